"""Helpers shared by the corpus operators: scratch tables, ids, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeclass.session import scratch_path

#: A null document id counts as this id, the largest one.
NULL_ID = 2**63 - 1


def id_key(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: For rows of megabytes: Parquet looks at a page's and a row group's size after each row, not after 100,
#: so that writer and reader hold a few rows at once.  Such rows hardly repeat: no dictionary.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
              "parquet.block.size": str(16 << 20), "parquet.enable.dictionary": "false"}


def keep_table(df: DataFrame, name: str, partition_by: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` below the shared scratch folder and return the written table."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of our own through Spark's file system layer."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def sliced(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``max_bytes`` of ``column`` (one row at least)."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)
