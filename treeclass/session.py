"""Session helpers: a tuned builder for local runs and the shared scratch folder.

Scratch data (IO round trips, lineage cuts) always goes under the folder the
cluster names in ``spark.checkpoint.dir``.  A private folder is created only when
that setting is absent, which is the case for ad-hoc local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "treeclass") -> SparkSession:
    """Session for tests and benchmarks (a cluster passes its own session)."""
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder, read from the session.

    A private folder is set only for a local master without the setting (ad-hoc runs, tests);
    on a cluster an unset folder is an error, since executors would write to their own disks."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="treeclass-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/treeclass-scratch/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through Spark's file system layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Owner of a run's scratch data: its own folder, dropped with its tables on exit.

    Use it as a context manager around a run whose results are written before it ends."""

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark, self.root = spark, scratch_path(spark, name)
        self.tables: list[str] = []
        self.cached: list[DataFrame] = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, name: str = "kept") -> DataFrame:
        """Write ``df`` once and return the written table (cuts the lineage)."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, key: str, name: str, **kw) -> DataFrame:
        out, table = _save_bucketed(df, key, name, self.path(name), **kw)
        self.tables.append(table)
        return out

    def close(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables = []
        remove_path(self.spark, self.root)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss); Spark removes it
    when the frame is no longer used (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets(spark: SparkSession) -> int:
    """Partition and bucket count of per-item tables: the parameter ``treeclass.buckets``
    (size it as bytes of the feature table over 128-256 MB); unset, the shuffle partitions."""
    return int(spark.conf.get("treeclass.buckets", str(default_partitions(spark))))


def _save_bucketed(df: DataFrame, key: str, name: str, path: str, num_buckets: int | None = None,
                   partitioned: bool = False) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    n = num_buckets or buckets(spark)
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    # one file per bucket per task: group rows by key first unless they already are
    src = df if partitioned else df.repartition(n, key)
    (src.write.mode("overwrite").bucketBy(n, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return spark.table(table), table


def write_bucketed(df: DataFrame, key: str, name: str, num_buckets: int | None = None,
                   partitioned: bool = False) -> DataFrame:
    """Write ``df`` as a table bucketed (and sorted) by ``key`` in the shared
    folder and return the table.

    Scans of the table report hash partitioning on ``key``, so joins with
    another side on ``key`` shuffle only that side, and aggregations keyed by
    ``key`` (plus anything) need no exchange at all.
    """
    path = scratch_path(df.sparkSession, name)
    return _save_bucketed(df, key, name, path, num_buckets, partitioned)[0]


def fits(df: DataFrame, max_rows: int) -> bool:
    """Proven size bound: True iff ``df`` has at most ``max_rows`` rows.

    Reads at most ``max_rows + 1`` rows, so the check itself stays cheap.
    """
    return df.limit(max_rows + 1).count() <= max_rows
