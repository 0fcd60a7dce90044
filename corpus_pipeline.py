"""The corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``.  A stage works on every row its predecessor kept.  Whether a row is dropped
depends on that row, not on its id: rows that share an id, or have none, are judged one by one.
Where ids are compared, a null id counts as the largest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeclass.llm import curve_packing, decontaminate, line_runs, simhash_pivots, tokens, toxicity
from treeclass.llm.common import id_key, keep_table, table


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of each row, written once so that the numbers stay."""
    return keep_table(docs.withColumn("_pipeline_row", F.monotonically_increasing_id()), "pipeline_rows")


def _texts(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("_pipeline_row").alias("doc_id"), "text")


def _rows_of(rows: DataFrame, numbers: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of numbered rows with a column of numbers."""
    return rows.join(numbers.toDF("_pipeline_row"), "_pipeline_row", how).drop("_pipeline_row")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold go."""
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs, machine, "_pipeline_score")
    return scored.where(F.col("_pipeline_score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; ``n_chars`` follows the text."""
    out = line_runs.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays; of several, the one with the
    smallest text hash."""
    rows = _numbered(docs)
    groups = simhash_pivots.near_duplicates(_texts(rows)).select(F.col("doc_id").alias("_pipeline_row"), "component_id")
    order = rows.select("_pipeline_row", id_key().alias("id"), F.xxhash64("text").alias("hash"))
    first = groups.join(order, "_pipeline_row").groupBy("component_id").agg(F.min(F.struct("id", "hash", "_pipeline_row")).alias("first"))
    return _rows_of(rows, first.select("first._pipeline_row"), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's windows cover beyond the contract's share go."""
    rows = _numbered(docs)
    found = decontaminate.contamination(_texts(rows), table(spark, sf_dir, "benchmark"))
    return _rows_of(rows, found.where("contaminated").select("doc_id"), "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of padded sequences, with their token ids."""
    return curve_packing.pack(docs, tokens.file(tokens.RANKS))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("packing", pack_sequences)]

#: Fitted scores, fingerprints and tokens have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
