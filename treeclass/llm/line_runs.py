"""Line deduplication over levelled sorted runs of line hashes (DataFrame operations only).

Documents arrive in batches of ascending id ranges.  A batch's line keys are
reduced to one row per key, anti-joined with every stored run (a merge join on
the bucketed, sorted hash; only the batch is shuffled), and the keys that no run
holds become a new run of their own.  When ``fanout`` runs of a level have
gathered, they are merged into one run of the next level, so the number of runs
to be probed grows with the logarithm of the batches.

A key is the line with white space stripped at both ends and A-Z lower-cased.
Keys of at least ``min_chars`` code points that at least two documents hold stay
only in the document with the smallest id; all its lines with that key stay.

Defined cases: a null text is one empty line; a null id counts as the largest
id; rows that share an id are one document (each row is rewritten on its own);
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeclass.llm.common import id_key, keep_table, remove_path
from treeclass.session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 10
BATCHES = 4
FANOUT = 3


def line_key(line: Column) -> Column:
    stripped = F.trim(line, F.lit(BLANKS))
    # lower() folds A-Z alone when the line is ASCII; other letters must stay as they are
    return F.when(F.octet_length(stripped) == F.length(stripped), F.lower(stripped)).otherwise(
        F.translate(stripped, UPPER, LOWER))


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, row, pos, h1, h2): one row per line that counts.  ``row`` tells rows of one
    id apart by their text; (h1, h2) is a 128-bit hash of the key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select(id_key().alias("id"), F.xxhash64(text).alias("row"),
                        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keyed = lines.select("id", "row", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "id", "row", "pos", F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), F.col("key")).alias("h2"))


class LineRuns:
    """The stored runs: bucketed tables (h1, h2, first), sorted by hash, in levels."""

    def __init__(self, spark, buckets: int | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def _write(self, run: DataFrame) -> tuple[str, str]:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        path = scratch_path(self.spark, name)
        (run.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2")
         .sortBy("h1", "h2").option("path", path).saveAsTable(name))
        return name, path

    def _remove(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run[0]}")
        remove_path(self.spark, run[1])

    def _append(self, run: tuple[str, str], level: int = 0) -> None:
        """Store a run; a full level is compacted into one run of the next."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = reduce(DataFrame.unionByName, (self.spark.table(n) for n, _ in full))
            self._append(self._write(merged), level + 1)
            for old in full:
                self._remove(old)

    def add(self, batch: DataFrame, name: str = "line_drops") -> DataFrame:
        """Lines (id, row, pos) of ``batch`` to drop, as a written table; the runs then hold
        the batch's new keys.  Batches must come in ascending id order, an id in one batch."""
        firsts = keep_table(batch.groupBy("h1", "h2").agg(
            F.min("id").alias("first"), F.max("id").alias("last")), "line_firsts")
        key = ["h1", "h2"]
        fresh, known = firsts, []
        for run in self.tables():
            fresh = fresh.join(run.select(*key), key, "left_anti")
            known.append(run.join(firsts.select(*key), key).select(*key, "first"))
        # keys met before, or new ones that two documents of this batch share
        known.append(firsts.where("first < last").select(*key, "first"))
        owner = reduce(DataFrame.unionByName, known).groupBy(*key).agg(F.min("first").alias("first"))
        drops = batch.join(owner, key).where("first < id").select("id", "row", "pos")
        out, run = keep_table(drops, name), self._write(fresh.select(*key, "first"))
        self._append(run)  # last: compaction removes the runs read above
        return out

    def close(self) -> None:
        for level in self.levels:
            for run in level:
                self._remove(run)
        self.levels = []


def id_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Upper ids (exclusive) of all batches but the last: quantiles of the ids."""
    cuts = docs.agg(F.percentile_approx(id_key(), [i / batches for i in range(1, batches)], 1000)
                    ).first()[0] if batches > 1 else []
    return sorted(set(cuts or []))


def dropped_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS,
                  fanout: int = FANOUT) -> DataFrame:
    """(id, row, pos) of every line to drop, batch after batch through the runs."""
    spark = docs.sparkSession
    bounds = id_bounds(docs.select("doc_id"), batches)
    number = sum((F.when(F.col("id") >= b, 1).otherwise(0) for b in bounds), F.lit(0))
    keys = keep_table(line_keys(docs, min_chars).withColumn("batch", number), "line_keys", "batch")
    runs = LineRuns(spark, fanout=fanout)
    drops = [runs.add(keys.where(F.col("batch") == b).drop("batch")) for b in range(len(bounds) + 1)]
    runs.close()
    return reduce(DataFrame.unionByName, drops)


def dedup_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS,
                fanout: int = FANOUT, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with ``text`` rewritten; ``counts`` names columns for the lines before and the
    lines dropped, to be added.

    Only (id, row, positions) of documents that lose lines meet the texts again."""
    columns = docs.columns
    drops = dropped_lines(docs, batches, min_chars, fanout).groupBy(
        F.col("id").alias("_runs_id"), F.col("row").alias("_runs_row")).agg(F.collect_set("pos").alias("_runs_gone"))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({"_runs_id": id_key(), "_runs_row": F.xxhash64(text)})
    joined = keyed.join(drops, ["_runs_id", "_runs_row"], "left")
    split = joined.withColumn("_runs_lines", F.split(text, "\n", -1))
    counted = split.withColumns({
        "_runs_gone": F.coalesce("_runs_gone", F.array().cast("array<int>")), "_runs_n": F.size("_runs_lines")})
    # set difference of positions: linear in the lines, however many are dropped
    kept = F.array_except(F.sequence(F.lit(0), F.col("_runs_n") - 1), F.col("_runs_gone"))
    rebuilt = counted.withColumns({
        "_runs_dropped": F.size("_runs_gone"),
        "text": F.when(F.size("_runs_gone") == 0, F.col("text")).otherwise(
            F.array_join(F.transform(kept, lambda i: F.get(F.col("_runs_lines"), i)), "\n"))})
    added = [F.col(c).cast("long").alias(n) for c, n in zip(("_runs_n", "_runs_dropped"), counts or ())]
    return rebuilt.select(*columns, *added)


def op10(docs: DataFrame) -> DataFrame:
    """Per document: line counts and the hash of what is kept."""
    out = dedup_lines(docs.select("doc_id", "text"), counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines),
firsts as (
  select k, min(doc_id) as first_doc from keyed where length(k) >= 10 group by k),
marked as (
  select l.doc_id, l.pos, l.line, coalesce(f.first_doc < l.doc_id, false) as gone
  from keyed l left join firsts f on l.k = f.k and length(l.k) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
