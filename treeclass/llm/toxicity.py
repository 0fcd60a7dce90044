"""Toxicity scores from a factorization machine over hashed terms.

Terms of a text: its lower-cased words and their first four and five letters (inflected and
compounded forms share them), hashed into ``2**HASH_BITS`` buckets; a bucket counts once per
text.  Learning uses at most ``MAX_ROWS`` labelled texts (those with the smallest id hash):

1. per bucket, texts and toxic texts are counted (pre-aggregated in the tasks);
2. the ``TERMS`` buckets of largest chi-square statistic, if significant, become the features;
3. a distributed factorization machine (``pyspark.ml``) learns an intercept, a weight per
   feature and ``FACTORS`` factors per feature, whose products weigh pairs of features.

Scoring is one pass over the whole texts without a shuffle; only the fitted parameters
(``TERMS`` x (1 + ``FACTORS``) numbers) are sent to the tasks.

Defined cases: a null or text without words has no terms and the intercept's score; null labels
and labels without a document are not learned from; without both classes among the
labelled rows every score is that class, 0 or 1 (0 without labels); a null id is not held
out; repeated rows count as often as they occur; an empty table gives no scores; other
columns are never read.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeclass.llm.common import keep_table, sliced

MAX_ROWS = 20_000
HASH_BITS = 22
TERMS = 2048
MIN_TEXTS = 5
MIN_CHI = 10.83  # one in a thousand under independence
FACTORS = 4
THRESHOLD = 0.3
TASK_BYTES = 8 << 20
CACHE = 200_000

_WORD = re.compile(r"[^\W_]+")


def word_buckets(word: str) -> tuple[int, ...]:
    """Buckets of one word's terms."""
    w = word.encode()
    terms = [b"w" + w] + [b"p" + word[:n].encode() for n in (4, 5) if len(word) >= n]
    return tuple(zlib.crc32(t) & ((1 << HASH_BITS) - 1) for t in terms)


def text_buckets(text: str | None, cache: dict) -> set[int]:
    """Distinct buckets of a text; ``cache`` (word -> buckets) is emptied when it is full."""
    out: set[int] = set()
    for w in set(_WORD.findall((text or "").lower())):
        got = cache.get(w)
        if got is None:
            if len(cache) >= CACHE:
                cache.clear()
            got = cache[w] = word_buckets(w)
        out.update(got)
    return out


@dataclass
class Machine:
    """Fitted parameters; ``buckets`` sorted, a row of ``factors`` for each."""

    buckets: np.ndarray
    intercept: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, features: np.ndarray) -> float:
        v = self.factors[features]
        pairs = (np.square(v.sum(axis=0)) - np.square(v).sum(axis=0)).sum() / 2
        return float(self.intercept + self.weights[features].sum() + pairs)


def held_out(col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(y, buckets) of the labelled texts learned from, at most ``max_rows`` labels, written once."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("toxic") > 0).cast("int").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out("id"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)  # a bounded table: safe to broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("y", "text")

    def run(batches):
        cache: dict = {}
        for whole in batches:
            for batch in sliced(whole, "text", TASK_BYTES):
                found = [sorted(text_buckets(t, cache)) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("y"), pa.array(found, type=pa.list_(pa.int32()))], names=["y", "buckets"])
    return keep_table(rows.mapInArrow(run, "y int, buckets array<int>"), "toxicity_rows")


def bucket_counts(rows: DataFrame) -> DataFrame:
    """(bucket, n, n1): texts and toxic texts with the bucket, summed in each task first."""
    def run(batches):
        for batch in batches:
            values = batch.column("buckets")
            size = np.diff(values.offsets.to_numpy())
            y = np.repeat(batch.column("y").to_numpy(), size)
            bucket, at, n = np.unique(values.flatten().to_numpy(), return_inverse=True, return_counts=True)
            n1 = np.bincount(at, weights=y, minlength=len(bucket))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(n, type=pa.int64()), pa.array(n1.astype(np.int64))], names=["bucket", "n", "n1"])
    counted = rows.mapInArrow(run, "bucket int, n long, n1 long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, terms: int = TERMS) -> Machine:
    rows = training_rows(docs, labels, max_rows)
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    none = np.empty(0, dtype=np.int64)
    if not 0 < toxic < total:
        return Machine(none, math.inf if toxic else -math.inf, none.astype(float), np.empty((0, FACTORS)))
    a, n = F.col("n1").cast("double"), F.col("n").cast("double")
    all_, bad = F.lit(float(total)), F.lit(float(toxic))
    chi = all_ * F.pow(a * all_ - n * bad, 2) / (n * (all_ - n) * bad * (all_ - bad))
    best = bucket_counts(rows).where((F.col("n") >= MIN_TEXTS) & (F.col("n") < total)).withColumn(
        "chi", chi).where(F.col("chi") >= MIN_CHI).orderBy(F.desc("chi"), "bucket").limit(terms)
    buckets = sorted(r.bucket for r in best.select("bucket").collect())
    if not buckets:
        return Machine(none, math.log(toxic / (total - toxic)), none.astype(float), np.empty((0, FACTORS)))
    vocabulary = CountVectorizerModel.from_vocabulary([str(b) for b in buckets], "terms", "features")
    vectors = vocabulary.setBinary(True).transform(rows.select(
        F.col("y").cast("double").alias("label"), F.col("buckets").cast("array<string>").alias("terms"))).select("label", "features")
    model = FMClassifier(factorSize=FACTORS, maxIter=100, stepSize=0.1, regParam=1e-3, seed=7, solver="adamW").fit(vectors)
    return Machine(np.array(buckets), float(model.intercept), model.linear.toArray(),
                   np.array(model.factors.toArray()))


def with_scores(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; all columns pass through the tasks."""
    def run(batches):
        feature = {int(b): i for i, b in enumerate(machine.buckets)}
        cache: dict = {}

        def features(text):
            out: set[int] = set()
            for w in set(_WORD.findall((text or "").lower())):
                got = cache.get(w)
                if got is None:
                    if len(cache) >= CACHE:
                        cache.clear()
                    got = cache[w] = tuple(feature[b] for b in word_buckets(w) if b in feature)
                out.update(got)
            return np.fromiter(sorted(out), dtype=np.int64, count=len(out))

        for whole in batches:
            for batch in sliced(whole, "text", TASK_BYTES):
                z = np.array([machine.margin(features(t)) for t in batch.column("text").to_pylist()], dtype=float)
                with np.errstate(over="ignore"):
                    score = pa.array(1 / (1 + np.exp(-z)))
                yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_scores(rows, machine).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op1(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scores(docs, fit(docs, labels))
