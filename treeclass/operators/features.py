"""Hashed term frequency, inverse document frequency, TF-IDF, labelled vectors.

Long form first: ``tf(id, bucket, tf)``, ``idf(bucket, df, idf)``,
``tfidf(id, bucket, value)``.  The IDF table has at most ``num_buckets`` rows,
a bound fixed by a parameter, so it is broadcast without a data check.  Vectors
(``pyspark.ml`` sparse) are only assembled for model fitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeclass.functions.hashing import bucket as bucket_expr
from treeclass.operators.joins import small_side
from treeclass.session import cut_lineage

# Bucket counts used by the reference (30 * 1024 for every level of
# the cascade; 2^20, 100 * 1024, 60 * 1024 for levels 0/1/2 of the flat program).
CASCADE_BUCKETS = 30 * 1024
FLAT_BUCKETS_BY_LEVEL = {0: 1 << 20, 1: 100 * 1024, 2: 60 * 1024}
CASCADE_BUCKETS_BY_LEVEL = {1: CASCADE_BUCKETS, 2: CASCADE_BUCKETS, 3: CASCADE_BUCKETS}


def hashing_tf(bag: DataFrame, num_buckets: int = CASCADE_BUCKETS,
               hash_fn: str = "murmur3") -> DataFrame:
    """``id, bucket, tf`` — count of the item's terms falling in each bucket."""
    return (bag.select("id", bucket_expr("term", num_buckets, hash_fn).alias("bucket"))
            .groupBy("id", "bucket").agg(F.count("*").alias("tf")))


def idf(tf: DataFrame, num_docs: int) -> DataFrame:
    """``bucket, df, idf`` with ``idf = ln((m + 1) / (df + 1))``, no minimum df.

    ``num_docs`` (m) counts every item the IDF is fitted on, including items
    whose bag is empty.
    """
    return (tf.groupBy("bucket").agg(F.count("*").alias("df"))
            .select("bucket", "df",
                    F.log((F.lit(float(num_docs)) + 1.0) / (F.col("df") + 1.0)).alias("idf")))


def node_idf(tf: DataFrame, rows: DataFrame) -> DataFrame:
    """``node, bucket, df, n_docs, idf`` — the IDF of every node's own training set in one
    aggregation.  ``rows(id, node)``: the training rows of all nodes (an item is in at most one
    set per level); ``n_docs`` counts those without terms too.  At most nodes x buckets rows."""
    # an item's nodes travel as one array, so each term row is joined once
    nodes = rows.groupBy("id").agg(F.collect_set("node").alias("nodes"))
    df = (tf.select("id", "bucket").join(nodes, "id").select(F.explode("nodes").alias("node"), "bucket")
          .groupBy("node", "bucket").agg(F.count("*").alias("df")))
    sizes = rows.groupBy("node").agg(F.count_distinct("id").alias("n_docs"))
    return df.join(small_side(sizes), "node").select(
        "node", "bucket", "df", "n_docs", F.log((F.col("n_docs") + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def fold_idf(weights: DataFrame, idf_by_node: DataFrame) -> DataFrame:
    """Weights of models fitted on ``tf x idf`` of their node, times that IDF: they score plain term
    frequencies.  A bucket outside a node's training set has no weight there; intercepts stay."""
    known = weights.where(F.col("feature").isNotNull()).join(
        idf_by_node.select("node", F.col("bucket").alias("feature"), "idf"), ["node", "feature"])
    folded = known.select("node", "idx", "feature", (F.col("w") * F.col("idf")).alias("w"))
    return folded.unionByName(weights.where(F.col("feature").isNull()).select("node", "idx", "feature", "w"))


def tfidf(tf: DataFrame, idf_table: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``id, bucket, value = tf * idf`` and the ``carry`` columns of both tables (idf broadcast: at
    most one row per bucket)."""
    own = [c for c in carry if c in idf_table.columns and c not in tf.columns]
    return (tf.join(F.broadcast(idf_table.select("bucket", "idf", *own)), "bucket")
            .select("id", "bucket", *carry, (F.col("tf") * F.col("idf")).alias("value")))


def fit_tfidf(items: DataFrame, bag: DataFrame, num_buckets: int = CASCADE_BUCKETS,
              hash_fn: str = "murmur3", idf_table: DataFrame | None = None, keep=cut_lineage):
    """TF-IDF of ``bag``; the IDF is fitted on ``items`` unless one is given.

    Returns ``(tfidf_long, idf_table)``.  Fitting needs two passes over the term
    frequencies (document frequencies first, then the product), so ``tf`` is then
    materialised once instead of re-tokenising (``keep``: a checkpoint in the shared folder by default).
    """
    tf = hashing_tf(bag, num_buckets, hash_fn)
    if idf_table is None:
        tf = keep(tf)
        idf_table = idf(tf, items.count())
    return tfidf(tf, idf_table), idf_table


def tfidf_vectors(items: DataFrame, tf: DataFrame, idf_table: DataFrame | None, num_buckets: int) -> DataFrame:
    """``id, features`` = tf x idf sparse vectors, built without Python; without an IDF
    table the plain term frequencies.

    Each item's buckets become tokens (bucket id as text, repeated ``tf`` times;
    grouped per item, so bounded by that item's terms), a count vectorizer whose
    vocabulary is the bucket ids ``0..n-1`` turns them into sparse count vectors,
    and an element-wise product scales them by the IDF (a dense vector of
    ``num_buckets`` values: bounded by the parameter, not by the data).  Items
    without terms get an empty vector.
    """
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
    from pyspark.ml.linalg import DenseVector

    tokens = (tf.select("id", F.array_repeat(F.col("bucket").cast("string"), F.col("tf").cast("int"))
                        .alias("t"))
              .groupBy("id").agg(F.flatten(F.collect_list("t")).alias("tokens")))
    docs = items.select("id").join(tokens, "id", "left").select(
        "id", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    vocab = [str(i) for i in range(num_buckets)]
    counts = CountVectorizerModel.from_vocabulary(vocab, inputCol="tokens", outputCol="tf_vec").transform(docs)
    if idf_table is None:
        return counts.select("id", F.col("tf_vec").alias("features"))
    scale = [0.0] * num_buckets
    for r in idf_table.select("bucket", "idf").collect():  # <= num_buckets rows
        scale[int(r["bucket"])] = float(r["idf"])
    prod = ElementwiseProduct(scalingVec=DenseVector(scale), inputCol="tf_vec", outputCol="features")
    return prod.transform(counts).select("id", "features")


def level_features(long: DataFrame, level: int) -> DataFrame:
    """``id, features{level}``: an item's ``tfidf`` rows of one level as an array of (bucket, value) by bucket
    (bounded by the item's own terms)."""
    return long.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("bucket", "value"))).alias(f"features{level}"))


def join_levels(labels: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Label rows with the features of all levels: a chain of inner joins of the levels' features by item, then
    with the label rows.  ``levels`` have a row per id (``level_features``), so each label row comes once however
    often its id does; an item that lacks terms at a level has no row."""
    rows = levels[0]
    for level in levels[1:]:
        rows = rows.join(level, "id")
    return labels.join(rows, "id")


def stored_values(vectors: str) -> Column:
    """The values that a vector column holds, in the order of their indices: of a sparse vector those of
    its non-empty buckets, so an item costs its own terms and not ``num_buckets``."""
    return F.unwrap_udt(vectors)["values"]


def labeled_features(labels: DataFrame, level_label: str, vectors: DataFrame) -> DataFrame:
    """``id, label DOUBLE, features`` for items whose ``level_label`` is present (>= 0)."""
    return (labels.where(F.col(level_label) >= 0)
            .select("id", F.col(level_label).cast("double").alias("label"))
            .join(vectors, "id"))
