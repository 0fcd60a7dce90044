"""Linear scoring of pivot-form multinomial models and the confidence-gated cascade.

Tables:

* ``features(id, feature, value)`` — sparse item features (bucket or term key).
* ``weights(node, idx, feature, w)`` — pivot-form weights: class ``idx >= 1`` of
  the model at taxonomy ``node``; class 0 is the pivot with margin 0 (no rows); a NULL
  feature marks an intercept.  ``pack_weights`` stores them as vectors, one row per
  (node, feature) and block of ``CLASS_BLOCK`` classes.
* ``models(node, ...)`` — the nodes that have a model.
* ``index(parent_id, id, idx)`` — ``category_index``, class index → category id.

A margin is ``sum(value * w)``.  The predicted class is the one with the largest
margin when that margin is > 0, lowest index on ties, otherwise class 0; the
confidence is ``sigmoid(max(0, best margin))``.  A class with no overlapping
weight has margin 0 and so never beats the pivot — only joined classes matter.

Distribution: every level routes ``(id, node)`` pairs onto the features with an
equi-join on ``id`` (each item sits at one node per level), joins the packed weights on
``(node, feature)``, one row to one up to ``CLASS_BLOCK`` classes, and adds the vectors per item: one
sum per class in a hash aggregate, no row per class.  With features hash-partitioned by
``id`` all per-item aggregations and the level-to-level joins reuse that
partitioning; a level's packed weights are broadcast when their bytes pass the bound
(``treeclass.broadcastMaxBytes``), otherwise the rows of the frequent features are and only the
other features are shuffled (``joins.frequent_join``).
Only the nodes an item actually reaches are scored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from treeclass.functions.scoring import sigmoid
from treeclass.operators.joins import bounded_by, broadcast_max_bytes, frequent_join
from treeclass.session import cut_lineage

# Confidence gates of the cascade (L1, L2, L3), bounds inclusive.
DEFAULT_GATES = (0.7, 0.8, 0.9)


#: Classes of one packed row: a node with more has a row per feature and block.
CLASS_BLOCK = 64


def pack_weights(weights: DataFrame) -> DataFrame:
    """``node, feature, block, ws`` — the weights of classes ``block * CLASS_BLOCK + 1`` and on as
    an array (missing classes 0, trailing ones left out; repeated cells add up).  A scored (item,
    term) row then meets one row per block.  Packed frames pass unchanged."""
    if "ws" in weights.columns:
        return weights
    at = F.col("idx") - 1
    grouped = (weights.select("node", "feature", F.floor(at / CLASS_BLOCK).cast("int").alias("block"),
                              F.struct((at % CLASS_BLOCK).alias("pos"), "w").alias("c"))
               .groupBy("node", "feature", "block").agg(F.collect_list("c").alias("cs"), F.max("c.pos").alias("last")))
    cell = lambda i: F.aggregate("cs", F.lit(0.0), lambda s, c: s + F.when(c["pos"] == i, c["w"]).otherwise(0.0))
    return grouped.select("node", "feature", "block", F.transform(F.sequence(F.lit(0), F.col("last")), cell).alias("ws"))


def _shape_columns() -> list:
    """Size bound in bytes (8 a weight, 64 a row and its key), longest vector, blocks, and
    whether there are intercepts, of packed weights."""
    return [F.coalesce(F.sum(F.size("ws") * 8 + 64), F.lit(0)).alias("bytes"),
            F.coalesce(F.max(F.size("ws")), F.lit(0)).alias("width"),
            (F.coalesce(F.max("block"), F.lit(0)) + 1).alias("blocks"),
            F.coalesce(F.max(F.col("feature").isNull()), F.lit(False)).alias("icpt")]


def packed_shape(packed: DataFrame):
    """One row with the shape of packed weights (one pass over them)."""
    return packed.agg(*_shape_columns()).first()


def class_margins(features: DataFrame, routes: DataFrame, weights: DataFrame,
                  margin_digits: int | None = None,
                  broadcast_weights: bool | None = None, shape=None) -> DataFrame:
    """``id, node, margins`` — the margins of classes 1, 2, … as an array, for every route with
    a shared feature or an intercept; with more than ``CLASS_BLOCK`` classes a row per
    ``block`` of them.

    ``weights``: long or packed; rows with a NULL feature are intercepts, which every item
    at the node gets.  ``broadcast_weights``: None = decide by the size of the packed
    weights; True/False = a decision the caller already made.  ``shape``: their
    ``packed_shape`` when the caller has it.
    """
    packed = pack_weights(weights)
    shape = shape or packed_shape(packed)
    if broadcast_weights is None:
        broadcast_weights = shape.bytes <= broadcast_max_bytes(packed.sparkSession)
    # features are the big side: never broadcast them on a (compressed-size)
    # estimate; a merge join reads them from their id buckets and shuffles only
    # the routes
    routed = features.hint("merge").join(routes.select("id", "node"), "id")
    # broadcast behind the size check; otherwise the rows of frequent features are (a hot key: the
    # root sees every item), as many as the bound allows, and only the other features are shuffled
    row_bytes = (8 * shape.width + 64) * shape.blocks
    joined = frequent_join(routed, packed, ["node", "feature"], broadcast=broadcast_weights,
                           max_keys=broadcast_max_bytes(packed.sparkSession) // row_bytes).select(
        "id", "node", "block", "value", "ws")
    if shape.icpt:
        base = packed.where(F.col("feature").isNull()).select("node", "block", "ws")
        # at most one row per node and block: bounded by the model
        joined = joined.unionByName(routes.select("id", "node").join(bounded_by(base)(base), "node").select(
            "id", "node", "block", F.lit(1.0).alias("value"), "ws"))
    sums = [F.sum(F.get("ws", F.lit(i)) * F.col("value")) for i in range(max(1, shape.width))]
    if margin_digits is not None:
        sums = [F.round(x, margin_digits) for x in sums]
    keys = ["id", "node"] + ["block"] * (shape.blocks > 1)
    return joined.groupBy(*keys).agg(F.array(*(F.coalesce(x, F.lit(0.0)) for x in sums)).alias("margins"))


def best_class(margins: DataFrame) -> DataFrame:
    """``id, node, idx, margin`` — argmax over positive margins, lowest idx on ties."""
    top = F.array_max("margins")
    first = F.array_position("margins", top).cast("int")  # the first of equal margins
    if "block" not in margins.columns:
        return margins.where(top > 0).select("id", "node", first.alias("idx"), top.alias("margin"))
    idx = F.col("block") * CLASS_BLOCK + first
    best = margins.where(top > 0).groupBy("id", "node").agg(F.max(F.struct(top.alias("margin"), (-idx).alias("neg_idx"))).alias("b"))
    return best.select("id", "node", (-F.col("b.neg_idx")).cast("int").alias("idx"), F.col("b.margin").alias("margin"))


def score_routes(routes: DataFrame, features: DataFrame, weights: DataFrame,
                 margin_digits: int | None = None, single_route: bool = False,
                 broadcast_weights: bool | None = None, shape=None) -> DataFrame:
    """``id, node, idx, margin, confidence`` for every route (class 0 / 0.5 when
    no class has a positive margin).

    ``single_route=True`` declares at most one node per item (a cascade level):
    the result then joins back on ``id`` alone, which keeps the join aligned with
    an ``id`` partitioning instead of reshuffling on ``(id, node)``.
    """
    best = best_class(class_margins(features, routes, weights, margin_digits, broadcast_weights, shape))
    r = routes.select("id", "node")
    if single_route:
        joined = r.join(best.drop("node"), "id", "left")
    else:
        joined = r.join(best, ["id", "node"], "left")
    return (joined
            .select("id", "node", F.coalesce("idx", F.lit(0)).alias("idx"),
                    F.coalesce("margin", F.lit(0.0)).alias("margin"))
            .withColumn("confidence", sigmoid("margin")))


def linear_score(routes: DataFrame, features: DataFrame, weights: DataFrame, index: DataFrame,
                 margin_digits: int | None = None, single_route: bool = False,
                 broadcast_weights: bool | None = None, shape=None,
                 index_hint: Callable | None = None) -> DataFrame:
    """Adds the predicted child category: ``id, node, idx, category, margin, confidence``."""
    s = score_routes(routes, features, weights, margin_digits, single_route, broadcast_weights, shape)
    ix = (index_hint or bounded_by(index))(index.select(F.col("parent_id").alias("node"), "idx",
                                                        F.col("id").alias("category")))
    return s.join(ix, ["node", "idx"], "left").select(
        "id", "node", "idx", "category", "margin", "confidence")


def linear_score_runmax(routes: DataFrame, features: DataFrame, weights: DataFrame,
                        margin_digits: int | None = None) -> DataFrame:
    """Class of ``linear_score`` with the running-max confidence variant of the
    flat program: 0.5 for a class > 0, 0.0 for the pivot class."""
    s = score_routes(routes, features, weights, margin_digits)
    return s.select("id", "node", "idx",
                    F.when(F.col("idx") > 0, 0.5).otherwise(0.0).alias("confidence"))


def linear_predict(routes: DataFrame, features: DataFrame, weights: DataFrame,
                   margin_digits: int | None = None) -> DataFrame:
    """``id, node, prediction`` — class index only."""
    s = score_routes(routes, features, weights, margin_digits)
    return s.select("id", "node", F.col("idx").cast("double").alias("prediction"))


def cascade_predict(items: DataFrame, features: DataFrame, weights: DataFrame,
                    models: DataFrame, index: DataFrame, gates=DEFAULT_GATES,
                    margin_digits: int | None = None,
                    keep: Callable[[DataFrame], DataFrame] | None = cut_lineage) -> DataFrame:
    """Top-down cascade: ``id, cat1_pred, conf1, cat2_pred, conf2, cat3_pred, conf3``, one
    row for every item (ids unique); levels that an item does not reach are NULL, all
    of them when the root has no model.

    ``keep`` stores the results of levels 1 and 2 once (default: a reliable checkpoint;
    a run passes ``Scratch.keep`` so that its files go with it): each feeds the next level
    and the final assembly.  ``None`` leaves the whole cascade lazy.

    Level 1 scores every item at the root; an item descends to its predicted L1
    node when ``conf1 >= gates[0]`` and that node has a model, and to its
    predicted L2 node when also ``conf2 >= gates[1]`` and that node has a model.
    ``models`` needs ``node`` and ``level`` (1 = root model, 2 = L1 node, 3 = L2 node).
    Broadcasting is decided per level, by the size of that level's packed weights.
    """
    g1, g2, _ = gates
    keep = keep or (lambda df: df)
    spark = items.sparkSession
    packed = pack_weights(weights)
    small = bounded_by(models)
    hint = bounded_by(index)
    # one pass over the model: bytes, classes and intercepts of each level
    shapes = {r.level: r for r in packed.join(small(models.select("node", "level")), "node").groupBy("level").agg(
        *_shape_columns()).collect()}
    none = Row(bytes=0, width=0, blocks=1, icpt=False)

    def level(n: int, routes: DataFrame) -> DataFrame:
        nodes = small(models.where(F.col("level") == n).select("node"))
        routed = routes.join(nodes, "node", "left_semi")
        own = packed.join(nodes, "node", "left_semi")
        shape = shapes.get(n, none)
        return linear_score(routed, features, own, index, margin_digits, single_route=True,
                            broadcast_weights=shape.bytes <= broadcast_max_bytes(spark), shape=shape, index_hint=hint)

    s1 = keep(level(1, items.select("id", F.lit(0).alias("node"))))
    s2 = keep(level(2, s1.where(F.col("confidence") >= g1).select("id", F.col("category").alias("node"))))
    s3 = level(3, s2.where(F.col("confidence") >= g2).select("id", F.col("category").alias("node")))
    out = items.select("id")
    for n, s in enumerate((s1, s2, s3), 1):
        out = out.join(s.select("id", F.col("category").alias(f"cat{n}_pred"), F.col("confidence").alias(f"conf{n}")),
                       "id", "left")
    return out


def cascade_decode(pred: DataFrame, gates=DEFAULT_GATES, emit_level1: bool = False) -> DataFrame:
    """``id, depth, category`` (category 0 = undecided).

    Default semantics: a row that did not reach a second-level prediction gets
    depth 0; a second-level prediction is kept at depth 2 unless the third-level
    confidence passes ``gates[2]``, then depth 3.  ``emit_level1=True`` returns
    depth 1 with the L1 category when the first gate passed but no L1 model exists.
    """
    g3 = gates[2]
    no_l2 = F.col("cat2_pred").isNull()
    l3_ok = F.coalesce(F.col("conf3"), F.lit(-1.0)) >= g3
    depth = F.when(no_l2, 0).when(~l3_ok, 2).otherwise(3)
    category = F.when(no_l2, 0).when(~l3_ok, F.col("cat2_pred")).otherwise(F.col("cat3_pred"))
    if emit_level1:
        passed = F.col("conf1") >= gates[0]
        depth = F.when(no_l2 & passed, 1).otherwise(depth)
        category = F.when(no_l2 & passed, F.col("cat1_pred")).otherwise(category)
    return pred.select("id", depth.cast("int").alias("depth"), category.cast("int").alias("category"))
