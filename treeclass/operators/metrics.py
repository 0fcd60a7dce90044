"""Taxonomy-aware costs and classifier evaluation.

Cost of predicting ``b`` for true category ``a`` (``cost[a][b]``, 0 when equal),
``mode='exact'`` (the reference's path walk): climb from ``b`` one point per step
until reaching a node of ``path(a)``, then add twice that node's position in
``path(a)``.  ``path(a)`` = ``a`` (position 0), its k-th ancestor at position
``k + 1`` for ``1 <= k <= depth(a) - 2``, then the root at position
``depth(a)``; the L1 ancestor of a category of depth >= 2 is not on it.
``mode='tree'``: steps from ``b`` up to the lowest common ancestor plus twice the
steps from ``a`` up to it.

Costs are computed only for the ``(a, b)`` pairs an evaluation needs (equi-joins
on taxonomy-sized tables, broadcast after one size check of the closure, which bounds
them all); row sums come from subtree aggregates, so no
operator enumerates all category pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeclass.operators.joins import bounded_by
from treeclass.operators.taxonomy import category_depth


def _path_positions(closure: DataFrame, depth: DataFrame, mode: str, small) -> DataFrame:
    """``a, anc, p`` — nodes of ``path(a)`` with their position (root = anc 0)."""
    c = closure.join(small(depth), "id")
    if mode == "exact":
        nodes = c.where((F.col("hops") == 0) | (F.col("hops") <= F.col("depth") - 2)).select(
            F.col("id").alias("a"), "anc",
            F.when(F.col("hops") == 0, 0).otherwise(F.col("hops") + 1).alias("p"))
    elif mode == "tree":
        nodes = c.select(F.col("id").alias("a"), "anc", F.col("hops").alias("p"))
    else:
        raise ValueError("mode must be 'exact' or 'tree'")
    root = depth.select(F.col("id").alias("a"), F.lit(0).alias("anc"), F.col("depth").alias("p"))
    return nodes.unionByName(root)


def _climb(closure: DataFrame, depth: DataFrame) -> DataFrame:
    """``b, anc, hops`` — every ancestor of ``b`` (itself and the root included)."""
    root = depth.select(F.col("id").alias("b"), F.lit(0).alias("anc"), F.col("depth").alias("hops"))
    return closure.select(F.col("id").alias("b"), "anc", "hops").unionByName(root)


def pair_cost(pairs: DataFrame, closure: DataFrame, mode: str = "exact",
              carry: tuple[str, ...] = ()) -> DataFrame:
    """``a, b, cost`` (plus ``carry`` columns) for the given ``(a, b)`` pairs.

    One pass: each pair meets its ancestor tables on equi-keys; ``a = b`` meets
    itself at 0 steps and position 0, so equal pairs cost 0 without a branch
    (the input is consumed once).  Pairs are deduplicated on ``a, b, carry``.
    """
    depth, small = category_depth(closure), bounded_by(closure)
    pos = small(_path_positions(closure, depth, mode, small))
    up = small(_climb(closure, depth))
    keys = ["a", "b", *carry]
    p = pairs.select(*keys).distinct()
    return (p.join(pos, "a").join(up, ["b", "anc"])
            .groupBy(*keys)
            .agg(F.min_by(F.col("hops") + 2 * F.col("p"), F.col("hops")).cast("int").alias("cost")))


def cost_row_sums(category: DataFrame, closure: DataFrame) -> DataFrame:
    """``a, row_sum`` = sum over all b of ``cost[a][b]`` (exact mode), from
    subtree counts and depth sums; linear in taxonomy size x depth."""
    depth, small = category_depth(closure), bounded_by(closure)
    stats = (closure.join(small(depth), "id").groupBy("anc")
             .agg(F.count("*").alias("cnt"), F.sum("depth").alias("sd")))
    everything = depth.agg(F.count("*").alias("cnt"), F.sum("depth").alias("sd")).select(
        F.lit(0).alias("anc"), "cnt", "sd")
    stats = stats.unionByName(everything)
    node_depth = depth.select(F.col("id").alias("anc"), F.col("depth").alias("m_depth")).unionByName(
        category.sparkSession.range(1).select(F.lit(0).alias("anc"), F.lit(0).alias("m_depth")))
    pos = _path_positions(closure, depth, "exact", small)
    w = Window.partitionBy("a").orderBy("p")
    path = (pos.withColumn("below", F.lag("anc").over(w))
            .join(small(stats), "anc")
            .join(small(node_depth), "anc"))
    below = stats.select(F.col("anc").alias("below"), F.col("cnt").alias("cnt_b"),
                         F.col("sd").alias("sd_b"))
    path = path.join(small(below), "below", "left")
    n = F.col("cnt") - F.coalesce("cnt_b", F.lit(0))
    s = F.col("sd") - F.coalesce("sd_b", F.lit(0))
    # the category itself contributes 0; its proper descendants climb to it (p = 0)
    own = F.col("sd") - F.col("m_depth") * F.col("cnt")
    part = F.when(F.col("below").isNull(), own).otherwise(s - F.col("m_depth") * n + 2 * F.col("p") * n)
    return path.groupBy("a").agg(F.sum(part).cast("long").alias("row_sum"))


def category_frequency(labels: DataFrame, category: DataFrame, closure: DataFrame) -> DataFrame:
    """``id, freq`` — share of items whose deepest category is the category or a
    descendant of it (every ancestor below the root counts).  Items are counted per
    deepest category first, so only taxonomy-sized rows reach the closure join."""
    deepest = labels.select(F.coalesce("cat3", "cat2", "cat1").alias("cat"))
    per_cat = deepest.groupBy("cat").agg(F.count("*").alias("n"))
    # per_cat is taxonomy-sized, so a global window over it is a small task
    per_cat = per_cat.withColumn("total", F.sum("n").over(Window.partitionBy()))
    up = (per_cat.join(bounded_by(closure)(closure.select(F.col("id").alias("cat"), "anc")), "cat", "left")
          # a category outside the taxonomy is an error, not a smaller total
          .select(F.coalesce("anc", F.raise_error(F.format_string("unknown category %s", "cat")).cast("int")).alias("id"),
                  "n", "total")
          .groupBy("id").agg(F.sum("n").alias("n"), F.first("total").alias("total")))
    total = F.max("total").over(Window.partitionBy())
    return (category.select("id").join(up, "id", "left")
            .select("id", (F.coalesce("n", F.lit(0)) / total).alias("freq")))


def category_weights(freq: DataFrame, row_sums: DataFrame, num_categories: int) -> DataFrame:
    """``id, weight = freq * n / row_sum``."""
    return (freq.join(row_sums.withColumnRenamed("a", "id"), "id")
            .select("id", F.try_divide(F.col("freq") * F.lit(num_categories),
                                       F.col("row_sum").cast("double")).alias("weight")))


def mean_hier_cost(pred: DataFrame, closure: DataFrame, mode: str = "exact") -> DataFrame:
    """``n, n_unknown, total_cost, mean_cost`` over ``pred(id, label, prediction)``
    (category ids).  Correct rows cost 0 but count.  Rows whose label or prediction is not
    in the taxonomy have no cost: they are counted in ``n_unknown`` and the mean is over the
    others, so a caller must look at ``n_unknown`` (the flows raise).  Rows are
    pre-aggregated per (label, prediction) pair before the cost lookup."""
    pairs = (pred.groupBy(F.col("label").alias("a"), F.col("prediction").alias("b"))
             .agg(F.count("*").alias("n")))
    depth, small = category_depth(closure), bounded_by(closure)
    pos = small(_path_positions(closure, depth, mode, small))
    up = small(_climb(closure, depth))
    per_pair = (pairs.join(pos, "a", "left").join(up, ["b", "anc"], "left")
                .groupBy("a", "b", "n")
                .agg(F.min_by(F.col("hops") + 2 * F.col("p"), F.col("hops")).alias("cost")))
    known = F.col("cost").isNotNull()
    agg = per_pair.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                       F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_unknown"),
                       F.coalesce(F.sum(F.when(known, F.col("n") * F.col("cost"))), F.lit(0)).alias("total_cost"))
    return agg.select(
        F.col("n").cast("long").alias("n"), F.col("n_unknown").cast("long").alias("n_unknown"),
        F.col("total_cost").cast("long").alias("total_cost"),
        F.try_divide(F.col("total_cost").cast("double"), F.col("n") - F.col("n_unknown")).alias("mean_cost"))


def selective_accuracy(decoded: DataFrame, truth: DataFrame, compare: str = "id",
                       index: DataFrame | None = None) -> DataFrame:
    """``n_correct, n_resolved, selective_accuracy`` over rows with depth != 0.

    ``decoded(id, depth, category)`` from the cascade, ``truth(id, cat1, cat2, cat3)``.
    ``compare='id'`` compares category ids at the accepted depth.
    ``compare='local_index'`` compares in-parent class indexes instead (the
    reference's form, where a wrong parent with the same local index counts as
    right); it needs ``truth`` from ``label_encode`` (``l1_idx, l2_idx, l3_idx``)
    and the class ``index`` to map predicted categories to their local index.
    """
    j = decoded.join(truth, "id")
    if compare == "id":
        right = F.col("category") == (F.when(F.col("depth") == 1, F.col("cat1"))
                                      .when(F.col("depth") == 2, F.col("cat2"))
                                      .when(F.col("depth") == 3, F.col("cat3")))
    elif compare == "local_index":
        if index is None:
            raise ValueError("compare='local_index' needs the class index")
        ix = bounded_by(index)(index.select(F.col("id").alias("category"), F.col("idx").alias("pred_idx")))
        j = j.join(ix, "category", "left")
        right = F.col("pred_idx") == (F.when(F.col("depth") == 1, F.col("l1_idx"))
                                      .when(F.col("depth") == 2, F.col("l2_idx"))
                                      .when(F.col("depth") == 3, F.col("l3_idx")))
    else:
        raise ValueError("compare must be 'id' or 'local_index'")
    resolved = F.col("depth") != 0
    agg = j.agg(F.sum(F.when(resolved & F.coalesce(right, F.lit(False)), 1).otherwise(0)).cast("long")
                .alias("n_correct"),
                F.sum(F.when(resolved, 1).otherwise(0)).cast("long").alias("n_resolved"))
    return agg.select("n_correct", "n_resolved",
                      F.try_divide(F.col("n_correct").cast("double"), F.col("n_resolved"))
                      .alias("selective_accuracy"))


def accuracy(pred: DataFrame) -> DataFrame:
    """``n, n_correct, accuracy`` over ``pred(label, prediction)``."""
    agg = pred.agg(F.count("*").alias("n"),
                   F.sum(F.when(F.col("label") == F.col("prediction"), 1).otherwise(0))
                   .cast("long").alias("n_correct"))
    return agg.select("n", "n_correct",
                      F.try_divide(F.col("n_correct").cast("double"), F.col("n")).alias("accuracy"))


def multiclass_metrics(pred: DataFrame) -> DataFrame:
    """Accuracy and label-weighted F1, precision, recall, TPR, FPR over
    ``pred(label, prediction)``, from a (label, prediction) confusion table."""
    conf = pred.groupBy("label", "prediction").agg(F.count("*").alias("n"))
    by_label = conf.groupBy(F.col("label").alias("c")).agg(
        F.sum("n").alias("n_label"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = conf.groupBy(F.col("prediction").alias("c")).agg(
        F.sum(F.when(F.col("label") != F.col("prediction"), F.col("n")).otherwise(0)).alias("fp"))
    # one row per class: a global window over it is a small task
    per = (by_label.join(by_pred, "c", "left")
           .select("c", "n_label", "tp", F.coalesce("fp", F.lit(0)).alias("fp"),
                   F.sum("n_label").over(Window.partitionBy()).alias("total")))
    precision = F.when(F.col("tp") + F.col("fp") == 0, F.lit(0.0)).otherwise(
        F.col("tp") / (F.col("tp") + F.col("fp")))
    recall = F.col("tp") / F.col("n_label")
    per = per.select("*", precision.alias("precision"), recall.alias("recall"),
                     F.try_divide(F.col("fp").cast("double"), F.col("total") - F.col("n_label"))
                     .alias("fpr"))
    f1 = F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    share = F.col("n_label") / F.col("total")
    return per.agg(
        (F.sum("tp") / F.first("total")).alias("accuracy"),
        F.sum(f1 * share).alias("weighted_f_measure"),
        F.sum(F.col("precision") * share).alias("weighted_precision"),
        F.sum(F.col("recall") * share).alias("weighted_recall"),
        F.sum(F.col("recall") * share).alias("weighted_true_positive_rate"),
        F.sum(F.col("fpr") * share).alias("weighted_false_positive_rate"))
