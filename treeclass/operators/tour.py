"""Interval index of a taxonomy: the places where a walk enters and leaves each category.

The walk goes down the children in id order: ``a`` lies in the subtree of ``b`` iff its interval
``[enter, leave]`` lies in b's.  Sums over subtrees, and over the path to the root, are differences
of running sums along the walk, and the depth of the lowest common ancestor of two categories is the
smallest depth between the places where they are entered.  All tables have as many rows as the
taxonomy (times the logarithm of its size for common ancestors), whatever its depth: a chain of
n categories has n rows here and n * n / 2 in the closure.

The walk is a linked list of 2 n steps, numbered by pointer doubling: a round halves what is left, so
the number of jobs is the logarithm of the taxonomy's size, not its depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.operators.ordering import dense_index, running_sums
from treeclass.session import Scratch, cut_lineage


def category_tour(category: DataFrame) -> DataFrame:
    """``id, parent_id, depth, enter, leave`` of every category and the root (id 0, depth 0,
    parent NULL); L1 has depth 1.  A category without a parent in the taxonomy, and a cycle, raise."""
    nodes = cut_lineage(category.select(F.col("id").cast("long"), F.col("parent_id").cast("long")))
    lost = nodes.where("parent_id <> 0").join(nodes.select(F.col("id").alias("parent_id")), "parent_id", "left_anti").count()
    if lost:
        raise ValueError(f"{lost} categories have a parent that is not in the taxonomy")
    # siblings follow each other in one global order, so a parent with very many children is split
    ordered = cut_lineage(dense_index(nodes, ["parent_id", "id"], "place"))
    following = ordered.select((F.col("place") - 1).alias("place"), F.col("id").alias("next_id"), F.col("parent_id").alias("next_parent"))
    down = nodes.groupBy("parent_id").agg(F.min("id").alias("child")).withColumnRenamed("parent_id", "id")
    root = category.sparkSession.range(1).select(F.lit(0).cast("long").alias("id"), F.lit(None).cast("long").alias("parent_id"),
                                                 F.lit(None).cast("long").alias("sibling"))
    links = ordered.join(following, "place", "left").select(
        "id", "parent_id", F.when(F.col("next_parent") == F.col("parent_id"), F.col("next_id")).alias("sibling"))
    links = links.unionByName(root).join(down, "id", "left")
    enter, leave = lambda c: F.col(c) * 2, lambda c: F.col(c) * 2 + 1
    steps = links.select(F.inline(F.array(
        F.struct(enter("id").alias("step"), F.coalesce(enter("child"), leave("id")).alias("next"), F.lit(1).alias("up")),
        F.struct(leave("id").alias("step"), F.coalesce(enter("sibling"), leave("parent_id")).alias("next"), F.lit(-1).alias("up")))))
    # per step: how many follow it, and the sum of their ups, over a stretch that doubles
    now = cut_lineage(steps.select("step", "next", F.when(F.col("next").isNull(), 0).otherwise(1).cast("long").alias("after"),
                                   F.lit(0).cast("long").alias("rise"), F.col("up").cast("long").alias("up")))
    # what lies ahead of a step excludes its own up: the next step's up joins in
    now = now.join(now.select(F.col("step").alias("next"), F.col("up").alias("next_up")), "next", "left").select(
        "step", "next", "after", F.coalesce("next_up", F.lit(0).cast("long")).alias("rise"), "up")
    total = 2 * nodes.count() + 2
    for _ in range(total.bit_length() + 1):
        now = cut_lineage(now)
        if now.where(F.col("next").isNotNull()).isEmpty():
            break
        ahead = now.select(F.col("step").alias("next"), F.col("next").alias("next2"), F.col("after").alias("after2"), F.col("rise").alias("rise2"))
        now = now.join(ahead, "next", "left").select(
            "step", F.col("next2").alias("next"), (F.col("after") + F.coalesce("after2", F.lit(0))).alias("after"),
            (F.col("rise") + F.coalesce("rise2", F.lit(0))).alias("rise"), "up")
    else:
        raise ValueError("the taxonomy has a cycle")
    placed = now.select(F.floor(F.col("step") / 2).alias("id"), F.pmod("step", F.lit(2)).alias("end"),
                        (F.lit(total - 1) - F.col("after")).alias("at"), "rise")
    both = placed.groupBy("id").agg(F.min(F.when(F.col("end") == 0, F.col("at"))).alias("enter"),
                                    F.min(F.when(F.col("end") == 1, F.col("at"))).alias("leave"),
                                    # all ups add to 0: what is ahead is what lies behind, negated
                                    F.min(F.when(F.col("end") == 0, -F.col("rise") - 1)).alias("depth"))
    return cut_lineage(both.join(nodes.unionByName(root.select("id", "parent_id")), "id").select(
        F.col("id").cast("int"), F.col("parent_id").cast("int"), F.col("depth").cast("int"), "enter", "leave"))


def _ends(tour: DataFrame, *columns: str) -> DataFrame:
    """``at, id, sign`` — a row where a category is entered (sign 1) and where it is left (-1)."""
    return tour.select(F.inline(F.array(
        F.struct(F.col("enter").alias("at"), F.lit(1).alias("sign"), "id", *columns),
        F.struct(F.col("leave").alias("at"), F.lit(-1).alias("sign"), "id", *columns))))


def subtree_sums(tour: DataFrame, values: list[str]) -> DataFrame:
    """``id, <value>`` — each of ``values`` (long columns of ``tour``) summed over the subtree."""
    steps = _ends(tour, *values).select("id", "at", "sign", *(F.when(F.col("sign") == 1, F.col(v)).otherwise(0).alias(v) for v in values))
    run = running_sums(steps, ["at"], values)
    return run.groupBy("id").agg(*(F.sum(-F.col("sign") * F.col(f"{v}_before")).cast("long").alias(v) for v in values))


def path_sums(tour: DataFrame, values: list[str]) -> DataFrame:
    """``id, <value>`` — each of ``values`` summed over the category and its ancestors."""
    steps = _ends(tour, *values).select("id", "at", "sign", *((F.col("sign") * F.col(v)).alias(v) for v in values))
    run = running_sums(steps, ["at"], values)
    return run.where("sign = 1").select("id", *((F.col(f"{v}_before") + F.col(v)).cast("long").alias(v) for v in values))


def common_depth(pairs: DataFrame, tour: DataFrame) -> DataFrame:
    """``pairs`` (``a, b`` and other columns) with ``depth_a``, ``depth_b`` and ``depth_common``, the
    depth of the lowest common ancestor.  Pairs outside the taxonomy go.

    A table holds the smallest depth over every stretch of 2^k steps, so a pair looks up two."""
    ends = tour.select("id", F.col("enter").alias("at"), "depth")
    met = (pairs.join(ends.toDF("a", "at_a", "depth_a"), "a").join(ends.toDF("b", "at_b", "depth_b"), "b")
           .withColumn("low", F.least("at_a", "at_b")).withColumn("high", F.greatest("at_a", "at_b")))
    met = cut_lineage(met.withColumn("k", F.floor(F.log2(F.col("high") - F.col("low") + 1)).cast("int")))
    most = met.agg(F.max("k")).first()[0]
    with Scratch(tour.sparkSession, "tour") as scratch:
        # the depth of the walk after each step; written tables, since what a checkpoint remembers of
        # its conditions piles up in the plans, round by round
        stretch = scratch.keep(_ends(tour, "depth").select(
            "at", F.when(F.col("sign") == 1, F.col("depth")).otherwise(F.col("depth") - 1).alias("m")))
        table = stretch.withColumn("k", F.lit(0))
        for k in range(most or 0):
            later = stretch.select((F.col("at") - (1 << k)).alias("at"), F.col("m").alias("m2"))
            stretch = scratch.keep(stretch.join(later, "at", "left").select("at", F.least("m", "m2").alias("m")))
            table = table.unionByName(stretch.withColumn("k", F.lit(k + 1)))
        first = table.select("k", F.col("at").alias("low"), F.col("m").alias("m1"))
        second = table.select("k", F.col("at").alias("start"), F.col("m").alias("m2"))
        met = met.withColumn("start", F.col("high") - F.expr("shiftleft(1L, k)") + 1)
        return cut_lineage(met.join(first, ["k", "low"]).join(second, ["k", "start"]).select(
            *pairs.columns, "depth_a", "depth_b", F.least("m1", "m2").alias("depth_common")))


def pair_cost(pairs: DataFrame, tour: DataFrame, mode: str = "exact", carry: tuple[str, ...] = ()) -> DataFrame:
    """``metrics.pair_cost`` through the tour: ``a, b, cost`` of distinct pairs.

    The climb from ``b`` meets the path of ``a`` at their lowest common ancestor, unless (exact mode)
    that is an L1 category other than ``a``, which is not on the path: then at the root."""
    if mode not in ("exact", "tree"):
        raise ValueError("mode must be 'exact' or 'tree'")
    met = common_depth(pairs.select("a", "b", *carry).distinct(), tour)
    a, b, m = F.col("depth_a"), F.col("depth_b"), F.col("depth_common")
    if mode == "tree":
        cost = (b - m) + 2 * (a - m)
    else:
        top = F.when((m == 1) & (a > 1), F.lit(0)).otherwise(m)
        cost = F.when(m == a, b - a).when(top == 0, b + 2 * a).otherwise((b - top) + 2 * (a - top + 1))
    return met.select("a", "b", *carry, cost.cast("int").alias("cost"))


def category_frequency(labels: DataFrame, tour: DataFrame) -> DataFrame:
    """``metrics.category_frequency`` through the tour: ``id, freq``."""
    counts = labels.select(F.coalesce("cat3", "cat2", "cat1").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    known = counts.join(tour.select("id", "enter"), "id", "left").select(
        F.when(F.col("enter").isNull(), F.raise_error(F.format_string("unknown category %s", "id")).cast("int")).otherwise(F.col("id")).alias("id"), "n")
    own = cut_lineage(tour.join(known, "id", "left").withColumn("n", F.coalesce("n", F.lit(0))))
    sums = cut_lineage(subtree_sums(own, ["n"]))
    total = sums.where("id = 0").select(F.col("n").alias("total"))  # the root's subtree is everything: one row
    return sums.where("id <> 0").join(F.broadcast(total)).select("id", (F.col("n") / F.col("total")).alias("freq"))


def cost_row_sums(tour: DataFrame) -> DataFrame:
    """``metrics.cost_row_sums`` (exact mode) through the tour: ``a, row_sum``.

    Of the categories b that climb to an ancestor m of a (and not to the next one below, c), ``n`` in
    number with depths of sum ``s``, each costs ``depth(b) - depth(m) + 2 (depth(a) - depth(m) + 1)``.  That
    is linear in depth(a), so two sums over the path of a give the whole."""
    own = tour.where("id <> 0").select("*", F.lit(1).cast("long").alias("cnt"), F.col("depth").cast("long").alias("sd"))
    whole = tour.where("id = 0").select("*", F.lit(0).cast("long").alias("cnt"), F.lit(0).cast("long").alias("sd"))
    sub = cut_lineage(subtree_sums(own.unionByName(whole), ["cnt", "sd"]))
    t = tour.join(sub, "id").join(sub.select(F.col("id").alias("parent_id"), F.col("cnt").alias("cnt_m"), F.col("sd").alias("sd_m")),
                                  "parent_id", "left")
    deep, m = F.col("depth") >= 3, F.col("depth") - 1
    n = F.when(deep, F.col("cnt_m") - F.col("cnt")).otherwise(0)
    s = F.when(deep, F.col("sd_m") - F.col("sd")).otherwise(0)
    # the part of the path below the root: the category of depth 2, or an L1 category itself
    second = F.col("depth") == 2
    t = cut_lineage(t.select("id", "parent_id", "depth", "enter", "leave", "cnt", "sd", n.cast("long").alias("y"), (s - 3 * m * n).cast("long").alias("x"),
                             F.when(second, F.col("cnt")).otherwise(0).alias("c2"), F.when(second, F.col("sd")).otherwise(0).alias("s2")))
    sums = cut_lineage(path_sums(t, ["x", "y", "c2", "s2"])).toDF("id", "px", "py", "pc", "ps")
    every = sub.where("id = 0").select(F.col("cnt").alias("cnt_all"), F.col("sd").alias("sd_all"))  # one row
    d = F.col("depth")
    flat = d == 1
    outside_n = F.col("cnt_all") - F.when(flat, F.col("cnt")).otherwise(F.col("pc"))
    outside_s = F.col("sd_all") - F.when(flat, F.col("sd")).otherwise(F.col("ps"))
    total = (F.col("sd") - d * F.col("cnt")) + F.col("px") + 2 * (d + 1) * F.col("py") + outside_s + 2 * d * outside_n
    return t.where("id <> 0").join(sums, "id").join(F.broadcast(every)).select(F.col("id").alias("a"), total.cast("long").alias("row_sum"))
