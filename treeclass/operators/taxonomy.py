"""Taxonomy tables: levels, dense child indexes, closure, children lists.

Input ``category(id INT, parent_id INT, name)``; the root is the implicit id 0.
All tables here are sized by the taxonomy (not by the items), so a window over
one parent or over all categories stays a small, bounded task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeclass.operators.joins import small_side
from treeclass.operators.ordering import dense_index
from treeclass.session import cut_lineage


def level1_categories(category: DataFrame) -> DataFrame:
    """Children of the root (``parent_id = 0``)."""
    return category.where(F.col("parent_id") == 0).select("id")


def category_index(category: DataFrame) -> DataFrame:
    """``parent_id, id, idx`` — dense class index of each child within its parent,
    in id order (the order is stored with every model, so it never drifts)."""
    w = Window.partitionBy("parent_id").orderBy("id")
    return category.select("parent_id", "id",
                           (F.row_number().over(w) - 1).cast("int").alias("idx"))


def category_closure(category: DataFrame) -> DataFrame:
    """``id, anc, hops`` — each category with itself (hops 0) and every proper
    ancestor below the root.  Built level by level with equi-joins of written tables
    (taxonomy-sized); the loop runs once per tree level, stops on an empty frontier and
    raises when a category meets itself."""
    edges = cut_lineage(category.select("id", "parent_id"))
    up_one = small_side(edges.select(F.col("id").alias("anc"), F.col("parent_id").alias("up")))
    closure = edges.select("id", F.col("id").alias("anc"), F.lit(0).alias("hops"))
    frontier = edges.where(F.col("parent_id") != 0).select(
        "id", F.col("parent_id").alias("anc"), F.lit(1).alias("hops"))
    while True:
        frontier = cut_lineage(frontier)
        n, cyclic = frontier.agg(F.count("*"), F.coalesce(F.max(F.col("id") == F.col("anc")), F.lit(False))).first()
        if cyclic:
            raise ValueError("the taxonomy has a cycle")
        if n == 0:
            return cut_lineage(closure)
        closure = closure.unionByName(frontier)
        frontier = (frontier.join(up_one, "anc").where(F.col("up") != 0)
                    .select("id", F.col("up").alias("anc"), (F.col("hops") + 1).alias("hops")))


def category_depth(closure: DataFrame) -> DataFrame:
    """``id, depth`` (L1 = 1)."""
    return closure.groupBy("id").agg((F.max("hops") + 1).cast("int").alias("depth"))


def categories_level(category: DataFrame, closure: DataFrame | None = None) -> DataFrame:
    """``id, parent_id, level``."""
    closure = category_closure(category) if closure is None else closure
    return category.select("id", "parent_id").join(
        category_depth(closure).withColumnRenamed("depth", "level"), "id")


def child_counts(category: DataFrame) -> DataFrame:
    """``node, num_classes`` for every parent, the root included."""
    return (category.groupBy(F.col("parent_id").alias("node"))
            .agg(F.count("*").cast("int").alias("num_classes")))


def level2_children(category: DataFrame) -> DataFrame:
    """Children of every L1 category: ``parent_id, n_children, children``
    (children = sorted ids, comma separated)."""
    l1 = level1_categories(category).withColumnRenamed("id", "parent_id")
    grouped = (category.groupBy("parent_id")
               .agg(F.count("*").cast("int").alias("n_children"),
                    F.sort_array(F.collect_list("id")).alias("ids")))
    return (grouped.join(small_side(l1), "parent_id")
            .select("parent_id", "n_children",
                    F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
                    .alias("children")))


def category_list(category: DataFrame) -> DataFrame:
    """``pos, id`` — the sorted category ids with their global dense position."""
    return dense_index(category.select("id"), ["id"], "pos").select("pos", "id")


def category_map_for_parent(labels: DataFrame, level: int, parent: int = -1) -> DataFrame:
    """Distinct categories seen at ``level`` (1-3) in labelled items → ``id, idx``.

    With ``parent != -1`` only items whose level-``level-1`` category equals
    ``parent`` count.  Indexes are dense in id order.
    """
    col = f"cat{level}"
    rows = labels.where(F.col(col).isNotNull())
    if parent != -1:
        if level < 2:
            raise ValueError("a parent filter needs level >= 2")
        rows = rows.where(F.col(f"cat{level - 1}") == parent)
    seen = rows.select(F.col(col).alias("id")).distinct()
    return dense_index(seen, ["id"])


def category_map_by_parent(labels: DataFrame, level: int) -> DataFrame:
    """For every parent at once: ``parent_id, id, idx`` — the distinct level-``level``
    categories seen under each level-``level-1`` category, dense in id order.
    One job for all parents (a window per parent), not one job per parent."""
    if level < 2:
        raise ValueError("level must be 2 or 3")
    col, up = f"cat{level}", f"cat{level - 1}"
    seen = (labels.where(F.col(col).isNotNull())
            .select(F.col(up).alias("parent_id"), F.col(col).alias("id")).distinct())
    w = Window.partitionBy("parent_id").orderBy("id")
    return seen.select("parent_id", "id", (F.row_number().over(w) - 1).cast("int").alias("idx"))


def dedupe_last(df: DataFrame, key: str | list[str], value: str, order: str) -> DataFrame:
    """Keyed dedupe where the last row (by ``order``) wins: ``key..., value``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))
