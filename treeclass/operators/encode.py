"""Label encoding and training-subset selection on item label tables.

``labels`` = ``id, cat1, cat2, cat3`` with NULL for absent levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.functions.hashing import md5_hash
from treeclass.operators.joins import small_side
from treeclass.operators.taxonomy import child_counts


def label_encode(labels: DataFrame, index: DataFrame, on_unknown: str = "error") -> DataFrame:
    """Replace each present level by its dense in-parent index, absent → -1.

    ``index`` = ``category_index`` (``parent_id, id, idx``), broadcast behind a
    size check.  An id that is not a child of the level above raises
    (``on_unknown='error'``) or drops the row (``'drop'``).
    """
    ix = small_side(index)
    out = labels
    parents = {1: F.lit(0), 2: F.col("cat1"), 3: F.col("cat2")}
    for lvl in (1, 2, 3):
        x = ix.select(F.col("parent_id").alias(f"_p{lvl}"), F.col("id").alias(f"_c{lvl}"),
                      F.col("idx").alias(f"_i{lvl}"))
        out = out.join(x, (F.col(f"cat{lvl}") == F.col(f"_c{lvl}"))
                       & (parents[lvl] == F.col(f"_p{lvl}")), "left")
    cols = []
    checks = []
    for lvl in (1, 2, 3):
        present = F.col(f"cat{lvl}").isNotNull()
        unknown = present & F.col(f"_i{lvl}").isNull()
        checks.append(unknown)
        if on_unknown == "error":
            val = F.when(unknown, F.raise_error(F.format_string(
                "unknown category %s at level %d", F.col(f"cat{lvl}"), F.lit(lvl))))
            cols.append(F.coalesce(val.cast("int"), F.col(f"_i{lvl}"), F.lit(-1)).alias(f"l{lvl}_idx"))
        else:
            cols.append(F.coalesce(F.col(f"_i{lvl}"), F.lit(-1)).alias(f"l{lvl}_idx"))
    if on_unknown == "drop":
        out = out.where(~(checks[0] | checks[1] | checks[2]))
    elif on_unknown != "error":
        raise ValueError("on_unknown must be 'error' or 'drop'")
    return out.select("id", "cat1", "cat2", "cat3", *cols)


def flat_label(labels: DataFrame, flat_map: DataFrame, level: int = 2) -> DataFrame:
    """Items with ``level`` present, labelled by the flat map: ``id, category, label``."""
    col = f"cat{level}"
    m = small_side(flat_map.select(F.col("id").alias(col), "idx"))
    return (labels.where(F.col(col).isNotNull()).join(m, col)
            .select("id", F.col(col).alias("category"), F.col("idx").cast("double").alias("label")))


def deepest_category(labels: DataFrame) -> DataFrame:
    """``id, category`` = the deepest present level of each item."""
    return labels.select("id", F.coalesce("cat3", "cat2", "cat1").alias("category"))


def node_rows(labels: DataFrame) -> DataFrame:
    """Training rows per taxonomy node: ``id, node, level, category``.

    The root trains on every item with an L1 category, an L1 node on its items
    that carry an L2 category, an L2 node on its items that carry an L3 one.
    """
    # one scan of the labels: a row gives up to three node rows
    levels = F.array(
        F.struct(F.lit(0).alias("node"), F.lit(1).alias("level"), F.col("cat1").alias("category")),
        F.struct(F.col("cat1").alias("node"), F.lit(2).alias("level"), F.col("cat2").alias("category")),
        F.struct(F.col("cat2").alias("node"), F.lit(3).alias("level"), F.col("cat3").alias("category")))
    return labels.select("id", F.inline(levels)).where(F.col("category").isNotNull())


def unknown_labels(labels: DataFrame, index: DataFrame) -> DataFrame:
    """One row ``n_rows, unknown1, unknown2, unknown3``: label rows, and per level the labels
    that are no child of the level above.  Nothing is dropped or cut short."""
    seen = node_rows(labels).groupBy("node", "level", "category").agg(F.count("*").alias("n"))
    ix = index.select(F.col("parent_id").alias("node"), F.col("id").alias("category"), "idx")
    found = seen.join(small_side(ix), ["node", "category"], "left")
    bad = F.col("idx").isNull()
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), *(
        F.coalesce(F.sum(F.when(bad & (F.col("level") == lv), F.col("n"))), F.lit(0)).alias(f"unknown{lv}")
        for lv in (1, 2, 3)))


def check_labels(labels: DataFrame, index: DataFrame) -> None:
    """Raise when a label at any level is not in the class index."""
    r = unknown_labels(labels, index).first()
    if r.unknown1 or r.unknown2 or r.unknown3:
        raise ValueError(f"unknown categories: {r.unknown1} at level 1, {r.unknown2} at level 2, "
                         f"{r.unknown3} at level 3, of {r.n_rows} labels")


def check_unique_ids(items: DataFrame) -> None:
    """Raise when an id occurs twice: ids are the join key of every later step."""
    r = items.groupBy("id").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("extra")).first()
    if r.extra:
        raise ValueError(f"{r.extra} rows repeat an item id")


def node_training_set(labels: DataFrame) -> DataFrame:
    """``node, level, n_rows`` — one aggregation for every node at once
    (partial aggregation keeps a hot node cheap before the shuffle)."""
    return (node_rows(labels).groupBy("node", "level")
            .agg(F.count("*").alias("n_rows")))


def trainable_nodes(labels: DataFrame, category: DataFrame) -> DataFrame:
    """Nodes that get a model: children in the taxonomy and at least one row.
    ``node, level, num_classes, n_rows``."""
    return (node_training_set(labels).join(small_side(child_counts(category)), "node")
            .where((F.col("num_classes") > 0) & (F.col("n_rows") > 0))
            .select("node", "level", "num_classes", "n_rows"))


def train_test_split(df: DataFrame, train_percent: int = 60, key: str = "id") -> DataFrame:
    """Adds ``is_train``: a reproducible split on a hash of the key (md5 bucket
    below ``train_percent`` of 100); it does not depend on partitioning."""
    return df.withColumn("is_train", (md5_hash(key) % 100) < train_percent)


def random_split(df: DataFrame, weights=(0.6, 0.4), seed: int = 44):
    """The seed-based split; the assignment depends on the input partitioning."""
    return df.randomSplit(list(weights), seed)
