"""Reader of linear models saved by ``pyspark.mllib`` (``LogisticRegressionModel.save``).

Public layout of a model folder: ``metadata`` holds one JSON line with ``numFeatures`` and
``numClasses``, ``data`` one parquet row ``weights, intercept, threshold``.  A model of two classes has one
weight per feature and its intercept; a model of K classes has one flat vector, the pivot rows of
classes 1 to K-1 end to end, each with a last slot for its bias when it was fitted with one.

The vectors are unfolded by Spark in the tasks that read them; nothing passes the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: folder names of the reference's models (classes, iterations, regularisation, node).
MODEL_GLOB = "logistic_regression_*"
NODE_PATTERN = r"logistic_regression_[^/_]+_[^/_]+_[^/_]+_(\d+)"

_DATA = ("weights struct<type: tinyint, size: int, indices: array<int>, values: array<double>>, "
         "intercept double, threshold double")
_META = "class string, version string, numFeatures int, numClasses int"


def _node(pattern: str, path: Column) -> Column:
    name = F.regexp_extract(path, pattern, 1)
    return F.when(name != "", name.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("no node id in the model path "), path)).cast("int"))


def read_models(spark: SparkSession, root: str, glob: str = MODEL_GLOB, pattern: str = NODE_PATTERN) -> tuple[DataFrame, DataFrame]:
    """``weights(node, idx, feature, w)`` and ``models(node, num_classes, num_features)`` of all
    model folders ``root/glob``; the first group of ``pattern`` is the node id in a folder's name.
    Intercepts are rows with a NULL feature.  A path without an id, a node that two folders claim or
    weights that do not fit the metadata raise."""
    path = F.col("_metadata.file_path")
    meta = spark.read.schema(_META).json(f"{root}/{glob}/metadata").select(
        _node(pattern, path).alias("node"), F.col("numClasses").alias("num_classes"), F.col("numFeatures").alias("num_features"))
    twice = meta.groupBy("node").count().where("count > 1").first()
    if twice:
        raise ValueError(f"{twice['count']} model folders belong to node {twice.node}")
    v = F.col("weights")
    data = spark.read.schema(_DATA).parquet(f"{root}/{glob}/data").select(
        _node(pattern, path).alias("node"), "intercept", F.coalesce(v["size"], F.size(v["values"])).alias("size"),
        F.arrays_zip(F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1)).alias("p"), v["values"].alias("w")).alias("cells"))
    # a row per model: joining them moves one row each
    rows = data.join(meta, "node").withColumn("rows", F.greatest(F.col("num_classes") - 1, F.lit(1)))
    stride = (F.col("size") / F.col("rows")).cast("int")
    fits = (F.col("size") == stride * F.col("rows")) & (stride.isin(F.col("num_features")) | (stride == F.col("num_features") + 1))
    rows = rows.withColumn("stride", F.when(fits, stride).otherwise(F.raise_error(F.format_string(
        "node %s: %s weights for %s classes of %s features", "node", "size", "num_classes", "num_features")).cast("int")))
    cells = rows.select("node", "num_features", "stride", F.inline("cells")).where("w <> 0").select(
        "node", (F.floor(F.col("p") / F.col("stride")) + 1).cast("int").alias("idx"),
        F.nullif(F.col("p") % F.col("stride"), F.col("num_features")).cast("int").alias("feature"), "w")
    single = rows.where("num_classes = 2 and intercept <> 0").select(
        "node", F.lit(1).alias("idx"), F.lit(None).cast("int").alias("feature"), F.col("intercept").alias("w"))
    return cells.unionByName(single), meta


def with_levels(models: DataFrame, category: DataFrame, closure: DataFrame) -> DataFrame:
    """Adds ``level`` (root 1, a node of depth d has d + 1), as the cascade needs it."""
    from treeclass.operators.taxonomy import categories_level
    depth = categories_level(category, closure).select(F.col("id").alias("node"), (F.col("level") + 1).alias("level"))
    root = models.sparkSession.range(1).select(F.lit(0).alias("node"), F.lit(1).alias("level"))
    return models.join(depth.unionByName(root), "node")
