"""Model fitting: one multinomial logistic regression per taxonomy node.

``pyspark.ml`` fits symmetric class rows ``C_0..C_{K-1}``; scoring uses the pivot
form ``W_i = C_i - C_0`` (i >= 1), whose margins decide the same class and give
the confidence ``sigmoid(max(0, best margin))``.  A binary model already has one
coefficient row, which is the pivot row of class 1.

Fits are distributed jobs (L-BFGS with tree aggregation inside ``pyspark.ml``);
the driver only loops over the trainable-node list, a taxonomy-sized table,
and launches a few fits at a time.  A fitted model is saved and released at once;
the weights table is unfolded by Spark from the saved models, never on the driver.  The class count of a node is its child
count in the taxonomy, carried as label metadata so that a child without rows
still owns a class.  Single-child nodes have nothing to learn: they are kept
in the model table with no weights (class 0, confidence 0.5).
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeclass.operators.encode import node_rows
from treeclass.operators.joins import small_side
from treeclass.session import Scratch, scratch_path

# Solver settings of the reference (10 L-BFGS iterations, L2 0.01,
# no intercept).
MAX_ITER = 10
REG_PARAM = 0.01

#: Labelled rows a training file may hold: larger groups of items are dealt over more files (and tasks:
#: 20 000 rows of a few hundred terms are some 50 MB).
ROWS_PER_FILE = 20_000

WEIGHTS_SCHEMA = "node int, idx int, feature int, w double"
MODELS_SCHEMA = "node int, level int, num_classes int, num_features int, train_seconds double"

# Layout of a saved model's data (the public format of ``pyspark.ml``), read as plain structs.
_MATRIX = ("struct<type: tinyint, numRows: int, numCols: int, colPtrs: array<int>, rowIndices: array<int>, "
           "values: array<double>, isTransposed: boolean>")
_VECTOR = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
SAVED_SCHEMA = f"coefficientMatrix {_MATRIX}, interceptVector {_VECTOR}, node int"


def with_class_count(df: DataFrame, num_classes: int) -> DataFrame:
    """Tag ``label`` as nominal with ``num_classes`` values (honoured by the fit)."""
    meta = {"ml_attr": {"type": "nominal", "num_vals": int(num_classes)}}
    return df.withColumn("label", F.col("label").alias("label", metadata=meta))


def fit_lr(labeled: DataFrame, num_classes: int, max_iter: int = MAX_ITER,
           reg_param: float = REG_PARAM, fit_intercept: bool = False) -> LogisticRegressionModel:
    lr = LogisticRegression(maxIter=max_iter, regParam=reg_param, fitIntercept=fit_intercept,
                            standardization=True, family="auto", tol=1e-6)
    return lr.fit(with_class_count(labeled, num_classes))


def saved_weights(spark: SparkSession, path: str) -> DataFrame:
    """Non-zero pivot weights ``node, idx, feature, w`` of the models saved as
    ``path/node=N``; a NULL feature marks an intercept.

    Coefficients are unfolded in the tasks that read the saved models (one row per
    model): dense matrices by position, sparse ones by their pointer arrays."""
    m = F.col("coefficientMatrix")
    saved = spark.read.schema(SAVED_SCHEMA).option("basePath", path).parquet(f"{path}/node=*/data")
    rows = saved.select("node", m["numRows"].alias("rows"), m["numCols"].alias("cols"),
                        F.coalesce(m["isTransposed"], F.lit(False)).alias("by_row"), m["colPtrs"].alias("ptrs"),
                        m["rowIndices"].alias("inner"), m["values"].alias("values"), (m["type"] == 0).alias("sparse"))
    # "major" runs along the storage order: columns, or rows when the matrix is transposed
    dense = rows.where(~F.col("sparse")).select("node", "rows", "cols", "by_row", F.posexplode("values").alias("p", "c"))
    width = F.when(F.col("by_row"), F.col("cols")).otherwise(F.col("rows"))
    dense = dense.select("node", "rows", "by_row", F.floor(F.col("p") / width).cast("int").alias("major"),
                         (F.col("p") % width).alias("minor"), "c")
    start, end = F.element_at("ptrs", F.col("major") + 1), F.element_at("ptrs", F.col("major") + 2)
    sparse = rows.where("sparse").select(
        "node", "rows", "by_row", "ptrs", "inner", "values",
        F.explode(F.sequence(F.lit(0), F.size("ptrs") - 2)).alias("major")).where(end > start).select(
        "node", "rows", "by_row", "major", F.inline(F.arrays_zip(
            F.slice("inner", start + 1, end - start).alias("minor"), F.slice("values", start + 1, end - start).alias("c"))))
    cells = dense.unionByName(sparse).select(
        "node", "rows", F.when(F.col("by_row"), F.col("major")).otherwise(F.col("minor")).alias("cls"),
        F.when(F.col("by_row"), F.col("minor")).otherwise(F.col("major")).alias("feature"), "c")
    b = F.col("interceptVector")
    dense_b = F.transform(b["values"], lambda v, i: F.struct(
        F.when(b["indices"].isNull(), i).otherwise(F.element_at(b["indices"], i + 1)).alias("cls"), v.alias("c")))
    intercepts = saved.select("node", m["numRows"].alias("rows"), F.inline(dense_b)).where("c <> 0").select(
        "node", "rows", "cls", F.lit(None).cast("int").alias("feature"), "c")
    return pivot(cells.where("c <> 0").unionByName(intercepts))


def pivot(cells: DataFrame) -> DataFrame:
    """``node, idx, feature, w`` from coefficient cells ``node, rows, cls, feature, c``:
    ``W_i = C_i - C_0``.  A binary model already has the pivot row of class 1."""
    grouped = cells.groupBy("node", "rows", "feature").agg(F.collect_list(F.struct("cls", "c")).alias("cs"))
    zero = F.coalesce(F.get(F.filter("cs", lambda x: x["cls"] == 0), F.lit(0))["c"], F.lit(0.0))
    by_class = F.transform(F.sequence(F.lit(1), F.col("rows") - 1), lambda i: F.struct(
        i.alias("idx"), (F.coalesce(F.get(F.filter("cs", lambda x: x["cls"] == i), F.lit(0))["c"], F.lit(0.0))
                         - F.col("zero")).alias("w")))
    one = F.array(F.struct(F.lit(1).alias("idx"), F.col("zero").alias("w")))
    return (grouped.withColumn("zero", zero)
            .withColumn("ws", F.when(F.col("rows") == 1, one).otherwise(by_class))
            .select("node", "feature", F.inline("ws")).where("w <> 0")
            .select("node", "idx", "feature", "w"))


def weights_frame(node: int, model: LogisticRegressionModel, folder: str) -> DataFrame:
    """Pivot weights of one fitted model, through its saved form in ``folder``."""
    spark = SparkSession.getActiveSession()
    model.write().overwrite().save(f"{folder}/node={node}")
    return saved_weights(spark, folder)


def node_training_rows(labels: DataFrame, index: DataFrame) -> DataFrame:
    """``id, node, level, label`` — the class index of each item at each node.  A label
    that is not in the index raises: no training row is dropped."""
    ix = small_side(index.select(F.col("parent_id").alias("node"), F.col("id").alias("category"),
                                 "idx"))
    missing = F.raise_error(F.format_string("unknown category %s under node %s", "category", "node"))
    return (node_rows(labels).join(ix, ["node", "category"], "left")
            .select("id", "node", "level", F.coalesce("idx", missing.cast("int")).cast("double").alias("label")))


def training_paths(labels: DataFrame, index: DataFrame, nodes: list[int]) -> DataFrame:
    """``id, label1, label2, label3, node2, node3`` — the class index of each item at the root and at the
    level-1 and level-2 nodes of its path, NULL where that is none of ``nodes``.  One row per label row, so
    an item's vector is stored once for all its nodes.  A label that is not in the index raises."""
    ix = small_side(index.where(F.col("parent_id").isin(nodes)))
    out, columns = labels, []
    for level, node in enumerate((F.lit(0), F.col("cat1"), F.col("cat2")), 1):
        category = F.col(f"cat{level}")
        own = ix.select(F.col("parent_id").alias(f"_n{level}"), F.col("id").alias(f"_c{level}"), F.col("idx").alias(f"_i{level}"))
        out = out.join(own, (node == F.col(f"_n{level}")) & (category == F.col(f"_c{level}")), "left")
        missing = F.raise_error(F.format_string("unknown category %s under node %s", category, node)).cast("int")
        columns.append(F.when(category.isNotNull() & node.isin(nodes), F.coalesce(f"_i{level}", missing))
                       .cast("double").alias(f"label{level}"))
    return (out.select("id", "cat1", "cat2", *columns).where("coalesce(label1, label2, label3) is not null")
            .select("id", "label1", "label2", "label3", F.when(F.col("label2").isNotNull(), F.col("cat1")).alias("node2"),
                    F.when(F.col("label3").isNotNull(), F.col("cat2")).alias("node3")))


def scaled(data: DataFrame, idf_table: DataFrame, num_features: int) -> DataFrame:
    """Labelled term-frequency vectors times one IDF (at most ``num_features`` values)."""
    scale = [0.0] * num_features
    for r in idf_table.select("bucket", "idf").collect():
        scale[int(r["bucket"])] = float(r["idf"])
    prod = ElementwiseProduct(scalingVec=DenseVector(scale), inputCol="features", outputCol="scaled")
    return prod.transform(data).select("label", F.col("scaled").alias("features"))


def train_hierarchy(labels: DataFrame, index: DataFrame, nodes: DataFrame, vectors: DataFrame,
                    num_features: int, max_iter: int = MAX_ITER, reg_param: float = REG_PARAM,
                    parallelism: int = 8, model_dir: str | None = None, fit_intercept: bool = False,
                    idf_by_node: DataFrame | None = None):
    """Fit every node of ``nodes(node, level, num_classes, n_rows)``.

    The labelled vectors are written once, each with its labels at all nodes of its path
    (``training_paths``), as a table partitioned by the level-1 and level-2 node in the shared folder,
    so each fit reads only the partitions of its node.  Rows are dealt by (partition, salt) with
    ``rows / ROWS_PER_FILE`` salts: a large partition spreads over many tasks and files, a small
    one is a single file.  Returns ``(weights, models)``; the fitted models stay saved as
    ``{model_dir}/node={node}`` (a scratch folder by default).  The labelled vectors are removed
    when the fits end.

    ``idf_by_node`` (``features.node_idf``): ``vectors`` are term frequencies then, and each node's
    are scaled by its own IDF (``num_features`` values per node, on the JVM) before its fit.
    """
    spark = labels.sparkSession
    todo = [(int(r["node"]), int(r["level"]), int(r["num_classes"]))
            for r in nodes.select("node", "level", "num_classes").collect()]
    fit_nodes = [n for n, _, k in todo if k >= 2]
    model_dir = model_dir or scratch_path(spark, "models")
    owner = Scratch(spark, "node-training")
    written = []

    def run(task):
        node, level, k = task
        if k < 2:
            return node, level, k, num_features, 0.0
        t0 = time.time()
        own = F.lit(True) if level == 1 else F.col(f"node{level}") == node
        data = written[0].where(own & F.col(f"label{level}").isNotNull()).select(F.col(f"label{level}").alias("label"), "features")
        if idf_by_node is not None:
            data = scaled(data, idf_by_node.where(F.col("node") == node), num_features)
        fit_lr(data, k, max_iter, reg_param, fit_intercept).write().overwrite().save(f"{model_dir}/node={node}")
        return node, level, k, num_features, time.time() - t0

    with owner:
        if fit_nodes:
            rows = training_paths(labels, index, fit_nodes)
            salts = rows.groupBy(F.col("node2").alias("_n2"), F.col("node3").alias("_n3")).agg(
                F.ceil(F.count("*") / ROWS_PER_FILE).cast("int").alias("salts"))
            salted = (rows.join(small_side(salts), F.col("node2").eqNullSafe(F.col("_n2")) & F.col("node3").eqNullSafe(F.col("_n3")))
                      .withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts"))))
            path = owner.path("rows")
            dealt = (salted.join(vectors, "id").select("label1", "label2", "label3", "features", "node2", "node3", "salt")
                     .repartition("node2", "node3", "salt").drop("salt"))
            dealt.write.partitionBy("node2", "node3").parquet(path)
            written.append(spark.read.schema(dealt.schema).parquet(path))
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = list(pool.map(run, todo))
    weights = saved_weights(spark, model_dir) if fit_nodes else spark.createDataFrame([], WEIGHTS_SCHEMA)
    return weights, spark.createDataFrame(fitted, MODELS_SCHEMA)


# --- saved hierarchies ---------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists; an unreachable or unknown store raises."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def data_fingerprint(spark: SparkSession, paths: list[str], tables: list[DataFrame]) -> str:
    """Hash of the input files (path, size, modification time) and of the rows of tables."""
    files = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p).select(
        F.xxhash64("path", "length", F.col("modificationTime").cast("long")).alias("h")) for p in paths]
    return "|".join([_hash_of(f) for f in files] + [table_hash(t) for t in tables])


def _hash_of(hashes: DataFrame) -> str:
    r = hashes.agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h")).first()
    return f"{r[0]}:{r[1]}:{r[2]}"


def table_hash(table: DataFrame) -> str:
    """Hash of a table's rows in any order."""
    return _hash_of(table.select(F.xxhash64(*table.columns).alias("h")))


def _published(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(folder, fingerprint) of the complete hierarchies below ``path``, newest first."""
    if not path_exists(spark, path):
        return []
    fs, p = _fs(spark, path)
    found = [s for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("v-")]
    out = []
    for s in sorted(found, key=lambda s: -s.getModificationTime()):
        folder = s.getPath().toString()
        if path_exists(spark, f"{folder}/meta/_SUCCESS"):  # written last: without it the folder is incomplete
            out.append((folder, spark.read.json(f"{folder}/meta").first()["fingerprint"]))
    return out


def save_hierarchy(weights: DataFrame, models: DataFrame, index: DataFrame, path: str,
                   fingerprint: dict | None = None, idf: DataFrame | None = None) -> str:
    """Weights, model table, class index and IDF together in a fresh folder below ``path``,
    so a reload can never pair a model with another index or IDF.  The meta file is written
    last and publishes the folder; a crash before leaves the older ones in force."""
    folder = f"{path}/v-{uuid.uuid4().hex}"
    weights.write.parquet(f"{folder}/weights")
    models.write.parquet(f"{folder}/models")
    index.write.parquet(f"{folder}/index")
    if idf is not None:
        idf.write.parquet(f"{folder}/idf")
    meta = json.dumps(fingerprint or {}, sort_keys=True)
    weights.sparkSession.createDataFrame([(meta,)], "fingerprint string").write.json(f"{folder}/meta")
    return folder


def load_hierarchy(spark: SparkSession, path: str, fingerprint: dict | None = None):
    """``weights, models, index, idf`` (idf None when not saved) of the newest complete
    hierarchy, or of the newest with that fingerprint."""
    want = None if fingerprint is None else json.dumps(fingerprint, sort_keys=True)
    for folder, got in _published(spark, path):
        if want is None or got == want:
            idf = spark.read.parquet(f"{folder}/idf") if path_exists(spark, f"{folder}/idf") else None
            return (*(spark.read.parquet(f"{folder}/{t}") for t in ("weights", "models", "index")), idf)
    raise FileNotFoundError(f"no complete hierarchy for this fingerprint in {path}")


def hierarchy_exists(spark: SparkSession, path: str, fingerprint: dict | None = None) -> bool:
    """Only a missing path or fingerprint means absent; any storage error is raised."""
    want = json.dumps(fingerprint or {}, sort_keys=True)
    return any(got == want for _, got in _published(spark, path))


# --- nodes that changed -----------------------------------------------------------------------------

def node_keys(labels: DataFrame, index: DataFrame, tf: DataFrame, settings: dict) -> DataFrame:
    """``node, key`` — what a node's model depends on: its training rows (class and term
    frequencies of each item), its classes and the settings.

    An item's terms become one hash (order-free sums and xors), a node's items another, so the keys
    come from one aggregation per item and one per node, and partial results merge in any order.
    The caller puts everything global into ``settings``."""
    h = F.xxhash64("bucket", "tf")
    terms = tf.groupBy("id").agg(F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x"))
    row = F.xxhash64("label", "s", "x")
    rows = node_training_rows(labels, index).join(terms, "id", "left").groupBy("node").agg(
        F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x"))
    child = F.xxhash64("id", "idx")
    classes = index.groupBy(F.col("parent_id").alias("node")).agg(F.sum(child.cast("decimal(38,0)")).alias("c"))
    key = F.concat_ws("|", "n", "s", "x", "c", F.lit(json.dumps(settings, sort_keys=True)))
    return rows.join(small_side(classes), "node").select("node", key.alias("key"))


def stored_nodes(spark: SparkSession, path: str, keys: DataFrame):
    """``weights, models`` of the newest complete hierarchy below ``path``, reduced to the nodes
    whose key is still the same; None when there is no such hierarchy."""
    for folder, _ in _published(spark, path)[:1]:
        models = spark.read.parquet(f"{folder}/models")
        if "key" in models.columns:
            same = models.join(small_side(keys), ["node", "key"], "left_semi")
            return spark.read.parquet(f"{folder}/weights").join(small_side(same.select("node")), "node", "left_semi"), same
    return None


def fit_changed_nodes(spark: SparkSession, path: str, keys: DataFrame, nodes: DataFrame, train_fn):
    """``weights, models, fitted`` for every node of ``nodes``: nodes that the newest complete
    hierarchy below ``path`` holds with the same key are taken from it, the others are fitted by
    ``train_fn(nodes)`` (``weights, models``), and ``fitted`` lists them.  Nothing is published
    here: ``save_hierarchy`` writes the mixed result, so a crash before leaves the old one in force."""
    old = stored_nodes(spark, path, keys)
    todo = nodes if old is None else nodes.join(small_side(old[1].select("node")), "node", "left_anti")
    fitted = sorted(r.node for r in todo.select("node").collect())
    keyed = lambda models: models.join(small_side(keys), "node")
    if old is None:
        weights, models = train_fn(nodes)
        return weights, keyed(models), fitted
    kept = old[1].join(small_side(nodes.select("node")), "node", "left_semi")
    if not fitted:
        return old[0].join(small_side(kept.select("node")), "node", "left_semi"), kept, fitted
    weights, models = train_fn(nodes.where(F.col("node").isin(fitted)))
    columns = [c for c in kept.columns if c in [*models.columns, "key"]]
    return (old[0].join(small_side(kept.select("node")), "node", "left_semi").unionByName(weights),
            kept.select(*columns).unionByName(keyed(models).select(*columns)), fitted)


def fit_or_load(spark: SparkSession, path: str, fingerprint: dict, train_fn):
    """``weights, models, index, idf``; trains only when ``path`` holds no complete hierarchy
    with this fingerprint.  The caller puts everything that changes results into it: see
    ``data_fingerprint`` for files and tables, next to bucket count and solver settings.
    ``train_fn`` returns ``weights, models, index`` or these and the IDF."""
    if not hierarchy_exists(spark, path, fingerprint):
        weights, models, index, *idf = train_fn()
        save_hierarchy(weights, models, index, path, fingerprint, *idf)
    return load_hierarchy(spark, path, fingerprint)
