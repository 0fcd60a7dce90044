"""``pyspark.ml`` stages, so that titles, models and the cascade run in a ``Pipeline``.

* ``TitleTerms`` (Transformer): title -> array of ``(bucket, tf)``, the hashed term
  frequencies of the title's lemmas.
* ``HierarchyClassifier`` (Estimator): these terms and the three label columns -> one model per
  trainable node.
* ``HierarchyModel`` (Model): terms -> depth and category of the confidence-gated cascade.

The stages are wrappers in the Spark sense only: all work is that of ``operators.text``,
``features``, ``train`` and ``score``.  Terms stay a plain array of structs, so they are unfolded on
the JVM; dense vectors are never formed for scoring.

Rows: each input row gives one output row with all its columns; ids are the join key, so a null
or repeated id raises, as does an output column that already exists or an input column that is
missing or of another type.  A null or empty title has no terms and is scored as an item without
features.  Tables without rows give no rows; a fit without labelled rows gives a model without nodes,
which leaves every item undecided (depth 0, category 0).

Persistence: parameters as JSON, tables as Parquet, the metadata last, so that a save that was cut
short cannot be loaded.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeclass.operators import encode, features, score, taxonomy, text, train
from treeclass.session import Scratch
from treeclass.sources import tsv

TERMS_TYPE = "array<struct<bucket:int,tf:bigint>>"
INTEGERS = ("tinyint", "smallint", "int", "bigint")


def check_columns(dataset: DataFrame, wanted: dict[str, tuple[str, ...]], new: tuple[str, ...] = ()) -> None:
    """Raise when a wanted column is missing or of none of its types, or a new one exists."""
    types = {f.name: f.dataType.simpleString() for f in dataset.schema.fields}
    for name, allowed in wanted.items():
        if name not in types:
            raise ValueError(f"column {name!r} is missing; there are {sorted(types)}")
        if allowed and types[name] not in allowed:
            raise TypeError(f"column {name!r} is {types[name]}, not {' or '.join(allowed)}")
    taken = sorted({n.lower() for n in new} & {n.lower() for n in types})
    if taken:
        raise ValueError(f"output columns {taken} exist already")


def check_ids(items: DataFrame) -> None:
    """Raise on null and on repeated ids."""
    if items.where("id is null").limit(1).count():
        raise ValueError("an item has no id")
    encode.check_unique_ids(items)


class _Stage(Params):
    idCol = Param(Params._dummy(), "idCol", "column of the item id, unique", TypeConverters.toString)
    termsCol = Param(Params._dummy(), "termsCol", "column of the terms (bucket, tf)", TypeConverters.toString)
    numBuckets = Param(Params._dummy(), "numBuckets", "number of term buckets", TypeConverters.toInt)

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))


class TitleTerms(_Stage, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``termsCol``: the hashed term frequencies of ``titleCol``, ordered by bucket.

    ``lexiconPath``: the lexicon as Parquet; ``stopwordsPath``: one word per line (empty: none)."""

    titleCol = Param(Params._dummy(), "titleCol", "column of the title", TypeConverters.toString)
    lexiconPath = Param(Params._dummy(), "lexiconPath", "folder of the lexicon table", TypeConverters.toString)
    stopwordsPath = Param(Params._dummy(), "stopwordsPath", "file of the stop words", TypeConverters.toString)
    lower = Param(Params._dummy(), "lower", "fold the case of titles", TypeConverters.toBoolean)
    hashFunction = Param(Params._dummy(), "hashFunction", "murmur3 or md5", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, idCol="id", titleCol="title", termsCol="terms", lexiconPath=None, stopwordsPath=None,
                 numBuckets=features.CASCADE_BUCKETS, lower=False, hashFunction="murmur3"):
        super().__init__()
        self._setDefault(idCol="id", titleCol="title", termsCol="terms", stopwordsPath="", lower=False,
                         numBuckets=features.CASCADE_BUCKETS, hashFunction="murmur3")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, key, terms = dataset.sparkSession, self.get("idCol"), self.get("termsCol")
        check_columns(dataset, {key: (), self.get("titleCol"): ("string",)}, (terms,))
        items = dataset.select(F.col(key).alias("id"), F.col(self.get("titleCol")).alias("title"))
        check_ids(items.select("id"))
        stop = self.get("stopwordsPath")
        stop = tsv.read_stopwords(spark, stop) if stop else spark.createDataFrame([], "orth string")
        bag = text.process_title(items, spark.read.parquet(self.get("lexiconPath")), stop, lower=self.get("lower"))
        tf = features.hashing_tf(bag, self.get("numBuckets"), self.get("hashFunction"))
        # an item's terms are bounded by its own title
        found = tf.groupBy(F.col("id").alias(key)).agg(F.sort_array(F.collect_list(F.struct("bucket", "tf"))).alias(terms))
        return dataset.join(found, key, "left").select(
            *dataset.columns, F.coalesce(terms, F.array()).cast(TERMS_TYPE).alias(terms))


class _Cascade(_Stage):
    gates = Param(Params._dummy(), "gates", "confidences to descend and to decide", TypeConverters.toListFloat)
    emitLevel1 = Param(Params._dummy(), "emitLevel1", "decide at level 1 where no deeper model exists", TypeConverters.toBoolean)
    depthCol = Param(Params._dummy(), "depthCol", "output column of the depth", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "output column of the category", TypeConverters.toString)
    marginDigits = Param(Params._dummy(), "marginDigits", "digits that margins are rounded to; below 0: not rounded",
                         TypeConverters.toInt)

    def _cascade_defaults(self) -> None:
        self._setDefault(idCol="id", termsCol="terms", numBuckets=features.CASCADE_BUCKETS, gates=list(score.DEFAULT_GATES),
                         emitLevel1=False, depthCol="depth", predictionCol="category", marginDigits=-1)


class HierarchyClassifier(_Cascade, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits one model per trainable node of the taxonomy at ``categoriesPath``.

    ``idf``: ``fit_once`` (one of all items), ``per_node`` (of each training set, folded into the
    weights) or ``none``.  A label that the taxonomy lacks raises."""

    labelCols = Param(Params._dummy(), "labelCols", "columns of the three levels' categories", TypeConverters.toListString)
    categoriesPath = Param(Params._dummy(), "categoriesPath", "file of the taxonomy", TypeConverters.toString)
    idf = Param(Params._dummy(), "idf", "fit_once, per_node or none", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "iterations of a fit", TypeConverters.toInt)
    regParam = Param(Params._dummy(), "regParam", "L2 penalty", TypeConverters.toFloat)
    parallelism = Param(Params._dummy(), "parallelism", "fits at a time", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, idCol="id", termsCol="terms", labelCols=("cat1", "cat2", "cat3"), categoriesPath=None,
                 numBuckets=features.CASCADE_BUCKETS, idf="fit_once", maxIter=train.MAX_ITER, regParam=train.REG_PARAM,
                 parallelism=8, gates=score.DEFAULT_GATES, emitLevel1=False, depthCol="depth", predictionCol="category"):
        super().__init__()
        self._cascade_defaults()
        self._setDefault(labelCols=["cat1", "cat2", "cat3"], idf="fit_once", maxIter=train.MAX_ITER, regParam=train.REG_PARAM,
                         parallelism=8)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> HierarchyModel:
        spark, mode, n = dataset.sparkSession, self.get("idf"), self.get("numBuckets")
        key, terms, levels = self.get("idCol"), self.get("termsCol"), self.get("labelCols")
        if mode not in ("fit_once", "per_node", "none"):
            raise ValueError(f"idf must be fit_once, per_node or none, not {mode!r}")
        if len(levels) != 3:
            raise ValueError("labelCols must name three columns")
        check_columns(dataset, {key: (), terms: (TERMS_TYPE,), **dict.fromkeys(levels, INTEGERS)})
        with Scratch(spark, "hierarchy-fit") as scratch:
            rows = scratch.keep(dataset.select(F.col(key).alias("id"), F.col(terms).alias("terms"), *(
                F.col(c).cast("int").alias(f"cat{i}") for i, c in enumerate(levels, 1))), "rows")
            check_ids(rows.select("id"))
            labels = rows.select("id", "cat1", "cat2", "cat3")
            category = scratch.keep(tsv.read_categories(spark, self.get("categoriesPath")), "category")
            index = scratch.keep(taxonomy.category_index(category), "index")
            encode.check_labels(labels, index)
            nodes = scratch.keep(encode.trainable_nodes(labels, category), "nodes")
            tf = scratch.keep(rows.select("id", F.inline("terms")), "tf")
            idf = None
            if mode == "fit_once":
                idf = scratch.keep(features.idf(tf, rows.count()), "idf")
            elif mode == "per_node":
                idf = scratch.keep(features.node_idf(tf, encode.node_rows(labels)), "idf")
            once = idf if mode == "fit_once" else None
            vectors = scratch.keep(features.tfidf_vectors(rows.select("id"), tf, once, n), "vectors")
            weights, models = train.train_hierarchy(
                labels, index, nodes, vectors, n, self.get("maxIter"), self.get("regParam"), self.get("parallelism"),
                scratch.path("models"), idf_by_node=idf if mode == "per_node" else None)
            if mode == "per_node":
                weights = features.fold_idf(weights, idf)
            # the model owns its tables: they outlive the fit's scratch data
            owner = Scratch(spark, "hierarchy-model")
            kept = {name: owner.keep(t, name) for name, t in (
                ("weights", score.pack_weights(weights)), ("models", models), ("index", index), ("idf", once)) if t is not None}
        model = HierarchyModel(**kept)
        model.owner = owner
        return self._copyValues(model)


class HierarchyModel(_Cascade, Model, MLReadable, MLWritable):
    """The cascade over fitted tables; adds ``depthCol`` and ``predictionCol`` (category 0: undecided).

    ``weights`` (long or packed), ``models``, ``index`` and, if terms are to be scaled, ``idf``.
    ``transform`` stores the terms as a table bucketed by id and the first two levels (checkpoints that
    Spark removes when the result is no longer used).  ``release`` removes the stored terms, whose
    results must be written before, and the tables of a fitted model that was not loaded from a folder."""

    def __init__(self, weights: DataFrame | None = None, models: DataFrame | None = None, index: DataFrame | None = None,
                 idf: DataFrame | None = None):
        super().__init__()
        self._cascade_defaults()
        self.owner: Scratch | None = None
        self.stored: list[Scratch] = []
        self.tables = {"weights": weights, "models": models, "index": index, "idf": idf}

    def setGates(self, gates) -> HierarchyModel:
        return self._set(gates=list(gates))

    def release(self) -> None:
        if self.owner is not None:
            self.owner.close()
            self.owner = None
        while self.stored:
            self.stored.pop().close()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, terms, t = self.get("idCol"), self.get("termsCol"), self.tables
        depth, category, digits = self.get("depthCol"), self.get("predictionCol"), self.get("marginDigits")
        check_columns(dataset, {key: (), terms: ()}, (depth, category))
        if "num_features" in t["models"].columns:
            other = t["models"].where(F.col("num_features") != self.get("numBuckets")).count()
            if other:
                raise ValueError(f"{other} models were fitted on another number of buckets than {self.get('numBuckets')}")
        items = dataset.select(F.col(key).alias("id"), F.col(terms).alias("terms"))
        self.stored.append(Scratch(dataset.sparkSession, "hierarchy-terms"))
        items = self.stored[-1].bucketed(items, "id", "terms")
        check_ids(items.select("id"))
        long = items.select("id", F.inline("terms"))
        if t["idf"] is not None:
            long = features.tfidf(long, t["idf"])
            long = long.select("id", F.col("bucket").alias("feature"), "value")
        else:
            long = long.select("id", F.col("bucket").alias("feature"), F.col("tf").cast("double").alias("value"))
        gates = tuple(self.get("gates"))
        pred = score.cascade_predict(items.select("id"), long, score.pack_weights(t["weights"]), t["models"], t["index"], gates,
                                     margin_digits=None if digits < 0 else digits)
        decided = score.cascade_decode(pred, gates, self.get("emitLevel1")).select(
            F.col("id").alias(key), F.col("depth").alias(depth), F.col("category").alias(category))
        return dataset.join(decided, key, "left").select(*dataset.columns, depth, category)

    def write(self) -> MLWriter:
        return _HierarchyWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _HierarchyReader()


class _HierarchyWriter(MLWriter):
    def __init__(self, instance: HierarchyModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        tables = {name: t for name, t in self.instance.tables.items() if t is not None}
        for name, t in tables.items():
            (score.pack_weights(t) if name == "weights" else t).write.parquet(f"{path}/{name}")
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"tables": sorted(tables)})


class _HierarchyReader(MLReader):
    def load(self, path: str) -> HierarchyModel:
        spark: SparkSession = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark, f"{HierarchyModel.__module__}.{HierarchyModel.__name__}")
        model = HierarchyModel(**{name: spark.read.parquet(f"{path}/{name}") for name in metadata["tables"]})
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
