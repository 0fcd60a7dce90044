"""End-to-end flows over user files, as a user of the reference runs them.

``classify``: read labelled and unlabelled item TSVs, the taxonomy, the stop
words and a lexicon table → build features → train one model per trainable node
(or reuse a saved hierarchy of the same data and settings) → cascade-predict the
unlabelled items → write ``id \\t category`` → measure selective accuracy on
the labelled items → append metrics.

``flat_cost``: flat classifier over the level-2 categories on a reproducible
60/40 split, scored by mean hierarchical cost.

Text files are converted to columnar tables once; every later step reads those.  All
scratch data belong to the run and are removed when it ends.  Unknown categories and
repeated item ids raise; nothing is dropped.  The only driver-side data are the node
list (one row per trainable taxonomy node) and sizes.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeclass.operators import encode, features, metrics, score, taxonomy, text, train
from treeclass.operators.joins import bounded_by
from treeclass.session import Scratch
from treeclass.sources import tsv

#: fit_once: one IDF of all training items, kept with the models.  per_node: each node's training
#: set has its own IDF, kept with its model, for training and scoring.  refit: the reference's form, an
#: IDF per training set when training, one fitted on the scored items when scoring.
IDF_MODES = ("fit_once", "per_node", "refit")


def term_frequencies(scratch: Scratch, items: DataFrame, lexicon: DataFrame, stop: DataFrame, num_buckets: int,
                     hash_fn: str = "murmur3", lower: bool = False) -> DataFrame:
    """``id, bucket, tf`` of the items' titles, written once."""
    bag = text.process_title(items, lexicon, stop, lower=lower)
    return scratch.keep(features.hashing_tf(bag, num_buckets, hash_fn), "tf")  # read by idf, product, vectors


def build_features(scratch: Scratch, items: DataFrame, lexicon: DataFrame, stop: DataFrame, num_buckets: int,
                   idf_table: DataFrame | None = None, hash_fn: str = "murmur3", lower: bool = False,
                   use_idf: bool = True):
    """Item features bucketed by id: ``(long, idf_table, tf)``; the long table has
    ``id, feature, value`` (feature = bucket).  Without an IDF table one is fitted on
    these items; ``use_idf=False`` keeps plain term frequencies."""
    tf = term_frequencies(scratch, items, lexicon, stop, num_buckets, hash_fn, lower)
    if not use_idf:
        idf_table, long = None, tf.select("id", F.col("bucket").alias("feature"), F.col("tf").cast("double").alias("value"))
    else:
        if idf_table is None:
            idf_table = scratch.keep(features.idf(tf, items.count()), "idf")
        long = features.tfidf(tf, idf_table).select("id", F.col("bucket").alias("feature"), "value")
    return scratch.bucketed(long, "id", "features"), idf_table, tf


def check_feature_size(models: DataFrame, num_buckets: int) -> None:
    """Raise when a model was fitted on another number of features than those scored."""
    other = models.where(F.col("num_features") != num_buckets).count()
    if other:
        raise ValueError(f"{other} models were fitted on another number of features than {num_buckets}")


def classify(spark: SparkSession, training_path: str, test_path: str, categories_path: str,
             stopwords_path: str, lexicon: DataFrame, out_path: str, model_path: str,
             metrics_path: str | None = None, num_buckets: int = features.CASCADE_BUCKETS,
             gates=score.DEFAULT_GATES, emit_level1: bool = False, lower: bool = False,
             idf: str = "fit_once", use_idf: bool = True) -> DataFrame:
    """Returns the decoded predictions of the unlabelled items (also written).

    ``idf``: see ``IDF_MODES``.  ``use_idf=False``: term frequencies only.  When the inputs changed
    since the newest saved hierarchy, only the nodes whose training rows or classes changed are fitted
    again (with ``fit_once`` a changed IDF changes every node).  ``lower`` folds the case of titles before they meet the lexicon and the stop words."""
    if idf not in IDF_MODES:
        raise ValueError(f"idf must be one of {IDF_MODES}")
    with Scratch(spark, "classify") as scratch:
        train_ads = scratch.keep(tsv.read_ads(spark, training_path), "training")
        test_ads = scratch.keep(tsv.read_test_ads(spark, test_path).select("id", "title"), "test")
        category = scratch.keep(tsv.read_categories(spark, categories_path), "category")
        stop = scratch.keep(tsv.read_stopwords(spark, stopwords_path), "stop")
        lexicon = scratch.keep(lexicon, "lexicon")
        index = scratch.keep(taxonomy.category_index(category), "index")
        labels = train_ads.select("id", "cat1", "cat2", "cat3")
        encode.check_unique_ids(train_ads)
        encode.check_unique_ids(test_ads)
        encode.check_labels(labels, index)
        nodes = scratch.keep(encode.trainable_nodes(labels, category), "nodes")
        own_idf = use_idf and idf != "fit_once"  # an IDF per training set
        settings = {"buckets": num_buckets, "iters": train.MAX_ITER, "reg": train.REG_PARAM, "lower": lower,
                    "idf": "none" if not use_idf else "node" if own_idf else "all"}
        fingerprint = {**settings, "data": train.data_fingerprint(
                           spark, [training_path, categories_path, stopwords_path], [lexicon])}

        def fit():
            tf = term_frequencies(scratch, train_ads.select("id", "title"), lexicon, stop, num_buckets, lower=lower)
            idf_table = None
            if own_idf:
                idf_table = scratch.keep(features.node_idf(tf, encode.node_rows(labels)), "node-idf")
            elif use_idf:
                idf_table = scratch.keep(features.idf(tf, train_ads.count()), "idf")
            common = settings if own_idf or not use_idf else {**settings, "table": train.table_hash(idf_table)}
            keys = scratch.keep(train.node_keys(labels, index, tf, common), "keys")

            def fit_nodes(changed):
                vectors = scratch.keep(features.tfidf_vectors(train_ads.select("id"), tf, None if own_idf else idf_table,
                                                              num_buckets), "vectors")
                return train.train_hierarchy(labels, index, changed, vectors, num_buckets, model_dir=scratch.path("models"),
                                             idf_by_node=idf_table if own_idf else None)
            w, m, _ = train.fit_changed_nodes(spark, model_path, keys, nodes, fit_nodes)
            return w, m, index, idf_table

        t0 = time.time()
        weights, models, index, idf_table = train.fit_or_load(spark, model_path, fingerprint, fit)
        train_seconds = time.time() - t0
        check_feature_size(models, num_buckets)
        if use_idf and idf == "per_node":  # the weights carry the IDF, the items' features are term frequencies
            weights = features.fold_idf(weights, idf_table)
        packed = scratch.keep(score.pack_weights(weights), "packed")

        def decode(items):
            feats, _, _ = build_features(scratch, items.select("id", "title"), lexicon, stop, num_buckets,
                                         idf_table if idf == "fit_once" else None, lower=lower,
                                         use_idf=use_idf and idf != "per_node")
            pred = score.cascade_predict(items.select("id"), feats, packed, models, index, gates, keep=scratch.keep)
            return scratch.keep(score.cascade_decode(pred, gates, emit_level1), "decoded")

        tsv.write_predictions(decode(test_ads), out_path)
        if metrics_path:
            _write_run_log(decode(train_ads), labels, models, model_path, train_seconds, metrics_path)
    return tsv.read_predictions(spark, out_path)


def _write_run_log(decoded: DataFrame, labels: DataFrame, models: DataFrame, model_path: str,
                   train_seconds: float, metrics_path: str) -> None:
    """Run log rows ``kind, model, name, value``: the run's seconds and accuracies, the six
    multiclass metrics of the resolved items, and each model's training seconds."""
    sel = metrics.selective_accuracy(decoded, labels)
    truth = encode.deepest_category(labels).withColumnRenamed("category", "label")
    resolved = decoded.where("depth <> 0").join(truth, "id").select(
        F.col("label").cast("double").alias("label"), F.col("category").cast("double").alias("prediction"))
    multi = metrics.multiclass_metrics(resolved)
    run, model = F.lit("run").alias("kind"), F.lit(model_path).alias("model")

    def unfold(df):
        return df.select(run, model, F.inline(F.array(*(
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in df.columns))))
    seconds = decoded.sparkSession.range(1).select(run, model, F.lit("train_seconds").alias("name"),
                                                   F.lit(float(train_seconds)).alias("value"))
    per_model = models.select(F.lit("model").alias("kind"), F.format_string("%s/node=%d", F.lit(model_path), "node").alias("model"),
                              F.lit("train_seconds").alias("name"), F.col("train_seconds").alias("value"))
    rows = seconds.unionByName(unfold(sel)).unionByName(unfold(multi)).unionByName(per_model)
    tsv.write_metrics(rows, metrics_path)


def flat_cost(spark: SparkSession, training_path: str, categories_path: str, stopwords_path: str,
              lexicon: DataFrame, level: int = 2, train_percent: int = 60,
              num_buckets: int = features.FLAT_BUCKETS_BY_LEVEL[1], lower: bool = False) -> DataFrame:
    """Mean hierarchical cost of a flat level-``level`` classifier
    (``n, n_unknown, total_cost, mean_cost``); raises when a category is unknown."""
    with Scratch(spark, "flat") as scratch:
        ads = scratch.keep(tsv.read_ads(spark, training_path), "ads")
        encode.check_unique_ids(ads)
        category = scratch.keep(tsv.read_categories(spark, categories_path), "category")
        closure = taxonomy.category_closure(category)
        stop = scratch.keep(tsv.read_stopwords(spark, stopwords_path), "stop")
        flat_map = scratch.keep(taxonomy.category_map_for_parent(ads, level), "flat-map")
        small = bounded_by(flat_map)
        # title and label stay on their row: the map is joined to it, the texts are not shuffled
        col = f"cat{level}"
        rows = encode.train_test_split(ads.where(F.col(col).isNotNull()), train_percent).join(
            small(flat_map.select(F.col("id").alias(col), F.col("idx").cast("double").alias("label"))), col).select(
            "id", "title", F.col(col).alias("category"), "label", "is_train")
        rows = scratch.keep(rows, "rows")
        tr, te = rows.where("is_train"), rows.where("not is_train")
        # like the reference: the test features get their own IDF
        _, idf_tr, tf_tr = build_features(scratch, tr.select("id", "title"), lexicon, stop, num_buckets, lower=lower)
        f_te, _, _ = build_features(scratch, te.select("id", "title"), lexicon, stop, num_buckets, lower=lower)
        vec_tr = features.tfidf_vectors(tr, tf_tr, idf_tr, num_buckets)
        data = tr.select("id", "label").join(vec_tr, "id")
        model = train.fit_lr(data.select("label", "features"), flat_map.count())
        w = train.weights_frame(0, model, scratch.path("flat-model"))
        pred = score.linear_predict(te.select("id", F.lit(0).alias("node")), f_te, w)
        named = (pred.join(small(flat_map.select(F.col("idx").cast("double").alias("prediction"),
                                                 F.col("id").alias("pred_cat"))), "prediction", "left")
                 .join(te.select("id", F.col("category").alias("label")), "id"))
        cost = metrics.mean_hier_cost(named.select("id", "label", F.col("pred_cat").alias("prediction")), closure)
        r = cost.first()
        if r.n_unknown:
            raise ValueError(f"{r.n_unknown} of {r.n} predictions or labels are not in the taxonomy")
        return spark.createDataFrame([r], cost.schema)
