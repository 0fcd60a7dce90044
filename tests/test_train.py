"""Training: the pivot-form weights score exactly like the fitted model."""

import pytest
from pyspark.sql import functions as F

from treeclass.operators import encode, features, score, taxonomy, train
from treeclass.plans.context import Context
from treeclass.session import scratch_path

BUCKETS = 1024


@pytest.fixture(scope="module")
def trained(spark):
    c = Context(spark, "/root/testdata/sf0.001")
    tf = features.hashing_tf(c.bag, BUCKETS)
    long = features.tfidf(tf, features.idf(tf, c.items.count())).cache()
    vectors = features.tfidf_vectors(c.items, tf, features.idf(tf, c.items.count()), BUCKETS).cache()
    weights, models = train.train_hierarchy(c.labels, c.index, c.models, vectors, BUCKETS, parallelism=4)
    return c, long, vectors, weights.cache(), models.cache()


def test_model_table_structure(trained):
    c, _, _, weights, models = trained
    m = {r.node: r.num_classes for r in models.collect()}
    expect = {r.node: r.num_classes for r in c.models.collect()}
    assert m == expect
    fitted = {r.node for r in weights.select("node").distinct().collect()}
    assert fitted == {n for n, k in m.items() if k >= 2}
    assert weights.where((F.col("idx") < 1) | (F.col("feature") >= BUCKETS)).count() == 0


def test_root_model_beats_majority_and_pivot_scoring_matches(spark, trained):
    c, long, vectors, weights, models = trained
    enc = encode.label_encode(c.labels, c.index)
    data = features.labeled_features(enc, "l1_idx", vectors)
    k = c.category.where("parent_id = 0").count()
    model = train.fit_lr(data.select("label", "features"), k)
    ml_pred = model.transform(data).select("id", "label", "prediction")
    n = ml_pred.count()
    acc = ml_pred.where("label = prediction").count() / n
    majority = data.groupBy("label").count().agg(F.max("count")).first()[0] / n
    assert acc > majority
    w = train.weights_frame(0, model, scratch_path(spark, "t-root"))
    # the exported cells are the model's own rows minus the first
    c0 = model.coefficientMatrix.toArray()
    want = c0[1:] - c0[0]
    for r in w.where("feature % 97 = 3").collect():
        assert abs(want[r.idx - 1, r.feature] - r.w) < 1e-12
    assert w.count() == int((want != 0).sum())
    routes = c.items.select("id", F.lit(0).alias("node"))
    ours = score.linear_predict(routes, long.withColumnRenamed("bucket", "feature"), w)
    j = ml_pred.join(ours.withColumnRenamed("prediction", "pivot"), "id")
    agree = j.where("prediction = pivot").count() / j.count()
    assert agree >= 0.999


def test_binary_and_intercept_models_export(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(float(i % 2), Vectors.sparse(6, [i % 3, 3], [1.0, float(i % 2)])) for i in range(60)]
    data = spark.createDataFrame(rows, ["label", "features"])
    model = train.fit_lr(data, 2, fit_intercept=True)
    w = {r.feature: r.w for r in train.weights_frame(5, model, scratch_path(spark, "t-bin")).collect()}
    assert abs(w.pop(None) - model.intercept) < 1e-12
    assert w == {i: x for i, x in enumerate(model.coefficients.toArray()) if x != 0}


def test_sparse_coefficients_export(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(float(i % 3), Vectors.sparse(5000, [i % 3, 4000 + i % 2], [1.0, 1.0])) for i in range(90)]
    model = train.fit_lr(spark.createDataFrame(rows, ["label", "features"]), 3)
    c = model.coefficientMatrix.toArray()
    want = {(i, j): c[i, j] - c[0, j] for i in (1, 2) for j in range(5000) if c[i, j] != c[0, j]}
    got = {(r.idx, r.feature): r.w for r in train.weights_frame(0, model, scratch_path(spark, "t-sp")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_unknown_labels_raise_at_each_level(spark):
    from treeclass.operators import taxonomy
    index = taxonomy.category_index(spark.createDataFrame(
        [(1, 0, ""), (11, 1, ""), (111, 11, "")], "id int, parent_id int, name string"))
    for bad in ((9, None, None), (1, 99, None), (1, 11, 999)):
        labels = spark.createDataFrame([(1, 1, 11, 111), (2, *bad)], "id long, cat1 int, cat2 int, cat3 int")
        with pytest.raises(ValueError, match="unknown categories"):
            encode.check_labels(labels, index)
        with pytest.raises(Exception, match="unknown category"):
            train.node_training_rows(labels, index).collect()
    repeated = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    with pytest.raises(ValueError, match="repeat"):
        encode.check_unique_ids(repeated)


def test_fit_or_load_follows_the_data(spark, trained, tmp_path):
    c, _, _, weights, models = trained
    path, calls = scratch_path(spark, "t-hier"), []
    data = f"{tmp_path}/in"
    spark.range(5).write.csv(data)

    def load(**settings):
        key = {"data": train.data_fingerprint(spark, [data], [c.stop]), **settings}
        return train.fit_or_load(spark, path, key, lambda: calls.append(1) or (weights, models, c.index))
    load()
    assert load()[0].count() == weights.count() and len(calls) == 1
    load(buckets=2)
    assert len(calls) == 2
    spark.range(6).write.mode("append").csv(data)  # new files under the same path
    load()
    assert len(calls) == 3


def test_incomplete_or_unreadable_storage(spark, trained):
    c, _, _, weights, models = trained
    path = scratch_path(spark, "t-part")
    assert not train.hierarchy_exists(spark, path, {})
    weights.write.parquet(f"{path}/v-half/weights")  # a crash before the meta file
    assert not train.hierarchy_exists(spark, path, {})
    with pytest.raises(FileNotFoundError):
        train.load_hierarchy(spark, path)
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        train.hierarchy_exists(spark, "nosuchstore://x/y", {})


def test_node_idf_and_folded_weights(spark):
    tf = spark.createDataFrame([(1, 5, 2), (1, 6, 1), (2, 5, 1), (3, 6, 4)], "id long, bucket int, tf long")
    rows = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 0), (1, 7), (2, 7)], "id long, node int")  # item 4 has no terms
    idf = features.node_idf(tf, rows)
    import math
    got = {(r.node, r.bucket): (r.df, r.n_docs, round(r.idf, 9)) for r in idf.collect()}
    assert got == {(0, 5): (2, 4, round(math.log(5 / 3), 9)), (0, 6): (2, 4, round(math.log(5 / 3), 9)),
                   (7, 5): (2, 2, 0.0), (7, 6): (1, 2, round(math.log(3 / 2), 9))}
    weights = spark.createDataFrame([(0, 1, 5, 2.0), (7, 1, 6, -1.0), (7, 2, None, 0.5)], "node int, idx int, feature int, w double")
    folded = {(r.node, r.idx, r.feature): round(r.w, 9) for r in features.fold_idf(weights, idf).collect()}
    assert folded == {(0, 1, 5): round(2 * math.log(5 / 3), 9), (7, 1, 6): round(-math.log(3 / 2), 9), (7, 2, None): 0.5}


def test_own_idf_of_a_node_scales_its_training_rows(spark):
    """A node fitted with its IDF and the folded weights decides like the model on scaled vectors."""
    from treeclass.operators import taxonomy
    index = taxonomy.category_index(spark.createDataFrame([(1, 0, ""), (2, 0, "")], "id int, parent_id int, name string"))
    labels = spark.createDataFrame([(i, 1 + i % 2, None, None) for i in range(40)], "id long, cat1 int, cat2 int, cat3 int")
    tf = spark.createDataFrame([(i, b, 1 + b) for i in range(40) for b in ((i % 2), 2 + i % 3)], "id long, bucket int, tf long")
    nodes = spark.createDataFrame([(0, 1, 2, 40)], "node int, level int, num_classes int, n_rows long")
    idf = features.node_idf(tf, encode.node_rows(labels))
    vectors = features.tfidf_vectors(labels.select("id"), tf, None, 8)
    weights, _ = train.train_hierarchy(labels, index, nodes, vectors, 8, idf_by_node=idf)
    folded = features.fold_idf(weights, idf)
    long = tf.select("id", F.col("bucket").alias("feature"), F.col("tf").cast("double").alias("value"))
    routes = labels.select("id", F.lit(0).alias("node"))
    got = {r.id: r.prediction for r in score.linear_predict(routes, long, folded).collect()}
    assert got == {i: float(i % 2) for i in range(40)}


@pytest.mark.parametrize("classes,intercept", [(2, False), (2, True), (4, False), (4, True)])
def test_models_saved_by_mllib_score_the_same(spark, tmp_path, classes, intercept):
    import random

    from pyspark.mllib.classification import LogisticRegressionWithLBFGS
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.regression import LabeledPoint

    from treeclass.sources import mllib
    rnd = random.Random(classes)
    rows = [(i, [(b, float(rnd.randint(1, 3))) for b in sorted({i % classes, 5 + rnd.randrange(7), 12})]) for i in range(120)]
    points = spark.sparkContext.parallelize([LabeledPoint(i % classes, Vectors.sparse(13, v)) for i, v in rows], 2)
    model = LogisticRegressionWithLBFGS.train(points, iterations=10, regParam=0.01, numClasses=classes, intercept=intercept)
    model.save(spark.sparkContext, f"{tmp_path}/logistic_regression_{classes}_10_0.01_17")
    weights, models = mllib.read_models(spark, str(tmp_path))
    assert [tuple(r) for r in models.collect()] == [(17, classes, 13)]
    assert (weights.where("feature is null").count() > 0) == intercept
    long = spark.createDataFrame([(i, b, x) for i, v in rows for b, x in v], "id long, feature int, value double")
    routes = spark.createDataFrame([(i, 17) for i, _ in rows], "id long, node int")
    got = {r.id: r.prediction for r in score.linear_predict(routes, long, weights).collect()}
    assert got == {i: float(model.predict(Vectors.sparse(13, v))) for i, v in rows}


def test_mllib_reader_refuses_what_does_not_fit(spark, tmp_path):
    from pyspark.mllib.classification import LogisticRegressionModel
    from pyspark.mllib.linalg import DenseVector

    from treeclass.sources import mllib
    model = LogisticRegressionModel(DenseVector([1.0, 0.0, -2.0]), 0.5, 3, 2)
    model.save(spark.sparkContext, f"{tmp_path}/a/logistic_regression_2_10_0.01_5")
    w, _ = mllib.read_models(spark, f"{tmp_path}/a")
    assert {tuple(r) for r in w.collect()} == {(5, 1, 0, 1.0), (5, 1, 2, -2.0), (5, 1, None, 0.5)}
    model.save(spark.sparkContext, f"{tmp_path}/a/logistic_regression_2_20_0.01_5")
    with pytest.raises(ValueError, match="node 5"):
        mllib.read_models(spark, f"{tmp_path}/a")
    model.save(spark.sparkContext, f"{tmp_path}/b/logistic_regression_x")
    with pytest.raises(Exception, match="no node id"):
        mllib.read_models(spark, f"{tmp_path}/b")[0].collect()
    spark.read.parquet(f"{tmp_path}/a/logistic_regression_2_10_0.01_5/data").write.parquet(f"{tmp_path}/c/logistic_regression_3_1_1_8/data")
    spark.createDataFrame([("x", "1.0", 4, 3)], "class string, version string, numFeatures int, numClasses int").write.json(
        f"{tmp_path}/c/logistic_regression_3_1_1_8/metadata")
    with pytest.raises(Exception, match="weights for 3 classes"):
        mllib.read_models(spark, f"{tmp_path}/c")[0].collect()


def test_levels_of_loaded_models(spark):
    from treeclass.operators import taxonomy
    from treeclass.sources import mllib
    category = spark.createDataFrame([(1, 0, ""), (11, 1, ""), (111, 11, "")], "id int, parent_id int, name string")
    models = spark.createDataFrame([(0,), (1,), (11,)], "node int")
    levels = mllib.with_levels(models, category, taxonomy.category_closure(category))
    assert {(r.node, r.level) for r in levels.collect()} == {(0, 1), (1, 2), (11, 3)}


def test_vectors_are_written_once_for_all_nodes_of_a_path(spark, monkeypatch):
    """Before: a copy of an item's vector per node, 500 000 rows in one task."""
    labels = spark.createDataFrame([(i, 10 + i % 2, 100 + i % 4, (1000 + i % 8) if i % 3 else None) for i in range(48)] + [(48, None, None, None)],
                                   "id long, cat1 int, cat2 int, cat3 int")
    parents = {10: 0, 11: 0, **{100 + j: 10 + j % 2 for j in range(4)}, **{1000 + j: 100 + j % 4 for j in range(8)}}
    category = spark.createDataFrame([(k, p, "") for k, p in parents.items()], "id int, parent_id int, name string")
    index = taxonomy.category_index(category)
    nodes = [r.node for r in encode.trainable_nodes(labels, category).collect()]
    paths = train.training_paths(labels, index, nodes).collect()
    assert len(paths) == 48
    flat = sorted((r.id, n, r[f"label{level}"]) for r in paths for level, n in ((1, 0), (2, r.node2), (3, r.node3))
                  if r[f"label{level}"] is not None)
    assert flat == sorted((r.id, r.node, r.label) for r in train.node_training_rows(labels, index).collect())
    some = train.training_paths(labels, index, [10, 101]).collect()
    assert {r.node2 for r in some} == {10, None} and {r.node3 for r in some} == {101, None}
    with pytest.raises(Exception, match="unknown category"):
        train.training_paths(labels, index.where("id <> 1003"), nodes).collect()
