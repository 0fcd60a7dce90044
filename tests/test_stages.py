"""The ``pyspark.ml`` stages: equal to the flow, saved and loaded, columns and ids checked."""

import pytest
from pyspark.ml import Pipeline, PipelineModel

from tests.test_flows import PATHS, classify, files  # noqa: F401  (files: a fixture)
from treeclass.operators.stages import HierarchyClassifier, HierarchyModel, TitleTerms
from treeclass.session import scratch_path
from treeclass.sources import tsv

GATES = [0.5, 0.5, 0.5]


@pytest.fixture(scope="module")
def paths(spark, files):  # noqa: F811
    d, lexicon = files
    lexicon.write.mode("overwrite").parquet(f"{d}/lexicon")
    return d


def title_terms(d, **kw):
    return TitleTerms(lexiconPath=f"{d}/lexicon", stopwordsPath=f"{d}/stop", numBuckets=512, **kw)


@pytest.mark.parametrize("mode", ["fit_once", "per_node"])
def test_fit_save_load_transform_equals_the_flow(spark, files, paths, mode):  # noqa: F811
    d = paths
    steps = Pipeline(stages=[title_terms(d), HierarchyClassifier(categoriesPath=f"{d}/cat", numBuckets=512, gates=GATES, idf=mode)])
    folder = scratch_path(spark, "flow-steps")
    steps.write().save(f"{folder}/unfitted")
    steps = Pipeline.load(f"{folder}/unfitted")  # an unfitted pipeline comes back with its parameters
    model = steps.fit(tsv.read_ads(spark, f"{d}/train"))
    model.write().save(f"{folder}/fitted")
    model.stages[1].release()  # the saved tables are copies
    loaded = PipelineModel.load(f"{folder}/fitted")
    assert loaded.stages[1].uid == model.stages[1].uid and loaded.stages[1].get("gates") == GATES
    test = tsv.read_test_ads(spark, f"{d}/test").select("id", "title", "title")
    test = test.toDF("id", "title", "node")  # a further column, with a name of the operators' own
    out = loaded.transform(test)
    assert out.columns == ["id", "title", "node", "terms", "depth", "category"]
    rows = {r.id: r for r in out.collect()}
    assert {i: r.category for i, r in rows.items()} == classify(spark, files, idf=mode)
    assert {1000 + i: p[2] or p[1] for i, p in enumerate(PATHS[:6])}.items() <= {i: r.category for i, r in rows.items()}.items()
    assert rows[1000].title == rows[1000].node and rows[2000].terms == []
    strict = loaded.stages[1].copy().setGates([1.0, 1.0, 1.0])
    assert {(r.depth, r.category) for r in strict.transform(loaded.stages[0].transform(test)).collect()} == {(0, 0)}


def test_terms_of_null_empty_and_unknown_titles(spark, paths):
    rows = [(1, "car car red"), (2, None), (3, ""), (4, "unheardof"), (5, "with")]
    frame = spark.createDataFrame(rows, "id long, title string")
    got = {r.id: [tuple(t) for t in r.terms] for r in title_terms(paths).transform(frame).collect()}
    assert [len(got[i]) for i in range(1, 6)] == [2, 0, 0, 0, 0] and all(tf == 1 for _, tf in got[1])
    assert got[1] == sorted(got[1])
    assert title_terms(paths).transform(frame.limit(0)).collect() == []


@pytest.mark.parametrize("rows, error", [([(1, "a"), (1, "b")], "repeat"), ([(None, "a")], "no id")])
def test_ids_are_checked(spark, paths, rows, error):
    with pytest.raises(ValueError, match=error):
        title_terms(paths).transform(spark.createDataFrame(rows, "id long, title string"))


def test_columns_are_checked(spark, paths):
    frame = spark.createDataFrame([(1, "car", 5)], "id long, title string, Terms int")
    with pytest.raises(ValueError, match="exist already"):
        title_terms(paths).transform(frame)
    with pytest.raises(ValueError, match="'name' is missing"):
        title_terms(paths, titleCol="name").transform(frame)
    with pytest.raises(TypeError, match="'Terms' is int"):
        HierarchyClassifier(termsCol="Terms", categoriesPath=f"{paths}/cat").fit(frame)


def test_unknown_labels_raise_and_no_rows_leave_items_undecided(spark, paths):
    schema = "id long, title string, cat1 int, cat2 int, cat3 int"
    fit = lambda rows: HierarchyClassifier(categoriesPath=f"{paths}/cat", numBuckets=512, maxIter=1).fit(
        title_terms(paths).transform(spark.createDataFrame(rows, schema)))
    with pytest.raises(ValueError, match="unknown categories"):
        fit([(1, "car", 1, 99, None)])
    model = fit([])
    out = model.transform(title_terms(paths).transform(spark.createDataFrame([(7, "car")], "id long, title string")))
    assert [(r.id, r.depth, r.category) for r in out.collect()] == [(7, 0, 0)]
    folder = scratch_path(spark, "flow-empty")
    model.write().save(folder)
    assert HierarchyModel.load(folder).tables["idf"] is not None
    model.release()
