"""End-to-end flows over files: values, not only counts."""

import os

import pytest

from treeclass.plans import flows
from treeclass.session import Scratch, checkpoint_root, scratch_path
from treeclass.sources import tsv

CATEGORIES = [(1, 0), (2, 0), (11, 1), (12, 1), (21, 2), (22, 2), (111, 11), (112, 11), (121, 12), (122, 12)]
WORDS = {1: "car", 2: "house", 11: "sedan", 12: "truck", 21: "flat", 22: "villa", 111: "red", 112: "blue", 121: "short",
         122: "long"}
PATHS = [(1, 11, 111), (1, 11, 112), (1, 12, 121), (1, 12, 122), (2, 21, None), (2, 22, None), (1, None, None)]


def title(path, i):
    return " ".join([WORDS[p] for p in path if p] * 3 + ["with", f"x{chr(97 + i % 5)}"])


@pytest.fixture(scope="module")
def files(spark):
    d = scratch_path(spark, "flow-files")
    ads = [(i, title(p, i), *p) for i, p in enumerate(PATHS * 12)]
    tsv.write_ads(spark.createDataFrame(ads, "id long, title string, cat1 int, cat2 int, cat3 int"), f"{d}/train")
    test = [(1000 + i, title(p, i)) for i, p in enumerate(PATHS[:6])] + [(2000, ""), (2001, "zzz")]
    tsv.write_test_ads(spark.createDataFrame(test, "id long, title string"), f"{d}/test")
    tsv.write_categories(spark.createDataFrame([(i, p, WORDS[i]) for i, p in CATEGORIES], "id int, parent_id int, name string"),
                         f"{d}/cat")
    tsv.write_stopwords(spark.createDataFrame([("with",)], "orth string"), f"{d}/stop")
    words = {w for _, t, *_ in ads for w in t.split()}
    lexicon = spark.createDataFrame([(w, 1, 300, w) for w in sorted(words)], "orth string, ordinal int, tag_id int, lemma string")
    return d, lexicon


def classify(spark, files, **kw):
    d, lexicon = files
    out = scratch_path(spark, "flow-out")
    rows = flows.classify(spark, f"{d}/train", f"{d}/test", f"{d}/cat", f"{d}/stop", lexicon, out,
                          kw.pop("models", scratch_path(spark, "flow-models")), kw.pop("log", None), num_buckets=512,
                          gates=kw.pop("gates", (0.5, 0.5, 0.5)), **kw)
    return {r.id: r.category for r in rows.collect()}


def test_classify_predicts_the_known_categories(spark, files):
    log = scratch_path(spark, "flow-log")
    got = classify(spark, files, log=log)
    assert {1000 + i: p[2] or p[1] for i, p in enumerate(PATHS[:6])}.items() <= got.items()
    assert set(got) == {1000 + i for i in range(6)} | {2000, 2001}  # the empty and the unknown title keep a row
    rows = tsv.read_metrics(spark, log, "kind string, model string, name string, value double").collect()
    by_name = {r.name: r.value for r in rows if r.kind == "run"}
    # items labelled at the first level only are resolved deeper: one path of seven
    assert by_name["selective_accuracy"] == pytest.approx(6 / 7) and by_name["n_resolved"] == 84
    assert {"accuracy", "weighted_f_measure", "weighted_precision", "weighted_recall", "weighted_true_positive_rate",
            "weighted_false_positive_rate", "train_seconds"} <= by_name.keys()
    per_model = {r.model.rsplit("=", 1)[1]: r.value for r in rows if r.kind == "model"}
    assert per_model.keys() == {"0", "1", "2", "11", "12"} and all(v > 0 for v in per_model.values())


@pytest.mark.parametrize("mode", [{"idf": "refit"}, {"idf": "per_node"}, {"use_idf": False}])
def test_classify_modes(spark, files, mode):
    got = classify(spark, files, **mode)
    assert sum(got[1000 + i] == (p[2] or p[1]) for i, p in enumerate(PATHS[:6])) >= 5


def test_runs_reuse_models_and_leave_no_scratch(spark, files):
    models = scratch_path(spark, "flow-keep")
    first = classify(spark, files, models=models)
    root = checkpoint_root(spark)
    before = set(os.listdir(f"{root.removeprefix('file:')}/treeclass-scratch"))
    assert classify(spark, files, models=models) == first
    new = set(os.listdir(f"{root.removeprefix('file:')}/treeclass-scratch")) - before
    assert {n.split("-")[0] for n in new} <= {"flow"}  # the run's own output only
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("features_")]
    assert len([v for v in os.listdir(models.removeprefix("file:")) if v.startswith("v-")]) == 1


def scratch_folders(spark):
    return set(os.listdir(f"{checkpoint_root(spark).removeprefix('file:')}/treeclass-scratch"))


def test_changed_items_refit_only_the_nodes_on_their_path(spark, files, monkeypatch):
    """The first run trains all nodes and leaves only its output; a run after one item of
    category 111 changed fits the root, 1 and 11 again, the others are taken over."""
    from treeclass.operators import train
    d, lexicon = files
    fitted, fit = [], train.train_hierarchy

    def watched(labels, index, nodes, *args, **kw):
        fitted.append(sorted(r.node for r in nodes.collect()))
        return fit(labels, index, nodes, *args, **kw)
    monkeypatch.setattr(train, "train_hierarchy", watched)
    models, folder = scratch_path(spark, "flow-changed"), scratch_path(spark, "flow-files2")
    ads = tsv.read_ads(spark, f"{d}/train")
    before = scratch_folders(spark)
    for title_of_0 in ("car sedan red with xa", "car sedan red red red"):
        changed = ads.selectExpr("id", f"if(id = 0, '{title_of_0}', title) as title", "cat1", "cat2", "cat3")
        tsv.write_ads(changed, f"{folder}/train")
        flows.classify(spark, f"{folder}/train", f"{d}/test", f"{d}/cat", f"{d}/stop", lexicon, f"{folder}/out", models,
                       num_buckets=512, idf="per_node")
    assert fitted == [[0, 1, 2, 11, 12], [0, 1, 11]]
    new = {n.split("-")[0] for n in scratch_folders(spark) - before}
    assert new <= {"flow"}  # the models and files of this test: no training rows are left
    weights, nodes, *_ = train.load_hierarchy(spark, models)
    assert {r.node for r in nodes.collect()} == {0, 1, 2, 11, 12} == {r.node for r in weights.select("node").distinct().collect()}


def test_unknown_category_or_repeated_id_raises(spark, files):
    d, lexicon = files
    for rows, match in (([(1, "car", 1, 99, None)], "unknown categories"), ([(1, "car", 1, 11, None)] * 2, "repeat")):
        bad = scratch_path(spark, "flow-bad")
        tsv.write_ads(spark.createDataFrame(rows, "id long, title string, cat1 int, cat2 int, cat3 int"), bad)
        with pytest.raises(ValueError, match=match):
            flows.classify(spark, bad, f"{d}/test", f"{d}/cat", f"{d}/stop", lexicon, scratch_path(spark, "o"),
                           scratch_path(spark, "m"), num_buckets=64)


def test_flat_cost_is_small_on_separable_items(spark, files):
    d, lexicon = files
    r = flows.flat_cost(spark, f"{d}/train", f"{d}/cat", f"{d}/stop", lexicon, num_buckets=512).first()
    assert r.n > 10 and r.n_unknown == 0 and r.mean_cost < 1.0


def test_feature_size_guard(spark):
    models = spark.createDataFrame([(0, 512)], "node int, num_features int")
    flows.check_feature_size(models, 512)
    with pytest.raises(ValueError, match="number of features"):
        flows.check_feature_size(models, 1024)


def test_scratch_owner_removes_its_data(spark):
    with Scratch(spark, "own") as s:
        kept, table = s.keep(spark.range(3)), s.bucketed(spark.range(4), "id", "own_table")
        assert (kept.count(), table.count()) == (3, 4)
        root = s.root.removeprefix("file:")
        assert os.path.isdir(root)
    assert not os.path.exists(root)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("own_table")]


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    from treeclass import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session)
