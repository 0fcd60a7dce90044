"""Linear scoring and the gated cascade (FIXTURES §4.3, §4.4)."""

import math

from pyspark.sql import functions as F

from treeclass.operators import score


def df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


W_SCHEMA = "node int, idx int, feature string, w double"
F_SCHEMA = "id long, feature string, value double"


def test_linear_score_k3(spark):
    weights = df(spark, [(0, 1, "a", 1.0), (0, 1, "b", -0.5), (0, 2, "a", 0.2), (0, 2, "b", 2.0),
                         (0, 1, "t", 0.5), (0, 2, "t", 0.5)], W_SCHEMA)
    feats = df(spark, [(1, "a", 1.0), (2, "b", 1.0), (4, "zzz", 1.0), (5, "t", 1.0)], F_SCHEMA)
    routes = df(spark, [(i, 0) for i in (1, 2, 3, 4, 5)], "id long, node int")
    got = {r.id: (r.idx, r.confidence) for r in score.score_routes(routes, feats, weights).collect()}
    assert got[1][0] == 1 and math.isclose(got[1][1], 0.731059, abs_tol=1e-6)
    assert got[2][0] == 2 and math.isclose(got[2][1], 0.880797, abs_tol=1e-6)
    assert got[3] == (0, 0.5) and got[4] == (0, 0.5)  # empty bag / unknown term
    assert got[5][0] == 1  # tie: lowest class index wins
    rm = {r.id: (r.idx, r.confidence) for r in score.linear_score_runmax(routes, feats, weights).collect()}
    assert rm[1] == (1, 0.5) and rm[3] == (0, 0.0)


def logit(p):
    return math.log(p / (1 - p))


def test_gate_table(spark):
    # root → {1, 2, 3}; 2 → {21, 22, 23}; 22 → {221, 222}; models at 0, 2, 22 only
    cats = [(1, 0), (2, 0), (3, 0), (21, 2), (22, 2), (23, 2), (221, 22), (222, 22)]
    from treeclass.operators.taxonomy import category_index
    index = category_index(spark.createDataFrame([(i, p, "") for i, p in cats],
                                                 "id int, parent_id int, name string"))
    models = df(spark, [(0, 1), (2, 2), (22, 3)], "node int, level int")
    w = [
        (0, 1, "fa", -1.0),                         # a: L1 conf 0.5 → depth 0
        (0, 2, "fb", logit(0.75)),                  # b: L1 0.75 → 3, no model → depth 0
        (0, 1, "fc", logit(0.75)), (2, 1, "fc", logit(0.6)),           # c: L2 0.6 → depth 2 (22)
        (0, 1, "fd", logit(0.75)), (2, 2, "fd", logit(0.85)),          # d: L2 → 23, no L3 model
        (0, 1, "fe", logit(0.75)), (2, 1, "fe", logit(0.85)), (22, 1, "fe", -3.0),  # e: L3 0.5
        (0, 1, "ff", logit(0.75)), (2, 1, "ff", logit(0.85)), (22, 1, "ff", logit(0.95)),  # f: depth 3
    ]
    weights = df(spark, w, W_SCHEMA)
    feats = df(spark, [(i, f"f{c}", 1.0) for i, c in enumerate("abcdef")], F_SCHEMA)
    items = df(spark, [(i,) for i in range(6)], "id long")
    pred = score.cascade_predict(items, feats, weights, models, index)
    dec = {r.id: (r.depth, r.category) for r in score.cascade_decode(pred).collect()}
    assert dec == {0: (0, 0), 1: (0, 0), 2: (2, 22), 3: (2, 23), 4: (2, 22), 5: (3, 222)}
    fixed = {r.id: (r.depth, r.category) for r in score.cascade_decode(pred, emit_level1=True).collect()}
    assert fixed[1] == (1, 3) and fixed[0] == (0, 0)


def test_gate_bounds_inclusive(spark):
    pred = df(spark, [(1, 1, 0.7, 2, 0.8, 3, 0.9), (2, 1, 0.7, 2, 0.8, 3, 0.8999999)],
              "id long, cat1_pred int, conf1 double, cat2_pred int, conf2 double, cat3_pred int, conf3 double")
    dec = {r.id: (r.depth, r.category) for r in score.cascade_decode(pred).collect()}
    assert dec == {1: (3, 3), 2: (2, 2)}


def test_cascade_is_one_row_per_item(spark):
    import __spark_entry__ as e
    out = e.entry(spark)
    assert out.columns == ["id", "depth", "category"]
    n_items = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert out.count() == n_items == out.select("id").distinct().count()
    assert out.where(~F.col("depth").isin(0, 2, 3)).count() == 0


def test_materialised_levels_do_not_change_results(spark):
    from treeclass.plans.context import Context
    c = Context(spark, "/root/testdata/sf0.001")
    args = (c.items, c.features, c.weights, c.models, c.index)
    a = score.cascade_predict(*args, margin_digits=6)
    b = score.cascade_predict(*args, margin_digits=6, keep=None)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_no_item_disappears_without_a_root_model(spark):
    from treeclass.operators.taxonomy import category_index
    index = category_index(spark.createDataFrame([(1, 0, ""), (2, 0, "")], "id int, parent_id int, name string"))
    models = df(spark, [(2, 2)], "node int, level int")
    items = df(spark, [(i,) for i in range(3)], "id long")
    feats, weights = df(spark, [(0, "a", 1.0)], F_SCHEMA), df(spark, [(2, 1, "a", 1.0)], W_SCHEMA)
    out = score.cascade_decode(score.cascade_predict(items, feats, weights, models, index))
    assert sorted(map(tuple, out.collect())) == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]


def test_intercepts_and_packed_weights(spark):
    weights = df(spark, [(0, 1, "a", 1.0), (0, 2, "a", 0.2), (0, 1, None, -2.0), (0, 2, None, 0.5), (7, 1, None, 9.0)], W_SCHEMA)
    feats = df(spark, [(1, "a", 3.0), (2, "b", 1.0)], F_SCHEMA)
    routes = df(spark, [(1, 0), (2, 0), (3, 0)], "id long, node int")
    want = {1: (2, 1.1), 2: (2, 0.5), 3: (2, 0.5)}
    for w in (weights, score.pack_weights(weights)):
        for broadcast in (None, False):
            got = {r.id: (r.idx, round(r.margin, 6)) for r in score.score_routes(
                routes, feats, w, broadcast_weights=broadcast).collect()}
            assert got == want


def test_vector_margins_equal_a_sum_per_class(spark):
    """A node with 150 classes (three blocks), one with 3, intercepts, repeated cells, negative values, ties."""
    import random
    rnd = random.Random(4)
    rows = [(0, rnd.randint(1, 149), f"f{rnd.randint(0, 30)}", rnd.choice([-1.0, -0.5, 0.5, 1.0])) for _ in range(1500)]
    rows += [(1, rnd.randint(1, 2), f"f{rnd.randint(0, 30)}", rnd.choice([-1.0, 1.0])) for _ in range(60)]
    rows += [(0, 70, None, 0.25), (0, 140, None, 0.25), (1, 2, None, -0.5)]
    values = {(i, f"f{rnd.randint(0, 30)}"): rnd.choice([-2.0, 1.0, 3.0]) for i in range(40) for _ in range(6)}
    want = {}
    for i in range(42):  # two items without features
        for node in (0, 1):
            margin = {}
            for n, idx, f, w in rows:
                if n == node and (f is None or (i, f) in values):
                    margin[idx] = margin.get(idx, 0.0) + w * (1.0 if f is None else values[i, f])
            top = max(margin.values(), default=0.0)
            want[i, node] = (min(k for k, m in margin.items() if m == top), top) if top > 0 else (0, 0.0)
    weights = df(spark, rows, W_SCHEMA)
    feats = df(spark, [(i, f, v) for (i, f), v in values.items()], F_SCHEMA)
    routes = df(spark, list(want), "id long, node int")
    for w in (weights, score.pack_weights(weights)):
        for broadcast in (None, False):
            got = {(r.id, r.node): (r.idx, r.margin) for r in score.score_routes(routes, feats, w, broadcast_weights=broadcast).collect()}
            assert got == want


def test_weights_are_those_of_each_category_and_term(spark, tmp_path):
    import hashlib

    from treeclass.operators import encode
    from treeclass.plans.context import Context
    docs = [(1, "alpha beta common", "de", "src1"), (2, "alpha gamma common", "en", "src2"), (3, "delta common", "en", "src18"),
            (3, "omega common", "es", "src4"), (None, "nobody common", "es", "src5"), (4, None, "fr", "src6"), (5, "beta common", "en", "src5")]
    df(spark, [(*d, len(d[1] or "")) for d in docs], "doc_id long, text string, lang string, source string, n_chars int").write.parquet(
        f"{tmp_path}/documents.parquet")
    df(spark, [(1, 1, 0), (2, 0, 0), (2, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    c = Context(spark, str(tmp_path))
    cats = {(r.id, r.category) for r in encode.node_rows(c.labels).collect()}
    index = {r.id: (r.parent_id, r.idx) for r in c.index.collect() if r.idx > 0}
    want = {(*index[cat], b.term, (int(hashlib.md5(f"{cat}:{b.term}".encode()).hexdigest()[:8], 16) % 2001 - 1000) / 1000)
            for b in c.bag.collect() for i, cat in cats if i is not None and i == b.id and cat in index}
    got = [tuple(r) for r in c.weights.select("node", "idx", "feature", "w").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 5
    packed = lambda f: sorted((r.node, r.feature, r.block, tuple(r.ws)) for r in f.collect())
    alone = packed(c.root_packed)  # packed without the other nodes
    assert "packed" not in c.__dict__ and alone and alone == packed(c.packed.where("node = 0"))
