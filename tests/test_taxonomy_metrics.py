"""Taxonomy tables and taxonomy-aware costs on literal trees (FIXTURES §4.1, §4.2)."""

import math

import pytest
from treeclass.operators import metrics, taxonomy

# A subtree of the reference taxonomy holding every node of the hand-checked cells.
TREE = [(5, 0), (3, 0), (84, 5), (81, 5), (181, 84), (182, 84), (1365, 81), (1307, 3), (1309, 3)]
# (a = label, b = prediction, exact, tree)
CELLS = [(5, 3, 3, 3), (5, 84, 1, 1), (84, 5, 5, 2), (84, 81, 6, 3), (84, 181, 1, 1),
         (181, 84, 4, 2), (181, 182, 5, 3), (181, 5, 7, 4), (181, 1365, 9, 6), (5, 181, 2, 2),
         (181, 1307, 8, 8), (1307, 1309, 6, 3)]


def cat(spark, rows):
    return spark.createDataFrame([(i, p, f"c{i}") for i, p in rows], "id int, parent_id int, name string")


# Every cell cost[a][b] of TREE, row a over the columns in the order of TREE, recorded by hand.
ALL_COSTS = {
    5: (0, 3, 1, 1, 2, 2, 2, 4, 4), 3: (3, 0, 4, 4, 5, 5, 5, 1, 1),
    84: (5, 5, 0, 6, 1, 1, 7, 6, 6), 81: (5, 5, 6, 0, 7, 7, 1, 6, 6),
    181: (7, 7, 4, 8, 0, 5, 9, 8, 8), 182: (7, 7, 4, 8, 5, 0, 9, 8, 8),
    1365: (7, 7, 8, 4, 9, 9, 0, 8, 8), 1307: (5, 5, 6, 6, 7, 7, 7, 0, 6), 1309: (5, 5, 6, 6, 7, 7, 7, 6, 0)}


def test_hand_cells_agree():
    ids = [i for i, _ in TREE]
    for a, b, exact, _ in CELLS:
        assert ALL_COSTS[a][ids.index(b)] == exact


@pytest.mark.parametrize("mode,col", [("exact", 2), ("tree", 3)])
def test_pair_cost_cells(spark, mode, col):
    c = cat(spark, TREE)
    closure = taxonomy.category_closure(c)
    pairs = spark.createDataFrame([(a, b) for a, b, *_ in CELLS], "a int, b int")
    got = {(r.a, r.b): r.cost for r in metrics.pair_cost(pairs, closure, mode).collect()}
    assert got == {(x[0], x[1]): x[col] for x in CELLS}


def test_all_pairs_and_row_sums(spark):
    c = cat(spark, TREE)
    closure = taxonomy.category_closure(c)
    ids = [i for i, _ in TREE]
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids], "a int, b int")
    got = {(r.a, r.b): r.cost for r in metrics.pair_cost(pairs, closure).collect()}
    assert got == {(a, b): cost for a, row in ALL_COSTS.items() for b, cost in zip(ids, row)}
    sums = {r.a: r.row_sum for r in metrics.cost_row_sums(c, closure).collect()}
    assert sums == {a: sum(row) for a, row in ALL_COSTS.items()}


def test_deep_tree_and_cycle(spark):
    chain = cat(spark, [(i, i - 1) for i in range(1, 71)])  # deeper than any fixed cap
    assert taxonomy.category_closure(chain).where("id = 70").count() == 70
    with pytest.raises(ValueError, match="cycle"):
        taxonomy.category_closure(cat(spark, [(1, 2), (2, 3), (3, 1), (9, 0)]))


def test_unknown_categories_are_counted_or_raise(spark):
    closure = taxonomy.category_closure(cat(spark, TREE))
    pred = spark.createDataFrame([(1, 181, 84), (2, 84, 999), (3, 999, 3), (4, 5, None), (5, 1307, 1309)],
                                 "id long, label int, prediction int")
    r = metrics.mean_hier_cost(pred, closure).first()
    assert (r.n, r.n_unknown, r.total_cost, r.mean_cost) == (5, 3, 10, 5.0)
    labels = spark.createDataFrame([(1, 5, 84, 181), (2, 5, 84, 999)], "id long, cat1 int, cat2 int, cat3 int")
    with pytest.raises(Exception, match="unknown category 999"):
        metrics.category_frequency(labels, cat(spark, TREE), closure).collect()


def test_frequency_and_weights_mini_tree(spark):
    mini = [(5, 0), (3, 0), (84, 5), (181, 84), (182, 84)]
    c = cat(spark, mini)
    closure = taxonomy.category_closure(c)
    labels = spark.createDataFrame([(1, 5, 84, 181), (2, 5, 84, 182), (3, 5, 84, None), (4, 3, None, None)],
                                   "id long, cat1 int, cat2 int, cat3 int")
    freq = metrics.category_frequency(labels, c, closure)
    assert {r.id: r.freq for r in freq.collect()} == {5: 0.75, 3: 0.25, 84: 0.75, 181: 0.25, 182: 0.25}
    sums = metrics.cost_row_sums(c, closure)
    assert {r.a: r.row_sum for r in sums.collect()} == {5: 8, 3: 17, 84: 12, 181: 23, 182: 23}
    w = {r.id: r.weight for r in metrics.category_weights(freq, sums, 5).collect()}
    expect = {5: 0.46875, 3: 0.073529, 84: 0.3125, 181: 0.054348, 182: 0.054348}
    for k, v in expect.items():
        assert math.isclose(w[k], v, abs_tol=1e-6)


def test_index_closure_invariants(spark):
    c = cat(spark, TREE)
    ix = taxonomy.category_index(c).collect()
    by_parent = {}
    for r in ix:
        by_parent.setdefault(r.parent_id, []).append((r.id, r.idx))
    for kids in by_parent.values():
        kids.sort()
        assert [i for _, i in kids] == list(range(len(kids)))  # dense 0..K-1 in id order
    cl = taxonomy.category_closure(c)
    depth = {r.id: r.depth for r in taxonomy.category_depth(cl).collect()}
    assert depth == {5: 1, 3: 1, 84: 2, 81: 2, 181: 3, 182: 3, 1365: 3, 1307: 2, 1309: 2}
    assert cl.where("hops = 0").count() == len(TREE)


def test_frequency_parent_dominates_child(spark):
    c = cat(spark, TREE)
    closure = taxonomy.category_closure(c)
    labels = spark.createDataFrame([(1, 5, 84, 181), (2, 5, 81, 1365), (3, 3, 1307, None), (4, 5, None, None)],
                                   "id long, cat1 int, cat2 int, cat3 int")
    f = {r.id: r.freq for r in metrics.category_frequency(labels, c, closure).collect()}
    for child, parent in TREE:
        if parent:
            assert f[parent] >= f[child]


def test_mean_cost_and_accuracy(spark):
    c = cat(spark, TREE)
    closure = taxonomy.category_closure(c)
    pred = spark.createDataFrame([(1, 181, 84), (2, 84, 84), (3, 5, 3), (4, 1307, 1309)],
                                 "id long, label int, prediction int")
    r = metrics.mean_hier_cost(pred, closure).first()
    assert (r.n, r.total_cost) == (4, 4 + 0 + 3 + 6)
    assert math.isclose(r.mean_cost, 13 / 4)
    a = metrics.accuracy(pred).first()
    assert (a.n, a.n_correct) == (4, 1)


def test_multiclass_metrics_by_hand(spark):
    pred = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0)],
                                 "label double, prediction double")
    m = metrics.multiclass_metrics(pred).first()
    # class 0: tp1 fp1 n2 p.5 r.5; class 1: tp2 fp1 n2 p2/3 r1; class 2: tp0 fp0 n1 p0 r0
    assert math.isclose(m.accuracy, 3 / 5)
    assert math.isclose(m.weighted_precision, (0.5 * 2 + 2 / 3 * 2) / 5)
    assert math.isclose(m.weighted_recall, (0.5 * 2 + 1 * 2) / 5)
    f1 = lambda p, r: 0 if p + r == 0 else 2 * p * r / (p + r)
    assert math.isclose(m.weighted_f_measure, (f1(0.5, 0.5) * 2 + f1(2 / 3, 1) * 2) / 5)
    # fpr: c0 1/3, c1 1/3, c2 0/4
    assert math.isclose(m.weighted_false_positive_rate, (1 / 3 * 2 + 1 / 3 * 2) / 5)


def test_selective_accuracy_forms(spark):
    decoded = spark.createDataFrame([(1, 0, 0), (2, 2, 84), (3, 3, 181), (4, 2, 81)],
                                    "id long, depth int, category int")
    truth = spark.createDataFrame([(1, 5, 84, 181), (2, 5, 84, 182), (3, 5, 84, 182), (4, 5, 84, None)],
                                  "id long, cat1 int, cat2 int, cat3 int")
    r = metrics.selective_accuracy(decoded, truth).first()
    assert (r.n_correct, r.n_resolved) == (1, 3)
    empty = metrics.selective_accuracy(decoded.where("depth = 0"), truth).first()
    assert empty.selective_accuracy is None and empty.n_resolved == 0


def test_category_maps_single_and_all_parents(spark):
    labels = spark.createDataFrame([(1, 5, 84, 181), (2, 5, 84, 182), (3, 5, 81, 1365), (4, 3, 1307, None)],
                                   "id long, cat1 int, cat2 int, cat3 int")
    one = {r.id: r.idx for r in taxonomy.category_map_for_parent(labels, 3, parent=84).collect()}
    assert one == {181: 0, 182: 1}
    flat = {r.id: r.idx for r in taxonomy.category_map_for_parent(labels, 2).collect()}
    assert flat == {81: 0, 84: 1, 1307: 2}
    allp = {(r.parent_id, r.id): r.idx for r in taxonomy.category_map_by_parent(labels, 3).collect()}
    assert allp == {(84, 181): 0, (84, 182): 1, (81, 1365): 0}
