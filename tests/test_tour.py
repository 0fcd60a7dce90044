"""The interval index against path walks: a chain of thousands, a bush, one flat parent, bad input."""

import random

import pytest
from pyspark.sql import functions as F

from treeclass.operators import metrics, ordering, taxonomy, tour

SCHEMA = "id int, parent_id int, name string"


def frame(spark, parents):
    return spark.createDataFrame([(i, p, "") for i, p in parents.items()], SCHEMA).repartition(3)


def path(parents, i):
    out = [i]
    while out[-1]:
        out.append(parents[out[-1]])
    return out  # up to the root, included


def cost_by_hand(parents, a, b, mode):
    """Climb from b to the first node on the path of a; its place there counts twice."""
    up, depth = path(parents, a), len(path(parents, a)) - 1
    if mode == "tree":
        place = {n: i for i, n in enumerate(up)}
    else:
        place = {0: depth, **{up[k]: k + 1 for k in range(1, depth - 1)}, a: 0}
    for hops, n in enumerate(path(parents, b)):
        if n in place:
            return hops + 2 * place[n]


def bush(n, seed):
    rnd = random.Random(seed)
    ids = rnd.sample(range(1, 10 * n), n)
    parents = {}
    for i in ids:
        parents[i] = rnd.choice([0, *list(parents)[-30:], *list(parents)[:3]])
    return parents


def test_tour_and_costs_of_a_bush(spark):
    parents = bush(120, 5)
    category = frame(spark, parents)
    walk = tour.category_tour(category)
    rows = {r.id: r for r in walk.collect()}
    assert len(rows) == 121 and sorted([r.enter for r in rows.values()] + [r.leave for r in rows.values()]) == list(range(242))
    for i in parents:
        assert rows[i].depth == len(path(parents, i)) - 1
        for j in parents:
            assert (i in path(parents, j)) == (rows[i].enter <= rows[j].enter and rows[j].leave <= rows[i].leave)
    pairs = spark.createDataFrame([(a, b) for a in parents for b in list(parents)[::3]] * 2, "a int, b int")
    for mode in ("exact", "tree"):
        got = {(r.a, r.b): r.cost for r in tour.pair_cost(pairs, walk, mode).collect()}
        assert got == {(a, b): cost_by_hand(parents, a, b, mode) for a in parents for b in list(parents)[::3]}
    sums = {r.a: r.row_sum for r in tour.cost_row_sums(walk).collect()}
    assert sums == {a: sum(cost_by_hand(parents, a, b, "exact") for b in parents) for a in parents}
    closure = taxonomy.category_closure(category)
    assert sums == {r.a: r.row_sum for r in metrics.cost_row_sums(category, closure).collect()}


def test_a_chain_of_5000_categories(spark):
    n = 5000
    parents = {i: i - 1 for i in range(1, n + 1)}
    category = frame(spark, parents)
    walk = tour.category_tour(category)
    assert {(r.id, r.depth, r.enter, r.leave) for r in walk.collect()} == {(i, i, i, 2 * n + 1 - i) for i in range(n + 1)}
    labels = spark.createDataFrame([(1, 1, None, None), (2, 1, n, None), (3, 1, 2, 4000)], "id long, cat1 int, cat2 int, cat3 int")
    freq = {r.id: r.freq for r in tour.category_frequency(labels, walk).collect()}
    assert (freq[1], freq[2], freq[4000], freq[4001], freq[n]) == (1.0, 2 / 3, 2 / 3, 1 / 3, 1 / 3)
    want = [(a, b, cost_by_hand(parents, a, b, "exact")) for a, b in [(1, n), (n, 1), (n, n), (2500, 17), (17, 2500), (2, 1), (1, 2), (3, 1)]]
    got = tour.pair_cost(spark.createDataFrame([w[:2] for w in want], "a int, b int"), walk)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    sums = {r.a: r.row_sum for r in tour.cost_row_sums(walk).collect()}
    for a in (1, 2, 3, 2500, n):
        # b below a costs b - a; b from 2 to a - 1 is on the path, 1 climbs to the root
        assert sums[a] == sum((b - a) if b >= a else 2 * (a - b + 1) if b >= 2 else 1 + 2 * a for b in range(1, n + 1))


def test_flat_and_empty_taxonomies(spark):
    flat = {i: 0 for i in range(1, 300)}
    rows = tour.category_tour(frame(spark, flat)).where("id <> 0").collect()
    assert {(r.id, r.enter, r.leave) for r in rows} == {(i, 2 * i - 1, 2 * i) for i in flat}
    empty = tour.category_tour(spark.createDataFrame([], SCHEMA))
    assert [tuple(r) for r in empty.collect()] == [(0, None, 0, 0, 1)]


def test_cycles_orphans_and_unknown_labels_raise(spark):
    with pytest.raises(ValueError, match="cycle"):
        tour.category_tour(frame(spark, {1: 0, 2: 3, 3: 2}))
    with pytest.raises(ValueError, match="not in the taxonomy"):
        tour.category_tour(frame(spark, {1: 0, 2: 9}))
    walk = tour.category_tour(frame(spark, {1: 0}))
    with pytest.raises(Exception, match="unknown category"):
        tour.category_frequency(spark.createDataFrame([(1, 5, None, None)], "id long, cat1 int, cat2 int, cat3 int"), walk).collect()


def test_dense_index_has_no_window_over_everything(spark):
    ids = spark.range(500).select((F.col("id") * 7 % 499).alias("id")).distinct()
    out = ordering.dense_index(ids, ["id"])
    assert [(r.id, r.idx) for r in out.orderBy("id").collect()] == [(i, i) for i in range(499)]
    category = spark.createDataFrame([(i, 0, "") for i in range(50)], SCHEMA)
    for df in (out, taxonomy.category_list(category)):
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
    sums = ordering.running_sums(spark.range(100).select("id", (-F.col("id")).alias("v"), F.lit(2).alias("w")), ["id"], ["v", "w"])
    assert [(r.v_before, r.w_before) for r in sums.orderBy("id").collect()] == [(-i * (i - 1) // 2, 2 * i) for i in range(100)]
