"""The salted (non-broadcast) join path gives the same results as the broadcast one."""

from pyspark.sql import functions as F

from treeclass.operators import joins, score, text
from treeclass.plans.context import Context

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lookup_join_salted_equals_broadcast(spark):
    # a hot key holding most rows, plus a key without a match
    big = spark.createDataFrame([(i, "hot" if i % 4 else f"k{i % 7}") for i in range(400)],
                                "id long, k string")
    small = spark.createDataFrame([("hot", 1), ("k0", 2), ("k4", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = joins.lookup_join(big, small, ["k"], how, broadcast=True)
        b = joins.lookup_join(big, small, ["k"], how, broadcast=False)
        assert rows(a) == rows(b), how
    plan = joins.lookup_join(big, small, ["k"], broadcast=False)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


def test_text_and_cascade_without_broadcast(spark):
    c = Context(spark, SF)
    items, lexicon, stop = c.items, c.lexicon, c.stop
    want_bag = rows(text.process_title(items, lexicon, stop))
    want_tok = rows(text.remove_stopwords(text.tag_filter(text.annotate_tokens(items, lexicon)), stop))
    want_cas = rows(score.cascade_predict(c.items, c.features, c.weights, c.models, c.index, margin_digits=6))
    spark.conf.set("treeclass.broadcastMaxRows", "0")
    spark.conf.set("treeclass.skewSalts", "5")
    try:
        assert rows(text.process_title(items, lexicon, stop)) == want_bag
        got_tok = text.remove_stopwords(text.tag_filter(text.annotate_tokens(items, lexicon)), stop)
        assert rows(got_tok) == want_tok
        got_cas = score.cascade_predict(c.items, c.features, c.weights, c.models, c.index, margin_digits=6)
        assert rows(got_cas) == want_cas
    finally:
        spark.conf.unset("treeclass.broadcastMaxRows")
        spark.conf.unset("treeclass.skewSalts")


def test_frequent_join_equals_broadcast(spark):
    # a hot key, keys without a match, null keys, a key with two lookup rows; items that repeat
    big = spark.createDataFrame([(i % 300, None if i % 11 == 0 else "hot" if i % 4 else f"k{i % 7}") for i in range(400)],
                                "id long, k string")
    small = spark.createDataFrame([("hot", 1), ("k0", 2), ("k0", 5), ("k4", 3), (None, 4)], "k string, v int")
    for how in ("inner", "left"):
        want = sorted(map(str, joins.frequent_join(big, small, ["k"], how, broadcast=True).collect()))
        for keys in (0, 1, 2, 1000):
            got = joins.frequent_join(big, small, ["k"], how, broadcast=False, max_keys=keys)
            assert sorted(map(str, got.collect())) == want, (how, keys)
    assert [r.k for r in joins.frequent_keys(big, ["k"], 1).collect()] == ["hot"]


def test_joins_of_large_lookups_hold_one_copy(spark):
    """The lookup side is not copied per salt: its shuffled rows are those of the table."""
    c = Context(spark, SF)
    spark.conf.set("treeclass.broadcastMaxRows", "0")
    try:
        bag = text.process_title(c.items, c.lexicon, c.stop)
        tokens = text.annotate_tokens(c.items, c.lexicon)
        scores = score.class_margins(c.features, c.items.selectExpr("id", "0 as node"), c.packed, broadcast_weights=False)
        for frame in (bag, tokens, scores):
            assert "_salt" not in frame._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("treeclass.broadcastMaxRows")
