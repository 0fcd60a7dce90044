"""Title processing, hashing and IDF (FIXTURES §4.5 and the analyser semantics)."""

import math

from pyspark.sql import functions as F

from treeclass.functions.text import tag_is_dropped
from treeclass.operators import features, text


def lex(spark, rows):
    return spark.createDataFrame(rows, "orth string, ordinal int, tag_id int, lemma string")


def test_murmur_buckets_match_reference_hashing(spark):
    words = ["samochód", "abc", "dom", "żółty", "opel"]
    bag = spark.createDataFrame([(1, w) for w in words], "id long, term string")
    got = {r.bucket for r in features.hashing_tf(bag, 30720).collect()}
    assert got == {14019, 2996, 17002, 23171, 1580}


def test_idf_example(spark):
    bag = spark.createDataFrame([(1, "abc"), (1, "dom"), (2, "abc"), (3, "opel")], "id long, term string")
    tf = features.hashing_tf(bag, 30720)
    got = {r.bucket: r.idf for r in features.idf(tf, 3).collect()}
    b = {r.term: r.b for r in bag.select("term", F.pmod(F.hash("term"), F.lit(30720)).alias("b")).collect()}
    assert math.isclose(got[b["abc"]], math.log(4 / 3), abs_tol=1e-6)
    assert math.isclose(got[b["dom"]], math.log(2), abs_tol=1e-6)


def test_empty_bag_counts_in_idf_and_gets_empty_vector(spark):
    items = spark.createDataFrame([(1, "x"), (2, "y"), (3, "")], "id long, title string")
    bag = spark.createDataFrame([(1, "abc"), (2, "abc")], "id long, term string")
    tf = features.hashing_tf(bag, 16)
    idf_t = features.idf(tf, 3)
    assert math.isclose(idf_t.first().idf, math.log(4 / 3))
    vec = {r.id: r.features for r in features.tfidf_vectors(items, tf, idf_t, 16).collect()}
    assert vec[3].numNonzeros() == 0 and vec[3].size == 16
    assert vec[1].numNonzeros() == 1
    plain = {r.id: r.features for r in features.tfidf_vectors(items, tf, None, 16).collect()}
    assert list(plain[1].values) == [1.0] and plain[3].numNonzeros() == 0


def test_tag_filter_ids_and_ranges(spark):
    df = spark.createDataFrame([(t,) for t in [0, 97, 98, 300, 429, 461, 508, 509, 573, 577, 578, 591,
                                               592, 594, 598, 599, 705, 723, 724, 800, 801]], "t int")
    dropped = {r.t for r in df.where(tag_is_dropped("t")).collect()}
    assert dropped == {0, 97, 429, 461, 508, 573, 578, 591, 592, 594, 598, 705, 723, 800, 801}


def test_first_surviving_analysis_and_surface_forms(spark):
    items = spark.createDataFrame([(1, "qui voit les Chats, qui"), (2, "zzzzzzzzzzzzzz With with")],
                                  "id long, title string")
    lexicon = lex(spark, [("qui", 1, 592, "qui"), ("qui", 2, 301, "qui:alt"), ("voit", 1, 300, "voir:v"),
                          ("les", 1, 581, "le"), ("Chats", 1, 300, "Chat:s2"), ("with", 1, 300, "with"),
                          ("With", 1, 300, "With")])
    stop = spark.createDataFrame([("with",)], "orth string")
    toks = text.annotate_tokens(items, lexicon)
    assert toks.where("orth = 'zzzzzzzzzzzzzz'").first().tag_id == 0  # unknown word → tag 0
    chain = text.bag_from_first_lemmas(text.first_lemma(
        text.remove_stopwords(text.tag_filter(toks), stop)))
    fast = text.process_title(items, lexicon, stop)
    expect = {(1, "qui"), (1, "voir"), (1, "Chat"), (2, "With")}
    assert {(r.id, r.term) for r in chain.collect()} == expect
    assert {(r.id, r.term) for r in fast.collect()} == expect


def test_titles_keep_their_case(spark):
    items = spark.createDataFrame([(1, "With Audi")], "id long, title string")
    lexicon = lex(spark, [("With", 1, 300, "With"), ("Audi", 1, 300, "Audi"), ("audi", 1, 300, "audi")])
    stop = spark.createDataFrame([("with",)], "orth string")
    assert {r.term for r in text.process_title(items, lexicon, stop).collect()} == {"With", "Audi"}
    assert {r.term for r in text.process_title(items, lexicon, stop, lower=True).collect()} == {"audi"}


def test_process_title_equals_per_position_chain_on_corpus(spark):
    from treeclass.sources import fixture
    sf = "/root/testdata/sf0.001"
    items = fixture.items(spark, sf)
    lexicon = fixture.lexicon(spark, sf).cache()
    stop = fixture.stopwords(spark)
    chain = text.bag_from_first_lemmas(text.first_lemma(
        text.remove_stopwords(text.tag_filter(text.annotate_tokens(items, lexicon)), stop)))
    fast = text.process_title(items, lexicon, stop)
    assert chain.count() == fast.count() > 0
    assert chain.exceptAll(fast).count() == 0


def test_tfidf_vectors_equal_the_library_transformer(spark):
    from pyspark.ml.feature import IDF
    from treeclass.plans.context import Context
    c = Context(spark, "/root/testdata/sf0.001")
    tf = features.hashing_tf(c.bag, 512)
    n = c.items.count()
    ours = {r.id: r.features for r in features.tfidf_vectors(c.items, tf, features.idf(tf, n), 512).collect()}
    counts = features.tfidf_vectors(c.items, tf, None, 512)
    theirs = {r.id: r.v for r in IDF(inputCol="features", outputCol="v").fit(counts).transform(counts).collect()}
    assert ours.keys() == theirs.keys()
    for k in ours:
        a, b = ours[k].toArray(), theirs[k].toArray()
        assert all(math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-15) for x, y in zip(a, b))


def test_words_cut_into_nodes_give_a_lemma_each(spark):
    """A lattice: 'miałem' is one form or two nodes; a part's written form meets the stop list; the
    first surviving analysis counts per start node; later words start after all nodes."""
    items = spark.createDataFrame([(1, "miałem dom unknownword miałem"), (2, "byłaś"), (3, "dom")], "id long, title string")
    lexicon = spark.createDataFrame([
        ("miałem", 1, 592, "mieć:x", 1, 2, None),        # whole form, dropped by its tag
        ("miałem", 2, 300, "mieć:v", 1, 1, "miał"),
        ("miałem", 3, 301, "miał:n", 1, 1, "miał"),      # later analysis of the same node
        ("miałem", 4, 300, "być:aux", 2, 2, "em"),
        ("byłaś", 1, 300, "być:w", 1, 2, None), ("byłaś", 2, 300, "być:v", 1, 1, "była"), ("byłaś", 3, 300, "aś", 2, None, "aś"),
        ("dom", 1, 300, "dom", None, None, None)],
        "orth string, ordinal int, tag_id int, lemma string, segment int, end_segment int, surface string")
    stop = spark.createDataFrame([("aś",)], "orth string")
    tokens = text.annotate_tokens(items, lexicon)
    at = {(r.id, r.start_node, r.end_node, r.orth, r.ordinal) for r in tokens.collect()}
    assert {(1, 1, 3, "miałem", 1), (1, 2, 3, "em", 4), (1, 3, 4, "dom", 1), (1, 4, 5, "unknownword", 1), (1, 5, 7, "miałem", 1),
            (1, 6, 7, "em", 4), (2, 2, 3, "aś", 3), (3, 1, 2, "dom", 1)} <= at
    first = text.first_lemma(text.remove_stopwords(text.tag_filter(tokens), stop))
    assert {tuple(r) for r in first.collect()} == {(1, 1, "mieć"), (1, 2, "być"), (1, 3, "dom"), (1, 5, "mieć"), (1, 6, "być"),
                                                   (2, 1, "być"), (3, 1, "dom")}
    expect = {(1, "mieć"), (1, "być"), (1, "dom"), (2, "być"), (3, "dom")}
    assert {tuple(r) for r in text.process_title(items, lexicon, stop).collect()} == expect
    assert {tuple(r) for r in text.bag_from_first_lemmas(first).collect()} == expect


def test_word_lemmas_take_the_first_of_each_node(spark):
    lexicon = spark.createDataFrame([
        ("ab", 2, 300, "late:x", 1, 1, "ab"), ("ab", 1, 300, "first:x", 1, 1, "ab"), ("ab", 3, 300, "second", 2, 2, "b"),
        ("ab", 4, 300, "first", 3, 3, "c"),                  # a third node with the lemma of the first
        ("cd", None, 300, "never", 1, 1, "cd"),              # no order: no lemma
        ("ef", None, 300, "never", 1, 1, "ef"), ("ef", 5, 300, "some", 1, 1, "ef"),
        ("gh", 1, 300, None, 1, 1, "gh"), ("gh", 2, 300, "after", 1, 1, "gh"), ("gh", 1, 300, "tail", 2, 2, "h"),
        ("ij", 1, 592, "dropped", 1, 1, "ij"), ("kl", 1, 300, "kl", 1, 1, "stop")],
        "orth string, ordinal int, tag_id int, lemma string, segment int, end_segment int, surface string")
    found = text.word_lemmas(lexicon, spark.createDataFrame([("stop",)], "orth string"))
    # one aggregation and one shuffle per word
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r.orth: sorted(r.terms) for r in found.collect()} == {
        "ab": ["first", "second"], "cd": [], "ef": ["some"], "gh": ["tail"]}
