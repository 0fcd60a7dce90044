"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the driver tables in ``sf_dir`` (via ``Context``) over whole
tables and whole texts.  Floating outputs are rounded (6 digits for margins and
confidences, 9 for IDF-derived values) so that another engine can match them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeclass.operators import encode, features, metrics, score, taxonomy, text, tour, train
from treeclass.operators.joins import small_side
from treeclass.operators.stages import HierarchyModel, TitleTerms
from treeclass.plans.context import MARGIN_DIGITS, Context
from treeclass.session import cut_lineage, scratch_path
from treeclass.sources import mllib, tsv

NUM_BUCKETS = features.CASCADE_BUCKETS
R6 = 6
R9 = 9


def _ctx(spark, sf_dir) -> Context:
    return Context.shared(spark, sf_dir)


def _fresh_bag(c: Context) -> DataFrame:
    """The lemma bag computed now from the items (for queries whose output is
    the text step itself, so its work is always measured)."""
    return text.process_title(c.items, c.lexicon, c.stop)


# --- sources / sinks ---------------------------------------------------------
def scan_ads_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _ctx(spark, sf_dir)
    path = scratch_path(spark, "ads-training")
    tsv.write_ads(c.items.join(c.labels, "id"), path)
    return tsv.read_ads(spark, path)


def scan_ads_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _ctx(spark, sf_dir)
    path = scratch_path(spark, "ads-test")
    tsv.write_test_ads(c.items, path)
    return tsv.read_test_ads(spark, path)


def scan_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _ctx(spark, sf_dir)
    path = scratch_path(spark, "categories")
    tsv.write_categories(c.category, path)
    return tsv.read_categories(spark, path)


def scan_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    from treeclass.sources.fixture import vocabulary
    path = scratch_path(spark, "words")
    tsv.write_stopwords(vocabulary(spark, sf_dir), path)
    return tsv.read_stopwords(spark, path)


def sink_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    tsv.write_predictions(cascade_decode(spark, sf_dir), path)
    return tsv.read_predictions(spark, path)


def sink_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    sel = selective_accuracy(spark, sf_dir)
    rows = sel.select(F.explode(F.array(
        F.struct(F.lit("n_correct").alias("metric"), F.col("n_correct").cast("double").alias("value")),
        F.struct(F.lit("n_resolved").alias("metric"), F.col("n_resolved").cast("double").alias("value")),
        F.struct(F.lit("selective_accuracy").alias("metric"),
                 F.round("selective_accuracy", R9).alias("value")))).alias("m")).select("m.*")
    path = scratch_path(spark, "metrics")
    tsv.write_metrics(rows, path)
    return tsv.read_metrics(spark, path, "metric string, value double")


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _ctx(spark, sf_dir)
    path = scratch_path(spark, "hierarchy")
    train.save_hierarchy(c.weights, c.models.select(
        "node", "level", "num_classes", F.lit(NUM_BUCKETS).alias("num_features")), c.index, path,
        {"source": sf_dir})
    w, m, _, _ = train.load_hierarchy(spark, path)
    per_node = w.groupBy("node").agg(F.count("*").alias("n_weights"))
    return m.join(per_node, "node", "left").select(
        "node", "level", "num_classes", F.coalesce("n_weights", F.lit(0)).alias("n_weights"))


# --- taxonomy ----------------------------------------------------------------
def categories_level(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return taxonomy.categories_level(c.category, c.closure)


def category_index(spark, sf_dir):
    return _ctx(spark, sf_dir).index


def category_closure(spark, sf_dir):
    return _ctx(spark, sf_dir).closure


def category_tour(spark, sf_dir):
    return tour.category_tour(_ctx(spark, sf_dir).category).select("id", "depth", "enter", "leave")


def l2_children(spark, sf_dir):
    return taxonomy.level2_children(_ctx(spark, sf_dir).category)


def category_list(spark, sf_dir):
    return taxonomy.category_list(_ctx(spark, sf_dir).category)


def category_map_for_parent(spark, sf_dir):
    return taxonomy.category_map_for_parent(_ctx(spark, sf_dir).labels, level=2, parent=-1)


def category_map_by_parent(spark, sf_dir):
    return taxonomy.category_map_by_parent(_ctx(spark, sf_dir).labels, level=3)


def dedupe_last(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return taxonomy.dedupe_last(docs, "source", "lang", "doc_id")


# --- encoding ----------------------------------------------------------------
def ads_label_encode(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return encode.label_encode(c.labels, c.index)


def ads_flat_label(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return encode.flat_label(c.labels, taxonomy.category_map_for_parent(c.labels, 2))


def deepest_category(spark, sf_dir):
    return encode.deepest_category(_ctx(spark, sf_dir).labels)


def node_training_set(spark, sf_dir):
    return encode.node_training_set(_ctx(spark, sf_dir).labels)


def trainable_nodes(spark, sf_dir):
    return _ctx(spark, sf_dir).models


def train_test_split(spark, sf_dir):
    return encode.train_test_split(_ctx(spark, sf_dir).labels.select("id"))


def random_split(spark, sf_dir):
    """The seed-based 60/40 split (seed 44).  The assignment depends on partitioning, so the
    row states what holds for any: the parts are disjoint, complete and near 60 %."""
    c = _ctx(spark, sf_dir)
    rows = encode.flat_label(c.labels, taxonomy.category_map_for_parent(c.labels, 2))
    a, b = encode.random_split(rows.select("id"), (0.6, 0.4), 44)
    marked = (a.withColumn("is_train", F.lit(1)).unionByName(b.withColumn("is_train", F.lit(0)))
              .groupBy("id").agg(F.count("*").alias("n"), F.sum("is_train").alias("t")))
    whole = rows.select("id").join(marked, "id", "full")
    return whole.agg(F.count("*").alias("n_rows"), F.max(F.coalesce("n", F.lit(0))).cast("long").alias("most_parts"),
                     F.min(F.coalesce("n", F.lit(0))).cast("long").alias("fewest_parts"),
                     (F.abs(F.avg("t") - 0.6) < 0.1).alias("near_60_percent"))


def node_training_rows(spark, sf_dir):
    """Training rows of every node against a class index that lacks the level-3 categories
    of good quality: labels the index does not know are counted, none is dropped."""
    c = _ctx(spark, sf_dir)
    index = c.index.where("id < 1000 or id % 10 = 0")
    rows = encode.node_rows(c.labels).join(
        index.select(F.col("parent_id").alias("node"), F.col("id").alias("category"), "idx"), ["node", "category"], "left")
    return rows.groupBy("node", "level").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("idx").isNull().cast("long")).alias("n_unknown"))


def unknown_labels(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    r = encode.unknown_labels(c.labels, c.index.where("id < 1000 or id % 10 = 0"))
    return r.select(*(F.col(x).cast("long").alias(x) for x in r.columns))


# --- scalar functions --------------------------------------------------------
def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def scalar_string(spark, sf_dir):
    d = _docs(spark, sf_dir)
    line = F.concat_ws("\t", F.col("doc_id").cast("string"), "lang", F.lit(""), "source")
    parts = F.split(line, "\t")
    return d.select(F.col("doc_id").alias("id"),
                    F.element_at(parts, 2).alias("lang"),
                    F.split_part(line, F.lit("\t"), F.lit(4)).alias("source"),
                    F.size(parts).alias("n_parts"),
                    (F.element_at(parts, 3) == "").alias("third_empty"))


def scalar_cast(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select(F.col("doc_id").alias("id"),
                    F.substring("source", 4, 100).cast("int").alias("feed"),
                    F.col("doc_id").cast("string").alias("id_str"),
                    F.col("doc_id").cast("string").cast("bigint").alias("id_back"),
                    F.expr("try_cast(lang as int)").alias("lang_num"),
                    F.col("n_chars").cast("double").alias("n_chars_d"))


def scalar_array(spark, sf_dir):
    from treeclass.functions.text import tokenize
    d = _docs(spark, sf_dir).select(F.col("doc_id").alias("id"), tokenize("text").alias("t"))
    return d.select(
        "id", F.size("t").alias("n_tokens"),
        F.array_contains("t", "the").alias("has_the"),
        F.array_position("t", "the").cast("bigint").alias("pos_the"),
        F.try_element_at("t", F.lit(-1)).alias("last_token"),  # null for a text without letters
        F.size(F.array_distinct("t")).alias("n_distinct"),
        F.size(F.filter("t", lambda x: F.length(x) > 6)).alias("n_long"),
        F.aggregate(F.transform("t", lambda x: F.length(x)), F.lit(0).cast("bigint"),
                    lambda acc, x: acc + x).alias("total_len"),
        F.size(F.array_append("t", F.lit("<end>"))).alias("n_appended"))


def scalar_map(spark, sf_dir):
    ix = _ctx(spark, sf_dir).index
    m = (ix.groupBy("parent_id")
         .agg(F.map_from_entries(F.collect_list(F.struct("idx", "id"))).alias("m")))
    return m.select("parent_id",
                    F.element_at("m", F.lit(0)).alias("first_child"),
                    F.size(F.map_keys("m")).alias("n_classes"),
                    F.map_contains_key("m", F.lit(1)).alias("has_second"),
                    F.array_max(F.map_values("m")).alias("max_child"))


def scalar_arith(spark, sf_dir):
    d = _docs(spark, sf_dir)
    n = F.col("n_chars")
    return d.select(F.col("doc_id").alias("id"), (n * 2 + 1).alias("a"),
                    F.round(n / 7, R6).alias("b"), (n % 7).alias("c"),
                    F.expr("n_chars div 7").alias("d"),
                    ((n > 1000) & (F.col("lang") == "en")).alias("e"))


def scalar_format(spark, sf_dir):
    # The model path pattern and the time stamp format of the reference
    m = _ctx(spark, sf_dir).models
    return m.select("node", F.format_string("model/logistic_regression_%d_%d_%s_%d",
                                            "num_classes", F.lit(train.MAX_ITER),
                                            F.lit(str(train.REG_PARAM)), "node").alias("model_path"),
                    F.date_format(F.lit("2017-01-02 03:04:05.678").cast("timestamp"),
                                  "yyyy-MM-dd_HH-mm-ss-SSS").alias("stamp"))


# --- text --------------------------------------------------------------------
def annotate_tokens(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return text.annotate_tokens(c.items, c.lexicon)


def tag_filter(spark, sf_dir):
    return text.tag_filter(annotate_tokens(spark, sf_dir))


def stopword_anti_join(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return text.remove_stopwords(text.tag_filter(text.annotate_tokens(c.items, c.lexicon)), c.stop)


def first_lemma(spark, sf_dir):
    return text.first_lemma(stopword_anti_join(spark, sf_dir))


def lemma_base(spark, sf_dir):
    from treeclass.functions.text import lemma_base as base
    return _ctx(spark, sf_dir).lexicon.select("orth", "ordinal", "lemma", base("lemma").alias("base"))


def process_title(spark, sf_dir):
    return _fresh_bag(_ctx(spark, sf_dir))


# --- features ----------------------------------------------------------------
def hashing_tf(spark, sf_dir):
    return features.hashing_tf(_fresh_bag(_ctx(spark, sf_dir)), NUM_BUCKETS, "md5")


def stage_title_terms(spark, sf_dir):
    """The `pyspark.ml` stage of the title terms, saved and loaded, over files of lexicon and stop words."""
    c = _ctx(spark, sf_dir)
    folder = scratch_path(spark, "stage-terms")
    c.lexicon.write.parquet(f"{folder}/lexicon")
    tsv.write_stopwords(c.stop, f"{folder}/stop")
    TitleTerms(lexiconPath=f"{folder}/lexicon", stopwordsPath=f"{folder}/stop", hashFunction="md5").write().save(f"{folder}/stage")
    return TitleTerms.load(f"{folder}/stage").transform(c.items).select("id", F.inline("terms"))


def _idf(c: Context):
    return features.idf(features.hashing_tf(c.bag, NUM_BUCKETS, "md5"), c.items.count())


def idf(spark, sf_dir):
    return _idf(_ctx(spark, sf_dir)).select("bucket", "df", F.round("idf", R9).alias("idf"))


def node_idf(spark, sf_dir):
    """The IDF of every node's own training set."""
    c = _ctx(spark, sf_dir)
    tf = features.hashing_tf(c.bag, NUM_BUCKETS, "md5")
    per_node = features.node_idf(tf, encode.node_rows(c.labels))
    return per_node.select("node", "bucket", "df", "n_docs", F.round("idf", R9).alias("idf"))


def linear_score_node_idf(spark, sf_dir):
    """Items scored at the nodes of their label path with the IDF of the node's training set
    folded into the weights (terms as features)."""
    c = _ctx(spark, sf_dir)
    tf = c.bag.select("id", F.col("term").alias("bucket"))
    weights = features.fold_idf(c.weights, features.node_idf(tf, encode.node_rows(c.labels)))
    s = score.linear_score(_label_routes(c), c.features, c._stored(score.pack_weights(weights), "folded"), c.index, MARGIN_DIGITS)
    return s.select("id", "node", "category", "margin")


def _turn_items(spark, sf_dir) -> DataFrame:
    """A second corpus: conversation turns, with ids beside those of the documents."""
    t = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return t.select((-(F.col("conv_id").cast("long") * 1000 + F.col("turn").cast("long")) - 1).alias("id"),
                    F.col("text").alias("title"))


def idf_union_corpus(spark, sf_dir):
    """IDF fitted on two corpora together, beside the one of the documents alone."""
    c = _ctx(spark, sf_dir)
    turns = _turn_items(spark, sf_dir)
    corpus = c.items.select("id").unionByName(turns.select("id"))
    bag = c.bag.select("id", "term").unionByName(text.process_title(turns, c.lexicon, c.stop))
    both = features.idf(features.hashing_tf(bag, NUM_BUCKETS, "md5"), corpus.count())
    one = _idf(c).select("bucket", F.col("df").alias("df_documents"))
    return both.join(one, "bucket", "left").select(
        "bucket", "df", F.round("idf", R9).alias("idf"), F.coalesce("df_documents", F.lit(0)).alias("df_documents"))


def _tfidf(c: Context, num_buckets: int):
    long, _ = features.fit_tfidf(c.items, _fresh_bag(c), num_buckets, "md5", keep=c.keep_tf)
    return long


def tfidf(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    tf = c.keep_tf(features.hashing_tf(_fresh_bag(c), NUM_BUCKETS, "md5"))  # read by the IDF and the product
    return features.tfidf(tf, features.idf(tf, c.items.count()), ("tf", "df")).withColumn("value", F.round("value", R9))


def features_join(spark, sf_dir):
    """The features of the three levels, joined one after another, on the row of the labels.  Terms and sum are
    those of the deepest level at which the item is labelled."""
    c = _ctx(spark, sf_dir)
    enc = encode.label_encode(c.labels, c.index).select("id", "l1_idx", "l2_idx", "l3_idx")
    by_level = features.CASCADE_BUCKETS_BY_LEVEL
    long = {n: _tfidf(c, n) for n in sorted(set(by_level.values()))}  # levels with as many buckets share the term frequencies
    rows = features.join_levels(enc, [features.level_features(long[n], level) for level, n in by_level.items()])
    own = F.when(F.col("l3_idx") >= 0, F.col("features3")).when(F.col("l2_idx") >= 0, F.col("features2")).otherwise(F.col("features1"))
    return rows.select(*enc.columns, own.alias("own")).select(
        *enc.columns, F.size("own").cast("long").alias("n_terms"),
        F.round(F.aggregate("own", F.lit(0.0), lambda a, x: a + x["value"]), R6).alias("tfidf_sum"))


def labeled_features(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    enc = encode.label_encode(c.labels, c.index)
    tf = c.keep_tf(features.hashing_tf(_fresh_bag(c), NUM_BUCKETS, "md5"))  # read twice
    vec = features.tfidf_vectors(c.items, tf, features.idf(tf, c.items.count()), NUM_BUCKETS)
    lf = features.labeled_features(enc, "l1_idx", vec)
    values = features.stored_values("features")
    return lf.select("id", "label",
                     F.size(F.filter(values, lambda x: x != 0)).alias("nnz"),
                     F.round(F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x)), R6).alias("norm"))


# --- scoring -----------------------------------------------------------------
def _label_routes(c: Context) -> DataFrame:
    """Each item at the nodes on its true label path that have a model."""
    r = encode.node_rows(c.labels).select("id", "node")
    return r.join(small_side(c.models.select("node")), "node", "left_semi")


def linear_score(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    s = score.linear_score(_label_routes(c), c.features, c.packed, c.index, MARGIN_DIGITS)
    return s.select("id", "node", "idx", "category", "margin",
                    F.round("confidence", R6).alias("confidence"))


def sigmoid_confidence(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    routes = c.items.select("id", F.lit(0).alias("node"))
    s = score.score_routes(routes, c.features, c.root_packed, MARGIN_DIGITS)
    return s.select("id", "margin", F.round("confidence", R6).alias("confidence"))


def linear_score_runmax(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return score.linear_score_runmax(_label_routes(c), c.features, c.packed, MARGIN_DIGITS)


def linear_predict(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return score.linear_predict(_label_routes(c), c.features, c.packed, MARGIN_DIGITS)


def _cascade(c: Context) -> DataFrame:
    return score.cascade_predict(c.items, c.features, c.packed, c.models, c.index,
                                 margin_digits=MARGIN_DIGITS)


def cascade_predict(spark, sf_dir):
    p = _cascade(_ctx(spark, sf_dir))
    return p.select("id", "cat1_pred", F.round("conf1", R6).alias("conf1"), "cat2_pred",
                    F.round("conf2", R6).alias("conf2"), "cat3_pred",
                    F.round("conf3", R6).alias("conf3"))


def cascade_decode(spark, sf_dir):
    return score.cascade_decode(_cascade(_ctx(spark, sf_dir)))


def stage_hierarchy_model(spark, sf_dir):
    """The cascade as a saved and loaded `pyspark.ml` model over term columns."""
    c = _ctx(spark, sf_dir)
    folder = scratch_path(spark, "stage-model")
    model = HierarchyModel(c.packed, c.models, c.index)
    model._set(marginDigits=MARGIN_DIGITS).write().save(folder)
    # an item's terms are bounded by its own title
    bags = c.bag.groupBy("id").agg(F.collect_list(F.struct(F.col("term").alias("bucket"), F.lit(1).cast("long").alias("tf"))).alias("terms"))
    out = HierarchyModel.load(folder).transform(c.items.select("id").join(bags, "id", "left"))
    return out.select("id", "depth", "category")


def cascade_decode_no_root_model(spark, sf_dir):
    """Without a root model every item is kept and stays undecided."""
    c = _ctx(spark, sf_dir)
    return score.cascade_decode(score.cascade_predict(
        c.items, c.features, c.packed, c.models.where("node <> 0"), c.index, margin_digits=MARGIN_DIGITS))


def linear_score_intercept(spark, sf_dir):
    """Root scores with an intercept per class: (class number - 2) / 4."""
    c = _ctx(spark, sf_dir)
    base = c.index.where("parent_id = 0 and idx > 0").select(
        F.lit(0).alias("node"), "idx", F.lit(None).cast("string").alias("feature"), ((F.col("idx") - 2) / 4.0).alias("w"))
    weights = c.weights.where("node = 0").unionByName(base)
    routes = c.items.select("id", F.lit(0).alias("node"))
    s = score.linear_score(routes, c.features, weights, c.index, MARGIN_DIGITS)
    return s.select("id", "idx", "category", "margin", F.round("confidence", R6).alias("confidence"))


def stream_cascade_decode(spark, sf_dir):
    """The cascade run as a Structured Streaming query over the documents
    folder (file source, available-now trigger), read back from its sink."""
    from treeclass.streaming import classify_stream
    c = _ctx(spark, sf_dir)
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").schema
    # the table is a file or a folder of files; a file source takes either by a pattern only
    stream = (spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/documents.parque[t]")
              .select(F.col("doc_id").alias("id"), F.col("text").alias("title")))
    out = scratch_path(spark, "stream-out")
    q = classify_stream(stream, c.lexicon, c.stop, c.packed, c.models, c.index, out,
                        scratch_path(spark, "stream-ckpt"), margin_digits=MARGIN_DIGITS)
    q.awaitTermination()
    return spark.read.parquet(out).select("id", "depth", "category")


# --- evaluation --------------------------------------------------------------
def category_cost(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    dec = score.cascade_decode(_cascade(c)).where(F.col("category") != 0)
    pairs = (dec.join(encode.deepest_category(c.labels).withColumnRenamed("category", "a"), "id")
             .select("a", F.col("category").alias("b")))
    return metrics.pair_cost(pairs, c.closure)


def category_frequency(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = metrics.category_frequency(c.labels, c.category, c.closure)
    return f.select("id", F.round("freq", R9).alias("freq"))


def category_weights(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = metrics.category_frequency(c.labels, c.category, c.closure)
    sums = metrics.cost_row_sums(c.category, c.closure)
    n = c.category.count()
    w = metrics.category_weights(f, sums, n)
    return w.select("id", F.round("weight", R9).alias("weight"))


def _root_predictions(c: Context) -> DataFrame:
    routes = c.items.select("id", F.lit(0).alias("node"))
    s = score.linear_score(routes, c.features, c.root_packed, c.index, MARGIN_DIGITS)
    return s.join(c.labels, "id")


def category_cost_tour(spark, sf_dir):
    """Exact and tree costs of the occurring pairs through the interval index."""
    c = _ctx(spark, sf_dir)
    pairs = cut_lineage(score.cascade_decode(_cascade(c)).where(F.col("category") != 0).join(
        encode.deepest_category(c.labels).withColumnRenamed("category", "a"), "id").select("a", F.col("category").alias("b")).distinct())
    walk = tour.category_tour(c.category)
    return tour.pair_cost(pairs, walk).join(
        tour.pair_cost(pairs, walk, "tree").withColumnRenamed("cost", "tree_cost"), ["a", "b"])


def category_weights_tour(spark, sf_dir):
    """Frequencies, row sums and weights through the interval index."""
    c = _ctx(spark, sf_dir)
    walk = tour.category_tour(c.category)
    freq, sums = cut_lineage(tour.category_frequency(c.labels, walk)), cut_lineage(tour.cost_row_sums(walk))
    w = metrics.category_weights(freq, sums, c.category.count())
    return w.join(freq, "id").join(sums.withColumnRenamed("a", "id"), "id").select(
        "id", F.round("freq", R9).alias("freq"), "row_sum", F.round("weight", R9).alias("weight"))


def mean_hier_cost(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    p = _root_predictions(c).select("id", F.col("cat1").alias("label"),
                                    F.col("category").alias("prediction"))
    m = metrics.mean_hier_cost(p, c.closure)
    return m.select("n", "n_unknown", "total_cost", F.round("mean_cost", R9).alias("mean_cost"))


def mean_hier_cost_unknown(spark, sf_dir):
    """The same with predictions outside the taxonomy for every third item."""
    c = _ctx(spark, sf_dir)
    p = _root_predictions(c).select("id", F.col("cat1").alias("label"),
                                    F.when(F.col("id") % 3 == 0, 9999).otherwise(F.col("category")).alias("prediction"))
    m = metrics.mean_hier_cost(p, c.closure)
    return m.select("n", "n_unknown", "total_cost", F.round("mean_cost", R9).alias("mean_cost"))


def selective_accuracy(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    s = metrics.selective_accuracy(score.cascade_decode(_cascade(c)), c.labels)
    return s.select("n_correct", "n_resolved", F.round("selective_accuracy", R9).alias("selective_accuracy"))


def selective_accuracy_local_index(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    truth = encode.label_encode(c.labels, c.index)
    s = metrics.selective_accuracy(score.cascade_decode(_cascade(c)), truth, "local_index", c.index)
    return s.select("n_correct", "n_resolved", F.round("selective_accuracy", R9).alias("selective_accuracy"))


def category_cost_tree(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    dec = score.cascade_decode(_cascade(c)).where(F.col("category") != 0)
    pairs = (dec.join(encode.deepest_category(c.labels).withColumnRenamed("category", "a"), "id")
             .select("a", F.col("category").alias("b")))
    return metrics.pair_cost(pairs, c.closure, mode="tree")


def cascade_decode_level1(spark, sf_dir):
    return score.cascade_decode(_cascade(_ctx(spark, sf_dir)), emit_level1=True)


def _root_index_predictions(c: Context) -> DataFrame:
    enc = encode.label_encode(c.labels, c.index).select("id", F.col("l1_idx").cast("double").alias("label"))
    p = _root_predictions(c).select("id", F.col("idx").cast("double").alias("prediction"))
    return enc.join(p, "id")


def accuracy(spark, sf_dir):
    a = metrics.accuracy(_root_index_predictions(_ctx(spark, sf_dir)))
    return a.select("n", "n_correct", F.round("accuracy", R9).alias("accuracy"))


def multiclass_metrics(spark, sf_dir):
    m = metrics.multiclass_metrics(_root_index_predictions(_ctx(spark, sf_dir)))
    return m.select(*[F.round(x, R9).alias(x) for x in m.columns])


# --- training ----------------------------------------------------------------
def _train_inputs(c: Context, num_buckets: int):
    tf = features.hashing_tf(c.bag, num_buckets, "murmur3")
    # read once, by the step that writes the training rows
    vectors = features.tfidf_vectors(c.items, tf, features.idf(tf, c.items.count()), num_buckets)
    enc = encode.label_encode(c.labels, c.index)
    return enc, vectors


def train_lr(spark, sf_dir):
    """A fitted root model in one row: items, whether it beats the majority class, and
    whether the exported pivot weights decide every item as the model itself does."""
    c = _ctx(spark, sf_dir)
    enc, vectors = _train_inputs(c, NUM_BUCKETS)
    k = c.category.where("parent_id = 0").count()
    data = c._stored(features.labeled_features(enc, "l1_idx", vectors), "labeled")
    model = train.fit_lr(data.select("label", "features"), k)
    own = model.transform(data).select("id", "label", "prediction")
    weights = train.weights_frame(0, model, scratch_path(spark, "root-model"))
    tf = features.hashing_tf(c.bag, NUM_BUCKETS, "murmur3")
    long = features.tfidf(tf, features.idf(tf, c.items.count())).withColumnRenamed("bucket", "feature")
    ours = score.linear_predict(c.items.select("id", F.lit(0).alias("node")), long, weights)
    both = own.join(ours.select("id", F.col("prediction").alias("pivot")), "id", "left")
    majority = data.groupBy("label").count().agg(F.max("count").alias("majority"))
    return both.agg(F.count("*").alias("n"), F.sum((F.col("label") == F.col("prediction")).cast("int")).alias("right"),
                    F.avg((F.col("prediction") == F.col("pivot")).cast("double")).alias("agree")).join(majority).select(
        "n", (F.col("right") > F.col("majority")).alias("beats_majority"), (F.col("agree") >= 0.999).alias("pivot_agrees"))


def train_hierarchy(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    _, vectors = _train_inputs(c, NUM_BUCKETS)
    weights, models = train.train_hierarchy(c.labels, c.index, c.models, vectors, NUM_BUCKETS)
    per_node = weights.groupBy("node").agg(F.count("*").alias("n_weights"))
    return (models.join(per_node, "node", "left")
            .select("node", "level", "num_classes", "num_features",
                    (F.coalesce("n_weights", F.lit(0)) > 0).alias("has_weights")))


def trained_cascade(spark, sf_dir):
    """End to end: train on the md5 split's 60 %, score the held-out items with the fitted
    weights, and state in one row what must hold whatever the coefficients are."""
    c = _ctx(spark, sf_dir)
    part = cut_lineage(encode.train_test_split(c.labels))
    train_labels = part.where("is_train").drop("is_train")
    held = part.where("not is_train").drop("is_train")
    tf = c.keep_tf(features.hashing_tf(c.bag, NUM_BUCKETS, "murmur3"))
    tf_train = tf.join(train_labels.select("id"), "id", "left_semi")
    idf_table = cut_lineage(features.idf(tf_train, train_labels.count()))
    vectors = features.tfidf_vectors(train_labels.select("id"), tf_train, idf_table, NUM_BUCKETS)
    nodes = cut_lineage(encode.trainable_nodes(train_labels, c.category))
    path = scratch_path(spark, "trained")
    weights, models, index, idf_table = train.fit_or_load(spark, path, {"key": "trained_cascade"}, lambda: (
        *train.train_hierarchy(train_labels, c.index, nodes, vectors, NUM_BUCKETS), c.index, idf_table))
    feats = features.tfidf(tf.join(held.select("id"), "id", "left_semi"), idf_table).withColumnRenamed("bucket", "feature")
    pred = cut_lineage(score.cascade_predict(held.select("id"), feats, weights, models, index))
    dec = score.cascade_decode(pred)
    both = pred.join(dec, "id").join(held, "id")
    up = c.category.select(F.col("id").alias("cat2_pred"), F.col("parent_id").alias("p2"))
    up3 = c.category.select(F.col("id").alias("cat3_pred"), F.col("parent_id").alias("p3"))
    chain = both.join(up, "cat2_pred", "left").join(up3, "cat3_pred", "left")
    ok = (F.coalesce(F.col("p2") == F.col("cat1_pred"), F.col("cat2_pred").isNull())
          & F.coalesce(F.col("p3") == F.col("cat2_pred"), F.col("cat3_pred").isNull())
          & (F.col("cat2_pred").isNull() | (F.col("conf1") >= 0.7)) & (F.col("cat3_pred").isNull() | (F.col("conf2") >= 0.8)))
    majority = held.groupBy("cat1").count().agg(F.max("count").alias("majority"))
    return chain.agg(F.count("*").alias("n_items"), F.count_distinct("id").alias("n_ids"),
                     F.min(ok).alias("valid_chain"), F.sum((F.col("cat1_pred") == F.col("cat1")).cast("int")).alias("right")
                     ).join(majority).select("n_items", "n_ids", "valid_chain",
                                             (F.col("right") > F.col("majority")).alias("beats_majority"))


def fit_or_load(spark, sf_dir):
    """Train-or-load in one row: calls of the training function for the same data twice,
    then for changed data (a table with one more row), and the nodes loaded."""
    c = _ctx(spark, sf_dir)
    path, calls = scratch_path(spark, "cache"), []

    def fit():
        calls.append(1)
        models = c.models.select("node", "level", "num_classes", F.lit(NUM_BUCKETS).alias("num_features"))
        return c.weights, models, c.index, _idf(c)
    docs = f"{sf_dir.rstrip('/')}/documents.parquet"
    for stop in (c.stop, c.stop, c.stop.unionByName(spark.createDataFrame([("more",)], "orth string"))):
        key = {"data": train.data_fingerprint(spark, [docs], [stop, c.lexicon])}
        _, models, _, idf_table = train.fit_or_load(spark, path, key, fit)
    return models.agg(F.count("*").alias("n_nodes")).select(
        "n_nodes", F.lit(len(calls)).alias("n_fits"), F.lit(idf_table.count()).cast("long").alias("n_idf"))


def mllib_models(spark, sf_dir):
    """A root model saved by ``pyspark.mllib`` in the reference's layout, read back: the class, the
    margin and the node of every item equal those of the weights it was made from."""
    from pyspark.mllib.classification import LogisticRegressionModel
    from pyspark.mllib.linalg import DenseVector
    c = _ctx(spark, sf_dir)
    small = 256
    tf = c.keep_tf(features.hashing_tf(c.bag, small, "md5"))
    k = c.category.where("parent_id = 0").count()
    enc = encode.label_encode(c.labels, c.index)
    data = c._stored(features.labeled_features(enc, "l1_idx", features.tfidf_vectors(c.items, tf, None, small)), "labeled")
    rows = train.fit_lr(data.select("label", "features"), k).coefficientMatrix.toArray()
    pivot = rows[1:] - rows[0]  # classes x buckets: bounded by the parameters
    root = scratch_path(spark, "mllib")
    LogisticRegressionModel(DenseVector(pivot.ravel()), 0.0, small, k).save(
        spark.sparkContext, f"{root}/logistic_regression_{k}_{train.MAX_ITER}_{train.REG_PARAM}_0")
    weights, models = mllib.read_models(spark, root)
    direct = spark.createDataFrame([(0, i + 1, b, float(w)) for i, row in enumerate(pivot) for b, w in enumerate(row) if w],
                                   train.WEIGHTS_SCHEMA)
    long = tf.select("id", F.col("bucket").alias("feature"), F.col("tf").cast("double").alias("value"))
    routes = c.items.select("id", F.lit(0).alias("node"))
    a, b = (score.linear_score(routes, long, w, c.index, MARGIN_DIGITS) for w in (weights, direct))
    same = a.join(b.select("id", F.col("idx").alias("idx2"), F.col("margin").alias("margin2")), "id")
    return same.agg(F.count("*").alias("n"), F.min((F.col("idx") == F.col("idx2")) & (F.abs(F.col("margin") - F.col("margin2")) < 1e-5)
                                                   & (F.col("node") == 0)).alias("same")).join(models).select(
        "n", "same", "node", "num_classes", "num_features")


def refit_changed_nodes(spark, sf_dir):
    """``step, node``: the nodes fitted for the same data twice (steps 1 and 2; none in step 2), then
    after one item of a level-3 category got another term (3), and when the fit of that step
    had ended in an error before (the old models stay in force).  Weights stand in for fits."""
    c = _ctx(spark, sf_dir)
    path, steps = scratch_path(spark, "changed"), []
    tf = c.keep_tf(features.hashing_tf(c.bag, NUM_BUCKETS, "md5"))
    item = c.labels.where("cat3 is not null").agg(F.min("id").alias("id"))
    more = tf.unionByName(item.select("id", F.lit(NUM_BUCKETS).alias("bucket"), F.lit(1).cast("long").alias("tf")))

    def fit(nodes):
        own = c.weights.join(nodes.select("node"), "node", "left_semi")
        return own, nodes.select("node", "level", "num_classes")

    def fail(nodes):
        raise InterruptedError
    for step, (terms, train_fn) in enumerate(((tf, fit), (tf, fit), (more, fail), (more, fit)), 1):
        keys = cut_lineage(train.node_keys(c.labels, c.index, terms, {"buckets": NUM_BUCKETS}))
        try:
            weights, models, fitted = train.fit_changed_nodes(spark, path, keys, c.models, train_fn)
        except InterruptedError:
            continue
        train.save_hierarchy(weights, models, c.index, path, {"step": step})
        steps += [(min(step, 3), n) for n in fitted]
    kept = train.load_hierarchy(spark, path)
    counts = kept[1].select("node").exceptAll(c.models.select("node")).union(c.models.select("node").exceptAll(kept[1].select("node")))
    lost = counts.count() + abs(kept[0].count() - c.weights.count())
    return spark.createDataFrame(steps, "step int, node int").withColumn("n_lost", F.lit(lost).cast("long"))


QUERIES = {
    # sources / sinks
    "scan_ads_training": scan_ads_training,
    "scan_ads_test": scan_ads_test,
    "scan_categories": scan_categories,
    "scan_stopwords": scan_stopwords,
    "sink_predictions": sink_predictions,
    "sink_metrics": sink_metrics,
    "model_roundtrip": model_roundtrip,
    # taxonomy
    "categories_level": categories_level,
    "category_index": category_index,
    "category_closure": category_closure,
    "category_tour": category_tour,
    "l2_children": l2_children,
    "category_list": category_list,
    "category_map_for_parent": category_map_for_parent,
    "category_map_by_parent": category_map_by_parent,
    "dedupe_last": dedupe_last,
    # encoding
    "ads_label_encode": ads_label_encode,
    "ads_flat_label": ads_flat_label,
    "deepest_category": deepest_category,
    "node_training_set": node_training_set,
    "unknown_labels": unknown_labels,
    "node_training_rows": node_training_rows,
    "trainable_nodes": trainable_nodes,
    "train_test_split": train_test_split,
    "random_split": random_split,
    # scalar functions
    "scalar_string": scalar_string,
    "scalar_cast": scalar_cast,
    "scalar_array": scalar_array,
    "scalar_map": scalar_map,
    "scalar_arith": scalar_arith,
    "scalar_format": scalar_format,
    # text
    "annotate_tokens": annotate_tokens,
    "tag_filter": tag_filter,
    "stopword_anti_join": stopword_anti_join,
    "first_lemma": first_lemma,
    "lemma_base": lemma_base,
    "process_title": process_title,
    # features
    "hashing_tf": hashing_tf,
    "stage_title_terms": stage_title_terms,
    "idf": idf,
    "node_idf": node_idf,
    "idf_union_corpus": idf_union_corpus,
    "tfidf": tfidf,
    "features_join": features_join,
    "labeled_features": labeled_features,
    # scoring
    "sigmoid_confidence": sigmoid_confidence,
    "linear_score": linear_score,
    "linear_score_intercept": linear_score_intercept,
    "linear_score_node_idf": linear_score_node_idf,
    "linear_score_runmax": linear_score_runmax,
    "linear_predict": linear_predict,
    "cascade_predict": cascade_predict,
    "cascade_decode": cascade_decode,
    "cascade_decode_no_root_model": cascade_decode_no_root_model,
    "stream_cascade_decode": stream_cascade_decode,
    "stage_hierarchy_model": stage_hierarchy_model,
    "cascade_decode_level1": cascade_decode_level1,
    # evaluation
    "category_cost": category_cost,
    "category_cost_tree": category_cost_tree,
    "category_cost_tour": category_cost_tour,
    "category_frequency": category_frequency,
    "category_weights": category_weights,
    "category_weights_tour": category_weights_tour,
    "mean_hier_cost": mean_hier_cost,
    "mean_hier_cost_unknown": mean_hier_cost_unknown,
    "selective_accuracy": selective_accuracy,
    "selective_accuracy_local_index": selective_accuracy_local_index,
    "accuracy": accuracy,
    "multiclass_metrics": multiclass_metrics,
    # training
    "train_lr": train_lr,
    "train_hierarchy": train_hierarchy,
    "fit_or_load": fit_or_load,
    "mllib_models": mllib_models,
    "refit_changed_nodes": refit_changed_nodes,
    "trained_cascade": trained_cascade,
}
