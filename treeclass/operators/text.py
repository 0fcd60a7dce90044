"""Title → bag of lemmas.

Per-position operators (``words`` … ``first_lemma``) mirror the analyser view:
one row per (item, start node, analysis).  A lexicon may cut a word into several nodes: its
optional columns ``segment`` and ``end_segment`` (1-based, inclusive) say which part of the word an
analysis covers and ``surface`` how that part is written; each node then gives a lemma of
its own.  ``process_title`` is the production
path and exploits that every per-position decision depends on the word alone
(its analyses, their tags, the stop list), so it

1. resolves each distinct word of the lexicon to the first surviving lemma of each of its nodes
   (``word_lemmas``: lexicon-sized, independent of the items), and
2. dedupes words inside each item's own row (``array_distinct``, no shuffle),
   joins them to (1) and dedupes the lemmas per item.

Result: the same bag as the per-position chain (tested), with one shuffle of
(item, word) pairs instead of several over every token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeclass.functions.text import lemma_base, tag_is_dropped, tokenize
from treeclass.operators.joins import broadcast_max_rows, frequent_join, lookup_join
from treeclass.session import buckets, fits


def words(items: DataFrame, lower: bool = False) -> DataFrame:
    """``id, start_node, orth`` — every word of the whole title, 1-based position."""
    return (items.select("id", F.posexplode(tokenize("title", lower)).alias("pos", "orth"))
            .select("id", (F.col("pos") + 1).cast("int").alias("start_node"), "orth"))


def with_segments(lexicon: DataFrame) -> DataFrame:
    """The lexicon with its optional columns: an analysis without them covers its whole word as one node."""
    def column(name, default):
        return F.coalesce(F.col(name), default) if name in lexicon.columns else default
    first = column("segment", F.lit(1)).cast("int")
    return lexicon.select("orth", "ordinal", "tag_id", "lemma", first.alias("segment"),
                          F.greatest(first, column("end_segment", first).cast("int")).alias("end_segment"),
                          column("surface", F.col("orth")).alias("surface"))


def annotate_tokens(items: DataFrame, lexicon: DataFrame, lower: bool = False) -> DataFrame:
    """``id, start_node, end_node, orth, lemma, tag_id, ordinal`` — each word with every
    lexicon analysis; a word outside the lexicon gets one analysis with tag 0.

    Nodes are numbered through the item: a word takes as many as its analyses have segments, and an
    analysis runs from the node where it starts to the one where the next could.  ``orth`` is
    the written form of what the analysis covers."""
    lex, w = with_segments(lexicon), words(items, lower)
    if "segment" in lexicon.columns or "end_segment" in lexicon.columns:
        wide = lex.groupBy("orth").agg((F.max("end_segment") - 1).alias("extra")).where("extra > 0")
        earlier = Window.partitionBy("id").orderBy("start_node").rowsBetween(Window.unboundedPreceding, -1)
        w = frequent_join(w, wide, ["orth"], "left").select("id", "orth", (
            F.col("start_node") + F.coalesce(F.sum("extra").over(earlier), F.lit(0))).cast("int").alias("start_node"))
    return (frequent_join(w, lex, ["orth"], "left")
            .select("id", (F.col("start_node") + F.coalesce("segment", F.lit(1)) - 1).alias("start_node"),
                    (F.col("start_node") + F.coalesce("end_segment", F.lit(1))).alias("end_node"),
                    F.coalesce("surface", "orth").alias("orth"), F.coalesce("lemma", "orth").alias("lemma"),
                    F.coalesce("tag_id", F.lit(0)).cast("int").alias("tag_id"),
                    F.coalesce("ordinal", F.lit(1)).cast("int").alias("ordinal")))


def tag_filter(tokens: DataFrame) -> DataFrame:
    return tokens.where(~tag_is_dropped("tag_id"))


def remove_stopwords(tokens: DataFrame, stop: DataFrame) -> DataFrame:
    """Anti-join on the surface form, case-sensitive."""
    return lookup_join(tokens, stop.select("orth"), ["orth"], "left_anti")


def first_lemma(tokens: DataFrame) -> DataFrame:
    """``id, start_node, lemma`` — lemma base of the first surviving analysis."""
    return (tokens.groupBy("id", "start_node")
            .agg(F.min_by(lemma_base("lemma"), F.col("ordinal")).alias("lemma")))


def bag_from_first_lemmas(first: DataFrame) -> DataFrame:
    return first.select("id", F.col("lemma").alias("term")).distinct()


def word_lemmas(lexicon: DataFrame, stop: DataFrame) -> DataFrame:
    """``orth, terms`` — the distinct lemma bases that each known word contributes: per node the
    first analysis whose tag is kept and whose written form is no stop word."""
    parts = with_segments(lexicon).withColumnRenamed("orth", "word").withColumnRenamed("surface", "orth")
    kept = remove_stopwords(tag_filter(parts), stop)
    # a word's analyses are gathered in one aggregation; sorted, the first of each segment is its node's
    found = kept.groupBy(F.col("word").alias("orth")).agg(
        F.collect_list(F.struct("segment", "ordinal", lemma_base("lemma").alias("term"))).alias("found"))
    found = found.select("orth", F.array_sort(F.filter("found", lambda x: x["ordinal"].isNotNull())).alias("found"))
    first = F.filter("found", lambda x, i: (i == 0) | (F.get("found", i - 1)["segment"] != x["segment"]))
    return found.select("orth", F.array_compact(F.array_distinct(F.transform(first, lambda x: x["term"]))).alias("terms"))


def item_words(items: DataFrame, lower: bool = False) -> DataFrame:
    """``id, orth`` — the distinct words of each item (deduplicated inside the
    item's own row, no shuffle)."""
    return items.select("id", F.explode(F.array_distinct(tokenize("title", lower))).alias("orth"))


def process_title(items: DataFrame, lexicon: DataFrame, stop: DataFrame,
                  items_by_id: bool = False, words: DataFrame | None = None,
                  lower: bool = False) -> DataFrame:
    """``id, term`` — distinct lemmas of each item, hash-partitioned by ``id``
    so that per-item aggregations downstream need no further shuffle.

    ``items_by_id=True`` declares ``items`` already hash-partitioned by ``id``;
    then only the (id, lemma) dedupe runs, in place.  ``words`` = precomputed
    ``item_words(items)`` (when another step also needs them)."""
    per_item = item_words(items, lower) if words is None else words
    # |word_lemmas| <= |lexicon|: the lexicon's row count bounds the broadcast side;
    # beyond it only the frequent words are broadcast and the others shuffled
    resolved = frequent_join(per_item, word_lemmas(lexicon, stop), ["orth"],
                             broadcast=fits(lexicon, broadcast_max_rows(lexicon)))
    pairs = resolved.select("id", F.explode("terms").alias("term"))
    if not items_by_id:
        pairs = pairs.repartition(buckets(items.sparkSession), "id")
    return pairs.distinct()
