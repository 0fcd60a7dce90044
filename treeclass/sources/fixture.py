"""Shared fixture: the classification inputs derived from the driver tables.

The driver ships no item/taxonomy files, so the inputs the reference reads are
derived from ``documents`` and ``labels`` with plain column rules (the oracle SQL
in ``treeclass.plans.oracle`` states the same rules):

* item  = one document; its title is the **whole** text.
* L1    = language (de 1, en 2, es 3, other 4)      -> category ``10 + l1``
* L2    = L1 x (feed number mod 3), where the feed is the number in ``source``;
          feeds 18 and 19 are labelled at L1 only     -> ``100 + 10*l1 + s``
* L3    = L2 x quality label, when ``labels`` has one  -> ``1000 + 100*l1 + 10*s + q``
* taxonomy = every category that some item carries, with its parent.
* lexicon  = the analyses of every distinct word of the corpus: words of 12 or
             more letters are unknown to it (they get tag 0 when annotated);
             words of 1-2 letters carry one of ``LEXICON_DROPPED`` (by their hash),
             3-letter words a particle tag (all dropped by the tag filter), other
             words one of ``LEXICON_KEPT``, ids just outside the dropped ranges; a
             word over 4 letters ending in 's' gets lemma ``stem:s2``;
             3-letter words have a second analysis (tag 301, ``word:alt``).
             Words of 10 and 11 letters are cut into two nodes after the fifth letter: their first
             analysis covers both (10 letters: a dropped tag), two more cover one each.
             Words are kept as written (case included).
* stop words = the fixed list below.

Only narrow label columns are joined; the texts are read where they lie and are
never shuffled before tokenisation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeclass.functions.hashing import md5_hash
from treeclass.functions.text import tokenize

# The fixture stop-word list.
FIXTURE_STOP_WORDS = ("with", "that", "they", "avec", "pour", "auch")

# Lexicon rule parameters.
UNKNOWN_MIN_LENGTH = 12
TWO_NODES = 10
LABEL_ONLY_L1_MIN_FEED = 18
# Tags of the fixture lexicon, with both bounds of every dropped range, and
# kept tags on both sides of each.
LEXICON_DROPPED = (592, 151, 235, 429, 445, 461, 800, 462, 485, 508, 705, 714, 723, 594, 596, 598, 573,
                   578, 585, 591, 148, 99, 97, 801)
LEXICON_KEPT = (300, 593, 150, 152, 234, 236, 428, 509, 799, 802, 704, 724, 599, 572, 574, 577, 147, 149, 98, 100, 96)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id LONG, title STRING`` — every document, whole text."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("title"))


def ad_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, cat1, cat2, cat3`` (INT, NULL when the level is absent)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    l1 = (F.when(F.col("lang") == "de", 1).when(F.col("lang") == "en", 2)
          .when(F.col("lang") == "es", 3).otherwise(4))
    feed = F.substring("source", 4, 100).cast("int")
    s = feed % 3
    cat1 = (F.lit(10) + l1).cast("int")
    cat2 = F.when(feed >= LABEL_ONLY_L1_MIN_FEED, F.lit(None)).otherwise(100 + l1 * 10 + s).cast("int")
    cat3 = (F.when(cat2.isNull() | F.col("quality").isNull(), F.lit(None))
            .otherwise(1000 + l1 * 100 + s * 10 + F.col("quality")).cast("int"))
    return (docs.join(lab, "doc_id", "left")
            .select(F.col("doc_id").alias("id"), cat1.alias("cat1"), cat2.alias("cat2"),
                    cat3.alias("cat3")))


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxonomy ``id INT, parent_id INT, name STRING`` of every category in use."""
    levels = F.array(F.struct(F.col("cat1").alias("id"), F.lit(0).alias("parent_id")),
                     F.struct(F.col("cat2").alias("id"), F.col("cat1").alias("parent_id")),
                     F.struct(F.col("cat3").alias("id"), F.col("cat2").alias("parent_id")))
    pairs = (ad_labels(spark, sf_dir).select(F.inline(levels))
             .where(F.col("id").isNotNull()).distinct())
    return pairs.select(F.col("id").cast("int"), F.col("parent_id").cast("int"),
                        F.concat(F.lit("category "), F.col("id").cast("string")).alias("name"))


def vocabulary(spark: SparkSession, sf_dir: str, item_frame: DataFrame | None = None,
               words: DataFrame | None = None) -> DataFrame:
    """Distinct words ``orth`` of all whole texts (from per-item ``words`` if given)."""
    if words is not None:
        return words.select("orth").distinct()
    return ((items(spark, sf_dir) if item_frame is None else item_frame)
            .select(F.explode(F.array_distinct(tokenize("title"))).alias("orth"))
            .distinct())


def lexicon(spark: SparkSession, sf_dir: str, item_frame: DataFrame | None = None,
            words: DataFrame | None = None) -> DataFrame:
    """``orth, ordinal INT, tag_id INT, lemma, segment INT, end_segment INT, surface`` — analyses
    in analyser order."""
    w = vocabulary(spark, sf_dir, item_frame, words).where(F.length("orth") < UNKNOWN_MIN_LENGTH)
    n = F.length("orth")

    def by_hash(ids):
        return F.element_at(F.array(*map(F.lit, ids)), (md5_hash("orth") % len(ids) + 1).cast("int"))
    tag = F.when(n <= 2, by_hash(LEXICON_DROPPED)).when(n.isin(3, TWO_NODES), 592).otherwise(by_hash(LEXICON_KEPT))
    lemma = (F.when((n > 4) & F.col("orth").endswith("s"),
                    F.concat(F.expr("substring(orth, 1, length(orth) - 1)"), F.lit(":s2")))
             .otherwise(F.col("orth")))
    first = F.struct(F.lit(1).alias("ordinal"), tag.cast("int").alias("tag_id"), lemma.alias("lemma"), F.lit(1).alias("segment"),
                     F.when(n >= TWO_NODES, 2).otherwise(1).alias("end_segment"), F.col("orth").alias("surface"))

    def more(ordinal, tag_id, lemma, segment, surface):
        return F.struct(F.lit(ordinal).alias("ordinal"), F.lit(tag_id).alias("tag_id"), lemma.alias("lemma"),
                        F.lit(segment).alias("segment"), F.lit(segment).alias("end_segment"), surface.alias("surface"))
    head, tail = F.substring("orth", 1, 5), F.substring("orth", 6, 100)
    analyses = F.when(n == 3, F.array(first, more(2, 301, F.concat("orth", F.lit(":alt")), 1, F.col("orth")))).when(
        n >= TWO_NODES, F.array(first, more(2, 149, F.concat(head, F.lit(":p")), 1, head),
                                more(3, 100, F.concat(tail, F.lit(":q")), 2, tail))).otherwise(F.array(first))
    return w.select("orth", F.inline(analyses))


def stopwords(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, FIXTURE_STOP_WORDS))).alias("orth"))
