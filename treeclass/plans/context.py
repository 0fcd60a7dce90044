"""Fixture context: the tables every registered query starts from.

Each attribute is a lazily built DataFrame derived from the driver tables in one
folder (``sf_dir``); see ``treeclass.sources.fixture`` for the rules.  The
scoring fixture uses deterministic weights so that another engine can recompute
them: a term gets a weight for class ``c`` only when some item labelled ``c``
contains it (an equi-join of item labels with item bags), with value
``(md5_32(c || ':' || term) mod 2001 - 1000) / 1000``.  Models are the trainable
nodes.  Features are the binary bag (value 1.0 per term).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeclass.functions.hashing import md5_hash
from treeclass.operators import encode, score, taxonomy, text
from treeclass.operators.joins import bounded_by
from treeclass.session import buckets, cut_lineage, scratch_path, write_bucketed
from treeclass.sources import fixture

MARGIN_DIGITS = 6


class Context:
    _shared: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Context":
        """One context per (session, folder): its materialised inputs (lexicon,
        taxonomy, feature table, weights, model table) are built once and read by
        every query, as a scoring job reads a stored feature table and model."""
        key = (id(spark), sf_dir.rstrip("/"))
        ctx = cls._shared.get(key)
        if ctx is None or ctx.spark is not spark:
            ctx = cls._shared[key] = cls(spark, sf_dir)
        return ctx

    def prepare(self) -> "Context":
        """Materialise every shared input now."""
        for name in ("labels", "category", "index", "closure", "lexicon", "bag", "packed", "models"):
            getattr(self, name)
        return self

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        """Written once below the shared folder and read as a table (compact, and columns
        that a query does not need are not read)."""
        path = scratch_path(self.spark, f"ctx-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_tf(self, tf: DataFrame) -> DataFrame:
        """Term frequencies written once as a table bucketed by item id, as they are partitioned
        already: what reads them per item shuffles nothing."""
        return write_bucketed(tf, "id", "tf", partitioned=True)

    # --- inputs -------------------------------------------------------------
    @cached_property
    def items(self) -> DataFrame:
        # a corpus of fewer files than cores (the driver's is one file of one row group) is dealt out
        # once by id and written, so that every query works on all cores; one of many files is read where it lies
        items = fixture.items(self.spark, self.sf_dir)
        if len(items.inputFiles()) >= self.spark.sparkContext.defaultParallelism:
            return items
        return self._stored(items.repartition(buckets(self.spark), "id"), "items")

    @cached_property
    def labels(self) -> DataFrame:
        return cut_lineage(fixture.ad_labels(self.spark, self.sf_dir))  # ids and three numbers

    @cached_property
    def category(self) -> DataFrame:
        return cut_lineage(fixture.category(self.spark, self.sf_dir))

    @cached_property
    def words(self) -> DataFrame:
        # per-item distinct words: read by the fixture vocabulary and by the bag
        return self._stored(text.item_words(self.items), "words")

    @cached_property
    def lexicon(self) -> DataFrame:
        # an input table in practice; materialised once so size checks are cheap
        return self._stored(fixture.lexicon(self.spark, self.sf_dir, self.items, self.words), "lexicon")

    @cached_property
    def stop(self) -> DataFrame:
        return fixture.stopwords(self.spark)

    # --- taxonomy -----------------------------------------------------------
    @cached_property
    def index(self) -> DataFrame:
        return cut_lineage(taxonomy.category_index(self.category))

    @cached_property
    def closure(self) -> DataFrame:
        return taxonomy.category_closure(self.category)  # written by the operator

    @cached_property
    def models(self) -> DataFrame:
        # the model table (taxonomy-sized): materialised once
        return cut_lineage(encode.trainable_nodes(self.labels, self.category))

    # --- text ---------------------------------------------------------------
    @cached_property
    def bag(self) -> DataFrame:
        # read by the weights and by every cascade level: written once as a
        # table bucketed by item id, so scoring levels never reshuffle it
        bag = text.process_title(self.items, self.lexicon, self.stop, words=self.words)
        return write_bucketed(bag, "id", "bag", partitioned=True)

    @cached_property
    def features(self) -> DataFrame:
        return self.bag.select("id", F.col("term").alias("feature"), F.lit(1.0).alias("value"))

    # --- deterministic scoring fixture --------------------------------------
    @cached_property
    def weights(self) -> DataFrame:
        # an item's categories travel as one set: the terms of equal sets are joined into one row before they are
        # told apart, so each row of the bag is aggregated once
        ad_cats = encode.node_rows(self.labels).groupBy("id").agg(F.array_sort(F.collect_set("category")).alias("cats"))
        cat_terms = ad_cats.join(self.bag, "id").select("cats", "term").distinct().select(
            F.explode("cats").alias("cat"), "term").distinct()
        ix = bounded_by(self.index)(self.index.where(F.col("idx") > 0)
                                    .select(F.col("id").alias("cat"), F.col("parent_id").alias("node"), "idx"))
        key = F.concat(F.col("cat").cast("string"), F.lit(":"), F.col("term"))
        # a model artifact in practice (a parquet table): materialised once
        return self._stored(cat_terms.join(ix, "cat").select(
            "node", "idx", F.col("term").alias("feature"),
            ((md5_hash(key) % 2001 - 1000).cast("double") / 1000.0).alias("w")), "weights")

    @cached_property
    def packed(self) -> DataFrame:
        return self._stored(score.pack_weights(self.weights), "packed")

    @cached_property
    def root_packed(self) -> DataFrame:
        """The root model's packed weights: of all nodes' where these are there, else packed alone."""
        if "packed" in self.__dict__:
            return self.packed.where("node = 0")
        return self._stored(score.pack_weights(self.weights.where("node = 0")), "root-packed")
