"""The scoring cascade over a Structured Streaming source of items.

Items arrive as a stream (``readStream``); the model side (lexicon, stop words,
weights, model table, class index) is static.  Every per-item step of the
cascade is stateless across items, so each micro-batch is classified with the
batch operators inside ``foreachBatch`` and appended to a sink: no streaming
state, one result per input row (an id that comes again, in the same batch or a later one, is
classified again), and a restart resumes from the checkpoint in the shared folder
(exactly-once with an idempotent sink keyed by batch id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.operators import score, text
from treeclass.session import Scratch, cut_lineage


def classify_batch(items: DataFrame, lexicon: DataFrame, stop: DataFrame, weights: DataFrame,
                   models: DataFrame, index: DataFrame, margin_digits: int | None = None,
                   bag: DataFrame | None = None, keep=cut_lineage) -> DataFrame:
    """``id, depth, category`` for one batch of ``items(id, title)``."""
    bag = text.process_title(items, lexicon, stop) if bag is None else bag
    feats = bag.select("id", F.col("term").alias("feature"), F.lit(1.0).alias("value"))
    pred = score.cascade_predict(items.select("id"), feats, weights, models, index,
                                 margin_digits=margin_digits, keep=keep)
    return score.cascade_decode(pred)


def classify_stream(stream: DataFrame, lexicon: DataFrame, stop: DataFrame, weights: DataFrame,
                    models: DataFrame, index: DataFrame, out_path: str, checkpoint: str,
                    margin_digits: int | None = None, available_now: bool = True):
    """Start the query; returns the ``StreamingQuery``.  Output: parquet under
    ``out_path/batch=<id>`` (a replayed batch overwrites its own folder)."""
    # the static side is stored once by the caller or here, never cached per stream
    packed = score.pack_weights(weights)
    if packed is not weights:
        packed = cut_lineage(packed)

    def run(batch: DataFrame, batch_id: int) -> None:
        # what a batch stores (its bag and two cascade levels) goes when the batch ends
        with Scratch(batch.sparkSession, f"batch-{batch_id}") as scratch:
            # rows are scored under a number of their own, so a repeated id gives a result per row
            rows = scratch.keep(batch.select("id", "title").withColumn("row", F.monotonically_increasing_id()))
            items = rows.select(F.col("row").alias("id"), "title")
            bag = scratch.keep(text.process_title(items, lexicon, stop))
            out = classify_batch(items, lexicon, stop, packed, models, index, margin_digits, bag, scratch.keep)
            out = out.withColumnRenamed("id", "row").join(rows.select("row", "id"), "row").select("id", "depth", "category")
            out.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
