"""The stream path: one result per input row, whatever the ids."""

from pyspark.sql import functions as F

from treeclass.operators.taxonomy import category_index
from treeclass.session import scratch_path
from treeclass.streaming import classify_stream


def test_repeated_ids_give_a_result_per_row(spark):
    index = category_index(spark.createDataFrame([(1, 0, ""), (2, 0, ""), (21, 2, ""), (22, 2, "")], "id int, parent_id int, name string"))
    models = spark.createDataFrame([(0, 1), (2, 2)], "node int, level int")
    weights = spark.createDataFrame([(0, 1, "car", 1.0), (2, 1, "red", 0.5)], "node int, idx int, feature string, w double")
    lexicon = spark.createDataFrame([(w, 1, 300, w) for w in ("car", "red", "dom")], "orth string, ordinal int, tag_id int, lemma string")
    stop = spark.createDataFrame([], "orth string")
    folder = scratch_path(spark, "stream-in")
    rows = [(7, "car red"), (7, "car red"), (7, "dom"), (None, "car"), (8, "car")]
    spark.createDataFrame(rows, "id long, title string").coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema("id long, title string").parquet(folder)
    out = scratch_path(spark, "stream-out")
    classify_stream(stream, lexicon, stop, weights, models, index, out, scratch_path(spark, "stream-ckpt")).awaitTermination()
    got = sorted(((r.id, r.depth, r.category) for r in spark.read.parquet(out).select("id", "depth", "category").collect()), key=str)
    # the margin of "car" passes the first gate (sigmoid(1) = 0.73) once and is not added up
    assert got == sorted([(7, 2, 22), (7, 2, 22), (7, 0, 0), (None, 2, 21), (8, 2, 21)], key=str)
    assert spark.read.parquet(out).where(F.col("depth") > 2).isEmpty()


def test_stream_query_over_a_folder_and_over_a_file(spark, tmp_path):
    from treeclass.plans import registry
    texts = ["the car stops", "das Auto und car", "coche rojo car", None, "cars and more cars"]
    docs = spark.createDataFrame([(i, t, ("de", "en", "es")[i % 3], f"src{i}") for i, t in enumerate(texts * 4)],
                                 "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    folder, single = str(tmp_path / "folder"), str(tmp_path / "single")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    labels.write.parquet(f"{single}/labels.parquet")
    docs.coalesce(1).write.parquet(f"{single}/part")
    next((tmp_path / "single" / "part").glob("*.parquet")).rename(tmp_path / "single" / "documents.parquet")
    for d in (folder, single):
        want = sorted(tuple(r) for r in registry.cascade_decode(spark, d).collect())
        assert len(want) == 20
        assert sorted(tuple(r) for r in registry.stream_cascade_decode(spark, d).collect()) == want
