"""The pipeline's stages, each against a plain version on its own input."""

import re

import pytest
from fixtures import docs, edge_rows, prose_rows
from pyspark.sql import functions as F
from test_llm_index_warc_lpf import brute_contamination, words
from test_llm_lines_simhash import brute_components, brute_fingerprint, brute_lines

import corpus_pipeline
from treeclass.llm.common import NULL_ID

TOXIC = "you are an idiotic pathetic fool"


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    """(docs rows, folder with labels and benchmark)."""
    rows = [(i and i + 2000, t) for i, t in edge_rows()] + prose_rows(90)
    bench = [(1, " ".join(words(dict(rows)[4])[:30])), (2, "some thing that no document has in it at all")]
    rows += [(300 + i, f"{TOXIC} {t}") for i, (_, t) in enumerate(prose_rows(40, seed=9))]
    rows.append((500, "in front " + bench[0][1] + " behind"))
    labels = [(i, 1, int(TOXIC in (t or ""))) for i, t in rows if i is not None and i < 2000]
    d = str(tmp_path_factory.mktemp("pipeline"))
    docs(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return rows, bench, d


def run_stage(spark, name, rows, folder):
    frame = docs(spark, rows)
    out = dict(corpus_pipeline.STAGES)[name](spark, frame, folder)
    if name != "packing":
        assert out.columns == frame.columns and [f.dataType for f in out.schema] == [f.dataType for f in frame.schema]
    return out


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "packing"]


def test_toxicity_stage_drops_toxic_documents_only(spark, case):
    rows, _, d = case
    got = pairs(run_stage(spark, "toxicity", rows, d))
    assert got == sorted(((i, t) for i, t in rows if TOXIC not in (t or "")), key=repr)


def test_line_stage_rewrites_texts(spark, case):
    rows, _, d = case
    out = run_stage(spark, "line_dedup", rows, d).withColumn("h", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()
    want = sorted(((i, h) for i, _, _, h in brute_lines(rows)), key=repr)
    assert sorted(((r.doc_id, r.h) for r in out), key=repr) == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)


def test_simhash_stage_keeps_the_first_of_each_group(spark, case):
    rows, _, d = case
    least = brute_components([brute_fingerprint(t) for _, t in rows], [i for i, _ in rows])
    want = [(i, t) for (i, t), c in zip(rows, least) if (NULL_ID if i is None else i) == c]
    kept = {i for i, _ in want}
    assert pairs(run_stage(spark, "simhash", rows, d)) == sorted(((i, t) for i, t in rows if i in kept), key=repr)


def test_decontamination_stage_drops_contaminated_documents(spark, case):
    rows, bench, d = case
    bad = {x[0] for x in brute_contamination(rows, bench) if x[-1]}
    assert {4, 500} <= bad
    assert pairs(run_stage(spark, "decontamination", rows, d)) == sorted(((i, t) for i, t in rows if i not in bad), key=repr)


def test_rows_with_one_id_or_none_are_judged_one_by_one(spark, case):
    _, bench, d = case
    text = {i: t for i, t in prose_rows(60, seed=11) if i % 8 in (4, 5, 6) and len(t) > 300}
    clean = list(text.values())[:9]
    bad = ["before " + bench[0][1] + " after", bench[0][1]]
    rows = [(None, t) for t in clean[:4]] + [(None, bad[0]), (600, bad[0]), (600, clean[4]), (601, clean[5]), (601, bad[1])]
    assert pairs(run_stage(spark, "decontamination", rows, d)) == sorted(((i, t) for i, t in rows if t not in bad), key=repr)
    rows = [(None, clean[0]), (None, clean[1]), (700, clean[1]), (None, clean[2]), (None, clean[2]), (None, clean[3]), (None, clean[3] + " "),
            (701, clean[4]), (701, clean[5]), (702, clean[5]), (703, clean[6]), (703, clean[1])]
    for frame in (rows, rows[::-1]):
        got = [(i, (t or "").strip()) for i, t in pairs(run_stage(spark, "simhash", frame, d))]
        assert sorted(got, key=repr) == sorted([(None, clean[0]), (700, clean[1]), (None, clean[2]), (None, clean[3]), (701, clean[4]),
                                                (701, clean[5]), (703, clean[6])], key=repr)


def test_stages_take_an_empty_table(spark, case):
    for name, _ in corpus_pipeline.STAGES:
        assert run_stage(spark, name, [], case[2]).collect() == []


def test_run_is_the_stages_in_order(spark, case):
    rows, bench, d = case
    frame = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, d).collect(), frame.schema)
    kept = {r.doc_id: r.text for r in frame.collect()}
    out = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id for r in out} == set(kept)
    assert not any(re.search(TOXIC, t or "") for t in kept.values()) and 500 not in kept
    assert all(len(r.ids) == r.length for r in out)
