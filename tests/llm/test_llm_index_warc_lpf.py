import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
from fixtures import docs, edge_rows, prose_rows
from pyspark.sql import functions as F

from treeclass.llm import decontaminate, lpf_dedup, warc
from treeclass.llm.common import NULL_ID, remove_path
from treeclass.session import scratch_path

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BENCH = "item_id long, text string, doc_id int, words string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


def brute_contamination(rows, items, size=13):
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            b = words(text)
            n = min(size, len(b))
            windows = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def contamination_case():
    rows = prose_rows(60) + [(i and i + 1000, t) for i, t in edge_rows()]
    source = dict(rows)
    items = [(1, " ".join(words(source[4])[:40])), (2, " ".join(words(source[2])[-25:]).upper()), (10, "one two"), (11, "漢字"),
             (12, None), (13, "... "), (3, "never seen at all"), (1, "alpha beta"), (20, "the the the the the the the the the the the the the")]
    rows += [(2000, "x " + items[0][1] + ", " + items[1][1]), (2001, "the " * 50), (2002, "One--TWO one two"), (2001, "the " * 14)]
    return rows, items


@pytest.mark.parametrize("block", [8 << 20, 120], ids=["one block", "blocks"])
def test_contamination_matches_brute_force(spark, block):
    rows, items = contamination_case()
    frame = docs(spark, rows)
    bench = spark.createDataFrame([(i, t, 1, "w") for i, t in items], BENCH)
    index = decontaminate.build_index(frame, shard_bytes=20_000)
    found = decontaminate.matches(index, bench, block_bytes=block)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    got = found.select("doc_id", "n_words", n_hit.alias("h"), F.size("items").alias("n"),
                       F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("s")).collect()
    want = brute_contamination(rows, items)
    assert sorted((tuple(r) for r in got), key=repr) == [x[:5] for x in want]
    if block > 1000:
        assert sorted((tuple(r) for r in decontaminate.op5(frame, bench).collect()), key=repr) == want


def test_contamination_empty_tables(spark):
    rows, items = contamination_case()
    bench = spark.createDataFrame([(i, t, 1, "w") for i, t in items], BENCH)
    assert decontaminate.op5(docs(spark, []), bench).collect() == []
    assert {r.n_hit for r in decontaminate.op5(docs(spark, rows), bench.limit(0)).collect()} == {0}


def test_proximity_allows_words_off_their_places(spark):
    item = "red fox jumps over lazy dogs near old stone walls every single morning"
    rows = [(1, item), (2, item.replace("over", "right over")), (3, item.replace("lazy dogs", "dogs lazy")),
            (4, " ".join(reversed(item.split()))), (5, item.replace("fox", "cat")), (6, "red fox jumps over lazy dogs near"), (7, "old " + item[-40:])]
    index = decontaminate.build_index(docs(spark, rows))
    bench = spark.createDataFrame([(1, item, 1, "w")], BENCH)
    hit = lambda slop: {r.doc_id for r in decontaminate.matches(index, bench, slop).collect() if r.items}
    assert hit(0) == {1} and hit(1) == {1, 2, 3}


def brute_proximity(rows, items, slop, size):
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            b = words(text)
            n = min(size, len(b))
            for window in {tuple(b[k:k + n]) for k in range(len(b) - n + 1)}:
                for s in range(-n - slop, len(w) + slop):
                    if all(term in w[max(0, s + k - slop):max(0, s + k + slop + 1)] for k, term in enumerate(window)):
                        hit.update(range(max(0, s), min(s + n, len(w))))
                        found.add(str(item))
        out.append((i, len(w), sorted(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("slop", [0, 1, 2])
def test_proximity_matches_brute_force_in_any_shards(spark, slop):
    rnd = random.Random(9)
    rows = [(1, "b a c"), (2, "b a c a a a"), (3, "c c c b a c"), (4, "x a"), (5, "b x"), (6, "a"), (7, "b"), (8, ""), (9, "b c a")]
    rows += [(10 + i, " ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(0, 12)))) for i in range(60)]
    items = [(1, "a b c"), (2, "a b"), (3, "d"), (4, "e f g a b"), (5, "a a b"), (6, "g f e d c b a")]
    bench = spark.createDataFrame([(i, t, 1, "w") for i, t in items], BENCH)
    frame = docs(spark, rows).coalesce(1)
    want = brute_proximity(rows, items, slop, 4)
    assert slop != 1 or {i for i, _, _, found in want if "1" in found} >= {1, 2, 3}
    for shard in (1, 40, 1 << 20):
        found = decontaminate.matches(decontaminate.build_index(frame, shard), bench, slop, 4).collect()
        got = [(r.doc_id, r.n_words, [p for s in r.spans for p in range(s.start, s.start + s.length)], sorted(r["items"])) for r in found]
        assert sorted(got) == want, shard


def test_word_hashes_agree_with_words():
    data = "Ünïcode don't A1b2-c3 漢字 x" * 3
    starts, h = decontaminate.words(data.encode())
    plain = words(data)
    assert len(h) == len(plain)
    assert len(set(h.tolist())) == len(set(plain))
    assert all((h[i] == h[j]) == (plain[i] == plain[j]) for i in range(len(h)) for j in range(i))


# --- WARC -------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, payload string, record_id int, owner int"


def page_rows():
    big, huge = "<p>ä" * 300, "<html>" + "x" * 1_500_000
    rows = [(1, "u1", big), (2, "u2", big), (3, None, big), (4, "u4", "small"), (5, "u5", "small"), (6, "u6", None), (7, "u7", ""),
            (8, "http://a/\r\nX: 1", huge), (9, "ü", huge), (10, "u", "y" * 1000), (11, "u", "y" * 1000), (12, "u", "y" * 999),
            (13, "u", "y" * 999), (14, "u", "a\r\n\r\nb" * 400)]
    return [(*r, "p", 1, 2) for r in rows]


def brute_pages(rows):
    data = {r[0]: (r[2] or "").encode() for r in rows}
    out = []
    for i, d in data.items():
        owner = max(j for j, e in data.items() if e == d)
        again = len(d) >= 1000 and owner != i
        out.append((i, len(d), hashlib.sha1(d).hexdigest(), "revisit" if again else "response", owner if again else None))
    return sorted(out)


def test_pages_round_trip(spark):
    pages = spark.createDataFrame(page_rows(), PAGES)
    assert sorted(tuple(r) for r in warc.op4(pages).collect()) == brute_pages(page_rows())


def test_repeated_pages_and_null_ids_match_the_sql(spark):
    big, other = "<p>ä" * 300, "z" * 2000
    rows = ([(1, big)] * 3 + [(9, big)] * 2 + [(2, big), (9, other), (3, other), (3, "short"), (3, other + "!"), (4, "short"), (4, "short"),
            (None, big), (None, big), (None, "w" * 1500), (None, "w" * 1500), (None, None), (5, "q" * 1000), (5, "q" * 1000)])
    pages = spark.createDataFrame([(i, "u", h, "p", 1, 2) for i, h in rows], PAGES)
    got = sorted((tuple(r) for r in warc.op4(pages).collect()), key=repr)
    data = [(i, (h or "").encode()) for i, h in rows]
    want = []
    for i, d in data:  # the SQL, row by row
        owner = max((j for j, e in data if e == d and j is not None), default=None) if len(d) >= 1000 else None
        again = i is not None and owner is not None and i < owner
        want.append((i, len(d), hashlib.sha1(d).hexdigest(), "revisit" if again else "response", owner if again else None))
    assert got == sorted(want, key=repr)
    spark.udf.register("strlen", lambda x: len(x.encode()), "long")
    pages.createOrReplaceTempView("pages")
    assert got == sorted((tuple(r) for r in spark.sql(warc.ORACLE_SQL).collect()), key=repr)
    spark.catalog.dropTempView("pages")
    records = warc.page_records(pages).collect()
    assert len(records) == len(rows) and all(r.payload is not None for r in records if r.record_type == "response")


def test_archives_many_files_push_down_and_append(spark):
    path = scratch_path(spark, "warc-test")
    rows = warc.page_records(spark.createDataFrame(page_rows(), PAGES)).repartition(3)
    warc.write_archives(rows, path, file_bytes=500)
    warc.write_archives(rows.where("record_type = 'response'"), path)  # adds, keeps the others
    n, responses = len(page_rows()), sum(r[3] == "response" for r in brute_pages(page_rows()))
    everything = warc.read_archives(spark, path)
    assert everything.count() == n + responses
    asked = warc.read_archives(spark, path, "record_id string, record_type string, content_length long").where(
        "record_type = 'revisit' and content_length < 1000")
    assert "record_type" not in asked._jdf.queryExecution().executedPlan().toString().split("Filter")[-1].split("BatchScan")[0]
    assert asked.count() == n - responses
    system, root = warc.file_system(path)
    assert len(system.get_file_info(pafs.FileSelector(root))) > 5
    remove_path(spark, path)


def test_schemes_of_spark_are_known_to_arrow(tmp_path):
    assert [warc.arrow_uri(x) for x in ("s3a://b/c", "s3n://b/s3a://c", "s3://b", "hdfs://h/c", "/s3a")] == [
        "s3://b/c", "s3://b/s3a://c", "s3://b", "hdfs://h/c", "/s3a"]
    assert warc.file_system(f"file://{tmp_path}")[1] == warc.file_system(str(tmp_path))[1] == str(tmp_path)


def test_payloads_are_not_inflated_when_unwanted(tmp_path):
    row = {"record_type": "response", "record_id": "<a>", "warc_date": None, "target_uri": "u", "refers_to": None, "digest": "sha1:x",
           "payload": np.random.default_rng(1).bytes(200_000)}
    good, bad = warc.member(warc.record(row)), bytearray(warc.member(warc.record(row | {"record_id": "<b>"})))
    bad[100_000] ^= 0xFF  # damaged payload: inflating it would fail
    plain = zlib.compressobj(6, zlib.DEFLATED, 31)  # a member without the size field
    other = plain.compress(warc.record(row | {"record_id": "<c>"})) + plain.flush()
    path = tmp_path / "x.warc.gz"
    path.write_bytes(good + bytes(bad) + other + good)
    with open(path, "rb") as f:
        assert [x["record_id"] for x, _ in warc.records(f, lambda _: True, False)] == ["<a>", "<b>", "<c>", "<a>"]
    with open(path, "rb") as f:
        got = list(warc.records(f, lambda x: x["record_id"] != "<b>", True))
    assert [p == row["payload"] for _, p in got] == [True] * 3
    with open(path, "rb") as f, pytest.raises((ValueError, zlib.error)):
        list(warc.records(f, lambda _: True, True))


def test_pages_empty_table(spark):
    assert warc.op4(spark.createDataFrame([], PAGES)).collect() == []


# --- longest previous factors -----------------------------------------------------------------

def brute_removed(rows, size=50):
    first = {}
    number = lambda i: NULL_ID if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - size + 1):
            first[b[p:p + size]] = min(first.get(b[p:p + size], NULL_ID), number(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - size + 1):
            if first[b[p:p + size]] < number(i):
                gone[p:p + size] = True
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0])
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def lpf_rows():
    rnd = random.Random(8)
    bits = [bytes(rnd.choice(b"abcd ") for _ in range(rnd.randint(30, 90))).decode() for _ in range(25)]
    mixed = [(100 + i, "".join(rnd.choice(bits)[rnd.randint(0, 9):] for _ in range(rnd.randint(1, 6)))) for i in range(60)]
    return [(i, t[:3000] if t else t) for i, t in edge_rows()] + mixed + [(300, "z" * 5000), (301, "é" + "z" * 60), (302, "z" * 49), (303, "z" * 50)]


@pytest.mark.parametrize("hot", [250_000, 20], ids=["usual", "hot keys"])
def test_lpf_matches_brute_force(spark, hot, monkeypatch):
    rows = lpf_rows()
    out = lpf_dedup.dedup_substrings(docs(spark, rows).repartition(3), hot)
    got = [tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()]
    assert sorted(got, key=repr) == brute_removed(rows)


def test_lpf_op_and_empty_table(spark):
    rows = prose_rows(80)
    assert sorted((tuple(r) for r in lpf_dedup.op8(docs(spark, rows)).collect()), key=repr) == brute_removed(rows)
    assert lpf_dedup.op8(docs(spark, [])).collect() == []


def test_has_earlier_is_the_previous_or_next_smaller_test():
    rnd = np.random.default_rng(2)
    text = rnd.integers(97, 99, 4000).astype(np.uint8)
    text[1000:1100] = text[2000:2100]
    text[3000:3080] = text[2010:2090]
    starts = np.arange(0, 3950)
    doc = starts // 500
    order, same = lpf_dedup.window_order(text, starts)
    window = [text[s:s + 50].tobytes() for s in starts]
    assert [window[i] for i in order] == sorted(window)
    least = {}
    for w, d in zip(window, doc):
        least[w] = min(least.get(w, 99), d)
    assert lpf_dedup.has_earlier(order, same, doc).tolist() == [bool(least[w] < d) for w, d in zip(window, doc)]
