import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from fixtures import docs, edge_rows, prose_rows
from pyspark.sql import functions as F

from treeclass.llm import components, line_runs, simhash_pivots
from treeclass.llm.common import NULL_ID

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(rows, min_chars=10):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(ASCII)
    number = lambda i: NULL_ID if i is None else i
    first = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            first[key(x)] = min(first.get(key(x), NULL_ID), number(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or first[key(x)] == number(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows", [edge_rows(), prose_rows()], ids=["edge", "prose"])
def test_line_runs_match_brute_force(spark, rows):
    got = sorted((tuple(r) for r in line_runs.op10(docs(spark, rows)).collect()), key=repr)
    assert got == brute_lines(rows)


def test_line_runs_keep_columns_and_compact(spark):
    rows = prose_rows(60)
    frame = docs(spark, rows)
    out = line_runs.dedup_lines(frame, batches=6, fanout=2)
    assert out.columns == frame.columns
    assert out.select("id", "n_lines").distinct().collect() == [("x", 5)]
    kept = sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in out.collect())
    assert kept == [(i, h) for i, _, _, h in sorted(brute_lines(rows))]


def test_runs_hold_each_key_once_and_few_runs(spark):
    runs = line_runs.LineRuns(spark, buckets=2)
    keys = line_runs.line_keys(docs(spark, prose_rows(64)))
    for b in range(5):
        runs.add(keys.where(F.col("id") % 5 == b))
    held = [r for t in runs.tables() for r in t.collect()]
    assert len({(r.h1, r.h2) for r in held}) == len(held) == keys.select("h1", "h2").distinct().count()
    assert len(runs.tables()) <= 3  # 5 batches: levels 0 and 2
    runs.close()


def test_line_runs_empty_table(spark):
    assert line_runs.op10(docs(spark, [])).collect() == []


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    shingles = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, bits=3):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for r, i in zip(root, ids):
        least[r] = min(least.get(r, NULL_ID), NULL_ID if i is None else i)
    return [least[r] for r in root]


@pytest.mark.parametrize("rows", [edge_rows(), prose_rows()], ids=["edge", "prose"])
def test_simhash_matches_brute_force(spark, rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, brute_components(fps, [i for i, _ in rows]))), key=repr)
    assert sorted((tuple(r) for r in simhash_pivots.op7(docs(spark, rows)).collect()), key=repr) == want


@pytest.mark.parametrize("block_rows", [4096, 7], ids=["whole", "cut"])
def test_links_of_random_and_dense_fingerprints(spark, block_rows):
    """Chains and a dense ball of fingerprints; hot keys cut into sub-blocks give the same classes."""
    rnd = random.Random(3)
    fps = {rnd.getrandbits(64) for _ in range(150)} | {0}
    centre = rnd.getrandbits(64)
    for _ in range(60):  # ball: one or two bits off the centre
        fps.add(centre ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    step = rnd.getrandbits(64)
    for _ in range(40):  # chain: three bits a step
        for _ in range(3):
            step ^= 1 << rnd.randrange(64)
        fps.add(step)
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    edges = simhash_pivots.links(frame, block_rows=block_rows)
    roots = {r.node: r.root for r in components.components(edges).collect()}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    got = [roots.get(f, f) for f in signed]
    want = brute_components(fps, list(range(len(fps))))
    assert len(set(want)) < len(fps) - 60
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(fps)) for j in range(i))


def test_pivots_discard_pairs_but_no_link():
    rnd = random.Random(1)
    a = np.array([rnd.getrandbits(64) for _ in range(2000)], dtype=np.uint64)
    b = a.copy()
    for k in range(3):
        b ^= np.uint64(1) << np.array([rnd.randrange(64) for _ in a], dtype=np.uint64)
    table = lambda x: np.bitwise_count(x[:, None] ^ simhash_pivots.PIVOTS[None]).astype(np.int8)
    assert (np.abs(table(a) - table(b)).max(axis=1) <= 3).all()
    far = np.abs(table(a) - table(np.roll(a, 1))).max(axis=1) <= 3
    assert far.mean() < 0.01


def test_components_long_path_and_empty(spark):
    order = list(range(40))
    random.Random(2).shuffle(order)
    path = [(order[i], order[i + 1]) for i in range(39)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 40)}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []
