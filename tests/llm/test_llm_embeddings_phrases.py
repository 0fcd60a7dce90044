"""Phrase mining, whitening and vector near-duplicates against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import docs, edge_rows, prose_rows
from treeclass.llm import collocations, embedding_tiles, whitening, word_blocks
from treeclass.session import Scratch

VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int, row long, tile int, x string, id string, n_links int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7, 3, "x", "y", 5) for i, v in rows], VECTOR_SCHEMA)


# --- op11 ---------------------------------------------------------------------------------------

def phrases_by_hand(rows, min_count, max_words, top):
    f, n, out = defaultdict(Counter), Counter(), []
    fold = {c: c + 32 for c in range(65, 91)}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(fold)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= min_count}
        best = []
        for p, a in found.items():
            score, cut = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            inside = any(b >= a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                best.append((-score, -a, " ".join(p).encode(), count[p[:cut]], count[p[cut:]]))
        out += [(lang, rank, b[2].decode(), -b[1], b[3], b[4], n[lang], -b[0]) for rank, b in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("small,chunk", [(500_000, 4 << 20), (0, 300)])
def test_phrases_equal_brute_force(spark, monkeypatch, small, chunk):
    monkeypatch.setattr(collocations, "SMALL", small)  # frequent groups by broadcast, or dealt by key
    rnd = random.Random(3)
    words = ["New", "york", "city", "of", "the", "é", "漢字", "a-b", "x\x0by"]
    rows = [(rnd.choice(["en", "de", "", None]), "".join(rnd.choice(words) + rnd.choice([" ", "  ", "\t", ". ", "!", "\n", " "])
                                                       for _ in range(rnd.randint(0, 60)))) for _ in range(60)]
    rows += [("en", None), (None, ""), ("en", " \t "), ("en", "new york city " * 4000), ("en", "the of the of the of the")] + [("de", "copy of the city")] * 9
    frame = spark.createDataFrame([(lang, t, 1, "w", 2) for lang, t in rows], "lang string, text string, n int, word string, chunk int").repartition(3)
    got = collocations.collocations(frame, min_count=4, max_words=5, top=25, chunk_bytes=chunk)
    assert sorted(tuple(r) for r in got.collect()) == phrases_by_hand(rows, 4, 5, 25)


def test_phrases_of_edge_rows_and_empty_tables(spark):
    got = collocations.collocations(docs(spark, edge_rows() + prose_rows(40)), min_count=5)
    assert sorted(tuple(r) for r in got.collect()) == phrases_by_hand([("en", t) for _, t in edge_rows() + prose_rows(40)], 5, 5, 2000)
    assert collocations.op11(docs(spark, [])).count() == 0
    assert collocations.op11(docs(spark, [(1, "too rare"), (2, None)])).count() == 0


def test_rare_groups_are_not_rows_of_their_own(spark, monkeypatch):
    rnd, kept, keep = random.Random(4), {}, Scratch.keep

    def counted(self, df, name="kept"):
        out = keep(self, df, name)
        kept[name] = out.count()
        return out
    monkeypatch.setattr(Scratch, "keep", counted)
    monkeypatch.setattr(collocations, "PART_WORDS", 500, raising=False)  # several parts of the groups
    rows = [(i, " ".join(f"w{rnd.randrange(60)}" for _ in range(400)) + " ab cd ef ab cd ef") for i in range(20)]
    got = collocations.collocations(docs(spark, rows), min_count=20, chunk_bytes=5000)
    assert sorted(tuple(r) for r in got.collect()) == phrases_by_hand([("en", t) for _, t in rows], 20, 5, 2000)
    # some 3 600 pairs of frequent words, few of them frequent: what is kept follows the blocks, not the pairs
    assert 0 < kept["groups2"] < 500


def test_words_of_chunks_are_not_rows_of_their_own(spark, monkeypatch):
    kept, keep = {}, Scratch.keep

    def counted(self, df, name="kept"):
        out = keep(self, df, name)
        kept[name] = out.count()
        return out
    frame = type(docs(spark, []))
    joined, join = [], frame.join
    monkeypatch.setattr(Scratch, "keep", counted)
    monkeypatch.setattr(frame, "join", lambda self, other, on=None, how=None: (joined.append(on), join(self, other, on, how))[1])
    rows = [(i, " ".join(f"w{j}" for j in range(500)) + f" a{i} b{i} é") for i in range(30)] + [(None, "w1 w2"), (7, None)]
    got = collocations.collocations(docs(spark, rows), min_count=30, top=10, chunk_bytes=3000)
    assert sorted(tuple(r) for r in got.collect()) == phrases_by_hand([("en", t) for _, t in rows], 30, 5, 10)
    # 30 chunks or so of some 500 frequent words each: 501 rows of words, the others are blocks
    assert ["lang", "word"] not in joined and 501 < kept["groups1"] <= 501 + 8 * kept["word_chunks"] < 1500


def test_words_are_counted_by_language_and_go_back_to_their_chunks(spark):
    chunks = {(1, "en"): {b"a": 3, "é".encode(): 1, b"rare": 1}, (2, "en"): {b"a": 2, b"b": 9}, (3, "de"): {b"a": 4, b"rare": 1}}
    frame = spark.createDataFrame([(c, lang, word_blocks.packed(list(w)), word_blocks.planes(np.array(list(w.values()))))
                                   for (c, lang), w in chunks.items()], "chunk long, lang string, words binary, counts binary")
    for parts in (1, 3, 50):
        for value in ("id", "f"):
            found = word_blocks.counted(frame, parts, 4, value).cache()
            words = {(r.lang, r.word): r for r in found.where("id is not null").collect()}
            assert {k: r.f for k, r in words.items()} == {("en", "a"): 5, ("en", "b"): 9, ("de", "a"): 4}
            assert len({r.id for r in words.values()}) == 3
            back = {r.chunk: r.kept for r in word_blocks.kept_by_chunk(found).collect()}
            for (c, lang), w in chunks.items():
                at, values = word_blocks.kept_words(list(w), [k.asDict() for k in back[c]], parts)
                assert dict(zip(at.tolist(), values.tolist())) == {
                    i: words[lang, x.decode()][value] for i, x in enumerate(w) if (lang, x.decode()) in words}


def test_phrase_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 10 ** 12 + 7, 10 ** 15 + 3, 10 ** 12 + 9, 10 ** 13 + 7
    phrases = spark.createDataFrame([("en", 2, "x y", a), ("en", 1, "x", left), ("en", 1, "y", right)], "lang string, n_words int, phrase string, f long")
    row = collocations.scored(phrases, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert row.score == 1000 * a * n // (left * right)


# --- op12 ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("dims,wanted", [(64, 16), (200, 16), (10, 16), (1, 1), (30, 30)])
def test_jacobi_davidson_equals_dense_solver(dims, wanted):
    rnd = np.random.default_rng(dims)
    a = rnd.standard_normal((dims, dims))
    a = a @ a.T
    values, vectors_, residuals, _ = whitening.eigenpairs(lambda b: a @ b, dims, wanted)
    ref, u = np.linalg.eigh(a)
    assert np.allclose(values, ref[::-1][:wanted], rtol=1e-12)
    assert residuals.max() <= 1e-12 * ref[-1]
    assert np.allclose(np.abs((u[:, ::-1][:, :wanted] * vectors_).sum(axis=0)), 1, atol=1e-8)


def test_jacobi_davidson_takes_clusters_and_zero(spark):
    a = np.diag([5.0, 5, 5, 5, 1, 1 - 1e-9, 0, 0])
    values, u, _, _ = whitening.eigenpairs(lambda b: a @ b, 8, 6)
    assert np.allclose(values, [5, 5, 5, 5, 1, 1], atol=1e-8) and np.allclose(u.T @ u, np.eye(6), atol=1e-12)
    assert np.allclose(whitening.eigenpairs(lambda b: 0 * b, 5, 5)[0], 0)


def test_minres_solves_indefinite_systems():
    rnd = np.random.default_rng(2)
    a = rnd.standard_normal((30, 30))
    a = a + a.T
    rhs = rnd.standard_normal((30, 3))
    assert np.allclose(a @ whitening.minres(lambda v: a @ v, rhs, 200, 1e-10), rhs, atol=1e-6)


def white_by_hand(rows, components):
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    y = (fit * n - sums).astype(float) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return n, ((x * n - sums) ** 2).sum(axis=1), ((x * n - sums).astype(float) / n) @ u / np.sqrt(e), e / np.trace(y.T @ y / n)


def test_whitening_equals_brute_force(spark):
    rnd = np.random.default_rng(5)
    mix = rnd.standard_normal((20, 20))
    data = [(i, (rnd.standard_normal(20) @ mix).tolist()) for i in range(300)]
    data += [(7, data[7][1])] * 5 + [(None, data[3][1])]
    bad = [(900, None), (901, []), (902, [1.0, None] * 10), (903, [float("nan")] * 20), (904, [float("inf")] * 20), (905, [1.0, 2.0])]
    out = whitening.whiten(vectors(spark, data + bad).repartition(3)).toPandas()
    n, deviation, white, explained = white_by_hand(data, 16)
    assert len(out) == 16 * len(data) and set(out.n) == {n} and out.identity_error.max() < 1e-12
    kept = out[out.vec_id.notna()].drop_duplicates(["vec_id", "component"]).set_index(["vec_id", "component"]).sort_index()
    mine = kept.whitened.to_numpy().reshape(-1, 16)
    sign = np.sign((mine * white[:300]).sum(axis=0))
    assert np.allclose(mine * sign, white[:300], atol=1e-9)
    assert kept.deviation.to_numpy().reshape(-1, 16)[:, 0].tolist() == deviation[:300].tolist()
    assert np.allclose(kept.explained.to_numpy().reshape(-1, 16)[0], explained, rtol=1e-9)


def test_whitening_of_small_and_wide_tables(spark):
    assert whitening.op12(vectors(spark, [])).count() == 0
    assert whitening.op12(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    line = whitening.op12(vectors(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])])).toPandas()
    assert set(line.component) == {1} and np.allclose(sorted(line.whitened), [-1.5 ** 0.5, 0, 1.5 ** 0.5])
    # beyond 64 bits: the sums stay exact, the deviation is null
    huge = whitening.op12(vectors(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 5.0])])).toPandas()
    assert huge.deviation.isna().any() and huge.whitened.notna().all()


# --- op13 ---------------------------------------------------------------------------------------

def classes_by_hand(rows, threshold):
    usable = {k: np.array(v, dtype=np.float32).astype(float) for k, (_, v) in enumerate(rows)
              if v and None not in v and np.isfinite(v).all() and any(v)}
    unit = {k: v / np.abs(v).max() for k, v in usable.items()}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    near = {k: [j for j in unit if j != k and len(unit[j]) == len(v) and v @ unit[j] >= threshold] for k, v in unit.items()}
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min(2 ** 63 - 1 if rows[j][0] is None else rows[j][0] for j in seen)
        out.append((i, len(near.get(k, [])), least, least == (2 ** 63 - 1 if i is None else i)))
    return sorted(out, key=str)


@pytest.mark.parametrize("threshold,tile", [(0.95, 16), (0.8, 50), (0.95, None)])
def test_vector_classes_equal_brute_force(spark, threshold, tile):
    rnd = np.random.default_rng(4)
    centres = rnd.standard_normal((6, 24))
    rows = [(i, (centres[i % 6] * (i % 5 < 3) + rnd.standard_normal(24) * rnd.choice([0.05, 0.2, 0.35, 1.0])).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)] + [(3, rows[3][1]), (None, rows[3][1]), (None, None), (300, []), (301, [0.0] * 24),
             (302, [float("nan")] + [1.0] * 23), (303, [None] + [1.0] * 23), (304, [1.0, 2.0]), (305, [2.0, 4.0]), (306, [1e38, 2e38]),
             (307, [float("inf"), 1.0]), (308, [1e-40, 2e-40])]
    got = embedding_tiles.near_duplicates(vectors(spark, rows).repartition(3), threshold, tile=tile)
    assert sorted((tuple(r) for r in got.collect()), key=str) == classes_by_hand(rows, threshold)


def test_vector_classes_of_an_empty_table(spark):
    assert embedding_tiles.op13(vectors(spark, [])).count() == 0
    with pytest.raises(ValueError):
        embedding_tiles.near_duplicates(vectors(spark, []), 0.0)


def test_int8_bounds_hold_for_every_pair():
    rnd = np.random.default_rng(8)
    a, b = (rnd.standard_normal((70, 40)) * rnd.choice([0.01, 1, 50], (70, 40)) for _ in range(2))
    tiles = [embedding_tiles.Tile(np.arange(70).tobytes(), (m / np.linalg.norm(m, axis=1)[:, None]).tobytes(), 40) for m in (a, b)]
    cosine = tiles[0].unit @ tiles[1].unit.T
    for threshold in (0.05, 0.3, 0.6):
        possible = {(int(i), int(j)) for part in embedding_tiles.possible_pairs(*tiles, threshold, False) for i, j in zip(*part)}
        assert {(int(i), int(j)) for i, j in zip(*np.nonzero(cosine >= threshold))} <= possible
        assert len(possible) < 70 * 70  # and they discard


def test_runs_leave_nothing_but_their_result(spark, tmp_path):
    def tables():
        return {t.name for t in spark.catalog.listTables()}
    before = tables()
    collocations.collocations(docs(spark, prose_rows(20)), min_count=3).count()
    assert tables() == before
    with Scratch(spark, "owned") as scratch:
        kept = scratch.keep(spark.range(3), "x")
        assert kept.agg(F.sum("id")).first()[0] == 3
