import base64
import collections
import random
import re
import zlib

import numpy as np
import pytest
from fixtures import blank_rows, docs, edge_rows, prose_rows
from pyspark.sql import functions as F

from treeclass.llm import curve_packing, fertility, pseudo_likelihood, token_edits, tokens, toxicity

RANKS, PIECES = tokens.file(tokens.RANKS), tokens.file(tokens.PIECES)


# --- toxicity ---------------------------------------------------------------------------------

def toxic_rows(n=600):
    """Label 1 for two insults, and for a mild word only together with a group word."""
    rnd = random.Random(4)
    words = ["w" + "".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        kind = i % 6
        add = {0: ["idiotic"], 1: ["mild", "group"], 2: ["mild"], 3: ["group"]}.get(kind, [])
        for w in add:
            text.insert(rnd.randrange(len(text)), w)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(kind in (0, 1))))
    return rows, labels


def test_toxicity_learns_words_and_pairs_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    truth = {i: y for i, _, y in labels}
    out = toxicity.op1(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {r.doc_id: r.held_out for r in out} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in truth}
    held = [r for r in out if r.held_out]
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_toxicity_edges(spark):
    rows, labels = toxic_rows(80)
    frame = docs(spark, edge_rows() + rows)
    table = spark.createDataFrame(labels + [(None, 1, 1), (2, 1, None), (99_999, 1, 1), (0, 1, 0)], "doc_id long, quality int, toxic int")
    out = toxicity.op1(frame, table).collect()
    assert len(out) == len(edge_rows()) + 80
    empty = {r.score for r in out if r.doc_id in (2, 3, 4) and r.doc_id not in dict(rows)}
    assert len(empty) <= 1
    none = toxicity.op1(frame, table.limit(0))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}
    assert toxicity.op1(docs(spark, []), table).collect() == []
    kept = toxicity.with_scores(frame, toxicity.fit(frame, table), "s")
    assert kept.columns == [*frame.columns, "s"]


def test_machine_margin_is_the_pairwise_sum():
    rnd = np.random.default_rng(1)
    m = toxicity.Machine(np.arange(6), 0.3, rnd.standard_normal(6), rnd.standard_normal((6, 4)))
    at = np.array([0, 2, 5])
    pairs = sum(m.factors[i] @ m.factors[j] for i in at for j in at if i < j)
    assert np.isclose(m.margin(at), 0.3 + m.weights[at].sum() + pairs)


# --- edit-aware token counts ------------------------------------------------------------------

def test_edits_match_full_encoding(monkeypatch):
    counter = token_edits.Counter(RANKS)
    encode = tokens.encoder(RANKS).encode_ordinary
    rnd = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "'ll", "'", "12", "é", "!", "word ", "\t", "漢"]
    for _ in range(3000):
        monkeypatch.setattr(token_edits, "LEAF", rnd.choice([1, 2, 4, 16]))
        text = "".join(rnd.choice(bits) for _ in range(rnd.choice([0, 1, 3, 10, 40, 150])))
        edits = [dict(start=(a := rnd.randint(0, len(text))), end=a + rnd.choice([0, 0, 1, 3, 200]),
                      replacement=rnd.choice(["", None, " ", "x", "'ll", "long text  \n here"])) for _ in range(rnd.choice([0, 1, 2, 5]))]
        used, skipped = token_edits.usable(edits, len(text))
        assert len(used) + skipped == len(edits)
        chars, counts = token_edits.plant(text, counter)
        assert counts.total == len(encode(text))
        new, _ = token_edits.edit(text, chars, counts, used, counter)
        want = text
        for a, b, r in reversed(used):
            want = want[:a] + r + want[b:]
        assert (new, counts.total, chars.total) == (want, len(encode(want)), len(want))


def test_edits_encode_only_near_the_edit():
    counter = token_edits.Counter(RANKS)
    text = "some words of a long text " * 4000
    chars, counts = token_edits.plant(text, counter)
    _, encoded = token_edits.edit(text, chars, counts, [(50_000, 50_004, "other")], counter)
    assert encoded <= 4 * token_edits.LEAF
    assert (chars.nodes[1:chars.size] == chars.nodes[2::2] + chars.nodes[3::2]).all()


def test_op2_matches_full_encoding(spark):
    rows = edge_rows() + blank_rows() + [(20, "write to me.you@example.org or +49 30 1234567, see https://x.y/z?q now"), (21, "a@b")]
    def encode(text):  # the JSON tokenizer, with special tokens as ordinary text
        return tokenizer.encode(text, add_special_tokens=False).ids
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokens.file("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    trees = token_edits.build_trees(token_edits.redactions(docs(spark, rows)), RANKS)
    out = token_edits.apply_edits(trees, RANKS).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by_id[20].text == "Source: s\nwrite to [removed] or [removed], see [removed] now"
    assert by_id[2].text == "Source: s\n" and by_id[2].n_tokens_before == 0
    for r in out:
        assert r.n_tokens == len(encode(r.text)) == r.token_tree[1]
    assert sorted(r.n_tokens_before for r in out) == sorted(len(encode(t or "")) for _, t in rows)
    assert token_edits.op2(docs(spark, []), RANKS).collect() == []


# --- masked pseudo-likelihood -----------------------------------------------------------------

def brute_log_prob(ids, p):
    """One token at a time, with a plain softmax over classes and words."""
    total = 0.0
    soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    padded = [pseudo_likelihood.PAD] * 2 + list(ids) + [pseudo_likelihood.PAD] * 2
    for i, t in enumerate(ids):
        around = [padded[i], padded[i + 1], padded[i + 3], padded[i + 4]]
        h = np.tanh(np.concatenate([p["embed"][a] for a in around]) @ p["inner"] + p["inner_bias"])
        c, w = divmod(t, pseudo_likelihood.PER_CLASS)
        total += np.log(soft(h @ p["classes"] + p["class_bias"])[c]) + np.log(soft(h @ p["words"][c] + p["word_bias"][c])[w])
    return total


def test_scores_match_brute_force_and_training_helps(spark):
    rnd = random.Random(2)
    pairs = [("red", "car"), ("blue", "sky"), ("green", "tree")]
    texts = [" ".join(w for _ in range(30) for w in ("the", *rnd.choice(pairs))) for _ in range(150)]
    rows = [(i + 100, t) for i, t in enumerate(texts)] + edge_rows()[:5]
    frame = docs(spark, rows)
    words, params = pseudo_likelihood.train(frame)
    assert words["the"] == 0 and len(words) <= pseudo_likelihood.VOCABULARY - pseudo_likelihood.BUCKETS
    p = pseudo_likelihood.split(params)
    out = pseudo_likelihood.scores(frame, words, params).collect()
    for r, (i, t) in list(zip(sorted(out, key=lambda r: r.doc_id), sorted(rows, key=lambda r: r[0])))[::17]:
        ids = [words[w] for w in (t or "").lower().split()]
        assert r.n_tokens == len(ids) and np.isclose(r.log_prob, brute_log_prob(ids, p), rtol=1e-3, atol=1e-3)
    good = pseudo_likelihood.scores(spark.createDataFrame([(1, texts[0]), (2, " ".join(reversed(texts[0].split())))], "doc_id long, text string"),
                                    words, params).orderBy("doc_id").collect()
    assert good[0].mean_log_prob > good[1].mean_log_prob + 0.3  # word order counts
    none = pseudo_likelihood.scores(docs(spark, [(1, None)]), words, params).first()
    assert (none.n_tokens, none.log_prob, none.mean_log_prob) == (0, 0.0, None)
    assert pseudo_likelihood.op3(docs(spark, [])).collect() == []


def test_many_matches_are_placed_right(spark):
    texts = ["".join(f"w{i} é𝄞 me{i}@x.org, " for i in range(30_000)), "a@b", "a@b c@d", "none", "", None]
    found = {r.doc_id: r.edits for r in token_edits.redactions(docs(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        want = [m.span() for m in re.finditer(r"[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+", text or "")]
        assert found[i][0].replacement == "Source: s\n" and [(e.start, e.end) for e in found[i][1:]] == want


def test_long_numbers_are_replaced_whole(spark):
    numbers = ["1" * 100, "+" + "12 34-56 " * 30 + "7", "9" * 100_000, "1234567", "12-34-56"]
    frame = docs(spark, [(i, f"call {x} now") for i, x in enumerate(numbers)])
    out = token_edits.apply_edits(token_edits.build_trees(token_edits.redactions(frame), RANKS), RANKS).collect()
    want = ["[removed]"] * 3 + ["1234567", "[removed]"]
    assert {r.doc_id: r.text for r in out} == {i: f"Source: s\ncall {x} now" for i, x in enumerate(want)}


def test_vocabulary_grows_and_rare_words_have_their_own_probability(spark):
    rnd = random.Random(3)
    common = [f"c{i}" for i in range(1500)]
    texts = [" ".join(rnd.choice(common) for _ in range(2000)) + " seldom" * (1 + i % 3) + f" once{i}" for i in range(700)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, texts[8]), (901, None), (902, "once1 seldom once1")]
    frame = docs(spark, rows)
    counts = pseudo_likelihood.word_counts(frame).cache()
    words, params = pseudo_likelihood.train(frame, 1, counts)
    n = {r.word: r.n for r in counts.collect()}
    side = int(np.ceil(sum(n.values()) ** 0.25))
    assert side > pseudo_likelihood.CLASSES and len(words) == side * side - side * side // 8 > 896
    base = collections.Counter()
    for w in n.keys() - words.keys():
        base[words[w]] += n[w]
    assert sum(words.rare) == sum(base.values())
    extra = [(901, "seldom neverseen once3")]
    rows += extra
    frame = docs(spark, rows)
    plain, out = (sorted(pseudo_likelihood.scores(frame, words, params, c).collect(), key=repr) for c in (None, counts))
    order = lambda x: (x.doc_id is None, x.doc_id or 0, x.n_tokens)
    plain, out = sorted(plain, key=order), sorted(out, key=order)
    assert len(out) == len(rows)
    texts_of = sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, len((x[1] or "").split())))
    for p, r, (i, t) in zip(plain, out, texts_of):
        own = sum(np.log(n.get(w, 0.5) / (base[words[w]] + 0.5)) for w in (t or "").split() if w not in words)
        assert r.doc_id == p.doc_id == i and np.isclose(r.log_prob, p.log_prob + own, rtol=1e-6, atol=1e-6)
    seldom, made_up = (pseudo_likelihood.scores(docs(spark, [(1, w)]), words, params, counts).first().log_prob
                       - pseudo_likelihood.scores(docs(spark, [(1, w)]), words, params).first().log_prob
                       + np.log(base[words[w]] + 0.5) for w in ("once1", "neverseen"))
    assert seldom > made_up + 0.5


def test_scores_that_cannot_leave_the_range_are_not_looked_at():
    rnd = np.random.default_rng(1)
    ids = np.array([pseudo_likelihood.PAD] * 2 + rnd.integers(0, 1024, 3000).tolist() + [pseudo_likelihood.PAD] * 2)
    at, around = pseudo_likelihood.contexts(ids)
    for factor, small in ((1, True), (40, False)):
        p = pseudo_likelihood.split(pseudo_likelihood.fresh().astype(np.float64) * factor)
        assert pseudo_likelihood.bounded(p) == small
        got = pseudo_likelihood.forward(p, around, ids[at], small=pseudo_likelihood.bounded(p))
        assert np.isfinite(got).all() and np.isclose(got.sum(), brute_log_prob(ids[at], p), rtol=1e-4)
    trainer = pseudo_likelihood.Trainer(pseudo_likelihood.fresh())
    before = trainer.vector.copy()
    for _ in range(pseudo_likelihood.LOOKED_AT):  # what a trainer takes for granted between two looks
        trainer.learn(ids)
    moved = np.abs(trainer.vector - before).max()
    assert 0 < moved < pseudo_likelihood.RATE * pseudo_likelihood.LOOKED_AT
    assert pseudo_likelihood.LARGE + pseudo_likelihood.RATE * pseudo_likelihood.LOOKED_AT * (pseudo_likelihood.HIDDEN + 1) < 80


def test_texts_are_cut_into_words_once(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "CHUNK", 2000)  # several chunks a task, of several slices
    monkeypatch.setattr(pseudo_likelihood, "TASK_BYTES", 500)
    read = spark.sparkContext.accumulator(0)
    rows = [(i, f"The the {'red' if i % 3 else 'blue'} car once{i} " * (1 + i % 9)) for i in range(200)] + [
        (7, "the the"), (None, "lost"), (300, None), (301, " "), (302, "long " * 3000)]

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch
    frame = docs(spark, rows).select("doc_id", "text").repartition(3).mapInArrow(counted, "doc_id long, text string")
    out = pseudo_likelihood.op3(frame).collect()
    assert read.value == len(rows)  # not once more for each round, nor for the scores
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.n_tokens) for r in out), key=key) == sorted(((i, len((t or "").split())) for i, t in rows), key=key)
    assert all((r.mean_log_prob is None) == (r.n_tokens == 0) and r.log_prob <= 0 for r in out)
    want = collections.Counter(w for _, t in rows for w in (t or "").lower().split())
    assert {r.word: r.n for r in pseudo_likelihood.word_counts(docs(spark, rows)).collect()} == want


def test_chunks_are_scored_as_their_texts(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(f"w{int(rnd.expovariate(0.003))}" for _ in range(rnd.randint(0, 300)))) for i in range(120)]
    frame = docs(spark, rows)
    counts = pseudo_likelihood.word_counts(frame).cache()
    words, params = pseudo_likelihood.train(frame, 2, counts)
    n, p = {r.word: r.n for r in counts.collect()}, pseudo_likelihood.split(params)
    assert len(words) < len(n)  # some are rare
    out = {r.doc_id: r.log_prob for r in pseudo_likelihood.scores(frame, words, params, counts.where("word != 'w1'")).collect()}
    for i, t in rows[::12]:
        ids = [words[w] for w in t.split()]
        own = sum(np.log(n[w] / (words.rare[words[w] - words.pad + words.buckets] + 0.5)) for w in t.split() if w not in words)
        assert np.isclose(out[i], brute_log_prob(ids, p) + own, rtol=1e-3, atol=1e-3)


def test_gradients_match_differences():
    rnd = np.random.default_rng(0)
    vector = pseudo_likelihood.fresh().astype(np.float64)
    ids = np.array([pseudo_likelihood.PAD] * 2 + rnd.integers(0, 60, 20).tolist() + [pseudo_likelihood.PAD] * 2)
    at, around = pseudo_likelihood.contexts(ids)
    grad = np.zeros(pseudo_likelihood.SIZE)
    pseudo_likelihood.forward(pseudo_likelihood.split(vector), around, ids[at], pseudo_likelihood.split(grad))
    loss = lambda v: -pseudo_likelihood.forward(pseudo_likelihood.split(v), around, ids[at]).sum()
    for i in np.argsort(-np.abs(grad))[:40:4]:
        step = np.zeros_like(vector)
        step[i] = 1e-5
        assert np.isclose((loss(vector + step) - loss(vector - step)) / 2e-5, grad[i], rtol=1e-4)


def random_ids(rnd, n, top):
    return np.array([pseudo_likelihood.PAD] * 2 + rnd.integers(0, top, n).tolist() + [pseudo_likelihood.PAD] * 2)


def test_a_softmax_runs_over_the_tokens_of_many_classes(monkeypatch):
    ids, calls, softmax = random_ids(np.random.default_rng(4), 3000, 1024), [], pseudo_likelihood._softmax
    monkeypatch.setattr(pseudo_likelihood, "_softmax", lambda *a: calls.append(1) or softmax(*a))
    at, around = pseudo_likelihood.contexts(ids)
    p = pseudo_likelihood.split(pseudo_likelihood.fresh().astype(np.float64))
    got = pseudo_likelihood.forward(p, around, ids[at])
    assert len(calls) <= 2 * -(-3000 // pseudo_likelihood.BLOCK)  # not one more for each class
    assert np.isclose(got.sum(), brute_log_prob(ids[at], p), rtol=1e-6)


def test_gradients_do_not_depend_on_blocks(monkeypatch):
    rnd = np.random.default_rng(6)
    p, ids = pseudo_likelihood.split(pseudo_likelihood.fresh().astype(np.float64)), random_ids(rnd, 700, 300)
    at, around = pseudo_likelihood.contexts(ids)
    found = []
    for block in (1000, 64, 7):
        monkeypatch.setattr(pseudo_likelihood, "BLOCK", block)
        vector = np.zeros(pseudo_likelihood.SIZE)
        grads = pseudo_likelihood.split(vector)
        log_p = [pseudo_likelihood.forward(p, around, ids[at], grads) for _ in range(2)][1]  # set, not added to the ones before
        found.append((log_p, vector))
    for log_p, vector in found[1:]:
        assert np.allclose(log_p, found[0][0]) and np.allclose(vector, found[0][1])


@pytest.mark.parametrize("tops", [(40, 700, 300), (1024, 40)])
def test_steps_are_those_over_all_parameters(tops):
    rnd = np.random.default_rng(7)
    trainer, want = pseudo_likelihood.Trainer(pseudo_likelihood.fresh()), pseudo_likelihood.fresh().astype(np.float64)
    squares = np.full(len(want), 1e-2)
    for top in tops:  # few of the classes, most, all
        ids = random_ids(rnd, 500, top)
        trainer.learn(ids)
        at, around = pseudo_likelihood.contexts(ids)
        grad = np.zeros(len(want))
        pseudo_likelihood.forward(pseudo_likelihood.split(want), around, ids[at], pseudo_likelihood.split(grad))
        grad /= pseudo_likelihood.STEP ** 0.5
        squares += grad * grad
        want -= pseudo_likelihood.RATE * grad / np.sqrt(squares)
        assert np.allclose(trainer.vector, want, atol=1e-4)


def test_words_are_cut_as_python_cuts_them():
    plain = ["a b\tc\r\nd\x0be\x0cf", "", " B  b ", "É\u200bß İ ΑΣ 语 𝄞", "\ufeff x\u180ey \x1b"]
    other = ["a\x1cb", "\x1fa c", "a\u3000", "\x85", "a \u2028 b\xa0c", "\u1680 d\u2009e"]
    for texts in (plain, other, plain + other, ["", " "], [], *([t] for t in plain + other)):
        tokens, sizes, words = pseudo_likelihood._cut([t.lower().strip() for t in texts])
        want = [t.lower().split() for t in texts]
        assert tokens.to_pylist() == [w for t in want for w in t] and sizes.to_pylist() == [len(t) for t in want]
        assert words.decode() == "\n".join(tokens.dictionary.to_pylist())


# --- fertility --------------------------------------------------------------------------------

def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count, hit = collections.Counter(windows), [False] * len(words)
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit[i:i + 8] = [True] * 8
    failed = len(words) < 20 or 100 * sum(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, sum(hit), failed


def test_fertility_base_and_values(spark):
    rows = edge_rows() + [(i + 1000, t) for i, t in prose_rows(40)] + [(100, "a #b *c | <d> $ %"), (101, "one two three four five six seven eight " * 3),
                                          (102, "x\nx\n \n \nx"), (103, " ".join(f"слово{i}" for i in range(30)))]
    out = fertility.op6(docs(spark, rows), RANKS, PIECES).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out), key=repr)
    assert got == sorted(((i, *brute_base(t)) for i, t in rows), key=repr)
    assert {r.doc_id: r.script for r in out}[103] == "cyrillic"
    encode, pieces = tokens.encoder(RANKS).encode_ordinary, tokens.pieces(PIECES)
    for r in out:
        text = dict(rows)[r.doc_id] or ""
        words = fertility.WORD.findall(text)
        if not words or r.doc_id == 5:
            continue
        ids = [i for w in words for i in pieces.encode(w)]
        p = np.array(list(collections.Counter(ids).values())) / len(ids)
        assert np.isclose(r.chars_per_token, sum(map(len, words)) / sum(len(encode(" " + w)) for w in words))
        assert np.isclose(r.fallback_share, sum(pieces.is_byte(i) for i in ids) / len(ids))
        assert np.isclose(r.entropy, -(p * np.log2(p)).sum())
    assert fertility.op6(docs(spark, []), RANKS, PIECES).collect() == []


def test_bands_reject_encoded_data_and_keep_prose(spark):
    rnd = random.Random(6)
    junk = " ".join("".join(rnd.choice("ĀāĂ㐀㐁ꙮ") for _ in range(8)) for _ in range(60))
    rows = [(1, "The quick brown fox jumps over the lazy dog while twenty other animals watch them from a hill near the old mill."),
            (2, junk), (3, "Быстрая лиса прыгает через ленивую собаку, пока двадцать других зверей смотрят на них с холма у старой "
             "мельницы возле реки под синим летним небом над тихой деревней")]
    kept = {r.doc_id: r.kept for r in fertility.op6(docs(spark, rows), RANKS, PIECES).collect()}
    assert kept == {1: True, 2: False, 3: True}


PROSE = {
    "en": "The quick brown fox jumps over the lazy dog while twenty other animals watch them from a hill near the old mill.",
    "de": "Die Größe der alten Häuser überrascht viele Gäste, während über den Dächern schöne Vögel ihre Lieder für müde Zuhörer im Garten singen.",
    "fr": "Les élèves ont préféré étudier près de la fenêtre, où la lumière d'été éclairait déjà les cahiers posés sur la vieille table en bois.",
    "es": "El niño pequeño corrió rápidamente hacia la montaña, donde su abuela preparaba el café y contaba historias de otros tiempos más felices.",
    "vi": "Hôm nay trời rất đẹp, chúng tôi cùng nhau đi dạo quanh hồ và nói chuyện về những kỷ niệm cũ của thời thơ ấu ở làng quê yên bình.",
    "pl": "Wczoraj wieczorem poszliśmy całą rodziną na długi spacer wzdłuż rzeki, żeby obejrzeć zachód słońca i porozmawiać o planach na przyszły rok.",
    "cs": "Včera večer jsme šli s celou rodinou na dlouhou procházku podél řeky, abychom viděli západ slunce a promluvili si o plánech na příští rok.",
    "tr": "Dün akşam hep beraber bütün aile birlikte nehir boyunca uzun bir yürüyüşe çıktık, güneşin batışını izledik ve gelecek yılın planlarını konuştuk.",
    "hu": "Tegnap este az egész család hosszú sétára indult a folyó mentén, hogy megnézzük a naplementét és beszéljünk a jövő évi terveinkről is.",
    "ru": "Сегодня утром мы пошли в лес и увидели много разных птиц, которые пели свои песни на высоких деревьях у реки возле старой мельницы.",
    "el": "Σήμερα το πρωί πήγαμε στο δάσος και είδαμε πολλά διαφορετικά πουλιά που τραγουδούσαν πάνω στα ψηλά δέντρα δίπλα στο ποτάμι του χωριού.",
    "zh": "今天 早上 我们 一起 去 森林 里 散步 看见 了 许多 美丽 的 小鸟 在 高高 的 树上 唱歌 然后 回家 吃饭",
    "ar": "ذهبنا صباح اليوم إلى الغابة ورأينا الكثير من الطيور المختلفة التي كانت تغني فوق الأشجار العالية بالقرب من النهر القديم في قريتنا الجميلة",
    "hi": "आज सुबह हम सब जंगल में गए और हमने बहुत सारे अलग अलग पक्षी देखे जो नदी के पास ऊँचे पेड़ों पर अपने गीत गा रहे थे",
}


def encoded_rows():
    """Base64, hex digits and texts of two-byte letters read with a one-byte code."""
    rnd = random.Random(7)
    wrong = [(PROSE[lang] + " ").encode().decode(code, "replace") for lang, code in (("ru", "latin-1"), ("ru", "cp1252"), ("el", "latin-1"))]
    return ["\n".join(base64.b64encode(rnd.randbytes(57)).decode() for _ in range(n)) for n in (20, 60, 400)] + [
        " ".join(rnd.randbytes(16).hex() for _ in range(n)) for n in (20, 60, 400)] + wrong


def test_encoded_data_is_rejected_and_prose_of_every_language_kept(spark):
    rows = [(i, PROSE[lang], lang) for i, lang in enumerate(PROSE)] + [(100 + i, t, "en") for i, t in enumerate(encoded_rows())]
    out = fertility.op6(spark.createDataFrame(rows, "doc_id long, text string, lang string"), RANKS, PIECES).collect()
    assert not any(r.base_failed for r in out)
    assert {r.doc_id: r.kept for r in out} == {i: i < 100 for i, _, _ in rows}


def test_bands_beyond_the_broadcast_bound_give_the_same(spark):
    rows = [(i, " ".join(["plain words of a usual text"] * (2 + i % 5) + [str(i)] * 9)) for i in range(150)] + edge_rows()
    want = sorted(fertility.op6(docs(spark, rows), RANKS, PIECES).collect(), key=repr)
    spark.conf.set("treeclass.broadcastMaxRows", "0")
    try:
        assert sorted(fertility.op6(docs(spark, rows), RANKS, PIECES).collect(), key=repr) == want
    finally:
        spark.conf.unset("treeclass.broadcastMaxRows")


def test_bands_follow_the_corpus(spark):
    """Random letters and short hex words lie in the fixed bands, not in those of the prose around."""
    rnd = random.Random(8)
    syllables = {lang: [w.strip(".,") for line in (PROSE[lang], more) for w in line.split()] for lang, more in (
        ("en", "People often wonder whether small towns could offer them better schools, cheaper homes, cleaner air and quieter nights."),
        ("es", "Muchas personas buscan mejores escuelas, casas baratas, aire limpio y noches tranquilas lejos del ruido urbano."))}
    rows = []
    for lang, parts in syllables.items():
        for _ in range(120):
            words = [rnd.choice(parts) for _ in range(rnd.randint(150, 170))]
            rows.append((len(rows), " ".join(words), lang))
    n = len(rows)
    for lang in syllables:
        for _ in range(10):
            rows.append((len(rows), " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(85)), lang))
            rows.append((len(rows), " ".join(rnd.randbytes(4).hex() for _ in range(85)), lang))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = fertility.op6(frame, RANKS, PIECES).collect()
    assert not any(r.base_failed for r in out) and len(out) == len(rows)
    assert {r.doc_id: r.kept for r in out} == {i: i < n for i, _, _ in rows}


# --- packing ----------------------------------------------------------------------------------

def check_packing(rows, pieces, length):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokens.file("byte_bpe_50k.json"))
    want = collections.Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in rows)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        assert zlib.crc32(np.array(p.ids, dtype="<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length > 0
        by_doc[p.doc_id].append(p)
    for (i, ids), n in want.items():
        if sum(k for (j, _), k in want.items() if j == i) == 1:
            own = sorted(by_doc[i], key=lambda p: p.start)
            assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
            assert tuple(x for p in own for x in p.ids) == ids and {p.doc_tokens for p in own} == {len(ids)}
    assert sum(p.length for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    fill = []
    for s in sorted(by_sequence):
        own = sorted(by_sequence[s], key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        fill.append(sum(p.length for p in own))
    assert all(f == length for f in fill[:-1]) and 0 < fill[-1] <= length


@pytest.mark.parametrize("length", [1024, 64])
def test_packing_holds_every_id_once(spark, length):
    rows = edge_rows() + blank_rows() + [(200, "<|endoftext|> is text here")]
    check_packing(rows, curve_packing.pack(docs(spark, rows), RANKS, length).collect(), length)


def test_packing_empty_table(spark):
    assert curve_packing.op9(docs(spark, []), RANKS).collect() == []


def test_hilbert_key_is_a_walk_over_neighbours():
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        key = curve_packing.hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_copies_are_neighbours_on_the_curve(spark):
    rows = prose_rows(60) + [(500, prose_rows(60)[4][1])]
    out = curve_packing.op9(docs(spark, rows), RANKS).withColumn("at", F.col("sequence_id") * 1024 + F.col("offset")).collect()
    place = {r.doc_id: r.at for r in sorted(out, key=lambda r: -r.start)}
    size = {r.doc_id: r.doc_tokens for r in out}
    between = sum(n for i, n in size.items() if min(place[4], place[500]) < place[i] < max(place[4], place[500]))
    assert between <= sum(size[i] for i, t in rows if t == dict(rows)[4])
