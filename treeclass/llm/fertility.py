"""Quality rules by tokeniser fertility.

Every word of a text is encoded on its own with two public vocabularies: a byte-level BPE and a
piece BPE with byte fallback.  Per text:

* ``chars_per_token``: characters of words over byte-level tokens;
* ``fallback_share``: share of the piece vocabulary's tokens that are single bytes;
* ``entropy``: bits of the distribution of the text's piece tokens.

A text passes when each lies in two bands, after the base rules (``judge``):

* a fixed one of its main script (the script of most of its letters), from figures of prose;
  languages that the byte-level vocabulary cuts small have a lower floor of their own, and
  Latin texts of ``LONG_CHARS`` characters need more bits than digits and few letters give;
* one of its group in the corpus, of all documents of the same ``lang`` (if there is such a
  column), script and size (power of two of its characters) that pass the base rules: ``SPREAD``
  times the distance of the quartiles beyond the quartiles.  Up to a quarter of a group may
  be encoded data without moving it far.  A group needs ``MIN_DOCS`` documents.

Outside are encoded data, most mojibake and texts of a few endlessly repeated tokens.  Words
recur, so each task keeps the encodings of the words it has met, up to ``CACHE`` words.

Defined cases: a null text has no words and fails the base rules; texts without letters belong
to script ``other``; a null language is a group of its own; a null id is kept as it is; repeated rows each get their row; an empty table gives
no rows; columns other than the text, id and language are ignored.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeclass.llm import tokens
from treeclass.llm.common import keep_table, sliced
from treeclass.operators.joins import lookup_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
MIN_WORDS = 20
REPEAT_WORDS = 8
MAX_REPEAT_PERCENT = 30
CACHE = 200_000
TASK_BYTES = 4 << 20

LONG_CHARS = 512
SPREAD = 4
MIN_DOCS = 50
VALUES = ("chars_per_token", "fallback_share", "entropy")

#: script -> bands (low, high) of characters per token, byte-fallback share and entropy in bits
BANDS = {
    "latin": ((1.4, 12.0), (0.0, 0.25), (2.5, 11.5)),
    "cyrillic": ((0.4, 8.0), (0.0, 0.35), (2.5, 11.5)),
    "greek": ((0.4, 8.0), (0.0, 0.6), (2.5, 10.0)),
    "han": ((0.25, 4.0), (0.0, 0.8), (2.5, 11.5)),
    "other": ((0.2, 12.0), (0.0, 0.9), (2.5, 11.5)),
}
#: Latin languages of many accents -> floor of characters per token
LANGUAGE_FLOORS = {"vi": 0.7, "yo": 0.7, "nv": 0.7}
#: Floor of the entropy of long Latin texts: hex digits have 4.6 to 4.7 bits, prose 5.3 and more
LONG_ENTROPY = 4.9
#: A group's band reaches beyond a quartile by SPREAD times at least so much: value -> (least distance, below, above)
CORPUS_SIDES = {"chars_per_token": (0.05, True, False), "fallback_share": (0.05, False, True), "entropy": (0.1, True, True)}
#: first code points of letter blocks; a block reaches to the next start
SCRIPT_STARTS = np.array([0x0, 0x370, 0x400, 0x530, 0x1E00, 0x1F00, 0x2000, 0x2E80, 0xA000])
SCRIPT_NAMES = ["latin", "greek", "cyrillic", "other", "latin", "greek", "other", "han", "other"]


def repeated_words(codes: np.ndarray) -> int:
    """Words in windows of ``REPEAT_WORDS`` words found twice or more; a word's code names it."""
    if len(codes) <= REPEAT_WORDS:
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(codes, REPEAT_WORDS)
    mixed = np.zeros(len(windows), dtype=np.uint64)
    for k in range(REPEAT_WORDS):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + windows[:, k].astype(np.uint64) + np.uint64(1)
    order = np.argsort(mixed)
    same = np.flatnonzero(mixed[order[1:]] == mixed[order[:-1]])
    if not len(same):
        return 0
    rows = np.unique(np.concatenate([order[same], order[same + 1]]))  # equal windows, perhaps others: compare
    _, which, n = np.unique(windows[rows], axis=0, return_inverse=True, return_counts=True)
    again = rows[n[which.ravel()] > 1]
    edge = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + REPEAT_WORDS, -1)
    return int((np.cumsum(edge) > 0).sum())


def line_counts(text: str) -> tuple[int, int]:
    """(symbols, duplicate lines): a duplicate line has a word and equals an earlier line."""
    lines = text.split("\n")
    distinct = set(lines)
    blank = [x for x in distinct if not WORD.search(x)]
    n_blank = sum(map(lines.count, blank)) if len(blank) < 4 else sum(not WORD.search(x) for x in lines)
    return len(SYMBOL.findall(text)), len(lines) - n_blank - (len(distinct) - len(blank))


def _letter_scripts() -> np.ndarray:
    """Script number of every code point that is a letter, else the number after the last."""
    points = np.arange(0x110000)
    script = np.searchsorted(SCRIPT_STARTS, points, side="right") - 1
    letter = np.fromiter((not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)), dtype=bool)
    return np.where(letter, script, len(SCRIPT_NAMES)).astype(np.uint8)


class _Codes(dict):
    """Words numbered in the order they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


class Fertility:
    """Encodings of words with both vocabularies; keeps those of the words met.

    A word's code is its place in ``counts`` (byte-level tokens) and in the rows of piece
    tokens, which are stored end to end."""

    def __init__(self, ranks: str, pieces: str, cache: int = CACHE):
        self.bpe, self.pieces, self.cache = tokens.encoder(ranks), tokens.pieces(pieces), cache
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.scripts = _letter_scripts()
        self.forget()

    def forget(self) -> None:
        self.codes = _Codes()
        self.counts, self.lengths = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int32)

    def learn(self) -> None:
        """Encode the words that have a new code."""
        new = list(islice(self.codes, len(self.counts), None))
        if not new:
            return
        rows = self.pieces.encode(new, num_threads=1)
        self.counts = np.append(self.counts, [len(tokens.ordinary_ids(self.bpe, " " + w)) for w in new])
        self.lengths = np.append(self.lengths, [len(r) for r in rows])
        self.ids = np.append(self.ids, np.array([i for r in rows for i in r], dtype=np.int32))
        self.begins = np.cumsum(self.lengths) - self.lengths

    def main_script(self, text: str) -> str:
        """The script with the most letters of a text."""
        n = np.bincount(self.scripts[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")], minlength=len(SCRIPT_NAMES) + 1)
        totals: dict[str, int] = {}
        for name, k in zip(SCRIPT_NAMES, n.tolist()):
            totals[name] = totals.get(name, 0) + k
        best = max(sorted(totals), key=totals.get)
        return best if totals[best] else "other"

    def measure(self, texts: list[str]) -> list[tuple]:
        """Of each text: the four base counts, repeated words, script and the three fertility values."""
        if len(self.codes) > self.cache:
            self.forget()
        split = []
        for text in texts:
            words = WORD.findall(text)
            split.append((np.fromiter(map(self.codes.__getitem__, words), dtype=np.int64, count=len(words)),
                          sum(map(len, words))))
        self.learn()
        out = []
        for text, (codes, chars) in zip(texts, split):
            symbols, dup_lines = line_counts(text)
            out.append((len(codes), chars, symbols, dup_lines, repeated_words(codes), self.main_script(text),
                        *self._values(codes, chars)))
        return out

    def _values(self, codes: np.ndarray, chars: int) -> tuple[float, float, float]:
        if not len(codes):
            return 0.0, 0.0, 0.0
        length = self.lengths[codes]
        ends = np.cumsum(length)
        ids = self.ids[np.repeat(self.begins[codes] - (ends - length), length) + np.arange(ends[-1])]
        n = np.bincount(ids, minlength=len(self.is_byte))
        p = n[n > 0] / len(ids)
        return chars / int(self.counts[codes].sum()), float(n[self.is_byte].sum() / len(ids)), float(-(p * np.log2(p)).sum())


SCHEMA = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "script string, chars_per_token double, fallback_share double, entropy double")


def measures(docs: DataFrame, ranks: str, pieces: str) -> DataFrame:
    """Base counts and fertility of every whole text."""
    def run(batches):
        fertility = Fertility(ranks, pieces)
        for whole in batches:
            for batch in sliced(whole, "text", TASK_BYTES):
                columns = list(zip(*fertility.measure([t or "" for t in batch.column("text").to_pylist()])))
                kinds = [pa.int64()] * 5 + [pa.string()] + [pa.float64()] * 3
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("lang")] + [pa.array(c, type=t) for c, t in zip(columns, kinds)],
                    names=[x.split()[0] for x in SCHEMA.split(", ")])
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _group() -> list[Column]:
    """Language, script and the number of binary digits of a text's characters."""
    return [F.coalesce("lang", F.lit("")).alias("group_lang"), F.col("script").alias("group_script"),
            F.length(F.bin("word_chars")).alias("group_size")]


def corpus_bands(measured: DataFrame) -> DataFrame:
    """Per group of documents that pass the base rules: low and high ends of the values."""
    quartiles = measured.where(~base_failed()).groupBy(*_group()).agg(
        F.count("*").alias("n"), *(F.percentile_approx(v, [0.25, 0.75], 10_000).alias(v) for v in VALUES)).where(
        F.col("n") >= MIN_DOCS)
    ends = []
    for v, (least, below, above) in CORPUS_SIDES.items():
        reach = SPREAD * F.greatest(F.col(v)[1] - F.col(v)[0], F.lit(least))
        ends += [(F.col(v)[0] - reach).alias(f"{v}_low")] * below + [(F.col(v)[1] + reach).alias(f"{v}_high")] * above
    return quartiles.select("group_lang", "group_script", "group_size", *ends)


def judge(measured: DataFrame, bands: dict = BANDS, corpus: DataFrame | None = None) -> DataFrame:
    """Adds ``base_failed`` and ``kept``; ``corpus``: bands of the groups, if there are any."""
    inside = F.lit(False)
    for script, ranges in bands.items():
        ok = F.col("script") == script
        for column, (low, high) in zip(VALUES, ranges):
            floor = F.lit(low)
            if script == "latin" and column == "chars_per_token":
                for lang, own in LANGUAGE_FLOORS.items():
                    floor = F.when(F.coalesce("lang", F.lit("")) == lang, own).otherwise(floor)
            elif script == "latin" and column == "entropy":
                floor = F.when(F.col("word_chars") >= LONG_CHARS, LONG_ENTROPY).otherwise(floor)
            ok = ok & F.col(column).between(floor, high)
        inside = inside | ok
    out = measured
    if corpus is not None:
        keys = ["group_lang", "group_script", "group_size"]
        # a group per language, script and size: broadcast behind a check, else salted by document
        out = lookup_join(measured.select("*", *_group()), corpus, keys, "left", salt_key="doc_id")
        for v, (_, below, above) in CORPUS_SIDES.items():
            if below:
                inside = inside & F.coalesce(F.col(v) >= F.col(f"{v}_low"), F.lit(True))
            if above:
                inside = inside & F.coalesce(F.col(v) <= F.col(f"{v}_high"), F.lit(True))
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & inside).select(
        *measured.columns, "base_failed", "kept")


def op6(docs: DataFrame, ranks: str, pieces: str) -> DataFrame:
    measured = keep_table(measures(docs, ranks, pieces), "fertility")
    return judge(measured, corpus=keep_table(corpus_bands(measured), "fertility_bands")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "script", "chars_per_token", "fallback_share", "entropy")
