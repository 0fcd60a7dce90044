"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings of every training word.  The index is split by
documents: a shard holds some megabytes of whole documents, its sorted terms, and for each
term the word positions in the shard, gap-coded.  A word that every document holds costs
each shard its own postings and no task more than a shard; building needs no shuffle.

``matches`` looks the test windows up in every shard.  For each window the postings of its
rarest term in the shard give the candidate starts; the other terms' lists, adjusted by
their offsets, are intersected with them from the next rarest on.  With ``slop`` > 0 every
term, the rarest too, may lie up to that many words off its place, within the document
(proximity match).  A match covers as many words from its start as the window has, within
the document; all starts that match count.

The test side is looked up in blocks of at most ``BLOCK_BYTES`` of text, so what is sent to
the tasks (some bytes a word) has a fixed bound however many items there are; results of blocks are
merged.  A shard's windows are formed some at a time.

Terms are 64-bit hashes of the lower-cased word bytes (random table times powers of an odd
number, mixed); a false match needs equal hashes of different words within a window whose
other words agree.

Defined cases: null or wordless documents have no words and no matches; null or wordless
items have no window; a null item id is listed as the empty string, repeated item ids count
once; repeated documents each get their row; empty tables give no rows or no matches; other
columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.llm.common import LARGE_ROWS, NULL_ID, id_key, keep_table, sliced

WINDOW = 13
SHARD_BYTES = 4 << 20
PIECE_BYTES = 1 << 20  # text hashed at once
BLOCK_BYTES = 8 << 20
STEP = 1 << 20  # candidates handled at once in a shard
WINDOWS_AT_ONCE = 1 << 16  # windows looked up at once in a shard

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_TABLE = np.random.default_rng(20_240_501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)

INDEX_SCHEMA = ("shard long, doc_ids binary, word_counts binary, terms binary, counts binary, gaps binary")
MATCH_SCHEMA = ("shard long, row int, doc_id long, n_words long, spans array<struct<start: long, length: long>>, "
                "items array<string>")


_NO_WORD = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, dtype=np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start byte, hash) of every word of UTF-8 text, hashed piece by piece."""
    at, starts, hashes = 0, [], []
    while at < len(data) or not starts:
        cut = _NO_WORD.search(data, min(at + PIECE_BYTES, len(data)))
        end = cut.start() if cut else len(data)
        start, h = _piece_words(data[at:end])
        starts.append(start + at)
        hashes.append(h)
        at = end + 1
    return np.concatenate(starts), np.concatenate(hashes)


def _piece_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    b = _LOWER[np.frombuffer(data, dtype=np.uint8)]
    inside = np.zeros(len(b) + 2, dtype=bool)
    inside[1:-1] = _WORD[b]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(((len(b) >> 18) + 1) << 18)
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[b] * up[:len(b)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return starts, h ^ (h >> np.uint64(29))


def index_shard(ids: np.ndarray, texts: list[bytes]) -> list[bytes]:
    """The columns of one shard: ids, word counts, terms, postings per term, gaps.

    The position of a word is its number in the shard plus the number of its document, so
    that consecutive positions never cross documents."""
    starts, h = words(b"\n".join(texts))
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    first = np.searchsorted(starts, begins)
    n_words = np.diff(np.append(first, len(starts)))
    position = np.arange(len(h)) + np.repeat(np.arange(len(texts)), n_words)
    order = np.argsort(h, kind="stable")
    h = h[order]
    new = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, dtype=np.int64)
    counts = np.diff(np.append(new, len(h))).astype(np.uint32)
    gaps = np.diff(position[order].astype(np.uint32), prepend=np.uint32(0))  # wraps at 2**32
    return [x.tobytes() for x in (ids.astype(np.int64), n_words.astype(np.int64), h[new], counts, gaps)]


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The positional index of every document, written below the shared scratch folder."""
    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in sliced(whole, "text", shard_bytes):
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
                row = index_shard(ids, [(t or "").encode() for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | n])] + [pa.array([x], type=pa.binary()) for x in row],
                    names=["shard", "doc_ids", "word_counts", "terms", "counts", "gaps"])
                n += 1
    rows = docs.select(id_key().alias("doc_id"), F.col("text").cast("string").alias("text"))
    return keep_table(rows.mapInArrow(run, INDEX_SCHEMA), "positional_index", options=LARGE_ROWS)


class Windows:
    """The windows of a block of items, by window length: vocabulary numbers of the items' words in a row, the place
    of each window's first word and its item.  Rows of windows are made ``WINDOWS_AT_ONCE`` at a time."""

    def __init__(self, items: list[tuple[str, str]], size: int = WINDOW):
        self.names = sorted({i for i, _ in items})
        number = {x: n for n, x in enumerate(self.names)}
        by_length: dict[int, list] = {}
        for item, text in items:
            _, h = words(text.encode())
            if len(h):
                by_length.setdefault(min(size, len(h)), []).append((h, number[item]))
        self.vocabulary = np.unique(np.concatenate([h for x in by_length.values() for h, _ in x] or [np.empty(0, dtype=np.uint64)]))
        self.lengths = {}
        for n, found in by_length.items():
            sizes = np.array([len(h) for h, _ in found])
            windows = sizes - n + 1
            begin = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(windows) - windows), windows)
            self.lengths[n] = (np.searchsorted(self.vocabulary, np.concatenate([h for h, _ in found])).astype(np.int32),
                               (begin + np.arange(len(begin))).astype(np.int32),
                               np.repeat(np.array([i for _, i in found], dtype=np.int32), windows))

    def parts(self):
        """(length, rows of vocabulary numbers, item numbers) of all windows, some at a time."""
        for n, (numbers, first, items) in self.lengths.items():
            for at in range(0, len(first), WINDOWS_AT_ONCE):
                some = slice(at, at + WINDOWS_AT_ONCE)
                yield n, numbers[first[some, None] + np.arange(n)], items[some]


def _intersect(rows: np.ndarray, items: np.ndarray, terms: "_Terms", slop: int, begin: np.ndarray, n_words: np.ndarray):
    """(item number, start position, document) of each occurrence of the windows ``rows``; with
    ``slop`` > 0 a start may come several times.  ``begin``: first position of each document."""
    count = terms.count[rows]
    some = count.min(axis=1) > 0
    rows, items, count = rows[some], items[some], count[some]
    order = np.argsort(count, axis=1, kind="stable")  # rarest first
    reach = 2 * slop + 1
    total = count.min(axis=1, initial=2**62) * reach
    blocks = np.flatnonzero(np.diff(np.cumsum(total) // STEP)) + 1
    for part in np.split(np.arange(len(rows)), blocks):
        if not len(part):
            continue
        n = total[part]
        w = np.repeat(part, n)  # the window of each candidate
        within, shift = np.divmod(np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n), reach)
        at = order[w, 0]
        place = terms.positions[terms.first[rows[w, at]] + within].astype(np.int64)
        start = place - at + shift - slop
        doc = np.searchsorted(begin, place, side="right") - 1 if slop else None
        for k in range(1, rows.shape[1]):
            at = order[w, k]
            low, high = start + at - slop, start + at + slop
            if slop:  # exact windows cannot cross documents
                low, high = np.maximum(low, begin[doc]), np.minimum(high, begin[doc] + n_words[doc] - 1)
            ok = terms.holds(rows[w, at], low, high)
            w, start = w[ok], start[ok]
            doc = doc[ok] if slop else None
        yield items[w], start, doc if slop else np.searchsorted(begin, start, side="right") - 1


class _Terms:
    """The postings of one shard for the vocabulary of a block."""

    def __init__(self, row: dict, vocabulary: np.ndarray):
        terms = np.frombuffer(row["terms"], dtype=np.uint64)
        counts = np.frombuffer(row["counts"], dtype=np.uint32).astype(np.int64)
        self.positions = np.cumsum(np.frombuffer(row["gaps"], dtype=np.uint32), dtype=np.uint32)
        at = np.searchsorted(terms, vocabulary)
        known = at < len(terms)
        known[known] = terms[at[known]] == vocabulary[known]
        self.term = np.where(known, at, 0)
        begin = np.cumsum(counts) - counts
        self.count = np.zeros(len(vocabulary), dtype=np.int64)
        self.first = np.zeros(len(vocabulary), dtype=np.int64)
        self.count[known], self.first[known] = counts[at[known]], begin[at[known]]
        # sorted (term, position) pairs: any list can be probed by one binary search
        self.key = np.repeat(np.arange(len(terms), dtype=np.int64), counts) << 32 | self.positions

    def holds(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the list of ``word`` has a position from ``low`` to ``high``."""
        base = self.term[word] << 32
        at = np.searchsorted(self.key, base + np.maximum(low, 0))
        ok = (at < len(self.key)) & (high >= 0)
        ok[ok] = self.key[at[ok]] <= (base + high)[ok]
        return ok


def _find(row: dict, windows: Windows, slop: int) -> pa.RecordBatch:
    ids = np.frombuffer(row["doc_ids"], dtype=np.int64)
    n_words = np.frombuffer(row["word_counts"], dtype=np.int64)
    begin = np.cumsum(n_words + 1) - n_words - 1  # first position of each document
    terms = _Terms(row, windows.vocabulary)
    edges = np.zeros(int((n_words + 1).sum()) + 1, dtype=np.int64)
    pairs = [np.empty(0, dtype=np.int64)]
    for length, rows, items in windows.parts():
        for item, start, doc in _intersect(rows, items, terms, slop, begin, n_words):
            low, high = np.maximum(start, begin[doc]), np.minimum(start + length, begin[doc] + n_words[doc])
            high = np.maximum(low, high)
            np.add.at(edges, low, 1)
            np.add.at(edges, high, -1)
            pairs.append(np.unique(doc * len(windows.names) + item))
    hit = np.cumsum(edges) > 0
    change = np.flatnonzero(np.diff(hit, prepend=False, append=False))
    low, high = change[::2], change[1::2]
    doc = np.searchsorted(begin, low, side="right") - 1
    pairs = np.unique(np.concatenate(pairs))
    of, item = np.divmod(pairs, max(1, len(windows.names)))
    cut = lambda values, docs: pa.ListArray.from_arrays(
        pa.array(np.searchsorted(docs, np.arange(len(ids) + 1)), type=pa.int32()), values)
    spans = pa.StructArray.from_arrays([pa.array(low - begin[doc]), pa.array(high - low)], names=["start", "length"])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), row["shard"])), pa.array(np.arange(len(ids)), type=pa.int32()),
         pa.array(ids, mask=ids == NULL_ID), pa.array(n_words), cut(spans, doc),
         cut(pa.array([windows.names[i] for i in item.tolist()], type=pa.string()), of)],
        names=["shard", "row", "doc_id", "n_words", "spans", "items"])


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """The items with a block number; a block holds about ``block_bytes`` of text."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-total // block_bytes) or 1
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), n


def _merge_spans(batches):
    """Sorted spans of several blocks joined where they touch or overlap."""
    for batch in batches:
        spans = batch.column("spans")
        of = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
        start, length = (spans.flatten().field(n).to_numpy() for n in ("start", "length"))
        # ends so far within the document: starts beyond them begin a new span
        shift = of * (int((start + length).max(initial=0)) + 1)
        reach = np.maximum.accumulate(start + length + shift) if len(of) else start
        new = np.ones(len(of), dtype=bool)
        new[1:] = (of[1:] != of[:-1]) | ((start + shift)[1:] > reach[:-1])
        first = np.flatnonzero(new)
        ends = (reach - shift)[np.append(first[1:], len(of)) - 1] if len(first) else start
        merged = pa.StructArray.from_arrays([pa.array(start[first]), pa.array(ends - start[first])], names=["start", "length"])
        cuts = pa.array(np.searchsorted(of[first], np.arange(batch.num_rows + 1)), type=pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.ListArray.from_arrays(cuts, merged), batch.column("items")],
            names=["doc_id", "n_words", "spans", "items"])


def matches(index: DataFrame, benchmark: DataFrame, slop: int = 0, window: int = WINDOW,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per indexed document: (doc_id, n_words, spans, items) with the merged spans of
    words (start, length) that occurrences of windows cover, and the items' ids."""
    items, n = item_blocks(benchmark, block_bytes)

    def look_up(block: int) -> DataFrame:
        windows = Windows([tuple(r) for r in items.where(F.col("block") == block).select("item", "text").collect()], window)

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    yield _find(batch.slice(i, 1).to_pylist()[0], windows, slop)
        return index.mapInArrow(run, MATCH_SCHEMA)

    found = reduce(DataFrame.unionByName, (look_up(b) for b in range(n)))
    if n > 1:  # a document has a row of each block
        found = found.groupBy("shard", "row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")).drop("shard", "row")
        found = found.mapInArrow(_merge_spans, "doc_id long, n_words long, spans array<struct<start: long, length: long>>, items array<string>")
    return found.select("doc_id", "n_words", "spans", "items")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, words hit by exact 13-word windows, items, and the verdict."""
    found = matches(build_index(docs), benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["length"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


ORACLE_SQL = r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
bw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
iw as (
  select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as win
  from (select item_id, w, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as p
        from bw where len(w) > 0)),
lens as (select distinct n from iw),
dwin as (
  select doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p from dw, lens where len(w) >= n)),
hits as (select doc_id, p, d.n, item_id from dwin d join iw i on d.n = i.n and d.win = i.win),
hit_words as (select doc_id, count(distinct q) as n_hit
              from (select doc_id, unnest(range(p, p + n)) as q from hits) group by doc_id),
hit_items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
              from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw d left join hit_words using (doc_id) left join hit_items using (doc_id)
"""
