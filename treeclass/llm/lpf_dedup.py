"""Substring deduplication by longest-previous-factor tests over suffix arrays.

A byte goes when a string of ``MATCH`` bytes that covers it also starts in a document with a smaller
id.  Per string start ("window") that is: among all windows with the same bytes, is there
one of a smaller document?  In suffix order equal windows are neighbours, so the nearest
previous and next windows of smaller documents, if their common prefix has the full length,
are the earlier matches (longest previous factor, cut at ``MATCH``).

One suffix array over the corpus would have to be sorted whole.  Instead:

1. Chunks.  Whole documents are packed into chunk rows (some megabytes, compressed), a table
   bucketed by chunk: later steps shuffle only what is sent to the chunks, not the texts.
2. Runs.  The smallest hash of the ``GRAM``-byte strings inside a window is the window's key;
   equal windows have equal keys, and neighbours mostly share it.  A run is a stretch of
   window starts of one document with one key; with its last window's bytes it is a segment.
3. Keys.  Chunks send their distinct keys, packed and dealt by hash; those that two documents
   hold are flagged, and the flags go back to the chunks.
4. Segments.  For flagged keys chunks send the hashes of their distinct segments with the first
   document of each.  Back go two bits: whether a smaller document elsewhere has the whole segment
   (then it goes), and whether the key has other segments too, so that parts of it may match.
5. Only the latter send their bytes, once per distinct segment, dealt by key.  Each task builds the
   suffix array of the windows it holds and takes the longest-previous-factor test.
6. A key with more than ``HOT_WINDOWS`` windows is cut into single windows, reduced to the
   smallest document of each distinct window and joined back: no task gathers a hot key.
7. Chunks apply their removals.

Segments are told apart by their key and a 64-bit hash.

Defined cases: a null text is empty; texts under ``MATCH`` bytes keep all; a null id counts as
the largest id; rows that share an id are one document (neither removes the other's
bytes) and each get their row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.llm.common import NULL_ID, id_key, keep_table, sliced
from treeclass.operators.joins import small_side
from treeclass.session import write_bucketed

MATCH = 50
GRAM = 24
MAX_RUN = 1024
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 64 << 20
LOW_BITS = 28
HOT_WINDOWS = 500_000
BATCH_WINDOWS = 250_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


# --- chunks and runs -------------------------------------------------------------------------

def pack_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, ids, ends, n_bytes, data): whole documents packed in the order of the scan."""
    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for batch in sliced(whole, "text", chunk_bytes):
                texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
                ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | n]), *(pa.array([x], type=pa.binary()) for x in (ids.tobytes(), ends.tobytes())),
                     pa.array([int(ends[-1])]), pa.array([squeeze(b"".join(texts))], type=pa.binary())],
                    names=["chunk", "ids", "ends", "n_bytes", "data"])
                n += 1
    rows = docs.select(id_key().alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = rows.mapInArrow(run, "chunk long, ids binary, ends binary, n_bytes long, data binary")
    return write_bucketed(packed, "chunk", "lpf_chunks", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                          partitioned=True)


class Chunk:
    def __init__(self, row: dict):
        self.chunk = row["chunk"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.ends = np.frombuffer(row["ends"], dtype=np.int64)
        self.begins = np.append(0, self.ends[:-1])
        self.data = zstandard.ZstdDecompressor().decompress(row["data"]) if row["n_bytes"] else b""


def window_keys(data: np.ndarray) -> np.ndarray:
    """For every window start, the smallest hash of the ``GRAM``-byte strings in the window."""
    n = len(data) - GRAM + 1
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray(shape=(len(data),), dtype="<u8", buffer=padded, strides=(1,)).copy()
    h = words[:n] * _MIX
    for at in range(8, GRAM, 8):
        h ^= h >> np.uint64(29)
        h ^= words[at:at + n]
        h *= _MIX
    h ^= h >> np.uint64(32)
    h *= _MIX
    width, span = MATCH - GRAM + 1, 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[:len(h) - (width - span)], h[width - span:])


def runs(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, key, document number) of the runs of a chunk."""
    data = np.frombuffer(chunk.data, dtype=np.uint8)
    if len(data) < MATCH:
        none = np.empty(0, dtype=np.int64)
        return none, none, none.astype(np.uint64), none
    keys = window_keys(data)
    valid = np.ones(len(data), dtype=bool)
    for begin, end in zip(chunk.begins.tolist(), chunk.ends.tolist()):  # a window ends within its document
        valid[max(begin, end - MATCH + 1):end] = False
    valid = valid[:len(keys)]
    change = np.append(True, keys[1:] != keys[:-1])
    change[1:] |= ~valid[:-1]
    start = np.flatnonzero(change & valid)
    stop = np.append(np.flatnonzero(change | ~valid), len(keys))
    stop = stop[np.searchsorted(stop, start, side="right")]
    size = stop - start
    pieces = -(-size // MAX_RUN)  # long runs (constant text) are cut
    first = np.repeat(start, pieces) + MAX_RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    size = np.minimum(MAX_RUN, np.repeat(stop, pieces) - first)
    return first, size, keys[first], np.searchsorted(chunk.ends, first, side="right")


def key_ids(key: np.ndarray, buckets: int) -> np.ndarray:
    """Number of a key: its bucket, then ``LOW_BITS`` low bits (keys that share a number are
    only looked at more closely)."""
    bucket = (key >> np.uint64(LOW_BITS + 8)) % np.uint64(buckets)
    return (bucket << np.uint64(LOW_BITS) | (key & np.uint64((1 << LOW_BITS) - 1))).astype(np.int64)


def _groups(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by the columns, where groups begin in it, group of each row)."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), group


def _split(bucket: np.ndarray) -> list[np.ndarray]:
    """Row numbers of each bucket of a sorted column."""
    return [p for p in np.split(np.arange(len(bucket)), np.flatnonzero(np.diff(bucket)) + 1) if len(p)]


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _flags(x: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=n).astype(bool)


def _press(x: np.ndarray) -> bytes:
    """Compressed array, its bytes in planes (small numbers: planes of zeros)."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes())


def _unpress(x: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class Work:
    """The runs of one chunk and what has come back to it so far."""

    def __init__(self, row: dict, buckets: int):
        self.chunk = Chunk(row)
        self.start, self.size, key, self.doc = runs(self.chunk)
        self.ids = key_ids(key, buckets)
        self.keys, self.key_of = np.unique(self.ids, return_inverse=True)
        if "shared" in row:
            self._use_shared(self._gather(row["shared"], "bits", self.keys >> LOW_BITS))
        if "segment_bits" in row:
            self.later = self._gather(row["segment_bits"], "later", self.entry_id >> LOW_BITS)
            self.partial = self._gather(row["segment_bits"], "partial", self.entry_id >> LOW_BITS)

    @staticmethod
    def _gather(flags: list, name: str, bucket: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bucket), dtype=bool)
        for f in flags or ():
            low, high = np.searchsorted(bucket, [f["bucket"], f["bucket"] + 1])
            out[low:high] = _flags(f[name], high - low)
        return out

    def doc_ids(self, some=slice(None)) -> np.ndarray:
        return self.chunk.ids[self.doc[some]]

    def _use_shared(self, shared: np.ndarray) -> None:
        """Flagged runs, and their distinct segments ("entries") by key number and hash."""
        self.flagged = np.flatnonzero(shared[self.key_of]) if len(self.key_of) else self.key_of
        data, ends = self.chunk.data, self.start + self.size + MATCH - 1
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(
            self.start[self.flagged].tolist(), ends[self.flagged].tolist())), dtype=np.uint64, count=len(self.flagged))
        ids, docs = self.ids[self.flagged], self.doc_ids(self.flagged)
        order, begin, self.entry_of = _groups([ids, hashes])
        self.entry_id, self.entry_hash = ids[order[begin]], hashes[order[begin]]
        self.first = np.minimum.reduceat(docs[order], begin) if len(begin) else docs
        self.several = (np.maximum.reduceat(docs[order], begin) != self.first) if len(begin) else docs.astype(bool)
        # a run of the entry in its first document: where its bytes are read
        first_run = np.flatnonzero(docs == self.first[self.entry_of]) if len(docs) else docs
        self.sample = np.zeros(len(begin), dtype=np.int64)
        self.sample[self.entry_of[first_run]] = self.flagged[first_run]


def _each(batches, buckets: int):
    for batch in batches:
        for i in range(batch.num_rows):
            yield Work(batch.slice(i, 1).to_pylist()[0], buckets)


def _rows(names: str, kinds: str, rows: list[tuple]) -> pa.RecordBatch:
    types = {"i": pa.int32(), "l": pa.int64(), "b": pa.binary()}
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, type=types[k]) for c, k in zip(columns, kinds)], names=names.split())


def _to_chunks(flags: DataFrame, name: str, *fields: str) -> DataFrame:
    """One row a chunk with what goes back to it, written (it is small and read again)."""
    return keep_table(flags.groupBy("chunk").agg(F.collect_list(F.struct(*fields)).alias(name)), f"lpf_{name}")


def _with(chunks: DataFrame, *sides: DataFrame) -> DataFrame:
    for side in sides:  # built into a hash table; the chunks stay in their buckets
        chunks = chunks.join(side.hint("shuffle_hash"), "chunk", "left")
    return chunks


def shared_keys(chunks: DataFrame, buckets: int) -> DataFrame:
    """Per chunk, a bit for each of its distinct keys: whether two documents hold it."""
    def send(batches):
        for w in _each(batches, buckets):
            order, begin, _ = _groups([w.ids])
            docs = w.doc_ids(order)
            several = np.minimum.reduceat(docs, begin) != np.maximum.reduceat(docs, begin) if len(begin) else begin.astype(bool)
            yield _rows("bucket chunk low several", "ilbb", [
                (int(w.keys[p[0]] >> LOW_BITS), w.chunk.chunk, _press(np.diff(w.keys[p], prepend=w.keys[p[0]] >> LOW_BITS << LOW_BITS).astype(np.uint32)),
                 _bits(several[p])) for p in _split(w.keys >> LOW_BITS)])

    def flag(key, table):
        low = [np.cumsum(_unpress(x, np.uint32), dtype=np.int64) for x in table.column("low").to_pylist()]
        several = [_flags(x, len(k)) for x, k in zip(table.column("several").to_pylist(), low)]
        _, at, n = np.unique(np.concatenate(low), return_inverse=True, return_counts=True)
        twice = n > 1
        twice[at[np.concatenate(several)]] = True
        bits = np.split(twice[at], np.cumsum([len(k) for k in low])[:-1])
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "bits": pa.array([_bits(b) for b in bits], type=pa.binary())})
    sent = chunks.mapInArrow(send, "bucket int, chunk long, low binary, several binary")
    flagged = sent.groupBy("bucket").applyInArrow(flag, "chunk long, bucket int, bits binary")
    return _to_chunks(flagged, "shared", "bucket", "bits")


def segment_bits(chunks: DataFrame, buckets: int) -> DataFrame:
    """Per chunk, two bits for each of its entries: whether a smaller document elsewhere has the whole
    segment, and, if not, whether its key has other segments with which parts may match."""
    def send(batches):
        for w in _each(batches, buckets):
            bucket = w.entry_id >> LOW_BITS
            yield _rows("bucket chunk low hash first several", "ilbbbb", [
                (int(bucket[p[0]]), w.chunk.chunk,
                 _press(np.diff(w.entry_id[p], prepend=bucket[p[0]] << LOW_BITS).astype(np.uint32)), w.entry_hash[p].tobytes(),
                 _press(w.first[p].astype(np.int64)), _bits(w.several[p])) for p in _split(bucket)])

    def decide(key, table):
        low = [np.cumsum(_unpress(x, np.uint32), dtype=np.int64) for x in table.column("low").to_pylist()]
        several = np.concatenate([_flags(x, len(k)) for x, k in zip(table.column("several").to_pylist(), low)])
        first = np.concatenate([_unpress(x, np.int64) for x in table.column("first").to_pylist()])
        hashes = np.frombuffer(b"".join(table.column("hash").to_pylist()), dtype=np.uint64)
        cuts = np.cumsum([len(k) for k in low])[:-1]
        low = np.concatenate(low)
        order, begin, group = _groups([low, hashes])  # segments
        least = np.minimum.reduceat(first[order], begin)[group]
        key_order, key_begin, key_group = _groups([low])  # keys
        docs = first[key_order]
        shared = (np.minimum.reduceat(docs, key_begin) != np.maximum.reduceat(docs, key_begin)) | np.logical_or.reduceat(
            several[key_order], key_begin)
        h = hashes[key_order]
        mixed = np.minimum.reduceat(h, key_begin) != np.maximum.reduceat(h, key_begin)
        later = least < first
        partial = ~later & (shared & mixed)[key_group]
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "later": pa.array([_bits(x) for x in np.split(later, cuts)], type=pa.binary()),
                         "partial": pa.array([_bits(x) for x in np.split(partial, cuts)], type=pa.binary())})
    sent = chunks.mapInArrow(send, "bucket int, chunk long, low binary, hash binary, first binary, several binary")
    decided = sent.groupBy("bucket").applyInArrow(decide, "chunk long, bucket int, later binary, partial binary")
    return _to_chunks(decided, "segment_bits", "bucket", "later", "partial")


SEGMENT_SCHEMA = "key long, chunk long, entry int, doc long, windows int, data binary"


def partial_segments(chunks: DataFrame, buckets: int) -> DataFrame:
    """The bytes of the segments that may match in part, once per distinct segment."""
    def run(batches):
        for w in _each(batches, buckets):
            for some in np.array_split(np.flatnonzero(w.partial), len(w.partial) // 50_000 + 1):
                at = w.sample[some]
                data = [w.chunk.data[a:b] for a, b in zip(w.start[at].tolist(), (w.start[at] + w.size[at] + MATCH - 1).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.entry_id[some]), pa.array(np.full(len(some), w.chunk.chunk)), pa.array(some.astype(np.int32)),
                     pa.array(w.first[some]), pa.array(w.size[at].astype(np.int32)), pa.array(data, type=pa.binary())],
                    names=[x.split()[0] for x in SEGMENT_SCHEMA.split(", ")])
    return keep_table(chunks.mapInArrow(run, SEGMENT_SCHEMA), "lpf_segments")


# --- suffix order and the longest-previous-factor test ---------------------------------------

def window_order(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array of the window starts, whether each equals the window before it in that
    order): suffixes compared on their first ``MATCH`` bytes, eight at a time."""
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray(shape=(len(text),), dtype=">u8", buffer=padded, strides=(1,))
    at = [*range(0, MATCH - 7, 8)] + ([MATCH - 8] if MATCH % 8 else [])
    columns = [words[starts + o].astype(np.uint64) for o in at]
    order = np.lexsort(columns[::-1])
    same = np.ones(len(starts), dtype=bool)
    same[:1] = False
    for c in columns:
        same[1:] &= c[order[1:]] == c[order[:-1]]
    return order, same


def has_earlier(order: np.ndarray, same: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a window's previous or next smaller document in suffix order has its bytes.

    Running minima from both sides, which start anew where the common prefix falls short."""
    _, doc = np.unique(doc, return_inverse=True)
    group = np.cumsum(~same)
    d = doc[order].astype(np.int64)
    step = int(d.max(initial=0)) + 2
    down = np.minimum.accumulate(d - group * step) + group * step  # smallest so far within the group
    up = (np.minimum.accumulate((d + group * step)[::-1])[::-1]) - group * step
    out = np.empty(len(d), dtype=bool)
    out[order] = (down < d) | (up < d)
    return out


MASK_SCHEMA = "chunk long, entry int, mask binary"


def _masks(t: pa.Table) -> pa.RecordBatch:
    """Per segment, the windows that occur in a smaller document than its first; without any, no row."""
    data = t.column("data").to_pylist()
    size = t.column("windows").to_numpy().astype(np.int64)
    begin = np.cumsum([0] + [len(x) for x in data])[:-1]
    text = np.frombuffer(b"".join(data), dtype=np.uint8)
    starts = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    found = has_earlier(*window_order(text, starts), np.repeat(t.column("doc").to_numpy(), size))
    chunk, entry = t.column("chunk").to_pylist(), t.column("entry").to_pylist()
    return _rows("chunk entry mask", "lib", [
        (chunk[i], entry[i], _bits(x)) for i, x in enumerate(np.split(found, np.cumsum(size)[:-1])) if x.any()])


def segment_masks(found: DataFrame, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """(chunk, entry, mask): the windows of each segment that a smaller document has."""
    hot = keep_table(found.groupBy("key").agg(F.sum("windows").alias("n")).where(F.col("n") > hot_windows).select(
        "key", F.lit(True).alias("hot")), "lpf_hot_keys")
    marked = found.join(small_side(hot), "key", "left")  # few keys: segments stay where they are
    usual = marked.where("hot is null").drop("hot").repartition("key").sortWithinPartitions("key")

    def run(batches):
        held, windows = None, 0  # rows not yet handled; the last key may go on in the next batch
        for batch in batches:
            for piece in sliced(batch, "data", 4 << 20):
                t = pa.Table.from_batches([piece])
                held = t if held is None else pa.concat_tables([held, t])
                windows += int(t.column("windows").to_numpy().sum())
                if windows < BATCH_WINDOWS:
                    continue
                key = held.column("key").to_numpy()
                cut = int(np.searchsorted(key, key[-1]))  # sorted: where the last key begins
                if cut:
                    yield _masks(held.slice(0, cut))
                    held = held.slice(cut)
                    windows = int(held.column("windows").to_numpy().sum())
        if held is not None and held.num_rows:
            yield _masks(held)

    def cut_windows(batches):
        for batch in batches:
            for piece in sliced(batch, "data", 1 << 20):
                columns = zip(*(piece.column(c).to_pylist() for c in ("chunk", "entry", "doc", "windows", "data")))
                yield _rows("chunk entry doc place window", "lilib", [
                    (c, e, d, i, x[i:i + MATCH]) for c, e, d, n, x in columns for i in range(n)])
    # a hot key's segments have met in one partition: deal them out before they unfold
    single = marked.where("hot").select("chunk", "entry", "doc", "windows", "data").repartition("chunk", "entry").mapInArrow(
        cut_windows, "chunk long, entry int, doc long, place int, window binary")
    # written, so that the join below has plain exchanges on both sides, which Spark can split
    firsts = keep_table(single.groupBy("window").agg(F.min("doc").alias("least")), "lpf_hot_windows")
    places = single.join(firsts, "window").groupBy("chunk", "entry").agg(
        F.max("place").alias("last"), F.collect_list(F.when(F.col("least") < F.col("doc"), F.col("place"))).alias("gone"))

    def to_mask(batches):
        for batch in batches:
            rows = []
            for chunk, entry, last, gone in zip(*(c.to_pylist() for c in batch.columns)):
                bits = np.zeros(last + 1, dtype=bool)
                bits[gone] = True
                rows.append((chunk, entry, _bits(bits)))
            yield _rows("chunk entry mask", "lib", rows)
    return usual.mapInArrow(run, MASK_SCHEMA).unionByName(places.where(F.size("gone") > 0).mapInArrow(to_mask, MASK_SCHEMA))


# --- removal ---------------------------------------------------------------------------------

DEDUP_SCHEMA = "doc_id long, text string, kept binary, n_bytes long, n_removed long, n_spans long"


def _kept_bytes(w: Work, masks: list) -> np.ndarray:
    """Which bytes of a chunk stay."""
    edge = np.zeros(len(w.chunk.data) + 1, dtype=np.int32)

    def gone(begin, end):
        np.add.at(edge, begin, 1)
        np.add.at(edge, end, -1)
    if len(w.flagged):
        first = w.doc_ids(w.flagged) == w.first[w.entry_of]
        whole = w.flagged[w.later[w.entry_of] | ~first]  # a smaller document has the whole segment
        gone(w.start[whole], w.start[whole] + w.size[whole] - 1 + MATCH)
        at = np.full(len(w.entry_id), -1)
        at[[m["entry"] for m in masks or ()]] = np.arange(len(masks or ()))
        own = np.flatnonzero(first & (at[w.entry_of] >= 0) & ~w.later[w.entry_of])
        for r, m in zip(w.flagged[own].tolist(), at[w.entry_of[own]].tolist()):
            windows = w.start[r] + np.flatnonzero(_flags(masks[m]["mask"], int(w.size[r])))
            gone(windows, windows + MATCH)
    return np.cumsum(edge)[:-1] <= 0


def dedup_substrings(docs: DataFrame, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """Per document: the kept bytes (cuts may fall within a character; ``text`` leaves broken ones
    out), and what was removed."""
    chunks = pack_chunks(docs)
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES + 1)
    shared = shared_keys(chunks, buckets)
    bits = segment_bits(_with(chunks, shared), buckets)
    masks = segment_masks(partial_segments(_with(chunks, shared, bits), buckets), hot_windows)
    per_chunk = _to_chunks(masks, "masks", "entry", "mask")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                w = Work(row, buckets)
                kept, data, ids = _kept_bytes(w, row["masks"]), np.frombuffer(w.chunk.data, dtype=np.uint8), w.chunk.ids
                out = [[] for _ in range(4)]
                for begin, end in zip(w.chunk.begins.tolist(), w.chunk.ends.tolist()):
                    own = kept[begin:end]
                    n = int(own.sum())
                    spans = int((~own[1:] & own[:-1]).sum()) + int(len(own) > 0 and not own[0])
                    for column, value in zip(out, (data[begin:end][own].tobytes(), end - begin, end - begin - n, spans)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=ids == NULL_ID), pa.array([x.decode("utf-8", "ignore") for x in out[0]]),
                     pa.array(out[0], type=pa.binary()), *(pa.array(c, type=pa.int64()) for c in out[1:])],
                    names=["doc_id", "text", "kept", "n_bytes", "n_removed", "n_spans"])
    return _with(chunks, shared, bits, per_chunk).mapInArrow(run, DEDUP_SCHEMA)


def op8(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
