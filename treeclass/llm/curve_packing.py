"""Sequence packing along a space-filling curve.

1. Tokens: the public byte-level BPE file, whole texts, then the separator id 0.  Pre-tokens
   are merged independently, so a rank-file encoder with the same vocabulary gives the ids of
   the JSON file (tested against it).
2. Vector: token counts hashed into ``BUCKETS`` signed buckets, scaled to length one and
   projected on ``DIMS`` fixed random directions; the coordinates are cut into ``2**BITS``
   cells and turned into a Hilbert key, so documents with similar tokens get near keys.
3. Order: the small rows (id, key, length) are range-sorted by (key, id); the place of each
   document in the one token stream is its partition's start plus a running sum within it.
4. Cutting: the stream is cut every ``length`` ids, so all sequences but the last are full.
   Documents meet their places by id again, and each task cuts its own.

The ids travel compressed and only once; no task or the driver holds more than the totals of
the sort's partitions.

Defined cases: a null or empty text is the separator alone; the vocabulary's added token counts as
one id; runs of white space may have any length; a text is held whole by one task, with 2 bytes an
id; a null id sorts last; rows with equal key and id are ordered by their row number; an empty table
gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeclass.llm.common import id_key, keep_table, sliced
from treeclass.llm.tokens import all_ids, encoder

LENGTH = 1024
SEPARATOR = 0
DIMS, BITS, BUCKETS = 3, 10, 256
TASK_BYTES = 2 << 20


@lru_cache(maxsize=1)
def _projection() -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each id with its sign (bucket + BUCKETS for minus), and the directions."""
    rng = np.random.default_rng(9)
    return rng.integers(0, 2 * BUCKETS, 1 << 16), rng.standard_normal((BUCKETS, DIMS))


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of integer cells (rows of coordinates of ``bits`` bits):
    Gray-code form, undoing the exchanges and reflections from the highest bit down."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    odd = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        odd ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= odd
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


def vector_cells(ids: np.ndarray) -> np.ndarray:
    """Grid cell of one document's projected vector; unit vectors stay within [-1, 1] or so."""
    bucket, directions = _projection()
    counts = np.bincount(bucket[ids], minlength=2 * BUCKETS)
    v = (counts[:BUCKETS] - counts[BUCKETS:]).astype(float)
    norm = np.linalg.norm(v)
    point = (v / norm if norm else v) @ directions / 2
    return np.clip((point + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


TOKEN_SCHEMA = "row long, doc_id long, key long, n long, ids binary"


def token_table(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(row, doc_id, key, n, ids), written below the scratch folder; ``row`` is unique."""
    def run(batches):
        bpe = encoder(vocabulary)
        pack = zstandard.ZstdCompressor(level=1).compress
        row = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in sliced(whole, "text", TASK_BYTES):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids = [np.array([*x, SEPARATOR], dtype=np.uint16) for x in all_ids(bpe, texts)]
                cells = np.array([vector_cells(x) for x in ids]).reshape(-1, DIMS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(ids))), batch.column("doc_id"),
                     pa.array(hilbert_key(cells, BITS)), pa.array([len(x) for x in ids], type=pa.int64()),
                     pa.array([pack(x.tobytes()) for x in ids], type=pa.binary())],
                    names=["row", "doc_id", "key", "n", "ids"])
                row += len(ids)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return keep_table(rows.mapInArrow(run, TOKEN_SCHEMA), "token_ids")


def stream_places(tokens: DataFrame) -> DataFrame:
    """(row, begin): the first position of each document in the stream of all documents."""
    spark = tokens.sparkSession
    order = ["key", "id", "row"]
    small = tokens.select("row", "key", "n", id_key().alias("id"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written once: the number of the partition must be that of the rows read later
    dealt = keep_table(small.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "curve_order")
    totals = sorted(tuple(r) for r in dealt.groupBy("part").agg(F.sum("n")).collect())  # one row a partition
    begins, at = [], 0
    for part, n in totals:
        begins.append((part, at))
        at += n
    starts = spark.createDataFrame(begins, "part int, base long")
    running = F.sum("n").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return dealt.withColumn("before", F.coalesce(running, F.lit(0))).join(F.broadcast(starts), "part").select(
        "row", (F.col("base") + F.col("before")).alias("begin"))


PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                "offset long, ids array<int>")


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: where they lie in the padded sequences, with their ids."""
    tokens = token_table(docs, vocabulary)
    placed = tokens.select("row", "doc_id", "n", "ids").join(stream_places(tokens), "row")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for batch in sliced(whole, "ids", TASK_BYTES // 2):
                yield _cut([np.frombuffer(unpack(x), dtype=np.uint16).astype("<u4") for x in batch.column("ids").to_pylist()],
                           batch.column("doc_id").to_pylist(), batch.column("begin").to_pylist(), length, with_ids)
    return placed.mapInArrow(run, PIECE_SCHEMA)


def _cut(ids: list[np.ndarray], docs: list, begins: list[int], length: int, with_ids: bool) -> pa.RecordBatch:
    out = [[] for _ in range(7)]
    for x, doc, at in zip(ids, docs, begins):
        start = 0
        while start < len(x):
            n = min(len(x) - start, length - at % length)
            values = (doc, start, n, zlib.crc32(x[start:start + n]), len(x), at // length, at % length)
            for column, value in zip(out, values):
                column.append(value)
            at, start = at + n, start + n
    if with_ids:
        ends = np.concatenate([[0], np.cumsum(out[2], dtype=np.int64)])
        listed = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
    else:
        listed = pa.nulls(len(out[0]), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=pa.int64()) for c in out] + [listed],
        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])


def op9(docs: DataFrame, vocabulary: str) -> DataFrame:
    return pack(docs, vocabulary, with_ids=False).drop("ids")
