"""SimHash near-duplicates with pivot distance tables.

Fingerprint: lower-cased (A-Z) white-space words, shingles of ``shingle_words`` words joined
by a blank (fewer words: the whole sequence), XXH64 with seed 42; a bit is set when it is set
in over half of the shingle hashes.  No words: fingerprint zero, linked like any other.

Linking, over distinct fingerprints only (copies share one row):

1. Pivot table: the Hamming distances of every fingerprint to ``len(PIVOTS)`` reference
   fingerprints, computed once and carried as one byte each.
2. Comparison blocks.  The triangle inequality, |d(a,p) - d(b,p)| <= d(a,b), says which pairs
   can be discarded, but over 64 random bits a single pivot keeps about 46 % of all pairs, so
   the table alone cannot tell which pairs need not be met at all.  Pairs meet when they agree
   on two of five bit bands: three differing bits touch at most three bands, so no link is lost.
3. Within a block a pair is discarded when any pivot coordinate differs by more than the
   maximum distance; the survivors are verified by their exact distance.  A block gives a
   spanning forest of its links (each row linked to an earlier one), never all its pairs.
4. A key with more than ``BLOCK_ROWS`` rows is cut into sub-blocks which meet pairwise in
   tasks of their own, so no task holds more than two sub-blocks of a key.

Components over the forests give the classes; fingerprint copies join by equality.

Defined cases: null or wordless texts have fingerprint zero; a null id counts as the largest id;
repeated rows each get their row; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.llm.common import id_key, keep_table, sliced
from treeclass.llm.components import components

SEED = 42
#: Reference fingerprints: the hashes of 1..24.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(1, 25)], dtype=np.uint64)
BANDS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
BLOCK_ROWS = 4096
TASK_BYTES = 8 << 20


def shingle_hashes(text: str | None, shingle_words: int) -> bytes:
    """Big-endian XXH64 values of all shingles, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and [\x20\x09-\x0D] only
    if not words:
        return b""
    if len(words) <= shingle_words:
        return xxhash.xxh64_digest(b" ".join(words), SEED)
    digest, joined = xxhash.xxh64_digest, b" ".join(words)
    out, start, ends = [], 0, []
    for w in words:
        start += len(w) + 1
        ends.append(start - 1)
    start = 0
    for first, end in zip(words, ends[shingle_words - 1:]):
        out.append(digest(joined[start:end], SEED))
        start += len(first) + 1
    return b"".join(out)


def majority(hashes: bytes) -> int:
    """The fingerprint of big-endian hashes; counted in blocks, so long texts need little memory."""
    h = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i:i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp long): the fingerprint's 64 bits as a signed long."""
    def run(batches):
        for whole in batches:
            for batch in sliced(whole, "text", TASK_BYTES):
                fps = [majority(shingle_hashes(t, shingle_words)) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                    names=["doc_id", "fp"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, fp long")


def pivot_table(distinct: DataFrame) -> DataFrame:
    """Adds ``dist``: one byte per pivot, the distance to it."""
    distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(p)))) for p in PIVOTS.view(np.int64)]
    return distinct.withColumn("dist", F.unhex(F.concat(*(F.lpad(F.hex(d), 2, "0") for d in distances))))


def _block_keys() -> list:
    """Ten keys: the bits of two bands, marked with the pair's number."""
    masks = [((1 << width) - 1) << at for at, width in BANDS]
    pairs = [(i, j) for i in range(5) for j in range(i + 1, 5)]
    signed = [int(np.uint64(masks[i] | masks[j]).view(np.int64)) for i, j in pairs]
    return [F.struct(F.lit(n).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for n, m in enumerate(signed)]


def _near(a, b, fps, dist, bits):
    """The pairs (a, b) of rows that link: discarded pivot by pivot, then verified exactly."""
    for p in range(dist.shape[1]):  # few pairs reach the later pivots
        ok = np.abs(dist[a, p] - dist[b, p]) <= bits
        a, b = a[ok], b[ok]
        if not len(a):
            return a, b
    ok = np.bitwise_count(fps[a] ^ fps[b]) <= bits
    return a[ok], b[ok]


def _forest(fps: np.ndarray, dist: np.ndarray, side: np.ndarray, begins: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within groups of rows (``begins`` marks their first rows).

    ``side``: rows of one group with equal sides (not -1) don't meet here but in another task."""
    n = len(fps)
    group = np.cumsum(begins) - 1
    sizes = np.bincount(group, minlength=1)
    label = np.arange(n)
    small = sizes <= 8
    for step in range(1, min(8, n)):  # small groups: all of them at once, one offset at a time
        a = np.flatnonzero((group[:-step] == group[step:]) & small[group[:-step]])
        a = a[(side[a] == -1) | (side[a] != side[a + step])]
        for i, j in zip(*(x.tolist() for x in _near(a, a + step, fps, dist, bits))):
            while label[i] != i:
                i = label[i]
            while label[j] != j:
                j = label[j]
            label[max(i, j)] = min(i, j)
    for g in np.flatnonzero(~small):
        start = np.searchsorted(group, g)
        end = start + sizes[g]
        own = label[start:end]  # a view; root of a row is a row of its group
        for i in range(start, end - 1):
            b = np.arange(i + 1, end)
            b = b[(side[i] == -1) | (side[b] != side[i])]
            _, b = _near(np.full(len(b), i), b, fps, dist, bits)
            if len(b):
                roots = np.unique(np.append(label[b], label[i]))
                if len(roots) > 1:
                    own[np.isin(own, roots)] = roots[0]
    while (label != label[label]).any():
        label = label[label]
    child = np.flatnonzero(label != np.arange(n))
    return fps[child], fps[label[child]]


def links(distinct: DataFrame, bits: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(u, v): edges whose components are those of all pairs at ``bits`` or fewer differing bits."""
    if not 0 <= bits <= 3:
        raise ValueError("the bands are complete for 0 to 3 differing bits")
    keyed = pivot_table(distinct).select("fp", "dist", F.explode(F.array(*_block_keys())).alias("k")).select(
        "fp", "dist", "k.band", "k.bits")
    key = ["band", "bits"]
    shared = keyed.groupBy(*key).count().where("count > 1")
    met = keyed.join(shared, key)
    # hot keys: sub-block s meets the others in tasks (s, t) and (t, s) -> (low, high)
    n = F.ceil(F.col("count") / F.lit(block_rows)).cast("int")
    met = met.withColumn("n", n).withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    met = met.select(*key, F.least("sub", "other").alias("low"), F.greatest("sub", "other").alias("high"),
                     "sub", "fp", "dist")
    task = [*key, "low", "high"]
    dealt = met.repartition(*task).sortWithinPartitions(*task, "fp")

    def run(batches):
        tail = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if tail is not None:
                t = pa.concat_tables([tail, t])
            cut = _last_group(t, task)
            tail = t.slice(cut)
            if cut:
                yield from _linked(t.slice(0, cut), task, bits)
        if tail is not None and tail.num_rows:
            yield from _linked(tail, task, bits)
    return dealt.mapInArrow(run, "u long, v long")


def _change(t: pa.Table, columns: list[str]) -> np.ndarray:
    """Whether a row begins a new group of the sorted ``columns``."""
    new = np.zeros(t.num_rows, dtype=bool)
    new[:1] = True
    for c in columns:
        x = t.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return new


def _last_group(t: pa.Table, columns: list[str]) -> int:
    """Where the last group begins, which the next batch may continue."""
    at = np.flatnonzero(_change(t, columns))
    return int(at[-1]) if len(at) else 0


def _linked(t: pa.Table, columns: list[str], bits: int):
    fps = t.column("fp").to_numpy().view(np.uint64)
    dist = np.frombuffer(b"".join(t.column("dist").to_pylist()), dtype=np.uint8).reshape(len(fps), -1).astype(np.int8)
    cross = t.column("low").to_numpy() != t.column("high").to_numpy()
    side = np.where(cross, t.column("sub").to_numpy(), -1)
    child, root = _forest(fps, dist, side, _change(t, columns), bits)
    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(root.view(np.int64))], names=["u", "v"])


def near_duplicates(docs: DataFrame, shingle_words: int = 3, bits: int = 3) -> DataFrame:
    """(doc_id, fp long, component_id): the smallest doc_id of each document's component."""
    fps = keep_table(fingerprints(docs, shingle_words), "fingerprints")
    distinct = keep_table(fps.groupBy("fp").agg(F.min(id_key()).alias("least")), "distinct_fingerprints")
    roots = components(links(distinct.select("fp"), bits))
    # the class of a fingerprint, then its smallest document
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    member = classes.join(named, "root").select("fp", "component_id")
    return fps.join(member, "fp").select("doc_id", "fp", "component_id")


def op7(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
