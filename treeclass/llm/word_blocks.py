"""Words of chunks of text, counted over all chunks without a row for every word of a chunk.

A chunk of documents has its distinct words, joined by line feeds (no word holds one), with the number
of times each occurs.  It sends them in blocks, one for each part of the words (dealt by the words' hash);
the task of a part adds the counts of all chunks, and what it finds goes back to each chunk by a join
on the chunk.  Parts are as many as hold ``PART_WORDS`` words of chunks each.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.session import buckets

#: Words of chunks to a part, on average at most.
PART_WORDS = 1_000_000

#: What chunks have: ``words`` and ``counts`` (``planes``) are packed, ``n`` sums the counts, ``distinct`` words.
WORDS_SCHEMA = "chunk long, lang string, words binary, counts binary, n long, distinct long"
BLOCK_SCHEMA = "chunk long, part int, lang string, words binary, counts binary"
#: A word (``id`` not null), or the kept words of a chunk's block: their places in it, and ``id`` or ``f`` of each.
COUNTED_SCHEMA = "id long, lang string, word string, f long, chunk long, part int, kept binary"


def squeezed(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.astype(np.int32).tobytes())


def codes(b: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=np.int32)


def planes(*columns: np.ndarray) -> bytes:
    """Columns of equal length; equal bytes of the numbers stand together."""
    rows = np.stack([c.astype(np.int64) for c in columns])
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(rows.view(np.uint8).reshape(len(rows), -1, 8).swapaxes(1, 2)).tobytes())


def columns(b: bytes, n: int) -> np.ndarray:
    planes_ = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=np.uint8).reshape(n, 8, -1)
    return np.ascontiguousarray(planes_.swapaxes(1, 2)).view(np.int64)[:, :, 0]


def packed(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def unpacked(b: bytes) -> list[bytes]:
    words = zstandard.ZstdDecompressor().decompress(b)
    return words.split(b"\n") if words else []


def decoded(b: bytes) -> list[str]:
    words = zstandard.ZstdDecompressor().decompress(b).decode()
    return words.split("\n") if words else []


def dealt(words: list[bytes], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the words by part, where parts begin and end in it)."""
    part = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % parts
    return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def part_count(chunks: DataFrame) -> int:
    """Parts of the words of ``chunks`` (with the column ``distinct``)."""
    return max(buckets(chunks.sparkSession), -(-(chunks.agg(F.sum("distinct")).first()[0] or 0) // PART_WORDS))


def _blocks(chunks: DataFrame, parts: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, lang, words, counts = (batch.column(c)[i].as_py() for c in ("chunk", "lang", "words", "counts"))
                words = unpacked(words)
                counts = np.zeros(len(words), dtype=np.int64) if counts is None else columns(counts, 1)[0]
                order, ends = dealt(words, parts)
                held, at = np.flatnonzero(np.diff(ends)), order.tolist()
                cuts = list(zip(ends[held].tolist(), ends[held + 1].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(held), pa.int64()), pa.array(held, pa.int32()), pa.array([lang] * len(held), pa.string()),
                     pa.array([packed([words[i] for i in at[a:b]]) for a, b in cuts], pa.binary()),
                     pa.array([planes(counts[order[a:b]]) for a, b in cuts], pa.binary())],
                    names=["chunk", "part", "lang", "words", "counts"])
    return chunks.select("chunk", "lang", "words", "counts").mapInArrow(run, BLOCK_SCHEMA)


def counted(chunks: DataFrame, parts: int, min_count: int = 1, value: str = "id") -> DataFrame:
    """Every word of a language with ``min_count`` occurrences in all chunks, with a number of its own; and
    for each block the places of such words in it with their ``value`` (``id`` or ``f``).

    A row without a number of chunk only counts; one without counts only asks for the values of its words."""
    names = [c.split()[0] for c in COUNTED_SCHEMA.split(", ")]
    types = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]
             for c in COUNTED_SCHEMA.split(", ")]

    def rows(size: int, **given):
        return pa.RecordBatch.from_arrays(
            [pa.array(given[c], t) if c in given else pa.nulls(size, t) for c, t in zip(names, types)], names=names)

    def run(batches):
        of, langs, read, counts = [], [], [], []
        for batch in batches:
            of += zip(batch.column("chunk").to_pylist(), batch.column("part").to_pylist())
            langs += batch.column("lang").to_pylist()
            read += [pa.array(unpacked(b), pa.binary()) for b in batch.column("words").to_pylist()]
            counts += [columns(b, 1)[0] for b in batch.column("counts").to_pylist()]
        if not of:
            return
        ends = np.cumsum([0] + [len(r) for r in read])
        coded = pa.concat_arrays(read).dictionary_encode()
        words, known = coded.dictionary, {lang: i for i, lang in enumerate(sorted(set(langs)))}
        key = coded.indices.to_numpy().astype(np.int64) * len(known) + np.repeat([known[lang] for lang in langs], np.diff(ends))
        held = np.unique(key)
        place = np.searchsorted(held, key)
        f = np.zeros(len(held), dtype=np.int64)
        np.add.at(f, place, np.concatenate(counts))
        often = np.flatnonzero(f >= min_count)
        by_lang, text = held[often] % len(known), words.take(pa.array(held[often] // len(known)))
        # numbers follow the words, so that a task that is run again gives the same ones
        order = pa.compute.sort_indices(pa.table({"lang": by_lang, "word": text}), sort_keys=[
            ("lang", "ascending"), ("word", "ascending")]).to_numpy()
        often, number = often[order], np.zeros(len(held), dtype=np.int64)
        number[often] = (TaskContext.get().partitionId() << 33) + 1 + np.arange(len(often))
        at_langs = list(known)
        yield rows(len(often), id=number[often], lang=[at_langs[i] for i in by_lang[order].tolist()],
                   word=text.take(pa.array(order)).cast(pa.string()), f=f[often])
        mine = np.where(number > 0, number if value == "id" else f, 0)[place]
        for (chunk, part), a, b in zip(of, ends, ends[1:]):
            at = np.flatnonzero(mine[a:b])
            if len(at) and chunk is not None:
                yield rows(1, chunk=[chunk], part=[part], kept=[planes(np.diff(at, prepend=0), np.diff(mine[a:b][at], prepend=0))])
    return _blocks(chunks, parts).repartitionById(parts, F.col("part")).mapInArrow(run, COUNTED_SCHEMA)


def kept_by_chunk(found: DataFrame) -> DataFrame:
    """(chunk, kept): what was found of all blocks of a chunk."""
    return found.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("part", "kept")).alias("kept"))


def kept_words(words: list[bytes], kept: list[dict], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of a chunk's kept words among its ``words``, ascending; their values)."""
    order, ends = dealt(words, parts)
    found = [(ends[k["part"]], np.cumsum(columns(k["kept"], 2), axis=1)) for k in kept]
    at, values = order[np.concatenate([begin + k[0] for begin, k in found])], np.concatenate([k[1] for _, k in found])
    by = np.argsort(at)
    return at[by], values[by]
