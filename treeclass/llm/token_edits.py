"""Edit-aware token counts with segment trees over pre-tokens.

``build_trees`` cuts each text into pre-tokens (byte-level BPE merges never cross them, so a
text's count is the sum over its pre-tokens), groups ``LEAF`` neighbours into a leaf, and
keeps two segment trees per document: characters and tokens of each leaf, with the sums of
their subtrees.  The trees are stored; the text is not needed to read a count.

``apply_edits`` takes edits (start, end, replacement; in characters of the text before any
edit).  Per touched region it descends the character tree to the leaf that holds the
position two characters before the edit (a pre-token depends on at most two characters
after its end), re-encodes from that leaf's first character on, and stops as soon as a new
pre-token ends where an untouched leaf of the old text ends: the pattern never looks back, so
all that follows is as before.  The changed leaves get the new pre-tokens and only the sums on
their paths to the roots are brought up to date.

Edits that overlap an earlier one (by start, then end) are not applied and are counted in
``n_skipped``; positions are cut to the text; null replacements delete.

Defined cases: texts and runs of white space may have any length, a text is held whole by one task; a
null text is empty (it can still get insertions); null or empty edit lists change
nothing; a null id is kept; repeated rows each get their row; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.llm import tokens
from treeclass.llm.common import sliced

LEAF = 16
CACHE = 200_000
TASK_BYTES = 4 << 20
_PRETOKEN = tokens.PRETOKEN


class Counter:
    """Token counts of pre-tokens; those met are kept, up to ``CACHE``."""

    def __init__(self, ranks: str):
        self.bpe, self.known = tokens.encoder(ranks), {}

    def counts(self, pieces: list[str]) -> list[int]:
        known, out = self.known, []
        for p in pieces:
            n = known.get(p)
            if n is None:
                if len(known) >= CACHE:
                    known.clear()
                n = len(tokens.piece_ids(self.bpe, p))
                if len(p) <= 64:
                    known[p] = n
            out.append(n)
        return out


class SumTree:
    """Sums of leaves in one array: node i has children 2i and 2i + 1, the root is node 1."""

    def __init__(self, nodes: np.ndarray):
        self.nodes, self.size = nodes, len(nodes) // 2

    @classmethod
    def of(cls, leaves: np.ndarray) -> "SumTree":
        size = 1
        while size < len(leaves):
            size *= 2
        nodes = np.zeros(2 * size, dtype=np.int64)
        nodes[size:size + len(leaves)] = leaves
        level = size
        while level > 1:
            nodes[level // 2:level] = nodes[level:2 * level:2] + nodes[level + 1:2 * level:2]
            level //= 2
        return cls(nodes)

    @property
    def total(self) -> int:
        return int(self.nodes[1])

    def leaf_at(self, position: int) -> tuple[int, int]:
        """(leaf, sum before it): the leaf that holds ``position``, found from the root down."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if position >= before + self.nodes[node]:
                before += int(self.nodes[node])
                node += 1
        return node - self.size, before

    def put(self, leaf: int, value: int) -> None:
        """Set a leaf and add the difference to the sums above it."""
        node = leaf + self.size
        change = value - int(self.nodes[node])
        while node and change:
            self.nodes[node] += change
            node //= 2


def plant(text: str, counter: Counter) -> tuple[SumTree, SumTree]:
    """The trees (characters, tokens) of a text."""
    pieces = _PRETOKEN.findall(text)
    at = np.arange(0, len(pieces), LEAF)
    if not len(at):
        return SumTree.of(np.zeros(1)), SumTree.of(np.zeros(1))
    chars = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    return SumTree.of(np.add.reduceat(chars, at)), SumTree.of(np.add.reduceat(np.array(counter.counts(pieces)), at))


def usable(edits: list[dict] | None, length: int) -> tuple[list[tuple[int, int, str]], int]:
    """Edits in order, cut to the text, and the number of those that overlap an earlier one."""
    cut = sorted((min(max(e["start"] or 0, 0), length), min(max(e["end"] or 0, e["start"] or 0, 0), length),
                  e["replacement"] or "") for e in edits or () if e is not None)
    out: list[tuple[int, int, str]] = []
    for e in cut:
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out, len(cut) - len(out)


def edit(text: str, chars: SumTree, counts: SumTree, edits: list[tuple[int, int, str]],
         counter: Counter) -> tuple[str, int]:
    """Apply ordered edits: the new text and the number of pre-tokens encoded again; the trees are updated."""
    parts, at = [], 0
    for start, end, new in edits:
        parts += [text[at:start], new]
        at = end
    after = "".join([*parts, text[at:]])
    old_chars = SumTree(chars.nodes.copy())  # positions of the text before the edits
    encoded, shift, i = 0, 0, 0  # shift: new position minus old one, after the edits done
    while i < len(edits):
        first, begin = old_chars.leaf_at(max(0, edits[i][0] - 2)) if old_chars.total else (0, 0)
        first = min(first, old_chars.size - 1)
        pieces, changed = [], [first]
        old_end = begin + int(old_chars.nodes[old_chars.size + first])  # end of the last leaf taken in
        position, done = begin + shift, False
        for m in _PRETOKEN.finditer(after, position):
            pieces.append(m.group())
            position = m.end()
            while True:  # take in edits and leaves that the new pre-tokens have reached
                if i < len(edits) and edits[i][0] - 2 <= old_end:
                    shift += len(edits[i][2]) - (edits[i][1] - edits[i][0])
                    old_end_needed = edits[i][1]
                    i += 1
                    while old_end < old_end_needed and changed[-1] + 1 < old_chars.size:
                        changed.append(changed[-1] + 1)
                        old_end += int(old_chars.nodes[old_chars.size + changed[-1]])
                elif position > old_end + shift and changed[-1] + 1 < old_chars.size and old_end < old_chars.total:
                    changed.append(changed[-1] + 1)
                    old_end += int(old_chars.nodes[old_chars.size + changed[-1]])
                else:
                    break
            if position == old_end + shift and not (i < len(edits) and edits[i][0] - 2 <= old_end):
                done = True
                break
        if not done:  # the new text has ended: no leaf after the last edit is left as it was
            while i < len(edits):
                shift += len(edits[i][2]) - (edits[i][1] - edits[i][0])
                i += 1
            while changed[-1] + 1 < old_chars.size and old_end < old_chars.total:
                changed.append(changed[-1] + 1)
                old_end += int(old_chars.nodes[old_chars.size + changed[-1]])
        n = counter.counts(pieces)
        encoded += len(pieces)
        per = -(-len(pieces) // len(changed)) or 1
        for k, leaf in enumerate(changed):
            chars.put(leaf, sum(map(len, pieces[k * per:(k + 1) * per])))
            counts.put(leaf, sum(n[k * per:(k + 1) * per]))
    return after, encoded


TREE_SCHEMA = "doc_id long, text string, edits array<struct<start: int, end: int, replacement: string>>, char_tree array<int>, token_tree array<int>"


def build_trees(docs: DataFrame, ranks: str) -> DataFrame:
    """``docs`` (doc_id, text, edits) with the trees of every whole text, as arrays of nodes."""
    def run(batches):
        counter = Counter(ranks)
        for whole in batches:
            for batch in sliced(whole, "text", TASK_BYTES):
                trees = [plant(t or "", counter) for t in batch.column("text").to_pylist()]
                columns = [pa.array([t[k].nodes for t in trees], type=pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(batch.columns + columns, names=[*batch.schema.names, "char_tree", "token_tree"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "edits").mapInArrow(
        run, TREE_SCHEMA)


EDITED_SCHEMA = ("doc_id long, text string, char_tree array<int>, token_tree array<int>, n_edits long, n_skipped long, "
                 "n_tokens_before long, n_tokens long, n_reencoded long, n_leaves long")


def apply_edits(trees: DataFrame, ranks: str) -> DataFrame:
    """Edited texts with their updated trees and counts."""
    def run(batches):
        counter = Counter(ranks)
        for whole in batches:
            for batch in sliced(whole, "text", TASK_BYTES):
                out = []
                for row in zip(*(batch.column(c) for c in ("text", "edits", "char_tree", "token_tree"))):
                    text = row[0].as_py() or ""
                    chars, counts = (SumTree(x.values.to_numpy().astype(np.int64)) for x in row[2:])
                    edits, skipped = usable(row[1].as_py(), len(text))
                    before = counts.total
                    text, encoded = edit(text, chars, counts, edits, counter)
                    out.append((text, chars.nodes, counts.nodes, len(edits), skipped, before, counts.total, encoded, chars.size))
                kinds = [pa.string()] + [pa.list_(pa.int32())] * 2 + [pa.int64()] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")] + [pa.array(c, type=t) for c, t in zip(zip(*out), kinds)],
                    names=[x.strip().split()[0] for x in EDITED_SCHEMA.split(",")])
    return trees.mapInArrow(run, EDITED_SCHEMA)


def match_starts(gaps: pd.Series, sizes: pd.Series) -> pd.Series:
    """Places of a text's matches from the lengths of the matches and of the gaps around them:
    running sums, in time linear in the matches (Spark's array functions would copy the list per match)."""
    return pd.Series([np.cumsum(g[:len(s)]) + np.cumsum(s) - s for g, s in zip(gaps, sizes)], index=gaps.index, dtype=object)


def redactions(docs: DataFrame) -> DataFrame:
    """(doc_id, text, edits): a source line before every text, and e-mail addresses, links and
    long numbers replaced by a mark.  Found by Spark's own pattern functions: the text between
    matches gives their places."""
    # look-behind and possessive runs: a long run of address characters is scanned once
    pattern = (r"(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]++@[A-Za-z0-9.-]++|https?://[^\s]++"
               r"|(?<![0-9+])\+?[0-9][0-9 -]{6,}[0-9]")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, lambda m: F.length(m))
    starts = F.pandas_udf(match_starts, "array<int>")(F.transform(gaps, lambda g: F.length(g)), sizes)
    placed = F.transform(F.arrays_zip(starts.alias("at"), sizes.alias("size")), lambda x: F.struct(
        x["at"].alias("start"), (x["at"] + x["size"]).alias("end"), F.lit("[removed]").alias("replacement")))
    head = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"),
                            F.concat(F.lit("Source: "), F.coalesce(F.col("source").cast("string"), F.lit("")), F.lit("\n")).alias("replacement")))
    return docs.select("doc_id", text.alias("text"), F.concat(head, placed).alias("edits"))


def op2(docs: DataFrame, ranks: str) -> DataFrame:
    """Token counts of every document before and after redaction, through the trees."""
    edited = apply_edits(build_trees(redactions(docs), ranks), ranks)
    return edited.select("doc_id", "n_edits", "n_skipped", "n_tokens_before", "n_tokens", "n_reencoded", "n_leaves",
                         F.sha2("text", 256).alias("text_sha256"))
