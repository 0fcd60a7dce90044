"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

1. Every usable vector is scaled to unit length in double precision and quantised with a scale
   of its own: ``u = s * q + e`` with ``q`` in int8 (largest absolute entry 127).  The lengths of
   ``s * q`` and ``e`` are kept; by Cauchy and Schwarz the true cosine of two vectors differs from
   ``s1 * s2 * (q1 . q2)`` by at most ``|s1 q1| |e2| + |e1| (|s2 q2| + |e2|)``.
2. Vectors are dealt into tiles by the hash of a unique row number, so that tiles have about
   the same size whatever the data hold: copies and hot groups spread over all tiles.  Tiles
   grow with the table (``TILE`` to ``MAX_TILE`` vectors), and every pair of tiles is one task group.
3. A task multiplies the codes of two tiles (exact: sums of int8 products), drops every pair
   whose bound lies below the threshold, and computes the others again in double precision.
   It returns, per vector, how many partners it found and the smallest row of its connected
   group within the two tiles: at most one row per vector and task, never the pairs.
4. Counts are summed per vector, the stars go to the distributed components.

No pair is skipped, so the arithmetic is quadratic (half the square of the table in int8
products); what moves is each tile to the tasks it takes part in, not one row per pair.

Defined cases: a vector that is null, empty, all zero or holds a null or non-finite component links
with nothing (its own class); vectors of different lengths never link; repeated
rows and equal ids are vectors of their own that link with each other; a null id counts as the
largest id; components of any finite size are scaled first, so no square overflows; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.llm.common import id_key, keep_table
from treeclass.llm.components import components
from treeclass.session import Scratch

THRESHOLD = 0.95
#: Vectors of a tile: the smallest and the largest size, and the number of tiles aimed at between.
TILE, MAX_TILE, TILES = 4096, 65_536, 128
#: Pairs of a block of a tile product, and pairs verified at once.
BLOCK, SLICE = 1 << 20, 65_536
#: Room for the rounding of bounds computed in double precision.
SLACK = 1e-9

TILE_SCHEMA = "tile int, dims int, n int, rows binary, vectors binary"
FOUND_SCHEMA = "row long, links long, root long"


def tile_table(rows: DataFrame, dims: int, tiles: int) -> DataFrame:
    """One row per tile: row numbers and unit vectors (double precision)."""
    def pack(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("row").to_numpy(), kind="stable")
        flat = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)[order]
        flat = flat / np.abs(flat).max(axis=1, keepdims=True)
        unit = flat / np.linalg.norm(flat, axis=1, keepdims=True)
        return pa.table({"tile": pa.array([group.column("tile")[0].as_py()], pa.int32()), "dims": pa.array([dims], pa.int32()),
                         "n": pa.array([len(unit)], pa.int32()),
                         "rows": pa.array([group.column("row").to_numpy()[order].astype(np.int64).tobytes()], pa.binary()),
                         "vectors": pa.array([unit.tobytes()], pa.binary())})
    dealt = rows.select(F.pmod(F.xxhash64("row"), F.lit(tiles)).cast("int").alias("tile"), "row", "v")
    return dealt.groupBy("tile").applyInArrow(pack, TILE_SCHEMA)


class Tile:
    """A tile in a task: unit vectors, int8 codes and what the bounds need."""

    def __init__(self, rows: bytes, vectors: bytes, dims: int):
        self.rows = np.frombuffer(rows, dtype=np.int64)
        self.unit = np.frombuffer(vectors, dtype=np.float64).reshape(-1, dims)
        self.scale = np.abs(self.unit).max(axis=1) / 127
        self.codes = np.rint(self.unit / self.scale[:, None]).astype(np.int8)
        back = self.codes * self.scale[:, None]
        self.kept = np.linalg.norm(back, axis=1)
        self.error = np.linalg.norm(self.unit - back, axis=1)
        # products of codes are exact in this type: below 2^24 in single, 2^53 in double precision
        self.exact = np.float32 if dims * 127 * 127 < 1 << 24 else np.float64


def possible_pairs(a: Tile, b: Tile, threshold: float, same: bool):
    """(i, j) index arrays of the pairs whose bound reaches the threshold, block by block."""
    right, top = b.codes.astype(a.exact).T.copy(), b.scale.max()
    kept, error = b.kept.max(), b.error.max()
    step = max(1, BLOCK // len(b.unit))
    for at in range(0, len(a.unit), step):
        part = slice(at, at + step)
        product = a.codes[part].astype(a.exact) @ right
        # first against the loosest bound of the tile: one comparison a pair
        loose = threshold - SLACK - a.kept[part] * error - a.error[part] * (kept + error)
        i, j = np.nonzero(product >= np.where(loose > 0, loose / (a.scale[part] * top), -np.inf)[:, None].astype(np.float64))
        # then against the bound of the pair itself
        cosine = product[i, j].astype(np.float64)
        i += at
        if same:
            upper = i < j
            i, j, cosine = i[upper], j[upper], cosine[upper]
        bound = cosine * a.scale[i] * b.scale[j] + a.kept[i] * b.error[j] + a.error[i] * (b.kept[j] + b.error[j])
        near = bound >= threshold - SLACK
        yield i[near], j[near]


def verified(a: Tile, b: Tile, i: np.ndarray, j: np.ndarray, threshold: float):
    """The pairs whose cosine in double precision reaches the threshold."""
    keep = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), SLICE):
        part = slice(at, at + SLICE)
        keep[part] = np.einsum("ij,ij->i", a.unit[i[part]], b.unit[j[part]]) >= threshold
    return i[keep], j[keep]


def merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (the smallest node of each node's group) after the edges (i, j) are added."""
    while len(i):
        i, j = root[i], root[j]
        apart = i != j
        i, j = i[apart], j[apart]
        # only roots are hooked, always to a smaller root: groups stay whole and no cycle forms
        np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def linked(a: Tile, b: Tile, same: bool, threshold: float) -> pa.Table:
    """Links of each vector of two tiles, and the smallest row of its group there."""
    rows = a.rows if same else np.concatenate([a.rows, b.rows])
    order = np.argsort(rows, kind="stable")  # nodes by row number: the smallest node is the smallest row
    place = np.empty_like(order)
    place[order] = np.arange(len(rows))
    links, root = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
    for i, j in possible_pairs(a, b, threshold, same):  # a block's pairs are folded in before the next
        i, j = verified(a, b, i, j, threshold)
        j = j if same else j + len(a.rows)
        links += np.bincount(i, minlength=len(rows)) + np.bincount(j, minlength=len(rows))
        root = merge(root, place[i], place[j])
    some = np.flatnonzero(links)
    return pa.table({"row": pa.array(rows[some]), "links": pa.array(links[some]), "root": pa.array(rows[order][root[place]][some])})


def tile_links(tiles: DataFrame, count: int, threshold: float) -> DataFrame:
    """(row, links, root) of every pair of tiles; a task group holds two tiles."""
    def run(group: pa.Table) -> pa.Table:
        parts = [Tile(r["rows"], r["vectors"], r["dims"]) for r in sorted(
            group.select(["tile", "rows", "vectors", "dims"]).to_pylist(), key=lambda r: r["tile"])]
        return linked(parts[0], parts[-1], len(parts) == 1, threshold)
    other = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    met = tiles.withColumn("other", other).select(
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "dims", "rows", "vectors")
    return met.groupBy("low", "high").applyInArrow(run, FOUND_SCHEMA)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", tile: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept): links of each vector with cosine at or above the
    threshold (over 0), and the smallest id that can be reached over links.  ``tile``: vectors of
    a tile (default: by the size of the table)."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    with Scratch(spark, "tiles") as scratch:
        # row numbers are unique and written once, so that they stay
        rows = scratch.keep(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("vec_id"),
                                           id_key(id_col).alias("id"), v.alias("v")).withColumn("usable", usable), "vectors")
        sizes = {r.dims: r.n for r in rows.where("usable").groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).collect()}
        found = None
        for dims, n in sizes.items():  # one length as a rule
            size = tile or min(MAX_TILE, max(TILE, -(-n // TILES)))
            count = -(-n // size)
            tiles = scratch.keep(tile_table(rows.where(F.col("usable") & (F.size("v") == dims)), dims, count), "tiles")
            part = tile_links(tiles, count, threshold)
            found = part if found is None else found.unionByName(part)
        ids = rows.select("row", "vec_id", "id")
        if found is None:
            out = ids.withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("id"))
        else:
            found = scratch.keep(found, "found")
            links = found.groupBy("row").agg(F.sum("links").alias("n_links"))
            roots = components(found.select(F.col("row").alias("u"), F.col("root").alias("v")))
            classed = scratch.keep(ids.join(links, "row", "left").join(roots.withColumnRenamed("node", "row"), "row", "left").select(
                "row", "vec_id", "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "row").alias("root")), "classes")
            least = classed.groupBy("root").agg(F.min("id").alias("component_id"))
            # only rows with links meet their class: the others are classes of their own
            alone = classed.where("n_links = 0").withColumn("component_id", F.col("id"))
            out = classed.where("n_links > 0").join(least, "root").select(*alone.columns).unionByName(alone)
        return keep_table(out.select("vec_id", "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")),
                          "vector_classes")


def op13(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)


#: Fixed value: the same in DuckDB, all pairs of a small table.
ORACLE_SQL = """
with recursive
ok as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(list_filter(embedding::double[], lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding::double[], lambda x: x <> 0)) > 0),
unit as (select vec_id, v, sqrt(list_inner_product(v, v)) as norm from ok),
link as (
  select a.vec_id as u, b.vec_id as w from unit a join unit b on a.vec_id <> b.vec_id
  where list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.95),
reach(u, w) as (select u, w from link union select r.u, l.w from reach r join link l on l.u = r.w),
least as (select u, min(w) as w from reach group by u),
degree as (select u, count(*) as n from link group by u)
select e.vec_id, coalesce(d.n, 0) as n_links, least(e.vec_id, coalesce(m.w, e.vec_id)) as component_id,
       coalesce(m.w, e.vec_id) >= e.vec_id as kept
from embeddings e left join least m on m.u = e.vec_id left join degree d on d.u = e.vec_id
"""
