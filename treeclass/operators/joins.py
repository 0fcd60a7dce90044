"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.session import cut_lineage, fits

DEFAULT_BROADCAST_MAX_ROWS = 1_000_000


def broadcast_max_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("treeclass.broadcastMaxRows",
                                        str(DEFAULT_BROADCAST_MAX_ROWS)))


def small_side(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when it provably has at most ``max_rows`` rows.

    Otherwise the frame is returned as is and the planner shuffles both sides
    (sort-merge join, with AQE splitting skewed partitions at run time).
    """
    limit = broadcast_max_rows(df) if max_rows is None else max_rows
    return F.broadcast(df) if fits(df, limit) else df


def bounded_by(table: DataFrame):
    """Broadcast hint for frames with at most as many rows as ``table`` (or a small multiple):
    one size check of the materialised table instead of one for each frame derived from it."""
    return F.broadcast if fits(table, broadcast_max_rows(table)) else (lambda df: df)


DEFAULT_SALTS = 32


def salt_count(df: DataFrame) -> int:
    """Salts of a shuffled lookup: ``treeclass.skewSalts``.  A key with a third of all rows is
    spread over that many tasks; size it as (rows of the hottest key) / (rows a task may
    hold).  AQE splits what is still skewed."""
    return int(df.sparkSession.conf.get("treeclass.skewSalts", str(DEFAULT_SALTS)))


DEFAULT_BROADCAST_MAX_BYTES = 256 << 20


def broadcast_max_bytes(spark) -> int:
    return int(spark.conf.get("treeclass.broadcastMaxBytes", str(DEFAULT_BROADCAST_MAX_BYTES)))


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                broadcast: bool | None = None, salt_key: str = "id",
                max_rows: int | None = None) -> DataFrame:
    """Join a large frame to a lookup table whose keys may be hot.

    The lookup side is broadcast when it provably has at most ``max_rows`` rows
    (or when the caller already proved it: ``broadcast=True``).  Otherwise the join
    is salted: each big row gets salt ``pmod(hash(salt_key), S)`` and every lookup
    row is replicated once per salt, so one hot key (a word in a third of all
    items, the root node of every item) is spread over ``S`` tasks instead of
    one.  The extra cost is ``S`` copies of the lookup table, independent of the
    data.  Inner, left, left-semi and left-anti semantics are unchanged: a big
    row meets exactly one copy of each matching lookup row.
    """
    if broadcast is None:
        limit = broadcast_max_rows(small) if max_rows is None else max_rows
        broadcast = fits(small, limit)
    if broadcast:
        return big.join(F.broadcast(small), on, how)
    if salt_key not in big.columns:
        # no per-item column (e.g. the lexicon itself, unique per word): no hot key
        return big.join(small, on, how)
    n = salt_count(big)
    salted_big = big.withColumn("_salt", F.pmod(F.hash(F.col(salt_key)), F.lit(n)))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return salted_big.join(salted_small, [*on, "_salt"], how).drop("_salt")


DEFAULT_FREQUENT_KEYS = 200_000

#: One item in so many is counted to find frequent keys; it decides where a row is joined, never whether.
COUNTED = 16


def frequent_keys(big: DataFrame, on: list[str], max_keys: int, item: str = "id") -> DataFrame:
    """At most ``max_keys`` of the most frequent keys, counted on the items whose hashed id is
    divisible by ``COUNTED``.  The bound is met by a power of two of the count: the driver sees at most
    a row per power."""
    part = big.where(F.pmod(F.xxhash64(item), F.lit(COUNTED)) == 0)
    counts = cut_lineage(part.groupBy(*on).agg(F.floor(F.log2(F.count("*"))).alias("_power")))
    least, total = None, 0
    for r in sorted(counts.groupBy("_power").count().collect(), key=lambda r: -r["_power"]):
        total += r["count"]
        if total > max_keys:
            break
        least = r["_power"]
    return (counts.where(F.lit(False)) if least is None else counts.where(F.col("_power") >= least)).select(*on)


def frequent_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", broadcast: bool | None = None,
                  max_keys: int | None = None, item: str = "id") -> DataFrame:
    """Join (``inner`` or ``left``) of a large frame to a lookup table that may be too large to broadcast.

    A table within the bound is broadcast whole (``broadcast``: as in ``lookup_join``).  Otherwise only
    its rows of the frequent keys are (``treeclass.frequentKeys``, or fewer by ``max_keys``): most rows of
    ``big`` then meet theirs where they lie.  The rows of all other keys are shuffled with one copy of the
    table; none of those keys is hot."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if broadcast is None:
        broadcast = fits(small, broadcast_max_rows(small))
    if broadcast:
        return big.join(F.broadcast(small), on, how)
    limit = int(big.sparkSession.conf.get("treeclass.frequentKeys", str(DEFAULT_FREQUENT_KEYS)))
    keys = frequent_keys(big, on, limit if max_keys is None else min(limit, max_keys), item)
    found = keys.join(small.join(F.broadcast(keys), on, "left_semi"), on, how)
    near = big.join(F.broadcast(found), on)
    far = big.join(F.broadcast(keys), on, "left_anti").join(small, on, how)
    return near.unionByName(far)
