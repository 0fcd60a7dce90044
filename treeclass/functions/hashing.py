"""Feature hashing expressions.

``murmur_bucket`` is Spark's Murmur3 ``hash`` taken modulo the bucket count; it
equals the bucket the reference's hashing term-frequency transformer assigns.
``md5_bucket`` is a portable alternative that other SQL engines can reproduce.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def murmur_bucket(term: Column | str, num_buckets: int) -> Column:
    return F.pmod(F.hash(_col(term)), F.lit(num_buckets)).cast("int")


def md5_hash(value: Column | str) -> Column:
    """First 32 bits of md5 of the string form, as a non-negative bigint."""
    return F.conv(F.substring(F.md5(_col(value).cast("string")), 1, 8), 16, 10).cast("bigint")


def md5_bucket(term: Column | str, num_buckets: int) -> Column:
    return (md5_hash(term) % F.lit(num_buckets)).cast("int")


def bucket(term: Column | str, num_buckets: int, hash_fn: str = "murmur3") -> Column:
    if hash_fn == "murmur3":
        return murmur_bucket(term, num_buckets)
    if hash_fn == "md5":
        return md5_bucket(term, num_buckets)
    raise ValueError(f"unknown hash_fn {hash_fn!r}")
