"""Integer and uniform values derived from md5, the same on every engine and every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(text: Column) -> Column:
    """The first 32 bits of md5 as a non-negative bigint."""
    return F.conv(F.substring(F.md5(text.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash52(text: Column) -> Column:
    """The first 52 bits of md5: exact as a bigint and as a double."""
    return F.conv(F.substring(F.md5(text.cast("string")), 1, 13), 16, 10).cast("bigint")


def unit_uniform(text: Column) -> Column:
    """A value strictly between 0 and 1."""
    return (hash32(text) + F.lit(0.5)) / F.lit(4294967296.0)


def salt(buckets: int, *columns) -> Column:
    """A repeatable bucket number: unlike rand() it survives the re-run of a lost task.

    Declared non-null, or a join on it would evaluate it once more to filter nulls.
    """
    return F.coalesce(F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int"), F.lit(0))
