"""Joins and ordered series that stay parallel when one key holds a large share of the rows.

Three building blocks, each exact:

* `salted_join`   - an equi join whose hot keys are spread over salts.
* `running`       - running aggregates in two levels: inside (key, block), then over one
                    summary row per block. No task sees a whole key.
* `chunks`        - row-position chunks with the neighbouring rows a frame needs copied in, so
                    that lag, lead and rolling frames run per (key, chunk).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch.functions.hashing import salt
from tidewatch.sources.layers import settle

DEFAULT_SALTS = 8
CHUNK_ROWS = 65536
BLOCK_ROWS = 1_000_000

POSITION = "_position"
CHUNK = "_chunk"
HALO = "_halo"


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    condition: Column | None = None,
    how: str = "inner",
    salts: int = DEFAULT_SALTS,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Join `big` to `small` on equal keys, each key of `big` spread over `salts` tasks.

    `small` is replicated once per salt, so it should hold few rows per key. The salt comes
    from the row's own values (`spread`, by default all columns), so a retried task places
    every row where it was before. The join itself is not hinted: with a small build side the
    engine still turns it into a broadcast join, after checking its size. The copies come from a
    cross join, which that check multiplies by; exploded copies it would not see, and many rows
    would go through the driver. The key columns come once, from `big`; `condition` may name the
    other columns of both sides. Outer rows are kept for `how="left"` only.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    spread = list(spread) or list(big.columns)
    left = big.withColumn("_salt", salt(salts, *spread))
    keys = {name: f"_key_{name}" for name in on}
    right = salt_copies(small.withColumnsRenamed(keys), salts, "_salt_copy")
    match = F.col("_salt") == F.col("_salt_copy")
    for name, renamed in keys.items():
        match = match & (F.col(name) == F.col(renamed))
    if condition is not None:
        match = match & condition
    return left.join(right, match, how).drop("_salt", "_salt_copy", *keys.values())


def salt_copies(df: DataFrame, salts: int, out: str) -> DataFrame:
    """Every row once per salt, the salt in the column `out`; the engine's estimate of the size grows with the copies."""
    numbers = df.sparkSession.range(salts).select(F.col("id").cast("int").alias(out))
    return df.crossJoin(F.broadcast(numbers))


def _local(fn: str, value: Column, window: WindowSpec) -> Column:
    if fn == "last":
        return F.last(value, ignorenulls=True).over(window)
    return getattr(F, fn)(value).over(window)


def _summary(fn: str, value: Column, order: Sequence[str]) -> Column:
    if fn == "last":
        return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    return getattr(F, fn)(value)


def _carry(fn: str, name: str, window: WindowSpec) -> Column:
    if fn == "last":
        return F.last(name, ignorenulls=True).over(window)
    merge = "sum" if fn == "count" else fn
    return getattr(F, merge)(name).over(window)


def _combine(fn: str, local: str, carry: str) -> Column:
    if fn == "last":
        return F.coalesce(F.col(local), F.col(carry))
    if fn in ("max", "min"):
        pick = F.greatest if fn == "max" else F.least
        return pick(F.col(local), F.col(carry))
    return F.when(F.col(local).isNull() & F.col(carry).isNull(), None).otherwise(
        F.coalesce(F.col(local), F.lit(0)) + F.coalesce(F.col(carry), F.lit(0))
    )


def running(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    block: Column,
    columns: Mapping[str, tuple[str, str | Column]],
    ties: bool = False,
) -> DataFrame:
    """Add running aggregates, from the start of each key up to the row.

    `columns` maps an output name to (function, input); functions are max, min, sum, count and
    last (the last non-null value). `block` must grow with the first order column, and keeps
    rows of equal order together. `ties=True` lets rows of equal order share the value (a RANGE
    frame), otherwise a ROWS frame is used. The second level holds one row per (key, block).
    `df` is read twice, so give it a table (see `sources.layers.settle`), not a long plan.
    Rows with the same null key are one series, like those of any other key.
    """
    values = {out: (fn, F.col(c) if isinstance(c, str) else c) for out, (fn, c) in columns.items()}
    df = df.withColumn("_block", block)
    local = Window.partitionBy(*key, "_block").orderBy(*order)
    local = (
        local.rangeBetween(Window.unboundedPreceding, 0)
        if ties
        else local.rowsBetween(Window.unboundedPreceding, 0)
    )
    inside = df.withColumns({f"_in_{o}": _local(fn, v, local) for o, (fn, v) in values.items()})

    totals = df.groupBy(*key, "_block").agg(
        *[_summary(fn, v, order).alias(f"_tot_{o}") for o, (fn, v) in values.items()]
    )
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *key,
        "_block",
        *[_carry(fn, f"_tot_{o}", before).alias(f"_pre_{o}") for o, (fn, _) in values.items()],
    )
    names = {name: f"_carried_{i}" for i, name in enumerate([*key, "_block"])}
    same = F.lit(True)
    for name, renamed in names.items():
        same = same & F.col(name).eqNullSafe(F.col(renamed))
    joined = inside.join(carried.withColumnsRenamed(names), same, "left")
    result = joined.withColumns(
        {o: _combine(fn, f"_in_{o}", f"_pre_{o}") for o, (fn, _) in values.items()}
    )
    return result.select(*[c for c in df.columns if c != "_block"], *values)


def chunks(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    block: Column,
    back: int,
    ahead: int = 0,
    size: int = CHUNK_ROWS,
) -> DataFrame:
    """Number the rows of each key and cut them into chunks of `size` rows.

    The last `back` rows of a chunk are copied to the next one and the first `ahead` rows to
    the previous one, flagged as halo. A frame of at most `back` rows behind and `ahead` rows
    ahead over `chunk_window` then sees what it would see over the whole key. `order` must be
    total within a key for a repeatable result. Finish with `drop_halo`.
    """
    if back > size or ahead > size:
        raise ValueError("a chunk must be at least as long as the frame")
    numbered = running(df, key, order, block, {POSITION: ("count", F.lit(1))})
    slot = F.pmod(F.col(POSITION) - 1, F.lit(size))
    home = F.floor((F.col(POSITION) - 1) / size).cast("bigint")
    none = F.lit(None).cast("bigint")
    copies = F.array(
        home,
        F.when(slot >= size - back, home + 1).otherwise(none) if back else none,
        F.when((slot < ahead) & (home > 0), home - 1).otherwise(none) if ahead else none,
    )
    return (
        numbered.withColumn("_home", home)
        .withColumn(CHUNK, F.explode(F.array_compact(copies)))
        .withColumn(HALO, F.col(CHUNK) != F.col("_home"))
        .drop("_home")
    )


def chunk_window(key: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*key, CHUNK).orderBy(POSITION)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(HALO, CHUNK, POSITION)


def value_blocks(df: DataFrame, column: str, out: str = "_part", rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds a block number that grows with `column`; a block holds about `rows` rows, equal values together.

    Blocks are range partitions, so their number follows the data. The result is written, which
    fixes the partition that each row was in.
    """
    n = max(1, -(-df.count() // rows))
    return settle(df.repartitionByRange(n, column).withColumn(out, F.spark_partition_id()), "value-blocks")
