"""Similar-patient search: sign-projection hashing, bucket join, distance, top k.

Queries are few and the index is large. The index is hashed where it lies; query buckets are
matched to it by an equi join on (table, bucket, salt), pairs flow straight into the distance,
and each task keeps its k best per query before anything is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import config
from tidewatch.functions.hashing import salt
from tidewatch.functions.numeric import plain_number, round_half_up
from tidewatch.operators.nearest import BLOCK_CELLS, Nearest, distinct, rounded_distance
from tidewatch.operators.skew import salt_copies, salted_join
from tidewatch.sources.layers import settle

DEFAULT_TABLES = 5
DEFAULT_BITS = 8
SEED = 42

RING = ["pivot", "second", "ring"]
#: Bounds give way by so much, more than distances are rounded by.
SLACK = 1e-5
#: Rows that are looked at first, as a multiple of the wanted ones.
FIRST_ROWS = 64


def projections(n_tables: int, n_bits: int, dims: int, seed: int = SEED) -> list[np.ndarray]:
    """One (bits x dims) Gaussian matrix per table, in the order of a seeded generator."""
    rng = np.random.RandomState(seed)
    return [rng.randn(n_bits, dims) for _ in range(n_tables)]


def bits_for(rows: int, per_bucket: int = 256) -> int:
    """Bits that leave about `per_bucket` rows in a bucket of an index of so many rows."""
    return max(1, math.ceil(math.log2(max(2, rows / per_bucket))))


class Moments(NamedTuple):
    """Two numbers per feature; small enough to be literals in every plan that uses them."""

    mean: list[float]
    spread: list[float]


def feature_moments(df: DataFrame, features: Sequence[str] = config.FEATURES) -> Moments:
    """Means and spreads of the zero-filled features, by one aggregate."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    row = df.agg(
        F.array(*[F.avg(c) for c in filled]).alias("mean"),
        F.array(*[F.stddev_pop(c) + F.lit(1e-9) for c in filled]).alias("spread"),
    ).first()
    empty = row["mean"][0] is None
    return Moments([0.0] * len(filled) if empty else row["mean"], [1.0] * len(filled) if empty else row["spread"])


def standardize_features(
    df: DataFrame, features: Sequence[str] = config.FEATURES, moments: Moments | None = None, out: str = "z"
) -> DataFrame:
    """Adds an array of standardized features; nulls become 0 first."""
    moments = feature_moments(df, features) if moments is None else moments
    scaled = [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(m)) / F.lit(s)
        for c, m, s in zip(features, moments.mean, moments.spread)
    ]
    return df.withColumn(out, F.array(*scaled))


def lsh_buckets(
    df: DataFrame, n_tables: int = DEFAULT_TABLES, n_bits: int = DEFAULT_BITS,
    dims: int = len(config.FEATURES), seed: int = SEED, vector: str = "z", out: str = "buckets",
) -> DataFrame:
    """Adds one bucket per table: the signs of its projections as a bit number.

    All projections of an Arrow batch are one matrix product; spelled out as column arithmetic
    they outgrow a compiled method, and array lambdas are interpreted.
    """
    planes = np.vstack(projections(n_tables, n_bits, dims, seed))
    weights = 1 << np.arange(n_bits)

    @F.pandas_udf("array<bigint>")
    def buckets(vectors: pd.Series) -> pd.Series:
        signs = np.stack(vectors.to_numpy()) @ planes.T >= 0
        return pd.Series(list(signs.reshape(-1, n_tables, n_bits) @ weights))

    # Marked nondeterministic so that filters inferred from its result do not run it again.
    return df.withColumn(out, buckets.asNondeterministic()(vector))


def lsh_hash(df: DataFrame, out: str = "buckets", **options) -> DataFrame:
    """The index in long form: one row per (row, table) with its bucket."""
    hashed = lsh_buckets(df, out=out, **options)
    return hashed.select("*", F.posexplode(out).alias("table_id", "bucket"))


def euclidean(a: Column, b: Column, dims: int) -> Column:
    total = (a[0] - b[0]) * (a[0] - b[0])
    for i in range(1, dims):
        total = total + (a[i] - b[i]) * (a[i] - b[i])
    return F.sqrt(total)


def lsh_bucket_join(probes: DataFrame, index: DataFrame, spread: str, salts: int = 8) -> DataFrame:
    """Pairs of probe and index rows that share a bucket in any table, each pair once.

    Both sides come from `lsh_hash`, the probes' bucket list under `q_buckets`. A pair that
    meets in several tables is kept where it meets first, which its two bucket lists tell, so
    nothing is gathered to remove duplicates. The index rows of a hot bucket are spread over
    salts by the column `spread`; the probes are copied once per salt.
    """
    left = salt_copies(probes, salts, "_salt")
    right = index.withColumn("_salt", salt(salts, spread))
    same = F.zip_with("q_buckets", "buckets", lambda a, b: a == b)
    first = F.array_position(same, F.lit(True)) == F.col("table_id") + 1
    return (
        right.join(left, ["table_id", "bucket", "_salt"])
        .filter(first)
        .drop("table_id", "bucket", "_salt", "q_buckets", "buckets")
    )


def topk_similar(pairs: DataFrame, query_key: str, index_key: str, k: int, distance: str = "distance") -> DataFrame:
    """The k nearest per query, ties by key. Each task keeps k per query before the shuffle."""
    w = Window.partitionBy(query_key).orderBy(distance, index_key)
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def lsh_index(
    history: DataFrame, key: str, moments: Moments, features: Sequence[str] = config.FEATURES,
    n_tables: int = DEFAULT_TABLES, n_bits: int = DEFAULT_BITS, seed: int = SEED, keep: Sequence[str] = (),
) -> DataFrame:
    """The searchable form of a table: key, standardized features, buckets, one row per table.

    The columns `keep` lie beside them, so that a search shows them without reading the table.
    """
    z = standardize_features(history.select(key, *features, *keep), features, moments)
    return lsh_hash(z, n_tables=n_tables, n_bits=n_bits, dims=len(features), seed=seed).select(
        key, *keep, "z", "buckets", "table_id", "bucket"
    )


def write_index(index: DataFrame, path: str) -> DataFrame:
    """The index as files by table and bucket, so that a search reads its own buckets only.

    Rows are rebalanced by bucket first: few files per bucket, and a hot bucket is split.
    """
    index.hint("rebalance", "table_id", "bucket").write.mode("overwrite").partitionBy("table_id", "bucket").parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def bucket_counts(rows: DataFrame) -> dict[int, dict[int, int]]:
    """The number of rows by table and bucket."""
    counts: dict[int, dict[int, int]] = {}
    for row in rows.groupBy("table_id", "bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(row["table_id"], {})[row["bucket"]] = row["n"]
    return counts


def in_buckets(wanted: Mapping[int, Sequence[int]]) -> Column:
    """A filter on (table_id, bucket) that names the buckets as literals."""
    found = F.lit(False)
    for table, buckets in sorted(wanted.items()):
        found = found | ((F.col("table_id") == table) & F.col("bucket").isin(sorted(buckets)))
    return found


def _block_nearest(z: np.ndarray, own: np.ndarray, q_z: np.ndarray, q_own: np.ndarray, table: int, k: int) -> tuple[np.ndarray, ...]:
    """(query, row, distance) of the k nearest rows of every query in one bucket, ties by place.

    Pairs that share a bucket of an earlier table are left out. One matrix product tells which rows can be among
    the k nearest; distances are exact, and taken of those only.
    """
    met = np.zeros((len(q_z), len(z)), bool)
    for t in range(table):
        met |= q_own[:, t][:, None] == own[:, t][None, :]
    wanted = ~met
    if np.isfinite(z).all() and np.isfinite(q_z).all() and len(z) > k:
        lengths, q_lengths = (z * z).sum(axis=1), (q_z * q_z).sum(axis=1)
        about = q_lengths[:, None] + lengths[None, :] - 2 * (q_z @ z.T)
        about[met] = np.inf
        slack = 1e-12 * (1 + q_lengths + lengths.max())
        most = (np.sqrt(np.maximum(np.partition(about, k - 1, axis=1)[:, k - 1], 0) + slack) + 2e-6) ** 2 + slack
        wanted &= about <= most[:, None]
    query, row = np.nonzero(wanted)
    distance = rounded_distance(z[row], q_z[query])
    order = np.lexsort((row, distance, query))
    query, row, distance = query[order], row[order], distance[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], row[keep], distance[keep]


def bucket_nearest(
    probes: DataFrame, index: DataFrame, query_key: str, key: str, k: int, dims: int, salts: int = 8, keep: Sequence[str] = (),
    many: bool = False,
) -> DataFrame:
    """The k nearest index rows per probe in each bucket, pairs that meet in several tables in the first of them.

    Both sides come from `lsh_hash`, as for `lsh_bucket_join`. A bucket is dealt over `salts` tasks: its index rows, each
    probe going to all, or with `many` its probes, each index row going to all. A task reads the index rows of
    a (table, bucket, salt) first, in order of their key, then meets the probes batch by batch, so pairs are no rows.
    """
    sides = [probes, index]
    sides[many] = salt_copies(sides[many], salts, "_salt")
    sides[not many] = sides[not many].withColumn("_salt", salt(salts, key if not many else query_key))
    left = sides[0].select("table_id", "bucket", "_salt", F.lit(True).alias("_asks"), query_key, F.col("q_z").alias("z"), F.col("q_buckets").alias("buckets"))
    right = sides[1].select("table_id", "bucket", "_salt", F.lit(False).alias("_asks"), key, *keep, "z", "buckets")
    names = {query_key: "_query", key: "_key", **{c: f"_keep_{c}" for c in keep}}
    both = right.withColumnsRenamed(names).unionByName(left.withColumnsRenamed(names), allowMissingColumns=True)
    tasks = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["table_id", "bucket", "_salt"]
    dealt = both.repartition(tasks, *group).sortWithinPartitions(*group, "_asks", "_key")
    shown = ["_key", *[f"_keep_{c}" for c in keep]]
    fields = [T.StructField(c, both.schema[c].dataType) for c in ("_query", *shown)]
    schema = T.StructType([*fields, T.StructField("distance", T.DoubleType())])

    def lists(column: pa.ChunkedArray, kind: str, width: int) -> np.ndarray:
        flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.astype(kind).reshape(-1, width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, held = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            marks = np.stack([table[c].to_numpy().astype(np.int64) for c in (*group, "_asks")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                piece, mark = table.slice(start, end - start), tuple(marks[:3, start])
                if mark != at:
                    at, parts, held = mark, [], None
                if not marks[3, start]:
                    parts.append(piece)
                    continue
                if not parts:
                    continue
                if held is None:
                    rows = pa.concat_tables(parts)
                    width = len(rows["buckets"][0])
                    held = rows.select(shown).combine_chunks(), lists(rows["z"], "f8", dims), lists(rows["buckets"], "i8", width)
                told, z, own = held
                q_z, q_own = lists(piece["z"], "f8", dims), lists(piece["buckets"], "i8", own.shape[1])
                step = max(1, BLOCK_CELLS // len(z))
                for i in range(0, len(q_z), step):
                    query, row, distance = _block_nearest(z, own, q_z[i : i + step], q_own[i : i + step], int(mark[0]), k)
                    found = told.take(row)
                    columns = [piece["_query"].take(pa.array(query + i)), *[found[c] for c in shown], pa.array(distance)]
                    yield from pa.table(columns, names=schema.names).to_batches()

    found = dealt.mapInArrow(search, schema)
    return found.withColumnsRenamed({v: n for n, v in names.items()})


#: Pairs that are not worth a round per table.
FEW_PAIRS = 1 << 26
#: Queries of a bucket that are worth a task of their own, and that are searched at once; index rows that a task holds.
LEAST_QUERIES, QUERIES_AT_ONCE, HELD_ROWS = 8192, 1 << 17, 1 << 20


class Round(NamedTuple):
    """What one round of `nearest_lists` searches: a table, a part of its index rows, and the tasks of hot buckets."""

    table: int
    part: int
    parts: int
    slices: dict[int, int]


def search_rounds(asked: Mapping[int, Mapping[int, int]], held: Mapping[int, Mapping[int, int]], tasks: int) -> list[Round]:
    """The tables in order of the pairs in their buckets, fewest first, as what they find bounds the search of the others.

    A bucket's queries are cut into slices that get all its rows. A slice has twice as many queries as the bucket has rows at least, so that
    copies cost less than the search, and not fewer than it takes to busy all tasks. Of large buckets a round holds a part of the rows.
    """
    rounds = []
    common = {t: {b: (n, held[t][b]) for b, n in asked[t].items() if b in held[t]} for t in asked if t in held}
    for t in sorted(common, key=lambda t: (sum(n * m for n, m in common[t].values()), t)):
        if not common[t]:
            continue
        share = sum(n for n, _ in common[t].values()) // (2 * tasks)
        parts = -(-max(m for _, m in common[t].values()) // HELD_ROWS)
        slices = {b: -(-n // max(LEAST_QUERIES, share, 2 * m // parts)) for b, (n, m) in common[t].items()}
        rounds += [Round(t, i, parts, {b: n for b, n in slices.items() if n > 1}) for i in range(parts)]
    return rounds


def _flat(column: pa.ChunkedArray, kind: str, width: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return pc.list_flatten(column).to_numpy().astype(kind, copy=False).reshape(-1, width)


def _merged(carried: pa.Array | None, told: pa.Table, distance: np.ndarray, place: np.ndarray, k: int) -> pa.Array:
    """Per query the k best of the carried list and of (distance, place in `told`), by distance and key; a place behind the rows is none.

    `told` has the key and then the columns that are shown.
    """
    n, kinds = len(place), [told.schema.field(i).type for i in range(told.num_columns)]
    columns = [told[c].combine_chunks() for c in told.column_names]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    here = place < told.num_rows
    distances, at = np.where(here, distance, np.inf), np.where(here, place, 0)
    values = [pa.array(distances[here]), *[c.take(pa.array(at[here])) for c in columns]]
    spot, there = np.where(here, np.cumsum(here).reshape(here.shape) - 1, -1), here
    if carried is not None:
        before = carried.flatten()
        lengths = pc.fill_null(pc.list_value_length(carried), 0).to_numpy(zero_copy_only=False)
        held = np.arange(k) < lengths[:, None]
        old = np.full((n, k), np.inf)
        old[held] = before.field(0).to_numpy(zero_copy_only=False)
        values = [pa.concat_arrays([before.field(i).cast(v.type), v]) for i, v in enumerate(values)]
        spot = np.concatenate([np.where(held, np.cumsum(held).reshape(held.shape) - 1, -1), np.where(here, spot + len(before), -1)], axis=1)
        distances, there = np.concatenate([old, distances], axis=1), np.concatenate([held, here], axis=1)
        tied = (there[:, :k, None] & there[:, None, k:] & (distances[:, :k, None] == distances[:, None, k:])).any(axis=(1, 2))
        # Entries that are none come last; each half is in order already.
        order = np.lexsort((np.broadcast_to(np.arange(2 * k), distances.shape), distances, ~there), axis=1)
        if tied.any():
            query, entry = np.nonzero(there & tied[:, None])
            entries = {"query": query, "distance": distances[query, entry], "key": values[1].take(pa.array(spot[query, entry]))}
            by = pc.sort_indices(pa.table(entries), sort_keys=[(c, "ascending") for c in entries], null_placement="at_start").to_numpy()
            ends = np.cumsum(np.bincount(query, minlength=n))
            rank = np.arange(len(query)) - np.concatenate([[0], ends[:-1]])[query]
            order[query, rank] = entry[by]
        spot, there = np.take_along_axis(spot, order[:, :k], axis=1), np.take_along_axis(there, order[:, :k], axis=1)
    values = [v.take(pa.array(spot[there])) for v in values]
    offsets = pa.array(np.concatenate([[0], np.cumsum(there.sum(axis=1))]), pa.int32())
    names = ["distance", *told.column_names]
    fields = [pa.field(c, kind) for c, kind in zip(names, [pa.float64(), *kinds])]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(values, fields=fields))


def nearest_lists(
    probes: DataFrame, index: DataFrame, query_key: str, key: str, k: int, dims: int, n_tables: int, keep: Sequence[str],
    asked: Mapping[int, Mapping[int, int]], held: Mapping[int, Mapping[int, int]],
) -> DataFrame:
    """Per query the list `nearest` of its k nearest index rows (distance, key, `keep`), by distance and key, among those that share a bucket.

    `probes` has `query_key`, q_z and q_buckets, `index` is that of `write_index`; both are counted by table and bucket
    (`asked`, `held`). Buckets that no query is in are not read. A round searches one table: queries meet the rows of their bucket, in cells of neighbouring rows, and carry
    their k best to the next round, where only rows nearer than those are looked at. A query's rows in a round are those
    that share no bucket of the tables before; such a row is among the k nearest of all only if it is among those of its bucket.
    """
    spark = probes.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shown = {key: "_key", **{c: f"_keep_{c}" for c in keep}}
    entry = T.StructType([T.StructField("distance", T.DoubleType()), *[T.StructField(n, index.schema[c].dataType) for c, n in shown.items()]])
    lists = T.ArrayType(entry)
    found = probes.select(F.col(query_key).alias("_query"), F.col("q_z").alias("z"), F.col("q_buckets").alias("buckets"), F.lit(None).cast(lists).alias("_nearest"))
    before: list[int] = []
    for r in search_rounds(asked, held, tasks):
        slices = F.lit(1)
        if r.slices:
            hot = F.create_map(*[F.lit(x).cast("bigint") for pair in sorted(r.slices.items()) for x in pair])
            slices = F.coalesce(F.try_element_at(hot, F.col("_bucket")), F.lit(1))
        rows = index.filter(in_buckets({r.table: list(asked[r.table])}))
        if r.parts > 1:
            rows = rows.filter(F.pmod(F.xxhash64(key), F.lit(r.parts)) == r.part)
        rows = rows.withColumnsRenamed(shown).select(F.col("bucket").cast("bigint").alias("_bucket"), F.lit(False).alias("_asks"), *shown.values(), "z", "buckets")
        rows = rows.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
        asks = found.select("*", F.col("buckets")[r.table].alias("_bucket"), F.lit(True).alias("_asks"))
        # Equal queries meet in one slice, where they are searched once.
        asks = asks.withColumn("_slice", F.pmod(F.xxhash64("z"), slices))
        both = rows.unionByName(asks, allowMissingColumns=True)
        dealt = both.repartition(tasks, "_bucket", "_slice").sortWithinPartitions("_bucket", "_slice", "_asks", "_key")
        search = _round_search(k, dims, n_tables, tuple(dict.fromkeys(t for t in before if t != r.table)), list(shown.values()), found.columns)
        found = dealt.mapInArrow(search, found.schema)
        before.append(r.table)
    names = ["distance", key, *keep]
    plain = F.transform("_nearest", lambda t: F.struct(*[t[old].alias(new) for old, new in zip(entry.names, names)]))
    return found.select(F.col("_query").alias(query_key), plain.alias("nearest"))


def _round_search(
    k: int, dims: int, n_tables: int, before: Sequence[int], shown: Sequence[str], columns: Sequence[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The search of one round for `mapInArrow`: of a (bucket, slice) the index rows come first, in order of their key, then the queries."""
    before = list(before)

    def answered(rows: tuple[pa.Table, np.ndarray, Nearest], asks: pa.Table) -> pa.Table:
        told, own, nearest = rows
        z = _flat(asks["z"], "f8", dims)
        order, begins = distinct(z)
        first, group = order[begins], np.empty(len(z), int)
        group[order] = np.cumsum(begins) - 1
        some = asks.take(pa.array(first))
        carried = some["_nearest"].combine_chunks()
        carried = carried.combine_chunks() if isinstance(carried, pa.ChunkedArray) else carried
        limit, lengths = np.full(len(first), np.inf), pc.fill_null(pc.list_value_length(carried), 0).to_numpy(zero_copy_only=False)
        if lengths.any():
            full = lengths == k
            limit[full] = carried.flatten().field(0).to_numpy(zero_copy_only=False)[np.cumsum(lengths)[full] - 1]
        distance, place = nearest.search(z[first], limit)
        q_own = _flat(some["buckets"], "i8", n_tables)
        met = np.append(own, np.full((1, n_tables), -1), axis=0)[place][:, :, before] == q_own[:, None, before]
        place = np.where(met.any(axis=2), told.num_rows, place)
        # What is left keeps its order; what was met goes to the end.
        order = np.argsort(place == told.num_rows, axis=1, kind="stable")
        distance, place = np.take_along_axis(distance, order, axis=1), np.take_along_axis(place, order, axis=1)
        lists = _merged(carried if lengths.any() else None, told, distance, place, k).take(pa.array(group))
        return asks.set_column(asks.schema.get_field_index("_nearest"), "_nearest", lists)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, rows, asks = None, [], None, []

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal rows
            if not asks:
                return
            table = pa.concat_tables(asks)
            asks.clear()
            if parts and rows is None:
                all_rows = pa.concat_tables(parts)
                rows = all_rows.select(shown), _flat(all_rows["buckets"], "i8", n_tables), Nearest(_flat(all_rows["z"], "f8", dims), k)
                parts[:] = [all_rows.slice(0, 0)]
            yield from (table if rows is None else answered(rows, table)).select(columns).to_batches(max_chunksize=16384)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            marks = np.stack([table[c].to_numpy().astype(np.int64) for c in ("_bucket", "_slice", "_asks")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                piece, mark = table.slice(start, end - start), tuple(marks[:2, start])
                if mark != at:
                    yield from out()
                    at, parts, rows = mark, [], None
                if not marks[2, start]:
                    parts.append(piece)
                    continue
                asks.append(piece)
                if sum(t.num_rows for t in asks) >= QUERIES_AT_ONCE:
                    yield from out()
        yield from out()

    return search


def lsh_search(
    queries: DataFrame, index: DataFrame, moments: Moments, key: str,
    features: Sequence[str] = config.FEATURES, k: int = 5, n_tables: int = DEFAULT_TABLES,
    n_bits: int = DEFAULT_BITS, seed: int = SEED, salts: int = 8, query_key: str = "query_id",
    keep: Sequence[str] = (), prune: bool = False,
) -> DataFrame:
    """The k nearest index rows per query among those sharing a bucket with it.

    `queries` holds `query_key` and the features. A query without bucket mates has no rows. With
    `prune` the index is a written one, of which no other folder is read than those of the queries' buckets, see `nearest_lists`.
    """
    if prune:
        lists = lsh_lists(queries, index, moments, key, features, k, n_tables, n_bits, seed, query_key, keep)
        found = lists.select(query_key, F.explode("nearest").alias("_t")).select(query_key, f"_t.{key}", *[f"_t.{c}" for c in keep], "_t.distance")
    else:
        z = standardize_features(queries.select(query_key, *features), features, moments, out="q_z")
        probes = lsh_hash(
            z, vector="q_z", out="q_buckets", n_tables=n_tables, n_bits=n_bits, dims=len(features), seed=seed
        ).select(query_key, "q_z", "q_buckets", "table_id", "bucket")
        found = bucket_nearest(probes, index, query_key, key, k, len(features), salts, keep)
    return topk_similar(found.select(query_key, key, *keep, "distance"), query_key, key, k)


def lsh_lists(
    queries: DataFrame, index: DataFrame, moments: Moments, key: str,
    features: Sequence[str] = config.FEATURES, k: int = 5, n_tables: int = DEFAULT_TABLES,
    n_bits: int = DEFAULT_BITS, seed: int = SEED, query_key: str = "query_id", keep: Sequence[str] = (), few: int | None = None,
) -> DataFrame:
    """(query_key, nearest): as `lsh_search` with `prune`, one row per row of `queries`, in it the list of its own k nearest.

    Up to `few` pairs (FEW_PAIRS) are compared in one round, each different query once; more go through `nearest_lists`.
    """
    z = standardize_features(queries.select(query_key, *features), features, moments, out="q_z")
    probes = lsh_buckets(z, n_tables, n_bits, len(features), seed, "q_z", "q_buckets").select(query_key, "q_z", "q_buckets")
    asked = bucket_counts(probes.select(F.posexplode("q_buckets").alias("table_id", "bucket")))
    read = index.filter(in_buckets(asked))
    held = bucket_counts(read)
    if sum(n * held.get(t, {}).get(b, 0) for t, counts in asked.items() for b, n in counts.items()) > (FEW_PAIRS if few is None else few):
        return nearest_lists(probes, index, query_key, key, k, len(features), n_tables, keep, asked, held)
    many = sum(sum(n.values()) for n in asked.values()) > sum(sum(n.values()) for n in held.values())
    named = probes.withColumn("_same", F.md5(F.concat_ws("|", F.transform("q_z", lambda v: v.cast("string")))))
    different = named.dropDuplicates(["_same"]).select("_same", "q_z", "q_buckets", F.posexplode("q_buckets").alias("table_id", "bucket"))
    found = topk_similar(bucket_nearest(different, read, "_same", key, k, len(features), keep=keep, many=many), "_same", key, k)
    lists = found.groupBy("_same").agg(F.sort_array(F.collect_list(F.struct("rank", "distance", key, *keep))).alias("_ranked"))
    plain = F.transform("_ranked", lambda t: F.struct(*[t[c].alias(c) for c in ("distance", key, *keep)]))
    return salted_join(named.select(query_key, "_same"), lists, ["_same"], how="left").select(query_key, plain.alias("nearest"))


def bits_measured(z: DataFrame, rows: int, per_bucket: int = 64, dims: int = len(config.FEATURES), seed: int = SEED) -> int:
    """Bits at which a row's bucket holds about `per_bucket` rows, itself included, as measured on the rows.

    Rows crowd in some buckets, and what a query meets is the mean over rows, not over buckets. Buckets of one table at
    the most useful number of bits are counted once; fewer bits merge those counts.
    """
    most = min(24, max(1, math.ceil(math.log2(max(2, rows)))) + 4)
    counts = lsh_buckets(z, 1, most, dims, seed).groupBy(F.col("buckets")[0].alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    widths = counts.select("n", "bucket", F.explode(F.sequence(F.lit(1), F.lit(most))).alias("bits"))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bits")) - 1
    sizes = widths.groupBy("bits", F.col("bucket").bitwiseAND(mask).alias("b")).agg(F.sum("n").cast("double").alias("n"))
    means = sizes.groupBy("bits").agg(F.try_divide(F.sum(F.col("n") * F.col("n")), F.sum("n")).alias("mean")).collect()
    return min([r["bits"] for r in means if r["mean"] <= per_bucket], default=most)


def probe_buckets(
    df: DataFrame, probes: int, n_tables: int = DEFAULT_TABLES, n_bits: int = DEFAULT_BITS,
    dims: int = len(config.FEATURES), seed: int = SEED, vector: str = "q_z", out: str = "q_probes",
) -> DataFrame:
    """Adds, per table, the buckets to look in: the vector's own, then its neighbours, nearest first.

    A neighbour differs in the bits of some hyperplanes; its distance is that of the vector to all of them, so
    the bits that nearly went the other way are turned over first. Of the nearest planes, as many as can matter are combined.
    """
    planes = projections(n_tables, n_bits, dims, seed)
    close = min(n_bits, max(1, probes.bit_length() + 2))
    subsets = np.arange(1 << close)[:, None] >> np.arange(close) & 1

    @F.pandas_udf("array<array<bigint>>")
    def buckets(vectors: pd.Series) -> pd.Series:
        found = []
        for v in vectors:
            tables = []
            for matrix in planes:
                side = matrix @ np.asarray(v)
                own = int((side >= 0) @ (1 << np.arange(n_bits)))
                gap = (side / np.linalg.norm(matrix, axis=1)) ** 2
                nearest = np.argsort(gap, kind="stable")[:close]
                order = np.argsort(subsets @ gap[nearest], kind="stable")[:probes]
                tables.append((own ^ (subsets[order] @ (1 << nearest))).tolist())
            found.append(tables)
        return pd.Series(found)

    return df.withColumn(out, buckets.asNondeterministic()(vector))


def probe_join(queries: DataFrame, index: DataFrame, spread: str, salts: int = 8) -> DataFrame:
    """Pairs of query and index rows where the row's bucket is among the query's probes of any table, each once.

    Pairs that meet in several tables are kept in the first of them, as both bucket lists tell. Index
    rows of a hot bucket are spread over salts.
    """
    asked = queries.select("*", F.posexplode("q_probes").alias("table_id", "_some")).withColumn("bucket", F.explode("_some"))
    left = salt_copies(asked.drop("_some"), salts, "_salt")
    right = index.withColumn("_salt", salt(salts, spread))
    meets = F.zip_with("q_probes", "buckets", lambda probes, bucket: F.array_contains(probes, bucket))
    first = F.array_position(meets, F.lit(True)) == F.col("table_id") + 1
    return right.join(left, ["table_id", "bucket", "_salt"]).filter(first).drop("table_id", "bucket", "_salt", "q_probes", "buckets")


def multi_probe_similar(
    queries: DataFrame, history: DataFrame, key: str, features: Sequence[str] = config.FEATURES, k: int = 5,
    n_tables: int = 4, probes: int = 8, n_bits: int | None = None, seed: int = SEED, query_key: str = "query_id",
    moments: Moments | None = None,
) -> DataFrame:
    """The k nearest rows among those in the probed buckets, with the number of `candidates` of each query.

    Bits follow from the measured sizes of buckets, which hold about as many rows however long the history is, and a
    query's candidates are those of at most tables times probes buckets. Ties go by key; a null feature is 0; a query that is
    a history row finds itself.
    """
    moments = feature_moments(history, features) if moments is None else moments
    if n_bits is None:
        n_bits = bits_measured(standardize_features(history.select(*features), features, moments), history.count(), 64, len(features), seed)
    index = lsh_index(history, key, moments, features, n_tables, n_bits, seed)
    z = standardize_features(queries.select(F.col(key).alias(query_key), *features), features, moments, out="q_z")
    asked = probe_buckets(z.select(query_key, "q_z"), probes, n_tables, n_bits, len(features), seed)
    pairs = probe_join(asked, index, key).select(
        query_key, key, round_half_up(euclidean(F.col("z"), F.col("q_z"), len(features)), 6).alias("distance")
    )
    counts = pairs.groupBy(query_key).agg(F.count(F.lit(1)).alias("candidates"))
    return topk_similar(pairs, query_key, key, k).join(counts, query_key)


def recall_against(found: DataFrame, exact: DataFrame, query_key: str = "query_id") -> DataFrame:
    """Share of exact results that a search reached: its result of the same rank is no farther away."""
    near = found.select(query_key, "rank", F.col("distance").alias("_reached"))
    both = exact.join(near, [query_key, "rank"], "left")
    hit = F.coalesce(F.col("_reached") <= F.col("distance"), F.lit(False))
    return both.agg(
        F.count_distinct(query_key).alias("queries"), F.count(F.lit(1)).alias("wanted"), F.count_if(hit).alias("reached")
    ).withColumn("recall", F.try_divide(F.col("reached"), F.col("wanted")))


def lsh_similar(
    queries: DataFrame, history: DataFrame, key: str, features: Sequence[str] = config.FEATURES,
    k: int = 5, n_tables: int = DEFAULT_TABLES, n_bits: int | None = None, seed: int = SEED,
    salts: int = 8, query_key: str = "query_id",
) -> DataFrame:
    """Index and search in one plan, for a few queries that are rows of `history` or like them.

    Without `n_bits` the buckets follow the number of rows, so that a query's candidates stay about
    as many however long the history is. A query that is also a history row finds itself at distance 0.
    """
    moments = feature_moments(history, features)
    n_bits = bits_for(history.count()) if n_bits is None else n_bits
    index = lsh_index(history, key, moments, features, n_tables, n_bits, seed)
    asked = queries.select(F.col(key).alias(query_key), *features)
    return lsh_search(asked, index, moments, key, features, k, n_tables, n_bits, seed, salts, query_key)


def choose_pivots(z: DataFrame, n: int, sample: int = 2048) -> np.ndarray:
    """Up to `n` vectors far from each other, among a bounded sample of the rows: those of the smallest hashes."""
    rows = z.select("z").distinct().orderBy(F.xxhash64("z"), "z").limit(sample).collect()
    vectors = np.array([r["z"] for r in rows])
    if not len(vectors):
        return vectors
    chosen = [0]
    gap = np.linalg.norm(vectors - vectors[0], axis=1)
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(vectors - vectors[chosen[-1]], axis=1))
    return vectors[chosen]


def pivot_distances(vector: Column, pivots: np.ndarray) -> Column:
    """Distances to all pivots, in their order."""
    return F.array(*[euclidean(vector, F.array(*map(F.lit, p.tolist())), len(p)) for p in pivots])


class PivotIndex(NamedTuple):
    """`rows` by their two nearest pivots and ring of distance to the nearest; `rings` has, of each, rows and the range of distances to every pivot."""

    rows: DataFrame
    rings: DataFrame
    pivots: np.ndarray


def pivot_index(z: DataFrame, key: str, n_pivots: int = 32, n_rings: int = 16) -> PivotIndex:
    """Index of (key, z): a ring per pair of pivots and step of distance, the steps a share of the largest distance to a nearest pivot.

    Rings are at most pivots squared times rings and one, whatever the number of rows; both follow the wanted fineness.
    """
    pivots = choose_pivots(z, n_pivots)
    if not len(pivots):
        none = z.select(key, "z", *[F.lit(0).alias(c) for c in RING])
        empty = z.select(*[F.lit(0).alias(c) for c in RING], F.lit(0).alias("n"), F.col("z").alias("low"), F.col("z").alias("high"))
        return PivotIndex(none.limit(0), empty.limit(0), pivots)
    far = settle(z.select(key, "z", pivot_distances(F.col("z"), pivots).alias("far")), "pivot-distances")
    nearest, next_one = F.array_min("far"), F.get(F.array_sort("far"), 1)
    step = far.agg(F.max(nearest)).first()[0] / n_rings or 1.0
    rows = far.select(
        key, "z", "far",
        F.array_position("far", nearest).cast("int").alias("pivot"),
        F.coalesce(F.array_position("far", next_one), F.lit(0)).cast("int").alias("second"),
        F.floor(nearest / step).cast("int").alias("ring"),
    )
    ends = [F.array(*[end(F.col("far")[i]) for i in range(len(pivots))]) for end in (F.min, F.max)]
    rings = rows.groupBy(*RING).agg(F.count(F.lit(1)).alias("n"), ends[0].alias("low"), ends[1].alias("high"))
    return PivotIndex(rows.drop("far"), settle(rings, "pivot-rings"), pivots)


def pivot_rings(z_queries: DataFrame, index: PivotIndex, query_key: str) -> DataFrame:
    """(query, vector, ring, n, least) for the queries, a handful, and all rings.

    No row of the ring is nearer than `least`, by the triangle inequality over every pivot.
    """
    asked = z_queries.withColumn("far", pivot_distances(F.col("q_z"), index.pivots))
    queries = asked.agg(F.collect_list(F.struct(query_key, "q_z", "far"))).scalar()
    both = index.rings.withColumn("_queries", queries).select("*", F.explode("_queries").alias("q"))
    gaps = F.zip_with(F.col("q.far"), F.arrays_zip("low", "high"), lambda far, end: F.greatest(end["low"] - far, far - end["high"], F.lit(0.0)))
    return both.select(
        F.col(f"q.{query_key}").alias(query_key), F.col("q.q_z").alias("q_z"), *RING, "n",
        F.array_max(gaps).alias("least"),
    )


def pivot_pairs(asked: DataFrame, index: PivotIndex, key: str, query_key: str, dims: int) -> DataFrame:
    """Each wanted (query, ring) with the ring's rows and their distances."""
    pairs = index.rows.join(asked.select(query_key, "q_z", *RING), RING)
    return pairs.select(query_key, key, round_half_up(euclidean(F.col("z"), F.col("q_z"), dims), 6).alias("distance"))


def exact_search(z_queries: DataFrame, index: PivotIndex, key: str, k: int, dims: int, query_key: str = "query_id") -> tuple[DataFrame, DataFrame]:
    """The k nearest rows of every query, and the (query, ring) that had to be searched for them, with `n` rows each.

    The rings of least bounds that hold some times k rows give a distance within which the k nearest are;
    rings farther than that are left out.
    """
    rings = settle(pivot_rings(z_queries, index, query_key), "query-rings")

    order = Window.partitionBy(query_key).orderBy("least", *RING).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0))
    first = rings.withColumn("_before", before).filter(F.col("_before") < FIRST_ROWS * k)
    seen = topk_similar(pivot_pairs(first, index, key, query_key, dims), query_key, key, k)
    within = settle(seen.groupBy(query_key).agg(F.max("distance").alias("within"), F.count(F.lit(1)).alias("found")), "within")
    wanted = rings.join(within, query_key).filter((F.col("found") < k) | (F.col("least") <= F.col("within") + SLACK))
    wanted = settle(wanted.select(query_key, "q_z", *RING, "n"), "wanted-rings")
    return topk_similar(pivot_pairs(wanted, index, key, query_key, dims), query_key, key, k), wanted


def exact_similar(
    queries: DataFrame, history: DataFrame, key: str, features: Sequence[str] = config.FEATURES,
    k: int = 5, query_key: str = "query_id",
) -> DataFrame:
    """The k nearest rows without hashing: the yardstick for the hashed search's recall.

    The queries are a handful of example rows. Distances to pivots rule out most of the history, see `exact_search`.
    """
    moments = feature_moments(history, features)
    z_history = standardize_features(history.select(key, *features), features, moments).select(key, "z")
    z_queries = standardize_features(queries.select(F.col(key).alias(query_key), *features), features, moments, "q_z")
    index = pivot_index(z_history, key)
    if not len(index.pivots):
        pairs = index.rows.select(F.col(key).alias(query_key), key, F.lit(0.0).alias("distance"))
        return topk_similar(pairs, query_key, key, k)
    return exact_search(z_queries.select(query_key, "q_z"), index, key, k, len(features), query_key)[0]


def progression_examples(df: DataFrame, key: str, target: str = config.TARGET, n: int = 1) -> DataFrame:
    """The rows to search for: progressing cases first, in key order."""
    return df.orderBy(F.col(target).desc(), key).limit(n)


def twin_explanation(
    twins: DataFrame, queries: DataFrame, history: DataFrame, key: str, query_key: str = "query_id",
    compared: Sequence[str] = ("creatinine", "urine_output_ml", "kdigo_stage"), target: str = config.TARGET,
) -> DataFrame:
    """A line of text per twin: compared values of both, and what became of the twin."""
    def shown(c: str) -> Column:
        return F.when(F.col(c).isNull(), "nan").otherwise(plain_number(F.col(c)))

    asked = queries.select(F.col(key).alias(query_key), *[shown(c).alias(f"q_{c}") for c in compared])
    found = history.select(key, *[shown(c).alias(f"t_{c}") for c in compared], target)
    summary = F.concat_ws(
        ", ",
        *[F.concat(F.lit(f"{c}: "), F.col(f"t_{c}"), F.lit(" (vs query "), F.col(f"q_{c}"), F.lit(")")) for c in compared],
    )
    outcome = F.when(F.col(target) == 1, "AKI Stage 3").otherwise("No Progress")
    return (
        twins.join(asked, query_key)
        .join(found, key)
        .select(query_key, F.col(key).alias("twin_id"), "rank", summary.alias("summary"), outcome.alias("outcome"))
    )
