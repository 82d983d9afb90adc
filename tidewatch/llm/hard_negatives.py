"""Hard negatives by exact inner product, searched in an R-tree packed by Sort-Tile-Recursive.

Rows are range-partitioned by label and the coordinate of most spread into slabs of bounded size;
inside a slab they are tiled by further coordinates, halving by halving, and stored in that order.
Runs of consecutive rows are leaves, runs of consecutive boxes the nodes above. A box bounds every
coordinate, so it bounds the inner product with an anchor from both sides. A search keeps a queue
of boxes, highest bound first, and leaves out boxes of unwanted labels, boxes outside every
wanted score window, and boxes that can't beat the k-th result so far.

Anchors meet slabs in blocks: a cell of one anchor block and one slab is searched by one task, and results
of an anchor's cells are merged by rank. Every row is indexed and every search is exact.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import prepare
from tidewatch.sources.layers import settle

#: Rows of a slab at most, and at least where there are few; slabs that a small table is still cut to.
SLAB_ROWS, LEAST_SLAB_ROWS, LEAST_SLABS = 65536, 1024, 32
#: Anchors of a block, rows of a leaf, children of a node.
ANCHORS, LEAF, FAN = 2048, 128, 16
#: Scaled components at or beyond this size can't be summed exactly in a long; their rows take no part.
TOO_LARGE = 1 << 26
#: Sums below this are exact in doubles.
EXACT = 1 << 53

TREE = "slab int, n int, ids binary, labels binary, places binary, vectors binary"
FOUND = "place long, of long, id long, found long, score long"


class Tree:
    """The boxes over rows that are stored in packed order."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, places: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.places, self.vectors = ids, labels, places, vectors
        self.levels = [self._boxes((vectors, vectors, ids, labels, labels), LEAF)]
        while len(self.levels[-1][0]) > FAN:
            self.levels.append(self._boxes(self.levels[-1], FAN))

    @staticmethod
    def _boxes(below: tuple, size: int) -> tuple:
        """Lowest and highest coordinates, smallest id, lowest and highest label of runs of `size`."""
        starts = np.arange(0, len(below[0]), size)
        low, high = np.minimum.reduceat, np.maximum.reduceat
        return tuple(fn(part, starts) for fn, part in zip((low, high, low, low, high), below, strict=True))

    def search(self, q: np.ndarray, label: int, place: int, same: bool, windows: list, k: int, seed: tuple | None = None) -> list[list]:
        """For each window (lowest, highest score) the first k rows as (-score, id, place).

        Wanted are rows of the same label but the one at `place`, or of other labels. `seed`, for a single window,
        is the k-th result of rows searched elsewhere: what comes behind it is not wanted.
        """
        found: list[list] = [[] for _ in windows]
        last = [seed] * len(windows)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        queue: list[tuple] = []

        def alive(lower, upper, first_id) -> bool:
            for (low, high), worst in zip(windows, last, strict=True):
                if upper >= low and lower <= high and (worst is None or (-min(upper, high), first_id) <= worst):
                    return True
            return False

        def push(level: int, start: int, stop: int) -> None:
            lows, highs, first_ids, low_label, high_label = (part[start:stop] for part in self.levels[level])
            upper, lower = highs @ up + lows @ down, lows @ up + highs @ down
            if same:
                wanted = (low_label <= label) & (high_label >= label)
            else:
                wanted = (low_label != label) | (high_label != label)
            for i in np.flatnonzero(wanted).tolist():
                entry = (lower[i], upper[i], first_ids[i])
                if alive(*entry):
                    heapq.heappush(queue, (-upper[i], first_ids[i], level, start + i, lower[i]))

        push(len(self.levels) - 1, 0, len(self.levels[-1][0]))
        while queue:
            upper, first_id, level, node, lower = heapq.heappop(queue)
            if not alive(lower, -upper, first_id):
                continue
            if level:
                push(level - 1, node * FAN, min((node + 1) * FAN, len(self.levels[level - 1][0])))
                continue
            rows = slice(node * LEAF, (node + 1) * LEAF)
            scores = self.vectors[rows] @ q
            least = min(low if worst is None else max(low, -worst[0]) for (low, _), worst in zip(windows, last, strict=True))
            of_label = self.labels[rows] == label
            wanted = (scores >= least) & (scores <= max(high for _, high in windows)) & (of_label if same else ~of_label)
            for i in np.flatnonzero(wanted).tolist():
                score, own = int(scores[i]), (int(self.ids[rows][i]), int(self.places[rows][i]))
                if own[1] == place:
                    continue
                for w, (low, high) in enumerate(windows):
                    if low <= score <= high and (last[w] is None or (-score, own[0]) <= last[w]):
                        insort(found[w], (-score, *own))
                        if len(found[w]) >= k:
                            del found[w][k:]
                            last[w] = found[w][-1][:2] if last[w] is None else min(last[w], found[w][-1][:2])
        return found


def tiled(order: np.ndarray, vectors: np.ndarray, coordinates: list[int]) -> Iterator[np.ndarray]:
    """Row numbers in tiles: sorted by one coordinate, cut, and each part tiled by the rest."""
    leaves = -(-len(order) // LEAF)
    if leaves <= 1 or not coordinates:
        yield order
        return
    order = order[np.argsort(vectors[order, coordinates[0]], kind="stable")]
    left = min(len(coordinates), max(1, math.ceil(math.log2(leaves))))
    size = LEAF * -(-leaves // math.ceil(leaves ** (1 / left)))
    for start in range(0, len(order), size):
        yield from tiled(order[start : start + size], vectors, coordinates[1:])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows; shorter ones end in zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int32)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy()
    return out


def _points(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(place, vec_id, label, v) of the rows that take part, written once; v has integers."""
    vector = F.col(vector_col).cast("array<double>")
    chosen = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), vector.alias("x"))
    fits = F.forall("x", lambda x: F.coalesce(F.abs(x * scale) < TOO_LARGE, F.lit(False)))
    chosen = chosen.filter("vec_id is not null and label is not null and x is not null").filter(fits)
    v = F.transform("x", lambda x: F.floor(x * scale).cast("int"))
    return settle(chosen.select(F.monotonically_increasing_id().alias("place"), "vec_id", "label", v.alias("v")), "points")


def _spread(points: DataFrame) -> tuple[int, int, int, list[int]]:
    """Number of rows, longest vector, largest size of a component, and coordinates by falling variance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).value_lengths()
            m = _matrix(batch.column(0), max(sizes.to_pylist(), default=0)).astype(np.float64)
            yield pa.RecordBatch.from_pydict(
                {
                    "c": pa.array(np.arange(m.shape[1])), "n": pa.array(np.full(m.shape[1], len(m))),
                    "s": pa.array(m.sum(axis=0)), "ss": pa.array((m * m).sum(axis=0)),
                    "most": pa.array(np.abs(m).max(axis=0, initial=0).astype(np.int64)),
                }
            )

    parts = points.select("v").mapInArrow(run, "c long, n long, s double, ss double, most long").groupBy("c")
    sums = parts.agg(F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.max("most").alias("most")).orderBy("c").collect()
    n = points.count()
    variance = [r["ss"] - r["s"] ** 2 / n for r in sums]
    return n, len(sums), max([r["most"] for r in sums], default=0), sorted(range(len(sums)), key=lambda c: -variance[c])


def build(points: DataFrame, n: int, width: int, by_spread: list[int]) -> DataFrame:
    """TREE: one row per slab, its rows in packed order; written once."""
    slabs = max(-(-n // SLAB_ROWS), min(LEAST_SLABS, -(-n // LEAST_SLAB_ROWS)), 1)
    first = F.get("v", F.lit(by_spread[0] if by_spread else 0))
    # The id and the place spread rows with equal vectors.
    dealt = points.withColumn("first", F.coalesce(first, F.lit(0))).repartitionByRange(slabs, "label", "first", "vec_id", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        vectors = np.concatenate([_matrix(b.column("v"), max(width, 1)) for b in held])
        labels, places = table.column("label").to_numpy(), table.column("place").to_numpy()
        order = np.lexsort((places, labels))
        cuts = np.flatnonzero(np.diff(labels[order])) + 1
        order = np.concatenate([tile for part in np.split(order, cuts) for tile in tiled(part, vectors, by_spread)])
        own = lambda values: values[order].astype("<i8").tobytes()
        yield pa.RecordBatch.from_pydict(
            {
                "slab": pa.array([TaskContext.get().partitionId()], pa.int32()), "n": pa.array([len(order)], pa.int32()),
                "ids": [own(table.column("vec_id").to_numpy())], "labels": [own(labels)], "places": [own(places)],
                "vectors": [vectors[order].astype("<i4").tobytes()],
            }
        )

    return settle(dealt.select("vec_id", "label", "place", "v").mapInArrow(run, TREE), "tree")


def _tree(row: dict, exact: type) -> Tree:
    longs = [np.frombuffer(row[name], "<i8") for name in ("ids", "labels", "places")]
    return Tree(*longs, np.frombuffer(row["vectors"], "<i4").reshape(row["n"], -1).astype(exact))


def _anchors(trees: DataFrame, every: int, k: int, exact: type) -> DataFrame:
    """(place, vec_id, label, q, seed_score, seed_id): the anchors, with their k-th positive inside their own slab."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = _tree(row, exact)
                out = []
                for i in np.flatnonzero(tree.ids % every == 0).tolist():
                    own = {"place": int(tree.places[i]), "vec_id": int(tree.ids[i]), "label": int(tree.labels[i])}
                    best = tree.search(tree.vectors[i], own["label"], own["place"], True, [(-math.inf, math.inf)], k)[0]
                    seed = best[-1] if len(best) == k else (None, None)
                    q = tree.vectors[i].astype("<i4").tobytes()
                    out.append(own | {"q": q, "seed_score": seed[0], "seed_id": seed[1]})
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([(c, pa.binary() if c == "q" else pa.int64()) for c in ("place", "vec_id", "label", "q", "seed_score", "seed_id")])
    return settle(trees.mapInArrow(run, "place long, vec_id long, label long, q binary, seed_score long, seed_id long"), "anchors")


def _search(trees: DataFrame, anchors: DataFrame, slabs: int, blocks: int, same: bool, k: int, exact: type) -> DataFrame:
    """FOUND: for each anchor (place) and window (of: its highest score, 0 for positives) k results of every slab."""
    grid = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = trees.withColumn("block", grid(blocks))
    right = anchors.withColumn("block", F.pmod("place", F.lit(blocks)).cast("int")).withColumn("slab", grid(slabs))

    def run(tree_rows: pa.Table, anchor_rows: pa.Table) -> pa.Table:
        out = []
        if tree_rows.num_rows and anchor_rows.num_rows:
            tree = _tree(tree_rows.to_pylist()[0], exact)
            for a in anchor_rows.to_pylist():
                q = np.frombuffer(a["q"], "<i4").astype(exact)
                if same:
                    seed = None if a["seed_id"] is None else (a["seed_score"], a["seed_id"])
                    tops = [0], tree.search(q, a["label"], a["place"], True, [(-math.inf, math.inf)], k, seed)
                else:
                    tops = a["highs"], tree.search(q, a["label"], a["place"], False, list(zip(a["lows"], a["highs"], strict=True)), k)
                out += [(a["place"], of, i, place, -score) for of, top in zip(*tops, strict=True) for score, i, place in top]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("place", "of", "id", "found", "score"), columns, strict=True)})

    return left.groupBy("block", "slab").cogroup(right.groupBy("block", "slab")).applyInArrow(run, FOUND)


def _first(rows: DataFrame, k: int, *key: str) -> DataFrame:
    """The first k results of every key over all slabs, with their rank."""
    ranked = Window.partitionBy(*key).orderBy(F.desc("score"), "id", "found")
    return rows.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def _hundredths(score: str, times: int, up: bool = False) -> Column:
    """`score` * `times` / 100, rounded down or up; in decimals, as the product may not fit a long."""
    product = F.col(score).cast("decimal(20,0)") * F.lit(-times if up else times).cast("decimal(10,0)")
    floor = ((product - F.pmod(product, F.lit(100).cast("decimal(10,0)"))) / F.lit(100).cast("decimal(10,0)")).cast("long")
    return -floor if up else floor


def mine(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of the components times `scale`, rounded down; higher come first, ties by smaller
    id. Anchors are the rows whose id is divisible by `every`; an anchor's positives are its first
    other rows of the same label. For each positive, the first rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score are returned.

    Rows with a null id, label or vector, or a component that is null, not finite or 2^26 or more when scaled take no
    part. Vectors of differing length are compared as if the shorter ones ended in zeros. Repeated
    rows, and rows that share an id, are rows of their own. An anchor without positives or negatives gives no
    rows, and so does an empty table. Other columns are ignored.
    """
    prepare(rows.sparkSession)
    points = _points(rows, id_col, label_col, vector_col, scale)
    n, width, most, by_spread = _spread(points)
    # Bounds and scores are sums of `width` products; beyond what doubles hold, whole numbers of Python take over.
    exact = np.float64 if 2 * max(width, 1) * most * most < EXACT else object
    trees = build(points, n, width, by_spread)
    slabs = (trees.agg(F.max("slab")).first()[0] or 0) + 1
    anchors = _anchors(trees, every, positives, exact)
    blocks = max(1, -(-anchors.count() // ANCHORS))
    found = _search(trees, anchors, slabs, blocks, True, positives, exact)
    pairs = settle(_first(found, positives, "place").select("place", "id", "found", "score"), "positives")
    # A window of negative scores is empty, as 80 % of a negative score is more than all of it.
    highest = _hundredths("score", high).alias("high")
    windows = pairs.select("place", _hundredths("score", low, up=True).alias("low"), highest).filter("low <= high")
    windows = windows.dropDuplicates().groupBy("place").agg(F.sort_array(F.collect_list(F.struct("high", "low"))).alias("w"))
    asking = anchors.select("place", "label", "q").join(windows, "place").select("place", "label", "q", "w.high", "w.low")
    asking = asking.withColumnsRenamed({"high": "highs", "low": "lows"})
    against = _first(_search(trees, asking, slabs, blocks, False, negatives, exact), negatives, "place", "of")
    against = against.select("place", F.col("of").alias("high"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = pairs.join(anchors.select("place", F.col("vec_id").alias("anchor_id")), "place")
    named = named.select("place", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), highest)
    return named.join(against, ["place", "high"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
