"""SimHash near-duplicates with pigeonring filtering.

A fingerprint is cut into segments on a ring. If two fingerprints differ in at most `budget` bits,
some chain of consecutive segments exists whose first l segments differ in at most
l * budget / segments bits, for every l. A segment whose share is below one difference must be
equal, one more difference is allowed a few segments on, and so forth; the segments that a chain
must have equal are a join key. Rows of a key are compared by the chain first and by all bits last.

The keys find every pair. Only distinct fingerprints are compared, and a key's rows give the links
of a spanning forest, not all pairs. A key with many rows is cut into blocks, and pairs of blocks are
compared in separate tasks; so is a join on a fingerprint or a group that many rows have.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import row_key, texts, unused
from tidewatch.llm.graph import components
from tidewatch.sources.layers import settle

SEED = 42
SEGMENTS, CHAIN = 8, 5
BYTES = 8

#: Rows of one key that are compared in one task.
BUCKET_ROWS = 4096
FEW = 8


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of all shingles in order, repeated ones too; those of a shorter text are one of all its words."""
    import xxhash

    listed = text.lower().split()
    if not listed:
        return np.zeros(0, np.uint64)
    joined = b" ".join(listed)
    lengths = np.fromiter(map(len, listed), np.int64, len(listed))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(listed) < shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(listed) - shingle + 1], ends[shingle - 1 :]
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return np.frombuffer(raw, ">u8").astype(np.uint64)


def fingerprint(text: bytes, shingle: int) -> bytes:
    """64 bits, most significant first; a bit is 1 if set in over half the shingle hashes, repeated ones each time."""
    hashes = shingles(text, shingle)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[start : start + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int32)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def _keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return texts(docs, id_col, text_col).select(
        "doc_id", row_key().alias("key"), F.col("text").cast("binary").alias("text")
    )


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, fp binary) of every row; `key` is the row key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(found, pa.binary())], names=["doc_id", "key", "fp"]
            )

    return _keyed_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, key long, fp binary")


def chain_subsets(segments: int, budget: int, length: int) -> list[tuple[int, ...]]:
    """Sets of segments of which at least one set is equal in any two fingerprints within the budget."""
    allowed = [(i + 1) * budget // segments for i in range(length)]
    found = set()
    for start in range(segments):
        for out in combinations(range(1, length), allowed[-1]):
            if all(sum(o <= i for o in out) <= allowed[i] for i in range(length)):
                found.add(tuple(sorted((start + i) % segments for i in range(length) if i not in out)))
    return sorted(found)


def chain_keys(budget: int) -> Callable[[np.ndarray], np.ndarray]:
    """Keys of 64-bit fingerprints (n, 8 bytes) that every pair within `budget` differing bits shares once or more."""
    subsets = chain_subsets(SEGMENTS, budget, CHAIN)

    def keys(fp: np.ndarray) -> np.ndarray:
        out = np.zeros((len(fp), len(subsets)), np.int64)
        for k, subset in enumerate(subsets):
            for segment in subset:
                out[:, k] = out[:, k] << 8 | fp[:, segment]
            out[:, k] |= k << 48
        return out

    return keys


def _near(one: np.ndarray, others: np.ndarray, budget: int) -> np.ndarray:
    """Which rows of `others` are within the budget: a viable chain first, all bits last."""
    differing = np.bitwise_count(one ^ others)
    segments = differing.shape[1]
    twice = np.concatenate([differing, differing[:, : CHAIN - 1]], 1).astype(np.int16)
    sums = twice[:, :segments].copy()
    viable = sums * segments <= budget
    for step in range(1, CHAIN):
        sums += twice[:, step : step + segments]
        viable &= sums * segments <= (step + 1) * budget
    found = viable.any(1)
    found[found] = differing[found].sum(1, dtype=np.int32) <= budget
    return found


Near = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _forest(fp: np.ndarray, near: Near) -> list[tuple[int, int]]:
    """Links of a spanning forest of one key's rows: whoever is reached leaves the rows to search."""
    left = np.arange(len(fp))
    links = []
    while len(left):
        reached = [left[0]]
        left = left[1:]
        while reached and len(left):
            at = reached.pop()
            found = near(fp[at], fp[left])
            hit = left[found]
            left = left[~found]
            links += [(at, h) for h in hit]
            reached += hit.tolist()
    return links


def _links_of(node: np.ndarray, key: np.ndarray, fp: np.ndarray, near: Near) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among rows sorted by key: few rows by comparing neighbours, more by a forest."""
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    sizes = np.repeat(np.diff(edges), np.diff(edges))
    small = sizes <= FEW
    for d in range(1, min(FEW, len(key))):
        i = np.flatnonzero((key[d:] == key[:-d]) & small[:-d])
        if len(i):
            i = i[near(fp[i], fp[i + d])]
            yield node[i], node[i + d]
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        if end - start > FEW:
            pairs = _forest(fp[start:end], near)
            if pairs:
                at = np.array(pairs) + start
                yield node[at[:, 0]], node[at[:, 1]]


def links(nodes: DataFrame, budget: int) -> DataFrame:
    """(a, b): links among (node long, fp binary of 64 bits) that join what is within the budget."""
    keys, near = chain_keys(budget), functools.partial(_near, budget=budget)
    wide = pa.binary(BYTES)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(batch.column("fp").to_pylist())
            fp = np.frombuffer(raw, np.uint8).reshape(-1, BYTES)
            found = keys(fp)
            n, k = found.shape
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.ravel()),
                    pa.array(np.repeat(batch.column("node").to_numpy(), k)),
                    pa.FixedSizeBinaryArray.from_buffers(wide, n * k, [None, pa.py_buffer(np.repeat(fp, k, 0).tobytes())])
                    .cast(pa.binary()),
                ],
                names=["key", "node", "fp"],
            )

    rows = nodes.select("node", "fp").mapInArrow(keyed, "key long, node long, fp binary")
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BUCKET_ROWS)
    counts = settle(counts.withColumn("cut", F.ceil(F.col("n") / BUCKET_ROWS).cast("int")).drop("n"), "hot-keys")
    own = F.pmod(F.xxhash64("node"), F.col("cut")).cast("int")
    rows = (
        rows.join(counts, "key", "left")
        .withColumn("own", F.coalesce(own, F.lit(0)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("cut"), F.lit(1)) - 1)))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "fp")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            group = pc_group(table)
            fp = np.frombuffer(b"".join(table.column("fp").to_pylist()), np.uint8).reshape(-1, BYTES)
            for a, b in _links_of(table.column("node").to_numpy(), group, fp, near):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 4 * BUCKET_ROWS:
                continue
            # The last key may go on in the next batch.
            group = pc_group(held)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield from out(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from out(held)

    def pc_group(table: pa.Table) -> np.ndarray:
        """A number for each run of equal (key, i, j)."""
        key, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
        new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        return np.concatenate([[0], np.cumsum(new)])

    return (
        rows.repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "node")
        .mapInArrow(compare, "a long, b long")
        .dropDuplicates()
    )


def _join_counted(big: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Join on a key of which `small` has one row and, as `n`, how many rows of `big` have it.

    A key of more than BUCKET_ROWS rows is spread over as many tasks as it has that number of rows.
    """
    cut = F.ceil(F.col("n") / BUCKET_ROWS).cast("int")
    hot = settle(small.filter(F.col("n") > BUCKET_ROWS).select(on, cut.alias("cut")), "hot-keys")
    part = F.pmod(F.xxhash64(*big.columns), F.col("cut")).cast("int")
    parts = F.explode(F.sequence(F.lit(0), cut - 1))
    spread = big.join(hot, on, "left").withColumn("part", F.coalesce(part, F.lit(0))).drop("cut")
    return spread.join(small.withColumn("part", parts).drop("n"), [on, "part"]).drop("part")


def _grouped(docs: DataFrame, shingle: int, budget: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and for each distinct one (fp, n rows, group, first row of the group)."""
    if not 0 <= budget < SEGMENTS:
        raise ValueError(f"chains find up to {SEGMENTS - 1} differing bits, not {budget}")
    rows = settle(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    own = [F.min(F.struct("doc_id", "key")).alias("first"), F.count(F.lit(1)).alias("n")]
    nodes = settle(rows.groupBy("fp").agg(*own).withColumn("node", F.xxhash64("fp")), "fingerprint-nodes")
    roots = settle(components(links(nodes, budget)).join(nodes.select("node", "first"), "node"), "fingerprint-roots")
    of_root = roots.groupBy("root").agg(F.min("first").alias("component"), F.count(F.lit(1)).alias("n"))
    of_node = _join_counted(roots.select("node", "root"), settle(of_root, "fingerprint-components"), "root")
    grouped = nodes.join(of_node, "node", "left").select(
        "fp", "n", F.coalesce("root", "node").alias("group"), F.coalesce("component", "first").alias("component")
    )
    return rows, settle(grouped, "fingerprint-groups")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, budget: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, key, fp (binary), group, component_id of every row: the smallest doc_id reachable over links.

    Fingerprints of 64 bits link at `budget` differing bits or fewer, without a miss. Texts without
    words share the fingerprint zero and link like any other. A null id comes before every other as
    a smallest id, and is then null; repeated rows are linked; other columns are ignored; an empty
    table gives no rows.
    """
    rows, grouped = _grouped(docs, shingle, budget, id_col, text_col)
    return _join_counted(rows, grouped, "fp").select(
        "doc_id", "key", "fp", "group", F.col("component.doc_id").alias("component_id")
    )


def deduplicate(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """One row of each near-duplicate group: that of the smallest id, all columns unchanged, whatever their names.

    A null text counts as empty and is near every other without words; of repeated rows one stays; an empty
    table stays empty.
    """
    from tidewatch.llm.decontam import row_key_of

    _, grouped = _grouped(docs, shingle, budget, "doc_id", "text")
    own, kept_key = unused("_own_key", docs.columns), unused("_kept_key", docs.columns)
    kept = settle(grouped.select(F.col("component.key").alias(kept_key)).distinct(), "kept-documents")
    keyed = docs.withColumn(own, row_key_of(docs))
    return keyed.join(kept, F.col(own) == F.col(kept_key), "left_semi").dropDuplicates([own]).drop(own)
