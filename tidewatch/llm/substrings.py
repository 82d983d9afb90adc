"""Substring dedup by level-wise doubling of repeated word windows.

Texts are dealt into blocks by a hash of the document. A window of the wanted length holds
length / 2 + 1 windows of half that length; the one with the smallest hash stands for it. Level 1
asks which of these half-length windows occur more than once anywhere, level 2 extends only the
repeated ones to the full length and asks where each full window occurs first. Blocks send each
distinct window once and get one bit back for it, so that a passage repeated in many documents
costs a few bytes per block, and no window carries its place across the network.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import row_key, texts

LENGTH = 20
#: Text bytes of a block, and windows that one task of a level compares.
BLOCK_TEXT = 4 << 20
LEVEL_ROWS = 2_000_000

ASKED = "part int, block int, hashes binary, tails binary, at binary, doc_ids binary, keys binary"
ANSWER = "block int, part int, level int, bits binary"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_C, _D = np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)


def _join(left: np.ndarray, right: np.ndarray, a: np.uint64 = _A, b: np.uint64 = _B) -> np.ndarray:
    """Hash of two neighbouring windows."""
    n = min(len(left), len(right))
    with np.errstate(over="ignore"):
        z = left[:n] * a + right[:n] * b
        z = (z ^ (z >> np.uint64(32))) * _C
    return z ^ (z >> np.uint64(29))


def _windows(words: np.ndarray, length: int, a: np.uint64 = _A, b: np.uint64 = _B) -> np.ndarray:
    """Hashes of all windows of `length` words, by doubling."""
    power, width, out, done = words, 1, None, 0
    while True:
        if length & width:
            out = power if out is None else _join(out, power[done:], a, b)
            done += width
        if done == length:
            return out
        power = _join(power, power[width:], a, b)
        width *= 2


@dataclass
class Block:
    """The documents of a block in order of id, and their windows, numbered through the block."""

    doc_ids: np.ndarray
    keys: np.ndarray
    null_ids: np.ndarray
    words: list[list[bytes]]
    first: np.ndarray
    hashes: np.ndarray
    tails: np.ndarray
    halves: np.ndarray
    starts: np.ndarray
    stand_in: np.ndarray
    length: int

    @property
    def level_one(self) -> np.ndarray:
        """Distinct stand-in hashes, sorted."""
        return np.unique(self.halves[self.stand_in])

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Numbers of full windows whose stand-in is repeated, here or elsewhere."""
        found, inverse, counts = np.unique(self.halves[self.stand_in], return_inverse=True, return_counts=True)
        # The same place stands for neighbouring windows: it is repeated if two places have its hash.
        places = np.unique(self.stand_in)
        at_places = np.bincount(np.searchsorted(found, self.halves[places]), minlength=len(found))
        return self.starts[((at_places > 1) | repeated)[inverse]] if len(found) else self.starts[:0]

    def distinct(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the full windows `at`: the first of each kind, sorted by hash, and each one's kind."""
        order = np.lexsort((at, self.tails[at], self.hashes[at]))
        ordered = at[order]
        h, t = self.hashes[ordered], self.tails[ordered]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])]) if len(at) else np.zeros(0, bool)
        kind = np.empty(len(at), np.int64)
        kind[order] = np.cumsum(new) - 1
        return ordered[new], kind


def _block(table: pa.Table, length: int) -> Block:
    import xxhash

    doc_ids = table.column("doc_id").to_numpy() if not table.column("doc_id").null_count else None
    nulls = table.column("doc_id").is_null().to_numpy()
    if doc_ids is None:
        doc_ids = table.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
    keys = table.column("key").to_numpy()
    # Rows that repeat id and text are one document.
    order = np.lexsort((keys, doc_ids, ~nulls))
    kept = order[np.concatenate([[True], keys[order][1:] != keys[order][:-1]])] if len(order) else order
    column = table.column("text")
    words = [column[int(i)].as_py().split() for i in kept]
    digest = xxhash.xxh3_64_digest
    flat = np.frombuffer(b"".join([digest(w) for listed in words for w in listed]), ">u8").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(sizes) - sizes
    half = length // 2
    empty = np.zeros(0, np.int64)
    if len(flat) < length:
        h = t = halves = np.zeros(0, np.uint64)
        starts = stand_in = empty
    else:
        halves = _windows(flat, half)
        h = _join(halves, halves[half:]) if 2 * half == length else _windows(flat, length)
        t = _windows(flat, length, _C, _D).astype(np.uint32)
        left = np.repeat(first + sizes, sizes)[: len(h)] - np.arange(len(h))
        starts = np.flatnonzero(left >= length)
        smallest = np.lib.stride_tricks.sliding_window_view(halves, length - half + 1)
        stand_in = np.empty(len(starts), np.int64)
        for i in range(0, len(starts), 1 << 18):
            part = starts[i : i + (1 << 18)]
            stand_in[i : i + len(part)] = part + smallest[part].argmin(1)
    return Block(doc_ids[kept], keys[kept], nulls[kept], words, first, h, t, halves, starts, stand_in, length)


def _parts(sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each part's hashes begin; parts are the top bits."""
    if not bits:
        return np.array([0, len(sorted_hashes)])
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]])


def _answers(table: pa.Table, level: int) -> dict[int, np.ndarray]:
    """Bits of a block by part number."""
    found = {}
    for part, own, bits in zip(
        table.column("part").to_pylist(), table.column("level").to_pylist(), table.column("bits").to_pylist(), strict=True
    ):
        if own == level:
            found[part] = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    return found


def _collected(answers: dict[int, np.ndarray], edges: np.ndarray) -> np.ndarray:
    """The answers for all of a block's sorted hashes."""
    out = [answers[p][: b - a] for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
    return np.concatenate(out) if out else np.zeros(0, bool)


def dedup_substrings(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, key, n_words, removed array<struct<first, last>>, kept (binary) of every document.

    A word is removed if a window of `length` words that covers it also starts earlier, in a
    smaller doc_id or further up in the same text; `kept` has the other words joined by one space.
    Words are runs of anything but ASCII white space. Null and empty texts have no words; a null
    id comes before all others; rows that repeat id and text are one document and come out once;
    different texts of one id are ordered by a hash; other columns are ignored; an empty table
    gives no rows.
    """
    rows = texts(docs, id_col, text_col).select(
        "doc_id", row_key().alias("key"), F.col("text").cast("binary").alias("text")
    )
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(n_bytes / BLOCK_TEXT))
    # A sixth of the windows stand in for others; windows are about as many as six bytes of text.
    bits = max(0, math.ceil(math.log2(max(1, n_bytes / 12 / LEVEL_ROWS))))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int"))
    schema = pa.schema(
        [("part", pa.int32()), ("block", pa.int32())]
        + [(c, pa.binary()) for c in ("hashes", "tails", "at", "doc_ids", "keys")]
    )

    def ask_halves(table: pa.Table) -> pa.Table:
        block = _block(table, length)
        hashes = block.level_one
        edges = _parts(hashes, bits)
        number = table.column("block")[0].as_py()
        listed = [
            {"part": p, "block": number, "hashes": hashes[a:b].tobytes()}
            for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            if b > a
        ]
        return pa.Table.from_pylist(listed, schema)

    def answer(rows_: list[dict], flags: np.ndarray, sizes: list[int], level: int) -> pa.Table:
        ends = np.cumsum(sizes)
        listed = [
            {"block": r["block"], "part": r["part"], "level": level, "bits": np.packbits(flags[e - n : e]).tobytes()}
            for r, e, n in zip(rows_, ends, sizes, strict=True)
        ]
        return pa.Table.from_pylist(
            listed,
            pa.schema([("block", pa.int32()), ("part", pa.int32()), ("level", pa.int32()), ("bits", pa.binary())]),
        )

    def repeated(table: pa.Table) -> pa.Table:
        rows_ = table.select(["part", "block", "hashes"]).to_pylist()
        parts = [np.frombuffer(r["hashes"], np.uint64) for r in rows_]
        _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        return answer(rows_, counts[inverse] > 1, [len(p) for p in parts], 1)

    def known(block: Block, answers: pa.Table) -> np.ndarray:
        return block.candidates(_collected(_answers(answers, 1), _parts(block.level_one, bits)))

    def ask_full(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_pylist([], schema)
        block = _block(table, length)
        at, _ = block.distinct(known(block, answers))
        doc = np.searchsorted(block.first, at, "right") - 1
        hashes, tails = block.hashes[at], block.tails[at]
        edges = _parts(hashes, bits)
        number = table.column("block")[0].as_py()
        listed = []
        for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if b > a:
                used, inverse = np.unique(doc[a:b], return_inverse=True)
                listed.append(
                    {
                        "part": p, "block": number, "hashes": hashes[a:b].tobytes(), "tails": tails[a:b].tobytes(),
                        "at": inverse.astype(np.int32).tobytes(), "doc_ids": block.doc_ids[used].tobytes(),
                        "keys": block.keys[used].tobytes(),
                    }
                )
        return pa.Table.from_pylist(listed, schema)

    def earliest(table: pa.Table) -> pa.Table:
        rows_ = table.to_pylist()
        hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows_]
        tails = np.concatenate([np.frombuffer(r["tails"], np.uint32) for r in rows_])
        at = [np.frombuffer(r["at"], np.int32) for r in rows_]
        ids = np.concatenate([np.frombuffer(r["doc_ids"], np.int64)[a] for r, a in zip(rows_, at, strict=True)])
        keys = np.concatenate([np.frombuffer(r["keys"], np.int64)[a] for r, a in zip(rows_, at, strict=True)])
        h = np.concatenate(hashes)
        order = np.lexsort((keys, ids, tails, h))
        new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (tails[order][1:] != tails[order][:-1])])
        flags = np.zeros(len(h), bool)
        flags[order[new]] = True
        return answer(rows_, flags, [len(x) for x in hashes], 2)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"doc_id": [], "key": [], "n_words": [], "removed": [], "kept": []}
        if table.num_rows:
            block = _block(table, length)
            at = known(block, answers)
            firsts, kind = block.distinct(at)
            here = _collected(_answers(answers, 2), _parts(block.hashes[firsts], bits))
            stays = here[kind] & (firsts[kind] == at) if len(at) else np.zeros(0, bool)
            gone = at[~stays]
            total = sum(map(len, block.words))
            edge = np.bincount(gone, minlength=total + 1)[: total + 1] - np.bincount(
                gone + length, minlength=total + 1
            )[: total + 1]
            removed = np.cumsum(edge[:total]) > 0
            for i, words in enumerate(block.words):
                own = removed[block.first[i] : block.first[i] + len(words)]
                step = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                out["doc_id"].append(None if block.null_ids[i] else int(block.doc_ids[i]))
                out["key"].append(int(block.keys[i]))
                out["n_words"].append(len(words))
                out["removed"].append(
                    [{"first": int(a), "last": int(b) - 1} for a, b in zip(step[::2], step[1::2], strict=True)]
                )
                keep = words if not len(step) else [words[j] for j in np.flatnonzero(~own)]
                out["kept"].append(b" ".join(keep))
        span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
        return pa.table(
            {
                "doc_id": pa.array(out["doc_id"], pa.int64()), "key": pa.array(out["key"], pa.int64()),
                "n_words": pa.array(out["n_words"], pa.int64()), "removed": pa.array(out["removed"], pa.list_(span)),
                "kept": pa.array(out["kept"], pa.binary()),
            }
        )

    asked_one = dealt.groupBy("block").applyInArrow(ask_halves, ASKED)
    answer_one = asked_one.groupBy("part").applyInArrow(repeated, ANSWER)
    asked_two = dealt.groupBy("block").cogroup(answer_one.groupBy("block")).applyInArrow(ask_full, ASKED)
    answer_two = asked_two.groupBy("part").applyInArrow(earliest, ANSWER)
    answers = answer_one.unionByName(answer_two)
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            finish, "doc_id long, key long, n_words long, removed array<struct<first:int,last:int>>, kept binary"
        )
    )


def digest(deduplicated: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    removed = F.aggregate(
        "removed", F.lit(0).cast("long"), lambda total, s: total + s["last"].cast("long") - s["first"].cast("long") + 1
    )
    return deduplicated.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
