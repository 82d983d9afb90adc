"""Byte-level BPE encoding by a global shuffle of distinct words, and decoding by the token bytes.

1. Each task cuts its rows into blocks of bounded size. A block lists its distinct pre-tokens and
   holds, for every position of its texts, the number of the pre-token found there.
2. The distinct pre-tokens of all blocks are dealt out by hash, sorted lists of a block packed
   together, and each distinct pre-token of the whole input is merged once where it arrives.
3. Ids go back to the blocks that asked for them, which put their texts together by position.

A pre-token appears once per block, so the most frequent one costs a few bytes per block, and no
text crosses the network, only numbers of pre-tokens.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import blocks, texts
from tidewatch.llm.pretokens import PATTERN, chunks

#: A route is a block's number, or below 0 a part of the distinct words.
CODED = (
    "route long, block long, words binary, sizes binary, doc_ids array<long>, lengths array<int>, codes binary, "
    "places binary"
)
ANSWER = "route long, part long, sizes binary, ids binary"
_CODED = pa.schema(
    [("route", pa.int64()), ("block", pa.int64()), ("words", pa.binary()), ("sizes", pa.binary()),
     ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("codes", pa.binary()),
     ("places", pa.binary())]
)
_ANSWER = pa.schema([("route", pa.int64()), ("part", pa.int64()), ("sizes", pa.binary()), ("ids", pa.binary())])
ZSTD_LEVEL = 1
#: Text bytes of a block: larger blocks repeat fewer words, and each must fit in a worker.
BLOCK_TEXT = 4 << 20
#: Distinct words of one part, and text bytes for each word of a block.
PART_WORDS, WORD_BYTES = 250_000, 50


def read_ranks(vocabulary: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(vocabulary, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def encoding_of(vocabulary: str):
    """The library's encoder over a rank file; a worker keeps it over groups and tasks."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=read_ranks(vocabulary), special_tokens={})


def squeeze(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress(data)


def unsqueeze(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def pack(numbers: np.ndarray) -> bytes:
    """Small numbers as compressed planes of bytes."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return squeeze(planes.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(unsqueeze(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def _code_block(table: pa.Table, block: int, bits: int) -> list[dict]:
    """The block's positions, and its distinct pre-tokens by part."""
    import regex
    import xxhash

    split = regex.compile(PATTERN).findall
    numbers: dict[str, int] = {}
    known: dict[str, tuple[int, ...]] = {}

    def coded(chunk: str) -> tuple[int, ...]:
        return tuple([numbers.setdefault(piece, len(numbers)) for piece in split(chunk)])

    parts = []
    for text in table.column("text").to_pylist():
        first, rest = chunks(text)
        for chunk in set(rest).difference(known):
            known[chunk] = coded(" " + chunk)
        parts.append(np.fromiter(chain(coded(first), chain.from_iterable(map(known.__getitem__, rest))), np.uint32))
    codes = np.concatenate(parts)
    # Frequent pre-tokens get small numbers, which pack well.
    by_count = np.argsort(-np.bincount(codes, minlength=len(numbers)), kind="stable")
    renumbered = np.empty(len(numbers), np.int64)
    renumbered[by_count] = np.arange(len(numbers))
    words = [w.encode() for w in numbers]
    hashes = np.frombuffer(b"".join([xxhash.xxh3_64_digest(w) for w in words]), ">u8").astype(np.uint64)
    part = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(words), np.int64)
    order = sorted(range(len(words)), key=words.__getitem__)
    order = np.array(order, np.int64)[np.argsort(part[order], kind="stable")] if words else np.zeros(0, np.int64)
    places = np.empty(len(words), np.int64)
    places[renumbered[order]] = np.arange(len(words))
    rows = [
        {
            "route": block, "block": block, "doc_ids": table.column("doc_id").to_pylist(),
            "lengths": [len(p) for p in parts], "codes": pack(renumbered[codes] if words else codes),
            "places": pack(places),
        }
    ]
    edges = np.searchsorted(part[order], np.arange((1 << bits) + 1))
    for p, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        if b > a:
            own = [words[i] for i in order[a:b].tolist()]
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            rows.append({"route": -p - 1, "block": block, "words": squeeze(b"".join(own)), "sizes": pack(sizes)})
    return rows


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>): the ranks of every whole text, one row out per row in.

    Each match of the public pattern is merged separately; no special tokens. Null and empty texts
    have no ids; a null id stays null; repeated rows come out each; other columns are ignored; an
    empty table gives no rows. `docs` should be a stored table: a task that runs again, for a lost
    executor, must find the same rows in the same order.
    """
    rows = texts(docs, id_col, text_col)
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, n_bytes / WORD_BYTES / PART_WORDS))))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 24
        for seq, table in enumerate(blocks(batches, "text", BLOCK_TEXT)):
            yield pa.RecordBatch.from_pylist(_code_block(table, task + seq, bits), _CODED)

    def merge(table: pa.Table) -> pa.Table:
        if table.column("route")[0].as_py() >= 0:
            return pa.Table.from_pylist([], _ANSWER)
        single = encoding_of(vocabulary)._core_bpe.encode_single_piece
        known: dict[bytes, list[int]] = {}
        out = []
        for row in table.select(["route", "block", "words", "sizes"]).to_pylist():
            joined = unsqueeze(row["words"])
            ends = np.cumsum(unpack(row["sizes"]).astype(np.int64)).tolist()
            words = [joined[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            for word in set(words).difference(known):
                known[word] = single(word)
            ids = list(map(known.__getitem__, words))
            out.append(
                {
                    "route": row["block"], "part": -row["route"], "sizes": pack(np.fromiter(map(len, ids), np.int64)),
                    "ids": pack(np.fromiter(chain.from_iterable(ids), np.int64)),
                }
            )
        return pa.Table.from_pylist(out, _ANSWER)

    def reassemble(table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, lengths, doc_ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        if table.num_rows and table.column("route")[0].as_py() >= 0:
            told = sorted(answers.to_pylist(), key=lambda r: r["part"])
            none = [np.zeros(0, np.int64)]
            sizes = np.concatenate(none + [unpack(r["sizes"]).astype(np.int64) for r in told])
            flat = np.concatenate(none + [unpack(r["ids"]).astype(np.int64) for r in told])
            starts = np.cumsum(sizes) - sizes
            for row in table.select(["doc_ids", "lengths", "codes", "places"]).to_pylist():
                places = unpack(row["places"])
                at = places[unpack(row["codes"])].astype(np.int64)
                n = sizes[at]
                ends = np.cumsum(n)
                total = int(ends[-1]) if len(ends) else 0
                ids.append(flat[np.arange(total) + np.repeat(starts[at] - (ends - n), n)])
                ends = np.concatenate([[0], ends])
                lengths.append(np.diff(ends[np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)]))
                doc_ids += row["doc_ids"]
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        values = pa.array(np.concatenate(ids), pa.int32())
        return pa.table(
            {
                "doc_id": pa.array(doc_ids, pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
            }
        )

    coded = rows.mapInArrow(code, CODED)
    merged = coded.groupBy("route").applyInArrow(merge, ANSWER)
    return (
        coded.groupBy("route").cogroup(merged.groupBy("route")).applyInArrow(reassemble, "doc_id long, ids array<int>")
    )


def id_lists(ids: pa.Array) -> Iterator[list[int]]:
    """The rows of a list column as Python lists; a null row is an empty one."""
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    values = ids.flatten().to_numpy()
    ends = np.cumsum(lengths).tolist()
    for start, end in zip([0, *ends[:-1]], ends, strict=False):
        yield values[start:end].tolist()


def decoder(vocabulary: str) -> Callable[[list[int]], bytes]:
    """Joins the bytes of ids, by a table with one entry per token."""
    ranks = read_ranks(vocabulary)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return lambda ids: b"".join(map(table.__getitem__, ids))


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """The input with a column `decoded` (binary): the bytes of the ids joined, by the token table.

    An input column of that name is replaced. Null ids decode to no bytes; repeated rows come out each. The table is read from the vocabulary and bounded by its size.
    """
    columns = [c for c in encoded.columns if c != "decoded"]
    schema = encoded.select(*columns).schema.add("decoded", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = decoder(vocabulary)
        for batch in batches:
            out = [joined(row) for row in id_lists(batch.column(ids_col))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"]
            )

    return encoded.select(*columns).mapInArrow(run, schema)


def round_trip_digests(encoded: DataFrame, vocabulary: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256, and `ids` if wanted.

    Decodes the ids as `decode` does and hashes the bytes where they are, so texts stay in the worker.
    """
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        joined = decoder(vocabulary)
        for batch in batches:
            ids = batch.column("ids")
            listed, plain = [], []
            for row in id_lists(ids):
                listed.append(sha256(",".join(map(str, row)).encode()).hexdigest())
                plain.append(sha256(joined(row)).hexdigest())
            columns = {
                "doc_id": batch.column("doc_id"), "n_tokens": pc.list_value_length(ids).cast(pa.int64()),
                "ids_sha256": pa.array(listed, pa.string()), "decoded_sha256": pa.array(plain, pa.string()),
            } | ({"ids": ids} if keep_ids else {})
            yield pa.RecordBatch.from_pydict(columns)

    return encoded.select("doc_id", "ids").mapInArrow(run, fields)
