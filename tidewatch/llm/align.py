"""Alignment of two tokenizers' tokens over the same bytes, as an Arrow pipeline.

A block of texts becomes flat columns: lists of ids are flattened, parent indices name the document
of each token, cumulative sums of byte lengths give token ends, and a hash join of both sides' ends
(a document's base plus the end within it) finds common cuts and, filled backwards, the
overlapping pairs. `Table.group_by` counts pairs per document and per segment of blocks; Spark
merges the segments' counts and sends every segment the counts of its own pairs back.

A segment holds each pair once, so what a pair costs in a shuffle follows the segments, not the rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.bpe import pack, unpack
from tidewatch.llm.common import blocks, texts
from tidewatch.llm.token_count import byte_letters
from tidewatch.sources.layers import settle

#: Text bytes of a block, and distinct pairs after which a segment of blocks ends.
BLOCK_TEXT = 4 << 20
SEGMENT_PAIRS = 600_000
#: Words handed to the libraries at once.
WORDS_AT_ONCE = 8192

#: Texts whose words can't be encoded one by one: a space beside white space, or at either end.
#: Elsewhere neither side has a token that holds a space after another character.
UNCUT = re.compile(r"\A |  |\s \s| \Z")

#: Rows of a segment are its blocks (doc_ids is set) or its pairs.
CODED = (
    "segment long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "shas array<string>, n_pairs array<long>, gaps binary, times binary, pairs binary, docs binary"
)
_LONGS = pa.list_(pa.int64())
_CODED = pa.schema(
    [("segment", pa.int64()), ("doc_ids", _LONGS), ("n_a", _LONGS), ("n_b", _LONGS), ("n_groups", _LONGS),
     ("n_links", _LONGS), ("shas", pa.list_(pa.string())), ("n_pairs", _LONGS), ("gaps", pa.binary()),
     ("times", pa.binary()), ("pairs", pa.binary()), ("docs", pa.binary())]
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Side:
    """One tokenizer: ids of words, and the bytes and decimal texts of its ids."""

    def __init__(self, token_bytes: list[bytes], ends: str):
        self.bytes = pa.array(token_bytes, pa.large_binary())
        self.lengths = pc.binary_length(self.bytes)
        #: Entry 2 * id is the id with a comma behind, 2 * id + 1 the id at the end of its side of a group.
        self.said = pa.array([f"{i}{end}" for i in range(len(token_bytes)) for end in (",", ends)], pa.large_string())

    def encode(self, words: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def lists(self, words: list[str]) -> pa.ListArray:
        sizes, ids = [], []
        for i in range(0, len(words), WORDS_AT_ONCE):
            found = self.encode(words[i : i + WORDS_AT_ONCE])
            sizes += map(len, found)
            ids += [pa.array([x for one in found for x in one], pa.int32())]
        offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(ids or [pa.array([], pa.int32())]))


class ByteSide(Side):
    """A byte-level vocabulary of the tokenizers library, given a space in front; special strings are plain text."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        of_letter = {c: b for b, c in byte_letters().items()}
        table = [b""] * self.tokenizer.get_vocab_size()
        for entry, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            if all(c in of_letter for c in entry):
                table[i] = bytes(map(of_letter.__getitem__, entry))
        super().__init__(table, "|")

    def encode(self, words):
        found = self.tokenizer.encode_batch_fast([" " + w for w in words], add_special_tokens=False)
        return [e.ids for e in found]


class PieceSide(Side):
    """A sentencepiece model, which puts the space in front itself."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model)
        table = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            plain = b"" if self.model.is_control(i) or self.model.is_unknown(i) else piece.replace("▁", " ").encode()
            table.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else plain)
            if re.search(" .* |[^ ] ", plain.decode()) and plain.strip(b" "):
                raise ValueError("pieces that hold a space after another character don't end at words")
        super().__init__(table, ";")

    def encode(self, words):
        return self.model.encode(words, num_threads=1)


@lru_cache(maxsize=2)
def sides_of(byte_vocabulary: str, piece_model: str) -> tuple[Side, Side]:
    return ByteSide(byte_vocabulary), PieceSide(piece_model)


class Tokens:
    """All tokens of one side in a block, in order: ids, parent documents, ends in the joined bytes."""

    def __init__(self, side: Side, words: pa.Array, word_of: pa.Array, doc_of: pa.Array):
        lists = side.lists(words.to_pylist()).take(word_of)
        self.side, self.ids = side, pc.list_flatten(lists)
        self.doc = doc_of.take(pc.list_parent_indices(lists))
        self.ends = pc.cumulative_sum(side.lengths.take(self.ids))

    def joined(self) -> pa.Buffer:
        return _bytes_of(self.side.bytes.take(self.ids))

    def keep(self, wanted: np.ndarray) -> None:
        mask = pa.array(wanted[self.doc.to_numpy()])
        self.ids, self.doc = self.ids.filter(mask), self.doc.filter(mask)
        self.ends = pc.cumulative_sum(self.side.lengths.take(self.ids))

    def table(self, name: str) -> pa.Table:
        return pa.table({"end": self.ends, name: pa.array(np.arange(len(self.ids), dtype=np.int32))})


def _bytes_of(column: pa.Array) -> memoryview:
    """The bytes of a binary column's rows, joined."""
    _, offsets, data = column.buffers()
    if data is None or not len(column):
        return memoryview(b"")
    at = np.frombuffer(offsets, np.int64)
    return memoryview(data)[at[column.offset] : at[column.offset + len(column)]]


def _words(column: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Distinct words, and for each word of the block its number there and its row."""
    whole = np.array([bool(UNCUT.search(t)) for t in column.to_pylist()], bool)
    cut, uncut = np.flatnonzero(~whole), np.flatnonzero(whole)
    lists = pc.split_pattern(column.take(pa.array(cut)), " ")
    flat = pa.concat_arrays([pc.list_flatten(lists), column.take(pa.array(uncut))])
    rows = np.concatenate([cut[pc.list_parent_indices(lists).to_numpy()], uncut])
    order = pa.array(np.argsort(rows, kind="stable"))
    coded = flat.take(order).dictionary_encode()
    return coded.dictionary, coded.indices, pa.array(rows).take(order)


def _differing(tokens: Tokens, expected: pa.Array) -> np.ndarray:
    """Rows whose tokens' bytes, joined, are not the expected ones."""
    joined, want = tokens.joined(), _bytes_of(expected)
    bad = np.zeros(len(expected), bool)
    if joined == want:
        return bad
    sizes = np.bincount(tokens.doc.to_numpy(), tokens.side.lengths.take(tokens.ids).to_numpy(), minlength=len(expected))
    ends = np.cumsum(sizes.astype(np.int64))
    for row, text in enumerate(expected):
        bad[row] = text.as_buffer() != joined[ends[row] - int(sizes[row]) : ends[row]]
    return bad


class Alignment:
    """What a block of texts gives: sums and digests per row, and the links of all rows."""

    def __init__(self, column: pa.Array, first: Side, second: Side):
        column = column.cast(pa.large_string())
        n = len(column)
        words, word_of, row_of = _words(column)
        sides = [Tokens(side, words, word_of, row_of) for side in (first, second)]
        expected = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string()))
        expected = expected.cast(pa.large_binary())
        empty = pc.equal(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        good = ~(empty | _differing(sides[0], expected) | _differing(sides[1], expected))
        if not good.all():
            for tokens in sides:
                tokens.keep(good)
        a, b = sides
        joined = a.table("a").join(b.table("b"), "end", join_type="full outer", use_threads=False).sort_by("end")
        at_a, at_b = joined.column("a").combine_chunks(), joined.column("b").combine_chunks()
        cut = pc.and_(at_a.is_valid(), at_b.is_valid())
        link_a, link_b = pc.fill_null_backward(at_a), pc.fill_null_backward(at_b)
        doc = a.doc.take(link_a)
        pair = pc.bit_wise_or(pc.shift_left(a.ids.take(link_a).cast(pa.int64()), pa.scalar(32, pa.int64())), b.ids.take(link_b).cast(pa.int64()))
        self.links = pa.table({"doc": doc.cast(pa.int64()), "pair": pair})
        count = lambda rows: np.bincount(rows.to_numpy(), minlength=n).astype(np.int64)
        self.n_a, self.n_b, self.n_links = count(a.doc), count(b.doc), count(doc)
        self.n_groups = count(doc.filter(cut))
        self.shas = self._digests(a, b, at_a.filter(cut).to_numpy(), at_b.filter(cut).to_numpy())

    def _digests(self, a: Tokens, b: Tokens, cut_a: np.ndarray, cut_b: np.ndarray) -> list[str]:
        """SHA-256 of each row's groups as text; cut_a and cut_b are the last tokens of each group."""
        last_a, last_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        last_a[cut_a] = last_b[cut_b] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b = np.concatenate([[0], cut_b + 1])
        said = np.empty(len(a.ids) + len(b.ids), np.int64)
        said[np.arange(len(a.ids)) + before_b[group_a]] = 2 * a.ids.to_numpy().astype(np.int64) + last_a
        said[np.arange(len(b.ids)) + cut_a[group_b] + 1] = 2 * b.ids.to_numpy().astype(np.int64) + last_b + len(a.side.said)
        told = pa.concat_arrays([a.side.said, b.side.said]).take(pa.array(said))
        data = _bytes_of(told)
        at = np.frombuffer(told.buffers()[1], np.int64)[: len(told) + 1] if len(told) else np.zeros(1, np.int64)
        ends = at[np.cumsum(self.n_a + self.n_b)].tolist()
        sha = lambda start, end: hashlib.sha256(data[start : end - 1]).hexdigest() if end > start else ""
        return [sha(start, end) for start, end in zip([0, *ends[:-1]], ends, strict=True)] if len(self.n_a) else []


class Segment:
    """The distinct pairs of some blocks, numbered as they come, and in how many rows each is linked."""

    def __init__(self, number: int):
        self.number, self.pairs, self.docs = number, pa.array([], pa.int64()), np.zeros(0, np.int64)

    def add(self, table: pa.Table, first: Side, second: Side) -> pa.RecordBatch:
        found = Alignment(table.column("text").combine_chunks(), first, second)
        held = found.links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        per_pair = held.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        distinct = per_pair.column("pair").combine_chunks()
        self.pairs = pa.concat_arrays([self.pairs, distinct.filter(pc.is_null(pc.index_in(distinct, self.pairs)))])
        docs = np.zeros(len(self.pairs), np.int64)
        docs[: len(self.docs)] = self.docs
        docs[pc.index_in(distinct, self.pairs).to_numpy()] += per_pair.column("count_all").to_numpy()
        self.docs = docs
        slots = pc.index_in(held.column("pair").combine_chunks(), self.pairs).to_numpy().astype(np.int64)
        doc = held.column("doc").to_numpy()
        order = np.argsort(doc << 32 | slots)
        slots, doc = slots[order], doc[order]
        gaps = np.diff(slots, prepend=0)
        starts = np.flatnonzero(np.diff(doc, prepend=-1))
        gaps[starts] = slots[starts]
        row = {
            "segment": self.number, "doc_ids": table.column("doc_id").to_pylist(), "n_a": found.n_a, "n_b": found.n_b,
            "n_groups": found.n_groups, "n_links": found.n_links, "shas": found.shas,
            "n_pairs": np.bincount(doc, minlength=table.num_rows), "gaps": pack(gaps),
            "times": pack(held.column("count_all").to_numpy()[order]),
        }
        return pa.RecordBatch.from_pylist([row], _CODED)

    def rows(self) -> pa.RecordBatch:
        row = {"segment": self.number, "pairs": self.pairs.to_numpy().astype("<i8").tobytes(), "docs": pack(self.docs)}
        return pa.RecordBatch.from_pylist([row], _CODED)


def _encode(rows: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """One row per block and one per segment (CODED), written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = sides_of(byte_vocabulary, piece_model)
        number = TaskContext.get().partitionId() << 32
        segment = Segment(number)
        for table in blocks(batches, "text", BLOCK_TEXT):
            yield segment.add(table, *sides)
            if len(segment.pairs) >= SEGMENT_PAIRS:
                yield segment.rows()
                segment = Segment(segment.number + 1)
        if len(segment.docs):
            yield segment.rows()

    return settle(rows.mapInArrow(run, CODED), "aligned")


def _pairs(coded: DataFrame) -> DataFrame:
    """(segment, slot, a, b, n): the pairs of every segment as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = np.frombuffer(row["pairs"], "<i8")
                docs = unpack(row["docs"]).astype(np.int64)
                for i in range(0, len(pairs), 100_000):
                    some = pairs[i : i + 100_000]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "segment": pa.array(np.full(len(some), row["segment"])),
                            "slot": pa.array(np.arange(i, i + len(some), dtype=np.int32)),
                            "a": pa.array((some >> 32).astype(np.int32)), "b": pa.array(some.astype(np.int32)),
                            "n": pa.array(docs[i : i + 100_000]),
                        }
                    )

    rows = coded.filter("pairs is not null").select("segment", "pairs", "docs")
    return rows.mapInArrow(run, "segment long, slot int, a int, b int, n long")


def _sums(table: pa.Table, answers: pa.Table) -> pa.Table:
    """RESULT for the blocks of one segment, given the counts of its pairs."""
    slots = answers.column("slot").to_numpy()
    counts, best = np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64)
    counts[slots] = answers.column("count").to_numpy()
    best[slots] = answers.column("best").to_numpy()
    out = {name: [] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")}
    for row in table.to_pylist():
        n_pairs = np.array(row["n_pairs"], np.int64)
        ends = np.cumsum(n_pairs)
        gaps, times = unpack(row["gaps"]).astype(np.int64), unpack(row["times"]).astype(np.int64)
        # Gaps add up within a row; what the rows before added up to is taken off.
        run = np.concatenate([[0], np.cumsum(gaps)])
        own = run[1:] - np.repeat(run[ends - n_pairs], n_pairs)
        summed = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])])
        out["n_best"].append(summed(times * best[own]))
        out["count_sum"].append(summed(times * counts[own]))
        out["doc_id"] += row["doc_ids"]
        out["groups_sha256"] += row["shas"]
        for name in ("n_a", "n_b", "n_groups", "n_links"):
            out[name] += row[name]
    for name in ("n_best", "count_sum"):
        out[name] = np.concatenate(out[name]) if out[name] else np.zeros(0, np.int64)
    return pa.table({k: pa.array(v, pa.string() if k == "groups_sha256" else pa.int64()) for k, v in out.items()})


def pair_counts(coded: DataFrame) -> DataFrame:
    """(segment, slot, a, b, count, best): in how many documents of the corpus each pair is linked, and
    whether that is the highest count of its first id. One shuffle, by the first id, serves both sums."""
    rows = _pairs(coded).repartition("a")
    counted = rows.withColumn("count", F.sum("n").over(Window.partitionBy("a", "b")))
    best = F.col("count") == F.max("count").over(Window.partitionBy("a"))
    return counted.select("segment", "slot", "a", "b", "count", best.cast("long").alias("best"))


def align(
    docs: DataFrame, byte_vocabulary: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """RESULT of every row, one row out per row in.

    `byte_vocabulary` (side A) encodes a space and the text, `piece_model` (side B) the text, which it
    puts a space before; both without special tokens, whose strings are plain text. Byte offsets
    where tokens of both sides end cut a text into groups; every pair of tokens that overlap is a link. A pair's
    count is in how many rows it is linked, n_best says how many links have the highest count of
    their A id, ties included, and count_sum adds the counts of all links. groups_sha256 is of `a1,a2|b1;a3|b2,b3`.

    Null and empty texts, and texts that either side doesn't give back byte for byte, have no tokens: zeros and
    an empty digest. A null id stays null; repeated rows come out, and count, each; other columns are ignored; an
    empty table gives no rows. The vocabularies are paths on every machine. Blocks and segments are written to
    the shared folder once, so a lost executor costs no second encoding.
    """
    coded = _encode(texts(docs, id_col, text_col), byte_vocabulary, piece_model)
    answers = pair_counts(coded).select("segment", "slot", "count", "best")
    of_blocks = coded.filter("pairs is null").drop("pairs", "docs")
    return of_blocks.groupBy("segment").cogroup(answers.groupBy("segment")).applyInArrow(_sums, RESULT)
