"""Token-id output in grammar-compressed shards with random access.

Documents are dealt by ranges of id and encoded in that order; a shard holds the documents of about
BLOCK_TEXT bytes of text. Each shard is compressed by Re-Pair: frequent pairs of neighbouring
symbols become rules, never across the end of a document, until no pair is frequent. The shard stores
the rules, how many ids each expands to, the remaining symbols and where each document begins, so
any document is decoded without the others.

A round replaces all pairs that no overlapping pair surpasses in frequency. After it only the
neighbours of what was replaced, and frequent pairs that gave way, are counted again: most pairs of
older symbols that were rare stay so. When none of these is frequent, all are counted once more.

The file format is a Parquet table of shards (part, seq, doc_ids, payload). Parts are ranges of id,
`seq` counts the shards of a part, and `payload` is laid out as

    magic "RPG1", n_docs, n_rules, n_symbols (u32 each), sizes of the four sections that follow (u32 each),
    rules (left symbols, then right symbols), expansion lengths, symbols, document offsets into the symbols

where a section is the compressed byte planes of its u32 numbers. Symbols below FIRST_RULE are ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.bpe import pack, unpack
from tidewatch.llm.common import blocks, row_key, texts
from tidewatch.llm.token_count import byte_letters
from tidewatch.session import work_dir

MAGIC = b"RPG1"
HEADER = struct.Struct("<4sIII4I")
END = 1
FIRST_RULE = 1 << 17
#: A pair is frequent if it stands so often; a rule made in a round replaces half as many places at least,
#: what is left of a run of one symbol.
LEAST_COUNT = 8
LEAST_USES = 4
BLOCK_TEXT = 4 << 20
CACHE_WORDS, CACHE_IDS, CACHE_LETTERS = 250_000, 2_000_000, 100
#: The vocabulary's split of normalized text, and where its lower-casing and
#: composition of letters begin to need the library.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
COMPOSING = "\u0300"
WORD_END = b"\0"
#: What chunks that are split all at once do not hold: blanks, controls, apostrophes, letters whose small
#: form is not one letter below COMPOSING.
NOT_PLAIN = "[^\x21-\x26\x28-\x7e\u00a1-\u00ac\u00ae-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u02ff]"
_BUCKETS = 1 << 20


def _bucket(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left.astype(np.uint32) * np.uint32(0x9E3779B1) + right.astype(np.uint32) * np.uint32(0x85EBCA77)
    return (mixed >> np.uint32(12)).astype(np.int32)


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.int64) << np.int64(32) | right


class _Rules:
    """Pairs that have a symbol, in order of their numbers and by code (left << 32 | right)."""

    def __init__(self) -> None:
        self.pairs, self.lengths = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        self.codes, self.numbers = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def known(self, codes: np.ndarray) -> np.ndarray:
        """The rule of each code, -1 without one."""
        if not len(self.codes):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.numbers[at], -1)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The symbol of each code, a new one if it has none."""
        number = self.known(codes)
        new = number < 0
        number[new] = len(self.pairs) + np.arange(new.sum())
        made = np.stack([codes[new] >> 32, codes[new] & 0xFFFFFFFF], 1)
        of_ids = made < FIRST_RULE
        sizes = np.where(of_ids, 1, np.append(self.lengths, 1)[np.where(of_ids, -1, made - FIRST_RULE)]).sum(1)
        self.pairs, self.lengths = np.concatenate([self.pairs, made]), np.concatenate([self.lengths, sizes])
        codes, numbers = np.concatenate([self.codes, codes[new]]), np.concatenate([self.numbers, number[new]])
        order = np.argsort(codes)
        self.codes, self.numbers = codes[order], numbers[order]
        return FIRST_RULE + number

    def frequent(self, symbols: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of pairs that are frequent or have a rule, the number of each one's pair by rising frequency, the pairs' codes."""
        left, right = symbols[places], symbols[places + 1]
        if len(places) > _BUCKETS >> 3:
            # Most pairs are rare; the counts of buckets rule them out without a sort.
            bucket = _bucket(left, right)
            often = np.bincount(bucket, minlength=_BUCKETS) >= LEAST_COUNT
            often[_bucket(self.pairs[:, 0], self.pairs[:, 1])] = True
            maybe = often[bucket]
            places, left, right = places[maybe], left[maybe], right[maybe]
        # A hash table tells the pairs apart, as few of them are distinct.
        found = pa.array(_pair(left, right)).dictionary_encode()
        codes, own = found.dictionary.to_numpy(), found.indices.to_numpy()
        counts = np.bincount(own, minlength=len(codes))
        order = np.flatnonzero((counts >= LEAST_COUNT) | (self.known(codes) >= 0))
        order = order[np.lexsort((codes[order], counts[order]))]
        rank = np.full(len(codes), -1, np.int32)
        rank[order] = np.arange(len(order))
        ranks = rank[own]
        some = ranks >= 0
        return places[some], ranks[some], codes[order]


def _taken(places: np.ndarray, ranks: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which places are replaced: no overlapping pair has a higher rank; of a run of one pair, every second place."""
    beside = np.diff(places) == 1
    top = np.ones(len(places), bool)
    top[1:] &= ~beside | (ranks[1:] >= ranks[:-1])
    top[:-1] &= ~beside | (ranks[:-1] >= ranks[1:])
    top = np.flatnonzero(top)
    new_run = np.concatenate([[True], np.diff(places[top]) > 1])
    first = np.flatnonzero(new_run)
    nth = np.arange(len(top)) - np.repeat(first, np.diff(first, append=len(top)))
    top = top[nth % 2 == 0]
    # The highest pair gives way to none, so that every round replaces some.
    uses = np.bincount(ranks[top], minlength=len(known))
    return top[((uses >= LEAST_USES) | known)[ranks[top]]]


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rules (n, 2), ids each expands to, symbols and the end of each document in them. `ends` are those in the ids."""
    symbols = ids.astype(np.int32)
    last = np.zeros(len(symbols), bool)
    last[ends[ends > 0] - 1] = True
    last[-1:] = True
    rules = _Rules()
    count = ~last
    every = True
    while True:
        places, ranks, codes = rules.frequent(symbols, np.flatnonzero(count))
        if not len(places):
            if every:
                return rules.pairs, rules.lengths, symbols, np.flatnonzero(last) + 1
            count, every = ~last, True
            continue
        taken = _taken(places, ranks, rules.known(codes) >= 0)
        at, ranks = places[taken], ranks[taken]
        used = np.flatnonzero(np.bincount(ranks, minlength=len(codes)))
        made = np.zeros(len(codes), np.int32)
        made[used] = rules.symbols(codes[used])
        symbols[at] = made[ranks]
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        # Counted next: what was frequent, and the pairs that end in a new symbol.
        count = np.zeros(len(symbols), bool)
        count[places] = True
        count = count[keep]
        count[np.maximum(at - np.arange(len(at)) - 1, 0)] = True
        symbols, last = symbols[keep], last[keep]
        count &= ~last
        every = False


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of ranges that begin at `starts`, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@dataclass
class Shard:
    """A shard read back: `expanded` holds every rule's ids, one after the other."""

    symbols: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    expanded: np.ndarray

    def document(self, i: int) -> np.ndarray:
        """The ids of one document, without touching the others."""
        return self.expand(self.symbols[self.offsets[i] : self.offsets[i + 1]])

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents, and each one's size."""
        before = np.concatenate([[0], np.cumsum(self.sizes(self.symbols))])
        return self.expand(self.symbols), np.diff(before[self.offsets])

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        return np.append(self.lengths, 1)[np.where(symbols >= FIRST_RULE, symbols - FIRST_RULE, -1)]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        rule = np.flatnonzero(symbols >= FIRST_RULE)
        sizes = self.sizes(symbols)
        out = np.repeat(symbols, sizes)
        to = (np.cumsum(sizes) - sizes)[rule]
        out[_spread(to, sizes[rule])] = self.expanded[_spread(self.starts[symbols[rule] - FIRST_RULE], sizes[rule])]
        return out


def write_shard(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """`ends` has the end of each document in the ids; no document is empty."""
    rules, lengths, symbols, at = compress(ids, ends)
    offsets = np.concatenate([[0], at])
    sections = [pack(rules.T.ravel()), pack(lengths), pack(symbols), pack(offsets)]
    return HEADER.pack(MAGIC, len(ends), len(rules), len(symbols), *map(len, sections)) + b"".join(sections)


def read_shard(payload: bytes) -> Shard:
    magic, n_docs, n_rules, n_symbols, *sizes = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a shard")
    at, sections = HEADER.size, []
    for size in sizes:
        sections.append(unpack(payload[at : at + size]).astype(np.int64) if size else np.zeros(0, np.int64))
        at += size
    rules, lengths, symbols, offsets = sections
    if (len(offsets), len(lengths), len(symbols)) != (n_docs + 1, n_rules, n_symbols):
        raise ValueError("a shard is damaged")
    starts = np.cumsum(lengths) - lengths
    pairs = rules.reshape(2, -1)
    expanded = np.arange(FIRST_RULE, FIRST_RULE + n_rules)
    while (rule := expanded >= FIRST_RULE).any():
        number = expanded[rule] - FIRST_RULE
        expanded = np.repeat(expanded, rule + 1)
        first = np.flatnonzero(rule) + np.arange(len(number))
        expanded[first], expanded[first + 1] = pairs[0, number], pairs[1, number]
    return Shard(symbols, offsets, lengths, starts, expanded)


def word_merger(vocabulary: str):
    """An encoding that merges the bytes of words, WORD_END behind each, by the vocabulary's ranks; which ids end a word.

    The ids of the vocabulary rise with its merges, which is checked. Texts with byte 0, which
    stands for the end of a word, are not for it.
    """
    import tiktoken

    with open(vocabulary) as f:
        read = json.load(f)
    model = read["model"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    first = model["vocab"]["".join(pairs[0])]
    if any(model["vocab"]["".join(pair)] != first + i for i, pair in enumerate(pairs)):
        raise ValueError("the ids of the vocabulary do not follow its merges")
    of_letter = {letter: byte for byte, letter in byte_letters().items()}
    suffix = model["end_of_word_suffix"]
    special = {t["content"] for t in read["added_tokens"]}
    ranks = {}
    for token, rank in model["vocab"].items():
        if token not in special:
            ends = token.endswith(suffix) and token != suffix
            plain = token.removesuffix(suffix) if ends else token
            raw = bytes([of_letter[c] for c in plain])
            if WORD_END not in raw or raw + WORD_END * ends == WORD_END:
                ranks[raw + WORD_END * ends] = rank
    ends_word = np.zeros(max(ranks.values()) + 1, bool)
    ends_word[[rank for token, rank in ranks.items() if token.endswith(WORD_END)]] = True
    return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}), ends_word


def _joined(strings: pa.Array, between: str) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings), between)[0].as_py()


class ChunkEncoder:
    """Ids of texts from the vocabulary's library, called once per distinct word.

    The vocabulary's own split never joins what a blank or line feed separates, and its normalizer
    drops them, so the ids of a text are those of its chunks one after the other. Plain chunks of the
    first alphabets are lower-cased and split here, all at once, and their words merged by rank, with
    byte 0 for the end of a word; others of these alphabets one by one. All other chunks, and special
    strings, go through the library whole. Words and chunks that are not plain are kept for later blocks.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.split = regex.compile(WORD_PATTERN).findall
        self.merger, self.ends_word = word_merger(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.not_plain = "|".join([NOT_PLAIN, *map(re.escape, self.special)])
        # Letters, digits (a word each) and all else; a line feed is between chunks.
        kinds = [1 if regex.match(r"\p{L}", c) else 2 if regex.match(r"\p{N}", c) else 3 for c in map(chr, range(ord(COMPOSING)))]
        self.kinds = np.array(kinds, np.uint8)
        self.kinds[ord("\n")] = 0
        self.others: dict[str, list[int]] = {}
        self.n_others = 0
        self.words, self.sizes, self.flat = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def chunk_ids(self, chunk: str) -> list[int]:
        known = (chunk.isascii() or max(chunk) < COMPOSING) and WORD_END.decode() not in chunk
        if not known or any(s in chunk for s in self.special):
            return self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return self.merger.encode_ordinary("".join([word + WORD_END.decode() for word in self.split(chunk.lower())]))

    def split_plain(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words of plain chunks, and how many each has."""
        text = _joined(chunks, "\n").lower()
        letters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kinds = self.kinds[letters]
        inside = kinds > 0
        ends = inside & ((kinds == 2) | (kinds != np.append(kinds[1:], 0)[: len(kinds)]))
        n_words = np.concatenate([[0], np.cumsum(ends)])
        n_words = np.diff(n_words[np.concatenate([[0], np.flatnonzero(~inside), [len(kinds)]])])[: len(chunks)]
        at = np.concatenate([[0], np.cumsum((letters >= 0x80) + inside.view(np.uint8), dtype=np.int32)[ends]]).astype(np.int32)
        data = text.replace("\n", "").encode()
        return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)), n_words

    def word_numbers(self, words: pa.Array) -> np.ndarray:
        """The place of each word in `words`, `sizes` and `flat`, where new ones are added."""
        found = words.dictionary_encode()
        distinct = found.dictionary
        number = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy().copy()
        new = number < 0
        if len(self.words) + new.sum() > CACHE_WORDS or len(self.flat) > CACHE_IDS:
            # Those of this block stay.
            stay = number[~new]
            starts, sizes = np.cumsum(self.sizes) - self.sizes, self.sizes[stay]
            self.words, self.sizes, self.flat = self.words.take(pa.array(stay)), sizes, self.flat[_spread(starts[stay], sizes)]
            number[~new] = np.arange(len(stay))
        number[new] = len(self.words) + np.arange(new.sum())
        if new.any():
            added = distinct.filter(pa.array(new))
            ids = self.merger.encode_to_numpy(_joined(added, WORD_END.decode()) + WORD_END.decode(), disallowed_special=())
            self.words = pa.concat_arrays([self.words, added])
            self.sizes = np.concatenate([self.sizes, np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)])
            self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        return number[found.indices.to_numpy()]

    def other_ids(self, chunks: pa.Array) -> list[list[int]]:
        if self.n_others > CACHE_IDS:
            self.others, self.n_others = {}, 0
        out = []
        for chunk in _joined(chunks, "\n").split("\n") if len(chunks) else []:
            ids = self.others.get(chunk)
            if ids is None:
                ids = self.chunk_ids(chunk)
                if len(chunk) <= CACHE_LETTERS:
                    self.others[chunk] = ids
                    self.n_others += 1 + len(ids)
            out.append(ids)
        return out

    def encode(self, listed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end id after each text, and each text's end."""
        split = pc.split_pattern(pc.replace_substring(listed.cast(pa.string()), "\n", " "), " ")
        found = split.flatten().dictionary_encode()
        chunks = found.dictionary
        other = pc.match_substring_regex(chunks, self.not_plain)
        words, n_words = self.split_plain(chunks.filter(pc.invert(other)))
        number = self.word_numbers(words)
        starts, sizes = (np.cumsum(self.sizes) - self.sizes)[number], self.sizes[number]
        before = np.concatenate([[0], np.cumsum(sizes)])
        others = self.other_ids(chunks.filter(other))
        # The ids of plain chunks, of others, and the end of a text.
        flat = np.concatenate(
            [self.flat[_spread(starts, sizes)], np.fromiter(chain.from_iterable(others), np.int32), np.array([END], np.int32)]
        )
        n_ids = np.concatenate(
            [np.diff(before[np.concatenate([[0], np.cumsum(n_words)])]), np.fromiter(map(len, others), np.int64), [1]]
        )
        row = np.argsort(np.append(other.to_numpy(zero_copy_only=False), True), kind="stable")
        starts, sizes = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
        starts[row], sizes[row] = np.cumsum(n_ids) - n_ids, n_ids
        n_chunks = np.cumsum(pc.list_value_length(split).to_numpy())
        at = np.insert(found.indices.to_numpy(), n_chunks, len(chunks))
        sizes = sizes[at]
        return flat[_spread(starts[at], sizes)], np.cumsum(sizes)[n_chunks + np.arange(len(listed))]


@functools.lru_cache(maxsize=2)
def encoder_of(vocabulary: str) -> ChunkEncoder:
    """A worker that runs several tasks keeps its encoder and what it knows."""
    return ChunkEncoder(vocabulary)


def write_ids(docs: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every whole text, an end id after each, in ascending id order, as shards at `path`.

    Null and empty texts have the end id alone; null ids come first; rows that repeat an id follow
    each other in an order that their text's hash fixes, every one with its ids; other columns are
    ignored; an empty table gives no shards.
    """
    rows = texts(docs, id_col, text_col).withColumn("key", row_key())
    ordered = rows.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        part = TaskContext.get().partitionId()
        for seq, table in enumerate(blocks(batches, "text", BLOCK_TEXT)):
            ids, ends = encoder.encode(table.column("text").combine_chunks())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                    pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([len(ids)], pa.int64()), pa.array([write_shard(ids, ends)], pa.binary()),
                ],
                names=["part", "seq", "doc_ids", "n_ids", "payload"],
            )

    shards = ordered.mapInArrow(run, "part int, seq int, doc_ids array<long>, n_ids long, payload binary")
    shards.write.mode("overwrite").parquet(path)


def read_ids(spark, path: str) -> DataFrame:
    """(doc_id, start, ids array<int>) of every document of the shards at `path`.

    `start` counts the ids of all documents before. Shards are added up inside their part, parts
    over one row each.
    """
    shards = spark.read.parquet(path)
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(parts_before), F.lit(0)).alias("base"))
    starts = (
        shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("inside"))
        .join(parts, "part")
        .select("part", "seq", (F.col("base") + F.col("inside")).alias("shard_start"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, sizes = read_shard(batch.column("payload")[i].as_py()).documents()
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                start = batch.column("shard_start")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values, pa.array(start + offsets[:-1].astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))],
                    names=["doc_id", "start", "ids"],
                )

    placed = shards.join(starts, ["part", "seq"]).select("doc_ids", "shard_start", "payload")
    return placed.mapInArrow(run, "doc_id long, start long, ids array<int>")


def digest(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian u32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            ids = batch.column("ids")
            values = ids.flatten().to_numpy().astype("<u4")
            ends = np.cumsum(pc.list_value_length(ids).to_numpy())
            sums = [
                zlib.crc32(values[a:b].tobytes()) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pc.list_value_length(ids).cast(pa.int64()),
                 pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return read.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the documents' ids to the shared folder and read them back."""
    path = work_dir(docs.sparkSession, "token-shards")
    write_ids(docs, vocabulary, path)
    return read_ids(docs.sparkSession, path)
