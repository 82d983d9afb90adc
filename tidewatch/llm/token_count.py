"""Token counts of byte-level BPE with the whole-token shortcut."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import texts
from tidewatch.llm.pretokens import OLD_LETTERS, PATTERN, ChunkCache


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def prove_whole_tokens(vocabulary: str) -> list[str]:
    """Texts of the vocabulary entries that, alone, are one pre-token and encode as that one token.

    Work on the vocabulary only, done once before any document is read; the list is bounded by
    the vocabulary's size. Entries that are not valid UTF-8 by themselves cannot be pre-tokens.
    """
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    split = regex.compile(PATTERN)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    of_letter = {c: b for b, c in byte_letters().items()}
    found = []
    for entry, token in tokenizer.get_vocab(with_added_tokens=False).items():
        if entry in special or any(c not in of_letter for c in entry):
            continue
        try:
            text = bytes(of_letter[c] for c in entry).decode()
        except UnicodeDecodeError:
            continue
        if any(c >= OLD_LETTERS for c in text) or split.findall(text) != [text]:
            continue
        if [t.id for t in tokenizer.model.tokenize(entry)] == [token]:
            found.append(text)
    return found


class TokenCounter:
    """Counts the tokens of texts; pre-tokens that are whole tokens never reach the merges."""

    def __init__(self, vocabulary: str, whole: frozenset[str]):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.split = regex.compile(PATTERN)
        self.letters = {b: c for b, c in byte_letters().items()}
        self.whole = whole
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.cache = ChunkCache(self.count_chunk)

    def merged(self, piece: str) -> int:
        return len(self.tokenizer.model.tokenize("".join([self.letters[b] for b in piece.encode()])))

    def count_chunk(self, chunk: str) -> int:
        if chunk and max(chunk) >= OLD_LETTERS:
            spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)
            return sum(len(self.tokenizer.model.tokenize(mapped)) for mapped, _ in spans)
        whole = self.whole
        return sum(1 if piece in whole else self.merged(piece) for piece in self.split.findall(chunk))

    def count(self, text: str) -> int:
        if self.special and self.special.search(text):
            between = self.special.split(text)
            return len(between) - 1 + sum(map(self.count_chunk, between))
        first, rest = self.cache.values(text)
        return first + sum(rest)


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, one row out per row in, without a shuffle.

    The counts are those of the vocabulary's library without begin, end or added tokens; special
    strings inside a text count as one token, as by the library's default. `vocabulary` is a path
    on every machine. Null and empty texts have 0 bytes and 0 tokens; a null id stays null;
    repeated rows are counted each; other columns are ignored; an empty table gives no rows.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    if pieces := json.loads(open(vocabulary).read()).get("normalizer"):
        raise ValueError(f"the vocabulary normalizes texts: {pieces}")
    proven = docs.sparkSession.sparkContext.broadcast(frozenset(prove_whole_tokens(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(vocabulary, proven.value)
        for batch in batches:
            counts = [counter.count(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
