"""Line dedup by a deletion-neighbourhood join.

Two lines are one edit apart if they are equal without the character at one and the same place (a
substitution), or if one equals the other without one character. Each line therefore emits itself
and its variants with one character deleted as hashed keys that carry the deleted place; equal
variants of another place would be two edits apart. Of each key only the earliest line counts: it is
named to the later ones, its text is sent to them, and a line goes only if the two texts are one
edit apart.

Lines of one edit share their first or their second half. Only lines that share a half with
another line of about their length emit variants, and only with deletions in the other half.

Texts are dealt into blocks by a hash of the document. A block asks about each of its distinct
lines once; the line that stands in a third of all documents is one row per block. It asks about
each distinct half once too, naming two of the lines at most that have it, as two prove it shared.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import prepare, unused
from tidewatch.llm.decontam import row_key_of

#: Shorter lines are duplicates only if they are equal.
LEAST_CHARS = 20
BLOCK_TEXT = 4 << 20
#: Characters of the lines whose variants are hashed together; a longer line stands alone.
SLICE_CHARS = 1 << 18
#: Primes and bases of the variants' hashes.
MODULI = ((2147483647, 1103515245), (2147483629, 1664525033))
_LENGTH = np.uint64(0x9E3779B97F4A7C15)
#: Rows that one task of a join compares, and text bytes per line that size the number of tasks.
JOIN_ROWS, LINE_BYTES = 500_000, 300

ASKED = "part int, kind int, block int, hashes binary, tails binary, at binary, docs binary, doc_ids binary, keys binary"
ANSWER = "block int, kind int, at binary"
PAIRS = "block int, at binary, later_blocks binary, later_at binary"
EARLIER = "text string, later array<struct<block:int,at:binary>>"
EQUAL, HALF, VARIANT = 0, 1, 2
_ASKED = pa.schema(
    [("part", pa.int32()), ("kind", pa.int32()), ("block", pa.int32())]
    + [(c, pa.binary()) for c in ("hashes", "tails", "at", "docs", "doc_ids", "keys")]
)
_ANSWER = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("at", pa.binary())])
_PAIRS = pa.schema([("block", pa.int32())] + [(c, pa.binary()) for c in ("at", "later_blocks", "later_at")])
_EARLIER = pa.schema(
    [("text", pa.string()), ("later", pa.list_(pa.struct([("block", pa.int32()), ("at", pa.binary())])))]
)


@dataclass
class Lines:
    """Distinct lines of a block in order of their first place, and the document of that place."""

    number: int
    doc_ids: np.ndarray
    keys: np.ndarray
    listed: list[str]
    doc: np.ndarray
    hashes: np.ndarray
    tails: np.ndarray
    #: For each row of the block, its lines and their numbers; -1 is a blank line.
    rows: list[tuple[list[str], list[int]]]
    #: Rows whose id and text an earlier row of the block has, and all rows in order of id.
    twin_of: list[int]
    order: list[int]


def _lines(table: pa.Table) -> Lines:
    import xxhash

    ids = table.column("_id")
    nulls = ids.is_null().to_numpy()
    doc_ids = ids.fill_null(np.iinfo(np.int64).min).to_numpy()
    keys = table.column("_key").to_numpy()
    texts = table.column("_text").to_pylist()
    order = np.lexsort((keys, doc_ids, ~nulls))
    numbers: dict[str, int] = {}
    doc: list[int] = []
    rows: list = [None] * len(texts)
    twin_of = [-1] * len(texts)
    last = -1
    for i in order.tolist():
        if last >= 0 and keys[i] == keys[last] and doc_ids[i] == doc_ids[last]:
            twin_of[i] = last
            rows[i] = rows[last]
            continue
        last = i
        lines = texts[i].split("\n")
        own = []
        for line in lines:
            stripped = line.strip(" \t\r\x0b\x0c")
            if not stripped:
                own.append(-1)
                continue
            at = numbers.setdefault(stripped, len(numbers))
            if at == len(doc):
                doc.append(i)
            own.append(at)
        rows[i] = (lines, own)
    listed = list(numbers)
    raw = np.frombuffer(b"".join([xxhash.xxh3_128_digest(s.encode()) for s in listed]), ">u8").reshape(-1, 2)
    return Lines(
        table.column("_block")[0].as_py(), doc_ids, keys, listed, np.array(doc, np.int64),
        raw[:, 0].astype(np.uint64), raw[:, 1].astype(np.uint64).astype(np.uint32), rows, twin_of, order.tolist(),
    )


def _halves(line: str) -> tuple[bytes, ...]:
    """First and second half of the line as one of its length, and as one that has a character too many."""
    n = len(line)
    m = n - 1
    return (
        f"{n}<{line[: n // 2]}".encode(),
        f"{n}>{line[n // 2 :]}".encode(),
        f"{m}<{line[: m // 2]}".encode(),
        f"{m}>{line[n - (m - m // 2) :]}".encode(),
    )


def _powers(p: int, base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1) modulo p."""
    out = np.ones(max(n, 1), np.uint64)
    have, last = 1, base
    while have < n:
        out[have : 2 * have] = out[: min(have, n - have)] * np.uint64(last) % np.uint64(p)
        have, last = 2 * have, last * last % p
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashed(listed: list[str], low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place and number of each line (place 0) and of the line without character p (place p + 1), low <= p < high.

    A line's hash is a polynomial of its characters modulo two primes, mixed with its length; without a
    character it is the sum before that place and the sum behind it, moved by one power. So memory
    follows the characters, however many variants a line has.
    """
    sizes = np.array([len(s) for s in listed], np.int64)
    chars = np.frombuffer("".join(listed).encode("utf-32-le", "surrogatepass"), np.uint32)
    start = np.cumsum(sizes) - sizes
    number = np.repeat(np.arange(len(listed), dtype=np.int64), sizes)
    at = np.arange(len(chars)) - start[number]
    wanted = np.flatnonzero((at >= low[number]) & (at < high[number]))
    line, place = number[wanted], at[wanted]
    whole = np.zeros(len(listed), np.uint64)
    cut = np.zeros(len(wanted), np.uint64)
    for p, base in MODULI:
        prime = np.uint64(p)
        terms = (chars.astype(np.uint64) + np.uint64(1)) * _powers(p, base, int(sizes.max()))[at] % prime
        # Sums of fewer than 2 ** 32 terms under 2 ** 31 stay under 2 ** 63.
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        before = sums[wanted] - sums[start][line]
        behind = (sums[start + sizes][line] - sums[wanted + 1]) % prime
        cut = cut << np.uint64(31) | (before + behind * np.uint64(pow(base, -1, p))) % prime
        whole = whole << np.uint64(31) | (sums[start + sizes] - sums[start]) % prime
    length = sizes.astype(np.uint64) * _LENGTH
    return (
        np.concatenate([_mixed(whole ^ length), _mixed(cut ^ (length[line] - _LENGTH))]),
        np.concatenate([np.zeros(len(listed), np.int64), place + 1]),
        np.concatenate([np.arange(len(listed)), line]),
    )


def _left(line: str, first_half: bool, second_half: bool) -> tuple[int, int]:
    """Range of deletions: a shared first half leaves those in the second one, and the other way round."""
    n = len(line)
    return 0 if second_half else (n - 1) // 2, n if first_half else max(n // 2, (n - 1) // 2 + 1)


def _variants(line: str, first_half: bool, second_half: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the line itself at place 0, and at place p + 1 of the line without character p."""
    low, high = _left(line, first_half, second_half)
    return _hashed([line], np.array([low]), np.array([high]))[:2]


def _ask(block: Lines, kind: int, hashes: np.ndarray, tails: np.ndarray, at: np.ndarray, bits: int, line: np.ndarray) -> list:
    """Rows of questions by part, the top bits of the hash. `line` gives the line of each question."""
    order = np.argsort(hashes, kind="stable")
    hashes, tails, at, line = hashes[order], tails[order], at[order], line[order]
    edges = [0, len(hashes)]
    if bits:
        cuts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        edges = [0, *np.searchsorted(hashes, cuts).tolist(), len(hashes)]
    out = []
    for part, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if b > a:
            row = {
                "part": part, "kind": kind, "block": block.number, "hashes": hashes[a:b].tobytes(),
                "tails": tails[a:b].astype(np.uint32).tobytes(), "at": at[a:b].astype(np.int32).tobytes(),
            }
            if kind != HALF:
                used, inverse = np.unique(block.doc[line[a:b]], return_inverse=True)
                row |= {
                    "docs": inverse.astype(np.int32).tobytes(), "doc_ids": block.doc_ids[used].tobytes(),
                    "keys": block.keys[used].tobytes(),
                }
            out.append(row)
    return out


def _half_hashes(block: Lines, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of halves in order; and for four halves of each long line, the line and the number of the hash."""
    import xxhash

    long = [i for i, s in enumerate(block.listed) if len(s) >= least_chars]
    digest = xxhash.xxh3_64_digest
    raw = b"".join([digest(h) for i in long for h in _halves(block.listed[i])])
    hashes, number = np.unique(np.frombuffer(raw, ">u8").astype(np.uint64), return_inverse=True)
    return hashes, np.repeat(np.array(long, np.int64), 4), number


def _two_of_each(number: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Rows that give the first two differing tails of each number."""
    order = np.lexsort((tails, number))
    order = order[_starts(number[order], tails[order])]
    own = number[order]
    second = np.concatenate([np.zeros(min(2, len(own)), bool), own[2:] == own[:-2]])
    return order[~second]


def _ask_lines(table: pa.Table, bits: int, least_chars: int) -> pa.Table:
    block = _lines(table)
    every = np.arange(len(block.listed))
    asked = _ask(block, EQUAL, block.hashes, block.tails, every, bits, every)
    hashes, line, number = _half_hashes(block, least_chars)
    if len(line):
        sent = _two_of_each(number, block.tails[line])
        line, number = line[sent], number[sent]
        asked += _ask(block, HALF, hashes[number], block.tails[line], number, bits, line)
    return pa.Table.from_pylist(asked, _ASKED)


def _joined(table: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows = table.to_pylist()
    sizes = [len(r["hashes"]) // 8 for r in rows]
    return (
        rows,
        np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows]),
        np.concatenate([np.frombuffer(r["tails"], np.uint32) for r in rows]),
        np.concatenate([np.frombuffer(r["at"], np.int32) for r in rows]),
        np.repeat(np.arange(len(rows)), sizes),
    )


def _answer(rows: list[dict], kind: int, at: np.ndarray, row: np.ndarray, hit: np.ndarray) -> pa.Table:
    """What was hit, by block; one sort of the hits, however many blocks have asked."""
    codes = np.unique(row[hit].astype(np.int64) << np.int64(32) | at[hit])
    edges = np.searchsorted(codes, np.arange(len(rows) + 1) << np.int64(32))
    told = (codes & np.int64(0xFFFFFFFF)).astype(np.int32)
    found = [
        {"block": r["block"], "kind": kind, "at": told[a:b].tobytes()}
        for r, a, b in zip(rows, edges[:-1].tolist(), edges[1:].tolist(), strict=True)
        if b > a
    ]
    return pa.Table.from_pylist(found, _ANSWER)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted columns change."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _places(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    ids = [np.frombuffer(r["doc_ids"], np.int64)[np.frombuffer(r["docs"], np.int32)] for r in rows]
    keys = [np.frombuffer(r["keys"], np.int64)[np.frombuffer(r["docs"], np.int32)] for r in rows]
    return np.concatenate(ids), np.concatenate(keys)


def _compare(table: pa.Table) -> pa.Table:
    """Answers of one part: lines that are not the earliest, halves that are shared."""
    rows, hashes, tails, at, row = _joined(table)
    kind = rows[0]["kind"]
    if kind == HALF:
        order = np.lexsort((tails, hashes))
        new = _starts(hashes[order])
        group = np.cumsum(new) - 1
        kinds = np.bincount(group[_starts(hashes[order], tails[order])])
        hit = np.zeros(len(hashes), bool)
        hit[order] = kinds[group] > 1
        return _answer(rows, HALF, at, row, hit)
    ids, keys = _places(rows)
    order = np.lexsort((at, keys, ids, tails, hashes))
    hit = np.zeros(len(hashes), bool)
    hit[order] = ~_starts(hashes[order], tails[order])
    return _answer(rows, EQUAL, at, row, hit)


def _pair_up(table: pa.Table) -> pa.Table:
    """For each line with a variant of an earlier one in this part, the earliest; by the block of the earlier line."""
    rows, hashes, tails, at, row = _joined(table)
    ids, keys = _places(rows)
    # The rank of a line's place decides who is earlier.
    by_place = np.lexsort((at, keys, ids))
    rank = np.empty(len(at), np.int64)
    rank[by_place] = np.cumsum(_starts(ids[by_place], keys[by_place], at[by_place])) - 1
    order = np.lexsort((rank, tails, hashes))
    h, t, r = hashes[order], tails[order], rank[order]
    same_place = _starts(h, t)
    first = r[np.maximum.accumulate(np.where(same_place, np.arange(len(r)), 0))]
    content = np.cumsum(_starts(h)) - 1
    none = np.iinfo(np.int64).max
    whole = np.full(content[-1] + 1, none)
    np.minimum.at(whole, content[t == 0], r[t == 0])
    cut = np.full(len(whole), none)
    np.minimum.at(cut, content[t > 0], r[t > 0])
    earliest = np.full(int(rank.max()) + 1, none)
    np.minimum.at(earliest, r, np.minimum(first, np.where(t == 0, cut[content], whole[content])))
    entry = np.empty(len(earliest), np.int64)
    entry[rank] = np.arange(len(rank))
    later = np.flatnonzero(earliest < np.arange(len(earliest)))
    blocks = np.array([own["block"] for own in rows], np.int32)[row]
    a, b = entry[later], entry[earliest[later]]
    a, b = a[np.argsort(blocks[b], kind="stable")], b[np.argsort(blocks[b], kind="stable")]
    edges = [*np.flatnonzero(_starts(blocks[b])).tolist(), len(b)]
    found = [
        {
            "block": int(blocks[b[i]]), "at": at[b[i:j]].tobytes(),
            "later_blocks": blocks[a[i:j]].tobytes(), "later_at": at[a[i:j]].tobytes(),
        }
        for i, j in zip(edges[:-1], edges[1:], strict=True)
    ]
    return pa.Table.from_pylist(found, _PAIRS)


def _earlier(table: pa.Table, pairs: pa.Table) -> pa.Table:
    """The text of each earlier line of the block that a pair names, and the later lines of its pairs."""
    if not table.num_rows or not pairs.num_rows:
        return pa.Table.from_pylist([], _EARLIER)
    listed = _lines(table).listed
    at, blocks, later = (
        np.concatenate([np.frombuffer(x, np.int32) for x in pairs.column(c).to_pylist()])
        for c in ("at", "later_blocks", "later_at")
    )
    own = np.unique(np.stack([at, blocks, later], 1), axis=0)
    edges = [*np.flatnonzero(_starts(own[:, 0])).tolist(), len(own)]
    found = [
        {
            "text": listed[own[i, 0]],
            "later": [{"block": int(block), "at": number.tobytes()} for _, block, number in own[i:j]],
        }
        for i, j in zip(edges[:-1], edges[1:], strict=True)
    ]
    return pa.Table.from_pylist(found, _EARLIER)


def within_one_edit(a: str, b: str) -> bool:
    """Whether the texts are equal, or become so by one character added, dropped or replaced."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    low, high = 0, len(b)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return a[low + 1 :] == b[low + (len(a) == len(b)) :]


def _verified(block: Lines, answers: pa.Table) -> set[int]:
    """Numbers of the lines that are one edit apart from an earlier line, whose text was sent."""
    gone: set[int] = set()
    columns = (answers.column(c).to_pylist() for c in ("kind", "at", "text"))
    for kind, at, text in zip(*columns, strict=True):
        if kind == VARIANT:
            number = int.from_bytes(at, "little")
            if number not in gone and within_one_edit(block.listed[number], text):
                gone.add(number)
    return gone


def _told(answers: pa.Table, kind: int) -> np.ndarray:
    """Sorted numbers that the answers of a block name."""
    found = [
        np.frombuffer(at, np.int32)
        for own, at in zip(answers.column("kind").to_pylist(), answers.column("at").to_pylist(), strict=True)
        if own == kind
    ]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def _shared(block: Lines, told: np.ndarray, least_chars: int) -> dict[int, int]:
    """Lines that have one of the told halves: 1 if a first one, 2 if a second, 3 if both."""
    _, line, number = _half_hashes(block, least_chars)
    which = np.tile(np.array([1, 2, 1, 2]), len(line) // 4)
    halves = np.zeros(len(block.listed), np.int64)
    hit = np.isin(number, told)
    np.bitwise_or.at(halves, line[hit], which[hit])
    return {i: int(halves[i]) for i in np.flatnonzero(halves).tolist()}


def _ask_variants(table: pa.Table, answers: pa.Table, bits: int, least_chars: int) -> pa.Table:
    if not table.num_rows:
        return pa.Table.from_pylist([], _ASKED)
    block = _lines(table)
    later = set(_told(answers, EQUAL).tolist())
    shared = _shared(block, _told(answers, HALF), least_chars)
    asked: list[dict] = []
    held: list[int] = []
    chars = 0

    def ask() -> None:
        left = np.array([_left(block.listed[i], bool(shared[i] & 1), bool(shared[i] & 2)) for i in held])
        hashes, places, of = _hashed([block.listed[i] for i in held], left[:, 0], left[:, 1])
        line = np.array(held)[of]
        asked.extend(_ask(block, VARIANT, hashes, places, line, bits, line))

    for i in shared:
        if i in later:
            continue
        if held and chars + len(block.listed[i]) > SLICE_CHARS:
            ask()
            held, chars = [], 0
        held.append(i)
        chars += len(block.listed[i])
    if held:
        ask()
    return pa.Table.from_pylist(asked, _ASKED)


def dedup_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The input's rows, with the kept lines in the text column, and two more columns.

    A line, without white space at its ends, is removed if an equal line stands earlier: in a
    smaller id, or further up in the same text. If it has `least_chars` characters or more, an
    earlier line of `least_chars` or more that differs by one edit (a character added, dropped or
    replaced) removes it too, whether that one is kept or not; both texts are compared before. `_n_lines` counts the lines that are
    not blank, `_n_removed` those that went. Blank lines stay. Null texts stay null with no lines;
    a null id comes before all others; rows that repeat id and text are one document and get the
    same result each; different texts of one id are ordered by a hash; all other columns stay as
    they are; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    key = row_key_of(docs, id_col, text_col)
    n_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_blocks = max(1, math.ceil(n_bytes / BLOCK_TEXT))
    bits = max(0, math.ceil(math.log2(max(1, 5 * n_bytes / LINE_BYTES / JOIN_ROWS))))
    others = [c for c in docs.columns if c != text_col]
    dealt = docs.select(
        F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int").alias("_block"),
        docs[id_col].cast("long").alias("_id"),
        key.alias("_key"),
        text.alias("_text"),
        docs[text_col].isNull().alias("_null"),
        F.struct(*[docs[c] for c in others]).alias("_others"),
    )

    def ask(table: pa.Table) -> pa.Table:
        return _ask_lines(table, bits, least_chars)

    def ask_variants(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _ask_variants(table, answers, bits, least_chars)

    schema = T.StructType(
        [T.StructField("_others", dealt.schema["_others"].dataType), T.StructField("_text", T.StringType()),
         T.StructField("_n_lines", T.LongType()), T.StructField("_n_removed", T.LongType())]
    )

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            empty = pa.nulls(0, table.schema.field("_others").type)
            none = pa.nulls(0, pa.int64())
            return pa.table({"_others": empty, "_text": pa.nulls(0, pa.string()), "_n_lines": none, "_n_removed": none})
        block = _lines(table)
        gone = set(_told(answers, EQUAL).tolist()) | _verified(block, answers)
        kept, n_lines, n_removed = [None] * table.num_rows, [0] * table.num_rows, [0] * table.num_rows
        met: set[int] = set()
        for i in block.order:
            if block.twin_of[i] >= 0:
                continue
            lines, own = block.rows[i]
            stay = []
            for line, number in zip(lines, own, strict=True):
                if number < 0:
                    stay.append(line)
                    continue
                n_lines[i] += 1
                if number in gone or number in met:
                    n_removed[i] += 1
                else:
                    met.add(number)
                    stay.append(line)
            kept[i] = "\n".join(stay)
        for i, twin in enumerate(block.twin_of):
            if twin >= 0:
                kept[i], n_lines[i], n_removed[i] = kept[twin], n_lines[twin], n_removed[twin]
        kept = [None if null else k for k, null in zip(kept, table.column("_null").to_pylist(), strict=True)]
        return pa.table(
            {
                "_others": table.column("_others"), "_text": pa.array(kept, pa.string()),
                "_n_lines": pa.array(n_lines, pa.int64()), "_n_removed": pa.array(n_removed, pa.int64()),
            }
        )

    asked = dealt.groupBy("_block").applyInArrow(ask, ASKED)
    answered = asked.groupBy("part", "kind").applyInArrow(_compare, ANSWER)
    pairs = (
        dealt.groupBy("_block").cogroup(answered.groupBy("block")).applyInArrow(ask_variants, ASKED)
        .groupBy("part").applyInArrow(_pair_up, PAIRS)
    )
    earlier = dealt.groupBy("_block").cogroup(pairs.groupBy("block")).applyInArrow(_earlier, EARLIER)
    variants = earlier.select(F.explode("later").alias("later"), "text").select(
        "later.block", F.lit(VARIANT).alias("kind"), "later.at", "text"
    )
    equal = answered.filter(F.col("kind") == EQUAL).withColumn("text", F.lit(None).cast("string"))
    answers = equal.unionByName(variants)
    done = dealt.groupBy("_block").cogroup(answers.groupBy("block")).applyInArrow(finish, schema)
    columns = [F.col("_text").alias(c) if c == text_col else F.col("_others")[c].alias(c) for c in docs.columns]
    counts = [F.col(c).alias(unused(c, docs.columns)) for c in ("_n_lines", "_n_removed")]
    return done.select(*columns, *counts)


def digest(deduplicated: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the kept text) of every row of `dedup_lines`.

    A null text has no lines and the digest of an empty one; repeated rows come out each; no rows give none.
    """
    n_lines, n_removed = deduplicated.columns[-2:]
    return deduplicated.select(
        "doc_id",
        F.col(n_lines).alias("n_lines"),
        F.col(n_removed).alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
