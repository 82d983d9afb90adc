"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame functions only.

Every input partition is cut into runs of at most `RUN_ROWS` rows. A run holds one entry per distinct text: its
digest, the stronger digest and length that verify it, how often it stands there, and the identity
of the row that stays. In each round, groups of `FAN_IN` neighbouring runs are merged into one
(three binomial rounds at once), entry by entry, until one run is left. The answers then go
back down the same tree, run by run, to the rows. A text that a third of all rows share is thus one
entry per run, and no join key ever stands for more than `RUN_ROWS` rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.sources.layers import settle

#: Rows of a run at most, and so rows that can meet under one key.
RUN_ROWS = 16384

#: Runs merged into one in a round.
FAN_IN = 8

#: An entry is a text: a short digest to sort and deal by, a strong one and the length to verify it.
ENTRY = ["digest", "sha", "n_bytes"]


def _unchanged(text: Column) -> Column:
    return text


def _digests(docs: DataFrame, id_col: str, text_col: str, place: Column, normalize: Callable[[Column], Column]) -> DataFrame:
    """(place, doc_id, digest, sha, n_bytes) of every row, written once: all later steps read these, not the texts."""
    text = normalize(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(place.alias("place"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return settle(
        rows.select(
            "place",
            "doc_id",
            F.xxhash64("text").alias("digest"),
            F.unhex(F.sha2("text", 256)).alias("sha"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        ),
        "digests",
    )


def _merge(entries: DataFrame, purpose: str) -> DataFrame:
    """One entry per run and verified text, each run in digest order, written to the shared folder."""
    merged = entries.groupBy("run", *ENTRY).agg(F.min("stays").alias("stays"), F.sum("n").alias("n"))
    return settle(merged.sortWithinPartitions("run", *ENTRY), purpose)


def _answer(asked: DataFrame, told: DataFrame, to_run: Column) -> DataFrame:
    """`asked` with the answers of the run that theirs went into; entries without one stand alone."""
    names = {c: f"of_{c}" for c in ("run", *ENTRY)}
    same = to_run == F.col("of_run")
    for c in ENTRY:
        same = same & (F.col(c) == F.col(f"of_{c}"))
    return asked.join(told.withColumnsRenamed(names), same, "left").drop(*names.values())


def _resolve(rows: DataFrame, keep: str) -> DataFrame:
    """`rows` of `_digests` with `of_stays` and `of_n` of their text, null where it stands once."""
    last = rows.agg(F.max(F.shiftright("place", 33)), F.max(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))).first()
    parts, longest = (last[0] or 0) + 1, (last[1] or 0) + 1
    chunk = F.floor(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(RUN_ROWS)).cast("long")
    rows = rows.withColumn("run", chunk * F.lit(parts) + F.shiftright("place", 33))
    # Complement turns the order of longs around without overflow; null ids stay only among themselves.
    rank = F.col("doc_id") if keep == "smallest" else F.bitwise_not("doc_id")
    stays = F.struct(F.col("doc_id").isNull().alias("no_id"), rank.alias("rank"), F.col("place").alias("place"))
    levels = [_merge(rows.select("run", *ENTRY, stays.alias("stays"), F.lit(1).cast("long").alias("n")), "runs-0")]
    runs = parts * -(-longest // RUN_ROWS)
    upper = F.floor(F.col("run") / F.lit(FAN_IN)).cast("long")
    while runs > 1:
        runs = -(-runs // FAN_IN)
        levels.append(_merge(levels[-1].withColumn("run", upper), f"runs-{len(levels)}"))
    answers = ["of_stays", "of_n"]
    told = levels.pop().filter("n > 1").withColumnsRenamed({"stays": "of_stays", "n": "of_n"})
    while levels:
        asked = levels.pop().select("run", *ENTRY)
        told = _answer(asked, told, upper).filter("of_n is not null").select("run", *ENTRY, *answers)
    return _answer(rows, told, F.col("run"))


def _check(keep: str) -> None:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")


def groups(
    docs: DataFrame,
    keep: str = "smallest",
    normalize: Callable[[Column], Column] = _unchanged,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, one row out per row in.

    Texts are equal when `normalize` (a column expression; none by default) makes them identical, which
    a 64-bit digest, SHA-256 and the length verify at every merge. Of equal texts the row with the
    smallest or largest id stays; of rows that repeat the id too, the first by place in the input, so one
    row of each group is kept. A null text counts as empty; a null id loses to any other and, where a
    group has no other, stays as null. Other columns are ignored; an empty table gives no rows.
    """
    _check(keep)
    done = _resolve(_digests(docs, id_col, text_col, F.monotonically_increasing_id(), normalize), keep)
    alone = F.col("of_n").isNull()
    rank = F.col("of_stays.rank") if keep == "smallest" else F.bitwise_not("of_stays.rank")
    return done.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(rank).alias("keep_id"),
        F.coalesce("of_n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("of_stays.place") == F.col("place"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicate(
    docs: DataFrame,
    keep: str = "smallest",
    normalize: Callable[[Column], Column] = _unchanged,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows that `groups` keeps, with all columns as they were, whatever their names.

    The input is written once with each row's place, by which the rows that go are taken out, so repeated
    rows leave exactly one. Null and empty texts are one text; an empty table stays empty.
    """
    _check(keep)
    own = "place"
    while own in {c.lower() for c in docs.columns}:
        own += "_"
    placed = settle(docs.withColumn(own, F.monotonically_increasing_id()), "placed")
    done = _resolve(_digests(placed, id_col, text_col, F.col(own), normalize), keep)
    gone = done.filter(F.col("of_stays.place") != F.col("place")).select(F.col("place").alias(own))
    return placed.join(gone, own, "left_anti").select(*[f"`{c}`" for c in docs.columns])
