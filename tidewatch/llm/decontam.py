"""Benchmark decontamination on a distributed positional inverted index, with DataFrame functions only.

1. Count the test terms in the training documents. A window of a test item that holds a term no
   document has cannot occur; any other window is searched from its two rarest terms.
2. Store the postings (term, document, position) of those rarest terms. A posting proposes an
   alignment of the item with the document: the difference of both positions. Alignments that two
   rarest terms propose go on.
3. Intersect the position lists of all the item's terms, each shifted by its offset, at those
   alignments. Runs of consecutive terms as long as the window are exact occurrences.

All keys of the shuffles are (document, position), (document, item, shift) or terms counted
before the shuffle, so a frequent term or a passage shared by many documents spreads out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import lower_ascii, row_key, texts, unused
from tidewatch.sources.layers import settle

WINDOW = 10
#: Rarest words of a window that propose an alignment together.
ANCHORS = 2
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of digits, letters a-z and anything beyond ASCII."""
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS, -1), "")


def postings(rows: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(term, key, pos) of (key, text); `terms` (term) limits the index to what will be asked."""
    index = rows.select("key", F.posexplode(words_of(F.col("text"))).alias("pos", "term")).select("term", "key", "pos")
    return index if terms is None else index.join(terms, "term", "left_semi")


def _item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, q, term, length); items without id or words are absent, repeated rows count once."""
    rows = items.select(
        F.col(id_col).cast("string").alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).filter(F.col("item_id").isNotNull())
    rows = rows.dropDuplicates().select(row_key("item_id", "text").alias("item"), "item_id", words_of(F.col("text")).alias("w"))
    return rows.select("item", "item_id", F.size("w").alias("length"), F.posexplode("w").alias("q", "term"))


def occurrences(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = 0, id_col: str = "doc_id",
    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(key, item_id, first, last): stretches of a document where consecutive words of an item stand.

    A stretch has at least `window` words, or the whole item if that is shorter; `key` is
    `row_key` of the document. With `slack` above 0 these are proximity matches: each word may
    stand up to `slack` places from where the phrase's rarest word puts it, and the stretch is the
    exact one that is meant.
    """
    rows = texts(docs, id_col, text_col).select(row_key().alias("key"), "text")
    asked = settle(_item_words(items, item_id_col, item_text_col), "benchmark-words")
    terms = asked.select("term").distinct()
    known = settle(terms, "benchmark-terms")
    counts = postings(rows, known).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    asked = settle(
        asked.join(settle(counts, "term-counts"), "term", "left").withColumn("n", F.coalesce("n", F.lit(0))), "benchmark-counted"
    )

    # Every window's rarest words, found inside the item's own rows.
    ahead = Window.partitionBy("item").orderBy("q").rowsBetween(0, window - 1)
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("n", "q", "term")).over(ahead)), 1, ANCHORS)
    windows = asked.select("item", "q", "length", rarest.alias("rarest")).filter(
        (F.col("q") == 0) | (F.col("q") + window <= F.col("length"))
    )
    windows = windows.filter(F.col("rarest")[0]["n"] > 0)
    if slack:
        anchors = asked.filter("n > 0").select("item", F.col("q").alias("anchor"), "term", F.lit(1).alias("need"))
    else:
        anchors = windows.select("item", F.size("rarest").alias("need"), F.explode("rarest").alias("r"))
        anchors = anchors.groupBy("item", F.col("r.q").alias("anchor"), F.col("r.term").alias("term")).agg(
            F.min("need").alias("need")
        )
    anchors = settle(anchors, "benchmark-anchors")
    index = settle(postings(rows, anchors.select("term").distinct()), "postings")
    # An alignment needs as many anchors in their places as a window has; an item has few of them.
    met = index.join(anchors, "term").groupBy("key", "item", (F.col("pos") - F.col("anchor")).alias("shift")).agg(
        F.size(F.collect_set("anchor")).alias("met"), F.min("need").alias("need")
    )
    shifts = settle(met.filter(F.col("met") >= F.col("need")).select("key", "item", "shift"), "alignments")

    expected = shifts.join(asked.select("item", "item_id", "q", "length", "term"), "item")
    expected = expected.withColumn("pos", F.col("q") + F.col("shift"))
    if slack:
        expected = expected.withColumn("pos", F.explode(F.sequence(F.col("pos") - slack, F.col("pos") + slack)))
    there = postings(rows.join(shifts.select("key").distinct(), "key", "left_semi"), known).dropDuplicates()
    matched = expected.join(there, ["key", "pos", "term"]).select("key", "item", "item_id", "shift", "q", "length")
    if slack:
        matched = matched.dropDuplicates()
    run = F.col("q") - F.row_number().over(Window.partitionBy("key", "item", "shift").orderBy("q"))
    return (
        matched.withColumn("run", run)
        .groupBy("key", "item", "shift", "item_id", "run")
        .agg(F.min("q").alias("q0"), F.max("q").alias("q1"), F.max("length").alias("length"))
        .filter(F.col("q1") - F.col("q0") + 1 >= F.least(F.lit(window), F.col("length")))
        .select(
            "key", "item_id", (F.col("q0") + F.col("shift")).alias("first"), (F.col("q1") + F.col("shift")).alias("last")
        )
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row.

    Null and empty texts have no words and no hits; a null id stays null; rows that repeat id and
    text get the same result each; items without an id or a word are ignored; other columns are
    ignored; without documents there are no rows, and without items no hits.
    """
    found = settle(
        occurrences(docs, items, window, 0, id_col, text_col, item_id_col, item_text_col), "occurrences"
    )
    before = Window.partitionBy("key").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("last") - F.greatest(F.coalesce(F.max("last").over(before), F.lit(-1)), F.col("first") - 1)
    spots = found.select("key", "first", "last").dropDuplicates().withColumn("fresh", F.greatest(fresh, F.lit(0)))
    hit = spots.groupBy("key").agg(F.sum("fresh").cast("long").alias("n_hit"))
    named = found.groupBy("key").agg(F.collect_set("item_id").alias("items"))
    per_doc = hit.join(named, "key")
    rows = texts(docs, id_col, text_col).select(
        "doc_id", row_key().alias("key"), F.size(words_of(F.col("text"))).cast("long").alias("n_words")
    )
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(per_doc, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items_found), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any occurrence, all columns unchanged, whatever their names.

    Null and empty texts stay, as do repeated rows of a clean document; an empty table stays empty.
    """
    found = settle(occurrences(docs, items, window).select("key").distinct(), "contaminated")
    key = row_key_of(docs)
    name = unused("_found_key", docs.columns)
    return docs.join(found.withColumnRenamed("key", name), key == F.col(name), "left_anti")


def row_key_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """`row_key` on the columns of a table itself."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return F.xxhash64(F.coalesce(docs[id_col].cast("long").cast("string"), F.lit("null")), text)
