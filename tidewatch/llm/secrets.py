"""Secret scans through a trigram inverted index, with DataFrame functions only.

Every rule's regular expression is turned into a Boolean query over trigrams that any match must
contain. Postings (trigram, document) are intersected by that query, and only the documents left
are searched with the expression. Rules without mandatory trigrams search every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as kind
from re import _parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import lower_ascii, row_key, texts
from tidewatch.sources.layers import settle


@dataclass(frozen=True)
class Rule:
    """A match counts if its `group` has `least` characters or more."""

    name: str
    pattern: str
    group: int
    least: int


#: The base rules, in the order in which ties of start are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)

#: Rules beyond the base: public forms of keys.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 27),
)

MOST_STRINGS = 64
MOST_CLASS = 8


def _crossed(left: set[str], right: set[str]) -> set[str] | None:
    return {a + b for a in left for b in right} if len(left) * len(right) <= MOST_STRINGS else None


def _exact(node) -> set[str] | None:
    """All strings that a parsed node can match, lower-cased, if they are few."""
    op, arg = node
    if op is kind.LITERAL:
        return {chr(arg).lower()}
    if op is kind.IN:
        chars = set()
        for inner, value in arg:
            if inner is kind.LITERAL:
                chars.add(chr(value).lower())
            elif inner is kind.RANGE and value[1] - value[0] < MOST_CLASS:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return chars if len(chars) <= MOST_CLASS else None
    if op is kind.SUBPATTERN:
        return _exact_sequence(arg[3])
    if op is kind.BRANCH:
        parts = [_exact_sequence(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is kind.MAX_REPEAT and arg[0] == 0 and arg[1] == 1:
        inner = _exact_sequence(arg[2])
        return None if inner is None else inner | {""}
    return None


def _exact_sequence(nodes) -> set[str] | None:
    strings: set[str] | None = {""}
    for node in nodes:
        own = _exact(node)
        strings = None if own is None or strings is None else _crossed(strings, own)
        if strings is None:
            return None
    return strings


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND of clauses; a clause is an OR of trigram sets, of which all trigrams must be present.

    An empty list says that the expression has no mandatory trigrams.
    """
    clauses: list[list[frozenset[str]]] = []

    def close(strings: set[str]) -> None:
        if all(len(s) >= 3 for s in strings):
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
            clauses.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))

    strings = {""}
    for node in _parser.parse(pattern):
        own = _exact(node)
        joined = _crossed(strings, own) if own is not None else None
        if joined is not None:
            strings = joined
            continue
        close(strings)
        strings = own if own is not None else {""}
    close(strings)
    return clauses


def trigram_postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, key): the inverted index of (key, text) for the trigrams that some query names."""
    lowered = lower_ascii(F.col("text"))
    found = F.array_compact(F.array(*[F.when(F.contains(F.col("lowered"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return rows.select("key", lowered.alias("lowered")).select(F.explode(found).alias("trigram"), "key")


def candidates(rows: DataFrame, rules: list[Rule]) -> DataFrame | None:
    """(key, rules): documents whose postings satisfy a rule's trigram query; rules without one are left out."""
    queries = {r.name: trigram_query(r.pattern) for r in rules}
    queries = {name: q for name, q in queries.items() if q}
    if not queries:
        return None
    trigrams = sorted({t for q in queries.values() for clause in q for s in clause for t in s})
    # One row per document; at most as many trigrams as the queries name.
    merged = trigram_postings(rows, trigrams).groupBy("key").agg(F.collect_set("trigram").alias("present"))

    def holds(query: list[list[frozenset[str]]]) -> Column:
        has = [
            reduce(Column.__or__, [reduce(Column.__and__, [F.array_contains("present", t) for t in sorted(s)]) for s in clause])
            for clause in query
        ]
        return reduce(Column.__and__, has)

    met = F.array_compact(F.array(*[F.when(holds(q), F.lit(name)) for name, q in queries.items()]))
    return merged.select("key", met.alias("rules")).filter(F.size("rules") > 0)


def _matches(rule: Rule, order: int) -> Column:
    """Matches in order: the characters between it and the one before, its length, its group's length."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    group = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    gaps = F.slice(F.split(text, rule.pattern, -1), 1, F.size(whole))
    return F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), group.alias("part")),
        lambda m, i: F.struct(
            F.lit(order).alias("kind"),
            i.alias("at"),
            F.char_length(m["gap"]).cast("long").alias("gap"),
            F.char_length(m["whole"]).cast("long").alias("n"),
            F.char_length(m["part"]).alias("part"),
        ),
    )


def _spans(found: DataFrame, rules: list[Rule]) -> DataFrame:
    """(key, kind, start, end_) of the matches that are long enough, in code points."""
    ordered = Window.partitionBy("key", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("kind") + 1)
    return (
        found.withColumn("end_", F.sum(F.col("gap") + F.col("n")).over(ordered))
        .filter(F.col("part") >= least)
        .select("key", "kind", (F.col("end_") - F.col("n")).alias("start"), "end_")
    )


def scan(
    docs: DataFrame, more: tuple[Rule, ...] = MORE_RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, secrets array<struct<start, kind, end_>> of every row, sorted by start, then rule.

    Positions are code points, ends exclusive. Matches of one rule are leftmost and do not overlap;
    those of different rules may. Null and empty texts have none; a null id stays null; rows that
    repeat id and text get the same spans each; other columns are ignored; an empty table gives no rows.
    """
    rules = [*BASE_RULES, *more]
    rows = texts(docs, id_col, text_col).withColumn("key", row_key())
    chosen = candidates(rows.select("key", "text"), rules)
    indexed = {r.name for r in rules if trigram_query(r.pattern)}
    full = [(i, r) for i, r in enumerate(rules) if r.name not in indexed]
    found = rows.select("key", F.inline(F.concat(*[_matches(r, i) for i, r in full]))) if full else None
    if chosen is not None:
        # Written first, so that the planner knows how few keys there are before it joins the texts.
        chosen = settle(chosen, "secret-candidates")
        searched = [
            F.when(F.array_contains("rules", r.name), _matches(r, i)) for i, r in enumerate(rules) if r.name in indexed
        ]
        texts_left = rows.select("key", "text").join(chosen, "key")
        verified = texts_left.select("key", F.explode(F.array_compact(F.array(*searched))).alias("m")).select(
            "key", F.inline("m")
        )
        found = verified if found is None else found.unionByName(verified)
    # Repeated rows find the same matches.
    spans = _spans(found.dropDuplicates(), rules)
    listed = spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end_"))).alias("secrets"))
    nothing = F.array().cast("array<struct<start:bigint,kind:int,end_:bigint>>")
    return (
        rows.select("doc_id", "key")
        .join(listed, "key", "left")
        .select("doc_id", F.coalesce("secrets", nothing).alias("secrets"))
    )


def digest(scanned: DataFrame, more: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    names = F.array(*[F.lit(r.name) for r in (*BASE_RULES, *more)])
    base = F.filter("secrets", lambda s: s["kind"] < len(BASE_RULES))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end_"].cast("string")
                ),
            ),
            ",",
        )

    def count(order: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == order)).cast("long")

    return scanned.select(
        "doc_id",
        *[count(i).alias(f"n_{r.name}") for i, r in enumerate(BASE_RULES)],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )

