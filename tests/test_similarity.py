"""Multi-probe search: order of the probes, recall, candidates that do not grow with the history."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.operators import nearest, similarity
from tidewatch.session import work_dir
from tidewatch.sources.layers import settle

FEATURES = list(config.FEATURES)


def history(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, len(FEATURES)))
    rows = centres[rng.integers(0, 40, n)] + 0.5 * rng.normal(size=(n, len(FEATURES)))
    schema = "row_key string, " + ", ".join(f"{c} double" for c in FEATURES)
    return settle(spark.createDataFrame([(f"r{i:06d}", *map(float, v)) for i, v in enumerate(rows)], schema), "history")


def test_probes_come_nearest_first(spark):
    v = [0.3, -1.2, 0.7] * 3
    df = spark.createDataFrame([(v,)], "q_z array<double>")
    own = similarity.lsh_buckets(df, 2, 5, 9, vector="q_z").first()["buckets"]
    probed = similarity.probe_buckets(df, 32, 2, 5, 9).first()["q_probes"]
    for bucket, probes, matrix in zip(own, probed, similarity.projections(2, 5, 9), strict=True):
        assert probes[0] == bucket and sorted(probes) == list(range(32))
        gap = (matrix @ np.array(v) / np.linalg.norm(matrix, axis=1)) ** 2
        far = [sum(gap[i] for i in range(5) if (p ^ bucket) >> i & 1) for p in probes]
        assert far == sorted(far)


def test_recall_and_candidates(spark):
    looked = []
    for n in (4_000, 16_000):
        rows = history(spark, n)
        asked = settle(rows.orderBy(F.md5("row_key")).limit(100), "asked")
        found = settle(similarity.multi_probe_similar(asked, rows, "row_key", n_tables=6, probes=8), "found")
        got = similarity.recall_against(found, similarity.exact_similar(asked, rows, "row_key")).first()
        assert got["queries"] == 100 and got["recall"] >= 0.9
        one = settle(similarity.multi_probe_similar(asked, rows, "row_key", n_tables=6, probes=1), "one")
        assert similarity.recall_against(one, similarity.exact_similar(asked, rows, "row_key")).first()["recall"] < got["recall"]
        pairs = found.groupBy("query_id", "row_key").count()
        assert pairs.filter("count > 1").isEmpty()
        looked.append(found.agg(F.avg("candidates")).first()[0])
    assert looked[1] < 2 * looked[0]


def test_pivots_give_the_exact_results_of_few_comparisons(spark):
    rows = history(spark, 20_000)
    repeated = settle(rows.unionByName(rows.limit(30).withColumn("row_key", F.concat(F.lit("again"), "row_key"))), "repeated")
    asked = settle(repeated.orderBy(F.md5("row_key")).limit(20), "asked")
    moments = similarity.feature_moments(repeated, FEATURES)
    z = similarity.standardize_features(repeated, FEATURES, moments)
    z_asked = similarity.standardize_features(asked.withColumnRenamed("row_key", "query_id"), FEATURES, moments, "q_z")
    index = similarity.pivot_index(z.select("row_key", "z"), "row_key")
    found, searched = similarity.exact_search(z_asked.select("query_id", "q_z"), index, "row_key", 5, len(FEATURES))

    keys, vectors = zip(*[(r["row_key"], r["z"]) for r in z.select("row_key", "z").collect()], strict=True)
    vectors = np.array(vectors)
    want = {}
    for r in z_asked.collect():
        far = np.linalg.norm(vectors - np.array(r["q_z"]), axis=1)
        want[r["query_id"]] = np.sort(far)[:5].round(5).tolist()
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(round(r["distance"], 5))
        assert abs(np.linalg.norm(vectors[keys.index(r["row_key"])] - vectors[keys.index(r["query_id"])]) - r["distance"]) < 1e-5
    assert got.keys() == want.keys()
    assert all(np.allclose(got[q], want[q], atol=2e-5) for q in want)
    compared = searched.agg(F.sum("n")).first()[0]
    assert 100 <= compared < 0.15 * 20 * len(keys)


def test_exact_search_of_small_tables(spark):
    rows = history(spark, 3)
    assert similarity.exact_similar(rows, rows, "row_key", k=5).count() == 9
    assert similarity.exact_similar(rows.limit(1), rows.filter("row_key = ''"), "row_key").count() == 0
    assert similarity.exact_similar(rows.filter("row_key = ''"), rows, "row_key").count() == 0
    same = rows.withColumns({c: F.lit(1.0) for c in FEATURES})
    assert {r["distance"] for r in similarity.exact_similar(same, same, "row_key", k=2).collect()} == {0.0}


@pytest.mark.parametrize("many", [False, True])
def test_blocks_of_a_bucket_give_the_pairs_nearest(spark, many):
    # Ties, repeated and null keys, infinite and missing values; a bucket of all rows in one table.
    def rows(n, step, bad):
        values = [[float((i * step + j) % 5) for j in range(3)] for i in range(n)]
        for i in bad:
            values[i][i % 3] = float("nan") if i % 2 else float("inf")
        return [(None if i % 17 == 0 else f"r{i % 40:02d}", v, [0, int(v[0]), int(v[1] + v[2])]) for i, v in enumerate(values) if np.isfinite(v).all()] + [
            (f"x{i}", values[i], [0, 9, 9]) for i in bad
        ]

    def long(data, names):
        df = spark.createDataFrame(data, f"{names[0]} string, {names[1]} array<double>, {names[2]} array<bigint>")
        return df.select("*", F.posexplode(names[2]).alias("table_id", "bucket"))

    index = long(rows(120, 7, [3, 8]), ("key", "z", "buckets")).withColumn("told", F.concat("key", F.lit("!")))
    asked = long([(f"q{i}", *r[1:]) for i, r in enumerate(rows(60, 3, [4, 5]))], ("query", "q_z", "q_buckets"))
    pairs = similarity.lsh_bucket_join(asked, index, "key").select(
        "query", "key", "told", similarity.round_half_up(similarity.euclidean(F.col("z"), F.col("q_z"), 3), 6).alias("distance")
    )
    blocks = similarity.bucket_nearest(asked, index, "query", "key", 4, 3, keep=("told",), many=many)
    # Pairs come as few rows: at most k per probe, table and salt.
    assert "Join" not in blocks._jdf.queryExecution().optimizedPlan().toString().replace("Join Cross", "")
    order = ["query", "rank"]
    shown = ["query", "key", "told", "distance", "rank"]
    expected, got = (
        [tuple(r) for r in similarity.topk_similar(p, "query", "key", 4).select(*shown).orderBy(*order).collect()]
        for p in (pairs, blocks)
    )
    assert expected and str(got) == str(expected)


def _all_pairs(z, q, k, limit):
    """The k nearest rows of each query, ties by place, of those within its limit."""
    found = []
    for one, most in zip(q, limit):
        distance = nearest.rounded_distance(z, np.repeat(one[None], len(z), axis=0))
        order = np.lexsort((np.arange(len(z)), distance))
        found.append([(int(i), float(distance[i])) for i in order if distance[i] <= most][:k])
    return found


@pytest.mark.parametrize("n, m, dims, k, steps, odd", [(1, 1, 2, 3, 0, 0), (90, 40, 2, 100, 1, 0), (900, 300, 9, 3, 0, 0), (900, 200, 3, 5, 1, 0), (700, 200, 3, 3, 1, 0.02)])
def test_cells_give_the_nearest_rows(n, m, dims, k, steps, odd):
    # Ties and equal rows, missing, infinite and huge values, and limits that leave fewer than k rows.
    rng = np.random.RandomState(3)
    z, q = rng.randn(n, dims), rng.randn(m, dims) * 2
    for rows in (z, q):
        if steps:
            rows[:] = rows.round(0)
        rows[rng.rand(*rows.shape) < odd] = rng.choice([np.nan, np.inf, 1e200, 1e12])
    for limit in (np.full(m, np.inf), np.where(rng.rand(m) < 0.5, np.inf, rng.rand(m).round(1) * 2)):
        with np.errstate(all="ignore"):
            distance, place = nearest.Nearest(z, k).search(q, limit)
            expected = _all_pairs(z, q, k, limit)
        assert [[(int(i), float(d)) for i, d in zip(p, e) if i < n] for p, e in zip(place, distance)] == expected


def test_cells_leave_out_most_pairs(monkeypatch):
    rng = np.random.RandomState(4)
    z, q = rng.randn(50000, 3), rng.randn(20000, 3)
    compared, matmul = [], np.matmul

    def counted(a, b):
        found = matmul(a, b)
        compared.append(found.size)
        return found

    rows = nearest.Nearest(z, 3)
    monkeypatch.setattr(np, "matmul", counted)
    rows.search(q, np.full(len(q), np.inf))
    assert 0 < sum(compared) < len(z) * len(q) / 20


def test_rounds_over_tables_give_the_nearest_of_all_pairs(spark, monkeypatch):
    # Slices of hot buckets and parts of large ones; ties, repeated and null keys, repeated queries, a query without mates.
    monkeypatch.setattr(similarity, "LEAST_QUERIES", 5)
    monkeypatch.setattr(similarity, "HELD_ROWS", 20)

    def rows(n, step):
        values = [[float((i * step + j) % 5) for j in range(3)] for i in range(n)]
        return [(None if i % 17 == 0 else f"r{(i * 7) % 41:02d}", v, [0, int(v[0]), int(v[1] + v[2])]) for i, v in enumerate(values)]

    def long(data, names):
        df = spark.createDataFrame(data, f"{names[0]} string, {names[1]} array<double>, {names[2]} array<bigint>")
        return df.select("*", F.posexplode(names[2]).alias("table_id", "bucket"))

    index = settle(long(rows(130, 7), ("key", "z", "buckets")).withColumn("told", F.concat("key", F.lit("!"))), "rows-of-buckets")
    queries = [(f"q{i}", *r[1:]) for i, r in enumerate(rows(60, 3))] + [("q1", [9.0, 9.0, float("nan")], [7, 9, 99])]
    asked = long(queries, ("query", "q_z", "q_buckets"))
    alone = spark.createDataFrame(queries, "query string, q_z array<double>, q_buckets array<bigint>")
    counts = similarity.bucket_counts(asked), similarity.bucket_counts(index)
    rounds = similarity.search_rounds(*counts, 2)
    assert max(r.parts for r in rounds) > 1 and any(r.slices for r in rounds) and {r.table for r in rounds} == {0, 1, 2}
    lists = similarity.nearest_lists(alone, index, "query", "key", 4, 3, 3, ("told",), *counts)
    assert lists.count() == len(queries)
    got = lists.select("query", F.posexplode("nearest").alias("at", "t")).select("query", "t.key", "t.told", "t.distance", (F.col("at") + 1).alias("rank"))
    pairs = similarity.lsh_bucket_join(asked, index, "key").select(
        "query", "key", "told", similarity.round_half_up(similarity.euclidean(F.col("z"), F.col("q_z"), 3), 6).alias("distance")
    )
    expected = similarity.topk_similar(pairs, "query", "key", 4).select("query", "key", "told", "distance", "rank")
    expected, got = ([tuple(r) for r in df.orderBy("query", "rank").collect()] for df in (expected, got))
    assert len(expected) == 60 * 4 and got == expected


def test_few_and_many_pairs_give_the_same_lists(spark):
    history = spark.range(400).select(
        F.col("id").cast("string").alias("row_key"), *[((F.col("id") * (i + 3)) % 13).cast("double").alias(c) for i, c in enumerate(config.FEATURES)]
    )
    moments = similarity.feature_moments(history)
    index = similarity.write_index(similarity.lsh_index(history, "row_key", moments, n_tables=3, n_bits=3), work_dir(spark, "index"))
    # Two queries of one id each keep their own list.
    queries = history.limit(80).select((F.col("row_key").cast("int") % 40).alias("query_id"), *config.FEATURES)
    both = [
        sorted(str(r) for r in similarity.lsh_lists(queries, index, moments, "row_key", k=5, n_tables=3, n_bits=3, few=few).collect())
        for few in (0, 1 << 26)
    ]
    assert both[0] == both[1] and len(both[0]) == 80
