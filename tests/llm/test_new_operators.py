"""Token alignment, hard negatives and exact dedup: edge cases, small blocks, and what their methods promise."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_edges import frame, some_texts
from tidewatch.llm import align, exact, hard_negatives

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def odd_texts():
    spaces = {
        20: " leads", 21: "ends ", 22: "two  spaces", 23: "\n \n", 24: " ", 25: "x\n y\t z\n\n w", 26: "a ▁b", 27: "▁",
        28: "\x00 zero <0x41>", 29: "<s> </s> <unk>", 30: "no break 　 wide", 31: "é ́x", 32: "  thin", 33: "tab\t",
    }
    return some_texts() | spaces


@pytest.fixture(scope="module")
def texts():
    return odd_texts() | {40: ""}


@pytest.fixture(scope="module")
def docs(spark, texts):
    return frame(spark, [(i, None if i == 40 else t) for i, t in texts.items()]).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("doc_id = 123456")


@pytest.mark.parametrize("small", [False, True])
def test_alignment(docs, texts, small, monkeypatch):
    if small:
        monkeypatch.setattr(align, "BLOCK_TEXT", 3000)
        monkeypatch.setattr(align, "SEGMENT_PAIRS", 200)
    got = {r["doc_id"]: r for r in align.align(docs, *FILES).collect()}
    assert set(got) == set(texts)
    for i, (*numbers, said) in brute.alignment(texts).items():
        r = got[i]
        assert [r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]] == numbers, i
        if said is not None:
            assert r["groups_sha256"] == (brute.sha(said.encode()) if said else ""), i
    # A piece with U+2581 is not what the text has, so neither side has tokens there.
    assert got[27]["n_a"] == got[40]["n_a"] == 0 and got[24]["n_a"] > 0


def test_alignment_counts_repeated_rows(spark, empty):
    rows = [(1, "one word"), (1, "one word"), (2, "one other")]
    got = align.align(spark.createDataFrame(rows, "doc_id long, text string"), *FILES).orderBy("doc_id").collect()
    assert len(got) == 3 and got[0] == got[1]
    assert got[0]["count_sum"] == brute.alignment({1: "one word", 3: "one word", 2: "one other"})[1][5]
    assert align.align(empty, *FILES).count() == 0


@pytest.mark.parametrize("small", [False, True])
def test_exact_dedup(spark, docs, texts, small, monkeypatch):
    if small:
        monkeypatch.setattr(exact, "RUN_ROWS", 2)
        monkeypatch.setattr(exact, "FAN_IN", 2)
    rows = [(i, None if i == 40 else t) for i, t in texts.items()]
    rows += [(i + 100, "hot") for i in range(40)] + [(100, "hot"), (None, "hot"), (None, "lone"), (None, "lone"), (7, "A"), (8, "a")]
    many = frame(spark, rows).repartition(7)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    pick = {"largest": max, "smallest": min}
    for keep, choose in pick.items():
        got = exact.groups(many, keep).collect()
        assert sorted((r["text_sha256"], r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted(
            (brute.sha((t or "").encode()), i is None, i or 0) for i, t in rows
        )
        for text, ids in groups.items():
            own = [r for r in got if r["text_sha256"] == brute.sha(text.encode())]
            want = choose([i for i in ids if i is not None], default=None)
            assert {(r["keep_id"], r["group_size"]) for r in own} == {(want, len(ids))}
            assert [r["doc_id"] for r in own if r["kept"]] == [want]
    kept = exact.deduplicate(many.withColumn("place", F.lit("x")), "largest")
    assert kept.columns == [*many.columns, "place"]
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(groups)
    folded = exact.deduplicate(many, normalize=lambda text: F.lower(text)).filter("lower(text) = 'a'").collect()
    assert [r["doc_id"] for r in folded] == [7]


def test_exact_dedup_of_nothing(empty):
    assert exact.groups(empty).count() == 0
    assert exact.deduplicate(empty).columns == empty.columns
    with pytest.raises(ValueError):
        exact.groups(empty, keep="any")


def mined(rows, every=100, k=5):
    """Every score of every anchor, sorted."""
    whole = []
    for place, (i, label, vector) in enumerate(rows):
        if None in (i, label, vector) or any(x is None or not math.isfinite(x) or abs(x * 256) >= 1 << 26 for x in vector):
            continue
        whole.append((place, i, label, [math.floor(x * 256) for x in vector]))
    out = []
    for place, i, label, v in whole:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, own, other) for own, j, other, w in whole if own != place)
        for score, positive, *_ in [s for s in scored if s[3] == label][:k]:
            wanted = [s for s in scored if s[3] != label and 80 * -score <= 100 * -s[0] <= 100 * -score][:k]
            out += [(i, positive, rank, s[1], -score, -s[0]) for rank, s in enumerate(wanted, 1)]
    return sorted(out)


SCHEMA = "vec_id long, label int, embedding array<float>, place string, slab string, block int"


def vectors(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dims)
    return [(i, int(rng.integers(4)), [float(np.float32(x)) for x in centre + spread * rng.normal(size=dims)]) for i in range(n)]


def check_mining(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", "x", 1) for r in rows], SCHEMA).repartition(3)
    assert sorted(map(tuple, hard_negatives.mine(df, **more).collect())) == mined(rows, more.get("every", 100))


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, small, monkeypatch):
    if small:
        for name, value in (("LEAF", 4), ("FAN", 2), ("SLAB_ROWS", 60), ("ANCHORS", 3)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(400, 6, 1)
    odd = [(None, 1, [1.0]), (500, None, [1.0]), (501, 1, None), (502, 1, [None, 1.0]), (503, 1, [math.inf]), (504, 1, [math.nan]),
           (600, 2, []), (700, 3, [2.0]), (-100, 0, [0.5] * 9), (800, 1, [3e38]), (200, 1, [0.25, 0.5, 0.25])]
    hot = [(1000 + i, i % 5, [0.5] * 6) for i in range(150)]
    check_mining(spark, rows + odd + hot + [(1000, 0, [0.5] * 6), (1000, 0, [0.5] * 6)], every=50)


def test_hard_negatives_beyond_doubles(spark):
    near = lambda x: float(np.float32(min(max(x * 60_000, -260_000.0), 260_000.0)))
    rows = [(i, label, [near(x) for x in v]) for i, label, v in vectors(60, 8, 2)]
    check_mining(spark, rows, every=10)


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(df).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(100, 1, [1.0], "x", "x", 1)], SCHEMA)).count() == 0


def test_boxes_are_left_out():
    """Anchors near one of many clusters open a small part of the leaves, and still find what a full scan finds."""
    rng = random.Random(3)
    centres = np.array([[math.cos(t), math.sin(t), 0.1 * t] for t in np.linspace(0, 6, 64)])
    points = np.concatenate([c + 0.02 * np.random.default_rng(i).normal(size=(256, 3)) for i, c in enumerate(centres)])
    points = np.floor(points * 256)
    order = np.concatenate(list(hard_negatives.tiled(np.arange(len(points)), points, [0, 1, 2])))
    assert sorted(order.tolist()) == list(range(len(points)))
    opened = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                opened.append(key)
            return np.asarray(super().__getitem__(key))

    ids = np.arange(len(points))
    tree = hard_negatives.Tree(ids, ids % 3, ids, points[order])
    tree.vectors = points[order].view(Counted)
    for i in rng.sample(range(len(points)), 20):
        got = tree.search(points[order][i], i % 3, i, True, [(-math.inf, math.inf)], 5)[0]
        scores = points[order] @ points[order][i]
        want = sorted((-int(s), j, j) for j, s in enumerate(scores) if j % 3 == i % 3 and j != i)[:5]
        assert got == want
    assert len(opened) < 0.25 * 20 * len(points) / hard_negatives.LEAF
