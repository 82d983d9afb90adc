"""The registered queries against brute force; tests/test_queries.py compares those that have SQL with it."""

import zlib

import pyarrow.parquet as pq
import pytest

from tests.conftest import SMALL
from tests.llm import brute
from tidewatch.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def texts_of(folder):
    return {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()}


@pytest.fixture(scope="module")
def texts():
    return texts_of(SMALL)


def rows(spark, name, folder=SMALL):
    return {r["doc_id"]: r for r in QUERIES[name](spark, folder).collect()}


def test_token_counts(spark, texts):
    got = rows(spark, "op1_token_counts")
    want = brute.token_counts(texts)
    assert {i: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for i, r in got.items()} == {
        i: (len(texts[i].encode()), n, n > 512) for i, n in want.items()
    }


def test_bpe_round_trip(spark, texts):
    got = rows(spark, "op2_bpe_round_trip")
    for i, ids in brute.encoded(texts).items():
        r = got.pop(i)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.sha(",".join(map(str, ids)).encode())
        assert r["decoded_sha256"] == brute.sha(texts[i].encode())
    assert not got


def test_substrings(spark, texts):
    got = rows(spark, "op3_substring_dedup")
    want = brute.substrings(texts)
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == {
        i: (n, gone, brute.sha(kept)) for i, (n, gone, kept) in want.items()
    }
    assert sum(w[1] for w in want.values())


def test_lines(spark, texts):
    got = rows(spark, "op4_line_dedup")
    assert {i: (r["n_lines"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == {
        i: (n, gone, brute.sha(kept.encode())) for i, (n, gone, kept) in brute.lines(texts).items()
    }


def test_simhash(spark, texts):
    got = rows(spark, "op5_simhash")
    assert {i: r["fingerprint"] for i, r in got.items()} == {
        i: f"{brute.fingerprint(t):016x}" for i, t in texts.items()
    }
    assert {i: r["component_id"] for i, r in got.items()} == brute.components(texts)


def test_token_shards(spark, texts):
    got = rows(spark, "op6_token_shards")
    assert {i: (r["start"], r["n_tokens"], r["ids_crc32"]) for i, r in got.items()} == brute.shards(texts)


@pytest.fixture(scope="module")
def labels():
    return {r["doc_id"]: r["quality"] for r in pq.read_table(f"{MEDIUM}/labels.parquet").to_pylist()}


def test_classifier_on_held_out_rows(spark, labels):
    got = rows(spark, "op7_quality_classifier", MEDIUM)
    assert set(got) == set(texts_of(MEDIUM))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    held = [i for i in labels if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == labels[i] for i in held) >= 0.95 * len(held)


def test_rules(spark, labels):
    got = rows(spark, "op8_quality_rules", MEDIUM)
    for i, text in texts_of(MEDIUM).items():
        r = got[i]
        want = brute.rule_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 4 == 2 and not got[i]["base_failed"]]
    assert sum(got[i]["kept"] == labels[i] for i in held) >= 0.95 * len(held)


def test_secrets(spark, texts):
    got = rows(spark, "op10_secret_scan")
    for i, text in texts.items():
        counts, spans = brute.secrets(text)
        r = got[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts
        assert r["base_sha256"] == brute.sha(spans.encode())
        assert set(spans.split(",")) <= set(r["spans"].split(","))


def test_token_alignment(spark, texts):
    got = rows(spark, "op11_token_alignment")
    assert set(got) == set(texts)
    for i, (*numbers, said) in brute.alignment(texts).items():
        r = got[i]
        assert [r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]] == numbers
        if said is not None:
            assert r["groups_sha256"] == (brute.sha(said.encode()) if said else "")


def test_exact_dedup(spark, texts):
    got = rows(spark, "op13_exact_dedup")
    for i, keep_id, size, kept, digest in brute.exact(list(texts.items())):
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (keep_id, size, kept, digest)
