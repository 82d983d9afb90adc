"""The parts that the methods are named for."""

import random
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tidewatch.llm import grammar, graph, lines, pretokens, secrets, simhash, token_count


def test_whole_tokens_are_proven():
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    whole = token_count.prove_whole_tokens(vocabulary)
    assert len(whole) > 40_000 and " the" in whole
    counter = token_count.TokenCounter(vocabulary, frozenset(whole))
    assert all(counter.merged(w) == 1 for w in random.Random(1).sample(whole, 500))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t \x1c'abs1É!́", max_size=40))
def test_chunks_hold_whole_pretokens(text):
    import regex

    split = regex.compile(public_tokenizers.PATTERN).findall
    first, rest = pretokens.chunks(text)
    assert split(first) + [p for c in rest for p in split(" " + c)] == split(text)


def test_every_pair_within_the_budget_shares_a_chain():
    rng = np.random.default_rng(3)
    for budget in range(1, 8):
        keys = simhash.chain_keys(budget)
        a = rng.integers(0, 256, (2000, 8), dtype=np.uint8)
        bits = np.unpackbits(a, axis=1)
        for row in bits:
            row[rng.choice(64, budget, replace=False)] ^= 1
        b = np.packbits(bits, axis=1)
        assert (keys(a) == keys(b)).any(1).all()
        assert all(simhash._near(x, y[None], budget)[0] for x, y in zip(a, b, strict=True))


def test_links_join_what_all_pairs_join(spark):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 256, 8, dtype=np.uint8)
    prints = np.tile(centre, (400, 1))
    bits = np.unpackbits(prints, axis=1)
    for row in bits:
        row[rng.choice(64, rng.integers(0, 8), replace=False)] ^= 1
    prints = np.unique(np.packbits(bits, axis=1), axis=0)
    nodes = spark.createDataFrame([(i, bytes(p)) for i, p in enumerate(prints)], "node long, fp binary")
    old = simhash.BUCKET_ROWS
    try:
        for rows in (old, 40):
            simhash.BUCKET_ROWS = rows
            edges = simhash.links(nodes, 4)
            got = {r["node"]: r["root"] for r in graph.components(edges).collect()}
            number = [int.from_bytes(bytes(p), "big") for p in prints]
            want = brute.groups(list(range(len(prints))), lambda a, b: (number[a] ^ number[b]).bit_count() <= 4)
            assert {i: got.get(i, i) for i in want} == want
            assert edges.count() < len(prints) * 40
    finally:
        simhash.BUCKET_ROWS = old


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_rows_of_hot_fingerprints_and_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 16)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    copied, near = [word() for _ in range(300)], [word() for _ in range(300)]
    listed = [" ".join(copied)] * 90
    for _ in range(60):
        own = list(near)
        own[rng.randrange(300)] = word()
        listed.append(" ".join(own))
    listed += [" ".join(word() for _ in range(40)) for _ in range(30)]
    rng.shuffle(listed)
    texts = dict(enumerate(listed))
    want = brute.components(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()} == want
    assert {r["doc_id"] for r in simhash.deduplicate(docs).collect()} == set(want.values())


def test_chains_refuse_a_budget_without_equal_segments(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        simhash.near_duplicates(docs, 4, budget=8)


@pytest.mark.parametrize("kinds", [2, 5, 300])
def test_shards_expand_to_what_was_written(kinds):
    rng = np.random.default_rng(kinds)
    sizes = rng.integers(1, 60, 300)
    ids = rng.integers(0, kinds, sizes.sum())
    ids[rng.integers(0, len(ids), 500)] = grammar.END
    ends = np.cumsum(sizes)
    shard = grammar.read_shard(grammar.write_shard(ids, ends))
    for d in rng.permutation(300):
        assert (shard.document(d) == ids[ends[d] - sizes[d] : ends[d]]).all()
    assert len(shard.lengths) and len(shard.symbols) < len(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab", min_size=20, max_size=24), st.integers(0, 23), st.sampled_from(["cut", "put", "swap"]))
def test_lines_of_one_edit_share_a_variant(line, p, how):
    p = min(p, len(line) - 1)
    other = {"cut": line[:p] + line[p + 1 :], "put": line[:p] + "c" + line[p:], "swap": line[:p] + "c" + line[p + 1 :]}[how]

    def asked(a, b):
        shared = [i & 1 for i, x in enumerate(lines._halves(a)) if x in lines._halves(b)]
        return set(zip(*lines._variants(a, 0 in shared, 1 in shared), strict=True))

    mine, theirs = asked(line, other), asked(other, line)
    whole = {c for c, t in theirs if t == 0} & {c for c, t in mine if t} | {c for c, t in mine if t == 0} & {c for c, t in theirs if t}
    assert (mine & theirs) or whole
    assert brute.one_edit(line, other)


def test_trigram_queries():
    queries = {r.name: secrets.trigram_query(r.pattern) for r in (*secrets.BASE_RULES, *secrets.MORE_RULES)}
    assert queries["hex"] == [] and queries["access"] == [[frozenset({"aki", "kia"})]]
    assert frozenset({"tok", "oke", "ken"}) in queries["assign"][0]
    assert all(queries[name] for name in queries if name != "hex")


def test_native_plans(spark):
    docs = spark.createDataFrame([(1, "token = abcdefghijk")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "abcdefghijk")], "item_id long, text string")
    from tidewatch.llm import decontam

    for df in (secrets.digest(secrets.scan(docs)), decontam.contamination(docs, items)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_a_block_asks_twice_at_most_about_a_shared_half():
    import pyarrow as pa

    def table(block, lo, hi):
        texts = ["\n".join(f"price of the usual item, on day {i:06d}" for i in range(lo, hi)), "a line of its own that nobody has"]
        n = len(texts)
        return pa.table({"_id": [block * 10 + i for i in range(n)], "_key": list(range(n)), "_text": texts, "_block": [block] * n})

    tables = [table(b, 3000 * b, 3000 * (b + 1)) for b in range(3)]
    asked = pa.concat_tables([lines._ask_lines(t, 0, 20) for t in tables])
    halves = asked.filter(pa.compute.equal(asked["kind"], lines.HALF))
    hashes = np.concatenate([np.frombuffer(h, np.uint64) for h in halves["hashes"].to_pylist()])
    assert np.unique(hashes, return_counts=True)[1].max() <= 2 * len(tables)
    answers = lines._compare(halves)
    for t in tables:
        own = answers.filter(pa.compute.equal(answers["block"], t["_block"][0]))
        block = lines._lines(t)
        shared = lines._shared(block, lines._told(own, lines.HALF), 20)
        assert set(shared) == set(range(3000)) and all(s & 1 for s in shared.values())


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(9)
    phrases = [rng.integers(2, 5000, rng.integers(2, 30)) for _ in range(200)]
    docs = [np.concatenate([phrases[p] for p in rng.integers(0, 200, 12)] + [[7] * rng.integers(0, 40), [grammar.END]]) for _ in range(400)]
    ids, ends = np.concatenate(docs).astype(np.int64), np.cumsum(list(map(len, docs)))
    rules, lengths, symbols, at = grammar.compress(ids, ends)
    inside = np.setdiff1d(np.arange(len(symbols) - 1), at - 1)
    pairs, counts = np.unique(np.stack([symbols[inside], symbols[inside + 1]]), axis=1, return_counts=True)
    assert counts.max() < grammar.LEAST_COUNT
    assert len(symbols) + 2 * len(rules) < len(ids) / 7 and len(np.unique(rules, axis=0)) == len(rules)
    uses = np.bincount(np.concatenate([symbols, rules.ravel()]))[grammar.FIRST_RULE :]
    assert uses.min() >= 1 and lengths.min() >= 2
    shard = grammar.read_shard(grammar.write_shard(ids, ends))
    assert all((shard.document(d) == docs[d]).all() for d in range(400))


def test_tasks_of_a_worker_share_an_encoder(spark, tmp_path, monkeypatch):
    import pickle

    from pyspark import cloudpickle

    sent, made = [], []
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    init, send = grammar.ChunkEncoder.__init__, type(docs).mapInArrow
    monkeypatch.setattr(grammar.ChunkEncoder, "__init__", lambda self, path: made.append(path) or init(self, path))
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, fn, *a: sent.append(cloudpickle.dumps(fn)) or send(df, fn, *a))
    grammar.write_ids(docs, public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "shards"))
    made.clear()
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a b", ""]})
    first, second = (list(pickle.loads(sent[0])(iter([batch]))) for _ in range(2))
    assert first == second and first[0]["n_ids"].to_pylist() == [4] and len(made) <= 1


@pytest.mark.parametrize("words", [20, 250_000])
def test_words_split_together_have_the_ids_of_the_library(words, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(grammar, "CACHE_WORDS", words)
    monkeypatch.setattr(grammar, "CACHE_IDS", 20 * words)
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = grammar.ChunkEncoder(vocabulary), Tokenizer.from_file(vocabulary)
    some = "a B \u00c9 \u0130 \u023a \u0178 \u00df \u00aa \u00b2 \u00d7 \u02ff 1 23 0 . , - ' 's 'll <|endoftext|> the tion \u0301 \u03a3 \u65e5 \u042f \U0001f600"
    pieces = [*some.split(), *" \n\t\r\x0b\x85\xa0\xad\0", "  "]
    rng = np.random.default_rng(3)
    for _ in range(20):
        texts = ["", " ", *("".join(rng.choice(pieces, rng.integers(0, 30))) for _ in range(30))]
        ids, ends = encoder.encode(pa.array(texts))
        want = [[*library.encode(t, add_special_tokens=False).ids, grammar.END] for t in texts]
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == want


def test_a_shard_gives_all_documents_at_once():
    rng = np.random.default_rng(4)
    for kinds, n in ((3, 200), (3, 1), (50_000, 40)):
        sizes = rng.integers(1, 30, n)
        ids = rng.integers(0, kinds, sizes.sum())
        all_ids, own = grammar.read_shard(grammar.write_shard(ids, np.cumsum(sizes))).documents()
        assert (all_ids == ids).all() and (own == sizes).all()


def test_answers_of_a_part_do_not_slow_down_with_its_blocks():
    import time

    def seconds(n_blocks, n=200_000):
        rng = np.random.default_rng(n_blocks)
        row = np.sort(rng.integers(0, n_blocks, n))
        at = rng.integers(0, 1000, n).astype(np.int32)
        hit = rng.random(n) < 0.5
        rows = [{"block": b} for b in range(n_blocks)]
        start = time.process_time()
        table = lines._answer(rows, lines.EQUAL, at, row, hit)
        took = time.process_time() - start
        for own in rng.integers(0, table.num_rows, 20).tolist():
            b = table["block"][own].as_py()
            assert (np.frombuffer(table["at"][own].as_py(), np.int32) == np.unique(at[(row == b) & hit])).all()
        return took

    seconds(128)
    assert min(seconds(7500) for _ in range(3)) < 5 * min(seconds(128) for _ in range(3)) + 0.05


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab", max_size=7), st.text(alphabet="ab", max_size=7))
def test_one_edit_is_an_edit_distance(a, b):
    assert lines.within_one_edit(a, b) == (_distance(a, b) <= 1)


def test_a_line_goes_only_if_the_texts_are_one_edit_apart():
    import pyarrow as pa

    line = "a line of twenty characters or more"
    table = pa.table({"_block": [0], "_id": [1], "_key": [1], "_text": [line]})
    block = lines._lines(table)
    at = np.int32(0).tobytes()

    def gone(*texts):
        rows = [{"kind": lines.VARIANT, "at": at, "text": t} for t in texts]
        return lines._verified(block, pa.Table.from_pylist([*rows, {"kind": lines.EQUAL, "at": at, "text": None}]))

    # What shares a key by chance alone, and what does so beside a true neighbour.
    assert gone("another line with the same key", line[2:]) == set()
    assert gone("another line with the same key", line[1:]) == {0}


def test_pairs_name_the_earliest_line():
    import pyarrow as pa

    stem = "a line of twenty characters or more, number "
    tables = [
        pa.table({"_block": [b] * 2, "_id": [b, b + 10], "_key": [b, b + 10], "_text": [f"{stem}{b}", f"{stem}1{b}"]})
        for b in range(3)
    ]
    asked = []
    for t in tables:
        block = lines._lines(t)
        n = [len(s) for s in block.listed]
        hashes, places, of = lines._hashed(block.listed, np.zeros(2, np.int64), np.array(n))
        asked += lines._ask(block, lines.VARIANT, hashes, places, of, 0, of)
    pairs = lines._pair_up(pa.Table.from_pylist(asked, lines._ASKED))
    found = {}
    for b, t in enumerate(tables):
        own = pairs.filter(pa.compute.equal(pairs["block"], b))
        for row in lines._earlier(t, own).to_pylist():
            for later in row["later"]:
                number = int(np.frombuffer(later["at"], np.int32)[0])
                found[lines._lines(tables[later["block"]]).listed[number]] = row["text"]
    expected = {f"{stem}{x}": f"{stem}0" for x in ("1", "2", "10")} | {f"{stem}11": f"{stem}1", f"{stem}12": f"{stem}1"}
    assert found == expected
