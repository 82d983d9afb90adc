"""The plainest statement of each operator's result, on Python dictionaries {doc_id: text}."""

from __future__ import annotations

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\r\x0b\x0c"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def in_order(texts: dict):
    return sorted(texts, key=lambda i: (i is not None, i))


def token_counts(texts: dict) -> dict:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def multi_encoding():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts: dict) -> dict:
    encoding = multi_encoding()
    return {i: encoding.encode_ordinary(t) for i, t in texts.items()}


def substrings(texts: dict, length: int = 20) -> dict:
    """id -> (n_words, n_removed, kept)."""
    first, out = {}, {}
    for i in in_order(texts):
        words = WORD.findall(texts[i].encode())
        gone = [False] * len(words)
        for p in range(len(words) - length + 1):
            if first.setdefault(tuple(words[p : p + length]), (i, p)) != (i, p):
                gone[p : p + length] = [True] * length
        out[i] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return out


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a[p + (len(a) >= len(b)) :] == b[p + (len(b) >= len(a)) :]


def lines(texts: dict, least: int = 20) -> dict:
    """id -> (n_lines, n_removed, kept text); every pair of lines is compared."""
    seen: list[str] = []
    out = {}
    for i in in_order(texts):
        kept, n, removed = [], 0, 0
        for raw in texts[i].split("\n"):
            line = raw.strip(SPACE)
            if not line:
                kept.append(raw)
                continue
            n += 1
            gone = line in seen or (
                len(line) >= least and any(len(s) >= least and one_edit(s, line) for s in seen if abs(len(s) - len(line)) < 2)
            )
            removed += gone
            if not gone:
                kept.append(raw)
            seen.append(line)
        out[i] = (n, removed, "\n".join(kept))
    return out


def fingerprint(text: str, shingle: int = 4) -> int:
    words = WORD.findall(text.translate(UPPER).encode())
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids: list, linked) -> dict:
    """id -> smallest id reachable, comparing every pair."""
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = in_order(dict.fromkeys(ids))
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if linked(a, b):
                p, q = top(a), top(b)
                if p != q:
                    low, high = in_order({p: 0, q: 0})
                    parent[high] = low
    return {i: top(i) for i in ids}


def components(texts: dict, bits: int = 4) -> dict:
    prints = {i: fingerprint(t) for i, t in texts.items()}
    return groups(list(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= bits)


def shards(texts: dict) -> dict:
    """id -> (start, n_tokens, crc32)."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, out = 0, {}
    for i in in_order(texts):
        ids = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 1]
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def rule_counts(text: str) -> tuple:
    words = WORD.findall(text.encode())
    places = collections.defaultdict(list)
    for p in range(len(words) - 7):
        places[tuple(words[p : p + 8])].append(p)
    covered = {q for at in places.values() if len(at) > 1 for p in at for q in range(p, p + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            again += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), again, len(covered)


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(texts: dict, items: list[tuple], window: int = 10) -> dict:
    """id -> (n_words, n_hit, sorted item ids as strings)."""
    asked = collections.defaultdict(set)
    for item, text in items:
        words = ITEM_WORD.findall((text or "").translate(UPPER))
        if item is None or not words:
            continue
        size = min(window, len(words))
        for p in range(len(words) - size + 1):
            asked[tuple(words[p : p + size])].add(str(item))
    sizes = {len(k) for k in asked}
    out = {}
    for i, text in texts.items():
        words = ITEM_WORD.findall(text.translate(UPPER))
        hit, found = set(), set()
        for size in sizes:
            for p in range(len(words) - size + 1):
                if names := asked.get(tuple(words[p : p + size])):
                    found |= names
                    hit |= set(range(p, p + size))
        out[i] = (len(words), len(hit), sorted(found))
    return out


#: The base rules of the contract, written anew.
SECRETS = [
    (
        "assign",
        re.compile(
            r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
            r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        ),
        lambda m: len(m[2]) >= 8,
    ),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def secrets(text: str) -> tuple:
    """Counts by kind and the spans."""
    spans, counts = [], []
    for kind, (name, pattern, enough) in enumerate(SECRETS):
        own = [(m.start(), kind, m.end(), name) for m in pattern.finditer(text) if enough(m)]
        spans += own
        counts.append(len(own))
    return counts, ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(spans))


def alignment(texts: dict) -> dict:
    """id -> (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), from every pair of tokens that overlap."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def spans(pieces):
        ends = np.cumsum([len(p) for p in pieces]).tolist()
        return list(zip([0, *ends[:-1]], ends, strict=True)) if pieces else []

    def piece_bytes(i):
        if second.is_byte(i):
            return bytes([int(second.id_to_piece(i)[3:5], 16)])
        return b"" if second.is_control(i) or second.is_unknown(i) else second.id_to_piece(i).replace("\u2581", " ").encode()

    found, linked = {}, collections.Counter()
    for i, text in texts.items():
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in first.id_to_token(x)) for x in a]
        bytes_b = [piece_bytes(x) for x in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        at_a, at_b = spans(bytes_a), spans(bytes_b)
        cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
        links, j = [], 0
        for x, (start, end) in zip(a, at_a, strict=True):
            while at_b[j][1] <= start:
                j += 1
            k = j
            while k < len(at_b) and at_b[k][0] < end:
                links.append((x, b[k]))
                k += 1
        said, start = [], 0
        inside = lambda ids, at, s, e: ",".join(str(x) for x, (_, stop) in zip(ids, at, strict=True) if s < stop <= e)
        if len(cuts) < 3000:
            for end in cuts:
                said.append(inside(a, at_a, start, end) + "|" + inside(b, at_b, start, end))
                start = end
        linked.update(set(links))
        found[i] = (len(a), len(b), len(cuts), links, ";".join(said) if len(cuts) < 3000 else None)
    most = collections.defaultdict(int)
    for (x, _), n in linked.items():
        most[x] = max(most[x], n)
    return {
        i: (n_a, n_b, n_cuts, len(links), sum(linked[p] == most[p[0]] for p in links), sum(linked[p] for p in links), said)
        for i, (n_a, n_b, n_cuts, links, said) in found.items()
    }


def exact(texts: list) -> list:
    """(id, text) in input order -> (id, keep_id, group_size, kept, sha) of each; the largest id stays."""
    groups = collections.defaultdict(list)
    for place, (i, text) in enumerate(texts):
        groups[text or ""].append((i is not None, i or 0, -place, i))
    out = []
    for place, (i, text) in enumerate(texts):
        stays = max(groups[text or ""])
        out.append((i, stays[3], len(groups[text or ""]), -stays[2] == place, sha((text or "").encode())))
    return out
