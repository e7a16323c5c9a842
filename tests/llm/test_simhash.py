"""SimHash fingerprints, the trie self-join and components against brute force."""

import random
import re

import numpy as np
import pytest

from sessiongrid.llm import simhash
from sessiongrid.llm.queries import QUERIES


def slow_fingerprint(text, words=4):
    import xxhash

    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", raw) if x]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + words]), 42) for i in range(max(1, len(w) - words + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def brute_components(fps, bits):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def clustered(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 12)] + [0, 2**64 - 1]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("text", ["", " \t\n", "one", "One two\x0bTHREE", "É é É é É", "a b c d e f g a b c d", "x " * 700])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)
    assert simhash.fingerprint(text, 5) == slow_fingerprint(text, 5)


def test_spark_hashes_alike(spark):
    from pyspark.sql import functions as F

    import xxhash

    got = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("bits", [0, 2, 4])
def test_trie_walk_finds_all_links(bits):
    fps = clustered(400, bits)
    x = np.array(fps, np.uint64)
    n = len(x)
    found = simhash.trie_links(x, np.array([n]), np.zeros(n, bool), np.zeros(n, bool), bits)
    assert all(bin(int(a) ^ int(b)).count("1") <= bits for a, b in found.T)
    at = {f: k for k, f in enumerate(fps)}
    parent = list(range(n))
    for _ in range(n):
        for a, b in found.T.tolist():
            i, j = at[a], at[b]
            parent[i] = parent[j] = min(parent[i], parent[j])
    want = brute_components(fps, bits)
    assert parent == want
    left = np.array([f % 3 == 0 for f in fps])
    across = simhash.trie_links(x, np.array([n]), left, np.ones(n, bool), bits)
    assert all((a % 3 == 0) != (b % 3 == 0) for a, b in across.T.tolist())


@pytest.mark.parametrize("chunk", [2048, 7])
def test_distributed_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    fps = clustered(300, 9)
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long").repartition(5)
    roots = {r["node"] % 2**64: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    own = lambda f: roots.get(f, f - 2**64 if f >> 63 else f)
    groups, found = {}, {}
    for f, c in zip(fps, brute_components(fps, 4)):
        groups.setdefault(c, set()).add(f)
        found.setdefault(own(f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_long_chains(spark):
    df = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(df).collect()}
    assert {roots[k] for k in range(1, 61)} == {0} and roots[101] == 100


def test_odd_documents(spark):
    rows = [(5, "same words here now ok"), (3, "same words here now ok"), (3, "same words here now ok"), (9, None), (8, ""), (7, " \n"), (None, "lonely text of null id"), (2, "z " * 40_000)]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, fp string")
    got = sorted((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect() if r["doc_id"] is not None)
    assert got == [(2, 2), (3, 3), (3, 3), (5, 3), (7, 7), (8, 7), (9, 7)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_query(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in QUERIES["op8_simhash"](spark, sf_dir).collect()}
    ids = sorted(texts)
    fps = [slow_fingerprint(texts[k]) for k in ids]
    assert [got[k]["fingerprint"] for k in ids] == [f"{f:016x}" for f in fps]
    assert [got[k]["component_id"] for k in ids] == [ids[c] for c in brute_components(fps, 4)]
