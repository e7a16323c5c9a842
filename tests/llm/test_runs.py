"""Periodic runs against a search of every period, and the query against the contract word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from sessiongrid.llm import runs
from sessiongrid.llm.queries import QUERIES


def every_run(words: list, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """Each period in turn, from the smallest."""
    found, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def some_words(rng: random.Random) -> list[int]:
    words, letters = [], rng.choice([1, 2, 3, 8])
    for _ in range(rng.randrange(25)):
        if words and rng.random() < 0.5:
            a = rng.randrange(len(words))
            words += words[a : rng.randrange(a, len(words)) + 1] * rng.randrange(1, 7)
        else:
            words.append(rng.randrange(letters))
    return words[:250]


@pytest.mark.parametrize(("exponent", "least"), [(2, 2), (3, 1), (4, 6)])
def test_all_runs_are_found(exponent, least):
    rng = random.Random(exponent)
    for _ in range(700):
        words = some_words(rng)
        assert runs.find_runs(words, exponent, least) == every_run(words, exponent, least), words


def test_cut_off_words_hold_no_run():
    rng = random.Random(9)
    for _ in range(1500):
        words = some_words(rng) + [99] * rng.randrange(2) + some_words(rng)
        assert runs.runs_of(np.array(words, np.int64)) == every_run(words), words


def test_factors_are_the_longest_that_start_earlier():
    rng = random.Random(3)
    for _ in range(200):
        words = some_words(rng)[:60]
        end = 0
        for start, length, source in runs.factors(words):
            assert start == end
            end += length
            starts_before = lambda n, a=start: [s for s in range(a) if words[s : s + n] == words[a : a + n]]
            if source < 0:
                assert length == 1 and words[start] not in words[:start]
            else:
                assert source in starts_before(length) and (end == len(words) or not starts_before(length + 1))
        assert end == len(words)


def test_very_long_texts_take_linear_time():
    for words in ([k % 7 for k in range(200_000)], [k * k % 1009 for k in range(100_000)], [1] * 100_000):
        found = runs.find_runs(words)
        assert len(found) == 1 and found[0][:2] == (0, len(words))


DOC = "doc_id long, text string, runs int, Collapsed string"


def test_odd_rows(spark):
    rows = [(1, None, 1, "x"), (2, "", 1, "x"), (3, " \n", 1, "x"), (None, "a b " * 4 + "c", 1, "x"), (None, "a b " * 4 + "c", 1, "x"), (4, "x y z " * 6, 1, "x"), (5, "a a a a a", 1, "x")]
    got = [tuple(r) for r in runs.collapse_runs(spark.createDataFrame(rows, DOC)).collect()]
    ab = (None, "a b " * 4 + "c", [(0, 8, 2)], "a b c")
    want = [(1, None, [], ""), (2, "", [], ""), (3, " \n", [], ""), ab, ab, (4, "x y z " * 6, [(0, 6, 1)], "x y z"), (5, "a a a a a", [], "a a a a a")]
    assert got == want
    assert runs.collapse_runs(spark.createDataFrame([], DOC)).collect() == []


def by_contract(doc_id, text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = every_run(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    digests = sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))
    return doc_id, len(found), s, length, q, 1000 * length // q if found else None, *digests


def test_query(spark, sf_dir, texts):
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    some = sorted(texts, key=lambda k: (zlib.crc32(str(k).encode()) % 10, len(texts[k])))[:120]
    assert [got[k] for k in some] == [by_contract(k, texts[k]) for k in some]
    assert sum(got[k][1] > 0 for k in some) > 10


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(None, "a " * 9), (7, None), (30, ""), (30, "b c"), (12, "one"), (12, "one")] + [(k, " ".join(str(i % 9) for i in range(k))) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((by_contract(k, t) for k, t in rows), key=str)
