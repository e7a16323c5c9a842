"""Repeated substrings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sessiongrid.llm import suffixes
from sessiongrid.llm.queries import QUERIES


def brute(rows, w):
    seen = Counter(t[i : i + w] for _, t in rows for i in range(len(t) - w + 1))
    out = []
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - w + 1):
            if seen[t[i : i + w]] > 1:
                gone[i : i + w] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((d, len(t), int(gone.sum()), int((np.diff(np.append(False, gone).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def random_rows():
    rng = random.Random(3)
    passage = "".join(rng.choice("abc") for _ in range(300))
    rows = []
    for i in range(90):
        t = "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 200)))
        if i % 3 == 0:
            a = rng.randint(0, 200)
            t = t[:50] + passage[a : a + rng.randint(20, 100)] + t[50:]
        rows.append((i, "x" * rng.randint(0, 90) + t if i % 7 == 0 else t))
    return rows + [(200, None), (201, ""), (202, rows[3][1]), (202, rows[3][1]), (203, rows[5][1]), (203, "zz"), (None, rows[7][1])]


@pytest.mark.parametrize("window, gram, partitions", [(20, 8, 4), (30, 16, 23)])
def test_random_texts(spark, window, gram, partitions):
    rows = random_rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)  # many buckets: grams lie across boundaries
    try:
        got = sorted(map(tuple, suffixes.report(spark.createDataFrame(rows, "doc_id long, text string"), window, gram).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute([(d, (t or "").encode()) for d, t in rows], window)


def test_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(1)
    unit = "".join(rng.choice("abcdefgh") for _ in range(30_000))
    rows = [(1, unit + "#" + unit[500:9000]), (2, "y" * 70_000)]
    got = sorted(map(tuple, suffixes.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == brute([(d, t.encode()) for d, t in rows], 200)


def test_empty(spark):
    assert suffixes.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_on_the_smallest_table(spark, sf_dir, texts):
    got = sorted(map(tuple, QUERIES["op4_suffix_dedup"](spark, sf_dir).collect()), key=str)
    assert got == brute([(d, t.encode()) for d, t in texts.items()], 200)


def test_multikey_quicksort_finds_equal_windows():
    rng = np.random.default_rng(2)
    buf = rng.integers(97, 99, 4000).astype(np.uint8)
    at = np.arange(0, 3900)
    group = at % 3
    got = suffixes.equal_windows(suffixes._words(buf), at, group, 13)
    keys = [(int(g), buf[a : a + 13].tobytes()) for a, g in zip(at, group)]
    n = Counter(keys)
    classes = {}
    for k, c in zip(keys, got.tolist()):
        assert (c >= 0) == (n[k] > 1)
        if c >= 0:
            assert classes.setdefault(k, c) == c
    assert len(set(classes.values())) == len(classes)


def test_texts_without_an_id_whose_hashes_agree_in_24_bits(spark):
    import xxhash

    base, seen, pair = "".join(random.Random(8).choice("abcdefgh") for _ in range(60)), {}, None
    for k in range(1 << 17):  # collisions are likely from some thousands on
        text = f"{k:06d}" + (base if k % 2 else "")
        low = xxhash.xxh64_intdigest(text.encode(), 42) & ((1 << 24) - 1)
        if len(seen.get(low, text)) != len(text):
            pair = seen[low], text
            break
        seen[low] = text
    rows = [(None, pair[0]), (None, pair[1]), (1, base + "#")]
    got = sorted(map(tuple, suffixes.report(spark.createDataFrame(rows, "doc_id long, text string"), 20, 8).collect()), key=str)
    assert got == brute([(d, t.encode()) for d, t in rows], 20)
