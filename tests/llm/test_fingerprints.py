"""Content-defined chunks and the comparison with the next document."""

import hashlib
import random

import pytest

from sessiongrid.llm import fingerprints as fp
from sessiongrid.llm.queries import QUERIES


def gear_boundaries(raw: bytes) -> list[int]:
    """The rule byte by byte."""
    ends, start, h = [], 0, []
    x = 0
    for b in raw:
        x = (x * 2 + int(fp.GEAR[b])) % 2**32
        h.append(x)
    i = 0
    while i < len(raw):
        size = i + 1 - start
        mask = fp.STRICT if size < fp.NORMAL else fp.LOOSE
        if size >= fp.LEAST and (h[i] & mask == 0 or size >= fp.MOST) and i + 1 < len(raw):
            ends.append(i + 1)
            start = i + 1
        i += 1
    return [*ends, len(raw)] if raw else []


def test_boundaries_follow_the_rule(texts):
    rng = random.Random(4)
    some = [b"", b"a", b"a" * 1000, bytes(rng.randrange(256) for _ in range(5000))] + [t.encode() for t in list(texts.values())[:30]]
    for raw in some:
        assert fp.boundaries(raw) == gear_boundaries(raw)


def test_blocks_do_not_matter(monkeypatch, texts):
    raw = "".join(texts.values()).encode()
    want = fp.boundaries(raw)
    monkeypatch.setattr(fp, "BLOCK", 1000)
    assert fp.boundaries(raw) == want


def test_likeness():
    a = fp.chunks("the quick brown fox jumps over the lazy dog " * 3 + "".join(chr(97 + k * k % 26) for k in range(4000)))
    assert fp.likeness(a, a) == 1 and fp.likeness({}, {}) == 1 and fp.likeness(a, {}) == 0
    assert fp.likeness({1: 10, 2: 30}, {2: 30, 3: 70}) == pytest.approx(30 / 40)


def test_an_insertion_moves_few_chunks(texts):
    text = max(texts.values(), key=len)
    changed = text[:1000] + "inserted words " + text[1000:]
    assert fp.likeness(fp.chunks(text), fp.chunks(changed)) > 0.9


@pytest.mark.parametrize("rows", [[], [(7, "only text here")], [(3, "b" * 50), (1, None), (2, ""), (2, "zz"), (2, "zz"), (None, "null id"), (9, "é" * 70_001)]])
def test_next_document(spark, rows):
    got = fp.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ordered = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    by_range = [r for r in ordered if r[0] is None], [r for r in ordered if r[0] is not None]
    ordered = by_range[0] + by_range[1]
    want = []
    for (k, a), (_, b) in zip(ordered, ordered[1:] + ordered[:1]):
        e = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        want.append((k, len(a), hashlib.sha256(e.encode()).hexdigest(), fp.as_text(fp.chunks(a)), fp.as_text(fp.chunks(e)), fp.likeness(fp.chunks(a), fp.chunks(e)), fp.likeness(fp.chunks(a), fp.chunks(b))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_query(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in QUERIES["op7_fingerprints"](spark, sf_dir).collect()}
    ids = sorted(texts)
    assert sorted(got) == ids
    for k, after in zip(ids, ids[1:] + ids[:1]):
        a, b = texts[k], texts[after]
        e = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        assert got[k]["n_chars"] == len(a) and got[k]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert got[k]["near_next"] == fp.likeness(fp.chunks(a), fp.chunks(b))


def test_column_is_replaced(spark):
    df = spark.createDataFrame([("x", "old")], "text string, fingerprint string")
    assert fp.fingerprint_documents(df).first()["fingerprint"] == fp.as_text(fp.chunks("x"))
