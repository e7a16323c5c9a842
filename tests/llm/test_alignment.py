"""Alignment of tokens against sets of byte offsets and pairs that are all written out."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sessiongrid.llm import alignment
from sessiongrid.llm.queries import QUERIES, tokenizer_path

A_PATH, B_PATH = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
DOC = "doc_id long, text string"


@pytest.fixture(scope="module")
def slow():
    """(doc_id, text) rows -> rows of the contract, by the libraries' tokenizers."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a_model.encode_special_tokens = True
    vocab = json.load(open(A_PATH))["model"]["vocab"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    a_bytes = {i: bytes(byte[c] for c in t) for t, i in vocab.items() if all(c in byte for c in t)}

    def piece(i: int) -> bytes:
        p = b_model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()

    def one(text):
        if not text:
            return [], []
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        raw = (" " + text).encode()
        return (a, b) if b"".join(a_bytes[i] for i in a) == raw == b"".join(map(piece, b)) else ([], [])

    def spans(ids, length):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(length(i))))
            at = out[-1][2]
        return out

    def rows(docs):
        made, counts = [], Counter()
        for doc_id, text in docs:
            a, b = one(text)
            a, b = spans(a, a_bytes.__getitem__), spans(b, piece)
            ends = sorted({e for *_, e in a} & {e for *_, e in b})
            found = [([], []) for _ in ends]
            for side, tokens in enumerate((a, b)):
                for i, _, e in tokens:
                    found[bisect.bisect_left(ends, e)][side].append(i)
            links = [(x, y) for left, right in found for x in left for y in right]
            counts.update(set(links))
            made.append((doc_id, len(a), len(b), found, links))
        best = {}
        for (x, _), n in counts.items():
            best[x] = max(best.get(x, 0), n)
        text = lambda found: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)
        return [
            (k, n_a, n_b, len(found), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text(found).encode()).hexdigest() if n_a else "")
            for k, n_a, n_b, found, links in made
        ]

    return rows


def test_components_are_those_of_a_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 40)
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randrange(50))]
        want = list(range(n))
        for _ in range(n):
            for i, j in edges:
                want[i] = want[j] = min(want[i], want[j])
        left, right = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
        assert alignment.components(n, left, right).tolist() == want


def test_a_chain_is_one_component():
    n = 100_000
    assert not alignment.components(n, np.arange(n - 1)[::-1], np.arange(1, n)[::-1]).any()


@pytest.mark.parametrize("block", [1, 7, 1 << 21])
def test_links_in_blocks(monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rng = np.random.default_rng(1)
    a_group, b_group = np.sort(rng.integers(0, 9, 60)), np.sort(rng.integers(0, 9, 50))
    a, b, doc = rng.integers(0, 5, 60), rng.integers(0, 4, 50), np.arange(9) // 3
    want = Counter((int(doc[g]), int(x), int(y)) for g, x in zip(a_group, a) for h, y in zip(b_group, b) if g == h)
    held, pair, n = alignment.links(a_group, a, b_group, b, doc)
    got = {(int(d), int(p) >> 20, int(p) & 0xFFFFF): int(k) for d, p, k in zip(held, pair, n)}
    assert got == want and list(zip(held, pair)) == sorted(zip(held, pair))


def test_numbers_are_packed():
    for x in ([], [0], [255, 3], [256], [70_000, 0], [1 << 40]):
        assert alignment.unpacked(alignment.packed(np.array(x, np.int64))).tolist() == x


ODD = [
    (1, None), (2, ""), (3, " "), (4, "  two  blanks "), (5, "<s> </s> <|endoftext|> <unk> <0x41>"), (6, "a▁b"), (7, "naïve café 日本語 🙂 ́x"), (7, "naïve café 日本語 🙂 ́x"), (None, "no id"), (None, "no id"),
    (8, "x" * 5000), (9, "\n\t\r\n  tabs\x00and\x1fcontrols"), (10, "1234567890 " * 300), (11, "ﬁ ligature ½   　"), (12, "ab" * 20_000),
]


@pytest.mark.parametrize("unit", [1, 100, 2_000_000])
def test_odd_rows(spark, slow, monkeypatch, unit):
    monkeypatch.setattr(alignment, "UNIT_CHARS", unit)
    docs = spark.createDataFrame([(k, t, "u") for k, t in ODD], f"{DOC}, unit string").repartition(3)
    got = sorted(map(tuple, alignment.report(docs, A_PATH, B_PATH).collect()), key=str)
    assert got == sorted(slow(ODD), key=str)


def test_empty_and_string_ids(spark, slow):
    assert alignment.report(spark.createDataFrame([], DOC), A_PATH, B_PATH).collect() == []
    rows = [("x", "some words"), ("y", None)]
    assert sorted(map(tuple, alignment.report(spark.createDataFrame(rows, "doc_id string, text string"), A_PATH, B_PATH).collect())) == sorted(slow(rows))


def test_query(spark, sf_dir, texts, slow):
    got = sorted(map(tuple, QUERIES["op12_token_alignment"](spark, sf_dir).collect()))
    assert got == sorted(slow(texts.items()))
