"""Byte-level BPE against the tokenizers library."""

import hashlib
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessiongrid.llm import bpe
from sessiongrid.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def odd_texts():
    rng = random.Random(5)
    alphabet = [chr(c) for c in range(0x180)] + [chr(c) for c in (0x85, 0x1C, 0x2028, 0x3000, 0x4E00, 0x1F600, 0x301, 0x558, 0xB2, 0x660, 0x378)] + [" "] * 40 + ["'s", "_", "  ", "<|endoftext|>"]
    return ["", "a" * 999, " " * 500, "aaaa'll_x_ 12²½", "<|endoftext|><|endoftext|> x"] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(800)]


def test_same_ids_and_text_as_the_library(library, texts):
    model = bpe.ByteBPE(tokenizer_path())
    some = odd_texts() + list(texts.values())
    for ids, want in zip(model.encode_batch(some), library.encode_batch(some, add_special_tokens=False)):
        assert ids.tolist() == want.ids
        assert model.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_forgetting_words_changes_nothing(monkeypatch, texts):
    some = list(texts.values())[:40]
    want = [x.tolist() for x in bpe.ByteBPE(tokenizer_path()).encode_batch(some)]
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    monkeypatch.setattr(bpe, "SLICE_CHARS", 2000)
    assert [x.tolist() for x in bpe.ByteBPE(tokenizer_path()).encode_batch(some)] == want


def test_frames_round_trip(spark):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (3, ""), (None, "né\n" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    out = bpe.decode(bpe.encode(df, tokenizer_path()), tokenizer_path()).collect()
    assert len(out) == 5 and all(r["decoded"] == (r["text"] or "") for r in out)
    assert bpe.round_trip(df.limit(0), tokenizer_path()).count() == 0


def test_query(spark, sf_dir, texts, library):
    got = {r["doc_id"]: r for r in QUERIES["op2_bpe"](spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for k, text in list(texts.items())[:60]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_a_model_keeps_no_object_for_each_merge():
    """Every worker holds a model: 50,000 merges and tokens as objects took 15 MB of it."""
    def held(x):
        return sys.getsizeof(x) + (sum(map(held, x.values() if isinstance(x, dict) else x)) if isinstance(x, (dict, list, tuple)) else 0)

    model = bpe.ByteBPE(tokenizer_path())
    assert sum(map(held, vars(model).values())) < 4_000_000
    assert model.token_bytes()[:3] == [b"!", b'"', b"#"]
