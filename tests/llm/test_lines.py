"""Line dedup against SQL and brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from comparing import rows_of, rows_of_sql

from sessiongrid.llm import lines
from sessiongrid.llm.queries import ORACLE_SQL, QUERIES


def words(line):
    return set(re.findall(r"[^ \t\x0b\f\r]+", line))


def brute(rows, t=0.8):
    """(doc_id, text, n_lines, n_removed); every row is a document of its own, by id (null last) and hash of the text."""
    number = lambda x: (h := xxhash.xxh64_intdigest(x.encode(), 42)) - (h >> 63 << 64)
    seen, out = [], []
    for k, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, number(r[1] or ""))):
        own, kept = [] if text is None else text.split("\n"), []
        for line in own:
            s = words(line)
            if not any(len(o & s) * 1000 >= t * 1000 * len(o | s) for o in seen if s):
                kept.append(line)
            if s:
                seen.append(s)
        out.append((k, None if text is None else "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=str)


def random_rows(n=60, seed=1):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 9)) for _ in range(rng.choice([3, 5, 9, 12, 30, 60, 90]))) for _ in range(14)]

    def line():
        w = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 1 + len(w) // 6)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 99)}"
        return rng.choice([" ", "  ", "\t", " \r"]).join(w)

    return [(k, "\n".join(line() if rng.random() < 0.8 else rng.choice(["", " ", "one", "two words", "\t\f\x0b"]) for _ in range(rng.randint(1, 6)))) for k in range(n)]


def found(spark, rows, schema="doc_id long, text string", t=0.8):
    return sorted(map(tuple, lines.dedup_lines(spark.createDataFrame(rows, schema).repartition(5), t).select("doc_id", "text", "n_lines", "n_removed").collect()), key=str)


def test_query_equals_sql(spark, duck, sf_dir):
    df = QUERIES["op10_line_dedup"](spark, sf_dir)
    want, names = rows_of_sql(duck, ORACLE_SQL["op10_line_dedup"])
    assert sorted(df.columns) == names and rows_of(df) == want


@pytest.mark.parametrize("limit, frequent, bits, dealt", [(32 << 20, 512, 62, 1000), (0, 1, 62, 2), (32 << 20, 4, 3, 3)])
def test_random_lines(spark, monkeypatch, limit, frequent, bits, dealt):
    """Also with shuffles for broadcasts, with frequent tokens only, with decimal places and dealt pairs."""
    for name, value in [("BROADCAST_BYTES", limit), ("FREQUENT", frequent), ("PLACE_BITS", bits), ("DEALT", dealt)]:
        monkeypatch.setattr(lines, name, value)
    rows = random_rows() + [(500, None), (501, ""), (None, "one"), (None, "a line under no id")]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("t", [0.6, 0.9, 1.0])
def test_other_thresholds(spark, t):
    rows = random_rows(40, seed=3)
    assert found(spark, rows, t=t) == brute(rows, t)


def test_one_word_of_thirty_changed_is_removed(spark):
    w = [f"w{k}" for k in range(30)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:12] + ["other"] + w[13:])), (3, " ".join(w[:9])), (4, " ".join(w[:8] + ["x"]))]
    assert [r[3] for r in found(spark, rows)] == [0, 1, 0, 1]  # 29 / 31 goes, 9 / 30 stays, 8 / 10 goes


def test_near_copies_resolve_without_all_pairs(spark):
    w = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(w[:40] + [f"x{k}"] + w[41:])) for k in range(200)]
    got = found(spark, rows)
    assert sum(r[3] for r in got) == 199 and next(r for r in got if r[0] == 0)[3] == 0


def test_columns_stay(spark):
    schema = "doc_id long, text string, lang string, n_lines int, d string, line_nos string, seq string, `row` string, `a.b` string"
    df = spark.createDataFrame([(1, "a\na", "en", 7, *"pqrst"), (2, "z" * 200_000, "de", 8, *"uvwxy")], schema)
    got = lines.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "lang", "d", "line_nos", "seq", "row", "a.b", "n_lines", "n_removed"]
    assert sorted((r["text"][:3], r["d"], r["line_nos"], r["seq"], r["row"], r["a.b"], r["n_lines"], r["n_removed"]) for r in got.collect()) == [("a", *"pqrst", 2, 1), ("zzz", *"uvwxy", 1, 0)]
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_rows_without_an_id_are_rows_of_their_own(spark):
    rng = random.Random(5)
    body = lambda k: "\n".join(f"own{k} line{n} {k}of {n}a {k}-{n}text" for n in range(3))
    rows = [(1, "head\na line that repeats"), (7, "x y z"), (7, "x y z\nmore of seven"), (7, "x y z")]
    rows += [(None, body(k) + ("\na line that repeats" if k % 3 == 0 else "")) for k in range(40)]
    rows += [(None, "same place"), (None, "same place\nother"), (None, "equal text\n \nin two rows"), (None, "equal text\n \nin two rows")]
    rng.shuffle(rows)
    rows += random_rows(30) + [(500, None), (501, ""), (None, "one"), (None, "a line under no id")]
    assert found(spark, rows) == brute(rows)


def test_string_ids(spark):
    rows = [("b", "one line of words\nfresh"), ("a", "one line of words"), (None, "one line of words\nlast")]
    assert found(spark, rows, "doc_id string, text string") == [("a", "one line of words", 1, 0), ("b", "fresh", 2, 1), (None, "last", 2, 1)]


def test_joins_are_built_in(spark, sf_dir):
    """Tokens alone are made in Arrow batches."""
    plan = QUERIES["op10_line_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_word_hashes():
    texts = [b"one two\n\n one", b"", b" \t\n" + b"x" * 200 + b" " + b"x" * 201 + "\u00fc \u00fc".encode(), b"\n\ntwo"]
    h, text, line = lines.word_hashes(texts)
    assert list(zip(text.tolist(), line.tolist())) == [(0, 0), (0, 0), (0, 2), (2, 1), (2, 1), (2, 1), (3, 2)]
    assert h[0] == h[2] and h[1] == h[6] and len(set(h.tolist())) == 5
    many = [str(k).encode() for k in range(100_000)]
    assert len(set(lines.word_hashes([b" ".join(many)])[0].tolist())) == 100_000


def test_pieces_change_no_hash(monkeypatch):
    texts = [b"one two  three\n" * 50 + b"x" * 300, b"", b"\n\n", b" a\tb " * 40 + b"y" * 100]
    want = [x.tolist() for x in lines.word_hashes(texts)]
    monkeypatch.setattr(lines, "SLICE", 16)
    assert [x.tolist() for x in lines.word_hashes(texts)] == want


def test_classes_meet_once_for_a_run_of_common_tokens(spark):
    """Not by each of its 55 pairs of frequent tokens, nor by each of its rare ones."""
    shared = list(range(1, 4)) + [-1 - k for k in range(10, 21)]
    classes = [(k, 60, 0, 0, [*shared[:6], -100 - k, *shared[6:]]) for k in range(8)] + [(k, 60, 0, 0, shared) for k in range(8, 12)] + [(12, 60, 0, 0, [7, -30, -12])]
    frame = spark.createDataFrame(classes, "at long, n int, b long, half long, prefix array<int>")
    none = spark.createDataFrame([], "late long")
    met = [(r["late"], r["early"]) for some in lines._met(frame, none, 800) for r in some.collect()]
    assert set(met) == {(i, j) for i in range(12) for j in range(i)} and len(met) <= 2 * len(set(met))


def test_classes_of_one_lead_meet_once(spark):
    """Their first frequent pair of tokens is the same, so no later run of common tokens brings the pair again."""
    shared = list(range(1, 4)) + [-1 - k for k in range(10, 21)]
    classes = [(k, 200, 0, 0, [50 + k, *shared[:6], -100 - k, *shared[6:]]) for k in range(8)] + [(8, 200, 0, 0, [1, -30, -31, -12, -13]), (9, 200, 0, 0, [1, 2, 3])]
    frame = spark.createDataFrame(classes, "at long, n int, b long, half long, prefix array<int>")
    none = spark.createDataFrame([], "late long")
    met = [(r["late"], r["early"]) for some in lines._met(frame, none, 800) for r in some.collect() if r["late"] < 8]
    assert sorted(met) == [(i, j) for i in range(8) for j in range(i)]
    pairs = {(r["late"], r["early"]) for some in lines._met(frame, none, 800) for r in some.collect()}
    assert {(8, j) for j in range(8)} | {(9, j) for j in range(9)} <= pairs  # other leads meet by their runs


def test_short_lines_have_two_maps():
    words = [str(k).encode() for k in range(40)]
    batch = lines._line_batch(np.array([0]), [b" ".join(words)], np.zeros(lines.COUNTERS, np.uint8), 20, 800)
    whole, half = (int(np.uint64(batch.column(k)[0].as_py() & ((1 << 64) - 1))) for k in (6, 7))
    assert half.bit_count() + (whole ^ half).bit_count() > whole.bit_count()
