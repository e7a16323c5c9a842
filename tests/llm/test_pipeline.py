"""The pipeline: columns, stages against their operators' brute force, odd rows."""

import corpus_pipeline as pipeline
import pytest
from test_lines import brute as brute_lines
from test_simhash import brute_components, slow_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        path = f"file://{tmp_path_factory.mktemp('stage')}/{k}"
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages_keep_the_columns_of_documents(stages):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "bpe"]
    for df in stages[:-1]:
        assert df.columns == COLUMNS
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert stages[4].count() == stages[5].count()


def test_toxicity_only_drops_rows(stages):
    before, after = set(pairs(stages[0])), set(pairs(stages[1]))
    assert after <= before and len(after) > 0.7 * len(before)


def test_line_stage(stages):
    want = sorted((k, text) for k, text, _, _ in brute_lines(pairs(stages[1])))
    assert pairs(stages[2]) == want
    assert stages[2].where("n_chars <> length(text)").count() == 0


def test_simhash_stage_keeps_one_of_each_group(stages):
    rows = pairs(stages[2])
    groups = brute_components([slow_fingerprint(t, 5) for _, t in rows], 4)
    assert pairs(stages[3]) == sorted({g: rows[g] for g in groups}.values())


def test_decontamination_stage(stages, spark, sf_dir):
    import re

    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t))
    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = low(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    clean = [(k, t) for k, t in pairs(stages[3]) if not any(tuple(low(t)[i : i + n]) in windows for n in sizes for i in range(len(low(t)) - n + 1))]
    assert pairs(stages[4]) == clean


def test_run_equals_the_stages(spark, sf_dir, stages):
    got = pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].collect()))


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def test_odd_rows(spark, sf_dir):
    fine = "fine text of some words here"
    rows = [(1, None), (2, ""), (3, fine), (3, fine), (4, fine), (None, "no id at all in this row"), (None, None), (5, f"{PASSAGE}\nshort line\n{PASSAGE}"), (6, "\u00e9" * 70_000)]
    df = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    some, kept = df, []
    for _, stage in pipeline.STAGES[:-1]:
        some = stage(spark, some, sf_dir)
        kept.append(sorted([(r["doc_id"], r["text"]) for r in some.collect()], key=str))
    # rows without words are one class, those of no id last; equal texts keep the lowest id
    lines = [(1, None), (2, ""), (3, fine), (3, ""), (4, ""), (None, "no id at all in this row"), (None, None), (5, f"{PASSAGE}\nshort line"), (6, "\u00e9" * 70_000)]
    assert kept[0] == sorted(rows, key=str) and kept[1] == sorted(lines, key=str)
    assert kept[2] == kept[3] == sorted([(1, None), (3, fine), (None, "no id at all in this row"), (5, f"{PASSAGE}\nshort line"), (6, "\u00e9" * 70_000)], key=str)
    assert sorted(r["n_tokens"] for r in pipeline.encode(spark, some, sf_dir).collect())[0] == 0
    none = df.limit(0)
    for _, stage in pipeline.STAGES:
        none = stage(spark, none, sf_dir)
    assert none.count() == 0


def test_columns_of_any_name_and_ids_of_any_type_stay(spark, sf_dir):
    names = ["score", "offending", "last", "id", "key", "again", "place", "row", "seq", "n_lines", "n_removed", "hits", "fp", "cls", "class", "__rest", "_rest", "d", "line_nos", "a.b"]
    rows = [(f"k{k}", f"text number {k} with words of its own {k * 7} {k * 11}", *[f"{n}{k}" for n in names]) for k in range(6)]
    df = spark.createDataFrame(rows, f"doc_id string, text string, {', '.join(f'`{n}` string' for n in names)}")
    some = df
    for _, stage in pipeline.STAGES[:-1]:
        some = stage(spark, some, sf_dir)
        assert some.columns == df.columns
    assert sorted(map(tuple, some.collect())) == rows
    assert [r["doc_id"] for r in pipeline.encode(spark, some, sf_dir).orderBy("doc_id").collect()] == [r[0] for r in rows]


def test_settings_of_the_session_stay(spark, sf_dir):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    pipeline.drop_toxic(spark, docs, sf_dir)
    pipeline.encode(spark, docs, sf_dir)
    assert spark.conf.get(key) == before
