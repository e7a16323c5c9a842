"""The near-copy stage of the pipeline against brute-force Jaccard."""

import random

import corpus_pipeline as pipeline
from test_simhash import slow_fingerprint

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def edited_rows(seed=4):
    """Texts with copies in which a few words are replaced: similarities on both sides of 0.8."""
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(60, 160))]
        texts.append(" ".join(base))
        for edits in (1, 2, 3, 5):
            w = list(base)
            for at in rng.sample(range(len(w)), edits):
                w[at] = f"new{rng.randrange(1000)}"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    return [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]


def lowest_of_classes(rows, t=0.8):
    """The lowest ids of the classes by links of that similarity, or of fingerprints within four bits."""
    sets, fps = [shingles(r[1]) for r in rows], [slow_fingerprint(r[1], 5) for r in rows]
    low = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]) or (fps[i] ^ fps[j]).bit_count() <= 4) and low[i] != low[j]:
                a, b = sorted((low[i], low[j]))
                low = [a if x == b else x for x in low]
    return sorted({rows[k][0] for k in low})


def test_stage_finds_all_of_similarity_0_8(spark, sf_dir):
    rows = edited_rows()
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = pipeline.drop_near_copies(spark, df, sf_dir)
    assert got.columns == df.columns
    assert sorted(r["doc_id"] for r in got.collect()) == lowest_of_classes(rows)


def test_one_row_of_each_group_without_ids_or_with_repeated_ones(spark, sf_dir):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, a), (None, d), (None, d), (None, b + " more")]
    df = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], DOCS).repartition(3)
    got = [(r["doc_id"], r["text"]) for r in pipeline.drop_near_copies(spark, df, sf_dir).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (3, c), (None, d)], key=str)


def shared_passage(n: int) -> list[tuple]:
    """Texts of 60 words that all share and 60 of their own, no two similar, and one near copy of the first."""
    common = " ".join(f"c{k}" for k in range(60))
    rows = [(k, " ".join(f"w{k}_{i}" for i in range(60)) + " " + common) for k in range(n)]
    return [*rows, (n, rows[0][1] + " end")]


def test_a_passage_of_many_texts_makes_no_pairs(spark):
    from sessiongrid.llm import nearcopies

    made = []
    for n in (150, 300, 600):
        docs = spark.createDataFrame(shared_passage(n), "doc_id long, text string").repartition(4)
        rows = nearcopies.keep_table(nearcopies.shingle_rows(docs, 5, 800), "shingles")
        posts = nearcopies.prefix_posts(docs, rows, 5, 800)
        held = posts.groupBy("token").count().where("count > 1")
        made.append(sum(r["count"] * (r["count"] - 1) // 2 for r in held.collect()))
        assert posts.groupBy("cls").count().select("count").distinct().count() <= 2
    assert max(made) <= 24  # the two copies alone share tokens, however many texts there are


def test_frequent_tokens_lose_no_similar_texts(spark, sf_dir, monkeypatch):
    """Order by rarity from three prefixes on: the same classes as without, and as by brute force."""
    from sessiongrid.llm import nearcopies

    rows = [(k, f"{t} {' '.join(f'c{i}' for i in range(40))}" if k % 2 else t, "en", "s", 1) for k, t, *_ in edited_rows(9)] + [(900 + k, t, "en", "s", 1) for k, t in shared_passage(30)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    for least in (3, 64):
        monkeypatch.setattr(nearcopies, "FREQUENT", least)
        got = sorted(r["doc_id"] for r in pipeline.drop_near_copies(spark, df, sf_dir).collect())
        assert got == lowest_of_classes(rows)


def test_long_texts_that_share_a_passage_are_told_apart_by_their_maps(spark):
    """Maps of different lengths count no more differing bits than there are differing shingles, and enough to tell texts apart."""
    import numpy as np

    from sessiongrid.llm import nearcopies

    rng = np.random.default_rng(3)
    common = rng.integers(-(2**63), 2**63 - 1, 4000)
    more = [np.unique(np.concatenate([common[:share], rng.integers(-(2**63), 2**63 - 1, n - share)])) for share, n in ((4000, 4000), (4000, 4600), (500, 4600), (3600, 4090))]
    rows = [(k, len(x), [int(v) for v in nearcopies.bitmap(x)]) for k, x in enumerate(more)]
    assert len({len(m) for _, _, m in rows}) == 2
    frame = spark.createDataFrame(rows, "cls long, n int, map array<long>")
    pairs = spark.createDataFrame([(i, j, len(more[i]), len(more[j])) for i in range(4) for j in range(i)], "cls long, other long, n int, n2 int")
    got = {(r["cls"], r["other"]): r["differ"] for r in nearcopies._mapped(frame, pairs, 800).collect()}
    for (i, j), differ in got.items():
        assert differ <= len(np.setxor1d(more[i], more[j]))
    similar = {(i, j) for i in range(4) for j in range(i) if len(np.intersect1d(more[i], more[j])) >= 0.8 * len(np.union1d(more[i], more[j]))}
    assert similar <= set(got)
    assert not {p for p in got if 2 in p}


def test_no_shuffle_holds_all_tokens_of_the_sets_with_a_passage(spark):
    """Counting and ordering the tokens of the sets concerned goes share by share, not in one shuffle."""
    from sessiongrid.llm import nearcopies

    docs = spark.createDataFrame(shared_passage(600), "doc_id long, text string").repartition(4)
    rows = nearcopies.keep_table(nearcopies.shingle_rows(docs, 5, 800), "shingles")
    context = spark.sparkContext
    stages = lambda: {s.stageId(): s.shuffleWriteRecords() for s in (found.apply(k) for found in [context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)] for k in range(found.size()))}
    before = stages()
    posts = nearcopies.prefix_posts(docs, rows, 5, 800)
    tokens = rows.selectExpr("sum(n)").first()[0]
    assert max(n for k, n in stages().items() if k not in before) < tokens / 3
    assert posts.groupBy("cls", "pos").count().where("count > 1").isEmpty()
