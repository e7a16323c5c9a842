"""The queries of this subpackage and their SQL, in the driver's form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, chat, decontaminate, fingerprints, lines, ownership, quality, runs, simhash, suffixes, toxicity, warc
from .common import new_folder, table
from .learning import with_contract

TOXIC_FROM, QUALITY_FROM = 0.3, 0.7


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return with_contract(toxicity.score_documents(docs, model), TOXIC_FROM, F.size("offending").alias("n_offending"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


#: Says every control string that a template may use.
PROBE = "</s>[INST] ok [/INST]"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PROBE))
    messages = rows.union(probe).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.read_back(chat.format_conversations(messages))


OP3_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(16 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;')) + length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))


OP5_SQL = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, n, max(page_id) AS newest FROM p GROUP BY ALL)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, CAST(5 * i + 1 AS INT), 5) AS BIGINT) >> (15 - 5 * k)) % 32 + 1 AS INT), 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> newest THEN newest END AS refers_to, true AS digest_ok
FROM p JOIN m USING (h, n)
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    return with_contract(quality.score_documents(docs, weights), QUALITY_FROM)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
runs AS (
  SELECT item, least(len(w), 10) AS n, list_slice(w, s, s + 9) AS run
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM runs),
hits AS (
  SELECT DISTINCT x.r, x.s, x.n, runs.item
  FROM (SELECT r, s, n, list_slice(w, s, s + n - 1) AS run
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN lens WHERE len(w) >= n)) x
  JOIN runs ON runs.run = x.run AND runs.n = x.n),
hit_words AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
hit_items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH l AS (
  SELECT doc_id, k, lines[k] AS line, list_distinct(regexp_extract_all(lines[k], '[^ \t\x0B\f\r]+')) AS w
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS k
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))),
c AS (SELECT row_number() OVER (ORDER BY doc_id, k) AS id, w, len(w) AS n, doc_id, k FROM (
        SELECT list_sort(w) AS w, arg_min(doc_id, (doc_id, k)) AS doc_id, arg_min(k, (doc_id, k)) AS k
        FROM l WHERE len(w) > 0 GROUP BY 1)),
f AS (SELECT tok, count(*) AS df FROM (SELECT unnest(w) AS tok FROM c) GROUP BY tok),
p AS (SELECT id, n, tok FROM (
        SELECT id, n, tok, row_number() OVER (PARTITION BY id ORDER BY df, tok) AS r
        FROM (SELECT id, n, unnest(w) AS tok FROM c) JOIN f USING (tok))
      WHERE r <= n - CAST(ceil(n * 0.8 - 1e-9) AS BIGINT) + 1),
pairs AS (SELECT DISTINCT a.id AS early, b.id AS late FROM p a JOIN p b USING (tok)
          WHERE a.id < b.id AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n)),
gone AS (SELECT DISTINCT late AS id FROM pairs JOIN c a ON a.id = early JOIN c b ON b.id = late
         WHERE len(list_intersect(a.w, b.w)) * 10 >= (a.n + b.n - len(list_intersect(a.w, b.w))) * 8),
stay AS (SELECT doc_id, k FROM c WHERE id NOT IN (SELECT id FROM gone)),
t AS (SELECT l.doc_id, count(*) AS n_lines,
        count(*) FILTER (len(l.w) > 0 AND stay.k IS NULL) AS n_removed,
        coalesce(string_agg(l.line, chr(10) ORDER BY l.k) FILTER (len(l.w) = 0 OR stay.k IS NOT NULL), '') AS kept
      FROM l LEFT JOIN stay ON stay.doc_id = l.doc_id AND stay.k = l.k GROUP BY l.doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN t USING (doc_id)
"""


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are the sources of the documents, their repositories the languages within a source."""
    return ownership.report(table(spark, sf_dir, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
found AS (
  SELECT r, 1 AS k, 'assign' AS kind, regexp_extract_all(t, a) AS hits, string_split_regex(t, a) AS gaps
  FROM (SELECT r, t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+' AS a FROM d)
  UNION ALL SELECT r, 2, 'access', regexp_extract_all(t, 'AKIA[A-Z0-9]+'), string_split_regex(t, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT r, 3, 'hex', regexp_extract_all(t, '[0-9a-f]{24,}'), string_split_regex(t, '[0-9a-f]{24,}') FROM d
  UNION ALL SELECT r, 4, 'live', regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}'), string_split_regex(t, '[A-Za-z0-9+/_=-]{20,}') FROM d),
placed AS (
  SELECT r, k, kind, hits[i] AS hit,
         CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda g: length(g))), 0) AS BIGINT) AS s
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found)),
spans AS (
  SELECT r, k, kind, s, s + length(hit) AS e, CASE WHEN k = 1 THEN regexp_extract(hit, '[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1) ELSE hit END AS v
  FROM placed),
base AS (SELECT * FROM spans WHERE k = 1 AND length(v) >= 6 OR k = 2 AND length(v) >= 20 OR k = 3),
looks AS (
  SELECT *, length(v) >= 16 AND len(list_distinct(string_split(v, ''))) >= 10 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AS looks
  FROM (SELECT * FROM base UNION ALL
        SELECT * FROM spans x WHERE k = 4 AND NOT EXISTS (SELECT 1 FROM base WHERE base.r = x.r AND base.s < x.e AND base.e > x.s))),
candidates AS (SELECT * FROM looks WHERE k < 4 OR looks),
owned AS (SELECT v, count(DISTINCT source) AS owners, bool_or(looks) AS looks FROM candidates JOIN d USING (r) GROUP BY v),
judged AS (
  SELECT r, k, kind, s, e, CASE WHEN owners >= 3 THEN 'example' WHEN owned.looks THEN 'live' ELSE 'plain' END AS verdict
  FROM candidates JOIN owned USING (v)),
t AS (
  SELECT r, count(*) FILTER (k = 1) AS n_assign, count(*) FILTER (k = 2) AS n_access, count(*) FILTER (k = 3) AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 4) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans,
         count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_examples
  FROM judged WHERE k < 4 OR verdict = 'live' GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_examples, 0) AS n_examples
FROM d LEFT JOIN t USING (r)
"""


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, chosen by the checksum of the id, are made periodic from one word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    sized = split.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rest = F.col("n") - F.col("a")
    period = sized.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest)), " ")
    return period.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    first = found.withColumn("longest", longest)
    return first.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_bpe, op3_chat, op4_suffix_dedup, op5_warc, op6_quality, op7_fingerprints, op8_simhash, op9_decontamination, op10_line_dedup, op11_secret_scan, op12_token_alignment, op13_periodic_runs)
}
ORACLE_SQL: dict[str, str] = {"op3_chat": OP3_SQL, "op5_warc": OP5_SQL, "op9_decontamination": OP9_SQL, "op10_line_dedup": OP10_SQL, "op11_secret_scan": OP11_SQL}
