"""The operators on the supplied tables, whole, with the SQL that states the result where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govpub.llm import (chat, decontam, fst_bpe, host_quality, langid, line_align, pii, probminhash, recompress, resample,
                        toxicity, url_rules, warc)
from govpub.llm.base import ORACLES, QUERIES, query, table  # noqa: F401

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Key where the session sets none (`spark.govpub.pii.key`, from a secret store); surrogates cannot be linked across keys.
PII_KEY = b"example key, replace"


@query()
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every whole text, learned from the part that is not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    marked = docs.withColumn("held_out", langid.held_out())
    return langid.identified(marked, langid.train(docs), ["doc_id", "held_out"])


@query()
def op2_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every text with surrogates in place of personal data."""
    key = spark.conf.get("spark.govpub.pii.key", None)
    return pii.pseudonymised(table(spark, folder, "documents").select("doc_id", "text"), key.encode() if key else PII_KEY)


@query()
def op3_probminhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return probminhash.classes(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "class_id")


_UPPER, _LOWER = url_rules._UPPER, url_rules._LOWER
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query(rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
             regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(13, len(w)) AS n,
                array_to_string(w[k + 1 : k + least(13, len(w))], ' ') AS win
         FROM (SELECT *, unnest(range(0, len(w) - least(13, len(w)) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
places AS (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS k FROM d JOIN sizes ON len(w) >= n),
hits AS (SELECT r, k, n, array_to_string(w[k + 1 : k + n], ' ') AS win FROM places),
found AS (SELECT h.r, h.k, h.n, h.win FROM hits h SEMI JOIN wins USING (win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT f.r, item_id FROM found f JOIN wins USING (win)) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""")
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontam.contamination(table(spark, folder, "documents").select("doc_id", "text"),
                                  table(spark, folder, "benchmark"), ["doc_id"])


@query("""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM t),
one AS (SELECT conv_id, pos, sha256(concat_ws('|', pos, coalesce('r' || role, '-'), coalesce('t' || text, '-'))) AS h,
        '<|im_start|>' || coalesce(role, '') || chr(10)
        || replace(replace(coalesce(text, ''), '<|im_start|>', '<​|im_start|>'), '<|im_end|>', '<​|im_end|>')
        || '<|im_end|>' || chr(10) AS piece FROM p),
pre AS (SELECT conv_id, pos, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix,
               max(pos) OVER (PARTITION BY conv_id) AS n FROM one),
whole AS (SELECT min(conv_id) AS conv_id, n, prefix FROM pre WHERE pos = n GROUP BY n, prefix),
kept AS (SELECT conv_id, n FROM whole WHERE prefix NOT IN (SELECT prefix FROM pre WHERE pos < n))
SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(n AS BIGINT) AS n_turns, string_agg(piece, '' ORDER BY pos) AS text
FROM one JOIN kept USING (conv_id) GROUP BY conv_id, n
""")
def op5_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations that no longer one continues, rendered."""
    return chat.rendered(table(spark, folder, "conversations"))


_TOKENS = r"""
u AS (SELECT page_id, row_number() OVER () AS r,
             CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT *, translate(raw, '%s', '%s') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
q AS (SELECT *, substr(rest, length(raw) + length(path) + 1) AS tail, string_split(host, '.') AS ls FROM p),
tok AS (SELECT *, CASE WHEN host = '' THEN [] ELSE list_sort(list_distinct(
  ['host=' || host]
  || CASE WHEN len(ls) > 2 THEN ['site=' || ls[-2] || '.' || ls[-1], 'sub=' || ls[1]] ELSE [] END
  || list_transform(list_filter(string_split(path, '/'),
       lambda s: s <> '' AND NOT regexp_matches(s, '^[0-9]+([.].*)?$')), lambda s: 'path=' || s)
  || CASE WHEN regexp_matches(path, '[.][A-Za-z0-9]+$') THEN ['ending=' || regexp_extract(path, '[.]([A-Za-z0-9]+)$', 1)] ELSE [] END
  || CASE WHEN path LIKE '%%/' THEN ['slash'] ELSE [] END
  || list_transform(list_filter(list_transform(string_split(regexp_extract(tail, '^\?([^#]*)', 1), '&'),
       lambda kv: string_split(kv, '=')[1]), lambda k: k <> ''), lambda k: 'key=' || k)
  || CASE WHEN contains(tail, '#') THEN ['fragment'] ELSE [] END)) END AS tokens FROM q)""" % (_UPPER, _LOWER)

_FITS = {rule: f"(host = '{rule.partition('/')[0]}' OR host LIKE '%.{rule.partition('/')[0]}') AND "
               f"starts_with(path, '/{rule.partition('/')[2]}')" for rule, _ in url_rules.LISTED}
_BY_LENGTH = sorted(url_rules.LISTED, key=lambda x: (-len(x[0]), x[0]))
_RULE = " ".join(f"WHEN {_FITS[r]} THEN '{r}'" for r, _ in _BY_LENGTH)
_SAYS = " ".join(f"WHEN {_FITS[r]} THEN '{v}'" for r, v in _BY_LENGTH)


@query(rf"""
WITH {_TOKENS},
bad AS (SELECT doc_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
tx AS (SELECT r, tokens, bad FROM tok JOIN bad
       ON doc_id = TRY_CAST(nullif(regexp_extract(path, '^/[a-z]+/([0-9]+)', 1), '') AS BIGINT) WHERE len(tokens) > 0),
n AS (SELECT count(*) AS n, sum(bad) AS bad FROM tx),
sub AS (SELECT bad, list_filter(tokens, lambda t, i: (mask >> (i - 1)) & 1 = 1) AS combination
        FROM (SELECT *, unnest(range(1, CAST(pow(2, len(tokens)) AS BIGINT))) AS mask FROM tx)),
counted AS (SELECT combination, count(*) AS c, sum(bad) AS b FROM sub GROUP BY combination),
rules AS (SELECT combination FROM counted, n
          WHERE b >= {url_rules.MIN_PAGES} AND b / c >= {url_rules.MIN_CONFIDENCE} AND (b / c) / (n.bad / n.n) >= {url_rules.MIN_LIFT}),
hit AS (SELECT DISTINCT r FROM tok, rules WHERE list_has_all(tokens, combination))
SELECT page_id, host, path, CASE {_RULE} END AS rule,
       CASE {_SAYS} WHEN hit.r IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM tok LEFT JOIN hit USING (r)
""")
def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return url_rules.judged(table(spark, folder, "pages"), table(spark, folder, "labels"))


@query()
def op7_line_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the blocks that an earlier one has."""
    return line_align.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), every_copy=True)


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
g AS (SELECT digest, min(page_id) AS least, count(*) AS c FROM q WHERE n >= 100 GROUP BY digest),
r AS (SELECT q.*, CASE WHEN c > 1 AND (page_id IS NULL OR page_id > least) THEN least END AS refers_to
      FROM q LEFT JOIN g USING (digest))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM r
""")
def op8_warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as archives, normalised and read back."""
    return warc.archived(table(spark, folder, "pages").select("page_id", "url", "html"))


@query()
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every text and what they decode to."""
    return fst_bpe.round_trip(table(spark, folder, "documents"), VOCABULARY, public_tokenizers.PATTERN)


@query(rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS r,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
win AS (SELECT r, k, array_to_string(w[k : k + 2], ' ') AS win
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM d WHERE len(w) > 2)),
twice AS (SELECT r, win FROM win GROUP BY r, win HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT r, unnest(range(k, k + 3)) AS p FROM win SEMI JOIN twice USING (r, win)) GROUP BY r),
m AS (SELECT doc_id, source AS host, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN lines USING (r) LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 3 * n_words
             OR word_chars > 10 * n_words AS strict_failed FROM m),
hosts AS (SELECT host, count(*) AS n, sum(CASE WHEN base_failed OR strict_failed THEN 1 ELSE 0 END) AS k FROM f GROUP BY host),
t AS (SELECT count(*) AS hosts, sum(n) AS n, sum(k) / sum(n) AS mean, sum(n * n) AS sq_n, sum(k * k / n) AS sq_k FROM hosts),
b AS (SELECT mean, CASE WHEN n - sq_n / n > 0 THEN (sq_k - n * mean * mean - (hosts - 1) * mean * (1 - mean)) / (n - sq_n / n)
                   ELSE 0 END AS between_hosts FROM t),
prior AS (SELECT mean, CASE WHEN between_hosts > 0 THEN least(greatest(mean * (1 - mean) / between_hosts - 1, {host_quality.PRIOR_MIN}),
                 {host_quality.PRIOR_MAX}) ELSE {host_quality.PRIOR_MAX} END AS strength FROM b),
v AS (SELECT host, CASE WHEN (k + mean * strength) / (n + strength) >= {host_quality.HOST_LIMIT} THEN 'strict' ELSE 'trusted' END
             AS host_verdict FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_verdict,
       NOT base_failed AND NOT (host_verdict = 'strict' AND strict_failed) AS kept
FROM f JOIN v ON f.host IS NOT DISTINCT FROM v.host
""")
def op10_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of every document, and whether its host's record lets it pass."""
    found = host_quality.judged(table(spark, folder, "documents").select("doc_id", "text", "source"), ["doc_id"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "host_verdict", F.col("kept"))


@query()
def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every whole text, learned from the labels of the part that is not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = toxicity.scored(docs.withColumn("held_out", toxicity.held_out()),
                            toxicity.train(docs, table(spark, folder, "labels")), ["doc_id", "held_out"])
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"


@query(rf"""
WITH crc AS (SELECT list(list_reduce(range(8), lambda c, x: {_CRC_STEP}, n) ORDER BY n) AS t FROM range(256) r(n)),
d AS (SELECT 0 AS side, doc_id, row_number() OVER () AS r, text FROM documents
      UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark),
w AS (SELECT side, doc_id, r, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS w FROM d),
f AS (SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS f FROM w),
g AS (SELECT side, r, f, count(*) AS n FROM f GROUP BY ALL),
b AS (SELECT f, xor(list_reduce(list_transform(range(CAST(length(h) / 2 AS BIGINT)), lambda k:
                    16 * (instr('0123456789ABCDEF', h[2 * k + 1]) - 1) + instr('0123456789ABCDEF', h[2 * k + 2]) - 1),
                    lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) % {resample.BUCKETS} AS bucket
      FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM g)), crc),
p AS (SELECT side, r, bucket, n FROM g JOIN b USING (f)),
s AS (SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM p GROUP BY bucket),
tot AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM s),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (all_s + {resample.BUCKETS}) AS DOUBLE)
                / CAST((coalesce(s, 0) + 1) * (all_t + {resample.BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain FROM s, tot),
m AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
      FROM p JOIN gain USING (bucket) WHERE side = 0 GROUP BY r),
h AS (SELECT doc_id, r, len(w) AS n_words, list_reduce(range(1, 9), lambda c, k: c * 16 + instr('0123456789abcdef', x[k]) - 1, 0) AS h
      FROM (SELECT *, sha256('{resample.KEY}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM w WHERE side = 0)),
z AS (SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
      FROM h LEFT JOIN m USING (r)),
o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {resample.MIN_WORDS}
                                   ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS place,
             count(*) FILTER (n_words >= {resample.MIN_WORDS}) OVER () AS n FROM z)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= {resample.MIN_WORDS} AND place <= {resample.PERCENT} * n // 100 THEN place END AS rank FROM o
""")
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and place in the draw of every document, with the benchmark's texts as the target."""
    found = resample.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document (a tenth of them with a periodic tail), the longest one, and digests of runs and rest."""
    docs = recompress.with_tails(table(spark, folder, "documents").select("doc_id", "text"))
    best, runs = F.col("longest"), F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return recompress.periodic(docs, ["doc_id"]).withColumn("longest", recompress.longest()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(runs, lambda r: F.concat(r, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
