"""Queries of the operators over the driver tables, and their SQL twins.

Each query applies its operator with production parameters to the whole
table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (bpe, decontam, divergence, interplay, licenses, mincut, minhash, quality, secretscan, tokenfile, toxicity, urlrep,
                        warc)
from quarry.llm.common import read_table

#: Vocabularies of the queries.
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Host and path rules of the URL query.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: The near-duplicate query takes four words; the operator's default is five.
FOUR_WORDS = minhash.Near(shingle=4)


def op1_mincut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut.extract(read_table(spark, sf_dir, "pages"))


def op2_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.capture_index(read_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Labels as page outcomes: a page is bad if its label says low quality or toxic; label ids are page ids here."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))


def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrep.judge(read_table(spark, sf_dir, "pages"), page_outcomes(read_table(spark, sf_dir, "labels")), URL_RULES)


def op5_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.recognise(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


def op6_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), conf=FOUR_WORDS)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), MULTI_RANKS, public_tokenizers.PATTERN)
    return bpe.decode(encoded, MULTI_RANKS).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                                   F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfile.write_tokens(read_table(spark, sf_dir, "documents"), TOKENIZER, public_tokenizers.PATTERN)
    return tokenfile.checksums(tokenfile.read_tokens(manifest))


def op10_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.find(read_table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secretscan.named(F.col("base")), 256).alias("base_sha256"),
                        secretscan.named(F.col("spans")).alias("spans"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op12_filter_interplay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interplay.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_noisy_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, read_table(spark, sf_dir, "labels")))


SPARK = {f.__name__: f for f in (
    op1_mincut_text, op2_template_leaks, op3_warc_index, op4_host_reputation, op5_license_rules, op6_minhash_components,
    op7_byte_bpe, op8_line_quality, op9_token_files, op10_secret_spans, op11_source_divergence, op12_filter_interplay,
    op13_noisy_toxicity)}

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WARC_SQL = """
WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
b AS (
  SELECT *, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, CAST(i // 4 AS INT) * 5 + 1, 5) AS INT) // CAST(pow(32, 3 - i % 4) AS INT)) % 32 AS INT), 1)),
      'string_agg', '') AS payload_digest FROM d),
m AS (SELECT hex, min(page_id) AS first_id FROM b GROUP BY hex)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM b JOIN m USING (hex)
"""


def _url_sql() -> str:
    two = ", ".join(f"'{s}'" for s in urlrep.TWO_LABEL_SUFFIXES)
    conf = urlrep.Reputation()

    def level(name, parent):
        """Posterior means of one level from its groups' n, bad and the mean m expected above."""
        return f"""
{name}_s AS (
  SELECT CASE WHEN coalesce(sum(n), 0) = 0 OR sum(n * m * (1 - m)) = 0 OR sum(n) <= count(*) THEN NULL
         WHEN sum(n * m * (1 - m)) > sum(m * (1 - m))
         THEN (sum(pow(bad - n * m, 2) / n) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m))) ELSE 0.0 END AS raw
  FROM {parent} WHERE n > 0),
{name} AS (
  SELECT p.*, strength, (m * strength + bad) / (strength + n) AS mean FROM {parent} p,
    (SELECT CASE WHEN raw IS NULL THEN 1e6 ELSE (1 - least(greatest(raw, 1e-6), 0.999999)) / least(greatest(raw, 1e-6), 0.999999) END AS strength FROM {name}_s))"""

    return rf"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UP}', '{_LOW}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
o AS (
  SELECT host, CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NULL OR toxic IS NULL THEN NULL ELSE 0 END AS bad
  FROM u LEFT JOIN labels ON page_id = doc_id),
c AS (
  SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad,
         string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS parts FROM o GROUP BY host),
h AS (
  SELECT host, n, bad, parts, CASE WHEN array_to_string(parts[-2:], '.') IN ({two}) THEN array_to_string(parts[-2:], '.') ELSE parts[-1] END AS suffix FROM c),
hd AS (
  SELECT *, array_to_string(parts[greatest(len(parts) - len(string_split(suffix, '.')), 1):], '.') AS domain FROM h),
t AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) AS m FROM hd),
sp AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT m FROM t) AS m FROM hd GROUP BY suffix),
{level("s", "sp").strip()},
dp AS (SELECT x.suffix, x.domain, x.n, x.bad, s.mean AS m FROM (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hd GROUP BY suffix, domain) x JOIN s USING (suffix)),
{level("d", "dp").strip()},
hp AS (SELECT hd.host, hd.n, hd.bad, d.mean AS m FROM hd JOIN d USING (suffix, domain)),
{level("k", "hp").strip()},
blocked AS (SELECT host FROM k WHERE mean - {conf.z} * sqrt(mean * (1 - mean) / (strength + n + 1)) > {conf.max_bad}),
r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


_NEAR_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, r) AS (SELECT a, b FROM l UNION SELECT reach.doc_id, l.b FROM reach JOIN l ON reach.r = l.a),
low AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low.r, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low.r, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.doc_id = d.doc_id
"""


def _quality_sql() -> str:
    r = quality.LineRules()
    phrases = rf"(^|[^\p{{L}}\p{{N}}])(?:{'|'.join(quality.BOILERPLATE)})(?:s|d|rs?)?($|[^\p{{L}}\p{{N}}])"
    tail = r"""["''»”’)\]]*[\x20\x09-\x0D]*$"""
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, string_split(t, chr(10)) AS lines,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars FROM t),
i AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3),
c AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM i),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest([0, 1, 2]) AS k FROM c WHERE c >= 2) GROUP BY rid),
l AS (
  SELECT rid, x, len(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS nw, length(replace(x, ' ', '')) AS solid,
         length(regexp_replace(x, '[^!-/:-@\[-`{{-~]+', '', 'g')) AS marks, length(regexp_replace(x, '[^|>»›•·]+', '', 'g')) AS seps,
         length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) AS chars
  FROM (SELECT rid, unnest(lines) AS x FROM w)),
lost AS (
  SELECT rid, sum(chars) AS n FROM l
  WHERE (seps >= {r.min_separators} AND seps * {r.words_per_separator} >= nw)
     OR (solid >= {r.mark_chars} AND marks * 100 > solid * {r.max_mark_pct})
     OR (nw <= {r.boilerplate_words} AND regexp_matches(lower(x), '{phrases}')
         AND NOT (nw >= {r.sentence_words} AND regexp_matches(x, '[.!?…。！？]{tail}')))
     OR (nw < {r.fragment_words} AND nw > 0 AND NOT regexp_matches(x, '[.!?…:;,。！？]{tail}'))
  GROUP BY rid),
b AS (
  SELECT w.rid, doc_id, len(w) AS n_words, word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS lost
  FROM w LEFT JOIN rep ON rep.rid = w.rid LEFT JOIN lost ON lost.rid = w.rid)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_pct} * n_words AS base_failed,
       NOT (n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_pct} * n_words) AND NOT lost * 100 > word_chars * {r.max_lost_pct} AS kept
FROM b
"""


_DIVERGENCE_SQL = rf"""
WITH r AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
x AS (SELECT rid, lang, source, unnest(terms) AS term FROM r),
k AS (SELECT lang, term, count(*) AS total FROM x GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM r),
c AS (SELECT x.lang, x.source, x.term, count(*) AS n FROM x JOIN k ON x.lang = k.lang AND x.term = k.term GROUP BY 1, 2, 3),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY 1, 2),
p AS (
  SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // (gn.n + 2 * v.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.total + 2)) // (v.n + 2 * v.v) AS q
  FROM gn JOIN v ON gn.lang = v.lang JOIN k ON gn.lang = k.lang
  LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
pp AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pp.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pp ON pp.lang = a.lang AND pp.source = a.source AND pp.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

_INTERPLAY_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
low AS (SELECT t, min(doc_id) AS first_id FROM t GROUP BY t),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t.t, '[^A-Z]+', '', 'g')) > 10 * length(t.t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t.t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN low.first_id < t.doc_id THEN 'E' ELSE '' END AS fails
  FROM t JOIN low ON t.t = low.t LEFT JOIN lab ON lab.doc_id = t.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a JOIN l b ON b.x <> a.x JOIN l c ON c.x NOT IN (a.x, b.x)
  JOIN l d ON d.x NOT IN (a.x, b.x, c.x) JOIN l e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
m AS (
  SELECT part, filter_order, step, filter, n, good, toxic, contains(fails, filter) AS hit, fails = filter AS only_hit,
         before <> '' AND regexp_matches(fails, '[' || before || 'x]') AS gone FROM c, s),
r AS (
  SELECT part, filter_order, step, filter, sum(CASE WHEN gone OR hit THEN 0 ELSE n END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN only_hit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM m GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r
"""

SQL = {
    "op3_warc_index": _WARC_SQL,
    "op4_host_reputation": _url_sql(),
    "op6_minhash_components": _NEAR_SQL,
    "op8_line_quality": _quality_sql(),
    "op11_source_divergence": _DIVERGENCE_SQL,
    "op12_filter_interplay": _INTERPLAY_SQL,
}
