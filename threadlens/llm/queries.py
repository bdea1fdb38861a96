"""The training-data operators applied to the given tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import (
    byte_bpe,
    decontaminate,
    jaccard_join,
    pii,
    preference_format,
    quality_rules,
    secret_scan,
    source_audit,
    substring_dedup,
    token_alignment,
    toxicity,
    url_filter,
    vector_search,
)
from threadlens.session import ship_package

#: Fixed values of the query: the rules, and what decides where none of them fits.
URL_RULES = url_filter.host_rules([
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
])
URL_EXTRA = [url_filter.Rule("spam", "block", "*spam*/**"), url_filter.Rule("spam", "block", "*spam*")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    ledger = secret_scan.scan(docs, path="doc_id")
    return secret_scan.digest(secret_scan.findings(docs, ledger, path="doc_id")).withColumnRenamed("path", "doc_id")


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_pii(table(spark, folder, "documents"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES, URL_EXTRA)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, folder, "documents"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "spans")


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, folder, "documents"), *tokenizer())


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations 2i and 2i + 1 as chosen and rejected."""
    turns = table(spark, folder, "conversations")
    ids = turns.select("conv_id").distinct()
    pairs = ids.where("conv_id % 2 = 0").selectExpr("conv_id div 2 as pair_id", "conv_id as chosen_id", "conv_id + 1 as rejected_id")
    return preference_format.format_preferences(turns, pairs)


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = jaccard_join.join_classes(table(spark, folder, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id", "class_id")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("items", "h")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align_documents(table(spark, folder, "documents"), *files)


def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def op13_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, folder, "documents"))


LLM_QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_pii": op2_pii,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_preferences": op8_preferences,
    "op9_decontamination": op9_decontamination,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_token_alignment": op11_token_alignment,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_source_audit": op13_source_audit,
}

OP3_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(name, host_part, path_part, verdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
  ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
hits AS (
  SELECT page_id, host, path, arg_max(name, length(name)) AS rule, arg_max(verdict, length(name)) AS verdict, count(name) AS n
  FROM (SELECT p.*, r.name, r.verdict FROM (SELECT row_number() OVER () AS k, * FROM parts) p
        LEFT JOIN rules r ON (p.host = r.host_part OR p.host LIKE '%.' || r.host_part) AND starts_with(p.path, r.path_part)) x
  GROUP BY k, page_id, host, path)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host LIKE '%spam%' THEN 'block' ELSE 'allow' END) AS verdict,
       n + CASE WHEN host LIKE '%spam%' THEN 1 ELSE 0 END AS matched
FROM hits"""



def _op1_sql() -> str:
    """Places follow from the lengths of the matches and of the pieces between them. Runs that would be
    dropped for their length are left out of the patterns where that cannot change other matches."""
    patterns = [r.pattern.replace("'", "''") for r in secret_scan.RULES]
    patterns[1], patterns[2] = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
    cut = ", ".join(f"regexp_extract_all(t, '{p}') AS m{i}, string_split_regex(t, '{p}') AS g{i}" for i, p in enumerate(patterns))
    parts = []
    for i, rule in enumerate(secret_scan.RULES):
        start = (
            f"list_sum(list_transform(g{i}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m{i}[1:i - 1], lambda x: length(x))), 0)"
        )
        parts.append(
            f"list_filter(list_transform(range(1, len(m{i}) + 1), lambda i: {{'s': ({start})::BIGINT, 'k': {i}, 'm': m{i}[i]}}), "
            f"lambda z: length(regexp_extract(z.m, '{patterns[i]}', {rule.group})) >= {rule.at_least})"
        )
    kinds = "[" + ", ".join(f"'{r.kind}'" for r in secret_scan.RULES) + "]"
    show = f"list_transform({{}}, lambda z: {kinds}[z.k + 1] || ':' || z.s || ':' || (z.s + length(z.m)))"
    base = "list_filter(f, lambda z: z.k < 3)"
    counts = ", ".join(f"len(list_filter(f, lambda z: z.k = {i}))::BIGINT AS n_{r.kind}" for i, r in enumerate(secret_scan.RULES) if r.base)
    return (
        f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), c AS (SELECT doc_id, t, {cut} FROM d), "
        f"x AS (SELECT doc_id, t, list_sort(list_concat({', '.join(parts)})) AS f FROM c) "
        f"SELECT doc_id, sha256(t) AS blob, {counts}, sha256(coalesce(array_to_string({show.format(base)}, ','), '')) AS base_sha256, "
        f"coalesce(array_to_string({show.format('f')}, ','), '') AS spans FROM x"
    )


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id::VARCHAR AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, len(win) AS n, array_to_string(win, ' ') AS win
  FROM (SELECT item, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda p: w[p:p + 12])) AS win FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM w, sizes)),
h AS (SELECT doc_id, p, dw.n AS n, item FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, list_sort(list_distinct(list(item))) AS items FROM h GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""

OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, list(r ORDER BY turn, role, text) AS a
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS r
        FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
p AS (
  SELECT c.conv_id // 2 AS pair_id, c.conv_id AS chosen_id, r.conv_id AS rejected_id, c.a AS a, r.a AS b,
         len(list_filter(range(1, least(len(c.a), len(r.a)) + 1), lambda i: c.a[1:i] = r.a[1:i])) AS n
  FROM t c JOIN t r ON r.conv_id = c.conv_id + 1 WHERE c.conv_id % 2 = 0),
x AS (SELECT *, a[1:n] AS s, a[n + 1:] AS u, b[n + 1:] AS v FROM p)
SELECT pair_id, chosen_id, rejected_id, n::BIGINT AS n_prompt_turns,
  coalesce(array_to_string(list_transform(s, lambda z: '<|' || z.role || '|>' || chr(10) || z.text || chr(10)), ''), '') AS prompt,
  coalesce(array_to_string(list_transform(u, lambda z: '<|' || z.role || '|>' || chr(10) || z.text || chr(10)), ''), '') AS chosen,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(u) + 1), lambda i: u[i].role = 'assistant'), lambda i:
    (coalesce(list_sum(list_transform(u[1:i - 1], lambda z: length(z.role) + length(z.text) + 6)), 0) + length(u[i].role) + 5)::BIGINT || ':' ||
    (coalesce(list_sum(list_transform(u[1:i - 1], lambda z: length(z.role) + length(z.text) + 6)), 0) + length(u[i].role) + 5 + length(u[i].text))::BIGINT), ','), '') AS chosen_mask,
  coalesce(array_to_string(list_transform(v, lambda z: '<|' || z.role || '|>' || chr(10) || z.text || chr(10)), ''), '') AS rejected,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(v) + 1), lambda i: v[i].role = 'assistant'), lambda i:
    (coalesce(list_sum(list_transform(v[1:i - 1], lambda z: length(z.role) + length(z.text) + 6)), 0) + length(v[i].role) + 5)::BIGINT || ':' ||
    (coalesce(list_sum(list_transform(v[1:i - 1], lambda z: length(z.role) + length(z.text) + 6)), 0) + length(v[i].role) + 5 + length(v[i].text))::BIGINT), ','), '') AS rejected_mask
FROM x"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
totals AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM groups g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT t.lang, t.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.total + v.v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 1)) // (v.total + v.v) AS q
  FROM totals t JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = kept.term),
pairs AS (
  SELECT g.lang, g.source, h.source AS item, coalesce(x.value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
    ON x.lang = g.lang AND x.source = g.source AND x.item = h.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts) z
WHERE part = 'pair' OR rank <= 200"""

LLM_ORACLES = {"op13_source_audit": OP13_SQL, "op8_preferences": OP8_SQL, "op9_decontamination": OP9_SQL, "op1_secret_scan": _op1_sql(), "op3_url_filter": OP3_SQL}
