"""DuckDB SQL for the queries: the same results by independent means.

The SQL tokenises to rows and groups them; it shares no step with the array plans of the
package. RE2 has no back-references, so letter runs and letter pairs are written out.
"""

from __future__ import annotations

import json

from threadlens.wordlists import SENTIMENT_EN, stopwords

# The default settings as the key-sorted compact JSON that the stored hashes are taken of.
TOKEN_RULES = '"drop_numeric_tokens":true,"drop_stopwords":true,"lowercase":true,"min_token_len":2'
STOPWORD_RULES = '"stopwords_hash":"dummy","stopwords_lang":"en"'
STATS_JSON = f'{{{TOKEN_RULES},"normalization":"none",{STOPWORD_RULES},"top_n_tokens":30}}'
CORPUS_JSON = f'{{{TOKEN_RULES},"ngram_range":[1,1],"normalization":"none",{STOPWORD_RULES}}}'
KEYWORD_JSON = (
    '{"config":{"drop_numeric_tokens":true,"drop_stopwords":true,"idf_mode":"smooth_log_plus1_ln","lowercase":true,"max_df":0.9,"min_df":2,'
    '"min_ngram_df":2,"min_token_len":2,"ngram_range":[1,1],"normalization":"none","stopwords_hash":"dummy","stopwords_lang":"en",'
    '"tf_mode":"norm","top_k":30},"keywords_version":"v1"}'
)
STATS_HASH, CORPUS_HASH, KEYWORD_HASH = (f"left(sha256('{json}'), 16)" for json in (STATS_JSON, CORPUS_JSON, KEYWORD_JSON))

SPACES = r"\t-\r\x1c-\x20\x85\x{1680}\x{2028}\x{2029}"


def _words(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _clean(text: str) -> str:
    url = rf"(?i)https?://[^{SPACES}]+|www\.[^{SPACES}]+"
    marked = f"regexp_replace({text}, '{url}', '<URL>', 'g')"
    return f"trim(regexp_replace(lower({marked}), '[{SPACES}]+', ' ', 'g'))"


def _collapsed(text: str) -> str:
    for letter in "abcdefghijklmnopqrstuvwxyz":
        text = f"regexp_replace({text}, '{letter}{{3,}}', '{letter}{letter}', 'g')"
    return text


DOCS = f"""
docs AS (
  SELECT doc_id, lang AS channel_id, lang || '-' || source AS video_id, {_clean('text')} AS text_clean
  FROM documents)"""

CONVERSATIONS = f"""
docs AS (
  SELECT CAST(conv_id AS VARCHAR) AS video_id, conv_id || '-' || turn AS doc_id, role AS channel_id, turn,
         {_clean('text')} AS text_clean
  FROM conversations)"""

PLANTED = f"""
docs AS (
  SELECT conv_id || '-' || turn AS doc_id, role AS video_id,
         {_clean("CASE WHEN turn % 4 = 0 THEN text || ' great amazing setup' ELSE text END")} AS text_clean
  FROM conversations)"""

TOKENS = f"""
words AS (
  SELECT doc_id, unnest(w) AS token, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, regexp_extract_all({_collapsed('text_clean')}, '[a-z0-9_'']+') AS w FROM docs)),
tokens AS (
  SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place
  FROM words
  WHERE length(token) >= 2
    AND NOT regexp_full_match(token, '[0-9]+')
    AND token NOT IN ({_words(stopwords('en'))})
    AND NOT (length(token) >= 6 AND length(token) % 2 = 0 AND regexp_full_match(token, '[a-z]+')
             AND token = repeat(substr(token, 1, 2), CAST(length(token) // 2 AS INTEGER))))"""

STEMMED = """
features AS (SELECT doc_id, stem AS token FROM tokens JOIN stems USING (token))"""

UNIGRAMS = """
features AS (SELECT doc_id, token FROM tokens)"""

BIGRAMS = """
features AS (
  SELECT doc_id, token FROM tokens
  UNION ALL
  SELECT doc_id, token || ' ' || following
  FROM (SELECT doc_id, token, lead(token) OVER (PARTITION BY doc_id ORDER BY place) AS following FROM tokens)
  WHERE following IS NOT NULL)"""


# The published suffix rules, as SQL writes them: one step per line, each over the result of the one before. Suffixes are
# matched at the end of a word, so the leftmost match is the longest suffix.
STEP_2 = (
    "ational ate, tional tion, enci ence, anci ance, abli able, entli ent, izer ize, ization ize, ation ate, ator ate, alism al, aliti al,"
    " alli al, fulness ful, ousli ous, ousness ous, iveness ive, iviti ive, biliti ble, bli ble, ogi og, fulli ful, lessli less, li -"
)
STEP_3 = "ational ate, tional tion, alize al, icate ic, iciti ic, ical ic, ful -, ness -, ative -"
STEP_4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion"
IRREGULAR = (
    "skis ski, skies sky, dying die, lying lie, tying tie, idly idl, gently gentl, ugly ugli, early earli, only onli, singly singl, sky sky,"
    " news news, howe howe, atlas atlas, cosmos cosmos, bias bias, andes andes"
)
INVARIANT = "inning outing canning herring earring proceed exceed succeed"
SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"


def _rules(table: str) -> dict[str, str]:
    return {a: b.replace("-", "") for a, b in (rule.split() for rule in table.split(","))}


def _suffix(rules) -> str:
    return "(" + "|".join(sorted(rules, key=len, reverse=True)) + ")$"


def _map(rules: dict[str, str]) -> str:
    return "map {" + ", ".join(f"'{a}': '{b}'" for a, b in rules.items()) + "}"


def _stems(words: str) -> str:
    """``stems(token, stem)`` of the distinct tokens of a relation."""
    two, three, odd = _rules(STEP_2), _rules(STEP_3), _rules(IRREGULAR)
    region = "CASE WHEN regexp_matches({0}, '[aeiouy][^aeiouy]') THEN length(regexp_extract({0}, '^.*?[aeiouy][^aeiouy]')) ELSE length({0}) END"
    left = "left(w, length(w) - length(x))"
    return f"""
s0 AS (SELECT DISTINCT token FROM {words}),
s1 AS (SELECT token, regexp_replace(regexp_replace(token, '^''', ''), '(^|[aeiouy])y', '\\1Y', 'g') AS w FROM s0),
s2 AS (SELECT *, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)') THEN length(regexp_extract(w, '^(gener|commun|arsen)'))
                 ELSE {region.format('w')} END AS r1 FROM s1),
s3 AS (SELECT * EXCLUDE (w), r1 + {region.format('substr(w, r1 + 1)')} AS r2, regexp_replace(w, '''(s''?)?$', '') AS w FROM s2),
s4 AS (SELECT * EXCLUDE (w), CASE WHEN w LIKE '%sses' THEN left(w, -2)
         WHEN w LIKE '%ied' OR w LIKE '%ies' THEN CASE WHEN length(w) > 4 THEN left(w, -2) ELSE left(w, -1) END
         WHEN w LIKE '%s' AND NOT regexp_matches(w, '(us|ss)$') AND regexp_matches(left(w, greatest(length(w) - 2, 0)), '[aeiouy]')
         THEN left(w, -1) ELSE w END AS w FROM s3),
s5 AS (SELECT *, w IN ({_words(INVARIANT.split())}) AS done, regexp_extract(w, '(eedly|ingly|edly|eed|ing|ed)$') AS x FROM s4),
s6 AS (SELECT *, left(w, length(w) - length(x)) AS base FROM s5),
s7 AS (SELECT token, r1, r2, done, w AS kept, CASE WHEN done OR x = '' THEN w
         WHEN x LIKE 'eed%' THEN CASE WHEN length(base) >= r1 THEN base || 'ee' ELSE w END
         WHEN NOT regexp_matches(base, '[aeiouy]') THEN w
         WHEN regexp_matches(base, '(at|bl|iz)$') THEN base || 'e'
         WHEN regexp_matches(base, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(base, -1)
         WHEN length(base) <= r1 AND regexp_matches(base, '{SHORT}') THEN base || 'e' ELSE base END AS w FROM s6),
s8 AS (SELECT * EXCLUDE (w), CASE WHEN length(w) > 2 AND regexp_matches(w, '[^aeiouy][yY]$') THEN left(w, -1) || 'i' ELSE w END AS w FROM s7),
s9 AS (SELECT *, regexp_extract(w, '{_suffix(two)}') AS x FROM s8),
s10 AS (SELECT * EXCLUDE (w, x), CASE WHEN x <> '' AND length(w) - length(x) >= r1
          AND (x <> 'ogi' OR {left} LIKE '%l') AND (x <> 'li' OR regexp_matches({left}, '[cdeghkmnrt]$')) THEN {left} || {_map(two)}[x] ELSE w END AS w FROM s9),
s11 AS (SELECT *, regexp_extract(w, '{_suffix(three)}') AS x FROM s10),
s12 AS (SELECT * EXCLUDE (w, x), CASE WHEN x <> '' AND length(w) - length(x) >= CASE WHEN x = 'ative' THEN r2 ELSE r1 END
          THEN {left} || {_map(three)}[x] ELSE w END AS w FROM s11),
s13 AS (SELECT *, regexp_extract(w, '{_suffix(STEP_4.split())}') AS x FROM s12),
s14 AS (SELECT * EXCLUDE (w, x), CASE WHEN x <> '' AND length(w) - length(x) >= r2 AND (x <> 'ion' OR regexp_matches({left}, '[st]$')) THEN {left} ELSE w END AS w
        FROM s13),
s15 AS (SELECT * EXCLUDE (w), CASE WHEN w LIKE '%e' AND (length(w) - 1 >= r2 OR (length(w) - 1 >= r1 AND NOT regexp_matches(left(w, -1), '{SHORT}'))) THEN left(w, -1)
          WHEN w LIKE '%ll' AND length(w) - 1 >= r2 THEN left(w, -1) ELSE w END AS w FROM s14),
odd AS (SELECT {_map(odd)} AS m),
stems AS (SELECT token, CASE WHEN length(token) <= 2 THEN token WHEN token IN ({_words(odd)}) THEN m[token]
                        WHEN done THEN kept ELSE replace(w, 'Y', 'y') END AS stem FROM s15, odd)"""


def _stats(grain: str, n: str = "") -> str:
    """Totals (N, thresholds) and per-token sums of a grain."""
    return f""",
lengths{n} AS (SELECT doc_id, count(*) AS len FROM features GROUP BY doc_id),
totals{n} AS (
  SELECT {grain}, count(*) AS row_count, count(l.len) AS n_docs
  FROM docs LEFT JOIN lengths{n} l USING (doc_id) GROUP BY {grain}),
freq{n} AS (
  SELECT {grain}, token, count(*) AS df, sum(c * 1.0::DOUBLE / len) AS tf
  FROM (SELECT doc_id, token, count(*) AS c FROM features GROUP BY doc_id, token)
  JOIN lengths{n} USING (doc_id) JOIN docs USING (doc_id)
  GROUP BY {grain}, token)"""


CORPUS = """,
corpus AS (
  SELECT token, count(DISTINCT video_id) AS df_videos FROM features JOIN docs USING (doc_id) GROUP BY token),
corpus_size AS (SELECT count(DISTINCT video_id) AS n_videos FROM docs)"""


def _scored(grain: str, with_corpus: bool = False, n: str = "") -> str:
    keys = ", ".join(f"f.{g.strip()}" for g in grain.split(","))
    join = " AND ".join(f"f.{g.strip()} = t.{g.strip()}" for g in grain.split(","))
    df, size, source = ("f.df", "n_docs", "") if not with_corpus else (
        "coalesce(k.df_videos, 0)", "(SELECT n_videos FROM corpus_size)", "LEFT JOIN corpus k ON f.token = k.token")
    return f""",
scored{n} AS (
  SELECT *, avg_tf * idf AS score FROM (
    SELECT {keys}, f.token, {df} AS df, f.tf / n_docs AS avg_tf,
           ln((1.0 + {size}) / (1.0 + {df}))::DOUBLE + 1.0 AS idf
    FROM freq{n} f JOIN totals{n} t ON {join} {source}
    WHERE {df} >= 2 AND {df} <= CAST(floor(0.9::DOUBLE * {size}) AS BIGINT)))"""


SENTIMENT = f"NOT list_has_any(string_split(token, ' '), [{_words(SENTIMENT_EN)}])"


def _ranked(grain: str, n: str = "", sentiment: str = SENTIMENT) -> str:
    return f""",
ranked{n} AS (
  SELECT *, row_number() OVER (PARTITION BY {grain} ORDER BY round(score, 12) DESC, df DESC, token) AS rank
  FROM scored{n} WHERE {sentiment} QUALIFY rank <= 30)"""


def _keywords(grain: str, docs: str = DOCS, features: str = UNIGRAMS, with_corpus: bool = False,
              sentiment: str = SENTIMENT, digits: int = 6) -> str:
    return (
        f"WITH {docs}, {TOKENS}, {features}{_stats(grain)}{CORPUS if with_corpus else ''}"
        f"{_scored(grain, with_corpus)}{_ranked(grain, sentiment=sentiment)}"
        f" SELECT {grain}, rank, token, round(score, {digits}) AS score, round(idf, {digits}) AS idf,"
        f" round(avg_tf, {digits}) AS avg_tf, CAST(df AS BIGINT) AS df FROM ranked"
    )


def _counts(grain: str) -> str:
    return (f"WITH {DOCS}, {TOKENS} SELECT {grain}, token, count(*) AS count"
            f" FROM tokens JOIN docs USING (doc_id) GROUP BY {grain}, token")


def _token_stats(grain: str, tie: str, docs: str = DOCS, arrival: str = "doc_id") -> str:
    return f"""WITH {docs}, {TOKENS},
c AS (SELECT {grain}, token, count(*) AS n, min({arrival}) AS d, arg_min(place, {arrival} * 1000000 + place) AS p
      FROM tokens JOIN docs USING (doc_id) GROUP BY {grain}, token),
r AS (SELECT *, row_number() OVER (PARTITION BY {grain} ORDER BY n DESC, {tie}) AS rank FROM c),
top AS (SELECT {grain}, string_agg(token || ':' || n, ' ' ORDER BY rank) AS top_tokens
        FROM r WHERE rank <= 30 GROUP BY {grain}),
sizes AS (SELECT {grain}, CAST(sum(n) AS BIGINT) AS total_token_count, count(*) AS unique_token_count
          FROM c GROUP BY {grain}),
totals AS (SELECT {grain}, count(*) AS row_count,
                  count(*) FILTER (WHERE text_clean IS NULL OR text_clean = '') AS empty_text_count
           FROM docs GROUP BY {grain})
SELECT {grain}, row_count, empty_text_count, coalesce(total_token_count, 0) AS total_token_count,
       coalesce(unique_token_count, 0) AS unique_token_count, coalesce(top_tokens, '') AS top_tokens
FROM totals LEFT JOIN sizes USING ({grain}) LEFT JOIN top USING ({grain})"""


def _summary(grain: str, features: str, ngram_rule: str = "true") -> str:
    return f"""WITH {DOCS}, {TOKENS}, {features}{_stats(grain)}{_scored(grain)},
vocabulary AS (SELECT * FROM scored WHERE {ngram_rule}),
v AS (SELECT {grain}, count(*) AS vocab_size FROM vocabulary GROUP BY {grain}),
listed AS (SELECT *, row_number() OVER (PARTITION BY {grain} ORDER BY round(score, 12) DESC, df DESC, token) AS rank
           FROM vocabulary WHERE {SENTIMENT} QUALIFY rank <= 30),
k AS (SELECT {grain}, count(*) AS keyword_count, string_agg(token || ':' || df, ' | ' ORDER BY rank) AS keywords
      FROM listed GROUP BY {grain})
SELECT {grain}, 'tfidf_v2_1' AS artifact_version, row_count, row_count - n_docs AS empty_text_count,
       n_docs AS doc_count_non_empty, coalesce(vocab_size, 0) AS vocab_size,
       CASE WHEN n_docs > 0 THEN 2 ELSE 1 END::BIGINT AS min_df_abs,
       CASE WHEN n_docs > 0 THEN least(CAST(floor(0.9::DOUBLE * n_docs) AS BIGINT), n_docs) ELSE 0 END AS max_df_abs,
       CAST(coalesce(keyword_count, 0) AS BIGINT) AS keyword_count, coalesce(keywords, '') AS keywords
FROM totals LEFT JOIN v USING ({grain}) LEFT JOIN k USING ({grain})"""


def _threshold_rows() -> str:
    settings = {
        "count": ("2", "50"),
        "share": ("CAST(ceil(0.05::DOUBLE * n_docs) AS BIGINT)", "CAST(floor(0.9::DOUBLE * n_docs) AS BIGINT)"),
        "one": ("1", "n_docs"),
        "below": ("0", "CAST(floor(0.5::DOUBLE * n_docs) AS BIGINT)"),
    }
    rows = [
        f"SELECT video_id, '{name}' AS setting, n_docs AS idf_documents,"
        f" CASE WHEN n_docs > 0 THEN {low} ELSE 1 END::BIGINT AS min_df_abs,"
        f" CASE WHEN n_docs > 0 THEN least({high}, n_docs) ELSE 0 END::BIGINT AS max_df_abs FROM totals"
        for name, (low, high) in settings.items()
    ]
    return f"WITH {DOCS}, {TOKENS}, {UNIGRAMS}{_stats('video_id')} " + " UNION ALL ".join(rows)


def _lifted(with_corpus: bool, docs: str = DOCS) -> str:
    pair = "channel_id, video_id"
    return f"""WITH {docs}, {TOKENS}, {UNIGRAMS}{CORPUS if with_corpus else ''}
{_stats(pair, '_v')}{_stats('channel_id', '_c')}
{_scored(pair, with_corpus, '_v')}{_scored('channel_id', with_corpus, '_c')}
{_ranked(pair, '_v')}{_ranked('channel_id', '_c')},
lifted AS (
  SELECT v.channel_id, v.video_id, v.token, v.score AS video_score, coalesce(c.score, 0) AS channel_score,
         v.df AS video_df, coalesce(c.df, 0) AS channel_df,
         CASE WHEN coalesce(c.score, 0) = 0 THEN 'inf'::DOUBLE ELSE v.score / c.score END AS lift
  FROM ranked_v v LEFT JOIN ranked_c c ON v.channel_id = c.channel_id AND v.token = c.token),
distinctive AS (
  SELECT *, row_number() OVER (PARTITION BY channel_id, video_id
    ORDER BY CASE WHEN isinf(lift) THEN lift ELSE round(lift, 12) END DESC, round(video_score, 12) DESC, token) AS rank
  FROM lifted QUALIFY rank <= 30)"""


def _distinctive(with_corpus: bool, docs: str = DOCS) -> str:
    return _lifted(with_corpus, docs) + """
SELECT channel_id, video_id, rank, token, round(video_score, 6) AS video_score,
       round(channel_score, 6) AS channel_score,
       CASE WHEN isinf(lift) THEN lift ELSE round(lift, 6) END AS lift,
       CAST(video_df AS BIGINT) AS video_df, CAST(channel_df AS BIGINT) AS channel_df
FROM distinctive"""


def _report(docs: str, errors: str, after: str, stats_hash: str, keyword_hash: str) -> str:
    """Report lines of all channels without their distinctive keywords, which ``distinctive`` holds."""
    return _lifted(False, docs) + f""",
top_tokens AS (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY n DESC, token) AS rank
  FROM (SELECT channel_id, token, count(*) AS n FROM tokens JOIN docs USING (doc_id) GROUP BY channel_id, token)
  QUALIFY rank <= 30),
runs AS (
  SELECT channel_id, count(DISTINCT video_id) AS videos, count(*) AS comments,
         {errors} AS errors FROM docs GROUP BY channel_id),
head AS (
  SELECT channel_id, unnest([
    'channel_id: ' || channel_id,
    'latest_run: videos=' || videos || ' | comments=' || comments || ' | errors=' || errors,
    'run_window: after={after} | before=N/A',
    'artifacts: preprocess_version=v1 | stats_config=' || {stats_hash} || ' | tfidf_config=' || {keyword_hash}
  ]) AS line, unnest([1, 2, 3, 4]) AS rank
  FROM runs)
SELECT channel_id, NULL::VARCHAR AS video_id, 'head' AS section, CAST(rank AS BIGINT) AS rank,
       NULL::VARCHAR AS token, line FROM head
UNION ALL
SELECT channel_id, NULL, 'top_tokens', rank, token, ' ' || lpad(rank::VARCHAR, 2, ' ') || '. '
       || CASE WHEN length(token) < 15 THEN rpad(token, 15, ' ') ELSE token END || ' count=' || n
FROM top_tokens
UNION ALL
SELECT channel_id, NULL, 'top_keywords', rank, token, ' ' || lpad(rank::VARCHAR, 2, ' ') || '. '
       || CASE WHEN length(token) < 15 THEN rpad(token, 15, ' ') ELSE token END
       || ' score=' || printf('%.3f', score) || ' df=' || df
FROM ranked_c"""


REPORT = _report(DOCS, "count(*) FILTER (WHERE text_clean IS NULL OR text_clean = '')", "2024-01-05 00:00 UTC", STATS_HASH, KEYWORD_HASH) + """
UNION ALL
SELECT channel_id, video_id, 'distinctive_keywords', rank, token, ' ' || lpad(rank::VARCHAR, 2, ' ') || '. '
       || CASE WHEN length(token) < 15 THEN rpad(token, 15, ' ') ELSE token END
       || ' lift=' || CASE WHEN isinf(lift) THEN 'inf' ELSE printf('%.3f', lift) END
       || ' video_df=' || video_df || ' channel_df=' || channel_df
FROM distinctive
UNION ALL
SELECT DISTINCT source, NULL, 'absent', 0, NULL, 'no stored token statistics, keywords' FROM documents"""

RAW = """
raw AS (
  SELECT CAST(conv_id AS VARCHAR) AS video_id, conv_id || '-' || turn AS comment_id, text, turn,
         CASE WHEN turn % 2 = 0 THEN role END AS author,
         CASE WHEN turn % 4 <> 0 THEN turn END AS like_count,
         CASE WHEN turn % 3 = 1 THEN TIMESTAMP '2026-01-01 10:00:00' + to_minutes(CAST(turn % 60 AS INTEGER))
              WHEN turn % 3 = 2 THEN TIMESTAMP '2026-01-01 10:00:00' + to_minutes(CAST(turn % 60 AS INTEGER))
         END AS published_at,
         CASE WHEN turn % 5 <> 0 THEN turn % 2 = 1 END AS is_reply
  FROM conversations)"""

CLEAN_ROWS = f"""WITH {RAW}
SELECT video_id, comment_id, coalesce(author, '') AS author,
       coalesce(published_at, TIMESTAMP '1970-01-01 00:00:00') AS published_at,
       CAST(coalesce(like_count, 0) AS BIGINT) AS like_count, coalesce(is_reply, false) AS is_reply,
       {_clean('text')} AS text_clean, 'v1' AS preprocess_version FROM raw"""

PAGES = """
flat AS (
  SELECT CAST(conv_id AS VARCHAR) AS video_id, conv_id || '-' || turn AS comment_id, text, role AS author,
         CAST(turn AS BIGINT) AS like_count, TIMESTAMP '2026-01-01 12:34:56' AS published_at, false AS is_reply,
         CAST(turn // 2 AS BIGINT) AS page_no,
         row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn) - 1 AS item_no
  FROM conversations)"""

REFS = """
forms AS (
  SELECT page_id, url, page_id::VARCHAR AS p, 'id_' || page_id AS vid, lpad(page_id::VARCHAR, 22, '0') AS wide FROM pages),
refs AS (
  SELECT page_id, unnest(range(12)) AS form, unnest([url, '   ' || vid || '   ', 'https://youtu.be/' || vid || '?t=5',
    'https://www.youtube.com/watch?list=a&v=' || vid || '%2B&t=1#x', 'https://youtube.com/shorts/' || vid || '/more',
    'https://www.youtube.com/embed/' || vid || ';p=1', 'UC' || wide, 'https://WWW.YouTube.com//channel/UC' || wide,
    '@Name_' || p, 'http://m.youtube.com/@name.' || p || '/videos', 'https://youtube.com/user/User' || p,
    'https://youtube.com/channel/short' || p]) AS raw_ref, vid, wide, p
  FROM forms)"""

RESOLUTIONS = """
resolutions AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN '@User_' || user_id ELSE 'https://www.youtube.com/@user_' || user_id END AS raw_ref,
         '@user_' || user_id AS input_ref, 'c' || event_id AS channel_id, ts AS resolved_at_utc
  FROM events)"""

LATEST_REF = """SELECT input_ref, channel_id, resolved_at_utc FROM {} QUALIFY
  row_number() OVER (PARTITION BY input_ref ORDER BY resolved_at_utc DESC, channel_id) = 1"""

STATUS = """
status AS (
  SELECT 'c' || user_id AS channel_id, 'v' || event_id AS video_id, CAST(floor(value) AS BIGINT) AS comment_count,
         event_type = 'error' AS failed FROM events)"""

ARTIFACTS = f"""WITH {DOCS}, {TOKENS}, {UNIGRAMS}{_stats('video_id')}{_scored('video_id')}{_ranked('video_id')},
sizes AS (SELECT video_id, count(*) AS vocab_size FROM scored GROUP BY video_id)
SELECT video_id, {KEYWORD_HASH} AS config_hash, vocab_size, '2' AS min_df_raw,
       '0.9' AS max_df_raw, rank, token, round(score, 6) AS score, round(avg_tf, 6) AS avg_tf,
       round(idf, 6) AS idf, df
FROM ranked JOIN sizes USING (video_id)"""

NGRAM_RULE = "token NOT LIKE '% %' OR df >= 2"

JOB_DOCS = CONVERSATIONS.replace("role AS channel_id", "'c' || (conv_id % 10) AS channel_id")
# Jobs stamp the hash of the stopword list into their settings.
STOPWORDS_HASH = "left(sha256('" + json.dumps(stopwords("en"), separators=(",", ":")).replace("'", "''") + "'), 16)"
STAMPED = [f"left(sha256(replace('{x}', 'dummy', {STOPWORDS_HASH})), 16)" for x in (STATS_JSON, KEYWORD_JSON)]

ORACLES: dict[str, str] = {
    "clean_text": f"SELECT doc_id, {_clean('text')} AS text_clean FROM documents",
    "clean_comments": CLEAN_ROWS.replace("'v1' AS preprocess_version", "'v1' AS preprocess_version, text AS text_raw"),
    "token_counts_video": _counts("video_id"),
    "token_counts_channel": _counts("channel_id"),
    "token_stats_video": _token_stats("video_id", "d, p"),
    "token_stats_channel": _token_stats("channel_id", "token"),
    "token_grouping_sets": f"""WITH {DOCS}, {TOKENS}
SELECT CASE WHEN grouping(video_id) = 0 THEN 'video' WHEN grouping(channel_id) = 0 THEN 'channel' ELSE 'all' END AS level,
       coalesce(video_id, channel_id) AS key, token, count(*) AS count
FROM tokens JOIN docs USING (doc_id)
GROUP BY GROUPING SETS ((video_id, token), (channel_id, token), (token))""",
    "ngrams": f"""WITH {CONVERSATIONS}, {TOKENS},
grams AS (
  SELECT doc_id, place, token, 1 AS words FROM tokens
  UNION ALL SELECT doc_id, place, token || ' ' || b, 2 FROM
    (SELECT *, lead(token) OVER w AS b FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY place)) WHERE b IS NOT NULL
  UNION ALL SELECT doc_id, place, token || ' ' || b || ' ' || c, 3 FROM
    (SELECT *, lead(token) OVER w AS b, lead(token, 2) OVER w AS c FROM tokens
     WINDOW w AS (PARTITION BY doc_id ORDER BY place)) WHERE c IS NOT NULL)
SELECT doc_id AS comment_id, row_number() OVER (PARTITION BY doc_id ORDER BY words, place) - 1 AS position, token,
       CAST(words AS BIGINT) AS words FROM grams""",
    "tfidf_video": _keywords("video_id"),
    "tfidf_channel": _keywords("channel_id"),
    "tfidf_bigrams": _keywords("video_id", features=BIGRAMS),
    "tfidf_keep_sentiment": _keywords("video_id", PLANTED, BIGRAMS, sentiment="true").replace(
        "SELECT video_id, rank", "SELECT video_id AS role, rank"),
    "tfidf_no_sentiment": _keywords("video_id", PLANTED, BIGRAMS).replace(
        "SELECT video_id, rank", "SELECT video_id AS role, rank"),
    "keyword_summary_video": _summary("video_id", UNIGRAMS),
    "tfidf_stemmed": _keywords("video_id", features=f"{_stems('tokens')}, {STEMMED}"),
    "stem_vocabulary": f"WITH {DOCS}, {TOKENS}, {_stems('tokens')} SELECT token, stem FROM stems",
    "keyword_summary_channel": _summary("channel_id", BIGRAMS, NGRAM_RULE),
    "df_thresholds": _threshold_rows(),
    "corpus_df": f"WITH {DOCS}, {TOKENS}, {BIGRAMS}{CORPUS} SELECT token, df_videos FROM corpus",
    "tfidf_video_corpus": _keywords("video_id", with_corpus=True),
    "tfidf_channel_corpus": _keywords("channel_id", with_corpus=True),
    "distinctive_keywords": _distinctive(False),
    "distinctive_keywords_corpus": _distinctive(True),
    "flatten_comment_pages": f"WITH {PAGES} SELECT * FROM flat",
    "flatten_video_pages": """SELECT 'v' || event_id AS video_id, 'c' || user_id AS channel_id, event_type AS title,
       ts AS published_at, NULL::VARCHAR AS view_count FROM events""",
    "page_quarantine": """SELECT 'v' || event_id AS video_id, 'c0' AS channel_id, 'video of another channel' AS reason
FROM events WHERE (event_id // 50) % 2 = 1 AND user_id <> 0""",
    "cap_comments": f"""WITH {PAGES} SELECT video_id, comment_id, page_no, item_no FROM flat
QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY page_no, item_no) <= 3""",
    "discover_videos": """SELECT 'c' || user_id AS channel_id, 'v' || event_id AS video_id, event_type AS title, ts AS published_at
FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, 'v' || event_id) <= 10""",
    "run_summary": f"""WITH {STATUS} SELECT channel_id, count(*) AS video_count,
       coalesce(string_agg(video_id, ' ' ORDER BY video_id) FILTER (WHERE NOT failed), '') AS video_ids,
       CAST(coalesce(sum(comment_count) FILTER (WHERE NOT failed), 0) AS BIGINT) AS comment_count,
       count(*) FILTER (WHERE failed) AS error_count FROM status GROUP BY channel_id""",
    "preprocess_totals": f"""WITH {STATUS} SELECT channel_id, count(*) AS video_count,
       count(*) FILTER (WHERE NOT failed) AS processed_count, count(*) FILTER (WHERE failed) AS error_count,
       CAST(CASE WHEN bool_or(failed) THEN 1 ELSE 0 END AS BIGINT) AS exit_code FROM status GROUP BY channel_id""",
    "latest_runs": """SELECT 'c' || user_id AS channel_id, ts AS finished_at_utc, 'v' || event_id AS video_id,
       CAST(floor(value) AS BIGINT) AS comment_count, CAST(event_type = 'error' AS BIGINT) AS error_count
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""",
    "upsert_refs": f"WITH {RESOLUTIONS} " + LATEST_REF.format("resolutions"),
    "resolve_refs": f"""WITH {RESOLUTIONS},
early AS (SELECT * FROM resolutions WHERE resolved_at_utc < TIMESTAMP '2024-01-05'),
mapping AS ({LATEST_REF.format('early')})
SELECT r.raw_ref, coalesce(m.channel_id, r.raw_ref) AS channel_id, m.channel_id IS NOT NULL AS resolved
FROM (SELECT DISTINCT raw_ref, input_ref FROM resolutions) r LEFT JOIN mapping m USING (input_ref)""",
    "normalize_video_refs": f"""WITH {REFS}
SELECT page_id, form, raw_ref, CASE form WHEN 1 THEN vid WHEN 2 THEN vid WHEN 3 THEN vid || '+' WHEN 4 THEN vid
  WHEN 5 THEN vid ELSE trim(raw_ref) END AS video_id FROM refs""",
    "normalize_channel_refs": f"""WITH {REFS}
SELECT page_id, form, raw_ref,
  CASE WHEN form IN (6, 7) THEN 'channel_id' WHEN form IN (8, 9) THEN 'handle' WHEN form = 10 THEN 'username' END AS kind,
  CASE WHEN form IN (6, 7) THEN 'UC' || wide WHEN form = 8 THEN '@Name_' || p WHEN form = 9 THEN '@name.' || p
       WHEN form = 10 THEN 'User' || p END AS value,
  CASE WHEN form IN (6, 7) THEN 'UC' || wide WHEN form = 8 THEN '@name_' || p WHEN form = 9 THEN '@name.' || p
       WHEN form = 10 THEN 'user' || p END AS input_ref
FROM refs""",
    "version_guard": """SELECT video_id, count(DISTINCT v) AS versions, min(v) AS lowest, max(v) AS highest,
  CASE count(DISTINCT v) WHEN 0 THEN 'missing' WHEN 1 THEN 'single' ELSE 'mixed' END AS verdict
FROM (SELECT lang || '-' || source AS video_id,
             CASE WHEN source LIKE '%0' THEN NULL WHEN doc_id % 40 = 0 THEN 'v0' ELSE 'v1' END AS v FROM documents)
GROUP BY video_id""",
    "missing_videos": """SELECT lang AS channel_id, lang || '-' || source AS video_id FROM documents
GROUP BY lang, source HAVING count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) = 0""",
    "tfidf_channel_members": _keywords("channel_id", DOCS.replace("lang AS channel_id", "source AS channel_id")),
    "channel_comments": """SELECT doc_id, lang || '-' || source AS video_id, source AS channel_id FROM documents""",
    "lift_guard": """SELECT channel_id, video_id, CASE WHEN channel_id = 'fr' THEN 'no channel artifact'
  WHEN d % 3 = 0 THEN 'preprocess_version differs' WHEN d % 5 = 0 THEN 'config_hash differs'
  ELSE 'video not in channel' END AS reason
FROM (SELECT lang AS channel_id, source, lang || '-' || source AS video_id, max(doc_id) AS d FROM documents GROUP BY ALL)
WHERE channel_id = 'fr' OR d % 3 = 0 OR d % 5 = 0 OR source = 'src7'""",
    "channel_report": REPORT,
    "raw_round_trip": f"""WITH {RAW} SELECT video_id, comment_id, text, author, CAST(like_count AS BIGINT) AS like_count,
       published_at, coalesce(is_reply, false) AS is_reply, CAST(turn AS BIGINT) AS arrival FROM raw""",
    "clean_round_trip": CLEAN_ROWS,
    "corpus_round_trip": f"""WITH {DOCS}, {TOKENS}, {UNIGRAMS}{CORPUS}
SELECT token, df_videos, n_videos AS video_count, {CORPUS_HASH} AS config_hash
FROM corpus, corpus_size""",
    "artifact_round_trip": ARTIFACTS,
    "run_log": """SELECT 'c' || user_id AS channel_id, ts AS finished_at_utc, CAST(floor(value) AS BIGINT) AS comment_count
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""",
    "stream_clean": CLEAN_ROWS,
    "stream_quarantine": """SELECT conv_id || '-' || turn || CASE WHEN turn % 7 = 3 THEN ' cut {"video_id' ELSE '' END AS line,
       CASE WHEN turn % 7 = 3 THEN 'not a JSON comment record' END AS reason FROM conversations""",
    "stream_tfidf": _keywords("video_id"),
    "stream_redelivered": f"""WITH {CONVERSATIONS}, {TOKENS}
SELECT video_id, token, 0::BIGINT AS docs, count(DISTINCT doc_id) AS df, count(*) AS count
FROM tokens JOIN docs USING (doc_id) GROUP BY video_id, token
UNION ALL
SELECT video_id, NULL, count(DISTINCT d.doc_id), count(DISTINCT t.doc_id), 0 FROM docs d LEFT JOIN tokens t USING (doc_id) GROUP BY video_id""",
    "stream_df_upsert": f"WITH {CONVERSATIONS}, {TOKENS}, {BIGRAMS}{CORPUS} SELECT token, df_videos FROM corpus",
    "stream_run_log": """SELECT 'c' || user_id AS channel_id, ts AS finished_at_utc, CAST(floor(value) AS BIGINT) AS comment_count
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""",
    "job_ingest_pages": f"""WITH {PAGES} SELECT video_id, comment_id, text, like_count FROM flat
QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY page_no, item_no) <= 3""",
    "job_preprocess": f"""SELECT CAST(conv_id AS VARCHAR) AS video_id, conv_id || '-' || turn AS comment_id, role AS author,
       {_clean('text')} AS text_clean, 'v1' AS preprocess_version FROM conversations""",
    "job_video_stats": _token_stats("video_id", "d, p", JOB_DOCS, "turn"),
    "job_video_keywords": _keywords("video_id", JOB_DOCS, digits=9),
    "job_artifact_sources": """SELECT kind, CAST(conv_id AS VARCHAR) AS video_id, count(*) AS comments
FROM conversations, (VALUES ('token_stats'), ('tfidf')) AS k(kind) GROUP BY ALL""",
    "job_corpus": f"WITH {JOB_DOCS}, {TOKENS}, {UNIGRAMS}{CORPUS} SELECT token, df_videos, n_videos AS video_count FROM corpus, corpus_size",
    "job_ingest_channels": """SELECT 'c' || (conv_id % 10) AS channel_id, count(DISTINCT conv_id) AS listed, count(DISTINCT conv_id) AS video_count,
       count(*) AS comment_count, 0::BIGINT AS error_count FROM conversations GROUP BY 1""",
    "job_preprocess_channels": """WITH v AS (SELECT DISTINCT conv_id, 'c' || (conv_id % 10) AS channel_id FROM conversations)
SELECT channel_id, count(*) AS video_count, count(*) FILTER (WHERE conv_id % 7 <> 3) AS processed_count,
       count(*) FILTER (WHERE conv_id % 7 = 3) AS error_count, CAST(bool_or(conv_id % 7 = 3) AS BIGINT) AS exit_code FROM v GROUP BY channel_id
UNION ALL SELECT NULL, 0, 0, count(*), 1 FROM v WHERE conv_id % 10 = 1""",
    "job_channel_stats": _token_stats("channel_id", "token", JOB_DOCS, "turn"),
    "job_channel_keywords": _keywords("channel_id", JOB_DOCS, digits=9),
    "job_distinctive": _distinctive(False, JOB_DOCS),
    "job_report": _report(JOB_DOCS, "0", "N/A", *STAMPED),
    "stream_corpus_df": f"WITH {DOCS}, {TOKENS}, {UNIGRAMS}{CORPUS} SELECT token, df_videos FROM corpus",
}

ORACLES["job_list_videos"] = ORACLES["discover_videos"]
