"""The registered queries in DuckDB SQL, over the same stored tables."""

from __future__ import annotations

from ..functions import stem, stopwords, text
from ..operators.articles import hit_limit
from .queries import NEWEST, TOPIC


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


ENGLISH = _quoted(stopwords.ENGLISH)
SHORT = _quoted(stopwords.SHORT)

# --- shared pieces ------------------------------------------------------------------------------

ARTICLES = "SELECT doc_id, lang, split_part(text, chr(10), 1) AS title, text AS article FROM documents"
WORDS = "regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
WORD = WORDS.format(c="text")
# Trailing empty tokens go; a text of blanks only has no tokens at all.
WHITESPACE = """CASE WHEN text <> '' AND regexp_matches(text, '^[ \\t\\n\\x0B\\f\\r]+$') THEN []::VARCHAR[]
    ELSE string_split_regex(regexp_replace(lower(text), '[ \\t\\n\\x0B\\f\\r]+$', ''),
                            '[ \\t\\n\\x0B\\f\\r]') END"""
SCRIPT = "regexp_extract_all(text, '{}')".format(
    "|".join(f"[^\\P{{{name}}}\\s\\p{{Z}}\\x{{85}}]+" for name in text.SCRIPTS)
)
SCRIPT_LOWER = SCRIPT.replace("(text,", "(lower(text),")


def _without(tokens: str, words: str, fold: str = "lower(w)") -> str:
    return f"list_filter({tokens}, lambda w: {fold} NOT IN ({words}))"


def _pairs(tokens: str) -> str:
    """Neighbouring tokens; ``tokens`` is a column."""
    return (
        f"list_transform(range(1, len({tokens})), "
        f"lambda i: {tokens}[i] || ' ' || {tokens}[i + 1])"
    )


def _token_report(tokens: str) -> str:
    return f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(t, '|') AS tokens
FROM (SELECT doc_id, {tokens} AS t FROM documents)"""


def _tf(tokens: str, source: str = "documents") -> str:
    return f"""SELECT doc_id, term, count(*) AS tf
FROM (SELECT doc_id, unnest({tokens}) AS term FROM {source}) GROUP BY doc_id, term"""


def _tfidf(tokens: str, idf: str, l2: bool = False) -> str:
    weight = f"CAST(tf AS DOUBLE) * ({idf})"
    final = "w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))" if l2 else "w"
    return f"""WITH tf AS ({_tf(tokens)}),
d AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY term),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
x AS (SELECT doc_id, term, {weight} AS w FROM tf JOIN d USING (term) CROSS JOIN n)
SELECT doc_id, term, round({final}, 6) AS weight FROM x"""


LOG1P = "ln(CAST(1 AS DOUBLE) + n / (CAST(1 AS DOUBLE) + df))"
SMOOTH = "ln((CAST(1 AS DOUBLE) + n) / (CAST(1 AS DOUBLE) + df)) + CAST(1 AS DOUBLE)"
SPARK = "ln((n + CAST(1 AS DOUBLE)) / (df + CAST(1 AS DOUBLE)))"


ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def _plain(html: str) -> str:
    out = f"regexp_replace({html}, '<[^>]*>', ' ', 'g')"
    for entity, char in ENTITIES.items():
        out = f"replace({out}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({out}, '[ \\t\\n\\f\\r]+', ' ', 'g'))"


TITLE = _plain("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
BODY_PATTERN = "'(?is)<article[^>]*>(.*?)</article>'"
BODY = (
    f"CASE WHEN regexp_matches(html, {BODY_PATTERN}) "
    f"THEN {_plain(f'regexp_extract(html, {BODY_PATTERN}, 1)')} END"
)

def _elements(names: str) -> str:
    return "|".join(f"<{n}\\b[^>]*>.*?(?:</{n}\\s*>|\\z)" for n in names.split())


# Blocks of pages, each with its score; the best run by sums of all scores before a block.
BLOCKS = f"""SELECT page_id, block, pos,
  CASE WHEN words = 0 THEN 0 ELSE outside - 3 * (words - outside) - tags - 15 END AS score FROM (
  SELECT page_id, block, pos, len(block) - len(replace(block, '<', '')) AS tags,
    len(regexp_extract_all(regexp_replace(block, '<[^>]*>', ' ', 'g'), '[^ \\t\\n\\f\\r]+')) AS words,
    len(regexp_extract_all(regexp_replace(regexp_replace(block, '(?is)<a\\b[^>]*>.*?(?:</a\\s*>|\\z)', ' ', 'g'),
      '<[^>]*>', ' ', 'g'), '[^ \\t\\n\\f\\r]+')) AS outside
  FROM (SELECT page_id, unnest(bs) AS block, generate_subscripts(bs, 1) AS pos FROM (
    SELECT page_id, string_split_regex(
      regexp_replace(regexp_replace(regexp_replace(html, '(?i)<(/?)article', '<\\1div', 'g'),
        '(?is)<!--.*?(?:-->|\\z)|{_elements("script style template noscript")}', ' ', 'g'),
        '(?is){_elements("title nav footer aside")}', ' ', 'g'),
      '(?i)</?(?:address|article|blockquote|body|br|center|dd|div|dl|dt|fieldset|figcaption|figure|form|h[1-6]|head|header|hr|html|li|main|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|tr|ul)\\b[^>]*>') AS bs
    FROM pages)))"""
BEST_RUN = f"""WITH b AS ({BLOCKS}),
s AS (SELECT *, sum(score) OVER (PARTITION BY page_id ORDER BY pos) AS upto FROM b),
r AS (SELECT *, min((upto - score) * 1000000 - pos) OVER (PARTITION BY page_id ORDER BY pos) AS low FROM s),
e AS (SELECT page_id, pos AS stop, upto, CAST(ceil(low / 1000000.0) AS BIGINT) AS base, low FROM r
  QUALIFY row_number() OVER (PARTITION BY page_id
    ORDER BY upto - CAST(ceil(low / 1000000.0) AS BIGINT) DESC, pos) = 1)
SELECT b.page_id, string_agg(block, ' ' ORDER BY pos) AS html
FROM b JOIN e ON b.page_id = e.page_id AND pos <= stop AND pos >= base * 1000000 - low
WHERE upto > base GROUP BY b.page_id"""
HITS = f"""SELECT page_id AS rank, {TITLE} AS title, url,
  regexp_extract(html, '(?i)<html[^>]* lang="([a-z]+)', 1) AS lang
FROM pages WHERE regexp_extract(html, '(?i)<html[^>]* lang="([a-z]+)', 1) = 'en'
  AND TIMESTAMP '{NEWEST}' - to_hours(CAST(length(html) % 336 AS INTEGER))
      >= TIMESTAMP '{NEWEST}' - INTERVAL 7 DAY"""
# Every URL with the text of its newest page.
TEXTS = f"""SELECT url AS page_url, {BODY} AS article FROM pages
QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id DESC) = 1"""


def _looked_up(hits: str) -> str:
    return f"SELECT * FROM ({hits}) JOIN ({TEXTS}) ON trim(url) = page_url"


TOPIC_HITS = f"SELECT * FROM ({HITS}) WHERE contains(lower(title), '{TOPIC}')"

PLAIN_JSON = "CAST(json_object('title', title, 'article', article) AS VARCHAR)"

LINES = "string_split(text, chr(10))"
HEADLINE_ROWS = f"""SELECT doc_id, strftime(DATE '2014-07-01' + CAST(doc_id % 365 AS INTEGER), '%Y%m%d') AS "Date",
  quality AS "Label", {LINES} AS lines FROM documents JOIN labels USING (doc_id)"""


def _cell(i: int) -> str:
    if i < 25:
        return f"lines[{i}]"
    return "CASE WHEN len(lines) >= 25 THEN array_to_string(lines[25:], ' ') END"


def _cells(wrap: str = "{}") -> str:
    return ", ".join(
        "coalesce({}, 'nan')".format(wrap.format(_cell(i))) for i in range(1, 26)
    )


RAW_TEXT = f"concat_ws(' ', {_cells()})"
CLEAN = "lower(regexp_replace({}, '[^a-zA-Z]', ' ', 'g'))"
CLEAN_TEXT = f"concat_ws(' ', {_cells(CLEAN)})"
TRAIN_TEST = f"""SELECT doc_id, "Label", {CLEAN_TEXT} AS article, 'train' AS part
FROM ({HEADLINE_ROWS}) WHERE "Date" < '20150101'
UNION ALL SELECT doc_id, "Label", {RAW_TEXT} AS article, 'test' AS part
FROM ({HEADLINE_ROWS}) WHERE "Date" > '20141231'"""

EVAL = """SELECT doc_id, quality AS label, CAST(n_chars > 1500 AS INTEGER) AS prediction
FROM documents JOIN labels USING (doc_id)"""
REPORT = f"""SELECT c AS class,
  coalesce(CAST(hits AS DOUBLE) / nullif(predicted, 0), 0) AS precision,
  coalesce(CAST(hits AS DOUBLE) / nullif(support, 0), 0) AS recall,
  coalesce(CAST(2 * hits AS DOUBLE) / nullif(support + predicted, 0), 0) AS f1, support
FROM (SELECT c, count(*) FILTER (label = c) AS support,
        count(*) FILTER (prediction = c) AS predicted,
        count(*) FILTER (label = c AND prediction = c) AS hits
      FROM (SELECT DISTINCT label AS c FROM ({EVAL}) UNION SELECT DISTINCT prediction FROM ({EVAL}))
      CROSS JOIN ({EVAL}) GROUP BY c)"""

LOGITS = "SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding[1:3]] AS l FROM embeddings"
SOFTMAX = f"""SELECT vec_id, [x / list_sum(e) FOR x IN e] AS s
FROM (SELECT vec_id, [exp(x - list_max(l)) FOR x IN l] AS e FROM ({LOGITS}))"""

SCALED = "SELECT CAST(user_id AS VARCHAR) AS ticker, value * 10 AS aggregated_score FROM events"


# --- Porter's steps, one subquery each ----------------------------------------------------------


def _cut(source: str, pattern: str) -> str:
    return f"""SELECT term, e, left(w, length(w) - length(e)) AS s
FROM (SELECT term, w, regexp_extract(w, '{pattern}', 1) AS e FROM ({source}))"""


def _matches(pattern: str, column: str = "s") -> str:
    return f"regexp_matches({column}, '{pattern}')"


def _table_step(source: str, endings: dict[str, str], condition: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in endings.items())
    return f"""SELECT term, CASE WHEN e <> '' AND {_matches(condition)}
  THEN s || CASE e {cases} END ELSE s || e END AS w
FROM ({_cut(source, stem.ending_pattern(endings))})"""


def _stems(terms: str) -> str:
    """(term, stem) for a subquery of terms."""
    out = f"SELECT term, term AS w FROM ({terms})"
    out = f"""SELECT term, CASE WHEN regexp_matches(w, '(ss|i)es$') THEN left(w, length(w) - 2)
  WHEN regexp_matches(w, '[^s]s$') THEN left(w, length(w) - 1) ELSE w END AS w FROM ({out})"""
    out = f"""SELECT term, CASE WHEN e = 'eed' AND {_matches(stem.M_POSITIVE)} THEN s || 'ee'
  WHEN e IN ('ed', 'ing') AND {_matches(stem.HAS_VOWEL)} THEN
    CASE WHEN regexp_matches(s, '(at|bl|iz)$') THEN s || 'e'
         WHEN length(s) > 1 AND right(s, 1) = substr(s, length(s) - 1, 1)
              AND right(s, 1) NOT IN ('a','e','i','o','u','y','l','s','z') THEN left(s, length(s) - 1)
         WHEN {_matches(stem.ENDS_CVC)} THEN s || 'e' ELSE s END
  ELSE s || e END AS w FROM ({_cut(out, '(eed|ed|ing)$')})"""
    out = f"""SELECT term, CASE WHEN e = 'y' AND {_matches(stem.HAS_VOWEL)} THEN s || 'i' ELSE s || e END AS w
FROM ({_cut(out, '(y)$')})"""
    out = _table_step(out, stem.STEP_2, stem.M_POSITIVE)
    out = _table_step(out, stem.STEP_3, stem.M_POSITIVE)
    plain = stem.ending_pattern(stem.STEP_4)
    out = f"""SELECT term, CASE WHEN e <> '' AND {_matches(stem.M_OVER_ONE)} THEN s
  WHEN e = '' AND regexp_matches(s, '[st]ion$')
       AND {_matches(stem.M_OVER_ONE, 'left(s, length(s) - 3)')} THEN left(s, length(s) - 3)
  ELSE s || e END AS w FROM ({_cut(out, plain)})"""
    out = f"""SELECT term, CASE WHEN e = 'e' AND ({_matches(stem.M_OVER_ONE)}
    OR ({_matches(stem.M_ONE)} AND NOT {_matches(stem.ENDS_CVC)})) THEN s ELSE s || e END AS w
FROM ({_cut(out, '(e)$')})"""
    return f"""SELECT term, CASE WHEN length(term) <= 2 THEN term
  WHEN regexp_matches(w, 'll$') AND {_matches(stem.M_OVER_ONE, 'w')} THEN left(w, length(w) - 1)
  ELSE w END AS stem FROM ({out})"""


# Longest pieces from left to right over the hexadecimal bytes of each distinct word.
MODEL_TOKENS = f"""
WITH RECURSIVE pieces AS MATERIALIZED (
  SELECT hex(from_base64(piece)) AS piece, id FROM read_csv('/opt/tokenizers/byte_bpe_50k.tiktoken',
    delim=' ', header=false, quote='', escape='', columns={{'piece': 'VARCHAR', 'id': 'INTEGER'}})),
docs AS MATERIALIZED (SELECT doc_id, {WORD} AS words FROM documents),
units AS MATERIALIZED (
  SELECT DISTINCT hex(encode(' ' || w)) AS unit FROM (SELECT unnest(words) AS w FROM docs)),
spans AS (
  SELECT unit, p, unnest(range(1, 1 + least(length(unit) // 2 - p,
    (SELECT max(length(piece)) // 2 FROM pieces)))) AS n
  FROM (SELECT unit, unnest(range(0, length(unit) // 2)) AS p FROM units)),
longest AS MATERIALIZED (
  SELECT unit, p, max(n) AS n, arg_max(id, n) AS id
  FROM spans JOIN pieces ON piece = substr(unit, 2 * p + 1, 2 * n) GROUP BY unit, p),
chain AS (
  SELECT unit, p, n, id FROM longest WHERE p = 0
  UNION ALL
  SELECT g.unit, g.p, g.n, g.id FROM chain c JOIN longest g ON g.unit = c.unit AND g.p = c.p + c.n),
cut AS MATERIALIZED (SELECT unit, list(id ORDER BY p) AS ids FROM chain GROUP BY unit),
placed AS (
  SELECT doc_id, i, w, ids,
    sum(len(ids)) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS upto
  FROM (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM docs)
  JOIN cut ON unit = hex(encode(' ' || w))),
whole AS (
  SELECT doc_id, flatten(list(ids ORDER BY i)) AS ids, max(upto) AS n,
    string_agg(w, ' ' ORDER BY i) FILTER (WHERE upto <= 510) AS fits
  FROM placed GROUP BY doc_id)
SELECT doc_id,
  array_to_string([50256] || coalesce(ids, [])[1:510] || list_transform(
    range(0, 511 - least(510, coalesce(n, 0))::BIGINT), lambda x: 50256), ',') AS input_ids,
  (2 + least(510, coalesce(n, 0)))::BIGINT AS n_unmasked,
  coalesce(n, 0)::BIGINT AS n_pieces,
  coalesce(fits, '') AS model_text
FROM docs LEFT JOIN whole USING (doc_id)"""
KEPT = _without(WORD, SHORT)
RAW_MESSAGES = f"SELECT doc_id, 'news' AS topic, {PLAIN_JSON} AS value FROM ({ARTICLES})"
PAIR_DOCS = f"(SELECT doc_id, {_pairs('t')} AS p FROM (SELECT doc_id, {WORD} AS t FROM documents))"
HEADLINE_PAIRS = f"""SELECT doc_id, part, {_pairs('t')} AS p
FROM (SELECT doc_id, part, {WORDS.format(c='article')} AS t FROM ({TRAIN_TEST}))"""
NORMALIZED = _without(
    WORDS.format(c="regexp_replace(lower(text), '[^a-zA-Z0-9\\s]', '', 'g')"), ENGLISH
)
CLEANED = _without(WHITESPACE, ENGLISH)



def _stemmed_tfidf(idf: str, l2: bool = False) -> str:
    """Weights over the stems of lower-cased script tokens without the short stop list."""
    final = "w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))" if l2 else "w"
    return f"""WITH words AS ({_tf(_without(SCRIPT_LOWER, SHORT))}),
tf AS (SELECT doc_id, stem AS term, sum(tf) AS tf
  FROM words JOIN ({_stems('SELECT DISTINCT term FROM words')}) s ON words.term = s.term
  GROUP BY doc_id, stem),
d AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY term),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
x AS (SELECT doc_id, term, CAST(tf AS DOUBLE) * ({idf}) AS w FROM tf JOIN d USING (term) CROSS JOIN n)
SELECT doc_id, term, round({final}, 6) AS weight FROM x"""


ORACLES: dict[str, str] = {
    "src_batch_messages": f"SELECT doc_id, {PLAIN_JSON} AS text FROM ({ARTICLES})",
    "json_decode": f"""SELECT doc_id, CASE WHEN lang = 'en' THEN title END AS title,
  CASE WHEN lang = 'en' THEN article END AS article FROM ({ARTICLES})""",
    "json_decode_tolerant": f"""SELECT doc_id, title, article FROM ({ARTICLES})
WHERE lang IN ('en', 'fr')""",
    "json_dead_letters": f"""SELECT doc_id, CASE WHEN lang = 'de' THEN substr(article, 1, 1)
  ELSE CAST(json_array(title, article) AS VARCHAR) END AS raw
FROM ({ARTICLES}) WHERE lang NOT IN ('en', 'fr')""",
    "json_dead_letter_reasons": """SELECT doc_id, CASE lang WHEN 'fr' THEN 'no known field' ELSE 'unreadable' END AS reason
FROM documents WHERE lang IN ('fr', 'de')""",
    "sink_json_messages": f"SELECT doc_id, {PLAIN_JSON} AS value FROM ({ARTICLES})",
    "src_parquet_articles": f"SELECT doc_id, title, article FROM ({ARTICLES})",
    "src_csv_headlines": f"""SELECT "Date", "Label", regexp_replace({RAW_TEXT}, '[^\\x00-\\xff]', '?', 'g') AS article
FROM ({HEADLINE_ROWS})""",
    "page_extract": f"""SELECT page_id, trim(url) AS url, {TITLE} AS title, {BODY} AS article FROM pages""",
    "page_body_blocks": f"""SELECT p.page_id, {_plain('r.html')} AS article
FROM pages p LEFT JOIN ({BEST_RUN}) r ON p.page_id = r.page_id""",
    "article_search": f"""SELECT rank, title, url, lang FROM ({TOPIC_HITS})
ORDER BY rank LIMIT {hit_limit(40)}""",
    "article_search_ranked": f"""WITH t AS (
  SELECT page_id, regexp_extract_all(lower({TITLE}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM pages),
m AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(CAST(len(w) AS DOUBLE)) AS mean FROM t),
tf AS (SELECT page_id, len(w) AS len, unnest(w) AS term FROM t),
c AS (SELECT page_id, len, term, CAST(count(*) AS DOUBLE) AS tf FROM tf
  WHERE term IN ('the', 'of', 'and', 'tion') GROUP BY ALL),
d AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM c GROUP BY term)
SELECT page_id, round(sum(ln(CAST(1 AS DOUBLE) + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
  / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / mean))), 6) AS score
FROM c JOIN d USING (term) CROSS JOIN m GROUP BY page_id ORDER BY score DESC, page_id LIMIT 60""",
    "article_lookup": f"SELECT rank, title, article FROM ({_looked_up(HITS)})",
    "article_nonempty": f"""SELECT doc_id, title, article FROM ({ARTICLES})
WHERE lang NOT IN ('es', 'de') AND article <> ''""",
    "article_keep_empty": f"""SELECT doc_id, title, CASE WHEN lang = 'es' THEN '' ELSE article END AS article
FROM ({ARTICLES}) WHERE lang <> 'de'""",
    "article_topn": f"""SELECT rank, title, article
FROM ({_looked_up(f"SELECT * FROM ({TOPIC_HITS}) ORDER BY rank LIMIT {hit_limit(20)}")})
WHERE article IS NOT NULL AND article <> '' ORDER BY rank LIMIT 20""",
    "article_topn_per_topic": f"""WITH h AS (SELECT *, lower(split_part(title, ' ', 1)) AS topic FROM ({HITS})),
asked AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY topic ORDER BY rank) <= {hit_limit(5)})
SELECT topic, rank, title, article FROM ({_looked_up("SELECT * FROM asked")}) WHERE article IS NOT NULL AND article <> ''
QUALIFY row_number() OVER (PARTITION BY topic ORDER BY rank) <= 5""",
    "preview_head": f"SELECT doc_id, title, article FROM ({ARTICLES}) ORDER BY doc_id LIMIT 20",
    "headline_clean": f"SELECT doc_id, {CLEAN.format('text')} AS article FROM documents",
    "text_normalize": """SELECT doc_id, regexp_replace(lower(text), '[^a-zA-Z0-9\\s]', '', 'g') AS article
FROM documents""",
    "tokens_whitespace": _token_report(WHITESPACE),
    "tokens_script": _token_report(SCRIPT),
    "tokens_word": _token_report(WORD),
    "tokens_no_stopwords": _token_report(CLEANED),
    "tokens_custom_stopwords": _token_report(_without(SCRIPT, SHORT, "w")),
    "tokens_model": MODEL_TOKENS,
    "stream_model_tokens": MODEL_TOKENS,
    "tokens_truncated": _token_report(f"({WORD})[1:512]"),
    "bigrams": f"""SELECT doc_id, CAST(len(p) AS INTEGER) AS n, array_to_string(p, '|') AS tokens
FROM (SELECT doc_id, {_pairs('t')} AS p FROM (SELECT doc_id, {CLEANED} AS t FROM documents))""",
    "tokens_stemmed": f"""WITH x AS (SELECT doc_id, {_without(SCRIPT_LOWER, SHORT)} AS t FROM documents),
y AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM x),
z AS (SELECT doc_id, count(*) AS n, string_agg(stem, '|' ORDER BY pos) AS tokens
      FROM y JOIN ({_stems('SELECT DISTINCT term FROM y')}) s ON y.term = s.term GROUP BY doc_id)
SELECT x.doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n, coalesce(tokens, '') AS tokens
FROM x LEFT JOIN z ON x.doc_id = z.doc_id""",
    "term_freq": _tf(WORD),
    "doc_freq": f"SELECT term, count(*) AS df FROM ({_tf(WORD)}) GROUP BY term",
    "bigram_counts": _tf("p", PAIR_DOCS),
    "bigram_vocab": f"""SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index
FROM (SELECT DISTINCT unnest(p) AS term FROM {PAIR_DOCS})""",
    "tfidf_log1p": _tfidf(KEPT, LOG1P),
    "tfidf_l2": _tfidf(WORD, SMOOTH, l2=True),
    "tfidf_stop_l2": _tfidf(NORMALIZED, SMOOTH, l2=True),
    "tfidf_spark": _tfidf(WORD, SPARK),
    "features_left_join": f"""SELECT a.doc_id, title, term, weight FROM ({ARTICLES}) a
LEFT JOIN ({_tfidf(KEPT, SMOOTH, l2=True)}) f ON a.doc_id = f.doc_id""",
    "tfidf_bigrams": f"""WITH tf AS ({_tf("p", PAIR_DOCS)}),
d AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY term),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents)
SELECT doc_id, term, round(CAST(tf AS DOUBLE) * ({SMOOTH}), 6) AS weight
FROM tf JOIN d USING (term) CROSS JOIN n""",
    "tfidf_stemmed_log1p": _stemmed_tfidf(LOG1P),
    "tfidf_stemmed_l2": _stemmed_tfidf(SMOOTH, l2=True),
    "features_left_join_stemmed": f"""SELECT a.doc_id, title, term, weight FROM ({ARTICLES}) a
LEFT JOIN ({_stemmed_tfidf(SMOOTH, l2=True)}) f ON a.doc_id = f.doc_id""",
    "stemmed_terms": f"""WITH tf AS ({_tf(KEPT)})
SELECT doc_id, tf.term AS term, stem, tf
FROM tf JOIN ({_stems('SELECT DISTINCT term FROM tf')}) s ON tf.term = s.term""",
    "label_index": """SELECT doc_id, source AS label, label_index FROM documents
JOIN (SELECT source AS s, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS label_index
      FROM documents GROUP BY source) ON source = s""",
    "date_split": f"""SELECT doc_id, "Date", 'train' AS part FROM ({HEADLINE_ROWS}) WHERE "Date" < '20150101'
UNION ALL SELECT doc_id, "Date", 'test' AS part FROM ({HEADLINE_ROWS}) WHERE "Date" > '20141231'""",
    "headline_concat": TRAIN_TEST,
    "ml_bow": f"""WITH x AS (SELECT doc_id, part, unnest(p) AS term FROM ({HEADLINE_PAIRS})),
v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index
      FROM (SELECT DISTINCT term FROM x WHERE part = 'train'))
SELECT doc_id, term_index, count(*) AS tf FROM x JOIN v USING (term)
WHERE part = 'test' GROUP BY doc_id, term_index""",
    "sentiment_scores": f"""SELECT vec_id, round(s[1], 6) AS score_0, round(s[2], 6) AS score_1,
  round(s[3], 6) AS score_2 FROM ({SOFTMAX})""",
    "sentiment_labels": f"""SELECT vec_id, CAST(list_position(l, list_max(l)) - 1 AS INTEGER) AS class_index,
  CASE list_position(l, list_max(l)) WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' ELSE 'positive' END
  AS sentiments FROM ({LOGITS})""",
    "udf_registered": "SELECT doc_id, CAST(1 AS BIGINT) AS sentiment_prediction FROM documents",
    "eval_confusion": f"""WITH e AS ({EVAL}),
c AS (SELECT label AS c FROM e UNION SELECT prediction FROM e)
SELECT a.c AS label, b.c AS prediction,
  (SELECT count(*) FROM e WHERE e.label = a.c AND e.prediction = b.c) AS n
FROM c a CROSS JOIN c b""",
    "eval_accuracy": f"""SELECT round(avg(CAST(label = prediction AS DOUBLE)), 9) AS accuracy
FROM ({EVAL})""",
    "eval_report": f"""SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f1, 9) AS f1, support FROM ({REPORT})""",
    "eval_report_avg": f"""WITH r AS ({REPORT})
SELECT 'macro avg' AS average, round(avg(precision), 9) AS precision,
  round(avg(recall), 9) AS recall, round(avg(f1), 9) AS f1, CAST(sum(support) AS BIGINT) AS support FROM r
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
  round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
  CAST(sum(support) AS BIGINT) FROM r""",
    "src_stream_articles": RAW_MESSAGES,
    "stream_parquet_sink": f"SELECT doc_id, title, article FROM ({ARTICLES})",
    "stream_features": f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens,
  array_to_string({_pairs('t')}, '|') AS ngrams
FROM (SELECT doc_id, {CLEANED} AS t FROM documents)""",
    "stream_tfidf": _tfidf(NORMALIZED, SMOOTH, l2=True),
    "stream_preview": f"SELECT doc_id, title, article FROM ({ARTICLES}) ORDER BY doc_id LIMIT 20",
    "stream_scaled_scores": SCALED,
    "stream_table_sink": SCALED,
    "stream_score_count": 'SELECT CAST(user_id AS VARCHAR) AS ticker, count(*) AS "count" FROM events GROUP BY user_id',
    "score_count": 'SELECT count(*) AS "count" FROM events',
    "score_by_ticker": 'SELECT CAST(user_id AS VARCHAR) AS ticker, count(*) AS "count" FROM events GROUP BY user_id',
}
