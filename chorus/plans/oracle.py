"""The same results stated as plain SQL for an independent engine (DuckDB).

The statements share no code with the operators. Stop words come from the text
files in ``stop_words``, so neither a session nor Spark's jars are needed.
"""

from functools import cache
from pathlib import Path

LANGS = {"de": "german", "en": "english", "es": "spanish", "fr": "french"}


@cache
def stop_list(language: str) -> list[str]:
    lines = (Path(__file__).parent / "stop_words" / f"{language}.txt").read_text("utf-8").splitlines()
    return [w for w in lines if w and not w.startswith("#")]


def _stop_list(language: str) -> str:
    quoted = [w.replace("'", "''") for w in stop_list(language)]
    return "[" + ", ".join(f"'{w}'" for w in quoted) + "]"


RAW = r"string_split_regex(lower(regexp_replace(text, '[[:punct:]]', ' ', 'g')), '[ \t\n\x0B\f\r]')"


def _by_lang() -> str:
    cases = " ".join(f"WHEN '{c}' THEN {_stop_list(n)}" for c, n in LANGS.items() if c != "en")
    return f"CASE lang {cases} ELSE {_stop_list('english')} END"


def _without(words: str, stops: str) -> str:
    return f"list_filter({words}, lambda w: NOT list_contains({stops}, w))"


def _tokens() -> str:
    """CTEs: ``tok`` (every document's words) and ``kept`` (more than three of them)."""
    return f"""
    raw AS (SELECT doc_id AS review_id, source AS app_id, lang, {RAW} AS pieces FROM documents),
    stops AS (SELECT lang, {_by_lang()} AS stop FROM (SELECT DISTINCT lang FROM documents)),
    flat AS (SELECT review_id, app_id, lang, unnest(pieces) AS w, generate_subscripts(pieces, 1) AS pos FROM raw),
    stopped AS (SELECT lang, unnest(stop) AS w FROM stops),
    content AS (SELECT flat.* FROM flat ANTI JOIN stopped USING (lang, w) WHERE w <> ''),
    lens AS (SELECT review_id, count(*) AS n_tokens FROM content GROUP BY ALL),
    terms AS (SELECT content.app_id, content.review_id, content.lang, w AS term, pos, n_tokens
              FROM content JOIN lens USING (review_id) WHERE n_tokens > 3),
    kept AS (SELECT DISTINCT app_id, review_id, lang, n_tokens FROM terms),
    tf AS (SELECT app_id, review_id, term, count(*) AS n FROM terms GROUP BY ALL),
    dfreq AS (SELECT app_id, term, count(DISTINCT review_id) AS doc_freq FROM terms GROUP BY ALL),
    idfs AS (SELECT app_id, term, doc_freq, ln((m + 1) / (doc_freq + 1)) AS idf
             FROM dfreq JOIN (SELECT app_id, count(*) AS m FROM kept GROUP BY ALL) USING (app_id))"""


def _topics() -> str:
    """CTEs on top of the tokens: label topics with phi, mass, term frequencies."""
    return _tokens() + """,
    wk AS (SELECT app_id, lang AS topic, term, count(*) AS weight FROM terms GROUP BY ALL),
    mass AS (SELECT app_id, lang AS topic, sum(n_tokens)::DOUBLE AS mass FROM kept GROUP BY ALL),
    total AS (SELECT app_id, sum(mass) AS total FROM mass GROUP BY ALL),
    phi AS (SELECT app_id, topic, term, weight, weight / mass AS phi FROM wk JOIN mass USING (app_id, topic)),
    freqs AS (SELECT app_id, topic, term, phi, mass * phi AS freq, mass / total AS proportion, total
              FROM phi JOIN mass USING (app_id, topic) JOIN total USING (app_id)),
    marginal AS (SELECT app_id, term, sum(freq) AS f, max(total) AS total FROM freqs GROUP BY ALL),
    salient_all AS (
        SELECT app_id, term, f AS freq, f / marginal.total * s AS saliency FROM marginal JOIN (
            SELECT app_id, term, sum(freq / f * ln(freq / f / proportion)) AS s
            FROM freqs JOIN marginal USING (app_id, term) GROUP BY ALL) USING (app_id, term)),
    salient AS (SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY app_id ORDER BY round(saliency, 10) DESC, term) AS rank FROM salient_all) WHERE rank <= 30),
    lifts AS (SELECT app_id, topic, term, freq, f AS term_total, ln(phi) AS logprob,
                     ln(phi / (f / marginal.total)) AS loglift
              FROM freqs JOIN marginal USING (app_id, term)),
    relevant AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY app_id, topic, "lambda"
            ORDER BY round(relevance, 10) DESC, term) AS rank
        FROM (SELECT *, "lambda" * logprob + (1 - "lambda") * loglift AS relevance
              FROM lifts, (SELECT i / 10 AS "lambda" FROM range(11) r(i)))) WHERE rank <= 30),
    shown AS (SELECT app_id, term FROM salient UNION SELECT app_id, term FROM relevant)"""


def _linguistic() -> str:
    """CTEs: normalized tokens by position, the made dictionaries, lemmas and tags."""
    return r"""
    nt AS (SELECT doc_id AS review_id, source AS app_id, lang, string_split_regex(lower(text), '[ \t\n\x0B\f\r]') AS p
           FROM documents),
    nflat AS (SELECT review_id, lang, generate_subscripts(p, 1) AS pos,
                     regexp_replace(unnest(p), '[^\p{L}]', '', 'g') AS form FROM nt),
    forms AS (SELECT * FROM nflat WHERE form <> ''),
    lemma_table AS (SELECT DISTINCT lang, form, left(form, length(form) - 1) AS lemma FROM forms
                    WHERE regexp_matches(form, '..s$')),
    lemmas AS (SELECT review_id, lang, pos, coalesce(lemma, form) AS lemma
               FROM forms LEFT JOIN lemma_table USING (lang, form)),
    tagged AS (SELECT *, CASE
        WHEN regexp_matches(lemma, '(ble|ed|eux|ich|al)$') THEN 'JJ'
        WHEN regexp_matches(lemma, '(ing|er|en|re|ar)$') THEN 'VB'
        WHEN regexp_matches(lemma, '^(the|of|and|la|le|de|der|die|das|el|to|in)$') THEN 'DT'
        ELSE 'NN' END AS tag FROM lemmas),
    lines AS (SELECT review_id, list(lemma ORDER BY pos) AS lemmas,
                     string_agg(lemma || '/' || tag || ' ', '' ORDER BY pos) AS line FROM tagged GROUP BY ALL),
    chunks AS (SELECT review_id, lemmas, list_transform(
        list_concat(regexp_extract_all(line, '((?:\S+/JJ )+\S+/NN )', 1),
                    regexp_extract_all(line, '((?:\S+/NN )+\S+/NN )', 1)),
        lambda c: rtrim(regexp_replace(c, '/(JJ|NN) ', ' ', 'g'))) AS phrases FROM lines)"""


# every event belongs to the document at its number in turn; the latest one dates it
DATED = """
    happened AS (SELECT * FROM (SELECT *, event_id % n AS place, count(*) OVER (PARTITION BY event_id % n) AS n_events,
                     row_number() OVER (PARTITION BY event_id % n ORDER BY ts DESC, event_id DESC) AS nth
                 FROM events, (SELECT max(doc_id) + 1 AS n FROM documents)) WHERE nth = 1),
    dated AS (SELECT doc_id AS review_id, source AS app_id, documents.lang, text, ts, n_events,
                     'user' || user_id AS user_name, event_type AS title,
                     json_extract_string(props, '$.k') AS app_version, quality AS rating
              FROM documents LEFT JOIN happened ON place = doc_id LEFT JOIN labels USING (doc_id))"""

STORED = DATED + """,
    stored AS (SELECT CASE WHEN lang IN ('en', 'de') THEN 'app_store' ELSE 'google_play' END AS store,
                      CASE WHEN lang IN ('en', 'de') THEN 'App ' || app_id END AS app_name,
                      app_id, lang AS country, lang, '{"n":' || sum(n_events) || '}' AS lda_data,
                      max(ts) AS update_dt
               FROM dated GROUP BY app_id, lang)"""

ENTITIES = """
    entities AS (SELECT p_name || '_' || p_brand AS app_name, p_partkey AS app_id,
                        substr(p_type, 1, 2) AS country, substr(p_brand, 1, 2) AS lang FROM part)"""

_UPSERTED = f"""
    WITH {STORED}
    SELECT store, app_name, app_id, country, lang, lda_data,
           strftime(update_dt, '%Y-%m-%d %H:%M:%S') AS update_dt FROM (
        SELECT * FROM stored WHERE store = 'app_store'
        UNION ALL
        SELECT * REPLACE ('{{"n":-2}}' AS lda_data, update_dt + INTERVAL 2 DAY AS update_dt)
        FROM stored WHERE store = 'google_play'
        UNION ALL
        SELECT * REPLACE ('zz' AS country) FROM stored WHERE store = 'google_play')"""

_FEED_ID = (
    "sha256(concat_ws(chr(1), user_name, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S'), title, text))"
)


# what a valid model must show
_ALL_CHECKS_HOLD = """
    SELECT unnest(['phi_sums_to_one', 'theta_sums_to_one', 'lengths_positive', 'topics_agree']) AS check, true AS ok"""


def statements() -> dict[str, str]:
    tokens, topics, words = _tokens(), _topics(), _linguistic()
    english = _stop_list("english")
    return {
        "page_flatten": f"""
            WITH {DATED}
            SELECT app_id, lang, review_id // 400 AS page_no, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS date,
                   title = 'error' AS "isEdited", coalesce(rating, 5) AS rating, text AS review, title,
                   user_name AS "userName" FROM dated""",
        "props_flatten": "SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events",
        "next_offset": r"""
            SELECT page_id, nullif(regexp_extract(url, '^.+page=([0-9]+).*$', 1), '')::INTEGER AS next_page FROM pages""",
        "page_offsets": f"""
            WITH {DATED}, p AS (SELECT DISTINCT app_id, lang, review_id // 400 AS page_no FROM dated)
            SELECT app_id, lang, page_no, CASE WHEN page_no < max(page_no) OVER (PARTITION BY app_id, lang)
                   THEN ((page_no + 1) * 20)::INTEGER END AS next_offset FROM p""",
        "review_date_parse": """
            SELECT event_id, CASE WHEN event_type <> 'error'
                   THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS date FROM events""",
        "feed_reviews": f"""
            WITH {DATED}
            SELECT 'app_store' AS store, app_id, lang AS country, lang, {_FEED_ID} AS review_id, user_name, title,
                   text, coalesce(rating, 5) AS rating, title = 'error' AS is_edited,
                   strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM dated""",
        "extract_reviews_app_store": f"""
            WITH {DATED}, found AS (SELECT DISTINCT app_id, lang, {_FEED_ID} AS review_id, user_name, text,
                                    coalesce(rating, 5) AS rating, date_trunc('second', ts) AS ts
                                    FROM dated WHERE ts >= TIMESTAMP '2024-01-10'),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY app_id, lang ORDER BY ts DESC, review_id) AS nth FROM found)
            SELECT 'app_store' AS store, app_id, lang AS country, lang, review_id, user_name, text, rating,
                   strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM ranked WHERE nth <= 30""",
        "extract_reviews_google_play": """
            WITH found AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id::VARCHAR) AS nth
                           FROM events WHERE event_type <> 'error' AND floor(value * 3) <= 127
                           AND json_extract(props, '$.k') IS NOT NULL AND ts >= TIMESTAMP '2024-01-10')
            SELECT 'google_play' AS store, 'com.app' || user_id AS app_id, 'us' AS country, 'en' AS lang,
                   event_id::VARCHAR AS review_id, 'u' AS user_name, event_type AS text,
                   floor(value * 3)::INTEGER AS rating, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
            FROM found WHERE nth <= 20""",
        "review_topics_run": f"""
            WITH {tokens} SELECT 'app_store' AS store, 'App' AS app_name, 'all' AS app_id, lang AS country, lang,
                   5 AS n_topics FROM kept GROUP BY lang""",
        "topic_result_upsert_store_key": f"""
            WITH {STORED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY store, app_name, app_id
                    ORDER BY lang IN ('de', 'es') DESC, update_dt DESC, lda_data DESC) AS nth FROM stored)
            SELECT store, app_name, app_id, 'zz' AS country, lang, lda_data,
                   strftime(update_dt, '%Y-%m-%d %H:%M:%S') AS update_dt FROM ranked WHERE nth = 1""",
        "write_reviews_then_read": """
            SELECT source AS app_id, lang, count(*) AS n, sum(length(text))::BIGINT AS chars
            FROM documents WHERE lang <> 'fr' GROUP BY ALL
            UNION ALL
            SELECT source, 'fr', count(*), sum(length(text))::BIGINT
            FROM (SELECT DISTINCT source, text FROM documents WHERE lang = 'fr') GROUP BY ALL""",
        "read_reviews_typed": "SELECT doc_id AS review_id, lang, source AS app_id FROM documents",
        "entity_key": f"""
            WITH {ENTITIES}
            SELECT app_id, 'app_store/' || lower(app_name || '_' || app_id || '_' || country || '_' || lang)
                   || '.parquet' AS entity_key FROM entities""",
        "topic_result_upsert": _UPSERTED,
        "topic_result_versions": _UPSERTED,
        "stream_upsert": _UPSERTED,
        "topic_result_json": f"""
            WITH {topics},
            k AS (SELECT app_id, count(*) AS topics FROM mass GROUP BY ALL),
            t AS (SELECT app_id, count(*) AS n FROM (SELECT DISTINCT app_id, topic, term FROM relevant) GROUP BY ALL),
            s AS (SELECT app_id, count(*) AS n FROM salient GROUP BY ALL),
            tt AS (SELECT app_id, count(*) AS n FROM freqs JOIN shown USING (app_id, term) GROUP BY ALL)
            SELECT app_id, topics::INTEGER AS topics, (t.n + s.n)::INTEGER AS term_lines,
                   tt.n::INTEGER AS token_lines
            FROM k JOIN t USING (app_id) JOIN s USING (app_id) JOIN tt USING (app_id)""",
        "topic_result_read": f"""
            WITH {topics}
            SELECT app_id, 'Default' AS category, term, round(freq, 6) AS freq, round(freq, 6) AS total,
                   (31 - rank)::DOUBLE AS logprob, (31 - rank)::DOUBLE AS loglift FROM salient
            UNION ALL
            SELECT DISTINCT app_id, 'Topic' || topic, term, round(freq, 6), round(term_total, 6), round(logprob, 6),
                   round(loglift, 6) FROM relevant""",
        "conform_schema": """
            SELECT event_id::VARCHAR AS "reviewId", nullif(event_type, 'error') AS content,
                   CASE WHEN floor(value * 3) <= 127 THEN floor(value * 3)::INTEGER END AS score,
                   json_extract(props, '$.k')::INTEGER AS "thumbsUpCount",
                   CASE WHEN event_type = 'error' THEN 'content: missing value'
                        WHEN floor(value * 3) > 127 THEN 'score: does not fit' END AS reject_reason FROM events""",
        "date_cutoff": "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'",
        "entity_validate": """
            SELECT c_custkey, store, country, length(CASE store WHEN 'app_store' THEN app_name ELSE c_name END)
                       BETWEEN 3 AND 50 AND length(country) = 2 AS valid
            FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN 'app_store' ELSE 'google_play' END AS store,
                         substr(c_mktsegment, 1, 1 + c_nationkey % 3) AS country,
                         substr(c_name, 1, 1 + c_custkey % 5) AS app_name FROM customer)""",
        "result_constraints": """
            WITH r AS (SELECT *, CASE WHEN event_type IN ('click', 'view') THEN 'app_store' ELSE 'google_play' END
                              AS store, user_id || '-' || event_id AS app_id FROM events),
                 twice AS (SELECT * FROM r UNION ALL SELECT * FROM r WHERE event_type = 'purchase')
            SELECT event_id, store, CASE
                   WHEN value <= 2 THEN 'country is null'
                   WHEN event_type = 'view' THEN 'app_name is null'
                   WHEN length(app_id) > CASE store WHEN 'app_store' THEN 10 ELSE 50 END THEN 'app_id too long'
                   WHEN value > 30 THEN 'country too long'
                   WHEN event_type = 'purchase' THEN 'key not unique' END AS violation,
                   strftime(ts + INTERVAL 500 MILLISECOND, '%Y-%m-%d %H:%M:%S') AS update_dt FROM twice""",
        "text_column_pick": f"""
            WITH {DATED}
            SELECT 'app_store' AS store, 'App ' || app_id AS app_name, app_id, {_FEED_ID} AS review_id,
                   user_name, text, NULL AS app_version FROM dated
            UNION ALL
            SELECT 'google_play', NULL, conv_id::VARCHAR, conv_id || '-' || turn, role, text, '1.0'
            FROM conversations""",
        "topic_lookup": f"""
            WITH {STORED} SELECT lda_data FROM stored WHERE store = 'app_store' AND app_name = 'App src7'
            AND app_id = 'src7' AND country = 'en'""",
        "app_listing_app_store": f"""
            WITH {STORED} SELECT app_name, app_id, country FROM stored WHERE store = 'app_store' ORDER BY ALL""",
        "app_listing_google_play": f"""
            WITH {STORED} SELECT app_id, country FROM stored WHERE store = 'google_play' ORDER BY ALL""",
        "slug_normalize": r"""
            SELECT p_partkey, regexp_replace(lower(p_name || '__' || p_brand || ' ' || p_type), '[\W_]+', '-', 'g')
                   AS slug FROM part""",
        "id_from_page": r"""
            SELECT page_id, nullif(regexp_extract(url, 'https?://[^/]+/[a-z]{2}/([0-9]+)', 1), '') AS app_id
            FROM pages""",
        "id_from_landing_page": "SELECT p_partkey AS app_id, p_partkey::VARCHAR AS found FROM part",
        "landing_url_build": rf"""
            WITH {ENTITIES}
            SELECT app_id, 'https://apps.apple.com/' || lower(country) || '/app/'
                   || regexp_replace(lower(app_name), '[\W_]+', '-', 'g') || '/id' || app_id AS landing_url,
                   'https://amp-api.apps.apple.com/v1/catalog/' || lower(country) || '/apps/' || app_id || '/reviews'
                   AS request_url FROM entities""",
        "newest_n_per_app": """
            SELECT event_type, event_id FROM (SELECT *, row_number() OVER (
                PARTITION BY event_type ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn <= 1000""",
        "review_cap": """
            SELECT event_id, event_type FROM (SELECT *, row_number() OVER (
                PARTITION BY event_type ORDER BY event_id) AS rn FROM events) WHERE rn <= 1000""",
        "dedup_reviews": """
            SELECT source AS app_id, lang, min(doc_id) AS review_id FROM documents GROUP BY source, lang, text""",
        "strip_punct": r"""
            SELECT doc_id AS review_id, regexp_replace(text, '[[:punct:]]', ' ', 'g') AS clean FROM documents""",
        "tokenize": f"""
            SELECT review_id, len(p)::BIGINT AS n, array_to_string(p, '|') AS tokens
            FROM (SELECT doc_id AS review_id, {RAW} AS p FROM documents)""",
        "remove_stop_words_english": f"""
            SELECT doc_id AS review_id, array_to_string({_without(RAW, english)}, '|') AS words FROM documents""",
        "remove_stop_words": f"""
            SELECT doc_id AS review_id, array_to_string({_without(RAW, _by_lang())}, '|') AS words FROM documents""",
        "drop_empty_tokens": f"""
            SELECT doc_id AS review_id, array_to_string(list_filter({RAW}, lambda w: w <> ''), '|') AS words
            FROM documents""",
        "token_count": f"""
            WITH {tokens} SELECT doc_id AS review_id, coalesce(n_tokens, 0)::BIGINT AS n_tokens
            FROM documents LEFT JOIN lens ON review_id = doc_id""",
        "min_token_filter": f"""
            WITH {tokens} SELECT review_id, string_agg(term, '|' ORDER BY pos) AS words FROM terms GROUP BY ALL""",
        "normalize_tokens": f"""
            WITH {words} SELECT doc_id AS review_id, coalesce(string_agg(form, '|' ORDER BY pos), '') AS tokens
            FROM documents LEFT JOIN forms ON review_id = doc_id GROUP BY ALL""",
        "lemmatize": f"""
            WITH {words} SELECT review_id, string_agg(lemma, '|' ORDER BY pos) AS lemmas FROM lemmas GROUP BY ALL""",
        "pos_tag": f"""
            WITH {words} SELECT review_id, string_agg(tag, '|' ORDER BY pos) AS tags FROM tagged GROUP BY ALL""",
        "chunk_ngrams": f"""
            WITH {words} SELECT review_id, array_to_string(phrases, '|') AS phrases FROM chunks""",
        "finish_concat": f"""
            WITH {words} SELECT review_id, (len(lemmas) + len(phrases))::BIGINT AS n,
                   array_to_string(list_concat(lemmas, phrases), '|') AS words FROM chunks""",
        "wordless_documents": f"""
            WITH {words} SELECT source AS app_id, count(*) FILTER (WHERE doc_id NOT IN
                   (SELECT review_id FROM forms)) AS n_wordless FROM documents GROUP BY ALL""",
        "top_terms_by_source": f"""
            WITH {tokens}, w AS (SELECT app_id, term, sum(n * idf) AS weight
                                 FROM tf JOIN idfs USING (app_id, term) GROUP BY ALL)
            SELECT app_id, term, round(weight, 6) AS weight, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (
                PARTITION BY app_id ORDER BY round(weight, 8) DESC, term) AS rank FROM w) WHERE rank <= 10""",
        "vocabulary": f"""
            WITH {tokens}, s AS (SELECT app_id, term, count(*) AS term_freq,
                                        count(DISTINCT review_id) AS doc_freq FROM terms GROUP BY ALL)
            SELECT app_id, idx, term, term_freq, doc_freq FROM (SELECT *, row_number() OVER (
                PARTITION BY app_id ORDER BY term_freq DESC, term) - 1 AS idx FROM s)""",
        "term_frequency": f"WITH {tokens} SELECT * FROM tf",
        "document_frequency": f"WITH {tokens} SELECT * FROM dfreq",
        "idf": f"WITH {tokens} SELECT app_id, term, doc_freq, round(idf, 6) AS idf FROM idfs",
        "tf_idf": f"""
            WITH {tokens} SELECT app_id, review_id, term, n, round(n * idf, 6) AS tf_idf
            FROM tf JOIN idfs USING (app_id, term)""",
        "doc_count_check": f"""
            WITH {tokens}, fitted AS (SELECT lang, count(DISTINCT review_id) AS fit_docs FROM terms GROUP BY lang),
            listed AS (SELECT lang, count(*) AS table_docs FROM kept GROUP BY lang)
            SELECT lang, fit_docs, table_docs, fit_docs = table_docs AS ok FROM fitted JOIN listed USING (lang)""",
        "doc_length_stats": f"""
            WITH {tokens} SELECT app_id, count(*) AS n_docs, min(n_tokens) AS min_tokens,
                   sum(n_tokens)::BIGINT AS n_tokens, min(n_tokens) > 0 AS ok FROM kept GROUP BY ALL""",
        "label_topics": f"WITH {topics} SELECT app_id, topic, term, weight, round(phi, 6) AS phi FROM phi",
        "align_docs": f"""
            WITH {tokens} SELECT app_id, review_id, lang AS topic, 1.0::DOUBLE AS theta, n_tokens FROM kept""",
        "topic_mass": f"""
            WITH {topics} SELECT app_id, topic, mass, total, round(mass / total, 6) AS proportion
            FROM mass JOIN total USING (app_id)""",
        "topic_proportion": f"""
            WITH {topics} SELECT app_id, topic, round(mass / total, 6) AS proportion
            FROM mass JOIN total USING (app_id)""",
        "summary_validate": f"""
            WITH {topics},
            sums AS (SELECT app_id, topic, sum(phi) AS s FROM phi GROUP BY ALL),
            per_app AS (SELECT app_id, max(abs(s - 1)) <= 1e-6 AS phi_ok, count(*) AS k FROM sums GROUP BY ALL),
            d AS (SELECT app_id, min(n_tokens) > 0 AS len_ok, count(DISTINCT lang) AS k2 FROM kept GROUP BY ALL)
            SELECT app_id, 'phi_sums_to_one' AS check, phi_ok AS ok FROM per_app
            UNION ALL SELECT app_id, 'theta_sums_to_one', true FROM d
            UNION ALL SELECT app_id, 'lengths_positive', len_ok FROM d
            UNION ALL SELECT app_id, 'topics_agree', k = k2 FROM per_app JOIN d USING (app_id)""",
        "term_topic_freq": f"WITH {topics} SELECT app_id, topic, term, round(freq, 6) AS freq FROM freqs",
        "term_marginal": f"""
            WITH {topics} SELECT app_id, term, round(f, 6) AS freq, round(f / total, 6) AS share FROM marginal""",
        "saliency": f"""
            WITH {topics} SELECT app_id, term, round(freq, 6) AS freq, round(saliency, 6) AS saliency,
                   rank::INTEGER AS rank FROM salient""",
        "log_prob_lift": f"""
            WITH {topics} SELECT app_id, topic, term, round(logprob, 6) AS logprob, round(loglift, 6) AS loglift
            FROM lifts""",
        "relevance": f"""
            WITH {topics} SELECT app_id, topic, "lambda", rank::INTEGER AS rank, term,
                   round(relevance, 6) AS relevance FROM relevant""",
        "token_table": f"""
            WITH {topics} SELECT app_id, topic, term, round(freq / f, 6) AS share
            FROM freqs JOIN shown USING (app_id, term) JOIN marginal USING (app_id, term)""",
        "topic_pairs": f"""
            WITH {topics} SELECT a.app_id, a.topic AS topic_a, b.topic AS topic_b
            FROM mass a JOIN mass b ON a.app_id = b.app_id AND a.topic < b.topic""",
        "topic_distance": f"""
            WITH {topics}, pairs AS (SELECT a.app_id, a.topic AS topic_a, b.topic AS topic_b
                FROM mass a JOIN mass b ON a.app_id = b.app_id AND a.topic < b.topic),
            sides AS (SELECT pairs.*, term, phi AS p, 0.0 AS q FROM pairs JOIN phi
                          ON phi.app_id = pairs.app_id AND phi.topic = topic_a
                      UNION ALL SELECT pairs.*, term, 0.0, phi FROM pairs JOIN phi
                          ON phi.app_id = pairs.app_id AND phi.topic = topic_b),
            cells AS (SELECT app_id, topic_a, topic_b, term, sum(p) AS p, sum(q) AS q FROM sides GROUP BY ALL)
            SELECT app_id, topic_a, topic_b, round(sum(
                CASE WHEN p > 0 THEN p / 2 * ln(2 * p / (p + q)) ELSE 0 END +
                CASE WHEN q > 0 THEN q / 2 * ln(2 * q / (p + q)) ELSE 0 END), 6) AS distance
            FROM cells GROUP BY ALL""",
        "label_top_terms": f"""
            WITH {topics} SELECT app_id, topic, term, round(phi, 6) AS phi, rank::INTEGER AS rank
            FROM (SELECT *, row_number() OVER (PARTITION BY app_id, topic ORDER BY round(phi, 10) DESC, term) AS rank
                  FROM phi) WHERE rank <= 10""",
        "lda_fit": f"""
            WITH {tokens} SELECT 'google_play' AS store, 5 AS n_topics,
                   count(DISTINCT term) AS n_terms, count(DISTINCT review_id) AS n_docs,
                   count(DISTINCT term) AS n_terms_seen, 0::BIGINT AS n_tokens_dropped,
                   0::BIGINT AS n_docs_without_term FROM terms""",
        "lda_per_entity": f"""
            WITH {tokens} SELECT lang, 5 AS n_topics, count(DISTINCT term) AS n_terms,
                   count(DISTINCT review_id) AS n_docs, count(DISTINCT term) AS n_terms_seen,
                   0::BIGINT AS n_tokens_dropped, 0::BIGINT AS n_docs_without_term FROM terms GROUP BY lang""",
        "linguistic_lda": f"""
            WITH {words}, said AS (SELECT review_id, unnest(list_concat(lemmas, phrases)) AS word FROM chunks)
            SELECT lang, 5 AS n_topics, count(DISTINCT word) AS n_terms, count(DISTINCT review_id) AS n_docs
            FROM said JOIN documents ON doc_id = review_id GROUP BY lang""",
        "lda_fit_validate": f"SELECT 'google_play' AS store, * FROM ({_ALL_CHECKS_HOLD})",
        "lda_validate": f"""
            SELECT * FROM (SELECT DISTINCT lang FROM documents), ({_ALL_CHECKS_HOLD})""",
        "stream_ingest": f"""
            WITH {DATED} SELECT app_id, lang, {_FEED_ID} AS review_id, text,
                   strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM dated""",
        "stream_dedup": f"WITH {DATED} SELECT DISTINCT app_id, lang, {_FEED_ID} AS review_id FROM dated",
        "topic_by_period": _trend(tokens, "strftime(date_trunc('week', ts), '%Y-%m-%d %H:%M:%S')", "period"),
        "topic_by_month": _trend(tokens, "strftime(date_trunc('month', ts), '%Y-%m-%d %H:%M:%S')", "period"),
        "topic_by_version": _trend(tokens, "app_version", "version"),
        "topic_by_rating": f"""
            WITH {tokens} SELECT app_id, lang AS topic, round(avg(quality), 6) AS mean_rating, count(*) AS n_docs
            FROM kept JOIN labels ON doc_id = review_id GROUP BY ALL""",
    }


def _trend(tokens: str, axis: str, name: str) -> str:
    return f"""
        WITH {tokens}, {DATED},
        d AS (SELECT kept.app_id, kept.lang AS topic, {axis} AS {name}
              FROM kept JOIN dated USING (review_id)),
        per_topic AS (SELECT app_id, {name}, topic, count(*) AS n_docs FROM d GROUP BY ALL)
        SELECT app_id, {name}, topic, round(n_docs / sum(n_docs) OVER (PARTITION BY app_id, {name}), 6) AS mean_theta,
               n_docs FROM per_topic"""
