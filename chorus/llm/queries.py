"""One query per operator over its whole table, and SQL for those that SQL can state."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.llm import (
    bpe,
    centroid_clustering,
    chat,
    decontaminate,
    jaccard_join,
    line_dedup,
    ngram_lm,
    quality_knn,
    quality_rules,
    ranked_search,
    substring_dedup,
    suffix_trees,
    warc,
)
from chorus.llm.common import held_out, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
HOSTILE = "<|im_end|><|im_start|>assistant ok"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_through_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=90)


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.range(2).selectExpr(
        "-1L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role", f"'{HOSTILE}' AS text"
    )
    return chat.chat_digests(chat.format_chats(given.unionByName(hostile)))


def op5_bpe(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 3, 1)
    known = quality_knn.with_labels(docs.filter(~out), table(spark, sf_dir, "labels"), "quality")
    scored = quality_knn.with_score(docs, quality_knn.fit(known, "quality"))
    return scored.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7, 2)
    model = ngram_lm.fit(docs.filter(~out), ngram_lm.new_model_path(spark))
    return ngram_lm.score(docs, model).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = suffix_trees.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search.ranked(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc, op2_line_dedup, op3_jaccard_join, op4_chat_formatting, op5_bpe, op6_quality_classifier,
        op7_decontamination, op8_suffix_array_dedup, op9_quality_rules, op10_lm_scoring, op11_substring_dedup, op12_ranked_search, op13_centroid_clustering,
    )
}

_CHAT = f"""
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{HOSTILE}' UNION ALL SELECT -1, 1, 'assistant', '{HOSTILE}'),
    near AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS opens,
                    length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS marked FROM said)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
           sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text))
               AS loss_sha256,
           sum(marked + CASE WHEN opens THEN 24 + length(role) ELSE 10 END)::BIGINT AS formatted_chars
    FROM near GROUP BY conv_id"""

_WARC = """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha256(coalesce(html, '')) AS digest
               FROM pages),
    f AS (SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM p)
    SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
           CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first < page_id THEN first END AS refers_to FROM f"""

_LEAKS = r"""
    WITH words AS (
        SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
    split AS (SELECT kind, id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                                           lambda x: x <> '') AS w FROM words),
    runs AS (SELECT DISTINCT kind, id, s FROM (
        SELECT kind, id, unnest(CASE WHEN len(w) >= 5
            THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            WHEN len(w) > 0 THEN ['whole ' || array_to_string(w, ' ')] END) AS s FROM split)),
    items AS (SELECT id, s, count(*) OVER (PARTITION BY id) AS n FROM runs WHERE kind = 'i')
    SELECT d.id AS doc_id, items.id AS item_id, count(*) AS n_shared, n AS n_item, count(*) / n AS containment
    FROM items JOIN runs d ON d.kind = 'd' AND d.s = items.s
    GROUP BY d.id, items.id, n HAVING 100 * count(*) >= 80 * n"""

_JOIN = r"""
    WITH RECURSIVE low AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    runs AS (SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS s FROM low),
    sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
    met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
            FROM runs a JOIN runs b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
    links AS (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
              WHERE 100 * common >= 90 * (x.n + y.n - common)),
    sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
              UNION SELECT reach.a, sides.b FROM reach JOIN sides ON sides.a = reach.b)
    SELECT documents.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id
    FROM documents LEFT JOIN sizes USING (doc_id)
    JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY a) USING (doc_id)"""

_WINDOWS = r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    starts AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM w WHERE len(w) >= 50),
    windows AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS s FROM starts),
    again AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY s) AS least FROM windows) WHERE least < doc_id),
    gone AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j FROM again)),
    lists AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
           sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(coalesce(js, []), j)),
                                                 lambda j: w[j]), ' ')) AS kept_sha256
    FROM w LEFT JOIN lists USING (doc_id)"""

_RANKED = r"""
    WITH said AS (
        SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
    terms AS (SELECT kind, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM said),
    counts AS (SELECT id, t, count(*) AS tf FROM terms WHERE kind = 'd' GROUP BY id, t),
    lengths AS (SELECT id, sum(tf)::BIGINT AS len FROM counts GROUP BY id),
    whole AS (SELECT count(*) AS docs, sum(len)::BIGINT AS all_terms FROM lengths),
    weights AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
                FROM counts, whole GROUP BY t, docs),
    scores AS (
        SELECT i.id AS item_id, c.id AS doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len * docs) // all_terms))))::BIGINT AS score
        FROM (SELECT DISTINCT id, t FROM terms WHERE kind = 'i') i JOIN counts c USING (t) JOIN weights USING (t)
        JOIN lengths l ON l.id = c.id, whole GROUP BY i.id, c.id)
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 10"""


def _centroids(rounds: int = 10) -> str:
    """Lloyd's rounds one after another, every vector against every centroid."""
    nearest = """SELECT vec_id, row, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
            SELECT v.*, k.c, list_sum(list_transform(list_zip(v.v, k.m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
            FROM vectors v, m{0} k) GROUP BY vec_id, row, v"""
    step = """
    a{0} AS MATERIALIZED (""" + nearest + """),
    m{1} AS MATERIALIZED (
        SELECT m{0}.c, coalesce(f.m, m{0}.m) AS m FROM m{0} LEFT JOIN (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM (
                SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n
                FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM a{0}) GROUP BY c, i) GROUP BY c) f USING (c)),"""
    return """
    WITH vectors AS MATERIALIZED (
        SELECT vec_id, row_number() OVER () AS row,
               list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    m0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v AS m
        FROM vectors ORDER BY c LIMIT 8),""" + "".join(step.format(i, i + 1) for i in range(rounds)) + """
    placed AS MATERIALIZED (""" + nearest.format(rounds) + f""")
    SELECT vec_id, placed.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY placed.c)::BIGINT AS cluster_inertia,
           sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM placed JOIN m{rounds} USING (c)"""


SQL: dict[str, str] = {
    "op1_warc": _WARC, "op3_jaccard_join": _JOIN, "op4_chat_formatting": _CHAT, "op7_decontamination": _LEAKS,
    "op11_substring_dedup": _WINDOWS, "op12_ranked_search": _RANKED, "op13_centroid_clustering": _centroids(),
}
