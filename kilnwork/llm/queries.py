"""Registered queries of this subpackage, with the SQL that checks those which SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwork.llm import (
    conversation_repair,
    extraction,
    fingerprints,
    hard_negatives,
    language,
    mixing,
    near_dedup,
    pattern_packing,
    pieces,
    pseudo_likelihood,
    quality_model,
    rules,
    suffix_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ordered(df: DataFrame, *names: str) -> DataFrame:
    """These columns first."""
    return df.select(*names, *(c for c in df.columns if c not in names))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    _, scorer = quality_model.fit(docs)
    return quality_model.score(docs, scorer)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    vocabulary = pseudo_likelihood.fit_vocabulary(docs)
    return pseudo_likelihood.score(docs, vocabulary, pseudo_likelihood.fit(docs, vocabulary))


#: A public vocabulary; its path is a parameter of ``read_model``.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), pieces.read_model(MODEL_PATH))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "mix.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(_table(spark, sf_dir, "documents"))
    return _ordered(judged, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))
    return _ordered(found, "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit_text_model(docs)).select("doc_id", "lid.*")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the language of their markup, the suffix and host of their address, and the model of the documents."""
    model = language.fit_text_model(_table(spark, sf_dir, "documents"))
    pages = _table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>|&\w+;", " ").alias("text"),
        F.regexp_extract("html", r"(?i)<html[^>]*\slang=[\"']?([a-z]+)", 1).alias("lang"),
        F.lower(F.regexp_extract("url", "^[^:/]+://([^/:?#]+)", 1)).alias("host"),
    )
    found = language.identify(pages, model, host="host", suffix=language.address_suffix(F.col("host")))
    return found.select("page_id", "lid.*")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.usable(_table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return conversation_repair.digests(conversation_repair.damaged(rows), rows)


def op13_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = pieces.read_model(public_tokenizers.path("word_bpe_49k.json")).decode()
    return pattern_packing.pack(_table(spark, sf_dir, "documents"), model)


QUERIES = {
    "op10_html_extraction": op10_html_extraction,
    "op1_suffix_dedup": op1_suffix_dedup,
    "language_id_pages": language_id_pages,
    "op7_language_id": op7_language_id,
    "op8_near_dedup": op8_near_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op9_lm_scoring": op9_lm_scoring,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_fingerprints": op6_fingerprints,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_pattern_packing": op13_pattern_packing,
}

# The given pages' articles hold headings, paragraphs, bold text, line breaks and a few character references.
_ARTICLE = r"""
    SELECT page_id, url, text, len(text) AS n_chars FROM (
        SELECT page_id, url, array_to_string([y FOR y IN [
                   trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                       x, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))
                   FOR x IN string_split_regex(
                       regexp_replace(regexp_replace(body, '<br>', ' ', 'g'), '</?b>', '', 'g'), '</?(?:p|h1)>')
               ] IF y <> ''], chr(10) || chr(10)) AS text
        FROM (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1),
                                                  '<[a-z/!][^>]*$', '') AS body FROM pages))
"""

# The checksum bit by bit, and the repair as the least cost and edits to go for each state of the grammar, from the last row
# on: after nothing, a system, a user or an assistant turn. Letters are role initials, capitals where a row is cut short.
_DELETE, _INSERT = "struct_pack(c := {0}.c + 3, a := 'D' || {0}.a)", "struct_pack(c := {0}.c + 2, a := 'I' || {0}.a)"
_KEEP = "CASE WHEN {1} THEN struct_pack(c := {0}.c + cut, a := 'K' || {0}.a) END"
_REROLE = "CASE WHEN r <> 'x' THEN struct_pack(c := {0}.c + 2 + cut, a := 'R' || {0}.a) END"


def _own(state: str, *kept: tuple[str, str], after: str) -> str:
    options = [_DELETE.format(state), *(_KEEP.format(*k) for k in kept), _REROLE.format(after)]
    return f"list_min([{', '.join(options)}])"


_REPAIR = f"""
    WITH RECURSIVE
    crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    hashed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                       string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                       lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
        FROM conversations, crc),
    rows AS (
        SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM hashed, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) WHERE h <> 0),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, regexp_replace(text, '[ \t-\r]+$', '') AS said
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM rows)),
    marked AS (
        SELECT *, CASE WHEN said = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                       WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
        FROM placed),
    togo AS (
        SELECT conv_id, max(i) + 1 AS i, struct_pack(c := 0, a := '') AS q0, struct_pack(c := 4, a := 'II') AS q1,
               struct_pack(c := 2, a := 'I') AS q2, struct_pack(c := 0, a := '') AS q3 FROM marked GROUP BY 1
        UNION ALL
        SELECT conv_id, i, list_min([o0, {_INSERT.format('z2')}]), list_min([o1, {_INSERT.format('z2')}]), z2, z3
        FROM (SELECT *, list_min([o2, {_INSERT.format('o3')}]) AS z2, list_min([o3, {_INSERT.format('o2')}]) AS z3
              FROM (SELECT conv_id, i, {_own('q0', ('q1', "r = 's'"), ('q2', "r = 'u'"), after='q2')} AS o0,
                           {_own('q1', ('q2', "r = 'u'"), after='q2')} AS o1,
                           {_own('q2', ('q3', "r = 'a'"), after='q3')} AS o2,
                           {_own('q3', ('q2', "r = 'u'"), after='q2')} AS o3
                    FROM (SELECT m.conv_id, m.i, q0, q1, q2, q3, (fault = 'truncated')::INT AS cut,
                                 CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' ELSE initial END AS r
                          FROM togo JOIN marked m ON m.conv_id IS NOT DISTINCT FROM togo.conv_id AND m.i = togo.i - 1)))),
    best AS (SELECT conv_id, q0.c AS cost, q0.a AS audit FROM togo WHERE i = 1),
    kept AS (
        SELECT conv_id, k, substr(audit, k, 1) AS e, (SELECT count(*) FROM range(1, k + 1) t(j) WHERE substr(audit, j, 1) <> 'I') AS i
        FROM best, unnest(range(1, len(audit) + 1)) u(k) WHERE substr(audit, k, 1) <> 'D'),
    turns AS (
        SELECT kept.conv_id, k, e, role, text, bool_or(e = 'K' AND role LIKE 's%') OVER (PARTITION BY kept.conv_id) AS opened,
               row_number() OVER (PARTITION BY kept.conv_id ORDER BY k) AS place
        FROM kept LEFT JOIN placed ON kept.conv_id IS NOT DISTINCT FROM placed.conv_id AND placed.i = kept.i),
    whole AS (
        SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (place + opened::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                          || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS repaired_sha256
        FROM turns GROUP BY 1)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
           coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                      count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY 1) m
        ON m.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN whole ON whole.conv_id IS NOT DISTINCT FROM c.conv_id
"""

# Hexadecimal digits stand for bytes, two each. A run goes on while the next window begins at most 50 bytes later.
ORACLES = {
    "op12_conversation_repair": _REPAIR,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), true))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
              FROM v a, v b WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same AND vec_id <> anchor_id
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
             AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5
    """,
    "op10_html_extraction": _ARTICLE,
    "op1_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS MATERIALIZED (
            SELECT doc_id, p, md5(substr(h, 2 * p + 1, 100)) AS s
            FROM (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - 49, 0))) AS p FROM d)),
        gone AS (
            SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, true) AS fresh
            FROM w JOIN (SELECT s, min(doc_id) AS least FROM w GROUP BY s) USING (s) WHERE least < doc_id),
        runs AS (
            SELECT doc_id, min(p) AS a, max(p) + 50 AS b
            FROM (SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gone)
            GROUP BY doc_id, run),
        ends AS (
            SELECT doc_id, a AS till, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM runs
            UNION ALL
            SELECT doc_id, len(h) // 2, coalesce(b, 0) FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM runs GROUP BY 1) USING (doc_id)),
        kept AS (
            SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (till - since)), '' ORDER BY since) AS k
            FROM ends JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, len(h) // 2 AS n_bytes, (len(h) - len(k)) // 2 AS n_removed, coalesce(n, 0) AS n_spans,
               sha256(unhex(k)) AS kept_sha256
        FROM d JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM runs GROUP BY 1) USING (doc_id)
    """,
}
