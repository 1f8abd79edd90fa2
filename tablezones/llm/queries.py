"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablezones.llm import decontam, itq_dedup, jaccard_join, line_dedup, packing, pii_crf, quality_gam, quotes, subword_toxicity, token_files, turn_repair, warc, word_runs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_decontam_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(documents, counts=True)


def op4_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find_personal_data(_table(spark, sf_dir, "documents"))


def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = token_files.write_token_files(_table(spark, sf_dir, "documents"))
    return token_files.read_token_files(spark, folder, manifest)


def op7_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_dedup.similar_vectors(_table(spark, sf_dir, "embeddings"))


def op8_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op9_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("conv_id", "turn", "role", "reply_to", "depth", "n_quoted", "text", "chat")
    return quotes.reply_ordered(_table(spark, sf_dir, "conversations")).select(*columns)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(_table(spark, sf_dir, "documents"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_damaged(_table(spark, sf_dir, "conversations"))


def op12_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.periodic_runs(_table(spark, sf_dir, "documents"), plant=True)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_decontam_bm25": op2_decontam_bm25,
    "op3_line_dedup": op3_line_dedup,
    "op4_pii_crf": op4_pii_crf,
    "op5_quality_gam": op5_quality_gam,
    "op6_token_files": op6_token_files,
    "op7_itq_dedup": op7_itq_dedup,
    "op8_warc_chunks": op8_warc_chunks,
    "op9_quote_links": op9_quote_links,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_turn_repair": op11_turn_repair,
    "op12_subword_toxicity": op12_subword_toxicity,
    "op13_word_runs": op13_word_runs,
}

ORACLES: dict[str, str] = {
    "op9_quote_links": r"""
        WITH RECURSIVE l AS (
            SELECT r, conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
            FROM (SELECT *, row_number() OVER () AS r FROM conversations)
            WHERE text IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL
        ), parsed AS (
            SELECT r, conv_id, turn, i, length(regexp_replace(regexp_extract(line, '^[ \t]*(?:>[ \t]*)*'), '[^>]', '', 'g')) AS level,
                   lower(trim(regexp_replace(regexp_replace(line, '^[ \t]*(?:>[ \t]*)*', ''), '[ \t]+', ' ', 'g'), ' ')) AS plain FROM l
        ), turned AS (
            SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY r ORDER BY i) THEN 0 ELSE 1 END AS fresh FROM parsed WHERE plain <> ''
        ), numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS block FROM turned),
        passages AS (
            SELECT conv_id, turn, level, string_split(string_agg(plain, ' ' ORDER BY i), ' ') AS w FROM numbered GROUP BY r, block, conv_id, turn, level
        ), lines AS (
            SELECT conv_id, turn, level, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END) AS plain FROM passages
            UNION
            SELECT conv_id, turn, level, plain FROM parsed WHERE level = 0 AND plain <> '' AND len(string_split(plain, ' ')) < 5
        ), found AS (
            SELECT q.conv_id, q.turn, q.level, q.plain, max(o.turn) AS origin FROM lines q
            JOIN lines o ON o.conv_id = q.conv_id AND o.plain = q.plain AND o.turn < q.turn AND o.level = 0
            WHERE q.level > 0 GROUP BY ALL
        ), votes AS (SELECT conv_id, turn, level, origin, count(*) AS hits FROM found GROUP BY ALL),
        best AS (
            SELECT conv_id, turn, origin FROM votes
            QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, hits DESC, origin DESC) = 1
        ), keys AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
        parent AS (
            SELECT k.conv_id, k.turn, coalesce(b.origin, p.turn) AS reply_to FROM keys k
            LEFT JOIN best b ON b.conv_id = k.conv_id AND b.turn = k.turn
            LEFT JOIN keys p ON p.conv_id = k.conv_id AND p.turn = k.turn - 1
        ), tree AS (
            SELECT conv_id, turn, reply_to, CAST(0 AS BIGINT) AS depth FROM parent WHERE reply_to IS NULL
            UNION ALL
            SELECT p.conv_id, p.turn, p.reply_to, t.depth + 1 FROM parent p JOIN tree t ON t.conv_id = p.conv_id AND t.turn = p.reply_to
        ), own AS (
            SELECT *, list_filter(string_split(text, chr(10)), lambda x: NOT contains(regexp_extract(x, '^[ \t]*(?:>[ \t]*)*'), '>')) AS kept FROM conversations
        ), clean AS (
            SELECT *, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) - len(kept) END AS BIGINT) AS n_quoted FROM own
        ), done AS (
            SELECT conv_id, turn, role, n_quoted, CASE WHEN n_quoted = 0 THEN text ELSE trim(array_to_string(kept, chr(10)), ' ') END AS text FROM clean
        )
        SELECT d.conv_id, d.turn, d.role, t.reply_to, coalesce(t.depth, 0) AS depth, d.n_quoted, d.text,
               '<|' || coalesce(d.role, '') || '|>' || chr(10) || coalesce(d.text, '') || chr(10) AS chat
        FROM done d LEFT JOIN tree t ON t.conv_id = d.conv_id AND t.turn = d.turn""",
    "op8_warc_chunks": f"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages WHERE page_id IS NOT NULL
        ), m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
        SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id <> top THEN top END AS refers_to
        FROM m""",
    "op3_line_dedup": f"""
        WITH pages AS MATERIALIZED (SELECT *, row_number() OVER () AS r FROM documents), lines AS (
            SELECT r, source, l.i AS i, l.line AS line
            FROM (SELECT r, source, unnest(list_zip(string_split(text, chr(10)), range(1, len(string_split(text, chr(10))) + 1))) AS z FROM pages) t,
                 LATERAL (SELECT z[1] AS line, z[2] AS i) l
        ), total AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
        common AS (
            SELECT source, trim(line, ' ') AS line, count(DISTINCT r) AS n FROM lines
            WHERE trim(line, ' ') <> '' GROUP BY 1, 2
        ), bad AS (
            SELECT c.source, c.line FROM common c JOIN total t ON c.source IS NOT DISTINCT FROM t.source
            WHERE c.n >= {line_dedup.MIN_PAGES} AND c.n > t.total * CAST({line_dedup.RATIO} AS DOUBLE)
        ), judged AS (
            SELECT a.r, a.i, a.line, b.line IS NOT NULL AS dropped FROM lines a
            LEFT JOIN bad b ON a.source IS NOT DISTINCT FROM b.source AND trim(a.line, ' ') = b.line
        ), done AS (
            SELECT r, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped) AS clean,
                   count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped
            FROM judged GROUP BY r
        )
        SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(clean, '') END AS text,
               coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
        FROM pages d LEFT JOIN done USING (r)""",
}
