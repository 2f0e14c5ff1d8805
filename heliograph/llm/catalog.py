"""The queries of this subpackage: opN_<name>(spark, sf_dir), pipeline, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from heliograph.llm import chat_format, curriculum, exact_dedup, jaccard_join, packing, perplexity, quality_crf, token_store, url_filter, warc
from heliograph.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op2_quality_crf(spark, sf_dir):
    return quality_crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op4_harmonic_packing(spark, sf_dir):
    return packing.report(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op5_warc_archive(spark, sf_dir):
    return warc.report(table(spark, sf_dir, "pages"))


def op6_curriculum_mix(spark, sf_dir):
    rows = curriculum.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies", F.round("position", 9).alias("position"))


def op7_perplexity_rules(spark, sf_dir):
    return perplexity.rules(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op9_token_files(spark, sf_dir):
    return token_store.report(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_chat_format(spark, sf_dir):
    from heliograph.runtime import saved

    rows = saved(chat_format.examples(chat_format.with_probe(table(spark, sf_dir, "conversations"))), "chat-examples")
    return chat_format.report(rows)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {f.__name__: f for f in (
        op1_url_filter, op2_quality_crf, op3_exact_dedup, op4_harmonic_packing, op5_warc_archive, op6_curriculum_mix,
        op7_perplexity_rules, op8_jaccard_join, op9_token_files, op10_chat_format, pipeline,
    )}


_ESCAPED = "replace({0}, '\\', '\\\\')"
for _c in chat_format.CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"

SQL = {
    "op3_exact_dedup": r"""
        WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
             w AS (SELECT doc_id, body, points,
                          first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
                          count(*) OVER (PARTITION BY body) AS group_size FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM w""",
    "op5_warc_archive": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS bytes FROM pages),
             w AS (SELECT page_id, bytes, sha1(body) AS digest, max(page_id) OVER (PARTITION BY body) AS latest FROM p)
        SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
               CASE WHEN bytes >= 1000 AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN bytes >= 1000 AND page_id <> latest THEN latest END AS refers_to FROM w""",
    "op6_curriculum_mix": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
             s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
             n AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS slot FROM s),
             r AS (SELECT *, [3, 1, 2][slot + 1] AS weight FROM n),
             o AS (SELECT *, row_number() OVER (ORDER BY source_size * 2 / weight, source NULLS LAST) AS k,
                          sum(source_size) OVER () AS total FROM r),
             l AS (SELECT *, total * 3 / 2 - coalesce(sum(source_size * 2) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                          sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM o),
             f AS (SELECT *, rest * weight >= source_size * 2 * weight_left AS capped FROM l),
             v AS (SELECT arg_min(rest, k) AS rest, arg_min(weight_left, k) AS weight_left FROM f WHERE NOT capped),
             t AS (SELECT f.source, f.source_size, f.slot,
                          CASE WHEN capped THEN (source_size * 2)::DOUBLE ELSE v.rest * f.weight / v.weight_left END::DOUBLE AS target
                   FROM f LEFT JOIN v ON true),
             c AS (SELECT doc_id, size, t.source_size, t.target, t.slot, floor(t.target)::BIGINT AS goal,
                          coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR), doc_id
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
                   FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
             k AS (SELECT *, (greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - start - source_size)))::BIGINT AS taken,
                          (size > 0 AND 2 * (goal - start) >= size)::INT + (size > 0 AND 2 * (goal - start - source_size) >= size)::INT AS copies,
                          CASE WHEN target > 0 THEN start / target END AS share FROM c)
        SELECT doc_id, size, source_size, target, taken, copies, round(CASE WHEN taken > 0 THEN least(1, greatest(0, CASE slot
                   -- rates of 1.5, 1 and 0.5 over thirds of the time; 1 throughout; 0.5, 1 and 1.5
                   WHEN 0 THEN CASE WHEN share <= 1 / 2 THEN share / 1.5 WHEN share <= 5 / 6 THEN 1 / 3 + (share - 1 / 2) ELSE 2 / 3 + (share - 5 / 6) / 0.5 END
                   WHEN 1 THEN share
                   ELSE CASE WHEN share <= 1 / 6 THEN share / 0.5 WHEN share <= 1 / 2 THEN 1 / 3 + (share - 1 / 6) ELSE 2 / 3 + (share - 1 / 2) / 1.5 END
               END)) END, 9) AS position FROM k""",
    "op10_chat_format": rf"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-1, 0, 'user', '{chat_format.PROBE}'), (-1, 1, 'assistant', '{chat_format.PROBE}')),
             l AS (SELECT *, {len(chat_format.START + chat_format.SEP + chat_format.END)} + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}) AS size,
                          lead(turn) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NULL AS is_last FROM c),
             p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM l)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               (sum(upto) FILTER (role = 'assistant' OR is_last))::BIGINT AS formatted_chars
        FROM p GROUP BY conv_id""",
}


def oracle_sql():
    return dict(SQL)
