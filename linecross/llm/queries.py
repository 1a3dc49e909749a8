"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from linecross.llm.ann import nearest_neighbours
from linecross.llm.bpe import bpe_digests
from linecross.llm.common import read_table, shared_folder, stage
from linecross.llm.conversations import repair_digests
from linecross.llm.decontaminate import find_leaks
from linecross.llm.fill_middle import fill_in_middle, restored_texts
from linecross.llm.html_text import extract_text, train_block_model
from linecross.llm.jaccard import similar_documents
from linecross.llm.langid import held_out, predict_language, train_language_model
from linecross.llm.lm import language_model_scores
from linecross.llm.packing import pack_documents
from linecross.llm.quality import quality_scores
from linecross.llm.substring_dedup import removal_digests
from linecross.llm.warc import warc_round_trip


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train_language_model(docs.where(f"NOT {held_out(3)}"))
    return predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", F.expr(held_out(3)).alias("held_out"), "lang_pred", "score")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.expr(held_out(5)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return extract_text(pages.select("page_id", "url", "html"), train_block_model(pages)).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(read_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = warc_round_trip(spark, read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf_dir, "documents"), vocabulary_path())


def op9_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return stage(pack_documents(read_table(spark, sf_dir, "documents"), shared_folder(spark, "packed"),
                                vocabulary_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, end=50256), "segments")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read_table(spark, sf_dir, "documents"))


def op11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored_texts(fill_in_middle(read_table(spark, sf_dir, "documents"))).selectExpr(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "sha2(output, 256) AS output_sha256", "sha2(restored, 256) AS restored_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_language_model": op3_language_model,
    "op4_decontamination": op4_decontamination,
    "op5_html_text": op5_html_text,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_warc": op7_warc,
    "op8_bpe": op8_bpe,
    "op9_token_packing": op9_token_packing,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_nearest_vectors": op11_nearest_vectors,
    "op12_fill_middle": op12_fill_middle,
    "op13_conversation_repair": op13_conversation_repair,
}


def _plus(key: str, cost: int | str, letters: str) -> str:
    """SQL for a way ``key`` (six digits of cost, then its letters) that goes on; null stays null."""
    return f"lpad(CAST(CAST(left({key}, 6) AS INTEGER) + {cost} AS VARCHAR), 6, '0') || substr({key}, 7) || '{letters}'"


_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split({}, ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
                                  lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)))"""

ORACLE: dict[str, str] = {
    "op7_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
             f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN coalesce(first = page_id, true) THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)""",
    "op12_fill_middle": """
        WITH h AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
             l AS (SELECT *, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS lines,
                          list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS d FROM h),
             c AS (SELECT *, len(lines) AS n, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b FROM l),
             p AS (SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle,
                          array_to_string(lines[b + 1:], '') AS suffix,
                          CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                               WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p""",
    "op13_conversation_repair": f"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_CRC32.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k
            FROM conversations),
        damaged AS (
            SELECT coalesce(conv_id, -1) AS c, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE k WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM keyed WHERE k <> 0),
        told AS (
            SELECT c, turn, role, text, left(role, 1) AS i, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
                   count(*) OVER (PARTITION BY c) AS n, regexp_extract(text, '([^ \\t\\n\\x0B\\f\\r])[ \\t\\n\\x0B\\f\\r]*$', 1) AS z,
                   CASE WHEN z = '' THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
                        WHEN z NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault,
                   lag(i) OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) || i AS pair,
                   fault IN ('sound', 'truncated') AS stays, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS more
            FROM damaged),
        walk AS (
            SELECT DISTINCT c, CAST(0 AS BIGINT) AS pos, n, '000000' AS w0, CAST(NULL AS VARCHAR) AS w1, '000003I' AS w2, '000006II' AS w3 FROM told
            UNION ALL
            SELECT c, pos, n, e0, e1, least(e2, {_plus("e0", 3, "I")}, {_plus("e1", 3, "I")}, {_plus("e3", 3, "I")}),
                   least(e3, {_plus("e2", 3, "I")}, {_plus("e0", 6, "II")}, {_plus("e1", 6, "II")})
            FROM (SELECT t.c, t.pos, t.n, {_plus("w0", 4, "D")} AS e0,
                         least({_plus("w1", 4, "D")}, CASE WHEN stays AND i = 's' THEN {_plus("w0", "more", "K")} END) AS e1,
                         least({_plus("w2", 4, "D")}, CASE WHEN stays THEN {_plus("least(w0, w1, w3)", "3 + more", "R")} END,
                               CASE WHEN stays AND i = 'u' THEN {_plus("least(w0, w1, w3)", "more", "K")} END) AS e2,
                         least({_plus("w3", 4, "D")}, CASE WHEN stays THEN {_plus("w2", "3 + more", "R")} END,
                               CASE WHEN stays AND i = 'a' THEN {_plus("w2", "more", "K")} END) AS e3
                  FROM walk JOIN told AS t ON t.c = walk.c AND t.pos = walk.pos + 1)),
        best AS (SELECT c, least(w0, w3) AS w, CAST(left(w, 6) AS BIGINT) AS cost, substr(w, 7) AS audit FROM walk WHERE pos = n),
        letters AS (SELECT c, step, substr(audit, step, 1) AS edit FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS step FROM best)),
        placed AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS pos, count(*) FILTER (edit <> 'D') OVER w AS nth
                   FROM letters WINDOW w AS (PARTITION BY c ORDER BY step)),
        given AS (SELECT p.c, step, nth, edit, CASE WHEN edit <> 'I' THEN t.role END AS role, CASE WHEN edit <> 'I' THEN t.text ELSE '' END AS text,
                        max(CASE WHEN edit = 'K' AND i = 's' AND nth = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY p.c) AS led
                 FROM placed AS p LEFT JOIN told AS t ON t.c = p.c AND t.pos = p.pos WHERE edit <> 'D'),
        hashed AS (SELECT c, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                               || ':' || text, chr(10) ORDER BY step)) AS sha FROM given GROUP BY c),
        figures AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY c)
        SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
               coalesce(sha, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS k LEFT JOIN figures AS f ON f.c = coalesce(k.conv_id, -1)
             LEFT JOIN best AS b ON b.c = f.c LEFT JOIN hashed AS h ON h.c = f.c""",
}
