"""Registered queries of the subpackage: each applies one operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_repair, decontamination, html_extraction, language_id, license_scan, near_dedup, piece_encoding, sharding,
               spelling_groups, token_counts, token_output, toxicity, vector_search)
from .common import id_bucket, table, work_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return token_output.read_tokens(spark, path)


def op2_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return piece_encoding.encode_documents(docs, tokenizer_path("piece_bpe_32k.model")).drop("ids")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), id_bucket(F.col("doc_id"), 5) != 0)
    scored = toxicity.score_toxicity(docs, model, ["doc_id"])
    return scored.select("doc_id", (id_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.templates(spark))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"))


def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), sharding.uniform_tree(3, 2, 4))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, id_bucket(F.col("doc_id"), 4) != 2)
    found = language_id.identify(docs, model, ["doc_id"])
    return found.select("doc_id", (id_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), limit=2048)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.group_spellings(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_output, op2_piece_encoding, op3_toxicity, op4_license_scan, op5_near_dedup, op6_vector_search,
        op7_sharding, op8_language_id, op9_token_counts, op10_decontamination, op11_html_extraction, op12_conversation_repair,
        op13_spelling_groups)
}

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# crc32 in SQL: its table of 256 rows from the polynomial, then one look-up a byte of UTF-8 text below U+0800.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
                    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS t)"""


def _crc32(text: str) -> str:
    codes = (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] "
             f"ELSE [(192 | (unicode(c) >> 6))::BIGINT, (128 | (unicode(c) & 63))::BIGINT] END))")
    return f"xor(list_reduce({codes}, lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295::BIGINT), 4294967295)"


_WORDS = f"regexp_extract_all({_ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL: dict[str, str] = {
    "op6_vector_search": """
        WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                     AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        pairs AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(
                          list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
                  FROM (SELECT vec_id, min(e) AS e FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id) q
                  JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op10_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        windows AS (SELECT DISTINCT item_id, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS k, least(len(w), 13) AS n
                    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
        places AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w
               FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
        hits AS (SELECT doc_id, s, p.n, item_id FROM places p JOIN windows
                 ON p.n = windows.n AND array_to_string(w[s:s + p.n - 1], ' ') = k),
        marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                   FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op12_conversation_repair": f"""
        WITH RECURSIVE {_CRC_TABLE},
        raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                       {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS harm
                FROM conversations, crc),
        damaged AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
                           CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                           unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
                    FROM raw WHERE harm <> 0),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role || ':' || text, role, copy) AS i,
                          row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged),
        told AS (SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
                        CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                             WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault
                 FROM placed),
        counted AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                           count(*) FILTER (fault = 'truncated') AS truncated,
                           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
                    FROM told GROUP BY conv_id),
        inserts(s, x, price, letters, added) AS (VALUES
            ('', '', 0, '', []::VARCHAR[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
            ('', 'u', 2, 'I', ['user:']), ('s', 'u', 2, 'I', ['user:']), ('a', 'u', 2, 'I', ['user:']), ('u', 'a', 2, 'I', ['assistant:']),
            ('', 'a', 4, 'II', ['user:', 'assistant:']), ('s', 'a', 4, 'II', ['user:', 'assistant:'])),
        edits(op) AS (VALUES ('D'), ('K'), ('R')),
        best AS (
            SELECT conv_id, 0::BIGINT AS i, '' AS s, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counted
            UNION ALL
            SELECT conv_id, i, s, least_of.c, least_of.a, least_of.l
            FROM (SELECT conv_id, i, s, min({{'c': cost, 'a': audit, 'l': lines}}) AS least_of
                  FROM (SELECT b.conv_id, r.i, CASE op WHEN 'D' THEN x WHEN 'K' THEN initial WHEN 'R' THEN CASE x WHEN 'u' THEN 'a' ELSE 'u' END END AS s,
                               b.cost + price + CASE op WHEN 'D' THEN 3 WHEN 'K' THEN 0 ELSE 2 END
                                   + CASE WHEN op <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END AS cost,
                               b.audit || letters || op AS audit,
                               list_concat(list_concat(b.lines, added), CASE op WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
                                   ELSE [CASE x WHEN 'u' THEN 'assistant:' ELSE 'user:' END || text] END) AS lines
                        FROM best b JOIN inserts ON inserts.s = b.s
                        JOIN told r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1, edits
                        WHERE op = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (op = 'R' OR
                              (initial <> '' AND contains(CASE x WHEN '' THEN 'su' WHEN 'u' THEN 'a' ELSE 'u' END, initial)))))
                  GROUP BY conv_id, i, s)),
        ended AS (SELECT b.conv_id, min({{'c': b.cost + price, 'a': b.audit || letters, 'l': list_concat(b.lines, added)}}) AS z
                  FROM best b JOIN counted k ON k.conv_id IS NOT DISTINCT FROM b.conv_id AND k.n = b.i
                  JOIN inserts ON inserts.s = b.s WHERE x IN ('', 'a') GROUP BY b.conv_id),
        ids AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(z.c, 0)::BIGINT AS cost,
               coalesce(z.a, '') AS audit, sha256(coalesce(array_to_string(z.l, chr(10)), '')) AS repaired_sha256
        FROM ids LEFT JOIN counted k ON k.conv_id IS NOT DISTINCT FROM ids.conv_id
        LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id""",
    "op13_spelling_groups": f"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (SELECT doc_id, unnest(regexp_extract_all({_ASCII_LOWER}, '[A-Za-z\u00C0-\u00FF]{{7,}}')) AS run FROM documents),
        keyed AS (SELECT run, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h, copies
                  FROM (SELECT doc_id, run, count(*) AS copies FROM runs GROUP BY ALL), crc),
        harmed AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, copies
                   FROM keyed),
        words AS (SELECT word, sum(copies)::BIGINT AS n FROM harmed WHERE length(word) >= 7 GROUP BY word HAVING sum(copies) >= 2),
        cut AS (SELECT word, i, left(word, i - 1) AS head, substr(word, i + 1) AS tail
                FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
        pairs AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
                  UNION SELECT cut.word, w.word FROM cut JOIN words w ON w.word = head || tail
                  UNION SELECT w.word, cut.word FROM cut JOIN words w ON w.word = head || tail),
        best AS (SELECT p.word, count(*) AS n_near, min({{'fewer': -w.n, 'near': near}}) AS z FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word),
        judged AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -z.fewer >= 10 * w.n THEN z.near END AS form,
                          CASE WHEN -z.fewer >= 10 * w.n THEN -z.fewer END AS form_n FROM words w LEFT JOIN best USING (word)),
        chain AS (SELECT word, word AS root FROM judged UNION ALL
                  SELECT chain.word, form FROM chain JOIN judged ON judged.word = chain.root WHERE form IS NOT NULL)
        SELECT j.word, form, chain.root, j.n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
        FROM judged j JOIN chain ON chain.word = j.word
        WHERE NOT EXISTS (FROM judged k WHERE k.word = chain.root AND k.form IS NOT NULL)""",
}
