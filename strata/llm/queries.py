"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (chat, decontaminate, jaccard, language, license_scan, neighbours, ngram_model, packing, phrases,
                        prefix_trie, substrings, suffix_dedup, toxicity)
from strata.llm.common import documents


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(documents(spark, sf_dir))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(documents(spark, sf_dir))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(documents(spark, sf_dir, "embeddings"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_model.scores(documents(spark, sf_dir))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(documents(spark, sf_dir, "conversations"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, sf_dir))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(documents(spark, sf_dir, "conversations"))


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top; it imports this subpackage

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": _op1,
        "op2_language_id": _op2,
        "op3_decontaminate": _op3,
        "op4_license_scan": _op4,
        "op5_toxicity": _op5,
        "op6_nearest": _op6,
        "op7_lm_score": _op7,
        "op8_jaccard_join": _op8,
        "op9_chat_format": _op9,
        "op10_pack": _op10,
        "op11_phrases": _op11,
        "op12_suffix_dedup": _op12,
        "op13_prefix_trie": _op13,
        "pipeline": _pipeline,
    }


#: Repeated windows of 13 words, removed from all but the smallest document that has them.
_OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     win AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS win
             FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM w)),
     least AS (SELECT win, min(doc_id) AS m FROM win GROUP BY win),
     hit AS (SELECT DISTINCT doc_id, i FROM (SELECT win.doc_id, unnest(range(p, p + 13)) AS i
                                             FROM win JOIN least ON win.win = least.win WHERE m < win.doc_id)),
     word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
     kept AS (SELECT word.doc_id, count(hit.i) AS n_removed,
                     string_agg(word, ' ' ORDER BY word.i) FILTER (WHERE hit.i IS NULL) AS kept
              FROM word LEFT JOIN hit ON word.doc_id = hit.doc_id AND word.i = hit.i GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""

#: Document words in an occurrence of a benchmark window.
_OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
     b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
     bw AS (SELECT DISTINCT item_id, k, array_to_string(ws[p:p + k - 1], ' ') AS win
            FROM (SELECT item_id, ws, least(13, len(ws)) AS k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p
                  FROM b WHERE len(ws) > 0)),
     sizes AS (SELECT DISTINCT k FROM bw),
     dw AS (SELECT doc_id, p, k, array_to_string(ws[p:p + k - 1], ' ') AS win
            FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d, sizes WHERE len(ws) >= k)),
     found AS (SELECT dw.doc_id, dw.p, dw.k, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k),
     hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit
             FROM (SELECT doc_id, unnest(range(p, p + k)) AS i FROM found) GROUP BY doc_id),
     items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

#: Counts of words and of phrases of two and three words, their lowest-scoring cuts, and the first 2000 of each language.
_OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
     p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
     w AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p),
     g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
           FROM (SELECT lang, ws, i, unnest([1, 2, 3]) AS k FROM w) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
     n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
     c AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM g WHERE k > 1 AND f >= 10),
     cut AS (SELECT lang, k, phrase, f, j, array_to_string(ws[:j], ' ') AS x, array_to_string(ws[j + 1:], ' ') AS y
             FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
     s AS (SELECT cut.lang, cut.k, cut.phrase, cut.f, j, l.f AS l, r.f AS r,
                  (1000000::HUGEINT * cut.f * cut.f) // (l.f::HUGEINT * r.f) AS score
           FROM cut JOIN g l ON l.lang = cut.lang AND l.phrase = x AND l.k = j JOIN g r ON r.lang = cut.lang AND r.phrase = y AND r.k = cut.k - j),
     b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
     inside AS (SELECT lang, phrase, max(f) AS f FROM (SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
                FROM c WHERE k = 3) GROUP BY lang, phrase),
     kept AS (SELECT b.* FROM b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase AND b.k = 2
              WHERE i.f IS NULL OR 100 * i.f < 50 * b.f),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, CAST(ranked.f AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000"""

#: Bytes (as two hex digits each) covered by a string of 100 that also starts earlier.
_OP12_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
     part AS (SELECT doc_id, a, len(x) // 2 AS n, substr(x, 2 * a + 1, 1198) AS x FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2, 500)) AS a FROM d)),
     win AS (SELECT doc_id, a + i AS i, substr(x, 2 * i + 1, 200) AS s FROM (SELECT doc_id, a, x, unnest(range(0, least(500, n - a - 99))) AS i FROM part)),
     least AS (SELECT s, min((doc_id, i)) AS m FROM win GROUP BY s HAVING count(*) > 1),
     hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 100)) AS i FROM win JOIN least ON win.s = least.s WHERE m < (win.doc_id, win.i)),
     byte AS (SELECT doc_id, a + i AS i, substr(x, 2 * i + 1, 2) AS b FROM (SELECT doc_id, a, x, unnest(range(0, least(500, n - a))) AS i FROM part)),
     kept AS (SELECT byte.doc_id, count(hit.i) AS n_removed, string_agg(b, '' ORDER BY byte.i) FILTER (WHERE hit.i IS NULL) AS kept
              FROM byte LEFT JOIN hit ON byte.doc_id = hit.doc_id AND byte.i = hit.i GROUP BY byte.doc_id),
     spans AS (SELECT doc_id, count(*) AS n_spans FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit)
               WHERE before IS NULL OR before < i - 1 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN spans ON d.doc_id = spans.doc_id"""

#: Rebuilt conversations as lists of turns; a node is a distinct prefix. CRC-32 bit by bit.
_OP13_SQL = r"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
     l AS (SELECT conv_id, list(len(role) || ':' || role || text ORDER BY i) AS own FROM o GROUP BY conv_id),
     h AS (SELECT conv_id, own, conv_id - conv_id % 100 AS base,
                  xor(list_reduce(flatten([[4294967295]] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
                      lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END),
                    4294967295) % 6 AS h FROM l),
     r AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[:h], h.own[h + 1:]) AS seq FROM h LEFT JOIN l b ON b.conv_id = h.base),
     p AS (SELECT conv_id, seq, len(seq) AS n, unnest(range(0, len(seq) + 1)) AS depth FROM r),
     m AS (SELECT conv_id, n, depth, md5(CAST(seq[:depth] AS VARCHAR)) AS node, md5(CAST(seq[:depth - 1] AS VARCHAR)) AS above,
                  len(seq[depth]) - strpos(seq[depth], ':') - CAST(split_part(seq[depth], ':', 1) AS BIGINT) AS chars FROM p),
     nodes AS (SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(above) AS above,
                      CASE WHEN depth > 0 THEN (count(*) - 1) * any_value(chars) ELSE 0 END AS saved,
                      string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth) AS ends
               FROM m GROUP BY depth, node),
     kids AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
     full_ AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, node)),
     -- every node's path from the root, along its smallest member
     up AS (SELECT full_.depth AS d, full_.saved, full_.n_children, m.depth, m.node
            FROM full_ JOIN m ON m.conv_id = full_.conv_id AND m.depth <= full_.depth),
     sums AS (SELECT depth, node, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM up GROUP BY ALL)
SELECT f.conv_id, f.depth, parent.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(f.ends, '')) AS ends_sha256
FROM full_ f JOIN sums USING (depth, node) LEFT JOIN nodes parent ON f.depth > 0 AND parent.depth = f.depth - 1 AND parent.node = f.above"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL expresses; the others are tested against brute force."""
    return {"op1_substring_dedup": _OP1_SQL, "op3_decontaminate": _OP3_SQL, "op11_phrases": _OP11_SQL, "op12_suffix_dedup": _OP12_SQL,
            "op13_prefix_trie": _OP13_SQL}
