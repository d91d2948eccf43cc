"""Registered queries of the operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import encoding_digests
from .chat_format import perspectives
from .common import table
from .exact_dedup import exact_duplicates
from .html_text import extract_main_text
from .license_scan import TEMPLATES, THRESHOLD, license_report, words_of
from .merkle_manifest import tamper_report
from .mixing import mix
from .near_dedup import near_duplicates
from .perplexity import quality_rules
from .personal_data import personal_data_report
from .token_alignment import align
from .token_counts import count_tokens
from .toxicity import score_toxicity, train


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encoding_digests(docs, path, public_tokenizers.PATTERN)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=4)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(table(spark, sf_dir, "conversations"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(docs, *paths)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tamper_report(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents")).drop("blocks")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_near_dedup": op5_near_dedup,
    "op6_html_text": op6_html_text,
    "op7_token_counts": op7_token_counts,
    "op8_chat_format": op8_chat_format,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_personal_data": op10_personal_data,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_license_scan": op13_license_scan,
}


def _merkle_sql(levels: int = 24, top_levels: int = 12) -> str:
    """Trees level by level: a run of three is a string of digests, a leaf's siblings what its run holds besides.

    Good for up to 3 ** ``levels`` rows of a source and 3 ** ``top_levels`` sources.
    """
    shown = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
    fields = [shown.format(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = "sha256(" + " || ".join([*fields, shown.format("text")]) + ")"
    altered = "sha256(" + " || ".join([*fields, shown.format("replace(text, chr(10), '')")]) + ")"
    # eight shifts a byte, the first of which takes the byte in
    crc = """xor(list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
            lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT)"""
    parts = [
        f"""WITH given AS (
            SELECT row_number() OVER () AS row, doc_id, source, {text} AS leaf, {altered} AS altered, {crc} AS crc
            FROM documents
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   CASE WHEN crc % 2 = 0 THEN altered ELSE leaf END AS tried
            FROM given
        ), n0 AS (SELECT coalesce('s' || source, 'n') AS tree, place, leaf AS digest FROM placed
        ), t0 AS (SELECT *, coalesce('s' || source, 'n') AS tree, '' AS siblings FROM placed"""
    ]

    def climb(nodes: str, rows: str, count: int) -> None:
        for i in range(count):
            width = 3 ** (i + 1)
            parts.append(
                f"""), r{nodes}{i} AS (
            SELECT tree, place // 3 AS place, string_agg(digest, '' ORDER BY place) AS run,
                   max(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {nodes}{i}) GROUP BY 1, 2
        ), {nodes}{i + 1} AS (
            SELECT tree, place, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS digest FROM r{nodes}{i}
        ), {rows}{i + 1} AS (
            SELECT t.* EXCLUDE (cut) REPLACE (
                CASE WHEN n > 1 THEN sha256(run[:cut] || tried || run[cut + 65:]) ELSE tried END AS tried,
                CASE WHEN n > 1 THEN siblings || run[:cut] || run[cut + 65:] ELSE siblings END AS siblings)
            FROM (SELECT *, 64 * ((place // {width // 3}) % 3) AS cut FROM {rows}{i}) t
            JOIN r{nodes}{i} r ON r.tree = t.tree AND r.place = t.place // {width}"""
            )

    climb("n", "t", levels)
    parts.append(
        f"""), subroots AS (
            SELECT tree AS name, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM n{levels}
        ), m0 AS (SELECT 'all' AS tree, place, subroot AS digest FROM subroots
        ), u0 AS (
            SELECT t.* EXCLUDE (tree, place), 'all' AS tree, s.place, s.subroot FROM t{levels} t JOIN subroots s ON s.name = t.tree"""
    )
    climb("m", "u", top_levels)
    parts.append(
        f""")
        SELECT doc_id, leaf, subroot, digest AS root, sha256(siblings) AS proof_sha256, tried AS folded_root,
               tried = digest AS verified
        FROM u{top_levels} JOIN m{top_levels} USING (tree)"""
    )
    return "\n".join(parts)


def _license_sql() -> str:
    """Common words of every block with every template, without filters."""
    rows = []
    for number, (text, label) in enumerate(TEMPLATES):
        words = words_of(text)
        need = -(-len(set(words)) * THRESHOLD.numerator // THRESHOLD.denominator)
        rows.append(f"({number}, '{label}', {len(words)}, {need}, {sorted(set(words))})")
    return rf"""
        WITH templates(number, label, stride, need, words) AS (VALUES {", ".join(rows)}
        ), w AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM documents
        ), phrases(phrase, base_label) AS (
            VALUES (['cc', 'by'], 'cc-by'), (['general', 'public', 'license'], 'gpl'), (['all', 'rights', 'reserved'], 'reserved')
        ), places AS (
            SELECT row, base_label, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1:i + len(phrase)] = phrase)) AS start
            FROM w, phrases
        ), base AS (
            SELECT row, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
                   list_distinct(list(base_label)) AS labels FROM places GROUP BY row
        ), held AS (
            SELECT row, number, label, stride, need, len(words) AS size, pos, word
            FROM (SELECT row, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w)
            JOIN (SELECT *, unnest(words) AS word FROM templates) USING (word)
        ), contained AS (
            SELECT row, number, label, need, size, block, count(DISTINCT word) AS common
            FROM (SELECT *, unnest([pos // stride, pos // stride - 1]) AS block FROM held) WHERE block >= 0 GROUP BY ALL
        ), more AS (
            SELECT row, list_distinct(list(label)) AS labels, max(common::DOUBLE / size) AS share
            FROM contained WHERE common >= need GROUP BY row
        )
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
               coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',')
                   AS labels,
               CASE WHEN n_base IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
        FROM w LEFT JOIN base USING (row) LEFT JOIN more USING (row)
    """

ORACLES: dict[str, str] = {
    "op5_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS ws
            FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
                END AS sh
            FROM w
        ), u AS (
            SELECT doc_id, unnest(sh) AS x FROM s
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b
            WHERE 100 * n >= 80 * (len(p.sh) + len(q.sh) - n)
        ), edges AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM s
            UNION
            SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a
        ), smallest AS (
            SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
        )
        SELECT doc_id, len(sh) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM s JOIN smallest USING (doc_id)
    """,
    "op8_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, 'unknown') AS who,
                   replace(coalesce(text, ''), '<|', '<' || chr(8203) || '|') AS text
            FROM conversations
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, who, text) - 1 AS place
            FROM t
        ), participants AS (
            SELECT DISTINCT conv_id AS of, who AS participant FROM t WHERE who <> 'system'
        ), views AS (
            SELECT conv_id, participant, place // 512 AS segment, place, who = participant AS own, text,
                   CASE WHEN who = participant THEN '<|assistant|>' WHEN who = 'system' THEN '<|system|>'
                        ELSE '<|user|>' || replace(who, '<|', '<' || chr(8203) || '|') || ': ' END AS head
            FROM placed JOIN participants ON conv_id IS NOT DISTINCT FROM of
        ), offsets AS (
            SELECT *, length(head) + coalesce(sum(length(head) + length(text) + 8) OVER (
                PARTITION BY conv_id, participant, segment ORDER BY place
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
            FROM views
        )
        SELECT conv_id, participant, segment, count(*) AS n_turns, count(*) FILTER (own) AS n_own_turns,
               string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY place) AS rendered,
               coalesce(string_agg(begins || ':' || (begins + length(text)), ',' ORDER BY place) FILTER (own), '') AS mask
        FROM offsets GROUP BY conv_id, participant, segment
    """,
    "op9_exact_dedup": r"""
        WITH norm AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents
        ), grouped AS (
            SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
                   count(*) OVER (PARTITION BY norm) AS group_size
            FROM norm
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM grouped
    """,
    "op12_merkle_manifest": _merkle_sql(),
    "op13_license_scan": _license_sql(),
}
