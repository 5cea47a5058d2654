"""The queries of this package and, where SQL can express them, the same results in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girolens.llm import (
    bpe,
    chat,
    decontaminate,
    fingerprints,
    html_wrappers,
    merkle,
    near_dedup,
    periodic_runs,
    quality,
    secrets,
    suffix_dedup,
    token_blocks,
    url_filter,
)
from girolens.llm.common import shared_folder, table

#: The rules of the URL filter query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def op3_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.main_text(table(spark, sf_dir, "pages"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("regions") > 0).alias("contaminated"), F.size("regions").cast("long").alias("n_regions"),
                        F.array_sort(F.array_distinct("regions.item_id")).alias("item_ids"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"), n=3, percent=85)


def op10_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.round_trip(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.strongest(periodic_runs.find(periodic_runs.planted(table(spark, sf_dir, "documents"))))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = f"{shared_folder(spark)}/secrets-{uuid.uuid4().hex}"
    secrets.scan(docs, ledger)
    return secrets.told(secrets.findings(docs, ledger))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_bpe": op2_bpe,
    "op3_html_wrappers": op3_html_wrappers,
    "op4_fingerprints": op4_fingerprints,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_near_dedup": op9_near_dedup,
    "op10_token_blocks": op10_token_blocks,
    "op11_merkle": op11_merkle,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_secrets": op13_secrets,
}

ORACLE: dict[str, str] = {
    "op8_url_filter": r"""
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://')
                THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), bare AS (
            SELECT page_id, split_part(split_part(rest, '#', 1), '?', 1) AS rest FROM cut
        ), parts AS (
            SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS host, substr(rest, length(split_part(rest, '/', 1)) + 1) AS path
            FROM bare
        ), rules(r_host, r_path, r_verdict) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        ), hits AS (
            SELECT page_id, max_by(struct_pack(rule := r_host || r_path, verdict := r_verdict),
                length(r_host || r_path)) AS best
            FROM parts, rules
            WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
            GROUP BY page_id
        )
        SELECT p.page_id, p.host, p.path, h.best.rule AS rule, coalesce(h.best.verdict, 'allow') AS verdict
        FROM parts p LEFT JOIN hits h ON p.page_id = h.page_id""",
    "op11_merkle": r"""
        WITH RECURSIVE base AS (
            SELECT doc_id, source, text,
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(str_split(doc_id::VARCHAR, ''),
                    lambda d: ascii(d)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                    lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 5 = 0 AS tampers
            FROM documents
        ), leaves AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                CASE WHEN tampers THEN sha256(head || coalesce(strlen(text) || ':' || translate(text,
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS other
            FROM base
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree, count(*) OVER (PARTITION BY source) AS n
            FROM leaves
        ), low AS (
            SELECT tree, 0 AS level, place AS idx, n, leaf AS node FROM placed
            UNION ALL
            SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY idx))
            FROM low WHERE n > 1 GROUP BY tree, level, idx // 16, n
        ), tops AS (
            SELECT tree, node AS subroot, tree - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1
        ), high AS (
            SELECT 0 AS level, idx, n, subroot AS node FROM tops
            UNION ALL
            SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY idx))
            FROM high WHERE n > 1 GROUP BY level, idx // 16, n
        ), nodes AS (
            SELECT tree, level, idx, node FROM low WHERE n > 1
            UNION ALL SELECT 0, level, idx, node FROM high WHERE n > 1
        ), steps AS (
            SELECT tree, level, idx,
                coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM nodes WINDOW run AS (PARTITION BY tree, level, idx // 16 ORDER BY idx)
        ), depths AS (
            SELECT tree, max(level) + 1 AS depth FROM steps GROUP BY tree
        ), paths AS (
            SELECT p.tree, p.place, s.level AS k, s.l, s.r
            FROM (SELECT DISTINCT tree, place FROM placed) p JOIN steps s ON s.tree = p.tree AND s.idx = p.place // (16 ** s.level)::BIGINT
            UNION ALL
            SELECT p.tree, p.place, coalesce(d.depth, 0) + s.level, s.l, s.r
            FROM (SELECT DISTINCT tree, place FROM placed) p LEFT JOIN depths d ON d.tree = p.tree
                JOIN steps s ON s.tree = 0 AND s.idx = (p.tree - 1) // (16 ** s.level)::BIGINT
        ), proofs AS (
            SELECT tree, place, sha256(string_agg(l || r, '' ORDER BY k)) AS proof FROM paths GROUP BY tree, place
        ), folds AS (
            SELECT tree, place, 0 AS k, coalesce(other, leaf) AS node FROM placed
            UNION ALL
            SELECT f.tree, f.place, f.k + 1, sha256(p.l || f.node || p.r)
            FROM folds f JOIN paths p ON p.tree = f.tree AND p.place = f.place AND p.k = f.k
        ), ends AS (
            SELECT tree, place, max_by(node, k) AS folded FROM folds GROUP BY tree, place
        )
        SELECT p.doc_id, p.leaf, t.subroot, (SELECT node FROM high WHERE n = 1) AS root,
            coalesce(o.proof, sha256('')) AS proof_sha256, e.folded AS folded_root,
            e.folded = (SELECT node FROM high WHERE n = 1) AS verified
        FROM placed p JOIN tops t ON t.tree = p.tree LEFT JOIN proofs o ON o.tree = p.tree AND o.place = p.place
            JOIN ends e ON e.tree = p.tree AND e.place = p.place""",
    "op13_secrets": r"""
        WITH rules(rank, kind, pattern, part, least) AS (
            VALUES (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
                (1, 'access', '()(AKIA[A-Z0-9]+)', 2, 20), (2, 'hex', '()([0-9a-f]+)', 2, 24)
        ), texts AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
        ), cut AS (
            SELECT row, rank, kind, least, unnest(list_transform(range(1, len(m) + 1), lambda k: {'start':
                list_sum(list_transform(p[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0),
                'whole': length(m[k]), 'own': length(v[k])})) AS hit
            FROM (
                SELECT row, 0 AS rank, 'assign' AS kind, 6 AS least, regexp_extract_all(text, (SELECT pattern FROM rules WHERE rank = 0), 0) AS m,
                    regexp_extract_all(text, (SELECT pattern FROM rules WHERE rank = 0), 2) AS v,
                    string_split_regex(text, (SELECT pattern FROM rules WHERE rank = 0)) AS p FROM texts
                UNION ALL
                SELECT row, 1, 'access', 20, regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
                    string_split_regex(text, 'AKIA[A-Z0-9]+') FROM texts
                UNION ALL
                SELECT row, 2, 'hex', 24, regexp_extract_all(text, '[0-9a-f]{24,}'), regexp_extract_all(text, '[0-9a-f]{24,}'),
                    string_split_regex(text, '[0-9a-f]{24,}') FROM texts
            )
        ), held AS (
            SELECT row, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
                string_agg(kind || ':' || hit.start::BIGINT || ':' || (hit.start + hit.whole)::BIGINT, ',' ORDER BY hit.start, rank) AS spans
            FROM cut WHERE hit.own >= least GROUP BY row
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
            sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM texts LEFT JOIN held USING (row)""",
}
