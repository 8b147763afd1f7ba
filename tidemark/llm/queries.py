"""Registered queries of the operators, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.brown import brown_query
from tidemark.llm.decontaminate import decontamination_query
from tidemark.llm.jaccard_join import join_query
from tidemark.llm.line_runs import line_query
from tidemark.llm.middles import middles_query
from tidemark.llm.more_sql import MORE_ORACLES
from tidemark.llm.repair import repair_query
from tidemark.llm.shards import shard_query
from tidemark.llm.surrogates import surrogate_query
from tidemark.llm.token_files import token_file_query
from tidemark.llm.topk import top_k_query
from tidemark.llm.toxicity import toxicity_query
from tidemark.llm.url_filter import url_query
from tidemark.sources.scratch import work_dir


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; TOKENIZER_DIR overrides the installed folder."""
    import public_tokenizers

    folder = os.environ.get("TOKENIZER_DIR")
    return f"{folder}/{name}" if folder else str(public_tokenizers.path(name))


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate_query(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.tiktoken")
    out = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern(), decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_query(table(spark, sf_dir, "documents"))


def op4_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_query(table(spark, sf_dir, "documents"))


def op5_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_query(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_query(table(spark, sf_dir, "embeddings"))


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_query(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_query(table(spark, sf_dir, "documents"), work_dir(spark, "tokens"), vocabulary("byte_bpe_50k.json"), pattern())


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_query(table(spark, sf_dir, "conversations"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middles_query(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_query(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_surrogates, op2_byte_bpe, op3_jaccard_join, op4_two_pass_shuffle, op5_brown_classes,
        op6_toxicity, op7_threshold_top_k, op8_line_runs, op9_token_files, op10_winnowing,
        op11_structure_repair, op12_fill_in_middle, op13_url_filter,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op3_jaccard_join": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
        ), reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) USING (doc_id)
    """,
    "op7_threshold_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
    """,
    "op8_line_runs": f"""
        WITH l AS (
            SELECT doc_id, pos, line, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
            FROM (SELECT doc_id, unnest(t) AS line, unnest(range(len(t))) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS t FROM documents))
        ), common AS (
            SELECT key, max(doc_id) AS top FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), marked AS (SELECT l.*, (top IS NOT NULL AND top <> doc_id) AS gone FROM l LEFT JOIN common USING (key))
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op10_winnowing": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        i AS (SELECT item_id, w, least(10, len(w)) AS m FROM (
            SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS p FROM i)),
        places AS (
            SELECT doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') AS g
            FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM i) WHERE len(w) >= m)
        ), hits AS (SELECT doc_id, p, places.m AS m, item_id FROM places JOIN windows ON places.m = windows.m AND places.g = windows.g),
        marked AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS x FROM hits) GROUP BY doc_id),
        listed AS (
            SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
    **MORE_ORACLES,
}
