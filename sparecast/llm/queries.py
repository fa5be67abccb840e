"""One registered query per operator, each over its whole table, and their SQL where SQL can state the result."""

from __future__ import annotations

import importlib
import pathlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparecast.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def importable(spark: SparkSession) -> None:
    """Let Python workers of a session that runs from a checkout import the package."""
    root = str(pathlib.Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def tokenizer_file() -> str:
    """The vocabulary of the registered queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sparecast.llm.secret_scan import scan

    importable(spark)
    return scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.token_files import token_report

    importable(spark)
    return token_report(table(spark, sf_dir, "documents"), tokenizer_file())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.toxicity import toxicity_report

    importable(spark)
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.quality import quality_report

    importable(spark)
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.html_text import extract

    importable(spark)
    return extract(table(spark, sf_dir, "pages"))


def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.shards import shard_documents

    importable(spark)
    return shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.exact_dedup import exact_duplicates

    importable(spark)
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.bpe import encode_documents

    importable(spark)
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.near_dedup import near_duplicates

    importable(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=85)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.decontaminate import contamination

    importable(spark)
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.vector_codes import vector_codes

    importable(spark)
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.spelling import spelling_variants

    importable(spark)
    return spelling_variants(table(spark, sf_dir, "documents"), damage_every=199)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparecast.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


QUERIES = (op1_secret_scan, op2_token_files, op3_toxicity, op4_quality_classifier, op5_html_main_text, op6_minimax_shards,
           op7_exact_dedup, op8_bpe_round_trip, op9_minhash_near_dedup, op10_decontamination, op11_vector_codes,
           op12_spelling_variants, op13_quality_rules)

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Exact dedup as plain grouping by the normalised text.
OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Decontamination as a join of all windows, written out as text.
OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
s AS (SELECT item, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item, size, array_to_string(w[p:p + size - 1], ' ') AS t
       FROM (SELECT item, w, size, unnest(generate_series(1, len(w) - size + 1)) AS p FROM s)),
dw AS (SELECT r, size, p, array_to_string(w[p:p + size - 1], ' ') AS t
       FROM (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS p
             FROM d CROSS JOIN (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)),
hits AS (SELECT DISTINCT dw.r, dw.p, dw.size, iw.item FROM dw JOIN iw ON dw.size = iw.size AND dw.t = iw.t),
n AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + size - 1)) AS q FROM hits) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN i ON d.r = i.r
"""


def check_imports() -> None:
    """Raise ImportError where a module of an operator, or a package that it needs, is missing."""
    for name in ("bpe", "decontaminate", "exact_dedup", "html_text", "near_dedup", "quality", "quality_rules", "secret_scan", "shards", "spelling",
                 "token_files", "toxicity", "vector_codes"):
        importlib.import_module(f"sparecast.llm.{name}")


def llm_queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def llm_sql() -> dict[str, str]:
    from sparecast.llm.quality_rules import rules_sql
    from sparecast.llm.vector_codes import codes_sql

    return {"op7_exact_dedup": OP7_SQL, "op10_decontamination": OP10_SQL, "op11_vector_codes": codes_sql(),
            "op13_quality_rules": rules_sql()}
