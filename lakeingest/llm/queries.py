"""The registered queries of this subpackage, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.registry import table
from ..session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


@query("op5_ngram_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_jaccard_classes
    return ngram_jaccard_classes(table(spark, sf_dir, "documents"), k=5, similarity=75)


@query("op9_suffix_array_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import repeated_passages
    return repeated_passages(table(spark, sf_dir, "documents"), min_words=50)


def tokenizer_path() -> str:
    """The vocabulary file of the token query: a parameter of the operator, never copied into the repository."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op8_bpe_encode_decode")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_texts
    return encode_texts(table(spark, sf_dir, "documents"), tokenizer_path(), digests_only=True)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .samples import remainder
    from .toxicity import score_toxicity, train_toxicity
    documents = table(spark, sf_dir, "documents")
    weights, bias = train_toxicity(documents, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return score_toxicity(documents, weights, bias).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .rule_ensemble import score_quality, train_quality
    from .samples import remainder
    documents = table(spark, sf_dir, "documents")
    ensemble = train_quality(documents, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    return score_quality(documents, ensemble).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _op2_sql() -> str:
    from .quality_rules import ORACLE
    return ORACLE


@query("op2_quality_rules", _op2_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_verdicts
    return quality_verdicts(table(spark, sf_dir, "documents"))


def _op10_sql() -> str:
    from .pfair_mix import ORACLE
    return ORACLE


@query("op10_pfair_mix", _op10_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pfair_mix import scheduled
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    return scheduled(rows).select("doc_id", "source", "mix.*")


@query("op1_hash_prefix_forest")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .hash_forest import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op6_html_extraction")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract_pages
    return extract_pages(table(spark, sf_dir, "pages"))


def _op7_sql() -> str:
    from .warc_revisit import ORACLE
    return ORACLE


@query("op7_warc_revisits", _op7_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .warc_revisit import captures_of, resolve_revisits
    rows = resolve_revisits(captures_of(table(spark, sf_dir, "pages")))
    return rows.select("record_id", "url_key", "captured_at", "outcome", "resolved_id", "resolved_at",
                       F.col("headers")["content-type"].alias("content_type"), F.col("headers")["date"].alias("date_header"),
                       F.col("headers")["cache-control"].alias("cache_control"),
                       F.length("body").cast("long").alias("body_chars"), F.md5(F.col("body").cast("binary")).alias("body_md5"))


def _op11_sql() -> str:
    from .hard_negatives import ORACLE
    return ORACLE


@query("op11_hard_negatives", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .hard_negatives import hard_negatives
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("id") % 50 == 0)


def _op12_sql() -> str:
    from .ranked_search import ORACLE
    return ORACLE


@query("op12_ranked_search", _op12_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ranked_search import ranked_search
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def _op13_sql() -> str:
    from .exact_dedup import ORACLE
    return ORACLE


@query("op13_exact_dedup", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf_dir, "documents"), carry=["doc_id"])
