"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import decontaminate
from .html_extract import html_extract
from .importance_resampling import IMPORTANCE_RESAMPLING_SQL, importance_resampling
from .language_id import language_id
from .license_scan import license_scan
from .line_dedup import LINE_DEDUP_SQL, line_dedup
from .near_join import near_join
from .oracles import DECONTAMINATE_SQL, NEAR_JOIN_SQL, QUALITY_RULES_SQL
from .quality_classifier import quality_classifier
from .quality_rules import quality_rules
from .rolling_median import ROLLING_MEDIAN_SQL, rolling_median
from .sentencepieces import encode
from .token_counts import token_counts
from .token_output import token_output


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def leak_digest(rows: DataFrame) -> DataFrame:
    """Decontaminated rows with the number and least of their items in place of the list."""
    return rows.select("doc_id", "contaminated", "kept", F.size("item_ids").cast("long").alias("n_items"), F.array_min("item_ids").alias("first_item"), F.round("cover", 6).alias("cover"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": lambda s, d: html_extract(table(s, d, "pages")),
    "op2_line_dedup": lambda s, d: line_dedup(table(s, d, "documents")),
    "op3_quality_classifier": lambda s, d: quality_classifier(table(s, d, "documents"), table(s, d, "labels")),
    "op4_language_id": lambda s, d: language_id(table(s, d, "documents")),
    "op5_quality_rules": lambda s, d: quality_rules(table(s, d, "documents")).withColumn("host_rate", F.round("host_rate", 6)),
    "op6_ngram_jaccard_join": lambda s, d: near_join(table(s, d, "documents")),
    "op7_sentencepiece": lambda s, d: encode(table(s, d, "documents"), tokenizer_file("piece_bpe_32k.model")),
    "op8_token_counts": lambda s, d: token_counts(table(s, d, "documents"), tokenizer_file("byte_bpe_50k.json")),
    "op9_license_scan": lambda s, d: license_scan(table(s, d, "documents")),
    "op10_benchmark_decontamination": lambda s, d: leak_digest(decontaminate(table(s, d, "documents"), table(s, d, "benchmark"))),
    "op11_importance_resampling": lambda s, d: importance_resampling(table(s, d, "documents"), table(s, d, "benchmark")),
    "op12_token_output": lambda s, d: token_output(table(s, d, "documents"), tokenizer_file("byte_bpe_50k.json")),
    "op13_rolling_median": lambda s, d: rolling_median(table(s, d, "clicks")),
}

SQL: dict[str, str] = {"op2_line_dedup": LINE_DEDUP_SQL, "op5_quality_rules": QUALITY_RULES_SQL, "op6_ngram_jaccard_join": NEAR_JOIN_SQL, "op10_benchmark_decontamination": DECONTAMINATE_SQL, "op11_importance_resampling": IMPORTANCE_RESAMPLING_SQL, "op13_rolling_median": ROLLING_MEDIAN_SQL}
