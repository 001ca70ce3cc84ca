"""The registered queries of the pipeline operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradelens.llm.common import shared_path, table
from tradelens.llm.oracle import SQL


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.quality import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.neardup import components

    return components(table(spark, sf_dir, "documents"), size=3, percent=85).drop("key")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.license import scan

    return scan(table(spark, sf_dir, "documents"))


def op6_soft_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.mixing import soft_mixture

    # No upper bound: a domain with less than its share gets copies.
    return soft_mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), max_rate=None)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.warc import page_records, read_warc, write_warc

    folder = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return page_records(read_warc(spark, folder))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.language import identify

    return identify(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.pii import pii_spans

    return pii_spans(table(spark, sf_dir, "documents"))


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.suffixtree import suffix_tree_scores

    return suffix_tree_scores(table(spark, sf_dir, "documents"))


def op11_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.prefixtokens import token_counts

    return token_counts(table(spark, sf_dir, "documents"), limit=512)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.resampling import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradelens.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packing": op2_packing,
    "op3_nearest": op3_nearest,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_license_scan": op5_license_scan,
    "op6_soft_mixture": op6_soft_mixture,
    "op7_warc": op7_warc,
    "op8_language": op8_language,
    "op9_pii": op9_pii,
    "op10_suffix_tree": op10_suffix_tree,
    "op11_prefix_tokens": op11_prefix_tokens,
    "op12_resampling": op12_resampling,
    "op13_collocations": op13_collocations,
}

#: Models, tokenisers and searches are beyond SQL; tests compare those with
#: brute-force versions.
ORACLE_SQL: dict[str, str] = SQL
