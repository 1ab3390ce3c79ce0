"""The driver's queries of this subpackage; their SQL is in corpusmill.llm.sql."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import grouped_split, mixing, packing, quota_sample
from corpusmill.llm.overlap import Overlaps
from corpusmill.llm.tokens import with_tokens
from corpusmill.llm.truncation import Truncation
from corpusmill.session import staged, table

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}
#: The tokenizer's vocabulary file for these queries, unless the session names another.
VOCABULARY = ("corpusmill.vocabulary", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def _overlaps(spark: SparkSession, d: str) -> Overlaps:
    return Overlaps(table(spark, d, "mechanism_records"), table(spark, d, "sft_mechanisms"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).record_pairs().select("record_no_a", "record_no_b")


def p1_coverage(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).coverage()


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).linked_classes()


def p1_members(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).members


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).report()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    t = lambda name: table(spark, d, name)
    return grouped_split.group_keys(t("sft_mechanisms"), t("mechanism_records"), t("templates"), t("template_aliases"))


def p2_split(spark: SparkSession, d: str) -> DataFrame:
    return grouped_split.split_rows(staged(p2_found(spark, d), "group-keys"), SHARES)


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return grouped_split.report(p2_found(spark, d), SHARES)


def _sampler(spark: SparkSession, d: str) -> quota_sample.Sampler:
    return quota_sample.Sampler(table(spark, d, "mechanism_records"), table(spark, d, "sample_targets"), "record_no")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _sampler(spark, d).unmet()


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sampler(spark, d).sample()


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return _sampler(spark, d).report()


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return staged(with_tokens(table(spark, d, "documents"), ["doc_id", "lang", "source"], spark.conf.get(*VOCABULARY)), "sized")


def p5_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_sized(spark, d), table(spark, d, "pack_specs"), "doc_id")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(p5_containers(spark, d), table(spark, d, "pack_specs"))


def p6_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_sized(spark, d), table(spark, d, "mix_targets"), "doc_id")


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.report(_sized(spark, d), table(spark, d, "mix_targets"), "doc_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return Truncation(table(spark, d, "documents")).found()


def p7_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return Truncation(table(spark, d, "documents")).judged()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return Truncation(table(spark, d, "documents")).report()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_coverage, p1_classes, p1_members, p1_report, p2_found, p2_split, p2_report, p4_found, p4_sample, p4_report, p5_containers, p5_report, p6_mix, p6_report, p7_found, p7_verdicts, p7_report)}
