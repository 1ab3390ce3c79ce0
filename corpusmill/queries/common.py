"""Views of the driver's tables that several queries share, in DataFrame and SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import table


def records(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mechanism_records")


def full_rows(spark: SparkSession, d: str) -> DataFrame:
    """Chat rows that carry a reference, which serves as the record's steps."""
    return table(spark, d, "sft_mechanisms").filter("task = 'mechanism_full'").select("row_id", "record_no", "reference", "messages", "meta")


def steps(spark: SparkSession, d: str) -> DataFrame:
    return full_rows(spark, d).select("row_id", F.posexplode("reference").alias("pos", "s")).select("row_id", "pos", "s.subtype", "s.smiles", "s.weight")


def molecules(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("record_no", "source", F.posexplode("reactants_smiles").alias("pos", "molecule"))


FULL = "full_rows as (select row_id, record_no, reference, messages, meta from sft_mechanisms where task = 'mechanism_full')"
STEPS = FULL + ", steps as (select row_id, (u.i - 1)::int as pos, reference[u.i].subtype as subtype, reference[u.i].smiles as smiles, reference[u.i].weight as weight from full_rows, unnest(generate_series(1, len(reference))) as u(i))"
MOLECULES = "molecules as (select record_no, source, (u.i - 1)::int as pos, reactants_smiles[u.i] as molecule from mechanism_records, unnest(generate_series(1, len(reactants_smiles))) as u(i))"
#: Collapsed text: trimmed lower case with single spaces.
COLLAPSED = r"trim(regexp_replace(lower({0}), '\s+', ' ', 'g'))"
