"""Queries of the whole plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.plans import evaluation, pipeline, training_data
from corpusmill.queries import query
from corpusmill.queries.common import full_rows, records
from corpusmill.session import table


def _records(spark, d):
    return pipeline.records_of(records(spark, d), table(spark, d, "sft_mechanisms"))


@query()
def curation_pipeline(spark, d):
    """All phases over train records with the validation and test records as held-out corpora; the
    clean ones come out."""
    r = _records(spark, d)
    allowed = table(spark, d, "templates").select(F.lit("step").alias("type"), F.explode("subtypes").alias("subtype")).distinct()
    moves = spark.createDataFrame([("step", "dissociation", "step", "heterolytic_cleavage"), ("step", "coordination", None, None)], "from_type string, from_subtype string, to_type string, to_subtype string")
    clean, _, split, _ = pipeline.curate(r.filter("split = 'train'").drop("split"), [r.filter(f"split = '{s}'").drop("split") for s in ("validation", "test")], allowed, moves)
    return clean.select("record_id", "source", "provenance", F.size("steps").alias("n_steps")).join(split.select("record_id", "split"), "record_id")


@query()
def training_rows(spark, d):
    """Train rows with a redrawn copy each, decontaminated against the held-out splits."""
    r = _records(spark, d)
    train, _ = training_data.build(r.filter("split = 'train'"), r.filter("split in ('validation', 'test')"), "record_id", 0.03, 1)
    return train.select("record_id", "variant", "level", "prompt", F.size("reference").alias("n_steps"))


@query()
def evaluation_run(spark, d):
    """Recorded answers replayed and scored per level."""
    rows = full_rows(spark, d)
    gold = rows.select("row_id", "reference", "meta.level")
    said = evaluation.replay(rows.select("row_id", F.element_at("messages", -1)["content"].alias("t")), "row_id", "t")
    return evaluation.evaluate(gold, said, "row_id", "reference", "level")[2]
