"""Generate, score and report: the evaluation harness as one plan per stage."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import aggregates as A
from corpusmill.operators import scoring as C

#: A model: prompts to raw outputs, called once per batch on the executors.
Generator = Callable[[list[str]], list[str]]


def generate(todo: DataFrame, done: DataFrame | None, key: str, prompt: str, model: Generator, retry_errors: bool = False) -> DataFrame:
    """(key, raw_output, error) for prompts that aren't done. A failure is a row and counts as done,
    unless errors are retried."""
    if done is not None:
        todo = A.not_done(todo, done, key, F.col("error").isNotNull() if retry_errors else None)
    ddl = dict(todo.dtypes)[key]

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            try:
                out, err = model(texts), [None] * len(texts)
            except Exception:  # one by one, so that only the failing prompts fail
                out, err = [], []
                for t in texts:
                    try:
                        out.append(model([t])[0])
                        err.append(None)
                    except Exception as e:
                        out.append(None)
                        err.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(err, pa.string())], names=[key, "raw_output", "error"])

    return todo.select(key, prompt).mapInArrow(run, f"`{key}` {ddl}, raw_output string, error string")


def replay(predictions: DataFrame, key: str, raw: str) -> DataFrame:
    """Outputs recorded earlier in place of a model's."""
    return predictions.select(key, F.col(raw).alias("raw_output"), F.lit(None).cast("string").alias("error"))


def evaluate(gold: DataFrame, predictions: DataFrame, key: str, reference: str, level: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scores per row, summary, per level); a gold row without prediction scores 0."""
    rows = C.against_gold(gold, predictions, key)
    scores = C.scored(rows, key, reference, "raw_output").join(gold.select(key, level), key)
    return scores, C.summary(scores), C.by_level(scores, level)


def board(summaries: dict[str, DataFrame], static: DataFrame | None = None) -> DataFrame:
    """The leaderboard of measured and static results."""
    frames = [s.withColumn("model", F.lit(m)) for m, s in summaries.items()]
    return C.leaderboard(*frames, *([static] if static is not None else []))
