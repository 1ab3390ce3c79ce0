"""Scans of the formats records come in. Every reader gives typed rows and tells where a row stood."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pyspark.sql.window import Window

from corpusmill.operators.aggregates import first_rows
from corpusmill.operators.normalize import first_paragraph, reaction_parts, strip_cx
from corpusmill.sources import wire


def template_base(record_id: Column) -> Column:
    """The text before the first underscore."""
    return F.substring_index(record_id, "_", 1)


def json_lines(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    """One JSON object a line; blank lines are skipped, unreadable ones dropped. Adds file and line_no,
    which counts every line of the file from 1. A limit takes the first rows by file and line.

    Lines are numbered by task: the tasks' line counts per file are added up, so files stay splittable.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    per = lines.groupBy("file", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    start = per.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    rows = lines.join(start, ["file", "_block"]).withColumn("line_no", F.col("_before") + F.col("_id") - F.col("_first") + 1).filter(F.trim("value") != "")
    out = rows.select(F.from_json("value", schema).alias("r"), "file", "line_no").filter("r is not null").select("r.*", "file", "line_no")
    return out if limit is None else first_rows(out, ["file", "line_no"], limit)


def json_array(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    """A file that is one JSON array; a limit takes its first elements. Such a file is one task's work."""
    out = spark.read.schema(schema).option("multiLine", True).json(path)
    if limit is None:
        return out
    numbered = out.withColumn("_id", F.monotonically_increasing_id())
    return first_rows(numbered, ["_id"], limit).drop("_id")


def reaction_tsv(spark: SparkSession, path: str, column: str, limit: int | None = None) -> DataFrame:
    """Tab-separated rows with a header; short rows and those without both sides are dropped, then
    a limit takes the first of what is kept, by file and place. Adds reactants, agents and products."""
    rows = spark.read.option("sep", "\t").option("header", True).option("mode", "DROPMALFORMED").option("quote", "").csv(path)
    kept = rows.withColumn("_p", reaction_parts(strip_cx(F.col(column)))).filter("_p is not null")
    if limit is not None:
        kept = first_rows(kept.withColumns({"_file": F.input_file_name(), "_id": F.monotonically_increasing_id()}), ["_file", "_id"], limit).drop("_file", "_id")
    return kept.select("*", "_p.*").drop("_p")


def elementary_csv(spark: SparkSession, path: str, aliases: dict[str, list[str]], keep: Column | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header whose columns go by several names: each field is the first non-empty of its
    candidates. Unreadable reactions are dropped. multi_line reads fields with line breaks, but then a
    file can't be split among tasks."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"{path} isn't there; this licensed source has to be put in place by hand")
    rows = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    have = {c.strip().lower(): c for c in rows.columns}

    def pick(names: list[str]) -> Column:
        found = [F.when(F.trim(F.col(f"`{have[n.lower()]}`")) != "", F.trim(F.col(f"`{have[n.lower()]}`"))) for n in names if n.lower() in have]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    out = rows.select(*(pick(names).alias(field) for field, names in aliases.items()))
    if keep is not None:
        out = out.filter(keep)
    return out.withColumn("_p", reaction_parts(F.col("reaction"))).filter("_p is not null").select("*", "_p.*").drop("_p")


#: The header names of elementary-step tables.
STEP_TABLE = {"reaction": ["Reaction SMIRKS", "Reaction SMILES", "smirks", "reaction"], "arrows": ["Arrow codes", "arrows"], "origin": ["Original source", "source"], "note": ["Auxiliary information", "note"]}


def polar_steps(spark: SparkSession, path: str) -> DataFrame:
    return elementary_csv(spark, path, STEP_TABLE).withColumn("family", F.lit("polar"))


def radical_steps(spark: SparkSession, path: str) -> DataFrame:
    return elementary_csv(spark, path, STEP_TABLE).withColumn("family", F.lit("radical"))


#: A deposited reaction as a struct, as from_protobuf gives it.
DEPOSIT = "identifier string, inputs array<struct<role:string,identifiers:array<struct<kind:string,value:string>>>>, outcomes array<struct<products:array<struct<identifiers:array<struct<kind:string,value:string>>>>>>, temperature double"


def deposits(spark: SparkSession, path: str, max_shards: int | None = None, descriptor: str | None = None, message: str | None = None) -> DataFrame:
    """Shards of Parquet in sorted order. A binary column data is decoded: by from_protobuf if a
    descriptor's file and message name are given (that needs Spark's protobuf package), else by the
    field numbers of deposited reactions; blobs that can't be decoded are dropped. Without it the
    columns of DEPOSIT are there already."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    shards = sorted(s.getPath().toString() for s in fs.listStatus(root) if s.isDirectory())[:max_shards] or [path]
    df = spark.read.option("recursiveFileLookup", True).parquet(*shards)
    if dict(df.dtypes).get("data") != "binary":
        return df
    if descriptor is not None:
        from pyspark.sql.protobuf.functions import from_protobuf

        return df.select(from_protobuf("data", message, descriptor, {"mode": "PERMISSIVE"}).alias("r")).filter("r is not null").select("r.*")

    schema = to_arrow_schema(T._parse_datatype_string(DEPOSIT))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pylist([r for r in map(wire.reaction, b.column(0).to_pylist()) if r is not None], schema=schema)

    return df.select("data").mapInArrow(run, DEPOSIT)


def deposit_records(df: DataFrame) -> DataFrame:
    """(identifier, reactants, reagents, products, conditions); rows without reactants or products
    are dropped."""
    first = lambda c: F.get(F.filter(c["identifiers"], lambda i: i["kind"] == "SMILES"), F.lit(0))["value"]
    named = lambda cs: F.filter(F.transform(cs, first), lambda x: x.isNotNull() & (x != ""))
    reactants = named(F.filter("inputs", lambda c: c["role"] == "REACTANT"))
    reagents = named(F.filter("inputs", lambda c: ~F.coalesce(c["role"] == "REACTANT", F.lit(False))))
    products = named(F.flatten(F.transform("outcomes", lambda o: o["products"])))
    out = df.select("identifier", reactants.alias("reactants"), reagents.alias("reagents"), products.alias("products"), "temperature").filter((F.size("reactants") > 0) & (F.size("products") > 0))
    parts = F.array_compact(F.array(F.when(F.col("temperature").isNotNull(), F.concat(F.lit("T="), F.col("temperature").cast("string"))), F.when(F.size("reagents") > 0, F.concat(F.lit("reagents:"), F.array_join(F.slice("reagents", 1, 6), ".")))))
    return out.select("identifier", "reactants", "reagents", "products", F.array_join(parts, "; ").alias("conditions"))


def summaries(pages: DataFrame, title: str, text: str, limit: int = 1200) -> DataFrame:
    """(title, summary) of pages that have one."""
    return pages.select(F.col(title).alias("title"), first_paragraph(F.col(text), limit).alias("summary")).filter("summary is not null and title is not null")


def last_predictions(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """Rows of an append-only JSON-lines file; malformed ones are skipped, the last of a key wins."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_n"))
    rows = lines.select(F.from_json("value", schema).alias("r"), "_f", "_b", "_n").filter("r is not null").select("r.*", "_f", "_b", "_n").filter(F.col(key).isNotNull())
    w = Window.partitionBy(key).orderBy(F.desc("_f"), F.desc("_b"), F.desc("_n"))
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_f", "_b", "_n")


def embedded_pairs(prompts: DataFrame, text: str, schema: str = "array<struct<type:string,subtype:string>>") -> DataFrame:
    """The pairs of the first [...] list in each text that parses and names subtypes."""
    lists = F.regexp_extract_all(text, F.lit(r"(?s)(\[\s*\{.*?\}\s*\])"), F.lit(1))
    parsed = F.filter(F.transform(F.filter(lists, lambda s: s.contains('"subtype"')), lambda s: F.from_json(s, schema)), lambda p: p.isNotNull())
    return prompts.select(F.explode(F.get(parsed, F.lit(0))).alias("p")).select("p.*").distinct()


def optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one of that schema where there is none."""
    wanted = T._parse_datatype_string(schema)
    return spark.read.schema(wanted).parquet(path) if _exists(spark, path) else spark.createDataFrame([], wanted)


def benchmark_split(spark: SparkSession, name: str, paths: dict[str, str], schema: str, limit: int | None = None) -> DataFrame:
    """A named split from .json or .jsonl; unknown names are an error."""
    if name not in paths:
        raise KeyError(f"no split {name}; there are {', '.join(sorted(paths))}")
    read = json_array if paths[name].endswith(".json") else json_lines
    return read(spark, paths[name], schema, limit)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
