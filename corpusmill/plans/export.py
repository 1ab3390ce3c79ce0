"""Sinks: tables per phase, JSON lines, rejects, text corpus, manifests, cards, multi-config export."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_phase(df: DataFrame, path: str) -> None:
    """One Parquet table per phase; nested columns stay nested."""
    df.write.mode("overwrite").parquet(path)


def encoded(df: DataFrame) -> DataFrame:
    """The interchange form: every nested column as JSON text, nulls kept in objects."""
    nested = {f.name for f in df.schema if f.dataType.typeName() in ("array", "struct", "map")}
    return df.select(*(F.to_json(c, {"ignoreNullFields": "false"}).alias(c) if c in nested else F.col(c) for c in df.columns))


def decoded(df: DataFrame, schemas: dict[str, str]) -> DataFrame:
    """Back from the interchange form; unreadable text becomes null."""
    return df.select(*(F.from_json(c, schemas[c]).alias(c) if c in schemas else F.col(c) for c in df.columns))


def write_jsonl(df: DataFrame, path: str, ascii_only: bool = False) -> None:
    """JSON lines, nulls kept; text as it is, or with other than ASCII characters escaped."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").option("writeNonAsciiCharacterAsCodePoint", str(ascii_only).lower()).json(path)


def write_rejects(rejects: DataFrame, path: str) -> None:
    rejects.write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A small report as JSON lines in one file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_corpus(lines: DataFrame, path: str) -> None:
    """One text column, sorted parts in order."""
    lines.write.mode("overwrite").text(path)


def append_new(new: DataFrame, path: str, key: str) -> None:
    """Appends rows whose key isn't there yet, so a run can be taken up again."""
    spark = new.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        new = new.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
    new.write.mode("append").parquet(path)


def write_manifest(split: DataFrame, key: str, path: str) -> None:
    """The ids of each split in its own folder."""
    split.select(key, "split").write.mode("overwrite").partitionBy("split").json(path)


def routed(rows: DataFrame, config: str, split: str) -> DataFrame:
    """Adds config and config_split for the export's folders; null splits are train."""
    return rows.withColumn("config", F.coalesce(F.col(config), F.lit("default"))).withColumn("config_split", F.coalesce(F.col(split), F.lit("train")))


def export_configs(rows: DataFrame, config: str, split: str, path: str) -> None:
    """A folder per config and split, meta as columns, other nested columns as JSON text."""
    flat = rows.select(*(c for c in rows.columns if c != "meta"), *([F.col(f"meta.{f}").alias(f"meta_{f}") for f in rows.schema["meta"].dataType.names] if "meta" in rows.columns else []))
    encoded(routed(flat, config, split)).write.mode("overwrite").partitionBy("config", "config_split").parquet(path)


def distributions(records: DataFrame, cols: list[str]) -> DataFrame:
    """(what, value, n) for each column: the card's tables in one pass."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("what"), F.coalesce(F.col(c).cast("string"), F.lit("none")).alias("value")) for c in cols))).alias("x")
    return records.select(each).groupBy("x.what", "x.value").agg(F.count("*").alias("n"))


#: A card's tables show so many values each; the JSON has them all.
SHOWN = 50


def card(counts: dict, gates: dict[str, dict], title: str = "Data card", tables: DataFrame | None = None, licenses: dict[str, str] | None = None, gaps: list[str] | None = None) -> tuple[str, str]:
    """(JSON, Markdown) of counts, gate results, distribution tables (what, value, n), licence
    verdicts and known gaps. The tables hold categories, so few rows come to the driver."""
    rows = [] if tables is None else [r.asDict() for r in tables.orderBy("what", F.desc("n"), "value").collect()]
    data = {"counts": counts, "gates": gates, "tables": rows, "licenses": licenses or {}, "gaps": gaps or []}
    lines = [f"# {title}", "", "| what | number |", "|-|-|", *(f"| {k} | {v} |" for k, v in counts.items()), ""]
    for what in dict.fromkeys(r["what"] for r in rows):
        lines += [f"## By {what}", "", f"| {what} | n |", "|-|-:|", *(f"| {r['value']} | {r['n']} |" for r in [r for r in rows if r["what"] == what][:SHOWN]), ""]
    if licenses:
        lines += ["## Licences", "", "| source | verdict |", "|-|-|", *(f"| {k} | {v} |" for k, v in licenses.items()), ""]
    for phase, result in gates.items():
        lines += [f"## {phase}", "", *(f"- {k}: {v}" for k, v in result.items()), ""]
    if gaps:
        lines += ["## Known gaps", "", *(f"- {g}" for g in gaps), ""]
    return json.dumps(data, ensure_ascii=False, indent=2, default=str), "\n".join(lines)


def write_card(folder: str, counts: dict, gates: dict[str, dict], **more) -> None:
    as_json, as_text = card(counts, gates, **more)
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / "data_card.json").write_text(as_json)
    (Path(folder) / "DATA_CARD.md").write_text(as_text)


def export_counts(rows: DataFrame, config: str, split: str) -> dict[str, dict[str, int]]:
    """Rows per config and split."""
    out: dict[str, dict[str, int]] = {}
    for r in routed(rows, config, split).groupBy("config", "config_split").agg(F.count("*").alias("n")).orderBy("config", "config_split").collect():
        out.setdefault(r["config"], {})[r["config_split"]] = r["n"]
    return out


def export_card(counts: dict[str, dict[str, int]], license_tag: str, title: str, body: str = "", decontamination: dict | None = None, check: dict | None = None, tags: tuple[str, ...] = ()) -> str:
    """A data set's page: front matter with a data_files entry per config and split, how to load it,
    its configurations, the data card's text, and what decontamination and format check gave."""
    front = ["---", f"license: {license_tag}", *(["tags:", *(f"- {t}" for t in tags)] if tags else []), "configs:"]
    for name, splits in counts.items():
        front += [f"- config_name: {name}", "  data_files:", *(line for s in splits for line in (f"  - split: {s}", f"    path: config={name}/config_split={s}/*"))]
    lines = [*front, "---", "", f"# {title}", "", "## Loading", "", "Read the Parquet files of a configuration; nested columns are JSON text.", "", "## Configurations", ""]
    lines += [f"- {name}: " + ", ".join(f"{s} {n}" for s, n in splits.items()) for name, splits in counts.items()] + [""]
    lines += [line for line in body.splitlines() if not line.startswith("# ")]
    for head, facts in (("Decontamination", decontamination), ("Format check", check)):
        if facts:
            lines += [f"## {head}", "", *(f"- {k}: {v}" for k, v in facts.items()), ""]
    return "\n".join(lines) + "\n"


def dry_run(rows: DataFrame, config: str, split: str, folder: str, license_tag: str, title: str, **more) -> str:
    """Writes the export and its page to a folder, publishes nothing, and gives the page's text. A key
    found in several splits of a config is an error."""
    if "reaction_id" in rows.columns:
        leaks = routed(rows, config, split).filter("reaction_id is not null").groupBy("config", "reaction_id").agg(F.countDistinct("config_split").alias("k")).filter("k > 1")
        if leaks.limit(1).count():
            raise ValueError("some reaction_id stands in several splits")
    text = export_card(export_counts(rows, config, split), license_tag, title, **more)
    export_configs(rows, config, split, folder)
    spark = rows.sparkSession
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/_card")
    return text


def gate(name: str, metrics: DataFrame) -> dict:
    """The one row of a metrics frame as a gate report, printed for the console."""
    row = metrics.first()
    result = row.asDict(recursive=True) if row else {}
    print(f"[{name}] " + ", ".join(f"{k}={v}" for k, v in result.items()))
    return result
