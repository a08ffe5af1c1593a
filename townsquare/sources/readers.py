"""Scans: single files, raw folders, fallbacks, bounded samples and stored runs."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from townsquare.runtime import freeze
from townsquare.sources import runs


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    multi_line: bool = False,
    balanced_quotes: bool = True,
) -> DataFrame:
    """A1: CSV with a header; types come from ``schema`` or, for ad-hoc reads, are inferred.

    With a schema the columns are matched to the header by name, so a file may hold them in
    any order and may lack some (those become null). Large files are split into many tasks, also where quoted fields
    span lines (``multi_line=True``, see ``quoted_records``). A file that holds lone quotes inside unquoted fields
    needs ``balanced_quotes=False`` then, and is read whole, at a task per file.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    split = multi_line and balanced_quotes
    if schema is None and not split:
        return reader.option("inferSchema", True).csv(path)
    as_text = _from_records(spark, path, reader.csv(path).columns) if split else reader.csv(path)
    if schema is None:
        return as_text.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in _inferred(as_text)))
    present = {name.strip(): name for name in as_text.columns}
    return as_text.select(
        *(
            (
                F.col(f"`{present[field.name]}`").try_cast(field.dataType)
                if field.name in present
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in schema.fields
        )
    )


def _inferred(as_text: DataFrame) -> list[T.StructField]:
    """The narrowest of integer, long, double, date, timestamp, boolean and string that all values of a column fit, in one pass."""
    kinds = ("int", "bigint", "double", "date", "timestamp", "boolean")
    checks = [
        F.bool_and(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").try_cast(kind).isNotNull()).alias(f"{i}_{kind}")
        for i, c in enumerate(as_text.columns)
        for kind in kinds
    ]
    known = [F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(as_text.columns)]
    row = as_text.agg(*checks, *known).first()
    found = []
    for i, c in enumerate(as_text.columns):
        fitting = [kind for kind in kinds if row[f"{i}_n"] and row[f"{i}_{kind}"]]
        found.append(T.StructField(c, T._parse_datatype_string(fitting[0]) if fitting else T.StringType()))
    return found


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (file, first, record): the records of CSV files whose quoted fields may span lines, read in splits.

    A line begins a record if an even number of quotes stands before it in its file (a quote inside a field
    is doubled). Each split counts its own quotes, the counts of earlier splits (a row per split) are added, and a line then
    knows by itself whether it begins a record. Records within a split are put together there; only those that cross into
    another split are shuffled again. Lines end with a line feed, before which a carriage return may stand.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"), F.col("value"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    in_file = Window.partitionBy("file").orderBy("split")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = freeze(lines.groupBy("file", "split").agg(F.sum("quotes").alias("own")).select(
        "file", "split", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"), "own",
    ))
    here = Window.partitionBy("file", "split").orderBy("line")
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = F.coalesce(F.sum("quotes").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # A row per split is added to every line: bounded by the files' bytes over the split size.
    placed = lines.join(F.broadcast(splits), ["file", "split"]).withColumn("begins", (F.col("before") + within) % 2 == 0)
    owned = placed.withColumn("owner", F.max(F.when(F.col("begins"), F.col("line"))).over(upto))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n")
    # Lines are where their split is, so this needs no shuffle.
    pieces = freeze(
        owned.groupBy("file", "split", "owner").agg(joined.alias("record"), F.max("line").alias("last"), F.first((F.col("before") + F.col("own")) % 2).alias("open"))
    )
    ends = pieces.groupBy("file", "split").agg(F.max("owner").alias("last_owner"), F.max("last").alias("last_line"))
    # The record that runs on into a split without an owner there began in the last split that has one.
    carried = F.last(F.when(F.col("last_owner").isNotNull(), F.struct("split", "last_owner")), ignorenulls=True).over(earlier)
    ends = F.broadcast(ends.select("file", "split", "last_owner", "last_line", carried.alias("carried")))
    known = pieces.join(ends, ["file", "split"]).withColumns({
        "crosses": F.col("owner").isNull() | ((F.col("open") == 1) & (F.col("last") == F.col("last_line"))),
        "from_split": F.when(F.col("owner").isNull(), F.col("carried.split")).otherwise(F.col("split")),
        "from_line": F.coalesce("owner", "carried.last_owner"),
    })
    whole = known.where("not crosses").select("file", "from_split", "from_line", "record")
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "record"))), lambda x: x["record"]), "\n")
    crossing = known.where("crosses").groupBy("file", "from_split", "from_line").agg(parts.alias("record"))
    records = whole.unionByName(crossing)
    # A row per file.
    heads = F.broadcast(records.groupBy("file").agg(F.min(F.struct("from_split", "from_line")).alias("head")))
    return records.join(heads, "file").select(
        "file", (F.struct("from_split", "from_line") == F.col("head")).alias("first"), F.regexp_replace("record", "\r$", "").alias("record")
    )


def _from_records(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))])
    rows = quoted_records(spark, path).where("not first and trim(record) != ''")
    parsed = rows.select(F.from_csv("record", fields.simpleString()[len("struct<") : -1].replace(":", " "), {"escape": '"', "maxCharsPerColumn": "-1"}).alias("row"))
    return parsed.select(*(F.col(f"row.c{i}").alias(name) for i, name in enumerate(columns)))


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """A2: Parquet scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_any(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Scan by suffix: ``.csv`` or ``.parquet``."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, schema, multi_line)
    if path.rstrip("/").endswith(".parquet"):
        return read_parquet(spark, path, schema)
    raise ValueError(f"neither .csv nor .parquet: {path}")


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names directly under a folder, by one listing of the Hadoop file system; [] if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(path))


def raw_dataset_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the datasets in a raw folder: each top-level ``.csv``/``.parquet`` file or folder.

    One level is listed, however many files the datasets hold; hidden names are skipped.
    """
    names = _listed(spark, folder.rstrip("/"))
    return [name for name in names if re.search(r"\.(csv|parquet)$", name) and not name.startswith((".", "_"))]


def read_raw_folder(
    spark: SparkSession,
    folder: str,
    schemas: Mapping[str, T.StructType] | None = None,
    multi_line: bool = False,
) -> dict[str, DataFrame]:
    """A3: one lazy DataFrame per dataset of a raw folder; ``schemas`` go by dataset name."""
    root = folder.rstrip("/")
    return {
        name: read_any(spark, f"{root}/{name}", (schemas or {}).get(name), multi_line)
        for name in raw_dataset_names(spark, root)
    }


def first_available(
    spark: SparkSession, paths: Iterable[str], schema: T.StructType | None = None, multi_line: bool = False
) -> tuple[DataFrame, str] | None:
    """A4: the first candidate location that can be scanned, with its path; ``None`` if none can."""
    for path in paths:
        try:
            return read_any(spark, path, schema, multi_line), path
        except (AnalysisException, ValueError):
            continue
    return None


def seeded_sample(df: DataFrame, n: int = 30_000, seed: int = 42, key: str | None = None) -> DataFrame:
    """A5: exactly min(n, rows) rows without replacement, repeatable under any partitioning.

    Rows are ranked by the MD5 of the seed and a ``key`` column, or of the seed and the whole row
    where none is named. A hash cut keeps a little more than
    ``n`` rows before the ordered limit, so the final sort sees about ``n`` rows in all and
    not ``n`` per input task; the cut is widened in the rare case that it keeps too few.
    """
    total = df.count()
    if total <= n:
        return df
    columns = [F.col(f"`{c}`") for c in df.columns]
    content = F.col(key).cast("string") if key else F.to_json(F.struct(*columns))
    hashed = df.withColumn("__hash", F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(content, F.lit("")))))
    share = min(1.0, (n + 8 * math.sqrt(n) + 8) / total)
    while True:
        bound = min(int(share * 16**8), 16**8 - 1)
        kept = hashed.filter(F.substring("__hash", 1, 8) <= F.lit(f"{bound:08x}"))
        if share >= 1.0:
            break
        kept = freeze(kept)
        if kept.count() >= n:
            break
        share = min(1.0, share * 2)
    return kept.orderBy("__hash", *columns).limit(n).drop("__hash")


def with_source(df: DataFrame, source: str) -> DataFrame:
    """Provenance tag; replaces any tag the rows already carry."""
    return df.withColumn("data_source", F.lit(source))


def list_runs(spark: SparkSession, base: str) -> list[str]:
    """A10: ids of the committed runs that hold a final dataset, newest first."""
    return [entry["run_id"] for entry in runs.committed(spark, base) if entry["posts"]]


def load_run(spark: SparkSession, base: str, run_id: str) -> DataFrame:
    """A10: the final dataset of one committed run; only that run's partition is listed and read."""
    entry = runs.record(spark, base, run_id)
    if entry is None or not entry["posts"]:
        raise runs.NotCommitted(f"no committed dataset of run {run_id} under {base}")
    root = f"{base.rstrip('/')}/posts"
    return spark.read.option("basePath", root).parquet(f"{root}/run_id={run_id}").drop("run_id")


def load_report(spark: SparkSession, base: str, section: str, run_id: str) -> DataFrame:
    """A10: one report section of one committed run."""
    entry = runs.record(spark, base, run_id)
    if entry is None or section not in entry["sections"]:
        raise runs.NotCommitted(f"no committed section {section} of run {run_id} under {base}")
    return spark.read.json(f"{base.rstrip('/')}/reports/{section}/run_id={run_id}")


def load_states(spark: SparkSession, base: str, name: str, run_ids: Iterable[str] | None = None) -> DataFrame:
    """A10: one state of several committed runs (all that have it, if none are named), with a column ``run_id``.

    Only the states are listed and read, never the posts. Columns that some runs lack are null there.
    """
    found = {entry["run_id"] for entry in runs.committed(spark, base) if name in entry.get("states", ())}
    wanted = sorted(found if run_ids is None else set(run_ids))
    if not wanted or not found.issuperset(wanted):
        raise runs.NotCommitted(f"no committed state {name} of {sorted(set(wanted) - found) or 'any run'} under {base}")
    root = f"{base.rstrip('/')}/states/{name}"
    reader = spark.read.option("basePath", root).option("mergeSchema", True)
    return reader.parquet(*(f"{root}/run_id={run_id}" for run_id in wanted)).withColumn("run_id", F.col("run_id").cast("string"))
