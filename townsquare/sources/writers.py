"""Sinks: CSV, Parquet, JSON reports and versioned run folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from townsquare.runtime import freeze
from townsquare.sources import readers, runs


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header, quoted so that A1 reads it back."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    # White space at the ends of a text is part of it.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> str:
    """Parquet."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return path


def write_report(report: DataFrame, path: str) -> str | None:
    """One JSON report section; an empty section writes nothing.

    The section is computed once, into an intermediate table that is then looked at and converted.
    """
    report = freeze(report)
    if report.isEmpty():
        return None
    report.write.mode("overwrite").json(path)
    return path


def save_run(
    base: str,
    run_id: str,
    posts: DataFrame | None,
    reports: Mapping[str, DataFrame | None],
    compression: str = "snappy",
    states: Mapping[str, DataFrame] | None = None,
) -> list[str]:
    """Write the final dataset, the report sections and the mergeable states of one run.

    Posts go to ``posts/run_id=…``, reports to ``reports/<section>/run_id=…`` and states to ``states/<name>/run_id=…`` so that runs
    can be listed and pruned as partitions. A commit record is written last and readers go by it, so a failure on
    the way leaves no run behind; the same id saved again is no run until it is whole again. Returns the paths written.
    """
    root = base.rstrip("/")
    spark = SparkSession.active()
    runs.withdraw(spark, base, run_id)
    written: list[str] = []
    if posts is not None:
        written.append(write_parquet(posts, f"{root}/posts/run_id={run_id}", compression))
    sections = {
        section: write_report(report, f"{root}/reports/{section}/run_id={run_id}")
        for section, report in reports.items()
        if report is not None
    }
    sections = {section: path for section, path in sections.items() if path}
    kept = {
        name: write_parquet(state, f"{root}/states/{name}/run_id={run_id}", compression)
        for name, state in (states or {}).items()
    }
    runs.commit(spark, base, run_id, posts is not None, list(sections), list(kept))
    return [*written, *sections.values(), *kept.values()]


def ingest(
    spark,
    candidates: Mapping[str, list[str]],
    out_folder: str,
    sampled: tuple[str, ...] = (),
    n: int = 30_000,
    seed: int = 42,
    enabled: bool = True,
    schemas: Mapping[str, T.StructType] | None = None,
    multi_line: bool = False,
) -> dict[str, str]:
    """A4-A7 in one step: pick each source's first usable location and return its path.

    All rows are kept unless asked otherwise: a source named in ``sampled`` is cut to a bounded sample (``n=None`` keeps all rows), tagged
    and written next to the others as CSV; the rest are used where they lie.
    """
    if not enabled:
        return {}
    paths = {}
    for source, locations in candidates.items():
        found = readers.first_available(spark, locations, (schemas or {}).get(source), multi_line)
        if found is None:
            continue
        df, path = found
        if source in sampled:
            rows = df if n is None else readers.seeded_sample(df, n, seed)
            path = write_csv(readers.with_source(rows, source), f"{out_folder.rstrip('/')}/{source}_sampled.csv")
        paths[source] = path
    return paths
