"""Writers for flat tables, and the job that flattens a folder with all views."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clinflat.operators.flatten import FlatView
from clinflat.session import remove_folder, shared_folder
from clinflat.sources.resources import read_resources
from clinflat.sources.router import has_untyped_files, read_routed, route_resources

REPORT_SCHEMA = "resource string, name string, rows bigint, resources bigint, seconds double"


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Create or replace a managed table, also when it has no rows."""
    df.write.mode(mode).saveAsTable(name)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def view_name(view: FlatView) -> str:
    return view.name or view.resource.lower()


def flatten_all(
    spark: SparkSession,
    views: Sequence[FlatView],
    source: str,
    parquet_folder: str | None = None,
    database: str | None = None,
    parse_once: bool = True,
    staging: str | None = None,
) -> DataFrame:
    """Run views over a folder of resource files and write one table per view.

    Results go to ``parquet_folder/<name>``, to tables of ``database``, or both. A type with
    several views is parsed once: into typed Parquet under ``staging``, which its owner
    clears, or, where none is given, onto the disks of the executors until its views are
    written; what a lost executor held is parsed again. Without ``parse_once`` each view
    scans the files and parses only the fields it uses. Files of a folder whose names tell no
    type are read once for all types: their lines are sorted by type below ``staging`` or, for
    the time of the run, in the folder that all executors share. The report has one row per view.
    """
    if parquet_folder is None and database is None:
        raise ValueError("name a parquet folder, a database, or both")
    run = uuid.uuid4().hex
    report = []
    layout = f"{(staging or shared_folder(spark)).rstrip('/')}/clinflat-{run}/by_type"
    routed = has_untyped_files(spark, source)
    if routed:
        route_resources(spark, source, layout)
    for resource in dict.fromkeys(v.resource for v in views):
        own = [v for v in views if v.resource == resource]
        started = time.monotonic()
        records = read_resources(spark, source, resource, typed_only=routed)
        if routed:
            records = records.unionByName(read_routed(spark, layout, resource))
        seen = Observation(f"resources_{resource}")
        shared = parse_once and len(own) > 1
        if shared and staging is not None:
            staged = f"{staging.rstrip('/')}/clinflat-{run}/{resource}"
            write_parquet(records.observe(seen, F.count(F.lit(1)).alias("n")), staged)
            records = spark.read.parquet(staged)
            observed_records = records
        else:
            if shared:
                records = records.persist(StorageLevel.DISK_ONLY)
            observed_records = records.observe(seen, F.count(F.lit(1)).alias("n"))
        written = []
        for i, v in enumerate(own):
            name = view_name(v)
            rows = Observation(f"rows_{name}")
            df = v.apply(observed_records if i == 0 else records).observe(
                rows, F.count(F.lit(1)).alias("n")
            )
            if parquet_folder is not None:
                path = f"{parquet_folder.rstrip('/')}/{name}"
                write_parquet(df, path)
                df = spark.read.parquet(path)
            if database is not None:
                write_table(df, f"{database}.{name}")
            written.append((name, rows))
        if shared and staging is None:
            records.unpersist()
        seconds = time.monotonic() - started
        resources = seen.get["n"]
        report += [(resource, name, rows.get["n"], resources, seconds) for name, rows in written]
    if routed and staging is None:
        remove_folder(spark, layout)
    return spark.createDataFrame(report, REPORT_SCHEMA)
