"""Queries that go through files: records of the given tables are exported as newline-delimited
JSON into the shared folder and read, routed, flattened or streamed from there."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.nesting import as_json
from checks.queries import register
from checks.records import FLAT_SQL, RECORDS, TERMINOLOGY_SQL, records, terminology
from clinflat.operators.flatten import FlatView
from clinflat.plans.tables import TABLES
from clinflat.session import shared_folder
from clinflat.sources import router
from clinflat.sources.resources import read_code_table, read_resources
from clinflat.sources.schemas import DIAGNOSIS_MAP_SCHEMA
from clinflat.sources.sinks import flatten_all
from clinflat.sources.upkeep import IncrementalTable
from clinflat.streaming.landing import flatten_folder, flatten_stream, stream_resources


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def write_named(spark: SparkSession, lines: DataFrame, folder: str, name: str) -> None:
    """Lines as text files of a folder that are called name.000.ndjson and so on."""
    staged = f"{folder}-{uuid.uuid4().hex}"
    lines.write.text(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(folder))
    parts = [f.getPath() for f in system.listStatus(hadoop.Path(staged)) if f.getPath().getName().startswith("part-")]
    for i, part in enumerate(sorted(parts, key=lambda p: p.getName())):
        system.rename(part, hadoop.Path(f"{folder}/{name}.{i:03d}.ndjson"))


def export(spark: SparkSession, sf_dir: str, typed: Sequence[str] = (), mixed: Sequence[str] = ()) -> str:
    """A new folder with the records of flat tables: in files named by their type, or all mixed."""
    folder = new_folder(spark)

    def lines(table: str) -> DataFrame:
        return as_json(records(spark, sf_dir, table))

    for table in typed:
        write_named(spark, lines(table), folder, RECORDS[table][0])
    if mixed:
        write_named(spark, reduce(DataFrame.unionByName, map(lines, mixed)), folder, "records")
    return folder


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = export(spark, sf_dir, ["practitioner"], ["practitioner_role", "organization"])
    return TABLES["practitioner"].apply(read_resources(spark, folder, "Practitioner"))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, layout = export(spark, sf_dir, mixed=["practitioner", "organization", "location"]), new_folder(spark)
    router.route_resources(spark, folder, layout)
    return TABLES["location"].apply(router.read_routed(spark, layout, "Location"))


JOB_VIEWS = ("practitioner", "organization", "observation", "observation_component", "medication")


def _flatten_all(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    folder = export(spark, sf_dir, ["practitioner"], ["organization", "observation"])
    database, out = f"flat_{uuid.uuid4().hex}", new_folder(spark)
    spark.sql(f"create database {database} location '{out}-tables'")
    views = [TABLES[n] for n in JOB_VIEWS]
    return database, flatten_all(spark, views, folder, parquet_folder=out, database=database)


def _count(table: str, resources: str) -> str:
    rows = f"(select count(*) from ({FLAT_SQL[table]}))"
    return f"select '{table}' as name, {rows} as rows, (select count(*) from {resources}) as resources"


def _stream_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five views of two types in one stream; the rows of one, and how many the others have."""
    folder, out = export(spark, sf_dir, ["observation"], ["practitioner"]), new_folder(spark)
    names = ("practitioner", "observation", "observation_component")
    copies = [FlatView(f"{n}_again", TABLES[n].resource, TABLES[n].select) for n in names[:2]]
    views = [*[TABLES[n] for n in names], *copies]
    flatten_folder(spark, views, folder, out, f"{out}-state").awaitTermination()
    counts = [
        spark.read.parquet(f"{out}/{v.name}").select(F.lit(v.name).alias("name"), "batch").groupBy("name").count()
        for v in views
    ]
    return reduce(DataFrame.unionByName, counts).withColumnRenamed("count", "rows")


def _stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, out = export(spark, sf_dir, ["observation"], ["practitioner"]), new_folder(spark)
    flatten_folder(spark, [TABLES["observation_component"], TABLES["observation"]], folder, out, f"{out}-state").awaitTermination()
    return spark.read.parquet(f"{out}/observation_component").drop("batch")


def _stream_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, out = export(spark, sf_dir, ["immunization"]), new_folder(spark)
    stream = stream_resources(spark, folder, "Immunization", files_per_batch=1)
    flatten_stream(TABLES["immunization"], stream, out, f"{out}-state").awaitTermination()
    return spark.read.parquet(out)


def _code_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    terminology(spark, sf_dir, "diagnosis_map").write.option("header", True).csv(path)
    return read_code_table(spark, path, DIAGNOSIS_MAP_SCHEMA)


def _two_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Practitioners of a full export, then of a later one with changes of every second and with old rows again."""
    full = records(spark, sf_dir, "practitioner")

    def at(df: DataFrame, time: str) -> DataFrame:
        meta = F.struct(F.lit(time).alias("lastUpdated")).cast(full.schema["meta"].dataType)
        return df.withColumn("meta", meta)

    first, second, source = at(full, "2024-01-01T00:00:00Z"), new_folder(spark), new_folder(spark)
    changed = at(full.where("cast(id as long) % 2 = 0").withColumn("gender", F.lit("other")), "2024-02-01T00:00:00+01:00")
    write_named(spark, as_json(first), source, "Practitioner")
    write_named(spark, as_json(changed.unionByName(first.where("cast(id as long) % 5 < 2"))), second, "Practitioner")
    table = IncrementalTable(spark, new_folder(spark), "Practitioner")
    table.load(source)
    table.load(second)
    return TABLES["practitioner"].apply(table.current())


register(
    "incremental_table",
    _two_exports,
    f"""select * replace (case when cast(id as bigint) % 2 = 0 then 'other' else gender end as gender)
    from ({FLAT_SQL["practitioner"]})""",
)
register("files_read", _read, FLAT_SQL["practitioner"])
register("files_routed", _routed, FLAT_SQL["location"])
register(
    "files_flatten_all",
    lambda spark, sf_dir: _flatten_all(spark, sf_dir)[1].select("name", "rows", "resources"),
    f"""{_count("practitioner", "supplier")} union all {_count("organization", "nation")} union all
    {_count("observation", "events")} union all {_count("observation_component", "events")} union all
    select 'medication', 0, 0""",
)
register(
    "files_flattened_table",
    lambda spark, sf_dir: spark.table(f"{_flatten_all(spark, sf_dir)[0]}.observation_component"),
    FLAT_SQL["observation_component"],
)
register(
    "stream_views",
    _stream_views,
    " union all ".join(
        f"select '{name}' as name, count(*) as rows from ({FLAT_SQL[name.removesuffix('_again')]})"
        for name in ("practitioner", "observation", "observation_component", "practitioner_again", "observation_again")
    ),
)
register("stream_view_rows", _stream_rows, FLAT_SQL["observation_component"])
register("stream_single_view", _stream_one, FLAT_SQL["immunization"])
# an empty field of a CSV file is no value
register(
    "files_code_table",
    _code_table,
    f"select * replace (nullif(map_target, '') as map_target) from ({TERMINOLOGY_SQL['diagnosis_map']})",
)
