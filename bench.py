"""Time the two steps of the pipeline and some single operators; prints one JSON line.

BENCH_SF_DIR names the folder of the given tables, BENCH_CPUS the number of cores.

Flatten: newline-delimited JSON of all record types (written beforehand, not timed) through
all nineteen views into Parquet. Map and report: every model over those flat tables.
Operator queries run from the given tables. Results that are not files go to Spark's noop
sink, so all rows and columns are computed. map_job is the whole map step as one job, with
shared intermediates and all fourteen tables written; as it builds the models above again, the
total is without it.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import checks.operator_queries  # noqa: F401
from checks.nesting import as_json
from checks.queries import QUERIES, RUN, Models
from checks.records import RECORDS, records, terminology
from clinflat.plans import reports
from clinflat.plans.job import InputLayer
from clinflat.plans.tables import TABLES
from clinflat.session import get_session
from clinflat.sources.sinks import flatten_all

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
LINE_TABLES = ("explanation_of_benefit_item", "explanation_of_benefit_diagnosis")
OPERATORS = (
    "foreach", "sibling_selects", "union_branches", "repeat_tree", "collection_functions",
    "bundle_entries", "conditional_references",
)
MODELS = {
    "code_map_top1": Models.code_map,
    "drug_code_top1": Models.package_map,
    "claim_header": Models.headers,
    "claim_diagnosis": Models.diagnoses,
    "claim_diagnosis_pivot": Models.diagnosis_columns,
    "enrolment_spans": Models.spans,
    "patient": Models.patients,
    "encounter": Models.encounters,
    "condition": Models.conditions,
    "procedure": Models.procedures,
    "observation": Models.observations,
    "lab_result": Models.labs,
    "medication": Models.medications,
    "immunization": Models.immunizations,
    "location": Models.locations,
    "practitioner": Models.practitioners,
    "eligibility": Models.eligibility,
    "medical_claim": Models.medical,
    "pharmacy_claim": Models.pharmacy,
    "pmpm_by_year": Models.pmpm,
    "encounters_by_type": lambda m: reports.encounters_by_type(m.encounter_set()),
    "common_conditions": lambda m: reports.common_conditions(m.condition_set()),
    "headline_summary": Models.summary,
}


def write_files(spark, tables, folder: str) -> None:
    os.makedirs(folder)
    done = set()
    for table in tables:
        resource = RECORDS[table][0]
        if resource in done:
            continue
        done.add(resource)
        staged = f"{folder}.{resource}"
        as_json(records(spark, FOLDER, table)).write.text(staged)
        parts = sorted(n for n in os.listdir(staged) if n.startswith("part-"))
        for i, name in enumerate(parts):
            os.link(f"{staged}/{name}", f"{folder}/{resource}.{i:03d}.ndjson")


def main() -> None:
    spark = get_session(
        "bench",
        spark__master=f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=CPUS,
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    times: dict[str, float] = {}

    def timed(name: str, job):
        started = time.monotonic()
        result = job()
        times[name] = round(time.monotonic() - started, 3)
        return result

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    flat = f"{scratch}/flat"
    resources = 0
    for step, names in (
        ("flatten_records", [t for t in TABLES if t not in LINE_TABLES]),
        ("flatten_claim_lines", list(LINE_TABLES)),
    ):
        export = f"{scratch}/{step}"
        write_files(spark, names, export)
        views = [TABLES[n] for n in names]
        report = timed(step, lambda e=export, v=views: flatten_all(spark, v, e, parquet_folder=flat))
        resources += sum(dict(report.select("resource", "resources").collect()).values())
    for name, build in MODELS.items():
        timed(name, lambda b=build: drain(b(Models(spark, FOLDER, flat))))
    spark.sql(f"create database bench location '{scratch}/bench'")
    maps = [terminology(spark, FOLDER, n) for n in ("diagnosis_map", "drug_packages")]
    layer = InputLayer(spark, Models(spark, FOLDER, flat).flat, *maps, "bench", RUN)
    timed("map_job", layer.build)
    for name in OPERATORS:
        timed(name, lambda n=name: drain(QUERIES[n](spark, FOLDER)))
    flatten_seconds = times["flatten_records"] + times["flatten_claim_lines"]
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()) - times["map_job"], 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "flattened_resources": resources,
        "flattened_resources_per_sec": round(resources / flatten_seconds),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
