"""The map step as one job: flat tables in, the fourteen tables of the input layer out.

Claim headers, claim lines and the first diagnoses of each claim are read by several tables.
The job computes each of them once, with the columns that are read, and keeps it as a table in
buckets by claim, so that every later join by claim reads matching buckets, shuffles nothing and
sorts nothing. Claims with very many lines would fill a bucket on their own and a bucket cannot be
split: their lines are kept in a table without buckets, where adaptive execution splits the joins.

A shuffle's files go when the table is written that it was for, and the lines as they were
flattened once they lie by claim, so the job holds the shuffles of a few tables at a time at most.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat.plans import claims, clinical, code_maps
from clinflat.plans.common import RunInfo
from clinflat.session import remove_folder, shuffles_cleared

#: Lines of a claim from which it is kept out of the buckets.
LONG_CLAIM = 1 << 20
#: Shared intermediates are read by the job alone. Ids and amounts of lines seldom repeat, so dictionaries of them cost
#: time and save no space.
STAGE_OPTIONS = {"compression": "zstd"}
LINE_OPTIONS = STAGE_OPTIONS | {"parquet.enable.dictionary": "false"}
#: Tables that are written side by side, so that no core waits for the last task of a table.
WRITERS = 3
#: Which of the fourteen tables read others of them.
READS = {"eligibility": ("patient",)}
STAGES = (
    "stage_diagnosis_code", "stage_drug_package", "stage_line", "stage_long_claim", "stage_long_claim_line", "stage_claim_line",
    "stage_claim_header", "stage_claim_diagnosis", "stage_long_claim_header", "stage_long_claim_diagnosis", "stage_enrolment",
)
REPORT_SCHEMA = "name string, rows bigint, seconds double"
LINES = "explanation_of_benefit_item"
DIAGNOSES = "explanation_of_benefit_diagnosis"
#: Flat columns of claim lines that the tables are made of.
LINE_COLUMNS = tuple(dict.fromkeys([*claims.medical_line_columns(), *claims.pharmacy_line_columns(), *claims.LINE_DATE_COLUMNS]))


class InputLayer:
    """The tables of the input layer over flat tables.

    ``flat`` gives a flat table by name. Tables are written to ``database``, below ``folder``
    where one is named, else where the database keeps its tables; shared intermediates carry the
    prefix ``stage_``. Building again replaces all of them. ``buckets`` is the number of buckets
    by claim, by default that of shuffle partitions: choose it so that a bucket of claim lines
    fits a task. ``diagnosis_salts`` is for claims with diagnoses in very many tasks.
    ``columns`` gives some columns of a flat table, for sources that read less for them; by default
    they are those of ``flat``.
    """

    def __init__(
        self,
        spark: SparkSession,
        flat: Callable[[str], DataFrame],
        diagnosis_map: DataFrame,
        drug_packages: DataFrame,
        database: str,
        run: RunInfo | None = None,
        folder: str | None = None,
        buckets: int | None = None,
        long_claim: int = LONG_CLAIM,
        diagnosis_salts: int = 1,
        columns: Callable[[str, Sequence[str]], DataFrame] | None = None,
    ) -> None:
        self.spark, self.flat, self.database, self.folder = spark, flat, database, folder
        self.diagnosis_map, self.drug_packages = diagnosis_map, drug_packages
        self.run = run or RunInfo()
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.long_claim, self.diagnosis_salts = long_claim, diagnosis_salts
        self.columns = columns or (lambda name, names: flat(name).select(*names))
        self.has_long_claims = False
        self.report: list[tuple[str, int, float]] = []

    # -- storage ---------------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def _write(self, name: str, df: DataFrame, by: str | None = None) -> DataFrame:
        """Replace a table, in buckets sorted by a column where one is named, and note its rows."""
        started = time.monotonic()
        writer = (df if by is None else df.repartition(self.buckets, by)).write.mode("overwrite").format("parquet")
        if by is not None:
            writer = writer.bucketBy(self.buckets, by).sortBy(by)
        if name.startswith("stage_"):
            writer = writer.options(**(LINE_OPTIONS if name.endswith("_line") else STAGE_OPTIONS))
        if self.folder is not None:
            writer = writer.option("path", self._path(name))
        writer.saveAsTable(f"{self.database}.{name}")
        written = self.table(name)
        self.report.append((name, written.count(), time.monotonic() - started))
        return written

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def _drop(self, name: str) -> None:
        """Remove a table and its files."""
        self.spark.sql(f"drop table {self.database}.{name}")
        if self.folder is not None:
            remove_folder(self.spark, self._path(name))

    # -- shared intermediates ----------------------------------------------------------

    def stage(self) -> None:
        """Compute the shared intermediates, each once."""
        with shuffles_cleared(self.spark), self._in_order(), ThreadPoolExecutor(WRITERS) as pool:
            beside_this = inheritable_thread_target(self.spark)
            beside = [pool.submit(beside_this(f)) for f in (self._stage_diagnoses, self._stage_packages)]
            long = self._stage_lines()
            headers = claims.claim_headers(
                self.flat("explanation_of_benefit"), self._all_lines(), self.flat("encounter"), self.flat("practitioner")
            )
            self._write("stage_claim_header", headers, by="claim_id")
            spans = claims.enrolment_spans(self.table("stage_claim_header"), self.flat("patient"))
            self._write("stage_enrolment", spans)
            for written in beside:
                written.result()
            if self.has_long_claims:
                # without buckets, as Spark can split a large claim in a join of two shuffles only
                of_long = F.col("claim_id") == F.col("eob_id")
                for name in ("claim_header", "claim_diagnosis"):
                    self._write(f"stage_long_{name}", self.table(f"stage_{name}").join(long, of_long, "left_semi"))

    def _stage_lines(self) -> DataFrame:
        """The lines, those of long claims apart; the long claims."""
        # flattened once, as the steps below read the lines up to three times
        lines = self._write("stage_line", self.columns(LINES, LINE_COLUMNS))
        sizes = lines.groupBy("eob_id").agg(F.count(F.lit(1)).alias("lines"))
        long = self._write("stage_long_claim", sizes.where(F.col("lines") > self.long_claim).select("eob_id"))
        self.has_long_claims = not long.isEmpty()
        if self.has_long_claims:
            self._write("stage_long_claim_line", lines.join(long, "eob_id", "left_semi"))
            lines = lines.join(long, "eob_id", "left_anti")
        self._write("stage_claim_line", lines, by="eob_id")
        self._drop("stage_line")
        return long

    def _stage_diagnoses(self) -> None:
        code_map = self._write("stage_diagnosis_code", code_maps.diagnosis_code_map(self.diagnosis_map))
        diagnoses = self.columns(DIAGNOSES, claims.DIAGNOSIS_INPUTS)
        lists = claims.claim_diagnosis_lists(diagnoses, self.flat("condition"), code_map, salts=self.diagnosis_salts)
        self._write("stage_claim_diagnosis", lists, by="claim_id")

    def _stage_packages(self) -> None:
        self._write("stage_drug_package", code_maps.drug_package_map(self.drug_packages))

    @contextmanager
    def _in_order(self) -> Iterator[None]:
        """What is written within is reported in one order, whichever table was ready first."""
        before = len(self.report)
        yield
        order = [*STAGES, *self.models()]
        self.report[before:] = sorted(self.report[before:], key=lambda row: order.index(row[0]))

    def _prefixes(self) -> list[str]:
        return ["stage_"] + ["stage_long_"] * self.has_long_claims

    def _all_lines(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.table(f"{p}claim_line") for p in self._prefixes()])

    # -- the fourteen tables -----------------------------------------------------------

    def models(self) -> dict[str, Callable[[], DataFrame]]:
        """What builds each table from flat tables and shared intermediates, in an order that has
        each one before those that read it."""
        flat, table, run = self.flat, self.table, self.run
        return {
            "patient": lambda: clinical.patients(flat("patient"), run),
            "encounter": lambda: clinical.encounters(flat("encounter"), table("stage_claim_header"), run),
            "condition": lambda: clinical.conditions(flat("condition"), run),
            "procedure": lambda: clinical.procedures(flat("procedure"), run),
            "observation": lambda: clinical.observations(flat("observation"), flat("observation_component"), run),
            "lab_result": lambda: clinical.lab_results(flat("observation"), flat("diagnostic_report_result"), run),
            "medication": lambda: clinical.medications(
                flat("medication_request"), flat("medication"), table("stage_drug_package"), run
            ),
            "immunization": lambda: clinical.immunizations(flat("immunization"), run),
            "location": lambda: clinical.locations(flat("location"), flat("organization"), run),
            "practitioner": lambda: clinical.practitioners(flat("practitioner"), flat("practitioner_role"), run),
            "eligibility": lambda: claims.eligibility(table("stage_enrolment"), table("patient"), run),
            "medical_claim": self.medical_claims,
            "pharmacy_claim": self.pharmacy_claims,
            "appointment": lambda: clinical.appointments(self.spark),
        }

    def _of_claims(self, build: Callable[[str], DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, [build(prefix) for prefix in self._prefixes()])

    def medical_claims(self) -> DataFrame:
        return self._of_claims(
            lambda prefix: claims.medical_claims(
                self.table(f"{prefix}claim_header"),
                self.table(f"{prefix}claim_line"),
                self.table(f"{prefix}claim_diagnosis"),
                self.run,
            )
        )

    def pharmacy_claims(self) -> DataFrame:
        packages = self.table("stage_drug_package")
        return self._of_claims(
            lambda prefix: claims.pharmacy_claims(
                self.table(f"{prefix}claim_header"), self.table(f"{prefix}claim_line"), packages, self.run
            )
        )

    def build(self) -> DataFrame:
        """Write all tables, a few at a time; one row per table, intermediates included: name, rows, seconds."""
        self.report = []
        self.stage()
        written: dict[str, Future] = {}

        def write(name: str, model: Callable[[], DataFrame]) -> None:
            for other in READS.get(name, ()):
                written[other].result()
            self._write(name, model())

        with shuffles_cleared(self.spark), self._in_order(), ThreadPoolExecutor(WRITERS) as pool:
            for name, model in self.models().items():
                written[name] = pool.submit(inheritable_thread_target(self.spark)(write), name, model)
            try:
                for table in written.values():
                    table.result()
            except BaseException:
                pool.shutdown(wait=False, cancel_futures=True)  # those not begun
                raise
        return self.spark.createDataFrame(self.report, REPORT_SCHEMA)
