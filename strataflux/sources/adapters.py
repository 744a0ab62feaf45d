"""Datasets on disk as discovered sessions, their files and their metadata.

An adapter says where sessions lie and what is known about them; everything after it works on canonical rows.
"""

from __future__ import annotations

import re
from abc import ABC, abstractmethod
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux.operators.canonical import decode, site_from_subject_id
from strataflux.operators.confound import first_rows

# fixed values: accepted names of the columns of a phenotype table, in order of preference, and its codes
PHENOTYPE_COLUMNS = {
    "subject_number": ("sub_id", "subid", "subject_id", "participant_id", "subject"),
    "site": ("site_id", "site"),
    "age": ("age_at_scan", "age_at_session", "age"),
    "sex": ("sex", "gender"),
    "dx": ("dx_group", "dx", "diagnosis", "group"),
}
SEX_CODES = {"1": "M", "2": "F"}
DX_CODES = {"1": "patient", "2": "control"}
CORE_TABLES = ("aseg.stats", "lh.aparc.stats", "rh.aparc.stats")


def listing(spark: SparkSession, pattern: str) -> list[str]:
    """Full URIs that match a pattern, as the scans name them; directories and files are metadata, so the driver lists them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in (found or []))


def walk(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(path, size, is_folder) of everything below the folders, and of those that are files; each task walks its share of them."""

    def below(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for folder in batch["folder"]:
                system, start = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))
                head = folder[: len(folder) - len(start)] if folder.endswith(start) else ""
                top = system.get_file_info(start)
                found = [top] if top.type == fs.FileType.File else system.get_file_info(fs.FileSelector(start, recursive=True))
                yield pd.DataFrame([(head + f.path, f.size or 0, f.type == fs.FileType.Directory) for f in found], columns=["path", "size", "is_folder"])

    seeds = spark.createDataFrame([(f,) for f in folders], "folder string")
    spread = seeds.repartition(max(1, min(len(folders), 4 * spark.sparkContext.defaultParallelism)))
    return spread.mapInPandas(below, "path string, size bigint, is_folder boolean")


class Adapter(ABC):
    def __init__(self, spark: SparkSession, root: str, subject: str | None = None) -> None:
        self.spark, self.root, self.subject = spark, root.rstrip("/"), subject
        self._found: DataFrame | None = None

    @abstractmethod
    def subject_folders(self) -> list[str]:
        """Full URIs of the subjects' folders, the only names that the driver lists."""

    @abstractmethod
    def place(self, path: Column) -> tuple[Column, Column]:
        """(subject_id, session_id) of the path of a `stats` folder."""

    @abstractmethod
    def metadata(self, sessions: DataFrame) -> DataFrame:
        """(subject_id, session_id, ...) with the acquisition and covariate columns that are known."""

    @abstractmethod
    def roster(self) -> DataFrame:
        """(subject_id, session_id, missing_cause, site) of every expected session."""

    def accepts(self, name: Column) -> Column:
        return name.endswith(".stats")

    def discover(self) -> DataFrame:
        """(subject_id, session_id, files array<string>); sessions without files have an empty array. Folders are walked in tasks."""
        if self._found is None:
            own = [f for f in self.subject_folders() if self.subject in (None, f.rpartition("/")[2])]
            tree = walk(self.spark, own)
            name, parent = F.substring_index("path", "/", -1), F.regexp_replace("path", "/[^/]*$", "")
            folders = tree.filter(F.col("is_folder") & (name == "stats")).select(F.col("path").alias("folder"), F.lit(None).cast("string").alias("file"))
            files = tree.filter(~F.col("is_folder") & (F.substring_index(parent, "/", -1) == "stats") & self.accepts(name)).select(parent.alias("folder"), F.col("path").alias("file"))
            held = folders.unionByName(files).groupBy("folder").agg(F.array_sort(F.collect_set("file")).alias("files"))
            subject, session = self.place(F.col("folder"))
            self._found = held.select(subject.alias("subject_id"), session.alias("session_id"), "files").filter("subject_id <> '' AND session_id <> ''")
        return self._found


class NestedAdapter(Adapter):
    """<root>/derivatives/freesurfer/<subject>/<session>/stats, with subjects.parquet and sessions.parquet beside, if there are any."""

    def subject_folders(self) -> list[str]:
        return listing(self.spark, f"{self.root}/derivatives/freesurfer/*")

    def place(self, path: Column) -> tuple[Column, Column]:
        pattern = r"/derivatives/freesurfer/([^/]+)/([^/]+)/stats$"
        return F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)

    def _truth(self, name: str, schema: str) -> DataFrame:
        present = listing(self.spark, f"{self.root}/{name}.parquet")
        return self.spark.read.parquet(f"{self.root}/{name}.parquet") if present else self.spark.createDataFrame([], schema)

    def metadata(self, sessions: DataFrame) -> DataFrame:
        subjects = self._truth(
            "subjects",
            "subject_id string, scanner_manufacturer string, scanner_model string, field_strength_tesla double, age_baseline double, sex string, "
            "dx_baseline string, etiv_baseline double",
        )
        visits = self._truth("sessions", "subject_id string, session_id string, time_from_baseline_years double, age_at_session double, acquisition_site string")
        people = first_rows(
            subjects.select("subject_id", "scanner_manufacturer", "scanner_model", "field_strength_tesla", "age_baseline", "sex", "dx_baseline", "etiv_baseline"),
            ["subject_id"], ["age_baseline", "sex"],
        )
        dated = first_rows(
            visits.select("subject_id", "session_id", "time_from_baseline_years", "age_at_session", F.col("acquisition_site").alias("site")),
            ["subject_id", "session_id"], ["time_from_baseline_years", "site"],
        )
        return sessions.select("subject_id", "session_id").join(people, "subject_id", "left").join(dated, ["subject_id", "session_id"], "left")

    def roster(self) -> DataFrame:
        return self._truth("sessions", "subject_id string, session_id string, missing_cause string, site string").select(
            "subject_id", "session_id", "missing_cause", "site"
        )


class FlatAdapter(Adapter):
    """<root>/<subject>/stats with the three core tables; one session per subject, covariates from a phenotype table."""

    def __init__(self, spark: SparkSession, root: str, subject: str | None = None, phenotype: str | None = None) -> None:
        super().__init__(spark, root, subject)
        self.phenotype_path = phenotype

    def subject_folders(self) -> list[str]:
        return listing(self.spark, f"{self.root}/*")

    def place(self, path: Column) -> tuple[Column, Column]:
        own = F.substring_index(F.regexp_replace(path, "/[^/]*/stats$", ""), "/", -1) == F.lit(self.root.rpartition("/")[2])
        return F.when(own, F.regexp_extract(path, r"/([^/]+)/stats$", 1)).otherwise(""), F.lit("1")

    def accepts(self, name: Column) -> Column:
        return name.isin(*CORE_TABLES)

    def phenotype(self) -> DataFrame:
        """(subject_number, site, age, sex, dx); empty without a usable table. Column names match in any letter case."""
        schema = "subject_number bigint, site string, age double, sex string, dx string"
        if not self.phenotype_path or not listing(self.spark, self.phenotype_path):
            return self.spark.createDataFrame([], schema)
        raw = self.spark.read.csv(self.phenotype_path, header=True)
        names = {c.strip().lower(): c for c in raw.columns}
        columns = {k: next((names[a] for a in aliases if a in names), None) for k, aliases in PHENOTYPE_COLUMNS.items()}
        if columns["subject_number"] is None:
            return self.spark.createDataFrame([], schema)
        cell = lambda k: F.trim(F.col(f"`{columns[k]}`")) if columns[k] else F.lit(None).cast("string")
        table = raw.select(
            cell("subject_number").try_cast("double").cast("bigint").alias("subject_number"), cell("site").alias("site"),
            cell("age").try_cast("double").alias("age"), decode(cell("sex"), SEX_CODES).alias("sex"), decode(cell("dx"), DX_CODES).alias("dx"),
        )
        return first_rows(table.filter("subject_number IS NOT NULL"), ["subject_number"], ["site", "age", "sex", "dx"])

    @staticmethod
    def number(subject_id: Column) -> Column:
        """The number at the end of a subject id, however it is padded."""
        return F.regexp_extract(subject_id, r"(\d+)$", 1).try_cast("bigint")

    def metadata(self, sessions: DataFrame) -> DataFrame:
        known = sessions.select("subject_id", "session_id", self.number(F.col("subject_id")).alias("subject_number")).join(
            self.phenotype(), "subject_number", "left"
        )
        return known.select(
            "subject_id", "session_id", F.lit(0.0).alias("time_from_baseline_years"), F.coalesce("site", site_from_subject_id(F.col("subject_id"))).alias("site"),
            F.col("age").alias("age_baseline"), F.col("age").alias("age_at_session"), "sex", F.col("dx").alias("dx_baseline"), F.col("dx").alias("dx_at_session"),
        )

    def roster(self) -> DataFrame:
        """Found subjects, and those of the phenotype table without a folder, which were never acquired."""
        found = self.discover()
        numbered = found.select("subject_id", "session_id", self.number(F.col("subject_id")).alias("subject_number"))
        present = numbered.join(self.phenotype().select("subject_number", F.col("site").alias("listed")), "subject_number", "left").select(
            "subject_id", "session_id", F.lit(None).cast("string").alias("missing_cause"),
            F.coalesce("listed", site_from_subject_id(F.col("subject_id"))).alias("site"),
        )
        absent = self.phenotype().join(numbered.select("subject_number"), "subject_number", "left_anti").select(
            F.col("subject_number").cast("string").alias("subject_id"), F.lit("1").alias("session_id"), F.lit("missing_acquisition").alias("missing_cause"), "site"
        )
        return present.unionByName(absent)


def build_adapter(spark: SparkSession, kind: str, root: str, subject: str | None = None, phenotype: str | None = None) -> Adapter:
    if kind == "nested":
        return NestedAdapter(spark, root, subject)
    if kind == "flat":
        return FlatAdapter(spark, root, subject, phenotype)
    raise ValueError(f"unknown adapter: {kind}")
