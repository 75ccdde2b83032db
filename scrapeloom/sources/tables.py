"""Written tables, grouped by run and published as a whole."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import reconcile

PUBLISHED = "published"


class PublicationConflict(RuntimeError):
    """Another run was published since this attempt began."""


class Warehouse:
    """Tables under ``root/run=<id>/attempt=<token>/<name>``.

    Every attempt at a run has a folder of its own, and publishing names that folder in
    a numbered file. An attempt may only become the number after the one that was
    last when it began, and a number is given once: of two writers one wins, the
    other is told. Readers see the highest number; an attempt that fails leaves it
    untouched, also when it repeats the id of the published run.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._attempts: dict[str, str] = {}
        self._numbers: dict[str, int] = {}

    def begin(self, run: str) -> None:
        """Start a new attempt at a run; what is written from now on belongs to it."""
        self._attempts[run] = f"run={run}/attempt={uuid.uuid4().hex}"
        log = self._log()
        last = None if log is None else log.agg(F.max("number")).first()[0]
        self._numbers[run] = 1 + (last or 0)

    def path(self, run: str, name: str) -> str:
        if run not in self._attempts:
            self.begin(run)
        return f"{self.root}/{self._attempts[run]}/{name}"

    def write(self, run: str, name: str, df: DataFrame, *partition_by: str) -> DataFrame:
        """Overwrite a table of the attempt at hand; returns its reconciliation line."""
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(run, name))
        return reconcile(name, self.spark.read.parquet(self.path(run, name)), seen.get["rows"])

    def publish(self, run: str) -> int:
        """Make the attempt at hand the published one; returns its number.

        The file is written aside and renamed to its number, which fails where that
        exists. File systems that rename without overwriting in one step, as HDFS does,
        thus let only one of several writers through. Local ones look first and rename then,
        so there the file gets its number by a link, which is one step.
        """
        number = self._numbers[run]
        context, hadoop = self.spark.sparkContext, self.spark._jvm.org.apache.hadoop.fs
        aside = hadoop.Path(f"{self.root}/{PUBLISHED}/.{uuid.uuid4().hex}")
        target = hadoop.Path(f"{self.root}/{PUBLISHED}/{number:010d}.json")
        files = target.getFileSystem(context._jsc.hadoopConfiguration())
        local = files.getUri().getScheme() == "file"
        if local:  # without a checksum file, which a link would leave behind
            files = files.getRawFileSystem()
        line = json.dumps({"run": run, "folder": self._attempts[run]})
        out = files.create(aside, False)
        out.write(bytearray(line.encode()))
        out.close()
        try:
            if local:
                nio = self.spark._jvm.java.nio.file
                old, new = (nio.Paths.get(files.makeQualified(p).toUri()) for p in (aside, target))
                nio.Files.createLink(new, old)
                files.delete(aside, False)
            else:
                names = hadoop.FileContext.getFileContext(context._jsc.hadoopConfiguration())
                names.rename(aside, target, self._without_overwriting())
        except Py4JJavaError as error:
            files.delete(aside, False)
            if "FileAlreadyExists" not in str(error.java_exception.getClass()):
                raise
            raise PublicationConflict(f"number {number} was published while run {run} was made") from error
        return number

    def _without_overwriting(self):
        """The options of a rename that fails where its target exists."""
        java = self.spark._jvm.java.lang
        kind = java.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = java.reflect.Array.newInstance(kind, 1)
        options[0] = next(k for k in kind.getEnumConstants() if k.name() == "NONE")
        return options

    def _log(self) -> DataFrame | None:
        """All publications, as (number, run, folder); None before the first."""
        place = f"{self.root}/{PUBLISHED}"
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        reader = self.spark.read.schema("run string, folder string").option("pathGlobFilter", "[0-9]*.json")
        files = reader.json(place)
        number = F.regexp_extract("_metadata.file_name", "^(\\d+)", 1).cast("bigint")
        return files.select(number.alias("number"), "run", "folder")

    def _published(self, run: str | None = None):
        """Run and folder of the last publication, of any run or of one."""
        log = self._log()
        if log is None:
            raise LookupError(f"nothing is published under {self.root}")
        log = log if run is None else log.where(F.col("run") == run)
        last = log.agg(F.max_by(F.struct("run", "folder"), "number")).first()[0]
        if last is None:
            raise LookupError(f"run {run} is not published under {self.root}")
        return last

    def current_run(self) -> str:
        return self._published().run

    def published_table(self, name: str) -> DataFrame | None:
        """A table of the last published run, or None if there is no run or it has no such table."""
        if self._log() is None:
            return None
        place = f"{self.root}/{self._published().folder}/{name}"
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        exists = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)
        return self.spark.read.parquet(place) if exists else None

    def read(self, name: str, run: str | None = None) -> DataFrame:
        """A published table, or with ``run`` that of the attempt begun here or published last."""
        folder = self._attempts.get(run) or self._published(run).folder
        return self.spark.read.parquet(f"{self.root}/{folder}/{name}")


def write_csv(df: DataFrame, folder: str, single_file: bool = False) -> None:
    """CSV with a header line; ``single_file`` for outputs of known small size."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(folder)
