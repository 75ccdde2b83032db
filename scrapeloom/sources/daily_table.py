"""A table kept by day, of which single days are replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


class DailyTable:
    """Rows under ``path/rows/<day>=.../`` and one line per replaced day and load under ``path/loads``.

    A load replaces the days it holds and leaves all others untouched. Spark writes it
    aside and moves the finished days into place, so a load whose tasks fail changes
    nothing. Moving is one step per day, not for all: :meth:`check` compares what is
    there with what the loads say. Loads of one table follow each other; two at once
    are not told apart.

    Days are texts, compared as such, and stay texts when read. Rows without a day form
    a day of their own (null).
    """

    def __init__(self, spark: SparkSession, path: str, day: str = "scrape_date"):
        self.spark, self.path, self.day = spark, path.rstrip("/"), day
        self._rows, self._loads, self._columns = (f"{self.path}/{part}" for part in ("rows", "loads", "columns"))

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _exists(self, path: str) -> bool:
        files, folder = self._folder(path)
        return files.exists(folder)

    def read(self) -> DataFrame | None:
        """All rows, or None before the first load; filters on the day read only the folders they need."""
        fields = self._fields()
        if fields is None:
            return None
        return self.spark.read.schema(StructType([*fields, StructField(self.day, StringType())])).parquet(self._rows)

    def _fields(self) -> list[StructField] | None:
        """The columns of all loads but the day, from files without rows, so no data file is opened for them."""
        if not self._exists(self._columns):
            return None
        return list(self.spark.read.option("mergeSchema", True).parquet(self._columns).schema)

    def _keep_columns(self, rows: DataFrame) -> None:
        known = self._fields()
        own = rows.drop(self.day)
        if known is None or not {(f.name, f.dataType) for f in own.schema} <= {(f.name, f.dataType) for f in known}:
            own.limit(0).write.mode("append").parquet(self._columns)
        files, folder = self._folder(self._rows)
        files.mkdirs(folder)

    def loads(self) -> DataFrame | None:
        """``load, day, rows`` of all loads; None before the first."""
        if not self._exists(self._loads):
            return None
        return self.spark.read.schema("load bigint, day string, rows bigint").parquet(self._loads)

    def load(self, df: DataFrame, days: list[str] | None = None) -> int:
        """Replace the days that ``df`` holds, and empty those of ``days`` that it does not hold.

        With ``days``, rows of other days are refused. Returns the number of the load.
        ``df`` is read twice, the first time for its days only. The days pass through
        the driver: one line a day, not a row.
        """
        day = F.col(self.day).cast("string")
        rows = df.withColumn(self.day, day)
        held = rows.groupBy(self.day).agg(F.lit(None).alias("_"))
        if days is not None:
            strange = held.where(~F.coalesce(F.col(self.day).isin(days), F.lit(False))).limit(1)
            if not strange.isEmpty():
                raise ValueError(f"rows of a day that is not to be replaced: {strange.first()[0]}")
        replaced = {r[0] for r in held.toLocalIterator()}
        emptied = set(days or ()) - replaced
        earlier = self.loads()
        number = 1 + ((earlier.agg(F.max("load")).first()[0] if earlier is not None else None) or 0)
        self._keep_columns(rows)
        seen = Observation()
        if replaced:
            out = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
            out.option("partitionOverwriteMode", "dynamic").partitionBy(self.day).parquet(self._rows)
        for name in sorted(emptied):
            self._empty(name)
        changed = self.spark.createDataFrame([(d,) for d in replaced | emptied], "day string")
        found = self._counts()
        lines = changed.join(found, changed.day.eqNullSafe(found.day), "left").select(
            F.lit(number).cast("bigint").alias("load"), changed.day, F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")
        )
        lines.coalesce(1).write.mode("append").parquet(self._loads)
        written = self.loads().where(F.col("load") == number).agg(F.sum("rows")).first()[0] or 0
        if written != (seen.get["rows"] if replaced else 0):
            raise RuntimeError(f"load {number}: {written} rows found of {seen.get['rows']} handed to the writer")
        return number

    def _empty(self, name: str) -> None:
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)
        files, folder = self._folder(f"{self._rows}/{self.day}={escaped}")
        files.delete(folder, True)

    def _counts(self) -> DataFrame:
        rows = self.read()
        if rows is None:
            return self.spark.createDataFrame([], "day string, rows bigint")
        return rows.groupBy(F.col(self.day).alias("day")).agg(F.count(F.lit(1)).alias("rows"))

    def check(self) -> DataFrame:
        """``day, load, rows_expected, rows_found, matches`` for each day that was ever loaded."""
        last = self.loads().groupBy("day").agg(F.max_by(F.struct("load", "rows"), "load").alias("last"))
        found = self._counts().withColumnRenamed("day", "found_day").withColumnRenamed("rows", "found")
        rows = F.coalesce("found", F.lit(0)).cast("bigint")
        return last.join(found, F.col("day").eqNullSafe(F.col("found_day")), "full").select(
            F.coalesce("day", "found_day").alias("day"), "last.load", F.col("last.rows").alias("rows_expected"),
            rows.alias("rows_found"), F.coalesce(F.col("last.rows") == rows, F.lit(False)).alias("matches"),
        )
