"""Stage tables of the workload: written on first use, then read back.

The stages feed each other as in a daily run. A table is built once per Spark
application and input folder, in the shared folder; a later query that finds it
there reads it.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from scrapeloom.operators import cleaning, resolution
from scrapeloom.plans import star as model
from scrapeloom.session import shared_dir
from scrapeloom.sources.daily_csv import apply_date_fallback

from . import scrape_view

ROW_ORDER = ("event_id",)


class Stages:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        key = md5(sf_dir.rstrip("/").encode()).hexdigest()[:12]
        self.base = f"{shared_dir(spark)}/stages-{spark.sparkContext.applicationId}-{key}"

    def saved(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.base}/{name}"
        try:
            return self.spark.read.parquet(path)
        except AnalysisException:  # not built yet
            build().write.mode("overwrite").parquet(path)
            return self.spark.read.parquet(path)

    def table(self, name: str) -> DataFrame:
        return scrape_view.table(self.spark, self.sf_dir, name)

    @property
    def landing(self) -> DataFrame:
        return scrape_view.landing(self.spark, self.sf_dir)

    @property
    def raw(self) -> DataFrame:
        return self.saved("raw_scrape", lambda: apply_date_fallback(self.landing))

    @property
    def clean(self) -> DataFrame:
        return self.saved("clean_scrape", lambda: cleaning.clean_scrape(self.raw))

    def resolution(self, pct: int = 100) -> resolution.Resolution:
        signals = resolution.add_signals(self.clean)
        clusters = None
        if pct < 100:
            clusters = self.saved(
                f"clusters_{pct}", lambda: resolution.name_clusters(signals, ROW_ORDER, pct)
            )
        entities = self.saved(
            f"entities_{pct}", lambda: resolution.build_entities(signals, clusters)
        )
        return resolution.Resolution(signals, clusters, entities)

    def star(self) -> model.Star:
        """The star over companies of equal names."""
        entity_map = self.resolution().entity_map
        categories = self.saved("dim_category", lambda: model.dim_category(self.clean))
        locations = self.saved("dim_location", lambda: model.dim_location(self.clean))
        return model.Star(
            dim_date=self.saved("dim_date", lambda: model.dim_date(self.clean)),
            dim_category=categories,
            dim_entity=self.saved("dim_entity", lambda: model.dim_entity(entity_map)),
            dim_location=locations,
            fact_scrape=self.saved(
                "fact_scrape",
                lambda: model.fact_scrape(self.clean, categories, entity_map, locations),
            ),
        )
