"""Chain of stages: ingest, clean, resolve, model, report, gate, publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, profiling, quality, resolution
from ..sources.daily_csv import ingest
from ..sources.tables import Warehouse, write_csv
from . import reports
from . import star as model

# Gates that keep a run from being published.
BLOCKING = ("entity_id_unique", "phone_ten_digits")


@dataclass
class RunResult:
    run: str
    published: bool
    gates: DataFrame
    report_rows: dict[str, int]


def run_stages(
    spark: SparkSession,
    folder: str,
    warehouse: Warehouse,
    run: str,
    blocking: tuple[str, ...] = BLOCKING,
    pct: int = 90,
    **reading,
) -> RunResult:
    """Build all tables of a run from a folder of daily files.

    ``reading`` is passed on to :func:`ingest`. Each stage is written once and
    read back by the next. The run is published
    only if every table holds the rows handed to its writer and no blocking
    gate fails. Companies keep the numbers of the run published before; if another
    run is published meanwhile, :class:`PublicationConflict` is raised, as its numbers
    are not in this one.
    """
    warehouse.begin(run)
    earlier = warehouse.published_table("entity_ids")
    loaded = ingest(spark, folder, row_order=True, **reading)
    checks = [warehouse.write(run, "raw_scrape", loaded.raw)]
    warehouse.write(run, "ingest_report", loaded.report)
    warehouse.write(run, "schema_drift", loaded.drift)
    warehouse.write(run, "quarantine", loaded.quarantine)

    raw = warehouse.read("raw_scrape", run)
    checks.append(warehouse.write(run, "clean_scrape", cleaning.clean_scrape(raw)))
    clean = warehouse.read("clean_scrape", run)

    resolved = resolution.resolve(clean, pct=pct, registry=earlier)
    warehouse.write(run, "entities", resolved.entities)
    resolved.entities = warehouse.read("entities", run)
    checks.append(warehouse.write(run, "entity_ids", resolution.extended_registry(resolved.entities, earlier)))
    checks.append(warehouse.write(run, "entity_map", resolved.entity_map))
    warehouse.write(run, "entity_conflicts", resolved.conflicts)
    entity_map = warehouse.read("entity_map", run)
    write_csv(entity_map.drop("first_seen"), warehouse.path(run, "entity_map_csv"))

    def save(df: DataFrame, name: str) -> DataFrame:
        checks.append(warehouse.write(run, name, df))
        return warehouse.read(name, run)

    star = model.build_star(clean, entity_map, save=save)
    report_rows = reports.write_reports(star, warehouse.path(run, "reports"))

    summaries = {
        "null_summary": profiling.null_profile(raw),
        "cleaning_summary": cleaning.cleaning_summary(clean),
        "resolution_summary": resolved.summary,
        "top_entities": resolved.top_entities(),
        "model_row_counts": star.row_counts(),
    }
    for name, summary in summaries.items():
        warehouse.write(run, name, summary)
    warehouse.write(run, "gates", quality.gate_report(clean, star.dim_entity))
    gates = warehouse.read("gates", run)
    failed = gates.where(F.col("check_name").isin(*blocking) & ~F.col("passed"))
    good = failed.isEmpty() and all(check.first().matches for check in checks)
    if good:
        warehouse.publish(run)
    return RunResult(run, good, gates, report_rows)
