"""Star schema: dates, categories, entities, locations and the scrape fact."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import contact, dates, text
from ..operators.common import dense_index
from ..session import cut

NO_MATCH = -1


def dim_date(clean: DataFrame) -> DataFrame:
    """One row per scrape date; texts that are no dates are left to :func:`bad_dates`."""
    days = (
        clean.where(F.col("scrape_date").isNotNull())
        .select(F.col("scrape_date").alias("date_id"))
        .distinct()
        .withColumn("full_date", dates.iso_date("date_id"))
        .where(F.col("full_date").isNotNull())
    )
    return days.select(
        "date_id",
        "full_date",
        F.year("full_date").cast("bigint").alias("year"),
        F.month("full_date").cast("bigint").alias("month"),
        F.dayofmonth("full_date").cast("bigint").alias("day"),
        dates.sunday_based_weekday("full_date").alias("day_of_week"),
        dates.week_start("full_date").alias("week_start"),
    )


def bad_dates(clean: DataFrame) -> DataFrame:
    """Rows whose scrape date cannot be read as a date."""
    return clean.where(F.col("scrape_date").isNotNull() & dates.iso_date("scrape_date").isNull())


def dim_category(clean: DataFrame) -> DataFrame:
    """Known labels. Cleaning lets through canonical labels only, so the one
    task of the numbering window never sees more rows than there are labels."""
    labels = (
        clean.where(F.col("category").isNotNull() & (F.col("category") != contact.UNKNOWN_CATEGORY))
        .select(F.col("category").alias("category_name"))
        .distinct()
    )
    number = F.row_number().over(Window.orderBy("category_name")).cast("bigint")
    return labels.select(number.alias("category_id"), "category_name")


def dim_entity(entity_map: DataFrame) -> DataFrame:
    return entity_map.select(
        "entity_id",
        "canonical_name",
        "canonical_phone",
        F.col("categories").alias("all_categories"),
        "n_raw_rows",
        "first_seen",
    )


def dim_location(clean: DataFrame, placeholders_as_null: bool = True) -> DataFrame:
    """Distinct (city, country) with a known country, numbered by country and city."""
    city = text.known_city("city") if placeholders_as_null else F.col("city")
    places = (
        clean.where(F.col("country").isNotNull()).select(city.alias("city"), "country").distinct()
    )
    order = [F.asc_nulls_last("country"), F.asc_nulls_last("city")]
    return dense_index(places, order, "location_id").select("location_id", "city", "country")


def _spread(key: str, *others: str) -> Column:
    """Join key whose NULLs, which never match, do not meet in one task."""
    salt = F.concat(F.lit("\u0001"), F.pmod(F.xxhash64(*others), F.lit(4096)).cast("string"))
    return F.coalesce(F.col(key), salt)


def fact_scrape(
    clean: DataFrame,
    categories: DataFrame,
    entity_map: DataFrame,
    locations: DataFrame,
    link: str = "phone",
) -> DataFrame:
    """One row per clean row with a date.

    The dimensions should be written tables: the planner then knows their size
    and broadcasts those that are small, while larger ones are shuffled with
    hot keys split at run time. ``link='phone'`` finds the entity by phone;
    ``link='assignment'`` takes the ``entity_id`` that resolution gave each row.
    """
    rows = clean.where(F.col("scrape_date").isNotNull())
    salt = ("email_clean", "website_clean", "scraped_at", "company_name")
    if link == "phone":
        phones = entity_map.where(F.col("canonical_phone").isNotNull()).select(
            F.col("canonical_phone").alias("_phone"), "entity_id"
        )
        rows = rows.withColumn("_phone", _spread("phone_clean", *salt)).join(phones, "_phone", "left")
    elif link != "assignment":
        raise ValueError("link must be 'phone' or 'assignment'")
    names = categories.withColumnRenamed("category_name", "category")
    places = locations.select(
        "location_id", F.col("city").alias("_city"), F.col("country").alias("_country")
    )
    rows = rows.withColumn("_place", _spread("country", *salt))
    return (
        rows.join(names, "category", "left")
        .join(
            places,
            F.col("city").eqNullSafe(F.col("_city")) & (F.col("_place") == F.col("_country")),
            "left",
        )
        .select(
            F.monotonically_increasing_id().alias("fact_id"),
            F.col("scrape_date").alias("date_id"),
            "category_id",
            F.coalesce("entity_id", F.lit(NO_MATCH)).cast("bigint").alias("entity_id"),
            F.coalesce("location_id", F.lit(NO_MATCH)).cast("bigint").alias("location_id"),
            "phone_clean",
            "email_clean",
            "website_clean",
            "employee_count",
            "_source_file",
            "scraped_at",
        )
    )


@dataclass
class Star:
    """The five tables of the model."""

    dim_date: DataFrame
    dim_category: DataFrame
    dim_entity: DataFrame
    dim_location: DataFrame
    fact_scrape: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))

    def row_counts(self) -> DataFrame:
        """Rows per table of the model."""
        counts = None
        for name, table in self.tables().items():
            one = table.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            counts = one if counts is None else counts.unionByName(one)
        return counts


def build_star(
    clean: DataFrame,
    entity_map: DataFrame,
    link: str = "phone",
    save: Callable[[DataFrame, str], DataFrame] = cut,
) -> Star:
    """Write each table with ``save``, which returns it read back."""
    categories = save(dim_category(clean), "dim_category")
    locations = save(dim_location(clean), "dim_location")
    fact = fact_scrape(clean, categories, entity_map, locations, link)
    return Star(
        dim_date=save(dim_date(clean), "dim_date"),
        dim_category=categories,
        dim_entity=save(dim_entity(entity_map), "dim_entity"),
        dim_location=locations,
        fact_scrape=save(fact, "fact_scrape"),
    )
