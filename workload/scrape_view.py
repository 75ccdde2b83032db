"""Scrape-like rows derived from the given tables.

Every event becomes one listing row of the company whose id is the event's
user: the web page gives name and site, the customer the place. Values are then
dirtied by row number. No row is left out. The same expressions are used in
Spark and in the checking SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_DIGITS = "cast(2000000000 + e.user_id * 7919 as string)"
_DASHED = (
    f"concat(substring({_DIGITS}, 1, 3), '-', substring({_DIGITS}, 4, 3), '-', substring({_DIGITS}, 7, 4))"
)
_DAY = "cast(cast(e.ts as date) as string)"

# One label per event type, in the spelling of the source data.
_LABEL = """case e.event_type
    when 'click' then 'ERP' when 'error' then 'HR' when 'purchase' then 'Legal'
    when 'signup' then 'MSP Platform' else 'Medical' end"""

COLUMNS = {
    "event_id": "e.event_id",
    # one day whose file has no dates at all, and a few single gaps
    "scrape_date": f"case when {_DAY} = '2024-01-10' or e.event_id % 1009 = 7 then null else {_DAY} end",
    "category": f"""case
        when e.event_id % 997 = 6 then 'category'
        when e.event_id % 7 = 0 and e.event_type = 'purchase' then 'legal'
        when e.event_id % 7 = 1 and e.event_type = 'purchase' then 'LEGAL '
        when e.event_id % 7 = 2 and e.event_type = 'purchase' then 'Lgl'
        when e.event_id % 7 = 2 then concat('  ', {_LABEL}, ' ')
        when e.event_id % 7 = 3 then '-'
        when e.event_id % 7 = 4 then lower({_LABEL})
        else {_LABEL} end""",
    "company_name": """case
        when e.event_id % 997 = 5 then 'company_name'
        when e.event_id % 211 = 3 then ' None '
        when e.event_id % 3 = 0
            then translate(p.title, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')
        when e.event_id % 3 = 1 then concat(' ', p.title, '  Inc.')
        else p.title end""",
    "phone": f"""case
        when e.user_id % 6 = 0 then case e.event_id % 3 when 0 then 'N/A' when 1 then '12345' else null end
        else case e.event_id % 9
            when 0 then {_DIGITS}
            when 1 then concat('+1', {_DIGITS})
            when 2 then concat('1', {_DIGITS})
            when 3 then concat('0', {_DIGITS})
            when 4 then {_DASHED}
            when 5 then concat('(', substring({_DIGITS}, 1, 3), ') ',
                substring({_DIGITS}, 4, 3), '-', substring({_DIGITS}, 7, 4))
            when 6 then concat(substring({_DIGITS}, 1, 3), '.',
                substring({_DIGITS}, 4, 3), '.', substring({_DIGITS}, 7, 4))
            when 7 then concat({_DIGITS}, ' ext. ', cast(e.event_id % 90 as string))
            else concat('1-', {_DASHED}, ' EXT 10') end end""",
    "email": """case e.event_id % 50 when 0 then 'bad_at_example' when 1 then ' null'
        else concat('Info@Host', cast(e.user_id as string), '.com') end""",
    "website": """case
        when e.user_id % 12 = 0 then '-'
        when e.event_id % 5 = 0 then upper(p.url)
        else p.url end""",
    "employee_count": """case when e.event_id % 11 = 0 then 'NA' when e.value < 10 then '1-10'
        when e.value < 50 then '11-50' else '51-200' end""",
    "city": """case e.event_id % 10 when 0 then '-' when 1 then null
        else concat('CITY_', cast(c.c_custkey % 20 as string)) end""",
    "country": "n.n_name",
    "scraped_at": "cast(e.ts as string)",
    # arrives in the middle of the month
    "source_url": f"case when {_DAY} >= '2024-01-15' then p.url end",
    "_source_file": f"concat('scrape_', {_DAY}, '.csv')",
    "_file_date": _DAY,
}

_PAGE = "select page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) as title from pages"

LANDING_SQL = (
    "select "
    + ",\n    ".join(f"{expression} as {name}" for name, expression in COLUMNS.items())
    + f"""
from events e
left join customer c on c.c_custkey = e.user_id
left join nation n on n.n_nationkey = c.c_nationkey
left join ({_PAGE}) p on p.page_id = e.user_id"""
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows as they land, before any stage.

    Pages and customers grow with the data: which side is broadcast is left to
    the planner, which knows the file sizes.
    """
    names = ("events", "customer", "nation", "pages")
    views = {name: table(spark, sf_dir, name) for name in names}
    return spark.sql(LANDING_SQL.replace("from events e", "from {events} e")
                     .replace("join customer c", "join {customer} c")
                     .replace("join nation n", "join {nation} n")
                     .replace("from pages", "from {pages}"), **views)
