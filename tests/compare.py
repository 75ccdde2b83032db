"""Run a registered query and its checking SQL side by side."""

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def open_tables(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(round(value, 6))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return repr(value)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(_cell(r[c]) for c in columns) for r in df.collect())


def sql_rows(con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(_cell(r[i]) for i in order) for r in found.fetchall())
    return [names[i] for i in order], rows
