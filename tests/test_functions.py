"""Single-value rules, each as one DataFrame."""

import random
import re

import pytest
from pyspark.sql import functions as F

from scrapeloom.functions import contact, dates, text
from scrapeloom.functions.similarity import similarity_ratio


def apply(spark, values, *columns):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", *columns).orderBy("i")
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in df.collect()]


PHONES = {
    "4045550182": "4045550182",
    "+1 404 555 0182": "4045550182",
    "14045550182": "4045550182",
    "04045550182": "4045550182",
    "(404)5550182": "4045550182",
    "404/555/0182": "4045550182",
    "404-555-0182 ext 77": "4045550182",
    "404-555-0182 Ext. 7 or 8": "4045550182",
    "8325162691 x 123": "8325162691",
    "8325162691#4": "8325162691",
    "8325162691 box 4": "8325162691",
    "8325162691 ext.12 ext.13": "8325162691",
    "1234567890": "1234567890",
    "12": None,
    "12345": None,
    "123456789012345": None,
    "8325162691x123": None,
    "8325162691 x123": None,
    "8325162691 extension 12": None,
    "8325162691 ext: 12": None,
    "fax 8325162691": None,
    "#8325162691": None,
    "0832516269": None,
    "001 832 516 2691": None,
    "+44 20 7946 0958": None,
    "10123456789": "0123456789",
}
NULLS = [None, "", "nan", " NaN ", "None", "NULL", "n/a", "NA", "nil", "-", "  ", "\t- "]


def test_phone(spark):
    clean = contact.clean_phone("v")
    got = apply(spark, PHONES, clean, contact.phone_flag("v", clean))
    assert got == [(p, "ok" if p else "invalid") for p in PHONES.values()]
    assert set(apply(spark, NULLS, clean, contact.phone_flag("v", clean))) == {(None, "null")}


def test_phone_with_extended_extensions(spark):
    values = ["8325162691x123", "8325162691 x123", "8325162691 extension 12", "8325162691 ext: 12"]
    assert set(apply(spark, values, contact.clean_phone("v", True))) == {"8325162691"}


def test_phone_rule_on_random_digit_texts(spark):
    rng = random.Random(7)
    values = [
        "".join(rng.choice("01123456789 -().+") for _ in range(rng.randint(8, 15))) for _ in range(2000)
    ]

    def rule(value):
        digits = re.sub("[^0-9]", "", value)
        if digits[:1] == "0" or (digits[:1] == "1" and len(digits) == 11):
            digits = digits[1:]
        return digits if len(digits) == 10 else None

    assert apply(spark, values, contact.clean_phone("v")) == [rule(v) for v in values]


def test_category(spark):
    cases = {
        **{label: label for label in sorted(set(contact.CATEGORY_LABELS.values()))},
        **dict(contact.CATEGORY_LABELS), "\tHR  ": "HR", "Medical\n": "Medical",
        "Plumbing": "Unknown", "medical": "Unknown", "E R P": "Unknown",
    }
    assert apply(spark, cases, contact.clean_category("v")) == list(cases.values())
    assert set(apply(spark, NULLS, contact.clean_category("v"))) == {None}
    custom = contact.clean_category("v", {"a": "A"})
    assert apply(spark, ["a", "ERP"], custom) == ["A", "Unknown"]


def test_email(spark):
    cases = {
        "A@B.Com": ("a@b.com", "ok"), " x@y.z ": ("x@y.z", "ok"),
        "bad": ("bad", "invalid"), "a@b": ("a@b", "invalid"), "a.b": ("a.b", "invalid"),
        "N/A": (None, "null"),
    }
    got = apply(spark, cases, contact.clean_email("v"), contact.email_flag("v"))
    assert got == list(cases.values())


def test_website_and_host(spark):
    cases = {
        "http://harbor.example/": "harbor.example",
        "https://www.harbor.example?q=1#top": "harbor.example?q=1#top",
        "HTTPS://Www.Harbor.Example:443/a:b": "harbor.example",
        "www.harbor.example:8080": "harbor.example",
        "sub.harbor.example/x/y": "sub.harbor.example",
        "http://www.": None, "https://": None, "": None, None: None,
        "http://www.www.a.b/x:1": "www.a.b",
    }
    assert apply(spark, cases, contact.site_host("v")) == list(cases.values())
    assert apply(spark, [" HTTP://A.b ", "nan", None], contact.clean_website("v")) == ["http://a.b", None, None]
    keys = ["https://www.A.io:80/x", "www.b.c", "http://http://x"]
    assert apply(spark, keys, contact.site_key("v")) == ["a.io:80/x", "b.c", "http://x"]


def test_normalise_name(spark):
    cases = {
        " Acme,  Legal-Co. ": "acme legalco", None: "", "!!!": "", "A_b C": "a_b c",
        "Été & Co": "été co", "x² – y": "x² y", "! Acme": " acme",
    }
    assert apply(spark, cases, text.normalise_name("v")) == list(cases.values())


def test_null_like_and_csv_tokens(spark):
    assert all(apply(spark, NULLS, text.is_null_like("v")))
    assert not any(apply(spark, ["0", "nano", "--", "n.a"], text.is_null_like("v")))
    values = ["NA", " NA", "na", "null", "NULL", "", "x"]
    assert apply(spark, values, text.null_csv_na("v")) == [None, " NA", "na", None, None, None, "x"]
    assert apply(spark, ["", "  ", None, "\t", "a"], text.is_blank("v")) == [True, True, True, False, False]


def test_city_placeholders_are_case_sensitive(spark):
    values = ["-", "NaN", "none", "null", "n/a", "", " - ", "None", "nan", "Rome"]
    assert apply(spark, values, text.known_city("v")) == [None] * 7 + ["None", "nan", "Rome"]


def test_file_dates(spark):
    cases = {
        "scrape_2026-06-01.csv": "2026-06-01", "2026-06-01.csv": None, "a_b_c.csv": "b_c",
        "x_.csv": "", "a_b.c.csv": "b.c",
    }
    assert apply(spark, cases, dates.date_from_file_name("v")) == list(cases.values())


def test_date_parts(spark):
    values = ["2026-06-07", "2026-06-08", "2026-13-01", "x", None]
    day = dates.iso_date("v")
    got = apply(spark, values, day.cast("string"), dates.week_start(day), dates.sunday_based_weekday(day))
    assert got == [("2026-06-07", "2026-06-01", 0), ("2026-06-08", "2026-06-08", 1)] + [(None,) * 3] * 3
    odd = ["2026-06-07", "2026-6-7", "x", None]
    assert apply(spark, odd, dates.odd_date("v")) == [None, "2026-6-7", "x", None]


def test_percentages(spark):
    df = spark.createDataFrame([(110, 100), (0, 110), (5, 0), (1, None)], "a long, b long")
    got = [r[0] for r in df.select(dates.percent_change("a", "b")).collect()]
    assert got == [10.0, -100.0, None, None]
    shares = df.select(dates.percent_share("a", F.lit(400), 1)).collect()
    assert [r[0] for r in shares] == [27.5, 0.0, 1.3, 0.3]


@pytest.mark.parametrize(
    "later, earlier, ratio", [("acme legall", "acme legal", 20 / 21), ("", "", 1.0), ("ab", "ba", 0.5)]
)
def test_similarity(spark, later, earlier, ratio):
    df = spark.createDataFrame([(later, earlier)], "a string, b string")
    assert df.select(similarity_ratio("a", "b")).first()[0] == pytest.approx(ratio)
