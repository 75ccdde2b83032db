"""Reading daily files: headers, encodings, malformed lines, dates."""

import random

import pytest

from scrapeloom.operators import cleaning
from scrapeloom.sources.daily_csv import CONTRACT, ingest, normalise_header

HEADER = ",".join(CONTRACT)


def line(**cells):
    return ",".join(cells.get(c, "") for c in CONTRACT)


@pytest.fixture
def folder(tmp_path):
    def write(name, *lines, encoding="utf-8"):
        (tmp_path / name).write_bytes("\n".join(lines).encode(encoding))

    write.path = str(tmp_path)
    write.dir = tmp_path
    return write


def collect(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_headers_drift_and_lineage(spark, folder):
    folder("scrape_2026-06-01.csv", HEADER, line(scrape_date="2026-06-01", city="Rome"))
    folder(
        "scrape_2026-06-02.csv",
        " Scrape Date ,COMPANY NAME,source_url",
        "2026-06-02,Acme,http://x",
    )
    folder("nodate.csv", HEADER, line(scrape_date="2026-06-03", city="Bonn"))
    folder("note.txt", "not a csv file")
    out = ingest(spark, folder.path)
    assert out.raw.columns == [*CONTRACT, "source_url", "_source_file", "_file_date"]
    assert collect(out.raw, "scrape_date", "company_name", "city", "source_url", "_source_file", "_file_date") == [
        ("2026-06-01", None, "Rome", None, "scrape_2026-06-01.csv", "2026-06-01"),
        ("2026-06-02", "Acme", None, "http://x", "scrape_2026-06-02.csv", "2026-06-02"),
        ("2026-06-03", None, "Bonn", None, "nodate.csv", None),
    ]
    drift = {r[0]: r for r in out.drift.collect()}
    assert set(drift) == {"scrape_2026-06-02.csv"}
    assert drift["scrape_2026-06-02.csv"].extra_columns == ["source_url"]
    assert "phone" in drift["scrape_2026-06-02.csv"].missing_columns


def test_all_values_are_text_and_na_texts_are_null(spark, folder):
    folder(
        "a_2026-06-01.csv",
        HEADER,
        line(scrape_date="2026-06-01", phone="0012", city="NA", country="n/a", email=" NA", website='""'),
        "",
        "   ",
        line(scrape_date="2026-06-01", phone="1e5", city="None", country="-", company_name='"a ""b"", c"'),
    )
    out = ingest(spark, folder.path).raw
    assert {t for _, t in out.dtypes} == {"string"}
    assert collect(out, "phone", "city", "country", "email", "website", "company_name") == [
        ("0012", None, None, " NA", None, None),
        ("1e5", None, "-", None, None, 'a "b", c'),
    ]


def test_encodings(spark, folder):
    folder("a_1.csv", HEADER, line(scrape_date="1", city="Zürich"), encoding="utf-8")
    folder("b_2.csv", HEADER, line(scrape_date="2", city="Orléans"), line(scrape_date="2", city="Rome"), encoding="latin-1")
    folder("c_3.csv", "﻿" + HEADER, line(scrape_date="3", city="Łódź"), encoding="utf-8")
    out = ingest(spark, folder.path)
    assert collect(out.raw, "scrape_date", "city") == [("1", "Zürich"), ("2", "Orléans"), ("2", "Rome"), ("3", "Łódź")]
    assert collect(out.report, "_source_file", "encoding") == [
        ("a_1.csv", "UTF-8"), ("b_2.csv", "ISO-8859-1"), ("c_3.csv", "UTF-8"),
    ]


def test_malformed_lines(spark, folder):
    full = line(scrape_date="2026-06-01", city="Rome", scraped_at="t")
    folder(
        "a_2026-06-01.csv",
        HEADER,
        full,
        full + ",surplus",
        full + ",",
        full + ",x,y,z",
        "2026-06-01,ERP,short",
        line(scrape_date="2026-06-01", company_name='"a,b"', scraped_at="u"),
    )
    out = ingest(spark, folder.path)
    assert collect(out.raw, "category", "company_name", "city", "scraped_at") == [
        ("ERP", "short", None, None), (None, "a,b", None, "u"), (None, None, "Rome", "t"),
    ]
    assert collect(out.quarantine, "line", "_file_date") == sorted(
        (full + tail, "2026-06-01") for tail in (",surplus", ",", ",x,y,z")
    )
    # pruned reads find the same lines
    assert out.raw.select("city").count() == 3
    assert collect(out.report, "status", "row_count", "malformed") == [("ok", 3, 3)]


def test_fields_over_several_lines(spark, folder):
    folder(
        "a_1.csv", HEADER, line(scrape_date="1", company_name='"two\nlines, one name"', city="Rome"),
        line(scrape_date="1", city='5" pipe'),
    )
    folder("b_2.csv", HEADER, line(scrape_date="2", city="Bonn"))
    out = ingest(spark, folder.path)
    assert collect(out.raw, "scrape_date", "company_name", "city") == [
        ("1", "two\nlines, one name", "Rome"), ("1", None, '5" pipe'), ("2", None, "Bonn"),
    ]
    assert collect(out.files, "_source_file", "multi_line") == [("a_1.csv", True), ("b_2.csv", False)]


def test_empty_files_are_reported(spark, folder):
    folder("a_1.csv", HEADER, line(scrape_date="1"))
    folder("b_2.csv", HEADER)
    folder("c_3.csv")
    out = ingest(spark, folder.path)
    assert out.raw.count() == 1
    assert collect(out.report, "_source_file", "status", "row_count") == [
        ("a_1.csv", "ok", 1), ("b_2.csv", "empty", 0), ("c_3.csv", "empty", 0),
    ]


def test_unreadable_file_is_skipped_and_counted(spark, folder):
    import gzip

    good = gzip.compress((HEADER + "\n" + line(scrape_date="1", city="Rome")).encode())
    (folder.dir / "a_1.csv.gz").write_bytes(good)
    (folder.dir / "b_2.csv.gz").write_bytes(good[:12])
    out = ingest(spark, folder.path, pattern="*.csv.gz")
    assert collect(out.raw, "scrape_date", "city") == [("1", "Rome")]
    assert collect(out.report, "_source_file", "status") == [("a_1.csv.gz", "ok"), ("b_2.csv.gz", "failed")]


def many_lines(day, n=300):
    rng = random.Random(day)
    return "\n".join([HEADER, *[line(scrape_date=day, city=f"c{rng.random()}") for _ in range(n)]]).encode()


def test_files_are_taken_whole_or_not_at_all(spark, folder):
    """Streams that are cut, damaged or go on, in all formats whose end can be proven."""
    import bz2
    import gzip
    import zlib

    data = {f"2026-06-{d:02d}": many_lines(f"2026-06-{d:02d}") for d in range(1, 10)}
    days = sorted(data)
    packed = {
        f"a_{days[0]}.csv.gz": gzip.compress(data[days[0]]),
        f"a_{days[1]}.csv.gz": gzip.compress(data[days[1]])[:-900],  # half way
        f"a_{days[2]}.csv.gz": gzip.compress(data[days[2]])[:-4],  # only the length is missing
        f"a_{days[3]}.csv.gz": gzip.compress(data[days[3]][:5000]) + gzip.compress(data[days[3]][5000:]),
        f"a_{days[4]}.csv.bz2": bz2.compress(data[days[4]]),
        f"a_{days[5]}.csv.bz2": bz2.compress(data[days[5]])[:-200],
        f"a_{days[6]}.csv.deflate": zlib.compress(data[days[6]]),
        f"a_{days[7]}.csv": data[days[7]] + b"\n",
        f"a_{days[8]}.csv.gz": b"",
    }
    damaged = bytearray(packed[f"a_{days[0]}.csv.gz"])
    damaged[-6] ^= 255  # the checksum
    packed["b_2026-07-01.csv.gz"] = bytes(damaged)
    for name, content in packed.items():
        (folder.dir / name).write_bytes(content)
    out = ingest(spark, folder.path, pattern="*.csv*")
    counts = {r.scrape_date: r["count"] for r in out.raw.groupBy("scrape_date").count().collect()}
    assert counts == {days[i]: 300 for i in (0, 3, 4, 6, 7)}
    found = {r._source_file[2:12]: (r.status, r.row_count, r.reason) for r in out.report.collect()}
    assert found == {
        **{days[i]: ("ok", 300, None) for i in (0, 3, 4, 6, 7)},
        **{d: ("failed", 0, "broken stream") for d in (days[1], days[2], days[5], "2026-07-01")},
        days[8]: ("empty", 0, None),
    }
    assert out.quarantine.count() == 0


def test_a_file_that_ends_inside_quotes_fails(spark, folder):
    folder("a_1.csv", HEADER, line(scrape_date="1", city="Rome"), line(scrape_date="1", company_name='"never closed'), "more", "lines")
    folder("b_2.csv", HEADER, line(scrape_date="2", company_name='"closed\nlater"'), line(scrape_date="2", city='a "b'))
    out = ingest(spark, folder.path)
    assert collect(out.report, "_source_file", "status", "row_count", "reason") == [
        ("a_1.csv", "failed", 0, "open quote at the end"), ("b_2.csv", "ok", 2, None),
    ]
    assert collect(out.raw, "scrape_date", "company_name", "city") == [("2", "closed\nlater", None), ("2", None, 'a "b')]


def test_carriage_returns_end_lines(spark, folder):
    rows = [HEADER, line(scrape_date="1", city="Rome", scraped_at="x"), line(scrape_date="1", company_name='"a\nb"', scraped_at="y")]
    for i, end in enumerate(["\r\n", "\r"]):
        (folder.dir / f"a_{i}.csv").write_bytes((end.join(rows).replace("\n", end) if end == "\r" else "\r\n".join(rows)).encode() + end.encode())
    out = ingest(spark, folder.path)
    assert collect(out.report, "status", "row_count", "malformed") == [("ok", 2, 0)] * 2
    assert collect(out.raw, "company_name", "city", "scraped_at") == sorted(
        [(None, "Rome", "x"), ("a\nb", None, "y")] * 2, key=str
    )


def records_of(content):
    """Records by a walk over all characters: quotes open a field at its first character only."""
    records, field_start, inside, at = [""], True, False, 0
    while at < len(content):
        c = content[at]
        if inside:
            if c == '"' and content[at + 1 : at + 2] == '"':
                records[-1] += c
                at += 1
            elif c == '"':
                inside = False
        elif c == '"' and field_start:
            inside = True
        if c == "\n" and not inside:
            records.append("")
            field_start = True
        else:
            records[-1] += c
            field_start = not inside and c == ","
        at += 1
    return [r for r in records if r.strip(" ")], inside


@pytest.mark.parametrize("split", [25, 1 << 27])
def test_records_of_split_files_equal_a_walk_over_characters(spark, folder, split):
    """However a file is cut into blocks, and whatever quotes its lines hold."""
    from scrapeloom.sources import daily_csv

    rng, contents = random.Random(11), {}
    for i in range(25):
        body = "".join(rng.choices('ab,"\n ', [6, 6, 5, 2 + i % 5, 3, 1], k=rng.randint(1, 900)))
        contents[f"f_{i}.csv"] = body
        (folder.dir / f"f_{i}.csv").write_text(body)
    settings = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = daily_csv.cut(daily_csv.land_lines(spark.read, folder.path), "lines")
        records, open_ended = daily_csv.to_records(lines)
        found = records.orderBy("_path", "_block_start", "_row_seq").collect()
        still_open = {r[0].split("/")[-1] for r in open_ended.collect()}
        if split < 100:
            assert lines.select("_path", "_block_start").distinct().count() > 2 * len(contents)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 0 < len(still_open) < len(contents)
    for name, body in contents.items():
        expected, inside = records_of(body)
        assert (name in still_open) == inside, name
        if not inside:
            own = [r for r in found if r._path.endswith("/" + name)]
            assert [r.line for r in own] == expected, name
            assert [r.width for r in own] == [len(fields_of(r)) for r in expected], name


def fields_of(record):
    fields, field_start, inside, at = [""], True, False, 0
    while at < len(record):
        c = record[at]
        if inside and c == '"' and record[at + 1 : at + 2] == '"':
            at += 1
        elif inside:
            inside = c != '"'
        elif c == ",":
            fields.append("")
        elif c == '"' and field_start:
            inside = True
        field_start = not inside and c == ","
        at += 1
    return fields


def test_a_file_of_spanning_fields_is_read_by_many_tasks(spark, folder):
    rows = [line(scrape_date="2026-06-01", company_name=f'"two\nlines {i}"', city=str(i)) for i in range(1000)]
    folder("a_2026-06-01.csv", HEADER, *rows)
    size = (folder.dir / "a_2026-06-01.csv").stat().st_size
    settings = {"spark.sql.files.maxPartitionBytes": str(size // 7), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        raw = ingest(spark, folder.path, row_order=True).raw
        found = raw.orderBy("_block_start", "_row_seq").select("company_name", "city", "_block_start").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r[:2] for r in found] == [(f"two\nlines {i}", str(i)) for i in range(1000)]
    assert len({r._block_start for r in found}) >= 7


def test_date_fallback_only_for_wholly_undated_files(spark, folder):
    folder("a_2026-06-01.csv", HEADER, line(city="Rome"), line(city="Bonn"))
    folder("b_2026-06-02.csv", HEADER, line(scrape_date="2026-06-05"), line(city="Oslo"))
    folder("c_2026-06-03.csv", "city,phone", "Bern,1")
    folder("d.csv", "city,phone", "Kiel,1")
    raw = ingest(spark, folder.path).raw
    assert collect(raw, "city", "scrape_date") == [
        ("Bern", "2026-06-03"), ("Bonn", "2026-06-01"), ("Kiel", None), ("Oslo", None),
        ("Rome", "2026-06-01"), (None, "2026-06-05"),
    ]


def test_row_order_follows_the_file(spark, folder):
    folder("a_1.csv", HEADER, *[line(scrape_date="1", city=f"c{i:03d}") for i in range(200)])
    raw = ingest(spark, folder.path, row_order=True).raw
    ordered = raw.orderBy("_source_file", "_block_start", "_row_seq").select("city").collect()
    assert [r[0] for r in ordered] == [f"c{i:03d}" for i in range(200)]


def test_unusual_file_names(spark, folder):
    folder("a b_+%é 1.csv", HEADER, line(scrape_date="1"))
    raw = ingest(spark, folder.path).raw
    assert collect(raw, "_source_file", "_file_date") == [("a b_+%é 1.csv", "+%é 1")]


def test_missing_input(spark, folder):
    with pytest.raises(FileNotFoundError):
        ingest(spark, folder.path)
    folder("a_1.csv")
    with pytest.raises(ValueError):
        ingest(spark, folder.path)


def test_repeated_header_names():
    assert normalise_header(["City", " city ", "", "x"]) == ["city", "city.1", "unnamed:_2", "x"]


def test_extra_columns_of_any_name_are_kept(spark, tmp_path):
    header = ",".join([*CONTRACT, "_vendor_id", "No. of offices", "phone", "_uri"])
    (tmp_path / "scrape_2026-06-01.csv").write_text(header + "\n" + ",".join(f"v{i}" for i in range(14)) + "\n")
    raw = ingest(spark, str(tmp_path)).raw
    row = cleaning.clean_scrape(raw).first().asDict()
    assert [row[c] for c in ("_vendor_id", "no._of_offices", "phone.1", "_uri.1")] == ["v10", "v11", "v12", "v13"]
