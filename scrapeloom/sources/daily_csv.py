"""Daily CSV exports to the raw table, each file whole or not at all.

The files are read once, as lines, by as many tasks as they have blocks, and landed
together with what each line says about its file: bytes, encoding and quotes. Lines
become records, files are admitted, and only then are cells parsed.

A quoted field may span lines, so whether a line begins a record depends on all lines
before it. Each line maps the state it is entered in (outside or inside quotes) to the
one it leaves. Such maps compose, so a running composition within each block and one
over the few blocks of a file give the state everywhere, without any task reading a
whole file.

A file is admitted if the lines read account for all its bytes, its compressed stream
(if it is one) ends as it should, and no quoted field is open at its end. Nothing of
any other file gets into the raw table. Only file names and headers reach the driver.
"""

from __future__ import annotations

import bz2
import csv
import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, text
from ..session import cut

# The documented columns of a daily export.
CONTRACT = (
    "scrape_date", "category", "company_name", "phone", "email", "website",
    "employee_count", "city", "country", "scraped_at",
)
LINEAGE = ("_source_file", "_file_date")
ROW_ORDER = ("_block_start", "_row_seq")
# Columns the ingest adds while it reads; a file's own column of such a name is numbered.
INTERNAL = (*LINEAGE, *ROW_ORDER, "_malformed", "_path", "_uri", "_record", "_cells")
# Endings of compressed files, and the streams their proof can read.
GZIP, DEFLATE, BZIP2 = "gz", "deflate", "bz2"
UNPROVEN = ("zst", "lz4", "snappy")  # compressed too, but admitted without proof


def normalise_header(cells: Sequence[str]) -> list[str]:
    """Column names: trimmed, lower case, blanks to underscores, repeats numbered.

    Names that the ingest uses itself are numbered like repeats, so no column is lost.
    """
    names: list[str] = []
    for position, cell in enumerate(cells):
        raw = cell.lstrip("﻿")
        name = raw.strip().lower().replace(" ", "_") or f"unnamed:_{position}"
        repeat, unique = 0, name
        while unique in names or unique in INTERNAL:
            repeat += 1
            unique = f"{name}.{repeat}"
        names.append(unique)
    return names


def _decoded(uri: str) -> Column:
    """Path or name without URI escapes; most have none."""
    c = F.col(uri)
    return F.when(c.contains("%"), F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))).otherwise(c)


def _path(uri: str) -> Column:
    """Path to read from, in the one spelling used as key. Not for single rows."""
    return F.regexp_replace(_decoded(uri), "^file:/+", "file:/").alias("_path")


def file_name() -> Column:
    """Name of the file a row was read from."""
    return _decoded("_metadata.file_name")


def day_folder_name(prefix: str = "scrape_") -> Column:
    """Daily file name for days that arrive in parts, as ``.../day=<date>/<part>.csv``."""
    day = F.split_part(F.split_part("_metadata.file_path", F.lit("/day="), F.lit(-1)), F.lit("/"), F.lit(1))
    return F.concat(F.lit(prefix), day, F.lit(".csv"))


def _lineage(source_name: Column) -> list[Column]:
    return [
        source_name.alias("_source_file"),
        dates.date_from_file_name(source_name).alias("_file_date"),
    ]


def list_files(reader: DataFrameReader, folder: str, source_name: Column) -> DataFrame:
    """Path, name, date and size of each file; file contents are not read.

    The paths come from the reader's own listing, as a scan leaves out files
    without content.
    """
    found = reader.format("binaryFile").load(folder)
    spark = found.sparkSession
    paths = spark.createDataFrame([(p,) for p in found.inputFiles()], "path string")
    name = F.element_at(F.split("path", "/"), -1)
    metadata = F.struct(F.col("path").alias("file_path"), name.alias("file_name"))
    listed = paths.select(metadata.alias("_metadata")).select(
        _path("_metadata.file_path"), *_lineage(source_name)
    )
    sizes = found.select(_path("_metadata.file_path"), F.col("length").alias("bytes"))
    return listed.join(sizes, "_path", "left").fillna(0, ["bytes"])


def unpacked_length(content: bytes, kind: str) -> int | None:
    """Bytes in a compressed file, or None if its stream is broken or does not end."""
    length = 0
    while True:
        stream = bz2.BZ2Decompressor() if kind == BZIP2 else zlib.decompressobj(31 if kind == GZIP else 15)
        try:
            for at in range(0, len(content), 1 << 16):
                data, most = content[at : at + (1 << 16)], 1 << 20
                while data and not stream.eof:
                    out = stream.decompress(data, most)
                    length += len(out)
                    data = b"" if kind == BZIP2 else stream.unconsumed_tail
                    while kind == BZIP2 and not stream.needs_input and not stream.eof:
                        length += len(stream.decompress(b"", most))
                if stream.eof:
                    break
        except (OSError, zlib.error, EOFError):
            return None
        if not stream.eof:
            return None
        rest = len(stream.unused_data) + max(0, len(content) - at - (1 << 16))
        content = content[len(content) - rest :]
        if not content.strip(b"\0\n"):  # padding may follow the last stream
            return length


def unpacked_lengths(reader: DataFrameReader, folder: str) -> DataFrame:
    """``_path, unpacked`` of the compressed files whose streams can be proven; null if broken.

    A task holds one compressed file, or several small ones up to the size of a scan split.
    """

    def work(batches):
        for batch in batches:
            lengths = [
                unpacked_length(content.as_py(), kind.as_py())
                for content, kind in zip(batch.column("content"), batch.column("kind"))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("_path"), pa.array(lengths, pa.int64())], ["_path", "unpacked"])

    files = reader.format("binaryFile").load(folder).withColumn("kind", F.element_at(F.split("path", r"\."), -1))
    packed = files.where(F.col("kind").isin(GZIP, DEFLATE, BZIP2)).select(_path("path"), "kind", "content")
    return packed.mapInArrow(work, "_path string, unpacked bigint")


def _step(state: Column, chunk: Column) -> Column:
    """State after one text between commas: 1 inside a quoted field, 0 outside.

    A quote opens a field only as its first character, and an odd run of quotes closes it;
    what follows up to the comma is plain text.
    """
    opens = (state == 0) & chunk.startswith('"')
    inside = F.when(opens, F.substring(chunk, 2, 1 << 30)).otherwise(chunk)
    closes = inside.rlike('(?:^|[^"])"(?:"")*(?:[^"]|$)')
    return F.when((opens | (state == 1)) & ~closes, 1).otherwise(0)


def _leaves(text: str | Column, entered: int) -> Column:
    """State in which a text with quotes is left when it is entered in the given one."""
    return F.aggregate(F.split(text, ","), F.lit(entered), _step)


def _width(text: str) -> Column:
    """Fields of a record: one more than the commas outside quotes."""
    start = F.struct(F.lit(0).alias("state"), F.lit(0).alias("n"))
    walked = F.aggregate(
        F.split(text, ","),
        start,
        lambda a, c: F.struct(
            _step(a["state"], c).alias("state"), (a["n"] + F.when(a["state"] == 0, 1).otherwise(0)).alias("n")
        ),
    )
    plain = F.length(text) - F.length(F.replace(F.col(text), F.lit(","))) + 1
    return F.when(F.col(text).contains('"'), walked["n"]).otherwise(plain)


def land_lines(reader: DataFrameReader, folder: str) -> DataFrame:
    """All lines as written text, with their place and what they say about their file.

    Carriage returns end lines too. Lines that are not UTF-8 are shown as Latin-1; the
    bytes count all there is to a line.
    """
    raw = reader.option("ignoreCorruptFiles", True).option("lineSep", "\n").text(folder)
    utf8 = F.is_valid_utf8("value")
    shown = F.when(utf8, F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    lines = raw.select(
        _path("_metadata.file_path"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        (F.octet_length("value") + 1).alias("octets"),
        utf8.alias("utf8"),
        shown.alias("line"),
    )
    whole = F.array("line")
    parts = F.split(F.regexp_replace("line", "\r$", ""), "\r")
    lines = lines.select("_path", "_block_start", "octets", "utf8", F.posexplode(F.when(F.col("line").contains("\r"), parts).otherwise(whole)).alias("part", "line"))
    quoted = F.col("line").contains('"')
    return lines.select(
        "_path",
        "_block_start",
        F.monotonically_increasing_id().alias("_row_seq"),
        F.when(F.col("part") == 0, F.col("octets")).otherwise(0).alias("octets"),
        "utf8",
        (F.trim("line") == "").alias("blank"),
        F.when(quoted, _leaves("line", 0)).otherwise(0).alias("from_outside"),
        F.when(quoted, _leaves("line", 1)).otherwise(1).alias("from_inside"),
        _width("line").alias("width"),
        "line",
    )


def _composed(order: str, parts: list[str], outside: Column, inside: Column) -> tuple[Column, Column]:
    """Running composition of the maps up to each row: (swaps, fixed).

    The state after a row is ``fixed`` if any map so far ignores the state it is
    entered in, else the state at the beginning, and in both cases turned over as often as ``swaps`` says.
    """
    so_far = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum(F.when((outside == 1) & (inside == 0), 1).otherwise(0)).over(so_far) % 2
    fixed = F.last(F.when(outside == inside, outside.cast("bigint").bitwiseXOR(swaps)), ignorenulls=True).over(so_far)
    return swaps, fixed


def _record_places(spanning: DataFrame) -> DataFrame:
    """The lines of files with spanning fields, with the place of the record each belongs to.

    ``closed`` tells whether the line ends outside quotes; a line that begins a record
    has its own place.
    """
    outside, inside = F.col("from_outside"), F.col("from_inside")
    swaps, fixed = _composed("_row_seq", ["_path", "_block_start"], outside, inside)
    marked = cut(spanning.withColumns({"swaps": swaps, "fixed": fixed}), "quotes")
    # one row per block: its map, and the state in which it is entered
    last = F.max_by(F.struct("swaps", "fixed"), "_row_seq")
    blocks = marked.groupBy("_path", "_block_start").agg(last.alias("end"))
    turned = F.col("end.swaps").cast("bigint")
    blocks = blocks.withColumns(
        {
            "out": F.coalesce("end.fixed", F.lit(0)).bitwiseXOR(turned),
            "in": F.coalesce("end.fixed", F.lit(1)).bitwiseXOR(turned),
        }
    )
    swaps, fixed = _composed("_block_start", ["_path"], F.col("out"), F.col("in"))
    blocks = blocks.withColumns({"swaps": swaps, "fixed": fixed})
    after = F.coalesce("fixed", F.lit(0)).bitwiseXOR(F.col("swaps"))
    by_file = Window.partitionBy("_path").orderBy("_block_start")
    entered = F.coalesce(F.lag(after).over(by_file), F.lit(0))
    blocks = blocks.select("_path", "_block_start", entered.alias("entered"))

    by_block = Window.partitionBy("_path", "_block_start").orderBy("_row_seq")
    before = F.coalesce(F.lag("fixed").over(by_block), F.col("entered")).bitwiseXOR(
        F.coalesce(F.lag("swaps").over(by_block), F.lit(0))
    )
    lines = marked.join(cut(blocks, "blocks"), ["_path", "_block_start"]).withColumn("before", before)
    lines = lines.withColumn("closed", F.when(F.col("before") == 0, outside).otherwise(inside) == 0)
    so_far = by_block.rowsBetween(Window.unboundedPreceding, 0)
    begins = F.when(F.col("before") == 0, F.col("_row_seq"))
    lines = cut(lines.withColumn("record", F.last(begins, ignorenulls=True).over(so_far)), "records")
    # a record that goes on into a block began in the last block before in which one begins
    starts = lines.groupBy("_path", "_block_start").agg(F.max("record").alias("record"))
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(F.col("_block_start").alias("block"), F.col("record").alias("seq"))
    starts = starts.select(
        "_path",
        "_block_start",
        F.last(F.when(F.col("record").isNotNull(), place), ignorenulls=True).over(earlier).alias("carried"),
    )
    own = F.when(F.col("record").isNotNull(), F.struct(F.col("_block_start").alias("block"), F.col("record").alias("seq")))
    return lines.join(cut(starts, "carried"), ["_path", "_block_start"]).withColumn("place", F.coalesce(own, "carried"))


def to_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (``_path, _block_start, _row_seq, utf8, line, width``) and the files that end inside quotes.

    Lines that are records by themselves pass as they are; only those of spanning
    fields are put together. Blank lines between records are dropped.
    """
    columns = ["_path", "_block_start", "_row_seq", "utf8", "line", "width"]
    spanning = cut(lines.where("from_outside = 1").select("_path").distinct(), "spanning")
    plain = lines.join(spanning, "_path", "left_anti")
    if spanning.isEmpty():
        return plain.where("not blank").select(*columns), spanning
    placed = _record_places(lines.join(spanning, "_path", "left_semi"))
    ends = placed.groupBy("_path").agg(F.max_by("closed", F.struct("_block_start", "_row_seq")).alias("closed"))
    whole = placed.where("before = 0 and closed and not blank")
    pieces = F.array_sort(F.collect_list(F.struct("_block_start", "_row_seq", "line")))
    joined = (
        placed.join(ends.where("closed").select("_path"), "_path", "left_semi")
        .where("before = 1 or not closed")
        .groupBy("_path", "place")
        .agg(pieces.alias("pieces"), F.min("utf8").alias("utf8"))
        .select(
            "_path",
            F.col("place.block").alias("_block_start"),
            F.col("place.seq").alias("_row_seq"),
            "utf8",
            F.array_join(F.col("pieces.line"), "\n").alias("line"),
        )
    )
    joined = cut(joined.withColumn("width", _width("line")), "spanned")
    records = plain.where("not blank").select(*columns).unionByName(whole.select(*columns)).unionByName(joined.select(*columns))
    return records, ends.where("not closed").select("_path")


def inspect_files(listing: DataFrame, lines: DataFrame, unpacked: DataFrame, open_ended: DataFrame) -> DataFrame:
    """The listing with the outcome for each file: ``reason`` it is refused for, if any,
    ``encoding``, ``multi_line``, and the place of its header."""
    per_block = lines.groupBy("_path", "_block_start").agg(
        F.sum("octets").alias("octets"),
        F.min("utf8").alias("utf8"),
        F.max("from_outside").alias("spans"),
        F.min(F.when(~F.col("blank"), F.col("_row_seq"))).alias("first"),
    )
    place = F.struct(F.col("_block_start").alias("block"), F.col("first").alias("seq"))
    seen = per_block.groupBy("_path").agg(
        F.sum("octets").alias("octets"),
        F.min("utf8").alias("utf8"),
        (F.max("spans") == 1).alias("multi_line"),
        F.min(F.when(F.col("first").isNotNull(), place)).alias("header_place"),
    )
    ending = F.element_at(F.split("_path", r"\."), -1)
    packed = ending.isin(GZIP, DEFLATE, BZIP2)
    read = F.coalesce("octets", F.lit(0))
    due = F.when(packed, F.col("unpacked")).when(ending.isin(*UNPROVEN) & (read > 0), read).otherwise(F.col("bytes"))
    # the last line may lack its end, and the scan leaves out a byte order mark
    complete = (read - due).isin(0, 1, -3, -2)
    reason = (
        F.when(packed & F.col("unpacked").isNull() & (F.col("bytes") > 0), "broken stream")
        .when((F.col("bytes") > 0) & ~complete, "cut short")
        .when(F.col("open").isNotNull(), "open quote at the end")
    )
    return (
        listing.join(seen, "_path", "left")
        .join(unpacked, "_path", "left")
        .join(open_ended.withColumn("open", F.lit(True)), "_path", "left")
        .select(
            *listing.columns,
            reason.alias("reason"),
            F.when(F.col("utf8"), "UTF-8").when(~F.col("utf8"), "ISO-8859-1").alias("encoding"),
            F.coalesce("multi_line", F.lit(False)).alias("multi_line"),
            "header_place",
        )
    )


def _decoded_line() -> Column:
    """A record's text in its file's encoding; lines that look like UTF-8 may stand in a Latin-1 file."""
    again = F.decode(F.col("line").cast("binary"), "ISO-8859-1")
    return F.when((F.col("encoding") == "ISO-8859-1") & F.col("utf8"), again).otherwise(F.col("line"))


def _with_headers(spark: SparkSession, files: DataFrame, records: DataFrame) -> DataFrame:
    """``files`` with ``header`` and its ``columns``; distinct headers reach the driver."""
    headers = files.where(F.col("reason").isNull() & F.col("header_place").isNotNull())
    headers = headers.select("_path", "encoding", F.col("header_place.block").alias("_block_start"), F.col("header_place.seq").alias("_row_seq"))
    found = cut(
        records.join(headers, ["_path", "_block_start", "_row_seq"]).select("_path", _decoded_line().alias("header")),
        "headers",
    )
    named = [(r.header, normalise_header(next(csv.reader([r.header])))) for r in found.select("header").distinct().toLocalIterator()]
    columns = spark.createDataFrame(named, "header string, columns array<string>")
    return files.join(found.join(columns, "header"), "_path", "left")


def apply_date_fallback(rows: DataFrame, file_key: str = "_source_file") -> DataFrame:
    """Fill ``scrape_date`` from the file name in files where no row has one.

    One small aggregate per file is joined back, instead of a window that would
    bring all rows of a file into one task.
    """
    undated = (
        rows.groupBy(file_key, F.col("_file_date").alias("_fallback"))
        .agg(F.count("scrape_date").alias("dated"))
        .where((F.col("dated") == 0) & (F.coalesce("_fallback", F.lit("")) != ""))
        .select(file_key, "_fallback")
    )
    filled = rows.join(cut(undated, "undated"), file_key, "left")
    return filled.withColumn("scrape_date", F.coalesce("scrape_date", "_fallback")).select(
        *text.quoted(rows.columns)
    )


class Ingest:
    """Outcome of reading a folder of daily files.

    ``raw`` is the raw table, ``quarantine`` the malformed lines, ``drift`` the
    columns that files lack or add, and ``report`` one line per file.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        pattern: str = "*.csv",
        row_order: bool = False,
        recursive: bool = False,
        source_name: Column | None = None,
    ):
        def reader() -> DataFrameReader:
            return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)

        source_name = file_name() if source_name is None else source_name
        listing = cut(list_files(reader(), folder, source_name), "files")
        if listing.isEmpty():
            raise FileNotFoundError(f"no {pattern} files in {folder}")
        lines = cut(land_lines(reader(), folder), "lines")
        records, open_ended = to_records(lines)
        unpacked = unpacked_lengths(reader(), folder)
        files = cut(inspect_files(listing, lines, unpacked, open_ended), "files")
        self.files = cut(_with_headers(spark, files, records), "files")
        admitted = self.files.where("columns is not null")
        if admitted.isEmpty():
            raise ValueError(f"no {pattern} file in {folder} has any content")
        # the header is a record of its own; a record with too many fields is malformed
        place = F.struct(F.col("_block_start").alias("block"), F.col("_row_seq").alias("seq"))
        rows = records.join(admitted.select("_path", *LINEAGE, "encoding", "columns", "header_place"), "_path")
        self._records = rows.where(place != F.col("header_place")).withColumn(
            "_malformed", F.col("width") > F.size("columns")
        )
        widths = admitted.agg(F.max(F.size("columns")), F.array_distinct(F.flatten(F.collect_set("columns")))).first()
        extra = sorted(c for c in widths[1] if c not in CONTRACT)
        self.raw = apply_date_fallback(self._parsed(widths[0], [*CONTRACT, *extra], row_order))
        self.quarantine = self._records.where("_malformed").select(_decoded_line().alias("line"), *LINEAGE)

    def _parsed(self, width: int, names: list[str], row_order: bool) -> DataFrame:
        """The cells of the good records by column name, parsed in one pass whatever their headers are."""
        schema = ", ".join(f"c{i} string" for i in range(width))
        options = {"mode": "PERMISSIVE", "escape": '"', "maxCharsPerColumn": "-1", "maxColumns": str(max(20480, width))}
        good = self._records.where("not _malformed").withColumn("_cells", F.from_csv(_decoded_line(), schema, options))
        good = good.withColumn("_cells", F.array(*[text.null_csv_na(F.col(f"_cells.c{i}")) for i in range(width)]))
        cells = [F.get("_cells", F.array_position("columns", name).cast("int") - 1).alias(name) for name in names]
        return good.select(*cells, *LINEAGE, *(ROW_ORDER if row_order else ()))

    @property
    def drift(self) -> DataFrame:
        """Unexpected and missing columns per admitted file that has either."""
        contract = F.array(*[F.lit(c) for c in CONTRACT])
        return (
            self.files.where("columns is not null")
            .select(
                "_source_file",
                F.array_sort(F.array_except("columns", contract)).alias("extra_columns"),
                F.array_sort(F.array_except(contract, "columns")).alias("missing_columns"),
            )
            .where("size(extra_columns) > 0 or size(missing_columns) > 0")
        )

    @property
    def report(self) -> DataFrame:
        """Per file: status (ok, empty, failed), encoding, rows, malformed lines, and why it failed."""
        rows = self._records.groupBy("_path").agg(
            F.count_if(~F.col("_malformed")).alias("row_count"), F.count_if("_malformed").alias("malformed")
        )
        none = F.coalesce("row_count", F.lit(0)) == 0
        return self.files.join(rows, "_path", "left").select(
            *LINEAGE,
            F.when(F.col("reason").isNotNull(), "failed").when(none, "empty").otherwise("ok").alias("status"),
            "encoding",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.coalesce("malformed", F.lit(0)).alias("malformed"),
            "reason",
        )


def ingest(spark: SparkSession, folder: str, **options) -> Ingest:
    """Read a folder of daily files.

    ``pattern`` selects file names; ``row_order`` keeps the position of each row
    (needed to resolve names in order of appearance); ``recursive`` looks into
    subfolders; ``source_name`` tells the daily file from the file metadata where
    a day arrives in several parts.
    """
    return Ingest(spark, folder, **options)
