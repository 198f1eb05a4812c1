"""Readers of the shapes that public series and prose come in. Schemas are given, never inferred; what can't be read is counted, not lost."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import number_or_null
from tidemark.sources import archives

BAD = "_bad_row"


def _with_bad(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])


def csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True, newlines: bool = False) -> DataFrame:
    """CSV, gzipped or not; columns are named as in the schema, lower case. Rows that don't fit have `_bad_row` filled and are for the caller to count (`bad_rows`) or drop.

    newlines: quoted cells may hold them, which makes each file one task; without, plain files are split among tasks.
    """
    out = spark.read.csv(path, schema=_with_bad(schema), sep=sep, header=header, multiLine=newlines, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=BAD, enforceSchema=True)
    return out.toDF(*[c if c == BAD else c.strip().lower() for c in out.columns])


def bad_rows(rows: DataFrame) -> DataFrame:
    """How many rows there are (n), how many don't fit the schema (n_bad), and how many hold nothing that could be read (n_empty). One pass."""
    empty = F.coalesce(*[F.col(c).cast("string") for c in rows.columns if c != BAD]).isNull()
    return rows.agg(F.count("*").alias("n"), F.count(BAD).alias("n_bad"), F.count_if(empty).alias("n_empty"))


def csv_after_preamble(spark: SparkSession, path: str, schema: T.StructType, starts: str) -> DataFrame:
    """CSV whose header follows other lines: the lines before the one that begins with `starts`, and that one, are left out by a comparison with its place in the file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"))
    head = lines.where(F.startswith("value", F.lit(starts))).groupBy("file").agg(F.min("n").alias("head"))
    body = lines.join(head, "file").where("n > head and value <> ''")
    return body.select("file", F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), {"mode": "PERMISSIVE"}).alias("r")).select("file", "r.*")


def keyed_csvs(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """One table of a folder with a file per key; the key is the file's name. Cells that are no numbers are null."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.csv(folder, schema=text, header=True)
    key = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1)
    return raw.select(F.upper(key).alias("key"), *[number_or_null(F.col(f.name)).cast(f.dataType).alias(f.name) if isinstance(f.dataType, T.NumericType) else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def last_wins(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key in file order."""
    values = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*values), order).alias("_r")).select(*key, "_r.*")


def zipped_lines(spark: SparkSession, path: str | list[str], wanted: str = r".*", contains: str | None = None) -> DataFrame:
    """Lines (archive, member, n, line) of members of zip files, below folders too; `contains` drops lines before they leave the task. Each member is read by itself."""
    return archives.lines(archives.members(archives.listed(spark, path), wanted), contains)


def json_points(df: DataFrame, column: str, sentinel: float) -> DataFrame:
    """value.timeSeries[].values[].value[] of nested JSON as points: site, ts (UTC, no zone), value; sentinels are null."""
    schema = "value struct<timeSeries:array<struct<name:string,values:array<struct<value:array<struct<value:string,dateTime:string>>>>>>>"
    series = df.select(F.explode(F.from_json(column, schema)["value"]["timeSeries"]).alias("s"))
    points = series.select(F.col("s.name").alias("site"), F.explode("s.values").alias("v")).select("site", F.explode("v.value").alias("p"))
    value = F.col("p.value").try_cast("double")
    ts = F.to_utc_timestamp(F.try_to_timestamp(F.col("p.dateTime")), F.current_timezone()).cast("timestamp_ntz")
    return points.select("site", ts.alias("ts"), F.when(value != sentinel, value).alias("value"))


def sdmx_observations(df: DataFrame, column: str) -> DataFrame:
    """Observations of one-dimensional SDMX-JSON: period id by its place in the structure, and the first value of each observation."""
    schema = "data struct<structures:array<struct<dimensions:struct<observation:array<struct<values:array<struct<id:string>>>>>>>,dataSets:array<struct<series:map<string,struct<observations:map<string,array<double>>>>>>>"
    d = df.select(F.from_json(column, schema)["data"].alias("d"))
    periods = F.col("d.structures")[0]["dimensions"]["observation"][0]["values"]
    series = d.select(periods.alias("periods"), F.explode(F.col("d.dataSets")[0]["series"]).alias("series", "body"))
    points = series.select("periods", "series", F.explode("body.observations").alias("at", "v"))
    return points.select("series", F.get("periods", F.col("at").cast("int"))["id"].alias("period"), F.get("v", F.lit(0)).alias("value"))


def header_details(lines: DataFrame, order: str, header: str) -> DataFrame:
    """Lines with the header that they stand under: `group` is the last header's first field. Lines of one file are in order."""
    is_head = F.col("value").rlike(header)
    w = Window.partitionBy("file").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = lines.withColumn("group", F.last(F.when(is_head, F.trim(F.split("value", ",")[0])), ignorenulls=True).over(w))
    return out.where(~is_head)


def wide_to_long(rows: DataFrame, cells: str, order: str, header_rows: int, sheet: list[str]) -> DataFrame:
    """Sheets, known by the columns `sheet`, of arrays of cells whose first rows are headers: sheet, period, each column's headers and values that are numbers. Headers are joined by sheet and column number; rows of one sheet are numbered together."""
    n = F.row_number().over(Window.partitionBy(*sheet).orderBy(order)) - 1
    numbered = rows.withColumn("r", n).select(*sheet, "r", F.posexplode(cells).alias("c", "cell"))
    heads = numbered.where(F.col("r") < header_rows).groupBy(*sheet, "c").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "cell"))), lambda x: x["cell"]).alias("heads"))
    body = numbered.where(F.col("r") >= header_rows)
    periods = body.where("c = 0").select(*sheet, "r", F.col("cell").alias("period"))
    return body.where("c > 0").join(periods, [*sheet, "r"]).join(heads, [*sheet, "c"]).select(*sheet, "heads", "period", number_or_null(F.col("cell")).alias("value")).where("value is not null")


def loose_rows(lines: DataFrame, column: str = "value") -> DataFrame:
    """Rows of two fields with commas or blanks between, period first; anything else is no row."""
    cells = F.when(F.col(column).contains(","), F.split(column, r"\s*,\s*")).otherwise(F.split(F.trim(column), r"\s+"))
    period = F.regexp_extract(cells[0], r"^(\d{4})-?(\d{2})(?:-01)?$", 0)
    rows = lines.select(cells.alias("cells"), period.alias("period")).where("period <> '' and size(cells) = 2")
    return rows.select(F.regexp_replace(F.substring("period", 1, 7), r"^(\d{4})-?(\d{2}).*$", "$1-$2").alias("period"), number_or_null(F.get("cells", F.lit(1))).alias("value"))


def dated_index(line: Column) -> tuple[Column, Column]:
    """(date, values) of `YYYY MM DD v…` and `DD Mon YY v…` lines; *, -1 and runs of fused -1 are missing."""
    modern = F.regexp_extract(line, r"^\s*(\d{4}) (\d{2}) (\d{2})", 0)
    old = F.regexp_extract(line, r"^\s*(\d{2} [A-Z][a-z]{2} \d{2})", 0)
    date = F.coalesce(F.to_date(F.try_to_timestamp(F.trim(modern), F.lit("yyyy MM dd"))), F.to_date(F.try_to_timestamp(F.trim(old), F.lit("dd MMM yy"))))
    rest = F.substring(line, F.length(F.when(modern != "", modern).otherwise(old)) + 1, F.length(line))
    values = F.regexp_extract_all(rest, F.lit(r"(\*|-1|-?\d+(?:\.\d+)?)"), 1)
    return date, F.transform(values, lambda v: F.when(~v.isin("*", "-1"), v.try_cast("double")))


class _Text(HTMLParser):
    """Text outside nested blocks of given classes, scripts and styles."""

    def __init__(self, drop: set[str]) -> None:
        super().__init__()
        self.drop, self.depth, self.hidden, self.out = drop, 0, False, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.hidden = tag in ("script", "style")
        if tag == "div" and (self.depth or self.drop & set((dict(attrs).get("class") or "").split())):
            self.depth += 1

    def handle_endtag(self, tag: str) -> None:
        self.hidden = False
        if tag == "div" and self.depth:
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if not self.depth and not self.hidden:
            self.out.append(data)


def without_blocks(df: DataFrame, html: str, classes: set[str]) -> DataFrame:
    """Adds `body`: text without div blocks of the classes, however deep they nest (which no regular expression can follow)."""
    names = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField("body", T.StringType())])

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        parser = _Text(classes)
        parser.feed(text)
        parser.close()  # gives what follows the last tag, or an unfinished entity
        return " ".join("".join(parser.out).split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([one(x) for x in b.column(html).to_pylist()], type=pa.string())], names=[*names, "body"])

    return df.mapInArrow(run, schema)


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def xlsx_cells(spark: SparkSession, path: str) -> DataFrame:
    """file, sheet, row, col (letters), value of every filled cell, streamed row by row from each workbook."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for where, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    shared = []
                    if "xl/sharedStrings.xml" in z.namelist():
                        shared = ["".join(t.text or "" for t in si.iter(f"{_SHEET}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
                    for name in sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)):
                        held = []
                        for _, node in ElementTree.iterparse(z.open(name)):
                            if node.tag == f"{_SHEET}c":
                                v = node.findtext(f"{_SHEET}v")
                                if node.get("t") == "inlineStr":
                                    v = "".join(t.text or "" for t in node.iter(f"{_SHEET}t"))
                                if v is not None:
                                    ref = re.fullmatch(r"([A-Z]+)(\d+)", node.get("r"))
                                    held.append({"file": where, "sheet": name[14:-4], "row": int(ref[2]), "col": ref[1], "value": shared[int(v)] if node.get("t") == "s" else v})
                            elif node.tag == f"{_SHEET}row":
                                node.clear()
                        if held:
                            yield pa.RecordBatch.from_pylist(held)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, sheet string, row bigint, col string, value string")


def decoded(content: Column) -> Column:
    """Bytes as UTF-8 where they are, else as Windows-1252; line ends become one newline each."""
    high = range(0x80, 0xA0)  # where Windows-1252 and ISO 8859-1 differ
    windows = F.translate(F.decode(content, "iso-8859-1"), "".join(map(chr, high)), bytes(high).decode("cp1252", errors="replace"))
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(windows)
    return F.regexp_replace(text, r"\r+\n|\r", "\n")


def box_lines(boxes: DataFrame, tolerance: float) -> DataFrame:
    """Word boxes (page, x0, top, text) as lines: boxes whose tops are at most tolerance apart in order are one line, read from left to right."""
    w = Window.partitionBy("page").orderBy("top", "x0")
    new = (F.col("top") - F.lag("top").over(w) > tolerance).cast("int")
    placed = boxes.withColumn("_new", F.coalesce(new, F.lit(0))).withColumn("line", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    words = F.transform(F.sort_array(F.collect_list(F.struct("x0", "text"))), lambda b: b["text"])
    return placed.groupBy("page", "line").agg(F.min("top").alias("top"), F.array_join(words, " ").alias("text"))


def nearest_column(boxes: DataFrame, columns: DataFrame) -> DataFrame:
    """Each box with the nearest of its page's columns (page, name, center); ties go to the left one. Columns of a page are few."""
    j = boxes.join(columns, "page").withColumn("_d", F.abs(F.col("center") - (F.col("x0") + F.col("x1")) / 2))
    w = Window.partitionBy("page", "x0", "top").orderBy("_d", "center")
    return j.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_d", "center")
