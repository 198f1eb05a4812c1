"""Statistical agencies' structured formats: XML that may be damaged, JSON-stat cubes, and SDMX-JSON with several dimensions."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_XML_OWN = {"amp", "lt", "gt", "quot", "apos"}
_ENTITY = re.compile(r"&(?:(#\d+|#x[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);)?")
_LOOSE = re.compile(r"<(?![A-Za-z_/!?])")
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _entity(m: re.Match) -> str:
    if m[1] is None:
        return "&amp;"
    if m[1] in _XML_OWN or m[1][0] == "#":
        return m[0]
    plain = html.unescape(m[0])  # an entity of HTML; what is none of either is text
    return html.escape(plain) if plain != m[0] else f"&amp;{m[1]};"


def _elements(text: str, tag: str) -> tuple[list[tuple[dict, str]], bool]:
    """(attributes, text) of each finished element, and whether the document broke off."""
    text = _LOOSE.sub("&lt;", _ENTITY.sub(_entity, _CONTROL.sub("", text)))
    parser = ElementTree.XMLPullParser(events=("start", "end"))
    above: list[dict] = [{}]
    found: list[tuple[dict, str]] = []
    broken = False
    try:
        parser.feed(text)
        parser.close()
    except ElementTree.ParseError:
        broken = True
    try:
        for event, node in parser.read_events():
            if event == "start":
                above.append({**above[-1], **{k.rpartition("}")[2]: v for k, v in node.attrib.items()}})
                continue
            own = above.pop()
            if node.tag.rpartition("}")[2] == tag:
                found.append((own, " ".join("".join(node.itertext()).split())))
    except ElementTree.ParseError:
        broken = True
    return found, broken


def xml_elements(df: DataFrame, column: str, tag: str, keys: list[str]) -> DataFrame:
    """A row for each element `tag` of the XML documents in a column: keys, n (its place, from 0), attributes (its own and its ancestors', the inner ones winning), text, broken.

    Bare ampersands, loose `<`, entities of HTML and control characters are repaired. A document that breaks off gives what
    was finished before, with broken true; a null, or one without such elements, gives one row with null n, so that it can
    be counted. Namespaces are left out of names. A document is one row, and is held by one task.
    """
    schema = T.StructType([*[df.schema[k] for k in keys], *T.StructType.fromDDL("n int, attributes map<string,string>, text string, broken boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, n, attributes, text, broken = [], [], [], [], []
            for i, doc in enumerate(b.column(len(keys)).to_pylist()):
                found, bad = _elements(doc, tag) if doc is not None else ([], False)
                for j, (own, words) in enumerate(found):
                    at.append(i), n.append(j), attributes.append(list(own.items())), text.append(words), broken.append(bad)
                if not found:
                    at.append(i), n.append(None), attributes.append(None), text.append(None), broken.append(bad)
            held = [b.column(i).take(pa.array(at, type=pa.int32())) for i in range(len(keys))]
            more = [pa.array(n, type=pa.int32()), pa.array(attributes, type=pa.map_(pa.string(), pa.string())), pa.array(text, type=pa.string()), pa.array(broken, type=pa.bool_())]
            yield pa.RecordBatch.from_arrays([*held, *more], names=[*keys, "n", "attributes", "text", "broken"])

    return df.select(*keys, column).mapInArrow(run, schema)


def _numbered(raw: Column) -> Column:
    """place -> code of a JSON-stat category index, which is an object {code: place} or a list of codes."""
    by_code = F.from_json(raw, "map<string,int>")
    listed = F.from_json(raw, "array<string>")
    of_list = F.map_from_arrays(F.transform(listed, lambda x, i: i), listed)
    return F.when(F.startswith(F.ltrim(raw), F.lit("[")), of_list).otherwise(F.map_from_arrays(F.map_values(by_code), F.map_keys(by_code)))


def json_stat(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Cells of JSON-stat cubes: keys, dims (dimension -> code), value. Values are an object by place or a list; nulls in it are no cells. Places run over the dimensions, the last one fastest."""
    d = df.select(*keys, F.from_json(column, "id array<string>, size array<int>, dimension map<string,string>, value string").alias("d"))
    codes = F.transform("d.id", lambda name: _numbered(F.get_json_object(F.col("d.dimension")[name], "$.category.index")))
    listed = F.from_json("d.value", "array<double>")
    cells = F.when(F.startswith(F.ltrim("d.value"), F.lit("[")), F.map_from_arrays(F.transform(listed, lambda x, i: i.cast("string")), listed)).otherwise(F.from_json("d.value", "map<string,double>"))
    each = d.select(*keys, "d.id", "d.size", codes.alias("codes"), F.explode(cells).alias("at", "value")).where("value is not null")
    stride = lambda i: F.aggregate(F.slice("size", i + 2, F.size("size")), F.lit(1).cast("bigint"), lambda a, x: a * x)
    place = lambda i: (F.floor(F.col("at").cast("bigint") / stride(i)) % F.get("size", i)).cast("int")
    found = F.transform("id", lambda _, i: F.try_element_at(F.get("codes", i), place(i)))
    return each.select(*keys, F.map_from_arrays("id", found).alias("dims"), "value")


def sdmx_series(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Observations of SDMX-JSON with series of several dimensions: keys, dims (dimension -> code, of the series' colon-joined places), period, value (null where it isn't stated)."""
    part = "array<struct<id:string,values:array<struct<id:string>>>>"
    schema = f"data struct<structures:array<struct<dimensions:struct<series:{part},observation:{part}>>>,dataSets:array<struct<series:map<string,struct<observations:map<string,array<double>>>>>>>"
    d = df.select(*keys, F.from_json(column, schema)["data"].alias("d"))
    dimensions = F.get("d.structures", F.lit(0))["dimensions"]
    series = d.select(*keys, dimensions["series"].alias("of"), F.get(dimensions["observation"], F.lit(0))["values"].alias("periods"), F.explode(F.get("d.dataSets", F.lit(0))["series"]).alias("series", "body"))
    places = F.split("series", ":").cast("array<int>")
    dims = F.map_from_arrays(F.transform("of", lambda x: x["id"]), F.transform("of", lambda x, i: F.get(x["values"], F.get(places, i))["id"]))
    points = series.select(*keys, dims.alias("dims"), "periods", F.explode("body.observations").alias("at", "v"))
    return points.select(*keys, "dims", F.get("periods", F.col("at").cast("int"))["id"].alias("period"), F.get("v", F.lit(0)).alias("value"))
