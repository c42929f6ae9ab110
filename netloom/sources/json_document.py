"""Multi-table JSON documents read in byte ranges.

A document is one object with an array of flat objects for each table. A reader
that takes it as one record needs one task; here it is cut at every ``}``, which
Spark's text source does in byte ranges on any file system, and a piece is then
one element, led by what stands between elements: a comma, or the end of an
array and the name of the next. The few pieces with a name say where each table
begins.

A ``}`` inside a string would cut an element in two. Whether any does shows in
one pass: such a piece has an odd number of quotes. Only then are quotes and
elements counted along the whole document, by distributed running totals, and
the pieces of an element put together.

A path may be one file, or a folder of parts that make up a document in the order
of their names, each part ending between elements.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netloom.functions.prefix import running_total
from netloom.session import materialize

_STRING = r'"((?:[^"\\]|\\.)*)"'
_QUIET = r'"(?:[^"\\]|\\.)*"'
#: What stands before an element: a comma; or the start of the document or the end
#: of an array, then single values and empty arrays, and the name of the next
#: array (group 1). Group 2 is the element, without its closing brace.
_PIECE = (
    rf"(?s)^(?:\s*[\]{{](?:[\s,]*{_QUIET}\s*:\s*(?:{_QUIET}|[-+.\w]+|\[\s*\]))*[\s,]*(?:{_STRING}\s*:\s*\[)?)?[\s,]*(\{{.*)?"
)
_POSITION = ["file", "block", "seq"]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def _quotes(value: str = "value") -> Column:
    """Quotes that are not escaped."""
    plain = F.regexp_replace(value, r"(?s)\\.", "")
    return F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))


def _whole_elements(pieces: DataFrame) -> DataFrame:
    """The pieces again, those of one element put together: a ``}`` ends an element
    where an even number of quotes stands before it."""
    counted = running_total(pieces.withColumn("quotes", _quotes().cast("long")), [], _POSITION, "quotes", "so_far")
    ends = counted.withColumn("is_end", (F.col("so_far") % 2 == 0).cast("long"))
    numbered = running_total(ends.select("value", *_POSITION, "is_end"), [], _POSITION, "is_end", "element")
    parts = F.array_sort(F.collect_list(F.struct(*_POSITION, "value"))).alias("parts")
    whole = numbered.groupBy((F.col("element") - F.col("is_end")).alias("element")).agg(parts)
    first = [F.col("parts")[0][c].alias(c) for c in _POSITION]
    return materialize(whole.select(F.array_join(F.col("parts.value"), "}").alias("value"), *first), "json_elements")


def read_tables(spark: SparkSession, path: str, model: Mapping[str, StructType]) -> dict[str, DataFrame]:
    """The tables of ``model`` (named and typed as in the document); a table that
    the document lacks is empty. A document whose last array does not end is an
    error, and so is an element whose values are not of the declared types."""
    pieces = _pieces(spark, path)
    at = F.struct(*_POSITION)
    blank = F.trim(F.regexp_replace("value", r"\s", "")) == ""
    ends = [f(F.when(~blank, F.col("value")), F.when(~blank, at)).alias(n) for n, f in (("first", F.min_by), ("last", F.max_by))]
    facts = pieces.agg(F.bool_or(_quotes() % 2 == 1).alias("odd"), *ends).first()
    if facts["odd"]:
        pieces = _whole_elements(pieces)
        facts = pieces.agg(*ends).first()
    # what the document's own closing brace ends is no element, and begins with the end of an array (or of nothing)
    end = re.match(_PIECE, facts["last"] or "")
    if facts["last"] is None or facts["last"].lstrip()[:1] not in ("]", "{") or end[2] or facts["first"].lstrip()[:1] != "{":
        raise ValueError(f"{path} is not a whole document of tables")
    parsed = pieces.select(*_POSITION, F.regexp_extract("value", _PIECE, 1).alias("name"), F.regexp_extract("value", _PIECE, 2).alias("element"))
    # one row for each array of the document's only object
    begins = sorted((r["file"], r["block"], r["seq"], json.loads(f'"{r["name"]}"')) for r in parsed.where("name <> ''").drop("element").collect())
    tables = {}
    for table, schema in model.items():
        ranges = [F.lit(False)]
        for here, after in zip(begins, [*begins[1:], None]):
            if here[3] == table:
                ranges.append((at >= _literal(here)) & (at < _literal(after) if after else F.lit(True)))
        own = (F.col("element") != "") & reduce(lambda a, b: a | b, ranges)
        # guarded, as a filter on the result may run before the one on the rows
        value = F.when(own, F.from_json(F.concat("element", F.lit("}")), schema, {"mode": "FAILFAST"})).alias("e")
        tables[table] = parsed.where(own).select(value).select("e.*")
    return tables


def _literal(begin: tuple) -> Column:
    return F.struct(*[F.lit(v).cast(t).alias(c) for v, c, t in zip(begin, _POSITION, ("string", "long", "long"))])


def write_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """The tables as one document in parts: a folder of text files, written by many
    tasks, that make it up in the order of their names."""
    lines, marks = [], []
    spark = next(iter(tables.values())).sparkSession
    for k, (table, df) in enumerate(tables.items()):
        marks.append((k, 0, 0, ("{" if not k else "],\n") + json.dumps(table) + ": ["))
        # written, so that the number of a row is the same in both uses below
        rows = materialize(df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row")), f"json_{uuid.uuid4().hex}")
        rows = rows.select("row", F.monotonically_increasing_id().alias("id"))
        first = rows.agg(F.min("id")).first()[0]
        comma = F.when(F.col("id") == F.lit(first), F.lit("")).otherwise(F.lit(","))
        lines.append(rows.select(F.lit(k).alias("k"), F.lit(1).alias("kind"), "id", F.concat(comma, "row").alias("text")))
    marks.append((len(tables), 0, 0, "]}"))
    every = reduce(DataFrame.unionByName, lines, spark.createDataFrame(marks, "k int, kind int, id long, text string"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every.repartitionByRange(n, "k", "kind", "id").sortWithinPartitions("k", "kind", "id").select("text").write.text(path)
