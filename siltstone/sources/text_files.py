"""CSV sources."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_text(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header, every column as text.

    With ``columns`` no file is opened before the query runs, and a header that
    differs from them is an error. Without, Spark reads one header line.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header and inferred types; costs one more pass over the files."""
    return spark.read.csv(path, header=True, inferSchema=True)


# ---------------------------------------------------------------- with broken lines

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_FIELD = rf'(?:{_QUOTED}|[^",\r\n]*+)'
#: No field reads so: then an empty field is null, and a quoted empty one an empty text.
_NO_TEXT = "\x01"


def _well_formed(fields: int) -> str:
    return _FIELD + f"(?:,{_FIELD}){{{fields - 1}}}"


@dataclass(frozen=True)
class CheckedCsv:
    """What was read: ``rows`` with all columns as text, and ``broken`` (file, record, reason)."""

    rows: DataFrame
    broken: DataFrame


def read_csv_checked(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], *, line_breaks: bool = False
) -> CheckedCsv:
    """CSV as RFC 4180 has it; records that do not parse go to a side table and spoil none beside them.

    A record is good if it has as many fields as there are columns, each either quoted as a
    whole, with inner quotes doubled, or without any quote. An empty field is null, a quoted
    empty one an empty text. Every other record is kept word for word, with a reason:
    `short` or `long` (its number of fields), `unterminated` (an odd number of quotes) or
    `stray quote`. Records that repeat the header and blank lines are dropped.

    Without ``line_breaks`` a record is a line, and files are split among tasks. With it, quoted
    fields may hold line breaks: a record then goes as far as it must to be good, and a line
    that no following text completes is a broken record by itself, after which reading goes
    on with the next line. For that a file is read whole by one task, as Spark does for
    `multiLine`, so files should be of a size that fits a task's memory.
    """
    names = list(columns)
    well_formed = _well_formed(len(names))
    text = spark.read.text(path, wholetext=line_breaks).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))
    if line_breaks:
        # At the start of a line: the longest good record, or else the line as it is.
        pattern = rf"(?<![^\n])(?:{well_formed}(?=\r?\n|\z)|[^\n]+)"
        text = text.select("file", F.explode(F.regexp_extract_all("record", F.lit(pattern), F.lit(0))).alias("record"))
        text = text.select("file", F.regexp_replace("record", r"\r\z", "").alias("record"))
    records = text.where((F.col("record") != "") & (F.col("record") != ",".join(names)))
    good = F.col("record").rlike(rf"\A{well_formed}\z")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    options = {"quote": '"', "escape": '"', "nullValue": _NO_TEXT, "emptyValue": ""}
    parsed = F.from_csv(F.col("record"), schema.simpleString()[7:-1].replace(":", " "), options)
    return CheckedCsv(
        records.where(good).select(parsed.alias("row")).select("row.*"),
        records.where(~good).select("file", "record", _fault(F.col("record"), len(names)).alias("reason")),
    )


def _fault(record: Column, fields: int) -> Column:
    """Why a record is broken."""
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    bare = F.regexp_replace(record, _QUOTED, "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (
        F.when(quotes % 2 == 1, F.lit("unterminated"))
        .when(found < fields, F.lit("short"))
        .when(found > fields, F.lit("long"))
        .otherwise(F.lit("stray quote"))
    )
