"""CSV as text without loss, and bad lines set aside instead of guessed at.

Files are RFC 4180: comma, ``"`` doubled inside quotes, a header.  Every
column is text.  NULL is an empty field, the empty text is ``""``; padding,
quotes, commas and line ends inside quotes come back as they were.

``read_checked`` returns the good rows and the rejects:

* By line (default): a line is a record, so files are split over tasks.  The
  structure of each line is checked natively: quoted runs are folded to one
  mark, after which a field is either only marks or has neither mark nor
  quote (else reason ``quotes``: an open quote, text beside a closing one),
  and the commas left give the number of fields (else reason ``fields``).  A
  quoted line end leaves an open quote on both sides of it, so such records
  are rejected and reported, not misread.  A line with the columns of the
  header in another order is reason ``header``.
* ``multi_line``: quoted line ends belong to values.  Spark reads a file per
  task and reports records with a wrong number of fields, so the sink
  (``write``) bounds the rows of a file.

Blank lines are no records (a row of one NULL column is one; the sink
refuses frames of one column).  The header is the first line of the first
file; the same line elsewhere is a header too.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BAD = "_corrupt_record"
#: Empty unquoted fields are read as this and then as NULL, so that "" can stay the empty text.
_NULL = "\x00null\x00"
_FORMAT = {"sep": ",", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_READ = _FORMAT | {"mode": "PERMISSIVE", "nullValue": _NULL, "emptyValue": "", "maxCharsPerColumn": "-1", "columnNameOfCorruptRecord": _BAD}
_WRITE = _FORMAT | {"header": "true", "encoding": "UTF-8", "nullValue": "", "emptyValue": '""'}


class Landing(NamedTuple):
    """``rows``: the wanted columns of good records; ``rejects``: (file, reason, text) of the others."""

    rows: DataFrame
    rejects: DataFrame


def write(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Distributed CSV with a header per file, at most ``rows_per_file`` rows each."""
    if len(df.columns) < 2:
        raise ValueError("a NULL in a single column would be a blank line")
    df.write.mode("overwrite").options(**_WRITE).option("maxRecordsPerFile", rows_per_file).csv(path)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The column names in the header line of a file."""
    first = spark.read.options(**_FORMAT).csv(path).first()  # reads the first line only
    names = [n or "" for n in first or ()]
    if len({n.lower() for n in names}) < len(names) or "" in names:
        raise ValueError(f"{path}: missing or repeated column names in the header: {names}")
    return names


def _reason(line: Column, names: Sequence[str]) -> Column:
    """Why a line is no record of these columns; NULL if it is one."""
    mark = "\x01"
    folded = F.regexp_replace(F.replace(line, F.lit(mark), F.lit(" ")), '"[^"]*"', mark)
    quotes = folded.contains('"') | folded.rlike(f"[^,{mark}]{mark}|{mark}[^,{mark}]")
    fields = F.length(folded) - F.length(F.replace(folded, F.lit(","), F.lit(""))) + 1
    same = F.array_sort(F.split(line, ",")) == F.array(*[F.lit(n) for n in sorted(names)])
    return (F.when(quotes, F.lit("quotes")).when(fields != len(names), F.lit("fields")).when(same, F.lit("header")))


def read_checked(spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = False,
                 header: Sequence[str] | None = None) -> Landing:
    """The good records' ``columns`` (default: all) as text, and the rejects."""
    names = list(header or header_of(spark, path))
    missing = [c for c in columns or () if c not in names]
    if missing:
        raise ValueError(f"{path}: columns {missing} are not in the header {names}")
    wanted = [F.col(f"`{c}`") for c in columns or names]
    file = F.col("_metadata.file_path").alias("file")
    schema = ", ".join(f"`{n}` string" for n in [*names, _BAD])
    if multi_line:
        read = (spark.read.schema(schema).options(**_READ).option("header", True).option("enforceSchema", False)
                .option("multiLine", True).option("columnPruning", False).csv(path))
        # Spark refuses to read the corrupt record alone, so a value is looked at too (always true).
        read = read.where(F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0)
        bad = F.col(_BAD).isNotNull()
        return Landing(read.where(~bad).select(*wanted), read.where(bad).select(file, F.lit("fields").alias("reason"), F.col(_BAD).alias("text")))
    first = ",".join('"' + n.replace('"', '""') + '"' if any(c in n for c in ',"') else n for n in names)
    quoted = ",".join('"' + n.replace('"', '""') + '"' for n in names)
    lines = spark.read.text(path).where((F.col("value") != "") & ~F.col("value").isin(first, quoted))
    judged = lines.select("value", file, _reason(F.col("value"), names).alias("reason"))
    parsed = judged.where("reason IS NULL").select(F.from_csv("value", schema, _READ).alias("r")).select("r.*")
    return Landing(parsed.select(*wanted), judged.where("reason IS NOT NULL").select("file", "reason", F.col("value").alias("text")))
