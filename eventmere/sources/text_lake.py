"""Lake kept as text files: ``<base>/<kind>/<YYYY-MM-DD>/<any>.csv``.

Folders named ``kind=<kind>`` and ``dt=<day>`` are read as well.

Kinds have different columns, and so may files of one kind: columns come and go, or
change places, over the years. A text scan fills columns by position, so files are
grouped by their header line, each group is read with its own columns, and the groups
are joined by name. Columns nobody knows are left out, columns a file lacks are NULL.
"""

from __future__ import annotations

import csv
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmere.functions import days, repair
from eventmere.schemas import TEXT_RECORD, record_columns
from eventmere.sources import lake, paths


def read_text(
    spark: SparkSession,
    base: str,
    start: str | date | None = None,
    end: str | date | None = None,
    *,
    headers: dict[str, list[str]] | None = None,
    line_breaks: bool = True,
) -> DataFrame:
    """All columns as text, plus ``kind`` and ``dt`` taken from the folder names.

    Days without files give no rows. The header of each file says which columns it
    holds, in which order; names are compared without spaces around them and without
    regard to case. ``headers`` names the columns of kinds whose headers are all the
    same, which spares reading them; a file that differs is then an error, never
    shifted columns.

    With ``line_breaks`` a field may span lines and a file is one task; without it
    large files are split.
    """
    limits = days.parse_range(start, end)
    wanted = "*"
    if limits:
        wanted = f"{{{','.join(f'{day},dt={day}' for day in days.day_list(*limits))}}}"
    frames = []
    for folder in paths.child_folders(spark, base):
        kind, pattern = folder.removeprefix("kind="), f"{base}/{folder}/{wanted}/*.csv"
        if kind in (headers or {}):
            if paths.matches(spark, pattern):
                frames.append(_read_files(spark, [pattern], headers[kind], line_breaks, checked=True))
            continue
        for header, files in header_groups(spark, pattern).items():
            whole = list(header) == record_columns(kind) and len(files) == len(paths.matching(spark, pattern))
            frames.append(_read_files(spark, [pattern] if whole else [paths.literal(f) for f in files], list(header), line_breaks))
    if not frames:
        return spark.createDataFrame([], T.StructType([*TEXT_RECORD.fields, *_FOLDERS.fields]))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return _complete(rows)


def header_groups(spark: SparkSession, pattern: str) -> dict[tuple[str, ...], list[str]]:
    """Files that fit a glob, by the column names of their header line; empty files are in no group.

    The driver reads one line per file, as it lists the files anyhow.
    """
    files = paths.matching(spark, pattern)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, paths.first_lines(spark, files)):
        names = next(csv.reader([line]), [])
        if names:
            groups.setdefault(_column_names(names), []).append(file)
    return groups


def _column_names(names: list[str]) -> tuple[str, ...]:
    """Known names as they are declared; of a repeated name the first counts, the others are unknown."""
    declared = {name.lower(): name for name in TEXT_RECORD.fieldNames()}
    found: list[str] = []
    for n, name in enumerate(names):
        own = declared.get(name.strip().lower())
        found.append(own if own and own not in found else f"unknown_{n}")
    return tuple(found)


_FOLDERS = T.StructType([T.StructField("kind", T.StringType()), T.StructField("dt", T.DateType())])


def _read_files(spark: SparkSession, files: list[str], names: list[str], line_breaks: bool, checked: bool = False) -> DataFrame:
    """Files whose columns are ``names``; with ``checked`` another header is an error."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    known = [name for name in names if name in TEXT_RECORD.fieldNames()]
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", not checked)
        .option("escape", '"')
        .option("multiLine", line_breaks)
    )
    place = F.col("_metadata.file_path")
    return reader.csv(files).select(
        *known,
        F.regexp_extract(place, r"/(?:kind=)?([^/]+)/[^/]+/[^/]+$", 1).alias("kind"),
        F.regexp_extract(place, r"/(?:dt=)?([^/]+)/[^/]+$", 1).try_cast("date").alias("dt"),
    )


def _complete(rows: DataFrame) -> DataFrame:
    """Every record column, NULL where no file has it, in declared order."""
    missing = [f for f in TEXT_RECORD.fields if f.name not in rows.columns]
    rows = rows.withColumns({f.name: F.lit(None).cast("string") for f in missing}) if missing else rows
    return rows.select(*TEXT_RECORD.fieldNames(), *_FOLDERS.fieldNames())


def normalize(rows: DataFrame) -> DataFrame:
    """Typed records: unreadable numbers and times become NULL, rows without a creator go."""
    typed = {
        "user_id": repair.lenient_long(F.col("user_id")),
        "creator_id": repair.lenient_long(F.col("creator_id")),
        "created_at": repair.lenient_time(F.col("created_at")),
        "lecture_id": repair.lenient_long(F.col("lecture_id")),
        "buffering_duration": repair.lenient_double(F.col("buffering_duration")),
        "amount": repair.lenient_long(F.col("amount")).try_cast("int"),
        "retry_count": repair.lenient_long(F.col("retry_count")).try_cast("int"),
    }
    return rows.withColumns(typed).filter(F.col("creator_id").isNotNull())


def read(
    spark: SparkSession,
    base: str,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DataFrame:
    """Repaired records of a text lake, limited to a day range when one is given."""
    return lake.in_range(normalize(read_text(spark, base, start, end)), start, end)
