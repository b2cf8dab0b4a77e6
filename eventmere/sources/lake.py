"""The archive lake: ``data/batch_id=<id>/kind=<kind>/dt=<day>`` plus a manifest.

Kind and day are folder columns, so a report on one kind and a few days opens
only those folders. The folder kind is the lower-case event type; the event type
itself is kept in the file as it came.

Each batch has a line per kind and day with its rows and its first and last time,
counted while it is written: ``counts/batch_id=<id>``, and the same by day in
``days/dt=<day>/batch_id=<id>``, so that a day range looks at no other batch.
Small batches are merged by :func:`compact`.
"""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmere.functions import days, labels
from eventmere.operators.dedupe import earliest_value
from eventmere.schemas import COMMON_COLUMNS, KIND_COLUMNS, LAKE, WIDE, record_columns
from eventmere.sources import batches, layout, paths

DATA = "data"
SOURCES = "sources"
METRICS = "metrics"
COUNTS = "counts"
DAYS = "days"

SOURCE = T.StructType([T.StructField("source_id", T.StringType()), T.StructField("events", T.LongType())])
#: Rows per kind and day of a batch; the times are those of the whole batch.
COUNT = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("dt", T.DateType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("first_at", T.TimestampType()),
        T.StructField("last_at", T.TimestampType()),
    ]
)
#: Kinds and days that are counted exactly while writing; with more, the written folders are counted.
MOST_FOLDERS = 100_000
#: Batches with fewer rows are merged.
SMALL_ROWS = 20_000_000


def with_folders(records: DataFrame) -> DataFrame:
    """Add the folder columns. The day is the event's, so a late event joins its own day."""
    return records.withColumns(
        {"kind": labels.kind_of(F.col("event_type")), "dt": F.to_date("created_at")}
    )


def only_kind_columns(records: DataFrame) -> DataFrame:
    """Clear, row by row, the columns a record's kind does not hold."""
    kind = labels.kind_of(F.col("event_type"))
    kept = []
    for name in WIDE.fieldNames():
        if name in COMMON_COLUMNS:
            kept.append(F.col(name))
        else:
            holders = [k for k, columns in KIND_COLUMNS.items() if name in columns]
            kept.append(F.when(kind.isin(holders), F.col(name)).alias(name))
    return records.select(*kept)


def write_batch(
    spark: SparkSession, records: DataFrame, root: str, batch_id: str, sources: DataFrame | None = None
) -> bool:
    """Archive records as one batch; False when the batch is already archived.

    ``sources`` (source_id, events) names the table batches the records came from, and
    how many events each held.

    Rows are rebalanced by folder before writing: AQE splits a folder that holds a
    large share of the rows over several tasks and merges small ones, so file
    counts follow data size and no task gets a whole hot kind or day.
    """
    def write_files() -> None:
        counts = _write_data(spark, with_folders(only_kind_columns(records)), root, batch_id)
        if sources is not None:
            names = sources.select("source_id", F.col("events").cast("bigint").alias("events")).coalesce(1)
            names.write.mode("overwrite").parquet(batches.batch_folder(root, SOURCES, batch_id))
        _write_counts(spark, counts, root, batch_id)

    return batches.commit(spark, root, batch_id, write_files)


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out by folder; AQE splits a large folder and merges small ones."""
    return rows.hint("rebalance", F.col("kind"), F.col("dt"))


def _write_data(spark: SparkSession, rows: DataFrame, root: str, batch_id: str) -> list[tuple]:
    """Write rows that have the folder columns; returns lines of ``COUNT``.

    The lines are gathered by the tasks that write, after the last shuffle, where Spark
    counts a partition once however often it was tried; nothing is read again.
    """
    seen = Observation()
    place = F.to_json(F.struct("kind", F.col("dt").cast("string").alias("dt")))
    rows = spread(rows).withColumn("_place", place).observe(
        seen,
        F.count("*").alias("rows"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
        F.expr(f"approx_top_k(_place, {MOST_FOLDERS}, {MOST_FOLDERS})").alias("places"),
    )
    folder = batches.batch_folder(root, DATA, batch_id)
    rows = rows.drop("_place").sortWithinPartitions("kind", "dt", "created_at")
    rows.write.mode("overwrite").partitionBy("kind", "dt").parquet(folder)
    found = seen.get
    counted = [(p["item"], p["count"]) for p in found["places"] or []]
    # Exact while all items fit, which is when they make up all rows.
    if len(counted) > MOST_FOLDERS // 2 or sum(n for _, n in counted) != found["rows"]:
        written = spark.read.schema(LAKE).option("basePath", f"{root}/{DATA}").parquet(folder)
        lines = [(r["kind"], r["dt"], r["count"]) for r in written.groupBy("kind", "dt").count().collect()]
    else:
        lines = []
        for text, count in counted:
            named = json.loads(text)
            day = named.get("dt")
            lines.append((named.get("kind"), date.fromisoformat(day) if day else None, count))
    return [(*line, found["first_at"], found["last_at"]) for line in lines]


def _write_counts(spark: SparkSession, counts: list[tuple], root: str, batch_id: str) -> None:
    """Store a batch's lines, by batch and by day. One line per folder of the batch, whatever its size."""
    lines = spark.createDataFrame(counts, COUNT).coalesce(1)
    lines.write.mode("overwrite").parquet(batches.batch_folder(root, COUNTS, batch_id))
    by_day = lines.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
    by_day.option("partitionOverwriteMode", "dynamic").partitionBy("dt", "batch_id").parquet(f"{root}/{DAYS}")


def batch_counts(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """Lines of some batches: rows per kind and day, with ``batch_id``."""
    schema = T.StructType([*COUNT.fields, T.StructField("batch_id", T.StringType())])
    held = [f for f in folders if paths.exists(spark, batches.batch_folder(root, COUNTS, f))]
    if not held:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{root}/{COUNTS}")
    return reader.parquet(*[batches.batch_folder(root, COUNTS, f) for f in held])


def write_csv(records: DataFrame, folder: str) -> None:
    """Optional text copy: one folder per kind, each with that kind's columns only.

    The record set is read once per kind. Days that are written again are replaced,
    so a repeated run adds nothing.
    """
    tagged = with_folders(records)
    for kind in (*KIND_COLUMNS, None):
        if kind is None:
            chosen = tagged.filter(~F.col("kind").isin(*KIND_COLUMNS))
            target, folders = folder, ["kind", "dt"]
        else:
            chosen = tagged.filter(F.col("kind") == kind)
            target, folders = f"{folder}/kind={kind}", ["dt"]
        write_csv_files(chosen.select(*record_columns(kind or ""), *folders), target, folders)


def write_csv_files(rows: DataFrame, target: str, folders: list[str], mode: str = "overwrite") -> None:
    """Text files with a header, in folders by some columns; folders that get rows are replaced, or added to."""
    rows = rows.hint("rebalance", *[F.col(c) for c in folders])
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
        .partitionBy(*folders)
        .csv(target)
    )


def read(spark: SparkSession, root: str, once: bool = False) -> DataFrame:
    """All archived records of committed batches.

    ``once`` keeps each event from its first batch only, for lakes in which a lost
    checkpoint archived events twice. It costs a shuffle by event.
    """
    rows = batches.visible(spark, root, DATA, LAKE)
    if once:
        first = earliest_value(rows, "event_id", "batch_id", [F.col("batch_id")])
        rows = rows.join(first, ["event_id", "batch_id"], "left_semi").select(*LAKE.fieldNames())
    return rows


def archived_sources(spark: SparkSession, root: str) -> DataFrame:
    """Table batches that committed archive batches hold: source_id, events, batch_id."""
    return batches.visible(spark, root, SOURCES, SOURCE)


def read_kind(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """One kind with its own columns; other kinds' folders are not opened."""
    rows = batches.visible(spark, root, DATA, LAKE).filter(F.col("kind") == kind)
    return rows.select(*record_columns(kind), "batch_id", "dt")


def in_range(records: DataFrame, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Records from the start day to the end day, both included; all when neither is given."""
    limits = days.parse_range(start, end)
    if limits is None:
        return records
    rows = records.filter(days.within_days(F.col("created_at"), *limits))
    return rows.filter(days.dt_between(F.col("dt"), *limits)) if "dt" in rows.columns else rows


def read_range(spark: SparkSession, root: str, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Records of a day range; folders of other days are not listed."""
    limits = days.parse_range(start, end)
    if limits is None:
        return read(spark, root)
    found = _range_folders(spark, root, days.day_list(*limits))
    if not found:
        return spark.createDataFrame([], LAKE)
    rows = spark.read.schema(LAKE).option("basePath", f"{root}/{DATA}").parquet(*found)
    return in_range(rows.select(*LAKE.fieldNames()), start, end)


def _range_folders(spark: SparkSession, root: str, wanted: list[date]) -> list[str]:
    """Folders of visible batches that hold some days; nothing is asked of other days or batches."""
    holders: dict[str, set[str]] = {}
    for day in wanted:
        for folder in layout.batch_names(paths.child_folders(spark, f"{root}/{DAYS}/dt={day}")):
            holders.setdefault(folder, set()).add(str(day))
    if not holders:
        return []
    now = layout.read_layout(spark, root, ids=(), removals=False)
    merged = set(now.merged.values())
    found = []
    for folder, own in sorted(holders.items()):
        alone = folder not in now.merged and paths.matches(spark, f"{batches.batch_folder(root, 'manifest', folder)}/part-*")
        if folder in merged or alone:
            pattern = f"{batches.batch_folder(root, DATA, folder)}/kind=*/dt={{{','.join(sorted(own))}}}"
            found += paths.matching(spark, pattern)
    return found


def compact(spark: SparkSession, root: str, small_rows: int = SMALL_ROWS) -> str | None:
    """Merge the batches with fewer than ``small_rows`` rows; the new folder, None without two of them.

    Readers get all of the merge or nothing of it, and those that began before keep the
    old folders until :func:`drop_old` deletes these. Records keep their batch's id. A
    merged batch that is no longer small is left alone, so a row is written again only
    a few times, however long the lake lives.
    """
    now = layout.read_layout(spark, root)
    sizes = batch_counts(spark, root, sorted({now.folder(i) for i in now.ids})).groupBy("batch_id").agg(F.sum("row_count").alias("n"))
    known = {r["batch_id"]: r["n"] for r in sizes.collect()}
    small = {f for f in (now.folder(i) for i in now.ids) if known.get(f, 0) < small_rows}
    if len(small) < 2:
        return None
    ids = sorted(i for i in now.ids if now.folder(i) in small)

    def write(folder: str) -> None:
        rows = batches.visible(spark, root, DATA, LAKE, ids, now).withColumnRenamed("batch_id", "from_batch")
        counts = _write_data(spark, rows, root, folder)
        if paths.exists(spark, f"{root}/{SOURCES}"):
            sources = batches.visible(spark, root, SOURCES, SOURCE, ids, now).withColumnRenamed("batch_id", "from_batch")
            sources.coalesce(1).write.parquet(batches.batch_folder(root, SOURCES, folder))
        _write_counts(spark, counts, root, folder)

    return batches.merge(spark, root, ids, now, write)


def drop_old(spark: SparkSession, root: str, grace: timedelta = timedelta(days=1)) -> list[str]:
    """Delete the data of folders that were merged at least ``grace`` ago; their names."""
    names = layout.drop_old_folders(spark, root, [DATA, SOURCES], grace)
    for folder in names:
        for day in paths.child_folders(spark, f"{root}/{DAYS}"):
            paths.delete_folder(spark, f"{root}/{DAYS}/{day}/batch_id={folder}")
    return names


def run_metrics(records: DataFrame) -> DataFrame:
    """Records per kind and day, plus a total line with the run's status."""
    return metric_lines(records.groupBy("kind", "dt").agg(F.count("*").alias("row_count")))


def metric_lines(counts: DataFrame) -> DataFrame:
    """The same from rows counted per kind and day."""
    lines = counts.select(
        F.lit("partition").alias("line"), "kind", F.col("dt").cast("string").alias("dt"), "row_count", F.lit(None).cast("string").alias("status")
    )
    # The total sums the lines, which is empty-safe: no lines, zero rows.
    total = counts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")).select(
        F.lit("total").alias("line"),
        F.lit(None).cast("string").alias("kind"),
        F.lit(None).cast("string").alias("dt"),
        "row_count",
        F.when(F.col("row_count") > 0, F.lit("SUCCESS")).otherwise(F.lit("IDLE")).alias("status"),
    )
    return lines.unionByName(total)


def write_metrics(spark: SparkSession, root: str, batch_id: str) -> None:
    """Store a batch's metrics beside it, from what was counted while it was written."""
    lines = batch_counts(spark, root, [batch_id])
    metric_lines(lines).coalesce(1).write.mode("overwrite").parquet(batches.batch_folder(root, METRICS, batch_id))


def write_idle(spark: SparkSession, root: str, run_id: str) -> None:
    """Store the metrics of a run that found nothing to archive."""
    nothing = spark.createDataFrame([], COUNT)
    metric_lines(nothing).coalesce(1).write.mode("overwrite").parquet(batches.batch_folder(root, METRICS, run_id))


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Metrics of all runs, idle ones included."""
    return spark.read.parquet(f"{root}/{METRICS}")
