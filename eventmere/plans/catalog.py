"""Runnable queries by name; each takes (spark, folder of the given tables).

All read the whole ``events`` table through :mod:`eventmere.sources.driver_tables`.
Times are returned as microseconds since 1970, UTC.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.functions import labels
from eventmere.functions.exact import ratio_2dp
from eventmere.operators import archive, dedupe, ingest, integrity, purge
from eventmere.plans import facts, panels, reports
from eventmere.schemas import KIND_COLUMNS, RAW_EVENT, WIDE, record_columns
from eventmere.session import use_utc
from eventmere.sources import batches, driver_tables, lake, paths, tables, text_lake
from eventmere.streaming.archive import archive_once, archive_stream, purge_archived, purge_until
from eventmere.streaming.capture import capture, events_of, read_rejected, read_unreadable, seed_users, watch_parquet

Query = Callable[[SparkSession, str], DataFrame]

CUTOFF = datetime(2024, 1, 15, 12, 0, 0)
FIRST_DAY, LAST_DAY = "2024-01-10", "2024-01-15"
EMPTY_DAY = "1999-01-01"
HOT_ORDER = "ORD-hot"


def _live(spark: SparkSession, sf_dir: str) -> tables.Tables:
    use_utc(spark)
    return driver_tables.tables(spark, sf_dir)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return driver_tables.raw_events(driver_tables.read_events(spark, sf_dir))


def _micros(df: DataFrame) -> DataFrame:
    """Times as numbers, so engines with different time types compare equal."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    out = [F.unix_micros(F.col(c)).alias(c.removesuffix("_at") + "_us") if c in times else F.col(c) for c in df.columns]
    return df.select(*out)


# -- lake ------------------------------------------------------------------

_lakes: dict[tuple[str, str], str] = {}


def _new_lake(spark: SparkSession, sf_dir: str) -> str:
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, archive.wide(_live(spark, sf_dir)), root, "all")
    return root


def _lake_root(spark: SparkSession, sf_dir: str) -> str:
    """The archived events; written once per session, as reports share one lake."""
    use_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lakes:
        _lakes[key] = _new_lake(spark, sf_dir)
    return _lakes[key]


def _lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.read(spark, _lake_root(spark, sf_dir))


def _partition_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("kind", "dt").agg(F.count("*").alias("row_count"))


def archive_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partition_counts(lake.read(spark, _new_lake(spark, sf_dir)))


def archive_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _new_lake(spark, sf_dir)
    lake.write_metrics(spark, root, "all")
    return spark.read.parquet(batches.batch_folder(root, "metrics", "all"))


def lake_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(_lake(spark, sf_dir).select(*WIDE.fieldNames(), "kind", "dt"))


def lake_range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partition_counts(lake.read_range(spark, _lake_root(spark, sf_dir), FIRST_DAY, LAST_DAY))


def _compacted_lake(spark: SparkSession, sf_dir: str) -> str:
    """The archived events in batches of four days each and one of all weeks, merged but for the last."""
    use_utc(spark)
    key = (spark.sparkContext.applicationId, f"compacted {sf_dir}")
    if key not in _lakes:
        root = paths.fresh_folder(spark, "lake")
        records = _lake(spark, sf_dir).select(*WIDE.fieldNames())
        late = F.col("event_id").cast("bigint") % 10 == 0
        for part in range(8):
            lake.write_batch(spark, records.filter(~late & (F.expr("day(created_at) div 4") == part)), root, f"part-{part}")
        lake.compact(spark, root)
        lake.write_batch(spark, records.filter(late), root, "late")
        _lakes[key] = root
    return _lakes[key]


def lake_compacted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(lake.read(spark, _compacted_lake(spark, sf_dir)).select(*WIDE.fieldNames(), "kind", "dt"))


def lake_compacted_range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partition_counts(lake.read_range(spark, _compacted_lake(spark, sf_dir), FIRST_DAY, LAST_DAY))


def lake_rebuilt_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = tables.from_records(_lake(spark, sf_dir).select(*WIDE.fieldNames()), _live(spark, sf_dir).users)
    return tables.row_counts(rebuilt)


def _text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived records as text, some of it unreadable."""
    n = F.col("event_id").cast("bigint")
    creator, lecture = F.col("creator_id").cast("string"), F.col("lecture_id").cast("string")
    seconds = F.col("buffering_duration").cast("string")
    stamp = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    records = archive.wide(_live(spark, sf_dir))
    spoiled = {
        "creator_id": F.when(n % 7 == 0, F.concat(creator, F.lit(".0")))
        .when(n % 7 == 1, F.lit("n/a"))
        .when(n % 7 == 2, F.concat(F.lit(" "), creator, F.lit(" ")))
        .otherwise(creator),
        "lecture_id": F.when(n % 4 == 0, F.concat(lecture, F.lit(".0"))).when(n % 4 == 1, F.lit("1d")).otherwise(lecture),
        "buffering_duration": F.when(n % 5 == 0, F.lit("abc"))
        .when(n % 5 == 1, F.concat(seconds, F.lit(".5")))
        .otherwise(seconds),
        "created_at": F.when(n % 11 == 0, F.lit("not a time"))
        .when(n % 11 == 1, F.concat(stamp, F.lit("+00:00")))
        .otherwise(stamp),
    }
    return records.select(*[spoiled.get(c, F.col(c).cast("string")).alias(c) for c in records.columns])


def lake_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(text_lake.normalize(_text_records(spark, sf_dir)).select(
        "event_id", "creator_id", "lecture_id", "buffering_duration", "created_at"
    ))


# -- archive ---------------------------------------------------------------


def archive_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(archive.wide(_live(spark, sf_dir)))


def archive_wide_many_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third task belongs to one order as well."""
    live = _live(spark, sf_dir)
    tasks = live.payment_tasks
    first = tasks.filter("task_id % 3 = 0").withColumn("order_id", F.lit(HOT_ORDER))
    orders = live.payment_details.withColumn(
        "order_id", F.when(F.col("event_id").cast("bigint") % 1000 == 1, F.lit(HOT_ORDER)).otherwise(F.col("order_id"))
    )
    return _micros(archive.wide(live.with_tables(payment_tasks=tasks.unionByName(first), payment_details=orders)))


def _archive_kind(kind: str) -> Query:
    return lambda spark, sf_dir: _micros(archive.of_kind(_live(spark, sf_dir), kind))


def archive_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(archive.of_other_kinds(_live(spark, sf_dir)))


def archive_cutoff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = archive.up_to(_live(spark, sf_dir).master_event_logs, CUTOFF)
    return events.groupBy("event_type").agg(F.count("*").alias("row_count"))


# -- reports and panels ----------------------------------------------------


def _report(report: Callable[[facts.Facts], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(facts.from_tables(_live(spark, sf_dir)))


def _lake_report(report: Callable[[facts.Facts], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(facts.from_records(_lake(spark, sf_dir)))


def _panel(panel: Callable[[DataFrame], DataFrame], first: str | None = None, last: str | None = None) -> Query:
    return lambda spark, sf_dir: panel(lake.read_range(spark, _lake_root(spark, sf_dir), first, last))


# -- ingest ----------------------------------------------------------------


def _routed(table: str, *hidden: str) -> Query:
    return lambda spark, sf_dir: _micros(ingest.route(_raw(spark, sf_dir))[table].drop(*hidden))


def _spoiled_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming events of which some break rules; one order and one event id come very often."""
    n = F.col("event_id").cast("bigint")
    return _raw(spark, sf_dir).select(
        F.when(n % 10 == 7, F.lit("E-same")).otherwise(F.col("event_id")).alias("event_id"),
        F.when(n % 50 != 0, F.col("user_id")).alias("user_id"),
        "creator_id",
        "event_type",
        "created_at",
        F.when(n % 40 != 1, F.col("lecture_id")).alias("lecture_id"),
        "referrer",
        "buffering_duration",
        F.when(n % 30 == 11, F.repeat("user_agent", F.lit(20))).otherwise(F.col("user_agent")).alias("user_agent"),
        F.when((n % 3 == 0) & F.col("order_id").isNotNull(), F.lit("ORD-same")).otherwise(F.col("order_id")).alias("order_id"),
        "amount",
        "status",
        "error_code",
    )


def _some_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live(spark, sf_dir).users.filter("user_id < 1000 OR user_id % 20 != 5")


def ingest_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = ingest.accept(_spoiled_raw(spark, sf_dir), _some_users(spark, sf_dir))
    return _micros(accepted.select("event_id", "user_id", "event_type", "created_at", "order_id"))


def ingest_rejected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.rejected_counts(_spoiled_raw(spark, sf_dir), _some_users(spark, sf_dir))


def users_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the users exist; all come again under another name."""
    users = _live(spark, sf_dir).users
    again = users.withColumn("name", F.concat(F.lit("again_"), F.col("user_id").cast("string")))
    return _micros(dedupe.add_absent(users.filter("user_id % 2 = 0"), again, "user_id"))


# -- purge and checks ------------------------------------------------------


def _cutoff_keys(live: tables.Tables) -> DataFrame:
    return purge.event_keys(archive.up_to(live.master_event_logs, CUTOFF))


def purge_deleted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = _live(spark, sf_dir)
    return purge.removed_counts(live, _cutoff_keys(live))


def _purge_retained(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        live = _live(spark, sf_dir)
        return _micros(purge.retained(live, _cutoff_keys(live))[table])

    return query


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.constraint_report(_live(spark, sf_dir))


def _spoiled_tables(live: tables.Tables) -> tables.Tables:
    """Every kind of rule broken by some rows; a third of all orders share one id."""
    n = F.col("event_id").cast("bigint")

    def when(condition: Column, value: Column, column: str) -> Column:
        return F.when(condition, value).otherwise(F.col(column)).alias(column)

    events = live.master_event_logs
    return live.with_tables(
        master_event_logs=events.unionByName(events.filter(n % 50 == 3)).select(
            "event_id",
            when(n % 70 == 2, F.lit(-1), "user_id"),
            when(n % 90 == 1, F.lit(None), "creator_id"),
            "event_type",
            "created_at",
        ),
        page_view_details=live.page_view_details.select(
            "event_id", "lecture_id", when(n % 30 == 4, F.repeat("referrer", F.lit(20)), "referrer")
        ),
        cart_add_details=live.cart_add_details.select("event_id", when(n % 20 == 6, F.lit(None), "lecture_id")),
        video_buffering_details=live.video_buffering_details.select(
            when(n % 25 == 0, F.concat(F.lit("x"), F.col("event_id")), "event_id"),
            "lecture_id",
            "buffering_duration",
            "user_agent",
        ),
        payment_details=live.payment_details.select(
            "event_id", when(n % 3 == 0, F.lit("ORD-same"), "order_id"), "amount", "status", "error_code"
        ),
    )


def constraint_report_spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.constraint_report(_spoiled_tables(_live(spark, sf_dir)))


# -- streaming -------------------------------------------------------------


def _capture(spark: SparkSession, sf_dir: str, root: str, condition: str = "true") -> None:
    """Stream the events table into a store of committed batches."""
    use_utc(spark)
    schema = driver_tables.read_events(spark, sf_dir).schema
    stream = driver_tables.raw_events(watch_parquet(spark, f"{sf_dir}/events.parquet", schema)).filter(condition)
    capture(stream, root, paths.fresh_folder(spark, "capture-checkpoint")).awaitTermination()


def _captured(spark: SparkSession, sf_dir: str) -> str:
    root = paths.fresh_folder(spark, "store")
    _capture(spark, sf_dir, root)
    return root


def stream_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = batches.read_tables(spark, _captured(spark, sf_dir))
    return tables.row_counts(stored).filter("table_name != 'users'")


def stream_archive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, target = _captured(spark, sf_dir), paths.fresh_folder(spark, "lake")
    archive_stream(spark, root, target, paths.fresh_folder(spark, "archive-checkpoint")).awaitTermination()
    return _partition_counts(lake.read(spark, target))


def stream_ingest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured events with all their details."""
    return _micros(archive.wide(batches.read_tables(spark, _captured(spark, sf_dir))).drop("task_status", "retry_count"))


def stream_archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events captured, archived and read back, all columns."""
    root, target = _captured(spark, sf_dir), paths.fresh_folder(spark, "lake")
    archive_once(spark, root, target, paths.fresh_folder(spark, "archive-checkpoint"))
    return _micros(lake.read(spark, target).select(*WIDE.fieldNames(), "kind", "dt"))


def archive_idle_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total lines of three archive runs: before the first capture, after it, and once more."""
    root, target = paths.fresh_folder(spark, "store"), paths.fresh_folder(spark, "lake")
    checkpoint = paths.fresh_folder(spark, "archive-checkpoint")
    archive_once(spark, root, target, checkpoint)
    _capture(spark, sf_dir, root)
    archive_once(spark, root, target, checkpoint)
    archive_once(spark, root, target, checkpoint)
    return lake.read_metrics(spark, target).filter("line = 'total'").select("row_count", "status")


def _purged(spark: SparkSession, sf_dir: str) -> tables.Tables:
    """Events with an even id are archived; odd ones come after that and before the purge."""
    root, target = paths.fresh_folder(spark, "store"), paths.fresh_folder(spark, "lake")
    _capture(spark, sf_dir, root, "CAST(event_id AS BIGINT) % 2 = 0")
    archive_once(spark, root, target, paths.fresh_folder(spark, "archive-checkpoint"))
    _capture(spark, sf_dir, root, "CAST(event_id AS BIGINT) % 2 = 1")
    purge_archived(spark, root, target)
    return batches.read_tables(spark, root)


def store_purged_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(_purged(spark, sf_dir).master_event_logs)


def store_purged_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(_purged(spark, sf_dir).payment_tasks.drop("task_id"))


def _purged_until(spark: SparkSession, sf_dir: str) -> str:
    """Events with an even id are archived; odd ones come after that. Then the cutoff purge."""
    key = (spark.sparkContext.applicationId, f"purged until {sf_dir}")
    if key not in _lakes:
        root, target = paths.fresh_folder(spark, "store"), paths.fresh_folder(spark, "lake")
        _capture(spark, sf_dir, root, "CAST(event_id AS BIGINT) % 2 = 0")
        archive_once(spark, root, target, paths.fresh_folder(spark, "archive-checkpoint"))
        _capture(spark, sf_dir, root, "CAST(event_id AS BIGINT) % 2 = 1")
        purge_until(spark, root, target, CUTOFF)
        _lakes[key] = root
    return _lakes[key]


def store_cutoff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table after archived events up to the cutoff were removed."""
    stored = batches.read_tables(spark, _purged_until(spark, sf_dir))
    return tables.row_counts(stored).filter("table_name != 'users'")


def store_cutoff_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(batches.read_tables(spark, _purged_until(spark, sf_dir)).payment_tasks.drop("task_id"))


def store_merged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left after the cutoff, with all details, from batches merged into one."""
    root = _purged_until(spark, sf_dir)
    batches.merge_tables(spark, root)
    return _micros(archive.wide(batches.read_tables(spark, root)).drop("task_status", "retry_count"))


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What capture left out of incoming events of which some break rules."""
    inbox, root = paths.fresh_folder(spark, "inbox"), paths.fresh_folder(spark, "store")
    _spoiled_raw(spark, sf_dir).write.parquet(inbox)
    stream = watch_parquet(spark, inbox, RAW_EVENT)
    capture(stream, root, paths.fresh_folder(spark, "capture-checkpoint"), _some_users(spark, sf_dir)).awaitTermination()
    return _micros(read_rejected(spark, root).select("event_id", "user_id", "event_type", "created_at", "reject_reason"))


def _message_store(spark: SparkSession, sf_dir: str) -> str:
    """Events as JSON messages, of which every tenth is cut off."""
    use_utc(spark)
    key = (spark.sparkContext.applicationId, f"messages {sf_dir}")
    if key not in _lakes:
        inbox, root = paths.fresh_folder(spark, "inbox"), paths.fresh_folder(spark, "store")
        raw = _raw(spark, sf_dir)
        n = F.col("event_id").cast("bigint")
        whole = F.to_json(F.struct(*RAW_EVENT.fieldNames()), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
        cut = F.concat(F.lit('{"event_id": "'), F.col("event_id"))
        messages = raw.select(
            F.lit("events").alias("topic"), (n % 4).cast("int").alias("partition"), n.alias("offset"),
            F.when(n % 10 == 3, cut).otherwise(whole).cast("binary").alias("value"),
        )
        messages.write.parquet(inbox)
        stream = events_of(watch_parquet(spark, inbox, messages.schema))
        capture(stream, root, paths.fresh_folder(spark, "capture-checkpoint")).awaitTermination()
        _lakes[key] = root
    return _lakes[key]


def stream_message_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events captured from messages, with all their details."""
    stored = batches.read_tables(spark, _message_store(spark, sf_dir))
    return _micros(archive.wide(stored).drop("task_status", "retry_count"))


def stream_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that hold no event, with where they came from."""
    kept = read_unreadable(spark, _message_store(spark, sf_dir))
    return kept.select("topic", "partition", "offset", F.col("content").cast("string").alias("content"))


def store_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the users are seeded; all come again under another name, twice."""
    root, users = paths.fresh_folder(spark, "store"), _live(spark, sf_dir).users
    again = users.withColumn("name", F.concat(F.lit("again_"), F.col("user_id").cast("string")))
    seed_users(spark, root, users.filter("user_id % 2 = 0"), "first")
    seed_users(spark, root, again, "second")
    seed_users(spark, root, again, "third")
    return _micros(batches.read_tables(spark, root).users)


# -- text lake ---------------------------------------------------------------


def _text_lake(spark: SparkSession, sf_dir: str) -> str:
    use_utc(spark)
    key = (spark.sparkContext.applicationId, f"text {sf_dir}")
    if key not in _lakes:
        root = paths.fresh_folder(spark, "text-lake")
        lake.write_csv(archive.wide(_live(spark, sf_dir)), root)
        _lakes[key] = root
    return _lakes[key]


def text_lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text_lake.read(spark, _text_lake(spark, sf_dir))
    rows = rows.withColumn("buffering_duration", F.col("buffering_duration").cast("int"))
    return _micros(rows.select(*WIDE.fieldNames(), "kind", "dt"))


def text_lake_range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partition_counts(text_lake.read(spark, _text_lake(spark, sf_dir), FIRST_DAY, LAST_DAY))


def text_lake_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each kind in three forms: as declared, turned round with a column more, and without the last column."""
    use_utc(spark)
    root = paths.fresh_folder(spark, "text-lake")
    tagged = lake.with_folders(archive.wide(_live(spark, sf_dir)))
    form = F.col("event_id").cast("bigint") % 3
    for kind in KIND_COLUMNS:
        names = record_columns(kind)
        extra = F.lit("a, b").alias("note")
        for n, columns in enumerate((names, [*reversed(names[1:]), extra, names[0]], names[:-1])):
            rows = tagged.filter((F.col("kind") == kind) & (form == n)).select(*columns, "dt")
            lake.write_csv_files(rows, f"{root}/kind={kind}", ["dt"], mode="append")
    return _micros(text_lake.read(spark, root).select("event_id", "user_id", "created_at", "lecture_id", "user_agent", "order_id", "retry_count", "kind", "dt"))


# -- scalar functions ------------------------------------------------------


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels, stamps and guards of every event in one projection."""
    n = F.col("event_id").cast("bigint")
    at = F.col("created_at")
    return _raw(spark, sf_dir).select(
        "event_id",
        labels.order_label(at, F.lit(100000) + n % 900000).alias("order_label"),
        labels.role_email(F.lit("STUDENT"), F.col("user_id")).alias("email"),
        labels.role_name(F.lit("STUDENT"), F.col("user_id")).alias("name"),
        labels.creator_label(F.col("creator_id")).alias("creator"),
        labels.short_agent(F.col("user_agent")).alias("agent_start"),
        labels.minute_stamp(at).alias("minute_stamp"),
        labels.day_text(at).alias("day_text"),
        F.to_date(at).alias("day"),
        F.date_add(F.to_date(at), 1).alias("next_day"),
        labels.kind_of(F.upper("event_type")).alias("kind"),
        labels.stable_uuid(F.col("user_id"), F.col("event_type"), F.col("referrer")).alias("made_id"),
        F.coalesce("lecture_id", F.lit(0)).alias("lecture_or_zero"),
        F.nullif(F.col("lecture_id"), F.lit(9)).alias("lecture_not_nine"),
        F.greatest(F.col("buffering_duration") - 10, F.lit(0)).alias("over_ten"),
        ratio_2dp(n, F.col("buffering_duration")).alias("rounded_ratio"),
    )


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        f.__name__: f
        for f in (
            archive_partition_counts,
            archive_run_metrics,
            lake_scan_all,
            lake_range_counts,
            lake_rebuilt_tables,
            lake_normalize,
            archive_wide,
            archive_other,
            archive_cutoff_counts,
            ingest_accepted,
            ingest_rejected_counts,
            users_insert_if_absent,
            purge_deleted_counts,
            constraint_report,
            constraint_report_spoiled,
            stream_ingest_counts,
            stream_archive_counts,
            stream_ingest_scan,
            stream_archive_scan,
            stream_rejected,
            stream_message_scan,
            stream_unreadable,
            archive_idle_metrics,
            archive_wide_many_tasks,
            store_purged_master,
            store_purged_tasks,
            store_users,
            store_cutoff_counts,
            store_cutoff_tasks,
            store_merged_scan,
            lake_compacted_scan,
            lake_compacted_range_counts,
            text_lake_scan,
            text_lake_range_counts,
            text_lake_mixed_headers,
            scalar_functions,
        )
    }
    named["table_row_counts"] = lambda spark, sf_dir: tables.row_counts(_live(spark, sf_dir))
    for kind in ("page_view", "cart_add", "video_buffering", "payment"):
        named[f"archive_{kind}"] = _archive_kind(kind)
    for report in (
        reports.cart_dropout_by_lecture,
        reports.channel_buffering_quality,
        reports.outbox_stuck_rate,
        reports.creator_buffering_risk,
    ):
        named[report.__name__] = _report(report)
        named[f"lake_{report.__name__}"] = _lake_report(report)
    for panel in (
        panels.cart_dropout_by_creator,
        panels.buffering_by_first_referrer,
        panels.outbox_volumes,
        panels.top_creators_by_buffering,
    ):
        named[f"dash_{panel.__name__}"] = _panel(panel)
        named[f"dash_{panel.__name__}_range"] = _panel(panel, FIRST_DAY, LAST_DAY)
        named[f"dash_{panel.__name__}_empty_range"] = _panel(panel, EMPTY_DAY, EMPTY_DAY)
    named["first_referrer_per_user"] = _panel(panels.first_referrer_per_user)
    named["ingest_master"] = _routed("master_event_logs")
    named["ingest_page_view"] = _routed("page_view_details")
    named["ingest_cart_add"] = _routed("cart_add_details")
    named["ingest_video_buffering"] = _routed("video_buffering_details")
    named["ingest_payment"] = _routed("payment_details")
    # Task ids are hashes no other engine computes; their uniqueness is tested apart.
    named["ingest_outbox_tasks"] = _routed("payment_tasks", "task_id")
    named["purge_retained_master"] = _purge_retained("master_event_logs")
    named["purge_retained_tasks"] = _purge_retained("payment_tasks")
    return named
