"""Committed table batches to the lake, each exactly once.

The stream watches the manifest, not the tables: a new manifest row names a batch
whose files are all there. An event and its details and tasks are in one batch, so
archiving a batch needs no other.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmere.operators import archive
from eventmere.schemas import LAKE, TABLES
from eventmere.sources import batches, lake, layout, paths
from eventmere.streaming.capture import each_batch

BATCHES_PER_STEP = 200


def watch_commits(spark: SparkSession, root: str, batches_per_step: int = BATCHES_PER_STEP) -> DataFrame:
    """Stream of the ids of newly committed batches, a bounded number at a time."""
    paths.make_folder(spark, f"{root}/manifest")  # it may be watched before the first capture
    return (
        spark.readStream.schema(batches.MANIFEST)
        .option("maxFilesPerTrigger", batches_per_step)
        .parquet(f"{root}/manifest")
        .select("batch_id")
    )


def archive_stream(
    spark: SparkSession,
    root: str,
    lake_root: str,
    checkpoint: str,
    batches_per_step: int = BATCHES_PER_STEP,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Archive what was committed since the last run, then store the run's metrics.

    Run it every hour with the default trigger: it works off what is there and ends.
    """

    def handle(commits: DataFrame, batch_id: str) -> None:
        session = commits.sparkSession
        # At most batches_per_step short ids, to let the scan open only their folders.
        asked = [row["batch_id"] for row in commits.collect()]
        ids = batches.open_ids(session, root, asked)
        records = archive.wide(batches.read_tables(session, root, ids))
        lake.write_batch(session, records, lake_root, batch_id, sources=_event_counts(session, root, ids))
        lake.write_metrics(session, lake_root, batch_id)

    return each_batch(watch_commits(spark, root, batches_per_step), checkpoint, handle, trigger)


def _event_counts(spark: SparkSession, root: str, ids: list[str]) -> DataFrame:
    """Events of each of some visible batches, batches without events included."""
    schema = TABLES["master_event_logs"].schema
    counts = batches.visible(spark, root, "master_event_logs", schema, ids).groupBy("batch_id").agg(F.count("*").alias("events"))
    named = spark.createDataFrame([(i,) for i in ids], "source_id string")
    joined = named.join(counts, named["source_id"] == counts["batch_id"], "left")
    return joined.select("source_id", F.coalesce("events", F.lit(0)).cast("bigint").alias("events"))


def archive_once(
    spark: SparkSession, root: str, lake_root: str, checkpoint: str, batches_per_step: int = BATCHES_PER_STEP
) -> bool:
    """Archive what is there and end; a run that finds nothing stores an idle line. False then."""
    before = set(batches.committed_ids(spark, lake_root))
    archive_stream(spark, root, lake_root, checkpoint, batches_per_step).awaitTermination()
    worked = bool(set(batches.committed_ids(spark, lake_root)) - before)
    if not worked:
        lake.write_idle(spark, lake_root, f"idle-{uuid.uuid4().hex}")
    return worked


def purge_archived(spark: SparkSession, root: str, lake_root: str) -> list[str]:
    """Drop the table batches the lake holds; returns their ids.

    An event committed later than the archive run is in a later batch and stays.
    With nothing archived nothing is dropped. Rows are counted, not rewritten: each
    batch must still have the events that were archived from it, and each archive
    batch must hold as many events as its sources gave. Otherwise nothing is dropped.
    Events that :func:`purge_until` removed before count as had.
    """
    live = batches.committed_ids(spark, root)
    # Batches without events, such as seeded users, stay.
    archived = lake.archived_sources(spark, lake_root).filter(F.col("source_id").isin(live) & (F.col("events") > 0))
    # Ids of live batches only, so not more than there are.
    found = {row["source_id"]: (row["batch_id"], row["events"]) for row in archived.collect()}
    ids = sorted(found)
    if not ids:
        batches.retire(spark, root, [])
        return []
    now = {row["source_id"]: row["events"] for row in _event_counts(spark, root, ids).collect()}
    for row in _removed_counts(spark, root, ids).collect():
        now[row["batch_id"]] += row["events"]
    wrong = [i for i in ids if now[i] != found[i][1]]
    lakes = sorted({batch for batch, _ in found.values()})
    given = lake.archived_sources(spark, lake_root).filter(F.col("batch_id").isin(lakes)).groupBy("batch_id").agg(F.sum("events").alias("events"))
    held = batches.visible(spark, lake_root, lake.DATA, LAKE, lakes).groupBy("batch_id").agg(F.count_distinct("event_id").alias("held"))
    short = given.join(held, "batch_id", "left").filter(F.coalesce("held", F.lit(0)) != F.col("events")).collect()
    if wrong or short:
        raise RuntimeError(f"archived and live events differ: batches {wrong[:5]}, archive batches {[r['batch_id'] for r in short][:5]}")
    batches.retire(spark, root, ids)
    return ids


def _removed_counts(spark: SparkSession, root: str, ids: list[str]) -> DataFrame:
    """Events removed from each of some batches by key, merged away or not."""
    now = layout.read_layout(spark, root)
    touched = {i: list(now.removed[i]) for i in ids if i in now.removed}
    if not touched:
        return spark.createDataFrame([], "batch_id string, events bigint")
    keys = batches.removed_keys(spark, root, touched).select("batch_id", "event_id").distinct()
    return keys.groupBy("batch_id").agg(F.count("*").alias("events"))


def purge_until(spark: SparkSession, root: str, lake_root: str, cutoff: datetime) -> str | None:
    """Remove the archived events up to a time from the store, with their details and tasks.

    Only events whose id the lake holds go: an event that was committed after the
    archive run stays, although it may be older than the cutoff. No file is changed:
    the removed keys are stored, by batch, and readers leave their rows out at once;
    :func:`batches.merge_tables` writes batches without them. A run that failed is
    simply run again. Returns the purge's id, None if there was nothing to remove.
    """
    now = layout.read_layout(spark, root)
    held = lake.archived_sources(spark, lake_root).filter(F.col("source_id").isin(list(now.ids)))
    # Ids of live batches and of the archive batches that hold them.
    pairs = [(r["source_id"], r["batch_id"]) for r in held.select("source_id", "batch_id").collect()]
    if not pairs:
        return None
    sources, lakes = (sorted({p[k] for p in pairs}) for k in (0, 1))
    master = batches.visible(spark, root, "master_event_logs", TABLES["master_event_logs"].schema, sources, now)
    events = archive.up_to(master, cutoff).select("batch_id", "event_id")
    archived = archive.up_to(batches.visible(spark, lake_root, lake.DATA, LAKE, lakes), cutoff).select("event_id")
    gone = events.join(archived.hint("merge"), "event_id", "left_semi")
    payments = batches.visible(spark, root, "payment_details", TABLES["payment_details"].schema, sources, now)
    orders = payments.select("batch_id", "event_id", "order_id").hint("merge")
    keys = gone.join(orders, ["batch_id", "event_id"], "left")
    if gone.isEmpty():
        return None
    return batches.remove_rows(spark, root, keys)
