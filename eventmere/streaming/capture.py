"""Arriving events to committed table batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmere.functions import labels
from eventmere.operators import ingest
from eventmere.operators.dedupe import earliest_row
from eventmere.schemas import RAW_EVENT, TABLES
from eventmere.sources import batches, layout, paths


#: Events that were left out, with the reason; part of their batch's commit, and never purged.
REJECTED = "rejected"
#: Messages that hold no event, as they came; part of their batch's commit, and never purged.
UNREADABLE = "unreadable"
MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
#: Column of a stream that holds the message where it cannot be read, else NULL.
MESSAGE_COLUMN = "_unreadable"


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """All rejected events of committed batches, those of retired batches included."""
    schema = T.StructType([*RAW_EVENT.fields, T.StructField("reject_reason", T.StringType())])
    return _read_kept(spark, root, REJECTED, schema)


def read_unreadable(spark: SparkSession, root: str) -> DataFrame:
    """Messages of committed batches that hold no event, as they came, those of retired batches included."""
    return _read_kept(spark, root, UNREADABLE, MESSAGE)


def _read_kept(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """A table that is not purged with its batches."""
    ids = {*batches.committed_ids(spark, root), *batches.committed_ids(spark, root, "retired")}
    held = ids.intersection(layout.batch_names(paths.child_folders(spark, f"{root}/{table}")))
    folders = [batches.batch_folder(root, table, i) for i in sorted(held)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def seed_users(spark: SparkSession, root: str, users: DataFrame, batch_id: str) -> bool:
    """Commit the users the store does not have yet; False when the batch was there before.

    The batch holds users only. It is kept when event batches are retired.
    """
    known = batches.read_tables(spark, root).users
    new = earliest_row(users.select(*TABLES["users"].columns), "user_id")
    absent = new.join(known.select("user_id"), "user_id", "left_anti").select(*TABLES["users"].columns)
    return batches.commit_tables(spark, {"users": absent}, root, batch_id)


def watch_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Stream of a parquet folder's files, or of a single file.

    ``bytes_per_batch`` bounds a micro-batch, so a backlog is worked off in steps.
    """
    reader = spark.readStream.schema(schema)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    if paths.is_folder(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def watch_topic(spark: SparkSession, servers: str, topic: str, records_per_batch: int) -> DataFrame:
    """Stream of a Kafka topic holding one JSON event per message (needs the Kafka connector)."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", records_per_batch)
        .load()
    )
    return events_of(messages)


def events_of(messages: DataFrame) -> DataFrame:
    """Events of messages (``topic``, ``partition``, ``offset``, ``value``), one JSON object each.

    A message that is no object, or has a field of another type, is kept whole in
    ``MESSAGE_COLUMN``; :func:`capture` stores it apart. An event without an id gets
    one from its topic, partition and offset, which stay the same when it is read again.
    """
    schema = T.StructType([*RAW_EVENT.fields, T.StructField("_corrupt", T.StringType())])
    text = F.col("value").cast("string")
    options = {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    parsed = messages.withColumn("_event", F.from_json(text, schema, options))
    # The parser takes a list of objects for its first one, and an empty text for nothing.
    is_object = F.regexp_like(text, F.lit(r"^\s*\{"))
    good = F.coalesce(is_object & F.col("_event").isNotNull() & F.col("_event._corrupt").isNull(), F.lit(False))
    # A column of its own, so that the text is looked at once and not for every field.
    parsed, readable = parsed.withColumn("_readable", good), F.col("_readable")
    place = F.struct(
        F.col("topic").cast("string").alias("topic"), F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"), F.col("value").cast("binary").alias("content"),
    )
    made = labels.stable_uuid(F.col("topic"), F.col("partition"), F.col("offset"))
    event = [F.when(readable, F.col(f"_event.{c}")).alias(c) for c in RAW_EVENT.fieldNames() if c != "event_id"]
    event_id = F.when(readable, F.coalesce(F.col("_event.event_id"), made)).alias("event_id")
    return parsed.select(event_id, *event, F.when(~readable, place).alias(MESSAGE_COLUMN))


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """Id Spark keeps in a query's checkpoint: the same after restarts.

    It goes in front of batch numbers. They start over when a checkpoint is lost,
    and must then not be taken for batches already committed.
    """
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def each_batch(
    stream: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, str], None],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch over with its lasting id."""

    def run(batch: DataFrame, number: int) -> None:
        handle(batch, f"{run_name(batch.sparkSession, checkpoint)}-{number:010d}")

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def capture(
    raw_stream: DataFrame,
    root: str,
    checkpoint: str,
    users: DataFrame | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Route arriving events to their tables; each micro-batch commits as a whole.

    Events are checked as in :func:`ingest.accept`, also against what is stored.
    Keep the live tables small by purging, as that check reads their keys.
    """

    def handle(batch: DataFrame, batch_id: str) -> None:
        spark = batch.sparkSession
        if batches.is_committed(spark, root, batch_id):
            return
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        arrived, apart = batch, {}
        if MESSAGE_COLUMN in batch.columns:
            apart = {UNREADABLE: batch.filter(F.col(MESSAGE_COLUMN).isNotNull()).select(f"{MESSAGE_COLUMN}.*")}
            batch = batch.filter(F.col(MESSAGE_COLUMN).isNull()).drop(MESSAGE_COLUMN)
        stored = batches.read_tables(spark, root)
        # Nearly always everyone is known. Seeing that from the few distinct ids
        # saves two shuffles of the whole batch by user and by creator.
        checked = users is not None and not ingest.unknown_people(batch, users).isEmpty()
        known = users if checked else None
        # Eight tables are written from these two. Lost blocks are computed again, and give
        # the same rows: ties are broken by all columns.
        first = ingest.first_events(batch, known, stored).persist(StorageLevel.MEMORY_AND_DISK)
        payments = ingest.first_payments(first, stored).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # Counting whole events by all columns is a shuffle of the batch; two counts tell whether any is left over.
            repeats = ingest.fit_events(batch, known).count() > first.count()
            left_out = ingest.rejected(batch, known, stored, first, payments, repeats)
            frames = ingest.route(ingest.with_payments(first, payments)) | {REJECTED: left_out} | apart
            batches.commit_tables(spark, frames, root, batch_id)
        finally:
            payments.unpersist()
            first.unpersist()
            arrived.unpersist()

    return each_batch(raw_stream, checkpoint, handle, trigger)
