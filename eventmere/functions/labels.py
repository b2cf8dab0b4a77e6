"""Text built from other columns: ids, names, stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmere.schemas import NO_KIND


def order_label(created_at: Column, number: Column) -> Column:
    """Order id such as ``ORD-20240131-123456``."""
    return F.concat_ws("-", F.lit("ORD"), F.date_format(created_at, "yyyyMMdd"), number.cast("string"))


def role_email(role: Column, user_id: Column) -> Column:
    return F.concat(F.lower(role), F.lit("_"), user_id.cast("string"), F.lit("@example.com"))


def role_name(role: Column, user_id: Column) -> Column:
    return F.concat(F.initcap(role), F.lit("_"), user_id.cast("string"))


def creator_label(creator_id: Column) -> Column:
    return F.concat(F.lit("Creator "), creator_id.cast("string"))


def short_agent(user_agent: Column) -> Column:
    """First 15 characters, as shown in a capture log line."""
    return F.substring(user_agent, 1, 15)


def minute_stamp(at: Column) -> Column:
    """Batch stamp such as ``20240131_1205``."""
    return F.date_format(at, "yyyyMMdd_HHmm")


def day_text(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd")


def kind_of(event_type: Column) -> Column:
    """Folder label of an event type; a folder name cannot be empty."""
    return F.coalesce(F.nullif(F.lower(event_type), F.lit("")), F.lit(NO_KIND))


def stable_uuid(*parts: Column) -> Column:
    """UUID-shaped id that is the same for the same parts, so a retried job makes the same ids.

    Parts are length-prefixed, so neighbouring values cannot run into each other.
    """
    framed = [
        F.coalesce(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("~"))
        for p in parts
    ]
    digest = F.sha2(F.concat(*framed), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def task_key(order_id: Column) -> Column:
    """Task id derived from the order, the same on every run."""
    return F.xxhash64(order_id)
