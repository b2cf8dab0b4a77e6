from fixtures import Log, at

from eventmere.operators import integrity
from eventmere.schemas import TABLES
from eventmere.sources import driver_tables


def broken_rules(tables):
    rows = integrity.constraint_report(tables).collect()
    return {(r.table_name, r.rule, r.column_name): r.violations for r in rows if r.violations}


def good():
    log = Log().view("v", 1, "google").cart("c", 1).stall("s", 2, 9).pay("p", 1, tasks=["DONE"])
    return log


def test_every_declared_rule_has_one_line(spark):
    rows = [(r.table_name, r.rule, r.column_name) for r in integrity.constraint_report(good().tables(spark)).collect()]
    expected = 0
    for spec in TABLES.values():
        expected += len(spec.required) + len(spec.max_length) + 1 + len(spec.unique) + len(spec.foreign_keys)
    assert len(rows) == len(set(rows)) == expected


def test_good_tables_break_nothing(spark):
    assert broken_rules(good().tables(spark)) == {}
    assert broken_rules(Log().tables(spark)) == {}
    assert broken_rules(driver_tables.tables(spark, "/root/testdata/sf0.001")) == {}


def test_each_rule_broken_once(spark):
    log = good()
    log.rows["users"] += [(1, "other@example.com", "n", "r", at("2024-01-01")), (50, "p1@example.com", "n" * 51, "r", None)]
    log.rows["master_event_logs"] += [
        ("v", 1, 1, "page_view", at("2024-01-01")),
        ("m1", 99, 98, "k" * 51, at("2024-01-01")),
        (None, None, 1, None, None),
    ]
    log.rows["page_view_details"] += [("v", 1, "r" * 101), ("ghost", None, "x")]
    log.rows["cart_add_details"] += [("c", 1), ("c", 1)]
    log.rows["video_buffering_details"] += [(None, 1, None, "u" * 256)]
    log.rows["payment_details"] += [("c", "ORD-p", 5, "s" * 21, "e" * 51)]
    log.rows["payment_tasks"] += [(0, "ORD-nobody", "DONE", 0, at("2024-01-01")), (9, None, "DONE", 0, None)]
    assert broken_rules(log.tables(spark)) == {
        ("users", "primary_key", "user_id"): 1,
        ("users", "unique", "email"): 1,
        ("users", "max_length", "name"): 1,
        ("users", "not_null", "joined_at"): 1,
        ("master_event_logs", "primary_key", "event_id"): 1,
        ("master_event_logs", "foreign_key", "user_id"): 1,
        ("master_event_logs", "foreign_key", "creator_id"): 1,
        ("master_event_logs", "max_length", "event_type"): 1,
        ("master_event_logs", "not_null", "event_id"): 1,
        ("master_event_logs", "not_null", "user_id"): 1,
        ("master_event_logs", "not_null", "event_type"): 1,
        ("master_event_logs", "not_null", "created_at"): 1,
        ("page_view_details", "primary_key", "event_id"): 1,
        ("page_view_details", "foreign_key", "event_id"): 1,
        ("page_view_details", "max_length", "referrer"): 1,
        ("page_view_details", "not_null", "lecture_id"): 1,
        ("cart_add_details", "primary_key", "event_id"): 2,
        ("video_buffering_details", "not_null", "event_id"): 1,
        ("video_buffering_details", "not_null", "buffering_duration"): 1,
        ("video_buffering_details", "max_length", "user_agent"): 1,
        ("payment_details", "unique", "order_id"): 1,
        ("payment_details", "max_length", "status"): 1,
        ("payment_details", "max_length", "error_code"): 1,
        ("payment_tasks", "primary_key", "task_id"): 1,
        ("payment_tasks", "foreign_key", "order_id"): 1,
        ("payment_tasks", "not_null", "order_id"): 1,
        ("payment_tasks", "not_null", "updated_at"): 1,
    }
