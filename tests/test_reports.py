import literal_forms
import pytest
from fixtures import Log, values

from eventmere.operators import archive
from eventmere.plans import facts, reports
from eventmere.sources import driver_tables


def live(report, tables):
    return getattr(reports, report.__name__)(facts.from_tables(tables))


@pytest.mark.parametrize("literal", literal_forms.REPORTS, ids=lambda f: f.__name__)
def test_reduced_form_equals_full_join(spark, literal):
    tables = driver_tables.tables(spark, "/root/testdata/sf0.01")
    reduced = live(literal, tables)
    assert values(reduced) == values(literal(tables).select(*reduced.columns))


def awkward(spark):
    log = Log()
    # User 1: two channels, several views each, two stalls, two orders in two lectures.
    log.view("v1", 1, "google").view("v2", 1, "google").view("v3", 1, "direct").view("v4", 1, "google")
    log.stall("s1", 1, 10).stall("s2", 1, 25, creator=2)
    log.cart("c1", 1, lecture=1).cart("c2", 1, lecture=1).cart("c3", 1, lecture=2)
    log.pay("p1", 1, tasks=["PENDING", "DONE"]).pay("p2", 1, tasks=["DONE"])
    # User 2: a channel whose users never buffer; only a failed payment, with a task.
    log.view("v5", 2, "mail").cart("c4", 2, lecture=1).pay("p3", 2, "FAIL", tasks=["PENDING"])
    # User 3: buffers without a view; pays without a task and without a cart.
    log.stall("s3", 3, 7, creator=3).pay("p4", 3)
    log.view("v6", 4, "google").stall("s4", 4, 3, creator=2)
    log.event("o1", 5, 1, "signup")
    return log.tables(spark)


@pytest.mark.parametrize("literal", literal_forms.REPORTS, ids=lambda f: f.__name__)
def test_reduced_form_equals_full_join_on_awkward_rows(spark, literal):
    tables = awkward(spark)
    reduced = live(literal, tables)
    expected = values(literal(tables).select(*reduced.columns))
    assert values(reduced) == expected
    records = archive.wide(tables)
    assert values(getattr(reports, literal.__name__)(facts.from_records(records))) == expected


def test_dropout_counts_orders_of_any_lecture(spark):
    rows = values(live(literal_forms.cart_dropout_by_lecture, awkward(spark)))
    assert rows == [(1, 2, 2, 50.0), (2, 1, 2, 0.0)]


def test_channel_mean_is_weighted_by_views(spark):
    rows = values(live(literal_forms.channel_buffering_quality, awkward(spark)))
    # google: three views of user 1 x (10 + 25), one view of user 4 x 3.
    assert rows == [("direct", 1, 2, 17.5), ("google", 4, 3, 15.43), ("mail", 1, 0, 0.0)]


def test_stuck_rate_counts_a_payment_per_task_and_failed_payments_tasks(spark):
    row = values(live(literal_forms.outbox_stuck_rate, awkward(spark)))
    assert row == [(4, 2, 50.0)]


def test_stuck_rate_without_success_is_null_in_one_row(spark):
    assert values(live(literal_forms.outbox_stuck_rate, Log().pay("p", 1, "FAIL").tables(spark))) == [(0, 0, None)]
    assert values(live(literal_forms.outbox_stuck_rate, Log().tables(spark))) == [(0, 0, None)]


def test_creator_risk_has_equal_counts(spark):
    rows = values(live(literal_forms.creator_buffering_risk, awkward(spark)))
    assert rows == [(1, 1, 1, 10.0), (2, 2, 2, 14.0), (3, 1, 1, 7.0)]


def test_reports_of_nothing_are_empty(spark):
    tables = Log().tables(spark)
    for literal in literal_forms.REPORTS:
        if literal is not literal_forms.outbox_stuck_rate:
            assert values(live(literal, tables)) == []


def test_order_is_by_metric_then_key(spark):
    log = Log().cart("a", 1, lecture=5).cart("b", 2, lecture=3).cart("c", 3, lecture=4).pay("p", 3)
    rows = [(r.lecture_id, r.dropout_rate) for r in live(literal_forms.cart_dropout_by_lecture, log.tables(spark)).collect()]
    assert rows == [(3, 100.0), (5, 100.0), (4, 0.0)]
