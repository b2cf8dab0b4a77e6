from fixtures import at, records, values

from eventmere.plans import panels


def test_missing_payment_status_is_paid_in_the_cart_panel_only(spark):
    rows = records(
        spark,
        {"event_type": "cart_add"},
        {"event_type": "cart_add"},
        {"event_type": "payment", "payment_status": None},
        {"event_type": "payment", "payment_status": "FAIL"},
    )
    assert values(panels.cart_dropout_by_creator(rows)) == [(1, 2, 1, 50.0)]
    assert values(panels.outbox_volumes(rows)) == [("Pending Outbox Tasks", 0), ("Success Payments", 0)]


def test_dropout_is_not_negative_and_needs_carts(spark):
    paid = {"event_type": "payment", "payment_status": "SUCCESS"}
    rows = records(spark, {"event_type": "cart_add"}, paid, paid, {**paid, "creator_id": 9}, {"event_type": "cart_add", "creator_id": 4})
    assert values(panels.cart_dropout_by_creator(rows)) == [(1, 1, 2, 0.0), (4, 1, 0, 100.0)]


def test_volumes_count_waiting_tasks_of_successful_payments(spark):
    def pay(status, task):
        return {"event_type": "payment", "payment_status": status, "task_status": task}

    rows = records(spark, pay("SUCCESS", "PENDING"), pay("SUCCESS", "DONE"), pay("FAIL", "PENDING"))
    assert values(panels.outbox_volumes(rows)) == [("Pending Outbox Tasks", 1), ("Success Payments", 2)]


def view(user, referrer, when, kind="page_view"):
    return {"event_type": kind, "user_id": user, "referrer": referrer, "created_at": at(when)}


def test_first_referrer_is_the_earliest_that_is_known(spark):
    rows = records(
        spark,
        view(1, "later", "2024-03-02 00:00:00"),
        view(1, "first", "2024-03-01 00:00:00"),
        view(1, None, "2024-02-01 00:00:00"),
        view(2, "b", "2024-03-01 00:00:00"),
        view(2, "a", "2024-03-01 00:00:00"),
        {**view(3, "x", "2024-03-01 00:00:00"), "created_at": None},
        view(3, "known_time", "2025-03-01 00:00:00"),
        view(4, "not_exactly_a_view", "2024-03-01 00:00:00", "Page_View"),
    )
    # User 2's views are at the same time: the lower event id counts.
    assert values(panels.first_referrer_per_user(rows)) == [(1, "first"), (2, "b"), (3, "known_time")]


def stall(user, seconds, creator=1, kind="video_buffering"):
    return {"event_type": kind, "user_id": user, "creator_id": creator, "buffering_duration": seconds}


def test_stalls_match_by_pattern_and_need_a_view(spark):
    rows = records(
        spark,
        view(1, "google", "2024-03-01 00:00:00"),
        stall(1, 5),
        stall(1, None, kind="Video_Start"),
        stall(1, 9, kind="PRE-BUFFERING"),
        stall(1, 9, kind=None),
        stall(1, 9, kind="cart_add"),
        stall(2, 50),
    )
    assert values(panels.buffering_by_first_referrer(rows)) == [("google", 3)]
    assert values(panels.top_creators_by_buffering(rows), ) == [(1, 7.0, "Creator 1")]


def test_empty_panels_show_a_stand_in(spark):
    rows = records(spark, stall(2, 50))
    assert values(panels.buffering_by_first_referrer(rows)) == [("no_matched_referrer", 0)]
    assert values(panels.top_creators_by_buffering(rows)) == [(0, 0.0, "Creator 0")]
    none = rows.limit(0)
    assert values(panels.buffering_by_first_referrer(none)) == [("no_matched_referrer", 0)]
    assert values(panels.cart_dropout_by_creator(none)) == []
    assert values(panels.outbox_volumes(none)) == [("Pending Outbox Tasks", 0), ("Success Payments", 0)]


def test_top_five_with_ties_by_creator(spark):
    seconds = {1: 10, 2: 30, 3: 20, 4: 20, 5: 20, 6: 40, 7: 20}
    rows = records(
        spark, view(1, "google", "2024-03-01 00:00:00"), *[stall(1, s, creator=c) for c, s in seconds.items()]
    )
    got = [(r.creator_id, r.avg_buffering_duration) for r in panels.top_creators_by_buffering(rows).collect()]
    assert got == [(6, 40.0), (2, 30.0), (3, 20.0), (4, 20.0), (5, 20.0)]


def test_negative_mean_is_kept(spark):
    rows = records(spark, view(1, "google", "2024-03-01 00:00:00"), stall(1, -4), stall(1, 0))
    assert values(panels.top_creators_by_buffering(rows)) == [(1, -2.0, "Creator 1")]
