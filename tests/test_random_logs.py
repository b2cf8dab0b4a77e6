"""Fast forms against full joins on random logs with heavy users, orders and copies."""

import random

import literal_forms
import pytest
from fixtures import Log, values

from eventmere.operators import archive, purge
from eventmere.plans import facts, panels, reports
from eventmere.schemas import TABLES, WIDE
from eventmere.sources import tables


def random_log(seed: int) -> Log:
    rnd = random.Random(seed)
    log = Log()
    for i in range(400):
        user = 1 if rnd.random() < 0.35 else rnd.randint(2, 40)
        creator = rnd.choice([101, 101, 102, 103, 104, 105, 106])
        when = f"2024-03-{rnd.randint(1, 28):02d} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00"
        kind = rnd.choice(["view", "cart", "stall", "pay", "other"])
        if kind == "view":
            log.view(f"v{i}", user, rnd.choice(["google", "direct", "mail"]), creator, rnd.randint(1, 5), when)
        elif kind == "cart":
            log.cart(f"c{i}", user, rnd.randint(1, 5), creator, when)
        elif kind == "stall":
            log.stall(f"s{i}", user, rnd.randint(-2, 30), creator, rnd.randint(1, 5), when)
        elif kind == "pay":
            tasks = [rnd.choice(["PENDING", "DONE"]) for _ in range(rnd.choice([0, 1, 1, 1, 2, 40]))]
            log.pay(f"p{i}", user, rnd.choice(["SUCCESS", "SUCCESS", "FAIL"]), tasks, creator, when)
        else:
            log.event(f"o{i}", user, creator, rnd.choice(["signup", "Video_Start", "CART_ADD"]), when)
    return log


@pytest.fixture(params=[1, 2], scope="module")
def live(request, spark):
    return random_log(request.param).tables(spark)


def test_reports(live):
    records = archive.wide(live).persist()
    for literal in literal_forms.REPORTS:
        report = getattr(reports, literal.__name__)
        reduced = report(facts.from_tables(live))
        expected = values(literal(live).select(*reduced.columns))
        assert values(reduced) == expected, literal.__name__
        assert values(report(facts.from_records(records))) == expected, literal.__name__
    records.unpersist()


def test_wide_and_kinds(live):
    names = WIDE.fieldNames()
    assert values(archive.wide(live), *names) == values(literal_forms.wide(live), *names)
    kinds = [archive.of_kind(live, k).count() for k in ("page_view", "cart_add", "video_buffering", "payment")]
    assert sum(kinds) + archive.of_other_kinds(live).count() == archive.wide(live).count()


def test_panels_by_plain_python(live):
    rows = sorted(archive.wide(live).collect(), key=lambda r: (r.created_at, r.event_id))
    first = {}
    for r in rows:
        if r.event_type == "page_view":
            first.setdefault(r.user_id, r.referrer)
    stalls = [r for r in rows if any(w in r.event_type.lower() for w in ("buffering", "video")) and r.user_id in first]
    counts = {}
    seconds = {}
    for r in stalls:
        counts[first[r.user_id]] = counts.get(first[r.user_id], 0) + 1
        if r.buffering_duration is not None:
            seconds.setdefault(r.creator_id, []).append(r.buffering_duration)
    records = archive.wide(live)
    assert dict(values(panels.first_referrer_per_user(records))) == first
    assert dict(values(panels.buffering_by_first_referrer(records))) == counts
    ranked = sorted((-(sum(s) / len(s)), c) for c, s in seconds.items())[:5]
    got = [(-r.avg_buffering_duration, r.creator_id) for r in panels.top_creators_by_buffering(records).collect()]
    assert got == ranked
    for creator, carts, paid, rate in values(panels.cart_dropout_by_creator(records)):
        mine = [r for r in rows if r.creator_id == creator]
        assert carts == sum(r.event_type == "cart_add" for r in mine)
        assert paid == sum(r.event_type == "payment" and r.payment_status == "SUCCESS" for r in mine)
        assert rate == max(carts - paid, 0) / carts * 100


def test_purge_and_rebuild(live):
    gone = purge.event_keys(live.master_event_logs.filter("created_at < '2024-03-15'"))
    kept = purge.retained(live, gone)
    again = tables.from_records(archive.wide(kept), live.users)
    for name in ("master_event_logs", "payment_details", "payment_tasks", "page_view_details"):
        columns = [c for c in TABLES[name].columns if c not in ("task_id", "updated_at")]
        assert values(again[name], *columns) == values(kept[name], *columns), name
