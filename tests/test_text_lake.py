import csv
import os

import pytest
from fixtures import at, records, text_records, values

from eventmere.plans import panels
from eventmere.schemas import record_columns
from eventmere.sources import lake, text_lake


def put(base, kind, day, rows, columns=None, name="log_daily_20240301_0001.csv"):
    folder = os.path.join(base, kind, day)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(columns or record_columns(kind))
        writer.writerows(rows)


@pytest.fixture
def base(tmp_path):
    base = str(tmp_path / "raw-data" / "shop")
    put(base, "cart_add", "2024-03-01", [["c1", 1, 2, "cart_add", "2024-03-01 10:00:00.5+00:00", 4]])
    put(base, "cart_add", "2024-03-03", [["c2", 1, 2.0, "cart_add", "2024-03-03 10:00:00", "4.0"]])
    put(base, "page_view", "2024-03-01", [
        ["v1", 1, 2, "page_view", "2024-03-01 09:00:00+00:00", 4, 'a "quoted", and\nbroken 사이트'],
        ["v2", 1, "n/a", "page_view", "2024-03-01 09:00:00+00:00", 4, "google"],
    ])
    put(base, "video_buffering", "2024-03-01", [
        ["s1", 1, 3, "video_buffering", "2024-03-01 09:30:00", 4, 12, "agent"],
        ["s2", 1, 3, "video_buffering", "no time", 4, "many", "agent"],
    ])
    put(base, "payment", "2024-03-01", [["p1", 1, 2, "payment", "2024-03-01 11:00:00", "o", 50000, "SUCCESS", "", "PENDING", 0]])
    put(base, "signup", "2024-03-02", [["o1", 1, 2, "signup", "2024-03-02 11:00:00"]])
    return base


def test_all_kinds_align_by_name(spark, base):
    rows = {r.event_id: r for r in text_lake.read_text(spark, base).collect()}
    assert len(rows) == 8
    assert rows["v1"].referrer == 'a "quoted", and\nbroken 사이트'
    assert rows["s1"].buffering_duration == "12" and rows["s1"].referrer is None
    assert rows["p1"].payment_status == "SUCCESS" and rows["p1"].error_code is None
    assert (rows["o1"].kind, str(rows["o1"].dt), rows["o1"].lecture_id) == ("signup", "2024-03-02", None)


def test_repair(spark, base):
    rows = {r.event_id: r for r in text_lake.read(spark, base).collect()}
    assert "v2" not in rows  # no readable creator
    assert rows["c2"].creator_id == 2 and rows["c2"].lecture_id == 4
    assert rows["s2"].created_at is None and rows["s2"].buffering_duration is None
    assert rows["s1"].buffering_duration == 12.0


def test_range_takes_days_without_files(spark, base):
    def ids(*limits):
        return [r[0] for r in values(text_lake.read(spark, base, *limits), "event_id")]

    assert ids("2024-03-01", "2024-03-01") == ["c1", "p1", "s1", "v1"]  # a bad time is in no range
    assert ids("2024-03-02", "2024-03-10") == ["c2", "o1"]
    assert ids("2023-01-01", "2023-01-03") == []
    with pytest.raises(ValueError):
        ids("2024-03-02", "2024-03-01")


def test_missing_base_is_empty(spark, tmp_path):
    assert text_lake.read(spark, str(tmp_path / "none")).count() == 0


def test_columns_no_file_has_are_null(spark, tmp_path):
    base = str(tmp_path)
    columns = ["event_id", "user_id", "creator_id", "event_type", "created_at"]
    put(base, "cart_add", "2024-03-01", [["c1", 1, 2, "cart_add", "2024-03-01 10:00:00"]], columns)
    row = text_lake.normalize(text_lake.read_text(spark, base, headers={"cart_add": columns})).first()
    assert row.lecture_id is None and row.payment_status is None and row.creator_id == 2


def test_other_header_is_an_error_not_shifted_columns(spark, tmp_path):
    base = str(tmp_path)
    columns = ["user_id", "event_id", "creator_id", "event_type", "created_at", "lecture_id"]
    put(base, "cart_add", "2024-03-01", [[1, "c1", 2, "cart_add", "2024-03-01 10:00:00", 3]], columns)
    with pytest.raises(Exception, match="(?i)header"):
        text_lake.read_text(spark, base, headers={"cart_add": record_columns("cart_add")}).collect()


def test_files_of_one_kind_with_other_headers_are_read_by_name(spark, tmp_path):
    base, day = str(tmp_path), "2024-03-01"
    common = record_columns("")
    put(base, "cart_add", day, [["c1", 1, 2, "cart_add", f"{day} 10:00:00", 3]], name="a.csv")
    put(base, "cart_add", day, [[4, f"{day} 10:00:00", "cart_add", 2, "line\nbreak", 1, "c2"]],
        ["lecture_id", "created_at", " Event_Type", "creator_id", "note", "USER_ID", "event_id"], name="b [1]{x}.csv")
    put(base, "cart_add", day, [["c3", 1, 2, "cart_add", f"{day} 10:00:00"]], common, name="c.csv")
    put(base, "cart_add", day, [["c4", 1, 2, "cart_add", f"{day} 10:00:00", 5, "other"]], [*common, "lecture_id", "event_id"], name="d.csv")
    put(base, "cart_add", "2024-03-02", [["c5", 1, 2, "cart_add", "2024-03-02 10:00:00", 6]], name="e.csv")
    open(f"{base}/cart_add/{day}/empty.csv", "w").close()
    with open(f"{base}/cart_add/{day}/bom.csv", "w", encoding="utf-8-sig") as f:
        f.write(",".join(common) + "\n" + f"c6,1,2,cart_add,{day} 10:00:00\n")
    got = values(text_lake.read(spark, base), "event_id", "user_id", "lecture_id", "dt")
    assert [(r[0], r[1], r[2], r[3].day) for r in got] == [
        ("c1", 1, 3, 1), ("c2", 1, 4, 1), ("c3", 1, None, 1), ("c4", 1, 5, 1), ("c5", 1, 6, 2), ("c6", 1, None, 1),
    ]
    assert [r[0] for r in values(text_lake.read(spark, base, "2024-03-02", "2024-03-02"), "event_id")] == ["c5"]
    groups = text_lake.header_groups(spark, f"{base}/cart_add/*/*.csv")
    assert sorted(len(files) for files in groups.values()) == [1, 1, 2, 2]


def test_panels_on_text(spark, base):
    rows = text_lake.read(spark, base)
    assert values(panels.cart_dropout_by_creator(rows)) == [(2, 2, 1, 50.0)]
    assert values(panels.outbox_volumes(rows)) == [("Pending Outbox Tasks", 1), ("Success Payments", 1)]
    assert [r[1] for r in values(panels.buffering_by_first_referrer(rows))] == [2]
    assert values(panels.top_creators_by_buffering(rows)) == [(3, 12.0, "Creator 3")]


def test_text_copy_can_be_read_again(spark, tmp_path):
    target = str(tmp_path / "copy")
    source = records(
        spark,
        {"event_type": "page_view", "lecture_id": 1, "referrer": 'q "x",\n y', "created_at": at("2024-03-01 10:00:00.123456")},
        {"event_type": "payment", "order_id": "o", "amount": 5, "payment_status": "FAIL", "created_at": at("2024-03-02")},
        {"event_type": "signup", "created_at": at("2024-03-02")},
    )
    lake.write_csv(source, target)
    assert {"kind=page_view", "kind=payment", "kind=signup"} <= set(os.listdir(target))
    header = next(
        open(os.path.join(folder, f), encoding="utf-8").readline().strip()
        for folder, _, files in os.walk(f"{target}/kind=payment")
        for f in files
        if f.endswith(".csv")
    )
    assert header.split(",") == record_columns("payment")
    read = text_lake.normalize(text_lake.read_text(spark, target))
    names = ["event_id", "user_id", "created_at", "lecture_id", "referrer", "order_id", "amount", "payment_status"]
    assert values(read, *names) == values(source, *names)


def test_numbers_with_fractions(spark):
    rows = text_lake.normalize(text_records(spark, {"buffering_duration": "3.5", "lecture_id": "2.0", "creator_id": "1.0"}))
    assert values(rows, "buffering_duration", "lecture_id", "creator_id") == [(3.5, 2, 1)]
