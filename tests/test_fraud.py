"""Boundary frames for the four fraud patterns and their combination."""

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from txnlake.operators import fraud
from txnlake.operators.silver import normalize

COLS = (
    "transaction_id string, transaction_type string, amount double, currency string, fee double, "
    "sender_phone string, recipient_phone string, merchant_code string, status string, "
    "initiated_at timestamp_ntz, completed_at timestamp_ntz, channel string, region string, "
    "_ingested_at timestamp_ntz, _batch_id string"
)
DAY = datetime(2024, 1, 15)


def silver_of(spark, rows):
    full = []
    for i, r in enumerate(rows):
        t = r.get("t", DAY + timedelta(hours=10))
        full.append(
            (
                r.get("id", f"T{i:05d}"), r.get("type", "PAYMENT"), r.get("amount", 100.0), "XOF", 0.0,
                r.get("sender", "770000001"), r.get("recipient", "780000001"), None, "SUCCESS",
                t, t, "USSD", "R", DAY, "b",
            )
        )
    return normalize(spark.createDataFrame(full, COLS))


def test_velocity_threshold_is_strict(spark):
    rows = [{"sender": "A", "t": DAY + timedelta(minutes=i)} for i in range(20)]
    rows += [{"sender": "B", "t": DAY + timedelta(minutes=i)} for i in range(21)]
    rows += [{"sender": None, "t": DAY + timedelta(minutes=i)} for i in range(21)]
    out = fraud.velocity(silver_of(spark, rows), "2024-01-15", 20).collect()
    assert {r.sender_phone for r in out} == {"B"}
    assert len(out) == 21 and out[0].flag_detail_1 == "21"


def test_amount_spike_includes_row_in_mean(spark):
    five = [{"sender": "A", "amount": a} for a in (1.0, 1.0, 1.0, 1.0, 10_000.0)]
    six = [{"sender": "B", "amount": a} for a in (1.0, 1.0, 1.0, 1.0, 1.0, 10_000.0)]
    # C: amount exactly 5 x mean is not a spike (mean = 30/6 = 5, 25 == 5 x 5)
    equal = [{"sender": "C", "amount": a} for a in (1.0, 1.0, 1.0, 1.0, 1.0, 25.0)]
    out = fraud.amount_spike(silver_of(spark, five + six + equal), "2024-01-15").collect()
    assert {r.sender_phone for r in out} == {"B"}
    assert out[0].flag_detail_1 == "10000.0"


def test_amount_spike_history_window(spark):
    old = [{"sender": "A", "amount": 1.0, "t": DAY - timedelta(days=10, hours=-i)} for i in range(10)]
    today = [{"sender": "A", "amount": 50.0}]
    s = silver_of(spark, old + today)
    # unbounded history: mean = 60/11, 50 > 5 * 5.45 -> flagged
    assert fraud.amount_spike(s, "2024-01-15", since="2023-01-01").count() == 1
    # history from 7 days back, the default, contains only the row itself -> not flagged
    assert fraud.amount_spike(s, "2024-01-15").count() == 0
    assert fraud.amount_spike(s, "2024-01-15", since="2024-01-08").count() == 0


def test_rapid_transfer_boundaries(spark):
    base = DAY + timedelta(hours=10)
    rows = [
        {"id": "a0", "type": "TRANSFER", "sender": "S", "recipient": "R", "t": base},
        {"id": "a1", "type": "TRANSFER", "sender": "S", "recipient": "R", "t": base},  # 0 s
        {"id": "a2", "type": "TRANSFER", "sender": "S", "recipient": "R", "t": base + timedelta(seconds=599)},
        {"id": "a3", "type": "TRANSFER", "sender": "S", "recipient": "R", "t": base + timedelta(seconds=1199)},  # 600 s
        {"id": "b0", "type": "TRANSFER", "sender": "S", "recipient": "Q", "t": base + timedelta(seconds=30)},
        {"id": "c0", "type": "PAYMENT", "sender": "S", "recipient": "R", "t": base + timedelta(seconds=60)},
        {"id": "d0", "type": "TRANSFER", "sender": "S", "recipient": "M", "t": DAY - timedelta(seconds=60)},
        {"id": "d1", "type": "TRANSFER", "sender": "S", "recipient": "M", "t": DAY + timedelta(seconds=60)},
    ]
    out = fraud.rapid_transfer(silver_of(spark, rows), None, 10).collect()
    got = {r.transaction_id: r.flag_detail_1 for r in out}
    assert got == {"a1": "0.0", "a2": "10.0"}  # 599 s rounds to 10.0 but is < 10 min


def test_rapid_transfer_null_senders(spark):
    base = DAY + timedelta(hours=3)
    rows = [
        {"id": "n0", "type": "TRANSFER", "sender": None, "recipient": "R", "t": base},
        {"id": "n1", "type": "TRANSFER", "sender": None, "recipient": "R", "t": base + timedelta(minutes=1)},
    ]
    s = silver_of(spark, rows)
    assert [r.transaction_id for r in fraud.rapid_transfer(s, None, 10).collect()] == ["n1"]
    assert fraud.rapid_transfer(s, None, 10, drop_null_sender=True).count() == 0


def test_off_hours(spark):
    rows = [
        {"id": "a", "amount": 99_999.99, "t": DAY + timedelta(hours=3)},
        {"id": "b", "amount": 100_000.0, "t": DAY + timedelta(hours=3)},
        {"id": "c", "amount": 100_000.0, "t": DAY + timedelta(hours=10)},
    ]
    out = fraud.off_hours_large(silver_of(spark, rows), "2024-01-15").collect()
    assert [(r.transaction_id, r.flag_detail_1, r.flag_detail_2) for r in out] == [("b", "3", 100000.0)]


def test_detect_all_precedence_and_superset(spark):
    rows = [{"sender": "V", "amount": 1.0, "t": DAY + timedelta(hours=2, minutes=i)} for i in range(6)]
    rows.append({"id": "big", "sender": "V", "amount": 200_000.0, "t": DAY + timedelta(hours=3)})
    s = silver_of(spark, rows)
    flags_all = fraud.all_flags(s, "2024-01-15", velocity_threshold=5)
    flags = fraud.detect_all(s, "2024-01-15", velocity_threshold=5)
    by_id = {r.transaction_id: r.flag_pattern for r in flags.collect()}
    assert by_id["big"] == "VELOCITY_ANOMALY"  # also spike and off-hours
    patterns = {r.flag_pattern for r in flags_all.filter("transaction_id = 'big'").collect()}
    assert patterns == {"VELOCITY_ANOMALY", "AMOUNT_SPIKE", "OFF_HOURS_LARGE"}
    assert flags.count() == flags_all.select("transaction_id").distinct().count()


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["S1", "S2", None]), st.sampled_from(["R1", "R2"]), st.integers(0, 2 * 86400)),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([60, 600, 3600, 86400]),
)
def test_bucketed_gaps_equal_plain_lag(spark, events, bucket):
    rows = [
        {"id": f"t{i:03d}", "type": "TRANSFER", "sender": s, "recipient": r, "t": DAY + timedelta(seconds=sec)}
        for i, (s, r, sec) in enumerate(events)
    ]
    s = silver_of(spark, rows)
    got = {
        (r.transaction_id, r.minutes_since_prev)
        for r in fraud.transfer_gaps(s, None, bucket_seconds=bucket).collect()
    }
    w = Window.partitionBy("sender_phone", "recipient_phone", "_date").orderBy("initiated_at", "transaction_id")
    plain = s.withColumn("p", F.lag("initiated_at").over(w)).withColumn(
        "m", (F.unix_timestamp("initiated_at") - F.unix_timestamp("p")) / 60
    )
    want = {(r.transaction_id, r.m) for r in plain.collect()}
    assert got == want


def test_spike_history_starts_at_the_given_day(spark):
    old = [{"transaction_id": f"o{i}", "initiated_at": "2023-06-01 10:00:00", "amount": 10.0}
           for i in range(20)]
    new = [{"transaction_id": f"n{i}", "initiated_at": "2024-01-15 10:00:00", "amount": 1000.0}
           for i in range(3)]
    rows = spark.createDataFrame(old + new).select(
        "transaction_id", F.col("initiated_at").cast("timestamp_ntz").alias("initiated_at"),
        "amount", F.lit("771234567").alias("sender_phone"), F.lit("PASS").alias("_quality_flag"),
    ).withColumn("_date", F.to_date("initiated_at"))
    mean = lambda **k: fraud.sender_mean(rows, **k).first().avg_amount_7d
    assert mean() < 200
    assert mean(since="2024-01-08") == 1000.0


def test_rolling_spike_counts_the_days_before_and_the_day_so_far(spark):
    import random

    from txnlake.operators import fraud

    rnd = random.Random(4)
    rows = []
    for i in range(900):
        sender = "hot" if i % 3 else rnd.choice(["a", "b", None])
        d, s = rnd.randrange(1, 22), rnd.randrange(0, 3000)
        amount = float(rnd.choice([10, 12, 15, 900]))
        at = f"2024-01-{d:02d} {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"
        rows.append((f"T{i:04d}", sender, "r", amount, at, at[:10], "PASS" if rnd.random() < 0.9 else "FAIL"))
    df = spark.createDataFrame(rows, "transaction_id string, sender_phone string, recipient_phone string, "
                               "amount double, at string, d string, _quality_flag string").selectExpr(
        "*", "cast(at as timestamp_ntz) as initiated_at", "cast(d as date) as _date", "'x' as channel", "'y' as region")
    want = set()
    for t, sender, _, amount, at, d, flag in rows:
        if sender is None or flag != "PASS":
            continue
        history = [
            r[3] for r in rows
            if r[1] == sender and r[6] == "PASS" and (r[4], r[0]) <= (at, t)
            and int(d[-2:]) - int(r[5][-2:]) <= 7
        ]
        if amount > sum(history) / len(history) * 3.0:
            want.add(t)
    for slot in (1, 300, 86400):
        got = {r.transaction_id for r in fraud.rolling_spike(df, 3.0, slot_seconds=slot).collect()}
        assert got == want
    assert len(want) > 20


def test_spike_history_is_seven_days(spark):
    from txnlake.operators import fraud

    rows = [("old", "2024-01-01", 1.0)] * 1 + [(f"o{i}", "2024-01-01", 10_000.0) for i in range(9)]
    rows += [(f"n{i}", "2024-01-10", 10.0) for i in range(9)] + [("big", "2024-01-10", 900.0)]
    df = spark.createDataFrame(rows, "transaction_id string, d string, amount double").selectExpr(
        "transaction_id", "'s' as sender_phone", "'r' as recipient_phone", "amount",
        "cast(d as timestamp_ntz) as initiated_at", "'x' as channel", "'y' as region",
        "cast(d as date) as _date", "'PASS' as _quality_flag")
    for day in (None, "2024-01-10"):
        assert [r.transaction_id for r in fraud.amount_spike(df, day).collect()] == ["big"]
    assert fraud.amount_spike(df, None, days=9).collect() == []
    assert fraud.amount_spike(df, None, since="2023-12-01").collect() == []
