"""Phone helpers, HMAC tokens, API page parsing and data checks."""

import hashlib
import hmac
import json

from pyspark.sql import functions as F

from txnlake.functions import privacy
from txnlake.operators import checks
from txnlake.sources import pages


def _one(spark, values):
    return spark.createDataFrame([(v,) for v in values], "phone string")


def test_mask_and_canonical(spark):
    df = _one(spark, ["771234567", "+221 77 123 45 67", "77123456", "991234567", None])
    out = df.select(
        privacy.mask("phone").alias("m"),
        privacy.phone_canonical("phone").alias("c"),
        privacy.phone_known_prefix("phone").alias("k"),
    ).collect()
    assert [r.m for r in out] == ["77XXXXX567", "77XXXXX567", "XXXXX", "99XXXXX567", None]
    assert [r.c for r in out] == ["771234567", "771234567", "77123456", "991234567", None]
    assert [r.k for r in out] == [True, True, True, False, None]


def test_tokens_equal_python_hmac(spark):
    phones = ["771234567", "781234567", "701234567"]
    for secret in ("dev-secret-change-in-production", "k" * 100):
        got = [r.t for r in _one(spark, phones).select(privacy.tokenize("phone", secret).alias("t")).collect()]
        want = [hmac.new(secret.encode(), p.encode(), hashlib.sha256).hexdigest()[:16] for p in phones]
        assert got == want


def _page(transactions, raw=None):
    return raw if raw is not None else json.dumps({"transactions": transactions, "totalCount": len(transactions)})


def test_flatten_and_quarantine(spark):
    good = {
        "id": "OM1", "type": "PAYMENT", "amount": 1500,
        "sender": {"msisdn": "+221 77 123 45 67"}, "recipient": {"msisdn": "781234567"},
        "initiatedAt": "2024-01-15T10:00:00Z",
    }
    offset = dict(good, id="OM2", initiatedAt="2024-01-15T10:00:00+00:00", fee="12.5", currency="EUR")
    bad_amount = dict(good, id="OM3", amount="12x")
    negative = dict(good, id="OM4", amount=-5)
    bad_time = dict(good, id="OM5", initiatedAt="yesterday")
    bad_fee = dict(good, id="OM6", fee="free")
    no_sender = dict(good, id="OM7", sender={"msisdn": None})
    docs = [
        (1, _page([good, offset, bad_amount])),
        (2, _page([negative, bad_time, bad_fee, no_sender])),
        (3, _page([])),
        (4, "not json at all"),
    ]
    df = spark.createDataFrame(docs, "page long, body string")
    rows = {r.transaction_id: r for r in pages.flatten_pages(df).collect()}
    assert set(rows) == {"OM1", "OM2"}
    assert rows["OM1"].currency == "XOF" and rows["OM1"].fee == 0.0 and rows["OM1"].status == "SUCCESS"
    assert rows["OM1"].channel == "USSD" and rows["OM1"].sender_phone == "771234567"
    assert rows["OM2"].fee == 12.5 and rows["OM2"].currency == "EUR"
    assert rows["OM1"].initiated_at == rows["OM2"].initiated_at
    q = {(r.transaction_id, r.reason) for r in pages.quarantine_pages(df).collect()}
    assert q == {
        ("OM3", "bad_amount"), ("OM4", "bad_amount"), ("OM5", "bad_initiated_at"),
        ("OM6", "bad_fee"), ("OM7", "missing_sender"), (None, "not_json"),
    }  # an empty transaction list is a normal page
    redacted = pages.flatten_pages(df, secret="s").collect()
    assert all("msisdn" not in r.raw_payload for r in redacted)
    assert all(len(r.sender_phone) == 16 for r in redacted)


def test_page_edge_values(spark):
    good = {
        "id": "A0", "type": "PAYMENT", "amount": 100.5, "extra": {"k": [1, "x"]},
        "sender": {"msisdn": "771234567", "name": "Awa"}, "recipient": {"msisdn": "781234567"},
        "initiatedAt": "2024-01-15T10:00:00",
    }
    cases = {
        "A1": ({"completedAt": ""}, None),
        "A2": ({"initiatedAt": "12:30"}, "bad_initiated_at"),
        "A3": ({"initiatedAt": "2024"}, "bad_initiated_at"),
        "A4": ({"amount": "5d"}, "bad_amount"),
        "A5": ({"amount": "NaN"}, "bad_amount"),
        "A6": ({"currency": None}, "bad_currency"),
        "A7": ({"fee": None}, "bad_fee"),
        "A8": ({"initiatedAt": "2024-01-15"}, None),
        "A9": ({"initiatedAt": "2024-01-15T05:00:00-05:00"}, None),
        "B1": ({"amount": "1e999"}, "bad_amount"),
        "B2": ({"completedAt": "soon"}, "bad_completed_at"),
    }
    items = [good, *[good | {"id": k} | change for k, (change, _) in cases.items()], None, 5]
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(_page(items),), (_page([]),), ('{"page": 1}',)], "body string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = {r.transaction_id: r for r in pages.flatten_pages(df).collect()}
        kept = pages.quarantine_pages(df, secret="s").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert set(rows) == {"A0", *[k for k, (_, reason) in cases.items() if reason is None]}
    assert rows["A0"].initiated_at.hour == 10 and rows["A9"].initiated_at == rows["A0"].initiated_at
    assert rows["A8"].initiated_at.hour == 0 and rows["A1"].completed_at is None
    assert json.loads(rows["A0"].raw_payload) == good
    assert {(r.transaction_id, r.reason) for r in kept if r.transaction_id} == {
        (k, reason) for k, (_, reason) in cases.items() if reason
    }
    assert sorted(r.reason for r in kept if not r.transaction_id) == [
        "no_transactions", "not_an_object", "not_an_object"
    ]
    assert all("Awa" not in (r.raw_text or "") and "771234567" not in (r.raw_text or "") for r in kept)


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", 0.0, "SUCCESS", None), ("a", 5.0, "BAD", None), (None, 50_000_000.0, None, None), ("b", 1.0, "FAILED", None)],
        "id string, amount double, status string, empty string",
    )
    assert [(r.id, r.n_records) for r in checks.violations_unique(df, "id").collect()] == [("a", 2)]
    assert checks.violations_not_null(df, ["id"]).count() == 1
    assert [r.status for r in checks.violations_accepted(df, "status", ["SUCCESS", "FAILED"]).collect()] == ["BAD"]
    ends = checks.violations_range(df, "amount", 0, 50_000_000, inclusive=False).collect()
    assert sorted(r.amount for r in ends) == [0.0, 50_000_000.0]
    assert checks.violations_range(df, "amount", 0, 50_000_000, inclusive=True).count() == 0
    assert checks.at_least_one(df, "empty").count() == 1
    assert checks.at_least_one(df, "id").count() == 0


def test_key_pads_redacted_in_explain(spark, capsys):
    df = _one(spark, ["771234567"]).select(privacy.tokenize("phone", "my-secret").alias("t"))
    df.explain(True)
    out = capsys.readouterr().out
    inner, outer = privacy._hmac_pads("my-secret")
    assert inner.hex().upper()[:32] not in out.upper()
    assert "redacted" in out


def test_iso_times_like_fromisoformat(spark):
    from datetime import datetime

    dates = ["2024-01-15", "20240115", "2024-W03-1", "2024W037", "2020-W53-5", "2021-W53-5", "2024-W03",
             "2024W03", "2024-02-30", "2024", "2024-1-5", "0001-01-02", "9999-12-30", "2024-11-03"]
    clocks = ["", "T10", "T10:05", "T1005", "T10:05:07", "T100507", "T10:05:07.5", "T10:05:07,123456789",
              "T100507.25", "T1:2", "T25:00", "T10:0507", "T10:60", " 01:30:07.123456", "x10:05", "T"]
    offsets = ["", "Z", "+01", "-0130", "+01:30", "+01:30:15", "-013015", "z", "+1"]
    texts = [d + t + o for d in dates for t in clocks for o in offsets if t or not o]

    def plain(text):
        try:
            v = datetime.fromisoformat(text)
        except ValueError:
            return None
        return v.replace(tzinfo=None) - (v.utcoffset() or v - v)

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = {r.t: r.v for r in df.select("t", pages._utc_ntz(F.col("t")).alias("v")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {t: plain(t) for t in texts}
    assert sum(v is not None for v in got.values()) > 500


def test_redacted_payload_keeps_all_else(spark):
    item = {
        "id": "A1", "type": "PAYMENT", "amount": 20, "fee": 0.25, "big": 12345678901234567890, "none": None,
        "nested": {"sender": {"kept": 1}, "list": [1, "x", {"k": True}]}, "sender": {"msisdn": "771234567"},
        "recipient": {"msisdn": "781234567"}, "initiatedAt": "20240115T100000",
    }
    twice = '{"id":"A2","id":"A2","type":"PAYMENT","amount":1,"sender":{"msisdn":"770000001"},' \
        '"recipient":{"msisdn":"780000001"},"initiatedAt":"2024-01-15T10"}'
    body = '{"transactions":[' + json.dumps(item) + "," + twice + "]}"
    rows = pages.flatten_pages(spark.createDataFrame([(body,)], "body string"), secret="s").collect()
    kept = {r.transaction_id: json.loads(r.raw_payload) for r in rows}
    assert kept["A1"] == {k: v for k, v in item.items() if k not in ("sender", "recipient")}
    assert kept["A2"]["id"] == "A2" and "sender" not in kept["A2"]


def test_pages_are_parsed_once(spark, capsys):
    df = spark.createDataFrame([("{}",)], "body string")
    for frame in (pages.flatten_pages(df, secret="s"), pages.quarantine_pages(df)):
        frame.explain("extended")
        plan = capsys.readouterr().out.split("== Physical Plan ==")[1]
        assert plan.count("from_json") <= 2
