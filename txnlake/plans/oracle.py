"""Independent DuckDB SQL for every registered query.

These strings are the correctness oracle: hand-written ANSI SQL over the raw
driver tables (``events`` is the only input the transaction queries need),
with no code shared with the Spark side. DuckDB differences handled here:
``dayofweek`` is 0-based on Sunday (+1), ``hour`` is BIGINT (cast), ``epoch``
is fractional (floor), ``sum(bigint)`` is HUGEINT (cast).
"""

from __future__ import annotations

from ..functions.quality import TRANSACTION_TYPES
from . import params as P

# --- shared CTEs -------------------------------------------------------------

_EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
    CASE WHEN event_id % 73 = 0 THEN 'UNKNOWN'
         WHEN event_id % 12 = 0 THEN 'FAILED'
         WHEN event_id % 25 = 0 THEN 'PENDING'
         WHEN event_id % 40 = 7 THEN 'REVERSED'
         ELSE 'SUCCESS' END AS st,
    CASE WHEN event_id % 20 < 13 THEN 'USSD'
         WHEN event_id % 20 < 18 THEN 'APP'
         WHEN event_id % 20 = 18 THEN 'WEB'
         ELSE 'AGENT' END AS ch
  FROM events
)"""

_RAW_SELECT = """
  SELECT
    'OM' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS transaction_id,
    CASE WHEN event_id % 10 < 3 THEN 'EXT-' || lpad(CAST(event_id AS VARCHAR), 12, '0') END AS external_id,
    CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'click' THEN 'TRANSFER'
         WHEN 'view' THEN 'DEPOSIT' WHEN 'signup' THEN 'WITHDRAWAL' ELSE 'REFUND' END AS transaction_type,
    CAST(CASE WHEN event_id % 97 = 0 THEN 0 ELSE floor(value * 400) END AS DOUBLE) + {amount_add} AS amount,
    CASE WHEN event_id % 89 = 0 THEN 'EUR' ELSE 'XOF' END AS currency,
    CAST(CASE WHEN event_id % 83 = 0 THEN -1 ELSE floor(value * 4) END AS DOUBLE) AS fee,
    CASE WHEN event_id % 79 = 0 THEN NULL
         ELSE (CASE WHEN event_id % 7 = 0 THEN '+221 ' ELSE '' END) || '77' || lpad(CAST(user_id AS VARCHAR), 7, '0')
    END AS sender_raw,
    '78' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR), 7, '0') AS recipient_raw,
    CASE WHEN event_id % 5 < 3 THEN 'MERCH' || lpad(CAST(event_id % 25 AS VARCHAR), 5, '0') END AS merchant_code,
    CASE WHEN event_id % 5 < 3 THEN 'Merchant ' || CAST(event_id % 25 AS VARCHAR) END AS merchant_name,
    CASE WHEN event_id % 5 = 0 THEN 'FOOD' WHEN event_id % 5 = 1 THEN 'TRANSPORT'
         WHEN event_id % 5 = 2 THEN 'RETAIL' END AS merchant_category,
    st AS status,
    CASE WHEN st = 'FAILED' THEN 'INSUFFICIENT_FUNDS' END AS failure_reason,
    CASE WHEN event_id % 71 = 0 THEN NULL ELSE ts END AS initiated_at,
    CASE WHEN st = 'PENDING' THEN NULL ELSE ts + to_seconds(CAST(event_id % 30 + 1 AS BIGINT)) END AS completed_at,
    ch AS channel,
    CASE WHEN ch = 'AGENT' THEN 'AG' || lpad(CAST(event_id % 100 AS VARCHAR), 5, '0') END AS agent_code,
    'Region ' || CAST(user_id % 11 AS VARCHAR) AS region,
    props AS raw_payload,
    ts + INTERVAL 1 HOUR + {ingest_add} AS _ingested_at,
    'events/' || strftime(ts, '%Y-%m-%d') AS _source_file,
    '{batch}' AS _batch_id
  FROM ev{where}"""

_RAW = (
    "raw AS ("
    + _RAW_SELECT.format(amount_add="0", ingest_add="INTERVAL 0 HOUR", batch="batch-1", where="")
    + "\n  UNION ALL"
    + _RAW_SELECT.format(
        amount_add="1",
        ingest_add="INTERVAL 1 HOUR",
        batch="batch-2",
        where=" WHERE event_id % 50 = 0",
    )
    + "\n)"
)

_BRONZE_COLS = """transaction_id, external_id, transaction_type, amount, currency, fee,
    {sender} AS sender_phone, {recipient} AS recipient_phone,
    merchant_code, merchant_name, merchant_category, status, failure_reason,
    initiated_at, completed_at, channel, agent_code, region, raw_payload,
    _ingested_at, _source_file, _batch_id"""


def _canon(c: str) -> str:
    return f"trim(replace(replace({c}, '+221', ''), ' ', ''))"


def _hmac(c: str, secret: str) -> str:
    """HMAC-SHA256 as two SHA-256 calls over the padded key (key <= 64 bytes)."""
    key = secret.encode("utf-8")
    assert len(key) <= 64
    key = key.ljust(64, b"\x00")
    ipad = bytes(b ^ 0x36 for b in key).hex()
    opad = bytes(b ^ 0x5C for b in key).hex()
    inner = f"unhex(sha256(unhex('{ipad}') || encode({c})))"
    return f"substr(sha256(unhex('{opad}') || {inner}), 1, 16)"


_BRONZE = (
    "bronze AS (\n  SELECT "
    + _BRONZE_COLS.format(sender=_canon("sender_raw"), recipient=_canon("recipient_raw"))
    + "\n  FROM raw\n)"
)

_STATUSES = "('SUCCESS', 'PENDING', 'FAILED', 'REVERSED')"

_DEDUP = """
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id
      ORDER BY _ingested_at DESC NULLS LAST, _batch_id DESC NULLS LAST) AS rn
    FROM bronze
  ) WHERE rn = 1
)"""

_SILVER = f"""
silver AS (
  SELECT *,
    coalesce(amount > 0, false) AS _quality_amount_positive,
    coalesce(amount < 50000000, false) AS _quality_amount_reasonable,
    coalesce(currency = 'XOF', false) AS _quality_currency_xof,
    coalesce(status IN {_STATUSES}, false) AS _quality_valid_status,
    sender_phone IS NOT NULL AS _quality_has_sender,
    initiated_at IS NOT NULL AS _quality_has_initiated_at,
    coalesce(fee >= 0, false) AS _quality_fee_non_negative,
    CASE WHEN amount > 0 AND status IN {_STATUSES} AND initiated_at IS NOT NULL
         THEN 'PASS' ELSE 'FAIL' END AS _quality_flag,
    CAST(initiated_at AS DATE) AS _date,
    CAST(hour(initiated_at) AS INTEGER) AS _hour,
    CAST(dayofweek(initiated_at) + 1 AS INTEGER) AS _day_of_week,
    CASE WHEN amount < 1000 THEN 'MICRO' WHEN amount < 5000 THEN 'SMALL'
         WHEN amount < 20000 THEN 'MEDIUM' WHEN amount < 100000 THEN 'LARGE'
         ELSE 'XLARGE' END AS _amount_bucket,
    (dayofweek(initiated_at) + 1) IN (1, 7) AS _is_weekend,
    (hour(initiated_at) BETWEEN 9 AND 12 OR hour(initiated_at) BETWEEN 15 AND 18) AS _is_peak_hour,
    merchant_code IS NOT NULL AS _is_merchant_txn,
    CAST(floor(epoch(completed_at)) - floor(epoch(initiated_at)) AS BIGINT) AS _processing_latency_seconds
  FROM dedup
)"""

_PASS = """
pass AS (SELECT * FROM silver WHERE _quality_flag = 'PASS')"""


def with_bronze(body: str, extra: str = "") -> str:
    return "WITH " + ",".join([_EV, _RAW, _BRONZE]) + extra + "\n" + body


def with_silver(body: str, extra: str = "") -> str:
    return "WITH " + ",".join([_EV, _RAW, _BRONZE, _DEDUP, _SILVER, _PASS]) + extra + "\n" + body


# --- gold --------------------------------------------------------------------

_DAILY = """
daily AS (
  SELECT _date, region, channel, _is_weekend, _is_peak_hour,
    count(*) AS transaction_count,
    sum(amount) AS total_volume_xof,
    {avg} AS avg_transaction_xof,
    median(amount) AS median_transaction_xof,
    sum(fee) AS total_fees_xof,
    count(CASE WHEN _is_merchant_txn THEN 1 END) AS merchant_txn_count,
    count(CASE WHEN status = 'FAILED' THEN 1 END) AS failed_count,
    count(CASE WHEN status = 'REVERSED' THEN 1 END) AS reversed_count,
    count(DISTINCT merchant_code) AS unique_merchants,
    sum(CASE WHEN _is_merchant_txn THEN amount END) AS merchant_volume_xof,
    {lat} AS avg_latency_seconds,
    sround((count(*) - count(CASE WHEN status = 'FAILED' THEN 1 END)) / count(*) * 100, 2) AS success_rate,
    sround(count(CASE WHEN _is_merchant_txn THEN 1 END) / count(*) * 100, 2) AS merchant_share_pct
  FROM pass
  GROUP BY _date, region, channel, _is_weekend, _is_peak_hour
)"""

_MERCHANT = """
merchant AS (
  SELECT merchant_code, merchant_name, merchant_category, _date,
    count(*) AS transaction_count,
    sum(amount) AS total_volume_xof,
    {avg} AS avg_transaction_xof,
    sum(fee) AS total_fees_xof,
    count(DISTINCT sender_phone) AS unique_customers,
    count(CASE WHEN status = 'FAILED' THEN 1 END) AS failed_count,
    sround((count(*) - count(CASE WHEN status = 'FAILED' THEN 1 END)) / count(*) * 100, 2) AS success_rate,
    sround(CASE WHEN count(DISTINCT sender_phone) = 0 THEN NULL
               ELSE count(*) / count(DISTINCT sender_phone) END, 2) AS avg_txn_per_customer
  FROM pass
  WHERE _is_merchant_txn
  GROUP BY merchant_code, merchant_name, merchant_category, _date
)"""

DAILY = _DAILY.format(avg="avg(amount)", lat="avg(_processing_latency_seconds)")
DAILY_ROUNDED = _DAILY.format(
    avg="sround(avg(amount), 2)", lat="sround(avg(_processing_latency_seconds), 1)"
)
MERCHANT = _MERCHANT.format(avg="avg(amount)")
MERCHANT_ROUNDED = _MERCHANT.format(avg="sround(avg(amount), 2)")


_FLAG_BASE = "transaction_id, sender_phone, recipient_phone, amount, initiated_at, channel, region"

_FRAUD = """
vc AS (
  SELECT sender_phone, _date, count(*) AS daily_txn_count FROM {src}
  GROUP BY sender_phone, _date HAVING count(*) > {vel}
),
f_velocity AS (
  SELECT p.transaction_id, p.sender_phone, p.recipient_phone, p.amount, p.initiated_at, p.channel, p.region,
    'VELOCITY_ANOMALY' AS flag_pattern, CAST(vc.daily_txn_count AS VARCHAR) AS flag_detail_1,
    CAST(NULL AS DOUBLE) AS flag_detail_2
  FROM {src} p JOIN vc ON p.sender_phone = vc.sender_phone AND p._date = vc._date
),
sd AS (SELECT sender_phone, _date, sum(amount) AS s, count(amount) AS n FROM pass GROUP BY sender_phone, _date),
sa AS (SELECT a.sender_phone, a._date, sum(b.s) / sum(b.n) AS avg_amount_7d
  FROM sd a JOIN sd b ON b.sender_phone = a.sender_phone AND b._date BETWEEN a._date - 7 AND a._date
  GROUP BY a.sender_phone, a._date),
f_spike AS (
  SELECT p.transaction_id, p.sender_phone, p.recipient_phone, p.amount, p.initiated_at, p.channel, p.region,
    'AMOUNT_SPIKE' AS flag_pattern, CAST(sround(p.amount, 2) AS VARCHAR) AS flag_detail_1,
    sround(sa.avg_amount_7d, 2) AS flag_detail_2
  FROM {src} p JOIN sa ON p.sender_phone = sa.sender_phone AND p._date = sa._date
  WHERE p.amount > sa.avg_amount_7d * 5.0
),
gaps AS (
  SELECT *, CASE WHEN prev_txn_time IS NOT NULL THEN
      (floor(epoch(initiated_at)) - floor(epoch(prev_txn_time))) / 60.0 END AS minutes_since_prev
  FROM (
    SELECT *, lag(initiated_at) OVER (PARTITION BY sender_phone, recipient_phone, _date
                                      ORDER BY initiated_at, transaction_id) AS prev_txn_time
    FROM {src} WHERE transaction_type = 'TRANSFER'
  )
),
f_rapid AS (
  SELECT transaction_id, sender_phone, recipient_phone, amount, initiated_at, channel, region,
    'RAPID_TRANSFER' AS flag_pattern, CAST(sround(minutes_since_prev, 1) AS VARCHAR) AS flag_detail_1,
    CAST(NULL AS DOUBLE) AS flag_detail_2
  FROM gaps WHERE minutes_since_prev < {rapid}
),
f_off AS (
  SELECT transaction_id, sender_phone, recipient_phone, amount, initiated_at, channel, region,
    'OFF_HOURS_LARGE' AS flag_pattern, CAST(_hour AS VARCHAR) AS flag_detail_1,
    amount AS flag_detail_2
  FROM {src} WHERE NOT _is_peak_hour AND amount >= 100000
),
f_all AS (
  SELECT * FROM f_velocity UNION ALL SELECT * FROM f_spike
  UNION ALL SELECT * FROM f_rapid UNION ALL SELECT * FROM f_off
),
flags AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
      CASE flag_pattern WHEN 'VELOCITY_ANOMALY' THEN 0 WHEN 'AMOUNT_SPIKE' THEN 1
                        WHEN 'RAPID_TRANSFER' THEN 2 ELSE 3 END) AS rn
    FROM f_all
  ) WHERE rn = 1
)"""


def _fraud(src: str = "pass", vel: int = P.VELOCITY_THRESHOLD) -> str:
    return "," + _FRAUD.format(src=src, vel=vel, rapid=P.RAPID_MINUTES)


_DAY = f"""
day_pass AS (SELECT * FROM pass WHERE _date = DATE '{P.DAY}')"""

_PHONES = """
phones AS (SELECT transaction_id, _batch_id, sender_raw AS sender_phone, recipient_raw AS recipient_phone
           FROM raw)"""


def _mask(c: str) -> str:
    k = _canon(c)
    return (
        f"CASE WHEN {c} IS NULL THEN NULL WHEN length({k}) >= 9 "
        f"THEN substr({k}, 1, 2) || 'XXXXX' || right({k}, 3) ELSE 'XXXXX' END"
    )


def _share(col: str, src: str) -> str:
    return (
        f"SELECT {col}, count(*) AS txn_count, "
        f"sround(count(*) / sum(count(*)) OVER () * 100, 1) AS pct FROM {src} GROUP BY {col}"
    )


_RULES = f"""
    coalesce(amount > 0, false) AS _quality_amount_positive,
    coalesce(amount < 50000000, false) AS _quality_amount_reasonable,
    coalesce(currency = 'XOF', false) AS _quality_currency_xof,
    coalesce(status IN {_STATUSES}, false) AS _quality_valid_status,
    sender_phone IS NOT NULL AS _quality_has_sender,
    initiated_at IS NOT NULL AS _quality_has_initiated_at,
    coalesce(fee >= 0, false) AS _quality_fee_non_negative,
    CASE WHEN amount > 0 AND status IN {_STATUSES} AND initiated_at IS NOT NULL
         THEN 'PASS' ELSE 'FAIL' END AS _quality_flag"""

_SEVEN_DAYS = "DATE '2024-01-24'"

def _exact_mean(c: str) -> str:
    """Mean over an exact DECIMAL sum; doubles enter by their shortest text form
    (as Spark casts them), see reports.exact_mean."""
    return f"CAST(sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count({c})"


# mean of 2-decimal success rates from an exact integer sum (see reports.mean_of_rounded)
_MEAN_RATE = (
    "CAST(sum(CAST(round(success_rate * 100) AS BIGINT)) AS DOUBLE) / (count(success_rate) * 100)"
)

# --- API pages: the elements as text, and what is to be made of them ---------------

_K = "CAST(substr(transaction_id, 3) AS BIGINT)"


def _pair(key: str, expr: str, text: bool = True) -> str:
    """A JSON member, left out where the value is NULL."""
    value = f"CAST(to_json({expr}) AS VARCHAR)" if text else f"({expr})"
    return f"CASE WHEN {expr} IS NOT NULL THEN '\"{key}\":' || {value} END"


_UTC = "'%Y-%m-%dT%H:%M:%S.%fZ'"
_MEMBERS = {
    "id": _pair("id", "transaction_id"),
    "externalId": _pair("externalId", "external_id"),
    "type": _pair("type", "transaction_type"),
    "amount": _pair("amount", "CAST(amount AS BIGINT)"),
    "currency": _pair("currency", f"CASE WHEN {_K} % 17 <> 0 THEN currency END"),
    "fee": _pair("fee", f"CASE WHEN {_K} % 19 <> 0 THEN CAST(fee AS BIGINT) END"),
    "sender": _pair("sender", "CASE WHEN sender_raw IS NOT NULL THEN "
                    f"'{{\"msisdn\":\"' || sender_raw || '\",\"name\":\"S' || {_K} || '\"}}' END", False),
    "recipient": _pair("recipient", "'{\"msisdn\":\"' || recipient_raw || '\"}'", False),
    "merchantCode": _pair("merchantCode", "merchant_code"),
    "merchantName": _pair("merchantName", "merchant_name"),
    "merchantCategory": _pair("merchantCategory", "merchant_category"),
    "status": _pair("status", "status"),
    "failureReason": _pair("failureReason", "failure_reason"),
    "initiatedAt": _pair("initiatedAt", f"CASE {_K} % 4 WHEN 0 THEN strftime(initiated_at, '%Y%m%dT%H%M%S,%f') "
                         "WHEN 1 THEN strftime(initiated_at + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S.%f+01:30') "
                         f"ELSE strftime(initiated_at, {_UTC}) END"),
    "completedAt": _pair("completedAt", f"CASE WHEN {_K} % 23 = 0 THEN '' ELSE strftime(completed_at, {_UTC}) END"),
    "channel": _pair("channel", "channel"),
    "agentCode": _pair("agentCode", "agent_code"),
    "region": _pair("region", "region"),
}


def _meta(inner: str) -> str:
    return _pair("meta", f"CASE WHEN {_K} % 3 = 0 THEN '{{' || concat_ws(',', {inner}) || '}}' END", False)


_ATTEMPT = f"'\"attempt\":' || ({_K} % 7)"
_TAGS, _KEPT = "'\"tags\":[\"' || channel || '\",\"x\"]'", "'\"sender\":{\"kept\":true}'"


def _object(members: list[str]) -> str:
    return "'{' || concat_ws(',', " + ", ".join(members) + ") || '}'"


# as the source sent it; and without the personal objects, keys in order of name
_PAYLOAD = _object([*_MEMBERS.values(), _meta(f"{_ATTEMPT}, {_TAGS}, {_KEPT}")])
_REDACTED = _object([
    m for _, m in sorted({
        **{k: m for k, m in _MEMBERS.items() if k not in ("sender", "recipient")},
        "meta": _meta(f"{_ATTEMPT}, {_KEPT}, {_TAGS}"),
    }.items())
])

_BROKEN_AMOUNT = f"replace({_PAYLOAD}, '\"amount\":', '\"amount\":\"x\",\"was\":')"
_PAGE_REASON = (
    f"CASE WHEN {_K} % 101 = 0 THEN 'not_an_object' WHEN {_K} % 103 = 0 OR amount <= 0 THEN 'bad_amount' "
    f"WHEN {_K} % 19 <> 0 AND fee < 0 THEN 'bad_fee' WHEN sender_raw IS NULL THEN 'missing_sender' "
    "WHEN initiated_at IS NULL THEN 'bad_initiated_at' END"
)
_PAGE_GOOD = f"{_PAGE_REASON} IS NULL"


def _expand_round(sql: str) -> str:
    """Rewrite ``sround(x, d)`` into DuckDB SQL with Spark's rounding.

    Spark rounds a double HALF_UP on its shortest decimal form (1.025 -> 1.03);
    DuckDB rounds the binary value (1.0249999999999999 -> 1.02). Going through
    the shortest text form and a DECIMAL reproduces Spark.
    """
    out, i, tag = [], 0, "sround("
    while True:
        j = sql.find(tag, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        k, depth, comma = j + len(tag), 1, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        expr = _expand_round(sql[j + len(tag) : comma])
        digits = sql[comma + 1 : k - 1].strip()
        out.append(
            f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"
        )
        i = k


def oracle_sql() -> dict[str, str]:
    return {k: _expand_round(v) for k, v in _oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    S, B = with_silver, with_bronze
    d, m = "," + DAILY, "," + MERCHANT
    # sources / landing
    q["bronze_land"] = B("SELECT * FROM bronze")
    q["staging_view"] = B(
        "SELECT * EXCLUDE (sender_phone, recipient_phone, raw_payload), "
        "sender_phone AS sender_token, recipient_phone AS recipient_token FROM bronze"
    )
    q["flatten_pages"] = B(
        "SELECT transaction_id, external_id, transaction_type, amount, "
        f"CASE WHEN {_K} % 17 = 0 THEN 'XOF' ELSE currency END AS currency, "
        f"CASE WHEN {_K} % 19 = 0 THEN 0.0::DOUBLE ELSE fee END AS fee, "
        f"{_canon('sender_raw')} AS sender_phone, {_canon('recipient_raw')} AS recipient_phone, "
        "merchant_code, merchant_name, merchant_category, status, failure_reason, initiated_at, "
        f"CASE WHEN {_K} % 23 <> 0 THEN completed_at END AS completed_at, channel, agent_code, region, "
        f"{_PAYLOAD} AS raw_payload FROM raw WHERE {_PAGE_GOOD}"
    )
    q["quarantine_pages"] = B(
        f"SELECT {_K} // {P.PAGE_SIZE} AS page, "
        f"CASE WHEN {_K} % 101 <> 0 THEN transaction_id END AS transaction_id, {_PAGE_REASON} AS reason, "
        f"CASE WHEN {_K} % 101 = 0 THEN '7' WHEN {_K} % 103 = 0 THEN {_BROKEN_AMOUNT} ELSE {_PAYLOAD} END AS raw_text "
        f"FROM raw WHERE NOT ({_PAGE_GOOD})"
    )
    q["payload_redacted"] = B(
        f"SELECT transaction_id, {_hmac(_canon('sender_raw'), P.SECRET)} AS sender_phone, "
        f"{_hmac(_canon('recipient_raw'), P.SECRET)} AS recipient_phone, {_REDACTED} AS raw_payload "
        f"FROM raw WHERE {_PAGE_GOOD}"
    )
    q["high_water_mark"] = B("SELECT max(initiated_at) AS high_water_mark FROM bronze")
    q["incremental_batch"] = B(
        "SELECT b.* FROM bronze b WHERE b.initiated_at > (SELECT max(initiated_at) FROM ex) "
        "AND NOT EXISTS (SELECT 1 FROM ex WHERE ex.transaction_id = b.transaction_id)",
        f", ex AS (SELECT * FROM bronze WHERE initiated_at < TIMESTAMP '{P.LANDED_UNTIL}')",
    )
    q["retention_keep"] = S("SELECT * FROM silver WHERE _date IS NULL OR _date >= DATE '2024-01-15'")
    q["retention_expired"] = S("SELECT * FROM silver WHERE _date < DATE '2024-01-15'")
    # privacy
    q["phone_canonical"] = B(
        f"SELECT transaction_id, _batch_id, {_canon('sender_phone')} AS sender_canonical, "
        f"{_canon('recipient_phone')} AS recipient_canonical FROM phones",
        "," + _PHONES,
    )
    prefixes = "('77', '78', '76', '70', '75')"
    q["phone_prefix_check"] = B(
        f"SELECT transaction_id, _batch_id, substr({_canon('sender_phone')}, 1, 2) IN {prefixes} AS sender_known_prefix, "
        f"substr({_canon('recipient_phone')}, 1, 2) IN {prefixes} AS recipient_known_prefix FROM phones",
        "," + _PHONES,
    )
    q["tokenize_phones"] = B(
        f"SELECT transaction_id, _batch_id, {_hmac(_canon('sender_phone'), P.SECRET)} AS sender_phone, "
        f"{_hmac(_canon('recipient_phone'), P.SECRET)} AS recipient_phone FROM phones",
        "," + _PHONES,
    )
    q["mask_phones"] = B(
        f"SELECT transaction_id, _batch_id, {_mask('sender_phone')} AS sender_phone_masked, "
        f"{_mask('recipient_phone')} AS recipient_phone_masked FROM phones",
        "," + _PHONES,
    )
    # silver
    q["range_half_open"] = B(
        f"SELECT * FROM bronze WHERE initiated_at >= TIMESTAMP '{P.SLICE_START}' "
        f"AND initiated_at < TIMESTAMP '{P.SLICE_END}'"
    )
    q["dedup_latest"] = S("SELECT * FROM dedup")
    q["quality_rules"] = B(f"SELECT transaction_id, _batch_id, {_RULES} FROM bronze")
    q["silver"] = S("SELECT * FROM silver")
    q["silver_sql_model"] = S(
        "SELECT * EXCLUDE (sender_phone, recipient_phone, raw_payload), "
        "sender_phone AS sender_token, recipient_phone AS recipient_token, "
        "coalesce(amount > 0, false) AS _quality_amount_positive, "
        "coalesce(amount < 50000000, false) AS _quality_amount_reasonable, "
        f"coalesce(status IN {_STATUSES}, false) AS _quality_valid_status, "
        "initiated_at IS NOT NULL AS _quality_has_initiated_at, "
        f"CASE WHEN amount > 0 AND status IN {_STATUSES} AND initiated_at IS NOT NULL "
        "THEN 'PASS' ELSE 'FAIL' END AS _quality_flag, "
        "CAST(initiated_at AS DATE) AS _date, CAST(hour(initiated_at) AS INTEGER) AS _hour, "
        "CAST(dayofweek(initiated_at) + 1 AS INTEGER) AS _day_of_week, "
        "CASE WHEN amount < 1000 THEN 'MICRO' WHEN amount < 5000 THEN 'SMALL' "
        "WHEN amount < 20000 THEN 'MEDIUM' WHEN amount < 100000 THEN 'LARGE' ELSE 'XLARGE' END AS _amount_bucket, "
        "coalesce((dayofweek(initiated_at) + 1) IN (1, 7), false) AS _is_weekend, "
        "coalesce(hour(initiated_at) BETWEEN 9 AND 12 OR hour(initiated_at) BETWEEN 15 AND 18, false) AS _is_peak_hour, "
        "merchant_code IS NOT NULL AS _is_merchant_txn, "
        "CAST(floor(epoch(completed_at)) - floor(epoch(initiated_at)) AS BIGINT) AS _processing_latency_seconds "
        "FROM dedup"
    )
    q["enrich_time"] = S(
        "SELECT transaction_id, _date, _hour, _day_of_week, _is_weekend, _is_peak_hour FROM silver"
    )
    q["amount_bucket"] = S("SELECT transaction_id, amount, _amount_bucket FROM silver")
    q["latency"] = S(
        "SELECT transaction_id, initiated_at, completed_at, _processing_latency_seconds FROM silver"
    )
    q["range_closed"] = S(
        f"SELECT * FROM silver WHERE _date >= DATE '{P.SLICE_START}' AND _date <= DATE '{P.SLICE_END}'"
    )
    q["quality_report"] = S(
        "SELECT count(*) AS total_rows, count(*) FILTER (WHERE _quality_flag = 'PASS') AS passing, "
        "count(*) FILTER (WHERE _quality_flag = 'FAIL') AS failing, "
        "count(*) FILTER (WHERE status = 'FAILED') AS failed_txns, "
        "count(*) FILTER (WHERE status = 'REVERSED') AS reversed_txns, "
        "min(amount) AS min_amount, max(amount) AS max_amount, avg(amount) AS avg_amount, "
        "sum(amount) AS total_volume_xof, min(_date) AS earliest_date, max(_date) AS latest_date "
        "FROM silver"
    )
    q["quality_failures"] = S(
        "SELECT count(*) AS total_rows, count(*) FILTER (WHERE _quality_flag = 'FAIL') AS failing, "
        "sround(count(*) FILTER (WHERE _quality_flag = 'FAIL') / count(*) * 100, 2) AS fail_pct, "
        "count(*) FILTER (WHERE _quality_flag = 'FAIL' AND NOT _quality_amount_positive) AS fail_amount_positive, "
        "count(*) FILTER (WHERE _quality_flag = 'FAIL' AND NOT _quality_valid_status) AS fail_valid_status, "
        "count(*) FILTER (WHERE _quality_flag = 'FAIL' AND NOT _quality_has_initiated_at) AS fail_has_initiated_at "
        "FROM silver"
    )
    q["normalize_metrics"] = S(
        "SELECT r AS rows_read, w AS rows_written, r - w AS duplicates_removed, f AS quality_failures, "
        "f AS rows_with_warnings, CASE WHEN w > 0 THEN sround((w - f) / w * 100, 2) ELSE 0.0 END AS quality_pass_rate "
        "FROM (SELECT (SELECT count(*) FROM bronze) AS r, count(*) AS w, "
        "count(*) FILTER (WHERE _quality_flag = 'FAIL') AS f FROM silver)"
    )
    q["failure_sample"] = S(
        "SELECT * FROM silver WHERE _quality_flag = 'FAIL' ORDER BY transaction_id LIMIT 20"
    )
    q["silver_sample"] = S(
        "SELECT transaction_id, amount, status, _date, _hour, _day_of_week, _is_weekend, "
        "_is_peak_hour, _amount_bucket, _is_merchant_txn, _processing_latency_seconds, "
        "_quality_flag FROM silver ORDER BY transaction_id LIMIT 20"
    )
    # gold
    q["daily_summary"] = S("SELECT * FROM daily", d)
    q["daily_summary_rounded"] = S("SELECT * FROM daily", "," + DAILY_ROUNDED)
    q["merchant_activity"] = S("SELECT * FROM merchant", m)
    q["merchant_activity_rounded"] = S("SELECT * FROM merchant", "," + MERCHANT_ROUNDED)
    # fraud
    q["sender_day_counts"] = S("SELECT * FROM vc", _fraud())
    q["sender_recent_avg"] = S(
        "SELECT sender_phone, avg(amount) AS avg_amount_7d FROM pass "
        "WHERE initiated_at >= TIMESTAMP '2024-01-24' GROUP BY sender_phone"
    )
    q["transfer_gaps"] = S(
        "SELECT transaction_id, sender_phone, recipient_phone, initiated_at, prev_txn_time, "
        "minutes_since_prev FROM gaps",
        _fraud(),
    )
    q["fraud_velocity"] = S("SELECT * FROM f_velocity", _fraud())
    q["fraud_velocity_day"] = S("SELECT * FROM f_velocity", "," + _DAY + _fraud("day_pass", 3))
    q["fraud_amount_spike"] = S("SELECT * FROM f_spike", _fraud())
    spike = (
        "SELECT p.transaction_id, p.sender_phone, p.recipient_phone, p.amount, p.initiated_at, p.channel, "
        "p.region, 'AMOUNT_SPIKE' AS flag_pattern, CAST(sround(p.amount, 2) AS VARCHAR) AS flag_detail_1, "
        "sround(mean, 2) AS flag_detail_2 "
    )
    q["fraud_amount_spike_since"] = S(
        spike + "FROM pass p JOIN (SELECT sender_phone, avg(amount) AS mean FROM pass "
        f"WHERE initiated_at >= TIMESTAMP '{P.SLICE_START}' AND initiated_at < TIMESTAMP '{P.SLICE_END}' "
        "GROUP BY sender_phone) m ON m.sender_phone = p.sender_phone WHERE p.amount > mean * 5.0"
    )
    q["rolling_spike"] = S(
        spike + "FROM (SELECT a.transaction_id, any_value(a.sender_phone) AS sender_phone, "
        "any_value(a.recipient_phone) AS recipient_phone, any_value(a.amount) AS amount, "
        "any_value(a.initiated_at) AS initiated_at, any_value(a.channel) AS channel, "
        "any_value(a.region) AS region, CAST(sum(CAST(b.amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean "
        "FROM pass a JOIN pass b ON b.sender_phone = a.sender_phone AND b._date BETWEEN a._date - 7 AND a._date "
        "AND (b._date < a._date OR (b.initiated_at, b.transaction_id) <= (a.initiated_at, a.transaction_id)) "
        "GROUP BY a.transaction_id) p WHERE p.amount > mean * 5.0"
    )
    q["fraud_rapid_transfer"] = S("SELECT * FROM f_rapid", _fraud())
    q["fraud_off_hours"] = S("SELECT * FROM f_off", _fraud())
    q["fraud_flags_all"] = S("SELECT * FROM f_all", _fraud())
    q["fraud_flags"] = S("SELECT * FROM flags", _fraud())
    q["fraud_flags_day"] = S("SELECT * FROM flags", "," + _DAY + _fraud("day_pass"))
    # checks
    q["check_unique"] = B(
        "SELECT transaction_id, count(*) AS n_records FROM bronze WHERE transaction_id IS NOT NULL "
        "GROUP BY transaction_id HAVING count(*) > 1"
    )
    q["check_unique_silver"] = S(
        "SELECT transaction_id, count(*) AS n_records FROM silver WHERE transaction_id IS NOT NULL "
        "GROUP BY transaction_id HAVING count(*) > 1"
    )
    q["check_not_null"] = B(
        "SELECT transaction_id, _batch_id, amount, initiated_at FROM bronze "
        "WHERE transaction_id IS NULL OR amount IS NULL OR initiated_at IS NULL"
    )
    q["check_accepted_values"] = B(
        f"SELECT transaction_id, _batch_id, status FROM bronze "
        f"WHERE status IS NOT NULL AND status NOT IN {_STATUSES}"
    )
    q["check_accepted_types"] = B(
        "SELECT transaction_id, _batch_id, transaction_type FROM bronze WHERE transaction_type IS NOT NULL "
        "AND transaction_type NOT IN ('PAYMENT', 'TRANSFER', 'WITHDRAWAL', 'DEPOSIT', 'REFUND')"
    )
    q["check_accepted_range"] = B(
        "SELECT transaction_id, _batch_id, amount FROM bronze "
        "WHERE amount IS NOT NULL AND NOT (amount > 0 AND amount < 50000000)"
    )
    q["check_success_rate_range"] = S(
        "SELECT * FROM daily WHERE success_rate IS NOT NULL AND NOT (success_rate >= 0 AND success_rate <= 100)",
        d,
    )
    q["check_at_least_one"] = S(
        "SELECT count(transaction_count) AS n_non_null FROM daily HAVING count(transaction_count) = 0", d
    )
    # reports
    q["bronze_range"] = B(
        "SELECT min(initiated_at) AS min_initiated_at, max(initiated_at) AS max_initiated_at FROM bronze"
    )
    for key, cols in (
        ("status_distribution", "status"),
        ("channel_region", "channel, region"),
        ("type_distribution", "transaction_type"),
        ("channel_distribution", "channel"),
        ("region_distribution", "region"),
    ):
        q[key] = B(f"SELECT {cols}, count(*) AS txn_count FROM bronze GROUP BY {cols}")
    q["amount_stats"] = B(
        "SELECT count(*) AS txn_count, sum(amount) AS total_volume, avg(amount) AS avg_amount, "
        "median(amount) AS median_amount, min(amount) AS min_amount, max(amount) AS max_amount FROM bronze"
    )
    q["type_share"] = B(_share("transaction_type", "bronze"))
    q["region_share"] = B(_share("region", "bronze"))
    q["top_regions"] = B(_share("region", "bronze") + " ORDER BY txn_count DESC, region LIMIT 5")
    q["duplicate_report"] = B(
        "SELECT count(*) AS total_rows, count(DISTINCT transaction_id) AS unique_ids, "
        "count(*) - count(DISTINCT transaction_id) AS duplicates FROM bronze"
    )
    q["batch_audit"] = B("SELECT DISTINCT _batch_id, _ingested_at, _source_file FROM bronze")
    q["bucket_distribution"] = S(_share("_amount_bucket", "silver"))
    q["peak_offpeak"] = S(
        "SELECT _is_peak_hour, count(*) AS txn_count, sum(amount) AS total_volume_xof, "
        "avg(amount) AS avg_amount_xof FROM silver GROUP BY _is_peak_hour"
    )
    q["summary_last_7d"] = S(f"SELECT * FROM daily WHERE _date >= {_SEVEN_DAYS}", d)
    q["kpi_last_7d"] = S(
        "SELECT CAST(sum(transaction_count) AS BIGINT) AS total_txns, sum(total_volume_xof) AS total_volume, "
        f"{_MEAN_RATE} AS avg_success_rate, sum(total_fees_xof) AS total_fees, "
        f"{_exact_mean('avg_latency_seconds')} AS avg_latency FROM daily WHERE _date >= {_SEVEN_DAYS}",
        d,
    )
    q["region_performance"] = S(
        "SELECT region, CAST(sum(transaction_count) AS BIGINT) AS txn_count, "
        f"sum(total_volume_xof) AS volume_xof, {_MEAN_RATE} AS avg_success_pct "
        "FROM daily GROUP BY region",
        d,
    )
    for key, rate in (
        ("dashboard_region_7d", _MEAN_RATE),
        ("dashboard_region_7d_rounded", f"sround({_MEAN_RATE}, 1)"),
    ):
        q[key] = S(
            "SELECT _date, region, CAST(sum(transaction_count) AS BIGINT) AS txns, "
            f"sum(total_volume_xof) AS volume_xof, {rate} AS success_pct FROM daily "
            f"WHERE _date >= {_SEVEN_DAYS} GROUP BY _date, region",
            d,
        )
    q["top_merchants"] = S(
        "SELECT merchant_name, merchant_category, sum(total_volume_xof) AS total_volume, "
        "CAST(sum(transaction_count) AS BIGINT) AS txn_count, "
        f"{_exact_mean('avg_transaction_xof')} AS avg_txn, "
        "CAST(sum(unique_customers) AS BIGINT) AS customers FROM merchant "
        "GROUP BY merchant_name, merchant_category "
        "ORDER BY total_volume DESC, merchant_name NULLS FIRST, merchant_category NULLS FIRST LIMIT 10",
        m,
    )
    q["flag_breakdown"] = S(
        "SELECT flag_pattern, count(*) AS flag_count FROM flags GROUP BY flag_pattern", _fraud()
    )
    q["top_flags"] = S("SELECT * FROM flags ORDER BY amount DESC, transaction_id LIMIT 50", _fraud())
    q["velocity_detail"] = S(
        "SELECT transaction_id, sender_phone, amount, flag_detail_1, region, channel FROM flags "
        "WHERE flag_pattern = 'VELOCITY_ANOMALY' "
        "ORDER BY CAST(flag_detail_1 AS INTEGER) DESC, transaction_id LIMIT 20",
        _fraud(),
    )
    q["spike_detail"] = S(
        "SELECT transaction_id, sender_phone, amount, flag_detail_1, flag_detail_2, region FROM flags "
        "WHERE flag_pattern = 'AMOUNT_SPIKE' ORDER BY amount DESC, transaction_id LIMIT 20",
        _fraud(),
    )
    def by_rule(rules: dict[str, str], src: str) -> str:
        return " UNION ALL ".join(
            f"SELECT '{n}' AS \"check\", count(*) FILTER (WHERE {c}) AS n_failed FROM {src}" for n, c in rules.items()
        )

    rules = {f"bronze_{c}_not_null": f"{c} IS NULL" for c in
             ("transaction_id", "transaction_type", "status", "amount", "initiated_at")}
    rules["bronze_amount_range"] = "amount <= 0 OR amount >= 50000000"
    rules["bronze_status_accepted"] = f"status NOT IN {_STATUSES}"
    rules["bronze_type_accepted"] = (
        "transaction_type NOT IN ('PAYMENT', 'TRANSFER', 'WITHDRAWAL', 'DEPOSIT', 'REFUND')"
    )
    q["check_rules_bronze"] = B(by_rule(rules, "bronze"))
    q["check_failures_bronze"] = B(" UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", transaction_id, _batch_id FROM bronze WHERE {c}" for n, c in rules.items()
    ))
    q["check_rules_silver"] = S(by_rule({
        "silver_transaction_id_not_null": "transaction_id IS NULL",
        "silver_quality_flag_not_null": "_quality_flag IS NULL", "silver_date_not_null": "_date IS NULL",
        "silver_flag_accepted": "_quality_flag NOT IN ('PASS', 'FAIL')",
        "silver_bucket_accepted": "_amount_bucket NOT IN ('MICRO', 'SMALL', 'MEDIUM', 'LARGE', 'XLARGE')",
    }, "silver"))
    rate = "success_rate < 0 OR success_rate > 100"
    q["check_rules_daily"] = S(by_rule({
        "daily_date_not_null": "_date IS NULL", "daily_count_not_null": "transaction_count IS NULL",
        "daily_success_rate_range": rate,
    }, "daily"), d)
    q["check_rules_merchant"] = S(by_rule({
        "merchant_code_not_null": "merchant_code IS NULL", "merchant_success_rate_range": rate,
    }, "merchant"), m)
    q["check_unique_sender_day"] = S(
        "SELECT sender_phone, _date, count(*) AS n_records FROM silver WHERE sender_phone IS NOT NULL "
        "AND _date IS NOT NULL GROUP BY sender_phone, _date HAVING count(*) > 1"
    )
    q["check_types_narrow"] = B(
        "SELECT transaction_id, _batch_id, transaction_type FROM bronze "
        "WHERE transaction_type NOT IN {}".format(str(tuple(TRANSACTION_TYPES[:2])))
    )
    q["check_rate_narrow"] = S(
        "SELECT merchant_code, _date, success_rate FROM merchant WHERE success_rate < 50 OR success_rate > 99", m
    )
    q["check_reason_absent"] = S("SELECT CAST(0 AS BIGINT) AS n_non_null FROM silver WHERE status = 'SUCCESS' "
                                 "HAVING count(failure_reason) = 0")
    q["bronze_sample"] = B("SELECT * FROM bronze ORDER BY transaction_id, _ingested_at, _batch_id LIMIT 10")
    # stored layers
    q["landing_incremental"] = B("SELECT transaction_id, amount, initiated_at, _batch_id FROM bronze")
    q["retained_silver"] = S(
        "SELECT transaction_id, amount, _date FROM silver WHERE _date IS NULL OR _date >= DATE '2024-01-15'"
    )
    landed = "transaction_id, amount, initiated_at"
    q["landing_streams"] = B(
        f"SELECT {landed}, 'stream-' || CASE WHEN ({_K} // {P.PAGE_SIZE}) % 2 = 0 THEN 'a' ELSE 'b' END "
        f"|| '-00000000' AS _batch_id FROM raw WHERE {_PAGE_GOOD}"
    )
    q["landing_one_batch"] = B(
        f"SELECT {landed}, 'one' AS _batch_id FROM bronze, "
        f"(VALUES (DATE '{P.SLICE_START}'), (DATE '{P.SLICE_END}')) AS t(d) WHERE initiated_at IS NULL "
        "OR CAST(initiated_at AS DATE) BETWEEN d - 3 AND d"
    )
    moved = (
        ", moved AS (SELECT transaction_id, amount, "
        "coalesce(initiated_at, completed_at, _ingested_at) + INTERVAL 15 DAY AS at FROM bronze "
        f"WHERE _batch_id = 'batch-2' AND coalesce(initiated_at, completed_at, _ingested_at) "
        f"+ INTERVAL 15 DAY < TIMESTAMP '{P.AS_OF}')"
    )
    either = (
        "SELECT b.transaction_id, coalesce(m.amount, b.amount) AS amount, "
        "CASE WHEN m.at IS NULL THEN b.initiated_at ELSE m.at END AS initiated_at, {more} "
        "FROM bronze b LEFT JOIN moved m USING (transaction_id) WHERE b._batch_id = 'batch-1'"
    )
    q["landing_again"] = B(either.format(more="b._batch_id"), moved)
    q["silver_corrected"] = B(
        either.format(more="CAST(CASE WHEN m.at IS NULL THEN b.initiated_at ELSE m.at END AS DATE) AS _date"),
        moved,
    )
    return q
