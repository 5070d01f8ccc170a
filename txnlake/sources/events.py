"""Map the driver's ``events`` table onto raw transaction records (Bronze).

The column recipe is a fixed test fixture: every derived column is a pure
function of one event row, so the mapping is a single narrow projection (no
shuffle) over one scan. Every 50th event is exploded into a second, later
delivery (``batch-2``) so that keep-latest deduplication has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.privacy import canonical_phones, tokenize_phones

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")

BRONZE_COLUMNS = (
    "transaction_id",
    "external_id",
    "transaction_type",
    "amount",
    "currency",
    "fee",
    "sender_phone",
    "recipient_phone",
    "merchant_code",
    "merchant_name",
    "merchant_category",
    "status",
    "failure_reason",
    "initiated_at",
    "completed_at",
    "channel",
    "agent_code",
    "region",
    "raw_payload",
    "_ingested_at",
    "_source_file",
    "_batch_id",
)

# Fixed values of the fixture recipe.
TYPE_BY_EVENT = {
    "purchase": "PAYMENT",
    "click": "TRANSFER",
    "view": "DEPOSIT",
    "signup": "WITHDRAWAL",
}
OTHER_TYPE = "REFUND"
REDELIVERY_EVERY = 50


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table. How it is split is the reader's setting
    (``spark.sql.files.maxPartitionBytes``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: str, mapping: dict[str, str], other: str) -> str:
    arms = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {arms} ELSE '{other}' END"


# The recipe as SQL expressions over one event row. Each string is parsed on
# the JVM side, so building the plan costs one call per column instead of one
# per sub-expression.
_STATUS = (
    "CASE WHEN event_id % 73 = 0 THEN 'UNKNOWN' WHEN event_id % 12 = 0 THEN 'FAILED' "
    "WHEN event_id % 25 = 0 THEN 'PENDING' WHEN event_id % 40 = 7 THEN 'REVERSED' "
    "ELSE 'SUCCESS' END"
)
_CHANNEL = (
    "CASE WHEN event_id % 20 < 13 THEN 'USSD' WHEN event_id % 20 < 18 THEN 'APP' "
    "WHEN event_id % 20 = 18 THEN 'WEB' ELSE 'AGENT' END"
)
_RAW_EXPRS = (
    "concat('OM', lpad(CAST(event_id AS STRING), 12, '0')) AS transaction_id",
    "CASE WHEN event_id % 10 < 3 THEN concat('EXT-', lpad(CAST(event_id AS STRING), 12, '0')) END"
    " AS external_id",
    _case("event_type", TYPE_BY_EVENT, OTHER_TYPE) + " AS transaction_type",
    "CASE WHEN event_id % 97 = 0 THEN 0.0D ELSE CAST(floor(value * 400) AS DOUBLE) END AS amount",
    "CASE WHEN event_id % 89 = 0 THEN 'EUR' ELSE 'XOF' END AS currency",
    "CASE WHEN event_id % 83 = 0 THEN -1.0D ELSE CAST(floor(value * 4) AS DOUBLE) END AS fee",
    "CASE WHEN event_id % 79 = 0 THEN CAST(NULL AS STRING) ELSE concat("
    "CASE WHEN event_id % 7 = 0 THEN '+221 ' ELSE '' END, '77', "
    "lpad(CAST(user_id AS STRING), 7, '0')) END AS sender_phone",
    "concat('78', lpad(CAST(CAST(get_json_object(props, '$.k') AS INT) % 5 AS STRING), 7, '0'))"
    " AS recipient_phone",
    "CASE WHEN event_id % 5 < 3 THEN concat('MERCH', lpad(CAST(event_id % 25 AS STRING), 5, '0'))"
    " END AS merchant_code",
    "CASE WHEN event_id % 5 < 3 THEN concat('Merchant ', CAST(event_id % 25 AS STRING)) END"
    " AS merchant_name",
    "CASE WHEN event_id % 5 = 0 THEN 'FOOD' WHEN event_id % 5 = 1 THEN 'TRANSPORT' "
    "WHEN event_id % 5 = 2 THEN 'RETAIL' END AS merchant_category",
    "status",
    "CASE WHEN status = 'FAILED' THEN 'INSUFFICIENT_FUNDS' END AS failure_reason",
    "CASE WHEN event_id % 71 = 0 THEN NULL ELSE ts END AS initiated_at",
    "CASE WHEN status = 'PENDING' THEN NULL "
    "ELSE timestampadd(SECOND, CAST(event_id % 30 + 1 AS INT), ts) END AS completed_at",
    "channel",
    "CASE WHEN channel = 'AGENT' THEN concat('AG', lpad(CAST(event_id % 100 AS STRING), 5, '0'))"
    " END AS agent_code",
    "concat('Region ', CAST(user_id % 11 AS STRING)) AS region",
    "props AS raw_payload",
    "ts + INTERVAL 1 HOUR AS _ingested_at",
    "concat('events/', date_format(ts, 'yyyy-MM-dd')) AS _source_file",
    "'batch-1' AS _batch_id",
)


def raw_transactions(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One raw transaction per event, first delivery (``batch-1``).

    ``keep`` names extra input columns carried through unchanged.
    """
    return events.selectExpr(
        *EVENT_COLUMNS, *keep, f"{_STATUS} AS status", f"{_CHANNEL} AS channel"
    ).selectExpr(*_RAW_EXPRS, *keep)


def with_redelivery(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every event once, and every 50th a second time one hour later.

    One scan: each event row is exploded into its delivery numbers, and the
    second delivery (``batch-2``) carries amount + 1 and a later ingest time.
    """
    deliveries = events.withColumn(
        "_delivery",
        F.explode(F.expr(f"IF(event_id % {REDELIVERY_EVERY} = 0, array(1, 2), array(1))")),
    )
    return (
        raw_transactions(deliveries, keep=("_delivery", *keep))
        .withColumns(
            {
                "amount": F.expr("amount + (_delivery - 1)"),
                "_ingested_at": F.expr("_ingested_at + (_delivery - 1) * INTERVAL 1 HOUR"),
                "_batch_id": F.expr("concat('batch-', CAST(_delivery AS STRING))"),
            }
        )
        .drop("_delivery")
    )


def bronze_from_events(events: DataFrame, secret: str | bytes | None = None) -> DataFrame:
    """Bronze rows (22 columns) with canonical phones, tokenised when a secret is given.

    Phones are canonicalised at the edge exactly as the source model does
    before landing; with ``secret`` they are then replaced by HMAC tokens.
    """
    bronze = with_redelivery(events)
    if secret is None:
        return canonical_phones(bronze)
    return tokenize_phones(bronze, secret)
