"""API pages made from the ``events`` table: the input of the page queries.

Only gives the page parser rows to work on, in the source's shape. A rule on the
event's number leaves keys out, adds keys the parser does not know, gives numbers as
text and times in other ISO forms, and breaks some elements; both deliveries of a
re-delivered event are in its page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.events import with_redelivery

# Elements as the source sends them; ``k`` is the event's number.
_ELEMENT = """
to_json(named_struct(
  'id', transaction_id, 'externalId', external_id, 'type', transaction_type,
  'amount', CAST(amount AS BIGINT), 'currency', IF(k % 17 = 0, NULL, currency),
  'fee', IF(k % 19 = 0, NULL, CAST(fee AS BIGINT)),
  'sender', IF(sender_phone IS NULL, NULL, named_struct('msisdn', sender_phone, 'name', concat('S', k))),
  'recipient', named_struct('msisdn', recipient_phone),
  'merchantCode', merchant_code, 'merchantName', merchant_name, 'merchantCategory', merchant_category,
  'status', status, 'failureReason', failure_reason,
  'initiatedAt', CASE k % 4
    WHEN 0 THEN date_format(initiated_at, "yyyyMMdd'T'HHmmss,SSSSSS")
    WHEN 1 THEN date_format(initiated_at + INTERVAL 90 MINUTES, "yyyy-MM-dd HH:mm:ss.SSSSSS'+01:30'")
    ELSE date_format(initiated_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END,
  'completedAt', IF(k % 23 = 0, '', date_format(completed_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
  'channel', channel, 'agentCode', agent_code, 'region', region,
  'meta', IF(k % 3 = 0, named_struct('attempt', k % 7, 'tags', array(channel, 'x'),
    'sender', named_struct('kept', true)), NULL)
))
"""


def api_pages(events: DataFrame, page_size: int, body_col: str = "body") -> DataFrame:
    """(page, body): pages of the elements of ``page_size`` consecutive event numbers."""
    rows = with_redelivery(events.withColumn("k", F.col("event_id")), keep=("k",))
    element = F.when(F.col("k") % 101 == 0, F.lit("7")).when(
        F.col("k") % 103 == 0, F.expr(f"replace({_ELEMENT}, '\"amount\":', '\"amount\":\"x\",\"was\":')")
    ).otherwise(F.expr(_ELEMENT))
    page = F.floor(F.col("k") / page_size)
    pages = rows.select(page.alias("page"), element.alias("e")).groupBy("page").agg(
        F.collect_list("e").alias("e")
    )
    body = F.concat(
        F.lit('{"transactions":['), F.array_join("e", ","), F.lit('],"page":'), F.col("page").cast("string"),
        F.lit(',"totalCount":'), F.size("e").cast("string"), F.lit("}"),
    )
    return pages.select("page", body.alias(body_col))
