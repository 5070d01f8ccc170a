"""API page documents (JSON text) -> transaction rows.

``flatten_pages`` is the distributed replacement of a driver-side parse loop:
``from_json`` with a declared schema, ``explode`` of the transaction list,
per-field defaults and ``try_cast`` parsing. Every element is either a good
row or a quarantined row with a reason, never silently lost; a page that is
not JSON at all is quarantined as one row.

Each element keeps its own JSON text, which is the stored payload; its fields
are parsed from that text as strings first, so a value of the wrong type becomes
a reason instead of an error or a silent NULL. Only an absent key has a default:
an explicit null currency or fee is a reason. An empty completion time counts as
absent, an empty transaction list is a normal page.

A page is parsed once and each of its elements once: elements are parsed inside the
array, before it is exploded, so neither a filter nor a later column repeats it.

A redacted payload is the element as a VARIANT without its ``sender`` and ``recipient``
keys: unknown fields, numbers and nested values stay what they are. An element that is
no VARIANT (a key given twice) keeps its declared fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.privacy import phone_canonical, tokenize

PARTY = T.StructType(
    [T.StructField("msisdn", T.StringType()), T.StructField("name", T.StringType())]
)

ELEMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("externalId", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("fee", T.StringType()),
        T.StructField("sender", PARTY),
        T.StructField("recipient", PARTY),
        T.StructField("merchantCode", T.StringType()),
        T.StructField("merchantName", T.StringType()),
        T.StructField("merchantCategory", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("failureReason", T.StringType()),
        T.StructField("initiatedAt", T.StringType()),
        T.StructField("completedAt", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("agentCode", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("transactions", T.ArrayType(T.StringType())),  # each element's own text
        T.StructField("page", T.LongType()),
        T.StructField("totalCount", T.LongType()),
        T.StructField("hasMore", T.BooleanType()),
        T.StructField("_corrupt", T.StringType()),  # set when the text is not JSON
    ]
)

# Defaults applied when a field is absent.
DEFAULT_CURRENCY = "XOF"
DEFAULT_FEE = 0.0
DEFAULT_STATUS = "SUCCESS"
DEFAULT_CHANNEL = "USSD"


# Fixed patterns: plain decimal numbers; ISO 8601 as ``datetime.fromisoformat`` reads it,
# i.e. calendar or week date, any one separator, and a time with or without colons.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DATE = r"(\d{4}(-\d{2}-\d{2}|\d{4}|-W\d{2}(-\d)?|W\d{2}\d?))"
_CLOCK = r"\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?|\d{2}(\d{2}([.,]\d+)?)?)?"
_OFFSET = r"(Z|[+-]\d{2}(:?[0-5]\d(:?[0-5]\d)?)?)?"
ISO_TIME = f"(?s)^{_DATE}(.{_CLOCK}{_OFFSET})?$"
USUAL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"
WEEK = r"(?s)^(\d{4})-?W(\d{2})-?(\d?)"
# (pattern, replacement), in this order: other ISO forms to the usual one
_TO_USUAL = (
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
    (r"(?s)^(.{10}).", "$1T"),
    (r"T(\d{2})(\d{2})(\d{2})", "T$1:$2:$3"),
    (r"T(\d{2})(\d{2})(?!\d)", "T$1:$2"),
    (r"^(.{10})$", "$1T00"),
    (r"T(\d{2})(?!:)", "T$1:00"),
    (r"T(\d{2}:\d{2})(?!:)", "T$1:00"),
    (r"[.,](\d{1,6})\d*(?=[Z+-]|$)", ".$1"),
    (r"(T[^Z+-]*)$", "$1Z"),
    (r"(T.*[+-]\d{2})$", "$1:00"),
    (r"(T.*[+-]\d{2})(\d{2})", "$1:$2"),
    (r"(T.*[+-]\d{2}:\d{2})(\d{2})", "$1:$2"),
)


def _calendar_date(text: Column) -> Column:
    """Text that begins with a week date, with the calendar date instead."""
    part = lambda g: F.regexp_extract(text, WEEK, g)
    monday = F.date_trunc("week", F.concat(part(1), F.lit("-01-04")).try_cast("timestamp_ntz")).cast("date")
    week, day = part(2).cast("int"), F.coalesce(F.when(part(3) != "", part(3)), F.lit("1")).cast("int")
    # week 53 exists only where its Thursday is still in the year
    there = (week >= 1) & day.between(1, 7) & (F.year(F.date_add(monday, week * 7 - 4)) == part(1).cast("int"))
    found = F.when(there, F.date_add(monday, week * 7 - 8 + day).cast("string"))
    return F.concat(found, F.regexp_replace(text, WEEK, ""))


def _utc_ntz(text: Column) -> Column:
    """ISO text with or without an offset -> UTC wall time (TIMESTAMP_NTZ), independent
    of the session time zone; text without an offset is UTC; anything else NULL.
    Fractions are cut to microseconds; offsets have no fractions."""
    other = F.when(text.rlike(WEEK), _calendar_date(text)).otherwise(text)
    for pattern, replacement in _TO_USUAL:
        other = F.regexp_replace(other, pattern, replacement)
    usual = F.when(text.rlike(USUAL), text).when(text.rlike(ISO_TIME), other)
    micros = F.unix_micros(usual.try_cast("timestamp"))
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def _number(text: Column) -> Column:
    """Plain decimal text -> finite double; anything else NULL."""
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def _completed(tx: Column) -> Column:
    return F.when(tx["completedAt"] != "", tx["completedAt"])


def _elements(pages: DataFrame, body_col: str) -> DataFrame:
    """A row for each element (column ``_el``), and one for a page without a list. All
    parsing is done inside the array, so that it is done once."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = pages.withColumn("_doc", F.from_json(F.col(body_col), PAGE, options))

    def fields(text: Column, place: Column) -> Column:
        return F.struct(
            place.cast("int").alias("pos"), text.alias("txt"), F.from_json(text, ELEMENT).alias("tx"),
            F.json_object_keys(text).alias("keys"),
        )

    def values(e: Column) -> Column:
        tx = e["tx"]
        return F.struct(
            e["pos"].alias("pos"), e["txt"].alias("txt"), tx.alias("tx"), e["keys"].alias("keys"),
            _number(tx["amount"]).alias("amount"), _number(tx["fee"]).alias("fee"),
            _utc_ntz(tx["initiatedAt"]).alias("initiated"), _utc_ntz(_completed(tx)).alias("completed"),
            F.lit(None).cast("string").alias("page_reason"),
        )

    def page_only(reason: str) -> Column:
        none = F.lit(None)
        return F.array(F.struct(
            none.cast("int").alias("pos"), none.cast("string").alias("txt"), none.cast(ELEMENT).alias("tx"),
            none.cast("array<string>").alias("keys"), none.cast("double").alias("amount"),
            none.cast("double").alias("fee"), none.cast("timestamp_ntz").alias("initiated"),
            none.cast("timestamp_ntz").alias("completed"), F.lit(reason).alias("page_reason"),
        ))

    elements = (
        F.when(F.col("_doc").isNull() | F.col("_doc._corrupt").isNotNull(), page_only("not_json"))
        .when(F.col("_doc.transactions").isNull(), page_only("no_transactions"))
        .otherwise(F.transform(F.transform("_doc.transactions", fields), values))
    )
    return parsed.select(*pages.columns, F.explode(elements).alias("_el"))


def _reason() -> Column:
    el, tx, keys = F.col("_el"), F.col("_el.tx"), F.col("_el.keys")
    null_given = lambda k: F.array_contains(keys, k) & tx[k].isNull()
    return (
        F.when(el["page_reason"].isNotNull(), el["page_reason"])
        .when(tx.isNull() | keys.isNull(), "not_an_object")
        .when(tx["id"].isNull(), "missing_id")
        .when(tx["type"].isNull(), "missing_type")
        .when(el["amount"].isNull() | (el["amount"] <= 0), "bad_amount")
        .when(null_given("currency"), "bad_currency")
        .when(
            null_given("fee") | (tx["fee"].isNotNull() & el["fee"].isNull()) | (el["fee"] < 0), "bad_fee"
        )
        .when(tx["sender"]["msisdn"].isNull(), "missing_sender")
        .when(tx["recipient"]["msisdn"].isNull(), "missing_recipient")
        .when(el["initiated"].isNull(), "bad_initiated_at")
        .when(_completed(tx).isNotNull() & el["completed"].isNull(), "bad_completed_at")
    )


def redacted(text: Column, tx: Column) -> Column:
    """An element's JSON without the personal objects; keys come in order of name."""
    whole = F.try_parse_json(text).cast("map<string,variant>")
    kept = F.map_filter(whole, lambda k, _: ~k.isin("sender", "recipient"))
    return F.coalesce(F.to_json(kept), F.to_json(tx.dropFields("sender", "recipient")))


def _row_columns(secret: str | bytes | None) -> list[Column]:
    tx, text = F.col("_el.tx"), F.col("_el.txt")

    def phone(c: Column) -> Column:
        canon = phone_canonical(c)
        return canon if secret is None else tokenize(canon, secret)

    return [
        tx["id"].alias("transaction_id"),
        tx["externalId"].alias("external_id"),
        tx["type"].alias("transaction_type"),
        F.col("_el.amount").alias("amount"),
        F.coalesce(tx["currency"], F.lit(DEFAULT_CURRENCY)).alias("currency"),
        F.coalesce(F.col("_el.fee"), F.lit(DEFAULT_FEE)).alias("fee"),
        phone(tx["sender"]["msisdn"]).alias("sender_phone"),
        phone(tx["recipient"]["msisdn"]).alias("recipient_phone"),
        tx["merchantCode"].alias("merchant_code"),
        tx["merchantName"].alias("merchant_name"),
        tx["merchantCategory"].alias("merchant_category"),
        F.coalesce(tx["status"], F.lit(DEFAULT_STATUS)).alias("status"),
        tx["failureReason"].alias("failure_reason"),
        F.col("_el.initiated").alias("initiated_at"),
        F.col("_el.completed").alias("completed_at"),
        F.coalesce(tx["channel"], F.lit(DEFAULT_CHANNEL)).alias("channel"),
        tx["agentCode"].alias("agent_code"),
        tx["region"].alias("region"),
        (text if secret is None else redacted(text, tx)).alias("raw_payload"),
    ]


def _rejected_columns(body_col: str, secret: str | bytes | None) -> list[Column]:
    text = F.when(F.col("reason") == "not_json", F.col(body_col)).otherwise(F.col("_el.txt"))
    if secret is not None:
        text = F.when(
            F.col("reason").isin("not_json", "not_an_object"),
            F.concat(F.lit("sha256:"), F.sha2(text, 256)),
        ).otherwise(redacted(F.col("_el.txt"), F.col("_el.tx")))
    return [
        F.col("_el.tx.id").alias("transaction_id"),
        F.col("_el.pos").alias("position"),
        F.col("reason"),
        text.alias("raw_text"),
    ]


def token_secret(secret: str | bytes | None, tokenize: bool) -> str | bytes | None:
    """The secret that a landing uses: phones are tokenised unless that is turned off."""
    if not tokenize:
        return None
    if not secret:
        raise ValueError("tokenising phones needs a secret; pass tokenize=False to land them as they are")
    return secret


def flatten_pages(
    pages: DataFrame,
    body_col: str = "body",
    secret: str | bytes | None = None,
) -> DataFrame:
    """Good transaction rows of all pages (Bronze columns without audit).

    Phones are canonicalised; with ``secret`` they are tokenised and the
    sender/recipient objects are removed from the stored payload.
    """
    return _elements(pages, body_col).filter(_reason().isNull()).select(*_row_columns(secret))


def quarantine_pages(
    pages: DataFrame, body_col: str = "body", secret: str | bytes | None = None
) -> DataFrame:
    """Rejected elements (and non-JSON pages) with the first failing reason.

    Each row carries the rejected element's own JSON (``raw_text``), so its size
    is bounded by one element; the full page text is kept only for a page that
    is not JSON at all. With ``secret`` no personal data is stored: the
    sender/recipient objects are removed, and only the SHA-256 of text that
    cannot be parsed is kept (see ``redacted``). Other columns of ``pages`` (e.g. a page number)
    are kept.
    """
    rejected = _elements(pages, body_col).withColumn("reason", _reason()).filter("reason IS NOT NULL")
    extra = [c for c in pages.columns if c != body_col]
    return rejected.select(*extra, *_rejected_columns(body_col, secret))


def split_pages(pages: DataFrame, body_col: str = "body", secret: str | bytes | None = None) -> DataFrame:
    """Every element in one parse, good or not: the columns of ``flatten_pages``, its
    ``reason`` (NULL: good), ``position`` and the other columns of ``pages`` (``_page``).
    Stored, it serves ``good_rows`` and ``rejected_rows`` without parsing again. A rejected
    element's payload is what ``quarantine_pages`` keeps of it."""
    extra = [c for c in pages.columns if c != body_col]
    judged = _elements(pages, body_col).withColumn("reason", _reason())
    *columns, _ = _row_columns(secret)
    *_, kept = _rejected_columns(body_col, secret)  # of a good element: its payload
    page = F.struct(*extra) if extra else F.lit(None).cast("struct<_none:int>")
    return judged.select(
        page.alias("_page"), "reason", F.col("_el.pos").alias("position"), *columns, kept.alias("raw_payload")
    )


def good_rows(split: DataFrame) -> DataFrame:
    return split.filter(F.col("reason").isNull()).drop("_page", "reason", "position")


def rejected_rows(split: DataFrame) -> DataFrame:
    page = [F.col("_page")[f].alias(f) for f in split.schema["_page"].dataType.names if f != "_none"]
    return split.filter(F.col("reason").isNotNull()).select(
        *page, "transaction_id", "position", "reason", F.col("raw_payload").alias("raw_text")
    )
