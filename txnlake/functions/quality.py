"""Row-quality rules as named Column predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (rule names, limits and accepted codes of the source system).
AMOUNT_CAP = 50_000_000
HOME_CURRENCY = "XOF"
VALID_STATUSES = ("SUCCESS", "PENDING", "FAILED", "REVERSED")
TRANSACTION_TYPES = ("PAYMENT", "TRANSFER", "WITHDRAWAL", "DEPOSIT", "REFUND")
CHANNELS = ("USSD", "APP", "WEB", "AGENT")
AMOUNT_BUCKETS = ("MICRO", "SMALL", "MEDIUM", "LARGE", "XLARGE")
QUALITY_FLAGS = ("PASS", "FAIL")


RULE_SQL = {
    "amount_positive": "amount > 0",
    "amount_reasonable": f"amount < {AMOUNT_CAP}",
    "currency_xof": f"currency = '{HOME_CURRENCY}'",
    "valid_status": "status IN (" + ", ".join(f"'{v}'" for v in VALID_STATUSES) + ")",
    "has_sender": "sender_phone IS NOT NULL",
    "has_initiated_at": "initiated_at IS NOT NULL",
    "fee_non_negative": "fee >= 0",
}


def rules() -> dict[str, Column]:
    """The seven named row rules, in their fixed order."""
    return {name: F.expr(sql) for name, sql in RULE_SQL.items()}


# Rules that decide PASS/FAIL; the others are advisory only.
CRITICAL = ("amount_positive", "valid_status", "has_initiated_at")


def rule_column(name: str) -> str:
    return f"_quality_{name}"
