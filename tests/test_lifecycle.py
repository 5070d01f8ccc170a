"""Incremental loading, retention and landing audit columns."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txnlake.plans import catalog
from txnlake.sources import lifecycle
from txnlake.operators.silver import in_time_range

SF = "/root/testdata/sf0.001"


def test_incremental_is_idempotent(spark):
    bronze = catalog.bronze(spark, SF)
    landed = in_time_range(bronze, None, "2024-01-21")
    new = lifecycle.incremental(bronze, landed)
    mark = landed.agg(F.max("initiated_at")).first()[0]
    assert new.filter(F.col("initiated_at") <= mark).count() == 0
    # landing the increment and asking again yields nothing new
    after = landed.unionByName(new)
    assert lifecycle.incremental(bronze, after).count() == 0
    # overlap: re-fetching already landed ids adds nothing
    assert lifecycle.incremental(landed, landed).count() == 0


def test_incremental_on_empty_bronze(spark):
    bronze = catalog.bronze(spark, SF)
    empty = bronze.limit(0)
    assert lifecycle.incremental(bronze, empty).count() == bronze.filter("initiated_at IS NOT NULL").count()
    assert lifecycle.high_water_mark(empty).first()[0] is None


def test_retention_split_and_floor(spark):
    silver = catalog.silver(spark, SF)
    keep = lifecycle.retention_keep(silver, "2025-01-14", 365)
    gone = lifecycle.retention_expired(silver, "2025-01-14", 365)
    assert keep.count() + gone.count() == silver.count()
    assert gone.agg(F.max("_date")).first()[0].isoformat() == "2024-01-14"
    with pytest.raises(ValueError):
        lifecycle.retention_keep(silver, "2025-01-14", 29)


def test_land_audit_columns(spark):
    rows = catalog.bronze(spark, SF).drop("_ingested_at", "_source_file", "_batch_id")
    out = lifecycle.land(rows, "2024-02-01 00:00:00", "bronze-20240201-abc")
    r = out.filter("initiated_at IS NOT NULL").orderBy("transaction_id").first()
    assert out.columns[-3:] == ["_ingested_at", "_source_file", "_batch_id"]
    assert r._ingested_at == datetime(2024, 2, 1)
    assert r._source_file == "payments-api/" + r.initiated_at.strftime("%Y%m%d") + ".json"
    assert out.select("_batch_id").distinct().count() == 1
