"""Landing identity, lost runs, the day index and declared schemas."""

import json

import pytest
from pyspark.sql import functions as F

from txnlake.plans import catalog, jobs
from txnlake.plans.jobs import LakePaths
from txnlake.sources import day_index, landings, lifecycle, pages, schemas, sinks
from txnlake.streaming.landing import start_landing

from .test_jobs import SF, _delivery


def rows_of(df):
    return sorted(((r.transaction_id, r.amount, str(r.initiated_at)[:10]) for r in df.collect()), key=str)


def test_two_streams_keep_each_others_rows(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    pg = catalog.api_pages(spark, SF)
    pg.select(pages_part(0)).filter("body is not null").write.text(str(tmp_path / "a"))
    pg.select(pages_part(1)).filter("body is not null").write.text(str(tmp_path / "b"))
    for name in "ab":  # both begin at epoch 0
        start_landing(spark, str(tmp_path / name), paths, str(tmp_path / f"ck-{name}"), tokenize=False).awaitTermination()
    good = pages.flatten_pages(pg)
    assert rows_of(jobs.read_bronze(spark, paths)) == rows_of(good)
    # a fresh checkpoint lands the files again under its own name: nothing is lost
    start_landing(spark, str(tmp_path / "a"), paths, str(tmp_path / "ck-new"), tokenize=False).awaitTermination()
    assert {r[0] for r in rows_of(jobs.read_silver(spark, paths))} == {r[0] for r in rows_of(good)}
    assert jobs.read_silver(spark, paths).count() == good.select("transaction_id").distinct().count()


def _good(spark, rows, batch):
    return _delivery(spark, rows, batch).withColumn("status", F.lit("SUCCESS"))


def pages_part(k):
    elements = F.from_json("body", "transactions array<string>").getField("transactions")
    mine = F.filter(elements, lambda _, i: i % 2 == k)
    return F.concat(F.lit('{"transactions":['), F.array_join(mine, ","), F.lit("]}")).alias("body")


def test_one_batch_id_twice_in_a_day(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    first = _delivery(spark, [("A", 1.0, "2024-01-15 10:00:00"), ("N1", 2.0, None)], "1")
    second = _delivery(spark, [("B", 3.0, "2024-01-16 10:00:00"), ("N2", 4.0, None), (None, 5.0, None)], "1")
    jobs.ingest_daily(spark, paths, first, "2024-01-15", days_back=0)
    jobs.ingest_daily(spark, paths, second, "2024-01-16", days_back=0)
    want = rows_of(first.unionByName(second))
    assert rows_of(jobs.read_bronze(spark, paths)) == want
    for _ in range(2):  # once more, and other rows under the same name and range
        jobs.ingest_daily(spark, paths, second, "2024-01-16", days_back=0)
    assert rows_of(jobs.read_bronze(spark, paths)) == want
    third = _delivery(spark, [("C", 6.0, "2024-01-16 11:00:00")], "1")
    jobs.ingest_daily(spark, paths, third, "2024-01-16", days_back=0)
    assert rows_of(jobs.read_bronze(spark, paths)) == rows_of(first.unionByName(second).unionByName(third))


def test_landing_again_leaves_the_old_day(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    jobs.ingest_bronze(_delivery(spark, [("C", 1.0, "2024-01-15 10:00:00"), ("D", 9.0, "2024-01-14 10:00:00")], "1"), paths)
    jobs.normalize_job(spark, paths)
    jobs.ingest_bronze(_delivery(spark, [("C", 1.0, "2024-01-16 10:00:00")], "1"), paths)
    assert rows_of(jobs.read_bronze(spark, paths)) == [("C", 1.0, "2024-01-16"), ("D", 9.0, "2024-01-14")]
    # the old attempt's folders are gone, and no marker is left
    assert landings.hidden(spark, paths.landings + "/bronze") == []
    assert not sinks.exists(spark, paths.bronze + "/_event_date=2024-01-15")or not any(
        "~0" in f for f in sinks.partition_folders(spark, paths.bronze + "/_event_date=2024-01-15", "_batch_part", lambda v: True)
    )
    jobs.normalize_job(spark, paths, "2024-01-16", "2024-01-17")
    assert rows_of(jobs.read_silver(spark, paths)) == [("C", 1.0, "2024-01-16"), ("D", 9.0, "2024-01-14")]


@pytest.mark.parametrize("lost_at", ["before_write", "after_write"])
def test_lost_runs_show_nothing_and_are_repeated(spark, tmp_path, monkeypatch, lost_at):
    paths = LakePaths(str(tmp_path / "lake"))
    jobs.ingest_bronze(_delivery(spark, [("A", 1.0, "2024-01-15 10:00:00")], "1"), paths)
    new = _delivery(spark, [("A", 2.0, "2024-01-16 10:00:00"), ("B", 3.0, None)], "1")
    write = sinks.overwrite_partitions

    def lost(df, path, *args, **more):
        if path != paths.bronze:
            return write(df, path, *args, **more)
        if lost_at == "after_write":
            write(df, path, *args, **more)
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "overwrite_partitions", lost)
        for _ in range(2):
            with pytest.raises(RuntimeError):
                jobs.ingest_bronze(new, paths)
    assert rows_of(jobs.read_bronze(spark, paths)) == [("A", 1.0, "2024-01-15")]
    jobs.ingest_bronze(new, paths)
    want = [("A", 2.0, "2024-01-16"), ("B", 3.0, "None")]
    assert rows_of(jobs.read_bronze(spark, paths)) == want
    assert rows_of(spark.read.parquet(paths.bronze)) == want  # lost attempts are deleted
    jobs.normalize_job(spark, paths, "2024-01-16", "2024-01-17")
    assert rows_of(jobs.read_silver(spark, paths)) == want


def test_index_reads_only_the_buckets_of_the_ids(spark, tmp_path, capsys):
    index = str(tmp_path / "index")
    rows = catalog.bronze(spark, SF).withColumn("_event_date", F.to_date("initiated_at"))
    day_index.note_landing(rows, index, "first")
    buckets = [3, 5]
    df = day_index.known(spark, index, buckets)
    want = day_index.entries(rows).filter(F.col("_bucket").isin(*buckets))
    assert sorted(map(str, df.collect())) == sorted(map(str, want.select(*df.columns).collect()))
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [_bucket" in plan and "IN (3,5)" in plan
    day_index.note_landing(rows, index, "first")  # again: nothing new
    assert spark.read.parquet(index + "/days").count() == day_index.entries(rows).count()


def test_days_to_write():
    pairs = [("2024-01-01", "2024-01-05"), ("2024-01-05", "2024-01-09"), ("2024-01-02", None)]
    assert day_index.days_to_write(pairs, ["2024-01-09"]) == {"2024-01-01", "2024-01-05", "2024-01-09"}
    assert day_index.days_to_write(pairs, ["2024-01-03"]) == {"2024-01-03"}
    assert day_index.days_to_write(pairs, [None]) == {None, "2024-01-02"}
    assert day_index.days_to_write([(None, None)], ["2024-01-03"]) == {"2024-01-03", None}


def test_settled_days_are_read_but_not_written(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    jobs.ingest_bronze(_delivery(spark, [("A", 1.0, "2024-01-15 10:00:00"), ("X", 7.0, "2024-01-15 11:00:00")], "1"), paths)
    jobs.ingest_bronze(_delivery(spark, [("A", 2.0, "2024-01-16 10:00:00")], "2"), paths)
    assert set(map(str, jobs.affected_days(spark, paths, [day("2024-01-16")]))) == {"2024-01-15", "2024-01-16"}
    jobs.normalize_job(spark, paths)
    assert day_index.unsettled(spark, paths.index) == {}
    # day 15 again, for another reason: A's later row on day 16 still wins
    assert jobs.affected_days(spark, paths, [day("2024-01-15")]) == [day("2024-01-15")]
    jobs.normalize_job(spark, paths, "2024-01-15", "2024-01-16")
    assert rows_of(jobs.read_silver(spark, paths)) == [("A", 2.0, "2024-01-16"), ("X", 7.0, "2024-01-15")]


def day(text):
    from datetime import date

    return date.fromisoformat(text)


def test_schemas_grow_and_refuse(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(spark.createDataFrame([(1, "a")], "x int, p string"), path, "p")
    sinks.append(spark.createDataFrame([(2, 0.5, "1")], "x int, extra double, p string"), path, "p")
    df = sinks.read_table(spark, path)
    assert df.schema.simpleString() == "struct<x:int,extra:double,p:string>"
    assert sorted(map(tuple, df.collect())) == [(1, None, "a"), (2, 0.5, "1")]  # a text partition stays text
    assert json.loads(sinks.read_text(spark, path + "/_schema.json"))["type"] == "struct"
    with pytest.raises(schemas.SchemaMismatch, match="x: bigint instead of int"):
        sinks.append(spark.createDataFrame([(3, "a")], "x long, p string"), path, "p")
    bronze = catalog.bronze(spark, SF)
    assert schemas.require(bronze, "bronze") is bronze
    with pytest.raises(schemas.SchemaMismatch, match="fee: absent"):
        schemas.require(bronze.drop("fee"), "bronze")
    with pytest.raises(schemas.SchemaMismatch, match="amount: string"):
        jobs.ingest_bronze(bronze.withColumn("amount", F.col("amount").cast("string")), LakePaths(path + "-lake"))


def test_phones_are_tokenised_unless_turned_off(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    body = catalog.api_pages(spark, SF).limit(1)
    with pytest.raises(ValueError, match="secret"):
        jobs.ingest_pages(body, paths, "2024-01-31", "b")
    with pytest.raises(ValueError, match="secret"):
        start_landing(spark, str(tmp_path), paths, str(tmp_path / "ck"))
    jobs.ingest_pages(body, paths, "2024-01-31", "b", secret="s")
    assert all(len(r.sender_phone) == 16 for r in jobs.read_bronze(spark, paths).collect())


def test_incremental_keeps_late_rows_and_reads_touched_days(spark, tmp_path, capsys):
    paths = LakePaths(str(tmp_path / "lake"))
    first = _delivery(spark, [("A", 1.0, "2024-01-15 10:00:00"), ("B", 2.0, "2024-01-20 10:00:00")], "1")
    assert jobs.ingest_incremental(spark, paths, first, "i1")["rows_written"] == 2
    fetch = _delivery(spark, [
        ("A", 1.0, "2024-01-15 10:00:00"),  # landed
        ("L", 3.0, "2024-01-15 09:00:00"),  # late: before the high-water mark
        ("N", 4.0, None), (None, 5.0, "2024-01-21 10:00:00"),
        ("A", 9.0, "2024-01-15 10:00:00"),  # a correction
    ], "2")
    assert jobs.ingest_incremental(spark, paths, fetch, "i2")["rows_written"] == 4
    assert jobs.ingest_incremental(spark, paths, fetch, "i3")["rows_written"] == 0
    assert jobs.read_bronze(spark, paths).count() == 6
    assert str(jobs.high_water_mark(spark, paths)) == "2024-01-21 10:00:00"
    jobs.bronze_days(spark, paths, [day("2024-01-15"), None]).explain("formatted")
    plan = capsys.readouterr().out
    filters = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert any("_event_date" in line and "2024-01-15" in line for line in filters)


def test_incremental_broadcasts_no_stored_rows_and_compares_once(spark, tmp_path, monkeypatch, capsys):
    paths = LakePaths(str(tmp_path / "lake"))
    rows = _delivery(spark, [("A", 1.0, "2024-01-15 10:00:00"), ("B", 2.0, None)], "1")
    limits = {f"spark.sql.{x}autoBroadcastJoinThreshold": "1g" for x in ("", "adaptive.")}
    old = {k: spark.conf.get(k) for k in limits}
    given = []

    def seen(new, *args):
        given.append(new)
        return {"rows_written": 0}

    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        jobs.ingest_bronze(rows, paths)
        lifecycle.not_yet_landed(rows, jobs.bronze_days(spark, paths, None)).explain("formatted")
        lifecycle.incremental(rows, rows).explain("formatted")
        plans = capsys.readouterr().out
        monkeypatch.setattr(jobs, "ingest_bronze", seen)
        jobs.ingest_incremental(spark, paths, rows, "i1")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plans and "BroadcastHashJoin" not in plans
    given[0].explain("formatted")
    assert "Join" not in capsys.readouterr().out  # the rows come from the stored comparison
    assert not sinks.exists(spark, paths.staged("i1"))


@pytest.mark.parametrize("secret", [None, "s"])
def test_pages_are_parsed_once_for_good_and_rejected_rows(spark, tmp_path, monkeypatch, secret):
    pg = catalog.api_pages(spark, SF).unionByName(spark.createDataFrame(
        [(-1, "no json"), (-2, "{}"), (-3, '{"transactions":[7,{"id":"X"}]}')], "page long, body string"
    )).persist()
    parse, calls = pages._elements, []
    monkeypatch.setattr(pages, "_elements", lambda *a: calls.append(a) or parse(*a))
    split = pages.split_pages(pg, secret=secret)
    for got, want in ((pages.good_rows(split), pages.flatten_pages(pg, secret=secret)),
                      (pages.rejected_rows(split), pages.quarantine_pages(pg, secret=secret))):
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    calls.clear()
    paths = LakePaths(str(tmp_path / "lake"))
    jobs.ingest_pages(pg.limit(1).select("body"), paths, "2024-01-31", "b", secret, tokenize=bool(secret))
    assert len(calls) == 1 and not sinks.exists(spark, paths.staged("b"))
    pg.unpersist()


def test_retention_deletes_from_every_layer(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    jobs.ingest_bronze(_good(spark, [
        ("A", 1000.0, "2024-01-15 10:00:00"), ("B", 2000.0, "2024-01-20 10:00:00"), ("N", 3.0, None)
    ], "1"), paths)
    jobs.normalize_job(spark, paths)
    jobs.aggregate_job(spark, paths, "2024-01-31", 30)
    with pytest.raises(ValueError):
        jobs.apply_retention(spark, paths, "2024-03-01", 29)
    gone = jobs.apply_retention(spark, paths, "2024-02-17", 30)  # keeps from 2024-01-18 on
    assert {k: v for k, v in gone.items() if k in ("bronze", "silver")} == {
        "bronze": ["2024-01-15"], "silver": ["2024-01-15"]
    }
    record = sinks.read_text(spark, paths.root + "/retention/2024-02-17.json")
    assert json.loads(record) == gone and gone["daily_summary"] == ["2024-01-15"]
    assert jobs.apply_retention(spark, paths, "2024-02-17", 30) == {}
    assert sinks.read_text(spark, paths.root + "/retention/2024-02-17.json") == record
    assert rows_of(jobs.read_bronze(spark, paths)) == [("B", 2000.0, "2024-01-20"), ("N", 3.0, "None")]
    assert rows_of(jobs.read_silver(spark, paths)) == [("B", 2000.0, "2024-01-20"), ("N", 3.0, "None")]
    left = spark.read.parquet(paths.index + "/days").collect()
    assert {r.transaction_id for r in left} == {"B", "N"}


def test_checks_in_a_date_range_and_again(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    bad = _good(spark, [("A", -1.0, "2024-01-15 10:00:00"), ("B", 2.0, "2024-01-16 10:00:00"),
                            ("B", 60_000_000.0, "2024-01-16 11:00:00")], "1")
    jobs.ingest_bronze(bad, paths)
    jobs.normalize_job(spark, paths)
    jobs.aggregate_job(spark, paths, "2024-01-31", 30)
    got = jobs.check_job(spark, paths, "run")
    assert got["bronze_amount_range"] == 2 and got["bronze_transaction_id_unique"] == 1
    assert got["silver_transaction_id_unique"] == 0 and got["daily_count_at_least_one"] == 0
    assert jobs.check_job(spark, paths, "later", "2024-01-16", "2024-01-16")["bronze_amount_range"] == 1
    # the same run again, after the bad row was corrected: nothing of it is left
    jobs.ingest_bronze(bad.filter("transaction_id = 'A'").withColumn("amount", F.lit(5.0)), paths)
    assert jobs.check_job(spark, paths, "run")["bronze_amount_range"] == 1
    stored = spark.read.parquet(paths.root + "/checks").filter("_check = 'bronze_amount_range'")
    assert sorted((r._run_id, json.loads(r.row)["transaction_id"]) for r in stored.collect()) == [
        ("later", "B"), ("run", "B")
    ]
