from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnlake.operators.stats import grouped_median


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50).map(float))),
        min_size=1,
        max_size=60,
    )
)
def test_grouped_median_equals_builtin(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got = {r.k: r.median for r in grouped_median(df, ["k"], "v").collect()}
    want = {
        r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect() if r.m is not None
    }
    assert got == want


def test_grouped_median_hot_group_spread(spark):
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("k"),
        (F.col("id") % 997).cast("double").alias("v"),
    )
    got = {r.k: r.median for r in grouped_median(df, ["k"], "v").collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert got == want


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", None]),
            st.floats(allow_nan=False, width=64)
            | st.sampled_from([0.0, -0.0, 1e-300, 1e300, float("inf"), float("-inf")])
            | st.floats(1000.0, 1000.001),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_grouped_median_of_any_doubles(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got = {r.k: r.median for r in grouped_median(df, ["k"], "v").collect()}
    for k in got:
        values = sorted(v for key, v in rows if key == k)
        lo, hi = values[(len(values) - 1) // 2], values[len(values) // 2]
        want = lo + (hi - lo) * 0.5
        assert got[k] == want or (got[k] != got[k] and want != want)
    assert set(got) == {k for k, _ in rows}


def test_grouped_median_under_other_planning(spark):
    """Neither exchange reuse, nor coalescing, nor the number of partitions matters."""
    df = spark.range(0, 30000).select(
        (F.col("id") % 3).cast("string").alias("_k0"), F.col("id").alias("_n"),
        (F.hash("id") % 5000 / 7).alias("v"),
    )
    want = {r[0]: r.m for r in df.groupBy("_k0").agg(F.median("v").alias("m")).collect()}
    names = ["spark.sql.exchange.reuse", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.enabled"]
    old = {n: spark.conf.get(n) for n in names}
    try:
        for values in (("true", "true", "true"), ("false", "false", "true"), ("false", "false", "false")):
            for name, value in zip(names, values):
                spark.conf.set(name, value)
            got = grouped_median(df.repartition(7), ["_k0"], "v")
            assert {r[0]: r.median for r in got.collect()} == want
            assert "spark_partition_id" not in got._jdf.queryExecution().toString().lower()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
