from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from orderflow.operators.drift import monitor_days, psi, psi_by
from orderflow.operators.feedback import read_performance, refresh_performance
from orderflow.operators.registry import ALIAS_SCHEMA, alias_as_of

D0 = date(2024, 1, 1)


def samples(spark):
    base = spark.range(3000).select((F.rand(1) * 10).alias("x"), F.when(F.rand(2) < 0.8, F.rand(3)).alias("y"), F.element_at(F.array(F.lit("a"), F.lit("b")), (F.col("id") % 2 + 1).cast("int")).alias("kind"))
    cur = spark.range(900).select(
        F.date_add(F.lit(D0), (F.col("id") % 6).cast("int")).alias("day"),
        (F.rand(4) * 10 + F.col("id") % 6).alias("x"),
        F.when(F.rand(5) < 0.5, F.rand(6)).alias("y"),
        F.when(F.col("id") % 6 < 4, "a").when(F.col("id") % 6 == 4, "new").alias("kind"),
    )
    return base.cache(), cur.cache()


def test_psi_of_each_day_equals_psi_of_the_day_alone(spark):
    base, cur = samples(spark)
    edges = {"x": [2.0, 4.0, 6.0, 8.0], "y": [0.25, 0.5], "never": []}
    base, cur = (df.withColumn("never", F.lit(None).cast("double")) for df in (base, cur))
    got = {(r.day, r.feature): (r.n_base, r.n_cur, round(r.psi, 9)) for r in psi_by(base, cur, edges, ["day"]).collect()}
    want = {}
    for n in range(6):
        day = D0 + timedelta(days=n)
        for r in psi(base, cur.where(F.col("day") == F.lit(day)), edges).collect():
            want[day, r.feature] = (r.n_base, r.n_cur, round(r.psi, 9))
    assert got == want


def test_categories_and_daily_verdicts_are_replaced(spark, tmp_path):
    base, cur = samples(spark)
    limits = spark.createDataFrame([("psi", 0.1, 0.25)], "check string, warn double, error double")
    out, days = str(tmp_path / "drift"), [D0 + timedelta(days=n) for n in range(6)]
    args = (base, cur, {"x": [5.0]}, limits, out, days, "day", "day", ["kind"])
    assert monitor_days(*args) == []
    first = {(r.day, r.subject): (r.severity, r.n_cur) for r in spark.read.parquet(out).collect()}
    assert len(first) == 12 and {v[1] for v in first.values()} == {150}
    assert first[D0, "x"][0] == "OK" and first[D0 + timedelta(days=5), "x"][0] == "ERROR"
    assert all(first[d, "kind"][0] == "ERROR" for d in days)  # one kind, then a new one, then none
    gone = cur.where(F.col("day") != F.lit(D0))
    assert monitor_days(base, gone, {"x": [5.0]}, limits, out, days, "day", "day", ["kind"]) == [D0]
    assert {(r.day, r.subject) for r in spark.read.parquet(out).collect()} == {k for k in first if k[0] != D0}


def test_only_days_with_news_are_measured_again(spark, tmp_path):
    out = str(tmp_path / "performance")
    predictions = spark.range(60).selectExpr("id as order_id", "cast(1 as long) as model_version", "cast(id % 7 as double) as score", "date_add(date'2024-01-01', cast(id % 6 as int)) as day")
    facts = predictions.selectExpr("order_id", "cast(order_id % 3 = 0 as int) as y", "cast(date_add(day, 1 + cast(order_id % 4 as int)) as timestamp) as known_at")

    def refresh(today, scores=predictions, known=facts):
        return refresh_performance(scores, known, out, "order_id", "y", 2, today, known_at="known_at")

    day = lambda n: D0 + timedelta(days=n)
    assert refresh(day(4)) == [day(0), day(1), day(2)]
    assert refresh(day(4)) == []
    table = {r.day: r.n_rows for r in read_performance(spark, out).collect()}
    assert table == {day(n): facts.where(f"known_at < date'2024-01-06' and order_id % 6 = {n}").count() for n in range(3)}
    assert refresh(day(5)) == [day(1), day(2), day(3)]  # day 0 is settled
    changed = facts.withColumn("y", F.when(F.col("order_id") == 6, 1 - F.col("y")).otherwise(F.col("y")))
    assert refresh(day(5), known=changed) == [day(0)]
    rescored = predictions.withColumn("score", F.when(F.col("day") == F.lit(day(2)), -F.col("score")).otherwise(F.col("score")))
    assert refresh(day(5), rescored, changed) == [day(2)]
    lost = changed.where("order_id % 6 <> 1")
    assert refresh(day(5), rescored, lost) == [day(1)]
    assert sorted(r.day for r in read_performance(spark, out).collect()) == [day(0), day(2), day(3)]


def test_alias_carries_over_empty_buckets_and_ignores_nulls(spark):
    at = datetime(2024, 1, 1, 10)
    history = spark.createDataFrame(
        [("m", "c", 1, at, "set"), ("m", "c", 2, at + timedelta(days=40), "set"), (None, "c", 9, at, "set"), ("n", "c", 5, at, "set")], ALIAS_SCHEMA
    )
    events = [("m", "c", at + timedelta(days=n, minutes=1), n) for n in (-1, 0, 7, 39, 40, 400)] + [("m", "c", None, 50), (None, "c", at, 51), ("x", "c", at, 52), ("n", "c", at, 53)]
    df = spark.createDataFrame(events, "name string, alias string, ts timestamp, version_ int")
    got = {r.version_: r.version for r in alias_as_of(df, history, "ts").collect()}
    assert got == {-1: None, 0: 1, 7: 1, 39: 1, 40: 2, 400: 2, 50: None, 51: None, 52: None, 53: 5}


def test_alias_plan_joins_nothing(spark):
    history = spark.createDataFrame([("m", "c", n, datetime(2024, 1, 1) + timedelta(hours=n), "set") for n in range(500)], ALIAS_SCHEMA)
    events = spark.range(20_000).selectExpr("'m' as name", "'c' as alias", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id * 60) as ts")
    found = alias_as_of(events, history, "ts")
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.groupBy("version").count().agg(F.max("count")).first()[0] <= 60 * 60
    assert found.count() == 20_000
