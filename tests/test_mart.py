from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderflow.plans.mart import (
    FEATURES,
    LABEL,
    assert_no_leakage,
    build_layers,
    inference_mart,
    mart_order_features,
    order_features,
    order_sellers,
    seller_record,
)
from orderflow.sources.roles import Roles, load_roles


def day(n):
    return datetime(2024, 1, n)


def roles(spark):
    orders = spark.createDataFrame(
        [
            (1, 1, "a", day(1), day(5), day(4)),   # late, known on day 5
            (2, 1, "a", day(2), day(3), day(9)),   # in time, known on day 3
            (3, 1, "a", day(5), None, day(9)),     # bought the moment order 1 arrives
            (4, 2, "b", day(6), day(7), day(9)),
            (5, 9, "b", day(8), day(9), day(8)),   # no items, unknown customer
        ],
        "order_id long, customer_id long, order_priority string, purchase_ts timestamp, "
        "delivered_at timestamp, estimated_at timestamp",
    )
    items = spark.createDataFrame(
        [(1, 10, 100, 250), (1, 10, 100, 750), (1, 11, 101, 100), (2, 10, 100, 100),
         (3, 10, 100, 100), (4, 10, 101, 100), (4, 10, 999, 300)],
        "order_id long, seller_id long, product_id long, price long",
    ).withColumns({c: F.lit(100).cast("long") for c in ("quantity", "discount", "tax")})
    return Roles(
        orders=orders,
        items=items,
        products=spark.createDataFrame(
            [(100, "x", 5, 1000), (101, "x", 7, 3000)],
            "product_id long, brand string, size int, retail_price long",
        ),
        sellers=spark.createDataFrame([(10, 1), (11, 2)], "seller_id long, seller_nation int"),
        customers=spark.createDataFrame(
            [(1, 1, "s", 100), (2, 2, "t", 200)],
            "customer_id long, customer_nation int, customer_segment string, customer_acctbal long",
        ),
    )


@pytest.fixture(scope="module")
def features(spark):
    return {r["order_id"]: r for r in order_features(roles(spark)).collect()}


def test_one_row_per_order_with_22_features(features):
    assert set(features) == {1, 2, 3, 4, 5}
    assert len(FEATURES) == 22 and set(FEATURES) < set(features[1].asDict())


def test_amounts_do_not_fan_out(features):
    one = features[1]
    assert (one["n_items"], one["n_products"], one["n_sellers"], one["n_brands"]) == (3, 2, 2, 1)
    assert (one["sum_price"], one["max_price"]) == (11.0, 7.5)
    assert one["avg_retail_price"] == pytest.approx((10 + 10 + 30) / 3)
    assert one["same_nation_share"] == pytest.approx(2 / 3) and one["max_size"] == 7


def test_history_uses_outcomes_strictly_before_the_purchase(features):
    assert features[2]["seller_late_rate_before"] is None
    assert features[3]["seller_late_rate_before"] == 0.0  # order 1 arrives at that very time
    assert features[4]["seller_late_rate_before"] == 0.5


def test_unknown_parties_and_missing_items(features):
    four, five = features[4], features[5]
    assert four["n_products"] == 2 and four["avg_retail_price"] == 30.0
    assert five["n_items"] == 0 and five["sum_price"] == 0.0 and five["avg_price"] is None
    assert five["customer_segment"] is None and five[LABEL] == 1


def test_label_is_open_while_not_delivered(spark, features):
    assert features[3][LABEL] is None
    everything = order_features(roles(spark))
    assert mart_order_features(everything).count() == 4
    assert LABEL not in inference_mart(everything).columns
    assert inference_mart(everything).count() == 5


def test_forbidden_columns_are_refused(spark):
    df = spark.range(1)
    assert assert_no_leakage(df) is df
    for name in ("delivery_days", "review_score", "order_status", "mart_seller_avg"):
        with pytest.raises(ValueError):
            assert_no_leakage(df.withColumn(name, F.lit(1)))


def test_written_layers_hold_the_same_rows(spark, tmp_path):
    lazy = order_features(roles(spark))
    written = build_layers(roles(spark), str(tmp_path)).select(*lazy.columns)
    assert sorted(map(str, lazy.collect())) == sorted(map(str, written.collect()))


def test_hot_seller_history_equals_self_join(spark, sf_dir):
    """All items moved to one seller: the history is still exact."""
    given = load_roles(spark, sf_dir)
    pairs = order_sellers(
        given.items.withColumn("seller_id", F.lit(1).cast("long")), given.orders
    )
    got = {
        r["ts"]: (r["n_before"], r["late_before"]) for r in seller_record(pairs).collect()
    }
    rows = pairs.select("purchase_ts", "delivered_at", "_late").toPandas()
    outcomes = rows.dropna(subset=["delivered_at"])
    for ts in rows["purchase_ts"].drop_duplicates().sample(40, random_state=1):
        known = outcomes[outcomes["delivered_at"] < ts]
        assert got[ts.to_pydatetime()] == (len(known), int(known["_late"].sum()))


def test_unused_branches_are_pruned(spark, sf_dir):
    df = order_features(load_roles(spark, sf_dir)).select("order_id", "purchase_month")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "part.parquet" not in plan
