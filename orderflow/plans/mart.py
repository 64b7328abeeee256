"""The feature mart: one row per order, features known at purchase.

Three intermediate tables feed it: orders with their delivery and customer,
products per order, and sellers per order.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.dates import date_parts, month_index, month_of
from orderflow.functions.labels import late_label
from orderflow.operators.cumulative import cumulative_counts
from orderflow.operators.lookup import with_lookup
from orderflow.operators.origin import assert_origins
from orderflow.operators.training import FeatureSpec
from orderflow.sources.layers import layer_path, write_layer
from orderflow.sources.roles import Roles
from orderflow.workspace import drop_folder

LABEL = "is_late_delivery"

# The 22 features of the mart.
CALENDAR = ("purchase_month", "purchase_quarter", "purchase_dow", "purchase_day", "month_index")
ORDER = (
    "order_priority", "n_items", "n_products", "n_sellers", "sum_price", "avg_price",
    "max_price", "sum_qty", "avg_discount", "sum_tax",
)
PRODUCT = ("avg_retail_price", "max_size", "n_brands")
PARTIES = ("customer_segment", "customer_acctbal", "same_nation_share", "seller_late_rate_before")
FEATURES = (*CALENDAR, *ORDER, *PRODUCT, *PARTIES)

# Columns that are only known after the purchase, and aggregates of other marts.
FORBIDDEN = ("delivery_*", "delivered_*", "review_*", "order_status", "mart_*")

# Sources that are only known after the purchase, and the feature that may use them,
# because it counts deliveries strictly before it.
FORBIDDEN_ORIGINS = ("lineitem.l_shipdate", "*.delivered_at", "*.review_*", "*.order_status")
DECLARED_ORIGINS = {"seller_late_rate_before": ("lineitem.l_shipdate", "*.delivered_at")}

CATEGORICAL = ("order_priority", "customer_segment")
NULLABLE = (
    "avg_price", "max_price", "avg_discount", "avg_retail_price", "max_size",
    "customer_acctbal", "same_nation_share", "seller_late_rate_before",
)


def feature_spec() -> FeatureSpec:
    return FeatureSpec(
        numeric=tuple(f for f in FEATURES if f not in CATEGORICAL),
        categorical=CATEGORICAL,
        nullable=NULLABLE,
    )


def assert_no_leakage(df: DataFrame, patterns: Sequence[str] = FORBIDDEN) -> DataFrame:
    """Return `df`, or raise when a column name matches a forbidden pattern; runs no job."""
    found = [c for c in df.columns for p in patterns if fnmatch.fnmatch(c, p)]
    if found:
        raise ValueError(f"columns not known at purchase: {sorted(set(found))}")
    return df


def order_products(items: DataFrame) -> DataFrame:
    """One row per (order, product): amounts of its items."""
    return items.groupBy("order_id", "product_id").agg(
        F.count("*").alias("n"),
        F.sum("price").alias("price"),
        F.max("price").alias("max_price"),
        F.sum("quantity").alias("quantity"),
        F.sum("discount").alias("discount"),
        F.sum("tax").alias("tax"),
    )


def item_brands(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order: the number of brands among its products."""
    bought = pairs.select("order_id", "product_id")
    return (
        with_lookup(bought, products.select("product_id", "brand"), "product_id")
        .groupBy("order_id")
        .agg(F.count_distinct("brand").alias("n_brands"))
    )


def item_totals(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order from its products, brands aside.

    At the grain of (order, product) the number of products is a row count,
    so no row is expanded. Brands need a distinct count, which shuffles twice:
    `item_brands` does that without the amounts.
    """
    n = F.col("n")
    return (
        with_lookup(pairs, products.drop("brand"), "product_id")
        .groupBy("order_id")
        .agg(
            F.sum("n").alias("n_items"),
            F.count("*").alias("n_products"),
            F.sum("price").alias("sum_price"),
            F.max("max_price").alias("max_price"),
            F.sum("quantity").alias("sum_qty"),
            F.sum("discount").alias("sum_discount"),
            F.sum("tax").alias("sum_tax"),
            F.sum(n * F.col("retail_price")).alias("sum_retail_price"),
            F.sum(F.when(F.col("retail_price").isNotNull(), n)).alias("n_retail_price"),
            F.max("size").alias("max_size"),
        )
    )


def order_sellers(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per (order, seller) with the number of items and the dates of the order."""
    pairs = items.groupBy("order_id", "seller_id").agg(F.count("*").alias("seller_items"))
    dates = orders.select(
        "order_id", "purchase_ts", "delivered_at", late_label().alias("_late")
    )
    return pairs.join(dates, "order_id")


def seller_record(pairs: DataFrame) -> DataFrame:
    """Per (seller, purchase time): outcomes strictly before it and the late ones among them.

    Outcomes and purchases of a seller are laid on one time axis and summed
    up by `cumulative_counts` with months as buckets, so a seller with very
    many orders is spread over its months. Days would hold little more than a
    row each, and their totals as many rows as the axis. An open outcome has no
    time and is left out there.
    """
    def point(ts: str, n, late):
        return F.struct(
            F.col(ts).alias("ts"), n.cast("long").alias("n"), late.cast("long").alias("late")
        )

    purchase = point("purchase_ts", F.lit(0), F.lit(0))
    outcome = point("delivered_at", F.lit(1), F.col("_late"))
    axis = pairs.select("seller_id", F.inline(F.array(purchase, outcome)))
    return cumulative_counts(axis, "ts", ["n", "late"], ["seller_id"], bucket=month_of(F.to_date("ts")))


Save = Callable[[str, DataFrame], DataFrame]


def _unsaved(name: str, df: DataFrame) -> DataFrame:
    return df


def seller_totals(
    pairs: DataFrame, orders: DataFrame, sellers: DataFrame, history: DataFrame | None = None, save: Save = _unsaved
) -> DataFrame:
    """One row per order from its sellers: nation match and record before the purchase.

    `history` has the pairs the record is taken from, `pairs` among them; by default it is `pairs`.
    """
    record = save(
        "seller_record",
        seller_record(pairs if history is None else history).select(
            F.col("seller_id").alias("_seller"), F.col("ts").alias("_ts"), "n_before", "late_before"
        ),
    )
    nations = orders.select("order_id", "customer_nation")
    same = F.col("seller_nation") == F.col("customer_nation")
    return (
        with_lookup(
            pairs.join(
                record, (F.col("seller_id") == F.col("_seller")) & (F.col("purchase_ts") == F.col("_ts"))
            ),
            sellers,
            "seller_id",
        )
        .join(nations, "order_id")
        .groupBy("order_id")
        .agg(
            F.sum(F.when(same, F.col("seller_items")).otherwise(0)).alias("same_nation_items"),
            F.sum("seller_items").alias("all_items"),
            F.count("*").alias("n_sellers"),
            F.sum("n_before").alias("n_before"),
            F.sum("late_before").alias("late_before"),
        )
    )


def _ratio(numerator: str, denominator: str):
    return F.col(numerator).cast("double") / F.nullif(
        F.col(denominator).cast("double"), F.lit(0.0)
    )


def _amount(hundredths):
    return hundredths / F.lit(100.0)


def order_features(
    roles: Roles, save: Save = _unsaved, record: Roles | None = None
) -> DataFrame:
    """Key, dates, the 22 features and the label of every order; label NULL while not delivered.

    `save` may write an intermediate table and hand back what it read; by
    default everything stays one lazy plan. `record` has the orders and items
    that the sellers' records need where `roles` is only a part of the orders.
    """
    orders = save("int_orders", with_lookup(roles.orders, roles.customers, "customer_id"))
    bought = save("int_order_products", order_products(roles.items))
    pairs = save("int_order_sellers", order_sellers(roles.items, orders))
    history = None if record is None else order_sellers(record.items, record.orders)
    joined = orders
    for name, part in (
        ("item_totals", item_totals(bought, roles.products)),
        ("item_brands", item_brands(bought, roles.products)),
        ("seller_totals", seller_totals(pairs, orders, roles.sellers, history, save)),
    ):
        joined = joined.join(save(name, part), "order_id", "left")
    zero = F.lit(0)
    features = joined.select(
        "order_id",
        F.to_date("purchase_ts").alias("purchase_date"),
        month_of(F.to_date("purchase_ts")).alias("month"),
        *date_parts("purchase_ts", "purchase"),
        month_index("purchase_ts").alias("month_index"),
        "order_priority",
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("n_products", zero).alias("n_products"),
        F.coalesce("n_sellers", zero).alias("n_sellers"),
        _amount(F.coalesce("sum_price", zero)).alias("sum_price"),
        _amount(_ratio("sum_price", "n_items")).alias("avg_price"),
        _amount(F.col("max_price")).alias("max_price"),
        _amount(F.coalesce("sum_qty", zero)).alias("sum_qty"),
        _amount(_ratio("sum_discount", "n_items")).alias("avg_discount"),
        _amount(F.coalesce("sum_tax", zero)).alias("sum_tax"),
        _amount(_ratio("sum_retail_price", "n_retail_price")).alias("avg_retail_price"),
        "max_size",
        F.coalesce("n_brands", zero).alias("n_brands"),
        "customer_segment",
        _amount(F.col("customer_acctbal")).alias("customer_acctbal"),
        _ratio("same_nation_items", "all_items").alias("same_nation_share"),
        _ratio("late_before", "n_before").alias("seller_late_rate_before"),
        late_label().alias(LABEL),
    )
    return assert_origins(assert_no_leakage(features), FEATURES, FORBIDDEN_ORIGINS, DECLARED_ORIGINS)


def build_layers(roles: Roles, root: str) -> DataFrame:
    """Write the intermediate tables and the features of all orders, partitioned by month.

    Deliveries and order-seller pairs are read several times further down;
    written once, they are not recomputed. The parts of the features are
    written in turn, so that the disk holds the shuffles of one of them at a
    time, and dropped at the end. The written parts hide the sources behind
    them, so the origins are followed through the unwritten plan as well.
    Returns the written table.
    """
    order_features(roles)
    spark = roles.orders.sparkSession
    parts: list[str] = []

    def save(name: str, df: DataFrame) -> DataFrame:
        if name.startswith("int_"):
            return write_layer(df, root, "intermediate", name)
        parts.append(layer_path(root, "intermediate", f"part_{name}"))
        return write_layer(df, root, "intermediate", f"part_{name}")

    try:
        return write_layer(order_features(roles, save), root, "marts", "order_features", ["month"])
    finally:
        for path in parts:
            drop_folder(spark, path)


def mart_order_features(features: DataFrame) -> DataFrame:
    """Delivered orders: the rows a model can learn from."""
    return features.where(F.col(LABEL).isNotNull())


def inference_mart(features: DataFrame) -> DataFrame:
    """The same columns without the target, for every order."""
    return features.drop(LABEL)
