"""Pipeline tables read from the star-schema Parquet files of a folder.

The files carry no delivery date: an order counts as delivered on the first
ship date after the order date among its items, and is promised within a
fixed number of days.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROMISED_DAYS = 1000


@dataclass(frozen=True)
class Roles:
    """The typed tables the mart is built from; amounts are in hundredths."""

    orders: DataFrame
    items: DataFrame
    products: DataFrame
    sellers: DataFrame
    customers: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hundredths(column: str):
    """Amount in whole hundredths: exact in sums, and a plain long in generated code.

    Sums of decimals leave the 18 digits that fit a long and become objects.
    """
    return F.rint(F.col(column) * 100).cast("long")


def instant(column: str):
    """Zone-less timestamp as an instant of the session zone."""
    return F.col(column).cast("timestamp")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_partkey").alias("product_id"),
        hundredths("l_extendedprice").alias("price"),
        hundredths("l_quantity").alias("quantity"),
        hundredths("l_discount").alias("discount"),
        hundredths("l_tax").alias("tax"),
        instant("l_shipdate").alias("shipped_at"),
    )


def bare_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchase = instant("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("order_priority"),
        purchase.alias("purchase_ts"),
        F.date_add(purchase.cast("date"), PROMISED_DAYS).cast("timestamp").alias("estimated_at"),
    )


def with_delivery(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with `delivered_at`, NULL while not delivered.

    Items are reduced to distinct (order, ship time) before they meet the
    orders, so an order with very many items does not end in one task.
    """
    shipments = items.select(F.col("order_id").alias("_order"), "shipped_at").distinct()
    delivered = (
        shipments.join(
            orders.select("order_id", "purchase_ts"),
            (F.col("_order") == F.col("order_id")) & (F.col("shipped_at") > F.col("purchase_ts")),
        )
        .groupBy(F.col("_order"))
        .agg(F.min("shipped_at").alias("delivered_at"))
    )
    return orders.join(delivered, F.col("order_id") == F.col("_order"), "left").drop("_order")


def load_roles(spark: SparkSession, sf_dir: str) -> Roles:
    items = order_items(spark, sf_dir)
    return Roles(
        orders=with_delivery(bare_orders(spark, sf_dir), items),
        items=items.drop("shipped_at"),
        products=table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_brand").alias("brand"),
            F.col("p_size").alias("size"),
            hundredths("p_retailprice").alias("retail_price"),
        ),
        sellers=table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").alias("seller_nation"),
        ),
        customers=table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("customer_nation"),
            F.col("c_mktsegment").alias("customer_segment"),
            hundredths("c_acctbal").alias("customer_acctbal"),
        ),
    )
