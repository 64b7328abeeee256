import pytest
from pyspark.sql import functions as F

from orderflow.plans.mart import build_layers, order_features
from orderflow.sources.layers import replace_partitions, write_layer
from orderflow.sources.roles import load_roles
from orderflow.workspace import _CLEANUP, materialize, run_dir


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))


def counted(spark):
    rows = spark.range(20_000, numPartitions=4).withColumn("k", F.col("id") % 97)
    return rows.groupBy("k").agg(F.count("*").alias("n"))


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    df = counted(spark)
    assert materialize(df, "freed").count() == 97
    assert write_layer(df, str(tmp_path), "marts", "freed").count() == 97
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("k") % 2).cast("int"))
    dated = df.withColumn("day", day)
    days = [r["day"] for r in dated.select("day").distinct().collect()]
    # What the counts above left behind is theirs, and the garbage collector may take it meanwhile.
    between = shuffle_files(spark)
    replace_partitions(dated, str(tmp_path / "days"), days)
    materialize(df, "freed")
    write_layer(df, str(tmp_path), "marts", "again")
    assert shuffle_files(spark) <= between


@pytest.mark.parametrize("said", [None, "false"])
def test_the_session_keeps_its_own_setting(spark, said):
    known = spark.conf.get(_CLEANUP, None)
    try:
        if said is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, said)
        materialize(counted(spark), "freed")
        assert spark.conf.get(_CLEANUP, None) == said
    finally:
        if known is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, known)


def test_layers_leave_neither_parts_nor_shuffles(spark, sf_dir, tmp_path):
    before = shuffle_files(spark)
    written = build_layers(load_roles(spark, sf_dir), str(tmp_path))
    assert shuffle_files(spark) <= before
    assert sorted(p.name for p in (tmp_path / "intermediate").iterdir()) == ["int_order_products", "int_order_sellers", "int_orders"]
    lazy = order_features(load_roles(spark, sf_dir))
    assert written.select(lazy.columns).exceptAll(lazy).count() == 0 and written.count() == lazy.count()


def test_a_column_of_a_written_part_is_still_followed_to_its_source(spark, sf_dir, tmp_path):
    """A forbidden source behind an amount is found though the part that holds it is read back from disk."""
    from dataclasses import replace

    from orderflow.operators.origin import OriginLeak

    roles = load_roles(spark, sf_dir)
    shipped = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("seller_id"), F.col("l_partkey").alias("product_id"),
        F.unix_date(F.col("l_shipdate").cast("date")).cast("long").alias("price"),
        *[F.lit(1).cast("long").alias(c) for c in ("quantity", "discount", "tax")],
    )
    with pytest.raises(OriginLeak):
        build_layers(replace(roles, items=shipped), str(tmp_path))
