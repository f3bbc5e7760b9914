from __future__ import annotations

from checks import fixtures as fx


def test_orders_are_not_sent_whole_to_every_task(spark, tmp_path):
    """Only the key of the order table is read for key sets, which looks small; the join
    must still be dealt by key, since that table grows with the input."""
    spark.createDataFrame(
        [(1, 10.0), (2, 20.0), (3, 30.0)], "o_orderkey long, o_totalprice double"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(
        [(1, 1.0, 5.0), (1, 2.0, 7.0), (2, 3.0, 1.0), (4, 9.0, 9.0)],
        "l_orderkey long, l_quantity double, l_extendedprice double",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    new = fx.orders_new(spark, str(tmp_path))
    plan = new.select("mo")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
    assert sorted(tuple(r) for r in new.collect()) == [(1, 10.0, 3.0, 7.0, 2.0), (2, 20.0, 3.0, 1.0, 1.0)]
