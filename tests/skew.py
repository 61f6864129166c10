"""The test tables with hot keys and with NULLs in every column a query looks at."""

from pathlib import Path

from pyspark.sql import functions as F

HOT_ORDER, HOT_CUSTOMER, HOT_PART = 7, 11, 5
KEPT = ("nation", "region", "customer", "part")


def _one_in(n, salt, *columns):
    return F.pmod(F.xxhash64(*columns, F.lit(salt)), F.lit(n)) == 0


def write_skewed(spark, source, target):
    """A third of the lines in one order and one part, a third of the orders with one customer."""
    read = lambda name: spark.read.parquet(f"{source}/{name}.parquet")
    for name in KEPT:
        read(name).write.parquet(f"{target}/{name}.parquet")
    line = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    hidden = {"l_orderkey": 23, "l_partkey": 29, "l_returnflag": 31, "l_linestatus": 37, "l_shipdate": 41}
    lines = read("lineitem").withColumns(
        {
            "l_orderkey": F.when(_one_in(3, 1, *line), HOT_ORDER).otherwise(F.col("l_orderkey")).cast("bigint"),
            "l_partkey": F.when(_one_in(3, 2, *line), HOT_PART).otherwise(F.col("l_partkey")).cast("bigint"),
        }
    )
    lines = lines.withColumns(
        {name: F.when(~_one_in(n, n, *line), F.col(name)) for name, n in hidden.items()}
    )
    order = F.col("o_orderkey")
    orders = read("orders").withColumns(
        {
            "o_custkey": F.when(_one_in(3, 3, order), HOT_CUSTOMER)
            .when(~_one_in(19, 4, order), F.col("o_custkey"))
            .cast("bigint"),
            "o_orderpriority": F.when(~_one_in(17, 5, order), F.col("o_orderpriority")),
        }
    )
    lines.repartition(8).write.parquet(f"{target}/lineitem.parquet")
    orders.repartition(8).write.parquet(f"{target}/orders.parquet")
    return Path(target)
