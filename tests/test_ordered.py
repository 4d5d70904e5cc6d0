"""Running values in stretches against one window, with a key that holds half of the rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leksika.operators.ordered import last_known, running_sum


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 7 == 1, F.lit(None)).otherwise(F.col("id") % 5).cast("int")
    value = F.when(F.pmod(F.xxhash64("id"), F.lit(9)) == 0, F.col("id"))  # rare, so that it is carried over whole stretches
    return spark.range(2000).select("id", key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("t"), value.alias("v"))


@pytest.mark.parametrize("size", [1, 7, 100, 1 << 17])
def test_stretches_equal_one_window(rows, size):
    whole = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = rows.select("id", F.last("v", ignorenulls=True).over(whole).alias("last"), F.sum(F.coalesce("v", F.lit(0))).over(whole).alias("sum"))
    last = last_known(rows, "k", "t", "id", value=F.col("v"), name="last", size=size).select("id", "last")
    total = running_sum(rows, "k", "t", "id", value=F.col("v"), name="sum", size=size).select("id", "sum")
    assert sorted(map(repr, last.join(total, "id").collect())) == sorted(map(repr, expected.collect()))


def test_no_rows(rows):
    assert last_known(rows.where("false"), "k", "t", value=F.col("v"), name="last").count() == 0
    assert running_sum(rows.where("false"), "k", "t", value=F.col("v"), name="sum").count() == 0
