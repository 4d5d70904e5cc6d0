from pyspark.sql import functions as F

from leksika.operators import retrieval


def test_every_query_is_answered(spark):
    """1,010 queries: those past the 1,000 smallest ids had no result."""
    vectors = spark.range(6).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("embedding"))
    queries = spark.range(100, 1110).select(F.col("id").alias("query_id"), F.array(F.lit(1.0), F.lit(0.0)).alias("query"))
    found = retrieval.nearest_batch(queries, vectors, 2).groupBy("query_id").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).collect()
    assert len(found) == 1010 and all(r.ids == [4, 5] for r in found)
