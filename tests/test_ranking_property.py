"""Property test: the distributed ranking equals SQL window ranking on random frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridline.operators.ranking import rank_within

rows = st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(-3, 3))),
                min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, method=st.sampled_from(["rank", "dense_rank"]), parts=st.integers(1, 6))
def test_rank_property(spark, data, method, parts):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id INT, g STRING, v INT")
    got = rank_within(df, ["g"], [("v", "desc")], method=method, out="r", partitions=parts)
    fn = F.rank() if method == "rank" else F.dense_rank()
    want = df.withColumn("r", fn.over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    assert sorted(got.select("id", "r").collect()) == sorted(want.select("id", "r").collect())
