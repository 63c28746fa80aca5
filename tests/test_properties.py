"""Property tests: bucketed (salted) frames equal plain per-key frames for
any data, frame lengths and bucket sizes."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from faultline.operators.windows import FrameAgg, trailing_aggregates

rows = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 50_000),
                          st.one_of(st.none(), st.integers(-50, 50))),
                min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows, d1=st.integers(1, 20_000), d2=st.integers(1, 5_000),
       bucket=st.integers(1, 30_000), inc=st.booleans())
def test_salted_equals_plain(spark, data, d1, d2, bucket, inc):
    pdf = pd.DataFrame(data, columns=["k", "t", "v"])
    df = spark.createDataFrame(pdf, "k int, t bigint, v int")
    aggs = [FrameAgg("avg", "v", d1, "a"), FrameAgg("max", "v", d2, "m"),
            FrameAgg("count", "v", d1, "c"), FrameAgg("sum", "v", d2, "s")]

    def run(b):
        out = trailing_aggregates(df, "k", "t", aggs, include_current=inc, bucket_ms=b)
        return sorted((tuple(r) for r in out.select("k", "t", "v", "a", "m", "c", "s").collect()),
                      key=repr)

    assert run(bucket) == run(None)
