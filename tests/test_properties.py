"""Property tests (Hypothesis) for the quartile scoring used by RFM."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplens.operators import ranking as R


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=10_000), min_size=8, max_size=60, unique=True))
def test_qcut_score_matches_pandas_qcut(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    edges = R.exact_quantiles(df, "x", [0.25, 0.5, 0.75], ["a", "b", "c"])
    got = {r.x: r.s for r in df.crossJoin(edges).select(
        "x", R.qcut_score(F.col("x"), [F.col("a"), F.col("b"), F.col("c")]).alias("s")).collect()}
    exp = pd.qcut(pd.Series(values, dtype=float), 4, labels=[1, 2, 3, 4]).astype(int)
    assert [got[float(v)] for v in values] == exp.tolist()
