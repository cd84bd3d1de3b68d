"""cut() agrees with pandas.cut on random values, including edges and NULLs."""

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyrisk.functions import rules
from tallyrisk.functions.binning import cut

SPECS = [rules.AGE_BINS, rules.INCOME_BINS, rules.TENURE_BINS, rules.ACCOUNT_AGE_BINS,
         rules.INTEREST_BINS, rules.AMOUNT_BINS]


def _values(edges):
    finite = [e for e in edges if not math.isinf(e)]
    edge_vals = st.sampled_from(finite + [-1.0, finite[-1] + 1])
    return st.lists(st.one_of(st.none(), edge_vals,
                              st.floats(min_value=-10, max_value=finite[-1] * 1.2, allow_nan=False)),
                    min_size=1, max_size=40)


@settings(max_examples=5, deadline=None)
@given(data=st.data())
def test_cut_matches_pandas(spark, data):
    for edges, labels in SPECS:
        for right in (True, False):
            vals = data.draw(_values(edges))
            expected = pd.cut(pd.Series(vals, dtype="float64"), bins=edges, labels=labels, right=right)
            df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(vals)], "i int, x double")
            got = [r[1] for r in df.select("i", cut(F.col("x"), edges, labels, right=right)).orderBy("i").collect()]
            want = [None if pd.isna(e) else str(e) for e in expected]
            assert got == want, (edges, right, vals)
