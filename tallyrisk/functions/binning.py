"""Interval binning with explicit edge rules.

``cut(x, edges, labels)`` maps ``x`` to ``labels[i]`` when it falls in the
i-th interval.  With ``right=True`` the intervals are ``(e[i], e[i+1]]``: the
lowest edge itself and anything outside the edges get NULL.  With
``right=False`` they are ``[e[i], e[i+1])``.  NULL input gives NULL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(x: Column, edges: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        if right:
            cond = x > F.lit(lo)
            if not math.isinf(hi):
                cond = cond & (x <= F.lit(hi))
        else:
            cond = x >= F.lit(lo)
            if not math.isinf(hi):
                cond = cond & (x < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))
