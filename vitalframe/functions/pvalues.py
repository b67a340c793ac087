"""Upper-tail probabilities for test statistics.

Spark has no error function or incomplete gamma, so these run as pandas UDFs. They are meant for
test results, which hold one row per test. The worker code sits inside the factory so that it is
shipped with the plan and needs no package on the executors.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TAIL_TYPE = "p_value double, neg_log10_p double"


def _chi2_tail_udf():
    def tail(statistic: pd.Series, dof: pd.Series) -> pd.DataFrame:
        import math

        def log_upper_gamma(a, x):
            """log of the regularised upper incomplete gamma function Q(a, x)."""
            if x <= 0:
                return 0.0
            front = a * math.log(x) - x - math.lgamma(a)
            if x < a + 1:
                term = total = 1.0 / a
                n = a
                while abs(term) > abs(total) * 1e-17:
                    n += 1
                    term *= x / n
                    total += term
                lower = math.exp(front + math.log(total))
                return math.log1p(-lower) if lower < 1 else -math.inf
            tiny = 1e-300
            b = x + 1 - a
            c = 1 / tiny
            d = 1 / b
            h = d
            for i in range(1, 100_000):
                an = -i * (i - a)
                b += 2
                d = an * d + b
                d = tiny if abs(d) < tiny else d
                c = b + an / c
                c = tiny if abs(c) < tiny else c
                d = 1 / d
                h *= d * c
                if abs(d * c - 1) < 1e-16:
                    break
            return front + math.log(h)

        rows = []
        for x, k in zip(statistic, dof):
            if x is None or k is None or math.isnan(x) or math.isnan(k) or k <= 0:
                rows.append((None, None))
                continue
            lg = log_upper_gamma(k / 2, x / 2)
            rows.append((math.exp(lg) if lg > -745 else 0.0, -lg / math.log(10) + 0.0))
        return pd.DataFrame(rows, columns=["p_value", "neg_log10_p"])

    return F.pandas_udf(tail, TAIL_TYPE)


def _normal_tail_udf():
    def tail(z: pd.Series) -> pd.DataFrame:
        import math

        rows = []
        for v in z:
            if v is None or math.isnan(v):
                rows.append((None, None))
                continue
            p = 0.5 * math.erfc(v / math.sqrt(2))
            if v < 30:
                lg = math.log10(p)
            else:
                # Asymptotic series, where erfc is about to underflow.
                w = 1 / (v * v)
                series = 1 - w * (1 - 3 * w * (1 - 5 * w))
                lg = (-v * v / 2 - math.log(v * math.sqrt(2 * math.pi))) / math.log(10)
                lg += math.log10(series)
            rows.append((p, -lg + 0.0))
        return pd.DataFrame(rows, columns=["p_value", "neg_log10_p"])

    return F.pandas_udf(tail, TAIL_TYPE)


def chi2_tail(statistic: Column, dof: Column) -> Column:
    """Struct ``(p_value, neg_log10_p)`` of the chi-square upper tail."""
    return _chi2_tail_udf()(statistic.cast("double"), dof.cast("double"))


def normal_tail(z: Column) -> Column:
    """Struct ``(p_value, neg_log10_p)`` of the standard normal upper tail."""
    return _normal_tail_udf()(z.cast("double"))
