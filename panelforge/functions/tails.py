"""Upper-tail probabilities as native column expressions: normal, Student t, chi-square, F.

Regularised incomplete beta and gamma by their continued fractions (modified Lentz) and the gamma series, as
``aggregate`` over a fixed number of steps that grows with the square root of the arguments, so that they converge
at any degrees of freedom.  Log-gamma by Stirling's series behind a shift of ten.  Null and NaN give null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 1e-300
_SHIFT = 10
#: Coefficients of Stirling's series for log-gamma, of z^-1, z^-3, ...
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
_MOST_STEPS = 200_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def log_gamma(x) -> Column:
    """ln Gamma(x) for x > 0."""
    x = _c(x)
    z = x + F.lit(float(_SHIFT))
    low = F.lit(0.0)
    for k in range(_SHIFT):
        low = low + F.log(x + F.lit(float(k)))
    series = F.lit(0.0)
    for c in reversed(_STIRLING):
        series = series / (z * z) + F.lit(c)
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series / z - low


def _steps(size: Column) -> Column:
    return F.sequence(F.lit(1), F.least(F.lit(_MOST_STEPS), F.lit(80) + F.ceil(F.lit(8.0) * F.sqrt(size)).cast("int")))


def _away(x: Column) -> Column:
    """``x``, kept off zero (Lentz)."""
    return F.when(F.abs(x) > _TINY, x).otherwise(F.lit(_TINY))


def _state(c, d, h) -> Column:
    return F.struct(c.alias("c"), d.alias("d"), h.alias("h"))


def _one_step(s: Column, num: Column, den) -> Column:
    d = F.lit(1.0) / _away(den + num * s["d"])
    c = _away(den + num / s["c"])
    return _state(c, d, s["h"] * c * d)


def beta_reg(a, b, x) -> Column:
    """I_x(a, b), 0 to 1."""
    a, b, x = _c(a), _c(b), _c(x)
    swap = x >= (a + 1.0) / (a + b + 2.0)
    p, q, y = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b), F.when(swap, 1.0 - x).otherwise(x)
    front = F.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * F.log(y) + q * F.log1p(-y)) / p

    def step(s, k):
        m = k.cast("double")
        even = _one_step(s, m * (q - m) * y / ((p + 2.0 * m - 1.0) * (p + 2.0 * m)), F.lit(1.0))
        odd = -(p + m) * (p + q + m) * y / ((p + 2.0 * m) * (p + 2.0 * m + 1.0))
        # a struct of the first half step is held by a one-element transform, so that it is worked out once
        return F.transform(F.array(even), lambda t: _one_step(t, odd, F.lit(1.0)))[0]

    d = F.lit(1.0) / _away(1.0 - (p + q) * y / (p + 1.0))
    cf = F.aggregate(_steps(F.greatest(p, q)), _state(F.lit(1.0), d, d), step, lambda s: s["h"])
    inner = front * cf
    out = F.when(swap, 1.0 - inner).otherwise(inner)
    out = F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).otherwise(out)
    return F.when(F.isnan(x) | x.isNull() | a.isNull() | b.isNull(), F.lit(None).cast("double")).otherwise(out)


def gamma_upper(a, x) -> Column:
    """Q(a, x) = Gamma(a, x) / Gamma(a), 0 to 1."""
    a, x = _c(a), _c(x)
    front = F.exp(a * F.log(x) - x - log_gamma(a))

    def term(s, k):
        t = s["t"] * x / (a + k.cast("double"))
        return F.struct(t.alias("t"), (s["sum"] + t).alias("sum"))

    first = F.lit(1.0) / a
    series = F.aggregate(_steps(F.greatest(a, x)), F.struct(first.alias("t"), first.alias("sum")), term, lambda s: s["sum"])

    def step(s, k):
        m = k.cast("double")
        return _one_step(s, -m * (m - a), x + 1.0 - a + 2.0 * m)

    d = F.lit(1.0) / (x + 1.0 - a)
    cf = F.aggregate(_steps(F.greatest(a, x)), _state(F.lit(1 / _TINY), d, d), step, lambda s: s["h"])
    out = F.when(x <= 0, F.lit(1.0)).when(x < a + 1.0, 1.0 - front * series).otherwise(front * cf)
    return F.when(F.isnan(x) | x.isNull() | a.isNull(), F.lit(None).cast("double")).otherwise(out)


def normal_two_sided(z) -> Column:
    z = _c(z)
    return gamma_upper(F.lit(0.5), z * z / 2.0)


def t_two_sided(t, df) -> Column:
    """P(|T| > |t|); null without degrees of freedom."""
    t, df = _c(t), _c(df)
    return F.when(df > 0, beta_reg(df / 2.0, F.lit(0.5), df / (df + t * t)))


def chi2_upper(x, k) -> Column:
    return gamma_upper(_c(k) / 2.0, _c(x) / 2.0)


def f_upper(f, d1, d2) -> Column:
    f, d1, d2 = _c(f), _c(d1), _c(d2)
    return beta_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))
