"""Distribution functions as built-in column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stirling's series for the logarithm of the gamma function, coefficients of
# 1/z, 1/z^3, 1/z^5, 1/z^7, and half the logarithm of two pi.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)
_HALF_LOG_2PI = 0.9189385332046727
_SHIFT = 8


def log_gamma(z: Column) -> Column:
    """Natural logarithm of the gamma function for ``z > 0``, to about 12 digits.

    The argument is moved up by eight, where the series converges at once.
    """
    moved = z + _SHIFT
    series = sum(F.lit(c) / F.pow(moved, F.lit(2.0 * i + 1)) for i, c in enumerate(_STIRLING))
    product = z
    for i in range(1, _SHIFT):
        product = product * (z + i)
    return (moved - 0.5) * F.ln(moved) - moved + _HALF_LOG_2PI + series - F.ln(product)


def _not_zero(value: Column) -> Column:
    return F.when(F.abs(value) < 1e-300, F.lit(1e-300)).otherwise(value)


def _beta_fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of the incomplete beta function.

    It converges in a number of terms that grows with the root of the larger parameter,
    so that is how many are taken.
    """
    terms = (F.lit(60) + F.sqrt(F.greatest(a, b)) * 5).cast("int")

    def term(j):
        m = F.floor(j / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(j % 2 == 0, even).otherwise(odd)

    def step(state, t):
        c = _not_zero(1 + t / state["c"])
        d = 1 / _not_zero(1 + t * state["d"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    start = F.struct(F.lit(1e300).alias("c"), F.lit(1.0).alias("d"), F.lit(1.0).alias("h"))
    return F.aggregate(F.transform(F.sequence(F.lit(1), terms * 2), term), start, step)["h"]


def regularized_beta(x: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function I_x(a, b) for positive ``a`` and ``b``.

    NULL where an argument is; ``x`` at or beyond the ends gives 0 or 1.
    """
    x, a, b = (c.cast("double") for c in (x, a, b))
    inside = F.when((x > 0) & (x < 1), x)

    def tail(x, a, b):
        front = a * F.ln(x) + b * F.ln(1 - x) + log_gamma(a + b) - log_gamma(a) - log_gamma(b)
        return F.exp(front) / a * _beta_fraction(x, a, b)

    value = F.when(inside < (a + 1) / (a + b + 2), tail(inside, a, b)).otherwise(
        1 - tail(1 - inside, b, a)
    )
    known = x.isNotNull() & a.isNotNull() & b.isNotNull()
    return F.when(known & (x <= 0), 0.0).when(known & (x >= 1), 1.0).when(known, value)


def correlation_p_value(rho: Column, n: Column) -> Column:
    """Two-sided probability of a correlation this far from 0 among ``n`` unrelated pairs.

    Student's t with ``n - 2`` degrees of freedom. NULL for fewer than three pairs and
    for a correlation that is not defined; 0 for a perfect one.
    """
    freedom = F.when(n > 2, (n - 2).cast("double"))
    beyond = F.when(rho.isNotNull(), F.greatest(1 - rho * rho, F.lit(0.0)))
    return regularized_beta(beyond, freedom / 2, F.lit(0.5))
