"""Column expressions shared by the operators."""

from pyspark.sql import functions as F


def safe_ratio(numerator, denominator, otherwise=None):
    """`numerator / denominator`, or `otherwise` where the denominator is 0 or NULL."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(otherwise).cast("double"))


def pearson_from_sums(n, sx, sy, sxy, sxx, syy):
    """Pearson correlation from one-pass sums; 0 when either side has no variance.

    For integer and half-star ratings each sum is exact in a double, so the result
    does not depend on the order in which rows arrive.
    """
    num = n * sxy - sx * sy
    dx = n * sxx - sx * sx
    dy = n * syy - sy * sy
    return F.when((dx > 0) & (dy > 0), num / F.sqrt(dx * dy)).otherwise(F.lit(0.0))


def jaccard_from_counts(common, n_a, n_b):
    """`|A ∩ B| / |A ∪ B|` from the three counts; 0 for two empty sets."""
    return safe_ratio(common.cast("double"), n_a + n_b - common, 0.0)


def clip(value, low, high):
    """Limit a numeric column to `[low, high]`; NULL stays NULL."""
    return F.when(value < low, F.lit(float(low))).when(value > high, F.lit(float(high))).otherwise(value)


def error_bin(error, last=4):
    """Index of the unit-wide bin of an absolute error; `last` is open-ended."""
    return F.least(F.floor(F.abs(error)), F.lit(last)).cast("int")
