"""Numeric cleaning, differences, ratios and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-5


def finite(name: str) -> Column:
    """The column as double; text that is no number, NaN and +/-Inf become null."""
    value = f"try_cast(`{name}` AS double)"
    # A finite number minus itself is 0; NaN and the infinities give NaN, which is above 0 here.
    return F.expr(f"CASE WHEN {value} - {value} = 0 THEN {value} END")


def difference(left: str, right: str) -> Column:
    return F.col(left) - F.col(right)


def guarded_ratio(numerator: str, denominator: str, policy: str = "null") -> Column:
    """A ratio that never divides by zero.

    ``null``: no value when the denominator is null or not positive.
    ``add_epsilon``: the denominator is shifted by 1e-5.
    ``clamp_epsilon``: a denominator that is not positive is replaced by 1e-5.
    """
    num, den = F.col(numerator), F.col(denominator)
    if policy == "null":
        return F.when(den > 0, num / den)
    if policy == "add_epsilon":
        return F.try_divide(num, den + F.lit(EPSILON))
    if policy == "clamp_epsilon":
        return num / F.when(den > 0, den).when(den <= 0, F.lit(EPSILON))
    raise ValueError(f"Unknown ratio policy: {policy}")


def band(name: str, upper_bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The name of the first band whose upper bound (exclusive) is above the value."""
    value, result = F.col(name), None
    for bound, label in upper_bounds:
        test = value < bound
        result = F.when(test, label) if result is None else result.when(test, label)
    return result.when(value.isNotNull(), otherwise)


def rounded_half_away(name: str, digits: int) -> Column:
    """Round a double without building a decimal per value; -0.0 becomes 0.0.

    Values too large for any decimal place to be exact are left alone.
    """
    scale, value = f"1e{digits}D", f"`{name}`"
    return F.expr(f"CASE WHEN abs({value}) < 1e{18 - digits}D THEN signum({value}) * "
                  f"(floor(abs({value}) * {scale} + 0.5D) / {scale}) + 0D ELSE {value} END")


def hash_key(name: str) -> Column:
    """A spread-out 32-bit number that depends on the id alone (Fibonacci hashing).

    The id is first taken modulo 2^31, so that the product fits 64 bits for any id.
    """
    small = F.pmod(F.col(name).cast("bigint"), F.lit(2147483648))
    return (small * F.lit(2654435761)) % F.lit(4294967296)


def hash_bucket(name: str, buckets: int = 100) -> Column:
    """A bucket that survives repartitioning and re-runs, from the high bits of the hash."""
    return F.floor(hash_key(name) * F.lit(buckets) / F.lit(4294967296.0)).cast("int")
