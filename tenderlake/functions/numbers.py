"""Numeric column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(column) -> Column:
    """Lenient cast: text that is no number becomes NULL."""
    return _c(column).try_cast("double")


def number_text(column) -> Column:
    """Text of a number in double form (``12`` -> ``12.0``), other text unchanged."""
    column = _c(column)
    return F.coalesce(column.try_cast("double").cast("string"), column)


def unit_price(total, quantity) -> Column:
    """``total / quantity``; 0 where either is missing or the divisor is 0."""
    return F.coalesce(F.try_divide(_c(total).cast("double"), _c(quantity).cast("double")), F.lit(0.0))


def millions(column) -> Column:
    return _c(column) / F.lit(1_000_000)


def percent_of(part, whole) -> Column:
    """``100 * part / whole``, NULL when the whole is 0."""
    return F.try_divide(_c(part) * F.lit(100.0), _c(whole).cast("double"))


def percent_text(score) -> Column:
    """A share as text with one decimal: ``0.4213`` -> ``42.1%``."""
    return one_decimal(F.lit(100.0) * _c(score), "%")


def one_decimal(number, unit: str = "") -> Column:
    """A number as text with one decimal, rounded by its exact binary value, ties to the even digit: ``99.25`` -> ``99.2``.

    ``format_string`` rounds the shortest decimal form, ties away from zero. The
    fraction is scaled to a whole number of 2**-58, exact wherever it can be a tie.
    """
    number = _c(number)
    plain = F.abs(number) < F.lit(1e15)
    size = F.when(plain, F.abs(number)).otherwise(F.lit(0.0))
    tenths = ((size - F.floor(size)) * F.lit(float(1 << 58))).cast("bigint") * F.lit(10)
    digit, rest = F.shiftright(tenths, 58), tenths.bitwiseAND(F.lit((1 << 58) - 1))
    up = (rest > F.lit(1 << 57)) | ((rest == F.lit(1 << 57)) & (digit % 2 == 1))
    whole = F.floor(size) * F.lit(10) + digit + up.cast("bigint")
    sign = F.when(number < 0, F.lit("-")).otherwise(F.lit(""))
    text = F.concat(sign, ((whole - whole % 10) / F.lit(10)).cast("bigint").cast("string"), F.lit("."), (whole % 10).cast("string"), F.lit(unit))
    return F.when(plain, text).when(number.isNotNull(), F.format_string("%.1f" + unit.replace("%", "%%"), number))


def contract_cost(quantity, price, level, noise=None) -> Column:
    """Cost label: quantity x price x (1 + noise) x (0.5 + 0.5 * level / 4)."""
    cost = _c(quantity) * _c(price) * (F.lit(0.5) + F.lit(0.5) * _c(level) / F.lit(4))
    return cost if noise is None else cost * (F.lit(1.0) + noise)


def stable_uniform(key, seed: int) -> Column:
    """A uniform draw in (0, 1) fixed by the row key, so retries repeat it."""
    bits = F.pmod(F.xxhash64(_c(key), F.lit(seed)), F.lit(1 << 52))
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def stable_normal(key, seed: int) -> Column:
    """A standard normal draw fixed by the row key (polar form of two uniforms)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(stable_uniform(key, seed)))
    return radius * F.cos(F.lit(2.0) * F.pi() * stable_uniform(key, seed + 1))


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column
