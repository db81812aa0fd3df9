"""Exact money and rating arithmetic.

Prices and rates arrive as doubles. A sum of doubles depends on the order of the rows, so
two runs over the same data may differ in the last digits and swap a top-1. Every double therefore counts
as a decimal, the shortest one that gives this double, and sums are taken over whole units that any order leaves the same.

A unit is as fine as the prices and rates of a table need (``places_needed``). Where four to nine
decimal places do and amounts have up to 14 digits, an amount is one bigint, a number of ticks. Otherwise (``Scale``) it is cut
into limbs: bigints of nine decimal digits each, from the finest place up, with what remains in the
topmost. The limbs are summed each for itself, and carried once, in the result. Any finite double has its
place: a table with 1/3, 1e-12 and 1e15 takes three limbs. The total is turned into the nearest double.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decimal places of a tick: at least, and at most.
TICK_PLACES, MAX_PLACES = 4, 9
# A double may miss its decimal by so much of itself: what arithmetic before the input leaves behind.
NOISE = 1e-15
# Digits of a limb, and of the topmost one at most: products with a quantity then fit (``wide_product``).
LIMB_DIGITS, TOP_DIGITS = 9, 14


class Scale(int):
    """Decimal places of a unit, and the number of limbs that amounts take."""

    limbs: int

    def __new__(cls, places: int, limbs: int) -> Scale:
        scale = super().__new__(cls, places)
        scale.limbs = limbs
        return scale


class Places(NamedTuple):
    """Decimal places of the units of prices and of rates: plain numbers for ticks, else scales."""

    price: int = TICK_PLACES
    rate: int = TICK_PLACES


class NotFinite(ValueError):
    """A price or rate is infinite or no number."""


_WIDE = "decimal(38,0)"
_LOW_BITS = 16
_LOW_MASK = (1 << _LOW_BITS) - 1


def _whole(value: Column, places: int) -> Column:
    return F.round(value * F.lit(10**places))


def _exact(value: Column, places: int) -> Column:
    return F.abs(_whole(value, places) / F.lit(10**places) - value) <= F.abs(value) * F.lit(NOISE)


def to_ticks(value: Column, places: int = TICK_PLACES) -> Column:
    """Whole ticks of a double; a value with more decimal places is an error."""
    refused = F.raise_error(F.concat(value.cast("string"), F.lit(f" has more than {places} decimal places")))
    return F.when(value.isNull() | _exact(value, places), _whole(value, places)).otherwise(refused.cast("double")).cast("bigint")


def _shortest(value: Column) -> tuple[Column, Column]:
    """Digits of a double without sign and trailing zeros, none for zero, and the power of ten of the last."""
    text = F.abs(value).cast("string")
    mantissa = F.substring_index(text, "E", 1)
    power = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1)).otherwise(F.lit("0")).cast("int")
    fraction = F.when(F.contains(mantissa, F.lit(".")), F.substring_index(mantissa, ".", -1)).otherwise(F.lit(""))
    every = F.concat(F.substring_index(mantissa, ".", 1), fraction)
    digits = F.regexp_replace(every, "0+$", "")
    return F.regexp_replace(digits, "^0+", ""), power - F.length(fraction) + F.length(every) - F.length(digits)


def places_needed(products: DataFrame, price: str = "price", rate: str = "rate") -> Places:
    """What all prices and rates of a dimension need, found in one pass over it, or two if ticks won't do."""

    def needed(name: str) -> Column:
        enough = F.lit(None).cast("int")
        for places in range(MAX_PLACES, TICK_PLACES - 1, -1):
            enough = F.when(_exact(F.col(name), places), F.lit(places)).otherwise(enough)
        return F.coalesce(enough, F.when(F.col(name).isNull(), F.lit(TICK_PLACES)).otherwise(F.lit(MAX_PLACES + 1)))

    def odd(name: str) -> Column:
        return F.isnan(name) | (F.abs(name) == float("inf"))

    found = products.agg(
        *(F.max(F.when(~odd(n), needed(n))).alias(n) for n in (price, rate)), *(F.max(F.when(~odd(n), F.abs(n))).alias(f"{n}_most") for n in (price, rate)),
        *(F.max(F.when(odd(n), F.col(n).cast("string"))).alias(f"{n}_odd") for n in (price, rate)),
    ).first()
    for name in (price, rate):
        if found[f"{name}_odd"] is not None:
            raise NotFinite(f"{name} {found[f'{name}_odd']}")

    def ticks(name: str) -> bool:
        places = found[name] or TICK_PLACES
        return places <= MAX_PLACES and (found[f"{name}_most"] or 0) * 10**places < 10**TOP_DIGITS

    scales = {name: found[name] or TICK_PLACES for name in (price, rate)}
    if fine := [name for name in (price, rate) if not ticks(name)]:
        parts = {name: _shortest(F.col(name)) for name in fine}
        spans = products.agg(*(F.min(F.when(d != "", e)).alias(f"{n}_low") for n, (d, e) in parts.items()), *(F.max(F.when(d != "", e + F.length(d))).alias(f"{n}_high") for n, (d, e) in parts.items())).first()
        for name in fine:
            places = max(TICK_PLACES, -spans[f"{name}_low"])
            scales[name] = Scale(places, 1 + max(0, -(-(spans[f"{name}_high"] + places - TOP_DIGITS) // LIMB_DIGITS)))
    return Places(scales[price], scales[rate])


def limbs(value: Column, places: int) -> list[Column]:
    """A double in units, from the lowest limb up; one number of ticks unless ``places`` is a scale."""
    if not isinstance(places, Scale):
        return [to_ticks(value, places)]
    digits, power = _shortest(value)
    width = LIMB_DIGITS * (places.limbs - 1) + TOP_DIGITS
    padded = F.lpad(F.concat(digits, F.repeat(F.lit("0"), F.when(digits != "", power + int(places)).otherwise(F.lit(0)))), width, "0")
    starts = [(width - LIMB_DIGITS * (i + 1) + 1, LIMB_DIGITS) for i in range(places.limbs - 1)] + [(1, TOP_DIGITS)]
    sign = F.when(value < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    return [F.substring(padded, at, n).cast("bigint") * sign for at, n in starts]


def limb_names(name: str, places: int) -> list[str]:
    """Names of an amount's limbs, the lowest one named as the amount."""
    return [name, *(f"{name}{i}" for i in range(1, getattr(places, "limbs", 1)))]


def wide_parts(total: Column, name: str) -> list[Column]:
    """A bigint as two bigints, ``<name>_high`` and ``<name>_low``, that can be summed further.

    A bigint total of ticks overflows on some 10**12 lines of one key; a decimal total costs
    about twice the time per line and twice the bytes per row. The high and the low bits, each
    summed as a bigint, are exact for any table.
    """
    high, low = F.shiftright(total, _LOW_BITS), total.bitwiseAND(F.lit(_LOW_MASK))
    return [high.alias(f"{name}_high"), low.alias(f"{name}_low")]


def wide_product(left: Column, right: Column, name: str) -> list[Column]:
    """The product of two bigints as such a pair, exact also where the product is no bigint.

    ``left`` is the smaller factor, such as a price: below 2**47, and the product below 2**78.
    Anything larger is an overflow error.
    """
    low = left * right.bitwiseAND(F.lit(_LOW_MASK))
    high = left * F.shiftright(right, _LOW_BITS) + F.shiftright(low, _LOW_BITS)
    return [high.alias(f"{name}_high"), low.bitwiseAND(F.lit(_LOW_MASK)).alias(f"{name}_low")]


def wide_total(name: str) -> Column:
    """Sum over the pair ``name`` as decimal(38,0)."""
    high, low = F.sum(f"{name}_high").cast(_WIDE), F.sum(f"{name}_low").cast(_WIDE)
    return (high * F.lit(1 << _LOW_BITS).cast("decimal(5,0)") + low).cast(_WIDE)


def amount(ticks: Column, places: int = TICK_PLACES) -> Column:
    """Decimal amount behind a tick total."""
    return ticks.cast("decimal(28,0)") * F.lit(Decimal(1).scaleb(-places)).cast(f"decimal({places},{places})")


def ratio_half_up(ticks: Column, count: Column, digits: int, places: int = TICK_PLACES) -> Column:
    """``ticks / count`` as a double, rounded half up (away from zero) to ``digits`` decimals.

    Integer arithmetic throughout, so a value on the half is never lost to a double.
    NULL where the count is zero or NULL.
    """
    step = F.nullif(count, F.lit(0)).cast(_WIDE) * F.lit(10 ** (places - digits)).cast("decimal(9,0)")
    step = step.cast(_WIDE)
    doubled = (F.abs(ticks).cast(_WIDE) * F.lit(2).cast("decimal(1,0)") + step).cast(_WIDE)
    whole = F.call_function("div", doubled, (step * F.lit(2).cast("decimal(1,0)")).cast(_WIDE))
    return F.sign(ticks).cast("double") * whole.cast("double") / F.lit(float(10**digits))


def _carried(totals: list[Column]) -> Column:
    """``top`` and the digits ``low`` of the limbs below it, all of the latter from 0 to the base."""
    base = F.lit(10**LIMB_DIGITS).cast("decimal(10,0)")

    def step(acc: Column, limb: Column) -> Column:
        whole = (limb + acc["top"]).cast(_WIDE)
        digits = F.pmod(whole, base).cast(_WIDE)
        carry = F.call_function("div", (whole - digits).cast(_WIDE), base).cast(_WIDE)
        return F.struct(carry.alias("top"), F.concat(F.lpad(digits.cast("string"), LIMB_DIGITS, "0"), acc["low"]).alias("low"))

    start = F.struct(F.lit(0).cast(_WIDE).alias("top"), F.lit("").alias("low"))
    lower = F.aggregate(F.array(*totals[:-1]).cast(f"array<{_WIDE}>"), start, step)
    return F.struct((totals[-1] + lower["top"]).cast(_WIDE).alias("top"), lower["low"].alias("low"))


def _digits(totals: list[Column], times: int = 1) -> tuple[Column, Column]:
    """Sign and decimal digits of a sum of limbs, carried, times a small number."""
    factor = F.lit(times).cast("decimal(2,0)")
    up, down = (_carried([(t * factor).cast(_WIDE) for t in of]) for of in (totals, [(-t).cast(_WIDE) for t in totals]))
    negative = up["top"] < 0
    found = F.when(negative, down).otherwise(up)
    return F.when(negative, F.lit("-")).otherwise(F.lit("")), F.concat(found["top"].cast("string"), found["low"])


def total(name: str, places: int) -> Column:
    """The sum over the amount ``name`` as the nearest double."""
    if not isinstance(places, Scale):
        return amount(wide_total(name), places).cast("double")
    sign, digits = _digits([wide_total(n) for n in limb_names(name, places)])
    return F.concat(sign, digits, F.lit(f"E-{int(places)}")).cast("double")


def total_half_up(name: str, digits: int, places: int) -> Column:
    """The sum over the amount ``name``, rounded half up to ``digits`` decimals."""
    if not isinstance(places, Scale):
        return F.round(amount(wide_total(name), places), digits).cast("double")
    return mean_half_up(name, F.lit(1).cast("bigint"), digits, places)


def mean_half_up(name: str, count: Column, digits: int, places: int) -> Column:
    """The sum over the amount ``name`` by ``count``, rounded half up to ``digits`` decimals; NULL where the count is zero or NULL.

    Amounts of a scale that have more than 18 digits before the rounded place are no longer
    rounded there: no double has a digit left to round. They are the total by the count as doubles.
    """
    if not isinstance(places, Scale):
        return ratio_half_up(wide_total(name), count, digits, places)
    sign, doubled = _digits([wide_total(n) for n in limb_names(name, places)], times=2)
    # What is cut off is less than one, and so can't carry the quotient over the next whole number.
    kept = F.ltrim(F.substring(doubled, F.lit(1), F.greatest(F.length(doubled) - (int(places) - digits), F.lit(0))), F.lit("0"))
    parts = F.nullif(count, F.lit(0)).cast(_WIDE)
    doubled_count = (parts * F.lit(2).cast("decimal(1,0)")).cast(_WIDE)
    whole = F.call_function("div", (F.concat(F.lit("0"), kept).cast(_WIDE) + parts).cast(_WIDE), doubled_count).cast("double")
    rounded = F.when(sign == "-", -whole).otherwise(whole) / F.lit(float(10**digits))
    return F.when(F.length(kept) <= 18, rounded).otherwise(total(name, places) / F.nullif(count, F.lit(0)).cast("double"))
