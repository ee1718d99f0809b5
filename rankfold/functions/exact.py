"""Sums of doubles that do not depend on the order of addition.

A sum of doubles rounds after every addition, so its last bits follow the partitioning. Here each
value is cut into integer limbs of fixed weights, the limbs are summed exactly (as decimals, in
ordinary partial aggregates), and the total is rounded once at the end. Limbs hold the bits from
2^62 down to 2^-120: a value's lower bits are cut off, always in the same way; values of 2^63 or
more, infinities and NaN make the sum NaN (and its ``overflow`` count tells).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 30                            # of a limb but the first, which takes the sign too
WEIGHTS = (30, 0, -30, -60, -90, -120)  # powers of two
LIMIT = float(2 ** 63)


def limbs(value: Column) -> list[Column]:
    """Integers (doubles) l_k, of the value's sign, with value = sum of l_k * 2^WEIGHTS[k] up to
    cut-off bits. Every step is exact: powers of two scale, and a remainder by one needs no more
    bits than the value. Each limb comes from the value itself, so no expression grows."""
    size, sign = F.abs(value), F.signum(value)
    above = [size, *[size % F.lit(2.0 ** w) for w in WEIGHTS[:-1]]]
    return [sign * F.floor(rest / F.lit(2.0 ** w)) for rest, w in zip(above, WEIGHTS)]


def exact_sum(value: Column) -> Column:
    """The sum of ``value`` (double) in an aggregate, the same bits whatever the order of the rows;
    null without a value."""
    fits = F.abs(value) < F.lit(LIMIT)  # false for NaN, which is larger than any number
    sums = [F.sum(F.when(fits, limb).cast("decimal(28,0)")) for limb in limbs(value)]
    base = F.lit(2 ** BITS).cast("decimal(11,0)")
    low = [F.pmod(s, base).cast("decimal(38,0)") for s in sums[1:]]
    carry = [((s.cast("decimal(38,0)") - x) / base).cast("decimal(38,0)") for s, x in zip(sums[1:], low)]
    # a limb takes what the next lower one carries; doubles hold these exactly, added upwards from the least
    whole = [(x + c).cast("double") for x, c in zip([sums[0].cast("decimal(38,0)"), *low], [*carry, F.lit(0)])]
    result = F.lit(0.0)
    for limb, w in reversed(list(zip(whole, WEIGHTS))):
        result = result + limb * F.lit(2.0 ** w)
    bad = F.count(F.when(~fits, 1))
    return F.when(F.count(value) == 0, F.lit(None).cast("double")).when(bad > 0, F.lit(float("nan"))).otherwise(result)
