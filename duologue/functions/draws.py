"""Repeatable random draws: a digest of the row's key, not of its partition."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from duologue.functions import fixed_values as fv
from duologue.functions.text import round_half_up


def uniform(key: Column, salt: str | Column = "") -> Column:
    """A number in [0, 1) from the first 32 bits of SHA-1 of the key and a salt."""
    salt_column = salt if isinstance(salt, Column) else F.lit(salt)
    digest = F.sha1(F.concat_ws("/", key.cast("string"), salt_column.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def gaussian(key: Column, draw: Column, mean: float, std: float) -> Column:
    """Normal draw number ``draw`` of a key, by the Box-Muller transform."""
    u = F.greatest(uniform(key, F.concat(F.lit("u"), draw.cast("string"))), F.lit(1e-12))
    v = uniform(key, F.concat(F.lit("v"), draw.cast("string")))
    return F.lit(mean) + F.lit(std) * F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2.0 * math.pi) * v)


def target_duration(
    key: Column,
    *,
    mean: float = fv.MEAN_DURATION_SEC,
    std: float = fv.STD_DURATION_SEC,
    low: float = fv.MIN_DURATION_SEC,
    high: float = fv.MAX_DURATION_SEC,
    tries: int = 100,
) -> Column:
    """Truncated normal: the first of ``tries`` draws inside the window, else clamped.

    The first draws are plain expressions; the array of all others is only
    evaluated for the few rows that need it.
    """
    inside = lambda d: F.when(d.between(F.lit(low), F.lit(high)), d)
    draw = lambda n: gaussian(key, n, mean, std)
    later = F.filter(
        F.transform(F.sequence(F.lit(3), F.lit(tries)), draw), lambda d: d.between(F.lit(low), F.lit(high))
    )
    clamped = F.least(F.greatest(draw(F.lit(tries + 1)), F.lit(low)), F.lit(high))
    return round_half_up(
        F.coalesce(inside(draw(F.lit(1))), inside(draw(F.lit(2))), F.try_element_at(later, F.lit(1)), clamped), 1
    )


def permuted(key: Column, values: Sequence[str]) -> Column:
    """All values in an order of the key's own: by the SHA-256 of ``key/value``."""
    ranked = F.transform(F.array(*[F.lit(v) for v in values]), lambda v: F.struct(F.sha2(F.concat_ws("/", key.cast("string"), v), 256).alias("at"), v.alias("v")))
    return F.transform(F.array_sort(ranked), lambda x: x["v"])


def inclusion_share(value: Column, default: float = fv.NUMBER_INCLUSION_DEFAULT) -> Column:
    """A fraction or a percentage as a fraction within 0..1; unreadable -> default."""
    number = F.trim(value.cast("string")).try_cast("double")
    share = F.when(number > 1.0, number / F.lit(100.0)).otherwise(number)
    return F.coalesce(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)), F.lit(default))


def includes_numbers(key: Column, share: Column) -> Column:
    """One repeatable draw per conversation."""
    return uniform(key, "numbers") < share
