"""Column expressions used by the silver and gold jobs.

Every function takes and returns :class:`pyspark.sql.Column` objects, so all
work stays inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import (BAND_LABELS, CAPITAL_CITY, COST_RATE, POPULARITY_CUTS,  # noqa: F401
                     POPULARITY_LABELS, PRICE_CUTS, REGION_CITIES, REGION_IN_LABEL,
                     REGION_OUT_LABEL, STAR_RANK, STOCK_CUTS, WEEKEND_DAYS)

MONEY = "decimal(18,2)"
RATE = "decimal(5,4)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketize(c: str | Column, cuts: Sequence, labels: Sequence[str]) -> Column:
    """Ordered CASE with strict ``<`` upper bounds; NULL falls to the last label."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("bucketize needs exactly one more label than cut points")
    x = col(c)
    expr = F.when(x < F.lit(cuts[0]), F.lit(labels[0]))
    for cut, label in zip(cuts[1:], labels[1:-1]):
        expr = expr.when(x < F.lit(cut), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def tier_by_rank(c: str | Column, cuts: Sequence = POPULARITY_CUTS,
                 labels: Sequence[str] = POPULARITY_LABELS) -> Column:
    """Like :func:`bucketize` with inclusive ``<=`` bounds (Top <= 10, Média <= 40)."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("tier_by_rank needs exactly one more label than cut points")
    x = col(c)
    expr = F.when(x <= F.lit(cuts[0]), F.lit(labels[0]))
    for cut, label in zip(cuts[1:], labels[1:-1]):
        expr = expr.when(x <= F.lit(cut), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def flag(cond: Column) -> Column:
    """Boolean flag from a comparison; NULL input stays NULL."""
    return cond.cast("boolean")


def member_label(c: str | Column, values: Iterable, in_label: str, else_label: str) -> Column:
    """IN-list label; values outside the list and NULL get ``else_label``."""
    return F.when(col(c).isin(*list(values)), F.lit(in_label)).otherwise(F.lit(else_label))


def is_in(c: str | Column, values: Iterable) -> Column:
    return col(c).isin(*list(values))


def cast_col(c: str | Column, to: str, safe: bool = False) -> Column:
    """Cast; ``safe=True`` turns invalid input into NULL instead of an ANSI error."""
    return col(c).try_cast(to) if safe else col(c).cast(to)


def safe_ratio(num: str | Column, den: str | Column, scale: int, default=0.0) -> Column:
    """``den > 0 ? round(num / den, scale) : default``.

    With the float default (as in the silver jobs) the result is a double; with
    ``default=None`` it keeps the decimal type of the quotient and falls back
    to NULL. ``den <= 0`` and NULL denominators take the default.
    """
    n, d = col(num), col(den)
    fallback = F.lit(None).cast(MONEY) if default is None else F.lit(default)
    return F.round(F.when(d > 0, n / d).otherwise(fallback), scale)


def add_gross(net: str | Column = "net", discount: str | Column = "discount") -> Column:
    """Gross revenue = net + discount (decimal(18,2) + decimal(18,2) -> decimal(19,2))."""
    return col(net) + col(discount)


def cost_and_margin(price: str | Column = "list_price", rate: float = COST_RATE) -> dict[str, Column]:
    """Estimated cost, margin value and margin share of the list price.

    The rate is a double, so the three results are doubles, each rounded
    half-up (cost and margin to 2 places, the share to 4).
    """
    p = col(price)
    cost = F.round(p * F.lit(float(rate)), 2)
    margin = F.round(p - cost, 2)
    pct = F.round(F.when(p > 0, margin / p).otherwise(F.lit(0.0)), 4)
    return {"est_cost": cost, "margin": margin, "margin_pct": pct}


def padded_id(prefix: str, n: str | Column, width: int) -> Column:
    """``prefix`` + zero-padded number. Unlike plain ``lpad`` a number wider
    than ``width`` keeps all its digits instead of being cut (no collisions)."""
    s = col(n).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) > width, s).otherwise(F.lpad(s, width, "0")))


def to_money(c: str | Column) -> Column:
    """Exact money value: cast to decimal(18,2) first, before any arithmetic."""
    return col(c).cast(MONEY)


def uniform(*keys: str | Column, salt: str) -> Column:
    """Keyed pseudo-uniform draw in [0, 1).

    First 8 hex digits of ``md5(key1|key2|...|salt)`` read as an unsigned
    32-bit number and divided by 2^32. Unlike ``rand(seed)`` the value depends
    only on the keys, never on partitioning or task retries, so a recomputed
    partition after an executor loss yields the same rows.
    """
    parts = [col(k).cast("string") for k in keys] + [F.lit(salt)]
    h = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(h, 16, 10).cast("bigint") / F.lit(4294967296.0)


def uniform_below(*keys: str | Column, salt: str, p: float) -> Column:
    """``uniform(*keys, salt=salt) < p``, from the hex digits of the hash (no number is parsed)."""
    bound = math.ceil(p * 2 ** 32)
    if not 0 < bound < 2 ** 32:
        return F.lit(bound > 0)
    parts = [col(k).cast("string") for k in keys] + [F.lit(salt)]
    # digits of equal length order like numbers; the 24 more ones of the hash only matter after equal digits, where both are false
    return F.md5(F.concat_ws("|", *parts)) < F.lit(f"{bound:08x}")


def keyed_int(*keys: str | Column, salt: str, modulus: int) -> Column:
    """Keyed draw in 0 .. modulus-1 (same hash as :func:`uniform`)."""
    parts = [col(k).cast("string") for k in keys] + [F.lit(salt)]
    h = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.pmod(F.conv(h, 16, 10).cast("bigint"), F.lit(modulus))
