"""Rates, rounding and money totals.

Rounding rules differ between the reference's SQL and its pandas code, so
both are provided:

* ``rate_pct_half_up`` - the analytics SQL ``ROUND(s/t*100, 2)``, computed
  exactly from the two integer counts (half-up on the true ratio).
* ``rate_pct_half_even`` - pandas ``round(s/t*100, 2)``: numpy scales the
  double by 100, rounds half-to-even and divides back.

Money sums add ``decimal(38, 6)`` values, so they do not depend on the order
or the partitioning of the rows, and become a double once, at the end.
Amounts of up to six decimals are summed exactly; further decimals are
rounded half up at the sixth.  Amounts that no decimal holds (infinite, or
beyond 1e32) are added as doubles.  ``money_total`` rounds the sum to cents
where the reference's SQL does; ``money_sum`` does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate_pct_half_up(successes: Column, total: Column) -> Column:
    num = successes.cast("long") * F.lit(20000) + total.cast("long")
    den = total.cast("long") * F.lit(2)
    # exact integer floor division: (num - num mod den) is a multiple of den
    return F.when(total > 0, ((num - F.pmod(num, den)) / den) / F.lit(100.0))


def rate_pct_half_even(successes: Column, total: Column) -> Column:
    ratio = F.try_divide(successes.cast("double"), total.cast("double")) * F.lit(100.0)
    return F.rint(ratio * F.lit(100.0)) / F.lit(100.0)


SUM_TYPE = "decimal(38,6)"


def money_sum(amount: Column) -> Column:
    """Order-independent sum as a double; null without non-null amounts."""
    exact = amount.try_cast(SUM_TYPE)
    rest = F.sum(F.when(exact.isNull(), amount))
    total = F.sum(exact).cast("double")
    return F.when(rest.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + rest)


def money_total(amount: Column) -> Column:
    return F.round(money_sum(amount), 2)
