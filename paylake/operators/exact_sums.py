"""Exact sums of doubles as partial states that can be stored and merged (A4, A5, A1).

A double is an integer times a power of two, so every finite amount is cut, without
rounding, into four signed digits to the base 2**20, the first of them at the place
``bucket`` of its leading bit. Digits are added as 64-bit integers in plain partial
aggregates by (keys, bucket): order and partitioning of the rows cannot matter, and
2**43 rows a group cannot overflow (a larger sum raises). A group has at most some
107 buckets, the exponent range of a double; amounts of one currency have two or
three. ``finished`` carries the digits and rounds once, half to even: the total is
the double nearest to the true sum of the given doubles, as ``math.fsum`` gives it.

A state is a plain table ``keys, bucket, n_*, l?_*, odd_*``: two states of disjoint
rows are added with ``merged``, so a daily total grows by a batch without a second
look at the rows that made it.

Nulls are not added; a total of nulls alone is null. Infinite and NaN amounts are
added as doubles (``odd_*``) and decide the total; a sum beyond the range of doubles
is infinite. Null keys form a group of their own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 20                  # of a digit
DIGITS = 4                 # 1 + 3 * 20 >= 53 bits, wherever the leading bit is
BASE = 1 << BITS
CARRIES = 3                # further places that 63-bit digit sums can carry into
_DIGIT = "_digit{}"


def _pow2(e: Column) -> Column:
    return F.pow(F.lit(2.0), e.cast("double"))


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by.cast("int"))


def _cut(df: DataFrame, amount: Column) -> DataFrame:
    """``df`` with ``bucket`` and the digits of ``amount``; without a digit other than
    0 these are null. An inexact logarithm moves the bucket by one place at most, and
    the digits still hold all bits then: the first is 0 or one bit longer."""
    finite = F.abs(amount) < F.lit(float("inf"))
    df = df.withColumn("bucket", F.when(finite & ~F.isnan(amount) & (amount != 0), F.floor(
        F.log2(F.abs(amount)) / BITS).cast("int")))
    half = _pow2(F.col("bucket") * F.lit(-BITS // 2))  # in two steps: 2**1080 is no double
    df = df.withColumn("_rest", amount * half * half)
    for j in range(DIGITS):
        digit = _DIGIT.format(j)
        df = df.withColumn(digit, F.col("_rest").cast("long"))
        df = df.withColumn("_rest", (F.col("_rest") - F.col(digit)) * F.lit(float(BASE)))
    return df.drop("_rest")


def partials(df: DataFrame, keys: list[str], amount: Column,
             totals: dict[str, Column | None], counts: dict[str, Column] | None = None
             ) -> DataFrame:
    """State of ``df``: for each name in ``totals`` the digits of the amounts where its
    condition holds (``None``: of all), for each in ``counts`` the rows where that holds."""
    held = {n: F.lit(True) if c is None else F.coalesce(c, F.lit(False))
            for n, c in totals.items()}
    rows = df.select(*keys, amount.cast("double").alias("_amount"),
                     *[c.alias(f"_if_{n}") for n, c in held.items()],
                     *[c.alias(f"_of_{n}") for n, c in (counts or {}).items()])
    rows = _cut(rows, F.col("_amount"))
    own = F.col("_amount")
    odd = F.isnan(own) | (F.abs(own) == F.lit(float("inf")))
    sums = [F.count_if(f"_of_{n}").alias(f"c_{n}") for n in counts or {}]
    for n in totals:
        on = F.col(f"_if_{n}")
        sums.append(F.count(F.when(on, own)).alias(f"n_{n}"))
        sums.append(F.sum(F.when(on & odd, own)).alias(f"odd_{n}"))
        sums += [F.sum(F.when(on, F.col(_DIGIT.format(j)))).alias(f"l{j}_{n}")
                 for j in range(DIGITS)]
    return rows.groupBy(*keys, "bucket").agg(*sums)


def merged(state: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (keys, bucket) of states stacked with ``unionByName``."""
    rest = [c for c in state.columns if c not in (*keys, "bucket")]
    return state.groupBy(*keys, "bucket").agg(*[F.sum(c).alias(c) for c in rest])


def finished(state: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, then each count and total of the state under its own name."""
    names = [c[2:] for c in state.columns if c.startswith("n_")]
    counts = [c[2:] for c in state.columns if c.startswith("c_")]
    aggs = [F.sum(f"c_{n}").alias(f"c_{n}") for n in counts]
    for n in names:
        digits = [f"l{j}_{n}" for j in range(DIGITS)]
        aggs += [F.sum(f"n_{n}").alias(f"n_{n}"), F.sum(f"odd_{n}").alias(f"odd_{n}"),
                 # one entry a bucket, the exponent range bounds them
                 F.collect_list(F.when(F.col(digits[0]).isNotNull() & F.col("bucket").isNotNull(),
                                       F.struct("bucket", *[F.col(d).alias(f"l{j}") for j, d
                                                            in enumerate(digits)])))
                 .alias(f"parts_{n}")]
    one = merged(state, keys)
    out = one.groupBy(*keys).agg(*aggs) if keys else one.agg(*aggs)
    for n in names:
        out = _rounded(out, n)
    return out.select(*keys, *[F.col(f"c_{n}").alias(n) for n in counts], *names)


def _rounded(df: DataFrame, n: str) -> DataFrame:
    """Adds the column ``n``: the double nearest to the sum of ``parts_n``."""
    parts = F.col(f"parts_{n}")
    lowest = F.array_min(F.transform(parts, lambda p: p["bucket"])) - (DIGITS - 1)
    highest = F.array_max(F.transform(parts, lambda p: p["bucket"])) + CARRIES + 1
    df = df.withColumn("_low", lowest)

    def place(at):  # the sum of all digits at one place
        return F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc + F.coalesce(*[
            F.when(p["bucket"] - j == at, p[f"l{j}"]) for j in range(DIGITS)],
            F.lit(0).cast("long")))

    df = df.withColumn("_sums", F.when(F.size(parts) > 0, F.transform(
        F.sequence("_low", highest), place)))

    def carried(sums):  # digits 0 .. BASE - 1, least first, and what is left over
        return F.aggregate(
            sums, F.struct(F.lit(0).cast("long").alias("over"),
                           F.array().cast("array<bigint>").alias("digits")),
            lambda acc, s: F.struct(
                F.shiftright(acc["over"] + s, BITS).alias("over"),
                F.concat(acc["digits"], F.array((acc["over"] + s).bitwiseAND(BASE - 1)))
                .alias("digits")))

    df = df.withColumn("_minus", carried(F.col("_sums"))["over"] < 0)
    df = df.withColumn("_digits", carried(F.transform(
        "_sums", lambda s: F.when(F.col("_minus"), -s).otherwise(s)))["digits"])
    df = df.withColumn("_top", F.array_max(F.transform(
        "_digits", lambda d, i: F.when(d != 0, i))))

    def digit(back):
        return F.coalesce(F.get("_digits", F.col("_top") - back), F.lit(0).cast("long"))

    # the leading digit and the next three in one integer of 61 or 62 bits; a bit
    # that falls off, or any digit further down, sets the last bit
    df = df.withColumn("_cut", F.greatest(F.lit(0), F.length(F.bin(digit(0))) - 2))
    df = df.withColumn("_tail", F.shiftleft(digit(1), 2 * BITS).bitwiseOR(
        F.shiftleft(digit(2), BITS)).bitwiseOR(digit(3)))
    lost = F.pmod(F.col("_tail"), _shift("shiftleft", F.lit(1).cast("long"), F.col("_cut"))) != 0
    below = F.exists(F.transform("_digits", lambda d, i: (d != 0) & (i < F.col("_top") - 3)),
                     lambda x: x)
    whole = _shift("shiftleft", digit(0), F.lit(3 * BITS) - F.col("_cut")).bitwiseOR(
        _shift("shiftright", F.col("_tail"), F.col("_cut"))).bitwiseOR(
        F.when(lost | below, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    power = F.lit(BITS) * (F.col("_low") + F.col("_top") - 3) + F.col("_cut")
    first = F.greatest(power, F.lit(-1000))  # in two steps down to the least doubles
    size = whole.cast("double") * _pow2(first) * _pow2(power - first)
    total = F.when(F.col("_top").isNull(), F.lit(0.0)).when(F.col("_minus"), -size) \
        .otherwise(size)
    total = F.coalesce(F.col(f"odd_{n}"), F.when(F.col(f"n_{n}") > 0, total))
    return df.withColumn(n, total).drop("_low", "_sums", "_minus", "_digits", "_top", "_cut",
                                        "_tail", f"parts_{n}", f"odd_{n}", f"n_{n}")


def exact_totals(df: DataFrame, keys: list[str], amount: Column,
                 totals: dict[str, Column | None],
                 counts: dict[str, Column] | None = None) -> DataFrame:
    """Exact totals and counts by ``keys``; see the module's text for the edge cases."""
    return finished(partials(df, keys, amount, totals, counts), keys)
