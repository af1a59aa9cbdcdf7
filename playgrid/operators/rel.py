"""Relational building blocks shared by the marts.

Each operator is a DataFrame -> DataFrame composition of built-in Spark
operators chosen for how it partitions at scale:

* ``latest_version`` dedups with ``groupBy(key).max_by(struct)`` instead of a
  ``row_number`` window: the hash aggregate combines map-side, so a hot key
  (one key with a third of all rows) is reduced in every map task before the
  shuffle instead of being sorted in one reducer.
* ``last_known`` / ``first_known`` are ``max_by`` / ``min_by`` whose ordering is
  nulled where the value is NULL (the reference skips NULL values).
* ``asof_lookup`` turns the rate series into a forward-filled daily table
  (keys x calendar days, independent of event volume) and joins events on
  (key, day) equality: O(1) per event, no range-join row blow-up.
* ``dense_days`` explodes a bounded ``sequence`` per row (at most
  ``max_days + 1`` rows each).
* ``running_sum`` is a ROWS frame window partitioned by the cohort key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in ([x] if isinstance(x, (str, Column)) else x)]


def latest_version(df: DataFrame, key: Sequence[str], order: Sequence[str], method: str = "agg") -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (last version wins).

    ``method="agg"`` (default): grouped ``max_by`` with map-side partial
    aggregation - the choice when a key can have many versions (upserted
    API records, re-read windows, hot keys).
    ``method="window"``: the first row of a window over the key - cheaper when keys are
    near-unique message identities (the event log), where partial
    aggregation removes nothing and ``max_by`` over a wide struct forces a
    sort-based aggregate. The first row is the one with none before it: for
    ``row_number() = 1`` Spark would also sort the wide rows before the shuffle.
    """
    if method == "window":
        w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
        return df.withColumn("_before", F.lag(F.lit(True)).over(w)).filter(F.col("_before").isNull()).drop("_before")
    others = [c for c in df.columns if c not in key]
    picked = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*_cols(order)))
    return (df.groupBy(*key).agg(picked.alias("_v"))
            .select(*key, *[F.col(f"_v.{c}").alias(c) for c in others]))


def last_known(value, order) -> Column:
    """argMaxIf(value, order, value IS NOT NULL)."""
    v = value if isinstance(value, Column) else F.col(value)
    o = order if isinstance(order, Column) else F.col(order)
    return F.max_by(v, F.when(v.isNotNull(), o))


def first_known(value, order) -> Column:
    """argMinIf(value, order, value IS NOT NULL)."""
    v = value if isinstance(value, Column) else F.col(value)
    o = order if isinstance(order, Column) else F.col(order)
    return F.min_by(v, F.when(v.isNotNull(), o))


def _at(value, order: Column) -> Column:
    v = value if isinstance(value, Column) else F.col(value)
    return F.when(v.isNotNull(), F.struct(order.alias("at"), v.alias("value")))


def last_part(value, order: Column) -> Column:
    """``last_known`` of a part of the rows as (at, value): the parts are compared again by ``at``."""
    return last_known(_at(value, order), order)


def first_part(value, order: Column) -> Column:
    """The same for ``first_known``."""
    return first_known(_at(value, order), order)


def dense_days(df: DataFrame, start: str, as_of, max_days: int = 30,
               out: str = "day_since_install") -> DataFrame:
    """Dense grid 0..min(max_days, as_of - start) per row (no grid for future starts)."""
    age = F.datediff(F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of, F.col(start))
    return (df.filter(age >= 0)
            .withColumn(out, F.explode(F.sequence(F.lit(0), F.least(F.lit(max_days), age)))))


def running_sum(col: str, partition: Sequence[str], order: str) -> Column:
    w = (Window.partitionBy(*partition).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum(col).over(w)


def running_max(col, partition: Sequence[str], order: str) -> Column:
    w = (Window.partitionBy(*partition).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.max(col).over(w)


def asof_table(rates: DataFrame, key: str = "currency", date: str = "business_date",
               value: str = "usd_per_unit") -> tuple[DataFrame, DataFrame]:
    """As-of lookup tables for a (key, date) -> value series.

    Returns ``(daily, summary)``: ``daily`` holds one row per key and calendar
    day between the key's first and last date with the value of the latest
    date <= that day (forward fill with ``last(ignorenulls)`` over a window
    partitioned by key); ``summary`` holds per key the first / last date and
    the earliest / latest value. Both are bounded by (keys x calendar days) of
    the rate table, independent of the event volume, so the event side joins
    them on an equality key and never multiplies rows by the number of rate
    dates (the naive equi + range join would).
    """
    span = rates.groupBy(key).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    cal = span.select(key, F.explode(F.sequence("_lo", "_hi")).alias("_day"))
    obs = rates.select(F.col(key), F.col(date).alias("_day"), F.col(value).alias("_v"))
    w = (Window.partitionBy(key).orderBy("_day")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    daily = (cal.join(obs, [key, "_day"], "left")
             .select(key, "_day", F.last("_v", ignorenulls=True).over(w).alias("_v")))
    summary = rates.groupBy(key).agg(
        F.min(date).alias("_first_day"), F.max(date).alias("_last_day"),
        F.min_by(value, date).alias("_first_v"), F.max_by(value, date).alias("_last_v"))
    return daily, summary


def asof_lookup(events: DataFrame, rates: DataFrame, ev_key, ev_date: str, out: str = "rate_le",
                first_out: str | None = "rate0", key: str = "currency",
                date: str = "business_date", value: str = "usd_per_unit") -> DataFrame:
    """Attach the value of the latest rate date <= event date (``argMaxIf``).

    ``first_out`` additionally attaches the earliest value of the key (the
    fallback for events dated before the first rate). Events whose key has no
    rate at all get NULLs. Both lookup tables are keyed by equality; AQE
    broadcasts them when their runtime size is under the threshold and falls
    back to a shuffled join otherwise.
    """
    daily, summary = asof_table(rates, key, date, value)
    k = ev_key if isinstance(ev_key, Column) else F.col(ev_key)
    e = events.withColumn("_ak", k)
    e = e.join(daily.select(F.col(key).alias("_ak"), F.col("_day").alias(ev_date), F.col("_v")),
               ["_ak", ev_date], "left")
    e = e.join(summary.withColumnRenamed(key, "_ak"), "_ak", "left")
    e = e.withColumn(out, F.coalesce(F.col("_v"), F.when(F.col(ev_date) > F.col("_last_day"), F.col("_last_v"))))
    if first_out:
        e = e.withColumn(first_out, F.col("_first_v"))
    return e.drop("_ak", "_v", "_first_day", "_last_day", "_first_v", "_last_v")


def first_rate(rates: DataFrame, key: str = "currency", date: str = "business_date",
               rate_col: str = "usd_per_unit") -> DataFrame:
    """Earliest rate per currency (fallback for dates before the first rate)."""
    return rates.groupBy(key).agg(F.min_by(rate_col, date).alias("rate0"))


RADIX_BITS = 12


def grouped_median(counts: DataFrame, group: Sequence[str], value: str, weight: str, out: str = "median") -> DataFrame:
    """Exact median of an integer column per group, from a table of (group, value, weight = rows with that value).

    Rank selection by digits: each pass counts the rows of every group by the next ``RADIX_BITS`` bits of the value,
    among the values that share the digits found so far, and takes the digit that holds the middle rank. A group's
    state is at most 2^12 counts in each of two ranks (the two middle ones of an even number), whatever the group's
    rows or distinct values. As many passes are made as the differing bits of all values need (two for values
    below 2^24); each reads ``counts`` once, so it should be a written table.
    """
    low = F.lit(-(1 << 63)).cast("bigint")
    unsigned = F.col(value).cast("bigint").bitwiseXOR(low)  # unsigned bits in the values' order
    ends = counts.agg(F.min(value), F.max(value)).first()
    lo, hi = (int(x or 0) + (1 << 63) for x in ends)
    passes = max(1, -(-(lo ^ hi).bit_length() // RADIX_BITS))
    rows = counts.select(*group, unsigned.alias("_u"), F.col(weight).alias("_w"))
    total = rows.groupBy(*group).agg(F.sum("_w").alias("_n"))
    ranks = F.array(F.expr("(_n - 1) div 2"), F.expr("_n div 2"))
    state = total.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), F.posexplode(ranks).alias("_which", "_rank"))
    keys = [f"_g{i}" for i in range(len(group))]
    same = F.lit(True)
    for k, g in zip(keys, group):
        same = same & F.col(g).eqNullSafe(F.col(k))
    # what all values share, then a digit more in each pass
    state = state.withColumn("_prefix", F.lit(_signed(lo >> passes * RADIX_BITS)).cast("bigint"))
    for left in reversed(range(passes)):
        shift = left * RADIX_BITS
        above = F.shiftrightunsigned("_u", shift + RADIX_BITS) if shift + RADIX_BITS < 64 else F.lit(0).cast("bigint")
        digit = F.shiftrightunsigned("_u", shift).bitwiseAND(F.lit((1 << RADIX_BITS) - 1))
        held = rows.join(state, same & (above == F.col("_prefix")))
        per = held.groupBy(*keys, "_which", "_rank", "_prefix", digit.alias("_digit")).agg(F.sum("_w").alias("_w"))
        upto = F.sum("_w").over(Window.partitionBy(*keys, "_which").orderBy("_digit")
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = per.withColumn("_before", upto - F.col("_w")).filter(
            (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_w")))
        state = found.select(*keys, "_which", (F.col("_rank") - F.col("_before")).alias("_rank"),
                             F.shiftleft("_prefix", RADIX_BITS).bitwiseOR(F.col("_digit")).alias("_prefix"))
    middle = F.col("_prefix").bitwiseXOR(low).cast("double")
    return state.groupBy(*(F.col(k).alias(g) for k, g in zip(keys, group))).agg(
        (F.sum(middle) / 2).alias(out))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def segment_all(values: Column, include: Column | None = None) -> Column:
    """['ALL', value] (or ['ALL'] when ``include`` is false) for row expansion."""
    if include is None:
        return F.array(F.lit("ALL"), values)
    return F.when(include, F.array(F.lit("ALL"), values)).otherwise(F.array(F.lit("ALL")))
