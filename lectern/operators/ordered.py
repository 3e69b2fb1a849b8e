"""Order-dependent work without putting one group, or the whole table, into one task.

Spark's window runs a partition key in a single task. Here the order is cut into
blocks, each block is reduced first (map-side), and only the block heads or totals
(one small row per block) meet in the second window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536
#: Blocks whose totals meet in one window.
FAN = 4_096
#: Values that are ranked together for a percentile.
RANKED_VALUES = 1_000_000
_BLOCK_COL = "__block"


def block_width(df: DataFrame, order: str, rows: int = BLOCK) -> int:
    """Order numbers per block so that a block has about `rows` rows, however far apart the numbers are."""
    low, high, count = df.agg(F.min(order), F.max(order), F.count(order)).first()
    return max(1, (high - low + 1) * rows // count) if count else rows


def running_totals(
    df: DataFrame,
    order: str,
    totals: dict[str, Column],
    group: Sequence[str] = (),
    inclusive: bool = True,
    width: int | None = None,
    fan: int = FAN,
) -> DataFrame:
    """Add running sums of the given expressions in `order` (an integer unique in the group).

    `width` order numbers are a block; left out, it follows from their density. `fan` blocks
    are summed in one window, and what lies before them in a second one over their totals.
    """
    width = width or block_width(df, order)
    keys = [*group, _BLOCK_COL]
    blocked = df.withColumn(_BLOCK_COL, F.floor(F.col(order) / width))
    for name, expr in totals.items():
        blocked = blocked.withColumn(f"__v_{name}", expr)
    sums = blocked.groupBy(*keys).agg(*[F.sum(f"__v_{n}").alias(f"__s_{n}") for n in totals])
    sums = sums.withColumn("__super", F.floor(F.col(_BLOCK_COL) / fan))
    upper = [*group, "__super"]
    before = Window.partitionBy(*group).orderBy("__super").rowsBetween(Window.unboundedPreceding, -1)
    supers = sums.groupBy(*upper).agg(*[F.sum(f"__s_{n}").alias(f"__t_{n}") for n in totals])
    supers = supers.select(
        *[F.col(k).alias(f"__u_{k}") for k in upper],
        *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in totals],
    )
    earlier = Window.partitionBy(*upper).orderBy(_BLOCK_COL).rowsBetween(Window.unboundedPreceding, -1)
    met = sums.join(supers, [F.col(k).eqNullSafe(F.col(f"__u_{k}")) for k in upper])
    offsets = met.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[(F.col(f"__b_{n}") + F.coalesce(F.sum(f"__s_{n}").over(earlier), F.lit(0))).alias(f"__o_{n}") for n in totals],
    )
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    last = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, last)
    joined = blocked.join(offsets, on)
    for n in totals:
        joined = joined.withColumn(
            n, F.col(f"__o_{n}") + F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0))
        )
    return joined.select(*df.columns, *totals)


def running_average(df: DataFrame, order: str, value: str, out: str, width: int | None = None) -> DataFrame:
    """Average of all rows up to and including the current one."""
    totals = {"__sum": F.col(value).cast("double"), "__n": F.when(F.col(value).isNotNull(), 1).otherwise(0)}
    run = running_totals(df, order, totals, width=width)
    return run.withColumn(out, F.col("__sum") / F.col("__n")).drop("__sum", "__n")


def next_in_group(
    df: DataFrame, group: Sequence[str], order: str, columns: Sequence[str], out: str, width: int | None = None
) -> DataFrame:
    """Add a struct of the next row's columns in the group (null on the last row)."""
    width = width or block_width(df, order)
    keys = [*group, _BLOCK_COL]
    blocked = df.withColumn(_BLOCK_COL, F.floor(F.col(order) / width))
    payload = F.struct(*columns)
    heads = blocked.groupBy(*keys).agg(F.min_by(payload, F.col(order)).alias("__head"))
    following = heads.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.lead("__head").over(Window.partitionBy(*group).orderBy(_BLOCK_COL)).alias("__next_head"),
    )
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    inside = F.lead(payload).over(Window.partitionBy(*keys).orderBy(order))
    return (
        blocked.join(following, on)
        .withColumn(out, F.coalesce(inside, F.col("__next_head")))
        .select(*df.columns, out)
    )


def narrowed(df: DataFrame, number: Column, lo: float, hi: float, pos: float, ranked: int, accuracy: int = 10_000) -> tuple[float, float]:
    """The bracket (lo, hi) made smaller around the rank `pos` of the whole column."""
    while True:
        below, inside = df.agg(F.count_if(number < lo), F.count_if(number.between(lo, hi))).first()
        if inside <= ranked or lo >= hi:
            return lo, hi
        slack = 2.0 / accuracy
        at = [(pos - below) / inside - slack, (pos + 1 - below) / inside + slack]
        at = [min(1.0, max(0.0, x)) for x in at]
        new = df.where(number.between(lo, hi)).agg(F.percentile_approx(number, at, accuracy)).first()[0]
        if (new[0], new[1]) == (lo, hi):
            return lo, hi
        lo, hi = new


def exact_percentiles(
    df: DataFrame, value: str, shares: Sequence[float], accuracy: int = 10_000, ranked: int = RANKED_VALUES
) -> DataFrame:
    """Interpolated percentiles of a numeric column: rows (share, value).

    Equal values are merged first. A sketch with a proven rank error brackets each share,
    and the values inside a bracket are sketched again until at most `ranked` rows are left
    in it (or it cannot shrink); only those are ranked, the rest is a count.
    """
    number = F.col(value).cast("double")
    slack = 2.0 / accuracy
    sketch = df.agg(
        F.percentile_approx(number, [max(0.0, s - slack) for s in shares], accuracy).alias("lo"),
        F.percentile_approx(number, [min(1.0, s + slack) for s in shares], accuracy).alias("hi"),
        F.count(value).alias("total"),
    ).first()
    total = sketch["total"]
    lows = sketch["lo"] or [None] * len(shares)
    highs = sketch["hi"] or [None] * len(shares)
    if total > ranked:
        pairs = [narrowed(df, number, lo, hi, float(s) * (total - 1), ranked, accuracy) for s, lo, hi in zip(shares, lows, highs)]
        lows, highs = [p[0] for p in pairs], [p[1] for p in pairs]
    return ranked_between(df, number, shares, list(zip(lows, highs)), total)


def ranked_between(df: DataFrame, number: Column, shares: Sequence[float], sides: Sequence[tuple], total: int) -> DataFrame:
    """Percentiles (share, value) by ranking the values inside each share's bracket (lo, hi); the rest is a count."""
    brackets = F.array(
        *[
            F.struct(
                F.lit(float(s)).alias("share"),
                F.lit(lo).cast("double").alias("lo"),
                F.lit(hi).cast("double").alias("hi"),
                F.lit(float(s) * (total - 1)).alias("pos"),
            )
            for s, (lo, hi) in zip(shares, sides)
        ]
    )
    counts = df.where(number.isNotNull()).groupBy(number.alias("v")).agg(F.count("*").alias("n"))
    tagged = counts.select("v", "n", F.explode(F.filter(brackets, lambda b: F.col("v") <= b["hi"])).alias("b"))
    # values below the bracket shrink to one count per share before the shuffle
    inside_value = F.when(F.col("v") >= F.col("b.lo"), F.col("v"))
    merged = tagged.groupBy(F.col("b.share"), F.col("b.pos"), inside_value.alias("v")).agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("share").orderBy(F.col("v").asc_nulls_first()))
    ranked = merged.withColumn("upto", upto).where(F.col("v").isNotNull())
    first = F.min(F.when(F.col("upto") > F.floor("pos"), F.col("v")))
    second = F.min(F.when(F.col("upto") > F.ceil("pos"), F.col("v")))
    fraction = F.first(F.col("pos") - F.floor("pos"))
    return ranked.groupBy("share").agg((first + (second - first) * fraction).alias("value"))
