"""Vector expressions on ARRAY columns, in double precision."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.constants import KEYWORDS
from lectern.functions.text import _col


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it many times in `body`.

    Expressions repeated inside lambda functions are not shared by the optimizer.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column | str) -> Column:
    squares = F.aggregate(_col(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def l2_normalize(v: Column | str) -> Column:
    """Unit length; a zero vector stays zero."""

    def scaled(w: Column) -> Column:
        return bind(
            norm(w),
            lambda length: F.transform(
                w, lambda x: F.when(length == 0, x.cast("double")).otherwise(x.cast("double") / length)
            ),
        )

    return bind(_col(v), scaled)


def cosine(a: Column | str, b: Column | str) -> Column:
    def of(pair: Column) -> Column:
        return bind(
            norm(pair["a"]) * norm(pair["b"]),
            lambda scale: F.when(scale == 0, F.lit(0.0)).otherwise(dot(pair["a"], pair["b"]) / scale),
        )

    return bind(F.struct(_col(a).alias("a"), _col(b).alias("b")), of)


def keyword_vector(text: Column | str, keywords: Sequence[str] = KEYWORDS) -> Column:
    """One dimension per keyword, 1 where the lowercase text contains it, then unit length.

    All hits weigh the same, so the length follows from their number alone.
    """

    def hits(lowered: Column) -> Column:
        return F.array(*[F.when(lowered.contains(k), F.lit(1.0)).otherwise(F.lit(0.0)) for k in keywords])

    def scaled(h: Column) -> Column:
        count = F.aggregate(h, F.lit(0.0), lambda acc, x: acc + x)
        # 1 / sqrt(count), or 0 when no keyword occurs
        return bind(
            F.when(count == 0, F.lit(0.0)).otherwise(F.lit(1.0) / F.sqrt(count)),
            lambda weight: F.transform(h, lambda x: x * weight),
        )

    return bind(F.lower(_col(text)), lambda lowered: bind(hits(lowered), scaled))
