"""Array-column helpers (FN-13..20).

The reference works on driver-local Scala arrays; here the same operations are
higher-order functions on ``ArrayType`` columns, evaluated per row on executors.
Arrays come from :func:`ordered_list` over a bounded group (one row per key and
week), so their length is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .util import as_col


def ordered_list(value, order) -> Column:
    """Aggregate: the group's ``value``s ordered by ``order`` (deterministic)."""
    pairs = F.sort_array(F.collect_list(F.struct(as_col(order).alias("o"), as_col(value).alias("v"))))
    return F.transform(pairs, lambda p: p["v"])


def keep_last_digit_zero(arr) -> Column:
    """FN-13 + FN-8: keep elements whose last character is ``0`` (case-insensitive test)."""
    return F.filter(as_col(arr), lambda x: F.lower(F.right(x.cast("string"), F.lit(1))) == F.lit("0"))


def discounted(arr, rate: float) -> Column:
    """FN-14: ``x - x * rate`` for every element."""
    return F.transform(as_col(arr), lambda x: x - x * F.lit(rate))


def fold_concat(arr, sep: str = "") -> Column:
    """FN-15: left fold with string concatenation, ``sep`` between the elements."""
    merge = (lambda acc, x: F.concat(acc, F.lit(sep), x)) if sep else (lambda acc, x: F.concat(acc, x))
    a = as_col(arr)
    first = F.coalesce(F.try_element_at(a, F.lit(1)), F.lit(""))
    return F.aggregate(F.slice(a, 2, F.greatest(F.size(a), F.lit(1))), first, merge)


def reduce_sum(arr) -> Column:
    """FN-16 / AGG-14: ``reduce(_ + _)`` as a fold from 0."""
    return F.aggregate(as_col(arr), F.lit(0.0), lambda a, b: a + b)


def fold(arr, zero, op) -> Column:
    """AGG-14: fold with any binary operator, e.g. ``fold(a, F.lit(1.0), lambda x, y: x * y)``."""
    return F.aggregate(as_col(arr), zero, op)


def reduce_product(arr) -> Column:
    """AGG-14: ``reduce(_ * _)`` (the reference's note: use reduce for ``*`` and ``/``)."""
    return fold(arr, F.lit(1.0), lambda a, b: a * b)


def reduce_max(arr) -> Column:
    """AGG-14 with another operator: ``reduce(max)``; NULL for an empty array."""
    a = as_col(arr)
    return F.aggregate(a, F.try_element_at(a, F.lit(1)), lambda x, y: F.greatest(x, y))


def _mean_between(arr: Column, low: Column, high: Column) -> Column:
    """Mean of the elements at the 0-based positions ``low`` to ``high``."""
    part = F.slice(arr, low + 1, high - low + 1)
    return F.aggregate(part, F.lit(0.0), lambda s, x: s + x) / F.size(part)


def edged_means(arr, h: int) -> Column:
    """FN-18: means over ``[p - h, p + h]`` as three joined arrays of which the last is
    built from the end and reversed (``pre ++ inner ++ post.reverse``).

    ``pre`` has the first ``h`` positions, whose range is cut at the start; ``post``
    counts back from the last position, its ranges cut at the end; arrays of fewer than
    ``2 h`` elements have an empty ``inner`` and a shorter ``post``.
    """
    a = as_col(arr)
    n = F.size(a)
    last = n - 1
    n_pre = F.least(n, F.lit(h))
    n_post = F.greatest(F.least(n - n_pre, F.lit(h)), F.lit(0))

    def positions(count: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: i < count)

    pre = F.transform(positions(n_pre), lambda p: _mean_between(
        a, F.lit(0), F.least(p + h, last)))
    inner = F.transform(positions(n - n_pre - n_post), lambda i: _mean_between(
        a, i + n_pre - h, i + n_pre + h))
    post = F.transform(positions(n_post), lambda back: _mean_between(
        a, F.greatest(last - back - h, F.lit(0)), last))
    return F.concat(pre, inner, F.reverse(post))


def zipped(**arrays) -> Column:
    """FN-18: arrays zipped position by position into structs with the given names."""
    return F.arrays_zip(*[as_col(c).alias(name) for name, c in arrays.items()])


def as_set_contains(arr, value) -> Column:
    """FN-19: set membership on the de-duplicated array."""
    return F.array_contains(F.array_distinct(as_col(arr)), value)


def join_split(arr, sep: str = ",") -> Column:
    """FN-20: ``mkString(sep).split(sep)`` round trip."""
    return F.split(F.array_join(as_col(arr), sep), sep)
