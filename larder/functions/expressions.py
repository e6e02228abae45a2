"""Scalar column expressions (all JVM-side, whole-stage-codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c: str | Column) -> Column:
    """``try_cast(x AS int)``: trims spaces; decimals, exponents, blanks and
    overflow give NULL instead of failing under ANSI mode."""
    return _col(c).try_cast("int")


def lenient_long(c: str | Column) -> Column:
    """``try_cast(x AS bigint)``, for keys."""
    return _col(c).try_cast("bigint")


def first_match(pairs: Sequence[tuple[Column, object]], default: object) -> Column:
    """CASE chain: the first true condition wins, else ``default``.

    Built by folding the rule table, so the rule list is data, not code.
    A NULL condition counts as false, exactly like SQL CASE.
    """
    if not pairs:
        return F.lit(default)
    (cond0, val0), rest = pairs[0], pairs[1:]
    chain = reduce(lambda acc, cv: acc.when(cv[0], cv[1]), rest, F.when(cond0, val0))
    return chain.otherwise(default)


def substring_rule(text: str | Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First-match literal substring rules on ``lower(text)``."""
    low = F.lower(_col(text))
    return first_match([(low.contains(needle), label) for needle, label in rules], default)


def regex_rule(text: str | Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First-match unanchored regex rules on ``lower(text)``."""
    low = F.lower(_col(text))
    return first_match([(low.rlike(pattern), label) for pattern, label in rules], default)


def guarded_ratio(num: str | Column, den: str | Column, fallback: object) -> Column:
    """``num / den`` when ``den > 0``, else ``fallback`` (0, NULL or a sentinel)."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, n / d).otherwise(F.lit(fallback))
