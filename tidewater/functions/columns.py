"""Scalar Column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen and can be pushed down where Catalyst
allows.  Nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The course-popularity score bands (ratio strictly above the
# bound earns the score; checked in this order; anything else scores 0).
DEFAULT_BANDS: tuple[tuple[float, int], ...] = ((0.9, 10), (0.5, 4), (0.25, 2))


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band_score(ratio: ColumnOrName, bands: Sequence[tuple[float, int]] = DEFAULT_BANDS,
               default: int = 0) -> Column:
    """Ordered strict thresholds: first ``ratio > bound`` wins."""
    r = _c(ratio)
    expr = None
    for bound, score in bands:
        expr = (F.when(r > F.lit(bound), F.lit(score)) if expr is None
                else expr.when(r > F.lit(bound), F.lit(score)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def binary_label(c: ColumnOrName, threshold: float, when_true: int = 1, when_false: int = 0,
                 inclusive: bool = False) -> Column:
    """0/1 label.  A null input takes ``when_false`` (``null > x`` is not true)."""
    x = _c(c)
    cond = x >= F.lit(threshold) if inclusive else x > F.lit(threshold)
    return F.when(cond, F.lit(when_true)).otherwise(F.lit(when_false))


def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Double quotient; null where the denominator is 0 or null (never raises)."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def month_name(ts: ColumnOrName) -> Column:
    return F.date_format(_c(ts), "MMMM")


def month_number(ts: ColumnOrName) -> Column:
    return F.month(_c(ts))


def month_number_from_name(name: ColumnOrName) -> Column:
    """'March' -> 3, with the built-in parser rather than a UDF."""
    return F.month(F.to_date(_c(name), "MMMM"))


def split_field(c: ColumnOrName, sep: str, n: int) -> Column:
    """n-th (1-based) field of a string split on a literal separator."""
    return F.split_part(_c(c), F.lit(sep), F.lit(n))


def starts_with_any(c: ColumnOrName, prefixes: Iterable[str]) -> Column:
    x = _c(c)
    out = None
    for p in prefixes:
        t = x.startswith(p)
        out = t if out is None else (out | t)
    return out if out is not None else F.lit(False)


def round_half_up(c: ColumnOrName, digits: int) -> Column:
    return F.round(_c(c), digits)


def binary_to_string(c: ColumnOrName) -> Column:
    return _c(c).cast("string")


def pass_rule(grade: ColumnOrName, subject: ColumnOrName, strict_subject: str,
              strict_prefixes: Sequence[str] = ("A",),
              other_prefixes: Sequence[str] = ("A", "B", "C")) -> Column:
    """Two-argument pass rule: one subject needs a strict grade, others a wider one."""
    g = _c(grade)
    return (F.when(_c(subject) == F.lit(strict_subject), starts_with_any(g, strict_prefixes))
            .otherwise(starts_with_any(g, other_prefixes)))


def category_group(c: ColumnOrName, keep: Sequence[str], groups: dict[str, Sequence[str]],
                   other: str = "OTHER") -> Column:
    """Keep listed values, fold each group's members to the group name, rest -> other."""
    x = _c(c)
    expr = F.when(x.isin(list(keep)), x)
    for name, members in groups.items():
        expr = expr.when(x.isin(list(members)), F.lit(name))
    return expr.otherwise(F.lit(other))


_UTC_NAMES = {"UTC", "ETC/UTC", "GMT", "ETC/GMT", "Z", "+00:00", "UCT", "ZULU"}


def _session_is_utc() -> bool:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    return spark.conf.get("spark.sql.session.timeZone", "UTC").upper() in _UTC_NAMES


def ntz_to_instant(ts: ColumnOrName) -> Column:
    """timestamp_ntz wall clock (read as UTC) -> timestamp, in any session zone.

    In a UTC session this is a plain cast; otherwise the wall clock is moved
    from UTC to the session zone first, so the instant is the same.
    """
    if _session_is_utc():
        return _c(ts).cast("timestamp")
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _c(ts)).cast("timestamp")


def instant_to_ntz(ts: ColumnOrName) -> Column:
    """Inverse of :func:`ntz_to_instant`: timestamp -> its UTC wall clock as NTZ."""
    if _session_is_utc():
        return _c(ts).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(ts).cast("timestamp_ntz"))
