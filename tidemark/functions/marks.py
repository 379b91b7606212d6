"""Typed high-water marks.

A mark is the largest value of the watermark column(s) already copied. It is bound to the
Spark type of the column: the predicate compares the column with a literal of exactly that
type, so Catalyst pushes it to the Parquet scan or renders it in the JDBC dialect, and the
value keeps full precision (microseconds, decimals, 64-bit integers).

Canonical Python value per kind:

==============  ====================================================
kind            value
==============  ====================================================
timestamp       ``int`` microseconds since the epoch (an instant)
timestamp_ntz   naive ``datetime`` (wall clock, no zone)
date            ``date``
bigint, int     ``int``
decimal         ``Decimal``
string          ``str``
==============  ====================================================
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, replace
from decimal import Context, Decimal, InvalidOperation
from functools import reduce
from typing import Any, Iterable, Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

KINDS = ("timestamp", "timestamp_ntz", "date", "bigint", "int", "decimal", "string")

# Text shapes recognised for marks given as text.
DATE_TEXT = re.compile(r"^\d{4}-\d{2}-\d{2}$")
DATETIME_TEXT = re.compile(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$")

# Decimal columns have up to 38 digits.
EXACT = Context(prec=100)

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


@dataclass(frozen=True)
class Mark:
    """A high-water mark: its kind and canonical value."""

    kind: str
    value: Any

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unsupported mark kind {self.kind!r}; expected one of {KINDS}")

    def text(self) -> str:
        """Full-precision text form (for run history and reports)."""
        if self.kind == "timestamp":
            return micros_to_utc(self.value).isoformat(sep=" ")
        if isinstance(self.value, (dt.datetime, dt.date)):
            return self.value.isoformat(sep=" ") if isinstance(self.value, dt.datetime) else self.value.isoformat()
        return str(self.value)


    def exact_text(self) -> str:
        """Text that :func:`from_text` reads back to an equal mark."""
        return str(self.value) if self.kind != "timestamp_ntz" and self.kind != "date" else self.value.isoformat()


def from_text(kind: str, text: str) -> Mark:
    """The mark that ``exact_text`` wrote."""
    read = {"timestamp": int, "bigint": int, "int": int, "decimal": Decimal, "date": dt.date.fromisoformat,
            "timestamp_ntz": dt.datetime.fromisoformat, "string": str}
    return Mark(kind, read[kind](text))


def kind_of(dtype: DataType) -> str:
    """Mark kind for a Spark column type; raises for types that cannot carry a mark."""
    if isinstance(dtype, TimestampNTZType):
        return "timestamp_ntz"
    if isinstance(dtype, TimestampType):
        return "timestamp"
    if isinstance(dtype, DateType):
        return "date"
    if isinstance(dtype, LongType):
        return "bigint"
    if isinstance(dtype, (IntegerType, ShortType, ByteType)):
        return "int"
    if isinstance(dtype, DecimalType):
        return "decimal"
    if isinstance(dtype, StringType):
        return "string"
    raise TypeError(f"watermark column type {dtype.simpleString()} is not supported")


def mark_type(schema: StructType, columns: Sequence[str]) -> DataType:
    """The common Spark type of the watermark columns (all must share one kind)."""
    fields = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in columns if c not in fields]
    if missing:
        raise ValueError(f"watermark columns not in source: {missing}")
    types = [fields[c] for c in columns]
    kinds = {kind_of(t) for t in types}
    if len(kinds) != 1:
        raise TypeError(f"watermark columns {list(columns)} mix kinds {sorted(kinds)}")
    if isinstance(types[0], DecimalType):
        scale = max(t.scale for t in types)
        whole = max(t.precision - t.scale for t in types)
        return DecimalType(min(38, whole + scale), scale)
    if kinds == {"int"}:
        return IntegerType()
    return types[0]


def micros_to_utc(micros: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(microseconds=micros)


def coerce(value: Any, dtype: DataType, session_tz: str = "UTC") -> Mark:
    """Turn a user-supplied value (or text) into a mark of the column's kind.

    Text for timestamps: ``YYYY-MM-DD`` means midnight, ``YYYY-MM-DD HH:MM:SS[.ffffff]`` is
    taken as is; for ``timestamp`` (with zone) the wall clock is read in the session time
    zone, as ``CAST(text AS TIMESTAMP)`` does. Anything else fails here, before any read.
    """
    kind = kind_of(dtype)
    if isinstance(value, Mark):
        if value.kind != kind:
            raise TypeError(f"mark of kind {value.kind} cannot filter a {kind} column")
        return value
    if value is None:
        raise ValueError("mark value is None")
    if kind in ("timestamp", "timestamp_ntz"):
        if isinstance(value, str):
            value = _parse_datetime_text(value)
        elif isinstance(value, dt.datetime):
            pass
        elif isinstance(value, dt.date):
            value = dt.datetime(value.year, value.month, value.day)
        else:
            raise TypeError(f"cannot use {value!r} as a {kind} mark")
        if kind == "timestamp_ntz":
            return Mark(kind, value.replace(tzinfo=None) if value.tzinfo is None else value.astimezone(dt.timezone.utc).replace(tzinfo=None))
        if value.tzinfo is None:
            value = value.replace(tzinfo=ZoneInfo(session_tz))
        delta = value - _EPOCH
        return Mark(kind, (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds)
    if kind == "date":
        if isinstance(value, str):
            if not DATE_TEXT.match(value.strip()):
                raise ValueError(f"date mark text {value!r} is not YYYY-MM-DD")
            value = dt.date.fromisoformat(value.strip())
        elif isinstance(value, dt.datetime):
            value = value.date()
        if not isinstance(value, dt.date):
            raise TypeError(f"cannot use {value!r} as a date mark")
        return Mark(kind, value)
    if kind in ("bigint", "int"):
        if isinstance(value, bool):
            raise TypeError("a boolean is not a numeric mark")
        try:
            number = int(value.strip()) if isinstance(value, str) else int(value)
        except (TypeError, ValueError) as exc:
            raise ValueError(f"cannot use {value!r} as a {kind} mark") from exc
        if isinstance(value, (float, Decimal)) and number != value:
            raise ValueError(f"{value!r} is not an integral mark")
        limit = 2**63 if kind == "bigint" else 2**31
        if not -limit <= number < limit:
            raise ValueError(f"{number} does not fit a {kind} column")
        return Mark(kind, number)
    if kind == "decimal":
        try:
            number = Decimal(value.strip()) if isinstance(value, str) else Decimal(value)
        except (InvalidOperation, TypeError, ValueError) as exc:
            raise ValueError(f"cannot use {value!r} as a decimal mark") from exc
        if not number.is_finite():
            raise ValueError(f"{value!r} is not a finite decimal")
        return Mark(kind, number)
    return Mark(kind, str(value))


def _parse_datetime_text(text: str) -> dt.datetime:
    text = text.strip()
    if DATE_TEXT.match(text):
        return dt.datetime.fromisoformat(text + " 00:00:00")
    if DATETIME_TEXT.match(text):
        return dt.datetime.fromisoformat(text.replace("T", " "))
    raise ValueError(f"timestamp mark text {text!r} is neither YYYY-MM-DD nor YYYY-MM-DD HH:MM:SS[.ffffff]")


def literal(mark: Mark, dtype: DataType) -> Column:
    """A literal of exactly ``dtype`` holding the mark (foldable, so it is pushed down)."""
    if mark.kind == "timestamp":
        return F.timestamp_micros(F.lit(mark.value))
    if mark.kind == "timestamp_ntz":
        return F.lit(mark.value.isoformat(sep=" ")).cast("timestamp_ntz")
    if mark.kind == "date":
        return F.lit(mark.value.isoformat()).cast("date")
    if mark.kind in ("bigint", "int"):
        return F.lit(mark.value).cast(dtype)
    if mark.kind == "decimal":
        # Of exactly the mark's scale: rounded to the column's scale it could pass or skip a row.
        scale = max(dtype.scale, -mark.value.as_tuple().exponent, 0)
        return F.lit(format(mark.value, "f")).cast(DecimalType(min(38, dtype.precision - dtype.scale + scale), min(scale, 38)))
    return F.lit(mark.value)


@dataclass(frozen=True)
class Window:
    """What a mark predicate says, for stores that ask their database in its own words. Without a mark: any column is not NULL.
    With ``upto``, no column is beyond it."""

    columns: tuple[str, ...]
    mark: Mark | None
    inclusive: bool = False
    upto: Mark | None = None


def _known(predicate: Column, window: Window) -> Column:
    predicate.mark_window = window
    return predicate


def window_of(predicate: Column | None) -> Window | None:
    """The window of a predicate made by :func:`after` or :func:`any_not_null`, and of no other."""
    return getattr(predicate, "mark_window", None) if predicate is not None else None


def after(columns: Sequence[str], mark: Mark, dtype: DataType, inclusive: bool = False) -> Column:
    """Rows beyond the mark: ``c1 > m OR c2 > m ...`` (``>=`` when inclusive).

    The OR form is what both Parquet and JDBC pushdown understand; it selects the same rows
    as ``greatest(c1, c2, ...) > m`` for every NULL pattern, because ``greatest`` skips NULLs.
    """
    bound = literal(mark, dtype)
    tests = [(F.col(c) >= bound) if inclusive else (F.col(c) > bound) for c in columns]
    return _known(reduce(lambda a, b: a | b, tests), Window(tuple(columns), mark, inclusive))


def any_not_null(columns: Iterable[str]) -> Column:
    """First run, no mark yet: every row with at least one non-NULL watermark column."""
    columns = tuple(columns)
    return _known(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns]), Window(columns, None))


def not_beyond(predicate: Column, cut: Mark, dtype: DataType) -> Column:
    """A predicate made by :func:`after` or :func:`any_not_null` with an upper end: rows whose ``greatest`` mark is at most ``cut``."""
    window, bound = window_of(predicate), literal(cut, dtype)
    tests = [(F.col(c) <= bound) | F.col(c).isNull() if len(window.columns) > 1 else F.col(c) <= bound for c in window.columns]
    return _known(reduce(lambda a, b: a & b, tests, predicate), replace(window, upto=cut))


def batch_max(columns: Sequence[str], dtype: DataType) -> Column:
    """Aggregate for the new mark, ``max(greatest(...))``, in a form Python reads exactly.

    Instants travel as epoch microseconds so no time-zone conversion touches them.
    """
    value = F.col(columns[0]) if len(columns) == 1 else F.greatest(*[F.col(c) for c in columns])
    value = value.cast(dtype)
    if isinstance(dtype, TimestampType) and not isinstance(dtype, TimestampNTZType):
        return F.unix_micros(F.max(value))
    return F.max(value)


def from_observed(value: Any, dtype: DataType) -> Mark | None:
    """Mark from the value ``batch_max`` produced (``None`` for an empty batch)."""
    if value is None:
        return None
    kind = kind_of(dtype)
    if kind == "decimal":
        value = Decimal(value)
    return Mark(kind, value)


def later(a: Mark | None, b: Mark | None) -> Mark | None:
    """The larger of two marks: a mark never moves backwards."""
    if a is None:
        return b
    if b is None:
        return a
    return a if a.value >= b.value else b


def shift_back(mark: Mark, lookback: Any) -> Mark:
    """``mark - lookback``: a ``timedelta`` for time kinds, a number for numeric kinds."""
    if lookback is None:
        return mark
    if mark.kind == "timestamp":
        if not isinstance(lookback, dt.timedelta):
            raise TypeError("lookback for a timestamp mark must be a timedelta")
        micros = (lookback.days * 86_400 + lookback.seconds) * 1_000_000 + lookback.microseconds
        return Mark(mark.kind, mark.value - micros)
    if mark.kind in ("timestamp_ntz", "date"):
        if not isinstance(lookback, dt.timedelta):
            raise TypeError(f"lookback for a {mark.kind} mark must be a timedelta")
        if mark.kind == "date" and lookback % dt.timedelta(days=1):
            raise ValueError(f"lookback {lookback} for a date mark is not a whole number of days")
        return Mark(mark.kind, mark.value - lookback)
    if mark.kind in ("bigint", "int", "decimal"):
        if isinstance(lookback, dt.timedelta):
            raise TypeError(f"lookback for a {mark.kind} mark must be a number")
        if mark.kind == "decimal":
            return Mark(mark.kind, EXACT.subtract(mark.value, Decimal(str(lookback))))
        if int(lookback) != lookback:
            raise ValueError(f"lookback {lookback!r} for a {mark.kind} mark is not a whole number")
        return Mark(mark.kind, mark.value - int(lookback))
    raise TypeError("a string mark has no lookback")
