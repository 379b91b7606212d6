import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

from tidemark.functions import marks as M

from .conftest import SF01


def test_kind_of_every_supported_type():
    assert M.kind_of(TimestampType()) == "timestamp"
    assert M.kind_of(TimestampNTZType()) == "timestamp_ntz"
    assert M.kind_of(DateType()) == "date"
    assert M.kind_of(LongType()) == "bigint"
    assert M.kind_of(IntegerType()) == "int"
    assert M.kind_of(DecimalType(20, 0)) == "decimal"
    assert M.kind_of(StringType()) == "string"
    with pytest.raises(TypeError):
        M.kind_of(StructType([]))


def test_text_marks_date_only_and_datetime():
    m = M.coerce("2024-01-16", TimestampNTZType())
    assert m.value == dt.datetime(2024, 1, 16)
    m = M.coerce("2024-01-16 12:30:05.250000", TimestampNTZType())
    assert m.value == dt.datetime(2024, 1, 16, 12, 30, 5, 250000)
    with pytest.raises(ValueError):
        M.coerce("16/01/2024", TimestampNTZType())  # fails before any read, loudly


def test_numeric_marks_keep_sign_and_width():
    assert M.coerce(-5, LongType()).value == -5
    assert M.coerce(2**40, LongType()).value == 2**40
    assert M.coerce("-2147483649", LongType()).value == -2147483649
    with pytest.raises(ValueError):
        M.coerce(2**40, IntegerType())
    with pytest.raises(TypeError):
        M.coerce(True, IntegerType())  # a bool is not a number here


def test_decimal_mark_is_not_text():
    m = M.coerce("12345678901234567890", DecimalType(20, 0))
    assert m.kind == "decimal" and m.value == Decimal("12345678901234567890")


def test_timestamp_mark_is_an_instant():
    m = M.coerce("1970-01-01 00:00:01", TimestampType(), "UTC")
    assert m.value == 1_000_000
    m = M.coerce("1970-01-01 00:00:01", TimestampType(), "America/Chicago")
    assert m.value == 1_000_000 + 6 * 3600 * 1_000_000


def test_predicate_is_pushed_to_parquet(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    mark = M.coerce("2000-01-01", orders.schema["o_orderdate"].dataType)
    df = orders.where(M.after(["o_orderdate"], mark, orders.schema["o_orderdate"].dataType))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in plan
    assert df.count() == 3660


def test_ntz_mark_ignores_session_time_zone(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    dtype = orders.schema["o_orderdate"].dataType
    pred = M.after(["o_orderdate"], M.coerce("2000-01-01", dtype), dtype)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
        assert orders.where(pred).count() == 3660
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_timestamp_mark_pushdown_with_micros(spark):
    df = spark.range(5).select(F.timestamp_micros(F.col("id") * 1000).alias("ts"))
    mark = M.Mark("timestamp", 2000)
    assert df.where(M.after(["ts"], mark, TimestampType())).count() == 2


def test_batch_max_and_later():
    a, b = M.Mark("bigint", 5), M.Mark("bigint", 9)
    assert M.later(a, b) is b and M.later(b, a) is b and M.later(None, a) is a


def test_shift_back():
    m = M.Mark("timestamp_ntz", dt.datetime(2024, 1, 3))
    assert M.shift_back(m, dt.timedelta(days=2)).value == dt.datetime(2024, 1, 1)
    assert M.shift_back(M.Mark("bigint", 10), 3).value == 7
    with pytest.raises(TypeError):
        M.shift_back(M.Mark("string", "x"), 1)


row = st.tuples(
    st.one_of(st.none(), st.integers(-20, 20)),
    st.one_of(st.none(), st.integers(-20, 20)),
)


@settings(max_examples=20, deadline=None)
@given(rows=st.lists(row, min_size=0, max_size=12), mark=st.integers(-20, 20))
def test_or_predicate_equals_greatest_for_any_nulls(spark, rows, mark):
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    df = spark.createDataFrame(rows, schema)
    m = M.Mark("bigint", mark)
    by_or = sorted(df.where(M.after(["a", "b"], m, LongType())).collect(), key=repr)
    by_greatest = sorted(df.where(F.greatest("a", "b") > F.lit(mark)).collect(), key=repr)
    assert by_or == by_greatest
