import ast
import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlift.functions import arithmetic as A
from ledgerlift.functions import normalize as N


def column(df, name):
    return [r[name] for r in df.collect()]


def test_ids_in_every_form_agree(spark):
    raw = spark.createDataFrame([(bytearray(b"\x12\xab"), r"b'\x12\xab'"), (None, "12ab"), (None, None)], "a binary, b string")
    out = N.normalize_ids(raw, ("a", "b", "absent"))
    assert column(out, "a") == ["12ab", None, None]
    assert column(out, "b") == ["12ab", "12ab", None]
    assert N.normalize_ids(out, ("a", "b")).collect() == out.collect()


def test_numeric_ids_become_text(spark):
    raw = spark.createDataFrame([(7, 1.5), (8, float("nan"))], "a bigint, b double")
    out = N.normalize_ids(raw, ("a", "b"))
    assert column(out, "a") == ["7", "8"]
    assert column(out, "b") == ["1.5", None]


@pytest.mark.parametrize(
    "text",
    ["b'", "b''", r"b'\x1'", r"b'\xzz'", "b'a'b'", "b'é'", "b'\\é'", "b'a\nb'", 'b"ab"', r"b'abc\'", r"b'\400'", r"b'\d\0\07\1234'",
     "b'line\\\nnext'", r"b'\a\b\f\n\r\t\v\'\"\\'", "xb'a'", "b'tab\there'"],
)
def test_byte_literals_as_python_reads_them(spark, text):
    expected = text
    if text.startswith("b'") and text.endswith("'"):
        try:
            expected = ast.literal_eval(text).hex()
        except (SyntaxError, ValueError):
            pass
    raw = spark.createDataFrame([(text,)], "a string")
    assert column(N.normalize_ids(raw, ("a",)), "a") == [expected]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=200))
def test_byte_literals_round_trip(spark, values):
    literals = [(v.hex(), repr(v)) for v in values if repr(v).startswith("b'")]
    raw = spark.createDataFrame(literals or [("", "b''")], "h string, a string")
    out = N.normalize_ids(raw, ("a",)).where("a <> h")
    assert out.collect() == []


def test_text_is_utf8_or_latin1(spark):
    raw = spark.createDataFrame([(bytearray(b"\xc3\xa9"), "é"), (bytearray(b"\xe9"), "x"), (None, None)], "a binary, b string")
    out = N.normalize_text(raw, ("a", "b"))
    assert column(out, "a") == ["é", "é", None]
    assert column(out, "b") == ["é", "x", None]


def test_dates(spark):
    raw = spark.createDataFrame(
        [("2024-01-02 03:04:05.000006", dt.date(2024, 1, 2), 1), ("05/02/2024", None, 2), ("junk", None, 3), (None, None, 4)],
        "s string, d date, n int",
    )
    out = N.normalize_dates(raw, ("s", "d", "n"), ("dd/MM/yyyy",))
    assert column(out, "s") == [dt.datetime(2024, 1, 2, 3, 4, 5, 6), dt.datetime(2024, 2, 5), None, None]
    assert column(out, "d") == [dt.datetime(2024, 1, 2), None, None, None]
    assert column(out, "n") == [dt.datetime(1970, 1, 1)] * 4  # whole numbers are nanoseconds


def test_dates_as_numbers_and_with_zones(spark):
    raw = spark.createDataFrame(
        [(1704164645000006999, 1704164645000006000.0, "2024-01-01T00:00:00+05:00"), (-1, float("nan"), "2024-01-01T00:00:00Z"), (None, None, "2024-01-01 00:00:00-02")],
        "n bigint, f double, s string",
    )
    out = N.normalize_dates(raw, ("n", "f", "s"))
    assert column(out, "n") == [dt.datetime(2024, 1, 2, 3, 4, 5, 6), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), None]
    assert abs(column(out, "f")[0] - dt.datetime(2024, 1, 2, 3, 4, 5, 6)) < dt.timedelta(milliseconds=1) and column(out, "f")[1:] == [None, None]
    assert column(out, "s")[:2] == [dt.datetime(2023, 12, 31, 19), dt.datetime(2024, 1, 1)]
    with pytest.raises(TypeError):
        N.normalize_dates(spark.createDataFrame([(True,)], "b boolean"), ("b",))


def test_random_byte_literals(spark):
    rnd = random.Random(4)
    pieces = ["a", "B ", "\\x0a", "\\xFF", "\\x5c", "\\n", "\\\\", "\\'", "\\0", "\\101", "~"]
    texts = ["b'" + "".join(rnd.choice(pieces[: rnd.choice([2, 4, 11])]) for _ in range(rnd.randrange(6))) + "'" for _ in range(400)]
    texts += ["b'" + "\\x12" * n + "'" for n in (0, 1, 5000)]
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, a string")
    got = {r.i: r.a for r in N.normalize_ids(raw, ("a",)).collect()}
    assert [got[i] for i in range(len(texts))] == [ast.literal_eval(t).hex() for t in texts]


def test_amounts(spark):
    raw = spark.createDataFrame([("12.5",), ("x",), ("12d",), ("1e3",), ("nan",), (None,), (" 7 ",), ("-.5",)], "a string")
    assert column(raw.select(N.amount(F.col("a"), raw.schema["a"].dataType).alias("a")), "a") == [12.5, 0, 0, 1000, 0, 0, 7, -0.5]
    raw = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "a double")
    assert column(raw.select(N.amount(F.col("a"), raw.schema["a"].dataType).alias("a")), "a") == [1.5, 0, 0]


def test_cast_is_all_or_nothing(spark):
    rows = [("1", "1", "1.5", "12a", "1d"), ("2", "x", "2", "34", "2"), (None, "3", None, None, None)]
    raw = spark.createDataFrame(rows, "a string, b string, c string, d string, e string")
    out = N.numeric_or_keep(raw, ("a", "b", "c", "d", "e"))
    assert dict(out.dtypes) == {"a": "bigint", "b": "string", "c": "double", "d": "string", "e": "string"}
    assert column(out, "a") == [1, 2, None]


def test_whole_days_floor(spark):
    late, early = dt.datetime(2024, 1, 2, 1), dt.datetime(2024, 1, 1, 23)
    df = spark.createDataFrame([(late, early), (late, late), (None, late)], "a timestamp_ntz, b timestamp_ntz")
    assert column(df.select(A.whole_days(F.col("a"), F.col("b")).alias("d")), "d") == [0, 0, None]
    assert column(df.select(A.whole_days(F.col("b"), F.col("a")).alias("d")), "d") == [-1, 0, None]


def test_ratio_and_clip(spark):
    df = spark.createDataFrame([(6.0, 3.0), (500.0, 0.0), (-1.0, 2.0)], "a double, b double")
    ratio = A.guarded_ratio(F.col("a"), F.col("b"))
    assert column(df.select(ratio.alias("r")), "r") == [2.0, 500.0, -0.5]
    assert column(df.select(A.clip(ratio, 0.0, 10.0).alias("r")), "r") == [2.0, 10.0, 0.0]


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 33.33] * 500
    df = spark.createDataFrame([(v,) for v in values], "a double")
    totals = {df.repartition(n).agg(A.exact_sum(F.col("a")).alias("s")).first()["s"] for n in (1, 3, 7)}
    assert totals == {16965.0}
