import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tuneprep.functions import text
from tuneprep.operators import mapping
from tuneprep.plans import instruction

ODD = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"
NOT_SPACE = "\u200b\u180e\ufeff\x00ab\u00e9\U0001f600"


def expected(value):
    return "\n".join(line.rstrip() for line in value.strip().splitlines()).strip()


def normalized(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    rows = df.select("i", text.normalize_text(F.col("t")).alias("t")).collect()
    return [r["t"] for r in sorted(rows)]


def test_character_sets_are_those_of_python():
    every = [chr(c) for c in range(0x110000)]
    assert set(text.WHITESPACE_CHARS) == {c for c in every if c.isspace()}
    assert set(text.LINE_BREAK_CHARS) == {c for c in every if len(f"a{c}b".splitlines()) > 1}
    assert not set(text.BLANK_CHARS) & set(text.LINE_BREAK_CHARS)


@pytest.mark.parametrize(
    "value",
    [
        "", "   ", "\xa0a\u3000", "a \r\nb", "a\x1cb", "a\u2028b", "a\n\n\nb", "a\n   b ",
        "\u200ba", "a\r\r\nb", "a \n", "\n a", "x" + " " * 5000 + "y", "a\r", "a \x1f\n b",
    ],
)
def test_normalize_edges(spark, value):
    assert normalized(spark, [value]) == [expected(value)]


def test_normalize_random_strings(spark):
    rng = random.Random(7)
    values = ["".join(rng.choices(ODD + NOT_SPACE, k=rng.randint(0, 14))) for _ in range(5000)]
    assert normalized(spark, values) == [expected(v) for v in values]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00")), max_size=40))
def test_normalize_property(spark, values):
    assert normalized(spark, values) == [expected(v) for v in values]


def test_normalize_null_stays_null(spark):
    assert normalized(spark, [None]) == [None]


def test_has_text_agrees_with_normalisation(spark):
    rng = random.Random(3)
    values = ["".join(rng.choices(ODD + "a", k=rng.randint(0, 3))) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    assert (
        df.filter(text.has_text(F.col("t")) != (text.normalize_text(F.col("t")) != "")).count() == 0
    )


def test_stringify_like_python(spark):
    df = spark.createDataFrame([(1, True, "x", None)], "n bigint, b boolean, s string, z int")
    row = df.select(*[text.stringify(df, c).alias(c) for c in df.columns]).first()
    assert tuple(row) == (str(1), str(True), "x", None)


@pytest.mark.parametrize("kind", ["array<int>", "binary", "map<string,int>", "interval day to second"])
def test_stringify_rejects_what_spark_writes_differently(spark, kind):
    df = spark.createDataFrame([], f"v {kind}")
    with pytest.raises(ValueError, match="'v'"):
        text.stringify(df, "v")


@pytest.mark.parametrize(
    "template",
    ["{a}", "{{x}} {a}-{b}", "no field", "", "{a}{a}\n", instruction.ROLE_TAG_TEMPLATE.replace(
        "prompt", "a").replace("response", "b"), "}}{{{b}"],
)
def test_template_like_str_format(spark, template):
    rows = [("{b} braces {{}}", "B"), ("x", None), ("%s\\n", "{")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    got = mapping.format_template(df, template, "a", "i").orderBy("i").collect()
    assert [r["a"] for r in got] == [template.format(a=a, b=b) for a, b in rows]


def test_template_errors(spark):
    df = spark.createDataFrame([(1, "x")], "i int, a string")
    with pytest.raises(KeyError):
        mapping.format_template(df, "{missing}", "out", "i")
    for bad in ("{a:>5}", "{a!r}", "{a.b}", "{a[0]}", "{}", "{0}"):
        with pytest.raises(ValueError):
            mapping.format_template(df, bad, "out", "i")
    with pytest.raises(ValueError, match="collides"):
        mapping.format_template(df, "{a}", "i", "i")


def test_template_prunes_unused_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x", "y")], "i int, a string, b string").write.parquet(path)
    out = mapping.format_template(spark.read.parquet(path), "<{a}>", "a", "i")
    from conftest import executed_plan

    assert "ReadSchema: struct<i:int,a:string>" in executed_plan(out)


def test_stringify_is_str(spark):
    import datetime
    import decimal
    import random

    from tuneprep.operators.mapping import map_columns

    rng = random.Random(3)
    doubles = [0.0, -0.0, 1e16, 1e15, 123456789.125, 1e-4, 1e-5, 5e-324, 1.7976931348623157e308, 2e-3, 0.1 + 0.2, 2.0**-44, 1e23, float("inf"), float("-inf"), float("nan"), None]
    doubles += [rng.uniform(-1, 1) * 10 ** rng.randrange(-30, 30) for _ in range(400)]
    stamps = [datetime.datetime(2024, 2, 29, 23, 59, 59, us) for us in (0, 1, 500000, 120000, 999999)]
    stamps += [datetime.datetime(1, 1, 1), datetime.datetime(1999, 12, 31, 0, 0, 0, 10), None]
    decimals = [decimal.Decimal(x).quantize(decimal.Decimal("1e-9")) for x in ("0", "1.5", "-0.000000001", "0.000000123", "0.000001", "-0.0000009", "123456.789", "0.0000010")]
    rows = []
    for i, x in enumerate(doubles):
        stamp, number = stamps[i % len(stamps)], decimals[i % len(decimals)]
        rows.append((i, x, x, stamp, stamp and stamp.date(), number, number.quantize(decimal.Decimal("0.01"))))
    df = spark.createDataFrame(rows, "i int, d double, f float, t timestamp_ntz, day date, n decimal(20,9), m decimal(20,2)")
    cols = ["d", "f", "t", "day", "n", "m"]
    got = map_columns(df, {f"{c}_text": c for c in cols}, "i").collect()
    source = {r["i"]: r for r in df.collect()}
    for r in got:
        for c in cols:
            value = source[r["i"]][c]
            assert r[f"{c}_text"] == (None if value is None else str(value)), (c, value)
    utc = spark.createDataFrame([(1, datetime.datetime(2020, 5, 17, 1, 2, 3, 40))], "i int, t timestamp")
    assert map_columns(utc, {"x": "t"}, "i").first()["x"] == str(utc.first()["t"])
    with pytest.raises(ValueError, match="cast it to string"):
        map_columns(spark.createDataFrame([(1, [1])], "i int, a array<int>"), {"x": "a"}, "i")
