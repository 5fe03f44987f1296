import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.functions import text


def values(spark, column, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def cleaned(value):
    flat = re.sub("[\n\r\t]", " ", "null" if value is None else value)
    flat = flat.strip("".join(chr(c) for c in range(0x21)))
    return None if flat == "null" else flat


def test_clean_text_edges(spark):
    rows = ["\ta\n b\r", "\x01a\x01", "null", " null\n", "", "  ", None, "nullx", "a  ", " a"]
    found = values(spark, text.clean_text, rows)
    assert found == [cleaned(r) for r in rows]
    assert found[:7] == ["a  b", "a", None, None, "", "", None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="a \t\n\r\x00\x1f\x7fnul é", max_size=12), min_size=50, max_size=100))
def test_clean_text_property(spark, rows):
    assert values(spark, text.clean_text, rows) == [cleaned(r) for r in rows]


def scrubbed(raw):
    for pattern, to in [
        (r"t\$(date|full|conf|user)", r"t_\1"), (r"T\$(DATE|FULL|CONF|USER)", r"T_\1"),
        (r"[tT]\$", ""), (r"\$", "_"), ("[\n\r\t]", ""), (r':" *(\S+?) *"', r':"\1"'), (':""', ':"null"'),
    ]:
        raw = re.sub(pattern, to, raw, flags=re.ASCII)
    return raw


def test_scrub_edges(spark):
    rows = [
        '{"t$date":" x ","T$DATE":"","t$amt":"a b","a$b":"\n"}', "t$t$date", "T$date t$DATE", "tt$full$",
        '{"a":"   ","b":"c "}',
    ]
    assert values(spark, text.scrub_json_text, rows) == [scrubbed(r) for r in rows]


@settings(max_examples=5, deadline=None)
@given(st.lists(
    st.lists(st.sampled_from(["t$", "T$", "date", "DATE", "full", "$", ':"', '"', " ", "\n", "x", ":"]), max_size=14)
    .map("".join), min_size=50, max_size=100))
def test_scrub_property(spark, rows):
    assert values(spark, text.scrub_json_text, rows) == [scrubbed(r) for r in rows]


def test_codes(spark):
    df = spark.createDataFrame([("norm",), ("NORM ",), ("norm  ",), (None,)], "shiftcode string")
    assert [r[0] for r in text.normalize_code(df).collect()] == ["NORM", "NORM", "NORM  ", None]
    other = spark.createDataFrame([("norm ",)], "code string")
    assert text.normalize_code(other).first()[0] == "norm "


def test_only_string_columns_are_cleaned(spark):
    df = spark.createDataFrame([(" a ", 1, None)], "`a.b` string, n int, z string")
    assert tuple(text.clean_text_columns(df).first()) == ("a", 1, None)
