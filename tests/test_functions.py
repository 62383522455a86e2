import pytest
from pyspark.sql import functions as F

from tidewatch.functions.numeric import percent_change, round_half_up
from tidewatch.functions.text import fill_template, num_text, short_name, sql_text, template_sql


def column(spark, values, expression, kind="double"):
    frame = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [row[0] for row in frame.select(expression(F.col("x"))).collect()]


def test_num_text(spark):
    cases = {
        0.0: "0", -0.0: "0", 1.0: "1", -500.0: "-500", 12_000_000.0: "12000000", 0.0345: "0.0345",
        12221.43: "12221.43", 0.1: "0.1", -0.25: "-0.25", 100.5: "100.5", 1e17: "100000000000000000",
        0.00001: "0.00001", None: None,
    }
    assert column(spark, cases, num_text) == list(cases.values())
    assert column(spark, [1e30, 1e-12], num_text) == ["1.0E30", "1.0E-12"]


def test_round_half_up(spark):
    cases = {1.005: 1.01, -1.005: -1.01, 2.675: 2.68, 0.125: 0.13, 1e25: 1e25, None: None}
    assert column(spark, cases, lambda x: round_half_up(x, 2)) == list(cases.values())


def test_percent_change(spark):
    assert column(spark, [50.0, 0.0, None], lambda x: percent_change(F.lit(75.0), x)) == [
        50.0, None, None
    ]


def test_names_and_templates(spark):
    assert column(spark, ["A.B.SOME_CHECK", "PLAIN"], short_name, "string") == [
        "some_check", "plain"
    ]
    text = "it's {x}, \\ or {x}?"
    expected = ["it's 1, \\ or 1?", None]
    assert column(spark, ["1", None], lambda x: fill_template(text, {"x": x}), "string") == expected
    assert column(
        spark, ["1", None], lambda _: F.expr(template_sql(text, {"x": "x"})), "string"
    ) == expected


@pytest.mark.parametrize("text", ["", "plain", "o'clock", "back\\slash\\'", "100%"])
def test_sql_text(spark, text):
    assert spark.sql(f"select {sql_text(text)}").first()[0] == text
