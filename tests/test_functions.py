from datetime import date

import pytest
from pyspark.sql import functions as F

from spendmill import functions as fn


def values(spark, column, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column.alias("v")).collect()]


def test_lenient_date_keeps_the_row(spark):
    got = values(spark, fn.lenient_date("t"), ["2024-01-05", "2024-1-5", "bad", "", None, "2024-02-30", "2024-01", "2024"])
    assert got == [date(2024, 1, 5), date(2024, 1, 5)] + [None] * 6


def test_strict_date_fails(spark):
    assert values(spark, fn.strict_date("t"), ["2024-01-05", None]) == [date(2024, 1, 5), None]
    with pytest.raises(Exception, match="CANNOT_PARSE|INVALID|parse"):
        values(spark, fn.strict_date("t"), ["bad"])


def test_last_segment(spark):
    names = ["customers/1/adGroupCriteria/67~55", "plain", "", None]
    assert values(spark, fn.last_segment("t", "~"), names) == ["55", "plain", "", None]
    assert values(spark, fn.last_segment("t", "~", blank_as_null=True), names) == ["55", "plain", None, None]
    assert values(spark, fn.last_segment("t", "/"), ["customers/1/conversionActions/9"]) == ["9"]


def test_defaults(spark):
    assert values(spark, fn.default_if_blank("t", "Unnamed Account"), ["x", "", None]) == [
        "x",
        "Unnamed Account",
        "Unnamed Account",
    ]
    assert values(spark, fn.with_prefix("t", "act_"), ["1", "act_1", None]) == ["act_1", "act_1", None]
    assert values(spark, fn.without_prefix("t", "act_"), ["act_1", "1", "act_act_1"]) == ["1", "1", "1"]


def test_metric_text(spark):
    texts = ["12", " 12 ", "-3", "12.0", "x", "", None]
    assert values(spark, fn.bad_whole_number("t"), texts) == [False, False, False, True, True, True, False]
    assert values(spark, fn.whole_number_or_zero("t"), ["12", " 12 ", None]) == [12, 12, 0]
    texts = ["1.5", "1e3", " 2 ", "1d", "2F", "x", "", None, "-inf"]
    assert values(spark, fn.bad_number("t"), texts) == [False, False, False, True, True, True, True, False, False]
    assert values(spark, fn.number_or_zero("t"), ["1.5", "1e3", None]) == [1.5, 1000.0, 0.0]


def test_micros(spark):
    rows = spark.createDataFrame([(1_500_000, 1.234567), (None, None), (0, 0.1 + 0.2)], "m bigint, u double")
    assert [tuple(r) for r in rows.select(fn.micros_to_units("m"), fn.to_micros("u")).collect()] == [
        (1.5, 1234567),
        (None, None),
        (0.0, 300000),
    ]


def test_list_total(spark):
    ddl = "items array<struct<action_type: string, value: string>>"
    lists = [None, [], [("a", "1"), ("b", "2.5")], [("a", "x")], [("a", None)], [None]]
    rows = spark.createDataFrame([(items,) for items in lists], ddl).coalesce(1)
    got = rows.select(fn.list_total("items").alias("t"), fn.bad_list_values("items").alias("bad")).collect()
    assert [r["bad"] for r in got] == [False, False, False, True, True, True]
    assert [r["t"] for r in got[:3]] == [0.0, 0.0, 3.5]


AD = (
    "struct<type: string, responsive_search_ad: struct<headlines: array<struct<text: string>>, descriptions: "
    "array<struct<text: string>>>, responsive_display_ad: struct<headlines: array<struct<text: string>>, descriptions: "
    "array<struct<text: string>>, long_headline: struct<text: string>>, expanded_text_ad: struct<headline_part1: string, "
    "headline_part2: string, headline_part3: string, description: string, description2: string>>"
)


@pytest.mark.parametrize(
    ("ad", "headlines", "descriptions"),
    [
        (("RESPONSIVE_SEARCH_AD", ([("a",), ("",)], [("d",)]), None, None), ["a", ""], ["d"]),
        (("RESPONSIVE_SEARCH_AD", None, None, None), [], []),
        (("RESPONSIVE_DISPLAY_AD", None, ([("a",)], [("d",)], ("long",)), None), ["a", "long"], ["d"]),
        (("RESPONSIVE_DISPLAY_AD", None, ([("a",)], None, None), None), ["a"], []),
        (("EXPANDED_TEXT_AD", None, None, ("p1", "", None, "", "d2")), ["p1"], ["d2"]),
        (("IMAGE_AD", ([("a",)], None), None, ("p1", None, None, None, None)), [], []),
    ],
)
def test_assets(spark, ad, headlines, descriptions):
    row = spark.createDataFrame([(ad,)], f"ad {AD}")
    got = row.select(fn.asset_headlines(F.col("ad")), fn.asset_descriptions(F.col("ad"))).first()
    assert tuple(got) == (headlines, descriptions)
