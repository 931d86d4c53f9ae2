"""Report pipelines on edge rows (FIXTURES D) built inline."""

import datetime as dt

from slicewright.plans import reports

D = dt.date


def test_fill_rate_dedupe_and_ratio(spark):
    # D6 same (date, unit) on two hierarchy levels; D7 zero requests; D8 all-NULL metric.
    raw = spark.createDataFrame([
        (20251123, "hp", 1, 9, 8, 40, 0.5, 100, "level_1"),
        (20251123, "hp", 2, 9, 8, 60, 0.5, 100, "level_2"),
        (20251123, "zero", None, 1, 1, 5, 0.0, 0, "level_1"),
        (20251124, "hp", None, 1, 1, 1, 0.1, 4, "level_1"),
    ], "DATE bigint, AD_UNIT_NAME string, UNFILLED_IMPRESSIONS bigint, CODE_SERVED_COUNT bigint, "
       "RESPONSES_SERVED bigint, AD_SERVER_IMPRESSIONS bigint, FILL_RATE double, AD_REQUESTS bigint, "
       "AD_UNIT_NAME_LEVEL_1 string")
    out = {(r.date, r.ad_unit_name): r for r in reports.report_fill_rate(raw).collect()}
    hp = out[(D(2025, 11, 23), "hp")]
    assert (hp.unfilled_impressions, hp.code_served_count, hp.ad_server_impressions, hp.ad_requests) == (3, 18, 100, 200)
    assert hp.fill_rate == 0.5
    zero = out[(D(2025, 11, 23), "zero")]
    assert zero.fill_rate is None and zero.unfilled_impressions == 0
    assert out[(D(2025, 11, 24), "hp")].unfilled_impressions == 0  # all-NULL group sums to 0
    assert reports.report_fill_rate(raw).columns == [
        "date", "ad_unit_name", "unfilled_impressions", "code_served_count", "responses_served",
        "ad_server_impressions", "fill_rate", "ad_requests"]


def test_fill_rate_empty_batch(spark):
    raw = spark.createDataFrame([], "DATE bigint, AD_UNIT_NAME string, AD_SERVER_IMPRESSIONS bigint, AD_REQUESTS bigint")
    assert reports.report_fill_rate(raw).count() == 0


def test_inventory_keeps_expected_and_coerces(spark):
    raw = spark.createDataFrame([
        ("20240307", "Root > Sports", "sports.example.com", "l1", "l2", "Spring campaign 7", "Tablet", "320 x 50",
         "1234", "56", "1100", "789"),
        ("20251123", "x", "y", "l1", "l2", "o", "Mobile", "300 x 250", "-", "1e3", " 4 ", "N/A"),
    ], "DATE string, AD_UNIT_NAME_TOP_LEVEL string, AD_UNIT_NAME string, AD_UNIT_NAME_LEVEL_1 string, "
       "AD_UNIT_NAME_LEVEL_2 string, ORDER_NAME string, DEVICE_CATEGORY_NAME string, RENDERED_CREATIVE_SIZE string, "
       "IMPRESSIONS string, CLICKS string, AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS string, "
       "ACTIVE_VIEW_VIEWABLE_IMPRESSIONS string")
    df = reports.report_inventory_daily(raw)
    assert "ad_unit_level_1" not in df.columns
    rows = sorted(df.collect(), key=lambda r: r.ad_unit_name)
    assert tuple(rows[0]) == (D(2024, 3, 7), "Root > Sports", "sports.example.com", "Spring campaign 7", "Tablet",
                              "320 x 50", 1234, 56, 1100, 789)
    assert (rows[1].ad_server_impressions, rows[1].ad_server_clicks,
            rows[1].active_view_measurable_impressions, rows[1].active_view_viewable_impressions) == (None, 1000, 4, None)


def test_geo_rest_vs_backfill(spark):
    # D1 unknown country "0" is kept; D9 NULL-name subtotal dropped only by the backfill.
    raw = spark.createDataFrame([
        ("France", "FR", 1510, 10, 1, "0.5", 3),
        ("0", "0", 1510, 1, 0, "-", 0),
        (None, "NA", 1512, 11, 1, "0.25", 4),
    ], "COUNTRY_NAME string, COUNTRY_CODE string, MONTH_YEAR bigint, IMPRESSIONS bigint, CLICKS bigint, "
       "AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE string, AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS bigint")
    rest = reports.report_geo_monthly(raw).collect()
    assert len(rest) == 3
    assert {r.report_date for r in rest} == {D(2025, 11, 1), D(2026, 1, 1)}
    assert [r.country_name for r in rest if r.country_code == "NA"] == [None]  # NULL stays NULL, never "None"
    back = reports.report_geo_backfill(raw).collect()
    assert sorted(r.country_code for r in back) == ["0", "FR"]


def test_demographics_keeps_unmapped_columns(spark):
    raw = spark.createDataFrame([(1510, "MALE_18_24", "Homme", "18-24", "5")],
                                "MONTH_YEAR bigint, GRP_DEMOGRAPHICS string, GENDER_NAME string, "
                                "AGE_BRACKET_NAME string, SESSIONS string")
    df = reports.report_audience_demographics(raw)
    assert df.columns == ["report_date", "GRP_DEMOGRAPHICS", "gender", "age_bracket", "sessions"]
    assert tuple(df.first()) == (D(2025, 11, 1), "MALE_18_24", "Homme", "18-24", 5)


def test_csv_fill_rate_hierarchy_columns(spark):
    # X15: "Ad unit 2" and "Dimension.AD_UNIT_NAME" both map to ad_unit_name.
    raw = spark.createDataFrame([
        ("2025-11-23", "top", "hp", None, "1", "9", "8", "40", "0.4", "100"),
        ("2025-11-23", None, None, "hp", "2", "9", "8", "60", "0.6", "100"),
    ], "`Dimension.DATE` string, `Ad unit 1` string, `Ad unit 2` string, `Dimension.AD_UNIT_NAME` string, "
       "`Column.TOTAL_INVENTORY_LEVEL_UNFILLED_IMPRESSIONS` string, `Column.TOTAL_CODE_SERVED_COUNT` string, "
       "`Column.TOTAL_RESPONSES_SERVED` string, `Column.AD_SERVER_IMPRESSIONS` string, "
       "`Column.TOTAL_FILL_RATE` string, `Column.TOTAL_AD_REQUESTS` string")
    out = reports.csv_fill_rate(raw).collect()
    assert len(out) == 1 and out[0].ad_unit_name == "hp" and out[0].ad_server_impressions == 100
    assert out[0].fill_rate == 0.5


def test_csv_geo_with_chunk_date(spark):
    raw = spark.createDataFrame([("France", "2250", "10", "1", "0.5", "3"), (None, "0", "1", "0", "-", "0")],
                                "`Dimension.COUNTRY_NAME` string, `Dimension.COUNTRY_CRITERIA_ID` string, "
                                "`Column.AD_SERVER_IMPRESSIONS` string, `Column.AD_SERVER_CLICKS` string, "
                                "`Column.AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE` string, "
                                "`Column.AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS` string")
    out = reports.csv_geo_monthly(raw, D(2025, 1, 1)).collect()
    assert len(out) == 1 and out[0].report_date == D(2025, 1, 1) and out[0].country_code == "2250"


def test_legacy_inventory(spark):
    raw = spark.createDataFrame([("2025-11-23", "123", "u", "77", "o", "Desktop", "728 x 90", "5", "1", "extra")],
                                "`Dimension.DATE` string, `Dimension.AD_UNIT_ID` string, `Dimension.AD_UNIT_NAME` string, "
                                "`Dimension.ORDER_ID` string, `Dimension.ORDER_NAME` string, "
                                "`Dimension.DEVICE_CATEGORY_NAME` string, `Dimension.CREATIVE_SIZE` string, "
                                "`Column.AD_SERVER_IMPRESSIONS` string, `Column.AD_SERVER_CLICKS` string, junk string")
    r = reports.legacy_inventory_daily(raw).first()
    assert (r.date, r.ad_unit_id, r.order_id, r.ad_server_impressions) == (D(2025, 11, 23), 123, 77, 5)
    assert "junk" not in reports.legacy_inventory_daily(raw).columns


def test_fill_rate_keeps_null_unit_group(spark):
    # X18: NULL group keys form their own group (not dropped, not the text "nan").
    raw = spark.createDataFrame([(20251123, None, 1, 10), (20251123, None, 2, 10), (20251123, "hp", 3, 0)],
                                "DATE bigint, AD_UNIT_NAME string, AD_SERVER_IMPRESSIONS bigint, AD_REQUESTS bigint")
    out = {r.ad_unit_name: (r.ad_server_impressions, r.ad_requests, r.fill_rate)
           for r in reports.report_fill_rate(raw).collect()}
    assert out == {None: (3, 20, 0.15), "hp": (3, 0, None)}


def test_csv_geo_without_month_needs_a_date(spark):
    import pytest

    raw = spark.createDataFrame([("France", "2250")], "`Dimension.COUNTRY_NAME` string, `Dimension.COUNTRY_CRITERIA_ID` string")
    with pytest.raises(ValueError):
        reports.csv_geo_monthly(raw)
