"""Literal rows per rule; expected values are worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from homeledger.functions import dates, numbers, sql, text


def check(spark, rule, cases, kind="string"):
    rows = [(i, given) for i, (given, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", rule(F.col("x")).alias("y"))
    got = {r["i"]: r["y"] for r in df.collect()}
    for i, (given, want) in enumerate(cases):
        value = got[i]
        if isinstance(want, float) and value is not None:
            assert value == pytest.approx(want, rel=1e-12), given
        else:
            assert value == want, given


def test_clean_text(spark):
    check(spark, text.clean_text, [
        (None, "Unknown"), ("", "Unknown"), ("  ", "Unknown"), ("a  b", "a b"), (" a \n b\x1c", "a b"),
        ("a", "a"), ("\t", "Unknown")])


def test_normalize_text_and_fill_category(spark):
    check(spark, text.normalize_text, [(None, None), (" ", None), (" a\t b ", "a b")])
    check(spark, text.fill_category, [
        (None, "Unknown"), ("", "Unknown"), (" nan ", "Unknown"), (" a  b ", "a  b"), ("nano", "nano")])


def test_strip_accents(spark):
    check(spark, text.strip_accents, [
        ("Căn hộ Tỷ", "Can ho Ty"), ("đường Đ", "đuong Đ"), ("triệu", "trieu"), ("éàü", "eau"), (None, None)])


def test_province_variants(spark):
    check(spark, text.normalize_province, [
        ("TPHCM", "Hồ Chí Minh"), ("TP.HCM", "Hồ Chí Minh"), ("Hồ Chí Minh cũ", "Hồ Chí Minh"), (" Tp  Hồ Chí Minh ", "Hồ Chí Minh"),
        ("Hà Nội", "Hà Nội"), (None, "Unknown"), ("TPxHCM", "TPxHCM")])
    check(spark, lambda c: text.normalize_province(c, "merge"), [
        ("TPHCM", "TPHCM"), ("TP.HCM", "TPHCM"), ("TP. Hồ Chí Minh", "Hồ Chí Minh"), ("Hồ Chí Minh cũ", "Hồ Chí Minh cũ")])
    check(spark, lambda c: text.normalize_province(c, "web"), [("TPHCM", "TPHCM"), ("TP.HCM", "Hồ Chí Minh")])
    with pytest.raises(ValueError):
        text.normalize_province(F.lit("x"), "other")


def test_district(spark):
    check(spark, text.normalize_district, [
        ("Q.1", "1"), ("Q 7", "7"), ("Quận 2 (TP. Thủ Đức)", "2"), ("TP. Thủ Đức", "Thủ Đức"), ("TP Thủ Đức", "TP Thủ Đức"),
        ("Quận", "Quận"), ("Quận Huyện X", "X"), ("Q.", "Unknown"), ("Quận 2 (TP. Thủ Đức) cũ", "2cũ"), (None, "Unknown"),
        ("Abc Q.", "Abc Quận "), ("Huyện Nhà Bè", "Nhà Bè"), ("Huyện Quận 5", "Quận 5"), ("Quận Huyện", "Huyện"),
        ("(x)", "Unknown"), ("Thành phố Thị xã A ", "A")])
    check(spark, lambda c: text.normalize_district(c, "merge"), [("Quận 2 (TP. Thủ Đức)", "2 (Thành phố  Thủ Đức)")])


def test_ward(spark):
    check(spark, text.normalize_ward, [
        ("Phường 22", "22"), ("Xã Tân Kiên", "Tân Kiên"), ("Phường Xã Y", "Y"), ("Thị trấn A (cũ)", "A"), ("", "Unknown"),
        ("Phường", "Phường")])
    check(spark, lambda c: text.normalize_ward(c, "web"), [("Thị trấn A (cũ)", "A (cũ)")])


def test_direction(spark):
    check(spark, text.normalize_direction, [
        ("5", "Unknown"), ("5.0", "Unknown"), ("Đông Nam", "Đông Nam"), (" Tây ", "Tây"), ("Hướng lạ", "Unknown"), (None, "Unknown"),
        ("Đông Nam x", "Unknown")])
    check(spark, lambda c: text.normalize_direction(c, "merge"), [
        ("5.0", "Unknown"), ("Hướng lạ", "Hướng lạ"), ("NaN", "Unknown"), ("none", "Unknown"), (None, "Unknown"), ("5.1", "5.1")])


def test_extract_district(spark):
    check(spark, text.extract_district, [
        ("12 Lê Lợi, Phường 3, Quận Bình Thạnh, TP HCM", "Quận Bình Thạnh"), ("quận 7 TP.HCM", "quận 7 TP"), ("Hà Nội", None),
        ("TP. Thủ Đức", "TP. Thủ Đức"), ("Huyện A, Q. 10", "Q. 10"), (None, None)])


def test_numbers(spark):
    check(spark, numbers.parse_number_vn, [
        ("3,780", 3.78), ("3.780", 3.78), ("11,5", 11.5), ("1.234,5", 1234.5), ("abc", None), (None, None)])
    check(spark, numbers.try_number, [
        ("1e5", 1e5), (" 5 ", 5.0), ("inf", float("inf")), ("1d", None), ("1_000", None), ("1,5", None), ("nan", None),
        ("", None), (".5", 0.5), ("1.", 1.0), ("+2", 2.0), ("5 6", None)])
    check(spark, numbers.parse_or_default, [("1_000", 1000.0), (" 7 ", 7.0), ("", None), ("abc", None), (None, None)])
    check(spark, lambda c: numbers.parse_or_default(c, "int", 9), [("12", 12), ("1.5", 9), ("", 9), ("-3", -3)])


PRICES = [
    ("6 tỷ 600 triệu", 6.6e9), ("2 tỷ 40 triệu", 2.04e9), ("50 tỷ", 5e10), ("3.780tỷ", 3.78e9), ("1,650 tỷ", 1.65e9),
    ("1.234,5 tỷ", 2.345e11), ("850.000.000", 8.5e11), ("6.600.000.000", 6.6e9), ("850000000", 8.5e8), ("850000", None),
    ("Thỏa thuận", None), ("0", 0.0), ("0 tỷ", None), ("900 triệu", 9e8), ("900 trieu VNĐ", 9e8), ("2 TỈ", 2e9),
    ("2 ty 5 triệu", 2.005e9), ("0 triệu", 0.0), (None, None), ("", None), ("-5 tỷ", 5e9)]


def test_price(spark):
    check(spark, numbers.parse_price_vnd, PRICES)
    check(spark, lambda c: numbers.parse_price_vnd(c, numeric=True), [(-1.0, None), (5.0, 5.0), (float("nan"), None)], "double")


def test_legacy_price_and_floats(spark):
    check(spark, numbers.parse_price_legacy, [
        ("2 tỷ- 62 m2đ", 2e9), ("2,58 tỷ", 2.58e9), ("850 triệu", 8.5e8), ("2 tỷ 500 triệu", 2e9), ("-5 tỷ", None), ("5000", 5000.0)])
    check(spark, numbers.parse_float_vn, [
        ("62 m²", 62.0), ("32,26 triệu/m²", 32.26), ("1.234,5", 1234.5), ("1.234.567", None), ("62.", 62.0), ("x", None), ("-3", -3.0)])


def test_area(spark):
    check(spark, numbers.parse_area_m2, [
        ("70 m2", 70.0), ("1.250 m2", 1.25), ("2 PN 70m2", 2.0), ("0", 0.0), ("khoảng", None), ("70㎡", 70.0)])
    check(spark, lambda c: numbers.parse_area_m2(c, numeric=True), [(0.0, None), (5.0, 5.0)], "double")


def test_published_at(spark):
    def at(*a):
        return dt.datetime(*a)
    check(spark, dates.parse_published_at, [
        ("2025-12-25", at(2025, 12, 25)), ("2025/5/3 7:05", at(2025, 5, 3, 7, 5)), ("05/12/2025", at(2025, 5, 12)),
        ("25/12/2025 10:00:01", at(2025, 12, 25, 10, 0, 1)), ("Hôm nay", None), ("2025-02-30", None), ("", None), (None, None)])
    check(spark, lambda c: dates.parse_published_at(c, day_first=True), [
        ("05/12/2025", at(2025, 12, 5)), ("12/25/2025", at(2025, 12, 25)), ("2025-12-05", at(2025, 12, 5)), ("1.2.2025", at(2025, 2, 1))])
    check(spark, lambda c: dates.parse_published_at(c, strict_format="yyyy-MM-dd"), [
        ("2025-12-25", at(2025, 12, 25)), ("2025-12-25 10:00:00", None)])


def test_epoch(spark):
    check(spark, lambda c: dates.epoch_to_timestamp(c, "UTC"), [
        ("1767225600", "2026-01-01 00:00:00"), ("1767225600123", "2026-01-01 00:00:00"), ("x", None), (None, None), ("inf", None),
        ("1767225600.9", "2026-01-01 00:00:00"), ("-1", "1969-12-31 23:59:59")])
    check(spark, lambda c: dates.epoch_to_timestamp(c, "Asia/Ho_Chi_Minh"), [("1767225600", "2026-01-01 07:00:00")])


def test_end_of_day_and_weekday(spark):
    row = spark.range(1).select(
        dates.end_of_day("2026-03-31").alias("e"),
        *[c.alias(n) for n, c in dates.date_parts(F.lit("2026-05-25").cast("timestamp_ntz")).items()]).first()
    assert row["e"] == dt.datetime(2026, 3, 31, 23, 59, 59)
    assert (row["posted_year"], row["posted_month"], row["posted_day"], row["posted_dayofweek"]) == (2026, 5, 25, 0)


def test_money_format_and_band(spark):
    df = spark.createDataFrame([(1234567.0, 1e6), (2.1275e9, None), (None, 1.0)], "p double, mae double")
    lower, upper = numbers.prediction_band(F.col("p"), F.col("mae"))
    rows = df.select(numbers.format_vnd(F.col("p")).alias("v"), numbers.format_billion(F.col("p")).alias("b"),
                     lower.alias("lo"), upper.alias("hi")).collect()
    assert rows[0] == ("1,234,567 VND", "0.001 tỷ VNĐ", 234567.0, 2234567.0)
    assert rows[1]["b"] == f"{2.1275:.3f} tỷ VNĐ" and rows[1]["lo"] is None and rows[1]["hi"] is None
    assert rows[2]["v"] is None and rows[2]["b"] is None


def test_price_back_from_log(spark):
    row = spark.createDataFrame([(-1.0,)], "p double").select(
        numbers.price_of_log(F.col("p")).alias("a"), numbers.price_of_log(F.col("p"), floor=False).alias("b")).first()
    assert row["a"] == 0.0 and row["b"] < 0


def test_sql_functions_equal_column_functions(spark):
    sql.register_sql_functions(spark)
    df = spark.createDataFrame([(p,) for p, _ in PRICES], "x string")
    both = df.select(F.expr("parse_price_vnd(x)").alias("a"), numbers.parse_price_vnd(F.col("x")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in both)
    places = spark.createDataFrame([("Quận 2 (TP. Thủ Đức)",), ("Q.",), (None,), ("Quận Huyện X",)], "x string")
    got = [r[0] for r in places.selectExpr("normalize_district(x)").collect()]
    assert got == ["2", "Unknown", "Unknown", "X"]


def test_squeeze_takes_every_space_and_leaves_single_ones(spark):
    """Each character of the plane alone, doubled and beside a space, against the class with the Unicode flag."""
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(f"a{c}b {c}{c}d{c}",) for c in chars], "x string")
    plain = F.trim(F.regexp_replace("x", rf"(?U){text.WS}+", " "))
    assert df.where(~text._squeeze(F.col("x")).eqNullSafe(plain)).count() == 0
    assert text._RUNS != text.WS and df.where(F.regexp_count(F.lit("one two three"), F.lit(text._RUNS)) > 0).isEmpty()


def test_form_numbers_in_one_pattern(spark):
    check(spark, numbers.parse_or_default, [
        ("1__2", None), ("_1", None), ("1_", None), ("1_.5", None), ("1._5", None), ("1_0.2_5e1_0", 10.25e10), (".5_0", 0.5),
        ("\u00a0+1_2\u3000", 12.0), ("-inf", float("-inf")), ("e1", None), ("1e", None), ("1 2", None), ("9" * 20_000 + "x", None)])
    check(spark, numbers.try_number, [("1_0", None), ("\u2003-1.5E2 ", -150.0), ("1.", 1.0), (".", None), ("infinity", float("inf"))])
