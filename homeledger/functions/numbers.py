"""Numbers, money and area written as Vietnamese text, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from homeledger.functions.text import SPACE, WS, strip_accents, strip_edges

BILLION = 1_000_000_000.0
MILLION = 1_000_000.0

# --- fixed values: units and number shapes ---
_NUMBER = r"\d+(?:[,.]\d+)?"
_BILLIONS = rf"(?sU)({_NUMBER}){WS}*tỷ(.*)\z"
_MILLIONS = rf"(?U)({_NUMBER}){WS}*tri\u1ec7u"
MONEY_REWRITES = [
    ("tỉ", "tỷ"), ("ty", "tỷ"),
    ("tri\u00ea\u0323u", "tri\u1ec7u"),  # half-decomposed spelling
    ("trieu", "tri\u1ec7u"),
    ("vnd", ""), ("vnđ", ""), ("đ", ""),
]
AREA_UNITS = ["m²", "m2", "㎡"]
LEGACY_UNITS = ["m²", "m2", "triệu", "trieu", "tỷ", "ty"]
# --- end of fixed values ---


def _number_shape(digits: str, whole: bool = False) -> str:
    """A number between outer whitespace, as group 1; ``digits`` matches one run of them."""
    shape = digits if whole else rf"(?:{digits}\.?(?:{digits})?(?:e[+-]?{digits})?|\.{digits}(?:e[+-]?{digits})?|inf(?:inity)?)"
    return rf"(?i)\A{SPACE}*+([+-]?{shape}){SPACE}*+\z"


_PLAIN, _UNDERSCORED = r"\d++", r"\d(?:_?\d)*+"  # an underscore between digits is accepted, as in a Python number


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def try_number(c: Column) -> Column:
    """Text to double; anything that is not wholly a number is null, and so is NaN."""
    # no match is an empty text, and that is no number either
    return F.regexp_extract(c.cast("string"), _number_shape(_PLAIN), 1).try_cast("double")


def positive(c: Column) -> Column:
    v = nan_to_null(c.cast("double"))
    return F.when(v > 0, v)


def _drop(c: Column, words: list[str]) -> Column:
    for word in words:
        c = F.replace(c, F.lit(word), F.lit(""))
    return c


def _comma_decimal(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def _captured(c: Column, pattern: str, group: int) -> Column:
    """A captured number with at most one separator, null when the pattern is absent."""
    return _comma_decimal(F.regexp_extract(c, pattern, group))


def parse_number_vn(c: Column) -> Column:
    """Digits with separators: with both, dots group thousands; one alone is decimal."""
    t = F.regexp_replace(c, "[^0-9,.]", "")
    ungrouped = F.when(t.contains(","), F.replace(t, F.lit("."), F.lit(""))).otherwise(t)
    return _comma_decimal(ungrouped)


def money_text(c: Column) -> Column:
    """Lower case, one spelling per unit, no currency sign."""
    s = F.lower(c)
    for old, new in MONEY_REWRITES:
        s = F.replace(s, F.lit(old), F.lit(new))
    return s


def money_parts(s: Column) -> dict[str, Column]:
    """The numbers of a text already passed through ``money_text``."""
    return {
        "billions": _captured(s, _BILLIONS, 1),
        "rest": _captured(F.regexp_extract(s, _BILLIONS, 2), _MILLIONS, 1),
        "millions": _captured(s, _MILLIONS, 1),
        "bare": _captured(s, _NUMBER, 0),
    }


def price_of_parts(billions: Column, rest: Column, millions: Column, bare: Column) -> Column:
    """VND from the numbers of a money text.

    Billions, with the millions after them, come before millions alone; a bare number
    counts as VND from 1e8, as billions below 1000, and is ambiguous between.
    """
    total = billions * BILLION + F.coalesce(rest * MILLION, F.lit(0.0))
    return (
        F.when(billions.isNotNull(), F.when(total > 0, total))
        .when(millions.isNotNull(), millions * MILLION)
        .when(bare >= 100_000_000, bare)
        .when(bare < 1000, bare * BILLION)
    )


def parse_price_vnd(c: Column, numeric: bool = False) -> Column:
    """Price in VND. A numeric column is kept where positive, text is parsed."""
    return positive(c) if numeric else price_of_parts(**money_parts(money_text(c)))


def parse_float_vn(c: Column, numeric: bool = False) -> Column:
    """First signed number of a text once unit words are dropped."""
    if numeric:
        return nan_to_null(c.cast("double"))
    t = F.replace(_drop(F.lower(c), LEGACY_UNITS), F.lit("/"), F.lit(" "))
    num = F.regexp_extract(t, r"[-+]?\d[\d.,]*", 0)
    ungrouped = F.when(num.contains(","), F.replace(num, F.lit("."), F.lit(""))).otherwise(num)
    return _comma_decimal(ungrouped)


def parse_price_legacy(c: Column, numeric: bool = False) -> Column:
    """Price with one unit: the part before the first dash, scaled by the unit it names."""
    if numeric:
        return positive(c)
    t = _drop(F.split_part(strip_edges(F.lower(c)), F.lit("-"), F.lit(1)), ["đ", "vnd"])
    n = parse_float_vn(t)
    plain = strip_accents(t)
    return (
        F.when(plain.contains("ty"), n * BILLION)
        .when(plain.contains("trieu"), n * MILLION)
        .when(n < 1000, n * BILLION)
        .otherwise(n)
    )


def parse_area_m2(c: Column, numeric: bool = False) -> Column:
    """First number of an area text; a numeric column is kept where positive."""
    if numeric:
        return positive(c)
    return _captured(_drop(F.lower(c), AREA_UNITS), _NUMBER, 0)


def parse_or_default(c: Column, kind: str = "double", default: float | int | None = None) -> Column:
    """Form field to number: blank, null or bad text gives the default."""
    found = F.regexp_extract(c, _number_shape(_UNDERSCORED, whole=kind == "int"), 1)
    return F.coalesce(F.replace(found, F.lit("_"), F.lit("")).try_cast(kind), F.lit(default).cast(kind))


def format_vnd(c: Column) -> Column:
    return F.concat(F.format_number(c, 0), F.lit(" VND"))


def fixed(c: Column, digits: int) -> Column:
    """A number with fixed digits and no grouping, rounded by its exact binary value."""
    return F.replace(F.format_number(c, digits), F.lit(","), F.lit(""))


def format_billion(c: Column) -> Column:
    return F.concat(fixed(c / BILLION, 3), F.lit(" tỷ VNĐ"))


def log_target(c: Column) -> Column:
    return F.log1p(c)


def price_of_log(c: Column, floor: bool = True) -> Column:
    """Back from the log target; prices are not negative unless ``floor`` is off."""
    p = F.expm1(c)
    return F.greatest(p, F.lit(0.0)) if floor else p


def abs_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def prediction_band(predicted: Column, mae: Column) -> tuple[Column, Column]:
    """Lower and upper price, one mean error away; null without a known error."""
    lower = F.when(mae.isNotNull(), F.greatest(predicted - mae, F.lit(0.0)))
    return lower, predicted + mae
