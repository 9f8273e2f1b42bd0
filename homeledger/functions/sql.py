"""The text and money rules as SQL functions, for users who write SQL.

They are SQL expressions too, inlined into the caller's plan; no Python runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from homeledger import schema as S
from homeledger.functions import numbers as N, text as X


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _chain(x: str, steps: list[tuple[str, str]]) -> str:
    for old, new in steps:
        x = f"replace({x}, {_quote(old)}, {_quote(new)})"
    return x


def _prefixes(x: str, prefixes: list[str]) -> str:
    stripped = f"regexp_replace({x}, {_quote(X._prefix_pattern(prefixes))}, '$1')"
    return f"coalesce(nullif({stripped}, ''), '{S.UNKNOWN}')"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(_quote(v) for v in values) + ")"


def _functions() -> list[tuple[str, str, str]]:
    """(signature, return type, body), callees first."""
    spaces = _quote(rf"(?U){X.WS}+")
    no_brackets = f"trim(regexp_replace(clean_text(x), {_quote(r' *\(.*?\) *')}, ''))"
    captured = "try_cast(replace(nullif(regexp_extract({0}, {1}, {2}), ''), ',', '.') AS DOUBLE)"

    def cap(x: str, pattern: str, group: int) -> str:
        return captured.format(x, _quote(pattern), group)

    rest = f"regexp_extract(s, {_quote(N._BILLIONS)}, 2)"
    return [
        ("clean_text(x STRING)", "STRING",
         f"coalesce(nullif(trim(regexp_replace(x, {spaces}, ' ')), ''), '{S.UNKNOWN}')"),
        ("normalize_province(x STRING)", "STRING",
         f"CASE WHEN clean_text(x) IN {_in(X.PROVINCE_ALIASES['fixed'])} THEN {_quote(S.HCMC)} "
         "ELSE clean_text(x) END"),
        ("normalize_district(x STRING)", "STRING",
         _prefixes(_chain(no_brackets, X.DISTRICT_REWRITES), X.DISTRICT_PREFIXES)),
        ("normalize_ward(x STRING)", "STRING", _prefixes(no_brackets, X.WARD_PREFIXES)),
        ("normalize_direction(x STRING)", "STRING",
         f"CASE WHEN clean_text(x) IN {_in(X.COMPASS)} THEN clean_text(x) ELSE '{S.UNKNOWN}' END"),
        ("parse_number_vn(x STRING)", "DOUBLE",
         "try_cast(replace(CASE WHEN contains(x, ',') THEN replace(regexp_replace(x, '[^0-9,.]', ''), '.', '') "
         "ELSE regexp_replace(x, '[^0-9,.]', '') END, ',', '.') AS DOUBLE)"),
        ("money_text(x STRING)", "STRING", _chain("lower(x)", N.MONEY_REWRITES)),
        ("price_of_money_text(s STRING)", "DOUBLE",
         f"CASE WHEN {cap('s', N._BILLIONS, 1)} IS NOT NULL THEN "
         f"nullif({cap('s', N._BILLIONS, 1)} * 1e9 + coalesce({cap(rest, N._MILLIONS, 1)} * 1e6, 0e0), 0e0) "
         f"WHEN {cap('s', N._MILLIONS, 1)} IS NOT NULL THEN {cap('s', N._MILLIONS, 1)} * 1e6 "
         f"WHEN {cap('s', N._NUMBER, 0)} >= 1e8 THEN {cap('s', N._NUMBER, 0)} "
         f"WHEN {cap('s', N._NUMBER, 0)} < 1000 THEN {cap('s', N._NUMBER, 0)} * 1e9 END"),
        ("parse_price_vnd(x STRING)", "DOUBLE", "price_of_money_text(money_text(x))"),
        ("parse_area_m2(x STRING)", "DOUBLE",
         cap(_chain("lower(x)", [(u, "") for u in N.AREA_UNITS]), N._NUMBER, 0)),
    ]


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the session's SQL functions; returns their names."""
    names = []
    for signature, returns, body in _functions():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")
        names.append(signature.split("(")[0])
    return names
