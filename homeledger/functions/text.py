"""Text, place-name and direction rules as native column expressions.

Whitespace is matched with Unicode rules plus the separators U+001C..U+001F.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column, functions as F

from homeledger.schema import HCMC, UNKNOWN

WS = r"[\s\x1c-\x1f]"  # with the Unicode flag (?U)
_EDGES = rf"(?U)\A{WS}+|{WS}+\z"
# the same characters listed, which match faster than a class with the flag; first a cheap test that most letters fail
SPACE = r"[\x09-\x20\x85\xa0\u1680\u2000-\u3000&&[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
_RUNS = rf"{SPACE}(?:{SPACE}+|(?<! ))"  # all but single spaces, so that ordinary text is not rebuilt

# --- fixed values: spellings that must match the source data ---
PROVINCE_ALIASES = {
    "fixed": [
        "Tp Hồ Chí Minh", "TP Hồ Chí Minh", "TP. Hồ Chí Minh", "Thành phố Hồ Chí Minh",
        "TPHCM", "TP.HCM", "HCM", "Hồ Chí Minh cũ",
    ],
    # here "TP." has already become "TP", so the dotted spellings never match
    "merge": [
        "Tp Hồ Chí Minh", "TP Hồ Chí Minh", "TP. Hồ Chí Minh", "Thành phố Hồ Chí Minh",
        "TP.HCM", "HCM",
    ],
    "web": [
        "Tp Hồ Chí Minh", "TP Hồ Chí Minh", "TP. Hồ Chí Minh", "Thành phố Hồ Chí Minh",
        "TP.HCM", "HCM",
    ],
}
DISTRICT_REWRITES = [
    ("Q.", "Quận "), ("Q ", "Quận "), ("Tp.", "Thành phố "), ("TP.", "Thành phố "),
]
DISTRICT_PREFIXES = ["Quận ", "Huyện ", "Thành phố ", "Thị xã "]
WARD_PREFIXES = ["Phường ", "Xã ", "Thị trấn "]
COMPASS = [
    "Đông", "Tây", "Nam", "Bắc", "Đông Nam", "Đông Bắc", "Tây Nam", "Tây Bắc",
]
DISTRICT_PATTERNS = [
    r"(Quận\s+[\p{L}\p{N}_À-ỹ\s]+)",
    r"(Q\.\s*\d+)",
    r"(Huyện\s+[\p{L}\p{N}_À-ỹ\s]+)",
    r"(Thành phố\s+Thủ Đức)",
    r"(TP\.\s*Thủ Đức)",
]
# --- end of fixed values ---

VARIANTS = ("fixed", "merge", "web")


def _check_variant(variant: str) -> None:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")


# Rules refer to their input once wherever they can: a second reference would be a
# second run of every pattern below it.


def strip_edges(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _RUNS, " "))


def normalize_text(c: Column) -> Column:
    """Single spaces, no outer whitespace; empty becomes null."""
    return F.nullif(_squeeze(c), F.lit(""))


def _or_default(x: Column, default: str = UNKNOWN, words: str = "") -> Column:
    """The default in place of null, empty and the given words."""
    if words:
        x = F.regexp_replace(x, rf"\A(?:{words})\z", "")
    return F.coalesce(F.nullif(x, F.lit("")), F.lit(default))


def clean_text(c: Column, default: str = UNKNOWN) -> Column:
    """Single spaces, no outer whitespace; null and empty become the default."""
    return _or_default(_squeeze(c), default)


def fill_category(c: Column) -> Column:
    """Outer whitespace off, inner kept; null, empty and the text ``nan`` are unknown."""
    return _or_default(strip_edges(c), words="|nan")


def filter_text(c: Column) -> Column:
    """The form in which a category is compared with a filter argument."""
    return F.coalesce(strip_edges(c), F.lit(""))


@functools.cache
def _accent_tables() -> tuple[str, str]:
    """Precomposed characters and their bases, for all that reduce to one character."""
    composed, base = [], []
    for code in range(0xC0, 0x10000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        kept = [k for k in unicodedata.normalize("NFD", ch) if unicodedata.category(k) != "Mn"]
        if len(kept) == 1 and kept[0] != ch:
            composed.append(ch)
            base.append(kept[0])
    return "".join(composed), "".join(base)


def strip_accents(c: Column) -> Column:
    """Letters without combining marks; letters that do not decompose, such as đ, stay."""
    composed, base = _accent_tables()
    return F.regexp_replace(F.translate(c, composed, base), r"\p{Mn}", "")


def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def lookup(c: Column, mapping: dict[str, str]) -> Column:
    """Dictionary lookup that passes unknown values through."""
    return F.coalesce(F.try_element_at(_literal_map(mapping), c), c)


def normalize_province(c: Column, variant: str = "fixed") -> Column:
    _check_variant(variant)
    x = clean_text(c)
    if variant == "merge":
        x = F.replace(x, F.lit("TP."), F.lit("TP"))
    aliases = "|".join(a.replace(".", r"\.") for a in PROVINCE_ALIASES[variant])
    return F.regexp_replace(x, rf"\A(?:{aliases})\z", HCMC)


def _prefix_pattern(prefixes: list[str]) -> str:
    """Prefixes that go in turn, as one pattern.

    Any of them may come first; each later one may follow if text remains behind it.
    """
    starts = []
    for i, first in enumerate(prefixes):
        later = "".join(rf"(?:{p} *(?=[^ ]))?" for p in prefixes[i + 1:])
        starts.append(rf"{first} *{later}")
    return rf"\A(?:{'|'.join(starts)})(.*?) *\z"


def _strip_prefixes(x: Column, prefixes: list[str]) -> Column:
    # only a value that carried a prefix is trimmed again
    return _or_default(F.regexp_replace(x, _prefix_pattern(prefixes), "$1"))


def _drop_brackets(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r" *\(.*?\) *", ""))


def normalize_district(c: Column, variant: str = "fixed") -> Column:
    _check_variant(variant)
    x = _squeeze(c)
    if variant == "fixed":
        x = _drop_brackets(x)
    for old, new in DISTRICT_REWRITES:
        x = F.replace(x, F.lit(old), F.lit(new))
    return _strip_prefixes(x, DISTRICT_PREFIXES)


def normalize_ward(c: Column, variant: str = "fixed") -> Column:
    _check_variant(variant)
    x = _squeeze(c)
    if variant == "fixed":
        x = _drop_brackets(x)
    return _strip_prefixes(x, WARD_PREFIXES)


def normalize_direction(c: Column, variant: str = "fixed") -> Column:
    """Compass names stay, numeric codes are unknown; other text only ``merge`` keeps."""
    _check_variant(variant)
    x = _squeeze(c)
    if variant == "merge":
        return _or_default(x, words=r"\d+(?:\.0)?|(?i:nan|none)")
    return F.coalesce(F.try_element_at(_literal_map({name: name for name in COMPASS}), x), F.lit(UNKNOWN))


def extract_district(c: Column) -> Column:
    """First district-like phrase of an address; the pattern order decides, not the position."""
    x = normalize_text(c)
    found = [F.nullif(F.regexp_extract(x, rf"(?iuU){p}", 1), F.lit("")) for p in DISTRICT_PATTERNS]
    return normalize_text(F.coalesce(*found))
