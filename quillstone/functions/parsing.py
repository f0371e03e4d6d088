"""Row-level parsing as column expressions: amounts, code types, primary codes and item validation."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_MAX = 100_000_000
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Code-type spellings, and the order in which a primary code is chosen.
TYPE_ALIASES = {
    "CPT": "CPT", "CPT-4": "CPT", "HCPCS": "HCPCS", "MS-DRG": "MS-DRG", "MSDRG": "MS-DRG", "DRG": "MS-DRG", "APR-DRG": "APR-DRG",
    "ICD-10-PCS": "ICD-10-PCS", "ICD10PCS": "ICD-10-PCS", "NDC": "NDC", "CDM": "CDM", "RC": "RC", "LOCAL": "LOCAL", "EAPG": "OTHER", "TRIS-DRG": "OTHER", "APC": "OTHER",
}
CODE_PRIORITY = ("CPT", "HCPCS", "MS-DRG", "APR-DRG", "ICD-10-PCS", "NDC", "CDM", "RC", "LOCAL", "OTHER")
SETTINGS = ("inpatient", "outpatient", "both")
BILLING_CLASSES = ("facility", "professional", "both")


#: White space of any kind, as Unicode has it, with the separators 0x1c to 0x1f.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Decimal digits of all scripts, and what each is worth.
_DIGITS = [c for c in map(chr, range(128, 0x20000)) if c.isdecimal()]


def amount_text(raw: Column) -> Column:
    """raw without currency signs, thousands separators and white space."""
    return F.regexp_replace(raw, rf"[,${SPACE}]", "")


def number_text(text: Column) -> Column:
    """text without digit-group underscores, with digits of any script as 0-9; only text that is not ASCII is translated."""
    plain = F.replace(text, F.lit("_"), F.lit(""))
    digits = F.translate(plain, "".join(_DIGITS), "".join(str(unicodedata.decimal(c)) for c in _DIGITS))
    return F.when(plain.rlike(r"[^\x00-\x7f]"), digits).otherwise(plain)


def amount_reason(raw: Column, limit: float = AMOUNT_MAX) -> Column:
    """Why raw is no amount: null for an amount and for a blank cell, which is no error."""
    text = amount_text(raw)
    number = number_text(text)
    value, exact = number.try_cast("double"), number.try_cast("decimal(38,18)")
    blank = raw.isNull() | (text == "") | F.lower(text).isin("null", "none")
    return (
        F.when(blank, F.lit(None).cast("string")).when(~number.rlike(NUMBER), "non_numeric_amount").when(value <= 0, "non_positive_amount")
        .when(F.coalesce(exact > F.lit(limit).cast("decimal(38,18)"), value > limit), "above_plausible_max").when(_quantized(number) <= 0, "non_positive_amount")
    )


def _quantized(number: Column) -> Column:
    """Four decimals, half to even."""
    return F.bround(number.try_cast("decimal(38,18)"), 4).cast("decimal(14,4)")


def amount_value(raw: Column, limit: float = AMOUNT_MAX) -> Column:
    """The amount with four decimals, half to even; null for blanks and rejects."""
    number = number_text(amount_text(raw))
    return F.when(amount_reason(raw, limit).isNull() & number.rlike(NUMBER), _quantized(number))


def code_type(raw: Column) -> Column:
    """The canonical code type; OTHER for spellings that are not known."""
    known = F.create_map(*[F.lit(x) for pair in TYPE_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.upper(F.trim(F.coalesce(raw, F.lit(""))))), F.lit("OTHER"))


def ordered_codes(pairs: Column) -> Column:
    """(priority, place, type, code) of the non-blank codes of an array of (code, raw_type), best first."""
    rank = F.create_map(*[x for i, t in enumerate(CODE_PRIORITY) for x in (F.lit(t), F.lit(i))])
    named = F.transform(pairs, lambda p, i: F.struct(F.element_at(rank, code_type(p["raw_type"])).alias("priority"), i.alias("place"), code_type(p["raw_type"]).alias("type"), F.trim(p["code"]).alias("code")))
    return F.array_sort(F.filter(named, lambda p: p["code"].isNotNull() & (p["code"] != "")))


def primary_code(ordered: Column) -> Column:
    return F.get(ordered, F.lit(0))["code"]


def primary_type(ordered: Column) -> Column:
    return F.get(ordered, F.lit(0))["type"]


def alternative_codes(ordered: Column) -> Column:
    """The other codes as TYPE:code|TYPE:code."""
    return F.array_join(F.transform(F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))), lambda p: F.concat(p["type"], F.lit(":"), p["code"])), "|")


def enum_value(raw: Column) -> Column:
    """Trimmed and in lower case; null for blank."""
    text = F.lower(F.trim(raw))
    return F.when(text != "", text)


def item_reason(description: Column, primary: Column, setting: Column, billing_class: Column, settings: tuple[str, ...] = SETTINGS, classes: tuple[str, ...] = BILLING_CLASSES) -> Column:
    """The first failing check of an item; null if it passes."""
    return (
        F.when(F.coalesce(F.trim(description), F.lit("")) == "", "missing_description").when(primary.isNull(), "no_code")
        .when(F.coalesce(~enum_value(setting).isin(*settings), F.lit(False)), "invalid_setting").when(F.coalesce(~enum_value(billing_class).isin(*classes), F.lit(False)), "invalid_billing_class")
    )
