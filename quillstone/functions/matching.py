"""Text normalisation, code families and bit masks of description matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hospital prefixes, abbreviations and units of the normaliser.
PREFIXES = ("hc", "pr", "hb", "hchg", "chg")
ABBREVIATIONS = {
    "inj": "injection", "injs": "injection", "cath": "catheter", "fem": "femoral", "tib": "tibial", "cann": "cannulated", "spn": "spine", "iol": "intraocular lens",
    "imp": "implant", "stnt": "stent", "strl": "sterile", "bln": "balloon", "cort": "cortical", "lok": "locking", "ins": "insert", "proc": "procedure",
    "ct": "computed tomography", "us": "ultrasound", "mri": "magnetic resonance imaging", "iv": "intravenous", "po": "oral", "im": "intramuscular", "sc": "subcutaneous",
    "rt": "right", "lt": "left", "bilat": "bilateral", "ea": "each", "addl": "additional", "add'l": "additional", "sngl": "single", "unlis": "unlisted",
}
UNITS = ("mg", "ml", "mm", "cm", "gm", "g", "mcg", "unit", "units", "iu")


def normalize_text(raw: Column) -> Column:
    """Lower case, words only, leading hospital prefixes dropped, units split off, abbreviations spelled out. Idempotent."""
    text = F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), r"\bw/o\b", " without ")
    text = F.regexp_replace(text, r"\bw/(?=\s|$|[a-z])", " with ")
    words = F.filter(F.split(text, "[^a-z0-9']+"), lambda w: w != "")
    starts = F.array_position(F.transform(words, lambda w: ~w.isin(*PREFIXES)), True)
    kept = F.when(starts > 0, F.slice(words, F.greatest(starts, F.lit(1)).cast("int"), F.greatest(F.size(words), F.lit(1)))).otherwise(F.array().cast("array<string>"))
    apart = F.filter(F.split(F.array_join(F.transform(kept, lambda w: F.regexp_replace(w, f"^([0-9]+)({'|'.join(UNITS)})$", "$1 $2")), " "), " "), lambda w: w != "")
    known = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    return F.array_join(F.transform(apart, lambda w: F.coalesce(F.try_element_at(known, w), w)), " ")


def code_family(code: Column) -> Column:
    c = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    return (
        F.when(c.rlike("^[0-9]{5}$"), "cpt_numeric").when(c.rlike("^[0-9]{3}$"), "ms_drg").when(F.startswith(c, F.lit("J")), "drug_J")
        .when(c.rlike("^[CLVEGKPQRSTABDHM].{4}$"), "device_or_other_hcpcs").otherwise("other")
    )


def allowed_outside(mask: Column, own: Column) -> Column:
    """Whether an entry has evidence beyond one's own bit; an unknown hospital has bit 0, so anything is allowed."""
    return mask.bitwiseAND(F.bitwise_not(F.coalesce(own, F.lit(0).cast("long")))) != 0
