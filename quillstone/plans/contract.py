"""Contracts: what a source's files must look like, and what is only worth a warning."""

from __future__ import annotations

from dataclasses import dataclass, field

from quillstone.functions.parsing import BILLING_CLASSES, SETTINGS

# Column names of the price-transparency templates.
WIDE_GROUPS = ("standard_charge", "estimated_amount", "median_amount", "10th_percentile", "90th_percentile", "count", "additional_payer_notes")
WIDE_SUFFIXES = ("negotiated_dollar", "negotiated_percentage", "negotiated_algorithm", "methodology")
GENERIC_COLUMNS = {"gross": "standard_charge|gross", "cash": "standard_charge|discounted_cash", "min": "standard_charge|min", "max": "standard_charge|max"}
CANDIDATES = ("description", "code|1", "code|1|type", "setting", "billing_class", *GENERIC_COLUMNS.values())
TALL_CANDIDATES = (*CANDIDATES, "payer_name", "plan_name", "standard_charge|negotiated_dollar")
JSON_REQUIRED = ("hospital_name", "last_updated_on", "version", "standard_charge_information")


@dataclass(frozen=True)
class Contract:
    source: str
    layout: str
    accepted_template_versions: tuple[str, ...]
    required_columns: tuple[str, ...] = ()
    contract_version: int = 1
    deprecated_template_versions: tuple[str, ...] = ()
    expected_fixed_columns: tuple[str, ...] = ()
    known_deviations: tuple[str, ...] = ()
    allowed_settings: tuple[str, ...] = SETTINGS
    allowed_billing_classes: tuple[str, ...] = BILLING_CLASSES
    amount_max: float = 1e8
    max_reject_rate: float = 0.20
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.layout not in ("csv_tall", "csv_wide", "json"):
            raise ValueError(f"unknown layout {self.layout}")


def split_wide_header(column: str) -> tuple[str, str, str, str] | None:
    """(group, payer, plan, suffix) of a payer column; None for others. A plan may hold bars; payer and plan must both be there."""
    group, *rest = column.split("|")
    if group not in WIDE_GROUPS or len(rest) < 2 or column in GENERIC_COLUMNS.values():
        return None
    suffix = rest.pop() if rest[-1] in WIDE_SUFFIXES else ""
    return (group, rest[0], "|".join(rest[1:]), suffix) if len(rest) > 1 else None


def fixed_columns(layout: str, columns: list[str]) -> list[str]:
    return [c for c in columns if layout == "csv_tall" or split_wide_header(c) is None]


def validate_header(contract: Contract, layout: str, version: str | None, columns: list[str]) -> tuple[list[str], list[str]]:
    """(errors, warnings): errors quarantine a file."""
    errors, warnings = [], []
    if layout != contract.layout:
        errors.append(f"layout is {layout}, not {contract.layout}")
    if version not in contract.accepted_template_versions:
        errors.append(f"template version {version!r} is not accepted")
    elif version in contract.deprecated_template_versions:
        warnings.append(f"template version {version} is deprecated")
    present = set(columns)
    if missing := [c for c in contract.required_columns if c not in present]:
        errors.append(f"required columns are missing: {missing}")
    if contract.layout != "json" and contract.expected_fixed_columns:
        now, expected = set(fixed_columns(contract.layout, columns)), set(contract.expected_fixed_columns)
        for what, drift in (("new", now - expected), ("gone", expected - now)):
            if drift:
                warnings.append(f"{what} columns: {sorted(drift)[:8]}")
    return errors, warnings


def derive(source: str, found: dict) -> Contract:
    """A contract from a file's profile; files of the old template may move to the current one."""
    layout, version, columns = found["layout"], found["declared_version"], found["columns"]
    wanted = JSON_REQUIRED if layout == "json" else TALL_CANDIDATES if layout == "csv_tall" else CANDIDATES
    old = version == "2.0.0"
    return Contract(
        source, layout, ("2.0.0", "3.0.0") if old else (version,), tuple(c for c in wanted if c in columns), deprecated_template_versions=("2.0.0",) if old else (),
        expected_fixed_columns=() if layout == "json" else tuple(fixed_columns(layout, columns)), known_deviations=tuple(f"no column {c}" for c in wanted if c not in columns),
    )
