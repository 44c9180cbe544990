"""Values of one business: passed to the dataset plans, never built into an operator."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Rules:
    """What a business calls its brands, divisions, groups and places."""

    excluded_brands: tuple[str, ...] = ()
    # LIKE pattern -> division, first match wins
    division_patterns: tuple[tuple[str, str], ...] = ()
    # exact brand -> division, used by schemes
    brand_divisions: dict[str, str] = field(default_factory=dict)
    # receivables: patterns of divisions named explicitly, everything else is the default
    receivable_patterns: tuple[tuple[str, str], ...] = ()
    receivable_default: str | None = None
    # items of this brand are shown under their catalogue code
    catalogue_brand: str | None = None
    warehouse: str = ""
    core_shade: str = "Core item"
    image_groups: tuple[str, ...] = ()
    partner_type: str = "C"
    dealer_groups: tuple[str, ...] = ("100", "106")
    dealer_name: str = "Dealer"
    default_currency: str = "INR"
    transporter: str = ""
    contact_role: str = "proprietor"
    # (division, sub-brand, discount column)
    sub_brands: tuple[tuple[str, str, str], ...] = ()
    discount_name: str = "TRADE DISCOUNT"
    discount_from: str = "2019-04-01T00:00:00"
    discount_to: str = "2030-03-31T00:00:00"
    saving_types: dict[str, str] = field(
        default_factory=lambda: {"Quantity": "SC", "Percentage": "DIS"}
    )
    scheme_roles: tuple[str, ...] = ("RBM", "SE")
    scheme_category: str = "DEALER"
    scheme_end: str = "2026-12-31T00:00:00"
    # window of the scheme worklist
    scheme_list_from: str = "2025-07-01 00:00:00"
    scheme_list_to: str = "2026-05-31 00:00:00"
    price_end: str = "2060-12-31T00:00:00"
    tax_split: int = 2500
    tax_remap: dict[str, str] = field(default_factory=lambda: {"12.00": "18.00"})
    timezone: str | None = None

    @classmethod
    def from_json(cls, path: str) -> Rules:
        """Rules from a JSON file; lists become tuples, unknown names are refused."""
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        unknown = set(given) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown rules: {sorted(unknown)}")
        return cls(**{k: _frozen(v) for k, v in given.items()})


def _frozen(value):
    return tuple(_frozen(v) for v in value) if isinstance(value, list) else value
