"""Rule constants of the root cause analysis, and the label texts."""

from __future__ import annotations

from dataclasses import dataclass, field

# They must equal the source rules for the results to be right.
PROGRAMS = (
    "AC_NG.DS.SW_AS_A.CRI",
    "AC_NG.DS.SW_A.CRY",
    "AC_NG.DUAL_SRL_INS.ASSET",
)

# Item numbers that can not be dual serialized.
INELIGIBLE_ITEMS = (
    "709-BBEW", "865-BCFG", "709-BBOR", "865-BCFF", "303-11289", "865-BCFD",
    "709-BBEX", "199-BBJQ", "865-BCFE", "865-BCFK", "709-BBTV", "709-BBNG",
    "862-BBXI", "303-11291", "303-11290", "865-BCFJ", "199-BBMF", "865-BBJP",
    "303-11466", "142-BBNV", "149-BBGI", "149-BBGK", "151-BBEH", "151-BBGU",
    "151-BBHJ", "151-BBHY", "151-BBIY", "151-BBJB", "151-BBJE", "151-BBJF",
    "151-BBJP", "456-109-802", "456-109-803", "456-109-804", "456-109-805",
    "456-111-473", "456-111-474", "456-111-475", "456-111-476", "528-BYHE",
    "528-BYHF",
)

# The labels, in order of precedence.
ORIGINAL_NOT_FOUND = "Original asset not found"
ORIGINAL_WITHOUT_ENTITLEMENT = "Original Asset Without Entitlement"
DUAL_SERIALIZED = "Original entitlement dual serialized to different asset"
NOT_ELIGIBLE = "SKU not eligible"
AGREEMENT_NOT_FOUND = "CounterPart Agreement Not Found"
AGREEMENT_WITHOUT_ASSET = "Missing Agreement/Asset Relationship"
AGREEMENT_OTHER_ASSET = "CounterPart Agreement Linked to Non-Mapped Asset"
LOCATION_NOT_FOUND = "PartyLocation not found"
CUSTOMER_NOT_FOUND = "Customer not found in counterpart asset"
MAPPING_MISSING = "Missing Item Material Mapping"
MAIN_ITEM_MISSING = "Missing Global Item Main"
INSTRUCTION_ERROR = "Instruction in Error"
AGREEMENT_OTHER = "[AGREEMENT] Other"
OTHER = "Other"


@dataclass(frozen=True)
class RuleConfig:
    """Constants of the rules. Every one can be replaced for another data set."""

    programs: tuple[str, ...] = PROGRAMS
    placeholder_order: int = 99999
    window_start: str = "2023-10-01 00:00:00"
    #: first instant after the window, or its last one if ``window_inclusive``
    window_end: str = "2023-11-01 00:00:00"
    window_inclusive: bool = False
    relationship_type: int = 9
    dual_serial_identifier_type: int = 106
    counterpart_identifier_types: tuple[int, ...] = (111, 112)
    ineligible_items: tuple[str, ...] = field(default=INELIGIBLE_ITEMS)
    special_site: int = 6
    mapping_application: int = 33
    mapping_types: tuple[int, ...] = (1, 3, 4, 5, 6)
    instruction_entity_type: int = 1
