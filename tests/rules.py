"""The rules in plain Python, one asset at a time; slow and independent of the plans."""

from collections import defaultdict

from gapwise import config as c


def _number(text):
    try:
        return int(text)
    except (TypeError, ValueError):
        return None


def _index(rows, key, value):
    """Values per key; as in SQL a NULL key matches nothing."""
    found = defaultdict(list)
    for row in rows:
        if row[key] is not None:
            found[row[key]].append(value(row))
    return found


def _agreements(t):
    rows = [r for r in t["agreement_contract"] if r["agreement_id"] is not None]
    return _index(rows, "contract_id", lambda r: r["agreement_id"])


def _usable(value):
    return value is not None and value >= 1


def _located(addresses, site):
    if site is None:
        return bool(addresses)
    return any(_usable(a["ucid"] if site == 6 else a["customer_num"]) for a in addresses)


def report(t, cfg):
    """(asset, contract, label, original) for lists of dicts per table."""
    contracts = {r["contract_id"]: r for r in t["contract"]}
    sites = {r["agreement_id"]: r["source_site_id"] for r in t["agreement"]}
    address = {r["party_address_id"]: r for r in t["party_address"]}
    covers = _index(t["contract_coverage"], "asset_id", lambda r: r["contract_id"])
    agreements = _agreements(t)
    assets_of = _index(t["agreement_asset"], "agreement_id", lambda r: r["asset_id"])

    def addresses(link, key):
        return _index(
            [r for r in t[link] if r["party_address_id"] in address],
            key,
            lambda r: address[r["party_address_id"]],
        )

    of_agreement = addresses("party_address_agreement", "agreement_id")
    of_asset = addresses("party_address_asset", "asset_id")
    originals = _index(
        [r for r in t["asset_relationship"] if r["relationship_type_id"] == cfg.relationship_type],
        "from_asset_id",
        lambda r: r["to_asset_id"],
    )
    serialized = {
        _number(r["identifier_value"])
        for r in t["contract_identifier"]
        if r["identifier_type_id"] == cfg.dual_serial_identifier_type
    }
    instructed = {
        _number(r["entity_value"])
        for r in t["instruction"]
        if r["entity_type_id"] == cfg.instruction_entity_type
    }
    counterparts = _index(
        [r for r in t["agreement_identifier"]
         if r["identifier_type_id"] in cfg.counterpart_identifier_types
         and _number(r["identifier_value"]) is not None],
        "agreement_id",
        lambda r: _number(r["identifier_value"]),
    )
    mapping = [
        r for r in t["item_mapping"]
        if r["application_id"] == cfg.mapping_application and r["map_type_id"] in cfg.mapping_types
    ]

    def label(asset, contract):
        number = contract["contract_id"]
        if number in serialized:
            return c.DUAL_SERIALIZED
        if contract["item_num"] in cfg.ineligible_items:
            return c.NOT_ELIGIBLE
        own = min(agreements[number], default=None)
        if own is not None:
            other = min(counterparts[own], default=None)
            if other is None:
                return c.AGREEMENT_NOT_FOUND
            if not assets_of[other]:
                return c.AGREEMENT_WITHOUT_ASSET
            if asset["asset_id"] not in assets_of[other]:
                return c.AGREEMENT_OTHER_ASSET
            if not _located(of_agreement[other], sites.get(other)):
                return c.LOCATION_NOT_FOUND
        elif not _located(of_asset[asset["asset_id"]], asset["source_site_id"]) and not _usable(
            asset["customer_num"]
        ):
            return c.CUSTOMER_NOT_FOUND
        special = contract["source_site_id"] == cfg.special_site
        item = contract["item_num"]
        if item is None or not any(
            r["item_num_a" if special else "item_num_b"] == item for r in mapping
        ):
            return c.MAPPING_MISSING
        if not any(
            r["item_num"] == item
            and r["source_site_id"] is not None
            and (r["source_site_id"] == cfg.special_site) != special
            for r in t["item_main"]
        ):
            return c.MAIN_ITEM_MISSING
        if number in instructed:
            return c.INSTRUCTION_ERROR
        return c.AGREEMENT_OTHER if own is not None else c.OTHER

    out = []
    for asset in t["asset"]:
        if (
            asset["create_pgm"] not in cfg.programs
            or asset["order_num"] != cfg.placeholder_order
            or not cfg.window_start <= str(asset["created_at"]) < cfg.window_end
            or any(n in contracts for n in covers[asset["asset_id"]])
        ):
            continue
        mine = {o for o in originals[asset["asset_id"]] if o is not None}
        if not mine:
            out.append((asset["asset_id"], None, c.ORIGINAL_NOT_FOUND, None))
            continue
        via = {}
        for original in sorted(mine):
            for number in covers[original]:
                if number in contracts:
                    via.setdefault(number, original)
        if not via:
            out.append((asset["asset_id"], None, c.ORIGINAL_WITHOUT_ENTITLEMENT, min(mine)))
        for number, original in via.items():
            out.append((asset["asset_id"], number, label(asset, contracts[number]), original))
    return out


def coalesced(t, cfg, labelled):
    """The coalesced status for the (asset, contract) pairs of :func:`report`."""
    contracts = {r["contract_id"]: r for r in t["contract"]}
    agreements = _agreements(t)
    counterparts = _index(
        [r for r in t["agreement_identifier"]
         if r["identifier_type_id"] in cfg.counterpart_identifier_types
         and _number(r["identifier_value"]) is not None],
        "agreement_id",
        lambda r: _number(r["identifier_value"]),
    )
    linked = {r["agreement_id"] for r in t["party_address_agreement"]} - {None}
    mapped = {
        r[side] for r in t["item_mapping"] for side in ("item_num_a", "item_num_b")
        if r["application_id"] == cfg.mapping_application and r["map_type_id"] in cfg.mapping_types
    } - {None}
    mains = {r["item_num"] for r in t["item_main"]}
    out = []
    for asset, number, _, _ in labelled:
        if number is None:
            out.append((asset, None, None))
            continue
        item = contracts[number]["item_num"]
        other = min(counterparts[min(agreements[number], default=None)], default=None)
        if other not in linked:
            text = c.LOCATION_NOT_FOUND
        elif item not in mapped:
            text = c.MAPPING_MISSING
        elif item not in mains:
            text = c.MAIN_ITEM_MISSING
        else:
            text = c.OTHER
        out.append((asset, number, text))
    return out
