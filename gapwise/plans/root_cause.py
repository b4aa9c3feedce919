"""Why has an asset no contract? The analysis, one function per step.

Grain is what makes this hold on large tables. Each fact is found at the
smallest grain that has it (asset, contract, agreement, counterpart agreement,
item) and travels up once, over a key whose hot values are known from a base
table:

    counterpart agreement -> agreement -> contract -> (original, contract)
                                  item -> contract          |
                                  asset -> (asset, original) -> (asset, contract)

Frames that several steps read are written once, so that Spark knows their size and
they know their own hot keys. Tables are cut to the keys in use by semi joins, which
Spark broadcasts or shuffles by that size; there is one plan for few and for many
candidates. Pairs of assets and contracts are found with their keys alone and get
facts and asset columns at the end, once each.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise import config
from gapwise.config import RuleConfig
from gapwise.functions.predicates import address_usable, in_time_range, unusable_id, usable_id
from gapwise.functions.scalars import id_from_text
from gapwise.operators.facts import any_true, gather_facts
from gapwise.operators.joins import exists_flag, two_hop_absence, two_key_column_lookup, unique_rows
from gapwise.operators.skew import HotKeys, left_spread_join, lookup_join, spread_join, without_partner
from gapwise.operators.staging import Staged, cut_to_keys, is_broadcast, stage
from gapwise.sources.tables import TableSet, scan

#: source column -> report column
ASSET_COLUMNS = {
    "asset_id": "asset_id",
    "serial_num": "serial_num",
    "manufacturer_id": "manufacturer_id",
    "item_class": "item_class",
    "source_site_id": "site",
    "customer_num": "customer_num",
}

REPORT_COLUMNS = (
    *ASSET_COLUMNS.values(),
    "original_asset_id",
    "contract_id",
    "item_num",
    "contract_site",
    "is_dual_serialized",
    "is_ineligible_item",
    "agreement_id",
    "cp_agreement_id",
    "cp_site",
    "cp_contract_id",
    "has_any_asset",
    "has_this_asset",
    "location_ok",
    "customer_ok",
    "mapped_item",
    "has_main_item",
    "has_instruction",
    "root_cause",
)


# --- assets ------------------------------------------------------------------


def candidate_assets(tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Assets of the programs, the placeholder order and the window; all of it is pushed down."""
    asset = tables["asset"].where(
        F.col("create_pgm").isin(*cfg.programs)
        & (F.col("order_num") == cfg.placeholder_order)
        & in_time_range(
            F.col("created_at"), cfg.window_start, cfg.window_end, cfg.window_inclusive
        )
    )
    return unique_rows(scan({"asset": asset}, "asset", ASSET_COLUMNS), ["asset_id"])


def without_contract(assets: DataFrame, tables: TableSet) -> DataFrame:
    """Assets that reach no existing contract through coverage."""
    return two_hop_absence(
        assets,
        tables["contract_coverage"],
        tables["contract"],
        "asset_id",
        "contract_id",
        hot_key=lambda: tables.hot("contract_coverage", "asset_id"),
        hot_target=lambda: tables.hot("contract_coverage", "contract_id"),
    )


def assets_without_contract(tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """One row per asset."""
    return without_contract(stage(candidate_assets(tables, cfg), tables.skew).df, tables)


def original_asset(assets: DataFrame, tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Add ``original_asset_id``; one row per asset and original, NULL if there is none."""
    relation = (
        scan(
            tables,
            "asset_relationship",
            {
                "from_asset_id": "asset_id",
                "to_asset_id": "original_asset_id",
                "relationship_type_id": "kind",
            },
        )
        .where((F.col("kind") == cfg.relationship_type) & F.col("original_asset_id").isNotNull())
        .select("asset_id", "original_asset_id")
    )

    def hot() -> HotKeys:
        return tables.hot("asset_relationship", "from_asset_id")

    relation = cut_to_keys(relation, assets, "asset_id", hot, ["original_asset_id"]).distinct()
    return left_spread_join(
        assets, relation, ["asset_id"], hot_right=hot(), spread_right=["original_asset_id"]
    )


# --- contracts ---------------------------------------------------------------


def covered_contracts(links: DataFrame, tables: TableSet) -> DataFrame:
    """``(original_asset_id, contract_id)`` for the originals in ``links``, each pair once."""
    coverage = scan(
        tables,
        "contract_coverage",
        {"asset_id": "original_asset_id", "contract_id": "contract_id"},
    )
    return cut_to_keys(
        coverage,
        links,
        "original_asset_id",
        lambda: tables.hot("contract_coverage", "asset_id"),
        ["contract_id"],
    ).distinct()


def contract_rows(covered: DataFrame, tables: TableSet) -> DataFrame:
    """Existing contracts among the covered ones, one row per contract."""
    contract = scan(
        tables,
        "contract",
        {"contract_id": "contract_id", "item_num": "item_num", "source_site_id": "contract_site"},
    )
    return unique_rows(cut_to_keys(contract, covered, "contract_id"), ["contract_id"], named=True)


def contract_pairs(links: Staged, covered: Staged, existing: DataFrame, tables: TableSet) -> Staged:
    """``(asset_id, contract_id, original_asset_id)``, one row per asset and contract.

    An asset that reaches a contract through several originals keeps the lowest one.
    Only these keys are shuffled: they are made distinct before anything is attached.
    """
    reaching = cut_to_keys(
        covered.df, existing, "contract_id", lambda: covered.hot("contract_id"), ["original_asset_id"]
    )
    reached = spread_join(
        links.df,
        reaching,
        ["original_asset_id"],
        hot_left=links.hot("original_asset_id"),
        hot_right=covered.hot("original_asset_id"),
        spread_left=["asset_id"],
        spread_right=["contract_id"],
    )
    pairs = reached.groupBy("asset_id", "contract_id").agg(
        F.min("original_asset_id").alias("original_asset_id")
    )
    return stage(pairs, tables.skew)


def attach(
    assets: DataFrame, links: DataFrame, pairs: Staged, facts: DataFrame
) -> DataFrame:
    """One row per asset and contract, and one per asset that has no contract.

    ``assets`` has one row per asset and ``facts`` one per contract. An asset without a
    contract keeps its lowest original. Both are attached to the pairs once, by keys
    whose hot values the written pairs know.
    """
    lowest = links.groupBy("asset_id").agg(F.min("original_asset_id").alias("original_asset_id"))
    alone = without_partner(lowest, pairs.df, ["asset_id"])
    rows = pairs.df.unionByName(alone, allowMissingColumns=True)
    rows = lookup_join(
        rows, facts, ["contract_id"], hot=pairs.hot("contract_id"), spread=["asset_id"]
    )
    hot = pairs.hot("asset_id")
    if not hot:
        return assets.join(rows, "asset_id")
    return spread_join(rows, assets, ["asset_id"], hot_left=hot, spread_left=["contract_id"])


def original_contracts(assets: DataFrame, tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Contracts of the original assets, reached through coverage; ``assets`` has one row per asset."""
    links = stage(original_asset(assets.select("asset_id"), tables, cfg), tables.skew)
    covered = stage(covered_contracts(links.df, tables), tables.skew)
    contracts = stage(contract_rows(covered.df, tables), tables.skew).df
    return attach(assets, links.df, contract_pairs(links, covered, contracts, tables), contracts)


# --- facts about a contract; frames have one row per contract ----------------
#
# The ``*_rows`` functions give one fact each as (key, value) rows. Facts with
# the same key are then gathered by a single shuffle, whatever their number.


def dual_serial_rows(tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """The value of an identifier of this type is the contract it stands for."""
    return (
        tables["contract_identifier"]
        .where(F.col("identifier_type_id") == cfg.dual_serial_identifier_type)
        .select(
            id_from_text(F.col("identifier_value")).alias("contract_id"),
            F.lit(True).alias("is_dual_serialized"),
        )
    )


def instruction_rows(tables: TableSet, cfg: RuleConfig) -> DataFrame:
    return (
        tables["instruction"]
        .where(F.col("entity_type_id") == cfg.instruction_entity_type)
        .select(
            id_from_text(F.col("entity_value")).alias("contract_id"),
            F.lit(True).alias("has_instruction"),
        )
    )


def contract_agreement_rows(tables: TableSet) -> DataFrame:
    return tables["agreement_contract"].select("contract_id", "agreement_id")


DUAL_SERIALIZED = {"is_dual_serialized": any_true}
HAS_INSTRUCTION = {"has_instruction": any_true}
LOWEST_AGREEMENT = {"agreement_id": F.min}


def ineligible_item(contracts: DataFrame, cfg: RuleConfig) -> DataFrame:
    listed = F.coalesce(F.col("item_num").isin(*cfg.ineligible_items), F.lit(False))
    return contracts.withColumn("is_ineligible_item", listed)


def contract_preclass(contracts: DataFrame, tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Add ``is_dual_serialized`` and ``is_ineligible_item``."""
    flagged = gather_facts(
        contracts, "contract_id", [dual_serial_rows(tables, cfg)], DUAL_SERIALIZED
    )
    return ineligible_item(flagged, cfg)


def instruction_check(contracts: DataFrame, tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Add ``has_instruction``."""
    return gather_facts(
        contracts, "contract_id", [instruction_rows(tables, cfg)], HAS_INSTRUCTION
    )


def contract_agreement(
    contracts: DataFrame, tables: TableSet, used: DataFrame | None = None
) -> DataFrame:
    """Add ``agreement_id``, the lowest one of the contract."""
    return gather_facts(
        contracts, "contract_id", [contract_agreement_rows(tables)], LOWEST_AGREEMENT, used
    )


def contract_facts(
    contracts: DataFrame, tables: TableSet, cfg: RuleConfig, used: DataFrame | None = None
) -> DataFrame:
    """All of the above at once."""
    gathered = gather_facts(
        contracts,
        "contract_id",
        [
            dual_serial_rows(tables, cfg),
            instruction_rows(tables, cfg),
            contract_agreement_rows(tables),
        ],
        DUAL_SERIALIZED | HAS_INSTRUCTION | LOWEST_AGREEMENT,
        used,
    )
    return ineligible_item(gathered, cfg)


def distinct_agreements(contracts: DataFrame) -> DataFrame:
    return contracts.select("agreement_id").where(F.col("agreement_id").isNotNull()).distinct()


def counterpart_of(
    agreements: DataFrame, tables: TableSet, cfg: RuleConfig, used: DataFrame | None = None
) -> DataFrame:
    """Add ``cp_agreement_id`` to one row per agreement; the lowest value wins."""
    identifiers = (
        tables["agreement_identifier"]
        .where(F.col("identifier_type_id").isin(*cfg.counterpart_identifier_types))
        .select("agreement_id", id_from_text(F.col("identifier_value")).alias("cp_agreement_id"))
    )
    return gather_facts(agreements, "agreement_id", [identifiers], {"cp_agreement_id": F.min}, used)


def attach_agreements(contracts: DataFrame, agreements: DataFrame, hot: HotKeys) -> DataFrame:
    """Bring facts about agreements to the contracts; contracts without one stay.

    ``hot`` has hot values of the contracts' ``agreement_id``.
    """
    return lookup_join(contracts, agreements, ["agreement_id"], hot=hot, spread=["contract_id"])


def counterpart_agreement(contracts: DataFrame, tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Add ``agreement_id`` and ``cp_agreement_id``."""
    contracts = contract_agreement(contracts, tables)
    agreements = counterpart_of(distinct_agreements(contracts), tables, cfg)
    return attach_agreements(contracts, agreements, tables.hot("agreement_contract", "agreement_id"))


# --- facts about a counterpart agreement; frames have one row per agreement --


def distinct_counterparts(df: DataFrame) -> DataFrame:
    return df.select("cp_agreement_id").where(F.col("cp_agreement_id").isNotNull()).distinct()


def counterpart_site_rows(tables: TableSet) -> DataFrame:
    site = scan(
        tables, "agreement", {"agreement_id": "cp_agreement_id", "source_site_id": "cp_site"}
    )
    return site.withColumn("_agreements", F.lit(1))


def counterpart_contract_rows(tables: TableSet) -> DataFrame:
    return scan(
        tables,
        "agreement_contract",
        {"agreement_id": "cp_agreement_id", "contract_id": "cp_contract_id"},
    )


def counterpart_asset_rows(tables: TableSet) -> DataFrame:
    return scan(
        tables, "agreement_asset", {"agreement_id": "cp_agreement_id", "asset_id": "asset_id"}
    )


def any_asset_rows(tables: TableSet) -> DataFrame:
    return counterpart_asset_rows(tables).select(
        "cp_agreement_id", F.lit(True).alias("has_any_asset")
    )


def address_rows(
    link: DataFrame, tables: TableSet, hot: HotKeys | None = None, spread: str = "party_address_id"
) -> DataFrame:
    """A link's rows with their address: its customer number, its ucid; an id has one address."""
    address = scan(
        tables,
        "party_address",
        {
            "party_address_id": "party_address_id",
            "customer_num": "address_customer_num",
            "ucid": "ucid",
        },
    )
    return spread_join(
        link,
        unique_rows(address, ["party_address_id"], named=True),
        ["party_address_id"],
        hot_left=hot,
        spread_left=[spread],
    )


def usable_address_rows(addresses: DataFrame, key: str) -> DataFrame:
    """For each key and address: is its id usable for the special, for other sites?"""
    return addresses.select(
        key,
        usable_id(F.col("ucid")).alias("_special_ok"),
        usable_id(F.col("address_customer_num")).alias("_regular_ok"),
        F.lit(True).alias("_address"),
    )


def _addresses_of(
    used: DataFrame, tables: TableSet, name: str, columns: dict[str, str], key: str
) -> DataFrame:
    """Addresses that a link table has for the keys in use.

    The link is cut to these keys before it meets an address.
    """
    link = scan(tables, name, columns)
    if is_broadcast(used.select(key)):
        return address_rows(cut_to_keys(link, used, key), tables)
    of_key = next(c for c, alias in columns.items() if alias == key)
    link = cut_to_keys(link, used, key, lambda: tables.hot(name, of_key), ["party_address_id"])
    return address_rows(link, tables, tables.hot(name, "party_address_id"), key)


def location_addresses(counterparts: DataFrame, tables: TableSet) -> DataFrame:
    """Addresses of the counterpart agreements in use."""
    columns = {"agreement_id": "cp_agreement_id", "party_address_id": "party_address_id"}
    return _addresses_of(counterparts, tables, "party_address_agreement", columns, "cp_agreement_id")


def customer_addresses(assets: DataFrame, tables: TableSet) -> DataFrame:
    """Addresses of the assets in use."""
    columns = {"asset_id": "asset_id", "party_address_id": "party_address_id"}
    return _addresses_of(assets, tables, "party_address_asset", columns, "asset_id")


def only_site(column: str) -> Column:
    """The site of the one agreement with an id; a second row of the agreement is an error."""
    second = F.concat(F.lit("more than one row for agreement "), F.first("cp_agreement_id").cast("string"))
    return F.when(F.sum("_agreements") > 1, F.raise_error(second)).otherwise(F.min(column))


COUNTERPART_SITE = {"cp_site": only_site}
LOWEST_CONTRACT = {"cp_contract_id": F.min}
ANY_ASSET = {"has_any_asset": any_true}
ADDRESS = {"_special_ok": any_true, "_regular_ok": any_true, "_address": any_true}


def _address_ok(site: Column, cfg: RuleConfig) -> Column:
    return address_usable(
        site, cfg.special_site, F.col("_special_ok"), F.col("_regular_ok"), F.col("_address")
    )


def _with_location(df: DataFrame, cfg: RuleConfig) -> DataFrame:
    return df.withColumn("location_ok", _address_ok(F.col("cp_site"), cfg)).drop(*ADDRESS)


def counterpart_agreement_attrs(counterparts: DataFrame, tables: TableSet) -> DataFrame:
    """Add ``cp_site``, NULL if there is no such agreement."""
    return gather_facts(
        counterparts, "cp_agreement_id", [counterpart_site_rows(tables)], COUNTERPART_SITE
    )


def counterpart_agreement_contracts(counterparts: DataFrame, tables: TableSet) -> DataFrame:
    """Contracts of each counterpart agreement; NULL if it has none."""
    hot = tables.hot("agreement_contract", "agreement_id")
    rows = cut_to_keys(
        counterpart_contract_rows(tables), counterparts, "cp_agreement_id", lambda: hot, ["cp_contract_id"]
    )
    return left_spread_join(
        counterparts, rows.distinct(), ["cp_agreement_id"], hot_right=hot, spread_right=["cp_contract_id"]
    )


def party_location_check(
    counterparts: DataFrame, tables: TableSet, cfg: RuleConfig
) -> DataFrame:
    """Add ``location_ok``; the frame has ``cp_site``."""
    usable = usable_address_rows(location_addresses(counterparts, tables), "cp_agreement_id")
    gathered = gather_facts(counterparts, "cp_agreement_id", [usable], ADDRESS)
    return _with_location(gathered, cfg)


def counterpart_facts(used: DataFrame, tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """All facts about the counterpart agreements that a written frame names, one row for each."""
    gathered = gather_facts(
        distinct_counterparts(used),
        "cp_agreement_id",
        [
            counterpart_site_rows(tables),
            counterpart_contract_rows(tables),
            any_asset_rows(tables),
            usable_address_rows(location_addresses(used, tables), "cp_agreement_id"),
        ],
        COUNTERPART_SITE | LOWEST_CONTRACT | ANY_ASSET | ADDRESS,
        used,
    )
    return _with_location(gathered, cfg)


def agreement_has_this_asset(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Add ``has_this_asset`` per asset and contract; NULL without a counterpart agreement.

    ``links`` has the assets of counterpart agreements. Both keys together are one
    key of the join, so that an agreement with many assets and contracts spreads by
    its assets and neither side is repeated.
    """
    flagged = exists_flag(
        pairs,
        links,
        ["cp_agreement_id", "asset_id"],
        "has_this_asset",
        spread=["contract_id", "asset_id"],
    )
    return flagged.withColumn(
        "has_this_asset", F.when(F.col("cp_agreement_id").isNotNull(), F.col("has_this_asset"))
    )


def assets_in_use(counterparts: DataFrame, tables: TableSet) -> DataFrame:
    """Assets of the counterpart agreements in use."""
    return cut_to_keys(
        counterpart_asset_rows(tables),
        counterparts,
        "cp_agreement_id",
        lambda: tables.hot("agreement_asset", "agreement_id"),
        ["asset_id"],
    )


def agreement_asset_check(pairs: Staged, tables: TableSet) -> DataFrame:
    """Add ``has_any_asset`` and ``has_this_asset`` to rows per asset and contract."""
    counterparts = stage(distinct_counterparts(pairs.df), tables.skew).df
    any_asset = gather_facts(counterparts, "cp_agreement_id", [any_asset_rows(tables)], ANY_ASSET)
    rows = lookup_join(
        pairs.df,
        any_asset,
        ["cp_agreement_id"],
        hot=pairs.hot("cp_agreement_id"),
        spread=["contract_id", "asset_id"],
    )
    return agreement_has_this_asset(rows, assets_in_use(counterparts, tables))


# --- facts about an asset or an item -----------------------------------------


def customer_check(assets: DataFrame, tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Add ``customer_ok`` to rows per asset: usable address for its site, or usable number."""
    usable = usable_address_rows(customer_addresses(assets, tables), "asset_id")
    gathered = gather_facts(assets, "asset_id", [usable], ADDRESS)
    ok = _address_ok(F.col("site"), cfg) | ~unusable_id(F.col("customer_num"))
    return gathered.withColumn("customer_ok", ok).drop(*ADDRESS)


def is_special(cfg: RuleConfig) -> Column:
    """Contract of the special site? An unknown site counts as a regular one."""
    return F.coalesce(F.col("contract_site") == cfg.special_site, F.lit(False))


def item_mapping_check(df: DataFrame, tables: TableSet, cfg: RuleConfig, **options) -> DataFrame:
    """Add ``mapped_item``; the site of the contract selects the mapping column."""
    mapping = tables["item_mapping"].where(
        (F.col("application_id") == cfg.mapping_application)
        & F.col("map_type_id").isin(*cfg.mapping_types)
    )
    return two_key_column_lookup(
        df,
        mapping,
        F.when(is_special(cfg), F.lit("a")).otherwise(F.lit("b")),
        "item_num",
        {"a": "item_num_a", "b": "item_num_b"},
        "mapped_item",
        **options,
    )


def item_main_check(df: DataFrame, tables: TableSet, cfg: RuleConfig, **options) -> DataFrame:
    """Add ``has_main_item``: the mapped item at a main site of the other sort.

    Contracts of the special site need an item of any other site, all others
    one of the special site. NULL where nothing was mapped.
    """
    main = tables["item_main"].where(F.col("source_site_id").isNotNull()).select(
        F.col("item_num").alias("mapped_item"),
        (F.col("source_site_id") == cfg.special_site).alias("_main_special"),
    )
    flagged = exists_flag(
        df.withColumn("_main_special", ~is_special(cfg)),
        main,
        ["mapped_item", "_main_special"],
        "has_main_item",
        **options,
    ).drop("_main_special")
    return flagged.withColumn(
        "has_main_item", F.when(F.col("mapped_item").isNotNull(), F.col("has_main_item"))
    )


def attach_item_facts(
    rows: DataFrame, contracts: DataFrame, tables: TableSet, cfg: RuleConfig, hot: HotKeys
) -> DataFrame:
    """Add both item checks to rows per contract, made once per item and sort of site.

    ``contracts`` is a written frame with the items, ``hot`` has hot values of ``item_num``.
    """
    items = (
        contracts.select("item_num", is_special(cfg).alias("_special"))
        .where(F.col("item_num").isNotNull())
        .distinct()
        .withColumn("contract_site", F.when(F.col("_special"), F.lit(cfg.special_site)))
    )
    facts = item_main_check(item_mapping_check(items, tables, cfg), tables, cfg)
    return lookup_join(
        rows.withColumn("_special", is_special(cfg)),
        facts.drop("contract_site"),
        ["item_num", "_special"],
        hot=hot,
        spread=["contract_id"],
    ).drop("_special")


# --- label and report --------------------------------------------------------


def root_cause_label() -> Column:
    """First rule that holds, in order of precedence."""
    has_agreement = F.col("agreement_id").isNotNull()

    def agreement_rule(condition: Column) -> Column:
        return has_agreement & F.coalesce(condition, F.lit(False))

    return (
        F.when(F.col("original_asset_id").isNull(), config.ORIGINAL_NOT_FOUND)
        .when(F.col("contract_id").isNull(), config.ORIGINAL_WITHOUT_ENTITLEMENT)
        .when(F.col("is_dual_serialized"), config.DUAL_SERIALIZED)
        .when(F.col("is_ineligible_item"), config.NOT_ELIGIBLE)
        .when(agreement_rule(F.col("cp_agreement_id").isNull()), config.AGREEMENT_NOT_FOUND)
        .when(agreement_rule(~F.col("has_any_asset")), config.AGREEMENT_WITHOUT_ASSET)
        .when(agreement_rule(~F.col("has_this_asset")), config.AGREEMENT_OTHER_ASSET)
        .when(agreement_rule(~F.col("location_ok")), config.LOCATION_NOT_FOUND)
        .when(~has_agreement & ~F.col("customer_ok"), config.CUSTOMER_NOT_FOUND)
        .when(F.col("mapped_item").isNull(), config.MAPPING_MISSING)
        .when(~F.col("has_main_item"), config.MAIN_ITEM_MISSING)
        .when(F.col("has_instruction"), config.INSTRUCTION_ERROR)
        .when(has_agreement, config.AGREEMENT_OTHER)
        .otherwise(config.OTHER)
    )


def named_agreements(contracts: DataFrame, tables: TableSet, cfg: RuleConfig) -> Staged:
    """Agreements of written contracts with their counterparts, one row per agreement."""
    named = counterpart_of(distinct_agreements(contracts), tables, cfg, used=contracts)
    return stage(named, tables.skew)


def with_counterparts(
    contracts: DataFrame,
    named: Staged,
    facts: DataFrame,
    hot: HotKeys,
) -> DataFrame:
    """Add ``cp_agreement_id`` and facts about counterpart agreements to the contracts.

    They go through one row per agreement, so that either join is a lookup by a key
    whose hot values a written frame knows.
    """
    agreements = lookup_join(
        named.df, facts, ["cp_agreement_id"], hot=named.hot("cp_agreement_id"), spread=["agreement_id"]
    )
    return attach_agreements(contracts, agreements, hot)


@dataclass(frozen=True)
class Walk:
    """What the walk from the assets to the contracts found, each computed once."""

    assets: Staged
    links: Staged
    contracts: Staged
    pairs: Staged

    def attach(self, facts: DataFrame) -> DataFrame:
        return attach(self.assets.df, self.links.df, self.pairs, facts)


def walk(
    tables: TableSet,
    cfg: RuleConfig,
    facts: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> Walk:
    """From candidate assets to the contracts of their originals, with the facts that are wanted.

    ``facts`` adds columns to rows per contract; its second argument is a written frame
    that has their ids.
    """
    policy = tables.skew
    assets = stage(assets_without_contract(tables, cfg), policy)
    links = stage(original_asset(assets.df.select("asset_id"), tables, cfg), policy)
    covered = stage(covered_contracts(links.df, tables), policy)
    rows = contract_rows(covered.df, tables)
    contracts = stage(facts(rows, covered.df) if facts else rows, policy)
    return Walk(assets, links, contracts, contract_pairs(links, covered, contracts.df, tables))


def with_lowest_address(df: DataFrame, addresses: DataFrame, key: str, side: str) -> DataFrame:
    """Add the address with the lowest id to rows per key: its id, its customer number, its ucid."""
    lowest = addresses.groupBy(key).agg(F.min(F.struct("party_address_id", "address_customer_num", "ucid")).alias("_a"))
    shown = lowest.select(
        key,
        F.col("_a.party_address_id").alias(f"{side}_address_id"),
        F.col("_a.address_customer_num").alias(f"{side}_address_customer_num"),
        F.col("_a.ucid").alias(f"{side}_address_ucid"),
    )
    return lookup_join(df, shown, [key])


def checked_pairs(tables: TableSet, cfg: RuleConfig, addresses: bool = False) -> DataFrame:
    """Rows per asset and contract with the results of all checks, before the label.

    With ``addresses`` they also have the lowest address of the counterpart agreement
    (``cp_address_*``) and of the asset (``asset_address_*``). Each is found once per
    agreement or asset, before the pairs get it with the other facts.
    """
    found = walk(tables, cfg, lambda rows, used: contract_facts(rows, tables, cfg, used))
    contracts = found.contracts
    named = named_agreements(contracts.df, tables, cfg)
    counterparts = counterpart_facts(named.df, tables, cfg)
    assets = customer_check(found.assets.df, tables, cfg)
    if addresses:
        counterparts = with_lowest_address(counterparts, location_addresses(named.df, tables), "cp_agreement_id", "cp")
        assets = with_lowest_address(assets, customer_addresses(found.assets.df, tables), "asset_id", "asset")
    facts = with_counterparts(contracts.df, named, counterparts, contracts.hot("agreement_id"))
    facts = attach_item_facts(facts, contracts.df, tables, cfg, contracts.hot("item_num"))
    rows = attach(assets, found.links.df, found.pairs, facts)
    return agreement_has_this_asset(rows, assets_in_use(named.df, tables))


def root_cause_report(tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """The wide report: asset, contract, result of every check, and the label."""
    return checked_pairs(tables, cfg).withColumn("root_cause", root_cause_label()).select(
        *REPORT_COLUMNS
    )


def root_cause_ladder(tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Asset, contract and label alone."""
    return root_cause_report(tables, cfg).select("asset_id", "contract_id", "root_cause")
