"""Other views of the same relations: a coalesced status, a staged flow, a bridge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise import config
from gapwise.config import RuleConfig
from gapwise.functions.predicates import address_usable, usable_id
from gapwise.functions.scalars import id_from_text
from gapwise.operators.aggregates import grouped_count_status
from gapwise.operators.joins import or_key_join, star_inner_join, state_gated_join
from gapwise.operators.skew import lookup_join, spread_join, without_partner
from gapwise.operators.staging import Staged, cut_to_keys, stage
from gapwise.plans.root_cause import (
    ASSET_COLUMNS,
    assets_in_use,
    checked_pairs,
    contract_agreement,
    counterpart_contract_rows,
    customer_addresses,
    distinct_counterparts,
    location_addresses,
    named_agreements,
    walk,
    with_counterparts,
)
from gapwise.sources.tables import TableSet, scan


def item_status(items: DataFrame, tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Add ``mapping_status`` and ``main_status`` per item number; NULL where fine.

    An item is mapped if either column of the mapping has it. The main item is
    looked for only where the item is mapped.
    """
    mapping = tables["item_mapping"].where(
        (F.col("application_id") == cfg.mapping_application)
        & F.col("map_type_id").isin(*cfg.mapping_types)
    )
    matches = or_key_join(
        items, mapping.select("item_num_a", "item_num_b"), "item_num",
        ["item_num_a", "item_num_b"], how="inner",
    )
    mapped = grouped_count_status(
        items, matches, ["item_num"], config.MAPPING_MISSING,
        count_name="_maps", status_name="mapping_status",
    )
    mains = scan(tables, "item_main", {"item_num": "item_num"}).groupBy("item_num").agg(
        F.count(F.lit(1)).alias("_mains")
    )
    gated = state_gated_join(mapped, mains, F.col("mapping_status").isNull(), ["item_num"])
    return gated.withColumn(
        "main_status", F.when(F.col("_mains").isNull(), config.MAIN_ITEM_MISSING)
    ).drop("_maps", "_mains")


def located_counterparts(named: DataFrame, tables: TableSet) -> DataFrame:
    """One row per counterpart agreement that a written frame names, with ``_located``: has it any address link?"""
    links = scan(tables, "party_address_agreement", {"agreement_id": "cp_agreement_id"})
    return grouped_count_status(
        distinct_counterparts(named),
        cut_to_keys(links, named, "cp_agreement_id"),
        ["cp_agreement_id"],
        config.LOCATION_NOT_FOUND,
        count_name="_links",
    ).select("cp_agreement_id", (F.col("_links") > 0).alias("_located"))


def status_coalesce(tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Asset, contract and a label from the first status that is not fine.

    Order: location (any address link of the counterpart agreement will do),
    agreement, mapping, main item, else the label for others. NULL for assets
    without a contract. Of the facts about a contract only its agreement is looked up.
    """
    found = walk(tables, cfg, lambda rows, used: contract_agreement(rows, tables, used))
    contracts = found.contracts.df
    named = named_agreements(contracts, tables, cfg)
    located = located_counterparts(named.df, tables)
    facts = with_counterparts(contracts, named, located, found.contracts.hot("agreement_id"))
    items = contracts.select("item_num").where(F.col("item_num").isNotNull()).distinct()
    facts = lookup_join(
        facts,
        item_status(items, tables, cfg).withColumn("_item", F.lit(True)),
        ["item_num"],
        hot=found.contracts.hot("item_num"),
        spread=["contract_id"],
    )
    label = F.coalesce(
        F.when(~F.coalesce(F.col("_located"), F.lit(False)), config.LOCATION_NOT_FOUND),
        F.when(F.col("cp_agreement_id").isNull(), config.AGREEMENT_NOT_FOUND),
        F.when(F.col("_item").isNull(), config.MAPPING_MISSING),
        F.col("mapping_status"),
        F.col("main_status"),
        F.lit(config.OTHER),
    )
    labelled = facts.select("contract_id", "item_num", label.alias("root_cause"))
    return found.attach(labelled).select(
        *ASSET_COLUMNS.values(), "contract_id", "item_num", "root_cause"
    )


FLOW_COLUMNS = (
    "asset_id",
    "original_asset_id",
    "contract_id",
    "agreement_id",
    "cp_agreement_id",
    "stage",
    "record_id",
    "record_agreement_id",
    "site",
    "customer_num",
    "ucid",
    "item_num",
    "fits",
    "label",
)


def staged_agreement_flow(tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """Every record of every stage of each asset and contract, and what the stage makes of it.

    One row per asset, contract, stage and record:

    agreement  the counterpart agreement and its site; for each contract
    contract   each contract of the counterpart agreement
    asset      each asset of the counterpart agreement
    location   each address of the counterpart agreement, with the agreement that the
               link names, the customer number and the ucid
    customer   each address of the asset itself; for each asset
    mapping    the mapped item; for each contract

    A stage that finds nothing has one row without a record, and stages after the
    agreement none without a counterpart. ``fits`` says whether this record is what the
    stage asks for, ``label`` what is wrong with the stage as a whole, NULL where it is
    fine. Records of different stages follow each other and are never combined. Links
    that repeat count once.
    """
    pairs = stage(checked_pairs(tables, cfg), tables.skew)
    counterparts = stage(distinct_counterparts(pairs.df), tables.skew).df
    assets = stage(pairs.df.select("asset_id").distinct(), tables.skew).df
    of_agreement = _with_empty_stages(
        _records(counterpart_contract_rows(tables), "contract", "cp_agreement_id", "cp_contract_id", counterparts)
        .unionByName(_records(assets_in_use(counterparts, tables), "asset", "cp_agreement_id", "asset_id"))
        .unionByName(_records(location_addresses(counterparts, tables), "location", "cp_agreement_id", "party_address_id")),
        counterparts,
        "cp_agreement_id",
        ("contract", "asset", "location"),
        tables,
    )
    of_asset = _with_empty_stages(
        _records(customer_addresses(assets, tables), "customer", "asset_id", "party_address_id"),
        assets,
        "asset_id",
        ("customer",),
        tables,
    )
    own = pairs.df.where(F.col("contract_id").isNotNull())
    rows = [
        _attached(own, stage="'agreement'", record_id="cp_agreement_id", record_agreement_id="cp_agreement_id"),
        _attached(own, stage="'mapping'"),
        _with_records(pairs, of_agreement, "cp_agreement_id", record_agreement_id="cp_agreement_id"),
        _with_records(pairs, of_asset, "asset_id"),
    ]
    flow = reduce(DataFrame.unionByName, rows)
    fits, label = _verdicts(cfg)
    shown = {
        "site": F.when(F.col("stage") == "agreement", F.col("cp_site")),
        "customer_num": F.col("address_customer_num"),
        "item_num": F.when(F.col("stage") == "mapping", F.col("mapped_item")),
        "record_agreement_id": F.when(F.col("record_id").isNotNull(), F.col("record_agreement_id")),
        "fits": fits,
        "label": label,
    }
    return flow.withColumns(shown).select(*FLOW_COLUMNS)


def _records(
    rows: DataFrame, stage: str, key: str, record: str, used: DataFrame | None = None
) -> DataFrame:
    """(key, stage, record_id, address) of a stage's records, each once."""
    if used is not None:
        rows = cut_to_keys(rows, used, key)
    address = [
        F.col(c) if c in rows.columns else F.lit(None).cast("bigint").alias(c)
        for c in ("address_customer_num", "ucid")
    ]
    return rows.select(key, F.lit(stage).alias("stage"), F.col(record).alias("record_id"), *address).distinct()


def _with_empty_stages(
    records: DataFrame, keys: DataFrame, key: str, stages: tuple[str, ...], tables: TableSet
) -> Staged:
    """Records, and a row without one for each key and stage that has none."""
    written = stage(records, tables.skew).df
    every = keys.select(key, F.explode(F.array(*map(F.lit, stages))).alias("stage"))
    empty = without_partner(every, written, [key, "stage"])
    return stage(written.unionByName(empty, allowMissingColumns=True), tables.skew)


#: What the verdicts on records read of an asset and contract.
_FACTS = (
    "asset_id",
    "original_asset_id",
    "contract_id",
    "agreement_id",
    "cp_agreement_id",
    "site",
    "cp_site",
    "mapped_item",
    "has_any_asset",
    "has_this_asset",
    "location_ok",
    "customer_ok",
)


def _attached(pairs: DataFrame, **columns: str) -> DataFrame:
    """Pairs with the columns of a record, by expressions; those that aren't named are NULL."""
    kinds = {"stage": "string", "record_id": "bigint", "record_agreement_id": "bigint", "address_customer_num": "bigint", "ucid": "bigint"}
    facts = [F.col("site").alias("asset_site") if c == "site" else F.col(c) for c in _FACTS]
    made = [F.expr(columns.get(c, "null")).cast(kind).alias(c) for c, kind in kinds.items()]
    return pairs.select(*facts, *made)


def _with_records(pairs: Staged, records: Staged, key: str, **columns: str) -> DataFrame:
    """Pairs with each record of their key; both sides may have a hot key, and know it."""
    joined = spread_join(
        pairs.df.select(*_FACTS),
        records.df,
        [key],
        hot_left=pairs.hot(key),
        hot_right=records.hot(key),
        spread_left=["asset_id", "contract_id"],
        spread_right=["stage", "record_id"],
    )
    same = {c: c for c in ("stage", "record_id", "address_customer_num", "ucid")}
    return _attached(joined, **same, **columns)


def _verdicts(cfg: RuleConfig) -> tuple[Column, Column]:
    """Does a record fit its stage, and what is wrong with the stage?"""
    found = F.col("record_id").isNotNull()

    def usable(site: str) -> Column:
        special, regular = usable_id(F.col("ucid")), usable_id(F.col("address_customer_num"))
        return found & address_usable(F.col(site), cfg.special_site, special, regular, found)

    def of(stage: str) -> Column:
        return F.col("stage") == stage

    fits = (
        F.when(of("asset"), F.coalesce(F.col("record_id") == F.col("asset_id"), F.lit(False)))
        .when(of("location"), usable("cp_site"))
        .when(of("customer"), usable("asset_site"))
        .when(of("mapping"), F.col("mapped_item").isNotNull())
        .otherwise(found)
    )
    label = (
        F.when(of("agreement") & ~found, config.AGREEMENT_NOT_FOUND)
        .when(of("asset") & ~F.col("has_any_asset"), config.AGREEMENT_WITHOUT_ASSET)
        .when(of("asset") & ~F.col("has_this_asset"), config.AGREEMENT_OTHER_ASSET)
        .when(of("location") & ~F.col("location_ok"), config.LOCATION_NOT_FOUND)
        .when(of("customer") & ~F.col("customer_ok"), config.CUSTOMER_NOT_FOUND)
        .when(of("mapping") & F.col("mapped_item").isNull(), config.MAPPING_MISSING)
    )
    return fits, label


SUMMARY_COLUMNS = (
    *ASSET_COLUMNS.values(),
    "original_asset_id",
    "contract_id",
    "item_num",
    "contract_site",
    "agreement_id",
    "cp_agreement_id",
    "agreement_label",
    "cp_site",
    "cp_contract_id",
    "source_label",
    "cp_address_id",
    "cp_address_customer_num",
    "cp_address_ucid",
    "location_label",
    "asset_address_id",
    "asset_address_customer_num",
    "asset_address_ucid",
    "customer_label",
    "mapped_item",
)


def staged_agreement_summary(tables: TableSet, cfg: RuleConfig) -> DataFrame:
    """One row per asset and contract with a label per stage, NULL where fine.

    Of several records of a stage the one with the lowest id stands for all; the flow
    itself has each of them. Stages after the counterpart agreement have no label
    without such an agreement.
    """
    rows = checked_pairs(tables, cfg, addresses=True)
    has_contract = F.col("contract_id").isNotNull()
    has_counterpart = F.col("cp_agreement_id").isNotNull()
    labels = {
        "agreement_label": F.when(has_contract & ~has_counterpart, config.AGREEMENT_NOT_FOUND),
        "source_label": F.when(
            has_counterpart & ~F.col("has_any_asset"), config.AGREEMENT_WITHOUT_ASSET
        ).when(has_counterpart & ~F.col("has_this_asset"), config.AGREEMENT_OTHER_ASSET),
        "location_label": F.when(
            has_counterpart & ~F.col("location_ok"), config.LOCATION_NOT_FOUND
        ),
        "customer_label": F.when(~F.col("customer_ok"), config.CUSTOMER_NOT_FOUND),
    }
    return rows.withColumns(labels).select(*SUMMARY_COLUMNS)


def agreement_bridge(tables: TableSet, cfg: RuleConfig, via: str = "agreement") -> DataFrame:
    """Identifier, agreement, its site, contracts and assets for counterpart identifiers.

    ``via="agreement"`` follows the agreement that has the identifier, and
    ``via="value"`` the counterpart agreement that the identifier names.
    """
    identifiers = tables["agreement_identifier"].where(
        F.col("identifier_type_id").isin(*cfg.counterpart_identifier_types)
    )
    key = F.col("agreement_id") if via == "agreement" else id_from_text(F.col("identifier_value"))
    hub = identifiers.select(
        key.alias("_key"),
        "agreement_id",
        "identifier_type_id",
        F.col("identifier_value").alias("cp_agreement_id"),
    ).where(F.col("_key").isNotNull())
    points = [
        scan(tables, "agreement", {"agreement_id": "_key", "source_site_id": "cp_site"}),
        scan(
            tables, "agreement_contract", {"agreement_id": "_key", "contract_id": "cp_contract_id"}
        ),
        scan(tables, "agreement_asset", {"agreement_id": "_key", "asset_id": "cp_asset_id"}),
    ]
    hub_column = "agreement_id" if via == "agreement" else "counterpart_id"
    return star_inner_join(
        hub,
        points,
        "_key",
        hot=[
            tables.hot("agreement_identifier", hub_column),
            {},
            tables.hot("agreement_contract", "agreement_id"),
            tables.hot("agreement_asset", "agreement_id"),
        ],
    ).select(
        "cp_agreement_id",
        "agreement_id",
        "identifier_type_id",
        "cp_site",
        "cp_contract_id",
        "cp_asset_id",
    )
