"""One query per step of the analysis, on the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.functions.predicates import differs_from, unusable_id
from gapwise.functions.scalars import id_from_text
from gapwise.operators import joins
from gapwise.operators.skew import lookup_join
from gapwise.operators.staging import Staged, stage
from gapwise.plans import root_cause as rc
from gapwise.plans import variants
from gapwise.plans.fixtures import FIXTURE_RULES as CFG
from gapwise.sources.tables import TableSet


# --- base operators whose case needs the derived tables ----------------------


def filter_ne_three_valued(t: TableSet) -> DataFrame:
    site = F.col("source_site_id")
    joined = t["agreement_contract"].join(t["agreement"], "agreement_id", "left")
    return joined.where(differs_from(site, 6)).select(
        "agreement_id", "contract_id", "source_site_id", (site != 6).alias("ne_result")
    )


def and_or_grouped_predicate(t: TableSet) -> DataFrame:
    site = F.col("source_site_id")
    unusable = ((site == 6) & unusable_id(F.col("ucid"))) | (
        (site != 6) & unusable_id(F.col("customer_num"))
    )
    return (
        t["party_address_agreement"]
        .join(t["party_address"], "party_address_id")
        .join(t["agreement"], "agreement_id")
        .where(unusable)
        .select("agreement_id", "party_address_id", "source_site_id")
    )


def not_exists_two_keys(t: TableSet) -> DataFrame:
    pairs = t["agreement_contract"].join(t["contract_coverage"], "contract_id")
    return joins.not_exists(
        pairs.select("agreement_id", "asset_id").distinct(),
        t["agreement_asset"],
        ["agreement_id", "asset_id"],
    )


def nested_lookup(t: TableSet) -> DataFrame:
    inner = (
        t["agreement_identifier"]
        .where(F.col("identifier_type_id").isin(111, 112))
        .select("agreement_id", id_from_text(F.col("identifier_value")).alias("cp_agreement_id"))
    )
    return joins.nested_lookup(
        t["contract"].select("contract_id"),
        t["agreement_contract"],
        inner,
        "contract_id",
        "agreement_id",
        "cp_agreement_id",
        hot_inner=t.hot("agreement_contract", "agreement_id"),
    )


def two_key_column_lookup(t: TableSet) -> DataFrame:
    return joins.two_key_column_lookup(
        t["contract"],
        t["item_mapping"],
        F.when(F.col("source_site_id") == 6, "a").otherwise("b"),
        "item_num",
        {"a": "item_num_a", "b": "item_num_b"},
        "mapped_item",
        hot=t.hot("contract", "item_num"),
        spread=["contract_id"],
    ).select("contract_id", "item_num", "mapped_item")


def wide_left_assembly(t: TableSet) -> DataFrame:
    def count_of(table: str, key: str, name: str):
        counts = t[table].groupBy(F.col(key).try_cast("bigint").alias("contract_id"))
        return counts.agg(F.count(F.lit(1)).alias(name)), ["contract_id"]

    return joins.wide_left_assembly(
        t["contract"].select("contract_id", "item_num"),
        [
            count_of("contract_coverage", "contract_id", "n_assets"),
            count_of("contract_identifier", "identifier_value", "n_identifiers"),
            count_of("agreement_contract", "contract_id", "n_agreements"),
            count_of("instruction", "entity_value", "n_instructions"),
        ],
    )


# --- steps -------------------------------------------------------------------


def assets_without_contract(t: TableSet) -> DataFrame:
    return rc.assets_without_contract(t, CFG)


def original_asset(t: TableSet) -> DataFrame:
    return rc.original_asset(stage(assets_without_contract(t), t.skew).df, t, CFG)


def original_contracts(t: TableSet) -> DataFrame:
    assets = stage(assets_without_contract(t), t.skew).df
    return rc.original_contracts(assets, t, CFG).select(
        "asset_id", "original_asset_id", "contract_id", "item_num", "contract_site"
    )


def _covered(t: TableSet) -> tuple[Staged, Staged]:
    """Links to the originals, and what contracts cover them, each computed once for the steps after it."""
    assets = stage(assets_without_contract(t).select("asset_id"), t.skew).df
    links = stage(rc.original_asset(assets, t, CFG), t.skew)
    return links, stage(rc.covered_contracts(links.df, t), t.skew)


def _contracts(t: TableSet) -> DataFrame:
    return stage(rc.contract_rows(_covered(t)[1].df, t), t.skew).df


def contract_preclass(t: TableSet) -> DataFrame:
    return rc.contract_preclass(_contracts(t), t, CFG)


def counterpart_agreement(t: TableSet) -> DataFrame:
    return rc.counterpart_agreement(_contracts(t), t, CFG).select(
        "contract_id", "agreement_id", "cp_agreement_id"
    )


def _counterparts(t: TableSet) -> DataFrame:
    agreements = rc.distinct_agreements(rc.contract_agreement(_contracts(t), t))
    return stage(rc.distinct_counterparts(rc.counterpart_of(agreements, t, CFG)), t.skew).df


def counterpart_agreement_attrs(t: TableSet) -> DataFrame:
    return rc.counterpart_agreement_attrs(_counterparts(t), t)


def counterpart_agreement_contracts(t: TableSet) -> DataFrame:
    return rc.counterpart_agreement_contracts(_counterparts(t), t)


def agreement_asset_check(t: TableSet) -> DataFrame:
    links, covered = _covered(t)
    contracts = stage(rc.contract_rows(covered.df, t), t.skew).df
    pairs = rc.contract_pairs(links, covered, contracts, t)
    facts = rc.counterpart_agreement(contracts, t, CFG)
    rows = lookup_join(pairs.df, facts, ["contract_id"], hot=pairs.hot("contract_id"), spread=["asset_id"])
    return rc.agreement_asset_check(stage(rows, t.skew), t).select(
        "asset_id", "contract_id", "cp_agreement_id", "has_any_asset", "has_this_asset"
    )


def party_location_check(t: TableSet) -> DataFrame:
    return rc.party_location_check(counterpart_agreement_attrs(t), t, CFG)


def customer_check(t: TableSet) -> DataFrame:
    return rc.customer_check(stage(assets_without_contract(t), t.skew).df, t, CFG).select(
        "asset_id", "site", "customer_num", "customer_ok"
    )


def item_mapping_check(t: TableSet) -> DataFrame:
    return rc.item_mapping_check(
        _contracts(t), t, CFG, hot=t.hot("contract", "item_num"), spread=["contract_id"]
    )


def item_main_check(t: TableSet) -> DataFrame:
    return rc.item_main_check(
        item_mapping_check(t), t, CFG, hot=t.hot("contract", "item_num"), spread=["contract_id"]
    )


def instruction_check(t: TableSet) -> DataFrame:
    return rc.instruction_check(_contracts(t), t, CFG).select("contract_id", "has_instruction")


def root_cause_ladder(t: TableSet) -> DataFrame:
    return rc.root_cause_ladder(t, CFG)


def root_cause_report(t: TableSet) -> DataFrame:
    return rc.root_cause_report(t, CFG)


def status_coalesce(t: TableSet) -> DataFrame:
    return variants.status_coalesce(t, CFG)


def staged_agreement_flow(t: TableSet) -> DataFrame:
    return variants.staged_agreement_flow(t, CFG)


def staged_agreement_summary(t: TableSet) -> DataFrame:
    return variants.staged_agreement_summary(t, CFG)


def agreement_bridge(t: TableSet) -> DataFrame:
    return variants.agreement_bridge(t, CFG)


def agreement_bridge_by_value(t: TableSet) -> DataFrame:
    return variants.agreement_bridge(t, CFG, via="value")


QUERIES = {
    query.__name__: query
    for query in (
        filter_ne_three_valued,
        and_or_grouped_predicate,
        not_exists_two_keys,
        nested_lookup,
        two_key_column_lookup,
        wide_left_assembly,
        assets_without_contract,
        original_asset,
        original_contracts,
        contract_preclass,
        counterpart_agreement,
        counterpart_agreement_attrs,
        counterpart_agreement_contracts,
        agreement_asset_check,
        party_location_check,
        customer_check,
        item_mapping_check,
        item_main_check,
        instruction_check,
        root_cause_ladder,
        root_cause_report,
        status_coalesce,
        staged_agreement_flow,
        staged_agreement_summary,
        agreement_bridge,
        agreement_bridge_by_value,
    )
}
