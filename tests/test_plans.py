"""Shapes of the physical plans: what must never appear, and what must reach the scans."""

import re

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from gapwise.catalog import analysis, basics, oracle
from gapwise.operators import staging
from gapwise.plans import root_cause as rc
from gapwise.plans.fixtures import FIXTURE_RULES, derive_tables
from gapwise.sources.tables import SCHEMAS, TableSet

BAD_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "LeftSingle", "Python", "ObjectHash")
#: groups of one record are collected on purpose by these
COLLECTING = {"grouped_concat", "array_match_concat", "array_match_flags", "array_slot_placement",
              "array_scan_scalar_service", "struct_unpack"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _unwritten(df, path):
    df.count()  # which is what the observation of its rows waits for
    return df


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("stored"))
    tables = derive_tables(spark, SMALL)
    for name in tables:
        tables[name].write.parquet(f"{base}/{name}")
    return base


@pytest.fixture
def shuffled(spark):
    """Plans as for large tables: no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(basics.QUERIES | analysis.QUERIES))
def test_no_bad_node(spark, shuffled, monkeypatch, name):
    monkeypatch.setattr(staging, "write", _unwritten)  # so that the plan shows every step
    plan = physical(entry.queries()[name](spark, SMALL))
    bad = [node for node in BAD_NODES if node in plan]
    assert not [node for node in bad if not (node == "ObjectHash" and name in COLLECTING)]


def test_candidate_filters_reach_the_scan(spark, stored):
    tables = TableSet.from_parquet(spark, stored)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = physical(rc.candidate_assets(tables, FIXTURE_RULES))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    for part in ("In(create_pgm", "EqualTo(order_num,99999)", "GreaterThanOrEqual(created_at", "LessThan(created_at"):
        assert part in pushed


def test_scans_read_only_what_a_step_needs(spark, stored):
    tables = TableSet.from_parquet(spark, stored)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = physical(rc.without_contract(rc.candidate_assets(tables, FIXTURE_RULES), tables))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "contract_id:bigint" in schemas  # the contract table, its key alone
    assert not any("asset_id" in s and "item_num" in s for s in schemas)


def _steps(spark, stored):
    tables = TableSet.from_parquet(spark, stored)
    assets = staging.stage(rc.assets_without_contract(tables, FIXTURE_RULES), tables.skew).df
    links = staging.stage(rc.original_asset(assets, tables, FIXTURE_RULES), tables.skew)
    covered = staging.stage(rc.covered_contracts(links.df, tables), tables.skew)
    return tables, assets, links, covered


def test_few_keys_cut_the_scans_of_large_tables(spark, stored):
    """Spark broadcasts the keys of written frames into the scans, below all aggregates."""
    tables, assets, links, covered = _steps(spark, stored)
    plan = physical(rc.without_contract(assets, tables))
    assert re.search(r"BroadcastHashJoin \[asset_id#\d+L\], \[asset_id#\d+L\], LeftSemi", plan)
    contracts = rc.contract_rows(covered.df, tables)
    facts = physical(rc.contract_facts(contracts, tables, FIXTURE_RULES, covered.df))
    assert facts.count("LeftSemi") == 4 and "SortMergeJoin" not in facts  # the contracts and three fact tables


def test_many_keys_are_never_broadcast(spark, stored, shuffled):
    tables, assets, links, covered = _steps(spark, stored)
    assert "Broadcast" not in physical(rc.without_contract(assets, tables))
    contracts = rc.contract_rows(covered.df, tables)
    assert "Broadcast" not in physical(rc.contract_facts(contracts, tables, FIXTURE_RULES, covered.df))


def test_one_plan_for_few_and_many_candidates(spark, stored):
    """Whether Spark broadcasts or shuffles, each table is read equally often by the whole report."""
    scans = []
    for bound in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        try:
            report = rc.root_cause_report(TableSet.from_parquet(spark, stored), FIXTURE_RULES)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        scans.append(report._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
    assert scans[0] == scans[1] > 0


def test_links_are_cut_before_they_meet_an_address(spark, stored, shuffled):
    """Also where the keys are too many to broadcast."""
    tables, assets, links, covered = _steps(spark, stored)
    for addresses in (
        rc.customer_addresses(assets, tables),
        rc.location_addresses(assets.withColumnRenamed("asset_id", "cp_agreement_id"), tables),
    ):
        plan = physical(addresses)
        assert plan.index("Inner") < plan.index("LeftSemi")  # the semi join lies below the join with the addresses
        assert plan.count("LeftSemi") == 1


def test_pairs_are_made_distinct_by_their_keys_alone(spark, stored, shuffled):
    """Nothing but the two ids and the original takes part in the grouping of pairs."""
    tables, assets, links, covered = _steps(spark, stored)
    contracts = staging.stage(rc.contract_rows(covered.df, tables), tables.skew).df
    pairs = rc.contract_pairs(links, covered, contracts, tables)
    assert pairs.df.columns == ["asset_id", "contract_id", "original_asset_id"]
    facts = rc.contract_facts(contracts, tables, FIXTURE_RULES, contracts)
    plan = physical(rc.attach(assets, links.df, pairs, facts))
    keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]|SortAggregate\(key=\[([^\]]*)\]", plan)
    assert keys and not any("serial_num" in k or "item_num" in k or "is_" in k for found in keys for k in found)


def test_facts_of_one_key_share_one_shuffle(spark, stored, shuffled):
    tables = TableSet.from_parquet(spark, stored)
    contracts = tables["contract"].withColumnRenamed("source_site_id", "contract_site")
    plan = physical(rc.contract_facts(contracts, tables, FIXTURE_RULES))
    assert plan.count("Exchange hashpartitioning") == 3  # contracts, their keys, and all three fact tables


def test_every_table_has_a_schema_with_an_entry(spark):
    assert set(derive_tables(spark, SMALL)) == set(SCHEMAS)
    own = set(basics.QUERIES) | set(analysis.QUERIES)  # beside what the corpus operators add
    assert set(oracle.SQL) == own - {"stale_files"} and own <= set(entry.queries())


def test_derived_rows_stay_inside_code_generation(spark):
    """A table that makes several rows of one evaluates no lambda for each of them."""
    tables = derive_tables(spark, SMALL)
    for name in ("asset_relationship", "agreement_identifier", "agreement_asset", "party_address_agreement", "contract_coverage"):
        assert "lambda" not in tables[name]._jdf.queryExecution().optimizedPlan().toString()


def test_unique_lookups_are_shuffled_once(spark, stored, shuffled):
    """Rows made unique by their key need no other shuffle for the join by it."""
    tables = TableSet.from_parquet(spark, stored)
    link = tables["party_address_asset"]
    assert physical(rc.address_rows(link, tables)).count("Exchange hashpartitioning") == 2
    assert "_apart" not in physical(rc.contract_rows(tables["contract_coverage"], tables))
