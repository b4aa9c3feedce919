"""The analysis against the rules in plain Python, on skewed and awkward tables."""

import random
from collections import Counter

import pytest
import rules
from conftest import SMALL, rows

from gapwise import config as c
from gapwise.operators.skew import SkewPolicy
from gapwise.plans import root_cause as rc
from gapwise.plans import variants
from gapwise.plans.fixtures import FIXTURE_RULES, derive_tables
from gapwise.sources.tables import SCHEMAS, SKEW_COLUMNS, TableSet

CFG = FIXTURE_RULES

#: when keys are hot, and what Spark broadcasts
POLICIES = {
    "small tables": (SkewPolicy(), "10m"),
    "hot keys, few candidates": (SkewPolicy(hot_rows=4, max_hot=1000), "10m"),
    "hot keys, many candidates": (SkewPolicy(hot_rows=4, max_hot=1000), "-1"),
}


@pytest.fixture
def sizes(spark, request):
    policy, bound = POLICIES[request.param]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    yield policy
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def awkward_tables(seed):
    """Small tables with one hot value per key, NULLs, copies and dangling links."""
    r = random.Random(seed)

    def pick(n, hot=3, nulls=True):
        roll = r.random()
        if roll < 0.33:
            return hot
        return None if nulls and roll < 0.38 else r.randrange(n)

    def text(n):
        value = pick(n)
        return r.choice(["x", "", "7 up"]) if r.random() < 0.1 else None if value is None else str(value)

    def site():
        return r.choice([6, 6, 1, 2, None])

    def some(n, make):
        made = [make() for _ in range(n)]
        return made + made[: n // 6]  # copies

    number = lambda: r.choice([None, -1, 0, 1, 5])
    item = lambda: r.choice(["IT0", "A", "A", "B", "C", "D", None])
    return {
        "asset": [
            (i, f"SN{i}", i % 5, "class", site(), number(), r.choice([99999, 99999, i]),
             r.choice(["PGM.A", "PGM.B", "OTHER"]), r.choice(["1996-01-01 00:00:00", "2000-12-31 23:59:59", "2001-01-01 00:00:00"]))
            for i in range(60)
        ],
        "asset_relationship": some(90, lambda: (pick(60, 5), pick(60, 50), r.choice([9, 9, 4]))),
        "contract": [(i, item(), site()) for i in range(40)],
        "contract_coverage": some(40, lambda: (pick(50), pick(60, 50))),
        "contract_identifier": some(12, lambda: (r.randrange(40), text(60), r.choice([106, 105]))),
        "agreement": [(i, site()) for i in range(30)],
        "agreement_contract": some(40, lambda: (pick(35, 4), pick(45, 8))),
        "agreement_identifier": some(50, lambda: (pick(35, 4), r.choice([110, 111, 112]), text(35))),
        "agreement_asset": some(50, lambda: (pick(35), pick(60, 9))),
        "party_address": [(i, number(), number()) for i in range(20)],
        "party_address_agreement": some(40, lambda: (pick(24), pick(35))),
        "party_address_asset": some(40, lambda: (pick(24), pick(60))),
        "item_mapping": some(8, lambda: (item(), item(), r.choice([33, 33, 34]), r.randrange(1, 7))),
        "item_main": some(5, lambda: (item(), site())),
        "instruction": some(12, lambda: (r.randrange(9), r.choice([1, 2]), text(60))),
    }


def load(spark, data, policy):
    frames = {}
    for name, ddl in SCHEMAS.items():
        plain = ddl.replace("timestamp_ntz", "string")
        df = spark.createDataFrame(data[name], plain)
        if name == "asset":
            df = df.withColumn("created_at", df["created_at"].cast("timestamp_ntz"))
        frames[name] = df
    return TableSet(frames, policy)


def as_dicts(data):
    return {
        name: [dict(zip([p.split()[0] for p in ddl.split(", ")], row)) for row in data[name]]
        for name, ddl in SCHEMAS.items()
    }


def in_order(tuples):
    return sorted(tuples, key=lambda t: [(v is not None, v) for v in t])


def test_awkward_tables_reach_most_labels():
    seen = Counter()
    for seed in range(4):
        seen.update(r[2] for r in rules.report(as_dicts(awkward_tables(seed)), CFG))
    assert len(seen) >= 12, seen


def test_awkward_tables_have_hot_keys(spark):
    """The last policy really splits: every profiled key column has a hot value."""
    tables = load(spark, awkward_tables(0), SkewPolicy(hot_rows=4))
    for table, columns in SKEW_COLUMNS.items():
        for column in columns:
            assert tables.hot(table, column), (table, column)


@pytest.mark.parametrize("sizes", list(POLICIES), indirect=True)
@pytest.mark.parametrize("seed", [0, 1])
def test_report_equals_the_rules(spark, seed, sizes):
    data = awkward_tables(seed)
    report = rc.root_cause_report(load(spark, data, sizes), CFG)
    expected = in_order(rules.report(as_dicts(data), CFG))
    assert rows(report, "asset_id", "contract_id", "root_cause", "original_asset_id") == expected
    assert report.columns == list(rc.REPORT_COLUMNS)


@pytest.mark.parametrize("sizes", list(POLICIES), indirect=True)
def test_variants_equal_the_rules(spark, sizes):
    data = awkward_tables(2)
    tables, plain = load(spark, data, sizes), as_dicts(data)
    labelled = rules.report(plain, CFG)
    status = variants.status_coalesce(tables, CFG)
    assert rows(status, "asset_id", "contract_id", "root_cause") == in_order(
        rules.coalesced(plain, CFG, labelled)
    )
    staged = variants.staged_agreement_summary(tables, CFG)
    assert rows(staged, "asset_id", "contract_id", "original_asset_id") == in_order(
        (a, n, o) for a, n, _, o in labelled
    )
    shown = {(r[0], r[1]): r[2:] for r in rows(
        staged, "asset_id", "contract_id", "source_label", "location_label", "customer_label"
    )}
    for asset, number, label, _ in labelled:
        source, location, customer = shown[asset, number]
        if label in (c.AGREEMENT_WITHOUT_ASSET, c.AGREEMENT_OTHER_ASSET):
            assert source == label
        if label == c.LOCATION_NOT_FOUND:
            assert (source, location) == (None, label)
        if label == c.CUSTOMER_NOT_FOUND:
            assert customer == label


@pytest.mark.parametrize("via", ["agreement", "value"])
@pytest.mark.parametrize("sizes", list(POLICIES), indirect=True)
def test_bridge_is_every_combination(spark, via, sizes):
    data = awkward_tables(3)
    tables, t = load(spark, data, sizes), as_dicts(data)
    expected = []
    for i in t["agreement_identifier"]:
        if i["identifier_type_id"] not in (111, 112):
            continue
        key = i["agreement_id"] if via == "agreement" else rules._number(i["identifier_value"])
        if key is None:
            continue
        for a in [a for a in t["agreement"] if a["agreement_id"] == key]:
            for k in [k for k in t["agreement_contract"] if k["agreement_id"] == key]:
                for s in [s for s in t["agreement_asset"] if s["agreement_id"] == key]:
                    expected.append(
                        (i["identifier_value"], i["agreement_id"], i["identifier_type_id"],
                         a["source_site_id"], k["contract_id"], s["asset_id"])
                    )
    got = rows(variants.agreement_bridge(tables, CFG, via))
    assert got == in_order(expected)


@pytest.mark.parametrize("sizes", list(POLICIES), indirect=True)
def test_flow_has_every_record_of_every_stage(spark, sizes):
    data = awkward_tables(5)
    tables, t = load(spark, data, sizes), as_dicts(data)
    report = rc.root_cause_report(tables, CFG).collect()
    address = {a["party_address_id"]: (a["customer_num"], a["ucid"]) for a in t["party_address"]}

    def linked(link, key, value):
        return {
            (r["party_address_id"], *address[r["party_address_id"]])
            for r in t[link] if r[key] == value and r["party_address_id"] in address
        }

    def ids(table, key, value, column):
        return {(r[column], None, None) for r in t[table] if r[key] == value}

    expected = []
    for r in report:
        key, cp = (r["asset_id"], r["contract_id"]), r["cp_agreement_id"]
        stages = {"customer": linked("party_address_asset", "asset_id", r["asset_id"])}
        if r["contract_id"] is not None:
            stages |= {"agreement": {(cp, None, None)} if cp is not None else set(), "mapping": set()}
        if cp is not None:
            stages |= {
                "contract": ids("agreement_contract", "agreement_id", cp, "contract_id"),
                "asset": ids("agreement_asset", "agreement_id", cp, "asset_id"),
                "location": linked("party_address_agreement", "agreement_id", cp),
            }
        for stage, records in stages.items():
            expected += [(*key, stage, *record) for record in records or {(None, None, None)}]
    flow = variants.staged_agreement_flow(tables, CFG)
    assert flow.columns == list(variants.FLOW_COLUMNS)
    assert rows(flow, "asset_id", "contract_id", "stage", "record_id", "customer_num", "ucid") == in_order(expected)
    labels = {(r["asset_id"], r["contract_id"], r["stage"]): r["label"] for r in flow.collect()}
    fitting = {(r["asset_id"], r["contract_id"], r["stage"]) for r in flow.collect() if r["fits"]}
    for r in report:
        key = (r["asset_id"], r["contract_id"])
        assert (labels[(*key, "customer")] is None) == r["customer_ok"]
        if r["cp_agreement_id"] is not None:
            assert (labels[(*key, "location")] is None) == r["location_ok"] == ((*key, "location") in fitting)
            assert (labels[(*key, "asset")] is None) == r["has_this_asset"] == ((*key, "asset") in fitting)


@pytest.mark.parametrize("table", ["asset", "contract", "agreement", "party_address"])
def test_a_duplicate_id_is_an_error(spark, table):
    data = awkward_tables(1)
    used = {
        "asset": lambda r: r["asset_id"],
        "contract": lambda r: r["contract_id"],
        "agreement": lambda r: r["cp_agreement_id"],
    }
    report = rc.root_cause_report(load(spark, data, SkewPolicy()), CFG).collect()
    known = {row[0] for row in data[table]}
    wanted = {used[table](r) for r in report} & known if table in used else known
    twin = [row for row in data[table] if row[0] in wanted and row[0] is not None]
    data[table] = data[table] + (twin if table == "party_address" else twin[:1])
    with pytest.raises(Exception, match="more than one row for"):
        rc.root_cause_report(load(spark, data, SkewPolicy()), CFG).collect()


def test_all_labels_occur_on_given_tables(spark):
    """With several records per key, unknown sites and identifiers that are no numbers."""
    labels = rc.root_cause_ladder(derive_tables(spark, SMALL), CFG)
    found = dict(rows(labels.groupBy("root_cause").count()))
    assert set(found) == {
        c.ORIGINAL_NOT_FOUND, c.ORIGINAL_WITHOUT_ENTITLEMENT, c.DUAL_SERIALIZED, c.NOT_ELIGIBLE, c.AGREEMENT_NOT_FOUND,
        c.AGREEMENT_WITHOUT_ASSET, c.AGREEMENT_OTHER_ASSET, c.LOCATION_NOT_FOUND, c.CUSTOMER_NOT_FOUND, c.MAPPING_MISSING,
        c.MAIN_ITEM_MISSING, c.INSTRUCTION_ERROR, c.AGREEMENT_OTHER, c.OTHER,
    }


def test_order_of_input_and_unrelated_rows_do_not_matter(spark):
    data = awkward_tables(4)
    base = rows(rc.root_cause_ladder(load(spark, data, SkewPolicy()), CFG))
    moved = {name: list(reversed(table)) for name, table in data.items()}
    moved["contract"] = moved["contract"] + [(900, "A", 6)]
    moved["agreement_asset"] = moved["agreement_asset"] + [(900, 900)]
    moved["party_address"] = moved["party_address"] + [(900, 5, 5)]
    assert rows(rc.root_cause_ladder(load(spark, moved, SkewPolicy()), CFG)) == base
    pairs = [(a, n) for a, n, _ in base]
    assert len(pairs) == len(set(pairs))


def test_stored_tables_with_other_names(spark, tmp_path):
    """Physical table and column names may differ; a timestamp may have a zone."""
    data = awkward_tables(0)
    tables = load(spark, data, SkewPolicy())
    for name in tables:
        df = tables[name]
        if name == "agreement":
            df = df.withColumnRenamed("source_site_id", "SITE")
        if name == "asset":
            df = df.withColumn("created_at", df["created_at"].cast("timestamp"))
        df.write.parquet(str(tmp_path / f"raw_{name}"))
    stored = TableSet.from_parquet(
        spark,
        str(tmp_path),
        names={name: f"raw_{name}" for name in SCHEMAS},
        columns={"agreement": {"SITE": "source_site_id"}},
    )
    expected = in_order(r[:3] for r in rules.report(as_dicts(data), CFG))
    assert rows(rc.root_cause_ladder(stored, CFG)) == expected


def test_no_candidates_give_an_empty_report(spark):
    """The default rules look at another period than the derived tables have."""
    report = rc.root_cause_report(derive_tables(spark, SMALL), c.RuleConfig())
    assert report.columns == list(rc.REPORT_COLUMNS)
    assert report.count() == 0


def test_summary_gets_addresses_before_the_pairs(spark, monkeypatch):
    """They are looked up once per agreement and asset; wide pairs are not written for it."""

    def refused(*_):
        raise AssertionError("the summary writes pairs")

    monkeypatch.setattr(variants, "stage", refused)
    summary = variants.staged_agreement_summary(derive_tables(spark, SMALL), FIXTURE_RULES)
    assert summary.columns == list(variants.SUMMARY_COLUMNS)
    shown = summary.where("cp_address_id is not null and asset_address_id is not null")
    assert shown.count() > 0
