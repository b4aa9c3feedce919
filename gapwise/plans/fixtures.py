"""The fifteen tables derived from the generated TPC-H-like tables by arithmetic.

There is no published data for the analysis. The derivation gives every label
and grows with the given tables; ``FIXTURES.md`` states it in words.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.config import RuleConfig
from gapwise.operators.skew import SkewPolicy
from gapwise.operators.staging import stage
from gapwise.sources.tables import TableSet

#: rule constants that fit the derived tables
FIXTURE_RULES = RuleConfig(
    programs=("PGM.A", "PGM.B", "PGM.C"),
    window_start="1996-01-01 00:00:00",
    window_end="2001-01-01 00:00:00",
    ineligible_items=("IT0", "IT7", "IT14", "IT21", "IT28"),
)


def _int(value: str) -> str:
    return f"cast({value} as int)"


def _rows(df: DataFrame, *structs: Column) -> DataFrame:
    """One output row per struct that is not NULL, in a single pass over ``df``.

    All of it stays inside code generation: NULL structs are dropped after ``inline``,
    by a column that only the others have.
    """
    return df.select(F.inline(F.array(*structs))).where("_made").drop("_made")


def _row(condition: str, **columns: str) -> Column:
    fields = ", ".join(f"{expr} as {name}" for name, expr in columns.items())
    return F.expr(f"case when {condition} then struct({fields}, true as _made) end")


def derive_tables(
    spark: SparkSession, sf_dir: str, skew: SkewPolicy | None = None
) -> TableSet:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey as k",
        "o_orderkey div 2 as j",
        "o_orderkey % 2 = 0 as even",
        "o_custkey as cust",
        "o_orderpriority as priority",
        "o_orderdate as ordered_at",
    )
    policy = skew or SkewPolicy()

    @cache
    def contract_ids() -> DataFrame:
        """Five tables come from this aggregate of the largest table, so it is made once."""
        ids = (
            spark.read.parquet(f"{sf_dir}/lineitem.parquet")
            .where("l_orderkey % 2 = 1 or (l_orderkey div 2) % 17 = 0")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.min("l_partkey").alias("partkey"))
            .selectExpr(
                "l_orderkey * 10 + l_linenumber as c",
                "l_orderkey + l_linenumber as s",
                "partkey",
            )
        )
        return stage(ids, policy).df

    item_ids = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey as n").distinct()

    asset = orders.selectExpr(
        "k as asset_id",
        "concat('SN', k) as serial_num",
        "cust % 50 as manufacturer_id",
        "priority as item_class",
        _int("case when j % 23 = 0 then null when j % 3 = 0 then 6 else 1 end") + " as source_site_id",
        "case j % 7 when 0 then null when 1 then 0L else cust + 1 end as customer_num",
        "if(even, 99999L, k) as order_num",
        "case j % 4 when 0 then 'PGM.A' when 1 then 'PGM.B' when 2 then 'PGM.C' else 'OTHER' end"
        " as create_pgm",
        "ordered_at as created_at",
    )
    relationship = _rows(
        orders.where("even"),
        _row(
            "true",
            from_asset_id="k",
            to_asset_id="k + 1",
            relationship_type_id=_int("if(j % 11 = 0, 4, 9)"),
        ),
        _row("j % 14 = 3", from_asset_id="k", to_asset_id="k + 3", relationship_type_id="9"),
    )

    def contract() -> DataFrame:
        return contract_ids().selectExpr(
            "c as contract_id",
            "concat('IT', partkey) as item_num",
            _int("case when s % 19 = 0 then null when s % 4 = 0 then 6 else 1 end") + " as source_site_id",
        )

    def coverage() -> DataFrame:
        dangling = orders.where("even and j % 13 = 0").selectExpr(
            "90000000 + k as contract_id", "k as asset_id"
        )
        covered = _rows(
            contract_ids(),
            _row("true", contract_id="c", asset_id="c div 10"),
            _row("c % 10 = 4", contract_id="c", asset_id="c div 10 + 2"),
        )
        return covered.unionByName(dangling)

    def contract_identifier() -> DataFrame:
        return contract_ids().where("c % 7 = 0").selectExpr(
            "c + 5000000 as contract_id",
            "if(c % 21 = 0, concat('C-', c), cast(c as string)) as identifier_value",
            _int("if(c % 2 = 0, 106, 105)") + " as identifier_type_id",
        )

    def agreement_contract() -> DataFrame:
        counterparts = _rows(
            orders.where("even"),
            _row("true", agreement_id="2000000 + k", contract_id="90000000 + k"),
            _row("j % 6 = 1", agreement_id="2000000 + k", contract_id="91000000 + k"),
        )
        own = _rows(
            contract_ids().where("c % 10 <= 4"),
            _row("true", agreement_id="1000000 + c div 10", contract_id="c"),
            _row("c % 10 = 3", agreement_id="1000000 + c div 10 + 2", contract_id="c"),
        )
        return own.unionByName(counterparts)

    def instruction() -> DataFrame:
        return contract_ids().where("c % 5 < 2").selectExpr(
            "c as instr_id",
            _int("1 + c % 2") + " as entity_type_id",
            "if(c % 11 = 0, 'none', cast(c as string)) as entity_value",
        )

    agreement = orders.selectExpr(
        "if(even, 2000000 + k, 1000000 + k) as agreement_id",
        _int("case when j % 17 = 0 then null when j % if(even, 3, 2) = 0 then 6 else 1 end") + " as source_site_id",
    )
    agreement_identifier = _rows(
        orders.where("not even"),
        _row(
            "true",
            agreement_id="1000000 + k",
            identifier_type_id=_int("case j % 9 when 0 then 110 when 1 then 112 else 111 end"),
            identifier_value="cast(2000000 + k - 1 as string)",
        ),
        _row(
            "j % 12 = 5",
            agreement_id="1000000 + k",
            identifier_type_id="112",
            identifier_value="cast(2000000 + k + 1 as string)",
        ),
        _row("j % 10 = 7", agreement_id="1000000 + k", identifier_type_id="111", identifier_value="concat('A', k)"),
    )
    agreement_asset = _rows(
        orders.where("if(even, j % 5 <> 0, j % 5 <> 2)"),
        _row(
            "true",
            agreement_id="if(even, 2000000 + k, 1000000 + k)",
            asset_id="if(even and j % 5 = 1, k + 2, k)",
        ),
        _row("even and j % 7 = 3", agreement_id="2000000 + k", asset_id="k + 4"),
    )
    party_address = orders.where("even").selectExpr(
        "k as party_address_id",
        "case j % 6 when 1 then 0L when 2 then null else cust + 1 end as customer_num",
        "case j % 9 when 3 then null when 6 then 0L else cust + 1000 end as ucid",
    )
    item_mapping = item_ids.selectExpr(
        "concat('IT', n) as item_num_a",
        "concat('IT', n + 1) as item_num_b",
        _int("if(n % 10 = 3, 34, 33)") + " as application_id",
        _int("1 + n % 6") + " as map_type_id",
    )
    item_main = item_ids.selectExpr(
        "concat('IT', n) as item_num", _int("if(n % 2 = 0, 6, 1)") + " as source_site_id"
    )
    return TableSet(
        {
            "asset": asset,
            "asset_relationship": relationship,
            "contract": contract,
            "contract_coverage": coverage,
            "contract_identifier": contract_identifier,
            "agreement": agreement,
            "agreement_contract": agreement_contract,
            "agreement_identifier": agreement_identifier,
            "agreement_asset": agreement_asset,
            "party_address": party_address,
            "party_address_agreement": _rows(
                orders.where("even and j % 8 <> 0"),
                _row("true", party_address_id="k", agreement_id="2000000 + k"),
                _row("j % 5 = 2", party_address_id="k + 2", agreement_id="2000000 + k"),
            ),
            "party_address_asset": _rows(
                orders.where("even and j % 8 <> 1"),
                _row("true", party_address_id="k", asset_id="k"),
                _row("j % 7 = 2", party_address_id="k + 4", asset_id="k"),
            ),
            "item_mapping": item_mapping,
            "item_main": item_main,
            "instruction": instruction,
        },
        policy,
    )
