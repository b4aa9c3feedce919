"""Named tables: schemas, physical names and statistics on hot keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.operators.skew import HotKeys, SkewPolicy, hot_keys

#: table -> DDL of the columns that are used. The first column of asset,
#: contract, agreement and party_address identifies the row.
SCHEMAS = {
    "asset": (
        "asset_id bigint, serial_num string, manufacturer_id bigint, item_class string, "
        "source_site_id int, customer_num bigint, order_num bigint, create_pgm string, "
        "created_at timestamp_ntz"
    ),
    "asset_relationship": "from_asset_id bigint, to_asset_id bigint, relationship_type_id int",
    "contract": "contract_id bigint, item_num string, source_site_id int",
    "contract_coverage": "contract_id bigint, asset_id bigint",
    "contract_identifier": "contract_id bigint, identifier_value string, identifier_type_id int",
    "agreement": "agreement_id bigint, source_site_id int",
    "agreement_contract": "agreement_id bigint, contract_id bigint",
    "agreement_identifier": "agreement_id bigint, identifier_type_id int, identifier_value string",
    "agreement_asset": "agreement_id bigint, asset_id bigint",
    "party_address": "party_address_id bigint, customer_num bigint, ucid bigint",
    "party_address_agreement": "party_address_id bigint, agreement_id bigint",
    "party_address_asset": "party_address_id bigint, asset_id bigint",
    "item_mapping": "item_num_a string, item_num_b string, application_id int, map_type_id int",
    "item_main": "item_num string, source_site_id int",
    "instruction": "instr_id bigint, entity_type_id int, entity_value string",
}

#: join keys whose values may repeat very often, per table
SKEW_COLUMNS = {
    "asset_relationship": ("from_asset_id", "to_asset_id"),
    "contract": ("item_num",),
    "contract_coverage": ("contract_id", "asset_id"),
    "agreement_contract": ("agreement_id",),
    "agreement_identifier": ("agreement_id", "counterpart_id"),
    "agreement_asset": ("agreement_id",),
    "party_address_agreement": ("party_address_id", "agreement_id"),
    "party_address_asset": ("party_address_id", "asset_id"),
}


def scan(tables: Mapping[str, DataFrame], name: str, columns: Mapping[str, str]) -> DataFrame:
    """Some columns of a named table under new names; the rest is never read."""
    return tables[name].select(*[F.col(source).alias(alias) for source, alias in columns.items()])


class TableSet(Mapping):
    """Frames by logical name, or functions that make them when first asked for.

    Statistics on hot keys are taken once, on demand.
    """

    def __init__(
        self,
        frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
        skew: SkewPolicy | None = None,
    ):
        self._frames = dict(frames)
        self._hot: dict[str, dict[str, HotKeys]] = {}
        self.skew = skew or SkewPolicy()

    def __getitem__(self, name: str) -> DataFrame:
        frame = self._frames[name]
        if callable(frame):
            frame = self._frames[name] = frame()
        return frame

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def replace(self, **frames: DataFrame) -> TableSet:
        return TableSet({**self._frames, **frames}, self.skew)

    def hot(self, table: str, column: str) -> HotKeys:
        """Hot values of a join key. All such columns of a table are read in one pass."""
        if table not in self._hot:
            df = self[table]
            if table == "agreement_identifier":
                df = df.withColumn("counterpart_id", F.col("identifier_value").try_cast("bigint"))
            self._hot[table] = hot_keys(df, SKEW_COLUMNS[table], self.skew)
        return self._hot[table][column]

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        base_path: str,
        names: Mapping[str, str] | None = None,
        columns: Mapping[str, Mapping[str, str]] | None = None,
        skew: SkewPolicy | None = None,
    ) -> TableSet:
        """Read every table below a path with its declared schema.

        ``names`` maps logical to physical table names and ``columns`` physical
        to logical column names, where they differ.
        """

        def read(physical: str) -> DataFrame:
            return spark.read.parquet(f"{base_path}/{physical}")

        return cls(_conform(read, names or {}, columns or {}), skew)

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        database: str,
        names: Mapping[str, str] | None = None,
        columns: Mapping[str, Mapping[str, str]] | None = None,
        skew: SkewPolicy | None = None,
    ) -> TableSet:
        """The same from catalog tables, for example those of a Hive metastore."""

        def read(physical: str) -> DataFrame:
            return spark.table(f"{database}.{physical}")

        return cls(_conform(read, names or {}, columns or {}), skew)


def _conform(
    read: Callable[[str], DataFrame],
    names: Mapping[str, str],
    columns: Mapping[str, Mapping[str, str]],
) -> dict[str, DataFrame]:
    frames = {}
    for name, ddl in SCHEMAS.items():
        logical = {c: kind for c, kind in (part.split() for part in ddl.split(", "))}
        physical = {target: source for source, target in columns.get(name, {}).items()}
        df = read(names.get(name, name))
        kinds = {c.lower(): kind for c, kind in df.dtypes}
        frames[name] = df.select(
            *[_typed(physical.get(c, c), kinds, kind).alias(c) for c, kind in logical.items()]
        )
    return frames


def _typed(column: str, kinds: Mapping[str, str], kind: str):
    """Cast only where needed, as a cast on a filter column would hide it from the scan."""
    found = kinds.get(column.lower())
    if found == kind or (kind.startswith("timestamp") and str(found).startswith("timestamp")):
        return F.col(column)
    return F.col(column).cast(kind)


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan over at least as many tasks as there are cores.

    Few row groups give few tasks, however much work each row is. A scan that has
    enough tasks stays as it is, so that nothing large is shuffled for this.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df
