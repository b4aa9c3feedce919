"""Writing an intermediate result once, and cutting tables to the keys in use."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gapwise.operators.skew import HotKeys, SkewPolicy, estimated_bytes, hot_keys, spread_join


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results that every executor sees.

    It is the context's checkpoint folder or the one in ``spark.checkpoint.dir``. Only
    where Spark runs inside one process, as in tests, a temporary folder is set if
    neither is; on a cluster that is an error, since no machine's own folder would do.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors see")
        folder = tempfile.mkdtemp(prefix="gapwise-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return (context.getCheckpointDir() or folder).rstrip("/")


@dataclass(frozen=True)
class Staged:
    """A frame that was written, and how many rows it has."""

    df: DataFrame
    rows: int
    policy: SkewPolicy

    def hot(self, column: str) -> HotKeys:
        """Hot keys of a column; a frame with fewer rows than make a key hot is not read for it."""
        if self.rows <= self.policy.hot_rows:
            return {}
        return hot_keys(self.df, [column], self.policy)[column]


def stage(df: DataFrame, policy: SkewPolicy) -> Staged:
    """Compute a frame that many later steps read, once, and count it on the way.

    It is written as Parquet to the shared folder, so that lost executors do not
    lose it, later steps read the columns they need, and the optimizer knows its
    size. The files stay until the folder's owner removes them, as the frames that
    read them are lazy.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    observed = Observation()
    written = write(df.observe(observed, F.count(F.lit(1)).alias("rows")), path)
    return Staged(written, observed.get["rows"], policy)


def write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_to_keys(
    table: DataFrame,
    keys: DataFrame,
    key: str,
    hot: Callable[[], HotKeys] | None = None,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Rows of a table whose key occurs in another frame.

    A semi join without a hint: Spark broadcasts the keys if it estimates them below its
    own bound, which cuts the table in its scan, and shuffles both sides if not. Only
    then ``hot`` is asked for keys of the table to split, by ``spread``.
    """
    keys = keys.select(key).where(F.col(key).isNotNull())
    if hot is None or is_broadcast(keys):
        return table.join(keys, key, "left_semi")
    return spread_join(table, keys.distinct(), [key], "left_semi", hot_left=hot(), spread_left=spread)


def is_broadcast(df: DataFrame) -> bool:
    """Would Spark broadcast this frame? Estimates come from the sizes of files."""
    size = estimated_bytes(df)
    bound = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return size is not None and size <= bound
