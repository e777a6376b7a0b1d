"""Session settings, the shared staging area and the broadcast size check."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# A lookup of at most this many rows may be broadcast. The widest lookup row here
# is below 300 bytes, so the largest broadcast stays near 30 MB.
BROADCAST_ROWS = 100_000


def build_session(app: str = "costweave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a private one only in local mode."""
    context = spark.sparkContext
    root = (
        spark.conf.get(CHECKPOINT_DIR, None)
        or context.getConf().get(CHECKPOINT_DIR)
        or context.getCheckpointDir()
    )
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="costweave-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/costweave/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}/{name}"


def clear_staging(spark: SparkSession) -> None:
    """Remove what this application staged. Call it once its results are stored."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage without tying it to executors, lets later steps prune
    columns, and gives the optimizer the true size of an aggregate.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` hinted for broadcast when its size allows it, else unchanged.

    Pass a reference table or a staged aggregate: the check reads its rows. A
    lookup above the limit is joined by shuffle, with adaptive skew splitting.
    """
    return lookups(df, max_rows=max_rows)[0]


def lookups(*frames: DataFrame, max_rows: int = BROADCAST_ROWS) -> list[DataFrame]:
    """``lookup`` for several tables with one size check."""
    marked = [
        df.limit(max_rows + 1).select(F.lit(i).alias("frame")) for i, df in enumerate(frames)
    ]
    counts = dict(reduce(DataFrame.union, marked).groupBy("frame").count().collect())
    return [
        F.broadcast(df) if counts.get(i, 0) <= max_rows else df for i, df in enumerate(frames)
    ]


def lookup_join(
    facts: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread_by: str,
    max_rows: int = BROADCAST_ROWS,
    salts: int = 64,
) -> DataFrame:
    """Inner join of a large table with a small one on few, heavy keys.

    Within the size limit the small side is broadcast and the large side never
    moves. Beyond it both sides are salted: ``spread_by`` splits each heavy key
    of the large side over ``salts`` partitions and the small side is repeated
    once per salt, so no key ends in a single task.
    """
    if fits_broadcast(small, max_rows):
        return facts.join(F.broadcast(small), keys)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        facts.withColumn("_salt", salt).join(repeated, [*keys, "_salt"]).drop("_salt")
    )
