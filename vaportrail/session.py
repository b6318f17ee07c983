"""Session settings and the shared scratch folder every job relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Instants are UTC everywhere: dates, hour buckets and key texts depend on it.
# Adaptive execution splits skewed joins and rebalanced writes at run time.
# The JVM never compiles methods above 8000 bytes; a generated stage that grows
# beyond runs several times faster split up by operator.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Input bytes one shuffle partition should stand for, and the most partitions
# that still pay off: every map task writes one block per partition.
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
PARTITION_BYTES = 256 << 20
MOST_PARTITIONS = 40_000


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the models need to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def fit_shuffle_to(spark: SparkSession, size: int) -> None:
    """Raise the number of shuffle partitions to suit so many bytes of input.

    Adaptive execution merges partitions that turn out small but cannot add
    any, and the default of 200 is far too few for a table of many terabytes.
    The session keeps the setting; ``shuffle_width`` gives it back.
    """
    wanted = min(size // PARTITION_BYTES, MOST_PARTITIONS)
    if wanted > int(spark.conf.get(SHUFFLE_PARTITIONS)):
        spark.conf.set(SHUFFLE_PARTITIONS, str(wanted))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get(SHUFFLE_PARTITIONS))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files a query reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    # Relations of unknown size claim the largest possible one.
    return sum(size for size in sizes if size < 1 << 60)


class _Widths:
    """Who is using a raised setting: the last to leave gives back what the first found."""

    def __init__(self):
        self.lock, self.users, self.found = threading.Lock(), 0, None


_WIDTHS = _Widths()


@contextmanager
def shuffle_width(df: DataFrame) -> Iterator[DataFrame]:
    """While a write of ``df`` runs, as many shuffle partitions as its input needs.

    Models built side by side share the session and with it the widest setting.
    """
    spark, size = df.sparkSession, input_bytes(df)
    with _WIDTHS.lock:
        if _WIDTHS.users == 0:
            _WIDTHS.found = spark.conf.get(SHUFFLE_PARTITIONS)
        _WIDTHS.users += 1
        fit_shuffle_to(spark, size)
    try:
        yield df
    finally:
        with _WIDTHS.lock:
            _WIDTHS.users -= 1
            if _WIDTHS.users == 0:
                spark.conf.set(SHUFFLE_PARTITIONS, _WIDTHS.found)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same context whose Parquet aggregates come from the files' footers.

    Maxima and counts are pushed down by the newer file reader only, which a setting
    chooses for a whole session; this one leaves the caller's plans as they are.
    """
    side = spark.newSession()
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return side


def local_session(name: str, cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A single-machine session may go without; it then gets a fresh temporary
    folder. A cluster may not, because executors cannot see each other's disks.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        scratch = tempfile.mkdtemp(prefix="vaportrail-")
        # A single machine's scratch goes with the driver.
        atexit.register(shutil.rmtree, scratch, ignore_errors=True)
        context.setCheckpointDir(scratch)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/vaportrail/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """The same rows from a written table: computed once, and there when executors are lost."""
    with shuffle_width(df):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
