"""Session set-up, table access and shipping of the package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_SHIPPED: set[str] = set()


def local_session(cores: int | str = "*", shuffle: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the engine's semantics need (UTC clock, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chatloom")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.environ.get("CHATLOOM_SHARED", "file:///tmp/chatloom-shared"))
        .config("spark.driver.memory", os.environ.get("CHATLOOM_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    ship(session)
    return session


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table `name` below `directory`."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


SPREAD_BYTES = 1 << 30  #: a table beyond this has splits enough, and is never shuffled only to be spread


def spread(df: DataFrame, most: int | None = SPREAD_BYTES) -> DataFrame:
    """`df`, dealt out over all cores if it is small and comes in fewer than half as many splits.

    For work that is heavy on each row: a small file is often a single split and would keep one core
    busy. Tables of more than `most` bytes (None: of any size), and tables with splits enough, stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    run = df._jdf.queryExecution()
    if most is not None and int(run.optimizedPlan().stats().sizeInBytes()) > most or 2 * run.toRdd().getNumPartitions() > cores:
        return df
    return df.repartition(cores)


def ship(spark: SparkSession) -> None:
    """Make the package importable by workers that don't share the driver's path, in local mode too.

    Python functions of the package are pickled by reference, so a cluster's workers must be able
    to import it. A zip of the sources (a few hundred kB) is added once a Spark application.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    target = Path(tempfile.mkdtemp(prefix="chatloom-")) / "chatloom_src.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as bundle:
        for path in sorted(_PACKAGE.rglob("*.py")):
            bundle.write(path, str(path.relative_to(_PACKAGE.parent)))
    context.addPyFile(str(target))
