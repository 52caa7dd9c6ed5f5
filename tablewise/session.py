"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tablewise", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    ANSI mode stays on (Spark 4 default); operators use try_* functions where
    the reference coerces silently.  On a cluster pass ``master=None`` and let
    spark-submit decide; ``shuffle_partitions`` should then be sized so one
    partition holds ~128-256 MB of shuffle data.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    cpus = os.environ.get("BENCH_CPUS")
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          # coalesce shuffle partitions to ~128 MB instead of keeping many tiny ones
          .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
          .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.driver.memory", os.environ.get("TABLEWISE_DRIVER_MEMORY", "8g"))
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = int(cpus) if cpus else 8
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the context if needed.

    The cluster names the folder in ``spark.checkpoint.dir``; it is read from
    the session.  Only a local-mode session with no setting gets a fresh
    temporary folder (tests); a cluster without the setting is an error,
    because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3) "
                               "before running iterative operators")
        conf = tempfile.mkdtemp(prefix="tablewise-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared folder) to bound the plan of
    iterative algorithms; survives executor loss unlike a local checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The table as Parquet files in the checkpoint folder, for loops of joins: a checkpoint keeps
    what the optimizer knows of order and columns, which grows on the driver with every
    round of renamed columns; files know their columns only."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tablewise`` importable in the Python workers (the pandas-task
    operators pickle references to its functions): zip the package once and
    ``addPyFile`` it, as ``spark-submit --py-files`` would."""
    import shutil
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="tablewise-pyfiles-")
    base = os.path.join(out, "tablewise")
    shutil.make_archive(base, "zip", root_dir=os.path.dirname(pkg_dir), base_dir="tablewise")
    sc.addPyFile(base + ".zip")
    _SHIPPED.add(key)
