"""Session settings the operators rely on, and the shared checkpoint folder."""

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a deployment should start with. Parallelism is left to the cluster
# (spark.sql.shuffle.partitions sized so a partition fits executor memory; AQE
# coalesces small ones and splits skewed ones).
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Single-machine session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("vacantia")
    conf = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster
    a machine-local path would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="vacantia-")
    return _LOCAL_DIRS[app]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
