"""Session settings the engine relies on."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Row semantics depend on these three; everything else is left to the cluster.
SEMANTIC_SETTINGS = {
    # Times without a zone are UTC.
    "spark.sql.session.timeZone": "UTC",
    # One bad row must give NULL, never fail the job (user rules are plain SQL text).
    "spark.sql.ansi.enabled": "false",
    # The last of several equal JSON keys wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}
# Plans here have thousands of expressions. Recording a Python call site for each one costs
# more than planning itself.
PLANNING_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Set what row semantics need on an existing session."""
    for key, value in SEMANTIC_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "sluice", **conf: str) -> SparkSession:
    """A session for tests and single-machine runs."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    for key, value in {**SEMANTIC_SETTINGS, **PLANNING_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


class WorkFolder:
    """Tables that cut the lineage of a job, in a folder that all executors share.

    The folder lies below ``spark.checkpoint.dir``, else below ``below`` (a job's warehouse),
    else below the session's warehouse. No setting of the session is changed. ``close`` deletes
    it; a job does so when it has succeeded, so that a failed one can be looked into.
    """

    def __init__(self, spark: SparkSession, name: str, below: str | None = None):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            root = f"{(below or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/_work"
            local = re.match(r"(file:|/)", root) and spark.conf.get("spark.hadoop.fs.defaultFS", "file:").startswith("file:")
            if local and not spark.sparkContext.master.startswith("local"):
                raise ValueError(f"{root} is a local folder; set spark.checkpoint.dir to one that all executors share")
        self.spark, self.path = spark, f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table of this folder, read back."""
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        self.drop("")


def work_dir(spark: SparkSession, name: str, below: str | None = None) -> str:
    """Path of a fresh work folder."""
    return WorkFolder(spark, name, below).path
