"""Session, table and lineage helpers shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for one machine, as tests and the bench use it."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("textlens")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_fallback: list[str] = []  # the local folder of this process, once one was needed
_scratch: set[str] = set()  # places of the tables of ``written()`` that still exist


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir if set, else (one machine only) a local one.

    The key belongs to the core, so a running session cannot take it; the local folder is remembered here.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        return where
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _fallback:
        _fallback.append("file://" + tempfile.mkdtemp(prefix="textlens-"))
        atexit.register(shutil.rmtree, _fallback[0][7:], ignore_errors=True)
    return _fallback[0]


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder with Spark's checkpoint(): the result survives lost executors."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write df as Parquet under a fresh name in the shared folder (in a folder for each value of ``by``) and read it again.

    Unlike checkpoint() the table is columnar: a reader that needs two columns reads two.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
    out._written_at = path
    _scratch.add(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _scratch.discard(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder that ``sweep`` deletes as well, for a query's own files."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.add(path)
    return path


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of ``written()`` that nothing reads any more, as a loop's last state once the next is written."""
    for df in tables:
        if path := getattr(df, "_written_at", None):
            _delete(df.sparkSession, path)


def sweep() -> None:
    """Delete every table of ``written()`` and place of ``scratch()`` that still exists: once the results of all queries so far have been read."""
    spark = SparkSession.getActiveSession()
    for path in list(_scratch) if spark is not None else ():
        _delete(spark, path)
