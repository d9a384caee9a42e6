"""Session, table and scratch-folder helpers shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "roadloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the library assumes (UTC, AQE); a cluster sets its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir where the cluster names it.

    Only where that setting is absent and the master is this machine (tests) a temporary folder is made, once a session; a
    cluster without the setting is an error, as each executor would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    own = spark.conf.get("roadloom.scratch", None)
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = "file://" + tempfile.mkdtemp(prefix="roadloom-")
        spark.conf.set("roadloom.scratch", own)
        atexit.register(shutil.rmtree, own[7:], True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(own)
    return own


_RUN_DIRS: set[str] = set()


def run_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared one; drop_scratch() removes it, at the latest when the process ends."""
    at = f"{shared_dir(spark)}/roadloom-{spark.sparkContext.applicationId}"
    if at not in _RUN_DIRS:
        _RUN_DIRS.add(at)
        atexit.register(_drop_at_end, at)
    return at


def _drop_at_end(path: str) -> None:
    """Delete a run's folder when Python ends; the JVM is still there then, even if its session was stopped."""
    from pyspark import SparkContext

    try:
        jvm = SparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)
    except Exception:  # noqa: BLE001  the gateway is gone: the shared folder's own expiry has to do it
        return


def file_system(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of a path on whatever storage it names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def drop_scratch(spark: SparkSession) -> None:
    """Delete what the session's operators have written to the shared folder (their results can no longer be read)."""
    fs, at = file_system(spark, run_dir(spark))
    fs.delete(at, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; [] if it is not there."""
    fs, at = file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, complete or not there: written beside and renamed."""
    fs, at = file_system(spark, path)
    _, part = file_system(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(at, False)
    if not fs.rename(part, at):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def persist_table(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def bounded_sample(df: DataFrame, by: str, size: int) -> list:
    """About size rows (at most twice as many) for fitting a model, chosen by a hash of column `by` over the whole table.

    The rows are counted first, so every row has the same chance whatever the table's size; sorted for determinism.
    """
    from pyspark.sql import functions as F

    n = df.select(F.count(F.lit(1))).first()[0]
    if n > size:
        df = df.where(F.pmod(F.xxhash64(F.lit("sample"), by), F.lit(1_000_000)) < int(1_000_000 * size / n) + 1)
    return sorted(df.limit(2 * size).collect(), key=lambda r: (str(r[by]), str(r)))


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary; the folder is a parameter (ROADLOOM_TOKENIZERS)."""
    return os.path.join(os.environ.get("ROADLOOM_TOKENIZERS", "/opt/tokenizers"), name)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session (they may lack it on a cluster)."""
    if spark.conf.get("roadloom.shipped", None) == spark.sparkContext.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    made = tempfile.mkdtemp(prefix="roadloom-zip-")
    atexit.register(shutil.rmtree, made, True)
    src = os.path.join(made, "src")
    shutil.copytree(root, os.path.join(src, os.path.basename(root)), ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(made, "roadloom"), "zip", src))
    spark.conf.set("roadloom.shipped", spark.sparkContext.applicationId)
