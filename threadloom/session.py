"""Session settings and lineage cuts."""

import atexit
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(name: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own session, which names
    a shared folder in ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The reliable folder the cluster names in ``spark.checkpoint.dir``.

    Only where it is unset on a local master a fresh local folder is taken; on a cluster a
    machine-local folder would not survive, so that is an error.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="threadloom-")
        context.setCheckpointDir(folder)
    return folder


_owned: set[str] = set()


def stage_folder(spark: SparkSession) -> str:
    """The folder of this application's stages; the application owns and deletes it."""
    folder = f"{shared_folder(spark)}/threadloom-{spark.sparkContext.applicationId}"
    if folder not in _owned:
        _owned.add(folder)
        atexit.register(_drop, spark._jvm, spark._jsc.hadoopConfiguration(), folder)
    return folder


def new_stage(spark: SparkSession) -> str:
    """A path of a new stage."""
    return f"{stage_folder(spark)}/stage-{uuid.uuid4().hex}"


def _drop(jvm, configuration, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(configuration).delete(path, True)
    except Exception:  # at exit the JVM may be gone already; then the folder stays
        return
    _owned.discard(folder)


def drop_stages(spark: SparkSession) -> None:
    """Delete all stages of this application; frames that read them are of no use any more.

    Call it when results are written. At a normal exit it is done as well.
    """
    _drop(spark._jvm, spark._jsc.hadoopConfiguration(), stage_folder(spark))


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to a table in the shared folder and read it from there.

    Later uses neither recompute it nor depend on the executors that made it, and the
    Parquet table keeps column pruning and gives the optimizer its real size, so the
    adaptive plan picks its joins by itself. ``drop_stages`` deletes the table.
    """
    path = new_stage(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def place() -> Column:
    """An id of each row of a table read from files: its file and its index there."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("index"))


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (or of an absolute local path), and the path in it, for files
    that tasks write or read themselves in the shared folder."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
