"""Versioned stages: a new version appears at once or not at all, and readers keep the one they chose.

A stage is a folder. The rows of a version lie in ``version-<id>``; the numbered file in
``versions`` that names it makes it current. That file is written under another name and then
renamed, which fails if the number is taken: so a crash leaves the last version, and of two
writers that began from the same version one gets an error. Nothing that a reader uses is
moved; ``drop_versions`` deletes what is no longer wanted.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _hadoop(spark: SparkSession, path: str):
    """A path, its file system, and what renames in it without overwriting."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """The folder of each version by its number."""
    target, system, _ = _hadoop(spark, f"{path}/versions")
    if not system.exists(target):
        return {}
    found = {}
    for status in system.listStatus(target):
        name = status.getPath().getName()
        if name.isdigit():
            stream = system.open(status.getPath())
            try:
                found[int(name)] = f"{path}/{bytes(stream.readAllBytes()).decode()}"
            finally:
                stream.close()
    return found


def read_stage(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the current version, or of a given one; later writes do not change them."""
    known = versions(spark, path)
    if not known or version not in (None, *known):
        raise FileNotFoundError(f"{path}, version {version}" if version is not None else path)
    return spark.read.parquet(known[max(known) if version is None else version])


def write_stage(df: DataFrame, path: str, after: int | None = None) -> int:
    """Write a new version and make it current; returns its number.

    ``after`` is the version that the rows were made from (by default the current one): if
    another was written since, this is an error and the new rows are deleted.
    """
    spark = df.sparkSession
    number = (max(versions(spark, path), default=-1) if after is None else after) + 1
    folder = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    try:
        _publish(spark, path, number, folder)
    except Exception:
        target, system, _ = _hadoop(spark, f"{path}/{folder}")
        system.delete(target, True)
        raise
    return number


def _publish(spark: SparkSession, path: str, number: int, folder: str) -> None:
    draft, system, context = _hadoop(spark, f"{path}/versions/draft-{uuid.uuid4().hex}")
    target, _, _ = _hadoop(spark, f"{path}/versions/{number:08d}")
    system.mkdirs(draft.getParent())
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(folder.encode()))
    finally:
        stream.close()
    none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    try:
        context.rename(draft, target, options)
    except Exception as error:
        system.delete(draft, False)
        raise FileExistsError(f"{path}: version {number} was written by another") from error


def rewrite_stage(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> int:
    """Make ``change(stage)`` the current version of a stage; returns its number."""
    current = max(versions(spark, path), default=None)
    if current is None:
        raise FileNotFoundError(path)
    return write_stage(change(read_stage(spark, path, current)), path, after=current)


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all but the newest ``keep`` versions, and what failed writers left behind.

    Call it when no job reads an older version or writes a new one.
    """
    known = versions(spark, path)
    kept = sorted(known)[-max(keep, 1) :]
    target, system, _ = _hadoop(spark, path)
    for number in set(known) - set(kept):  # first what names a version, then its rows
        system.delete(_hadoop(spark, f"{path}/versions/{number:08d}")[0], False)
    wanted = {known[n].rsplit("/", 1)[1] for n in kept}
    for status in system.listStatus(target):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in wanted:
            system.delete(status.getPath(), True)
    for status in system.listStatus(_hadoop(spark, f"{path}/versions")[0]):
        if status.getPath().getName().startswith("draft-"):
            system.delete(status.getPath(), False)
