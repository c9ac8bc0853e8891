"""Writers for JSONL output and fitted models; for stages see ``sources.stages``."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """One JSON object per line; null fields are left out. ``mode='append'`` adds rows."""
    df.write.mode(mode).option("compression", compression).json(path)


def write_by_kind(df: DataFrame, path: str, kind: str, mode: str = "overwrite") -> None:
    """One folder per kind."""
    df.write.mode(mode).partitionBy(kind).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_vocabulary(vocab: DataFrame, path: str) -> None:
    vocab.write.mode("overwrite").parquet(path)


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
