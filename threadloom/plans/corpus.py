"""From raw dumps to training text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom import schemas
from threadloom.operators import admit, clean, instruct, pairs, sampling
from threadloom.operators.language import LanguageModel
from threadloom.session import materialise
from threadloom.sources import readers


def clean_comments(comments: DataFrame, model: LanguageModel, position: str) -> DataFrame:
    """Admit, clean and polish; of the rows of one id the last by ``position`` wins."""
    cleaned = clean.clean_comments(admit.admit_comments(comments, model), (position,))
    return pairs.latest_by_id(clean.polish_comments(cleaned), "id", position).drop(position)


def clean_submissions(submissions: DataFrame, model: LanguageModel, position: str) -> DataFrame:
    cleaned = clean.clean_submissions(admit.admit_submissions(submissions, model), (position,))
    return pairs.latest_by_id(cleaned, "id", position).drop(position)


def cleaned_forum(
    comments: DataFrame, submissions: DataFrame, model: LanguageModel, position: str
) -> tuple[DataFrame, DataFrame]:
    """Both tables cleaned and written once, as pairing reads the comments three times."""
    replies = materialise(clean_comments(comments, model, position))
    return replies, materialise(clean_submissions(submissions, model, position))


def forum_pairs(
    comments: DataFrame, submissions: DataFrame, model: LanguageModel, position: str
) -> DataFrame:
    """Reply pairs of raw rows."""
    return pairs.reply_pairs(*cleaned_forum(comments, submissions, model, position))


def capped_sources(
    maths: DataFrame, code: DataFrame, word_problems: DataFrame, position: str
) -> dict[str, DataFrame]:
    """The first rows of each public source, by position, up to the cap of the source."""
    caps = {"maths": (maths, K.MATH_CAP), "code": (code, K.CODE_CAP), "word_problems": (word_problems, K.WORD_PROBLEM_CAP)}
    return {name: sampling.first_rows(df, position, cap).drop("rank") for name, (df, cap) in caps.items()}


def training_text(
    forum: DataFrame, others: dict[str, DataFrame], n: int = K.FORUM_SAMPLE, seed: str = sampling.SEED
) -> DataFrame:
    """Sample the forum pairs, merge all sources, shuffle and render.

    Every table needs a unique ``id``. ``rank`` gives the shuffled order. ``forum`` should be
    a written stage, because a sample reads its input twice.
    """
    sampled = materialise(sampling.sample_exact(forum, "id", n, seed).drop("rank"))
    parts = {
        name: df.withColumn("id", F.col("id").cast("string"))
        for name, df in {"forum": sampled, **others}.items()
    }
    merged = sampling.merge_sources(parts)
    keyed = merged.withColumn("row_key", F.concat_ws("|", "origin", "id"))
    return instruct.render_chatml(sampling.seeded_shuffle(keyed, "row_key", seed))


def build_stages(
    spark: SparkSession, comment_paths, submission_paths, folder: str, model: LanguageModel
) -> DataFrame:
    """Dumps to reply pairs, with Parquet stages ``comments``, ``submissions`` and ``pairs``.

    Compressed dumps give one task per file; the admitted rows are dealt out evenly before
    the cleaning expressions run and before the stage is written.
    """
    dumps = {
        "comments": (comment_paths, schemas.RAW_COMMENTS, admit.comment_candidates, clean_comments),
        "submissions": (
            submission_paths,
            schemas.RAW_SUBMISSIONS,
            admit.submission_candidates,
            clean_submissions,
        ),
    }
    for name, (paths, schema, candidates, cleaned) in dumps.items():
        rows = readers.good_rows(readers.read_dump(spark, paths, schema, "position"))
        kept = candidates(rows).hint("rebalance")
        cleaned(kept, model, "position").write.mode("overwrite").parquet(f"{folder}/{name}")
    replies, posts = (spark.read.parquet(f"{folder}/{name}") for name in dumps)
    pairs.reply_pairs(replies, posts).write.mode("overwrite").parquet(f"{folder}/pairs")
    return spark.read.parquet(f"{folder}/pairs")
