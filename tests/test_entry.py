"""The entry point with and without the optional parts, and stages that follow their tables."""

import pathlib
import shutil
import subprocess
import sys

from threadloom.catalog import views as V
from threadloom.catalog.queries import QUERIES

ROOT = pathlib.Path(__file__).resolve().parents[1]


def copied(tmp_path, *without):
    target = tmp_path / "repo"
    ignore = shutil.ignore_patterns(".git", "__pycache__", *without)
    shutil.copytree(ROOT, target, ignore=ignore)
    return target


def names(folder):
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


def test_the_rest_stands_alone(tmp_path):
    folder = copied(tmp_path, "llm", "corpus_pipeline.py")
    done = names(folder)
    assert done.returncode == 0, done.stderr
    assert set(done.stdout.split("\n")[0].split()) == set(QUERIES)
    (folder / "threadloom" / "llm" / "__pycache__").mkdir(parents=True)  # a folder without code
    assert names(folder).stdout == done.stdout


def test_an_error_in_an_optional_part_is_not_hidden(tmp_path):
    folder = copied(tmp_path)
    if not (folder / "corpus_pipeline.py").exists():
        return
    with open(folder / "corpus_pipeline.py", "a") as file:
        file.write("\nimport a_module_that_is_not_there\n")
    done = names(folder)
    assert done.returncode != 0 and "a_module_that_is_not_there" in done.stderr


def test_stages_are_made_anew_when_their_tables_change(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    before = QUERIES["min_score"](spark, str(tmp_path)).count()
    first = V.version_of(spark, str(tmp_path))
    docs.limit(20).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    after = QUERIES["min_score"](spark, str(tmp_path)).count()
    assert V.version_of(spark, str(tmp_path)) != first and 0 < after < before / 2
