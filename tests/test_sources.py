"""Readers and writers on small files of our own."""

import glob
import json
import tempfile

import pytest
import zstandard
from pyspark.sql import functions as F

from threadloom import schemas, session
from threadloom.operators import features, language, pairs, profile
from threadloom.plans import corpus
from threadloom.sources import readers, stages, writers


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="threadloom-test-")


def write_zst(path, lines):
    data = "\n".join(lines).encode("utf-8")
    with open(path, "wb") as f:
        f.write(zstandard.ZstdCompressor().compress(data))


def comment(i, **over):
    row = {
        "id": f"c{i}", "parent_id": "t3_s1", "link_id": "t3_s1", "subreddit": "a", "author": "bob",
        "body": f"this is a fine comment number {i}", "score": 60, "extra": {"deep": [1, 2]},
    }
    return json.dumps({**row, **over})


def test_read_dump_zst(spark, folder):
    lines = [comment(1), "{broken", "", comment(2, score=None), comment(3, score="77"), comment(4, body="héllo " * 4)]
    write_zst(f"{folder}/RC.zst", lines)
    rows = readers.read_dump(spark, f"{folder}/RC.zst", schemas.RAW_COMMENTS)
    good = {r["id"]: r for r in readers.good_rows(rows).collect()}
    assert set(good) == {"c1", "c2", "c4"}
    assert good["c2"]["score"] is None and good["c4"]["body"].startswith("héllo")
    assert "extra" not in rows.columns
    rejected = {r[schemas.CORRUPT][:7]: r["id"] for r in readers.rejected_rows(rows).collect()}
    assert len(rejected) == 2 and rejected["{broken"] is None


def test_head_lines(spark, folder):
    write_zst(f"{folder}/RC.zst", [comment(i) for i in range(30)])
    got = [json.loads(r["value"])["id"] for r in readers.head_lines(spark, f"{folder}/RC.zst", 7).collect()]
    assert got == [f"c{i}" for i in range(7)]


def test_jsonl_roundtrip_and_append(spark, folder):
    df = spark.createDataFrame([("i", "a", "b", None), ("j", "c", "d", "s")], schemas.INSTRUCTION_ROWS)
    path = f"{folder}/out.jsonl"
    writers.write_jsonl(df, path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert sorted(map(sorted, lines)) == [["input", "instruction", "output"], ["input", "instruction", "output", "subreddit"]]
    writers.write_jsonl(df, path, mode="append")
    assert spark.read.text(path).count() == 4


def test_merge_skips_own_output(spark, folder):
    df = spark.createDataFrame([("i", "a", "b", None)], schemas.INSTRUCTION_ROWS)
    for name in ("CoT.jsonl", "PoT.jsonl", "final_training.jsonl"):
        writers.write_jsonl(df, f"{folder}/{name}")
    with open(f"{folder}/plain.jsonl", "w") as f:
        f.write('{"instruction": "x", "input": "y", "output": "z"}\n\n{bad\n')
    rows = readers.read_instruction_tables(spark, f"{folder}/*.jsonl", "final_training.jsonl")
    assert sorted(r["origin"] for r in rows.collect()) == ["CoT.jsonl", "PoT.jsonl", "plain.jsonl"]


def test_labelled_text_picks_first_column(spark, folder):
    with open(f"{folder}/a.jsonl", "w") as f:
        f.write('{"question": "q", "body": "b"}\n')
    with open(f"{folder}/b.jsonl", "w") as f:
        f.write('{"other": 1}\n')
    paths = {"math": [f"{folder}/a.jsonl", f"{folder}/missing.jsonl"], "code": [f"{folder}/b.jsonl"]}
    rows = readers.read_labelled_text(spark, paths, skip_missing=True).collect()
    assert [(r["text"], r["category"]) for r in rows] == [("q", "math")]
    with pytest.raises(FileNotFoundError):
        readers.read_labelled_text(spark, paths)


def test_labelled_text_looks_at_all_lines_of_each_table(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"input": \n{"other": 1}\n{"question": "qa", "body": "no"}\n{"input": "ia"}\n')
    (tmp_path / "b.jsonl").write_text('{"body": "bb"}\n{"question": "qb"}\n')
    (tmp_path / "c.jsonl").write_text('{"body": "bc"}\n')
    (tmp_path / "d.jsonl").write_text('{"other": "no"}\n')
    rows = readers.read_labelled_text(spark, {"code": [f"{tmp_path}/*.jsonl"]}).collect()
    assert sorted(r.text for r in rows if r.text) == ["bc", "ia", "qb"]
    assert len(rows) == 6 and {r.category for r in rows} == {"code"}


def test_labelled_text_takes_patterns(spark, folder):
    for name in "xy":
        with open(f"{folder}/{name}.jsonl", "w") as f:
            f.write(f'{{"input": "{name}", "n": 1}}\n{{broken\n')
    rows = readers.read_labelled_text(spark, {"code": [f"{folder}/*.jsonl"]}).collect()
    assert sorted((r["text"], r["category"]) for r in rows) == [("x", "code"), ("y", "code")]


def test_last_row_wins_over_files_of_any_size(spark, folder):
    """The later file by name wins, whichever is larger; within a file the later line."""
    for sizes in ((5, 4000), (4000, 5)):
        paths = []
        for month, n in zip(("2020-01", "2020-02"), sizes, strict=True):
            path = f"{folder}/RC_{month}_{n}.zst"
            rows = [comment(i % 3, body=f"{month} {i}", pad="x" * 50) for i in range(n)]
            write_zst(path, rows)
            paths.append(path)
        rows = readers.read_dump(spark, paths, schemas.RAW_COMMENTS, "position")
        last = pairs.latest_by_id(readers.good_rows(rows), "id", "position")
        want = {f"c{i % 3}": f"2020-02 {i}" for i in range(sizes[1])}
        assert {r["id"]: r["body"] for r in last.collect()} == want


def test_counts_of_a_dump(spark, folder):
    write_zst(f"{folder}/RC.zst", [comment(1), "{broken", "", "  ", comment(2), "17"])
    rows = readers.read_dump(spark, f"{folder}/RC.zst", schemas.RAW_COMMENTS)
    assert rows.count() == 4
    assert readers.good_rows(rows).count() == 2 and readers.rejected_rows(rows).count() == 2
    assert tuple(profile.dump_counts(rows).first()) == (4, 2, 2)
    assert profile.row_counts({"dump": rows}).first()["rows"] == 4


def test_only_the_output_itself_is_left_out(spark, folder):
    line = '{"instruction": "x", "input": "y", "output": "z"}\n'
    for name in ("a.jsonl", "final.jsonl", "final.jsonl.part2.jsonl"):
        with open(f"{folder}/{name}", "w") as f:
            f.write(line)
    rows = readers.read_instruction_tables(spark, f"{folder}/*.jsonl", "final.jsonl")
    counts = {r["origin"]: r["count"] for r in rows.groupBy("origin").count().collect()}
    assert counts == {"a.jsonl": 1, "final.jsonl.part2.jsonl": 1}


def test_header_scan(spark, folder):
    write_zst(f"{folder}/RC.zst", ['{"b": 1, "a": 2}', "{broken", '{"c": {"deep": 1}}', '{"late": 1}'])
    found = profile.scan_header(spark, f"{folder}/RC.zst", 3).collect()
    assert sorted(r["field"] for r in found) == ["a", "b", "c"]


def test_models_come_back(spark, folder, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(documents, "text", "lang", ["de", "en"])
    language.save(model, f"{folder}/language")
    again = language.load(spark, f"{folder}/language")
    predict = lambda m: sorted(map(tuple, m.predict(documents, "doc_id", F.col("text")).collect()))
    assert predict(model) == predict(again)
    vocab = features.vocabulary(documents.select(F.split("text", " ").alias("w")), "w", 50)
    writers.save_vocabulary(vocab, f"{folder}/vocab")
    assert sorted(map(tuple, writers.load_vocabulary(spark, f"{folder}/vocab").collect())) == sorted(map(tuple, vocab.collect()))


def test_stages_are_deleted(spark):
    other = session.new_stage(spark)
    spark.range(3).write.parquet(other)
    kept = session.materialise(spark.range(5))
    assert kept.count() == 5 and readers.path_exists(spark, other)
    assert other.startswith(session.stage_folder(spark))


def test_write_by_kind(spark, folder):
    df = spark.createDataFrame([(1, "CoT"), (2, "PoT"), (3, "CoT")], "id int, kind string")
    writers.write_by_kind(df, f"{folder}/math", "kind")
    assert spark.read.json(f"{folder}/math/kind=CoT").count() == 2


def test_rewrite_stage(spark, folder):
    path = f"{folder}/stage"
    assert stages.write_stage(spark.range(10), path) == 0
    first = stages.read_stage(spark, path)
    for _ in range(2):
        stages.rewrite_stage(spark, path, lambda df: df.where("id % 2 = 0 or id < 5"))
    assert stages.read_stage(spark, path).count() == 7 and first.count() == 10
    assert stages.read_stage(spark, path, 0).count() == 10
    stages.drop_versions(spark, path)
    assert list(stages.versions(spark, path)) == [2] and stages.read_stage(spark, path).count() == 7
    with pytest.raises(FileNotFoundError):
        stages.read_stage(spark, path, 0)
    with pytest.raises(FileNotFoundError):
        stages.rewrite_stage(spark, f"{folder}/none", lambda df: df)


@pytest.mark.parametrize("at", ["while the rows are written", "before the version is named", "after it is named"])
def test_a_crash_leaves_a_whole_stage(spark, folder, monkeypatch, at):
    path = f"{folder}/stage"
    stages.write_stage(spark.range(10), path)
    change = lambda df: df.where("id < 4")
    if at == "while the rows are written":
        change = lambda df: df.select(F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    else:
        publish = stages._publish

        def crash(*args):
            if at == "after it is named":
                publish(*args)
            raise KeyboardInterrupt  # nothing is cleaned up, as when the process dies

        monkeypatch.setattr(stages, "_publish", crash)
    with pytest.raises(BaseException):
        stages.rewrite_stage(spark, path, change)
    monkeypatch.undo()
    assert stages.read_stage(spark, path).count() == (4 if at == "after it is named" else 10)
    stages.rewrite_stage(spark, path, lambda df: df.where("id < 3"))
    stages.drop_versions(spark, path)
    assert stages.read_stage(spark, path).count() == 3
    assert len(glob.glob(f"{path}/version-*")) == 1 and len(glob.glob(f"{path}/versions/*")) == 1


def test_two_writers_from_one_version(spark, folder):
    path = f"{folder}/stage"
    stages.write_stage(spark.range(10), path)

    def change(df):
        stages.rewrite_stage(spark, path, lambda other: other.where("id < 6"))
        return df.where("id < 2")

    with pytest.raises(FileExistsError):
        stages.rewrite_stage(spark, path, change)
    assert stages.read_stage(spark, path).count() == 6 and len(glob.glob(f"{path}/version-*")) == 2


def test_build_stages(spark, folder, sf):
    model = language.fit(spark.read.parquet(f"{sf}/documents.parquet"), "text", "lang", ["de", "en"])
    replies = [comment(1), comment(2, parent_id="t1_c1"), comment(3, score=3), comment(4, author="x_Bot")]
    post = {"id": "s1", "subreddit": "", "title": "A title that is long enough to pass on its own", "selftext": "", "score": 99, "author": "z"}
    write_zst(f"{folder}/RC.zst", replies)
    write_zst(f"{folder}/RS.zst", [json.dumps(post)])
    found = corpus.build_stages(spark, f"{folder}/RC.zst", f"{folder}/RS.zst", folder, model)
    got = {r["id"]: r for r in found.collect()}
    assert set(got) == {"c1", "c2"}
    assert got["c1"]["pair_type"] == "submission" and got["c1"]["input"] == post["title"]
    assert got["c1"]["instruction"] == "You are a user in r/a, Reply to the given comment."
    assert got["c2"]["instruction"].endswith(f"in context: {post['title']}.")


def test_parse_lines(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": ',), ('{"k": "1"}',), ("{}",)], "line string")
    schema = schemas.T.StructType([schemas.T.StructField("k", schemas.T.LongType())])
    rows = readers.parse_lines(df, "line", schema).select("is_valid", F.col("parsed.k").alias("k")).collect()
    assert [r["is_valid"] for r in rows] == [True, False, False, True] and rows[0]["k"] == 1
