"""Plan shape: what must reach the scan, and what must never appear."""

import pytest

from threadloom.catalog import views as V
from threadloom.catalog.queries import QUERIES
from threadloom.operators import admit, context, pairs, ranks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


OWN = sorted(set(QUERIES) - {"train_router", "score_router"})


@pytest.mark.parametrize("name", OWN)
def test_no_cross_or_nested_loop_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


@pytest.mark.parametrize(
    "name,pushed,columns",
    [
        ("min_score", "GreaterThanOrEqual(score,50)", "id:string,score:bigint"),
        ("drop_bots", "", "id:string,author:string"),
        ("drop_gif", "Contains(body,![gif])", "id:string,body:string"),
        ("drop_links_loose", "Contains(body,http)", "id:string,body:string"),
        ("drop_tombstones", "body", "id:string,body:string"),
    ],
)
def test_predicates_reach_the_scan(spark, sf, name, pushed, columns):
    text = plan(QUERIES[name](spark, sf))
    scan = text[text.index("PushedFilters") :]
    assert pushed in scan.split("ReadSchema")[0] and f"ReadSchema: struct<{columns}>" in scan


def test_no_size_switches_in_the_sources():
    import pathlib

    for path in pathlib.Path(__file__).parents[1].glob("threadloom/[!l]*/*.py"):
        text = path.read_text()
        assert "inputFiles" not in text and ".rdd" not in text and "repartition(2" not in text, path


def test_filters_and_columns_reach_the_scan(spark, sf):
    path = f"{sf}/orders.parquet"
    text = plan(spark.read.parquet(path).where("o_orderkey > 5").select("o_custkey"))
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,5)]" in text
    scan = plan(V.table(spark, sf, "events").groupBy("event_type").count())
    assert "ReadSchema: struct<event_type:string>" in scan


def test_admission_is_pushed_into_the_stage_scan(spark, sf, tmp_path):
    V.comments(spark, sf).write.parquet(str(tmp_path / "raw"))
    kept = admit.comment_candidates(spark.read.parquet(str(tmp_path / "raw"))).select("id")
    text = plan(kept)
    assert "Exchange" not in text and "PushedFilters: [" in text and "parent_id" not in text.split("ReadSchema")[1]


def test_rank_filters_run_before_the_shuffle(spark, sf):
    events = V.table(spark, sf, "events").select("user_id", "event_id")
    assert plan(pairs.latest_by_id(events, "user_id", "event_id")).count("WindowGroupLimit") == 2
    chat = V.table(spark, sf, "conversations")
    assert "WindowGroupLimit" in plan(context.last_messages(chat))


def test_document_frequencies_and_ranks_do_not_meet_in_one_task(spark, sf):
    """What a single partition takes in is a table of cell sizes, never rows."""
    events = V.table(spark, sf, "events").select("event_id", "user_id")
    text = plan(ranks.position_rank(events, "event_id", 1000))
    for line in text.split("\n"):
        if "SinglePartition" in line:
            below = text[text.index(line) + len(line) :].split("\n")[1]
            assert "HashAggregate" in below, below
    chat = V.table(spark, sf, "conversations")
    text = plan(context.budget_history(chat, 100, context.F.length("text")))
    assert "SinglePartition" not in text


def test_exact_sample_does_not_collect_in_one_task(spark, sf):
    orders = V.table(spark, sf, "orders").select("o_orderkey")
    text = plan(ranks.hash_rank(orders, "o_orderkey", "s", at_most=500))
    assert "TakeOrderedAndProject" not in text and "GlobalLimit" not in text
    assert "hashpartitioning(_cell" in text
    assert text.count("SinglePartition") <= 1  # the bucket sizes
