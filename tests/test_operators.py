"""Invariants, brute-force comparisons and skew for the DataFrame operators."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom import schemas
from threadloom.functions import predicates as P
from threadloom.functions import prompts
from threadloom.functions import text as X
from threadloom.operators import (
    admit,
    clean,
    context,
    features,
    instruct,
    language,
    pairs,
    profile,
    ranks,
    router,
    sampling,
    synth,
)
from threadloom.plans import corpus


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


# --- admission ----------------------------------------------------------------
GOOD = {"id": "1", "parent_id": "t3_a", "link_id": "t3_a", "subreddit": "s", "author": "bob", "body": "x" * 20, "score": 50}


@pytest.mark.parametrize(
    "change,reason",
    [
        ({}, None), ({"body": "[removed]"}, "tombstone"), ({"body": None}, "tombstone"),
        ({"score": 49}, "score"), ({"score": None}, "score"), ({"author": "SaveVideo"}, "bot"),
        ({"author": "HelperBOT"}, "bot"), ({"author": None}, "bot"), ({"author": "Bottle"}, None),
        ({"body": "x" * 14}, "length"), ({"body": "x" * 15}, None), ({"body": "x" * 1000}, None),
        ({"body": "x" * 1001}, "length"), ({"body": "see http somewhere"}, "link"),
        ({"body": "see www.somewhere"}, "link"), ({"body": "a nice ![gif](abc) here"}, "gif"),
        ({"body": "[removed]", "score": 1}, "tombstone"),
    ],
)
def test_comment_reasons(spark, change, reason):
    df = spark.createDataFrame([{**GOOD, **change}], schemas.RAW_COMMENTS)
    assert admit.with_comment_reason(df).first()["reason"] == reason
    assert admit.comment_candidates(df).count() == (reason is None)


POST = {"id": "1", "subreddit": "s", "author": "bob", "title": "t" * 40, "selftext": "", "score": 50}


@pytest.mark.parametrize(
    "change,reason",
    [
        ({}, None), ({"title": " [deleted] "}, "tombstone"), ({"title": None}, "tombstone"),
        ({"author": "xbot"}, "bot"), ({"score": 0}, "score"), ({"title": "t" * 9}, "title_length"),
        ({"title": "T" * 40}, "all_caps"), ({"title": "1" * 40}, None), ({"selftext": "x" * 19}, "body_length"),
        ({"selftext": "x" * 1001}, "body_length"), ({"title": "t" * 39}, "title_only_length"),
        ({"title": "t" * 39, "selftext": "x" * 20}, None), ({"selftext": None}, None),
        ({"selftext": "see https://a.b in there"}, "link"), ({"selftext": "an http word in the text"}, None),
        ({"selftext": "some text with ![gif](a)"}, "gif"), ({"selftext": "   "}, None),
    ],
)
def test_submission_reasons(spark, change, reason):
    df = spark.createDataFrame([{**POST, **change}], schemas.RAW_SUBMISSIONS)
    assert admit.with_submission_reason(df).first()["reason"] == reason
    assert admit.submission_candidates(df).count() == (reason is None)


def test_clean_submission_defaults(spark):
    df = spark.createDataFrame([{**POST, "title": "a fine title", "subreddit": "", "selftext": None}], schemas.RAW_SUBMISSIONS)
    row = clean.clean_submissions(df).first()
    assert row["subreddit"] == "AskReddit" and row["selftext"] is None


def test_language_model(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(documents, "text", "lang", ["de", "en", "es", "fr"])
    found = model.predict(documents, "doc_id", F.col("text"))
    truth = dict(rows_of(documents, "doc_id", "lang"))
    hits = [truth[i] == lang for i, lang in rows_of(found, "doc_id", "lang")]
    assert sum(hits) / len(hits) > 0.95


def test_keep_english(spark, sf):
    model = language.fit(spark.read.parquet(f"{sf}/documents.parquet"), "text", "lang", ["de", "en"])
    df = spark.createDataFrame(
        [("1", "plain ascii text"), ("2", "the thing and the other thing with the naïve one"), ("3", "der König und die Straße nicht für"), ("4", "é")],
        "id string, body string",
    )
    assert rows_of(admit.keep_english(df, F.col("body"), model), "id") == [("1",), ("2",)]
    assert rows_of(admit.keep_ascii(df, F.col("body")), "id") == [("1",)]
    same = df.where("id in ('2', '3')").withColumn("id", F.lit("x"))
    assert rows_of(admit.keep_english(same, F.col("body"), model), "body") == rows_of(df.where("id = '2'"), "body")


# --- pairs --------------------------------------------------------------------
def brute_pairs(comments, submissions):
    """Every comment against every possible parent and every possible thread."""
    out = []
    for c in comments:
        head = f"You are a user in r/{c['subreddit']}, Reply to the given comment"
        threads = [s for s in submissions if c["link_id"] == f"t3_{s['id']}"]
        for p in comments:
            if c["parent_id"] == f"t1_{p['id']}":
                tail = f" in context: {threads[0]['title']}." if threads else "."
                out.append((c["id"], head + tail, p["body"], c["body"]))
        for s in submissions:
            if c["parent_id"] == f"t3_{s['id']}":
                tail = f" in context: {s['title']}." if s["selftext"] else "."
                out.append((c["id"], head + tail, s["selftext"] or s["title"], c["body"]))
    return sorted(out)


def test_pairs_with_a_hot_parent(spark):
    rng = random.Random(1)
    submissions = [{"id": f"s{i}", "title": f"title {i}", "selftext": rng.choice([None, "", f"self {i}"])} for i in range(20)]
    comments = []
    for i in range(600):
        kind = rng.choice(["hot", "t1", "t3", "gone", "none"])
        parent = {"hot": "t3_s0", "t1": f"t1_c{rng.randrange(600)}", "t3": f"t3_s{rng.randrange(20)}", "gone": "t1_zzz", "none": None}[kind]
        comments.append(
            {"id": f"c{i}", "parent_id": parent, "link_id": rng.choice([None, "t3_s0", f"t3_s{rng.randrange(30)}"]),
             "subreddit": rng.choice([None, "a"]), "body": f"body {i}"}
        )
    c = spark.createDataFrame(comments, "id string, parent_id string, link_id string, subreddit string, body string")
    s = spark.createDataFrame(submissions, "id string, title string, selftext string")
    got = rows_of(pairs.reply_pairs(c, s), "id", "instruction", "input", "output")
    assert got == brute_pairs(comments, submissions)
    counts = dict(rows_of(pairs.pair_counts(pairs.reply_pairs(c, s))))
    assert counts["all"] == len(got) == counts["comment"] + counts["submission"]


@pytest.fixture
def skewed(spark):
    """Settings under which a small hot key counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_replies(spark, n, parent, link):
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("c"), "id").alias("id"), parent.alias("parent_id"), link.alias("link_id"),
        F.lit("f").alias("subreddit"), F.sha2(F.col("id").cast("string"), 512).alias("body"),
    )


def posts(spark):
    return spark.range(997).select(F.concat(F.lit("s"), "id").alias("id"), F.lit("t").alias("title"), F.lit("x").alias("selftext"))


def test_hot_parent_is_split_by_the_skew_join(spark, skewed):
    """A third of all replies answer one submission; the join splits them over tasks."""
    n = 30000
    parent = F.when(F.col("id") % 3 == 0, F.lit("t3_s0")).otherwise(F.concat(F.lit("t3_s"), F.col("id") % 997))
    found = pairs.submission_pairs(hot_replies(spark, n, parent, parent), posts(spark))
    assert len(found.collect()) == n
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_hot_thread_is_split_by_the_title_join(spark, skewed):
    """A third of all replies lie in one thread, a third name no thread."""
    n = 30000
    parent = F.concat(F.lit("t1_c"), (F.col("id") * 7) % n)
    link = F.when(F.col("id") % 3 == 0, F.lit("t3_s0")).when(F.col("id") % 3 == 1, F.concat(F.lit("t3_s"), F.col("id") % 997))
    found = pairs.comment_pairs(hot_replies(spark, n, parent, link), posts(spark))
    rows = found.collect()
    assert len(rows) == n and sum(" in context: t." in r["instruction"] for r in rows) == 20000
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_duplicate_ids_keep_the_last_row(spark):
    rows = [{**GOOD, "body": f"the body of version {v}", "pos": v} for v in (1, 3, 2)]
    df = spark.createDataFrame(rows, schemas.T.StructType([*schemas.RAW_COMMENTS, schemas.T.StructField("pos", schemas.T.LongType())]))
    model = language.fit(spark.createDataFrame([("the", "en"), ("der", "de")], "t string, l string"), "t", "l", ["de", "en"])
    assert rows_of(corpus.clean_comments(df, model, "pos"), "body") == [("the body of version 3",)]


def test_latest_by_id(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y"), (None, 9, "n")], "id string, pos int, v string")
    assert rows_of(pairs.latest_by_id(df, "id", "pos"), "id", "v") == [("a", "z"), ("b", "y")]


# --- ranks and sampling -------------------------------------------------------
def numbered(spark, n, hot=0.4):
    """Rows 0..n-1; one group holds ``hot`` of them, one group is null."""
    group = F.when(F.col("id") < n * hot, F.lit("hot")).when(F.col("id") % 7 > 0, F.concat(F.lit("g"), F.col("id") % 7))
    return spark.range(n).withColumn("g", group)


def test_hash_rank_is_a_permutation(spark):
    df = numbered(spark, 3000)
    ranked = ranks.hash_rank(df, "id", "s")
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 3001))
    for digits in (1, 2):
        assert rows_of(ranks.hash_rank(df, "id", "s", digits=digits), "id", "rank") == rows_of(ranked, "id", "rank")


def test_hash_rank_keeps_null_groups(spark):
    df = numbered(spark, 2000)
    ranked = ranks.hash_rank(df, "id", "s", by=("g",))
    sizes = Counter(r["g"] for r in df.collect())
    got = Counter(r["g"] for r in ranked.collect())
    assert got == sizes and None in sizes
    best = {r["g"]: r["m"] for r in ranked.groupBy("g").agg(F.max("rank").alias("m")).collect()}
    assert best == dict(sizes)


def test_exact_samples(spark):
    df = numbered(spark, 3000)
    for n in (0, 1, 700, 3000, 9000):
        got = [r["id"] for r in sampling.sample_exact(df, "id", n).collect()]
        assert len(got) == len(set(got)) == min(n, 3000)
    smaller = set(rows_of(sampling.sample_exact(df, "id", 100), "id"))
    assert smaller <= set(rows_of(sampling.sample_exact(df, "id", 700), "id"))


def test_caps(spark):
    df = numbered(spark, 3000)
    capped = Counter(r["g"] for r in sampling.cap_per_source(df, "g", "id", 150).collect())
    sizes = Counter(r["g"] for r in df.collect())
    assert capped == {g: min(150, n) for g, n in sizes.items()}
    odd = df.where("id % 2 = 1")
    got = ranks.position_rank(odd, "id", 500, cells=64)
    assert rows_of(got, "id", "rank") == [(2 * i + 1, i + 1) for i in range(500)]
    sparse = odd.withColumn("id", F.col("id") * 86_400_000 + 1_600_000_000_000)
    got = ranks.position_rank(sparse, "id", 500, cells=16)
    assert rows_of(got, "id", "rank") == [((2 * i + 1) * 86_400_000 + 1_600_000_000_000, i + 1) for i in range(500)]


def test_cells_are_even_for_sparse_positions(spark):
    """Timestamps with large gaps, most of them in one hot group."""
    rows = spark.range(20_000).select((F.pow("id", F.lit(3)) * 1000).cast("long").alias("at"), (F.col("id") % 3).alias("g"))
    sizes = [r["count"] for r in ranks.even_cells(rows, "at", 16, "cell").groupBy("cell").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16


def test_balance_classes(spark):
    df = numbered(spark, 1000)
    got = sampling.balance_classes(df, "g", "id", 300).collect()
    sizes = Counter(r["g"] for r in df.collect() if r["g"] is not None)
    assert Counter(r["g"] for r in got) == {g: 300 for g in sizes}
    for g, n in sizes.items():
        ids = [r["id"] for r in got if r["g"] == g]
        assert sorted(r["draw"] for r in got if r["g"] == g) == list(range(300))
        assert (len(set(ids)) == 300) if n >= 300 else (len(set(ids)) <= n)
    big = sampling.balance_classes(df, "g", "id", 5000)
    assert dict(rows_of(sampling.class_distribution(big, "g"))) == {g: 5000 for g in sizes}


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(5000)
    parts = Counter(r["part"] for r in sampling.train_test_split(df, "id", 20).collect())
    assert sum(parts.values()) == 5000 and 850 < parts["test"] < 1150


def test_mixture(spark):
    df = numbered(spark, 3000)
    got = sampling.mixture_sample(df, "g", "id", {"hot": 600, "g1": 50, "none": 9})
    assert Counter(r["g"] for r in got.collect()) == {"hot": 600, "g1": 50}
    assert sampling.percent_quotas(1_000_000) == {"forum": 600_000, "code": 200_000, "PoT": 100_000, "CoT": 100_000}


@pytest.mark.parametrize("total", [0, 1, 7, 99, 1000, 12_345])
def test_quotas_add_up(total):
    shares = {"a": 60, "b": 20, "c": 10, "d": 10, "none": 0}
    got = sampling.apportion(total, shares)
    assert sum(got.values()) == total and got["none"] == 0
    assert all(abs(got[n] - total * s / 100) < 1 for n, s in shares.items())
    rng = random.Random(total)
    for _ in range(50):
        rows = {n: rng.choice([0, 3, 50, 900, 20_000]) for n in shares if rng.random() < 0.9}
        quotas = sampling.filled_quotas(total, shares, rows)
        assert sum(quotas.values()) == min(total, sum(n for s, n in rows.items() if shares[s]))
        assert all(q <= rows.get(n, 0) for n, q in quotas.items())
        open_ = [n for n, q in quotas.items() if q < rows.get(n, 0) and shares[n]]
        levels = [quotas[n] / shares[n] for n in open_]  # sources with rows left are filled to one level
        assert not levels or max(levels) - min(levels) <= 2 / 10
        assert all(quotas[n] / s <= max(levels, default=float("inf")) + 0.2 for n, s in shares.items() if s)
    assert sampling.apportion(5, {}) == {}


def test_exact_mixture_fills_up_short_sources(spark):
    df = numbered(spark, 3000)
    have = Counter(r["g"] for r in df.collect())
    got = Counter(r["g"] for r in sampling.exact_mixture(df, "g", "id", 1000, {"hot": 1, "g1": 8, "none": 3}).collect())
    assert sum(got.values()) == 1000 and got["g1"] == have["g1"] and set(got) == {"hot", "g1"}


@pytest.mark.parametrize("name", ["shuffle", "sample", "cap", "first", "balance", "split", "arith", "words", "drop"])
def test_independent_of_partitioning(spark, shuffle_partitions, name):
    def run(df):
        text = df.withColumn("t", F.concat_ws(" ", F.lit("a b c d"), "g"))
        return {
            "shuffle": lambda: sampling.seeded_shuffle(df, "id"),
            "sample": lambda: sampling.sample_exact(df, "id", 200),
            "cap": lambda: sampling.cap_per_source(df, "g", "id", 50),
            "first": lambda: sampling.first_rows(df, "id", 100),
            "balance": lambda: sampling.balance_classes(df, "g", "id", 120),
            "split": lambda: sampling.train_test_split(df, "id", 10),
            "arith": lambda: synth.arithmetic(df, "id"),
            "words": lambda: synth.keyword_sentences(df.select("g").distinct(), "g"),
            "drop": lambda: synth.word_dropout(text.select("id", "t"), "id", "t"),
        }[name]()

    results = []
    for n in (2, 16):
        shuffle_partitions(n)
        out = run(numbered(spark, 600).where("g is not null").repartition(n))
        results.append(sorted(map(str, out.collect())))
    assert results[0] == results[1]


def test_running_totals(spark):
    rng = random.Random(2)
    data = [(rng.choice([1, 1, 1, 2, None]), i, rng.randrange(50)) for i in range(500)]
    df = spark.createDataFrame(data, "k int, pos int, v int")
    got = ranks.running_totals(df, ("k",), "pos", {"total": F.col("v")}, cells=16)
    seen, want = Counter(), []
    for k, pos, v in data:
        seen[k] += v
        want.append((pos, seen[k]))
    assert rows_of(got, "pos", "total") == want


# --- conversations ------------------------------------------------------------
def chat(spark, turns=400):
    """One long conversation with gaps in its turns, some short ones."""
    rng = random.Random(3)
    data = []
    for conv, n in ((0, turns), (1, 3), (2, 40), (3, 1)):
        turn = 0
        for i in range(n):
            turn += rng.choice([1, 1, 2, 90])
            role = "system" if i == 0 and conv else ("user" if i % 2 == 0 else "assistant")
            data.append((conv, turn, role, "w" * rng.choice([1, 5, 90, 700, 1500])))
    return data, spark.createDataFrame(data, schemas.MESSAGES)


def longest_suffixes(data, system_cost):
    """For each user message the longest run of earlier lines that fits its budget."""
    out = []
    for conv, turn, role, text in data:
        if role == "user":
            earlier = [f"{r.title()}: {t}\n" for c, n, r, t in data if c == conv and n < turn and r != "system"]
            room = 2048 - 512 - system_cost - len(text)
            fitting = [k for k in range(len(earlier) + 1) if len("".join(earlier[k:])) <= max(room, 0)]
            out.append((conv, turn, "".join(earlier[min(fitting) :])))
    return sorted(out)


@pytest.mark.parametrize("system_cost", [0, 200, 1500, 3000])
def test_history_equals_greedy(spark, system_cost):
    data, df = chat(spark)
    got = context.history_context(context.dialogue(df), system_cost)
    assert rows_of(got, "conv_id", "turn", "ctx") == longest_suffixes(data, system_cost)


def test_last_n_history(spark):
    data, df = chat(spark)
    want, history = [], {}
    for conv, turn, role, text in data:
        if role == "system":
            continue
        lines = history.setdefault(conv, [])
        if role == "user":
            want.append((conv, turn, "\n".join(lines[-10:])))
        lines.append(f"{role.title()}: {text}")
    got = context.last_n_history(context.dialogue(df))
    assert rows_of(got, "conv_id", "turn", "ctx") == sorted(want)


def test_histories_keep_a_null_conversation(spark):
    data = [(None, t, "user", "hi") for t in (1, 50, 7000)] + [(2, 1, "user", "a")]
    df = spark.createDataFrame(data, schemas.MESSAGES)
    assert context.budget_history(df, 100, F.length("text")).count() == 4
    ctx = {(r["conv_id"], r["turn"]): r["ctx"] for r in context.last_n_history(df).collect()}
    assert ctx[(None, 7000)] == "User: hi\nUser: hi" and ctx[(2, 1)] == ""


def test_budget_history(spark):
    data, df = chat(spark)
    got = context.budget_history(context.dialogue(df), 2000, F.length("text"))
    want, by_conv = [], {}
    for conv, turn, role, text in data:
        if role != "system":
            by_conv.setdefault(conv, []).append((turn, len(text)))
    for conv, messages in by_conv.items():
        cost = 0
        for turn, n in reversed(messages):
            cost += n
            if cost > 2000:
                break
            want.append((conv, turn))
    assert rows_of(got, "conv_id", "turn") == sorted(want)


def test_history_bins_spread_a_long_conversation(spark):
    """The join key holds the bin, so one conversation does not meet itself in one task."""
    _, df = chat(spark)
    plan = context.history_context(context.dialogue(df), 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "_bin" in plan


def test_request_profiles(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "2+2")], schemas.MESSAGES)
    label = F.when(F.col("turn") == 2, "math ").otherwise("General")
    out = {}
    for p in K.TEMPERATURES:
        rows = context.request_rows(df, label, F.lit("x"), 10, p).collect()
        out[p] = {r["turn"]: (r["temperature"], r["messages"][0]["content"], r["messages"][1]["content"]) for r in rows}
    assert out["v1"][2] == (0.1, K.PYTHON_BARE_TEXT, "2+2")
    assert out["v2"][2] == (0.2, K.PLAIN_TEXT, "2+2")
    assert out["reasoning"][2] == (0.4, K.PLAIN_TEXT + "\n\nCONTEXT:\nUser: hi\nAssistant: yo\n", "2+2")
    forum = context.request_rows(df, F.lit("General"), F.lit("x"), 10, "reasoning").where("turn = 2").first()
    assert forum["messages"][0]["content"] == (
        "You are a user in r/x.Reply to given comment.\n\nCONTEXT:\nUser: hi\nAssistant: yo\n"
    )
    assert out["v2"][0] == (0.8, "You are a user in r/x.Reply to given comment.", "hi")


def test_math_prompt_all_flags(spark):
    names = ("latex", "mcq", "code", "explain", "comments", "asymptote")
    flags = spark.range(64).select("id", *[(F.shiftright("id", i) % 2 == 1).alias(n) for i, n in enumerate(names)])
    for r in flags.withColumn("p", prompts.math_prompt(*names)).collect():
        rules = [
            (r["mcq"], K.MCQ_TEXT),
            (r["asymptote"], K.ASYMPTOTE_TEXT),
            (r["explain"] and not r["code"] and r["latex"], K.LATEX_TEXT),
            (r["explain"] and not r["code"] and not r["latex"], K.PLAIN_TEXT),
            (r["code"] and not (r["latex"] or r["explain"] or r["comments"]), K.PYTHON_BARE_TEXT),
            (r["code"] and r["comments"] and not (r["latex"] or r["explain"]), K.PYTHON_COMMENTED_TEXT),
            (r["latex"] and not r["code"] and not r["explain"], K.DETAILED_PLAIN_TEXT),
        ]
        assert r["p"] == next((t for ok, t in rules if ok), K.DEFAULT_MATH_TEXT)


def test_forum_template_is_a_parameter(spark):
    mine = prompts.ForumTemplate("P {forum}.", " T", " C {context}")
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", ""), ("", None)], "f string, c string")
    got = [r["p"] for r in df.select(prompts.forum_prompt("f", "c", mine).alias("p")).collect()]
    assert got == ["P a. C b", "P AskReddit. C b", "P a. T", "P AskReddit. T"]


# --- instruction rows ---------------------------------------------------------
def test_math_rows(spark):
    data = [("q1", "a", " DATA/CoT/gsm_train.json "), ("q2", "b", "data/pot/MATHQA.json"), ("q3", "c", "other"), ("q4", "d", None)]
    df = spark.createDataFrame(data, schemas.SOURCED_ROWS)
    assert rows_of(instruct.math_rows(df), "kind", "input", "output") == [
        ("CoT", "q1", "a"),
        ("PoT", "q2", "<TOOL_CALL>\nb\n</TOOL_CALL>"),
    ]
    assert dict(rows_of(instruct.source_counts(df))) == {"CoT": 1, "PoT": 1, "excluded": 2}


def test_training_text(spark):
    forum = spark.createDataFrame([(f"c{i}", "i", f"in{i}", "o", "s") for i in range(50)], "id string, instruction string, input string, output string, subreddit string")
    code = spark.createDataFrame([(i, "i", "in", "o") for i in range(5)], "id long, instruction string, input string, output string")
    out = corpus.training_text(forum, {"code": code}, 20)
    rows = out.collect()
    assert len(rows) == 25 and sorted(r["rank"] for r in rows) == list(range(1, 26))
    assert rows[0]["text"].startswith("<|im_start|>system\ni<|im_end|>\n<|im_start|>user\nin")
    assert rows[0]["text"].endswith("<|im_end|>\n<|im_start|>assistant\no<|im_end|>")


# --- profiles and features ----------------------------------------------------
def test_discover_fields(spark):
    df = spark.createDataFrame([(1, '{"b": 1, "a": 2}'), (2, '{"c": 1, "a": null}'), (3, "oops")], "pos int, j string")
    got = profile.discover_fields(df, "j", "pos").orderBy("first_line", "first_place").collect()
    assert [(r["field"], r["rows"]) for r in got] == [("b", 1), ("a", 2), ("c", 1)]


def test_sequences(spark):
    texts = ["b a a", "c " * 60, "the", "zz a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = df.withColumn("words", features.word_column("text"))
    vocab = features.vocabulary(rows, "words", 5)
    assert rows_of(vocab, "idx", "term") == [(0, "<PAD>"), (1, "<UNK>"), (2, "c"), (3, "b"), (4, "zz")]
    ids = {r["id"]: r["ids"] for r in features.encode_sequences(rows, "id", "words", vocab).collect()}
    assert ids[0] == [3] + [0] * 49 and ids[1] == [2] * 50 and ids[2] == [0] * 50 and ids[3] == [4] + [0] * 49


def test_tfidf_rows_have_unit_length(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = router.prepare(documents, "text")
    weights = features.fit_tfidf(rows, "term_words", "terms", 500).weights(rows, "doc_id")
    norms = weights.groupBy("doc_id").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect()
    assert norms and all(abs(r["n"] - 1) < 1e-9 for r in norms)


@pytest.mark.parametrize("network", [False, True])
def test_router_learns_and_persists(spark, network):
    import tempfile

    from threadloom.sources import writers

    kinds = {"math": "solve integral of x plus {}", "code": "import numpy pandas loop {}", "general": "tell nice story friend {}"}
    data = [(f"{k}{i}", k, t.format(i)) for k, t in kinds.items() for i in range(40)]
    df = router.prepare(spark.createDataFrame(data, "id string, category string, text string"), "text")
    fitted = router.train(df, "category", 60, network)
    model = fitted.model
    assert 0 < fitted.iterations <= 50 and fitted.converged == (fitted.iterations < 50)
    scored = router.score(model, df)
    assert router.accuracy(scored, "label", "category").first()["accuracy"] == "100.0"
    assert all(1 / 3 <= r["confidence"] <= 1 for r in scored.collect())
    path = tempfile.mkdtemp(prefix="threadloom-test-") + "/model"
    writers.save_model(model, path)
    again = router.score(writers.load_model(path), df)
    assert rows_of(again, "id", "label") == rows_of(scored, "id", "label")


@pytest.mark.parametrize("n", [5, 300, 10**6])
def test_top_ngrams_equal_a_full_count(spark, sf, n):
    documents = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    rows = router.prepare(documents, "text", stem=False)
    got = features.top_ngrams(rows, "term_words", n)
    assert rows_of(got, "tf", "term") == rows_of(features.top_terms(rows, "terms", n), "tf", "term")


@pytest.mark.parametrize("counters, proven", [(4000, True), (40, False)])
def test_top_ngrams_by_summaries_of_any_size(spark, sf, monkeypatch, counters, proven):
    """The exact top also where tasks drop rare n-grams, and where the bound proves nothing."""
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = router.prepare(documents, "text", stem=False).repartition(3)
    want = rows_of(features.top_terms(rows, "terms", 50), "tf", "term")
    called = []
    by_parts = features._top_by_parts
    monkeypatch.setattr(features, "COUNTERS", counters)
    monkeypatch.setattr(features, "_top_by_parts", lambda *a: called.append(1) or by_parts(*a))
    assert rows_of(features.top_ngrams(rows, "term_words", 50), "tf", "term") == want
    assert bool(called) != proven


def test_top_ngrams_of_frequent_words_are_numbers(spark, sf, monkeypatch):
    """Longer n-grams are counted without a row each, in parts of any size; also those in the vocabulary of a row."""
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = router.prepare(documents, "text", stem=False).repartition(3)
    odd = spark.createDataFrame([([],), (None,), (["a", "b"] * 700 + ["c"],), (["a"],)], "term_words array<string>")
    odd = odd.withColumn("terms", X.ngram_terms("term_words"))
    monkeypatch.setattr(features, "_summaries", None)
    for df in (rows.select("term_words"), odd.select("term_words")):
        whole = df.withColumn("terms", X.ngram_terms("term_words"))
        for lengths in ((1, 3), (2, 3), (2, 2), (1, 1)):
            parts = [F.col("term_words") if k == 1 else X.ngrams("term_words", k) for k in range(lengths[0], lengths[1] + 1)]
            want = whole.select(F.explode(F.concat(*parts)).alias("term")).groupBy("term").agg(F.count("*").alias("tf"))
            want = want.orderBy(F.desc("tf"), "term").limit(60)
            assert rows_of(features.top_ngrams(df, "term_words", 60, lengths), "tf", "term") == rows_of(want, "tf", "term")
        vocab = [r["term"] for r in features.top_ngrams(df, "term_words", 60).collect()]
        held = dict(whole.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").count().collect())
        assert features._holders(df, "term_words", vocab).tolist() == [held[t] for t in vocab]


def test_known_terms_are_those_of_the_vocabulary(spark):
    lists = [(1, ["a", "b", "a", "b", "c"]), (2, []), (3, None), (4, ["x"]), (5, ["b", "a", "b"])]
    df = spark.createDataFrame(lists, "id int, words array<string>")
    got = df.select("id", features.known_terms("words", ["b", "a b", "c", "q r s", "a b a"]).alias("t")).collect()
    assert {r["id"]: sorted(r["t"]) for r in got} == {1: ["a b", "a b", "a b a", "b", "b", "c"], 2: [], 3: [], 4: [], 5: ["a b", "b", "b"]}


def test_summaries_bound_counts():
    rng = random.Random(7)
    for size in (1, 3, 20):
        summary, seen = features.Summary(size), Counter()
        for _ in range(200):
            terms = [f"t{int(rng.paretovariate(0.7))}" for _ in range(30)]
            summary.add(terms)
            seen.update(terms)
        assert len(summary.counts) <= 2 * size and summary.error <= sum(seen.values()) / size
        assert all(summary.counts[t] <= n <= summary.counts[t] + summary.error for t, n in seen.items())
        assert set(summary.counts) <= set(seen)


def test_label_codes(spark):
    df = spark.createDataFrame([("math",), ("code",), ("general",), ("code",)], "c string")
    assert rows_of(features.label_codes(df, "c")) == [("code", 0), ("general", 1), ("math", 2)]


def test_evaluation_lines(spark):
    df = spark.createDataFrame([("5 + 5", "math", "MATH"), ("x" * 40, "code", "general")], "t string, p string, e string")
    lines = [r["line"] for r in router.evaluation_rows(df, "t", "p", "e").collect()]
    assert lines[0] == f"[PASS] {'5 + 5':<30} -> MATH"
    assert lines[1] == f"[FAIL] {'x' * 30} -> Pred: CODE | Exp: GENERAL"


# --- generated rows -----------------------------------------------------------
def test_synth(spark):
    ids = spark.range(400)
    questions = [r["input"] for r in synth.arithmetic(ids, "id").collect()]
    assert len(set(questions)) > 300 and not any("{" in q for q in questions)
    snippets = {r["input"] for r in synth.snippets(ids, "id").collect()}
    assert "function main() {}" in snippets and "def main():" in snippets
    sentences = synth.keyword_sentences(spark.createDataFrame([("sum",)], "k string"), "k").collect()
    assert len(sentences) == 40 and all("sum" in r["text"] for r in sentences)
    assert synth.repeat_phrases(spark.createDataFrame([("p",)], "p string")).count() == 50


def test_word_dropout(spark):
    texts = ["one two three\tfour  five", "a  b", "", "x y z"]
    df = spark.createDataFrame([(i, t) for i in range(300) for t in [texts[i % 4]]], "id int, t string")
    changed = 0
    for r in synth.word_dropout(df, "id", "t").collect():
        words = texts[r["id"] % 4].split()
        if len(words) < 3:
            assert r["t"] == texts[r["id"] % 4]
        else:
            options = [" ".join(words[:k] + words[k + 1 :]) for k in range(len(words))]
            assert r["t"] == " ".join(words) or r["t"] in options
            changed += r["t"] in options
    assert 10 < changed < 60


def test_predicates_do_not_lose_null_rows(spark):
    df = spark.createDataFrame([(None,), ("x",)], "author string")
    assert rows_of(df.select(P.is_bot("author").alias("b"))) == [(False,), (True,)]
