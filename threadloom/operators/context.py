"""Conversation history and prompt assembly over rows (conv_id, turn, role, text).

``turn`` is an integer, unique within a conversation.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.functions import prompts
from threadloom.functions import text as X
from threadloom.operators.ranks import running_totals

CONV = ("conv_id",)


def dialogue(messages: DataFrame) -> DataFrame:
    """Turns that belong to a history: system messages are prompts, not turns."""
    return messages.where(F.col("role") != "system")


def store_answers(messages: DataFrame) -> DataFrame:
    """History keeps the answer of an assistant turn without its reasoning."""
    answer = F.when(F.col("role") == "assistant", X.strip_reasoning("text"))
    return messages.withColumn("text", F.coalesce(answer, F.col("text")))


def last_messages(messages: DataFrame, n: int = 2 * K.MAX_TURNS) -> DataFrame:
    """The newest ``n`` messages per conversation; ranks are cut before the shuffle too."""
    newest = Window.partitionBy("conv_id").orderBy(F.col("turn").desc())
    return messages.withColumn("age", F.row_number().over(newest)).where(F.col("age") <= n)


def _line(newline: bool) -> Column:
    line = prompts.message_line("role", "text")
    return F.concat(line, F.lit("\n")) if newline else line


def _join_lines(separator: str) -> Column:
    """The lines of one bounded history in turn order; null entries are left out."""
    entry = F.when(F.col("line").isNotNull(), F.struct("line_turn", "line"))
    lines = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["line"])
    return F.array_join(lines, separator)


def render_last(messages: DataFrame, n: int = 2 * K.MAX_TURNS) -> DataFrame:
    """The history string of each conversation at its end, in both line styles."""
    recent = last_messages(messages, n).select(
        "conv_id", F.col("turn").alias("line_turn"), _line(False).alias("line")
    )
    joined = recent.groupBy("conv_id").agg(_join_lines("\n").alias("joined"))
    return joined.withColumn("terminated", F.concat("joined", F.lit("\n")))


def history_budget(system_cost, input_cost) -> Column:
    """Tokens left for history after the prompt, the input and the reserved response."""
    return F.lit(K.CONTEXT_TOKENS) - (system_cost + input_cost + F.lit(K.RESPONSE_RESERVE))


def budget_history(messages: DataFrame, budget: int, cost: Column) -> DataFrame:
    """Newest messages of each conversation whose summed cost stays within the budget.

    Costs are not negative, so stopping at the first message that does not fit is the same
    as keeping those whose cost sum, counted from the newest, is within the budget: running
    totals over the turns in reverse.
    """
    reverse = messages.withColumn("_reverse", -F.col("turn"))
    spent = running_totals(reverse, CONV, "_reverse", {"from_newest": cost})
    return spent.where(F.col("from_newest") <= budget).drop("_reverse")


def bounded_history(
    messages: DataFrame, budget: Column, largest_budget: int, cost: Column, newline: bool
) -> DataFrame:
    """The history string that each user message sees: (conv_id, turn, ctx).

    Message h is part of the history of message u when the cost from the start of h up to
    u fits into the budget of u, a range condition on running totals. The totals are cut
    into bins as wide as the largest budget, so u meets only the messages of two bins, and
    one long conversation is spread over many join keys instead of pairing with itself.
    """
    rows = running_totals(
        messages.withColumn("_cost", cost), CONV, "turn", {"_spent": F.col("_cost")}
    ).withColumn("_start", F.col("_spent") - F.col("_cost"))
    users = rows.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("_start").alias("_before"), budget.alias("_budget")
    )
    oldest = F.greatest(F.col("_before") - F.col("_budget"), F.lit(0))
    bins = F.sequence(_bin(oldest, largest_budget), _bin(F.col("_before"), largest_budget))
    asked = users.withColumn("_bin", F.explode_outer(F.when(F.col("_budget") > 0, bins)))
    lines = rows.select(
        "conv_id",
        F.col("turn").alias("line_turn"),
        "_start",
        _bin(F.col("_start"), largest_budget).alias("_bin"),
        _line(newline).alias("line"),
    )
    a, b = asked.alias("a"), lines.alias("b")
    fits = (
        F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
        & (F.col("a._bin") == F.col("b._bin"))
        & (F.col("b.line_turn") < F.col("a.turn"))
        & (F.col("a._before") - F.col("b._start") <= F.col("a._budget"))
    )
    found = a.join(b, fits, "left").groupBy("a.conv_id", "a.turn")
    return found.agg(_join_lines("" if newline else "\n").alias("ctx"))


def _bin(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width))


def last_n_history(messages: DataFrame, n: int = 2 * K.MAX_TURNS) -> DataFrame:
    """History of the last ``n`` messages before each user message, joined by newlines."""
    return bounded_history(messages, F.lit(n), n, F.lit(1), newline=False)


def history_context(messages: DataFrame, system_cost: int, cost=F.length) -> DataFrame:
    """Budgeted history before each user message; ``cost`` maps a text to its tokens."""
    return bounded_history(
        messages,
        history_budget(F.lit(system_cost), cost(F.col("text"))),
        K.CONTEXT_TOKENS - K.RESPONSE_RESERVE,
        cost(_line(True)),
        newline=True,
    )


def technical_prompt(route: Column, profile: str) -> Column:
    """The prompt of a maths or code message, null for the forum route."""
    return F.when(route == "MATH", F.lit(K.MATH_PROMPTS[profile])).when(
        route == "CODE", F.lit(K.CODE_PROMPT_TEXT)
    )


def route_prompt(df: DataFrame, label: str, template=prompts.ForumTemplate()) -> DataFrame:
    """Label to route, and per profile the temperature and the base prompt."""
    route = prompts.canonical_label(label)
    forum = prompts.forum_prompt(F.lit(""), F.lit(""), template)
    columns = [route.alias("route")]
    for profile in K.TEMPERATURES:
        prompt = F.coalesce(technical_prompt(route, profile), forum)
        columns.append(prompts.temperature(label, profile).alias(f"temperature_{profile}"))
        columns.append(prompt.alias(f"prompt_{profile}"))
    return df.select("*", *columns)


def request_rows(
    messages: DataFrame,
    label: Column,
    forum: Column,
    system_cost: int,
    profile: str = "v2",
    template=prompts.ForumTemplate(),
) -> DataFrame:
    """Requests for each user message: ``[{system}, {user}]`` with the history it may see.

    ``v1``: last messages, forum prompt only. ``v2``: budgeted history, forum prompt only.
    ``reasoning``: budgeted history, which follows the prompt of every route as a section of
    its own.
    """
    if profile == "v1":
        history = last_n_history(messages)
    else:
        history = history_context(messages, system_cost)
    users = messages.where(F.col("role") == "user").join(history, ["conv_id", "turn"])
    route = prompts.canonical_label(label)
    technical = technical_prompt(route, profile)
    if profile == "reasoning":
        base = F.coalesce(technical, prompts.forum_prompt(forum, F.lit(""), template))
        system = F.concat(base, prompts.context_section("ctx"))
    else:
        system = F.coalesce(technical, prompts.forum_prompt(forum, F.col("ctx"), template))
    return users.select(
        "conv_id",
        "turn",
        route.alias("route"),
        prompts.temperature(label, profile).alias("temperature"),
        prompts.messages(system, F.col("text")).alias("messages"),
    )
