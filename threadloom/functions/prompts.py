"""Prompt, routing and rendering expressions."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.functions import text as X


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def chatml(instruction, input, output) -> Column:
    """One training text of three turns; missing parts are empty."""

    def turn(role, c):
        body = F.coalesce(_col(c), F.lit(""))
        return F.concat(F.lit(f"<|im_start|>{role}\n"), body, F.lit("<|im_end|>"))

    return F.concat_ws(
        "\n", turn("system", instruction), turn("user", input), turn("assistant", output)
    )


def reply_instruction(forum, context) -> Column:
    """Instruction of a reply pair; a missing forum prints as ``None``."""
    head = F.concat(
        F.lit("You are a user in r/"),
        F.coalesce(_col(forum), F.lit("None")),
        F.lit(", Reply to the given comment"),
    )
    title = _col(context)
    return F.when(title.isNull(), F.concat(head, F.lit("."))).otherwise(
        F.concat(head, F.lit(" in context: "), title, F.lit("."))
    )


def canonical_label(c) -> Column:
    return X.strip_ws(F.upper(_col(c)))


def canonical_source(c) -> Column:
    return X.strip_ws(F.lower(_col(c)))


def temperature(label, profile: str = "v1") -> Column:
    technical, general = K.TEMPERATURES[profile]
    return F.when(canonical_label(label).isin(*K.TECHNICAL_LABELS), F.lit(technical)).otherwise(
        F.lit(general)
    )


def forum_of_topic(topic, table=K.FORUM_BY_TOPIC) -> Column:
    forum = F.lit(K.DEFAULT_FORUM)
    for name, value in table:
        forum = F.when(canonical_label(topic) == name, F.lit(value)).otherwise(forum)
    return forum


@dataclass(frozen=True)
class ForumTemplate:
    """Forum prompt texts: ``persona`` holds ``{forum}``, the tails follow it.

    The wording is a parameter. Callers with their own persona pass their own template.
    """

    persona: str = "You are a user in r/{forum}."
    tail: str = "Reply to given comment."
    context_tail: str = "Reply to given comment in context: {context}"


def forum_prompt(forum, context, template: ForumTemplate = ForumTemplate()) -> Column:
    """Four cases: forum given or defaulted, context given or not."""
    name = F.coalesce(F.nullif(_col(forum), F.lit("")), F.lit(K.DEFAULT_FORUM))
    ctx = F.nullif(_col(context), F.lit(""))
    persona = F.replace(F.lit(template.persona), F.lit("{forum}"), name)
    with_context = F.replace(F.lit(template.context_tail), F.lit("{context}"), ctx)
    return F.concat(persona, F.coalesce(with_context, F.lit(template.tail)))


def context_section(context) -> Column:
    """The history as a section behind a prompt; nothing without a history."""
    ctx = F.nullif(_col(context), F.lit(""))
    return F.coalesce(F.concat(F.lit("\n\nCONTEXT:\n"), ctx), F.lit(""))


def math_prompt(latex, mcq, code, explain, comments, asymptote) -> Column:
    """Decision list over six boolean columns; the first rule that holds wins."""
    latex, mcq, code = _col(latex), _col(mcq), _col(code)
    explain, comments, asymptote = _col(explain), _col(comments), _col(asymptote)
    bare_code = code & ~latex & ~explain
    return (
        F.when(mcq, F.lit(K.MCQ_TEXT))
        .when(asymptote, F.lit(K.ASYMPTOTE_TEXT))
        .when(~code & latex & explain, F.lit(K.LATEX_TEXT))
        .when(~code & ~latex & explain, F.lit(K.PLAIN_TEXT))
        .when(bare_code & ~comments, F.lit(K.PYTHON_BARE_TEXT))
        .when(bare_code & comments, F.lit(K.PYTHON_COMMENTED_TEXT))
        .when(~code & latex & ~explain, F.lit(K.DETAILED_PLAIN_TEXT))
        .otherwise(F.lit(K.DEFAULT_MATH_TEXT))
    )


def message_line(role, content) -> Column:
    """``Role: content`` with a title-case role."""
    return F.concat(F.initcap(_col(role)), F.lit(": "), _col(content))


def messages(system, user) -> Column:
    """The two-message request: ``[{system}, {user}]``."""

    def message(role, c):
        return F.struct(F.lit(role).alias("role"), _col(c).alias("content"))

    return F.array(message("system", system), message("user", user))


def mentions_technical_word(c, words=K.TECHNICAL_WORDS) -> Column:
    return F.lower(_col(c)).rlike("|".join(words))
