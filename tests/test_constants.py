"""Values that decide results, written out; the SQL counterparts share the constants."""

from threadloom import constants as K
from threadloom.functions import prompts


def test_thresholds():
    assert (K.MIN_SCORE, K.BODY_LENGTH, K.POLISHED_BODY_MIN) == (50, (15, 1000), 15)
    assert (K.MATH_CAP, K.CODE_CAP, K.WORD_PROBLEM_CAP, K.FORUM_SAMPLE) == (250_000, 180_000, 100_000, 500_000)
    assert (K.MAX_VOCABULARY, K.SEQUENCE_LENGTH, K.PAD_ID, K.UNKNOWN_ID) == (12_000, 50, 0, 1)
    assert (K.CONTEXT_TOKENS, K.RESPONSE_RESERVE, K.HEADER_SCAN_LINES) == (2048, 512, 2048)


def test_temperatures():
    assert K.TEMPERATURES == {"v1": (0.1, 0.8), "v2": (0.2, 0.8), "reasoning": (0.4, 0.8)}


def test_maths_sources():
    assert len(K.MATH_SOURCES) == len({s for s, _, _ in K.MATH_SOURCES}) == 10
    assert {k for _, k, _ in K.MATH_SOURCES} == {"CoT", "PoT"}


def test_forum_prompt_texts():
    template = prompts.ForumTemplate()
    assert template.persona == "You are a user in r/{forum}."
    assert template.context_tail == "Reply to given comment in context: {context}"
