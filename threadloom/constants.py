"""Word lists, tables, thresholds and texts that decide results.

Everything in this module is data. The values must stay exactly as they are for
the results to match; operators take them as defaults and accept replacements.
"""

# --- Fixed values: whitespace -------------------------------------------------
# The 29 characters that Python's str.strip() and str.split() treat as space.
WHITESPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)

# --- Fixed values: admission --------------------------------------------------
TOMBSTONES = ("[removed]", "[deleted]")
MIN_SCORE = 50
BODY_LENGTH = (15, 1000)
TITLE_LENGTH = (10, 200)
SELFTEXT_LENGTH = (20, 1000)
TITLE_ONLY_MIN = 40
RECHECK_TITLE_MIN = 10
POLISHED_BODY_MIN = 15
LOOSE_LINK_MARKS = ("http", "www.")
STRICT_LINK_MARKS = ("http://", "https://", "www.")
GIF_MARK = "![gif]"
DEFAULT_AUTHOR = "bot"
DEFAULT_FORUM = "AskReddit"
BOT_SUFFIX = "bot"
BOT_AUTHORS = (
    "AutoModerator",
    "RemindMeBot",
    "WikiTextBot",
    "ClickableLinkBot",
    "HCE_Replacement_Bot",
    "BookStoreBot",
    "haiku_bot",
    "AmputatorBot",
    "Shakespeare-Bot",
    "Reddit-Book-Bot",
    "SaveVideo",
    "SaveVideobot",
    "gifreversingbot",
    "wandering-dwarf-miner",
    "CommunityModBot",
)

# --- Fixed values: entity decoding, in the order it is applied ----------------
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "))

# --- Fixed values: instruction texts ------------------------------------------
MCQ_TEXT = (
    "You are a Math tutor, solve the following multiple choice question giving the "
    "correct option and explanation without Latex formatting"
)
ASYMPTOTE_TEXT = (
    "You are a Math tutor, solve the following question giving a detailed explanation "
    "and asymptote diagram and Latex formatting"
)
LATEX_TEXT = (
    "You are a Math tutor, solve the following question giving a detailed explanation "
    "with Latex formatting"
)
PLAIN_TEXT = (
    "You are a Math tutor, solve the following question giving an explanation "
    "without Latex formatting"
)
DETAILED_PLAIN_TEXT = (
    "You are a Math tutor, solve the following question giving a detailed explanation "
    "without Latex formatting"
)
PYTHON_BARE_TEXT = (
    "You are a math tutor, solve the following question in python without comments "
    "giving the final answer"
)
PYTHON_COMMENTED_TEXT = (
    "You are a math tutor, solve the following question in python with comments "
    "giving the final answer"
)
PYTHON_MINIMAL_TEXT = (
    "You are a math tutor, solve the following question in python with minimum comments "
    "giving the final answer"
)
DEFAULT_MATH_TEXT = "You are a Math tutor, solve the following question."
CODE_PROMPT_TEXT = "You are a Senior Python Developer. Write a Python program to solve this."
CODE_SOLUTION_TEXT = (
    "You are a Senior Python Developer. Provide a comprehensive solution with code and "
    "explanation."
)
WORD_PROBLEM_TEXT = (
    "You are a Math Tutor. Solve the given question explaining every step in detail with "
    "Latex formatting."
)

# (source, kind, instruction)
MATH_SOURCES = (
    ("data/cot/aqua_rat.json", "CoT", MCQ_TEXT),
    ("data/cot/math50k_camel.json", "CoT", LATEX_TEXT),
    ("data/cot/gsm_rft.json", "CoT", PLAIN_TEXT),
    ("data/pot/mathqa.json", "PoT", PYTHON_BARE_TEXT),
    ("data/pot/gsm_gpt4.json", "PoT", PYTHON_COMMENTED_TEXT),
    ("data/pot/numglue.json", "PoT", PYTHON_MINIMAL_TEXT),
    ("data/cot/math_train.json", "CoT", ASYMPTOTE_TEXT),
    ("data/pot/math_train.json", "PoT", PYTHON_COMMENTED_TEXT),
    ("data/pot/aqua_rat_filtered.json", "PoT", PYTHON_COMMENTED_TEXT),
    ("data/cot/gsm_train.json", "CoT", DETAILED_PLAIN_TEXT),
)

# --- Fixed values: row caps and mixture ---------------------------------------
MATH_CAP = 250_000
CODE_CAP = 180_000
WORD_PROBLEM_CAP = 100_000
FORUM_SAMPLE = 500_000
HEAD_SAMPLE_LINES = 2049
HEADER_SCAN_LINES = 2048
SOURCE_CAP = 15_000
BALANCED_CLASS_SIZE = 150_000
MIX_PERCENT = (("forum", 60), ("code", 20), ("PoT", 10), ("CoT", 10))

# --- Fixed values: features ---------------------------------------------------
MAX_VOCABULARY = 12_000
SEQUENCE_LENGTH = 50
PAD_TOKEN, PAD_ID = "<PAD>", 0
UNKNOWN_TOKEN, UNKNOWN_ID = "<UNK>", 1
NGRAM_RANGE = (1, 3)
HIDDEN_LAYERS = (64, 32)
TECHNICAL_WORDS = ("code", "python", "script", "solve", "calculate", "math", "function")

# --- Fixed values: English stop words -----------------------------------------
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours
    yourself yourselves he him his himself she she's her hers herself it it's its itself
    they them their theirs themselves what which who whom this that that'll these those
    am is are was were be been being have has had having do does did doing a an the and
    but if or because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under again further
    then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don don't should
    should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn
    doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn
    mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won
    won't wouldn wouldn't
    """.split()
)

# --- Fixed values: chat -------------------------------------------------------
MAX_TURNS = 5
CONTEXT_TOKENS = 2048
RESPONSE_RESERVE = 512
# profile -> (technical temperature, general temperature)
TEMPERATURES = {"v1": (0.1, 0.8), "v2": (0.2, 0.8), "reasoning": (0.4, 0.8)}
TECHNICAL_LABELS = ("MATH", "CODE")
# profile -> maths prompt
MATH_PROMPTS = {"v1": PYTHON_BARE_TEXT, "v2": PLAIN_TEXT, "reasoning": PLAIN_TEXT}
FORUM_BY_TOPIC = (
    ("FINANCE", "wallstreetbets"),
    ("GAMING", "gaming"),
    ("RELATIONSHIPS", "relationship_advice"),
    ("POLITICS", "politics"),
    ("TECH", "technology"),
    ("GENERAL", "AskReddit"),
)
BLOCKED_MODULES = ("os", "sys", "subprocess")

# --- Fixed values: generated rows ---------------------------------------------
TRAINER_OPERATORS = ("+", "-", "*", "/", "=", "plus", "minus", "times", "divided by")
SEQUENCE_OPERATORS = ("+", "-", "*", "/", "plus", "minus", "times", "divided by", "%")
TRAINER_TEMPLATES = (
    "{a} {op} {b}",
    "what is {a} {op} {b}",
    "calculate {a} {op} {b}",
    "solve {a} {op} {b}",
    "{a} {op} {b} ?",
)
TEST_TEMPLATES = (
    "{a} {op} {b}",
    "what is {a} {op} {b}?",
    "calculate {a} {op} {b}",
    "solve {a} {op} {b}",
    "if i have {a} apples and lose {b}, how many left?",
    "find the result of {a} {op} {b}",
)
SEQUENCE_TEMPLATES = ("{a}{op}{b}", "{a} {op} {b}")
MATH_KEYWORD_TEMPLATES = (
    "how do i calculate the {keyword}?",
    "what is the formula for {keyword}?",
    "help me solve this {keyword} problem",
    "find the {keyword}",
    "solve for {keyword}",
    "calculate {keyword}",
    "evaluate this {keyword}",
    "i have a homework question about {keyword}",
    "use {keyword} to solve the equation",
    "apply the {keyword} rule",
)
CODE_KEYWORD_TEMPLATES = (
    "write a python script to {keyword}",
    "how do i implement {keyword}?",
    "show me an example of {keyword}",
    "debug this {keyword} issue",
    "why is {keyword} not working?",
    "fix the syntax in my {keyword}",
    "how to install {keyword}?",
    "import {keyword} library",
    "run the {keyword} command",
)
SNIPPET_TEMPLATES = (
    "import {lib}",
    "include <{lib}>",
    "npm install {lib}",
    "pip install {lib}",
    "const {var} = require('{lib}')",
    "SELECT * FROM {table}",
    "def {func}():",
    "public static void {func}()",
    "function {func}() {}",
)
SNIPPET_LIBRARIES = ("numpy", "pandas", "react", "iostream", "math.h", "requests", "express")
SNIPPET_VARIABLES = ("data", "user", "response", "config")
SNIPPET_FUNCTION = "main"
KEYWORD_ROUNDS = 20
PHRASE_REPEATS = 50
BARE_KEYWORD_PERCENT = 10
WORD_DROP_PERCENT = 20
