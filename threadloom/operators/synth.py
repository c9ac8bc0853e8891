"""Generated rows driven by a table: one or more rows per input row, seeded by its key.

The same input gives the same rows under any partitioning.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.functions import draws


def _fill(template: Column, slots: dict[str, Column]) -> Column:
    return reduce(
        lambda t, slot: F.replace(t, F.lit("{" + slot[0] + "}"), slot[1]), slots.items(), template
    )


def arithmetic(
    df: DataFrame,
    key: str,
    largest: int = 100,
    operators=K.TRAINER_OPERATORS,
    templates=K.TRAINER_TEMPLATES,
    seed: str = "arith",
) -> DataFrame:
    """One arithmetic question per key: two operands in 1..largest, operator and template."""
    a = (draws.pick(f"{seed}-a", largest, key) + 1).cast("string")
    b = (draws.pick(f"{seed}-b", largest, key) + 1).cast("string")
    op = draws.choose(operators, draws.pick(f"{seed}-op", len(operators), key))
    template = draws.choose(templates, draws.pick(f"{seed}-t", len(templates), key))
    return df.select(key, _fill(template, {"a": a, "op": op, "b": b}).alias("input"))


def arithmetic_forms(
    df: DataFrame, key: str, largest: int = 1000, operators=K.SEQUENCE_OPERATORS, seed: str = "forms"
) -> DataFrame:
    """Per key the same question unspaced and spaced."""
    forms = [
        arithmetic(df, key, largest, operators, (template,), seed).withColumn("form", F.lit(i))
        for i, template in enumerate(K.SEQUENCE_TEMPLATES)
    ]
    return reduce(DataFrame.unionByName, forms)


def keyword_sentences(
    df: DataFrame,
    keyword: str,
    templates=K.MATH_KEYWORD_TEMPLATES,
    rounds: int = K.KEYWORD_ROUNDS,
    seed: str = "keyword",
) -> DataFrame:
    """Per keyword and round one generated sentence and one bare row."""
    numbered = df.select(keyword, F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"))
    bare = draws.pick(f"{seed}-bare", 100, keyword, "round") < K.BARE_KEYWORD_PERCENT
    template = draws.choose(templates, draws.pick(f"{seed}-t", len(templates), keyword, "round"))
    sentence = F.when(bare, F.col(keyword)).otherwise(_fill(template, {"keyword": F.col(keyword)}))
    texts = F.array(
        F.struct(F.lit("generated").alias("kind"), sentence.alias("text")),
        F.struct(F.lit("bare").alias("kind"), F.col(keyword).alias("text")),
    )
    return numbered.select(keyword, "round", F.inline(texts))


def snippets(df: DataFrame, key: str, libraries=K.SNIPPET_LIBRARIES, seed: str = "snippet") -> DataFrame:
    """One slot-filled code snippet per key."""
    def option(tag, options):
        return draws.choose(options, draws.pick(f"{seed}-{tag}", len(options), key))

    slots = {
        "lib": option("lib", libraries),
        "table": option("table", K.SNIPPET_VARIABLES),
        "var": option("var", K.SNIPPET_VARIABLES),
        "func": F.lit(K.SNIPPET_FUNCTION),
    }
    return df.select(key, _fill(option("t", K.SNIPPET_TEMPLATES), slots).alias("input"))


def repeat_phrases(df: DataFrame, times: int = K.PHRASE_REPEATS) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def word_dropout(df: DataFrame, key: str, text: str, seed: str = "drop") -> DataFrame:
    """With a fixed chance drop one random word; texts of fewer than three words stay as is."""
    words = df.withColumn("_words", F.filter(F.split(_python_space(text), " "), lambda w: w != ""))
    n = F.size("_words")
    at = (F.floor(draws.draw(seed, key) / F.lit(100)) % n).cast("int")
    dropped = F.concat(
        F.slice("_words", F.lit(1), at), F.slice("_words", at + F.lit(2), n)
    )
    chosen = F.when(draws.pick(seed, 100, key) < K.WORD_DROP_PERCENT, dropped).otherwise(F.col("_words"))
    noisy = F.when(n < 3, F.col(text)).otherwise(F.array_join(chosen, " "))
    return words.withColumn(text, noisy).drop("_words")


def _python_space(text: str) -> Column:
    """Every whitespace character as a plain space, as ``str.split()`` sees them."""
    return F.translate(F.col(text), K.WHITESPACE, " " * len(K.WHITESPACE))


def build_test_set(cases: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Labelled rows: the given cases plus generated maths and code rows for the ids."""
    maths = arithmetic(ids, key, 1000, K.SEQUENCE_OPERATORS, K.TEST_TEMPLATES, "test-math")
    code = snippets(ids, key, seed="test-code")

    def rows(df, prefix, category):
        row_id = F.concat(F.lit(prefix), F.col(key).cast("string")).alias("row_id")
        return df.select(row_id, F.lit(category).alias("category"), "input")

    return cases.select("row_id", "category", "input").unionByName(
        rows(maths, "m", "math")
    ).unionByName(rows(code, "c", "code"))
