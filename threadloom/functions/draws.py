"""Seeded draws that depend on a row key only, never on partitioning.

``rand(seed)`` changes with the number of partitions and with retried tasks; an md5 of
``tag|key`` does not, so a re-run after a lost executor gives the same rows.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digest(tag: str, *keys) -> Column:
    """32 hex digits of md5 over ``tag|key|key...``."""
    return F.md5(F.concat_ws("|", F.lit(str(tag)), *[_col(k).cast("string") for k in keys]))


def draw(tag: str, *keys) -> Column:
    """Uniform integer in ``[0, 2**32)`` per key."""
    return F.conv(F.substring(digest(tag, *keys), 1, 8), 16, 10).cast("bigint")


def pick(tag: str, n: int, *keys) -> Column:
    """Uniform integer in ``[0, n)`` per key."""
    return draw(tag, *keys) % F.lit(n)


def choose(options, index: Column) -> Column:
    """The option at ``index`` of a short literal list."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))
