"""Forum-shaped views over the test tables, once as DataFrames and once as SQL text.

Every line of every document is a comment, every document is a submission. The select
bodies are shared by both engines; only the draw and the line split differ. Texts are
whole; marks such as quotes, tags, entities, links and edit notes are added by draw because
the plain test text holds almost none.
"""

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.operators.network import Network
from threadloom.session import new_stage
from threadloom.sources import dumps
from threadloom.sources.readers import path_exists

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def spark_draw(tag: str, *keys: str) -> str:
    text = ", '|', ".join(f"cast({k} as string)" for k in keys)
    return f"cast(conv(substr(md5(concat('{tag}|', {text})), 1, 8), 16, 10) as bigint)"


def duck_draw(tag: str, *keys: str) -> str:
    text = " || '|' || ".join(f"({k})" for k in keys)
    return f"(('0x' || substr(md5('{tag}|' || {text}), 1, 8))::BIGINT)"


def case(index: str, options) -> str:
    """``options[index]`` as a CASE expression."""
    arms = " ".join(
        f"when {i} then '{o.replace(chr(39), chr(39) * 2)}'" for i, o in enumerate(options)
    )
    return f"case {index} {arms} end"


# Sources as they may be spelled in the data, and two unknown ones.
SOURCE_SPELLINGS = [f" {s.upper()} " if i % 2 else s for i, (s, _, _) in enumerate(K.MATH_SOURCES)]
SOURCE_SPELLINGS += ["data/cot/unknown.json", ""]

COMMENT_SELECT = """
    concat('c', rid) as id,
    case when line_no = 0 or p % 3 = 0 then concat('t3_s', doc_id)
         else concat('t1_c', rid - 1) end as parent_id,
    case when h % 47 = 0 then null else concat('t3_s', doc_id) end as link_id,
    case when h % 37 = 0 then null else source end as subreddit,
    case when h % 29 = 0 then 'AutoModerator' when h % 10 = 1 then 'helper_Bot'
         when h % 41 = 0 then null else concat('user', h % 50) end as author,
    case when h % 43 = 0 then null else s % 200 end as score,
    case when h % 23 = 0 then '[removed]' else concat(
        case when h % 5 = 0 then concat('> quoted line', chr(10)) else '' end,
        line,
        case when h % 13 = 0 then ' <b>bold</b>' else '' end,
        case when h % 3 = 0 then ' A &amp; B &lt;i&gt;x&lt;/i&gt; &amp;lt;&nbsp;' else '' end,
        case when h % 17 = 0 then ' sooooooo!!!!!!' else '' end,
        case when h % 19 = 0 then ' ![gif](abc)' else '' end,
        case when h % 11 = 0 then ' see http://ex.org' else '' end,
        case when h % 7 = 0 then concat(chr(10), '  EDIT: fixed typo') else '' end,
        case when h % 6 = 1 then concat('  ', chr(10)) else '' end) end as body,
    rid as pos
"""

SUBMISSION_SELECT = """
    concat('s', doc_id) as id,
    case when h % 37 = 0 then '' else source end as subreddit,
    case when h % 29 = 0 then 'SaveVideo' when h % 10 = 1 then 'helper_Bot'
         else concat('user', h % 50) end as author,
    s % 200 as score,
    case when h % 23 = 0 then '[removed] '
         when h % 31 = 0 then concat('ALL CAPS TITLE NUMBER ', doc_id, ' IS LONG ENOUGH TO PASS')
         when h % 27 = 0 then '<b>title</b> a'
         else concat(' ', first_line,
             case when h % 13 = 0 then ' <b>x</b>' else '' end,
             case when h % 17 = 0 then ' sooooooo!!!!!!' else '' end) end as title,
    case when h % 4 = 0 then '' when h % 41 = 0 then null else concat(
        case when h % 5 = 0 then concat('> quoted line', chr(10)) else '' end,
        substr(text, cast(length(first_line) + 2 as int)),
        case when h % 13 = 0 then ' <b>bold</b>' else '' end,
        case when h % 3 = 0 then ' A &amp; B &lt;i&gt;x&lt;/i&gt; &amp;lt;&nbsp;' else '' end,
        case when h % 19 = 0 then ' ![gif](abc)' else '' end,
        case when h % 11 = 0 then ' see https://ex.org' else '' end,
        case when h % 7 = 0 then concat(chr(10), '  EDIT: fixed typo') else '' end) end as selftext,
    doc_id as pos
"""

SOURCED_SELECT = f"""
    doc_id as id,
    first_line as instruction,
    text as output,
    {case('h % 12', SOURCE_SPELLINGS)} as source
"""

TOOL_SELECT = """
    doc_id as id,
    case h % 4
        when 0 then concat('<TOOL_CALL>', chr(10), 'x = 1', chr(10), '  import os', chr(10), text, chr(10), '</TOOL_CALL>')
        when 1 then concat('<TOOL_CALL>', chr(10), 'from subprocess import run', chr(10), text, chr(10), '</TOOL_CALL>')
        when 2 then concat('Answer: <TOOL_CALL>', chr(10), 'import osmosis', chr(10), text, chr(10), '</TOOL_CALL>')
        else text end as output
"""

THINK_SELECT = """
    conv_id, turn, role,
    case when role = 'assistant' and h % 2 = 0
         then concat('<think>', chr(10), 'plan ', turn, chr(10), '</think>', chr(10), text, ' <think>x</think> ')
         else text end as text
"""

LABELLED_SELECT = f"""
    conv_id, turn, role, text,
    {case('h % 3', (' math', 'Code ', 'general'))} as label,
    {case('p % 3', ('MATH', 'code', 'General'))} as predicted,
    case when h % 7 = 0 then null when h % 7 = 1 then '' else concat('src', conv_id % 20) end as forum,
    case when p % 5 = 0 then null when p % 5 = 1 then '' else text end as context
"""

# A line of the dump: every eleventh is broken, and ids come again.
DUMP_LINE = """case when pos % 11 = 0 then concat('{"id": "r', pos % 997, '", "score": ')
    else concat('{"id": "r', pos % 997, '", "score": ', coalesce(cast(score as string), 'null'),
         ', "subreddit": "', coalesce(subreddit, ''), '", "unread": [1, {"a": ', pos, '}]}') end"""
DUCK_DUMP_LINE = DUMP_LINE.replace("as string", "as varchar")

# JSON with fields that come and go, a null value and a nested object.
FIELDS_SELECT = """
    event_id,
    concat('{', case when h % 3 > 0 then '"b": 1, ' else '' end,
        case when h % 5 = 0 then '"c": null, ' else '' end,
        case when h % 7 = 0 then concat('"d', h % 3, '": {"x": 1}, ') else '' end,
        '"a": "', event_type, '"}') as line
"""

PROPS_SELECT = """
    event_id,
    case when h % 13 = 0 then '{"k": ' when h % 17 = 0 then '{"k": "12"}'
         when h % 19 = 0 then '{"k": null}' when h % 23 = 0 then '{}' else props end as line
"""


#: What the inputs of the fixed network count, and its layers.
LETTERS = "aeinst"
FIXED_SIZES = (6, 4, 3, 3)


def fixed_weight(layer: int, i: int, j: int) -> float:
    """Weight from unit i to unit j of the next layer; i = -1 is the bias."""
    return ((layer * 5 + i * 7 + j * 3) % 11 - 5) / (2 if i >= 0 else 20)


def fixed_network() -> Network:
    parts = []
    for layer, (a, b) in enumerate(zip(FIXED_SIZES[:-1], FIXED_SIZES[1:], strict=True)):
        parts += [fixed_weight(layer, i, j) for i in [*range(a), -1] for j in range(b)]
    return Network(FIXED_SIZES, np.array(parts))


# Tables with long texts, and the key by which their rows are dealt out on request.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}
#: Set by a caller whose tables are single files with one row group, which one task would
#: read: the number of partitions for their rows. Unset, a scan is left as it is.
SCAN_PARTITIONS = "threadloom.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    asked = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(asked), TEXT_TABLES[name]) if asked and name in TEXT_TABLES else df


def version_of(spark: SparkSession, folder: str) -> str:
    """A hash of the files in a folder of tables: their names, lengths and times of change."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    waiting, found = list(system.listStatus(path)), []
    while waiting:
        status = waiting.pop()
        if status.isDirectory():
            waiting += system.listStatus(status.getPath())
        else:
            found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


_staged: dict[tuple[str, ...], str] = {}


def kept_path(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The path of something made from the tables of a folder, once per application and state of the folder."""
    key = (spark.sparkContext.applicationId, sf_dir, version_of(spark, sf_dir), name)
    path = _staged.get(key)
    if path is None or not path_exists(spark, path):
        path = new_stage(spark)
        write(path)
        _staged[key] = path
    return path


def staged(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """Rows written once and read from there, as a raw dump brought to Parquet would be: filters
    and columns reach the scan."""
    return spark.read.parquet(kept_path(spark, sf_dir, name, lambda path: rows().write.parquet(path)))


def _documents(spark: SparkSession, sf_dir: str, tag: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "*",
        F.expr("split_part(text, chr(10), 1)").alias("first_line"),
        F.expr(spark_draw(tag, "doc_id")).alias("h"),
        F.expr(spark_draw("score", "doc_id")).alias("s"),
    )


def _project(df: DataFrame, body: str) -> DataFrame:
    """Apply a shared select body."""
    return df.selectExpr(f"inline_outer(array(struct({body})))")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "comments", lambda: _comments(spark, sf_dir))


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    rows = lines.withColumn("rid", F.expr("doc_id * 100000 + line_no"))
    draws = {t: F.expr(spark_draw(tag, "rid")) for t, tag in (("h", "dirty"), ("s", "score"), ("p", "parent"))}
    return _project(rows.withColumns(draws), COMMENT_SELECT)


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lambda: _project(_documents(spark, sf_dir, "post"), SUBMISSION_SELECT)
    return staged(spark, sf_dir, "submissions", rows)


def sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_documents(spark, sf_dir, "sourced"), SOURCED_SELECT)


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_documents(spark, sf_dir, "tool"), TOOL_SELECT)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "conv_id * 100 + turn"
    return table(spark, sf_dir, "conversations").withColumns(
        {"h": F.expr(spark_draw("msg", key)), "p": F.expr(spark_draw("pred", key))}
    )


def thinking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_messages(spark, sf_dir), THINK_SELECT)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_messages(spark, sf_dir), LABELLED_SELECT)


def dump(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a comment dump: NDJSON files in the order of ``pos``, ids that come again,
    and broken lines."""

    def rows() -> DataFrame:
        lines = comments(spark, sf_dir).selectExpr("pos", f"{DUMP_LINE} as line")
        return lines.repartitionByRange("pos").sortWithinPartitions("pos").select("line")

    return kept_path(spark, sf_dir, "dump", lambda path: rows().write.option("compression", "gzip").text(path))


def split_dump(spark: SparkSession, sf_dir: str, codec: str = "zstd", frame_bytes: int = 1 << 16) -> str:
    """The same dump in a few files of many small frames each, which end at any byte."""
    folder = f"{new_stage(spark)}.{codec}"
    lines = comments(spark, sf_dir).selectExpr("pos", f"{DUMP_LINE} as value")
    ordered = lines.repartitionByRange(2, "pos").sortWithinPartitions("pos")
    dumps.write_frames(ordered, folder, codec, frame_bytes).write.format("noop").mode("overwrite").save()
    return folder


def many_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _project(events.withColumn("h", F.expr(spark_draw("fields", "event_id"))), FIELDS_SELECT)


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _project(events.withColumn("h", F.expr(spark_draw("props", "event_id"))), PROPS_SELECT)


_DUCK_DOCUMENTS = """
    (select *, split_part(text, chr(10), 1) as first_line, {h} as h, {s} as s from documents)
"""


def _duck_documents(tag: str) -> str:
    return _DUCK_DOCUMENTS.format(h=duck_draw(tag, "doc_id"), s=duck_draw("score", "doc_id"))


_DUCK_MESSAGES = (
    f"(select *, {duck_draw('msg', 'conv_id * 100 + turn')} as h, "
    f"{duck_draw('pred', 'conv_id * 100 + turn')} as p from conversations)"
)

DUCK_VIEWS = {
    "lines_v": """
        select doc_id, source, generate_subscripts(l, 1) - 1 as line_no, unnest(l) as line
        from (select *, string_split(text, chr(10)) as l from documents)""",
    "comments_v": f"""
        select {COMMENT_SELECT} from (
            select *, {duck_draw('dirty', 'rid')} as h, {duck_draw('score', 'rid')} as s,
                   {duck_draw('parent', 'rid')} as p
            from (select *, doc_id * 100000 + line_no as rid from lines_v))""",
    "submissions_v": f"select {SUBMISSION_SELECT} from {_duck_documents('post')}",
    "sourced_v": f"select {SOURCED_SELECT} from {_duck_documents('sourced')}",
    "tool_v": f"select {TOOL_SELECT} from {_duck_documents('tool')}",
    "thinking_v": f"select {THINK_SELECT} from {_DUCK_MESSAGES}",
    "labelled_v": f"select {LABELLED_SELECT} from {_DUCK_MESSAGES}",
    "fields_v": f"select {FIELDS_SELECT} from (select *, {duck_draw('fields', 'event_id')} as h from events)",
    "props_v": f"select {PROPS_SELECT} from (select *, {duck_draw('props', 'event_id')} as h from events)",
}
DUCK_NEEDS = {"comments_v": ("lines_v",)}


def with_views(views: str, sql: str) -> str:
    """Put the definitions of the named views in front of a query."""
    names: list[str] = []
    for view in views.split():
        names += [n for n in (*DUCK_NEEDS.get(view, ()), view) if n not in names]
    head = ",\n".join(f"{n} as ({DUCK_VIEWS[n]})" for n in names)
    body = sql.strip()
    if body.startswith("with "):
        return f"with {head},\n{body[5:]}"
    return f"with {head}\n{body}"
