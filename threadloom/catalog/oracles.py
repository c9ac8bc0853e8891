"""For each registered query the same result as SQL for DuckDB."""

from threadloom import constants as K
from threadloom.catalog import views as V
from threadloom.catalog.views import duck_draw as draw
from threadloom.catalog.views import with_views
from threadloom.functions.prompts import ForumTemplate

ORACLES: dict[str, str] = {}


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def names(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# --- text expressions ---------------------------------------------------------
SPACE = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160))"


def strip(c: str) -> str:
    return f"trim({c}, {SPACE})"


def unescape(c: str) -> str:
    for old, new in K.ENTITIES:
        c = f"replace({c}, {q(old)}, {q(new)})"
    return c


def cut_edit(c: str) -> str:
    return rf"regexp_split_to_array({c}, '(?i)\n\s*edit:')[1]"


def strip_quotes(c: str) -> str:
    return f"regexp_replace({c}, '(?m)^>.*$', '', 'g')"


def strip_tags(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]+>', '', 'g')"


def strip_gif(c: str) -> str:
    return rf"regexp_replace({c}, '!\[gif\]\([^\n]*?\)', '', 'g')"


def polish(c: str) -> str:
    return strip(strip_gif(strip_tags(strip_quotes(c))))


def normalise(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^a-z0-9+=*<> -]', ' ', 'g')"


def normalise_spaced(c: str) -> str:
    spaced = rf"regexp_replace(lower({c}), '([+=*<>/-])', ' \1 ', 'g')"
    return f"regexp_replace({spaced}, '[^a-z0-9+=*<> -]', ' ', 'g')"


def tokens(normalised: str) -> str:
    return f"list_filter(string_split({normalised}, ' '), lambda w: w <> '')"


def content_words(normalised: str) -> str:
    return f"list_filter({tokens(normalised)}, lambda w: w not in {names(K.STOP_WORDS)})"


def squeeze(name: str, source: str, key: str, text: str) -> str:
    """CTEs that end in ``name(key, text)``: runs of one character cut to three.

    Gaps and islands over single characters, because the regular expressions of the
    checking engine have no back-references.
    """
    return rf"""
    {name}_c as (select {key}, unnest(regexp_extract_all({text}, '(?s).')) as c,
                 generate_subscripts(regexp_extract_all({text}, '(?s).'), 1) as p from {source}),
    {name}_g as (select *, p - row_number() over (partition by {key}, c order by p) as grp from {name}_c),
    {name}_r as (select *, row_number() over (partition by {key}, c, grp order by p) as rn from {name}_g),
    {name}_s as (select {key}, string_agg(c, '' order by p) as t from {name}_r
                 where rn <= 3 or c = chr(10) group by {key}),
    {name} as (select v.{key}, case when v.{text} is null then null else coalesce(s.t, '') end as {text}
               from {source} v left join {name}_s s on s.{key} = v.{key})"""


def with_ctes(views: str, *parts: str) -> str:
    """Views, further CTEs, and a final select."""
    *ctes, final = parts
    head = "with " + ",\n".join(c.strip() for c in ctes) + "\n" if ctes else ""
    return with_views(views, head + final)


# --- predicates ---------------------------------------------------------------
TOMBSTONE = f"body in {names(K.TOMBSTONES)}"
BOT = (
    f"(coalesce(author, 'bot') in {names(K.BOT_AUTHORS)} "
    "or ends_with(lower(coalesce(author, 'bot')), 'bot'))"
)
HAS_SCORE = f"coalesce(score, 0) >= {K.MIN_SCORE}"
BODY_LENGTH = "length(body) between 15 and 1000"
LOOSE_LINK = "(contains(body, 'http') or contains(body, 'www.'))"
GIF = "contains(body, '![gif]')"
TITLE = strip("title")
SELF = strip("coalesce(selftext, '')")
COMBINED = f"({TITLE} || ' ' || {SELF})"
STRICT_LINK = (
    f"(contains({COMBINED}, 'http://') or contains({COMBINED}, 'https://') "
    f"or contains({COMBINED}, 'www.'))"
)
LETTERS = r"length(regexp_replace({c}, '[^\p{{L}}]', '', 'g'))"
CAPITALS = r"length(regexp_replace({c}, '[^\p{{Lu}}]', '', 'g'))"


def letters(c: str) -> str:
    return LETTERS.format(c=c)


def capitals(c: str) -> str:
    return CAPITALS.format(c=c)


def all_caps(c: str) -> str:
    return f"({letters(c)} > 0 and {letters(c)} = {capitals(c)})"


def is_ascii(c: str) -> str:
    return rf"regexp_full_match({c}, '(?s)[\x00-\x7F]*')"


COMMENT_REASON = f"""case
    when {TOMBSTONE} then 'tombstone' when not ({HAS_SCORE}) then 'score' when {BOT} then 'bot'
    when not ({BODY_LENGTH}) then 'length' when {LOOSE_LINK} then 'link' when {GIF} then 'gif' end"""
SUBMISSION_REASON = f"""case
    when {TITLE} in {names(K.TOMBSTONES)} then 'tombstone' when {BOT} then 'bot'
    when not ({HAS_SCORE}) then 'score' when not (length({TITLE}) between 10 and 200) then 'title_length'
    when {all_caps(TITLE)} then 'all_caps'
    when length({SELF}) > 0 and not (length({SELF}) between 20 and 1000) then 'body_length'
    when length({SELF}) = 0 and length({TITLE}) < 40 then 'title_only_length'
    when {STRICT_LINK} then 'link' when contains({SELF}, '![gif]') then 'gif' end"""
KEPT_COMMENTS = f"kept_c as materialized (select * from comments_v where ({COMMENT_REASON}) is null)"
KEPT_SUBMISSIONS = f"kept_s as materialized (select * from submissions_v where ({SUBMISSION_REASON}) is null)"


def kept_ids(name: str, condition: str, view: str = "comments_v") -> None:
    ORACLES[name] = with_views(view, f"select id from {view} where {condition}")


kept_ids("drop_tombstones", f"not ({TOMBSTONE})")
kept_ids("min_score", HAS_SCORE)
kept_ids("drop_bots", f"not {BOT}")
kept_ids("length_range", BODY_LENGTH)
kept_ids("drop_links_loose", f"not {LOOSE_LINK}")
kept_ids("drop_links_strict", f"not {STRICT_LINK}", "submissions_v")
kept_ids("drop_gif", f"not {GIF}")
kept_ids(
    "title_body_rule",
    f"length({TITLE}) between 10 and 200 and case when length({SELF}) > 0 "
    f"then length({SELF}) between 20 and 1000 else length({TITLE}) >= 40 end",
    "submissions_v",
)
ORACLES["ascii_flag"] = with_views(
    "comments_v", f"select id, {is_ascii('body')} as is_ascii from comments_v"
)
ORACLES["all_caps"] = with_views(
    "submissions_v",
    f"""select id, {all_caps(TITLE)} as is_all_caps, {letters('title')} as letters,
        {capitals('title')} as capitals from submissions_v""",
)
ORACLES["reject_reason"] = with_views(
    "comments_v submissions_v",
    f"""select id, {COMMENT_REASON} as reason from comments_v
        union all select id, {SUBMISSION_REASON} as reason from submissions_v""",
)
ORACLES["default_values"] = with_views(
    "comments_v submissions_v",
    """select id, coalesce(nullif(subreddit, ''), 'AskReddit') as subreddit, author, score from submissions_v
       union all
       select id, coalesce(subreddit, 'AskReddit'), coalesce(author, 'bot'), coalesce(score, 0) from comments_v""",
)

# --- language model -----------------------------------------------------------


def gram_list(c: str) -> str:
    chars = f"regexp_extract_all(lower({c}), '(?s).')"
    return (
        f"list_transform(range(1, len({chars}) - 1), "
        f"lambda i: substr(lower({c}), i, 3))"
    )


def grams(source: str, key: str, text: str) -> str:
    """(key, gram) per trigram occurrence."""
    return f"""(select {key}, a[i] || a[i + 1] || a[i + 2] as gram from (
        select {key}, a, unnest(range(1, len(a) - 1)) as i from (
            select {key}, regexp_extract_all(lower({text}), '(?s).') as a from {source})))"""


def model(source: str) -> str:
    return f"""
    prof as materialized (select lang, gram, count(*) as n from {grams(source, 'lang', 'text')} group by all),
    class_total as (select lang, sum(n) as total from prof group by lang),
    gram_total as (select count(distinct gram) as v from prof)"""


MODEL = model("documents")


def predict(name: str, source: str, key: str, text: str) -> str:
    """CTEs that end in ``name(key, lang, score)``."""
    return f"""
    {name}_k as (select {key}, gram, count(*) as k from {grams(source, key, text)} group by all),
    {name}_n as (select {key}, sum(k) as total from {name}_k group by {key}),
    {name}_p as (select k.{key}, p.lang, sum(k.k * ln(p.n + 1.0e0)) as s
                 from {name}_k k join prof p on p.gram = k.gram group by all),
    {name}_s as (select n.{key}, c.lang,
                        round(coalesce(p.s, 0) - n.total * ln(c.total + g.v), 6) as score
                 from {name}_n n cross join class_total c cross join gram_total g
                 left join {name}_p p on p.{key} = n.{key} and p.lang = c.lang),
    {name} as materialized (select {key}, lang, score from {name}_s
             qualify row_number() over (partition by {key} order by score desc, lang) = 1)"""


def english(name: str, source: str, text: str, key: str = "id") -> str:
    """CTEs that end in ``name``: the rows of ``source`` that are ASCII or predicted English."""
    return f"""
    {name}_o as (select {key}, {text} as scored from {source} where not {is_ascii(text)}),
    {predict(name + '_l', name + '_o', key, 'scored').strip()},
    {name} as materialized (select * from {source} where {is_ascii(text)}
        or {key} in (select {key} from {name}_l where lang = 'en'))"""


ORACLES["lang_profile"] = (
    f"select lang, gram, count(*) as n from {grams('documents', 'lang', 'text')} group by all"
)
ORACLES["lang_predict"] = (
    f"with {MODEL}, {predict('found', 'documents', 'doc_id', 'text')} "
    "select doc_id, lang, round(score, 2) as score from found"
)
ORACLES["router_accuracy"] = (
    f"with {MODEL}, {predict('found', 'documents', 'doc_id', 'text')} "
    """select count(*) filter (where f.lang = d.lang) as correct, count(*) as total,
       printf('%.1f', 100.0 * count(*) filter (where f.lang = d.lang) / count(*)) as accuracy
       from found f join documents d on d.doc_id = f.doc_id"""
)
ORACLES["english_filter"] = with_ctes(
    "comments_v", MODEL, english("kept", "comments_v", "body"), "select id from kept"
)
ORACLES["english_filter_repeated_ids"] = with_ctes(
    "comments_v",
    MODEL,
    english("kept", "comments_v", "body", "pos"),
    "select 'r' || (pos % 97) as id, body from kept",
)
_PART = f"case when {draw('42-split', 'doc_id')} % 100 < 20 then 'test' else 'train' end"
ORACLES["lang_holdout"] = f"""with train as (select * from documents where {_PART} = 'train'),
    test as (select * from documents where {_PART} = 'test'),
    {model('train')}, {predict('found', 'test', 'doc_id', 'text')}
    select t.lang as expected, f.lang as predicted, count(*) as rows
    from test t join found f on f.doc_id = t.doc_id group by all"""
ORACLES["admit_comments"] = with_ctes(
    "comments_v", MODEL, KEPT_COMMENTS, english("kept", "kept_c", "body"), "select id, score from kept"
)
ORACLES["admit_submissions"] = with_ctes(
    "submissions_v",
    MODEL,
    KEPT_SUBMISSIONS,
    english("kept", "kept_s", COMBINED),
    "select id, score from kept",
)

# --- text functions -----------------------------------------------------------
for _name, _expr in {
    "unescape_entities": unescape("body"),
    "cut_edit": cut_edit("body"),
    "strip_quotes": strip_quotes("body"),
    "strip_gif": strip_gif("body"),
    "strip_ws": strip("body"),
}.items():
    ORACLES[_name] = with_views("comments_v", f"select id, {_expr} as body from comments_v")
ORACLES["squeeze_repeats"] = with_ctes(
    "comments_v", squeeze("sq", "comments_v", "id", "body"), "select id, body from sq"
)
ORACLES["strip_tags"] = f"select page_id, {strip_tags('html')} as text from pages"


def cleaned_comments(name: str, source: str) -> str:
    """CTEs that end in ``name``: ``source`` with cleaned bodies."""
    first = strip_tags(strip_quotes(cut_edit("body")))
    return f"""
    {name}_1 as materialized (select id, {first} as body from {source}),
    {squeeze(name + '_2', name + '_1', 'id', 'body').strip()},
    {name} as materialized (select v.id, v.parent_id, v.link_id, v.subreddit,
             {strip(unescape('x.body'))} as body, v.score
             from {source} v join {name}_2 x on x.id = v.id)"""


def cleaned_submissions(name: str, source: str) -> str:
    """CTEs that end in ``name``: ``source`` with cleaned titles and bodies, checked again."""
    title = strip_tags(strip_quotes(cut_edit("t.title")))
    body = strip(strip_tags(strip_quotes(cut_edit(unescape("x.selftext")))))
    return f"""
    {squeeze(name + '_t', source, 'id', 'title').strip()},
    {squeeze(name + '_x', source, 'id', 'selftext').strip()},
    {name}_u as (select v.id, coalesce(nullif(v.subreddit, ''), 'AskReddit') as subreddit, {title} as title,
             case when v.selftext <> '' then {body} else v.selftext end as selftext, v.score
             from {source} v join {name}_t t on t.id = v.id join {name}_x x on x.id = v.id),
    {name} as materialized (select id, subreddit, {strip('title')} as title, selftext, score
             from {name}_u where length(title) >= 10)"""


ORACLES["clean_comments"] = with_ctes(
    "comments_v", cleaned_comments("cleaned", "comments_v"), "select * from cleaned"
)
ORACLES["clean_submissions"] = with_ctes(
    "submissions_v", cleaned_submissions("cleaned", "submissions_v"), "select * from cleaned"
)
ORACLES["title_recheck"] = with_ctes(
    "submissions_v", cleaned_submissions("cleaned", "submissions_v"), "select id from cleaned"
)
ORACLES["polish_comments"] = with_ctes(
    "comments_v",
    cleaned_comments("cleaned", "comments_v"),
    f"select id, {polish('body')} as body from cleaned where length({polish('body')}) >= 15",
)
ORACLES["stage_counters"] = with_ctes(
    "comments_v",
    cleaned_comments("cleaned", "comments_v"),
    f"""select count(*) as processed, count(*) filter (where ok) as admitted,
        count(*) filter (where ok and length(p) < 15) as dropped,
        count(*) filter (where ok and length(p) >= 15) as kept,
        count(*) filter (where ok and length(p) >= 15 and p <> b) as cleaned
        from (select v.ok, c.body as b, {polish('c.body')} as p
              from (select id, ({COMMENT_REASON}) is null as ok from comments_v) v
              join cleaned c on c.id = v.id)""",
)
for _name, _expr in {
    "normalise_text": normalise("text"),
    "normalise_spaced": normalise_spaced("text"),
    "tokens": f"array_to_string({tokens(normalise('text'))}, '|')",
    "remove_stopwords": f"array_to_string({content_words(normalise('text'))}, ' ')",
    "wrap_tool_call": "'<TOOL_CALL>' || chr(10) || text || chr(10) || '</TOOL_CALL>'",
}.items():
    ORACLES[_name] = f"select doc_id, {_expr} as text from documents"
ORACLES["normaliser_skew"] = with_views(
    "comments_v",
    f"""select count(*) as rows, count(*) filter (
        where {tokens(normalise('body'))} <> {tokens(normalise_spaced('body'))}) as skewed from comments_v""",
)
ORACLES["tool_call_audit"] = with_views(
    "tool_v",
    r"""select id, code, coalesce(regexp_matches(code, '(?m)^\s*(import|from)\s+(os|sys|subprocess)\b'), false) as blocked
        from (select id, case when contains(output, '<TOOL_CALL>')
              then regexp_extract(output, '(?s)<TOOL_CALL>\n(.*?)\n</TOOL_CALL>', 1) end as code from tool_v)""",
)
ORACLES["keyword_flag"] = with_views(
    "labelled_v",
    f"""select conv_id, turn, regexp_matches(lower(text || ' ' || label), '{"|".join(K.TECHNICAL_WORDS)}')
        as technical from labelled_v""",
)

# --- sources and instruction rows ---------------------------------------------
ORACLES["parse_ndjson"] = with_views(
    "props_v",
    """select event_id, ok as is_valid, case when ok then cast(json_extract_string(line, '$.k') as bigint) end as k
       from (select *, json_valid(line) and coalesce(json_type(case when json_valid(line) then line else '{}' end, '$.k'), 'NULL')
             in ('UBIGINT', 'BIGINT', 'NULL') as ok from props_v)""",
)
_DUMPED = f"""select pos, line, case when json_valid(line) then line end as j
    from (select pos, {V.DUCK_DUMP_LINE} as line from comments_v)"""
ORACLES["read_dump"] = with_views(
    "comments_v",
    f"""select json_extract_string(j, '$.id') as id, cast(json_extract_string(j, '$.score') as bigint) as score,
        json_extract_string(j, '$.subreddit') as subreddit from ({_DUMPED}) where j is not null
        qualify row_number() over (partition by json_extract_string(j, '$.id') order by pos desc) = 1""",
)
ORACLES["read_dump_zstd_splits"] = ORACLES["read_dump_gzip_splits"] = ORACLES["read_dump"]
ORACLES["dump_row_counts"] = with_views(
    "comments_v", f"select count(*) as lines, count(j) as good, count(*) - count(j) as rejected from ({_DUMPED})"
)
_ORIGINS = ("documents", "benchmark", "conversations")
ORACLES["multi_source_scan"] = " union all ".join(
    f"select '{t}' as origin, '{t}.parquet' as file, count(*) as rows, cast(sum(length(text)) as bigint) as chars from {t}"
    for t in _ORIGINS
)
LABELLED_TEXT = """(select text, 'general' as category from documents
    union all select text, 'math' from benchmark union all select text, 'code' from conversations)"""
ORACLES["labelled_text"] = f"select * from {LABELLED_TEXT}"
ORACLES["class_distribution"] = f"select category, count(*) as rows from {LABELLED_TEXT} group by category"
ORACLES["head_sample"] = (
    f"select o_orderkey, o_custkey from orders order by o_orderkey limit {K.HEAD_SAMPLE_LINES}"
)
ORACLES["instruct_code"] = with_views(
    "sourced_v",
    f"""select id, {q(K.CODE_SOLUTION_TEXT)} as instruction, instruction as input, output from sourced_v
        union all
        select id, {q(K.CODE_PROMPT_TEXT)},
        {strip("instruction || chr(10) || case when id % 2 = 0 then '' else output end")}, output from sourced_v""",
)
ORACLES["instruct_qa"] = with_views(
    "sourced_v",
    f"select id, {q(K.WORD_PROBLEM_TEXT)} as instruction, instruction as input, output from sourced_v",
)
_SOURCE_ROWS = ", ".join(f"({q(s)}, {q(k)}, {q(i)})" for s, k, i in K.MATH_SOURCES)
MATH = f"""
    known as (select * from (values {_SOURCE_ROWS}) t(src, kind, text)),
    maths as (select s.id, k.kind, k.text as instruction, s.instruction as input,
        case when k.kind = 'PoT' then '<TOOL_CALL>' || chr(10) || s.output || chr(10) || '</TOOL_CALL>'
             else s.output end as output
        from sourced_v s join known k on k.src = {strip('lower(s.source)')})"""
ORACLES["instruct_by_source"] = with_ctes("sourced_v", MATH, "select * from maths")
ORACLES["read_tables"] = with_ctes(
    "sourced_v",
    MATH,
    """select kind || '.jsonl' as origin, count(*) as rows, cast(sum(length(output)) as bigint) as chars
       from maths group by 1
       union all select 'final.jsonl.part2.jsonl', 2 * count(*), cast(2 * sum(length(output)) as bigint) from maths""",
)
ORACLES["write_by_kind"] = with_ctes(
    "sourced_v", MATH, "select kind, count(*) as rows, cast(sum(id) as bigint) as ids from maths group by kind"
)
ORACLES["rewrite_stage"] = with_views(
    "comments_v", f"select id, {polish('body')} as body from comments_v where length({polish('body')}) >= 15"
)
ORACLES["head_lines"] = f"""select '{{"item_id":' || item_id || '}}' as value from benchmark
    order by item_id limit {K.HEAD_SAMPLE_LINES}"""
ORACLES["instruct_source_counts"] = with_ctes(
    "sourced_v",
    MATH,
    f"""select coalesce(k.kind, 'excluded') as kind, count(*) as rows
        from sourced_v s left join known k on k.src = {strip('lower(s.source)')} group by 1""",
)


def chatml(instruction: str, input: str, output: str) -> str:
    def turn(role, c):
        return f"'<|im_start|>{role}' || chr(10) || {c} || '<|im_end|>'"

    return " || chr(10) || ".join(
        [turn("system", instruction), turn("user", input), turn("assistant", output)]
    )


ORACLES["chatml_render"] = with_ctes(
    "sourced_v", MATH, f"select id, {chatml('instruction', 'input', 'output')} as text from maths"
)

# --- pairs --------------------------------------------------------------------
INSTRUCTION = """'You are a user in r/' || coalesce(c.subreddit, 'None') || ', Reply to the given comment' ||
    case when {ctx} is null then '.' else ' in context: ' || {ctx} || '.' end"""
PAIRS = f"""
    com as materialized (select id, parent_id, link_id, subreddit, {polish('body')} as body
            from cc where length({polish('body')}) >= 15),
    pair_c as (select c.id, 'comment' as pair_type, {INSTRUCTION.format(ctx='s.title')} as instruction,
        p.body as input, c.body as output, c.subreddit
        from com c join com p on c.parent_id = 't1_' || p.id
        left join cs s on c.link_id = 't3_' || s.id),
    pair_s as (select c.id, 'submission' as pair_type,
        {INSTRUCTION.format(ctx="case when s.selftext <> '' then s.title end")} as instruction,
        case when s.selftext <> '' then s.selftext else s.title end as input, c.body as output, c.subreddit
        from com c join cs s on c.parent_id = 't3_' || s.id),
    pairs as materialized (select * from pair_c union all select * from pair_s)"""
FORUM = (
    MODEL,
    KEPT_COMMENTS,
    KEPT_SUBMISSIONS,
    english("en_c", "kept_c", "body"),
    english("en_s", "kept_s", COMBINED),
    cleaned_comments("cc", "en_c"),
    cleaned_submissions("cs", "en_s"),
    PAIRS,
)
FORUM_VIEWS = "comments_v submissions_v"
ORACLES["pair_comment_reply"] = with_ctes(FORUM_VIEWS, *FORUM, "select * from pair_c")
ORACLES["pair_submission_reply"] = with_ctes(FORUM_VIEWS, *FORUM, "select * from pair_s")
ORACLES["pair_counts"] = with_ctes(
    FORUM_VIEWS,
    *FORUM,
    "select coalesce(pair_type, 'all') as pair_type, count(*) as pairs from pairs group by rollup (pair_type)",
)
ORACLES["top_sources"] = with_ctes(
    FORUM_VIEWS,
    *FORUM,
    """select subreddit, rows, row_number() over (order by rows desc, subreddit) as rank from (
       select subreddit, count(*) as rows from pairs where subreddit is not null group by 1
       order by rows desc, subreddit limit 100)""",
)
ORACLES["reply_pairs"] = with_ctes(FORUM_VIEWS, *FORUM, "select * from pairs")
ORACLES["latest_by_id"] = """select user_id, event_id, event_type, value from events
    qualify row_number() over (partition by user_id order by event_id desc) = 1"""

# --- counts and profiles ------------------------------------------------------
ORACLES["field_discovery"] = """select field, min(event_id) as first_line,
    arg_min(place, event_id * 1000 + place) as first_place, count(*) as rows from (
    select event_id, unnest(json_keys(props)) as field,
           generate_subscripts(json_keys(props), 1) - 1 as place from events) group by field"""
ORACLES["field_discovery_many"] = with_views(
    "fields_v",
    """select field, min(event_id) as first_line, arg_min(place, event_id * 1000 + place) as first_place,
       count(*) as rows from (select event_id, unnest(json_keys(line)) as field,
           generate_subscripts(json_keys(line), 1) - 1 as place from fields_v) group by field""",
)
ORACLES["field_overlap"] = with_ctes(
    FORUM_VIEWS,
    "a as (select distinct unnest(json_keys(to_json(v))) as f from (select * exclude (pos) from comments_v) v)",
    "b as (select distinct unnest(json_keys(to_json(v))) as f from (select * exclude (pos) from submissions_v) v)",
    """select (select count(*) from a) as left_fields, (select count(*) from b) as right_fields,
       (select count(*) from a join b on a.f = b.f) as common""",
)
ORACLES["row_counts"] = " union all ".join(
    f"select '{t}' as table_name, count(*) as rows from {t}" for t in V.TABLES
)
_COMMENT_TYPES = {
    "id": "string", "parent_id": "string", "link_id": "string", "subreddit": "string",
    "author": "string", "score": "bigint", "body": "string", "pos": "bigint",
}
ORACLES["frame_profile"] = with_views(
    "comments_v",
    " union all ".join(
        f"select '{c}' as column_name, '{t}' as data_type, count(*) as rows, count({c}) as non_null from comments_v"
        for c, t in _COMMENT_TYPES.items()
    ),
)
ORACLES["mix_report"] = """select source, count(*) as rows,
    round(count(*) / (sum(count(*)) over ()), 6) as share from documents group by source"""

# --- sampling -----------------------------------------------------------------


def hash_rank(key: str, seed: str = "42", by: str = "") -> str:
    return f"row_number() over ({by} order by md5('{seed}|' || {key}), {key})"


ORACLES["seeded_shuffle"] = f"select o_orderkey, o_orderpriority, {hash_rank('o_orderkey')} as rank from orders"
ORACLES["sample_exact"] = f"""select o_orderkey, o_orderpriority, {hash_rank('o_orderkey')} as rank
    from orders qualify rank <= 5000"""
ORACLES["cap_rows"] = """select event_id, user_id, row_number() over (order by event_id) as rank
    from events where event_type = 'purchase' qualify rank <= 1000"""
ORACLES["cap_per_source"] = f"""select event_id, event_type,
    {hash_rank('event_id', by='partition by event_type')} as rank from events qualify rank <= 1000"""
ORACLES["balance_classes"] = f"""with r as (select doc_id, quality,
        {hash_rank('doc_id', by='partition by quality')} as rank from labels),
    n as (select quality, count(*) as n from labels group by quality),
    d as (select quality, n, unnest(range(200)) as draw from n)
    select r.doc_id, d.quality, d.draw from d join r on r.quality = d.quality
    and r.rank = case when d.n >= 200 then d.draw + 1
        else {draw('42-up', 'd.quality', 'd.draw')} % d.n + 1 end"""
ORACLES["train_test_split"] = f"""select o_orderkey, o_orderpriority,
    case when {draw('42-split', 'o_orderkey')} % 100 < 20 then 'test' else 'train' end as part from orders"""
ORACLES["mixture_sample"] = f"""with s as (select event_id, case event_type when 'click' then 'forum'
        when 'view' then 'code' when 'purchase' then 'PoT' when 'error' then 'CoT' end as stratum from events),
    r as (select *, {hash_rank('event_id', by='partition by stratum')} as rank from s where stratum is not null)
    select event_id, stratum, rank from r
    where rank <= case stratum when 'forum' then 900 when 'code' then 300 else 150 end"""


def _filled(rounds: int) -> str:
    """CTEs ``q0 .. q<rounds>``: quotas by share, where sources with no more rows than that are closed in turn."""
    out = ["q0 as (select ord, stratum, share, have, null::bigint as taken, null::bigint as quota from base)"]
    for k in range(rounds):
        out.append(f"""a{k} as (select *, (select n from total) - coalesce(sum(taken) over (), 0) as room,
                sum(share) filter (taken is null) over () as whole from q{k}),
            b{k} as (select *, room * share // whole as part, room * share % whole as rest from a{k} where taken is null),
            c{k} as (select *, part + (row_number() over (order by rest desc, ord) <= room - sum(part) over ())::int as given from b{k}),
            q{k + 1} as (select ord, stratum, share, have, case when given >= have then have end as taken, given as quota from c{k}
                union all select ord, stratum, share, have, taken, taken from a{k} where taken is not null)""")
    return ",\n".join(out)


_STRATA = ", ".join(f"({i}, '{n}', {s})" for i, (n, s) in enumerate(K.MIX_PERCENT))
ORACLES["mixture_with_short_sources"] = f"""with total as (select count(*) // 2 as n from documents),
    shares(ord, stratum, share) as (values {_STRATA}),
    s as (select doc_id, stratum from documents join shares on ord = doc_id * 7 % 10 % 4 where doc_id % 11 > 0),
    base as (select ord, stratum, share, (select count(*) from s where s.stratum = shares.stratum) as have from shares),
    {_filled(5)},
    r as (select *, {hash_rank('doc_id', by='partition by stratum')} as rank from s)
    select doc_id, r.stratum, rank from r join q5 on q5.stratum = r.stratum where rank <= quota"""
_CAPS = {"maths": ("click", K.MATH_CAP), "code": ("view", K.CODE_CAP), "word_problems": ("purchase", K.WORD_PROBLEM_CAP)}
ORACLES["capped_sources"] = " union all ".join(
    f"""select '{n}' as origin, count(*) as rows, max(event_id) as last from (
        select event_id from events where event_type = '{t}' order by event_id limit {cap})"""
    for n, (t, cap) in _CAPS.items()
)
ORACLES["merge_sources"] = """select text, lang, null::bigint as item_id, null::varchar as role, 'documents' as origin from documents
    union all select text, null, item_id, null, 'benchmark' from benchmark
    union all select text, null, null, role, 'conversations' from conversations"""

# --- features -----------------------------------------------------------------


def words(normalised: str) -> str:
    return f"words as materialized (select doc_id, {content_words(normalised)} as w from documents)"


SPACED_WORDS = words(normalise_spaced("text"))
VOCAB_COUNTS = "counts as (select t as term, count(*) as tf from (select unnest(w) as t from words) group by 1)"
VOCAB = f"""vocab as materialized (select term, row_number() over (order by tf desc, term) + 1 as idx, tf
    from (select * from counts order by tf desc, term limit {K.MAX_VOCABULARY - 2}))"""
ORACLES["vocab_counts"] = f"with {SPACED_WORDS}, {VOCAB_COUNTS} select * from counts"
ORACLES["vocab_index"] = f"""with {SPACED_WORDS}, {VOCAB_COUNTS}, {VOCAB}
    select term, idx, tf from vocab union all select '<PAD>', 0, 0 union all select '<UNK>', 1, 0"""
ORACLES["encode_sequences"] = f"""with {SPACED_WORDS}, {VOCAB_COUNTS}, {VOCAB},
    head as (select doc_id, unnest(w[1:{K.SEQUENCE_LENGTH}]) as t,
             generate_subscripts(w[1:{K.SEQUENCE_LENGTH}], 1) as p from words),
    ids as (select doc_id, p, coalesce(idx, 1) as id from head left join vocab on term = t),
    slots as (select doc_id, unnest(range(1, {K.SEQUENCE_LENGTH + 1})) as p from documents)
    select doc_id, string_agg(coalesce(id, 0), ' ' order by p) as ids
    from slots left join ids using (doc_id, p) group by doc_id"""
PLAIN_WORDS = words(normalise("text"))
NGRAMS = f"""
    {PLAIN_WORDS},
    unigrams as (select doc_id, regexp_extract_all(array_to_string(w, ' '), '[a-z0-9]{{2,}}') as u from words),
    terms as materialized (select doc_id, list_concat(list_concat(u,
        list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1])),
        list_transform(range(1, len(u) - 1), lambda i: u[i] || ' ' || u[i + 1] || ' ' || u[i + 2])) as t from unigrams)"""
TOP_TERMS = f"""vocab as materialized (select term, count(*) as tf from (select unnest(t) as term from terms)
    group by term order by tf desc, term limit {K.MAX_VOCABULARY})"""
ORACLES["stemmed_words"] = """select c_custkey, stem || ' custom buy' as stems from customer
    join (values ('MACHINERY', 'machineri'), ('BUILDING', 'build'), ('AUTOMOBILE', 'automobil'),
          ('FURNITURE', 'furnitur'), ('HOUSEHOLD', 'household')) t(segment, stem) on segment = c_mktsegment"""
ORACLES["idf_table"] = f"""with {PLAIN_WORDS},
    d as (select term, count(distinct doc_id) as df from (select doc_id, unnest(w) as term from words) group by term),
    n as (select count(*) as n from documents)
    select term, df, round(ln((1.0e0 + n) / (1.0e0 + df)) + 1.0e0, 6) as idf from d, n"""
ORACLES["ngram_terms"] = f"with {NGRAMS} select doc_id, len(t) as n, array_to_string(t, '|') as terms from terms"
ORACLES["tfidf_vocab"] = f"with {NGRAMS}, {TOP_TERMS} select term, tf from vocab"
ORACLES["tfidf_weights"] = f"""with {NGRAMS}, {TOP_TERMS},
    f as (select doc_id, t.term, count(*) as tf from (select doc_id, unnest(t) as term from terms) t
          join vocab v on v.term = t.term group by all),
    d as (select term, count(*) as df from f group by term),
    n as (select count(*) as n from documents),
    w as (select doc_id, f.term, f.tf * (ln((1.0e0 + n) / (1.0e0 + df)) + 1.0e0) as w
          from f join d on d.term = f.term, n)
    select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as w from w"""
ORACLES["label_encode"] = with_views(
    "labelled_v",
    f"""select conv_id, turn, l as label, dense_rank() over (order by l) - 1 as code
        from (select conv_id, turn, {strip('upper(label)')} as l from labelled_v)""",
)
ORACLES["router_confusion"] = with_views(
    "labelled_v",
    "select upper(trim(label)) as expected, upper(trim(predicted)) as predicted, count(*) as rows from labelled_v group by 1, 2",
)
_ROUTER_PART = f"case when {draw('42-split', 'row_id')} % 100 < 20 then 'test' else 'train' end"
ORACLES["router_split"] = f"""select category, {_ROUTER_PART} as part, count(*) as rows from (
    select 'documents|' || doc_id as row_id, 'general' as category from documents
    union all select 'benchmark|' || item_id, 'math' from benchmark
    union all select 'conversations|' || conv_id || '|' || turn, 'code' from conversations) group by all"""
ORACLES["eval_rows"] = with_views(
    "labelled_v",
    """select conv_id, turn, case when p = e then '[PASS] ' || pre || ' -> ' || p
       else '[FAIL] ' || pre || ' -> Pred: ' || p || ' | Exp: ' || e end as line
       from (select conv_id, turn, upper(predicted) as p, upper(trim(label)) as e,
             rpad(substr(text, 1, 30), 30, ' ') as pre from labelled_v)""",
)

# --- conversations ------------------------------------------------------------
DIALOGUE = "dlg as (select * from {source} where role <> 'system')"
LINE = "upper(role[1]) || role[2:] || ': ' || text"
ORACLES["last_n_messages"] = f"""with {DIALOGUE.format(source='conversations')}
    select conv_id, turn, role, row_number() over (partition by conv_id order by turn desc) as age
    from dlg qualify age <= 10"""
ORACLES["render_history"] = f"""with {DIALOGUE.format(source='conversations')},
    r as (select *, {LINE} as line from dlg
          qualify row_number() over (partition by conv_id order by turn desc) <= 4)
    select conv_id, string_agg(line, chr(10) order by turn) as joined,
           string_agg(line, chr(10) order by turn) || chr(10) as terminated from r group by conv_id"""
ORACLES["last_n_history"] = f"""with {DIALOGUE.format(source='conversations')},
    m as (select *, {LINE} as line, row_number() over (partition by conv_id order by turn) as rn from dlg)
    select u.conv_id, u.turn, coalesce(string_agg(h.line, chr(10) order by h.turn), '') as ctx
    from m u left join m h on h.conv_id = u.conv_id and h.rn < u.rn and h.rn >= u.rn - 4
    where u.role = 'user' group by u.conv_id, u.turn"""
ORACLES["budget_history"] = f"""with {DIALOGUE.format(source='conversations')},
    m as (select conv_id, turn, cast(sum(length({LINE}) + 1) over (partition by conv_id order by turn desc
          rows between unbounded preceding and current row) as bigint) as from_newest from dlg)
    select conv_id, turn, from_newest from m where from_newest <= 2048 - 200 - 512"""


def context(source: str) -> str:
    """CTEs that end in ``ctx(conv_id, turn, ctx)``: the budgeted history of user messages."""
    return f"""
    {DIALOGUE.format(source=source)},
    m as (select conv_id, turn, role, text, {LINE} || chr(10) as line from dlg),
    p as (select *, length(line) as cost, sum(length(line)) over (partition by conv_id order by turn
          rows between unbounded preceding and current row) as cum from m),
    u as (select conv_id, turn, 2048 - (200 + length(text) + 512) as budget, cum - cost as before
          from p where role = 'user'),
    j as (select u.conv_id, u.turn, h.turn as ht, h.line from u left join p h on h.conv_id = u.conv_id
          and h.turn < u.turn and u.before - (h.cum - h.cost) <= u.budget and u.budget > 0),
    ctx as (select conv_id, turn, coalesce(string_agg(line, '' order by ht), '') as ctx
            from j group by conv_id, turn)"""


ORACLES["history_context"] = f"with {context('conversations')} select * from ctx"
ORACLES["strip_reasoning"] = with_views(
    "thinking_v",
    f"""select conv_id, turn, case when role = 'assistant'
        then {strip("regexp_replace(text, '(?s)<think>.*?</think>', '', 'g')")} else text end as text
        from thinking_v""",
)
_TEMPLATE = ForumTemplate()


def forum_prompt(forum: str, ctx: str) -> str:
    head = _TEMPLATE.persona.split("{forum}")
    tail = _TEMPLATE.context_tail.split("{context}")
    name = f"coalesce(nullif({forum}, ''), 'AskReddit')"
    with_ctx = f"{q(tail[0])} || nullif({ctx}, '') || {q(tail[1])}"
    return f"({q(head[0])} || {name} || {q(head[1])} || coalesce({with_ctx}, {q(_TEMPLATE.tail)}))"


def technical(route: str, profile: str) -> str:
    return (
        f"case {route} when 'MATH' then {q(K.MATH_PROMPTS[profile])} "
        f"when 'CODE' then {q(K.CODE_PROMPT_TEXT)} end"
    )


def temperature(route: str, profile: str) -> str:
    low, high = K.TEMPERATURES[profile]
    return f"case when {route} in ('MATH', 'CODE') then {low}e0 else {high}e0 end"


_ROUTE_COLUMNS = ", ".join(
    f"{temperature('route', p)} as temperature_{p}, "
    f"coalesce({technical('route', p)}, {forum_prompt('null', 'null')}) as prompt_{p}"
    for p in K.TEMPERATURES
)
ORACLES["route_prompt"] = with_views(
    "labelled_v",
    f"""select conv_id, turn, route, {_ROUTE_COLUMNS}
        from (select conv_id, turn, upper(trim(label)) as route from labelled_v)""",
)
ORACLES["forum_prompt"] = with_views(
    "labelled_v", f"select conv_id, turn, {forum_prompt('forum', 'context')} as prompt from labelled_v"
)
_TOPICS = [t for t, _ in K.FORUM_BY_TOPIC] + ["OTHER"]
ORACLES["topic_forum"] = f"""select doc_id, ' ' || lower(t) as topic,
    case t {" ".join(f"when '{t}' then '{f}'" for t, f in K.FORUM_BY_TOPIC)} else 'AskReddit' end as forum
    from (select doc_id, {V.case('doc_id % 7', _TOPICS)} as t from documents)"""
_FLAGS = ("latex", "mcq", "code", "explain", "comments", "asymptote")
ORACLES["math_prompt"] = f"""select *, case
    when mcq then {q(K.MCQ_TEXT)} when asymptote then {q(K.ASYMPTOTE_TEXT)}
    when not code and latex and explain then {q(K.LATEX_TEXT)}
    when not code and not latex and explain then {q(K.PLAIN_TEXT)}
    when code and not latex and not explain and not comments then {q(K.PYTHON_BARE_TEXT)}
    when code and not latex and not explain and comments then {q(K.PYTHON_COMMENTED_TEXT)}
    when not code and latex and not explain then {q(K.DETAILED_PLAIN_TEXT)}
    else {q(K.DEFAULT_MATH_TEXT)} end as prompt
    from (select doc_id, {", ".join(f"(h >> {i}) % 2 = 1 as {n}" for i, n in enumerate(_FLAGS))}
          from (select doc_id, {draw('flags', 'doc_id')} as h from documents))"""


def last_lines(source: str, n: int) -> str:
    """CTEs that end in ``ctx(conv_id, turn, ctx)``: the last ``n`` lines before user messages."""
    return f"""
    {DIALOGUE.format(source=source)},
    m as (select *, {LINE} as line, row_number() over (partition by conv_id order by turn) as rn from dlg),
    ctx as (select u.conv_id, u.turn, coalesce(string_agg(h.line, chr(10) order by h.turn), '') as ctx
        from m u left join m h on h.conv_id = u.conv_id and h.rn < u.rn and h.rn >= u.rn - {n}
        where u.role = 'user' group by u.conv_id, u.turn)"""


def requests(profile: str, history: str, system: str) -> str:
    return with_ctes(
        "labelled_v",
        history,
        """req as (select l.conv_id, l.turn, upper(trim(l.label)) as route, l.forum, l.text, c.ctx
            from labelled_v l join ctx c on c.conv_id = l.conv_id and c.turn = l.turn)""",
        f"""select conv_id, turn, route, {temperature('route', profile)} as temperature, 0 as place, 'system' as role,
            {system} as content from req
            union all
            select conv_id, turn, route, {temperature('route', profile)}, 1, 'user', text from req""",
    )


ORACLES["build_messages"] = requests(
    "v2", context("labelled_v"), f"coalesce({technical('route', 'v2')}, {forum_prompt('forum', 'ctx')})"
)
ORACLES["build_messages_v1"] = requests(
    "v1", last_lines("labelled_v", 2 * K.MAX_TURNS), f"coalesce({technical('route', 'v1')}, {forum_prompt('forum', 'ctx')})"
)
ORACLES["build_messages_reasoning"] = requests(
    "reasoning",
    context("labelled_v"),
    f"""coalesce({technical('route', 'reasoning')}, {forum_prompt('forum', "''")})
        || coalesce(chr(10) || chr(10) || 'CONTEXT:' || chr(10) || nullif(ctx, ''), '')""",
)
ORACLES["cleaned_history"] = with_ctes(
    "thinking_v",
    f"""stored as (select conv_id, turn, role, case when role = 'assistant'
        then {strip("regexp_replace(text, '(?s)<think>.*?</think>', '', 'g')")} else text end as text from thinking_v)""",
    context("stored"),
    "select * from ctx",
)

# --- generated rows -----------------------------------------------------------


def pick(tag: str, n: int, *keys: str) -> str:
    return f"({draw(tag, *keys)} % {n})"


def fill(template: str, **slots: str) -> str:
    for slot, value in slots.items():
        template = f"replace({template}, '{{{slot}}}', {value})"
    return template


def arithmetic(key: str, largest: int, operators, templates, seed: str) -> str:
    return fill(
        V.case(pick(f"{seed}-t", len(templates), key), templates),
        a=f"({pick(f'{seed}-a', largest, key)} + 1)::varchar",
        op=V.case(pick(f"{seed}-op", len(operators), key), operators),
        b=f"({pick(f'{seed}-b', largest, key)} + 1)::varchar",
    )


def snippet(key: str, seed: str) -> str:
    def option(tag, options):
        return V.case(pick(f"{seed}-{tag}", len(options), key), options)

    return fill(
        option("t", K.SNIPPET_TEMPLATES),
        lib=option("lib", K.SNIPPET_LIBRARIES),
        table=option("table", K.SNIPPET_VARIABLES),
        var=option("var", K.SNIPPET_VARIABLES),
        func=q(K.SNIPPET_FUNCTION),
    )


ORACLES["synth_arithmetic"] = f"""select o_orderkey,
    {arithmetic('o_orderkey', 100, K.TRAINER_OPERATORS, K.TRAINER_TEMPLATES, 'arith')} as input from orders"""
_FORMS = " union all ".join(
    f"select o_orderkey, {arithmetic('o_orderkey', 1000, K.SEQUENCE_OPERATORS, (t,), 'forms')} as input, {i} as form from orders"
    for i, t in enumerate(K.SEQUENCE_TEMPLATES)
)
ORACLES["synth_arithmetic_forms"] = _FORMS


def sentence(templates, seed: str) -> str:
    chosen = V.case(pick(f"{seed}-t", len(templates), "keyword", "round"), templates)
    return f"""case when {pick(f'{seed}-bare', 100, 'keyword', 'round')} < {K.BARE_KEYWORD_PERCENT}
        then keyword else {fill(chosen, keyword='keyword')} end"""


ORACLES["synth_templates"] = f"""with n as (select keyword, unnest(range({K.KEYWORD_ROUNDS})) as round
        from (select distinct p_name as keyword from part))
    select keyword, round, 'bare' as kind, keyword as text, 'math' as origin from n
    union all select keyword, round, 'bare', keyword, 'code' from n
    union all select keyword, round, 'generated', {sentence(K.MATH_KEYWORD_TEMPLATES, 'keyword')}, 'math' from n
    union all select keyword, round, 'generated', {sentence(K.CODE_KEYWORD_TEMPLATES, 'code')}, 'code' from n"""
ORACLES["synth_snippets"] = f"select p_partkey, {snippet('p_partkey', 'snippet')} as input from part"
ORACLES["repeat_phrases"] = (
    f"select item_id, text, unnest(range({K.PHRASE_REPEATS})) as copy from benchmark"
)
ORACLES["word_dropout"] = f"""with w as (select doc_id, text, {draw('drop', 'doc_id')} as h,
        list_filter(regexp_split_to_array(text, '\\s'), lambda x: x <> '') as w from documents),
    d as (select *, (h // 100) % len(w) as gone from w)
    select doc_id, case when len(w) < 3 then text
        when h % 100 < {K.WORD_DROP_PERCENT} then array_to_string(list_concat(w[1:gone], w[gone + 2:len(w)]), ' ')
        else array_to_string(w, ' ') end as text from d"""
TEST_SET = f"""rows as (
    select 'g' || item_id as row_id, 'general' as category, text as input from benchmark
    union all select 'm' || p_partkey, 'math',
        {arithmetic('p_partkey', 1000, K.SEQUENCE_OPERATORS, K.TEST_TEMPLATES, 'test-math')} from part
    union all select 'c' || p_partkey, 'code', {snippet('p_partkey', 'test-code')} from part)"""
ORACLES["build_test_set"] = f"with {TEST_SET} select *, {hash_rank('row_id')} as rank from rows"
ORACLES["training_text"] = with_ctes(
    FORUM_VIEWS + " sourced_v",
    *FORUM,
    MATH,
    f"""merged as (select 'forum|' || id as row_key, instruction, input, output from (
            select *, {hash_rank('id')} as r from pairs) where r <= 300
        union all select 'maths|' || id, instruction, input, output from maths)""",
    f"""select row_key, {hash_rank('row_key')} as rank, {chatml('instruction', 'input', 'output')} as text
        from merged""",
)


# --- streams give what the batch gives ------------------------------------------
ORACLES["stream_clean"] = with_ctes(
    "comments_v",
    f"asc_c as (select * from comments_v where {COMMENT_REASON} is null and {is_ascii('body')})",
    cleaned_comments("cc", "asc_c"),
    "select * from cc",
)
ORACLES["stream_route"] = ORACLES["route_prompt"]
ORACLES["stream_latest_by_id"] = ORACLES["latest_by_id"]
ORACLES["stream_late_history"] = f"""with {DIALOGUE.format(source='conversations')},
    m as (select *, {LINE} as line, row_number() over (partition by conv_id order by turn) as rn from dlg)
    select u.conv_id, u.turn, coalesce(string_agg(h.line, chr(10) order by h.turn), '') as history
    from m u left join m h on h.conv_id = u.conv_id and h.rn < u.rn and h.rn >= u.rn - {2 * K.MAX_TURNS}
    where u.role = 'user' group by u.conv_id, u.turn"""


def _layer(layer: int, source: str, units: list[str]) -> str:
    """The next layer's values as columns."""
    sizes = V.FIXED_SIZES
    sums = [
        " + ".join(f"{u} * ({V.fixed_weight(layer, i, j)})" for i, u in enumerate(units)) + f" + ({V.fixed_weight(layer, -1, j)})"
        for j in range(sizes[layer + 1])
    ]
    last = layer == len(sizes) - 2
    columns = [f"{s} as z{j}" if last else f"greatest({s}, 0) as h{layer}{j}" for j, s in enumerate(sums)]
    return f"select doc_id, {', '.join(columns)} from {source}"


_SHARES = ", ".join(f"len(regexp_extract_all(lower(coalesce(text, '')), '{c}')) / greatest(length(lower(coalesce(text, ''))), 1) as x{i}" for i, c in enumerate(V.LETTERS))
ORACLES["score_network"] = f"""with x as (select doc_id, {_SHARES} from documents),
    one as ({_layer(0, 'x', [f'x{i}' for i in range(6)])}),
    two as ({_layer(1, 'one', [f'h0{i}' for i in range(4)])}),
    out as ({_layer(2, 'two', [f'h1{i}' for i in range(3)])})
    select doc_id, case when z0 >= z1 and z0 >= z2 then 'a' when z1 >= z2 then 'b' else 'c' end as label,
        round(exp(greatest(z0, z1, z2)) / (exp(z0) + exp(z1) + exp(z2)), 6) as confidence from out"""
ORACLES["read_labelled_text"] = ORACLES["labelled_text"]
