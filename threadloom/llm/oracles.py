"""The numbered queries that SQL can express, for DuckDB."""

from threadloom.llm import licenses, quality
from threadloom.llm.decontaminate import WINDOW
from threadloom.llm.lsh_forest import SHINGLE, THRESHOLD
from threadloom.llm.warc import MIN_PAYLOAD

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}')"


OP3 = f"""
with p as (
    select page_id, url, coalesce(html, '') as html from pages
), d as (
    select page_id, url, octet_length(encode(html)) as payload_bytes, sha256(html) as payload_digest from p
), f as (
    select payload_digest, min(page_id) as first_page from d where payload_bytes >= {MIN_PAYLOAD} group by 1
)
select d.page_id, payload_bytes::BIGINT as payload_bytes, d.payload_digest,
       case when f.first_page is null or f.first_page = d.page_id then 'response' else 'revisit' end as record_type,
       case when f.first_page <> d.page_id then f.first_page end as refers_to, coalesce(url, '') as url
from d left join f on f.payload_digest = d.payload_digest
"""

OP6 = f"""
with recursive w as (
    select text, min(doc_id) as copy_id, {_words('text')} as words from documents where text is not null group by text
), sh as (
    select distinct copy_id, list_slice(words, i, least(i + {SHINGLE} - 1, len(words))) as s
    from (select copy_id, words, unnest(range(1, greatest(len(words) - {SHINGLE} + 1, 1) + 1)) as i from w where len(words) > 0)
), n as (
    select copy_id, count(*) as n from sh group by 1
), pairs as (
    select a.copy_id as a, b.copy_id as b, count(*) as c from sh a join sh b on a.s = b.s and a.copy_id <> b.copy_id group by 1, 2
), linked as (
    select a, b from pairs join n x on x.copy_id = a join n y on y.copy_id = b where c::double / (x.n + y.n - c) >= {THRESHOLD}
), links as (
    select a, count(*) as n_links from linked group by 1
), near as (
    select a, b from linked union select near.a, linked.b from near join linked on linked.a = near.b
), classes as (
    select a, min(b) as class_id from near group by 1
)
select d.doc_id, coalesce(classes.class_id, w.copy_id, d.doc_id) as class_id, coalesce(n_links, 0)::BIGINT as n_links,
       coalesce(w.copy_id, d.doc_id) as copy_id
from documents d left join w on w.text = d.text left join links on links.a = w.copy_id left join classes on classes.a = w.copy_id
"""


def _distance(p: str, q: str) -> str:
    """The divergence term of one bin, in bits; the square root of the sum is the distance."""
    m = f"(({p}) + ({q})) / 2"
    term = lambda x: f"case when ({x}) > 0 then ({x}) * log2(({x}) / ({m})) else 0 end"
    return f"({term(p)} + {term(q)}) / 2"


_CLASSES = [
    "[^a-z]", "[^A-Z]", "[^0-9]", r"[^ \t\n\x0B\x0C\r]", r"[^#*$%&|<>]", r"""[^.,;:''"\-()]""", "[^!?]",
    r"[^\x00-\x08\x0E-\x1F/=@\[\\\]^_`{}~+\x7F]",
]

OP8 = f"""
with d as (
    select doc_id, coalesce(text, '') as text, lang from documents
), w as (
    select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words,
           [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as lines
    from d
), win as (
    select doc_id, i, list_slice(words, i, i + 2) as s from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)
), often as (
    select doc_id, s from win group by 1, 2 having count(*) > 1
), hit as (
    select doc_id, count(distinct i + k) as n
    from (select win.doc_id, i, unnest([0, 1, 2]) as k from win join often using (doc_id, s)) group by 1
), base as (
    select w.doc_id, w.lang, w.text, len(words)::BIGINT as n_words,
           length(array_to_string(words, ''))::BIGINT as word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT as n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT as n_dup_lines,
           coalesce(hit.n, 0)::BIGINT as n_repeat_words
    from w left join hit using (doc_id)
), b as (
    select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed from base
), ch as (
    select doc_id, lang, base_failed, unnest(range(1, 10)) as k, unnest(c) as n from (
        select *, list_append(c9, octet_length(encode(text)) - list_sum(c9)::BIGINT) as c from (
            select doc_id, lang, base_failed, text, [{', '.join(f"length(regexp_replace(text, '{x}', '', 'g'))" for x in _CLASSES)}] as c9 from b))
), terms as (
    select doc_id, lang, base_failed, unnest({_words('text')}) as word from b
), bag as (
    select doc_id, word, count(*) as n from terms group by 1, 2
), total as (
    select doc_id, sum(n) as n from bag group by 1
), lw as (
    select lang, word, count(*) as n from terms where not base_failed group by 1, 2
), lt as (
    select lang, sum(n) as total from lw group by 1
), large as (
    select * from lt where total >= {quality.LANGUAGE_WORDS} and lang is not null
), ref as (
    select lang, word, n / total as q from lw join large using (lang) where n >= {quality.WORD_SHARE} * total
), refc as (
    select lang, k, sum(n) / sum(sum(n)) over (partition by lang) as q from ch join large using (lang) where not base_failed group by 1, 2
), size as (
    select doc_id, sum(n) as n from ch group by 1
), cd as (
    select doc_id, sqrt(greatest(0, sum({_distance('ch.n / size.n', 'refc.q')}))) as v
    from ch join size using (doc_id) join refc using (lang, k) where size.n > 0 group by 1
), pw as (
    select total.doc_id, ref.lang, q, coalesce(bag.n, 0) / total.n as p
    from total join b using (doc_id) join ref using (lang) left join bag on bag.doc_id = total.doc_id and bag.word = ref.word
), pr as (
    select * from pw union all select doc_id, lang, 1 - sum(q), 1 - sum(p) from pw group by 1, 2
), wd as (
    select doc_id, sqrt(greatest(0, sum({_distance('greatest(p, 0)', 'greatest(q, 0)')}))) as v from pr group by 1
), best as (
    select b.doc_id, cd.v as c, case when large.lang is not null and n_words > 0 then coalesce(wd.v, 1) end as w
    from b left join cd using (doc_id) left join wd using (doc_id) left join large on large.lang = b.lang
)
select b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not coalesce(n_words >= {quality.CHAR_MIN_WORDS} and c > {quality.CHAR_LIMIT}, false)
       and not coalesce(n_words >= {quality.WORD_MIN_WORDS} and w > least({quality.WORD_MOST}e0, {quality.WORD_FLOOR}e0 + {quality.WORD_NOISE}e0 / sqrt(n_words)), false) as kept
from b join best using (doc_id)
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_KNOWN = ", ".join(f"({_text(t)}, {_text(n)})" for t, n in licenses.KNOWN.items())
_RULES = ", ".join(f"({_text(n)}, {_text(licenses.pattern(ids))})" for n, ids in licenses.RULES)
_REPLACES = ", ".join(f"({_text(a)}, {_text(b)})" for a, b in licenses.REPLACES.items())

OP9 = rf"""
with known(sentence, id) as (values {_KNOWN}), rules(name, pattern) as (values {_RULES}),
replaces(long, short) as (values {_REPLACES}),
low as (
    select doc_id, regexp_replace(regexp_replace(lower(coalesce(text, '')), {_text(licenses.MARKS)}, '', 'g'),
        {_text(licenses.OPENINGS)}, '. \1', 'g') as low from documents
), cuts as (
    select doc_id, 1 as cut, regexp_split_to_array(low, {_text(licenses.PARAGRAPHS)}) as s from low
    union all select doc_id, 2, regexp_split_to_array(low, {_text(licenses.LINES)}) from low
), sentences as (
    select doc_id, cut, unnest(s) as sentence, generate_subscripts(s, 1) as place from (
        select doc_id, cut, [y for y in [trim(regexp_replace(x, {_text(licenses.SPACE)}, ' ', 'g')) for x in s] if y <> ''] as s from cuts)
), sizes as (
    select doc_id, count(*) as n_sentences from sentences where cut = 1 group by 1
), found as (
    select doc_id, cut, place, id from sentences join known using (sentence)
), lists as (
    select doc_id, cut, list(id order by place) as ids, ' ' || string_agg(id, '  ' order by place) || ' ' as line from found group by 1, 2
), names as (
    select distinct doc_id, name from lists join rules on regexp_matches(line, pattern)
), kept as (
    select * from names n where not exists (
        select 1 from names m join replaces r on m.name = r.long where m.doc_id = n.doc_id and r.short = n.name)
), licences as (
    select doc_id, string_agg(name, ',' order by name) as licenses from kept group by 1
), later as (
    select doc_id, id, min(place) as place from found f where cut = 2
    and not exists (select 1 from found g where g.doc_id = f.doc_id and g.cut = 1 and g.id = f.id) group by 1, 2
), ids as (
    select doc_id, string_agg(id, ',' order by cut, place) as sentence_ids
    from (select doc_id, cut, place, id from found where cut = 1 union all select doc_id, 2, place, id from later) group by 1
)
select d.doc_id, coalesce(n_sentences, 0)::BIGINT as n_sentences, coalesce(sentence_ids, '') as sentence_ids,
       coalesce(licenses, '') as licenses
from documents d left join sizes using (doc_id) left join ids using (doc_id) left join licences using (doc_id)
"""

OP10 = f"""
with d as (
    select doc_id, {_words('text')} as words from documents
), items as (
    select item_id, {_words('text')} as words from benchmark
), phrases as (
    select distinct item_id, list_slice(words, i, i + {WINDOW} - 1) as p, least(len(words), {WINDOW}) as n
    from (select item_id, words, unnest(range(1, greatest(len(words) - {WINDOW} + 1, 1) + 1)) as i from items where len(words) > 0)
), sizes as (
    select distinct n from phrases
), win as (
    select doc_id, i, n, list_slice(words, i, i + n - 1) as p
    from (select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as i from d cross join sizes)
), hits as (
    select distinct doc_id, i, win.n, item_id from win join phrases on win.p = phrases.p
), places as (
    select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from hits) group by 1
), found as (
    select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
    from (select distinct doc_id, item_id::varchar as id from hits) group by 1
)
select d.doc_id, len(words)::BIGINT as n_words, coalesce(n_hit, 0)::BIGINT as n_hit, coalesce(n_items, 0)::BIGINT as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (doc_id) left join found using (doc_id)
"""

OP11 = """
with v as (
    select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           [floor(256 * x::DOUBLE) for x in embedding] as e
    from embeddings
    where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), s as (
    select a.r as ar, a.vec_id as anchor_id, b.r, b.vec_id, a.label = b.label as same, list_inner_product(a.e, b.e)::BIGINT as score
    from v a join v b on a.r <> b.r where a.vec_id % 100 = 0
), p as (
    select * from (
        select *, row_number() over (partition by ar order by score desc, vec_id nulls last, r) as k from s where same
    ) where k <= 5
), n as (
    select p.anchor_id, p.vec_id as positive_id, p.score as positive_score, s.vec_id as negative_id, s.score as negative_score,
           row_number() over (partition by p.ar, p.r order by s.score desc, s.vec_id nulls last) as rank
    from p join s on s.ar = p.ar and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score
)
select anchor_id, positive_id, rank::INTEGER as rank, negative_id, positive_score, negative_score from n where rank <= 5
"""

_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(conv_id::VARCHAR, '')]),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                               lambda x, i: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)))"""

OP13 = rf"""
with own as (
    select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                         order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
    from conversations where conv_id is not null group by 1
), heads as (
    select conv_id, turns, {_CRC32} % 4 as h from own
), built as (
    select c.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, h), list_slice(c.turns, h + 1, len(c.turns))) as turns
    from heads c left join own b on b.conv_id = c.conv_id - c.conv_id % 20
), nodes as (
    select d, p, min(conv_id) as conv_id, count(*) as n_convs,
           case when d = 0 then 0 else (count(*) - 1) * len(regexp_extract_all(p[d].text, '[^ 	-
]+')) end as saved
    from (select conv_id, d, list_slice(turns, 1, d) as p from (select *, unnest(range(len(turns) + 1)) as d from built)) group by 1, 2
), kids as (
    select d - 1 as d, list_slice(p, 1, d - 1) as p, count(*) as n from nodes where d > 0 group by 1, 2
), counted as (
    select nodes.*, coalesce(n, 0) as n_children from nodes left join kids using (d, p)
), below as (
    select e as d, list_slice(p, 1, e) as p, sum((n_children = 0)::INT) as n_leaves, sum(saved) as saved_tokens
    from (select *, unnest(range(d + 1)) as e from counted) group by 1, 2
), ends as (
    select turns as p, string_agg(conv_id, ',' order by conv_id) as ids from built group by 1
)
select c.conv_id, c.d::BIGINT as depth, f.conv_id as parent_conv_id, c.n_convs::BIGINT as n_convs, c.n_children::BIGINT as n_children,
       n_leaves::BIGINT as n_leaves, saved_tokens::BIGINT as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from counted c join below using (d, p) left join ends on ends.p = c.p
left join nodes f on f.d = c.d - 1 and f.p = list_slice(c.p, 1, c.d - 1)
"""

ORACLES = {
    "op3_warc": OP3,
    "op6_ngram_jaccard": OP6,
    "op8_quality_rules": OP8,
    "op9_license_scan": OP9,
    "op10_decontamination": OP10,
    "op11_hard_negatives": OP11,
    "op13_prefix_trie": OP13,
}
