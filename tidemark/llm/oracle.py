"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import chat, line_dedup, merkle, mtree, secrets, vectors
from tidemark.llm.queries import CONTROL

OP1 = f"""
with line as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
    from documents
), pair as (
    select doc_id, i, line || chr(10) || lead(line) over (partition by doc_id order by i) as two
    from line
), placed as (
    select doc_id, i, min((doc_id, i)) over (partition by two) as first from pair where two is not null
), hit as (
    select doc_id, i, first[1] as src, i - first[2] as away from placed
    where first[1] <> doc_id or i >= first[2] + {line_dedup.WINDOW}
), run as (
    select *, i - row_number() over (partition by doc_id, src, away order by i) as run from hit
), chunk as (
    select doc_id, src, away, run, min(i) as start, max(i) + {line_dedup.WINDOW - 1} as stop from run group by all
), passage as (
    select c.doc_id, c.src, c.away, c.run, any_value(start) as start, any_value(stop) as stop
    from chunk c join line l on l.doc_id = c.doc_id and l.i between c.start and c.stop
    group by all
    having sum(len(regexp_extract_all(' ' || regexp_replace(l.line, '{line_dedup.BLANK}', '  ', 'g') || ' ', '{line_dedup.WORD}')))
               >= {line_dedup.LEAST_WORDS}
        or sum(length(regexp_replace(l.line, '{line_dedup.OTHER}', '', 'g'))) >= {line_dedup.LEAST_LETTERS}
), marked as (
    select l.doc_id, l.i, l.line, exists (select 1 from passage p where p.doc_id = l.doc_id and l.i between p.start and p.stop) as gone
    from line l
), rebuilt as (
    select doc_id, coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '') as text,
           count(*) filter (where gone) as removed
    from marked group by doc_id
)
select doc_id, removed as removed_lines, length(text) as n_chars, sha256(text) as text_sha256 from rebuilt
"""


def _located(kind: str, pattern: str, value: str) -> str:
    return f"""
{kind}_match as (
    select doc_id, unnest(regexp_extract_all(body, '{pattern}', 0)) as whole, {value} as value,
           unnest(regexp_split_to_array(body, '{pattern}')[:len(regexp_extract_all(body, '{pattern}', 0))]) as gap,
           generate_subscripts(regexp_extract_all(body, '{pattern}', 0), 1) as i
    from body
), {kind}_at as (
    select doc_id, whole, value, i,
           (sum(length(gap) + length(whole)) over (partition by doc_id order by i))::bigint as stop
    from {kind}_match
)"""


def _op3() -> str:
    assign = secrets.ASSIGN.replace("'", "''")
    allowed = " or ".join(f"regexp_matches(whole, '{p}')" for p in secrets.ALLOWED)
    weights = ", ".join(str(secrets.weight(c)) for c in range(secrets.WINDOW + 1))
    whole = "unnest(regexp_extract_all(body, '{}', 0))"
    return f"""
with body as (select doc_id, coalesce(text, '') as body from documents),
{_located("assign", assign, f"unnest(regexp_extract_all(body, '{assign}', 2))")},
{_located("access", secrets.ACCESS, whole.format(secrets.ACCESS))},
{_located("hex", secrets.HEX, whole.format(secrets.HEX))},
{_located("run", secrets.CANDIDATE, whole.format(secrets.CANDIDATE))},
base as (
    select doc_id, 'assign' as kind, 0 as rank, stop - length(whole) as start, stop from assign_at
    where length(value) >= {secrets.ASSIGN_VALUE}
    union all select doc_id, 'access', 1, stop - length(whole), stop from access_at
    union all select doc_id, 'hex', 2, stop - length(whole), stop from hex_at
), candidate as (
    select doc_id, whole, stop - length(whole) as start, regexp_matches(whole, '{secrets.ALL_HEX}') as hex
    from run_at where regexp_matches(whole, '[0-9]') and regexp_matches(whole, '[A-Za-z]') and not ({allowed})
), slid as (
    select *, unnest(range(0, length(whole) - {secrets.WINDOW} + 1)) as k from candidate
), letter as (
    select doc_id, start, hex, k, unnest(string_split(substr(whole, k + 1, {secrets.WINDOW}), '')) as c from slid
), counted as (
    select doc_id, start, hex, k, c, count(*) as n from letter group by all
), windows as (
    select doc_id, start, hex, k, sum(([{weights}])[n + 1]) as total from counted group by all
), added as (
    select doc_id, case when hex then 'entropy_hex' else 'entropy_base64' end as kind, case when hex then 3 else 4 end as rank,
           start + min(k) as start, start + max(k) + {secrets.WINDOW} as stop
    from windows
    where total <= case when hex then {secrets.limit(secrets.BITS["entropy_hex"])}
                        else {secrets.limit(secrets.BITS["entropy_base64"])} end
    group by doc_id, hex, windows.start
), spans as (
    select * from base
    union all
    select * from added a
    where not exists (select 1 from base b where b.doc_id = a.doc_id and b.start <= a.start and b.stop >= a.stop)
), named as (
    select *, kind || ':' || start || ':' || stop as name from spans
), summed as (
    select doc_id,
           count(*) filter (where kind = 'assign') as n_assign,
           count(*) filter (where kind = 'access') as n_access,
           count(*) filter (where kind = 'hex') as n_hex,
           string_agg(name, ',' order by start, rank) filter (where rank < 3) as base,
           string_agg(name, ',' order by start, rank) as spans
    from named group by doc_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join summed using (doc_id)
"""


_ESCAPED = "replace(replace({}, '\\', '\\\\'), '<|', '<\\|')"
_SIGNS = len(chat.START) + len(chat.END) + 2
OP10 = f"""
with turn as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')
), spoken as (
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
           coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '') as loss,
           sum({_SIGNS} + length(replace({_ESCAPED.format("role")}, chr(10), '\\n')) + length({_ESCAPED.format("text")}))::bigint
               as formatted_chars
    from turn group by conv_id
)
select conv_id, n_turns, turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, formatted_chars from spoken
"""


OP11 = f"""
with v as (
    select distinct vec_id, list_transform(embedding, lambda c: floor({vectors.SCALE} * c::double)) as x from embeddings
    where embedding is not null and vec_id is not null
      and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
    from v q join v c on q.vec_id % {mtree.EVERY} = 0 and c.vec_id <> q.vec_id
), ranked as (
    select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= {mtree.TOP}
"""

#: Levels of the two trees that the SQL goes up: more than enough for the tables it runs on.
LEVELS = {"leaf": 7, "top": 3}
#: One bit at a time, with the reversed polynomial.
_CRC32 = (
    "xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint), "
    "lambda crc, c: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda r, z: xor(r >> 1, 3988292384 * (r & 1)), xor(crc, c)), 4294967295::bigint), 4294967295)"
)


def _levels(name: str, levels: int) -> str:
    """Nodes n, their neighbours in the run, and one level up; a level of one node stays as it is."""
    parts = []
    for level in range(levels):
        parts.append(f"""{name}_beside{level} as (
    select g, pos, m, h,
           coalesce(string_agg(h, '') over (partition by g, pos // {merkle.FAN} order by pos rows between unbounded preceding and 1 preceding), '') as before,
           coalesce(string_agg(h, '') over (partition by g, pos // {merkle.FAN} order by pos rows between 1 following and unbounded following), '') as after
    from {name}{level}
), {name}{level + 1} as (
    select g, pos // {merkle.FAN} as pos, (max(m) + {merkle.FAN - 1}) // {merkle.FAN} as m,
           case when max(m) = 1 then min(h) else sha256(string_agg(h, '' order by pos)) end as h
    from {name}{level} group by g, pos // {merkle.FAN}
)""")
    return ", ".join(parts)


def _climb(name: str, levels: int, source: str, carried: str) -> str:
    """Each row's digest folded level by level, its siblings appended to its proof."""
    parts = []
    for level in range(levels):
        before = f"{name}_path{level - 1}" if level else source
        parts.append(f"""{name}_path{level} as (
    select {carried}, p.pos // {merkle.FAN} as pos, proof || before || after as proof,
           case when n.m = 1 then folded else sha256(before || folded || after) end as folded
    from {before} p join {name}_beside{level} n on n.g = p.g and n.pos = p.pos
)""")
    return ", ".join(parts)


def _op13() -> str:
    def leaf(text: str) -> str:
        fields = {name: f"{name}::varchar" for name in merkle.FIELDS} | {"text": text}
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in fields.values()) + ")"

    low = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    return f"""
with doc as (
    select doc_id, coalesce('v' || lang, 'n') as g, {leaf("text")} as h,
           case when {_CRC32} % 3 = 0 then {leaf(low)} end as changed
    from documents
), placed as (
    select *, row_number() over (partition by g order by doc_id nulls first, h) - 1 as pos, count(*) over (partition by g) as m
    from doc
), leaf0 as (select g, pos, m, h from placed),
{_levels("leaf", LEVELS["leaf"])},
subroot as (select g, h from leaf{LEVELS["leaf"]}),
top0 as (select '' as g, row_number() over (order by g) - 1 as pos, count(*) over () as m, h, g as name from subroot),
{_levels("top", LEVELS["top"])},
start as (
    select doc_id, g, pos, h as leaf, '' as proof, coalesce(changed, h) as folded from placed
),
{_climb("leaf", LEVELS["leaf"], "start", "p.doc_id, p.g, p.leaf")},
up as (
    select p.doc_id, '' as g, p.leaf, p.proof, p.folded, t.pos, t.h as subroot
    from leaf_path{LEVELS["leaf"] - 1} p join top0 t on t.name = p.g
),
{_climb("top", LEVELS["top"], "up", "p.doc_id, p.g, p.leaf, p.subroot")}
select doc_id, leaf, subroot, r.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = r.h as verified
from top_path{LEVELS["top"] - 1}, (select h from top{LEVELS["top"]}) r
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1,
        "op3_secrets": _op3(),
        "op10_chat": OP10,
        "op11_top_vectors": OP11,
        "op13_merkle": _op13(),
    }
