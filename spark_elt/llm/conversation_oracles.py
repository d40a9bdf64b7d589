"""DuckDB SQL for the operators on conversations."""

from __future__ import annotations

#: CRC-32 of ASCII texts: the table of its bytes (to be joined), and a fold over characters.
_CRC_TABLE = """crc_table as (
  select list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1), i)) as t)"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)"""


# ---------------------------------------------------------------- repair: a step by step search over the rows


def _way(state: int, cost: str, letter: str, row: str | None = None) -> str:
    s = f"acc[{state + 1}]"
    rows = f"list_append({s}.r, {row})" if row else f"{s}.r"
    return f"{{'c': {s}.c + ({cost}), 'a': {s}.a || {letter}, 'r': {rows}}}"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _insert(state: int, role: str) -> str:
    return _way(state, "3", "'I'", f"'{role}:'")


def _edit(state: int, initial: str, role: str) -> str:
    """The row becomes the one that the pattern expects after ``state``."""
    fits = f"x.role[1] = '{initial}'"
    way = _way(state, f"if({fits}, 0, 3) + if(x.truncated, 3, 0)", f"if({fits}, 'K', 'R')", f"if({fits}, x.role, '{role}') || ':' || x.text")
    return f"if(x.gone, {_NONE}, {way})"


_NONE = "{'c': 1000000000::bigint, 'a': '', 'r': []::varchar[]}"
_KEPT = _way(0, "if(x.truncated, 3, 0)", "'K'", "x.role || ':' || x.text")
_KEEP_SYSTEM = f"if(x.gone or x.role[1] <> 's', {_NONE}, {_KEPT})"
_BEFORE_USER = _least("acc[3]", _insert(0, "user"), _insert(1, "user"), _insert(3, "user"))
_INSERTIONS = f"[acc[1], acc[2], {_BEFORE_USER}, acc[4]]"
_MORE = f"[acc[1], acc[2], acc[3], {_least('acc[4]', _insert(2, 'assistant'))}]"
_DELETE = [_way(s, "4", "'D'") for s in range(4)]
_ROW = "[" + ", ".join([
    _DELETE[0],
    _least(_DELETE[1], _KEEP_SYSTEM),
    _least(_DELETE[2], *(_edit(s, "u", "user") for s in (0, 1, 3))),
    _least(_DELETE[3], _edit(2, "a", "assistant")),
]) + "]"

REPAIR = f"""
with {_CRC_TABLE},
named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as harm
  from conversations, crc_table),
damaged as (
  select conv_id, turn, if(harm = 4, 'user', role) as role,
    case harm when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(if(harm = 3, [0, 1], [0])) as copy
  from named where harm <> 0),
placed as (
  select *, sha256(strlen(role)::varchar || ':' || role || text) as id,
    row_number() over (partition by conv_id order by turn nulls first, sha256(strlen(role)::varchar || ':' || role || text)) as i
  from damaged),
faults as (
  select *, not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank,
    row_number() over (partition by conv_id, role, text order by i) > 1 as seen,
    not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') as cut,
    lag(role[1]) over (partition by conv_id order by i) as before
  from placed),
judged as (
  select *, seen and not blank as duplicate, cut and not blank and not seen as truncated, blank or seen as gone from faults),
steps as (
  select conv_id, flatten(list([
      {{'kind': 'i', 'role': '', 'text': '', 'gone': false, 'truncated': false}},
      {{'kind': 'j', 'role': '', 'text': '', 'gone': false, 'truncated': false}},
      {{'kind': 'r', 'role': role, 'text': text, 'gone': gone, 'truncated': truncated}}] order by i)) as steps,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
    count(*) filter (before || role[1] not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id),
searched as (
  select *, list_reduce(list_concat(steps, [
      {{'kind': 'i', 'role': '', 'text': '', 'gone': false, 'truncated': false}},
      {{'kind': 'j', 'role': '', 'text': '', 'gone': false, 'truncated': false}}]),
    lambda acc, x: case x.kind when 'i' then {_INSERTIONS} when 'j' then {_MORE} else {_ROW} end,
    [{{'c': 0::bigint, 'a': '', 'r': []::varchar[]}}, {_NONE}, {_NONE}, {_NONE}]) as found
  from steps),
best as (select *, list_min([found[1], found[4]]) as b from searched),
ids as (select distinct conv_id from conversations)
select ids.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(b.c, 0) as cost, coalesce(b.a, '') as audit,
  sha256(coalesce(array_to_string(b.r, chr(10)), '')) as repaired_sha256
from ids left join best on ids.conv_id is not distinct from best.conv_id
"""


# ---------------------------------------------------------------- trie: every prefix a row

TRIE = f"""
with {_CRC_TABLE},
rows as (
  select conv_id, turn, sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as id,
    strlen(coalesce(text, '')) as size
  from conversations where conv_id is not null),
own as (
  select conv_id, list({{'id': id, 'size': size}} order by turn nulls first, id, size) as turns,
    {_crc("conv_id::varchar")} % 9 as h
  from rows, crc_table group by conv_id, t),
rebuilt as (
  select own.conv_id, list_concat(coalesce(lead.turns[1:own.h], []), own.turns[own.h + 1:]) as turns
  from own left join own as lead on lead.conv_id = own.conv_id - own.conv_id % 5),
prefixes as (
  select conv_id, depth, sha256(array_to_string(list_transform(turns[1:depth], lambda x: x.id), ',')) as key,
    if(depth = 0, null, sha256(array_to_string(list_transform(turns[1:depth - 1], lambda x: x.id), ','))) as parent,
    coalesce(turns[depth].size, 0) as size, len(turns) = depth as ends
  from (select *, unnest(range(len(turns) + 1)) as depth from rebuilt)),
nodes as (
  select depth, key, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from prefixes group by depth, key),
children as (select depth - 1 as depth, parent, count(*) as n from nodes group by all),
counted as (
  select nodes.*, coalesce(children.n, 0) as n_children
  from nodes left join children on children.depth = nodes.depth and children.parent = nodes.key),
above as (
  select p.depth, p.key, sum((n.n_convs - 1) * n.size)::bigint as saved_tokens, count(*) filter (n.n_children = 0) as n_leaves
  from counted n join prefixes p on p.conv_id = n.conv_id and p.depth <= n.depth group by p.depth, p.key)
select c.conv_id, c.depth, up.conv_id as parent_conv_id, c.n_convs, c.n_children, a.n_leaves, a.saved_tokens, c.ends_sha256
from counted c join above a on a.depth = c.depth and a.key = c.key
left join nodes up on up.depth = c.depth - 1 and up.key = c.parent
"""
