"""DuckDB SQL of the operators that SQL can express, for the registered queries."""

from __future__ import annotations

import re

from . import mixing, personal, secrets
from .licenses import NEUTRAL, RULES, SENTENCES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM words WHERE len(w) > 0) x
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), digest AS (
  SELECT doc_id, n, md5(string_agg(md5(CAST(s AS VARCHAR)), ',' ORDER BY md5(CAST(s AS VARCHAR)))) AS d FROM shingle JOIN size USING (doc_id) GROUP BY doc_id, n
), class AS (
  SELECT d, any_value(n) AS n, min(doc_id) AS head FROM digest GROUP BY d
), own AS (
  SELECT c.head, c.n, s.s FROM class c JOIN shingle s ON s.doc_id = c.head
), link AS (
  SELECT a.head AS x, b.head AS y FROM own a JOIN own b ON a.s = b.s AND a.head < b.head AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.head, b.head, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), ways AS (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach(x, y) AS (
  SELECT head, head FROM class UNION SELECT r.x, b.y FROM reach r JOIN ways b ON b.x = r.y
), least AS (
  SELECT x AS head, min(y) AS root FROM reach GROUP BY x
)
SELECT w.doc_id, coalesce(g.n, 0) AS n_shingles, coalesce(l.root, w.doc_id) AS component_id, coalesce(l.root, w.doc_id) = w.doc_id AS kept
FROM words w LEFT JOIN digest g USING (doc_id) LEFT JOIN class c ON c.d = g.d LEFT JOIN least l ON l.head = c.head
"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

CONTAMINATION = f"""
WITH doc AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark
), item_window AS (
  SELECT DISTINCT item, list_slice(w, i, i + 9) AS win
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0) x
), width AS (
  SELECT DISTINCT len(win) AS n FROM item_window
), doc_window AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, width WHERE len(w) >= n) x
), hit AS (
  SELECT d.doc_id, d.i, d.n, t.item FROM doc_window d JOIN item_window t USING (win)
), word_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) x GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hit) x GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN word_hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _licenses() -> str:
    """Identifiers are written ``|Name,`` so that a rule can only start at one."""
    ids = " ".join(f"WHEN regexp_full_match(s, {_quoted(p)}) THEN '{n}'" for n, p in SENTENCES)
    steps, last = [], "start"
    for k, (name, pattern) in enumerate(RULES):
        marked = re.sub(r"([A-Z][A-Za-z0-9]+),", r"\\|\1,", pattern)
        steps.append(
            f"r{k} AS (SELECT row, regexp_replace(rest, {_quoted(marked)}, '|-,', 'g') AS rest, "
            f"CASE WHEN regexp_matches(rest, {_quoted(marked)}) THEN list_append(names, '{name}') ELSE names END AS names FROM {last})"
        )
        last = f"r{k}"
    neutral = ", ".join(f"'{n}'" for n in ("", "-", *NEUTRAL))
    return f"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, string_split_regex(lower(coalesce(text, '')), '[\\r\\n]+|[.!?;:]+(\\s|$)') AS pieces FROM documents
), plain AS (
  SELECT row, doc_id, list_transform(pieces, lambda s: trim(regexp_replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(s, '[^a-z0-9.]+', ' ', 'g'), '([0-9])[.]([0-9])', '\\1#\\2', 'g'), '([0-9])[.]([0-9])', '\\1#\\2', 'g'),
    '.', ' '), '#', '.'), ' +', ' ', 'g'))) AS sentences FROM doc
), named AS (
  SELECT row, doc_id, list_filter(list_transform(sentences, lambda s: CASE {ids} END), lambda x: x IS NOT NULL) AS ids FROM plain
), start AS (
  SELECT row, list_aggregate(list_transform(ids, lambda x: '|' || x || ','), 'string_agg', '') AS rest, CAST([] AS VARCHAR[]) AS names
  FROM named WHERE len(ids) > 0
), {", ".join(steps)}
SELECT n.doc_id, len(n.ids) AS n_sentences, array_to_string(n.ids, ',') AS sentence_ids,
       coalesce(array_to_string(list_filter(r.names, lambda x, i: list_position(r.names, x) = i), ','), '') AS licenses,
       coalesce(len(list_filter(string_split(replace(r.rest, '|', ''), ','), lambda x: x NOT IN ({neutral}))) > 0, FALSE) AS unknown
FROM named n LEFT JOIN {last} r USING (row)
"""


LICENSES = _licenses()


_DOCS = "SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents"


def _hits(number: int, pattern: str, value: str = "", where: str = "TRUE") -> str:
    """Matches ``m`` of a pattern with their start in code points, from the lengths of the
    matches and of the texts between them. ``value``: list of what the matches stand for."""
    p = _quoted(pattern)
    return f"""SELECT r, {number} AS k, h.m AS m, h.v AS v, h.s AS s, h.s + length(h.m) AS e, t FROM (
  SELECT r, t, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{'m': ms[i], 'v': vs[i],
    's': CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT)}})) AS h
  FROM (SELECT r, t, regexp_extract_all(t, {p}) AS ms, {value or f'regexp_extract_all(t, {p})'} AS vs, string_split_regex(t, {p}) AS gaps
        FROM doc WHERE regexp_matches(t, {p})) y) x WHERE {where}"""


_DIGITS = "regexp_replace(h.m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE
  WHEN (length({_DIGITS}) - i) % 2 = 0 THEN CAST({_DIGITS}[i] AS INT)
  WHEN CAST({_DIGITS}[i] AS INT) > 4 THEN 2 * CAST({_DIGITS}[i] AS INT) - 9 ELSE 2 * CAST({_DIGITS}[i] AS INT) END)) % 10 = 0"""
_ACCOUNT = "replace(h.m, ' ', '')"
_MOD97 = f"""list_reduce(list_prepend(0, list_transform(string_split({_ACCOUNT}[5:] || {_ACCOUNT}[:4], ''),
  lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE CAST(c AS INT) END)), lambda a, d: (a * (CASE WHEN d > 9 THEN 100 ELSE 10 END) + d) % 97) = 1"""


def _near(words: tuple[str, ...]) -> str:
    before = f"substr(t, CAST(greatest(h.s - {personal.NEAR}, 0) AS BIGINT) + 1, CAST(least(h.s, {personal.NEAR}) AS BIGINT))"
    return f"list_has_any(regexp_extract_all(lower({before}), '[a-z]+'), [{', '.join(map(_quoted, words))}])"


PERSONAL = f"""
WITH doc AS ({_DOCS}), hit AS (
  {_hits(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+")}
  UNION ALL {_hits(1, r"[0-9]+(?:[.][0-9]+){3}", where="regexp_full_match(h.m, '(0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])([.]|$)){4}')")}
  UNION ALL {_hits(2, r"[0-9](?:[ -]?[0-9])+", where=f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}")}
  UNION ALL {_hits(3, r"[+][0-9][ ().0-9-]+[0-9]", where=f"length({_DIGITS}) BETWEEN 9 AND 15")}
  UNION ALL {_hits(4, personal._IBAN.pattern, where=_MOD97)}
  UNION ALL {_hits(5, personal._SOCIAL.pattern, where=f"{_near(personal.FOR['social'])} AND NOT {_near(personal.AGAINST)}")}
), named AS (
  SELECT r, k, s, [{", ".join(map(_quoted, personal.KINDS))}][k + 1] || ':' || s || ':' || e AS span FROM hit
), told AS (
  SELECT r, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone,
    string_agg(span, ',' ORDER BY k, s) FILTER (k < {personal.BASE}) AS base, string_agg(span, ',' ORDER BY k, s) AS spans
  FROM named GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN told USING (r)
"""


def _either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


_ASSIGN = f"(?:{_either_case('password|passwd|secret|token|api_?key')})[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)"
_LIVE = f"""length(v) >= 8 AND list_sum(list_transform(list_distinct(string_split(v, '')), lambda c:
  -(length(v) - length(replace(v, c, ''))) / length(v) * log2((length(v) - length(replace(v, c, ''))) / length(v)))) >= {secrets.LIVE_BITS}"""

SECRETS = f"""
WITH doc AS ({_DOCS}), hit AS (
  {_hits(0, _ASSIGN, value=f"regexp_extract_all(t, {_quoted(_ASSIGN)}, 1)", where=f"length(h.v) >= {secrets.LEAST_VALUE}")}
  UNION ALL {_hits(1, "AKIA[A-Z0-9]+", where=f"length(h.m) >= {secrets.LEAST_ACCESS}")}
  UNION ALL {_hits(2, "[0-9a-f]+", where=f"length(h.m) >= {secrets.LEAST_HEX}").replace("'[0-9a-f]+'", "'[0-9a-f]{24,}'")}
  {" ".join("UNION ALL " + _hits(k, p.pattern, value=f"regexp_extract_all(t, {_quoted(p.pattern)}, {g})") for k, p, g in secrets._MORE)}
), owned AS (
  SELECT h.v, count(DISTINCT coalesce('+' || d.source, '')) AS owners FROM hit h JOIN doc d USING (r) GROUP BY h.v
), named AS (
  SELECT r, k, s, [{", ".join(map(_quoted, secrets.KINDS))}][k + 1] || ':' || s || ':' || e AS span,
         CASE WHEN owners > {secrets.MAX_OWNERS} THEN 'example' WHEN {_LIVE.replace("(v", "(h.v")} THEN 'live' ELSE 'weak' END AS verdict
  FROM hit h JOIN owned o ON h.v = o.v
), told AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(span, ',' ORDER BY s, k) FILTER (k < {secrets.BASE}) AS base, string_agg(span, ',' ORDER BY s, k) AS spans,
    count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example, count(*) FILTER (verdict = 'weak') AS n_weak
  FROM named GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(n_weak, 0) AS n_weak
FROM doc LEFT JOIN told USING (r)
"""


#: For sources whose weights lose less than one slot each by rounding down, as any do that
#: have at least a slot in the period.
MIXING = f"""
WITH RECURSIVE held AS (
  SELECT source, count(*) AS c FROM documents GROUP BY source
), wish AS (
  SELECT source, pow(c, {mixing.TEMPERATURE}) / (SELECT sum(pow(c, {mixing.TEMPERATURE})) FROM held) * greatest({mixing.PERIOD}, 4 * (SELECT count(*) FROM held)) AS exact FROM held
), base AS (
  SELECT source, exact, greatest(1, CAST(floor(exact) AS INT)) AS n, greatest({mixing.PERIOD}, 4 * (SELECT count(*) FROM held)) AS period FROM wish
), share AS (
  SELECT source, period, row_number() OVER (ORDER BY source NULLS LAST) AS rank,
    n + CASE WHEN row_number() OVER (ORDER BY n - exact, source NULLS LAST) <= period - (SELECT sum(n) FROM base) THEN 1 ELSE 0 END AS n
  FROM base
), slots AS (
  SELECT list(n ORDER BY rank) AS ns, any_value(period) AS period FROM share
), edf(slot, pick, nth, done) AS (
  SELECT CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), list_transform(ns, lambda x: CAST(0 AS BIGINT)) FROM slots
  UNION ALL
  SELECT slot + 1, p, done[p], list_transform(range(1, len(done) + 1), lambda i: done[i] + CASE WHEN i = p THEN 1 ELSE 0 END)
  FROM (SELECT slot, done, list_sort(list_filter(list_transform(range(1, len(ns) + 1), lambda i:
          [CAST(((done[i] + 1) * period + ns[i] - 1) // ns[i] AS BIGINT), i, CAST(done[i] * period // ns[i] AS BIGINT), CAST(ns[i] - done[i] AS BIGINT)]),
          lambda x: x[3] <= slot + 1 AND x[4] > 0))[1][2] AS p
        FROM edf, slots WHERE slot + 1 < period) x
), plan AS (
  SELECT e.slot, s.source, s.n, s.period, e.nth, e.nth * s.period // s.n AS release, ((e.nth + 1) * s.period + s.n - 1) // s.n AS deadline
  FROM edf e JOIN share s ON s.rank = e.pick
), numbered AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 10), doc_id) - 1 AS i FROM documents
)
SELECT d.doc_id, d.source, d.i // {mixing.BLOCK} AS mix_block,
       CAST(d.i // {mixing.BLOCK} // p.n * p.period + p.slot AS BIGINT) AS mix_slot,
       CAST(d.i // {mixing.BLOCK} // p.n * p.period + p.release AS BIGINT) AS mix_release,
       CAST(d.i // {mixing.BLOCK} // p.n * p.period + p.deadline AS BIGINT) AS mix_deadline, d.i % {mixing.BLOCK} AS mix_place
FROM numbered d JOIN plan p ON p.source IS NOT DISTINCT FROM d.source AND p.nth = (d.i // {mixing.BLOCK}) % p.n
"""
