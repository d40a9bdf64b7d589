"""Personal data: patterns propose spans, checksums confirm them, words nearby score them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the span digest; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "social")
BASE = 4

# Fixed patterns of the base kinds. Those that could read a long run again from each of
# its characters are written from the run's start, which finds the same spans.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Added kinds. An account's pattern takes what may follow it as well; see _accounts.
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b", re.A)
_SOCIAL = re.compile(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", re.A)

#: Length of the account numbers of each country.
ACCOUNT_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18,
    "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23,
    "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Words that raise (or lower) the score of a span when they stand within NEAR characters before it.
FOR = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "social": ("ssn", "social", "security"),
}
AGAINST = ("example", "sample", "test", "version", "order", "invoice", "isbn")
NEAR = 40
_WORD = re.compile(r"[a-z]+")
#: Score of a bare match, of a confirmed checksum, and of a word for or against.
BARE, CONFIRMED, WORD = 0.5, 0.3, 0.2
_CHECKED = {"card", "iban"}


def luhn(digits: str) -> bool:
    """Whether the digits' Luhn sum is a multiple of ten."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number (country, check digits, number) leaves 1 modulo 97."""
    plain = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    over = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > over and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < m.start():
            yield start, m.end()
            over = m.end()


def _account_end(text: str, start: int, end: int) -> int:
    """End of the account number at the start of a match, or -1: where its country's length
    ends, or else at the end of the match or, for countries not known, of any of its words."""
    known = ACCOUNT_LENGTH.get(text[start : start + 2])
    ends, n = [], 0
    for at in range(start, end):
        n += text[at] != "\x20"
        if text[at] != "\x20" and (at + 1 == end or text[at + 1] == "\x20") and n >= 15:
            ends.append((n, at + 1))
    tried = [e for k, e in ends if k == known] + [e for _, e in reversed(ends)][: 1 if known else None]
    return next((e for e in tried if mod97(text[start:e])), -1)


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """A match takes in words after the account number, and may begin before it; it is at
    most 67 characters long, so looking again at each word keeps the time linear."""
    at = 0
    while m := _IBAN.search(text, at):
        end = _account_end(text, m.start(), m.end())
        if end >= 0:
            yield m.start(), end
        at = end if end >= 0 else m.start() + 1


def _small(part: str) -> bool:
    plain = part.lstrip("0")
    return len(plain) <= 3 and int(plain or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find(text: str) -> list[tuple[int, int, int]]:
    """(number of the kind, start, end) of the confirmed spans, in that order."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    out += [(4, s, e) for s, e in _accounts(text)]
    out += [(5, m.start(), m.end()) for m in _SOCIAL.finditer(text) if score(text, "social", m.start()) > BARE]
    return out


def score(text: str, kind: str, start: int) -> float:
    """How sure a span is, from its checksum and the words before it."""
    words = set(_WORD.findall(text[max(0, start - NEAR) : start].lower()))
    near = WORD * bool(words.intersection(FOR[kind])) - WORD * bool(words.intersection(AGAINST))
    return round(BARE + CONFIRMED * (kind in _CHECKED) + near, 2)


_NAMES = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_iban", "n_social", "scores"]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: tuple[list[int], ...] = tuple([] for _ in KINDS)
        sha, spans, scores = [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            hits = find(text)
            for k, column in enumerate(counts):
                column.append(sum(h[0] == k for h in hits))
            named = [f"{KINDS[k]}:{s}:{e}" for k, s, e in hits]
            n = sum(h[0] < BASE for h in hits)
            sha.append(hashlib.sha256(",".join(named[:n]).encode()).hexdigest())
            spans.append(",".join(named))
            scores.append(",".join(f"{x}:{score(text, KINDS[k], s):g}" for x, (k, s, _) in zip(named, hits, strict=True)))
        ints = [pa.array(c, pa.int64()) for c in counts]
        texts = [pa.array(c, pa.string()) for c in (sha, spans)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *ints[:BASE], *texts, *ints[BASE:], pa.array(scores, pa.string())], _NAMES)


def personal_data(docs: DataFrame) -> DataFrame:
    """Personal data in each text.

    ``docs`` needs ``doc_id`` and ``text``. Returns one row per input row: ``doc_id``,
    ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256`` (their
    ``kind:start:end`` by kind, then start), ``spans`` (all kinds likewise), ``n_iban``,
    ``n_social`` and ``scores`` (``kind:start:end:score``). Spans count code points.

    Cards must pass Luhn, account numbers modulo 97 (at their country's length, so words
    after them do not hide them); a social security number counts
    only with a word for it nearby. A null text counts as empty: no spans, the digest of
    the empty string. Repeated rows each get a row; an empty table gives none. One pass,
    no shuffle; every pattern reads a text in time linear in its length.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join(f"{n} {kind if n == 'doc_id' else 'long' if n[:2] == 'n_' else 'string'}" for n in _NAMES)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_scan, schema)
