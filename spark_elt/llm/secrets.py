"""Secret scans with corpus-wide ownership frequency.

Patterns propose candidates in each text. The hash of a candidate's value is then
counted over the corpus by the distinct repositories and owners that hold it: a value
that several owners have is a widely copied example, one that a single owner has, and
that looks random, is a live-looking credential of that owner.

Values themselves do not leave the scan; hashes are counted in steps (per owner and
repository, per owner, over all), each aggregated before its shuffle, so a value that
is in a third of all documents is as cheap as any other.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Kinds in the order of the span digest; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "token", "signed", "login", "private_key")
BASE = 3

# Fixed patterns and least lengths of the base kinds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run that is long enough is found whole at its start
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# Added kinds: prefixed service tokens, signed web tokens, logins in addresses, key blocks.
# The SQL reads all four; the scan reads web tokens by _signed, the last two whole, as
# _LOGIN and by _key_blocks.
_MORE = (
    (3, re.compile(r"\b(?:gh[oprsu]_|glpat-|xox[abprs]-|sk_live_)[A-Za-z0-9_-]{16,}", re.A), 0),
    (4, re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0),
    (5, re.compile(r"://[^\x09-\x0D\x20/:@]{1,64}:([^\x09-\x0D\x20/:@]{6,128})@"), 1),
    (6, re.compile(r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\x09-\x0D\x20]*"), 0),
)

#: Runs of a web token's characters joined by dots, and the least length of its parts.
_CHAIN = re.compile(r"[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++)*+")
_LEAST_PART = 8

_LOGIN = re.compile(r"://[^\x09-\x0D\x20/:@]++:([^\x09-\x0D\x20/:@]{6,}+)@")
_KEY_EDGE = re.compile(r"-----(BEGIN|END) (?:[A-Z0-9]+ ){0,3}PRIVATE KEY(?: BLOCK)?-----")
# Line ends, also as written in string literals; the headers and the body of a key.
_EOL = r"(?:\r?\n|\r|(?:\\r)?\\n)"
_KEY_HEADERS = re.compile(rf"[\x09\x20]*+{_EOL}(?:[A-Za-z][A-Za-z-]*+:[^\r\n\\]*+{_EOL})*+")
_KEY_BODY = re.compile(r"(?:[A-Za-z0-9+/=\x09-\x0D\x20]|\\[nr])*+")
_KEY_BREAK = re.compile(r"\\[nr]|[^A-Za-z0-9+/=]")

#: Bits per character from which a value looks random.
LIVE_BITS = 2.8
#: Owners above which a value counts as a widely copied example.
MAX_OWNERS = 2


def _signed(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the signed web tokens, as the pattern finds them, reading every run
    of characters once: three parts, of which the first is from its ``eyJ`` on."""
    for m in _CHAIN.finditer(text):
        parts, at, k = m[0].split("."), m.start(), 0
        while k + 2 < len(parts):
            head, body, sign = (len(p) for p in parts[k : k + 3])
            begin = parts[k].find("eyJ")
            if 0 <= begin <= head - 3 - _LEAST_PART and min(body, sign) >= _LEAST_PART:
                yield at + begin, at + head + body + sign + 2
                at += head + body + sign + 3
                k += 3
            else:
                at += head + 1
                k += 1


def _key_blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, body) of the private keys: from BEGIN to END or, where another one
    begins before an END or none comes, through headers and body as far as they go. The
    body is without headers and line ends; a block without one stands for itself."""
    edges = list(_KEY_EDGE.finditer(text))
    for k, m in enumerate(edges):
        if m[1] != "BEGIN":
            continue
        follows = edges[k + 1] if k + 1 < len(edges) else None
        stop = follows.start() if follows else len(text)
        headers = _KEY_HEADERS.match(text, m.end(), stop)
        begin = headers.end() if headers else m.end()
        if follows and follows[1] == "END":
            end = follows.end()
        else:
            end = stop = _KEY_BODY.match(text, begin, stop).end()
        yield m.start(), end, _KEY_BREAK.sub("", text[begin:stop]) or text[m.start() : end]


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, value) of the candidates, in that order."""
    out = []
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST_VALUE:
            out.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    if "eyJ" in text:
        out += [(start, 4, end, text[start:end]) for start, end in _signed(text)]
    for kind, pattern, group in (_MORE[0], (5, _LOGIN, 1)):
        out += [(m.start(), kind, m.end(), m[group]) for m in pattern.finditer(text)]
    if "PRIVATE KEY" in text:
        out += [(start, 6, end, body) for start, end, body in _key_blocks(text)]
    return sorted(out)


def looks_live(value: str) -> bool:
    """Whether a value's characters are as varied as random ones."""
    if len(value) < 8:
        return False
    counts = Counter(value).values()
    return -sum(c / len(value) * math.log2(c / len(value)) for c in counts) >= LIVE_BITS


_SCAN = (
    "doc_id long, repository string, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "candidates array<struct<at:int,kind:string,start:int,end:int,value:string,random:boolean>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("at", pa.int32()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("random", pa.bool_())]))
    for batch in batches:
        counts: tuple[list[int], ...] = ([], [], [])
        sha, spans, found = [], [], []
        for value in batch.column(3):
            hits = find(value.as_py() or "")
            for k in range(BASE):
                counts[k].append(sum(h[1] == k for h in hits))
            named = [(k, f"{KINDS[k]}:{s}:{e}") for s, k, e, _ in hits]
            sha.append(hashlib.sha256(",".join(x for k, x in named if k < BASE).encode()).hexdigest())
            spans.append(",".join(x for _, x in named))
            found.append([
                {"at": n, "kind": KINDS[k], "start": s, "end": e, "value": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()[:32], "random": looks_live(v)}
                for n, (s, k, e, v) in enumerate(hits)
            ])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *(pa.array(c, pa.int64()) for c in counts), pa.array(sha), pa.array(spans, pa.string()), pa.array(found, kind)],
            [x.split()[0] for x in _SCAN.split(", ")],
        )


def secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source", max_owners: int = MAX_OWNERS) -> DataFrame:
    """Secrets in each text, told apart by who else has them.

    ``docs`` needs ``doc_id``, ``text`` and the columns that name the repository and its
    owner. Returns one row per input row: ``doc_id``; ``n_assign``, ``n_access``,
    ``n_hex`` and ``base_sha256`` of the base kinds; ``spans`` (all kinds,
    ``kind:start:end`` in code points, by start, then kind); ``n_live``, ``n_example``,
    ``n_weak``; ``verdicts`` (``kind:start:end:verdict:owners:repositories`` in the same
    order). A value held by more than ``max_owners`` owners is ``example``, else it is
    ``live`` if it looks random and ``weak`` if not.

    A null text counts as empty: no spans, the digest of the empty string, counts of 0.
    Null repositories or owners count as one. Repeated rows of a document are one
    repository; each keeps its row. An empty table gives no rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"), F.col("text").cast("string").alias("text"),
    )
    scanned = settle(texts.mapInArrow(_scan, _SCAN)).withColumn("row", F.monotonically_increasing_id())
    held = scanned.where(F.size("candidates") > 0).select("row", "repository", "owner", F.explode("candidates").alias("c")).select(
        "row", "repository", "owner", "c.*"
    )
    owners = (
        held.groupBy("value", "owner", "repository").agg(F.count("*").alias("n"))
        .groupBy("value", "owner").agg(F.count("*").alias("n"))
        .groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    )
    verdict = F.when(F.col("owners") > max_owners, "example").when(F.col("random"), "live").otherwise("weak")
    judged = (
        held.join(owners, "value").withColumn("verdict", verdict)
        .groupBy("row").agg(
            *(F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "example", "weak")),
            F.sort_array(F.collect_list(F.struct("at", F.concat_ws(":", "kind", "start", "end", "verdict", "owners", "repositories").alias("v")))).alias("all"),
        )
        .select("row", "n_live", "n_example", "n_weak", F.array_join(F.col("all.v"), ",").alias("verdicts"))
    )
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_live", "n_example", "n_weak")]
    return scanned.join(judged, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", *zero, F.coalesce("verdicts", F.lit("")).alias("verdicts")
    )
