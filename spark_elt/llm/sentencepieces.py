"""SentencePiece encoding and decoding of merge-type vocabularies.

A text becomes symbols, one a character. An agenda holds the adjacent pairs whose
concatenation is a piece of the vocabulary, the best score first and the leftmost among
equals; the best pair is merged and its new neighbours join the agenda, until no pair is
left. What is no piece then becomes its bytes. No merge crosses a place where no piece
holds a space mark after another character, nor a character that no longer piece has, so
a text is cut there and equal cuts are merged once and remembered (at most ``REMEMBERED``
short ones at a time; forgetting costs time only). The agendas of the short cuts of one
length, new in a batch, lie side by side in a matrix, from each row of which the best
pair is taken at a time; a longer cut has a heap.

The sentencepiece library encodes and decodes every Arrow batch as well; a difference
fails the job with both results. The model file travels with the job, so that workers
need no copy of it. Texts are taken whole; null is the empty text; other columns are not
read, whatever their names, and repeated rows stay repeated. A very long text costs
n log n in its longest cut.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator, Mapping
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_elt.session import ship_code

from .text import buffers, slices

SPACE = "▁"
#: Cuts kept in memory by a worker, and the longest of them.
REMEMBERED = 1 << 19
LONGEST = 32
#: Rank of a pair that is no piece.
NEVER = np.iinfo(np.int32).max
#: Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Text bytes that are encoded and checked at a time.
STEP = 1 << 19


class Known(Mapping):
    """Cuts and their ids, which lie one after the other in ``flat``: those of number ``k``
    are ``sizes[k]`` from ``starts[k]`` on."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.starts = self.sizes = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def add(self, parts: list[tuple[list[str], np.ndarray, np.ndarray]]) -> None:
        """Add new cuts: lists of them, with their ids and numbers of ids."""
        for cuts, _, _ in parts:
            self.numbers.update(zip(cuts, range(len(self.numbers), len(self.numbers) + len(cuts))))
        self.flat = np.concatenate([self.flat, *(ids for _, ids, _ in parts)])
        self.sizes = np.concatenate([self.sizes, *(sizes for _, _, sizes in parts)])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def drop(self, last: list[str]) -> None:
        """Forget the cuts that were added last."""
        for cut in last:
            del self.numbers[cut]
        kept = len(self.numbers)
        self.sizes, self.starts = self.sizes[:kept].copy(), self.starts[:kept].copy()
        self.flat = self.flat[: int(self.sizes.sum())].copy()

    def __getitem__(self, cut: str) -> tuple[int, ...]:
        k = self.numbers[cut]
        return tuple(self.flat[self.starts[k] : self.starts[k] + self.sizes[k]].tolist())

    def __iter__(self) -> Iterator[str]:
        return iter(self.numbers)

    def __len__(self) -> int:
        return len(self.numbers)


class Vocabulary:
    """Pieces and scores of a SentencePiece model whose pieces are made by merging."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        normal = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != 2:
            raise ValueError("the vocabulary is not of merge type")
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("texts would be normalised; only vocabularies over plain texts are read")
        if not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or BYTE not in kinds or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("user-defined or unused pieces, or no bytes for unknown characters")
        self.library = SentencePieceProcessor(model_proto=model)
        self.prefix = SPACE if normal.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.end = proto.trainer_spec.eos_id
        self.surface = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
            else proto.trainer_spec.unk_surface.encode() if p.type == UNKNOWN
            else b"" if p.type == CONTROL else p.piece.replace(SPACE, " ").encode()
            for p in proto.pieces
        ]
        self.kinds = [p.type for p in proto.pieces]
        self.marked = [p.type == NORMAL and p.piece.startswith(SPACE) for p in proto.pieces]
        self.cuts = self._cuts()
        sizes = np.array([len(x) for x in self.surface], np.int64)
        self.surface_sizes, self.surface_starts = sizes, np.cumsum(sizes) - sizes
        self.surface_bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        self.control = np.array([k == CONTROL for k in self.kinds])
        self.known = Known()
        self._pairs()

    def _pairs(self) -> None:
        """Numbers of the symbols (pieces and their characters), and a table of all pairs
        that make a piece: its number, and its rank by score. The pair (left, right) lies
        at ``place[left] + right``; the rows of the left symbols interleave, each at the
        first of some places tried where its cells are free."""
        symbols = sorted({*self.ids, *(c for p in self.ids for c in p)})
        self.number = {s: i for i, s in enumerate(symbols)}
        order = {s: i for i, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for p in self.ids:
            for k in range(1, len(p)):
                if p[:k] in self.number and p[k:] in self.number:
                    rows.setdefault(self.number[p[:k]], []).append((self.number[p[k:]], self.number[p], order[self.scores[p]]))
        room = 1 << max(10, (8 * sum(map(len, rows.values()))).bit_length())
        self.place = np.ones(len(symbols) + 1, np.int64)  # the last one is for no symbol, -1
        self.left_of = np.full(room + len(symbols) + 1, -9, np.int32)
        self.makes = np.full(len(self.left_of), -1, np.int32)
        self.ranks = np.full(len(self.left_of), NEVER, np.int32)
        for left, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
            right, makes, ranks = np.array(row, np.int64).T
            at, step = 1, 0
            while (self.left_of[at + right] >= 0).any():
                step += 1
                at = 1 + step * 7919 * (left + 1) % (room - 1) if step < 5_000 else self._more_room()
            self.place[left] = at
            self.left_of[at + right], self.makes[at + right], self.ranks[at + right] = left, makes, ranks
        codes = [ord(s) for s in symbols if len(s) == 1]
        self.of_code = np.full(max(codes, default=0) + 2, -1, np.int32)
        self.of_code[codes] = [self.number[chr(c)] for c in codes]
        #: Token of each symbol, -1 where it is written as bytes.
        self.token = np.array([*(self.ids.get(s, -1) for s in symbols), -1], np.int32)

    def _more_room(self) -> int:
        """A place behind all others, after making the table as long again."""
        at = len(self.left_of)
        self.left_of, self.makes, self.ranks = (
            np.append(x, np.full(len(x), rest, np.int32)) for x, rest in ((self.left_of, -9), (self.makes, -1), (self.ranks, NEVER))
        )
        return at

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs of symbol numbers (-1: none) and the numbers of what they make."""
        at = self.place[left] + right
        return np.where((self.left_of[at] == left) & (left >= 0), self.ranks[at], NEVER), self.makes[at]

    def _merge_all(self, cuts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge ``cuts`` of ``n`` characters, an agenda a row. Returns their ids in order,
        their numbers of ids, and the numbers of the cuts that hold other symbols than pieces."""
        m, width = len(cuts), n + 1  # the last column stands for no symbol, before and after a cut
        codes = np.frombuffer("".join(cuts).encode("utf-32-le"), np.uint32).reshape(m, n)
        at = np.full((m, width), -1, np.int32)
        at[:, :n] = self.of_code[np.minimum(codes, len(self.of_code) - 1)]
        agenda, makes = (x.reshape(m, n) for x in self._look(at[:, :-1].ravel(), at[:, 1:].ravel()))
        agenda, makes = (np.hstack([x, np.full((m, 1), x.dtype.type(NEVER))]) for x in (agenda, makes))
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), (m, 1))
        before = np.tile(np.append(n, np.arange(n, dtype=np.int32)), (m, 1))
        there = np.ones((m, width), bool)
        there[:, n] = False
        at_, makes_, after_, before_, there_ = (x.reshape(-1) for x in (at, makes, after, before, there))
        rows = np.arange(m) * width
        while True:
            left = agenda.argmin(axis=1)
            some = np.flatnonzero(agenda[np.arange(len(agenda)), left] < NEVER)
            if not len(some):
                break
            if len(some) < len(agenda):
                agenda, rows, left = agenda[some], rows[some], left[some]
            here, one = np.arange(len(rows)), rows + left
            right = after_[one]
            other = rows + right
            follows, leads, made = after_[other], before_[one], makes_[one]
            at_[one], there_[other] = made, False
            after_[one], before_[rows + follows] = follows, left
            agenda[here, right] = NEVER
            agenda[here, left], makes_[one] = self._look(made, at_[rows + follows])
            agenda[here, leads], makes_[rows + leads] = self._look(at_[rows + leads], made)
        tokens = self.token[at]
        odd = np.flatnonzero((there & (tokens < 0)).any(axis=1))
        there[odd] = False
        return tokens[there], there.sum(axis=1), odd

    def _cuts(self) -> re.Pattern:
        """The pattern of the parts of a text that merge by themselves."""
        longer = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            return re.compile(r"(?s).+")
        joined = "".join(re.escape(c) for c in sorted({c for p in longer for c in p} - {SPACE}))
        if not joined:
            return re.compile(f"{SPACE}+|.", re.S)
        return re.compile(f"{SPACE}*[{joined}]+|{SPACE}+|.", re.S)

    def pieces(self, symbols: str) -> list[str]:
        """The merged symbols of a text part, from its agenda of adjacent pairs."""
        at, scores = list(symbols), self.scores
        n = len(at)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = []
        for i in range(n - 1):
            score = scores.get(at[i] + at[i + 1])
            if score is not None:
                agenda.append((-score, i, i + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            # a pair of which a side has merged with another one meanwhile is gone
            if not at[left] or not at[right] or len(at[left]) + len(at[right]) != size:
                continue
            at[left] += at[right]
            at[right] = ""
            follows, leads = after[right], before[left]
            after[left] = follows
            if follows >= 0:
                before[follows] = left
            for a, b in ((leads, left), (left, follows)):
                if a >= 0 and b >= 0:
                    score = scores.get(at[a] + at[b])
                    if score is not None:
                        heapq.heappush(agenda, (-score, a, b, len(at[a]) + len(at[b])))
        return [p for p in at if p]

    def _tokens(self, pieces: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for piece in pieces:
            known = self.ids.get(piece)
            out += [known] if known is not None else [self.bytes[b] for b in piece.encode()]
        return tuple(out)

    def _learn(self, cuts: Iterable[str]) -> None:
        """Remember the ids of ``cuts`` that are not known."""
        by_size: dict[int, list[str]] = {}
        for cut in cuts:
            if cut not in self.known.numbers:
                by_size.setdefault(len(cut), []).append(cut)
        plain: list[str] = []
        learnt: list[tuple[list[str], np.ndarray, np.ndarray]] = []
        for n, some in by_size.items():
            if 1 < n <= LONGEST:
                ids, counts, odd = self._merge_all(some, n)
                if len(odd):
                    plain += [some[k] for k in odd.tolist()]
                    counts, some = np.delete(counts, odd), np.delete(np.array(some, object), odd).tolist()
                learnt.append((some, ids, counts))
            else:
                plain += some
        if plain:
            tokens = [self._tokens(self.pieces(c)) for c in plain]
            learnt.append((plain, np.fromiter(chain.from_iterable(tokens), np.int32), np.array([len(t) for t in tokens], np.int64)))
        self.known.add(learnt)

    def encode_flat(self, texts: list[str], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, each with the id of the end of a text if
        ``end``; and where each text's begin, and the last one's end."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        split = [self.cuts.findall(self.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        cuts = list(chain.from_iterable(split))
        numbers = np.fromiter(map(known.numbers.get, cuts, repeat(-1)), np.int64, len(cuts))
        unknown = np.flatnonzero(numbers < 0).tolist()
        new = {cuts[k] for k in unknown}
        long = [c for c in new if len(c) > LONGEST]
        self._learn(new.difference(long))
        self._learn(long)
        numbers[unknown] = [known.numbers[cuts[k]] for k in unknown]
        ids, ends = _gather(known.flat, known.starts[numbers], known.sizes[numbers])
        bounds = np.append(0, ends)[np.cumsum([0, *map(len, split)])]
        if end:
            ids, bounds = np.insert(ids, bounds[1:], self.end), bounds + np.arange(len(bounds))
        known.drop(long)
        return ids, bounds

    def encode_all(self, texts: list[str], end: bool = True) -> list[list[int]]:
        """Ids of each text, with the id of the end of a text if ``end``."""
        ids, bounds = self.encode_flat(texts, end)
        return _lists(ids, bounds)

    def encode(self, text: str, end: bool = True) -> list[int]:
        """Ids of one text."""
        return self.encode_all([text], end)[0]

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ``ids``: pieces with their space marks as blanks, bytes joined to
        characters (those that make none become U+FFFD), no mark before the first."""
        ids = list(ids)
        while ids and self.kinds[ids[-1]] == CONTROL:
            ids.pop()
        first = next((k for k, i in enumerate(ids) if self.kinds[i] != CONTROL), None)
        if first is None:
            return ""
        skip = len(self.prefix) if self.marked[ids[first]] else 0
        try:
            plain = not any(self.kinds[i] == CONTROL for i in ids[first:])
            if plain:
                return b"".join([self.surface[i] for i in ids[first:]]).decode()[skip:]
        except UnicodeDecodeError:
            pass
        out, run = [], b""
        for i in ids[first:]:
            if self.kinds[i] == BYTE:
                run += self.surface[i]
                continue
            out += [_characters(run), self.surface[i].decode()]
            run = b""
        return "".join([*out, _characters(run)])[skip:]


    def decode_flat(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each part of ``ids`` between ``bounds``, as ``decode`` gives it."""
        raw, ends = _gather(self.surface_bytes, self.surface_starts[ids], self.surface_sizes[ids])
        raw, cut = raw.tobytes(), np.append(0, ends)[bounds].tolist()
        controls = np.append(0, np.cumsum(self.control[ids]))[bounds]
        out = []
        for k, (lo, hi, n) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), np.diff(controls).tolist())):
            try:
                if hi - lo <= n or n > 1 or (n == 1 and not self.control[ids[hi - 1]]):
                    raise ValueError("ends inside a text")
                out.append(raw[cut[k] : cut[k + 1]].decode()[len(self.prefix) if self.marked[ids[lo]] else 0 :])
            except ValueError:  # also bytes that make no characters
                out.append(self.decode(ids[lo:hi].tolist()))
        return out


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of ``values`` at ``starts``, one after the other, and where each ends."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)], ends


def _lists(ids: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    flat, at = ids.tolist(), bounds.tolist()
    return [flat[lo:hi] for lo, hi in zip(at, at[1:])]


def _characters(run: bytes) -> str:
    """The characters of a run of byte pieces; a byte that begins none is U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            out.append("�")
        at += size
    return "".join(out)


@functools.lru_cache(maxsize=2)
def _loaded(_name: str, holder) -> Vocabulary:
    return Vocabulary(holder.model)


class _Model:
    """The bytes of a model, equal to others by their digest."""

    def __init__(self, model: bytes):
        self.model, self.name = model, hashlib.sha256(model).hexdigest()

    def __hash__(self):
        return hash(self.name)

    def __eq__(self, other):
        return self.name == other.name

    def vocabulary(self) -> Vocabulary:
        return _loaded(self.name, self)


def _model(path: str) -> _Model:
    with open(path, "rb") as f:
        return _Model(f.read())


def _same(kind: str, what: list, mine: list, theirs: list) -> None:
    for given, a, b in zip(what, mine, theirs):
        if a != b:
            raise ValueError(f"{kind} differs from the library's for {str(given)[:200]!r}: {str(a)[:200]} and {str(b)[:200]}")


def encode(docs: DataFrame, model_path: str, check: bool = True) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text): the ids of its whole text and
    of its end. The driver reads the model file. With ``check`` the library encodes every
    text too, and a difference fails the job."""
    ship_code(docs.sparkSession)
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = model.vocabulary()
        for batch in batches:
            _, offsets = buffers(batch.column(1))
            for lo, hi in slices(offsets, STEP):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                ids, bounds = words.encode_flat(texts)
                if check:
                    theirs = words.library.encode(texts, add_eos=True, num_threads=1)
                    flat = np.fromiter(chain.from_iterable(theirs), np.int32)
                    if not (np.array_equal(flat, ids) and np.array_equal(np.cumsum([0, *map(len, theirs)]), bounds)):
                        _same("encoding", texts, _lists(ids, bounds), theirs)
                made = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), made], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str, check: bool = True) -> DataFrame:
    """``encoded`` (doc_id, ids) with the ``decoded`` text of its ids (null: the empty
    text). With ``check`` the library decodes them too, and a difference fails the job."""
    ship_code(encoded.sparkSession)
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = model.vocabulary()
        for batch in batches:
            column = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(column), 0)
            at = np.append(0, np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)))
            flat = column.flatten().to_numpy(zero_copy_only=False)  # without the ids below a null
            lo = 0
            while lo < len(column):
                hi = lo + 1
                while hi < len(column) and at[hi + 1] - at[lo] <= STEP:
                    hi += 1
                ids, bounds = flat[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                decoded = words.decode_flat(ids, bounds)
                if check:
                    lists = _lists(ids, bounds)
                    _same("decoding", lists, decoded, words.library.decode(lists, num_threads=1))
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), column.slice(lo, hi - lo), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )
                lo = hi

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``decode``'s rows."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"),
    )
