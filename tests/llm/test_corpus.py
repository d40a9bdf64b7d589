"""Near duplicates, line repeats, mixing, the two models and the pipeline."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spark_elt.llm import common, language, lines, minhash, mixing, quality
from spark_elt.llm.queries import ORACLES, QUERIES

from .cases import SF, SCHEMA, docs, empty, rows, table  # noqa: F401

LOWER = {i: i + 32 for i in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")

# ---- near duplicates


def plain_groups(data, k, percent=80):
    """(size, component) of each row, by comparing all sets."""
    sets = []
    for i, text in data:
        w = SPACED.findall((text or "").translate(LOWER))
        sets.append(frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w and i is not None else frozenset())
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    root[find(a)] = find(b)
    least = {}
    for k2, (i, _) in enumerate(data):
        r = find(k2)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(least[r], i)
    return [(len(s), least[find(n)]) for n, s in enumerate(sets)]


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_table(docs, k):  # noqa: F811
    data = [(r.doc_id, r.text) for r in docs.collect()]
    want = Counter((i, n if i is not None else 0, c, i == c) for (i, _), (n, c) in zip(data, plain_groups(data, k), strict=True))
    got = Counter((r.doc_id, r.n_shingles if r.doc_id is not None else 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs, k).collect())
    assert got == want
    assert sum(n for (_, _, _, kept), n in want.items() if not kept) > 5


def family(seed, edits):
    """An original and copies with some words dropped or replaced."""
    random = np.random.default_rng(seed)
    base = [f"w{x}" for x in random.integers(0, 400, 120)]
    out = [base]
    for _ in range(60):
        w = list(base)
        for at in random.integers(0, len(w), random.integers(0, edits)):
            w[at] = f"w{random.integers(0, 4)}"
        out.append(w)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("edits", [4, 9, 16])
def test_near_duplicate_families(spark, edits):
    data = [(int(i), t) for i, t in enumerate(family(1, edits) + family(2, edits) + ["a b", "A  b", "b a"])]
    random = np.random.default_rng(3)
    data = [(int(i), t) for i, (_, t) in zip(random.permutation(len(data)), data, strict=True)]
    want = {(i, n, c) for (i, _), (n, c) in zip(data, plain_groups(data, 4), strict=True)}
    got = minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 4)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == want


def test_near_duplicates_drop(spark, docs):  # noqa: F811
    data = [(r.doc_id, r.text) for r in docs.collect()]
    keep = {i for (i, _), (_, c) in zip(data, plain_groups(data, 5), strict=True) if i == c}
    got = minhash.drop_duplicates(docs)
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _ in data if i in keep)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_signatures_estimate_jaccard():
    random = np.random.default_rng(0)
    h = random.integers(0, 2**63, 1000).astype(np.uint64)
    a, b = minhash.signature(h[:900], 512), minhash.signature(h[100:], 512)
    assert abs((a == b).mean() - 0.8) < 0.08


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([1, 2, 3, 7, 8, 9], 1), 20: 20, 21: 20, **{100 + i: 100 for i in range(41)}}


def test_joined_components(spark):
    def edges(pairs):
        return spark.createDataFrame(pairs, "a long, b long")

    first, more = [(1, 2), (3, 4), (5, 6), (7, 8)], [(2, 3), (6, 20), (30, 31), (1, 2), (31, 8)]
    roots = common.components(edges(first))
    for extra in (more, [(1, 2)], []):
        got = {r.node: r.root for r in common.joined_components(roots, edges(extra)).collect()}
        assert got == {r.node: r.root for r in common.components(edges(first + extra)).collect()}


# ---- line repeats


def plain_lines(data, ratio=lines.RATIO, least=lines.LEAST_PAGES):
    pages, seen = Counter(), Counter()
    for host, text in data:
        pages[host] += 1
        seen.update((host, x) for x in {*(text or "").split("\n")} if x.strip(" "))
    out = []
    for host, text in data:
        own = (text or "").split("\n")
        left = [x for x in own if not x.strip(" ") or not (seen[host, x] >= least and seen[host, x] > ratio * pages[host])]
        out.append(None if text is None else "\n".join(left) if any(x.strip(" ") for x in left) else text)
    return out


def test_lines_table(spark, docs):  # noqa: F811
    data = [r for r in docs.collect()]
    for ratio, least in ((0.1, 5), (0.15, 2)):
        want = Counter((r.doc_id, t, len(t) if t is not None else None) for r, t in zip(data, plain_lines([(r.source, r.text) for r in data], ratio, least), strict=True))
        got = lines.drop_boilerplate(docs, ratio=ratio, least_pages=least)
        assert got.columns == docs.columns
        assert Counter((r.doc_id, r.text, r.n_chars) for r in got.collect()) == want
    assert sum(t != r.text for r, t in zip(data, plain_lines([(r.source, r.text) for r in data], 0.15, 2), strict=True)) > 0
    assert lines.drop_boilerplate(empty(spark)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    sql = con.sql(ORACLES[name])
    got = QUERIES[name](spark, "/root/testdata/sf0.01")
    assert sorted(got.columns) == sorted(sql.columns)
    want = Counter(sql.fetchall())
    assert Counter(tuple(r) for r in got.select(*sql.columns).collect()) == want
    assert len(want) > 5


# ---- mixing


@pytest.mark.parametrize("weights", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 1.0}, {str(i): i + 1.0 for i in range(40)}, {"x": 997.0, None: 1.0, "y": 2.0}])
def test_pfair_windows(weights):
    slots = mixing.rounded(weights, 200)
    plan = mixing.layout(slots)
    period = sum(slots.values())
    assert [x[2] for x in plan] == list(range(period)) and Counter(x[0] for x in plan) == slots
    done = Counter()
    for source, i, slot, release, deadline in plan:
        assert i == done[source] and release <= slot < deadline
        done[source] += 1
        for s, n in slots.items():  # less than one block from the target, at every slot
            assert abs(done[s] - n * (slot + 1) / period) < 1


def test_mix_table(spark, docs):  # noqa: F811
    got = mixing.mix(docs, block=4, period=100)
    found = got.collect()
    assert got.columns == [*docs.columns, "mix_block", "mix_slot", "mix_release", "mix_deadline", "mix_place"]
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, r.text) for r in docs.collect())
    slots = mixing.rounded({s: n**mixing.TEMPERATURE for s, n in Counter(r.source for r in found).items()}, 100)
    plan = {(s, i): (slot, a, b) for s, i, slot, a, b in mixing.layout(slots)}
    size = sum(slots.values())
    by_source = defaultdict(list)
    for r in found:
        by_source[r.source].append((r.mix_block, r.mix_place))
        turn, i = divmod(r.mix_block, slots[r.source])
        assert (r.mix_slot, r.mix_release, r.mix_deadline) == tuple(x + turn * size for x in plan[r.source, i])
    for places in by_source.values():
        assert sorted(places) == [divmod(k, 4) for k in range(len(places))]
    # the same places again, also with the columns already there
    assert table(mixing.mix(got, block=4, period=100)) == table(got)
    assert mixing.mix(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"src0": 1.0})
    with pytest.raises(ValueError):
        mixing.rounded({"a": 0.0})


def test_mix_shares(spark):
    data = [(i, "a" if i < 3000 else "b" if i < 5000 else "c") for i in range(6000)]
    got = mixing.mix(spark.createDataFrame(data, "doc_id long, source string"), {"a": 0.5, "b": 0.3, "c": 0.2}, block=10)
    first = Counter(r.source for r in got.where("mix_slot < 300").collect())
    assert first == {"a": 1500, "b": 900, "c": 600}


# ---- models


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op9_quality"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == held(i) for i, r in got.items())
    judged = [(got[i].predicted, q) for i, q in labels.items() if got[i].held_out]
    assert np.mean([a == b for a, b in judged]) > 0.95
    again = {r.doc_id: r.score for r in QUERIES["op9_quality"](spark, sf).collect()}
    assert all(math.isclose(again[i], r.score, abs_tol=1e-3) for i, r in got.items())


def test_quality_odd_rows(spark, docs):  # noqa: F811
    labels = spark.createDataFrame([(r[0], r[1], 7) for r in rows("labels")] + [(None, 1, 7), (10_001, None, 7), (0, 1, 7)], "doc_id long, quality int, text int")
    got = quality.score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    passed = quality.accept(docs, labels)
    assert passed.columns == docs.columns
    assert Counter(r.doc_id for r in passed.collect()) == Counter(r.doc_id for r in got if r.predicted)
    none = labels.where("false")
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert len({r.score for r in quality.score(docs, labels.where("quality = 1")).collect()}) == 1
    assert quality.score(empty(spark), labels).count() == 0


def test_word_vectors_bring_words_of_like_use_together(spark):
    data = [(f"the {x} sat on a mat near {y} stones",) for x in ("cat", "dog") for y in ("red", "blue")] * 5 + [("one @ ## %% two",)] * 10
    vectors = quality.word_vectors(spark.createDataFrame(data, "text string"))
    raw = np.frombuffer(b"cat dog ## red", np.uint8)
    word, _, _ = quality.words(raw, np.array([0, len(raw)]))
    v = vectors[word] / np.linalg.norm(vectors[word], axis=1, keepdims=True)
    assert v[0] @ v[1] > v[0] @ v[2] + 0.2


def test_language(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op5_language_id"](spark, sf).collect()}
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(want) and all(0 <= r.score <= 1 and r.held_out == held(i) for i, r in got.items())
    assert np.mean([got[i].lang_pred == x for i, x in want.items() if got[i].held_out]) > 0.95


def test_language_odd_rows(spark, docs):  # noqa: F811
    got = language.languages(docs, sample=40, steps=30).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    for i in (10_001, 10_002, 10_003):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[-5].lang_pred != "und"
    unknown = language.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}
    assert language.languages(empty(spark)).count() == 0


def test_language_gradient():
    """Backpropagation through time against finite differences."""
    random = np.random.default_rng(1)
    unit = language.Gated(random.normal(0, 0.3, (language.PAD + 1, 3 * language.HIDDEN)), random.normal(0, 0.3, (3 * language.HIDDEN, language.HIDDEN)))
    unit.table, unit.u = unit.table.astype(np.float32), unit.u.astype(np.float32)
    codes = random.integers(0, 256, (7, 3))
    target = random.normal(0, 1, (7, language.HIDDEN, 3)).astype(np.float32)
    kept = []
    unit.states(codes, kept)
    for grad, weights in zip(unit.back(codes, kept, target), (unit.table, unit.u), strict=True):
        for _ in range(12):
            at = (random.choice(np.unique(codes)) if weights is unit.table else random.integers(0, weights.shape[0]), random.integers(0, weights.shape[1]))
            old, step = weights[at], np.float32(1e-2)
            weights[at] = old + step
            up = float((unit.states(codes) * target).sum(dtype=np.float64))
            weights[at] = old - step
            down = float((unit.states(codes) * target).sum(dtype=np.float64))
            weights[at] = old
            assert (up - down) / (2 * float(step)) == pytest.approx(grad[at], abs=0.02)


# ---- pipeline


def test_pipeline_stages(spark, docs):  # noqa: F811
    frame = docs
    counts = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = common.stored(stage(spark, frame, SF), f"test-{name}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
        counts.append(frame.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] == counts[4] > 0
    assert counts[0] < docs.count() and counts[2] < counts[1] and counts[3] < counts[2]
    nothing = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in got]
    assert len(ids) == len(set(ids)) and 100 < len(ids) < 200
