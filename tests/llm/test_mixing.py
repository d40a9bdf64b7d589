"""Mixing over many blocks and many sources."""

from collections import Counter

from spark_elt.llm import mixing


def test_mix_keeps_to_unrounded_weights(spark):
    weights = {"a": 0.50045, "b": 0.49945, "c": 0.0001}
    n = {"a": 50_045, "b": 49_945, "c": 10}
    data = spark.range(100_000).selectExpr("id as doc_id", f"case when id < {n['a']} then 'a' when id < {n['a'] + n['b']} then 'b' else 'c' end as source")
    got = mixing.mix(data, weights, block=1).select("source", "mix_slot").collect()
    assert len({r.mix_slot for r in got}) == 100_000
    done = Counter()
    for r in sorted(got, key=lambda r: r.mix_slot):
        done[r.source] += 1
        for s, w in weights.items():
            if done[s] < n[s]:
                assert abs(done[s] - w * (r.mix_slot + 1)) < 2, (s, r)


def test_slots_joined_instead_of_broadcast(spark, monkeypatch):
    data = spark.range(3_000).selectExpr("id as doc_id", "cast(sqrt(id) as int) % 7 as source")
    one = mixing.mix(data, block=2).collect()
    monkeypatch.setattr(mixing, "BROADCAST_SLOTS", 0)
    assert sorted(map(tuple, mixing.mix(data, block=2).collect())) == sorted(map(tuple, one))


def test_more_sources_than_are_broadcast(spark):
    n = mixing.BROADCAST_SOURCES + 2_000
    data = spark.range(n + 5).selectExpr("id as doc_id", f"case when id % {n} = 3 then null else concat('host', id % {n}) end as source")
    got = mixing.mix(data, block=1).collect()
    assert len(got) == n + 5 and len({r.mix_slot for r in got}) == n + 5
    assert Counter(r.mix_place for r in got) == {0: n + 5}
    assert sum(r.source is None for r in got) == 2
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in got)
