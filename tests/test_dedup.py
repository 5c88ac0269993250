"""Deduplication against plain-Python restatements."""

import random
from collections import OrderedDict

from pyspark.sql import functions as F

from tessera.operators import dedup


def lru_keep(seq, cache_len):
    cache, keep = OrderedDict(), []
    for v in seq:
        hit = v in cache
        cache[v] = 1
        cache.move_to_end(v)
        while len(cache) > cache_len:
            cache.popitem(last=False)
        keep.append(not hit)
    return keep


def frame(spark, shards):
    rows = [(s, p, v) for s, seq in shards.items() for p, v in enumerate(seq)]
    return spark.createDataFrame(rows, "shard int, pos long, sentence string")


def test_lru_fixture(spark):
    df = frame(spark, {0: list("xyxzwx")})
    kept = [r.sentence for r in dedup.dedup_lru(df, 2).orderBy("pos").collect()]
    assert kept == list("xyzwx")


def test_lru_random_matches_cache(spark):
    rnd = random.Random(7)
    shards = {s: [rnd.choice("abcdefghijkl") for _ in range(300)] for s in range(5)}
    df = frame(spark, shards)
    got = {(r.shard, r.pos) for r in dedup.dedup_lru(df, 4, num_partitions=3).collect()}
    want = {(s, p) for s, seq in shards.items() for p, k in enumerate(lru_keep(seq, 4)) if k}
    assert got == want


def test_lru_chunks_equal_whole_shards(spark):
    rnd = random.Random(11)
    shards = {s: [rnd.choice("abcdefghijklmnop") for _ in range(500)] for s in range(3)}
    df = frame(spark, shards)
    want = {(s, p) for s, seq in shards.items() for p, k in enumerate(lru_keep(seq, 5)) if k}
    for chunk in (7, 64, 1 << 20):
        got = {(r.shard, r.pos) for r in dedup.dedup_lru(df, 5, chunk_len=chunk).collect()}
        assert got == want, chunk


def test_recent_matches_loop_and_slices(spark):
    rnd = random.Random(3)
    shards = {s: [rnd.choice("abcdef") for _ in range(400)] for s in range(3)}
    df = frame(spark, shards)
    want = set()
    for s, seq in shards.items():
        last = {}
        for p, v in enumerate(seq):
            if v not in last or p - last[v] > 5:
                want.add((s, p))
            last[v] = p
    for slice_len in (1 << 20, 7):
        got = {(r.shard, r.pos) for r in dedup.dedup_recent(df, 5, slice_len=slice_len).collect()}
        assert got == want


def test_exact_keeps_first(spark):
    df = spark.createDataFrame([(2, 0, "a"), (1, 5, "a"), (1, 6, "b"), (3, 0, "b"), (1, 4, "c")],
                               "doc_id int, sent_no int, sentence string")
    got = sorted((r.doc_id, r.sent_no, r.sentence) for r in dedup.dedup_exact(df).collect())
    assert got == [(1, 4, "c"), (1, 5, "a"), (1, 6, "b")]


def test_hot_value_exact(spark):
    # one value in a third of the rows
    rows = [(i, 0, "hot" if i % 3 == 0 else f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id int, sent_no int, sentence string")
    out = dedup.dedup_exact(df)
    assert out.count() == 2001
    assert out.where(F.col("sentence") == "hot").first().doc_id == 0


def test_exact_packs_order_and_nulls(spark):
    rows = [(None, 3, "a"), (-5, 1, "a"), (2**63 - 1, -2**31, "b"), (-2**63, 2**31 - 1, "b"), (7, None, "c"), (7, 0, "c"),
            (-2**63, None, None), (4, 4, None)]
    df = spark.createDataFrame(rows, "doc_id long, sent_no int, sentence string")
    out = dedup.dedup_exact(df)
    assert {tuple(r) for r in out.collect()} == {
        (None, 3, "a"), (-2**63, 2**31 - 1, "b"), (7, None, "c"), (-2**63, None, None)}
    assert out.schema.simpleString() == df.schema.simpleString()
    plan = out._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert not dedup.dedup_exact(df.limit(0)).collect()
    # a further column takes the other form and keeps the same rows
    more = dedup.dedup_exact(df.withColumn("x", F.lit(1)))
    assert {tuple(r)[:3] for r in more.collect()} == {tuple(r) for r in out.collect()}


def test_lru_seeds_of_many_chunks_move_little(spark, monkeypatch):
    """Sums over chunks are a small multiple of the chunks' own, and hold no texts."""
    chunks, cache, seen = 70, 3, []
    top = dedup._top_recent
    monkeypatch.setattr(dedup, "_top_recent", lambda df, n, keys: seen.append((df.count(), dict(df.dtypes)["_v"])) or top(df, n, keys))
    rng = random.Random(5)
    lines = [None if x == 9 else f"line {x}" for x in (rng.choice([rng.randrange(10), 2]) for _ in range(4 * chunks))]
    rows = spark.createDataFrame([(0, i, s) for i, s in enumerate(lines)], "shard int, pos long, line string")
    kept = {r.pos for r in dedup.dedup_lru(rows, cache, "line", chunk_len=4).collect()}
    recent, want = OrderedDict(), set()
    for i, s in enumerate(lines):
        if s not in recent:
            want.add(i)
        recent[s] = None
        recent.move_to_end(s)
        if len(recent) > cache:
            recent.popitem(last=False)
    assert kept == want
    assert sum(n for n, _ in seen[1:]) < 7 * chunks * cache and {kind for _, kind in seen} == {"binary"}
