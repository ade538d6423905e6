import zlib
from collections import Counter

import numpy as np
import pytest

from convlens.llm import sharding


def test_matrix_has_exact_sums():
    rng = np.random.default_rng(0)
    for seed in range(50):
        blocks = rng.integers(0, 40, rng.integers(1, 8)).tolist()
        shards = sharding.shard_sizes(sum(blocks), int(rng.integers(1, 6)))
        m = sharding.communication_matrix(blocks, shards, seed)
        assert m.sum(axis=1).tolist() == blocks and m.sum(axis=0).tolist() == shards and (m >= 0).all()


def test_large_draws_follow_the_distribution(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 0)
    draws = Counter(sharding.hypergeometric(rng, 7, 5, 6) for _ in range(20_000))
    exact = Counter(rng.hypergeometric(7, 5, 6, 20_000).tolist())
    for k in range(1, 7):
        assert abs(draws[k] - exact[k]) < 5 * (exact[k] + 25) ** 0.5
    big = [sharding.hypergeometric(rng, 3 * 10 ** 9, 7 * 10 ** 9, 10 ** 8) for _ in range(200)]
    assert abs(np.mean(big) - 3 * 10 ** 7) < 5 * 4600 / 200 ** 0.5 and 2500 < np.std(big) < 7000


def test_every_shard_is_equally_likely(spark):
    df = spark.range(0, 600, 1, 5)
    seen = Counter()
    for seed in range(12):
        seen.update((r.id < 120, r.shard) for r in sharding.shuffle_to_shards(df, 3, seed).collect())
    # 120 rows of one block, 12 times: 480 in each shard but for chance
    assert all(abs(seen[True, s] - 480) < 90 for s in range(3))


def test_slots_and_sizes_in_pieces(spark):
    df = spark.range(1000).selectExpr("id % 10 AS a", "null AS key", "'x' AS rank", "1 AS block")
    got = sharding.shuffle_to_shards(df, 7, seed=3, rows_per_piece=20).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(map(len, by.values())) == [142] + [143] * 6 and sorted(by) == list(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert Counter(r.a for r in got) == {i: 100 for i in range(10)}
    order = [r.slot for r in sorted((r for r in got if r.shard == 0), key=lambda r: r.a)]
    assert order != sorted(order)


def test_edge_cases(spark):
    one = spark.createDataFrame([(None, None)], "doc_id bigint, text string")
    assert [(r.shard, r.slot) for r in sharding.shuffle_to_shards(one, 16).collect()] == [(0, 0)]
    assert sharding.shuffle_to_shards(one.limit(0), 16).collect() == []
    with pytest.raises(ValueError):
        sharding.shuffle_to_shards(one.selectExpr("*", "1 AS Slot"), 2)


def test_query(spark, sf):
    from convlens.llm.queries import op6_sharding
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op6_sharding(spark, sf).collect()
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(i, len(t) + 1, zlib.crc32(t)) for i, t in docs.items()}
    count = Counter(r.shard for r in got)
    assert len(got) == len(docs) and len(count) == 16 and max(count.values()) - min(count.values()) <= 1
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_equals_a_plain_reading(spark):
    """Every draw, permutation and slot followed by hand from the same hashes."""
    import struct

    import xxhash

    def spark_hash(number, row):
        first = xxhash.xxh64_intdigest(struct.pack("<i", number), 42)
        return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(struct.pack("<q", row), first)))[0]

    n_shards, seed, per_piece = 5, 3, 12
    df = spark.range(0, 317, 1, 4)
    held = {}
    for r in df.selectExpr("id", "spark_partition_id() AS b").collect():
        held.setdefault(r.b, []).append(r.id)
    blocks = [held[b] for b in sorted(held)]
    matrix = sharding.communication_matrix([len(b) for b in blocks], sharding.shard_sizes(317, n_shards), seed)
    shards = [[] for _ in range(n_shards)]
    for b, (ids, counts) in enumerate(zip(blocks, matrix)):
        rows = sorted(((spark_hash(2 * seed, (b << 33) + i), (b << 33) + i, x) for i, x in enumerate(ids)))
        at = 0
        for s, count in enumerate(counts):
            shards[s] += [(row, x) for _, row, x in rows[at:at + count]]
            at += count
    pieces = -(-317 // (n_shards * per_piece))
    want = set()
    for s, rows in enumerate(shards):
        key = lambda row: spark_hash(2 * seed + 1, row)
        piece = lambda row: int(((key(row) & (1 << 64) - 1) >> 11) * 2.0 ** -53 * pieces)
        order = sorted(rows, key=lambda r: (piece(r[0]), key(r[0]), r[0]))
        want |= {(x, s, slot) for slot, (_, x) in enumerate(order)}
    got = sharding.shuffle_to_shards(df, n_shards, seed, rows_per_piece=per_piece).collect()
    assert {(r.id, r.shard, r.slot) for r in got} == want
