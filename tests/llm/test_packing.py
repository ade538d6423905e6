import random

import pytest

from convlens.llm.packing import pack, pack_documents

SIZES = (16, 32, 64, 128)


def check(lengths, bins, offsets, capacities):
    held = {}
    for n, b, o in zip(lengths, bins, offsets):
        held.setdefault(b, []).append((o, n))
    assert sorted(held) == list(range(len(capacities)))
    for b, items in held.items():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= capacities[b] in SIZES
        assert not [c for c in SIZES if at <= c < capacities[b]]  # downsized


def test_packs_all_without_overlap():
    rng = random.Random(1)
    for _ in range(200):
        lengths = sorted((rng.choice([0, 1, 128, rng.randint(1, 128)]) for _ in range(rng.randint(0, 150))), reverse=True)
        check(lengths, *pack(lengths, list(SIZES)))


def test_close_to_full_and_better_than_one_size():
    rng = random.Random(2)
    lengths = sorted((min(128, int(rng.lognormvariate(3, 1)) + 1) for _ in range(5000)), reverse=True)
    several, one = pack(lengths, list(SIZES))[2], pack(lengths, [128])[2]
    assert sum(lengths) / sum(several) > 0.99
    assert sum(several) <= sum(one)


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, _ = pack([100, 120, 8][:2] + [8], [128], overhead=0)
    assert (bins[2], offsets[2]) == (1, 120)


def test_documents(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 0, 5, 128, 129, 1000, rng.randint(0, 300)])) for i in range(500)] + [(7, 50)] * 200 + [(None, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, length bigint").selectExpr("*", "1 AS bin", "2 AS part", "3 AS n")
    got = pack_documents(df, "doc_id", "length", SIZES, group_rows=100).collect()
    assert sum(r.length for r in got) == sum(n or 0 for _, n in rows)
    by_bin, by_doc = {}, {}
    for r in got:
        by_bin.setdefault(r.bin, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
        assert r.length <= r.capacity
    for items in by_bin.values():
        items.sort(key=lambda r: (r.offset, r.length))
        at = 0
        for r in items:
            assert r.offset == at
            at += r.length
        assert at <= items[0].capacity
    for i, n in rows[:500]:
        if i != 7:
            assert sorted((r.start, r.length) for r in by_doc[i]) == [(s, min(128, (n or 0) - s)) for s in range(0, max(n or 0, 1), 128)]
    assert len({b >> 32 for b in by_bin}) > 1
    assert pack_documents(df.limit(0), "doc_id", "length").collect() == []
    with pytest.raises(ValueError):
        pack_documents(df, "doc_id", "length", ())


def test_query(spark, sf):
    from convlens.llm.queries import op5_packing
    got = op5_packing(spark, sf).collect()
    sizes = {r.doc_id: len(r.text.encode()) + 1 for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == sizes


def plain(lengths, capacities, overhead):
    """The same policy read plainly: every open bin is looked at for every item."""
    worth = min((c + overhead) / c for c in capacities)
    bins, offsets, used, room, put = [], [], [], [], []
    for k, n in enumerate(lengths):
        if n == 0 and used:
            bins.append(len(used) - 1)
            offsets.append(used[-1])
            continue
        fits = [b for b in range(len(used)) if room[b] >= n and room[b] > 0]
        if fits:
            b = min(fits, key=lambda b: (room[b], -put[b]))  # least room, then the bin last put there
        else:
            def cost(c):
                to_come = sum(x for x in lengths[k + 1:] if x <= c - n) - sum(room)
                return c + overhead - worth * max(0, min(c - n, to_come)), c
            b = len(used)
            used.append(0)
            room.append(min((c for c in capacities if c >= n), key=cost))
            put.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        room[b] -= n
        put[b] = k + 1
    return bins, offsets, [min(c for c in capacities if c >= u) for u in used]


def test_equals_a_plain_reading_of_the_policy():
    rng = random.Random(11)
    for overhead in (0.0, 32.0):
        for _ in range(150):
            lengths = sorted((rng.choice([0, 1, 128, rng.randint(1, 128), rng.randint(1, 20)]) for _ in range(rng.randint(0, 90))), reverse=True)
            assert pack(lengths, list(SIZES), overhead) == plain(lengths, SIZES, overhead)
