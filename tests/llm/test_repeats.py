import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from convlens.llm import repeats


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:len(b)]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def rows(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(13)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    passage = [" ".join(word() for _ in range(rnd.randint(3, 40))) for _ in range(12)]
    out = [" ".join(rnd.choice(passage) if rnd.random() < 0.3 else word() for _ in range(rnd.randint(0, 40))) for _ in range(120)]
    out += [None, "", "ab", "a" * 500, "a" * 23, "a" * 25, "ab" * 40, "\x00" * 30, out[3], out[3], out[5][:-1], "x" + out[5], out[7] + out[7]]
    # one passage in many surroundings
    return out + [f"{word()} {passage[0]}{passage[1]} {word()}" for _ in range(80)]


@pytest.mark.parametrize("options", [{}, {"bits": 6}, {"bucket_bytes": 2000}, {"hot_rows": 3}, {"hot_rows": 0}])
@pytest.mark.parametrize("length", [24, 60])
def test_equals_brute_force(spark, texts, length, options):
    df = spark.createDataFrame([(i, t, b"k", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, doc binary, at int").repartition(5)
    want = sorted(((i, *w) for i, w in enumerate(brute(texts, length))), key=str)
    assert sum(w[2] > 0 for w in want) > 30
    assert rows(repeats.remove_repeats(df, length, **options)) == want


def test_long_texts_are_scanned_in_parts(monkeypatch):
    import pyarrow as pa
    rnd = np.random.default_rng(1)
    text = rnd.integers(97, 100, 5000).astype(np.uint8).tobytes()

    def strings(part):
        monkeypatch.setattr(repeats, "PART", part)
        out = {}
        for data, ends, of in repeats._parts(pa.array([text], pa.binary()), pa.array([b"k"], pa.binary()), 50):
            place, key, first, last = repeats.anchors(np.frombuffer(data, np.uint8), ends, 50, 8)
            which = np.searchsorted(ends, place, side="right")
            begin = np.concatenate([[0], ends[:-1]])[which]
            for p, h, i, j, b, t in zip(place, key, first, last, begin, which):
                out |= {int(s - b + of[t][1]): (int(p - b + of[t][1]), int(h)) for s in range(i, j + 1)}
        return out

    whole = strings(1 << 20)
    assert sorted(whole) == list(range(4951)) and strings(700) == whole


@pytest.mark.parametrize("width,shallow", [(3, 64), (20, 8), (40, 16), (64, 64), (70, 64), (1, 8)])
def test_sorting(width, shallow):
    rnd = np.random.default_rng(width)
    data = (rnd.integers(0, 2, (400, width)) * rnd.integers(1, 256)).astype(np.uint8)
    data[200:300, :width - 1] = data[0, :width - 1]
    data[300:] = data[rnd.integers(0, 5, 100)]
    order, shared = repeats.deep_shallow(data, shallow)
    got = [data[i].tobytes() for i in order]
    assert got == sorted(got) and sorted(order.tolist()) == list(range(400))
    common = lambda a, b: next((i for i in range(width) if a[i] != b[i]), width)
    assert shared.tolist() == [-1, *(common(a, b) for a, b in zip(got, got[1:]))]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (None, ""), (2, "short")], "doc_id bigint, text string")
    assert repeats.remove_repeats(df.limit(0)).collect() == []
    assert rows(repeats.remove_repeats(df)) == sorted([(i, n, 0, 0, hashlib.sha256(t).hexdigest()) for i, n, t in ((1, 0, b""), (None, 0, b""), (2, 5, b"short"))], key=str)


def test_query_equals_brute_force(spark, sf):
    from convlens.llm.queries import op13_repeats
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    df = op13_repeats(spark, sf)
    assert dict(df.dtypes) == {"doc_id": "bigint", "kept_sha256": "string"} | dict.fromkeys(("n_bytes", "n_removed", "n_spans"), "bigint")
    assert rows(df) == sorted(((d.doc_id, *w) for d, w in zip(docs, brute([d.text for d in docs], 400))), key=str)
