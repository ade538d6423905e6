import random
import re
from collections import Counter

import pytest

from convlens.llm import phrases


def brute(rows, least, longest=5, top=2000, absorb=100):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            c = counts.setdefault(lang, Counter())
            c.update(tuple(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            inside = lambda q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= absorb * a and inside(q) for q, b in found.items()):
                continue
            score, _, left, right = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(4)
    words = ["a", "B", "the", "é", "ñandú", "x y", "\x00", "long", "New", "York", "|"]
    rows = [(rnd.choice(["en", "de", None, "und"]), "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!"]) for _ in range(rnd.randint(0, 120))))
            for _ in range(150)]
    return [*rows, ("en", None), ("en", ""), (None, "  . ,"), ("xx", "one two"), *[("en", "of the many of the many of the many")] * 30]


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("options", [{}, {"block_bytes": 200, "budget": 1, "bucket_words": 10}, {"budget": 5, "top": 7}, {"absorb_percent": 60, "block_bytes": 3000, "budget": 40}, {"budget": 100, "longest": 3}, {"longest": 2, "budget": 1}])
def test_equals_brute_force(spark, corpus, options):
    df = spark.createDataFrame([(l, t, "c", 1) for l, t in corpus], "lang string, text string, block string, id int")
    want = brute(corpus, 8, options.get("longest", 5), options.get("top", 2000), options.get("absorb_percent", 100))
    assert len(want) > 20
    assert got(phrases.collocations(df, least=8, **options)) == want


def test_long_texts_go_in_chunks(spark, monkeypatch):
    words = phrases.Words()
    whole = [w for part in words.numbers("aa bb. cc  dd" * 50) for w in part.tolist()]
    monkeypatch.setattr(phrases, "CHUNK", 7)
    again = phrases.Words()
    parts = list(again.numbers("aa bb. cc  dd" * 50))
    assert len(parts) > 10 and [w for part in parts for w in part.tolist()] == whole and again == words


def test_products_beyond_64_bits(spark):
    ids = spark.createDataFrame([([1, 2], 4 * 10 ** 15, "en", 10 ** 17)], "phrase array<bigint>, f bigint, lang string, n bigint")
    words = spark.createDataFrame([(1, 7 * 10 ** 15), (2, 9 * 10 ** 15)], "id bigint, f bigint")
    assert phrases._scored(ids, words).first().score == 1000 * 4 * 10 ** 15 * 10 ** 17 // (63 * 10 ** 30)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).collect() == []
    assert phrases.collocations(spark.createDataFrame([("en", "a b"), (None, None)], "lang string, text string")).collect() == []


def test_query_equals_brute_force(spark, sf):
    from convlens.llm.queries import op12_phrases
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = op12_phrases(spark, sf)
    assert dict(df.dtypes) == {"lang": "string", "phrase": "string"} | dict.fromkeys(("rank", "a", "l", "r", "n", "score"), "bigint")
    assert got(df) == brute(rows, 100)
