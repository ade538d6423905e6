import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from convlens.llm import token_alignment

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def brute():
    """The contract's columns, read plainly with both libraries: every A token against every B token."""
    own_a, own_b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    own_a.encode_special_tokens = True
    back = token_alignment.byte_alphabet()

    def ends(pieces):
        out, at = [], 0
        for p in pieces:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    def run(texts):
        rows, held = [], defaultdict(set)
        for d, text in enumerate(texts):
            links, groups, a, b = Counter(), [], [], []
            if text:
                raw = (" " + text).encode()
                a = own_a.encode(" " + text, add_special_tokens=False).ids
                b = own_b.encode(text)
                bytes_a = [bytes(back[c] for c in own_a.id_to_token(i)) for i in a]
                bytes_b = [bytes([int(own_b.id_to_piece(i)[3:5], 16)]) if own_b.is_byte(i) else own_b.id_to_piece(i).replace("▁", " ").encode() for i in b]
                if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
                    a, b = [], []
                else:
                    ea, eb = ends(bytes_a), ends(bytes_b)
                    for i, (s, e) in zip(a, ea):
                        links.update((i, j) for j, (t, u) in zip(b, eb) if s < u and t < e)
                    low = 0
                    for e in sorted({e for _, e in ea} & {e for _, e in eb}):
                        groups.append("|".join(",".join(str(i) for i, (s, f) in zip(x, ex) if low <= s and f <= e) for x, ex in ((a, ea), (b, eb))))
                        low = e
            for pair in links:
                held[pair].add(d)
            rows.append((len(a), len(b), groups, links))
        best = defaultdict(int)
        for (i, _), docs in held.items():
            best[i] = max(best[i], len(docs))
        return [(na, nb, len(g), sum(x.values()), sum(n for p, n in x.items() if len(held[p]) == best[p[0]]),
                 sum(n * len(held[p]) for p, n in x.items()), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
                for na, nb, g, x in rows]

    return run


def columns(rows):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows}


def test_equals_brute_force(spark, brute):
    texts = ["the cat sat", "the cat sat", None, "", " ", "  two  spaces ", "a\n\nb\tc", "naïve café 東京 😀", "under▁score", "<|endoftext|> <s> </s> <0x41>",
             "x" * 300, "unbelievable, tokenization!", "\u0000null", "ÀÉ " * 40, "the cat sat on the mat", "  lead", "trail  ", "don't we'll 123 4567"]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, key string, n_a int")
    want = dict(enumerate(brute(texts)))
    assert columns(token_alignment.align(docs, A, B).collect()) == want
    # blocks of one text, texts cut at every place where they may be
    assert columns(token_alignment.align(docs, A, B, block_chars=1, segment_chars=1).collect()) == want


def test_query_equals_brute_force_on_documents(spark, sf, brute):
    from convlens.llm.queries import op11_alignment
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").where("n_chars < 3000").collect()]
    some = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = dict(zip([d for d, _ in docs], brute([t for _, t in docs])))
    assert columns(token_alignment.align(some, A, B, block_chars=20_000, segment_chars=500).collect()) == want
    got = op11_alignment(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert dict(got.dtypes) == {"doc_id": "bigint", "groups_sha256": "string"} | dict.fromkeys(("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), "bigint")


def test_long_texts_repeated_rows_and_empty_tables(spark, brute):
    long = "lorem ipsum, dolor sit amet " * 3000
    docs = spark.createDataFrame([(1, long), (1, long), (None, "lorem ipsum"), (2, "lorem ipsum")], "doc_id bigint, text string")
    cut = token_alignment.align(docs, A, B, segment_chars=1000, block_chars=10_000)
    whole = token_alignment.align(docs, A, B)
    rows = sorted(map(tuple, cut.collect()), key=str)
    assert rows == sorted(map(tuple, whole.collect()), key=str) and len(rows) == 4 and rows[0] == rows[1]
    short = dict(zip((None, 2), brute(["lorem ipsum"] * 2)))
    assert columns(token_alignment.align(docs.where("text = 'lorem ipsum'"), A, B).collect()) == short
    assert token_alignment.align(docs.limit(0), A, B).collect() == []
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert columns(token_alignment.align(none, A, B).collect()) == {1: (0, 0, 0, 0, 0, 0, ""), 2: (0, 0, 0, 0, 0, 0, "")}


def test_other_vocabularies_go_through_their_own_library():
    import json
    spec = json.load(open(A))
    spec["model"]["merges"] = spec["model"]["merges"][1:] + spec["model"]["merges"][:1]  # no longer in the order of ids
    own = token_alignment.ByteBpe(json.dumps(spec).encode())
    ids = own.encode(" the cat sat <|endoftext|>")
    assert b"".join(own.bytes[i] for i in ids) == b" the cat sat <|endoftext|>"
