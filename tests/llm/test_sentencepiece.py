import os
import random
import struct
import unicodedata

import pytest

from convlens.llm.sentencepiece_fst import BPE, BYTE, CONTROL, UNIGRAM, UNKNOWN, USER, Decoder, Encoder, Normaliser, decode, encode, read_model

PATH = "/opt/tokenizers/piece_bpe_32k.model"
needs_file = pytest.mark.skipif(not os.path.exists(PATH), reason="the vocabulary file is not here")


@pytest.fixture(scope="module")
def model():
    return read_model(PATH)


@needs_file
def test_equals_the_library(spark, sf, model):
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PATH)
    rng = random.Random(3)
    texts = ["", " ", "  a", "a  b\n ñ ẞ 漢字 \U0001F600", "a▁b", "<0x41></s>", "0" * 50, "=====---"]
    texts += ["".join(rng.choice("ab ethi▁\nñé漢x.=-0") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    e, d = Encoder(model), Decoder(model)
    for t in texts:
        assert e.encode(t).tolist() == lib.encode(t)
        assert d.decode(lib.encode(t)) == lib.decode(lib.encode(t)) == t.replace("▁", " ")
    for _ in range(500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 0, 1, 2]) for _ in range(rng.randint(0, 12))]
        assert d.decode(ids) == lib.decode(ids)


@needs_file
def test_neighbours_are_those_of_merging(model):
    e, rng = Encoder(model), random.Random(8)
    usable = [k for k, (p, _, kind) in enumerate(e.pieces) if kind == 1 and e.merged(p) == [p]]
    assert [k for k, (p, _, kind) in enumerate(e.pieces) if kind == 1 and e.builds(p)] == usable
    by_first = {}
    for k in usable:
        by_first.setdefault(e.pieces[k][0][0], []).append(k)
    same = [k for k in usable if len(set(e.pieces[k][0])) == 1]
    pairs = [(rng.choice(usable), rng.choice(usable)) for _ in range(4000)] + [(a, b) for a in same for b in by_first[e.pieces[a][0][0]][:40]]
    for a, b in pairs:
        one, two = e.pieces[a][0], e.pieces[b][0]
        assert e.accepts(a, b) == (e.merged(one + two) == [one, two]), (one, two)


@needs_file
def test_query_round_trip(spark, sf):
    from convlens.llm.queries import op3_sentencepiece
    rows = op3_sentencepiece(spark, sf, PATH).collect()
    assert rows and all(r.round_trip and r.n_ids == len(r.ids) for r in rows)


def message(*fields):
    """A protocol buffer message of (number, value) fields; whole numbers, 32-bit floats, bytes and strings."""
    def number(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + number(n >> 7)
    out = b""
    for key, value in fields:
        if isinstance(value, float):
            out += number(key << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += number(key << 3) + number(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += number(key << 3 | 2) + number(len(value)) + value
    return out


def odd_texts(rng, extra=()):
    letters = [*"ab eth  i\t\nñé漢ﬁ①ＡｶﾞÅ½­​̈́가각힣İ", *extra]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(700)]
    return ["", " ", "a▁", "▁", *words, *(unicodedata.normalize("NFD", w) for w in words[:200]), "x" + "é" * 3000]


@pytest.mark.parametrize("name", ["nmt_nfkc", "nfkc", "nfkc_cf", "nmt_nfkc_cf"])
@needs_file
def test_precompiled_character_maps_and_user_pieces_equal_the_library(tmp_path, name):
    """The given vocabulary under the normalisers that public models carry, and with pieces of the user's own."""
    spm = pytest.importorskip("sentencepiece")
    spec = spm.SentencePieceNormalizer(rule_name=name).serialized_normalizer_spec()
    with open(PATH, "rb") as f:
        raw = f.read()
    own = ["<call>", "ethi", "é漢", "①Ａ", "a b", "<call>>"]
    for users in ([], own):
        more = raw + message((3, spec), (3, message((4, 1)))) + b"".join(message((1, message((1, p), (2, 0.0), (3, USER)))) for p in users)
        path = tmp_path / f"{name}{len(users)}.model"
        path.write_bytes(more)
        lib, e = spm.SentencePieceProcessor(model_proto=more), Encoder(read_model(str(path)))
        for t in odd_texts(random.Random(len(users)), users):
            assert e.encode(t).tolist() == lib.encode(t), (t, users)


@pytest.mark.parametrize("collapse", [0, 1])
def test_unigram_with_user_pieces_equals_the_library(tmp_path, collapse):
    spm = pytest.importorskip("sentencepiece")
    rng = random.Random(collapse)
    words = sorted({"".join(rng.choice("abeti") for _ in range(rng.randint(2, 5))) for _ in range(60)} | {*"abethiñ▁", "▁a", "▁et", "ab▁"})
    pieces = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL), *((w, -1 - 9 * rng.random(), 1) for w in words),
              ("thi", 0.0, USER), ("ﬁ", 0.0, USER)]
    spec = spm.SentencePieceNormalizer(rule_name="nfkc").serialized_normalizer_spec()
    raw = b"".join(message((1, message((1, p), (2, w), (3, kind)))) for p, w, kind in pieces)
    raw += message((2, message((3, UNIGRAM))), (3, spec), (3, message((4, collapse))))
    path = tmp_path / "m.model"
    path.write_bytes(raw)
    lib, e = spm.SentencePieceProcessor(model_proto=raw), Encoder(read_model(str(path)))
    for t in odd_texts(rng, ["thi", "et"]):
        assert e.normalise(t) == lib.normalize(t)
        assert e.encode(t).tolist() == lib.encode(t), t


def test_normaliser_reads_the_longest_left_side():
    """Against a plain reading: at each position kept strings, then left sides, the longest first."""
    rng = random.Random(2)
    some = lambda n: "".join(rng.choice("abc[]^-") for _ in range(rng.randint(1, n)))
    for _ in range(200):
        rules, kept = {some(4): some(3) * rng.randint(0, 1) for _ in range(5)}, [some(3) for _ in range(rng.randint(0, 2))]
        text, want, i = some(40), "", 0
        while i < len(text):
            left = next((x for side in (kept, rules) for x in sorted(side, key=len, reverse=True) if text.startswith(x, i)), None)
            want += text[i] if left is None else left if left in kept else rules[left]
            i += len(left or "x")
        assert Normaliser(rules, kept)(text) == want


def all_segmentations(text, pieces):
    if not text:
        yield []
    for n in range(1, len(text) + 1):
        if text[:n] in pieces:
            for rest in all_segmentations(text[n:], pieces):
                yield [text[:n], *rest]


def test_unigram_path_is_the_lightest():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(30)} | set("abc"))
    pieces = [("<unk>", 0.0, UNKNOWN)] + [(w, -rng.random() * 5 - 1, 1) for w in words]
    model = {"pieces": pieces, "kind": UNIGRAM, "unknown": " ⁇ ", "prefix": False, "collapse": False, "escape": True}
    score = {p: s for p, s, _ in pieces}
    e = Encoder(model)
    for _ in range(60):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
        best = max(sum(score[p] for p in seg) for seg in all_segmentations(text, set(words)))
        assert abs(sum(pieces[i][1] for i in e.encode(text)) - best) < 1e-9
    assert e.encode("azzb").tolist() == [*e.encode("a"), 0, *e.encode("b")]


def test_normaliser_rules_and_byte_fallback(spark):
    pieces = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL)] + [(f"<0x{b:02X}>", 0.0, BYTE) for b in range(256)]
    pieces += [("▁", -9.0, 1), ("a", -8.0, 1), ("▁a", -1.0, 1)]
    model = {"pieces": pieces, "kind": BPE, "unknown": " ⁇ ", "prefix": True, "collapse": True, "escape": True}
    df = spark.createDataFrame([(1, "  a   é "), (2, None), (3, ""), (4, "ａ")], "doc_id bigint, text string").selectExpr("*", "5 AS keys")
    got = {r.doc_id: r for r in decode(encode(df, model, rules={"ａ": "a"}), model).collect()}
    assert got[1].ids == [260, 258, 2 + 0xC3, 2 + 0xA9] and got[1].decoded == "a é"
    assert (got[2].ids, got[2].decoded) == (None, None) and (got[3].ids, got[3].decoded) == ([], "")
    assert got[4].ids == [260]
    assert encode(df.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        encode(df, model, ids_col="KEYS")
