"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled whole, so that equal ones meet; each distinct text is encoded by a byte-level BPE (A) and a SentencePiece model
(B) and aligned once, and its pair counts weigh as many documents as hold it. Three steps follow:

1. Distinct texts are aligned in blocks of a few megabytes. A block is one row: its texts' measures, the A-B id pairs linked in each
   (how often), and the block's own table of distinct pairs with the number of documents that hold each.
2. Those tables are summed per pair over the corpus, and each A id's highest count is found.
3. Each block's pairs get their sums back (a join of block tables, not of links), its texts' measures are completed and
   joined to the documents by the text's SHA-256.

So what is shuffled are distinct texts, distinct pairs per block and narrow rows; nothing is broadcast but the two tokenizer files.
A hot text is counted before the shuffle; a text is one row in step 1 however many documents hold it.

Token bytes: an A entry is decoded from the byte-level alphabet; a B piece is its UTF-8 with U+2581 as space, <0xHH> is that byte.
Both are laid over ``space + text``. A group ends wherever tokens of both end. Two tokens are linked if their bytes overlap, so
a group of p and q tokens has p + q - 1 links.

Texts above ``segment_chars`` are cut where a single space stands between two other characters and no piece of B reaches across: there
a token of both ends for sure, so segments are encoded one after another and memory stays bounded. A long text without such a
place (no spaces at all) is one segment.

Defined results: a null or empty text, or one whose bytes A or B does not give back (U+2581 in the text, unknown pieces), has no tokens:
zeros and an empty string for ``groups_sha256``; it adds to no count. Special tokens' strings are plain text. Rows with equal
or null ids are rows of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convlens.llm.blocks import looked_up
from convlens.llm.common import materialize
from convlens.llm.sentencepiece_fst import per_process

SPACE = "▁"
# fixed value: how byte-level BPE of this kind cuts a text before it merges
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCKS = ("block bigint, keys array<binary>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, groups array<string>, "
          "ends array<int>, at binary, times binary, pairs array<bigint>, held array<bigint>")
MEASURES = "key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level BPE writes for each byte: itself where printable, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Tokenizer A from its JSON file. Merges whose order is that of the ids they give run as ranks, any others in the file's own library."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        self.bytes = [b""] * (max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))]) + 1)
        for word, i in vocab.items():
            self.bytes[i] = word.encode() if word in special else bytes(alphabet[c] for c in word)
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        before = spec.get("pre_tokenizer") or {}
        plain = (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel"
                 and before.get("use_regex", True) and not before.get("add_prefix_space") and all(a < b for a, b in zip(made, made[1:])))
        if plain:
            import tiktoken

            ranks = {self.bytes[i]: i for w, i in vocab.items() if w not in special}
            held = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda text: np.asarray(held.encode_to_numpy(text, disallowed_special=()), np.int64)
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_str(raw.decode())
            own.encode_special_tokens = True
            self.encode = lambda text: np.asarray(own.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """Tokenizer B from its model file."""

    def __init__(self, raw: bytes):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_proto=raw)
        pieces = [own.id_to_piece(i) for i in range(own.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if own.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.encode = lambda text: np.asarray(own.encode(text, num_threads=1), np.int64)
        self.cuts = not any(SPACE in p.lstrip(SPACE) for i, p in enumerate(pieces) if not own.is_control(i))


class Aligner:
    """Encodes and aligns batches of segments; each segment is (number of its text, text, whether it is the text's last)."""

    CUT = re.compile(r"(?<=[^\s]) (?=\w)")

    def __init__(self, raw_a: bytes, raw_b: bytes, segment_chars: int):
        self.a, self.b, self.segment_chars = ByteBpe(raw_a), Pieces(raw_b), segment_chars
        self.len_a, self.len_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        self.n_b = len(self.len_b)
        self.span = len(self.len_a) * self.n_b
        # each token as it is written, before a token of its own side and at a group's end
        self.written = [b"%d%s" % (i, s) for n, seps in ((len(self.len_a), (b",", b"|")), (self.n_b, (b",", b";"))) for i in range(n) for s in seps]

    def segments(self, text: str) -> Iterator[str]:
        at, n = 0, len(text)
        while self.b.cuts and n - at > self.segment_chars:
            cut = self.CUT.search(text, at + self.segment_chars)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:]

    def ids(self, segment: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Both encodings, or None if one does not give the bytes back."""
        raw, a, b = b" " + segment.encode(), self.a.encode(" " + segment), self.b.encode(segment)
        back = (b"".join(map(t.bytes.__getitem__, x.tolist())) == raw for t, x in ((self.a, a), (self.b, b)))
        return (a, b) if all(back) else None

    def align(self, found: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
        """Of encoded segments, each with its text's number: per segment the counts of groups and its groups as written (with a last
        separator); the texts, pairs and times of their links, by text and pair."""
        a, b = (np.concatenate([f[i] for f in found]) for i in (1, 2))
        size_a, size_b = (np.array([len(f[i]) for f in found]) for i in (1, 2))
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        last = np.searchsorted(end_b, end_a)  # the B token in which an A token's last byte lies
        ends_a = end_b[last] == end_a
        ends_b = np.zeros(len(b), bool)
        ends_b[last[ends_a]] = True
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        groups = int(ends_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)

        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = 2 * a + ends_a
        order[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = 2 * (len(self.len_a) + b) + ends_b
        stops = np.cumsum(size_a + size_b)
        written = [b"".join(map(self.written.__getitem__, order[i:j].tolist())) for i, j in zip([0, *stops[:-1]], stops)]
        n_groups = np.diff(np.concatenate([[0], np.cumsum(ends_a)[np.cumsum(size_a) - 1]]))

        first = np.searchsorted(end_b, end_a - self.len_a[a], side="right")
        links = last - first + 1
        text = np.repeat(np.array([f[0] for f in found]), size_a)
        to_b = np.arange(links.sum()) + np.repeat(first - (np.cumsum(links) - links), links)
        key, times = np.unique(np.repeat(text * self.span + a * self.n_b, links) + b[to_b], return_counts=True)
        return n_groups, written, key // self.span, key % self.span, times


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(values.astype(np.int32).tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.int32)


def _block(aligner: Aligner, number: int, rows: list[tuple[bytes, str, int]], block_chars: int) -> dict:
    """One row of BLOCKS for distinct texts (key, text, number of documents)."""
    n = len(rows)
    n_a, n_b, n_groups = (np.zeros(n, np.int64) for _ in range(3))
    hashes, bad, parts = [hashlib.sha256() for _ in rows], np.zeros(n, bool), []
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    waiting, size = [False] * n, 0  # whether a separator is still to be written

    def flush() -> None:
        nonlocal size
        if found:
            groups, written, *links = aligner.align(found)
            parts.append(links)
            for (t, a, b), g, w in zip(found, groups, written):
                n_a[t] += len(a)
                n_b[t] += len(b)
                n_groups[t] += g
                hashes[t].update((b";" if waiting[t] else b"") + w[:-1])
                waiting[t] = True
        found.clear()
        size = 0

    for t, (_, text, _) in enumerate(rows):
        for segment in aligner.segments(text):
            ids = aligner.ids(segment)
            if ids is None:
                bad[t] = True
                found[:] = [f for f in found if f[0] != t]
                break
            found.append((t, *ids))
            size += len(segment)
            if size >= block_chars:
                flush()
    flush()
    text, pair, times = (np.concatenate([p[i] for p in parts] or [np.empty(0, np.int64)]) for i in range(3))
    keep = ~bad[text]
    text, pair, times = text[keep], pair[keep], times[keep]
    if len(parts) > 1:  # a text's segments may lie in several batches
        key, back = np.unique(text * aligner.span + pair, return_inverse=True)
        text, pair, times = key // aligner.span, key % aligner.span, np.bincount(back, times, len(key)).astype(np.int64)
    pairs, at = np.unique(pair, return_inverse=True)
    documents = np.array([r[2] for r in rows], np.float64)
    zero = lambda x: np.where(bad, 0, x).tolist()
    return {"block": number, "keys": [r[0] for r in rows], "n_a": zero(n_a), "n_b": zero(n_b), "n_groups": zero(n_groups),
            "groups": ["" if x else h.hexdigest() for h, x in zip(hashes, bad)], "ends": np.searchsorted(text, np.arange(n), side="right").tolist(),
            "at": _pack(at), "times": _pack(times), "pairs": pairs, "held": np.bincount(at, documents[text], len(pairs)).astype(np.int64)}


def aligned_blocks(texts: DataFrame, a_raw: bytes, b_raw: bytes, block_chars: int, segment_chars: int) -> DataFrame:
    """Rows of BLOCKS from distinct texts (key, text, documents)."""
    held = texts.sparkSession.sparkContext.broadcast((a_raw, b_raw))  # two vocabularies: as large as their files
    schema = texts.sparkSession.createDataFrame([], BLOCKS).schema
    name = hashlib.sha1(a_raw + b_raw).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_process(("aligner", name, segment_chars), lambda: Aligner(*held.value, segment_chars))
        number, rows, size = TaskContext.get().partitionId() << 32, [], 0
        arrow = pa.schema([("block", pa.int64()), ("keys", pa.list_(pa.binary())), *((c, pa.list_(pa.int64())) for c in ("n_a", "n_b", "n_groups")),
                           ("groups", pa.list_(pa.string())), ("ends", pa.list_(pa.int32())), ("at", pa.binary()), ("times", pa.binary()),
                           ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int64()))])

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_block(aligner, number, rows, block_chars)], arrow)

        for b in batches:
            for key, text, documents in zip(*(b.column(c) for c in ("key", "text", "documents"))):
                rows.append((key.as_py(), text.as_py(), documents.as_py()))
                size += len(rows[-1][1])
                if size >= block_chars:
                    yield batch()
                    number, rows, size = number + 1, [], 0
        if rows:
            yield batch()

    return texts.select("key", "text", "documents").mapInArrow(run, schema)


def _completed(blocks: DataFrame) -> DataFrame:
    """MEASURES of each text of blocks whose pairs have been looked up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i] for c in b.schema.names}
                pairs = row["found"].values
                place = pairs.field("at").to_numpy()
                count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                count[place] = pairs.field("n").to_numpy()
                best[place] = pairs.field("best").to_numpy(zero_copy_only=False)
                at, times = _unpack(row["at"].as_py()), _unpack(row["times"].as_py()).astype(np.int64)
                ends = row["ends"].values.to_numpy()
                over = lambda x: np.diff(np.concatenate([[0], np.cumsum(np.concatenate([[0], x]))[ends]]))
                n_a, n_b, n_groups = (row[c].values.to_numpy() for c in ("n_a", "n_b", "n_groups"))
                yield pa.RecordBatch.from_arrays(
                    [row["keys"].values, *map(pa.array, (n_a, n_b, n_groups, n_a + n_b - n_groups, over(times * best[at]), over(times * count[at]))),
                     row["groups"].values], ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return blocks.mapInArrow(run, MEASURES)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          block_chars: int = 4 << 20, segment_chars: int = 1 << 20) -> DataFrame:
    """Per row of ``docs``: its id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        a_raw, b_raw = f.read(), g.read()
    key = F.unhex(F.sha2(F.encode(F.col(text_col), "utf-8"), 256))
    texts = (docs.where(F.col(text_col) != "").groupBy(F.col(text_col).alias("text")).agg(F.count(F.lit(1)).alias("documents"))
             .withColumn("key", F.unhex(F.sha2(F.encode("text", "utf-8"), 256))))
    blocks = materialize(aligned_blocks(texts, a_raw, b_raw, block_chars, segment_chars), "alignment-blocks")
    # an A id has no more partners than B has pieces, so its window is bounded
    n_b = len(Pieces(b_raw).bytes)
    sums = (blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
            .agg(F.sum("x.held").alias("n")).withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(F.expr(f"pair div {n_b}")))))
    counted = looked_up(blocks, "block", F.col("pairs"), "pair", sums, ["n", "best"])
    measures = _completed(counted.select("keys", "n_a", "n_b", "n_groups", "groups", "ends", "at", "times", "found"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return (docs.select(F.col(id_col).alias(id_col), key.alias("key")).join(measures, "key", "left")
            .select(id_col, *map(zero, ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                    F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))
