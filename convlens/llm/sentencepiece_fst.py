"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file: the normaliser (the rules of its precompiled character map, white space to ``▁``,
the leading space), the pieces (a trie whose accepting paths emit a piece's id at its weight), and byte fallback (for characters that no piece covers, their
UTF-8 bytes as byte pieces, or the unknown piece). Each text is composed with them and the path of least weight in the tropical
semiring is taken, over character positions from left to right.

In a unigram model a piece weighs minus its score. In a BPE model scores are merge ranks, so a sum of them says nothing; there the
pieces are further composed with an acceptor of neighbours: two pieces may follow each other (weight 0, else infinite) if merging
their characters by rank gives just these two. A sequence whose neighbours are all accepted is the one that merging gives, so
exactly one path of finite weight is left and it is SentencePiece's own result.

User-defined pieces are copied by the normaliser, the longest one at each position. In a BPE model they stand alone, and what is
between them is encoded for itself; in a unigram model they weigh 0.1 (less, by their bytes, where scores are above zero).

A text is cut where no piece of more than one character reaches across (before a run of spaces): the composition falls
apart there, and paths of repeated parts are kept for reuse in a bounded table. Defined results: a null text gives null ids; an
empty text gives none; control pieces are never made from text; decoding turns unknown ids into the model's unknown
surface, malformed byte runs into U+FFFD and drops control pieces; null ids give a null text.
"""

from __future__ import annotations

import hashlib
import re
import struct
import sys
import types
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructType

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def per_process(key: tuple | None, make):
    """``make()``, once per worker process: later tasks of a reused worker find it again. No key: made anew."""
    if key is None:
        return make()
    kept = sys.modules.setdefault("_convlens_llm_kept", types.ModuleType("_convlens_llm_kept")).__dict__.setdefault("table", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        width = {0: None, 1: 8, 5: 4}.get(key & 7, -1)
        if width is None:
            yield key >> 3, varint()
            continue
        width = varint() if width < 0 else width
        yield key >> 3, data[at:at + width]
        at += width


def read_model(path: str) -> dict:
    """What encoding needs of a SentencePiece model file, as plain values."""
    with open(path, "rb") as f:
        raw = f.read()
    fields = list(_fields(raw))
    pieces = []
    for v in (v for k, v in fields if k == 1):
        p = dict(_fields(v))
        pieces.append((p.get(1, b"").decode(), struct.unpack("<f", p[2])[0] if 2 in p else 0.0, p.get(3, NORMAL)))
    trainer = dict(_fields(next((v for k, v in fields if k == 2), b"")))
    norm = dict(_fields(b"".join(v for k, v in fields if k == 3)))  # a message given in parts
    if trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return {"key": hashlib.sha1(raw).hexdigest(), "pieces": pieces, "kind": trainer.get(3, UNIGRAM), "unknown": trainer.get(44, b" \xe2\x81\x87 ").decode(),
            "prefix": bool(norm.get(3, 1)), "collapse": bool(norm.get(4, 1)), "escape": bool(norm.get(5, 1)),
            "map": norm.get(2, b"")}


class Tree:
    """Left sides of rules as a tree by character, with the right side where one ends."""

    def __init__(self, rules: dict[str, str]):
        self.root: dict[str, list] = {}
        self.lefts = [left for left in rules if left]
        for left in self.lefts:
            node = self.root
            for c in left:
                arc = node.setdefault(c, [{}, None])
                node = arc[0]
            arc[1] = rules[left]

    def begins(self) -> set[str]:
        """The left sides' first one or two characters."""
        return {left[:2] for left in self.lefts}

    def longest(self, text: str, i: int) -> tuple[int, str] | None:
        """The end and the right side of the longest left side that begins at position i."""
        node, found = self.root, None
        for j in range(i, len(text)):
            if (arc := node.get(text[j])) is None:
                break
            node = arc[0]
            if arc[1] is not None:
                found = j + 1, arc[1]
        return found


class CharacterMap:
    """The same of a precompiled character map, used as it is stored: the size of a double-array tree over UTF-8 bytes, its units of 32
    bits, then the right sides, each ended by a zero byte. A unit holds its byte, the way to its children and whether a value is one of them."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
        self.rights = blob[4 + size:]
        self.bytes_of = units & 0x800000FF
        self.children = np.where(units & 0x200, units >> 10 << 8, units >> 10)
        self.steps = list(zip(self.bytes_of.tolist(), self.children.tolist(), (units >> 8 & 1).tolist(), (units & 0x7FFFFFFF).tolist()))

    def begins(self) -> set[str]:
        width = lambda byte: 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
        some_byte, out = np.arange(1, 256), set()
        nodes = [(b"", int(self.children[0]))] if self.steps else []
        while nodes:
            block, nodes = nodes[-4096:], nodes[:-4096]
            at = np.array([base for _, base in block])[:, None] ^ some_byte
            rows, cols = np.nonzero((at < len(self.steps)) & (self.bytes_of[np.minimum(at, len(self.steps) - 1)] == some_byte))
            for r, k in zip(rows.tolist(), at[rows, cols].tolist()):
                byte, child, ends, _ = self.steps[k]
                left = block[r][0] + bytes([byte])
                one = width(left[0])
                if ends and len(left) == one:
                    out.add(left.decode())
                if len(left) > one and len(left) == one + width(left[one]):
                    out.add(left.decode())
                else:
                    nodes.append((left, k ^ child))
        return out

    def longest(self, text: str, i: int) -> tuple[int, str] | None:
        steps, found = self.steps, None
        base = steps[0][1] if steps else 0
        for j in range(i, len(text)):
            for byte in text[j].encode("utf-8", "surrogatepass"):
                k = base ^ byte
                if not byte or k >= len(steps) or steps[k][0] != byte:
                    return found
                base = k ^ steps[k][1]
            if steps[k][2]:
                begin = steps[base][3]
                found = j + 1, self.rights[begin:self.rights.index(0, begin)].decode()
        return found


class Normaliser:
    """Rewriting rules as a machine. At each position the longest kept string that begins there is copied; else the longest left side is
    read (of the given rules before the model's map) and its right side written; else one character is copied."""

    def __init__(self, rules: dict[str, str], kept: Iterable[str] = (), blob: bytes = b""):
        self.machines = [Tree({k: k for k in kept}), Tree(rules), *([CharacterMap(blob)] if blob else [])]
        begins = set().union(*(machine.begins() for machine in self.machines))
        one_of = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]"
        singles, pairs = {x for x in begins if len(x) == 1}, [x for x in begins if len(x) == 2]
        starts = [one_of(singles)] if singles else []
        starts += [f"{one_of({x[0] for x in pairs})}(?={one_of({x[1] for x in pairs})})"] if pairs else []
        #: where a left side may begin; all else is copied in runs
        self.starts = re.compile("|".join(starts)) if starts else None

    def __call__(self, text: str) -> str:
        if self.starts is None:
            return text
        out, at = [], 0
        while found := self.starts.search(text, at):
            i = found.start()
            end, new = next(filter(None, (machine.longest(text, i) for machine in self.machines)), (i + 1, text[i]))
            out += text[at:i], new
            at = end
        return "".join([*out, text[at:]])


class Encoder(dict):
    """The composed transducer. As a mapping it keeps the ids (32 bits each, as bytes) of parts of texts already composed."""

    def __init__(self, model: dict, rules: dict[str, str] | None = None, keep: int = 200_000):
        super().__init__()
        self.older: dict[str, bytes] = {}  # the parts kept before: those used again are taken over
        self.pieces, self.kind, self.keep, self.model = model["pieces"], model["kind"], keep, model
        users = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == USER}
        self.rewrite = Normaliser(rules or {}, users, model.get("map", b""))
        self.ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL or (kind == USER and self.kind == UNIGRAM)}
        self.users = users if self.kind == BPE else {}
        self.alone = re.compile("(" + "|".join(map(re.escape, sorted(users, key=len, reverse=True))) + ")") if self.users else None
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.worst = min((s for _, s, kind in self.pieces if kind == NORMAL), default=0.0) - 10.0
        best = max((s for _, s, kind in self.pieces if kind == NORMAL and s > 0), default=0.0)
        self.weights = [0.1 - len(p.encode()) * best if kind == USER else -s for p, s, kind in self.pieces]
        self.follows: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}  # of a piece that merging builds: the two that its last merge joins
        usable = self.ids if self.kind == UNIGRAM else [p for p in self.ids if self.builds(p)]
        self.trie: dict[str, list] = {}  # by character: the next node and the id of the piece that ends there, or -1
        for piece in usable:
            node = self.trie
            for c in piece:
                arc = node.setdefault(c, [{}, -1])
                node = arc[0]
            arc[1] = self.ids[piece]
        usable = set(usable)
        # the longest shorter piece that a piece begins with, or -1
        self.shorter = [next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in usable), -1) if p in usable else -1
                        for p, _, _ in self.pieces]
        self.length = [len(p) for p, _, _ in self.pieces]
        self.longest = max(map(len, usable), default=1)
        inner = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(b == SPACE and a != SPACE for a, b in inner):
            self.cut = re.compile(r".+", re.DOTALL)
        elif any("\n" in pair for pair in inner):
            self.cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        else:
            self.cut = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")

    def merged(self, text: str) -> list[str]:
        """Characters merged by rank, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                if (k := self.ids.get(parts[i] + parts[i + 1])) is not None and (best is None or self.pieces[k][1] > best):
                    best, at = self.pieces[k][1], i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def builds(self, piece: str) -> bool:
        """Whether merging the piece's characters gives the piece; notes its halves."""
        parts = list(piece)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                if (k := self.ids.get(parts[i] + parts[i + 1])) is not None and (best is None or self.pieces[k][1] > best):
                    best, at = self.pieces[k][1], i
            if best is None:
                return False
            if len(parts) == 2:
                self.halves[self.ids[piece]] = self.ids[parts[0]], self.ids[parts[1]]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return True

    def accepts(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a in a BPE model: whether no merge across their border would have come first.

        Merges are taken back one after another, the latest first, which bares ever smaller pieces at the border; a merge of what
        was bared must not have come before the one taken back. Of equal merges the left one comes first."""
        known = self.follows.get(a << 24 | b)
        if known is None:
            if len(self.follows) >= self.keep:
                self.follows.clear()
            pieces, ids, halves = self.pieces, self.ids, self.halves
            one, two, limit, strict = a, b, float("-inf"), True
            while True:
                across = ids.get(pieces[one][0] + pieces[two][0])
                if across is not None and (pieces[across][1] > limit or (not strict and pieces[across][1] == limit)):
                    known = False
                    break
                left, right = halves.get(one), halves.get(two)
                if left is None and right is None:
                    known = True
                    break
                if right is None or (left is not None and pieces[one][1] < pieces[two][1]):
                    limit, strict, one = pieces[one][1], True, left[1]
                else:
                    limit, strict, two = pieces[two][1], False, right[0]
            self.follows[a << 24 | b] = known
        return known

    def _match(self, part: str, i: int) -> int:
        """The longest piece from position i; the others follow by ``shorter``."""
        node, found = self.trie, -1
        for c in part[i:i + self.longest]:
            arc = node.get(c)
            if arc is None:
                break
            node, k = arc
            if k >= 0:
                found = k
        return found

    def _fallback(self, c: str) -> list[int]:
        return [self.bytes[b] for b in c.encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]

    def _only_path(self, part: str) -> list[int]:
        """BPE: the one path of finite weight. Depth first, longest piece first; what comes before a position is the
        same on every accepted path, so a position that led nowhere is not tried again."""
        n, i, before, dead = len(part), 0, -1, set()
        trie, longest, length, shorter, follows = self.trie, self.longest, self.length, self.shorter, self.follows
        path: list[tuple[int, int, int]] = []  # position, piece before it, piece taken (-1: fallback)
        forward = True
        while i < n:
            if forward:  # the longest piece from here; the others follow by ``shorter``
                node, k = trie, -1
                for c in part[i:i + longest]:
                    if (arc := node.get(c)) is None:
                        break
                    node = arc[0]
                    if arc[1] >= 0:
                        k = arc[1]
            while k >= 0:
                if before < 0 or (ok := follows.get(before << 24 | k)) or (ok is None and self.accepts(before, k)):
                    if not dead or (i + length[k]) not in dead:
                        break
                k = shorter[k]
            if k < 0 and part[i] in self.ids:
                dead.add(i)
                i, before, k = path.pop()
                k = shorter[k]
                forward = False
                continue
            path.append((i, before, k))
            # without a piece: the character's bytes, next to which everything is accepted
            i, before, forward = i + (length[k] if k >= 0 else 1), k, True
        out: list[int] = []
        for at, _, k in path:
            if k >= 0:
                out.append(k)
            elif self.bytes or not out or out[-1] != self.unknown:
                out.extend(self._fallback(part[at]))
        return out

    def _least_path(self, part: str) -> list[int]:
        """Unigram: per position the least weight, the piece that ends there and where that begins."""
        n = len(part)
        weight, last, start = [0.0] + [float("inf")] * n, [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            arcs, k = [], self._match(part, i)
            while k >= 0:
                arcs.append((i + self.length[k], k))
                k = self.shorter[k]
            if not arcs or arcs[-1][0] != i + 1:
                arcs.append((i + 1, -1))
            for j, k in arcs:
                w = weight[i] + (self.weights[k] if k >= 0 else -self.worst)
                if w < weight[j]:
                    weight[j], last[j], start[j] = w, k, i
        out: list[int] = []
        j = n
        while j:
            if last[j] >= 0:
                out.append(last[j])
            elif self.bytes or not out or out[-1] != self.unknown:
                out.extend(reversed(self._fallback(part[start[j]])))
            j = start[j]
        out.reverse()
        return out

    def __missing__(self, part: str) -> bytes:
        out = self.older.get(part)
        if out is None:
            out = array("i", self._only_path(part) if self.kind == BPE else self._least_path(part)).tobytes()
        if len(self) >= self.keep:
            self.older = dict(self)
            self.clear()
        if len(part) <= 64:
            self[part] = out
        return out

    def normalise(self, text: str) -> str:
        some = bool(text)
        text = self.rewrite(text)
        if self.model["collapse"]:
            text = re.sub(" +", " ", text.strip(" "))
            some = bool(text)
        if some and self.model["prefix"]:
            text = " " + text
        if self.model["escape"]:
            text = text.replace(" ", SPACE)
        if self.model["collapse"]:  # also one that stood in the text
            text = text.rstrip(SPACE if self.model["escape"] else " ")
        return text

    def encode(self, text: str) -> np.ndarray:
        text = self.normalise(text)
        if self.alone:
            parts = []
            for i, some in enumerate(self.alone.split(text)):
                parts.append(array("i", [self.users[some]]).tobytes() if i % 2 else b"".join(map(self.__getitem__, self.cut.findall(some))))
            return np.frombuffer(b"".join(parts), np.int32)
        parts = self.cut.findall(text)
        return np.frombuffer(b"".join(map(self.__getitem__, parts)), np.int32)


class Decoder:
    """The inverse machine: ids to text."""

    def __init__(self, model: dict):
        self.prefix = model["prefix"] or model["collapse"]
        surface = {UNKNOWN: model["unknown"], CONTROL: ""}
        # an ASCII byte is a character by itself
        self.text = [chr(int(p[1:-1], 16)) if kind == BYTE and int(p[1:-1], 16) < 128 else surface.get(kind, p.replace(SPACE, " ")) if kind != BYTE else None for p, _, kind in model["pieces"]]
        self.byte = {i: int(p[1:-1], 16) for i, (p, _, kind) in enumerate(model["pieces"]) if kind == BYTE}
        self.plain = np.array([t is not None for t in self.text])
        self.unknown = model["unknown"]
        self.spaced = {i for i, (p, _, kind) in enumerate(model["pieces"]) if p.startswith(SPACE) and kind not in (UNKNOWN, CONTROL, BYTE)}

    def decode(self, ids: list[int] | np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        if len(ids) and ids.min() >= 0 and ids.max() < len(self.text) and self.plain[ids].all():
            ids = ids.tolist()
            first = next((k for k, i in enumerate(ids) if self.text[i]), len(ids))
            text = "".join(map(self.text.__getitem__, ids))
            return text[1:] if self.prefix and first < len(ids) and ids[first] in self.spaced else text
        out, run = [], bytearray()
        for i in ids.tolist():
            piece = self.text[i] if 0 <= i < len(self.text) else self.unknown
            if piece is None:
                run.append(self.byte[i])
                continue
            if run:
                out.append(self._bytes(run))
                run.clear()
            if piece:
                # the leading space is only that of a first piece from the text
                out.append(piece[1:] if self.prefix and not out and i in self.spaced else piece)
        if run:
            out.append(self._bytes(run))
        return "".join(out)

    @staticmethod
    def _bytes(run: bytearray) -> str:
        """Every byte that is no part of a character counts as one U+FFFD."""
        out, raw = [], bytes(run)
        while raw:
            try:
                out.append(raw.decode())
                break
            except UnicodeDecodeError as e:
                out.append(raw[:e.start].decode() + "�")
                raw = raw[e.start + 1:]
        return "".join(out)


def _with_column(df: DataFrame, source: str, out: str, kind: DataType, make) -> DataFrame:
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out} exists already; pass another name")
    at, names = df.columns.index(source), [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = make()
        for batch in batches:
            for i in range(0, batch.num_rows, 512):  # a few rows at a time: their strings and ids are what takes memory
                some = batch.slice(i, 512)
                yield pa.RecordBatch.from_arrays([*some.columns, convert(some.column(at))], names)

    return df.mapInArrow(run, StructType(list(df.schema.fields)).add(out, kind))




def encode(df: DataFrame, model: dict, text_col: str = "text", ids_col: str = "ids", rules: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the ids of the whole text."""
    held = df.sparkSession.sparkContext.broadcast(model)  # the vocabulary: as large as the model file

    def make():
        key = ("encoder", held.value["key"], str(rules)) if "key" in held.value else None
        encoder = per_process(key, lambda: Encoder(held.value, rules))

        def convert(texts: pa.Array) -> pa.Array:
            ids = [None if (t := x.as_py()) is None else encoder.encode(t) for x in texts]
            ends = np.cumsum([0, *(0 if x is None else len(x) for x in ids)]).astype(np.int32)
            flat = np.concatenate([*(x for x in ids if x is not None), np.empty(0, np.int32)])
            none = pa.array([x is None for x in ids]) if any(x is None for x in ids) else None
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()), mask=none)

        return convert

    return _with_column(df, text_col, ids_col, ArrayType(IntegerType()), make)


def decode(df: DataFrame, model: dict, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def make():
        key = ("decoder", held.value["key"]) if "key" in held.value else None
        decoder = per_process(key, lambda: Decoder(held.value))

        def convert(ids: pa.Array) -> pa.Array:
            return pa.array([None if not x.is_valid else decoder.decode(x.values.to_numpy()) for x in ids], pa.string())

        return convert

    return _with_column(df, ids_col, text_col, StringType(), make)
