"""Removal of repeated byte strings by a sparse suffix array that is sorted deep-shallow.

A string of ``length`` bytes that starts at two places has the same bytes at both, so any rule that picks a place from the bytes alone
picks the same place inside both. The rule here: the least hash among the string's substrings of ``k`` bytes, the leftmost of
equals. Places picked are anchors, about one per (length - k) / 2 bytes; each string has exactly one. Steps:

1. Every text is scanned for its anchors; hashes that occur once are of no use, as no string around them repeats. The others
   mark a bitmap of 2 ** ``bits`` bits, all that is broadcast. (A bit set by chance, or a full bitmap, lets more anchors through; results stay.)
2. In a second scan each anchor let through gives its context: the bytes of all strings whose anchor it is. Equal contexts leave
   a task twice at most (twice tells that they repeat), so copies cost little.
3. Contexts are dealt out by their anchor's hash into buckets of ``bucket_bytes``. In each, the suffixes that begin at anchors, and the prefixes
   that end there, reversed, are sorted: multikey quicksort on eight bytes at a time to a shallow depth, then a blind
   trie for each group that is still together. With the common lengths of neighbours in both orders, strings at distance d
   before their anchors are equal if the suffixes share length - d bytes and the reversed prefixes share d.
   An anchor with more than ``hot_rows`` distinct contexts would make a bucket too large: its strings are counted one by one, by their
   128-bit hashes, in an aggregate that combines before its shuffle.
4. Repeated strings are joined back to their documents' places, united to runs, and cut out.

All of it is judged on the input, overlaps included, whole texts, whatever their length (a long one is scanned in parts that overlap).

Defined results: a null text counts as empty: nothing removed, the hash of no bytes. Repeated rows and ids are rows of their own (equal
texts of ``length`` bytes or more remove each other wholly). Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.llm.common import materialize, thinned
from convlens.llm.sentencepiece_fst import per_process

PART = 1 << 20  # bytes scanned at a time
PLACE = 22  # bits for a place in such a part
SHALLOW = 64
BASE = 0x9E3779B97F4A7C15 | 1
U = np.uint64


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.full(n, base, U)
        out[0] = 1
        return np.multiply.accumulate(out)

    return table(BASE), table(pow(BASE, -1, 1 << 64))


def hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each substring of ``k`` bytes."""
    up, down = per_process(("powers", PART), lambda: _powers(PART + (1 << 16))) if len(data) <= PART + (1 << 16) else _powers(len(data))
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[:len(data)], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[:len(sums) - k]
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        h ^= h >> U(shift)
        h *= U(factor)
    return h ^ (h >> U(32))


def anchors(data: np.ndarray, ends: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Of texts that lie one after another in ``data``: per anchor its place, the hash there, and the first and last start of its strings."""
    none = np.empty(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    long = ends - starts >= length
    if not long.any():
        return none, none.astype(U), none, none
    h = hashes(data, k)
    w = length - k + 1
    # the hash's upper bits with the place below them: the least is the leftmost of the least
    value = (h & ~U((1 << PLACE) - 1)) | np.arange(len(h), dtype=U)
    whole = np.full(-(-len(value) // w) * w, ~U(0), U)
    whole[:len(value)] = value
    before = np.minimum.accumulate(whole.reshape(-1, w), axis=1).ravel()
    after = np.minimum.accumulate(whole.reshape(-1, w)[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:len(value) - w + 1], before[w - 1:len(value)])
    inside = np.zeros(len(least) + 1, np.int8)
    inside[starts[long]] += 1
    inside[ends[long] - length + 1] -= 1
    start = np.flatnonzero(np.cumsum(inside[:-1]))
    place = (least[start] & U((1 << PLACE) - 1)).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (np.diff(start) != 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    return place[first], h[place[first]], start[first], start[last]


def _parts(column: pa.Array, keys: pa.Array, length: int) -> Iterator[tuple[bytes, np.ndarray, list[tuple[bytes, int]]]]:
    """Texts of a batch in parts of about PART bytes: the bytes, where texts end, and of each its key and where it begins in its text."""
    held: list[bytes] = []
    of: list[tuple[bytes, int]] = []
    size = 0
    for text, key in zip(column, keys):
        text = text.as_py()
        if len(text) < length:
            continue
        key = key.as_py()
        for at in range(0, len(text) - length + 1, PART):
            held.append(text[at:at + PART + length - 1])
            of.append((key, at))
            size += len(held[-1])
            if size >= PART // 2:
                yield b"".join(held), np.cumsum([len(x) for x in held]), of
                held, of, size = [], [], 0
    if held:
        yield b"".join(held), np.cumsum([len(x) for x in held]), of


def _repeated_hashes(texts: DataFrame, length: int, k: int) -> DataFrame:
    """The hashes (key) of anchors that occur more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, ends, _ in _parts(b.column("bytes"), b.column("doc"), length):
                key, n = np.unique(anchors(np.frombuffer(data, np.uint8), ends, length, k)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.minimum(n, 2))], ["key", "n"])

    found = texts.select("doc", "bytes").mapInArrow(run, "key bigint, n bigint")
    return found.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > 1).select("key")


def _bitmap(keys: DataFrame, bits: int) -> bytes:
    """The keys' lowest ``bits`` bits as a bitmap: its size is fixed, whatever the number of keys."""
    spot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    pages = (keys.select(F.shiftright(spot, 15).alias("page"), spot.bitwiseAND(F.lit(32767)).alias("spot"))
             .groupBy("page").agg(F.bitmap_construct_agg("spot").alias("bitmap")))
    out = bytearray(max(4096, 1 << (bits - 3)))
    for page, bitmap in pages.toLocalIterator():
        out[page * 4096:page * 4096 + len(bitmap)] = bitmap
    return bytes(out)


def _contexts(texts: DataFrame, length: int, k: int, bits: int, bitmap: bytes, most_known: int = 500_000) -> DataFrame:
    """Each occurrence of an anchor that may repeat: its document, place and context (null after a task has told it twice)."""
    held = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, told = np.frombuffer(held.value, np.uint8), {}
        for b in batches:
            for data, ends, of in _parts(b.column("bytes"), b.column("doc"), length):
                place, key, first, last = anchors(np.frombuffer(data, np.uint8), ends, length, k)
                spot = key & U((1 << bits) - 1)
                on = np.flatnonzero((bitmap[spot >> U(3)] >> (spot & U(7)).astype(np.uint8)) & 1)
                place, key, first, last = place[on], key[on], first[on], last[on]
                text = np.searchsorted(ends, place, side="right")
                begin = np.concatenate([[0], ends[:-1]])[text]
                ids, contexts = [], []
                for p, i, j in zip(place.tolist(), first.tolist(), last.tolist()):
                    context = data[i:j + length]
                    ids.append(hashlib.blake2b(context, digest_size=16, salt=(p - i).to_bytes(8, "big")).digest())
                    times = told.get(ids[-1], 0)
                    if times < 2:
                        if len(told) >= most_known:
                            told.clear()
                        told[ids[-1]] = times + 1
                    contexts.append(context if times < 2 else None)
                at = place - begin + np.array([o[1] for o in of], np.int64)[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([of[t][0] for t in text.tolist()], pa.binary()), pa.array(at), pa.array(key.view(np.int64)), pa.array(ids, pa.binary()),
                     pa.array((place - first).astype(np.int32)), pa.array(contexts, pa.binary())], ["doc", "at", "key", "id", "before", "context"])

    return texts.select("doc", "bytes").mapInArrow(run, "doc binary, at bigint, key bigint, id binary, before int, context binary")


class BlindTrie:
    """Strings of one width, as whole numbers, in a trie that knows only the bits at which they branch. A string is led down by those
    bits alone to some leaf, compared with it once, and put in where they first differ."""

    def __init__(self, width: int):
        self.bits, self.root = 8 * width, None

    def add(self, value: int, row: int) -> None:
        node = self.root
        if node is None:
            self.root = (value, [row])
            return
        while len(node) == 3:  # [bit from the right, where it is 0, where it is 1]
            node = node[2] if value >> node[0] & 1 else node[1]
        differ = value ^ node[0]
        if not differ:
            node[1].append(row)
            return
        bit = differ.bit_length() - 1
        parent, side, node = None, 0, self.root
        while len(node) == 3 and node[0] > bit:
            parent, side = node, 2 if value >> node[0] & 1 else 1
            node = node[side]
        leaf = (value, [row])
        new = [bit, node, leaf] if value >> bit & 1 else [bit, leaf, node]
        if parent is None:
            self.root = new
        else:
            parent[side] = new

    def walk(self) -> Iterator[tuple[int, int]]:
        """Rows in order, each with the number of whole bytes shared with the one before (the first: -1)."""
        stack, shared = [(self.root, -1)], -1
        while stack:
            node, shared = stack.pop()
            while len(node) == 3:
                stack.append((node[2], (self.bits - 1 - node[0]) // 8))
                node = node[1]
            for row in node[1]:
                yield row, shared
                shared = self.bits // 8


def deep_shallow(rows: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``rows`` (byte strings of one width) and how many bytes each shares with the one before it (the first: -1)."""
    n, width = rows.shape
    padded = np.zeros((n, -(-max(width, 1) // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(U)
    order, new = np.arange(n), np.zeros(n, bool)  # new: begins another group than the row before
    new[:1] = True
    levels = min(words.shape[1], shallow // 8)
    for level in range(levels):  # all groups that are still open are split at once by their next eight bytes
        group = np.cumsum(new)
        open_ = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(open_):
            break
        by = words[order[open_], level]
        sorted_ = np.lexsort((by, group[open_]))
        order[open_], by = order[open_][sorted_], by[sorted_]
        new[open_[1:]] |= by[1:] != by[:-1]
    depth = min(8 * levels, width)
    differ = padded[order[1:], :8 * levels] != padded[order[:-1], :8 * levels]
    shared = np.full(n, -1, np.int32)
    shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth) if 8 * levels else 0
    if depth < width:
        first = np.flatnonzero(new)
        sizes = np.diff(np.concatenate([first, [n]]))
        for i, m in zip(first[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            trie = BlindTrie(width - depth)
            for row in order[i:i + m].tolist():
                trie.add(int.from_bytes(rows[row, depth:].tobytes(), "big"), row)
            for j, (row, common) in enumerate(trie.walk(), i):
                order[j] = row
                if common >= 0:
                    shared[j] = depth + common
    return order, shared


def _classes(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of the rows' first ``depth`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < depth)
    return out


def repeated_runs(contexts: list[bytes], before: np.ndarray, times: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Of distinct contexts (how many bytes lie before the anchor, how often each is told): which context, and from and to which distance before
    its anchor strings start that start elsewhere too."""
    n, reach = len(contexts), length - k
    sizes = np.array([len(c) for c in contexts])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(contexts) + bytes(length), np.uint8)
    anchor = ends - sizes + before
    after, nearest = sizes - before, before + length - sizes  # bytes from the anchor on; the least distance

    def matrix(width: int, step: int, held: np.ndarray) -> np.ndarray:
        out = np.zeros((n, width), np.uint8)
        for lo in range(0, n, 4096):
            s = slice(lo, lo + 4096)
            at = np.arange(width)
            place = anchor[s, None] + (at if step > 0 else -1 - at)
            out[s] = np.where(at < held[s, None], data[np.clip(place, 0, len(data) - 1)], 0)
        return out

    right, left = deep_shallow(matrix(length, 1, after)), deep_shallow(matrix(reach, -1, before))
    most = []
    for order, shared in (right, left):
        m = np.empty(n, np.int32)
        m[order] = np.maximum(shared, np.concatenate([shared[1:], [-1]]))
        most.append(m)
    repeated = np.zeros((n, reach + 2), bool)
    for d in range(reach + 1):
        may = np.flatnonzero((nearest <= d) & (d <= before) & (most[0] >= length - d) & (most[1] >= d) & (times == 1))
        beside = np.flatnonzero((nearest <= d) & (d <= before) & (times > 1))
        repeated[beside, d] = True
        if len(may):
            rows = np.concatenate([may, beside])
            both = _classes(*right, length - d)[rows] * (n + 1) + _classes(*left, d)[rows]
            _, which, count = np.unique(both, return_inverse=True, return_counts=True)
            repeated[rows, d] |= count[which] > 1
    turn = np.diff(np.concatenate([np.zeros((n, 1), np.int8), repeated.astype(np.int8)], axis=1), axis=1)
    row, low = np.nonzero(turn == 1)
    return row, low, np.nonzero(turn == -1)[1] - 1


def _in_buckets(contexts: DataFrame, length: int, k: int, buckets: int) -> DataFrame:
    """Runs (id, low, high) of repeated strings of the contexts (id, key, before, context)."""
    def run(rows: pa.Table) -> pa.Table:
        first, times = {}, []
        for i, x in enumerate(rows.column("id").to_pylist()):
            if first.setdefault(x, (len(times), i))[0] == len(times):
                times.append(0)
            times[first[x][0]] += 1
        at = [i for _, i in first.values()]
        column = rows.column("context").take(pa.array(at, pa.int64())).to_pylist()
        which, low, high = repeated_runs(column, rows.column("before").to_numpy()[at].astype(np.int64), np.array(times), length, k)
        ids = list(first)
        return pa.table({"id": pa.array([ids[i] for i in which.tolist()], pa.binary()), "low": low.astype(np.int32), "high": high.astype(np.int32)})

    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
    return contexts.select("id", "before", "context", bucket.alias("bucket")).groupBy("bucket").applyInArrow(run, "id binary, low int, high int")


def _by_strings(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: every string is counted by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, before, context in zip(*(b.column(c).to_pylist() for c in ("id", "before", "context"))):
                n = len(context) - length + 1
                strings = [hashlib.blake2b(context[s:s + length], digest_size=16).digest() for s in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.binary()), pa.array(range(before, before - n, -1), pa.int32()),
                                                  pa.array(strings, pa.binary())], ["id", "low", "string"])

    strings = contexts.select("id", "before", "context").mapInArrow(run, "id binary, low int, string binary")
    more = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("string")
    return strings.join(more, "string").select("id", "low", F.col("low").alias("high")).distinct()


def _cut(texts: DataFrame) -> DataFrame:
    """Per text with repeated runs: how much is removed, in how many runs, and the hash of the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, text, runs in zip(*(b.column(c) for c in ("doc", "bytes", "runs"))):
                text, at, kept, removed, spans = text.as_py(), 0, hashlib.sha256(), 0, 0
                pairs = sorted((r["a"], r["b"]) for r in runs.as_py())
                end = -1
                for lo, hi in pairs:
                    if lo > end:  # a run of its own: the one before has ended
                        kept.update(text[at:lo])
                        spans += 1
                        at = lo
                    if hi > end:
                        removed += hi - max(lo, at)
                        at = end = hi
                kept.update(text[at:])
                rows.append((key.as_py(), removed, spans, kept.hexdigest()))
            yield pa.RecordBatch.from_pylist([dict(zip(("doc", "n_removed", "n_spans", "kept_sha256"), r)) for r in rows], schema=pa.schema(
                [("doc", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    return texts.select("doc", "bytes", "runs").mapInArrow(run, "doc binary, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", bits: int = 27,
                   bucket_bytes: int = 16 << 20, hot_rows: int = 100_000) -> DataFrame:
    """Per row of ``docs``: its id, n_bytes, n_removed, n_spans and the SHA-256 of what is left (kept_sha256)."""
    k = max(1, length // 6)
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    all_ = docs.select(F.col(id_col).alias("row_id"), raw.alias("bytes")).withColumn("doc", F.unhex(F.sha2("bytes", 256)))
    texts = all_.where(F.octet_length("bytes") >= length).select("doc", "bytes")
    bitmap = _bitmap(_repeated_hashes(texts, length, k), bits)
    found = materialize(_contexts(texts, length, k, bits, bitmap), "repeats-contexts")
    contexts = found.where(F.col("context").isNotNull())
    total = contexts.agg(F.sum(F.octet_length("context") + 64)).first()[0] or 0
    sizes = contexts.groupBy("key").count()
    several = sizes.where(F.col("count") > hot_rows).select("key")
    buckets = max(1, -(-total // bucket_bytes))
    if several.isEmpty():
        runs = _in_buckets(contexts, length, k, buckets)
    else:
        runs = (_in_buckets(contexts.join(several, "key", "left_anti"), length, k, buckets)
                .unionByName(_by_strings(contexts.join(several, "key", "left_semi"), length)))
    covered = (found.select("doc", "at", "id").join(runs, "id")
               .groupBy("doc").agg(F.collect_set(F.struct((F.col("at") - F.col("high")).alias("a"), (F.col("at") - F.col("low") + length).alias("b"))).alias("runs")))
    covered = materialize(covered, "repeats-runs")
    # one text of each that loses something; all others keep their own hash
    losing = thinned(texts, F.col("doc"), covered, F.col("doc")).groupBy("doc").agg(F.first("bytes").alias("bytes")).join(covered, "doc")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return (all_.select("row_id", "doc", F.octet_length("bytes").cast("bigint").alias("n_bytes")).join(_cut(losing), "doc", "left")
            .select(F.col("row_id").alias(id_col), "n_bytes", zero("n_removed"), zero("n_spans"),
                    F.coalesce("kept_sha256", F.lower(F.hex("doc"))).alias("kept_sha256")))
