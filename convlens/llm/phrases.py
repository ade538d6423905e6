"""Phrase collocations from truncated suffix trees that are partitioned vertically and built independently.

The corpus, per language, is the sequence of words of its pieces; a suffix of it, cut after ``longest`` words or at the end of its piece,
is one path of the tree, and a phrase's count is the number of suffixes below its node. Steps:

1. Texts become blocks: rows of a few megabytes of one language, as numbers into the block's own table of words. The tables, cut by
   ranges of the words' checksums, are added up in buckets, which answer each block with the ids of its frequent words. A word below
   ``least`` occurrences is in no phrase sought, so it ends pieces like punctuation does.
2. Vertical partitioning: frequent words, as prefixes, are gathered into groups of about ``budget`` occurrences (in each bucket). A word above the budget is
   cut into parts by a hash of the word after it. Blocks send each part their distinct pairs of neighbours with counts; the part adds
   them up and answers for each pair whether it is frequent and, where the pair is itself above the budget, into how many parts its
   suffixes go (by a hash of the words after it).
3. A suffix ends before the first pair that is not frequent. Blocks send each part their distinct suffixes with counts.
4. Each part builds its subtree by itself: its leaves are sorted, nodes are runs of equal beginnings, and a node's count is the
   total of its leaves. Nodes above the place where a prefix was cut are summed over its parts.

What blocks send to a bucket or part is one row of packed arrays, so rows follow blocks and parts, not words; a bucket holds about
``bucket_words`` words of blocks, a part about a budget of suffixes, whatever is frequent. Nothing is broadcast and nothing of the corpus reaches the driver.

Pruning is exact: a phrase is never more frequent than a word or pair in it. Counts are whole numbers; scores are computed in
decimals of 38 digits (1000 * a * n stays below that for corpora up to 10 ** 17 words).

Defined results: null and empty texts hold no words; a null language is ``und``; phrases do not cross documents; repeated rows and ids count
each; other columns are ignored; an empty table, or one without frequent phrases, gives no rows; ties are ordered by phrase.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convlens.llm.common import materialize

# fixed values: bytes that end a piece, bytes that end a word; A-Z are lower-cased
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\x0b\x0c\r", b" \t"
TABLE = bytes(10 if c in PIECE_ENDS else 32 if c in WORD_ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))
CHUNK = 4 << 20


def _pack(values: np.ndarray, kind: type = np.int64) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values, kind).tobytes())


def _unpack(raw: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def _checksums(lang: str, words: list[bytes]) -> np.ndarray:
    start = zlib.crc32(lang.encode() + b"\n")
    return np.fromiter((zlib.crc32(w, start) for w in words), np.int64, len(words))


class Words(dict):
    """Numbers of words in order of appearance, from 1; 0 ends a piece, -1 is nothing between two spaces."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n

    def numbers(self, text: str) -> Iterator[np.ndarray]:
        data, at = text.encode().translate(TABLE), 0
        while at < len(data):  # a long text goes in chunks that end after a space
            cut = data.find(b" ", at + CHUNK) + 1 or len(data)
            parts = data[at:cut].replace(b"\n", b" \n ").split(b" ")
            found = np.fromiter(map(self.__getitem__, parts), np.int32, len(parts))
            yield found[found >= 0]
            at = cut


def word_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows (block, lang, n, words, counts, sequence) from (lang, text); a block's words are numbered in the order of their checksums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, open_ = TaskContext.get().partitionId() << 32, 0, {}

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            for lang, (words, parts) in open_.items():
                table = list(words)[2:]
                order = np.argsort(_checksums(lang, table), kind="stable")
                place = np.zeros(len(table) + 1, np.int32)
                place[order + 1] = np.arange(1, len(table) + 1)
                sequence = place[np.concatenate(parts)]
                counts = np.bincount(sequence, minlength=len(table) + 1)[1:]
                yield pa.RecordBatch.from_arrays([
                    pa.array([number]), pa.array([lang]), pa.array([counts.sum()], pa.int64()), pa.array([b"\n".join(table[i] for i in order.tolist())], pa.binary()),
                    pa.array([_pack(counts, np.int32)], pa.binary()), pa.array([_pack(sequence, np.int32)], pa.binary()), pa.array([len(table)], pa.int64())],
                    ["block", "lang", "n", "words", "counts", "sequence", "distinct"])
                number += 1
            open_.clear()
            size = 0

        end = np.zeros(1, np.int32)
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                text = text.as_py()
                words, parts = open_.setdefault(lang.as_py(), (Words(), []))
                for part in words.numbers(text):
                    parts.append(part)
                    size += 8 * len(part)
                    if size >= block_bytes and len(part) and part[-1] == 0:  # a piece has just ended
                        yield from rows()
                        words, parts = open_.setdefault(lang.as_py(), (Words(), []))
                parts.append(end)
                size += 8
                if size >= block_bytes:
                    yield from rows()
        yield from rows()

    some = docs.where("text != ''").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return some.mapInArrow(run, "block bigint, lang string, n bigint, words binary, counts binary, sequence binary, distinct bigint")


def _sent_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """Each block's words and counts, one row per bucket that they go to; ``start`` is where they begin in the block's numbering."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, lang, raw, counts in zip(*(b.column(c).to_pylist() for c in ("block", "lang", "words", "counts"))):
                words, counts = raw.split(b"\n") if raw else [], _unpack(counts, np.int32)
                bucket = _checksums(lang, words) * buckets >> 32
                starts = _runs(bucket)
                ends = np.concatenate([starts[1:], [len(words)]])[:len(starts)].tolist()
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block] * len(starts), pa.int64()), "lang": pa.array([lang] * len(starts), pa.string()), "bucket": bucket[starts],
                    "start": starts, "words": pa.array([zstandard.ZstdCompressor(1).compress(b"\n".join(words[lo:hi])) for lo, hi in zip(starts, ends)], pa.binary()),
                    "counts": pa.array([_pack(counts[lo:hi], np.int32) for lo, hi in zip(starts, ends)], pa.binary())})

    return blocks.select("block", "lang", "words", "counts").mapInArrow(
        run, "block bigint, lang string, bucket bigint, start bigint, words binary, counts binary")


def _answered_words(sent: DataFrame, least: int, budget: int) -> DataFrame:
    """To each block, for every word it sent: 0 or the word's id, and of frequent words their groups and parts. Besides, a row
    per bucket with its frequent words (no block)."""
    def run(rows: pa.Table) -> pa.Table:
        tables: dict[str, dict[bytes, int]] = {}
        names: list[tuple[str, bytes]] = []
        places, counts = [], []
        for lang, raw, n in zip(*(rows.column(c).to_pylist() for c in ("lang", "words", "counts"))):
            table = tables.setdefault(lang, {})
            place = np.empty(len(n := _unpack(n, np.int32)), np.int64)
            for i, word in enumerate(zstandard.ZstdDecompressor().decompress(raw).split(b"\n")):
                at = table.setdefault(word, len(names))
                if at == len(names):
                    names.append((lang, word))
                place[i] = at
            places.append(place)
            counts.append(n)
        f = np.bincount(np.concatenate(places), np.concatenate(counts), len(names)).astype(np.int64)
        bucket = rows.column("bucket")[0].as_py()
        some = np.flatnonzero(f >= least)
        ids, groups, parts = (np.zeros(len(names), np.int64) for _ in range(3))
        ids[some] = bucket << 32 | np.arange(1, len(some) + 1)
        share = np.where(f[some] > budget, 0, f[some])  # a word above the budget is a group of its own
        groups[some] = np.where(f[some] > budget, -ids[some], bucket << 32 | (np.cumsum(share) - share) // budget)
        parts[some] = -(-f[some] // budget)
        n, on = len(places), [ids[p] > 0 for p in places]
        pack = lambda of: [_pack(of[p[o]]) for p, o in zip(places, on)]
        out = {"block": rows.column("block").to_pylist(), "start": rows.column("start").to_pylist(), "ids": [_pack(ids[p]) for p in places],
               "groups": pack(groups), "parts": pack(parts)}
        blank = {"langs": [names[i][0] for i in some], "words": [names[i][1].decode() for i in some], "word_ids": ids[some].tolist(), "fs": f[some].tolist()}
        kinds = {"block": pa.int64(), "start": pa.int64(), "ids": pa.binary(), "groups": pa.binary(), "parts": pa.binary(), "langs": pa.list_(pa.string()),
                 "words": pa.list_(pa.string()), "word_ids": pa.list_(pa.int64()), "fs": pa.list_(pa.int64())}
        return pa.table({c: pa.array([*out.get(c, [None] * n), blank.get(c)], k) for c, k in kinds.items()})

    return sent.groupBy("bucket").applyInArrow(run, "block bigint, start bigint, ids binary, groups binary, parts binary, langs array<string>, words array<string>, "
                                                    "word_ids array<bigint>, fs array<bigint>")


def _mixed(words: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """A part from 0 on for each number or row of numbers, by a hash."""
    h = np.zeros(len(words), np.uint64)
    for column in (words.T if words.ndim == 2 else words[None]):
        h = (h ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % parts.astype(np.uint64)).astype(np.int64)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


class Pairs:
    """The distinct pairs of neighbours of a block, sorted by where they are sent: (group, sub)."""

    def __init__(self, sequence: np.ndarray, ids: np.ndarray, groups: np.ndarray, parts: np.ndarray):
        self.at = np.flatnonzero((sequence[:-1] > 0) & (sequence[1:] > 0))
        distinct, which, times = np.unique(sequence[self.at].astype(np.int64) << 32 | sequence[self.at + 1], return_inverse=True, return_counts=True)
        first, second = distinct >> 32, distinct & 0xFFFFFFFF
        group, sub = groups[first], _mixed(ids[second], parts[first])
        order = np.lexsort((ids[second], ids[first], sub, group))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.which = place[which]  # of each place in ``at``
        self.first, self.second, self.times = ids[first][order], ids[second][order], times[order]
        self.group, self.sub = group[order], sub[order]
        self.starts = _runs(self.group, self.sub)
        self.ends = np.concatenate([self.starts[1:], [len(order)]])[:len(self.starts)]


def _table(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
    """Sequence, ids, groups and parts of a block; word 0 is the end of a piece."""
    column = lambda c: _unpack(batch.column(c)[i].as_py())
    return _unpack(batch.column("sequence")[i].as_py(), np.int32), *(np.concatenate([[x], column(c)]) for x, c in ((0, "ids"), (0, "groups"), (1, "parts")))


def _frequent_words(blocks: DataFrame) -> DataFrame:
    """Blocks with only frequent words, in a table of ids, groups and parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                found = sorted(b.column("found")[i].as_py(), key=lambda x: x["start"])
                all_, groups, parts = (np.concatenate([_unpack(x[c]) for x in found] or [np.empty(0, np.int64)]) for c in ("ids", "groups", "parts"))
                frequent = all_ > 0
                new = np.concatenate([[0], np.where(frequent, np.cumsum(frequent), 0)]).astype(np.int32)
                sequence = new[_unpack(b.column("sequence")[i].as_py(), np.int32)]
                # only words with a neighbour, and one end between runs of them
                on = sequence > 0
                beside = np.concatenate([[False], on[:-1]]) | np.concatenate([on[1:], [False]])
                sequence = sequence[(on & beside) | ~on]
                off = sequence == 0
                sequence = sequence[~(off & np.concatenate([[True], off[:-1]]))]
                yield pa.RecordBatch.from_arrays([b.column("block").slice(i, 1), *(pa.array([x], pa.binary()) for x in (
                    _pack(sequence, np.int32), _pack(all_[frequent]), _pack(groups), _pack(parts)))], ["block", "sequence", "ids", "groups", "parts"])

    return blocks.select("block", "sequence", "found").mapInArrow(run, "block bigint, sequence binary, ids binary, groups binary, parts binary")


def _sent_pairs(blocks: DataFrame) -> DataFrame:
    """Each block's pairs, one row per part they go to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                p = Pairs(*_table(b, i))
                cut = lambda x: pa.array([_pack(np.diff(x[lo:hi], prepend=0)) for lo, hi in zip(p.starts, p.ends)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("block")[i].as_py()] * len(p.starts), pa.int64()), pa.array(p.group[p.starts]), pa.array(p.sub[p.starts]),
                     cut(p.first), cut(p.second), cut(p.times)], ["block", "group", "sub", "first", "second", "times"])

    return blocks.mapInArrow(run, "block bigint, group bigint, sub bigint, first binary, second binary, times binary")


def _answered(sent: DataFrame, least: int, budget: int) -> DataFrame:
    """To each block with frequent pairs: for every pair it sent, 0 or into how many parts the pair's suffixes go."""
    def run(rows: pa.Table) -> pa.Table:
        first, second, times = ([np.cumsum(_unpack(x.as_py())) for x in rows.column(c)] for c in ("first", "second", "times"))
        (_, one), (different, two) = (np.unique(np.concatenate(x), return_inverse=True) for x in (first, second))
        _, which = np.unique(one * len(different) + two, return_inverse=True)
        total = np.bincount(which, np.concatenate(times)).astype(np.int64)
        parts = np.where(total >= least, -(-total // budget), 0)[which]
        ends = np.cumsum([len(x) for x in first])
        out = [parts[hi - len(x):hi] for x, hi in zip(first, ends)]
        some = np.flatnonzero([x.any() for x in out])
        return pa.table({**{c: rows.column(c).take(pa.array(some)) for c in ("block", "group", "sub")},
                         "parts": pa.array([_pack(out[j]) for j in some], pa.binary())})

    return sent.groupBy("group", "sub").applyInArrow(run, "block bigint, group bigint, sub bigint, parts binary")


def _sent_suffixes(blocks: DataFrame, longest: int) -> DataFrame:
    """Each block's distinct suffixes of two words or more, one row per part they go to; ``whole`` is the least depth at which a part holds all of a node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                sequence, ids, groups, parts = _table(b, i)
                p = Pairs(sequence, ids, groups, parts)
                answers = {(x["group"], x["sub"]): _unpack(x["parts"]) for x in b.column("found")[i].as_py()}
                into = np.zeros(len(p.times), np.int64)
                for lo, hi, g, s in zip(p.starts, p.ends, p.group[p.starts].tolist(), p.sub[p.starts].tolist()):
                    if (g, s) in answers:
                        into[lo:hi] = answers[g, s]
                goes_on = np.zeros(len(sequence) + longest, bool)
                goes_on[p.at] = into[p.which] > 0
                pair = np.zeros(len(sequence), np.int64)
                pair[p.at] = p.which
                start = np.flatnonzero(goes_on)
                words, on = np.zeros((len(start), longest), np.int64), np.ones(len(start), bool)
                padded = np.concatenate([ids[sequence], np.zeros(longest, np.int64)])
                for d in range(longest):
                    words[:, d] = np.where(on, padded[start + d], 0)
                    on &= goes_on[start + d]
                group, sub, cuts = p.group[pair[start]], p.sub[pair[start]], into[pair[start]]
                part = np.where(cuts > 1, 1 + _mixed(words[:, 2:], np.maximum(cuts, 1)), 0) if longest > 2 else np.zeros(len(start), np.int64)
                order = np.lexsort((*words.T[::-1], part, sub, group))
                words, group, sub, part = words[order], group[order], sub[order], part[order]
                new = _runs(group, sub, part, *words.T)
                times = np.diff(np.concatenate([new, [len(order)]]))[:len(new)]
                words, group, sub, part = words[new], group[new], sub[new], part[new]
                starts = _runs(group, sub, part)
                ends = np.concatenate([starts[1:], [len(new)]])[:len(starts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[starts]), pa.array(sub[starts]), pa.array(part[starts]),
                     pa.array([_pack(words[lo:hi].T.ravel()) for lo, hi in zip(starts, ends)], pa.binary()),
                     pa.array([_pack(times[lo:hi]) for lo, hi in zip(starts, ends)], pa.binary())], ["group", "sub", "part", "words", "times"])

    return blocks.mapInArrow(run, "group bigint, sub bigint, part bigint, words binary, times binary")


def _subtrees(sent: DataFrame, longest: int, least: int) -> DataFrame:
    """Nodes (phrase, f) of two words or more; of those above a cut, what each part holds of them."""
    def build(rows: pa.Table) -> pa.Table:
        times = [_unpack(x.as_py()) for x in rows.column("times")]
        words = np.concatenate([_unpack(x.as_py()).reshape(longest, -1).T for x in rows.column("words")])
        order = np.lexsort(words.T[::-1])
        words, times = words[order], np.concatenate(times)[order].astype(np.int64)
        # a part above 0 is one of several that the suffixes of a pair were dealt out to by all their words
        whole = longest if rows.column("part")[0].as_py() else 2
        differs = np.ones((len(words), longest), bool)  # from the row before, in the first d + 1 words
        differs[1:] = np.logical_or.accumulate(words[1:] != words[:-1], axis=1)
        phrases, counts = [], []
        for d in range(2, longest + 1):
            starts = np.flatnonzero(differs[:, d - 1])
            total = np.add.reduceat(times, starts)
            keep = (words[starts, d - 1] > 0) & ((total >= least) | (d < whole))
            phrases.extend(words[starts[keep], :d].tolist())
            counts.append(total[keep])
        return pa.table({"phrase": pa.array(phrases, pa.list_(pa.int64())), "f": np.concatenate(counts)})

    return sent.groupBy("group", "sub", "part").applyInArrow(build, "phrase array<bigint>, f bigint")


def _scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates (phrase, lang, f) with l, r and score of their lowest-scoring cut."""
    parts = phrases.select("phrase", "f").unionByName(words.select(F.array("id").alias("phrase"), "f"))
    cuts = phrases.select("phrase", "f", "n", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.slice("phrase", F.lit(1), F.col("k"))).withColumn("rest", F.slice("phrase", F.col("k") + 1, F.size("phrase")))
    cuts = (cuts.join(parts.select(F.col("phrase").alias("head"), F.col("f").alias("l")), "head")
            .join(parts.select(F.col("phrase").alias("rest"), F.col("f").alias("r")), "rest"))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumn("up", F.lit(1000).cast("decimal(38,0)") * big("f") * big("n")).withColumn("down", big("l") * big("r"))
    best = cuts.groupBy("phrase").agg(F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("best"))
    return phrases.join(best, "phrase").select(*phrases.columns, "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, absorb_percent: int = 100,
                 block_bytes: int = 16 << 20, budget: int = 1_000_000, bucket_words: int = 1_000_000) -> DataFrame:
    """Per language its ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score."""
    blocks = materialize(word_blocks(docs, block_bytes), "phrase-blocks")
    buckets = max(1, -(-(blocks.agg(F.sum("distinct")).first()[0] or 0) // bucket_words))
    answers = materialize(_answered_words(_sent_words(blocks, buckets), least, budget), "phrase-words")
    total = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    words = (answers.where(F.col("block").isNull()).select(F.explode(F.arrays_zip("langs", "words", "word_ids", "fs")).alias("x"))
             .select(F.col("x.langs").alias("lang"), F.col("x.words").alias("word"), F.col("x.word_ids").alias("id"), F.col("x.fs").alias("f")))
    words = materialize(words.join(total, "lang"), "phrase-frequent")

    found = (answers.where(F.col("block").isNotNull()).groupBy("block").agg(F.collect_list(F.struct("start", "ids", "groups", "parts")).alias("found")))
    encoded = materialize(_frequent_words(blocks.select("block", "sequence").join(found, "block")), "phrase-sequences")
    answers = (_answered(_sent_pairs(encoded), least, budget).groupBy("block").agg(F.collect_list(F.struct("group", "sub", "parts")).alias("found")))
    nodes = _subtrees(_sent_suffixes(encoded.join(answers, "block"), longest), longest, least)
    phrases = nodes.groupBy("phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    of_lang = words.select(F.col("id").alias("head"), "lang", "n")
    phrases = materialize(phrases.withColumn("head", F.element_at("phrase", 1)).join(of_lang, "head").drop("head"), "phrases")

    inside = (phrases.where(F.size("phrase") > 2).select("phrase", "f", F.explode(F.sequence(F.lit(2), F.size("phrase") - 1)).alias("k"))
              .select("phrase", "f", "k", F.explode(F.sequence(F.lit(1), F.size("phrase") - F.col("k") + 1)).alias("at"))
              .groupBy(F.slice("phrase", F.col("at"), F.col("k")).alias("phrase")).agg(F.max("f").alias("longer")))
    kept = (_scored(phrases, words).join(inside, "phrase", "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < absorb_percent * F.col("f"))).drop("longer"))
    spelled = (kept.select("phrase", F.posexplode("phrase").alias("at", "id")).join(words.select("id", "word"), "id")
               .groupBy("phrase").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("text")))
    rows = kept.join(spelled, "phrase")
    best = [F.col("score").desc(), F.col("f").desc(), F.col("text")]
    # the best of each of many parts of a language, then the best of those
    part = F.pmod(F.xxhash64("text"), F.lit(64))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*best))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("bigint").alias("rank"), F.col("text").alias("phrase"), F.col("f").alias("a"), "l", "r", "n", "score")
