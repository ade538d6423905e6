"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. A text is cut into windows at word ends;
each window is compressed once with the ordinary dictionary and once with the toxic dictionary before the ordinary one.
As the second compressor knows all that the first knows at the same distances, its gain on a window is what the toxic
dictionary alone explains. How many windows of a text gain at least 1, 2, 3 and 4 bytes, against how many windows it has,
is calibrated to a probability on labelled texts that took no part in training the dictionaries.

The toxic dictionary is trained on the contrast of the classes: of every word of toxic text, the stretch whose byte
5-grams are many times as frequent in toxic as in ordinary texts. Ordinary words would otherwise fill it and cover
different parts of the common vocabulary than the other dictionary, which is noise.

The model is fitted on at most ``max_toxic`` + ``max_ordinary`` labelled documents (those with the least hash of their id), and
calibrated to the share of toxic ones among all labelled documents, so a threshold means the same at every size. One text of each id is learned from, of it the
first ``LEARN_CHARS`` characters: at most 393 MB of UTF-8 (6,000 texts of 64 KiB) come to the driver, whatever the tables hold. Every document is scored, over its whole text. Defined results: null and empty texts have no windows and get the calibrated
probability of a text without gains; without usable labels of both kinds every score is the share of toxic labels; rows
with equal ids are scored separately; a document whose labels disagree counts as toxic; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

GRAM, WINDOW, GAINS = 5, 64, (1, 2, 3, 4)
LEARN_CHARS = 16_384  # of a text that is learned from: longer ones give stretches of LEARN_STEP characters from all over
LEARN_STEP = 256
_PAD = b"\x01"


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def windows(text: str | None) -> list[bytes]:
    """Runs of whole words of at least ``WINDOW`` bytes (the last may be shorter), each between spaces."""
    whole, out, at = b" ".join(_words(text or "")), [], 0
    while at < len(whole):
        end = whole.find(b" ", at + WINDOW)
        end = len(whole) if end < 0 else end
        out.append(b" " + whole[at:end] + b" ")
        at = end + 1
    return out


def _grams(word: bytes) -> list[bytes]:
    word = b" " + word
    return [word[i:i + GRAM] for i in range(max(1, len(word) - GRAM + 1))]


def _document_frequency(texts: list[str]) -> Counter:
    return Counter(g for t in texts for g in {g for w in set(_words(t)) for g in _grams(w)})


def contrast_spans(toxic: list[str], ordinary: list[str], ratio: float = 40.0, support: float = 0.01) -> list[bytes]:
    """Of each word of the toxic texts the stretch of 5-grams whose share of toxic texts is ``ratio`` times their share of
    ordinary ones, without those much rarer than the stretch's most frequent one (endings of a common stem)."""
    in_toxic, in_ordinary = _document_frequency(toxic), _document_frequency(ordinary)
    least = max(3, support * len(toxic))
    telling = {g: n for g, n in in_toxic.items()
               if n >= least and n / len(toxic) > min(ratio, len(ordinary) / 4) * (in_ordinary[g] + 1) / len(ordinary)}
    out = []
    for text in toxic:
        for word in _words(text):
            if hit := [(i, telling[g]) for i, g in enumerate(_grams(word)) if g in telling]:
                top = max(n for _, n in hit)
                hit = [i for i, n in hit if 2 * n >= top]
                out.append((b" " + word)[hit[0]:hit[-1] + GRAM])
    return out


def _trained(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """The text of a trained dictionary; the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Matches from 5 bytes on: shorter ones are chance. The content is used as text, without entropy tables."""
    how = zstandard.ZstdCompressionParameters.from_level(
        3, source_size=WINDOW, dict_size=len(content), min_match=5, strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False, write_dict_id=False)
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(compression_params=how, dict_data=known)


@dataclass
class Model:
    """What scoring needs; a few kilobytes whatever the corpus."""

    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)
    base_rate: float = 0.0

    def compressors(self) -> tuple | None:
        return (_compressor(self.ordinary), _compressor(self.toxic + self.ordinary)) if self.weights else None


def gains(pairs: list[list[bytes]], compressors: tuple) -> list[np.ndarray]:
    """For each text's windows how many bytes the toxic dictionary saves."""
    flat = [w for ws in pairs for w in ws]
    if not flat:
        return [np.empty(0, np.int64) for _ in pairs]
    sizes = [np.fromiter(map(len, c.multi_compress_to_buffer(flat)), np.int64, len(flat)) for c in compressors]
    return np.split(sizes[0] - sizes[1], np.cumsum([len(ws) for ws in pairs])[:-1])


def features(gain: list[np.ndarray]) -> np.ndarray:
    hits = np.array([[np.count_nonzero(g >= t) for t in GAINS] for g in gain], np.float64).reshape(len(gain), len(GAINS))
    n = np.array([len(g) for g in gain], np.float64)[:, None]
    return np.hstack([np.ones((len(gain), 1)), np.log1p(hits), 4 * np.sqrt(hits / np.maximum(n, 1)), np.log1p(n) / 4])


def _logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, l2: float = 0.1, rounds: int = 60) -> np.ndarray:
    """``counts``: how many rows each row stands for."""
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), l2)
    keep[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (counts * (p * (1 - p) + 1e-9))[:, None]) + np.diag(keep), x.T @ (counts * (y - p)) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_model(rows: list[tuple[str, int]], dictionary_bytes: int = 8192, share: float | None = None) -> Model:
    """``rows``: (text, label), in an order that has nothing to do with the label. Alternate ones train the dictionaries;
    the others calibrate, weighted to the ``share`` of toxic texts among all that the rows were picked from (default: theirs)."""
    texts = [(t or "", y) for t, y in rows]
    by = {y: [t for t, label in texts if label == y] for y in (0, 1)}
    rate = share if share is not None else len(by[1]) / len(texts) if texts else 0.0
    if min(len(by[0]), len(by[1])) < 4:
        return Model(base_rate=rate)
    train, rest = {y: by[y][::2] for y in by}, {y: by[y][1::2] for y in by}
    spans = contrast_spans(train[1], train[0])
    # each span on its own between pads, so that trained segments do not run from one into another
    toxic = _trained([s.center(16, _PAD) for s in spans], dictionary_bytes, 16, 6) if spans else _PAD * 16
    start = toxic.find(_PAD * 2)
    ordinary = _trained([w for t in train[0] for w in windows(t)], dictionary_bytes, 64, 8)
    model = Model(ordinary[-7 * dictionary_bytes // 8:], toxic[max(0, start):], [0.0], rate)
    held = [(t, y) for y in rest for t in rest[y]]
    x = features(gains([windows(t) for t, _ in held], model.compressors()))
    counts = {1: rate * len(held) / len(rest[1]), 0: (1 - rate) * len(held) / len(rest[0])}
    model.weights = _logistic(x, np.array([y for _, y in held], np.float64), np.array([counts[y] for _, y in held])).tolist()
    return model


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        learn_from=None, max_toxic: int = 2000, max_ordinary: int = 4000) -> Model:
    """Fits on the labelled documents that ``learn_from`` (a column of the labels; default all) admits."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if learn_from is not None:
        usable = usable.where(learn_from)
    marked = usable.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    texts = documents.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    marked = marked.join(texts.select(F.col("_doc").alias("_id")), "_id", "left_semi").persist()
    n = {r["_label"]: r["count"] for r in marked.groupBy("_label").count().collect()}
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = (marked.where("_label = 1").orderBy(*order).limit(max_toxic)
              .union(marked.where("_label = 0").orderBy(*order).limit(max_ordinary)))
    joined = (texts.join(F.broadcast(picked), F.col("_doc") == F.col("_id")).withColumn("_text", stretches(F.col("_text")))
              .groupBy("_id", "_label").agg(F.min("_text").alias("_text")))
    rows = sorted(joined.collect(), key=lambda r: (hash_order(r["_id"]), r["_text"] or ""))
    marked.unpersist()
    return fit_model([(r["_text"], r["_label"]) for r in rows], share=n.get(1, 0) / sum(n.values()) if n else None)


def stretches(text: Column) -> Column:
    """The whole text up to ``LEARN_CHARS`` characters; of a longer one as many characters in stretches of ``LEARN_STEP``, picked by a
    hash of their number from its whole length and kept in order, so that every part is as likely to be learned from."""
    count = F.ceil(F.char_length(text) / F.lit(LEARN_STEP)).cast("int")
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: F.struct(F.xxhash64(i, F.char_length(text)).alias("h"), i.alias("i"))))
    picked = F.array_sort(F.transform(F.slice(order, 1, LEARN_CHARS // LEARN_STEP), lambda x: x["i"]))
    parts = F.transform(picked, lambda i: F.substring(text, i * LEARN_STEP + 1, F.lit(LEARN_STEP)))
    return F.when(text.isNull() | (F.char_length(text) <= LEARN_CHARS), text).otherwise(F.array_join(parts, " "))


def hash_order(value) -> int:
    """A fixed order that has nothing to do with the values' own."""
    import zlib

    return zlib.crc32(f"order:{value}".encode())


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", keep_text: bool = False) -> DataFrame:
    """``df`` with the score of the whole text; without the text itself unless ``keep_text``."""
    if score_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {score_col} exists already; pass another name for score_col")
    rest = [c for c in df.columns if keep_text or c != text_col]
    at = df.columns.index(text_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            if compressors is None:
                s = np.full(batch.num_rows, model.base_rate)
            else:
                x = []
                for text in batch.column(at):  # one text's windows at a time: memory follows the longest text
                    x.append(features(gains([windows(text.as_py())], compressors)))
                s = 1 / (1 + np.exp(-np.clip(np.vstack(x) @ np.array(model.weights), -30, 30))) if x else np.empty(0)
            kept = [c for i, c in enumerate(batch.columns) if keep_text or i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(s, pa.float64())], [*rest, score_col])

    schema = StructType(list(df.select(*rest).schema.fields)).add(score_col, "double")
    return df.mapInArrow(scored, schema)
