"""WARC archives: written with an index, read back through it.

``write_archives`` writes one gzip member per record (so each can be read alone) and, first and foremost, the index:
one row per record with archive, offset, length, URL, digest and type, kept as a Parquet table. Every task writes
archives of bounded size under names of its own attempt; only archives named in the index count, so the leavings of a lost
or repeated task are never read. ``read_records`` starts from any selection of index rows, sorts them by archive and
offset, merges ranges that lie close together into one read of bounded size, and parses the records.

Of records with equal payloads of at least ``least_bytes`` the one with the largest id is a response; the others become
revisit records that refer to it. Defined results: a null payload is empty; a null id never refers to another record and is never
referred to; rows with equal id and payload that share the largest id are all responses; a null URL is written as an empty
one; very long payloads are one record each, and an archive may exceed its size by one record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.llm.common import fresh, marked, materialize, shared_uri

INDEX = "archive string, offset bigint, length bigint, url string, digest string, record_type string, id bigint"
RECORD = ("id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
          "payload binary")
_ID, _HTTP = "urn:record:", b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def record_bytes(record_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    revisit = refers_to is not None
    body = _HTTP if revisit else _HTTP + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_ID}{'' if record_id is None else record_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '').replace(chr(10), '')}",
        f"WARC-Payload-Digest: sha1:{_base32(digest)}", f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()


def parse_record(raw: bytes) -> dict:
    """The record of one gzip member; for a response, digest and length are taken from the payload itself."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    field = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = rest[:int(field["Content-Length"])]
    number = lambda name: int(x) if (x := field[name][1 + len(_ID):-1]) else None
    out = {"id": number("WARC-Record-ID"), "url": field["WARC-Target-URI"], "record_type": field["WARC-Type"]}
    noted = base64.b32decode(field["WARC-Payload-Digest"].partition(":")[2]).hex()
    if out["record_type"] == "revisit":
        return out | {"payload_bytes": int(field["X-Payload-Length"]), "payload_digest": noted,
                      "refers_to": number("WARC-Refers-To"), "payload": None}
    payload = body.partition(b"\r\n\r\n")[2]
    if (digest := hashlib.sha1(payload).hexdigest()) != noted:
        raise ValueError(f"record {out['id']}: payload digest {digest}, noted {noted}")
    return out | {"payload_bytes": len(payload), "payload_digest": digest, "refers_to": None, "payload": payload}


def _with_revisits(rows: DataFrame, least_bytes: int) -> DataFrame:
    """Adds refers_to. Ids and digests of repeated payloads are joined first; of the rows with their payloads only those that a
    bitmap of revisiting ids lets through are shuffled, the others are responses where they lie."""
    narrow = rows.where(F.octet_length("payload") >= least_bytes).select("id", "digest")
    groups = (narrow.groupBy("digest").agg(F.max("id").alias("refers_to"), F.min("id").alias("least"))
              .where("least < refers_to").drop("least"))
    revisits = narrow.join(groups, "digest").where("id < refers_to").distinct()
    (may,) = fresh(rows, "may")
    split = marked(rows, F.col("id"), revisits, F.col("id"), may)
    sure = split.where(~F.col(may)).drop(may).withColumn("refers_to", F.lit(None).cast("bigint"))
    return sure.unionByName(split.where(may).drop(may).join(revisits, ["id", "digest"], "left"))


def write_archives(df: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = 1000,
                   archive_bytes: int = 256 << 20) -> DataFrame:
    """Writes every row as a record below the shared folder; returns the index (see ``INDEX``)."""
    home = shared_uri(df.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
                     F.sha1(payload).alias("digest"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(home)
        out, name, at = None, "", 0
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    else:
                        store.create_dir(folder, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{folder}/{name}", compression=None, buffer_size=1 << 20)
                raw = record_bytes(r["id"], r["url"], r["digest"], r["payload"], r["refers_to"])
                out.write(raw)
                found.append({"archive": f"{home}/{name}", "offset": at, "length": len(raw), "url": r["url"],
                              "digest": r["digest"], "id": r["id"],
                              "record_type": "response" if r["refers_to"] is None else "revisit"})
                at += len(raw)
            yield pa.RecordBatch.from_pylist(found, _SCHEMA)
        if out is not None:
            out.close()

    return materialize(_with_revisits(rows, least_bytes).mapInArrow(write, INDEX), "warc-index")


_SCHEMA = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                     ("digest", pa.string()), ("record_type", pa.string()), ("id", pa.int64())])


def plan_reads(index: DataFrame, gap_bytes: int = 64 << 10, read_bytes: int = 8 << 20) -> DataFrame:
    """The selected records as reads: (archive, start, end, parts), near records merged while the read stays bounded.

    Archives are cut into windows of ``read_bytes`` by the records' offsets, so that a read belongs to one window and
    an archive of any size is planned in parallel.
    """
    archive, start, near = fresh(index, "w_window", "w_start", "w_near")
    windows = index.select("archive", F.floor(F.col("offset") / read_bytes).alias(archive), "offset", "length")

    def plan(frame):
        import pandas as pd

        frame = frame.sort_values("offset").drop_duplicates("offset")
        ends = frame["offset"] + frame["length"]
        run = (frame["offset"] - ends.shift() > gap_bytes).cumsum()
        rows = [{"archive": g["archive"].iat[0], "start": int(g["offset"].iat[0]), "end": int((g["offset"] + g["length"]).iat[-1]),
                 "offsets": g["offset"].tolist(), "lengths": g["length"].tolist()} for _, g in frame.groupby(run)]
        return pd.DataFrame(rows, columns=["archive", "start", "end", "offsets", "lengths"])

    return windows.groupBy("archive", archive).applyInPandas(
        plan, "archive string, start bigint, end bigint, offsets array<bigint>, lengths array<bigint>")


def read_records(index: DataFrame, with_payload: bool = True, gap_bytes: int = 64 << 10, read_bytes: int = 8 << 20,
                 task_bytes: int = 64 << 20) -> DataFrame:
    """The selected records (see ``RECORD``), each index row once; ``with_payload=False`` leaves ``payload`` null. A task reads
    about ``task_bytes``: the planned reads are small rows, so their number says nothing of what they make a task read."""
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_as, file, store = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["archive"] != open_as:
                    store, path = fs.FileSystem.from_uri(r["archive"])
                    file, open_as = store.open_input_file(path), r["archive"]
                raw, found = file.read_at(r["end"] - r["start"], r["start"]), []
                for offset, length in zip(r["offsets"], r["lengths"]):
                    found.append(parse_record(raw[offset - r["start"]:offset - r["start"] + length]))
                    if not with_payload:
                        found[-1]["payload"] = None
                yield pa.RecordBatch.from_pylist(found, schema)

    tasks = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // task_bytes))
    return plan_reads(index, gap_bytes, read_bytes).repartition(tasks, "archive", "start").mapInArrow(read, RECORD)
