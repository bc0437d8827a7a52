"""WARC archives: one gzip member per record, read back sequentially.

Records of pages with equal payloads (by SHA-1) are stored once: the page with
the largest ``page_id`` becomes a ``response`` record, the others ``revisit``
records of the identical-payload profile, which keep the HTTP header (and so the
payload's length), the payload digest and the record they refer to.

``write_archives`` writes files of about ``FILE_BYTES`` into a shared folder
through ``pyarrow.fs`` under names that depend only on the partition, first
under a private name and then moved, so a repeated task replaces its own files.
``read_archives`` reads a file in chunks, inflates member after member, frames
each record by its Content-Length and checks block and payload digests without
holding the file.

Defined cases: a null html is an empty payload, a null url leaves out the
target URI, a null ``page_id`` sorts below all others and is read back as null;
rows that share the largest ``page_id`` of their payload are responses all, an
empty table gives no archive.  Only the three named columns are read.  A damaged record is
reported in ``status`` (``bad_header``, ``bad_length``, ``bad_digest``,
``truncated``), never skipped in silence.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import scratch_path, written

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 256 << 20
CHUNK = 1 << 20
ID_URI = "urn:page:"
RECORD = ("record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, "
          "payload_digest string, status string")


def digest_text(raw: bytes) -> str:
    return base64.b32encode(raw).decode("ascii")


def _id(page_id) -> str:
    return f"<{ID_URI}{'null' if page_id is None else int(page_id)}>"


def page_of(record_id):
    """SQL column: the page id in a record id, null for none."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def record(page_id, url: str | None, payload: bytes, digest: bytes, refers_to, revisit: bool) -> bytes:
    """One uncompressed WARC record."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode("ascii")
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest_text(digest)}",
             f"WARC-Block-Digest: sha1:{digest_text(hashlib.sha1(block).digest())}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for a response)."""
    p = pages.select("page_id", "url", F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("digest", F.unhex(F.sha1("payload")))
    light = p.filter(F.length("payload") >= min_bytes).select("page_id", "digest")
    # Only payloads that occur twice need a look-up; written first, so that the
    # join can be planned from its size and a frequent payload split.
    twice = written(light.groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
                    .filter((F.col("n") > 1) & F.col("first_id").isNotNull())
                    .select(F.col("digest").alias("d"), "first_id"), "warc-payloads")
    j = p.join(twice, p["digest"] == twice["d"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return j.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, level: int = 6, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``roles`` rows; returns the manifest (path, records, bytes)."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        done, out, n, size, seq = [], None, 0, 0, 0

        def close():
            nonlocal out, n, size, seq
            if out is not None:
                out.close()
                final = f"{root}/pages-{part:06d}-{seq:04d}.warc.gz"
                fs.move(temp, final)
                done.append((f"{folder.rstrip('/')}/{os.path.basename(final)}", n, size))
                out, n, size, seq = None, 0, 0, seq + 1

        for b in batches:
            ids = b["page_id"].astype(object).where(b["page_id"].notna(), None)
            refs = b["refers_to"].astype(object).where(b["refers_to"].notna(), None)
            for pid, url, payload, digest, ref in zip(ids, b["url"], b["payload"], b["digest"], refs):
                if out is None:
                    temp = f"{root}/.pages-{part:06d}-{seq:04d}.{attempt}"
                    out = fs.open_output_stream(temp, compression=None)
                z = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = z.compress(record(pid, url, payload, digest, ref, ref is not None)) + z.flush()
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= file_bytes:
                    close()
        close()
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    light = records.withColumn("page_id", F.col("page_id").cast("string")).withColumn(
        "refers_to", F.col("refers_to").cast("string"))
    return written(light.mapInPandas(write, "path string, records long, bytes long"), "warc-manifest")


MAGIC = b"\x1f\x8b\x08"      # the first bytes of a gzip member


def _next_member(stream, raw: bytes, chunk: int) -> bytes:
    """What is read from the next start of a member on, after the first byte of ``raw``; empty at the end."""
    at = raw.find(MAGIC, 1)
    while at < 0:
        more = stream.read(chunk)
        if not more:
            return b""
        raw = raw[-2:] + more
        at = raw.find(MAGIC)
    return raw[at:]


def read_members(stream, chunk: int = CHUNK) -> Iterator[tuple[bytes, list[bytes], str]]:
    """(header, block pieces, status) of each gzip member of a stream.

    A member that cannot be inflated is told once (``bad_header``, with what was read of it), and
    reading goes on at the next bytes that start a sound member."""
    raw, lost = stream.read(chunk), False
    while raw:
        z, head, block, need, status = zlib.decompressobj(31), b"", [], None, "ok"
        got = 0
        while True:
            try:
                piece = z.decompress(raw)
            except zlib.error:
                if not lost:
                    yield head, block, "bad_header"
                lost, status, raw = True, "lost", _next_member(stream, raw, chunk)
                break
            if need is None:
                head += piece
                end = head.find(b"\r\n\r\n")
                if end >= 0:
                    m = re.search(rb"\r\nContent-Length: *([0-9]+)", head[:end], re.I)
                    need = int(m[1]) if m else -1
                    piece, head = head[end + 4:], head[:end]
                else:
                    piece = b""
            if piece:
                block.append(piece)
                got += len(piece)
            if z.eof:
                raw = z.unused_data or stream.read(chunk)
                break
            raw = stream.read(chunk)
            if not raw:
                status = "truncated"
                break
        if status == "lost":
            continue
        if status == "ok" and need is None or need == -1:
            status = "bad_header"
        elif status == "ok" and got != need + 4:
            status = "bad_length"
        if status == "ok":
            tail = block[-1][-4:]
            while len(tail) < 4:      # the end of a record may lie in several pieces
                block[-2:] = [block[-2] + block[-1]]
                tail = block[-1][-4:]
            block[-1] = block[-1][:-4]
            if tail != b"\r\n\r\n":
                status = "bad_length"
        lost = False
        yield head, block, status


def parse(head: bytes, block: list[bytes], status: str) -> tuple:
    """A ``RECORD`` row; digests are computed piece by piece."""
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    kind = fields.get("warc-type")
    sha, body, http, n = hashlib.sha1(), hashlib.sha1(), b"", 0
    split = False
    for piece in block:
        sha.update(piece)
        if not split:
            http += piece
            end = http.find(b"\r\n\r\n")
            if end < 0:
                continue
            split, piece, http = True, http[end + 4:], http[:end]
        body.update(piece)
        n += len(piece)
    digest = digest_text(body.digest())
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if status == "ok" and fields.get("warc-block-digest", "") != f"sha1:{digest_text(sha.digest())}":
        status = "bad_digest"
    if kind == "revisit":
        m = re.search(rb"Content-Length: *([0-9]+)", http, re.I)
        n, digest = int(m[1]) if m else None, said
    elif status == "ok" and said != digest:
        status = "bad_digest"
    return (fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-refers-to"), n,
            digest, status)


def read_archives(manifest: DataFrame) -> DataFrame:
    """One ``RECORD`` row per record of the files in ``manifest.path``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for b in batches:
            for path in b["path"]:
                fs, p = _filesystem(path)
                rows = []
                with fs.open_input_stream(p, compression=None) as stream:
                    for member in read_members(stream):
                        rows.append(parse(*member))
                        if len(rows) == 5000:
                            yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})
                            rows = []
                yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})

    files = manifest.select("path")
    return files.repartition(max(1, min(files.count(), 20_000))).mapInPandas(read, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages, reads the archives back: one row per page."""
    folder = scratch_path(pages.sparkSession, "warc")
    got = read_archives(write_archives(roles(pages), folder))
    return got.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                      "record_type", page_of(F.col("refers_to")).alias("refers_to"), "status")
