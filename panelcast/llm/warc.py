"""WARC archives: one gzip member per record, written and read by Spark tasks.

Writing: equal payloads of ``MIN_REVISIT`` bytes or more are stored once; the
record of the smallest page id is the response and the others are revisit
records that refer to it. Each task writes its records to archives of about
``ROLL`` bytes in the shared folder. An archive counts only if its name is in
the manifest that Spark commits, so a task that is run again or twice leaves
no half-written or doubled archive in the result.

Reading is sequential: an archive is streamed in pieces of ``PIECE`` bytes
through one zlib stream per member; the record head ends at the first empty
line, ``Content-Length`` frames the block, and the payload digest of a
response is computed and compared. A revisit's digest and length are compared
with those of the response that it refers to, by a Spark join over all
archives (``verified``). After damage, reading goes on at the next gzip member.

Paths may be local or any URI that ``pyarrow.fs`` opens (hdfs, s3, gs).

Defined results: a null html is an empty payload, and so a response; rows
that repeat the smallest page id of a payload are all responses; a null page
id or url is left out of the record; a damaged archive gives one row with
``problem`` set and page_id null for the place where reading ended.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.scratch import written
from panelcast.llm.skew import lookup
from panelcast.session import scratch_path

MIN_REVISIT = 100
ROLL = 256 << 20
PIECE = 1 << 16
DATE = "2024-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member."""
    block = b"" if refers_to is not None else _HTTP.format(len(payload)).encode() + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>", f"X-Payload-Length: {len(payload)}"]
    head.append(f"Content-Length: {len(block)}")
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Records:
    """Records of one archive, read front to back."""

    def __init__(self, stream):
        self.stream, self.raw, self.text, self.z, self.members = stream, b"", b"", None, 0
        self.start = 0                       # where the current member begins

    def _more(self) -> bool:
        """Decompress a little more of the current member; False at its end."""
        if self.z.eof:
            return False
        if not self.raw:
            self.raw = self.stream.read(PIECE)
            if not self.raw:
                raise ValueError("archive ends inside a record")
        data, self.raw = self.raw, b""
        self.text += self.z.decompress(data, PIECE)
        self.raw = self.z.unconsumed_tail or self.z.unused_data
        return True

    def _take(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            if not self.text and not self._more():
                raise ValueError("record is shorter than its Content-Length")
            parts.append(self.text[:n - have])
            have += len(parts[-1])
            self.text = self.text[len(parts[-1]):]
        return b"".join(parts)

    def resync(self) -> bool:
        """After an error: to the next place behind the start of the failed
        member that looks like the start of one; False if there is none.
        (The failed member may have swallowed others, so it is searched too.)"""
        self.stream.seek(self.start + 1)
        held = b""
        while more := self.stream.read(PIECE):
            data = held + more
            at = data.find(b"\x1f\x8b\x08")
            if at >= 0:
                self.raw = data[at:]
                return True
            held = data[-2:]
        return False

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while self.raw or (piece := self.stream.read(PIECE)):
            if not self.raw:
                self.raw = piece
            self.start = self.stream.tell() - len(self.raw)
            self.z, self.text = zlib.decompressobj(31), b""
            self.members += 1
            while (end := self.text.find(b"\r\n\r\n")) < 0:
                if not self._more():
                    raise ValueError("record without a complete head")
            lines = self._take(end + 4).decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("record does not begin with a WARC version")
            head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}
            if not head.get("content-length", "").isdigit():
                raise ValueError("record without Content-Length")
            block = self._take(int(head["content-length"]))
            if self._take(4) != b"\r\n\r\n":
                raise ValueError("block does not end where Content-Length says")
            while self._more():
                pass
            if self.text:
                raise ValueError("data after the record in its member")
            yield head, block


def _write(folder: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        out, name, size, count = None, "", 0, 0

        def done():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64()), pa.array([size], pa.int64())],
                                              names=["archive", "n_records", "n_bytes"])
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
                if out is None:
                    name, size, count = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{base}/{name.rsplit('/', 1)[1]}", compression=None)
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                data = record(page_id.as_py(), url.as_py(), payload, digest.as_py(), refers_to.as_py())
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= roll:
                    yield done()
                    out = None
        if out is not None:
            yield done()
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str | None = "url", html_col: str = "html",
                   roll: int = ROLL) -> DataFrame:
    """Writes the pages as WARC archives below ``folder``; returns the
    manifest (archive, n_records, n_bytes), itself a written table."""
    digest = F.sha2(F.coalesce(F.col(html_col).cast("string"), F.lit("")), 256)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), (F.col(url_col) if url_col else F.lit(None)).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), digest.alias("digest"))
    long = F.octet_length("html") >= MIN_REVISIT
    same = (rows.where(long).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    total = rows.count()
    found = lookup(rows.withColumn("key", F.when(long, F.col("digest"))), same.withColumnRenamed("digest", "key"), "key", "n",
                   F.xxhash64("page_id", "url"), total)
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return written(found.select("page_id", "url", "html", "digest", refers.alias("refers_to"))
                   .mapInArrow(_write(folder, roll), "archive string, n_records long, n_bytes long"), "warc-manifest")[0]


def _id(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def _read(with_payload: bool):
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "digest_ok", "refers_to", "archive", "problem", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def row(archive: str, head: dict[str, str], block: bytes) -> tuple:
        kind, said = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha256:")
        if kind == "revisit":
            size, digest, ok, payload = int(head.get("x-payload-length", 0)), said, None, None
        else:
            payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            ok = digest == said
        return (_id(head.get("warc-record-id")), head.get("warc-target-uri"), kind, size, digest, ok, _id(head.get("warc-refers-to")),
                archive, None, payload if with_payload else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def out():
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)], names=names)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                files, path = _open(archive)
                with files.open_input_file(path) as stream:
                    records, sound, reading = Records(stream), True, True
                    while reading:
                        try:
                            for head, block in records:
                                rows.append(row(archive, head, block))
                                sound = True
                                size += len(block) if with_payload else 100
                                if size > 8 << 20:
                                    yield out()
                                    rows, size = [], 0
                            reading = False
                        except (ValueError, zlib.error) as e:
                            if sound:                # one row for each damaged stretch
                                rows.append((None, None, None, None, None, None, None, archive, f"record {records.members}: {e}", None))
                            sound, reading = False, records.resync()
        yield out()
    return run


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives named in column ``archive``;
    ``digest_ok`` is null for revisits (see ``verified``)."""
    n = max(1, archives.count())
    return archives.select("archive").repartition(n).mapInArrow(
        _read(with_payload), "page_id long, url string, record_type string, payload_bytes long, payload_digest string, digest_ok boolean, "
                             "refers_to long, archive string, problem string, payload binary")


def verified(records: DataFrame) -> DataFrame:
    """``records`` (a written table of ``read_archives``) with ``digest_ok`` of
    revisits: does a sound response of the page they refer to have the digest
    and length that they state? Revisits of one response may be a third of
    all rows, so they are looked up by ``skew.lookup``."""
    said = lambda page: F.concat_ws(":", page, "payload_digest", "payload_bytes")
    is_revisit = F.coalesce(F.col("record_type") == "revisit", F.lit(False))
    rows = records.withColumn("claim", F.when(is_revisit, said("refers_to")))
    claims = rows.where(is_revisit).groupBy("claim").agg(F.count(F.lit(1)).alias("n"))
    there = (records.where((F.col("record_type") == "response") & F.col("digest_ok")).select(said("page_id").alias("response"))
             .distinct().withColumn("found", F.lit(True)))
    known = claims.join(there, claims["claim"] == there["response"], "left").select("claim", "n", "found")
    looked = lookup(rows, known, "claim", "n", F.xxhash64("page_id", "url", "archive"), records.count())
    ok = F.when(is_revisit, F.coalesce("found", F.lit(False))).otherwise(F.col("digest_ok"))
    return looked.withColumn("digest_ok", ok).select(*records.columns)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder, and read back."""
    back, _ = written(read_archives(write_archives(pages, scratch_path(spark, "warc")), with_payload=False), "warc-records")
    return verified(back).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok", "problem")


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, true AS digest_ok, CAST(NULL AS VARCHAR) AS problem FROM f
"""
