"""WARC archives: writing with revisit records, and a salvage reader.

The writer puts each record into a gzip member of its own and starts a new file
after ``ROTATE`` bytes; the list of files of the tasks that committed is the
archive's manifest. The reader checks every record (gzip check sum, version line,
lengths, digests). After a failed check it searches for the next place from which
a whole record can be read, goes on there, and reports the bytes between as a gap.

Defined cases: a null payload is empty; a page without an id is always a response;
rows of one id with equal payloads are all responses if the id is the smallest;
extra columns are ignored; no pages give no files and no records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from vitalgrid.llm.common import stored
from vitalgrid.session import shared_folder

MIN_PAYLOAD = 100
ROTATE = 32 << 20
DATE = "1970-01-01T00:00:00Z"
WINDOW = 1 << 20
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."

RECORD_SCHEMA = """file string, offset long, length long, kind string, reason string, record_type string, record_id string,
 refers_to string, url string, payload_bytes long, payload_digest string, payload binary"""


def with_first(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(page_id, url, html, digest, first): ``first`` is the response a page revisits, else null."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    same = (
        rows.where((F.octet_length("html") >= min_payload) & F.col("page_id").isNotNull())
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1").select(F.col("digest").alias("_digest"), "first")
    )
    same = stored(same)  # apart from the join, so that it can split a frequent digest
    out = rows.join(same, F.col("digest") == F.col("_digest"), "left")
    return out.select("page_id", "url", "html", "digest", F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("first"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP head and leaves the payload to the record it refers to."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if first is not None else head + payload
    name = f"page:{page_id}" if page_id is not None else f"row:{uuid.uuid5(uuid.NAMESPACE_OID, digest)}"
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", f"<urn:{name}>"), ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("WARC-Payload-Digest", "sha256:" + digest),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if first is not None:
        fields += [
            ("WARC-Refers-To", f"<urn:page:{first}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    fields.append(("Content-Length", str(len(block))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, folder: str, rotate: int = ROTATE) -> DataFrame:
    """Write ``with_first`` pages below ``folder``; returns the manifest (file, n_records, n_bytes).

    A file's name holds a random part, so a repeated task never touches another
    attempt's file, and the manifest, stored before it is used, names each file once.
    """

    def run(batches):
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, count, size, done = None, "", 0, 0, []
        for batch in batches:
            for page, url, html, digest, first in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "first"))):
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out, count, size = files.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                data = member(record(page.as_py(), url.as_py(), html.as_py().encode(), digest.as_py(), first.as_py()))
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= rotate:
                    out.close()
                    done.append((f"{folder}/{name}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))], ["file", "n_records", "n_bytes"]
            )

    return stored(pages.select("page_id", "url", "html", "digest", "first").mapInArrow(run, "file string, n_records long, n_bytes long"))


class Salvage:
    """Records and gaps of one archive, read at random places with bounded buffers."""

    def __init__(self, read_at: Callable[[int, int], bytes], size: int):
        self.read_at, self.size = read_at, size

    def items(self) -> Iterator[tuple[int, int, dict | None, str]]:
        """(offset, length, fields of the record or None for a gap, reason)."""
        at = gap = 0
        reason = ""
        while at < self.size:
            found, end, why = self._record(at)
            if found is not None:
                if gap < at:
                    yield gap, at - gap, None, reason
                yield at, end - at, found, ""
                at = gap = end
            else:
                if gap == at:
                    reason = why
                at = self._next(at + 1)
        if gap < self.size:
            yield gap, self.size - gap, None, reason

    def _next(self, at: int) -> int:
        """The next place that looks like a member or a version line."""
        while at < self.size:
            data = self.read_at(at, WINDOW)
            hits = [i for i in (data.find(MAGIC), data.find(VERSION)) if i >= 0]
            if hits:
                return at + min(hits)
            if at + len(data) >= self.size:
                break
            at += len(data) - len(VERSION)
        return self.size

    def _record(self, at: int) -> tuple[dict | None, int, str]:
        head = self.read_at(at, 8)
        if head.startswith(MAGIC):
            data, end = self._member(at)
            if data is None:
                return None, at, "broken gzip member"
            found, used, why = parse(data)
            return (found, end, "") if found is not None and used == len(data) else (None, at, why or "more than a record in the member")
        if head.startswith(VERSION):
            return self._plain(at)
        return None, at, "neither member nor version line"

    def _member(self, at: int) -> tuple[bytes | None, int]:
        z, out, pos = zlib.decompressobj(31), [], at
        try:
            while not z.eof:
                data = self.read_at(pos, WINDOW)
                if not data:
                    return None, at
                out.append(z.decompress(data))
                if not out[0][:7].startswith(VERSION[: len(out[0][:7])]):
                    return None, at  # not a record's member: no need to unpack the rest
                pos += len(data)
        except zlib.error:
            return None, at
        return b"".join(out), pos - len(z.unused_data)

    def _plain(self, at: int) -> tuple[dict | None, int, str]:
        head, want = b"", 4096
        while b"\r\n\r\n" not in head:
            if len(head) >= min(WINDOW, self.size - at):
                return None, at, "no end of the header"
            head = self.read_at(at, want)
            want *= 4
        text = head[: head.index(b"\r\n\r\n") + 4]
        length = content_length(text)
        if length is None or at + len(text) + length + 4 > self.size:
            return None, at, "bad length"
        found, used, why = parse(text + self.read_at(at + len(text), length + 4))
        return found, at + used, why


def content_length(head: bytes) -> int | None:
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value)
    return None


def parse(data: bytes) -> tuple[dict | None, int, str]:
    """(fields, bytes used, reason) of the record that ``data`` starts with."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(VERSION) or end < 0:
        return None, 0, "no header"
    length = content_length(data[: end + 4])
    if length is None or len(data) < end + 8 + length or data[end + 4 + length : end + 8 + length] != b"\r\n\r\n":
        return None, 0, "bad length"
    fields = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not all(fields.get(name) for name in ("warc-type", "warc-record-id", "warc-date")):
        return None, 0, "a mandatory field is missing"
    block = data[end + 4 : end + 4 + length]
    want = fields.get("warc-block-digest", "")
    if want.startswith("sha256:") and hashlib.sha256(block).hexdigest() != want[7:]:
        return None, 0, "block digest"
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if fields.get("warc-type") == "revisit":
        fields |= {"payload": None, "bytes": content_length(head + b"\r\n\r\n"), "digest": stated}
    else:
        digest = hashlib.sha256(payload).hexdigest()
        if stated and stated != digest:
            return None, 0, "payload digest"
        fields |= {"payload": payload, "bytes": len(payload), "digest": digest}
    return fields, end + 8 + length, ""


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of the files that ``manifest`` names, one task per file."""

    def run(batches):
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in RECORD_SCHEMA.split(",")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for file in batch.column("file").to_pylist():
                files, path = pafs.FileSystem.from_uri(file)
                with files.open_input_file(path) as f:
                    rows, held, size = [], 0, f.size()
                    for at, length, x, why in Salvage(lambda o, n: f.read_at(max(0, min(n, size - o)), o), size).items():
                        if x is None:
                            rows.append((file, at, length, "gap", why, *[None] * 7))
                        else:
                            bare = [x.get(k, "").strip("<>") or None for k in ("warc-record-id", "warc-refers-to")]
                            rows.append((
                                file, at, length, "record", None, x.get("warc-type"), *bare, x.get("warc-target-uri"), x["bytes"],
                                x["digest"], x["payload"] if payloads else None,
                            ))
                            held += len(x["payload"] or b"") if payloads else 200
                        if held > 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    n = max(1, manifest.count())
    return manifest.select("file").repartition(min(n, 100_000), "file").mapInArrow(run, RECORD_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back: a row per page."""
    manifest = write_archives(with_first(pages), f"{shared_folder(pages.sparkSession)}/archive")
    records = read_archives(manifest, payloads=False).where("kind = 'record'")

    def number(c):
        return F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1)

    def page(c):
        return F.when(number(c) != "", number(c).cast("long"))

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )
