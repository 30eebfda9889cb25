"""WARC archives of web pages: monolithic gzip files in, one gzip member per record and a sidecar offset index out.

Three steps, each a Spark job whose tasks stream their own files in the shared folder:

1. :func:`write_monoliths`: every partition of the pages writes its records as one gzip stream per file (a new
   file after ``ROLL_BYTES`` or ``ROLL_RECORDS``, so no file grows with the input) and reports a small manifest
   row per record.
2. :func:`normalise`: each file is inflated once from start to end and every record is rewritten as a gzip member
   of its own; a sidecar file lists offset and length of each member. Records that repeat the payload of an
   earlier page are rewritten as revisits. Which ones is decided on the manifest: the smallest page of each
   digest by a map-side combined minimum, joined back as a table of its own, so that adaptive execution can split
   a digest that holds a large share of the pages. Page texts are never shuffled.
3. :func:`read_archives`: the sidecars are read by Spark, cut into ranges of about ``RANGE_BYTES``, and every
   member is inflated alone, at its offset; payload digests are verified.

File names carry a fresh id per task attempt and the names that count are those in the checkpointed rows, so a lost
executor or a second attempt leaves at most a file that nobody reads.

Defined cases: a NULL text is an empty payload; a NULL url becomes ``about:blank``; characters that a header cannot
hold are percent-encoded in the url (read back encoded) and in the page id (read back exactly); a NULL page id ranks
after all others and is read back as NULL; among rows of one page id with equal payloads exactly one is the response
(the first written); an empty table gives empty archives; other columns of the table are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.session import ensure_checkpoint_dir, materialize

ROLL_BYTES = 64 * 1024 * 1024     # uncompressed bytes of one archive
ROLL_RECORDS = 50_000             # records of one archive
RANGE_BYTES = 8 * 1024 * 1024     # compressed bytes that one reading step covers
BLOCK = 1024 * 1024               # bytes read or inflated at a time
MAX_TASKS = 100_000

# Names and texts of the WARC 1.1 format.
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# Header fields of this module's own: the key of the page and of the page that a revisit refers to.
KEY_FIELD = "X-Page-Id"
REFERS_FIELD = "X-Refers-To-Page-Id"

MANIFEST = ("archive string, part long, ordinal long, page_key string, record_id string, payload_bytes long, "
            "same binary")
INDEX = "archive string, offset long, length long, record_id string, record_type string"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, as a URI."""
    ensure_checkpoint_dir(spark)
    uri = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    return re.sub(r"^file:/+", "file:///", uri)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _create(uri: str):
    """An output stream for a new file; its folder is made first."""
    files, path = _open(uri)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return files.open_output_stream(path, compression=None)


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in fields), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + END + block + END


def response_record(key: str | None, url: str | None, payload: bytes, record_id: str, date: str = DATE) -> bytes:
    """The bytes of a response record; ``key`` None leaves its header out."""
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else "about:blank"
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date),
              ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", "sha1:" + _base32(hashlib.sha1(payload).digest())),
              ("Content-Type", "application/http; msgtype=response")]
    if key is not None:
        fields.append((KEY_FIELD, quote(key, safe="")))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    return _record(fields, http + payload)


def revisit_record(head: dict[str, str], block: bytes, refers_id: str, refers_key: str | None) -> bytes:
    """A response record rewritten as a revisit: the HTTP head stays, the payload goes."""
    fields = [("WARC-Type", "revisit")]
    fields += [(k, v) for k, v in head.items() if k not in ("WARC-Type", "Content-Length")]
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_id}>")]
    if refers_key is not None:
        fields.append((REFERS_FIELD, quote(refers_key, safe="")))
    return _record(fields, block[:block.index(END) + len(END)])


def parse_head(raw: bytes) -> dict[str, str]:
    """Header fields of a record head (version line first)."""
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k: v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


class _Inflater:
    """Bytes of a gzip stream of one or more members, inflated in bounded steps."""

    def __init__(self, stream):
        self.stream, self.inflate, self.tail = stream, zlib.decompressobj(31), b""
        self.held, self.at, self.begun = bytearray(), 0, False  # begun: within a gzip member

    def _more(self) -> bool:
        if self.inflate.eof:
            self.tail, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
        chunk = self.tail or self.stream.read(BLOCK)
        got = self.inflate.decompress(chunk, BLOCK)  # without input it hands out what it still holds
        if not chunk and not got and not self.inflate.eof:
            if self.begun or len(self.held) > self.at:
                raise ValueError("archive ends within a record")
            return False
        self.begun = not self.inflate.eof
        self.held += got
        self.tail = b"" if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def until(self, end: bytes) -> bytes | None:
        """Bytes up to ``end``, which is passed over; None at the end of the stream."""
        seen = self.at
        while (place := self.held.find(end, seen)) < 0:
            seen = max(self.at, len(self.held) - len(end) + 1)
            if not self._more():
                return None
        return self._take(place - self.at, len(end))

    def exactly(self, size: int, skip: int) -> bytes:
        while len(self.held) - self.at < size + skip:
            if not self._more():
                raise ValueError("archive ends within a record")
        return self._take(size, skip)

    def _take(self, size: int, skip: int) -> bytes:
        out = bytes(self.held[self.at:self.at + size])
        self.at += size + skip
        if self.at > 4 * BLOCK:
            del self.held[:self.at]
            self.at = 0
        return out


def iterate_records(stream) -> Iterator[tuple[bytes, dict[str, str], bytes]]:
    """(raw head, header fields, block) of every record of a gzip stream, in one pass."""
    source = _Inflater(stream)
    while (raw := source.until(END)) is not None:
        head = parse_head(raw)
        yield raw, head, source.exactly(int(head["Content-Length"]), len(END))


def _member(record: bytes, level: int) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


class _Monolith:
    """One gzip stream of records in a new file."""

    def __init__(self, folder: str, part: int, level: int):
        self.uri = f"{folder}/{part:015d}-{uuid.uuid4().hex}.warc.gz"
        self.part, self.out, self.squeeze = part, _create(self.uri), zlib.compressobj(level, zlib.DEFLATED, 31)
        self.size = self.records = 0

    def add(self, record: bytes) -> None:
        self.out.write(self.squeeze.compress(record))
        self.size += len(record)
        self.records += 1

    def close(self) -> None:
        self.out.write(self.squeeze.flush())
        self.out.close()


def write_monoliths(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", text: str = "html",
                    level: int = 6, roll_bytes: int = ROLL_BYTES, roll_records: int = ROLL_RECORDS) -> DataFrame:
    """Archives of all pages, each file one gzip stream; returns the checkpointed manifest, one row per record."""

    def write(batches):
        task, rolls, now = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            rows = []
            for page, link, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if now is not None and (now.size >= roll_bytes or now.records >= roll_records):
                    now.close()
                    now = None
                if now is None:
                    now, rolls = _Monolith(folder, task * 1_000_000 + rolls, level), rolls + 1
                payload = payload or b""
                record_id = uuid.uuid5(uuid.NAMESPACE_URL, f"{now.part}/{now.records}/{page}").urn
                rows.append((now.uri, now.part, now.records, page, record_id, len(payload),
                             hashlib.sha256(payload).digest()))
                now.add(response_record(page, link, payload, record_id))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), pa.int64(), pa.int64(), pa.string(),
                                                                 pa.string(), pa.int64(), pa.binary()])],
                    names=["archive", "part", "ordinal", "page_key", "record_id", "payload_bytes", "same"])
        if now is not None:
            now.close()

    columns = pages.select(F.col(key).cast("string"), F.col(url).cast("string"), F.col(text).cast("binary"))
    return materialize(columns.mapInArrow(write, MANIFEST))


def find_revisits(manifest: DataFrame, key_type: str, min_bytes: int = 0) -> DataFrame:
    """archive, ordinal, refers_id, refers_key of every record whose payload a smaller page holds.

    Pages compare by their key as ``key_type``, ties by their place in the archives.
    """
    rows = manifest.where(F.col("payload_bytes") >= min_bytes)
    place = F.struct(F.col("page_key").isNull().alias("none"), F.col("page_key").cast(key_type).alias("page"),
                     "part", "ordinal", "record_id", "page_key")
    firsts = rows.groupBy("same").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = materialize(firsts.where("n > 1").select(
        "same", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("part", "ordinal", "record_id", "page_key")]))
    later = (F.col("part") != F.col("first_part")) | (F.col("ordinal") != F.col("first_ordinal"))
    return rows.join(firsts, "same").where(later).select(
        "archive", "ordinal", F.col("first_record_id").alias("refers_id"), F.col("first_page_key").alias("refers_key"))


def normalise(archives: DataFrame, revisits: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite every archive with one gzip member per record; returns the index, one row per member.

    ``archives`` has a column ``archive`` (URIs of gzip WARC files, one member or several), ``revisits`` is as from
    :func:`find_revisits` and holds at most one row per record of an archive. The sidecar of ``x.warc.gz`` is a
    JSON-lines file of the same name in ``index``.
    """

    def rewrite(batches):
        for batch in batches:
            done = []
            for uri, changes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                known = {c["ordinal"]: c for c in changes or ()}
                name, offset, lines = uuid.uuid4().hex, 0, []
                target = f"{folder}/records/{name}.warc.gz"
                files, path = _open(uri)
                with files.open_input_stream(path, compression=None) as source, _create(target) as out:
                    for ordinal, (raw, head, block) in enumerate(iterate_records(source)):
                        kind, change = head.get("WARC-Type", ""), known.get(ordinal)
                        if change is None:
                            record = raw + END + block + END
                        else:
                            kind = "revisit"
                            record = revisit_record(head, block, change["refers_id"], change["refers_key"])
                        member = _member(record, level)
                        out.write(member)
                        lines.append('{"archive":"%s","offset":%d,"length":%d,"record_id":"%s","record_type":"%s"}\n' % (
                            target, offset, len(member), head["WARC-Record-ID"].strip("<>"), kind))
                        offset += len(member)
                with _create(f"{folder}/index/{name}.json") as out:
                    out.write("".join(lines).encode())
                done.append(target)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["archive"])

    changes = revisits.groupBy("archive").agg(F.collect_list(F.struct("ordinal", "refers_id", "refers_key")).alias("c"))
    work = materialize(archives.select("archive").distinct().join(changes, "archive", "left"))
    files, path = _open(f"{folder}/index")
    files.create_dir(path, recursive=True)
    written = materialize(work.repartition(_tasks(work)).mapInArrow(rewrite, "archive string"))
    lines = work.sparkSession.read.schema(INDEX).json(f"{folder}/index")
    return lines.join(written, "archive", "left_semi")


def _tasks(rows: DataFrame) -> int:
    return max(1, min(MAX_TASKS, rows.count()))


def read_archives(index: DataFrame, payload: bool = True) -> DataFrame:
    """page_key, record_id, record_type, url, payload_bytes, payload_digest, refers_key (and payload, NULL for revisits).

    Every member is read at its own offset, and the payload of a response is held against its digest.
    """

    def read(batches):
        for batch in batches:
            for uri, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                members = sorted((m["offset"], m["length"]) for m in members)
                files, path = _open(uri)
                rows = []
                with files.open_input_file(path) as source:
                    for offset, length in members:
                        source.seek(offset)
                        rows.append(_read_member(source.read(length), payload))
                yield pa.RecordBatch.from_pylist(rows, schema)

    fields = [("page_key", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
              ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_key", pa.string())]
    schema = pa.schema(fields + [("payload", pa.binary())] * payload)
    out = ("page_key string, record_id string, record_type string, url string, payload_bytes long, "
           "payload_digest string, refers_key string") + ", payload binary" * payload
    ranges = index.groupBy("archive", F.floor(F.col("offset") / RANGE_BYTES).alias("step")).agg(
        F.collect_list(F.struct("offset", "length")).alias("members"))
    ranges = materialize(ranges.select("archive", "members"))
    return ranges.repartition(_tasks(ranges)).mapInArrow(read, out)


def _read_member(data: bytes, keep: bool) -> dict:
    raw, _, rest = zlib.decompress(data, 31).partition(END)
    head = parse_head(raw)
    block = rest[:int(head["Content-Length"])]
    http, _, payload = block.partition(END)
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?im)^Content-Length: *(\d+)", http)[1])
    kind = head["WARC-Type"]
    if kind == "response" and (len(payload) != size or _base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    key, refers = head.get(KEY_FIELD), head.get(REFERS_FIELD)
    row = {"page_key": None if key is None else unquote(key), "record_id": head["WARC-Record-ID"].strip("<>"),
           "record_type": kind, "url": head.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
           "refers_key": None if refers is None else unquote(refers)}
    return row | ({"payload": payload if kind == "response" else None} if keep else {})


def archive_pages(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, key: str = "page_id", url: str = "url",
                  text: str = "html") -> DataFrame:
    """Write, normalise and index the archives of all pages below ``folder``; returns the index of the result."""
    manifest = write_monoliths(pages, f"{folder}/monoliths", key, url, text)
    revisits = find_revisits(manifest, pages.schema[key].dataType.simpleString(), min_revisit_bytes)
    return normalise(manifest.select("archive"), revisits, folder)


def page_report(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as read back from its archive."""
    kind = pages.schema["page_id"].dataType.simpleString()
    index = archive_pages(pages, shared_folder(pages.sparkSession, "warc"), min_revisit_bytes)
    return read_archives(index, payload=False).select(
        F.col("page_key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_key").cast(kind).alias("refers_to"))
