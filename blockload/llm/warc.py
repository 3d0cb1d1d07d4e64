"""WARC archives (operator 8): a writer, and a reader that splits files.

Writing: one gzip member per record, several archives per job. Of records
with equal payloads of at least ``MIN_REVISIT`` bytes the one with the largest
page id is a response, the others are revisits that refer to it and carry no
payload; their headers keep digest and length of the full payload.

Reading: files are cut into byte ranges. A task reads its range, looks for
gzip magic, takes a place for a member only if a header decodes there and the
first inflated bytes start a WARC record, and owns the records that start inside
its range, reading past its end to finish the last one. After a member the next
must follow, so magic inside compressed data is only ever met before the first
member of a range. A member may hold many records; they are read one after the
other, as is a file that is not compressed, by the task of its first range.

Scale: the digest join moves page ids and the html once; copies of one
payload are reduced to one row (largest id) before it. Writer tasks stream
records to files of bounded size and name them by task attempt; only files of
attempts whose rows were committed are listed, so a repeated task leaves
nothing but an unlisted file. Files are opened through pyarrow's file systems
(local and shared folders, HDFS, S3, GCS), never copied to a task's disk.

Defined results: null html is an empty payload, null or empty url becomes
``urn:page:<id>``; control characters in a url are percent-encoded; rows with a
null page_id are responses and are never referred to; repeated rows with the
largest page_id are all responses. No pages: no archives, an empty result. A
member that is cut short, fails its checksum or holds something else than whole
records raises, with file and place; with ``damaged="report"`` it gives a row of
type ``damaged`` instead, behind the records read before the damage, and reading
goes on with the next member. So does anything but zeros between members.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockload.llm.runtime import pick, ship
from blockload.session import new_path

MIN_REVISIT = 1000
FILE_BYTES = 256 << 20      # an archive is closed once it is this long
RANGE_BYTES = 16 << 20      # byte range of a reading task
LEVEL = 6
PIECE = 4 << 20             # inflated bytes that are made at a time
DAMAGED = "damaged"
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the formats: gzip magic with the deflate method, the first
# bytes of a record, the profile of a revisit.
MAGIC = b"\x1f\x8b\x08"
RECORD = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

FILES = "path string, bytes long, records long"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "target_uri string, payload binary, path string, start long, part int")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The pyarrow file system of a Spark path, and the path in it."""
    if "://" not in path and ":/" not in path:
        return fs.LocalFileSystem(), path
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           refers_url: str | None) -> bytes:
    """A record as one gzip member."""
    uri = _uri(page_id, url)
    sha1 = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    block = HTTP if refers_to is not None else HTTP + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", sha1), ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", len(block)), ("X-Payload-Length", len(payload))]
    if page_id is not None:
        fields.append(("X-Page-ID", page_id))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                   ("WARC-Refers-To-Target-URI", _uri(refers_to, refers_url)), ("X-Refers-To-Page-ID", refers_to)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def _uri(page_id: int | None, url: str | None) -> str:
    url = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    return url or f"urn:page:{page_id if page_id is not None else 'unknown'}"


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        out, path, size, records, done = None, "", 0, 0, []

        def close() -> None:
            nonlocal out
            out.close()
            done.append((path, size, records))
            out = None

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to", "refers_url"))):
                page_id, url, html, digest, refers_to, refers_url = (v.as_py() for v in row)
                data = member(page_id, url, (html or "").encode("utf-8", "surrogatepass"), digest, refers_to, refers_url)
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    system.create_dir(base, recursive=True)
                    out, path, size, records = system.open_output_stream(f"{base}/{name}", compression=None), \
                        f"{folder}/{name}", 0, 0
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= FILE_BYTES:
                    close()
        if out is not None:
            close()
        cols = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.int64())], names=["path", "bytes", "records"])
    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives into ``folder`` and
    returns the list of files (path, bytes, records), itself a stored table."""
    spark = pages.sparkSession
    ship(spark)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
        F.sha1(html).alias("digest"), F.octet_length(html).alias("n"))
    firsts = (rows.where((F.col("n") >= MIN_REVISIT) & F.col("page_id").isNotNull())
              .groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("r"), F.min("page_id").alias("least"))
              .where(F.col("r.page_id") > F.col("least"))
              .select("digest", F.col("r.page_id").alias("refers_to"), F.col("r.url").alias("refers_url")))
    linked = rows.join(firsts, "digest", "left")
    other = F.col("page_id") < F.col("refers_to")
    linked = linked.select("page_id", "url", "html", "digest", F.when(other, F.col("refers_to")).alias("refers_to"),
                           F.when(other, F.col("refers_url")).alias("refers_url"))
    listing = f"{folder}-files"
    linked.mapInArrow(_writer(folder), FILES).write.parquet(listing)
    return spark.read.schema(FILES).parquet(listing)


class Damaged(ValueError):
    """Bytes that are not what a record or member should be."""


class _Member:
    """The inflated bytes of the member at ``at``; ``read(place)`` gives the next
    bytes of the file from there on. ``end`` is the place after the member."""

    def __init__(self, read, at: int, first: bytes) -> None:
        self.read, self.at, self.first, self.end = read, at, first, -1

    def __iter__(self) -> Iterator[bytes]:
        inflater = zlib.decompressobj(31)
        data, place = self.first, self.at
        while data:
            place += len(data)
            while True:
                try:
                    out = inflater.decompress(data, PIECE)
                except zlib.error as e:
                    raise Damaged(str(e)) from e
                data = inflater.unconsumed_tail
                if out:
                    yield out
                if inflater.eof:
                    self.end = place - len(inflater.unused_data)
                    return
                if not data and not out:
                    break
            data = self.read(place)
        raise Damaged("the member is cut short")


class _Text:
    """Bytes that come in pieces."""

    def __init__(self, pieces) -> None:
        self.pieces, self.data = iter(pieces), bytearray()

    def has(self, n: int) -> bool:
        """Whether ``n`` more bytes are there."""
        while len(self.data) < n:
            piece = next(self.pieces, None)
            if piece is None:
                return False
            self.data += piece
        return True

    def take(self, n: int) -> bytes:
        if not self.has(n):
            raise Damaged(f"a record of {n} bytes ends after {len(self.data)}")
        out = bytes(self.data[:n])
        del self.data[:n]
        return out

    def until(self, mark: bytes) -> bytes:
        at = self.data.find(mark)
        while at < 0:
            seen = max(0, len(self.data) - len(mark))
            if not self.has(len(self.data) + 1):
                raise Damaged("a record's header has no end")
            at = self.data.find(mark, seen)
        return self.take(at + len(mark))[:at]

    def rest(self) -> bytes:
        while self.has(len(self.data) + 1):
            pass
        return self.take(len(self.data))


def records(text: _Text) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of the records that follow
    one another."""
    while True:
        while text.has(1) and text.data[0] in b"\r\n":
            text.take(1)
        if not text.has(1):
            return
        if not text.has(len(RECORD)) or not text.data.startswith(RECORD):
            raise Damaged("no record begins where one should")
        fields = {}
        for line in text.until(b"\r\n\r\n").decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        length = fields.get("content-length")
        if length is not None and not (length.isascii() and length.isdigit()):
            raise Damaged(f"a record of length {length!r}")
        yield fields, text.rest() if length is None else text.take(int(length))


def members(source, begin: int, end: int, size: int,
            window: int = 1 << 20) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(start, number in the member, fields, block) of the records in members
    that start in [begin, end); a damaged one has the number -1 and, in
    ``error``, what is wrong. A file that is not compressed is one member."""
    def read(place: int, n: int = window) -> bytes:
        return source.read_at(min(n, size - place), place) if place < size else b""

    def told(at: int, text: _Text) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
        part = 0
        try:
            for fields, block in records(text):
                yield at, part, fields, block
                part += 1
        except Damaged as e:
            yield at, -1, {"error": str(e)}, b""

    if read(0, len(RECORD)) == RECORD:
        if begin == 0:
            yield from told(0, _Text(read(at) for at in range(0, size, window)))
        return
    def opened(at: int, first: bytes) -> tuple[_Member, _Text, str | None]:
        """A member, its text, and what is wrong with its start."""
        member = _Member(read, at, first)
        text, error = _Text(member), None
        try:
            if not text.has(len(RECORD)) or not text.data.startswith(RECORD):
                error = "no record in a member"
        except Damaged as e:
            error = str(e)
        return member, text, error

    def missing(at: int, there: bytes) -> str | None:
        """What is wrong where a member should begin; zeros are none."""
        if there.startswith(MAGIC):
            return opened(at, there)[2]
        return "no member begins where one should" if there[:len(MAGIC)].strip(b"\0") else None

    buffer, base, at, follows = b"", begin, begin, begin == 0   # follows: a member has to begin here
    while at < end:
        if at - base + 18 > len(buffer):       # keep a header's length in sight
            buffer, base = read(at), at
        if follows and (error := missing(at, buffer[at - base:])):
            yield at, -1, {"error": error}, b""
            at, follows = at + 1, False
            continue
        follows = False
        found = buffer.find(MAGIC, at - base)
        if found < 0:
            step = base + len(buffer) - (len(MAGIC) - 1)
            if base + len(buffer) >= size or step <= at:
                return
            buffer, base, at = read(step), step, step
            continue
        at = base + found
        if at >= end:
            return
        member, text, error = opened(at, buffer[found:] if len(buffer) - found >= 18 else read(at))
        row = (at, -1, {}, b"")
        if error is None:
            for row in told(at, text):
                yield row
        at, follows = (member.end, True) if row[1] >= 0 else (at + 1, False)
    # The next member is another task's, unless nobody can find its start.
    if follows and at < size and (error := missing(at, read(at))):
        yield at, -1, {"error": error}, b""


def _reader(keep_payload: bool, damaged: str):
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in RECORDS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def number(fields: dict[str, str], name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin, end, size in zip(*(batch.column(c).to_pylist() for c in ("path", "begin", "end", "bytes"))):
                system, place = file_system(path)
                rows, held = [], 0
                with system.open_input_file(place) as source:
                    for start, part, fields, block in members(source, begin, end, size):
                        if part < 0:
                            if damaged != "report":
                                raise Damaged(f"{path} at byte {start}: {fields['error']}")
                            rows.append((None, None, None, DAMAGED, None, None, None, path, start, part))
                            continue
                        kind = fields.get("warc-type", "")
                        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else b""
                        digest = fields.get("warc-payload-digest", "")
                        digest = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
                        n = number(fields, "x-payload-length")
                        if kind == "response":   # what is in the record counts, not what its header says
                            n, digest = len(payload), hashlib.sha1(payload).hexdigest()
                        rows.append((number(fields, "x-page-id"), n, digest, kind, number(fields, "x-refers-to-page-id"),
                                     fields.get("warc-target-uri"), payload if keep_payload else None, path, start, part))
                        held += len(payload) if keep_payload else 100
                        if held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)
    return run


def list_archives(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, bytes) of existing archives, from Spark's file listing."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.col("length").alias("bytes"))


def read_archives(files: DataFrame, keep_payload: bool = True, range_bytes: int = RANGE_BYTES,
                  damaged: str = "raise") -> DataFrame:
    """The records of the archives in ``files`` (path, bytes), read by ranges;
    ``damaged`` is "raise" or "report"."""
    if damaged not in ("raise", "report"):
        raise ValueError(f"damaged must be raise or report, not {damaged!r}")
    spark = files.sparkSession
    ship(spark)
    begins = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0).cast("long")),
                        F.lit(range_bytes).cast("long"))
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(begins).alias("begin")).select(
        "path", "bytes", "begin", F.least(F.col("begin") + range_bytes, F.col("bytes")).alias("end"))
    n = max(1, ranges.count())
    spread = ranges.repartitionByRange(min(n, 100_000), F.xxhash64("path", "begin"))
    return spread.mapInArrow(_reader(keep_payload, damaged), RECORDS)


def archive_records(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes ``pages`` as archives, reads them back, one row per record."""
    files = write_archives(pages, folder or new_path(pages.sparkSession, "warc"))
    return read_archives(files, keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
