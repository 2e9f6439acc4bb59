"""WARC archives with a two-level capture index: compressed blocks of sorted keys under a sparse directory."""

from __future__ import annotations

import bisect
import gzip
import json
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm.common import materialize

BLOCK_LINES = 1000
ARCHIVE_BYTES = 1 << 30
CAPTURE_DATE = "2024-01-01T00:00:00Z"  # the pages table has no capture time
MIN_REVISIT_BYTES = 100
READ_BYTES = 256 << 20  # of archives per reading task, about
STRETCH = 64 << 20  # of an archive, read by one task
PART_LINES = 1_000_000  # of the index, about

ENTRY_SCHEMA = ("key string, page_id long, file string, offset long, length long, record_type string, "
                "payload_digest string, payload_bytes long, refers_to long")


# --- files in the shared folder -------------------------------------------------------------

# Schemes that Hadoop and Arrow name differently.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme and host by which Spark itself resolves it; a path on the local
    file system, such as a mount that all executors share, stays plain."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return file_system(whole)[1] if whole.startswith("file:/") else whole


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a qualified folder or file, and the path in it."""
    scheme, sign, rest = uri.partition(":/")
    if not sign:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:/{rest}")


def tasks_for(spark: SparkSession, amount: int, per_task: int) -> int:
    """Numbered partitions: their rows are pointers, by whose bytes adaptive execution would merge
    what reads many times as much."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), amount // per_task + 1)


class Ranges:
    """Reads byte ranges, with few files open at a time."""

    def __init__(self, most_open: int = 16):
        self.most_open = most_open
        self.open: OrderedDict[str, pa.NativeFile] = OrderedDict()

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri not in self.open:
            store, path = file_system(uri)
            self.open[uri] = store.open_input_file(path)
            if len(self.open) > self.most_open:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(uri)
        return self.open[uri].read_at(length, offset)


# --- records --------------------------------------------------------------------------------

def url_key(url: str | None) -> str:
    """The host reversed by its labels, then port, path and query: ``com,example)/a?b``."""
    if not url:
        return ")"
    clean = quote(url.strip(), safe="!#$%&'()*+,/:;=?@[]~|^\\\"<>{}`")
    try:
        parts = urlsplit(clean)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = port = None
    if not host:
        return f"){clean}"
    reversed_host = ",".join(reversed(host.rstrip(".").split(".")))
    query = f"?{parts.query}" if parts.query else ""
    return f"{reversed_host}{f':{port}' if port else ''}){parts.path or '/'}{query}"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member holding a response record, or a revisit record without the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {CAPTURE_DATE}", f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Page-ID: {'' if page_id is None else page_id}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(body)}")
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", compresslevel=4, mtime=0)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and HTTP payload of a record."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *fields = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(f.split(": ", 1) if ": " in f else (f.rstrip(":"), "") for f in fields)
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


# --- writing --------------------------------------------------------------------------------

def page_roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, html, payload_digest, first: the page whose payload a revisit refers to."""
    source = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    source = source.withColumn("payload_digest", F.sha2("html", 256))
    # copies combine before the shuffle; written, so that the join can split a large group of them
    groups = materialize(
        source.where(F.octet_length("html") >= MIN_REVISIT_BYTES).groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "first"),
        "warc-groups")
    return source.join(groups, "payload_digest", "left")


def write_archives(pages: DataFrame, folder: str, **names: str) -> DataFrame:
    """Write one record per page into gzip archives under ``folder``; return their index entries.

    Each task writes files of its own under unique names and reports where each record lies, so
    what a lost or repeated task leaves behind is never referred to.
    """
    folder = qualified(pages.sparkSession, folder)
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        out, name, offset = None, "", 0
        fields = ("page_id", "url", "html", "payload_digest", "first")
        for batch in batches:
            rows = []
            for page, url, html, digest, first in zip(*(batch.column(c).to_pylist() for c in fields), strict=True):
                if out is None or offset >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"archive-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = html.encode()
                revisit = first is not None and page != first
                member = record(page, url, payload, digest, first, revisit)
                out.write(member)
                rows.append((url_key(url), page, f"{folder.rstrip('/')}/{name}", offset, len(member),
                             "revisit" if revisit else "response", digest, len(payload), first if revisit else None))
                offset += len(member)
            yield _entries(rows)
        if out is not None:
            out.close()

    return materialize(page_roles(pages, **names).mapInArrow(run, ENTRY_SCHEMA), "warc-entries")


_ENTRY = pa.schema([
    ("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64())])


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t.type) for i, t in enumerate(_ENTRY)], schema=_ENTRY)


# --- index ----------------------------------------------------------------------------------

class CaptureIndex:
    """Sorted blocks of index lines, one directory per part, and the list of parts.

    ``parts`` holds (first key, last key, blocks file, directory file, directory bytes) per part,
    so it grows with the number of write tasks, not with the captures.
    """

    def __init__(self, parts: list[tuple[str, str, str, str, int]]):
        self.parts = sorted(parts)
        self.lasts = [p[1] for p in self.parts]

    def blocks(self, key: str, files: Ranges, seen: dict[str, tuple]) -> list[tuple[str, int, int]]:
        """(file, offset, length) of every block that may hold ``key``, by binary search."""
        out = []
        at = bisect.bisect_left(self.lasts, key)  # first part whose last key is not below
        while at < len(self.parts) and self.parts[at][0] <= key:
            _, _, blocks_file, directory_file, size = self.parts[at]
            if directory_file not in seen:
                seen.clear()  # keys come in order: one directory at a time
                directory = json.loads(gzip.decompress(files.read(directory_file, 0, size)))
                seen[directory_file] = (directory, [d[0] for d in directory])
            directory, firsts = seen[directory_file]
            start = max(0, bisect.bisect_left(firsts, key) - 1)  # the block before may end with it
            end = bisect.bisect_right(firsts, key)
            out += [(blocks_file, d[1], d[2]) for d in directory[start:end]]
            at += 1
        return out


PART_SCHEMA = "first string, last string, blocks string, directory string, size long"


def build_index(entries: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Sort the entries by key over all tasks and write blocks and directories under ``folder``.

    A key with very many captures is spread by page, so no task holds a whole hot host or page.
    """
    spark = entries.sparkSession
    folder = qualified(spark, folder)
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        name = uuid.uuid4().hex
        out, offset, directory, lines, first, last = None, 0, [], [], None, None

        def close_block() -> None:
            nonlocal offset, lines
            member = gzip.compress("\n".join(lines).encode(), compresslevel=4, mtime=0)
            out.write(member)
            directory.append([json.loads(lines[0])["key"], offset, len(member)])
            offset, lines = offset + len(member), []

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    out = store.open_output_stream(f"{base}/blocks-{name}.gz", compression=None)
                    first = row["key"]
                last = row["key"]
                lines.append(json.dumps(row))
                if len(lines) >= block_lines:
                    close_block()
        if out is None:
            return
        if lines:
            close_block()
        out.close()
        packed = gzip.compress(json.dumps(directory).encode(), mtime=0)
        with store.open_output_stream(f"{base}/directory-{name}.gz", compression=None) as f:
            f.write(packed)
        top = folder.rstrip("/")
        yield pa.RecordBatch.from_pylist(
            [{"first": first, "last": last, "blocks": f"{top}/blocks-{name}.gz", "directory": f"{top}/directory-{name}.gz",
              "size": len(packed)}],
            pa.schema([("first", pa.string()), ("last", pa.string()), ("blocks", pa.string()), ("directory", pa.string()),
                       ("size", pa.int64())]))

    n = tasks_for(spark, entries.count(), PART_LINES)
    ordered = entries.repartitionByRange(n, "key", "page_id", "offset").sortWithinPartitions("key", "page_id", "file", "offset")
    parts = materialize(ordered.mapInArrow(run, PART_SCHEMA), "warc-parts")
    return CaptureIndex([tuple(r) for r in parts.collect()])  # one row per part


def lookup(keys: DataFrame, index: CaptureIndex, spark: SparkSession) -> DataFrame:
    """The index entries of the wanted keys (column ``key``; repeated keys count once).

    Binary search in the directories tells the blocks; each wanted block is then read once, by
    range, whatever number of keys it holds.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, seen = Ranges(), {}
        for batch in batches:
            rows = [(key, *block) for key in batch.column("key").to_pylist() for block in index.blocks(key, files, seen)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))],
                names=["key", "block", "offset", "length"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at, found = Ranges(), None, {}
        for batch in batches:
            rows = []
            for key, block, offset, length in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "offset", "length")), strict=True):
                if at != (block, offset):
                    at, found = (block, offset), {}
                    for line in gzip.decompress(files.read(block, offset, length)).decode().split("\n"):
                        entry = json.loads(line)
                        found.setdefault(entry["key"], []).append(tuple(entry[f.name] for f in _ENTRY))
                rows += found.get(key, [])
            yield _entries(rows)

    n = tasks_for(spark, len(index.parts), 1)
    wanted = keys.select("key").where("key IS NOT NULL").distinct().repartitionByRange(n, "key").sortWithinPartitions("key")
    blocks = wanted.mapInArrow(find, "key string, block string, offset long, length long")
    return (blocks.repartition(n, "block", "offset").sortWithinPartitions("block", "offset", "key")
            .mapInArrow(read, ENTRY_SCHEMA))


def read_records(entries: DataFrame) -> DataFrame:
    """page_id, record_type, header_digest, refers_to and the payload of the entries' records.

    ``entries`` is read twice, the first time for the bytes to read; a written table is best.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Ranges()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                for e in batch.slice(at, 500).to_pylist():
                    headers, payload = parse_record(files.read(e["file"], e["offset"], e["length"]))
                    page, refers = headers["X-Page-ID"], headers.get("X-Refers-To-Page-ID")
                    rows.append({
                        "page_id": int(page) if page else None, "record_type": headers["WARC-Type"],
                        "header_digest": headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                        "refers_to": int(refers) if refers else None, "payload": payload})
                yield pa.RecordBatch.from_pylist(rows, pa.schema([
                    ("page_id", pa.int64()), ("record_type", pa.string()), ("header_digest", pa.string()),
                    ("refers_to", pa.int64()), ("payload", pa.binary())]))

    stretch = (F.col("offset") / F.lit(STRETCH)).cast("long")
    amount = entries.agg(F.sum("length")).first()[0] or 0
    n = tasks_for(entries.sparkSession, amount, READ_BYTES)
    return (entries.select("file", "offset", "length").repartition(n, "file", stretch).sortWithinPartitions("file", "offset")
            .mapInArrow(run, "page_id long, record_type string, header_digest string, refers_to long, payload binary"))


def archive_round_trip(pages: DataFrame, folder: str, **names: str) -> DataFrame:
    """Write all pages, look every page's key up in the index, read the records back.

    Per page: page_id, payload_bytes, payload_digest, record_type, refers_to. Sizes and digests
    of responses are taken from the payload as read; a revisit takes them from the response it
    refers to, found by page and digest.

    Of equal payloads of at least ``MIN_REVISIT_BYTES`` bytes the page with the lowest id is the
    response. A null payload is empty; a null url has the key ``)``; pages without an id are
    revisits where a copy has one, else responses; rows that repeat the lowest id are responses
    each; an empty table gives no rows and no archive; extra columns are ignored.
    """
    spark = pages.sparkSession
    entries = write_archives(pages, f"{folder.rstrip('/')}/archives", **names)
    index = build_index(entries, f"{folder.rstrip('/')}/index")
    records = read_records(materialize(lookup(entries.select("key"), index, spark), "warc-found"))
    records = materialize(
        records.select("page_id", "record_type", "header_digest", "refers_to", F.length("payload").cast("long").alias("payload_bytes"),
                       F.sha2("payload", 256).alias("payload_digest")), "warc-records")
    responses = materialize(
        records.where("record_type = 'response'")
        .select(F.col("page_id").alias("p"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n")).distinct(),
        "warc-responses")
    revisits = records.where("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("p")) & (F.col("header_digest") == F.col("d")))
    own = records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return own.unionByName(revisits.select(
        "page_id", F.col("n").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type", "refers_to"))
