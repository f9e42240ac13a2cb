"""WARC archives, written with an index first and read by byte ranges.

``write_archives`` deals records to archives, one archive per task, and writes
one gzip member per record.  Its result is the index: archive, offset and
length of the member, target URI, payload digest, type.  Digests are known
before anything is written, so a payload that an earlier record has is written
as a ``revisit`` that names that record.

``read_records`` takes any selection of index rows, sorts them by archive and
offset, joins ranges that lie close together into one read, and yields the
records with their payloads.

Archives go below a path that the driver and all executors share; files are
opened through ``pyarrow.fs``, so a store's URI works as well as a folder.  A
file's name carries the attempt of its task, and the index rows of the attempt
that counts name it: a task that runs again leaves no half-written archive
behind that an index row points to.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.session import materialise, scratch_path

#: Equal payloads below this size are written each time.
MIN_REVISIT_BYTES = 100
#: Ranges of an archive this near are read at once, up to this much.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: Archive bytes that one task reads back.
TASK_BYTES = 32 << 20
_DATE = "1970-01-01T00:00:00Z"
INDEX = ("record_id long, archive string, offset long, length long, url string, payload_digest string, "
         "payload_bytes long, record_type string, refers_to long")


def described(pages: DataFrame) -> DataFrame:
    """``(record_id, url, payload, payload_digest, payload_bytes, record_type,
    refers_to)`` per page, ``payload`` the html as UTF-8 (null: empty).

    Among equal payloads of ``MIN_REVISIT_BYTES`` or more the record with the
    smallest page_id is the response and the others are revisits of it.  Only
    digests are grouped: a payload that a third of the pages share is one row
    per task before the shuffle.  A page without page_id is always a response
    and is referred to by none; rows that repeat a page_id and its payload
    are all responses, or revisits of the same record.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("record_id"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("payload_digest"),
                       F.octet_length("payload").cast("long").alias("payload_bytes"))
    big = rows.where((F.col("payload_bytes") >= MIN_REVISIT_BYTES) & F.col("record_id").isNotNull())
    first = materialise(
        big.groupBy("payload_digest").agg(F.min("record_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("payload_digest", "first_id"), "warc-first")
    rows = rows.join(first, "payload_digest", "left")
    again = F.col("first_id") < F.col("record_id")
    return rows.select("record_id", "url", "payload", "payload_digest", "payload_bytes",
                       F.when(again, "revisit").otherwise("response").alias("record_type"),
                       F.when(again, F.col("first_id")).alias("refers_to"))


def _record_name(record_id) -> str:
    return f"<urn:page:{'none' if record_id is None else record_id}>"


def _plain_url(url: str) -> str:
    """A URL as a header can hold it: blanks and signs that do not print as ``%20``."""
    return "".join(c if c.isprintable() and c != " " else "%20" for c in url)


def _url_of(fields: dict[str, str]) -> str:
    """The page's own URL."""
    return unquote(fields["X-Source-URL"]) if "X-Source-URL" in fields else fields["WARC-Target-URI"]


def record_bytes(row: dict) -> bytes:
    """One WARC/1.1 record; a revisit has no payload of its own."""
    block = b"" if row["record_type"] == "revisit" else row["payload"]
    head = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", _record_name(row["record_id"])),
        ("WARC-Target-URI", _plain_url(row["url"])),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("X-Payload-Length", str(row["payload_bytes"])),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(block))),
    ]
    if _plain_url(row["url"]) != row["url"]:
        head.append(("X-Source-URL", quote(row["url"])))  # each byte by its own value
    if row["record_type"] == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", _record_name(row["refers_to"]))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, rest[:size]


def _open(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(), path)


def write_archives(records: DataFrame, path: str) -> DataFrame:
    """Write ``described`` records below ``path``; the index, itself written
    as a table there, has a row per record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(path)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        offset, out = 0, None
        try:
            for b in batches:
                at, size = [], []
                for row in b.to_pylist():
                    if out is None:
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(record_bytes(row)) + packer.flush()
                    out.write(member)
                    at.append(offset)
                    size.append(len(member))
                    offset += len(member)
                get = lambda c: b.column(b.schema.get_field_index(c))
                yield pa.RecordBatch.from_arrays(
                    [get("record_id"), pa.array([f"{path}/{name}"] * len(at), pa.string()),
                     pa.array(at, pa.int64()), pa.array(size, pa.int64()), get("url"), get("payload_digest"),
                     get("payload_bytes"), get("record_type"), get("refers_to")],
                    ["record_id", "archive", "offset", "length", "url", "payload_digest", "payload_bytes",
                     "record_type", "refers_to"])
        finally:
            if out is not None:
                out.close()

    return materialise(records.mapInArrow(run, INDEX), "warc-index")


def ranges(rows: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """Reads for sorted ``(offset, length)`` rows: ``(start, size, first row,
    row after the last)``; near ranges share one."""
    out: list[tuple[int, int, int, int]] = []
    for k, (offset, length) in enumerate(rows):
        if out:
            start, size, first, _ = out[-1]
            end = max(start + size, offset + length)
            if offset - (start + size) <= GAP_BYTES and end - start <= READ_BYTES:
                out[-1] = (start, end - start, first, k + 1)
                continue
        out.append((offset, length, k, k + 1))
    return out


READ = ("record_id long, url string, record_type string, refers_to long, payload_digest string, "
        "payload_bytes long, payload binary")


def read_records(index: DataFrame) -> DataFrame:
    """The records that ``index`` rows name, read back from the archives.

    Every record's block is checked against its digest; ``payload`` is null
    for revisits (see ``refers_to``).  Rows are dealt out by archive and
    offset, so a large archive is shared between tasks.  An empty selection
    gives no rows and reads nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, name = None, None
        for b in batches:
            rows = b.to_pylist()
            at = 0
            while at < len(rows):
                end = at
                while end < len(rows) and rows[end]["archive"] == rows[at]["archive"]:
                    end += 1
                if rows[at]["archive"] != name:
                    if source is not None:
                        source.close()
                    name = rows[at]["archive"]
                    fs, path = _open(name)
                    source = fs.open_input_file(path)
                part = rows[at:end]
                for start, size, first, last in ranges([(r["offset"], r["length"]) for r in part]):
                    data, out = source.read_at(size, start), []
                    for r in part[first:last]:
                        low = r["offset"] - start
                        fields, block = parsed(zlib.decompress(data[low:low + r["length"]], 31))
                        digest, again = fields["WARC-Payload-Digest"].split(":")[1], fields["WARC-Type"] == "revisit"
                        if not again and hashlib.sha256(block).hexdigest() != digest:
                            raise ValueError(f"record at {r['offset']} of {name} does not match its digest")
                        number = lambda x: None if x == "none" else int(x)
                        key = number(fields["WARC-Record-ID"][len("<urn:page:"):-1])
                        to = number(fields["WARC-Refers-To"][len("<urn:page:"):-1]) if again else None
                        out.append((key, _url_of(fields), fields["WARC-Type"], to, digest,
                                    int(fields["X-Payload-Length"]) if again else len(block),
                                    None if again else block))
                    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [
                        "record_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes",
                        "payload"])
                at = end
        if source is not None:
            source.close()

    rows = index.select("archive", "offset", "length")
    # index rows are small, what they point to is not: tasks by the bytes to read
    total = rows.agg(F.sum("length")).first()[0] or 0
    dealt = (rows.repartitionByRange(total // TASK_BYTES + 1, "archive", "offset")
             .sortWithinPartitions("archive", "offset"))
    return dealt.mapInArrow(run, READ)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write all pages as archives; the index.  ``path``: a shared folder or
    store, by default one below the session's checkpoint folder."""
    return write_archives(described(pages), path or scratch_path(pages.sparkSession, "warc"))


def selected(index: DataFrame, condition: Column) -> DataFrame:
    """Records that meet a condition on the index, read from the archives."""
    return read_records(index.where(condition))
