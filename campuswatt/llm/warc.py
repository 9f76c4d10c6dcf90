"""WARC archives of pages, and a reader that salvages damaged ones.

Writing: every page is one record. Pages of equal payloads share one response; the others are revisits that
name it. Records are text, so Spark's own text writer makes the files, on any storage, with the two line ends
that close a record as its line separator; a lost task writes its file again.

Reading: archives are plain or gzip, member by member. A record counts if its header, its length, the line
ends behind it and its digests hold. After a failed check the reader looks for the next gzip member or version
line from which a record holds again; the bytes between are one quarantined gap in the log. Inside a gzip member
the search goes on in its content, also in what a damaged member gives before it breaks.
"""

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from campuswatt.llm.common import settle
from campuswatt.session import checkpoint_dir

SHARED_FROM = 100                  # bytes from which equal payloads share a response
DATE = "2000-01-01T00:00:00Z"      # the pages carry no date of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The record types of the format.
TYPES = {"warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation"}
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


# --- writing ---------------------------------------------------------------------

def records(pages, page_id="page_id", url="url", html="html"):
    """page_id and record (text without the closing line ends) of every row.

    A null html is an empty payload. Of rows that repeat the smallest page_id of a payload all are responses.
    """
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("bytes", F.octet_length("html"))
    shared = settle(rows.filter(F.col("bytes") >= SHARED_FROM).groupBy("digest")
                    .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    rows = rows.join(shared, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("-")), F.lit(">"))
    block = F.concat(F.lit(_HTTP), F.when(again, F.lit("")).otherwise(F.col("html")))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name("page_id")), line("WARC-Date", F.lit(DATE)),
        F.when(target.isNotNull(), line("WARC-Target-URI", target)).otherwise(F.lit("")),
        F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name("first")))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(F.col("block").cast("binary"), 256))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"))
    return rows.withColumn("block", block).select("page_id", F.concat(head, F.col("block")).alias("record"))


def write(pages, folder, per_file=4096, file_bytes=1 << 24, **columns):
    """Write the archives of ``pages`` to ``folder``: files of at most ``per_file`` records and, unless one record
    alone is longer, ``file_bytes`` bytes. A row of the writer is a whole file."""
    def files(batches):
        held, size = [], 0
        for batch in batches:
            for record in batch.column(0).to_pylist():
                more = len(record.encode()) + 4
                if held and (len(held) == per_file or size + more > file_bytes):
                    yield _file(held)
                    held, size = [], 0
                held.append(record)
                size += more
        if held:
            yield _file(held)

    (records(pages, **columns).select("record").mapInArrow(files, "record string").write.option("lineSep", "\r\n\r\n")
     .option("maxRecordsPerFile", 1).text(folder))


def _file(held):
    return pa.RecordBatch.from_arrays([pa.array(["\r\n\r\n".join(held)])], names=["record"])


# --- reading ---------------------------------------------------------------------

class Damaged(Exception):
    pass


def _header(data, at):
    """Fields of the record header at ``at`` and where its block starts."""
    if not data.startswith(b"WARC/1.", at):
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0 or stop - at > 65536:
        raise Damaged("no end of header")
    fields = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("broken header line")
        key = key.strip().lower().decode("latin-1")
        if key in fields and key != "warc-concurrent-to":      # the only field that may come twice
            raise Damaged("two headers in one")
        fields[key] = value.strip().decode("utf-8", "replace")
    if fields.get("warc-type") not in TYPES or "warc-record-id" not in fields:
        raise Damaged("broken header fields")
    return fields, stop + 4


def parse(data, at):
    """The record at ``at``: its fields, payload and end. Raises Damaged if a check fails."""
    fields, start = _header(data, at)
    try:
        end = start + int(fields["content-length"])
    except (KeyError, ValueError):
        raise Damaged("no length") from None
    if end < start or data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("wrong length")
    block = data[start:end]
    if _differs(fields.get("warc-block-digest"), block):
        raise Damaged("wrong block digest")
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    if fields.get("warc-type") != "revisit" and _differs(fields.get("warc-payload-digest"), payload):
        raise Damaged("wrong payload digest")
    return fields, payload, end + 4


def _differs(named, data):
    kind, _, value = (named or "").partition(":")
    return kind == "sha256" and hashlib.sha256(data).hexdigest() != value.lower()


def _member(data, at):
    """Content of the gzip member at ``at``, its end and None; or what comes out before it breaks, None and the reason."""
    unzip, out = zlib.decompressobj(wbits=31), []
    while not unzip.eof and at < len(data):     # in steps: what lies behind the member is not copied each time
        before = unzip.copy()
        try:
            out.append(unzip.decompress(data[at:at + _STEP]))
        except zlib.error as e:
            try:
                for k in range(at, min(at + _STEP, len(data))):     # up to the byte that breaks it
                    out.append(before.decompress(data[k:k + 1]))
            except zlib.error:
                pass
            return b"".join(out), None, str(e)
        at += _STEP
    if not unzip.eof:
        return b"".join(out), None, "member breaks off"
    return b"".join(out), min(at, len(data)) - len(unzip.unused_data), None


_STEP = 1 << 16
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def _inside(content):
    """(reason, fields, payload) of the records and gaps in a member's content; the reason of a gap names its bytes."""
    at, lost, why = 0, None, None
    while at < len(content):
        try:
            fields, payload, end = parse(content, at)
        except Damaged as e:
            if lost is None:
                lost, why = at, str(e)
            following = content.find(b"WARC/1.", at + 1)
            at = following if following >= 0 else len(content)
            continue
        if lost is not None:
            yield f"{why} (bytes {lost} to {at} of the content)", None, None
            lost = None
        yield None, fields, payload
        at = end
    if lost is not None:
        yield f"{why} (bytes {lost} to {len(content)} of the content)", None, None


def salvage(data):
    """Walk an archive: ("record", start, end, fields, payload) and ("gap", start, end, reason, None) in order.

    What lies in a gzip member has the member's start and end. A member without a good end is a gap as a whole;
    what it gives before it breaks comes ahead of that gap, with the member's start as start and end.
    """
    at, lost, why, saved = 0, None, None, set()
    while at < len(data):
        try:
            if data[at:at + 3] == b"\x1f\x8b\x08":
                content, end, broken = _member(data, at)
                found = list(_inside(content))
                if not any(fields for _, fields, _ in found) and (found or broken):
                    raise Damaged(broken or found[0][0])
            else:
                fields, payload, end = parse(data, at)
                found, broken = [(None, fields, payload)], None
                if lost is not None and fields["warc-record-id"] in saved:      # bytes a broken member stores as they are
                    at = end
                    continue
        except Damaged as e:
            if lost is None:
                lost, why = at, str(e)
            following = _NEXT.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if lost is not None:
            yield "gap", lost, at, why, None
        lost, saved = None, set()
        for reason, fields, payload in found:
            stop = at if broken else end
            yield ("gap", at, stop, reason, None) if reason else ("record", at, stop, fields, payload)
        if broken:
            lost, why = at, broken
            saved = {fields["warc-record-id"] for _, fields, _ in found if fields}
            following = _NEXT.search(data, at + 1)
            end = following.start() if following else len(data)
        at = end
    if lost is not None:
        yield "gap", lost, len(data), why, None


_READ = ("archive string, kind string, start long, stop long, reason string, page_id long, payload_bytes long, "
         "payload_digest string, record_type string, refers_to long")


def _page(name):
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def read(spark, folder):
    """Records and quarantined gaps of all archives in ``folder``, one row each (``kind``)."""
    def run(batches):
        for batch in batches:
            rows = [[] for _ in range(10)]
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for kind, start, stop, told, payload in salvage(content.as_py()):
                    row = [path, kind, start, stop]
                    if kind == "gap":
                        row += [told] + [None] * 5
                    else:
                        again = told.get("warc-type") == "revisit"
                        row += [None, _page(told.get("warc-record-id")),
                                int(told.get("warc-payload-length", -1)) if again else len(payload),
                                told.get("warc-payload-digest", "").partition(":")[2] if again else hashlib.sha256(payload).hexdigest(),
                                told.get("warc-type"), _page(told.get("warc-refers-to"))]
                    for out, value in zip(rows, row):
                        out.append(value)
            names = [c.split()[0] for c in _READ.split(", ")]
            kinds = [pa.string() if c.split()[1] == "string" else pa.int64() for c in _READ.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)

    return spark.read.format("binaryFile").load(folder).select("path", "content").mapInArrow(run, _READ)


def round_trip(pages, **columns):
    """Write ``pages`` as archives into the shared folder, and what reading them gives."""
    spark = pages.sparkSession
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, folder, **columns)
    return (read(spark, folder).filter("kind = 'record'")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
