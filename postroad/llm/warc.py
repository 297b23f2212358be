"""WARC archives: written with an index of every record, read back by coalesced byte ranges.

Writing. Each page becomes a record: a response with its payload or, for a payload that an earlier page has, a
revisit of that page's record. Which it is follows from page, digest and length alone. Records are dealt evenly to archives by a hash; payloads
move once, to their archive, where the records stand in order. A task writes each archive's records as gzip members, so that every record can be read
by itself, and gives the index as it goes: (file, offset, length, url, digest, page, and what the record is). A file belongs to one attempt of a
task; the index names those of the attempts that counted, so a task that is run again does no harm.

Reading. Records are selected in the index. Their ranges, sorted by archive and offset, are joined into one read if
they lie at most `gap` bytes apart, up to reads of about `most` bytes; a record longer than that is a read of its own. Reads are dealt to as many
tasks as their bytes ask for. Tasks fetch the ranges through Arrow's file systems, parse the records, and check each payload against its digest.

Hot payloads: the first page of a payload is a partial minimum, joined back on digest and length, a join of short rows that Spark splits where it is
uneven. No group is gathered. Of equal rows, a task hands on the payload once.

Defined results: a null html is an empty payload; empty payloads are equal like any other. A null url is written as
an empty one. Null page ids are kept; one is the response only if its payload has no other page, and then one of
them is. Of rows with the same id and payload the one of the smallest url is the response, and the others revisit that id; equal rows
are a record each. Very long payloads are a record like others. An empty table gives no records. Only the named columns are read, so others may have any names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postroad.llm.shared import folder, written

ARCHIVE_BYTES = 16_000_000
GAP = 64_000
MOST = 2_000_000
#: Records that a task parses before it hands them on.
AT_ONCE = 256
#: Keys by which a task knows equal rows.
REMEMBERED = 500_000
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(value: Column) -> Column:
    """The SHA-1 of a text in base 32: 160 bits are 32 digits, in four blocks of 40 bits."""
    hexed = F.sha1(value.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*parts)), DIGITS, BASE32)


def _uri(page: Column, url: Column, copy: Column) -> Column:
    """A record's name: page, payload, url and number among equal rows."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), F.col("digest"), F.lit(":"), F.hex(F.xxhash64(url)), F.lit(":"), copy, F.lit(">"))


KEY = ["page_id", "url", "digest", "size"]


def _records(named: DataFrame) -> DataFrame:
    """One row for each record, without payload: page_id, url, digest, size, copy (a number among equal rows), kind, refers_to and its url."""
    facts = written(named.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies")), "facts")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"), "url")).alias("first")
    joined = facts.join(facts.groupBy("digest", "size").agg(first), ["digest", "size"])
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    response = F.col("page_id").eqNullSafe(F.col("first.id")) & (F.col("url") == F.col("first.url")) & (F.col("copy") == 1)
    return copies.select(*KEY, "copy", F.when(response, "response").otherwise("revisit").alias("kind"), F.when(~response, F.col("first.id")).alias("refers_to"), F.col("first.url").alias("first_url"))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of equal rows of a task the first, as far as it remembers."""
    seen: set[tuple] = set()
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(len(KEY))), strict=True))
        new = []
        for key in keys:
            new.append(key not in seen)
            seen.add(key)
        if len(seen) > REMEMBERED:
            seen.clear()
        yield batch.filter(pa.array(new, pa.bool_()))


def _file_system(name: str):
    from pyarrow import fs

    name = name.replace("s3a://", "s3://")
    return fs.FileSystem.from_uri(name if "://" in name else "file://" + name.removeprefix("file:"))


INDEX = "file string, offset long, length long, url string, digest string, page_id long, kind string"


def write(pages: DataFrame, path: str, page: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives under `path` and give their index, itself written to `path`/index."""
    line = F.regexp_replace(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), "[\\r\\n]", " ")  # a header has one line
    named = pages.select(F.col(f"`{page}`").cast("long").alias("page_id"), line.alias("url"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    named = named.select("page_id", "url", sha1_base32(F.col("html")).alias("digest"), F.octet_length("html").cast("long").alias("size"), "html")
    records = written(_records(named), "records")
    total = records.agg(F.sum(F.when(F.col("kind") == "response", F.col("size")).otherwise(0) + 700)).first()[0] or 0
    archives = max(1, -(-int(total) // archive_bytes))
    fields = {
        "WARC-Type": F.col("kind"), "WARC-Record-ID": _uri(F.col("page_id"), F.col("url"), F.col("copy").cast("string")), "WARC-Date": F.lit(DATE), "WARC-Target-URI": F.col("url"),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")), "WARC-Page-ID": F.col("page_id").cast("string"), "WARC-Payload-Length": F.col("size").cast("string"),
        "WARC-Profile": F.when(F.col("kind") == "revisit", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        "WARC-Refers-To": F.when(F.col("kind") == "revisit", _uri(F.col("refers_to"), F.col("first_url"), F.lit("1"))), "WARC-Refers-To-Page-ID": F.col("refers_to").cast("string"),
        "Content-Type": F.lit("application/http; msgtype=response"),
    }
    head = F.concat(F.lit("WARC/1.1\r\n"), *(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields.items()))
    deal = lambda *more: F.xxhash64(*KEY, *more).alias("deal")
    response = F.col("kind") == "response"
    heads = records.select(F.when(response, deal()).otherwise(deal("copy")).alias("deal"), *KEY, "kind", head.alias("head"), F.lit(None).cast("string").alias("html"), "copy")
    bodies = named.mapInArrow(_once, named.schema).select(deal(), *KEY, F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("head"), "html", F.lit(0).cast("long").alias("copy"))
    # A payload comes right before the records of its row. A task's rows are an archive.
    dealt = heads.unionByName(bodies).repartition(archives, "deal").drop("deal").sortWithinPartitions(*KEY, "copy")
    folder_ = f"{path}/archives"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Archive(folder_)
        for batch in batches:
            out.index.clear()
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.add(*row)
            yield pa.RecordBatch.from_pylist(out.index, _INDEX)
        out.close()

    dealt.mapInArrow(pack, INDEX).write.parquet(f"{path}/index")
    return read_index(pages.sparkSession, path)


_INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64()), ("kind", pa.string())])


class _Archive:
    """Writes sorted rows to an archive: a payload row is held until the records of the same key have passed."""

    def __init__(self, folder_: str):
        self.name, self.file, self.offset = f"{folder_}/{uuid.uuid4().hex}.warc.gz", None, 0
        self.key: tuple | None = None
        self.html = ""
        self.index: list[dict] = []

    def add(self, page_id: int, url: str, digest: str, size: int, kind: str, head: str, html: str, copy: int) -> None:
        key = page_id, url, digest, size
        if head is None:
            self.key, self.html = key, html
            return
        if self.file is None:
            system, place = _file_system(self.name)
            system.create_dir(place.rsplit("/", 1)[0], recursive=True)
            self.file = system.open_output_stream(place, compression=None)
        body = b"HTTP/1.1 200 OK\r\n\r\n"
        if kind == "response":
            if self.key != key:
                raise RuntimeError(f"no payload for page {page_id}")
            body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + self.html.encode()
        record = gzip.compress(head.encode() + b"Content-Length: %d\r\n\r\n" % len(body) + body + END, LEVEL, mtime=0)
        self.file.write(record)
        self.index.append({"file": self.name, "offset": self.offset, "length": len(record), "url": url, "digest": digest, "page_id": page_id, "kind": kind})
        self.offset += len(record)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def ranges(selected: DataFrame, gap: int = GAP, most: int = MOST) -> DataFrame:
    """(file, begin, end, records): the reads that hold the selected records, each with its records' places."""
    ordered = Window.partitionBy("file").orderBy("offset")
    near = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(ordered) <= gap
    same = near & (F.floor(F.col("offset") / most) == F.lag(F.floor(F.col("offset") / most)).over(ordered))
    marked = selected.withColumn("new", (~F.coalesce(same, F.lit(False))).cast("int")).withColumn("read", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct("offset", "length")
    return marked.groupBy("file", "read").agg(F.min("offset").alias("begin"), F.max(F.col("offset") + F.col("length")).alias("end"), F.sort_array(F.collect_list(place)).alias("records")).drop("read")


RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload string, sound boolean"


def read(selected: DataFrame, gap: int = GAP, most: int = MOST, payloads: bool = True) -> DataFrame:
    """The records of the selected index rows, from the archives. `sound`: a response's payload has its digest and length.

    Without `payloads` they are checked and left out.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _file_system(row["file"])
                with system.open_input_file(path) as source:
                    raw = source.read_at(row["end"] - row["begin"], row["begin"])
                for first in range(0, len(row["records"]), AT_ONCE):
                    places = [(r["offset"] - row["begin"], r["length"]) for r in row["records"][first : first + AT_ONCE]]
                    found = [_parsed(gzip.decompress(raw[at : at + n])) for at, n in places]
                    if not payloads:
                        found = [{**r, "payload": None} for r in found]
                    yield pa.RecordBatch.from_pylist(found, schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.string()), ("sound", pa.bool_())])
    # With a number, since adaptive execution sees short rows and not the bytes behind them.
    total = selected.agg(F.sum("length")).first()[0] or 0
    return ranges(selected, gap, most).repartition(max(1, -(-int(total) // most)), "file", "begin").mapInArrow(fetch, RECORD)


def _parsed(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.partition(": ")[::2] for line in lines[1:])
    size = int(fields["Content-Length"])
    _, _, payload = rest[:size].partition(b"\r\n\r\n")
    response = fields["WARC-Type"] == "response"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    stated = int(fields["WARC-Payload-Length"])
    sound = lines[0] == "WARC/1.1" and rest[size:] == b"\r\n\r\n" and (not response or (len(payload) == stated and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest))
    number = lambda name: int(fields[name]) if fields.get(name) else None
    return {"page_id": number("WARC-Page-ID"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To-Page-ID"), "payload_bytes": stated, "payload_digest": digest, "payload": payload.decode() if response else None, "sound": sound}


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write all pages and read all records back; a record that is not sound ends the job."""
    path = path or folder(pages.sparkSession, "warc")
    rows = read(write(pages, path), payloads=False)
    checked = F.when(F.col("sound"), F.col("record_type")).otherwise(F.raise_error(F.concat(F.lit("unsound record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))))
    return rows.select("page_id", "payload_bytes", "payload_digest", checked.alias("record_type"), "refers_to")
