"""Web archives (WARC 1.1): pages to segmented records in archive files, and back.

Writing. The payload of a page is chunked (``Transfer-Encoding: chunked``) into the block of
a ``response`` record. A block of more than ``segment_bytes`` is spread over records: the
first one has segment number 1, ``continuation`` records name it as their origin, and the
last one tells the total length. An archive file that is full is followed by another one,
in the midst of a block too. Of equal payloads one is stored; other pages get a ``revisit``
record that refers to it. Each task writes archive files of its own; the manifest names
those of the attempts that succeeded.

Reading. One archive file a task. Segments are grouped by their origin, ordered by number and
checked against the total length; chunks are decoded; revisits are resolved by the record
they refer to.
"""

from __future__ import annotations

import gzip
import io
import sys
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica.llm.common import named, octets
from armorica.workspace import materialise, new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT_BYTES, CHUNK_BYTES, ARCHIVE_BYTES = 8 << 10, 2 << 10, 64 << 20
# Payloads from this size on are stored once.
REVISIT_BYTES = 100
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEADER = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_HEADER = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RESPONSE, REVISIT, CONTINUATION = "response", "revisit", "continuation"
# Rows of a known width of some 100 bytes, up to which a table is sent to all workers.
SENT_ROWS = 200_000
# Copies of one row that are numbered at once, and bytes of blocks in a batch.
COPIES_AT_ONCE, BATCH_BYTES = 4_096, 4 << 20
LONGEST_LINE = 1 << 20

_MANIFEST = "name string, records bigint, bytes bigint"
_RECORD = (
    "record_type string, record_id string, origin string, number bigint, total bigint, id string, url string, digest string, "
    "refers_to string, block binary"
)
_RECORD_TYPES = [pa.string()] * 3 + [pa.int64()] * 2 + [pa.string()] * 4 + [pa.binary()]


def chunked(payload: bytes, chunk_bytes: int = CHUNK_BYTES) -> bytes:
    """The payload in chunks, each after its length in hexadecimal digits."""
    out = []
    for at in range(0, len(payload), chunk_bytes):
        part = payload[at : at + chunk_bytes]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """What ``chunked`` was given; extensions of chunk lengths and trailing fields are passed over."""
    out = []
    at = 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk without a length")
        size = int(body[at:end].partition(b";")[0].strip(), 16)
        if size == 0:
            return b"".join(out)
        if size < 0 or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk of another length")
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """Body of an HTTP response, decoded."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("a response without an empty line")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and value.strip().lower() == b"chunked":
            return dechunked(body)
    return body


def record_id(*parts: Column) -> Column:
    """Id of a record as text, made of the SHA-256 of its parts; a null is none."""
    digests = [F.coalesce(F.sha2(part.cast("string").cast("binary"), 256), F.lit("-")) for part in parts]
    digits = F.sha2(F.concat_ws("/", *digests).cast("binary"), 256)
    return F.regexp_replace(F.substring(digits, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", r"$1-$2-$3-$4-$5")


def _record(kind: str, own_id: str, fields: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{own_id}>", f"WARC-Date: {DATE}"]
    lines += [f"{name}: {value}" for name, value in fields.items() if value is not None]
    lines.append(f"Content-Length: {len(block)}")
    return b"".join(["\r\n".join(lines).encode(), b"\r\n\r\n", block, b"\r\n\r\n"])


class _Archives:
    """Archive files of one task, one after the other."""

    def __init__(self, folder: str, archive_bytes: int, compress: bool) -> None:
        self._store, self._path = fs.FileSystem.from_uri(folder)
        self._most, self._compress = archive_bytes, compress
        self._out = None
        self._name = ""
        self._records = self._bytes = 0

    @property
    def room(self) -> int:
        """Bytes until the file is full."""
        return max(0, self._most - self._bytes)

    def add(self, record: bytes) -> tuple[str, int, int] | None:
        """Append a record; gives the manifest row of the file that was full before."""
        done = self.close() if self._out is not None and not self.room else None
        if self._out is None:
            self._name = f"{uuid.uuid4().hex}.warc{'.gz' if self._compress else ''}"
            self._out = self._store.open_output_stream(f"{self._path}/{self._name}", compression=None)
        record = gzip.compress(record, 6) if self._compress else record
        self._out.write(record)
        self._records += 1
        self._bytes += len(record)
        return done

    def close(self) -> tuple[str, int, int] | None:
        if self._out is None:
            return None
        self._out.close()
        done = (self._name, self._records, self._bytes)
        self._out, self._records, self._bytes = None, 0, 0
        return done


def _written(folder: str, segment_bytes: int, chunk_bytes: int, archive_bytes: int, compress: bool):
    """Rows (record_id, id, url, digest, refers_to, payload) to archive files; gives their manifest rows."""

    def records(row: dict, archives: _Archives) -> Iterator[bytes]:
        fields = {
            "WARC-Target-URI": row["url"],
            "WARC-Payload-Digest": f"sha256:{row['digest']}",
            "X-Source-ID": row["id"],
            "Content-Type": "application/http; msgtype=response",
        }
        if row["refers_to"] is not None:
            fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:uuid:{row['refers_to']}>"}
            yield _record(REVISIT, row["record_id"], fields, REVISIT_HEADER)
            return
        block = HTTP_HEADER + chunked(row["payload"] or b"", chunk_bytes)
        at, number = 0, 0
        while at < len(block):
            # What does not fit into the file any more goes on in the next one.
            part = block[at : at + min(segment_bytes, archives.room or archive_bytes)]
            at += len(part)
            number += 1
            if number == 1 and at == len(block):
                yield _record(RESPONSE, row["record_id"], fields, part)
                return
            own = row["record_id"] if number == 1 else str(uuid.uuid5(uuid.UUID(row["record_id"]), str(number)))
            segment = {"WARC-Segment-Number": str(number)}
            if number > 1:
                segment["WARC-Segment-Origin-ID"] = f"<urn:uuid:{row['record_id']}>"
            if at == len(block):
                segment["WARC-Segment-Total-Length"] = str(len(block))
            yield _record(CONTINUATION if number > 1 else RESPONSE, own, segment | (fields if number == 1 else {}), part)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, archive_bytes, compress)
        done = []
        for batch in batches:
            for place in range(batch.num_rows):
                row = {name: column[place].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                for record in records(row, archives):
                    done.append(archives.add(record))
        done.append(archives.close())
        rows = [row for row in done if row is not None]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 3
        kinds = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names=["name", "records", "bytes"]
        )

    return write


def _looked_up(rows: DataFrame, table: DataFrame, key: str, how: str, sent_rows: int) -> DataFrame:
    """Join with a computed table of narrow rows: by broadcast if it is small, else by a shuffle that adaptive execution may split."""
    return rows.join(F.broadcast(table) if table.count() <= sent_rows else table, key, how)


def write_warc(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
    compress: bool = False,
    sent_rows: int = SENT_ROWS,
) -> str:
    """Write a record for every row, and the manifest (Parquet, one row per archive file); the folder is returned.

    ``folder``: a new folder all executors share, given as a URI or a path; by default one
    below ``spark.checkpoint.dir``. ``archive_bytes``: a file is closed when it has so many.
    ``compress``: each record is a gzip member.

    Of records with equal payloads of ``revisit_bytes`` or more, that of the smallest id is a
    response and the others revisit it; null ids come last, then the smaller URL decides, null
    last. Rows that agree in id, URL and payload are records of their own: the first of them may
    be the response, the others revisit it. Smaller payloads are all responses. A null payload is
    empty. Line breaks in URLs and text ids are written as %0A and %0D. Other columns are not read. An
    empty table gives a manifest without rows.
    """
    if min(segment_bytes, chunk_bytes, archive_bytes) < 1:
        raise ValueError("sizes are positive")
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)

    def line(column: Column) -> Column:
        return F.replace(F.replace(column.cast("string"), F.lit("\n"), F.lit("%0A")), F.lit("\r"), F.lit("%0D"))

    source = pages.select(
        named(id_col).alias("at"),
        line(named(id_col)).alias("id"),
        line(named(url_col)).alias("url"),
        F.coalesce(octets(named(payload_col)), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    source = source.withColumn("row_id", record_id(F.col("id"), F.col("url"), F.col("digest")))
    rows = materialise(
        source.groupBy("row_id").agg(
            F.count(F.lit(1)).alias("copies"),
            F.any_value("digest").alias("digest"),
            F.any_value(F.octet_length("payload")).alias("bytes"),
            F.any_value("at").alias("at"),
            F.any_value("url").alias("url"),
        )
    )
    order = F.struct(F.col("at").isNull(), "at", F.col("url").isNull(), "url", "row_id")
    shared = rows.filter(F.col("bytes") >= revisit_bytes).groupBy("digest")
    shared = shared.agg(F.sum("copies").alias("records"), F.min_by("row_id", order).alias("first"))
    shared = materialise(shared.filter("records > 1").select("digest", "first"))
    repeated = materialise(rows.filter("copies > 1").select("row_id", "copies"))

    known = _looked_up(source, shared, "digest", "left", sent_rows)
    names = ["record_id", "id", "url", "digest", "refers_to", "payload"]
    revisits = F.col("first").isNotNull() & (F.col("first") != F.col("row_id"))
    referred = F.when(revisits, F.col("first")).alias("refers_to")
    # A revisit needs no payload.
    payload = F.when(~revisits, F.col("payload")).alias("payload")
    if repeated.isEmpty():
        ready = known.select(F.col("row_id").alias("record_id"), "id", "url", "digest", referred, payload)
    else:
        marked = _looked_up(known, repeated, "row_id", "left", sent_rows)
        single = marked.filter("copies is null").select(F.col("row_id").alias("record_id"), "id", "url", "digest", referred, payload)
        one = marked.filter("copies is not null").groupBy("row_id").agg(
            *[F.any_value(name).alias(name) for name in ("id", "url", "digest", "first", "copies", "payload")]
        )
        ready = single.unionByName(_numbered(one).select(*names))
    ready.select(*names).mapInArrow(_written(folder, segment_bytes, chunk_bytes, archive_bytes, compress), _MANIFEST).write.parquet(
        f"{folder}/manifest"
    )
    return folder


def _numbered(repeated: DataFrame) -> DataFrame:
    """A row for each of the copies, with ids of their own; one may be the response the others refer to.

    Numbers are dealt in blocks, so that a row of very many copies does not stay in one task.
    """
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES_AT_ONCE))
    # Only the first block holds a payload that is stored once.
    slim = F.when(F.col("first").isNull() | (F.col("block") == 0), F.col("payload"))
    dealt = repeated.withColumn("block", F.explode(blocks)).withColumn("payload", slim).repartition("row_id", "block")
    first = F.col("block") * COPIES_AT_ONCE
    numbers = F.sequence(first, F.least(first + COPIES_AT_ONCE, F.col("copies")) - 1)
    copies = dealt.withColumn("number", F.explode(numbers))
    revisits = F.col("first").isNotNull() & ((F.col("first") != F.col("row_id")) | (F.col("number") > 0))
    return copies.select(
        F.when(F.col("number") == 0, F.col("row_id")).otherwise(record_id(F.col("row_id"), F.col("number"))).alias("record_id"),
        "id",
        "url",
        "digest",
        F.when(revisits, F.col("first")).alias("refers_to"),
        F.when(~revisits, F.col("payload")).alias("payload"),
    )


def records_of(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record of an archive file, gzip members or not."""
    stream = io.BufferedReader(stream, 1 << 20)
    if stream.peek(2)[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    while line := stream.readline(LONGEST_LINE):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not the beginning of a record")
        fields: dict[str, str] = {}
        name = ""
        while (line := stream.readline(LONGEST_LINE)).strip():
            text = line.decode("utf-8", "replace").strip("\r\n")
            if text[0] in " \t" and name:  # a folded line
                fields[name] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record that ends early")
        yield fields, block


def _bare(value: str | None) -> str | None:
    return value.strip("<>").removeprefix("urn:uuid:") if value else None


def _number(value: str | None) -> int | None:
    return int(value) if value else None


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        names = [part.split(" ")[0] for part in _RECORD.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            arrays = [pa.array(column, kind) for column, kind in zip(columns, _RECORD_TYPES, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for fields, block in records_of(stream):
                        get = fields.get
                        digest = (get("warc-payload-digest") or "").partition(":")[2] or None
                        rows.append(
                            (
                                get("warc-type"),
                                _bare(get("warc-record-id")),
                                _bare(get("warc-segment-origin-id")),
                                _number(get("warc-segment-number")),
                                _number(get("warc-segment-total-length")),
                                get("x-source-id"),
                                get("warc-target-uri"),
                                digest,
                                _bare(get("warc-refers-to")),
                                block,
                            )
                        )
                        size += len(block)
                        if size > BATCH_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                yield batch_of(rows)

    return read


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks, in segments, to payloads; a block that cannot be decoded has none."""
    for batch in batches:
        payloads = []
        for segments in batch.column("segments"):
            try:
                payloads.append(payload_of(b"".join(segments.as_py())) if segments.is_valid else None)
            except ValueError:
                payloads.append(None)
        place = batch.schema.get_field_index("segments")
        yield batch.set_column(place, "payload", pa.array(payloads, pa.binary()))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the archives, whole: ``record_type``, ``record_id``, ``id``, ``url``, ``digest``, ``refers_to``, ``payload``.

    Segments are put together by their origin in the order of their numbers. ``payload`` is
    null for revisits, for blocks with a segment missing, repeated or of a total length that
    differs, and for chunks that cannot be decoded.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    files = manifest.select("name").repartition(max(1, manifest.count()), "name")
    records = files.mapInArrow(_read(folder), _RECORD)
    head = ["record_type", "record_id", "id", "url", "digest", "refers_to"]
    alone = records.filter(F.col("number").isNull() & (F.col("record_type") != CONTINUATION))
    alone = alone.select(*head, F.when(F.col("record_type") == RESPONSE, F.array("block")).alias("segments"))
    # Of a record on several segments: its own fields come with the first.
    origin = F.when(F.col("number") == 1, F.col("record_id")).otherwise(F.col("origin"))
    parts = records.filter(F.col("number").isNotNull()).withColumn("origin", origin).filter("origin is not null")
    grouped = parts.groupBy("origin").agg(
        F.any_value(F.when(F.col("number") == 1, F.struct(*head)), True).alias("head"),
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
    )
    numbers, blocks = F.transform("parts", lambda x: x["number"]), F.transform("parts", lambda x: x["block"])
    length = F.aggregate(blocks, F.lit(0).cast("bigint"), lambda total, x: total + F.octet_length(x))
    in_order = numbers == F.sequence(F.lit(1).cast("bigint"), F.size("parts").cast("bigint"))
    again = grouped.filter("head is not null").select(
        *[F.col("head")[name].alias(name) for name in head],
        F.when(in_order & (length == F.col("total")), blocks).alias("segments"),
    )
    schema = ", ".join(f"{name} string" for name in head) + ", payload binary"
    return alone.unionByName(again).mapInArrow(_decoded, schema)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``id``, ``url``, ``record_type``, ``refers_to``, ``bytes``, ``digest`` of the pages of written archives.

    Ids are text. Size and SHA-256 are those of the decoded payload; those of a revisit are of the
    payload it refers to, whose id ``refers_to`` gives, and null if that has another digest than
    the revisit says, or is not there.
    """
    records = read_records(spark, folder).select(
        "record_type",
        "record_id",
        "id",
        "url",
        F.col("digest").alias("said"),
        F.col("refers_to").alias("origin"),
        F.octet_length("payload").cast("bigint").alias("bytes"),
        F.when(F.col("payload").isNotNull(), F.sha2("payload", 256)).alias("digest"),
    )
    records = materialise(records)
    responses = records.filter(F.col("record_type") == RESPONSE)
    revisits = records.filter(F.col("record_type") == REVISIT).drop("bytes", "digest")
    stored = responses.select(
        F.col("record_id").alias("origin"), F.col("id").alias("refers_to"), "bytes", "digest", F.lit(True).alias("there")
    )
    # Spark takes archives for as small as their manifest: a hint keeps it from a broadcast.
    found = revisits.join(stored.hint("merge"), "origin", "left")
    same = F.col("digest") == F.col("said")
    names = ["id", "url", "record_type", "refers_to", "bytes", "digest"]
    found = found.withColumns({name: F.when(same, F.col(name)) for name in ("bytes", "digest")})
    return responses.withColumn("refers_to", F.lit(None).cast("string")).select(*names).unionByName(found.select(*names))
