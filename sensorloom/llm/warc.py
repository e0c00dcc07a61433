"""Web archives with a two-level capture index.

Archives are WARC 1.1 files, each record a gzip member of its own, so that any record can be read by its
offset and length. Of equal payloads one is stored as a response, the others as revisits of it.

The index sorts one line a record by (reversed host and path, page id) across the cluster. Every range of
that order is a shard: its lines are packed into compressed blocks, and a sparse directory beside it holds
the first line and the place of each block. A look-up searches the shards' borders, then the shard's
directory, reads one block by its range, searches that, and reads the record by its range. Nothing
else of archive or index is touched.

Files lie below a folder of the shared storage and are written and read by tasks through pyarrow's file
systems (local, S3, GCS, HDFS). An attempt writes under a name of its own, and only what Spark commits
of its rows is ever referred to, so a lost executor leaves at most files that nobody reads.
"""

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import HOT, NULL_ID, id_back, id_of, text_of
from sensorloom.llm.urls import host_and_path
from sensorloom.session import freeze, ship

#: Payloads below this many bytes are always stored.
LEAST_BYTES = 100
#: A task begins another archive file beyond this size.
FILE_BYTES = 1 << 30
BLOCK_LINES = 3000
#: Ranges that lie closer than this are read at once, up to ``READ_BYTES``.
GAP_BYTES, READ_BYTES = 64 << 10, 4 << 20
LEVEL = 6
#: Captures that a task holds before it passes them on.
FOUND_ROWS = 10_000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_ID = -(2**63)


def sort_key(url: Column) -> Column:
    """``com,example,www)/path?query``: pages of a host, and of its subdomains, lie together.

    A null URL has the key ``)``, one without ``://`` its own text behind it; blanks and control characters read ``%20``.
    """
    host, _, rest = host_and_path(url)
    turned = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    tail = F.when(F.instr(url, "://") > 0, F.substring(rest, F.length(host) + 1, F.length(rest) + 1)).otherwise(F.coalesce(url, F.lit("")))
    return F.regexp_replace(F.concat(turned, F.lit(")"), tail), r"[\x00-\x20\x7f]", "%20")


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return fs.FileSystem.from_uri(folder)


# ---------------------------------------------------------------- records


def _compressed(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _escaped(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _record_id(page: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page} {digest}'.encode()).hexdigest())}>"


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return _compressed("\r\n".join(lines).encode() + block + b"\r\n\r\n")


def page_record(page: int, url: str | None, payload: bytes, digest: str, refers: int | None, date: str) -> bytes:
    """A response, or a revisit with the header lines of the response and no payload."""
    fields = [("WARC-Record-ID", _record_id(page, digest)), ("WARC-Date", date)]
    fields += [("WARC-Target-URI", _escaped(url))] if url is not None else []
    fields += [("WARC-Payload-Digest", f"sha256:{digest}")]
    fields += [("Page-ID", str(page))] if page != NULL_ID else []
    if refers is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _record_id(refers, digest)), ("Refers-To-Page-ID", str(refers))]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields += [("Content-Type", "application/http; msgtype=response")]
    return _record("response" if refers is None else "revisit", fields, head if refers is not None else head + payload)


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def parse_record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Header of the record, header of the page, and payload; a record that isn't whole raises an error."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    length = int(fields["Content-Length"])
    if not data.startswith(b"WARC/1.1\r\n") or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    page, _, payload = rest[:length].partition(b"\r\n\r\n")
    return fields, _fields(page), payload


# ---------------------------------------------------------------- archives


@dataclass
class Archive:
    """``records``: a row a record (key, _id, url, record_type, refers, digest, file, offset, length)."""

    folder: str
    records: DataFrame


PLACE = "file string, offset bigint, length bigint"
RECORDS = f"key string, _id bigint, url string, record_type string, refers bigint, digest string, {PLACE}"
COLUMNS = [c.split()[0] for c in RECORDS.split(", ")]


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        out, name, at = None, "", 0
        try:
            for b in batches:
                keys, ids, urls, digests, refers, payloads = (b.column(c) for c in ("key", "_id", "url", "digest", "refers", "payload"))
                places, kinds = [], []
                for i, (page, url, digest, to) in enumerate(zip(ids.to_pylist(), urls.to_pylist(), digests.to_pylist(), refers.to_pylist())):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                        info = _record("warcinfo", [("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                        out.write(info)
                        at = len(info)
                    member = page_record(page, url, payloads[i].as_py(), digest, to, date)
                    out.write(member)
                    places.append((name, at, len(member)))
                    kinds.append("response" if to is None else "revisit")
                    at += len(member)
                file, offset, length = zip(*places) if places else ((), (), ())
                made = [keys, ids, urls, pa.array(kinds, pa.string()), refers, digests, pa.array(file, pa.string()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())]
                yield pa.RecordBatch.from_arrays(made, COLUMNS)
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z"
) -> Archive:
    """Write a record for every row of ``pages`` into archives below ``folder``.

    The payload is the html in UTF-8, a null one is empty. Of equal payloads of at least ``least_bytes`` the page with
    the smallest id is the response and the others revisit it; a null id is larger than any. Repeated
    rows, and all copies that share the smallest id (or have none), are one capture written more than once: each
    is a response. A payload of any length is one record. Other columns do not matter, whatever their names; an empty table writes no file.

    Only digests and ids are grouped. Rows meet the repeated digests by a join: the few hot ones (over 1/1024 of
    all copies) are sent to all tasks, and the rest is too if it is small; otherwise rows shuffle by digest.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(sort_key(F.col(url)).alias("key"), id_of(id).alias("_id"), F.col(url).alias("url"), text_of(html).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= least_bytes)
    copies = freeze(large.groupBy("digest").agg(F.min("_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "copies")
    total = copies.agg(F.sum("n")).first()[0] or 0
    hot = copies.where(F.col("n") > total / HOT).select("digest", F.col("first").alias("_hot"))
    cold = copies.where(F.col("n") <= total / HOT).select(F.col("digest").alias("_digest"), F.col("first").alias("_cold"))
    rows = rows.join(F.broadcast(hot), "digest", "left")
    # Rows that are settled get keys that match nothing, each its own, so that they do not meet in one task.
    asked = F.when(F.col("_hot").isNull(), F.col("digest")).otherwise(F.concat_ws(" ", "digest", "_id", "url"))
    rows = rows.withColumn("_digest", asked).join(cold, "_digest", "left")
    first = F.when(F.octet_length("payload") >= least_bytes, F.coalesce("_hot", "_cold"))
    rows = rows.withColumn("refers", F.when(first != F.col("_id"), first)).select("key", "_id", "url", "digest", "refers", "payload")
    store, base = open_folder(f"{folder}/archives")
    store.create_dir(base, recursive=True)
    return Archive(folder, freeze(rows.mapInArrow(_write(f"{folder}/archives", date), RECORDS), "records"))


# ---------------------------------------------------------------- index


@dataclass
class Index:
    """``shards``: a row a shard (shard, first_key, first_id, last_key, last_id, blocks, lines)."""

    folder: str
    shards: DataFrame


SHARDS = "shard string, first_key string, first_id bigint, last_key string, last_id bigint, blocks bigint, lines bigint"
DETAILS = COLUMNS[2:]


def _write_shard(folder: str, block_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        out, waiting, blocks, at, lines, last = None, [], [], 0, 0, None
        name = uuid.uuid4().hex

        def flush():
            nonlocal at, waiting
            block = _compressed("".join(f"{k} {i} {json.dumps(d, separators=(',', ':'))}\n" for k, i, d in waiting).encode())
            out.write(block)
            blocks.append((waiting[0][0], waiting[0][1], at, len(block)))
            at += len(block)
            waiting = []

        for b in batches:
            for key, page, *rest in zip(*(b.column(c).to_pylist() for c in COLUMNS)):
                out = out or store.open_output_stream(f"{base}/{name}.blocks", compression=None)
                waiting.append((key, page, rest))
                lines, last = lines + 1, (key, page)
                if len(waiting) >= block_lines:
                    flush()
        if not lines:
            return
        if waiting:
            flush()
        out.close()
        with store.open_output_stream(f"{base}/{name}.directory", compression=None) as directory:
            directory.write(_compressed("".join(json.dumps(x) + "\n" for x in blocks).encode()))
        row = {"shard": name, "first_key": blocks[0][0], "first_id": blocks[0][1], "last_key": last[0], "last_id": last[1], "blocks": len(blocks), "lines": lines}
        yield pa.RecordBatch.from_pylist([row])

    return run


def build_index(archive: Archive, block_lines: int = BLOCK_LINES) -> Index:
    """Sort the captures of an archive into shards of compressed blocks.

    The order ends in a hash of the record's place, so a URL or an id that a third of all captures share is cut as well.
    """
    order = ["key", "_id", "_place"]
    lines = archive.records.withColumn("_place", F.xxhash64("file", "offset"))
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order).select(*COLUMNS)
    folder = f"{archive.folder}/index"
    store, base = open_folder(folder)
    store.create_dir(base, recursive=True)
    return Index(archive.folder, freeze(ordered.mapInArrow(_write_shard(folder, block_lines), SHARDS), "shards"))


class _Shard:
    """The directory of one shard, and the block that was read last."""

    def __init__(self, store: fs.FileSystem, path: str):
        with store.open_input_file(f"{path}.directory") as f:
            rows = [json.loads(x) for x in zlib.decompress(f.read(), 31).splitlines()]
        self.firsts = [(k, i) for k, i, _, _ in rows]
        self.places = [(at, n) for _, _, at, n in rows]
        self.file, self.held = store.open_input_file(f"{path}.blocks"), None

    def block(self, i: int) -> tuple[list[tuple[str, int]], list[str]]:
        if self.held is None or self.held[0] != i:
            at, n = self.places[i]
            lines = [x.split(" ", 2) for x in zlib.decompress(self.file.read_at(n, at), 31).decode().split("\n")[:-1]]
            self.held = (i, [(k, int(p)) for k, p, _ in lines], [d for *_, d in lines])
        return self.held[1:]

    def find(self, low: tuple[str, int], high: tuple[str, int]) -> Iterator[tuple[tuple[str, int], list]]:
        """Lines from ``low`` to ``high``: the directory names the blocks that can hold them."""
        i = max(bisect_left(self.firsts, low) - 1, 0)
        while i < len(self.firsts) and self.firsts[i] <= high:
            keys, details = self.block(i)
            for j in range(bisect_left(keys, low), bisect_right(keys, high)):
                yield keys[j], json.loads(details[j])
            i += 1


def _search(folder: str, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        names, at, shard = sent.value[0], None, None
        kinds = {"_id": pa.int64(), "refers": pa.int64(), "offset": pa.int64(), "length": pa.int64()}

        def told(found):
            columns = zip(*found) if found else [()] * len(COLUMNS)
            return pa.RecordBatch.from_arrays([pa.array(list(x), kinds.get(c, pa.string())) for c, x in zip(COLUMNS, columns)], COLUMNS)

        for b in batches:
            found = []
            for key, low, high, number in zip(*(b.column(c).to_pylist() for c in ("key", "low", "high", "shard"))):
                if number != at:
                    at, shard = number, _Shard(store, f"{base}/{names[number]}")
                for place, details in shard.find((key, low), (key, high)):
                    found.append((*place, *details))
                    if len(found) >= FOUND_ROWS:  # a URL may have any number of captures
                        yield told(found)
                        found = []
            yield told(found)

    return run


def look_up(index: Index, wanted: DataFrame, url: str = "url", id: str | None = None) -> DataFrame:
    """Captures of the URLs in ``wanted`` (with ``id``: of that page alone), each capture once; columns as in ``Archive``.

    Equal requests are one. Requests are ordered like the index, so a task reads neighbouring blocks one after the other;
    the shards' borders (as many as the sort had ranges) are all that is sent. URLs that differ only in scheme, blanks or
    control characters share their captures.
    """
    spark = wanted.sparkSession
    borders = index.shards.orderBy("first_key", "first_id", "last_key", "last_id").collect()
    firsts = [(r.first_key, r.first_id) for r in borders]
    lasts = [(r.last_key, r.last_id) for r in borders]
    sent = spark.sparkContext.broadcast(([r.shard for r in borders], firsts, lasts))

    def shards(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        _, firsts, lasts = sent.value
        for keys, low, high in batches:
            rows = zip(keys.to_pylist(), low.to_pylist(), high.to_pylist())
            yield pa.array([list(range(bisect_left(lasts, (k, a)), bisect_right(firsts, (k, z)))) for k, a, z in rows], pa.list_(pa.int32()))

    low, high = (id_of(id), id_of(id)) if id else (F.lit(FIRST_ID), F.lit(NULL_ID))
    asked = wanted.select(sort_key(F.col(url)).alias("key"), low.alias("low"), high.alias("high")).distinct()
    spread = asked.withColumn("shard", F.explode(F.arrow_udf(shards, "array<int>")("key", "low", "high")))
    order = ["shard", "key", "low"]
    return spread.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_search(f"{index.folder}/index", sent), RECORDS)


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        name, file = None, None
        for b in batches:
            places = list(zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))))
            out, i = {"bytes": [], "digest": [], "kind": [], "refers": [], "payload": []}, 0
            while i < len(places):
                start, j = places[i][1], i
                end = start + places[i][2]
                while j + 1 < len(places) and places[j + 1][0] == places[i][0] and places[j + 1][1] <= end + GAP_BYTES and end - start < READ_BYTES:
                    j += 1
                    end = max(end, places[j][1] + places[j][2])
                if places[i][0] != name:
                    name = places[i][0]
                    file = store.open_input_file(f"{base}/{name}")
                data = file.read_at(end - start, start)
                for _, offset, length in places[i : j + 1]:
                    fields, page, payload = parse_record(data[offset - start : offset - start + length])
                    size, digest, response = int(page["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"] == "response"
                    if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{name} at {offset}: the payload is not the one that was written")
                    out["bytes"].append(size)
                    out["digest"].append(digest)
                    out["kind"].append(fields["WARC-Type"])
                    out["refers"].append(int(fields["Refers-To-Page-ID"]) if "Refers-To-Page-ID" in fields else None)
                    out["payload"].append(payload if response and with_payload else None)
                i = j + 1
            made = [b.column("_id"), b.column("url"), pa.array(out["bytes"], pa.int64()), *(pa.array(out[c], pa.string()) for c in ("digest", "kind"))]
            made += [pa.array(out["refers"], pa.int64()), pa.array(out["payload"], pa.binary())]
            yield pa.RecordBatch.from_arrays(made, ["_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    return run


def read_records(folder: str, captures: DataFrame, id: str = "page_id", with_payload: bool = True) -> DataFrame:
    """Records of the captures: (id, url, payload_bytes, payload_digest, record_type, refers_to, payload).

    Records are read by their ranges, in the order of the archives; neighbours are read at once. Length and digest of a
    revisit are those of the payload it refers to, which itself is null; a response's payload is checked against its digest.
    """
    order = ["file", "offset"]
    placed = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    read = placed.select("_id", "url", *order, "length").mapInArrow(_read(f"{folder}/archives", with_payload), schema)
    return read.select(id_back("_id").alias(id), *[c for c in read.columns if c != "_id"])
