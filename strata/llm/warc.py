"""WARC: deterministic sharded writer, and the reader that checks it.

Records are range-sorted by key into shards of about equal bytes. The shard
borders come from exact byte counts in key bins (never more than ``MAX_BINS``),
not from a sample, so the same table always gives the same files. A bin that
holds more than a shard is cut again between its own first and last key, until
none does; a single key that does, and rows without a key, are cut by digest.
One shuffle brings each shard's rows to a task, sorted by (shard, key, digest);
the task streams them into gzip members, one per record, and rolls to the next
file when the compressed size is reached. No shard has to fit in memory.

Of records with equal payloads of at least ``LEAST_REVISIT`` bytes, the one
with the smallest key is the response and the others are revisits of it. Which
those are is found on (key, digest) alone, without payloads; the marks travel
in the same shuffle as the rows and sort right before them.

A file is written under a temporary name and renamed when it is whole. Names
and contents depend on the rows only, so a task that runs again, or twice at
the same time, leaves the same files. The manifest (name, records, bytes,
SHA-256) is written last; readers open only what it lists and check it.

Defined results: a null payload is empty; a null key is larger than any other;
of rows that repeat the smallest key of a payload the first by target is the
response, and the others revisit it (of rows without any key as well, whose
refers_to stays null); repeated rows have numbered record ids; line ends in a
target are escaped and a null target becomes the record's id; a payload of any
length is one record; an empty table writes no file; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import quoted, ship, stored
from strata.session import work_path

LEAST_REVISIT = 100
SHARD_BYTES, ROLL_BYTES = 64 << 20, 32 << 20
#: Bins of a first cut; cells of all later ones together, and shards, at most.
BINS, MAX_BINS = 1 << 12, 1 << 16
#: FIXED VALUES: names and values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
URN = "urn:x-record:"
MANIFEST = "path string, shard int, no int, records long, bytes long, sha256 string"


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _id(key: int | None, digest: str, no: int = 0) -> str:
    return f"<{URN}{'' if key is None else key}:{digest[:16]}{f':{no}' if no else ''}>"


def _key(record_id: str) -> int | None:
    text = record_id.strip("<>").removeprefix(URN).split(":")[0]
    return int(text) if text else None


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as one gzip member; the header holds no time, so equal records
    give equal bytes."""
    lines = [*headers, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", str(len(block)))]
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head + block + b"\r\n\r\n") + pack.flush()


def record(key: int | None, target: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, no: int = 0) -> bytes:
    """A response or revisit record with regenerated headers and digests;
    ``no`` counts records of the same key and payload."""
    own = _id(key, digest, no)
    uri = own.strip("<>") if target is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in target)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", DATE),
        ("WARC-Target-URI", uri), ("WARC-Payload-Digest", "sha256:" + digest), ("Content-Type", HTTP),
    ]
    if revisit:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _id(refers_to, digest))]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(headers, block if revisit else block + payload)


class _Archive:
    """The file that a task is writing."""

    def __init__(self, files, folder: str, shard: int, no: int):
        self.name = f"shard-{shard:08d}-{no:05d}.warc.gz"
        self.files, self.folder, self.shard, self.no = files, folder, shard, no
        self.temp = f"{folder}/.{self.name}.{uuid.uuid4().hex}"
        self.out = files.open_output_stream(self.temp, compression=None)
        self.size = self.records = 0
        self.hash = hashlib.sha256()
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{self.name}>"), ("WARC-Date", DATE),
                ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
        self._put(_member(info, b"format: WARC File Format 1.1\r\n"))

    def _put(self, data: bytes):
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)

    def add(self, data: bytes):
        self._put(data)
        self.records += 1

    def commit(self, uri: str) -> tuple:
        self.out.close()
        self.files.move(self.temp, f"{self.folder}/{self.name}")
        return f"{uri}/{self.name}", self.shard, self.no, self.records, self.size, self.hash.hexdigest()


def _writer(uri: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _files(uri)
        archive, mark, last, no, done = None, None, None, 0, []
        for batch in batches:
            for shard, key, digest, is_page, target, payload, refers in zip(*(batch.column(i) for i in range(7))):
                if not is_page.as_py():
                    mark = (key.as_py(), digest.as_py(), refers.as_py())
                    continue
                shard, key, digest, payload = shard.as_py(), key.as_py(), digest.as_py(), payload.as_py()
                no = no + 1 if last == (key, digest) else 0
                last = (key, digest)
                if archive and (archive.shard != shard or archive.size >= roll):
                    done.append(archive.commit(uri))
                    archive = _Archive(files, folder, shard, archive.no + 1 if archive.shard == shard else 0)
                archive = archive or _Archive(files, folder, shard, 0)
                # Without a mark the key is the payload's first: its first row
                # is the response.
                marked = mark is not None and mark[:2] == last
                revisit = marked or (no > 0 and len(payload) >= LEAST_REVISIT)
                archive.add(record(key, target.as_py(), payload, digest, mark[2] if marked else key, revisit, no))
        if archive:
            done.append(archive.commit(uri))
        if done:
            names = [x.split(" ")[0] for x in MANIFEST.split(", ")]
            types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    return run


def revisits(small: DataFrame) -> DataFrame:
    """(key, digest, refers_to) of the rows that repeat another's payload, from
    (key, digest, size). Counts are pre-aggregated; payloads are not read on."""
    large = small.where(F.col("size") >= LEAST_REVISIT)
    first = large.groupBy("digest").agg(F.min("key").alias("refers_to"), F.count("*").alias("n"))
    first = first.where((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n")
    return large.join(first, "digest").where(~F.col("key").eqNullSafe(F.col("refers_to"))).select("key", "digest", "refers_to").distinct()


#: Keys may lie further apart than a long reaches.
_BIN = "(key - low) div width"


def _cells(rows: DataFrame) -> DataFrame:
    """Bytes, first and last key of each (range, bin)."""
    bytes_ = F.sum(F.col("size") + 512).alias("b")
    return rows.groupBy("range", "bin").agg(bytes_, F.min("key").alias("first"), F.max("key").alias("last"))


def _binned(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """``rows`` (range, key) with the bin of the key in its range; at most
    MAX_BINS ranges of 24 bytes."""
    got = rows.join(F.broadcast(ranges), "range")
    return got.withColumn("bin", F.expr(_BIN)).drop("low", "width")


def _cut(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    exact = [(r, Decimal(low), Decimal(width)) for r, low, width in rows]
    return spark.createDataFrame(exact, "range int, low decimal(20,0), width decimal(20,0)")


def shards(small: DataFrame, shard_bytes: int) -> tuple[list[DataFrame], DataFrame]:
    """How keys find their shards: one table of ranges (range, low, width) for
    each level of cutting, with the heavy bins of the level before as ranges,
    and the stored cuts (range, bin) to (next range, or shard and the number of
    digest parts). Cells number MAX_BINS on each level at most."""
    spark = small.sparkSession
    low, high, total = small.agg(F.min("key"), F.max("key"), F.coalesce(F.sum(F.col("size") + 512), F.lit(0))).first()
    target = max(shard_bytes, total // MAX_BINS)
    levels, leaves, inner = [], [], []
    rows = small.where(F.col("key").isNotNull()).withColumn("range", F.lit(0))
    ranges = [] if low is None else [(0, low, max(1, -(-(high - low + 1) // BINS)))]
    while ranges:
        levels.append(_cut(spark, ranges))
        rows = _binned(rows, levels[-1])
        cells = stored(_cells(rows), "warc-cells")
        heavy = (F.col("b") > target) & (F.col("first") < F.col("last"))
        leaves.append(cells.where(~heavy))
        found = cells.where(heavy).orderBy("first").collect()
        bins = max(4, min(BINS, MAX_BINS // max(1, len(found))))
        start = ranges[-1][0] + 1
        ranges = [(start + i, r["first"], max(1, -(-(r["last"] - r["first"] + 1) // bins))) for i, r in enumerate(found)]
        named = [(r["range"], r["bin"], n[0]) for r, n in zip(found, ranges)]
        inner.append(spark.createDataFrame(named, "range int, bin long, next int"))
        rows = rows.join(F.broadcast(inner[-1]), ["range", "bin"]).drop("range", "bin").withColumnRenamed("next", "range")
    keyless = small.where(F.col("key").isNull()).agg(F.sum(F.col("size") + 512).alias("b")).where(F.col("b").isNotNull())
    last = keyless.select(F.lit(-1).alias("range"), F.lit(0).cast("long").alias("bin"), "b", F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
    for x in leaves:
        last = last.unionByName(x)
    before = Window.orderBy(F.col("first").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    # A cell of a single key may hold several shards, which its digests share.
    parts = F.when(F.col("first") < F.col("last"), 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("b") / target))).cast("int")
    begin = F.floor(F.coalesce(F.sum("b").over(before), F.lit(0)) / F.lit(target))
    more = F.coalesce(F.sum(parts - 1).over(before), F.lit(0))
    cut = last.select("range", "bin", (begin + more).cast("int").alias("shard"), parts.alias("parts"), F.lit(None).cast("int").alias("next"))
    for x in inner:
        cut = cut.unionByName(x, allowMissingColumns=True)
    return levels, stored(cut, "warc-cuts")


def _placed(rows: DataFrame, levels: list[DataFrame], cut: DataFrame) -> DataFrame:
    """``rows`` (key, digest) with their ``shard``."""
    none = F.lit(None).cast("int")
    rows = rows.withColumns({"range": F.when(F.col("key").isNull(), -1).otherwise(0), "shard": none, "parts": none})
    for i, ranges in enumerate(levels or [None]):
        if ranges is None:
            rows = rows.withColumn("bin", F.lit(0).cast("long"))
        else:
            rows = rows.join(F.broadcast(ranges), "range", "left")
            rows = rows.withColumn("bin", F.when(F.col("range") < 0, 0).otherwise(F.expr(_BIN))).drop("low", "width")
        here = cut.select("range", "bin", F.col("shard").alias("its_shard"), F.col("parts").alias("its_parts"), "next")
        rows = rows.join(F.broadcast(here), ["range", "bin"], "left")
        # A row that has its shard is in no range of the next level.
        rows = rows.withColumns({"shard": F.coalesce("shard", "its_shard"), "parts": F.coalesce("parts", "its_parts"), "range": F.col("next")})
        rows = rows.drop("bin", "its_shard", "its_parts", "next")
    share = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    return rows.withColumn("shard", (F.col("shard") + F.shiftright(share * F.col("parts"), 32)).cast("int")).drop("range", "parts")


def write(rows: DataFrame, key: str, target: str, payload: str, folder: str | None = None, shard_bytes: int = SHARD_BYTES,
          roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archives and return their stored manifest."""
    spark = rows.sparkSession
    ship(spark)
    folder = folder or work_path(spark, "llm", "warc")
    body = F.coalesce(quoted(payload).cast("binary"), F.lit(b""))
    pages = rows.select(
        quoted(key).cast("long").alias("key"), F.sha2(body, 256).alias("digest"), F.lit(True).alias("is_page"),
        quoted(target).alias("target"), body.alias("payload"), F.lit(None).cast("long").alias("refers_to"),
    )
    # Keys, digests and sizes are read by several plans: one pass over the texts.
    small = stored(pages.select("key", "digest", F.octet_length("payload").cast("long").alias("size")), "warc-digests")
    marks = revisits(small).select(
        "key", "digest", F.lit(False).alias("is_page"), F.lit(None).cast("string").alias("target"),
        F.lit(None).cast("binary").alias("payload"), "refers_to",
    )
    tagged = pages.unionByName(marks)
    placed = _placed(tagged, *shards(small, shard_bytes))
    sent = placed.select("shard", "key", "digest", "is_page", "target", "payload", "refers_to")
    n = max(1, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = sent.repartition(n, "shard").sortWithinPartitions("shard", F.col("key").asc_nulls_last(), "digest", "is_page", "target")
    files, path = _files(folder)
    files.create_dir(path, recursive=True)
    return stored(sent.mapInArrow(_writer(folder, roll_bytes), MANIFEST), "warc-manifest")


def _records(source, check) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each gzip member of an open file."""
    unpack, data = zlib.decompressobj(31), b""
    while chunk := source.read(1 << 20):
        check.update(chunk)
        while chunk:
            data += unpack.decompress(chunk)
            chunk = unpack.unused_data
            if unpack.eof:
                head, _, rest = data.partition(b"\r\n\r\n")
                headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                block = rest[: int(headers["Content-Length"])]
                if rest[len(block) :] != b"\r\n\r\n":
                    raise ValueError("a WARC record ends where it should not")
                yield headers, block
                unpack, data = zlib.decompressobj(31), b""
    if data:
        raise ValueError("a WARC file ends inside a record")


READ = "key long, target string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _reader(with_payload: bool):
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, path = _files(uri)
                check, rows, held = hashlib.sha256(), [], 0

                def out():
                    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[x.split(" ")[0] for x in READ.split(", ")])

                with files.open_input_stream(path, compression=None) as source:
                    for h, block in _records(source, check):
                        if hashlib.sha256(block).hexdigest() != h["WARC-Block-Digest"].removeprefix("sha256:"):
                            raise ValueError(f"{uri}: block digest of {h['WARC-Record-ID']}")
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rpartition(b"Content-Length: ")[2])
                        found = h["WARC-Payload-Digest"].removeprefix("sha256:")
                        revisit = h["WARC-Type"] == "revisit"
                        if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != found):
                            raise ValueError(f"{uri}: payload of {h['WARC-Record-ID']}")
                        refers = _key(h["WARC-Refers-To"]) if revisit else None
                        rows.append((_key(h["WARC-Record-ID"]), h["WARC-Target-URI"], length, found, h["WARC-Type"], refers, payload if with_payload else None))
                        held += len(payload) if with_payload else 64
                        if held > 8 << 20:
                            yield out()
                            rows, held = [], 0
                if check.hexdigest() != digest:
                    raise ValueError(f"{uri}: not the file that its manifest lists")
                if rows:
                    yield out()

    return run


def read(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of the listed files, checked against headers and manifest."""
    n = max(1, min(manifest.count(), 20_000))
    return manifest.select("path", "sha256").repartition(n, "path").mapInArrow(_reader(with_payload), READ)


def report(spark: SparkSession, rows: DataFrame, key: str = "page_id", target: str = "url", payload: str = "html", **more) -> DataFrame:
    got = read(write(rows, key, target, payload, **more))
    return got.select(F.col("key").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to")
