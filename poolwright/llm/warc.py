"""Deterministic sharded WARC writer, and its reader.

Records are dealt by ranges of their id and sorted within. Range edges come from exact
counts over id bins, refined where ids crowd, not from a sample, so equal input gives equal
files. A task writes one gzip member a record, rolls to the next file when the
compressed size is reached, and makes all headers and digests anew from the payload.

Files are written under temporary names; a task's rows tell what it wrote. These rows
are the manifest: once written, its files get their final names in a second job, which may
be repeated. A lost or repeated task leaves a temporary file that no manifest names. Readers
follow the manifest.

Of equal payloads of at least ``REVISIT_BYTES`` the one with the largest id is kept, the others become
revisit records. A null id sorts first and is never the kept one beside others; repeated rows
(equal id and payload) are alike. A null payload is empty.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolwright.llm.common import column, frugal
from poolwright.session import work_folder

REVISIT_BYTES = 1000
#: Compressed bytes after which a file is closed, and payload bytes of a shard.
ROLL_BYTES = 256 << 20
SHARD_BYTES = 1 << 30
#: Bins of ids that are counted first to find the range edges, and finer ones, at least, of a heavy bin.
BINS, FINER = 1 << 14, 64
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder: any that Arrow knows by its scheme, local without one."""
    if "://" not in uri and not uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(uri)


# --- records -------------------------------------------------------------------


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _clean(value: str) -> str:
    """A header's value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def member(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    head = [("WARC-Type", kind), ("WARC-Date", DATE), *fields, ("WARC-Block-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    raw = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def page_member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A page as a response, or as a revisit of the page ``refers_to``."""
    digest = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Record-ID", record_id(page_id, digest.hexdigest())), ("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest.digest()).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        fields.append(("WARC-Page-Id", str(page_id)))
    if refers_to is None:
        return member("response", fields, http + payload)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest.hexdigest())), ("WARC-Refers-To-Page-Id", str(refers_to))]
    return member("revisit", fields, http)


def first_member(name: str) -> bytes:
    """The record that opens every file."""
    return member("warcinfo", [("WARC-Record-ID", record_id(None, name)), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an open archive."""
    rest = b""
    while True:
        rest = rest or stream.read(1 << 20)
        if not rest:
            return
        unpacker = zlib.decompressobj(31)
        parts = []
        while not unpacker.eof:
            if not rest and not (rest := stream.read(1 << 20)):
                raise ValueError("an archive ends within a record")
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
        head, _, body = b"".join(parts).partition(b"\r\n\r\n")
        fields = {}
        for line in head.decode().split("\r\n")[1:]:
            key, _, value = line.partition(": ")
            fields[key.lower()] = value
        yield fields, body[: int(fields["content-length"])]


# --- writer --------------------------------------------------------------------


def records_of(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, html, digest); payloads of less than ``REVISIT_BYTES`` have no digest."""
    rows = pages.select(
        column(pages, "page_id", "long").alias("page_id"), column(pages, "url", "string").alias("url"),
        F.coalesce(column(pages, "html", "string"), F.lit("")).alias("html"))
    return rows.withColumn("digest", F.when(F.octet_length("html") >= REVISIT_BYTES, F.sha1(F.col("html").cast("binary"))))


def references(rows: DataFrame) -> DataFrame:
    """Rows (page_id, digest, refers_to) of the payloads that become revisits. Only ids and digests are shuffled."""
    own = rows.filter("digest is not null").select("page_id", "digest")
    kept = own.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 and refers_to is not null").drop("n")
    return own.join(kept, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def range_of(begins: Column, value: Column) -> Column:
    """Number of the sorted ``begins`` that are not above a whole number, by halving."""
    steps = F.sequence(F.ceil(F.log2(F.size(begins) + 1)).cast("int"), F.lit(0), F.lit(-1))

    def halve(at: Column, step: Column) -> Column:
        tried = at + F.call_function("shiftleft", F.lit(1), step)
        return F.when(F.coalesce(F.get(begins, tried - 1) <= value, F.lit(False)), tried).otherwise(at)

    return F.aggregate(steps, F.lit(0), halve)


def edges(pages: DataFrame, shard_bytes: int) -> list[int]:
    """Smallest id of every shard but the first: ranges of about ``shard_bytes`` of payload.

    Ids are counted in ``BINS`` bins of equal width. What a bin holds beyond a quarter of a shard is counted again in finer bins
    of that bin, all such bins in one job, until a bin is light or a single id; so ids may lie as they will. Jobs are few, as
    widths shrink by ``FINER`` at least, and the bins that reach the driver follow the number of shards.
    """
    rows = pages.select(column(pages, "page_id", "long").alias("id"), (F.octet_length(F.coalesce(column(pages, "html", "string"), F.lit(""))) + 1).alias("size"))
    found = rows.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    if found["lo"] is None:
        return []
    low, high = found["lo"], found["hi"]
    rows = rows.select(F.coalesce("id", F.lit(low)).alias("id"), "size")
    most = max(1, shard_bytes // 4)
    open_ = [(low, (high - low) // BINS + 1, high)]  # begin, width of a bin, last id
    sizes: dict[int, int] = {}  # bytes by the smallest id of a light bin
    while open_:
        begins, widths, ends = (F.from_json(F.lit(json.dumps([o[i] for o in open_])), "array<bigint>") for i in range(3))
        within = rows.withColumn("k", range_of(begins, F.col("id")) - 1).filter("k >= 0").filter(F.col("id") <= F.element_at(ends, F.col("k") + 1))
        # differences of far ids do not fit 64 bits
        exact = lambda c: c.cast("decimal(20,0)")
        place = F.floor((exact(F.col("id")) - exact(F.element_at(begins, F.col("k") + 1))) / exact(F.element_at(widths, F.col("k") + 1)))
        counted = within.groupBy("k", place.cast("long").alias("place")).agg(F.sum("size").alias("size"), F.min("id").alias("lo"), F.max("id").alias("hi")).collect()
        open_ = []
        for r in counted:
            if r["size"] <= most or r["lo"] == r["hi"]:
                sizes[r["lo"]] = r["size"]
            else:
                open_.append((r["lo"], (r["hi"] - r["lo"]) // max(FINER, 4 * r["size"] // most) + 1, r["hi"]))
        open_.sort()
    held, out = 0, []
    for begin, n in sorted(sizes.items()):
        if held and held + n > shard_bytes:
            out.append(begin)
            held = 0
        held += n
    return out


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in ``folder``; returns the manifest.

    The manifest, at ``folder``/manifest, has a row a file: shard, number, name, records, bytes, sha256.
    """
    spark = pages.sparkSession
    begins = edges(pages, shard_bytes)
    system, root = file_system(folder)
    system.create_dir(f"{root}/temporary", recursive=True)
    table = F.from_json(F.lit(json.dumps(begins)), "array<bigint>")
    shard = F.when(F.col("page_id").isNull(), 0).otherwise(range_of(table, F.col("page_id"))) if begins else F.lit(0)
    rows = records_of(pages)
    # references travel with the pages, ahead of each id, so pages are shuffled once
    ahead = references(rows).select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "refers_to", F.lit(0).alias("turn"))
    rows = ahead.union(rows.select("page_id", "url", "html", "digest", F.lit(None).cast("long"), F.lit(1))).withColumn("shard", shard.cast("int"))
    dealt = rows.repartition(len(begins) + 1, "shard").sortWithinPartitions("shard", "page_id", "turn", "url", "digest", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        done: list[tuple] = []
        open_: list = []  # shard, number, temporary name, stream, digest, bytes, records

        def close() -> None:
            shard, number, temporary, stream, digest, size, count = open_
            stream.close()
            done.append((shard, number, temporary, f"pages-{shard:06d}-{number:04d}.warc.gz", count, size, digest.hexdigest()))
            open_.clear()

        def put(data: bytes) -> None:
            open_[3].write(data)
            open_[4].update(data)
            open_[5] += len(data)

        known: dict[str, int] = {}  # what this id's payloads refer to
        known_id: int | None = None
        for batch in batches:
            for shard, page_id, url, html, digest, refers in zip(*(batch.column(c) for c in ("shard", "page_id", "url", "html", "digest", "refers_to"))):
                shard, page_id, digest = shard.as_py(), page_id.as_py(), digest.as_py()
                if page_id != known_id:
                    known, known_id = {}, page_id
                if not html.is_valid:
                    known[digest] = refers.as_py()
                    continue
                number = 0
                if open_ and (open_[0] != shard or open_[5] >= roll_bytes):
                    number = open_[1] + 1 if open_[0] == shard else 0
                    close()
                if not open_:
                    temporary = f"temporary/{shard}-{number}-{uuid.uuid4().hex}"
                    open_ += [shard, number, temporary, system.open_output_stream(f"{root}/{temporary}", compression=None), hashlib.sha256(), 0, 0]
                    put(first_member(f"pages-{shard:06d}-{number:04d}.warc.gz"))
                put(page_member(page_id, url.as_py(), html.as_buffer().to_pybytes(), known.get(digest)))
                open_[6] += 1
        if open_:
            close()
        names = ["shard", "number", "temporary", "name", "records", "bytes", "sha256"]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], kind) for i, kind in enumerate(kinds)], names)

    written = dealt.select("shard", "page_id", "url", "html", "digest", "refers_to").mapInArrow(
        run, "shard int, number int, temporary string, name string, records long, bytes long, sha256 string")
    with frugal(spark):
        written.write.parquet(f"{folder}/pending")
    commit(spark, folder)
    return spark.read.parquet(f"{folder}/manifest")


def commit(spark: SparkSession, folder: str) -> None:
    """Give the files of the pending manifest their names and write the manifest; may be repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        for batch in batches:
            for temporary, name in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist()):
                old, new = system.get_file_info([f"{root}/{temporary}", f"{root}/{name}"])
                if old.type != pa.fs.FileType.NotFound:
                    system.move(f"{root}/{temporary}", f"{root}/{name}")
                elif new.type == pa.fs.FileType.NotFound:
                    raise FileNotFoundError(f"{root}/{temporary}")
            yield batch.drop_columns(["temporary"])

    pending = spark.read.parquet(f"{folder}/pending")
    kinds = "shard int, number int, name string, records long, bytes long, sha256 string"
    pending.mapInArrow(run, kinds).write.mode("overwrite").parquet(f"{folder}/manifest")
    system, root = file_system(folder)
    system.delete_dir(f"{root}/temporary")  # what is left there, no manifest names


# --- reader --------------------------------------------------------------------


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives that the manifest in ``folder`` names.

    Columns: page_id, url, record_type, refers_to, payload_bytes, payload_digest (both of the full
    payload), and the payload of responses. Digests of responses are computed from what was read
    and must agree with the headers.
    """
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for fields, block in records(stream):
                        if fields["warc-type"] not in ("response", "revisit"):
                            continue
                        head, _, payload = block.partition(b"\r\n\r\n")
                        length = next(int(x[16:]) for x in head.decode().split("\r\n") if x.lower().startswith("content-length: "))
                        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        page_id, refers, url = (fields.get(k) for k in ("warc-page-id", "warc-refers-to-page-id", "warc-target-uri"))
                        if fields["warc-type"] == "response":
                            length, own = len(payload), hashlib.sha1(payload).hexdigest()
                            if own != digest:
                                raise ValueError(f"{name}: the payload of page {page_id} does not have its digest")
                        rows.append((
                            None if page_id is None else int(page_id), None if url is None else _plain(url), fields["warc-type"],
                            None if refers is None else int(refers), length, digest, payload if fields["warc-type"] == "response" else None))
                        size += len(payload)
                        if size > 4 << 20 or len(rows) > 5000:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.parquet(f"{folder}/manifest").select("name")
    n = max(1, min(files.count(), 10_000))
    kinds_sql = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string" + ", payload binary" * payloads
    return files.repartition(n, "name").mapInArrow(run, kinds_sql)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the work folder and read back."""
    spark = pages.sparkSession
    folder = f"{work_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, folder, roll_bytes=8 << 20, shard_bytes=16 << 20)
    return read(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The records that must come back, in SQL.
PAGES_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), kept as (
  select payload_digest, max(page_id) as kept from p where payload_bytes >= 1000 group by payload_digest having count(*) > 1
)
select page_id, payload_bytes, p.payload_digest,
  case when kept is not null and kept is distinct from page_id then 'revisit' else 'response' end as record_type,
  case when kept is not null and kept is distinct from page_id then kept end as refers_to
from p left join kept on p.payload_digest = kept.payload_digest
"""
