"""WARC: a deterministic sharded writer, and a reader of its archives.

Records are cut into shards of about equal payload by ranges of ``page_id``
(the cuts follow from the data alone), sorted, and written as gzip members.  A
shard's file is closed once its compressed size reaches the limit and the next
one begins.  Headers and digests are made anew from the payload; record ids
derive from page id and digest, dates are a parameter, so the same pages give
the same bytes.  Files get their final names when whole, and the manifest that
names them is written last; readers use only what it names.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with
the largest page id is a response; the others are revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import commit_file, filesystem, slices, stored, temporary_name, write_manifest
from larder.session import scratch_dir

REVISIT_BYTES = 1000
FILE_BYTES = 16 << 20  # compressed; a file exceeds it by less than a record
SHARD_BYTES = 64 << 20  # payload of a shard, before compression
CUTS = 4096  # ranges of page_id whose sizes the cuts are made from
#: Payloads with copies that are broadcast (about 100 bytes each) at most;
#: beyond that the join shuffles.
BROADCAST_GROUPS = 300_000
DATE = "2024-01-01T00:00:00Z"
LEVEL = 4
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _record_id(page_id: int | None, digest: str, copy: int) -> str:
    name = f"{page_id}:{digest}" + (f":{copy}" if copy else "")
    return f"<urn:uuid:{uuid.uuid5(_SPACE, name)}>"


def _base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _uri(url: str | None) -> str:
    """A header value holds no line ends."""
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, copy: int = 0, date: str = DATE) -> bytes:
    """One WARC record; ``refers_to``: the response's page id of a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest, copy)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(url)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).hexdigest())}",
        f"WARC-Payload-Digest: {_base32(digest)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_record_id(refers_to, digest, 0)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive; block digests are checked."""
    at = 0
    while at < len(data):
        member = zlib.decompressobj(31)
        raw = member.decompress(data[at:at + (1 << 16)])
        fed = at + (1 << 16)
        parts = [raw]
        while not member.eof:
            if fed >= len(data):
                raise ValueError("the archive ends inside a record")
            parts.append(member.decompress(data[fed:fed + (1 << 20)]))
            fed += 1 << 20
        at = min(fed, len(data)) - len(member.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        block = rest[:int(headers["Content-Length"])]
        if _base32(hashlib.sha1(block).hexdigest()) != headers["WARC-Block-Digest"]:
            raise ValueError(f"block digest of {headers['WARC-Record-ID']} differs")
        yield headers, block


def _with_types(pages: DataFrame) -> DataFrame:
    """Pages with digest, size, and the response that a revisit refers to.

    Of repeated rows with the largest page id, the first in the order of the
    file is the response, which only the writer can tell: all carry it here.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html").cast("long"))
    long = rows.where(F.col("size") >= REVISIT_BYTES).select("page_id", "digest")
    # Only payloads that occur more than once are joined back.
    groups = long.groupBy("digest").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    groups = stored(pages.sparkSession, groups, "warc-copies")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    return rows.join(groups, "digest", "left")


def _shards(pages: DataFrame) -> tuple[int, int, list[int]]:
    """(least id, ids in a range, shard of each range): at most ``CUTS`` ranges."""
    ids = pages.agg(F.min("page_id"), F.max("page_id")).first()
    if ids[0] is None:
        return 0, 1, [0]
    least, span = int(ids[0]), (int(ids[1]) - int(ids[0])) // CUTS + 1
    cut = ((F.col("page_id") - least) / span).cast("int")
    sizes = pages.where("page_id is not null").groupBy(cut.alias("cut")).agg(F.sum(F.octet_length(F.coalesce("html", F.lit("")))).alias("size"))
    of = {r.cut: r["size"] for r in sizes.collect()}
    shard, filled, out = 0, 0, []
    for c in range(CUTS):
        if filled >= SHARD_BYTES:
            shard, filled = shard + 1, 0
        filled += of.get(c, 0)
        out.append(shard)
    return least, span, out


def write_warc(pages: DataFrame, uri: str, file_bytes: int = FILE_BYTES, date: str = DATE) -> list[dict]:
    """Write a record per row; returns the manifest's files (path, records, bytes).

    Null html is an empty payload, a null url an empty target.  Rows are in
    order of page id (nulls first), then url and payload; repeated rows are
    records of their own.  An empty table gives a manifest without files.
    """
    spark = pages.sparkSession
    least, span, shards = _shards(pages)
    of = F.array(*[F.lit(s) for s in _starts(shards)])
    n_shards = shards[-1] + 1
    cut = F.coalesce(((F.col("page_id") - least) / span).cast("int"), F.lit(0))
    # The shard is the last one that starts at or before the row's range.
    rows = _with_types(pages).withColumn("shard", F.size(F.filter(of, lambda s: s <= cut)) - 1)
    order = [F.col("shard"), F.col("page_id").asc_nulls_first(), F.col("url").asc_nulls_first(), F.col("digest")]
    rows = rows.repartitionByRange(max(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard").sortWithinPartitions(*order)
    filesystem(uri)[0].create_dir(filesystem(uri)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesys, root = filesystem(uri)
        files: list[dict] = []
        out, shard, before, copy = None, None, None, 0

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                commit_file(filesys, files[-1]["tmp"], files[-1]["final"])
                out = None

        for batch in slices(batches):
            for row in batch.to_pylist():
                if shard != row["shard"]:
                    close()
                    shard, seq = row["shard"], 0
                same = (row["page_id"], row["digest"])
                copy = copy + 1 if same == before else 0
                before = same
                refers = row["largest"]
                # Pages without an id, and the first row of the largest id, are responses.
                if refers is not None and (row["page_id"] is None or (row["page_id"] == refers and not copy)):
                    refers = None
                raw = record_bytes(row["page_id"], row["url"], row["html"].encode("utf-8"), row["digest"], refers, copy, date)
                member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = member.compress(raw) + member.flush()
                if out is None:
                    final = posixpath.join(root, f"part-{shard:06d}-{seq:04d}.warc.gz")
                    files.append({"final": final, "tmp": temporary_name(final), "shard": shard, "seq": seq, "records": 0, "bytes": 0})
                    out = filesys.open_output_stream(files[-1]["tmp"], compression=None)
                    seq += 1
                out.write(data)
                files[-1]["records"] += 1
                files[-1]["bytes"] += len(data)
                if files[-1]["bytes"] >= file_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([f["final"] for f in files], pa.string()), *(pa.array([f[k] for f in files], pa.int64()) for k in ("shard", "seq", "records", "bytes"))],
            ["path", "shard", "seq", "records", "bytes"])

    shape = "path string, shard long, seq long, records long, bytes long"
    columns = rows.select("shard", "page_id", "url", "html", "digest", "largest")
    written = stored(spark, columns.mapInArrow(run, shape), "warc-manifest")
    files = [r.asDict() for r in written.orderBy("shard", "seq").collect()]  # a row per file
    write_manifest(uri, "manifest.json", {"files": files, "date": date})
    return files


def _starts(shards: list[int]) -> list[int]:
    return [i for i, s in enumerate(shards) if i == 0 or s != shards[i - 1]]


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, record_id string"


def read_warc(spark: SparkSession, files: list[dict], payloads: bool = False) -> DataFrame:
    """Records of the manifest's files, a row each; with ``payloads`` also the
    payload (null for revisits).  Size and digest are of the full payload: of
    the block for responses, as stated in the headers for revisits."""
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "record_id"] + ["payload"] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for path in batch.column("path").to_pylist():
                filesys, root = filesystem(path)
                with filesys.open_input_stream(root, compression=None) as stream:
                    rows = [_row(h, b, payloads) for h, b in parse_records(stream.read())]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(
                    [(n, pa.int64() if n in ("page_id", "payload_bytes", "refers_to") else pa.binary() if n == "payload" else pa.string()) for n in names]))

    listed = spark.createDataFrame([(f["path"],) for f in files], "path string")
    shape = RECORD + (", payload binary" if payloads else "")
    return listed.repartition(max(1, len(files)), "path").mapInArrow(run, shape)


def _row(headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = headers["WARC-Type"] == "revisit"
    stated = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(next(line for line in http.decode().split("\r\n") if line.startswith("Content-Length: ")).split(": ")[1])
    digest = stated if revisit else hashlib.sha1(payload).hexdigest()
    if digest != stated or not revisit and size != len(payload):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its headers")
    page = headers.get("X-Page-ID")
    refers = headers.get("X-Refers-To-Page-ID")
    row = {"page_id": None if page is None else int(page), "url": headers["WARC-Target-URI"], "record_type": headers["WARC-Type"],
           "payload_bytes": size, "payload_digest": digest, "refers_to": None if refers is None else int(refers), "record_id": headers["WARC-Record-ID"]}
    if payloads:
        row["payload"] = None if revisit else payload
    return row


def write_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages to the shared folder and return what the archives hold."""
    files = write_warc(pages, scratch_dir(pages.sparkSession, "warc"))
    return read_warc(pages.sparkSession, files)
