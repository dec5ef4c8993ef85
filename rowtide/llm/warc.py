"""WARC archives: a deterministic sharded writer and a reader.

Records are sorted by id over shards. The shard bounds are a function of the data alone: bytes are summed over at most
``RANGES`` equal id ranges, and neighbouring ranges share a shard up to ``SHARD_BYTES``. A task streams its shard in
order, gives every record new headers and digests, compresses it as a gzip member of its own and starts the next file
when the compressed size reaches ``ROLL_BYTES``. A file is written under a temporary name and renamed when complete; a
retried task writes the same bytes to the same name. The list of files, with sizes and digests, is the manifest: a
Parquet table that Spark commits last. Readers take the files of the manifest only.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with the largest id is the response; the
others are revisit records that refer to it and have no payload of their own.

Edge cases: a null payload is empty; a null id is written as ``null`` and sorts first; rows with one id and one payload
are one another's equals (both are responses if no larger id has it); characters of a URL that a header can't hold are
percent-encoded; an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.session import broadcast_if_small, materialize, scratch_path

REVISIT_BYTES = 1000
ROLL_BYTES = 8 << 20
SHARD_BYTES = 32 << 20
RANGES = 4096
DATE = "2024-01-01T00:00:00Z"  # headers are regenerated, the same in every run
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_MANIFEST = "file string, bytes long, sha256 string, records long, first_id string, last_id string"


def file_system(uri: str):
    """The file system of a folder that all executors share, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: str | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record: a response with the payload, or a revisit without it."""
    block = HTTP + payload if refers_to is None else HTTP
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe='%/:=&?~#+!$,;@()*[]' + chr(39))}",
        f"WARC-Payload-Digest: {_digest(payload)}",
        f"WARC-Block-Digest: {_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write_map(folder: str, roll: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = file_system(folder)
        made: list[tuple] = []
        state: dict = {"shard": None}

        def close() -> None:
            if state["shard"] is None or not state["records"]:
                return
            name = f"part-{state['shard']:06d}-{state['file']:05d}.warc.gz"
            data = b"".join(state["members"])
            hidden = f"{base}/.{name}.{uuid.uuid4().hex}"
            with files.open_output_stream(hidden, compression=None) as out:
                out.write(data)
            files.move(hidden, f"{base}/{name}")
            made.append((name, len(data), hashlib.sha256(data).hexdigest(), state["records"], state["first"], state["last"]))

        def open_file(shard: int, number: int) -> None:
            state.update(shard=shard, file=number, members=[], size=0, records=0, first=None, last=None)

        for frame in frames:
            for shard, page_id, url, payload, refers in zip(frame["shard"], frame["page_id"], frame["url"], frame["payload"], frame["refers_to"], strict=True):
                if shard != state["shard"]:
                    close()
                    open_file(shard, 0)
                elif state["size"] >= roll:
                    close()
                    open_file(shard, state["file"] + 1)
                gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = gz.compress(record(page_id, url, payload, refers)) + gz.flush()
                state["members"].append(member)
                state["size"] += len(member)
                state["records"] += 1
                state["first"] = page_id if state["records"] == 1 else state["first"]
                state["last"] = page_id
        close()
        out = pd.DataFrame(made, columns=["file", "bytes", "sha256", "records", "first_id", "last_id"])
        yield out

    return run


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Adds ``payload`` (bytes) and ``refers_to`` (null for responses). Payloads aren't shuffled for it while the repeated digests are few
    (measured); beyond the bound Spark joins by the digest."""
    rows = pages.withColumn("payload", F.coalesce(F.col("html"), F.lit("")).cast("binary")).drop("html")
    rows = rows.withColumns({"_sha": F.unhex(F.sha1("payload")), "_long": F.octet_length("payload") >= least})
    groups = rows.filter("_long").groupBy("_sha").agg(F.max("page_id").alias("_top"), F.count("*").alias("_n")).filter("_n > 1").select("_sha", "_top", F.lit(True).alias("_long"))
    joined = rows.join(broadcast_if_small(groups), ["_sha", "_long"], "left")
    refers = F.when(F.col("_top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top")), F.col("_top"))
    return joined.withColumn("refers_to", refers).drop("_sha", "_long", "_top")


def _shards(rows: DataFrame, target: int) -> tuple[DataFrame, int]:
    """Adds ``shard``; the number of shards."""
    low, high = rows.agg(F.min("page_id"), F.max("page_id")).first()
    low, high = (0, 0) if low is None else (low, high)
    width = max(1, -(-(high - low + 1) // RANGES))
    exact = "decimal(20,0)"  # ids may lie more than 2^63 apart
    part = F.coalesce(F.floor((F.col("page_id").cast(exact) - F.lit(low).cast(exact)) / F.lit(width).cast(exact)), F.lit(0)).cast("long")
    sizes = rows.groupBy(part.alias("r")).agg(F.sum(F.octet_length("html") + 600).alias("b")).orderBy("r").collect()  # at most RANGES rows
    bounds, held = [], 0
    for r in sizes:
        if held and held + (r["b"] or 0) > target:
            bounds.append(r["r"])
            held = 0
        held += r["b"] or 0
    shard = F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]).cast("array<bigint>"), lambda b: b <= part)) if bounds else F.lit(0)
    return rows.withColumn("shard", shard.cast("long")), len(bounds) + 1


def write_archives(pages: DataFrame, folder: str, roll: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` to ``folder``; the manifest (file, bytes, sha256, records, first_id, last_id)."""
    spark = pages.sparkSession
    files, base = file_system(folder)
    files.create_dir(f"{base}/data", recursive=True)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    rows, n = _shards(rows, shard_bytes)
    rows = with_revisits(rows)
    placed = rows.repartition(n, "shard") if n == 1 else rows.repartitionByRange(n, "shard")
    ordered = placed.sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "url", F.sha1("payload"))
    made = ordered.select("shard", F.col("page_id").cast("string"), "url", "payload", F.col("refers_to").cast("string")).mapInPandas(_write_map(f"{folder}/data", roll), _MANIFEST)
    made.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    rest, member = b"", zlib.decompressobj(31)
    out: list[bytes] = []
    while True:
        data = rest or stream.read(1 << 20)
        rest = b""
        if not data:
            return
        out.append(member.decompress(data))
        if member.eof:
            yield b"".join(out)
            rest, member, out = member.unused_data, zlib.decompressobj(31), []


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; the block digest is verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if _digest(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, block


def _id(urn: str | None) -> str | None:
    return None if urn is None or "null" in urn else urn.removeprefix("<urn:page:").rstrip(">")


def _read_map(folder: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = file_system(folder)
        for frame in frames:
            for name in frame["file"]:
                rows = []
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for data in _members(stream):
                        fields, block = parse(data)
                        payload = block.partition(b"\r\n\r\n")[2]
                        own = fields["WARC-Type"] == "response"
                        sha = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        if own and sha != hashlib.sha1(payload).hexdigest():
                            raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
                        rows.append((_id(fields["WARC-Record-ID"]), fields["WARC-Type"], sha, len(payload) if own else -1, _id(fields.get("WARC-Refers-To"))))
                yield pd.DataFrame(rows, columns=["page_id", "record_type", "payload_digest", "own_bytes", "refers_to"])

    return run


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record; a revisit has its response's bytes."""
    spread = manifest.select("file").repartition(max(1, manifest.count()))  # a task per file
    rows = spread.mapInPandas(_read_map(f"{folder}/data"), "page_id string, record_type string, payload_digest string, own_bytes long, refers_to string")
    rows = rows.withColumns({"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})
    rows = materialize(rows)  # slim; both sides of the join below read it, the archives are read once
    full = rows.filter("record_type = 'response'").groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_sha")).agg(F.max("own_bytes").alias("_bytes"))
    joined = rows.join(full, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_sha")), "left")
    return joined.select("page_id", F.when(F.col("own_bytes") >= 0, F.col("own_bytes")).otherwise(F.col("_bytes")).alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives below the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS d FROM p),
t AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d) ELSE page_id END AS top FROM q)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM t
"""
