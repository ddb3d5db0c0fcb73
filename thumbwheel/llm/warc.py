"""Web archives: deterministic shards, regenerated headers and digests, two-phase commit.

Keys are laid out in order and cut into shards of about ``shard_bytes`` by
running sums of their pages' sizes, so the shard of a page depends on the table
alone; pages are shuffled once, to the task of their shard. Each shard is written in order by one task, which rolls to a new file
when the compressed size reaches ``roll_bytes``. Attempts write under names of
their own; only the files of successful tasks reach the pending manifest, and a
second job renames those and writes the manifest that readers go by. Both
phases can be repeated: a lost executor leaves at most unlisted temporaries.

A record with the payload of an earlier key is a ``revisit`` that refers to it.
Files are reached through ``pyarrow.fs`` by the URI of the folder, so the folder
may be in any store that pyarrow knows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.llm.store import Scratch
from thumbwheel.llm.words import map_batches
from thumbwheel.operators.ordering import running_offsets
from thumbwheel.operators.skew import lookup_join

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_FILE_TASKS = 10_000
MANIFEST_SCHEMA = "name string, temporary string, shard long, roll long, n_records long, n_bytes long, sha256 string"


@dataclass(frozen=True)
class ArchiveConfig:
    prefix: str = "pages"
    shard_bytes: int = 32 << 20  # of payload, more if there would be too many shards
    max_shards: int = 65_536
    roll_bytes: int = 16 << 20  # of compressed file
    min_revisit_bytes: int = 100
    level: int = 6
    date: str = "2000-01-01T00:00:00Z"  # of every record: files depend on the table alone


def _keyed(pages: DataFrame) -> DataFrame:
    payload = F.coalesce("html", F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )


def shard_starts(spark: SparkSession, keys: DataFrame, cfg: ArchiveConfig) -> list[int]:
    """The first page_id of every shard but the first: at most ``max_shards`` numbers."""
    sizes = keys.where("page_id is not null").groupBy("page_id").agg(F.sum("row_bytes").alias("row_bytes"))
    placed = running_offsets(spark, sizes, ["page_id"], "row_bytes")
    size = F.greatest(F.lit(cfg.shard_bytes), F.ceil(F.col("grand_total") / cfg.max_shards))
    shards = placed.groupBy(F.floor(F.col("start") / size).alias("shard")).agg(F.min("page_id").alias("first"))
    return sorted(r["first"] for r in shards.collect())[1:]


def planned_records(spark: SparkSession, pages: DataFrame, cfg: ArchiveConfig, scratch: Scratch) -> DataFrame:
    """Rows for the writers: pages, and before the pages of a key what they refer to.

    The hint rows carry no payload; both kinds know their shard.
    """
    keys = scratch.keep(
        _keyed(pages).groupBy("page_id", "digest").agg(
            F.max(F.octet_length("payload")).alias("n_bytes"),
            F.sum(F.octet_length("payload").cast("long")).alias("row_bytes"), F.count("*").alias("n_rows"),
        ),
        "keys",
    )
    firsts = (
        keys.where(F.col("n_bytes") >= cfg.min_revisit_bytes)
        .groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.sum("n_rows").alias("__n"))
        .where("__n > 1").drop("__n")
    )
    hints = lookup_join(keys.select("page_id", "digest"), firsts, ["digest"], "page_id").where(
        ~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull()
    )
    starts = np.array(shard_starts(spark, keys, cfg), np.int64)

    @F.pandas_udf("long")
    def shard(page_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, page_id.to_numpy(), side="right"))

    absent = lambda kind, name: F.lit(None).cast(kind).alias(name)
    rows = _keyed(pages).select("page_id", "digest", "url", "payload", absent("long", "refers_to")).unionByName(
        hints.select("page_id", "digest", absent("string", "url"), absent("binary", "payload"), "refers_to")
    )
    return rows.withColumn("shard", shard(F.coalesce("page_id", F.lit(-(1 << 63)))))


def _record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def _uri(url: str | None, page_id: int | None) -> str:
    """A target URI without characters that would break the header."""
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _member(headers: list[tuple[str, object]], block: bytes, level: int) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join([*lines, b"", block, b"", b""])) + packer.flush()


def _sha256(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, place: str, cfg: ArchiveConfig
) -> bytes:
    """One gzip member. Headers and digests are made anew from the payload itself."""
    digest = _sha256(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    # A record others may refer to is named by its key and payload, any other by its place.
    own = _record_id(page_id, digest) if refers_to is None and page_id is not None else _record_id(place)
    headers: list[tuple[str, object]] = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", own),
        ("WARC-Date", cfg.date),
        ("WARC-Target-URI", _uri(url, page_id)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", _sha256(block)),
    ]
    if page_id is not None:
        headers.append(("Page-ID", page_id))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("Refers-To-Page-ID", refers_to),
        ]
    return _member(headers, block, cfg.level)


def write_archives(
    spark: SparkSession, pages: DataFrame, folder: str, cfg: ArchiveConfig = ArchiveConfig()
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``folder`` and return the manifest.

    Every row becomes one record: null html is an empty payload, rows with a
    null page_id sort first, repeated rows are repeated records, and of rows
    with one page_id and payload none revisits the other. Other columns are not
    read. An empty table leaves an empty manifest and no file.
    """
    scratch = Scratch(spark, "warc")
    records = planned_records(spark, pages, cfg, scratch)
    ordered = records.repartition("shard").sortWithinPartitions(
        "shard", "page_id", "digest", F.desc_nulls_last("refers_to"), "url"
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(f"{root}/_temporary", recursive=True)
        files: list[dict] = []
        out = None

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                files[-1]["sha256"] = files[-1].pop("hash").hexdigest()
                out = None

        def put(data: bytes) -> None:
            out.write(data)
            files[-1]["hash"].update(data)
            files[-1]["n_bytes"] += len(data)

        hint = None
        for batch in batches:
            for page_id, digest, url, payload, refers_to, shard in zip(*(c.to_pylist() for c in batch.columns)):
                if payload is None:
                    hint = (page_id, digest, refers_to)
                    continue
                refers_to = hint[2] if hint and hint[:2] == (page_id, digest) else None
                if out is None or files[-1]["shard"] != shard or files[-1]["n_bytes"] >= cfg.roll_bytes:
                    roll = files[-1]["roll"] + 1 if files and files[-1]["shard"] == shard else 0
                    close()
                    name = f"{cfg.prefix}-{shard:08d}-{roll:05d}.warc.gz"
                    temporary = f"_temporary/{name}.{uuid.uuid4().hex}"
                    files.append(
                        dict(name=name, temporary=temporary, shard=shard, roll=roll, n_records=0, n_bytes=0,
                             hash=hashlib.sha256())
                    )
                    out = fs.open_output_stream(f"{root}/{temporary}", compression=None)
                    put(_member(
                        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(name)), ("WARC-Date", cfg.date),
                         ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                        b"format: WARC File Format 1.1\r\n", cfg.level,
                    ))
                place = f"{files[-1]['name']}#{files[-1]['n_records']}"
                put(record_bytes(page_id, url, payload, refers_to, place, cfg))
                files[-1]["n_records"] += 1
        close()
        names = [f.split()[0] for f in MANIFEST_SCHEMA.split(", ")]
        if files:
            yield pa.RecordBatch.from_pydict({n: [f[n] for f in files] for n in names})

    pending = scratch.keep(
        ordered.select("page_id", "digest", "url", "payload", "refers_to", "shard").mapInArrow(write, MANIFEST_SCHEMA), "pending"
    )

    def publish(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist()):
            if fs.get_file_info(f"{root}/{temporary}").type != pafs.FileType.NotFound:
                fs.move(f"{root}/{temporary}", f"{root}/{name}")
        yield batch

    manifest = map_batches(_by_file(pending), publish, MANIFEST_SCHEMA).drop("temporary")
    manifest.write.mode("overwrite").parquet(f"{folder}/_manifest")
    scratch.drop("")
    return spark.read.parquet(f"{folder}/_manifest")


def _by_file(manifest: DataFrame) -> DataFrame:
    """Files dealt out over tasks; their rows are too small for Spark to see the work behind them."""
    return manifest.repartition(max(1, min(manifest.count(), MAX_FILE_TASKS)))


def records_of(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of one file, a gzip member at a time."""
    inflater, data = zlib.decompressobj(31), []
    for chunk in stream:
        while chunk:
            data.append(inflater.decompress(chunk))
            chunk = b""
            if inflater.eof:
                record, chunk = b"".join(data), inflater.unused_data
                head, _, rest = record.partition(b"\r\n\r\n")
                lines = head.decode().split("\r\n")
                headers = dict(line.split(": ", 1) for line in lines[1:])
                yield headers, rest[: int(headers["Content-Length"])]
                inflater, data = zlib.decompressobj(31), []
    if any(data):
        raise ValueError("an archive ends within a record")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page record of the files in the manifest, checked against their digests.

    Columns: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for revisits).
    """
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary"
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for name in batch.column("name").to_pylist():
            rows, held = [], 0
            with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
                for headers, block in records_of(iter(lambda: f.read(1 << 20), b"")):
                    if headers["WARC-Type"] not in ("response", "revisit"):
                        continue
                    row = _page_row(headers, block)
                    rows.append(row)
                    held += len(block) + 200
                    if held > 8 << 20:
                        yield _rows_batch(rows, names)
                        rows, held = [], 0
            if rows:
                yield _rows_batch(rows, names)

    manifest = spark.read.parquet(f"{folder}/_manifest").select("name")
    return map_batches(_by_file(manifest), read, schema)


def _rows_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _page_row(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(line[15:]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    kind = headers["WARC-Type"]
    if _sha256(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {headers['WARC-Record-ID']} does not match")
    if kind == "response" and (_sha256(payload) != headers["WARC-Payload-Digest"] or len(payload) != sizes[0]):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match")
    number = lambda key: int(headers[key]) if key in headers else None
    return (
        number("Page-ID"), headers["WARC-Target-URI"], sizes[0],
        headers["WARC-Payload-Digest"].removeprefix("sha256:"), kind, number("Refers-To-Page-ID"),
        payload if kind == "response" else None,
    )
