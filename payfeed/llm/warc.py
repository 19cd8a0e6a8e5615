"""WARC archives: written as one gzip stream a file, normalised to one member a record.

``write_archives`` makes monolithic files (a whole file is one gzip stream) and
``normalise_archives`` turns any such file into its seekable form: it inflates the stream once,
writes every record as a gzip member of its own, and writes a sidecar index with the
offset and length of each member. ``read_archives`` reads records by that index. A record is
the most that is held in memory.

Records with equal payloads of at least ``REVISIT_BYTES`` bytes are stored once: the one
with the smallest page_id is the response, the others are revisits that name it.

Nulls, ties, repeated rows: null html is an empty payload; a row without page_id is never
the smallest, and such rows alone are all responses; rows that repeat the smallest
page_id with the same payload are all responses. A null url is an empty target. Extra columns are
not stored. Empty input gives no files and no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import urllib.parse
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.llm.files import fresh_file, open_fs
from payfeed.session import materialize, run_path

REVISIT_BYTES = 100
FILE_BYTES = 256 << 20
_CHUNK = 1 << 20
_GZIP = 31
_DATE = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMED = re.compile(r"<urn:page:(-?\d+)>")
MANIFEST = "path string, index_path string, records long"


def _page_urn(page_id) -> str:
    return "<urn:page:none>" if page_id is None or pd.isna(page_id) else f"<urn:page:{int(page_id)}>"


def _page_of(urn: str | None) -> int | None:
    found = _NAMED.fullmatch(urn or "")
    return int(found[1]) if found else None


def encode_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; a revisit has the payload's digest and size and no payload."""
    target = re.sub(r"[\x00-\x20\x7f-\x9f]", lambda c: urllib.parse.quote(c[0]), url or "")
    revisit = refers_to is not None and not pd.isna(refers_to)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_page_urn(page_id)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_page_urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def split_head(record: bytes) -> tuple[dict[str, str], int]:
    """Header fields (lower-case names) and where the block begins."""
    end = record.index(b"\r\n\r\n")
    fields = {}
    for line in record[:end].decode("utf-8").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, end + 4


def inflated(read) -> Iterator[bytes]:
    """Chunks of a gzip file from ``read(size)``, of one member or of several."""
    inflate = zlib.decompressobj(_GZIP)
    while data := read(_CHUNK):
        while data:
            yield inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(_GZIP)
    yield inflate.flush()


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of a stream, each with the empty lines behind it."""
    buffer, need = bytearray(), None
    for chunk in chunks:
        buffer += chunk
        while True:
            if need is None:
                if b"\r\n\r\n" not in buffer:
                    break
                fields, begin = split_head(bytes(buffer[: buffer.index(b"\r\n\r\n") + 4]))
                need = begin + int(fields["content-length"]) + 4
            if len(buffer) < need:
                break
            yield bytes(buffer[:need])
            del buffer[:need]
            need = None
    if buffer:
        raise ValueError("the archive ends inside a record")


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as monolithic archives; returns their manifest."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    large = rows.filter(F.octet_length("html") >= REVISIT_BYTES)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    # A written side lets adaptive execution split a payload that many pages share.
    first = materialize(first.filter("n > 1 and first_id is not null").select("digest", "first_id"), "payloads")
    joined = rows.join(first, "digest", "left")
    later = F.coalesce(F.col("page_id") != F.col("first_id"), F.col("first_id").isNotNull())
    stored = joined.select("page_id", "url", "html", "digest", F.when(later, F.col("first_id")).alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, path, out, packer, size, count, rows = TaskContext.get().partitionId(), "", None, None, 0, 0, []

        def close() -> None:
            out.write(packer.flush())
            out.close()
            rows.append((path, "", count))

        for batch in batches:
            for page_id, url, text, digest, refers_to in batch.itertuples(index=False):
                if out is None or size >= file_bytes:
                    if out is not None:
                        close()
                    path, size, count = fresh_file(folder, f"whole-{part:06d}", ".warc.gz"), 0, 0
                    files, local = open_fs(path)
                    out, packer = files.open_output_stream(local, compression=None), zlib.compressobj(1, zlib.DEFLATED, _GZIP)
                record = encode_record(page_id, url, text.encode("utf-8", "replace"), digest, refers_to)
                out.write(packer.compress(record))
                size, count = size + len(record), count + 1
        if out is not None:
            close()
        yield pd.DataFrame(rows, columns=["path", "index_path", "records"])

    return materialize(stored.mapInPandas(write, MANIFEST), "archives")


def normalise_file(path: str, folder: str) -> tuple[str, str, int]:
    """Rewrite one archive with a member a record and a sidecar index (JSON lines)."""
    files, local = open_fs(path)
    target = fresh_file(folder, "records", ".warc.gz")
    index = target.removesuffix(".warc.gz") + ".cdxj"
    offset = count = 0
    with files.open_input_stream(local, compression=None) as source, files.open_output_stream(open_fs(target)[1], compression=None) as out, files.open_output_stream(open_fs(index)[1], compression=None) as side:
        for record in records(inflated(source.read)):
            packer = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
            member = packer.compress(record) + packer.flush()
            fields, _ = split_head(record)
            line = {"offset": offset, "length": len(member), "type": fields["warc-type"], "id": fields["warc-record-id"], "url": fields.get("warc-target-uri", ""), "digest": fields.get("warc-payload-digest", "")}
            out.write(member)
            side.write(json.dumps(line).encode() + b"\n")
            offset, count = offset + len(member), count + 1
    return target, index, count


def normalise_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Seekable archives and indexes for the archives of a manifest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([normalise_file(p, folder) for p in batch["path"]], columns=["path", "index_path", "records"])

    return materialize(_spread(manifest).mapInPandas(run, MANIFEST), "normalised")


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """Records by index: page_id, payload_bytes, payload_digest, record_type, refers_to, and (if ``payload``) url and payload.

    Size and digest are those of the full payload: a response's are taken from its bytes, a
    revisit's from its fields.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["url", "payload"] * payload
        for batch in batches:
            for path, index in zip(batch["path"], batch["index_path"]):
                files, local = open_fs(path)
                with files.open_input_stream(open_fs(index)[1], compression=None) as side, files.open_input_file(local) as source:
                    rows = []
                    for line in side.read().splitlines():
                        at = json.loads(line)
                        rows.append(_read_record(zlib.decompress(source.read_at(at["length"], at["offset"]), _GZIP), payload))
                        if len(rows) == 1000:
                            yield _frame(rows, names)
                            rows = []
                    yield _frame(rows, names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return _spread(manifest).mapInPandas(run, schema + (", url string, payload binary" if payload else ""))


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def _read_record(record: bytes, with_payload: bool) -> tuple:
    fields, begin = split_head(record)
    block = record[begin : begin + int(fields["content-length"])]
    head, body = split_head(block)
    data, kind = block[body:], fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha256:") if kind == "revisit" else hashlib.sha256(data).hexdigest()
    size = int(head["content-length"]) if kind == "revisit" else len(data)
    row = (_page_of(fields["warc-record-id"]), size, digest, kind, _page_of(fields.get("warc-refers-to")))
    return row + ((fields.get("warc-target-uri", ""), None if kind == "revisit" else data) if with_payload else ())


def _spread(manifest: DataFrame) -> DataFrame:
    """One file a partition, or several where there are many files."""
    many = 10 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartitionByRange(max(1, min(many, manifest.count())), "path")


def archive_pages(pages: DataFrame, payload: bool = False) -> DataFrame:
    """Write, normalise and read back all ``pages`` through the shared folder."""
    spark = pages.sparkSession
    whole = write_archives(pages, run_path(spark, "warc-whole"))
    return read_archives(normalise_archives(whole, run_path(spark, "warc")), payload)
