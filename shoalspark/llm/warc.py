"""Deterministic sharded WARC writer and reader.

Records are range-sorted, each task rolls its files by compressed size under temporary names and reports them in a
manifest, which Spark commits: only files of attempts that won are in it. A second job renames those to final names, a
marker ends the commit, and readers take nothing that the manifest does not list. Files go through pyarrow's file
systems to the folder's own store.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dealt_anew_text, delete_folder, shared_dir

MIN_REVISIT, DATE, MOST_TASKS = 100, "2024-01-01T00:00:00Z", 50_000
MANIFEST = "file string, temporary string, bytes long, records long, sha256 string"


def _at(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


def _record(kind: str, page_id, url: str, digest: str, size: int, first, payload: bytes, copy: int = 0) -> bytes:
    """One gzip member, the same bytes for the same row whenever it is written. copy tells equal rows apart."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    name = lambda i, d: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{i}:{d}')}>"
    head = {
        "WARC-Type": kind, "WARC-Record-ID": name(page_id, digest + kind + (f":{copy}" if copy else "")), "WARC-Date": DATE, "WARC-Target-URI": re.sub(r"\s", "", url or "urn:none"),
        "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type": "application/http; msgtype=response", "X-Payload-Length": size,
    }
    if page_id is not None:
        head["X-Page-Id"] = page_id
    if kind == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": name(first, digest + "response"), "X-Refers-To-Page-Id": first}
    lines = "".join(f"{k}: {v}\r\n" for k, v in (head | {"Content-Length": len(block)}).items())
    return gzip.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n", 6, mtime=0)


def write(pages: DataFrame, folder: str, roll_bytes: int = 64 << 20, shard_bytes: int = 256 << 20) -> DataFrame:
    """Writes page_id, url and html of each row to folder and returns the committed manifest.

    Null html is empty. Of payloads that are equal and have MIN_REVISIT bytes, the smallest page_id is the response, the
    others revisit it; rows equal in page_id too give one response. A null page_id is written and sorts first; it is a
    revisit if a named row has its payload. An empty table gives an empty manifest. Other columns are not read.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    digests = pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    firsts = digests.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    notes = digests.select("page_id", dealt_anew_text(F.col("digest")).alias("d")).join(firsts.select(dealt_anew_text(F.col("digest")).alias("d"), "first"), "d").groupBy("page_id", "d").agg(F.min("first").alias("first"))
    empty = F.lit(None).cast("string")
    # Notes travel with the pages to the range sort, so the payloads are shuffled once; a page's notes come before it.
    both = pages.select("page_id", F.lit(1).alias("part"), F.col("url").cast("string").alias("url"), html.alias("html"), empty.alias("d"), F.lit(None).cast(pages.schema["page_id"].dataType).alias("first")).unionByName(
        notes.select("page_id", F.lit(0).alias("part"), empty.alias("url"), empty.alias("html"), "d", "first")
    )
    total = digests.agg(F.sum("bytes")).first()[0] or 0
    shards = max(8, -(-total // shard_bytes))
    sorted_rows = both.repartitionByRange(shards, "page_id").sortWithinPartitions("page_id", "part", F.xxhash64("html"), "url")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _at(folder)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        out, number, made, size, count, known, current = None, 0, None, 0, 0, {}, object()

        def close() -> pd.DataFrame:
            out.close()
            return pd.DataFrame([(f"part-{part:05d}-{number:05d}.warc.gz", f"_temporary/{part:05d}-{number:05d}-{attempt}", size, count, made.hexdigest())], columns=[c.split()[0] for c in MANIFEST.split(", ")])

        for batch in batches:
            for page_id, kind, url, text, digest, first in batch.astype(object).where(batch.notna(), None).itertuples(index=False, name=None):
                page_id = None if page_id is None else int(page_id)
                if page_id != current:
                    current, known = page_id, {}
                if kind == 0:
                    known[digest] = int(first)
                    continue
                payload = text.encode()
                digest = hashlib.sha256(payload).hexdigest()
                target = known.get(digest)
                if target is not None and target == page_id:
                    known[digest], target = target, None
                    if (digest, "seen") in known:
                        target = page_id
                    known[digest, "seen"] = 1
                copy = known[digest, "copies"] = known.get((digest, "copies"), -1) + 1
                record = _record("response", page_id, url, digest, len(payload), None, payload, copy) if target is None else _record("revisit", page_id, url, digest, len(payload), target, b"", copy)
                if out is None:
                    store.create_dir(f"{root}/_temporary", recursive=True)
                    out, made, size, count = store.open_output_stream(f"{root}/_temporary/{part:05d}-{number:05d}-{attempt}", compression=None), hashlib.sha256(), 0, 0
                out.write(record)
                made.update(record)
                size, count = size + len(record), count + 1
                if size >= roll_bytes:
                    yield close()
                    out, number = None, number + 1
        if out is not None:
            yield close()

    session = pages.sparkSession
    sorted_rows.mapInPandas(run, MANIFEST).write.parquet(f"{folder}/manifest")
    commit(session, folder)
    return session.read.parquet(f"{folder}/manifest")


def commit(session: SparkSession, folder: str) -> None:
    """Gives the manifest's files their names, a file a task, sets the marker and drops what lost attempts wrote.

    Running it again after a loss does no harm.
    """

    def rename(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileType

        store, root = _at(folder)
        for batch in batches:
            for name, temporary in zip(batch["file"], batch["temporary"], strict=True):
                if store.get_file_info(f"{root}/{name}").type == FileType.NotFound:
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
            yield pd.DataFrame({"renamed": [len(batch)]})

    manifest = session.read.parquet(f"{folder}/manifest").select("file", "temporary")
    manifest.repartition(max(1, min(manifest.count(), MOST_TASKS)), "file").mapInPandas(rename, "renamed long").agg(F.sum("renamed")).first()
    store, root = _at(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/_COMMITTED") as marker:
        marker.write(b"1\n")
    delete_folder(session, f"{folder}/_temporary")


def _parse(stream) -> Iterator[tuple]:
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()).strip():
            k, v = line.decode().split(":", 1)
            head[k] = v.strip()
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n" or f"sha256:{hashlib.sha256(block).hexdigest()}" != head["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
        payload = block.partition(b"\r\n\r\n")[2]
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        if head["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"wrong payload digest in {head['WARC-Record-ID']}")
        number = lambda k: int(head[k]) if k in head else None  # noqa: E731, B023
        yield number("X-Page-Id"), head["WARC-Target-URI"], payload if head["WARC-Type"] == "response" else None, int(head["X-Payload-Length"]), digest, head["WARC-Type"], number("X-Refers-To-Page-Id")


def read(session: SparkSession, folder: str) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to of the committed archives, about a file a task."""
    manifest = session.read.parquet(f"{folder}/manifest").select("file")
    files = max(1, min(manifest.count(), MOST_TASKS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _at(folder)
        names = ["page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for name in batch["file"]:
                with store.open_input_file(f"{root}/{name}") as raw, gzip.GzipFile(fileobj=raw) as stream:
                    rows, held = [], 0
                    for r in _parse(stream):
                        rows.append((r[0], r[1], None if r[2] is None else r[2].decode(), *r[3:]))
                        held += r[3]
                        if held > 8 << 20:
                            yield pd.DataFrame(rows, columns=names, dtype=object)
                            rows, held = [], 0
                    yield pd.DataFrame(rows, columns=names, dtype=object)

    return manifest.repartition(files, "file").mapInPandas(run, "page_id long, url string, html string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, **sizes) -> DataFrame:
    """Writes the pages to a new folder in the shared one, and reads the archives back."""
    folder = f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write(pages, folder, **sizes)
    return read(pages.sparkSession, folder)
