"""WARC archives with a two-level capture index.

Archives are gzip members, one per record, written by tasks to a shared
folder.  Captures whose payload repeats an earlier one (same SHA-1) become
``revisit`` records that name the ``response`` with the smallest page id.

The index has two levels: lines sorted by (reversed-host URL key, page id) in
compressed blocks of ``BLOCK_LINES``, and per index part a sparse directory
with the first key of each block.  A lookup finds the part in the list of
parts, binary-searches the part's directory, reads one block's range, and then
the record's range in its archive.  All of it is range-partitioned, so a part
is one task's work and a URL with a third of the captures is cut over parts by
its page ids.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm.common import by_file, filesystem, open_new, prepare, read_range, scratch_uri

BLOCK_LINES = 1000
RECORD_DATE = "2024-01-01T00:00:00Z"
#: Level of the records' compression.
LEVEL = 4

_CAPTURE = ("page_id long, url string, urlkey string, digest string, record_type string, refers_to long, "
            "payload_bytes long, file string, offset long, length long")


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, then port, path and query, in lower case; "" for null.

    ``http://www.Example.com/A?b`` gives ``com,example)/a?b``.  The scheme, a
    leading ``www.``, credentials, default ports and the fragment do not
    count.  What has no host sorts by its own text.
    """
    if not url:
        return ""
    text = url.strip()
    try:
        parts = urlsplit(text if "//" in text else f"//{text}")
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return text.lower()
    if not host:
        return text.lower()
    host = host.removeprefix("www.").rstrip(".")
    keyed = ",".join(reversed(host.split(".")))
    if port and (parts.scheme, port) not in (("http", 80), ("https", 443)):
        keyed += f":{port}"
    return f"{keyed}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def _header_text(value: str) -> str:
    """A header value on one line (percent-encoded line ends)."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, uncompressed: a response, or a revisit without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {RECORD_DATE}",
             f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{digest_of(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers (names in lower case), ``payload`` (None for a revisit) and the HTTP length of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(headers["content-length"])]
    if headers["warc-block-digest"] != f"sha1:{digest_of(block)}":
        raise ValueError(f"damaged record {headers.get('warc-record-id')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"headers": headers, "http_length": length,
            "payload": payload if headers["warc-type"] == "response" else None}


def _first_holders(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to) of the captures that revisit an earlier one.

    Only ids and digests are shuffled; the smallest id per digest is
    aggregated before the shuffle, and digests with one holder drop out.
    """
    narrow = (pages.select("page_id", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"),
                           F.octet_length(F.coalesce("html", F.lit(""))).alias("n"))
                   .where((F.col("n") >= min_bytes) & F.col("page_id").isNotNull()))
    first = (narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
                   .where("last > refers_to").select("digest", "refers_to"))
    return (narrow.select("page_id", "digest").join(first, "digest").where("page_id > refers_to")
                  .groupBy("page_id", "digest").agg(F.min("refers_to").alias("refers_to")))


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, page_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> CaptureIndex:
    """Write a record per row and the capture index; returns the index.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest page id is a response and the others revisit it; smaller ones
    are responses.  A null html is an empty payload; a null url has no target
    and the empty key; a null page id is written as a response and sorts
    first; rows that repeat an id and payload are all of its kind.  Other
    columns are not read; an empty table gives empty archives and index.
    """
    spark = prepare(pages.sparkSession)
    folder = folder or scratch_uri(spark, "warc")
    pages = pages.select(F.col(page_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    again = _first_holders(pages, min_bytes).select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"),
                                                    "refers_to")
    rows = (pages.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
                 .join(again, (F.col("page_id") == F.col("__page")) & (F.col("digest") == F.col("__digest")), "left")
                 .select("page_id", "url", "html", "refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        name = out = None
        offset = 0
        for batch in batches:
            if out is None and len(batch):
                name, out = open_new(folder, f"records-{TaskContext.get().partitionId():06d}", ".warc.gz")
            found = []
            for page, url, html, refers in zip(*(batch[c].tolist() for c in ("page_id", "url", "html", "refers_to")),
                                               strict=True):
                page, refers = (None if x is None or x != x else int(x) for x in (page, refers))
                url = url if isinstance(url, str) else None
                payload = html.encode("utf-8", "surrogatepass") if isinstance(html, str) else b""
                digest = digest_of(payload)
                data = gzip.compress(record_bytes(page, url, payload, digest, refers), LEVEL, mtime=0)
                out.write(data)
                found.append((page, url, url_key(url), digest, "response" if refers is None else "revisit", refers,
                              len(payload), name, offset, len(data)))
                offset += len(data)
            frame = pd.DataFrame(found, columns=[x.split()[0] for x in _CAPTURE.split(", ")])
            for c in ("page_id", "refers_to"):
                frame[c] = pd.array(frame[c].tolist(), dtype="Int64")
            yield frame
        if out is not None:
            out.close()

    rows.mapInPandas(write, _CAPTURE).write.parquet(f"{folder}/captures")
    captures = spark.read.schema(_CAPTURE).parquet(f"{folder}/captures")
    return write_index(captures, folder)


# -- index ----------------------------------------------------------------------------------------

#: Rows of the list of index parts (about 200 bytes each) that are broadcast at once.
MAX_PARTS = 100_000

_PARTS = "first string, first_page string, last string, last_page string, file string, lines long"
_PART_COLUMNS = [x.split()[0] for x in _PARTS.split(", ")]


def _page_text(page) -> str:
    """Page id as text that sorts like the number; a null id sorts before all."""
    return "" if page is None else f"{page + (1 << 63):020d}"


def _line_key(urlkey: str, page) -> tuple[str, str]:
    return urlkey, _page_text(page)


def write_index(captures: DataFrame, folder: str) -> CaptureIndex:
    """Sorted, block-compressed index lines and their directories from capture rows."""
    spark = captures.sparkSession

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        name = out = first = last = None
        offset, lines, directory, n = 0, [], [], 0

        def flush():
            nonlocal offset, lines
            data = gzip.compress("\n".join(json.dumps(x[1:]) for x in lines).encode(), LEVEL, mtime=0)
            out.write(data)
            directory.append((lines[0][0], offset, len(data)))
            offset, lines = offset + len(data), []

        for batch in batches:
            for urlkey, page, file, at, length in zip(*(batch[c].tolist() for c in ("urlkey", "page_id", "file", "offset", "length")),
                                                      strict=True):
                page = None if page is None or page != page else int(page)
                if out is None:
                    name, out = open_new(folder, f"index-{TaskContext.get().partitionId():06d}", ".cdx.gz")
                key = _line_key(urlkey, page)
                first, last, n = first if first is not None else key, key, n + 1
                lines.append((key, urlkey, page, file, at, length))
                if len(lines) >= BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            files, path = filesystem(folder)
            with files.open_output_stream(f"{path}/{name}.dir") as f:
                f.write(zlib.compress(json.dumps(directory).encode()))
            yield pd.DataFrame([(*first, *last, name, n)], columns=_PART_COLUMNS)

    (captures.select("urlkey", "page_id", "file", "offset", "length")
             .repartitionByRange(F.col("urlkey"), F.col("page_id").asc_nulls_first())
             .sortWithinPartitions(F.col("urlkey"), F.col("page_id").asc_nulls_first())
             .mapInPandas(write, _PARTS)
             .write.parquet(f"{folder}/parts"))
    return CaptureIndex(spark, folder)


class IndexPart:
    """One part of the index: a sparse directory and range reads of its blocks."""

    def __init__(self, folder: str, name: str):
        self.folder, self.name = folder, name
        directory = json.loads(zlib.decompress(read_range(folder, f"{name}.dir")))
        self.firsts = [tuple(x[0]) for x in directory]
        self.ranges = [x[1:] for x in directory]
        self._held: tuple[int, list] = (-1, [])

    def block(self, k: int) -> list[list]:
        """The lines (urlkey, page_id, file, offset, length) of block ``k``."""
        if self._held[0] != k:
            offset, length = self.ranges[k]
            lines = gzip.decompress(read_range(self.folder, self.name, offset, length)).decode().split("\n")
            self._held = (k, [json.loads(x) for x in lines])
        return self._held[1]

    def find(self, urlkey: str, page=None, any_page: bool = False) -> list[list]:
        """Lines of a URL key and page id, or of all its page ids."""
        low = _line_key(urlkey, None if any_page else page)
        k = max(0, bisect.bisect_left(self.firsts, low) - 1)
        out = []
        while k < len(self.firsts) and (self.firsts[k] <= low or any_page and self.firsts[k][0] == urlkey):
            out += [x for x in self.block(k) if x[0] == urlkey and (any_page or x[1] == page)]
            k += 1
        return out


class CaptureIndex:
    """Finds captures by URL and reads their records."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def parts(self) -> DataFrame:
        """(first, first_page, last, last_page, file, lines) of each index part."""
        return self.spark.read.schema(_PARTS).parquet(f"{self.folder}/parts")

    def _part_blocks(self) -> Iterator[list[tuple]]:
        """The list of parts in key order, at most ``MAX_PARTS`` at a time."""
        block = []
        for r in self.parts().orderBy("first", "first_page").toLocalIterator():
            block.append(((r["first"], r["first_page"]), (r["last"], r["last_page"]), r["file"]))
            if len(block) >= MAX_PARTS:
                yield block
                block = []
        if block:
            yield block

    def lookup(self, keys: DataFrame) -> DataFrame:
        """(urlkey, page_id, file, offset, length) of the keys ``(page_id, url)`` that the index holds.

        Each key is binary-searched in the list of parts (broadcast in bounded
        blocks), then each part serves its keys with one open directory.
        Repeated keys are looked up once.
        """
        folder, spark = self.folder, self.spark
        wanted = keys.select("page_id", "url").distinct()
        schema = "part string, urlkey string, page_id long"

        def place(shared):
            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                parts = shared.value
                firsts = [p[0] for p in parts]
                for batch in batches:
                    rows = []
                    for p, u in zip(batch["page_id"].tolist(), batch["url"].tolist(), strict=True):
                        p, u = None if p is None or p != p else int(p), url_key(u if isinstance(u, str) else None)
                        key = _line_key(u, p)
                        k = bisect.bisect_right(firsts, key) - 1
                        if k >= 0 and key <= parts[k][1]:
                            rows.append((parts[k][2], u, p))
                    frame = pd.DataFrame(rows, columns=["part", "urlkey", "page_id"])
                    frame["page_id"] = pd.array(frame["page_id"].tolist(), dtype="Int64")
                    yield frame
            return run

        placed = spark.createDataFrame([], schema)
        for block in self._part_blocks():
            placed = placed.union(wanted.mapInPandas(place(spark.sparkContext.broadcast(block)), schema))

        def look(group: pd.DataFrame) -> pd.DataFrame:
            part, found = IndexPart(folder, group["part"].iloc[0]), []
            for urlkey, page in group.sort_values(["urlkey", "page_id"])[["urlkey", "page_id"]].itertuples(index=False):
                found += part.find(urlkey, None if pd.isna(page) else int(page))
            frame = pd.DataFrame(found, columns=["urlkey", "page_id", "file", "offset", "length"])
            frame["page_id"] = pd.array(frame["page_id"].tolist(), dtype="Int64")
            return frame

        return by_file(placed.distinct(), "part").groupBy("part").applyInPandas(
            look, "urlkey string, page_id long, file string, offset long, length long")

    def captures(self, url: str) -> list[list]:
        """Index lines of one URL: a few directory and block reads on the caller's side."""
        key = url_key(url)
        names = [r["file"] for r in self.parts().where((F.col("first") <= key) & (F.col("last") >= key))
                 .orderBy("first", "first_page").collect()]
        return [line for name in names for line in IndexPart(self.folder, name).find(key, any_page=True)]

    def read(self, places: DataFrame, with_payload: bool = True) -> DataFrame:
        """The records at ``places``: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

        The payload of a revisit is null; without ``with_payload`` all are.
        """
        folder = self.folder

        def fetch(group: pd.DataFrame) -> pd.DataFrame:
            rows = []
            order = group.sort_values("offset")
            name = order["file"].iloc[0]
            for at in range(0, len(order), 256):                   # neighbours in one range read
                part = order.iloc[at:at + 256]
                low, high = int(part["offset"].iloc[0]), int((part["offset"] + part["length"]).max())
                data = read_range(folder, name, low, high - low)
                for offset, length in zip(part["offset"].tolist(), part["length"].tolist(), strict=True):
                    record = parse_record(gzip.decompress(data[offset - low:offset - low + length]))
                    head, payload = record["headers"], record["payload"]
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if payload is not None and (digest_of(payload) != digest or len(payload) != record["http_length"]):
                        raise ValueError(f"damaged payload in {name} at {offset}")
                    rows.append((int(head["x-page-id"]) if "x-page-id" in head else None, head.get("warc-target-uri"),
                                 record["http_length"], digest, head["warc-type"],
                                 int(head["x-refers-to-page-id"]) if "x-refers-to-page-id" in head else None,
                                 payload if with_payload else None))
            frame = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type",
                                                "refers_to", "payload"])
            for c in ("page_id", "refers_to"):
                frame[c] = pd.array(frame[c].tolist(), dtype="Int64")
            return frame

        return by_file(places.select("file", "offset", "length").distinct(), "file").groupBy("file").applyInPandas(
            fetch, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                   "refers_to long, payload binary")
