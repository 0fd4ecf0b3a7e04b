"""Web archives with repeated payloads stored once.

Payload digests are shuffled without payloads; each digest that occurs more than once names its first
page, and pages meet that name again over digest and a salt, so a digest with very many pages doesn't
meet in one task. Archives are written by Spark's text writer: a record is one row, and the record end
of the format (two line breaks) is the row end, so files are committed like any Spark output and can
lie on any storage. Reading goes by ``Content-Length`` and streams each file record by record.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Smaller payloads are always stored.
SMALLEST_REVISIT = 100
SALTS = 16
_CRLF = "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page: Column, url: Column, digest: Column) -> Column:
    name = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("-")), F.coalesce(url, F.lit("-")), digest))
    cut = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """One header line, or none for a null value; line breaks in the value become spaces."""
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit(_CRLF))


def resolve_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, html, digest, bytes, record_id, refers_to``: ``refers_to`` is null for a response.

    Of pages with equal payloads of ``SMALLEST_REVISIT`` bytes or more, that with the smallest id is
    the response. Null html is an empty payload. Pages without id are never the original; rows that
    repeat the smallest id are responses each. Other columns are ignored.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("html")).select(
        "*", F.sha2("html", 256).alias("digest"), F.octet_length("html").cast("long").alias("bytes")
    )
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first")
    originals = (
        source.where(F.col("bytes") >= SMALLEST_REVISIT)
        .groupBy("digest")
        .agg(first, F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select(
            F.col("digest").alias("of_digest"),
            F.col("first.page_id").alias("first_id"),
            _record_id(F.col("first.page_id"), F.col("first.url"), F.col("digest")).alias("first_record"),
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"),
        )
    )
    salted = source.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return salted.join(originals, (F.col("digest") == F.col("of_digest")) & (F.col("salt") == F.col("of_salt")), "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        "bytes",
        _record_id(F.col("page_id"), F.col("url"), F.col("digest")).alias("record_id"),
        F.when(again, F.col("first_record")).alias("refers_to"),
    )


def write_archives(resolved: DataFrame, path: str, date: str = "2025-01-01T00:00:00Z") -> None:
    """Writes the records of :func:`resolve_revisits` as gzipped WARC 1.1 files below ``path``."""
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(_HTTP + "Content-Length: "), F.col("bytes").cast("string"), F.lit(_CRLF * 2))
    block = F.when(again, http).otherwise(F.concat(http, "html"))
    size = F.octet_length(http) + F.when(again, F.lit(0)).otherwise(F.col("bytes"))
    headers = [
        F.lit("WARC/1.1" + _CRLF),
        _header("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.col("record_id")),
        _header("WARC-Date", F.lit(date)),
        F.coalesce(_header("WARC-Target-URI", F.col("url")), F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.coalesce(_header("WARC-Refers-To", F.col("refers_to")), F.lit("")),
        F.when(again, _header("WARC-Profile", F.lit(_PROFILE))).otherwise(F.lit("")),
        F.coalesce(_header("Page-Id", F.col("page_id").cast("string")), F.lit("")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", size.cast("string")),
        F.lit(_CRLF),
        block,
    ]
    records = resolved.select(F.concat(*headers).alias("value"))
    records.write.option("lineSep", _CRLF * 2).option("compression", "gzip").text(path)


class _Stream:
    """Reads a gzipped file piece by piece."""

    def __init__(self, content: bytes, piece: int = 1 << 20) -> None:
        self.parts, self.held, self.at = self._inflate(content, piece), b"", 0

    @staticmethod
    def _inflate(content: bytes, piece: int) -> Iterator[bytes]:
        rest = content
        while rest:
            unzip = zlib.decompressobj(wbits=31)
            while not unzip.eof and rest:
                out = unzip.decompress(rest, piece)
                rest = unzip.unconsumed_tail if not unzip.eof else unzip.unused_data
                yield out
                if not rest and not unzip.eof:
                    yield unzip.flush()

    def _more(self) -> bool:
        part = next(self.parts, None)
        if part is None:
            return False
        self.held, self.at = self.held[self.at :] + part, 0
        return True

    def until(self, mark: bytes) -> bytes:
        """The bytes before the next ``mark``, which is passed over; nothing at the end of the file."""
        while (end := self.held.find(mark, self.at)) < 0:
            if not self._more():
                return b""
        found, self.at = self.held[self.at : end], end + len(mark)
        return found

    def exactly(self, size: int) -> bytes:
        parts, missing = [], size
        while missing:
            part = self.held[self.at : self.at + missing]
            parts.append(part)
            self.at += len(part)
            missing -= len(part)
            if missing and not self._more():
                raise ValueError("an archive ends inside a record")
        return b"".join(parts)


def records_in(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzipped archive."""
    stream = _Stream(content)
    while head := stream.until(b"\r\n\r\n"):
        lines = head.decode().split(_CRLF)
        headers = dict(line.split(": ", 1) for line in lines[1:])
        yield headers, stream.exactly(int(headers["Content-Length"]))
        if stream.exactly(4) != b"\r\n\r\n":
            raise ValueError("an archive record doesn't end where its length says")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "record_id", "record_type", "refers_record", "payload_digest", "payload_bytes"]
    types = [pa.string()] * 5 + [pa.int64()]
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for headers, block in records_in(content.as_py()):
                stored = headers["WARC-Type"] == "response"
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                digest = hashlib.sha256(payload).hexdigest() if stored else None
                if stored and headers["WARC-Payload-Digest"] != f"sha256:{digest}":
                    raise ValueError("an archived payload doesn't have its digest")
                rows.append(
                    (
                        headers.get("Page-Id"),
                        headers["WARC-Record-ID"],
                        headers["WARC-Type"],
                        headers.get("WARC-Refers-To"),
                        digest,
                        len(payload) if stored else None,
                    )
                )
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def read_archives(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """One row per record: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A revisit gets length and digest of the payload from the response it refers to, and names its page.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    records = files.mapInArrow(
        _read,
        "page_id string, record_id string, record_type string, refers_record string, payload_digest string, payload_bytes long",
    )
    stored, revisits = records.where("record_type = 'response'"), records.where("record_type = 'revisit'")
    asked = revisits.select(F.col("refers_record").alias("record_id")).distinct()
    targets = (
        stored.join(asked, "record_id", "left_semi")
        .groupBy("record_id")
        .agg(F.min(F.struct("page_id", "payload_digest", "payload_bytes")).alias("of"))
        .select(F.col("record_id").alias("refers_record"), "of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = revisits.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    resolved = salted.join(targets, ["refers_record", "salt"], "left").select(
        F.col("page_id").cast(id_type).alias("page_id"),
        F.col("of.payload_bytes").alias("payload_bytes"),
        F.col("of.payload_digest").alias("payload_digest"),
        "record_type",
        F.col("of.page_id").cast(id_type).alias("refers_to"),
    )
    return stored.select(
        F.col("page_id").cast(id_type).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.lit(None).cast(id_type).alias("refers_to"),
    ).unionByName(resolved)
