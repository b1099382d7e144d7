"""A content-addressed WARC archive.

An archive is a folder of two Parquet tables. ``payloads`` holds each distinct payload once, compressed by itself,
under its SHA-256; ``headers`` holds each record's exact header bytes (WARC header and HTTP header) with the digest of
its payload. Original records are put together again by joining the two, and every payload read back is checked against
its digest. The first record of a payload (smallest page_id) is a response; later ones with an equal payload of at least
``least`` bytes are revisits, whose record has no payload of its own. ``parsed`` takes the assembled bytes of records
apart again: header fields, lengths, payloads.

Edge cases: a null payload counts as empty; a null url becomes ``about:blank``; control characters and blanks in urls,
and nothing else, are percent-encoded, so that they cannot end a header line; payloads are stored and read whole,
however long (one is held by one task); rows that share the smallest page_id of a payload are all responses; a null
page_id is a response if no other row has its payload, else a revisit; only the three named columns are read, so others
of any name do no harm; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionforge.llm.common import ROWS_A_FILE, cut, partitions, quoted, remove_folder, shared_folder

#: Fixed values of RFC 4648 (base32) beside the digits that conv() gives for base 32.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "1970-01-01T00:00:00Z"
LEVEL = 3
#: What a record's bytes are parsed to.
PARSED = ("type", "url", "record_id", "refers_to_record", "named_sha1", "payload_bytes", "payload_sha1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hex_digits: Column) -> Column:
    """40 hexadecimal digits in base 32: each 5 digits are 20 bits, or 4 digits of base 32."""
    parts = [F.lpad(F.conv(F.substring(hex_digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


def safe_url(url: Column) -> Column:
    u = F.coalesce(url.cast("string"), F.lit("about:blank"))
    encoded = u
    for code in [*range(0x21), 0x7F]:
        encoded = F.replace(encoded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(u.rlike("[\\x00-\\x20\\x7F]"), encoded).otherwise(u)


def record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit("record"), page_id.cast("string"), digest).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def record_headers(rows: DataFrame, date: str = DATE) -> DataFrame:
    """Adds warc_header and http_header (binary) to rows with page_id, url, payload_bytes, sha1_base32, digest,
    record_type, refers_to."""
    lf = "\r\n"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{lf}Content-Type: text/html; charset=utf-8{lf}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(lf + lf))
    revisit = F.col("record_type") == "revisit"
    block = F.length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"), F.concat(F.lit("WARC-Target-URI: "), safe_url(F.col("url"))), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("digest"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to"), F.col("digest")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "sha1_base32"), F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    return rows.withColumns({"warc_header": F.concat(F.concat_ws(lf, *lines), F.lit(lf + lf)).cast("binary"), "http_header": http.cast("binary")})


def compressed(rows: DataFrame) -> DataFrame:
    """rows with payload compressed, each by itself, as it is stored and sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for b in batches:
            packed = pa.array([pack(x.as_buffer()) for x in b.column("payload")], pa.binary())
            yield b.set_column(b.schema.get_field_index("payload"), "payload", packed)

    return rows.mapInArrow(run, rows.schema)


def restored(records: DataFrame) -> DataFrame:
    """records with payload as it was; fails where it is missing or has another digest than the record names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                plain = []
                for digest, x in zip(part.column("digest").to_pylist(), part.column("payload"), strict=True):
                    if not x.is_valid:
                        raise ValueError(f"no payload {digest}")
                    plain.append(unpack(x.as_buffer()))
                    if hashlib.sha256(plain[-1]).hexdigest() != digest:
                        raise ValueError(f"not the payload of {digest}")
                yield part.set_column(part.schema.get_field_index("payload"), "payload", pa.array(plain, pa.binary()))

    return records.mapInArrow(run, records.schema)


def write_archive(pages: DataFrame, folder: str, least: int = 0, date: str = DATE, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Writes pages as an archive: payloads are read once for their digests and once, of first records, to be stored."""
    content = F.coalesce(pages[quoted(payload_col)].cast("string").cast("binary"), F.lit(b""))
    plain = pages.select(pages[quoted(id_col)].alias("page_id"), pages[quoted(url_col)].alias("url"), content.alias("payload"))
    d = plain.select("page_id", "url", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("digest"), base32(F.sha1("payload")).alias("sha1_base32"))
    records = cut(d)
    # One row a digest, cut so that the join below reads two plain inputs and can split a hot digest's rows.
    index = cut(records.groupBy("digest").agg(F.min("page_id").alias("first_id")).withColumnRenamed("digest", "of").repartition(max(1, min(partitions(pages), records.count() // ROWS_A_FILE))))
    d = records.join(index, records["digest"] == index["of"]).drop("of")
    again = (F.col("payload_bytes") >= least) & ~F.coalesce(F.col("page_id") == F.col("first_id"), F.col("first_id").isNull())
    d = d.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
    d = d.withColumn("refers_to", F.when(again, F.col("first_id"))).drop("first_id")
    record_headers(d, date).select("page_id", "record_type", "refers_to", "digest", "payload_bytes", "warc_header", "http_header").write.option("compression", "zstd").parquet(f"{folder}/headers")
    # A payload is stored with the digest it was found by; of rows that tie, one. Dealt by digest and page, once, so
    # that the copies of a hot payload are dropped where they lie, all over the cluster.
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = compressed(plain.select(F.sha2("payload", 256).alias("digest"), name("page_id").alias("page"), "payload"))
    first = index.select("of", name("first_id").alias("first_page"))
    kept = own.join(first, (own["digest"] == first["of"]) & (own["page"] == first["first_page"]), "left_semi")
    kept.groupBy("digest", "page").agg(F.first("payload").alias("payload")).drop("page").write.option("compression", "none").parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All records of an archive: page_id, record_type, refers_to, digest, warc_header, http_header, payload (the full
    one, also of revisits). Fails if a payload is missing or does not have its digest."""
    headers, payloads = (spark.read.parquet(f"{folder}/{t}") for t in ("headers", "payloads"))
    d = headers.join(payloads.withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"), "left").drop("of")
    return restored(d)


def record_bytes(records: DataFrame) -> DataFrame:
    """Adds record, the WARC record as bytes."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.withColumn("record", F.concat("warc_header", "http_header", body, F.lit(b"\r\n\r\n")))


def parse_record(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """The fields of a record's header, its HTTP header, and the payload behind it; fails where lengths do not fit."""
    head = record.index(b"\r\n\r\n") + 4
    version, *lines = record[: head - 4].decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    end = head + int(fields["Content-Length"])
    if not version.startswith("WARC/") or record[end:] != b"\r\n\r\n":
        raise ValueError(f"not one whole record: {fields.get('WARC-Record-ID')}")
    body = record.index(b"\r\n\r\n", head, end) + 4
    return fields, record[head:body], record[body:end]


def parsed(records: DataFrame) -> DataFrame:
    """records (with record and payload, the full one) to page_id, refers_to, and as the record's bytes have it: type,
    url, record_id, refers_to_record, named_sha1; and of the full payload, which for a response is the record's own:
    payload_bytes, payload_sha1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for record, payload in zip(b.column("record"), b.column("payload"), strict=True):
                fields, _, own = parse_record(record.as_py())
                full = own if fields["WARC-Type"] == "response" else payload.as_py()
                named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                rows.append((fields["WARC-Type"], fields["WARC-Target-URI"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), named, len(full), base64.b32encode(hashlib.sha1(full).digest()).decode()))
            columns = zip(*rows, strict=True) if rows else ([] for _ in PARSED)
            yield pa.record_batch([b.column("page_id"), b.column("refers_to"), *(pa.array(list(c), pa.int64() if n == "payload_bytes" else pa.string()) for n, c in zip(PARSED, columns, strict=True))], names=["page_id", "refers_to", *PARSED])

    kinds = dict(records.dtypes)
    schema = ", ".join([f"page_id {kinds['page_id']}", f"refers_to {kinds['refers_to']}", *(f"{n} {'long' if n == 'payload_bytes' else 'string'}" for n in PARSED)])
    elsewhere = F.when(F.col("record_type") == "revisit", F.col("payload")).alias("payload")  # a response has its payload in its bytes
    return records.select("page_id", "refers_to", "record", elsewhere).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """Writes the archive, puts each record together, and gives what its bytes say."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    d = parsed(record_bytes(read_archive(spark, folder)))
    # The named digest must be that of the payload read back, and a revisit must name the record it refers to.
    digest = F.when(F.col("payload_sha1") == F.col("named_sha1"), F.col("payload_sha1")).otherwise(F.raise_error(F.lit("a header names another digest")).cast("string"))
    refers = F.when(F.col("refers_to_record").isNull() == F.col("refers_to").isNull(), F.col("refers_to")).otherwise(F.raise_error(F.lit("a revisit refers to no record")).cast(dict(d.dtypes)["refers_to"]))
    found = cut(d.select("page_id", "payload_bytes", digest.alias("payload_digest"), F.col("type").alias("record_type"), refers.alias("refers_to")))
    remove_folder(spark, folder)
    return found


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages),
digits AS (
  SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * i, 5))::BIGINT >> (15 - 5 * j)) & 31)::INT, 1), '' ORDER BY i, j) AS payload_digest
  FROM p, (SELECT range AS i FROM range(8)), (SELECT range AS j FROM range(4)) GROUP BY page_id)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN digits USING (page_id)
"""
