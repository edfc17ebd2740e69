"""WARC archives as chunked record tables: oversized payloads are rows of record and chunk number with running digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteframe.llm.common import pieces
from tasteframe.scratch import fresh_path, materialise

#: Bytes of payload in a chunk; payloads below LEAST bytes are never written as revisits.
CHUNK, LEAST = 64 << 10, 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"
SCHEMA = "record string, chunk int, last boolean, header binary, data binary, digest string"


def record_header(record: str, page_id: int | None, url: str | None, kind: str, length: int, digest: str, refers_to: str | None) -> bytes:
    """The WARC/1.1 header block of a record, with the empty line that ends it.

    The block of a response is the bare payload (Content-Type text/html); a revisit has an empty block and names the digest and
    the record that has the payload.
    """
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{record}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Length", str(length if kind == "response" else 0)),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if kind == "response":
        fields.append(("Content-Type", "text/html; charset=utf-8"))
    else:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + CRLF


def parse_header(block: bytes) -> dict[str, str]:
    """Field names in lower case to values; a block that is no WARC header is an error."""
    lines = block.decode().split("\r\n")
    if lines[0] != "WARC/1.1" or lines[-2:] != ["", ""]:
        raise ValueError("not a WARC header")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:-2])}


def record_bytes(rows: list[tuple[bytes | None, bytes | None, bool]]) -> bytes:
    """The WARC stream of (header, data, last) rows in order; as every archive's rows in order make one."""
    return b"".join((header or b"") + (data or b"") + (CRLF + CRLF if last else b"") for header, data, last in rows)


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload of LEAST bytes or more a smaller page_id has as well."""
    heads = pages.select("page_id", "payload").filter(F.octet_length("payload") >= LEAST).select("page_id", F.sha2("payload", 256).alias("digest"))
    first = heads.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    first = first.filter("n > 1 and refers_to is not null").drop("n")
    return heads.join(first, "digest").filter("page_id is null or page_id > refers_to").distinct()


def repeats(pages: DataFrame) -> DataFrame:
    """(page_id, digest) of the pages whose record name more than one row gives."""
    heads = pages.select("page_id", "url", F.sha2("payload", 256).alias("digest"))
    name = F.sha2(F.concat(F.coalesce("url", F.lit("None")), F.lit("\n"), "digest"), 256).alias("name")  # as in write_archives
    return heads.groupBy("page_id", "digest", name).count().filter("count > 1").select("page_id", "digest").distinct()


def write_archives(pages: DataFrame, path: str, chunk: int = CHUNK) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) as a chunked record table in Parquet at ``path``.

    Rows are (record, chunk, last, header, data, digest): the header stands in chunk 0, the payload (html in UTF-8, null:
    empty) in pieces of ``chunk`` bytes, ``digest`` is the SHA-256 of the payload up to and including the row. A reader or
    writer holds one piece, and a lost task starts again from the page. The rows of a record, in order, joined
    by ``record_bytes``, are its WARC record, and so the rows of an archive are a WARC file.

    Of records with equal payloads of LEAST bytes or more, that with the smallest page_id is the response, others are revisits.
    Rows that repeat page_id and payload of a response are responses too, as is a page without page_id and twin.
    Records of rows that repeat a page_id are told apart by a hash of url and payload, and those of rows that repeat all three by
    the task that writes them and a number, behind a dot. Responses are written first; a revisit then refers to the record of
    its payload that sorts first among those written for the page. Other columns are ignored. Eager: two writes.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    marks = revisits(rows).withColumn("repeated", F.lit(False)).unionByName(repeats(rows).withColumn("repeated", F.lit(True)), allowMissingColumns=True)
    marks = marks.groupBy(F.col("page_id").alias("p"), F.col("digest").alias("d")).agg(F.max("refers_to").alias("refers_to"), F.max("repeated").alias("repeated"))
    marks = materialise(marks, "marks")
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.sha2("payload", 256) == F.col("d"))
    responses = rows.join(marks, same, "left").filter("refers_to is null").select("page_id", "url", "payload", "repeated")

    def named(page_id: int | None, url: str | None, digest: str, number: str) -> str:
        return f"{'' if page_id is None else page_id}-{hashlib.sha256(f'{url}{chr(10)}{digest}'.encode()).hexdigest()[:16]}{number}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for b in pieces(batches):
            out: list[tuple] = []
            held = 0
            for i in range(b.num_rows):
                page_id, url = (b.column(c)[i].as_py() for c in range(2))
                payload = memoryview(b.column(2)[i].as_buffer())
                full = hashlib.sha256(payload).hexdigest()
                own = b.column(3)[i].as_py()
                record = named(page_id, url, full, f".{task}.{number}" if own else "")
                number += bool(own)
                header = record_header(record, page_id, url, "response", len(payload), full, None)
                so_far = hashlib.sha256()
                for n, at in enumerate(range(0, max(1, len(payload)), chunk)):
                    data = payload[at : at + chunk]
                    so_far.update(data)
                    out.append((record, n, at + chunk >= len(payload), header if n == 0 else None, bytes(data), so_far.hexdigest()))
                    held += len(data)
                    if held > 4 << 20:
                        yield _batch(out)
                        out, held = [], 0
            if out:
                yield _batch(out)

    responses.mapInArrow(run, SCHEMA).write.parquet(path)

    def refer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for b in batches:
            out = []
            for page_id, url, digest, own, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                record = named(page_id, url, digest, f".{task}r.{number}" if own else "")
                number += bool(own)
                out.append((record, 0, True, record_header(record, page_id, url, "revisit", 0, digest, refers_to), None, digest))
            if out:
                yield _batch(out)

    written = pages.sparkSession.read.schema(SCHEMA).parquet(path).filter("last").select(_page_of("record").alias("of"), F.col("digest").alias("of_digest"), "record")
    asked = marks.select(F.col("refers_to").alias("r"), F.col("d").alias("rd")).filter("r is not null").distinct()
    written = written.join(asked, (F.col("of") == F.col("r")) & (F.col("of_digest") == F.col("rd")), "semi")
    first = written.groupBy("of", "of_digest").agg(F.min("record").alias("name"))
    again = rows.select("page_id", "url", F.sha2("payload", 256).alias("digest"))
    again = again.join(marks.filter("refers_to is not null"), F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")))
    again = again.join(first, (F.col("refers_to") == F.col("of")) & (F.col("digest") == F.col("of_digest")))
    again.select("page_id", "url", "digest", "repeated", "name").mapInArrow(refer, SCHEMA).write.mode("append").parquet(path)


def _page_of(record: str) -> Column:
    """The page_id in a record's name; null if it has none."""
    return F.nullif(F.regexp_extract(record, "^(-?[0-9]*)-", 1), F.lit("")).cast("long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.string()]
    names = ["record", "chunk", "last", "header", "data", "digest"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_archives(archive: DataFrame) -> DataFrame:
    """(record, page_id, record_type, payload_bytes, payload_digest, refers_to) of a chunked record table, verified.

    Records of one chunk are read where they lie. Chunks of longer ones are dealt by record, sorted, and streamed through a
    running SHA-256, chunk by chunk. A missing or doubled chunk, a wrong length or digest is an error. For a revisit
    ``refers_to`` is the name of another record, the digest is the header's and the length null, until ``resolve`` follows it.
    """
    schema = "record string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to string"
    names = ["record", "chunk", "last", "header", "data", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, fields, size, so_far, was = None, {}, 0, None, -1
        out: list[tuple] = []
        for b in pieces(batches):
            for record, chunk, last, header, data, digest in zip(*(b.column(b.schema.names.index(c)).to_pylist() for c in names), strict=True):
                if chunk == 0 and (was == -1):
                    now, fields, size, so_far = record, parse_header(header), 0, hashlib.sha256()
                elif record != now or chunk != was + 1:
                    raise ValueError(f"record {record}: chunk {chunk} stands after chunk {was} of {now}")
                was = chunk
                size += len(data or b"")
                so_far.update(data or b"")
                kind = fields["warc-type"]
                if kind != "revisit" and so_far.hexdigest() != digest:
                    raise ValueError(f"record {record}: the digest of chunk {chunk} is wrong")
                if last:
                    named = fields["warc-payload-digest"].removeprefix("sha256:")
                    if size != int(fields["content-length"]) or kind != "revisit" and so_far.hexdigest() != named:
                        raise ValueError(f"record {record}: length or digest differ from the header")
                    page_id = int(fields["x-page-id"]) if fields["x-page-id"] else None
                    if kind == "revisit":
                        out.append((record, page_id, "revisit", None, named, fields["warc-refers-to"][len("<urn:page:") : -1]))
                    else:
                        out.append((record, page_id, "response", size, named, None))
                    was = -1
            if out:
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["record", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"],
                )
                out = []
        if was != -1:
            raise ValueError(f"record {now} has no last chunk")

    short = archive.filter("chunk = 0 and last").mapInArrow(run, schema)
    n = int(archive.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = archive.filter("not (chunk = 0 and last)").select(names)
    long = long.repartition(n, "record").sortWithinPartitions("record", "chunk").mapInArrow(run, schema)
    return short.union(long)


def resolve(records: DataFrame) -> DataFrame:
    """``records`` of ``read_archives``, revisits with the page and the length of the record that they refer to; one that is
    not there, or has another digest, is an error."""
    responses, again = records.filter("record_type = 'response'"), records.filter("record_type = 'revisit'")
    full = responses.select(F.col("record").alias("name"), F.col("page_id").alias("of_page"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("of_response"))
    again = again.join(full, F.col("refers_to") == F.col("name"), "left")
    whole = F.when(F.col("d") == F.col("payload_digest"), F.col("of_response")).otherwise(F.raise_error(F.concat(F.lit("no payload for record "), "record")).cast("long"))
    again = again.select("record", "page_id", "record_type", whole.alias("payload_bytes"), "payload_digest", F.col("of_page").alias("refers_to"))
    return responses.withColumn("refers_to", F.col("refers_to").cast("long")).union(again)


def round_trip(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, record) of ``pages``, written and read again, a row per row.

    ``record`` is the name without the numbers that tell repeated rows apart: they differ from run to run.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "archives")
    write_archives(pages, path, chunk)
    read = resolve(materialise(read_archives(spark.read.parquet(path)), "records"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.substring_index("record", ".", 1).alias("record"))


ORACLE = """
WITH heads AS (
    SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest AS digest, min(page_id) AS refers_to FROM heads WHERE payload_bytes >= 100 GROUP BY 1),
typed AS (
    SELECT h.*, CASE WHEN page_id > f.refers_to OR page_id IS NULL THEN f.refers_to END AS refers_to
    FROM heads h LEFT JOIN firsts f ON h.payload_digest = f.digest AND payload_bytes >= 100)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
       coalesce(CAST(page_id AS VARCHAR), '') || '-' || substr(sha256(coalesce(url, 'None') || chr(10) || payload_digest), 1, 16) AS record
FROM typed
"""
