"""WARC archives of fetched pages: writing, reading, and one nested row per capture.

A page becomes three records (request, response or revisit, metadata); request
and metadata name the response in ``WARC-Concurrent-To``. Archives are written
by Spark's text sink, whose line separator is a record's last byte, so they go
to any file system that Spark writes to, gzip-compressed, with a bounded number
of records in each. Reading cuts records by their ``Content-Length`` and joins
each transaction through its concurrent-to identifier.
"""

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toolpulse.llm.common import salted_join

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEWLINE = "\r\n"

MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 1500
DATE = "1970-01-01T00:00:00Z"
KEY = ["page_key", "digest"]


def _record(kind: Column, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record as text, without its last byte, which the sink adds. Null headers are left out."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(DATE)), *headers]
    fields.append(("Content-Length", F.octet_length(block).cast("string")))
    head = F.concat_ws(NEWLINE, F.lit(VERSION), *[F.concat(F.lit(f"{name}: "), value) for name, value in fields])
    return F.concat(head, F.lit(NEWLINE * 2), block, F.lit(NEWLINE + "\r"))


def _one_line(text: Column) -> Column:
    return F.regexp_replace(text, r"[\r\n]", "%0A")


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Archives of (page_id, url, html) below ``path``.

    Equal payloads of at least ``min_revisit_bytes`` bytes: the rows with the
    smallest page_id are responses, others revisit the first of them. A null
    page_id is never referred to unless all are null, and then all are
    responses. A null html is an empty payload; a null url leaves the target
    header out, line ends in a url become %0A. Repeated rows are captures of their own.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumns(
        {
            "page_key": F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
            "digest": F.sha2("html", 256),
            "size": F.octet_length("html"),
        }
    )
    sized = rows.where(F.col("size") >= min_revisit_bytes)
    first = sized.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1 AND first IS NOT NULL").select("digest", "first")
    revisits = salted_join(sized.select("page_id", *KEY), first, ["digest"], F.col("page_key"), "inner")
    revisits = revisits.where(~F.col("page_id").eqNullSafe(F.col("first"))).select(*KEY, "first").distinct()
    # Rows and their copies meet in one shuffle of the payloads, by page.
    rows = rows.join(revisits, KEY, "left")
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy(*KEY).orderBy("url")))
    name = F.concat(F.lit("urn:page:"), "page_key", F.lit(":"), "digest", F.lit(":"), F.col("copy").cast("string"))
    ids = {k: F.concat(F.lit("<"), name, F.lit(f":{k}>")) for k in ("request", "response", "metadata")}
    target = ("WARC-Target-URI", _one_line(F.col("url")))
    concurrent = ("WARC-Concurrent-To", ids["response"])
    referred = F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(":"), "digest", F.lit(":1:response>"))
    revisit = F.col("first").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(NEWLINE * 2),
    )
    request = F.concat(F.lit("GET "), F.coalesce(_one_line(F.col("url")), F.lit("/")), F.lit(" HTTP/1.1" + NEWLINE * 2))
    page = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(NEWLINE)), F.lit(""))
    records = [
        _record(F.lit("request"), ids["request"], [concurrent, target], request),
        _record(
            F.when(revisit, "revisit").otherwise("response"),
            ids["response"],
            [
                target,
                ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
                ("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
                ("WARC-Refers-To", F.when(revisit, referred)),
            ],
            F.when(revisit, http).otherwise(F.concat(http, "html")),
        ),
        _record(F.lit("metadata"), ids["metadata"], [concurrent], page),
    ]
    sink = rows.select(F.explode(F.array(*records)).alias("value")).write.option("lineSep", "\n")
    sink.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of one uncompressed archive; header names in lower case."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = end + 4
        stop = start + int(headers["content-length"])
        yield headers, data[start:stop]
        at = stop + 4


def _unzip(data: bytes) -> bytes:
    """All members of a gzip file; other data as it is."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out) + data


def _http_body(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


FIELDS = [
    ("record_id", "warc-record-id"),
    ("kind", "warc-type"),
    ("concurrent_to", "warc-concurrent-to"),
    ("refers_to", "warc-refers-to"),
    ("target_uri", "warc-target-uri"),
    ("stated_digest", "warc-payload-digest"),
]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: header fields and ``block`` (of responses the HTTP body)."""

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in parse_records(_unzip(content.as_py())):
                    kind = headers["warc-type"]
                    block = _http_body(block) if kind in ("response", "revisit") else block
                    rows.append((*(headers.get(h) for _, h in FIELDS), block))
                    held += len(block)
                    if held > 8_000_000:
                        yield _records_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _records_batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    schema = ", ".join(f"{name} string" for name, _ in FIELDS) + ", block binary"
    return files.select("content").mapInArrow(parse, schema)


def _records_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * len(FIELDS) + [pa.binary()]
    names = [name for name, _ in FIELDS] + ["block"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``request``, ``metadata``.

    Request and metadata are joined to the response or revisit that they are
    concurrent to, and are null where the archive lacks them. A response's
    digest and size are taken from the payload itself.
    """
    kept = records.where(F.col("kind").isin("response", "revisit"))
    stored = F.col("kind") == "response"
    responses = kept.select(
        F.col("record_id").alias("capture_id"),
        F.struct(
            F.col("kind").alias("record_type"),
            "refers_to",
            "target_uri",
            "stated_digest",
            F.when(stored, F.col("block")).alias("payload"),
            F.when(stored, F.octet_length("block").cast("long")).alias("payload_bytes"),
            F.when(stored, F.sha2("block", 256)).alias("payload_digest"),
        ).alias("response"),
    )
    text = F.decode("block", "UTF-8")
    request = records.where("kind = 'request'").select(
        F.col("concurrent_to").alias("capture_id"),
        F.struct("record_id", F.regexp_extract(text, r"^(\S+)", 1).alias("method"), "target_uri").alias("request"),
    )
    page = F.regexp_extract(text, r"(?m)^page-id: (-?\d+)", 1)
    metadata = records.where("kind = 'metadata'").select(
        F.col("concurrent_to").alias("capture_id"),
        F.struct("record_id", F.when(page != "", page.cast("long")).alias("page_id")).alias("metadata"),
    )
    return responses.join(request, "capture_id", "left").join(metadata, "capture_id", "left")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Adds ``payload_bytes``, ``payload_digest`` and ``refers_to`` (a page) of every capture.

    A revisit takes them from the response that it refers to; they are null if
    the archives lack it or if its digest is not the one that the revisit states.
    """
    plain = captures.select(
        F.col("metadata.page_id").alias("page_id"),
        "capture_id",
        F.col("response.record_type").alias("record_type"),
        F.col("response.refers_to").alias("referred"),
        F.col("response.stated_digest").alias("stated"),
        F.col("response.payload_bytes").alias("own_bytes"),
        F.col("response.payload_digest").alias("own_digest"),
    )
    sources = plain.where("record_type = 'response'").select(
        F.col("capture_id").alias("referred"),
        F.col("page_id").alias("source_page"),
        F.col("own_bytes").alias("source_bytes"),
        F.col("own_digest").alias("source_digest"),
    )
    wanted = plain.where("record_type = 'revisit'").select("referred").distinct()
    found = salted_join(plain, sources.join(wanted, "referred"), ["referred"], F.col("capture_id"))
    valid = F.concat(F.lit("sha256:"), "source_digest") == F.col("stated")
    return found.select(
        "page_id",
        F.coalesce("own_bytes", F.when(valid, F.col("source_bytes"))).alias("payload_bytes"),
        F.coalesce("own_digest", F.when(valid, F.col("source_digest"))).alias("payload_digest"),
        "record_type",
        F.when(valid, F.col("source_page")).alias("refers_to"),
    )


def round_trip_sql(min_revisit_bytes: int = MIN_REVISIT_BYTES) -> str:
    """What reading back must give, in DuckDB SQL over ``pages`` with unique ids."""
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
      d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
      f AS (SELECT *, CASE WHEN payload_bytes >= {min_revisit_bytes}
        THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
      SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""
