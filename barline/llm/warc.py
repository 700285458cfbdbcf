"""WARC archives: writing captures, reading them back, and assembling transactions.

A capture is a response (or revisit), a request and a metadata record; the last two name
the first through ``WARC-Concurrent-To``. Spark's text writer puts the records into
archive files: a record ends with two line ends, which is the line separator here, so a
file is a plain WARC stream (compressed as a whole). Reading takes a file per row, walks
its records by ``Content-Length`` and joins them into one nested row per capture.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import lookup, with_rows
from barline.plans import drop_landed, land, landed
from barline.plans.landing import new_path

SMALLEST_REVISIT = 100
# Bytes of a capture (payload and three times its URL) up to a limit, and how many of those captures
# share a file: a file holds 32 MiB, 64 MiB, or one larger capture. As a file is read whole,
# this bounds a task.
SIZES = ((64 << 10, 512), (2 << 20, 32), (None, 1))
END = "\r\n"
DATE = "2024-01-01T00:00:00Z"


def captures(pages: DataFrame, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """Pages with digest, payload size and what they revisit.

    Of equal payloads of at least ``smallest`` bytes the one with the smallest page_id is
    the response; of rows that repeat that page_id, the first. A null page_id is larger
    than all others.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = land(
        with_rows(pages).select(
            "_row",
            "_run",
            F.col("page_id").cast("bigint").alias("_id"),
            F.coalesce(F.col("url").cast("string"), F.lit("")).alias("_url"),
            html.alias("_html"),
            F.octet_length(html).cast("bigint").alias("_bytes"),
            F.sha2(html, 256).alias("_digest"),
        ),
        "captures",
        compression="zstd",
    )
    rank = F.coalesce(F.col("_id"), F.lit(2**63 - 1))
    first = (
        rows.where(F.col("_bytes") >= smallest)
        .groupBy("_digest")
        .agg(
            F.min_by("_row", rank).alias("_first"),
            F.min("_id").alias("_first_id"),
            F.count(F.lit(1)).alias("_n"),
        )
        .where("_n > 1")
    )
    narrow = rows.select("_row", "_run", "_digest", "_bytes").where(F.col("_bytes") >= smallest)
    # Every write of archives reads it; landed, it is worked out once and has a known size.
    revisits = land(
        lookup(narrow, first, ["_digest"])
        .where(F.col("_row") != F.col("_first"))
        .select("_row", F.col("_first").alias("_of"), F.col("_first_id").alias("_of_id")),
        "revisits",
    )
    return rows.join(revisits, "_row", "left")


def _lines(*fields: tuple[str, Column | str] | None) -> Column:
    """Header lines; a field with a null value is left out."""
    out = []
    for name, value in fields:
        value = F.lit(value) if isinstance(value, str) else value
        out.append(
            F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))
        )
    return F.concat(F.lit("WARC/1.1" + END), *out, F.lit(END))


def _record_id(row: Column, kind: str) -> Column:
    return F.concat(F.lit("<urn:capture:"), row.cast("string"), F.lit(f":{kind}>"))


def records(found: DataFrame) -> DataFrame:
    """The three records of every capture as text, each without its final line ends."""
    revisit = F.col("_of").isNotNull()
    # A URL is a header value here: line ends would start a new header.
    url = F.regexp_replace("_url", "[\\r\\n]", "")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + END + "Content-Type: text/html; charset=utf-8" + END),
        F.lit("Content-Length: "),
        F.col("_bytes").cast("string"),
        F.lit(END + END),
    )
    payload = F.when(revisit, F.lit("")).otherwise(F.col("_html"))
    main_block = F.concat(http, payload)
    request_block = F.concat(
        F.lit("GET "), url, F.lit(" HTTP/1.1" + END + "Accept: text/html" + END + END)
    )
    metadata_block = F.concat(
        F.lit("pageId: "),
        F.coalesce(F.col("_id").cast("string"), F.lit("")),
        F.lit(END + "payloadBytes: "),
        F.col("_bytes").cast("string"),
        F.coalesce(F.concat(F.lit(END + "revisitOf: "), F.col("_of_id").cast("string")), F.lit("")),
        F.lit(END),
    )
    main_id = _record_id(F.col("_row"), "response")
    common = (("WARC-Target-URI", F.nullif(url, F.lit(""))), ("WARC-Date", DATE))
    main = F.concat(
        _lines(
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", main_id),
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
            ("WARC-Refers-To", _record_id(F.col("_of"), "response")),
            (
                "WARC-Profile",
                F.when(
                    revisit,
                    F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ),
            ),
            ("Content-Type", "application/http;msgtype=response"),
            ("Content-Length", F.octet_length(main_block)),
        ),
        main_block,
    )

    def beside(kind: str, content: str, block: Column) -> Column:
        return F.concat(
            _lines(
                ("WARC-Type", kind),
                ("WARC-Record-ID", _record_id(F.col("_row"), kind)),
                ("WARC-Concurrent-To", main_id),
                *common,
                ("Content-Type", content),
                ("Content-Length", F.octet_length(block)),
            ),
            block,
        )

    return found.select(
        F.explode(
            F.array(
                main,
                beside("request", "application/http;msgtype=request", request_block),
                beside("metadata", "application/warc-fields", metadata_block),
            )
        ).alias("value")
    )


def write_archives(
    found: DataFrame, path: str, sizes: Sequence[tuple[int | None, int]] = SIZES
) -> None:
    """Write the captures of ``captures()`` as gzipped WARC files under ``path``.

    ``sizes`` are (bytes of a capture at most, captures in a file) from small to large,
    the last without a limit. Captures of each class of size get files of their own;
    revisits, which have no payload, too.

    A class goes by columns of the page alone, so its rows are chosen before they are
    joined with what they revisit: a payload is shuffled at most once, however many
    classes there are. The writes of revisits read no payloads.
    """
    url = F.lit(3) * F.octet_length("_url")
    revisit = F.col("_of").isNotNull()

    def class_of(size: Column) -> Column:
        found_in = F.lit(len(sizes) - 1)
        for i in range(len(sizes) - 2, -1, -1):
            found_in = F.when(size <= sizes[i][0], i).otherwise(found_in)
        return found_in

    kinds = {
        False: (found.where(~revisit), class_of(F.col("_bytes") + url)),
        True: (found.where(revisit).withColumn("_html", F.lit("")), class_of(url)),
    }
    occurring = [
        (kind, i)
        for kind, (rows, its_class) in kinds.items()
        for (i,) in sorted(rows.select(its_class).distinct().collect())
    ]
    for n, (kind, i) in enumerate(occurring or [(False, 0)]):
        rows, its_class = kinds[kind]
        (
            records(rows.where(its_class == i))
            .write.option("lineSep", END + END)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", 3 * sizes[i][1])
            .mode("append" if n else "errorifexists")
            .text(path)
        )


def parse_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of one archive, compressed or not."""
    stream = io.BytesIO(raw)
    if raw[:2] == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    with io.BufferedReader(stream, 1 << 16) as lines:
        while line := lines.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            headers = {}
            while (line := lines.readline()).strip():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                headers[name.strip().lower()] = value.strip()
            yield headers, lines.read(int(headers["content-length"]))


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["type", "record_id", "concurrent_to", "refers_to", "uri", "digest", "http", "block"]
    for batch in batches:
        for raw in batch["content"]:
            rows = []
            for headers, block in parse_records(raw):
                kind = headers.get("warc-type")
                http = None
                if "msgtype=response" in headers.get("content-type", ""):
                    http, _, block = block.partition(b"\r\n\r\n")
                    http = http.decode("utf-8", "replace")
                rows.append(
                    (
                        kind,
                        headers.get("warc-record-id"),
                        headers.get("warc-concurrent-to"),
                        headers.get("warc-refers-to"),
                        headers.get("warc-target-uri"),
                        headers.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                        http,
                        block,
                    )
                )
            if rows:
                yield pd.DataFrame(rows, columns=names)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, one row each; block as bytes."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(
        _parsed,
        "type string, record_id string, concurrent_to string, refers_to string, uri string, "
        "digest string, http string, block binary",
    )


def field(text: Column, name: str) -> Column:
    """The value of a ``name: value`` line, null if there is none."""
    return F.nullif(F.regexp_extract(text, rf"(?:^|\n){name}: ([^\r\n]*)", 1), F.lit(""))


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: its identifier, response, request and metadata.

    Requests and metadata join the response or revisit they name; a record that names
    none makes a capture of its own, and a missing record is null.
    """
    capture = F.coalesce("concurrent_to", "record_id")
    record = F.struct("type", "record_id", "refers_to", "uri", "digest", "http", "block")
    main = F.col("type").isin("response", "revisit")
    one = lambda condition: F.first(F.when(condition, record), ignorenulls=True)
    return found.groupBy(capture.alias("capture")).agg(
        one(main).alias("response"),
        one(F.col("type") == "request").alias("request"),
        one(F.col("type") == "metadata").alias("metadata"),
    )


def archived(
    pages: DataFrame,
    smallest: int = SMALLEST_REVISIT,
    sizes: Sequence[tuple[int | None, int]] = SIZES,
) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back, one row per page:
    page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload and a null url an empty one. A null page_id is larger
    than all others; a revisit of such a page has a null refers_to. Repeated rows are
    captures of their own. An empty table gives an empty result. The payload and its
    digest are checked against each other as they are read; a difference is an error.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    before = set(landed(spark))
    write_archives(captures(pages, smallest), path, sizes)
    # The archives hold everything from here on.
    drop_landed(spark, [p for p in landed(spark) if p not in before])
    found = read_records(spark, path).withColumns(
        {
            "sha256": F.sha2("block", 256),
            "block": F.when(F.col("type").isin("request", "metadata"), F.col("block")),
        }
    ).withColumn(
        "digest",
        F.when(
            (F.col("type") == "response") & (F.col("sha256") != F.col("digest")),
            F.raise_error(F.concat(F.lit("payload and digest differ in "), F.col("record_id"))),
        ).otherwise(F.col("digest")),
    )
    meta = F.col("metadata.block").cast("string")
    return assemble(found).select(
        field(meta, "pageId").cast("bigint").alias("page_id"),
        field(F.col("response.http"), "Content-Length").cast("bigint").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        field(meta, "revisitOf").cast("bigint").alias("refers_to"),
    )


ORACLE = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS bytes,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM rows
"""
