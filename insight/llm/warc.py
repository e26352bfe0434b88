"""WARC archives of pages: revisit records for repeated payloads, and their resolution.

Archives are text tables whose rows end as WARC records end, so Spark's own sink writes and
commits them in any store, and a lost executor's files are written again.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.llm.shared import columns, written

_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:x-page:"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hexadecimal: five digits are four characters."""
    characters = []
    for group in range(8):
        number = F.conv(F.substring(hexadecimal, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            five = F.shiftright(number, shift).bitwiseAND(F.lit(31))
            characters.append(F.substring(F.lit(_ALPHABET), five + 1, F.lit(1)))
    return F.concat(*characters)


def payload_digest(payload: Column) -> Column:
    """Bare base32 SHA-1 of a string in UTF-8."""
    return base32(F.sha1(F.encode(payload, "UTF-8")))


def find_originals(headers: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, payload_digest, refers_to`` of the headers that are revisits.

    Of headers with one ``payload_digest`` and ``payload_bytes`` of at least ``least``, the one
    with the smallest ``page_id`` is the response. Only headers are shuffled; the smallest id is
    found before the shuffle within each task, and only digests that occur twice are joined.
    """
    large = headers.where(F.col("payload_bytes") >= least)
    first = (
        large.groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where(F.col("refers_to") < F.col("last"))
        .drop("last")
    )
    return (
        large.join(first, "payload_digest")
        .where(F.col("page_id") > F.col("refers_to"))
        .select("page_id", "payload_digest", "refers_to")
        .distinct()
    )


def _record(date: str) -> Column:
    urn = F.concat(F.lit(f"<{_URN}"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        urn,
        F.lit(f">\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), uri), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.coalesce(
            F.concat(
                F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <{_URN}"),
                F.col("refers_to").cast("string"),
                F.lit(">"),
            ),
            F.lit(""),
        ),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(_END),
        block,
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    *,
    least: int = 0,
    archive_bytes: int = 32 << 20,
    date: str = "1970-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """Write one record per row to ``folder``: a response, or a revisit without its payload.

    A null payload is empty; a null url leaves the header out; line ends in a url are escaped.
    Rows with a null key are responses, as are all rows with the smallest key of their payload.
    An archive holds as many records as ``archive_bytes`` has mean ones, as one gzip stream by
    default. No rows give no records.
    """
    rows = columns(pages, page_id=key, url=url, payload=payload).select(
        F.col("page_id").cast("long"),
        "url",
        F.coalesce(F.col("payload").cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": payload_digest(F.col("payload")),
        }
    )
    headers = written(rows.select("page_id", "payload_digest", "payload_bytes"))
    mean = headers.agg(F.avg("payload_bytes")).first()[0] or 0
    # Written, so its size is known: payloads are shuffled only if it is too large to broadcast.
    revisits = written(find_originals(headers, least))
    records = rows.join(revisits, ["page_id", "payload_digest"], "left").select(
        _record(date).alias("value")
    )
    records.write.option("lineSep", _END).option("compression", compression).option(
        "maxRecordsPerFile", max(1, int(archive_bytes / (mean + 500)))
    ).text(folder)


def parse_archive(content: bytes):
    """Records of one archive: a dict of headers in lower case, and the block."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at, end = 0, _END.encode()
    while (at := content.find(b"WARC/", at)) >= 0:
        stop = content.index(end, at)
        headers = {}
        for line in content[at:stop].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode()
        begin = stop + len(end)
        at = begin + int(headers["content-length"])
        yield headers, content[begin:at]


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(_URN)
    return int(number) if number.lstrip("-").isdigit() else None


def read_archives(spark: SparkSession, folder: str, *, payloads: bool = False) -> DataFrame:
    """One row per record of the archives in ``folder``.

    ``page_id, url, record_type, payload_digest, payload_bytes, refers_to`` and, if asked for,
    ``payload`` (binary). The length is that of the payload found, null for revisits, and a
    digest that a response's payload does not have is an error. A task holds one archive.
    """

    def parse(batches):
        for batch in batches:
            out: dict[str, list] = {name: [] for name in kinds}
            for content in batch.column(0):
                for headers, block in parse_archive(content.as_py()):
                    kind = headers["warc-type"]
                    body = block.partition(_END.encode())[2] if kind == "response" else None
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if body is not None:
                        found = base64.b32encode(hashlib.sha1(body).digest()).decode()
                        if found != digest:
                            raise ValueError(f"{headers['warc-record-id']}: not its digest")
                    out["page_id"].append(_page(headers.get("warc-record-id")))
                    out["url"].append(headers.get("warc-target-uri"))
                    out["record_type"].append(kind)
                    out["payload_digest"].append(digest)
                    out["payload_bytes"].append(None if body is None else len(body))
                    out["refers_to"].append(_page(headers.get("warc-refers-to")))
                    if payloads:
                        out["payload"].append(body)
            yield pa.RecordBatch.from_pydict({n: pa.array(v, kinds[n]) for n, v in out.items()})

    kinds = {
        "page_id": pa.int64(),
        "url": pa.string(),
        "record_type": pa.string(),
        "payload_digest": pa.string(),
        "payload_bytes": pa.int64(),
        "refers_to": pa.int64(),
    } | ({"payload": pa.binary()} if payloads else {})
    schema = (
        "page_id long, url string, record_type string, payload_digest string, "
        "payload_bytes long, refers_to long" + ", payload binary" * payloads
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(parse, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with ``payload_bytes`` and ``refers_to`` of revisits from their responses.

    Headers are shuffled by payload digest; the response with the smallest id answers for it. A
    revisit whose response is in no archive keeps a null length and the reference it came with.
    """
    originals = (
        records.where(F.col("record_type") == "response")
        .groupBy("payload_digest")
        .agg(F.min(F.struct("page_id", "payload_bytes")).alias("original"))
    )
    revisits = records.where(F.col("record_type") == "revisit").join(
        originals, "payload_digest", "left"
    )
    resolved = revisits.withColumns(
        {
            "payload_bytes": F.col("original.payload_bytes"),
            "refers_to": F.coalesce("original.page_id", "refers_to"),
        }
    )
    return records.where(F.col("record_type") != "revisit").unionByName(
        resolved.select(*records.columns)
    )
