"""Deduplicated WARC archives with revisit resolution.

Headers (page, URL, digest, length) are shuffled by payload digest.  Of the
records with equal payloads the one with the largest page_id becomes the
`response` and keeps its payload, every other one a `revisit` that refers to
it.  Records are written by Spark's text writer, whose line separator is the
blank line that ends a WARC record, so the files are plain gzipped WARC,
committed task by task to whatever file system the path names.

Reading back streams the archives through the same separator and rebuilds the
byte stream, so a record is found by its Content-Length alone, whatever blank
lines its payload has.  A reader holds one record, not a file.

Only the payload rows move (once, to meet the response headers); revisits and
the group of copies of a payload are headers.

Edge cases.  A very long payload is one record, held whole in a task.  Of copies
that tie in page_id the one with the greatest url is the response.  An empty table
gives archives without records, and reading those gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash128

END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 20_000


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of SHA-1: 160 bits are four runs of ten hex digits,
    each eight symbols of five bits."""
    digest = F.sha1(data)
    symbols = []
    for run in range(4):
        bits = F.conv(F.substring(digest, run * 10 + 1, 10), 16, 10).cast("long")
        symbols += [F.substring(F.lit(BASE32), F.shiftright(bits, 35 - 5 * k).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))
                    for k in range(8)]
    return F.concat(*symbols)


def _one_line(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00-\x1F\x7F]", " ")


def _record_id(digest: Column, page: Column, url: Column, copy: Column) -> Column:
    """A urn:uuid made from the record's content, so a re-run writes the same."""
    h = F.md5(F.concat_ws("\x01", digest, F.coalesce(page.cast("string"), F.lit("null")),
                          F.when(url.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), url)), copy.cast("string")))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut]), F.lit(">"))


def _header(kind: str, length: Column, *more: Column) -> Column:
    """Fresh header lines; the values are free of control characters."""
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), F.col("record_id"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), _one_line(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(F.col("page_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("\r\nX-Page-Id: "), F.col("page_id").cast("string"))),
        *more, F.lit("\r\nContent-Length: "), length.cast("string"), F.lit(END))


def archive_records(pages: DataFrame, scratch, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """One row per input row: record, the text of its WARC record.

    The payload is the html in UTF-8, NULL counts as empty.  Payloads are equal
    when length, SHA-1 and SHA-256 are.  Payloads shorter than min_bytes are
    all responses.  A NULL page_id comes last among copies; of rows that repeat
    in full one is the response.  Other columns are not read.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"),
                        base32_sha1(html.cast("binary")).alias("digest"), F.sha2(html, 256).alias("sha256"),
                        F.octet_length(html).alias("bytes"))
    same = ["digest", "sha256", "bytes"]
    heads = scratch.table(rows.groupBy(*same, "page_id", "url").agg(F.count("*").alias("copies")), "headers")
    first = scratch.table(heads.where(F.col("bytes") >= min_bytes).groupBy(*same).agg(
        F.max(F.struct("page_id", "url")).alias("o")).select(*same, F.col("o.page_id").alias("o_page"), F.col("o.url").alias("o_url")), "originals")
    mine = F.col("page_id").eqNullSafe(F.col("o_page")) & F.col("url").eqNullSafe(F.col("o_url"))
    one = F.lit(0)

    # the payloads of responses: each row meets its own original.  The key has no
    # NULLs, so one exchange of the payloads serves the join and the distinct
    whole = [*same, "k1", "k2"]
    named = lambda df, page, url: df.withColumns(dict(zip(("k1", "k2"), hash128(F.col(page), F.col(url)))))
    keyed = named(first, "o_page", "o_url").select(*whole)
    found = named(rows, "page_id", "url").join(keyed.hint("merge"), whole).dropDuplicates(whole).drop("k1", "k2")
    found = found.withColumn("record_id", _record_id(F.col("digest"), F.col("page_id"), F.col("url"), one))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    content = F.lit("\r\nContent-Type: application/http; msgtype=response")
    response = F.concat(_header("response", F.octet_length(http) + F.col("bytes"), content), http, F.col("html"))
    out = found.select(response.alias("record"))
    if min_bytes > 0:  # short payloads are never deduplicated
        short = rows.where(F.col("bytes") < min_bytes)
        short = short.withColumn("record_id", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))
        out = out.unionByName(short.select(response.alias("record")))

    # the revisits are headers only
    again = heads.join(first, same).withColumn("n", F.col("copies") - mine.cast("long")).where("n > 0")
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    again = again.withColumns({
        "record_id": _record_id(F.col("digest"), F.col("page_id"), F.col("url"), F.col("copy")),
        "refers": _record_id(F.col("digest"), F.col("o_page"), F.col("o_url"), one)})
    refers = F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
                            "WARC-Refers-To: "), F.col("refers"),
                      F.lit("\r\nWARC-Refers-To-Target-URI: "), _one_line(F.col("o_url")))
    return out.unionByName(again.select(_header("revisit", F.lit(0), refers).alias("record")))


def write_archives(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    (records.write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rebuilds each file's bytes from its pieces and reads record by record."""
    end = END.encode()
    names = ["record_type", "record_id", "refers_to_id", "page_id", "uri", "digest", "payload_bytes", "payload_digest"]
    kinds = [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 2 + [pa.int64(), pa.string()]
    parts: list[bytes] = []  # bytes not used yet; pieces and the blank lines between them
    held, want, file, fields = 0, None, None, {}

    def row(body: bytes) -> tuple:
        payload = body.partition(end)[2] if fields["WARC-Type"] == "response" else b""
        page = fields.get("X-Page-Id")
        return (fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), None if page is None else int(page),
                fields.get("WARC-Target-URI"), fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())

    def close() -> None:
        if want is not None or b"".join(parts) not in (b"", end):
            raise ValueError(f"{file} ends inside a record")

    # a batch may hold 64 MB: some rows at a time
    for batch in (b.slice(low, 128) for b in batches for low in range(0, b.num_rows, 128)):
        rows: list[tuple] = []
        for piece, name in zip(batch.column("value").to_pylist(), batch.column("file").to_pylist()):
            if name != file:
                close()
                parts, held, file = [], 0, name
            data = piece.encode()
            parts += [data, end]
            held += len(data) + len(end)
            while held:
                if want is None:
                    stream = b"".join(parts)
                    if stream == end:  # the reader cut the file's last blank line in two
                        break
                    head, _, rest = stream.partition(end)
                    lines = head.decode().split("\r\n")
                    if not lines[0].startswith("WARC/"):
                        raise ValueError(f"no WARC header in {file}: {lines[0][:60]!r}")
                    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(": "), "") for line in lines[1:])
                    want, parts, held = int(fields["Content-Length"]), [rest], len(rest)
                if held < want + len(end):
                    break
                stream = b"".join(parts)
                if stream[want:want + len(end)] != end:
                    raise ValueError(f"a record of {file} does not end where its length says")
                rows.append(row(stream[:want]))
                rest = stream[want + len(end):]
                want, parts, held = None, [rest], len(rest)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        pa.default_memory_pool().release_unused()
    close()


def read_archives(spark, path: str) -> DataFrame:
    """A row per record: record_type, record_id, refers_to_id, page_id, uri,
    digest (as the header has it), payload_bytes and payload_digest (of the
    bytes read; a revisit has none)."""
    lines = spark.read.option("lineSep", END).text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.mapInArrow(_parse, "record_type string, record_id string, refers_to_id string, page_id long, uri string, "
                                    "digest string, payload_bytes long, payload_digest string")


def resolve_revisits(read: DataFrame) -> DataFrame:
    """page_id, uri, payload_bytes, payload_digest, record_type, refers_to:
    revisits take payload facts and page from the response they refer to."""
    first = read.where("record_type = 'response'")
    original = first.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
                            F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
    revisit = read.where("record_type = 'revisit'").join(original, "refers_to_id", "left")
    columns = ["page_id", "uri"]
    return first.select(*columns, "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisit.select(*columns, F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type", "refers_to"))
