"""WARC archives: write with an index, read selected records by coalesced byte ranges.

Equal payloads are stored once: the record of the smallest page id is the response, the others
revisit it. Each task writes its records, one gzip member each, to archives of bounded size in a
folder that all executors share and returns index rows: archive, offset, length, URL and digest of
each record. An archive's name is new in every attempt, so a task that runs again never touches
the files that index rows of another attempt point to. A reader sorts the index rows it wants,
merges ranges that lie close together and reads each merged range once.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import ship
from tierweave.session import shared_folder, stored

ship(__name__)

#: Between two records (fixed value of the format).
SEPARATOR = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Size of an archive, about.
ARCHIVE_BYTES = 64 << 20
#: Ranges closer than this are read at once, up to so many bytes.
CLOSE_BYTES = 64 << 10
READ_BYTES = 8 << 20


def base32(hex40: Column) -> Column:
    """Base32 of a SHA-1 given in hexadecimal: 5 hexadecimal digits are 4 letters."""
    def letters(i: Column) -> Column:
        n = F.conv(F.substring(hex40, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[
            F.substring(F.lit(ALPHABET), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)
        ])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def record_head(row_url: str = "url") -> Column:
    """A record up to its payload. The reader finds all it returns in these fields."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    response = F.col("record_type") == "response"
    block = F.octet_length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)
    url = F.regexp_replace(row_url, "[\\x00-\\x1F]", "")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: <urn:"),
        # a page without an id is named by its row
        F.coalesce(F.concat(F.lit("x-page:"), F.col("page_id").cast("string")), F.concat(F.lit("x-row:"), F.hex("_row"))), F.lit(">"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(response, F.lit("")).otherwise(F.concat(
            F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:x-page:"),
            F.col("refers_to").cast("string"), F.lit(">"),
        )),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block.cast("string"), F.lit("\r\n\r\n"), http,
    )


def uri(folder: str) -> str:
    """Spark writes local folders as ``file:/...`` or as plain paths."""
    return re.sub("^file:/+", "file:///", folder if "://" in folder or folder.startswith("file:") else f"file:{folder}")


def write_archives(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
) -> tuple[str, DataFrame]:
    """Write all pages; returns the folder and the index.

    Index: page_id, url, payload_digest, payload_bytes, record_type, refers_to, archive, offset,
    length. A NULL html is an empty payload, a NULL url has no field. Payloads under ``min_bytes`` are all responses.
    Repeated rows (same id and payload) are all of the kind of the first. A page without an id revisits
    the smallest id of its payload, and is a response where no page of that payload has one. Other
    columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    html = F.coalesce("html", F.lit(""))
    key = F.xxhash64("page_id", F.coalesce("url", F.lit("")), F.col("url").isNull(), "_sha")
    whole = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(html).alias("_sha"),
    ).withColumn("_row", key)
    slim = stored(whole.select("page_id", "url", "_sha", "payload_bytes", "_row"))
    firsts = stored(slim.filter(F.col("payload_bytes") >= min_bytes).groupBy("_sha").agg(F.min("page_id").alias("_first")))
    typed = slim.join(firsts, "_sha", "left").select(
        "page_id", "url", "payload_bytes", "_row", base32(F.col("_sha")).alias("payload_digest"),
        F.when(F.coalesce(F.col("_first") < F.col("page_id"), F.lit(True)), F.col("_first")).alias("refers_to"),
    ).withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")).withColumn("head", record_head())
    heads = typed.select("head", "record_type", "refers_to", "payload_digest", F.col("page_id").alias("_page"), F.col("_row").alias("_key")).distinct()
    response = F.col("record_type") == "response"
    records = whole.join(  # equal rows have equal records, so one head serves all of them
        heads.hint("shuffle_hash"), whole["page_id"].eqNullSafe(heads["_page"]) & (whole["_row"] == heads["_key"]),
    ).select(
        # as text: pandas would make doubles of a column of longs with NULLs
        F.col("page_id").cast("string").alias("page_id"), "url", "payload_digest", "payload_bytes", "record_type",
        F.col("refers_to").cast("string").alias("refers_to"),
        F.when(response, F.concat("head", "html")).otherwise(F.col("head")).alias("record"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(uri(folder))
        system.create_dir(place, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            spots = []
            for record in batch.pop("record"):
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{place}/{name}", compression=None)
                member = zlib.compressobj(wbits=31)
                raw = member.compress((record + SEPARATOR).encode("utf-8", "surrogatepass")) + member.flush()
                out.write(raw)
                spots.append((name, at, len(raw)))
                at += len(raw)
            batch["archive"], batch["offset"], batch["length"] = zip(*spots, strict=True) if spots else ([], [], [])
            yield batch
        if out is not None:
            out.close()

    index = stored(records.mapInPandas(
        write, "page_id string, url string, payload_digest string, payload_bytes long, record_type string, refers_to string, "
        "archive string, offset long, length long",
    ).withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")}))
    return folder, index


def _ranges(rows: pd.DataFrame) -> Iterator[tuple[str, int, int, list]]:
    """Merged ranges of rows sorted by archive and offset: archive, begin, end, rows."""
    held, path, begin, end = [], None, 0, 0
    for row in rows.itertuples(index=False):
        last = row.offset + row.length
        if held and row.archive == path and row.offset - end <= CLOSE_BYTES and last - begin <= READ_BYTES:
            held.append(row)
            end = max(end, last)
            continue
        if held:
            yield path, begin, end, held
        held, path, begin, end = [row], row.archive, row.offset, last
    if held:
        yield path, begin, end, held


def parse_record(raw: bytes) -> dict:
    """Fields of a record; the payload of a response is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    named = (("page_id", fields["WARC-Record-ID"]), ("refers_to", fields.get("WARC-Refers-To", "")))
    page = {k: int(v.removeprefix("<urn:x-page:")[:-1]) for k, v in named if v.startswith("<urn:x-page:")}
    return {"page_id": None, "refers_to": None, **page, "record_type": fields["WARC-Type"], "payload_digest": digest, "payload": payload}


def read_records(folder: str, selected: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of some index rows: page_id, payload_bytes, payload_digest, record_type, refers_to, payload.

    ``payload`` (binary, of responses) is NULL unless ``with_payload``. ``payload_bytes`` of a
    revisit, which holds no payload, comes from the index.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(uri(folder))
        for batch in batches:
            out = []
            for name, begin, end, rows in _ranges(batch):
                with system.open_input_file(f"{place}/{name}") as f:
                    raw = f.read_at(end - begin, begin)
                for row in rows:
                    member = raw[row.offset - begin:row.offset - begin + row.length]
                    found = parse_record(zlib.decompress(member, wbits=31))
                    payload = found.pop("payload")
                    found["payload_bytes"] = row.payload_bytes if payload is None else len(payload)
                    out.append(found | {"payload": payload if with_payload else None})
            if out:
                columns = {c: [row[c] for row in out] for c in out[0]}
                # from the list, so that longs beside NULLs stay whole
                yield pd.DataFrame(columns | {c: pd.array(columns[c], dtype="Int64") for c in ("page_id", "refers_to")})

    # a number of its own keeps the small rows of the index from being merged into one task
    archives = max(1, selected.select("archive").distinct().count())
    return selected.select("archive", "offset", "length", "payload_bytes").repartition(archives, "archive").sortWithinPartitions(
        "archive", "offset",
    ).mapInPandas(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages and read all records back."""
    return read_records(*write_archives(pages)).drop("payload")


def warc_sql() -> str:
    """The expected records. Base32 is spelt out: 5 hexadecimal digits are 4 letters."""
    word = "(('0x' || substr(h, {a}, 5))::BIGINT)"
    spelt = " || ".join(
        f"substr('{ALPHABET}', (({word.format(a=5 * i + 1)} >> {s}) & 31)::INT + 1, 1)" for i in range(8) for s in (15, 10, 5, 0)
    )
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM h GROUP BY h)
SELECT page_id, payload_bytes, {spelt} AS payload_digest,
  CASE WHEN first IS NOT NULL AND coalesce(first < page_id, true) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN coalesce(first < page_id, true) THEN first END AS refers_to
FROM h JOIN f USING (h)"""
