"""Web archives whose records share a dictionary.

Each file begins with a skippable frame that holds a zstandard dictionary, built from the first records of that very
file, and goes on with one frame per record, compressed with it; so any record can be read alone, and small pages
compress as well as if they stood together. Too few records for a dictionary: the frame is left out.

A page is a ``response`` with its HTTP head and payload. If others have the same payload (of at least ``min_bytes``
bytes), that with the least page id is the response and the others are ``revisit`` records that refer to it and keep
the head only, whose Content-Length tells the payload's size.

Results in odd cases: a null html is an empty payload; a null url leaves the target out; rows with the least id of
their payload are all responses, also if the row repeats; rows without an id refer to a row that has one, and are
responses if there is none; an empty table gives no file and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.files import file_system, read_parts, write_parts
from cloakframe.operators.hot_keys import left_lookup

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_BYTES = 1 << 16
SAMPLE_BYTES = 1 << 22  # records that are held back to build a file's dictionary
FEWEST_SAMPLES = 16


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_refers_to(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(id, payload, refers_to) and the other columns: the least id of the rows with the same payload, null for
    that row itself. Groups are counted by digest before rows meet them, and rows of hot groups are not shuffled
    by the digest."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    keyed = pages.withColumn("__sum", F.when(F.octet_length(payload) >= min_bytes, F.sha1(payload.cast("binary"))))
    groups = keyed.select("__sum", F.col(id_col).alias("id")).where(F.col("__sum").isNotNull()).groupBy("__sum")
    first = groups.agg(F.count("*").alias("n"), F.min("id").alias("refers_to")).where("n > 1").drop("n")
    found = left_lookup(keyed, first, "__sum", "__sum")
    own = F.col(id_col).eqNullSafe(F.col("refers_to"))
    return found.withColumn("refers_to", F.when(~own, F.col("refers_to"))).drop("__sum")


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to else head + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", f"<urn:page:{page_id or ''}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
    ]
    if url is not None:
        # Spaces and control characters would end or split the field.
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)))
    if refers_to:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    """A dictionary built from records; empty if they are too few or too short for one."""
    if len(samples) < FEWEST_SAMPLES:
        return b""
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_records(stream, records: Iterator[bytes]) -> int:
    held, size = [], 0
    for one in records:
        held.append(one)
        size += len(one)
        if size >= SAMPLE_BYTES:
            break
    trained = _dictionary(held)
    options = {"level": 3, "write_checksum": True}
    if trained:
        stream.write(struct.pack("<II", DICTIONARY_FRAME, len(trained)) + trained)
        options["dict_data"] = zstandard.ZstdCompressionDict(trained)
    compressor, n = zstandard.ZstdCompressor(**options), 0
    for one in chain(held, records):
        stream.write(compressor.compress(one))
        n += 1
    return n


def read_records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of one file."""
    fs, path = file_system(uri)
    with fs.open_input_stream(path, compression=None) as raw:
        start = raw.read(8)
        magic, size = struct.unpack("<II", start)
        if magic == DICTIONARY_FRAME:
            decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw.read(size)))
            rest = raw
        else:
            decompressor, rest = zstandard.ZstdDecompressor(), _After(start, raw)
        plain = io.BufferedReader(decompressor.stream_reader(rest, read_across_frames=True), 1 << 18)
        while plain.readline():  # WARC/1.1
            fields = {}
            while (line := plain.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                fields[name] = value
            yield fields, plain.read(int(fields["Content-Length"]))
            plain.read(4)


class _After:
    """A stream that begins with bytes already taken from another."""

    def __init__(self, taken: bytes, stream):
        self.taken, self.stream = taken, stream

    def read(self, size: int = -1) -> bytes:
        if self.taken:
            out, self.taken = self.taken, b""
            return out
        return self.stream.read(size)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record per row, one archive per partition; returns the manifest."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"))
    referred = with_refers_to(rows, "id", "payload", min_bytes).select(
        F.col("id").cast("string").alias("id"), "url", F.coalesce("payload", F.lit("")).alias("payload"),
        F.col("refers_to").cast("string").alias("refers_to"),
    )

    def write(batches: Iterator[pd.DataFrame], stream) -> tuple[int, int]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, payload, refers_to in batch.itertuples(index=False):
                    yield record(*(None if pd.isna(x) else x for x in (page_id, url)), payload.encode(),
                                 None if pd.isna(refers_to) else refers_to, date)

        n = write_records(stream, records())
        return n, n

    return write_parts(referred, folder, ".warc.zst", write)


def _number(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""

    def read(row: dict) -> Iterator[pd.DataFrame]:
        rows = []
        for fields, block in read_records(row["path"]):
            head, _, payload = block.partition(b"\r\n\r\n")
            size = int(re.search(rb"Content-Length: (\d+)", head)[1])
            checksum, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
            if kind == "response" and (len(payload) != size or digest(payload) != checksum):
                raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
            refers_to = _number(fields["WARC-Refers-To"]) if kind == "revisit" else None
            rows.append((_number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, checksum, kind, refers_to))
            if len(rows) == 1000:
                yield _frame(rows)
                rows = []
        if rows:
            yield _frame(rows)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return read_parts(manifest, read, schema)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
