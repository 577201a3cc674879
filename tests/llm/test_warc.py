from __future__ import annotations

import base64
import hashlib

import pytest

from cloakframe.llm import warc
from cloakframe.llm.common import new_dir
from cloakframe.llm.queries import QUERIES
from cloakframe.sources.tables import load_table


def expected(rows, min_bytes: int = 0) -> list[tuple]:
    first: dict[bytes, int] = {}
    for page_id, html in rows:
        data = (html or "").encode()
        if page_id is not None:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        to = first.get(data) if len(data) >= min_bytes else None
        to = None if to == page_id else to
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), sha, "revisit" if to is not None else "response", to))
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    rows = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted(map(tuple, rows), key=repr)


def test_query_against_brute_force(spark, data_dir):
    pages = [(r.page_id, r.html) for r in load_table(spark, data_dir, "pages").collect()]
    assert got(QUERIES["op7_warc"](spark, data_dir)) == expected(pages)


ODD = [
    (4, "http://a/ b\r\nX: y", "same"), (2, None, "same"), (9, "u", "same"), (2, "u", "same"), (1, "u", ""), (3, "u", None),
    (None, "u", "same"), (None, "u", "alone"), (5, "u", "WARC/1.1\r\n\r\n\r\n\r\n"), (6, "ü", "é\x00\n" * 70_000),
]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_odd_rows(spark, min_bytes):
    df = spark.createDataFrame([(*r, 1) for r in ODD], "page_id long, url string, html string, refers_to int")
    manifest = warc.write_archives(df, new_dir(spark, "w"), min_bytes=min_bytes)
    back = warc.read_archives(manifest)
    assert got(back) == expected([(r[0], r[2]) for r in ODD], min_bytes)
    urls = {r.page_id: r.url for r in back.collect()}
    assert urls[4] == "http://a/%20b%0D%0AX:%20y" and urls[6] == "ü"


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(df, new_dir(spark, "w"))).collect() == []


def test_dictionary_leads_and_records_stand_alone(spark, data_dir):
    import struct

    import zstandard

    pages = load_table(spark, data_dir, "pages").coalesce(1)
    row = warc.write_archives(pages, new_dir(spark, "w")).orderBy("bytes", ascending=False).first()
    data = open(row.path.removeprefix("file://"), "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and data[8:12] == b"\x37\xa4\x30\xec"
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    one = decompressor.decompressobj().decompress(data[8 + size :])
    assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n") and one.count(b"WARC-Type") == 1


def test_hot_payload(spark):
    rows = [(i, "u", "copy" if i % 3 else f"text {i}") for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert got(warc.read_archives(warc.write_archives(df, new_dir(spark, "w")))) == expected([(r[0], r[2]) for r in rows])
