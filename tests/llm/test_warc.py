import base64
import gzip
import hashlib
import zlib
from pathlib import Path

import pytest

from shopledger.llm import queries, warc

SCHEMA = "page_id long, url string, html string, key string, offset int, sha1 string"
ROWS = [
    (1, "http://www.b.example.com/x?q=1#f", "<p>one</p>"), (2, "http://a.example.com/", "<p>one</p>"), (3, "https://a.example.com", None),
    (4, "http://b.example.com/x", ""), (5, None, "<p>é & ☃</p>\r\n\r\nWARC/1.1\r\n"), (6, "", "z" * 300_000), (6, "", "z" * 300_000),
    (7, "http://a.example.com/", "z" * 300_000), (None, "http://a.example.com/", "<p>one</p>"), (None, "u", "only here"), (None, "u", "only here"),
    (8, "http://hot.example.com/", "h"), (9, "http://hot.example.com/", "h2"), (10, "bücher.example/ö ä\tb", "b"),
]


def brute(rows):
    found = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        revisit = bool(same) and page != min(same)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        found.append((page, len(raw), digest, "revisit" if revisit else "response", min(same) if revisit else None))
    return sorted(found, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "s") for r in rows], SCHEMA)


@pytest.mark.parametrize("lines,broadcast", [(1, 0), (2, 50_000), (3_000, 50_000)])
def test_records_read_back(spark, tmp_path, monkeypatch, lines, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", broadcast)
    monkeypatch.setattr(warc, "READ_BYTES", 300)
    folder = f"{tmp_path}/a"
    entries = warc.write(frame(spark, ROWS), folder)
    made = warc.Archive(folder, entries, warc.build_index(entries, folder, lines))
    got = warc.read(made, warc.locate(made, frame(spark, ROWS))).collect()
    assert sorted((tuple(r[:5]) for r in got), key=str) == brute(ROWS)
    payloads = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response" and r.page_id}
    assert payloads == {p: (h or "").encode() for p, _, h in ROWS if p in payloads} and len(payloads) >= 6


def test_files_are_archives_and_the_index_is_sorted(spark, tmp_path):
    made = warc.archive(frame(spark, ROWS), f"{tmp_path}/a")
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in Path(f"{tmp_path}/a/warc").glob("*.warc.gz"))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.count(b"WARC-Record-ID: ") == len(ROWS)
    keys = []
    for block in sorted(made.directory.collect(), key=lambda b: b.first_key):
        data = Path(f"{tmp_path}/a/index/{block.file}").read_bytes()[block.offset : block.offset + block.length]
        keys += [line.split("\t")[0] for line in zlib.decompress(data, 31).decode().split("\n")]
    assert keys == sorted(keys) and len(keys) == len(ROWS)


def test_search_of_some_and_of_absent_pages(spark, tmp_path):
    made = warc.archive(frame(spark, ROWS), f"{tmp_path}/a")
    wanted = frame(spark, [(9, "https://hot.example.com/#x", None), (99, "http://hot.example.com/", None), (9, "http://zzz.example", None), (6, "", None)])
    assert sorted((r.page_id, r.key) for r in warc.locate(made, wanted).collect()) == [(6, ""), (6, ""), (9, "com,example,hot)/")]


def test_damage_is_an_error(spark, tmp_path):
    made = warc.archive(frame(spark, ROWS[:1]), f"{tmp_path}/a")
    file = next(Path(f"{tmp_path}/a/warc").glob("*.warc.gz"))
    raw = gzip.decompress(file.read_bytes()).replace(b"<p>one</p>", b"<p>two</p>")
    packed = warc._gzip(raw)
    file.write_bytes(packed)
    spot = spark.createDataFrame([(1, "k", file.name, 0, len(packed))], warc._PLACES)
    with pytest.raises(Exception, match="damaged record"):
        warc.read(made, spot).collect()


@pytest.mark.parametrize("url,key", [
    ("http://www.Example.com:80/A/b?c#d", "com,example)/A/b?c"), ("https://user@a.b.org", "org,b,a)"), (None, ""), ("", ""),
    ("a.com?x=/y", "com,a)/?x=/y"),
])
def test_keys(url, key):
    assert warc.reversed_host_key(url) == key


def test_whole_table_and_empty_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = sorted((tuple(r) for r in queries.op8_warc(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute([(p.page_id, p.url, p.html) for p in pages])
    assert warc.captures(spark.createDataFrame([], SCHEMA), queries.shared_folder(spark)).count() == 0
