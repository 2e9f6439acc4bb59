import gzip
import hashlib
import random
from collections import Counter

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from riskspark.llm import warc
from riskspark.llm.warc import (
    Ranges, archive_round_trip, build_index, file_system, lookup, parse_record, qualified, read_records, record, url_key,
    write_archives,
)

DDL = "page_id long, url string, html string, key string, file string, first long"


def pages():
    rng = random.Random(1)
    bodies = ["".join(rng.choices("<abc é>\r\n", k=rng.choice([0, 50, 99, 100, 101, 3000]))) for _ in range(25)]
    hosts = ["hot.example.com"] * 6 + ["example.org", "a.b.example.net:8080", "xn--e.test"]
    rows = [(i, f"https://{rng.choice(hosts)}/{rng.randint(0, 12)}?q={rng.randint(0, 3)}", rng.choice(bodies)) for i in range(220)]
    rows += [(900, None, "x" * 200), (901, "", "x" * 200), (902, "not a url", None), (903, "http://[bad", "é" * 60), (904, "http://h/\n b", "")]
    rows += [rows[7], (None, "http://null.id/", "x" * 200), (None, "http://null.id/", "y" * 300)]
    rng.shuffle(rows)
    return rows


def brute(rows):
    lowest = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and page is not None:
            lowest[raw] = min(page, lowest.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = lowest.get(raw)
        revisit = first is not None and page != first
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    rows = pages()
    df = spark.createDataFrame([(*r, "k", "f", 1) for r in rows], DDL).repartition(3)
    got = archive_round_trip(df, str(tmp_path / "w"))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("block_lines", [1, 3, 1000])
def test_lookup_finds_all_captures_of_a_key(spark, tmp_path, block_lines):
    rows = [(i, f"http://h{i % 5}.example/{i % 3}", f"{i}" * 40) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    entries = write_archives(df, str(tmp_path / "a"))
    index = build_index(entries, str(tmp_path / "i"), block_lines)
    wanted = [url_key("http://h2.example/1"), url_key("http://h4.example/0"), "zz,none)/", ")"]
    found = lookup(spark.createDataFrame([(k,) for k in wanted + wanted], "key string"), index, spark)
    want = sorted(i for i, u, _ in rows if url_key(u) in wanted)
    assert sorted(r.page_id for r in found.collect()) == want
    payloads = {r.page_id: bytes(r.payload).decode() for r in read_records(found).collect()}
    assert payloads == {i: h for i, _, h in rows if i in want}


def test_archives_are_plain_gzip_of_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a.b/", "hello")], "page_id long, url string, html string")
    entry = write_archives(df, str(tmp_path / "a")).first()
    with gzip.open(entry.file) as f:
        assert f.read().startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    headers, payload = parse_record(Ranges().read(entry.file, entry.offset, entry.length))
    assert payload == b"hello" and headers["WARC-Target-URI"] == "http://a.b/"


def test_empty_table(spark, tmp_path):
    assert archive_round_trip(spark.createDataFrame([], DDL), str(tmp_path / "e")).count() == 0


def test_keys_and_records():
    assert url_key("HTTPS://Blog.Example.com:8443/A?b=c") == "com,example,blog:8443)/A?b=c"
    assert url_key("http://example.com") == "com,example)/"
    assert "\n" not in url_key("http://h/\n b")
    headers, payload = parse_record(record(5, "u", b"a\r\n\r\nb", "d", 3, False))
    assert payload == b"a\r\n\r\nb" and headers["X-Page-ID"] == "5"
    headers, payload = parse_record(record(5, "u", b"abc", "d", 3, True))
    assert payload == b"" and headers["X-Refers-To-Page-ID"] == "3" and headers["WARC-Type"] == "revisit"


def test_reading_is_spread_by_the_bytes_to_read(spark, tmp_path, monkeypatch):
    # AQE would merge partitions of so few pointers into one
    rows = [(i, f"http://h{i}.example/", random.Random(i).randbytes(800).hex()) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    entries = write_archives(df, str(tmp_path / "a"))
    monkeypatch.setattr(warc, "STRETCH", 20_000)
    monkeypatch.setattr(warc, "READ_BYTES", 30_000)
    monkeypatch.setattr(warc, "PART_LINES", 40)
    index = build_index(entries, str(tmp_path / "i"), 7)
    assert len(index.parts) > 4
    found = lookup(entries.select("key"), index, spark)
    used = read_records(found).select("page_id", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.page_id for r in used) == list(range(300))
    per = Counter(r.task for r in used)
    assert len(per) > 4 and max(per.values()) < 150


def test_folders_are_resolved_as_spark_resolves_them(spark, tmp_path):
    assert qualified(spark, str(tmp_path)) == qualified(spark, f"file://{tmp_path}") == str(tmp_path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    # a default store other than the local one, reached by a class that needs no network
    conf.set("fs.defaultFS", "viewfs://cluster/")
    conf.set("fs.viewfs.mounttable.cluster.link./data", f"file://{tmp_path}")
    try:
        assert qualified(spark, "/data/x") == "viewfs://cluster/data/x"
    finally:
        conf.set("fs.defaultFS", before)
    assert isinstance(file_system("file:/a/b")[0], fs.LocalFileSystem) and file_system("file:///a/b")[1] == "/a/b"
    store, path = file_system("s3a://bucket/a/b?region=us-east-1")
    assert (store.type_name, path) == ("s3", "bucket/a/b")
