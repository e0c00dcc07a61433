import hashlib
import os
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from sensorloom.llm import warc

SCHEMA = "page_id bigint, url string, html string, file string, key string, digest string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, u, h, "f", "k", "d") for i, u, h in rows], SCHEMA).repartition(parts)


def plain(rows):
    """What a page's record must say: (id, bytes, digest, type, refers)."""
    out = []
    big = lambda i: float("inf") if i is None else i
    for i, _, html in rows:
        data = (html or "").encode()
        least = min((j for j, _, h in rows if (h or "").encode() == data), key=big)
        again = len(data) >= 100 and least != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", least if again else None))
    return Counter(out)


def archived(spark, tmp_path, rows, **more):
    df = table(spark, rows)
    archive = warc.write_archives(df, f"file://{tmp_path}/web")
    return df, archive, warc.build_index(archive, **more)


def everything(df, archive, index):
    captures = warc.look_up(index, df, "url", "page_id")
    return warc.read_records(archive.folder, captures)


def told(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


ROWS = [(i, f"http://{'www.' * (i % 2)}h{i % 7}.example.{'org' if i % 3 else 'com'}/p/{i % 40}?q={i}", f"<p>{'x' * (60 + i % 50)}{i % 10}</p>") for i in range(300)]


def test_round_trip(spark, tmp_path):
    df, archive, index = archived(spark, tmp_path, ROWS, block_lines=7)
    assert index.shards.agg(F.sum("lines")).first()[0] == 300 and index.shards.agg(F.sum("blocks")).first()[0] > 40
    records = everything(df, archive, index)
    assert told(records) == plain(ROWS)
    html = {i: h for i, _, h in ROWS}
    for r in records.collect():
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload).decode() == html[r.page_id]


def test_null_empty_long_and_repeated_rows(spark, tmp_path):
    long = "é<b>" * 300_000
    rows = [(1, None, None), (2, "", ""), (3, "no address", "x" * 99), (4, "http://a.b/", "x" * 99), (5, "http://a.b/", "x" * 100)]
    rows += [(None, "http://a.b/", "x" * 100), (None, None, "y" * 200), (None, None, "y" * 200), (6, "https://A.b/ q\n é?", long), (7, "http://u", long)]
    rows += [(8, "http://c.d/", "z" * 150)] * 3 + [(9, "http://c.d/", "z" * 150), (-4, "http://c.d/x", "z" * 50)]
    df, archive, index = archived(spark, tmp_path, rows, block_lines=2)
    assert told(everything(df, archive, index)) == plain(rows)
    assert {r.url for r in archive.records.collect()} == {u for _, u, _ in rows}
    empty = table(spark, [], 1)
    archive = warc.write_archives(empty, f"{tmp_path}/none")
    index = warc.build_index(archive)
    assert everything(empty, archive, index).collect() == []
    assert warc.look_up(index, df).collect() == []


def test_a_third_of_the_rows_on_one_payload_and_one_address(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FOUND_ROWS", 16)
    rows = [(i, "http://hot.example/", "h" * 500) for i in range(200)] + [(1000 + i, f"http://e{i % 9}.example/{i}", f"{i}" * 80) for i in range(400)]
    rows += [(None, "http://hot.example/", "h" * 500)] * 50
    df, archive, index = archived(spark, tmp_path, rows, block_lines=10)
    assert told(everything(df, archive, index)) == plain(rows)
    found = warc.look_up(index, table(spark, [(0, "http://hot.example/", "")] * 5))
    assert found.count() == 250 and found.select("file", "offset").distinct().count() == 250


@pytest.mark.parametrize("block_lines", [1, 5, 3000])
def test_look_up_by_address(spark, tmp_path, block_lines):
    df, archive, index = archived(spark, tmp_path, ROWS, block_lines=block_lines)
    asked = ["http://h1.example.org/p/1?q=1", "https://www.h3.example.com/p/3?q=3", "http://h1.example.org/p/1", "http://zzz/", "", "http://h1.example.org/p/1?q=1#x", None]
    found = warc.look_up(index, table(spark, [(0, u, "") for u in asked])).collect()
    assert sorted(r._id for r in found) == [i for i, u, _ in ROWS if u and u.split("://")[1] in [a.split("://")[1] for a in asked if a and "://" in a]]


def test_only_blocks_in_question_are_read(tmp_path, spark, monkeypatch):
    df, archive, index = archived(spark, tmp_path, ROWS, block_lines=5)
    shard = index.shards.orderBy(F.desc("lines")).first()
    store, base = warc.open_folder(f"file://{tmp_path}/web/index")
    held = warc._Shard(store, f"{base}/{shard.shard}")
    read = []
    block = held.block
    monkeypatch.setattr(held, "block", lambda i: read.append(i) or block(i))
    key, page = held.firsts[2]
    assert [k for k, _ in held.find((key, page), (key, page))] == [(key, page)]
    assert read == [1, 2]


def test_files_follow_the_format(spark, tmp_path, monkeypatch):
    df, archive, _ = archived(spark, tmp_path, ROWS)
    files = os.listdir(tmp_path / "web" / "archives")
    assert files and all(f.endswith(".warc.gz") for f in files)
    kinds = Counter()
    for f in files:
        data = (tmp_path / "web" / "archives" / f).read_bytes()
        while data:
            unpack = zlib.decompressobj(31)
            member = unpack.decompress(data)
            data = unpack.unused_data
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
            head = member.split(b"\r\n\r\n")[0].decode()
            kinds[head.split("WARC-Type: ")[1].split("\r\n")[0]] += 1
    assert kinds["warcinfo"] == len(files) and kinds["response"] + kinds["revisit"] == 300 and kinds["revisit"]
    good = warc.page_record(5, "http://a b\n/", b"payload" * 20, "00", None, "1970-01-01T00:00:00Z")
    fields, page, payload = warc.parse_record(good)
    assert fields["WARC-Target-URI"] == "http://a%20b%0A/" and page["Content-Length"] == "140" and payload == b"payload" * 20
    with pytest.raises(Exception):
        warc.parse_record(good[:-20])


def test_a_changed_payload_is_noticed(spark, tmp_path):
    df, archive, index = archived(spark, tmp_path, [(1, "http://a/", "q" * 300)])
    place = archive.records.first()
    path = tmp_path / "web" / "archives" / place.file
    data = bytearray(path.read_bytes())
    wrong = warc.page_record(1, "http://a/", b"r" * 300, place.digest, None, "1970-01-01T00:00:00Z")
    data[place.offset : place.offset + place.length] = wrong.ljust(place.length, b"\0")
    path.write_bytes(bytes(data))
    with pytest.raises(Exception, match="not the one that was written|whole|zlib|decompress"):
        everything(df, archive, index).collect()


def test_keys(spark):
    urls = ["http://www.example.com/a?b#c", "HTTPS://EXAMPLE.com", "ftp://h:80/x y", None, "plain text", "http://"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.sort_key(F.col("u"))).collect()]
    assert got == ["com,example,www)/a?b#c", "com,example)", "h:80)/x%20y", ")", ")plain%20text", ")"]
