import gzip
import hashlib
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from assaylake.llm import queries, registry, warc

PAGES = "page_id long, url string, html string, archive string, record int, digest string, refers long"


def through(rows, folder, **how):
    listing = warc.write_archives(rows, f"{folder}/raw", key="page_id", payload="html", uri="url", **how)
    done = warc.normalise(listing, f"{folder}/new", warc.find_revisits(listing, "bigint"))
    return listing, done, warc.read_records(warc.read_index(done))


def local(path):
    return path.removeprefix("file://")


@pytest.fixture
def pages(spark):
    hot, small = "<p>hot</p>" * 200, "<p>small</p>"
    rows = [(i, f"http://x/{i}", hot, "a", 1, "d", 9) for i in range(40)]
    rows += [(39, "http://x/again", hot, None, None, None, None), (None, "http://x/none", hot, "a", 1, "d", 9)]
    rows += [(50, None, None, "a", 1, "d", 9), (51, "http://x/ \r\nWARC-Type: bad", "", "a", 1, "d", 9)]
    rows += [(60 + i, "u", small, "a", 1, "d", 9) for i in range(3)] + [(70, "u", "ñ▁\r\n\r\nWARC/1.0\r\n" * 300_000, "a", 1, "d", 9)]
    rows += [(80, "u", "x" * 999, "a", 1, "d", 9), (81, "u", "x" * 999, "a", 1, "d", 9), (82, "u", "y" * 1000, "a", 1, "d", 9), (83, "u", "y" * 1000, "a", 1, "d", 9)]
    return spark.createDataFrame(rows, PAGES).repartition(3), rows


def expected(rows):
    out = []
    for i, (key, _, html, *_) in enumerate(rows):
        data = (html or "").encode()
        same = [(r[0] if r[0] is not None else -1, j) for j, r in enumerate(rows) if (r[2] or "").encode() == data]
        first = max(same)
        turned = len(data) >= 1000 and (first[0], i) != (first[0], first[1])
        out.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if turned else "response", first[0] if turned else None))
    # Which of the rows that share the largest key is the response is open; as rows of the result they are alike.
    return sorted(out, key=repr)


def test_round_trip_with_revisits(pages, tmp_path):
    frame, rows = pages
    _, done, read = through(frame, str(tmp_path), archive_bytes=5_000)
    got = read.select(F.col("key").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)
    texts = {(r.key, bytes(r.payload)) for r in read.where("record_type = 'response'").collect()}
    assert ("70", rows[-5][2].encode()) in texts and ("50", b"") in texts
    assert done.count() > 3
    uris = {r.uri for r in read.select("uri").collect()}
    assert "http://x/%20%0D%0AWARC-Type:%20bad" in uris and None in uris


def test_each_record_is_a_member_and_the_sidecar_finds_it(pages, tmp_path):
    frame, _ = pages
    listing, done, _ = through(frame, str(tmp_path))
    for row in listing.select("archive").distinct().collect():
        data = open(local(row.archive), "rb").read()
        unpack = __import__("zlib").decompressobj(31)
        unpack.decompress(data)
        assert unpack.eof and not unpack.unused_data  # one stream
    for row in done.collect():
        data = open(local(row.archive), "rb").read()
        lines = [json.loads(line) for line in open(local(row.sidecar))]
        assert len(lines) == row.records and sum(x["length"] for x in lines) == len(data) == row.bytes
        for x in lines:
            record = gzip.decompress(data[x["offset"] : x["offset"] + x["length"]])
            assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n")
            assert f"WARC-Type: {x['type']}\r\n".encode() in record
    few = warc.read_records(warc.read_index(done).where("type = 'response' and offset > 0").limit(2))
    assert few.count() == 2


def test_normalising_again_changes_no_record(pages, tmp_path):
    frame, _ = pages
    _, done, read = through(frame, str(tmp_path))
    again = warc.read_records(warc.read_index(warc.normalise(done, f"{tmp_path}/again")))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, read.collect()))


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
@pytest.mark.parametrize("split", [False, True])
def test_archives_of_others(spark, tmp_path, monkeypatch, piece, split):
    """Records of several kinds, folded lines, bare line feeds, in one stream or several."""
    http = b"HTTP/1.1 200 OK\r\nServer: a\r\n\r\n"
    body = b"<html>\r\n\r\nWARC/1.0</html>"
    digest = hashlib.sha1(body).hexdigest().upper()
    records = [
        b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 5\r\n\r\nGET /\r\n\r\n",
        b"WARC/1.0\nwarc-type: response\nWARC-Target-URI: http://a\n b\nWARC-Record-ID: <r>\n"
        + f"WARC-Payload-Digest: sha1:{digest}\nContent-Length: {len(http + body)}\n\n".encode() + http + body + b"\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: revisit\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
    ]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(map(gzip.compress, records)) if split else gzip.compress(b"".join(records)))
    (tmp_path / "b.warc.gz").write_bytes(b"")
    monkeypatch.setattr(warc, "_PIECE", piece)
    for name in ("a", "b"):
        made = warc._normalised(f"{tmp_path}/{name}.warc.gz", f"{tmp_path}/out", {}, 6)
        lines = [json.loads(line) for line in open(made["sidecar"])]
        assert [x["type"] for x in lines] == (["request", "response", "revisit"] if name == "a" else [])
        for x in lines[1:2]:
            with open(made["archive"], "rb") as f:
                f.seek(x["offset"])
                got = warc._read(warc._Stream(warc._inflated(f, x["length"])), True)
            assert (got["payload"], got["uri"], got["payload_digest"]) == (body, "http://a b", digest.lower())


def test_damage_is_an_error(tmp_path):
    whole = gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\n123")
    (tmp_path / "short.warc.gz").write_bytes(whole)
    (tmp_path / "cut.warc.gz").write_bytes(whole[:-9])
    (tmp_path / "odd.warc.gz").write_bytes(gzip.compress(b"no archive"))
    for name in ("short", "cut", "odd"):
        with pytest.raises(ValueError):
            warc._normalised(f"{tmp_path}/{name}.warc.gz", f"{tmp_path}/out", {}, 6)
    wrong = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:00\r\nContent-Length: 22\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc\r\n\r\n"
    with pytest.raises(ValueError, match="digest"):
        warc._read(warc._Stream(iter([wrong])), False)


def test_empty_table(spark, tmp_path):
    listing, done, read = through(spark.createDataFrame([], PAGES), str(tmp_path))
    assert listing.count() == done.count() == read.count() == 0


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL['op13_warc']})").fetchall()
    got = [tuple(r) for r in queries.op13_warc(spark, sf).select(columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
