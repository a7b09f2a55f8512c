import gzip
import hashlib

from dialtone.llm import warc as W
from dialtone.llm.queries import QUERIES


def test_arc_lengths_not_separators():
    trap = b"http://a 0.0.0.0 20240101000000 text/html 5\nWARC/1.1\r\n\r\n\n\n"
    for version in (1, 2):
        data = (W.arc_version_block("x.arc", "20240101", version)
                + W.arc_record("http://b", "2024010203", trap, version) + W.arc_record("http://c", "20240102030405", b"", version))
        got = list(W.read_arc(data))
        assert [(f["URL"], body) for _, f, body in got] == [("http://b", trap), ("http://c", b"")]
        assert (got[0][1].get("Checksum") is not None) == (version == 2)
    # the last record is cut in its header: it is reported, the one before is read
    assert [list(f)[0] for _, f, _ in W.read_arc(data[:-10])] == ["URL", "damage"]
    assert W.warc_date("20240102030405") == "2024-01-02T03:04:05Z" and W.warc_date("20240102") == "2024-01-02T00:00:00Z"


def test_warc_round_trip():
    block = b"WARC/1.1\r\nx: y\r\n\r\nbody\r\n\r\n"
    data = W.warc_record([("WARC-Type", "response")], block) + W.warc_record([("WARC-Type", "revisit")], b"")
    assert [(f["WARC-Type"], b) for f, b in W.read_warc(data)] == [("response", block), ("revisit", b"")]


def test_duplicates_become_revisits(spark, tables_dir):
    big, small = "é" * 600, "x" * 999
    htmls = {1: big, 2: big, 3: small, 4: small, 5: "y" * 1000, 6: None, 7: "", 8: big, 10: "y" * 1000,
             9: "HTTP/1.1 200 OK\r\n\r\nhttp://a 0.0.0.0 1 t 4\n\nWARC/1.1\r\n\r\n" * 30, 11: "z" * 300_000}
    rows = [(k, f"http://x/{k}?a=b c%20\t", h, "r", 1) for k, h in htmls.items()]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record string, path int")
    got = {r["page_id"]: r for r in QUERIES["op9_warc"](spark, tables_dir(pages=df)).collect()}
    assert set(got) == set(htmls)
    refers = {1: 8, 2: 8, 5: 10}
    for k, html in htmls.items():
        raw = (html or "").encode()
        r = got[k]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", refers[k]) if k in refers else ("response", None))
        assert r["url"] == f"http://x/{k}?a=b c%20\t" and r["intact"]


def test_nulls_repeats_and_empty(spark):
    schema = "page_id long, url string, html string"
    df = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (1, "", "b")], schema)
    got = sorted((r["key"] or "", r["url"] is None, r["type"]) for r in W.through_archives(df).collect())
    assert got == [("", True, "response"), ("1", False, "response"), ("1", False, "response")]
    assert W.through_archives(df.where("false")).count() == 0


def test_archives_are_complete_files(spark, tmp_path):
    df = spark.createDataFrame([(k, "http://x", "p" * 2000) for k in range(50)], "page_id long, url string, html string")
    W.write_arc(df.coalesce(1), str(tmp_path / "arc"), 2, archive_bytes=20_000)
    files = sorted((tmp_path / "arc").glob("*.gz"))
    assert len(files) > 3
    assert sum(len(list(W.read_arc(gzip.decompress(f.read_bytes())))) for f in files) == 50


def test_damaged_archives_are_read_on(spark, tmp_path):
    rec = lambda url, body, v=1: W.arc_record(url, "20240102030405", b"HTTP/1.1 200 OK\r\n\r\n" + body, v)
    block = W.arc_version_block("x.arc", "20240101", 1)
    spaced = b"http://a/b c d 0.0.0.0 20240102030405 text/html 4\nbody\n"
    short = b"http://short 20240102030405 text/html 4\nbody\n"  # a field is missing
    wrong = b"http://w 0.0.0.0 20240102030405 text/html 3\nlonger than three\n"
    data = block + rec("http://1", b"one") + spaced + short + rec("http://2", b"two") + wrong + rec("http://3", b"three") + b"http://no length at all\n"
    got = list(W.read_arc(data))
    assert [f["URL"] for _, f, _ in got if "URL" in f] == ["http://1", "http://a/b c d", "http://2", "http://w", "http://3"]
    assert [b for _, f, b in got if f.get("URL") == "http://a/b c d"] == [b"body"]
    assert len([f for _, f, _ in got if "damage" in f]) == 3
    assert [f["URL"] for _, f, _ in W.read_arc(rec("http://1", b"x") + rec("http://2", b"y", 2))] == ["http://1", "http://2"]
    folder = tmp_path / "arc"
    folder.mkdir()
    whole = gzip.compress(data)
    (folder / "a.arc.gz").write_bytes(whole)
    (folder / "b.arc.gz").write_bytes(gzip.compress(block + rec("http://4", b"four" * 50_000))[:-300])  # cut short
    (folder / "c.arc.gz").write_bytes(b"not gzip")
    (folder / "d.arc.gz").write_bytes(gzip.compress(block) + gzip.compress(rec("http://5", b"five")))  # two members
    W.convert(spark, [str(folder)], str(tmp_path / "warc"))
    urls = sorted(r["url"] for r in W.read_warc_archives(spark, str(tmp_path / "warc")).collect())
    assert urls == ["http://1", "http://2", "http://3", "http://5", "http://a/b c d", "http://w"]
    reported = W.damaged(spark, [str(folder)]).groupBy("path").count().collect()
    assert {r["path"].rsplit("/", 1)[1]: r["count"] for r in reported} == {"a.arc.gz": 3, "b.arc.gz": 2, "c.arc.gz": 1}
