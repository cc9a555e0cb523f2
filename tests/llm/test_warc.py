import base64
import gzip
import hashlib

from verdant.llm import warc as w


def test_url_key():
    assert w.url_key("http://www.Example.com/A?b=C#f") == "com,example)/a?b=c"
    assert w.url_key("https://m.a.org:443") == "org,a,m)/" and w.url_key("http://a.org:81/x") == "org,a:81)/x"
    assert w.url_key(None) == "" and w.url_key("mailto:x") and w.url_key("http://[bad") == "http://[bad"


def test_record_round_trip():
    digest = w.digest_of(b"p\r\n\r\nq")
    r = w.parse_record(w.record_bytes(7, "http://a/\n", b"p\r\n\r\nq", digest, None))
    assert r["payload"] == b"p\r\n\r\nq" and r["headers"]["x-page-id"] == "7" and r["headers"]["warc-target-uri"] == "http://a/%0A"
    r = w.parse_record(w.record_bytes(8, None, b"pq", digest, 7))
    assert r["payload"] is None and r["http_length"] == 2 and r["headers"]["x-refers-to-page-id"] == "7"


def test_archives_and_index(spark, monkeypatch):
    monkeypatch.setattr(w, "BLOCK_LINES", 3)
    rows = [(i, f"http://h{i % 4}.org/p", f"<p>{i % 11}</p>" * 3, "x") for i in range(60)]
    rows += [(100, None, None, "x"), (101, "http://a b.org/ c", "", "x"), (102, "http://h1.org/p", "é" * 50_000, "x"), (None, "http://n.org", "<p>1</p>" * 3, "x"),
             (7, "http://h3.org/p", rows[7][2], "x")]                       # a repeated row
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    index = w.write_archives(pages.repartition(4))
    got = index.read(index.lookup(pages)).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", 1 << 60), i)
    want = sorted((str(i), u or "", len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                   "response" if i is None or first[h or ""] == i else "revisit", str(None if i is None or first[h or ""] == i else first[h or ""]))
                  for i, u, h, _ in rows)
    assert sorted((str(r.page_id), r.url or "", r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == want
    assert all((r.payload or b"").decode() == (dict((str(i), h or "") for i, _, h, _ in rows)[str(r.page_id)] if r.record_type == "response" else "")
               for r in got)
    lines = index.captures("https://www.h1.org/p")
    assert sorted(x[1] for x in lines) == sorted([i for i in range(60) if i % 4 == 1] + [102])
    assert index.captures("http://h9.org/") == []
    missing = spark.createDataFrame([(1, "http://h0.org/p"), (999, "http://zzz.org/")], "page_id long, url string")
    assert index.lookup(missing).count() == 0
    # Payloads below the bound are responses.
    few = w.write_archives(pages, min_bytes=10_000)
    assert few.read(few.lookup(pages)).where("record_type = 'revisit'").count() == 0
    part = w.IndexPart(index.folder, index.parts().first()["file"])
    assert part.firsts == sorted(part.firsts) and gzip  # sorted blocks


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    index = w.write_archives(pages)
    assert index.read(index.lookup(pages)).count() == 0 and index.captures("http://a/") == []
