"""URL rules against plain matching, archives as a round trip."""

import hashlib
import re

from postlens.llm import url_rules, warc


def test_path_rules(spark):
    urls = [
        "http://example.org/es/1", "http://a.example.org/es/", "https://EXAMPLE.org/en/15", "http://example.org/en/2", "http://notexample.org/es/",
        "http://x.com/fr/de/", "http://x.com/de/fr", "http://x.net/ads/1", "http://x.net/ADS?x", "http://x.net/loads/1", "ftp://org/", "org/", None, "",
        "http://x.org", "http://x.org?es/", "a://b://c.org/x", "http://com/fr/", "http://x.org/\nES", "http://example.org/ES/",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[0], "h"), (0, urls[0], "h")], "page_id long, url string, host string")
    got = url_rules.judge_urls(pages).collect()
    assert len(got) == len(urls) + 2
    for r in (r for r in got if r["page_id"] is not None):
        url = urls[r["page_id"]] or ""
        rest = url.partition("://")[2]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.lower()
        assert (r["host"], r["path"]) == (host, path)
        fits = [
            (len(rule), verdict, rule) for verdict, rule in url_rules.PATH_RULES
            if (host == rule.partition("/")[0] or host.endswith("." + rule.partition("/")[0])) and path.startswith("/" + rule.partition("/")[2])
        ]
        if fits:
            assert (r["verdict"], r["rule"]) == max(fits)[1:]
        else:
            words = set(re.split("[^a-z0-9]+", rest.lower())) & set(url_rules.BLOCKED_WORDS)
            assert r["verdict"] == ("block" if words else "allow")
    assert url_rules.judge_urls(pages.limit(0)).count() == 0


def test_rarest_token_and_blocks(spark, monkeypatch):
    rules = [url_rules.path_rule("block", f"h{i}.net/p/") for i in range(10)]
    index = url_rules.build_index(rules, {"net": 100, "p": 50, **{f"h{i}": i for i in range(10)}})
    assert set(index) == {f"h{i}" for i in range(10)}
    pages = spark.createDataFrame([(i, f"http://www.h{i}.net/p/x") for i in range(12)], "page_id long, url string")
    monkeypatch.setattr(url_rules, "BLOCK", 3)
    got = {r["page_id"]: r["rule"] for r in url_rules.judge_urls(pages, rules).collect()}
    assert got == {i: f"h{i}.net/p/" if i < 10 else None for i in range(12)}
    assert {r["verdict"] for r in url_rules.judge_urls(pages, []).collect()} == {"allow"}


def test_archives(spark, tmp_path):
    long = "x" * 150
    rows = [
        (1, "http://a/%20\r\nX: y", long), (2, None, long), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "ü", "é" * 70), (7, "u", "é" * 70),
        (2, None, long), (None, "n", long), (None, None, "only"), (8, "u", "WARC/1.1\r\n\r\n" * 20), (9, "u", "y" * 300_000), (2**62 + 1, "u", "big id"), (2**62 + 3, "u", long),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload_bytes int").repartition(3)
    archives = warc.write_archives(warc.page_records(pages), str(tmp_path))
    for r in archives.collect():
        assert open(r["archive"], "rb").read(4) == b"\x5d\x2a\x4d\x18"
    got = warc.read_archives(archives).collect()
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    want = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        first = min((i for i, _, h in rows if h == html and i is not None), default=None)
        revisit = len(data) >= 100 and page_id != first
        want.append((page_id, url, "revisit" if revisit else "response", first if revisit else None, hashlib.sha256(data).hexdigest(), len(data), None if revisit else data))
    assert sorted([tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got], key=key) == sorted(want, key=key)
    assert warc.read_archives(warc.write_archives(warc.page_records(pages.limit(0)), str(tmp_path))).count() == 0


def test_large_archives_are_rotated(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 5_000)
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>" * 100) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(warc.page_records(pages), str(tmp_path))
    assert archives.count() > 1
    assert warc.read_archives(archives).count() == 60
