"""Embeddings, URLs and archives against plain versions."""

import base64
import hashlib
import json
import math
from collections import Counter
import random
import re

import brute
import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from footlight.llm import binarycodes, hosts, queries, warc
from footlight.llm.components import connected_components

SMALL = f"{TESTDATA}/sf0.001"


def vectors(seed=1, d=24):
    r = np.random.default_rng(seed)
    rows, i = [], 0
    for label in (0, 1, 2, None):
        for _ in range(12):
            centre = r.standard_normal(d)
            for _ in range(int(r.integers(1, 9))):
                rows.append((i * 3 % 1009 + 1, (centre + r.standard_normal(d) * r.uniform(0, 0.4)).tolist(), label))
                i += 1
    step = [[math.cos(a), math.sin(a)] + [0.0] * (d - 2) for a in np.arange(0, 6, 0.3)]  # a chain, each linked with the next
    rows += [(2000 + j, v, 5) for j, v in enumerate(step)]
    same = r.standard_normal(d).tolist()
    rows += [(3000 + j, same, 1) for j in range(5)] + [(3010, [2 * c for c in same], 1)]
    odd = [None, [0.0] * d, [float("nan")] * d, [float("inf")] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [], [1.0], [1.0], [-0.0] * d]
    return rows + [(4000 + j, v, 1) for j, v in enumerate(odd)]


def linked(spark, rows, **kw):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    clash = {c: F.lit(0) for c in ("id", "vec", "m", "n", "keys", "code", "h1", "place", "tile")}
    out = binarycodes.near_vectors(table.withColumns(clash), **kw).collect()
    assert all(x["kept"] == (x["vec_id"] == x["component_id"]) for x in out if x["vec_id"] is not None)
    return {x["vec_id"]: (x["n_links"], x["component_id"]) for x in out}, len(out)


@pytest.mark.parametrize("sent, tile", [(500, 4096), (0, 4), (0, 4096), (500, 8)])
def test_similar_vectors(spark, monkeypatch, sent, tile):
    monkeypatch.setattr(binarycodes, "SENT", sent)
    monkeypatch.setattr(binarycodes, "TILE", tile)
    rows = vectors()
    got, n = linked(spark, rows)
    assert n == len(rows) and got == {r[0]: e for r, e in zip(rows, brute.similar_vectors(rows, 0.93))}
    assert sum(x for x, _ in got.values()) > 100


def test_vectors_without_ids_and_empty_tables(spark):
    v = [1.0, 2.0, 3.0]
    got, n = linked(spark, [(None, v, 1), (7, v, 1), (9, v, 1)])
    assert n == 3 and got == {None: (0, None), 7: (1, 7), 9: (1, 7)}
    assert linked(spark, []) == ({}, 0)
    with pytest.raises(ValueError):
        linked(spark, [], threshold=0.0)


def test_number_of_tables_follows_the_label():
    """The work grows like a power well below the square, and no pair is missed more often than told."""
    work = []
    for n in (1, 2048, 10**5, 10**8, 10**11):
        bits, tables = binarycodes.tables_for(n, 0.93)
        together = (1 - math.acos(0.93) / math.pi) ** bits
        assert bits == 0 or (1 - together) ** tables <= binarycodes.MISS
        work.append(tables * n * (binarycodes.SENT + n / 2**bits))
    assert binarycodes.tables_for(2048, 0.93) == (0, 1) and work[4] / work[3] < 1000**1.25


@pytest.mark.parametrize("sent", [500, 0])
def test_repeated_ids_count_each(spark, monkeypatch, sent):
    """Rows of one id are vectors of their own, within a label and across labels."""
    monkeypatch.setattr(binarycodes, "SENT", sent)
    near = lambda x: [1.0, x, 0.5]
    rows = [(1, near(0.1), 1), (1, near(0.11), 1), (1, near(0.1), 2), (4, near(0.12), 1), (3, near(0.12), 2), (2, near(0.12), 2), (1, [-1.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = Counter(tuple(r) for r in binarycodes.near_vectors(df).collect())
    assert got == Counter({(1, 2, 1, True): 3, (4, 2, 1, False): 1, (3, 2, 1, False): 1, (2, 2, 1, False): 1, (1, 0, 1, True): 1})


def test_estimates_bound_the_cosine():
    """The estimate of a code is unbiased, and its error has the deviation that the factor tells."""
    r = np.random.default_rng(4)
    d, error, told = 48, [], []
    x = r.standard_normal(d)
    x /= np.linalg.norm(x)
    y = x * 0.93 + 0.37 * (lambda v: v / np.linalg.norm(v))(np.linalg.qr(np.stack([x, r.standard_normal(d)]).T)[0][:, 1])
    y /= np.linalg.norm(y)
    for _ in range(3000):
        turn = np.linalg.qr(r.standard_normal((d, d)))[0]
        a, b = turn @ x, turn @ y
        factor = np.abs(a).sum() / math.sqrt(d)
        error.append((np.sign(a) @ b) / (math.sqrt(d) * factor) - x @ y)
        told.append(math.sqrt((1 / factor**2 - 1) * (1 - (x @ y) ** 2) / (d - 1)))
    assert abs(np.mean(error)) < 0.003 and 0.9 < np.std(error) / np.mean(told) < 1.1


def test_components(spark):
    r = random.Random(6)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 80)] + [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(60)]
    pairs += [(3, 3), (1, 0), (None, 4), (5, None)]
    union = brute.Union({x for p in pairs for x in p if x is not None})
    for a, b in pairs:
        if a is not None and b is not None:
            union.join(a, b)
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked_ = {x for a, b in pairs if None not in (a, b) and a != b for x in (a, b)}
    assert got == {x: union.find(x) for x in linked_}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


URLS = [
    (1, "HTTP://WWW.Example.COM/en/x?y#z", "www.example.com", "/en/x"),
    (2, "https://a.b.example.com/EN/", "a.b.example.com", "/EN/"),
    (3, "ftp://example.com", "example.com", ""),
    (4, "https://example.com?x=/en/", "example.com", ""),
    (5, "https://example.com/en/#top", "example.com", "/en/"),
    (6, "no scheme/en/", "", ""),
    (7, None, "", ""),
    (8, "", "", ""),
    (9, "://É.Net/fr/a", "É.net", "/fr/a"),
    (10, "http://notexample.com/en/", "notexample.com", "/en/"),
    (11, "x://y://net/es/", "y:", "//net/es/"),
    (12, "http://net/es/\nline", "net", "/es/\nline"),
    (12, "http://net/es/\nline", "net", "/es/\nline"),
    (None, "http://sub.net/es", "sub.net", "/es"),
]


def test_rules(spark):
    pages = spark.createDataFrame([u[:2] for u in URLS], "page_id long, url string").withColumns({c: F.lit(1) for c in ("id", "host", "path", "n", "bad", "rule")})
    nothing = spark.createDataFrame([], "id long, bad int")
    got = hosts.judge_pages(pages, nothing, queries._RULES).collect()
    assert sorted(((x["page_id"] or 0, x["host"], x["path"]) for x in got)) == sorted(((u[0] or 0, *u[2:]) for u in URLS))
    rule = {x["page_id"]: (x["rule"], x["verdict"]) for x in got}
    expected = {1: ("www.example.com/en/", "allow"), 2: (None, "allow"), 3: (None, "allow"), 5: ("example.com/en/", "block"), 9: ("net/fr/", "block")}
    expected |= {10: ("com/", "allow"), 12: ("net/es/", "block"), None: (None, "allow"), 7: (None, "allow")}
    expected[2] = ("com/", "allow")
    assert {k: rule[k] for k in expected} == expected
    assert hosts.judge_pages(pages.limit(0), nothing, queries._RULES).count() == 0


def test_reputation_shrinks_to_the_levels_above(spark):
    r = random.Random(1)
    rows = []
    for host, n, rate in [("bad.spam.biz", 60, 0.95), ("few.spam.biz", 1, 1.0), ("none.spam.biz", 0, 0), ("good.site.org", 80, 0.02), ("one.site.org", 1, 1.0), ("x.co.uk", 40, 0.1)]:
        rows += [(host, int(r.random() < rate)) for _ in range(n)] + [(host, None)] * 3
    got = {x["host"]: x for x in hosts.reputations(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got["bad.spam.biz"]["low"] > 0.5 > got["good.site.org"]["rate"]
    assert got["few.spam.biz"]["rate"] > 0.7 and got["none.spam.biz"]["rate"] > 0.6  # as their domain
    assert got["one.site.org"]["low"] < 0.5  # one outcome convicts nobody in a good domain
    assert all(0 <= x["low"] <= x["rate"] <= 1 for x in got.values())
    shown = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("10.0.0.1:80",), ("localhost",), ("",), ("x.y.com:8080",)], "h string")
    names = [tuple(x) for x in shown.select(*hosts.suffix_and_domain(F.col("h"))).collect()]
    assert names == [("co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("10.0.0.1", "10.0.0.1"), ("localhost", "localhost"), ("", ""), ("com", "y.com")]


def test_blocked_by_reputation(spark):
    rows = [(i, f"http://bad.biz/{i}") for i in range(40)] + [(100 + i, f"http://ok.org/{100 + i}") for i in range(40)]
    known = [(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)]
    got = hosts.judge_pages(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(known, "id long, bad int"), []).collect()
    assert {(x["host"], x["verdict"], x["rule"]) for x in got} == {("bad.biz", "block", None), ("ok.org", "allow", None)}


def _plain_text(page: str) -> str:
    out = re.sub(r"(?s)<!--.*?-->", " ", page)
    out = re.sub(r"(?is)<(script|style|template|noscript)\b[^>]*>.*?</\1\s*>", " ", out)
    out = re.sub(r"[\s\xa0]+", " ", out)
    out = re.sub(rf"(?i)</?(?:{warc._BLOCKS})\b[^>]*>", "\n", out)
    out = re.sub(r"<[a-zA-Z/!?][^>]*>", "", out)

    def number(m):
        n = int(m[1][1:], 16) if m[1][0] in "xX" else int(m[1])
        return chr(n) if 0 < n < 0x110000 and not 0xD800 <= n <= 0xDFFF else m[0]

    out = re.sub(r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", number, out)
    for a, b in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]:
        out = out.replace(a, b)
    return re.sub(r"^\n+|\n+$", "", re.sub(r" ?\n[ \n]*", "\n", re.sub(" +", " ", out))).strip(" ")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_derivatives_of_all_pages(spark):
    out = queries.QUERIES["op4_warc_derivatives"](spark, SMALL).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(out) == 2 * len(pages) == len({x["record_id"] for x in out})
    for x in out:
        page = pages[x["page_id"]]
        body = page["html"].encode()
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
        assert (x["source_block_digest"], x["source_payload_digest"]) == (_sha1(http), _sha1(body))
        assert x["block_digest"] == _sha1(x["block"].encode()) and x["target_uri"] == page["url"]
        head = dict(line.split(": ", 1) for line in x["header"].split("\r\n")[1:])
        assert head["WARC-Refers-To"] == x["refers_to"] and int(head["Content-Length"]) == len(x["block"].encode())
        if x["type"] == "conversion":
            assert x["block"] == _plain_text(page["html"])
        else:
            about = json.loads(x["block"])
            assert about["source"]["WARC-Payload-Digest"] == _sha1(body) and about["source"]["WARC-Record-ID"] == x["refers_to"]
            assert about["html"]["links"] == re.findall(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']""", page["html"])
            assert {"name": "Content-Length", "value": str(len(body))} in about["http"]["headers"]


def test_derivatives_of_odd_responses(spark, tmp_path):
    rows = [
        (1, "<urn:a>", "http://x/", "2020-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\ncontent-type: TEXT/HTML\r\nX: a: b\r\n\r\n<p>a &#65;&#x42;&amp;lt; &#0;<br>c<script>d</script>\r\n\r\ne"),
        (2, "<urn:b>", None, None, "HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\nas <b>it</b> is"),
        (3, "<urn:c>", "http://y/", "d", "HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\nPNG"),
        (4, None, None, None, None),
        (4, None, None, None, None),
        (5, "<urn:e>", "u", "d", "no empty line"),
    ]
    table = spark.createDataFrame(rows, "page_id long, record_id string, target_uri string, date string, http string").withColumn("type", F.lit("?"))
    derived = warc.derive(table, ["page_id"])
    got = sorted((x["page_id"], x["type"], x["block"] if x["type"] == "conversion" else "") for x in derived.collect())
    text = [(1, "conversion", "a AB&lt; &#0;\nc e"), (2, "conversion", "as <b>it</b> is")]
    assert got == sorted(text + [(i, "metadata", "") for i in (1, 2, 3, 4, 4, 5)])
    one = json.loads(derived.where("page_id = 1 and type = 'metadata'").first()["block"])
    assert one["http"]["headers"] == [{"name": "content-type", "value": "TEXT/HTML"}, {"name": "X", "value": "a: b"}]
    assert warc.derive(table.limit(0), ["page_id"]).count() == 0
    warc.write_records(derived.where("page_id = 2").coalesce(1), str(tmp_path / "out"), "none")
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    found = re.findall(rb"WARC/1\.1\r\n.*?Content-Length: (\d+)\r\n\r\n", whole, re.S)
    at = 0
    for size in found:  # each record is as long as it says
        at = whole.index(b"\r\n\r\n", at) + 4 + int(size)
        assert whole[at : at + 4] == b"\r\n\r\n"
        at += 4
    assert at == len(whole) and len(found) == 2


def test_vectors_of_usual_lengths(spark, monkeypatch):
    """1,024 components, without and with projections."""
    r = np.random.default_rng(8)
    centres = r.standard_normal((6, 1024))
    rows = [(10 * i + j, (c + r.standard_normal(1024) * 0.1).tolist(), 1) for i, c in enumerate(centres) for j in range(4)]
    expected = {r[0]: e for r, e in zip(rows, brute.similar_vectors(rows, 0.93))}
    assert set(expected.values()) == {(3, 10 * i) for i in range(6)}
    for sent in (500, 0):
        monkeypatch.setattr(binarycodes, "SENT", sent)
        assert linked(spark, rows)[0] == expected
