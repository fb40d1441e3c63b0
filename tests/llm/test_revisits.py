import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.llm.revisits import BODY_HEADERS, HOP_HEADERS, RECORD, canonical_url, resolve_revisits

T0 = dt.datetime(2024, 1, 1)


def brute(rows):
    """rows: (id, type, url, date, status, headers, digest); urls already canonical, ids unique."""
    out = {}
    for i, kind, url, date, _, headers, _ in rows:
        if kind != "revisit":
            continue
        new = {k.lower(): v for k, v in (headers or {}).items()}
        earlier = [r for r in rows if r[1] == "response" and r[4] == 200 and r[2] == url and None not in (url, date, r[3]) and r[3] < date]
        if not earlier:
            out[i] = ("no_earlier_response", None, None, None)
            continue
        best = max(earlier, key=lambda r: (r[3], r[0]))
        old = {k.lower(): v for k, v in (best[5] or {}).items()}
        a, b = new.get("etag"), old.get("etag")
        if a is not None and b is not None:
            same = a.strip().removeprefix("W/") == b.strip().removeprefix("W/")
        else:
            same = new.get("last-modified") is not None and new.get("last-modified") == old.get("last-modified")
        if not same:
            out[i] = ("validator_mismatch", best[0], None, None)
            continue
        merged = {k: v for k, v in old.items() if k not in HOP_HEADERS}
        merged |= {k: v for k, v in new.items() if k not in BODY_HEADERS + HOP_HEADERS}
        out[i] = ("resolved", best[0], merged, best[6])
    return out


def _rows(seed, n):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        url = "http://hot/" if i % 3 == 0 else f"http://h/{rnd.randrange(12)}"
        headers = {}
        for name in ("ETag", "last-modified", "Cache-Control", "Content-Type", "Connection", "X-New"):
            if rnd.random() < 0.6:
                headers[name] = rnd.choice(['"a"', 'W/"a"', '"b"'])
        kind = rnd.choice(["response", "revisit"])
        out.append((i, kind, url if rnd.random() < 0.97 else None, T0 + dt.timedelta(seconds=rnd.randrange(n)) if rnd.random() < 0.97 else None,
                    (200 if rnd.random() < 0.9 else 404) if kind == "response" else 304, headers if rnd.random() < 0.95 else None, f"d{i}"))
    return out


@pytest.mark.parametrize("slices", [1, 4, 64])
def test_against_brute_force(spark, slices):
    rows = _rows(slices, 400)
    got = {r.record_id: (r.resolution, r.original_id, r.headers, r.payload_digest)
           for r in resolve_revisits(spark.createDataFrame(rows, RECORD), slices).collect()}
    assert got == brute(rows)


def test_canonical_urls(spark):
    cases = {"HTTP://Example.COM:80/A?b=C#d": "http://example.com/A?b=C", "https://x.org:443": "https://x.org/", "https://x.org:8443?q": "https://x.org:8443/?q",
             " http://x/?": "http://x/", "mailto:Me": "mailto:Me", "": "", "http://x:/y": "http://x/y"}
    df = spark.createDataFrame([(k,) for k in cases], "url string").select("url", canonical_url(F.col("url")).alias("c"))
    assert {r.url: r.c for r in df.collect()} == cases


def test_edges_of_the_input(spark):
    schema = RECORD + ", earlier string, slice long"
    assert resolve_revisits(spark.createDataFrame([], schema)).collect() == []
    at = [T0 + dt.timedelta(days=i) for i in range(3)]
    tag = {"ETAG": '"1"', "etag": '"2"'}
    rows = [(1, "response", "http://a/", at[0], 200, {"etag": '"1"'}, "d" * 1_000_000, "x", 1), (1, "response", "http://a/", at[0], 200, {"etag": '"1"'}, "d" * 1_000_000, "x", 1),
            (2, "revisit", "http://a", at[1], 304, tag, None, None, None), (None, "revisit", "http://a/", at[2], 304, tag, None, None, None),
            (3, "revisit", "http://a/", at[0], 304, tag, None, None, None), (4, "request", "http://a/", at[2], None, None, None, None, None)]
    got = {r.record_id: (r.resolution, r.original_id, r.headers) for r in resolve_revisits(spark.createDataFrame(rows, schema)).collect()}
    assert got == {2: ("resolved", 1, {"etag": '"1"'}), 3: ("no_earlier_response", None, None)}


def test_slices_hold_equal_shares_whatever_the_dates(spark, monkeypatch):
    """One record of 1970 beside a URL that has all others: the slices still part these."""
    import corpusflow.llm.revisits as m
    n = 4_000
    rows = [(0, "response", "http://hot/", dt.datetime(1970, 1, 2))]
    rows += [(i, "response" if i % 5 else "revisit", "http://hot/", T0 + dt.timedelta(seconds=i)) for i in range(1, n)]
    df = spark.createDataFrame(rows, "record_id long, record_type string, url string, date timestamp")
    seen = []

    class Spy(m.Bucketizer):
        def transform(self, line):
            out = super().transform(line)
            seen.append(out.groupBy("slice").count())
            return out

    monkeypatch.setattr(m, "Bucketizer", Spy)
    got = {r.record_id: r.original_id for r in m.latest_earlier(df, 32).collect()}
    assert got == {i: (i - 1 if (i - 1) % 5 or i == 1 else i - 2) for i in range(1, n) if i % 5 == 0}
    (sizes,) = [[r["count"] for r in s.collect()] for s in seen]
    assert len(sizes) == 32 and max(sizes) < 2 * n / 32
