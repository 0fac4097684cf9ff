import pytest

from touchline.llm import warc

RECORD = "record_id bigint, kind string, url string, fetched_at bigint, headers map<string,string>, etag string, uid int"


def solve(spark, rows):
    docs = spark.createDataFrame([(*r, "own", 1) for r in rows], RECORD)
    return {r.record_id: r for r in warc.resolve(docs).collect()}


def test_statuses(spark):
    day = 86400
    got = solve(spark, [
        (1, "response", "http://A.org:80/x/#top", 10, {"ETag": '"v1"', "Content-Type": "text/html", "X": "old"}),
        (2, "revisit", "https://a.org/x?utm_source=y", 20, {"etag": 'W/"v1"', "content-type": "no", "Date": "now", "x": "new"}),
        (3, "response", "a.org/x", 30, {"ETag": '"v2"'}),
        (4, "revisit", "a.org/x", 30, {"ETag": '"v1"'}),
        (5, "revisit", "a.org/x", 40 * day, {"ETag": '"v1"'}),
        (6, "revisit", "a.org/x", 41 * day, {"ETag": '"v2"'}),
        (7, "revisit", "b.org/", 5, {"ETag": '"v1"'}),
        (8, "response", "b.org", 6, None),
        (9, "revisit", "b.org", 7, {"ETag": '"v1"'}),
        (10, "response", "c.org/?b=2&a=1", 1, {"Last-Modified": "Mon"}),
        (11, "revisit", "c.org?a=1&b=2", 2, {"Last-Modified": "Mon", "ETag": '"z"'}),
        (12, "revisit", "c.org?a=1&b=2", 3, {"Last-Modified": "Tue"}),
        (13, "revisit", None, 3, None), (14, "revisit", "c.org", None, None), (15, "other", "c.org", 1, None), (16, None, "c.org", 1, None),
    ])
    assert {k: r.status for k, r in got.items()} == {
        1: "full", 2: "resolved", 3: "full", 4: "resolved", 5: "changed", 6: "resolved", 7: "unmatched", 8: "full", 9: "unverified",
        10: "full", 11: "resolved", 12: "changed", 13: "unmatched", 14: "unmatched", 15: "unmatched", 16: "unmatched",
    }
    assert got[2].source_id == 1 and got[4].source_id == 1 and got[6].source_id == 3 and got[5].source_id is None
    assert got[2].merged == {"etag": '"v1"', "content-type": "text/html", "x": "new", "date": "now"}
    assert got[2].canonical == got[1].canonical == "a.org/x"


def test_ties_and_repeats(spark):
    got = solve(spark, [(1, "response", "a", 5, {"ETag": "p"}), (2, "response", "a", 5, {"ETag": "q"}), (3, "revisit", "a", 6, {"ETag": "q"})])
    assert got[3].source_id == 2
    rows = [(1, "response", "a", 5, {"ETag": "p"})] * 2 + [(3, "revisit", "a", 6, {"ETag": "p"})] * 2
    docs = spark.createDataFrame([(*r, "own", 1) for r in rows], RECORD)
    assert sorted(r.status for r in warc.resolve(docs).collect()) == ["full", "full", "resolved", "resolved"]
    assert warc.resolve(docs.filter("record_id > 9")).count() == 0


def test_against_brute_force(spark):
    import random

    draw = random.Random(1)
    rows = [
        (k, draw.choice(["response", "revisit", "revisit"]), draw.choice(["a", "b", "c", "d/e"]), draw.randrange(0, 20) * 40000,
         {"ETag": draw.choice("pq")}) for k in range(200)
    ]
    got = solve(spark, rows)
    for record_id, kind, url, at, headers in rows:
        if kind == "revisit":
            before = [r for r in rows if r[1] == "response" and r[2] == url and r[3] < at]
            best = max(before, key=lambda r: (r[3], r[0]), default=None)
            want = "unmatched" if best is None else "resolved" if best[4] == headers else "changed"
            assert got[record_id].status == want
            assert got[record_id].source_id == (best[0] if want == "resolved" else None)


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "<p>"), (2, None, "<p>"), (3, "http://b.org", None)], "page_id bigint, url string, html string")
    found = warc.resolve(warc.records_of(pages)).collect()
    assert len(found) == 12 and sum(r.status == "resolved" for r in found) >= 3
