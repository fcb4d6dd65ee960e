from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from weftline.llm import url_rules as U

FIXED = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
URLS = [
    ("https://Www.Example.COM/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
    ("http://example.com/fr/", "example.com", "/fr/", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("x://y.net?/es/", "y.net", "", None, "allow"),
    ("x://y.net/es/#?", "y.net", "/es/", "net/es/", "block"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def labelled(spark):
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        host = "spam.example.org" if bad or i % 40 == 1 else f"h{i % 5}.example.org"
        rows.append((f"http://{host}/{'win' if bad and i % 8 else 'page'}/{i}", bad if i % 50 else None))
    return spark.createDataFrame([*rows, (None, True), ("nothing", True)], "url string, bad boolean")


def brute_rules(rows, support, confidence, most=3):
    rows = [(set(r["t"]), r["bad"]) for r in rows]
    found = {}
    for size in range(1, most + 1):
        for combination in {c for t, _ in rows for c in combinations(sorted(t), size)}:
            hit = [bad for t, bad in rows if t >= set(combination)]
            if sum(hit) >= support * len(rows) and sum(hit) >= confidence * len(hit):
                found[combination] = (sum(hit) / len(hit), sum(hit) / len(rows))
    return {r: v for r, v in found.items() if not any(set(s) < set(r) for s in found)}


def test_rules_equal_an_exhaustive_count(spark):
    frame = labelled(spark)
    known = frame.select(U.tokens_of(F.col("url")).alias("t"), "bad").where("t IS NOT NULL AND bad IS NOT NULL").collect()
    got = {tuple(r["rule"]): (r["confidence"], r["support"]) for r in U.spelled_out(U.mine_rules(frame, 0.02, 0.7)).collect()}
    assert got == brute_rules(known, 0.02, 0.7)
    assert ("host:spam",) in got


def test_rules_of_more_than_three_tokens(spark):
    """Bad only where host label, two path segments and query key meet; each subset of three is bad less often."""
    rows = []
    for i in range(480):
        parts = [i >> k & 1 for k in range(4)] if i % 2 else [1, 1, 1, 1]
        a, b, c, d = (x if p else x + "z" for p, x in zip(parts, "abcd"))
        rows.append((f"http://{a}.org/{b}/{c}?{d}={i}", all(parts) and i % 5 > 0))
    for k in range(4):
        a, b, c, d = (x if j != k else x + "z" for j, x in enumerate("abcd"))
        rows += [(f"http://{a}.org/{b}/{c}?{d}={i}", False) for i in range(200)]
    frame = spark.createDataFrame(rows, "url string, bad boolean")
    known = frame.select(U.tokens_of(F.col("url")).alias("t"), "bad").collect()
    got = {tuple(r["rule"]): (r["confidence"], r["support"]) for r in U.spelled_out(U.mine_rules(frame)).collect()}
    assert got == brute_rules(known, 0.002, 0.6, most=8)
    assert ("host:a", "path:b", "path:c", "query:d") in got


def test_rules_whose_rows_come_late(spark):
    """A bad host whose rows all come after the first 100,000 labelled rows."""
    early = spark.range(0, 101_000, 1, 1).select(F.format_string("http://h%d.org/p", F.col("id") % 3).alias("url"), F.lit(False).alias("bad"))
    late = spark.range(0, 1000, 1, 1).select(F.lit("http://spam.org/p").alias("url"), F.lit(True).alias("bad"))
    got = U.spelled_out(U.mine_rules(early.union(late))).collect()
    assert [(tuple(r["rule"]), r["confidence"], r["support"]) for r in got] == [(("host:spam",), 1.0, 1000 / 102_000)]


def test_a_template_of_many_tokens(spark):
    """Thirty tokens that are always together are one item; any of them alone is enough to block."""
    keys = "&".join(f"k{chr(97 + i)}=1" for i in range(25))
    row = F.when(F.col("id") % 100 == 0, F.lit(f"http://trap.org/a/b/c?{keys}")).otherwise(F.format_string("http://h%d.org/p", F.col("id") % 9))
    frame = spark.range(20_000).select(row.alias("url"), (F.col("id") % 100 == 0).alias("bad"))
    rules = U.mine_rules(frame)
    assert [(len(r["rule"]), len(r["rule"][0]), r["confidence"], r["support"]) for r in rules.collect()] == [(1, 29, 1.0, 0.01)]
    pages = spark.createDataFrame([("http://trap.org/",), ("http://x.org/b?q=1",), ("http://x.org/q?q=1",), ("http://h1.org/p",)], "url string")
    got = {r["url"]: r["verdict"] for r in U.filter_urls(pages, frame, []).collect()}
    assert got == {"http://trap.org/": "block", "http://x.org/b?q=1": "block", "http://x.org/q?q=1": "allow", "http://h1.org/p": "allow"}


def test_items_of_two_sets_keep_every_combination(spark):
    """Bad where two templates of two tokens each meet; the rules are all four pairs."""
    kinds = [("http://a.org/b/c/d", True), ("http://a.org/b/x", False), ("http://y.org/c/d", False), ("http://y.org/x", False)]
    frame = spark.createDataFrame([kinds[i % 4] for i in range(400)], "url string, bad boolean")
    known = frame.select(U.tokens_of(F.col("url")).alias("t"), "bad").collect()
    got = {tuple(r["rule"]): (r["confidence"], r["support"]) for r in U.spelled_out(U.mine_rules(frame, 0.02, 0.7)).collect()}
    assert got == brute_rules(known, 0.02, 0.7, most=6) and len(got) == 4


def test_mined_rules_block_and_fixed_rules_win(spark):
    pages = spark.createDataFrame(
        [(1, "http://spam.example.org/page/1"), (2, "http://h1.example.org/page/1"), (3, "http://spam.example.com/page/1"), (1, "http://spam.example.org/page/1")],
        "page_id long, url string",
    )
    got = U.filter_urls(pages, labelled(spark), FIXED, min_support=0.02, min_confidence=0.7).collect()
    assert sorted((r["page_id"], r["rule"], r["verdict"]) for r in got if r["page_id"] != 3) == [(1, None, "block"), (1, None, "block"), (2, None, "allow")]
    assert [(r["rule"], r["verdict"]) for r in got if r["page_id"] == 3] == [("com/", "allow")]


def test_hosts_paths_and_fixed_rules(spark):
    pages = spark.createDataFrame([(u[0], i, "clash") for i, u in enumerate(URLS)], "url string, page_id int, rule string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = U.filter_urls(pages, none, FIXED).orderBy("page_id").collect()
    assert [(r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == URLS


def test_empty_pages(spark):
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string"), labelled(spark), FIXED).count() == 0
