"""Bloom cascades: exact over their universe; parts of addresses; rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from slugline.llm import url_cascade as U
from slugline.llm.queries import RULES, op5_url_cascade


@pytest.mark.parametrize("limit", [1 << 20, 600])
def test_exact_over_the_universe(spark, limit):
    source = random.Random(4)
    keys = [(f"host{k}.example", source.random() < 0.2) for k in range(4000)]
    universe = spark.createDataFrame(keys, "key string, listed boolean")
    rows = spark.createDataFrame([(k,) for k, _ in keys] + [(keys[0][0],), (None,)], "host string")
    told = U.add_listed(rows, universe, "host", limit).collect()
    want = dict(keys) | {None: False}
    assert len(told) == 4002 and all(r.listed == want[r.row.host] for r in told)
    levels = U.build_cascade(universe)
    assert len(levels) > 1


def test_no_keys_and_all_keys(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "host string")
    for listed in (True, False):
        universe = spark.createDataFrame([("a", listed), ("b", listed)], "key string, listed boolean")
        assert {r.listed for r in U.add_listed(rows, universe, "host").collect()} == {listed}
    empty = universe.limit(0)
    assert {r.listed for r in U.add_listed(rows, empty, "host").collect()} == {False}
    assert U.add_listed(rows.limit(0), empty, "host").count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 8])
def test_clashing_names_null_marks_and_long_keys(spark, limit):
    long = ["x" * 300_000 + end for end in "ab"]
    universe = spark.createDataFrame(
        [(long[0], True), (long[1], False), ("é", True), ("", False), ("n", None), (None, True)], "key string, listed boolean"
    ).withColumns({c: F.lit("theirs") for c in ("h1", "h2", "row")})
    names = ["host", "key", "listed", "h1", "h2", "row", "shard"]
    rows = spark.createDataFrame([(h, *["mine"] * 6) for h in [*long, "é", "é", "", "n", None]], ", ".join(f"{n} string" for n in names))
    told = U.add_listed(rows, universe, "host", limit).collect()
    assert all(r.row.asDict() == {"host": r.row.host, **dict.fromkeys(names[1:], "mine")} for r in told)
    assert sorted((str(r.row.host)[-1:], r.listed) for r in told) == sorted(
        [("a", True), ("b", False), ("é", True), ("é", True), ("", False), ("n", False), ("e", False)]
    )


def test_hosts_are_listed_by_their_pages(spark, tmp_path):
    """A host is blocked when a tenth of its pages holds junk, or for its name; rules come first."""
    rows = [(k, f"http://junk.net/{k}", "a *** b" if k == 0 else "a ** b %") for k in range(10)]
    rows += [(20 + k, f"http://fine.net/{k}", "$$$" if k == 0 else None) for k in range(11)]
    rows += [(40, "http://x.free-bets.net/", None), (41, "http://free-bets.org/", "***"), (42, None, "***"), (43, "http://A.com/de/", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    told = {r.page_id: (r.rule, r.verdict) for r in op5_url_cascade(spark, str(tmp_path)).collect()}
    assert len(told) == len(rows) and {told[k] for k in range(10)} == {(None, "block")}
    assert {told[k] for k in range(20, 31)} == {(None, "allow")}
    assert [told[k] for k in range(40, 44)] == [(None, "block"), ("org/", "allow"), (None, "block"), ("com/de/", "block")]


def plain_parts(url):
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [(len(h + p), h + p, said) for said, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_parts_and_rules(spark):
    urls = [
        None, "", "nothing", "http://", "HTTP://Ex.ORG/a://b/c?d#e", "x://a.org", "https://example.org/en/12#x",
        "https://A.example.org/es/?q", "ftp://badexample.org/es/", "http://w.com/fr/x", "http://com/de/", "http://É.com?/fr/",
        "http://a\nb.org/x\ny", "://h/p", "http://example.org/en/2", "http://x.org?/",
    ]
    host, path = U.url_host(F.col("url")), U.url_path(F.col("url"))
    frame = spark.createDataFrame([(u,) for u in urls], "url string").select("url", host.alias("h"), path.alias("p"))
    rule, verdict = U.longest_rule(F.col("h"), F.col("p"), RULES)
    for row in frame.select("*", rule.alias("r"), verdict.alias("v")).collect():
        assert (row.h, row.p) == plain_parts(row.url), row.url
        assert (row.r, row.v) == plain_rule(row.h, row.p), row.url
