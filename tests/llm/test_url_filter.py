"""URL rules, and exact membership in cascades."""

import numpy as np
import pytest

from regulink.llm import url_filter as uf
from conftest import rows


def test_cascade_is_exact():
    dealt = np.random.default_rng(1)
    for n, share in ((1, 1.0), (5, 0.5), (30_000, 0.01), (30_000, 0.5), (30_000, 0.99), (100, 0.0)):
        h1, h2 = (dealt.integers(-(1 << 63), (1 << 63) - 1, n) for _ in range(2))
        listed = dealt.random(n) < share
        filters = uf.build_cascade(h1, h2, listed)
        assert (uf.probe(filters, h1, h2) == listed).all()


URLS = {
    1: ("http://Sub.Example.com/en/1?x", "sub.example.com", "/en/1", "example.com/en/", "block"),
    2: ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    3: ("x://a.www.example.com/en/?/fr/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    4: ("http://example.com/fr/en/", "example.com", "/fr/en/", "com/", "allow"),
    5: ("http://notexample.com", "notexample.com", "", None, "allow"),
    6: ("http://a.net/fr/", "a.net", "/fr/", "net/fr/", "block"),
    7: ("http://a.net?/fr/", "a.net", "", None, "allow"),
    8: ("http://spam.org/en/", "spam.org", "/en/", None, "block"),
    9: ("no scheme", "", "", None, "allow"),
    10: (None, "", "", None, "allow"),
    11: ("http://", "", "", None, "allow"),
    12: ("", "", "", None, "allow"),
    13: ("http://É.org/ä#/", "É.org", "/ä", None, "allow"),
}


@pytest.mark.parametrize("most", [1 << 20, -1])
def test_verdicts(spark, monkeypatch, most):
    monkeypatch.setattr(uf.add_membership, "__defaults__", (most,))
    monkeypatch.setattr(uf, "PROBE_SALTS", 3)
    df = spark.createDataFrame(
        [(k, v[0], "z") for k, v in URLS.items()] * 2, "page_id long, url string, host string"
    )
    assert rows(uf.judge_urls(df)) == sorted([(k, *v[1:]) for k, v in URLS.items()] * 2, key=repr)


def test_many_shards(spark):
    keys = spark.range(3000).selectExpr("cast(id as string) key", "id % 7 = 0 listed")
    asked = uf.add_membership(keys.select("key"), "key", uf.cascades(keys, shard_keys=200))
    assert asked.where("listed <> (cast(key as long) % 7 = 0)").isEmpty()


def test_empty_table(spark):
    assert uf.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_kinds_of_hosts(spark):
    hosts = {
        "adult-x.example.net": "block", "free-bets.example.org": "block", "m.ads-track.org": "block", "mycasino1.net": "block",
        "shadow.org": "allow", "essex.org": "allow", "abet.net": "allow", "adapt.example.org": "allow", "": "allow",
    }
    df = spark.createDataFrame([(k, f"http://{h}/x") for k, h in enumerate(hosts)], "page_id long, url string")
    got = {r["host"]: r["verdict"] for r in uf.judge_urls(df).collect()}
    assert got == hosts


def test_a_block_list_covers_subdomains(spark):
    listed = spark.createDataFrame([("Bad.org",), ("x.y.net",), ("x.y.net",), ("",), (None,)], "host string")
    hosts = {
        "bad.org": "block", "a.b.bad.org": "block", "notbad.org": "allow", "org": "allow", "x.y.net": "block",
        "y.net": "allow", "z.x.y.net": "block", "x.y.net.org": "allow", "": "allow", ".": "allow",
    }
    df = spark.createDataFrame([(k, f"http://{h}") for k, h in enumerate(hosts)] * 2 + [(99, None)], "page_id long, url string")
    got = {r["host"]: r["verdict"] for r in uf.judge_urls(df, block_list=listed).collect()}
    assert got == hosts
    assert uf.judge_urls(df, block_list=listed.limit(0)).where("verdict = 'block'").isEmpty()


def test_verdicts_come_from_the_cascade(spark, monkeypatch):
    df = spark.createDataFrame(
        [(k, f"http://{'bets' if k % 3 == 0 else 'news'}.h{k}.org/") for k in range(6000)], "page_id long, url string"
    )
    wrong = "verdict <> if(page_id % 3 = 0, 'block', 'allow')"
    assert uf.judge_urls(df).where(wrong).isEmpty()
    whole = uf.build_cascade
    monkeypatch.setattr(uf, "cascades", lambda u: _first_level(u, whole))
    assert 0 < uf.judge_urls(df).where(wrong).count() < 200


def _first_level(universe, build):
    """Cascades with all levels but the first left out."""
    spark = universe.sparkSession
    part = universe.select(*uf.key_hashes(uf.F.col("key")), "listed").distinct().toPandas()
    filters = build(part["_h1"].to_numpy(), part["_h2"].to_numpy(), part["listed"].to_numpy())
    assert len(filters) > 1
    return spark.createDataFrame([(0, [filters[0].tobytes()], 1)], "shard long, filters array<binary>, shards long")
