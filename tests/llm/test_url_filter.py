import pytest
from pyspark.sql import functions as F

from userflow.llm import url_filter
from userflow.llm.queries import URL_RULES


def keys(spark, values):
    return spark.createDataFrame([(v, 1) for v in values], "key string, listed_at int")


def test_membership_is_exact(spark):
    listed = [f"bad{i}.example/{i}" for i in range(3000)] + ["not/in/corpus", None, "bad1.example/1"]
    universe = [f"good{i}.example/{i}" for i in range(60_000)] + listed * 2 + ["", None]
    built = url_filter.cascade(keys(spark, listed), keys(spark, universe))
    assert len(built.levels) > 1
    found = keys(spark, universe).select("key", built.contains(F.col("key")).alias("in")).collect()
    assert all(r["in"] == (r.key is not None and r.key in set(listed)) for r in found)
    plan = keys(spark, universe).where(built.contains(F.col("key")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


COLLIDING = ("ads.org/", "agl.org/HMbBre;S")  # one xxhash64


def test_colliding_keys_end(spark):
    hashed = keys(spark, COLLIDING).select(F.xxhash64("key").alias("h")).distinct().count()
    built = url_filter.cascade(keys(spark, COLLIDING[:1]), keys(spark, [*COLLIDING, "c.org/"]))
    assert hashed == 1 and len(built.levels) < url_filter.MOST_LEVELS
    found = keys(spark, [*COLLIDING, "c.org/", None]).select("key", built.contains(F.col("key")).alias("in")).collect()
    assert {r.key: r["in"] for r in found} == {COLLIDING[0]: True, COLLIDING[1]: False, "c.org/": False, None: False}


@pytest.mark.parametrize("levels", [1, 2, 3])
@pytest.mark.parametrize("residue", [url_filter.MOST_RESIDUE, 1])
def test_the_residue_is_exact(spark, monkeypatch, levels, residue):
    monkeypatch.setattr(url_filter, "MOST_LEVELS", levels)
    monkeypatch.setattr(url_filter, "MOST_RESIDUE", residue)
    for name in ("FIRST_HASHES", "LATER_HASHES"):  # many keys pass each level
        monkeypatch.setattr(url_filter, name, 1)
    listed = [f"bad{i}" for i in range(8000)]
    rows = keys(spark, listed + [f"good{i}" for i in range(20_000)] + [None])
    built = url_filter.cascade(keys(spark, listed), rows)
    assert built is not None or residue == 1
    assert (built is None) == (residue == 1) or levels == 3  # so few are left
    if built is not None:
        assert len(built.levels) == levels and built.residue is not None
    flags = url_filter.with_listed(rows, keys(spark, listed))
    assert flags.count() == 28_001
    assert flags.where(F.col("listed") != F.coalesce(F.col("key").startswith("bad"), F.lit(False))).isEmpty()


@pytest.mark.parametrize("most", [url_filter.MOST_KEYS, 1])
def test_listed_flags(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "MOST_KEYS", most)
    rows = keys(spark, ["a", "b", "b", None, ""])
    assert [r.listed for r in url_filter.with_listed(rows, keys(spark, ["b", "z", None])).collect()] == [False, True, True, False, False]
    assert not any(r.listed for r in url_filter.with_listed(rows, keys(spark, [])).collect())
    assert url_filter.with_listed(keys(spark, []), keys(spark, ["b"])).collect() == []


def test_rules_and_parts(spark):
    cases = {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "no scheme.org/x": ("", "", None, "allow"),
        "http://A.ORG/x?q#f": ("a.org", "/x", "org/", "allow"),
        "http://a.org": ("a.org", "", None, "allow"),
        "http://borg/x": ("borg", "/x", None, "allow"),
        "http://org/x": ("org", "/x", "org/", "allow"),
        "HTTPS://www.Example.org/es/1": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/19": ("example.org", "/en/19", "example.org/en/1", "block"),
        "http://notexample.org/en/19": ("notexample.org", "/en/19", "org/", "allow"),
        "x://example.com/de/?a://b.org/es/": ("example.com", "/de/", "com/de/", "block"),
        "a\nb://c.com?x/fr/": ("c.com", "", None, "allow"),
        "http://listed.net/p#x": ("listed.net", "/p", None, "block"),
        "http://É.org/É": ("É.org", "/É", "org/", "allow"),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)] * 2 + [(None, None, None)], "page_id long, url string, host string")
    got = url_filter.filter_urls(pages, URL_RULES, keys(spark, ["listed.net/p"])).collect()
    assert len(got) == 2 * len(cases) + 1
    want = list(cases.values())
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == want[r.page_id or 0]
