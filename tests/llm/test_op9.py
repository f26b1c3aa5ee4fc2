import random

import pytest
from oracle import same

from lathe.llm import common
from lathe.llm import urlrules as U


def test_query_like_sql(spark, tmp_path):
    rng = random.Random(2)
    hosts = ["example.org", "www.Example.ORG", "org", "com", "a.b.com", "xcom", "notexample.org", "example.org.", "", "é.org", "net", "m.example.com"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?x=1", "/fr/9#top", "/de/1", "?q", "#f", "/es/a/b", "/FR/"]
    urls = [f"{rng.choice(['http', 'https'])}://{h}{p}" for h in hosts for p in paths]
    urls += [None, "", "no scheme/es/", "://org/", "x://y://org/", "http://org", "http://com/fr/\U0010ffffz", "http://a b.org/ x", "http://b org/en/1"] + ["http://org/hot"] * 200
    spark.createDataFrame([(i, u, "k", 3) for i, u in enumerate(urls)], "page_id long, url string, key string, range int").repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    same(U.query(spark, str(tmp_path)), U.ORACLE_SQL, str(tmp_path))


@pytest.mark.parametrize("block, hot", [(64, 1000), (3, 2)])
def test_many_nested_rules_like_brute_force(spark, monkeypatch, block, hot):
    monkeypatch.setattr(U, "BLOCK", block)
    monkeypatch.setattr(common, "HOT_KEYS", hot)
    rng = random.Random(4)
    host = lambda: ".".join(rng.choice("ab") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 4)))
    path = lambda: "/" + "".join(rng.choice("ab/") for _ in range(rng.randrange(0, 5)))
    rules = sorted({host() + path() for _ in range(150)})
    verdict = {r: rng.choice(["allow", "block"]) for r in rules}
    urls = ["http://" + host() + path() for _ in range(600)]
    df = U.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(6), spark.createDataFrame(list(verdict.items()), "rule string, verdict string"), "none")
    for r in df.collect():
        h, p = urls[r.page_id][7:].split("/", 1)
        p = "/" + p
        fit = [x for x in rules if ("." + h).endswith("." + x.split("/", 1)[0]) and p.startswith("/" + x.split("/", 1)[1])]
        want = max(fit, key=lambda x: (len(x), x), default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (h, p, want, verdict.get(want, "none"))


def test_very_long_url_and_rule_and_clashing_names(spark):
    long = "/a" * 1000
    rules = spark.createDataFrame([(f"x{long}", "block"), ("x/", "allow")], "rule string, verdict string")
    urls = ["http://x" + "/a" * 200_000, f"http://x{long[:-1]}", None]
    df = spark.createDataFrame([(i, u, "h", "p", 1) for i, u in enumerate(urls)], "page_id int, url string, host string, path string, rule int")
    got = {r.page_id: (r.rule, r.verdict) for r in U.judge(df, rules).collect()}
    assert got == {0: (f"x{long}", "block"), 1: ("x/", "allow"), 2: (None, "allow")}


def test_empty_table(spark):
    rules = spark.createDataFrame([("a/", "block")], "rule string, verdict string")
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    assert U.judge(spark.createDataFrame([(1, "http://a/")], "page_id long, url string"), rules.limit(0)).first().verdict == "allow"
