import os
import random

import pytest
from oracle import same

from lathe.llm import linededup as L

SF = "/root/testdata/sf0.001"


def test_like_sql(spark, tmp_path):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(2000)]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 15)))
    common = [line() for _ in range(6)]
    user = lambda: f"a user has logged in as {rng.choice(words)} from host h{rng.randrange(99)} at the usual  time"
    docs = []
    for i in range(50):
        docs.append("\n".join(rng.choice([line, line, user, lambda: rng.choice(common)])() for _ in range(rng.randrange(1, 12))))
    docs += ["1999\nAll rights reserved.", "All  rights reserved.\n1999\n\n", "v1 v2\nv1 v3"]
    for k in range(700):  # fifteen families, and other lines, under one beginning
        f = k % 15
        own = words[7 * f : 7 * f + 7]
        docs.append(f"at that time the {' '.join(own)} {words[700 + k]}" if k < 400 else f"at that time the {' '.join(rng.choice(words) for _ in range(9))}")
    docs += ["", "\n\n", docs[3], "short line\nshort line", "the same long line again here\nthe same long line again here", " \tlead and trail the white space \t"]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    same(L.query(spark, str(tmp_path)), L.ORACLE_SQL, str(tmp_path))
    got = {r.doc_id: r for r in L.query(spark, str(tmp_path)).collect()}
    assert sum("has logged in" in r.text for r in got.values()) <= 2  # one template, of which the first line stays
    assert 300 <= sum("at that time the" in r.text for r in got.values()) < 300 + 30  # each family is found among the others
    at = {d: i for i, d in enumerate(docs)}
    for alone in ("short line\nshort line", " \tlead and trail the white space \t"):
        assert got[at[alone]].n_dropped == 0 and got[at[alone]].text == alone
    assert got[at["All  rights reserved.\n1999\n\n"]].text == "\n" and got[at["v1 v2\nv1 v3"]].n_dropped == 0


def test_hot_lines_are_spread_and_the_same_ones_go(spark, monkeypatch):
    from lathe.llm import common

    rows = [(i, f"a line that all of them share\nown {i} words {'x' * (i % 50)} here now\nlogged in as user{'abc'[i % 3]} from there once") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = sorted(map(tuple, L.drop_recurring(df).collect()))
    monkeypatch.setattr(common, "HOT_KEYS", 3)
    assert sorted(map(tuple, L.drop_recurring(df).collect())) == want and sum(r[3] for r in want) > 500


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_like_sql_on_a_table(spark):
    same(L.query(spark, SF), L.ORACLE_SQL, SF)


def test_nulls_repeats_and_clashing_names(spark):
    a, b = "one two three four five six", "a b c d e f"
    df = spark.createDataFrame([(None, a, "x", 1), (5, f"{a}\n{b}", "y", 2), (5, f"{a}\n{b}", "y", 2), (6, None, "z", 3), (7, b, "w", 4)], "doc_id long, text string, id string, n_lines int")
    got = sorted((str(r.doc_id), r.id, r.text, r.n_dropped) for r in L.drop_recurring(df).collect() if r.text is not None)
    assert got == [("5", "y", b, 1), ("5", "y", b, 1), ("7", "w", "", 1), ("None", "x", a, 0)]
    assert L.drop_recurring(df).filter("text is null").count() == 1
    assert L.drop_recurring(df.limit(0)).count() == 0
