import math
import os
import re

import numpy as np
import pytest

from lathe.llm import quality as Q

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_held_out_accuracy(spark):
    found = Q.query(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert len(rows) > 50 and right > 0.93, right
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.predicted == 0 for r in bad) / len(bad) > 0.7
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_rules_in_columns_like_plain_evaluation(spark):
    model = Q.RuleModel(0.5, ((("upper", True, 0.3), ("words", False, 10.0)), (("bars", True, 0.0),)), (-2.0, 1.5))
    df = spark.createDataFrame([("ABC DEF",), ("a | b",), ("",), (None,), ("plain " * 5000,)], "text string")
    got = [r.score for r in Q.score(df.withColumn("score", Q.F.lit("x")), model).collect()]
    logistic = lambda z: 1 / (1 + math.exp(-z))
    assert got == pytest.approx([logistic(-1.5), logistic(2.0), logistic(0.5), logistic(0.5), logistic(0.5)])


TEXTS = ["", None, "One two, three. FOUR!\nfive | six * seven", "A" * 9, "a b a b\na  b", " lead\ttab ", "É É 12 34#", "Der Hund, die Katze.", "\n\n", "!", "mixed\u00a0space", "x_y Ab aB Abc", "long line " * 4000]


def plain_statistics(t):
    """The statistics in plain Python, from their description."""
    t = t or ""
    n, words = len(t), len(re.findall(r"[^ \t\n\x0b\f\r]+", t))
    share = lambda a, b: a / b if b else 0.0
    capital = [k for k in range(n - 1) if "A" <= t[k] <= "Z" and "a" <= t[k + 1] <= "z" and not (k and re.match(r"[A-Za-z0-9_]", t[k - 1]))]
    return {
        "chars": n, "words": words, "lines": t.count("\n") + (n > 0), "word_length": share(n, words),
        "upper": share(sum("A" <= c <= "Z" for c in t), n), "digits": share(sum("0" <= c <= "9" for c in t), n), "marks": share(sum(c in "#$%&*!|<>=_~^" for c in t), words),
        "exclaimed": share(t.count("!"), words), "bars": share(t.count("|"), words), "starred": share(t.count("*"), words), "stops": share(t.count("."), words), "commas": share(t.count(","), words),
        "capitalised": share(len(capital), words), "distinct": share(len(set(t.replace("\n", " ").split(" "))), words),
    }


def test_statistics_like_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    parts = Q.statistics(Q.text_of("text"))
    got = {r.i: r.asDict() for r in df.select("i", *(c.alias(n) for n, c in parts.items())).collect()}
    for i, t in enumerate(TEXTS):
        want = plain_statistics(t)
        assert got[i].keys() - {"i"} == want.keys()
        assert {k: got[i][k] for k in want} == pytest.approx(want), t


def test_fit_finds_a_planted_rule_and_is_the_same_each_time():
    rng = np.random.default_rng(4)
    x = rng.random((4000, 5))
    y = ((x[:, 1] > 0.6) & (x[:, 3] <= 0.4)).astype(float)
    names = list("abcde")
    model = Q.fit_rows(x, y, names)
    z = model.bias + sum(w * Q._holds(x, [(names.index(s), above, t) for s, above, t in r]) for r, w in zip(model.rules, model.weights))
    assert ((z > 0) == y).mean() > 0.98
    assert model == Q.fit_rows(x, y, names) and len(model.rules) < 60


def test_repeated_rows_do_not_change_the_fit(spark):
    docs = spark.createDataFrame([(i, ("good words here. " if i % 2 else "BAD!! ") * (1 + i % 7)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    once, twice = Q.fit(docs, labels), Q.fit(docs.union(docs), labels.union(labels))
    assert once == twice and once.rules


def test_a_filter_on_the_score_evaluates_no_statistic(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b c")], "doc_id long, text string")
    model = Q.RuleModel(0.5, ((("distinct", True, 0.3), ("words", False, 10.0)), (("distinct", True, 0.9),)), (-2.0, 1.5))
    plan = Q.score(docs, model).filter("score > 0.1").select("doc_id")._jdf.queryExecution().optimizedPlan().toString()
    filters = [x for x in plan.splitlines() if "Filter" in x]
    assert len(filters) == 1 and not any(x in filters[0] for x in ("CASE", "regexp", "distinct", "statistics"))


def test_few_or_no_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (2, None), (None, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    assert Q.score(docs, Q.fit(docs, labels.limit(0))).first().score == 0.5
    assert Q.score(docs, Q.fit(docs, labels)).first().score == pytest.approx(0.999)
    assert Q.score(docs.limit(0), Q.RuleModel()).count() == 0
