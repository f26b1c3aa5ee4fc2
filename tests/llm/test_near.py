import os
import random

import corpus_pipeline as C
import pytest

from lathe.llm import nearsets as N


def brute_first(texts):
    """The least document of each component of pairs at Jaccard 0.8 or more."""
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linked = 0
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                linked += a != sets[j]
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in range(len(sets))}, linked


def edited_copies(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = ["", " ", "one", "ONE", "one two"]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([30, 120, 400]))]
        texts.append(" ".join(base))
        for k in range(6):
            t = list(base)
            for _ in range(1 + k * len(t) // 120):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    base = [word() for _ in range(150)]
    for _ in range(60):  # a crowd, in part a chain
        t = list(base)
        for _ in range(rng.randrange(1, 4)):
            t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t))
        base = t if rng.random() < 0.3 else base
    shared = [word() for _ in range(14)]  # crowded shingles in texts that are mostly not alike
    texts += [" ".join([*shared, *(word() for _ in range(rng.randrange(2, 9)))]) for _ in range(40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("crowded, leaders, demoted", [(16, 4, 200_000), (2, 1, 0)])
def test_near_stage_links_edited_copies_like_brute_force(spark, tmp_path, monkeypatch, crowded, leaders, demoted):
    for name, value in (("CROWDED", crowded), ("LEADERS", leaders), ("DEMOTED", demoted)):
        monkeypatch.setattr(N, name, value)
    texts = edited_copies(crowded)
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want, linked = brute_first(texts)
    assert linked > 100 and len(want) > 20
    got = [r.doc_id for r in C.near_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_null_and_repeated_ids_lose_near_duplicates_only(spark, tmp_path):
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(None, a), (None, b), (None, c), (None, c), (7, d), (7, e), (7, e), (8, a), (9, f"{b} more")]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = C.near_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert got.columns == C.COLUMNS
    assert sorted(((str(r.doc_id), r.text) for r in got.collect())) == sorted([("8", a), ("9", f"{b} more"), ("None", c), ("7", d), ("7", e)])


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_recall_on_a_table(spark):
    """All pairs of different sets at 0.8 or more, and only these, decide which documents of the raw table stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    words = [t.encode().lower().split() for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    having, root, linked = {}, list(range(len(sets))), 0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        shared = {}
        for g in a:
            for j in having.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            having[g].append(i)
        for j, n in shared.items():
            if 5 * n >= 4 * (len(a) + len(sets[j]) - n):
                linked += a != sets[j]
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert linked >= 5 and all(sets[:1])
    got = [r.doc_id for r in C.near_stage(spark, docs, SF).collect()]
    empty = [i for i, a in enumerate(sets) if not a]
    want = {rows[find(i)][0] for i in range(len(sets)) if i not in empty[1:]}
    assert sorted(got) == sorted(want)


def test_a_sieve_lets_every_key_through(spark, monkeypatch):
    from pyspark.sql import functions as F

    from lathe.llm import common

    df = spark.createDataFrame([(k - 500, None if k % 7 else "x") for k in range(1000)], "k long, s string")
    keys = df.filter("k % 10 = 0")
    for words, most in ((1 << 18, 10), (1, 1000)):  # few bits: nearly all rows may be keys
        monkeypatch.setattr(common, "SIEVE", words)
        for key in (F.col("k"), F.xxhash64("k", "s")):
            got = common.sieved(df, keys, key, "met").collect()
            assert len(got) == 1000 and all(r.met for r in got if r.k % 10 == 0)
            assert sum(r.met and r.k % 10 != 0 for r in got) <= most
    assert not any(r.met for r in common.sieved(df, keys.limit(0), F.col("k"), "met").collect())
