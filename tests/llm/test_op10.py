import os
import random
from collections import Counter

import numpy as np
import pytest

from lathe.llm import decontaminate as D


def plain_score(item, doc):
    best, row = 0, [0] * (len(doc) + 1)
    for x in item:
        now = [0]
        for j, y in enumerate(doc, 1):
            now.append(max(0, row[j - 1] + (2 if x == y else -1), row[j] - 1, now[-1] - 1))
        best, row = max(best, *now), now
    return best / (2 * len(item))


def test_like_alignment_of_every_pair(spark, tmp_path):
    rng = random.Random(6)
    vocab = ["the", "of", "and"] * 30 + ["".join(rng.choice("abcdefgé") for _ in range(5)) for _ in range(400)]
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [some(rng.randrange(12, 40)) for _ in range(15)] + [["two", "words"], []]
    docs = [" ".join(some(rng.choice([0, 5, 150]))) for _ in range(40)]
    for k in range(60):
        passage = list(items[k % 15])
        for _ in range(k // 15 * 2):
            at = rng.randrange(len(passage))
            passage[at : at + rng.randrange(2)] = some(rng.randrange(2))
        docs.append(" ".join(some(rng.randrange(80)) + [w.upper() if k % 2 else w + "," for w in passage] + some(rng.randrange(80))))
    docs += [None, "", docs[-1]] + [" ".join(items[3])] * 30
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.score for r in D.query(spark, str(tmp_path)).collect()}
    want = {}
    for i, d in enumerate(docs):
        for k, t in enumerate(items):
            if len(t) >= 3 and (s := plain_score(t, D.words_of(d))) >= D.LEAST:
                want[i, k] = s
    assert got.keys() <= want.keys() and len(want) > 80
    assert all(abs(got[x] - want[x]) < 1e-9 for x in got)
    for i, k in want.keys() - got.keys():  # only where every run of five words was edited
        runs = {tuple(items[k][a : a + 5]) for a in range(len(items[k]) - 4)}
        w = D.words_of(docs[i])
        assert not runs & {tuple(w[a : a + 5]) for a in range(len(w) - 4)}
    assert len(want.keys() - got.keys()) < 0.03 * len(want)


def plain_places(item, doc):
    """All (begin, end) of best local alignments, by carrying begins along."""
    best, places = 0, set()
    row = [(0, {j}) for j in range(len(doc) + 1)]
    for x in item:
        now = [(0, {0})]
        for j, y in enumerate(doc, 1):
            ways = [(row[j - 1][0] + (2 if x == y else -1), row[j - 1][1]), (row[j][0] - 1, row[j][1]), (now[-1][0] - 1, now[-1][1]), (0, {j})]
            top = max(s for s, _ in ways)
            now.append((top, set().union(*(b for s, b in ways if s == top))))
            if top >= best and top:
                places = places if top == best else set()
                best = top
                places |= {(b, j) for b in now[-1][1]}
        row = now
    return best, places


def test_where_an_alignment_lies():
    assert D.align(*(np.array([ord(c) for c in x]) for x in ("abcdefgh", "zzzqabxcdefgh")))[1:] == (4, 13)
    rng = random.Random(2)
    for _ in range(400):
        item, doc = ([rng.randrange(5) for _ in range(rng.randrange(3, 12))] for _ in range(2))
        score, begin, end = D.align(np.array(item), np.array(doc))
        best, places = plain_places(item, doc)
        assert score == best / (2 * len(item)) and (not best or (begin, end) in places)


@pytest.mark.parametrize("kind", ["int", "string", "bigint", "smallint"])
def test_kinds_of_ids_and_clashing_names(spark, kind):
    docs = spark.createDataFrame([("1", "x a b c d e"), (None, "a b c d")], "doc_id string, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text", "1 as score", "2 as item_id")
    items = spark.createDataFrame([("7", "a b c d")], "item_id string, text string").selectExpr(f"cast(item_id as {kind}) item_id", "text", "3 as doc_id")
    got = D.matches(docs, items)
    assert got.schema["item_id"].dataType.simpleString() == kind
    assert sorted((str(r.doc_id), str(r.item_id), r.score, r.first_word, r.end_word) for r in got.collect()) == [("1", "7", 1.0, 1, 5), ("None", "7", 1.0, 0, 4)]


def test_codes_that_wrap_lose_no_match(spark, monkeypatch):
    items = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k")], "item_id int, text string")
    docs = spark.createDataFrame([(1, "z a b c d e f z"), (2, "g h i j x"), (3, "a c b")], "doc_id int, text string")
    want = sorted(map(tuple, D.matches(docs, items).collect()))
    real = D.Items.__init__

    def wide(self, rows):
        real(self, rows)
        self.base = (1 << 40) + 9
        self.grams = [self.codes(w) for w in self.words]
        self.all = np.unique(np.concatenate(self.grams))

    monkeypatch.setattr(D.Items, "__init__", wide)
    assert sorted(map(tuple, D.matches(docs, items).collect())) == want and len(want) == 2


def test_very_long_text(spark):
    item = " ".join(f"w{k}" for k in range(30))
    text = "some filler of words " * 100_000 + item + " and more " * 50_000
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    r = D.matches(docs, spark.createDataFrame([(1, item)], "item_id int, text string")).first()
    assert (r.score, r.first_word, r.end_word) == (1.0, 400_000, 400_030)


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_recall_on_a_table(spark):
    """Against the alignment of every pair that could reach the least score by the words they share."""
    docs = [(r.doc_id, D.words_of(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, D.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want, number = {}, {}
    for d, w in docs:
        has = Counter(w)
        for k, t in items:
            # No alignment matches more words than the two have in common.
            if len(t) >= 3 and sum((has & Counter(t)).values()) >= D.LEAST * len(t):
                a, b = (np.array([number.setdefault(x, len(number)) for x in y]) for y in (t, w))
                if (s := D.align(a, b)[0]) >= D.LEAST:
                    want[d, k] = s
    got = {(r.doc_id, r.item_id): r.score for r in D.query(spark, SF).collect()}
    assert len(want) > 20 and got.keys() <= want.keys()
    assert len(got) >= 0.97 * len(want) and all(abs(got[x] - want[x]) < 1e-9 for x in got)


def test_blocks_and_empty_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d"), (2, "g h i j"), (3, "g h i j")], "item_id long, text string")
    monkeypatch.setattr(D, "BLOCK_WORDS", 4)
    assert sorted((r.doc_id, r.item_id, r.score) for r in D.matches(docs, items).collect()) == [(1, 1, 1.0), (2, 2, 1.0), (2, 3, 1.0)]
    assert D.matches(docs.limit(0), items).count() == 0
    assert D.matches(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("step", [4, 5, 6])
def test_edited_copy_beside_many_verbatim_leaks(spark, step):
    rng = random.Random(11)
    item = [f"w{k}" for k in range(40)]
    other = lambda n: [f"o{rng.randrange(5000)}" for _ in range(n)]
    copy = [other(1)[0] if i % step == step - 1 else w for i, w in enumerate(item)]
    # The rarest 3-grams of the item are those that the edited copy broke.
    docs = [other(30) + c + other(30) for c in [item] * 50 + [copy]] + [other(80) for _ in range(50)]
    rows = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    want = {i: s for i, d in enumerate(docs) if (s := plain_score(item, d)) >= D.LEAST}
    assert sorted(want) == list(range(51))
    assert {r.doc_id: r.score for r in D.matches(rows, items).collect()} == want
