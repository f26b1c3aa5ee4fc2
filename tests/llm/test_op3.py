import hashlib
import random
from collections import Counter

import pytest
from oracle import same

from lathe.llm import warcaudit as W


def test_query_like_sql(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, f"http://h/{i}", "<p>" + "é" * rng.randrange(50)) for i in range(2000)] + [(9000, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    assert len(same(W.query(spark, str(tmp_path)), W.ORACLE_SQL, str(tmp_path))) > 30


def frame(spark, rows):
    return W.manifest(spark.createDataFrame(rows, "key long, record string, digest string"))


def test_like_plain_comparison(spark):
    rng = random.Random(1)
    a = {rng.randrange(-(10**9), 10**9): f"record {i}" * rng.randrange(1, 4) for i in range(300)}
    b = dict(a)
    bad = rng.sample(sorted(a), 9)
    for k in bad[:3]:
        b[k] += "!"
    for k in bad[3:6]:
        del b[k]
    b[5] = "more"
    got = {r.key: r for r in W.audit(frame(spark, [(k, v, "x") for k, v in a.items()]), frame(spark, [(k, v, "x") for k, v in b.items()])).collect()}
    assert got.keys() == {*bad[:6], 5}
    for k in bad[:6]:
        assert got[k].status == ("corrupt" if k in b else "missing")
        assert got[k].offset == sum(len(v) for x, v in a.items() if x < k)
        assert got[k].expected_digest == hashlib.sha256(a[k].encode()).hexdigest()
    assert got[5].status == "extra" and got[5].found_length == 4


@pytest.mark.parametrize("fanout", [64, 4])
def test_every_unmatched_record_has_a_row_whatever_the_key(spark, monkeypatch, fanout):
    """A key with most of the records; records lost, changed and added under it; the ranges that differ are few."""
    monkeypatch.setattr(W, "FANOUT", fanout)
    rng = random.Random(6)
    a = [(7 if i % 3 else i, f"record {i} {'x' * rng.randrange(9)}") for i in range(3000)] + [(8, "copy")] * 9
    rng.shuffle(a)
    gone = set(rng.sample([r for r in a if r[0] == 7], 5))
    b = [r for r in a if r not in gone][1:] + [(7, "new one"), (7, "new two"), (8, "copy")]
    dropped = [r for r in a if r not in gone][0]
    got = [r.asDict() for r in W.audit(frame(spark, [(*r, "x") for r in a]), frame(spark, [(*r, "x") for r in b])).collect()]
    digest = lambda r: hashlib.sha256(r[1].encode()).hexdigest()
    lost = sorted((r["key"], r["expected_digest"], r["expected_copies"]) for r in got if r["expected_digest"])
    more = sorted((r["key"], r["found_digest"], r["found_copies"]) for r in got if r["found_digest"])
    want = Counter(a)
    want.subtract(b)
    assert lost == sorted((k[0], digest(k), n) for k, n in want.items() if n > 0) and dropped in want
    assert more == sorted((k[0], digest(k), -n) for k, n in want.items() if n < 0)
    order = lambda rows: sorted(rows, key=lambda r: (r[0], digest(r), len(r[1])))
    for side, rows in (("", a), ("found_", b)):
        at, places = 0, {}
        for r in order(rows):
            places.setdefault((r[0], digest(r)), at)
            at += len(r[1])
        for r in got:
            d = r[f"{side or 'expected_'}digest"]
            assert d is None or r[f"{side}offset"] == places[r["key"], d]


def test_descent_reads_few_ranges_after_a_loss(spark, monkeypatch):
    monkeypatch.setattr(W, "FANOUT", 8)
    rows = [(i, f"r{i}", "x") for i in range(4000)]
    a, b = (W.tree(frame(spark, x), 3) for x in (rows, rows[1:2000] + rows[2001:]))
    assert W.root(a[-1]) != W.root(b[-1])
    for k, most in ((1, 6), (2, 6)):
        assert 1 <= W._differing(a[k], b[k]).count() <= most


def test_repeats_nulls_and_empty(spark):
    a = [(1, "r", "x")] * 50 + [(1, "s", "x"), (None, "n", "x"), (2, None, "x")]
    m = frame(spark, a)
    assert W.audit(m, frame(spark, a)).count() == 0
    assert [(r.key, r.status) for r in W.audit(m, frame(spark, a[1:])).collect()] == [(1, "missing")]
    assert [(r.key, r.status, r.offset) for r in W.audit(m, frame(spark, [(k, v if k else "N", d) for k, v, d in a])).collect()] == [(None, "corrupt", 0)]
    assert W.audit(m.limit(0), m.limit(0)).count() == 0
    assert {r.status for r in W.audit(m.limit(0), m).collect()} == {"extra"}
