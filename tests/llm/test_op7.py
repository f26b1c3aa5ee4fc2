import random

import xxhash

from lathe.llm import simhash as S


def brute_fp(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= bits:
                a_, b_ = find(i), find(j)
                root[max(a_, b_)] = min(a_, b_)
    return [find(i) for i in range(len(fps))]


def test_query_like_brute_force(spark, tmp_path):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(4))
    texts = ["", None, " \t\n", "One", "one two", "Same TEXT here", "same text\nhere"]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([60, 300]))]
        texts.append(" ".join(base))
        for _ in range(6):
            t = list(base)
            t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, "", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, simhash string").write.parquet(f"{tmp_path}/documents.parquet")
    fps = [brute_fp(t or "") for t in texts]
    comp = brute_components(fps)
    got = S.query(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.fingerprint == f"{fps[r.doc_id]:016x}"
        assert r.component_id == comp[r.doc_id]


def test_crowded_keys_link_the_same(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(3)]
    fps = set(base)
    for b in base:
        for _ in range(150):
            b ^= 1 << rng.randrange(20)  # a crowd under the keys of the upper blocks, in chains
            b ^= (1 << rng.randrange(64)) if rng.random() < 0.3 else 0
            fps.add(b)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    docs = spark.createDataFrame(list(enumerate(fps)), "doc_id long, simhash long")
    want = brute_components([x & (1 << 64) - 1 for x in fps])
    assert {r.doc_id: r.component_id for r in S.groups(docs).collect()} == dict(enumerate(want))


def test_empty_table(spark):
    assert S.groups(S.fingerprints(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
