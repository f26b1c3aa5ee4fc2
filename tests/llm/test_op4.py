import hashlib
import random
import zlib

from lathe.llm import piecewise as P


def plain(text):
    """The fingerprint, byte by byte."""
    data = text.encode()
    if not data:
        return "3::"
    hs = []
    for i in range(len(data)):
        w = [data[i - k] if i >= k else 0 for k in range(7)]
        x = 0
        for k, c in enumerate(w):
            x ^= (c << 5 * k) & 0xFFFFFFFF
        hs.append((sum(w) + sum((7 - k) * c for k, c in enumerate(w)) + x + 1) & 0xFFFFFFFF)
    block = 3
    while block * 64 < len(data):
        block *= 2
    while block > 3 and sum(h % block == 0 for h in hs) < 32:
        block //= 2

    def sign(b, most):
        out, a = "", 0
        for i, h in enumerate(hs):
            if h % b == 0 and len(out) < most - 1:
                out += P.ALPHABET[zlib.crc32(data[a : i + 1]) & 63]
                a = i + 1
        return out + (P.ALPHABET[zlib.crc32(data[a:]) & 63] if a < len(data) else "")

    return f"{block}:{sign(block, 64)}:{sign(2 * block, 32)}"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_likeness(a, b):
    if a == b:
        return 1.0
    (ba, a1, a2), (bb, b1, b2) = a.split(":"), b.split(":")
    if not a1 or not b1:
        return 0.0
    ba, bb = int(ba), int(bb)

    def alike(x, y):
        if x == y:
            return 1.0
        if min(len(x), len(y)) < 4 or not {x[i : i + 4] for i in range(len(x) - 3)} & {y[i : i + 4] for i in range(len(y) - 3)}:
            return 0.0
        return 1 - edits(x, y) / max(len(x), len(y))

    if ba == bb:
        return max(alike(a1, b1), alike(a2, b2) if a2 and b2 else 0.0)
    return alike(a1, b2) if ba == 2 * bb else alike(b1, a2) if bb == 2 * ba else 0.0


def test_query_like_plain_python(spark, tmp_path):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghé") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 20, 200, 900]))) for _ in range(60)]
    texts += ["", None, "a", "aa", "a" * 5000, "😀" * 40, texts[3], texts[3]]
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in P.query(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    down = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, t) in enumerate(down):
        following, r = down[(k + 1) % len(down)][1], got[i]
        new = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (plain(t), plain(new))
        assert abs(r.near_edited - plain_likeness(plain(t), plain(new))) < 1e-12
        assert abs(r.near_next - plain_likeness(plain(t), plain(following))) < 1e-12


def test_one_row_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(1, "abcabc", 5)], "doc_id long, text string, part int")
    assert P.with_edited(df).first().edited_fingerprint == P.fingerprint("abcaab")
    assert P.with_edited(df.union(df).union(df)).count() == 3
    assert P.with_edited(df.limit(0)).count() == 0
    assert P.fingerprints(df).columns == ["doc_id", "text", "part", "fingerprint"]
