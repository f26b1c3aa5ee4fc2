import random

import corpus_pipeline as C
import sentencepiece

from lathe.llm import sentencepieces


def test_stages_like_brute_force(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    good = ["\n".join(line(rng.randrange(6, 30)) for _ in range(rng.randrange(2, 6))) for _ in range(300)]
    bad = ["\n".join(" ".join(w.upper() + "!!" for w in line(20).split()) for _ in range(3)) for _ in range(80)]
    items = [line(20) for _ in range(8)]
    boiler = line(60)
    docs = [*good, *bad]
    rng.shuffle(docs)
    for k in range(0, 40):
        docs[k] += "\n" + boiler
    leaks = [f"{line(12)} {items[k % 8]} {line(12)}" for k in range(16)]
    copies = [d for d in docs[100:110]]
    lone = line(200)  # one line: its near copies are left to the near-dedup stage
    near = [lone, lone.swapcase(), lone.lower()]  # the marks fold case
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate([*docs, *leaks, *copies, *near, "", None])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int("!!" not in docs[i]), 0) for i in range(0, len(docs), 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept, at = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in C.STAGES:
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(f"{tmp_path}/out/{name}")
        at = spark.read.parquet(f"{tmp_path}/out/{name}")
        if name != "tokens":
            assert at.columns == C.COLUMNS
        kept[name] = {r.doc_id: r for r in at.collect()}
        assert len(kept[name]) == at.count()
    n = len(docs)
    # Quality: what has no marks stays, what is shouted goes.
    assert kept["quality"].keys() >= {i for i in range(n) if "!!" not in docs[i]} | set(range(n, n + 16))
    assert not kept["quality"].keys() & {i for i in range(n) if "!!" in docs[i] and boiler not in docs[i]}
    # Lines: each line of five words or more is in one document, its first.
    seen, lines = set(), {}
    for i in sorted(kept["quality"]):
        stay = []
        for x in (kept["quality"][i].text or "").split("\n"):
            same = tuple(x.split())
            if len(same) < 5 or same not in seen:
                stay.append(x)
            seen.add(same)
        lines[i] = "\n".join(stay)
    assert {i: r.text or "" for i, r in kept["lines"].items()} == lines
    assert all(r.n_chars == len(r.text) for r in kept["lines"].values() if r.text is not None)
    # Near-dedup: one of each group of texts with equal words; the others are far apart.
    first = {}
    for i in sorted(lines):
        first.setdefault(lines[i].lower(), i)
    assert set(kept["near_duplicates"]) == set(first.values())
    # Decontamination: the leaks go, all else stays.
    leaked = {i for i in kept["near_duplicates"] if any(x in lines[i] for x in items)}
    assert len(leaked) == 16 and set(kept["benchmark"]) == set(kept["near_duplicates"]) - leaked
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.model_path())
    assert all(r.n_tokens == len(sp.encode(lines[i])) + 2 for i, r in kept["tokens"].items())
    assert set(kept["tokens"]) == set(kept["benchmark"])


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
