"""A plain checker for byte-pair learning, written from its description."""


def merge(ids, a, b, new):
    out, i = [], 0
    while i < len(ids):
        if i + 1 < len(ids) and (ids[i], ids[i + 1]) == (a, b):
            out.append(new)
            i += 2
        else:
            out.append(ids[i])
            i += 1
    return out


def learn(docs, vocab, least, rules=()):
    """Rules (a, b, new) and counts over documents that pairs do not cross."""
    seqs, rules, counts = [list(d.encode()) for d in docs], list(rules), []
    for r in rules:
        seqs = [merge(s, *r) for s in seqs]
    while 256 + len(rules) < vocab:
        n = {}
        for s in seqs:
            for p in zip(s, s[1:]):
                n[p] = n.get(p, 0) + 1
        if not n or max(n.values()) < least:
            break
        best = next(p for p in n if n[p] == max(n.values()))
        rules.append((*best, 256 + len(rules)))
        counts.append(n[best])
        seqs = [merge(s, *rules[-1]) for s in seqs]
    return rules, counts
