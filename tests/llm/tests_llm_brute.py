"""Plain single-machine versions of the contracts, for small tables."""

from collections import Counter, defaultdict


def passages(rows, width=20):
    """doc_id, words, words removed, kept text: windows that start earlier go."""
    first = {}
    for doc_id, text in sorted(rows):
        words = text.encode().split()
        for s in range(len(words) - width + 1):
            first.setdefault(tuple(words[s : s + width]), (doc_id, s))
    for doc_id, text in rows:
        words, gone = text.encode().split(), set()
        for s in range(len(words) - width + 1):
            if first[tuple(words[s : s + width])] != (doc_id, s):
                gone.update(range(s, s + width))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        yield doc_id, len(words), len(gone), kept


def components(rows, percent=85):
    """Root of every document: links are found over shared rare shingles, which miss none."""
    sets = {}
    for doc_id, text in rows:
        words = text.encode().lower().split()
        n = min(5, len(words))
        sets[doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    seen = Counter(s for v in sets.values() for s in v)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i in sorted(sets, key=lambda i: len(sets[i])):
        own = sets[i]
        rare = sorted(own, key=lambda s: (seen[s], s))[: len(own) - -(-percent * len(own) // 100) + 1]
        for j in {j for s in rare for j in index[s]}:
            if 100 * len(own & sets[j]) >= percent * len(own | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for s in rare:
            index[s].append(i)
    return {i: find(i) for i in sets}
