"""Small frames with awkward rows, and brute-force versions."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, rep long, pos int, score double"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
LONG = " ".join(f"word{i % 997}" for i in range(30_000))


def documents(spark, texts, source="s", ids=None):
    """Documents with columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    sources = [source] * len(texts) if isinstance(source, (str, type(None))) else source
    rows = [(i, t, "en", s, None if t is None else len(t), "k", 1, 2, 0.5) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, a null id."""
    texts = [BASE, BASE, None, "", " \t\n", LONG, LONG + " end", "one", "one two", BASE]
    return documents(spark, texts, ids=[0, 1, 2, 3, 4, 5, 6, 7, 8, 1]).unionByName(documents(spark, [BASE, None], ids=[None, None]))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def near_duplicate_components(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    names, links = sorted(sets), []
    holders = {}
    for i in names:
        for x in sets[i]:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in holders.values() if len(ids) < 200 for k, a in enumerate(ids) for b in ids[k + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            links.append((a, b))
    return sets, components(names, links)
