"""Small inputs and brute-force versions that the tests of this folder share."""

import re

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=()):
    """A documents table from (doc_id, text) rows, with extra columns of clashing names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOC)
    return df.withColumns({c: F.lit("clash") for c in extra})


def shingle_set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute_components(rows):
    """component_id of each row of (doc_id, text), by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) if sets[i] else doc_id for i, (doc_id, _) in enumerate(rows)], [len(s) for s in sets]


def brute_hits(text, items, size=13):
    """(n_words, n_hit, item ids) by trying every window at every place."""
    fold = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, ids = fold(text), set(), set()
    for item_id, item in items:
        x = fold(item)
        for k in range(max(1, len(x) - size + 1)) if x else ():
            win = x[k:k + size]
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    ids.add(item_id)
    return len(w), len(hit), {i for i in ids if i is not None}
