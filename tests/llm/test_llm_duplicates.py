"""Near duplicates, components, substring dedup and the pipeline."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_cases import brute_components, brute_hits, docs
from quarry.llm import components as C
from quarry.llm import neardup as N
from quarry.llm import quality as Q
from quarry.llm import substring as S
from quarry.llm.components import components
from quarry.llm.queries import ORACLE, QUERIES
from tools_compare import rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    assert rows_of([r.asDict() for r in df.collect()], cols) == rows_of([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)


# --- components -------------------------------------------------------------------

def test_components_of_paths_stars_and_cycles(spark, monkeypatch):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(700, 701), (701, 702), (702, 700), (9, 9)]
    edges += [(800 + rng.randrange(40), 800 + rng.randrange(40)) for _ in range(30)]
    rng.shuffle(edges)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root if sum(find(m) == find(n) for m in root) > 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    for hub, most in ((3, 1000), (3, 0)):               # hubs by broadcast, and beyond its bound
        monkeypatch.setattr(C, "HUB", hub)
        monkeypatch.setattr(C, "BROADCAST_ROWS", most)
        assert {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == got


# --- near duplicates -----------------------------------------------------------------

def near_rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    text = lambda n: [word() for _ in range(n)]
    rows = [(i, " ".join(text(rng.randint(1, 120)))) for i in range(60)]
    base = text(150)
    rows += [(100 + i, " ".join(base)) for i in range(12)]                                   # exact copies
    for i in range(40):                                                                     # near copies, some beyond the threshold
        t = list(base)
        for k in rng.sample(range(150), rng.randint(1, 7)):
            t[k] = word()
        rows.append((200 + i, " ".join(t)))
    chain = text(100)
    for i in range(8):                                                                      # a chain: neighbours linked, ends not
        rows.append((300 + i, " ".join(chain)))
        chain = chain[8:] + text(8)
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "one two"), (404, "One  TWO"), (405, "one"), (406, "x " * 30000), (407, "x " * 50),
             (408, "é É"), (409, "é é"), (None, " ".join(base)), (None, "alone without id"), (100, " ".join(base)), (100, " ".join(text(30))),
             (410, "a\x1cb c d e f"), (411, "a b c d e f")]
    return rows


def test_near_duplicates_brute_force(spark, monkeypatch):
    rows = near_rows()
    comp, sizes = brute_components(rows)
    want = Counter((i, n, c, i == c) for (i, _), n, c in zip(rows, sizes, comp))
    got = N.near_duplicates(docs(spark, rows, ["node", "kept", "component_id", "bucket"]))
    assert Counter(tuple(r) for r in got.collect()) == want
    monkeypatch.setattr(N, "BROADCAST_ROWS", 0)         # the way beyond the bound
    assert Counter(tuple(r) for r in N.near_duplicates(docs(spark, rows)).collect()) == want
    assert N.near_duplicates(docs(spark, [])).count() == 0
    alone = N.near_duplicates(docs(spark, [(1, "a b"), (2, None)])).collect()
    assert sorted(tuple(r) for r in alone) == [(1, 1, 1, True), (2, 0, 2, True)]


def two_families(members):
    """Two families that share two thirds of their words; every member has an edit of its own."""
    rng = random.Random(5)
    text = lambda n: [f"w{rng.randrange(10 ** 7)}" for _ in range(n)]
    both, own = text(200), [text(100), text(100)]
    rows = []
    for i in range(members):
        for f in range(2):
            t = both + own[f]
            for k in rng.sample(range(300), 2):
                t[k] = f"e{rng.randrange(10 ** 7)}"
            rows.append((2 * i + f, " ".join(t)))
    return rows


def test_two_families_do_not_meet_each_other(spark, monkeypatch):
    met, meetings = [], N.meetings

    def counted(probe, index):
        out = meetings(probe, index)
        met.append(out.count())
        return out
    monkeypatch.setattr(N, "meetings", counted)
    for members in (20, 40):
        rows = two_families(members)
        comp, _ = brute_components(rows)
        assert {(r.doc_id, r.component_id) for r in N.near_duplicates(docs(spark, rows)).collect()} == {(r[0], c) for r, c in zip(rows, comp)}
        assert len(set(comp)) == 2
    assert len(met) == 2 and met[0] <= 20 and met[1] <= 40      # linear at most


def test_estimate_follows_similarity_and_registers_merge():
    rng = np.random.default_rng(4)
    a, b, true = [], [], []
    for _ in range(150):
        both, only = rng.integers(100, 900), rng.integers(1, 200, 2)
        s = rng.integers(0, 1 << 63, both + only.sum(), dtype=np.uint64) * np.uint64(2)
        a.append(s[:both + only[0]])
        b.append(np.concatenate((s[:both], s[both + only[0]:])))
        true.append(both / len(s))
    ra, rb = (np.stack([N.registers(np.sort(x)) for x in v]) for v in (a, b))
    got = N.estimate(np.array([len(x) for x in a], float), np.array([len(x) for x in b], float), ra, rb)
    error = got - np.array(true)
    assert np.abs(error.mean()) < 0.01 and error.std() < 0.045
    assert (np.maximum(ra[0], rb[0]) == N.registers(np.union1d(a[0], b[0]))).all()
    # a pair at the threshold shares a band all but surely
    assert (1 - 0.75 ** N.ROWS) ** N.BANDS < 1e-5


def test_bands_find_pairs_at_the_threshold():
    rng = np.random.default_rng(8)
    missed = 0
    for _ in range(300):
        s = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)
        ra, rb = N.registers(s[:350]), N.registers(s[50:])            # similarity 300 / 400
        missed += not (ra.reshape(-1, N.ROWS) == rb.reshape(-1, N.ROWS)).all(1).any()
    assert missed == 0


# --- substring dedup ------------------------------------------------------------------

def brute_spans(rows, min_words):
    """Spans by the definition, from the words alone: of consecutive chunks those runs of at least ``min_words`` words,
    each the shortest from its first or up to its last chunk, that an earlier document holds as a run of chunks too."""
    first, found, out = {}, [], []
    for doc_id, text in rows:
        words, (start, _, _) = (text or "").split(), S.chunks(text)
        at, runs = [*start.tolist(), len(words)], []
        for i in range(len(start)):
            for j in range(i + 1, len(at)):
                if at[j] - at[i] >= min_words:
                    runs.append((at[i], at[j]))
                    break
        for j in range(1, len(at)):
            i = max((i for i in range(max(0, j - min_words), j) if at[j] - at[i] >= min_words), default=None)
            if i is not None:
                runs.append((at[i], at[j]))
        key = S.NO_ID if doc_id is None else doc_id
        found.append((doc_id, text, words, key, runs))
        for a, b in runs:
            w = tuple(words[a:b])
            first[w] = min(first.get(w, key), key)
    for doc_id, text, words, key, runs in found:
        gone = {i for a, b in runs if first[tuple(words[a:b])] < key for i in range(a, b)}
        edges = sorted(i for i in gone if i - 1 not in gone), sorted(i + 1 for i in gone if i + 1 not in gone)
        left = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc_id, tuple(zip(*edges)), None if text is None else " ".join(left)))
    return out


def passage_rows():
    rng = random.Random(21)
    vocab = [f"{rng.choice('kmprst')}{i}" for i in range(3000)] + ["Été", "日本"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    long_, line = [text(51), text(80)], text(14)
    rows = [(i, text(rng.randint(20, 300))) for i in range(40)]
    rows += [(100 + i, f"{text(rng.randint(0, 70))} {long_[i % 2]}\n{text(rng.randint(0, 70))}") for i in range(20)]
    rows += [(200 + i, f"{text(90)}\n{line}") for i in range(15)]                            # a shared short line
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, text(60) + " " + rows[45][1]), (303, "ha " * 5000), (304, "ha " * 400), (305, None),
             (306, ""), (307, "one"), (None, rows[1][1]), (None, rows[1][1]), (308, text(30000)), (309, " ".join([long_[0]] * 3)),
             (310, "self " + rows[3][1] + " " + rows[3][1]), (1, text(100) + " " + rows[0][1])]
    return rows, long_, line


def test_substring_brute_force(spark, monkeypatch):
    rows, long_, line = passage_rows()
    want = Counter(brute_spans(rows, S.MIN_WORDS))
    frame = docs(spark, rows, ["removed_spans", "digest", "deduped_text", "_sd_doc"])

    def seen(df):
        return Counter((r.doc_id, tuple((s.start, s.end) for s in r.removed_spans or ()),
                        None if r.deduped_text is None else " ".join(r.deduped_text.split())) for r in df.collect())
    got = S.substring_dedup(frame)
    assert seen(got) == want
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    assert seen(S.substring_dedup(frame)) == want
    texts = {r.doc_id: r.deduped_text for r in got.filter("doc_id >= 100 and doc_id < 300").collect()}
    for k in range(2):
        assert sum(" ".join(long_[k].split()) in " ".join(t.split()) for t in texts.values()) == 1   # only the first still has it
    assert all(line in texts[200 + i] for i in range(15))
    same = {i: t for i, t in rows if i is not None and 200 <= i < 215}
    assert all(texts[i] == t for i, t in same.items())
    assert S.substring_dedup(docs(spark, [])).count() == 0


def repeated_words(rows, n):
    """By row the words that lie in a window of n words which one earlier document holds as it stands."""
    first, out = {}, []
    windows = lambda t: (lambda w: [tuple(w[i:i + n]) for i in range(len(w) - n + 1)])((t or "").split())
    for doc_id, text in rows:
        for w in windows(text):
            first[w] = min(first.get(w, S.NO_ID), doc_id)
    for doc_id, text in rows:
        out.append({i + k for i, w in enumerate(windows(text)) if first[w] < doc_id for k in range(n)})
    return out


def removed_words(df):
    return {r.doc_id: {i for s in r.removed_spans or () for i in range(s.start, s.end)} for r in df.collect()}


def test_substring_needs_one_earlier_document(spark):
    rng = random.Random(31)
    text = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    patched, line, passage = text(300), text(24), text(60)
    start, size, _ = S.chunks(patched)
    words = patched.split()
    rows = [(i, f"{text(20)} {' '.join(words[max(0, a - 6):a + n + 6])} {text(20)}") for i, (a, n) in enumerate(zip(start, size))]
    rows += [(400, f"{text(50)} {line} {words[0]} {text(50)}"), (401, f"{text(50)} {passage} {text(50)}")]
    rows += [(500, patched), (501, f"{text(30)} {line} {patched}"), (502, f"{patched[:400]} {passage} {text(40)}")]
    assert sum(d in {x for _, t in rows[:-5] for x in S.chunks(t)[2].tolist()} for d in S.chunks(patched)[2].tolist()) > 0.9 * len(size)
    got = removed_words(S.substring_dedup(docs(spark, rows)))
    assert not got[500]                                     # every chunk is known, but from another document each
    true = dict(zip((i for i, _ in rows), repeated_words(rows, S.MIN_WORDS)))
    assert all(got[i] <= true[i] for i in got)
    assert len(true[502]) - len(got[502]) <= 23 and len(got[501]) >= 270


def test_substring_cuts_true_windows_only(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = removed_words(S.substring_dedup(docs(spark, rows)))
    true = repeated_words(rows, S.MIN_WORDS)
    assert all(got[i] <= t for (i, _), t in zip(rows, true))
    assert all(got[i] for (i, _), t in zip(rows, repeated_words(rows, 51)) if t)


def test_groups_are_the_shortest_either_way():
    rng = random.Random(8)
    for n in (0, 1, 27, 28, 29, 500):
        text = " ".join(f"w{rng.randrange(900)}" for _ in range(n))
        start, size, _ = S.chunks(text)
        at = [*start.tolist(), n]
        want = {(at[i], at[j] - at[i]) for i in range(len(start)) for j in range(i + 1, len(at))
                if at[j] - at[i] >= 28 and (at[j - 1] - at[i] < 28 or at[j] - at[i + 1] < 28)}
        a, k, d = S.groups(text, 28)
        assert set(zip(a.tolist(), k.tolist())) == want and len(a) == len(want) == len(d) and d.shape[1] == 2
        words = text.split()
        same = {}
        for i, n_, x in zip(a.tolist(), k.tolist(), map(tuple, d.tolist())):
            same.setdefault(x, set()).add(tuple(words[i:i + n_]))
        assert all(len(x) == 1 for x in same.values())      # the digest is that of the words
    with pytest.raises(ValueError):
        S.repeated_spans(None, 256)


def test_cuts_resist_insertions():
    rng = random.Random(6)
    words = [f"w{rng.randrange(900)}" for _ in range(400)]
    a = set(S.chunks(" ".join(words))[2].tolist())
    b = S.chunks(" ".join(words[:50] + ["new", "words"] + words[50:]))[2].tolist()
    assert sum(d not in a for d in b) <= 4
    start, size, digest = S.chunks("ha " * 1000)
    assert size.max() <= S.MAX_WORDS and size.sum() == 1000 and (np.diff(start) == size[:-1]).all()
    assert [len(x) for x in S.chunks(None)] == [0, 0, 0]


def test_without_keeps_other_white_space():
    spans = [{"start": 1, "end": 3}, {"start": 4, "end": 5}]
    assert S.without("a  b c\n\nd\te  f g\n", spans) == "a  d\tf g\n"
    assert S.without("a b c", [{"start": 1, "end": 3}]) == "a"
    assert S.without("a b c", [{"start": 0, "end": 3}]) == ""


# --- pipeline -------------------------------------------------------------------------

def test_pipeline_brute_force(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    model = Q.train(read("documents"), read("labels"))
    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    rows = [r for r in rows if model.score(np.array([Q.statistics(r[1])]))[0] >= 0.5]
    comp, _ = brute_components(rows)
    rows = [r for r, c in zip(rows, comp) if r[0] == c]
    cut = {i: (spans, text) for i, spans, text in brute_spans(rows, S.MIN_WORDS)}
    rows = [(i, cut[i][1] if cut[i][0] else t) for i, t in rows if not cut[i][0] or cut[i][1]]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    kept = []
    for i, t in rows:
        n, hit, _ = brute_hits(t, items)
        if not (hit and 20 * hit >= n):
            kept.append(i)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(kept) and len(got) >= len(kept) > 50
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "quality"


def test_pipeline_stages_keep_columns_and_stand_edges(spark):
    rows = near_rows() + [(900, "the same words " * 40), (901, "the same words " * 40)]
    frame = docs(spark, rows, ["kept", "removed_spans", "contamination", "gone", "quality_score"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert out.columns == corpus_pipeline.COLUMNS
        assert dict(out.dtypes) == dict(docs(spark, []).dtypes)
        assert out.count() <= len(rows)
        assert stage(spark, docs(spark, []), SF).count() == 0
    near = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, frame, SF)
    ids = Counter(r.doc_id for r in near.collect())
    comp, _ = brute_components(rows)
    comp = [c if c is not None else ("", t) for c, (_, t) in zip(comp, rows)]
    worded = {c for c, (_, t) in zip(comp, rows) if (t or "").split()}
    assert sum(1 for r in near.collect() if (r.text or "").split()) == len(worded) + 1  # one row of each component; id 100 names two
    assert ids[100] == 2 and ids[101] == 0 and ids[400] == ids[401] == ids[402] == 1 and ids[None] == 1
    repeated = [(1, "a b"), (1, "A  B"), (1, "a b"), (1, None), (1, None), (None, "a b"), (None, "c"), (None, "c"), (2, "d"), (None, "")]
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs(spark, repeated), SF)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(1, "A  B"), (1, None), (1, None), (None, "c"), (2, "d"), (None, "")])
    sub = dict(corpus_pipeline.STAGES)["substrings"](spark, frame, SF).filter(F.col("text").isNotNull())
    assert sub.filter("n_chars <> length(text)").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() >= len(rows)


def python_steps(df):
    """How often a plan hands rows to Python workers."""
    return df._jdf.queryExecution().sparkPlan().toString().count("ArrowEvalPython [")


def test_stages_run_one_python_worker_a_task(spark):
    rng = random.Random(31)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=90))
    rows = [(i, " ".join(rng.choices(words, k=60))) for i in range(12)] + [(20, passage), (21, passage), (22, "head " + passage)]
    stages = dict(corpus_pipeline.STAGES)
    cut = stages["substrings"](spark, docs(spark, rows), SF)
    assert python_steps(cut) == 1
    got = {r.doc_id: r.text for r in cut.collect()}
    assert got == {i: t for i, t in rows if i < 21} | {22: got[22]} and got[22].startswith("head") and len(got[22].split()) < 20
    shared = [*rows[:12], (3, rows[5][1]), (3, rows[3][1]), (None, rows[7][1]), (None, ""), (4, None)]
    near = stages["near_duplicates"](spark, docs(spark, shared), SF)
    assert python_steps(near) == 2                        # one for rows without words, one for those with
    assert Counter((r.doc_id, r.text) for r in near.collect()) == Counter(
        [(i, t) for i, t in rows[:12] if i != 5] + [(3, rows[5][1]), (None, ""), (4, None)])
