"""Prefix trie, exact search and collocations against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import collocations, maxscore, prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# 11 ------------------------------------------------------------------------
def brute_trie(turns, group=20, heads=4):
    convs = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    members = defaultdict(list)
    lengths = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        lead = c - (abs(c) % group) * (1 if c >= 0 else -1)
        whole = tuple(convs.get(lead, [])[:h] + ts[h:])
        lengths[c] = len(whole)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for p, m in members.items():
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
         sha256(",".join(str(c) for c in sorted(m) if lengths[c] == len(p)).encode()).hexdigest())
        for p, m in members.items()
    )


def trie_rows(spark, turns):
    df = spark.createDataFrame(turns, TURNS).withColumns({"shard": F.lit("mine"), "seg": F.lit("mine"), "words": F.lit(1)})
    got = prefix_trie.trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return rows(got.fillna(-1, ["parent_conv_id"]))


def some_turns(seed, n=70):
    rng = random.Random(seed)
    long = [("user", f"long {i} " * rng.randint(0, 3)) for i in range(200)]
    turns = []
    for c in range(-25, n):
        if c % 20 == 0 and rng.random() < 0.4:
            continue  # no leader
        if rng.random() < 0.2:
            ts = long[: rng.choice([63, 64, 65, 127, 128, 129, 130, 200])] + [(None, "end")] * rng.randint(0, 1)
        else:
            ts = [(rng.choice(["user", None, ""]), rng.choice(["a b", "c", "", None])) for _ in range(rng.randint(1, 6))]
        turns += [(c, 3 * i if i or rng.random() < 0.5 else None, *t) for i, t in enumerate(ts)]
    turns += [(None, 0, "user", "nobody's")] * 3
    rng.shuffle(turns)
    return turns


def test_trie_matches_brute_force(spark, monkeypatch):
    turns = some_turns(1)
    want = brute_trie(turns)
    assert trie_rows(spark, turns) == want
    # Small shards and position ranges: most nodes lie in several.
    monkeypatch.setattr(prefix_trie, "SHARD", 5)
    monkeypatch.setattr(prefix_trie, "TURNS", 40)
    assert trie_rows(spark, turns) == want


def test_trie_of_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD", 100)
    turns = [(c, i, "user", f"turn {i} of all") for c in range(900) for i in range(3)] + [(1000 + c, 0, "user", str(c % 7)) for c in range(50)]
    assert trie_rows(spark, turns) == brute_trie(turns)


def test_trie_of_ties_repeated_rows_and_no_rows(spark):
    turns = [(1, 0, "b", "x"), (1, 0, "a", "y"), (1, None, "z", "first"), (2, 5, "a", "same"), (2, 5, "a", "same"), (3, None, None, None)]
    assert trie_rows(spark, turns) == brute_trie(turns)
    assert trie_rows(spark, []) == [] and trie_rows(spark, [(None, 1, "user", "x")]) == []


# 12 ------------------------------------------------------------------------
def brute_search(vectors, every=50, k=5):
    whole = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(i, set()).add(tuple(int(np.floor(256.0 * np.float64(np.float32(x)))) for x in v))
    want = []
    for q, qs in whole.items():
        if q % every == 0:
            best = {}
            for c, cs in whole.items():
                scores = [sum(a * b for a, b in zip(x, y)) for x in qs for y in cs if len(x) == len(y)]
                if c != q and scores:
                    best[c] = min(max(*scores, -(2**63)), 2**63 - 1)
            for rank, (s, c) in enumerate(sorted((-s, c) for c, s in best.items())[:k], 1):
                want.append((q, rank, c, -s))
    return sorted(want)


def search_rows(spark, vectors):
    df = spark.createDataFrame([(i, v, "mine") for i, v in vectors], "vec_id long, embedding array<float>, ids string")
    return rows(maxscore.report(df))


def test_search_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 16)) / 4
    vectors = [(i, [float(x) for x in np.float32(centres[i % 6] + rng.normal(size=16) / 20)]) for i in range(400)]
    # Copies, ties, zero vectors, repeated ids, other lengths, unusable rows.
    vectors += [(1000 + i, vectors[7][1]) for i in range(40)] + [(2000, [0.0] * 16), (2050, [0.0] * 16), (2050, [0.0] * 16)]
    vectors += [(50, vectors[9][1]), (8, vectors[11][1]), (3000, [0.5, -0.25]), (3001, [0.25, 0.1]), (3050, []), (3051, [])]
    vectors += [(4000, None), (4001, [None] * 16), (None, [1.0] * 16), (4050, [float("nan")] * 16), (4051, [float("inf")] * 16)]
    want = brute_search(vectors)
    assert search_rows(spark, vectors) == want
    monkeypatch.setattr(maxscore, "SAMPLE", 3)
    assert search_rows(spark, vectors) == want


def test_search_of_huge_components_and_of_nothing(spark):
    vectors = [(0, [1e30, -1.0]), (50, [2.0, -3e20]), (3, [1e36, 1e36]), (4, [-0.001, 5.0])]
    assert search_rows(spark, vectors) == brute_search(vectors)
    assert search_rows(spark, []) == []


def test_search_scores_few_vectors_in_full():
    rng = np.random.default_rng(5)
    # A few heavy terms in each vector, as in sparse retrieval.
    vectors = np.zeros((4000, 64), dtype=np.int64)
    for v in vectors:
        v[rng.choice(64, 6, replace=False)] = rng.integers(1, 200, 6)
    shard = maxscore.Shard(vectors)
    scored = 0
    for q in vectors[:40]:
        all_scores = vectors @ q
        found, sums, n = shard.search(q, 6, int(np.sort(all_scores[:500])[-6]))
        best = np.sort(all_scores)[-6]
        assert set(np.flatnonzero(all_scores >= best)) <= set(found) and (sums == all_scores[found]).all()
        scored += n
    assert scored < 0.1 * 40 * len(vectors)


# 13 ------------------------------------------------------------------------
def brute_phrases(docs, least, top):
    counts = Counter()
    for lang, text in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(ws)):
                for k in range(1, min(4, len(ws) - i) + 1):
                    counts[lang or "und", tuple(ws[i : i + k])] += 1
    totals = Counter()
    for (lang, p), a in counts.items():
        if len(p) == 1:
            totals[lang] += a
    cand = {x: a for x, a in counts.items() if len(x[1]) > 1 and a >= least}
    found = defaultdict(list)
    for (lang, p), a in cand.items():
        cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        if any(
            lg == lang and len(lp) > len(p) and 100 * la >= 80 * a and any(lp[i : i + len(p)] == p for i in range(len(lp) - len(p) + 1))
            for (lg, lp), la in cand.items()
        ):
            continue
        found[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, totals[lang], -s)
        for lang, best in found.items() for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1)
    )


def phrase_docs(seed=0, n=120):
    rng = random.Random(seed)
    vocab = ["The", "sea", "ist", "Été", "blau", "日本", "x", "y", "z", "a\x00b"]
    docs = []
    for i in range(n):
        words = [rng.choice(vocab) if rng.random() < 0.8 else f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 60))]
        docs.append((rng.choice(["en", "de", None, "und"]), "".join(w + rng.choice([" ", " ", "\t ", " ", ". ", ",", "\n", "\x0c"]) for w in words)))
    docs += [("en", "new york city hall is here")] * 40 + [("en", None), (None, None), ("en", ""), ("fr", " \t.,\n"), ("en", "b b b b b b")]
    return docs


def test_collocations_match_brute_force(spark):
    docs = phrase_docs()
    df = spark.createDataFrame(docs, "lang string, text string").withColumns({"n": F.lit("mine"), "w1": F.lit("mine"), "phrase": F.lit(0)})
    for least, top in ((5, 2000), (12, 7)):
        got = collocations.collocations(df, least, top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert rows(got) == brute_phrases(docs, least, top)
    assert rows(collocations.collocations(df.limit(0))) == []


def test_windows_do_not_depend_on_chunks(monkeypatch):
    docs = phrase_docs(4) + [("en", "w " * 500 + "x" * 300 + " y z" * 100)]
    batch = pa.record_batch([pa.array([d[0] or "und" for d in docs]), pa.array([d[1] or "" for d in docs])], names=["lang", "text"])

    class All:
        value = np.full(1, 2**64 - 1, dtype=np.uint64)

    def counted():
        total = Counter()
        for b in collocations._windows(All, All)(iter([batch])):
            for r in b.to_pylist():
                total[r["lang"], r["window"]] += r["n"]
        keys = Counter()
        for of in (collocations._count_keys(), collocations._count_keys(All)):
            for b in of(iter([batch])):
                for r in b.to_pylist():
                    keys[r["key"]] += r["n"]
        return total, keys

    want = counted()
    assert sum(want[0].values()) > 3000
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(collocations, "CHUNK", size)
        monkeypatch.setattr(collocations, "HELD", 50)
        monkeypatch.setattr(collocations, "ROWS", 7)
        assert counted() == want, size


def test_a_full_sieve_changes_nothing(spark, monkeypatch):
    docs = phrase_docs(8, 60)
    df = spark.createDataFrame(docs, "lang string, text string")
    monkeypatch.setattr(collocations, "_sieve", lambda frequent: np.full(4, 2**64 - 1, dtype=np.uint64))
    assert rows(collocations.collocations(df, 5)) == brute_phrases(docs, 5, 2000)
