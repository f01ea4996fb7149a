"""Joins, duplicates and searches against brute force on small tables."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from placekit.llm import decontaminate as D, graph as G, line_dedup as L, ngram_join as N, suffix_dedup as S
from placekit.llm.words import word_list
from placekit.sources.tables import table
from tests.conftest import SF_SMALL


def rand_text(rng, n, words=200):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"x{rng.randrange(999)}" if rng.random() < share else w for w in text.split(" "))


def find(up, x):
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def grouped(sets, threshold=(4, 5)):
    """Number of links and the component's smallest index of each set."""
    inv = collections.defaultdict(list)
    for n, s in enumerate(sets):
        for g in s:
            inv[g].append(n)
    up, links = list(range(len(sets))), [0] * len(sets)
    for n, s in enumerate(sets):
        for m, k in collections.Counter(m for g in s for m in inv[g] if m < n).items():
            if k * threshold[1] >= threshold[0] * (len(s) + len(sets[m]) - k):
                links[n] += 1
                links[m] += 1
                a, b = find(up, n), find(up, m)
                up[max(a, b)] = min(a, b)
    return links, [find(up, n) for n in range(len(sets))]


# ------------------------------------------------------------------ graph


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(100)] + [(7, 7)]
    up = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = find(up, a), find(up, b)
        up[max(a, b)] = min(a, b)
    want = {x: find(up, x) for x in up if any(y != x and find(up, y) == find(up, x) for y in up)}
    got = G.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == want
    assert got.count() == len(want)
    assert G.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_block_pairs_let_any_two_meet_once(spark):
    m = spark.createDataFrame([(g, n) for g, k in ((1, 30), (2, 2), (3, 1)) for n in range(k)], "g long, n long")
    cells = collections.defaultdict(list)
    for r in G.block_pairs(m, "g", "n", 4).collect():
        cells[r["g"], r["lo"], r["hi"]].append((r["n"], r["blk"]))
    met = collections.Counter((g, a, b) for (g, lo, hi), x in cells.items() for a, ba in x for b, bb in x
                              if a < b and (lo == hi or ba != bb))
    assert set(met.values()) == {1} and len(met) == 30 * 29 // 2 + 1


# ------------------------------------------------------------------ op 4


@pytest.fixture(scope="module")
def near():
    rng = random.Random(2)
    base = [rand_text(rng, n) for n in (40, 60, 200, 5, 3, 90)]
    texts = []
    for b in base:
        texts += [b, b] + [edited(rng, b, p) for p in (0.01, 0.02, 0.03, 0.05) for _ in range(6)]
    return texts + ["", "", None, "one two", "One, two!", "a b c d", "...", rand_text(rng, 5000)]


def check_groups(rows, texts):
    by = {}
    for i, t in texts:
        by.setdefault(t or "", []).append(i)
    classes = list(by)
    sets = []
    for t in classes:
        w = word_list(t.encode())
        k = min(5, len(w))
        sets.append({tuple(w[a:a + k]) for a in range(len(w) - k + 1)} if w else set())
    links, root = grouped(sets)
    group = collections.defaultdict(list)
    for n, r in enumerate(root):
        group[r].append(min(by[classes[n]]))
    number = {t: n for n, t in enumerate(classes)}
    assert len(rows) == len(texts)
    for i, t in texts:
        n = number[t or ""]
        r = rows[i]
        assert (r["class_id"], r["n_copies"], r["n_links"], r["group_id"]) == (
            min(by[t or ""]), len(by[t or ""]), links[n], min(group[root[n]])), (i, t)
    return sum(links)


def test_groups_equal_brute_force(spark, near, monkeypatch):
    texts = list(enumerate(near))
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("node", F.lit("clash"))
    for block in (N.BLOCK, 3):  # one cell each, and groups dealt out
        monkeypatch.setattr(N.links, "__defaults__", (N.WORDS, N.THRESHOLD, N.BANDS * N.ROWS, N.TOLERANCE, block))
        rows = {r["doc_id"]: r for r in N.similar_groups(docs).collect()}
        assert check_groups(rows, texts) > 20


def test_groups_of_the_small_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = {r["doc_id"]: r for r in N.op4_ngram_join(spark, SF_SMALL).collect()}
    check_groups(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_one_document_of_each_group_stays(spark, near):
    texts = [(i if i % 7 else None, t) for i, t in enumerate(near)] + [(1, near[1]), (1, near[1])]
    docs = spark.createDataFrame([(d, t, "en") for d, t in texts], "doc_id long, text string, lang string")
    kept = N.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {r["group_id"] for r in N.similar_groups(docs).select("group_id").collect()}
    assert kept.count() == len(groups)
    assert N.drop_near_duplicates(docs.limit(0)).count() == 0


def test_pruning_keeps_what_reaches_the_threshold():
    least = N.least_agreements(0.8, 150, 15, 1e-6)
    assert list(least) == list(range(15, 151, 15)) and all(least[a] <= least[b] for a, b in zip(least, list(least)[1:]))
    rng = np.random.default_rng(3)
    sig = rng.integers(0, 1 << 32, (2, 150), dtype=np.uint32)
    sig[1, :125] = sig[0, :125]  # 83 % agree, in any order
    perm = rng.permutation(150)
    one, two = np.array([0]), np.array([1])
    assert len(N.surviving(sig[:, perm], one, two, least)[0]) == 1
    sig[1, 60:] += 1
    assert len(N.surviving(sig[:, perm], one, two, least)[0]) == 0


# ------------------------------------------------------------------ op 7


def brute_contamination(texts, items, window=13):
    wins = collections.defaultdict(set)
    for item, t in items:
        w = word_list(t.encode()) if t else []
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            wins[tuple(w[a:a + k])].add(item)
    out = []
    for t in texts:
        w = word_list(t.encode()) if t else []
        hit, found = set(), set()
        for k in {len(x) for x in wins}:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in wins:
                    hit.update(range(a, a + k))
                    found |= wins[tuple(w[a:a + k])]
        out.append((len(w), len(hit), sorted(found, key=str), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), max_size=5),
       st.lists(st.lists(st.sampled_from("abcd"), max_size=40), max_size=4), st.integers(1, 4))
def test_search_equals_brute_force(items, docs, window):
    items = [(n, " ".join(i)) for n, i in enumerate(items)]
    texts = [" ".join(d) for d in docs]
    s = D.Searcher([(n, t.encode()) for n, t in items], window)
    for t, want in zip(texts, brute_contamination(texts, items, window)):
        spans, found = s.find(word_list(t.encode()))
        assert (D._covered(spans), sorted(found, key=str)) == want[1:3]


def test_op7_rows(spark):
    docs = table(spark, SF_SMALL, "documents").collect()
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    rows = {r["doc_id"]: r for r in D.op7_decontaminate(spark, SF_SMALL).collect()}
    want = brute_contamination([d["text"] for d in docs], items)
    assert any(w[3] for w in want)
    for d, (n, hit, found, bad) in zip(docs, want):
        r = rows[d["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(found), bad)
        assert r["items_sha256"] == hashlib.sha256(",".join(map(str, found)).encode()).hexdigest()


def test_contamination_edges_and_blocks(spark):
    rng = random.Random(4)
    items = [(k, rand_text(rng, 20)) for k in range(12)] + [(3, "short item"), (10, None), (None, "null id words"), (5, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [None, "", "...", items[0][1], "a " * 50 + items[1][1], "before Short, ITEM after", "null id words",
             items[2][1][:60], "z " * 1000 + items[4][1], items[0][1]]
    docs = spark.createDataFrame([(n // 2, t, 1) for n, t in enumerate(texts)], "doc_id long, text string, items int")
    want = brute_contamination(texts, items)
    for block in (D.MAX_BLOCK_BYTES, 100):  # one block, and more than a task keeps
        got = D.contamination(docs, bench, max_block_bytes=block, keep=("doc_id", "text")).collect()
        seen = collections.Counter((r["text"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got)
        assert seen == collections.Counter((t, n, h, tuple(x for x in f if x is not None), b)
                                           for t, (n, h, f, b) in zip(texts, want))
    assert D.drop_contaminated(docs, bench).columns == docs.columns
    assert D.contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert D.contamination(docs.limit(0), bench).count() == 0


# ------------------------------------------------------------------ op 8


def brute_repeats(texts, size):
    words = [word_list(t.encode()) if t else [] for t in texts]
    seen = collections.Counter(tuple(w[a:a + size]) for w in words for a in range(len(w) - size + 1))
    return [{x for a in range(len(w) - size + 1) if seen[tuple(w[a:a + size])] > 1 for x in range(a, a + size)}
            for w in words]


def test_repeated_passages_equal_brute_force(spark):
    rng = random.Random(6)
    p = [rand_text(rng, n, 5000) for n in (50, 49, 51, 80, 300)]
    texts = [rand_text(rng, 400, 5000) for _ in range(20)] + [None, "", "a b", p[0], p[0]]
    texts += [rand_text(rng, rng.randrange(80), 5000) + " " + x + " " + rand_text(rng, rng.randrange(80), 5000)
              for x in p for _ in range(4)]
    texts += [p[3] + " " + p[3], "le " * 200, p[4][:900], " ".join(p)]
    docs = spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = {r["doc_id"]: r for r in S.repeated_passages(docs).collect()}
    assert len(rows) == len(texts)
    for n, want in enumerate(brute_repeats(texts, 50)):
        got = [x for s in rows[n]["spans"] for x in range(s["start"], s["end"])]
        assert len(got) == len(set(got)) and set(got) == want, n
        gone = {x for s in rows[n]["drop"] for x in range(s["start"], s["end"])}
        assert gone <= want
    left = collections.Counter()  # every passage that repeats stays somewhere
    for n, t in enumerate(texts):
        w = word_list(t.encode()) if t else []
        gone = {x for s in rows[n]["drop"] for x in range(s["start"], s["end"])}
        left.update(tuple(w[a:a + 50]) for a in range(len(w) - 49) if not gone & set(range(a, a + 50)))
    for n, t in enumerate(texts):
        w = word_list(t.encode()) if t else []
        assert all(left[tuple(w[a:a + 50])] or any(
            set(range(a, a + 50)) & {x for s in rows[n]["drop"] for x in range(s["start"], s["end"])}
            for _ in [0]) for a in range(len(w) - 49))
    assert S.repeated_passages(docs.limit(0)).count() == 0


def test_selected_positions_depend_on_content_alone():
    from placekit.llm.words import hashed_words
    rng = random.Random(8)
    passage = rand_text(rng, 50, 5000)
    at = set()
    for _ in range(30):
        before, after = (rand_text(rng, rng.randrange(60), 5000) for _ in range(2))
        h, n = hashed_words([f"{before} {passage} {after}".encode()])
        s, p = S.selected(h, n)
        first = len(before.split())
        at.add(int(p[s.tolist().index(first)]) - first)
    assert len(at) == 1 and 0 <= at.pop() < S.WINDOW


# ------------------------------------------------------------------ op 10


def line_shingles(line):
    low = line.lower()
    return {low[i:i + 5] for i in range(max(1, len(low) - 4))}


def brute_lines(rows):
    """Texts without the lines that go; rows of (id, text)."""
    first = {}
    for d, t in sorted((r for r in rows if r[1]), key=lambda r: r[0]):
        for k, line in enumerate(t.split("\n")):
            if line.strip():
                first[line] = min(first.get(line, (d, k)), (d, k))
    lines = list(first)
    _, root = grouped([line_shingles(x) for x in lines])
    keep = {}
    for n, line in enumerate(lines):
        keep[root[n]] = min(keep.get(root[n], first[line]), first[line])
    at = {line: n for n, line in enumerate(lines)}
    return [None if t is None else "\n".join(
        x for k, x in enumerate(t.split("\n")) if not x.strip() or keep[root[at[x]]] == (d, k)) for d, t in rows]


def test_lines_equal_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    base = [rand_text(rng, n, 3000) for n in (4, 12, 30, 60, 8)]
    variants = [b[:k] + rng.choice("xyz") + b[k + 1:] for b in base for k in (rng.randrange(len(b)) for _ in range(8))]
    pool = base + variants + ["short", "", "Ein Wort ohne Ende " + "ü" * 60, "日本語" * 12, base[2].upper(), " " * 20, " " * 30]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(25)]
    texts += [None, "", "\n\n", base[1], base[1] + "\n" + base[1], "only this line here, alone\r"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(d, t, "k", len(t or "")) for d, t in rows],
                                 "doc_id long, text string, node string, n_chars long")
    want = brute_lines(rows)
    for block in (L.BLOCK, 2):
        monkeypatch.setattr(L.similar_lines, "__defaults__", (L.CHARS, L.THRESHOLD, block))
        got = {r["doc_id"]: r for r in L.dedup_lines(docs).collect()}
        assert [got[d]["text"] for d, _ in rows] == want
        assert all(r["n_chars"] == len(r["text"] or "") and r["node"] == "k" for r in got.values())
    assert L.dedup_lines(docs).columns == docs.columns
    assert L.dedup_lines(docs.limit(0)).count() == 0


def test_lines_of_the_small_table(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in L.op10_line_dedup(spark, SF_SMALL).collect()}
    for d, want in zip(docs, brute_lines([(d["doc_id"], d["text"]) for d in docs])):
        assert rows[d["doc_id"]]["kept_sha256"] == hashlib.sha256((want or "").encode()).hexdigest()


def test_lines_without_id_and_repeated_rows(spark):
    line = "a line that is long enough to count"
    docs = spark.createDataFrame([(None, line), (None, line + "\n" + line), (4, line), (4, line), (9, None)],
                                 "doc_id long, text string")
    out = L.dedup_lines(docs).collect()
    assert len(out) == 5 and sum((r["text"] or "").count(line) for r in out) in (1, 2)  # repeated rows are one document


def test_lines_run_no_python(spark):
    import inspect
    assert not any(x in inspect.getsource(L) for x in ("udf", "Pandas", "Arrow", "mapIn", ".rdd"))
