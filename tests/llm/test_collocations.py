"""Collocations against brute force."""

import collections
import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from placekit.llm import collocations as C


def brute(rows, least, longest, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][w[i:i + k]] += 1
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        mine = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                        for k in range(1, len(p)))
            mine.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in C.collocations(df, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(rng, number, vocabulary=30):
    words = [rng.choice(["", "Ü", "x\x00", "日", "A", " ", " "]) + f"w{i}" for i in range(vocabulary)]
    fixed = [[rng.choice(words) for _ in range(rng.randrange(2, 8))] for _ in range(12)]
    out = []
    for _ in range(number):
        t = []
        for _ in range(rng.randrange(25)):
            t += rng.choice(fixed) if rng.random() < 0.5 else [rng.choice(words)]
            t.append(rng.choice(["", "", "", ".", "\n", "\t", "!?", "\x0b", "\r"]))
        out.append(" ".join(t))
    return out


def test_collocations_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice(["en", "de", None, "und"]), t) for t in texts(rng, 120)]
    rows += [("en", None), ("en", ""), ("fr", "... \n"), ("es", "a a a a a a a a"), ("en", "Same TEXT here"), (None, "tail")]
    rows += [("en", "same text here")] * 40  # repeated rows count
    df = spark.createDataFrame([(i, lang, t, 1, "clash") for i, (lang, t) in enumerate(rows)],
                               "doc_id long, lang string, text string, f int, words string").repartition(5)
    for chunk, section, least, top in ((C.CHUNK, C.SECTION, 4, 2000), (300, 8, 3, 7)):
        monkeypatch.setattr(C, "CHUNK", chunk)
        want = brute(rows, least, 5, top)
        assert len(want) > 15
        assert mined(df, least=least, section=section, top=top) == want


def test_long_text_and_empty_table(spark):
    rng = random.Random(5)
    text = " ".join(texts(rng, 3000, 300))
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    assert mined(df, least=20) == brute([("en", text)], 20, 5, 2000)
    assert mined(df.limit(0)) == [] and mined(df, least=10 ** 9) == []


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(10 ** 13 + 7, 9 * 10 ** 14 + 1, 2 * 10 ** 13 + 11, 10 ** 13 + 9), (100, 10 ** 15, 100, 100), (101, 28345678, 7777, 333)]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    got = df.selectExpr("(cast(1000 as decimal(4, 0)) * cast(a as decimal(16, 0)) * cast(n as decimal(16, 0)))"
                        " div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0))) as s").collect()
    assert [r["s"] for r in got] == [1000 * a * n // (x * y) for a, n, x, y in rows]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=60), st.integers(1, 32), st.lists(st.sampled_from([1, 254, 255, 256, 10 ** 12]), min_size=60, max_size=60))
def test_filters_are_lossless_and_merge(values, half, counts):
    codes = np.array(values, np.uint64) & np.uint64((1 << (2 * half)) - 1)
    prints = C.permuted(codes, half)
    assert (C.permuted(prints, half, back=True) == codes).all()
    prints = np.unique(prints)
    counts = np.array(counts[:len(prints)], np.int64)
    back = C.read_filter(*C.make_filter(prints, counts, 2 * half), 2 * half)
    assert (back[0] == prints).all() and (back[1] == counts).all()
    both = C.merged([back, (prints[::2], counts[::2])])
    assert (both[0] == prints).all() and both[1].sum() == counts.sum() + counts[::2].sum()
