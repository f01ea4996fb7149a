"""Toxicity, chat, personal data, quality rules, pipeline."""

import collections
import inspect
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from placekit.llm import chat as C, pii as P, quality as Q, queries, toxicity as T
from placekit.sources.tables import table
from tests.conftest import SF_CHECK, SF_SMALL

# ------------------------------------------------------------------ op 1


def test_held_out_accuracy(spark):
    rows = T.op1_toxicity(spark, SF_CHECK).join(table(spark, SF_CHECK, "labels"), "doc_id").filter("held_out").collect()
    y = np.array([r["toxic"] for r in rows])
    p = np.array([r["predicted"] for r in rows])
    assert len(y) > 80 and ((p == 1) & (y == 0)).sum() <= 2 and p[y == 1].mean() > 0.65
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_factors_learn_an_interaction():
    """Neither term alone is toxic, both together are."""
    rng = np.random.default_rng(0)
    rows = [sorted({i for i in (0, 1) if rng.random() < 0.5} | {int(rng.integers(2, 12))}) for _ in range(3000)]
    y = np.array([0 in r and 1 in r for r in rows], float)
    m = T.fit(rows, y, np.arange(12))
    s = m.scores([[0], [1], [0, 1], [], [5], [0, 1, 7]])
    assert s[2] > 0.7 and s[5] > 0.7 and max(s[0], s[1], s[3], s[4]) < 0.5


def test_model_scores_by_the_formula():
    rng = np.random.default_rng(1)
    m = T.Model(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    for r in ([], [2], [0, 3, 5], list(range(6))):
        y = 0.3 + m.w[r].sum() + sum(m.v[i] @ m.v[j] for i in r for j in r if i < j)
        assert m.scores([r])[0] == pytest.approx(1 / (1 + np.exp(-y)))


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(n, f"filler{n % 7} text " + ("idiot scum" if n % 4 == 0 else "fine day"), 1)
                                  for n in range(400)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(n, int(n % 4 == 0)) for n in range(400)] + [(None, 1), (3, None), (5, 7)],
                                   "doc_id long, toxic int")
    model = T.train(docs, labels)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "an idiot scum"), (1, "an idiot scum"), (2, "fine " * 9)],
                                "doc_id long, text string")
    s = [r["score"] for r in T.score(odd, model).collect()]
    assert len(s) == 5 and s[0] == s[1] < 0.5 and s[2] == s[3] >= 0.7 and s[4] < 0.5
    assert T.drop_toxic(odd, model).count() == 3 and T.score(odd.limit(0), model).count() == 0
    none = T.train(docs, labels.limit(0))
    assert len({r["score"] for r in T.score(docs, none).collect()}) == 1
    held = docs.select(T.fold().alias("f"), "doc_id").filter("f = 1").count()
    assert 0 < held < 400


# ------------------------------------------------------------------ op 3

TRICKY = ["\\### Assistant: </turn> ok", "<role>user<text>x<end>\n", "\\l \\s \\\\ <", "<next>", "", None, "é日🙂\n\n", "\\"]


def test_chat_round_trip_and_mask(spark):
    turns = [(c, n, role, TRICKY[(c + n) % len(TRICKY)]) for c in range(12)
             for n, role in enumerate(["system", "user", "assistant", "assistant", "user", "<text>", None][:c % 8])]
    turns += [(50, 1, "assistant", "b"), (50, 1, "assistant", "b"), (50, None, "user", "first"), (None, 0, "assistant", "x")]
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, ts string")
    rows = C.read_conversations(C.format_conversations(df)).collect()
    by = collections.defaultdict(list)
    for c, n, r, t in turns:
        by[c].append((n is not None, n or 0, r or "", t or ""))
    assert {r["conv_id"] for r in rows} == set(by) and len(rows) == len(by)
    for r in rows:
        want = [(x[2], x[3]) for x in sorted(by[r["conv_id"]])]
        assert [(t["role"], t["text"]) for t in r["turns"]] == want
        assert r["loss"] == [t for role, t in want if role == "assistant"]
        blocks = sum(k == 0 or want[k - 1][0] != role for k, (role, _) in enumerate(want))
        assert r["formatted"].count("<role>") == blocks  # neighbours of one role are merged
        cut = [r["formatted"][m["start"]:m["end"]] for m in r["mask"]]
        assert [x.replace("\\l", "<").replace("\\s", "\\") for x in cut] == r["loss"]
    assert C.format_conversations(df.limit(0)).count() == 0


def test_chat_has_the_hard_conversation(spark):
    r = C.op3_chat_format(spark, SF_SMALL).filter("conv_id = -7").first()
    assert r["n_turns"] == 2 and r["loss_chars"] == 26
    assert not any(x in inspect.getsource(C) for x in ("udf", "Pandas", "Arrow", "mapIn", ".rdd"))


# ------------------------------------------------------------------ op 5

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+- (9)0b%\n٣é", max_size=80))
def test_base_spans_equal_the_patterns(t):
    assert P.base_spans(t) == brute_pii(t)


def test_base_spans_are_linear():
    for t in ("9" * 200_000, "a" * 200_000 + "@", "+1" * 60_000, "1." * 100_000, "a@" * 60_000, "1 " * 100_000):
        P.base_spans(t)


@pytest.fixture(scope="module")
def crf():
    return P.train()


def test_field_learns_its_table(crf):
    rows = P.labelled_rows()
    hit = sum(sorted(P.added_spans(crf, [t], [[]])[0]) == sorted(s) for t, s in rows)
    assert hit >= 0.9 * len(rows)


def test_field_adds_what_the_patterns_miss(crf):
    new = {"please write to bob dot ross at mail dot example dot com soon": "bob dot ross at mail dot example dot com",
           "phone (030) 555-9876 today": "(030) 555-9876", "card 4000.0566.5566.5556 of hers": "4000.0566.5566.5556"}
    for t, want in new.items():
        assert not P.base_spans(t) and [t[a:b] for _, a, b in P.added_spans(crf, [t], [[]])[0]] == [want]
    clean = ["License, Version 2.0.", "it is at the dot", "in 1999 and 2004", "the @ sign", "", "x" * 9999]
    assert P.added_spans(crf, clean, [[]] * len(clean)) == [[]] * len(clean)


def test_viterbi_equals_enumeration(crf):
    import itertools
    rng = np.random.default_rng(2)
    names = list(crf.symbols)
    for n in (1, 2, 4):
        seq = [names[i] for i in rng.integers(0, len(names), n)]
        e = crf.emissions(crf.encode([seq])[0])[0]
        best = max(itertools.product(range(len(P.LABELS)), repeat=n), key=lambda y: crf.start[y[0]] + sum(
            e[t, y[t]] for t in range(n)) + sum(crf.trans[a, b] for a, b in zip(y, y[1:])))
        padded = crf.viterbi([seq, seq + names[:3]])[0]
        assert tuple(padded) == best


def test_windows_give_what_the_whole_text_gives(crf):
    rng = np.random.default_rng(3)
    lines = [t for t, _ in P.labelled_rows()]
    for _ in range(20):
        t = " thing of the words and more of it ".join(lines[i] for i in rng.integers(0, len(lines), 6))
        toks = P.tokens(t, 0, len(t))
        whole = P._spans(t, toks, crf.viterbi([[v for _, _, v in toks]])[0], [])
        assert sorted(P.added_spans(crf, [t], [[]])[0]) == sorted(whole)


def test_a_text_is_decoded_from_end_to_end(crf, monkeypatch):
    rng = np.random.default_rng(5)
    words = ["%%% of", "thing", "The", "a,", "$$$ on", "is.", "###", "&&& at"]
    lines = [t for t, _ in P.labelled_rows()]
    far = " ".join(["erat*** the&&& of%%% at%%% st.&&&"] * 10)
    texts = ["", " \n ", f"{far} 9000426309966109$$$ {far}", " " * 300 + "a 1" + " " * 300 + lines[0] + " " * 300]
    for _ in range(12):  # labelled lines far from each other
        texts.append("\n\u3000".join(" ".join(rng.choice(words, rng.integers(1, 120))) + " " + lines[i]
                                   for i in rng.integers(0, len(lines), 5)) + " \t")
    wanted = []
    for t in texts:
        toks = P.tokens(t, 0, len(t))
        wanted.append(sorted(P._spans(t, toks, crf.viterbi([[v for _, _, v in toks]])[0], [])) if toks else [])
    assert wanted[2] == [("email", 11, 697)]
    assert list(map(sorted, P.added_spans(crf, texts, [[]] * len(texts)))) == wanted
    monkeypatch.setattr(P, "PART", 100)  # parts of a text, and of its scores
    monkeypatch.setattr(P, "BATCH_TOKENS", 70)
    assert list(map(sorted, P.added_spans(crf, texts, [[]] * len(texts)))) == wanted
    for t in texts:
        at = P.windows(t)
        assert "".join(t[a:b] for a, b in at) == t.rstrip() and all(b == c for (_, b), (c, _) in zip(at, at[1:]))


def test_addresses_without_digit_or_spelled_out_dot(crf):
    for t, want in {"Reach me: jane.doe at example.org, please": ["jane.doe at example.org"],
                    "they met at the house. Then it was": [], "he was at home.": []}.items():
        assert [t[a:b] for _, a, b in P.added_spans(crf, [t], [[]])[0]] == want


def test_spelled_out_addresses_in_capitals(crf):
    rng = np.random.default_rng(4)
    lines = [t.upper() for t, _ in P.labelled_rows()]
    for _ in range(20):
        t = " THING OF THE WORDS AND MORE OF IT ".join(lines[i] for i in rng.integers(0, len(lines), 6))
        toks = P.tokens(t, 0, len(t))
        whole = P._spans(t, toks, crf.viterbi([[v for _, _, v in toks]])[0], [])
        assert sorted(P.added_spans(crf, [t], [[]])[0]) == sorted(whole)
    for dot in ("DOT", "PUNKT", "PUNTO", "POINT", "dOT"):
        assert P.windows(f"JANE AT EXAMPLE {dot} COM") and P._valid("email", f"JANE AT EXAMPLE {dot} COM")


def test_pii_rows(spark, crf):
    docs = spark.createDataFrame([(1, None, 1), (1, "", 1), (None, "a@b.c +1 (974) 555-3436 x", 2), (2, "é a@b.c", 3)],
                                 "doc_id long, text string, spans int")
    rows = P.find_pii(docs, crf).collect()
    assert [r["base"] for r in rows] == ["", "", "email:0:5,phone:6:23", "email:2:7"]
    assert all(r["base"] in r["spans"] for r in rows) and P.find_pii(docs.limit(0), crf).count() == 0
    for r in P.find_pii(table(spark, SF_SMALL, "documents"), crf, keep=("doc_id", "text")).collect():
        assert r["base"] == ",".join(f"{k}:{a}:{b}" for k, a, b in brute_pii(r["text"]))


# ------------------------------------------------------------------ op 6


def brute_quality(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    three = list(zip(w, w[1:], w[2:]))
    many = collections.Counter(three)
    covered = {x for i, g in enumerate(three) if many[g] > 1 for x in range(i, i + 3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)),
            len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_base_equals_brute_force(spark):
    for r in Q.quality_rules(table(spark, SF_SMALL, "documents")).join(
            table(spark, SF_SMALL, "documents").select("doc_id", "text"), "doc_id").collect():
        assert tuple(r[c] for c in BASE) == brute_quality(r["text"])


def test_quality_edges(spark):
    texts = [None, "", " \n\t\x0b\r ", "a b c a b c", "x\nx\n \n \nx", "#*$ %&|<>", "é 日本 \xa0 b", "a  a a a", "one\n\none"]
    docs = spark.createDataFrame([(n // 2, t, None if n % 2 else "xx", 1) for n, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, words int")
    got = collections.Counter(tuple(r[c] for c in BASE) for r in Q.quality_rules(docs).collect())
    assert got == collections.Counter(map(brute_quality, texts))
    assert Q.quality_rules(docs).filter("kept").count() == 0 and Q.quality_rules(docs.limit(0)).count() == 0


def test_distance_equals_the_formula(spark):
    refs = [0.5, 0.3, 0.2, 0.0]
    for counts in ([5, 3, 2, 0], [0, 0, 0, 9], [1, 0, 0, 0], [0, 0, 0, 0], [7, 1, 9, 4]):
        got = spark.range(1).select(Q.js_distance(
            F.array(*[F.lit(c).cast("bigint") for c in counts]), F.lit(sum(counts)).cast("bigint"), refs)).first()[0]
        p = np.array(counts, float)
        if not p.sum():
            assert got == 1.0
            continue
        p, q = p / p.sum(), np.array(refs)
        m = (p + q) / 2
        kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x)
        assert got == pytest.approx(np.sqrt(max(0, (kl(p) + kl(q)) / 2)), abs=1e-9)


def test_verdicts_follow_the_labels(spark):
    rows = Q.op6_quality_rules(spark, SF_CHECK).join(table(spark, SF_CHECK, "labels"), "doc_id").filter("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1
    assert not any(x in inspect.getsource(Q) for x in ("udf", "Pandas", "Arrow", "mapIn", ".rdd"))


# ------------------------------------------------------------------ pipeline and registration


def test_every_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    from tests.oracle_compare import compare, duck
    ok, *_, detail = compare(spark, SF_SMALL, name, queries.QUERIES[name], queries.ORACLE[name], duck(SF_SMALL))
    assert ok, detail


def test_pipeline_equals_its_stages_by_brute_force(spark):
    """The last stage's rows are those of the kept documents, and each stage
    drops just what its operator decides on the stage before."""
    from tests.llm.test_similarity import brute_contamination, brute_lines, check_groups
    from placekit.session import materialize
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "decontaminate", "tokenize"]
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(materialize(stage(spark, steps[-1], SF_SMALL)))
    at = [{r["doc_id"]: r for r in s.collect()} for s in steps]
    assert all(s.columns == columns for s in steps[:5])
    model = T.train_on_folds(docs, table(spark, SF_SMALL, "labels"))
    assert set(at[1]) == {r["doc_id"] for r in T.score(docs, model).filter("score < 0.7").collect()}
    rows = [(r["doc_id"], r["text"]) for r in at[1].values()]
    assert [at[2][d]["text"] for d, _ in rows] == brute_lines(rows) and len(at[2]) == len(at[1])
    assert all(r["n_chars"] == len(r["text"]) for r in at[2].values())
    from placekit.llm.ngram_join import similar_groups
    groups = {r["doc_id"]: r for r in similar_groups(steps[2]).collect()}
    check_groups(groups, [(r["doc_id"], r["text"]) for r in at[2].values()])
    assert set(at[3]) == {r["group_id"] for r in groups.values()}
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    kept = [d for d, r in at[3].items() if not brute_contamination([r["text"]], items)[0][3]]
    assert set(at[4]) == set(kept) == set(at[5])
    assert {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF_SMALL).collect()} == {
        d: r["n_tokens"] for d, r in at[5].items()}
