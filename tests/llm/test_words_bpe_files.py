"""Words, BPE, token files: equality with plain Python and the tokenizers library."""

import hashlib
import io
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from placekit.llm import bpe as B, token_files as T, words as W
from tests.conftest import SF_SMALL

ODD = ["", None, "a  b", " a", "a ", "\n a\n\n b \t c", "<|endoftext|> x<|endoftext|>", "x<|startoftext|>y",
       "don't we'LL 's 'S", "é é ΑΣ ΣΑΣ İI", "日本語 テキスト 123 4 ５", "a b 　c", "🙂🙂 x", "  ", "́a á ́",
       "x" * 5000, "ab\x00c \x7f \x85 d", "Ａ １ ½ ²", " ́b  ́", "fiﬁ ẛ̣", "a\x1cb \x1d \x1e", "a\n b", "a \nb",
       "KK ÅÅ ẞ", "a​ b﻿", "word " * 3000]
FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(t):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [w.encode() for w in WORD.findall(lower)]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    from tokenizers import Tokenizer
    path = public_tokenizers.path(request.param)
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    return lib, B.Bpe(B.read_spec(path))


def check(both, texts):
    lib, own = both
    for t, ids in zip(texts, own.encode(texts)):
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(t)
        assert own.decode(ids) == lib.decode(want, skip_special_tokens=False).encode(), repr(t)


def test_bpe_equals_the_library_on_odd_texts(both):
    check(both, ODD)
    check(both, ODD)  # now remembered


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_bpe_equals_the_library_on_any_text(both, texts):
    check(both, texts)


def test_bpe_forgets_and_learns_again(both, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 3)
    check(both, ["one two three four", "five six", "one two seven"])


def test_words_are_remembered_without_their_neighbours(monkeypatch):
    from tokenizers import Tokenizer
    path = public_tokenizers.path(FILES[1])
    lib, own = Tokenizer.from_file(path), B.Bpe(B.read_spec(path))
    check((lib, own), ["ein Wörtchen, là\nnoch. eins", "noch"])

    def new(*_):
        raise AssertionError("all pre-tokens are known")

    monkeypatch.setattr(own, "_learn", new)
    monkeypatch.setattr(own, "_fragments", new)
    check((lib, own), ["ein, là eins. Wörtchen\nnoch,", "noch\nnoch Wörtchen. là"])


def test_all_latin_characters_are_cut_as_by_the_library(both):
    some = [chr(c) for c in range(0x260)]
    check(both, [f"a{c}b {c} 1{c}{c}2'{c} {c}'s\n{c}" for c in some] + ["".join(some), " ".join(some)])


def test_forced_cuts_are_pairs_of_no_token(both):
    own = both[1]
    at = {s: b for b, s in enumerate(B.byte_symbols())}
    inside = {(at[a], at[b]) for token in own.vocab
              for x in [token.removesuffix(own.suffix) if own.suffix else token]
              for a, b in zip(x, x[1:]) if a in at and b in at}
    assert own.cut.any() and not any(own.cut[a, b] for a, b in inside)


def test_op2_rows(spark):
    from tokenizers import Tokenizer
    from placekit.sources.tables import table
    lib = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    lib.no_truncation()
    lib.no_padding()
    rows = {r["doc_id"]: r for r in B.op2_bpe(spark, SF_SMALL).collect()}
    docs = table(spark, SF_SMALL, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = lib.encode(d["text"] or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        r = rows[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def test_bpe_edge_rows(spark):
    path = public_tokenizers.path(FILES[0])
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (None, "a b", "z"), (None, "a b", "z")],
                                 "doc_id long, text string, ids string")
    out = B.encode_decode(docs, path).orderBy("n_tokens").collect()
    assert [r["n_tokens"] for r in out] == [0, 0, 2, 2] and out[0]["decoded"] == b""
    assert B.encode_decode(docs.limit(0), path).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9é \n.-日", max_size=60)), max_size=6))
def test_words_and_their_hashes(texts):
    raw = [t.encode() if t is not None else None for t in texts]
    want = [plain_words(t) for t in texts]
    assert [W.word_list(t) for t in raw] == want
    h, n = W.hashed_words(raw)
    assert n.tolist() == [len(w) for w in want]
    flat = [w for words in want for w in words]
    assert len(flat) == len(h) and len(set(flat)) == len({(int(x)) for x in h})
    seen = {}
    assert all(seen.setdefault(w, int(x)) == int(x) for w, x in zip(flat, h))


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    monkeypatch.setattr(W, "_BLOCK", 64)
    texts = [b"some words here " * 50, None, b"x" * 500, b"tail of words", b" " * 200]
    h, n = W.hashed_words(texts)
    assert n.tolist() == [150, 0, 1, 3, 0] and len(set(h[:150].tolist())) == 3


def test_shingles_of_short_texts():
    h, n = W.hashed_words([b"a b c d e f", b"", b"a b", b"a b", b"b a", b"a b c d e"])
    s, k = W.shingles(h, n, 5)
    assert k.tolist() == [2, 0, 1, 1, 1, 1] and s[2] == s[3] != s[4] and s[0] == s[5]


def test_op9_rows_equal_the_library(spark):
    from tokenizers import Tokenizer
    from placekit.sources.tables import table
    lib = Tokenizer.from_file(public_tokenizers.path(FILES[1]))
    lib.no_truncation()
    lib.no_padding()
    rows = {r["doc_id"]: r for r in T.op9_token_files(spark, SF_SMALL).collect()}
    at = 0
    for d in table(spark, SF_SMALL, "documents").orderBy("doc_id").collect():
        ids = np.array(lib.encode(d["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        r = rows.pop(d["doc_id"])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not rows


def test_token_file_frames_and_checksums():
    import zstandard
    rng = np.random.default_rng(1)
    docs = [(k if k != 3 else None, rng.integers(0, 60000, n)) for k, n in enumerate([5, 0, 300, 7, 1000, 2])]
    w = T.FrameWriter(4, 2, frame_ids=310)
    parts = [p for d, ids in docs for p in w.add(d, ids)] + w.close()
    raw = b"".join(p + T.SEPARATOR for p in parts)
    f = T.TokenFile(io.BytesIO(raw))
    assert f.rank == 4 and len(f.frames) == 4
    assert [(d, i.tolist()) for d, i in f.read()] == [(d, i.tolist()) for d, i in docs]
    assert [i.tolist() for _, i in f.find([4])] == [docs[4][1].tolist()]
    # only the frame that is asked for is read
    asked = []
    plain = T.TokenFile.frame
    f.frame = lambda k: asked.append(k) or plain(f, k)
    list(f.read([5]))
    assert asked == [3]
    # standard tools read the file as it is
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert whole == b"".join(i.astype("<u2").tobytes() for _, i in docs)
    broken = bytearray(raw)
    broken[int(f.frames[0]["offset"]) + 12] ^= 1
    with pytest.raises(Exception):
        list(T.TokenFile(io.BytesIO(bytes(broken))).read([2]))
    with pytest.raises(ValueError):
        T.TokenFile(io.BytesIO(b"no table" * 20))


def test_token_files_edge_rows(spark, tmp_path):
    path = public_tokenizers.path(FILES[1])
    docs = spark.createDataFrame([(2, "b"), (None, "a a"), (1, None), (2, "b"), (5, "")], "doc_id long, text string")
    T.write_tokens(docs.withColumn("frame", F.lit(1)), str(tmp_path / "t"), path, files=2)
    back = T.read_tokens(spark, str(tmp_path / "t")).orderBy("rank", "number").collect()
    assert [r["doc_id"] for r in back] == [None, 1, 2, 2, 5]
    assert [r["n_tokens"] for r in back] == [3, 1, 2, 2, 1]
    T.write_tokens(docs.limit(0), str(tmp_path / "e"), path, files=2)
    assert T.read_tokens(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("file", FILES)
def test_tables_of_a_task_are_bounded_together(file, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 200)
    own = B.Bpe(B.read_spec(public_tokenizers.path(file)))
    for k in range(60):
        own.encode([f"a{k}x{i}y, b{k}{i}é 日{k}" for i in range(5)])
        tables = own.chunks, own.inner, own.tokens, own.pieces
        assert sum(len(t) + len(t.before) for t in tables) <= 200 + 60  # and what one call adds


def test_tasks_work_on_few_texts_at_a_time(spark, monkeypatch):
    import pyarrow as pa
    from placekit.llm import decontaminate, toxicity
    texts = ["some words " * 20] * 600 + [None, "", "long " * 600_000, "long " * 600_000, "end"]
    batch = pa.RecordBatch.from_pydict({"k0": list(range(len(texts))), "k1": texts, "text": texts})
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    tasks, kind = [], type(docs)
    whole = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, f, *a, **k: tasks.append(f) or whole(df, f, *a, **k))
    decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, "some words")], "item_id long, text string"))
    toxicity.drop_toxic(docs, toxicity.Model(np.arange(3), 0.0, np.zeros(3), np.zeros((3, 2))))
    B.encode_decode(docs, public_tokenizers.path(FILES[0]))
    assert len(tasks) == 3
    for run in tasks:
        out = list(run(iter([batch])))
        assert [x for b in out for x in b.column("k0").to_pylist()] == list(range(len(texts)))
        assert max(len(b) for b in out) <= 256  # and no two of the long texts
        assert not any({602, 603} <= set(b.column("k0").to_pylist()) for b in out)


def test_new_byte_pre_tokens_cost_ids_alone(monkeypatch):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path(FILES[1]))
    own = B.Bpe(B.read_spec(public_tokenizers.path(FILES[1])))
    asked, model = [], own.model[True]

    class IdsAlone:  # has no ``encode``, which makes offsets and words as well
        def encode_batch_fast(self, calls, add_special_tokens):
            asked.extend(calls)
            return model.encode_batch_fast(calls, add_special_tokens=add_special_tokens)

    own.model = {True: IdsAlone()}
    monkeypatch.setattr(B, "CALL", 7)
    texts = [" ".join(f"Zq{k}xé{k * k}q日{k}" for k in range(n)) + end for n in (0, 1, 2, 7, 8, 60) for end in ("", "\n ", "ß")]
    texts += [" ".join(f"Zq{k}xé{k * k}q" for k in range(90)), None, "<|endoftext|>a<|endoftext|>"]
    want = [np.array(lib.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode(texts) == want == own.encode(texts)
    assert max(len(c.split(" ")) for c in asked) == 7
