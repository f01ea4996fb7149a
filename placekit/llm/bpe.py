"""BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no vocabulary token can never
be joined by a merge, so a text may be cut between them: the fragments encode
independently and their ids are concatenated.  A blank is in no token of the
word vocabulary and only at the start of a token of the byte vocabulary, so
blanks are the first cuts; inside a word the pair table gives the others.  A
text of Latin letters alone is cut into its pre-tokens at once where the byte
vocabulary has its usual pattern: they repeat more often than what stands
between blanks.

Fragments repeat, so each task remembers their ids in a bounded table and
encodes only new ones, all of a batch in one call of the tokenizer's model.
The vocabulary file is a parameter; it is read where the session runs and
sent to the tasks (a few MB).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.llm.batches import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CALL = 256  # fragments in one call of the model; a longer text costs more for each
REMEMBERED = 400_000  # entries of a task's tables, all together

# White space of Unicode, which the tokenizers' patterns mean by \\s; Python's
# str.split also takes U+001C to U+001F.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_KNOWN = "\u0250"
_NOT_KNOWN = re.compile(f"[^\0-{chr(ord(_KNOWN) - 1)}]")

# Fixed value: the pre-tokens of a byte-level vocabulary that names no pattern.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _known(kind: str) -> str:
    """The characters before ``_KNOWN`` of a class of the patterns, for a set of ``re``."""
    of = regex.compile(kind)
    return "".join(re.escape(c) for c in map(chr, range(ord(_KNOWN))) if of.match(c))


def _latin_pattern() -> re.Pattern:
    """``BYTE_LEVEL_PATTERN`` for texts of characters before ``_KNOWN``, whose classes are
    written out.  Only alternatives that begin with different characters change places."""
    letter, number, space = map(_known, (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(f" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letter}{number}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


def _patterns(pre: dict) -> str:
    """The pre-token pattern that a tokenizer file names."""
    for step in pre.get("pretokenizers", [pre]):
        if step["type"] == "Split":
            return step["pattern"]["Regex"]
        if step["type"] == "ByteLevel" and step["use_regex"]:
            return BYTE_LEVEL_PATTERN
    raise ValueError("the tokenizer file names no pre-token pattern")


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte:
    a byte that prints is itself, the others follow from U+0100 in order."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, nxt = [""] * 256, 256
    for b in range(256):
        if b in prints:
            out[b] = chr(b)
        else:
            out[b] = chr(nxt)
            nxt += 1
    return out


class Remembered(dict):
    """A bounded table: what is not asked for while it fills up once goes."""

    def __init__(self):
        super().__init__()
        self.before: dict = {}

    def age(self) -> None:
        self.before = dict(self)
        self.clear()

    def older(self, key):
        """A value from before, taken over."""
        v = self.before.get(key)
        if v is not None:
            self[key] = v
        return v


class Bpe:
    """One tokenizer file: ``encode`` texts to little-endian unsigned 32-bit
    ids, ``decode`` them back to text."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        t = json.loads(spec)
        self.vocab = t["model"]["vocab"]
        self.specials = [x["content"] for x in t["added_tokens"]]
        self.suffix = t["model"]["end_of_word_suffix"] or ""
        self.prefix = t["model"].get("continuing_subword_prefix")
        self.word_ends = bool(self.suffix)
        self.id_bytes = {x["id"]: x["content"].encode() for x in t["added_tokens"]}
        self.id_bytes.update((i, s.encode()) for s, i in self.vocab.items())
        self.chunks = Remembered()  # what each chunk encodes to
        self.inner = Remembered()  # the same with the blank before it left out of the key
        self.tokens = Remembered()  # what each pre-token of Latin texts encodes to
        self.pieces = Remembered()  # what each other pre-token (bytes) encodes to
        pattern = _patterns(t["pre_tokenizer"])
        self.pattern = regex.compile(pattern)
        plain = pattern == BYTE_LEVEL_PATTERN and not self.word_ends and not self.tok.normalizer
        self.latin = _latin_pattern() if plain else None
        self._models(t)
        self._pairs()

    def _models(self, t: dict) -> None:
        """The same merges with and without the word end, for many fragments
        joined by blanks at a time; a blank is not a byte symbol."""
        from tokenizers import Tokenizer
        self.model = {}
        for end in {True, not self.word_ends}:
            spec = dict(t, normalizer=None, post_processor=None, decoder=None, added_tokens=[],
                        truncation=None, padding=None,
                        pre_tokenizer={"type": "WhitespaceSplit"})
            spec["model"] = dict(t["model"], end_of_word_suffix=(t["model"]["end_of_word_suffix"] if end else None))
            self.model[end] = Tokenizer.from_str(json.dumps(spec))

    def _pairs(self) -> None:
        """``cut[a, b]``: the symbols a, b are neighbours inside no token."""
        at = {s: b for b, s in enumerate(byte_symbols())}
        self.symbol = at
        self.cut = np.ones((256, 256), bool)
        for token in self.vocab:
            if self.suffix and token.endswith(self.suffix) and token != self.suffix:
                token = token[:-len(self.suffix)]
            codes = [at.get(c) for c in token]
            for a, b in zip(codes, codes[1:]):
                if a is not None and b is not None:
                    self.cut[a, b] = False
        self.char = np.array([ord(s) for s in byte_symbols()], np.uint32)
        # the number of symbols of each id, where ids alone tell which bytes they stand for
        self.symbols = None
        if not self.word_ends and not self.prefix and at.keys() <= self.vocab.keys():
            self.symbols = np.zeros(max(self.vocab.values()) + 1, np.int64)
            for token, i in self.vocab.items():
                self.symbols[i] = len(token)

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Encode chunks that are not remembered: their pre-tokens, and of these
        the ones not remembered all together."""
        cut = self._pre_tokens(chunks)
        known = self.pieces
        flat = [p for ps in cut for p in ps]
        new = [p for p in dict.fromkeys(flat) if p not in known and known.older(p) is None]
        known.update(zip(new, self._encoded(new)))
        return [known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps]) for ps in cut]

    def _encoded(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of every pre-token."""
        out: list[bytes] = []
        for at in range(0, len(pieces), 16384):
            part = pieces[at:at + 16384]
            ids, owner = self._fragments(b"".join(part), list(map(len, part)))
            bounds = (np.searchsorted(owner, np.arange(len(part) + 1)) * 4).tolist()
            coded = ids.tobytes()
            out += [coded[a:b] for a, b in zip(bounds, bounds[1:])]
        return out

    def _pre_tokens(self, chunks: list[str]) -> list[list[bytes]]:
        """The pre-tokens of every chunk, in UTF-8."""
        out: list = [None] * len(chunks)
        simple: list[int] = []  # letters of ASCII, no line break
        for i, c in enumerate(chunks):
            if c.isascii() or max(c) < _KNOWN:  # classes of letters that all versions of Unicode share
                if not self.word_ends and c.isascii() and c[-1:] > " " and "\n" not in c and not c[:2].isspace():
                    simple.append(i)
                else:
                    out[i] = [x.encode() for x in self.pattern.findall(c.lower() if self.word_ends else c)]
            else:
                c = self.tok.normalizer.normalize_str(c) if self.tok.normalizer else c
                out[i] = [bytes(map(self.symbol.__getitem__, x))
                          for x, _ in self.tok.pre_tokenizer.pre_tokenize_str(c)]
        # all simple ones in one call: a line break is a pre-token between them
        found: list[bytes] = []
        done = iter(simple)
        for x in self.pattern.findall("\n".join([chunks[i] for i in simple])) if simple else ():
            if x == "\n":
                out[next(done)] = found
                found = []
            else:
                found.append(x.encode())
        if simple:
            out[next(done)] = found
        return out

    def _fragments(self, raw: bytes, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens that follow each other in ``raw``, and each
        id's pre-token.

        Cuts every pre-token at the byte pairs that no token contains; only
        the last fragment of a word carries the word end."""
        if not sizes:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        codes = np.frombuffer(raw, np.uint8)
        ends = np.zeros(len(codes), bool)
        ends[np.cumsum(sizes) - 1] = True
        stops = np.flatnonzero(ends[:-1] | self.cut[codes[:-1], codes[1:]])
        spaced = np.insert(self.char[codes], stops + 1, 32).tobytes().decode("utf-32-le")
        if self.symbols is not None:
            starts = (stops + np.arange(2, len(stops) + 2))[CALL - 1::CALL].tolist()  # of every CALL-th fragment
            calls = [spaced[a:b] for a, b in zip([0, *starts], [*(x - 1 for x in starts), len(spaced)])]
            # without offsets and words, which cost more than the ids: lengths tell whose an id is
            ids = np.concatenate([np.array(e.ids, "<u4") for e in
                                  self.model[True].encode_batch_fast(calls, add_special_tokens=False)])
            return ids, np.searchsorted(np.cumsum(sizes), np.cumsum(self.symbols[ids]))
        fragments = spaced.split(" ")
        last = np.append(ends[stops], True)
        piece = np.cumsum(np.append(0, last[:-1]))
        ids, owner = [], []
        for end in sorted(self.model):
            at = np.flatnonzero(last == end) if self.word_ends else np.arange(len(fragments))
            for lo in range(0, len(at), CALL):
                some = at[lo:lo + CALL]
                enc = self.model[end].encode(" ".join([fragments[i] for i in some.tolist()]),
                                             add_special_tokens=False)
                ids.append(np.array(enc.ids, "<u4"))
                owner.append(some[np.array(enc.word_ids, np.int64)])
        ids, owner = np.concatenate(ids), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return ids[order].astype("<u4"), piece[owner[order]]

    def _chunk(self, text: str) -> tuple[list[str], bool]:
        """The text's chunks between certain cuts at blanks, and whether the
        blank before each chunk but the first belongs to it.

        White space is dropped by the word vocabulary.  In the byte vocabulary
        a single blank between two other characters starts a pre-token; next
        to other white space it need not, so such chunks stay together."""
        if self.word_ends:
            if _SEPARATORS.search(text):  # white space to Python alone
                return [x for x in _SPACE.split(text) if x], False
            return text.split(), False
        parts = text.split(" ")
        if all(parts) and "\n " not in text and " \n" not in text and not _OTHER_SPACE.search(text):
            return parts, True
        out = [parts[0]]
        for a in parts[1:]:
            if a and out[-1] and not a[0].isspace() and not out[-1][-1].isspace():
                out.append(" " + a)
            else:
                out[-1] = out[-1] + " " + a
        return out, False

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (null: empty) as little-endian unsigned 32-bit
        integers.  Strings of added tokens stand for their id, as in the library."""
        tables = {"chunks": self.chunks, "inner": self.inner, "tokens": self.tokens}
        known = [*tables.values(), self.pieces]
        if sum(map(len, known)) > REMEMBERED // 2:
            for table in known:
                table.age()
        coded: list[list] = []  # of each text, its chunks' ids; None where not remembered
        new: dict[str, dict[str, None]] = {k: {} for k in tables}  # chunks that are not remembered
        gaps: list[tuple] = []  # what to fill in: table, parts, where in them, chunks
        for t in texts:
            segments: list = [t or ""]
            for s in self.specials:
                if t and s in t:
                    segments = [y for x in segments for y in self._around(x, s)]
            parts: list = []
            for x in segments:
                if isinstance(x, bytes):
                    parts.append(x)
                elif x and self.latin and (x.isascii() or not _NOT_KNOWN.search(x)):
                    self._look_up(self.latin.findall(x), tables["tokens"], parts, new["tokens"], gaps)
                elif x:
                    chunks, blank = self._chunk(x)
                    if blank:
                        self._look_up(chunks[:1], tables["chunks"], parts, new["chunks"], gaps)
                        self._look_up(chunks[1:], tables["inner"], parts, new["inner"], gaps)
                    else:
                        self._look_up(chunks, tables["chunks"], parts, new["chunks"], gaps)
            coded.append(parts)
        for kind, chunks in new.items():
            if chunks:
                if kind == "tokens":
                    got = self._encoded([c.encode() for c in chunks])
                else:
                    got = self._learn([" " + c for c in chunks] if kind == "inner" else list(chunks))
                tables[kind].update(zip(chunks, got))
        for table, parts, where, chunks in gaps:
            for i, c in zip(where, chunks):
                parts[i] = table[c]
        return list(map(b"".join, coded))

    def _look_up(self, chunks: list[str], table: Remembered, parts: list, new: dict, gaps: list) -> None:
        base = len(parts)
        got = list(map(table.get, chunks))
        parts += got
        # a few lists for all gaps of a text: an object for each keeps the garbage collector busy
        where = [i for i, v in enumerate(got, base) if v is None]
        if where:
            missing = [chunks[i - base] for i in where]
            before = table.before
            for c in missing:
                v = before.get(c)
                if v is None:
                    new[c] = None
                else:
                    table[c] = v
            gaps.append((table, parts, where, missing))

    def _around(self, x, special: str) -> list:
        if isinstance(x, bytes):
            return [x]
        i = next(k for k, v in self.id_bytes.items() if v == special.encode())
        out: list = []
        for part in x.split(special):
            out += [np.array([i], "<u4").tobytes(), part]
        return out[1:]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the text of encoded ids, special tokens included: the
        tokens joined by blanks, or, in a byte vocabulary, their bytes."""
        table = self.id_bytes
        tokens = [table[i] for i in np.frombuffer(ids, "<u4").tolist()]
        if self.word_ends:
            return b" ".join(tokens)
        symbol = self.symbol
        return bytes(symbol[c] for c in b"".join(tokens).decode()).decode("utf-8", "replace").encode()


_HELD = "placekit_llm_bpe"


def tokenizer(spec: str) -> Bpe:
    """The task process's tokenizer for a file's content; kept with its
    remembered fragments for later tasks of the same worker."""
    held = sys.__dict__.setdefault(_HELD, {})
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in held:
        held.clear()
        held[key] = Bpe(spec)
    return held[key]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_decode(docs: DataFrame, tokenizer_file: str, keep: tuple[str, ...] = ("doc_id",),
                  with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns, ``ids`` (binary,
    little-endian unsigned 32-bit), ``n_tokens`` and, if ``with_text``,
    ``decoded`` (binary, UTF-8 of the ids' text).

    A null text is an empty one; both give no ids and an empty ``decoded``.
    Repeated rows each give a row; other columns are ignored.  A text is
    handled whole however long it is, one at a time.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_file))
    kept = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("text"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        bpe = tokenizer(spec.value)
        for batch in slices(batches):
            ids = bpe.encode(batch.column("text").to_pylist())
            cols = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if with_text:
                cols.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + cols,
                names=[*names, "ids", "n_tokens", *["decoded"] * with_text])

    schema = ", ".join([f"{n} {kept.schema[n].dataType.simpleString()}" for n in names]
                       + ["ids binary", "n_tokens bigint"] + ["decoded binary"] * with_text)
    return kept.mapInArrow(run, schema).select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], "ids", "n_tokens", *["decoded"] * with_text)


def op2_bpe(spark, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    from placekit.sources.tables import table
    if tokenizer_file is None:
        import public_tokenizers
        tokenizer_file = public_tokenizers.path("word_bpe_49k.json")
    coded = encode_decode(table(spark, sf_dir, "documents"), tokenizer_file)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
