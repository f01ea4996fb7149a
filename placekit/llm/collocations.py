"""Phrase collocations, counted in counting quotient filters.

A text's pieces are cut at ``.,;:!?`` and line ends, their words are runs without
blank and tab; A-Z are lower-cased.  Everything is per language (null: ``und``).

1. Tasks cut the texts into chunks of about ``CHUNK`` bytes per language, and write
   each chunk as its list of different words, their counts, and the sequence
   of local word numbers with a mark between pieces.
2. A chunk's words go to sections of their hash, where counts are summed.  Words of at least
   ``least`` occurrences get a number (others cannot be in a phrase that occurs so often), which
   goes back to the chunks that hold the word.  No dictionary is broadcast.
3. Phrases of n words are counted after those of n - 1: a phrase is packed as the
   numbers of its first and of its last n - 1 words, both frequent, so its code is
   lossless and holds 2 b bits whatever n is.  The code is permuted by an
   invertible Feistel network and split in quotient and full remainder.  A chunk
   makes one counting quotient filter of its phrases: the lengths of the runs of equal
   quotients, the remainders in order, and small counters.
4. Filters are cut by the top bits of the quotient into sections.  A section's filters
   of all chunks come together and are merged in order; no count is lost or
   approximate.  The merged codes of at least ``least`` occurrences are turned back into the two
   numbers, get a number of their own, and go back to the chunks that hold them.
5. The counted phrases are few.  Cuts, scores and the test for longer phrases are joins
   of that table with itself, in exact decimals.

A section's size does not depend on how frequent a phrase is: a phrase takes one entry in the
filter of each chunk.  The number of sections grows with what is counted, so a section fits in a task.

Defined results: null and empty texts have no words; null languages are ``und``;
every row counts, repeated ones too; very long texts are one chunk each; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placekit.llm.vectors import runs
from placekit.llm.words import mix
from placekit.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 100  # occurrences of a candidate
WORDS = 5  # of the longest candidate
TOP = 2000  # rows of the report for each language
CHUNK = 4 << 20
SECTION = 1 << 19  # filter entries that a section is meant to have
SALTS = 64
_MARK = b"\n"


def _table() -> bytes:
    """A-Z to lower case, tabs to blanks, what ends a piece to line feeds."""
    out = bytearray(range(256))
    for b in range(ord("A"), ord("Z") + 1):
        out[b] = b + 32
    out[0x09] = 0x20
    for b in b".,;:!?\x0b\x0c\r":
        out[b] = _MARK[0]
    return bytes(out)


_BYTES = _table()


def packed(x) -> bytes:
    """Bytes or an array as they are kept in tables."""
    return zstandard.compress(x if isinstance(x, bytes) else x.tobytes(), 1)


def unpacked(x, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


def pieces(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, and a line feed for each end of a piece."""
    return [w for w in text.translate(_BYTES).replace(_MARK, b" \n ").split(b" ") if w]


# ------------------------------------------------------------------ the filter


def permuted(code: np.ndarray, half: int, back: bool = False) -> np.ndarray:
    """An invertible permutation of the numbers of ``2 * half`` bits: four
    rounds of a Feistel network."""
    mask = np.uint64((1 << half) - 1)
    left, right = code >> np.uint64(half), code & mask
    with np.errstate(over="ignore"):
        for key in (4, 3, 2, 1) if back else (1, 2, 3, 4):
            noise = lambda x: mix(x + np.uint64(key) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) & mask  # noqa: B023, E731
            left, right = (right ^ noise(left), left) if back else (right, left ^ noise(right))
    return left << np.uint64(half) | right


def make_filter(prints: np.ndarray, counts: np.ndarray, bits: int) -> tuple[bytes, bytes, bytes]:
    """The filter of sorted different fingerprints of ``bits`` bits: run lengths
    of all quotients, remainders, counters.  There are about as many quotients as
    fingerprints; counters of one byte are followed by those that need eight."""
    q = min(bits, max(0, int(len(prints)).bit_length() - 1))
    rest = bits - q
    lengths = np.bincount((prints >> np.uint64(rest)).astype(np.int64) if rest < 64 else np.zeros(len(prints), np.int64),
                          minlength=1 << q)
    width = 1 if lengths.max(initial=0) < 256 else 4
    remainder = prints & np.uint64((1 << rest) - 1)
    low = remainder.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :-(-rest // 8)]
    small = np.minimum(counts, 255).astype(np.uint8)
    return (packed(bytes([q, width]) + lengths.astype(f"<u{width}").tobytes()), low.tobytes(),
            packed(small.tobytes() + counts[counts >= 255].astype("<u8").tobytes()))


def read_filter(lengths: bytes, remainders: bytes, counters: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of a filter in order, and their counts."""
    lengths, counters = zstandard.decompress(lengths), zstandard.decompress(counters)
    q, width = lengths[0], lengths[1]
    lengths = np.frombuffer(lengths, f"<u{width}", offset=2)
    n, rest = int(lengths.sum()), bits - q
    low = np.zeros((n, 8), np.uint8)
    octets = -(-rest // 8)
    low[:, :octets] = np.frombuffer(remainders, np.uint8).reshape(n, octets)
    quotient = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
    prints = low.view("<u8").reshape(n).astype(np.uint64)
    if rest < 64:
        prints |= quotient << np.uint64(rest)
    counts = np.frombuffer(counters, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(counters, "<u8", offset=n).astype(np.int64)
    return prints, counts


def merged(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of several filters and the sums of their counts."""
    prints = np.concatenate([p for p, _ in filters])
    counts = np.concatenate([c for _, c in filters])
    order = np.argsort(prints, kind="stable")  # merges the sorted runs
    prints, counts = prints[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1]))) if len(prints) else np.empty(0, np.int64)
    return prints[starts], np.add.reduceat(counts, starts) if len(prints) else counts


# ------------------------------------------------------------------ chunks and words


_CHUNK = "chunk long, lang string, n long, different long, words binary, counts binary, seq binary"


def _chunks(batches):
    """Batches of (lang, text) as chunks.  A chunk's number is unique among the
    tasks that wrote the table; -1 in its sequence is an end of a piece."""
    number = TaskContext.get().partitionId() << 32
    held: dict[str, list] = {}  # lang: numbers of its words, sequences so far, bytes so far

    def row(lang):
        nonlocal number
        names, seqs, _ = held.pop(lang)
        seq = np.concatenate(seqs)
        counts = np.bincount(seq, minlength=len(names))[1:]  # 0 is the mark; it becomes -1
        number += 1
        return pa.RecordBatch.from_pylist([{
            "chunk": number, "lang": lang, "n": int(counts.sum()), "different": len(counts),
            "words": packed(_MARK.join(list(names)[1:])), "counts": packed(counts), "seq": packed(seq - np.int32(1))}],
            schema=pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("different", pa.int64()),
                              ("words", pa.binary()), ("counts", pa.binary()), ("seq", pa.binary())]))

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary())):
            at = held.setdefault(lang, [{_MARK: 0}, [], 0])
            t, names = text.as_py(), at[0]
            words = pieces(t)
            words.append(_MARK)
            at[1].append(np.fromiter((names.setdefault(w, len(names)) for w in words), np.int32, len(words)))
            at[2] += len(t)
            if at[2] >= CHUNK:
                yield row(lang)
            elif sum(x[2] for x in held.values()) >= 4 * CHUNK:  # many languages: the largest goes
                yield row(max(held, key=lambda x: held[x][2]))
    for lang in list(held):
        yield row(lang)


_STATE = "chunk long, lang string, at binary, ids binary"
_COUNTED = "lang string, section long, chunk long, bits int, lengths binary, remainders binary, counters binary"
_MERGED = "chunk long, lang string, codes binary, ids binary, first long, last long, id long, f long"
_DEALT = "lang string, section long, chunk long, words binary, locals binary, counts binary"
_WORDS = "chunk long, lang string, codes binary, ids binary, word string, id long, f long"


def _rows(batch, *columns):
    """The rows of a batch; binary values are views of it, not copies."""
    cols = [batch.column(c) for c in columns]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_buffer() if pa.types.is_binary(c.type) else c[i].as_py() for c in cols)


def _deal_words(sections: int):
    """The words of each chunk, by sections of their hash."""
    def run(batches):
        for b in batches:
            for chunk, lang, words, counts in _rows(b, "chunk", "lang", "words", "counts"):
                words, counts = zstandard.decompress(words).split(_MARK), unpacked(counts, np.int64)
                if not len(counts):
                    continue
                at = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % sections
                order = np.argsort(at, kind="stable")
                edge = np.searchsorted(at[order], np.arange(sections + 1))
                rows = [(lang, s, chunk, packed(_MARK.join([words[i] for i in order[lo:hi].tolist()])),
                         packed(order[lo:hi].astype(np.int32)), packed(counts[order[lo:hi]]))
                        for s, (lo, hi) in enumerate(zip(edge[:-1], edge[1:])) if hi > lo]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.binary(),
                                                                 pa.binary(), pa.binary()))],
                    ["lang", "section", "chunk", "words", "locals", "counts"])

    return run


def _merge_words(sections: int, least: int):
    """Of each section its frequent words (rows without chunk), and what each
    chunk has of them: local numbers and ids."""
    schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("codes", pa.binary()), ("ids", pa.binary()),
                        ("word", pa.string()), ("id", pa.int64()), ("f", pa.int64())])

    def finish(lang, section, held):
        total: dict[bytes, int] = {}
        for _, words, _, counts in held:
            for w, c in zip(zstandard.decompress(words).split(_MARK), unpacked(counts, np.int64).tolist()):
                total[w] = total.get(w, 0) + c
        often = sorted(w for w, c in total.items() if c >= least)
        if not often:
            return
        ids = {w: n * sections + section for n, w in enumerate(often)}
        yield pa.RecordBatch.from_pylist([{"lang": lang, "word": w.decode(), "id": i, "f": total[w]} for w, i in ids.items()],
                                         schema=schema)
        for chunk, words, local, _ in held:
            number = np.array([ids.get(w, -1) for w in zstandard.decompress(words).split(_MARK)], np.int64)
            ok = number >= 0
            if ok.any():
                yield pa.RecordBatch.from_pylist([{
                    "chunk": chunk, "lang": lang, "codes": packed(unpacked(local, np.int32)[ok]),
                    "ids": packed(number[ok].astype(np.uint32))}], schema=schema)

    def run(batches):
        key, held = None, []
        for (lang, section), piece in runs(batches, ["lang", "section"]):
            if (lang, section) != key:
                if key:
                    yield from finish(*key, held)
                key, held = (lang, int(section)), []
            held += zip(*(piece.column(c).to_pylist() for c in ("chunk", "words", "locals", "counts")))
        if key:
            yield from finish(*key, held)

    return run


def _word_state(batches):
    """A chunk's numbers of frequent words (kind 0), then its sequence (kind 1):
    where these words stand."""
    now, known = None, []
    for (chunk, kind), piece in runs(batches, ["chunk", "kind"]):
        if chunk != now:
            now, known = chunk, []
        if kind == 0:
            known += [(unpacked(x, np.int32), unpacked(y, np.uint32)) for x, y in _rows(piece, "codes", "ids")]
        elif known:
            for lang, seq in _rows(piece, "lang", "codes"):
                seq = unpacked(seq, np.int32)
                ids = np.full(int(seq.max(initial=-1)) + 2, -1, np.int64)  # the last one is for the mark, -1
                for local, number in known:
                    ids[local] = number
                yield _state_row(int(chunk), lang, np.arange(len(seq)), ids[seq])


def _state_row(chunk, lang, at, ids):
    ok = ids >= 0
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), pa.array([lang], pa.string()),
         pa.array([packed(np.diff(at[ok], prepend=0).astype(np.int32))], pa.binary()),  # steps: they are small
         pa.array([packed(ids[ok].astype(np.uint32))], pa.binary())],
        ["chunk", "lang", "at", "ids"])


def _pairs(at, ids, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Where two frequent phrases start at neighbouring words, and the packed codes of the two."""
    at, ids = np.cumsum(unpacked(at, np.int32)), unpacked(ids, np.uint32)
    both = np.flatnonzero(at[1:] == at[:-1] + 1)
    return at[both], ids[both].astype(np.uint64) << np.uint64(half) | ids[both + 1].astype(np.uint64)


def _count_chunks(half: int, sections_log2: int):
    """Of each chunk's state its filter, cut in sections."""
    bits = 2 * half

    def run(batches):
        for b in batches:
            for chunk, lang, at, ids in _rows(b, "chunk", "lang", "at", "ids"):
                _, codes = _pairs(at, ids, half)
                prints, counts = np.unique(permuted(codes, half), return_counts=True)
                cut = min(sections_log2, bits)
                edge = np.searchsorted(prints >> np.uint64(bits - cut) if cut else np.zeros(len(prints), np.uint64),
                                       np.arange((1 << cut) + 1, dtype=np.uint64))
                rows = [(lang, s, chunk, bits, *make_filter(prints[lo:hi], counts[lo:hi], bits))
                        for s, (lo, hi) in enumerate(zip(edge[:-1], edge[1:])) if hi > lo]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (
                            pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                        ["lang", "section", "chunk", "bits", "lengths", "remainders", "counters"])

    return run


def _merge_sections(half: int, sections: int, least: int):
    """Of each section its frequent phrases (rows without chunk), and what each
    chunk has of them (rows with the codes and their numbers).  A phrase's
    number is its rank in the section, spread over the sections."""
    schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("codes", pa.binary()), ("ids", pa.binary()),
                        ("first", pa.int64()), ("last", pa.int64()), ("id", pa.int64()), ("f", pa.int64())])

    def finish(lang, section, chunks, filters):
        prints, counts = merged(filters)
        often = counts >= least
        prints, counts = prints[often], counts[often]
        if not len(prints):
            return
        codes = permuted(prints, half, back=True)
        ids = np.arange(len(prints)) * sections + section
        n = len(prints)
        nothing = lambda k, t: pa.nulls(k, t)
        yield pa.RecordBatch.from_arrays(
            [nothing(n, pa.int64()), pa.array([lang] * n), nothing(n, pa.binary()), nothing(n, pa.binary()),
             pa.array((codes >> np.uint64(half)).astype(np.int64)), pa.array((codes & np.uint64((1 << half) - 1)).astype(np.int64)),
             pa.array(ids), pa.array(counts)], schema=schema)
        for chunk, (own, _) in zip(chunks, filters):
            there = np.searchsorted(prints, own)
            there[there == n] = 0
            there = there[prints[there] == own]
            if len(there):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([lang]), pa.array([packed(codes[there])], pa.binary()),
                     pa.array([packed(ids[there].astype(np.uint32))], pa.binary()), *(nothing(1, pa.int64()) for _ in range(4))], schema=schema)

    def run(batches):
        key, chunks, filters = None, [], []
        for (lang, section), piece in runs(batches, ["lang", "section"]):
            if (lang, section) != key:
                if key:
                    yield from finish(*key, chunks, filters)
                key, chunks, filters = (lang, int(section)), [], []
            for chunk, bits, *parts in zip(*(piece.column(c).to_pylist() for c in (
                    "chunk", "bits", "lengths", "remainders", "counters"))):
                chunks.append(chunk)
                filters.append(read_filter(*parts, bits))
        if key:
            yield from finish(*key, chunks, filters)

    return run


def _next_state(half: int):
    """A chunk's rows of frequent codes, then its state (kind 1): the state of
    the phrases that are one word longer."""
    def run(batches):
        now, codes, ids = None, [], []
        for (chunk, kind), piece in runs(batches, ["chunk", "kind"]):
            if chunk != now:
                now, codes, ids = chunk, [], []
            if kind == 0:
                for x, y in _rows(piece, "codes", "ids"):
                    codes.append(unpacked(x, np.uint64))
                    ids.append(unpacked(y, np.uint32))
            elif codes:
                for lang, at, own in _rows(piece, "lang", "codes", "ids"):
                    known, number = np.concatenate(codes), np.concatenate(ids)
                    order = np.argsort(known)
                    known, number = known[order], number[order]
                    at, code = _pairs(at, own, half)
                    there = np.searchsorted(known, code)
                    there[there == len(known)] = 0
                    yield _state_row(int(chunk), lang, at, np.where(known[there] == code, number[there].astype(np.int64), -1))

    return run


# ------------------------------------------------------------------ phrases


def counted_phrases(docs: DataFrame, least: int = LEAST, longest: int = WORDS, section: int = SECTION):
    """(phrases, totals): lang, n_words, words and f of the phrases of up to ``longest``
    words that occur at least ``least`` times, and lang and n, its number of words."""
    texts = docs.filter(F.col("text").isNotNull() & (F.col("text") != "")).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    chunks = materialize(texts.mapInArrow(_chunks, _CHUNK))
    totals = chunks.groupBy("lang").agg(F.sum("n").alias("n")).filter("n > 0")
    different = chunks.agg(F.sum("different")).first()[0] or 0
    sections = different // section + 1
    found = materialize(chunks.select("chunk", "lang", "words", "counts").mapInArrow(_deal_words(sections), _DEALT)
                              .repartition("lang", "section").sortWithinPartitions("lang", "section", "chunk")
                              .mapInArrow(_merge_words(sections, least), _WORDS))
    both = (found.filter("chunk is not null").select("chunk", "lang", "codes", "ids").withColumn("kind", F.lit(0))
                 .unionByName(chunks.select("chunk", "lang", F.col("seq").alias("codes"), F.lit(b"").alias("ids"), F.lit(1).alias("kind"))))
    state = materialize(both.repartition("chunk").sortWithinPartitions("chunk", "kind").mapInArrow(_word_state, _STATE))

    often = found.filter("chunk is null")
    level = often.select("lang", "id", F.array("word").alias("words"), "f")
    phrases = level.select("lang", "words", "f")
    for _ in range(2, longest + 1):
        size, top = level.agg(F.sum("f"), F.max("id")).first()  # its occurrences, and its largest number
        if not size:
            break
        half = max(1, int(top).bit_length())
        if half > 32:  # states hold numbers of 32 bits, codes two of them
            raise ValueError(f"{top} is too large a phrase number: two do not fit 64 bits")
        cut = min(max(0, (size // section).bit_length()), 2 * half)
        found = materialize(state.mapInArrow(_count_chunks(half, cut), _COUNTED).repartition("lang", "section")
                                 .sortWithinPartitions("lang", "section", "chunk")
                                 .mapInArrow(_merge_sections(half, 1 << cut, least), _MERGED))
        both = (found.filter("chunk is not null").select("chunk", "lang", "codes", "ids").withColumn("kind", F.lit(0))
                     .unionByName(state.select("chunk", "lang", F.col("at").alias("codes"), "ids").withColumn("kind", F.lit(1))))
        state = materialize(both.repartition("chunk").sortWithinPartitions("chunk", "kind").mapInArrow(_next_state(half), _STATE))
        first, last = (level.select("lang", F.col("id").alias(c), F.col("words").alias(f"{c}_words")) for c in ("first", "last"))
        level = materialize(found.filter("chunk is null").select("lang", "first", "last", "id", "f")
                                 .join(first, ["lang", "first"]).join(last, ["lang", "last"])
                                 .select("lang", "id", F.concat("first_words", F.slice("last_words", -1, 1)).alias("words"), "f"))
        phrases = phrases.unionByName(level.select("lang", "words", "f"))
    return materialize(phrases), totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = WORDS, top: int = TOP, section: int = SECTION) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of
    ``docs`` (lang, text) by the score of their weakest cut."""
    words, totals = counted_phrases(docs, least, longest, section)
    known = words.select("lang", F.array_join("words", " ").alias("phrase"), "f")
    longer = words.filter(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"))
    phrase = F.array_join("words", " ")
    # f falls or stays from a phrase to a longer one that holds it, so a phrase with as frequent a
    # longer one has one of one more word
    inside = longer.select("lang", F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.size("words") - 1), " "),
        F.array_join(F.slice("words", F.lit(2), F.size("words") - 1), " "))).alias("phrase"), "a").distinct()
    own = longer.select("lang", "words", phrase.alias("phrase"), "a").join(inside, ["lang", "phrase", "a"], "left_anti")
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("right"))
    for side, f in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(f)), ["lang", side])
    cuts = cuts.join(totals, "lang").withColumn("score", F.expr(
        "(cast(1000 as decimal(4, 0)) * cast(a as decimal(16, 0)) * cast(n as decimal(16, 0)))"
        " div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"))
    weakest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    rows = weakest.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    # a language's best are among the best of each of its parts: no task ranks all phrases of a language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for part in (["lang", "salt"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).filter(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    """Each language's first 2000 collocations of two to five words."""
    from placekit.sources.tables import table
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH piece AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, row_number() OVER () AS p,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k))),
f AS (SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a
  FROM (SELECT lang, w, a, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM (SELECT lang, w, a, unnest(range(2, k)) AS m FROM c))),
own AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND i.a >= c.a)),
cut AS (
  SELECT lang, phrase, a, j, array_to_string(w[:j], ' ') AS lp, array_to_string(w[j + 1:], ' ') AS rp
  FROM (SELECT lang, phrase, a, w, unnest(range(1, k)) AS j FROM own)),
scored AS (
  SELECT cut.lang, cut.phrase, a, j, x.f AS l, y.f AS r, n,
         ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp
  JOIN n ON n.lang = cut.lang
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM scored
QUALIFY rank <= 2000
"""
