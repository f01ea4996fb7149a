"""Personal data by base patterns and a linear-chain conditional random field.

The base patterns (e-mail, IP, card, phone) are found in linear time and
always stay.  The field adds what they miss: spelled-out e-mail addresses,
phone numbers without a country code, cards and addresses with other separators.

A text is a sequence of tokens: letters, digits, single signs.  A token's *symbol* is
its word shape (case, number of digits, whether they pass the card or octet
check, the sign itself, or one of a few cue words) and whether white space
stands before it.  The field scores label ``y`` at token ``t`` by the symbols at ``t - 2`` to
``t + 2`` and neighbouring labels by a transition matrix.  It is trained in
numpy from a small labelled table (``LABELLED`` by default; any table of texts
and spans will do) and decoded by Viterbi in numpy batches.

A text is one sequence, decoded from its first token to its last; texts of like length
are decoded together.  Of the spans found, those count that can be what they are labelled (``_valid``).
"""

from __future__ import annotations

import hashlib
import re
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.llm.batches import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
REACH = 2
EPOCHS = 300
PENALTY = 0.02
BATCH_TOKENS = 1 << 18
# Characters of a text that are cut into tokens at once, and pieces whose symbols are remembered.
PART, MOST_PIECES = 1 << 20, 1 << 17
# Rows and bytes of text that are decoded together.
ROWS, SIZE = 1024, 4 << 20

# ---------------------------------------------------------------- base patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in text.split(".")))


def _only_digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def emails(t: str) -> list[tuple[int, int]]:
    """The matches of the e-mail pattern: from each ``@``, back over the local
    part (not into the match before) and on over the domain."""
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        s = at
        while s > end and t[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(t, at + 1) if s < at else None
        if m:
            end = m.end()
            out.append((s, end))
        at = t.find("@", max(at + 1, end))
    return out


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out = [("email", s, e) for s, e in emails(t)]
    if _DIGIT.search(t):
        out += [("ip", *m.span()) for m in _IP.finditer(t) if _octets(m[0])]
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 13:
                d = _only_digits(m[0])
                if 13 <= len(d) <= 19 and luhn(d):
                    out.append(("card", *m.span()))
        if "+" in t:
            out += [("phone", *m.span()) for m in _PHONE.finditer(t) if 9 <= len(_only_digits(m[0])) <= 15]
    return out


# ---------------------------------------------------------------- tokens and symbols

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)
_CUES = frozenset("at dot punkt punto point arobase tel phone telefon mobile fax call mail email card visa ip version "
                  "license isbn".split())


def _shape(token: str) -> str:
    if token[0] in "0123456789":
        n = len(token)
        if n <= 3:
            return f"d{n}" if int(token) <= 255 else "d3+"
        if 13 <= n <= 19:
            return "card" if luhn(token) else "long"
        return f"d{n}" if n <= 12 else "d20"
    if token.isalpha():
        low = token.lower()
        if low in _CUES:
            return low
        size = "1" if len(token) == 1 else ""
        return size + ("X" if token.isupper() else "Xx" if token[0].isupper() else "x")
    return token if token.isascii() else "sign"


def tokens(t: str, lo: int, hi: int) -> list[tuple[int, int, str]]:
    """(start, end, symbol) of the tokens of ``t[lo:hi]``."""
    out, space = [], "_"
    for m in _TOKEN.finditer(t, lo, hi):
        if m[0].isspace():
            space = "_"
        else:
            out.append((m.start(), m.end(), space + _shape(m[0])))
            space = ""
    return out


# ---------------------------------------------------------------- the field


@dataclass
class Crf:
    """``symbols``: rows of ``w[offset]``; the last row stands for the others.
    ``trans[a, b]``: from label a to b; ``start``: of a first label."""

    symbols: dict[str, int]
    w: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    def encode(self, seqs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol numbers, padded left and right by ``REACH`` of "nothing", and lengths."""
        n = np.array([len(s) for s in seqs])
        none, other = len(self.symbols) + 1, len(self.symbols)
        x = np.full((len(seqs), int(n.max(initial=0)) + 2 * REACH), none)
        for i, s in enumerate(seqs):
            x[i, REACH:REACH + len(s)] = [self.symbols.get(v, other) for v in s]
        return x, n

    def emissions(self, x: np.ndarray) -> np.ndarray:
        size = x.shape[1] - 2 * REACH
        return sum(self.w[o][x[:, o:o + size]] for o in range(2 * REACH + 1))

    def viterbi(self, seqs: list[list[str]]) -> list[np.ndarray]:
        """The best label sequence of every token sequence, all at once."""
        return self.paths(*self.encode(seqs))

    def paths(self, x: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        """The best label sequences for padded symbol numbers and lengths.  The scores of
        ``BATCH_TOKENS`` tokens are held; those of longer sequences are computed a second time."""
        size, end = x.shape[1] - 2 * REACH, len(LABELS)
        width = max(BATCH_TOKENS // len(n), 1)
        into, by_label = self.trans[:, :, None], np.ascontiguousarray(self.w.transpose(0, 2, 1))
        after = np.concatenate((self.trans, np.zeros((end, 1))), 1)
        sums, most = np.empty((end, end, len(n))), np.empty((end, len(n)))

        def forward(at: int, best: np.ndarray | None) -> np.ndarray:
            """Scores (label, token, sequence) of the best paths to the tokens from ``at`` on."""
            part = np.ascontiguousarray(x[:, at:at + width + 2 * REACH].T)
            k = len(part) - 2 * REACH
            e = by_label[0].take(part[:k], 1)
            for o in range(1, 2 * REACH + 1):
                e += by_label[o].take(part[o:o + k], 1)
            for t in range(k):
                here = e[:, t]
                if best is None:
                    here += self.start[:, None]
                else:
                    np.add(best[:, None, :], into, out=sums)
                    here += np.maximum.reduce(sums, out=most)
                best = here
            return e

        begins = range(0, size, width)
        before = [None]
        for at in begins[:-1]:
            before.append(forward(at, before[-1])[:, -1].copy())
        out, shortest = np.zeros((size, len(n)), np.int8), n.min()
        y = np.full(len(n), end)  # behind the last token
        for at, best in zip(reversed(begins), reversed(before)):
            scores = forward(at, best)
            for t in range(at + scores.shape[1] - 1, at - 1, -1):
                y = (scores[:, t - at] + after.take(y, 1)).argmax(0)
                if t >= shortest:
                    y[t >= n] = end
                out[t] = y
        return [out[:k, i] for i, k in enumerate(n)]


def _allowed() -> np.ndarray:
    """Transitions that a labelling can have: I-k only after B-k or I-k."""
    ok = np.ones((len(LABELS), len(LABELS)), bool)
    for j, b in enumerate(LABELS):
        if b[0] == "I":
            ok[:, j] = [a[2:] == b[2:] and a != "O" for a in LABELS]
    return ok


def fit(examples: list[tuple[list[str], list[int]]], epochs: int = EPOCHS, penalty: float = PENALTY,
        rate: float = 0.15) -> Crf:
    """Maximum likelihood with an L2 penalty by full-batch AdaGrad; expected
    counts by the forward-backward recursion over all sequences at once."""
    symbols = {s: i for i, s in enumerate(sorted({s for seq, _ in examples for s in seq}))}
    k = len(LABELS)
    ok = _allowed()
    crf = Crf(symbols, np.zeros((2 * REACH + 1, len(symbols) + 2, k)), np.where(ok, 0.0, -1e4),
              np.where([b[0] == "I" for b in LABELS], -1e4, 0.0))
    if not examples:
        crf.start[1:] = -1e4
        crf.trans[:, 1:] = -1e4
        return crf
    x, n = crf.encode([s for s, _ in examples])
    size = x.shape[1] - 2 * REACH
    mask = np.arange(size) < n[:, None]
    gold = np.zeros((len(examples), size), np.int64)
    for i, (_, y) in enumerate(examples):
        gold[i, :len(y)] = y
    hot = np.eye(k)[gold] * mask[:, :, None]
    pair_gold = np.einsum("btj,btk->jk", hot[:, :-1], hot[:, 1:])
    squares = [np.full_like(p, 1e-6) for p in (crf.w, crf.trans, crf.start)]
    for _ in range(epochs):
        e = crf.emissions(x)
        a = np.zeros_like(e)
        a[:, 0] = crf.start + e[:, 0]
        for t in range(1, size):
            s = _logsum(a[:, t - 1][:, :, None] + crf.trans, 1) + e[:, t]
            a[:, t] = np.where(mask[:, t, None], s, a[:, t - 1])
        z = _logsum(a[:, -1], 1)
        b = np.zeros_like(e)
        pair = np.zeros((k, k))
        for t in range(size - 2, -1, -1):
            inner = e[:, t + 1] + b[:, t + 1]
            s = _logsum(crf.trans + inner[:, None, :], 2)
            b[:, t] = np.where(mask[:, t + 1, None], s, 0.0)
            p = np.exp(a[:, t][:, :, None] + crf.trans + inner[:, None, :] - z[:, None, None])
            pair += (p * mask[:, t + 1, None, None]).sum(0)
        node = np.exp(a + b - z[:, None, None]) * mask[:, :, None]
        diff = hot - node
        gw = np.zeros_like(crf.w)
        for o in range(2 * REACH + 1):
            np.add.at(gw[o], x[:, o:o + size], diff)
        grads = (gw - penalty * crf.w, np.where(ok, pair_gold - pair - penalty * crf.trans, 0.0),
                 np.where(crf.start > -1e3, diff[:, 0].sum(0) - penalty * crf.start, 0.0))
        for value, g, s in zip((crf.w, crf.trans, crf.start), grads, squares):
            s += g * g
            value += rate * g / np.sqrt(s)
    return crf


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


# The labelled table. [kind:text] marks a span.
LABELLED = """
write to [email:jane dot doe at example dot org] today
Reach me: [email:jane.doe at example dot org], please
mail [email:info (at) example (dot) com] or come by
his address is [email:max [at] beispiel [dot] de] he said
send it to [email:support at mail7 dot example dot com] and wait
contact [email:a.b@example.com] for more
Contact [email:34@mail7.example.com] und der
[email:x1 (at) mail.example.net] was there
email [email:luc arobase exemple point fr] merci
escribe a [email:ana arroba ejemplo punto es] hoy
the of [email:sales2(at)example.com] and then
ask [email:john_smith at corp dot example dot net].
call [phone:(017) 555-7713] now
my phone is [phone:555-123-4567] and
tel [phone:030 1234567] or later
Phone: [phone:212 555 0187].
mobile [phone:0171 5551234] bitte
telefon [phone:089/5551234] ab acht
fax [phone:(212) 555-0199], please
the [phone:+1 (974) 555-3436] thatenon it
call me on [phone:+49 30 5551234] soon
at [phone:+33 1 55 51 23 45] et
ring [phone:00 49 30 5551234] tomorrow
tel: [phone:555.123.4567] thanks
card [card:4111 1111 1111 1111] expires
visa [card:4111111111111111] of his
the [card:4111-1111-1111-1111] and
pay with [card:4111.1111.1111.1111] today
card [card:5500 0000 0000 0004], ok
und [card:4952935900253052] der
number 4111111111111112 is no card
the 9807915762804490 and 2669109448945250 are long
server [ip:129.38.82.176] is down
ip [ip:10.0.0.1] and more
from [ip:192.168.1.20] to
host | [ip:161.17.88.162] | up
[ip:10 . 0 . 0 . 7] was it
version 2.0 of the license
License, Version 2.0.
GNU General Public License, version 3.
CC BY-NC 4.0.
version 1.2.3.4 beta 12
chapter 3 has 12 pages and 400 lines
in 1999 and 2004 they met
it costs 12.50 or 1,200.00 in all
on 2024-05-17 at 10:30 we
am 17.05.2024 um 10 Uhr
le 3 mai 2021 est
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" thhantou
key = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" elleellele
id 300.400.500.600 is no address
isbn 978-3-16-148410-0 is a book
the @ sign and a # sign
@user said so and @other did
look at the dot on the map
a dot and another dot at the end
they met at the house of it
the and of that it was on the
und der die das nicht ein
de la que el en y a los
le la les et des en un
he was there . Then , the end
section 4 (17) and 5 (18) say
0 1 2 3 4 5 6 7 8 9
page 12 of 555 in part 1234
room 0171 and hall 5551234 are free
score 3-2 and 10-12 in 90 min
sum 12345678901234567890123 of all
the 100 % of 7 & 8 * 9 = 504
x = y + 1 and z = 2
"""

_MARKED = re.compile(r"\[(email|ip|card|phone):((?:[^\[\]]|\[at\]|\[dot\])*)\]")


def labelled_rows() -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The built-in labelled table: (text, [(kind, start, end), ...])."""
    out = []
    for line in LABELLED.strip().split("\n"):
        text, spans, at = "", [], 0
        for m in _MARKED.finditer(line):
            text += line[at:m.start()]
            spans.append((m[1], len(text), len(text) + len(m[2])))
            text += m[2]
            at = m.end()
        out.append((text + line[at:], spans))
    return out


def train(rows: list[tuple[str, list[tuple[str, int, int]]]] | None = None) -> Crf:
    """Fit the field on labelled texts (the built-in table)."""
    examples = []
    for text, spans in labelled_rows() if rows is None else rows:
        toks = tokens(text, 0, len(text))
        y = []
        for s, e, _ in toks:
            hit = next(((k, a) for k, a, b in spans if a <= s and e <= b), None)
            y.append(0 if hit is None else LABELS.index(f"{'B' if s == hit[1] else 'I'}-{hit[0]}"))
        if toks:
            examples.append(([v for _, _, v in toks], y))
    return fit(examples)


# ---------------------------------------------------------------- spans of a text

_DOT = re.compile(r"[0-9]|(?<![^\W_])(?i:dot|punkt|punto|point)(?![^\W_])|[^\W_]\.[^\W_]")
_BLANK = re.compile(r"\s")
_PIECE = re.compile(r"\s*+(?:[^\W\d_]+|[0-9]+|.)", re.S)


def windows(t: str) -> list[tuple[int, int]]:
    """The whole text in parts of about ``PART`` characters, cut at white space; white
    space at the end is left out."""
    out, lo, end = [], 0, len(t.rstrip())
    while lo < end:
        cut = _BLANK.search(t, lo + PART, end)
        out.append((lo, cut.start() if cut else end))
        lo = out[-1][1]
    return out


class Symbols(dict):
    """Symbol numbers of pieces, a token and the white space before it; those of a
    bounded number of pieces are remembered."""

    def __init__(self, crf: Crf):
        self.symbols = crf.symbols

    def __missing__(self, piece: str) -> int:
        token = piece.lstrip()
        number = self.symbols.get(("" if len(token) == len(piece) else "_") + _shape(token), len(self.symbols))
        if len(piece) <= 16:  # longer ones seldom come again
            if len(self) >= MOST_PIECES:
                self.clear()
            self[piece] = number
        return number

    def read(self, t: str) -> tuple[np.ndarray, np.ndarray]:
        """Symbol numbers and ends of the tokens of a text."""
        numbers, ends = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for lo, hi in windows(t):
            pieces = _PIECE.findall(t[lo:hi].rstrip())
            ends.append(lo + np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))))
            if lo == 0 and pieces:
                pieces[0] = " " + pieces[0]  # the beginning of a text is like white space
            numbers.append(np.fromiter(map(self.__getitem__, pieces), np.int32, len(pieces)))
        return np.concatenate(numbers), np.concatenate(ends)


def _valid(kind: str, text: str) -> bool:
    digits = _only_digits(text)
    if kind == "email":
        return "@" in text or bool(re.search(r"(?i)\bat\b|arobase|arroba", text)) and (
            bool(_DOT.search(text)))
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and _octets(".".join(parts))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def added_spans(crf: Crf, texts: list[str], base: list[list[tuple[str, int, int]]],
                known: Symbols | None = None) -> list[list[tuple[str, int, int]]]:
    """The field's spans of each text that overlap no base span."""
    known = Symbols(crf) if known is None else known
    read = [known.read(t) for t in texts]
    size = np.array([len(x) for x, _ in read], np.int64)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    order = np.argsort(size, kind="stable")
    at = int((size == 0).sum())
    while at < len(order):  # texts of like length together, a bounded number of tokens
        to = at + 1
        while to < len(order) and (to + 1 - at) * size[order[to]] <= BATCH_TOKENS:
            to += 1
        part = order[at:to]
        x = np.full((len(part), int(size[part].max()) + 2 * REACH), len(crf.symbols) + 1)
        for row, i in zip(x, part):
            row[REACH:REACH + size[i]] = read[i][0]
        for i, y in zip(part, crf.paths(x, size[part])):
            ends = read[i][1]
            edge = np.flatnonzero(np.diff(y != 0, prepend=False, append=False))
            for lo, hi in zip(edge[::2], edge[1::2]):
                stops = ends[lo:hi].tolist()
                starts = [int(ends[lo - 1]) if lo else 0, *stops[:-1]]
                toks = [(b - len(texts[i][a:b].lstrip()), b, None) for a, b in zip(starts, stops)]
                out[i] += _spans(texts[i], toks, y[lo:hi], base[i])
        at = to
    return out


def _spans(t, toks, y, base):
    found, k = [], 0
    while k < len(y):
        if not y[k]:
            k += 1
            continue
        kind, first = LABELS[y[k]][2:], k
        k += 1
        while k < len(y) and LABELS[y[k]] == f"I-{kind}":
            k += 1
        s, e = toks[first][0], toks[k - 1][1]
        if _valid(kind, t[s:e]) and not any(a < e and s < b for _, a, b in base):
            found.append((kind, s, e))
    return found


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def find_pii(docs: DataFrame, crf: Crf | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns, ``n_email``, ``n_ip``,
    ``n_card``, ``n_phone`` (base spans), ``base`` and ``spans`` (base spans,
    and all): ``kind:start:end`` in code points, end exclusive, by kind, then
    start, joined by commas.

    Null and empty texts have none.  A text is searched whole.  Repeated rows
    each give a row; other columns are ignored.
    """
    crf = crf or train()
    kept = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("text"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        known = Symbols(crf)
        for batch in slices(batches, rows=ROWS, size=SIZE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            more = added_spans(crf, texts, base, known)
            cols = [pa.array([sum(x[0] == k for x in b) for b in base], pa.int64()) for k in KINDS]
            cols += [pa.array(map(_joined, base), pa.string()),
                     pa.array([_joined(b + m) for b, m in zip(base, more)], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + cols,
                                             names=[*names, *(f"n_{k}" for k in KINDS), "base", "spans"])

    schema = ", ".join([f"{n} {kept.schema[n].dataType.simpleString()}" for n in names]
                       + [f"n_{k} bigint" for k in KINDS] + ["base string", "spans string"])
    return kept.mapInArrow(run, schema).select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], *[f"n_{k}" for k in KINDS], "base", "spans")


def op5_pii(spark, sf_dir: str) -> DataFrame:
    from placekit.sources.tables import table
    return find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
