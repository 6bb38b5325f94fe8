"""Text that was read in the wrong character encoding: finding and restoring it.

A wrong code page replaces every character outside of ASCII by others, always the same ones: a substitution cipher whose key nobody
wrote down. Its symbols are units of one or more characters, each standing for one letter. The keys of each source come from the
data by expectation-maximization, against bigrams of the languages of the whole corpus:

- A key of a source is a table of P(letter | unit). Some keys start from known pairs of code pages (read as R, written in T), which
  also say how characters form units; others start blank, from nothing but how often units and letters occur.
- E-step: a line is right as it stands or was garbled under one of its source's keys: its words are read by the tables, and the
  bigrams tell how much likelier they are so. A key must read every word outside of ASCII of the line (some it may leave unchanged), since
  one wrong reading garbles the whole line; text that merely quotes garbled characters has right ones next to them. For each unit of
  such a line, its neighbours, the bigrams and the table give the letters that it may stand for.
- M-step: these letters, summed, are the new tables; each source counts how often each of its keys occurs, which settles ties between
  pages; and the bigrams are counted again over all words as they are read now. This goes on until hardly a line changes its key.
- What no such key explains, and what is unlikely in its source by the bigrams of all others, is given to blank keys: hidden letters
  of one script, observed units of one or two characters, expected counts by forward and backward sums over the stretches of units.
  A blank key counts only if it pays for its own description and reads as well as right text does.

The tables then restore the lines: units become one symbol each, and str.translate() applies the key.

Spark counts lines, words and stretches before anything is scored, so the work follows the distinct ones, and lines go by
a pair of hashes. Bigrams are counted over a fixed set of symbols, which bounds what the driver gets and broadcasts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.session import cut

# Code pages that texts are wrongly read as, and that they may have been written in: where keys may start from.
READ_AS = "cp1252 cp1251 cp1250 koi8-r cp437 mac-roman cp850 cp866 cp1253 cp1254 iso8859-2 iso8859-5 mac-cyrillic cp852".split()
WRITTEN_IN = "utf-8 cp1252 cp1251 koi8-r cp866 cp1250 iso8859-2 cp1253 cp1254 gbk shift_jis euc_jp euc_kr big5 mac-roman cp437 cp850 iso8859-5 mac-cyrillic".split()
#: Log odds against a swap that leaves UTF-8 valid, and against any other key.
AGAINST_UTF8, AGAINST_OTHER = 3.0, 10.0
#: A key that makes a word this much less likely doesn't read its line, however well it reads the others.
LEAST_WORD = -8.0
#: What the first bigrams may be wrong by, in nats a word, when candidates are chosen.
SLACK = 3.0
#: The tables have settled when at most this share of the garbled lines changes its key; and rounds that are enough for that.
SETTLED, ROUNDS = 0.005, 8
#: So many of a word's own occurrences don't speak for the word as it stands, or rare garbled words would explain themselves.
OWN = 3
#: Weight of a page's letter for a unit, in occurrences, and the trust in it before any count.
PAGE_WEIGHT, PAGE_TRUST = 5.0, 0.98
#: Blank keys: a line is suspect if the bigrams of each word are this much (nats each) less likely than usual; a key reads well within `WELL` of usual.
SUSPECT, WELL = 2.5, 1.0
#: Blank keys have settled when a round gains less than this share of the likelihood; and rounds that are enough for that.
GAIN, BLANK_ROUNDS = 0.002, 30
#: Stretches of a source that one task of a blank key takes, about.
TASK_RUNS = 20_000
LOST = "�"
_NOT_ASCII = re.compile(r"[^\x00-\x7F]")


def _symbols() -> tuple[np.ndarray, int]:
    """Symbol of each code point below 0x10000: letters of alphabets by themselves, other characters by kind."""
    t = np.zeros(0x10000, np.int32)
    for k in range(128):
        t[k] = 1 if chr(k).isdigit() else 2 + ord(chr(k).lower()) - 97 if chr(k).isalpha() else 28
    n = 29
    for a, b in ((0x80, 0x700), (0x900, 0xE80), (0x10A0, 0x1100), (0x1E00, 0x2070), (0x20A0, 0x20C0), (0x2100, 0x2300), (0x2500, 0x25A0)):
        t[a:b] = n + np.arange(b - a)
        n += b - a
    for a, b in ((0x3000, 0x3040), (0x3040, 0x3100), (0x3100, 0x4E00), (0x4E00, 0xA000), (0xAC00, 0xD7A4), (0xE000, 0xF900), (0xFF00, 0xFFF0)):
        t[a:b] = n
        n += 1
    t[(t == 0) & (np.arange(0x10000) > 127)] = n
    return t, n + 1


SYMBOL, N_SYMBOLS = _symbols()
#: Code point of each symbol that stands for one character outside of ASCII, else 0.
LETTER = np.zeros(N_SYMBOLS, np.int32)
LETTER[SYMBOL[0x80:0x2600]] = np.arange(0x80, 0x2600)
LETTER[N_SYMBOLS - 1] = 0
#: Nats that a blank key pays for each unit, which of all symbols it stands for, and for being there at all.
UNIT_COST, KEY_COST = float(np.log(N_SYMBOLS)), 100.0
#: Characters from here on are also counted one by one, given their kind.
IDEOGRAPHS = 0x2E80


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, each between two zeros; their code points (0 there); where each text begins."""
    raw = np.frombuffer("".join(f"\x00{t}\x00" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = np.where(raw == 0, 0, np.where(raw < 0x10000, SYMBOL[np.minimum(raw, 0xFFFF)], N_SYMBOLS - 1))
    starts = np.cumsum([0, *[len(t) + 2 for t in texts]])[:-1]
    return sym, raw, starts


def _symbol(ch: str) -> int:
    return int(SYMBOL[ord(ch)]) if ord(ch) < 0x10000 else N_SYMBOLS - 1


def _counted(texts: list[str], n: np.ndarray) -> pa.RecordBatch:
    """(kind, code, n): bigrams (kind 0) and ideographs (kind 1) of texts that occur n times."""
    sym, raw, _ = _codes([t.replace("\x00", " ") for t in texts])
    weight = np.repeat(n, [len(t) + 2 for t in texts])
    pair = sym[:-1].astype(np.int64) * N_SYMBOLS + sym[1:]
    inner = ~((raw[:-1] == 0) & (raw[1:] == 0))
    out = []
    for kind, codes, w in ((0, pair[inner], weight[:-1][inner]), (1, raw[raw >= IDEOGRAPHS].astype(np.int64), weight[raw >= IDEOGRAPHS])):
        u, at = np.unique(codes, return_inverse=True)
        out.append((np.full(len(u), kind), u, np.bincount(at, w, len(u)).astype(np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)], ["kind", "code", "n"])


def _count(plain: bool):
    """mapInArrow function: (text, n) to the counts of bigrams; plain leaves out texts that could be swapped UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n = b.column(0).to_pylist(), b.column(1).to_numpy()
            if plain:
                keep = np.array([not _maybe_utf8(t) for t in texts], bool)
                texts, n = [t for t, k in zip(texts, keep) if k], n[keep]
            if texts:
                yield _counted(texts, n)

    return run


class Bigrams:
    """Log probabilities of symbols after symbols; at most N_SYMBOLS squared counts, those not zero, and one for each ideograph of the first plane."""

    def __init__(self, counts: pd.DataFrame):
        kind, code, n = counts["kind"].to_numpy(), counts["code"].to_numpy(np.int64), counts["n"].to_numpy(float)
        at = np.nonzero(kind == 0)[0]
        at = at[np.argsort(code[at])]
        self.code, self.n = np.append(code[at], np.iinfo(np.int64).max), np.append(n[at], 0.0)
        self.row = np.bincount(code[at] // N_SYMBOLS, n[at], N_SYMBOLS)
        self.col = np.bincount(code[at] % N_SYMBOLS, n[at], N_SYMBOLS)
        self.alone = 5 * (self.col + 0.02) / (self.row.sum() + 0.02 * N_SYMBOLS)
        s = np.full(0x10000, 0.05)
        low = (kind == 1) & (code < 0x10000)
        s[code[low]] += n[low]
        self.single = np.log(s / (n[kind == 1].sum() + 1000)).astype(np.float32)

    def count(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        want = a.astype(np.int64) * N_SYMBOLS + b
        at = np.searchsorted(self.code, want)
        return np.where(self.code[at] == want, self.n[at], 0.0)

    def log(self, a: np.ndarray, b: np.ndarray, less: np.ndarray | float = 0.0) -> np.ndarray:
        """Log probability of b after a; less: counts that are left out."""
        return np.log((np.maximum(self.count(a, b) - less, 0) + self.alone[b]) / (np.maximum(self.row[a] - less, 0) + 5))

    def score(self, texts: list[str], own: list[int] | None = None) -> np.ndarray:
        """Log probability of each text; own: occurrences that are left out of its counts."""
        if not texts:
            return np.empty(0)
        sym, raw, starts = _codes(texts)
        less = np.repeat(own, [len(t) + 2 for t in texts])[:-1] if own is not None else 0.0
        v = np.append(self.log(sym[:-1], sym[1:], less), 0.0) + np.where(raw >= IDEOGRAPHS, self.single[np.minimum(raw, 0xFFFF)], 0)
        v[np.append(starts[1:], len(sym)) - 1] = 0  # from one text to the next
        return np.add.reduceat(v, starts)

    @cached_property
    def usual(self) -> float:
        """The mean log probability of bigrams that have a symbol outside of ASCII."""
        a, b = self.code[:-1] // N_SYMBOLS, self.code[:-1] % N_SYMBOLS
        on = (a > 28) | (b > 28)
        return float((self.n[:-1][on] * self.log(a[on], b[on])).sum() / max(self.n[:-1][on].sum(), 1)) if on.any() else 0.0

    def between(self, left: int, right: int) -> np.ndarray:
        """Log probability of each symbol between two others."""
        x = np.arange(N_SYMBOLS)
        return self.log(np.full(N_SYMBOLS, left), x) + self.log(x, np.full(N_SYMBOLS, right))

    @cached_property
    def alphabets(self) -> dict[str, np.ndarray]:
        """Symbols of each script that the corpus shows, and with them those outside of ASCII that are no letters."""
        by: dict[str, list[int]] = {}
        for s in np.nonzero((LETTER > 0) & (self.col > 0))[0]:
            ch = chr(LETTER[s])
            if ch != LOST:
                by.setdefault(unicodedata.name(ch, "?").split()[0] if unicodedata.category(ch)[0] in "LM" else "", []).append(int(s))
        signs = by.pop("", [])
        return {k: np.array(v + signs) for k, v in by.items() if len(v) > 4}


def _to_bytes(text: str, page: str) -> list[int | None] | None:
    """The bytes that were read as text, None where one was lost; bytes that a Windows page doesn't define are the control characters of their number."""
    try:
        return list(text.encode(page))
    except UnicodeEncodeError:
        pass
    out: list[int | None] = []
    for ch in text:
        try:
            out += ch.encode(page)
        except UnicodeEncodeError:
            if ch == LOST:
                out.append(None)
            elif page.startswith("cp125") and 0x80 <= ord(ch) < 0xA0:
                out.append(ord(ch))
            else:
                return None
    return out


def _decoded(data: bytes, page: str) -> str | None:
    try:
        return data.decode(page)
    except UnicodeDecodeError:
        return None


def _maybe_utf8(word: str) -> bool:
    for r in READ_AS:
        data = _to_bytes(word, r)
        if data is not None and None not in data and _decoded(bytes(data), "utf-8") is not None:
            return True
    return False


def _pieces(data: list[int | None], page: str) -> list[tuple[int, str | None]] | None:
    """(number of bytes, letter) in order; a letter is None if one of its bytes was lost; None if the page can't have written the bytes."""
    out, i = [], 0
    while i < len(data):
        b = data[i]
        if b is not None and b < 0x80:
            out.append((1, chr(b)))
            i += 1
            continue
        size, letter = 0, None
        if page == "utf-8":  # the first byte, or how many others follow, tells the length
            size = 1 if b is None else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0
            if b is None:
                while size < 4 and i + size < len(data) and data[i + size] is not None and 0x80 <= data[i + size] < 0xC0:
                    size += 1
            part = data[i : i + size]
            if not size or len(part) < size or any(x is not None and not 0x80 <= x < 0xC0 for x in part[1:]):
                return None
            if None not in part and (letter := _decoded(bytes(part), page)) is None:
                return None
        else:
            for k in (1, 2, 3):
                part = data[i : i + k]
                if None in part:
                    size = len(part)
                    break
                if len(part) == k and (letter := _decoded(bytes(part), page)) is not None:
                    size = k
                    break
            if not size:
                return None
        out.append((size, letter))
        i += size
    return out


def units(text: str, swap: str) -> tuple[list[str], list[str | None]] | None:
    """The units of a text under a key and the letter that the pages give each of them (None where they say nothing); ASCII stands for itself.

    swap: 'R>T'; 'R>T>cp1252>utf-8' for one that happened twice; '?w:SCRIPT' for a blank key with units of w characters.
    """
    if swap.startswith("?"):
        w, us = int(swap[1]), []
        for ascii_, run in groupby(text, str.isascii):
            s = "".join(run)
            if not ascii_ and len(s) % w:
                return None
            us += list(s) if ascii_ else [s[i : i + w] for i in range(0, len(s), w)]
        return us, [u if u.isascii() else None for u in us]
    us, letters, steps = list(text), list(text), swap.split(">")
    for r, t in zip(steps[::2], steps[1::2]):
        if None in letters or (data := _to_bytes("".join(letters), r)) is None or len(data) != len(us) or (got := _pieces(data, t)) is None:
            return None
        at = np.cumsum([0, *[k for k, _ in got]])
        us, letters = ["".join(us[a:b]) for a, b in zip(at[:-1], at[1:])], [x for _, x in got]
    return us, letters


def _readings(word: str) -> list[tuple[str, str | None]]:
    """(swap, text) of all pairs of pages that could have made this word, without a text for those that leave it unchanged."""
    out, lost = [], LOST in word
    for r in READ_AS:
        data = _to_bytes(word, r)
        if data is None:
            continue
        for t in WRITTEN_IN:
            if t == r:
                continue
            if lost:
                got = _pieces(data, t)
                text = "".join(x or LOST for _, x in got) if got else None
            else:
                text = _decoded(bytes(data), t)
            if text is None:
                continue
            for swap, x in ((f"{r}>{t}", text), *([(f"{r}>utf-8>cp1252>utf-8", _again(text))] if t == "utf-8" and not lost else [])):
                if x == word:
                    out.append((swap, None))
                elif x is not None and "\x00" not in x and not any(0x80 <= ord(c) < 0xA0 for c in x):
                    out.append((swap, x))
    return out


def _again(text: str) -> str | None:
    """What was read as cp1252 a second time."""
    data = _to_bytes(text, "cp1252")
    got = None if data is None or None in data else _decoded(bytes(data), "utf-8")
    return got if got != text else None


def _read(us: list[str], letters: list[str | None], table: dict[str, str]) -> str:
    """Each unit becomes one private symbol, and translate() turns the symbols into letters: those of the table, else of the pages."""
    names: dict[str, str] = {}
    key: dict[int, str] = {}
    for u, x in zip(us, letters):
        if u not in names:
            names[u] = chr(0xF0000 + len(names))
            key[ord(names[u])] = table.get(u) or x or LOST
    return "".join(names[u] for u in us).translate(key)


def _dict(said: list | None) -> dict[str, dict]:
    return {x["unit"]: x for x in said or ()}


SHAPE = "source string, word string, swap string, units array<string>, letters array<string>"


def _candidates(model):
    """mapInArrow function: (word, n) to (word, swap, gain): how much likelier each pair of pages makes the word, null for those that leave it unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(i, 1000) for i in range(0, b.num_rows, 1000)):
                word, n = part.column(0).to_pylist(), part.column(1).to_pylist()
                stands = model.value.score(word, [min(k, OWN) for k in n])
                rows = [(w, swap, s, text) for w, s in zip(word, stands) for swap, text in _readings(w)]
                gain = model.value.score([r[3] if r[3] is not None else "" for r in rows])
                rows = [(r[0], r[1], None if r[3] is None else float(g - r[2])) for r, g in zip(rows, gain) if r[3] is None or g - r[2] >= LEAST_WORD - SLACK]
                cols = list(zip(*rows)) if rows else [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64())], ["word", "swap", "gain"])

    return run


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (source, word, swap) with the word's units and what the pages say of them."""
    for b in batches:
        got = [units(w, c) for w, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        none = pa.nulls(b.num_rows, pa.float64())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x[0] for x in got], pa.list_(pa.string())), pa.array([x[1] for x in got], pa.list_(pa.string())), none], [*b.schema.names, "units", "letters", "base"])


def _score(model):
    """mapInArrow function: (source, word, swap, units, letters, base, n, said) to (source, word, swap, gain)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            word, us, letters, base, n, said = (b.column(i).to_pylist() for i in (1, 3, 4, 5, 6, 7))
            text = [_read(u, x, {k: v["letter"] for k, v in _dict(t).items()}) for u, x, t in zip(us, letters, said)]
            own = dict(zip(word, n))
            stands = dict(zip(own, model.value.score(list(own), list(own.values()))))
            gain = model.value.score(text) - np.array([stands[w] if s is None else s for w, s in zip(word, base)])
            keep = pa.array(gain >= LEAST_WORD)
            yield pa.RecordBatch.from_arrays([x.filter(keep) for x in (b.column(0), b.column(1), b.column(2), pa.array(gain))], ["source", "word", "swap", "gain"])

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (source, swap, n, units, letters, said) to (text, n): words as their keys read them."""
    for b in batches:
        text = [_read(u, x, {k: v["letter"] for k, v in _dict(t).items()}) for u, x, t in zip(*(b.column(i).to_pylist() for i in (3, 4, 5)))]
        yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), b.column(2)], ["text", "n"])


def _letters(model):
    """mapInArrow function: (source, swap, n, units, letters, said) to (source, swap, unit, page, letter, n): the letters that each unit may stand for, given its neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, seen = model.value, {}
        for b in batches:
            sums: dict[tuple, float] = {}
            for source, swap, n, us, page, said in zip(*(b.column(i).to_pylist() for i in range(6))):
                table = _dict(said)
                now = [table[u]["letter"] if u in table else x or LOST for u, x in zip(us, page)]
                sym = [0, *[_symbol(x[-1]) for x in now], 0]
                for i, (u, x) in enumerate(zip(us, page)):
                    if u.isascii():
                        continue
                    best, p = (table[u]["letter"], table[u]["p"]) if u in table else (x, PAGE_TRUST)
                    at = (sym[i], best, round(p, 2) if best else 0, sym[i + 2])
                    if at not in seen:
                        if best and ord(best[-1]) >= IDEOGRAPHS:
                            seen[at] = [(best, 1.0)]
                        else:
                            v = lm.between(sym[i], sym[i + 2])
                            v = np.where(LETTER > 0, v, -np.inf) + np.log((1 - p) / N_SYMBOLS if best else 1.0 / N_SYMBOLS)
                            if best:
                                k = _symbol(best[-1])
                                v[k] = lm.log(np.array([sym[i]]), np.array([k]))[0] + lm.log(np.array([k]), np.array([sym[i + 2]]))[0] + np.log(max(p, 1e-3))
                            v = np.exp(v - v.max())
                            v /= v.sum()
                            seen[at] = [(best if best and k == _symbol(best[-1]) else chr(LETTER[k]), float(v[k])) for k in np.nonzero(v > 0.02)[0] if LETTER[k] or best]
                    for letter, q in seen[at]:
                        sums[source, swap, u, x, letter] = sums.get((source, swap, u, x, letter), 0.0) + n * q
            cols = list(zip(*sums)) if sums else [()] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols), pa.array(list(sums.values()), pa.float64())], ["source", "swap", "unit", "page", "letter", "n"])

    return run


def _lines(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(doc, source, words, f1, f2): the words outside of ASCII of each line that has some, and the hashes that the line goes by."""
    d = docs.select(F.col(key).alias("doc"), F.coalesce(F.lower(F.trim(F.col(source))), F.lit("")).alias("source"), F.col(text).alias("_t"))
    lines = d.filter(_foreign(F.col("_t"))).select("doc", "source", F.explode(F.split("_t", r"[\r\n]+")).alias("line")).filter(_foreign(F.col("line")))
    lines = lines.select("doc", "source", _words(F.col("line")).alias("words"))
    return lines.select("*", *_names(F.col("source"), F.col("words")))


def _foreign(c: Column) -> Column:
    """Whether a text has characters outside of ASCII: it has more bytes than characters."""
    return F.octet_length(c) > F.char_length(c)


def _words(line: Column) -> Column:
    return F.filter(F.split(line, r"[ \t]+"), _foreign)


def _names(source: Column, words: Column) -> list[Column]:
    return [F.xxhash64(source, words).alias("f1"), F.xxhash64(F.lit(7), words, source).alias("f2")]


LINE = ["f1", "f2"]


class Garbled:
    """lines: doc, source, f1, f2, swap (null for lines with nothing but lost characters); keys: source, swap, unit, letter, n, best (the table's letter)."""

    def __init__(self, lines: DataFrame, keys: DataFrame | None):
        self.lines, self.keys = lines, keys


class _Fit:
    """The state of one fit: words of lines, candidates, tables, and the lines found."""

    def __init__(self, docs: DataFrame, key: str, text: str, source: str):
        self.spark = docs.sparkSession
        self.lines = cut(_lines(docs, key, text, source))
        # words that have lost characters alone say nothing about a key
        telling = F.filter("words", lambda w: ~_lost_only(w))
        forms = self.lines.groupBy("f1", "f2", "source", "words").agg(F.count("*").alias("n")).withColumn("telling", telling)
        forms = cut(forms.select("f1", "f2", "source", "n", F.explode_outer("telling").alias("word"), F.size("telling").alias("size")))
        self.lost = forms.filter("word IS NULL").select("f1", "f2", F.lit(None).cast("string").alias("swap"))
        self.words = forms.filter("word IS NOT NULL")
        self.counts = cut(self.words.groupBy("word").agg(F.sum("n").alias("n")))
        self.refused = self.spark.createDataFrame([], "source string, swap string")
        self.teach: DataFrame | None = None
        self.open: DataFrame | None = None
        self.keys: DataFrame | None = None
        self.found: DataFrame | None = None

    def model(self, texts: DataFrame, plain: bool = False):
        sums = texts.mapInArrow(_count(plain), "kind bigint, code bigint, n bigint").groupBy("kind", "code").agg(F.sum("n").alias("n"))
        return self.spark.sparkContext.broadcast(Bigrams(sums.toPandas()))

    def start(self) -> None:
        """Candidates from the pages, by bigrams of the words that could not be swapped UTF-8."""
        spread = self.counts.repartition(self.spark.sparkContext.defaultParallelism * 2, "word")
        self.lm = self.model(spread.select("word", "n"), plain=True)
        maybe = cut(spread.mapInArrow(_candidates(self.lm), "word string, swap string, gain double"))
        # the keys that read all words of a line, some of which they may leave unchanged, and don't make it far less likely
        new, same = maybe.filter("gain IS NOT NULL"), maybe.filter("gain IS NULL").select("word", "swap")
        part = self.words.select("f1", "f2", "size", "word").join(new, "word").groupBy("f1", "f2", "swap").agg(F.max("size").alias("size"), F.count("*").alias("k"), F.sum("gain").alias("gain"))
        part = cut(part.filter(F.col("gain") > AGAINST_UTF8 - 2 * SLACK))
        rest = part.filter("k < size").select("f1", "f2", "swap").join(self.words.select("f1", "f2", "word"), LINE).join(same, ["word", "swap"]).groupBy("f1", "f2", "swap").agg(F.count("*").alias("rest"))
        whole = part.join(rest, ["f1", "f2", "swap"], "left").filter("k + coalesce(rest, 0) = size").select("f1", "f2", "swap", "k", "gain")
        self.whole = cut(whole.join(self.words.select("f1", "f2", "source", "n").distinct(), LINE))
        terms = self.whole.select("f1", "f2", "swap", "k").join(self.words, LINE).join(new.select("word", "swap"), ["word", "swap"])
        self.terms = cut(terms.select("f1", "f2", "source", "n", "word", "swap", "k"))
        self.cand = cut(self.terms.select("source", "word", "swap").distinct().mapInArrow(_spelled, SHAPE + ", base double"))

    def _said(self, cand: DataFrame) -> DataFrame:
        """cand with said: what the tables say other than the pages, of the word's own units."""
        if self.open is None or self.open.isEmpty():
            return cand.withColumn("said", F.lit(None).cast("array<struct<unit: string, letter: string, p: double>>"))
        at = ["source", "swap", "word"]
        need = cand.select(*at, F.explode(F.array_distinct("units")).alias("unit")).filter(_foreign(F.col("unit"))).join(self.open, ["source", "swap", "unit"])
        return cand.join(need.groupBy(*at).agg(F.collect_list(F.struct("unit", "letter", "p")).alias("said")), at, "left")

    def e_step(self) -> int:
        """Reads all words by the tables and gives each line its likeliest key; returns how many lines changed theirs."""
        if self.found is None:
            per = self.whole
        else:
            known = self.teach.groupBy(F.col("text").alias("word")).agg(F.least(F.sum("n"), F.lit(OWN)).alias("n"))
            src = self._said(self.cand).join(known, "word", "left").select("source", "word", "swap", "units", "letters", "base", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), "said")
            self.gains = cut(src.mapInArrow(_score(self.lm), "source string, word string, swap string, gain double"))
            per = self.terms.join(self.gains, ["source", "word", "swap"]).groupBy("f1", "f2", "source", "swap", "n", "k").agg(F.sum("gain").alias("gain"), F.count("*").alias("read")).filter("read = k")
        against = F.when(F.col("swap").contains(">utf-8"), AGAINST_UTF8).otherwise(AGAINST_OTHER)
        per = per.filter(F.col("gain") > AGAINST_UTF8)
        if self.found is not None:
            seen = self.found.groupBy("source", "swap").agg(F.log1p(F.sum("n")).alias("bonus"))
            per = per.join(seen, ["source", "swap"], "left")
        else:
            per = per.withColumn("bonus", F.lit(0.0))
        # a key that the source shows often needs less to be believed, and of keys that read a line alike it comes first
        fit = F.col("gain") - against + F.coalesce("bonus", F.lit(0.0))
        per = per.filter(fit > 0)
        best = per.groupBy("f1", "f2", "source").agg(F.min_by(F.struct("swap", "n"), F.struct(-fit, F.col("swap"))).alias("m"))
        was, self.found = self.found, cut(best.select("f1", "f2", "source", "m.swap", "m.n"))
        if was is None:
            return self.found.count()
        return self.found.select(*LINE, "swap").join(was.select(*LINE, F.col("swap").alias("was")), LINE, "full").filter("NOT swap <=> was").count()

    def m_step(self) -> None:
        """Tables, and bigrams of all words as they are read now."""
        held = cut(self.words.join(self.found.select("f1", "f2", "swap"), LINE, "left").groupBy("source", "word", "swap").agg(F.sum("n").alias("n")))
        used = self._said(held.filter("swap IS NOT NULL").join(self.cand, ["source", "word", "swap"])).select("source", "swap", "n", "units", "letters", "said", "word")
        used = cut(used)
        read = used.select("source", "swap", "n", "units", "letters", "said")
        # words that a key leaves unchanged have no candidate of their own
        plain = held.join(used.select("source", "word", "swap"), ["source", "word", "swap"], "left_anti").select(F.col("word").alias("text"), "n")
        self.teach = cut(plain.unionByName(read.mapInArrow(_texts, "text string, n bigint")).groupBy("text").agg(F.sum("n").alias("n")))
        self.lm.unpersist()
        self.lm = self.model(self.teach)
        sums = read.mapInArrow(_letters(self.lm), "source string, swap string, unit string, page string, letter string, n double").groupBy("source", "swap", "unit", "page", "letter").agg(F.sum("n").alias("n"))
        self.keys = cut(sums, self.keys)
        weight = F.col("n") + F.when(F.col("letter") == F.col("page"), PAGE_WEIGHT).otherwise(0.0)
        best = self.keys.groupBy("source", "swap", "unit", "page").agg(F.max_by("letter", F.struct(weight, F.col("letter"))).alias("letter"), (F.max(weight) / (F.sum("n") + F.when(F.col("page").isNull(), 0.0).otherwise(PAGE_WEIGHT))).alias("p"))
        self.best = best
        self.open = cut(best.filter("page IS NULL OR letter <> page").select("source", "swap", "unit", "letter", F.least("p", F.lit(0.999)).alias("p")))

    def settle(self) -> None:
        for _ in range(ROUNDS):
            changed = self.e_step()
            if self.teach is not None and changed <= SETTLED * self.found.count():
                return
            self.m_step()

    # --- blank keys ---------------------------------------------------------------------------------------------------------

    def unaided(self, texts: DataFrame) -> DataFrame:
        """(source, word, base, bad, k) of texts(source, word): by bigrams to which the text's own source didn't add.

        base is its log probability; bad how much less likely than usual its k bigrams outside of ASCII are.
        """
        own = self.own.join(texts.select("source").distinct(), "source", "left_semi").withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(self.tasks - 1))))
        w = texts.select("source", "word").distinct().withColumn("task", F.pmod(F.xxhash64("word"), F.lit(self.tasks)).cast("int"))
        return w.groupBy("source", "task").cogroup(own.groupBy("source", "task")).applyInPandas(_unaided(self.lm), "source string, word string, base double, bad double, k bigint")

    def suspects(self) -> DataFrame:
        """(f1, f2, source, word, n, size, base, bad): words of lines that no key explains and that the other sources' bigrams make unlikely."""
        left = self.words.join(self.found, LINE, "left_anti")
        mine = left.groupBy("source", "word").agg(F.sum("n").alias("n"))
        self.tasks = mine.count() // TASK_RUNS + 1
        self.own = cut(mine.mapInArrow(_own_bigrams, "source string, code bigint, n bigint").groupBy("source", "code").agg(F.sum("n").alias("n")))
        per = left.join(cut(self.unaided(mine)), ["source", "word"])
        bad = per.groupBy(*LINE).agg(F.sum("bad").alias("b"), F.min(F.col("bad") / F.col("k")).alias("each")).filter((F.col("each") > SUSPECT) & (F.col("b") > AGAINST_OTHER))
        some = cut(per.join(bad.select(*LINE), LINE, "left_semi").select("f1", "f2", "source", "word", "n", "size", "base", "bad"))
        # only sources whose lines could pay for a key at all
        cost = some.select("source", F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter(_foreign(F.col("c"))).groupBy("source").agg((F.count_distinct("c") * UNIT_COST + KEY_COST).alias("cost"))
        pays = some.select("source", "word", "bad").distinct().groupBy("source").agg(F.sum("bad").alias("bad")).join(cost, "source").filter("bad > cost")
        return some.join(pays.select("source"), "source", "left_semi")

    def blank(self) -> bool:
        """Learns at most one blank key for each source from what no other key explains, and adds its candidates; False if there was none."""
        some = cut(self.suspects())
        if some.isEmpty():
            return False
        # what is to be explained doesn't speak for itself
        minus = some.groupBy(F.col("word").alias("text")).agg((-F.sum("n")).alias("n"))
        lm = self.model(self.teach.unionByName(minus).groupBy("text").agg(F.sum("n").alias("n")).filter("n > 0"))
        alphabets = sorted(lm.value.alphabets)
        # each word speaks once: copies of a line are no evidence
        words = cut(some.groupBy("source", "word").agg(F.lit(1).cast("bigint").alias("n"), F.first("base").alias("base")))
        widths = words.select("source", F.explode(F.array(F.lit(1), F.lit(2))).alias("w"), "word", "n", "base")
        widths = widths.filter("w = 1 OR NOT exists(split(word, '[\\\\x00-\\\\x7F]+'), x -> char_length(x) % 2 = 1)")  # pairs of characters have even stretches
        runs = cut(widths.mapInArrow(_runs, "source string, w int, a int, run array<string>, b int, n bigint, size int").groupBy("source", "w", "a", "run", "b", "size").agg(F.sum("n").alias("n")))
        tasks = runs.count() // TASK_RUNS + 1
        seen = runs.select("source", "w", F.explode("run").alias("unit"), "n").groupBy("source", "w", "unit").agg(F.sum("n").alias("n"))
        table = cut(seen.groupBy("source", "w").applyInPandas(_first_tables(lm, alphabets), TABLE))
        data = runs.withColumn("task", F.pmod(F.xxhash64("run", "a", "b"), F.lit(tasks)).cast("int")).withColumn("script", F.explode(F.array(*map(F.lit, alphabets))))
        at, was = ["source", "w", "script", "task"], -np.inf
        for _ in range(BLANK_ROUNDS):
            spread = table.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
            part = data.groupBy(*at).cogroup(spread.groupBy(*at)).applyInPandas(_expected(lm), PART)
            table = cut(part.groupBy("source", "w", "script").applyInPandas(_new_tables, TABLE), table)
            now = table.groupBy("source", "w", "script").agg(F.first("ll").alias("ll")).agg(F.sum("ll")).first()[0] or 0.0
            if now - was <= GAIN * abs(now):
                break
            was = now
        # a key has to pay for its own description, and to read about as well as right text does
        stands = widths.groupBy("source", "w").agg(F.sum(F.col("base") * F.col("n")).alias("stands"))
        inner = runs.groupBy("source", "w").agg(F.sum(F.col("n") * (F.size("run") + 1)).alias("steps"))
        plain = widths.mapInArrow(_plain_part(lm), "source string, w int, ll double").groupBy("source", "w").agg(F.sum("ll").alias("plain"))
        score = table.groupBy("source", "w", "script").agg(F.first("ll").alias("ll"), (F.count("*") * UNIT_COST + KEY_COST).alias("cost")).join(inner, ["source", "w"]).join(plain, ["source", "w"]).join(stands, ["source", "w"])
        good = (F.col("ll") + F.col("plain") - F.col("cost") > F.col("stands")) & (F.col("ll") > F.col("steps") * (lm.value.usual - WELL))
        score = score.filter(good).withColumn("swap", F.concat(F.lit("?"), F.col("w").cast("string"), F.lit(":"), F.col("script")))
        score = score.join(self.cand.select("source", "swap").distinct().unionByName(self.refused), ["source", "swap"], "left_anti")
        pick = cut(score.groupBy("source").agg(F.max_by(F.struct("w", "script", "swap"), F.col("ll") - F.col("cost")).alias("m")).select("source", "m.w", "m.script", "m.swap"))
        if pick.isEmpty():
            return False
        new = table.join(pick, ["source", "w", "script"]).mapInArrow(_best_letters(lm), "source string, swap string, unit string, letter string, p double")
        new = cut(new)
        more = cut(words.join(pick.select("source", "swap"), "source").select("source", "word", "n", "base", "swap").mapInArrow(_blank_candidates, SHAPE + ", base double"))
        # the source's own bigrams vouch for what it reads as little as for what stands there
        letter = F.when(_foreign(F.col("unit")), F.col("letter")).otherwise(F.col("unit"))
        read = more.select("source", "swap", "word", F.posexplode("units").alias("i", "unit")).join(new, ["source", "swap", "unit"], "left").groupBy("source", "word").agg(F.array_sort(F.collect_list(F.struct("i", letter.alias("x")))).alias("t"))
        read = cut(read.select("source", "word", F.array_join(F.transform("t", lambda x: x["x"]), "").alias("text")))
        with_own = read.select("source", "text").distinct().mapInArrow(_scored(lm), "source string, text string, aided double")
        without = self.unaided(read.select("source", F.col("text").alias("word"))).select("source", F.col("word").alias("text"), F.col("base").alias("alone"))
        read = read.join(with_own, ["source", "text"]).join(without, ["source", "text"]).select("source", "word", (F.col("aided") - F.col("alone")).alias("help"))
        more = more.join(read, ["source", "word"]).withColumn("base", F.col("base") + F.col("help")).drop("help")
        self.open = cut(self.open.unionByName(new) if self.open is not None else new)
        self.cand = cut(self.cand.unionByName(more))
        lines = some.join(pick.select("source", "swap"), "source").withColumn("k", F.col("size").cast("bigint"))
        self.terms = cut(self.terms.unionByName(lines.select("f1", "f2", "source", "n", "word", "swap", "k")))
        return True

    def unpaid(self) -> DataFrame:
        """(source, swap): blank keys that gain less with the words of the lines they were given than they cost to describe."""
        used = self.terms.filter(F.col("swap").startswith("?")).join(self.found.select("f1", "f2", "swap"), [*LINE, "swap"]).select("source", "swap", "word").distinct()
        gain = used.join(self.gains, ["source", "word", "swap"]).groupBy("source", "swap").agg(F.sum("gain").alias("gain"))
        many = used.join(self.cand, ["source", "word", "swap"]).select("source", "swap", F.explode("units").alias("u")).filter(_foreign(F.col("u"))).groupBy("source", "swap").agg(F.count_distinct("u").alias("u"))
        return gain.join(many, ["source", "swap"]).filter(F.col("gain") < F.col("u") * UNIT_COST + KEY_COST).select("source", "swap")

    def drop_unpaid(self) -> None:
        """Takes back what unpaid keys have read, and the keys."""
        bad = cut(self.unpaid())
        if not bad.isEmpty():
            without = lambda d: cut(d.join(bad, ["source", "swap"], "left_anti"))
            self.found, self.cand, self.terms = without(self.found), without(self.cand), without(self.terms)
            self.refused = self.refused.unionByName(bad)
            self.m_step()


def _lost_only(word: Column) -> Column:
    """Whether the only characters outside of ASCII are lost ones."""
    return ~_foreign(F.translate(word, LOST, ""))


def _own_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (source, word, n) to the counts of bigrams (source, code, n)."""
    for b in batches:
        for source, at in pd.Series(range(b.num_rows)).groupby(b.column(0).to_pandas()).groups.items():
            part = b.take(pa.array(at.to_numpy()))
            got = _counted(part.column(1).to_pylist(), part.column(2).to_numpy())
            keep = pa.array(np.nonzero(got.column(0).to_numpy() == 0)[0])
            yield pa.RecordBatch.from_arrays([pa.array([source] * len(keep), pa.string()), got.column(1).take(keep), got.column(2).take(keep)], ["source", "code", "n"])


def _scored(model):
    """mapInArrow function: (source, text) with the text's log probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(model.value.score(b.column(1).to_pylist()), pa.float64())], ["source", "text", "aided"])

    return run


def _unaided(model):
    """Cogrouped words and bigram counts of one source; see _Fit.unaided."""

    def run(words: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(words):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("source", object), ("word", object), ("base", float), ("bad", float), ("k", "int64"))})
        own = own.sort_values("code")
        code, n = np.append(own["code"].to_numpy(np.int64), np.iinfo(np.int64).max), np.append(own["n"].to_numpy(float), 0.0)
        sym, raw, starts = _codes(words["word"].tolist())
        a, b = sym[:-1].astype(np.int64), sym[1:]
        at = np.searchsorted(code, a * N_SYMBOLS + b)
        v = np.append(model.value.log(a, b, np.where(code[at] == a * N_SYMBOLS + b, n[at], 0.0)), 0.0) + np.where(raw >= IDEOGRAPHS, model.value.single[np.minimum(raw, 0xFFFF)], 0)
        on = np.append((a > 28) | (b > 28), False)
        ends = np.append(starts[1:], len(sym)) - 1
        v[ends], on[ends] = 0, False
        k, bad = np.add.reduceat(on.astype(int), starts), np.add.reduceat(np.where(on, model.value.usual - v, 0.0), starts)
        many = np.add.reduceat((raw >= IDEOGRAPHS).astype(int), starts)  # they have no alphabet
        return pd.DataFrame({"source": words["source"].to_numpy(object), "word": words["word"].to_numpy(object), "base": np.add.reduceat(v, starts), "bad": np.where(many, -np.inf, bad), "k": k})

    return run


TABLE = "source string, w int, script string, unit string, probs array<double>, ll double"
PART = "source string, w int, script string, unit string, sums array<double>, ll double"


def _tokens(word: str, w: int) -> list[tuple[int, list[str], int]]:
    """(symbol before, units, symbol after) of each stretch of units."""
    us, page = units(word, f"?{w}:")
    out, last = [], 0
    for is_unit, part in groupby(zip(us, page), lambda x: x[1] is None):
        part = list(part)
        if is_unit:
            out.append([last, [u for u, _ in part], 0])
        else:
            if out:
                out[-1][2] = _symbol(part[0][0])
            last = _symbol(part[-1][0])
    return [tuple(x) for x in out]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (source, w, word, n) to its stretches of units with the symbols around them."""
    for b in batches:
        rows = [(s, w, a, run, z, n, len(run)) for s, w, word, n in zip(*(b.column(i).to_pylist() for i in range(4))) for a, run, z in _tokens(word, w)]
        cols = list(zip(*rows)) if rows else [()] * 7
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["source", "w", "a", "run", "b", "n", "size"])


def _plain_part(model):
    """mapInArrow function: (source, w, word, n) to the log probability of what stands for itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n = b.column(2).to_pylist(), b.column(3).to_numpy()
            sym, _, starts = _codes(texts)
            v = np.append(np.where((sym[:-1] <= 28) & (sym[1:] <= 28), model.value.log(sym[:-1], sym[1:]), 0.0), 0.0)
            v[np.append(starts[1:], len(sym)) - 1] = 0
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.add.reduceat(v, starts) * n if texts else [], pa.float64())], ["source", "w", "ll"])

    return run


def _first_tables(model, alphabets: list[str]):
    """applyInPandas function over the units of a source: P(unit | letter) by how alike their ranks in frequency are."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f, out = f.sort_values(["n", "unit"], ascending=[False, True]), []
        for script in alphabets:
            letters = model.value.alphabets[script]
            rank = np.empty(len(letters))
            rank[np.argsort(-model.value.col[letters], kind="stable")] = np.arange(len(letters))
            p = np.exp(-np.abs(np.arange(len(f))[:, None] - rank[None, :]) / 8.0) + 0.05
            p /= p.sum(0)
            out += [(f["source"].iloc[0], f["w"].iloc[0], script, u, x, 0.0) for u, x in zip(f["unit"], p)]
        return pd.DataFrame(out, columns=["source", "w", "script", "unit", "probs", "ll"])

    return run


def _expected(model):
    """Cogrouped stretches and table of a source and script: expected counts of letters for units, and the log likelihood."""

    def run(key: tuple, data: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        lm, letters = model.value, model.value.alphabets[key[2]]
        size = len(letters)
        at = {u: i for i, u in enumerate(table["unit"])}
        emit = np.array(table["probs"].tolist()).reshape(len(at), size)
        step = np.exp(lm.log(np.repeat(letters, size), np.tile(letters, size))).reshape(size, size)
        sums, ll = np.zeros_like(emit), 0.0
        for k, part in data.groupby("size"):
            for some in np.array_split(np.arange(len(part)), len(part) * k * size // 4_000_000 + 1):
                d = part.iloc[some]
                if not len(d):
                    continue
                u = np.array([[at[x] for x in r] for r in d["run"]])
                a, b, n = d["a"].to_numpy(), d["b"].to_numpy(), d["n"].to_numpy(float)
                head = np.exp(lm.log(np.repeat(a, size), np.tile(letters, len(a)))).reshape(-1, size)
                tail = np.exp(lm.log(np.tile(letters, len(b)), np.repeat(b, size))).reshape(-1, size)
                fwd, scale = [], np.zeros(len(d))
                f = head * emit[u[:, 0]]
                for i in range(k):
                    if i:
                        f = (f @ step) * emit[u[:, i]]
                    z = f.sum(1, keepdims=True) + 1e-300
                    f = f / z
                    scale += np.log(z[:, 0])
                    fwd.append(f)
                g = tail
                last = (f * g).sum(1) + 1e-300
                ll += float((n * (scale + np.log(last))).sum())
                for i in range(k - 1, -1, -1):
                    post = fwd[i] * g
                    post /= post.sum(1, keepdims=True) + 1e-300
                    np.add.at(sums, u[:, i], post * n[:, None])
                    g = (g * emit[u[:, i]]) @ step.T
                    g /= g.sum(1, keepdims=True) + 1e-300
        return pd.DataFrame([(*key[:3], u, x, 0.0 if i else ll) for i, (u, x) in enumerate(zip(at, sums))], columns=["source", "w", "script", "unit", "sums", "ll"])

    return run


def _new_tables(f: pd.DataFrame) -> pd.DataFrame:
    """applyInPandas function: the parts of one key to P(unit | letter); ll is the key's own log likelihood, in each row."""
    names, code = np.unique(f["unit"].to_numpy(str), return_inverse=True)
    total = np.zeros((len(names), len(f["sums"].iloc[0])))
    np.add.at(total, code, np.array(f["sums"].tolist()))
    p = total + 0.01
    p /= p.sum(0)
    of, ll = (f["source"].iloc[0], f["w"].iloc[0], f["script"].iloc[0]), f["ll"].sum()
    return pd.DataFrame([(*of, str(u), x, ll) for u, x in zip(names, p)], columns=["source", "w", "script", "unit", "probs", "ll"])


def _best_letters(model):
    """mapInArrow function: rows of tables with swap to each unit's likeliest letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = model.value
        for b in batches:
            rows = []
            for x in b.to_pylist():
                letters = lm.alphabets[x["script"]]
                v = np.array(x["probs"]) * lm.col[letters]  # P(unit | letter) P(letter)
                k = int(np.argmax(v))
                rows.append((x["source"], x["swap"], x["unit"], chr(LETTER[letters[k]]), float(min(v[k] / v.sum(), 0.999))))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:4]), pa.array(cols[4], pa.float64())], ["source", "swap", "unit", "letter", "p"])

    return run


def _blank_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (source, word, n, base, swap) to the columns of candidates."""
    for b in batches:
        rows = [(x["source"], x["word"], x["swap"], *got, x["base"]) for x in b.to_pylist() if (got := units(x["word"], x["swap"]))]
        cols = list(zip(*rows)) if rows else [()] * 6
        kinds = (pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["source", "word", "swap", "units", "letters", "base"])


def find_garbled(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", with_keys: bool = True) -> Garbled:
    """Lines that were read in the wrong encoding, and the keys learned for each source (None without with_keys).

    The defined cases: null, empty and pure ASCII texts have no lines; a null source is a source of its own; sources that differ in case or
    outer blanks are one; a lost character (U+FFFD) is a unit, or part of one, whose letter the pages don't know; lines all of whose words
    outside of ASCII have lost characters alone are garbled and have no key; equal documents have equal results; other columns are ignored.
    """
    fit = _Fit(docs, key, text, source)
    fit.start()
    fit.settle()
    while fit.blank():  # each turn takes away what its keys explain
        fit.settle()
        fit.drop_unpaid()
    if with_keys:
        fit.m_step()
    found = fit.found.select("f1", "f2", "swap").unionByName(fit.lost)
    if not with_keys:
        return Garbled(fit.lines.select("doc", "source", "f1", "f2").join(found, LINE), None)
    keys = fit.keys.join(fit.best.select("source", "swap", "unit", F.col("letter").alias("_b")), ["source", "swap", "unit"]).select("source", "swap", "unit", "letter", "n", (F.col("letter") == F.col("_b")).alias("best"))
    return Garbled(fit.lines.select("doc", "source", "f1", "f2").join(found, LINE), keys)


def garbled_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key): documents with at least one garbled line, each once; null keys are left out. See find_garbled."""
    return find_garbled(docs, key, text, source, with_keys=False).lines.filter("doc IS NOT NULL").select(F.col("doc").alias(key)).distinct()


def restore(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", found: Garbled | None = None) -> DataFrame:
    """(key, text, exact) of the garbled documents, with their garbled lines read by the tables of their source; found: what find_garbled gave for docs, if it is at hand.

    exact tells whether the tables knew the letter of every unit of all garbled lines. Lines with nothing but lost characters stay as they
    are, and exact is false. Repeated documents come as often as in docs. See find_garbled for the other cases.
    """
    g = found or find_garbled(docs, key, text, source)
    bad = g.lines.select("doc").filter("doc IS NOT NULL").distinct()
    d = docs.select(F.col(key).alias("doc"), F.coalesce(F.lower(F.trim(F.col(source))), F.lit("")).alias("source"), F.col(text).alias("_t")).join(bad, "doc", "left_semi").withColumn("row", F.expr("uuid()"))
    kind = d.schema["doc"].dataType.simpleString()
    lines = d.select("doc", "row", "source", F.posexplode(F.split("_t", r"(?<=[\r\n])(?=[^\r\n])")).alias("i", "line")).withColumn("_w", _words(F.regexp_replace("line", r"[\r\n]+$", "")))
    lines = cut(lines.select("doc", "row", "i", "line", "source", *_names(F.col("source"), F.col("_w"))))
    swaps = g.lines.select("f1", "f2", "swap").distinct().withColumn("hit", F.lit(True))
    marked = cut(lines.join(swaps, LINE, "left"))
    # of each garbled line the letters of its own units
    todo = marked.filter("swap IS NOT NULL").select("f1", "f2", "source", "swap", "line").dropDuplicates([*LINE, "line"])
    split = todo.mapInArrow(_line_units, "f1 bigint, f2 bigint, source string, swap string, line string, units array<string>, letters array<string>")
    split = cut(split.withColumn("id", F.xxhash64("line")))
    best = g.keys.filter("best").select("source", "swap", "unit", "letter")
    said = split.select("f1", "f2", "id", "source", "swap", F.explode(F.array_distinct("units")).alias("unit")).filter(_foreign(F.col("unit"))).join(best, ["source", "swap", "unit"])
    said = said.groupBy("f1", "f2", "id").agg(F.collect_list(F.struct("unit", "letter")).alias("said"))
    read = split.join(said, ["f1", "f2", "id"], "left").mapInArrow(_restored, "f1 bigint, f2 bigint, line string, new string, ok boolean")
    out = marked.join(read, [*LINE, "line"], "left").select("doc", "row", "i", F.coalesce("new", "line").alias("line"), F.when(F.col("hit").isNull(), True).otherwise(F.coalesce("ok", F.lit(False))).alias("ok"))
    texts = out.groupBy("doc", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]), "").alias("text"), F.min("ok").alias("exact"))
    return texts.select(F.col("doc").cast(kind).alias(key), "text", "exact")


def _line_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (f1, f2, source, swap, line) with the line's units and what the pages say of them; words that the key can't read stand for themselves."""
    for b in batches:
        us, letters = [], []
        for swap, line in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
            u: list[str] = []
            x: list[str | None] = []
            for word in re.split(r"([ \t\r\n]+)", line):
                got = units(word, swap) if _NOT_ASCII.search(word) else None
                u += got[0] if got else list(word)
                x += got[1] if got else list(word)
            us.append(u)
            letters.append(x)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(us, pa.list_(pa.string())), pa.array(letters, pa.list_(pa.string()))], [*b.schema.names, "units", "letters"])


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: lines with their units to the lines as read by the tables."""
    for b in batches:
        new, ok = [], []
        for x in b.select(["units", "letters", "said"]).to_pylist():
            table = {k: v["letter"] for k, v in _dict(x["said"]).items()}
            new.append(_read(x["units"], x["letters"], table))
            ok.append(not any(LOST in u or (p is None and u not in table) for u, p in zip(x["units"], x["letters"])))
        yield pa.RecordBatch.from_arrays([b.column("f1"), b.column("f2"), b.column("line"), pa.array(new, pa.string()), pa.array(ok, pa.bool_())], ["f1", "f2", "line", "new", "ok"])


def learned_keys(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(source, swap, unit, letter, n): the tables learned for each source, in expected occurrences."""
    g = find_garbled(docs, key, text, source)
    return g.keys.groupBy("source", "swap", "unit", "letter").agg(F.round(F.sum("n"), 3).alias("n"))
