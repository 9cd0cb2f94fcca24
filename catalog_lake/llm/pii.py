"""Personal data: fixed patterns, and a linear-chain conditional random field that finds other spellings.

The field labels words O, B-kind or I-kind from their shapes (letter, digit and mark
classes), digit counts, checksums and the shapes of the words beside them.  It is trained
here, in numpy, on a small labelled table, and decoded by Viterbi in numpy batches.  Its
chains are the neighbourhoods of words that personal data cannot do without: a digit, an
at sign, ``::`` or the word "dot".  What it adds must still pass its kind's check (a
card's checksum, an address that reads as one), so numbers that only look alike are left.
"""

from __future__ import annotations

import hashlib
import ipaddress
import random
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words on each side of a telling word that belong to its chain.
NEIGHBOURS = 3
#: Rows of the labelled table that a fit uses at most, by smallest hash; the table below has fewer.
MAX_LABELLED_ROWS = 5_000

# --- the fixed patterns ---------------------------------------------------------------------

DIGIT = re.compile(r"[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+")
# A match can only start where its digits start, so a long run of digits is tried once.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain: at each at sign the longest local part before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL_END.match(text[start - 1]):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1  # no match can reach over this at sign
            at = text.find("@", done)


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """(start, end) of the fixed patterns, one list per kind in the order of KINDS."""
    out: list[list[tuple[int, int]]] = [list(_emails(text)), [], [], []]
    if DIGIT.search(text):
        out[1] = [m.span() for m in IP.finditer(text)
                  if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split("."))]
        out[2] = [m.span() for m in CARD.finditer(text) if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        out[3] = [m.span() for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


# --- words and features ---------------------------------------------------------------------

TELLING = re.compile(r"[0-9@]|::|(?<![A-Za-z])[dD][oO][tT](?![A-Za-z])")
EDGES = ".,;:!?\"'<>#$%&*|"
V6 = re.compile(r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}")
RUNS = re.compile(r"(.)\1+")
CLASSES = {**{chr(c): "A" for c in range(65, 91)}, **{chr(c): "a" for c in range(97, 123)}, **{chr(c): "0" for c in range(48, 58)}}
#: Words whose spelling, not only their shape, is a feature.
SPELLED = {"at", "[at]", "(at)", "dot", "[dot]", "(dot)", "tel", "telephone", "phone", "call", "mobile", "fax", "mail", "email", "write", "card",
           "visa", "amex", "paid", "ip", "host", "address", "server", "version", "order", "invoice", "no", "token", "isbn", "date", "=",
           "telefon", "kontakt", "karte", "appelez", "carte", "llame", "tarjeta", "correo"}


def _features(word: str) -> tuple[list[str], list[str]]:
    """The word's own features, and those that its neighbours see."""
    core = word.strip(EDGES)
    shape = "".join(CLASSES.get(c, c if c.isascii() else "a" if c.isalpha() else "?") for c in core[:64])
    short = RUNS.sub(r"\1", shape)[:24]
    spelled = core.lower() if core.lower() in SPELLED else ""
    digits = _digits(core)
    seen = [f"s={short}", f"w={spelled}", f"d={min(len(digits), 20)}"]
    own = [*seen, f"f={shape[:24]}", f"e={word != core}", f"l={len(digits) >= 13 and luhn(digits)}",
           f"v={bool(V6.fullmatch(core)) and len(core) > 6}", f"@={len(list(_emails(core)))}",
           f"i={any(s == 0 and e == len(core) for s, e in base_spans(core)[1])}"]
    return own, seen


def chains(text: str) -> list[list[tuple[int, int]]]:
    """The neighbourhoods of telling words: lists of (start, end) of their words."""
    told = [m.start() for m in TELLING.finditer(text)]
    if not told:
        return []
    words = [m.span() for m in WORD.finditer(text)]
    starts = [s for s, _ in words]
    out: list[list[tuple[int, int]]] = []
    stop = 0  # words before this one are placed
    last = -1
    for at in told:
        k = bisect_right(starts, at, max(last, 0)) - 1
        if k == last:
            continue
        last = k
        first, end = max(k - NEIGHBOURS, 0), min(k + NEIGHBOURS + 1, len(words))
        if out and first <= stop:
            out[-1] += words[stop:end]
        else:
            out.append(words[first:end])
        stop = end
    return out


class Crf:
    """Weights of a linear-chain conditional random field over the labels above."""

    CACHED = 50_000  # words of at most 40 characters

    def __init__(self, features: dict[str, int], weights: np.ndarray, steps: np.ndarray, first: np.ndarray):
        self.features, self.weights, self.steps, self.first = features, weights, steps, first
        self._scores: dict[str, np.ndarray] = {}

    def word_scores(self, word: str) -> np.ndarray:
        """Label scores that the word gives to itself, to the word after and to the word before it."""
        got = self._scores.get(word)
        if got is None:
            own, seen = _features(word)
            got = np.zeros((3, len(LABELS)))
            for row, prefix, names in ((0, "", own), (1, "-", seen), (2, "+", seen)):
                for f in names:
                    if (k := self.features.get(prefix + f)) is not None:
                        got[row] += self.weights[k]
            if len(word) <= 40:
                if len(self._scores) >= self.CACHED:
                    self._scores.clear()
                self._scores[word] = got
        return got

    def scores(self, words: list[str]) -> np.ndarray:
        s = np.array([self.word_scores(w) for w in words]).reshape(-1, 3, len(LABELS))
        out = s[:, 0].copy()
        out[1:] += s[:-1, 1]
        out[:-1] += s[1:, 2]
        return out

    def decode(self, batch: list[list[str]]) -> list[np.ndarray]:
        """The best labels of every chain; all chains of the batch go forward a word at a time."""
        order = sorted(range(len(batch)), key=lambda k: -len(batch[k]))
        lengths = np.array([len(batch[k]) for k in order])
        scores = [self.scores(batch[k]) for k in order]
        best, came = np.zeros((len(batch), len(LABELS))), []
        for t in range(int(lengths.max(initial=0))):
            n = int((lengths > t).sum())
            here = np.array([s[t] for s in scores[:n]])
            if t == 0:
                best[:n] = self.first + here
                continue
            paths = best[:n, :, None] + self.steps
            came.append(paths.argmax(axis=1).astype(np.int8))
            best[:n] = paths.max(axis=1) + here
        out: list[np.ndarray] = [np.zeros(0, int)] * len(batch)
        for row, k in enumerate(order):
            labels = np.zeros(lengths[row], int)
            label = int(best[row].argmax())
            for t in range(lengths[row] - 1, -1, -1):
                labels[t] = label
                label = int(came[t - 1][row, label]) if t else label
            out[k] = labels
        return out


def fit(rows: Iterable[tuple[list[str], list[str]]], penalty: float = 0.02, rounds: int = 150) -> Crf:
    """The field's weights from (words, labels) rows: penalised likelihood by gradient ascent with adaptive steps (Adam)."""
    rows = [(w, y) for w, y in rows if w]
    features: dict[str, int] = {}
    cells: list[list[int]] = []
    for words, _ in rows:
        seen = [_features(w) for w in words]
        for t in range(len(words)):
            names = [*seen[t][0], *([f"-{f}" for f in seen[t - 1][1]] if t else []),
                     *([f"+{f}" for f in seen[t + 1][1]] if t + 1 < len(words) else [])]
            cells.append([features.setdefault(f, len(features)) for f in names])
    k, n = len(LABELS), len(rows)
    lengths = np.array([len(w) for w, _ in rows])
    longest = int(lengths.max(initial=1))
    of = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    flat = np.array([f for c in cells for f in c], int)
    row_of = np.repeat(np.arange(n), lengths)
    at = np.arange(len(cells)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    truth = np.array([LABELS.index(x) for _, y in rows for x in y], int)
    gold = np.zeros((len(cells), k))
    gold[np.arange(len(cells)), truth] = 1
    weights = np.zeros((len(features) + k + 1, k))  # features, then steps, then first
    told = np.zeros_like(weights)
    np.add.at(told, flat, gold[of])
    inner = at > 0
    np.add.at(told, (len(features) + truth[:-1][inner[1:]], truth[1:][inner[1:]]), 1)
    told[-1] = gold[at == 0].sum(axis=0)
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    live = np.arange(longest) < lengths[:, None]
    cell_starts = np.append(0, np.cumsum([len(c) for c in cells]))[:-1]
    by_feature = np.argsort(flat, kind="stable")  # every feature occurs
    feature_starts = np.flatnonzero(np.append(True, np.diff(flat[by_feature]) > 0))

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    for r in range(1, rounds + 1):
        steps, first = weights[len(features):-1], weights[-1]
        own = np.add.reduceat(weights[flat], cell_starts)
        emit = np.zeros((n, longest, k))
        emit[row_of, at] = own
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            ahead[:, t] = np.where(live[:, t, None], total(ahead[:, t - 1, :, None] + steps, 1) + emit[:, t], ahead[:, t - 1])
        whole = total(ahead[:, -1], 1)
        expected = np.zeros_like(weights)
        for t in range(longest - 2, -1, -1):
            on = live[:, t + 1]
            after = emit[:, t + 1] + behind[:, t + 1]
            behind[on, t] = total(steps + after[on][:, None, :], 2)
            pair = ahead[on, t][:, :, None] + steps + after[on][:, None, :] - whole[on][:, None, None]
            expected[len(features):-1] += np.exp(pair).sum(axis=0)
        shares = np.exp(ahead + behind - whole[:, None, None])[row_of, at]
        expected[:len(features)] = np.add.reduceat(shares[of[by_feature]], feature_starts)
        expected[-1] = shares[at == 0].sum(axis=0)
        slope = (told - expected) / n - penalty * weights / np.sqrt(n)
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope ** 2
        weights = weights + 0.15 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-8)
    return Crf(features, weights[:len(features)], weights[len(features):-1], weights[-1])


# --- the labelled table ---------------------------------------------------------------------

COMMON = ("the of and to in is on that with for was it der die und den von ist mit ein auf des le la les et un que dans est pour "
          "sur el los que por con las una del se al you we our at by from or as be an not this are").split()


def _filler(rnd: random.Random) -> str:
    word = rnd.choice(COMMON) if rnd.random() < 0.5 else "".join(rnd.choice(("tion", "er", "an", "ou", "re", "st", "ei", "ch", "ón", "é", "ü", "ll", "na"))
                                                                  for _ in range(rnd.randint(1, 5)))
    word = rnd.choice((word, word, word, word.capitalize(), word.upper()))
    return word + rnd.choice(("",) * 12 + (",", ".", ";", "!!", "###", "$$$", "%%%"))


def _number(rnd: random.Random, n: int) -> str:
    return str(rnd.randint(1, 9)) + "".join(str(rnd.randint(0, 9)) for _ in range(n - 1))


def _card(rnd: random.Random, n: int, valid: bool = True) -> str:
    d = rnd.choice("3456") + "".join(str(rnd.randint(0, 9)) for _ in range(n - 2))
    return d + next(str(c) for c in rnd.sample(range(10), 10) if luhn(d + str(c)) == valid)


def _name(rnd: random.Random) -> str:
    return "".join(rnd.choice(("an", "jo", "ri", "ka", "le", "mu", "to", "es")) for _ in range(rnd.randint(1, 3)))


def _sample(rnd: random.Random, kind: str) -> tuple[list[str], list[str]]:
    """Words before, and the words of one piece of personal data of the kind."""
    name, host, top = _name(rnd) + rnd.choice(("", str(rnd.randint(1, 99)), "." + _name(rnd))), _name(rnd), rnd.choice(("com", "org", "de", "example.com"))
    if kind == "email":
        at, dot = rnd.choice((("at", "dot"), ("[at]", "[dot]"), ("(at)", "(dot)"), ("AT", "DOT")))
        out = rnd.choice(([f"{name}@{host}.{top}"], [name, at, host, *[w for p in top.split(".") for w in (dot, p)]]))
        return rnd.choice(([], ["mail"], ["e-mail:"], ["write", "to"], ["correo:"], ["kontakt:"])), out
    if kind == "ip":
        four = ".".join(str(rnd.randint(0, 255)) for _ in range(4))
        groups = [f"{rnd.randint(0, 65535):x}" for _ in range(8)]
        six = rnd.choice((":".join(groups), "2001:db8::" + ":".join(groups[:rnd.randint(1, 4)]), "fe80::" + ":".join(groups[:4])))
        return rnd.choice(([], ["ip"], ["host"], ["from"], ["server"])), [rnd.choice((four, six, six))]
    if kind == "card":
        d = _card(rnd, 16)
        amex = "3" + rnd.choice("47") + "".join(str(rnd.randint(0, 9)) for _ in range(12))
        amex += next(str(c) for c in range(10) if luhn(amex + str(c)))
        four = [d[i:i + 4] for i in range(0, 16, 4)]
        return rnd.choice(([], ["card"], ["visa"], ["paid", "by", "card"], ["carte"], ["karte"], ["tarjeta"])), rnd.choice(
            ([d], four, ["-".join(four)], [".".join(four)], ["/".join(four)], [amex], [amex[:4], amex[4:10], amex[10:]], ["-".join((amex[:4], amex[4:10], amex[10:]))]))
    a, b, c = _number(rnd, 3), _number(rnd, 3), _number(rnd, 4)
    return rnd.choice(([], ["tel"], ["tel."], ["call"], ["phone:"], ["telefon"], ["appelez"], ["llame"], ["mobile"])), rnd.choice(
        (["+1", f"({a})", f"{b}-{c}"], [f"({a})", f"{b}-{c}"], [f"{a}-{b}-{c}"], [f"{a}.{b}.{c}"], [f"00{_number(rnd, 2)}", a, f"{b}{c}"], [f"+{_number(rnd, 2)}", a, b, c],
         [f"0{_number(rnd, 2)}/{b}{c}"], [f"1-{a}-{b}-{c}"]))


def _decoy(rnd: random.Random) -> list[str]:
    """Words that look like personal data and are not."""
    return rnd.choice((
        lambda: [_card(rnd, 16, valid=False)], lambda: [_number(rnd, rnd.randint(1, 9))], lambda: ["version", f"{rnd.randint(0, 9)}.{rnd.randint(0, 20)}.{rnd.randint(0, 9)}"],
        lambda: [f"{rnd.randint(1990, 2030)}-{rnd.randint(1, 12):02}-{rnd.randint(1, 28):02}"], lambda: [f"{rnd.randint(0, 23):02}:{rnd.randint(0, 59):02}:{rnd.randint(0, 59):02}"],
        lambda: ["token", "=", '"' + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + '"'], lambda: [f"{rnd.randint(1, 999)},{rnd.randint(0, 999):03}.{rnd.randint(0, 99):02}"],
        lambda: ["order", "no", _card(rnd, rnd.randint(10, 15), valid=False)], lambda: ["isbn", f"978-{_number(rnd, 1)}-{_number(rnd, 4)}-{_number(rnd, 4)}-{_number(rnd, 1)}"],
        lambda: ["the", "dot", "on", "the"], lambda: [f"@{_name(rnd)}"], lambda: [f"{rnd.randint(256, 999)}.{rnd.randint(0, 99)}.{rnd.randint(0, 99)}.{rnd.randint(0, 99)}"],
        lambda: ["at", str(rnd.randint(1, 12)), "to", str(rnd.randint(13, 24))], lambda: [f"std::{_name(rnd)}"], lambda: [f"{rnd.randint(1, 99)}%"],
        lambda: [_number(rnd, 4) + "-" + _number(rnd, 4)], lambda: [f"§{rnd.randint(1, 99)}.{rnd.randint(1, 9)}"]))()


def labelled_rows(n: int = 900, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """``n`` rows (words, labels): personal data in its spellings, look-alikes, and words around them, drawn by rule."""
    rnd, rows = random.Random(seed), []
    for _ in range(n):
        words: list[str] = []
        labels: list[str] = []

        def add(new: list[str], kind: str = "", words: list[str] = words, labels: list[str] = labels) -> None:
            words += new
            labels += [("B-" if i == 0 else "I-") + kind if kind else "O" for i in range(len(new))]

        for _ in range(rnd.randint(1, 3)):
            add([_filler(rnd) for _ in range(rnd.choice((0, 0, 1, 2, 3, 4)))])
            if rnd.random() < 0.6:
                kind = rnd.choice(KINDS)
                before, data = _sample(rnd, kind)
                add(before)
                add([*data[:-1], data[-1] + rnd.choice(("",) * 5 + (".", ",", "!!", "###"))], kind)
            else:
                add(_decoy(rnd))
        add([_filler(rnd) for _ in range(rnd.randint(0, 4))])
        rows.append((words, labels))
    return rows


def labelled_table(spark: SparkSession, n: int = 900, seed: int = 11) -> DataFrame:
    return spark.createDataFrame(labelled_rows(n, seed), "words array<string>, labels array<string>")


def fit_table(labelled: DataFrame) -> Crf:
    """The field fitted on a labelled table (words, labels); at most MAX_LABELLED_ROWS rows of it, by smallest hash."""
    some = labelled.select("words", "labels", F.xxhash64("words").alias("h")).orderBy("h", "words", "labels").limit(MAX_LABELLED_ROWS)
    return fit([(r["words"], r["labels"]) for r in some.collect()])


# --- spans ----------------------------------------------------------------------------------

BRACKETED = re.compile(r"\s*[\[(]?\s*(?<![A-Za-z])(at|dot)(?![A-Za-z])\s*[\])]?\s*", re.IGNORECASE)


def _valid(kind: str, s: str) -> bool:
    """Whether the text reads as personal data of the kind."""
    digits = _digits(s)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15 and not (len(digits) >= 13 and luhn(digits))
    if kind == "ip":
        try:
            ipaddress.ip_address(s)
        except ValueError:
            return False
        return True
    plain = BRACKETED.sub(lambda m: "@" if m[1].lower() == "at" else ".", s)
    return list(_emails(plain)) == [(0, len(plain))]


def added_spans(text: str, words: list[tuple[int, int]], labels: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) of the labelled stretches of a chain that pass their kind's check."""
    t = 0
    while t < len(words):
        if not labels[t]:
            t += 1
            continue
        kind = (int(labels[t]) - 1) // 2
        end = t + 1
        while end < len(words) and labels[end] == 2 * kind + 2:
            end += 1
        start, stop = words[t][0], words[end - 1][1]
        while start < stop and text[start] in EDGES:
            start += 1
        while stop > start and text[stop - 1] in EDGES:
            stop -= 1
        if _valid(KINDS[kind], text[start:stop]):
            yield kind, start, stop
        t = end


def find_batch(texts: list[str], crf: Crf) -> list[tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]]:
    """Per text: the fixed patterns' spans and all spans, each one sorted list per kind."""
    base = [base_spans(t) for t in texts]
    found = [(i, c) for i, t in enumerate(texts) for c in chains(t)]
    spans = [[list(k) for k in b] for b in base]
    for (i, words), labels in zip(found, crf.decode([[texts[i][s:e] for s, e in c] for i, c in found]), strict=True):
        taken = sorted(s for k in spans[i] for s in k) if labels.any() else []
        for kind, start, stop in added_spans(texts[i], words, labels):
            at = bisect_right(taken, (stop,))
            if at and taken[at - 1][1] > start:
                continue  # it lies over another span
            spans[i][kind].append((start, stop))
            taken.insert(at, (start, stop))
    return [(b, [sorted(k) for k in s]) for b, s in zip(base, spans, strict=True)]


def written(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, of in zip(KINDS, spans, strict=True) for s, e in of)


@lru_cache(maxsize=2)
def _crf(payload: bytes) -> Crf:
    import pickle
    return Crf(*pickle.loads(payload))


def find_personal_data(docs: DataFrame, crf: Crf, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per input row, no shuffle.

    The counts and ``base_sha256`` are the fixed patterns'; ``spans`` has these and the
    field's own, which lie over none of them, as kind:start:end in code points, by kind and
    start.  A null or empty text has none.  Repeated rows and null ids are rows like any
    other; an empty table gives no rows.  Texts go through in batches of about a megabyte,
    a longer one alone; chains of a batch are decoded together.
    """
    import pickle
    payload = pickle.dumps((crf.features, crf.weights, crf.steps, crf.first))
    kind = docs.schema[doc].dataType.simpleString()
    names = ["doc", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def groups(column: pa.Array) -> Iterator[list[str]]:
        held, size = [], 0
        for t in column:
            held.append(t.as_py() or "")
            size += len(held[-1])
            if size >= 1 << 20:
                yield held
                held, size = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _crf(payload)
        for b in batches:
            rows = [(*map(len, base), hashlib.sha256(written(base).encode()).hexdigest(), written(spans))
                    for texts in groups(b.column(1)) for base, spans in find_batch(texts, model)]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = [*[pa.int64()] * 4, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names)

    return docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, f"doc {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string")
