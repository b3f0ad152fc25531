"""Personal data: fixed patterns, and spans that a semi-Markov CRF adds.

Base spans are the leftmost non-overlapping matches of four patterns (email, ip,
card, phone), found by anchored scans that are linear in the text.

The semi-Markov conditional random field (Sarawagi & Cohen 2004) scores whole
candidate spans: its features look at the span as a whole (number of digits, Luhn
sum, parts, separators, what stands on either side), which a token model cannot.
A region is a run of white-space separated words that each hold a digit or @, since a
candidate must hold one. In a region, dynamic programming over segments of at most
MAX_ATOMS atoms (words and single symbols) chooses boundaries and types jointly;
atoms outside any entity are segments of type "none". Outside regions every
segmentation has the same score, so decoding the regions decodes the whole text.

The field is trained here on a bounded sample of the corpus's regions, labelled by
the base spans (weak supervision), and on copies with another notation (no country
code, other separators) plus look-alikes that are not personal (dates, versions,
prices, hashes, numbers that fail the checks).
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 16
SAMPLE = 1500  # documents whose regions train the field
EPOCHS, RATE = 12, 0.1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+")
_WORD = re.compile(r"[^\s]+")
_ATOM = re.compile(r"\w+|[^\w\s]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four patterns; failing matches are dropped without a retry."""
    spans, at, stop = [], text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > stop and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at) if begin < at else None
        if match:
            stop = match.end()
            spans.append((begin, stop, "email"))
        stop = max(stop, at + 1)  # the local part never holds an @
        at = text.find("@", stop)
    if _DIGIT.search(text) is None:
        return spans
    for chain in _NUMBERS.finditer(text):
        parts = list(re.finditer("[0-9]+", chain.group())) if chain.group().count(".") >= 3 else []
        for i in range(0, len(parts) - 3, 4):
            if all(_byte(p.group()) for p in parts[i:i + 4]):
                spans.append((chain.start() + parts[i].start(), chain.start() + parts[i + 3].end(), "ip"))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((match.start(), match.end(), "card"))
    stop, at = 0, text.find("+")
    while at >= 0:
        match = _PHONE.match(text, at)
        if match:
            body = match.group()
            end = max(body.rfind(d) for d in "0123456789") + 1
            # + digit, at least one character of the class, then a digit
            if end >= 4:
                if 10 <= sum(c.isdigit() for c in body[:end]) <= 15:
                    spans.append((at, at + end, "phone"))
                stop = at + end
        at = text.find("+", max(stop, at + 1))
    return spans


def _byte(digits: str) -> bool:
    """Whether the number is at most 255; digits may be any number of zeros first."""
    own = digits.lstrip("0")
    return len(own) <= 3 and int(own or "0") <= 255


def regions(text: str) -> list[tuple[int, int]]:
    """Runs of words that each hold a digit or @, at most GAP white-space characters of any kind apart."""
    out = []
    at = 0
    while True:
        hit = _SEED.search(text, at)
        if hit is None:
            return out
        begin = hit.start()
        while begin > at and not text[begin - 1].isspace():
            begin -= 1
        end = _WORD.match(text, begin).end()
        at = end
        if out and begin - out[-1][1] <= GAP and text[out[-1][1]:begin].isspace():
            out[-1] = (out[-1][0], end)
        else:
            out.append((begin, end))


GAP = 3
_SEED = re.compile(r"[0-9@]")
FEATURES = 30


def features(text: str, begin: int, end: int) -> list[int]:
    """Indices of the whole-span features that hold for ``text[begin:end]``."""
    span = text[begin:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    n = len(digits)
    letters = any(c.isalpha() for c in span)
    parts = re.split(r"[^0-9]+", span.strip("+()"))
    before, after = text[begin - 1:begin], text[end:end + 1]
    # a word or number goes on beyond the span, at once or after a joining sign
    continues_before = before.isalnum() or before in ("_", "+", "@") or (begin > 1 and before in (".", "-", "%") and text[begin - 2].isalnum())
    continues_after = after.isalnum() or after in ("_", "@") or (after in (".", "-") and text[end + 1:end + 2].isalnum())
    shape = re.sub(r"[0-9]+", "9", re.sub(r"\w*[^\W0-9_]\w*", "a", span))
    checks = (
        True,
        n < 7, 7 <= n <= 9, 10 <= n <= 13, 14 <= n <= 19, n > 19,
        14 <= n <= 19 and luhn(digits),
        14 <= n <= 19 and not letters and not luhn(digits),
        span.count("@") == 1 and bool(re.fullmatch(r"[\w.%+-]+@[\w-]+(\.[\w-]+)+", span)),
        "@" in span and not re.fullmatch(r"[\w.%+-]+@[\w-]+(\.[\w-]+)+", span),
        letters, letters and "@" not in span,
        bool(re.fullmatch(r"9\.9\.9\.9", shape)),
        bool(re.fullmatch(r"9\.9\.9\.9", shape)) and all(len(p) <= 3 and _byte(p) for p in parts),
        bool(re.fullmatch(r"9\.9\.9\.9", shape)) and not all(len(p) <= 3 and _byte(p) for p in parts),
        span.startswith("+"), "(" in span and ")" in span, span.count("(") != span.count(")"),
        "-" in span and not letters, " " in span, "." in span and "@" not in span,
        any(c in span for c in "/:,;=$%&#*\"'!?|<>_"),
        bool(re.fullmatch(r"\+9( ?\(?9\)?)?([ .-]9){1,4}", shape)),
        bool(re.fullmatch(r"\(9\) ?9([ .-]9)+", shape)),
        bool(re.fullmatch(r"9([ .-]9){2,3}", shape)) and 10 <= n <= 13 and max(map(len, parts)) <= 4,
        bool(re.fullmatch(r"9([ -]9){3,4}", shape)) and 14 <= n <= 19,
        continues_before, continues_after,
        not continues_before and before in ("", " ", "\n", "(", "\"", "<", ":"),
        not continues_after and after in ("", " ", "\n", ".", ",", ")", "\"", ">"),
    )
    return [i for i, holds in enumerate(checks) if holds]


def segments(text: str, begin: int, end: int):
    """Atoms of a region and its candidates: (first atom, last atom + 1, features)."""
    atoms = [(m.start(), m.end()) for m in _ATOM.finditer(text, begin, end)]
    candidates = []
    for i, (start, _) in enumerate(atoms):
        if not (text[start].isalnum() or text[start] in "+("):
            continue
        for j in range(i, min(i + MAX_ATOMS, len(atoms))):
            stop = atoms[j][1]
            if text[stop - 1].isalnum() and _SEED.search(text, start, stop) and stop - start <= 320:
                candidates.append((i, j + 1, features(text, start, stop)))
    return atoms, candidates


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + float(np.log(sum(np.exp(v - top) for v in values)))


class SemiMarkovCRF:
    """weights[f, k]: weight of feature f for kind k; "none" atoms weigh 0."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = np.zeros((FEATURES, len(KINDS))) if weights is None else weights

    def _scores(self, candidates) -> np.ndarray:
        return np.array([self.weights[f].sum(0) for *_, f in candidates]) if candidates else np.zeros((0, len(KINDS)))

    def decode(self, text: str, begin: int, end: int) -> list[tuple[int, int, str]]:
        """Spans of the best segmentation of a region."""
        atoms, candidates = segments(text, begin, end)
        scores = self._scores(candidates)
        ending: dict[int, list[int]] = {}
        for c, (_, j, _) in enumerate(candidates):
            ending.setdefault(j, []).append(c)
        best, back = [0.0] * (len(atoms) + 1), [None] * (len(atoms) + 1)
        for j in range(1, len(atoms) + 1):
            best[j], back[j] = best[j - 1], None
            for c in ending.get(j, ()):
                k = int(scores[c].argmax())
                value = best[candidates[c][0]] + scores[c, k]
                if value > best[j]:
                    best[j], back[j] = value, (candidates[c][0], k)
        spans, j = [], len(atoms)
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, k = back[j]
                spans.append((atoms[i][0], atoms[j - 1][1], KINDS[k]))
                j = i
        return spans[::-1]

    def gradient(self, atoms, candidates, gold: dict, grad: np.ndarray) -> float:
        """Adds observed minus expected features; returns the log-likelihood of ``gold`` {(i, j): kind}."""
        if not candidates:
            return 0.0
        n, scores = len(atoms), self._scores(candidates)
        starting, ending = {}, {}
        for c, (i, j, _) in enumerate(candidates):
            starting.setdefault(i, []).append(c)
            ending.setdefault(j, []).append(c)
        total = np.logaddexp.reduce(scores, axis=1)  # over kinds
        forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            forward[j] = _log_sum([forward[j - 1], *(forward[candidates[c][0]] + total[c] for c in ending.get(j, ()))])
        for i in range(n - 1, -1, -1):
            backward[i] = _log_sum([backward[i + 1], *(backward[candidates[c][1]] + total[c] for c in starting.get(i, ()))])
        observed = 0.0
        for c, (i, j, f) in enumerate(candidates):
            part = np.exp(forward[i] + backward[j] - forward[n] + scores[c])
            grad[f] -= part
            kind = gold.get((i, j))
            if kind is not None:
                grad[f, KINDS.index(kind)] += 1
                observed += scores[c, KINDS.index(kind)]
        return observed - forward[n]

    def fit(self, examples: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = EPOCHS, seed: int = 3):
        """``examples``: texts and their spans. AdaGrad on the penalised log-likelihood."""
        lattices = []
        for text, spans in examples:
            for begin, end in regions(text):
                atoms, candidates = segments(text, begin, end)
                first = {a[0]: i for i, a in enumerate(atoms)}
                last = {a[1]: i + 1 for i, a in enumerate(atoms)}
                gold = {(first[s], last[e]): kind for s, e, kind in spans if s in first and e in last}
                lattices.append((atoms, candidates, gold))
        rng, squares = np.random.default_rng(seed), np.full_like(self.weights, 1e-6)
        for _ in range(epochs):
            order = rng.permutation(len(lattices))
            for lo in range(0, len(order), 16):
                grad = -1e-3 * self.weights
                for i in order[lo:lo + 16]:
                    self.gradient(*lattices[i], grad)
                squares += grad * grad
                self.weights = self.weights + RATE * 4 * grad / np.sqrt(squares)
        return self


def _region_texts(texts: list[str], per_kind: int = 400) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Training examples: each region of the sample with a little of its surroundings."""
    out, seen = [], dict.fromkeys((*KINDS, "none"), 0)
    for text in texts:
        spans = base_spans(text)
        for begin, end in regions(text):
            if end - begin > 200:
                continue
            own = [(s, e, k) for s, e, k in spans if begin <= s and e <= end]
            own = [x for x in own if not any(y is not x and y[0] <= x[0] and x[1] <= y[1] for y in own)]
            kind = own[0][2] if own else "none"
            if seen[kind] < per_kind:
                seen[kind] += 1
                lo = max(0, begin - 20)
                out.append((text[lo:end + 20], [(s - lo, e - lo, k) for s, e, k in own]))
    return out


def _variants(rng: np.random.Generator, n: int = 120) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Other notations of the four kinds, and look-alikes that are none of them."""
    digits = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    words = ("call", "see", "and", "from", "item", "the", "mail", "at")
    word = lambda: words[rng.integers(len(words))]

    def card():
        body = str(rng.integers(3, 7)) + digits(14)
        number = next(body + d for d in "0123456789" if luhn(body + d))
        return number if rng.random() < 0.5 else "-".join(number[i:i + 4] for i in range(0, 16, 4))

    hexes = lambda: "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, 32))
    part = lambda: str(rng.integers(0, 256))
    sep = lambda: " -."[rng.integers(3)]
    made = {
        "phone": [lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", lambda: (lambda s: digits(3) + s + digits(3) + s + digits(4))(sep()),
                  lambda: f"+{rng.integers(1, 99)} {digits(3)} {digits(3)} {digits(4)}"],
        "email": [lambda: f"{word()}.{digits(2)}@{word()}{rng.integers(9)}.example.org", lambda: f"{word()}@{word()}.com"],
        "ip": [lambda: ".".join(part() for _ in range(4))],
        "card": [card],
        None: [lambda: f"{rng.integers(1900, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", lambda: f"{rng.integers(1, 9)}.{rng.integers(20)}",
               lambda: f"v{rng.integers(9)}.{rng.integers(20)}.{rng.integers(20)}", lambda: f"${rng.integers(10, 9999)}.99",
               lambda: f'token = "{hexes()}"', lambda: hexes(), lambda: digits(rng.integers(1, 9)), lambda: digits(rng.integers(20, 40)),
               lambda: f"{rng.integers(256, 999)}.{part()}.{part()}.{part()}", lambda: f"{rng.integers(10, 23)}:{rng.integers(10, 59)}",
               lambda: f"{word()}@{word()}", lambda: digits(16) if rng.random() < 0.5 else digits(17), lambda: f"{digits(3)} {digits(2)}",
               lambda: f"{word()}{digits(2)}", lambda: f"{part()}.{part()}.{part()}.{part()}.{part()}"]}
    out = []
    for kind, makers in made.items():
        for make in makers:
            for _ in range(n // len(makers) if kind else n // 4):
                left, middle, right = word() + " ", make(), " " + word() + "."
                own = [(len(left), len(left) + len(middle), kind)] if kind else []
                if kind is None:
                    own = [(s, e, k) for s, e, k in base_spans(left + middle + right) if k == "card"]
                out.append((left + middle + right, own))
    return out


def fit_field(docs: DataFrame, size: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> SemiMarkovCRF:
    """The field trained on the regions of at most ``size`` documents, chosen by a hash.

    Repeated rows count once; an empty table trains it on the made-up notations alone.
    """
    hashed = docs.where(F.col(text_col).rlike("[0-9@]")).select(F.col(text_col).alias("t"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    # the hashes first: a limit over rows with texts would send each task's own choice of texts to the driver
    least = [r.h for r in hashed.select("h").distinct().orderBy("h").limit(size).collect()]
    rows = hashed.where(F.col("h") <= least[-1]).dropDuplicates(["h"]).orderBy("h").collect() if least else []
    return SemiMarkovCRF().fit(_region_texts([r["t"] for r in rows]) + _variants(np.random.default_rng(17)))


def find(text: str | None, field: SemiMarkovCRF) -> list[tuple[int, int, str, bool]]:
    """(start, end, kind, base) by start, then kind in the order of KINDS.

    Spans of the field that touch a base span are left out: base ones stay as they are.
    """
    if not text:
        return []
    base = base_spans(text)
    spans = [(s, e, k, True) for s, e, k in base]
    if _SEED.search(text):
        taken: list[list[int]] = []  # the base spans' union, in order
        for s, e, _ in sorted(base):
            if taken and s < taken[-1][1]:
                taken[-1][1] = max(taken[-1][1], e)
            else:
                taken.append([s, e])
        ends = [y for _, y in taken]
        for begin, end in regions(text):
            for s, e, k in field.decode(text, begin, end):
                i = bisect_right(ends, s)  # the first that ends beyond the start
                if i == len(taken) or taken[i][0] >= e:
                    spans.append((s, e, k, False))
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


SPANS = "array<struct<start:long,end:long,kind:string,base:boolean>>"


def spans_column(field: SemiMarkovCRF, text: Column) -> Column:
    """Spans of a string column as SPANS (code points, end exclusive); null and empty texts have none."""
    weights = field.weights

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        crf = SemiMarkovCRF(weights)
        return pd.Series([[{"start": s, "end": e, "kind": k, "base": b} for s, e, k, b in find(t, crf)] for t in texts], dtype=object)

    return spans(text)


def redacted_column(field: SemiMarkovCRF, text: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans
    become one bracket of the first span's kind. Null stays null."""
    weights = field.weights

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        crf, out = SemiMarkovCRF(weights), []
        for text in texts:
            merged: list[list] = []
            for s, e, k, _ in find(text, crf):
                if merged and s < merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e, k])
            if merged:
                parts, at = [], 0
                for s, e, k in merged:
                    parts += [text[at:s], f"[{k.upper()}]"]
                    at = e
                text = "".join(parts) + text[at:]
            out.append(text)
        return pd.Series(out, dtype=object)

    return redact(text)
