"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Strict patterns give the base spans, which always stay. Wider generators propose
more spans, which may overlap. Boosted trees rate each candidate by its format and
by the text around it, and a candidate is added if its rating reaches the threshold
of its kind and nothing chosen before overlaps it. Thresholds are set on documents
the trees have not seen, so that nearly everything above them is right.

The trees are only asked about candidates apart from base spans, so base spans as they
stand teach them nothing. What is right they learn from base spans written in another
form (a card with dots, an address with "(at)"), from cue words before a candidate,
which are no features, and from made-up examples, the same for every table: so a
table with few or no secrets or phone numbers has a model of them too.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.llm.common import free_name, release, table
from revloom.session import written

KINDS = ["email", "ip", "card", "phone", "secret"]
# All candidates of a kind and label together weigh at most as much as so many made-up ones,
# so that rare kinds are not lost among others.
MOST_WEIGHT = 2_000
# Made-up examples of each kind and label.
MADE_UP = 120
TREES, DEPTH, RATE, BINS = 30, 3, 0.3, 16
# Weights are whole numbers of this unit, so sums are the same in any order. They stay
# below 2**53 for any number of candidates.
UNIT = 1 << 30
# Candidates that one task adds up.
TASK = 50_000
# Candidates whose features a worker holds as Python numbers at once, about 1 kB each:
# a table of numbers in a text has one in ten characters.
PIECE = 2_000
# Thresholds are multiples of one in so many.
STEPS = 1 << 12
# Share of right candidates above a threshold, and how many it must be seen on.
PRECISION, LEAST = 0.98, 20
# Threshold of a kind with fewer than LEAST right ones to measure it on.
FALLBACK = 0.9
WINDOW = 24

# Fixed values of the contract, written so that they never go back over digits.
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Wide generators of the method.
WIDE = {
    "email": re.compile(r"[^\s@<>\"']{1,64}+\s?(?:@|\(at\)|\[at\])\s?[^\s@<>\"']{3,255}"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]{4}){2,3}[0-9]{0,3}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+\x20?|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]\(?[0-9]{2,4}\)?){2,4}(?![0-9])"),
    "secret": re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{20,}+"),
}
ANY = re.compile(r"[0-9@]|\(at\)|\[at\]")
# What a secret is called where one is assigned; gives labels for training.
ASSIGNED = re.compile(r"(?:key|token|secret|password|passwd|credential)\w*[\"']?\s{0,3}[=:]\s{0,3}[\"']?\Z", re.I)

# Words that announce an address or a number. Labels only, never features.
CUES = {
    "email": re.compile(r"(?:mail|contact|kontakt|courriel|correo|write to)\W{0,3}(?:\w+\W{1,3}){0,2}\Z", re.I),
    "phone": re.compile(r"(?:tel|phone|fax|mobil|call|telefon|t[ée]l[ée]phone|appel|tel[ée]fono|llam)\w*\W{0,4}(?:\w+\W{1,3}){0,2}\Z", re.I),
}
DOMAIN = re.compile(r"[A-Za-z0-9-]\.[A-Za-z]{2,}\W*\Z")

RESULT = T.StructType(
    [T.StructField(c, T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))) for c in ("base", "added")]
)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches; each "@" belongs to the run before it."""
    last = 0
    for match in EMAIL_DOMAIN.finditer(text):
        start = at = match.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            yield start, match.end()
            last = match.end()


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start, in code points."""
    if not text or not ANY.search(text):
        return []
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(_byte(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def candidates(text: str | None) -> list[tuple[str, int, int]]:
    """Spans that the wide generators propose; they may overlap."""
    if not text or not ANY.search(text):
        return []
    return [(kind, m.start(), m.end()) for kind, pattern in WIDE.items() for m in pattern.finditer(text)]


def checked(span: str) -> bool:
    """Digits in the number and with the check digit of a card."""
    found = "".join(c for c in span if "0" <= c <= "9")
    return 13 <= len(found) <= 19 and luhn(found)


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of a candidate and of the text around it, as numbers."""
    span, before, after = text[start:end], text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    digits = sum(c.isdigit() for c in span)
    letters = sum(c.isalpha() for c in span)
    groups = re.split(r"\D+", span.strip())
    word = re.findall(r"[^\W\d_]+", before)[-1:]
    return [
        float(KINDS.index(kind)),
        float(len(span)),
        float(digits),
        float(letters),
        float(len(set(span))),
        float(len(groups)),
        float(max(map(len, groups))),
        float(min((len(g) for g in groups if g), default=0)),
        float(span.count(".")),
        float(span.count("-")),
        float(span.count(" ")),
        float(span.count("(") - span.count(")") == 0 and "(" in span),
        float(span[:1] == "+"),
        float(ord(span[0]) < 128 and span[0].isdigit()),
        float(sum(c in "0123456789abcdef" for c in span) / len(span)),
        float(max((int(g[:4]) for g in groups if g), default=0)),
        float(before[-1:] in ("=", ":", '"', "'")),
        float(before[-1:].isspace() or not before),
        float(after[:1] in ('"', "'")),
        float(after[:1].isspace() or not after),
        float("=" in before[-6:] or ":" in before[-6:]),
        float(sum(c.isdigit() for c in before + after)),
        float(len(word[0]) if word else 0),
        float(before.rstrip("=: \"'")[-5:].lower() in ("token", "t_key", "i_key", "ecret", "sword", "l_key")),
        float("@" in span),
        float(bool(DOMAIN.search(span))),
        float(sum(len(g) == 4 and g[:2] in ("19", "20") for g in groups)),
        float(span[:1] == "0" or span[:2] == "(0"),
        float(kind == "card" and checked(span)),
    ]


def label(text: str, kind: str, start: int, end: int, base: list[tuple[str, int, int]]) -> bool | None:
    """Training label of a candidate by what stands before it, or None if that does not tell.

    The model is never asked about what overlaps a base span; of these only phone
    numbers that are something else tell what a number is not.
    """
    over = {k for k, s, e in base if start < e and s < end}
    if over:
        return False if kind == "phone" and "phone" not in over else None
    before, span = text[max(0, start - 48) : start], text[start:end]
    if kind == "secret":
        return bool(ASSIGNED.search(before))
    if kind == "ip":
        return False  # the base pattern has all that are in range
    if kind == "card":
        return None if checked(span) else False
    if kind == "email":
        return bool(DOMAIN.search(span)) and (True if CUES["email"].search(before) else None)
    digits = sum("0" <= c <= "9" for c in span)
    if not 7 <= digits <= 15:
        return False
    return True if digits >= 9 and CUES["phone"].search(before) else None


def rewritten(kind: str, span: str, rng: random.Random) -> str | None:
    """A base span in a form that only the wide generators propose; None if there is none."""
    if kind == "email":
        return span.replace("@", rng.choice([" (at) ", " [at] ", " @ ", " (at)"]), 1)
    digits = re.sub("[^0-9]", "", span)
    if kind == "card" and len(digits) >= 16:
        return ".".join([digits[:4], digits[4:8], digits[8:12], digits[12:]])
    if kind == "phone":
        digits = digits[-10:]
        return _dialled(digits, rng)
    return None


def _dialled(digits: str, rng: random.Random) -> str:
    """Nine or ten digits as a phone number without "+"."""
    a, b, c = digits[:-7], digits[-7:-4], digits[-4:]
    mark = rng.choice("-. ")
    two = digits[-8:-6] + " " + digits[-6:-3] + " " + digits[-3:]
    return rng.choice(
        [f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}{mark}{b}{mark}{c}", f"1-{a}-{b}-{c}", f"00{rng.randint(1, 99)} {two}", f"0{a}/{b} {c}", f"0{a} {b} {c}"]
    )


def _where(text: str, kind: str, start: int, end: int) -> tuple[int, int] | None:
    """The candidate of the kind that covers most of a known span."""
    left = max(0, start - 80)
    for k, s, e in candidates(text[left : end + 80]):
        s, e = s + left, e + left
        if k == kind and min(e, end) - max(s, start) >= 0.8 * (end - start):
            return s, e
    return None


def other_forms(text: str, base: list[tuple[str, int, int]], seed: int) -> Iterator[list[float]]:
    """Features of the base spans of a text, each written in another form."""
    rng = random.Random(seed)
    for kind, start, end in base:
        form = rewritten(kind, text[start:end], rng)
        if form is not None:
            left = max(0, start - 200)
            near = text[left:start] + form + text[end : end + 200]
            at = _where(near, kind, start - left, start - left + len(form))
            if at:
                yield describe(near, kind, *at)


def made_up() -> list[tuple[list[float], bool]]:
    """(features, label) of invented candidates, the same in every run."""
    rng = random.Random(11)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    low, dec = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    word = lambda: some(low, rng.randint(2, 10))

    def card(right: bool, n: int) -> str:
        body = some(dec, n - 1)
        good = next(d for d in dec if luhn(body + d))
        return body + (good if right else rng.choice(dec.replace(good, "")))

    def fours(d: str, mark: str) -> str:
        return mark.join([d[:4], d[4:8], d[8:12], d[12:]])

    def long_run() -> str:
        letters = rng.choice(["0123456789abcdef", low + dec, low + low.upper() + dec, low + low.upper() + dec + "+/_-"])
        return some(letters, rng.randint(20, 64)) + rng.choice(dec)

    def right(kind: str) -> tuple[str, str, str]:
        if kind == "email":
            span = f"{word()}{rng.choice(['', '.', '_'])}{word()}@{word()}.{rng.choice(['com', 'org', 'net', 'de', 'fr', 'co.uk'])}"
            return "", rewritten(kind, span, rng), ""
        if kind == "card":
            return "", fours(card(True, rng.choice([16, 16, 16, 19])), "."), ""
        if kind == "phone":
            return "", _dialled(rng.choice("23456789") + some(dec, rng.choice([8, 9, 9, 9])), rng), ""
        mark = rng.choice(['"', "'", ""])
        name = rng.choice(["token", "api_key", "secret", "client_secret", "password", "access_token"])
        return f"{name}{rng.choice([' = ', '=', ': '])}{mark}", long_run(), mark

    def wrong(kind: str) -> tuple[str, str, str]:
        year = lambda: str(rng.randint(1900, 2099))
        two = lambda: f"{rng.randint(1, 31):02}"
        if kind == "email":
            price = f"{rng.randint(1, 99)}.{two()}"
            return "", rng.choice([f"{word()} @{word()}xy", f"{word()} (at) {word()}xy", f"{word()} @ {price}", f"{rng.randint(1, 99)} @ {price}", f"{word()} [at] {year()}"]), ""
        if kind == "ip":
            return "", ".".join(str(rng.randint(256, 999)) if i == 2 else str(rng.randint(0, 999)) for i in range(4)), ""
        if kind == "card":
            return "", fours(card(rng.random() < 0.2, 12) if rng.random() < 0.2 else card(False, 16), rng.choice(["", ".", ".", " ", "-"])).rstrip(". -"), ""
        if kind == "phone":
            three = lambda n: " ".join([str(rng.randint(1, 999)), *(some(dec, 3) for _ in range(n))])
            return "", rng.choice([
                f"{year()}-{two()}-{two()}", f"{two()}.{two()}.{year()}", f"{two()}/{two()}/{year()}", f"{year()}-{two()}-{two()} {two()}",
                f"{year()} {year()} {year()}", f"{year()}-{year()} {year()}-{year()}", f"{two()} {two()} {two()}", three(2), three(3), f"{rng.randint(1, 20)}.{two()}.{two()}",
                f"978-{rng.randint(0, 9)}{two()}-{two()}-{some(dec, 4)}",
            ]), ""
        return rng.choice(["", f"{word()}/", f"{word()} {word()} "]), rng.choice([f"{word()}-{word()}-{word()}-{word()}-{word()}-{year()}", f"{word()}_{word()}_{word()}_{year()}_{two()}_{word()}_v1", long_run()]), ""

    out = []
    for kind in KINDS:
        for make, y in ((right, True), (wrong, False)):
            if kind == "ip" and y:
                continue
            for _ in range(MADE_UP):
                before, span, after = make(kind)
                before = f"{word()} {word()} {before}"
                after += rng.choice([f" {word()} {word()}", f", {word()}", f"\n{word()}", "."])
                text = before + span + after
                at = _where(text, kind, len(before), len(before) + len(span))
                if at:
                    out.append((describe(text, kind, *at), y))
    return out


@dataclass
class Forest:
    """Boosted trees over numbers; a rating from 0 to 1 per row."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    prior: float = 0.0

    def rate(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        for column, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                right = x[np.arange(len(x)), column[node]] > cut[node]
                node = 2 * node + 1 + right
            total += value[node]
        return 0.5 * (1 + np.tanh(total / 2))


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """How many cuts of its column lie below each number."""
    return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1).astype(np.uint8)


@dataclass
class Stage:
    """Trees grown so far over binned rows, and the levels of the next one."""

    prior: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    column: np.ndarray
    bin: np.ndarray
    level: int

    def sums(self, bins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Pull and weight of rows by node of the level, column and bin, in ``UNIT``."""
        total = np.full(len(y), self.prior)
        for column, cut, value in self.trees:
            total += value[_followed(bins, column, cut, DEPTH)]
        p = 0.5 * (1 + np.tanh(total / 2))
        of_row = np.rint(weight * (y - p)), np.rint(weight * np.maximum(p * (1 - p), 1e-9))
        nodes = 2**self.level
        at = (_followed(bins, self.column, self.bin, self.level) - (nodes - 1)) * (BINS + 1)
        out = np.zeros((nodes, bins.shape[1], BINS + 1, 2))
        for c in range(bins.shape[1]):
            for i, values in enumerate(of_row):
                out[:, c, :, i] = np.bincount(at + bins[:, c], weights=values, minlength=nodes * (BINS + 1)).reshape(nodes, -1)
        return out


def _followed(bins: np.ndarray, column: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Node of each row after so many levels of a tree over bins."""
    node, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
    for _ in range(levels):
        node = 2 * node + 1 + (bins[rows, column[node]] > cut[node])
    return node


def grown(cuts: list[np.ndarray], share: float, sums: Callable[[Stage], np.ndarray]) -> Forest:
    """Complete trees of depth ``DEPTH``, split where the logistic loss gains most.

    ``share``: of the right ones. ``sums``: ``Stage.sums`` over all rows; once a level.
    """
    if share in (0, 1):
        return Forest([], 20.0 if share else -20.0)
    forest = Forest([], float(np.log(share / (1 - share))))
    inner, trees = 2**DEPTH - 1, []
    is_cut = np.arange(BINS)[None, :] < np.array([len(c) for c in cuts])[:, None]
    for _ in range(TREES):
        column, value = np.zeros(2 * inner + 1, dtype=np.int64), np.zeros(2 * inner + 1)
        cut, last = np.full(2 * inner + 1, np.inf), np.full(2 * inner + 1, BINS)
        for level in range(DEPTH):
            found = sums(Stage(forest.prior, trees, column, last, level)) / UNIT
            for k, of_node in enumerate(found, 2**level - 1):
                left = np.cumsum(of_node, axis=1)
                g, h = left[0, -1]
                gl, hl = left[:, :BINS, 0], left[:, :BINS, 1]
                gain = np.where(is_cut, gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1), -np.inf)
                c, at = np.unravel_index(int(np.argmax(gain)), gain.shape)
                if gain[c, at] > 1e-6:
                    column[k], last[k], cut[k] = c, at, cuts[c][at]
                    g_left, h_left = gl[c, at], hl[c, at]
                else:
                    g_left, h_left = g, h
                value[2 * k + 1] = RATE * g_left / (h_left + 1)
                value[2 * k + 2] = RATE * (g - g_left) / (h - h_left + 1)
        trees.append((column, last, value))
        forest.trees.append((column, cut, value))
    return forest


def boost(x: np.ndarray, y: np.ndarray) -> Forest:
    """``grown`` on rows at hand, all of one weight."""
    if not len(y):
        return Forest([], -20.0)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[:-1], method="lower")) for c in x.T]
    bins, weight = binned(x, cuts), np.full(len(y), float(UNIT))
    return grown(cuts, float(y.mean()), lambda stage: stage.sums(bins, y, weight))


def calibrated(ratings: np.ndarray, right: np.ndarray, weight: np.ndarray | None = None, seen: np.ndarray | None = None) -> float:
    """Lowest rating from which on the share of right ones is at least ``PRECISION``.

    Infinite if no rating has ``LEAST`` candidates above it that are. ``seen`` is how
    many candidates each stands for, ``weight`` how many it counts as in the share.
    """
    order = np.argsort(-ratings, kind="stable")
    weight = np.ones(len(ratings)) if weight is None else weight
    seen = np.ones(len(ratings)) if seen is None else seen
    share = np.cumsum((right * weight)[order]) / np.cumsum(weight[order])
    # Only the last of equal ratings is a place to cut.
    ends = np.append(ratings[order][1:] != ratings[order][:-1], True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero((share >= PRECISION) & ends & (np.cumsum(seen[order]) >= LEAST))
    return float(ratings[order][good[-1]]) if len(good) else float("inf")


def threshold(ratings: np.ndarray, right: np.ndarray, seen: np.ndarray) -> float:
    """``calibrated``, but ``FALLBACK`` where there are too few right ones to tell, and
    never below an even chance. The right ones, many of them rewritten or made up, count
    at most as much as the wrong ones together."""
    if (seen * right).sum() < LEAST:
        return FALLBACK
    most = (seen * (1 - right)).sum() / (seen * right).sum()
    return max(0.5, calibrated(ratings, right, np.where(right > 0, seen * min(1.0, most), seen), seen))


@dataclass
class Model:
    forest: Forest
    thresholds: dict[str, float]

    def __call__(self, text: str | None) -> tuple[list, list]:
        """(base spans, added spans), each by kind as listed, then start."""
        base = base_spans(text)
        proposed = [c for c in candidates(text) if not any(c[1] < e and s < c[2] for _, s, e in base)]
        if not proposed:
            return base, []
        ratings = np.concatenate(
            [self.forest.rate(np.array([describe(text, *c) for c in proposed[at : at + PIECE]])) for at in range(0, len(proposed), PIECE)]
        )
        added: list[tuple[str, int, int]] = []
        for i in np.argsort(-ratings, kind="stable"):
            kind, start, end = proposed[i]
            if ratings[i] >= self.thresholds[kind] and not any(start < e and s < end for _, s, e in added):
                added.append((kind, start, end))
        return base, sorted(added, key=lambda c: (KINDS.index(c[0]), c[1]))


def examples(order: int, text: str) -> Iterator[tuple[int, int, list[float], bool]]:
    """(order, n, x, y) of the candidates with a label in a text."""
    base = base_spans(text)
    for n, c in enumerate(candidates(text)):
        y = label(text, *c, base)
        if y is not None:
            yield order, n, describe(text, *c), y
    for n, x in enumerate(other_forms(text, base, int(order))):
        yield order, -1 - n, x, True


def described(texts: DataFrame, text: str) -> DataFrame:
    """(order, n, x, y) of the candidates with a label in all different texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for frame in frames for pair in zip(frame["order"], frame["text"], strict=True) for row in examples(*pair))
        while piece := list(islice(rows, PIECE)):
            yield pd.DataFrame(piece, columns=["order", "n", "x", "y"])
        release()

    hashed = texts.select(F.xxhash64(text).alias("order"), F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    # The hash and the number tell what is equal: features need not be compared.
    found = hashed.mapInPandas(run, "order long, n int, x array<double>, y boolean")
    return found.dropDuplicates(["order", "n"])


def weighted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``weight`` in ``UNIT``: one each, less where a kind and label have
    more than ``MOST_WEIGHT`` that are not made up."""
    group = [F.col("x")[0].alias("kind"), "y", "made"]
    full = F.when(F.col("made"), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.lit(float(MOST_WEIGHT)) / F.col("count")))
    of_group = rows.groupBy(*group).count().select("kind", "y", "made", F.rint(full * UNIT).cast("long").alias("weight"))
    # Ten kinds and labels at most, made up or not.
    return rows.join(F.broadcast(of_group), (F.col("x")[0] == F.col("kind")) & (rows["y"] == of_group["y"]) & (rows["made"] == of_group["made"])).select(
        rows["*"], "weight"
    )


def quantiles(rows: DataFrame) -> list[np.ndarray]:
    """The cuts of every column: ``BINS`` quantiles of the weight, each once."""
    values = rows.select("weight", F.posexplode("x").alias("column", "value")).groupBy("column", "value").agg(F.sum("weight").alias("weight"))
    up_to = F.sum("weight").over(W.partitionBy("column").orderBy("value"))
    every = F.sum("weight").over(W.partitionBy("column"))
    ranked = values.select("column", "value", "weight", up_to.alias("end"), every.alias("total"))
    # The first multiple of a quantile at or after the start of a value, if before its end.
    first = F.expr(f"(({BINS} * (end - weight) + total - 1) div total) * total")
    found = ranked.where(first < BINS * F.col("end")).select("column", "value").collect()
    columns = max(r["column"] for r in found) + 1
    return [np.array(sorted(r["value"] for r in found if r["column"] == c)) for c in range(columns)]


def forest_of(rows: DataFrame) -> Forest:
    """``grown`` on all ``rows`` (x, y, weight); each level is a sum over the tasks."""
    cuts = quantiles(rows)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                bins = binned(np.stack(frame["x"].to_list()), cuts)
                own = [bins.tobytes(), frame["y"].to_numpy(dtype=np.uint8).tobytes(), frame["weight"].to_numpy(dtype=np.int64).tobytes()]
                yield pd.DataFrame([own], columns=["bins", "y", "weight"])

    blocks = written(rows.select("x", "y", "weight").mapInPandas(run, "bins binary, y binary, weight binary"), "pii-binned")
    right, total, number = rows.agg(F.sum(F.when(F.col("y"), F.col("weight")).otherwise(0)), F.sum("weight"), F.count("*")).head()
    # A task does enough in each of the many sums.
    blocks = blocks.coalesce(-(-number // TASK)).rdd

    def sums(stage: Stage) -> np.ndarray:
        def add(known, row):
            y = np.frombuffer(row["y"], dtype=np.uint8)
            bins = np.frombuffer(row["bins"], dtype=np.uint8).reshape(len(y), -1)
            return known + stage.sums(bins, y.astype(float), np.frombuffer(row["weight"], dtype=np.int64).astype(float))

        return blocks.treeAggregate(np.zeros((2**stage.level, len(cuts), BINS + 1, 2)), add, np.add)

    return grown(cuts, right / total, sums)


def thresholds(rows: DataFrame, forest: Forest) -> dict[str, float]:
    """``threshold`` of each kind on all ``rows`` (x, y), in steps of one in ``STEPS``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.stack(frame["x"].to_list())
                step = np.floor(forest.rate(x) * STEPS).astype(np.int64)
                yield pd.DataFrame({"kind": x[:, 0].astype(np.int64), "step": step, "y": frame["y"]})

    found = rows.select("x", "y").mapInPandas(run, "kind long, step long, y boolean").groupBy("kind", "step", "y").count().collect()
    out = {}
    for i, kind in enumerate(KINDS):
        mine = sorted((r["step"], r["y"], r["count"]) for r in found if r["kind"] == i)
        step, right, seen = np.array(mine, dtype=float).reshape(-1, 3).T
        out[kind] = threshold(step / STEPS, right, seen)
    return out | {"ip": float("inf")}


def learn(texts: DataFrame, text: str = "text") -> Model:
    """Fit on the candidates of all texts, equal texts once, and the made-up examples.

    Half of the texts, by hash, grow the trees, the other half sets the thresholds; so
    do the made-up examples. All of a kind and label weigh at most ``MOST_WEIGHT`` for
    the trees; thresholds see them as they are. Without a text nothing is added.
    """
    if texts.where(F.col(text).rlike("[0-9@]")).isEmpty():
        return Model(Forest([], -20.0), dict.fromkeys(KINDS, float("inf")))
    found = described(texts, text).select("x", "y", (F.col("order") % 2 == 0).alias("grows"), F.lit(False).alias("made"))
    invented = [(x, y, i % 2 == 0, True) for i, (x, y) in enumerate(made_up())]
    extra = texts.sparkSession.createDataFrame(invented, "x array<double>, y boolean, grows boolean, made boolean")
    rows = written(found.unionByName(extra.coalesce(1)), "pii-candidates")
    grows = written(weighted(rows).where("grows"), "pii-growing")
    forest = forest_of(grows)
    return Model(forest, thresholds(rows.where("not grows"), forest))


def find(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``base`` and ``added``: arrays of (kind, start, end), in code points, end
    exclusive. A null text counts as empty. Taken names get underscores."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([shared.value(t) for t in part], columns=["base", "added"])
        release()

    run = F.pandas_udf(run, RESULT)
    found = free_name(df, "found")
    whole = df.withColumn(found, run(F.col(text)))
    return whole.select(*df.columns, *[F.col(f"{found}.{c}").alias(free_name(df, c)) for c in ("base", "added")])


def redact(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind in brackets."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([replaced(t, shared.value) for t in texts], dtype=object)

    return df.withColumn(text, F.pandas_udf(run, T.StringType())(F.col(text)))


def replaced(text: str | None, model: Model) -> str | None:
    if text is None:
        return None
    out, to = [], 0
    base, added = model(text)
    for kind, start, end in sorted([*base, *added], key=lambda c: (c[1], -c[2])):
        if end > to:
            out += [text[to:start], f"[{kind}]"] if start >= to else []
            to = end
    return "".join([*out, text[to:]])


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, learn(docs)).drop("text")
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    order = F.array(*[F.lit(k) for k in KINDS])
    every = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(F.array_position(order, s.kind).alias("rank"), s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind")),
        )
    )
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")
    counts = [of_kind(k).alias(f"n_{k}") for k in KINDS[:4]]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(shown(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        shown(every).alias("spans"),
    )


QUERIES = {"op2_pii": op2_pii}
ORACLE: dict[str, str] = {}
