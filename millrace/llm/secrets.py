"""Secret scan: patterns, and a battery of randomness tests under false-discovery control."""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import code_points, map_batches, settle, texts

ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
#: Kinds in the order that breaks ties between spans.
KINDS = ("assign", "access", "hex", "random")

#: Shortest and longest run that the battery judges as one token; longer runs are judged in parts.
MIN_LENGTH, MAX_LENGTH = 16, 512
_TOKEN = re.compile(rb"([A-Za-z0-9+/_-]{%d,%d})(?:={1,2}(?![A-Za-z0-9+/_=-]))?" % (MIN_LENGTH, MAX_LENGTH))
#: Signs of base64, of base64url, and of either.
_SIGNS = tuple(re.compile(x) for x in (rb"[+/]+", rb"[_-]+", rb"[+/_-]+"))
_ONE_CLASS = re.compile(rb"[a-z+/_-]*|[A-Z+/_-]*")
_KEYWORDS = (b"passw", b"secret", b"token", b"api")

#: Share in percent of the letters a-z in ordinary prose.
LETTER_SHARES = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4,
                 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
#: In a written identifier, the chance that two neighbours differ in class (lower, upper, digit, sign).
CLASS_CHANGE = 0.2

_LOWER, _UPPER, _DIGIT = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
#: Encodings, narrowest first: a token has the first one whose alphabet holds all of its characters.
ENCODINGS = {
    "hex": b"0123456789abcdef",
    "HEX": b"0123456789ABCDEF",
    "base32": _UPPER + b"234567",
    "lower36": _LOWER + _DIGIT,
    "upper36": _UPPER + _DIGIT,
    "base62": _UPPER + _LOWER + _DIGIT,
    "base64": _UPPER + _LOWER + _DIGIT + b"+/",
    "base64url": _UPPER + _LOWER + _DIGIT + b"-_",
    "lower": _LOWER,
    "upper": _UPPER,
}
_SINGLE = {0b0010: list(ENCODINGS).index("lower"), 0b0100: list(ENCODINGS).index("upper")}
#: Upper ends of the length classes, each with its own weight in the false-discovery control.
LENGTHS = (20, 24, 32, 48, MAX_LENGTH)
#: p values are rounded up to these steps of -log10.
STEP, STEPS = 0.05, 1200
#: Only p values under this are kept one by one; the others count towards the number of tests.
KEEP = 0.05


def _tail(z: np.ndarray) -> np.ndarray:
    """P(Z > z) of a standard normal."""
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z])


def _parts(data: bytes, sign: re.Pattern, start: int, end: int) -> list[tuple[int, int]]:
    out, at = [], start
    for m in sign.finditer(data, start, end):
        out.append((at, m.start()))
        at = m.end()
    return [*out, (at, end)]


def tokens_of(data: bytes) -> list[tuple[int, int, int]]:
    """(start, end, end with padding) of the tokens of a text, in order.

    Runs are parted at "=", which counts as padding only at a run's end.  A run with signs of base64 and of
    base64url is parted at those of one of them: at those that leave the longest part.  Letters of one class
    with signs between them are parted at every sign.
    """
    out = []
    for m in _TOKEN.finditer(data):
        (start, end), token = m.span(1), m[1]
        std, url = b"+" in token or b"/" in token, b"-" in token or b"_" in token
        if (std or url) and _ONE_CLASS.fullmatch(token):
            parts = _parts(data, _SIGNS[2], start, end)
        elif std and url:
            parts = max((_parts(data, sign, start, end) for sign in _SIGNS[:2]), key=lambda x: max(b - a for a, b in x))
        else:
            parts = [(start, end)]
        out += [(a, b, m.end() if b == end else b) for a, b in parts if b - a >= MIN_LENGTH]
    return out


class Battery:
    """The tests of one token, for arrays of tokens.

    Against chance: the chi-squared distance of its characters from uniformity over the inferred
    alphabet, the number of class runs, and the serial correlation of neighbouring codes; their p
    values combined (Fisher) must not speak against a random string.  Against prose: the same chi-squared
    and runs figures, under letter shares and class changes of ordinary text, give the p value that
    goes into the false-discovery control.  It falls with length by itself.

    Letters of one class have no class runs.  Chi-squared and serial correlation are tested against chance;
    against prose, the likelihood ratio of uniform letters to letter shares, which uses which letters are
    frequent and not only how unevenly they are spread.
    """

    def __init__(self):
        names = list(ENCODINGS)
        self.codes = np.full((len(names), 256), -1, np.int64)
        self.classes = np.zeros(256, np.int64)
        for i, members in enumerate((_LOWER, _UPPER, _DIGIT)):
            self.classes[list(members)] = i + 1
        self.fits = np.zeros(256, np.int64)
        self.ratio = np.zeros((len(names), 256))
        self.size, self.prose, self.change, self.ratios = [], [], [], []
        for e, name in enumerate(names):
            alphabet = ENCODINGS[name]
            self.codes[e, list(alphabet)] = np.arange(len(alphabet))
            self.fits[list(alphabet)] |= 1 << e
            share = np.array([LETTER_SHARES[c - 97] if 97 <= c < 123 else LETTER_SHARES[c - 65] * 0.15
                              if 65 <= c < 91 else 1.0 for c in alphabet])
            if not any(97 <= c < 123 for c in alphabet):
                share = np.array([LETTER_SHARES[c - 65] if 65 <= c < 91 else 1.0 for c in alphabet])
            share /= share.sum()
            kinds = np.bincount(self.classes[list(alphabet)], minlength=4) / len(alphabet)
            ratio = -np.log(share * len(alphabet))
            self.ratio[e, list(alphabet)] = ratio
            self.ratios.append((ratio.mean(), ratio @ share, math.sqrt(max(ratio ** 2 @ share - (ratio @ share) ** 2, 1e-12))))
            self.size.append(len(alphabet))
            self.prose.append((share ** 2, share ** 3))
            self.change.append(1 - (kinds ** 2).sum())
        self.size, self.change = np.array(self.size), np.array(self.change)
        self.two = np.array([x.sum() for x, _ in self.prose])
        self.three = np.array([x.sum() for _, x in self.prose])
        #: of the log of the ratio at one letter: mean if uniform, mean and deviation in prose
        self.ratios = np.array(self.ratios)

    def z_random(self, e: int, m: float) -> float:
        """Figure against prose that a random token of ``m`` characters has on average."""
        if self.change[e] == 0:
            uniform, mean, spread = self.ratios[e]
            return (uniform - mean) * math.sqrt(m) / (1.4 * spread)
        k, two, three = self.size[e], self.two[e], self.three[e]
        spread = (k / m) * math.sqrt(4 * m ** 3 * (three - two ** 2) + 2 * m ** 2 * two ** 2)
        z_chi = (k * ((1 - two) + m * two) - m - (k - 1)) / (1.4 * spread)
        z_runs = (m - 1) * (self.change[e] - CLASS_CHANGE) / math.sqrt((m - 1) * CLASS_CHANGE * (1 - CLASS_CHANGE))
        return (z_chi + z_runs) / math.sqrt(2)

    def __call__(self, data: bytes, starts: np.ndarray, ends: np.ndarray):
        """Encoding, step of -log10 p against prose, and whether chance may have made it.
        Numbers, and letters of one class with signs, have encoding -1: digits are as even in numbers as
        in random strings."""
        raw = np.frombuffer(data, np.uint8)
        n = ends - starts
        token = np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
        chars = raw[at]
        first = np.cumsum(n) - n
        fits = np.bitwise_and.reduceat(self.fits[chars], first)
        kinds = np.bitwise_or.reduceat(1 << self.classes[chars], first)
        kinds &= 0b1110
        mixed = (kinds & (kinds - 1)) != 0
        encoding = np.where(mixed & (fits != 0), np.log2(np.maximum(fits & -fits, 1)).astype(np.int64), -1)
        plain = np.bitwise_or.reduceat((self.classes[chars] == 0).astype(np.int64), first) == 0
        single = np.zeros(len(n), bool)
        for kind, name in _SINGLE.items():
            encoding[(kinds == kind) & plain] = name
            single |= (kinds == kind) & plain
        e = np.maximum(encoding, 0)
        codes = self.codes[e[token], chars]
        k, m = self.size[e].astype(float), n.astype(float)
        seen, counts = np.unique(token * 64 + np.maximum(codes, 0), return_counts=True)
        squares = np.bincount(seen // 64, weights=counts.astype(float) ** 2, minlength=len(n))
        chi = squares * k / m - m
        inner = np.flatnonzero(np.diff(token, prepend=-1) == 0)
        changes = np.bincount(token[inner], weights=(self.classes[chars[inner]] != self.classes[chars[inner - 1]]),
                              minlength=len(n))
        centred = codes - (k[token] - 1) / 2
        serial = np.bincount(token[inner], weights=centred[inner] * centred[inner - 1], minlength=len(n))
        serial /= np.sqrt(m - 1) * (k * k - 1) / 12
        # against chance
        p_chi = _tail(((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / np.sqrt(2 / (9 * (k - 1))))
        q = np.where(single, 0.5, self.change[e])
        p_runs = 2 * _tail(np.abs(changes - (m - 1) * q) / np.sqrt((m - 1) * q * (1 - q) * 1.5))
        p_serial = 2 * _tail(np.abs(serial))
        p_runs[single] = 1
        half = -sum(np.log(np.maximum(x, 1e-300)) for x in (p_chi, p_runs, p_serial))
        chance = np.exp(-half) * (1 + half + np.where(single, 0, half ** 2 / 2))
        # against prose
        two, three = self.two[e], self.three[e]
        mean = k * ((1 - two) + m * two) - m
        spread = (k / m) * np.sqrt(np.maximum(4 * m ** 3 * (three - two ** 2) + 2 * m ** 2 * two ** 2, 1))
        z_chi = (mean - chi) / (1.4 * spread)
        z_runs = (changes - (m - 1) * CLASS_CHANGE) / np.sqrt((m - 1) * CLASS_CHANGE * (1 - CLASS_CHANGE))
        _, usual, deviation = self.ratios[e].T
        ratio = np.bincount(token, weights=self.ratio[e[token], chars], minlength=len(n))
        z_ratio = (ratio - m * usual) / (1.4 * deviation * np.sqrt(m))
        p = _tail(np.where(single, z_ratio, (z_chi + z_runs) / math.sqrt(2)))
        steps = np.minimum(np.floor(-np.log10(np.maximum(p, 1e-300)) / STEP), STEPS).astype(np.int64)
        return encoding, steps, chance >= 0.001


def base_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the pattern matches, sorted."""
    low = data.lower()
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(data) if len(m[1]) >= 6] \
        if any(word in low for word in _KEYWORDS) else []
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data)]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(data)])


def _points(data: bytes, spans: list[tuple]) -> list[tuple]:
    """The same spans, sorted by start, in code points."""
    if not spans or data.isascii():
        return spans
    where, at, points = {}, 0, 0
    for edge in sorted({x for span in spans for x in (span[0], span[2])}):
        points += code_points(data[at:edge])
        where[edge], at = points, edge
    return [(where[s[0]], s[1], where[s[2]], *s[3:]) for s in spans]


def weights(tests: dict[tuple[int, int], int], battery: Battery) -> dict[tuple[int, int], float]:
    """Weight of each (encoding, length class): the power of the test at that length, scaled to a
    mean of 1 over the tests of an encoding."""
    power = {}
    for e, c in tests:
        power[e, c] = max(0.05, 0.5 * math.erfc((3 - battery.z_random(e, float([MIN_LENGTH, *LENGTHS][c]))) / math.sqrt(2)))
    out = {}
    for e in {e for e, _ in tests}:
        total = sum(n for (x, _), n in tests.items() if x == e)
        scale = total / sum(n * power[x, c] for (x, c), n in tests.items() if x == e)
        out |= {(x, c): power[x, c] * scale for x, c in tests if x == e}
    return out


def cuts(tests: dict[tuple[int, int], int], steps: dict[tuple[int, int, int], int], rate: float,
         battery: Battery) -> dict[tuple[int, int], int]:
    """Least step that is a discovery, by encoding and length class: weighted Benjamini-Hochberg on
    p values rounded up, separately for each encoding."""
    weight, out = weights(tests, battery), {}
    for e in {e for e, _ in tests}:
        total = sum(n for (x, _), n in tests.items() if x == e)
        found = sorted((10 ** (-STEP * s) / weight[x, c], n) for (x, c, s), n in steps.items() if x == e)
        limit, seen = 0.0, 0
        for p, n in found:
            seen += n
            if p * total <= rate * seen:
                limit = p
        for x, c in tests:
            if x == e:
                out[e, c] = next((s for s in range(STEPS + 1) if 10 ** (-STEP * s) / weight[x, c] <= limit), STEPS + 1)
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01) -> DataFrame:
    """Spans of secrets in every text: doc_id, base spans, and the spans of random tokens.

    ``base``: array of (start, kind, end) by start, then kind: leftmost matches of the patterns.
    ``added``: the same for tokens of 16 or more characters that the battery finds random, none of which
    overlaps a base span; ``rate`` is the false-discovery rate over all tokens of all texts, held for
    each encoding, with weights for length.  Places are code points, ends exclusive.  A null text has
    no spans; repeated rows are scanned one by one; an empty table gives no rows.

    The p values of all texts meet in counts by encoding, length class and step: a bounded table, whatever
    the input.  The scan is kept in the shared folder, so texts are read once.
    """
    def make():
        battery = Battery()

        def scan(batch):
            out = {"doc_id": batch["doc_id"], "base": [], "tests": [], "kept": []}
            for data in batch["text"]:
                base = base_spans(data)
                tokens = tokens_of(data)
                tests, kept = {}, []
                if tokens:
                    starts, ends, _ = np.array(tokens).T
                    encoding, steps, chance = battery(data, starts, ends)
                    lengths = np.searchsorted(LENGTHS, ends - starts)
                    for i in np.flatnonzero(encoding >= 0):
                        key = (int(encoding[i]), int(lengths[i]))
                        tests[key] = tests.get(key, 0) + 1
                        if chance[i] and steps[i] * STEP >= -math.log10(KEEP):
                            s, _, t = tokens[i]
                            if not any(a < t and s < b for a, _, b in base):
                                kept.append((s, 3, t, *key, int(steps[i])))
                out["base"].append([dict(start=a, kind=k, end=b) for a, k, b in _points(data, base)])
                out["tests"].append([dict(encoding=e, length=c, n=n) for (e, c), n in tests.items()])
                out["kept"].append([dict(start=a, kind=k, end=b, encoding=e, length=c, step=s)
                                    for a, k, b, e, c, s in _points(data, kept)])
            return out
        return scan

    span = "start: bigint, kind: int, end: bigint"
    scanned = settle(map_batches(texts(docs, id_col, text_col), make, f"""
        doc_id {dict(docs.dtypes)[id_col]}, base array<struct<{span}>>, tests array<struct<encoding: int, length: int, n: bigint>>,
        kept array<struct<{span}, encoding: int, length: int, step: int>>"""), "secrets")
    tests = {(r.encoding, r.length): r.n for r in scanned.select(F.inline("tests")).groupBy("encoding", "length")
             .agg(F.sum("n").alias("n")).collect()}
    steps = {(r.encoding, r.length, r.step): r.n for r in scanned.select(F.inline("kept"))
             .groupBy("encoding", "length", "step").agg(F.count("*").alias("n")).collect()}
    least = cuts(tests, steps, rate, Battery())
    rule = " OR ".join(f"(x.encoding = {e} AND x.length = {c} AND x.step >= {s})" for (e, c), s in sorted(least.items())
                       if s <= STEPS) or "false"
    added = F.expr(f"transform(filter(kept, x -> {rule}), x -> struct(x.start AS start, x.kind AS kind, x.end AS end))")
    return scanned.select(F.col("doc_id").alias(id_col), "base", added.alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(F.expr(names), x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
