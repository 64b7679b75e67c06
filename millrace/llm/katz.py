"""LM scoring: a Katz backoff model of words, pairs and triples, learned and evaluated in batches of documents.

A batch is a row with the words of some documents.  Words, pairs and triples of a batch are dealt by hash to
parts as one packed list each (every distinct one once, however often it occurs, so a frequent
one costs one entry a batch); a part (their number follows from that of the tokens) adds up the counts and sends each batch its
answers in the order in which it asked.  All shuffles carry packed lists, no task holds more than a part or a batch, and nothing but
the counts of counts (a bounded table) reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import BATCH_ROWS, BLANK_WORDS, arrow_schema, drop, mix, settle, texts, word_arrays

#: Tokens of a batch, about; a longer document is a batch of its own.
BATCH_TOKENS = 3 << 18
#: Batches of a part, at most: what one task counts doesn't grow with the corpus.
PART_BATCHES = 5
#: Counts up to this are discounted by their own count of counts (Turing), greater ones by a line through the logs.
TURING = 5
#: Hashes that stand for the start and the end of a text.
START, END = np.uint64(1), np.uint64(2)
#: Every tenth document is held out of the training, by the checksum of its id.
FOLDS = 10

#: Tables of packed lists: they are compressed already, and rows of some megabytes would else be gathered by the hundred before
#: the size of a page or row group is looked at, which writers and readers then hold whole.
PACKED = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.block.size": str(8 << 20),
          "parquet.page.size.row.check.min": "1"}

#: Rows that a reader of files turns into arrays at once: texts, and lists of a part.
READ_ROWS = 16

_codec = pa.Codec("zstd", compression_level=1)


def pack(values: np.ndarray) -> bytes:
    """An array of numbers, its bytes sorted by place and compressed."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return values.dtype.str.encode().ljust(4) + len(planes).to_bytes(8, "little") + _codec.compress(planes, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    kind, size = np.dtype(data[:4].decode().strip()), int.from_bytes(data[4:12], "little")
    if not size:
        return np.zeros(0, kind)
    planes = _codec.decompress(data[12:], decompressed_size=size, asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers, as differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def pack_repeated(values: np.ndarray) -> bytes:
    """Numbers of which many are equal: the distinct ones, and for each its place among them."""
    distinct, places = np.unique(values, return_inverse=True)
    head = pack(distinct)
    return len(head).to_bytes(8, "little") + head + pack(small(places))


def unpack_repeated(data: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(data[:8], "little")
    return unpack(data[8:end])[unpack(data[end:])]


def small(values: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds them."""
    most = int(values.max(initial=0))
    return values.astype(np.uint8 if most < 256 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def _by_key(keys: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and codes that count in it."""
    order = np.argsort(keys, kind="stable").astype(np.int32)
    place = np.empty_like(order)
    place[order] = np.arange(len(order), dtype=np.int32)
    return order, place[codes]


def _by_use(uses: np.ndarray) -> np.ndarray:
    """Places of words, the most used first."""
    return np.argsort(-uses.astype(np.int64), kind="stable").astype(np.int32)


class Batch:
    """Words, pairs and triples of one batch, from its packed row."""

    def __init__(self, words: bytes, uses: bytes, tokens: bytes, sizes: bytes, held: bytes):
        self.words = unpack_sorted(words)  # START and END are the first two
        # places in words; every text ends with END.  They are packed as ranks by use, which are mostly small.
        self.tokens = _by_use(unpack(uses))[unpack(tokens)]
        self.sizes = unpack(sizes).astype(np.int64)
        self.held = unpack(held).astype(bool)
        self.text = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.learned = ~self.held[self.text]
        first = np.cumsum(self.sizes) - self.sizes
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[first] = 0
        self.inner = np.ones(len(self.tokens), bool)  # tokens with two words before them
        self.inner[first] = False

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.learned], minlength=len(self.words))

    def pairs(self):
        """Distinct pairs by key: keys, first and second word, training count, and each token's pair."""
        codes, distinct = pd.factorize(self.before.astype(np.int64) * len(self.words) + self.tokens)
        first, second = (x.astype(np.int32) for x in np.divmod(distinct, len(self.words)))
        keys = mix(self.words[first] * np.uint64(0x9E3779B97F4A7C15) + mix(self.words[second] + np.uint64(0x632BE59BD9B4E019)))
        order, codes = _by_key(keys, codes)
        counts = np.bincount(codes[self.learned], minlength=len(order))
        return keys[order], first[order], second[order], counts, codes

    def triples(self, keys: np.ndarray, pairs: np.ndarray):
        """Distinct triples by key, from the keys of pairs and each token's pair: keys, pair of the first two and of the last
        two words, training count, and the triple of each inner token."""
        inner = np.flatnonzero(self.inner)
        codes, distinct = pd.factorize(pairs[inner - 1].astype(np.int64) * len(self.words) + self.tokens[inner])
        first, word = (x.astype(np.int32) for x in np.divmod(distinct, len(self.words)))
        last = np.zeros(len(distinct), np.int32)
        last[codes] = pairs[inner]
        made = mix(keys[first] * np.uint64(0xC2B2AE3D27D4EB4F) + mix(self.words[word] + np.uint64(0x165667B19E3779F9)))
        order, codes = _by_key(made, codes)
        counts = np.bincount(codes[self.learned[inner]], minlength=len(order))
        return made[order], first[order], last[order], counts, codes


def edges(parts: int) -> np.ndarray:
    """Least hash of each part."""
    return np.array([(p << 64) // parts + (1 if (p << 64) % parts else 0) for p in range(parts)], np.uint64)


def _spans(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    at = np.append(np.searchsorted(keys, edges(parts)), len(keys)).tolist()
    return ((p, a, b) for p, (a, b) in enumerate(zip(at, at[1:])) if a < b)


@dataclass
class Discounts:
    """Good-Turing: a count r is worth ``of(r)`` times itself, always under 1: Turing's estimate for small counts,
    where it is usable, else that of a line through the logarithms of the counts of counts."""

    turing: list[float]
    slope: float

    @staticmethod
    def fit(counts: dict[int, int]) -> "Discounts":
        """``counts``: how many events have a count of r, for r up to TURING + 1."""
        seen = [(math.log(r), math.log(n)) for r, n in sorted(counts.items()) if n > 0 and r <= TURING + 1]
        slope = -2.0
        if len(seen) > 1:
            x, y = np.array(seen).T
            slope = float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum())
        slope = min(slope, -1.05)
        line = [(1 + 1 / r) ** (slope + 1) for r in range(1, TURING + 1)]
        own = [(r + 1) * counts.get(r + 1, 0) / (r * counts[r]) if counts.get(r) else 0 for r in range(1, TURING + 1)]
        return Discounts([0.0] + [d if 0 < d < 1 else e for d, e in zip(own, line)], slope)

    def of(self, counts: np.ndarray) -> np.ndarray:
        c = counts.astype(float)
        with np.errstate(divide="ignore"):
            d = (1 + 1 / c) ** (self.slope + 1)
        low = counts <= TURING
        d[low] = np.array(self.turing)[counts[low]]
        return d


@dataclass
class Model:
    """What is known of the whole corpus: training tokens, distinct ones, and all discounts."""

    tokens: int
    distinct: int
    words: Discounts
    pairs: Discounts
    triples: Discounts
    unknown: float

    def word_chance(self, counts: np.ndarray) -> np.ndarray:
        """P(word) from its training count; all unknown words share what the discounts leave over."""
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, self.words.of(np.maximum(counts, 1)) * counts / self.tokens, self.unknown)


def _batches(docs: DataFrame, batch_tokens: int) -> DataFrame:
    """Rows (batch, ids, words, uses, tokens, sizes, held) with about ``batch_tokens`` tokens each."""
    schema = "batch bigint, ids array<{}>, words binary, uses binary, tokens binary, sizes binary, held binary".format(dict(docs.dtypes)["doc_id"])
    arrow = arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, hashes, size = [], [], 0

        def row():
            words, tokens, uses = np.unique(np.concatenate([[START, END], *hashes]).astype(np.uint64), return_inverse=True,
                                            return_counts=True)
            rank = np.argsort(_by_use(uses))
            held = np.array([crc32(str("" if i is None else i).encode()) % FOLDS == 0 for i in ids], np.uint8)
            values = [number, ids, pack_sorted(words), pack(small(uses)), pack(small(rank[tokens[2:]])), pack(small(np.array(list(map(len, hashes))))), pack(held)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

        for part in parts:
            for doc, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                _, _, found = word_arrays(data.lower(), BLANK_WORDS)
                found = np.append(np.where(found < 3, found + np.uint64(1 << 32), found), END)
                ids.append(doc)
                hashes.append(found)
                size += len(found)
                if size >= batch_tokens:
                    yield row()
                    number += 1
                    ids, hashes, size = [], [], 0
        if ids:
            yield row()

    return docs.mapInArrow(run, schema)


def _rows(arrow: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)


def _over_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(row)`` yields dicts of columns, for one row at a time."""
    arrow = arrow_schema(schema)

    def run(parts):
        for part in parts:
            for i in range(part.num_rows):
                for out in fn({n: part.column(n)[i].as_py() for n in part.schema.names}):
                    yield _rows(arrow, out)

    return df.mapInArrow(run, schema)


def _by_batch(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(rows)`` yields dicts of columns, for the rows of one batch at a time.  They meet in Python only: joined to one row in
    Spark, they would be copied whole on the heap at every step."""
    arrow = arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn([row for part in parts for row in part.to_pylist()]):
            yield _rows(arrow, out)

    return df.groupBy("batch").applyInArrow(run, schema)


def _told(fn):
    """``fn`` for a batch's row with its answers, from the rows of ``told_by``."""
    def run(rows):
        row, = (r for r in rows if r["kind"] is None)
        yield from fn(row | {"answers": [r for r in rows if r["kind"] is not None]})
    return run


SPREAD = "array<struct<r: bigint, n: bigint>>"
ASK = f"part int, kind string, batch bigint, keys binary, counts binary, wanted binary, alone {SPREAD}"
ANSWER = f"batch bigint, kind string, part int, counts binary, flags binary, wanted binary, spread {SPREAD}"


def _spread(counts: np.ndarray) -> list[dict]:
    """How many events have each count there is, above 0."""
    return [dict(r=r, n=n) for r, n in zip(*(x.tolist() for x in np.unique(counts, return_counts=True))) if r]


def _alone(first: np.ndarray, last: np.ndarray, local: np.ndarray, total: np.ndarray, wanted: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Triples whose count their own batch knows from what it was told of their first and last two words: either pair has no training
    count, or has it all in this batch while no held-out text may ask for it.  ``local`` and ``total`` are training counts
    of pairs, ``wanted`` are contexts in held-out texts, ``held`` all pairs there."""
    mine = local == total
    return (mine & ~wanted)[first] | (mine & ~held)[last] | (total == 0)[first] | (total == 0)[last]


def _ask(parts: int, triples: bool):
    """Words and pairs of a batch, or (once pairs are answered) those triples that it doesn't know alone, by part."""
    def ask(row):
        batch = Batch(row["words"], row["uses"], row["tokens"], row["sizes"], row["held"])
        keys, _, _, counts, codes = batch.pairs()
        if triples:
            told = counts, *_answers(row["answers"], "pair", keys, parts)
            made, first, last, counts, _ = batch.triples(keys, codes)
            alone = _alone(first, last, told[0], told[1], *told[3])
            yield out("triple", row["batch"], made[~alone], counts[~alone], None, _spread(counts[alone]))
            return
        wanted = np.zeros((2, len(keys)), np.uint8)
        wanted[0, codes[np.flatnonzero(batch.inner & ~batch.learned) - 1]] = 1
        wanted[1, codes[~batch.learned]] = 1
        yield out("pair", row["batch"], keys, counts, wanted)
        wanted = np.zeros((2, len(batch.words)), np.uint8)
        wanted[0, batch.before[~batch.learned]] = 1
        hashed = mix(batch.words)
        by = np.argsort(hashed, kind="stable")
        yield out("word", row["batch"], hashed[by], batch.word_counts()[by], wanted[:, by])

    def out(kind, number, keys, counts, wanted, alone=None):
        counts = small(counts)
        spans = list(_spans(keys, parts)) or [(0, 0, 0)]
        return {"part": [p for p, _, _ in spans], "kind": [kind] * len(spans), "batch": [number] * len(spans),
                "keys": [pack_sorted(keys[a:b]) for _, a, b in spans], "counts": [pack(counts[a:b]) for _, a, b in spans],
                "wanted": [None if wanted is None else pack(np.packbits(wanted[:, a:b])) for _, a, b in spans],
                "alone": [alone] + [None] * (len(spans) - 1)}
    return ask


def _over_parts(df: DataFrame, fn, schema: str, *keys: str) -> DataFrame:
    """``fn(columns)`` makes the output's columns from the lists of one group's."""
    arrow = arrow_schema(schema)
    return df.groupBy(*keys).applyInArrow(
        lambda part: pa.Table.from_batches([_rows(arrow, fn(part.to_pydict()))], schema=arrow), schema)


def _count(columns: dict) -> dict:
    """All that was asked of one part: total counts, in the order of each asker.

    Flags are 1 for the one asker that speaks for the key; a word or pair is wanted if a held-out text has it as a
    context (and, for pairs, if one has it at all).  ``spread``: how many keys have each count there is, with those that
    batches know alone.
    """
    keys = [unpack_sorted(k) for k in columns["keys"]]
    sizes = np.array([len(k) for k in keys])
    codes, _ = pd.factorize(np.concatenate(keys))
    del keys
    counts = np.concatenate([unpack(c) for c in columns["counts"]])
    total = np.bincount(codes, weights=counts).astype(np.int64)
    flags = np.zeros(len(codes), bool)
    owner = np.zeros(len(total), np.int64)
    owner[codes[::-1]] = np.arange(len(codes))[::-1]
    flags[owner] = True
    wanted = None
    if columns["wanted"][0] is not None:
        asked = np.concatenate([_bits(w, n) for w, n in zip(columns["wanted"], sizes.tolist())], axis=1)
        wanted = np.stack([(np.bincount(codes, weights=x) > 0)[codes] for x in asked])
    spread = [_spread(total) + [x for some in columns["alone"] for x in some or ()]] + [None] * (len(sizes) - 1)
    ends = np.cumsum(sizes)
    answers = total[codes]
    return {
        "batch": columns["batch"], "kind": columns["kind"], "part": columns["part"], "spread": spread,
        "counts": [pack(small(answers[e - n:e])) for e, n in zip(ends, sizes)],
        "flags": [pack(np.packbits(flags[e - n:e])) for e, n in zip(ends, sizes)],
        "wanted": [None if wanted is None else pack(np.packbits(wanted[:, e - n:e])) for e, n in zip(ends, sizes)]}


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(unpack(data), count=2 * n).reshape(2, n)


def _answers(rows: list[dict], kind: str, keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts and flags of the (sorted) keys of a batch, and which are wanted as contexts, and at all."""
    found = {r["part"]: r for r in rows if r["kind"] == kind}
    counts, flags, wanted = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool), np.zeros((2, len(keys)), bool)
    for p, a, b in _spans(keys, parts):
        counts[a:b] = unpack(found[p]["counts"])
        flags[a:b] = np.unpackbits(unpack(found[p]["flags"]), count=b - a)
        if found[p]["wanted"] is not None:
            wanted[:, a:b] = _bits(found[p]["wanted"], b - a)
    return counts, flags, wanted


KNOWN = "batch bigint, kind string, part int, keys binary, numbers binary, ids array<{}>"
SCORED = "doc_id {}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _score(model: Model, parts: int, order: int, id_type: str):
    """Scores of a batch but for the backoff weights of what its held-out texts have and the training doesn't: the
    contexts and texts are kept, and the sums over known pairs and triples of each context that anyone wants.

    A token whose triple is known takes its chance from it; else from its pair, times the weight of the two words before
    it, if they are known; and if the pair is new too, from the word, times the weight of the word before it.
    """
    schema = KNOWN.format(id_type)

    def score(row):
        batch = Batch(row["words"], row["uses"], row["tokens"], row["sizes"], row["held"])
        hashed = mix(batch.words)
        by = np.argsort(hashed, kind="stable")
        counts, wanted = np.zeros(len(by), np.int64), np.zeros(len(by), bool)
        counts[by], _, (wanted[by], _) = _answers(row["answers"], "word", hashed[by], parts)
        keys, first, second, local, codes = batch.pairs()
        both, owner, (pair_wanted, pair_held) = _answers(row["answers"], "pair", keys, parts)
        chance = model.word_chance(counts)
        # a text's start is no token: its count is that of the texts' ends
        context = counts.copy()
        context[0] = counts[1]
        worth = model.pairs.of(np.maximum(both, 1)) * both
        known = both > 0
        share = np.where(known, worth / np.maximum(context[first], 1), chance[second])
        log = np.log10(share)[codes]
        # contexts of one word, then those of two
        contexts, totals = np.concatenate([hashed, keys]), np.concatenate([context, both])
        new = ~known[codes] & (context[batch.before] > 0)
        speak = known & owner & wanted[first]
        spoken = [(first[speak], worth[speak], chance[second[speak]])]
        further = np.zeros(0, np.int64)
        if order > 2:
            inner = np.flatnonzero(batch.inner)
            triples, lead, last, three, at = batch.triples(keys, codes)
            asked = ~_alone(lead, last, local, both, pair_wanted, pair_held)
            owner = np.ones(len(three), bool)
            three[asked], owner[asked], _ = _answers(row["answers"], "triple", triples[asked], parts)
            value = model.triples.of(np.maximum(three, 1)) * three
            seen = three > 0
            whole = inner[seen[at]]
            log[whole] = np.log10(value / np.maximum(both[lead], 1), where=seen, out=np.zeros(len(three)))[at][seen[at]]
            new[whole] = False
            further = inner[~seen[at] & (both[codes[inner - 1]] > 0)]
            del triples, inner, at, whole
            speak = seen & owner & pair_wanted[lead]
            spoken.append((len(hashed) + lead[speak], value[speak], share[last[speak]]))
        n = len(batch.sizes)
        base = np.log10((counts + 0.1) / (model.tokens + 0.1 * (model.distinct + 1)))
        sums = [np.bincount(batch.text, weights=x, minlength=n) for x in (
            counts[batch.tokens] > 0, base[batch.tokens], log)]
        ids = row["ids"]
        yield {"batch": [row["batch"]], "kind": ["text"], "part": [-1], "keys": [pack(small(batch.sizes))],
               "numbers": [pack(np.concatenate([*sums, batch.held.astype(float)]))], "ids": [ids]}
        # tokens that back off from a context that is known: its weight is still missing
        missing = np.flatnonzero(new)
        places, at = np.unique(np.concatenate([batch.before[missing], len(hashed) + codes[further - 1]]), return_inverse=True)
        by = np.argsort(contexts[places], kind="stable")
        rank = np.empty_like(by)
        rank[by] = np.arange(len(by))
        yield {"batch": [row["batch"]], "kind": ["new"], "part": [-1],
               "keys": [pack(small(batch.text[np.concatenate([missing, further])]))],
               "numbers": [pack(small(rank[at]))], "ids": [None]}
        yield from parted("ask", row["batch"], contexts[places][by], small(totals[places][by]))
        # sums over known pairs and triples, each spoken for by one batch
        places, at = np.unique(np.concatenate([x for x, _, _ in spoken]), return_inverse=True)
        mass, lower = (np.bincount(at, weights=np.concatenate([x[i] for x in spoken]), minlength=len(places)) for i in (1, 2))
        by = np.argsort(contexts[places], kind="stable")
        yield from parted("sum", row["batch"], contexts[places][by], mass[by], lower[by])

    def parted(kind, number, keys, numbers, lower=None):
        spans = list(_spans(keys, parts))
        yield {"batch": [number] * len(spans), "kind": [kind] * len(spans), "part": [p for p, _, _ in spans],
               "keys": [pack_sorted(keys[a:b]) for _, a, b in spans],
               "numbers": [pack(numbers[a:b]) if lower is None else pack_repeated(np.concatenate([numbers[a:b], lower[a:b]]))
                           for _, a, b in spans], "ids": [None] * len(spans)}
    return score, schema


WEIGHTS = "batch bigint, part int, weights binary"


def _weigh(columns: dict) -> dict:
    """log10 of the backoff weight of each context asked for in one part: what the discounts leave of the context's
    chance, over what the shorter context leaves to words that never followed it."""
    rows = list(zip(columns["kind"], columns["batch"], columns["part"], columns["keys"], columns["numbers"]))
    sums = [(unpack_sorted(k), unpack_repeated(x).reshape(2, -1)) for kind, _, _, k, x in rows if kind == "sum"]
    asked = [(batch, p, unpack_sorted(k), unpack(x).astype(float)) for kind, batch, p, k, x in rows if kind == "ask"]
    out: dict[str, list] = {"batch": [], "part": [], "weights": []}
    if asked:
        keys, at = np.unique(np.concatenate([k for k, _ in sums] or [np.zeros(0, np.uint64)]), return_inverse=True)
        mass, lower = (np.bincount(at, weights=np.concatenate([x[i] for _, x in sums]), minlength=len(keys)) if sums
                       else np.zeros(0) for i in (0, 1))
        for batch, p, k, total in asked:
            place = np.searchsorted(keys, k)
            left, rest = 1 - mass[place] / total, 1 - lower[place]
            out["batch"].append(batch)
            out["part"].append(p)
            out["weights"].append(pack(np.log10(np.maximum(left, 1e-300) / np.maximum(rest, 1e-300))))
    return out


def _finish(id_type: str):
    schema = SCORED.format(id_type)

    def finish(rows):
        kinds = {r["kind"]: r for r in rows}
        text, new = kinds["text"], kinds["new"]
        sizes = unpack(text["keys"]).astype(np.int64)
        known, base, score, held = unpack(text["numbers"]).reshape(4, -1)
        found = sorted((r["part"], r["weights"]) for r in rows if r["kind"] is None)
        weights = np.concatenate([unpack(w) for _, w in found] or [np.zeros(0)])
        score = score + np.bincount(unpack(new["keys"]).astype(np.int64), minlength=len(sizes),
                                    weights=weights[unpack(new["numbers"]).astype(np.int64)])
        yield {"doc_id": text["ids"], "held_out": held > 0, "n_tokens": sizes, "n_known": known.astype(np.int64),
               "base_score": base, "score": score}
    return finish, schema


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_tokens: int = BATCH_TOKENS,
                    order: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Tokens are what blanks part, A-Z in lower case, and one end; a null or empty text is its end.  Rows whose crc32(id)
    mod 10 is 0 are held out (a null id counts as empty text, and so is held out); the others are learned from, repeated
    rows repeatedly.  ``score`` is log10 of the text's chance: for a triple seen in training, its discounted
    share of the two words before; for another, their backoff weight times the chance after one word (without the
    two words, that chance), which is found alike from pairs and the word's own chance.  The start of a text counts as
    one word.  With ``order`` 2 pairs are the longest.  Weights make the chances of all words (unknown ones are one)
    add up to 1 after every context.  ``base_score`` is additive smoothing.  Words, pairs and triples are told apart by 64-bit
    hashes.  An empty table gives no rows; without training rows every chance is 1.

    Batches, answers and scores so far are tables in the shared folder; batches and answers go when the scores are there.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    id_type = dict(docs.dtypes)[id_col]
    made: list[str] = []
    batches = _settle_rows(_batches(texts(docs, id_col, text_col), batch_tokens), "batches", made, BATCH_ROWS)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-batches.count() // PART_BATCHES))

    def answered(asked: DataFrame) -> DataFrame:
        return _settle_rows(_over_parts(asked, _count, ANSWER, "kind", "part"), "answers", made)

    def told_by(rows: DataFrame) -> DataFrame:
        return batches.unionByName(rows.select("batch", "kind", "part", "counts", "flags", "wanted"), allowMissingColumns=True)

    answers = answered(_over_batches(batches, _ask(parts, False), ASK))
    if order > 2:  # triples after words and pairs: most that hold a rare pair needn't be asked for, and one shuffle lies on disk at a time
        told = told_by(answers.where("kind = 'pair'"))
        answers = answers.unionByName(answered(_by_batch(told, _told(_ask(parts, True)), ASK)))
    model = _model(answers)
    score, schema = _score(model, parts, order, id_type)
    known = _settle_rows(_by_batch(told_by(answers), _told(score), schema), "known")
    drop(docs.sparkSession, made)
    weighed = _over_parts(known.where("kind IN ('ask', 'sum')"), _weigh, WEIGHTS, "part")
    rows = known.where("kind IN ('text', 'new')").select("batch", "kind", "keys", "numbers", "ids")
    finish, schema = _finish(id_type)
    scored = _by_batch(rows.unionByName(weighed, allowMissingColumns=True), finish, schema)
    return scored.select(F.col("doc_id").alias(id_col), "held_out", "n_tokens", "n_known",
                         F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def _settle_rows(df: DataFrame, label: str, made: list[str] | None = None, at_once: int = 1) -> DataFrame:
    """``settle`` for rows of some megabytes: they go to Python one by one (or ``at_once``), so a task's memory outside the heap holds
    one, and files are read by a few rows, whose arrays a reader keeps on the heap."""
    conf = df.sparkSession.conf
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(at_once), "spark.sql.parquet.columnarReaderBatchSize": str(READ_ROWS)}
    before = {name: conf.get(name) for name in wanted}
    for name, value in wanted.items():
        conf.set(name, value)
    try:
        return settle(df, label, free=True, made=made, **PACKED)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def _model(answers: DataFrame) -> Model:
    spread = answers.where("spread IS NOT NULL").select("kind", F.inline("spread"))
    low = {(r.kind, r.r): r.n for r in spread.where(F.col("r") <= TURING + 1).groupBy("kind", "r").agg(F.sum("n").alias("n")).collect()}
    words, pairs, triples = (Discounts.fit({r: n for (k, r), n in low.items() if k == kind}) for kind in ("word", "pair", "triple"))
    r = F.col("r")
    worth = F.when(r > TURING, F.pow(1 + 1 / r, F.lit(words.slope + 1))).otherwise(
        F.element_at(F.array(*map(F.lit, words.turing)), (F.least(r, F.lit(TURING)) + 1).cast("int")))
    whole = spread.where("kind = 'word'").agg(F.sum(r * F.col("n")).alias("tokens"), F.sum("n").alias("distinct"),
                                              F.sum(r * F.col("n") * worth).alias("mass")).first()
    tokens = whole.tokens or 0
    return Model(tokens, whole.distinct or 0, words, pairs, triples, 1 - whole.mass / tokens if tokens else 1.0)
