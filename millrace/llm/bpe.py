"""BPE encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import PIECE_BYTES, Words, joined, map_batches, pieces, texts

SUFFIX = "</w>"
#: Characters for which the fast path's classes are the tokenizer's own; other texts are normalised and split
#: by the tokenizer file's own rules.  Excluded: controls, superscripts, fractions, dotted capital I.
_FAST = re.compile("[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ſ]")
#: Of these, the ones that are letters if they are beyond ASCII; texts of nothing else are split by bytes.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-įı-ſ]")
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s0-9{_LETTERS}]+")
#: Of bytes: blanks 0, letters 1, digits 2, others 3.
_KINDS = np.array([0 if b in b"\t\n\r " else 1 if 97 <= b <= 122 or b >= 128 else 2 if 48 <= b <= 57 else 3 for b in range(256)])
_BLANK = _KINDS == 0
#: Pieces remembered by a worker, in each of two generations; longer pieces aren't kept.
REMEMBER, LONGEST = 250_000, 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, other = [], 0
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(256 + other))
            other += 1
    return out


class Bpe:
    """A byte-level BPE tokenizer whose words end in ``</w>``, from the text of its file.

    ``last[p]`` is the last token of the encoding of the first p symbols.  It is unique: of the tokens that
    end at p (matches of an automaton over all tokens), the one that the merges leave standing next to
    ``last[p - len]``.  Following these backwards from the end gives the ids.
    """

    def __init__(self, file: str):
        spec = json.loads(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != SUFFIX or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("a byte-level BPE file with word ends is needed")
        self.file, self._rules = file, None
        vocab = model["vocab"]
        self.text = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be plain strings")
        self.text |= {i: t for t, i in self.special.items()}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.letters = byte_letters()
        # tokens are numbered in the order of their merges; single symbols come first
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {a + b for a, b in merges}
        if len(made) != len(merges):
            raise ValueError("two merges make the same token")
        self.ids = [i for t, i in vocab.items() if t not in made]
        number = {self.text[i]: n for n, i in enumerate(self.ids)}
        self.halves: list[tuple[int, int]] = [(n, n) for n in range(len(self.ids))]
        self.pairs: dict[tuple[int, int], int] = {}
        for a, b in merges:
            n = number[a + b] = len(self.ids)
            self.ids.append(vocab[a + b])
            self.halves.append((number[a], number[b]))
            self.pairs[number[a], number[b]] = n
        self._known: dict[int, bool] = {}  # left * 2**20 + right: compatible
        # a symbol is one character: the last one of a word is moved up by END
        self.automaton = ahocorasick.Automaton()
        for token, n in number.items():
            ends = token.endswith(SUFFIX)
            plain = token[:-len(SUFFIX)] if ends else token
            if all(c in self.letters for c in plain) and plain:
                key = plain[:-1] + chr(ord(plain[-1]) + END) if ends else plain
                self.automaton.add_word(key, (len(key), n))
        self.automaton.make_automaton()
        self.table = np.array([self.text.get(i, "") for i in range(max(self.text) + 1)], object)
        self._young: dict[bytes, list[int]] = {}
        self._old: dict[bytes, list[int]] = {}

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens standing side by side: undo their merges, latest first, and
        look for an earlier merge across the border."""
        latest = len(self.halves)
        while True:
            across = self.pairs.get((left, right))
            if across is not None and across < latest:
                return False
            # of equal ranks, the merge on the left happened first
            if left > right:
                latest = left
                inner = self.halves[left][1]
                if inner != left:
                    left = inner
                    continue
                latest, inner = right + 1, self.halves[right][0]
                if inner == right:
                    return True
                right = inner
            else:
                latest, inner = right + 1, self.halves[right][0]
                if inner != right:
                    right = inner
                    continue
                latest, inner = left, self.halves[left][1]
                if inner == left:
                    return True
                left = inner

    def word(self, symbols: str) -> list[int]:
        """Ids of a word given as one character a symbol."""
        n, known = len(symbols), self._known
        last, back = [0] * (n + 1), [0] * (n + 1)
        for end, (size, token) in self.automaton.iter(symbols):  # at each end, the longest token first
            end += 1
            if back[end]:
                continue
            if size == end:
                last[end], back[end] = token, size
                continue
            pair = last[end - size] << 20 | token
            fits = known.get(pair)
            if fits is None:
                if len(known) > 1_000_000:
                    known.clear()
                fits = known[pair] = self._compatible(pair >> 20, token)
            if fits:
                last[end], back[end] = token, size
        out, at = [], n
        while at:
            if not back[at]:
                raise ValueError("the vocabulary lacks a byte")
            out.append(self.ids[last[at]])
            at -= back[at]
        return out[::-1]

    def _piece(self, piece: bytes) -> list[int]:
        """Ids of a piece of normalised text."""
        found = self._young.get(piece)
        if found is not None:
            return found
        found = self._old.get(piece)
        if found is None:
            symbols = piece.decode() if piece.isascii() and piece.decode().isprintable() \
                else "".join([self.letters[b] for b in piece])
            found = self.word(symbols[:-1] + chr(ord(symbols[-1]) + END))
        if len(piece) <= LONGEST:
            if len(self._young) >= REMEMBER:
                self._old, self._young = self._young, {}
            self._young[piece] = found
        return found

    def _pieces(self, text: str) -> list[bytes]:
        if not _FAST.search(text):
            return [p.encode() for p in _PIECE.findall(text.lower())]
        if self._rules is None:
            from tokenizers import Tokenizer
            whole = Tokenizer.from_str(self.file)
            self._rules = whole.normalizer, whole.pre_tokenizer
        normal, split = self._rules
        byte = {c: b for b, c in enumerate(self.letters)}
        return [bytes(byte[c] for c in piece) for piece, _ in split.pre_tokenize_str(normal.normalize_str(text))]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return self.encode_batch([text])[0]

    def encode_batch(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of each text.  Plain texts are cut into pieces together, and each distinct piece is looked up once."""
        out: list = [None] * len(batch)
        plain, size = [], 0
        for i, text in enumerate(batch):
            if self._special and "<|" in text and len(parts := self._special.split(text)) > 1:
                out[i] = np.concatenate([np.array([self.special[p]] if j % 2 else self._listed(p), np.uint32)
                                         for j, p in enumerate(parts)])
            elif _PLAIN.search(text):
                out[i] = np.array(self._listed(text), np.uint32)
            else:
                plain.append((i, text.lower().encode()))
                size += len(text)
                if size > PIECE_BYTES:
                    self._together(plain, out)
                    plain, size = [], 0
        self._together(plain, out)
        return out

    def _listed(self, text: str) -> list[int]:
        out = []
        for piece in self._pieces(text):
            out += self._piece(piece)
        return out

    def _together(self, plain: list[tuple[int, bytes]], out: list) -> None:
        if not plain:
            return
        data, at = joined([text for _, text in plain])
        starts, tokens, sizes = [], [], []
        for offset, part in pieces(data, ~_BLANK):
            a, b, hashes = _cut(part)
            codes, distinct = pd.factorize(hashes)
            sample = np.zeros(len(distinct), np.int64)
            sample[codes[::-1]] = np.arange(len(codes))[::-1]
            found = [self._piece(part[s:e]) for s, e in zip(a[sample].tolist(), b[sample].tolist())]
            length = np.fromiter(map(len, found), np.int64, len(found))
            first = np.cumsum(length) - length
            flat = np.fromiter(chain.from_iterable(found), np.uint32, int(length.sum()))
            n = length[codes]
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - first[codes], n)
            starts.append(a + offset)
            sizes.append(n)
            tokens.append(flat[place])
        starts, sizes, tokens = (np.concatenate(x) for x in (starts, sizes, tokens))
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, at)]
        for (i, _), a, b in zip(plain, ends[:-1].tolist(), ends[1:].tolist()):
            out[i] = tokens[a:b]

    def decode(self, ids) -> str:
        """Tokens parted by blanks: the file has no decoder."""
        return " ".join(self.table[np.asarray(ids, np.int64)].tolist())


def _cut(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the pieces of plain lower-case text: endings after an apostrophe, runs of
    letters, single digits, runs of anything else."""
    words = Words(data, ~_BLANK)
    raw, kinds = words.raw, _KINDS[words.raw]
    new = np.ones(len(raw), bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(raw))
    solid = kinds[a] > 0
    a, b = a[solid], b[solid]
    quote = np.flatnonzero((raw[a] == 39) & (b - a == 1))
    quote = quote[(quote + 1 < len(a))]
    quote = quote[(a[quote + 1] == b[quote]) & (kinds[a[quote + 1]] == 1)]
    if len(quote):
        one = raw[a[quote + 1]]
        two = np.where(b[quote + 1] - a[quote + 1] > 1, raw[np.minimum(a[quote + 1] + 1, len(raw) - 1)], 0)
        more = np.where(np.isin(one, list(b"stmd")), 1, np.where(((one == 114) | (one == 118)) & (two == 101)
                                                                | (one == 108) & (two == 108), 2, 0))
        b[quote] += more
        a[quote + 1] += more
        left = a < b
        a, b = a[left], b[left]
    return a, b, words.hashes(a, b)


END = 0x1000


def _tokenizers(spark, path: str):
    """The tokenizer, built once in each Python worker from a broadcast of its file."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


_built: dict[str, Bpe] = {}


def _worker_bpe(file: str) -> Bpe:
    key = hashlib.sha256(file.encode()).hexdigest()
    if key not in _built:
        _built.clear()
        _built[key] = Bpe(file)
    return _built[key]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers), decoded_sha256 (of the text
    that the ids decode to) and, unless left out, the ids.

    Special tokens written in a text become their ids.  A null or empty text has no tokens; repeated rows
    are encoded one by one; an empty table gives no rows.  ``path`` is read by the driver only; the file is
    broadcast, so its size is the vocabulary's.
    """
    shared = _tokenizers(docs.sparkSession, path or default_path())

    def make():
        bpe = _worker_bpe(shared.value)

        def encode(batch):
            out = {"doc_id": batch["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for ids in bpe.encode_batch([data.decode(errors="replace") for data in batch["text"]]):
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                if with_ids:
                    out["ids"].append(ids.astype(np.int32))
            return out
        return encode

    kind = dict(docs.dtypes)[id_col]
    return map_batches(texts(docs, id_col, text_col), make,
                       f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
                       + ", ids array<int>" * with_ids).withColumnRenamed("doc_id", id_col)


def decode_documents(rows: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text that the ids decode to; null ids decode to null."""
    shared = _tokenizers(rows.sparkSession, path or default_path())

    def make():
        bpe = _worker_bpe(shared.value)
        return lambda batch: {"doc_id": batch["doc_id"], "text": [
            None if ids is None else bpe.decode(ids) for ids in batch["ids"]]}

    picked = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return map_batches(picked, make, f"doc_id {dict(rows.dtypes)[id_col]}, text string").withColumnRenamed("doc_id", id_col)
