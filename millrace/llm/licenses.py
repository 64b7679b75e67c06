"""License scan: MinHash bands over overlapping windows find templates, shingle containment confirms them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import LETTER_WORDS, batch_words, map_batches, mix, rolling, texts, word_arrays

#: Public license notices, as they are written in files.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    "All-rights-reserved": ("All rights reserved.",),
}

SHINGLE = 5
CONTAINMENT = 0.8
#: MinHash rows of a band, and the chance to miss a template that the bands may leave.
ROWS, MISS = 1, 1e-4
_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, (512, 2), dtype=np.uint64) | np.uint64(1)


#: A window is so many blocks, each a quarter of the shingles of the longest template of its class.
BLOCKS = 5


def bands_needed(rows: int = ROWS, containment: float = CONTAINMENT, miss: float = MISS) -> int:
    """Bands that retrieve a contained template with a chance of 1 - ``miss`` at least.

    A template of t shingles is in a class whose windows have 2.5 t at most, and any run of t shingles is
    in a window.  With ``containment`` of them there, the Jaccard similarity is at least containment /
    (3.5 - containment), and a band agrees with that to the power of its rows.  Templates of one shingle have
    windows of one, where the first band decides.
    """
    similarity = containment / (3.5 - containment)
    return int(np.ceil(np.log(miss) / np.log(1 - similarity ** rows)))


@dataclass
class _Template:
    license: str
    variant: int
    shingles: np.ndarray


class Templates:
    """Templates by shingle length (shorter for very short ones) and size class, with their bands."""

    def __init__(self, templates: dict[str, tuple[str, ...]], shingle: int, rows: int):
        self.rows, self.bands = rows, bands_needed(rows)
        if rows * self.bands > len(_SEEDS):
            raise ValueError("so many bands and rows are too many")
        self.classes: dict[tuple[int, int], list[_Template]] = {}
        for name, variants in templates.items():
            for i, text in enumerate(variants):
                _, _, words = word_arrays(text.encode().lower(), LETTER_WORDS)
                size = min(shingle, len(words))
                if size:
                    found = np.unique(rolling(words, size))
                    width = 1 << int(np.ceil(np.log2(len(found))))
                    self.classes.setdefault((size, width), []).append(_Template(name, i, found))
        #: By class and band: band values, and the templates that have them.
        self.known: dict[tuple[int, int], list[dict[int, list[int]]]] = {}
        for key, members in self.classes.items():
            self.known[key] = [{} for _ in range(self.bands)]
            for t, template in enumerate(members):
                for band, known in enumerate(self.known[key]):
                    value = np.zeros(1, np.uint64)
                    for seed in self._seeds(band):
                        value = _fold(value, self._values(template.shingles, seed).min(keepdims=True), seed)
                    known.setdefault(int(value[0]), []).append(t)

    def _seeds(self, band: int) -> np.ndarray:
        return _SEEDS[band * self.rows:(band + 1) * self.rows]

    @staticmethod
    def _values(shingles: np.ndarray, seed: np.ndarray) -> np.ndarray:
        return shingles * seed[0] + (seed[1] ^ (shingles >> np.uint64(32)))

    def find(self, first: np.ndarray, hashes: np.ndarray):
        """For the texts of a batch: (text, first word, end word, template, containment)."""
        for size in sorted({size for size, _ in self.classes}):
            whole = rolling(hashes, size)
            counts = np.maximum(np.diff(first) - size + 1, 0)
            if counts.any():
                # shingles inside a text, one text after the other
                text = np.repeat(np.arange(len(counts)), counts)
                inside = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield from self._of_size(size, whole[first[text] + inside], text, inside)

    def _of_size(self, size: int, shingles: np.ndarray, text: np.ndarray, inside: np.ndarray):
        levels = self._levels(size, text, inside)
        hits: dict[int, set[tuple[int, int]]] = {level.block: set() for level in levels}
        for band in range(self.bands):
            folded: dict[int, np.ndarray] = {}
            for seed in self._seeds(band):
                least = self._values(shingles, seed)
                for level in levels:
                    if level.starts is not None:
                        least = np.minimum.reduceat(least, level.starts)
                    for width in level.widths:
                        if width > 1 or not band:
                            window = least if width == 1 else level.windows(least)
                            folded[width] = _fold(folded.get(width, np.zeros(len(window), np.uint64)), window, seed)
            for level in levels:
                for width in level.widths:
                    if width in folded:
                        for value, templates in self.known[size, width][band].items():
                            at = np.flatnonzero(folded[width] == np.uint64(value)).tolist()
                            hits[level.block].update((i, width, t) for i in at for t in templates)
        ends = np.cumsum(np.bincount(text))
        for level in levels:
            for i, width, t in sorted(hits[level.block]):
                template, start = self.classes[size, width][t], int(level.first[i])
                end = min(start + (1 if width == 1 else BLOCKS * level.block), int(ends[text[start]]))
                found = np.flatnonzero(np.isin(shingles[start:end], template.shingles)) + start
                share = len(np.unique(shingles[found])) / len(template.shingles)
                if share >= CONTAINMENT:
                    yield int(text[start]), int(inside[found[0]]), int(inside[found[-1]]) + size, template, share

    def _levels(self, size: int, text: np.ndarray, inside: np.ndarray) -> list["_Level"]:
        widths = sorted(width for x, width in self.classes if x == size)
        out, block, first = [], 1, np.arange(len(text))
        while block <= max(1, widths[-1] // 4):
            starts = None
            if block > 1:
                starts = np.flatnonzero(inside[first] % block == 0)
                first = first[starts]
            of = text[first]
            out.append(_Level(block, [w for w in widths if max(1, w // 4) == block], first, starts,
                              {k: of[k:] == of[:-k] for k in (1, 2, 4)}))
            block *= 2
        return out


@dataclass
class _Level:
    """Blocks of one length: their first shingles, where they begin among the blocks of half that length,
    and whether the blocks 1, 2 and 4 places on are of the same text."""

    block: int
    widths: list[int]
    first: np.ndarray
    starts: np.ndarray | None
    same: dict[int, np.ndarray]

    def windows(self, least: np.ndarray) -> np.ndarray:
        """Least value of each block and the four after it."""
        two = self._with(least, least, 1)
        return self._with(self._with(two, two, 2), least, 4)

    def _with(self, values: np.ndarray, others: np.ndarray, step: int) -> np.ndarray:
        out = values.copy()
        if len(out) > step:
            np.minimum(values[:-step], others[step:], out=out[:-step], where=self.same[step])
        return out


def _fold(value: np.ndarray, least: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """A band's value with one more of its rows."""
    return mix(value * seed[0] + least)


def scan_licenses(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, id_col: str = "doc_id",
                  text_col: str = "text", shingle: int = SHINGLE, rows: int = ROWS) -> DataFrame:
    """doc_id, n_words and ``found``: an array of (license, variant, first, words, containment) by first word.

    Windows of consecutive shingles (``shingle`` words; a shorter template is one shingle), five blocks long
    and a block apart, are looked up by their MinHash bands; as many bands are taken as retrieve a template of
    which 0.8 are in a window with a chance of 0.9999.  A hit counts if 0.8 of the template's
    shingles are in the window; of hits of one template that overlap, the fullest counts.  Words are
    digits, letters and everything beyond ASCII, A-Z in lower case.  A null or empty text has no words
    and no hits.  Templates are broadcast: a given list, whose size the caller knows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Templates(TEMPLATES if templates is None else templates, shingle, rows))

    def make():
        known = shared.value

        def scan(batch):
            first, _, _, hashes = batch_words([t.lower() for t in batch["text"]], LETTER_WORDS)
            found: list[list[tuple]] = [[] for _ in batch["text"]]
            for text, a, b, template, share in known.find(first, hashes):
                found[text].append((a, b, template.license, template.variant, share))
            return {"doc_id": batch["doc_id"], "n_words": np.diff(first).tolist(), "found": [_best(x) for x in found]}
        return scan

    kind = dict(docs.dtypes)[id_col]
    return map_batches(texts(docs, id_col, text_col), make, f"""doc_id {kind}, n_words bigint, found array<struct<
        license: string, variant: int, first: bigint, words: bigint, containment: double>>""").withColumnRenamed("doc_id", id_col)


def _best(found: list[tuple]) -> list[dict]:
    out: list[tuple] = []
    for hit in sorted(found, key=lambda x: (-x[4], x[1] - x[0], x[0], x[2:4])):
        if not any(hit[2:4] == x[2:4] and hit[0] < x[1] and x[0] < hit[1] for x in out):
            out.append(hit)
    return [dict(license=name, variant=v, first=a, words=b - a, containment=share)
            for a, b, name, v, share in sorted(out, key=lambda x: (x[0], x[2], x[3]))]
