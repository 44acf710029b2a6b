"""License scan: MinHash bands over overlapping token windows, then exact containment.

Templates are notices in several wordings, headers and whole licenses (``license_texts.py``). Each is searched in windows of the smallest power of two that is
at least twice its length, laid at half that stride, so every occurrence lies whole in some
window. A window's set of ``WIDTH``-word shingles has Jaccard similarity of at least about a quarter with a template
inside it (n of at most 4n + 2 shingles); ``HASHES`` bands of one MinHash value find it with probability
1 - 0.8^40 > 0.9998 even at 0.2. The bands of all templates of a window size are one sorted index, in which a window's
values are looked up; a window without any template's shingle shares no band and is passed over. Retrieved (window, template) pairs are verified on exact
shingles: the share of the template's shingles in the window must reach ``min_containment``. Of a license's wordings in a window the best
contained and the longest found stay. Where templates of different licenses overlap and the shingles found of one are mostly the other's too
(other versions, other members of a family), the better contained one is reported; so is the longer one where its text found holds the other's whole. Ties stay. Overlapping windows of one license are one match.

Work grows with a text's length: windows of equal content are looked up and verified once, and a match meets the kinds of matches
that overlap it, each kind once. The templates are a parameter of known size and travel with the tasks. Everything is per text: no shuffle,
no group. Null and empty texts and texts shorter than a shingle give no rows; repeated rows give repeated matches; an empty table gives none; templates
shorter than ``WIDTH`` words are one shingle. Words are lower-cased and stripped of outer punctuation.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.llm.license_texts import wordings
from propensio.llm.text import mix, shingles, word_hashes

WIDTH, HASHES, MIN_CONTAINMENT = 3, 40, 0.8
#: Single notices, searched for besides ``license_texts.wordings()`` (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced",
}
_FACTORS = np.random.default_rng(41).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OUTER = re.compile(r"(?<![^\s])[^\w\s]+|[^\w\s]+(?![^\s])")


def _words(text: str) -> np.ndarray:
    return word_hashes(_OUTER.sub(" ", text.lower()))


class _Index:
    """Templates by window size: their shingles, and the bands' values in one sorted list a size."""

    def __init__(self, templates: list[tuple[str, str]]):
        seen: dict[tuple[str, bytes], tuple[str, int, np.ndarray]] = {}
        for name, text in sorted(templates):
            words = _words(text)
            own = np.unique(shingles(words, WIDTH))
            if len(own):
                seen.setdefault((name, own.tobytes()), (name, max(8, 1 << (2 * len(words) - 1).bit_length()), own))
        self.names = [t[0] for t in seen.values()]
        self.own = [t[2] for t in seen.values()]
        self.sizes = np.array([len(o) for o in self.own], dtype=np.int64)
        flat = np.concatenate(self.own) if seen else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.owner = np.repeat(np.arange(len(self.own)), self.sizes)[order]
        self.shingles, first = np.unique(flat[order], return_index=True)
        self.cuts = np.append(first, len(flat))
        self.bands: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        windows = np.array([t[1] for t in seen.values()], dtype=np.int64)
        for window in np.unique(windows).tolist():
            members = np.flatnonzero(windows == window)
            keys = np.concatenate([_band_keys((self.own[k][None, :] * _FACTORS[:, None]).min(axis=1)) for k in members])
            of = np.repeat(members, HASHES)
            order = np.argsort(keys, kind="stable")
            self.bands[window] = keys[order], of[order]

    def retrieved(self, window: int, grams: np.ndarray) -> np.ndarray:
        """Templates that share a band value with a window's shingles."""
        keys, of = self.bands[window]
        wanted = _band_keys((grams[None, :] * _FACTORS[:, None]).min(axis=1))
        low, high = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, "right")
        return np.unique(np.concatenate([of[a:b] for a, b in zip(low, high, strict=True)]))

    def verified(self, window: int, grams: np.ndarray, min_containment: float) -> list[tuple]:
        """(license, share, shingles found, template's shingles): per license the best contained wording and the longest found."""
        near = self.retrieved(window, grams)
        if not len(near):
            return []
        inside = np.unique(grams)
        at = np.minimum(np.searchsorted(self.shingles, inside), len(self.shingles) - 1)
        at = at[self.shingles[at] == inside]
        held = np.bincount(np.concatenate([self.owner[self.cuts[i] : self.cuts[i + 1]] for i in at]), minlength=len(self.own))
        good = near[held[near] >= min_containment * self.sizes[near] - 1e-9]
        best: dict[str, list[int]] = {}
        for k in good.tolist():
            best.setdefault(self.names[k], []).append(k)
        out = []
        for name, wordings in best.items():
            shares = {k: held[k] / self.sizes[k] for k in wordings}
            for k in {max(wordings, key=lambda k: (shares[k], held[k])), max(wordings, key=lambda k: (held[k], shares[k]))}:
                own = self.own[k]
                out.append((name, float(shares[k]), own[np.isin(own, inside)], own))
        return out


def _band_keys(lows: np.ndarray) -> np.ndarray:
    return mix(lows ^ (np.arange(HASHES, dtype=np.uint64) << np.uint64(57)))


def _explains(b: tuple, a: tuple) -> bool:
    """Does match ``b`` explain an overlapping match ``a`` (license, share, shingles found, template's shingles)?"""
    if b[0] == a[0]:
        return False
    better = b[1] > a[1] and 2 * int(np.isin(a[2], b[3]).sum()) >= len(a[2])
    return better or (len(b[2]) > len(a[2]) and bool(np.isin(a[2], b[2]).all()))


def _unexplained(matches: list[tuple[int, int, int]], kinds: list[tuple]) -> list[tuple[int, int, int]]:
    """Matches (start, end, kind) that no overlapping match explains; each meets every overlapping kind once."""
    known: dict[tuple[int, int], bool] = {}
    verdicts: dict[tuple[int, frozenset], bool] = {}
    matches, order, out = sorted(matches), sorted(matches, key=lambda m: m[1]), []
    by_span: dict[int, list[tuple[int, int, int]]] = {}
    for m in matches:
        by_span.setdefault(m[1] - m[0], []).append(m)
    for group in by_span.values():  # of one length, so that both ends move forward together
        live: Counter = Counter()
        entered = gone = 0
        for start, end, kind in group:
            while entered < len(matches) and matches[entered][0] < end:
                live[matches[entered][2]] += 1
                entered += 1
            while gone < len(order) and order[gone][1] <= start:
                live[order[gone][2]] -= 1
                gone += 1
            around = frozenset(k for k, n in live.items() if n > 0)
            if (kind, around) not in verdicts:
                for k in around:
                    if (k, kind) not in known:
                        known[k, kind] = _explains(kinds[k], kinds[kind])
                verdicts[kind, around] = not any(known[k, kind] for k in around)
            if verdicts[kind, around]:
                out.append((start, end, kind))
    return out


def _find(index: _Index, words: np.ndarray, min_containment: float) -> list[tuple[str, int, int, float]]:
    """Matches of one text: license, first word, past the last word, containment."""
    grams = shingles(words, WIDTH)
    if not len(grams) or not len(index.shingles):
        return []
    at = np.minimum(np.searchsorted(index.shingles, grams), len(index.shingles) - 1)
    held = np.flatnonzero(index.shingles[at] == grams)  # a window without them shares no band
    if not len(held):
        return []
    kinds: list[tuple] = []
    numbers: dict[tuple, int] = {}
    matches = []
    for window in index.bands:
        span, step = window - WIDTH + 1, window // 2
        last = max(1, -(-(len(grams) - span + step) // step))
        # windows that hold such a shingle: s * step <= shingle < s * step + span
        reach = np.concatenate([held // step - k for k in range(-(-span // step) + 1)])
        reach = np.unique(reach[(reach >= 0) & (reach < last)])
        seen: dict[bytes, list[int]] = {}
        for s in (reach * step).tolist():
            part = grams[s : s + span]
            key = part.tobytes() if window <= 256 else mix(part + np.arange(len(part), dtype=np.uint64)).sum(dtype=np.uint64).tobytes() + len(part).to_bytes(4)
            if key not in seen:
                seen[key] = []
                for found in index.verified(window, part, min_containment):
                    mark = (found[0], found[1], found[2].tobytes(), found[3].tobytes())
                    if mark not in numbers:
                        numbers[mark] = len(kinds)
                        kinds.append(found)
                    seen[key].append(numbers[mark])
            matches += [(s, min(s + window, len(words)), k) for k in seen[key]]
    out: list[list] = []
    for name, s, end, share in sorted((kinds[k][0], s, end, kinds[k][1]) for s, end, k in _unexplained(matches, kinds)):
        if out and out[-1][0] == name and s <= out[-1][2]:
            out[-1][2], out[-1][3] = max(end, out[-1][2]), max(share, out[-1][3])
        else:
            out.append([name, s, end, share])
    return [tuple(m) for m in out]


def _scan(templates: list[tuple[str, str]], min_containment: float):
    index = _Index(templates)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for ident, text in zip(pdf["id"], pdf["text"], strict=True):
                if text:
                    rows += [(ident, name, s, end - s, share) for name, s, end, share in _find(index, _words(text), min_containment)]
            out = pd.DataFrame(rows, columns=["id", "license", "first_word", "n_words", "containment"])
            yield out.astype({"first_word": "int64", "n_words": "int64", "containment": "float64", "license": "object"})

    return run


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, min_containment: float = MIN_CONTAINMENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per match of ``templates`` (license: text; the module's own by default): id, ``license``, ``first_word`` and ``n_words`` of the windows, ``containment``."""
    kind = dict(docs.dtypes)[id_col]
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, license string, first_word long, n_words long, containment double"
    wanted = [*TEMPLATES.items(), *wordings()] if templates is None else list(templates.items())
    return thin.mapInPandas(_scan(wanted, min_containment), schema).withColumnRenamed("id", id_col)
