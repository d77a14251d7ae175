"""Finding license texts: MinHash bands over overlapping windows, then exact containment.

Words end at spaces and punctuation on both sides, so neither comment markers nor
the marks around a notice are part of it.  A template has five-word shingles, or
one shingle if it is shorter.  Templates of up to ``SHORT`` shingles are retrieved
by every one of them.  Longer ones are cut into windows of two to sixteen shingles
at every place; a document at every half window.  Windows of one width are
compared by ``BANDS`` bands of ``ROWS`` MinHash values each: windows with a
Jaccard similarity s meet in a band with probability 1 - (1 - s^ROWS)^BANDS,
99.5 % at s = 0.6.  What is retrieved is a candidate; a document has a license
if it holds enough of the template's distinct shingles, counted exactly.

Templates are a parameter of bounded size, so their bands go to every task and
documents are read once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.words import Words, blocks, mix

SHINGLE_WORDS = 5
BANDS, ROWS = 12, 2
WIDTHS = (1, 2, 4, 8, 16)
SHORT = 32
MAX_TEMPLATE_WORDS = 2_000_000

#: Names, notices and headers as their licenses word them, then the texts in ``license_texts``.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so"
    ),
    **{
        f"{spdx}-name": text
        for spdx, text in {
            "0BSD": "BSD Zero Clause License",
            "AGPL-3.0": "GNU Affero General Public License, version 3.",
            "BSD-2-Clause": "BSD 2-Clause License",
            "BSD-3-Clause": "BSD 3-Clause License",
            "EPL-2.0": "Eclipse Public License, version 2.0",
            "EUPL-1.2": "European Union Public Licence, version 1.2",
            "GPL-2.0": "GNU General Public License, version 2.",
            "GPL-3.0": "GNU General Public License, version 3.",
            "LGPL-2.1": "GNU Lesser General Public License, version 2.1",
            "LGPL-3.0": "GNU Lesser General Public License, version 3.",
            "MPL-2.0": "Mozilla Public License, version 2.0",
        }.items()
    },
    **{
        f"{spdx.replace(' ', '-')}-{how}": text.format(spdx)
        for spdx in ("MIT", "ISC", "BSD", "Boost Software", "Apache")
        for how, text in {
            "licensed": "Licensed under the {} License.", "distributed": "Distributed under the {} License.",
            "terms": "under the terms of the {} License",
        }.items()
        if (spdx, how) != ("Apache", "licensed")  # a part of the notice Apache-2.0
    },
    "Apache-2.0-distributed": "Distributed under the Apache License, Version 2.0.",
    "Apache-2.0-released": "Released under the Apache License, Version 2.0.",
    "Apache-2.0-terms": "under the terms of the Apache License, Version 2.0.",
    **{
        f"{kind.replace(' ', '-')}-{version}{how}": text.format(kind=kind, version=version, name=name)
        for kind, name in {
            "CC BY": "Attribution", "CC BY-SA": "Attribution-ShareAlike", "CC BY-ND": "Attribution-NoDerivatives",
            "CC BY-NC": "Attribution-NonCommercial", "CC BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "CC BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
        }.items()
        for version in ("4.0", "3.0")
        for how, text in {
            "": "Licensed under {kind} {version}.",
            "-name": "under a Creative Commons {name} {version}",
            "-name-the": "under the Creative Commons {name} {version}",
        }.items()
    },
    **{
        f"{spdx}-spdx": f"SPDX-License-Identifier: {spdx}"
        for spdx in (
            "0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "EPL-2.0",
            "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib",
        )
    },
    **{
        f"{spdx}-header": (
            f"This {what} is free software; you can redistribute it and/or modify it under the terms of the "
            f"{name} as published by the Free Software Foundation; either version {version} of the License, or "
            f"(at your option) any later version. This {what} is distributed in the hope that it will be useful, "
            "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
            f"PARTICULAR PURPOSE. See the {name} for more details."
        )
        for spdx, what, name, version in (
            ("AGPL-3.0", "program", "GNU Affero General Public License", "3"),
            ("GPL-2.0", "program", "GNU General Public License", "2"),
            ("GPL-3.0", "program", "GNU General Public License", "3"),
            ("LGPL-2.1", "library", "GNU Lesser General Public License", "2.1"),
            ("LGPL-3.0", "library", "GNU Lesser General Public License", "3"),
        )
    },
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "BSD-header": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."
    ),
    **{
        f"{file.name.removesuffix('.txt')}-text": file.read_text(encoding="utf-8")
        for file in sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name)
        if file.name.endswith(".txt")
    },
}


def _min_hashes(shingles: np.ndarray) -> np.ndarray:
    """One row of hashes per MinHash function."""
    seeds = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return (shingles[None, :] * seeds[:, None]) ^ ((shingles >> np.uint64(29))[None, :] * seeds[::-1, None])


def _band_keys(minima: np.ndarray, width: int) -> np.ndarray:
    """The key of each band of each window: bands by windows."""
    key = np.zeros((BANDS, minima.shape[1]), dtype=np.uint64)
    for r in range(ROWS):
        key = mix(key + minima[r::ROWS] + np.uint64(r + 1))
    band = np.arange(BANDS, dtype=np.uint64) + np.uint64(1000 * width)
    return mix(key ^ mix(band)[:, None])


class Templates:
    """The band keys and distinct shingles of the templates."""

    def __init__(self, texts: Mapping[str, str]) -> None:
        if sum(len(t.split()) for t in texts.values()) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates have more than {MAX_TEMPLATE_WORDS} words")
        self.names = sorted(n for n, t in texts.items() if t.split())
        column = pa.array([texts[n] for n in self.names], pa.string())
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        single: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.shingles: list[np.ndarray] = []
        self.ks: list[int] = []
        for _, block in blocks(column, marks=True):
            for i in range(len(block)):
                k = min(SHINGLE_WORDS, len(block.of(i)))
                number = len(self.shingles)
                if not k:
                    self.shingles.append(np.zeros(0, dtype=np.uint64))
                    self.ks.append(k)
                    continue
                hashes, bounds = block.shingles(k)
                own = hashes[bounds[i] : bounds[i + 1]]
                self.shingles.append(np.unique(own))
                self.ks.append(k)
                if len(own) <= SHORT:
                    single.setdefault(k, []).append((self.shingles[-1], np.full(len(self.shingles[-1]), number)))
                    continue
                # The widest window that a copy is sure to hold whole, half steps apart.
                width = max(w for w in WIDTHS if w + max(w // 2, 1) - 1 <= len(own))
                places = len(own) - width + 1
                values = _min_hashes(own)
                minima = np.min([values[:, j : j + places] for j in range(width)], axis=0)
                keys = _band_keys(minima, width).ravel()
                found.setdefault(width, []).append((keys, np.full(len(keys), number)))
        self.index = {width: self._sorted(pairs) for width, pairs in found.items()}
        self.single = {k: self._sorted(pairs) for k, pairs in single.items()}

    @staticmethod
    def _sorted(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of key and owner, by key."""
        keys = np.concatenate([p[0] for p in pairs])
        owner = np.concatenate([p[1] for p in pairs])
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        return keys[new], owner[new]

    @staticmethod
    def _owners(index: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place in ``wanted``, owner) of every key that is in the index."""
        keys, owner = index
        at = np.searchsorted(keys, wanted)
        hit = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == wanted)
        for i, place in zip(hit, at[hit]):
            while place < len(keys) and keys[place] == wanted[i]:
                yield int(i), int(owner[place])
                place += 1

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray, k: int = SHINGLE_WORDS) -> set[tuple[int, int]]:
        """(text, template) pairs of templates with shingles of k words that share a
        shingle, or for long templates a band of a window."""
        found: set[tuple[int, int]] = set()
        if not len(hashes):
            return found
        text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        if k in self.single:
            found.update((int(text_of[i]), number) for i, number in self._owners(self.single[k], hashes))
        if k < SHINGLE_WORDS or not self.index:
            return found
        values = _min_hashes(hashes)
        for width, index in self.index.items():
            step = max(width // 2, 1)
            first = np.flatnonzero((np.arange(len(hashes)) - bounds[text_of]) % step == 0)
            first = first[first + width <= bounds[text_of[first] + 1]]
            if not len(first):
                continue
            minima = values[:, first]
            for j in range(1, width):
                np.minimum(minima, values[:, first + j], out=minima)
            for band in _band_keys(minima, width):
                found.update((int(text_of[first[i]]), number) for i, number in self._owners(index, band))
        return found

    def verified(self, block: Words) -> list[tuple[int, str, float, int]]:
        """(text, template, containment, word at which its first shingle starts; words as of a plain split)."""
        out = []
        for k in sorted(set(self.ks) - {0}):
            hashes, bounds = block.shingles(k)
            for text, number in self.candidates(hashes, bounds, k):
                own, wanted = hashes[bounds[text] : bounds[text + 1]], self.shingles[number]
                place = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
                hit = wanted[place] == own
                share = len(np.unique(place[hit])) / len(wanted)
                out.append((text, number, share, block.bounds[text] + int(np.argmax(hit))))
        return [
            (text, self.names[number], share, block.place_in_text(word, text))
            for text, number, share, word in sorted(out)
        ]


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] | None = None, percent: int = 80,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The licenses of every document: doc_id, n_licenses, licenses.

    ``licenses`` is an array of name, containment (share of the template's
    distinct shingles that the document holds, ``percent`` / 100 at least) and
    first_word, in order of name.  One row per row of ``docs``; null or empty
    texts, and templates without words, match nothing.  A template of fewer than
    five words is one shingle, and found anywhere in a text.
    """
    known = Templates(NOTICES if templates is None else templates)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    license_type = pa.list_(pa.struct([("name", pa.string()), ("containment", pa.float64()), ("first_word", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for first, block in blocks(batch.column(1), marks=True):
                for text, name, share, word in own.verified(block):
                    if 100 * share >= percent:
                        found[first + text].append({"name": name, "containment": share, "first_word": word})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f) for f in found], pa.int64()), pa.array(found, license_type)],
                names=["doc_id", "n_licenses", "licenses"],
            )

    id_type = dict(chosen.dtypes)["doc_id"]
    return chosen.mapInArrow(
        scan,
        f"doc_id {id_type}, n_licenses bigint, "
        "licenses array<struct<name:string,containment:double,first_word:bigint>>",
    )
