"""License scans: MinHash bands over overlapping windows retrieve templates; exact shingle containment verifies.

A text's words (A-Z lower-cased, without marks at their ends) are cut into overlapping windows for each size class of
template. A template with m shingles belongs to the class W, the least power of two with W >= m; windows of the class
have 1.25 W shingles and start every W/4, so one of them holds any occurrence of the template whole and has a Jaccard
similarity of at least 0.4 with it. With one row a band, a template that occurs whole is missed by all ``bands`` bands
with a probability under 0.6^bands (2.8e-4 for 16); an occurrence of which a fifth of the shingles is changed still
has 0.8 * 0.4 of similarity or more, and is missed with a probability under 0.68^bands. Band keys of windows are
looked up in the templates' table, which is a parameter and not data.

Each retrieved template is verified around its windows by exact shingles, from left to right: wherever the last 2 m
shingles of the text hold ``containment`` of the template's, an occurrence begins at the last place from which they do;
it goes on with shingles that it has not had yet, up to 2 m from its begin, and the next one is looked for behind it. So
every occurrence is a match of its own, however near to the next.

Edge cases: null and empty texts, and texts shorter than every template, match nothing and still give a row; texts
are scanned whole, in pieces that overlap by more than the largest occurrence; repeated rows are scanned each for
itself; a template with fewer words than a shingle is one shingle; only the id and the text are read, so other columns
of any name do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionforge.llm.common import quoted

WIDTH = 5
BANDS = 16
CONTAINMENT = 0.8
#: Words of a text that are scanned at a time; pieces overlap by twice the largest window.
PIECE = 1 << 16
#: Marks that are cut from the ends of words.
MARKS = b".,;:!?\"'()[]{}<>*#/-_=`"

#: What public licenses are declared by in texts, notices and short licenses' own words.
TEMPLATES = {
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT-whole": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def tokens(text: bytes) -> list[bytes]:
    return [w.strip(MARKS) or w for w in text.lower().split()]


def shingles(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Hashes of the shingles in order; of fewer words the one of all."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    if len(h) < width:
        return combine([h[i : i + 1] for i in range(len(h))])
    return combine([h[i : len(h) - width + 1 + i] for i in range(width)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers with good avalanche (splitmix64's last step)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + c)
    return out


def permuted(h: np.ndarray, band: int) -> np.ndarray:
    return mix(h + np.uint64(0x9E3779B97F4A7C15 * (band + 1) % (1 << 64)))


@dataclass
class Class:
    """The templates of one size class: their shingles, and their band keys in order."""

    size: int
    ids: list[str]
    sets: list[np.ndarray]
    keys: list[np.ndarray]
    owners: list[np.ndarray]


def prepare(templates: Mapping[str, str], width: int = WIDTH, bands: int = BANDS) -> list[Class]:
    by_size: dict[int, list[tuple[str, np.ndarray]]] = {}
    for name, text in sorted(templates.items()):
        own = np.unique(shingles(tokens(text.encode()), width))
        if len(own):
            by_size.setdefault(max(4, 1 << (len(own) - 1).bit_length()), []).append((name, own))
    out = []
    for size, members in sorted(by_size.items()):
        mins = [np.array([permuted(own, b).min() for _, own in members], np.uint64) for b in range(bands)]
        order = [np.argsort(m, kind="stable") for m in mins]
        out.append(Class(size, [n for n, _ in members], [own for _, own in members], [m[o] for m, o in zip(mins, order, strict=True)], order))
    return out


def sliding_min(x: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The least of x[s : s + length] for each start."""
    step = length // 5  # windows are five quarters of W and start every quarter
    pad = np.full(-len(x) % step, np.iinfo(np.uint64).max, np.uint64)
    quarters = np.concatenate([x, pad]).reshape(-1, step).min(1)
    q = np.concatenate([quarters, np.full(5, np.iinfo(np.uint64).max, np.uint64)])
    at = starts // step
    return np.minimum.reduce([q[at + i] for i in range(5)])


def scan_hashes(h: np.ndarray, valid: np.ndarray, bounds: np.ndarray, classes: list[Class], share: float) -> list[tuple[int, str, int, int, float]]:
    """(segment, template, first shingle, past the last, containment) of all matches in the shingle hashes of
    segments that lie one after the other; bounds has where they start, and the end. Shingles that are not valid
    reach over a segment's end."""
    found: list[tuple[int, str, int, int, float]] = []
    perms = [np.where(valid, permuted(h, b), np.iinfo(np.uint64).max) for b in range(len(classes[0].keys))] if classes else []
    for c in classes:
        step = c.size // 4
        starts = np.arange(0, len(h), step)
        hits: set[tuple[int, int, int]] = set()
        for perm, keys, owners in zip(perms, c.keys, c.owners, strict=True):
            least = sliding_min(perm, starts, 5 * step)
            lo = np.searchsorted(keys, least, "left")
            for w in np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == least).tolist():
                first, end = int(starts[w]), int(starts[w]) + 5 * step
                s0, s1 = np.searchsorted(bounds, first, "right") - 1, np.searchsorted(bounds, min(end, len(h)), "left")
                for k in range(lo[w], np.searchsorted(keys, least[w], "right")):
                    hits.update((s, int(owners[k]), w) for s in range(s0, s1))
        near: dict[tuple[int, int], list[list[int]]] = {}
        for s, t, w in sorted(hits):
            a, z = max(int(bounds[s]), int(starts[w]) - 2 * c.size), min(int(bounds[s + 1]), int(starts[w]) + 5 * step + 2 * c.size)
            regions = near.setdefault((s, t), [])
            if regions and a <= regions[-1][1]:
                regions[-1][1] = max(z, regions[-1][1])
            else:
                regions.append([a, z])
        for (s, t), regions in near.items():
            for a, z in regions:
                at = a + np.flatnonzero(np.isin(h[a:z], c.sets[t]) & valid[a:z])
                found += [(s, c.ids[t], *o) for o in occurrences(at.tolist(), h[at].tolist(), len(c.sets[t]), share)]
    return found


def occurrences(at: list[int], shingle: list[int], size: int, share: float) -> list[tuple[int, int, float]]:
    """(begin, past the end, containment) of a template's occurrences among its shingles in a text, in order of place."""
    need, reach = share * size, 2 * size
    out: list[tuple[int, int, float]] = []
    held: Counter[int] = Counter()
    i = j = 0
    while j < len(at):
        held[shingle[j]] += 1
        j += 1
        while at[j - 1] - at[i] >= reach or held[shingle[i]] > 1:  # what is too far, or comes again, does not begin it
            held[shingle[i]] -= 1
            if not held[shingle[i]]:
                del held[shingle[i]]
            i += 1
        if len(held) >= need:
            while j < len(at) and at[j] - at[i] < reach and shingle[j] not in held:
                held[shingle[j]] += 1
                j += 1
            out.append((at[i], at[j - 1] + 1, len(held) / size))
            held.clear()
            i = j
    return out


def scan_texts(texts: list[bytes], classes: list[Class], share: float = CONTAINMENT, width: int = WIDTH, piece: int = PIECE) -> list[list[tuple[str, int, int, float]]]:
    """For each whole text (template, first word, past the last word, containment) of all matches in order of place.
    Short texts are scanned together, long ones in overlapping pieces."""
    overlap = 8 * max((c.size for c in classes), default=0) + width
    out: list[dict[str, list[tuple[str, int, int, float]]]] = [{} for _ in texts]
    group: list[tuple[int, int, list[bytes]]] = []

    def flush() -> None:
        flat = [w for _, _, words in group for w in words]
        sizes = np.array([len(words) for _, _, words in group])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        if not flat:
            return group.clear()
        own = np.array([xxhash.xxh64_intdigest(w) for w in flat] + [0] * (width - 1), np.uint64)
        h = combine([own[i : i + len(flat)] for i in range(width)])
        valid = np.arange(len(flat)) + width <= np.repeat(bounds[1:], sizes)
        for i, (_, _, words) in enumerate(group):
            if 0 < len(words) < width:  # one shingle of all
                h[bounds[i]], valid[bounds[i]] = shingles(words, width)[0], True
        for s, name, a, z, p in scan_hashes(h, valid, bounds, classes, share):
            row, offset, words = group[s]
            a, z = (offset + x - int(bounds[s]) for x in (a, z))
            # What a piece and the next one both see is taken from the first; behind it, from the next.
            ours = out[row].setdefault(name, [])
            if not ours or a >= ours[-1][2] - width + 1:
                ours.append((name, a, z + min(width, len(words)) - 1, p))
        group.clear()

    held = 0
    for row, text in enumerate(texts):
        words = tokens(text)
        for at in range(0, len(words), piece):
            group.append((row, at, words[at : at + piece + overlap]))
            held += len(group[-1][2])
            if held >= piece:
                flush()
                held = 0
    flush()
    return [sorted((m for ms in own.values() for m in ms), key=lambda m: (m[1], m[0])) for own in out]


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, share: float = CONTAINMENT, width: int = WIDTH, bands: int = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, matches (license, start_word, end_word, containment), in order of place."""
    classes = prepare(templates, width, bands)
    kind = dict(docs.dtypes)[id_col]
    match = pa.struct([("license", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("containment", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("license", "start_word", "end_word", "containment")
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                found = scan_texts([t or b"" for t in part.column(1).to_pylist()], classes, share, width)
                rows = [[dict(zip(names, m, strict=True)) for m in ms] for ms in found]
                yield pa.record_batch([part.column(0), pa.array(rows, pa.list_(match))], names=["doc_id", "matches"])

    schema = f"doc_id {kind}, matches array<struct<license:string,start_word:bigint,end_word:bigint,containment:double>>"
    return docs.select(docs[quoted(id_col)].alias("doc_id"), docs[quoted(text_col)].cast("string").cast("binary").alias("text")).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_matches, licenses (distinct, in order), matches as JSON."""
    d = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return d.select(
        "doc_id", F.size("matches").alias("n_matches"), F.array_join(F.sort_array(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.to_json("matches").alias("matches"),
    )
