"""License scans: MinHash bands over text windows retrieve templates, shingle containment verifies them.

Everything runs as DataFrame functions. A text's words are runs of letters and digits in small letters, its shingles
three words. A template of s shingles is looked for in windows of its size class (``size_class``: s, rounded up by at
most a fourth), which start every eighth of that. Where the template stands whole, some window has it but for one
sixteenth at each end, so their Jaccard likeness is at least 0.6 after rounding; where a fifth of its shingles is gone,
0.45. A band is one MinHash value; with ``BANDS`` of them a template that stands whole is missed with a probability
below 0.4 ** 16, and one that is only just contained with one below 0.55 ** 16, about 7 in 100,000. Texts that share no
shingle with any template are told first, by one lookup a text: they can't contain four fifths of one.

What was retrieved for a text is verified over all of it: from each shingle of the template (a hit), the distinct hits
in the next s + s/4 shingles must be ``CONTAINED`` of the template's. Overlapping places that pass are one match, from
the first word of its first hit to the last word of its last. The list of templates is a bounded parameter and becomes
literals; nothing is shuffled, joined or collected.

Nulls and empty texts, and those of fewer than three words, match nothing. Repeated rows give repeated rows, an empty
table an empty one; columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
import struct
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.expressions import islands, let, literal, places

SHINGLE = 3
BANDS = 16
CONTAINED = 0.8
WORD = "[\\p{L}\\p{N}]+"
SEED = 42

#: Notices as their licenses word them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-2.0-disclaimer": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "lgpl-3.0-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "warranty-disclaimer": "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
}


def words(text: str) -> list[str]:
    """A template's words; templates are ASCII."""
    return re.findall("[a-z0-9]+", text.lower())


def shingles(text: str) -> list[str]:
    """A template's distinct shingles, in order."""
    found = words(text)
    return list(dict.fromkeys(" ".join(found[i : i + SHINGLE]) for i in range(len(found) - SHINGLE + 1)))


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _hash(shingle: str) -> int:
    """Spark's xxhash64 of the shingle's words."""
    from xxhash import xxh64_intdigest

    seed = SEED
    for word in shingle.split(" "):
        seed = xxh64_intdigest(word.encode(), seed)
    return _signed(seed)


def _band(value: int, band: int) -> int:
    """Spark's xxhash64 of a shingle's hash with a band's bits turned over."""
    from xxhash import xxh64_intdigest

    return _signed(xxh64_intdigest(struct.pack("<q", value ^ _turned(band)), SEED))


def _turned(band: int) -> int:
    from xxhash import xxh64_intdigest

    return _signed(xxh64_intdigest(struct.pack("<q", band), 0))


def size_class(size: int) -> int:
    """``size``, rounded up to three binary digits."""
    step = 1 << max(0, size.bit_length() - 3)
    return ceil(size / step) * step


def _retrieved(templates: dict[str, str]) -> str:
    """SQL for the numbers of templates that share a band with a window of ``sh``, the shingle hashes of a text.

    A band can only agree if the window holds a shingle of some template, so only windows about those are looked at.
    """
    by_class: dict[int, list[tuple[int, list[int]]]] = {}
    for number, text in enumerate(templates.values()):
        own = [_hash(s) for s in shingles(text)]
        by_class.setdefault(size_class(len(own)), []).append((number, [min(_band(h, b) for h in own) for b in range(BANDS)]))
    found = []
    for size, members in sorted(by_class.items()):
        step = max(1, size // 8)
        starts = f"array_distinct(flatten(transform(p, i -> transform(sequence(greatest(0, i - {size - 1}) div {step}, i div {step}), j -> j * {step} + 1))))"
        lows = f"transform(hb, x -> transform(w, s -> array_min(slice(x, s, {size}))))"
        picks = [f"if(exists(zip_with(z, array({', '.join(f'{x}L' for x in own)}), (a, b) -> array_contains(a, b)), o -> o), array({number}), cast(array() as array<int>))" for number, own in members]
        found.append(let("w", starts, let("z", lows, f"concat({', '.join(picks)})")))
    bands = f"transform(array({', '.join(f'{_turned(b)}L' for b in range(BANDS))}), k -> transform(sh, h -> xxhash64(h ^ k)))"
    hits = let("own", f"array_intersect(sh, array({_known(templates)}))", "filter(sequence(0, size(sh) - 1), i -> array_contains(own, sh[i]))")
    return let("p", hits, let("hb", bands, f"concat({', '.join(found)})"))


def _known(templates: dict[str, str]) -> str:
    """The hashes of all templates' shingles, listed as SQL."""
    return ", ".join(f"{h}L" for h in sorted({_hash(s) for t in templates.values() for s in shingles(t)}))


def _verified(templates: dict[str, str]) -> str:
    """SQL for the matches (name, from, to: places of words) of the templates numbered in ``_retrieved``."""
    table = []
    for name, text in templates.items():
        own = shingles(text)
        table.append(f"named_struct('name', {literal(name)}, 'own', array({', '.join(map(literal, own))}), 'least', {ceil(CONTAINED * len(own) - 1e-9)}, 'span', {len(own) + ceil(len(own) / 4)})")
    merged = islands("filter(w, x -> x.n >= t.least)", "from", "to", ">=")
    window = let("q", "filter(slice(h, j + 1, t.span), x -> x < p + t.span)", f"named_struct('from', p, 'to', array_max(q) + {SHINGLE}, 'n', size(array_distinct(transform(q, x -> ss[x]))))")
    hits = "filter(sequence(0, size(ss) - 1), i -> array_contains(t.own, ss[i]))"
    matches = let("h", hits, let("w", f"transform(h, (p, j) -> {window})", f"transform({merged}, m -> named_struct('name', t.name, 'from', m.at, 'to', m.to))"))
    strings = f"transform(sequence(0, size(_words) - {SHINGLE}), i -> concat_ws(' ', {', '.join(f'_words[i+{k}]' for k in range(SHINGLE))}))"
    return let("ss", strings, f"flatten(transform(_retrieved, r -> {let('t', f'element_at(array({", ".join(table)}), r + 1)', matches)}))")


def find(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``docs`` with ``matches``: array of struct<start, name, end> in order; places are code points, the end exclusive."""
    if any(not shingles(t) for t in templates.values()):
        raise ValueError(f"a template needs {SHINGLE} words")
    text = docs.withColumn("_text", F.col("text")).withColumn("text", F.coalesce("text", F.lit("")))
    cut = text.withColumn("_words", F.expr(f"transform(regexp_extract_all(text, {literal(WORD)}, 0), w -> lower(w))"))
    hashes = f"transform(sequence(0, size(_words) - {SHINGLE}), i -> xxhash64({', '.join(f'_words[i+{k}]' for k in range(SHINGLE))}))"
    none = "cast(array() as array<bigint>)"
    hashed = cut.withColumn("_hashes", F.expr(f"if(size(_words) < {SHINGLE}, {none}, {hashes})"))
    maybe = hashed.withColumn("_hashes", F.expr(f"if(arrays_overlap(_hashes, array({_known(templates)})), _hashes, {none})"))
    retrieved = maybe.withColumn("_retrieved", F.expr(f"if(size(_hashes) = 0, cast(array() as array<int>), {let('sh', '_hashes', _retrieved(templates))})"))
    kind = "array<struct<name:string,from:int,to:int>>"
    verified = retrieved.withColumn("_matches", F.expr(f"if(size(_retrieved) = 0, cast(array() as {kind}), {_verified(templates)})"))
    placed = let("p", places(WORD), "transform(_matches, m -> named_struct('start', p[m.from].at, 'name', m.name, 'end', p[m.to - 1].to))")
    found = f"if(size(_matches) = 0, cast(array() as array<struct<start:int,name:string,end:int>>), array_sort({placed}))"
    return verified.withColumn("matches", F.expr(found)).withColumn("text", F.col("_text")).drop("_text", "_words", "_hashes", "_retrieved", "_matches")


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_matches and matches (``name:start:end`` by start, then name, comma-joined) of every row."""
    found = find(docs.select("doc_id", "text"), templates)
    listed = F.expr("array_join(transform(matches, m -> concat_ws(':', m.name, m.start, m.end)), ',')")
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), listed.alias("matches"))
