"""License scans by conditional compression.

Method: around each word that license notices use, windows of about each template's length
are cut, across line ends: the template is laid with each of its own such words on the one
in the text, and given no, some or its own length of slack on either side; the line's block
of words is one window more.  Each window is compressed alone and with the templates as raw
zstandard dictionaries; templates are ranked by how much the size falls.  The winner is
confirmed by the exact wording differences: words of the template that the window lacks
(after the best alignment of word sequences), and whether every word that tells this license
from its kin is there.  Of winners that overlap, the one with most words in common, less the
missing and the extra ones, stays; all others are reported.

Templates that a window's words can't confirm are not compressed with it, which changes no
verdict.  Defined results: null or empty texts have no candidates; texts and lines of any length are
searched whole, in time that grows with their length; line ends, with comment marks after them, count
as a space; of overlapping winners with as many words in common the one that saves more bytes stays,
then the one with the larger reduction, then the first; ``n_candidates`` counts the blocks of words in
a line around triggers; repeated rows each get a row; the templates are a parameter; other columns
are ignored; an empty table gives no rows.  Nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K

#: Short public wordings of license notices, by license.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely."),
    ("WTFPL", "Do What The Fuck You Want To Public License, Version 2."),
    ("Artistic-2.0", "Licensed under the Artistic License 2.0."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("ODbL-1.0", "This database is made available under the Open Database License."),
    ("GFDL-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Licensed under MIT."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Licensed under the Mozilla Public License 2.0."),
    ("GPL-2.0", "This code is licensed under GPLv2."),
    ("GPL-3.0", "This code is licensed under GPLv3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
]
#: Words that make a line a candidate, and words that name a license.
TRIGGER = rb"licen[cs]|copyright|all rights reserved|permission is|is hereby granted|redistribution and use|creative commons|public domain".replace(b" ", rb"[^0-9a-z\x80-\xff]+")
NAMING = {"apache", "mit", "gnu", "general", "lesser", "affero", "public", "mozilla", "cc", "by", "nc", "nd", "sa", "cc0", "creative", "commons", "redistribution", "rights", "reserved", "permission", "1", "2", "3", "4", "0", "attribution", "noncommercial", "noderivatives", "sharealike", "neither", "nor", "eclipse", "boost", "artistic", "sil", "font", "database", "documentation", "library", "unencumbered", "fuck", "bsd", "clause", "gpl", "gplv2", "gplv3", "lgpl", "mpl", "spdx"}
#: Words on either side of a trigger that belong to its block in a line.
AROUND = 40
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: A line end with the comment marks behind it, or white space: one space in a window.
_BREAK = re.compile(rb"\s*\n[\s*#/;>-]*|\s{2,}")
_SCHEMA = "doc_id bigint, n_candidates bigint, found array<struct<license: string, start: bigint, end: bigint, reduction: double, missing: bigint, extra: bigint>>"


def common_words(a: list[bytes], b: list[bytes]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``; where ``b`` stands whole, there."""
    for k in (k for k, w in enumerate(a[: len(a) - len(b) + 1]) if b and w == b[0]):
        if a[k : k + len(b)] == b:
            return list(range(k, k + len(b)))
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    places = []
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            places.append(i)
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return places


def closest_words(a: list[bytes], b: list[bytes]) -> list[int]:
    """:func:`common_words` from the begin or from the end, whichever spans less of ``a``."""
    ahead, back = common_words(a, b), [len(a) - 1 - i for i in reversed(common_words(a[::-1], b[::-1]))]
    return min(ahead, back, key=lambda places: places[-1] - places[0] if places else 0)


#: Surroundings of triggers (some 20 kB each) whose windows a task remembers.
AROUND_KEPT = 256


class Scanner:
    """Templates with their compressors."""

    def __init__(self, templates: list[tuple[str, str]], max_missing: float, min_reduction: float):
        self.max_missing, self.min_reduction = max_missing, min_reduction
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
        self.templates, self.laid = [], []
        for name, wording in templates:
            text = wording.encode().lower()
            # a raw dictionary needs a few bytes of its own before the wording
            raw = zstandard.ZstdCompressionDict(b"\n" * 8 + text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words = _WORD.findall(text)
            places = [(m.group()[:5], len(_WORD.findall(text[: m.start()]))) for m in re.finditer(TRIGGER, text)]
            self.laid.append(places)
            self.templates.append((name, words, {w.decode() for w in words} & NAMING, zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)))
        #: No window goes further from its trigger.
        self.reach = max([2 * len(words) for _, words, _, _ in self.templates], default=0)
        self.judge = lru_cache(maxsize=50_000)(self._judge)

    def _may_confirm(self, i: int, words: set[bytes]) -> bool:
        """Whether a window of these words can hold enough of the template."""
        _, wording, naming, _ = self.templates[i]
        return len(set(wording) - words) <= self.max_missing * len(wording) and all(w.encode() in words for w in naming)

    def windows(self, kind: bytes, near: list[bytes], at: int) -> set[tuple[int, int]]:
        """Begin and end, in ``near``, of the windows of the trigger of this kind at word ``at``."""
        found = set()
        for i, (_, wording, _, _) in enumerate(self.templates):
            n = len(wording)
            for own, q in self.laid[i]:
                begin = at - q
                if own == kind and self._may_confirm(i, set(near[max(0, begin - n) : max(0, begin + 2 * n)])):
                    slack = (0, -(-n // 4), n)
                    found |= {(max(0, begin - x), min(len(near), begin + n + y)) for x in slack for y in slack}
        return found

    def _judge(self, block: bytes) -> tuple | None:
        """(license, reduction, bytes saved, missing, extra, first word, end word) of a window, or None."""
        words = _WORD.findall(block)
        there = set(words)
        ranked = sorted((len(self.templates[i][3].compress(block)), -len(self.templates[i][1]), i) for i in range(len(self.templates)) if self._may_confirm(i, there))
        alone = len(self.plain.compress(block)) if ranked else 0
        for size, _, i in ranked:
            reduction = 1 - size / alone
            if reduction < self.min_reduction:
                return None
            name, wording, naming, _ = self.templates[i]
            places = closest_words(words, wording)
            missing = len(wording) - len(places)
            there = {words[p].decode(errors="replace") for p in places}
            if places and missing <= self.max_missing * len(wording) and naming <= there:
                return name, reduction, alone - size, missing, places[-1] + 1 - places[0] - len(places), places[0], places[-1] + 1
        return None


def _apart(verdicts: set[tuple]) -> list[tuple]:
    """The best of the (license, reduction, saved, missing, extra, first word, end word) that overlap, in order."""
    begins, kept = [], {}  # the kept ones don't overlap, so only the neighbours of a place can
    for v in sorted(verdicts, key=lambda v: (2 * v[4] + v[3] - (v[6] - v[5]), -v[2], -v[1], v[5], v[0])):
        at = bisect_left(begins, v[6])  # the last that begins before its end
        if at and kept[begins[at - 1]][6] > v[5]:
            continue
        insort(begins, v[5])
        kept[v[5]] = v
    return [kept[x] for x in begins]


def _rows(templates, max_missing, min_reduction):
    def rows(batches):
        scanner, trigger, around = Scanner(templates, max_missing, min_reduction), re.compile(TRIGGER), {}
        for batch in batches:
            for lo, hi, buf, offs in K.chunks(batch.column(1)):
                n = hi - lo
                text = buf.tobytes().lower()
                count, found, verdicts, done = np.zeros(n, dtype=np.int64), [[] for _ in range(n)], {}, -1
                start, end, doc = K.words(buf, offs, K.ALNUM)
                bounds = K.bounds(doc, n)
                for m in trigger.finditer(text):
                    own = int(np.searchsorted(offs, m.start(), "right")) - 1
                    if m.end() > offs[own + 1]:
                        continue
                    first, last = int(bounds[own]), int(bounds[own + 1])
                    at = int(np.searchsorted(start, m.start(), "right")) - 1
                    # the block: words of the line, or of the lines that the trigger is in
                    a, b = max(first, at - AROUND), min(last, at + AROUND)
                    begin, stop = text.rfind(b"\n", int(start[a]), m.start()), text.find(b"\n", m.end(), int(end[b - 1]))
                    a = a if begin < 0 else int(np.searchsorted(start, begin))
                    b = b if stop < 0 else int(np.searchsorted(start, stop))
                    if m.start() >= done:
                        count[own] += 1
                        done = int(end[b - 1])
                    x, y = max(first, at - scanner.reach), min(last, at + scanner.reach)
                    place = m.group()[:5], text[start[x] : end[y - 1]], at - x  # texts that repeat a notice repeat its surroundings
                    if place not in around:
                        if len(around) >= AROUND_KEPT:
                            around.clear()
                        around[place] = scanner.windows(place[0], [text[s:e] for s, e in zip(start[x:y].tolist(), end[x:y].tolist())], at - x)
                    for a, b in {(a, b)} | {(x + a, x + b) for a, b in around[place]}:
                        if verdict := scanner.judge(_BREAK.sub(b" ", text[start[a] : end[b - 1]])):
                            *what, i, j = verdict
                            verdicts.setdefault(own, set()).add((*what, a + i, a + j))
                points = np.concatenate([np.zeros(1, np.int64), np.cumsum((buf & 0xC0) != 0x80)]) if verdicts else None
                for own, each in verdicts.items():
                    for name, reduction, _, missing, extra, a, b in _apart(each):
                        first, last = (int(points[x] - points[offs[own]]) for x in (start[a], end[b - 1]))
                        found[own].append({"license": name, "start": first, "end": last, "reduction": round(reduction, 6), "missing": missing, "extra": extra})
                kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reduction", pa.float64()), ("missing", pa.int64()), ("extra", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(count), pa.array(found, kind)], ["doc_id", "n_candidates", "found"])

    return rows


def license_scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, max_missing: float = 0.2, min_reduction: float = 0.25) -> DataFrame:
    """(doc_id, n_candidates, found) of every document row; spans are in code points."""
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_rows(templates, max_missing, min_reduction), _SCHEMA)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: candidate blocks, confirmed licenses and their spans."""
    found = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.array_join(F.array_sort(F.array_distinct("found.license")), ",")
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x.license, x.start.cast("string"), x.end.cast("string"), x.missing.cast("string"), x.extra.cast("string"))), ",")
    return found.select("doc_id", "n_candidates", F.size("found").cast("bigint").alias("n_confirmed"), names.alias("licenses"), spans.alias("spans"))
