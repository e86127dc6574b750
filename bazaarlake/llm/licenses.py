"""License scans by conditional compression.

Texts are read without line breaks and comment marks. Where one speaks of rights, the words around, as many as a template has on
either side, are compressed with Zstandard alone and with the template as a raw dictionary. Every template that saves enough is
laid over these words; the exact differences in wording decide whether it stands there, and where it begins and ends.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes that a match has at least.
MIN_MATCH = 4
# Share of the compressed words that a template must save before it is laid over them. With LEAST_MATCH of its words in twice as many
# all templates save more, see the tests.
LEAST_REDUCTION = 0.1
# The share of a template's words that must be found in order, and of words in between that it does not have.
LEAST_MATCH, MOST_INSERTED = 0.8, 0.25
# Words beyond the template's own number that are looked at on either side.
MARGIN = 4

# Words that a license notice cannot do without, in lower case; and words of these of which a text holds one.
SIGNS = (
    "licen[sc]e", "copyright", "rights reserved", "permission is hereby granted", "permission to use, copy",
    "redistribution and use", "public domain", "creative commons", "cc by", "spdx",
)
SIGN_WORDS = r"licen[sc]e|copyright|reserved|permission|redistribution|domain|creative|\bcc\b|spdx"
# Marks of comments and quotes at the ends of lines.
LINE_START = re.compile(r"(?m)^[ \t]*(?:/\*+!?|\*+/?|//+!?|#+!?|--+|;+|%+|<!--+|>+|\|+|(?:REM|rem|dnl|\.\.)(?=[ \t]|$))+[ \t]*")
LINE_END = re.compile(r"(?m)[ \t]*(?:\*+/|--+>|\*+|#+|\|)[ \t]*$")

# Wording of license notices.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer.",
    "BSD-notice": "Released under the BSD License.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-4.0-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "This work is dedicated to the public domain.",
    "All-rights-reserved": "All rights reserved.",
}
SPDX = (
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only", "ISC", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "Unlicense",
)
TEMPLATES |= {f"SPDX-{name}": f"SPDX-License-Identifier: {name}" for name in SPDX}

FOUND = "doc_id long, block long, license string, reduction double, matched double, differences string, text string"

WORD = re.compile(r"\w+(?:[.-]\w+)*")
SIGN = re.compile("|".join(s.replace(" ", r"\s+") for s in SIGNS), re.I)


class Notice(NamedTuple):
    license: str
    reduction: float
    matched: float
    differences: str
    #: The words of the text from ``start`` to ``end`` are the notice, of which ``score`` are the template's, less those in between.
    start: int
    end: int
    score: int


def plain_text(text: str) -> str:
    """The text without the marks that comments and quotes have at the ends of lines."""
    return LINE_END.sub("", LINE_START.sub("", text))


def fit(wanted: list[int], words: np.ndarray) -> tuple[int, int, int, int]:
    """Where all of ``wanted`` fits best into ``words``: (start, end, equal words, words in between), with fewest edits.

    Words may be left out of either side; before the start and behind the end they cost nothing.
    """
    width = len(words) + 1
    places = np.arange(width)
    costs = np.zeros((len(wanted) + 1, width), np.int64)
    for i, word in enumerate(wanted):
        best = costs[i] + 1
        best[1:] = np.where(words == word, np.minimum(costs[i, :-1], best[1:]), best[1:])
        costs[i + 1] = places + np.minimum.accumulate(best - places)
    end = at = int(costs[-1].argmin())
    i, equal, inserted = len(wanted), 0, 0
    while i:
        if at and words[at - 1] == wanted[i - 1] and costs[i, at] == costs[i - 1, at - 1]:
            i, at, equal = i - 1, at - 1, equal + 1
        elif costs[i, at] == costs[i - 1, at] + 1:
            i -= 1
        else:
            at, inserted = at - 1, inserted + 1
    return at, end, equal, inserted


class Scanner:
    """Templates as compression dictionaries."""

    def __init__(self, templates: Mapping[str, str], least_reduction: float = LEAST_REDUCTION):
        self.least_reduction = least_reduction
        self.templates = {name: WORD.findall(text.lower()) for name, text in templates.items()}
        self.number: dict[str, int] = {}
        self.wanted = {name: [self.number.setdefault(w, len(self.number)) for w in words] for name, words in self.templates.items()}
        # The fast strategy with a target length leaves what it does not match as it is: sizes of short texts can be compared.
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_FAST, target_length=1, min_match=MIN_MATCH, window_log=17, hash_log=14, chain_log=6, search_log=1,
            write_content_size=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        self.plain = zstandard.ZstdCompressor(compression_params=settings)
        raw = lambda words: zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.given = {name: zstandard.ZstdCompressor(dict_data=raw(words), compression_params=settings) for name, words in self.templates.items()}

    def reduction(self, words: list[str], name: str) -> float:
        """The share of the compressed words that a template as dictionary saves."""
        data = " ".join(words).encode("utf-8", "surrogatepass")
        return 1 - len(self.given[name].compress(data)) / len(self.plain.compress(data))

    def at(self, words: list[str], numbers: np.ndarray, low: int, hit: int, high: int) -> Notice | None:
        """The notice at a word, between two others: of all that are confirmed the one with most of its template's words.

        Equal ones go to the higher share of the template, then to the higher reduction, then to the first name.
        """
        ranked = []
        for name, wanted in self.wanted.items():
            reach = len(wanted) + MARGIN
            start, end = max(low, hit - reach), min(high, hit + reach)
            reduction = self.reduction(words[start:end], name)
            if reduction >= self.least_reduction:
                ranked.append((-reduction, name, start, end))
        best = None
        for reduction, name, start, end in sorted(ranked):
            wanted = self.wanted[name]
            a, b, equal, inserted = fit(wanted, numbers[start:end])
            a, b = a + start, b + start
            if equal < LEAST_MATCH * len(wanted) or inserted > max(1, MOST_INSERTED * len(wanted)) or not a <= hit < b:
                continue
            found = Notice(name, -reduction, equal / len(wanted), "", a, b, equal - inserted)
            if best is None or (found.score, found.matched) > (best.score, best.matched):
                best = found
        return best and best._replace(differences=self.differences(words[best.start : best.end], best.license))

    def differences(self, words: list[str], name: str) -> str:
        """What a notice words otherwise than its template."""
        wanted = self.templates[name]
        steps = difflib.SequenceMatcher(None, wanted, words, autojunk=False).get_opcodes()
        return "; ".join(f"-{' '.join(wanted[i1:i2])} +{' '.join(words[j1:j2])}" for kind, i1, i2, j1, j2 in steps if kind != "equal")

    def notices(self, text: str) -> list[tuple[str, Notice]]:
        """(text, notice) of every notice, in order; no word belongs to two."""
        text = plain_text(text)
        hits = [m.start() for m in SIGN.finditer(text)]
        if not hits:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        starts = [a for a, _ in spans]
        words = [text[a:b].lower() for a, b in spans]
        numbers = np.array([self.number.get(w, -1) for w in words], np.int64)
        hits = sorted({max(0, bisect_right(starts, h) - 1) for h in hits})
        found, low = [], 0
        for hit in hits:
            if hit < low:
                continue
            notice = self.at(words, numbers, low, hit, len(words))
            if notice:
                shown = " ".join(text[spans[notice.start][0] : spans[notice.end - 1][1]].split())
                found.append((shown, notice))
                low = notice.end
        return found


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """One row for each license notice of each document (doc_id, text): FOUND.

    ``block`` counts the document's notices from 0, ``differences`` lists what the notice words otherwise. Notices may be wrapped and
    stand in comments. Null and empty texts and texts without a notice give no row; repeated rows give theirs again. Every whole
    text is searched; nothing is shuffled.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows += [(doc_id, number, *n[:4], shown) for number, (shown, n) in enumerate(scanner.notices(text))]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.string(), pa.string()]
            names = [part.split()[0] for part in FOUND.split(", ")]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return docs.select("doc_id", "text").filter(F.col("text").rlike(f"(?i){SIGN_WORDS}")).mapInArrow(scan, FOUND)
