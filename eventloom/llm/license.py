"""License scans by conditional compression against license texts.

A candidate block is compressed alone and with each template as a raw zstandard dictionary; the relative
size reductions rank the templates, and the winner must then agree word for word up to a few differences.
Candidates are the lines around cues and, wherever a cue stands, windows of words as long as a template and
placed so that the cue is where the template has one: across line breaks, and inside lines of any length.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Public license notices, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
        " and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    "BSD-3-Clause": (
        "Licensed under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met:",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.",),
    "CC0-1.0": ("Released into the public domain under CC0 1.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
CUES = ("licens", "licenc", "permission is hereby", "redistribut", "public domain", "free software", "creative commons", "cc by", "cc0")
MIN_REDUCTION = 0.3  # of the compressed size, by the best template
MAX_DIFFERENCE = 0.15  # words that differ, of the template's
MIN_COMMON = 0.25  # of the template's words in a window, below which compressing it is of no use
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_ANY_WORD = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")
_CUE = re.compile("|".join(cue.replace(" ", "[^A-Za-z0-9]+") for cue in CUES), re.IGNORECASE)
RESULT = (
    "doc_id bigint, start bigint, length bigint, license_id string, reduction double, words_missing array<string>,"
    " words_changed array<string>, confirmed boolean, block string"
)


class Scanner:
    """Compressors for all templates, made once per task."""

    def __init__(self, templates: dict[str, tuple[str, ...]]) -> None:
        import zstandard as z

        settings = z.ZstdCompressionParameters.from_level(19, write_checksum=0, write_content_size=0, write_dict_id=0)
        self.plain = z.ZstdCompressor(compression_params=settings)
        self.known = [
            (name, _WORD.findall(text.lower()), z.ZstdCompressor(compression_params=settings, dict_data=z.ZstdCompressionDict(_plain(text), dict_type=z.DICT_TYPE_RAWCONTENT)))
            for name, texts in sorted(templates.items())
            for text in texts
        ]
        # For each template its words as a bag, and which of its words begin cues.
        self.bags = [Counter(wanted) for _, wanted, _ in self.known]
        self.cues = [_cue_words(text) or [0] for _, texts in sorted(templates.items()) for text in texts]
        self.seen: dict[tuple[int, str], float] = {}
        self.judged: dict[str, tuple | None] = {}

    def notices(self, text: str) -> list[tuple[int, str, tuple]]:
        """(start, block, judgement) of the notices of a text, in order; none overlaps another.

        Of overlapping candidates the confirmed ones come first, then those that agree with a template in
        more words, differ in fewer, reduce more, are shorter.
        """
        found = []
        for start, block in candidate_blocks(text):
            if block not in self.judged:
                if len(self.judged) > 10_000:
                    self.judged.clear()
                self.judged[block] = self.judge(block)
            if self.judged[block]:
                found.append((start, block, self.judged[block]))
        if found or _CUE.search(text):
            found += self._windows(text)

        def rank(x: tuple[int, str, tuple]) -> tuple:
            name, reduction, missing, changed, confirmed, agreed = x[2]
            return not confirmed, -agreed, len(missing) + len(changed), -reduction, len(x[1]), x[0], name

        kept: list[tuple[int, int, tuple]] = []  # start, end, notice; by place
        for x in sorted(found, key=rank):
            start, end = x[0], x[0] + len(x[1])
            at = bisect_right(kept, start, key=lambda k: k[0])
            if (at == 0 or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0]):
                kept.insert(at, (start, end, x))
        return [x for _, _, x in kept]

    def _windows(self, text: str) -> Iterator[tuple[int, str, tuple]]:
        """The best window of each cue, from the first to the last word that agrees with its template."""
        places = [m.span() for m in _ANY_WORD.finditer(text)]
        starts = [a for a, _ in places]
        words = [text[a:z].lower() for a, z in places]
        for cue in dict.fromkeys(bisect_right(starts, m.start()) - 1 for m in _CUE.finditer(text)):
            if cue < 0:
                continue
            ranked = []
            for i, (bag, at) in enumerate(zip(self.bags, self.cues)):
                n = len(self.known[i][1])
                for p in at:
                    low, high = max(cue - p, 0), min(cue - p + n, len(words))
                    if (Counter(words[low:high]) & bag).total() >= MIN_COMMON * n:
                        reduction = self._reduction(i, text[places[low][0] : places[high - 1][1]])
                        if reduction >= MIN_REDUCTION:
                            ranked.append((reduction, i, p))
            best = max(ranked, default=(0, 0, 0))[0]
            fits = []
            for reduction, i, p in ranked:
                if reduction < best - 0.1:
                    continue
                wanted = self.known[i][1]
                n, slack = len(wanted), 1 + int(MAX_DIFFERENCE * len(wanted))
                low, high = max(cue - p - slack, 0), min(cue - p + n + slack, len(words))
                same = [m for m in difflib.SequenceMatcher(None, wanted, words[low:high], autojunk=False).get_matching_blocks() if m.size]
                first, last = low + same[0].b, low + same[-1].b + same[-1].size
                if not first <= cue < last:
                    continue
                end = places[last - 1][1]
                end += len(re.match(r"[^\sA-Za-z0-9]*", text[end:]).group()) if end < len(text) else 0
                missing, changed = self._differences(wanted, words[first:last])
                agreed = n - len(missing)
                fits.append((not self._confirms(wanted, missing, changed), -agreed, len(missing) + len(changed), -reduction, i, starts[first], end, missing, changed))
            if fits:
                off, agreed, _, _, i, start, end, missing, changed = min(fits)
                block = text[start:end]
                yield start, block, (self.known[i][0], self._reduction(i, block), missing, changed, not off, -agreed)

    def _reduction(self, i: int, block: str) -> float:
        if (i, block) not in self.seen:
            if len(self.seen) > 10_000:
                self.seen.clear()
            data = _plain(block)
            self.seen[i, block] = 1 - len(self.known[i][2].compress(data)) / len(self.plain.compress(data))
        return self.seen[i, block]

    @staticmethod
    def _confirms(wanted: list[str], missing: list[str], changed: list[str]) -> bool:
        return len(missing) + len(changed) <= MAX_DIFFERENCE * len(wanted) and not any(w[0].isdigit() for w in missing + changed)

    def judge(self, block: str) -> tuple | None:
        """(license, reduction, missing words, other words, confirmed, words that agree) of the best template, if it reduces enough.

        Equal reductions go to the template with fewer differing words, then to the first name.
        """
        data = _plain(block)
        alone = len(self.plain.compress(data))
        ranked = sorted((1 - len(c.compress(data)) / alone, i) for i, (_, _, c) in enumerate(self.known))
        best = ranked[-1][0]
        if best < MIN_REDUCTION:
            return None
        words = _WORD.findall(block.lower())
        near = [(r, i) for r, i in ranked if r >= best - 0.1]
        judged = [(*self._differences(self.known[i][1], words), r, i) for r, i in near]
        missing, changed, reduction, i = min(judged, key=lambda x: (len(x[0]) + len(x[1]), -x[2], x[3]))
        name, wanted, _ = self.known[i]
        return name, reduction, missing, changed, self._confirms(wanted, missing, changed), len(wanted) - len(missing)

    @staticmethod
    def _differences(wanted: list[str], words: list[str]) -> tuple[list[str], list[str]]:
        """Template words that are missing, and words put inside the template's text; words around it don't count."""
        runs = difflib.SequenceMatcher(None, wanted, words, autojunk=False).get_opcodes()
        missing = [w for tag, a, z, _, _ in runs if tag != "equal" for w in wanted[a:z]]
        inside = [(b, y) for k, (tag, _, _, b, y) in enumerate(runs) if tag != "equal" and 0 < k < len(runs) - 1]
        return missing, [w for b, y in inside for w in words[b:y]]


def _plain(text: str) -> bytes:
    return " ".join(text.lower().split()).encode()


def _cue_words(text: str) -> list[int]:
    """The words of a text in which cues begin, by number."""
    starts = [m.start() for m in _ANY_WORD.finditer(text)]
    return list(dict.fromkeys(bisect_right(starts, m.start()) - 1 for m in _CUE.finditer(text)))


def candidate_blocks(text: str) -> Iterator[tuple[int, str]]:
    """(start, block): lines that hold a cue, each joined with directly following lines that hold one too."""
    lower = text.lower()
    if len(lower) != len(text) or not any(cue in lower for cue in CUES):
        if not any(cue in text.casefold() for cue in CUES):
            return
    at, open_at, parts = 0, 0, []
    for line in [*text.split("\n"), ""]:
        small = line.lower()
        if any(cue in small for cue in CUES):
            if not parts:
                open_at = at
            parts.append(line)
        elif parts:
            yield open_at, "\n".join(parts)
            parts = []
        at += len(line) + 1


def _scan(templates: dict[str, tuple[str, ...]]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates)
        names = [c.split()[0] for c in RESULT.split(", ")]
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                for start, block, (name, reduction, missing, changed, confirmed, _) in scanner.notices(text or ""):
                    rows.append((doc_id, start, len(block), name, reduction, missing, changed, confirmed, block))
            yield pd.DataFrame(rows, columns=[n.split(":")[0] for n in names])

    return run


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """One row per license notice found: document, place in code points, license, reduction, word differences.

    `confirmed` is false where the nearest license differs in a number or in more than MAX_DIFFERENCE of
    its words. Null and empty texts have no blocks; repeated rows are scanned each on their own.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(_scan(templates), RESULT)
