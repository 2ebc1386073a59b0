"""Licence scan: lines, paragraphs and windows of words against licence templates by the Dice coefficient over word bigrams.

Text is normalised (A-Z lower-cased, other ASCII characters than letters and digits are blanks). Two sets of bigrams with a Dice
coefficient of t or more differ in size by a factor of (2 - t) / t at most, so each unit only meets the templates whose
size lies within that bound; templates are sorted by size for it. The templates are fixed and few and travel with the code.
Whole texts are read once, without a shuffle.

Lines and paragraphs (which end at a line without a word, such as ` *` in a comment block) tell where a notice stands. A notice inside a longer line, or
a licence text over many paragraphs, is found by windows: as many words as the template has, slid over all words of the text. A window can only
match a template of n bigrams if t * n / (2 - t) of its places hold bigrams of the template, so only stretches that do are looked at, with
counts that follow the window. Of consecutive places that match, the best one is reported (the first of equals).

Defined results: a null or empty text, and a unit of fewer than two words, match nothing; a text shorter than the template is one window; null ids and
repeated rows are scanned like others; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import map_texts
from gondola.llm.toxicity import tokens

# Conditions and disclaimers that several licences share.
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.")
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission.")
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

# Names and wording of common licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met:",
    "BSD-2-Clause text": f"{_BSD_2} {_BSD_END}",
    "BSD-3-Clause text": f"{_BSD_2} {_BSD_3} {_BSD_END}",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0 short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-4.0 short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0 short": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."),
    "MIT": "Released under the MIT License.",
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:"),
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "zlib text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not "
        "be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
        "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
}
#: The end of a paragraph: a line without a word.
GAP = re.compile(r"\n[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n")


def bigrams(text: str) -> frozenset[tuple[bytes, bytes]]:
    words = tokens(text)
    return frozenset(zip(words, words[1:]))


class Scanner:
    """Templates sorted by size, and the words they use."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        found = ((len(b), name, b) for name, text in templates.items() for b in [bigrams(text)] if b)
        self.templates = sorted(found, key=lambda x: x[:2])
        self.lengths = {name: len(tokens(text)) for name, text in templates.items()}
        self.owners: dict[tuple[bytes, bytes], list[int]] = defaultdict(list)
        for i, (_, _, b) in enumerate(self.templates):
            for pair in b:
                self.owners[pair].append(i)
        self.sizes = [n for n, *_ in self.templates]
        self.factor = (2 - threshold) / threshold
        self.words = {w for *_, b in self.templates for pair in b for w in pair}
        self.least = min(self.sizes, default=1) / self.factor

    def matches(self, text: str) -> list[tuple[str, float]]:
        """(licence, Dice) of every template that one unit matches."""
        words = tokens(text)
        # a match shares at least this many bigrams, so at least as many words
        if len(words) < 2 or sum(map(self.words.__contains__, words)) < self.least * self.threshold:
            return []
        own = frozenset(zip(words, words[1:]))
        low = bisect_left(self.sizes, len(own) / self.factor - 1e-9)
        high = bisect_right(self.sizes, len(own) * self.factor + 1e-9)
        scored = ((name, 2 * len(own & b) / (len(own) + n)) for n, name, b in self.templates[low:high])
        return [(name, dice) for name, dice in scored if dice >= self.threshold]

    def windows(self, words: list[bytes]) -> list[tuple[int, str, float]]:
        """(first word, licence, Dice) of the best window of each run of windows that match a template."""
        hits: dict[int, list[int]] = defaultdict(list)
        known = self.words
        pairs = list(zip(words, words[1:]))
        # looked up only where both words occur in some template
        for at in (i for i, (a, b) in enumerate(pairs) if a in known and b in known):
            for owner in self.owners.get(pairs[at], ()):
                hits[owner].append(at)
        out = []
        for owner, places in sorted(hits.items()):
            n, name, b = self.templates[owner]
            need = max(1, ceil(n * self.threshold / (2 - self.threshold) - 1e-9))
            width = self.lengths[name] - 1  # bigrams of a window
            final = max(0, len(pairs) - width)
            ranges: list[list[int]] = []
            for low, high in zip(places, places[need - 1 :]):
                if high - low < width:
                    first, last = min(max(0, high - width + 1), final), min(low, final)
                    if ranges and first <= ranges[-1][1] + 1:
                        ranges[-1][1] = max(ranges[-1][1], last)
                    else:
                        ranges.append([first, last])
            for first, last in ranges:
                out += [(start, name, dice) for start, dice in self._slide(pairs, first, last, width, b)]
        return out

    def _slide(self, pairs: list, first: int, last: int, width: int, b: frozenset) -> list[tuple[int, float]]:
        """The best (start, Dice) of each run of matching windows that start in first .. last."""
        seen = Counter(pairs[first : first + width])
        shared = sum(p in b for p in seen)
        best, run = [], False
        for start in range(first, last + 1):
            if start > first:
                gone = pairs[start - 1]
                seen[gone] -= 1
                if not seen[gone]:
                    del seen[gone]
                    shared -= gone in b
                if start + width <= len(pairs):
                    come = pairs[start + width - 1]
                    shared += come in b and come not in seen
                    seen[come] += 1
            dice = 2 * shared / (len(seen) + len(b))
            if dice < self.threshold:
                run = False
            elif not run:
                best.append((start, dice))
                run = True
            elif dice > best[-1][1]:
                best[-1] = (start, dice)
        return best

    def scan(self, text: str) -> list[dict]:
        units = [("line", i, x) for i, x in enumerate(text.split("\n"))]
        units += [("paragraph", i, x) for i, x in enumerate(GAP.split(text)) if "\n" in x.strip(" \t\n\r\x0b\x0c")]
        found = [(unit, i, name, dice) for unit, i, x in units for name, dice in self.matches(x)]
        found += [("window", *x) for x in self.windows(tokens(text))]
        return [dict(zip(("unit", "unit_no", "licence", "dice"), x)) for x in found]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8) -> DataFrame:
    """(doc_id, unit, unit_no, licence, dice) of every line and every paragraph of several lines that matches a template, and of the
    best window of every run of windows that do; lines and paragraphs are numbered from 0, a window by its first word."""
    ready = Scanner(TEMPLATES if templates is None else templates, threshold)
    rows = map_texts(
        docs, ["doc_id"], "found array<struct<unit string, unit_no int, licence string, dice double>>",
        lambda texts: {"found": [ready.scan(t) for t in texts]})
    return rows.select("doc_id", F.inline("found"))
