"""Licence scans with a positional index of rare licence words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import ALNUM, freeing, tune, utf8

# Phrases whose every place counts, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wordings of common licence notices, and phrases that must be among the words found.
TEMPLATES = {
    "agpl-3.0": [
        ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license", ["gnu affero general public license"]),
    ],
    "apache-2.0": [
        ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", ["apache license version 2 0"]),
        ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ["apache license version 2 0"]),
    ],
    "bsd": [("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"])],
    "bsl-1.0": [("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", ["to any person or organization obtaining a copy"])],
    "cc-by": [("this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"])],
    "cc-by-nc": [
        ("licensed under cc by nc 4 0", ["cc by nc"]),
        ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial 4 0"]),
    ],
    "cc-by-sa": [("this work is licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"])],
    "cc0": [("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ["waived all copyright and related or neighboring rights"])],
    "epl-2.0": [("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ["eclipse public license"])],
    "gpl-2.0": [
        ("this work is licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
        ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ["gnu general public license", "version 2 of the license"]),
    ],
    "gpl-3.0": [
        ("this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
        ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ["gnu general public license", "version 3 of the license"]),
    ],
    "isc": [("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["distribute this software for any purpose with or without fee"])],
    "lgpl": [
        ("this library is licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
        ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ["gnu lesser general public license"]),
    ],
    "mit-text": [
        ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge to any person obtaining a copy"]),
        ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ["permission is hereby granted free of charge to any person obtaining a copy"]),
    ],
    "mit-notice": [("released under the mit license", ["under the mit license"]), ("licensed under the mit license", ["under the mit license"])],
    "mpl-2.0": [("this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"])],
    "unlicense": [("this is free and unencumbered software released into the public domain", ["free and unencumbered software released into the public domain"])],
    "zlib": [("this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ["in no event will the authors be held liable for any damages arising from the use of this software"])],
}
_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation "
    "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
)
_BSD_HEAD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
)
_BSD_NAMES = "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission "
_BSD_TAIL = (
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed "
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)
_ISC = (
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"
)
_ZLIB = (
    "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software "
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions "
    "1 the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required "
    "2 altered source versions must be plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution"
)

# Whole licences, without their titles and names.
WHOLE = {
    "bsd-2-clause-whole": [(_BSD_HEAD + _BSD_TAIL, ["redistributions in binary form must reproduce the above copyright notice"])],
    "bsd-3-clause-whole": [(_BSD_HEAD + _BSD_NAMES + _BSD_TAIL, ["redistributions in binary form must reproduce the above copyright notice", "endorse or promote products derived from this software"])],
    "isc-whole": [(_ISC, ["for any purpose with or without fee is hereby granted"])],
    "mit-whole": [(_MIT, ["this permission notice shall be included in all copies or substantial portions of the software"])],
    "zlib-whole": [(_ZLIB, ["altered source versions must be plainly marked as such"])],
}
#: A template needs this share of its words, in order, among one and a fifth as many neighbouring words.
SHARE = 0.8
#: A template is measured where this part of its places at least, all of them of its rarest, stand about as far from each other as in it.
VOTES = 0.2


class Index:
    """Templates by word: for each word the (template, place) where it stands, of each template's rarest places only."""

    def __init__(self, templates: dict[str, list[tuple[str, list[str]]]], base: dict[str, str]):
        flat = [(name, text.encode().split(), [p.encode().split() for p in keys]) for name in sorted(templates) for text, keys in templates[name]]
        self.names, self.words, self.keys = ([x[k] for x in flat] for k in range(3))
        self.vocabulary = {w for words in self.words for w in words}
        self.masks = [{w: sum(1 << k for k, v in enumerate(words) if v == w) for w in words} for words in self.words]
        self.least = [next(h for h in range(len(w) + 1) if h >= (SHARE - 1e-9) * len(w)) for w in self.words]
        self.span = [len(w) + (len(w) + 4) // 5 for w in self.words]
        self.votes = [min(least, max(2, math.ceil(VOTES * len(w)))) for w, least in zip(self.words, self.least, strict=True)]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.rarest({})
        self.base = [(p.encode().split(), label) for p, label in base.items()]
        self.ends = {p[-1] for p, _ in self.base}

    def rarest(self, idf: dict[bytes, float]) -> None:
        """Lists the rarest places of each template: as many as a match may lack, and as many more as it needs votes, so that it has these votes."""
        self.postings = {}
        for t, words in enumerate(self.words):
            places = sorted(range(len(words)), key=lambda k: (-idf.get(words[k], 0.0), k))[: len(words) - self.least[t] + self.votes[t]]
            for k in places:
                self.postings.setdefault(words[k], []).append((t, k))

    def places(self, words: list[bytes], phrase: list[bytes], at: dict[bytes, list[int]]) -> list[int]:
        """Where a phrase starts, given the places of its last word."""
        n = len(phrase)
        return [k - n + 1 for k in at.get(phrase[-1], ()) if k >= n - 1 and words[k - n + 1 : k + 1] == phrase]

    def in_order(self, t: int, words: list[bytes]) -> int:
        """How many words of a template stand among words in its order: a longest common subsequence, a bit for each place."""
        mask, open_ = self.masks[t], (1 << len(self.words[t])) - 1
        every = open_
        for w in words:
            if m := open_ & mask.get(w, 0):
                open_ = ((open_ + m) | (open_ - m)) & every
        return len(self.words[t]) - open_.bit_count()

    def starts(self, t: int, places: list[tuple[int, list[int]]]) -> list[list[int]]:
        """Ranges (from, to) of where a window with a template can begin, from (place in the template, its word's places in the text).

        Each pair votes for a start, its place in the text less that in the template. In a window that begins
        at k and holds least of the words, inserted words raise that of a pair to k + span - least at most and
        left-out words lower it to k - (words - least); so starts so far apart add up.
        """
        lacking, more = len(self.words[t]) - self.least[t], self.span[t] - self.least[t]
        start = np.concatenate([np.array(at) - k for k, at in places])
        place = np.repeat([k for k, _ in places], [len(at) for _, at in places])
        order = np.argsort(start, kind="stable")
        start, place = start[order], place[order]
        end = np.searchsorted(start, start + lacking + more, "right")
        enough = np.flatnonzero(end - np.arange(len(start)) >= self.votes[t])
        out: list[list[int]] = []
        for a in enough.tolist():
            if len(set(place[a : end[a]].tolist())) < self.votes[t]:  # of as many places
                continue
            lo, hi = int(start[a]) - more, int(start[a]) + lacking
            if out and lo <= out[-1][1] + 1:
                out[-1][1] = hi
            else:
                out.append([lo, hi])
        return out

    def share(self, t: int, words: list[bytes], ranges: list[list[int]]) -> float:
        """The largest share of a template in windows of its span that begin in the ranges and hold its key phrases; 0 below SHARE."""
        span, least, best, mask = self.span[t], self.least[t], 0, self.masks[t]
        for lo, hi in ranges:
            lo, hi = max(0, lo), min(hi, len(words) - 1)
            known = np.cumsum([0, *(w in mask for w in words[lo : hi + span])])
            for k in range(lo, hi + 1):
                if words[k] not in mask:  # a window that begins with a word of the template holds as much
                    continue
                if known[min(k - lo + span, len(known) - 1)] - known[k - lo] <= max(best, least - 1):
                    continue
                window = words[k : k + span]
                if all(_holds(window, p) for p in self.keys[t]):
                    best = max(best, n) if (n := self.in_order(t, window)) >= least else best
        return best / len(self.words[t])

    def scan(self, text: bytes) -> tuple[int, int, int | None, int | None, set[str], dict[str, float]]:
        """Words, places of base phrases, their first and last, base labels, and each label found with its share."""
        words = text.translate(ALNUM).split()
        known = self.postings.keys() | self.ends
        at: dict[bytes, list[int]] = {}
        for w in known.intersection(words):
            at[w] = []
        if not at:
            return len(words), 0, None, None, set(), {}
        for k, w in enumerate(words):
            if w in at:
                at[w].append(k)
        starts, base = [], set()
        for phrase, label in self.base:
            if found := self.places(words, phrase, at):
                starts += found
                base.add(label)
        near: dict[int, list[tuple[int, list[int]]]] = {}
        for w in at.keys() & self.postings.keys():
            for t, k in self.postings[w]:
                near.setdefault(t, []).append((k, at[w]))
        shares: dict[str, float] = {}
        for t, found in near.items():
            if len(found) >= self.votes[t] and (ranges := self.starts(t, found)):
                if (share := self.share(t, words, ranges)) > shares.get(self.names[t], 0.0):
                    shares[self.names[t]] = share
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), base, shares


def _holds(words: list[bytes], phrase: list[bytes]) -> bool:
    return any(words[k : k + len(phrase)] == phrase for k in range(len(words) - len(phrase) + 1))


def _document_counts(index: Index):
    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in utf8(batch.column(0)):
                counts.update(index.vocabulary & set(text.translate(ALNUM).split()))
                counts[b""] += 1
        yield pa.RecordBatch.from_pydict({"w": list(counts), "n": list(counts.values())}, pa.schema([("w", pa.binary()), ("n", pa.int64())]))

    return rows


def _scan(index_of):
    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = index_of.value
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in utf8(batch.column(1)):
                n, n_base, first, last, base, shares = index.scan(text)
                row = (n, n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | shares.keys())), max([*shares.values(), 1.0 if base else 0.0]))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return rows


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, list[tuple[str, list[str]]]] | None = None,
    base: dict[str, str] | None = None,
) -> DataFrame:
    """Every row's licence labels.

    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased. A
    first pass counts in how many texts of the whole table each licence word stands.
    Then each template is looked up by the places of its own rarest words, as many as may be wrong and
    a fifth of all more, so that a match must hold that fifth. Each vote for a start, and where
    enough of different places vote for about one, a template is found if a window there
    of one and a fifth as many words holds its key phrases and SHARE of its words in their order,
    whatever else the text holds. A label has several wordings; whole licences have labels of their own.
    Several matches of a label count as the best. Returns the id, n_words,
    n_base (places of base phrases), first_word and last_word (their smallest and largest
    start, else null), base_labels, labels (base and found) and score (the best share;
    1 for a base phrase; else 0).

    Null and empty texts have no words and no labels. Repeated rows count each; null
    ids, very long texts (read whole) and empty tables are handled like any other. Words equally rare
    count in the order of the template; other columns are not read.
    """
    tune(docs.sparkSession)
    index = Index(templates or TEMPLATES | WHOLE, base or BASE)
    text = F.col(text_col).cast("string").alias("t")
    counted = docs.select(text).mapInArrow(_document_counts(index), "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    counts = {bytes(r["w"]): r["n"] for r in counted.collect()}  # a row for each licence word
    total = counts.pop(b"", 0)
    index.rarest({w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in index.vocabulary})
    index_of = docs.sparkSession.sparkContext.broadcast(index)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    out = docs.select(F.col(id_col).alias("id"), text).mapInArrow(_scan(index_of), schema)
    return out.withColumnRenamed("id", id_col)
