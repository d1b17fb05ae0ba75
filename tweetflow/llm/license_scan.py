"""Licence texts found by an exact set-similarity join with filters.

A text block is a run of ``BLOCK`` words, or of twice that as often as a long
template needs; blocks overlap by half, so that any passage of half that length
lies within one. A block meets a template if it contains at least a given share
of the template's distinct words. Words are ordered by how many blocks of the
whole corpus have them, rarest first:

* prefix: a block that meets a template has one of its rarest
  ``n - ceil(share * n) + 1`` words;
* length: it has at least ``ceil(share * n)`` distinct words;
* positional: after the first shared word, in order, enough words of the
  template must be left to reach that number.

What passes is verified by counting, on hashes and then on the words as they are
spelled. Phrases are templates that must be contained whole; their places are
then read off the block's words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.decontaminate import Keys
from tweetflow.llm.frames import annotate, bound_batches, pick
from tweetflow.llm.words import lower_words, slices, utf8, words

#: Words of the shortest blocks; the next one begins half as many words on.
BLOCK = 128
#: Share of a notice's distinct words that a block must contain.
SHARE = 0.85


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: The words must follow one another, so all of them must be there.
    phrase: bool = False


#: The phrases of the contract and their labels.
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

#: The notices that the licences ask to put above a work.
NOTICES = (
    Template("mit", "released under the mit license"),
    Template("apache-2", "licensed under the apache license version 2 0"),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the"
        " gnu general public license as published by the free software foundation",
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files to deal in the software without restriction",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
    ),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
)

#: Licences, and the longer notices, as they stand in files.
BODIES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction including"
        " without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
        " copies of the software and to permit persons to whom the software is furnished to do so subject to"
        " the following conditions the above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the software the software is provided as is without warranty of"
        " any kind express or implied including but not limited to the warranties of merchantability fitness for"
        " a particular purpose and noninfringement in no event shall the authors or copyright holders be liable"
        " for any claim damages or other liability whether in an action of contract tort or otherwise arising"
        " from out of or in connection with the software or the use or other dealings in the software",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided"
        " that the following conditions are met redistributions of source code must retain the above copyright"
        " notice this list of conditions and the following disclaimer redistributions in binary form must"
        " reproduce the above copyright notice this list of conditions and the following disclaimer in the"
        " documentation and or other materials provided with the distribution this software is provided by the"
        " copyright holders and contributors as is and any express or implied warranties including but not"
        " limited to the implied warranties of merchantability and fitness for a particular purpose are"
        " disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect"
        " incidental special exemplary or consequential damages including but not limited to procurement of"
        " substitute goods or services loss of use data or profits or business interruption however caused and"
        " on any theory of liability whether in contract strict liability or tort including negligence or"
        " otherwise arising in any way out of the use of this software even if advised of the possibility of"
        " such damage",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is"
        " hereby granted provided that the above copyright notice and this permission notice appear in all"
        " copies the software is provided as is and the author disclaims all warranties with regard to this"
        " software including all implied warranties of merchantability and fitness in no event shall the author"
        " be liable for any special direct indirect or consequential damages or any damages whatsoever resulting"
        " from loss of use data or profits whether in an action of contract negligence or other tortious action"
        " arising out of or in connection with the use or performance of this software",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in"
        " compliance with the license you may obtain a copy of the license at http www apache org licenses"
        " license 2 0 unless required by applicable law or agreed to in writing software distributed under the"
        " license is distributed on an as is basis without warranties or conditions of any kind either express"
        " or implied see the license for the specific language governing permissions and limitations under the"
        " license",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation either version 3 of the license or"
        " at your option any later version this program is distributed in the hope that it will be useful but"
        " without any warranty without even the implied warranty of merchantability or fitness for a particular"
        " purpose see the gnu general public license for more details you should have received a copy of the gnu"
        " general public license along with this program if not see http www gnu org licenses",
    ),
)


def block_words(template: Template) -> int:
    """Words of the blocks that a template is looked for in: twice its own at least."""
    block = BLOCK
    while block < 2 * len(_hashes(template.text)):
        block *= 2
    return block


class _Join:
    """Templates for blocks of one length, ready to be met: words by rarity, prefixes and bounds."""

    def __init__(self, templates: list[Template], share: float, blocks_with: dict[int, int], block: int):
        self.templates = templates
        self.block = block
        self.texts = [set(lower_words(*_found(t.text)).split()) for t in templates]
        self.phrases = [lower_words(*_found(t.text)) for t in templates]
        self.words: list[np.ndarray] = []  # distinct, rarest first
        self.spelled: list[np.ndarray] = []  # in the order of the text
        self.needed: list[int] = []
        prefixes: dict[int, list[tuple[int, int]]] = {}
        for t, template in enumerate(templates):
            spelled = _hashes(template.text)
            rank = sorted(set(spelled.tolist()), key=lambda h: (blocks_with.get(h, 0), h))
            needed = len(rank) if template.phrase else math.ceil(share * len(rank))
            self.words.append(np.array(rank, np.uint64))
            self.spelled.append(spelled)
            self.needed.append(needed)
            for place, word in enumerate(rank[: len(rank) - needed + 1]):
                prefixes.setdefault(word, []).append((t, place))
        self.keys = Keys(np.array(sorted(prefixes), np.uint64))
        self.places = [prefixes[int(k)] for k in self.keys.keys]

    def met(self, hashes: np.ndarray, spell) -> Iterator[tuple[int, float, int, int]]:
        """``(template, share, block start, block end)`` for the words of one text.

        ``spell`` gives the words of a stretch as they are compared.
        """
        at, number = self.keys.find(hashes)
        if not len(at):
            return
        size, half = self.block, self.block // 2
        last = max(0, -(-(len(hashes) - size) // half))
        candidates: dict[tuple[int, int], int] = {}
        for i, k in zip(at.tolist(), number.tolist(), strict=True):
            blocks = range(max(0, -(-(i - size + 1) // half)), min(i // half, last) + 1)
            for block in blocks:
                for t, place in self.places[k]:
                    candidates[t, block] = min(place, candidates.get((t, block), place))
        cached: dict[int, np.ndarray] = {}
        for (t, block), place in candidates.items():
            rank, needed = self.words[t], self.needed[t]
            if len(rank) - place < needed:  # positional bound
                continue
            if block not in cached:
                cached[block] = np.unique(hashes[block * half : block * half + size])
            have = cached[block]
            if len(have) < needed:  # length bound
                continue
            where = np.minimum(np.searchsorted(have, rank), len(have) - 1)
            shared = int((have[where] == rank).sum())
            if shared < needed:
                continue
            start, end = block * half, min(block * half + size, len(hashes))
            shared = len(self.texts[t].intersection(spell(start, end).split()))
            if shared >= needed:
                yield t, shared / len(rank), start, end

    def places_of(self, t: int, hashes: np.ndarray, start: int, end: int, spell) -> list[int]:
        """Where the words of a phrase follow one another in a block."""
        spelled = self.spelled[t]
        n = end - start - len(spelled) + 1
        same = np.ones(max(n, 0), bool)
        for j, word in enumerate(spelled):
            same &= hashes[start + j : start + j + len(same)] == word
        places = (np.flatnonzero(same) + start).tolist()
        return [p for p in places if spell(p, p + len(spelled)) == self.phrases[t]]


def _found(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = utf8(pa.array([text]))
    found = words(data, offsets)
    return data, found.starts, found.ends


def _hashes(text: str) -> np.ndarray:
    return words(*utf8(pa.array([text]))).hashes


def blocks_with_words(docs: DataFrame, text: str, known: dict[int, np.ndarray]) -> dict[int, dict[int, int]]:
    """By the length of blocks: in how many of the whole corpus each of the given words stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = {size: Keys(some) for size, some in known.items()}
        total = {size: np.zeros(len(k.keys), np.int64) for size, k in keys.items()}
        for batch in slices(batches, "text"):
            found = words(*utf8(batch.column("text")))
            for size, k in keys.items():
                half = size // 2
                at, number = k.find(found.hashes)
                of_text = np.searchsorted(found.first, at, side="right") - 1
                # A word stands in the blocks of its own half and of the one before.
                own = (at - found.first[of_text]) // half
                last = np.maximum(0, -(-(found.counts[of_text] - size) // half))
                seen = []
                for block in (own, own - 1):
                    fits = (block >= 0) & (block <= last)
                    seen.append(np.stack([of_text[fits], block[fits], number[fits]]))
                each = np.unique(np.concatenate(seen, axis=1), axis=1)
                total[size] += np.bincount(each[2], minlength=len(total[size]))
        for size, k in keys.items():
            some = np.flatnonzero(total[size])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), size, np.int32)), pa.array(k.keys[some].view(np.int64)),
                 pa.array(total[size][some])],
                names=["size", "key", "n"],
            )

    bound_batches(docs.sparkSession)
    counted = pick(docs, text=text).mapInArrow(run, "size int, key bigint, n bigint")
    out: dict[int, dict[int, int]] = {size: {} for size in known}
    for row in counted.groupBy("size", "key").agg(F.sum("n").alias("n")).collect():
        out[row["size"]][row.key & (2**64 - 1)] = row.n
    return out


def scan_licenses(
    docs: DataFrame,
    *,
    text: str = "text",
    templates: tuple[Template, ...] = PHRASES + NOTICES + BODIES,
    share: float = SHARE,
    into: str = "licenses",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, phrases, blocks.

    ``phrases`` are all places ``(label, start, end)`` of a phrase's words,
    ``blocks`` the blocks ``(label, start, end, share)`` that meet a notice; both
    count words from 0, end exclusive. Templates may be of any length; they are
    part of the task, so their number is that of the licences. A null or empty
    text has no words. No row moves.
    """
    by_block: dict[int, list[Template]] = {}
    for template in templates:
        by_block.setdefault(block_words(template), []).append(template)
    known = {b: np.unique(np.concatenate([_hashes(t.text) for t in group])) for b, group in by_block.items()}
    counts = blocks_with_words(docs, text, known)
    joins = [_Join(group, share, counts[b], b) for b, group in sorted(by_block.items())]

    def prepare():
        def scan(column: pa.Array) -> list:
            data, offsets = utf8(column)
            found = words(data, offsets)
            phrases: list[list[dict]] = [[] for _ in range(len(column))]
            blocks: list[list[dict]] = [[] for _ in range(len(column))]
            at = np.concatenate([join.keys.find(found.hashes)[0] for join in joins])
            for i in np.unique(np.searchsorted(found.first, at, side="right") - 1).tolist():
                first = int(found.first[i])
                hashes = found.hashes[first : found.first[i + 1]]

                def spell(start: int, end: int, first: int = first) -> bytes:
                    part = slice(first + start, first + end)
                    return lower_words(data, found.starts[part], found.ends[part])

                places: set[tuple[int, str, int]] = set()
                for join in joins:
                    for t, part, start, end in join.met(hashes, spell):
                        label = join.templates[t].label
                        if join.templates[t].phrase:
                            n = len(join.spelled[t])
                            places |= {(p, label, p + n) for p in join.places_of(t, hashes, start, end, spell)}
                        else:
                            blocks[i].append({"label": label, "start": start, "end": end, "share": part})
                phrases[i] = [{"label": w, "start": s, "end": e} for s, w, e in sorted(places)]
                blocks[i].sort(key=lambda b: (b["start"], b["end"], b["label"], b["share"]))
            return [found.counts, phrases, blocks]

        return scan

    return annotate(
        docs, text, prepare,
        "n_words bigint, phrases array<struct<label:string,start:bigint,end:bigint>>,"
        " blocks array<struct<label:string,start:bigint,end:bigint,share:double>>",
        into, drop,
    )
