"""License scans by a positional rare-token index.

The index holds the words of licence phrases and templates: for each word its postings (wording,
position) and its rarity, the inverse frequency over all documents scanned. A file's licence words are
looked up from the rarest on. A posting at position p of a wording, met at place q of the file, says that
the wording starts at q - p; words that agree on the start are one alignment.

* Phrases are exact: the starts of the rarest word are intersected with those of the next rarer until
  none is left or all words agree. Every place of a phrase holds its rarest word, so none is lost.
* Templates allow edits: the starts that a template's rarest words give may drift by ``DRIFT`` words. An alignment
  counts when its words make up ``COVERED`` of the template's rarity and one of the mandatory key phrases
  of the template stands inside it, word for word.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import map_batches, stage

# A word, once A-Z is lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Share of a template's rarity that has to agree, and words that edits may shift.
COVERED = 0.7
DRIFT = 3

# Exact phrases and the labels they give.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Wording of common licences, the label, and key phrases of which one must stand in it.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction",
     ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("mit", "released under the mit license", ("the mit license",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
     ("apache license",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met",
     ("redistribution and use in source and binary forms", "with or without modification")),
    ("bsd", "released under the bsd license", ("the bsd license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation",
     ("gnu general public license",)),
    ("gpl-2", "licensed under the gnu general public license version 2", ("general public license version 2",)),
    ("gpl-3", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("released into the public domain",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held "
             "liable for any damages arising from the use of this software",
     ("in no event will the authors be held liable",)),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain", ("dedicated the work to the public domain",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license", ("attribution noncommercial",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license", ("attribution sharealike",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("commons attribution 4 0", "commons attribution international")),
)

FOUND = "label string, start long, end long, score double, base boolean"


def words(text: str | None) -> list[str]:
    """Words of a text with A-Z in lower case."""
    return WORD.findall((text or "").translate(LOWER))


class Index:
    """Postings of the wordings' words by place, and the words of every wording from the rarest on."""

    def __init__(self, phrases: Iterable, templates: Iterable):
        self.phrases = [(words(p), label) for p, label in phrases]
        self.templates = [(label, words(t), [words(k) for k in keys]) for label, t, keys in templates]
        lines = [p for p, _ in self.phrases] + [t for _, t, _ in self.templates] + [k for *_, keys in self.templates for k in keys]
        if not all(lines):
            raise ValueError("a phrase, template or key phrase has no words")
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for line in lines for w in line}))}

    def weigh(self, files: int, holding: dict[int, int]) -> Index:
        """Set the rarity of every word: inverse frequency over ``files``, smoothed and above zero."""
        idf = {w: math.log((files + 1.0) / (holding.get(i, 0) + 0.5)) + 1e-3 for w, i in self.vocabulary.items()}
        self.rarity = idf
        order = lambda line: sorted(range(len(line)), key=lambda k: (-idf[line[k]], k))
        self.rare_phrases = [([(self.vocabulary[p[k]], k) for k in order(p)], len(p), label) for p, label in self.phrases]
        self.rare_templates = []
        for label, line, keys in self.templates:
            ranked = order(line)
            total = sum(idf[w] for w in line)
            half, lead = 0.0, 0
            # An alignment that covers enough holds some word of any set that outweighs what may lack.
            while half <= (1 - COVERED) * total:
                half += idf[line[ranked[lead]]]
                lead += 1
            self.rare_templates.append((
                label, [(self.vocabulary[line[k]], k) for k in ranked], lead, [idf[line[k]] / total for k in ranked], len(line),
                [[(self.vocabulary[key[k]], k) for k in order(key)] for key in keys],
            ))
        return self

    def hits(self, text: str | None) -> tuple[int, dict[int, np.ndarray]]:
        """Number of words, and the places of every licence word."""
        found, own = words(text), {}
        for at, word in enumerate(found):
            if word in self.vocabulary:
                own.setdefault(self.vocabulary[word], []).append(at)
        return len(found), {w: np.array(p, np.int64) for w, p in own.items()}

    @staticmethod
    def exact(rare: list[tuple[int, int]], places: dict[int, np.ndarray]) -> np.ndarray:
        """Starts at which all words of a line stand in a row, the rarest looked up first."""
        starts = None
        for word, at in rare:
            own = places.get(word)
            if own is None:
                return np.empty(0, np.int64)
            starts = own - at if starts is None else starts[np.isin(starts, own - at, assume_unique=True)]
            if not len(starts):
                return starts
        return starts

    def aligned(self, template: tuple, places: dict[int, np.ndarray]) -> list[tuple[int, int, float]]:
        """(start, end, share) of the places where enough of a template stands, edits allowed."""
        _, rare, lead, shares, length, keys = template
        seeds = [places[w] - at for w, at in rare[:lead] if w in places]
        if not seeds or sum(s for (w, _), s in zip(rare, shares) if w in places) < COVERED:
            return []
        marks = [(self.exact(key, places), len(key)) for key in keys]
        if not any(len(m) for m, _ in marks):
            return []
        starts = np.unique(np.concatenate(seeds))
        total = np.zeros(len(starts))
        low, high = np.full(len(starts), np.iinfo(np.int64).max), np.full(len(starts), -1)
        for (word, at), share in zip(rare, shares):
            own = places.get(word)
            if own is None:
                continue
            # The place nearest to where the start puts this word.
            right = np.searchsorted(own, starts + at)
            near = own[np.minimum(right, len(own) - 1)]
            left = own[np.maximum(right - 1, 0)]
            near = np.where(abs(left - starts - at) < abs(near - starts - at), left, near)
            agrees = abs(near - starts - at) <= DRIFT
            total += share * agrees
            low = np.where(agrees, np.minimum(low, near), low)
            high = np.where(agrees, np.maximum(high, near), high)
        good = np.flatnonzero(total >= COVERED)
        kept = []
        # The best first; one that overlaps a better one goes.
        for k in good[np.lexsort((starts[good], -total[good]))].tolist():
            a, b = int(low[k]), int(high[k]) + 1
            slot = bisect_left(kept, (a,))
            free = (slot == len(kept) or b <= kept[slot][0]) and (not slot or kept[slot - 1][1] <= a)
            if free and any(np.searchsorted(m, a - DRIFT) < np.searchsorted(m, b + DRIFT - n, "right") for m, n in marks):
                kept.insert(slot, (a, b, min(1.0, float(total[k]))))
        return kept

    def look_up(self, places: dict[int, np.ndarray]) -> list[tuple[str, int, int, float, bool]]:
        """All matches of a file by start: (label, start, end, score, whether by an exact phrase)."""
        found = []
        for rare, length, label in self.rare_phrases:
            found += [(label, int(s), int(s) + length, 1.0, True) for s in self.exact(rare, places)]
        for template in self.rare_templates:
            found += [(template[0], a, b, share, False) for a, b, share in self.aligned(template, places)]
        return sorted(found, key=lambda m: (m[1], m[2], m[0], not m[4]))


def _packed(places: dict[int, np.ndarray]) -> bytes:
    return b"".join(np.concatenate([[w, len(p)], p]).astype(np.int32).tobytes() for w, p in sorted(places.items()))


def _unpacked(data: bytes) -> dict[int, np.ndarray]:
    row, at, out = np.frombuffer(data, np.int32).astype(np.int64), 0, {}
    while at < len(row):
        word, n = row[at:at + 2].tolist()
        out[word] = row[at + 2:at + 2 + n]
        at += 2 + n
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: Iterable = PHRASES, templates: Iterable = TEMPLATES) -> DataFrame:
    """Columns ``key`` (long), ``n_words`` (long) and ``matches`` per row, in order of start.

    A match is (label, start, end, score, base): words from ``start`` up to ``end``, ``base`` where an exact
    phrase stands there (score 1), else the share of a template's rarity found. Null texts are empty;
    empty texts have no words and no matches. Repeated rows get equal answers, null keys are kept, an
    empty table gives no rows and other columns are not read. Rarity is counted over all rows once a row.
    Texts are cut into words once; what the second pass reads is the places of licence words.
    """
    index = Index(phrases, templates)

    def cut(columns: list[list]) -> list:
        found = [index.hits(t) for t in columns[1]]
        return [columns[0], [n for n, _ in found], [_packed(p) for _, p in found]]

    placed = stage(map_batches(docs.select(F.col(key).cast("long"), text), cut, f"`{key}` long, n_words long, places binary", text), "places")

    def held(columns: list[list]) -> list | None:
        seen = [w for data in columns[0] for w in _unpacked(data)]
        if not seen:
            return None
        word, n = np.unique(seen, return_counts=True)
        return [word.tolist(), n.tolist()]

    # One row for each licence word, however many files there are.
    counted = map_batches(placed.select("places"), held, "word long, n long", "places").groupBy("word").agg(F.sum("n").alias("n"))
    index.weigh(placed.count(), {r["word"]: r["n"] for r in counted.collect()})

    def look_up(columns: list[list]) -> list:
        names = ("label", "start", "end", "score", "base")
        matches = [[dict(zip(names, m)) for m in index.look_up(_unpacked(data))] for data in columns[2]]
        return [columns[0], columns[1], matches]

    return map_batches(placed, look_up, f"`{key}` long, n_words long, matches array<struct<{FOUND.replace(' ', ':').replace(',:', ', ')}>>", "places")
