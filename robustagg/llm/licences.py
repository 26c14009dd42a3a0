"""License scan by a positional index of rare words.

Licence notices are templates: word sequences with a label and mandatory key
phrases. Their words have posting lists (template, position). Document frequency
of every template word is counted over all documents; it orders the words by
rarity (IDF). For each document and template whose key words it holds, the
document's ``LOOKUP`` rarest words of that template are looked up, and their
postings are intersected by relative position: places where at least ``VOTES``
of them agree on where the template would start are candidates. A candidate
counts if every key phrase stands, word by word, within ``SLACK`` words of its
place. Its score is the share of the template's words found exactly in place.

Besides, the base phrases are counted wherever their words stand consecutively.

Two passes over the texts: one for the frequencies (a vector as long as the
vocabulary per task, added up), one for the scan. Nothing is shuffled but these
counts; the vocabulary and its counts are all that tasks get, bounded by the
templates.

Defined cases: null text is empty; a document without words has no labels and
score 0; texts are scanned whole, in slices of documents of ``SLICE_BYTES`` or one
document; repeated rows count as documents each; ties in rarity go to the lesser
word; an empty table gives no rows; extra columns are not read, whatever their
names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ship_package
from .words import ALNUM, find_words, slices

LOOKUP, VOTES, SLACK = 4, 2, 12
SLICE_BYTES = 4 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases and labels of the contract.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Public licence notices (label, text, key phrases).
TEMPLATES = [
    ("mit", "Released under the MIT License", ["under the mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
     ["permission is hereby granted free of charge", "to deal in the software without restriction"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
     ["except in compliance with the license", "you may obtain a copy of the license"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license version 3"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
            "later version", ["under the terms of the gnu general public license", "published by the free software foundation"]),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
             "the Free Software Foundation", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
     ["gnu affero general public license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met",
     ["redistribution and use in source and binary forms", "the following conditions are met"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies",
     ["for any purpose with or without fee", "this permission notice appear in all copies"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ["subject to the terms of the mozilla public license"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ["creative commons attribution 4 0"]),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
     ["creative commons attribution sharealike 4 0"]),
    ("cc0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
                "this software to the public domain worldwide", ["to the public domain worldwide"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["free and unencumbered software released into the public domain"]),
    ("zlib", "In no event will the authors be held liable for any damages arising from the use of this software",
     ["will the authors be held liable"]),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", ["boost software license version 1 0"]),
]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(str.maketrans(UPPER, LOWER)))


@dataclass
class Template:
    label: str
    words: np.ndarray  # word numbers
    keys: list[tuple[int, np.ndarray]]  # (position, word numbers) of the key phrases


class Index:
    """Numbers of the words of templates and base phrases, and the templates in them."""

    def __init__(self, templates, base):
        texts = [words_of(text) for _, text, _ in templates]
        phrases = [words_of(p) for p, _ in base]
        self.vocabulary = sorted({w for t in texts + phrases for w in t})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        in_numbers = lambda ws: np.array([number[w] for w in ws], np.int32)
        self.templates = []
        for (label, _, keys), words in zip(templates, texts, strict=True):
            placed = []
            for key in map(words_of, keys):
                at = next((i for i in range(len(words)) if words[i:i + len(key)] == key), None)
                if at is None:
                    raise ValueError(f"the template of {label} lacks its key phrase {' '.join(key)!r}")
                placed.append((at, in_numbers(key)))
            self.templates.append(Template(label, in_numbers(words), placed))
        self.base = [(in_numbers(p), label) for p, (_, label) in zip(phrases, base, strict=True)]
        hashes = find_words(pa.array([" ".join(self.vocabulary)]), ALNUM).hashes
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order.astype(np.int32)

    def numbers_of(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for words that no template has."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)


def _presence(numbers: np.ndarray, owner: np.ndarray, rows: int, size: int) -> np.ndarray:
    present = np.zeros((rows, size), bool)
    known = numbers >= 0
    present[owner[known], numbers[known]] = True
    return present


def _frequencies(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.vocabulary), np.int64)
        for batch in slices(batches, "text", SLICE_BYTES):
            w = find_words(batch.column("text"), ALNUM)
            total += _presence(index.numbers_of(w.hashes), w.owner(), batch.num_rows, len(total)).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["word", "n"])
    return run


def document_frequencies(docs: DataFrame, index: Index) -> np.ndarray:
    """Documents that hold each word of the index (one number per word on the driver)."""
    counts = (docs.select("text").mapInArrow(_frequencies(index), "word int, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(len(index.vocabulary), np.int64)
    for r in counts:
        out[r["word"]] = r["n"]
    return out


def _places(numbers: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of the phrase in the words of a document."""
    n = len(numbers) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    same = np.ones(n, bool)
    for i, w in enumerate(phrase):
        same &= numbers[i:i + n] == w
    return np.flatnonzero(same)


def match(numbers: np.ndarray, template: Template, rarity: np.ndarray) -> tuple[int, float] | None:
    """Best (start, score) of a template in the words of a document, or None."""
    mine = np.unique(template.words)
    mine = mine[np.isin(mine, numbers)]
    rarest = mine[np.argsort(rarity[mine], kind="stable")][:LOOKUP]
    starts = [np.unique(np.flatnonzero(numbers == w)[:, None] - np.flatnonzero(template.words == w)[None, :]) for w in rarest]
    if not starts:
        return None
    start, votes = np.unique(np.concatenate(starts), return_counts=True)
    start = start[votes >= VOTES]
    for at, phrase in template.keys:
        if not len(start):
            return None
        found = _places(numbers, phrase)
        after = np.searchsorted(found, start + at - SLACK)
        start = start[(after < len(found)) & (np.append(found, 1 << 62)[after] <= start + at + SLACK)]
    best = None
    n = len(template.words)
    for i in range(0, len(start), 4096):
        places = start[i:i + 4096, None] + np.arange(n)
        inside = (places >= 0) & (places < len(numbers))
        same = (numbers[np.clip(places, 0, len(numbers) - 1)] == template.words) & inside
        score = same.sum(1) / n
        k = int(np.argmax(score))
        if best is None or score[k] > best[1]:
            best = (int(start[i + k]), float(score[k]))
    return best


_OUT = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
        "score double, matches array<struct<template: int, label: string, start: long, score: double>>")


def _scan(index: Index, rarity: np.ndarray):
    needed = [np.unique(np.concatenate([k for _, k in t.keys])) for t in index.templates]
    matched = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("start", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            w, n = find_words(batch.column("text"), ALNUM), batch.num_rows
            owner, numbers = w.owner(), index.numbers_of(w.hashes)
            count, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1, np.int64)
            base: list[set[str]] = [set() for _ in range(n)]
            for phrase, label in index.base:
                at = _places(numbers, phrase)
                at = at[owner[at] == owner[at + len(phrase) - 1]]
                rows, place = owner[at], at - w.first[owner[at]]
                np.add.at(count, rows, 1)
                np.minimum.at(first, rows, place)
                np.maximum.at(last, rows, place)
                for i in np.unique(rows).tolist():
                    base[i].add(label)
            present = _presence(numbers, owner, n, len(index.vocabulary))
            found: list[list[dict]] = [[] for _ in range(n)]
            for t, template in enumerate(index.templates):
                for i in np.flatnonzero(present[:, needed[t]].all(1)).tolist():
                    best = match(numbers[w.first[i]:w.first[i + 1]], template, rarity)
                    if best is not None:
                        found[i].append({"template": t, "label": template.label, "start": best[0], "score": best[1]})
            none = count == 0
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(w.counts, pa.int64()), pa.array(count),
                pa.array(first, mask=none), pa.array(last, mask=none),
                pa.array([sorted(b) for b in base], pa.list_(pa.string())),
                pa.array([sorted(b | {m["label"] for m in f}) for b, f in zip(base, found, strict=True)], pa.list_(pa.string())),
                pa.array([max((m["score"] for m in f), default=0.0) for f in found], pa.float64()),
                pa.array(found, matched)],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])
    return run


def scan_licences(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    and matches (template number, label, start word, score), one row per row of
    docs. ``templates``: (label, notice, key phrases of it)."""
    ship_package(docs.sparkSession)
    index = Index(templates, base)
    docs = docs.select("doc_id", "text")
    often = document_frequencies(docs, index)
    # Rank by (documents, word): word numbers are in the order of the words.
    rarity = np.empty(len(often), np.int64)
    rarity[np.lexsort((np.arange(len(often)), often))] = np.arange(len(often))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_scan(index, rarity), f"doc_id {kind}, {_OUT}")
