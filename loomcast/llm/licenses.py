"""License scans: short notices found exactly and with a bounded number of edits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loomcast.llm.common import whole

# Phrases that are counted wherever their words stand consecutively.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Short notices in normal form (lower case, one space between words) and labels.
NOTICES = {
    "all rights reserved": "reserved",
    "artistic license 2 0": "artistic-2.0",
    "boost software license version 1 0": "bsl-1.0",
    "cc0 1 0 universal public domain dedication": "cc0",
    "common development and distribution license": "cddl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by nc sa": "cc-by-nc-sa",
    "licensed under cc by nd": "cc-by-nd",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under the apache license version 2 0": "apache-2.0",
    "microsoft public license": "ms-pl",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
    "of the license or at your option any later version": "or-later",
    "open data commons open database license": "odbl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "python software foundation license": "psf",
    "released under the mit license": "mit",
    "sil open font license": "ofl",
    "spdx license identifier": "spdx",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "under a creative commons attribution": "cc-by",
}

# ASCII letters in lower case, digits and all bytes above ASCII stay; the rest parts words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


@dataclass(frozen=True)
class Fuzzy:
    """One edit is allowed per ``letters_per_edit`` letters of a notice."""

    letters_per_edit: int = 12

    def edits(self, notice: str) -> int:
        return len(notice) // self.letters_per_edit


@cache
def compiled(fuzzy: Fuzzy) -> list[tuple[str, str, int, list[tuple[int, str]], regex.Pattern]]:
    """Per notice: its label, edits, exact seeds with their offsets, and the bounded-error pattern.

    A notice with k edits is split into k + 1 pieces; one of them must occur unchanged.
    """
    out = []
    for notice, label in NOTICES.items():
        k = fuzzy.edits(notice)
        borders = [round(i * len(notice) / (k + 1)) for i in range(k + 2)]
        seeds = [(a, notice[a:b]) for a, b in zip(borders, borders[1:], strict=False)]
        pattern = regex.compile(rf"(?be)(?<![^ ])(?:{regex.escape(notice)}){{e<={k}}}(?![^ ])")
        out.append((notice, label, k, seeds, pattern))
    return out


def normal_words(text: str) -> list[bytes]:
    """Words of the text after lower-casing A-Z: runs of digits, letters and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def _matches(pattern: regex.Pattern, text: str, start: int, end: int) -> Iterator[regex.Match]:
    """All matches in a stretch of text that do not overlap: the best one, then those on both sides of it."""
    stretches = [(start, end)]
    while stretches:
        a, b = stretches.pop()
        m = pattern.search(text, a, b)
        if m and m.end() > m.start():
            yield m
            stretches += [(a, m.start()), (m.end(), b)]


def fuzzy_hits(joined: bytes, fuzzy: Fuzzy) -> list[tuple[str, int, int, float]]:
    """(label, start, end, score) of notices in a normal text, in characters of its decoded form.

    Hits of one notice that overlap are the best one; ties go to the first.
    """
    found = []
    text = None
    for notice, label, k, seeds, pattern in compiled(fuzzy):
        if not any(seed.encode() in joined for _, seed in seeds):
            continue
        text = joined.decode("utf-8", "surrogatepass") if text is None else text
        windows = []
        for offset, seed in seeds:
            at = text.find(seed)
            while at >= 0:
                windows.append((max(0, at - offset - k - 1), at - offset + len(notice) + k + 1))
                at = text.find(seed, at + 1)
        reach, hits = -1, []
        merged: list[list[int]] = []
        for a, b in sorted(windows):
            if merged and a <= reach:
                reach = merged[-1][1] = max(reach, b)
            else:
                merged.append([a, b])
                reach = b
        for a, b in merged:
            for m in _matches(pattern, text, a, b):
                hits.append((label, m.start(), m.end(), 1.0 - sum(m.fuzzy_counts) / len(notice)))
        found += hits
    return sorted(found, key=lambda h: (h[1], h[2], h[0]))


def scan(text: str, fuzzy: Fuzzy = Fuzzy()) -> dict:
    """Exact places of the base phrases, fuzzy notices with spans, labels and score of one text."""
    words = normal_words(text)
    joined = b" " + b" ".join(words) + b" "
    starts, base = [], set()
    for phrase, label in PHRASES.items():
        needle = f" {phrase} ".encode()
        at = joined.find(needle)
        before, counted = 0, 0  # words before a place, counted forward from the last one
        while at >= 0:
            counted += joined.count(b" ", before, at)
            before = at
            starts.append(counted)
            base.add(label)
            at = joined.find(needle, at + 1)
    hits = fuzzy_hits(joined[1:-1], fuzzy)
    return {
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts) if starts else None,
        "last_word": max(starts) if starts else None,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {h[0] for h in hits})),
        "score": 1.0 if starts else max((h[3] for h in hits), default=0.0),
        "spans": hits,
    }


def scan_licenses(docs: DataFrame, fuzzy: Fuzzy = Fuzzy()) -> DataFrame:
    """Base places, labels and spans of notices of every whole text, one row per input row.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans
    (label, start, end in characters of the normal text, score). A null text counts as empty;
    without a place the words are null and the score is 0; repeated rows and null ids give
    rows of their own; columns besides doc_id and text are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    columns = {
        "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
        "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(span),
    }
    names = [f.name for f in span]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(text.as_py(), fuzzy) for text in batch.column("text")]
            for row in rows:
                row["spans"] = [dict(zip(names, s, strict=True)) for s in row["spans"]]
            arrays = [pa.array([r[c] for r in rows], k) for c, k in columns.items()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *columns])

    return docs.select("doc_id", whole().alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, spans array<struct<label:string,start:bigint,end:bigint,score:double>>",
    )
