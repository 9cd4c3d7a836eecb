"""License scans with ordered signature rules.

Each license has a hand-written name pattern; each kind of signature (SPDX tag,
grant, URL, plain mention) wraps every name, which gives hundreds of rules, and
the grants' own wording adds more.  A rule runs only where its keywords stand in
the text.  Detections then compete: one that lies within the interval of another of
higher priority, or within a longer one (or an equal one of an earlier rule) of the same
priority, is suppressed; a longer one of lower priority suppresses nothing.  So a name
without a version gives way to the same name with one.  One sweep over the detections by
place, with the furthest end seen of each priority, settles all of that.

Map-only: one pass over each text in Arrow batches, one row out per row in.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import pick, text_blocks

W = rb"[0-9a-z\x80-\xff]"
N = rb"[^0-9a-z\x80-\xff]+"

BLOCK_BYTES = 4_000_000
#: Phrases of the contract and their labels.
BASE = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))

#: label, keyword that the name needs, the name's words ("(x)?" optional), SPDX identifiers, URL part.
NAMES = (
    ("mit", "mit", "mit", "mit", "opensource.org/licenses/mit"),
    ("mit", "expat", "expat", "", ""),
    ("mit", "x11", "x11", "", ""),
    ("mit-0", "mit", "mit no attribution", "mit-0", "opensource.org/licenses/mit-0"),
    ("apache-1.1", "apache", "apache (software )?(license )?(version |v ?)?1 1", "apache-1.1", "apache.org/licenses/license-1.1"),
    ("apache-2.0", "apache", "apache (software )?(license )?(version |v ?)?2( 0)?", "apache-2.0", "apache.org/licenses/license-2.0"),
    ("bsd-2-clause", "bsd", "(simplified bsd|freebsd|bsd 2 clause|2 clause bsd)", "bsd-2-clause", "opensource.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", "bsd", "(new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)", "bsd-3-clause", "opensource.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", "bsd", "(original bsd|bsd 4 clause|4 clause bsd)", "bsd-4-clause", "opensource.org/licenses/bsd-4-clause"),
    ("0bsd", "bsd", "(zero clause bsd|bsd zero clause|0bsd)", "0bsd", "opensource.org/licenses/0bsd"),
    ("isc", "isc", "isc", "isc", "opensource.org/licenses/isc"),
    ("gpl-1.0", "gpl", "(gnu )?gpl (version |v ?)?1( 0)?", "gpl-1.0(-only|-or-later)?", "gnu.org/licenses/gpl-1.0"),
    ("gpl-2.0", "gpl", "(gnu )?gpl (version |v ?)?2( 0)?", "gpl-2.0(-only|-or-later)?", "gnu.org/licenses/gpl-2.0"),
    ("gpl-3.0", "gpl", "(gnu )?gpl (version |v ?)?3( 0)?", "gpl-3.0(-only|-or-later)?", "gnu.org/licenses/gpl-3.0"),
    ("gpl-1.0", "general public", "(gnu )?general public license (version |v ?)?1( 0)?", "", ""),
    ("gpl-2.0", "general public", "(gnu )?general public license (version |v ?)?2( 0)?", "", ""),
    ("gpl-3.0", "general public", "(gnu )?general public license (version |v ?)?3( 0)?", "", "gnu.org/licenses/gpl"),
    ("lgpl-2.1", "lgpl", "(gnu )?lgpl (version |v ?)?2 1", "lgpl-2.1(-only|-or-later)?", "gnu.org/licenses/lgpl-2.1"),
    ("lgpl-3.0", "lgpl", "(gnu )?lgpl (version |v ?)?3( 0)?", "lgpl-3.0(-only|-or-later)?", "gnu.org/licenses/lgpl-3.0"),
    ("lgpl-2.1", "lesser general", "(gnu )?lesser general public license (version |v ?)?2 1", "", ""),
    ("lgpl-3.0", "lesser general", "(gnu )?lesser general public license (version |v ?)?3( 0)?", "", ""),
    ("lgpl-2.0", "library general", "(gnu )?library general public license", "lgpl-2.0(-only|-or-later)?", "gnu.org/licenses/lgpl-2.0"),
    ("agpl-3.0", "agpl", "(gnu )?agpl (version |v ?)?3( 0)?", "agpl-3.0(-only|-or-later)?", "gnu.org/licenses/agpl"),
    ("agpl-3.0", "affero", "(gnu )?affero general public license( version 3| v3)?( 0)?", "", ""),
    ("gfdl", "free documentation", "(gnu )?free documentation license", "gfdl-1.[123](-only|-or-later)?", "gnu.org/licenses/fdl"),
    ("mpl-1.1", "mozilla", "mozilla public license (version |v ?)?1 1", "mpl-1.1", "mozilla.org/mpl/1.1"),
    ("mpl-2.0", "mozilla", "mozilla public license (version |v ?)?2( 0)?", "mpl-2.0", "mozilla.org/mpl/2.0"),
    ("mpl-2.0", "mpl", "mpl (version |v ?)?2( 0)?", "", ""),
    ("epl-1.0", "eclipse", "eclipse public license (version |v ?)?1( 0)?", "epl-1.0", "eclipse.org/legal/epl-v10"),
    ("epl-2.0", "eclipse", "eclipse public license (version |v ?)?2( 0)?", "epl-2.0", "eclipse.org/legal/epl-2.0"),
    ("cddl-1.0", "common development", "common development and distribution license", "cddl-1.[01]", "opensource.org/licenses/cddl-1.0"),
    ("cpl-1.0", "common public", "common public license", "cpl-1.0", "opensource.org/licenses/cpl1.0"),
    ("eupl-1.2", "european union", "european union public licen[cs]e", "eupl-1.[12]", "eupl.eu"),
    ("artistic-1.0", "artistic", "artistic license (version |v ?)?1( 0)?", "artistic-1.0(-perl|-cl8)?", "opensource.org/licenses/artistic-1.0"),
    ("artistic-2.0", "artistic", "artistic license (version |v ?)?2( 0)?", "artistic-2.0", "opensource.org/licenses/artistic-2.0"),
    ("bsl-1.0", "boost", "boost software license", "bsl-1.0", "boost.org/license_1_0"),
    ("busl-1.1", "business source", "business source license", "busl-1.1", "mariadb.com/bsl11"),
    ("sspl-1.0", "server side", "server side public license", "sspl-1.0", "mongodb.com/licensing/server-side-public-license"),
    ("elastic-2.0", "elastic", "elastic license( 2 0| version 2)?", "elastic-2.0", "elastic.co/licensing/elastic-license"),
    ("polyform-nc-1.0.0", "polyform", "polyform noncommercial", "polyform-noncommercial-1.0.0", "polyformproject.org/licenses/noncommercial"),
    ("zlib", "zlib", "zlib( libpng)?", "zlib", "opensource.org/licenses/zlib"),
    ("libpng", "libpng", "libpng", "libpng(-2.0)?", "libpng.org/pub/png/src/libpng-license"),
    ("unlicense", "unlicense", "unlicense", "unlicense", "unlicense.org"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", "wtfpl.net"),
    ("python-2.0", "python", "python software foundation license", "(python-2.0|psf-2.0)", "docs.python.org/3/license"),
    ("php-3.01", "php", "php license", "php-3.01?", "php.net/license"),
    ("openssl", "openssl", "openssl", "openssl", "openssl.org/source/license"),
    ("postgresql", "postgresql", "postgresql", "postgresql", "opensource.org/licenses/postgresql"),
    ("ofl-1.1", "open font", "(sil )?open font license", "ofl-1.1", "scripts.sil.org/ofl"),
    ("odbl-1.0", "open database", "open database license", "odbl-1.0", "opendatacommons.org/licenses/odbl"),
    ("odc-by-1.0", "open data commons", "open data commons attribution", "odc-by-1.0", "opendatacommons.org/licenses/by"),
    ("pddl-1.0", "public domain dedication", "public domain dedication and license", "pddl-1.0", "opendatacommons.org/licenses/pddl"),
    ("cc0-1.0", "cc0", "cc0( 1 0)?", "cc0-1.0", "creativecommons.org/publicdomain/zero"),
    ("cc-by-3.0", "cc by", "cc by 3( 0)?", "cc-by-3.0", "creativecommons.org/licenses/by/3"),
    ("cc-by-4.0", "cc by", "cc by 4( 0)?", "cc-by-4.0", "creativecommons.org/licenses/by/4"),
    ("cc-by-sa-3.0", "cc by", "cc by sa 3( 0)?", "cc-by-sa-3.0", "creativecommons.org/licenses/by-sa/3"),
    ("cc-by-sa-4.0", "cc by", "cc by sa 4( 0)?", "cc-by-sa-4.0", "creativecommons.org/licenses/by-sa/4"),
    ("cc-by-nd-4.0", "cc by", "cc by nd( 4( 0)?)?", "cc-by-nd-4.0", "creativecommons.org/licenses/by-nd"),
    ("cc-by-nc-4.0", "cc by", "cc by nc 4( 0)?", "cc-by-nc-4.0", "creativecommons.org/licenses/by-nc/4"),
    ("cc-by-nc-sa-4.0", "cc by", "cc by nc sa( 4( 0)?)?", "cc-by-nc-sa-4.0", "creativecommons.org/licenses/by-nc-sa"),
    ("cc-by-nc-nd-4.0", "cc by", "cc by nc nd( 4( 0)?)?", "cc-by-nc-nd-4.0", "creativecommons.org/licenses/by-nc-nd"),
    ("gpl", "gpl", "(gnu )?gpl", "", ""),
    ("gpl", "general public", "(gnu )?general public license", "", ""),
    ("lgpl", "lgpl", "(gnu )?lgpl", "", ""),
    ("lgpl", "lesser general", "(gnu )?lesser general public license", "", ""),
    ("agpl", "agpl", "(gnu )?agpl", "", ""),
    ("apache", "apache", "apache (software )?license", "", ""),
    ("bsd", "bsd", "bsd", "", ""),
    ("mpl", "mozilla", "mozilla public license", "", ""),
    ("epl", "eclipse", "eclipse public license", "", ""),
    ("artistic", "artistic", "artistic license", "", ""),
    ("ms-pl", "microsoft public", "microsoft public license", "ms-pl", "opensource.org/licenses/ms-pl"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal license", "ms-rl", "opensource.org/licenses/ms-rl"),
    ("cc-by-sa", "cc by", "cc by sa( [0-9]( [0-9])?)?", "cc-by-sa-[12].[05]", "creativecommons.org/licenses/by-sa/2"),
    ("cc-by-nc", "cc by", "cc by nc( [0-9]( [0-9])?)?", "cc-by-nc-[123].[05]", "creativecommons.org/licenses/by-nc/2"),
    ("cc-by-nd", "cc by", "cc by nd [0-9]( [0-9])?", "cc-by-nd-[123].[05]", ""),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike", "", ""),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial", "", ""),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(ative)?s?", "", ""),
    ("cc-by-any", "creative commons", "creative commons attribution", "", ""),
)

#: label, keyword, wording of a grant.
TEXTS = (
    ("mit", "permission is", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification"),
    ("gpl", "redistribute", "redistribute it and or modify it under the terms of the gnu (lesser |affero )?general public license"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", "(dedicated|released|placed) (in)?to the public domain"),
    ("public-domain", "public domain", "in the public domain"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("proprietary", "reproduced", "may not be reproduced (or distributed )?without (prior )?(written )?permission"),
    ("copyright", "copyright", "copyright (c )?(19|20)[0-9][0-9]"),
    ("mit", "permission notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as-is", "warranty", "(software|work|program|material) is provided as is (and )?without (any )?(express or implied )?warranty"),
    ("bsd", "redistributions", "redistributions (of source code|in binary form) must (retain|reproduce) the above copyright notice"),
    ("bsd-3-clause", "endorse", "names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "applicable", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "contributor", "licensed to the apache software foundation (asf )?under one or more contributor license agreements"),
    ("gpl", "free software", "(this program|this file|this library|it) is free software you can redistribute it"),
    ("gpl-2.0-or-later", "later", "either version 2 of the license or (at your option )?any later version"),
    ("gpl-3.0-or-later", "later", "either version 3 of the license or (at your option )?any later version"),
    ("gpl", "received", "you should have received a copy of the gnu general public license"),
    ("lgpl", "received", "you should have received a copy of the gnu (lesser|library) general public license"),
    ("agpl", "received", "you should have received a copy of the gnu affero general public license"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("bsl-1.0", "accompanying", "copy of the software and accompanying documentation covered by this license"),
    ("wtfpl", "public license", "do what the fuck you want to public license"),
    ("cc0-1.0", "waiv", "waiv(ed|ing) all (of his or her )?(copyright|rights to the work)"),
    ("json", "good", "the software shall be used for good not evil"),
    ("beerware", "beer", "beer ware license"),
    ("openssl", "openssl", "includes software developed by the openssl project"),
    ("epl", "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("mpl-2.0", "mpl", "if a copy of the mpl was not distributed with this file"),
    ("unlicense", "anyone", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("public-domain", "disclaims", "the author disclaims copyright to this source code"),
    ("public-domain", "copyright", "no (known )?copyright restrictions"),
    ("proprietary", "proprietary", "(confidential and )?proprietary information of"),
    ("proprietary", "unauthorized", "unauthorized copying of this (file|software|document)"),
    ("proprietary", "reproduced", "no part of this (publication|document|work|book) may be reproduced"),
    ("proprietary", "internal use", "for internal use only"),
    ("noncommercial", "commercial", "(for non ?commercial use only|not for commercial use)"),
    ("noncommercial", "personal", "for personal use only"),
    ("permission", "permission", "(reprinted|used|reproduced) (with|by) (the )?(kind )?permission"),
)

#: kind, priority, confidence, what stands around the name, a word that it needs.
KINDS = (
    ("tag", 4, 1.0, "", "spdx"),
    ("url", 3, 0.9, "", "/"),
    ("grant", 3, 0.95, "(licen[cs]ed|released|distributed|published|available|provided) (to you )?under (the )?(terms of )?(the )?", "under"),
    ("mention", 2, 0.6, "", "licen"),
)


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    priority: int
    confidence: float
    keywords: tuple[bytes, ...]
    regex: re.Pattern[bytes]


def words_pattern(words: str) -> bytes:
    """Words with anything that is no word between them; " )" takes its gap into the group."""
    return words.encode().replace(b" ?", b"\0").replace(b" ", N).replace(b"\0", b"(?:" + N + b")?")


@functools.lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, strongest first."""
    out: list[tuple] = []
    for label, keyword, name, spdx, url in NAMES:
        needs = keyword.split(" ")
        for kind, priority, confidence, around, word in KINDS:
            if kind == "tag" and spdx:
                out.append((label, priority, confidence, ("spdx",), rb"spdx-license-identifier:[ \t(]*(?:" + spdx.encode().replace(b".", rb"\.") + rb")(?![a-z0-9.-])"))
            elif kind == "url" and url:
                out.append((label, priority, confidence, (url.split("/")[0],), re.escape(url.encode()) + rb"(?![a-z0-9])"))
            elif kind == "grant":
                out.append((label, priority, confidence, (word, *needs), rb"(?<!%b)%b(?:%b)(?:%blicen[cs]e)?(?!%b)" % (W, words_pattern(around), words_pattern(name), N, W)))
            elif kind == "mention" and (" " in name or name.startswith("(")):
                out.append((label, priority, confidence, tuple(needs), rb"(?<!%b)(?:%b)(?:%blicen[cs]e)?(?!%b)" % (W, words_pattern(name), N, W)))
            elif kind == "mention":
                out.append((label, priority, confidence, (word, *needs), rb"(?<!%b)(?:%b)%blicen[cs]e(?!%b)" % (W, words_pattern(name), N, W)))
    for label, keyword, wording in TEXTS:
        out.append((label, 3, 0.9, tuple(keyword.split(" ")), rb"(?<!%b)(?:%b)(?!%b)" % (W, words_pattern(wording), W)))
    out.sort(key=lambda r: -r[1])
    return tuple(
        Rule(i, label, priority, confidence, tuple(k.encode() for k in keys), re.compile(regex))
        for i, (label, priority, confidence, keys, regex) in enumerate(out)
    )


@functools.lru_cache(maxsize=1)
def gates() -> tuple[tuple[bytes, tuple[Rule, ...]], ...]:
    """Rules by their first keyword, which is looked up once per text for all of them."""
    by: dict[bytes, list[Rule]] = {}
    for r in rules():
        by.setdefault(r.keywords[0], []).append(r)
    return tuple((k, tuple(v)) for k, v in by.items())


def detect(text: bytes) -> list[tuple[int, int, Rule]]:
    """Detections in a lower-cased text that no other one suppresses, by start."""
    found = []
    for keyword, under in gates():
        if keyword in text:
            for r in under:
                if all(k in text for k in r.keywords[1:]):
                    found += [(m.start(), m.end(), r) for m in r.regex.finditer(text)]
    # by start, long ones first: what contains a detection comes before it
    found.sort(key=lambda d: (d[0], -d[1], d[2].order))
    reach: dict[int, int] = {}  # furthest end so far of each priority
    kept: list[tuple[int, int, Rule]] = []
    for s, e, r in found:
        if all(p < r.priority or end < e for p, end in reach.items()):
            kept.append((s, e, r))
        reach[r.priority] = max(e, reach.get(r.priority, 0))
    return kept


_BASE_RULES = tuple(
    (p.split(b" ")[0] if p != b"cc by" else b"cc", re.compile(rb"(?<!%b)%b(?!%b)" % (W, p.replace(b" ", N), W)), label)
    for p, label in BASE
)
_IS_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def scan(text: bytes) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    is_word = _IS_WORD[np.frombuffer(text, np.uint8)]
    opens = is_word.copy()
    opens[1:] &= ~is_word[:-1]
    text = text.lower()  # of bytes: A-Z only
    places, base = [], set()
    for keyword, regex, label in _BASE_RULES:
        if keyword in text:
            for m in regex.finditer(text):
                places.append(m.start())
                base.add(label)
    first = last = None
    if places:
        first, last = int(np.count_nonzero(opens[: min(places)])), int(np.count_nonzero(opens[: max(places)]))
    kept = detect(text)
    score = max([0.5 * bool(base), *(r.confidence for _, _, r in kept)])
    labels = ",".join(sorted(base | {r.label for _, _, r in kept}))
    return int(np.count_nonzero(opens)), len(places), first, last, ",".join(sorted(base)), labels, score


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ]
)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [scan(t) for _, _, texts in text_blocks(batch.column(1), BLOCK_BYTES) for t in texts]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(SCHEMA)[1:], strict=True))], schema=SCHEMA
        )


def _places(text: bytes, at: list[int]) -> list[int]:
    """Code points before each of the byte places: bytes that begin a character."""
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(begins)])[at].tolist()


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
    names = ["doc_id", "label", "start", "end", "confidence"]
    for batch in batches:
        rows = []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            found = detect(t.lower())
            starts, ends = _places(t, [s for s, _, _ in found]), _places(t, [e for _, e, _ in found])
            rows += [(i, r.label, s, e, r.confidence) for s, e, (_, _, r) in zip(starts, ends, found, strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    Texts are lower-cased in A-Z only.  A null or empty text has no words, empty
    label lists, null places and score 0.  Repeated rows give a row each; null ids
    are carried; further columns are ignored.
    """
    return pick(docs, id_col, text_col).mapInArrow(
        _scanned,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )


def license_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, label, start, end, confidence): every detection kept, in code points, end exclusive.

    Null and empty texts have none; repeated rows give theirs each; null ids are carried;
    an empty table gives an empty result.
    """
    return pick(docs, id_col, text_col).mapInArrow(
        _spans, "doc_id long, label string, start long, end long, confidence double"
    )
