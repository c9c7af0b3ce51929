"""Licence recognition by sentences and rules.

A text is cut into sentences, these are normalised and mapped to the identifiers of known licence
sentences. The sequence of a text's identifiers is then matched against licence rules in
their order: the first rule whose identifiers stand there one after the other names a licence
and uses them up. Identifiers left over and sentences that only sound like a licence are told.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stintlake.llm.common import text_bytes

# Sentences of public licence texts and notices, normalised, as patterns. A named
# group ``v`` holds a version and ``k`` the kind of a Creative Commons licence.
_V = r"(?:v\.? ?|version )?(?P<v>\d(?:\.\d)*)"
_VERB = r"(?:licensed|released|distributed|available|published|provided)"
_NOTICE = r"(?:.* )?(?:is |are )?(?:licensed|released|distributed|available|published|provided|made available) under "
SENTENCES: list[tuple[str, str]] = [
    ("copyright", r"(?:copyright|\(c\)|©)(?: \(c\)| ©)? .*|all rights reserved"),
    ("spdx", r"spdx license identifier (?P<k>[a-z0-9.+-]+)"),
    ("mit-notice", _NOTICE + r"(?:the )?mit license(?: terms)?"),
    ("mit-title", r"(?:the )?mit license(?: \(mit\))?"),
    ("mit-grant", r"permission is hereby granted,? free of charge,? to any person obtaining a copy of this software and associated documentation files.*"),
    ("mit-condition", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-warranty", r"the software is provided as is,? without warranty of any kind,? express or implied.*"),
    ("mit-liability", r"in no event shall the authors or copyright holders be liable for any claim,? damages or other liability.*"),
    ("isc-grant", r"permission to use,? copy,? modify,? and(?: or |/or )distribute this software for any purpose with or without fee is hereby granted.*"),
    ("isc-warranty", r"the software is provided as is and the author disclaims all warranties.*"),
    ("apache-notice", _NOTICE + r"(?:the )?apache license,? " + _V + r"(?: \(the license\))?"),
    ("apache-compliance", r"you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at(?: https?//\S+)?"),
    ("apache-warranty", r"unless required by applicable law or agreed to in writing,? software distributed under the license is distributed on an as is basis.*"),
    ("apache-see", r"see the license for the specific language governing permissions and limitations under the license"),
    ("bsd-notice", _NOTICE + r"(?:the |a )?(?P<k>[23]|two|three|new|simplified)?[ -]?(?:clause )?bsd(?: (?P<v>[23])[ -]clause)? license"),
    ("bsd-grant", r"redistribution and use in source and binary forms,? with or without modification,? are permitted provided that the following conditions are met"),
    ("bsd-source", r"(?:\W*\d?\W*)?redistributions of source code must retain the above copyright notice,? this list of conditions and the following disclaimer"),
    ("bsd-binary", r"(?:\W*\d?\W*)?redistributions in binary form must reproduce the above copyright notice,? this list of conditions and the following disclaimer in the documentation.*"),
    ("bsd-names", r"(?:\W*\d?\W*)?neither the name of .* nor the names of (?:its|their) contributors may be used to endorse or promote products.*"),
    ("bsd-warranty", r"this software is provided by the .* as is and any express or implied warranties.*"),
    ("gpl-notice", _NOTICE + r"(?:the )?(?:gnu )?(?P<k>lesser |library |affero )?(?:general public license|gpl),? " + _V + r"(?P<later> or (?:\(at your option\) )?(?:any )?later(?: version)?)?"),
    ("gpl-free", r"this (?:program|library|software) is free software you can redistribute it and(?: or |/or )modify it under the terms of the gnu (?P<k>lesser |library |affero )?general public license as published by the free software foundation,? either " + _V + r"(?: of the license)?(?P<later>,? or \(at your option\) any later version)?"),
    ("gpl-hope", r"this (?:program|library|software) is distributed in the hope that it will be useful,? but without any warranty.*"),
    ("gpl-see", r"see the gnu (?:lesser |library |affero )?general public license for more details"),
    ("gpl-received", r"you should have received a copy of the gnu (?:lesser |library |affero )?general public license along with this.*"),
    ("mpl-notice", r"this source code form is subject to the terms of the mozilla public license,? " + _V),
    ("mpl-copy", r"if a copy of the mpl was not distributed with this file,? you can obtain one at.*"),
    ("cc-notice", _NOTICE + r"(?:a |the )?(?:cc|creative commons) ?(?P<k>by(?: ?- ?(?:nc|sa|nd))*)(?: ?-? ?" + _V + r")?(?: (?:international|unported))?(?: license)?"),
    ("cc-words", _NOTICE + r"(?:a |the )?creative commons (?P<k>attribution(?:[ -]+(?:noncommercial|non-commercial|sharealike|share alike|noderivatives|noderivs))*) " + _V + r"(?: (?:international|unported))?(?: license)?"),
    ("cc0-notice", _NOTICE + r"(?:the )?(?:cc0|creative commons zero)(?: ?" + _V + r")?(?: universal)?.*"),
    ("mpl-words", _NOTICE + r"(?:the )?(?:mozilla public license|mpl),?[ -]" + _V),
    ("epl-words", _NOTICE + r"(?:the )?(?:eclipse public license|epl),?(?: -)?[ -]" + _V),
    ("eupl-words", _NOTICE + r"(?:the )?(?:european union public license|eupl),?[ -]" + _V),
    ("boost-words", _NOTICE + r"(?:the )?boost software license,?(?: -)? " + _V),
    ("zlib-words", _NOTICE + r"(?:the )?zlib(?:/libpng)?(?: license)?"),
    ("wtfpl-words", _NOTICE + r"(?:the )?(?:wtfpl|do what the fuck you want to public license)(?: license)?"),
    ("id-notice", _NOTICE + r"(?:the )?(?P<k>mit|isc|unlicense|bsd-[23]-clause|apache-2\.0|apache 2\.0|bsl-1\.0|[al]?gpl-[23]\.[01](?:-only|-or-later)?)(?: license)?"),
    ("unlicense-grant", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", r"(?:.* )?(?:is |are )?(?:dedicated to|released into|placed in|in) the public domain"),
]
# Licence rules in order, whole texts before notices. ``{k}`` and ``{v}`` come from
# the first sentence that has them.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("SPDX:{k}", ("spdx",)),
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-title", "mit-grant", "mit-condition", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-{v}", ("apache-notice", "apache-compliance", "apache-copy", "apache-warranty", "apache-see")),
    ("Apache-{v}", ("apache-notice", "apache-compliance")),
    ("{k}GPL-{v}", ("gpl-free", "gpl-hope", "gpl-see", "gpl-received")),
    ("{k}GPL-{v}", ("gpl-free", "gpl-hope")),
    ("MPL-{v}", ("mpl-notice", "mpl-copy")),
    ("Unlicense", ("unlicense-grant",)),
    ("{k}GPL-{v}", ("gpl-free",)),
    ("{k}GPL-{v}", ("gpl-notice",)),
    ("Apache-{v}", ("apache-notice",)),
    ("MPL-{v}", ("mpl-notice",)),
    ("MPL-{v}", ("mpl-words",)),
    ("EPL-{v}", ("epl-words",)),
    ("EUPL-{v}", ("eupl-words",)),
    ("BSL-{v}", ("boost-words",)),
    ("Zlib", ("zlib-words",)),
    ("WTFPL", ("wtfpl-words",)),
    ("ID:{k}", ("id-notice",)),
    ("BSD", ("bsd-notice",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-title",)),
    ("CC0-{v}", ("cc0-notice",)),
    ("CC-{k}-{v}", ("cc-notice",)),
    ("CC-{k}-{v}", ("cc-words",)),
    ("Public-Domain", ("public-domain",)),
]
# What makes a sentence worth a look.
_TRIGGER = re.compile(
    r"licen[cs]e|copyright|©|\(c\)|spdx|permission|redistribution|warrant|all\W+rights\W+reserved"
    r"|public\W+domain|creative\W+commons|free\W+software|in\W+no\W+event|neither\W+the\W+name"
    r"|mozilla|\bmpl\b|(?:released|distributed|available|published|provided)\W+under", re.I,
)
_KIND_WORDS = {
    "lesser": "L", "library": "L", "affero": "A", "attribution": "BY", "noncommercial": "NC",
    "non-commercial": "NC", "sharealike": "SA", "share alike": "SA", "noderivatives": "ND", "noderivs": "ND",
}

# Identifiers that are not written in capitals throughout.
_IDENTIFIERS = {
    "apache-2.0": "Apache-2.0", "apache 2.0": "Apache-2.0", "unlicense": "Unlicense",
    "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause",
}

_PATTERNS = [
    (name, re.compile(pattern)) for name, pattern in SENTENCES if not pattern.startswith(_NOTICE)
]
#: What stands behind the verb of a notice, wherever it is in a sentence.
_NOTICES = [
    (name, re.compile(pattern.removeprefix(_NOTICE).removesuffix(".*") + r"(?!\w|\.\w)"))
    for name, pattern in SENTENCES if pattern.startswith(_NOTICE)
]
_UNDER = re.compile(r"\b" + _VERB + r" under (?:either |both )?")
#: Between two licences of one notice.
_JOIN = re.compile(r",? (?:and/or|and|or|as well as) (?:under )?")
_STARTS_NOTICE = re.compile(_VERB, re.I)
_SIGN = r"(?://+|/?\*+/?|#+|--|>+)"
#: A line that opens a copyright statement; wrapped words on copyright holders and the like do not.
_COPYRIGHT = (
    rf"^[ \t]*{_SIGN}?[ \t]*(?:(?:\(c\)|©)[ \t]*(?:copyright\b|\d{{4}})|copyright[ \t:]+(?:\(c\)|©|\d{{4}}|by\b"
    r"|(?!(?:notices?|holders?|owners?|laws?|licen[cs]es?|statements?|and|or|is|in|to|the above)\b)\w))"
)
_SPACE = rf"\s+(?:{_SIGN}\s+)?"
#: Ends of sentences: a mark before white space or the end, the colon before a list of conditions, a
#: line that is empty or holds a comment sign only, the beginning of a grant that stands on the line of
#: a copyright statement, and both ends of a line that opens one.
_BREAK = re.compile(
    rf"(?<!\bv)[.!?;]+(?=\s|$)|(?<=conditions):(?=\s|$)|(?<=\smet):(?=\s|$)|\n[ \t\r]*{_SIGN}?[ \t\r]*\n"
    rf"|(?=\bpermission{_SPACE}is{_SPACE}hereby{_SPACE}granted\b)"
    rf"|(?=\bpermission{_SPACE}to{_SPACE}use,)"
    rf"|(?=\bredistribution{_SPACE}and{_SPACE}use{_SPACE}in{_SPACE}source\b)", re.I,
)
_COPYRIGHT_LINE = re.compile(_COPYRIGHT + r"[^\n]*", re.I | re.M)
#: Ends a sentence, whatever stands before it.
_PUBLIC = re.compile(r"(?:is |are )?\b(?:dedicated to|released into|placed in|in) the public domain\b")


def _plain(text: str) -> str:
    """Lower case, one spelling of licence, no quotes, comment signs or white space runs."""
    s = text.lower().replace("licence", "license").replace("spdx-license-identifier", "spdx license identifier")
    s = re.sub(r"[\"'`“”‘’:;!?]", "", s)
    s = re.sub(r"(?:^|\n)[ \t]*(?://+|/?\*+/?|#+|--|>+)?[ \t]*", " ", s)
    return " ".join(s.split())


def normalise(sentence: str) -> str:
    """A sentence as the patterns have it."""
    return _plain(sentence).strip(" .,-*/#")


Hit = tuple[str, dict[str, str | None]]


def placed_notices(text: str) -> Iterator[tuple[int, int, Hit]]:
    """Where the notices in a normalised text begin and end, with identifiers and groups, in order."""
    at = 0
    while verb := _UNDER.search(text, at):
        at = verb.end()
        while True:
            hits = [(m.end(), name, m) for name, p in _NOTICES if (m := p.match(text, at))]
            if not hits:
                break
            at, name, m = max(hits, key=lambda h: h[0])
            yield verb.start(), at, (name, m.groupdict())
            more = _JOIN.match(text, at)
            if not more:
                break
            at = more.end()


def notices(text: str) -> list[Hit]:
    """Identifiers and groups of all notices in a normalised sentence, in order."""
    return [hit for _, _, hit in placed_notices(text)]


def identify(sentence: str) -> list[tuple[str, dict[str, str | None]]]:
    """The identifier of a known sentence and its groups, and those of notices inside."""
    if not _TRIGGER.search(sentence):
        return []
    text = normalise(sentence)
    for name, pattern in _PATTERNS:
        if name == "copyright" and "\n" in sentence.strip():
            continue  # a copyright statement ends with its line
        m = pattern.fullmatch(text)
        if m:
            inside = notices(text)
            # an open beginning stands before the words, an open end after them
            own = [(name, m.groupdict())]
            return [*inside, *own] if name == "public-domain" else [*own, *inside]
    return []


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Places of the sentences that a trigger word occurs in."""
    breaks = [m.span() for m in _BREAK.finditer(text)]
    grants = [start for start, end in breaks if start == end]
    for m in _COPYRIGHT_LINE.finditer(text):
        # a grant that begins on the line goes on behind it
        grant = bisect.bisect_right(grants, m.start())
        end = m.end() if grant == len(grants) else min(m.end(), grants[grant])
        breaks += [(m.start(), m.start()), (end, end)]
    start = 0
    for end in [*sorted(breaks), (len(text), len(text))]:
        if start < end[0] and _TRIGGER.search(text, start, end[0]):
            yield start, end[0]
        start = max(start, end[1])


def _known(text: str, start: int, end: int) -> Iterator[tuple[str | None, dict, int, int]]:
    """Identified sentences in one stretch; if the whole is unknown, those that begin with a line.

    The stretch is normalised once, line by line. A known sentence may be wrapped over any number of
    lines; it begins and ends with a line, a notice may stand anywhere.
    """
    whole = identify(text[start:end])
    if whole:
        for hit in whole:
            yield *hit, start, end
        return
    places, begins, parts, at, size = [], [], [], start, 0
    for line in text[start:end].split("\n"):
        plain = _plain(line)
        if plain:
            places.append((at, at + len(line)))
            begins.append(size)
            parts.append(plain)
            size += len(plain) + 1
        at += len(line) + 1
    joined = " ".join(parts)
    ends = [b + len(p.rstrip(" .,-*/#")) for b, p in zip(begins, parts)]

    def line_of(offset: int) -> int:
        return bisect.bisect_right(begins, offset) - 1

    found: list[tuple[int, int, Hit]] = []
    used = 0
    for i, first in enumerate(begins):
        if first < used:
            continue
        for name, pattern in _PATTERNS:
            if name == "public-domain":
                continue
            own = pattern.fullmatch(joined, first, ends[i]) if name == "copyright" else pattern.match(joined, first)
            if own and (own.end() == len(joined) or own.end() >= ends[line_of(own.end() - 1)]):
                used = own.end()
                found.append((first, used, (name, own.groupdict())))
                break
    found += placed_notices(joined)
    found += [
        (m.start(), m.end(), ("public-domain", {})) for m in _PUBLIC.finditer(joined)
        if m.end() >= ends[line_of(m.end() - 1)]
    ]
    for a, b, hit in sorted(found, key=lambda f: f[:2]):
        yield *hit, places[line_of(a)][0], places[line_of(b - 1)][1]
    if not found:
        yield None, {}, start, end


def _name(template: str, groups: list[dict]) -> str:
    first = lambda key: next((g[key] for g in groups if g.get(key)), "") or ""
    kind = first("k").strip()
    if template.startswith("CC-"):
        kind = "-".join(_KIND_WORDS.get(w, w.upper()) for w in re.findall(r"non-commercial|share alike|[a-z]+", kind))
    elif "GPL" in template:
        kind = _KIND_WORDS.get(kind, "")
    elif template.startswith("ID:"):
        words = re.sub(r"-(?:ONLY|OR-LATER)$", lambda m: m[0].lower(), kind.upper())
        return _IDENTIFIERS.get(kind, words)
    version = first("v")
    if "GPL" in template and version:
        version = (version if "." in version else f"{version}.0") + ("-or-later" if first("later") else "")
    return template.format(k=kind, v=version).rstrip("-")


def scan(text: str) -> dict:
    """Licences of one text in order of place, what is left over, and spans of the evidence."""
    found = [(*k, n) for n, k in enumerate(k for a, b in sentences(text) for k in _known(text, a, b))]
    known = [k for k in found if k[0]]
    licenses: list[tuple[int, str]] = []
    left = [k for k in known if k[0] != "copyright"]
    for template, wanted in RULES:
        rest, i = [], 0
        while i < len(left):
            took = left[i:i + len(wanted)]
            if tuple(k[0] for k in took) == wanted:
                licenses.append((took[0][4], _name(template, [k[1] for k in took])))
                i += len(wanted)
            else:
                rest.append(left[i])
                i += 1
        left = rest
    spans = sorted({(k[2], k[3]) for k in found if k[0]})
    return {
        "licenses": [name for _, name in sorted(licenses)],
        "unmatched": [k[0] for k in left],
        "copyrights": sum(k[0] == "copyright" for k in found),
        "unknown": sum(k[0] is None for k in found),
        "spans": [{"first": a, "last": b} for a, b in spans],
    }


_ADDED = (
    "licenses array<string>, unmatched array<string>, copyrights int, unknown int,"
    " spans array<struct<first:int,last:int>>"
)
_ADDED_ARROW = {
    "licenses": pa.list_(pa.string()), "unmatched": pa.list_(pa.string()), "copyrights": pa.int32(),
    "unknown": pa.int32(), "spans": pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])),
}
_NOTHING = {"licenses": [], "unmatched": [], "copyrights": 0, "unknown": 0, "spans": []}


def scan_licenses(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with what ``scan`` finds in the whole text.

    ``licenses`` are the names by rule, in order of place and repeated if found again;
    ``unmatched`` known sentences that no rule used; ``copyrights`` and ``unknown`` count
    copyright lines and sentences that only sound like a licence; ``spans`` are the character
    ranges of known sentences. NULL and empty texts have none. Input columns of these names are
    replaced; an empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in _ADDED_ARROW]
    at = names.index("text")
    given = docs.select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in text_bytes(batch.column(at)):
                text = raw.decode("utf-8", "replace")
                rows.append(scan(text) if _TRIGGER.search(text) else _NOTHING)
            added = [pa.array([r[c] for r in rows], kind) for c, kind in _ADDED_ARROW.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*names, *_ADDED_ARROW])

    return given.mapInArrow(run, T.StructType([*given.schema.fields, *T.StructType.fromDDL(_ADDED).fields]))
