"""License scan by sentence rules.

A text is cut into sentences: at stops followed by white space, at blank
lines, and before lines that begin like a licence sentence; comment signs at
line starts are skipped.  A sentence that is not known as a whole is read in
parts, and a clause may follow the name of a licence.
A sentence is normalised: lower case, "licence" as "license", signs other than
a stop between digits as spaces.  Known licence sentences map a normalised
sentence to an identifier, and to a version where it names one.  The sequence
of identifiers of a text is then matched against ordered rules: at each place
the first rule that matches wins and its sentences are used up; identified
sentences of a rule may have at most GAP other sentences between them.
Identified sentences that no rule uses are reported as ``unmatched``.

One row per finding: doc_id, license, version, identifiers, first and last
sentence number, and the character span [begin, end) of the whole text.
Texts are never cut short.  Null and empty texts and texts without a known
sentence give no rows; repeated rows give equal findings.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = 2

# Sentences of public licences after normalisation, as patterns
# that match the whole sentence; "(v)" stands for a version.
SENTENCES = {
    "spdx": r"spdx license identifier (?P<name>.+)",
    "name-mit": r"(?:.* )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?mit license",
    "name-apache": r"(?:.* )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?apache license(?: version)?(?: ?v)? ?(v)?(?: the license)?",
    "name-gpl": r"(?:.* )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:general public license|gpl)(?: version)?(?: ?v)? ?(v)?(?: or later| or any later version)?",
    "name-lgpl": r"(?:.* )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:lesser general public license|lgpl)(?: version)?(?: ?v)? ?(v)?(?: or later| or any later version)?",
    "name-agpl": r"(?:.* )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:affero general public license|agpl)(?: version)?(?: ?v)? ?(v)?(?: or later| or any later version)?",
    "mpl-form": r"this source code form is subject to the terms of the mozilla public license v (v)",
    "name-mpl": r"(?:.* )?(?:subject to|released under|licensed under|distributed under) (?:the )?(?:terms of )?(?:the )?mozilla public license(?: version)?(?: ?v)? ?(v)?",
    "name-bsd": r"(?:.* )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?(?P<clauses>[234])? ?(?:clause )?bsd(?: (?P<after>[234]) clause)? license",
    "name-cc": r"(?:.* )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:a )?(?:cc|creative commons) (?P<name>0|zero|(?:by|attribution)(?: (?:nc|sa|nd|noncommercial|non commercial|sharealike|share alike|noderivatives))*)(?: license)?(?: version)? ?(v)?(?: international| unported)?(?: license)?",
    "mit-grant": r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files.*",
    "mit-notice": r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "isc-grant": r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted.*",
    "as-is": r"(?:the|this) software is provided (?:by .* )?as is.*",
    "bsd-grant": r"redistribution and use in source and binary forms with or without modification are permitted.*",
    "bsd-source": r"(?:\d )?redistributions of source code must retain the above copyright notice.*",
    "bsd-binary": r"(?:\d )?redistributions in binary form must reproduce the above copyright notice.*",
    "bsd-names": r"(?:\d )?neither the name of .* may be used to endorse or promote products.*",
    "no-liability": r"in no event shall .* be liable for any.*",
    "apache-use": r"you may not use this file except in compliance with the license",
    "apache-copy": r"you may obtain a copy of the license at.*",
    "apache-as-is": r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*",
    "apache-limits": r"see the license for the specific language governing permissions and limitations under the license",
    "gpl-free": r"(?:this program|.*) is free software you can redistribute it and or modify it under the terms of the gnu (?P<kind>general|lesser general|affero general) public license.*?(?:version (v))?(?P<later> of the license or.*)?",
    "gpl-hope": r"(?:this program|.*) is distributed in the hope that it will be useful.*",
    "gpl-more": r"see the gnu (?:general|lesser general|affero general) public license for more details",
    "gpl-copy": r"you should have received a copy of the gnu (?:general|lesser general|affero general) public license.*",
    "mpl-copy": r"if a copy of the mpl was not distributed with this file you can obtain one at.*",
    "unlicense": r"this is free and unencumbered software released into the public domain",
    "public-domain": r"(?:this|the) .* (?:is|are) (?:hereby )?(?:placed |released |dedicated )?(?:in|into|to) the public domain",
    "title-mit": r"(?:the )?mit license(?: mit)?",
    "title": r"(?:the )?(?P<name>isc|zlib|apache|eclipse public|mozilla public) license(?: version)?(?: ?v)? ?(v)?(?: \w+ \d{4})?",
    "field": r"(?:the )?license (?:is )?(?P<name>mit|isc|zlib|apache|epl|mpl|agpl|lgpl|gpl|bsd|unlicense)(?: license)?(?: version)?(?: ?v)? ?(v)?",
    "name-uses": r"(?:.* )?uses? the (?P<name>mit|isc|zlib|apache|eclipse public|mozilla public) license(?: version)?(?: ?v)? ?(v)?",
}
# What titles, fields and plain statements call a licence.
CALLED = {"mit": "MIT", "isc": "ISC", "zlib": "Zlib", "apache": "Apache", "epl": "EPL", "eclipse public": "EPL",
          "mpl": "MPL", "mozilla public": "MPL", "agpl": "AGPL", "lgpl": "LGPL", "gpl": "GPL", "bsd": "BSD",
          "unlicense": "Unlicense"}
# Ordered rules: licence, the identifiers in their order ("?" at the end: may be missing).
RULES = [
    ("MIT", ["title-mit?", "mit-grant", "mit-notice", "as-is?", "no-liability?"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "as-is?", "no-liability?"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "as-is?", "no-liability?"]),
    ("ISC", ["isc-grant", "as-is?", "no-liability?"]),
    ("Apache", ["name-apache", "apache-use", "apache-copy?", "apache-as-is?", "apache-limits?"]),
    ("GPL", ["gpl-free", "gpl-hope?", "gpl-more?", "gpl-copy?"]),
    ("MPL", ["mpl-form", "mpl-copy?"]),
    ("Unlicense", ["unlicense"]),
    ("MIT", ["name-mit"]), ("Apache", ["name-apache"]), ("AGPL", ["name-agpl"]), ("LGPL", ["name-lgpl"]),
    ("GPL", ["name-gpl"]), ("MPL", ["name-mpl"]), ("BSD", ["name-bsd"]), ("CC", ["name-cc"]),
    ("MIT", ["title-mit"]), ("called", ["title"]), ("called", ["field"]), ("called", ["name-uses"]),
    ("SPDX", ["spdx"]), ("public domain", ["public-domain"]),
]
# A text without any of these words has no known sentence: each way through a
# pattern has one of them.  Single words, as signs and line ends between words
# are free; short ones stand alone.
WORDS = ("licen[sc]e|permission|redistribut|copyright|domain|provided|spdx|liable|endorse|hope|gpl|creative"
         "|(?<![^\\W_])(?:cc|mpl)(?![^\\W_])")

_VERSION = r"(?P<v>\d+(?:\.\d+)*)"
_PATTERNS = [(name, re.compile(p.replace("(v)", _VERSION), re.S)) for name, p in SENTENCES.items()]
# A clause may follow the name of a licence.
_NAMES = [(name, re.compile(f"(?:{p.replace('(v)', _VERSION)})(?: .*)?", re.S))
          for name, p in SENTENCES.items() if name.startswith("name-")]
_NEXT = re.compile(r" (?=(?:(?:released|licensed|distributed|available|provided) under|subject to) )")
_CUT = re.compile(r"(?!(?<=\b[vV])\.\s+\d)[.!?]+(?=\s|$)|\n[\s#*/%;-]*\n"
                  r"|\n(?=[\s#*/%;-]*(?:SPDX|Licensed|Released|Permission|Redistribution|This)\b)"
                  r"|(?<=[.!?;:])\n(?![\s#*/%;-]*(?:you can redistribute|either version)\b)")
_PART = re.compile(r";\s")
_HINT = re.compile(WORDS, re.I)
_SIGN = re.compile(r"(?<=\d)\.(?=\d)|[^\w]+|_+")


def sentences(text: str):
    """(number, begin, end) of the sentences of a text."""
    at, k = 0, 0
    for m in [*_CUT.finditer(text), None]:
        end = m.start() if m else len(text)
        if text[at:end].strip():
            yield k, at, end
            k += 1
        at = m.end() if m else end


def normalise(sentence: str) -> str:
    text = re.sub(r"(?m)^[ \t]*(?://+|/\*+|\*+/?|#+|--+|%+|;+)", " ", sentence.lower()).replace("licence", "license")
    return " ".join(_SIGN.sub(lambda m: "." if m[0] == "." else " ", text).split())


def identify(sentence: str):
    """(identifier, version, match) of a normalised sentence, or None."""
    for name, pattern in _PATTERNS:
        m = pattern.fullmatch(sentence)
        if m:
            return name, m.groupdict().get("v"), m
    return None


def identify_all(sentence: str):
    """(begin, end, found) of all that a sentence as it stands names.  A
    sentence that is no known one as a whole is read in parts, cut at semicolons
    and, where several licences are named, before each of them."""
    whole = identify(normalise(sentence))
    if whole and not whole[0].startswith("name-"):
        return [(0, len(sentence), whole)]
    out, at = [], 0
    for m in [*_PART.finditer(sentence), None]:
        end = m.start() if m else len(sentence)
        text = normalise(sentence[at:end])
        cuts = [0, *(c.end() for c in _NEXT.finditer(text)), len(text)]
        found = [(name, f.groupdict().get("v"), f) for a, z in zip(cuts, cuts[1:])
                 for name, pattern in _NAMES if (f := pattern.fullmatch(text[a:z].rstrip()))]
        if not found:
            found = [f for f in [identify(text)] if f]
        out += [(at, end, f) for f in found]
        at = m.end() if m else end
    return out


def _named(license_: str, found) -> str:
    name, _, m = found
    got = m.groupdict()
    if license_ == "SPDX":
        return got["name"]
    if license_ == "called":
        return CALLED[got["name"]]
    if license_ == "CC":
        short = {"0": "0", "zero": "0", "attribution": "BY", "noncommercial": "NC", "sharealike": "SA",
                 "noderivatives": "ND"}
        words = got["name"].replace("non commercial", "noncommercial").replace("share alike", "sharealike").split()
        return "CC-" + "-".join(short.get(w, w.upper()) for w in words)
    if license_ == "GPL" and name == "gpl-free":
        return {"general": "GPL", "lesser general": "LGPL", "affero general": "AGPL"}[got["kind"]]
    if license_ == "BSD" and (got["clauses"] or got["after"]):
        return f"BSD-{got['clauses'] or got['after']}-Clause"
    return license_


def findings(text: str):
    """(license, version, identifiers, first, last, begin, end) of a text."""
    known = []
    for k, a, z in sentences(text):
        piece = text[a:z]
        if _HINT.search(piece):
            for b, e, found in identify_all(piece):
                part = piece[b:e]
                b += a + len(part) - len(part.lstrip())
                known.append((k, b, b + len(part.strip()), found))
    at = 0
    while at < len(known):
        for license_, rule in RULES:
            to, ok = at, True
            for want in rule:
                here = to < len(known) and known[to][3][0] == want.rstrip("?") and (
                    to == at or known[to][0] - known[to - 1][0] <= GAP + 1)
                if here:
                    to += 1
                elif not want.endswith("?"):
                    ok = False
                    break
            if ok:
                break
        else:
            license_, to = "unmatched", at + 1
        used = known[at:to]
        version = next((f[1] for _, _, _, f in used if f[1]), None)
        name = license_ if license_ == "unmatched" else _named(license_, used[0][3])
        yield (name, version, [f[0] for _, _, _, f in used], used[0][0], used[-1][0], used[0][1], used[-1][2])
        at = to


FINDING = ("doc_id long, license string, version string, sentences array<string>, first int, last int, "
           "begin long, end long")


def _scan(batches):
    kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    for b in batches:
        rows = [(i, *f) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for f in findings(t)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                             [c.split()[0] for c in FINDING.split(", ")])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The licence findings of every document."""
    src = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.where(F.col("text").rlike(f"(?i){WORDS}")).mapInArrow(_scan, FINDING)
