"""License scan by ordered signature rules.

Several hundred regular expressions over the normalised words of a text, each behind keywords that must occur first.  All
detections are put in order of priority; one that lies inside the interval of a detection of higher priority is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewatch.llm.common import PLAIN, as_bytes

# Base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"),
)

# Hand-written signatures: label | priority | keyword | pattern over lower-case words with one space between.
SIGNATURES = """
mit | 60 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 40 | without limitation the rights | without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies
mit | 30 | mit license | (?:the )?(?:terms of the )?mit license
mit | 20 | licensed under mit | licensed under mit
mit-0 | 70 | mit no attribution | mit no attribution(?: license)?
x11 | 55 | x11 license | (?:the )?x11 license
x11 | 65 | x consortium | except as contained in this notice the name of the x consortium shall not be used
expat | 50 | expat license | (?:the )?expat license
isc | 60 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 50 | isc license | (?:the )?isc license
0bsd | 70 | zero clause bsd | (?:the )?(?:bsd )?zero clause bsd(?: license)?
bsd | 40 | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause | 55 | 2 clause bsd | (?:the )?2 clause bsd license
bsd-2-clause | 55 | simplified bsd | (?:the )?simplified bsd license
bsd-2-clause | 55 | freebsd license | (?:the )?freebsd license
bsd-3-clause | 55 | 3 clause bsd | (?:the )?3 clause bsd license
bsd-3-clause | 55 | new bsd license | (?:the )?new bsd license
bsd-3-clause | 55 | modified bsd license | (?:the )?modified bsd license
bsd-3-clause | 60 | neither the name | neither the names? of .{0,80}?nor the names of (?:its|their|any) contributors may be used to endorse or promote
bsd-4-clause | 65 | all advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-4-clause | 55 | original bsd license | (?:the )?original bsd license
bsd-3-clause-clear | 70 | clear bsd | (?:the )?clear bsd license
apache | 30 | apache license | (?:the )?apache license
apache-2.0 | 60 | apache license version 2 0 | (?:under )?(?:the )?apache license version 2 0
apache-2.0 | 60 | apache 2 0 | (?:the )?apache 2 0 licen[sc]e
apache-2.0 | 65 | www apache org licenses license 2 0 | https? www apache org licenses license 2 0
apache-1.1 | 60 | apache software license version 1 1 | (?:the )?apache software license version 1 1
apache-1.0 | 60 | apache license version 1 0 | (?:the )?apache license version 1 0
gpl | 30 | gnu general public license | (?:the )?gnu general public license
gpl | 25 | gnu gpl | (?:the )?gnu gpl
lgpl | 45 | lesser general public | (?:the )?gnu lesser general public license
lgpl | 45 | library general public | (?:the )?gnu library general public license
agpl | 45 | affero general public | (?:the )?gnu affero general public license
gfdl | 45 | free documentation license | (?:the )?gnu free documentation license
gpl-classpath-exception | 70 | classpath exception | (?:gpl .{0,30}?)?with (?:the )?classpath exception
gpl-linking-exception | 70 | as a special exception | as a special exception the copyright holders .{0,60}?give you permission to link
mpl | 35 | mozilla public license | (?:the )?mozilla public license
epl | 35 | eclipse public license | (?:the )?eclipse public license
cddl | 35 | common development and distribution | (?:the )?common development and distribution license
cpl-1.0 | 35 | common public license | (?:the )?common public license(?: version 1 0)?
ipl-1.0 | 35 | ibm public license | (?:the )?ibm public license(?: version 1 0)?
eupl | 35 | european union public licen | (?:the )?european union public licen[cs]e
osl | 35 | open software license | (?:the )?open software license
afl | 35 | academic free license | (?:the )?academic free license
artistic | 35 | artistic license | (?:the )?artistic license
artistic-2.0 | 55 | artistic license 2 0 | (?:the )?artistic license 2 0
artistic-perl | 60 | same terms as perl | under the same terms as perl itself
bsl-1.0 | 55 | boost software license | (?:the )?boost software license(?: version 1 0)?
zlib | 55 | zlib license | (?:the )?zlib(?: libpng)? license
zlib | 60 | this software is provided as is | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising
libpng | 55 | libpng license | (?:the )?libpng license
wtfpl | 60 | do what the fuck you want | do what the fuck you want to public license
beerware | 60 | beer ware license | (?:the )?beer ware license
unlicense | 60 | free and unencumbered software | this is free and unencumbered software released into the public domain
unlicense | 50 | the unlicense | (?:released under )?the unlicense
public-domain | 35 | public domain | (?:released |dedicated |placed )?(?:in|into|to) the public domain
public-domain | 30 | work is in the public | this work is in the public domain
cc0-1.0 | 55 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc | 25 | creative commons | (?:a )?creative commons license
cc-by | 30 | cc by | cc by
odbl-1.0 | 55 | open database license | (?:the )?open (?:data commons )?(?:open )?database license
odc-by-1.0 | 55 | data commons attribution | (?:the )?open data commons attribution license
pddl-1.0 | 55 | public domain dedication and license | (?:the )?(?:open data commons )?public domain dedication and license
psf-2.0 | 50 | python software foundation license | (?:the )?python software foundation license
python-2.0 | 50 | python license | (?:the )?python license
php-3.01 | 50 | php license | (?:the )?php license(?: version 3 01)?
postgresql | 50 | postgresql license | (?:the )?postgresql licen[cs]e
openssl | 50 | openssl license | (?:the )?openssl license
ruby | 50 | ruby license | (?:the )?ruby license
vim | 50 | vim license | (?:the )?vim license
ofl-1.1 | 50 | open font license | (?:the )?(?:sil )?open font license(?: version 1 1)?
ncsa | 50 | ncsa open source license | (?:the )?(?:university of illinois )?ncsa open source license
ecl-2.0 | 50 | educational community license | (?:the )?educational community license(?: version 2 0)?
upl-1.0 | 50 | universal permissive license | (?:the )?universal permissive license(?: version 1 0)?
ms-pl | 50 | microsoft public license | (?:the )?microsoft public license
ms-rl | 50 | microsoft reciprocal license | (?:the )?microsoft reciprocal license
cecill | 50 | cecill | (?:the )?cecill(?: free software)? licen[cs]e(?: agreement)?
mulan-psl-2.0 | 50 | mulan psl | (?:the )?mulan psl v2
sspl-1.0 | 50 | server side public license | (?:the )?server side public license
bsl-1.1 | 50 | business source license | (?:the )?business source license(?: 1 1)?
elastic-2.0 | 50 | elastic license | (?:the )?elastic license(?: 2 0)?
commons-clause | 55 | commons clause | (?:the )?commons clause (?:license )?condition
polyform-noncommercial | 50 | polyform noncommercial | (?:the )?polyform noncommercial license
openrail | 50 | openrail | (?:creativeml |bigscience )?open ?rail(?: m)?(?: license)?
llama-community | 50 | llama 2 community license | llama 2 community license(?: agreement)?
proprietary | 20 | all rights reserved | all rights reserved
proprietary | 35 | proprietary and confidential | (?:this (?:file|software) is )?proprietary and confidential
no-redistribution | 35 | may not be reproduced | may not be reproduced (?:distributed )?(?:or transmitted )?(?:in any form)?
unspecified-license | 10 | see the license | see the license (?:file )?for (?:the )?(?:specific language|details|more information)
unspecified-license | 10 | see license | see licen[cs]e (?:file|txt|md)
""".strip()

# Families with versions: label, name pattern, keyword, versions.
FAMILIES = (
    ("gpl", "(?:gnu )?general public license", "general public license", ("1", "2", "3")),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public license", "general public license", ("2", "2 1", "3")),
    ("agpl", "(?:gnu )?affero general public license", "affero general public", ("1", "3")),
    ("gfdl", "(?:gnu )?free documentation license", "free documentation license", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla public license", "mozilla public license", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public license", "eclipse public license", ("1 0", "2 0")),
    ("cddl", "common development and distribution license", "common development and distribution", ("1 0", "1 1")),
    ("eupl", "european union public licen[cs]e", "european union public licen", ("1 0", "1 1", "1 2")),
    ("osl", "open software license", "open software license", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free license", "academic free license", ("1 1", "1 2", "2 0", "2 1", "3 0")),
)
# Creative Commons elements, long names and versions.
CC_ELEMENTS = (
    ("by", "attribution"), ("by sa", "attribution share ?alike"), ("by nd", "attribution no ?deriv(?:ative)?s"),
    ("by nc", "attribution non ?commercial"), ("by nc sa", "attribution non ?commercial share ?alike"),
    ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# Short identifiers as they stand after "spdx license identifier".
SPDX = (
    "mit", "apache 2 0", "bsd 2 clause", "bsd 3 clause", "isc", "zlib", "unlicense", "cc0 1 0", "gpl 2 0 only",
    "gpl 2 0 or later", "gpl 3 0 only", "gpl 3 0 or later", "lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 3 0 only",
    "lgpl 3 0 or later", "agpl 3 0 only", "agpl 3 0 or later", "mpl 2 0", "epl 2 0", "bsl 1 0", "artistic 2 0",
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: bytes
    pattern: re.Pattern[bytes]


def _identifier(words: str) -> str:
    """"gpl 2 0 only" to "gpl-2.0-only": numbers next to each other are joined by a point."""
    return re.sub(r"(?<=\d) (?=\d)", ".", words).replace(" ", "-")


def _rules() -> tuple[Rule, ...]:
    found: list[tuple[str, int, str, str]] = []
    for line in SIGNATURES.splitlines():
        label, priority, keyword, pattern = (part.strip() for part in line.split(" | "))
        found.append((label, int(priority), keyword, pattern))
    for label, name, keyword, versions in FAMILIES:
        for v in versions:
            short = f"{label}-{_identifier(v if ' ' in v else v + ' 0')}"
            number = f"(?:version |v ?)?{v}(?: 0)?(?! ?[0-9])"
            found += [
                (short, 60, keyword, f"(?:the )?{name} {number}"),
                (f"{short}-only", 70, keyword, f"(?:the )?{name} {number} only"),
                (f"{short}-or-later", 70, keyword, f"(?:the )?{name} {number} or (?:at your option )?(?:any )?later(?: version)?"),
                (f"{short}-or-later", 75, keyword, f"(?:the )?{name} as published by the free software foundation either {number} of the license or at your option any later version"),
                (short, 50, label, f"{label} ?(?:version |v)?{v}(?: 0)?(?! ?[0-9])"),
                (f"{short}-or-later", 55, label, f"{label} ?(?:version |v)?{v}(?: 0)? or later"),
            ]
    for short, long in CC_ELEMENTS:
        label = "cc-" + short.replace(" ", "-")
        found += [(label, 40 + len(short), "cc " + short, f"cc {short}"),
                  (label, 45 + len(short), "creative commons", f"creative commons {long}(?: international| unported)?(?: public)? license")]
        for v in CC_VERSIONS:
            found += [
                (f"{label}-{_identifier(v)}", 60 + len(short), "cc " + short, f"cc {short} {v}(?: international| unported)?"),
                (f"{label}-{_identifier(v)}", 65 + len(short), "creative commons", f"creative commons {long} {v}(?: international| unported| generic)?(?: public)?(?: license)?"),
                (f"{label}-{_identifier(v)}", 70 + len(short), "creativecommons org", f"creativecommons org licenses {short} {v}"),
            ]
    for name in SPDX:
        found.append((_identifier(name), 90, "spdx license identifier", f"spdx license identifier {name}"))
    found.sort(key=lambda r: -r[1])
    return tuple(Rule(label, p, keyword.encode(), re.compile(b"(?<= )" + pattern.encode() + b"(?= )")) for label, p, keyword, pattern in found)


RULES = _rules()
#: Words of which every keyword above has one: a text without any of them is done with.
GATES = (b"licen", b"gpl", b"public", b"cc", b"permi", b"commons", b"redistribution", b"reserved", b"reproduced", b"proprietary", b"contributors",
         b"neither the name", b"advertising", b"rights to use", b"limitation", b"as is", b"exception", b"perl", b"cecill", b"mulan", b"rail",
         b"consortium", b"attribution", b"unencumbered", b"copy modify", b"clause", b"fuck", b"apache 2 0", b"mpl", b"epl", b"cddl", b"eupl", b"osl", b"afl", b"gfdl")


def detections(padded: bytes) -> list[tuple[int, int, str, int]]:
    """(start, stop, label, priority) in a text of words with one space between and at both ends, after suppression."""
    raw: list[tuple[int, int, str, int]] = []
    present: dict[bytes, bool] = {}
    for rule in RULES:  # by falling priority
        if rule.keyword not in present:
            present[rule.keyword] = rule.keyword in padded
        if present[rule.keyword]:
            raw += [(m.start(), m.end(), rule.label, rule.priority) for m in rule.pattern.finditer(padded)]
    return suppressed(raw)


def suppressed(raw: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Detections that don't lie inside one of higher priority (or, at equal priority, inside a longer one)."""
    kept: list[tuple[int, int, str, int]] = []
    starts: list[int] = []  # of kept intervals in order; none lies inside another, so their stops rise too
    stops: list[int] = []
    for found in sorted(set(raw), key=lambda d: (-d[3], d[0] - d[1], d[0], d[2])):
        start, stop = found[:2]
        i = bisect_right(starts, start)
        if i and stops[i - 1] >= stop:
            continue
        # Intervals of higher priority that lie inside this longer one make way in the index, not in the result.
        j = i
        while j < len(starts) and stops[j] <= stop:
            j += 1
        starts[i:j], stops[i:j] = [start], [stop]
        kept.append(found)
    return kept


def scan(text: bytes | None) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str, int]]]:
    """Number of words, base places (word number, label) and the rules' detections of a text."""
    words = (text or b"").translate(PLAIN).split()
    padded = b" " + b" ".join(words) + b" "
    places: list[tuple[int, str]] = []
    for phrase, label in BASE:
        needle = b" " + phrase.encode() + b" "
        at = padded.find(needle)
        word, counted = 0, 0
        while at >= 0:
            word += padded.count(b" ", counted, at)
            counted = at
            places.append((word, label))
            at = padded.find(needle, at + 1)
    rules = detections(padded) if any(g in padded for g in GATES) else []
    return len(words), places, rules


def license_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and the detections as structs.

    Words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII.  ``score`` is the highest priority of
    a surviving detection by 100, at least 0.3 for a base place, 0 without any.  A null or empty text has no words and no
    labels (empty strings).  Repeated rows are judged each; no rows in, no rows out.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    struct = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("label", pa.string()), ("priority", pa.int64())])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text in as_bytes(batch.column(1)):
                n, places, rules = scan(text)
                at = [p for p, _ in places]
                base = sorted({label for _, label in places})
                labels = sorted({*base, *[r[2] for r in rules]})
                score = max([r[3] / 100 for r in rules] + [0.3] * bool(places), default=0.0)
                out.append((n, len(at), min(at, default=None), max(at, default=None), ",".join(base), ",".join(labels), score,
                            [dict(zip(("start", "stop", "label", "priority"), r)) for r in sorted(rules)]))
            columns = list(zip(*out)) if out else [()] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(struct)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"],
            )

    return rows.mapInArrow(
        report, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double, detections array<struct<start: bigint, stop: bigint, label: string, priority: bigint>>",
    )
