"""License scans: ordered signature rules behind a keyword filter, overlaps resolved by priority."""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from subscriber_analytics.llm.arrow import add_columns

# A word: any bytes but ASCII ones that are neither digits nor letters (texts are lower-cased before).
_WORD = rb"[0-9a-z\x80-\xff]"
_GAP = rb"[^0-9a-z\x80-\xff]+"
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

# Bytes of a stretch of text, by which kept spans are looked up.
STRETCH = 64

# The base phrases: found wherever their words stand one behind the other.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Signature rules: label | keyword | patterns, strongest family first. In a pattern a blank is any gap
# between words, a word in brackets may be absent, a bar separates words that stand for each other.
# The keyword is a word that every match contains.
SIGNATURES = """
agpl-3.0 | affero | gnu affero general public license (version) (3|v3)
agpl-3.0 | affero | affero general public license (as published by the free software foundation)
agpl-3.0 | affero | affero gpl (version) (3|v3)
agpl-3.0 | agpl | licensed under (the) agpl (version) (3|v3)
agpl-3.0 | agpl | agpl 3 0 (only|or) (later)
agpl-3.0 | agplv3 | agplv3
lgpl-3.0 | lesser | gnu lesser general public license (as published by the free software foundation) version 3
lgpl-3.0 | lgpl | lgpl (version) 3 (0) (only|or) (later)
lgpl-3.0 | lgplv3 | lgplv3
lgpl-2.1 | lesser | gnu lesser general public license (as published by the free software foundation) version 2 1
lgpl-2.1 | lesser | lesser general public license for more details
lgpl-2.1 | lgpl | lgpl (version) 2 1 (only|or) (later)
lgpl-2.1 | lgplv2 | lgplv2 (1)
lgpl-2.0 | library | gnu library general public license
lgpl-2.0 | lgpl | lgpl (version) 2 0 (only|or) (later)
lgpl | lesser | lesser general public license
lgpl | lgpl | under (the) (terms) (of) (the) (gnu) lgpl
gpl-3.0 | general | gnu general public license (as published by the free software foundation) (either) version 3
gpl-3.0 | general | general public license version 3 29 june 2007
gpl-3.0 | gpl | gpl (version) 3 (0) (only|or) (later)
gpl-3.0 | gplv3 | gplv3
gpl-2.0 | general | gnu general public license (as published by the free software foundation) (either) version 2
gpl-2.0 | general | general public license version 2 june 1991
gpl-2.0 | gpl | gpl (version) 2 (0) (only|or) (later)
gpl-2.0 | gplv2 | gplv2
gpl-1.0 | general | general public license version 1 february 1989
gpl-1.0 | gpl | gpl (version) 1 (0) (only|or) (later)
gpl | general | general public license for more details
gpl | general | under the terms of the gnu general public license
gpl | gpl | licensed under (the) (gnu) gpl
gpl | gpl | released under (the) (gnu) gpl
gpl | gpl | distributed under (the) (gnu) gpl
gpl | copyleft | this is free software you are free to change and redistribute it copyleft
gfdl | documentation | gnu free documentation license (version) (1) (1|2|3)
gfdl | gfdl | licensed under (the) gfdl
gpl-classpath | classpath | classpath exception
apache-2.0 | apache | apache license (version) 2 0
apache-2.0 | apache | licensed under the apache license version 2 0
apache-2.0 | apache | apache software license (version) 2 0
apache-2.0 | apache | www apache org licenses license 2 0
apache-2.0 | apache | apache 2 0
apache-2.0 | apache | apache license january 2004
apache-1.1 | apache | apache (software) license (version) 1 1
apache-1.0 | apache | apache (software) license (version) 1 0
apache | apache | licensed under the apache license
apache | apache | apache software license
apache | apache | released under (the) apache
mit | merge | use copy modify merge publish distribute sublicense and or sell copies of the software
mit | permission | permission is hereby granted free of charge to any person obtaining a copy
mit | noninfringement | warranties of merchantability fitness for a particular purpose and noninfringement
mit | licensed | licensed under (the) mit
mit | released | released under (the) mit
mit | distributed | distributed under (the) mit
mit | license | the mit license (mit)
mit | spdx | spdx license identifier mit
mit | expat | expat license
mit-0 | attribution | mit no attribution
x11 | x11 | x11 license
x11 | consortium | x consortium license
isc | isc | isc license
isc | isc | licensed under (the) isc
isc | permission | permission to use copy modify and or distribute this software for any purpose with or without fee
0bsd | bsd | zero clause bsd
0bsd | 0bsd | 0bsd
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software
bsd-4-clause | bsd | bsd 4 clause
bsd-4-clause | bsd | (original|old) bsd license
bsd-3-clause | endorse | may be used to endorse or promote products derived from this software
bsd-3-clause | bsd | bsd 3 clause
bsd-3-clause | bsd | (new|revised|modified) bsd (license)
bsd-3-clause | clause | 3 clause bsd
bsd-2-clause | bsd | bsd 2 clause
bsd-2-clause | bsd | (simplified|freebsd) bsd (license)
bsd-2-clause | clause | 2 clause bsd
bsd | redistributions | redistributions of source code must retain the above copyright notice
bsd | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd | bsd | bsd license
bsd | bsd | bsd style license
bsd | bsd | licensed under (the) bsd
mpl-2.0 | mozilla | mozilla public license (version|v) 2 0
mpl-2.0 | mozilla | mozilla org mpl 2 0
mpl-2.0 | mpl | mpl (version) 2 0
mpl-1.1 | mozilla | mozilla public license (version) 1 1
mpl-1.1 | mpl | mpl (version) 1 1
mpl-1.0 | mozilla | mozilla public license (version) 1 0
mpl | mozilla | mozilla public license
mpl | mpl | licensed under (the) mpl
epl-2.0 | eclipse | eclipse public license (version|v) 2 0
epl-2.0 | epl | epl (version) 2 0
epl-1.0 | eclipse | eclipse public license (version|v) 1 0
epl-1.0 | epl | epl (version) 1 0
epl | eclipse | eclipse public license
edl-1.0 | eclipse | eclipse distribution license
cddl-1.1 | distribution | common development and distribution license (version) 1 1
cddl-1.0 | distribution | common development and distribution license (version) 1 0
cddl | distribution | common development and distribution license
cddl | cddl | licensed under (the) cddl
cpl-1.0 | common | common public license (version) (1) (0)
ipl-1.0 | ibm | ibm public license
cpal-1.0 | attribution | common public attribution license
eupl-1.2 | european | european union public licence (version|v) 1 2
eupl-1.1 | european | european union public licence (version|v) 1 1
eupl | european | european union public (licence|license)
eupl | eupl | licensed under (the) eupl
osl-3.0 | open | open software license (version|v) 3 0
osl | open | open software license
afl-3.0 | academic | academic free license (version|v) 3 0
afl | academic | academic free license
ecl-2.0 | educational | educational community license
artistic-2.0 | artistic | artistic license (version) 2 0
artistic-1.0 | artistic | artistic license (version) 1 0
artistic | artistic | artistic license
artistic | perl | under the same terms as perl itself
zlib | zlib | zlib license
zlib | libpng | zlib libpng license
zlib | misrepresented | altered source versions must be plainly marked as such and must not be misrepresented
zlib | misrepresented | the origin of this software must not be misrepresented
libpng | libpng | libpng license
boost-1.0 | boost | boost software license (version) (1) (0)
boost-1.0 | boost | www boost org license 1 0
unlicense | unlicense | the unlicense
unlicense | unencumbered | free and unencumbered software released into the public domain
unlicense | unlicense | unlicense org
wtfpl | wtfpl | wtfpl
wtfpl | want | do what the fuck you want to public license
beerware | beer | beer ware license
beerware | beer | you can buy me a beer in return
cc0-1.0 | cc0 | cc0 (1) (0) (universal)
cc0-1.0 | creative | creative commons zero
cc0-1.0 | publicdomain | creativecommons org publicdomain zero
cc-by-nc-sa | creative | creative commons attribution noncommercial sharealike
cc-by-nc-sa | creative | creative commons attribution non commercial share alike
cc-by-nc-sa | cc | cc by nc sa (1|2|3|4) (0|5)
cc-by-nc-nd | creative | creative commons attribution noncommercial no derivatives
cc-by-nc-nd | creative | creative commons attribution non commercial no derivatives
cc-by-nc-nd | cc | cc by nc nd (1|2|3|4) (0|5)
cc-by-nc | creative | creative commons attribution noncommercial
cc-by-nc | creative | creative commons attribution non commercial
cc-by-nc | cc | cc by nc (1|2|3|4) (0|5)
cc-by-nc | creativecommons | creativecommons org licenses by nc
cc-by-nd | creative | creative commons attribution no derivatives
cc-by-nd | cc | cc by nd (1|2|3|4) (0|5)
cc-by-nd | creativecommons | creativecommons org licenses by nd
cc-by-sa | creative | creative commons attribution sharealike
cc-by-sa | creative | creative commons attribution share alike
cc-by-sa | cc | cc by sa (1|2|3|4) (0|5)
cc-by-sa | creativecommons | creativecommons org licenses by sa
cc-by | creative | creative commons attribution (1|2|3|4) (0|5)
cc-by | creative | creative commons attribution license
cc-by | cc | cc by (1|2|3|4) (0|5)
cc-by | creativecommons | creativecommons org licenses by
cc | creative | licensed under (a|the) creative commons
cc | creative | creative commons license
odbl-1.0 | database | open database license
odbl-1.0 | odbl | odbl (1) (0)
odc-by | commons | open data commons attribution license
pddl | domain | public domain dedication and license
ofl-1.1 | sil | sil open font license (version) (1) (1)
ofl-1.1 | ofl | ofl 1 1
ofl | font | open font license
python-2.0 | python | python software foundation license
python-2.0 | psf | psf license agreement
python-2.0 | python | python license
php-3.01 | php | php license (version) (3) (01)
ruby | ruby | ruby license
openssl | openssl | openssl license
openssl | openssl | this product includes software developed by the openssl project
ncsa | ncsa | university of illinois ncsa open source license
ncsa | ncsa | ncsa license
postgresql | postgresql | postgresql license
vim | vim | vim license
tcl | tcl | tcl tk license
curl | curl | curl license
icu | icu | icu license
unicode | unicode | unicode license agreement
unicode | unicode | unicode terms of use
w3c | w3c | w3c software (and) (document) (notice|license)
json | evil | the software shall be used for good not evil
ms-pl | microsoft | microsoft public license
ms-pl | pl | licensed under (the) ms pl
ms-rl | microsoft | microsoft reciprocal license
bsl-1.1 | business | business source license (1) (1)
sspl-1.0 | server | server side public license
sspl-1.0 | sspl | sspl (v1)
elastic-2.0 | elastic | elastic license (2) (0)
commons-clause | clause | commons clause license condition
polyform | polyform | polyform (noncommercial|shield|perimeter|strict) license
confluent | confluent | confluent community license
hippocratic | hippocratic | hippocratic license
openrail | openrail | openrail (m|s) license
openrail | responsible | responsible ai license
nasa-1.3 | nasa | nasa open source agreement
upl-1.0 | universal | universal permissive license
qpl-1.0 | q | q public license
sleepycat | sleepycat | sleepycat license
latex-1.3c | latex | latex project public license
lppl | lppl | lppl (version) (1) (3)
cecill-2.1 | cecill | cecill (free) (software) license
cecill-b | cecill | cecill b
cecill-c | cecill | cecill c
mulan-psl-2.0 | mulan | mulan (psl|permissive) (software) (license) (v2)
blueoak-1.0 | blue | blue oak model license
public-domain | domain | released into the public domain
public-domain | domain | this (work|software|file) is in the public domain
public-domain | domain | dedicated to the public domain
public-domain | domain | placed in the public domain
spdx | spdx | spdx license identifier
proprietary | proprietary | proprietary and confidential
proprietary | confidential | confidential and proprietary
proprietary | unauthorized | unauthorized copying of this file via any medium is strictly prohibited
proprietary | reserved | all rights reserved
proprietary | license | end user license agreement
proprietary | eula | subject to (the) eula
proprietary | trade | contains trade secrets
warranty | warranty | provided as is without warranty of any kind
warranty | warranties | without warranties or conditions of any kind
warranty | liable | in no event shall the authors or copyright holders be liable
warranty | liability | limitation of liability
"""


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: re.Pattern[bytes]
    priority: int
    weight: float


def _bounded(body: bytes) -> re.Pattern[bytes]:
    return re.compile(rb"(?<!" + _WORD + rb")" + body + rb"(?!" + _WORD + rb")")


def _pattern(text: str) -> bytes:
    """Regex of a signature: the first word is never an optional one that stands alone."""
    parts = b""
    for n, token in enumerate(re.findall(r"\([^)]*\)|\S+", text)):
        words = token.strip("()").replace(" ", _GAP.decode("latin-1")).encode("latin-1")
        if not token.startswith("("):
            parts += (_GAP if n else b"") + words
        elif n == 0:
            parts += rb"(?:" + words + rb")"
        else:
            parts += rb"(?:" + _GAP + rb"(?:" + words + rb"))?"
    return parts


@functools.lru_cache(maxsize=1)
def rules() -> tuple[tuple[Rule, ...], ahocorasick.Automaton]:
    """The rules, strongest first, and an automaton over their keywords that gives rule numbers."""
    found = []
    for n, line in enumerate(SIGNATURES.strip().splitlines()):
        label, keyword, text = (part.strip() for part in line.split("|", 2))
        fixed = len(re.sub(r"\([^)]*\)", "", text).split())
        # A long fixed phrase is stronger evidence than a short one.
        found.append(Rule(label, keyword, _bounded(_pattern(text)), n, min(1.0, 0.4 + 0.1 * fixed)))
    keywords: dict[str, list[int]] = {}
    for n, rule in enumerate(found):
        keywords.setdefault(rule.keyword, []).append(n)
    automaton = ahocorasick.Automaton()
    for keyword, numbers in keywords.items():
        automaton.add_word(keyword, tuple(numbers))
    automaton.make_automaton()
    return tuple(found), automaton


@functools.lru_cache(maxsize=1)
def base_rules() -> tuple[tuple[str, re.Pattern[bytes], str], ...]:
    # A lookahead, so that places that overlap all count.
    return tuple((text.split()[-1], re.compile(rb"(?<!" + _WORD + rb")(?=" + _pattern(text) + rb"(?!" + _WORD + rb"))"), label)
                 for text, label in BASE)


def detections(data: bytes, lowered: str) -> list[tuple[int, int, Rule]]:
    """Spans of rules in a lower-cased text that no other detection suppresses, by start.

    Stronger rules come first. A span is suppressed if a kept one contains it, or if a kept one of the
    same family of labels (up to the first hyphen) overlaps it.
    """
    table, automaton = rules()
    numbers: set[int] = set()
    for _, found in automaton.iter(lowered):
        numbers.update(found)
    kept: list[tuple[int, int, Rule]] = []
    # Kept spans by the stretches of text they touch, so that a text full of them needs no pairwise look.
    near: dict[int, list[tuple[int, int, Rule]]] = defaultdict(list)
    for n in sorted(numbers):
        rule = table[n]
        family = rule.label.split("-")[0]
        for match in rule.pattern.finditer(data):
            start, end = match.span()
            touched = range(start // STRETCH, (end - 1) // STRETCH + 1)
            if any(s <= start and end <= e or s < end and start < e and r.label.split("-")[0] == family
                   for t in touched for s, e, r in near[t]):
                continue
            kept.append((start, end, rule))
            for t in touched:
                near[t].append(kept[-1])
    return sorted(kept, key=lambda x: (x[0], x[1], x[2].priority))


FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("label", T.StringType())]))),
])


def scan_text(text: str) -> tuple[int, int, int | None, int | None, str, str, float, list[dict[str, object]]]:
    """The columns of FIELDS for one text; spans are byte offsets of the UTF-8 text."""
    data = text.encode().lower()
    word = _IS_WORD[np.frombuffer(data, np.uint8)]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    places, base_labels = [], set()
    for keyword, pattern, label in base_rules():
        if keyword.encode() in data:
            found = [m.start() for m in pattern.finditer(data)]
            places += found
            if found:
                base_labels.add(label)
    kept = detections(data, data.decode())
    labels = base_labels | {rule.label for _, _, rule in kept}
    first = int(starts[:min(places)].sum()) if places else None
    last = int(starts[:max(places)].sum()) if places else None
    score = max([rule.weight for _, _, rule in kept] + [0.6 if places else 0.0])
    spans = [{"start": s, "end": e, "label": rule.label} for s, e, rule in kept]
    return (int(starts.sum()), len(places), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)),
            float(score), spans)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the words, base phrases, labels, score and spans of each text.

    n_base counts all places of the base phrases, first_word and last_word are the smallest and
    largest word at which one starts (null without any). labels are the base ones and those of the kept
    signature rules; score is the weight of the strongest evidence. A null text is an empty one: no
    words, no labels, score 0. Repeated rows are scanned each; columns of these names are replaced.
    """
    def work(texts: pa.Array) -> dict[str, object]:
        rows = [scan_text(t) for t in texts.fill_null("").to_pylist()]
        return {f: [r[k] for r in rows] for k, f in enumerate(FIELDS.names)}

    return add_columns(docs, text, FIELDS, work)
