"""Ordered license signatures: names, texts and addresses written by hand, names times versions and forms of writing.

A blank in a name, sentence or address stands for any white space and the marks that lead the lines of a comment, so a
notice may be wrapped anywhere. Keywords are searched in a text where such gaps are folded to one blank.
"""

from __future__ import annotations

import re
from typing import NamedTuple

# Phrases of the base labels.
BASE = {
    "gpl": "gnu general public license",
    "apache": "apache license",
    "cc-by": "cc by",
    "mit": "mit license",
}

#: What may stand between two words of a notice: white space, also with the marks that lead the lines of a comment.
GAP = r"\s[\s*#/;>%|]*"

#: Priorities, best first: an identifier or address, a full name with its version, a name alone, a sentence of the text.
IDENTIFIER, VERSIONED, NAMED, SENTENCE = range(4)
#: How sure a detection of each priority is.
WEIGHT = (0.95, 0.85, 0.6, 0.5)


class Rule(NamedTuple):
    keyword: str
    priority: int
    label: str
    pattern: str


class Family(NamedTuple):
    label: str
    keyword: str
    name: str
    short: str
    versions: tuple[str, ...]


# Families of licenses: label, keyword of the name, pattern of the name, pattern of the short name, versions.
FAMILIES = (
    Family("gpl", "general public licen", r"gnu general public licen[cs]e", r"gpl", ("1.0", "2.0", "3.0")),
    Family("lgpl", "general public licen", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", r"lgpl", ("2.0", "2.1", "3.0")),
    Family("agpl", "general public licen", r"(?:gnu )?affero general public licen[cs]e", r"agpl", ("1.0", "3.0")),
    Family("gfdl", "free documentation licen", r"gnu free documentation licen[cs]e", r"gfdl", ("1.1", "1.2", "1.3")),
    Family("apache", "apache", r"apache(?: software)? licen[cs]e", r"apache", ("1.0", "1.1", "2.0")),
    Family("mpl", "mozilla public licen", r"mozilla public licen[cs]e", r"mpl", ("1.0", "1.1", "2.0")),
    Family("epl", "eclipse public licen", r"eclipse public licen[cs]e", r"epl", ("1.0", "2.0")),
    Family("cpl", "common public licen", r"common public licen[cs]e", r"cpl", ("0.5", "1.0")),
    Family("cddl", "common development and distribution", r"common development and distribution licen[cs]e", r"cddl", ("1.0", "1.1")),
    Family("eupl", "european union public licen", r"european union public licen[cs]e", r"eupl", ("1.0", "1.1", "1.2")),
    Family("artistic", "artistic licen", r"artistic licen[cs]e", r"artistic", ("1.0", "2.0")),
    Family("afl", "academic free licen", r"academic free licen[cs]e", r"afl", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    Family("osl", "open software licen", r"open software licen[cs]e", r"osl", ("1.0", "1.1", "2.0", "2.1", "3.0")),
    Family("ofl", "open font licen", r"(?:sil )?open font licen[cs]e", r"ofl", ("1.0", "1.1")),
    Family("bsl", "boost software licen", r"boost software licen[cs]e", r"bsl", ("1.0",)),
    Family("busl", "business source licen", r"business source licen[cs]e", r"busl", ("1.0", "1.1")),
    Family("sspl", "server side public licen", r"server side public licen[cs]e", r"sspl", ("1.0",)),
    Family("elastic", "elastic licen", r"elastic licen[cs]e", r"elastic", ("1.0", "2.0")),
    Family("psf", "python software foundation licen", r"python software foundation licen[cs]e", r"psf", ("2.0",)),
    Family("php", "php licen", r"php licen[cs]e", r"php", ("3.0", "3.01")),
    Family("zpl", "zope public licen", r"zope public licen[cs]e", r"zpl", ("1.1", "2.0", "2.1")),
    Family("lppl", "latex project public licen", r"latex project public licen[cs]e", r"lppl", ("1.0", "1.1", "1.2", "1.3a", "1.3c")),
    Family("ecl", "educational community licen", r"educational community licen[cs]e", r"ecl", ("1.0", "2.0")),
    Family("upl", "universal permissive licen", r"universal permissive licen[cs]e", r"upl", ("1.0",)),
    Family("ncsa", "ncsa", r"(?:university of illinois/)?ncsa open source licen[cs]e", r"ncsa", ()),
    Family("odbl", "open database licen", r"open database licen[cs]e", r"odbl", ("1.0",)),
    Family("odc-by", "open data commons", r"open data commons attribution licen[cs]e", r"odc-by", ("1.0",)),
    Family("cern-ohl", "cern open hardware licen", r"cern open hardware licen[cs]e", r"cern-ohl", ("1.1", "1.2", "2.0")),
    Family("mit", "mit licen", r"(?:the )?mit licen[cs]e", r"mit", ()),
    Family("isc", "isc licen", r"(?:the )?isc licen[cs]e", r"isc", ()),
    Family("zlib", "zlib licen", r"(?:the )?zlib licen[cs]e", r"zlib", ()),
    Family("bsd", "bsd", r"(?:the )?(?:new |modified |simplified |revised )?bsd licen[cs]e", r"bsd", ()),
    Family("openssl", "openssl licen", r"openssl licen[cs]e", r"openssl", ()),
    Family("postgresql", "postgresql licen", r"postgresql licen[cs]e", r"postgresql", ()),
    Family("ruby", "ruby licen", r"ruby licen[cs]e", r"ruby", ()),
    Family("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense", ()),
    Family("vim", "vim licen", r"vim licen[cs]e", r"vim", ()),
    Family("ms-pl", "microsoft public licen", r"microsoft public licen[cs]e", r"ms-pl", ()),
    Family("ms-rl", "microsoft reciprocal licen", r"microsoft reciprocal licen[cs]e", r"ms-rl", ()),
)

# Creative Commons: conditions and versions.
CC_CONDITIONS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_WORDS = {"by": "attribution", "sa": "share-?alike", "nd": "no-?derivatives?(?: works)?", "nc": "non-?commercial"}

# Names and addresses that stand by themselves: keyword, priority, label, pattern.
SINGLE = (
    Rule("fuck", NAMED, "wtfpl", r"do what the fuck you want to public licen[cs]e"),
    Rule("beer-ware", NAMED, "beerware", r"the beer-ware licen[cs]e"),
    Rule("creative commons zero", NAMED, "cc0", r"creative commons zero"),
    Rule("freetype project licen", NAMED, "ftl", r"freetype project licen[cs]e"),
    Rule("unicode, inc. licen", NAMED, "unicode", r"unicode, inc\. licen[cs]e agreement"),
    Rule("cc0", IDENTIFIER, "cc0-1.0", r"\bcc0-1\.0\b"),
    Rule("publicdomain/zero", IDENTIFIER, "cc0-1.0", r"creativecommons\.org/publicdomain/zero/1\.0"),
    Rule("opensource.org/licen", IDENTIFIER, "mit", r"opensource\.org/licenses/mit\b"),
    Rule("opensource.org/licen", IDENTIFIER, "isc", r"opensource\.org/licenses/isc\b"),
    Rule("opensource.org/licen", IDENTIFIER, "zlib", r"opensource\.org/licenses/zlib\b"),
    Rule("opensource.org/licen", IDENTIFIER, "bsd-2-clause", r"opensource\.org/licenses/bsd-2-clause\b"),
    Rule("opensource.org/licen", IDENTIFIER, "bsd-3-clause", r"opensource\.org/licenses/bsd-3-clause\b"),
    Rule("opensource.org/licen", IDENTIFIER, "apache-2.0", r"opensource\.org/licenses/apache-2\.0\b"),
    Rule("opensource.org/licen", IDENTIFIER, "artistic-2.0", r"opensource\.org/licenses/artistic-2\.0\b"),
    Rule("apache.org/licen", IDENTIFIER, "apache-2.0", r"apache\.org/licenses/license-2\.0"),
    Rule("apache.org/licen", IDENTIFIER, "apache-1.1", r"apache\.org/licenses/license-1\.1"),
    Rule("gnu.org/licen", IDENTIFIER, "gpl", r"gnu\.org/licenses/?(?=[\s>\").]|$)"),
    Rule("gnu.org/licen", IDENTIFIER, "gpl-2.0", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    Rule("gnu.org/licen", IDENTIFIER, "gpl-3.0", r"gnu\.org/licenses/gpl-3\.0"),
    Rule("gnu.org/licen", IDENTIFIER, "lgpl-2.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    Rule("gnu.org/licen", IDENTIFIER, "lgpl-3.0", r"gnu\.org/licenses/lgpl-3\.0"),
    Rule("gnu.org/licen", IDENTIFIER, "agpl-3.0", r"gnu\.org/licenses/agpl-3\.0"),
    Rule("gnu.org/licen", IDENTIFIER, "gfdl-1.3", r"gnu\.org/licenses/fdl-1\.3"),
    Rule("mozilla.org/mpl", IDENTIFIER, "mpl-1.1", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    Rule("mozilla.org/mpl", IDENTIFIER, "mpl-2.0", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    Rule("eclipse.org", IDENTIFIER, "epl-1.0", r"eclipse\.org/(?:legal|org/documents)/epl-v10"),
    Rule("eclipse.org", IDENTIFIER, "epl-2.0", r"eclipse\.org/legal/epl-(?:2\.0|v20)"),
    Rule("boost.org/licen", IDENTIFIER, "bsl-1.0", r"boost\.org/license_1_0\.txt"),
    Rule("opendatacommons.org", IDENTIFIER, "odbl-1.0", r"opendatacommons\.org/licenses/odbl"),
    Rule("opendatacommons.org", IDENTIFIER, "odc-by-1.0", r"opendatacommons\.org/licenses/by\b"),
    Rule("scripts.sil.org/ofl", IDENTIFIER, "ofl", r"scripts\.sil\.org/ofl"),
    Rule("unlicense", IDENTIFIER, "unlicense", r"unlicense\.org"),
    Rule("spdx-license-identifier", IDENTIFIER, "bsd-2-clause", r"spdx-license-identifier:\s*bsd-2-clause\b"),
    Rule("spdx-license-identifier", IDENTIFIER, "bsd-3-clause", r"spdx-license-identifier:\s*bsd-3-clause\b"),
    Rule("spdx-license-identifier", IDENTIFIER, "bsd-0-clause", r"spdx-license-identifier:\s*0bsd\b"),
    Rule("spdx-license-identifier", IDENTIFIER, "wtfpl", r"spdx-license-identifier:\s*wtfpl\b"),
)

# Sentences of license texts and notices: keyword, label, pattern.
TEXTS = (
    ("permission is hereby granted", "mit", r"permission is hereby granted, free of charge, to any person(?! or organi[sz]ation)"),
    ("this permission notice", "mit", r"the above copyright notice and this permission notice(?: \(including the next paragraph\))? shall be included in all copies or substantial portions"),
    ("permission is hereby granted", "bsl-1.0", r"permission is hereby granted, free of charge, to any person or organi[sz]ation obtaining a copy of the software and accompanying documentation"),
    ("redistribution and use in source", "bsd", r"redistribution and use in source and binary forms"),
    ("redistributions of source code", "bsd", r"redistributions of source code must retain the (?:above )?copyright"),
    ("redistributions in binary form", "bsd", r"redistributions in binary form must reproduce the (?:above )?copyright"),
    ("used to endorse or promote", "bsd-3-clause", r"names? of (?:its|their|the|any) (?:\S+ )?contributors may be used to endorse or promote products"),
    ("advertising materials", "bsd-4-clause", r"all advertising materials mentioning features or use of this software must display"),
    ("permission to use, copy, modify", "isc", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee"),
    ("permission to use, copy, modify", "postgresql", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose, without fee, and without a written agreement"),
    ("permission to use, copy, modify", "hpnd", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose(?: and)? (?:with or )?without fee is hereby granted"),
    ("permission to use, copy, modify", "isc", r"permission to use, copy, modify,? and(?:/or)? distribute this software(?! for any purpose| and its documentation)"),
    ("must not be misrepresented", "zlib", r"the origin of this (?:software|source code) must not be misrepresented"),
    ("altered source versions", "zlib", r"altered source versions must be plainly marked as such"),
    ("free and unencumbered", "unlicense", r"this is free and unencumbered software released into the public domain"),
    ("public domain", "public-domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    ("all rights reserved", "all-rights-reserved", r"all rights reserved"),
    ("gnu general public licen", "gpl", r"under the terms of the gnu general public licen[cs]e"),
    ("gnu lesser general public licen", "lgpl", r"under the terms of the gnu lesser general public licen[cs]e"),
    ("gnu library general public licen", "lgpl", r"under the terms of the gnu library general public licen[cs]e"),
    ("affero general public licen", "agpl", r"under the terms of the gnu affero general public licen[cs]e"),
    ("no invariant sections", "gfdl", r"with no invariant sections, (?:with )?no front-cover texts"),
    ("licensed under the apache licen", "apache", r"licensed under the apache licen[cs]e"),
    ("contributor license agreements", "apache-2.0", r"licensed to the apache software foundation \(asf\) under one or more contributor license agreements"),
    ("redistribution, must include the following acknowl", "apache-1.1", r"end-user documentation included with the redistribution, must include the following acknowledge?ment"),
    ("mozilla public licen", "mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[cs]e"),
    ("copy of the mpl was not distributed", "mpl-2.0", r"if a copy of the mpl was not distributed with this file"),
    ("subject to the mozilla public licen", "mpl", r"contents of this file are subject to the mozilla public licen[cs]e"),
    ("under the terms of the eclipse public licen", "epl", r"accompanying materials are made available under the terms of the eclipse public licen[cs]e"),
    ("common development and distribution", "cddl", r"contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("distributed by the copyright holder", "artistic", r"refers to the collection of files distributed by the copyright holder"),
    ("individual components", "ofl", r"neither the font software nor any of its individual components"),
    ("hereby grants licensee", "psf", r"psf hereby grants licensee a nonexclusive, royalty-free, world-?wide licen[cs]e"),
    ("developed by the openssl project", "openssl", r"this product includes software developed by the openssl project"),
    ("independent jpeg group", "ijg", r"based in part on the work of the independent jpeg group"),
    ("licensed under the eupl", "eupl", r"licensed under the eupl"),
    ("non-production use of the licensed work", "busl", r"make non-production use of the licensed work"),
    ("managed service", "elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service"),
    ("you accept this licen", "ms-pl", r"if you use the software, you accept this licen[cs]e"),
    ("good, not evil", "json", r"the software shall be used for good, not evil"),
    ("software without restriction", "ncsa", r"to deal with the software without restriction"),
    ("buy me a beer", "beerware", r"you can buy me a beer in return"),
    ("you must give appropriate credit", "cc-by", r"you must give appropriate credit, provide a link to the licen[cs]e"),
    ("transform, or build upon the material", "cc-by-sa", r"if you remix, transform, or build upon the material, you must distribute your contributions under the same licen[cs]e"),
    ("transform, or build upon the material", "cc-by-nd", r"if you remix, transform, or build upon the material, you may not distribute the modified material"),
    ("for commercial purposes", "cc-by-nc", r"you may not use the material for commercial purposes"),
    ("associated a work with this deed", "cc0", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("confidential and proprietary information", "proprietary", r"this software is the confidential and proprietary information of"),
    ("strictly prohibited", "proprietary", r"unauthorized copying of this file, via any medium is strictly prohibited"),
)

# Notices that name the version after the publisher: label, pattern of the name, versions.
PUBLISHED = (("gpl", r"gnu general public licen[cs]e", ("1.0", "2.0", "3.0")), ("lgpl", r"gnu (?:lesser|library) general public licen[cs]e", ("2.0", "2.1", "3.0")), ("agpl", r"gnu affero general public licen[cs]e", ("3.0",)))


def _number(version: str) -> str:
    """A version as it is written: 2.0 also as 2."""
    return re.escape(version.removesuffix(".0")) + (r"(?:\.0)?" if version.endswith(".0") else "") + r"(?![0-9]|\.[0-9])"


def _family(f: Family) -> list[Rule]:
    spdx = "spdx-license-identifier"
    rules = [Rule(f.keyword, NAMED, f.label, f.name), Rule(spdx, IDENTIFIER, f.label, rf"{spdx}:\s*{f.short}\b(?!-[0-9])")]
    for v in f.versions:
        label = f"{f.label}-{v}"
        rules += [
            Rule(f.keyword, VERSIONED, label, rf"{f.name}[\s,(*#/;>%|]*(?:either )?(?:version|ver\.?|v\.?)?[\s*#/;>%|]*{_number(v)}"),
            Rule(spdx, IDENTIFIER, label, rf"{spdx}:\s*{f.short}-{_number(v)}(?:-only|-or-later|\+)?"),
            Rule(f"{f.short}", VERSIONED, label, rf"\b{f.short}(?:\s*-?\s*v\.?\s*|-){_number(v)}"),
        ]
    return rules


def _creative_commons() -> list[Rule]:
    rules = []
    for c in CC_CONDITIONS:
        words = r"[\s-]+".join(CC_WORDS[x] for x in c.split("-"))
        rules.append(Rule("creative commons", NAMED, f"cc-{c}", rf"creative commons {words}(?![\s-]*(?:share|non|no-?d))"))
        for v in CC_VERSIONS:
            n = _number(v)
            rules += [
                Rule("creativecommons.org", IDENTIFIER, f"cc-{c}-{v}", rf"creativecommons\.org/licenses/{c}/{n}"),
                Rule("creative commons", VERSIONED, f"cc-{c}-{v}", rf"creative commons {words}\s+{n}"),
                Rule("cc", VERSIONED, f"cc-{c}-{v}", rf"\bcc[\s-]{c}[\s-]{n}"),
            ]
    return rules


def _published() -> list[Rule]:
    return [
        Rule("free software foundation", VERSIONED, f"{label}-{v}", rf"{name},? as published by the free software foundation[,;:]? (?:either )?version {_number(v)}")
        for label, name, versions in PUBLISHED
        for v in versions
    ]


def _clauses() -> list[Rule]:
    named = ((0, "zero"), (1, "one"), (2, "two"), (3, "three"), (4, "four"))
    return [Rule("bsd", VERSIONED, f"bsd-{n}-clause", rf"\b(?:{n}|{word})[\s-]clause bsd|\bbsd[\s-]{n}[\s-]clause") for n, word in named]


def rules() -> list[Rule]:
    """All rules in order; of two detections with the same span and priority the earlier rule counts."""
    made = [r for f in FAMILIES for r in _family(f)] + _creative_commons() + _clauses() + _published() + list(SINGLE)
    made += [Rule(keyword, SENTENCE, label, pattern) for keyword, label, pattern in TEXTS]
    return [r._replace(pattern=r.pattern.replace(" ", GAP)) for r in made]


#: Words of which most notices hold one; a keyword without any of them is looked for by its longest word.
ROOTS = ("licen", "permission", "distribut", "domain", "reserved", "creative")
#: The rules of a short name want its version behind it.
SHORT = r"\b(?:" + "|".join(f.short for f in FAMILIES if f.versions) + r")[\s-]*(?:v\.?\s*)?[0-9]|\bcc[\s-]+by[\s-]"


def gates() -> list[str]:
    """Words without blanks of which a text holds one, or matches ``SHORT``, if any rule matches it."""
    short = {f.short for f in FAMILIES if f.versions} | {"cc"}
    words = {max(r.keyword.split(), key=len) for r in rules() if r.keyword not in short and not any(root in r.keyword for root in ROOTS)}
    return [*ROOTS, *sorted(words)]
