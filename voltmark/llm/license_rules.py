"""Signatures of licences: regular expressions over normalised words.

A text is lower-cased and reduced to runs of digits, letters and characters outside ASCII, joined by single spaces:
``Apache-2.0`` reads ``apache 2 0``. A signature matches whole words. ``*`` in front of one of its words marks the
keyword it is looked up by (the first word, if there is none); the keyword is a plain word.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Words that a signature has in front of its keyword, and from it on, at most.
WORDS_AHEAD, WORDS_ON = 12, 18

# The phrases and labels that are counted as base places.
BASE = (
    ("gpl", "*gnu general public license"),
    ("apache", "*apache license"),
    ("cc-by", "*cc by"),
    ("mit", "mit *license"),
)

# Label, short identifier, full names, web addresses. Names and identifiers of public licences.
_V2 = "(?: version)? v?2(?: 0)?"
_V3 = "(?: version)? v?3(?: 0)?"
FAMILIES = (
    ("MIT", "mit", ("mit *licen[sc]e", "expat *licen[sc]e", "mit x11 *licen[sc]e", "x11 *licen[sc]e"), ("*opensource org licenses? mit", "*choosealicense com licenses mit")),
    ("MIT-0", "mit 0", ("mit no *attribution(?: licen[sc]e)?",), ("*opensource org licenses? mit 0",)),
    ("Apache-2.0", "apache 2 0", (f"*apache licen[sc]e{_V2}", f"*apache software licen[sc]e{_V2}"), ("*apache org licenses license 2 0", "*opensource org licenses? apache 2 0")),
    ("Apache-1.1", "apache 1 1", ("*apache (?:software )?licen[sc]e(?: version)? v?1 1",), ("*apache org licenses license 1 1",)),
    ("Apache-1.0", "apache 1 0", ("*apache (?:software )?licen[sc]e(?: version)? v?1 0",), ("*apache org licenses license 1 0",)),
    ("GPL-1.0", "gpl 1 0(?: only| or later)?", ("*gnu general public licen[sc]e(?: version)? v?1(?: 0)?",), ("*gnu org licenses(?: old licenses)? gpl 1 0",)),
    ("GPL-2.0", "gpl 2 0(?: only| or later)?", (f"*gnu general public licen[sc]e{_V2}", f"*gnu gpl{_V2}", "*gplv2"), ("*gnu org licenses(?: old licenses)? gpl 2 0", "*opensource org licenses? gpl 2 0")),
    ("GPL-3.0", "gpl 3 0(?: only| or later)?", (f"*gnu general public licen[sc]e{_V3}", f"*gnu gpl{_V3}", "*gplv3"), ("*gnu org licenses gpl 3 0", "*opensource org licenses? gpl 3 0")),
    ("LGPL-2.0", "lgpl 2 0(?: only| or later)?", ("*gnu (?:library|lesser) general public licen[sc]e(?: version)? v?2(?: 0)?", "*lgplv2"), ("*gnu org licenses(?: old licenses)? lgpl 2 0",)),
    ("LGPL-2.1", "lgpl 2 1(?: only| or later)?", ("*gnu lesser general public licen[sc]e(?: version)? v?2 1", "*lgpl v?2 1"), ("*gnu org licenses(?: old licenses)? lgpl 2 1", "*opensource org licenses? lgpl 2 1")),
    ("LGPL-3.0", "lgpl 3 0(?: only| or later)?", (f"*gnu lesser general public licen[sc]e{_V3}", "*lgplv3"), ("*gnu org licenses lgpl 3 0", "*opensource org licenses? lgpl 3 0")),
    ("AGPL-3.0", "agpl 3 0(?: only| or later)?", (f"*gnu affero general public licen[sc]e{_V3}", "*agplv3"), ("*gnu org licenses agpl 3 0", "*opensource org licenses? agpl 3 0")),
    ("AGPL-1.0", "agpl 1 0(?: only| or later)?", ("*affero general public licen[sc]e(?: version)? v?1(?: 0)?",), ()),
    ("GFDL-1.3", "gfdl 1 3(?: only| or later)?", ("*gnu free documentation licen[sc]e(?:(?: version)? v?1 3)?",), ("*gnu org licenses fdl 1 3",)),
    ("GFDL-1.2", "gfdl 1 2(?: only| or later)?", ("*gnu free documentation licen[sc]e(?: version)? v?1 2",), ("*gnu org licenses(?: old licenses)? fdl 1 2",)),
    ("BSD-2-Clause", "bsd 2 clause", ("*bsd 2 clause(?: licen[sc]e)?", "(?:simplified|freebsd) *bsd licen[sc]e", "2 clause *bsd(?: licen[sc]e)?", "two clause *bsd(?: licen[sc]e)?"), ("*opensource org licenses? bsd 2 clause",)),
    ("BSD-3-Clause", "bsd 3 clause", ("*bsd 3 clause(?: licen[sc]e)?", "(?:new|modified|revised) *bsd licen[sc]e", "3 clause *bsd(?: licen[sc]e)?", "three clause *bsd(?: licen[sc]e)?"), ("*opensource org licenses? bsd 3 clause",)),
    ("BSD-4-Clause", "bsd 4 clause", ("*bsd 4 clause(?: licen[sc]e)?", "(?:original|old) *bsd licen[sc]e", "4 clause *bsd(?: licen[sc]e)?"), ()),
    ("0BSD", "0bsd", ("zero clause *bsd(?: licen[sc]e)?", "*0bsd"), ("*opensource org licenses? 0bsd",)),
    ("ISC", "isc", ("isc *licen[sc]e",), ("*opensource org licenses? isc",)),
    ("MPL-1.0", "mpl 1 0", ("*mozilla public licen[sc]e(?: version)? v?1 0",), ("*mozilla org mpl mpl 1 0",)),
    ("MPL-1.1", "mpl 1 1", ("*mozilla public licen[sc]e(?: version)? v?1 1",), ("*mozilla org mpl(?: mpl)? 1 1",)),
    ("MPL-2.0", "mpl 2 0", (f"*mozilla public licen[sc]e{_V2}", f"*mpl{_V2}"), ("*mozilla org mpl 2 0", "*mozilla org en us mpl 2 0")),
    ("EPL-1.0", "epl 1 0", ("*eclipse public licen[sc]e(?: version)? v?1(?: 0)?",), ("*eclipse org legal epl v10",)),
    ("EPL-2.0", "epl 2 0", (f"*eclipse public licen[sc]e{_V2}",), ("*eclipse org legal epl 2 0", "*eclipse org legal epl v20")),
    ("EDL-1.0", "edl 1 0", ("*eclipse distribution licen[sc]e(?:(?: version)? v?1(?: 0)?)?",), ("*eclipse org org documents edl v10",)),
    ("CDDL-1.0", "cddl 1 0", ("common development and distribution *licen[sc]e(?:(?: version)? v?1 0)?", "*cddl(?: version)? v?1 0"), ("*opensource org licenses? cddl 1 0",)),
    ("CDDL-1.1", "cddl 1 1", ("common development and distribution *licen[sc]e(?: version)? v?1 1",), ()),
    ("CPL-1.0", "cpl 1 0", ("common public *licen[sc]e(?:(?: version)? v?1 0)?",), ("*opensource org licenses? cpl 1 0",)),
    ("IPL-1.0", "ipl 1 0", ("ibm public *licen[sc]e(?:(?: version)? v?1 0)?",), ()),
    ("EUPL-1.1", "eupl 1 1", ("european union public *licen[sc]e(?: version)? v?1 1", "*eupl(?: version)? v?1 1"), ()),
    ("EUPL-1.2", "eupl 1 2", ("european union public *licen[sc]e(?:(?: version)? v?1 2)?", "*eupl(?: version)? v?1 2"), ()),
    ("OSL-3.0", "osl 3 0", (f"open software *licen[sc]e{_V3}",), ("*opensource org licenses? osl 3 0",)),
    ("AFL-3.0", "afl 3 0", (f"academic free *licen[sc]e{_V3}",), ("*opensource org licenses? afl 3 0",)),
    ("Artistic-1.0", "artistic 1 0", ("*artistic licen[sc]e(?:(?: version)? v?1(?: 0)?)?",), ("*opensource org licenses? artistic 1 0",)),
    ("Artistic-2.0", "artistic 2 0", (f"*artistic licen[sc]e{_V2}",), ("*opensource org licenses? artistic 2 0",)),
    ("BSL-1.0", "bsl 1 0", ("*boost software licen[sc]e(?:(?: version)? v?1 0)?",), ("*boost org license 1 0",)),
    ("BUSL-1.1", "busl 1 1", ("business source *licen[sc]e(?:(?: version)? v?1 1)?",), ()),
    ("SSPL-1.0", "sspl 1 0", ("server side public *licen[sc]e(?:(?: version)? v?1)?", "*sspl(?: version)? v?1"), ()),
    ("Elastic-2.0", "elastic 2 0", (f"*elastic licen[sc]e{_V2}",), ("*elastic co licensing elastic license",)),
    ("Zlib", "zlib", ("*zlib licen[sc]e", "*zlib libpng licen[sc]e"), ("*opensource org licenses? zlib",)),
    ("Libpng", "libpng(?: 2 0)?", ("*libpng licen[sc]e",), ()),
    ("PostgreSQL", "postgresql", ("*postgresql licen[sc]e",), ("*opensource org licenses? postgresql",)),
    ("PSF-2.0", "psf 2 0", ("python software foundation *licen[sc]e", "*psf licen[sc]e"), ("*python org psf license",)),
    ("Python-2.0", "python 2 0", (f"python *licen[sc]e{_V2}",), ()),
    ("PHP-3.01", "php 3 01", ("*php licen[sc]e(?:(?: version)? v?3 01)?",), ("*php net license 3 01",)),
    ("Ruby", "ruby", ("ruby *licen[sc]e",), ()),
    ("Unlicense", "unlicense", ("*unlicense",), ("*unlicense org",)),
    ("WTFPL", "wtfpl", ("do what the fuck you want to public *licen[sc]e", "*wtfpl"), ("*wtfpl net",)),
    ("MS-PL", "ms pl", ("microsoft public *licen[sc]e",), ("*opensource org licenses? ms pl",)),
    ("MS-RL", "ms rl", ("microsoft reciprocal *licen[sc]e",), ("*opensource org licenses? ms rl",)),
    ("NCSA", "ncsa", ("university of illinois ncsa open source *licen[sc]e", "ncsa *licen[sc]e"), ("*opensource org licenses? ncsa",)),
    ("OFL-1.1", "ofl 1 1", ("sil open font *licen[sc]e(?:(?: version)? v?1 1)?", "open font *licen[sc]e"), ("*scripts sil org ofl",)),
    ("UPL-1.0", "upl 1 0", ("universal permissive *licen[sc]e(?:(?: version)? v?1 0)?",), ("*opensource org licenses? upl",)),
    ("Vim", "vim", ("vim *licen[sc]e",), ()),
    ("W3C", "w3c", ("w3c software(?: notice and)? *licen[sc]e",), ("*w3 org consortium legal",)),
    ("ZPL-2.1", "zpl 2 1", ("*zope public licen[sc]e(?:(?: version)? v?2 1)?",), ()),
    ("OpenSSL", "openssl", ("*openssl licen[sc]e",), ("*openssl org source license",)),
    ("OLDAP-2.8", "oldap 2 8", ("*openldap public licen[sc]e(?:(?: version)? v?2 8)?",), ("*openldap org software release license",)),
    ("CC0-1.0", "cc0 1 0", ("*cc0(?: 1 0)?(?: universal)?", "*creative commons zero(?: 1 0)?"), ("*creativecommons org publicdomain zero 1 0",)),
    ("ODbL-1.0", "odbl 1 0", ("open database *licen[sc]e(?: 1 0)?", "*odbl"), ("*opendatacommons org licenses odbl",)),
    ("ODC-By-1.0", "odc by 1 0", ("open data commons attribution *licen[sc]e", "*odc by"), ("*opendatacommons org licenses by",)),
    ("PDDL-1.0", "pddl 1 0", ("public domain dedication and *licen[sc]e", "*pddl"), ("*opendatacommons org licenses pddl",)),
    ("OGL-UK-3.0", "ogl uk 3 0", ("open government *licen[sc]e(?:(?: version)? v?3(?: 0)?)?",), ("*nationalarchives gov uk doc open government licence",)),
)

# The parts of a Creative Commons licence and their names.
_CC_PARTS = (
    ("by", "attribution"),
    ("by sa", "attribution share ?alike"),
    ("by nd", "attribution no ?deriv(?:ative)?s"),
    ("by nc", "attribution non ?commercial"),
    ("by nc sa", "attribution non ?commercial share ?alike"),
    ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
)
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Label and a clause that stands in the text of the licence itself.
CLAUSES = (
    ("MIT", "*permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("MIT", "the above copyright notice and this *permission notice shall be included in all copies"),
    ("ISC", "*permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("BSD", "*redistribution and use in source and binary forms with or without modification are permitted"),
    ("BSD", "*redistributions of source code must retain the above copyright notice this list of conditions"),
    ("BSD", "*redistributions in binary form must reproduce the above copyright notice"),
    ("BSD-3-Clause", "neither the name of (?:[^ ]+ ){1,6}nor the names of its *contributors may be used to endorse"),
    ("BSD-4-Clause", "all *advertising materials mentioning features or use of this software must display"),
    ("Apache-2.0", "you may not use this file except in *compliance with the license"),
    ("Apache-2.0", "unless required by *applicable law or agreed to in writing software distributed under the license"),
    ("GPL", "this program is free software you can *redistribute it and or modify it under the terms of the gnu general public license"),
    ("LGPL", "this library is free software you can *redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("GPL-2.0", "either *version 2 of the license or at your option any later version"),
    ("GPL-3.0", "either *version 3 of the license or at your option any later version"),
    ("GPL", "you should have *received a copy of the gnu general public license"),
    ("LGPL", "you should have *received a copy of the gnu lesser general public license"),
    ("AGPL-3.0", "you should have *received a copy of the gnu affero general public license"),
    ("MPL-2.0", "this source code form is *subject to the terms of the mozilla public license v 2 0"),
    ("MPL-1.1", "the contents of this file are *subject to the mozilla public license version 1 1"),
    ("EPL", "this program and the accompanying materials are made *available under the terms of the eclipse public license"),
    ("CDDL", "the contents of this file are *subject to the terms of the common development and distribution license"),
    ("BSL-1.0", "*permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("Zlib", "this software is provided as is without any *express or implied warranty in no event will the authors be held liable"),
    ("Zlib", "the *origin of this software must not be misrepresented"),
    ("Unlicense", "this is free and unencumbered software released into the public *domain"),
    ("Unlicense", "*unencumbered software released into the public domain"),
    ("OFL-1.1", "this font software is *licensed under the sil open font license"),
    ("PostgreSQL", "*permission to use copy modify and distribute this software and its documentation for any purpose without fee"),
    ("Artistic-2.0", "everyone is *permitted to copy and distribute verbatim copies of this license document"),
    ("WTFPL", "you just do what the *fuck you want to"),
    ("public-domain", "(?:released|dedicated|placed) (?:in)?to the public *domain"),
    ("public-domain", "this work is in the public *domain"),
    ("proprietary", "all *rights reserved"),
    ("proprietary", "*proprietary and confidential"),
    ("proprietary", "*unauthorized (?:copying|reproduction|use|distribution)(?: or distribution)? of this"),
    ("commercial", "commercial *license agreement"),
    ("commercial", "end user *license agreement"),
)

# Label and a name without a version.
GENERAL = (
    ("GPL", "*gnu general public licen[sc]e"),
    ("GPL", "*gnu gpl"),
    ("GPL", "*gpl"),
    ("LGPL", "*gnu lesser general public licen[sc]e"),
    ("LGPL", "*gnu library general public licen[sc]e"),
    ("LGPL", "*lgpl"),
    ("AGPL", "*gnu affero general public licen[sc]e"),
    ("AGPL", "*agpl"),
    ("GFDL", "*gfdl"),
    ("Apache", "*apache licen[sc]e"),
    ("BSD", "*bsd(?: style)? licen[sc]e"),
    ("MPL", "*mozilla public licen[sc]e"),
    ("EPL", "*eclipse public licen[sc]e"),
    ("CC", "*creative commons"),
    ("CC", "*creativecommons org licenses"),
    ("CC-BY", "*cc by"),
    ("CDDL", "*cddl"),
    ("EUPL", "*eupl"),
    ("SSPL", "*sspl"),
)

#: How a text says that a licence holds for it.
NOTICE = (
    "(?:licen[sc]ed|released|distributed|redistributed|available|published|provided|covered|issued|shared) under(?: the)?"
    "(?: terms(?: and conditions)? of)?(?: the| an?)?"
)

#: Kinds of signature: priority, and how sure a match is.
KINDS = {
    "base": (0, 0.6), "mention": (1, 0.4), "name": (2, 0.6), "title": (3, 0.8), "link": (4, 0.9), "notice": (5, 0.95),
    "clause": (6, 0.98), "tag": (7, 1.0),
}


@dataclass(frozen=True)
class Rule:
    """One signature. ``ahead`` matches the words before the keyword, ``on`` those from the keyword on."""

    label: str
    kind: str
    keyword: str
    ahead: str
    on: str

    @property
    def priority(self) -> int:
        return KINDS[self.kind][0]

    @property
    def weight(self) -> float:
        return KINDS[self.kind][1]


def rules(label: str, kind: str, signature: str, before: str = "") -> list[Rule]:
    """The rules of a signature: one, or two where its keyword is spelled ``licen[sc]e``."""
    ahead, _, on = signature.rpartition("*")
    ahead = " ".join(x for x in (before, ahead.strip()) if x)
    first = on.split(" ")[0].split("(")[0]
    return [Rule(label.lower(), kind, word, ahead, word + on[len(first) :]) for word in _spelled(first)]


def _spelled(word: str) -> list[str]:
    return [word.replace("[sc]", c) for c in "sc"] if "[sc]" in word else [word]


def all_rules() -> list[Rule]:
    """Every rule, in order: of two that match the same words with the same priority the first one counts."""
    made = [r for label, signature in BASE for r in rules(label, "base", signature)]
    families = list(FAMILIES)
    for parts, name in _CC_PARTS:
        for version in _CC_VERSIONS:
            label = f"CC-{parts.upper().replace(' ', '-')}-{version.replace(' ', '.')}"
            names = (f"*cc {parts} {version}", f"*creative commons {name}(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?(?: version)? {version}")
            families.append((label, f"cc {parts} {version}", names, (f"*creativecommons org licenses {parts} {version}",)))
    for label, identifier, names, links in families:
        made += rules(label, "tag", f"*spdx license identifier {identifier}")
        for name in names:
            made += rules(label, "notice", name, NOTICE)
            made += rules(label, "title", name)
        for link in links:
            made += rules(label, "link", link)
        if " " in identifier:
            first, *rest = identifier.split(" ")
            made += rules(label, "mention", " ".join([f"*{first}", *rest]))
    for label, clause in CLAUSES:
        made += rules(label, "clause", clause)
    for label, name in GENERAL:
        made += rules(label, "notice", name, NOTICE)
        made += rules(label, "name", name)
    return list(dict.fromkeys(made))
