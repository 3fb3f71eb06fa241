"""Licence scan by sentence rules (operator 2).

A known licence sentence is looked up as a sequence of words from each place
where a sentence or a line begins, to the end of a sentence or line; what stands
between words, such as line breaks and comment marks, does not count. That gives
identifiers. A notice such as SPDX-License-Identifier gives one for each licence
that it names, with its exception, and so do notices in other words (released under
the X licence) and titles of licence texts, whose names are looked up in a table
made from families and versions. The identifiers found, in order, are then matched against the
rules: a rule is an ordered list of identifiers, met when they follow one another
with few other sentences between. Sentences are counted after joining wrapped
lines: they end at an end mark, a blank line or a known sentence's border.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_FREE = "This {} is free software: you can redistribute it and/or modify it under the terms of"
#: Known sentences of public licences and notices, by identifier; {} is up to NAME_WORDS words.
SENTENCES = {
    "mit-released": ("Released under the MIT License.", "This project is licensed under the MIT License.", "Licensed under the MIT License."),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "mit-notice": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",),
    "as-is": ("The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",),
    "apache-licensed": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    "apache-comply": ("you may not use this file except in compliance with the License.",),
    "apache-obtain": ("You may obtain a copy of the License at",),
    "gpl-3": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."),
    "gpl-2": ("This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."),
    "gpl-2-free": (f"{_FREE} the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "gpl-2-only": (
        f"{_FREE} the GNU General Public License as published by the Free Software Foundation; version 2 of the License.",
        f"{_FREE} the GNU General Public License version 2 as published by the Free Software Foundation.",
    ),
    "gpl-free": (f"{_FREE} the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "gpl-3-only": (f"{_FREE} the GNU General Public License as published by the Free Software Foundation, version 3 of the License.", f"{_FREE} the GNU General Public License as published by the Free Software Foundation, version 3."),
    "lgpl-21-free": (f"{_FREE} the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",),
    "lgpl-3-free": (f"{_FREE} the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "lgpl-3": ("Licensed under the GNU Lesser General Public License, version 3.", "This work is licensed under the GNU Lesser General Public License, version 3."),
    "agpl-3-free": (f"{_FREE} the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "agpl-3": ("Licensed under the GNU Affero General Public License, version 3.", "This work is licensed under the GNU Affero General Public License, version 3."),
    "gpl-verbatim": ("Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",),
    "gpl-3-open": ("The GNU General Public License is a free, copyleft license for software and other kinds of works.",),
    "agpl-3-open": ("The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",),
    "apache-open": ("\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",),
    "mpl-2-open": ("\"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.",),
    "gpl-hope": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",),
    "bsd-redistribution": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",),
    "bsd-binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",),
    "bsd-advert": ("All advertising materials mentioning features or use of this software must display the following acknowledgement:",),
    "bsd-endorse": (
        "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Neither the name of {} nor the names of {} contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "The name of {} may not be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "bsd-3": ("Licensed under the BSD 3-Clause License.", "This project is licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."),
    "bsd-2": ("Licensed under the BSD 2-Clause License.", "This project is licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License."),
    "mpl-2": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, Version 2.0.", "Licensed under the Mozilla Public License 2.0."),
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "0bsd-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",),
    "isc": ("Licensed under the ISC License.", "This project is licensed under the ISC License.", "Released under the ISC License."),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
    "zlib-grant": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",),
    "boost": ("Distributed under the Boost Software License, Version 1.0.",),
    "epl-2": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",),
    "cc0": ("Licensed under CC0 1.0.", "This work is licensed under CC0 1.0."),
    "cc-by-sa-4": ("Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."),
    "cc-by-nd-4": ("Licensed under CC BY-ND 4.0.", "This work is licensed under CC BY-ND 4.0."),
    "cc-by-nc-sa-4": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under CC BY-NC-SA 4.0."),
    "cc-by-nc-4": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."),
    "cc-by-4": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."),
}
#: Rules in order of preference, each a licence and the identifiers that make it out.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-released",)),
    ("Apache-2.0", ("apache-licensed", "apache-comply", "apache-obtain")),
    ("Apache-2.0", ("apache-licensed",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0-only", ("gpl-verbatim", "gpl-3-open")),
    ("GPL-3.0-only", ("gpl-3-open",)),
    ("AGPL-3.0-only", ("gpl-verbatim", "agpl-3-open")),
    ("AGPL-3.0-only", ("agpl-3-open",)),
    ("Apache-2.0", ("apache-open",)),
    ("MPL-2.0", ("mpl-2-open",)),
    ("GPL-3.0-only", ("gpl-3-only",)),
    ("GPL-3.0-only", ("gpl-3",)),
    ("GPL-2.0-or-later", ("gpl-2-free",)),
    ("GPL-2.0-only", ("gpl-2-only",)),
    ("GPL-2.0-only", ("gpl-2",)),
    ("LGPL-2.1-or-later", ("lgpl-21-free",)),
    ("LGPL-3.0-or-later", ("lgpl-3-free",)),
    ("LGPL-3.0-only", ("lgpl-3",)),
    ("AGPL-3.0-or-later", ("agpl-3-free",)),
    ("AGPL-3.0-only", ("agpl-3",)),
    ("BSD-4-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse")),
    ("BSD-4-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advert")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-3",)),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-2",)),
    ("MPL-2.0", ("mpl-2",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc",)),
    ("0BSD", ("0bsd-grant",)),
    ("Unlicense", ("unlicense",)),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("boost",)),
    ("EPL-2.0", ("epl-2",)),
    ("CC0-1.0", ("cc0",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
)
#: Other sentences allowed between two neighbours of a rule.
GAP = 2

#: Words that {} in a known sentence stands for, at most.
NAME_WORDS = 12

#: Ends of sentences, and blank lines, which may hold a comment mark.
_BREAK = re.compile(r"(?<=[.!?:;])\s+|\n(?:[^\w\n]|_)*\n")
#: What stands between two words; dnl and rem are comment marks.
_JOINT = r"(?:[\W_]++(?:(?<=[\s])(?:dnl|rem)(?=[\W_])[\W_]++)?)"
#: The first word after a line break or the end of a sentence, and past a number such as 1. or (a).
_START = re.compile(r"(?:\A|\n|(?<=[.!?:;])\s)[\W_]*+(?:(?:dnl|rem|DNL|REM)(?=[\W_])[\W_]*+)?(?:(?:\d{1,2}|[A-Za-z])[.)]\s[\W_]*+)?([^\W_]*+)")
_END = r"(?=(?:[^\w\n]|_)*?(?:[.!?:;]\s|\n|\Z))"
_WORD = re.compile(r"[^\W_]+")
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]+)")
_SPDX_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*")
#: Names that SPDX no longer uses, and what they mean.
_OLD_IDS = {f"{g}-{v}{e}": f"{g}-{v}{n}" for g, v in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0")) for e, n in (("", "-only"), ("+", "-or-later"))}
_SPDX_IDS = {name.lower(): new for name, new in (*((x, x) for x in (*(x for x, _ in RULES), *_OLD_IDS.values(), "CC-BY-3.0", "CC-BY-SA-3.0", "EPL-1.0", "Apache-1.1", "MPL-1.1", "Artistic-2.0", "WTFPL", "Python-2.0", "OFL-1.1", "MIT-0", "BSD-4-Clause")), *_OLD_IDS.items())}


#: Names of licences without a version.
PLAIN_NAMES = {
    "MIT": ("MIT", "MIT License", "Expat License"),
    "ISC": ("ISC", "ISC License"),
    "0BSD": ("0BSD", "Zero Clause BSD", "BSD Zero Clause License"),
    "BSD-2-Clause": ("BSD 2-Clause", "2-Clause BSD", "BSD 2-Clause Simplified", "Simplified BSD License", "FreeBSD License", "two-clause BSD"),
    "BSD-3-Clause": ("BSD 3-Clause", "3-Clause BSD", "BSD 3-Clause New or Revised", "New BSD License", "Modified BSD License", "Revised BSD License", "three-clause BSD"),
    "BSD-4-Clause": ("BSD 4-Clause", "4-Clause BSD", "BSD 4-Clause Original or Old", "Original BSD License", "four-clause BSD"),
    "Zlib": ("zlib", "zlib License"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0", "Creative Commons Zero", "CC0 1.0 Universal", "Creative Commons Zero 1.0 Universal"),
    "WTFPL": ("WTFPL", "Do What The F*ck You Want To Public License"),
}
#: Names that a version follows, and the versions.
VERSIONED_NAMES = {
    "Apache-{}": (("Apache", "Apache License", "Apache Software License"), ("1.1", "2.0")),
    "GPL-{}": (("GNU General Public License", "General Public License", "GNU GPL", "GPL"), ("2.0", "3.0")),
    "LGPL-{}": (("GNU Lesser General Public License", "Lesser General Public License", "GNU LGPL", "LGPL"), ("2.1", "3.0")),
    "AGPL-{}": (("GNU Affero General Public License", "Affero General Public License", "GNU AGPL", "AGPL"), ("3.0",)),
    "MPL-{}": (("Mozilla Public License", "MPL"), ("1.1", "2.0")),
    "EPL-{}": (("Eclipse Public License", "EPL"), ("1.0", "2.0")),
    "BSL-{}": (("Boost Software License",), ("1.0",)),
    "OFL-{}": (("SIL Open Font License", "Open Font License", "OFL"), ("1.1",)),
    "Artistic-{}": (("Artistic License", "Artistic"), ("2.0",)),
}
#: The parts of Creative Commons names, with short and full words.
CC_PARTS = {"BY": ("Attribution",), "NC": ("NonCommercial", "Non-Commercial"), "SA": ("ShareAlike", "Share-Alike", "Share Alike"), "ND": ("NoDerivatives", "No-Derivatives", "NoDerivs")}
CC_KINDS = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")


def _spelled(version: str) -> list[tuple[str, ...]]:
    """The words that 2.0 may be written with: 2 0, 2, version 2, v 2 0, v2."""
    digits = tuple(version.split("."))
    short = [digits, digits[:1]] if digits[1] == "0" else [digits]
    return [y for x in short for y in (x, ("version", *x), ("v", *x), (f"v{x[0]}", *x[1:]))]


def _name_table() -> dict[tuple[str, ...], str]:
    """A licence for each sequence of words that names it."""
    table = {}
    words = lambda name: tuple(x.lower() for x in _WORD.findall(name))
    for licence, names in PLAIN_NAMES.items():
        table |= {words(x): licence for x in names}
    for licence, (names, versions) in VERSIONED_NAMES.items():
        for name, version in itertools.product(map(words, names), versions):
            for end in _spelled(version):
                table[(*name, *end)] = licence.format(version)
                if len(name) == 1 and end[0][0] == "v":
                    table[(name[0] + end[0], *end[1:])] = licence.format(version)
    for kind, version in itertools.product(CC_KINDS, CC_VERSIONS):
        parts = kind.split("-")
        for end, full in itertools.product(_spelled(version), itertools.product(*(CC_PARTS[x] for x in parts))):
            table |= {(*words(x), *end): f"CC-{kind}-{version}" for x in (f"CC {kind}", f"Creative Commons {kind}", "Creative Commons " + " ".join(full), "CC " + " ".join(full))}
    return table


NAMES = _name_table()
_LONGEST = max(map(len, NAMES))
_TITLE_HEADS = {x[0] for x in NAMES} | {"the"}
#: Words that may stand before and after a name, and how a later version is allowed.
_BEFORE = {"the", "a", "an", "terms", "of", "conditions", "and", "either", "both", "following", "open", "source", "free", "permissive"}
_AFTER_NAME = {"license", "licence", "licenses", "licences", "international", "unported", "generic", "universal", "public"}
_LATER = tuple(tuple(x.split()) for x in ("or at your option any later version", "or any later version", "or later version", "or later", "or newer"))
_NOTICE = re.compile(r"\b(?:licen[sc]ed|released|distributed|redistributed|available|provided|offered|covered|published|shared)[\W_]{1,8}under\b|^[^\w\n]*licen[sc]e[ \t*_]*[:=]", re.IGNORECASE | re.MULTILINE)
_DENIED = re.compile(r"(?:\b(?:not|never|cannot|longer|formerly|previously)|n't)\W+(?:\w+\W+)?\Z", re.IGNORECASE)
_NAME_END = re.compile(r"[\"'”’)\]>*_`+]*(?:\Z|\s*[.,;:!?(…—–\n]|\s+(?:and|or|see|which|as|for|in|by|found|with|unless|that|at|to|here|because|from)\b)")
_TITLE_END = re.compile(r"[^\w\n(]*(?:\([\w.+ -]+\))?[^\w\n]*(?:(?:\d{1,2} )?(?:January|February|March|April|May|June|July|August|September|October|November|December) \d{4})?[^\w\n]*(?:\n|\Z)")
#: What every title, notice and SPDX line holds one of.
_LICENCE_WORD = re.compile(r"licen[sc]e|\bunder\b", re.IGNORECASE)
_JOINED = re.compile(r"[^\w.;]*\b(or|and)\b(?:[\W_]+under\b)?", re.IGNORECASE)
#: Characters of indent that may stand before a title.
_INDENT = 120
_EXPRESSION = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_GNU = re.compile(r"[AL]?GPL-")


def _starts_line(text: str, at: int) -> bool:
    """Whether no word stands before a place in its line."""
    before = text[max(0, at - _INDENT) : at]
    return ("\n" in before or at <= _INDENT) and not _WORD.search(before[before.rfind("\n") + 1 :])


def _named(text: str, at: int) -> tuple[str, int, bool] | None:
    """(licence, end, whether the word licence is in it) of the longest name at a place, with its later versions."""
    near = text[at : at + 400]
    found = [(m[0].lower(), m.end()) for m in itertools.islice(_WORD.finditer(near), _LONGEST + 24)]
    words = tuple(x for x, _ in found)
    skipped = next((i for i, x in enumerate(words) if x not in _BEFORE), len(words))
    for first, n in itertools.product(range(skipped + 1), range(_LONGEST, 0, -1)):
        if licence := NAMES.get(words[first : first + n]):
            n = min(n, len(words) - first)
            end = first + n
            while end < len(words) and words[end] in _AFTER_NAME and end < first + n + 3:
                end += 1
            worded = any(x.startswith("licen") for x in words[first:end])
            if _GNU.match(licence):
                plus = near[found[end - 1][1] :][:1] == "+"
                later = next((x for x in _LATER if words[end : end + len(x)] == x), ())
                end += len(later) or (words[end : end + 1] == ("only",))
                licence += "-or-later" if later or plus else "-only"
            return licence, at + found[end - 1][1], worded
    return None


def _notice(text: str, at: int) -> tuple[list[str], str, int] | None:
    """(licences, expression, end) of the names that follow a place, joined by or and and; none if other words follow."""
    first = _named(text, at)
    if not first:
        return None
    licences, shown, end = [first[0]], first[0], first[1]
    while (joined := _JOINED.match(text, end)) and (more := _named(text, joined.end())):
        licences.append(more[0])
        shown, end = f"{shown} {joined[1].upper()} {more[0]}", more[1]
    return (licences, shown, end) if _NAME_END.match(text, end) else None


def _spdx(line: str) -> tuple[list[str], str]:
    """(known licences with their exceptions, the expression in current names; empty if it isn't one)."""
    tokens = _EXPRESSION.findall(line)
    shown, licences, depth, operand = [], [], 0, True
    sound = bool(tokens)
    for token in tokens:
        word = token.upper()
        if word in ("AND", "OR", "WITH"):
            sound, operand = sound and not operand, True
            shown.append(word)
        elif token in "()":
            depth += 1 if token == "(" else -1
            sound = sound and depth >= 0 and operand == (token == "(")
            shown.append(token)
        else:
            sound, operand = sound and operand, False
            known = _SPDX_IDS.get(token.lower())
            if shown[-1:] == ["WITH"]:
                if licences and licences[-1] == shown[-2:-1]:
                    licences[-1] = [f"{licences[-1][0]} WITH {token}"]
            elif known:
                licences.append([known])
            shown.append(known or token)
    text = " ".join(shown).replace("( ", "(").replace(" )", ")") if sound and not operand and not depth else ""
    return [x for (x,) in licences], text


def _pattern(form: str) -> re.Pattern:
    """The words of a known sentence with anything but words between them."""
    parts = [_JOINT.join(_WORD.findall(x)) for x in form.split("{}")]
    return re.compile(rf"{_JOINT}(?:[^\W_]++{_JOINT}){{1,{NAME_WORDS}}}?".join(parts) + r"(?![^\W_])" + _END, re.IGNORECASE)


class Recogniser:
    """Sentences and rules made ready for lookup."""

    def __init__(self, sentences: dict[str, tuple[str, ...]] = SENTENCES, rules: tuple = RULES) -> None:
        known = sorted(((form, name) for name, forms in sentences.items() for form in forms), key=lambda x: -len(x[0]))
        self.heads: dict[str, list[tuple[re.Pattern, str]]] = {}
        for form, name in known:
            self.heads.setdefault(_WORD.search(form)[0].lower(), []).append((_pattern(form), name))
        titled = [(x, (f"title:{x}", *rule)) for x, rule in rules]
        self.rules = tuple(y for pair in zip(titled, rules) for y in pair)

    def _found(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, identifier, expression) of known sentences, titles and notices, in order; parts of one notice share their start and end, and the first holds its expression."""
        found, last = [], 0
        named = bool(_LICENCE_WORD.search(text))
        for m in _START.finditer(text):
            if m.start(1) < last:
                continue
            head = m[1].lower()
            for pattern, name in self.heads.get(head, ()):
                if hit := pattern.match(text, m.start(1)):
                    last = hit.end()
                    found.append((m.start(1), last, name, ""))
                    break
            else:
                if named and head in _TITLE_HEADS and _starts_line(text, m.start(1)):
                    title = _named(text, m.start(1))
                    if title and title[2] and _TITLE_END.match(text, title[1]):
                        last = title[1]
                        found.append((m.start(1), last, f"title:{title[0]}", ""))
        if named:
            more = []
            for m in _NOTICE.finditer(text):
                if not _DENIED.search(text[max(0, m.start() - 40) : m.start()]) and (notice := _notice(text, m.end())):
                    more += [(m.start(), notice[2], f"notice:{x}", "" if i else notice[1]) for i, x in enumerate(notice[0])]
            for m in _SPDX.finditer(text):
                licences, shown = _spdx(m[1])
                more += [(m.start(), m.end(), f"spdx:{x}", "" if i else shown) for i, x in enumerate(licences)]
            taken = [(x, y) for x, y, _, _ in found]
            starts = [x for x, _ in taken]
            for new in more:
                i = bisect.bisect_right(starts, new[0]) - 1
                if (i < 0 or taken[i][1] <= new[0]) and (i + 1 == len(starts) or starts[i + 1] >= new[1]):
                    found.append(new)
            found.sort(key=lambda x: x[:2])
        return found

    def identify(self, text: str) -> list[tuple[int, str]]:
        """(sentence number, identifier) of every known sentence, title and notice."""
        return self._numbered(text, self._found(text))

    def expressions(self, text: str) -> list[str]:
        """What notices and SPDX lines say, in order, with and, or and with kept."""
        return [x for *_, x in self._found(text) if x]

    @staticmethod
    def _numbered(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, str]]:
        out, at, number = [], 0, 0
        for start, end, name, _ in found:
            number += sum(1 for x in _BREAK.split(text[at:start]) if _WORD.search(x))
            if at and start < at:  # a further licence of one notice
                number -= 1
            out.append((number, name))
            at, number = max(at, end), number + 1
        return out

    def match(self, found: list[tuple[int, str]]) -> list[tuple[str, int, int]]:
        """(licence, first, last sentence number); an identifier serves the first rule that takes it."""
        used: set[int] = set()
        out = []
        own = sorted({x for _, x in found if x.startswith(("spdx:", "notice:", "title:"))})
        for licence, rule in (*self.rules, *((x.split(":", 1)[1], (x,)) for x in own)):
            dead: set[tuple[int, int]] = set()
            for i, (number, name) in enumerate(found):
                if name == rule[0] and i not in used and (taken := _follow(found, rule, i, 1, used, dead)):
                    used.update(taken)
                    out.append((licence, number, found[taken[-1]][0]))
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def _follow(found: list[tuple[int, str]], rule: tuple[str, ...], i: int, k: int, used: set[int], dead: set[tuple[int, int]]) -> list[int]:
    """The least places, i first, that meet a rule from its identifier k on; none if they can't. dead: what is known to fail."""
    if k == len(rule):
        return [i]
    for j in range(i + 1, len(found)):
        if found[j][0] - found[i][0] > GAP + 1:
            break
        if found[j][1] == rule[k] and j not in used and (j, k + 1) not in dead and (rest := _follow(found, rule, j, k + 1, used, dead)):
            return [i, *rest]
    dead.add((i, k))
    return []


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, sentence_ids (identifiers in order), licences (array of licence, first, last) and expressions (of notices and SPDX lines) of every row.

    Null and empty texts have none. Repeated rows give repeated results, a null
    key stays. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recogniser = Recogniser()
        for batch in batches:
            ids, licences, expressions = [], [], []
            for t in batch.column(1):
                whole = t.as_py() or ""
                places = recogniser._found(whole)
                found = recogniser._numbered(whole, places)
                expressions.append([x for *_, x in places if x])
                ids.append([name for _, name in found])
                licences.append([{"licence": x, "first": a, "last": b} for x, a, b in recogniser.match(found)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.string())), pa.array(licences, pa.list_(pa.struct([("licence", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))), pa.array(expressions, pa.list_(pa.string()))],
                ["key", "sentence_ids", "licences", "expressions"],
            )

    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(run, f"key {kind}, sentence_ids array<string>, licences array<struct<licence:string,first:bigint,last:bigint>>, expressions array<string>").withColumnRenamed("key", key)
