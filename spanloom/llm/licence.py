"""Licence recognition: sentences first, then rules over sequences of sentences.

A text is normalised (comment marks and mark-up go, lines that were wrapped are joined) and cut into
sentences. A sentence maps to identifiers of known sentences: the wording of a known one inside it, found
by an Aho-Corasick automaton; a grant, which names a licence and its version after words such as "released
under"; a title, which is a licence's name and nothing else; or an SPDX tag. The identifiers, in order, are
matched against the licence rules: a rule holds where its identifiers follow one another (those with a
question mark may be missing). Rules are tried in their order, and identifiers that a rule has used are not
used again. A title stands on a line of fewer than 120 characters. "All rights reserved" counts only where no licence is recognised within ``NEAR`` sentences.

Defined results: a null or empty text, and one without a known sentence, gives no row; texts are read
whole; a name that is only mentioned or negated is no sentence; identifiers without a matching rule are
reported as licence ``unknown``; repeated rows give repeated results; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from fnmatch import fnmatchcase

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from spanloom.llm import texts

#: Sentences on either side of a licence in which a reservation of rights belongs to it.
NEAR = 12

#: Identifiers of licence sentences and their wording.
SENTENCES = {
    "apache-compliance": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-endorse": "may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    "mpl-terms": "subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-copy": "If a copy of the MPL was not distributed with this file",
    "gpl-useful": "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-copy": "You should have received a copy of the GNU",
    "cc0-waiver": "has waived all copyright and related or neighboring rights",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "reserved": "All rights reserved",
}

#: Licence families and how normalised texts name them.
NAMES = [
    ("LGPL", r"(?:gnu )?(?:lesser|library) general public licen[sc]e|gnu lgpl|lgpl"),
    ("AGPL", r"(?:gnu )?affero general public licen[sc]e|gnu agpl|agpl"),
    ("GPL", r"(?:gnu )?general public licen[sc]e|gnu gpl|gpl"),
    ("Apache", r"apache(?: software)?(?: public)? licen[sc]e|apache"),
    ("MIT", r"mit(?: x11)? licen[sc]e|mit|expat licen[sc]e"),
    ("BSD-3-Clause", r"bsd 3 clause(?: licen[sc]e)?|3 clause bsd(?: licen[sc]e)?|(?:new|modified|revised) bsd licen[sc]e"),
    ("BSD-2-Clause", r"bsd 2 clause(?: licen[sc]e)?|2 clause bsd(?: licen[sc]e)?|simplified bsd licen[sc]e|freebsd licen[sc]e"),
    ("BSD", r"bsd licen[sc]e|bsd"),
    ("ISC", r"isc licen[sc]e|isc"),
    ("MPL", r"mozilla public licen[sc]e|mpl"),
    ("EPL", r"eclipse public licen[sc]e|epl"),
    ("BSL", r"boost software licen[sc]e|bsl"),
    ("Zlib", r"zlib licen[sc]e|zlib"),
    ("CC0", r"cc0|creative commons zero|creative commons cc0"),
    ("CC-BY-NC-ND", r"cc by nc nd|creative commons attribution non ?commercial no ?derivatives"),
    ("CC-BY-NC-SA", r"cc by nc sa|creative commons attribution non ?commercial share ?alike"),
    ("CC-BY-NC", r"cc by nc|creative commons attribution non ?commercial"),
    ("CC-BY-ND", r"cc by nd|creative commons attribution no ?derivatives"),
    ("CC-BY-SA", r"cc by sa|creative commons attribution share ?alike"),
    ("CC-BY", r"cc by|creative commons attribution"),
]
#: Families whose licences carry a version in their name.
VERSIONED = {"LGPL", "AGPL", "GPL", "Apache", "MPL", "EPL", "BSL", "CC0", "CC-BY-NC-ND", "CC-BY-NC-SA", "CC-BY-NC", "CC-BY-ND", "CC-BY-SA", "CC-BY"}

#: Licence (or none: the one that the first identifier with a colon names), and the identifiers that
#: show it; first rules first.
RULES = [
    (None, ["spdx:*"]),
    (None, ["grant:Apache-2.0", "apache-compliance?", "apache-copy?", "apache-as-is?"]),
    ("MIT", ["title:MIT?", "reserved?", "mit-grant", "mit-notice?", "mit-as-is?"]),
    ("BSD-3-Clause", ["title:BSD*?", "reserved?", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is?"]),
    ("BSD-2-Clause", ["title:BSD*?", "reserved?", "bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is?"]),
    ("ISC", ["title:ISC?", "reserved?", "isc-grant", "isc-as-is?"]),
    ("MPL-2.0", ["mpl-terms", "mpl-copy?"]),
    ("CC0-1.0", ["title:CC0*?", "cc0-waiver"]),
    ("Unlicense", ["unlicense"]),
    (None, ["grant:*", "gpl-useful?", "gpl-copy?"]),
    (None, ["title:*"]),
    ("proprietary", ["reserved"]),
]

_decoration = re.compile(r"^[ \t>|]*(?:<!--|//+!?|/\*+!?|\*+/|\*+|#+!?|--+|;+|%+|rem\b|dnl\b)*[ \t]*|[ \t]*(?:\*+/|-->)?[ \t\r]*$", re.IGNORECASE | re.MULTILINE)
_markup = re.compile(r"<[^<>\n]*>")
_block = re.compile(r"\n[ \t]*\n\s*")
# a stop ends a sentence, but not one behind "v" or another short abbreviation
_stop = re.compile(r"(?<!\bv)(?<!\binc)(?<!\bltd)(?<!\be\.g)(?<!\bi\.e)[.!?](?=\s|[\"')\]]|$)", re.IGNORECASE)
_word = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
_spdx = re.compile(r"spdx-licen[sc]e-identifier:\s*(\(*[a-z0-9.+-]+\)*(?:[ \t]+(?:and|or|with)[ \t]+\(*[a-z0-9.+-]+\)*)*)", re.IGNORECASE)
_name = re.compile(" (?:" + "|".join(f"(?P<n{i}>{pattern})" for i, (_, pattern) in enumerate(NAMES)) + r")(?= |$)")
_grant = re.compile(r" (?:under|governed by|covered by)(?: (?:the|a|an|either|both|one|any|terms|conditions|and|of|provisions|version|v|[0-9]+(?:\.[0-9]+)*)){0,9}$")
# what stands between two licences of one grant
_also = re.compile(r"(?: licen[sc]e)? (?:and or|and|or)(?: (?:under|the|a|an|terms|of))*")
_verb = re.compile(r" (?:licen[sc]ed|released|distributed|redistribute|modify|available|published|provided|covered|use|used|governed|dual|shared|made|offered|issued) ")
_denied = re.compile(r" (?:not|never|neither|cannot|isn t|aren t|wasn t|no longer) ")
_version = re.compile(r"(?: (?:international|unported|either|only|public|licen[sc]e|as published by the free software foundation))*(?: (?:version|v|ver))? ?v?([0-9]+(?:\.[0-9]+)?)(?= |$)")
_before = re.compile(r" (?:version|v) ?v?([0-9]+(?:\.[0-9]+)?) of the$")
_later = re.compile(r"(?: of (?:the|that) licen[sc]e)?(?: or(?: at your option)?(?: any)? (?:later|newer|above|greater)| or later| and later)(?= |$)")
_rest = re.compile(r"(?: (?:[0-9.]+|licen[sc]e|mit|gplv?[0-9]*|the|only|version|january|february|march|april|may|june|july|august|september|october|november|december|international|universal|public|http|https|www|gnu|org|apache|licenses|html?))*$")
_headed = re.compile(r"^(?: the)?(?: licen[sc]e(?: is| type)?)?$")


def normalised(sentence: str) -> str:
    """Lower-case words with one space before each."""
    return "".join(f" {w}" for w in _word.findall(sentence.lower()))


def _sign() -> re.Pattern:
    """One word that each known wording, name and tag cannot be without: a text that has none of them needs no normalising.

    Of a wording the longest word, of each way to write a name the longest of its words that are not optional. Marks and
    line ends never stand inside a word, so a word is found in the raw text wherever a sentence has it.
    """
    signs = {max(normalised(wording).split(), key=len) for wording in SENTENCES.values()}
    for _, pattern in NAMES:
        pattern = re.sub(r" ?\(\?:[^()]*\)\??| \?", " ", pattern)
        signs |= {max(way.split(), key=len) for way in pattern.split("|")}
    return re.compile(r"(?<![^\W_])(?:spdx|" + "|".join(sorted(signs)) + r")(?![^\W_])", re.IGNORECASE)


def sentences(text: str) -> list[str]:
    """The sentences of a text without comment marks and mark-up, wrapped lines joined; titles on lines of their own apart."""
    plain = _markup.sub(" ", _decoration.sub("", text))
    out = []
    for block in _block.split(plain):
        held, lines = [], block.split("\n")
        for i, line in enumerate(lines):
            if len(line) < 120 and (_named(normalised(line), True) or _spdx.search(line)):
                out += _stop.split(" ".join(held))
                held = []
                if i + 1 < len(lines) and normalised(lines[i + 1]).startswith(" version "):
                    lines[i + 1] = f"{line} {lines[i + 1].strip()}"  # the version of a title stands on the next line
                else:
                    out.append(line)
            else:
                held.append(line)
        out += _stop.split(" ".join(held))
    return out


def _named(words: str, alone: bool) -> list[tuple[int, int, str]]:
    """(begin, end, identifier) of the grants in a normalised sentence, or, if ``alone``, of the title that it is."""
    found = []
    for m in _name.finditer(words):
        family = NAMES[int(m.lastgroup[1:])][0]
        before, end = words[: m.start()], m.end()
        version = _version.match(words, end)
        earlier = _before.search(before)
        number = version[1] if version else earlier[1] if earlier else None
        end = version.end() if version else end
        later = _later.match(words, end)
        # "under the terms of the GNU General Public License as published ..., either version 2 of the License, or ... later"
        licence = family
        if family in VERSIONED and number:
            licence += f"-{number if '.' in number else number + '.0'}" + ("-or-later" if later else "")
        elif family == "CC0":
            licence += "-1.0"
        end = later.end() if later else end
        if alone:
            if _headed.match(before) and _rest.match(words, end) and (m[0].endswith(("license", "licence")) or before or version or family.startswith(("BSD-", "CC"))):
                return [(0, len(words), f"title:{licence}")]
            return []
        granted = _grant.search(before) or (found and _also.fullmatch(words[found[-1][1] : m.start()]))
        if granted and _verb.search(f"{before} ") and not _denied.search(f"{before} "):
            found.append((m.start(), end, f"grant:{licence}"))
    return found


SIGN = _sign()


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for name, wording in SENTENCES.items():
        phrase = normalised(wording) + " "
        found.add_word(phrase, (name, len(phrase)))
    found.make_automaton()
    return found


def identified(text: str, known: ahocorasick.Automaton) -> list[tuple[int, str]]:
    """(sentence, identifier) of the known sentences in a text, in order, without those inside a longer one."""
    if not SIGN.search(text):
        return []
    out = []
    for number, sentence in enumerate(sentences(text)):
        tag = _spdx.search(sentence)
        if tag:
            out.append((number, f"spdx:{tag[1].rstrip('.')}"))
            continue
        words = normalised(sentence)
        hits = [(end - size + 1, end, name) for end, (name, size) in known.iter(f"{words} ")]
        hits += _named(words, True) or _named(words, False)
        covered = 0
        for start, end, name in sorted(hits, key=lambda h: (h[0], -h[1])):
            if start >= covered:
                out.append((number, name))
                covered = end
    return out


def _used(ids: list[str | None], at: int, sequence: list[str]) -> list[int] | None:
    """The places that a rule takes from ``at`` on, or None where it doesn't hold."""
    taken = []
    for i, item in enumerate(sequence):
        pattern = item.removesuffix("?")
        if at < len(ids) and ids[at] is not None and fnmatchcase(ids[at], pattern):
            taken.append(at)
            at += 1
        elif pattern == item or (i == 0 and len(sequence) == 1):
            return None
    return taken


def licences(found: list[tuple[int, str]]) -> list[tuple[str, list[str]]]:
    """(licence, identifiers used), in the order of the first identifier; what no rule takes is ``unknown``."""
    left: list[str | None] = [name for _, name in found]
    out, near = [], []
    for licence, sequence in RULES:
        for at in range(len(left)):
            if left[at] is None:
                continue
            taken = _used(left, at, sequence)
            if not taken:
                continue
            names = [left[i] for i in taken]
            if licence == "proprietary" and any(abs(found[at][0] - other) <= NEAR for other in near):
                left[at] = None
                continue
            out.append((at, licence or next(n for n in names if ":" in n).partition(":")[2], names))
            near += [found[i][0] for i in taken] if licence != "proprietary" else []
            for i in taken:
                left[i] = None
    out += [(i, "unknown", [x]) for i, x in enumerate(left) if x is not None]
    return [(licence, names) for _, licence, names in sorted(out, key=lambda f: f[0])]


def _scan_batches(batches):
    known = automaton()
    for batch in batches:
        for part in texts.slices(batch):
            docs, licence, names, place = [], [], [], []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                for i, (name, sequence) in enumerate(licences(identified(text or "", known))):
                    docs.append(doc), licence.append(name), names.append(sequence), place.append(i)
            out = [pa.array(docs, pa.int64()), pa.array(place, pa.int32()), pa.array(licence, pa.string()), pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "place", "licence", "sentences"])


def scan(docs: DataFrame) -> DataFrame:
    """One row per licence statement: (doc_id, place, licence, sentences). A single pass without a shuffle."""
    return docs.select("doc_id", "text").mapInArrow(_scan_batches, "doc_id long, place int, licence string, sentences array<string>")
