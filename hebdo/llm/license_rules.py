"""The signature rules of the license scan, written out.

Fixed values.  A rule is (label, priority, keywords, pattern).  Patterns read
lower-cased words joined by single spaces, so punctuation is gone: "Apache-2.0"
reads "apache 2 0".  Every alternative of a pattern holds all its keywords;
words of a keyword joined by | stand for each other, and "licen" stands for the
forms of the word license.

Names that are also plain words or people's names (MIT, Apache, Boost, Ruby,
Artistic, ...) count only beside a word for license, or by a full name.

Priorities: 95 clauses of a license's own text, 90 identifiers, 85 addresses,
80 grants, 60 titles and names, 50 fields, 45 identifiers that stand alone,
40 remarks.
"""

from __future__ import annotations

#: What stands for a keyword stem.
STEMS = {"licen": ("license", "licence", "licensed", "licenses", "licences", "licenced")}

#: Abbreviations in the patterns.
MACROS = {
    "{g}": "(?:released|licen[cs]ed|distributed|available|provided|published|covered) under {of}",
    "{of}": "(?:an? |the )?(?:terms (?:and conditions )?of )?(?:an? |the )?",
    "{c}": "(?: {v}[1-4] [05])?(?: international| unported| generic)?(?: public)?(?: {L})?",
    "{p}": "(?: as published by the free software foundation)?(?: either)?",
    "{o}": "(?: only| or later| or any later version)?",
    "{v}": "(?:version |v ?)?",
    "{L}": "licen[cs]e",
    "{D}": "licen[cs]ed",
}

#: SPDX identifiers as words, and their labels: the terms of an expression.
SPDX = {
    "mit": "mit", "mit 0": "mit-0", "x11": "x11", "apache 1 0": "apache-1", "apache 1 1": "apache-1", "apache 2 0": "apache-2",
    "bsd 2 clause": "bsd-2-clause", "bsd 2 clause patent": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause",
    "bsd 3 clause clear": "bsd-3-clause", "bsd 4 clause": "bsd-4-clause", "0bsd": "0bsd", "isc": "isc", "zlib": "zlib",
    "gpl 1 0": "gpl", "gpl 1 0 only": "gpl", "gpl 1 0 or later": "gpl", "gpl 2 0": "gpl-2", "gpl 2 0 only": "gpl-2",
    "gpl 2 0 or later": "gpl-2", "gpl 3 0": "gpl-3", "gpl 3 0 only": "gpl-3", "gpl 3 0 or later": "gpl-3",
    "lgpl 2 0": "lgpl-2", "lgpl 2 0 only": "lgpl-2", "lgpl 2 0 or later": "lgpl-2", "lgpl 2 1": "lgpl-2",
    "lgpl 2 1 only": "lgpl-2", "lgpl 2 1 or later": "lgpl-2", "lgpl 3 0": "lgpl-3", "lgpl 3 0 only": "lgpl-3",
    "lgpl 3 0 or later": "lgpl-3", "agpl 3 0": "agpl-3", "agpl 3 0 only": "agpl-3", "agpl 3 0 or later": "agpl-3",
    "gfdl 1 1": "fdl", "gfdl 1 2": "fdl", "gfdl 1 3": "fdl", "gfdl 1 3 or later": "fdl", "mpl 1 0": "mpl-1",
    "mpl 1 1": "mpl-1", "mpl 2 0": "mpl-2", "epl 1 0": "epl", "epl 2 0": "epl", "cddl 1 0": "cddl", "cddl 1 1": "cddl",
    "bsl 1 0": "boost", "busl 1 1": "business-source", "unlicense": "unlicense", "wtfpl": "wtfpl",
    "artistic 1 0": "artistic", "artistic 2 0": "artistic-2", "psf 2 0": "python-2", "python 2 0": "python-2",
    "php 3 0": "php", "php 3 01": "php", "ruby": "ruby", "ofl 1 0": "ofl", "ofl 1 1": "ofl", "eupl 1 1": "eupl",
    "eupl 1 2": "eupl", "osl 3 0": "osl", "afl 3 0": "afl", "ms pl": "ms-pl", "ms rl": "ms-rl", "odbl 1 0": "odbl",
    "cc0 1 0": "cc0", "cc by 3 0": "cc-by", "cc by 4 0": "cc-by", "cc by sa 3 0": "cc-by-sa", "cc by sa 4 0": "cc-by-sa",
    "cc by nd 4 0": "cc-by-nd", "cc by nc 4 0": "cc-by-nc", "cc by nc sa 4 0": "cc-by-nc-sa",
    "cc by nc nd 4 0": "cc-by-nc-nd", "postgresql": "postgresql", "openssl": "openssl", "vim": "vim",
    "elastic 2 0": "elastic", "sspl 1 0": "sspl", "blueoak 1 0 0": "blue-oak", "upl 1 0": "upl", "ncsa": "ncsa",
    "curl": "curl", "w3c": "w3c", "libpng 2 0": "libpng", "mulanpsl 2 0": "mulan", "ecl 2 0": "ecl", "cpl 1 0": "cpl",
    "ipl 1 0": "ipl", "qpl 1 0": "qpl", "zpl 2 1": "zpl", "llvm exception": "llvm-exception",
    "classpath exception 2 0": "classpath-exception", "gcc exception 3 1": "gcc-exception",
}

#: What introduces an SPDX expression: priority, keywords, pattern, least number of terms.  The terms are joined
#: by "or", "and" and "with".
EXPRESSIONS = (
    (90, ("spdx", "licen"), "spdx {L} identifier", 1),
    (55, ("licen",), "{L}(?: expression)?", 2),
)

RULES = (
    # --- MIT, X11, ISC and their texts
    ("mit", 95, ("permission", "charge"), r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 95, ("copyright", "copies", "portions"), r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions"),
    ("mit", 80, ("mit", "licen"), r"{D} under {of}mit(?: {L})?"),
    ("mit", 80, ("mit", "licen", "under"), r"(?:{g}|under {of})mit {L}"),
    ("mit", 80, ("mit", "licen", "subject"), r"subject to {of}mit {L}"),
    ("mit", 60, ("mit", "licen"), r"(?:the )?mit(?: style| expat| x11)? {L}(?: agreement)?"),
    ("mit", 60, ("expat", "licen"), r"(?:the )?expat {L}"),
    ("mit", 50, ("mit", "licen"), r"{L} mit(?: {L})?"),
    ("mit", 85, ("opensource", "mit"), r"opensource org licenses mit(?: {L})?(?: php)?"),
    ("mit-0", 60, ("mit", "attribution"), r"mit no attribution(?: {L})?"),
    ("mit-0", 61, ("mit", "licen"), r"mit 0 {L}|{L} mit 0"),
    ("x11", 61, ("x11", "licen"), r"(?:mit )?x11 {L}|{D} under {of}(?:mit )?x11"),
    ("isc", 95, ("permission", "purpose"), r"permission to use copy modify and (?:or )?distribute this software for any purpose"),
    ("isc", 80, ("isc", "licen"), r"{D} under {of}isc(?: {L})?|under {of}isc {L}"),
    ("isc", 60, ("isc", "licen"), r"(?:the )?isc {L}"),
    ("isc", 50, ("isc", "licen"), r"{L} isc"),
    ("isc", 60, ("internet", "consortium", "licen"), r"internet (?:software|systems) consortium {L}"),
    # --- BSD
    ("bsd", 95, ("redistribution", "binary"), r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 95, ("redistributions", "retain"), r"redistributions of source code must retain the above copyright notice"),
    ("bsd", 95, ("redistributions", "reproduce"), r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", 95, ("neither", "endorse"), r"neither the names? of (?:[^ ]+ ){1,12}nor the names of (?:its|their|any|other) (?:[^ ]+ ){0,3}contributors may be used to endorse"),
    ("bsd-4-clause", 95, ("advertising", "acknowledgement|acknowledgment"), r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", 80, ("bsd", "licen"), r"{D} under {of}bsd(?: style| type)?(?: {L})?|under {of}bsd(?: style| type)? {L}"),
    ("bsd", 60, ("bsd", "licen"), r"(?:the )?bsd(?: style| type| like)? {L}"),
    ("bsd", 50, ("bsd", "licen"), r"{L} bsd"),
    ("bsd", 60, ("berkeley", "licen"), r"berkeley software distribution {L}"),
    ("bsd-2-clause", 62, ("bsd", "licen"), r"(?:the )?(?:bsd 2 clause|2 clause bsd|two clause bsd|bsd two clause|simplified bsd|freebsd bsd) {L}"),
    ("bsd-2-clause", 81, ("bsd", "under"), r"(?:{g}|under {of})(?:bsd 2 clause|2 clause bsd|two clause bsd|bsd two clause|simplified bsd)(?: {L})?"),
    ("bsd-2-clause", 45, ("bsd", "clause"), r"bsd 2 clause|2 clause bsd|two clause bsd|bsd two clause"),
    ("bsd-2-clause", 62, ("freebsd", "licen"), r"(?:the )?freebsd {L}"),
    ("bsd-3-clause", 62, ("bsd", "licen"), r"(?:the )?(?:bsd 3 clause|3 clause bsd|three clause bsd|bsd three clause|new bsd|modified bsd|revised bsd) {L}"),
    ("bsd-3-clause", 81, ("bsd", "under"), r"(?:{g}|under {of})(?:bsd 3 clause|3 clause bsd|three clause bsd|bsd three clause|new bsd|modified bsd|revised bsd)(?: {L})?"),
    ("bsd-3-clause", 45, ("bsd", "clause"), r"bsd 3 clause|3 clause bsd|three clause bsd|bsd three clause"),
    ("bsd-4-clause", 62, ("bsd", "licen"), r"(?:the )?(?:bsd 4 clause|4 clause bsd|four clause bsd|bsd four clause|original bsd) {L}"),
    ("bsd-4-clause", 45, ("bsd", "clause"), r"bsd 4 clause|4 clause bsd|four clause bsd|bsd four clause"),
    ("0bsd", 62, ("bsd", "clause"), r"(?:zero clause bsd|bsd zero clause|bsd 0 clause|0 clause bsd)(?: {L})?"),
    ("0bsd", 82, ("bsd", "clause", "under"), r"(?:{g}|under {of})(?:zero clause bsd|bsd zero clause|bsd 0 clause|0 clause bsd)(?: {L})?"),
    ("0bsd", 62, ("0bsd",), r"0bsd(?: {L})?"),
    ("bsd", 85, ("opensource", "bsd"), r"opensource org licenses bsd(?: {L})?(?: php)?"),
    ("ncsa", 60, ("ncsa", "licen"), r"(?:university of illinois )?ncsa(?: open source)? {L}"),
    # --- Apache
    ("apache-2", 95, ("apache", "compliance"), r"{D} under the apache {L} version 2 0(?: the {L})? you may not use this file except in compliance"),
    ("apache-2", 95, ("compliance", "licen"), r"you may not use this file except in compliance with the {L}"),
    ("apache-2", 95, ("applicable", "warranties|distributed"), r"unless required by applicable law or agreed to in writing software distributed under the {L} is distributed on an as is basis"),
    ("apache-2", 95, ("applicable", "licensor"), r"unless required by applicable law or agreed to in writing licensor provides the work"),
    ("apache-2", 81, ("apache", "licen"), r"(?:{g}|under {of}|subject to {of})apache(?: software)? {L} {v}2(?: 0)?"),
    ("apache-2", 81, ("apache", "licen"), r"{D} under {of}apache {v}2(?: 0)?(?: {L})?|under {of}apache {v}2(?: 0)? {L}"),
    ("apache-2", 61, ("apache", "licen"), r"(?:the )?apache(?: software)? {L} {v}2(?: 0)?"),
    ("apache-2", 61, ("apache", "licen"), r"(?:the )?apache {v}2(?: 0)? {L}"),
    ("apache-2", 51, ("apache", "licen"), r"{L} apache(?: {L})? {v}2(?: 0)?"),
    ("apache-2", 45, ("apache",), r"apache 2 0"),
    ("apache-2", 85, ("apache", "licenses"), r"apache org licenses license 2 0"),
    ("apache-2", 85, ("opensource", "apache"), r"opensource org licenses apache 2 0(?: php)?"),
    ("apache-2", 45, ("asl",), r"asl 2 0"),
    ("apache-1", 61, ("apache", "licen"), r"(?:the )?apache(?: software)? {L} {v}1(?: [01])?"),
    ("apache-1", 81, ("apache", "licen"), r"(?:{g}|under {of})apache(?: software)? {L} {v}1(?: [01])?"),
    ("apache-1", 45, ("apache",), r"apache 1 [01]"),
    ("apache", 80, ("apache", "licen"), r"{D} under {of}apache(?: software)?(?: style)?(?: {L})?|under {of}apache(?: software)?(?: style)? {L}"),
    ("apache", 60, ("apache", "licen"), r"(?:the )?apache(?: software)?(?: style)? {L}"),
    ("apache", 50, ("apache", "licen"), r"{L} apache"),
    # --- GNU
    ("gpl", 95, ("redistribute", "general"), r"this (?:program|file|software|script) is free software you can redistribute it and or modify it under the terms of the gnu general public {L}(?! as| v| 2| 3)"),
    ("gpl", 94, ("verbatim", "copies"), r"everyone is permitted to copy and distribute verbatim copies of this {L} document"),
    ("gpl", 80, ("gpl", "under"), r"(?:{g}|under {of})(?:gnu )?gpl(?: {L})?"),
    ("gpl", 80, ("gpl", "subject"), r"subject to {of}(?:gnu )?gpl(?: {L})?"),
    ("gpl", 80, ("general", "under"), r"(?:{g}|under {of})(?:gnu )?general public {L}"),
    ("gpl", 60, ("gpl", "licen"), r"(?:the )?(?:gnu )?gpl {L}|{L} (?:gnu )?gpl"),
    ("gpl", 60, ("gnu", "gpl"), r"(?:the )?gnu gpl"),
    ("gpl", 60, ("general", "licen"), r"(?:the )?(?:gnu )?general public {L}"),
    ("gpl-2", 81, ("general", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?(?:gnu )?general public {L}{p} {v}2(?: 0)?{o}"),
    ("gpl-2", 81, ("gpl",), r"(?:(?:{g}|under {of}))?(?:the )?(?:gnu )?gpl(?: {L})?{p} {v}2(?: 0)?{o}"),
    ("gpl-2", 81, ("gplv2|gpl2",), r"(?:(?:{g}|under {of}))?(?:gnu )?gplv?2(?: 0)?{o}(?: {L})?"),
    ("gpl-3", 81, ("general", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?(?:gnu )?general public {L}{p} {v}3(?: 0)?{o}"),
    ("gpl-3", 81, ("gpl",), r"(?:(?:{g}|under {of}))?(?:the )?(?:gnu )?gpl(?: {L})?{p} {v}3(?: 0)?{o}"),
    ("gpl-3", 81, ("gplv3|gpl3",), r"(?:(?:{g}|under {of}))?(?:gnu )?gplv?3(?: 0)?{o}(?: {L})?"),
    ("gpl-2", 85, ("gnu", "gpl"), r"gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?"),
    ("gpl-3", 85, ("gnu", "gpl"), r"gnu org licenses gpl(?: 3 0)?(?: html| txt)?"),
    ("lgpl", 80, ("lgpl", "under"), r"(?:{g}|under {of})(?:gnu )?lgpl(?: {L})?"),
    ("lgpl", 80, ("lgpl", "subject"), r"subject to {of}(?:gnu )?lgpl(?: {L})?"),
    ("lgpl", 80, ("lesser|library", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?(?:gnu )?(?:lesser|library) general public {L}"),
    ("lgpl", 60, ("lgpl", "licen"), r"(?:the )?(?:gnu )?lgpl {L}|{L} (?:gnu )?lgpl"),
    ("lgpl", 60, ("gnu", "lgpl"), r"(?:the )?gnu lgpl"),
    ("lgpl-2", 81, ("lesser|library", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?(?:gnu )?(?:lesser|library) general public {L}{p} {v}2(?: [01])?{o}"),
    ("lgpl-2", 81, ("lgpl",), r"(?:(?:{g}|under {of}))?(?:gnu )?lgpl(?: {L})?{p} {v}2(?: [01])?{o}"),
    ("lgpl-2", 81, ("lgplv2|lgpl2",), r"(?:(?:{g}|under {of}))?(?:gnu )?lgplv?2(?: [01])?{o}(?: {L})?"),
    ("lgpl-3", 81, ("lesser", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?(?:gnu )?lesser general public {L}{p} {v}3(?: 0)?{o}"),
    ("lgpl-3", 81, ("lgpl",), r"(?:(?:{g}|under {of}))?(?:gnu )?lgpl(?: {L})?{p} {v}3(?: 0)?{o}"),
    ("lgpl-3", 81, ("lgplv3|lgpl3",), r"(?:(?:{g}|under {of}))?(?:gnu )?lgplv?3(?: 0)?{o}(?: {L})?"),
    ("lgpl", 85, ("gnu", "lgpl"), r"gnu org licenses (?:old licenses )?lgpl(?: [23] [01])?(?: html| txt)?"),
    ("agpl-3", 81, ("agpl",), r"(?:(?:{g}|under {of}))?(?:gnu )?agpl(?:(?: {L})?{p} {v}3(?: 0)?)?{o}(?: {L})?"),
    ("agpl-3", 81, ("agplv3|agpl3",), r"(?:(?:{g}|under {of}))?(?:gnu )?agplv?3(?: 0)?{o}(?: {L})?"),
    ("agpl-3", 81, ("affero", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?(?:gnu )?affero general public {L}(?:{p} {v}3(?: 0)?{o})?"),
    ("agpl-3", 85, ("gnu", "agpl"), r"gnu org licenses agpl(?: 3 0)?(?: html| txt)?"),
    ("fdl", 81, ("documentation", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?(?:gnu )?free documentation {L}(?: {v}1(?: [123])?)?"),
    ("fdl", 45, ("gfdl",), r"gfdl(?: {v}1(?: [123])?)?"),
    ("classpath-exception", 60, ("classpath", "exception"), r"classpath exception"),
    ("gcc-exception", 60, ("runtime", "exception"), r"gcc runtime library exception"),
    ("llvm-exception", 60, ("llvm", "exceptions|exception"), r"llvm exceptions?"),
    # --- Mozilla, Eclipse, CDDL, CPL and relatives
    ("mpl-2", 95, ("source", "mozilla"), r"this source code form is subject to the terms of the mozilla public {L} v 2 0"),
    ("mpl-2", 81, ("mozilla", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?mozilla public {L} {v}2(?: 0)?"),
    ("mpl-2", 81, ("mpl",), r"(?:(?:{g}|under {of}))?mpl {v}2(?: 0)?"),
    ("mpl-2", 81, ("mplv2|mpl2",), r"(?:(?:{g}|under {of}))?mplv?2(?: 0)?(?: {L})?"),
    ("mpl-1", 81, ("mozilla", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?mozilla public {L} {v}1(?: [01])?"),
    ("mpl-1", 81, ("mpl",), r"(?:(?:{g}|under {of}))?mpl {v}1(?: [01])?"),
    ("mpl", 80, ("mozilla", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?mozilla public {L}"),
    ("mpl", 80, ("mpl", "under"), r"(?:{g}|under {of})mpl(?: {L})?"),
    ("mpl", 60, ("mpl", "licen"), r"(?:the )?mpl {L}|{L} mpl"),
    ("mpl", 85, ("mozilla", "mpl"), r"mozilla org mpl(?: [12] [01])?"),
    ("epl", 81, ("eclipse", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?eclipse public {L}(?: {v}[12](?: 0)?)?"),
    ("epl", 60, ("epl", "licen"), r"epl(?: {v}[12](?: 0)?)? {L}|{L} epl(?: {v}[12](?: 0)?)?"),
    ("epl", 45, ("epl",), r"epl [12] 0"),
    ("edl", 81, ("eclipse", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?eclipse distribution {L}(?: {v}1(?: 0)?)?"),
    ("cddl", 81, ("development", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?common development and distribution {L}(?: {v}1(?: [01])?)?"),
    ("cddl", 60, ("cddl",), r"cddl(?: {v}1(?: [01])?)?(?: {L})?"),
    ("cpl", 81, ("common", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?common public {L}(?: {v}1(?: 0)?)?"),
    ("ipl", 81, ("ibm", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?ibm public {L}(?: {v}1(?: 0)?)?"),
    ("osl", 81, ("software", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?open software {L}(?: {v}3(?: 0)?)?(?! agreement)"),
    ("osl", 45, ("osl",), r"osl 3 0"),
    ("osl", 60, ("osl", "licen"), r"osl {L}|{L} osl"),
    ("afl", 81, ("academic", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?academic free {L}(?: {v}[123](?: [01])?)?"),
    ("eupl", 81, ("european", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?european union public {L}(?: {v}1(?: [12])?)?"),
    ("eupl", 60, ("eupl",), r"eupl(?: {v}1(?: [12])?)?"),
    ("cecill", 60, ("cecill",), r"cecill(?: [bc])?(?: {L})?(?: {v}[12](?: [01])?)?"),
    ("ecl", 81, ("educational", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?educational community {L}(?: {v}[12](?: 0)?)?"),
    ("qpl", 81, ("public", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?q public {L}(?: {v}1(?: 0)?)?"),
    ("zpl", 81, ("zope", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?zope public {L}(?: {v}[12](?: [01])?)?"),
    ("sun", 81, ("sun", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?sun (?:public|industry standards source) {L}(?: {v}1(?: [01])?)?"),
    ("nokia", 81, ("nokia", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?nokia open source {L}"),
    ("apsl", 81, ("apple", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?apple public source {L}(?: {v}[12](?: [01])?)?"),
    ("ms-pl", 81, ("microsoft", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?microsoft public {L}"),
    ("ms-rl", 81, ("microsoft", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?microsoft reciprocal {L}"),
    ("ms-pl", 60, ("ms", "licen"), r"ms pl {L}|{L} ms pl"),
    ("upl", 81, ("universal", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?universal permissive {L}(?: {v}1(?: 0)?)?"),
    ("mulan", 81, ("mulan",), r"mulan (?:psl|permissive software {L})(?: {v}[12])?"),
    ("blue-oak", 81, ("blue", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?blue oak model {L}(?: {v}1(?: 0(?: 0)?)?)?"),
    ("parity", 60, ("parity", "licen"), r"(?:the )?parity public {L}(?: {v}[67](?: 0(?: 0)?)?)?"),
    # --- zlib, Boost, public domain and other short ones
    ("zlib", 95, ("permission", "freely"), r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("zlib", 95, ("altered", "misrepresented"), r"altered source versions must be plainly marked as such and must not be misrepresented"),
    ("zlib", 80, ("zlib", "licen"), r"{D} under {of}zlib(?: libpng)?(?: {L})?|under {of}zlib(?: libpng)? {L}"),
    ("zlib", 60, ("zlib", "licen"), r"(?:the )?zlib(?: libpng)? {L}|{L} zlib"),
    ("libpng", 60, ("libpng", "licen"), r"(?:the )?libpng {L}(?: {v}[12])?"),
    ("boost", 96, ("permission", "charge"), r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("boost", 81, ("boost", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?boost software {L}(?: {v}1(?: 0)?)?"),
    ("boost", 60, ("boost", "licen"), r"(?:the )?boost {L}(?: {v}1(?: 0)?)?"),
    ("boost", 85, ("boost", "txt"), r"boost org license 1 0 txt"),
    ("boost", 45, ("bsl",), r"bsl 1 0"),
    ("unlicense", 95, ("unencumbered",), r"free and unencumbered software released into the public domain"),
    ("unlicense", 60, ("unlicense",), r"(?:the )?unlicense(?: {L})?"),
    ("wtfpl", 95, ("want", "public"), r"do what the [a-z]+ you want to public {L}"),
    ("wtfpl", 60, ("wtfpl",), r"wtfpl(?: {L})?"),
    ("beerware", 60, ("beer", "licen"), r"(?:the )?beer ware {L}|the beer {L}"),
    ("beerware", 60, ("beerware", "licen"), r"(?:the )?beerware {L}"),
    ("public-domain", 65, ("domain",), r"(?:released |dedicated |placed )?(?:in|into|to) the public domain"),
    ("public-domain", 60, ("domain", "dedication"), r"public domain dedication"),
    # --- languages and products
    ("artistic-2", 81, ("artistic", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?artistic {L} {v}2(?: 0)?"),
    ("artistic", 80, ("artistic", "licen", "under"), r"(?:{g}|under {of})artistic {L}(?: {v}1(?: 0)?)?"),
    ("artistic", 60, ("artistic", "licen"), r"(?:the )(?:clarified )?artistic {L}(?: {v}1(?: 0)?)?"),
    ("artistic", 60, ("artistic", "licen", "perl"), r"perl artistic {L}|artistic {L} perl"),
    ("artistic-2", 45, ("artistic",), r"artistic 2 0"),
    ("perl", 80, ("perl", "terms"), r"(?:under )?the same terms as perl(?: [0-9] [0-9]+)?(?: itself)?"),
    ("python-2", 81, ("python", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?python software foundation {L}(?: agreement)?(?: {v}2)?"),
    ("python-2", 60, ("python", "licen"), r"(?:the )?python {L}(?: {v}2(?: 0)?)?|{L} python 2 0"),
    ("python-2", 45, ("psf",), r"psf 2 0"),
    ("python-2", 60, ("psf", "licen"), r"(?:the )?psf {L}(?: agreement)?|{L} psf"),
    ("ruby", 60, ("ruby", "licen"), r"(?:the )?ruby {L}|under {of}ruby {L}|{L} ruby"),
    ("ruby", 80, ("ruby", "terms"), r"the same terms as ruby(?: itself)?"),
    ("php", 60, ("php", "licen"), r"(?:the )?php {L}(?: {v}3(?: 0[01]?| 01)?)?|{L} php"),
    ("postgresql", 80, ("postgresql", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?postgresql {L}|{L} postgresql"),
    ("postgresql", 95, ("permission", "fee"), r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("openssl", 80, ("openssl", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?openssl {L}|{L} openssl"),
    ("openssl", 95, ("openssl", "toolkit"), r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("vim", 80, ("vim", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?vim {L}|{L} vim"),
    ("curl", 60, ("curl", "licen"), r"(?:the )?curl {L}|{L} curl"),
    ("w3c", 60, ("w3c", "licen"), r"(?:the )?w3c(?: software)?(?: notice and)?(?: document)? {L}"),
    ("icu", 60, ("icu", "licen"), r"(?:the )?icu {L}"),
    ("unicode", 60, ("unicode", "licen"), r"unicode(?: inc)?(?: data files and software)? {L}(?: agreement| v3)?"),
    ("ijg", 60, ("jpeg", "licen"), r"independent jpeg group {L}"),
    ("tcl", 60, ("tcl", "licen"), r"tcl(?: tk)? {L}"),
    ("hpnd", 95, ("permission", "copyright", "copies", "notice"), r"permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose is hereby granted without fee provided that the above copyright notice appears? in all copies and that both that copyright notice"),
    ("ofl", 81, ("font", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?(?:sil )?open font {L}(?: {v}1(?: [01])?)?"),
    ("ofl", 60, ("ofl",), r"(?:sil )?ofl(?: {v}1(?: [01])?)?(?: {L})?"),
    ("ubuntu-font", 60, ("ubuntu", "licen"), r"ubuntu font {L}(?: {v}1(?: 0)?)?"),
    ("lppl", 60, ("latex", "licen"), r"latex project public {L}(?: {v}1(?: [0-3][abc]?)?)?"),
    ("lppl", 45, ("lppl",), r"lppl(?: {v}1(?: [0-3][abc]?)?)?"),
    # --- source available
    ("elastic", 81, ("elastic", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?elastic {L}(?: {v}2(?: 0)?)?|{L} elastic 2 0"),
    ("sspl", 81, ("server", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?server side public {L}(?: {v}1(?: 0)?)?"),
    ("sspl", 45, ("sspl",), r"sspl(?: {v}1(?: 0)?)?"),
    ("business-source", 81, ("business", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?business source {L}(?: {v}1(?: [01])?)?"),
    ("business-source", 45, ("busl",), r"busl 1 1"),
    ("business-source", 45, ("bsl",), r"bsl 1 1"),
    ("commons-clause", 60, ("commons", "clause"), r"commons clause(?: {L})?(?: condition)?"),
    ("confluent", 60, ("confluent", "licen"), r"confluent community {L}"),
    ("redis-source", 60, ("redis", "licen"), r"redis source available {L}(?: {v}2)?"),
    ("polyform", 60, ("polyform", "licen"), r"polyform (?:noncommercial|small business|strict|shield|perimeter|free trial|internal use) {L}(?: 1 0 0)?"),
    ("fair-source", 60, ("fair", "licen"), r"(?:the )?fair source {L}"),
    ("functional-source", 60, ("functional", "licen"), r"functional source {L}"),
    ("hippocratic", 60, ("hippocratic", "licen"), r"hippocratic {L}"),
    # --- data and content
    ("odbl", 81, ("database", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?open (?:data commons open )?database {L}(?: {v}1(?: 0)?)?"),
    ("odbl", 60, ("odbl",), r"odbl(?: {v}1(?: 0)?)?"),
    ("odc-by", 60, ("commons", "attribution"), r"open data commons attribution {L}(?: {v}1(?: 0)?)?"),
    ("pddl", 60, ("commons", "domain"), r"open data commons public domain dedication(?: and {L})?"),
    ("cdla", 60, ("community", "data"), r"community data {L} agreement (?:permissive|sharing)(?: {v}[12](?: 0)?)?"),
    ("ogl", 81, ("government", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?open government {L}(?: {v}[123](?: 0)?)?"),
    ("openrail", 60, ("openrail",), r"(?:bigscience |creativeml )?openrail(?: m)?(?: {L})?"),
    ("openrail", 60, ("responsible", "licen"), r"(?:open )?responsible ai {L}"),
    ("llama", 60, ("llama", "licen"), r"llama(?: [234])?(?: [0-9])? community {L}(?: agreement)?"),
    ("cc0", 60, ("cc0",), r"(?:cc )?cc0(?: {v}1 0)?(?: universal)?(?: public domain dedication)?(?: {L})?"),
    ("cc0", 61, ("commons", "zero|cc0"), r"creative commons (?:zero|cc0)(?: {v}1 0)?(?: universal)?"),
    ("cc0", 85, ("creativecommons", "zero"), r"creativecommons org publicdomain zero(?: 1 0)?"),
    ("cc-by", 60, ("cc", "by"), r"cc by [1-4] [05](?: international| unported)?(?: {L})?"),
    ("cc-by", 80, ("cc", "licen"), r"{D} under {of}cc by(?! (?:nc|sa|nd))|{L} cc by(?! (?:nc|sa|nd))|cc by {L}"),
    ("cc-by-sa", 60, ("cc", "sa"), r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", 60, ("cc", "nd"), r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", 60, ("cc", "nc"), r"cc by nc(?: [1-4] [05])?(?! (?:sa|nd))"),
    ("cc-by-nc-sa", 60, ("cc", "nc", "sa"), r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", 60, ("cc", "nc", "nd"), r"cc by nc nd(?: [1-4] [05])?"),
    ("cc", 60, ("commons", "licen"), r"(?:(?:{g}|under {of}))?(?:the )?creative commons {L}"),
    ("cc-by", 61, ("commons", "attribution|by"), r"creative commons (?:attribution|by)(?! (?:non|noncommercial|share|sharealike|no|noderivs|noderivatives|noderivative|noderiv|nc|sa|nd)){c}"),
    ("cc-by-sa", 61, ("commons", "share|sharealike|sa"), r"creative commons (?:attribution share alike|attribution sharealike|by sa){c}"),
    ("cc-by-nd", 61, ("commons", "no|noderivs|noderivatives|noderivative|noderiv|nd"), r"creative commons (?:attribution no ?deriv(?:ative)?s?(?: works)?|by nd){c}"),
    ("cc-by-nc", 61, ("commons", "non|noncommercial|nc"), r"creative commons (?:attribution non ?commercial|by nc)(?! (?:share|sharealike|no|noderivs|noderivatives|noderivative|noderiv|sa|nd)){c}"),
    ("cc-by-nc-sa", 62, ("commons", "share|sharealike|sa"), r"creative commons (?:attribution non ?commercial share ?alike|by nc sa){c}"),
    ("cc-by-nc-nd", 62, ("commons", "no|noderivs|noderivatives|noderivative|noderiv|nd"), r"creative commons (?:attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?|by nc nd){c}"),
    ("cc-by", 85, ("creativecommons", "by"), r"creativecommons org licenses by(?: [1-4] [05])?(?: legalcode| deed)?(?! (?:nc|sa|nd))"),
    ("cc-by-sa", 85, ("creativecommons", "sa"), r"creativecommons org licenses by sa(?: [1-4] [05])?"),
    ("cc-by-nd", 85, ("creativecommons", "nd"), r"creativecommons org licenses by nd(?: [1-4] [05])?"),
    ("cc-by-nc", 85, ("creativecommons", "nc"), r"creativecommons org licenses by nc(?: [1-4] [05])?(?! (?:sa|nd))"),
    ("cc-by-nc-sa", 86, ("creativecommons", "nc", "sa"), r"creativecommons org licenses by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", 86, ("creativecommons", "nc", "nd"), r"creativecommons org licenses by nc nd(?: [1-4] [05])?"),
    # --- remarks and reservations
    ("proprietary", 60, ("proprietary", "licen"), r"(?:the )?proprietary(?: software)? {L}|{L} proprietary|{D} under {of}proprietary"),
    ("proprietary", 60, ("eula", "licen"), r"end user {L} agreement eula"),
    ("proprietary", 60, ("end", "licen", "agreement"), r"end user {L} agreement"),
    ("proprietary", 60, ("unauthorized", "prohibited"), r"unauthorized (?:copying|use|reproduction|distribution) (?:[^ ]+ ){1,12}is (?:strictly )?prohibited"),
    ("proprietary", 60, ("confidential", "proprietary"), r"confidential and proprietary|proprietary and confidential"),
    ("all-rights-reserved", 40, ("rights", "reserved"), r"all rights reserved"),
    ("warranty-disclaimer", 40, ("warranty", "kind"), r"provided as is without (?:any )?warranty of any kind"),
    ("warranty-disclaimer", 40, ("warranty", "express|expressed"), r"provided as is without (?:any )?(?:express(?:ed)? or implied )warranty"),
    ("warranty-disclaimer", 39, ("warranty", "provided"), r"provided as is without (?:any )?warranty"),
    ("warranty-disclaimer", 40, ("warranty", "merchantability"), r"without even the implied warranty of merchantability"),
    ("warranty-disclaimer", 40, ("liable", "damages"), r"in no event shall (?:[^ ]+ ){1,12}be liable for any (?:claim|direct|special|damages)(?: [^ ]+){0,4} damages"),
)


def expanded(pattern: str) -> str:
    """A pattern with its abbreviations written out."""
    for mark, text in MACROS.items():
        pattern = pattern.replace(mark, text)
    return pattern
