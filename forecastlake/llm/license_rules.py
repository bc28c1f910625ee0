"""Signature rules of license scans, in order of priority.

A rule is a line ``label | confidence | keyword | regex`` over normalised text: words in
lower case, one space between them. Every match holds one of the rule's keywords (parted
by ``/``); a rule runs only where one occurs. A regex must begin and end at word ends. Short forms:
``{L}`` license, ``{V}`` an optional "version", ``{U}`` "under the terms of the".
Names are written once and used by three templates: identifier, notice and bare name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

_SHORT = {
    "{L}": "licen[cs]e",
    "{V}": "(?: version| ver| v)?",
    "{U}": "under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?",
}

#: Sentences of license texts and of the notices that go with them.
SIGNATURES = r"""
mit | 0.98 | free of charge to any person | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit-0 | 0.97 | free of charge to any person | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
x11 | 0.97 | x consortium | except as contained in this notice the name of the x consortium shall not be used
isc | 0.97 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
0bsd | 0.97 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software
hpnd | 0.90 | permission to use copy modify | permission to use copy modify and distribute this software and its documentation for any purpose (?:and without fee )?is hereby granted
bsd-4 | 0.97 | all advertising materials | all advertising materials mentioning features or use of this software must display
bsd-3 | 0.96 | endorse or promote | neither the names? of .{1,80}? nor the names of (?:its|their) contributors may be used to endorse or promote products
bsd-3 | 0.90 | endorse or promote | the names? of the (?:author|copyright holder|contributors?) may not be used to endorse or promote products
bsd-2 | 0.85 | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-2-views | 0.90 | views and conclusions | the views and conclusions contained in the software and documentation are those of the authors
bsd-patent | 0.93 | patent license | subject to the terms and conditions of this license each copyright holder and contributor hereby grants .{0,120}?patent license
apache-2 | 0.98 | apache license | licensed under the apache {L}{V} 2(?: 0)? the {L} you may not use this file except in compliance
apache-2 | 0.95 | apache org licenses | (?:www )?apache org licenses license 2 0
apache-1.1 | 0.95 | apache software foundation | this product includes software developed by the apache software foundation
apache-1 | 0.95 | apache group | this product includes software developed by the apache group
gpl-3-or-later | 0.98 | gnu general public | under the terms of the gnu general public {L} as published by the free software foundation either version 3 of the {L} or at your option any later version
gpl-2-or-later | 0.98 | gnu general public | under the terms of the gnu general public {L} as published by the free software foundation either version 2 of the {L} or at your option any later version
gpl-1-or-later | 0.98 | gnu general public | under the terms of the gnu general public {L} as published by the free software foundation either version 1(?: of the {L})? or at your option any later version
gpl-2-only | 0.97 | gnu general public | under the terms of the gnu general public {L}{V} 2 (?:only )?as published by the free software foundation
lgpl-3-or-later | 0.98 | lesser general public | under the terms of the gnu lesser general public {L} as published by the free software foundation either version 3 of the {L} or at your option any later version
lgpl-2.1-or-later | 0.98 | lesser general public | under the terms of the gnu lesser general public {L} as published by the free software foundation either version 2 1 of the {L} or at your option any later version
lgpl-2-or-later | 0.98 | library general public | under the terms of the gnu library general public {L} as published by the free software foundation either version 2 of the {L} or at your option any later version
agpl-3-or-later | 0.98 | affero general public | under the terms of the gnu affero general public {L} as published by the free software foundation either version 3 of the {L} or at your option any later version
fdl | 0.96 | free documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {L}
gpl-any | 0.85 | gnu general public | you should have received a copy of the gnu general public {L}
lgpl-any | 0.85 | lesser general public | you should have received a copy of the gnu lesser general public {L}
agpl-any | 0.85 | affero general public | you should have received a copy of the gnu affero general public {L}
classpath-exception | 0.96 | linking this library | linking this library statically or dynamically with other modules is making a combined work
gcc-exception | 0.96 | gcc runtime library | gcc runtime library exception
llvm-exception | 0.96 | llvm exceptions | llvm exceptions to the apache 2 0 {L}
font-exception | 0.95 | embed this font | as a special exception if you create a document which uses this font and embed this font
bison-exception | 0.95 | bison parser skeleton | create a larger work that contains part or all of the bison parser skeleton
autoconf-exception | 0.95 | autoconf | output of autoconf when it processes|configuration script generated by autoconf
openssl-exception | 0.94 | openssl | permission to link .{0,80}?with the openssl (?:project s )?openssl library
mpl-2 | 0.98 | mozilla public | this source code form is subject to the terms of the mozilla public {L} v 2 0
mpl-2 | 0.95 | mozilla org mpl | (?:www )?mozilla org mpl 2 0
mpl-1.1 | 0.97 | mozilla public | the contents of this file are subject to the mozilla public {L} version 1 1
mpl-1 | 0.97 | mozilla public | the contents of this file are subject to the mozilla public {L} version 1 0
npl-1.1 | 0.97 | netscape public | the contents of this file are subject to the netscape public {L} version 1 1
cddl-1 | 0.97 | common development and | the contents of this file are subject to the terms of the common development and distribution {L}
epl-2 | 0.97 | eclipse public | made available under the terms of the eclipse public {L} (?:version |v )?2 0
epl-1 | 0.97 | eclipse public | made available under the terms of the eclipse public {L} (?:version |v )?1 0
cpl-1 | 0.96 | common public | made available under the terms of the common public {L} (?:version |v )?1 0
edl-1 | 0.96 | eclipse distribution | made available under the terms of the eclipse distribution {L} (?:version |v )?1 0
zlib | 0.97 | as is without any express | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | 0.95 | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented
boost-1 | 0.97 | boost software | distributed under the boost software {L}{V} 1 0
boost-1 | 0.96 | free of charge to any person | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this {L}
unlicense | 0.97 | free and unencumbered | this is free and unencumbered software released into the public domain
cc0-1 | 0.97 | cc0 | to the extent possible under law .{0,200}?cc0
cc0-1 | 0.96 | waived all copyright | waived all copyright and related or neighboring rights
cc0-1 | 0.95 | publicdomain zero | creativecommons org publicdomain zero 1 0
pddl-1 | 0.95 | public domain dedication | open data commons public domain dedication and {L}
odbl-1 | 0.96 | open database | made available under the open database {L}
odc-by-1 | 0.96 | open data commons attribution | made available under the open data commons attribution {L}
wtfpl | 0.96 | do what the | do what the fuck you want to(?: public {L})?
beerware | 0.96 | buy me a beer | you can buy me a beer in return
artistic-2 | 0.96 | artistic | under (?:the terms of )?the artistic {L} 2 0
artistic-1 | 0.90 | artistic | under the same terms as perl itself|either the gnu general public {L} or the artistic {L}
perl | 0.92 | perl itself | (?:redistribute|distribute)(?: it)? and or modify it under the same terms as perl itself
python-2 | 0.96 | python software foundation | this {L} agreement is between the python software foundation
cnri-python | 0.95 | cnri | this {L} agreement is between the corporation for national research initiatives
php-3.01 | 0.96 | php | subject to version 3 01 of the php {L}
php-3 | 0.96 | php | subject to version 3 0 of the php {L}
ruby | 0.93 | ruby | you can redistribute it and or modify it under either the terms of the (?:2 clause bsdl|gpl) .{0,80}?ruby
openssl | 0.96 | openssl project | this product includes software developed by the openssl project
ssleay | 0.96 | eric young | this product includes cryptographic software written by eric young
curl | 0.95 | daniel stenberg | copyright .{0,40}?daniel stenberg .{0,80}?all rights reserved
libpng | 0.96 | png reference library | the png reference library is supplied as is
libtiff | 0.95 | sam leffler | the names of sam leffler and silicon graphics may not be used
ijg | 0.96 | independent jpeg group | this software is based in part on the work of the independent jpeg group
ftl | 0.95 | freetype | portions of this software are copyright .{0,40}?the freetype project
ncsa | 0.96 | university of illinois | university of illinois ncsa open source {L}
w3c | 0.95 | w3c | w3c software (?:notice and |and document notice and )?{L}
unicode | 0.95 | unicode | unicode (?:inc )?{L} agreement data files and software
icu | 0.95 | international business machines | icu {L} icu 1 8 1 and later
ofl-1.1 | 0.97 | open font | this font software is licensed under the sil open font {L}{V} 1 1
ms-pl | 0.95 | microsoft public | this {L} governs use of the accompanying software .{0,200}?microsoft public {L}
upl-1 | 0.95 | universal permissive | licensed under the universal permissive {L}
postgresql | 0.95 | university of california | in no event shall the university of california be liable .{0,200}?postgresql
sleepycat | 0.95 | sleepycat | redistributions in any form must be accompanied by information on how to obtain complete source code
bsl-1.1 | 0.95 | business source | business source {L} 1 1
elastic-2 | 0.95 | elastic | you may not provide the (?:software|products) to third parties as a hosted or managed service
sspl-1 | 0.96 | server side public | server side public {L}{V} 1
commons-clause | 0.96 | commons clause | commons clause (?:{L} )?condition|the commons clause
json | 0.96 | for good not evil | the software shall be used for good not evil
polyform-noncommercial | 0.95 | polyform | polyform noncommercial {L}
polyform-small-business | 0.95 | polyform | polyform small business {L}
openrail | 0.93 | openrail | (?:big science|bigscience|creativeml|bigcode) (?:bloom )?(?:open )?(?:rail|openrail) ?[ms]?
llama-community | 0.94 | llama | llama [23](?: [0-9])? community {L}(?: agreement)?
gemma-terms | 0.93 | gemma | gemma terms of use
cc-by-nc-nd | 0.95 | licenses by nc nd | creativecommons org licenses by nc nd [1-4] [05]
cc-by-nc-sa | 0.95 | licenses by nc sa | creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc | 0.95 | licenses by nc | creativecommons org licenses by nc [1-4] [05]
cc-by-nd | 0.95 | licenses by nd | creativecommons org licenses by nd [1-4] [05]
cc-by-sa | 0.95 | licenses by sa | creativecommons org licenses by sa [1-4] [05]
cc-by | 0.95 | licenses by | creativecommons org licenses by [1-4] [05]
us-government | 0.90 | united states government | (?:is a )?work of the united states government (?:and )?(?:is )?(?:not subject to|in the public domain)
ogl-uk-3 | 0.95 | open government | contains public sector information licensed under the open government {L}(?: v 3 0| v3 0)?
etalab-2 | 0.95 | licence ouverte | licence ouverte open licen[cs]e(?: version 2 0)?|licence ouverte
dl-de-by-2 | 0.95 | datenlizenz | datenlizenz deutschland namensnennung(?: version)? 2 0
dl-de-zero-2 | 0.95 | datenlizenz | datenlizenz deutschland zero(?: version)? 2 0
"""

#: Names: ``label | keyword | regex of the identifier | regex of the name``.
NAMES = r"""
gpl-3-or-later | general public | gpl 3 0 or later | (?:gnu )?general public {L}{V} 3(?: 0)? or (?:any )?later(?: version)?
gpl-3-only | general public | gpl 3 0 only | (?:gnu )?general public {L}{V} 3(?: 0)? only
gpl-3 | general public | gpl 3 0 | (?:gnu )?general public {L}{V} 3(?: 0)?
gpl-2-or-later | general public | gpl 2 0 or later | (?:gnu )?general public {L}{V} 2(?: 0)? or (?:any )?later(?: version)?
gpl-2-only | general public | gpl 2 0 only | (?:gnu )?general public {L}{V} 2(?: 0)? only
gpl-2 | general public | gpl 2 0 | (?:gnu )?general public {L}{V} 2(?: 0)?
gpl-1 | general public | gpl 1 0(?: only| or later)? | (?:gnu )?general public {L}{V} 1(?: 0)?
gpl-3 | gpl | gpl v3 | (?:gnu )?gpl ?(?:version |v ?)3(?: 0)?
gpl-2 | gpl | gpl v2 | (?:gnu )?gpl ?(?:version |v ?)2(?: 0)?
lgpl-3-or-later | lesser general public | lgpl 3 0 or later | (?:gnu )?lesser general public {L}{V} 3(?: 0)? or (?:any )?later(?: version)?
lgpl-3 | lesser general public | lgpl 3 0(?: only)? | (?:gnu )?lesser general public {L}{V} 3(?: 0)?
lgpl-2.1-or-later | lesser general public | lgpl 2 1 or later | (?:gnu )?lesser general public {L}{V} 2 1 or (?:any )?later(?: version)?
lgpl-2.1 | lesser general public | lgpl 2 1(?: only)? | (?:gnu )?lesser general public {L}{V} 2 1
lgpl-2 | library general public | lgpl 2 0(?: only| or later)? | (?:gnu )?library general public {L}(?:{V} 2(?: 0)?)?
lgpl-3 | lgpl | lgpl v3 | (?:gnu )?lgpl ?(?:version |v ?)3(?: 0)?
lgpl-2.1 | lgpl | lgpl v2 1 | (?:gnu )?lgpl ?(?:version |v ?)2 1
agpl-3-or-later | affero general public | agpl 3 0 or later | (?:gnu )?affero general public {L}{V} 3(?: 0)? or (?:any )?later(?: version)?
agpl-3 | affero general public | agpl 3 0(?: only)? | (?:gnu )?affero general public {L}{V} 3(?: 0)?
agpl-1 | affero general public | agpl 1 0 | affero general public {L}{V} 1(?: 0)?
agpl-3 | agpl | agpl v3 | (?:gnu )?agpl ?(?:version |v ?)3(?: 0)?
lgpl-any | lesser general public | lgpl | (?:gnu )?lesser general public {L}
agpl-any | affero general public | agpl | (?:gnu )?affero general public {L}
gpl-any | general public | gpl | gnu general public {L}
fdl-1.3 | free documentation | gfdl 1 3(?: only| or later)? | (?:gnu )?free documentation {L}{V} 1 3
fdl-1.2 | free documentation | gfdl 1 2(?: only| or later)? | (?:gnu )?free documentation {L}{V} 1 2
fdl-1.1 | free documentation | gfdl 1 1(?: only| or later)? | (?:gnu )?free documentation {L}{V} 1 1
fdl | free documentation | gfdl | gnu free documentation {L}
apache-2 | apache | apache 2 0 | apache (?:software )?{L}{V} 2(?: 0)?|apache 2(?: 0)? {L}
apache-1.1 | apache | apache 1 1 | apache (?:software )?{L}{V} 1 1
apache-1 | apache | apache 1 0 | apache (?:software )?{L}{V} 1 0
apache-any | apache | apache | apache (?:software )?{L}
mit-0 | mit no attribution | mit 0 | mit no attribution {L}
mit-modern | variant of the mit | mit modern variant | modern variant of the mit {L}
mit | mit licen/mit x11/mit style/expat | mit | (?:mit|expat) (?:x11 )?(?:style )?{L}
x11 | x11 | x11 | x11 {L}
isc | isc licen | isc | isc {L}
0bsd | bsd | 0bsd | (?:zero clause|0 clause|bsd zero clause) (?:bsd )?{L}
bsd-4 | bsd | bsd 4 clause | (?:4|four) clause bsd {L}|original bsd {L}
bsd-3 | bsd | bsd 3 clause | (?:3|three) clause bsd {L}|bsd (?:3|three) clause(?: {L})?|(?:new|modified|revised) bsd {L}
bsd-2 | bsd | bsd 2 clause | (?:2|two) clause bsd {L}|bsd (?:2|two) clause(?: {L})?|(?:simplified|free) bsd {L}
bsd-1 | bsd | bsd 1 clause | (?:1|one) clause bsd {L}
bsd-any | bsd | bsd | bsd (?:style )?{L}
mpl-2 | mozilla public | mpl 2 0 | mozilla public {L}{V} 2(?: 0)?
mpl-1.1 | mozilla public | mpl 1 1 | mozilla public {L}{V} 1 1
mpl-1 | mozilla public | mpl 1 0 | mozilla public {L}{V} 1 0
mpl-any | mozilla public | mpl | mozilla public {L}
npl-1.1 | netscape public | npl 1 1 | netscape public {L}{V} 1 1
npl-any | netscape public | npl 1 0 | netscape public {L}
cddl-1.1 | common development and | cddl 1 1 | common development and distribution {L}{V} 1 1
cddl-1 | common development and | cddl 1 0 | common development and distribution {L}(?:{V} 1 0)?
epl-2 | eclipse public | epl 2 0 | eclipse public {L}{V} 2(?: 0)?
epl-1 | eclipse public | epl 1 0 | eclipse public {L}{V} 1(?: 0)?
epl-any | eclipse public | epl | eclipse public {L}
edl-1 | eclipse distribution | edl 1 0 | eclipse distribution {L}(?:{V} 1 0)?
cpl-1 | common public | cpl 1 0 | common public {L}(?:{V} 1 0)?
ipl-1 | ibm public | ipl 1 0 | ibm public {L}(?:{V} 1 0)?
eupl-1.2 | european union public | eupl 1 2 | european union public {L}{V} 1 2
eupl-1.1 | european union public | eupl 1 1 | european union public {L}{V} 1 1
eupl-any | european union public | eupl | european union public {L}
cecill-2.1 | cecill | cecill 2 1 | cecill (?:free software )?{L}{V} 2 1
cecill-b | cecill b | cecill b | cecill b (?:free software )?{L}
cecill-c | cecill c | cecill c | cecill c (?:free software )?{L}
cecill-any | cecill | cecill | cecill (?:free software )?{L}
osl-3 | open software | osl 3 0 | open software {L}{V} 3(?: 0)?
afl-3 | academic free | afl 3 0 | academic free {L}(?:{V} 3(?: 0)?)?
rpl-1.5 | reciprocal public | rpl 1 5 | reciprocal public {L}(?:{V} 1 5)?
qpl-1 | q public | qpl 1 0 | q public {L}(?:{V} 1 0)?
spl-1 | sun public | spl 1 0 | sun public {L}(?:{V} 1 0)?
sissl | sun industry standards | sissl | sun industry standards source {L}
apsl-2 | apple public source | apsl 2 0 | apple public source {L}(?:{V} 2(?: 0)?)?
nasa-1.3 | nasa open source | nasa 1 3 | nasa open source agreement(?:{V} 1 3)?
cpal-1 | common public attribution | cpal 1 0 | common public attribution {L}(?:{V} 1 0)?
lppl-1.3c | latex project public | lppl 1 3c | latex project public {L}{V} 1 3c
lppl-any | latex project public | lppl 1 [0-3]a? | latex project public {L}
artistic-2 | artistic | artistic 2 0 | artistic {L}{V} 2(?: 0)?
artistic-1 | artistic | artistic 1 0(?: perl)? | artistic {L}(?:{V} 1 0)?
python-2 | python | python 2 0|psf 2 0 | python software foundation {L}
php-3.01 | php | php 3 01 | php {L}{V} 3 01
php-any | php | php 3 0 | php {L}
ruby | ruby | ruby | ruby {L}
zpl-2.1 | zope public | zpl 2 1 | zope public {L}(?:{V} 2 1)?
zlib | zlib | zlib | zlib (?:libpng )?{L}
libpng-2 | libpng | libpng 2 0 | libpng {L}(?:{V} 2)?
boost-1 | boost software | bsl 1 0 | boost software {L}(?:{V} 1 0)?
unlicense | unlicense | unlicense | the unlicense
wtfpl | wtfpl | wtfpl | wtfpl(?:{V} 2)?
ncsa | ncsa | ncsa | (?:uiuc |university of illinois )?ncsa open source {L}
ofl-1.1 | open font | ofl 1 1 | (?:sil )?open font {L}(?:{V} 1 1)?
ms-pl | microsoft public | ms pl | microsoft public {L}
ms-rl | microsoft reciprocal | ms rl | microsoft reciprocal {L}
upl-1 | universal permissive | upl 1 0 | universal permissive {L}(?:{V} 1 0)?
postgresql | postgresql | postgresql | postgresql {L}
openssl | openssl | openssl | openssl {L}
vim | vim | vim | vim {L}
tcl | tcl tk | tcl | tcl tk {L}
sleepycat | sleepycat | sleepycat | sleepycat {L}
mulan-2 | mulan | mulanpsl 2 0 | mulan (?:psl v2|permissive software {L}{V} 2)
blueoak-1 | blue oak | blueoak 1 0 0 | blue oak model {L}(?:{V} 1 0 0)?
bsl-1.1 | business source | busl 1 1 | business source {L}
sspl-1 | server side public | sspl 1 0 | server side public {L}
elastic-2 | elastic | elastic 2 0 | elastic {L}(?:{V} 2(?: 0)?)?
hippocratic-2.1 | hippocratic | hippocratic 2 1 | hippocratic {L}(?:{V} 2 1)?
parity-7 | parity public | parity 7 0 0 | parity public {L}(?:{V} 7(?: 0 0)?)?
odbl-1 | open database | odbl 1 0 | (?:open data commons )?open database {L}(?:{V} 1 0)?
odc-by-1 | open data commons attribution | odc by 1 0 | open data commons attribution {L}(?:{V} 1 0)?
pddl-1 | public domain dedication | pddl 1 0 | public domain dedication and {L}
cdla-permissive-2 | community data | cdla permissive 2 0 | community data {L} agreement permissive{V} 2(?: 0)?
cdla-permissive-1 | community data | cdla permissive 1 0 | community data {L} agreement permissive(?:{V} 1(?: 0)?)?
cdla-sharing-1 | community data | cdla sharing 1 0 | community data {L} agreement sharing(?:{V} 1(?: 0)?)?
ogl-uk-3 | open government | ogl uk 3 0 | open government {L}(?:{V} 3(?: 0)?)?
cc0-1 | cc0 | cc0 1 0 | cc0(?: 1 0)?(?: universal)?
openrail-m | openrail | creativeml openrail m | open ?rail m {L}
"""

#: Creative Commons: parts of a label and how they are spelt out; every version.
CC_PARTS = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative|ative work|)s?"}
CC_KINDS = ("by-nc-nd", "by-nc-sa", "by-nc", "by-nd", "by-sa", "by")
CC_VERSIONS = ("4 0", "3 0", "2 5", "2 0", "1 0")

#: References that name no license, or a lack of one.
REFERENCES = r"""
public-domain | 0.70 | public domain | (?:released|dedicated|placed) (?:in|in to|into|to) the public domain
public-domain | 0.50 | public domain | (?:is|are) in the public domain
proprietary | 0.60 | proprietary | (?:confidential and proprietary|proprietary and confidential)
proprietary | 0.60 | strictly prohibited | unauthorized (?:copying|use|reproduction|distribution) .{0,60}?(?:is )?strictly prohibited
see-license-file | 0.40 | license file | (?:see|refer to) (?:the )?license file
"""

#: Phrases that always count, with their labels; the confidence of a place.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
BASE_CONFIDENCE = 0.9


@dataclass(frozen=True)
class Rule:
    label: str
    confidence: float
    keyword: str
    pattern: re.Pattern


def _rule(label: str, confidence: float, keyword: str, regex: str) -> Rule:
    for a, b in _SHORT.items():
        regex = regex.replace(a, b)
    return Rule(label, confidence, keyword, re.compile(rf"(?<= )(?:{regex})(?= )"))


def _table(text: str) -> list[list[str]]:
    return [[x.strip() for x in re.split(r" \| ", line)] for line in text.strip().splitlines()]


def _creative_commons() -> list[tuple[str, str, str, str]]:
    out = []
    for kind in CC_KINDS:
        parts = kind.split("-")
        words = " ".join(CC_PARTS[p] for p in parts)
        short = "cc " + " ".join(parts)
        for version in CC_VERSIONS:
            label = f"cc-{kind}-{version.replace(' ', '.')}"
            out.append((label, "cc by", f"{short} {version}", f"{short} {version}"))
            out.append((label, "creative commons", f"{short} {version}", f"creative commons {words}(?: {{L}})?{{V}} {version}"))
        out.append((f"cc-{kind}", "creative commons", short, f"creative commons {words}(?: {{L}})?"))
        if kind != "by-nc":        # a base phrase
            out.append((f"cc-{kind}", "cc by", short, short))
    return out


def rules() -> list[Rule]:
    """All rules, the most certain kinds first."""
    signatures = [_rule(a, float(c), k, r) for a, c, k, r in _table(SIGNATURES)]
    names = [*map(tuple, _table(NAMES)), *_creative_commons()]
    identifiers = [_rule(a, 0.99, "spdx", f"spdx {{L}} identifier (?:{i})") for a, _, i, _ in names]
    notices = [_rule(a, 0.95, k, rf"(?:licensed|released|distributed|published|available|provided|covered) {{U}}(?:{n})")
               for a, k, _, n in names]
    bare = [_rule(a, 0.70, k, n) for a, k, _, n in names]
    return signatures + identifiers + notices + bare + [_rule(a, float(c), k, r) for a, c, k, r in _table(REFERENCES)]
