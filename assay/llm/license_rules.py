"""Signature rules for licenses, one per line: label, rank, keyword, pattern.

Patterns are read on a text's words: lower case, one space between words, no punctuation ("apache license version 2 0").
The keyword must be in those words before the pattern is tried at all, so it is text that each match contains. Every
match needs one of STEMS or NAMES in the text.
"""

from __future__ import annotations

#: A text without any of these has no license statement; they are looked for before anything else is done.
STEMS = ("licen", "copyright", "reserved", "domain", "spdx", "warrant", "redistribut", "gpl", "commons", "copyleft")
#: Names of licenses that are statements by themselves, as regexes on the text before its words are lined up.
NAMES = (r"cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by", "wtfpl")

#: Ranks: 4 a version or clause is named, 3 a grant or notice, 2 the name of a license, 1 a general statement.
_RULES = r"""
mit|4|permission is hereby granted|permission is hereby granted free of charge to any person obtaining a copy(?: \S+){0,12} licen\S*
mit|3|under|(?:released|licensed|distributed|available|provided|published) under (?:the )?(?:terms of (?:the )?)?(?:mit|expat) licen[cs]e
mit|3|mit|(?:this|the) (?:software|code|project|library|work|program|file) is (?:licensed )?under (?:the )?mit licen[cs]e
mit|3|mit|licen[cs]ed? mit
mit|3|mit|spdx licen[cs]e identifier mit
mit|2|mit|(?:the )?mit licen[cs]e
mit|2|expat|expat licen[cs]e
mit|2|mit|mit style licen[cs]e
mit|2|x11|mit x11 licen[cs]e
x11|2|x11|x11 licen[cs]e
x11|3|x11|spdx licen[cs]e identifier x11
mit-0|3|mit|spdx licen[cs]e identifier mit 0
mit-0|2|attribution|mit no attribution licen[cs]e
apache-1.0|4|apache|apache (?:software )?licen[cs]e (?:version |v )?1 0
apache-1.1|4|apache|apache (?:software )?licen[cs]e (?:version |v )?1 1
apache-2.0|4|apache|(?:licensed|released|distributed) under (?:the )?(?:terms of (?:the )?)?apache licen[cs]e (?:version |v )?2(?: 0)?
apache-2.0|4|apache|apache (?:software )?licen[cs]e (?:version |v )?2(?: 0)?
apache-2.0|4|apache|spdx licen[cs]e identifier apache 2 0
apache-2.0|4|apache|www apache org licenses license 2 0
apache|3|apache|(?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?apache (?:software )?licen[cs]e
apache|2|apache|apache (?:software )?licen[cs]e
apache|2|apache|asl licen[cs]e from apache
gpl-1.0|4|gpl|gpl (?:version |v )1(?: 0)?
gpl-1.0|4|general public|(?:gnu )?general public licen[cs]e (?:version |v )1(?: 0)?
gpl-2.0|4|general public|(?:licensed|released|distributed) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?general public licen[cs]e (?:version |v )2(?: 0)?
gpl-2.0|4|general public|(?:gnu )?general public licen[cs]e (?:version |v )2(?: 0)?
gpl-2.0|4|gpl|gpl ?(?:version |v ?)?2(?: 0)?
gpl-2.0|4|gpl|spdx licen[cs]e identifier gpl 2 0
gpl-2.0-only|4|gpl|gpl 2 0 only
gpl-2.0-or-later|4|gpl|gpl 2 0 or later
gpl-2.0-or-later|4|general public|(?:gnu )?general public licen[cs]e(?: \S+){0,8} version 2(?: \S+){0,4} (?:or )?(?:\S+ ){0,4}any later version
gpl-3.0|4|general public|(?:licensed|released|distributed) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?general public licen[cs]e (?:version |v )3(?: 0)?
gpl-3.0|4|general public|(?:gnu )?general public licen[cs]e (?:version |v )3(?: 0)?
gpl-3.0|4|gpl|gpl ?(?:version |v ?)?3(?: 0)?
gpl-3.0|4|gpl|spdx licen[cs]e identifier gpl 3 0
gpl-3.0-only|4|gpl|gpl 3 0 only
gpl-3.0-or-later|4|gpl|gpl 3 0 or later
gpl-3.0-or-later|4|general public|(?:gnu )?general public licen[cs]e(?: \S+){0,8} version 3(?: \S+){0,4} (?:or )?(?:\S+ ){0,4}any later version
gpl|3|general public|(?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?general public licen[cs]e
gpl|3|redistribute|redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl|3|gpl|(?:licensed|released|distributed|available) under (?:the )?(?:gnu )?gpl
gpl|3|warranty|without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e
gpl|2|general public|(?:gnu )?general public licen[cs]e
gpl|2|gpl|gnu gpl
gpl|2|gpl|gpl licen[cs]e
lgpl-2.0|4|general public|(?:gnu )?library general public licen[cs]e(?: version 2(?: 0)?)?
lgpl-2.0|4|lgpl|lgpl ?(?:version |v ?)?2 0
lgpl-2.1|4|general public|(?:gnu )?lesser general public licen[cs]e (?:version |v )2 1
lgpl-2.1|4|lgpl|lgpl ?(?:version |v ?)?2 1
lgpl-2.1|4|lgpl|spdx licen[cs]e identifier lgpl 2 1
lgpl-3.0|4|general public|(?:gnu )?lesser general public licen[cs]e (?:version |v )3(?: 0)?
lgpl-3.0|4|lgpl|lgpl ?(?:version |v ?)?3(?: 0)?
lgpl-3.0|4|lgpl|spdx licen[cs]e identifier lgpl 3 0
lgpl|3|lgpl|(?:licensed|released|distributed|available) under (?:the )?(?:gnu )?lgpl
lgpl|2|general public|(?:gnu )?lesser general public licen[cs]e
lgpl|2|lgpl|gnu lgpl
agpl-1.0|4|general public|affero general public licen[cs]e (?:version |v )?1(?: 0)?
agpl-3.0|4|general public|(?:gnu )?affero general public licen[cs]e (?:version |v )3(?: 0)?
agpl-3.0|4|agpl|agpl ?(?:version |v ?)?3(?: 0)?
agpl-3.0|4|agpl|spdx licen[cs]e identifier agpl 3 0
agpl|3|agpl|(?:licensed|released|distributed|available) under (?:the )?(?:gnu )?agpl
agpl|2|general public|(?:gnu )?affero general public licen[cs]e
gfdl-1.1|4|free documentation|(?:gnu )?free documentation licen[cs]e (?:version |v )1 1
gfdl-1.2|4|free documentation|(?:gnu )?free documentation licen[cs]e (?:version |v )1 2
gfdl-1.3|4|free documentation|(?:gnu )?free documentation licen[cs]e (?:version |v )1 3
gfdl|2|free documentation|(?:gnu )?free documentation licen[cs]e
bsd-2-clause|4|bsd|(?:simplified bsd|2 clause bsd|bsd 2 clause) licen[cs]e
bsd-2-clause|4|freebsd|freebsd licen[cs]e
bsd-2-clause|4|bsd|spdx licen[cs]e identifier bsd 2 clause
bsd-3-clause|4|bsd|(?:new bsd|modified bsd|revised bsd|3 clause bsd|bsd 3 clause) licen[cs]e
bsd-3-clause|4|bsd|spdx licen[cs]e identifier bsd 3 clause
bsd-3-clause|3|redistribution|redistribution and use in source and binary forms(?: \S+){0,200} neither the name of
bsd-4-clause|4|bsd|(?:original bsd|4 clause bsd|bsd 4 clause) licen[cs]e
bsd-4-clause|3|advertising|redistribution and use in source and binary forms(?: \S+){0,200} all advertising materials
0bsd|3|bsd|spdx licen[cs]e identifier 0bsd
0bsd|2|bsd|(?:zero clause bsd|0bsd|bsd zero clause) licen[cs]e
bsd|3|redistribution|redistribution and use in source and binary forms with or without modification are permitted
bsd|3|bsd|(?:licensed|released|distributed|available) under (?:the |a )?(?:terms of (?:the )?)?bsd(?: style)? licen[cs]e
bsd|2|bsd|bsd(?: style)? licen[cs]e
mpl-1.0|4|mozilla|mozilla public licen[cs]e (?:version |v )?1 0
mpl-1.1|4|mozilla|mozilla public licen[cs]e (?:version |v )?1 1
mpl-2.0|4|mozilla|mozilla public licen[cs]e (?:version |v )?2(?: 0)?
mpl-2.0|4|mpl|spdx licen[cs]e identifier mpl 2 0
mpl-2.0|3|mozilla|subject to the terms of the mozilla public licen[cs]e
mpl|2|mozilla|mozilla public licen[cs]e
epl-1.0|4|eclipse|eclipse public licen[cs]e (?:version |v )?1(?: 0)?
epl-2.0|4|eclipse|eclipse public licen[cs]e (?:version |v )?2(?: 0)?
epl-2.0|4|epl|spdx licen[cs]e identifier epl 2 0
epl|2|eclipse|eclipse public licen[cs]e
edl-1.0|2|eclipse|eclipse distribution licen[cs]e
cddl-1.0|4|common development|common development and distribution licen[cs]e(?: cddl)? (?:version |v )?1 0
cddl-1.1|4|common development|common development and distribution licen[cs]e(?: cddl)? (?:version |v )?1 1
cddl|2|common development|common development and distribution licen[cs]e
cddl|3|cddl|spdx licen[cs]e identifier cddl 1 [01]
cpl-1.0|2|common public|common public licen[cs]e
cpal-1.0|2|common public|common public attribution licen[cs]e
ipl-1.0|2|ibm|ibm public licen[cs]e
isc|3|isc|(?:licensed|released|distributed|available) under (?:the )?isc licen[cs]e
isc|3|isc|spdx licen[cs]e identifier isc
isc|2|isc|isc licen[cs]e
isc|4|permission to use|permission to use copy modify and or distribute this software for any purpose(?: \S+){0,30} warrant\S*
zlib|3|zlib|spdx licen[cs]e identifier zlib
zlib|2|zlib|zlib(?: libpng)? licen[cs]e
libpng|2|libpng|libpng licen[cs]e
bsl-1.0|4|boost|boost software licen[cs]e (?:version |v )?1 0
bsl-1.0|2|boost|boost software licen[cs]e
bsl-1.0|3|bsl|spdx licen[cs]e identifier bsl 1 0
busl-1.1|2|business|business source licen[cs]e
unlicense|3|unlicense|spdx licen[cs]e identifier unlicense
unlicense|3|unencumbered|free and unencumbered software released into the public domain
unlicense|2|unlicense|(?:the )?unlicense
wtfpl|2|want to public|do what the fuck you want to public licen[cs]e
wtfpl|3|wtfpl|(?:licensed|released) under (?:the )?wtfpl(?: licen[cs]e)?
artistic-1.0|4|artistic|artistic licen[cs]e (?:version |v )?1(?: 0)?
artistic-2.0|4|artistic|artistic licen[cs]e (?:version |v )?2(?: 0)?
artistic|2|artistic|(?:perl )?artistic licen[cs]e
perl|3|perl|under the same terms as perl(?: \S+){0,20} licen\S*
psf-2.0|3|identifier|spdx licen[cs]e identifier (?:psf|python) 2 0
psf-2.0|2|python|python software foundation licen[cs]e
python|2|python|python licen[cs]e
ruby|2|ruby|ruby(?: s)? licen[cs]e
php-3.0|4|php|php licen[cs]e (?:version |v )?3 0
php-3.01|4|php|php licen[cs]e (?:version |v )?3 01
php|2|php|php licen[cs]e
openssl|2|openssl|openssl licen[cs]e
ssleay|2|ssleay|ssleay licen[cs]e
w3c|2|w3c|w3c software(?: notice and)? licen[cs]e
ofl-1.0|4|open font|open font licen[cs]e (?:version |v )?1 0
ofl-1.1|4|open font|open font licen[cs]e (?:version |v )?1 1
ofl|2|open font|(?:sil )?open font licen[cs]e
eupl-1.1|4|european union|european union public licen[cs]e (?:version |v )?1 1
eupl-1.2|4|european union|european union public licen[cs]e (?:version |v )?1 2
eupl|2|european union|european union public licen[cs]e
cecill-2.1|4|cecill|cecill (?:free software )?licen[cs]e(?: agreement)? (?:version |v )?2 1
cecill-b|2|cecill|cecill b(?: free software)? licen[cs]e
cecill-c|2|cecill|cecill c(?: free software)? licen[cs]e
cecill|2|cecill|cecill(?: free software)? licen[cs]e
ms-pl|2|microsoft|microsoft public licen[cs]e
ms-rl|2|microsoft|microsoft reciprocal licen[cs]e
ms-eula|2|microsoft|microsoft software licen[cs]e terms
afl-2.1|4|academic free|academic free licen[cs]e (?:version |v )?2 1
afl-3.0|4|academic free|academic free licen[cs]e (?:version |v )?3 0
afl|2|academic free|academic free licen[cs]e
osl-2.1|4|open software|open software licen[cs]e (?:version |v )?2 1
osl-3.0|4|open software|open software licen[cs]e (?:version |v )?3 0
osl|2|open software|open software licen[cs]e
apsl-2.0|4|apple|apple public source licen[cs]e (?:version |v )?2 0
apsl|2|apple|apple public source licen[cs]e
qpl-1.0|2|q public|q public licen[cs]e
sleepycat|2|sleepycat|sleepycat licen[cs]e
postgresql|2|postgresql|postgresql licen[cs]e
ncsa|2|ncsa|(?:university of illinois )?ncsa open source licen[cs]e
hpnd|2|historical|historical permission notice and disclaimer licen[cs]e
vim|2|vim|vim licen[cs]e
unicode|2|unicode|unicode(?: inc)? licen[cs]e(?: agreement)?
upl-1.0|2|universal permissive|universal permissive licen[cs]e
mulan-psl|2|mulan|mulan permissive software licen[cs]e
lppl-1.3|4|latex|latex project public licen[cs]e (?:version |v )?1 3
lppl|2|latex|latex project public licen[cs]e
nasa-1.3|2|nasa|nasa open source agreement(?: \S+){0,6} licen\S*
npl-1.1|2|netscape|netscape public licen[cs]e
sissl|2|sun industry|sun industry standards source licen[cs]e
sspl-1.0|2|server side|server side public licen[cs]e
elastic-2.0|4|elastic|elastic licen[cs]e (?:version |v )?2(?: 0)?
elastic|2|elastic|elastic licen[cs]e
openldap|2|openldap|openldap public licen[cs]e
zpl-2.1|2|zope|zope public licen[cs]e
odbl-1.0|2|open database|open (?:data commons open )?database licen[cs]e
odc-by-1.0|2|attribution|open data commons attribution licen[cs]e
pddl-1.0|2|dedication|public domain dedication and licen[cs]e
cdla-permissive|2|community data|community data licen[cs]e agreement permissive
cdla-sharing|2|community data|community data licen[cs]e agreement sharing
ogl-uk-3.0|4|open government|open government licen[cs]e (?:version |v )?3(?: 0)?
ogl-uk|2|open government|open government licen[cs]e
openrail|2|rail|(?:creative ml |bigcode )?open ?rail(?: m)? licen[cs]e
llama|2|llama|llama \d(?: \d)? community licen[cs]e(?: agreement)?
cc0-1.0|4|cc0|spdx licen[cs]e identifier cc0 1 0
cc0-1.0|3|cc0|cc0(?: 1 0)? (?:universal )?(?:public domain dedication|licen[cs]e)
cc0-1.0|3|creative commons|creative commons (?:cc0|zero)
cc-by|3|cc by|licensed under (?:the |a )?cc by
cc-by|2|creative commons|creative commons attribution(?: licen[cs]e)?
cc-by-sa|3|cc by sa|licensed under (?:the |a )?cc by sa
cc-by-sa|2|creative commons|creative commons attribution share ?alike(?: licen[cs]e)?
cc-by-nc|3|cc by nc|licensed under (?:the |a )?cc by nc
cc-by-nc|2|creative commons|creative commons attribution non ?commercial(?: licen[cs]e)?
cc-by-nd|3|cc by nd|licensed under (?:the |a )?cc by nd
cc-by-nd|2|creative commons|creative commons attribution no ?deriv(?:s|atives|ative works)(?: licen[cs]e)?
cc-by-nc-sa|3|cc by nc sa|licensed under (?:the |a )?cc by nc sa
cc-by-nc-sa|2|creative commons|creative commons attribution non ?commercial share ?alike(?: licen[cs]e)?
cc-by-nc-nd|3|cc by nc nd|licensed under (?:the |a )?cc by nc nd
cc-by-nc-nd|2|creative commons|creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works)(?: licen[cs]e)?
cc|1|creative commons|creative commons(?: public)? licen[cs]e
cc|1|creativecommons|creativecommons org licenses
public-domain|3|public domain|(?:released|dedicated|placed) (?:in|into|to) the public domain
public-domain|2|public domain|(?:is|are) in the public domain
proprietary|2|proprietary|proprietary and confidential(?: \S+){0,12} licen\S*
proprietary|2|proprietary|proprietary licen[cs]e
commercial|2|commercial|commercial licen[cs]e(?: agreement)?
eula|2|end user|end user licen[cs]e agreement
shareware|1|shareware|shareware licen[cs]e
freeware|1|freeware|freeware licen[cs]e
copyleft|1|copyleft|copyleft
no-warranty|1|warranty|(?:provided )?as is without warranty of any kind
no-warranty|1|warranties|without warranties or conditions of any kind
all-rights-reserved|2|reserved|copyright(?: \S+){0,8} all rights reserved
all-rights-reserved|1|reserved|all rights reserved
some-rights-reserved|1|reserved|some rights reserved
copyright|1|copyright|copyright (?:c )?(?:19|20)\d\d
copyright|1|copyright|copyright c
spdx|1|spdx|spdx licen[cs]e identifier \S+
unknown-license|1|licen|(?:released|licensed|distributed|published) under (?:the |a )?(?:\S+ ){1,4}licen[cs]e
unknown-license|1|see the|see the licen[cs]e file
unknown-license|1|subject to the|subject to the (?:following )?licen[cs]e(?: terms)?
unknown-license|1|licensed|this (?:work|content|file|software|document) is licensed
"""

#: Versions of the Creative Commons licenses, for which each pattern would only repeat.
_CC = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")


def _creative_commons() -> list[tuple[str, int, str, str]]:
    named = [(k, v, f"cc-{k.replace(' ', '-')}-{v.replace(' ', '.')}") for k in _CC for v in _CC_VERSIONS]
    return [
        *((label, 4, f"cc {k} {v}", f"(?:licensed under (?:the |a )?|licen[cs]e )?cc {k} {v}(?: licen[cs]e)?") for k, v, label in named),
        *((label, 4, f"cc {k} {v}", f"spdx licen[cs]e identifier cc {k} {v}") for k, v, label in named),
    ]


def rules() -> list[tuple[str, int, str, str]]:
    """(label, rank, keyword, pattern) of all rules, in order of priority."""
    lines = [line.split("|", 3) for line in _RULES.strip().splitlines()]
    return sorted([*((a, int(b), c, d) for a, b, c, d in lines), *_creative_commons()], key=lambda r: -r[1])
