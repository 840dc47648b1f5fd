"""Signature rules for licence texts, written over lower-case words with one space between them.

A family has a label, the words of its SPDX tag and its name as a regex. Each family gives three rules
(tag, grant, title); notices are rules of their own. A rule's keyword is a literal that every match
holds, and its trigger the shorter literal that decides whether a text is looked at in detail at all.
"""

from __future__ import annotations

from dataclasses import dataclass

# Label | SPDX tag | name | keyword of the name. All in words, without punctuation.
FAMILIES = r"""
afl-3.0 | afl 3 0 | academic free license(?: version| v)?(?: 3 0)? | academic free
agpl-3.0 | agpl 3 0(?: only| or later)? | (?:gnu )?affero general public license(?: version| v)?(?: 3)? | affero
apache-1.0 | apache 1 0 | apache(?: software)? license(?: version| v) 1 0 | apache
apache-1.1 | apache 1 1 | apache(?: software)? license(?: version| v) 1 1 | apache
apache-2.0 | apache 2 0 | apache(?: software)? license(?: version| v)? 2(?: 0)? | apache
apache | apache | apache(?: software)? license | apache
apple-psl | apsl 2 0 | apple public source license(?: version)?(?: 2 0)? | apple public
artistic-1.0 | artistic 1 0 | artistic license(?: version)? 1 0 | artistic
artistic-2.0 | artistic 2 0 | artistic license(?: version)? 2 0 | artistic
beerware | beerware | beer ?ware license(?: revision \d+)? | beer
bittorrent | bittorrent 1 1 | bittorrent open source license(?: version 1 \d)? | bittorrent
bsd-1-clause | bsd 1 clause | (?:1|one) clause bsd license | bsd license
bsd-2-clause | bsd 2 clause | (?:(?:2|two) clause|simplified) bsd license | bsd license
bsd-3-clause | bsd 3 clause | (?:(?:3|three) clause|new|revised|modified) bsd license | bsd license
bsd-4-clause | bsd 4 clause | (?:(?:4|four) clause|original) bsd license | bsd license
bsd | bsd | bsd (?:style )?license | bsd
bsl-1.0 | bsl 1 0 | boost software license(?: version)?(?: 1 0)? | boost
busl-1.1 | busl 1 1 | business source license(?: version)?(?: 1 1)? | business source
cc0-1.0 | cc0 1 0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)? | cc0
cc-by-1.0 | cc by 1 0 | (?:cc by|creative commons attribution)(?: license| generic)? 1 0 | 1 0
cc-by-2.0 | cc by 2 0 | (?:cc by|creative commons attribution)(?: license| generic)? 2 0 | 2 0
cc-by-2.5 | cc by 2 5 | (?:cc by|creative commons attribution)(?: license| generic)? 2 5 | 2 5
cc-by-3.0 | cc by 3 0 | (?:cc by|creative commons attribution)(?: license| unported)? 3 0 | 3 0
cc-by-4.0 | cc by 4 0 | (?:cc by|creative commons attribution)(?: license| international)? 4 0 | 4 0
cc-by-sa-2.0 | cc by sa 2 0 | (?:cc by sa|creative commons attribution sharealike)(?: license)? 2 0 | 2 0
cc-by-sa-3.0 | cc by sa 3 0 | (?:cc by sa|creative commons attribution sharealike)(?: license| unported)? 3 0 | 3 0
cc-by-sa-4.0 | cc by sa 4 0 | (?:cc by sa|creative commons attribution sharealike)(?: license| international)? 4 0 | 4 0
cc-by-nd-3.0 | cc by nd 3 0 | (?:cc by nd|creative commons attribution noderiv(?:s|atives))(?: license)? 3 0 | 3 0
cc-by-nd-4.0 | cc by nd 4 0 | (?:cc by nd|creative commons attribution noderiv(?:s|atives))(?: license)? 4 0 | 4 0
cc-by-nc-2.0 | cc by nc 2 0 | (?:cc by nc|creative commons attribution noncommercial)(?: license)? 2 0 | 2 0
cc-by-nc-3.0 | cc by nc 3 0 | (?:cc by nc|creative commons attribution noncommercial)(?: license)? 3 0 | 3 0
cc-by-nc-4.0 | cc by nc 4 0 | (?:cc by nc|creative commons attribution noncommercial)(?: license| international)? 4 0 | 4 0
cc-by-nc-sa-3.0 | cc by nc sa 3 0 | (?:cc by nc sa|creative commons attribution noncommercial sharealike) 3 0 | 3 0
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | (?:cc by nc sa|creative commons attribution noncommercial sharealike) 4 0 | 4 0
cc-by-nc-nd-3.0 | cc by nc nd 3 0 | (?:cc by nc nd|creative commons attribution noncommercial noderiv(?:s|atives)) 3 0 | 3 0
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | (?:cc by nc nd|creative commons attribution noncommercial noderiv(?:s|atives)) 4 0 | 4 0
cc-by-sa | cc by sa | cc by sa | cc by sa
cc-by-sa | cc by sa | creative commons attribution share ?alike(?: license)? | creative commons attribution
cc-by-nc | cc by nc | cc by nc | cc by nc
cc-by-nc | cc by nc | creative commons attribution non ?commercial(?: license)? | creative commons attribution
cc-by | cc by | cc by | cc by
cc-by | cc by | creative commons attribution(?: license)? | creative commons attribution
cddl-1.0 | cddl 1 [01] | common development and distribution license(?: version| v)?(?: 1 [01])? | common development
cecill-2.1 | cecill 2 1 | cecill (?:free software )?license(?: agreement)?(?: version| v)?(?: 2 1)? | cecill
cpl-1.0 | cpl 1 0 | common public license(?: version)?(?: 1 0)? | common public
curl | curl | curl license | curl
ecl-2.0 | ecl 2 0 | educational community license(?: version)?(?: 2 0)? | educational
epl-1.0 | epl 1 0 | eclipse public license(?: version| v)? 1 0 | eclipse
epl-2.0 | epl 2 0 | eclipse public license(?: version| v)? 2 0 | eclipse
epl | epl | eclipse public license | eclipse
eupl-1.2 | eupl 1 [12] | european union public licen[cs]e(?: version| v)?(?: 1 [12])? | european union
fdl-1.3 | gfdl 1 \d(?: only| or later)? | gnu free documentation license(?: version)?(?: 1 \d)? | documentation license
freetype | ftl | freetype (?:project )?license | freetype
gpl-1.0 | gpl 1 0(?: only| or later)? | (?:gnu )?(?:general public license|gpl)(?: version| v) ?1(?: 0)? | g
gpl-2.0 | gpl 2 0(?: only| or later)? | (?:gnu )?(?:general public license|gpl)(?: version| v) ?2(?: 0)? | g
gpl-3.0 | gpl 3 0(?: only| or later)? | (?:gnu )?(?:general public license|gpl)(?: version| v) ?3(?: 0)? | g
gpl | gpl | gnu general public license|gnu gpl | gnu g
hpnd | hpnd | historical permission notice and disclaimer license | historical permission
icu | icu | (?:icu|unicode) license(?: agreement)? | license
ijg | ijg | independent jpeg group license | jpeg
imagemagick | imagemagick | imagemagick license | imagemagick
intel | intel | intel open source license | intel
ipl-1.0 | ipl 1 0 | ibm public license(?: version)?(?: 1 0)? | ibm
isc | isc | isc license | isc
lgpl-2.0 | lgpl 2 0(?: only| or later)? | (?:gnu )?(?:library general public license|lgpl)(?: version| v) ?2(?: 0)? | l
lgpl-2.1 | lgpl 2 1(?: only| or later)? | (?:gnu )?(?:lesser general public license|lgpl)(?: version| v) ?2 1 | l
lgpl-3.0 | lgpl 3 0(?: only| or later)? | (?:gnu )?(?:lesser general public license|lgpl)(?: version| v) ?3(?: 0)? | l
lgpl | lgpl | (?:gnu )?(?:lesser|library) general public license|gnu lgpl | l
libpng | libpng(?: 2 0)? | (?:lib)?png (?:reference library )?license | png
lppl-1.3 | lppl 1 3[ac]? | latex project public license(?: version)?(?: 1 3[ac]?)? | latex
mit-0 | mit 0 | mit no attribution license | no attribution
mit | mit | (?:mit|expat) license | license
mpl-1.1 | mpl 1 1 | mozilla public license(?: version| v)? 1 1 | mozilla
mpl-2.0 | mpl 2 0 | mozilla public license(?: version| v)? 2 0 | mozilla
mpl | mpl | mozilla public license | mozilla
ms-pl | ms pl | microsoft public license | microsoft
ms-rl | ms rl | microsoft reciprocal license | microsoft
ncsa | ncsa | (?:university of illinois )?ncsa open source license | ncsa
npl-1.1 | npl 1 [01] | netscape public license(?: version)?(?: 1 [01])? | netscape
odbl-1.0 | odbl 1 0 | open (?:data commons open )?database license(?: version)?(?: 1 0)? | database license
ofl-1.1 | ofl 1 1 | (?:sil )?open font license(?: version)?(?: 1 [01])? | open font
openldap | oldap 2 \d | openldap public license(?: version 2 \d)? | openldap
openssl | openssl | openssl license | openssl
osl-3.0 | osl 3 0 | open software license(?: version)?(?: [123] [01])? | open software
php-3.01 | php 3 0(?:1)? | php license(?: version)?(?: 3 01?)? | php
postgresql | postgresql | postgresql license | postgresql
psf-2.0 | psf 2 0 | python software foundation license(?: version)?(?: 2)? | python software
python-2.0 | python 2 0 | python license(?: version)?(?: 2(?: 0)?)? | python
qpl-1.0 | qpl 1 0 | q public license(?: version)?(?: 1 0)? | q public
ruby | ruby | ruby license | ruby
sleepycat | sleepycat | sleepycat license | sleepycat
sspl-1.0 | sspl 1 0 | server side public license(?: version| v)?(?: 1)? | server side
unlicense | unlicense | unlicense | unlicense
upl-1.0 | upl 1 0 | universal permissive license(?: version| v)?(?: 1 0)? | universal permissive
vim | vim | vim license | vim
w3c | w3c | w3c software (?:notice and )?(?:and document )?license | w3c
wtfpl | wtfpl | do what the fuck you want to public license|wtfpl(?: version| v)?(?: 2)? | w
x11 | x11 | x11 license | x11
zlib | zlib | zlib license | zlib
zpl-2.1 | zpl 2 [01] | zope public license(?: version)?(?: 2 [01])? | zope
"""

# Label | words of a notice | keyword | score.
NOTICES = r"""
apache-2.0 | https? (?:www )?apache org licenses license 2 0(?: txt| html)? | apache org | 0.95
gpl | https? (?:www )?gnu org (?:licenses|copyleft) gpl(?: [123] 0)?(?: txt| html)? | gnu org | 0.95
lgpl | https? (?:www )?gnu org (?:licenses|copyleft) lgpl(?: [23] [01])?(?: txt| html)? | gnu org | 0.95
agpl-3.0 | https? (?:www )?gnu org licenses agpl(?: 3 0)?(?: txt| html)? | gnu org | 0.95
mit | https? (?:www )?opensource org licenses mit(?: license)?(?: php)? | opensource org | 0.95
bsd | https? (?:www )?opensource org licenses bsd(?: license| [23] clause)?(?: php)? | opensource org | 0.95
isc | https? (?:www )?opensource org licenses isc(?: license)? | opensource org | 0.95
mpl-2.0 | https? (?:www )?mozilla org (?:en us )?mpl 2 0 | mozilla org | 0.95
mpl | https? (?:www )?mozilla org mpl | mozilla org | 0.9
cc-by | https? creativecommons org licenses by [1234] [05] | creativecommons | 0.95
cc-by-sa | https? creativecommons org licenses by sa [1234] [05] | creativecommons | 0.95
cc-by-nc | https? creativecommons org licenses by nc [1234] [05] | creativecommons | 0.95
cc-by-nd | https? creativecommons org licenses by nd [1234] [05] | creativecommons | 0.95
cc-by-nc-sa | https? creativecommons org licenses by nc sa [1234] [05] | creativecommons | 0.95
cc-by-nc-nd | https? creativecommons org licenses by nc nd [1234] [05] | creativecommons | 0.95
cc0-1.0 | https? creativecommons org publicdomain zero 1 0 | creativecommons | 0.95
mit | permission is hereby granted free of charge to any person obtaining a copy of this software | hereby granted | 0.9
isc | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted | to use copy | 0.9
bsd | redistribution and use in source and binary forms with or without modification are permitted | redistribution and use | 0.9
bsd-3-clause | neither the name of [^ ]+(?: [^ ]+){0,12} may be used to endorse or promote products | to endorse | 0.85
gpl | this (?:program|library) is free software you can redistribute it and or modify it under the terms of the gnu general public license | free software | 0.9
lgpl | this (?:program|library) is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license | free software | 0.9
gpl-2.0-or-later | either version 2 of the license or at your option any later version | any later version | 0.9
gpl-3.0-or-later | either version 3 of the license or at your option any later version | any later version | 0.9
mpl-2.0 | this source code form is subject to the terms of the mozilla public license(?: v)? 2 0 | source code form | 0.95
unlicense | this is free and unencumbered software released into the public domain | unencumbered | 0.95
zlib | this software is provided as is without any express or implied warranty in no event will the authors be held liable | without any express | 0.85
boost | permission is hereby granted free of charge to any person or organization obtaining a copy of the software | or organization | 0.9
public-domain | (?:released|placed|dedicated) (?:in)?to the public domain | public domain | 0.8
public-domain | (?:is|are) in the public domain | public domain | 0.7
proprietary | all rights reserved | rights reserved | 0.5
proprietary | proprietary and confidential | proprietary and | 0.7
copyright | copyright(?: c)?(?: by)? (?:19|20)\d\d(?: (?:19|20)\d\d)? | copyright | 0.4
"""

#: A rule of the first kind outranks one of a later kind over the same words.
KINDS = [
    ("tag", r"spdx license identifier (?:{tag})", "spdx", 1.0),
    ("grant", r"(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?(?:{name})", "under", 0.95),
    ("title", r"(?:{name})", "", 0.8),
]

#: Literals of which every match of every rule holds one. Texts without any are left at the first look.
TRIGGERS = [
    "licen", "spdx", "cc by", "cc0", "creativecommons", "creative commons", "copyright", "public domain", "gpl",
    "hereby granted", "redistribution and", "to endorse", "gnu org", "mozilla org", "opensource org", "apache org",
    "without any express", "rights reserved", "proprietary and", "wtfpl",
]


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    regex: str
    keyword: str
    score: float


def _rows(table: str) -> list[list[str]]:
    # "|" also parts the choices of a name; columns have blanks around it
    return [line.split(" | ") for line in table.strip().splitlines()]


def rules() -> list[Rule]:
    """All rules in the order in which they outrank each other."""
    found = []
    for kind, form, keyword, score in KINDS:
        for label, tag, name, name_keyword in _rows(FAMILIES):
            regex = form.format(tag=tag, name=name)
            found.append(Rule(0, label, regex, keyword or name_keyword, score))
        if kind == "tag":
            found += [Rule(0, label, regex, key, float(s)) for label, regex, key, s in _rows(NOTICES)]
    return [Rule(k, r.label, r.regex, r.keyword, r.score) for k, r in enumerate(found)]
