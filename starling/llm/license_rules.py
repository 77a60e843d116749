"""Signature rules of the license scan, hand-written, in order of priority.

A pattern is matched against a text's words (A-Z in lower case; letters, digits and everything
beyond ASCII), joined by single spaces, between whole words.  So ``GPL-3.0`` reads ``gpl 3 0``.
Each line is ``label: pattern``.  A rule is tried only on texts that hold all words that its
pattern cannot do without (``required_words``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# words too frequent to tell anything: never part of a prefilter
COMMON = frozenset("a an and any as at by for from in is it no not of on or that the this to under use with you your "
                   "0 1 2 3 4 5".split())


@dataclass(frozen=True)
class Rule:
    label: str
    kind: str
    pattern: str

    @property
    def required(self) -> tuple[tuple[str, ...], ...]:
        return required_words(self.pattern)


# kinds in order of priority with the trust put in one detection of the kind; ``base`` are the phrases
# that every scan reports whatever else is found there, so that they need not suppress anything, and
# ``contract`` the ones that the registered query reports in the same way in columns of their own
KINDS = {"tag": 1.0, "text": 0.95, "notice": 0.9, "link": 0.8, "name": 0.7, "clue": 0.3, "base": 1.0, "contract": 1.0}
ALWAYS = ("base", "contract")

BASE = """
mit: the mit license
apache-2: apache license version 2
cc-by-nc: cc by nc
"""

# the phrases whose places the registered query counts, fixed by its contract; looked for beside all
# other rules, never in place of one
CONTRACT = """
mit: under the mit license
apache-2: apache license version 2
cc-by-nc: cc by nc
"""

# machine-readable identifiers
TAGS = """
mit: spdx license identifier mit
mit-0: spdx license identifier mit 0
apache-2: spdx license identifier apache 2 0
apache-1.1: spdx license identifier apache 1 1
bsd-0: spdx license identifier 0bsd
bsd-1: spdx license identifier bsd 1 clause
bsd-2: spdx license identifier bsd 2 clause
bsd-2-patent: spdx license identifier bsd 2 clause patent
bsd-3: spdx license identifier bsd 3 clause
bsd-3-clear: spdx license identifier bsd 3 clause clear
bsd-4: spdx license identifier bsd 4 clause
gpl-1: spdx license identifier gpl 1 0(?: only| or later)?
gpl-2: spdx license identifier gpl 2 0(?: only)?
gpl-2-later: spdx license identifier gpl 2 0 or later
gpl-3: spdx license identifier gpl 3 0(?: only)?
gpl-3-later: spdx license identifier gpl 3 0 or later
lgpl-2: spdx license identifier lgpl 2 0(?: only)?
lgpl-2-later: spdx license identifier lgpl 2 0 or later
lgpl-2.1: spdx license identifier lgpl 2 1(?: only)?
lgpl-2.1-later: spdx license identifier lgpl 2 1 or later
lgpl-3: spdx license identifier lgpl 3 0(?: only)?
lgpl-3-later: spdx license identifier lgpl 3 0 or later
agpl-3: spdx license identifier agpl 3 0(?: only)?
agpl-3-later: spdx license identifier agpl 3 0 or later
gfdl-1.3: spdx license identifier gfdl 1 3(?: only| or later)?
mpl-1.1: spdx license identifier mpl 1 1
mpl-2: spdx license identifier mpl 2 0
epl-1: spdx license identifier epl 1 0
epl-2: spdx license identifier epl 2 0
cddl-1: spdx license identifier cddl 1 0
eupl-1.2: spdx license identifier eupl 1 2
osl-3: spdx license identifier osl 3 0
afl-3: spdx license identifier afl 3 0
artistic-2: spdx license identifier artistic 2 0
isc: spdx license identifier isc
zlib: spdx license identifier zlib
bsl-1: spdx license identifier bsl 1 0
unlicense: spdx license identifier unlicense
wtfpl: spdx license identifier wtfpl
cc0: spdx license identifier cc0 1 0
cc-by: spdx license identifier cc by [1-4] [05]
cc-by-sa: spdx license identifier cc by sa [1-4] [05]
cc-by-nd: spdx license identifier cc by nd [1-4] [05]
cc-by-nc: spdx license identifier cc by nc [1-4] [05]
cc-by-nc-sa: spdx license identifier cc by nc sa [1-4] [05]
cc-by-nc-nd: spdx license identifier cc by nc nd [1-4] [05]
odbl-1: spdx license identifier odbl 1 0
odc-by: spdx license identifier odc by 1 0
pddl: spdx license identifier pddl 1 0
postgresql: spdx license identifier postgresql
python-2: spdx license identifier psf 2 0
ncsa: spdx license identifier ncsa
ms-pl: spdx license identifier ms pl
ms-rl: spdx license identifier ms rl
ofl-1.1: spdx license identifier ofl 1 1
upl-1: spdx license identifier upl 1 0
blue-oak-1: spdx license identifier blueoak 1 0 0
other-spdx: spdx license identifier [a-z0-9]+
"""

# telling sentences of license texts
TEXTS = """
mit: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
bsd-2: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd-2: redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3: neither the name of (?:[a-z0-9]+ ){1,12}nor the names of (?:its|other) contributors may be used to endorse or promote products
bsd-4: all advertising materials mentioning features or use of this software must display the following acknowledge?ment
isc: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd-0: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
zlib: the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib: altered source versions must be plainly marked as such and must not be misrepresented as being the original software
apache-2: licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2: unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2: terms and conditions for use reproduction and distribution 1 definitions
apache-1.1: the end user documentation included with the redistribution if any must include the following acknowledge?ment
gpl: this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl-2: gnu general public license as published by the free software foundation either version 2 of the license
gpl-2: gnu general public license as published by the free software foundation version 2
gpl-3: gnu general public license as published by the free software foundation either version 3 of the license
gpl-3: gnu general public license as published by the free software foundation version 3
gpl: you should have received a copy of the gnu general public license along with this (?:program|software|library|file)
gpl: the licenses for most software are designed to take away your freedom to share and change it
gpl-3: the gnu general public license is a free copyleft license for software and other kinds of works
lgpl: this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl-2.1: gnu lesser general public license as published by the free software foundation either version 2 1 of the license
lgpl-3: gnu lesser general public license as published by the free software foundation either version 3 of the license
lgpl: you should have received a copy of the gnu (?:lesser|library) general public license along with this library
agpl-3: gnu affero general public license as published by the free software foundation either version 3 of the license
agpl-3: you should have received a copy of the gnu affero general public license along with this program
gfdl: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2: this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2: if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1: the contents of this file are subject to the mozilla public license version 1 1
epl-1: the accompanying program is provided under the terms of this eclipse public license
epl-2: this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
cddl-1: the contents of this file are subject to the terms of the common development and distribution license
bsl-1: permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
unlicense: this is free and unencumbered software released into the public domain
unlicense: anyone is free to copy modify publish use compile sell or distribute this software
wtfpl: you just do what the fuck you want to
cc0: to the extent possible under law (?:[a-z0-9]+ ){1,8}has waived all copyright and related or neighboring rights
cc-by: you are free to share copy and redistribute the material in any medium or format for any purpose even commercially
cc-by-sa: if you remix transform or build upon the material you must distribute your contributions under the same license as the original
cc-by-nd: if you remix transform or build upon the material you may not distribute the modified material
cc-by-nc: you may not use the material for commercial purposes
artistic: the intent of this document is to state the conditions under which a package may be copied
ofl-1.1: this font software is licensed under the sil open font license
ofl-1.1: the goals of the open font license are to stimulate worldwide development of collaborative font projects
postgresql: permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
ncsa: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers
openssl: this product includes software developed by the openssl project for use in the openssl toolkit
x11: except as contained in this notice the name of the x consortium shall not be used in advertising
beerware: you can buy me a beer in return
json: the software shall be used for good not evil
"""

# statements that a work is under a license
NOTICES = """
mit: (?:licen[sc]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?mit licen[sc]e
mit: under the terms of the (?:expat|mit) licen[sc]e
apache-2: (?:licen[sc]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?apache (?:software )?licen[sc]e (?:version |v )?2(?: 0)?
apache-2: (?:licen[sc]ed|released|distributed|available) under (?:the )?apache 2(?: 0)?(?: licen[sc]e)?
apache: (?:licen[sc]ed|released|distributed|available) under (?:the )?apache (?:software )?licen[sc]e
bsd: (?:licen[sc]ed|released|distributed|available) under (?:the |a )?(?:terms of the )?bsd(?: style| like)? licen[sc]e
bsd-2: (?:licen[sc]ed|released|distributed|available) under (?:the )?(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd) licen[sc]e
bsd-3: (?:licen[sc]ed|released|distributed|available) under (?:the )?(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd) licen[sc]e
gpl-2: (?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?gnu (?:general public licen[sc]e|gpl) (?:version |v )?2(?: 0)?
gpl-3: (?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?gnu (?:general public licen[sc]e|gpl) (?:version |v )?3(?: 0)?
gpl: (?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?gnu (?:general public licen[sc]e|gpl)
gpl-2: (?:licen[sc]ed|released|distributed|available) under (?:the )?gplv2
gpl-3: (?:licen[sc]ed|released|distributed|available) under (?:the )?gplv3
lgpl: (?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?gnu (?:lesser|library) general public licen[sc]e
lgpl: (?:licen[sc]ed|released|distributed|available) under (?:the )?(?:gnu )?lgpl
agpl-3: (?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?gnu affero general public licen[sc]e(?: version 3| v3)?
mpl-2: (?:licen[sc]ed|released|distributed|available) under (?:the )?mozilla public licen[sc]e (?:version |v )?2(?: 0)?
epl-2: (?:licen[sc]ed|released|distributed|available) under (?:the )?eclipse public licen[sc]e (?:version |v )?2(?: 0)?
isc: (?:licen[sc]ed|released|distributed|available) under (?:the )?isc licen[sc]e
zlib: (?:licen[sc]ed|released|distributed|available) under (?:the )?zlib(?: libpng)? licen[sc]e
bsl-1: (?:licen[sc]ed|released|distributed|available) under (?:the )?boost software licen[sc]e
wtfpl: (?:licen[sc]ed|released|distributed|available) under (?:the )?wtfpl
cc0: (?:licen[sc]ed|released|dedicated|available) under (?:the )?(?:creative commons )?cc0(?: 1 0)?
cc-by: (?:licen[sc]ed|released|published|available) under (?:a |the )?cc by(?: [1-4] [05])?
cc-by-sa: (?:licen[sc]ed|released|published|available) under (?:a |the )?cc by sa(?: [1-4] [05])?
cc-by-nd: (?:licen[sc]ed|released|published|available) under (?:a |the )?cc by nd(?: [1-4] [05])?
cc-by-nc: (?:licen[sc]ed|released|published|available) under (?:a |the )?cc by nc(?: [1-4] [05])?
cc-by-nc-sa: (?:licen[sc]ed|released|published|available) under (?:a |the )?cc by nc sa(?: [1-4] [05])?
cc-by-nc-nd: (?:licen[sc]ed|released|published|available) under (?:a |the )?cc by nc nd(?: [1-4] [05])?
cc: (?:licen[sc]ed|released|published|available) under (?:a |the )?creative commons
dual: dual licen[sc]ed under (?:the )?[a-z0-9]+
dual: available under (?:either|any) of the following licen[sc]es
public-domain: (?:placed|released|dedicated) (?:into|in|to) the public domain
public-domain: this work is in the public domain
proprietary: this software is proprietary and confidential
proprietary: unauthorized copying of this file via any medium is strictly prohibited
proprietary: may not be reproduced or transmitted in any form (?:or by any means )?without (?:the )?prior written permission
non-commercial: for non commercial use only
non-commercial: for personal and non commercial use
same-terms: under the same terms as (?:perl|python|ruby) itself
unknown: (?:licen[sc]ed|released|distributed) under the (?:[a-z0-9]+ ){1,5}public licen[sc]e
unknown: (?:licen[sc]ed|released|distributed) under the (?:[a-z0-9]+ ){1,5}licen[sc]e
"""

# addresses of licenses
LINKS = """
apache-2: apache org licenses license 2 0
mit: opensource org licen[sc]es?(?: php)? mit(?: license)?
bsd-2: opensource org licen[sc]es?(?: php)? bsd 2 clause
bsd-3: opensource org licen[sc]es?(?: php)? bsd 3 clause
bsd-3: opensource org licen[sc]es?(?: php)? bsd license
gpl-2: gnu org licenses (?:old licenses )?gpl 2 0
gpl-3: gnu org licenses gpl 3 0
gpl: gnu org (?:licenses|copyleft) gpl(?: html| txt)?
lgpl-2.1: gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3: gnu org licenses lgpl 3 0
lgpl: gnu org (?:licenses|copyleft) (?:lgpl|lesser)(?: html| txt)?
agpl-3: gnu org licenses agpl(?: 3 0)?
gfdl: gnu org (?:licenses|copyleft) fdl(?: html| txt)?
mpl-1.1: mozilla org mpl mpl 1 1
mpl-2: mozilla org (?:en us )?mpl 2 0
epl-1: eclipse org legal epl v10
epl-2: eclipse org legal epl 2 0
cc-by: creativecommons org licenses by [1-4] [05]
cc-by-sa: creativecommons org licenses by sa [1-4] [05]
cc-by-nd: creativecommons org licenses by nd [1-4] [05]
cc-by-nc: creativecommons org licenses by nc [1-4] [05]
cc-by-nc-sa: creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd: creativecommons org licenses by nc nd [1-4] [05]
cc0: creativecommons org publicdomain zero 1 0
public-domain: creativecommons org publicdomain mark 1 0
unlicense: unlicense org
wtfpl: wtfpl net
bsl-1: boost org license 1 0 txt
artistic-2: perlfoundation org artistic license 2 0
ofl-1.1: scripts sil org ofl
odbl-1: opendatacommons org licenses odbl
odc-by: opendatacommons org licenses by
pddl: opendatacommons org licenses pddl
python-2: python org (?:psf|download) (?:license|releases)
"""

# names of licenses
NAMES = """
mit: mit licen[sc]e
mit: expat licen[sc]e
mit: mit x11 licen[sc]e
mit-0: mit no attribution
x11: x11 licen[sc]e
apache-1: apache (?:software )?licen[sc]e (?:version |v )?1 0
apache-1.1: apache (?:software )?licen[sc]e (?:version |v )?1 1
apache-2: apache (?:software )?licen[sc]e (?:version |v )?2(?: 0)?
apache-2: apache 2 0
apache-2: apache licen[sc]e v2
apache: apache (?:software |public )?licen[sc]e
bsd: bsd(?: style| like| type)? licen[sc]e
bsd: berkeley software distribution licen[sc]e
bsd-0: zero clause bsd(?: licen[sc]e)?
bsd-0: bsd zero clause(?: licen[sc]e)?
bsd-1: bsd (?:1|one) clause(?: licen[sc]e)?
bsd-2: bsd (?:2|two) clause(?: licen[sc]e)?
bsd-2: (?:2|two) clause bsd(?: licen[sc]e)?
bsd-2: simplified bsd licen[sc]e
bsd-2: freebsd licen[sc]e
bsd-3: bsd (?:3|three) clause(?: licen[sc]e)?
bsd-3: (?:3|three) clause bsd(?: licen[sc]e)?
bsd-3: (?:new|modified|revised) bsd licen[sc]e
bsd-4: bsd (?:4|four) clause(?: licen[sc]e)?
bsd-4: (?:original|old) bsd licen[sc]e
gpl: gnu general public licen[sc]e
gpl: gnu gpl
gpl: general public licen[sc]e
gpl-1: gnu general public licen[sc]e (?:version |v )?1(?: 0)?
gpl-2: gnu general public licen[sc]e (?:version |v )?2(?: 0)?
gpl-2: gnu general public licen[sc]e v2
gpl-2: gpl (?:version |v )?2(?: 0)?(?: only)?
gpl-2: gplv2
gpl-2-later: gpl (?:version |v )?2(?: 0)? or (?:any )?later(?: version)?
gpl-2-later: gplv2 or later
gpl-3: gnu general public licen[sc]e (?:version |v )?3(?: 0)?
gpl-3: gnu general public licen[sc]e v3
gpl-3: gpl (?:version |v )?3(?: 0)?(?: only)?
gpl-3: gplv3
gpl-3-later: gpl (?:version |v )?3(?: 0)? or (?:any )?later(?: version)?
gpl-3-later: gplv3 or later
lgpl: gnu (?:lesser|library) general public licen[sc]e
lgpl: gnu lgpl
lgpl-2: library general public licen[sc]e (?:version |v )?2(?: 0)?
lgpl-2.1: lesser general public licen[sc]e (?:version |v )?2 1
lgpl-2.1: lgpl (?:version |v )?2 1
lgpl-2.1: lgplv2 1
lgpl-3: lesser general public licen[sc]e (?:version |v )?3(?: 0)?
lgpl-3: lgpl (?:version |v )?3(?: 0)?
lgpl-3: lgplv3
agpl-3: gnu affero general public licen[sc]e (?:version |v )?3(?: 0)?
agpl-3: agpl (?:version |v )?3(?: 0)?
agpl-3: agplv3
agpl: affero general public licen[sc]e
gfdl: gnu free documentation licen[sc]e
gfdl-1.2: gnu free documentation licen[sc]e (?:version |v )?1 2
gfdl-1.3: gnu free documentation licen[sc]e (?:version |v )?1 3
mpl: mozilla public licen[sc]e
mpl-1.1: mozilla public licen[sc]e (?:version |v )?1 1
mpl-2: mozilla public licen[sc]e (?:version |v )?2(?: 0)?
mpl-2: mpl 2 0
epl: eclipse public licen[sc]e
epl-1: eclipse public licen[sc]e (?:version |v )?1 0
epl-2: eclipse public licen[sc]e (?:version |v )?2 0
cpl-1: common public licen[sc]e(?: version)?(?: 1 0)?
ipl-1: ibm public licen[sc]e
cddl: common development and distribution licen[sc]e
cddl-1: cddl 1 0
eupl: european union public licen[sc]e
eupl-1.2: eupl (?:version |v )?1 2
osl-3: open software licen[sc]e (?:version |v )?3 0
afl-3: academic free licen[sc]e (?:version |v )?3 0
afl: academic free licen[sc]e
artistic: artistic licen[sc]e
artistic-2: artistic licen[sc]e (?:version |v )?2(?: 0)?
isc: isc licen[sc]e
zlib: zlib(?: libpng)? licen[sc]e
libpng: libpng licen[sc]e
bsl-1: boost software licen[sc]e(?: version)?(?: 1 0)?
business-source: business source licen[sc]e(?: 1 1)?
elastic-2: elastic licen[sc]e (?:version )?2(?: 0)?
sspl-1: server side public licen[sc]e
commons-clause: commons clause
unlicense: the unlicense
wtfpl: do what the fuck you want to public licen[sc]e
cc0: cc0(?: 1 0)?(?: universal)?
cc0: creative commons zero
cc-by: cc by [1-4] [05]
cc-by: creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-sa: cc by sa(?: [1-4] [05])?
cc-by-sa: creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nd: cc by nd(?: [1-4] [05])?
cc-by-nd: creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nc: cc by nc(?: [1-4] [05])?
cc-by-nc: creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nc-sa: cc by nc sa(?: [1-4] [05])?
cc-by-nc-sa: creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nc-nd: cc by nc nd(?: [1-4] [05])?
cc-by-nc-nd: creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[sc]e)?
cc: creative commons licen[sc]e
odbl-1: open database licen[sc]e
odbl-1: odbl
odc-by: open data commons attribution licen[sc]e
pddl: public domain dedication and licen[sc]e
ogl: open government licen[sc]e(?: v?[1-3](?: 0)?)?
cdla-permissive: community data license agreement permissive
cdla-sharing: community data license agreement sharing
postgresql: postgresql licen[sc]e
python-2: python software foundation licen[sc]e(?: version 2)?
python-2: psf licen[sc]e
php-3: php licen[sc]e(?: version)?(?: 3 01| 3 0)?
ruby: ruby licen[sc]e
ncsa: university of illinois ncsa open source licen[sc]e
openssl: openssl licen[sc]e
ms-pl: microsoft public licen[sc]e
ms-rl: microsoft reciprocal licen[sc]e
upl-1: universal permissive licen[sc]e
ofl-1.1: sil open font licen[sc]e(?: version)?(?: 1 1)?
ofl-1.1: open font licen[sc]e
hippocratic: hippocratic licen[sc]e
blue-oak-1: blue oak model licen[sc]e
cecill-2.1: cecill (?:version |v )?2 1
cecill: cecill licen[sc]e
mulan-2: mulan psl v2
ecl-2: educational community licen[sc]e
lppl: latex project public licen[sc]e
w3c: w3c software (?:notice and )?licen[sc]e
vim: vim licen[sc]e
curl: curl licen[sc]e
json: json licen[sc]e
beerware: beer ?ware licen[sc]e
unicode: unicode licen[sc]e
openrail: open ?rail(?: [a-z])? licen[sc]e
llama: llama (?:[0-9] )?community license(?: agreement)?
bigscience-rail: bigscience rail licen[sc]e
"""

# mentions that a license is near, or that there is none
CLUES = """
rights-reserved: all rights reserved
rights-reserved: alle rechte vorbehalten
rights-reserved: tous droits réservés
rights-reserved: todos los derechos reservados
public-domain: public domain
unknown: see the license file
unknown: see license txt
unknown: see license for (?:more )?details
unknown: end user licen[sc]e agreement
unknown: licen[sc]e agreement
unknown: open source licen[sc]e
unknown: free software licen[sc]e
unknown: permissive licen[sc]e
unknown: copyleft licen[sc]e
unknown: subject to the terms (?:and conditions )?of the licen[sc]e
"""


def required_words(pattern: str, most: int = 3) -> tuple[tuple[str, ...], ...]:
    """Sets of words of which every match holds one each: the ``most`` sets of the longest words.

    Only words that stand outside of optional parts count; a choice between single words is a set.
    """
    open_part = "\x00"        # what a match may or may not hold; touches the words beside it
    rest = pattern.replace(" ?", open_part)
    group = re.compile(r"\((?:\?:)?([^()]*)\)([?*+]|\{[^}]*\})?")
    while found := group.search(rest):
        choices = found[1].split("|")
        if found[2] is None and all(c.isalnum() or c in "[]" for c in "".join(choices)):
            mark = "\x01".join(choices)
        else:
            before = " " if all(c.startswith(" ") for c in choices) else ""
            after = " " if all(c.endswith(" ") for c in choices) else ""
            mark = before + open_part + after
        rest = rest[:found.start()] + mark + rest[found.end():]
    sets = set()
    for token in rest.split(" "):
        words = {w for choice in token.split("\x01") for w in _spellings(choice)}
        if words and all(w.isalnum() for w in words) and not words & COMMON:
            sets.add(tuple(sorted(words)))
    return tuple(sorted(sets, key=lambda ws: (-min(map(len, ws)), ws))[:most])


def _spellings(word: str) -> list[str]:
    """A word with its choices of single letters, as in ``licen[sc]e``, written out."""
    at = re.search(r"\[([a-z]+)\]", word)
    if not at:
        return [word]
    return [w for c in at[1] for w in _spellings(word[:at.start()] + c + word[at.end():])]


def compiled(contract: str = "") -> tuple[Rule, ...]:
    """All rules in order of priority, and after them the given phrases of a contract."""
    tables = {"tag": TAGS, "text": TEXTS, "notice": NOTICES, "link": LINKS, "name": NAMES, "clue": CLUES, "base": BASE,
              "contract": contract}
    rules = []
    for kind, lines in tables.items():
        for line in lines.strip().splitlines():
            label, pattern = line.split(": ", 1)
            rules.append(Rule(label, kind, pattern))
    return tuple(rules)


RULES = compiled()
# the rules of the registered query
QUERY_RULES = compiled(CONTRACT)
