"""License signatures in order of priority: hand-written expressions over lower-case text.

Each line is ``label | keywords | confidence | expression``.  Every match holds each of the keywords as a word, or one of
its alternatives between slashes.  A blank in an expression stands for any run of white space and comment marks, so
wrapped and commented texts match.
``{id}`` stands around an identifier of an SPDX license expression.
"""

from __future__ import annotations

import re

MARK = "spdx-license-identifier"
#: Signatures of public licenses: identifiers, grants, notices, addresses, statements and names.
TABLE = r"""
agpl | spdx license identifier | 1 | {id}agpl-[13]\.0(?:-only|-or-later|\+)?{/id}
apache | spdx license identifier | 1 | {id}apache-(?:1\.[01]|2\.0)\+?{/id}
artistic | spdx license identifier | 1 | {id}artistic-[12]\.0(?:-perl|-cl8)?{/id}
boost | spdx license identifier | 1 | {id}bsl-1\.0{/id}
bsd | spdx license identifier | 1 | {id}(?:0bsd|bsd-[1-4]-clause(?:-[a-z0-9]+)*){/id}
busl | spdx license identifier | 1 | {id}busl-1\.1{/id}
cc-by | spdx license identifier | 1 | {id}cc-by-[1-4]\.[05]{/id}
cc-by-nc | spdx license identifier | 1 | {id}cc-by-nc(?:-nd|-sa)?-[1-4]\.[05]{/id}
cc-by-nd | spdx license identifier | 1 | {id}cc-by-nd-[1-4]\.[05]{/id}
cc-by-sa | spdx license identifier | 1 | {id}cc-by-sa-[1-4]\.[05]{/id}
cc0 | spdx license identifier | 1 | {id}cc0-1\.0{/id}
cddl | spdx license identifier | 1 | {id}cddl-1\.[01]{/id}
cecill | spdx license identifier | 1 | {id}cecill-(?:1\.[01]|2\.[01]|b|c){/id}
curl | spdx license identifier | 1 | {id}curl{/id}
ecl | spdx license identifier | 1 | {id}ecl-[12]\.0{/id}
elastic | spdx license identifier | 1 | {id}elastic-2\.0{/id}
epl | spdx license identifier | 1 | {id}epl-[12]\.0{/id}
eupl | spdx license identifier | 1 | {id}eupl-1\.[012]{/id}
gfdl | spdx license identifier | 1 | {id}gfdl-1\.[123](?:-invariants|-no-invariants)?(?:-only|-or-later)?{/id}
gpl | spdx license identifier | 1 | {id}gpl-[123]\.0(?:-only|-or-later|\+)?{/id}
hpnd | spdx license identifier | 1 | {id}hpnd(?:-[a-z-]+)?{/id}
isc | spdx license identifier | 1 | {id}isc{/id}
lgpl | spdx license identifier | 1 | {id}lgpl-(?:2\.[01]|3\.0)(?:-only|-or-later|\+)?{/id}
mit | spdx license identifier | 1 | {id}mit(?:-0)?{/id}
mpl | spdx license identifier | 1 | {id}mpl-(?:1\.[01]|2\.0)(?:-no-copyleft-exception)?{/id}
ms-pl | spdx license identifier | 1 | {id}ms-pl{/id}
ms-rl | spdx license identifier | 1 | {id}ms-rl{/id}
mulan | spdx license identifier | 1 | {id}mulanpsl-[12]\.0{/id}
ncsa | spdx license identifier | 1 | {id}ncsa{/id}
odbl | spdx license identifier | 1 | {id}odbl-1\.0{/id}
ofl | spdx license identifier | 1 | {id}ofl-1\.[01](?:-no-rfn|-rfn)?{/id}
openssl | spdx license identifier | 1 | {id}openssl{/id}
osl | spdx license identifier | 1 | {id}osl-(?:[12]\.[01]|3\.0){/id}
php | spdx license identifier | 1 | {id}php-3\.0(?:1)?{/id}
postgresql | spdx license identifier | 1 | {id}postgresql{/id}
psf | spdx license identifier | 1 | {id}(?:psf|python)-2\.0(?:\.1)?{/id}
ruby | spdx license identifier | 1 | {id}ruby{/id}
sspl | spdx license identifier | 1 | {id}sspl-1\.0{/id}
unlicense | spdx license identifier | 1 | {id}unlicense{/id}
upl | spdx license identifier | 1 | {id}upl-1\.0{/id}
vim | spdx license identifier | 1 | {id}vim{/id}
w3c | spdx license identifier | 1 | {id}w3c(?:-19980720|-20150513)?{/id}
wtfpl | spdx license identifier | 1 | {id}wtfpl{/id}
zlib | spdx license identifier | 1 | {id}zlib(?:-acknowledgement)?{/id}
zpl | spdx license identifier | 1 | {id}zpl-[12]\.[01]{/id}
agpl | affero | 0.99 | it under the terms of the gnu affero general public license(?: as published by the free software foundation)?
agpl | affero | 0.98 | gnu affero general public license,? version 3(?:, 19 november 2007)?
agpl | affero | 0.97 | remote network interaction; use with the gnu affero general public license
lgpl | lesser general | 0.99 | it under the terms of the gnu lesser general public license(?: as published by the free software foundation)?
lgpl | library general | 0.99 | it under the terms of the gnu library general public license(?: as published by the free software foundation)?
lgpl | lesser general | 0.98 | gnu lesser general public license,? version (?:2\.1|3)(?:, (?:february 1999|29 june 2007))?
lgpl | library general | 0.98 | gnu library general public license,? version 2(?:, june 1991)?
gpl | general public | 0.99 | it under the terms of the gnu general public license(?: as published by the free software foundation)?
gpl | general public | 0.98 | gnu general public license,? version [123](?:, (?:february 1989|june 1991|29 june 2007))?
gpl | general public | 0.97 | you should have received a copy of the gnu general public license
lgpl | lesser general | 0.97 | you should have received a copy of the gnu lesser general public license
agpl | affero | 0.97 | you should have received a copy of the gnu affero general public license
gpl | verbatim copies | 0.9 | everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed
gpl | free software foundation | 0.9 | under the terms of version [23] of the license,? as published by the free software foundation
gfdl | free documentation | 0.99 | under the terms of the gnu free documentation license, version 1\.[123]
gfdl | invariant sections | 0.95 | with no invariant sections, no front-cover texts,? and no back-cover texts
gpl | classpath | 0.9 | linking this library statically or dynamically with other modules is making a combined work[^.]{0,80}classpath
gpl | runtime library exception | 0.9 | gcc runtime library exception
apache | apache license | 0.99 | licensed under the apache license, version (?:2\.0|1\.1)
apache | in compliance with the license | 0.8 | you may not use this file except in compliance with the license
apache | apache software foundation | 0.95 | licensed to the apache software foundation \(asf\) under one or more contributor license agreements
apache | apache software foundation | 0.9 | this product includes software developed by the apache software foundation
apache | apache license | 0.95 | apache license version 2\.0, january 2004
mit | free of charge | 0.99 | permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
mit | without restriction | 0.9 | to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge
mit | substantial portions | 0.9 | this permission notice shall be included in all copies or substantial portions of the software
x11 | x consortium | 0.95 | except as contained in this notice, the name of the x consortium shall not be used
ncsa | university of illinois | 0.97 | university of illinois/ncsa open source license
json | not evil | 0.99 | the software shall be used for good, not evil
isc | with or without fee | 0.98 | permission to use, copy, modify,(?: and/or| and)? distribute this software for any purpose with or without fee is hereby granted, provided
bsd | with or without fee | 0.95 | permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted\.
hpnd | supporting documentation | 0.9 | both that copyright notice and this permission notice appear in supporting documentation
postgresql | without a written agreement | 0.95 | for any purpose, without fee, and without a written agreement is hereby granted
bsd | source and binary forms | 0.98 | redistribution and use in source and binary forms, with or without modification, are permitted
bsd | endorse or promote | 0.9 | neither the name of [^.]{1,120} nor the names of its contributors may be used to endorse or promote products
bsd | advertising materials | 0.95 | all advertising materials mentioning features or use of this software must display
bsd | binary form must reproduce | 0.9 | redistributions in binary form must reproduce the above copyright notice
zlib | misrepresented | 0.97 | the origin of this software must not be misrepresented; you must not claim that you wrote the original software
zlib | as is | 0.9 | this software is provided 'as-is', without any express or implied warranty
libpng | libpng | 0.95 | this copy of the libpng notices is provided for your convenience
boost | boost software | 0.99 | distributed under the boost software license, version 1\.0
boost | machine executable object code | 0.9 | unless such copies or derivative works are solely in the form of machine-executable object code
mpl | mozilla public | 0.99 | this source code form is subject to the terms of the mozilla public license, v\. ?2\.0
mpl | mozilla public | 0.97 | the contents of this file are subject to the mozilla public license version 1\.[01]
mpl | mpl was not distributed | 0.95 | if a copy of the mpl was not distributed with this file
npl | netscape public | 0.97 | the contents of this file are subject to the netscape public license
epl | eclipse public | 0.98 | made available under the terms of the eclipse public license(?: v\.? ?| version )?[12]?(?:\.0)?
cpl | common public | 0.95 | made available under the terms of the common public license(?: v| version )?1\.0
ipl | ibm public | 0.95 | ibm public license version 1\.0
cddl | common development | 0.98 | the contents of this file are subject to the terms of the common development and distribution license
cddl | common development | 0.9 | common development and distribution license(?: \(cddl\))?(?:,? version 1\.[01])?
eupl | under the eupl | 0.98 | licensed under the eupl
eupl | european union public | 0.98 | european union public licen[sc]e(?: v\.? ?1\.[012])?
apsl | apple public source | 0.95 | apple public source license(?: version [12]\.[012])?
artistic | artistic license | 0.97 | under the terms of (?:either: a\) |the )?artistic license(?: 2\.0)?
artistic | standard version | 0.85 | you may make and give away verbatim copies of the source form of the standard version
gpl | as perl itself | 0.9 | under the same terms as perl itself
psf | python software foundation | 0.97 | python software foundation license(?: version 2)?
psf | beopen python | 0.9 | beopen python open source license agreement version 1
php | php license | 0.97 | this source file is subject to version (?:2\.02|3\.0|3\.01) of the php license
ruby | ruby s | 0.9 | (?:distributed|copyrighted free software)[^.]{0,60}under ruby's licen[sc]e
openssl | openssl project | 0.95 | this product includes software developed by the openssl project for use in the openssl toolkit
openssl | eric young | 0.9 | this product includes cryptographic software written by eric young
sleepycat | sleepycat | 0.95 | (?:the )?sleepycat license
vim | vim license | 0.9 | vim license
curl | curl license | 0.9 | curl license
w3c | w3c software | 0.95 | w3c(?:®)? software(?: and document)? notice and license
unicode | unicode | 0.95 | unicode(?:®)?,? inc\.? license agreement
icu | icu license | 0.95 | icu license(?: - icu 1\.8\.1 and later)?
ijg | independent jpeg | 0.95 | this software is based in part on the work of the independent jpeg group
zpl | zope public | 0.97 | zope public license(?: \(zpl\))?,? version [12]\.[01]
qpl | q public | 0.95 | q public license(?: version)?(?: 1\.0)?
osl | open software license | 0.95 | licensed under the open software license version [123]\.[01]
afl | academic free | 0.95 | (?:licensed under the )?academic free license(?:,? version [123]\.[01])?
rpl | reciprocal public | 0.95 | reciprocal public license(?: 1\.[15])?
cpal | common public attribution | 0.95 | common public attribution license(?: version 1\.0)?
ecl | educational community | 0.97 | licensed under the educational community license,? version [12]\.0
upl | universal permissive | 0.97 | the universal permissive license \(upl\),? version 1\.0
ms-pl | microsoft public | 0.97 | microsoft public license \(ms-pl\)
ms-rl | microsoft reciprocal | 0.97 | microsoft reciprocal license(?: \(ms-rl\))?
cecill | cecill | 0.95 | (?:governed by|licen[sc]ed under) the cecill(?:-[bc])? licen[sc]e
mulan | mulan | 0.95 | licensed under mulan psl v[12]
beerware | license | 0.95 | \bbeer-?ware license
beerware | you can buy beer | 0.95 | you can buy me a beer in return
wtfpl | what the | 0.97 | do what the f[u*]ck you want to(?: public license)?
unlicense | public domain | 0.98 | this is free and unencumbered software released into the public domain
cc0 | creativecommons | 0.97 | creativecommons\.org/publicdomain/zero/1\.0
cc0 | universal | 0.97 | cc0 1\.0 universal(?: public domain dedication)?
cc0 | dedicated | 0.9 | dedicated (?:all copyright|the work|to the public domain)[^.]{0,80}(?:cc0|worldwide)
public-domain | creativecommons | 0.95 | creativecommons\.org/publicdomain/mark/1\.0
cc-by-nc-nd | creativecommons | 0.98 | creativecommons\.org/licenses/by-nc-nd/[1-4]\.[05]
cc-by-nc-sa | creativecommons | 0.98 | creativecommons\.org/licenses/by-nc-sa/[1-4]\.[05]
cc-by-nc | creativecommons | 0.98 | creativecommons\.org/licenses/by-nc/[1-4]\.[05]
cc-by-nd | creativecommons | 0.98 | creativecommons\.org/licenses/by-nd/[1-4]\.[05]
cc-by-sa | creativecommons | 0.98 | creativecommons\.org/licenses/by-sa/[1-4]\.[05]
cc-by | creativecommons | 0.98 | creativecommons\.org/licenses/by/[1-4]\.[05]
cc-by-nc-nd | creative commons | 0.96 | creative commons attribution[ -]+non-?commercial[ -]+no-?deriv(?:ative)?s?(?: works)?
cc-by-nc-sa | creative commons | 0.96 | creative commons attribution[ -]+non-?commercial[ -]+share-?alike
cc-by-nc | creative commons | 0.95 | creative commons attribution[ -]+non-?commercial
cc-by-nd | creative commons | 0.95 | creative commons attribution[ -]+no-?deriv(?:ative)?s?(?: works)?
cc-by-sa | creative commons | 0.95 | creative commons attribution[ -]+share-?alike
cc-by | creative commons | 0.9 | creative commons attribution(?: [1-4]\.[05])?(?: international| unported| generic)?(?: licen[sc]e)?
odbl | open database | 0.97 | open data commons open database license|made available under the open database license
odc-by | open data commons attribution | 0.97 | open data commons attribution license
pddl | public domain dedication | 0.95 | open data commons public domain dedication (?:and|&) license
ofl | open font | 0.98 | this font software is licensed under the sil open font license, version 1\.[01]
ofl | reserved font name | 0.85 | with reserved font name
busl | business source | 0.97 | business source license(?: 1\.1)?
sspl | server side public | 0.98 | server side public license(?:,? version 1)?
elastic | elastic license | 0.95 | elastic license(?: 2\.0)?
commons-clause | commons clause | 0.97 | "?commons clause"? license condition(?: v1\.0)?
polyform | polyform | 0.95 | polyform (?:noncommercial|small business|strict|shield|perimeter|internal use) license
openrail | openrail | 0.95 | (?:creativeml |bigscience |bigcode )?openrail(?:-m|\+\+-m)?(?: license)?
openrail | open rail | 0.95 | (?:creativeml |bigscience |bigcode )?open rail(?:-m|\+\+-m)?(?: license)?
gpl | gnu org licenses | 0.95 | gnu\.org/licenses/(?:old-licenses/)?gpl(?:-[123]\.0)?
lgpl | gnu org licenses | 0.95 | gnu\.org/licenses/(?:old-licenses/)?lgpl(?:-[23]\.[01])?
agpl | gnu org licenses | 0.95 | gnu\.org/licenses/agpl(?:-3\.0)?
gfdl | gnu org licenses | 0.95 | gnu\.org/licenses/fdl(?:-1\.[23])?
apache | apache org licenses | 0.95 | apache\.org/licenses/license-(?:1\.[01]|2\.0)
mpl | mozilla org | 0.95 | mozilla\.org/(?:en-us/)?mpl(?:/[12]\.[01])?
epl | eclipse org | 0.95 | eclipse\.org/(?:legal/epl-v[12]0|org/documents/epl-)
mit | opensource org | 0.95 | opensource\.org/licenses?/mit(?:-license(?:\.php|\.html)?)?
bsd | opensource org | 0.95 | opensource\.org/licenses?/bsd-[123]-clause
apache | opensource org | 0.95 | opensource\.org/licenses?/apache-?2\.0
isc | opensource org | 0.95 | opensource\.org/licenses?/isc
gpl | opensource org | 0.95 | opensource\.org/licenses?/gpl-[23]\.0
boost | boost org | 0.95 | boost\.org/license_1_0
unlicense | unlicense org | 0.95 | unlicense\.org
ofl | scripts sil org | 0.95 | scripts\.sil\.org/ofl
wtfpl | wtfpl net | 0.95 | (?:www\.)?wtfpl\.net
php | php net license | 0.95 | php\.net/license/[23]_0
agpl | under affero/agpl/agplv3/agpl3 | 0.98 | (?:licensed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:affero general public licen[sc]e|agpl(?:[ -]?v?3(?:\.0)?)?(?![\w-]))
lgpl | under public/lgpl/lgplv2/lgplv3/lgpl2/lgpl3 | 0.98 | (?:licensed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl(?:[ -]?v?[23](?:\.[01])?)?(?![\w-]))
gpl | under public/gpl/gplv1/gplv2/gplv3/gpl2/gpl3 | 0.98 | (?:licensed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:general public licen[sc]e|gpl(?:[ -]?v?[123](?:\.0)?)?(?![\w-]))
apache | under apache | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?apache(?:(?: software)? licen[sc]e|[ -]v?[12](?:\.[01])?)?(?![\w-])
artistic | under artistic | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?artistic(?: licen[sc]e|[ -]v?[12](?:\.0)?)?(?![\w-])
boost | under boost/bsl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:boost(?: software licen[sc]e|[ -]v?1(?:\.0)?)?|bsl-1\.0)(?![\w-])
bsd | under bsd/0bsd | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the |an? )?(?:terms of )?(?:the )?(?:(?:new|modified|simplified|[0-4][ -]clause) )?0?bsd(?:-[0-4]-clause)?(?:[ -](?:style )?licen[sc]e)?(?![\w-])
cc-by-sa | under cc by sa | 0.97 | (?:licen[sc]ed|released|distributed|published|available) under (?:the |a )?cc[ -]by[ -]sa(?:[ -][1-4]\.[05])?(?![\w-])
cc-by-nc | under cc by nc | 0.97 | (?:licen[sc]ed|released|distributed|published|available) under (?:the |a )?cc[ -]by[ -]nc(?:[ -](?:sa|nd))?(?:[ -][1-4]\.[05])?(?![\w-])
cc-by | under cc by | 0.96 | (?:licen[sc]ed|released|distributed|published|available) under (?:the |a )?cc[ -]by(?:[ -][1-4]\.[05])?(?![\w-])
cc0 | under cc0 | 0.97 | (?:licen[sc]ed|released|distributed|published|available) under (?:the |a )?cc0(?:[ -]1\.0)?(?![\w-])
cddl | under cddl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?cddl(?:[ -]v?1\.[01])?(?![\w-])
ecl | under ecl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?ecl[ -]v?[12](?:\.0)?(?![\w-])
epl | under eclipse/epl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:eclipse public licen[sc]e|epl)(?:[ -]v?[12](?:\.0)?)?(?![\w-])
eupl | under eupl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?eupl(?:[ -]v?1\.[012])?(?![\w-])
gfdl | under documentation/gfdl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:free documentation licen[sc]e|gfdl(?:[ -]v?1\.[123])?)(?![\w-])
isc | under isc | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the |an? )?(?:terms of )?(?:the )?isc(?:[ -]licen[sc]e)?(?![\w-])
mit | under mit/expat | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the |an? )?(?:terms of )?(?:the )?(?:mit(?:-0)?|expat)(?:[ -](?:style )?licen[sc]e)?(?![\w-])
mpl | under mozilla/mpl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:mozilla public licen[sc]e|mpl(?:[ -]v?[12](?:\.[01])?)?)(?![\w-])
ms-pl | under microsoft/ms | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:microsoft public licen[sc]e|ms-pl)(?![\w-])
odbl | under database/odbl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:open database licen[sc]e|odbl(?:[ -]v?1(?:\.0)?)?)(?![\w-])
ofl | under font/ofl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:sil )?(?:open font licen[sc]e|ofl(?:[ -]v?1\.[01])?)(?![\w-])
osl | under software/osl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:open software licen[sc]e|osl(?:[ -]v?[123](?:\.[01])?)?)(?![\w-])
psf | under psf | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:psf(?:-2\.0)?|psf licen[sc]e)(?![\w-])
unlicense | under unlicense | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?unlicense(?![\w-])
upl | under permissive/upl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:universal permissive licen[sc]e|upl(?:[ -]v?1(?:\.0)?)?)(?![\w-])
wtfpl | under wtfpl | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?wtfpl(?![\w-])
zlib | under zlib | 0.98 | (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?zlib(?:[ -]licen[sc]e)?(?![\w-])
proprietary | proprietary | 0.9 | proprietary and confidential(?:\. unauthorized (?:copying|use))?
proprietary | without the prior written | 0.85 | without the prior written (?:permission|consent) of the (?:copyright (?:owner|holder)|publisher|author)
proprietary | no part of this | 0.9 | no part of this (?:publication|book|work|document) may be reproduced
non-commercial | use only | 0.85 | for (?:personal and )?non-?commercial use only
research-only | research | 0.85 | for (?:academic and |non-?commercial )?research (?:purposes|use) only
public-domain | public domain | 0.9 | (?:placed|released|dedicated) (?:in|into|to) the public domain
public-domain | copyright | 0.85 | no (?:known )?copyright(?: restrictions)?(?: is claimed)?
gpl | gpl | 0.9 | dual[ -]licensed under (?:the )?(?:mit|bsd|apache)[^.]{0,40}gpl
agpl | affero | 0.8 | (?:gnu )?affero general public licen[sc]e
agpl | agpl/agplv1/agplv2/agplv3/agpl1/agpl2/agpl3 | 0.8 | \bagpl(?:v?-?[123](?:\.0)?)?\b
apache | apache | 0.8 | apache(?: software)? licen[sc]e
apache | apache 2 | 0.8 | \bapache-2\.0\b
artistic | artistic | 0.7 | \bartistic licen[sc]e
beerware | beerware | 0.7 | \bbeerware\b
boost | boost | 0.8 | boost software licen[sc]e
bsd | bsd | 0.75 | \b(?:[234]-clause )?bsd(?:-[234]-clause| licen[sc]e)
cc-by-nc | cc | 0.75 | \bcc[ -]by-nc(?:-(?:sa|nd))?\b
cc-by-nd | cc | 0.75 | \bcc[ -]by-nd\b
cc-by-sa | cc | 0.75 | \bcc[ -]by-sa\b
cc-by | cc | 0.7 | \bcc[ -]by\b
cc0 | cc0 | 0.75 | \bcc0(?:-1\.0| 1\.0)?\b
cddl | cddl | 0.7 | \bcddl\b
ecl | educational community | 0.8 | educational community licen[sc]e
epl | eclipse | 0.8 | eclipse public licen[sc]e
eupl | eupl | 0.7 | \beupl\b
gfdl | free documentation | 0.8 | (?:gnu )?free documentation licen[sc]e
gpl | general public | 0.8 | (?:gnu )?general public licen[sc]e
gpl | gpl/gplv1/gplv2/gplv3/gpl1/gpl2/gpl3 | 0.7 | \bgpl(?:v?-?[123](?:\.0)?)?\b
isc | isc | 0.75 | \bisc licen[sc]e
lgpl | lesser general | 0.8 | (?:gnu )?lesser general public licen[sc]e
lgpl | library general | 0.8 | (?:gnu )?library general public licen[sc]e
lgpl | lgpl/lgplv2/lgplv3/lgpl2/lgpl3 | 0.7 | \blgpl(?:v?-?[23](?:\.[01])?)?\b
mit | mit | 0.75 | \bmit licen[sc]e
mpl | mozilla | 0.8 | mozilla public licen[sc]e
ms-pl | microsoft public | 0.8 | microsoft public licen[sc]e
odbl | open database | 0.8 | open database licen[sc]e
ofl | open font | 0.8 | (?:sil )?open font licen[sc]e
osl | open software | 0.75 | open software licen[sc]e
proprietary | all rights reserved | 0.7 | all rights reserved
psf | psf | 0.75 | \bpsf licen[sc]e
public-domain | public domain | 0.7 | public domain
unlicense | unlicense | 0.7 | \bunlicense\b
upl | universal permissive | 0.8 | universal permissive licen[sc]e
wtfpl | wtfpl | 0.7 | \bwtfpl\b
zlib | zlib | 0.75 | \bzlib licen[sc]e
"""
#: White space and comment marks.
_BLANK = r"[\s*#/;]+"
#: An identifier stands on the line that the mark begins.
_ID, _END = r"(?<![\w.-])(?:", rf")(?![\w+-]|\.\w)(?<={MARK}:[^\n]{{0,200}})"


def _expression(written: str) -> str:
    """The written expression with blanks outside of brackets widened and identifiers bounded."""
    cut = re.split(r"(\[[^\]]*\])", written)
    wide = "".join(x if k % 2 else x.replace(" ", _BLANK) for k, x in enumerate(cut))
    return wide.replace("{id}", _ID).replace("{/id}", _END)


def rules() -> list[tuple[int, str, str, str, float]]:
    """(priority, label, keywords, pattern, confidence) of every line."""
    lines = [[x.strip() for x in line.split(" | ", 3)] for line in TABLE.strip().splitlines()]
    return [(k, label, key, _expression(written), float(score)) for k, (label, key, score, written) in enumerate(lines)]
