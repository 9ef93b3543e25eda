"""Signatures of licenses, in the order in which they count.

A signature is matched on the words of a text, lower-cased and joined by single
spaces, so `Apache-2.0`, `Apache 2.0` and a line break inside a name look alike. A line
of a table is the label, the words that a text must have before the expression is
tried, and the expression, between bars.

Signatures of a kind further up win over those further down. `BASE` are plain phrases
whose places all count, whatever else is found there.
"""

# The phrases of the base scan.
BASE = """
gpl        | gnu      | gnu general public license
apache     | apache   | apache license
cc-by      | cc       | cc by
mit        | mit      | mit license
"""

# A declaration meant for machines names its license exactly. Label and identifier.
TAGS = """
0bsd                | 0bsd
afl-3.0             | afl 3 0
agpl-1.0            | agpl 1 0(?: only| or later)?
agpl-3.0            | agpl 3 0(?: only| or later)?
apache-1.0          | apache 1 0
apache-1.1          | apache 1 1
apache-2.0          | apache 2 0(?: with llvm exception)?
apsl-2.0            | apsl 2 0
artistic-1.0        | artistic 1 0(?: perl| cl8)?
artistic-2.0        | artistic 2 0
blueoak-1.0.0       | blueoak 1 0 0
bsd-1-clause        | bsd 1 clause
bsd-2-clause        | bsd 2 clause(?: patent| views)?
bsd-3-clause        | bsd 3 clause(?: clear| lbnl)?
bsd-4-clause        | bsd 4 clause(?: uc)?
bsl-1.0             | bsl 1 0
busl-1.1            | busl 1 1
cc-by-1.0           | cc by 1 0
cc-by-2.0           | cc by 2 0
cc-by-2.5           | cc by 2 5
cc-by-3.0           | cc by 3 0
cc-by-4.0           | cc by 4 0
cc-by-nc-3.0        | cc by nc 3 0
cc-by-nc-4.0        | cc by nc 4 0
cc-by-nc-nd-4.0     | cc by nc nd 4 0
cc-by-nc-sa-4.0     | cc by nc sa 4 0
cc-by-nd-4.0        | cc by nd 4 0
cc-by-sa-3.0        | cc by sa 3 0
cc-by-sa-4.0        | cc by sa 4 0
cc0-1.0             | cc0 1 0
cddl-1.0            | cddl 1 0
cddl-1.1            | cddl 1 1
cecill-2.1          | cecill 2 1
cecill-b            | cecill b
cecill-c            | cecill c
cpal-1.0            | cpal 1 0
cpl-1.0             | cpl 1 0
curl                | curl
ecl-2.0             | ecl 2 0
elastic-2.0         | elastic 2 0
epl-1.0             | epl 1 0
epl-2.0             | epl 2 0
eupl-1.1            | eupl 1 1
eupl-1.2            | eupl 1 2
gfdl-1.2            | gfdl 1 2(?: only| or later)?
gfdl-1.3            | gfdl 1 3(?: only| or later)?
gpl-1.0             | gpl 1 0(?: only| or later)?
gpl-2.0             | gpl 2 0(?: only| or later| with classpath exception)?
gpl-3.0             | gpl 3 0(?: only| or later)?
hpnd                | hpnd
icu                 | icu
ijg                 | ijg
isc                 | isc
lgpl-2.0            | lgpl 2 0(?: only| or later)?
lgpl-2.1            | lgpl 2 1(?: only| or later)?
lgpl-3.0            | lgpl 3 0(?: only| or later)?
libpng-2.0          | libpng 2 0
lppl-1.3c           | lppl 1 3c
mit                 | mit
mit-0               | mit 0
mpl-1.1             | mpl 1 1
mpl-2.0             | mpl 2 0(?: no copyleft exception)?
ms-pl               | ms pl
ms-rl               | ms rl
mulanpsl-2.0        | mulanpsl 2 0
ncsa                | ncsa
odbl-1.0            | odbl 1 0
odc-by-1.0          | odc by 1 0
ofl-1.1             | ofl 1 1
openssl             | openssl
osl-3.0             | osl 3 0
pddl-1.0            | pddl 1 0
php-3.01            | php 3 01
postgresql          | postgresql
python-2.0          | python 2 0
qpl-1.0             | qpl 1 0
ruby                | ruby
sleepycat           | sleepycat
sspl-1.0            | sspl 1 0
tcl                 | tcl
unicode-dfs-2016    | unicode dfs 2016
unlicense           | unlicense
upl-1.0             | upl 1 0
vim                 | vim
w3c                 | w3c
wtfpl               | wtfpl
x11                 | x11
zlib                | zlib
zpl-2.1             | zpl 2 1
"""

# The address of a license text.
ADDRESSES = """
agpl-3.0        | gnu         | gnu org licenses agpl(?: 3 0)?(?: html| txt)?
apache-2.0      | apache      | apache org licenses license 2 0(?: txt| html)?
apache-1.1      | apache      | apache org licenses license 1 1(?: txt| html)?
artistic-2.0    | perlfoundation | perlfoundation org artistic[ _]license 2 0
bsl-1.0         | boost       | boost org license 1 0 txt
bsd-2-clause    | opensource  | opensource org licenses? bsd 2 clause
bsd-3-clause    | opensource  | opensource org licenses? bsd (?:3 clause|license(?: php)?)
cc-by-2.0       | creativecommons | creativecommons org licenses by 2 0
cc-by-3.0       | creativecommons | creativecommons org licenses by 3 0
cc-by-4.0       | creativecommons | creativecommons org licenses by 4 0
cc-by-nc-3.0    | creativecommons | creativecommons org licenses by nc 3 0
cc-by-nc-4.0    | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nc-nd-3.0 | creativecommons | creativecommons org licenses by nc nd 3 0
cc-by-nc-nd-4.0 | creativecommons | creativecommons org licenses by nc nd 4 0
cc-by-nc-sa-3.0 | creativecommons | creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-4.0 | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nd-4.0    | creativecommons | creativecommons org licenses by nd 4 0
cc-by-sa-3.0    | creativecommons | creativecommons org licenses by sa 3 0
cc-by-sa-4.0    | creativecommons | creativecommons org licenses by sa 4 0
cc0-1.0         | creativecommons | creativecommons org publicdomain zero 1 0
public-domain   | creativecommons | creativecommons org publicdomain mark 1 0
cddl-1.0        | opensource  | opensource org licenses? cddl(?: 1 0)?
cecill-2.1      | cecill      | cecill info licences licence cecill v2 1
epl-1.0         | eclipse     | eclipse org (?:org documents|legal) epl v10(?: html)?
epl-2.0         | eclipse     | eclipse org (?:org documents|legal) epl (?:v20|2 0)(?: html)?
eupl-1.2        | eupl        | (?:joinup ec europa eu )?(?:[a-z0-9]+ ){0,4}eupl v1 2
gfdl            | gnu         | gnu org (?:copyleft|licenses) fdl(?: 1 3)?(?: html| txt)?
gpl             | gnu         | gnu org (?:copyleft|licenses) gpl(?: html| txt)?
gpl-2.0         | gnu         | gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?
gpl-3.0         | gnu         | gnu org licenses gpl 3 0(?: html| txt)?
isc             | opensource  | opensource org licenses? isc(?: license)?(?: txt)?
lgpl            | gnu         | gnu org (?:copyleft|licenses) (?:lesser|lgpl)(?: html| txt)?
lgpl-2.1        | gnu         | gnu org licenses (?:old licenses )?lgpl 2 1(?: html| txt)?
lgpl-3.0        | gnu         | gnu org licenses lgpl 3 0(?: html| txt)?
mit             | opensource  | opensource org licenses? mit(?: license)?(?: php)?
mpl-1.1         | mozilla     | mozilla org mpl (?:mpl 1 1(?: html| txt)?|1 1)
mpl-2.0         | mozilla     | mozilla org (?:en us )?mpl 2 0
odbl-1.0        | opendatacommons | opendatacommons org licenses odbl(?: 1 0)?
odc-by-1.0      | opendatacommons | opendatacommons org licenses by(?: 1 0)?
ofl-1.1         | sil         | scripts sil org ofl
pddl-1.0        | opendatacommons | opendatacommons org licenses pddl(?: 1 0)?
unlicense       | unlicense   | unlicense org
wtfpl           | wtfpl       | (?:www )?wtfpl net
"""

# A name with its version. `v?` and `version` are optional everywhere.
VERSIONED = """
afl-3.0         | academic    | academic free licen[sc]e (?:version |v )?v?3(?: 0)?
agpl-3.0        | affero      | gnu affero general public licen[sc]e (?:version |v |as published by the free software foundation either version )?v?3(?: 0)?
agpl-3.0        | agpl        | (?:gnu )?agpl ?(?:version |v )?v?3(?: 0)?
apache-1.0      | apache      | apache (?:software )?licen[sc]e (?:version |v )?v?1 0
apache-1.1      | apache      | apache (?:software )?licen[sc]e (?:version |v )?v?1 1
apache-2.0      | apache      | apache (?:software |public )?licen[sc]e (?:version |v )?v?2(?: 0)?
apache-2.0      | apache      | apache v?2 0 licen[sc]ed?
artistic-1.0    | artistic    | artistic licen[sc]e (?:version |v )?v?1(?: 0)?
artistic-2.0    | artistic    | artistic licen[sc]e (?:version |v )?v?2(?: 0)?
bsd-0-clause    | bsd         | (?:zero|0) clause bsd
bsd-2-clause    | bsd         | (?:simplified|freebsd|2 clause|two clause) bsd(?: style)?(?: licen[sc]e)?
bsd-2-clause    | bsd         | bsd (?:2|two) clause(?: licen[sc]e)?
bsd-3-clause    | bsd         | (?:modified|revised|new|3 clause|three clause) bsd(?: style)?(?: licen[sc]e)?
bsd-3-clause    | bsd         | bsd (?:3|three) clause(?: licen[sc]e)?
bsd-4-clause    | bsd         | (?:original|old|4 clause|four clause) bsd(?: style)?(?: licen[sc]e)?
bsd-4-clause    | bsd         | bsd (?:4|four) clause(?: licen[sc]e)?
bsl-1.0         | boost       | boost software licen[sc]e (?:version |v )?v?1 0
busl-1.1        | business    | business source licen[sc]e (?:version |v )?v?1 1
cc-by-2.0       | cc          | cc by (?:v)?2 0
cc-by-2.5       | cc          | cc by (?:v)?2 5
cc-by-3.0       | cc          | cc by (?:v)?3 0
cc-by-4.0       | cc          | cc by (?:v)?4 0
cc-by-nc-2.0    | cc          | cc by nc (?:v)?2 0
cc-by-nc-3.0    | cc          | cc by nc (?:v)?3 0
cc-by-nc-4.0    | cc          | cc by nc (?:v)?4 0
cc-by-nc-nd-3.0 | cc          | cc by nc nd (?:v)?3 0
cc-by-nc-nd-4.0 | cc          | cc by nc nd (?:v)?4 0
cc-by-nc-sa-3.0 | cc          | cc by nc sa (?:v)?3 0
cc-by-nc-sa-4.0 | cc          | cc by nc sa (?:v)?4 0
cc-by-nd-3.0    | cc          | cc by nd (?:v)?3 0
cc-by-nd-4.0    | cc          | cc by nd (?:v)?4 0
cc-by-sa-2.0    | cc          | cc by sa (?:v)?2 0
cc-by-sa-3.0    | cc          | cc by sa (?:v)?3 0
cc-by-sa-4.0    | cc          | cc by sa (?:v)?4 0
cc-by-3.0       | commons     | creative commons attribution 3 0
cc-by-4.0       | commons     | creative commons attribution 4 0
cc-by-nc-3.0    | commons     | creative commons attribution non ?commercial 3 0
cc-by-nc-4.0    | commons     | creative commons attribution non ?commercial 4 0
cc-by-nc-nd-4.0 | commons     | creative commons attribution non ?commercial no ?deriv(?:atives|ative works|s) 4 0
cc-by-nc-sa-4.0 | commons     | creative commons attribution non ?commercial share ?alike 4 0
cc-by-nd-4.0    | commons     | creative commons attribution no ?deriv(?:atives|ative works|s) 4 0
cc-by-sa-3.0    | commons     | creative commons attribution share ?alike 3 0
cc-by-sa-4.0    | commons     | creative commons attribution share ?alike 4 0
cc0-1.0         | cc0         | cc0(?: 1 0)?(?: universal)?
cc0-1.0         | commons     | creative commons zero(?: v?1 0)?
cddl-1.0        | distribution | common development and distribution licen[sc]e (?:version |v )?(?:cddl (?:version )?)?v?1 0
cddl-1.1        | distribution | common development and distribution licen[sc]e (?:version |v )?(?:cddl (?:version )?)?v?1 1
cecill-2.1      | cecill      | cecill (?:free software licen[sc]e agreement )?(?:version |v )?v?2 1
cpl-1.0         | common      | common public licen[sc]e (?:version |v )?v?1 0
elastic-2.0     | elastic     | elastic licen[sc]e (?:version |v )?v?2(?: 0)?
epl-1.0         | eclipse     | eclipse public licen[sc]e (?:version |v )?v?1 0
epl-2.0         | eclipse     | eclipse public licen[sc]e (?:version |v )?v?2 0
eupl-1.1        | european    | european union public licen[sc]e (?:version |v )?v?1 1
eupl-1.2        | european    | european union public licen[sc]e (?:version |v )?v?1 2
gfdl-1.2        | documentation | gnu free documentation licen[sc]e (?:version |v )?v?1 2
gfdl-1.3        | documentation | gnu free documentation licen[sc]e (?:version |v )?v?1 3
gpl-1.0         | gnu         | gnu general public licen[sc]e (?:gpl )?(?:version |v )?v?1(?: 0)?
gpl-2.0         | gnu         | gnu general public licen[sc]e (?:gpl )?(?:version |v )?v?2(?: 0)?
gpl-3.0         | gnu         | gnu general public licen[sc]e (?:gpl )?(?:version |v )?v?3(?: 0)?
gpl-2.0         | gplv2       | (?:gnu )?gplv2
gpl-3.0         | gplv3       | (?:gnu )?gplv3
gpl-2.0         | gpl         | (?:gnu )?gpl (?:version |v )?v?2(?: 0)?
gpl-3.0         | gpl         | (?:gnu )?gpl (?:version |v )?v?3(?: 0)?
gpl-2.0         | general     | version 2 of the (?:gnu )?general public licen[sc]e
gpl-3.0         | general     | version 3 of the (?:gnu )?general public licen[sc]e
gpl-2.0         | general     | gnu general public licen[sc]e as published by the free software foundation (?:either )?version 2
gpl-3.0         | general     | gnu general public licen[sc]e as published by the free software foundation (?:either )?version 3
lgpl-2.0        | library     | gnu library general public licen[sc]e (?:version |v )?v?2(?: 0)?
lgpl-2.1        | lesser      | gnu lesser general public licen[sc]e (?:lgpl )?(?:version |v )?v?2 1
lgpl-3.0        | lesser      | gnu lesser general public licen[sc]e (?:lgpl )?(?:version |v )?v?3(?: 0)?
lgpl-2.1        | lesser      | gnu lesser general public licen[sc]e as published by the free software foundation (?:either )?version 2 1
lgpl-3.0        | lesser      | gnu lesser general public licen[sc]e as published by the free software foundation (?:either )?version 3
lgpl-2.1        | lgplv2      | (?:gnu )?lgplv2(?: 1)?
lgpl-3.0        | lgplv3      | (?:gnu )?lgplv3
lgpl-2.1        | lgpl        | (?:gnu )?lgpl (?:version |v )?v?2 1
lgpl-3.0        | lgpl        | (?:gnu )?lgpl (?:version |v )?v?3(?: 0)?
lppl-1.3c       | latex       | latex project public licen[sc]e (?:version |v )?v?1 3c?
mit-0           | mit         | mit no attribution(?: licen[sc]e)?
mpl-1.0         | mozilla     | mozilla public licen[sc]e (?:mpl )?(?:version |v )?v?1 0
mpl-1.1         | mozilla     | mozilla public licen[sc]e (?:mpl )?(?:version |v )?v?1 1
mpl-2.0         | mozilla     | mozilla public licen[sc]e (?:mpl )?(?:version |v )?v?2(?: 0)?
mpl-2.0         | mpl         | mpl (?:version |v )?v?2 0
mulanpsl-2.0    | mulan       | mulan (?:permissive software licen[sc]e|psl) (?:version |v )?v?2
ofl-1.1         | sil         | sil open font licen[sc]e (?:version |v )?v?1 1
osl-3.0         | open        | open software licen[sc]e (?:version |v )?v?3 0
php-3.01        | php         | php licen[sc]e (?:version |v )?v?3 01
sspl-1.0        | server      | server side public licen[sc]e (?:version |v )?v?1
upl-1.0         | universal   | universal permissive licen[sc]e (?:version |v )?v?1 0
zpl-2.1         | zope        | zope public licen[sc]e (?:version |v )?v?2 1
"""

# Sentences that stand in the license texts themselves.
SENTENCES = """
agpl-3.0     | affero        | remote network interaction use with the gnu general public license
apache-2.0   | apache        | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0   | perpetual     | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license
artistic-2.0 | artistic      | you are always permitted to make arrangements wholly outside of this license
bsd          | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | endorse       | neither the names? of (?:[^ ]+ ){1,12}nor the names of (?:its|their|the) contributors may be used to endorse or promote products
bsd-4-clause | advertising   | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsl-1.0      | machine       | unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor
busl-1.1     | production    | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
cc0-1.0      | affirmer      | affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders
cc-by        | attribution   | this work is licensed under (?:a|the) creative commons attribution
curl         | merchantability | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
epl          | agreement     | the accompanying program is provided under the terms of this eclipse public license
gfdl         | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gpl          | redistribute  | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl          | warranty      | you should have received a copy of the gnu general public license along with
agpl-3.0     | redistribute  | you can redistribute it and or modify it under the terms of the gnu affero general public license
lgpl         | redistribute  | you can redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl         | lesser        | you should have received a copy of the gnu lesser general public license along with
gpl-2.0      | modifications | you must cause the modified files to carry prominent notices stating that you changed the files and the date of any change
gpl-3.0      | conveying     | you may convey a covered work in object code form under the terms of sections 4 and 5
hpnd         | fee           | permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
ijg          | independent   | this software is based in part on the work of the independent jpeg group
isc          | fee           | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
libpng       | png           | the png reference library is supplied as is
mit          | hereby        | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit          | substantial   | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mpl-2.0      | mozilla       | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1      | mozilla       | the contents of this file are subject to the mozilla public license version 1 1
ms-pl        | microsoft     | this license governs use of the accompanying software if you use the software you accept this license
ncsa         | university    | university of illinois ncsa open source license
odbl-1.0     | database      | this (?:[^ ]+ )?database is made available under the open database license
ofl-1.1      | font          | this font software is licensed under the sil open font license
openssl      | openssl       | this product includes software developed by the openssl project
postgresql   | postgresql    | portions copyright (?:c )?1996 [0-9]{4} (?:the )?postgresql global development group
public-domain | domain       | (?:this|the) (?:work|software|file|code|document|text) (?:is|has been|was) (?:released|placed|dedicated|put) (?:in|into|to) the public domain
python-2.0   | psf           | psf hereby grants licensee a nonexclusive royalty free world wide license
unlicense    | unencumbered  | this is free and unencumbered software released into the public domain
vim          | vim           | there are no restrictions on distributing unmodified copies of vim
w3c          | w3c           | this work is being provided by the copyright holders under the following license
wtfpl        | want          | you just do what the fuck you want to
x11          | consortium    | except as contained in this notice the name of the x consortium shall not be used in advertising
zlib         | altered       | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib         | origin        | the origin of this software must not be misrepresented you must not claim that you wrote the original software
proprietary  | rights        | all rights reserved unauthorized (?:copying|use|reproduction|distribution) (?:[^ ]+ ){0,12}(?:is )?strictly prohibited
proprietary  | confidential  | (?:this (?:file|document|software) (?:is|contains) )?proprietary and confidential
"""

# A name alone. What is no license by itself needs the word next to it.
NAMES = """
0bsd         | bsd          | bsd zero clause licen[sc]e
afl          | academic     | academic free licen[sc]e
agpl         | affero       | (?:gnu )?affero general public licen[sc]e
agpl         | agpl         | (?:gnu )?agpl
apache       | apache       | apache (?:software |public )?licen[sc]e
apsl         | apple        | apple public source licen[sc]e
artistic     | artistic     | (?:perl )?artistic licen[sc]e
beerware     | beer         | (?:the )?beer ?ware licen[sc]e
bsd          | bsd          | (?:berkeley )?bsd(?: style)? licen[sc]ed?
bsl          | boost        | boost software licen[sc]e
busl         | business     | business source licen[sc]e
cc-by-nc     | cc           | cc by nc
cc-by-nc-nd  | cc           | cc by nc nd
cc-by-nc-sa  | cc           | cc by nc sa
cc-by-nd     | cc           | cc by nd
cc-by-sa     | cc           | cc by sa
cc-by        | commons      | creative commons attribution(?: licen[sc]e)?
cc-by-sa     | commons      | creative commons attribution share ?alike
cc-by-nc     | commons      | creative commons attribution non ?commercial
cc-by-nd     | commons      | creative commons attribution no ?deriv(?:atives|ative works|s)
creative-commons | commons  | creative commons(?: public)? licen[sc]ed?
cddl         | cddl         | cddl(?: licen[sc]ed?)?
cddl         | distribution | common development and distribution licen[sc]e
cecill       | cecill       | cecill licen[sc]e
cpal         | common       | common public attribution licen[sc]e
cpl          | common       | common public licen[sc]e
ecl          | educational  | educational community licen[sc]e
elastic      | elastic      | elastic licen[sc]e
epl          | eclipse      | eclipse public licen[sc]e
eupl         | eupl         | eupl
eupl         | european     | european union public licen[sc]e
gfdl         | documentation | (?:gnu )?free documentation licen[sc]e
gpl          | general      | gnu general public licen[sc]e
gpl          | gpl          | gnu gpl
gpl          | gpl          | gpl licen[sc]ed?
icu          | icu          | icu licen[sc]e
ijg          | jpeg         | independent jpeg group licen[sc]e
isc          | isc          | isc licen[sc]ed?
lgpl         | lesser       | (?:gnu )?lesser general public licen[sc]e
lgpl         | library      | (?:gnu )?library general public licen[sc]e
lgpl         | lgpl         | (?:gnu )?lgpl
lppl         | latex        | latex project public licen[sc]e
mit          | mit          | mit(?: x11)?(?: style)? licen[sc]ed?
mit          | expat        | expat licen[sc]e
mpl          | mozilla      | mozilla public licen[sc]e
ms-pl        | microsoft    | microsoft public licen[sc]e
ms-rl        | microsoft    | microsoft reciprocal licen[sc]e
mulanpsl     | mulan        | mulan (?:permissive software licen[sc]e|psl)
ncsa         | ncsa         | ncsa (?:open source )?licen[sc]e
odbl         | database     | open (?:data commons open )?database licen[sc]e
ofl          | font         | (?:sil )?open font licen[sc]e
openssl      | openssl      | openssl licen[sc]e
osl          | open         | open software licen[sc]e
pddl         | domain       | public domain dedication and licen[sc]e
php          | php          | php licen[sc]e
postgresql   | postgresql   | postgresql licen[sc]e
python-2.0   | python       | python software foundation licen[sc]e
qpl          | public       | q public licen[sc]e
ruby         | ruby         | ruby licen[sc]e
sleepycat    | sleepycat    | sleepycat licen[sc]e
sspl         | server       | server side public licen[sc]e
unlicense    | unlicense    | (?:the )?unlicense
vim          | vim          | vim licen[sc]e
wtfpl        | wtfpl        | wtfpl
x11          | x11          | x11 licen[sc]e
zlib         | zlib         | zlib(?: libpng)? licen[sc]e
zpl          | zope         | zope public licen[sc]e
"""

# Nothing but the act of licensing; found only where no license is named.
GENERIC = """
all-rights-reserved | reserved | all rights reserved
see-license         | license  | see (?:the )?(?:accompanying )?licen[sc]e(?: file| txt| md)? (?:for|file|in) (?:[^ ]+ ){0,4}(?:details|information|terms|root|directory)
unknown-license     | under    | (?:licen[sc]ed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:an? |the |this )?(?:[a-z0-9]+ ){1,4}?licen[sc]e
unknown-license     | terms    | terms and conditions of (?:the|this) licen[sc]e
public-domain       | domain   | (?:in|into) the public domain
"""
