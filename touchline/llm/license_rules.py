"""Signatures of licences, in order: an earlier rule goes before a later one, an earlier tier before a later tier.

A rule is ``label ; keyword ; pattern``. Patterns read a text's words, lower case, one space apart, and
stand for whole words; a text without the keyword can't match. A line that begins with ``#`` opens a tier.
The first three rules are fixed phrases that are reported at every place.
"""

RULES = r"""
# base
mit        ; mit licen       ; under the mit license
apache-2   ; apache licen    ; apache license version 2
cc-by-nc   ; cc by nc        ; cc by nc

# tag
mit        ; spdx            ; spdx license identifier mit
mit-0      ; spdx            ; spdx license identifier mit 0
apache-2   ; spdx            ; spdx license identifier apache 2 0
apache-1.1 ; spdx            ; spdx license identifier apache 1 1
bsd-2      ; spdx            ; spdx license identifier bsd 2 clause(?: patent)?
bsd-3      ; spdx            ; spdx license identifier bsd 3 clause
bsd-0      ; spdx            ; spdx license identifier 0bsd
gpl-2      ; spdx            ; spdx license identifier gpl 2 0(?: only)?
gpl-2+     ; spdx            ; spdx license identifier gpl 2 0 or later
gpl-3      ; spdx            ; spdx license identifier gpl 3 0(?: only)?
gpl-3+     ; spdx            ; spdx license identifier gpl 3 0 or later
lgpl-2.1   ; spdx            ; spdx license identifier lgpl 2 1(?: only)?
lgpl-2.1+  ; spdx            ; spdx license identifier lgpl 2 1 or later
lgpl-3     ; spdx            ; spdx license identifier lgpl 3 0(?: only)?
lgpl-3+    ; spdx            ; spdx license identifier lgpl 3 0 or later
agpl-3     ; spdx            ; spdx license identifier agpl 3 0(?: only)?
agpl-3+    ; spdx            ; spdx license identifier agpl 3 0 or later
mpl-2      ; spdx            ; spdx license identifier mpl 2 0
epl-2      ; spdx            ; spdx license identifier epl 2 0
epl-1      ; spdx            ; spdx license identifier epl 1 0
isc        ; spdx            ; spdx license identifier isc
zlib       ; spdx            ; spdx license identifier zlib
boost-1    ; spdx            ; spdx license identifier bsl 1 0
unlicense  ; spdx            ; spdx license identifier unlicense
cc0        ; spdx            ; spdx license identifier cc0 1 0
cc-by      ; spdx            ; spdx license identifier cc by [1-4] 0
cc-by-sa   ; spdx            ; spdx license identifier cc by sa [1-4] 0
artistic-2 ; spdx            ; spdx license identifier artistic 2 0
wtfpl      ; spdx            ; spdx license identifier wtfpl
eupl-1.2   ; spdx            ; spdx license identifier eupl 1 2
postgresql ; spdx            ; spdx license identifier postgresql
python-2   ; spdx            ; spdx license identifier (?:psf|python) 2 0
ofl-1.1    ; spdx            ; spdx license identifier ofl 1 1
cddl-1     ; spdx            ; spdx license identifier cddl 1 [01]
blueoak-1  ; spdx            ; spdx license identifier blueoak 1 0 0
upl-1      ; spdx            ; spdx license identifier upl 1 0
osl-3      ; spdx            ; spdx license identifier osl 3 0

# text
mit        ; free of charge  ; permission is hereby granted free of charge to any person obtaining a copy of this software
mit        ; above copyright ; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit        ; without warranty; the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
isc        ; permission to   ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd-0      ; permission to   ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
bsd        ; redistribution  ; redistribution and use in source and binary forms with or without modification are permitted
bsd-3      ; endorse         ; neither the name of(?: [^ ]+){1,12} nor the names of its contributors may be used to endorse or promote products
bsd-3      ; endorse         ; the names? of(?: [^ ]+){1,12} may not be used to endorse or promote products
bsd-4      ; advertising     ; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-2      ; redistributions ; redistributions in binary form must reproduce the above copyright notice
bsd-2      ; redistributions ; redistributions of source code must retain the above copyright notice
apache-2   ; apache          ; licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2   ; apache          ; you may obtain a copy of the license at https? www apache org licenses license 2 0
apache-2   ; distributed on  ; unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-1.1 ; apache          ; this product includes software developed by the apache (?:software foundation|group)
gpl        ; redistribute it ; this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl-2+     ; either version  ; gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3+     ; either version  ; gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2      ; version 2       ; gnu general public license version 2 (?:only )?as published by the free software foundation
gpl-3      ; version 3       ; gnu general public license version 3 (?:only )?as published by the free software foundation
lgpl       ; redistribute it ; this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl-2.1+  ; either version  ; gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3+    ; either version  ; gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3+    ; either version  ; gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl        ; copy of the gnu ; you should have received a copy of the gnu general public license along with this program
lgpl       ; copy of the gnu ; you should have received a copy of the gnu lesser general public license along with this (?:program|library)
agpl       ; copy of the gnu ; you should have received a copy of the gnu affero general public license along with this program
mpl-2      ; mozilla         ; this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1    ; mozilla         ; the contents of this file are subject to the mozilla public license version 1 1
epl-2      ; eclipse         ; this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
epl-1      ; eclipse         ; this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
zlib       ; as is           ; this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib       ; misrepresented  ; the origin of this software must not be misrepresented you must not claim that you wrote the original software
boost-1    ; boost software  ; distributed under the boost software license version 1 0
unlicense  ; unencumbered    ; this is free and unencumbered software released into the public domain
wtfpl      ; what the fuck   ; do what the fuck you want to public license
cc0        ; waived all      ; (?:to the extent possible under law )?(?:[^ ]+ ){0,8}has waived all copyright and related or neighboring rights
cddl-1     ; common develop  ; common development and distribution license (?:cddl )?version 1 [01]
artistic-2 ; artistic        ; the artistic license 2 0
ofl-1.1    ; font software   ; this font software is licensed under the sil open font license version 1 1
postgresql ; permission to   ; permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
upl-1      ; universal perm  ; licensed under the universal permissive license
beerware   ; beer ware       ; the beer ware license
cc-by      ; creativecommons ; https? creativecommons org licenses by [1-4] [05]
cc-by-sa   ; creativecommons ; https? creativecommons org licenses by sa [1-4] [05]
cc-by-nd   ; creativecommons ; https? creativecommons org licenses by nd [1-4] [05]
cc-by-nc   ; creativecommons ; https? creativecommons org licenses by nc [1-4] [05]
cc-by-nc-sa; creativecommons ; https? creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd; creativecommons ; https? creativecommons org licenses by nc nd [1-4] [05]
cc0        ; creativecommons ; https? creativecommons org publicdomain zero 1 0
pd-mark    ; creativecommons ; https? creativecommons org publicdomain mark 1 0
gpl        ; gnu org         ; https? www gnu org licenses gpl(?: [23] 0)?
lgpl       ; gnu org         ; https? www gnu org licenses lgpl(?: [23] [01])?
agpl       ; gnu org         ; https? www gnu org licenses agpl(?: 3 0)?
mit        ; opensource org  ; https? (?:www )?opensource org licenses? mit
bsd-2      ; opensource org  ; https? (?:www )?opensource org licenses? bsd 2 clause
bsd-3      ; opensource org  ; https? (?:www )?opensource org licenses? bsd 3 clause
isc        ; opensource org  ; https? (?:www )?opensource org licenses? isc
mpl-2      ; mozilla org     ; https? (?:www )?mozilla org mpl 2 0

# name
mit        ; mit licen       ; (?:released|licensed|distributed|available|published|provided|covered|shared) under (?:the )?(?:terms of )?(?:the )?mit licen[cs]ed?
mit        ; mit licen       ; (?:the )?mit licen[cs]e(?: mit)?
mit        ; expat           ; (?:the )?expat licen[cs]e
mit        ; licen           ; licen[cs]ed? (?:is )?(?:under )?(?:the )?mit(?: x11)?
mit-0      ; mit no          ; mit no attribution(?: licen[cs]e)?
x11        ; x11             ; (?:the )?(?:mit )?x11 licen[cs]e
apache-2   ; apache          ; (?:the )?apache (?:software )?(?:public )?licen[cs]e (?:v|ver|version )?2(?: 0)?
apache-2   ; apache          ; apache 2(?: 0)? licen[cs]ed?
apache-2   ; apache          ; apache (?:software )?licen[cs]e v2(?: 0)?
apache-2   ; asl             ; asl 2 0
apache-1.1 ; apache          ; (?:the )?apache (?:software )?licen[cs]e (?:v |version )?1 1
apache-1   ; apache          ; (?:the )?apache (?:software )?licen[cs]e (?:v |version )?1 0
bsd-2      ; bsd             ; (?:the )?(?:simplified|freebsd) bsd licen[cs]e
bsd-2      ; bsd             ; bsd 2 clause(?: licen[cs]e)?
bsd-2      ; clause          ; 2 clause bsd(?: licen[cs]e)?
bsd-2      ; clause          ; two clause bsd(?: licen[cs]e)?
bsd-3      ; bsd             ; bsd 3 clause(?: clear)?(?: licen[cs]e)?
bsd-3      ; clause          ; 3 clause bsd(?: licen[cs]e)?
bsd-3      ; clause          ; three clause bsd(?: licen[cs]e)?
bsd-3      ; bsd             ; (?:new|modified|revised) bsd licen[cs]e
bsd-4      ; bsd             ; (?:original|old) bsd licen[cs]e
bsd-4      ; bsd             ; bsd 4 clause(?: licen[cs]e)?
bsd-0      ; 0bsd            ; 0bsd(?: licen[cs]e)?
bsd-0      ; zero clause     ; zero clause bsd(?: licen[cs]e)?
bsd-2      ; netbsd          ; netbsd licen[cs]e
bsd        ; bsd style       ; bsd style licen[cs]ed?
gpl-1+     ; gpl             ; (?:gnu )?gpl (?:v |version )?1(?: 0)? (?:or later|or any later version)
gpl-2+     ; gpl             ; (?:gnu )?gpl ?(?:v|v |version )?2(?: 0)? (?:or later|or any later version|or newer|or greater)
gpl-3+     ; gpl             ; (?:gnu )?gpl ?(?:v|v |version )?3(?: 0)? (?:or later|or any later version|or newer|or greater)
gpl-2      ; gpl             ; (?:gnu )?gpl ?(?:v|v |version )?2(?: 0)?(?: only)?
gpl-3      ; gpl             ; (?:gnu )?gpl ?(?:v|v |version )?3(?: 0)?(?: only)?
gpl-1      ; general public  ; (?:gnu )?general public licen[cs]e (?:\(?gpl )?(?:v|v |version )1(?: 0)?
gpl-2      ; general public  ; (?:gnu )?general public licen[cs]e (?:gpl )?(?:v|v |version )2(?: 0)?
gpl-3      ; general public  ; (?:gnu )?general public licen[cs]e (?:gpl )?(?:v|v |version )3(?: 0)?
gpl-2+     ; general public  ; (?:gnu )?general public licen[cs]e (?:gpl )?(?:v|v |version )2(?: 0)? or (?:later|any later version|newer|\(?at your option\)? any later version)
gpl-3+     ; general public  ; (?:gnu )?general public licen[cs]e (?:gpl )?(?:v|v |version )3(?: 0)? or (?:later|any later version|newer|\(?at your option\)? any later version)
gpl-cp     ; classpath       ; (?:gpl|general public license)(?: [^ ]+){0,4} with (?:the )?classpath exception
lgpl-2     ; lgpl            ; (?:gnu )?lgpl ?(?:v|v |version )?2(?: 0)?
lgpl-2.1   ; lgpl            ; (?:gnu )?lgpl ?(?:v|v |version )?2 1(?: only)?
lgpl-2.1+  ; lgpl            ; (?:gnu )?lgpl ?(?:v|v |version )?2 1 (?:or later|or any later version)
lgpl-3     ; lgpl            ; (?:gnu )?lgpl ?(?:v|v |version )?3(?: 0)?(?: only)?
lgpl-3+    ; lgpl            ; (?:gnu )?lgpl ?(?:v|v |version )?3(?: 0)? (?:or later|or any later version)
lgpl-2.1   ; lesser general  ; (?:gnu )?lesser general public licen[cs]e (?:lgpl )?(?:v|v |version )2 1
lgpl-3     ; lesser general  ; (?:gnu )?lesser general public licen[cs]e (?:lgpl )?(?:v|v |version )3(?: 0)?
lgpl-2     ; library general ; (?:gnu )?library general public licen[cs]e(?: (?:v |version )?2(?: 0)?)?
agpl-3     ; agpl            ; (?:gnu )?agpl ?(?:v|v |version )?3(?: 0)?(?: only)?
agpl-3+    ; agpl            ; (?:gnu )?agpl ?(?:v|v |version )?3(?: 0)? (?:or later|or any later version)
agpl-3     ; affero          ; (?:gnu )?affero general public licen[cs]e (?:agpl )?(?:v|v |version )3(?: 0)?
gfdl       ; free document   ; (?:gnu )?free documentation licen[cs]e(?: (?:v |version )?1 [123])?
gfdl       ; gfdl            ; gfdl(?: 1 [123])?
mpl-1.1    ; mpl             ; mpl (?:v |version )?1 1
mpl-2      ; mpl             ; mpl (?:v |version )?2 0
mpl-1.1    ; mozilla         ; mozilla public licen[cs]e (?:mpl )?(?:v |version )?1 1
mpl-2      ; mozilla         ; mozilla public licen[cs]e (?:mpl )?(?:v |version )?2 0
epl-1      ; eclipse         ; eclipse public licen[cs]e (?:epl )?(?:v|v |version )?1 0
epl-2      ; eclipse         ; eclipse public licen[cs]e (?:epl )?(?:v|v |version )?2 0
edl-1      ; eclipse         ; eclipse distribution licen[cs]e(?: (?:v |version )?1 0)?
cpl-1      ; common public   ; common public licen[cs]e(?: (?:v |version )?1 0)?
cpal-1     ; common public   ; common public attribution licen[cs]e(?: (?:v |version )?1 0)?
cddl-1     ; cddl            ; cddl (?:v |version )?1 [01]
eupl-1.1   ; eupl            ; eupl (?:v |version )?1 1
eupl-1.2   ; eupl            ; eupl (?:v |version )?1 2
eupl       ; european union  ; european union public licen[cs]e(?: (?:v |version )?1 [12])?
isc        ; isc             ; (?:the )?isc licen[cs]e
zlib       ; zlib            ; (?:the )?zlib(?: libpng)? licen[cs]e
libpng     ; libpng          ; (?:the )?libpng licen[cs]e
boost-1    ; boost           ; boost software licen[cs]e(?: (?:v |version )?1 0)?
unlicense  ; unlicense       ; (?:the )?unlicense
wtfpl      ; wtfpl           ; wtfpl(?: (?:v |version )?2)?
artistic-1 ; artistic        ; artistic licen[cs]e (?:v |version )?1 0
artistic-2 ; artistic        ; artistic licen[cs]e (?:v |version )?2 0
perl       ; perl itself     ; under the same terms as perl itself
ruby       ; ruby            ; (?:the )?ruby licen[cs]e
php-3      ; php             ; (?:the )?php licen[cs]e(?: (?:v |version )?3 0[01]?)?
python-2   ; psf             ; (?:the )?psf licen[cs]e(?: agreement)?
python-2   ; python soft     ; python software foundation licen[cs]e(?: (?:v |version )?2)?
openssl    ; openssl         ; (?:the )?openssl licen[cs]e
ssleay     ; ssleay          ; (?:the )?(?:original )?ssleay licen[cs]e
postgresql ; postgresql      ; (?:the )?postgresql licen[cs]e
curl       ; curl            ; (?:the )?curl licen[cs]e
icu        ; icu             ; (?:the )?icu licen[cs]e
unicode    ; unicode         ; unicode (?:data files and software )?licen[cs]e(?: agreement)?
w3c        ; w3c             ; w3c software (?:notice and )?licen[cs]e
ncsa       ; ncsa            ; (?:university of illinois )?ncsa open source licen[cs]e
afl-3      ; academic free   ; academic free licen[cs]e(?: (?:v |version )?[1-3] [01])?
osl-3      ; open software   ; open software licen[cs]e(?: (?:v |version )?[1-3] [01])?
ms-pl      ; microsoft       ; microsoft public licen[cs]e(?: ms pl)?
ms-rl      ; microsoft       ; microsoft reciprocal licen[cs]e(?: ms rl)?
qpl-1      ; public licen    ; q public licen[cs]e(?: (?:v |version )?1 0)?
sleepycat  ; sleepycat       ; (?:the )?sleepycat licen[cs]e
ipl-1      ; ibm public      ; ibm public licen[cs]e(?: (?:v |version )?1 0)?
apsl-2     ; apple public    ; apple public source licen[cs]e(?: (?:v |version )?2(?: 0)?)?
npl-1.1    ; netscape        ; netscape public licen[cs]e(?: (?:v |version )?1 [01])?
spl-1      ; sun public      ; sun public licen[cs]e(?: (?:v |version )?1 0)?
lppl-1.3   ; latex project   ; latex project public licen[cs]e(?: (?:v |version )?1 3[ac]?)?
ofl-1.1    ; open font       ; (?:sil )?open font licen[cs]e(?: (?:v |version )?1 1)?
cecill     ; cecill          ; cecill(?: (?:b|c))?(?: (?:v |version )?[12](?: [01])?)?(?: licen[cs]e)?
vim        ; vim             ; (?:the )?vim licen[cs]e
ftl        ; freetype        ; (?:the )?freetype (?:project )?licen[cs]e
ijg        ; jpeg group      ; independent jpeg group s? ?(?:software|licen[cs]e)
hpnd       ; historical perm ; historical permission notice and disclaimer
sspl-1     ; server side     ; server side public licen[cs]e(?: (?:v |version )?1)?
busl-1.1   ; business source ; business source licen[cs]e(?: (?:v |version )?1 1)?
elastic-2  ; elastic licen   ; elastic licen[cs]e(?: (?:v |version )?2(?: 0)?)?
commons-cl ; commons clause  ; commons clause(?: licen[cs]e condition)?
polyform   ; polyform        ; polyform (?:noncommercial|small business|shield|perimeter|strict|free trial) licen[cs]e
openrail   ; openrail        ; (?:creativeml |bigscience )?openrail(?: m)?(?: licen[cs]e)?
rail       ; responsible ai  ; responsible ai licen[cs]e
llama      ; llama           ; llama (?:[23] (?:[12] )?)?community licen[cs]e(?: agreement)?
odbl-1     ; open database   ; open database licen[cs]e(?: odbl)?
odbl-1     ; odbl            ; odbl(?: (?:v |version )?1 0)?
pddl-1     ; public domain   ; public domain dedication and licen[cs]e(?: pddl)?
odc-by-1   ; open data comm  ; open data commons attribution licen[cs]e
cdla-p     ; community data  ; community data licen[cs]e agreement permissive(?: (?:v |version )?[12] 0)?
cdla-s     ; community data  ; community data licen[cs]e agreement sharing(?: (?:v |version )?1 0)?
ogl-uk     ; open governm    ; open government licen[cs]e(?: (?:v |version )?[123](?: 0)?)?
etalab     ; licence ouverte ; licence ouverte(?: etalab)?(?: (?:v |version )?[12] 0)?
dl-de      ; datenlizenz     ; datenlizenz deutschland(?: (?:namensnennung|zero))?(?: (?:version )?2 0)?
cc-by-nc-sa; cc by           ; cc by nc sa(?: [1-4] [05])?
cc-by-nc-nd; cc by           ; cc by nc nd(?: [1-4] [05])?
cc-by-sa   ; cc by           ; cc by sa(?: [1-4] [05])?
cc-by-nd   ; cc by           ; cc by nd(?: [1-4] [05])?
cc-by-nc   ; cc by           ; cc by nc(?: [1-4] [05])?
cc-by      ; cc by           ; cc by(?: [1-4] [05])?
cc0        ; cc0             ; (?:cc |creative commons )?cc0(?: 1 0)?(?: universal)?
cc0        ; commons zero    ; creative commons zero(?: (?:v1 0 )?universal)?
cc-by-nc-sa; creative comm   ; creative commons (?:licen[cs]e )?attribution non ?commercial share ?alike(?: [1-4] [05])?(?: (?:international|unported|generic))?
cc-by-nc-nd; creative comm   ; creative commons (?:licen[cs]e )?attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?
cc-by-sa   ; creative comm   ; creative commons (?:licen[cs]e )?attribution share ?alike(?: [1-4] [05])?(?: (?:international|unported|generic))?
cc-by-nd   ; creative comm   ; creative commons (?:licen[cs]e )?attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?
cc-by-nc   ; creative comm   ; creative commons (?:licen[cs]e )?attribution non ?commercial(?: [1-4] [05])?(?: (?:international|unported|generic))?
cc-by      ; creative comm   ; creative commons (?:licen[cs]e )?attribution(?: [1-4] [05])?(?: (?:international|unported|generic))?

# family
apache     ; apache          ; (?:the )?apache (?:software |public )?licen[cs]ed?
bsd        ; bsd             ; (?:the )?bsd licen[cs]ed?
gpl        ; general public  ; gnu general public licen[cs]e
gpl        ; gpl             ; (?:gnu )?gpl(?: licen[cs]ed?)?
lgpl       ; lgpl            ; (?:gnu )?lgpl(?: licen[cs]ed?)?
lgpl       ; lesser general  ; (?:gnu )?lesser general public licen[cs]e
agpl       ; agpl            ; (?:gnu )?agpl(?: licen[cs]ed?)?
agpl       ; affero          ; (?:gnu )?affero general public licen[cs]e
mpl        ; mozilla         ; mozilla public licen[cs]e
epl        ; eclipse         ; eclipse public licen[cs]e
cddl       ; common develop  ; common development and distribution licen[cs]e
artistic   ; artistic        ; artistic licen[cs]e
cc         ; creative comm   ; creative commons(?: licen[cs]ed?)?
cc         ; licencia        ; licencia (?:de )?creative commons
cc         ; licence         ; licence creative commons
public-dom ; public domain   ; (?:released|placed|dedicated|is|are) (?:in|into|to) the public domain
public-dom ; public domain   ; public domain(?: work| mark| dedication)?
public-dom ; gemeinfrei      ; gemeinfrei(?:e|es|er|en)?
public-dom ; domaine public  ; (?:dans le )?domaine public
public-dom ; dominio         ; (?:de )?dominio p[uú]blico

# hint
proprietary; all rights      ; all rights reserved
proprietary; alle rechte     ; alle rechte vorbehalten
proprietary; tous droits     ; tous droits r[eé]serv[eé]s
proprietary; derechos        ; todos los derechos reservados
proprietary; proprietary     ; proprietary and confidential
proprietary; confidential    ; confidential and proprietary
proprietary; not be repro    ; may not be reproduced(?: or [^ ]+)?(?: [^ ]+){0,6} without (?:prior |express )?(?:written )?permission
proprietary; end user        ; end user licen[cs]e agreement
unknown    ; licensed under  ; (?:is |are )?licensed under(?: the)?(?: terms of)?(?: [^ ]+){0,4} licen[cs]e
unknown    ; released under  ; released under(?: the)?(?: [^ ]+){1,4} licen[cs]e
unknown    ; permission      ; used (?:with|by) (?:kind )?permission(?: of)?
unknown    ; license file    ; see (?:the )?license file(?: for details)?
unknown    ; copyright       ; copyright (?:c )?(?:19|20)[0-9][0-9]
non-commer ; non commercial  ; (?:for )?non commercial (?:use|purposes)(?: only)?
non-commer ; noncommercial   ; (?:for )?noncommercial (?:use|purposes)(?: only)?
research   ; research        ; (?:for )?research (?:use|purposes) only
"""

#: How sure a detection of each tier is that a licence is meant.
TIERS = {"base": 1.0, "tag": 1.0, "text": 0.95, "name": 0.9, "family": 0.6, "hint": 0.3}


def rules() -> list[tuple[int, int, str, str, str]]:
    """Tier, order, label, keyword and pattern of each rule."""
    found, tier = [], -1
    for line in RULES.splitlines():
        if line.startswith("#"):
            tier += 1
        elif line:
            label, keyword, pattern = (part.strip() for part in line.split(";", 2))
            found.append((tier, len(found), label, keyword, pattern))
    return found
