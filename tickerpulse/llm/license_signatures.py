"""Hand-written license signatures: sentences of license bodies, notices and short identifiers.

Patterns are over a line of lower-case words parted by single blanks, so "BSD-3-Clause" reads
"bsd 3 clause".  Names that are words of their own elsewhere ("mit", "asl", "isc", "psf", "ofl")
count only beside a word that speaks of a license.
"""

# Fixed values: (label, keyword that every match holds, pattern, priority from 1 to 9).
# Sentences of license bodies.
BODIES = [
    ("mit", "the above copyright notice and this permission notice",
     r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies", 9),
    ("mit", "deal in the software without restriction",
     r"to deal in the software without restriction including without limitation the rights", 9),
    ("mit", "the software is provided as is", r"the software is provided as is without warranty of any kind express or implied", 7),
    ("mit-0", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided", 9),
    ("bsd", "redistributions of source code", r"redistributions of source code must retain the above copyright notice", 9),
    ("bsd", "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice", 9),
    ("bsd", "endorse or promote products", r"neither the names? of .{1,120}? (?:may|will) be used to endorse or promote products derived from this software", 9),
    ("bsd", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 9),
    ("bsd", "freebsd project", r"the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies either expressed or implied of the freebsd project", 9),
    ("bsd", "regents of the university", r"copyright (?:c )?[0-9 ]+ the regents of the university of california", 7),
    ("0bsd", "with or without fee is hereby granted", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", 9),
    ("isc", "with or without fee is hereby granted", r"permission to use copy modify (?:and or|and) distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", 9),
    ("hpnd", "without fee is hereby granted", r"permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted", 9),
    ("apache", "you may not use this file except in compliance", r"you may not use this file except in compliance with the license", 8),
    ("apache", "you may obtain a copy of the license at", r"you may obtain a copy of the license at (?:https? )?(?:www )?apache org", 9),
    ("apache", "distributed on an as is basis", r"distributed on an as is basis without warranties or conditions of any kind", 8),
    ("apache", "grant of patent license", r"grant of patent license subject to the terms and conditions of this license", 8),
    ("apache", "apache software foundation", r"licensed to the apache software foundation asf under one or more contributor license agreements", 9),
    ("apache", "product includes software developed", r"this product includes software developed (?:by|at) the apache software foundation", 7),
    ("gpl", "general public license for more details", r"see the gnu general public license for more details", 8),
    ("gpl", "received a copy of the gnu general public", r"you should have received a copy of the gnu general public license along with", 8),
    ("gpl", "everyone is permitted to copy", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", 8),
    ("gpl", "take away your freedom", r"the licenses for most software are designed to take away your freedom to share and change it", 9),
    ("gpl", "free copyleft license", r"the gnu general public license is a free copyleft license for software and other kinds of works", 9),
    ("gpl", "either version", r"either version [123](?: 0)? of the license or at your option any later version", 7),
    ("gpl-exception", "as a special exception", r"as a special exception .{1,160}? give you (?:unlimited )?permission to (?:copy|link)", 6),
    ("gpl-exception", "linking this library", r"linking this library statically or dynamically with other modules", 7),
    ("lgpl", "lesser general public license for more details", r"see the gnu lesser general public license for more details", 9),
    ("lgpl", "gnu library general public license", r"(?:the )?gnu library general public license", 8),
    ("lgpl", "additional permissions listed below", r"incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions listed below", 9),
    ("agpl", "remote network interaction", r"remote network interaction use with the gnu general public license", 9),
    ("agpl", "interacting with it remotely", r"prominently offer all users interacting with it remotely through a computer network", 9),
    ("gfdl", "free documentation license", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 9),
    ("gfdl", "no invariant sections", r"with no invariant sections no front cover texts and no back cover texts", 9),
    ("mpl", "this source code form is subject", r"this source code form is subject to the terms of the mozilla public license", 9),
    ("mpl", "the contents of this file are subject", r"the contents of this file are subject to the mozilla public license", 9),
    ("mpl", "mozilla org mpl", r"obtain one at (?:https? )?(?:www )?mozilla org mpl", 9),
    ("mpl", "incompatible with secondary licenses", r"this source code form is incompatible with secondary licenses", 9),
    ("epl", "accompanying materials are made available", r"this program and the accompanying materials are made available under the terms of the eclipse (?:public|distribution) license", 9),
    ("cpl", "common public license", r"common public license(?: agreement| version)?(?: v?[0-9] [0-9])?", 7),
    ("cddl", "common development and distribution", r"the contents of this file are subject to the terms of the common development and distribution license", 9),
    ("cddl", "opensolaris", r"usr src opensolaris license or (?:https? )?(?:www )?opensolaris org os licensing", 9),
    ("zlib", "origin of this software", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", 9),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such", 9),
    ("libpng", "png reference library", r"the png reference library is supplied as is", 9),
    ("boost", "copy of the software and accompanying documentation", r"obtaining a copy of the software and accompanying documentation covered by this license", 9),
    ("boost", "boost org", r"(?:copy at )?(?:https? )?(?:www )?boost org license 1 0 txt", 8),
    ("unlicense", "released into the public domain", r"this is free and unencumbered software released into the public domain", 9),
    ("unlicense", "unlicense org", r"(?:https? )?(?:www )?unlicense org", 7),
    ("public-domain", "public domain", r"(?:hereby )?(?:placed|released|dedicated|put) (?:in|into|to) the public domain", 7),
    ("public-domain", "disclaims copyright", r"the author disclaims copyright to this source code", 9),
    ("public-domain", "no copyright", r"no copyright is claimed", 6),
    ("blessing", "may you do good", r"may you do good and not evil", 8),
    ("json", "used for good", r"the software shall be used for good not evil", 9),
    ("wtfpl", "you just do", r"you just do what the [^ ]+ you want to", 9),
    ("wtfpl", "public license", r"do what the [^ ]+ you want to public license", 9),
    ("beerware", "beer", r"(?:the )?beer ?ware license", 8),
    ("beerware", "buy me a beer", r"you can buy me a beer in return", 8),
    ("cc0", "waives all of", r"waives all of (?:his or her|their|its) rights to the work worldwide under copyright law", 8),
    ("cc0", "no rights reserved", r"no rights reserved", 5),
    ("cc0", "zero", r"(?:creative commons|cc) zero", 8),
    ("cc-by", "you are free to share", r"you are free to share copy and redistribute the material in any medium or format", 8),
    ("cc-by", "appropriate credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made", 8),
    ("cc-by-sa", "same license as the original", r"you must distribute your contributions under the same license as the original", 8),
    ("cc-by-nc", "commercial purposes", r"you may not use the material for commercial purposes", 8),
    ("cc-by-nd", "distribute the modified material", r"you may not distribute the modified material", 8),
    ("cc", "creativecommons org", r"(?:https? )?(?:www )?creativecommons org licenses (?:by(?: nc)?(?: nd| sa)?)(?: [0-9] [0-9])?", 8),
    ("cc0", "creativecommons org publicdomain", r"creativecommons org publicdomain zero(?: 1 0)?", 8),
    ("ofl", "font software", r"(?:this|the) font software is licensed under the sil open font license", 9),
    ("ofl", "reserved font name", r"with reserved font names? [^ ]+", 8),
    ("ofl", "free to use study modify", r"free to use study modify and redistribute the font", 6),
    ("openssl", "openssl toolkit", r"this product includes software developed by the openssl project for use in the openssl toolkit", 9),
    ("ssleay", "eric young", r"this product includes cryptographic software written by eric young", 9),
    ("php", "php license", r"this source file is subject to version [0-9] [0-9]{1,2} of the php license", 9),
    ("psf", "python software foundation", r"this license agreement is between the python software foundation", 9),
    ("psf", "nonexclusive royalty free", r"psf hereby grants licensee a nonexclusive royalty free world wide license", 9),
    ("artistic", "copyright holder maintains", r"such that the copyright holder maintains some semblance of artistic control", 9),
    ("artistic", "same terms as perl itself", r"(?:you (?:can|may) redistribute it and or modify it )?under the same terms as perl itself", 8),
    ("perl", "perl 5 programming language", r"same terms as the perl 5 programming language", 8),
    ("ruby", "ruby s license", r"(?:distributed |licensed )?under (?:the )?ruby s license", 8),
    ("tcl", "unless explicitly disclaimed", r"the following terms apply to all files associated with the software unless explicitly disclaimed in individual files", 9),
    ("curl", "daniel stenberg", r"copyright (?:c )?[0-9 ]+ daniel stenberg", 6),
    ("x11", "x consortium", r"the name of the x consortium shall not be used in advertising", 9),
    ("ncsa", "deal with the software without restriction", r"to deal with the software without restriction", 9),
    ("ms-pl", "microsoft public license", r"microsoft public license(?: ms pl)?", 8),
    ("ms-rl", "microsoft reciprocal license", r"microsoft reciprocal license(?: ms rl)?", 8),
    ("unicode", "unicode data files", r"unicode data files and software", 7),
    ("upl", "universal permissive license", r"universal permissive license(?: upl)?(?: version)?(?: v?1 0)?", 8),
    ("eupl", "european union public licen", r"european union public licen[cs]e(?: eupl)?(?: version)?(?: v ?)?(?: ?1 [0-2])?", 8),
    ("cecill", "cecill", r"governed by the cecill(?: b| c)? license under french law", 9),
    ("osl", "open software license", r"open software license(?: version)?(?: v?[123] 0)?", 8),
    ("afl", "academic free license", r"(?:licensed under the )?academic free license(?: version)? [0-9] [0-9]", 9),
    ("sspl", "server side public license", r"server side public license(?: sspl)?(?: version| v)?(?: ?1)?", 8),
    ("sspl", "offering the program as a service", r"offering the program as a service", 6),
    ("busl", "business source license", r"business source license(?: version)?(?: 1 [01])?", 8),
    ("busl", "change license", r"change date .{1,80}? change license", 7),
    ("elastic", "elastic license", r"elastic license(?: version)?(?: 2 0)?", 8),
    ("commons-clause", "commons clause", r"commons clause license condition|subject to the commons clause", 8),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|strict|perimeter) license", 8),
    ("odbl", "open database license", r"(?:open data commons )?open database license(?: odbl)?", 8),
    ("odc-by", "open data commons", r"open data commons attribution license", 8),
    ("pddl", "open data commons", r"open data commons public domain dedication (?:and )?license", 8),
    ("opl", "open publication license", r"open publication license(?: v1 0)?", 8),
    ("etalab", "licence ouverte", r"licence ouverte(?: open licence)?(?: etalab)?", 7),
    ("ogl", "open government licence", r"open government licence(?: v?[1-3] 0)?", 8),
    ("ogl-game", "open game license", r"open game license version 1 0a?", 8),
    ("openrail", "rail", r"(?:creativeml )?open ?rail (?:m |s |d )?license", 8),
    ("llama", "llama", r"llama (?:[0-9] )?community license(?: agreement)?", 8),
]

# Notices that claim or withhold rights.
NOTICES = [
    ("reserved", "unauthorized", r"unauthorized (?:copying|use|reproduction|distribution|duplication)(?: or (?:copying|use|reproduction|distribution|duplication))? .{1,60}? (?:strictly )?prohibited", 7),
    ("reserved", "without the prior written permission", r"(?:may be|be) reproduced .{1,120}? without the prior written permission", 8),
    ("reserved", "reproduction in whole or in part", r"reproduction in whole or in part (?:without (?:written )?permission )?is (?:strictly )?(?:prohibited|forbidden)", 8),
    ("reserved", "may not be published broadcast", r"may not be published broadcast rewritten or redistributed", 8),
    ("reserved", "with permission", r"(?:used|reprinted|reproduced) with permission", 5),
    ("reserved", "trade secret", r"(?:contains|contain|constitutes?) (?:proprietary |confidential )?(?:information and )?trade secrets?", 6),
    ("reserved", "alle rechte vorbehalten", r"alle rechte vorbehalten", 7),
    ("reserved", "tous droits", r"tous droits réservés|tous droits reserves", 7),
    ("reserved", "todos los derechos", r"todos los derechos reservados", 7),
    ("reserved", "tutti i diritti", r"tutti i diritti riservati", 7),
    ("reserved", "todos os direitos", r"todos os direitos reservados", 7),
    ("proprietary", "confidential", r"(?:strictly )?confidential and proprietary", 7),
    ("proprietary", "proprietary", r"proprietary (?:software|source code|information) of [^ ]+", 6),
    ("proprietary", "end user license agreement", r"end user license agreement", 7),
    ("proprietary", "internal use only", r"for internal use only", 5),
    ("proprietary", "evaluation", r"for evaluation (?:purposes|use) only", 6),
    ("proprietary", "non transferable", r"limited (?:non exclusive )?non transferable (?:revocable )?license", 7),
    ("proprietary", "reverse engineer", r"(?:may|shall|must) not (?:copy modify )?(?:decompile |disassemble |or )*reverse engineer", 7),
    ("proprietary", "oracle", r"oracle (?:binary code license|technology network license) agreement", 8),
    ("proprietary", "nvidia", r"nvidia software license agreement", 8),
    ("proprietary", "intel", r"intel simplified software license", 8),
    ("proprietary", "apple", r"apple sample code license", 7),
    ("noncommercial", "non commercial", r"(?:for )?non commercial (?:use|purposes)(?: only)?", 5),
    ("noncommercial", "noncommercial", r"(?:for )?noncommercial (?:use|purposes)(?: only)?", 5),
    ("noncommercial", "research purposes only", r"for (?:academic |non commercial )?research purposes only", 6),
    ("noncommercial", "use only", r"for (?:your )?personal (?:and )?(?:non commercial |noncommercial )?use only", 6),
    ("dual", "dual licensed", r"(?:is |are )?dual licensed under", 6),
    ("copyright", "copyright", r"copyright (?:c )?(?:by )?(?:19|20)[0-9]{2} (?:19|20)[0-9]{2}", 3),
    ("copyright", "spdx filecopyrighttext", r"spdx filecopyrighttext [^ ]+", 7),
    ("see-license", "see", r"see (?:the )?(?:license|licence|copying|notice)(?: file| txt| md)? for (?:more |further )?(?:details|information)", 5),
    ("see-license", "license", r"license (?:information )?can be found in the license file", 5),
    ("government", "u s government", r"(?:this )?(?:is a )?work of the u s government", 7),
    ("government", "restricted rights", r"u s government restricted rights", 7),
]

# Short identifiers, most with their versions.
SHORT = [
    ("mit", "mit", r"(?:license|licence|licensed|identifier)(?: under)?(?: the)?(?: is)? mit", 6),
    ("mit", "mit", r"mit (?:licensed|style license|style|no attribution)", 6),
    ("mit", "opensource org licenses mit", r"opensource org licenses mit(?: license(?: php)?)?", 8),
    ("mit-0", "mit", r"mit 0", 6),
    ("apache", "apache", r"apache(?: version| v)? ?[12] [01]", 6),
    ("apache", "apache", r"apache2(?: 0)?|apache 2", 6),
    ("bsd", "bsd", r"bsd 2 clause", 7),
    ("bsd", "bsd", r"bsd 3 clause(?: clear| attribution| lbnl)?", 7),
    ("bsd", "bsd", r"bsd 4 clause(?: uc)?", 7),
    ("bsd", "bsd", r"bsd (?:licensed|licence)|(?:modified|revised|original|free) bsd", 6),
    ("0bsd", "0bsd", r"0bsd", 7),
    ("gpl", "gplv", r"gplv[123](?: or later)?", 7),
    ("gpl", "gpl", r"gpl [123] 0(?: only| or later)", 8),
    ("gpl", "copyleft", r"copyleft (?:license|licence)", 4),
    ("lgpl", "lgplv", r"lgplv[23](?: 1)?(?: or later)?", 8),
    ("lgpl", "lgpl", r"lgpl [23] [01](?: only| or later)", 8),
    ("agpl", "agpl", r"agpl(?: ?v?[13](?: 0)?)?(?: only| or later)?", 7),
    ("agpl", "agplv3", r"agplv3(?: or later)?", 7),
    ("gfdl", "gfdl", r"gfdl(?: 1 [1-3])?", 6),
    ("gfdl", "gnu free documentation", r"gnu free documentation license(?: version)?(?: 1 [1-3])?", 8),
    ("mpl", "mpl", r"mpl [12] [01](?: no copyleft exception)?", 7),
    ("mpl", "mplv2", r"mplv2(?: 0)?", 7),
    ("epl", "epl", r"epl (?:v )?[12] 0", 7),
    ("cddl", "cddl", r"cddl(?: 1 [01])?", 7),
    ("isc", "isc", r"(?:license|licensed|identifier)(?: under)?(?: the)? isc", 6),
    ("zlib", "zlib", r"(?:license|licensed|identifier)(?: under)?(?: the)? zlib", 6),
    ("boost", "bsl", r"bsl 1 0", 6),
    ("busl", "busl", r"busl 1 1", 7),
    ("sspl", "sspl", r"sspl(?: ?v?1(?: 0)?)?", 7),
    ("eupl", "eupl", r"eupl(?: v ?| )?1 [0-2]", 7),
    ("ofl", "ofl", r"ofl 1 [01](?: rfn| no rfn)?", 7),
    ("ofl", "sil open font", r"sil open font license(?: version)?(?: 1 [01])?", 8),
    ("wtfpl", "wtfpl", r"wtfpl", 7),
    ("psf", "psf", r"psf(?: 2 0| license)", 6),
    ("psf", "python software foundation license", r"python software foundation license(?: version)?(?: 2)?", 8),
    ("artistic", "artistic", r"artistic [12] 0(?: perl| cl8)?", 7),
    ("cc-by-nd", "cc by nd", r"cc by nd(?: [1-4] [05])?", 7),
    ("cc-by-nc", "cc by nc sa", r"cc by nc sa(?: [1-4] [05])?", 8),
    ("cc-by-nc", "cc by nc nd", r"cc by nc nd(?: [1-4] [05])?", 8),
    ("cc-by-nd", "creative commons attribution noderiv", r"creative commons attribution noderiv(?:s|atives)(?: [1-4] [05])?", 8),
    ("cc-by-nc", "creative commons attribution noncommercial", r"creative commons attribution noncommercial(?: sharealike| noderiv(?:s|atives))?(?: [1-4] [05])?", 8),
    ("cc-by-nc", "creative commons attribution non commercial", r"creative commons attribution non commercial(?: share ?alike| no ?deriv(?:s|atives))?(?: [1-4] [05])?", 8),
    ("cc-by-nd", "creative commons attribution no deriv", r"creative commons attribution no deriv(?:s|atives)(?: [1-4] [05])?", 8),
    ("cc0", "cc0", r"cc0 1 0 universal", 8),
    ("pddl", "pddl", r"pddl(?: 1 0)?", 6),
    ("odbl", "odbl", r"odbl(?: v?1 0)?", 6),
    ("afl", "afl", r"afl [123] [01]", 6),
    ("osl", "osl", r"osl [123] 0", 6),
    ("ms-pl", "ms pl", r"ms pl", 5),
    ("upl", "upl", r"upl 1 0", 6),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license", 8),
    ("cecill", "cecill", r"cecill(?: [bc])?(?: ?[12] [01])?", 6),
    ("qpl", "q public license", r"q public license(?: version)?(?: 1 0)?", 8),
    ("postgresql", "postgresql licen", r"postgresql licen[cs]e", 7),
    ("openssl", "openssl license", r"openssl license", 7),
    ("php", "php license", r"php license(?: version)?(?: 3 0[01]?)?", 7),
    ("ruby", "ruby license", r"ruby license", 7),
    ("vim", "vim license", r"vim license", 7),
    ("w3c", "w3c software", r"w3c software (?:notice and )?(?:and document )?license", 8),
    ("x11", "x11 license", r"x11 license", 6),
    ("ftl", "freetype", r"freetype (?:project )?license", 8),
    ("ijg", "independent jpeg group", r"based in part on the work of the independent jpeg group", 8),
    ("info-zip", "info zip", r"info zip license", 7),
    ("mulan", "mulan", r"mulan (?:psl|permissive software license)(?: v ?2)?", 8),
    ("rpl", "reciprocal public license", r"reciprocal public license(?: 1 [15])?", 8),
    ("sleepycat", "sleepycat", r"sleepycat (?:public )?license", 8),
    ("apsl", "apple public source", r"apple public source license(?: 2 0)?", 8),
    ("nposl", "non profit open software", r"non profit open software license(?: 3 0)?", 8),
]

SIGNATURES = BODIES + NOTICES + SHORT
