"""Signatures of license texts: wording that stands in one license (or family) and hardly anywhere else.

Fixed values: each row is the label, the kind, a run of words that every spelling
holds (the prefilter's keyword) and a regex over normalised words (lower-cased,
one space between them; apostrophes and hyphens part words). ``notice`` is a
header that puts a work under a license, ``wording`` is a clause of the license
itself, ``disclaimer`` a warranty paragraph that a family of licenses shares.
Order is priority: rows for a version come before those for the family.
"""

GAP = r"(?: [^ ]+){1,8}"  # a name or a year that the text leaves open

SIGNATURES = (
    # GNU headers
    ("agpl-3.0", "notice", "affero general public license as published", r"(?:it under the terms of )?the gnu affero general public license as published by the free software foundation(?: either)? version 3"),
    ("agpl-3.0", "notice", "copy of the gnu affero", r"you should have received a copy of the gnu affero general public license"),
    ("lgpl-3.0", "notice", "lesser general public license as published", r"the gnu lesser general public license as published by the free software foundation(?: either)? version 3"),
    ("lgpl-2.1", "notice", "lesser general public license as published", r"the gnu lesser general public license as published by the free software foundation(?: either)? version 2 1"),
    ("lgpl-2.0", "notice", "library general public license as published", r"the gnu library general public license as published by the free software foundation(?: either)? version 2"),
    ("lgpl-2.1", "notice", "copy of the gnu lesser", r"you should have received a copy of the gnu lesser general public license along with this library"),
    ("lgpl-2.0", "notice", "copy of the gnu library", r"you should have received a copy of the gnu library general public license"),
    ("gpl-3.0", "notice", "gnu general public license as published", r"the gnu general public license as published by the free software foundation(?: either)? version 3"),
    ("gpl-2.0", "notice", "gnu general public license as published", r"the gnu general public license as published by the free software foundation(?: either)? version 2"),
    ("gpl-3.0", "notice", "see http", r"you should have received a copy of the gnu general public license along with this program if not see https? www gnu org licenses"),
    ("gpl-2.0", "notice", "51 franklin", r"write to the free software foundation inc 51 franklin st(?:reet)?"),
    ("gpl-2.0", "notice", "59 temple place", r"write to the free software foundation inc 59 temple place"),
    ("gfdl", "notice", "under the terms of the gnu free documentation", r"copy distribute and or modify this document under the terms of the gnu free documentation license"),
    # GNU texts
    ("agpl-3.0", "wording", "remote network interaction", r"remote network interaction use with the gnu general public license"),
    ("agpl-3.0", "wording", "interacting with it remotely", r"all users interacting with it remotely through a computer network"),
    ("agpl-3.0", "wording", "cooperation with the community in the case of network", r"cooperation with the community in the case of network server software"),
    ("lgpl-3.0", "wording", "terms and conditions of version 3 of the gnu", r"incorporates the terms and conditions of version 3 of the gnu general public license supplemented by"),
    ("lgpl-3.0", "wording", "without being bound by section 3", r"you may convey a covered work under sections 3 and 4 of this license without being bound by section 3"),
    ("lgpl-2.1", "wording", "derivative work of the library", r"such a work in isolation is not a derivative work of the library"),
    ("lgpl-2.1", "wording", "successor of the gnu library", r"this is the first released version of the lesser gpl it also counts as the successor of the gnu library public license"),
    ("lgpl-2.0", "wording", "first released version of the library gpl", r"this is the first released version of the library gpl"),
    ("gpl-3.0", "wording", "free copyleft license for software", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-3.0", "wording", "anti circumvention law", r"protecting users legal rights from anti circumvention law"),
    ("gpl-3.0", "wording", "conveying modified source versions", r"5 conveying modified source versions"),
    ("gpl-3.0", "wording", "installation information for a user product", r"installation information for a user product means any methods"),
    ("gpl-3.0", "wording", "automatic licensing of downstream", r"automatic licensing of downstream recipients"),
    ("gpl-2.0", "wording", "the licenses for most software are designed to take away", r"the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public license is intended"),
    ("gpl-2.0", "wording", "mere aggregation of another work", r"mere aggregation of another work not based on the program"),
    ("gpl-2.0", "wording", "customarily used for software interchange", r"on a medium customarily used for software interchange"),
    ("gpl-2.0", "wording", "written offer valid for at least three years", r"accompany it with a written offer valid for at least three years to give any third party"),
    ("gfdl", "wording", "invariant sections", r"with no invariant sections(?: with)? no front cover texts(?: and)?(?: with)? no back cover texts"),
    ("gfdl", "wording", "opaque copies of the document", r"publish or distribute opaque copies of the document numbering more than 100"),
    # Apache
    ("apache-2.0", "notice", "you may not use this file except in compliance with the license", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", "notice", "licenses this file to you under the apache", r"licenses this file to you under the apache license version 2 0"),
    ("apache-2.0", "notice", "contributor license agreements", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", "wording", "grant of patent license subject", r"grant of patent license subject to the terms and conditions of this license each contributor hereby grants to you"),
    ("apache-2.0", "wording", "grant of copyright license subject", r"grant of copyright license subject to the terms and conditions of this license each contributor hereby grants to you"),
    ("apache-2.0", "wording", "terms and conditions for use reproduction and distribution 1", r"terms and conditions for use reproduction and distribution 1 definitions"),
    ("apache-2.0", "wording", "how to apply the apache license", r"appendix how to apply the apache license to your work"),
    ("apache-2.0", "wording", "unless required by applicable law or agreed to in writing", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-1.1", "wording", "this product includes software developed by the apache", r"this product includes software developed by the apache software foundation http www apache org"),
    ("apache-1.1", "wording", "the names apache", r"the names apache(?: server)? and apache (?:group|software foundation) must not be used to endorse"),
    ("apache-1.1", "wording", "nor may apache appear", r"products derived from this software may not be called apache nor may apache appear in their name"),
    # MIT family
    ("mit-0", "wording", "publish distribute sublicense and or sell copies of the software and to permit", r"publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("mit", "wording", "free of charge to any person obtaining a copy", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "wording", "this permission notice", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit", "wording", "without limitation the rights to use copy modify merge", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell"),
    ("mit", "disclaimer", "fitness for a particular purpose and noninfringement", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "wording", "x consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("isc", "wording", "with or without fee is hereby granted", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("isc", "disclaimer", "the author disclaims all warranties", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("0bsd", "wording", "with or without fee is hereby granted the software", r"for any purpose with or without fee is hereby granted the software is provided as is"),
    ("hpnd", "wording", "and its documentation for any purpose", r"permission to use copy modify and distribute this software and its documentation for any purpose(?: and)?(?: with or)? without fee is hereby granted"),
    ("hpnd", "wording", "supporting documentation and that", r"that both that copyright notice and this permission notice appear in supporting documentation and that the name of"),
    ("ntp", "wording", "makes no representations about the suitability", r"makes no representations about the suitability (?:of )?this software for any purpose it is provided as is"),
    # BSD family
    ("bsd-4-clause", "wording", "all advertising materials mentioning", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-4-clause", "wording", "product includes software developed by the university of california", r"this product includes software developed by the university of california berkeley and its contributors"),
    ("bsd-3-clause", "wording", "nor the names of its contributors", rf"neither the name{GAP} nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", "wording", "neither the name of the university nor", r"neither the name of the university nor the names of its contributors"),
    ("bsd-3-clause", "wording", "the name of the author may not be used", r"the name of the author may not be used to endorse or promote products derived from this software"),
    ("bsd-2-clause", "wording", "representing official policies", r"should not be interpreted as representing official policies either expressed or implied of the freebsd project"),
    ("bsd", "wording", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "wording", "redistributions of source code must retain", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "wording", "redistributions in binary form must reproduce", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "disclaimer", "by the copyright holders and contributors as is", r"this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("bsd", "disclaimer", "by the regents and contributors as is", r"this software is provided by the regents and contributors as is and any express or implied warranties"),
    ("bsd", "disclaimer", "by the author and contributors as is", r"this software is provided by the author and contributors as is and any express or implied warranties"),
    ("bsd-3-clause-clear", "wording", "no express or implied licenses to any party s patent", r"no express or implied licenses to any party s patent rights are granted by this license"),
    # Mozilla, Eclipse, Sun and other weak copyleft
    ("mpl-2.0", "notice", "this source code form is subject to", r"this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0"),
    ("mpl-2.0", "notice", "if a copy of the mpl was not", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", "wording", "incompatible with secondary licenses", r"this source code form is incompatible with secondary licenses|incompatible with secondary licenses means"),
    ("mpl-2.0", "wording", "larger work means a work that combines covered software", r"larger work means a work that combines covered software with other material"),
    ("mpl-1.1", "notice", "the contents of this file are subject to the mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.1", "notice", "the contents of this file may be used under the terms of either", r"alternatively the contents of this file may be used under the terms of either the gnu general public license"),
    ("mpl-1.0", "notice", "the contents of this file are subject to the mozilla", r"the contents of this file are subject to the mozilla public license version 1 0"),
    ("npl-1.1", "notice", "subject to the netscape public", r"the contents of this file are subject to the netscape public license(?: version)? 1 1"),
    ("epl-2.0", "notice", "available under the terms of the eclipse public license", r"made available under the terms of the eclipse public license(?: v)? ?2 0"),
    ("epl-1.0", "notice", "available under the terms of the eclipse public license", r"made available under the terms of the eclipse public license v ?1 0"),
    ("epl-2.0", "wording", "secondary licenses when the conditions", r"this source code may also be made available under the following secondary licenses when the conditions"),
    ("epl-1.0", "wording", "provided under the terms of this eclipse public", r"the accompanying program is provided under the terms of this eclipse public license agreement"),
    ("cpl-1.0", "wording", "provided under the terms of this common public", r"the accompanying program is provided under the terms of this common public license agreement"),
    ("ipl-1.0", "wording", "provided under the terms of this ibm public", r"the accompanying program is provided under the terms of this ibm public license agreement"),
    ("cddl-1.0", "notice", "common development and distribution license", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl-1.0", "notice", "include this cddl header", r"when distributing covered code include this cddl header notice in each file"),
    ("spl-1.0", "notice", "subject to the sun public", r"the contents of this file are subject to the sun public license version 1 0"),
    ("apsl-2.0", "notice", "apple public source license", r"as defined in and that are subject to the apple public source license version 2 0"),
    ("ms-pl", "wording", "microsoft public license", r"microsoft public license ms pl|this license governs use of the accompanying software microsoft public license"),
    ("ms-rl", "wording", "reciprocal grants for any file", r"reciprocal grants for any file you distribute that contains code from the software"),
    ("qpl-1.0", "notice", "q public license", r"distributed under the terms of the q public license"),
    ("sleepycat", "wording", "redistributions in any form must be accompanied", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("osl-3.0", "notice", "open software license version 3", r"licensed under the open software license version 3 0"),
    ("afl-3.0", "notice", "academic free license version 3", r"licensed under the academic free license version 3 0"),
    ("eupl-1.2", "notice", "licensed under the eupl", r"licensed under the eupl(?: version)?(?: v)? ?1 2"),
    ("eupl-1.2", "wording", "licenced under the eupl", r"work has expressed by any other means his willingness to licenced under the eupl|licenced under the eupl"),
    ("cecill-2.1", "notice", "cecill", r"governed by the cecill(?: b| c)? license under french law"),
    ("mulan-2.0", "notice", "mulan psl v2", r"you can use this software according to the terms and conditions of the mulan psl v2"),
    ("upl-1.0", "wording", "listed in the lrgrwrks txt", r"any piece of software and or hardware listed in the lrgrwrks txt file if one is included with the software"),
    ("artistic-1.0", "wording", "the copyright holder maintains some semblance", r"the copyright holder maintains some semblance of artistic control over the development of the package"),
    ("artistic-2.0", "wording", "everyone is permitted to copy and distribute verbatim copies of this license document but changing", r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("artistic-2.0", "wording", "maintains some artistic control over the development", r"the copyright holder maintains some artistic control over the development of that package"),
    # Permissive texts of single projects
    ("bsl-1.0", "notice", "boost software license version 1", r"distributed under the boost software license version 1 0"),
    ("bsl-1.0", "wording", "machine executable object code generated by a source language", r"solely in the form of machine executable object code generated by a source language processor"),
    ("zlib", "wording", "the origin of this software must not be misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "wording", "altered source versions must be plainly marked", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "disclaimer", "held liable for any damages arising from the use of this software", r"in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("libpng", "notice", "png reference library", r"the png reference library is supplied as is"),
    ("ijg", "notice", "independent jpeg group", r"this software is based in part on the work of the independent jpeg group"),
    ("openssl", "wording", "developed by the openssl project", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "wording", "cryptographic software written by", r"this product includes cryptographic software written by eric young"),
    ("psf-2.0", "wording", "python software foundation psf and the individual", r"this license agreement is between the python software foundation psf and the individual or organization"),
    ("cnri-python", "wording", "corporation for national research initiatives", r"this license agreement is between the corporation for national research initiatives"),
    ("php-3.01", "wording", "this product includes php", r"this product includes php software freely available from"),
    ("php-3.01", "wording", "nor may php appear in their name", r"products derived from this software may not be called php nor may php appear in their name"),
    ("ruby", "wording", "redistribute it and or modify it under either the terms of the 2", r"you can redistribute it and or modify it under either the terms of the 2 clause bsdl"),
    ("postgresql", "wording", "postgresql database management system", r"postgresql database management system formerly known as postgres"),
    ("curl", "wording", "and many contributors see the thanks file", r"daniel stenberg daniel haxx se and many contributors see the thanks file"),
    ("icu", "wording", "provided that the above copyright notice s and this permission notice appear in all copies", r"provided that the above copyright notice s and this permission notice appear in all copies of the software and that both"),
    ("unicode-dfs", "wording", "unicode data files and any associated documentation", r"a copy of the unicode data files and any associated documentation"),
    ("ncsa", "wording", "all rights reserved developed by", rf"all rights reserved developed by{GAP} university of illinois"),
    ("ncsa", "wording", "to deal with the software without restriction", r"to deal with the software without restriction including without limitation the rights"),
    ("w3c", "wording", "w3c software", r"w3c software(?: and document)? notice and license"),
    ("beerware", "wording", "you can buy me a beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("wtfpl", "wording", "you just do what the fuck you want to", r"0 you just do what the fuck you want to"),
    ("unlicense", "wording", "free and unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "wording", "dedicate any and all copyright interest", r"dedicate any and all copyright interest in the software to the public domain"),
    ("bouncycastle", "notice", "legion of the bouncy castle", r"the legion of the bouncy castle(?: inc)? https? www bouncycastle org"),
    ("intel", "wording", "the name of the intel corporation", r"neither the name of the intel corporation nor the names of its contributors"),
    # Fonts, data, media
    ("ofl-1.1", "notice", "this font software is licensed under the sil", r"this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", "wording", "reserved font name", r"no modified version of the font software may use the reserved font name s"),
    ("ofl-1.1", "wording", "may be sold by itself", r"neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("bitstream-vera", "wording", "bitstream vera", r"bitstream vera is a trademark of bitstream inc"),
    ("odbl-1.0", "notice", "is made available under the open database", r"is made available under the open database license"),
    ("odbl-1.0", "wording", "share alike any derivative database", r"share alike any derivative database that you publicly use"),
    ("odc-by-1.0", "notice", "is made available under the open data commons attribution", r"is made available under the open data commons attribution license"),
    ("pddl-1.0", "notice", "is made available under the public domain dedication", r"is made available under the public domain dedication and license"),
    ("cc0-1.0", "notice", "dedicated all copyright and related", r"has dedicated all copyright and related and neighboring rights to this software to the public domain"),
    ("cc0-1.0", "wording", "affirmer hereby overtly fully permanently", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc0-1.0", "notice", "waived all copyright and related", r"has waived all copyright and related or neighboring rights to this work"),
    ("cc-by-nc-nd", "notice", "creative commons attribution noncommercial no", r"licensed under (?:a|the) creative commons attribution noncommercial no derivatives(?: works)? \d \d"),
    ("cc-by-nc-sa", "notice", "creative commons attribution noncommercial share", r"licensed under (?:a|the) creative commons attribution noncommercial sharealike \d \d"),
    ("cc-by-sa", "notice", "available under the creative commons attribution share", r"text is available under the creative commons attribution share ?alike license"),
    ("cc-by", "wording", "you must give appropriate credit provide a link", r"you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made"),
    ("cc-by-sa", "wording", "remix transform or build upon the material you must", r"if you remix transform or build upon the material you must distribute your contributions under the same licen[cs]e"),
    ("cc-by-nd", "wording", "remix transform or build upon the material you may not", r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-by-nc", "wording", "may not use the material for commercial purposes", r"you may not use the material for commercial purposes"),
    ("ogl-uk-3.0", "notice", "public sector information licensed under the open government", r"contains public sector information licensed under the open government licen[cs]e v3 0"),
    ("fal-1.3", "wording", "free art license", r"copyleft this is a free work you can copy distribute and modify it under the terms of the free art license"),
    ("cdla-permissive-2.0", "notice", "community data license agreement permissive", r"community data license agreement permissive(?: version)? 2 0"),
    ("cdla-sharing-1.0", "notice", "community data license agreement sharing", r"community data license agreement sharing(?: version)? 1 0"),
    # Source available and model licenses
    ("busl-1.1", "wording", "change license", r"effective on the change date or the fourth anniversary of the first publicly available distribution(?: of a specific version)?(?: of the licensed work)?(?: under this license)?(?: whichever comes first)?(?: the licensor hereby grants you rights under the terms of)? the change license"),
    ("busl-1.1", "wording", "make non production use", r"modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl-1.0", "notice", "server side public license", r"the terms of the server side public license version 1|server side public license sspl"),
    ("sspl-1.0", "wording", "offering the program as a service", r"13 offering the program as a service"),
    ("elastic-2.0", "notice", "elastic license", r"licensed under the elastic license 2 0|under the elastic license(?: v)? ?2 0"),
    ("elastic-2.0", "wording", "to third parties as a hosted or managed service", r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "notice", "commons clause", r"commons clause license condition v1 0|the software is provided to you by the licensor under the license as defined below subject to the following condition commons clause"),
    ("polyform-noncommercial", "notice", "polyform noncommercial", r"polyform noncommercial license 1 0 0"),
    ("parity-7.0", "notice", "parity public license", r"the parity public license 7 0 0"),
    ("openrail", "wording", "use based restrictions", r"use based restrictions as referenced in paragraph 5|use based restrictions as set forth in attachment a"),
    ("llama-community", "notice", "community license copyright", r"llama \d(?: \d)? is licensed under the llama \d(?: \d)? community license copyright|meta llama \d community license copyright"),
    ("json", "wording", "used for good not evil", r"the software shall be used for good not evil"),
    ("hippocratic", "notice", "hippocratic license", r"hippocratic license(?: version)? \d \d"),
    # Rights kept
    ("proprietary", "notice", "trade secrets of", rf"contains (?:confidential information and )?trade secrets of{GAP}"),
    ("proprietary", "notice", "unauthorized copying of this file", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "notice", "no part of this publication may be reproduced", r"no part of this publication may be reproduced(?: distributed)?(?: or transmitted)? in any form"),
    ("proprietary", "notice", "may not be published broadcast rewritten", r"this material may not be published broadcast rewritten or redistributed"),
    ("proprietary", "notice", "reproduction in whole or in part", r"reproduction in whole or in part without (?:written )?permission is prohibited"),
    ("proprietary", "notice", "for internal use only", r"for internal use only not for distribution"),
    ("us-government", "notice", "work of the united states government", r"(?:is )?(?:a )?work of the united states government"),
    ("us-government", "wording", "not subject to copyright protection in the united states", r"not subject to copyright protection in the united states"),
)
