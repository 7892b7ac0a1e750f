"""Fixed values of the license scan (operator 9): its signature rules.

Each entry is (label, confidence, keyword, expression), written by hand, in
order of priority: tags, addresses, sentences of license texts and headers,
names with a version, names, and last the weak signs.  Expressions are over
lower-case ASCII; a blank stands for blanks and the marks that begin comment
lines, <3> for the version 3 or 3.0 however it is introduced, with or without
"or later".  A keyword stands in whatever its expression matches, written with
single blanks for blanks, hyphens, slashes and comment marks.
"""

from __future__ import annotations

TAGS = (
    ("mit", 1.0, "spdx", r"spdx-license-identifier: ?mit"),
    ("mit-0", 1.0, "spdx", r"spdx-license-identifier: ?mit-0"),
    ("apache-2", 1.0, "spdx", r"spdx-license-identifier: ?apache-2\.0"),
    ("apache-2-llvm", 1.0, "spdx", r"spdx-license-identifier: ?apache-2\.0 with llvm-exception"),
    ("bsd-2", 1.0, "spdx", r"spdx-license-identifier: ?bsd-2-clause"),
    ("bsd-3", 1.0, "spdx", r"spdx-license-identifier: ?bsd-3-clause"),
    ("bsd-4", 1.0, "spdx", r"spdx-license-identifier: ?bsd-4-clause"),
    ("0bsd", 1.0, "spdx", r"spdx-license-identifier: ?0bsd"),
    ("gpl-2", 1.0, "spdx", r"spdx-license-identifier: ?gpl-2\.0(?:-only|-or-later|\+)?"),
    ("gpl-2-classpath", 1.0, "spdx", r"spdx-license-identifier: ?gpl-2\.0(?:-only|-or-later|\+)? with classpath-exception-2\.0"),
    ("gpl-2-syscall", 1.0, "spdx", r"spdx-license-identifier: ?gpl-2\.0(?:-only|-or-later|\+)? with linux-syscall-note"),
    ("gpl-3", 1.0, "spdx", r"spdx-license-identifier: ?gpl-3\.0(?:-only|-or-later|\+)?"),
    ("lgpl-2", 1.0, "spdx", r"spdx-license-identifier: ?lgpl-2\.0(?:-only|-or-later|\+)?"),
    ("lgpl-2.1", 1.0, "spdx", r"spdx-license-identifier: ?lgpl-2\.1(?:-only|-or-later|\+)?"),
    ("lgpl-3", 1.0, "spdx", r"spdx-license-identifier: ?lgpl-3\.0(?:-only|-or-later|\+)?"),
    ("agpl-3", 1.0, "spdx", r"spdx-license-identifier: ?agpl-3\.0(?:-only|-or-later|\+)?"),
    ("fdl-1.3", 1.0, "spdx", r"spdx-license-identifier: ?gfdl-1\.3(?:-only|-or-later)?"),
    ("mpl-2", 1.0, "spdx", r"spdx-license-identifier: ?mpl-2\.0"),
    ("epl-2", 1.0, "spdx", r"spdx-license-identifier: ?epl-2\.0"),
    ("cddl-1.0", 1.0, "spdx", r"spdx-license-identifier: ?cddl-1\.0"),
    ("eupl-1.2", 1.0, "spdx", r"spdx-license-identifier: ?eupl-1\.2"),
    ("isc", 1.0, "spdx", r"spdx-license-identifier: ?isc"),
    ("zlib", 1.0, "spdx", r"spdx-license-identifier: ?zlib"),
    ("boost-1", 1.0, "spdx", r"spdx-license-identifier: ?bsl-1\.0"),
    ("business-source", 1.0, "spdx", r"spdx-license-identifier: ?busl-1\.1"),
    ("unlicense", 1.0, "spdx", r"spdx-license-identifier: ?unlicense"),
    ("wtfpl", 1.0, "spdx", r"spdx-license-identifier: ?wtfpl"),
    ("cc0", 1.0, "spdx", r"spdx-license-identifier: ?cc0-1\.0"),
    ("cc-by", 1.0, "spdx", r"spdx-license-identifier: ?cc-by-[1-4]\.[05]"),
    ("cc-by-sa", 1.0, "spdx", r"spdx-license-identifier: ?cc-by-sa-[1-4]\.[05]"),
    ("ofl-1.1", 1.0, "spdx", r"spdx-license-identifier: ?ofl-1\.1"),
    ("artistic-2", 1.0, "spdx", r"spdx-license-identifier: ?artistic-2\.0"),
    ("mspl", 1.0, "spdx", r"spdx-license-identifier: ?ms-pl"),
    ("spdx", 0.9, "spdx", r"spdx-license-identifier: ?[a-z0-9.+-]+"),
)

ADDRESSES = (
    ("mit", 0.95, "opensource.org", r"opensource\.org/licenses?/mit(?:-license\.(?:php|html))?"),
    ("bsd-2", 0.95, "opensource.org", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3", 0.95, "opensource.org", r"opensource\.org/licenses?/bsd-3-clause"),
    ("bsd", 0.9, "opensource.org", r"opensource\.org/licenses?/bsd-license\.php"),
    ("isc", 0.95, "opensource.org", r"opensource\.org/licenses?/isc"),
    ("apache-2", 0.95, "opensource.org", r"opensource\.org/licenses?/apache-2\.0"),
    ("gpl-3", 0.95, "opensource.org", r"opensource\.org/licenses?/gpl-3\.0"),
    ("apache-2", 0.95, "apache.org", r"apache\.org/licenses/license-2\.0(?:\.txt|\.html)?"),
    ("apache-1.1", 0.95, "apache.org", r"apache\.org/licenses/license-1\.1(?:\.txt|\.html)?"),
    ("apache", 0.8, "apache.org", r"apache\.org/licenses/?"),
    ("gpl-2", 0.95, "gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0(?:\.en)?(?:\.html|\.txt)?"),
    ("gpl-3", 0.95, "gnu.org", r"gnu\.org/licenses/gpl-3\.0(?:\.en)?(?:\.html|\.txt)?"),
    ("gpl", 0.85, "gnu.org", r"gnu\.org/(?:licenses|copyleft)/gpl(?:\.html|\.txt)?"),
    ("lgpl-2.1", 0.95, "gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1(?:\.en)?(?:\.html|\.txt)?"),
    ("lgpl-3", 0.95, "gnu.org", r"gnu\.org/licenses/lgpl-3\.0(?:\.en)?(?:\.html|\.txt)?"),
    ("agpl-3", 0.95, "gnu.org", r"gnu\.org/licenses/agpl-3\.0(?:\.en)?(?:\.html|\.txt)?"),
    ("fdl", 0.9, "gnu.org", r"gnu\.org/licenses/fdl(?:-1\.[1-3])?(?:\.html|\.txt)?"),
    ("gnu", 0.6, "gnu.org", r"gnu\.org/licenses/?"),
    ("mpl-2", 0.95, "mozilla.org", r"mozilla\.org/mpl/2\.0"),
    ("mpl-1.1", 0.95, "mozilla.org", r"mozilla\.org/mpl/mpl-1\.1(?:\.html|\.txt)?"),
    ("epl-1", 0.95, "eclipse.org", r"eclipse\.org/legal/epl-v10(?:\.html)?"),
    ("epl-2", 0.95, "eclipse.org", r"eclipse\.org/legal/epl-(?:2\.0|v20)(?:\.html)?"),
    ("boost-1", 0.95, "boost.org", r"boost\.org/license_1_0\.txt"),
    ("unlicense", 0.95, "unlicense.org", r"unlicense\.org"),
    ("wtfpl", 0.95, "wtfpl.net", r"wtfpl\.net"),
    ("ofl", 0.95, "sil.org", r"scripts\.sil\.org/ofl"),
    ("cc0", 0.95, "creativecommons.org", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("public-domain", 0.9, "creativecommons.org", r"creativecommons\.org/publicdomain/mark/1\.0"),
    ("cc-by", 0.95, "creativecommons.org", r"creativecommons\.org/licenses/by/[1-4]\.[05]"),
    ("cc-by-sa", 0.95, "creativecommons.org", r"creativecommons\.org/licenses/by-sa/[1-4]\.[05]"),
    ("cc-by-nd", 0.95, "creativecommons.org", r"creativecommons\.org/licenses/by-nd/[1-4]\.[05]"),
    ("cc-by-nc", 0.95, "creativecommons.org", r"creativecommons\.org/licenses/by-nc/[1-4]\.[05]"),
    ("cc-by-nc-sa", 0.95, "creativecommons.org", r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.[05]"),
    ("cc-by-nc-nd", 0.95, "creativecommons.org", r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.[05]"),
)

SENTENCES = (
    ("mit", 0.95, "permission is hereby", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("boost-1", 0.95, "permission is hereby", r"permission is hereby granted, free of charge, to any person or organi[sz]ation obtaining a copy"),
    ("ofl", 0.95, "permission is hereby", r"permission is hereby granted, free of charge, to any person obtaining a copy of the font software"),
    ("unicode", 0.95, "permission is hereby", r"permission is hereby granted, free of charge, to any person obtaining a copy of the unicode data files"),
    ("mit", 0.8, "permission is hereby", r"permission is hereby granted,? free of charge"),
    ("mit", 0.9, "permission notice shall", r"above copyright notice and this permission notice shall be included in all copies"),
    ("x11", 0.9, "prior written authori", r"shall not be used in advertising or otherwise to promote the sale, use or other dealings in this software without prior written authori[sz]ation"),
    ("isc", 0.95, "permission to use", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee"),
    ("hpnd", 0.9, "permission to use", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose"),
    ("isc", 0.8, "permission to use", r"permission to use, copy, modify,? and(?:/or)? distribute"),
    ("bsd", 0.95, "redistribution and use", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", 0.85, "redistribution and use", r"redistribution and use in source and binary forms"),
    ("bsd", 0.85, "redistributions of source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", 0.85, "redistributions in binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3", 0.95, "endorse or promote", r"neither the name of [^.]{1,80} nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4", 0.9, "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment: ?this product includes software distributed"),
    ("apache-2", 0.95, "apache license", r"licensed under the apache license, version 2\.0 \(the [\"']license[\"']\)"),
    ("apache-2", 0.9, "in compliance with", r"you may not use this (?:file|work|product) except in compliance with the license"),
    ("apache-2", 0.9, "unless required by", r"unless required by applicable law or agreed to in writing, software distributed under the license"),
    ("apache-2", 0.95, "contributor hereby grants", r"each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (?:copyright|patent) license"),
    ("asf", 0.9, "apache software foundation", r"licensed to the apache software foundation \(asf\) under one or more contributor license agreements"),
    ("gpl-2", 0.98, "general public", r"this (?:program|file) is free software[;:,] you can redistribute it and(?:/or)? modify it under the terms of the gnu general public license<2>"),
    ("gpl-3", 0.98, "general public", r"this (?:program|file) is free software[;:,] you can redistribute it and(?:/or)? modify it under the terms of the gnu general public license<3>"),
    ("lgpl-2", 0.98, "general public", r"this (?:library|program) is free software[;:,] you can redistribute it and(?:/or)? modify it under the terms of the gnu (?:lesser|library) general public license<2>"),
    ("lgpl-2.1", 0.98, "general public", r"this (?:library|program) is free software[;:,] you can redistribute it and(?:/or)? modify it under the terms of the gnu (?:lesser|library) general public license<2\.1>"),
    ("lgpl-3", 0.98, "general public", r"this (?:library|program) is free software[;:,] you can redistribute it and(?:/or)? modify it under the terms of the gnu (?:lesser|library) general public license<3>"),
    ("agpl-3", 0.98, "general public", r"this program is free software[;:,] you can redistribute it and(?:/or)? modify it under the terms of the gnu affero general public license<3>"),
    ("gpl", 0.95, "general public", r"this (?:program|file) is free software[;:,] you can redistribute it and(?:/or)? modify it under the terms of the gnu general public license"),
    ("lgpl", 0.95, "general public", r"this (?:library|program) is free software[;:,] you can redistribute it and(?:/or)? modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", 0.95, "general public", r"this program is free software[;:,] you can redistribute it and(?:/or)? modify it under the terms of the gnu affero general public license"),
    ("gpl", 0.9, "general public", r"you should have received a copy of the gnu general public license along with"),
    ("lgpl", 0.9, "general public", r"you should have received a copy of the gnu (?:lesser|library) general public license along with"),
    ("agpl", 0.9, "general public", r"you should have received a copy of the gnu affero general public license along with"),
    ("gnu", 0.85, "verbatim copies", r"everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("gpl-2", 0.9, "take away your freedom", r"the licenses for most software are designed to take away your freedom"),
    ("gpl-3", 0.9, "practical works", r"the licenses for most software and other practical works are designed"),
    ("gpl-3", 0.9, "copyleft", r"general public license is a free, copyleft license for software and other kinds of works"),
    ("lgpl-2.1", 0.9, "specially designated", r"the lesser general public license, applies to some specially designated software packages"),
    ("gnu", 0.6, "fitness for a particular", r"distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("classpath-exception", 0.9, "independent modules", r"permission to link this library with independent modules"),
    ("fdl", 0.95, "free documentation", r"permission is granted to copy, distribute and(?:/or)? modify this document under the terms of the gnu free documentation license"),
    ("mpl-2", 0.95, "mozilla public", r"this source code form is subject to the terms of the mozilla public license, v\. ?2\.0"),
    ("mpl-1.1", 0.95, "mozilla public", r"the contents of this file are subject to the mozilla public license,? version 1\.1"),
    ("mpl-2", 0.9, "incompatible with secondary", r"incompatible with secondary licenses"),
    ("epl", 0.95, "eclipse public", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cpl", 0.95, "common public", r"this program and the accompanying materials are made available under the terms of the common public license"),
    ("cddl", 0.95, "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", 0.95, "eupl", r"licensed under the eupl(?:, version 1\.[12])?"),
    ("zlib", 0.95, "permission is granted to anyone", r"permission is granted to anyone to use this software for any purpose,? including commercial applications"),
    ("zlib", 0.85, "implied warranty", r"this software is provided ['\"]?as-is['\"]?, without any express or implied warranty"),
    ("unlicense", 0.95, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("cc0", 0.9, "related or neighbo", r"(?:has )?waived all copyright and related or neighbou?ring rights"),
    ("cc0", 0.9, "dedicated the work", r"has dedicated the work to the public domain by waiving all of (?:his or her|their) rights"),
    ("wtfpl", 0.95, "do what the", r"do what the f[a-z*]ck you want to public license"),
    ("artistic", 0.95, "copyright holder maintains", r"under which a package may be copied, such that the copyright holder maintains some semblance of artistic control"),
    ("ofl", 0.95, "font software", r"this font software is licensed under the sil open font license"),
    ("openssl", 0.9, "openssl", r"redistributions of any form whatsoever must retain the following acknowledge?ment: ?[\"']?this product includes software developed by the openssl project"),
    ("python", 0.9, "python software foundation", r"this license agreement is between the python software foundation"),
    ("beerware", 0.95, "beer ware", r"the beer-ware license"),
    ("business-source", 0.9, "change date", r"on the change date,[^.]{1,120} the licensor hereby grants you rights under the terms of the change license"),
    ("elastic", 0.9, "elastic license", r"licensed under the elastic license(?: 2\.0)?"),
    ("sspl", 0.9, "server side public", r"under the terms of the server side public license"),
    ("commons-clause", 0.9, "commons clause", r"commons clause[\"']? license condition"),
    ("openrail", 0.9, "responsible ai", r"(?:open )?responsible ai licen[sc]e"),
    ("llama", 0.9, "community license agreement", r"llama [23](?:\.[123])? community license agreement"),
    ("isc", 0.85, "appear in all copies", r"provided that the above copyright notice and this permission notice appear in all copies"),
    ("fsf-permissive", 0.9, "copying and distribution", r"copying and distribution of this file, with or without modification, are permitted in any medium without royalty"),
)

VERSIONED = (
    ("gpl-1", 0.95, "general public", r"(?:gnu )?general public licen[sc]e<1>"),
    ("gpl-2", 0.95, "general public", r"(?:gnu )?general public licen[sc]e<2>"),
    ("gpl-3", 0.95, "general public", r"(?:gnu )?general public licen[sc]e<3>"),
    ("lgpl-2", 0.95, "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e<2>"),
    ("lgpl-2.1", 0.95, "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e<2\.1>"),
    ("lgpl-3", 0.95, "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e<3>"),
    ("agpl-1", 0.95, "affero", r"(?:gnu )?affero general public licen[sc]e<1>"),
    ("agpl-3", 0.95, "affero", r"(?:gnu )?affero general public licen[sc]e<3>"),
    ("fdl-1.1", 0.95, "free documentation", r"(?:gnu )?free documentation licen[sc]e<1\.1>"),
    ("fdl-1.2", 0.95, "free documentation", r"(?:gnu )?free documentation licen[sc]e<1\.2>"),
    ("fdl-1.3", 0.95, "free documentation", r"(?:gnu )?free documentation licen[sc]e<1\.3>"),
    ("gpl-2", 0.9, "gpl", r"(?:gnu )?gpl(?:v| v|-| |, version )?2(?:\.0)?(?:\+|-only|-or-later| or later)?"),
    ("gpl-3", 0.9, "gpl", r"(?:gnu )?gpl(?:v| v|-| |, version )?3(?:\.0)?(?:\+|-only|-or-later| or later)?"),
    ("lgpl-2", 0.9, "lgpl", r"(?:gnu )?lgpl(?:v| v|-| |, version )?2(?:\.0)?(?:\+|-only|-or-later| or later)?"),
    ("lgpl-2.1", 0.9, "lgpl", r"(?:gnu )?lgpl(?:v| v|-| |, version )?2\.1(?:\+|-only|-or-later| or later)?"),
    ("lgpl-3", 0.9, "lgpl", r"(?:gnu )?lgpl(?:v| v|-| |, version )?3(?:\.0)?(?:\+|-only|-or-later| or later)?"),
    ("agpl-3", 0.9, "agpl", r"(?:gnu )?agpl(?:v| v|-| |, version )?3(?:\.0)?(?:\+|-only|-or-later| or later)?"),
    ("apache-1.0", 0.95, "apache", r"apache(?: software)?(?: foundation)? licen[sc]e<1\.0>"),
    ("apache-1.1", 0.95, "apache", r"apache(?: software)?(?: foundation)? licen[sc]e<1\.1>"),
    ("apache-2", 0.95, "apache", r"apache(?: software)?(?: foundation)? licen[sc]e<2>"),
    ("apache-2", 0.85, "apache", r"licensed under (?:the )?apache[ -]?2(?:\.0)?"),
    ("mpl-1.0", 0.95, "mozilla", r"mozilla public licen[sc]e<1\.0>"),
    ("mpl-1.1", 0.95, "mozilla", r"mozilla public licen[sc]e<1\.1>"),
    ("mpl-2", 0.95, "mozilla", r"mozilla public licen[sc]e<2>"),
    ("mpl-2", 0.85, "mpl", r"licensed under (?:the )?mpl[ -]?(?:v\.?)?2(?:\.0)?"),
    ("epl-1", 0.95, "eclipse", r"eclipse public licen[sc]e<1>"),
    ("epl-2", 0.95, "eclipse", r"eclipse public licen[sc]e<2>"),
    ("edl-1", 0.95, "eclipse", r"eclipse distribution licen[sc]e<1>"),
    ("cpl-1", 0.95, "common public", r"common public licen[sc]e<1>"),
    ("cddl-1.0", 0.95, "common development", r"common development and distribution licen[sc]e<1\.0>"),
    ("cddl-1.1", 0.95, "common development", r"common development and distribution licen[sc]e<1\.1>"),
    ("eupl-1.1", 0.95, "european union", r"european union public licen[sc]e<1\.1>"),
    ("eupl-1.2", 0.95, "european union", r"european union public licen[sc]e<1\.2>"),
    ("artistic-1", 0.95, "artistic", r"artistic licen[sc]e<1>"),
    ("artistic-2", 0.95, "artistic", r"artistic licen[sc]e<2>"),
    ("boost-1", 0.95, "boost", r"boost software licen[sc]e<1>"),
    ("osl-1", 0.95, "open software", r"open software licen[sc]e<1>"),
    ("osl-2", 0.95, "open software", r"open software licen[sc]e<2>"),
    ("osl-3", 0.95, "open software", r"open software licen[sc]e<3>"),
    ("afl-2", 0.95, "academic free", r"academic free licen[sc]e<2>"),
    ("afl-3", 0.95, "academic free", r"academic free licen[sc]e<3>"),
    ("ofl-1.0", 0.95, "open font", r"(?:sil )?open font licen[sc]e<1\.0>"),
    ("ofl-1.1", 0.95, "open font", r"(?:sil )?open font licen[sc]e<1\.1>"),
    ("cecill-1", 0.95, "cecill", r"cecill(?: free software)? licen[sc]e<1>"),
    ("cecill-2", 0.95, "cecill", r"cecill(?: free software)? licen[sc]e<2>"),
    ("cecill-2.1", 0.95, "cecill", r"cecill(?: free software)? licen[sc]e<2\.1>"),
    ("php-3.0", 0.95, "php", r"php licen[sc]e<3\.0>"),
    ("php-3.01", 0.95, "php", r"php licen[sc]e<3\.01>"),
    ("python-2", 0.95, "python", r"python(?: software foundation)? licen[sc]e<2>"),
    ("zope-2.1", 0.95, "zope", r"zope public licen[sc]e<2\.1>"),
    ("w3c", 0.9, "w3c", r"w3c software (?:notice and )?(?:document )?licen[sc]e"),
    ("odbl-1", 0.95, "open database", r"open (?:data commons open )?database licen[sc]e<1>"),
    ("odc-by-1", 0.95, "open data commons", r"open data commons attribution licen[sc]e<1>"),
    ("ogl-3", 0.95, "open government", r"open government licen[sc]e<3>"),
    ("business-source", 0.95, "business source", r"business source licen[sc]e<1\.1>"),
    ("elastic-2", 0.95, "elastic", r"elastic licen[sc]e<2>"),
    ("cc-by-nc-nd", 0.95, "creative commons", r"creative commons attribution[ -]+non-?commercial[ -]+no-?deriv(?:ative)?s(?: licen[sc]e)?<4>"),
    ("cc-by-nc-sa", 0.95, "creative commons", r"creative commons attribution[ -]+non-?commercial[ -]+share-?alike(?: licen[sc]e)?<4>"),
    ("cc-by-nc", 0.95, "creative commons", r"creative commons attribution[ -]+non-?commercial(?: licen[sc]e)?<4>"),
    ("cc-by-nd", 0.95, "creative commons", r"creative commons attribution[ -]+no-?deriv(?:ative)?s(?: licen[sc]e)?<4>"),
    ("cc-by-sa", 0.95, "creative commons", r"creative commons attribution[ -]+share-?alike(?: licen[sc]e)?<4>"),
    ("cc-by-sa", 0.95, "creative commons", r"creative commons attribution[ -]+share-?alike(?: licen[sc]e)?<3>"),
    ("cc-by", 0.95, "creative commons", r"creative commons attribution(?: licen[sc]e)?<4>"),
    ("cc-by", 0.95, "creative commons", r"creative commons attribution(?: licen[sc]e)?<3>"),
)

NAMES = (
    ("gpl", 0.85, "general public", r"(?:gnu )?general public licen[sc]e"),
    ("lgpl", 0.85, "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e"),
    ("agpl", 0.85, "affero", r"(?:gnu )?affero general public licen[sc]e"),
    ("fdl", 0.85, "free documentation", r"(?:gnu )?free documentation licen[sc]e"),
    ("gpl", 0.7, "gpl", r"gnu gpl"),
    ("lgpl", 0.7, "lgpl", r"(?:gnu )?lgpl"),
    ("agpl", 0.7, "agpl", r"(?:gnu )?agpl"),
    ("apache", 0.85, "apache", r"apache(?: software)?(?: foundation)? licen[sc]e"),
    ("mpl", 0.85, "mozilla", r"mozilla public licen[sc]e"),
    ("epl", 0.85, "eclipse", r"eclipse public licen[sc]e"),
    ("edl", 0.85, "eclipse", r"eclipse distribution licen[sc]e"),
    ("cpl", 0.85, "common public", r"common public licen[sc]e"),
    ("cddl", 0.85, "common development", r"common development and distribution licen[sc]e"),
    ("eupl", 0.85, "european union", r"european union public licen[sc]e"),
    ("artistic", 0.85, "artistic", r"artistic licen[sc]e"),
    ("boost", 0.85, "boost", r"boost software licen[sc]e"),
    ("osl", 0.85, "open software", r"open software licen[sc]e"),
    ("afl", 0.85, "academic free", r"academic free licen[sc]e"),
    ("ofl", 0.85, "open font", r"(?:sil )?open font licen[sc]e"),
    ("cecill", 0.85, "cecill", r"cecill(?: free software)? licen[sc]e"),
    ("mspl", 0.85, "microsoft public", r"microsoft public licen[sc]e"),
    ("msrl", 0.85, "microsoft reciprocal", r"microsoft reciprocal licen[sc]e"),
    ("mit", 0.85, "mit", r"mit(?:[ -]style)? licen[sc]e"),
    ("mit-0", 0.85, "mit no attribution", r"mit no attribution(?: licen[sc]e)"),
    ("x11", 0.85, "x11", r"x11 licen[sc]e"),
    ("isc", 0.85, "isc", r"isc licen[sc]e"),
    ("ncsa", 0.85, "ncsa", r"(?:university of illinois/)?ncsa open source licen[sc]e"),
    ("zlib", 0.85, "zlib", r"zlib(?:/libpng)? licen[sc]e"),
    ("bsd-2", 0.9, "clause", r"(?:2|two|simplified 2)[ -]clause bsd licen[sc]e"),
    ("bsd-3", 0.9, "clause", r"(?:3|three|modified 3)[ -]clause bsd licen[sc]e"),
    ("bsd-4", 0.9, "clause", r"(?:4|four|original 4)[ -]clause bsd licen[sc]e"),
    ("bsd-2", 0.85, "simplified bsd", r"simplified bsd licen[sc]e"),
    ("bsd-3", 0.85, "bsd", r"(?:new|modified) bsd licen[sc]e|new bsd-style licen[sc]e"),
    ("0bsd", 0.85, "zero", r"(?:bsd )?zero[ -]clause bsd licen[sc]e"),
    ("bsd", 0.8, "bsd", r"bsd(?:[ -]style)? licen[sc]e"),
    ("unlicense", 0.8, "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", 0.8, "wtfpl", r"wtfpl"),
    ("python", 0.8, "python", r"python(?: software foundation)? licen[sc]e"),
    ("php", 0.8, "php", r"php licen[sc]e"),
    ("ruby", 0.8, "ruby", r"ruby licen[sc]e"),
    ("perl", 0.8, "perl", r"perl licen[sc]e"),
    ("json", 0.8, "json", r"json licen[sc]e"),
    ("openssl", 0.8, "openssl", r"openssl licen[sc]e"),
    ("curl", 0.8, "curl", r"curl licen[sc]e"),
    ("zope", 0.8, "zope", r"zope public licen[sc]e"),
    ("odbl", 0.8, "database", r"open (?:data commons open )?database licen[sc]e"),
    ("odc-by", 0.8, "open data commons", r"open data commons attribution licen[sc]e"),
    ("ogl", 0.8, "open government", r"open government licen[sc]e"),
    ("business-source", 0.8, "business source", r"business source licen[sc]e"),
    ("sspl", 0.8, "server side public", r"server side public licen[sc]e"),
    ("elastic", 0.8, "elastic", r"elastic licen[sc]e"),
    ("cc-by-nc-nd", 0.9, "creative commons", r"creative commons attribution[ -]+non-?commercial[ -]+no-?deriv(?:ative)?s"),
    ("cc-by-nc-sa", 0.9, "creative commons", r"creative commons attribution[ -]+non-?commercial[ -]+share-?alike"),
    ("cc-by-nc", 0.9, "creative commons", r"creative commons attribution[ -]+non-?commercial"),
    ("cc-by-nd", 0.9, "creative commons", r"creative commons attribution[ -]+no-?deriv(?:ative)?s"),
    ("cc-by-sa", 0.9, "creative commons", r"creative commons attribution[ -]+share-?alike"),
    ("cc-by", 0.85, "creative commons", r"creative commons attribution(?: licen[sc]e)?"),
    ("cc0", 0.85, "creative commons", r"creative commons zero(?: licen[sc]e)?"),
    ("cc", 0.6, "creative commons", r"creative commons licen[sc]e"),
    ("cc-by-nc-nd", 0.95, "cc by", r"cc[ -]by[ -]nc[ -]nd(?:[ -][1-4](?:\.[05])?)?"),
    ("cc-by-nc-sa", 0.95, "cc by", r"cc[ -]by[ -]nc[ -]sa(?:[ -][1-4](?:\.[05])?)?"),
    ("cc-by-nc", 0.95, "cc by", r"cc[ -]by[ -]nc(?:[ -][1-4](?:\.[05])?)?"),
    ("cc-by-sa", 0.95, "cc by", r"cc[ -]by[ -]sa(?:[ -][1-4](?:\.[05])?)?"),
    ("cc-by-nd", 0.95, "cc by", r"cc[ -]by[ -]nd(?:[ -][1-4](?:\.[05])?)?"),
    ("cc-by", 0.9, "cc by", r"cc[ -]by(?:[ -][1-4](?:\.[05])?)?"),
    ("cc0", 0.9, "cc0", r"cc0(?:[ -]1\.0)?(?: universal)?"),
)

SIGNS = (
    ("public-domain", 0.9, "public domain", r"(?:placed in(?:to)?|dedicated to|released (?:in)?to) the public domain"),
    ("public-domain", 0.7, "public domain", r"(?:is|are) in the public domain"),
    ("proprietary", 0.9, "proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", 0.8, "unauthori", r"unauthori[sz]ed (?:copying|reproduction|distribution) of this (?:file|document|work)[^.]{0,60} prohibited"),
    ("proprietary", 0.8, "prior written permission", r"may not be (?:reproduced|copied|republished|redistributed) without (?:the )?prior written permission"),
    ("commercial", 0.6, "commercial use", r"(?:no|not for|non)[ -]commercial use"),
    ("reserved", 0.7, "all rights reserved", r"all rights reserved"),
    ("reserved", 0.6, "some rights reserved", r"some rights reserved"),
    ("copyright", 0.5, "copyright", r"copyright (?:\(c\) )?(?:19|20)[0-9][0-9](?: ?- ?(?:19|20)[0-9][0-9])?"),
    ("copyright", 0.4, "(c)", r"\(c\) ?(?:19|20)[0-9][0-9]"),
    ("dual-license", 0.6, "licensed under", r"(?:dual|multi|tri)-?licensed under"),
    ("license-text", 0.3, "licen", r"this (?:work|file|software|program|document|font|package|project|article|dataset) is licen[sc]ed"),
    ("license-text", 0.3, "licen", r"see (?:the )?(?:accompanying )?licen[sc]e(?:\.txt|\.md)? (?:file )?for (?:details|more information|the full text)"),
    ("license-text", 0.3, "terms of", r"under the terms of (?:the|this) licen[sc]e"),
    ("warranty", 0.4, "provided", r"provided [\"']?as[ -]is[\"']?"),
    ("warranty", 0.4, "distributed", r"distributed [\"']?as[ -]is[\"']?"),
    ("warranty", 0.4, "without warrant", r"without warrant(?:y|ies)(?: of any kind)?"),
    ("warranty", 0.4, "without any warrant", r"without any warrant(?:y|ies)"),
    ("liability", 0.4, "be liable", r"in no event shall the (?:authors or )?copyright (?:holders?|owner)(?: or contributors)? be liable"),
)

SIGNATURES = TAGS + ADDRESSES + SENTENCES + VERSIONED + NAMES + SIGNS
