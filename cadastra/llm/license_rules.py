"""Signature rules of licenses, hand-written, most specific family members first.

A rule is (label, kind, keywords, pattern). Patterns are read on normalised text: ASCII letters in lower case,
words joined by one space, ``licence`` and ``licenced`` spelled with s; they match whole words only. The
keywords are words of which each must stand in the document before the pattern is tried, the rarest first.

Kinds, from the most to the least certain: ``tag`` (identifiers and addresses), ``text`` (sentences of the
license itself), ``version`` (a name with its version), ``name``, ``hint``.
"""

from __future__ import annotations

# Words that may stand between the words of a rule, and after an unnamed license: what names it is then inside.
GAP = "(?: [^ ]+){0,3}"
TAIL = "(?: [^ ]+){0,6}"

RULES: list[tuple[str, str, str, str]] = [
    # MIT and relatives
    ("mit", "tag", "spdx mit", "spdx license identifier mit"),
    ("mit", "tag", "opensource mit", "opensource org licenses? mit(?: license)?(?: php| html)?"),
    ("mit", "tag", "mit org", "mit license org"),
    ("mit", "text", "hereby granted charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "text", "sublicense merge", "use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "text", "substantial portions", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "text", "noninfringement warranties", "warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "name", "mit license", "(?:the )?(?:terms of the )?mit license"),
    ("mit", "name", "mit licensed", "mit licensed"),
    ("mit", "name", "expat license", "expat license"),
    ("mit-0", "tag", "spdx mit", "spdx license identifier mit 0"),
    ("mit-0", "name", "mit attribution", "mit no attribution(?: license)?"),
    ("x11", "tag", "spdx x11", "spdx license identifier x11"),
    ("x11", "name", "x11 license", "x11 license"),
    ("x11", "name", "consortium license", "x consortium license"),
    ("isc", "tag", "spdx isc", "spdx license identifier isc"),
    ("isc", "tag", "opensource isc", "opensource org licenses? isc(?: license)?"),
    ("isc", "text", "hereby granted fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "text", "author disclaims", "the author disclaims all warranties with regard to this software"),
    ("isc", "name", "isc license", "isc license"),
    ("0bsd", "tag", "spdx 0bsd", "spdx license identifier 0bsd"),
    ("0bsd", "name", "0bsd", "0bsd(?: license)?"),
    ("0bsd", "name", "zero clause bsd", "zero clause bsd(?: license)?"),
    ("ntp", "name", "ntp license", "ntp license"),
    ("hpnd", "name", "historical permission notice", "historical permission notice and disclaimer"),
    # Apache
    ("apache-2", "tag", "spdx apache", "spdx license identifier apache 2 0"),
    ("apache-2", "tag", "apache org licenses", "apache org licenses license 2 0(?: txt| html)?"),
    ("apache-2", "tag", "opensource apache", "opensource org licenses? apache 2 0"),
    ("apache-2", "text", "compliance license", "you may not use this file except in compliance with the license"),
    ("apache-2", "text", "basis warranties", "distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2", "text", "governing permissions", "see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2", "version", "apache license", "apache(?: software)? license(?: version | v ?| )2(?: 0)?"),
    ("apache-2", "version", "apache 2", "apache 2(?: 0)? license"),
    ("apache-2", "version", "apache2", "apache2(?: 0)?(?: license)?"),
    ("apache-1.1", "tag", "spdx apache", "spdx license identifier apache 1 1"),
    ("apache-1.1", "version", "apache license", "apache(?: software)? license(?: version | v ?| )1 1"),
    ("apache-1.0", "version", "apache license", "apache(?: software)? license(?: version | v ?| )1 0"),
    ("apache", "name", "apache license", "apache(?: software)? license"),
    ("apache", "name", "apache licensed", "apache licensed"),
    # BSD
    ("bsd-2", "tag", "spdx bsd", "spdx license identifier bsd 2 clause"),
    ("bsd-2", "tag", "opensource bsd", "opensource org licenses? bsd 2 clause"),
    ("bsd-2", "version", "bsd clause", "bsd(?: license)? (?:2|two) clause(?: license)?"),
    ("bsd-2", "version", "bsd clause", "(?:2|two) clause bsd(?: license)?"),
    ("bsd-2", "name", "simplified bsd", "simplified bsd license"),
    ("bsd-2", "name", "freebsd license", "freebsd license"),
    ("bsd-3", "tag", "spdx bsd", "spdx license identifier bsd 3 clause"),
    ("bsd-3", "tag", "opensource bsd", "opensource org licenses? bsd 3 clause"),
    ("bsd-3", "text", "endorse promote", "be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-3", "version", "bsd clause", "bsd(?: license)? (?:3|three) clause(?: license)?"),
    ("bsd-3", "version", "bsd clause", "(?:3|three) clause bsd(?: license)?"),
    ("bsd-3", "name", "revised bsd", "revised bsd license"),
    ("bsd-3", "name", "modified bsd", "modified bsd license"),
    ("bsd-3", "name", "new bsd", "new bsd license"),
    ("bsd-4", "tag", "spdx bsd", "spdx license identifier bsd 4 clause"),
    ("bsd-4", "text", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-4", "version", "bsd clause", "bsd(?: license)? (?:4|four) clause(?: license)?"),
    ("bsd-4", "version", "bsd clause", "(?:4|four) clause bsd(?: license)?"),
    ("bsd-4", "name", "original bsd", "original bsd license"),
    ("bsd", "text", "redistribution binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "text", "redistributions binary reproduce", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "text", "redistributions retain", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "name", "bsd license", "bsd(?: style)? license"),
    ("bsd", "name", "bsd licensed", "bsd licensed"),
    # GNU GPL
    ("gpl-2-only", "tag", "spdx gpl", "spdx license identifier gpl 2 0(?: only)?"),
    ("gpl-2-or-later", "tag", "spdx gpl later", "spdx license identifier gpl 2 0 or later"),
    ("gpl-3-only", "tag", "spdx gpl", "spdx license identifier gpl 3 0(?: only)?"),
    ("gpl-3-or-later", "tag", "spdx gpl later", "spdx license identifier gpl 3 0 or later"),
    ("gpl-2", "tag", "gnu org gpl", "gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?"),
    ("gpl-3", "tag", "gnu org gpl", "gnu org licenses gpl(?: 3 0)?(?: html| txt)?"),
    ("gpl-2", "tag", "opensource gpl", "opensource org licenses? gpl 2 0"),
    ("gpl-3", "tag", "opensource gpl", "opensource org licenses? gpl 3 0"),
    ("gpl-2-or-later", "text", "gnu foundation later", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3-or-later", "text", "gnu foundation later", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2-only", "text", "gnu foundation", "gnu general public license version 2 as published by the free software foundation"),
    ("gpl-3-only", "text", "gnu foundation", "gnu general public license version 3 as published by the free software foundation"),
    ("gpl", "text", "gnu received", "you should have received a copy of the gnu general public license"),
    ("gpl-1", "version", "gnu", "gnu general public license(?: version | v ?| )1(?: 0)?"),
    ("gpl-2", "version", "gnu", "gnu (?:general public license|gpl)(?: version | v ?| )2(?: 0)?"),
    ("gpl-2", "version", "gpl", "gpl(?: license)?(?: version | v ?| )2(?: 0)?"),
    ("gpl-2", "version", "gplv2", "gplv2(?: 0)?"),
    ("gpl-3", "version", "gnu", "gnu (?:general public license|gpl)(?: version | v ?| )3(?: 0)?"),
    ("gpl-3", "version", "gpl", "gpl(?: license)?(?: version | v ?| )3(?: 0)?"),
    ("gpl-3", "version", "gplv3", "gplv3(?: 0)?"),
    ("gpl", "name", "gnu public", "gnu general public license"),
    ("gpl", "name", "gnu gpl", "gnu gpl"),
    ("gpl", "hint", "general public license", "general public license"),
    ("gpl", "hint", "gpl", "gpl"),
    ("gpl-classpath", "tag", "spdx classpath", "spdx license identifier gpl 2 0(?: only| or later)? with classpath exception 2 0"),
    ("gpl-classpath", "name", "classpath exception", "(?:gnu )?classpath exception"),
    ("gpl-linking", "name", "linking exception", "(?:gpl )?linking exception"),
    # GNU LGPL, AGPL, FDL
    ("lgpl-2.1", "tag", "spdx lgpl", "spdx license identifier lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "tag", "spdx lgpl", "spdx license identifier lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "tag", "gnu org lgpl", "gnu org licenses (?:old licenses )?lgpl 2 1(?: html| txt)?"),
    ("lgpl-3", "tag", "gnu org lgpl", "gnu org licenses lgpl(?: 3 0)?(?: html| txt)?"),
    ("lgpl", "text", "lesser received", "you should have received a copy of the gnu lesser general public license"),
    ("lgpl-2.1", "version", "lesser", "(?:gnu )?lesser general public license(?: version | v ?| )2 1"),
    ("lgpl-2.1", "version", "lgpl", "(?:gnu )?lgpl(?: version | v ?| )2 1"),
    ("lgpl-2.1", "version", "lgplv2", "lgplv2(?: 1)?"),
    ("lgpl-2", "version", "library", "(?:gnu )?library general public license(?: version | v ?| )2(?: 0)?"),
    ("lgpl-3", "version", "lesser", "(?:gnu )?lesser general public license(?: version | v ?| )3(?: 0)?"),
    ("lgpl-3", "version", "lgpl", "(?:gnu )?lgpl(?: version | v ?| )3(?: 0)?"),
    ("lgpl-3", "version", "lgplv3", "lgplv3(?: 0)?"),
    ("lgpl", "name", "lesser public", "(?:gnu )?lesser general public license"),
    ("lgpl", "name", "library public", "(?:gnu )?library general public license"),
    ("lgpl", "name", "lgpl", "(?:gnu )?lgpl"),
    ("agpl-3", "tag", "spdx agpl", "spdx license identifier agpl 3 0(?: only| or later)?"),
    ("agpl-3", "tag", "gnu org agpl", "gnu org licenses agpl(?: 3 0)?(?: html| txt)?"),
    ("agpl-3", "text", "affero received", "you should have received a copy of the gnu affero general public license"),
    ("agpl-3", "version", "affero", "(?:gnu )?affero general public license(?: version | v ?| )3(?: 0)?"),
    ("agpl-3", "version", "agpl", "(?:gnu )?agpl(?: version | v ?| )3(?: 0)?"),
    ("agpl-3", "version", "agplv3", "agplv3(?: 0)?"),
    ("agpl", "name", "affero", "(?:gnu )?affero general public license"),
    ("agpl", "name", "agpl", "(?:gnu )?agpl"),
    ("gfdl", "tag", "spdx gfdl", "spdx license identifier gfdl 1 [123](?: only| or later)?"),
    ("gfdl", "text", "invariant sections", "with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", "name", "free documentation license", "(?:gnu )?free documentation license(?: version 1 [123])?"),
    ("gfdl", "name", "gfdl", "gfdl"),
    # Mozilla, Eclipse, Sun, IBM
    ("mpl-2", "tag", "spdx mpl", "spdx license identifier mpl 2 0"),
    ("mpl-2", "tag", "mozilla org mpl", "mozilla org mpl 2 0"),
    ("mpl-2", "text", "mozilla subject", "subject to the terms of the mozilla public license v(?:ersion)? 2 0"),
    ("mpl-2", "text", "incompatible secondary", "incompatible with secondary licenses"),
    ("mpl-2", "version", "mozilla license", "mozilla public license(?: version | v ?| )2(?: 0)?"),
    ("mpl-2", "version", "mpl", "mpl(?: version | v ?| )2(?: 0)?"),
    ("mpl-1.1", "tag", "spdx mpl", "spdx license identifier mpl 1 1"),
    ("mpl-1.1", "version", "mozilla license", "mozilla public license(?: version | v ?| )1 1"),
    ("mpl-1.0", "version", "mozilla license", "mozilla public license(?: version | v ?| )1 0"),
    ("mpl", "name", "mozilla license", "mozilla public license"),
    ("epl-1", "tag", "spdx epl", "spdx license identifier epl 1 0"),
    ("epl-2", "tag", "spdx epl", "spdx license identifier epl 2 0"),
    ("epl-1", "tag", "eclipse legal v10", "eclipse org legal epl v10(?: html)?"),
    ("epl-2", "tag", "eclipse legal", "eclipse org legal epl (?:2 0|v20)(?: html)?"),
    ("epl-1", "version", "eclipse license", "eclipse public license(?: version | v ?| )1(?: 0)?"),
    ("epl-2", "version", "eclipse license", "eclipse public license(?: version | v ?| )2(?: 0)?"),
    ("epl", "name", "eclipse license", "eclipse public license"),
    ("edl-1", "name", "eclipse distribution", "eclipse distribution license"),
    ("cpl-1", "tag", "spdx cpl", "spdx license identifier cpl 1 0"),
    ("cpl-1", "name", "common public license", "common public license(?: version 1 0)?"),
    ("ipl-1", "name", "ibm license", "ibm public license(?: version 1 0)?"),
    ("cddl-1.0", "tag", "spdx cddl", "spdx license identifier cddl 1 0"),
    ("cddl-1.1", "tag", "spdx cddl", "spdx license identifier cddl 1 1"),
    ("cddl-1.0", "version", "cddl", "cddl(?: version | v ?| )1 0"),
    ("cddl", "name", "common development distribution", "common development and distribution license"),
    ("cddl", "name", "cddl", "cddl"),
    ("osl-3", "tag", "spdx osl", "spdx license identifier osl 3 0"),
    ("osl-3", "name", "open software license", "open software license(?: version | v ?| )3(?: 0)?"),
    ("afl-3", "tag", "spdx afl", "spdx license identifier afl 3 0"),
    ("afl-3", "name", "academic license", "academic free license(?: version| v)?(?: 3(?: 0)?)?"),
    ("eupl-1.2", "tag", "spdx eupl", "spdx license identifier eupl 1 2"),
    ("eupl-1.2", "version", "eupl", "eupl(?: version | v ?| )1 2"),
    ("eupl", "name", "european union license", "european union public license"),
    ("eupl", "name", "eupl", "eupl"),
    ("cecill", "tag", "spdx cecill", "spdx license identifier cecill (?:1 [01]|2 [01]|b|c)"),
    ("cecill-b", "version", "cecill b", "cecill b(?: license)?"),
    ("cecill-c", "version", "cecill c", "cecill c(?: license)?"),
    ("cecill", "name", "cecill", "(?:license )?cecill(?: license)?"),
    ("artistic-1", "version", "artistic license", "artistic license(?: version | v ?| )1(?: 0)?"),
    ("artistic-2", "tag", "spdx artistic", "spdx license identifier artistic 2 0"),
    ("artistic-2", "version", "artistic license", "artistic license(?: version | v ?| )2(?: 0)?"),
    ("artistic", "name", "artistic license", "(?:perl )?artistic license"),
    # Creative Commons: tags and addresses
    ("cc-by-nc", "tag", "spdx cc nc", "spdx license identifier cc by nc [1234] [05]"),
    ("cc-by-nc-nd", "tag", "spdx cc nd", "spdx license identifier cc by nc nd [1234] [05]"),
    ("cc-by-nc-sa", "tag", "spdx cc sa", "spdx license identifier cc by nc sa [1234] [05]"),
    ("cc-by-nd", "tag", "spdx cc nd", "spdx license identifier cc by nd [1234] [05]"),
    ("cc-by-sa", "tag", "spdx cc sa", "spdx license identifier cc by sa [1234] [05]"),
    ("cc-by", "tag", "spdx cc by", "spdx license identifier cc by [1234] [05]"),
    ("cc0", "tag", "spdx cc0", "spdx license identifier cc0 1 0"),
    ("cc-by-nc", "tag", "creativecommons nc", "creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nc-nd", "tag", "creativecommons nd", "creativecommons org licenses by nc nd [1234] [05]"),
    ("cc-by-nc-sa", "tag", "creativecommons sa", "creativecommons org licenses by nc sa [1234] [05]"),
    ("cc-by-nd", "tag", "creativecommons nd", "creativecommons org licenses by nd [1234] [05]"),
    ("cc-by-sa", "tag", "creativecommons sa", "creativecommons org licenses by sa [1234] [05]"),
    ("cc-by", "tag", "creativecommons by", "creativecommons org licenses by [1234] [05]"),
    ("cc0", "tag", "creativecommons zero", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", "tag", "creativecommons mark", "creativecommons org publicdomain mark 1 0"),
    # Creative Commons: names
    ("cc-by-nc-1", "version", "cc nc 1", "cc by nc 1 0"),
    ("cc-by-nc-2", "version", "cc nc 2", "cc by nc 2 [05]"),
    ("cc-by-nc-3", "version", "cc nc 3", "cc by nc 3 0"),
    ("cc-by-nc-4", "version", "cc nc 4", "cc by nc 4 0"),
    ("cc-by-nc-nd-3", "version", "cc nd 3", "cc by nc nd 3 0"),
    ("cc-by-nc-nd-4", "version", "cc nd 4", "cc by nc nd 4 0"),
    ("cc-by-nc-sa-3", "version", "cc sa 3", "cc by nc sa 3 0"),
    ("cc-by-nc-sa-4", "version", "cc sa 4", "cc by nc sa 4 0"),
    ("cc-by-nd-3", "version", "cc nd 3", "cc by nd 3 0"),
    ("cc-by-nd-4", "version", "cc nd 4", "cc by nd 4 0"),
    ("cc-by-sa-2", "version", "cc sa 2", "cc by sa 2 [05]"),
    ("cc-by-sa-3", "version", "cc sa 3", "cc by sa 3 0"),
    ("cc-by-sa-4", "version", "cc sa 4", "cc by sa 4 0"),
    ("cc-by-2", "version", "cc by 2", "cc by 2 [05]"),
    ("cc-by-3", "version", "cc by 3", "cc by 3 0"),
    ("cc-by-4", "version", "cc by 4", "cc by 4 0"),
    ("cc0", "version", "cc0 1", "cc0 1 0(?: universal)?"),
    ("cc-by-nc-nd", "name", "cc nc nd", "cc by nc nd"),
    ("cc-by-nc-sa", "name", "cc nc sa", "cc by nc sa"),
    ("cc-by-nc", "name", "cc by nc", "cc by nc"),
    ("cc-by-nd", "name", "cc by nd", "cc by nd"),
    ("cc-by-sa", "name", "cc by sa", "cc by sa"),
    ("cc-by", "name", "cc by license", "cc by license"),
    ("cc0", "name", "cc0", "cc0"),
    ("cc-by-nc-nd", "name", "creative commons attribution", "creative commons attribution non ?commercial no ?derivatives(?: [1234] [05])?(?: international| unported)?(?: public)?(?: license)?"),
    ("cc-by-nc-sa", "name", "creative commons attribution", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported)?(?: public)?(?: license)?"),
    ("cc-by-nc", "name", "creative commons noncommercial", "creative commons attribution noncommercial(?: [1234] [05])?(?: international| unported)?(?: public)?(?: license)?"),
    ("cc-by-nc", "name", "creative commons non commercial", "creative commons attribution non commercial(?: [1234] [05])?(?: international| unported)?(?: public)?(?: license)?"),
    ("cc-by-nd", "name", "creative commons attribution", "creative commons attribution noderiv(?:ative)?s(?: [1234] [05])?(?: international| unported)?(?: public)?(?: license)?"),
    ("cc-by-sa", "name", "creative commons sharealike", "creative commons attribution sharealike(?: [1234] [05])?(?: international| unported)?(?: public)?(?: license)?"),
    ("cc-by-sa", "name", "creative commons share alike", "creative commons attribution share alike(?: [1234] [05])?(?: international| unported)?(?: public)?(?: license)?"),
    ("cc-by", "name", "creative commons attribution", "creative commons attribution(?: [1234] [05])?(?: international| unported)?(?: public)?(?: license)?"),
    ("cc0", "name", "creative commons", "creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?"),
    ("cc", "hint", "creative commons", "creative commons(?: license)?"),
    # Public domain and waivers
    ("unlicense", "tag", "spdx unlicense", "spdx license identifier unlicense"),
    ("unlicense", "tag", "unlicense org", "unlicense org"),
    ("unlicense", "text", "unencumbered released", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "name", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "tag", "spdx wtfpl", "spdx license identifier wtfpl"),
    ("wtfpl", "name", "wtfpl", "wtfpl"),
    ("public-domain", "text", "dedicated public domain", "dedicated(?: [^ ]+){0,6} to the public domain"),
    ("public-domain", "text", "released public domain", "released(?: [^ ]+){0,3} (?:in)?to the public domain"),
    ("public-domain", "text", "placed public domain", "placed in the public domain"),
    ("public-domain", "hint", "public domain", "(?:in the )?public domain"),
    ("pddl", "name", "pddl", "pddl(?: 1 0)?"),
    ("pddl", "name", "domain dedication license", "public domain dedication and license"),
    # Data and content
    ("odbl", "tag", "spdx odbl", "spdx license identifier odbl 1 0"),
    ("odbl", "tag", "opendatacommons odbl", "opendatacommons org licenses odbl(?: 1 0)?"),
    ("odbl", "name", "open database license", "open (?:data commons open )?database license"),
    ("odbl", "name", "odbl", "odbl(?: 1 0)?"),
    ("odc-by", "name", "odc by", "odc by(?: 1 0)?"),
    ("odc-by", "name", "commons attribution license", "open data commons attribution license"),
    ("etalab-2", "version", "etalab 2", "etalab(?: license)? 2 0"),
    ("etalab", "name", "ouverte", "license ouverte(?: open license)?(?: 2 0)?"),
    ("etalab", "name", "etalab", "etalab"),
    ("ogl-uk", "name", "government license", "open government license(?: v?(?:ersion )?3 0)?"),
    ("ofl-1.1", "tag", "spdx ofl", "spdx license identifier ofl 1 1"),
    ("ofl-1.1", "name", "sil font license", "sil open font license(?: version)?(?: 1 1)?"),
    ("dl-de-by", "name", "datenlizenz", "datenlizenz deutschland(?: namensnennung)?(?: version)?(?: 2 0)?"),
    ("cdla", "name", "community data agreement", "community data license agreement(?: permissive| sharing)?"),
    ("free-art", "name", "free art license", "free art license(?: 1 3)?"),
    # Other software licenses
    ("bsl-1", "tag", "spdx bsl", "spdx license identifier bsl 1 0"),
    ("bsl-1", "tag", "boost org", "boost org license 1 0(?: txt)?"),
    ("bsl-1", "name", "boost license", "boost software license(?: version)?(?: 1 0)?"),
    ("busl", "tag", "spdx busl", "spdx license identifier busl 1 1"),
    ("busl", "name", "business source license", "business source license(?: version)?(?: 1 [01])?"),
    ("sspl", "name", "side public license", "server side public license"),
    ("sspl", "name", "sspl", "sspl(?: v1)?"),
    ("elastic-2", "name", "elastic license", "elastic license(?: version)?(?: v?2(?: 0)?)?"),
    ("zlib", "tag", "spdx zlib", "spdx license identifier zlib"),
    ("zlib", "text", "origin misrepresented", "the origin of this software must not be misrepresented"),
    ("zlib", "text", "altered plainly", "altered source versions must be plainly marked as such"),
    ("zlib", "name", "zlib license", "zlib(?: libpng)? license"),
    ("libpng", "name", "libpng license", "libpng license"),
    ("openssl", "name", "openssl license", "openssl license"),
    ("ssleay", "name", "ssleay license", "(?:original )?ssleay license"),
    ("python-2", "tag", "spdx identifier", "spdx license identifier (?:psf|python) 2 0"),
    ("python-2", "name", "python foundation license", "python software foundation license(?: version 2)?"),
    ("php-3", "name", "php license", "php license(?: version)?(?: v?3 0[01]?)?"),
    ("ruby", "name", "ruby license", "ruby license"),
    ("postgresql", "name", "postgresql license", "postgresql license"),
    ("ncsa", "name", "ncsa license", "(?:university of illinois )?ncsa open source license"),
    ("unicode", "name", "unicode license", "unicode(?: data files and software)? license"),
    ("curl", "name", "curl license", "curl license"),
    ("w3c", "name", "w3c license", "w3c software(?: notice and| and document)? license"),
    ("ms-pl", "name", "microsoft license", "microsoft public license"),
    ("ms-rl", "name", "microsoft reciprocal", "microsoft reciprocal license"),
    ("ms-pl", "name", "pl ms", "ms pl"),
    ("vim", "name", "vim license", "vim license"),
    ("beerware", "name", "beerware", "beerware(?: license)?"),
    ("beerware", "name", "beer ware", "beer ware license"),
    ("sleepycat", "name", "sleepycat license", "sleepycat license"),
    ("upl-1", "name", "universal permissive license", "universal permissive license(?: v?(?:ersion )?1 0)?"),
    ("jpl-image", "name", "jpl image policy", "jpl image use policy"),
    ("openrail-m", "name", "openrail", "(?:bigscience |creativeml )?openrail(?: m)?(?: license)?"),
    ("llama", "name", "llama license", "llama [23](?: [123])? community license(?: agreement)?"),
    # Proprietary notices
    ("proprietary", "text", "reproduced transmitted", "no part of this publication may be reproduced(?: [^ ]+){0,8} transmitted"),
    ("proprietary", "text", "unauthorized copying prohibited", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "text", "proprietary confidential", "proprietary and confidential"),
    ("proprietary", "hint", "rights reserved", "all rights reserved"),
    ("proprietary", "hint", "droits réservés", "tous droits réservés"),
    ("proprietary", "hint", "rechte vorbehalten", "alle rechte vorbehalten"),
    ("proprietary", "hint", "derechos reservados", "todos los derechos reservados"),
    # Unnamed
    ("unnamed", "hint", "license attached", "see the (?:attached|enclosed|accompanying) license"),
    ("unnamed", "hint", "license file", "see the license file"),
    ("unnamed", "hint", "released under license", f"released under (?:the|a|an){GAP} license{TAIL}"),
    ("unnamed", "hint", "licensed under", f"licensed under (?:the|a|an){GAP} license{TAIL}"),
    ("unnamed", "hint", "distributed under license", f"distributed under the terms of the{GAP} license{TAIL}"),
    ("unnamed", "hint", "lizenz unter", "unter(?: [^ ]+){1,4} lizenz"),
    ("unnamed", "hint", "license sous", "sous license(?: [^ ]+){1,2}"),
    ("unnamed", "hint", "licencia bajo", "bajo(?: [^ ]+){0,2} licencia(?: [^ ]+){1,2}"),
]
