"""Signature rules of the license scan.

A rule is a regular expression over the words of a text (lower case, one space
between words).  Rules come in families of different priority: an identifier
tag or a whole notice says more than an address, and that more than a name.
Every license below gives one rule per family; ``NOTICES`` are written out.
"""

from __future__ import annotations

from typing import NamedTuple

TAG, NOTICE, ADDRESS, NAME = 4, 3, 2, 1
CONFIDENCE = {TAG: 1.0, NOTICE: 0.95, ADDRESS: 0.85, NAME: 0.6}

V = r"(?: version| v)?"  # before a version number


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str  # a text without it is not searched
    pattern: str


# label, keyword, identifier words, name, address (words of the usual URL)
LICENSES: list[tuple[str, str, str, str, str]] = [
    ("mit", "mit", "mit", r"(?:x11 style )?mit licen[cs]e", "opensource org licenses mit"),
    ("mit-0", "attribution", "mit 0", "mit no attribution(?: licen[cs]e)?", "opensource org licenses mit 0"),
    ("x11", "x11", "x11", "x11 licen[cs]e", "spdx org licenses x11"),
    ("apache-1", "apache", r"apache 1 [01]", rf"apache (?:software )?licen[cs]e{V} 1(?: [01])?", "apache org licenses license 1"),
    ("apache-2", "apache", "apache 2 0", rf"apache (?:software )?(?:licen[cs]e{V} 2|2(?: 0)? licen[cs]e)(?: 0)?", "apache org licenses license 2 0"),
    ("bsd-0-clause", "clause bsd", "0bsd", "(?:zero clause|0 clause) bsd(?: licen[cs]e)?", "opensource org licenses 0bsd"),
    ("bsd-1-clause", "bsd", "bsd 1 clause", "(?:bsd 1 clause|1 clause bsd)(?: licen[cs]e)?", "spdx org licenses bsd 1 clause"),
    ("bsd-2-clause", "bsd", "bsd 2 clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[cs]e)?", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", "bsd 3 clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", "bsd 4 clause", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)?", "spdx org licenses bsd 4 clause"),
    ("bsd-patent", "patent", "bsd 2 clause patent", "bsd(?: 2 clause)? (?:plus patent|patent licen[cs]e)", "opensource org licenses bsdpluspatent"),
    ("isc", "isc", "isc", "isc licen[cs]e", "opensource org licenses isc"),
    ("zlib", "zlib", "zlib", "zlib(?: libpng)? licen[cs]e", "opensource org licenses zlib"),
    ("libpng", "png", r"libpng(?: 2 0)?", "(?:libpng|png reference library) licen[cs]e", "libpng org pub png src libpng license"),
    ("boost-1", "boost", "bsl 1 0", rf"boost software licen[cs]e(?:{V} 1(?: 0)?)?", "boost org license 1 0"),
    ("gpl-1", "1", r"gpl 1 0(?: only| or later)?", rf"(?:gnu )?(?:general public licen[cs]e|gpl){V} 1(?: 0)?", "gnu org licenses old licenses gpl 1 0"),
    ("gpl-2", "2", r"gpl 2 0(?: only| or later)?", rf"(?:gnu )?(?:general public licen[cs]e|gpl){V} ?2(?: 0)?", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3", "3", r"gpl 3 0(?: only| or later)?", rf"(?:gnu )?(?:general public licen[cs]e|gpl){V} ?3(?: 0)?", "gnu org licenses gpl 3 0"),
    ("gpl", "gnu", r"gpl", r"gnu (?:general public licen[cs]e|gpl)", "gnu org (?:licenses|copyleft) gpl"),
    ("lgpl-2", "2", r"lgpl 2 0(?: only| or later)?", rf"(?:gnu )?(?:library general public licen[cs]e|lgpl){V} ?2(?: 0)?(?! 1)", "gnu org licenses old licenses lgpl 2 0"),
    ("lgpl-2.1", "2", r"lgpl 2 1(?: only| or later)?", rf"(?:gnu )?(?:lesser general public licen[cs]e|lgpl){V} ?2 1", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3", "3", r"lgpl 3 0(?: only| or later)?", rf"(?:gnu )?(?:lesser general public licen[cs]e|lgpl){V} ?3(?: 0)?", "gnu org licenses lgpl 3 0"),
    ("lgpl", "l", r"lgpl", r"gnu (?:(?:lesser|library) general public licen[cs]e|lgpl)", "gnu org (?:licenses|copyleft) (?:lgpl|lesser)"),
    ("agpl-1", "affero", r"agpl 1 0(?: only| or later)?", rf"affero general public licen[cs]e{V} 1(?: 0)?", "affero org oagpl"),
    ("agpl-3", "a", r"agpl 3 0(?: only| or later)?", rf"(?:gnu )?(?:affero general public licen[cs]e|agpl){V} ?3(?: 0)?", "gnu org licenses agpl 3 0"),
    ("agpl", "a", r"agpl", r"gnu (?:affero general public licen[cs]e|agpl)", "gnu org licenses agpl"),
    ("gfdl-1.1", "1 1", r"gfdl 1 1(?: only| or later)?", rf"(?:gnu )?free documentation licen[cs]e{V} 1 1", "gnu org licenses old licenses fdl 1 1"),
    ("gfdl-1.2", "1 2", r"gfdl 1 2(?: only| or later)?", rf"(?:gnu )?free documentation licen[cs]e{V} 1 2", "gnu org licenses old licenses fdl 1 2"),
    ("gfdl-1.3", "1 3", r"gfdl 1 3(?: only| or later)?", rf"(?:gnu )?free documentation licen[cs]e{V} 1 3", "gnu org licenses fdl 1 3"),
    ("gfdl", "documentation", r"gfdl", r"gnu free documentation licen[cs]e", "gnu org (?:licenses|copyleft) fdl"),
    ("mpl-1.0", "mozilla", "mpl 1 0", rf"mozilla public licen[cs]e{V} 1(?: 0)?(?! 1)", "mozilla org mpl 1 0"),
    ("mpl-1.1", "mozilla", "mpl 1 1", rf"mozilla public licen[cs]e{V} 1 1", "mozilla org mpl 1 1"),
    ("mpl-2.0", "mozilla", "mpl 2 0", rf"mozilla public licen[cs]e{V} 2(?: 0)?", "mozilla org mpl 2 0"),
    ("epl-1.0", "eclipse", "epl 1 0", rf"eclipse public licen[cs]e{V} 1(?: 0)?", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", "epl 2 0", rf"eclipse public licen[cs]e{V} 2(?: 0)?", "eclipse org legal epl (?:2 0|v20)"),
    ("edl-1.0", "eclipse", "edl 1 0", rf"eclipse distribution licen[cs]e(?:{V} 1(?: 0)?)?", "eclipse org org documents edl v10"),
    ("cddl-1.0", "distribution", "cddl 1 0", rf"common development and distribution licen[cs]e{V} 1 0", "opensource org licenses cddl 1 0"),
    ("cddl-1.1", "distribution", "cddl 1 1", rf"common development and distribution licen[cs]e{V} 1 1", "glassfish java net public cddl"),
    ("cddl", "distribution", "cddl", "common development and distribution licen[cs]e", "opensource org licenses cddl"),
    ("cpl-1.0", "common", "cpl 1 0", rf"common public licen[cs]e(?:{V} 1(?: 0)?)?", "opensource org licenses cpl 1 0"),
    ("ipl-1.0", "ibm", "ipl 1 0", rf"ibm public licen[cs]e(?:{V} 1(?: 0)?)?", "opensource org licenses ipl 1 0"),
    ("artistic-1", "artistic", r"artistic 1 0(?: perl| cl8)?", rf"artistic licen[cs]e{V} 1(?: 0)?", "opensource org licenses artistic license 1 0"),
    ("artistic-2", "artistic", "artistic 2 0", rf"artistic licen[cs]e{V} 2(?: 0)?", "opensource org licenses artistic license 2 0"),
    ("artistic", "artistic", "artistic", "(?:perl )?artistic licen[cs]e", "dev perl org licenses artistic"),
    ("python-2", "python", r"(?:python|psf) 2 0", r"python (?:software foundation )?licen[cs]e(?: version)?(?: 2(?: 0)?)?", "python org psf license"),
    ("php-3", "php", r"php 3 0[01]?", rf"php licen[cs]e(?:{V} 3 0[01]?)?", "php net license 3 0"),
    ("ruby", "ruby", "ruby", "ruby(?: s)? licen[cs]e", "ruby lang org (?:en|ja) license"),
    ("postgresql", "postgresql", "postgresql", "postgresql licen[cs]e", "opensource org licenses postgresql"),
    ("openssl", "openssl", "openssl", "openssl licen[cs]e", "openssl org source license"),
    ("curl", "curl", "curl", "curl licen[cs]e", "curl (?:haxx )?se docs copyright"),
    ("ofl-1.0", "font", "ofl 1 0", rf"(?:sil )?open font licen[cs]e{V} 1 0", "scripts sil org ofl10"),
    ("ofl-1.1", "font", r"ofl 1 1(?: rfn| no rfn)?", rf"(?:sil )?open font licen[cs]e(?:{V} 1 1)?", "scripts sil org ofl"),
    ("unlicense", "unlicen", "unlicense", "(?:the )?unlicen[cs]e", "unlicense org"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl(?: version 2)?", "wtfpl net"),
    ("beerware", "beer", "beerware", "beer ?ware licen[cs]e", "people freebsd org phk"),
    ("afl-3", "academic", r"afl 3 0", rf"academic free licen[cs]e(?:{V} [123](?: [01])?)?", "opensource org licenses afl 3 0"),
    ("osl-3", "open", r"osl 3 0", rf"open software licen[cs]e(?:{V} [123](?: [01])?)?", "opensource org licenses osl 3 0"),
    ("ecl-2", "educational", r"ecl 2 0", rf"educational community licen[cs]e(?:{V} [12](?: 0)?)?", "opensource org licenses ecl 2 0"),
    ("eupl-1.1", "european", "eupl 1 1", rf"european union public licen[cs]e{V} 1 1", "joinup ec europa eu software page eupl"),
    ("eupl-1.2", "european", "eupl 1 2", rf"european union public licen[cs]e(?:{V} 1 2)?", "joinup ec europa eu collection eupl"),
    ("ms-pl", "microsoft", "ms pl", "microsoft public licen[cs]e", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", "ms rl", "microsoft reciprocal licen[cs]e", "opensource org licenses ms rl"),
    ("ncsa", "ncsa", "ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e", "opensource org licenses ncsa"),
    ("upl-1.0", "universal", "upl 1 0", rf"universal permissive licen[cs]e(?:{V} 1 0)?", "oss oracle com licenses upl"),
    ("vim", "vim", "vim", "vim licen[cs]e", "vimdoc sourceforge net htmldoc uganda"),
    ("w3c", "w3c", "w3c", "w3c (?:software notice and )?licen[cs]e", "w3 org consortium legal"),
    ("qpl-1.0", "q", "qpl 1 0", rf"q public licen[cs]e(?:{V} 1 0)?", "opensource org licenses qpl 1 0"),
    ("sspl-1", "server", "sspl 1 0", rf"server side public licen[cs]e(?:{V} 1)?", "mongodb com licensing server side public license"),
    ("busl-1.1", "business", "busl 1 1", rf"business source licen[cs]e(?:{V} 1 1)?", "mariadb com bsl11"),
    ("elastic-2", "elastic", "elastic 2 0", rf"elastic licen[cs]e(?:{V} 2(?: 0)?)?", "elastic co licensing elastic license"),
    ("odbl-1.0", "database", "odbl 1 0", rf"open (?:data commons open )?database licen[cs]e(?:{V} 1 0)?", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "commons", "odc by 1 0", "open data commons attribution licen[cs]e", "opendatacommons org licenses by"),
    ("pddl-1.0", "public", "pddl 1 0", "public domain dedication and licen[cs]e", "opendatacommons org licenses pddl"),
    ("ogl-uk", "government", r"ogl uk [123] 0", rf"open government licen[cs]e(?:{V} [123](?: 0)?)?", "nationalarchives gov uk doc open government licence"),
    ("cc0", "0", r"cc0 1 0", r"cc0(?: 1 0)?(?: universal)?", "creativecommons org publicdomain zero"),
    ("cc-pdm", "public", "cc pdm 1 0", "public domain mark(?: 1 0)?", "creativecommons org publicdomain mark"),
    ("cc-by", "cc by", r"cc by [1-4] [05]", r"cc by(?! (?:nc|sa|nd))(?: [1-4] [05])?", "creativecommons org licenses by [1-4]"),
    ("cc-by-sa", "cc by sa", r"cc by sa [1-4] [05]", r"cc by sa(?: [1-4] [05])?", "creativecommons org licenses by sa"),
    ("cc-by-nd", "cc by nd", r"cc by nd [1-4] [05]", r"cc by nd(?: [1-4] [05])?", "creativecommons org licenses by nd"),
    ("cc-by-nc", "cc by nc", r"cc by nc [1-4] [05]", r"cc by nc(?! (?:sa|nd))(?: [1-4] [05])?", "creativecommons org licenses by nc [1-4]"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa [1-4] [05]", r"cc by nc sa(?: [1-4] [05])?", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd [1-4] [05]", r"cc by nc nd(?: [1-4] [05])?", "creativecommons org licenses by nc nd"),
]

# Other names of the same licenses: label, keyword, name.
NAMES: list[tuple[str, str, str]] = [
    ("mit", "expat", "expat licen[cs]e"),
    ("bsd-2-clause", "freebsd", "freebsd licen[cs]e"),
    ("wtfpl", "do what the", "do what the [a-z]+ you want to public licen[cs]e"),
    ("cc-by", "commons attribution", "creative commons attribution(?! (?:non|share|no))(?: [1-4] [05])?"),
    ("cc-by-sa", "commons attribution", "creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nd", "commons attribution", "creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("cc-by-nc", "commons attribution", "creative commons attribution non ?commercial(?! (?:share|no))(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "commons attribution", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "commons attribution", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("cc0", "zero", "(?:cc zero|creative commons zero)(?: 1 0)?(?: universal)?"),
]

# Notices and clauses that name no license, or that are licenses' own words.
NOTICES: list[Rule] = [
    Rule("mit", NOTICE, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Rule("mit", NOTICE, "without restriction", r"to deal in the software without restriction"),
    Rule("isc", NOTICE, "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Rule("bsd", NAME, "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    Rule("bsd-3-clause", NOTICE, "endorse or promote", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    Rule("bsd-4-clause", NOTICE, "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledg"),
    Rule("apache-2", NOTICE, "apache", r"licensed under the apache licen[cs]e version 2 0 the licen[cs]e"),
    Rule("apache-2", NOTICE, "compliance with the license", r"you may not use this file except in compliance with the license"),
    Rule("gpl", NOTICE, "redistribute it and or modify", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    Rule("lgpl", NOTICE, "redistribute it and or modify", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e"),
    Rule("agpl", NOTICE, "redistribute it and or modify", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
    Rule("gfdl", NOTICE, "free documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    Rule("mpl-2.0", NOTICE, "mozilla", r"subject to the terms of the mozilla public licen[cs]e v 2 0"),
    Rule("zlib", NOTICE, "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    Rule("unlicense", NOTICE, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    Rule("boost-1", NOTICE, "boost", r"distributed under the boost software licen[cs]e version 1 0"),
    Rule("public-domain", NOTICE, "public domain", r"(?:released|placed|dedicated) (?:in)?to the public domain"),
    Rule("public-domain", NAME, "public domain", r"(?:in|is) the public domain"),
    Rule("proprietary", NOTICE, "all rights reserved", r"copyright (?:c )?[0-9]{4}(?: [0-9]{4})? [^ ]+(?: [^ ]+){0,6} all rights reserved"),
    Rule("proprietary", NAME, "all rights reserved", r"all rights reserved"),
    Rule("proprietary", NOTICE, "confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    Rule("proprietary", NOTICE, "strictly prohibited", r"(?:unauthori[sz]ed )?(?:copying|reproduction|redistribution)(?: [^ ]+){0,8} (?:is )?strictly prohibited"),
    Rule("see-license", NAME, "see", r"see (?:the )?(?:accompanying )?licen[cs]e(?: md| txt| file)? for (?:details|more information|the full licen[cs]e text)"),
    Rule("dual", NOTICE, "dual", r"dual licen[cs]ed under"),
]

_GRANT = (r"(?:(?:dual )?licen[cs]ed|released|distributed|available|published|provided|covered"
          r"|made available) under (?:the )?(?:terms of )?(?:the )?")


def rules() -> list[Rule]:
    """All rules, the strongest families first."""
    out = list(NOTICES)
    for label, keyword, tag, name, address in LICENSES:
        out += [Rule(label, TAG, "spdx", rf"spdx licen[cs]e identifier {tag}"),
                Rule(label, NOTICE, "under", rf"{_GRANT}(?:gnu )?{name}"),
                Rule(label, ADDRESS, address.split(" (")[0].split("[")[0].strip(), address),
                Rule(label, NAME, keyword, name)]
    for label, keyword, name in NAMES:
        out += [Rule(label, NOTICE, "under", rf"{_GRANT}{name}"), Rule(label, NAME, keyword, name)]
    return sorted(out, key=lambda r: -r.priority)
