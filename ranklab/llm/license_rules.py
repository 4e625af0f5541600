"""The license rules, each written by hand: (label, priority, keywords, pattern).

A pattern is a regex over lower-case words joined by single blanks (`GPL-2.0` is `gpl 2 0`,
`GPLv3` is `gplv3`); it begins and ends at word borders. Each match holds one of the
rule's keywords as a word (a test derives texts from every pattern and checks this).
NOT_A_VERSION keeps rules without a version off names that go on with one.
"""

from __future__ import annotations

TAG = 90        # a machine-readable tag
NOTICE = 80     # a sentence that grants under a named license
BODY = 70       # a sentence of the license itself
CLAIM = 60      # a statement about rights
NAME = 50       # the license's full name
SHORT = 40      # its identifier or a short form
MENTION = 30

NOT_A_VERSION = r"(?! (?:v ?|version )?[0-9])"
V = NOT_A_VERSION

PERMISSIVE = [
    # Apache
    ("apache-2.0", TAG, "spdx", r"spdx license identifier apache 2 0"),
    ("apache-2.0", NOTICE, "apache", r"licen[cs]ed under (?:the )?(?:terms of the )?apache (?:software )?licen[cs]e (?:version )?v?2(?: 0)?"),
    ("apache-2.0", NOTICE, "compliance", r"you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", NAME, "apache", r"apache (?:software )?licen[cs]e (?:version )?v?2(?: 0)?"),
    ("apache-2.0", NAME, "apache", r"apache software foundation licen[cs]e (?:version )?2(?: 0)?"),
    ("apache-2.0", SHORT, "apache", r"apache v?2 0(?: licen[cs]e)?"),
    ("apache-2.0", SHORT, "apache2 apachev2", r"(?:apache2|apachev2)(?: 0)?(?: licen[cs]e)?"),
    ("apache-2.0", SHORT, "asl", r"asl v?2(?: 0)?"),
    ("apache-2.0", SHORT, "apache", r"apache org licenses license 2 0"),
    ("apache-2.0", BODY, "irrevocable", r"perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-2.0", BODY, "basis", r"agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-1.1", NAME, "apache", r"apache (?:software )?licen[cs]e (?:version )?v?1 1"),
    ("apache-1.0", NAME, "apache", r"apache (?:software )?licen[cs]e (?:version )?v?1 0"),
    ("apache-1.1", SHORT, "apache", r"apache 1 1"),
    ("apache", NAME, "apache", r"apache (?:software )?licen[cs]e" + V),
    ("apache", NOTICE, "apache", r"licen[cs]ed to the apache software foundation"),
    # MIT and its kin
    ("mit", TAG, "mit", r"spdx license identifier mit(?! 0)"),
    ("mit", NOTICE, "mit", r"licen[cs]ed under (?:the )?(?:terms of the )?mit(?: licen[cs]e)?"),
    ("mit", NOTICE, "mit", r"(?:released|distributed|available) under (?:the )?(?:terms of the )?mit licen[cs]e"),
    ("mit", NAME, "mit", r"(?:the )?mit licen[cs]e"),
    ("mit", NAME, "expat", r"expat licen[cs]e"),
    ("mit", NAME, "mit", r"mit x11 licen[cs]e"),
    ("mit", SHORT, "mit", r"licen[cs]e mit"),
    ("mit", BODY, "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", BODY, "sublicense", r"the rights to use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", BODY, "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("mit-0", TAG, "mit", r"spdx license identifier mit 0"),
    ("mit-0", NAME, "attribution", r"mit no attribution(?: licen[cs]e)?"),
    ("x11", NAME, "x11", r"x11 licen[cs]e"),
    ("x11", BODY, "consortium", r"the name of the x consortium shall not be used in advertising"),
    ("mit-modern", NAME, "modern", r"mit licen[cs]e modern variant"),
    # BSD
    ("bsd-2-clause", TAG, "bsd", r"spdx license identifier bsd 2 clause"),
    ("bsd-3-clause", TAG, "bsd", r"spdx license identifier bsd 3 clause"),
    ("bsd-2-clause", NAME, "bsd", r"(?:2|two) clause bsd(?: licen[cs]e)?"),
    ("bsd-3-clause", NAME, "bsd", r"(?:3|three) clause bsd(?: licen[cs]e)?"),
    ("bsd-4-clause", NAME, "bsd", r"(?:4|four) clause bsd(?: licen[cs]e)?"),
    ("bsd-2-clause", SHORT, "bsd", r"bsd 2 clause(?: licen[cs]e)?"),
    ("bsd-3-clause", SHORT, "bsd", r"bsd 3 clause(?: licen[cs]e)?"),
    ("bsd-4-clause", SHORT, "bsd", r"bsd 4 clause(?: licen[cs]e)?"),
    ("bsd-2-clause", NAME, "bsd", r"(?:simplified|freebsd) bsd licen[cs]e"),
    ("bsd-3-clause", NAME, "bsd", r"(?:new|revised|modified) bsd licen[cs]e"),
    ("bsd-4-clause", NAME, "bsd", r"(?:original|old) bsd licen[cs]e"),
    ("bsd", NOTICE, "bsd", r"licen[cs]ed under (?:the )?(?:terms of the )?bsd(?: style)? licen[cs]e"),
    ("bsd", NOTICE, "bsd", r"use of this source code is governed by a bsd style licen[cs]e"),
    ("bsd", NAME, "bsd", r"bsd(?: style)? licen[cs]e"),
    ("bsd", SHORT, "bsd", r"licen[cs]e bsd"),
    ("bsd", BODY, "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd", BODY, "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", BODY, "redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", BODY, "endorse", r"may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", BODY, "advertising", r"all advertising materials mentioning features or use of this software"),
    ("0bsd", TAG, "0bsd", r"spdx license identifier 0bsd"),
    ("0bsd", NAME, "bsd", r"(?:zero|0) clause bsd(?: licen[cs]e)?"),
    ("0bsd", SHORT, "0bsd", r"0bsd"),
    ("bsd-patent", NAME, "patent", r"bsd (?:2 clause )?plus patent(?: licen[cs]e)?"),
    # short permissive ones
    ("isc", TAG, "isc", r"spdx license identifier isc"),
    ("isc", NAME, "isc", r"isc licen[cs]e"),
    ("isc", NAME, "consortium", r"internet (?:software|systems) consortium licen[cs]e"),
    ("isc", BODY, "permission", r"permission to use copy modify and (?:or )?distribute this software for any purpose"),
    ("zlib", TAG, "zlib", r"spdx license identifier zlib"),
    ("zlib", NAME, "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("zlib", BODY, "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", BODY, "altered", r"altered source versions must be plainly marked as such"),
    ("libpng", NAME, "libpng", r"libpng licen[cs]e"),
    ("boost-1.0", TAG, "bsl", r"spdx license identifier bsl 1 0"),
    ("boost-1.0", NAME, "boost", r"boost software licen[cs]e (?:version )?1 0"),
    ("boost-1.0", NOTICE, "boost", r"distributed under the boost software licen[cs]e"),
    ("boost", NAME, "boost", r"boost software licen[cs]e" + V),
    ("unlicense", TAG, "unlicense", r"spdx license identifier unlicense"),
    ("unlicense", NAME, "unlicense", r"the unlicense"),
    ("unlicense", SHORT, "unlicense", r"licen[cs]e unlicense"),
    ("unlicense", SHORT, "unlicense", r"unlicense org"),
    ("unlicense", BODY, "unencumbered", r"free and unencumbered software released into the public domain"),
    ("wtfpl", TAG, "wtfpl", r"spdx license identifier wtfpl"),
    ("wtfpl", NAME, "fuck", r"do what the fuck you want to public licen[cs]e"),
    ("wtfpl", SHORT, "wtfpl", r"wtfpl(?: v?2)?"),
    ("ncsa", TAG, "ncsa", r"spdx license identifier ncsa"),
    ("ncsa", NAME, "ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e"),
    ("postgresql", TAG, "postgresql", r"spdx license identifier postgresql"),
    ("postgresql", NAME, "postgresql", r"postgresql licen[cs]e"),
    ("openssl", NAME, "openssl", r"openssl licen[cs]e"),
    ("openssl", BODY, "openssl", r"developed by the openssl project for use in the openssl toolkit"),
    ("php-3.01", NAME, "php", r"php licen[cs]e (?:version )?3 01"),
    ("php", NAME, "php", r"php licen[cs]e" + V),
    ("w3c", NAME, "w3c", r"w3c software (?:notice )?(?:and (?:document )?)?licen[cs]e"),
    ("curl", NAME, "curl", r"curl licen[cs]e"),
    ("tcl", NAME, "tcl", r"tcl tk licen[cs]e"),
    ("unicode", NAME, "unicode", r"unicode (?:inc )?licen[cs]e agreement"),
    ("icu", NAME, "icu", r"icu licen[cs]e"),
    ("ijg", BODY, "jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", NAME, "freetype", r"freetype (?:project )?licen[cs]e"),
    ("imagemagick", NAME, "imagemagick", r"imagemagick licen[cs]e"),
    ("info-zip", NAME, "zip", r"info zip licen[cs]e"),
    ("bzip2", NAME, "bzip2", r"bzip2 licen[cs]e"),
    ("vim", NAME, "vim", r"vim licen[cs]e"),
    ("zope-2.1", NAME, "zope", r"zope public licen[cs]e (?:version )?2 1"),
    ("zope", NAME, "zope", r"zope public licen[cs]e" + V),
    ("beerware", NAME, "beerware beer", r"(?:the )?(?:beerware|beer ware) licen[cs]e"),
    ("beerware", BODY, "beer", r"you can buy me a beer in return"),
    ("upl-1.0", NAME, "universal", r"universal permissive licen[cs]e(?: (?:version |v ?)?1 0)?"),
    ("blueoak-1.0", NAME, "oak", r"blue oak model licen[cs]e(?: 1 0 0)?"),
    ("mulan-2.0", NAME, "mulan", r"mulan (?:permissive software|psl) (?:licen[cs]e )?v2"),
    ("ecl-2.0", NAME, "educational", r"educational community licen[cs]e(?: version)? 2 0"),
    ("afl-3.0", NAME, "academic", r"academic free licen[cs]e (?:version |v ?)?3 0"),
    ("afl", NAME, "academic", r"academic free licen[cs]e" + V),
    ("fair", NAME, "fair", r"the fair licen[cs]e"),
    ("json", BODY, "evil", r"the software shall be used for good not evil"),
    ("python-2.0", NAME, "python", r"python software foundation licen[cs]e (?:version )?2(?: 0)?"),
    ("python", NAME, "python", r"python software foundation licen[cs]e" + V),
    ("python-2.0", SHORT, "psf", r"psf (?:licen[cs]e )?(?:version )?2(?: 0)?"),
    ("python", SHORT, "psf", r"psf licen[cs]e" + V),
    ("artistic-1.0", TAG, "artistic", r"spdx license identifier artistic 1 0"),
    ("artistic-2.0", TAG, "artistic", r"spdx license identifier artistic 2 0"),
    ("artistic-1.0", NAME, "artistic", r"artistic licen[cs]e (?:version )?1 0"),
    ("artistic-2.0", NAME, "artistic", r"artistic licen[cs]e (?:version )?v?2(?: 0)?"),
    ("artistic", NAME, "artistic", r"(?:perl )?artistic licen[cs]e" + V),
    ("perl", NOTICE, "perl", r"under the same terms as perl(?: itself)?"),
    ("ruby", NAME, "ruby", r"ruby licen[cs]e"),
    ("ruby", NOTICE, "ruby", r"under the same terms as ruby(?: itself)?"),
]

COPYLEFT = [
    # GPL
    ("gpl-1.0", TAG, "gpl", r"spdx license identifier gpl 1 0(?: only)?"),
    ("gpl-2.0", TAG, "gpl", r"spdx license identifier gpl 2 0(?: only)?"),
    ("gpl-3.0", TAG, "gpl", r"spdx license identifier gpl 3 0(?: only)?"),
    ("gpl-1.0-or-later", TAG, "gpl", r"spdx license identifier gpl 1 0 or later"),
    ("gpl-2.0-or-later", TAG, "gpl", r"spdx license identifier gpl 2 0 or later"),
    ("gpl-3.0-or-later", TAG, "gpl", r"spdx license identifier gpl 3 0 or later"),
    ("gpl", NOTICE, "gpl", r"licen[cs]ed under (?:the )?(?:terms of the )?(?:gnu )?gpl" + V),
    ("gpl", NOTICE, "public", r"licen[cs]ed under (?:the )?(?:terms of the )?(?:gnu )?general public licen[cs]e" + V),
    ("gpl", NOTICE, "gpl", r"(?:released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?gpl" + V),
    ("gpl-1.0", NAME, "public", r"(?:gnu )?general public licen[cs]e (?:version |v ?)1(?: 0)?"),
    ("gpl-2.0", NAME, "public", r"(?:gnu )?general public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("gpl-3.0", NAME, "public", r"(?:gnu )?general public licen[cs]e (?:version |v ?)?3(?: 0)?"),
    ("gpl-2.0-or-later", NAME, "public", r"(?:gnu )?general public licen[cs]e (?:version |v ?)?2(?: 0)? or (?:at your option )?(?:any )?later(?: version)?"),
    ("gpl-3.0-or-later", NAME, "public", r"(?:gnu )?general public licen[cs]e (?:version |v ?)?3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?"),
    ("gpl-2.0-or-later", NOTICE, "version", r"either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", NOTICE, "version", r"either version 3 of the license or at your option any later version"),
    ("gpl-1.0-or-later", NOTICE, "version", r"either version 1 of the license or at your option any later version"),
    ("gpl-2.0-or-later", NOTICE, "gpl gplv2", r"(?:gpl version 2|gpl v2|gplv2) or (?:any )?later(?: version)?"),
    ("gpl-3.0-or-later", NOTICE, "gpl gplv3", r"(?:gpl version 3|gpl v3|gplv3) or (?:any )?later(?: version)?"),
    ("gpl-1.0", SHORT, "gpl gplv1", r"(?:gplv1|gpl (?:version |v ?)?1)(?: 0)?(?: only)?"),
    ("gpl-2.0", SHORT, "gpl gplv2 gpl2", r"(?:gplv2|gpl2|gpl (?:version |v ?)?2)(?: 0)?(?: only)?(?: licen[cs]e)?"),
    ("gpl-3.0", SHORT, "gpl gplv3 gpl3", r"(?:gplv3|gpl3|gpl (?:version |v ?)?3)(?: 0)?(?: only)?(?: licen[cs]e)?"),
    ("gpl-2.0-or-later", SHORT, "gpl", r"gpl 2 0 or later"),
    ("gpl-3.0-or-later", SHORT, "gpl", r"gpl 3 0 or later"),
    ("gpl", NAME, "gpl", r"(?:gnu )?gpl licen[cs]e" + V),
    ("gpl", NAME, "gpl", r"gnu gpl" + V),
    ("gpl", NAME, "public", r"gnu general public licen[cs]e" + V),
    ("gpl", SHORT, "gpl", r"licen[cs]e gpl" + V),
    ("gpl", BODY, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("gpl", BODY, "warranty", r"without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e"),
    ("gpl", BODY, "freedom", r"designed to take away your freedom to share and change"),
    # LGPL
    ("lgpl-2.0", TAG, "lgpl", r"spdx license identifier lgpl 2 0(?: only)?"),
    ("lgpl-2.1", TAG, "lgpl", r"spdx license identifier lgpl 2 1(?: only)?"),
    ("lgpl-3.0", TAG, "lgpl", r"spdx license identifier lgpl 3 0(?: only)?"),
    ("lgpl-2.1-or-later", TAG, "lgpl", r"spdx license identifier lgpl 2 1 or later"),
    ("lgpl-3.0-or-later", TAG, "lgpl", r"spdx license identifier lgpl 3 0 or later"),
    ("lgpl", NOTICE, "lgpl", r"licen[cs]ed under (?:the )?(?:terms of the )?(?:gnu )?lgpl" + V),
    ("lgpl", NOTICE, "lesser", r"licen[cs]ed under (?:the )?(?:terms of the )?(?:gnu )?lesser general public licen[cs]e" + V),
    ("lgpl-2.0", NAME, "library", r"(?:gnu )?library general public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("lgpl-2.1", NAME, "lesser", r"(?:gnu )?lesser general public licen[cs]e (?:version |v ?)?2 1"),
    ("lgpl-3.0", NAME, "lesser", r"(?:gnu )?lesser general public licen[cs]e (?:version |v ?)?3(?: 0)?"),
    ("lgpl-2.1-or-later", NAME, "lesser", r"(?:gnu )?lesser general public licen[cs]e (?:version |v ?)?2 1 or (?:at your option )?(?:any )?later(?: version)?"),
    ("lgpl-3.0-or-later", NAME, "lesser", r"(?:gnu )?lesser general public licen[cs]e (?:version |v ?)?3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?"),
    ("lgpl-2.1-or-later", NOTICE, "version", r"either version 2 1 of the license or at your option any later version"),
    ("lgpl-2.0", SHORT, "lgpl lgplv2", r"(?:lgplv2|lgpl (?:version |v ?)?2)(?: 0)?(?! [0-9])"),
    ("lgpl-2.1", SHORT, "lgpl lgplv2", r"(?:lgplv2|lgpl (?:version |v ?)?2) 1(?: only)?(?: licen[cs]e)?"),
    ("lgpl-3.0", SHORT, "lgpl lgplv3 lgpl3", r"(?:lgplv3|lgpl3|lgpl (?:version |v ?)?3)(?: 0)?(?: only)?(?: licen[cs]e)?"),
    ("lgpl-2.1-or-later", SHORT, "lgpl", r"lgpl 2 1 or later"),
    ("lgpl-3.0-or-later", SHORT, "lgpl", r"lgpl 3 0 or later"),
    ("lgpl", NAME, "lgpl", r"(?:gnu )?lgpl licen[cs]e" + V),
    ("lgpl", NAME, "lgpl", r"gnu lgpl" + V),
    ("lgpl", NAME, "lesser library", r"(?:gnu )?(?:lesser|library) general public licen[cs]e" + V),
    ("lgpl", BODY, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e"),
    # AGPL
    ("agpl-3.0", TAG, "agpl", r"spdx license identifier agpl 3 0(?: only)?"),
    ("agpl-3.0-or-later", TAG, "agpl", r"spdx license identifier agpl 3 0 or later"),
    ("agpl", NOTICE, "agpl", r"licen[cs]ed under (?:the )?(?:terms of the )?(?:gnu )?agpl" + V),
    ("agpl-1.0", NAME, "affero", r"affero general public licen[cs]e (?:version |v ?)?1(?: 0)?"),
    ("agpl-3.0", NAME, "affero", r"(?:gnu )?affero general public licen[cs]e (?:version |v ?)?3(?: 0)?"),
    ("agpl-3.0-or-later", NAME, "affero", r"(?:gnu )?affero general public licen[cs]e (?:version |v ?)?3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?"),
    ("agpl-3.0", SHORT, "agpl agplv3 agpl3", r"(?:agplv3|agpl3|agpl (?:version |v ?)?3)(?: 0)?(?: only)?(?: licen[cs]e)?"),
    ("agpl-3.0-or-later", SHORT, "agpl", r"agpl 3 0 or later"),
    ("agpl", NAME, "agpl", r"(?:gnu )?agpl licen[cs]e" + V),
    ("agpl", NAME, "agpl", r"gnu agpl" + V),
    ("agpl", NAME, "affero", r"(?:gnu )?affero general public licen[cs]e" + V),
    ("agpl", BODY, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
    # exceptions to the GPL
    ("classpath-exception", TAG, "classpath", r"with classpath exception(?: 2 0)?"),
    ("classpath-exception", NAME, "classpath", r"classpath exception"),
    ("gcc-exception", TAG, "gcc", r"with gcc exception(?: 3 1| 2 0)?"),
    ("gcc-exception", NAME, "gcc", r"gcc runtime library exception"),
    ("linux-syscall-note", TAG, "syscall", r"with linux syscall note"),
    ("linking-exception", BODY, "exception", r"as a special exception (?:.{0,120}? )?permission to link"),
    ("font-exception", NAME, "font", r"(?:gpl )?font exception"),
    ("autoconf-exception", NAME, "autoconf", r"autoconf (?:configure script )?exception"),
    ("bison-exception", NAME, "bison", r"bison exception"),
    ("llvm-exception", TAG, "llvm", r"with llvm exceptions?"),
    # GNU documentation
    ("gfdl-1.1", NAME, "documentation", r"(?:gnu )?free documentation licen[cs]e (?:version |v ?)?1 1"),
    ("gfdl-1.2", NAME, "documentation", r"(?:gnu )?free documentation licen[cs]e (?:version |v ?)?1 2"),
    ("gfdl-1.3", NAME, "documentation", r"(?:gnu )?free documentation licen[cs]e (?:version |v ?)?1 3"),
    ("gfdl", NAME, "documentation", r"(?:gnu )?free documentation licen[cs]e" + V),
    ("gfdl-1.2", SHORT, "gfdl", r"gfdl 1 2"),
    ("gfdl-1.3", SHORT, "gfdl", r"gfdl 1 3"),
    ("gfdl", SHORT, "gfdl", r"gnu gfdl|gfdl licen[cs]e"),
    ("gfdl", BODY, "invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    # Mozilla, Eclipse, CDDL, EUPL and others
    ("mpl-1.0", TAG, "mpl", r"spdx license identifier mpl 1 0"),
    ("mpl-1.1", TAG, "mpl", r"spdx license identifier mpl 1 1"),
    ("mpl-2.0", TAG, "mpl", r"spdx license identifier mpl 2 0"),
    ("mpl-1.0", NAME, "mozilla", r"mozilla public licen[cs]e (?:version |v ?)?1 0"),
    ("mpl-1.1", NAME, "mozilla", r"mozilla public licen[cs]e (?:version |v ?)?1 1"),
    ("mpl-2.0", NAME, "mozilla", r"mozilla public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("mpl", NAME, "mozilla", r"mozilla public licen[cs]e" + V),
    ("mpl-1.0", SHORT, "mpl", r"mpl (?:version |v ?)?1 0"),
    ("mpl-1.1", SHORT, "mpl", r"mpl (?:version |v ?)?1 1"),
    ("mpl-2.0", SHORT, "mpl mplv2", r"(?:mplv2|mpl (?:version |v ?)?2)(?: 0)?"),
    ("mpl-2.0", NOTICE, "mozilla", r"subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("mpl", NOTICE, "mpl", r"licen[cs]ed under (?:the )?mpl" + V),
    ("mpl-2.0", BODY, "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one"),
    ("epl-1.0", TAG, "epl", r"spdx license identifier epl 1 0"),
    ("epl-2.0", TAG, "epl", r"spdx license identifier epl 2 0"),
    ("epl-1.0", NAME, "eclipse", r"eclipse public licen[cs]e (?:version |v ?)?1(?: 0)?"),
    ("epl-2.0", NAME, "eclipse", r"eclipse public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("epl", NAME, "eclipse", r"eclipse public licen[cs]e" + V),
    ("epl-1.0", SHORT, "epl", r"epl v?1 0"),
    ("epl-2.0", SHORT, "epl", r"epl v?2 0"),
    ("edl-1.0", NAME, "eclipse", r"eclipse distribution licen[cs]e(?: (?:version |v ?)?1 0)?"),
    ("cpl-1.0", NAME, "common", r"common public licen[cs]e(?: (?:version |v ?)?1 0)?"),
    ("ipl-1.0", NAME, "ibm", r"ibm public licen[cs]e(?: (?:version |v ?)?1 0)?"),
    ("cddl-1.0", NAME, "development", r"common development and distribution licen[cs]e (?:version |v ?)?1 0"),
    ("cddl-1.1", NAME, "development", r"common development and distribution licen[cs]e (?:version |v ?)?1 1"),
    ("cddl", NAME, "development", r"common development and distribution licen[cs]e" + V),
    ("cddl-1.0", SHORT, "cddl", r"cddl (?:version |v ?)?1 0"),
    ("cddl-1.1", SHORT, "cddl", r"cddl (?:version |v ?)?1 1"),
    ("cddl", SHORT, "cddl", r"licen[cs]ed under the cddl" + V),
    ("eupl-1.1", NAME, "european", r"european union public licen[cs]e (?:version |v ?)?1 1"),
    ("eupl-1.2", NAME, "european", r"european union public licen[cs]e (?:version |v ?)?1 2"),
    ("eupl", NAME, "european", r"european union public licen[cs]e" + V),
    ("eupl-1.1", SHORT, "eupl", r"eupl (?:version |v ?)?1 1"),
    ("eupl-1.2", SHORT, "eupl", r"eupl (?:version |v ?)?1 2"),
    ("osl-3.0", NAME, "open", r"open software licen[cs]e (?:version |v ?)?3 0"),
    ("osl-2.1", NAME, "open", r"open software licen[cs]e (?:version |v ?)?2 1"),
    ("osl", NAME, "open", r"open software licen[cs]e" + V),
    ("osl-3.0", SHORT, "osl", r"osl 3 0"),
    ("cecill-2.1", NAME, "cecill", r"cecill (?:free software )?(?:licen[cs]e )?(?:agreement )?(?:version |v ?)?2 1"),
    ("cecill-b", NAME, "cecill", r"cecill b(?: licen[cs]e)?"),
    ("cecill-c", NAME, "cecill", r"cecill c(?: licen[cs]e)?"),
    ("cecill", NAME, "cecill", r"cecill licen[cs]e"),
    ("ms-pl", NAME, "microsoft", r"microsoft public licen[cs]e"),
    ("ms-pl", SHORT, "ms", r"ms pl"),
    ("ms-rl", NAME, "microsoft", r"microsoft reciprocal licen[cs]e"),
    ("sleepycat", NAME, "sleepycat", r"sleepycat licen[cs]e"),
    ("apsl-2.0", NAME, "apple", r"apple public source licen[cs]e(?: (?:version )?2 0)?"),
    ("nasa-1.3", NAME, "nasa", r"nasa open source agreement(?: (?:version )?1 3)?"),
    ("cern-ohl", NAME, "cern", r"cern open hardware licen[cs]e(?: (?:version )?v?[12](?: 2)?)?"),
    ("qpl-1.0", NAME, "public", r"q public licen[cs]e(?: (?:version )?1 0)?"),
    ("rpl-1.5", NAME, "reciprocal", r"reciprocal public licen[cs]e(?: (?:version )?1 5)?"),
    ("npl-1.1", NAME, "netscape", r"netscape public licen[cs]e(?: (?:version )?1 1)?"),
]

CONTENT = [
    # Creative Commons: attribution
    ("cc-by-1.0", SHORT, "cc", r"cc by 1 0"),
    ("cc-by-2.0", SHORT, "cc", r"cc by 2 0"),
    ("cc-by-2.5", SHORT, "cc", r"cc by 2 5"),
    ("cc-by-3.0", SHORT, "cc", r"cc by 3 0(?: unported)?"),
    ("cc-by-4.0", SHORT, "cc", r"cc by 4 0(?: international)?"),
    ("cc-by-2.0", NAME, "creative", r"creative commons attribution (?:licen[cs]e )?(?:version )?2 0(?: generic)?(?: licen[cs]e)?"),
    ("cc-by-2.5", NAME, "creative", r"creative commons attribution (?:licen[cs]e )?(?:version )?2 5(?: generic)?(?: licen[cs]e)?"),
    ("cc-by-3.0", NAME, "creative", r"creative commons attribution (?:licen[cs]e )?(?:version )?3 0(?: unported)?(?: licen[cs]e)?"),
    ("cc-by-4.0", NAME, "creative", r"creative commons attribution (?:licen[cs]e )?(?:version )?4 0(?: international)?(?: licen[cs]e)?"),
    ("cc-by", NAME, "creative", r"creative commons attribution(?: licen[cs]e)?(?! (?:non|share|no|[0-9]))"),
    ("cc-by-4.0", TAG, "creativecommons", r"creativecommons org licenses by 4 0"),
    ("cc-by-3.0", TAG, "creativecommons", r"creativecommons org licenses by 3 0"),
    # share alike
    ("cc-by-sa-1.0", SHORT, "cc", r"cc by sa 1 0"),
    ("cc-by-sa-2.0", SHORT, "cc", r"cc by sa 2 0"),
    ("cc-by-sa-2.5", SHORT, "cc", r"cc by sa 2 5"),
    ("cc-by-sa-3.0", SHORT, "cc", r"cc by sa 3 0(?: unported)?"),
    ("cc-by-sa-4.0", SHORT, "cc", r"cc by sa 4 0(?: international)?"),
    ("cc-by-sa", SHORT, "cc", r"cc by sa" + V),
    ("cc-by-sa-2.0", NAME, "creative", r"creative commons attribution share ?alike (?:licen[cs]e )?(?:version )?2 0(?: generic)?(?: licen[cs]e)?"),
    ("cc-by-sa-3.0", NAME, "creative", r"creative commons attribution share ?alike (?:licen[cs]e )?(?:version )?3 0(?: unported)?(?: licen[cs]e)?"),
    ("cc-by-sa-4.0", NAME, "creative", r"creative commons attribution share ?alike (?:licen[cs]e )?(?:version )?4 0(?: international)?(?: licen[cs]e)?"),
    ("cc-by-sa", NAME, "creative", r"creative commons attribution share ?alike(?: licen[cs]e)?" + V),
    ("cc-by-sa-4.0", TAG, "creativecommons", r"creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", TAG, "creativecommons", r"creativecommons org licenses by sa 3 0"),
    # no derivatives
    ("cc-by-nd-2.0", SHORT, "cc", r"cc by nd 2 0"),
    ("cc-by-nd-3.0", SHORT, "cc", r"cc by nd 3 0(?: unported)?"),
    ("cc-by-nd-4.0", SHORT, "cc", r"cc by nd 4 0(?: international)?"),
    ("cc-by-nd", SHORT, "cc", r"cc by nd" + V),
    ("cc-by-nd-3.0", NAME, "creative", r"creative commons attribution no ?deriv(?:ative)?s (?:licen[cs]e )?(?:version )?3 0(?: unported)?(?: licen[cs]e)?"),
    ("cc-by-nd-4.0", NAME, "creative", r"creative commons attribution no ?deriv(?:ative)?s (?:licen[cs]e )?(?:version )?4 0(?: international)?(?: licen[cs]e)?"),
    ("cc-by-nd", NAME, "creative", r"creative commons attribution no ?deriv(?:ative)?s(?: licen[cs]e)?" + V),
    ("cc-by-nd-4.0", TAG, "creativecommons", r"creativecommons org licenses by nd 4 0"),
    # non-commercial
    ("cc-by-nc-2.0", SHORT, "cc", r"cc by nc 2 0"),
    ("cc-by-nc-3.0", SHORT, "cc", r"cc by nc 3 0(?: unported)?"),
    ("cc-by-nc-4.0", SHORT, "cc", r"cc by nc 4 0(?: international)?"),
    ("cc-by-nc", SHORT, "cc", r"cc by nc(?! (?:sa|nd|[0-9]))"),
    ("cc-by-nc-3.0", NAME, "creative", r"creative commons attribution non ?commercial (?:licen[cs]e )?(?:version )?3 0(?: unported)?(?: licen[cs]e)?"),
    ("cc-by-nc-4.0", NAME, "creative", r"creative commons attribution non ?commercial (?:licen[cs]e )?(?:version )?4 0(?: international)?(?: licen[cs]e)?"),
    ("cc-by-nc", NAME, "creative", r"creative commons attribution non ?commercial(?: licen[cs]e)?(?! (?:share|no|[0-9]))"),
    ("cc-by-nc-4.0", TAG, "creativecommons", r"creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa-2.0", SHORT, "cc", r"cc by nc sa 2 0"),
    ("cc-by-nc-sa-3.0", SHORT, "cc", r"cc by nc sa 3 0(?: unported)?"),
    ("cc-by-nc-sa-4.0", SHORT, "cc", r"cc by nc sa 4 0(?: international)?"),
    ("cc-by-nc-sa", SHORT, "cc", r"cc by nc sa" + V),
    ("cc-by-nc-sa-3.0", NAME, "creative", r"creative commons attribution non ?commercial share ?alike (?:version )?3 0(?: unported)?(?: licen[cs]e)?"),
    ("cc-by-nc-sa-4.0", NAME, "creative", r"creative commons attribution non ?commercial share ?alike (?:version )?4 0(?: international)?(?: licen[cs]e)?"),
    ("cc-by-nc-sa", NAME, "creative", r"creative commons attribution non ?commercial share ?alike(?: licen[cs]e)?" + V),
    ("cc-by-nc-sa-4.0", TAG, "creativecommons", r"creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-2.0", SHORT, "cc", r"cc by nc nd 2 0"),
    ("cc-by-nc-nd-3.0", SHORT, "cc", r"cc by nc nd 3 0(?: unported)?"),
    ("cc-by-nc-nd-4.0", SHORT, "cc", r"cc by nc nd 4 0(?: international)?"),
    ("cc-by-nc-nd", SHORT, "cc", r"cc by nc nd" + V),
    ("cc-by-nc-nd-3.0", NAME, "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s (?:version )?3 0(?: unported)?(?: licen[cs]e)?"),
    ("cc-by-nc-nd-4.0", NAME, "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s (?:version )?4 0(?: international)?(?: licen[cs]e)?"),
    ("cc-by-nc-nd", NAME, "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: licen[cs]e)?" + V),
    ("cc-by-nc-nd-4.0", TAG, "creativecommons", r"creativecommons org licenses by nc nd 4 0"),
    # zero
    ("cc0-1.0", TAG, "cc0", r"spdx license identifier cc0 1 0"),
    ("cc0-1.0", SHORT, "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", SHORT, "cc", r"cc zero"),
    ("cc0-1.0", NAME, "creative", r"creative commons (?:cc0|zero)(?: (?:version |v ?)?1 0)?(?: universal)?(?: licen[cs]e)?"),
    ("cc0-1.0", TAG, "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("cc-pdm", NAME, "mark", r"public domain mark(?: 1 0)?"),
    ("creative-commons", NOTICE, "creative", r"licen[cs]ed under (?:a |the )?creative commons licen[cs]e"),
    ("creative-commons", NAME, "creative", r"creative commons licen[cs]e"),
    # data, fonts, art, games
    ("odbl-1.0", TAG, "odbl", r"spdx license identifier odbl 1 0"),
    ("odbl-1.0", NAME, "database", r"open (?:data commons open )?database licen[cs]e(?: (?:version |v ?)?1 0)?"),
    ("odbl-1.0", SHORT, "odbl", r"odbl(?: v?1 0)?"),
    ("odc-by-1.0", NAME, "commons", r"open data commons attribution licen[cs]e(?: (?:version |v ?)?1 0)?"),
    ("pddl-1.0", NAME, "commons", r"open data commons public domain dedication and licen[cs]e"),
    ("cdla-permissive", NAME, "data", r"community data licen[cs]e agreement permissive(?: (?:version )?[12] 0)?"),
    ("cdla-sharing", NAME, "data", r"community data licen[cs]e agreement sharing(?: (?:version )?1 0)?"),
    ("ogl-uk-3.0", NAME, "government", r"open government licen[cs]e (?:version |v ?)?3 0"),
    ("ogl-uk", NAME, "government", r"open government licen[cs]e" + V),
    ("ofl-1.0", NAME, "font", r"(?:sil )?open font licen[cs]e (?:version |v ?)?1 0"),
    ("ofl-1.1", NAME, "font", r"(?:sil )?open font licen[cs]e (?:version |v ?)?1 1"),
    ("ofl", NAME, "font", r"(?:sil )?open font licen[cs]e" + V),
    ("ofl-1.1", SHORT, "ofl", r"ofl 1 1"),
    ("ofl", BODY, "font", r"this font software is licensed under the sil open font licen[cs]e"),
    ("free-art", NAME, "art", r"free art licen[cs]e(?: (?:version )?1 3)?"),
    ("design-science", NAME, "science", r"design science licen[cs]e"),
    ("open-game", NAME, "game", r"open game licen[cs]e(?: (?:version )?1 0a?)?"),
]

RESTRICTED = [
    # source available, model licenses
    ("sspl-1.0", NAME, "server", r"server side public licen[cs]e(?: (?:version |v ?)?1)?"),
    ("sspl-1.0", SHORT, "sspl", r"sspl(?: v?1(?: 0)?)?"),
    ("busl-1.1", NAME, "business", r"business source licen[cs]e(?: (?:version )?1 1)?"),
    ("busl-1.1", SHORT, "busl", r"busl 1 1"),
    ("elastic-2.0", NAME, "elastic", r"elastic licen[cs]e (?:version )?v?2(?: 0)?"),
    ("elastic", NAME, "elastic", r"elastic licen[cs]e" + V),
    ("commons-clause", NAME, "clause", r"commons clause(?: licen[cs]e)?(?: condition)?"),
    ("confluent", NAME, "confluent", r"confluent community licen[cs]e"),
    ("polyform-noncommercial", NAME, "polyform", r"polyform non ?commercial licen[cs]e(?: 1 0 0)?"),
    ("polyform-small-business", NAME, "polyform", r"polyform small business licen[cs]e(?: 1 0 0)?"),
    ("prosperity", NAME, "prosperity", r"prosperity public licen[cs]e(?: 3 0 0)?"),
    ("hippocratic", NAME, "hippocratic", r"hippocratic licen[cs]e(?: (?:version )?[0-9] [0-9])?"),
    ("openrail", NAME, "openrail", r"(?:creativeml )?openrail(?: m)?(?: licen[cs]e)?"),
    ("openrail", NAME, "responsible", r"responsible ai licen[cs]e"),
    ("research-only", CLAIM, "research", r"for (?:non commercial )?research (?:purposes|use) only"),
    ("non-commercial", CLAIM, "commercial", r"for non commercial (?:use|purposes) only"),
    ("non-commercial", CLAIM, "commercial", r"not for commercial (?:use|purposes)"),
    ("personal-use", CLAIM, "personal", r"for personal use only"),
    ("evaluation-only", CLAIM, "evaluation", r"for evaluation (?:use|purposes) only"),
    ("internal-use", CLAIM, "internal", r"for internal use only"),
    ("eula", NAME, "user", r"end user licen[cs]e agreement"),
    ("eula", SHORT, "eula", r"eula"),
    # statements
    ("reserved", CLAIM, "reserved", r"(?:all|some) rights (?:are )?reserved"),
    ("reserved", CLAIM, "rechte", r"alle rechte vorbehalten"),
    ("reserved", CLAIM, "droits", r"tous droits réservés"),
    ("reserved", CLAIM, "derechos", r"(?:todos los|reservados todos los) derechos(?: reservados)?"),
    ("reserved", CLAIM, "diritti", r"tutti i diritti riservati"),
    ("reserved", CLAIM, "direitos", r"todos os direitos reservados"),
    ("no-rights-reserved", CLAIM, "reserved", r"no rights reserved"),
    ("copyright", MENTION, "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"),
    ("copyright", MENTION, "copyrighted", r"this (?:document|file|work|material) is copyrighted"),
    ("copyright", MENTION, "copyright", r"protected by (?:international )?copyright laws?"),
    ("copyright", MENTION, "©", r"© (?:19|20)[0-9]{2}"),
    ("public-domain", CLAIM, "domain", r"(?:in|into|to) the public domain"),
    ("public-domain", CLAIM, "domain", r"public domain dedication"),
    ("public-domain", CLAIM, "domain", r"dedicated to the public domain"),
    ("public-domain", CLAIM, "domain", r"no copyright this work is public domain"),
    ("public-domain", CLAIM, "disclaims disclaim", r"the author(?:s)? (?:hereby )?disclaims? copyright to this source code"),
    ("proprietary", CLAIM, "proprietary", r"proprietary and confidential"),
    ("proprietary", CLAIM, "confidential", r"confidential and proprietary"),
    ("proprietary", CLAIM, "unauthorized", r"unauthorized (?:copying|reproduction|distribution|use) (?:of this (?:file|software|document|material) )?(?:.{0,40}? )?is strictly prohibited"),
    ("proprietary", CLAIM, "reproduced", r"may not be reproduced (?:in any form )?without (?:the )?(?:prior )?(?:express )?written (?:permission|consent)"),
    ("proprietary", CLAIM, "trade", r"contains trade secrets"),
    ("permission-required", CLAIM, "permission", r"(?:used|reprinted|reproduced) (?:with|by) permission"),
    ("attribution-required", CLAIM, "credit", r"provided (?:that )?(?:appropriate )?credit is given"),
    ("dual", MENTION, "dual", r"dual licen[cs]ed"),
    ("see-license", MENTION, "license", r"see (?:the )?(?:accompanying )?license file(?: for details)?"),
    ("see-copying", MENTION, "copying", r"see (?:the )?(?:file )?copying(?: file)? for details"),
]

RULES = PERMISSIVE + COPYLEFT + CONTENT + RESTRICTED
