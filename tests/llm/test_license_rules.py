"""Every rule finds texts made from its own pattern; plain sentences get the labels a reader would give."""

import random
import re

import pytest

from ranklab.llm import license_rules, licenses
from ranklab.llm.common import words


def sample(parts, rng):
    """A text that the parsed pattern matches."""
    out = ""
    for kind, value in parts:
        name = str(kind)
        if name == "LITERAL":
            out += chr(value)
        elif name == "ANY":
            out += "x"
        elif name == "IN":
            what, chosen = rng.choice(value)
            out += chr(chosen if str(what) == "LITERAL" else rng.randint(*chosen))
        elif name == "BRANCH":
            out += sample(rng.choice(value[1]), rng)
        elif name == "SUBPATTERN":
            out += sample(value[3], rng)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = value
            out += "".join(sample(body, rng) for _ in range(rng.randint(low, min(int(high), low + 3))))
        elif name != "ASSERT_NOT":
            raise AssertionError(name)
    return out


def gate(ordered):
    made = {}
    for i, r in enumerate(ordered):
        for k in r.keywords:
            made.setdefault(k.encode(), []).append(i)
    return made


def labels(text):
    ordered = licenses.rules()
    return sorted({d.rule.label for d in licenses.suppress(licenses.detect(words(text), gate(ordered), ordered))})


def test_every_rule_finds_its_own_texts_through_the_gate():
    rng = random.Random(11)
    ordered = licenses.rules()
    gates = gate(ordered)
    patterns = {re.compile(f"(?<= )(?:{p})(?= )".encode()): (label, priority, p) for label, priority, _, p in license_rules.RULES}
    assert len(patterns) == len(license_rules.RULES)           # no pattern twice
    for rule in ordered:
        if rule.base:
            continue
        label, priority, pattern = patterns[rule.pattern]
        for _ in range(12):
            text = f"before {sample(re._parser.parse(pattern), rng)} behind"
            assert any(d.rule is rule and d.start <= 1 for d in licenses.detect(words(text), gates, ordered)), (pattern, text)


@pytest.mark.parametrize("text, want", [
    ("This is licensed under the GPL.", ["gpl"]),
    ("Code: GPLv3", ["gpl-3.0"]),
    ("a GPL license", ["gpl"]),
    ("LGPLv2.1 applies", ["lgpl-2.1"]),
    ("MPL-2.0", ["mpl-2.0"]),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", ["classpath-exception", "gpl-2.0-or-later"]),
    ("GNU General Public License, version 2 or (at your option) any later version", ["gpl-2.0-or-later"]),
    ("GNU General Public License v3.0", ["gpl-3.0"]),
    ("GNU Library General Public License version 2", ["lgpl-2.0"]),
    ("GNU Lesser General Public License 3 or later", ["lgpl-3.0-or-later"]),
    ("GNU Affero General Public License version 3", ["agpl-3.0"]),
    ("AGPL-3.0-only", ["agpl-3.0"]),
    ("Licensed to the Apache Software Foundation", ["apache"]),
    ("under Apache 2.0", ["apache-2.0"]),
    ("http://www.apache.org/licenses/LICENSE-2.0", ["apache-2.0"]),
    ("Apache Software License, Version 1.1", ["apache-1.1"]),
    ("The MIT License (MIT)", ["mit"]),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", ["mit"]),
    ("MIT No Attribution", ["mit-0"]),
    ("a BSD-style license", ["bsd"]),
    ("BSD 3-Clause License", ["bsd-3-clause"]),
    ("Simplified BSD License", ["bsd-2-clause"]),
    ("ISC license", ["isc"]), ("zlib/libpng license", ["zlib"]), ("Boost Software License 1.0", ["boost-1.0"]),
    ("The Unlicense", ["unlicense"]), ("WTFPL v2", ["wtfpl"]), ("Artistic License 2.0", ["artistic-2.0"]),
    ("under the same terms as Perl itself", ["perl"]), ("Mozilla Public License Version 1.1", ["mpl-1.1"]),
    ("Eclipse Public License - v 2.0", ["epl-2.0"]),
    ("Eclipse Public License v2.0", ["epl-2.0"]), ("CDDL 1.1", ["cddl-1.1"]), ("EUPL-1.2", ["eupl-1.2"]),
    ("GNU Free Documentation License 1.3", ["gfdl-1.3"]), ("SIL Open Font License, Version 1.1", ["ofl-1.1"]),
    ("CC BY-SA 4.0 International", ["cc-by-sa-4.0"]), ("cc-by-nc-nd", ["cc-by-nc-nd"]), ("CC0 1.0 Universal", ["cc0-1.0"]),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", ["cc-by-nc-sa-4.0"]),
    ("https://creativecommons.org/licenses/by-nc/4.0/", ["cc-by-nc-4.0"]),
    ("Open Data Commons Open Database License 1.0", ["odbl-1.0"]), ("Business Source License 1.1", ["busl-1.1"]),
    ("Server Side Public License", ["sspl-1.0"]), ("Alle Rechte vorbehalten", ["reserved"]), ("Tous droits réservés", ["reserved"]),
    ("proprietary and confidential", ["proprietary"]), ("Copyright (c) 2019", ["copyright"]),
    ("the general public and the license of a driver", []), ("mit dem Hund", []), ("a boost for open software", []), ("", []),
])
def test_plain_cases(text, want):
    assert labels(text) == want
