import random
import re

import pytest

from lexitrend.llm import op3_licenses as lic

ZLIB = """This software is provided 'as-is', without any express or implied warranty.

Permission is granted to anyone to use this software for any purpose, including commercial applications, subject to:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
2. Altered source versions must be plainly marked as such."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted:
1. Redistributions of source code must retain the above copyright notice.
2. Redistributions in binary form must reproduce the above copyright notice.
"""
ADVERT = """3. All advertising materials mentioning features or use of this software must display an acknowledgement.
"""
ENDORSE = """4. Neither the name of the holder nor the names of its contributors may be used to endorse or promote products.
"""
AS_IS = "THIS SOFTWARE IS PROVIDED \"AS IS\". In no event shall the holder be liable."
GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public "
       "License as published by the Foundation, either version 3 of the License, or (at your option) any later version.")
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy. The above copyright notice and this "
       "permission notice shall be included. ")
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose is granted. "

FULL = [
    (ZLIB, "Zlib"), (BSD + ADVERT + ENDORSE + AS_IS, "BSD-4-Clause"), (BSD + ENDORSE + AS_IS, "BSD-3-Clause"),
    (BSD + AS_IS, "BSD-2-Clause"), ("The MIT License. " + MIT + AS_IS, "MIT"), (MIT + AS_IS, "MIT"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy. " + AS_IS, "MIT"),
    ("ISC License. " + ISC + AS_IS, "ISC"), (ISC + AS_IS, "ISC"),
    (GNU.format(""), "GPL-3.0-or-later"), (GNU.format("Lesser "), "LGPL-3.0-or-later"), (GNU.format("Affero "), "AGPL-3.0-or-later"),
    ("GNU General Public License version 2 or later", "GPL-2.0-or-later"), ("Lesser General Public License 2.1 or later", "LGPL-2.1-or-later"),
    ("Affero General Public License 3 or later", "AGPL-3.0-or-later"), ("Affero General Public License 3", "AGPL-3.0"),
    ("Library General Public License 2", "LGPL-2.0"), ("General Public License v2", "GPL-2.0"), ("Under GPLv3.", "GPL-3.0"),
    ("SPDX-License-Identifier: MIT", "MIT"), ("Apache License 2.0", "Apache-2.0"), ("Mozilla Public License 2.0", "MPL-2.0"),
    ("Eclipse Public License 2.0", "EPL-2.0"), ("Common Development and Distribution License 1.0", "CDDL-1.0"),
    ("Artistic License 2.0", "Artistic-2.0"), ("Boost Software License 1.0", "BSL-1.0"), ("Creative Commons Zero", "CC0-1.0"),
    ("Under CC0.", "CC0-1.0"), ("Creative Commons Attribution 4.0", "CC-BY-4.0"), ("CC-BY-SA 4.0", "CC-BY-SA-4.0"),
    ("cc-by-nc-3.0", "CC-BY-NC-3.0"), ("Creative Commons Attribution-ShareAlike 3.0", "CC-BY-SA-3.0"), ("CC BY 2.0", "CC-BY-2.0"),
    ("new BSD license", "BSD-3-Clause"), ("ISC license", "ISC"), ("zlib license", "Zlib"), ("MIT license", "MIT"),
    ("Do What The Fuck You Want To Public License", "WTFPL"), ("placed in the public domain", "LicenseRef-public-domain"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("All rights reserved", "LicenseRef-proprietary"), ("proprietary and confidential", "LicenseRef-proprietary"),
    # Further names.
    ("X11 License", "X11"), ("Licensed under the EUPL v1.2.", "EUPL-1.2"), ("European Union Public Licence 1.2", "EUPL-1.2"),
    ("OFL 1.1", "OFL-1.1"), ("SIL Open Font License, Version 1.1", "OFL-1.1"), ("PSF license", "PSF-2.0"),
    ("Python Software Foundation License", "PSF-2.0"), ("AFL 3.0", "AFL-3.0"), ("Academic Free License v. 3.0", "AFL-3.0"),
    ("Ms-PL", "MS-PL"), ("Microsoft Public License", "MS-PL"), ("GNU Free Documentation License, Version 1.3", "GFDL-1.3"),
    ("Apache 2.0 licensed", "Apache-2.0"), ("Beerware", "Beerware"), ('"THE BEER-WARE LICENSE" (Revision 42)', "Beerware"),
    # A notice with its copyright line is one licence.
    ("Copyright 2001 Someone. All rights reserved.\n\n" + BSD + ENDORSE + AS_IS, "BSD-3-Clause"),
    ("Copyright 2001 Someone. All rights reserved.\n\n" + ISC + AS_IS, "ISC"),
    ("Copyright 2001 Someone. All rights reserved.\n\n" + MIT + AS_IS + " All rights reserved.", "MIT"),
    # GNU licences: that version only, or later ones, or not said.
    ("GPL-2.0-only", "GPL-2.0-only"), ("GPLv2+", "GPL-2.0-or-later"), ("GPLv3 or later", "GPL-3.0-or-later"), ("GPL-2.0", "GPL-2.0"),
    ("GNU General Public License version 2 only", "GPL-2.0-only"), ("version 3 of the GNU General Public License", "GPL-3.0"),
    ("under the GNU General Public License version 2 as published by the Free Software Foundation.", "GPL-2.0-only"),
    ("GNU Lesser General Public License; version 2.1 of the License only.", "LGPL-2.1-only"),
    ("Affero General Public License 3 only", "AGPL-3.0-only"),
    ("Under GPL version 2. Under the Lesser General Public License 2.1 or later.", "GPL-2.0,LGPL-2.1-or-later"),
    # Texts of whole licences: their own sentences and the other names in them are no further finding.
    ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007. The licenses for most software and other practical works are designed to "
     "take away your freedom to share and change the works. You may link with version 3 of the GNU Affero General Public License. "
     "either version 3 of the License, or (at your option) any later version. If this is what you want to do, use the GNU Lesser "
     "General Public License instead of this License.", "GPL-3.0"),
    ("GNU General Public License Version 2. The licenses for most software are designed to take away your freedom to share.", "GPL-2.0"),
    ("The licenses for most software are designed to take away your freedom to share and change it.", "GPL-2.0"),
    ("The licenses for most software and other practical works are designed to take away your freedom.", "GPL-3.0"),
    ("Apache License Version 2.0, January 2004. Each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, "
     "royalty-free, irrevocable copyright license. Each Contributor grants an irrevocable (except as stated in this section) patent "
     "license. Licensed under the Apache License. Software distributed under the License is distributed on an \"AS IS\" BASIS.", "Apache-2.0"),
    ("Licensed under the Apache License, Version 2.0. Software distributed under the License is distributed on an \"AS IS\" BASIS.", "Apache-2.0"),
    ("Eclipse Public License - v 2.0. The program is provided under the terms of this Eclipse Public License.", "EPL-2.0"),
]
DENIED = [
    # A name that its sentence denies is none; a condition or an exception denies nothing.
    ("This file is not in the public domain.", ""), ("we do not use the GNU General Public License version 2", ""),
    ("This isn't under the MIT license, it is under the ISC license.", "ISC"),
    ("You may not use this file except in compliance with the Apache License, Version 2.0.", "Apache-2.0"),
    ("If you did not receive a copy of the MIT license, write to us.", "MIT"), ("Do not remove this. MIT license.", "MIT"),
]
#: Sentences that are part of a licence only.
PARTS = {"OrLater": "or any later version", "AsIs": "is provided as is", "NoLiability": "in no event shall he be liable",
         "BSDEndorse": "may not be used to endorse or promote", "FreeSoftware": "is free software; you can redistribute it and/or modify"}


def scanned(spark, texts: list[str]) -> list:
    return sorted(lic.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect(), key=lambda r: r["doc_id"])


def test_full_texts_and_every_rule(spark):
    """As they stand, and with each space a line break (the words of a pattern may stand on two lines)."""
    broken = [t.replace(" ", "\n") for t, _ in FULL]
    for r, (text, want) in zip(scanned(spark, [t for t, _ in FULL] + broken + [t for t, _ in DENIED]), FULL * 2 + DENIED):
        assert r["licenses"] == want, text


def test_every_sentence_passes_the_filter(spark):
    texts = [t for t, _ in FULL] + list(PARTS.values())
    seen = {x.split(":")[0] for r in scanned(spark, texts) for x in r["sentence_ids"].split(",")}
    assert seen == {name for name, _ in lic.SENTENCES}
    names = {name for name, _ in lic.identifiers(" ".join(PARTS.values()))[0]}
    assert names == set(PARTS)


def slow(found: list[tuple[str, str]]) -> list[str]:
    """All rules as patterns over the identifiers, written out one after another; at each place the
    first rule with a match, and of its matches the shortest."""
    rest = [f for f in found if f[0] != "Reserved"]
    names = {r[1][0] for r in lic.RULES if len(r[1]) == 1}
    other = "(?:(?!(?:%s) )[^ ]+ )" % "|".join(names)
    out, bare, at = [], set(), 0
    while at < len(rest):
        end = None
        for name, parts in lic.RULES:
            pattern = re.escape(parts[0]) + " "
            for before, part in zip(parts, parts[1:]):
                if part != lic.ANY:
                    pattern += ("(?:[^ ]+ )*?" if before == lic.ANY else other + "{0,%d}?" % lic.GAP) + re.escape(part) + " "
            stops = [e for e in range(at + 1, len(rest) + 1)
                     if re.fullmatch(pattern, "".join(f"{n} " for n, _ in rest[at:e]))]
            if stops:
                end = stops[0]
                v = ([v for n, v in rest[at:end] if v and n in parts] or [""])[0]
                full = name.replace("{v}", v).replace("--", "-").rstrip("-")
                if "{v}" in name and not v:
                    bare.add(full)
                if full not in out:
                    out.append(full)
                break
        at = end or at + 1
    out = [n for n in out if not (n in bare and any(o.startswith(n + "-") for o in out))]
    return out or ["LicenseRef-proprietary"] * (len(rest) < len(found))


def test_rules_against_a_slow_matcher():
    rng = random.Random(5)
    names = [n for n, _ in lic.SENTENCES] + ["NotGPLRef", "NotMITRef"]
    long = [r for r in lic.RULES if len(r[1]) > 1]
    for _ in range(1500):
        found: list[tuple[str, str]] = []
        while len(found) < rng.randrange(1, 14):
            for part in rng.choice(long)[1] if rng.random() < 0.6 else [rng.choice(names)]:
                if part != lic.ANY and rng.random() < 0.9:
                    found.append((part, rng.choice(("", "", "2.0"))))
                if rng.random() < 0.4:
                    found.append((rng.choice(names), rng.choice(("", "3.0"))))
        assert lic.licences(found) == slow(found), found


def test_long_texts_take_linear_time():
    found = [("GPLRef", "3.0"), ("GPL3Preamble", ""), ("BSDGrant", "")] * 60_000
    assert lic.licences(found) == ["GPL-3.0"]
    assert lic.licences(found + [("LesserInstead", "")]) == ["GPL-3.0"]


@pytest.mark.parametrize("text", ["access by the success of others", "nothing of that kind"])
def test_other_texts_have_none(text):
    assert lic.identifiers(text) == ([], 0)
