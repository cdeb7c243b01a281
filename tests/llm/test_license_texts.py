"""The published texts, wrapped as they are published, with and without comment marks."""

import pytest
from moodlake.llm import license_scan as L

MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""
ISC = """Copyright (c) 2020 Some One
Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
BSD_2 = """Copyright (c) 2020, Some One

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD_3 = BSD_2 + """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
APACHE = """Copyright 2020 Some One
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
WRAPPED = {"MIT": (MIT, 2), "ISC": (ISC, 1), "BSD-2-Clause": (BSD_2, 3), "BSD-3-Clause": (BSD_3, 4), "Apache-2.0": (APACHE, 4)}
MARKS = {"": "", "#": "# ", "star": " * ", "//": "// ", "rem": "REM ", "dnl": "dnl "}


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.licenses, r.n_sentences) for r in L.scan_licenses(docs).orderBy("doc_id").collect()]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_texts(spark, end):
    cases = [(name, n, end.join(mark + line for line in text.split("\n")))
             for name, (text, n) in WRAPPED.items() for mark in MARKS.values()]
    assert scan(spark, [text for _, _, text in cases]) == [(name, n) for name, n, _ in cases]


def test_lines_and_blank_lines(spark):
    texts = ["A heading\nLicensed under the MIT license\nand some more",  # a line of its own stays a sentence
             "Copyright (c) 2020 A\nAll rights\nreserved",
             "Licensed under\n\nthe MIT license",  # a blank line ends a sentence
             "Licensed under.\nthe MIT license",
             "We are not licensed under the MIT license", "\n" * 100_000 + "Licensed under the\nMIT license"]
    assert scan(spark, texts) == [("MIT", 1), ("Proprietary", 1), ("", 0), ("", 0), ("", 0), ("MIT", 1)]


GNU = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU {} as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
GPL, LESSER, AFFERO = "General Public License", "Lesser General Public\nLicense", "Affero General Public License"
NOTICES = [
    ("GPL-2.0", GNU.format(";", GPL, ";", 2)), ("GPL-2.0", GNU.format(":", GPL, ",", 2)), ("GPL-3.0", GNU.format(":", GPL, ",", 3)),
    ("GPL-3.0", GNU.format(";", GPL, ";", 3)), ("LGPL-2.1", GNU.replace("program", "library").format(";", LESSER, ";", "2.1")),
    ("LGPL-2.1", GNU.format(":", LESSER, ",", "2.1")),
    ("LGPL-3.0", GNU.format(":", LESSER, ",", 3)), ("LGPL-3.0", GNU.format(";", LESSER, ";", 3)),
    ("AGPL-3.0", GNU.format(":", AFFERO, ",", 3)), ("AGPL-3.0", GNU.format(";", AFFERO, ";", 3)),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public "
                "License version 2 as\npublished by the Free Software Foundation."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was "
                "not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish."),
    ("CC0-1.0", "To the extent possible under law, the person who associated CC0 with\nthis work has waived all copyright and related "
                "or neighboring\nrights to this work."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0\nInternational License. To view a copy, go there."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0\nInternational License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License."),
    ("Proprietary", "Copyright (c) 2020 Some One. All rights reserved."), *[(name, text) for name, (text, _) in WRAPPED.items()]]


def test_each_licence_is_found_in_its_published_text(spark):
    cases = [(name, "\n".join(mark + line for line in text.split("\n"))) for name, text in NOTICES for mark in MARKS.values()]
    assert [got for got, _ in scan(spark, [text for _, text in cases])] == [name for name, _ in cases]
    assert {name for name, _ in L.ALL_RULES} - {"BSD-4-Clause"} == {name for name, _ in NOTICES}  # that one has a test of its own


def test_spdx_lines(spark):
    cases = [(name, f"// SPDX-License-Identifier: {form}\nint x;") for name, forms in L.SPDX.items() for form in forms]
    cases += [("GPL-2.0", "/* SPDX-License-Identifier: GPL-2.0+ WITH Linux-syscall-note */"),
              ("Apache-2.0, MIT", "# SPDX-License-Identifier: (MIT OR Apache-2.0)\nit is this OR that"),
              ("BSD-3-Clause, MIT, GPL-2.0", "spdx-license-identifier: MIT and (BSD-3-Clause or GPL-2.0-only WITH Classpath-exception-2.0)"),
              ("", "SPDX-License-Identifier: LicenseRef-Own"), ("", "SPDX-License-Identifier: MIT-0")]
    assert [got for got, _ in scan(spark, [text for _, text in cases])] == [name for name, _ in cases]


def test_triggers_hold_however_words_are_parted(spark):
    texts = ["All rights  reserved.", "All\trights reserved", "All rights\u00a0reserved", "all-rights-reserved", "ALL RIGHTS\nRESERVED"]
    assert scan(spark, texts) == [("Proprietary", 1)] * 5


def test_bsd_with_a_named_holder_and_the_older_forms(spark):
    regents = BSD_3.replace("the copyright holder", "the University of California, Berkeley")
    author = BSD_2 + "\n\n3. The name of the author may not be used to endorse or promote products derived\n   from this software without specific prior written permission."
    advert = BSD_2 + ("\n\n3. All advertising materials mentioning features or use of this software must\n   display the following acknowledgement:\n"
                      "   This product includes software developed by Some One.\n\n") + "4. " + regents[regents.index("Neither"):]
    any_of = BSD_3.replace("the copyright holder", "The Open Group Inc").replace("of its\n", "of any\n")
    assert [r for r, _ in scan(spark, [regents, author, advert, any_of, BSD_2])] == [
        "BSD-3-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSD-3-Clause", "BSD-2-Clause"]


def test_notices_of_the_mit_licence(spark):
    texts = ["The MIT License (MIT)", "Licensed under the terms of the MIT license.", "This project is licensed under the MIT License.",
             "# The MIT License (MIT)\n#\n# Copyright 2020"]
    assert [r for r, _ in scan(spark, texts)] == ["MIT"] * 4


def test_long_spdx_lines_are_read_whole(spark):
    names = [n for n in L.SPDX if "GPL" not in n]
    line = "SPDX-License-Identifier: " + " OR ".join(names[i % len(names)] for i in range(40)) + " OR GPL-2.0-only WITH Classpath-exception-2.0 AND (ISC OR MIT)"
    assert len(line) > 400
    found, n = scan(spark, [f"# {line}\n# not a name OR another"])[0]
    assert set(found.split(", ")) == {*names, "GPL-2.0"} and n == 43
    assert scan(spark, ["a AND b OR c", "MIT OR Apache-2.0 license"]) == [("", 0), ("", 0)]
