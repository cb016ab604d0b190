"""Published notices of the licence families, in several layouts, by the operator and by its SQL."""

import duckdb
import pytest
from llm_fixtures import docs  # noqa: F401

from kilnwatt.llm import licenses

# Wording of the published notices.
FORMS = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
DEAL = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so{}"""


def gnu(kind, work, version, see):
    return f"""This {work} is free software; you can redistribute it and/or modify
it under the terms of the GNU {kind} Public License as published by
the Free Software Foundation{version}

This {work} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {see} Public License for more details."""


LATER = "; either version {} of the License, or\n(at your option) any later version."
NOTICES = [
    ("BSD-3-Clause", "Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + FORMS + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""),
    ("BSD-2-Clause", "Copyright 2020 Someone. All rights reserved.\n\n" + FORMS),
    ("MIT", "Copyright (c) 2020 Someone.\n\n" + DEAL.format(", subject to the following conditions:\n\n") + """The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""),
    ("MIT-0", DEAL.format(".")),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS"."""),
    ("GPL-3.0-or-later", gnu("General", "program", LATER.format(3), "General")),
    ("GPL-2.0-or-later", gnu("General", "program", LATER.format(2), "General")),
    ("GPL-3.0-only", gnu("General", "program", ", version 3 of the License.", "General")),
    ("LGPL-2.1-or-later", gnu("Lesser General", "library", LATER.format("2.1"), "Lesser General")),
    ("LGPL-3.0-or-later", gnu("Lesser General", "program", LATER.format(3), "Lesser General")),
    ("AGPL-3.0-or-later", gnu("Affero General", "program", LATER.format(3), "Affero General")),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("BSL-1.0", """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt)"""),
    ("Zlib", """This software is provided 'as-is', without any express or implied
warranty. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:"""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("PostgreSQL", """Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and
without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the
following two paragraphs appear in all copies."""),
    ("EPL-2.0", """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0"""),
    ("MIT", "Licensed under the MIT license"),
    ("MIT", "// Released under the terms of the\n// MIT License."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Released under CC0 1.0."),
    *[(n, f"SPDX-License-Identifier: {n}") for n in ("BSD-3-Clause", "GPL-2.0-only", "LGPL-2.1-or-later", "MPL-2.0", "ISC", "CC-BY-NC-4.0", "AGPL-3.0", "Zlib")],
    ("Proprietary", "Copyright 2020 Someone. All rights reserved."),
    ("", "We keep all rights reserved for members. Not released under the MIT license at all."),
]
LAYOUTS = {
    "as published": lambda t: t,
    "one line": lambda t: " ".join(t.split()),
    "crlf": lambda t: t.replace("\n", "\r\n"),
    "hash": lambda t: "\n".join("# " + x for x in t.split("\n")),
    "star": lambda t: "/*\n" + "\n".join(" * " + x for x in t.split("\n")) + "\n */",
    "slashes": lambda t: "\n".join("// " + x for x in t.split("\n")),
    "indented": lambda t: "Some words before it.\n\n" + "\n".join("    " + x for x in t.split("\n")) + "\nSome words after.",
}


@pytest.fixture(scope="module")
def cases():
    return [(i, name, layout(text)) for i, (name, text, layout) in enumerate((n, t, f) for n, t in NOTICES for f in LAYOUTS.values())]


def test_published_notices(docs, cases):  # noqa: F811
    got = {r.doc_id: r.licences for r in licenses.scan(docs([(i, t) for i, _, t in cases])).collect()}
    wrong = [(name, got[i], text) for i, name, text in cases if got[i] != name]
    assert wrong == []


def test_sql_equals_operator(docs, cases):  # noqa: F811
    rows = [(i, t) for i, _, t in cases] + [(-1, None), (-2, ""), (-3, "\n\n"), (-4, "All rights reserved.\nMIT license"), (-4, "All rights reserved.\nMIT license")]
    df = docs(rows, extra=False)
    connection = duckdb.connect()
    connection.register("documents", df.toPandas())
    want = connection.execute(licenses.OP2_SQL).fetchall()
    got = [tuple(r) for r in licenses.scan(df).collect()]
    assert sorted(got) == sorted(want)


def test_reserved_counts_alone(docs):  # noqa: F811
    rows = [(1, "All rights reserved."), (2, "All rights reserved.\nReleased under the MIT License."), (3, "All rights reserved\nYou may not use this file except in compliance with the License.")]
    got = {r.doc_id: (r.licences, r.unexplained) for r in licenses.scan(docs(rows)).collect()}
    assert got == {1: ("Proprietary", ""), 2: ("MIT", ""), 3: ("Proprietary", "<ApacheNotExcept>")}
