"""Licence scan by sentence rules, in DataFrame operations only.

Normalised sentences that are known map to identifiers; the sequence of identifiers of a text is then matched against
licence rules in their order, each rule taking out what it explains. Everything happens within the row: one pass, no
shuffle, and the known sentences are a fixed table of the library.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.llm.common import table

# Wording of published licence notices, one sentence per line, as normalised (lower case, single spaces,
# letters and digits only). The GNU notices differ in names only and are made from `GNU` below.
NOTICES = {
    "ApacheNotExcept": "you may not use this file except in compliance with the license",
    "ApacheCopy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "ApacheAsIs": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "ApacheSee": "see the license for the specific language governing permissions and limitations under the license",
    "BoostGrant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "BoostLine": "distributed under the boost software license version 1 0",
    "BsdForms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BsdSource": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BsdBinary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BsdNames": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "Cc0Waive": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "Epl2": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "IscGrant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "BsdZeroGrant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "MitGrant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MitNotice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MitZeroGrant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    "Mpl2Subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "PostgresGrant": "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
    "Reserved": "all rights reserved",
    "UnlicenseFree": "this is free and unencumbered software released into the public domain",
    "Wtfpl": "do what the fuck you want to public license",
    "ZlibFree": "this software is provided as is without any express or implied warranty",
    "ZlibGrant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
}
# The GNU licences, their names in notices, and the versions.
GNU = {"GPL": "general", "LGPL": "lesser general", "AGPL": "affero general"}
GNU_VERSIONS = {"GPL": ("2.0", "3.0"), "LGPL": ("2.1", "3.0"), "AGPL": ("3.0",)}
GNU_WORKS = ("program", "library", "software", "file")
# How licences are called in a line such as "licensed under the ...", and the verbs of such lines.
SPOKEN = {
    "MIT": ("mit license", "mit licence", "expat license"),
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache license v2 0"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"),
    "0BSD": ("zero clause bsd license", "bsd zero clause license"),
    "ISC": ("isc license",),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0"),
    "EPL-2.0": ("eclipse public license version 2 0", "eclipse public license 2 0", "eclipse public license v 2 0"),
    "BSL-1.0": ("boost software license version 1 0", "boost software license 1 0"),
    "Zlib": ("zlib license",),
    "PostgreSQL": ("postgresql license",),
    "Artistic-2.0": ("artistic license 2 0", "artistic license version 2 0"),
    "Unlicense": ("unlicense",),
    "CC0-1.0": ("cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal"),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"),
    "CC-BY-NC-SA-4.0": ("cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international license"),
}
VERBS = (
    "licensed under", "released under", "distributed under", "available under", "this work is licensed under", "this project is licensed under",
    "this software is licensed under", "this program is licensed under", "this file is licensed under", "this code is licensed under",
)
#: Words that may stand between verb and name.
ARTICLES = ("the terms of the ", "terms of the ", "the ", "a ")
# Identifiers of the SPDX list besides the GNU ones.
SPDX = (*SPOKEN, "MIT-0", "Apache-1.1", "BSD-4-Clause", "WTFPL", "CC-BY-3.0", "CC-BY-SA-3.0", "MPL-1.1", "EPL-1.0", "Artistic-1.0")


def _normal(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def _gnu_sentences() -> dict[str, str]:
    out = {}
    for name, words in GNU.items():
        for work in GNU_WORKS:
            for version in GNU_VERSIONS[name]:
                number = _normal(version.removesuffix(".0")) if version != "2.1" else "2 1"
                under = f"this {work} is free software you can redistribute it and or modify it under the terms of the gnu {words} public license"
                either = f"as published by the free software foundation either version {number} of the license"
                out[f"{under} {either} or at your option any later version"] = f"{name}{version}Later"
                out[f"{under} {either}"] = f"{name}{version}Only"
                out[f"{under} as published by the free software foundation version {number} of the license"] = f"{name}{version}Only"
                out[f"{under} version {number} as published by the free software foundation"] = f"{name}{version}Only"
            hope = f"this {work} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
            out[hope] = "GnuHope"
        out[f"see the gnu {words} public license for more details"] = f"{name}See"
    return out


def _lines() -> dict[str, str]:
    """Names in lines, and identifiers: the verb before a name is a pattern of its own, not part of this table."""
    out = {spoken: f"{name}Line" for name, names in SPOKEN.items() for spoken in names}
    for name, words in GNU.items():
        for version in GNU_VERSIONS[name]:
            number = _normal(version.removesuffix(".0")) if version != "2.1" else "2 1"
            for spoken in (f"gnu {words} public license version {number}", f"gnu {words} public license v{number}", f"gnu {name.lower()} version {number}", f"{name.lower()} v{number}", f"{name.lower()} {_normal(version)}"):
                out[spoken] = f"{name}-{version}Line"
            out[f"gnu {words} public license version {number} or later"] = f"{name}-{version}-or-laterLine"
    return out


def _spdx() -> dict[str, str]:
    names = [*SPDX, *(f"{n}-{v}{end}" for n in GNU for v in GNU_VERSIONS[n] for end in ("", "-only", "-or-later"))]
    return {f"spdx license identifier {_normal(n)}": f"{n}Spdx" for n in names}


LINES = _lines()
#: Known sentences and their identifiers, lines of the form verb and name left out.
SENTENCES = {text: name for name, text in NOTICES.items()} | _gnu_sentences() | _spdx()
#: How else the first line of the Apache notice reads.
SENTENCES["licensed under the apache license version 2 0 the license"] = "Apache-2.0Line"


def _rules() -> list[tuple[str, tuple[str, ...]]]:
    """Licence rules, tried in this order: sequences of sentences that follow one another among the known ones. A rule
    stands before any that begins it."""
    rules = [
        ("Apache-2.0", ("Apache-2.0Line", "ApacheNotExcept", "ApacheCopy", "ApacheAsIs", "ApacheSee")),
        ("MIT", ("MitGrant", "MitNotice")),
        ("BSD-3-Clause", ("BsdForms", "BsdSource", "BsdBinary", "BsdNames")),
        ("BSD-2-Clause", ("BsdForms", "BsdSource", "BsdBinary")),
    ]
    for name in GNU:
        for version in GNU_VERSIONS[name]:
            for end, label in (("Later", "-or-later"), ("Only", "-only")):
                rules.append((f"{name}-{version}{label}", (f"{name}{version}{end}", "GnuHope", f"{name}See")))
                rules.append((f"{name}-{version}{label}", (f"{name}{version}{end}",)))
    rules += [
        ("ISC", ("IscGrant",)), ("0BSD", ("BsdZeroGrant",)), ("MIT-0", ("MitZeroGrant",)), ("MPL-2.0", ("Mpl2Subject",)), ("EPL-2.0", ("Epl2",)),
        ("BSL-1.0", ("BoostGrant",)), ("BSL-1.0", ("BoostLine",)), ("Zlib", ("ZlibFree", "ZlibGrant")), ("PostgreSQL", ("PostgresGrant",)),
        ("Unlicense", ("UnlicenseFree",)), ("WTFPL", ("Wtfpl",)), ("CC0-1.0", ("Cc0Waive",)),
    ]
    names = sorted(set(LINES.values()) | {n for n in SENTENCES.values() if n.endswith("Spdx")})
    return rules + [(re.sub("(Line|Spdx)$", "", n), (n,)) for n in names]


RULES = tuple(_rules())
#: Says something about the licence only where no rule does.
RESERVED, PROPRIETARY = "Reserved", "Proprietary"


#: What isn't a letter, a digit or the end of a line.
NOISE = r"[^a-z0-9\n]+"
#: Marks of a list at the beginning of a line, after comment leaders.
MARKS = r"(^|[\r\n])[^a-z0-9\r\n]*([0-9]{1,2}|[a-z])[.)]\s"
#: Where a sentence may begin or end. It may also go on there.
BREAKS = r"[.!?;:]+(\s|$)|[\r\n]+"
ADDRESS = r"(://\S+)\s"
_AND = "\n\n"


def _pattern() -> str:
    """Known sentences between line ends, which stand doubled so that neighbours don't share one; where a sentence has a
    space there may be a line end. Longer sentences come first."""
    join = lambda x: x.replace(" ", "(?: |\n\n)")
    line = "(?:" + "|".join(join(v) for v in VERBS) + ")(?: |\n\n)(?:" + "|".join(join(a) for a in ARTICLES) + ")?(?:" + "|".join(join(n) for n in sorted(LINES, key=len, reverse=True)) + ")"
    whole = sorted(SENTENCES, key=len, reverse=True)
    longer, shorter = [x for x in whole if len(x) > 60], [x for x in whole if len(x) <= 60]
    return "\n(" + "|".join([*map(join, longer), line, *map(join, shorter)]) + ")\n"


PATTERN = _pattern()


def sentences(text: Column) -> Column:
    """The known sentences of a text, in order; between their words there may be breaks of any kind."""
    broken = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(text), MARKS, "\n"), ADDRESS, "$1\n"), BREAKS, "\n")
    lines = F.regexp_replace(F.regexp_replace(broken, NOISE, " "), r" ?\n[ \n]*", _AND)
    found = F.regexp_extract_all(F.concat(F.lit(_AND), F.trim(lines), F.lit(_AND)), F.lit(PATTERN), F.lit(1))
    return F.transform(found, lambda s: F.replace(s, F.lit(_AND), F.lit(" ")))


def _verb() -> str:
    return "^(" + "|".join(VERBS) + ") (" + "|".join(a for a in ARTICLES) + ")?"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_known, identifiers, licences, unexplained): one row per row of `docs`.

    `identifiers` are those of the known sentences in order, `licences` the sorted distinct names of the rules that
    matched, `unexplained` the identifiers no rule took. "All rights reserved" means a proprietary text only where no rule
    matched. Null and empty texts have none of them (empty strings). A known sentence may be wrapped over lines, in a
    comment too. SPDX expressions of several names are not read. Other columns are left out.
    """
    table = SENTENCES | LINES
    names = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = docs.select("doc_id", sentences(F.col("text")).alias("_found"))
    # A sentence of the table, or a name after a verb.
    named = F.transform("_found", lambda s: F.concat(F.lit("<"), F.coalesce(names[s], names[F.regexp_replace(s, _verb(), "")]), F.lit(">")))
    marked = found.select("doc_id", F.coalesce(F.size("_found"), F.lit(0)).alias("_n"), F.when(F.size("_found") > 0, named).alias("_ids"))
    rows = marked.select("doc_id", F.greatest(F.col("_n"), F.lit(0)).cast("long").alias("n_known"), F.coalesce(F.array_join("_ids", ""), F.lit("")).alias("identifiers"))
    # Most texts have no known sentence; rules are only tried on the others, in one fold over them.
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{p}>" for p in parts)).alias("parts")) for name, parts in RULES])
    none = F.array().cast("array<string>")
    start = F.struct(F.col("identifiers").alias("rest"), none.alias("names"))
    # What is taken out leaves a mark, so that its neighbours don't become successive.
    step = lambda state, rule: F.when(
        F.instr(state["rest"], rule["parts"]) > 0,
        F.struct(F.replace(state["rest"], rule["parts"], F.lit("|")).alias("rest"), F.array_union(state["names"], F.array(rule["name"])).alias("names")),
    ).otherwise(state)
    rows = rows.withColumn("_end", F.when(F.col("n_known") > 0, F.aggregate(rules, start, step)).otherwise(start))
    reserved = f"<{RESERVED}>"
    alone = (F.size("_end.names") == 0) & (F.instr(F.col("_end.rest"), reserved) > 0)
    names_found = F.when(alone, F.array(F.lit(PROPRIETARY))).otherwise(F.array_sort("_end.names"))
    rest = F.replace(F.replace(F.col("_end.rest"), F.lit("|"), F.lit("")), F.lit(reserved), F.lit(""))
    return rows.select("doc_id", "n_known", "identifiers", F.array_join(names_found, ",").alias("licences"), rest.alias("unexplained"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same normalisation, sentences and rules."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    pairs = ", ".join(f"'{s}': '<{n}>'" for s, n in (SENTENCES | LINES).items())
    rules = ", ".join("{'name': " + quote(n) + ", 'parts': '" + "".join(f"<{p}>" for p in parts) + "'}" for n, parts in RULES)
    line_end, pattern = "chr(10) || chr(10)", quote(PATTERN.replace("\n", "\\n"))
    return rf"""
WITH broken AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '{MARKS}', chr(10), 'g'), '{ADDRESS}', '\1' || chr(10), 'g'),
    '{BREAKS}', chr(10), 'g') AS b FROM documents
), lines AS (
  SELECT doc_id, {line_end} || trim(regexp_replace(regexp_replace(b, '{NOISE}', ' ', 'g'), ' ?\n[ \n]*', {line_end}, 'g'), ' ') || {line_end} AS l FROM broken
), found AS (
  SELECT doc_id, list_transform(regexp_extract_all(l, {pattern}, 1), lambda x: replace(x, {line_end}, ' ')) AS f FROM lines
), known AS (SELECT MAP {{{pairs}}} AS names, [{rules}] AS rules), named AS (
  SELECT doc_id, CAST(len(f) AS BIGINT) AS n_known,
    coalesce(array_to_string(list_transform(f, lambda x: coalesce(names[x], names[regexp_replace(x, '{_verb()}', '')])), ''), '') AS identifiers FROM found, known
), ended AS (
  SELECT doc_id, n_known, identifiers, CASE WHEN n_known = 0 THEN {{'rest': '', 'names': CAST([] AS VARCHAR[])}} ELSE list_reduce(
    list_transform(rules, lambda r: {{'name': r.name, 'parts': r.parts, 'rest': identifiers, 'names': CAST([] AS VARCHAR[])}}),
    lambda a, r: CASE WHEN contains(a.rest, r.parts)
      THEN {{'name': '', 'parts': '', 'rest': replace(a.rest, r.parts, '|'), 'names': CASE WHEN list_contains(a.names, r.name) THEN a.names ELSE list_append(a.names, r.name) END}}
      ELSE {{'name': '', 'parts': '', 'rest': a.rest, 'names': a.names}} END,
    {{'name': '', 'parts': '', 'rest': identifiers, 'names': CAST([] AS VARCHAR[])}}) END AS e FROM named, known
)
SELECT doc_id, n_known, identifiers, CASE WHEN len(e.names) = 0 AND contains(e.rest, '<{RESERVED}>') THEN '{PROPRIETARY}' ELSE array_to_string(list_sort(e.names), ',') END AS licences,
  replace(replace(e.rest, '|', ''), '<{RESERVED}>', '') AS unexplained FROM ended
"""


OP2_SQL = _sql()
