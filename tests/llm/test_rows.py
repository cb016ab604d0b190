"""Decontamination, licences, packing and chat formatting against plain versions and SQL."""

import glob
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import SF_DIR, docs, in_order, odd_rows, real  # noqa: F401

from kilnwatt.llm import chat, decontaminate, licenses, packing
from kilnwatt.llm.queries import ORACLE, QUERIES

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = connection.execute(ORACLE[name])
    got = QUERIES[name](spark, SF_DIR)
    assert got.columns == [d[0] for d in result.description]
    assert in_order(got.collect()) == in_order(result.fetchall())


def contaminated(rows, items):
    split = lambda t: WORD.findall((t or "").translate(str.maketrans(decontaminate.UPPER, decontaminate.LOWER)))
    windows = [(i, tuple(w[j : j + min(10, len(w))])) for i, t in items if (w := split(t)) for j in range(len(w) - min(10, len(w)) + 1)]
    out = []
    for doc_id, t in rows:
        w, hit, names = split(t), set(), set()
        for i, window in windows:
            for j in range(len(w) - len(window) + 1):
                if tuple(w[j : j + len(window)]) == window:
                    hit.update(range(j, j + len(window)))
                    if i is not None:
                        names.add(str(i))
        out.append((doc_id, len(w), len(hit), len(names), ",".join(sorted(names))))
    return out


def test_contamination_odd_rows(spark, docs, odd_rows):  # noqa: F811
    texts = dict((i, t) for i, t in odd_rows if i is not None)
    some = (texts[5] or "").split()
    items = [(1, " ".join(some[3:40])), (10, " ".join(some[30:60])), (2, "Hello"), (3, "hello, THERE"), (4, ""), (5, None), (6, "z " * 12), (None, "y " * 11), (7, texts[17][-300:]), (1, " ".join(some[3:40])), (8, "É é w1")]
    rows = [*odd_rows, (300, "É é W1 x"), (301, "é é w1")]
    df = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as words", "'y' as row_key")
    found = decontaminate.contamination(docs(rows), df)
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r.items)) for r in found.collect()]
    want = contaminated(rows, items)
    assert in_order(got) == in_order(want)
    kept = decontaminate.clean(docs(rows), df)
    assert kept.columns == docs(rows).columns
    assert in_order(kept.select("doc_id", "text").collect()) == in_order(r for r, w in zip(rows, want, strict=True) if not w[2])


def test_contamination_items_of_every_length(spark, docs):  # noqa: F811
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 12)]
    rows = [(n, f"before {t} after") for n, t in items] + [(100 + n, f"before {t.rsplit(' ', 1)[0]} after") for n, t in items if n > 1]
    found = decontaminate.contamination(docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r.items)) for r in found.collect()]
    assert in_order(got) == in_order(contaminated(rows, items))
    only = [(n, t) for n, t in items if n == decontaminate.GRAM]
    kept = decontaminate.clean(docs(rows), spark.createDataFrame(only, "item_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {decontaminate.GRAM}


def test_contamination_empty_tables(spark, docs, odd_rows):  # noqa: F811
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 for r in decontaminate.contamination(docs(odd_rows), none).collect())
    assert decontaminate.contamination(docs([]), none).collect() == []


def test_license_rules(docs):  # noqa: F811
    grant = licenses.NOTICES["MitGrant"].capitalize()
    rows = [
        (1, f"Intro.\n{grant}. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nEnd"),
        (2, "All Rights Reserved. Released under the MIT License."),
        (3, "Licensed under the Apache License, Version 2.0\nsee the GNU General Public License for more details."),
        (4, None),
        (5, ""),
        (6, "not released under the mit license at all"),
        (6, "not released under the mit license at all"),
    ]
    got = {(r.doc_id, r.n_known, r.licences, r.unexplained) for r in licenses.scan(docs(rows)).collect()}
    assert got == {(1, 2, "MIT", ""), (2, 2, "MIT", ""), (3, 2, "Apache-2.0", "<GPLSee>"), (4, 0, "", ""), (5, 0, "", ""), (6, 0, "", "")}
    assert licenses.scan(docs([])).collect() == []


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0."""


def test_published_licences_wrapped_and_commented(docs):  # noqa: F811
    layouts = [lambda t: t, lambda t: " ".join(t.split()), lambda t: t.replace("\n", "\r\n"), *((lambda t, k=k: "\n".join(k + x for x in t.split("\n"))) for k in ("# ", " * ", "// "))]
    notices = [(APACHE, "Apache-2.0", 5), (MIT, "MIT", 2), (BSD.replace("1. ", "* ").replace("2. ", "* "), "BSD-2-Clause", 3), (BSD, "BSD-2-Clause", 3), (GPL, "GPL-2.0-or-later", 3), (MPL, "MPL-2.0", 1)]
    cases = [(f(t), name, n) for t, name, n in notices for f in layouts]
    got = {r.doc_id: (r.licences, r.n_known, r.unexplained) for r in licenses.scan(docs([(i, t) for i, (t, _, _) in enumerate(cases)])).collect()}
    assert got == {i: (name, n, "") for i, (_, name, n) in enumerate(cases)}


def test_packing_round_trip(docs, real, odd_rows):  # noqa: F811
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    odd = ["a <|endoftext|> b", "x<|endoftext|><|startoftext|>'s <|ENDOFTEXT|> <|endoftext| >", "<|endoftext|>", " <|startoftext|>\n\n.a", "Don't, it's 3.14. É. İ. ΟΔΟΣ. <|endoftext|>. a!. .b, ,c. 1,2,\x1cx\x85y　z", "word " * 5000, None, ""]
    rows = [(i, t) for i, t in enumerate([t for _, t in real[:60]] + [t for _, t in odd_rows] + odd)]
    got = packing.pack(docs(rows), TOKENIZER).collect()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, t in rows}
    pieces = {}
    for r in got:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for i, own in pieces.items():
        assert sorted(own) == [(k, s, min(2048, len(ids[i]) - s)) for k, s in enumerate(range(0, len(ids[i]), 2048))]
    assert set(pieces) == set(ids)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= -(-sum(map(len, ids.values())) // 2048) + 1
    assert packing.pack(docs([]), TOKENIZER).collect() == []


def test_words_of_letters_skip_the_whole_tokenizer():
    """Accented words take the short way to the model with the tokenizer's ids; other words take the long one."""
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self, path):
            self._whole, self.seen, self.model = Tokenizer.from_file(path), [], Tokenizer.from_file(path).model

        def encode_batch_fast(self, words, **how):
            self.seen += words
            return self._whole.encode_batch_fast(words, **how)

    tokenizer, words = Tokenizer.from_file(TOKENIZER), packing.WordIds(TOKENIZER)
    words._tokenizer = counting = Counting(TOKENIZER)
    rng = random.Random(4)
    letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7] + list("abcz")
    text = " ".join("".join(rng.choices(letters, k=rng.randint(1, 8))) for _ in range(500)) + " plain words again Más allá. plain"
    for part in (text, text + " más nuevo", "a÷b x²  Ñandú ﬁn 3a", ""):
        assert words.of(part) == np.array(tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert not any(re.fullmatch("[a-zß-öø-ÿ]+", w) for w in counting.seen) and {"a÷b", "3a"} <= set(counting.seen)


def test_fullest_is_optimal():
    rng = random.Random(2)
    for _ in range(200):
        left = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        longest = max(left)
        used = packing.fullest(longest, left, 60)
        assert all(u <= left[k] for k, u in used.items()) and used[longest] >= 1
        sums = {longest}
        for k, n in left.items():
            sums = {s + k * m for s in sums for m in range(n - (k == longest) + 1) if s + k * m <= 60}
        assert sum(k * u for k, u in used.items()) == max(sums)


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "<\u200bs> <\u200b\u200bs> </\u200bs>", "<<SYS>>\n<</SYS>>", "[ROLE] x [/ROLE]", "", "é\n", None]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool", "[/ROLE] ", None]), rng.choice(hard)) for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (50, None, "user", "a"), (51, 0, "user", "a"), (51, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as state", "'w' as part")
    segments = chat.format_segments(df)
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    formatted = {}
    for r in segments.collect():
        formatted.setdefault(r.conv_id, []).append((r.turn_no, ["open", "text", "close"].index(r.part), r.text))
    wanted = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(wanted)
    for c, turns in wanted.items():
        said = "".join(text for role, text in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(x[2]) for x in formatted[c])
    assert chat.read_back(chat.format_segments(df.limit(0))).collect() == []


def test_chat_marks_only_where_meant():
    codec, template = chat.Codec(chat.Template()), chat.Template()
    rng = random.Random(6)
    for _ in range(500):
        text = "".join(rng.choices([*template.control, template.escape, "<", ">", "[", "s", " ", "/"], k=8))
        coded = codec.write(text)
        assert codec.read(coded) == text and not any(m in coded for m in template.control)


def test_chat_text_alone_is_parsed():
    """Formatted text, cut anywhere, gives back the turns; cut short or without marks it is an error."""
    template = chat.Template()
    codec, rng = chat.Codec(template), random.Random(8)
    for _ in range(300):
        turns = [(rng.choice(["system", "user", "assistant", "tool", "", " [/ROLE]"]), "".join(rng.choices([*template.control, template.escape, "<", "</", "[", " ", "\n", "s>", "/INST]"], k=rng.randint(0, 6)))) for _ in range(4)]
        text = ""
        for role, said in turns:
            before = template.opening.get(role) or template.other[0] + codec.write(role) + template.other[1]
            text += before + codec.write(said) + template.closing.get(role, template.other[2])
        cuts = sorted(rng.choices(range(len(text) + 1), k=rng.randint(0, 30)))
        parser = chat.Parser(template)
        assert [t for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True) for t in parser.feed(text[a:b])] == turns
        parser.end()
    for wrong in ("[INST] x", "[INST] x [/INST]hello", "[RO"):
        with pytest.raises(ValueError):
            parser = chat.Parser(template)
            list(parser.feed(wrong))
            parser.end()


def test_turn_order(spark):
    orders = {1: "user assistant", 2: "system user assistant user", 3: "assistant user", 4: "user user", 5: "system", 6: "tool", 7: "system user"}
    rows = [(c, t, role, "x") for c, names in orders.items() for t, role in enumerate(names.split())]
    out = chat.read_back(chat.format_segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert {r.conv_id for r in out.collect() if r.valid} == {1, 2, 7}


def test_contamination_of_repeated_words(spark, docs):  # noqa: F811
    """Work doesn't grow with the product of both lengths: one word a thousand times against four thousand and a megabyte."""
    items = spark.createDataFrame([(1, "la " * 1000), (2, "la " * 9), (3, "la di " * 200)], "item_id long, text string")
    rows = [(1, "la " * 4000), (2, "a b " + "la " * 350_000), (3, "la " * 9 + "x"), (4, "la di " * 20_000), (5, "la " * 8)]
    got = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in decontaminate.contamination(docs(rows), items).collect()}
    assert got == {1: (4000, 4000, ["1", "2"]), 2: (350_002, 350_000, ["1", "2"]), 3: (10, 9, ["2"]), 4: (40_000, 40_000, ["3"]), 5: (8, 0, [])}
