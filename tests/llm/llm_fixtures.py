import os
import random

import pandas as pd
import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

#: Names that operators use inside; tables may have columns of these names too.
CLASHING = ["row_key", "text_key", "_key", "_id", "words", "n", "anchor", "body", "node", "region", "size", "shard", "slot", "number", "copies"]


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with the other columns and clashing ones."""

    def build(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        df = df.selectExpr("doc_id", "text", "'en' as lang", "cast(null as string) as source", "cast(char_length(text) as long) as n_chars")
        return df.selectExpr("*", *[f"'x' as `{c}`" for c in CLASHING]) if extra else df

    return build


@pytest.fixture(scope="session")
def real():
    """The smallest documents table, as (doc_id, text) pairs."""
    table = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    return list(zip(table.doc_id.tolist(), table.text.tolist(), strict=True))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows and ids, long texts, copies, near copies and shared passages."""
    rng = random.Random(1)
    vocabulary = ["a", "Bé", "the", "xx", "q", *(f"w{i}" for i in range(60))]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(30, 200))) for _ in range(6)]
    rows = [(90, None), (1, ""), (2, " \n\t"), (None, base[0]), (None, None), (3, base[0]), (3, base[0]), (3, base[0] + " tail"), (4, " ".join(["z"] * 400))]
    rows += [(5, base[1] + "\n\t " + base[2]), (6, "x y " + base[2][20:]), (7, base[3]), (8, base[4] + " " + base[4]), (9, "hello"), (10, "Hello"), (11, "hello there")]
    rows += [(12, " ".join(rng.choices(vocabulary, k=30)) + " " + base[3][:-30]), (13, " ".join(["y"] * 35)), (14, "y" * 49), (15, "y" * 50), (16, "y" * 50)]
    rows += [(17, base[5] + " " + " ".join(rng.choices(vocabulary, k=3000)) + " " + base[5]), (18, base[5].upper())]
    for i in range(30):
        words = base[i % 3].split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((100 + i, " ".join(words)))
    rng.shuffle(rows)
    return rows


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))
