from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, {}"
FOLDER = "/root/testdata/sf0.001"

LINE = "one two three four five six seven eight nine ten eleven twelve"
PROSE = " ".join(f"word{i} and the rest of it," for i in range(40))


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def texts():
    """Odd texts: null, empty, blank, long, repeated, not Latin, with marks and numbers."""
    long = " ".join(f"{w}{i % 997}" for i in range(30_000) for w in ("alpha", "beta"))
    return [
        (1, None, "s"),
        (2, "", "s"),
        (3, " \t\n ", None),
        (4, long, "s"),
        (5, PROSE, "s"),
        (6, PROSE, "t"),
        (6, PROSE, "t"),  # a repeated row
        (7, PROSE + " more", "t"),
        (8, "a" * 50_000, None),
        (9, "\n".join([LINE] * 5), "u"),
        (10, "Ä ß İ Σ ς 漢字   \x1c x's don't 😀 <|endoftext|> 12,5 ...", "u"),
        (11, "7" * 30_000, "u"),
        (12, "mail a.b@c.de, b@@x.y z@w.co.uk%q@r.st 1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.255", "u"),
        (13, "card 4111 1111 1111 1111 and 4111-1111-1111-1112; call +1 (372) 555-7739 or 372 555-7739.", "u"),
        (None, "no id", None),
        (None, "no id", None),
        (-5, "x", ""),
        (-(2**63) + 1, "x", ""),
    ]


@pytest.fixture(scope="session")
def odd(spark, texts):
    """The odd texts with extra columns whose names clash with those of results."""
    clash = (
        "kept string, size int, score string, shard string, length int, `offset` int, "
        "fingerprint int, target int, html string, spans int"
    )
    rows = [(i, t, "en", s, 1, *["clash", 1, "x", "y", 2, 3, 4, 5, "h", 6]) for i, t, s in texts]
    return spark.createDataFrame(rows, DOCS.format(clash)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(-5, 14)] + [(None, 1, 0), (5, None, 0), (5, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def table_rows(df, columns):
    return sorted(map(repr, (tuple(row[c] for c in columns) for row in df.collect())))
