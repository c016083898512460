import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, `key` string, id string"


def document(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), "clash", "clash", "clash", "clash")


def prose(seed, words=60, vocabulary=400):
    rng = random.Random(seed)
    names = ["".join(random.Random(n).choice("abcdefghijklmnoprstuvwy") for _ in range(3 + n % 6)) for n in range(vocabulary)]
    out = []
    for i in range(words):
        w = "the" if i % 5 == 0 else rng.choice(names)
        out.append(w.capitalize() + "." if i % 12 == 11 else w)
    return " ".join(out)


def edge_rows():
    """Nulls in every column, empty and blank texts, one very long text, repeated rows and ties."""
    long = "\n".join(prose(n, 200) for n in range(60))
    return [
        document(1, None), document(2, ""), document(3, " \n\t "), document(4, "one"), document(5, "One  two"),
        document(6, long, "b"), document(7, prose(1), None), document(7, prose(1), None), document(8, prose(1), "c"),
        document(9, "é😀 ▁ <|im_end|> \x00 " + prose(2), "b"), (None, None, None, None, None, None, None, None, None),
        (None, prose(3), None, None, None, None, None, None, None), document(10, prose(4) + " x", "b"), document(11, prose(4) + " y", "a"),
        document(12, "ONE two"), document(13, "spam " * 50),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.createDataFrame([document(n, prose(n, 20 + n % 70), f"s{n % 7}") for n in range(150)], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
