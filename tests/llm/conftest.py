import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, words string, score double, label string, kept boolean, row string, block int, h int"


def prose(rnd, n):
    return " ".join(rnd.choice("the of and to in alpha beta gamma delta Epsilon zeta, eta. theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()) for _ in range(n))


def nasty():
    """Texts with every odd case: null, empty, blank, one word, very long, repeated rows and ids, odd spaces, near and exact copies."""
    rnd = random.Random(7)
    base = prose(rnd, 300)
    near = base.split()
    near[150] = "changed"
    soup = " ".join(w + "###$$$" for w in prose(rnd, 120).split())
    texts = [None, "", " \n\t ", "one", "two words", base, base, " ".join(near), base.upper(), prose(rnd, 20000), "x" * 50000, soup,
             "a\x0bb\x0cc\xa0d e  f\r\ng", "Released under the MIT License.\nmit license mit license", "Licensed under the Apache License, Version 2.0, and more",
             "line\nline\nline\nother line", prose(rnd, 12), "é è ê à ü ñ <|endoftext|> \U0001f642 ß", "0 1 2 3 4 5 6 7 8 9 10 11", "General Public License"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, base), (None, base), (None, None), (3, "one")]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", "s", 1, "k", "w", 0.5, "l", True, "r", 1, 1) for i, t in nasty()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path
