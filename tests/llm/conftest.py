import random

import pytest

SF = "/root/testdata/sf0.001"
CLASHES = {"n": 1, "key": "k", "family": 2, "component": 3, "slot": 4, "block": 5, "h": 6, "s": 7,
           "part": 8, "_next": 9, "print": "p", "edited": "e", "score": 0.5, "weight": 1.5,
           "errors": 1, "item_id": 7}


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    letters = str.maketrans("0123456789", "ghijklmnop")
    return " ".join(f"w{draw.randrange(vocabulary):x}q".translate(letters) for _ in range(words))


EDGE_TEXTS = [
    None, "", " \n\t ", "Word", "two words", "12345 !!! ...", prose(1, 60), prose(1, 60),
    prose(1, 60).upper(), prose(2, 60) + " tail", prose(2, 60), "a" * 4000, "ab " * 30_000,
    prose(3, 20_000, 5000), "naïve Ünïcode — «ça» 漢字 " * 20, "x" * 49, "y" * 50, "y" * 51]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with null, empty, very long, tied and repeated rows, and clashing columns."""
    rows = [(i * 3, t, ["en", "de", None][i % 3], ["a", None, "b"][i % 3], len(t or ""),
             *CLASHES.values()) for i, t in enumerate(EDGE_TEXTS)]
    rows += rows[6:8]
    kinds = {str: "string", int: "long", float: "double"}
    extra = ", ".join(f"{n} {kinds[type(v)]}" for n, v in CLASHES.items())
    return spark.createDataFrame(
        rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def by_id(rows, key="doc_id"):
    found = {}
    for row in rows:
        found.setdefault(row[key], []).append(row)
    return found
