import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, node string, prefix string, terms string, x string, p_id string, kept_id string, part string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls everywhere, empty and blank texts, a very long one, copies, near copies, repeated rows and keys."""
    base = prose(1, 120)
    long = prose(2, 60_000, 50_000)
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "One  two"), (6, long), (7, base), (8, base), (9, base.replace("w1 ", "v1 ", 1)),
        (10, base + " tail"), (None, base), (None, None), (11, "solo é ß 日本語   x"), (12, prose(3, 80)), (12, prose(4, 80)), (13, prose(5, 40)), (13, prose(5, 40)),
        (14, "mail me: a.b@c.example.org_x@d.e, ip 1.2.3.4.5.6.7.8 or 300.1.1.1; card 4111-1111 1111 1111, +1 (555) 010-9999."), (15, "x" * 50_000 + "@" + "1." * 40_000 + "9 " * 30_000),
    ]
    texts += [((1 << 60) + 1, prose(6, 30)), ((1 << 60) + 2, prose(7, 30))]  # next to null keys
    return [(k, t, None if k == 4 else "en", None, None, 1, "a", None, "b", None, "c", None, "d") for k, t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
