import random

import pytest
from llm_fixtures import prose

CLASH = ("id", "digest", "row", "fp", "component", "spans", "key", "part", "ids", "sig")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with nulls, an empty and a very long text, ties, repeated
    rows, ids that repeat, and extra columns whose names operators use."""
    rng = random.Random(3)
    same = prose(rng, 60)
    lines = "\n".join(prose(rng, 9) for _ in range(12))
    rows = [
        (0, same), (1, same), (2, same + " tail"), (3, ""), (4, None), (5, "   \n\t "), (6, "word"),
        (7, "é" * 70 + " ünïcode \U0001F600 text"), (8, lines), (9, "first line\n" + lines + "\nlast line"),
        (10, prose(rng, 30_000)), (11, "x" * 20_000), (12, "1 " * 5_000), (13, prose(rng, 3)),
        (13, prose(rng, 50)), (14, prose(rng, 40)), (14, None), (None, same), (None, None),
        (15, "á <|endoftext|> B. c, D\x1ce\x85f"), (16, "\n\n\n\n"), (17, lines.replace("\n", "\r\n")),
    ]
    rows += [rows[9], rows[9], rows[3]]  # repeated rows
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASH)
    data = [(i, t, "en" if i else None, None, None if t is None else len(t), *["z"] * len(CLASH)) for i, t in rows]
    return spark.createDataFrame(data, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
