import random

import pytest

#: Columns whose names the operators use themselves.
CLASHING = ["key", "mark", "doc", "row", "score", "label", "digest", "member", "cell", "block", "kept", "n_words",
            "items", "vec", "side", "x", "n", "word", "count", "_kept", "settled"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Texts with nulls, empty and very long ones, repeated rows, missing ids and shared
    passages, and extra columns with clashing names."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta", "été", "straße", "mit", "license", "the", "of", "x1", "漢字", "no", "be"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = "shared passage: " + line(30) + "."
    base = line(80)
    texts = [None, "", " ", "\n\t", "a", "!?", base, base, base + " more words here", passage, line(10) + " " + passage,
             passage + " " + line(12), "ab" * 40, "z" * 300, "Released under the MIT License. " + line(20), line(6000),
             "é" * 130, line(3), line(3), "Licensed under CC BY-NC 4.0.", base.upper(), line(40) + " " + line(5)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(6, base), (6, base), (9, line(25)), (None, passage), (None, None)]
    schema = "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *["junk"] * len(CLASHING)) for i, t in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
