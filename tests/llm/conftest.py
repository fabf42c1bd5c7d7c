import random

import pytest

SF = "/root/testdata/sf0.001"
WORDS = ["ba", "Ke", "lo", "mi", "Nu", "pe", "ra", "Sö", "tü", "wo", "xa", "zé"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and blank and long texts, ties, repeated rows, near copies, shared passages."""
    rng = random.Random(3)
    base, passage = prose(rng, 120), prose(rng, 60)
    near = base.split(" ")
    near[50] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "en", None), (4, None, None, None),
        (5, "", "de", "b"), (6, " \n\t ", "de", "b"), (7, "one", "fr", "b"), (8, "ONE", "fr", "b"),
        (9, prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30), "en", "a"),
        (10, prose(rng, 40) + "\n" + passage, None, "a"), (10, prose(rng, 40) + "\n" + passage, None, "a"),
        (None, passage, "en", "c"), (None, prose(rng, 80), None, None),
        (11, ("la la la " * 9000) + prose(rng, 3000), "en", "a"), (12, "x" * 5000, "es", "c"),
        (13, "<|endoftext|> mark " + prose(rng, 55), "en", "a"), (14, "#*$ 123 456", "en", "a"),
    ]
    rows.append(rows[8])
    rows += [(100 + i, prose(rng, 20 + 7 * (i % 9)), ["en", "de", None][i % 3], "abc"[i % 3]) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows with further columns whose names the operators use themselves."""
    extra = ["th", "node", "label", "value", "spans", "n_words", "host", "start", "key", "probability",
             "row", "drawn", "removed_lines", "dim0", "times", "__th", "__p", "__spans", "none", "hits", "piece"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"`{x}` string" for x in extra)
    return spark.createDataFrame([(i, t, g, s, len(t or ""), *extra) for i, t, g, s in edge_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
