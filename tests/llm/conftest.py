import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of given (doc_id, text) rows, with columns whose names clash with those that operators make."""

    def make(rows, parts=3):
        clash = [("lang", None), ("source", "s"), ("n_chars", None), ("spans", "x"), ("n", 1), ("component_id", 5), ("kept", "no"), ("blob", "b"), ("_row", 2), ("held_out", 3), ("n_tokens", 4), ("length", 6)]
        kinds = {str: "string", int: "long", type(None): "string"}
        sql = "doc_id long, text string, " + ", ".join(f"{n} {'long' if n == 'n_chars' else kinds[type(v)]}" for n, v in clash)
        return spark.createDataFrame([(i, t, *[v for _, v in clash]) for i, t in rows], sql).repartition(parts)

    return make
