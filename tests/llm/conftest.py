import pytest


@pytest.fixture()
def frame(spark):
    """Rows given as dicts, with a schema string."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def union_find(ids, pairs):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
