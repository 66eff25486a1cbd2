"""Every registered query of the engine against DuckDB on the smallest tables."""

import pytest

from corpusloom.plans import catalog
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equal_to_sql(spark, con, name):
    same(con, catalog.queries()[name](spark, SF), catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs_without_sql(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_hamming_pairs_takes_every_vector(spark, tmp_path, monkeypatch):
    import random

    from corpusloom.functions import imghash

    monkeypatch.setattr(imghash, "BLOCK_ROWS", 32)
    rng = random.Random(1)
    grids = [[float(rng.random()) for _ in range(64)] for _ in range(200)]
    grids += [[x + 0.1 * rng.random() for x in grids[k]] for k in range(100)]
    rows = [(k, k % 3 if k else None, g) for k, g in enumerate(grids)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    bits = [[g[i + 1] > g[i] for i in range(64) if i % 8 != 7] for g in grids]
    apart = lambda a, b: sum(x != y for x, y in zip(bits[a], bits[b], strict=True))
    want = [(a, b, apart(a, b)) for b in range(1, 300) for a in range(1, b) if a % 3 == b % 3 and apart(a, b) < 20]
    assert any(a >= 120 for a, _, _ in want)
    assert sorted(map(tuple, catalog.queries()["hamming_pairs"](spark, str(tmp_path)).collect())) == sorted(want)
    near = {k: sorted([(d, b) for a, b, d in want if a == k] + [(d, a) for a, b, d in want if b == k]) for k in range(300)}
    got = {r["vec_id"]: (r["n_near"], r["distance"], r["nearest"]) for r in catalog.queries()["hamming_nearest"](spark, str(tmp_path)).collect()}
    assert got == {k: ((len(n), *n[0]) if n else (0, None, None)) for k, n in near.items()}
