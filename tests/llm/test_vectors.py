"""Operators on embeddings against brute force: hand-made rows, and the registered queries on small tables."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from hypothesis.extra import numpy as hnp
from pyspark.sql import functions as F

from crewcast.llm import hard_negatives, neighbours, whitening
from crewcast.llm.queries import QUERIES, every_hundredth
from crewcast.llm.vectors import Best

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, id string, rank string, score int, vector int"
NAN, INF = float("nan"), float("inf")


def odd_rows(count: int = 60, size: int = 5) -> list[tuple]:
    """Incomplete, zero, repeated and equal vectors, null ids and labels, one short vector; columns named like inner ones."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=size).round(2).tolist(), i % 3, "x", "y", 1, 2) for i in range(count)]
    same = rows[7][1]
    rows += [(100 + i, same, i % 2, None, None, None, None) for i in range(30)]
    rows += [(rows[5]), (rows[5]), (200, None, 1, "x", "y", 1, 2), (201, [1.0, None, 0.0, 0.0, 1.0], 1, "x", "y", 1, 2), (202, [NAN] * size, 1, "x", "y", 1, 2),
             (203, [INF] + [0.0] * (size - 1), 1, "x", "y", 1, 2), (204, [0.0] * size, 1, "x", "y", 1, 2), (205, [], 1, "x", "y", 1, 2),
             (206, [1.0, 2.0], 1, "x", "y", 1, 2), (None, same, 1, "x", "y", 1, 2), (207, same, None, "x", "y", 1, 2)]
    return rows


def complete(rows: list[tuple], size: int = 5) -> list[tuple]:
    return [r for r in rows if r[1] is not None and len(r[1]) == size and all(c is not None and np.isfinite(c) for c in r[1])]


@pytest.fixture
def odd(frame):
    return frame(odd_rows(), SCHEMA)


@pytest.fixture
def nothing(frame):
    return frame([], SCHEMA)


whole = st.integers(-(2**20), 2**20)


@settings(max_examples=60, deadline=None)
@given(st.data(), st.integers(1, 9), st.integers(1, 9), st.integers(1, 9), st.integers(1, 3))
def test_strassen_is_the_plain_product(data, m, k, n, leaf):
    a = data.draw(hnp.arrays(np.int64, (m, k), elements=whole))
    b = data.draw(hnp.arrays(np.int64, (k, n), elements=whole))
    assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.integers(0, 9)), max_size=40), st.integers(1, 4), st.integers(0, 40))
def test_heaps_merge(entries, keep, cut):
    best = Best(3, keep)
    for part in (entries[:cut], entries[cut:]):
        if part:
            best.add(*(np.array(x) for x in zip(*part)))
    want = [e for line in range(3) for e in sorted({e for e in entries if e[0] == line}, key=lambda e: (-e[1], e[2]))[:keep]]
    assert list(zip(best.line, best.score, best.id)) == want


def mined(rows: list[tuple], is_anchor, positives=5, negatives=10) -> list[tuple]:
    """Plain form: rows (id, label, vector)."""
    out = set()
    rows = sorted({(i, l, tuple(v)) for i, l, v in rows})
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    for a in rows:
        if not is_anchor(a[0]):
            continue
        near = sorted({(-score(a, b), b[0]) for b in rows if b[1] == a[1] and b[0] != a[0]})[:positives]
        for p, key in near:
            window = sorted({(-score(a, b), b[0]) for b in rows if b[1] != a[1] and 30 * -p <= 100 * score(a, b) <= 90 * -p})[:negatives]
            out.update((a[0], key, n + 1, other, -p, -s) for n, (s, other) in enumerate(window))
    return sorted(out)


@pytest.mark.parametrize("at_once", [3, 16_384])
def test_hard_negatives_of_odd_rows(odd, nothing, values, at_once):
    rows = [(r[0], r[2], np.floor(256 * np.float32(r[1]).astype(float)).astype(int).tolist()) for r in complete(odd_rows()) if r[0] is not None and r[2] is not None]
    whole = odd.withColumn("embedding", F.transform("embedding", lambda c: F.floor(256 * c.cast("double"))))
    small = hard_negatives.Settings(anchors=at_once, tile=(4, 7), leaf=2)
    found = hard_negatives.mine(whole.filter("NOT exists(embedding, c -> c > 1e9)"), lambda c: c % 10 == 0, settings=small)
    assert values(found) == sorted(mined(rows, lambda i: i % 10 == 0), key=repr)
    assert hard_negatives.mine(nothing.withColumn("embedding", F.col("embedding").cast("array<long>")), every_hundredth).collect() == []


def test_scores_that_do_not_fit_are_refused(frame):
    rows = frame([(0, [2.0**40] * 2, 1), (1, [2.0**40] * 2, 2)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.mine(rows, every_hundredth)


def whitened(vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    around = vectors - vectors.mean(0)
    values, axes = np.linalg.eigh(around.T @ around / len(vectors))
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return around @ axes / np.sqrt(values), values


def test_whitening_of_odd_rows(odd, nothing, frame, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    monkeypatch.setattr(whitening, "TASK_BLOCKS", 2)
    entry = lambda c: F.floor(1024 * c) + 100_000
    kept = complete(odd_rows())
    x = np.floor(1024 * np.array([np.float32(r[1]).astype(float) for r in kept])).astype(int) + 100_000
    want, eigen = whitened(x.astype(float), 3)
    rows = whitening.whiten(odd, 3, entry=entry).collect()
    assert len(rows) == 3 * len(kept) and {r["n"] for r in rows} == {len(kept)}
    assert all(r["identity_error"] < 1e-9 for r in rows)
    away = ((len(x) * x - x.sum(0)) ** 2).sum(1)
    key = lambda i: (i is None, i or 0)
    for c in (1, 2, 3):
        got = sorted(((key(r["id"]), r["deviation"], r["whitened"]) for r in rows if r["component"] == c))
        for sign in (1, -1):
            plain = sorted((key(r[0]), int(d), sign * w) for r, d, w in zip(kept, away, want[:, c - 1]))
            if np.allclose([g[2] for g in got], [p[2] for p in plain], atol=1e-8):
                break
        else:
            raise AssertionError(c)
        assert [g[:2] for g in got] == [p[:2] for p in plain]
    for few in (nothing, frame([r for r in odd_rows() if r[0] == 1], SCHEMA), frame([odd_rows()[61]] * 4, SCHEMA)):
        assert whitening.whiten(few, entry=entry).collect() == []


def test_a_deviation_beyond_a_long_is_null(frame):
    rows = whitening.whiten(frame([(i, [i * 2**32, 0]) for i in range(4)], "vec_id long, embedding array<long>")).collect()
    assert [r["deviation"] for r in rows] == [None] * 4 and all(r["component"] == 1 for r in rows)


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3)])
def test_hilbert_neighbours_on_the_curve_are_neighbours_in_space(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * axes), -1).reshape(-1, axes)
    keys = neighbours.hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    along = cells[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def nearest(rows: list[tuple], keep: int) -> dict:
    """Plain form of the search over rows (id, vector), queries being ids divisible by 10."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for i, v in rows:
        if i % 10 == 0:
            far = sorted({(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in rows if j != i})
            out[i] = [(j, d) for d, j in far[:keep]]
    return out


def test_neighbours_of_odd_rows(odd, nothing):
    rows = [(r[0], np.float32(r[1]).astype(float).tolist()) for r in complete(odd_rows()) if r[0] is not None and any(r[1])]
    small = neighbours.Settings(neighbours=4, axes=3, bits=5, block=8, queries=3, recall=1.0)
    found = {}
    for r in sorted(neighbours.search(odd, lambda c: c % 10 == 0, settings=small).collect()):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found == nearest(rows, 4)  # every row is a probe, so the window finds all
    assert neighbours.search(nothing, every_hundredth).collect() == []


def test_neighbours_of_few_rows_are_all_candidates(frame):
    rows = frame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 0.0])], "vec_id long, embedding array<double>")
    found = [tuple(r) for r in neighbours.search(rows, every_hundredth).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 100, 0.0), (0, 2, 1, 2**0.5), (100, 1, 0, 0.0), (100, 2, 1, 2**0.5)]


def test_registered_search_finds_nine_in_ten(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").toPandas()
    vectors, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    found = QUERIES["op13_nearest_neighbours"](spark, FOLDER).toPandas().sort_values(["query_id", "rank"])
    hits = 0
    for q in range(0, len(ids), 100):
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        got = found[found["query_id"] == ids[q]]
        assert got["rank"].tolist() == list(range(1, 11)) and (got["score"].to_numpy() == far[got["vec_id"]]).all()
        far[q] = np.inf
        hits += len(set(got["vec_id"]) & set(np.lexsort((ids, far))[:10]))
    assert hits >= 0.9 * 10 * len(range(0, len(ids), 100))


def test_registered_whitening_equals_numpy(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.floor(1024 * np.stack(rows["embedding"]).astype(float)) + 100_000
    want, values = whitened(x, 8)
    got = QUERIES["op12_embedding_whitening"](spark, FOLDER).toPandas().sort_values(["component", "vec_id"])
    plain = got["whitened"].to_numpy().reshape(8, -1).T
    signs = np.sign((plain * want).sum(0))
    assert np.abs(plain - want * signs).max() < 1e-8
    assert got["identity_error"].max() < 1e-9 and np.allclose(got.groupby("component")["explained"].first(), values / np.trace(np.cov(x.T, bias=True)))
