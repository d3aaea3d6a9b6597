import numpy as np
import pytest

from cellrisk.operators.information import neighbour_information


def psi(n):
    """Digamma of a whole number as a harmonic sum."""
    return sum(1.0 / i for i in range(1, n)) - 0.5772156649015329


def plain(values, labels, k=3):
    keep = [(v, g) for v, g in zip(values, labels) if v is not None and not np.isnan(v) and g is not None]
    sizes = {g: sum(1 for _, h in keep if h == g) for _, g in keep}
    keep = [(v, g) for v, g in keep if sizes[g] > 1]
    if not keep:
        return None
    v, g = np.array([a for a, _ in keep]), np.array([b for _, b in keep])
    total = 0.0
    for i in range(len(v)):
        away = np.abs(v - v[i])
        mates = np.sort(np.delete(away, i)[np.delete(g, i) == g[i]])
        reach = mates[min(k, len(mates)) - 1]
        inside = away == 0 if reach == 0 else away < reach
        total += psi(len(v)) - psi(sizes[g[i]]) + psi(int((inside & (g == g[i])).sum())) - psi(int(inside.sum()))
    return max(total / len(v), 0.0)


@pytest.mark.parametrize("k", [1, 3, 5])
def test_equals_plain_version(spark, k):
    rng = np.random.default_rng(5)
    labels = [int(x) if x < 3 else None for x in rng.choice(4, 400, p=[0.55, 0.3, 0.1, 0.05])] + [9, 7, 7]
    base = np.array([x or 0 for x in labels])
    columns = {
        "smooth": (rng.normal(0, 1, 403) + base).tolist(),
        "whole": [float(x) for x in rng.poisson(2 + base % 3)],
        "hot": [0.0 if rng.random() < 0.5 else float(x) for x in rng.exponential(1 + base % 3)],
        "constant": [4.0] * 403,
        "holes": [None if rng.random() < 0.2 else float("nan") if rng.random() < 0.1 else float(x) for x in rng.normal(0, 1, 403)],
        "empty": [None] * 403,
    }
    rows = [(*[columns[c][i] for c in columns], labels[i]) for i in range(403)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns) + ", g int")
    # Small blocks, so that many neighbours lie behind a border.
    found = {x["feature"]: x["mi"] for x in neighbour_information(df, list(columns), "g", k, block=12).collect()}
    for c in columns:
        want = plain(columns[c], labels, k)
        assert found[c] is None if want is None else found[c] == pytest.approx(want, abs=2e-6), c


def test_empty_table_and_refused_parameters(spark):
    df = spark.createDataFrame([], "x double, g int")
    assert [tuple(r) for r in neighbour_information(df, ["x"], "g").collect()] == [("x", None)]
    with pytest.raises(ValueError):
        neighbour_information(df, ["x"], "g", k=0)
