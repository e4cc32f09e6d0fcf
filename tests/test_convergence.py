"""Verdicts against the rule written out for one series."""

import numpy as np
import pytest

from surveyloom.operators import convergence as V


def judge(series, sd, n_missing, final, sigma=2.0):
    n, tail = len(series), max(1, len(series) // 3)
    sd = sd if sd > 0 else 1.0
    level = float(np.mean(series[-tail:]))
    band = sigma * sd / np.sqrt(max(1, n_missing))
    outside = [i + 1 for i, v in enumerate(series) if abs(v - level) > band]
    converged = 1 if not outside else min(outside[-1] + 1, n)
    drift = abs(float(np.mean(series[:tail])) - level) / sd
    moves = [abs(v - level) for v in series[final - 1 :]]
    return level, converged, drift, max(moves) / sd if moves else None


def test_verdicts(spark):
    rng = np.random.default_rng(3)
    series = {}
    for i in range(30):
        n = int(rng.integers(1, 13))
        start, noise = rng.normal() * 5, rng.random() * 2
        series["c%d" % (i % 3), f"f{i}"] = (
            [float(start * 0.5**t + rng.normal() * noise) for t in range(n)], float(rng.choice([0.0, 1.0, 4.0])), int(rng.integers(0, 200)),
        )
    rows = [(c, f, t + 1, v, m, sd) for (c, f), (s, sd, m) in series.items() for t, v in enumerate(s)]
    trace = spark.createDataFrame(rows, "cell string, feature string, iteration int, mean_imputed double, n_missing long, sd_obs double")
    stable = V.stability(V.verdicts(trace, ["cell"])).cache()
    got = {(r["cell"], r["feature"]): r for r in stable.collect()}
    unstable = {}
    for key, (s, sd, m) in series.items():
        level, converged, drift, deviation = judge(s, sd, m, 5)
        r = got[key]
        assert r["level"] == pytest.approx(level) and r["converged_at"] == converged and r["drift"] == pytest.approx(drift)
        assert r["deviation"] == (None if deviation is None else pytest.approx(deviation))
        assert r["measured"] == (m >= 50) and r["unstable"] == (m >= 50 and deviation is not None and deviation > 0.30)
        if r["unstable"]:
            unstable[key[1]] = unstable.get(key[1], 0) + 1
    assert {r["feature"]: r["n_cells"] for r in V.unstable_features(stable).collect()} == unstable
    cells = {r["cell"]: r for r in V.cell_summary(stable, ["cell"]).collect()}
    for c, r in cells.items():
        mine = [x for (cell, _), x in got.items() if cell == c]
        assert (r["n_features"], r["n_measured"], r["n_unstable"]) == (len(mine), sum(x["measured"] for x in mine), sum(x["unstable"] for x in mine))
        assert r["n_settled"] + r["n_unstable"] == r["n_measured"] and r["n_ignored"] + r["n_measured"] == r["n_features"]
    top = V.most_missing(stable, ["cell"], top=2).collect()
    for c in cells:
        want = sorted([(-x["n_missing"], x["feature"]) for (cell, _), x in got.items() if cell == c and x["measured"]])[:2]
        assert sorted((-r["n_missing"], r["feature"]) for r in top if r["cell"] == c) == sorted(want)
