"""Properties of the imputation, its indicators and its trace."""

from dataclasses import replace
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from surveyloom.operators import impute as I, trees
from surveyloom.session import materialise
from surveyloom.specs import ImputeRule

BY = ["source_flag", "kohort"]
RULE = ImputeRule(exclude=frozenset({"source_flag", "kohort", "id", "label"}), never=frozenset({"visits"}), min_values=50, row_key=("id",))
CODED = frozenset({"code"})


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        source = "a" if i % 3 else "b"
        cohort = None if i % 50 == 0 else ("young" if i % 2 else "old")
        x, y = rng.normal(), rng.normal()
        z = 2 * x - y + 0.1 * rng.normal() + (5 if source == "a" else 0)
        code = float(np.clip(round(2 + x), 1, 4))
        gap = rng.random(5) < 0.25
        rows.append((
            i, source, cohort, int(rng.random() < 0.3), x, None if gap[0] else y, None if gap[1] else z,
            None if gap[2] else code, None if gap[3] else float(i % 4), None if source == "a" else x, 7.0 if gap[4] else None,
        ))
    return spark.createDataFrame(
        rows, "id int, source_flag string, kohort string, label int, x double, y double, z double, code double, visits double, only_b double, constant double"
    ).cache()


def rows_of(df):
    return {r["id"]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def filled(table):
    return rows_of(I.impute_linear(table, RULE, CODED, "label", {"a": ["x", "y", "z", "code", "visits", "constant"], "b": table.columns}))


def test_keeps_what_is_known(table, filled):
    for i, before in rows_of(table).items():
        for c, v in before.items():
            if v is not None:
                assert filled[i][c] == v


def test_no_gap_left_in_eligible_features(filled):
    for r in filled.values():
        if r["kohort"] is None:
            continue
        assert None not in (r["x"], r["y"], r["z"], r["code"])
        assert r["code"] in (1.0, 2.0, 3.0, 4.0)


def test_rows_without_a_cohort_pass(table, filled):
    before = rows_of(table)
    for i, r in filled.items():
        if r["kohort"] is None:
            assert {c: r[c] for c in before[i]} == before[i]
            assert all(r[c] is None for c in r if c.endswith("_missing"))


def test_indicators(table, filled):
    before = rows_of(table)
    assert {c for c in filled[1] if c.endswith("_missing")} == {"y_missing", "z_missing", "code_missing", "visits_missing", "constant_missing"}
    for i, r in filled.items():
        if r["kohort"] is not None:
            assert r["z_missing"] == int(before[i]["z"] is None)
            assert r["visits_missing"] == int(before[i]["visits"] is None)
            assert r["visits"] == before[i]["visits"] and r["constant"] == before[i]["constant"]


def test_recovers_a_relation_better_than_the_mean(table, filled):
    before, rng, errors, spread = rows_of(table), None, [], []
    for i, r in filled.items():
        if before[i]["z"] is None and before[i]["y"] is not None and r["kohort"]:
            want = 2 * before[i]["x"] - before[i]["y"] + (5 if r["source_flag"] == "a" else 0)
            errors.append(r["z"] - want)
            spread.append(want)
    assert rng is None and np.std(errors) < 0.2 * np.std(spread)


def test_same_for_any_partitioning_and_blocks(table, filled):
    present = {"a": ["x", "y", "z", "code", "visits", "constant"], "b": table.columns}
    again = rows_of(I.impute_linear(table.repartition(3, "z"), RULE, CODED, "label", present))
    for i, r in filled.items():
        for c in ("y", "z", "code"):
            assert again[i][c] == (None if r[c] is None else pytest.approx(r[c], abs=1e-7))
    chain = rows_of(I.impute_linear(table, replace(RULE, block_size=1, sweeps=8), CODED, "label", present))
    off = [chain[i]["z"] - filled[i]["z"] for i in filled if filled[i]["kohort"]]
    assert np.std(off) < 0.1


def test_cells_do_not_depend_on_others_or_on_batches(spark, table, filled):
    present = {"a": ["x", "y", "z", "code", "visits", "constant"], "b": table.columns}
    more = spark.range(60_000).selectExpr(
        "CAST(100000 + id AS INT) AS id", "concat('m', id % 1000) AS source_flag", "'old' AS kohort", "0 AS label",
        "CAST(id % 13 AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS y", "IF(id % 5 = 0, NULL, CAST(id % 11 AS DOUBLE)) AS z",
        "IF(id % 3 = 0, NULL, CAST(9 + id % 2 AS DOUBLE)) AS code", "1D AS visits", "1D AS only_b", "7D AS constant",
    )
    # matrices of very few cells fit a batch
    rule = replace(RULE, gram_bytes=30_000)
    imputer = I.ChainedImputer(rule, CODED, "label", present).fit(table.unionByName(more))
    assert len(imputer.batches) > 2
    again = rows_of(imputer.transform().where("id < 100000"))
    for i, r in filled.items():
        for c in ("y", "z", "code"):
            assert again[i][c] == (None if r[c] is None else pytest.approx(r[c], abs=1e-7))


def test_only_coefficients_reach_the_driver(table, monkeypatch):
    seen = []
    real = I.DataFrame.collect
    monkeypatch.setattr(I.DataFrame, "collect", lambda df: (seen.append(df.columns), real(df))[1])
    imputer = I.ChainedImputer(replace(RULE, sweeps=2), CODED, "label").fit(table)
    assert not any("gram" in c for columns in seen for c in columns)
    plan = imputer.transform()._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


def test_codes_would_be_missed_without_snapping(table, monkeypatch):
    monkeypatch.setattr(I, "_nearest", lambda codes, values: values)
    out = I.impute_linear(table, RULE, CODED, "label")
    assert out.where("kohort IS NOT NULL AND code NOT IN (1, 2, 3, 4)").count() > 0


def test_never_reads_the_label(table, filled):
    flipped = table.withColumn("label", 1 - F.col("label"))
    with pytest.raises(ValueError, match="excluded"):
        I.ChainedImputer(replace(RULE, exclude=frozenset(BY)), label="label")
    out = I.ChainedImputer(RULE, CODED, "label")
    out._prepare(flipped)
    assert "label" not in out.features and "id" not in out.features


def test_eligibility_bounds(spark):
    rows = [("s", "k", float(i), float(i % 5) if i < 99 else None, float(i % 5) if i < 100 else None, 1.0, float(i) if i < 180 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "source_flag string, kohort string, a double, n99 double, n100 double, one double, tenth double")
    rule = ImputeRule(exclude=frozenset(BY))
    got = {r["feature"]: (r["eligible"], r["indicator"]) for r in I.eligibility(df, ["a", "n99", "n100", "one", "tenth"], BY, rule).collect()}
    assert got == {"a": (True, False), "n99": (False, True), "n100": (True, True), "one": (False, False), "tenth": (True, True)}
    assert I.imputation_matrix(df, rule, "k").columns == ["a", "n100", "tenth"]


def test_trace_counts_and_settles(table):
    imputer = I.ChainedImputer(replace(RULE, sweeps=6), CODED, "label").fit(table, log=True)
    trace = imputer.trace().collect()
    known = {(r["source_flag"], r["kohort"]): r for r in table.groupBy(*BY).agg(F.count_if(F.col("z").isNull()).alias("gaps"), F.stddev_pop("z").alias("sd")).collect()}
    z = [r for r in trace if r["feature"] == "z"]
    assert len(z) == 4 * 6
    for r in z:
        cell = known[r["source_flag"], r["kohort"]]
        assert r["n_missing"] == cell["gaps"] and r["sd_obs"] == pytest.approx(cell["sd"])
    last = {(r["source_flag"], r["kohort"], r["iteration"]): r["mean_imputed"] for r in z}
    assert all(abs(last[s, k, 6] - last[s, k, 5]) < 0.01 for s in "ab" for k in ("young", "old"))
    # the log's last sweep is what the table is filled with
    out = imputer.transform().where("z_missing = 1").groupBy(*BY).agg(F.avg("z").alias("z")).collect()
    assert len(out) == 4 and all(last[r["source_flag"], r["kohort"], 6] == pytest.approx(r["z"]) for r in out)


def test_nothing_to_impute(spark):
    df = spark.createDataFrame([("s", "k", 1.0), ("s", "k", 2.0)], "source_flag string, kohort string, a double")
    imputer = I.ChainedImputer(ImputeRule(exclude=frozenset(BY))).fit(df)
    assert sorted(map(tuple, imputer.transform().collect())) == [("s", "k", 1.0), ("s", "k", 2.0)]
    with pytest.raises(ValueError):
        imputer.trace()


@pytest.fixture(scope="module")
def by_trees(table):
    return rows_of(I.impute_tree(table, replace(RULE, sweeps=2, min_leaf=5), CODED, "label", trees=3, depth=4))


def test_trees(table, by_trees):
    before, errors, spread = rows_of(table), [], []
    assert len(by_trees) == len(before)
    for i, r in by_trees.items():
        if r["kohort"] is None:
            assert {c: r[c] for c in before[i]} == before[i]
            continue
        assert r["z"] is not None and r["code"] in (1.0, 2.0, 3.0, 4.0)
        for c, v in before[i].items():
            assert v is None or r[c] == v
        if before[i]["z"] is None and before[i]["y"] is not None:
            spread.append(2 * before[i]["x"] - before[i]["y"] + (5 if r["source_flag"] == "a" else 0))
            errors.append(r["z"] - spread[-1])
    assert np.std(errors) < 0.5 * np.std(spread)


def test_trees_do_not_depend_on_layout_other_cells_or_batches(spark, table, by_trees):
    """Sums are of whole numbers, so values are the same to the last bit."""
    more = spark.range(6000).selectExpr(
        "CAST(100000 + id AS INT) AS id", "concat('m', id % 4) AS source_flag", "'old' AS kohort", "0 AS label",
        "CAST(id % 13 AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS y", "IF(id % 5 = 0, NULL, CAST(id % 11 AS DOUBLE)) AS z",
        "IF(id % 3 = 0, NULL, CAST(9 + id % 2 AS DOUBLE)) AS code", "1D AS visits", "1D AS only_b", "7D AS constant",
    )
    rule = replace(RULE, sweeps=2, min_leaf=5)
    whole = I.TreeImputer(rule, CODED, "label", trees=3, depth=4).fit(table.unionByName(more).repartition(7))
    again = rows_of(whole.transform().where("id < 100000"))
    # the profile's means are sums of doubles, whose last digits depend on their order
    for i, r in by_trees.items():
        for c in ("y", "z", "code"):
            assert again[i][c] == (None if r[c] is None else pytest.approx(r[c], abs=1e-6))
    split = I.TreeImputer(replace(rule, gram_bytes=500), CODED, "label", trees=3, depth=4).fit(table)
    assert len(split.batches) > 1 and not split.history
    again = rows_of(split.transform())
    for i, r in by_trees.items():
        for c in ("y", "z", "code"):
            assert again[i][c] == (None if r[c] is None else pytest.approx(r[c], abs=1e-6))


def test_a_level_of_all_trees_is_one_pass(table, monkeypatch):
    seen = []
    real = I.DataFrame.collect
    monkeypatch.setattr(I.DataFrame, "collect", lambda df: (seen.append(df.columns), real(df))[1])
    I.TreeImputer(replace(RULE, sweeps=2, min_leaf=5), CODED, "label", trees=2, depth=3).fit(table)
    assert len([c for c in seen if "n_left" in c]) <= 2 * 2 * 3
    assert not any(x in c for c in seen for x in ("sums", "counts", "gram"))


def test_a_tree_against_all_splits():
    """The first split lowers the squares most of all features and cuts."""
    from surveyloom.operators import trees as T

    rng = np.random.default_rng(7)
    z = np.round(rng.normal(size=(400, 4)), 1)
    z[:, 3] = np.where(z[:, 1] < 0.3, -1.0, 1.5) + 0.1 * rng.normal(size=400)
    low, high = z.min(axis=0), z.max(axis=0)
    step = np.clip((z - low) / (high - low) * T.STEPS, 0, T.STEPS - 1).astype(int)
    counts = np.concatenate([np.bincount(step[:, f], minlength=T.STEPS) for f in range(4)])
    cuts = T.cuts_of(counts, low, high, 127)
    assert [len(c) for c in cuts[:3]] == [len(np.unique(z[:, f])) - 1 for f in range(3)] and len(cuts[3]) <= 126
    y, best = z[:, 3], None
    for f in range(3):
        for cut in cuts[f]:
            left = z[:, f] < cut
            if min(left.sum(), (~left).sum()) >= 5:
                left_over = ((y[left] - y[left].mean()) ** 2).sum() + ((y[~left] - y[~left].mean()) ** 2).sum()
                best = min(best or (np.inf, 0, 0), (left_over, f, cut))
    assert best[1] == 1 and 0.2 < best[2] <= 0.3
    tree = T.empty_tree(1)
    left = z[:, 1] < best[2]
    T.grow(tree, cuts, {
        "node": 0, "feature": 1, "bin": int(np.flatnonzero(cuts[1] == best[2])[0]), "n": 400.0, "total": y.sum() * T.UNITS,
        "n_left": float(left.sum()), "total_left": y[left].sum() * T.UNITS,
    })
    assert T.predict([tree], 1.0, z) == pytest.approx(np.where(left, y[left].mean(), y[~left].mean()))


@pytest.mark.parametrize("few", [I.FEW_CODES, 0])
def test_snap_to_the_nearest_code(spark, monkeypatch, few):
    monkeypatch.setattr(I, "FEW_CODES", few)
    rng = np.random.default_rng(1)
    codes = sorted({float(v) for v in np.round(rng.gamma(1.0, 20.0, 60), 1)})
    values = [*rng.uniform(-10, 120, 500), *codes, *[(a + b) / 2 for a, b in zip(codes, codes[1:])]]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)] + [(-1, None)], "i int, v double")
    table = spark.createDataFrame([(c,) for c in codes * 3], "value double")
    got = {r["i"]: r["v"] for r in I.snap_to_codes(df, "v", table).collect()}
    assert got.pop(-1) is None and len(got) == len(values)
    for i, v in enumerate(values):
        assert got[i] == min(codes, key=lambda c: (abs(v - c), c))


def test_value_domains_of_any_codes(spark):
    rows = [("a", 0.0, 1.5, "7"), ("a", 62.0, None, "x"), ("b", 63.0, -1.0, None), ("b", 5.0, 2.0, "7"), ("b", 5.0, 2.5, "8")]
    df = spark.createDataFrame(rows, "g string, p double, q double, t string")
    got = sorted((r["g"], r["variable"], r["value"]) for r in I.value_domains(df, ["p", "q", "t"], ["g"]).collect())
    assert got == [
        ("a", "p", 0.0), ("a", "p", 62.0), ("a", "q", 1.5), ("a", "t", 7.0), ("b", "p", 5.0), ("b", "p", 63.0),
        ("b", "q", -1.0), ("b", "q", 2.0), ("b", "q", 2.5), ("b", "t", 7.0), ("b", "t", 8.0),
    ]
    whole = sorted((r["variable"], r["value"]) for r in I.value_domains(df, ["q"], [], whole=True).collect())
    assert whole == [("q", -1.0), ("q", 2.0)]


def test_written_rows_are_bounded_in_bytes(spark, tmp_path):
    """A row of the state, and what a reader holds of it at once, stay small however wide the cell is."""
    width, n = 60, 20_000
    plan = I.CellPlan(
        active=np.arange(width), targets=np.array([0]), mean=np.zeros(width), sd=np.ones(width), low=np.zeros(width), high=np.ones(width), codes={},
    )
    raw = np.random.default_rng(1).random((n, width))
    raw[::3, 0] = np.nan
    batches = [
        pa.RecordBatch.from_arrays([pa.array(np.zeros(m)), pa.array(np.arange(at, at + m)), *map(pa.array, raw[at : at + m].T)], names=[str(i) for i in range(width + 2)])
        for at, m in ((0, 12_000), (12_000, 100), (12_100, 7_900))
    ]
    out = list(I._first_state(SimpleNamespace(value={0: plan}), 1, "mean")(iter(batches)))
    assert max(b.column("z")[0].as_buffer().size for b in out) <= I.STATE_BYTES
    z = np.concatenate([z for b in out for _, z, _ in I._states(b)])
    gaps = np.concatenate([g for b in out for _, _, g in I._states(b)])
    assert np.array_equal(z, np.nan_to_num(raw)) and np.array_equal(gaps, np.isnan(raw))
    table = spark.createDataFrame(pa.Table.from_batches(out * 20).to_pandas(), I.STATE).coalesce(1)
    table.write.options(**I.STATE_FILES).parquet(str(tmp_path / "state"))
    (file,) = (tmp_path / "state").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert max(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)) < 16 << 20


def test_few_sweeps_write_their_features_once(table, monkeypatch):
    """Sweeps are repeated on rows as they are read, with the numbers that writing each of them gives."""
    written = []
    monkeypatch.setattr(I, "materialise", lambda df, name, *a, **k: written.append(name) or materialise(df, name, *a, **k))
    got = I.ChainedImputer(RULE, CODED, "label").fit(table)
    assert written.count("impute-state") == 1
    monkeypatch.setattr(I.ChainedImputer, "replayed", 1)
    each = I.ChainedImputer(RULE, CODED, "label").fit(table)
    assert written.count("impute-state") == 1 + RULE.sweeps
    for a, b in zip(got.history[0], each.history[0], strict=True):
        for cell in a:
            for (t, base, slopes), (u, other, others) in zip(a[cell], b[cell], strict=True):
                assert t == u and np.isclose(base, other, rtol=1e-9, atol=1e-12) and np.allclose(slopes, others, rtol=1e-9, atol=1e-12)


def test_a_level_is_counted_without_copies_of_its_rows():
    """Counts and sums are those of one row at a time; rows of a target are not picked out, and the two are added up together."""
    rng = np.random.default_rng(6)
    place, here = rng.integers(0, 40, (3, 500)), rng.random(500) < 0.7
    for scale in (1e6, 1e13):
        values = np.where(here, np.rint(rng.normal(0, scale, 500)), 0.0)
        n, s = trees.counts_and_sums(place.ravel(), here, values, 3, 40)
        want_n, want_s = np.zeros(40), [0] * 40
        for f, r in np.ndindex(3, 500):
            want_n[place[f, r]] += here[r]
            want_s[place[f, r]] += int(values[r])
        assert n.tolist() == want_n.tolist() and s.tolist() == [float(x) for x in want_s]

    class Counted(np.ndarray):
        """Features that tell when rows of them are picked out."""

        picked = 0

        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                Counted.picked += 1
            return np.asarray(self)[at]

    z, gaps = rng.normal(size=(500, 3)).view(Counted), rng.random((500, 3)) < 0.2
    shared = SimpleNamespace(value={0: SimpleNamespace(cuts=[np.array([-0.5, 0.5])] * 3)})
    grown = SimpleNamespace(value={(0, t): ([trees.empty_tree(2)], trees.empty_tree(2)) for t in range(3)})
    run = trees.count_level(shared, lambda batch: [(0, z, gaps)], grown, {0: [0, 1, 2]}, 0, 0.5, 4)
    found = list(run(iter([None])))
    assert Counted.picked == 0
    assert [sum(x.column(2)[0].as_py()[:4]) for x in found] == (~gaps).sum(axis=0).tolist()


def test_sweeps_read_what_stands_for_rows_with_the_same_gaps(spark, monkeypatch):
    """The state does not grow with the rows, and the trace is that of the chain written out for each row."""
    written = []
    monkeypatch.setattr(I, "materialise", lambda df, name, *a, **k: written.append((name, materialise(df, name, *a, **k))) or written[-1][1])
    monkeypatch.setattr(I, "drop_table", lambda df: None)
    df = spark.range(30_000).selectExpr(
        "'s' AS source_flag", "IF(id % 2 = 0, 'young', 'old') AS kohort", "CAST(id % 101 AS DOUBLE) AS a",
        "IF(hash(id, 1) % 4 = 0, NULL, (id % 101) * 2 + pmod(hash(id, 2), 17)) AS b",
        "IF(hash(id, 3) % 5 = 0, NULL, pmod(hash(id, 2), 17) - (id % 101) / 10D) AS c", "IF(hash(id, 4) % 3 = 0, NULL, CAST(id % 7 AS DOUBLE)) AS d",
    ).cache()
    rule = ImputeRule(exclude=frozenset(BY), sweeps=3, start="mean")
    got = {(r["kohort"], r["feature"], r["iteration"]): r for r in I.ChainedImputer(rule).fit(df, log=True, fill=False).trace().collect()}
    sizes = [t.agg(F.sum("rows")).first()[0] for name, t in written if name == "impute-state"]
    # what the last sweep leaves is not written
    assert len(sizes) == rule.sweeps and max(sizes) <= 2 * 2**3 * 5
    assert len(got) == 2 * 3 * rule.sweeps
    for cell in ("young", "old"):
        raw = df.where(F.col("kohort") == cell).select(*"abcd").toPandas().to_numpy(float)
        gaps, mean, sd = np.isnan(raw), np.nanmean(raw, axis=0), np.nanstd(raw, axis=0)
        z = np.where(gaps, 0.0, (raw - mean) / sd)
        order = sorted((1, 2, 3), key=lambda j: (gaps[:, j].sum(), j))
        for sweep in range(rule.sweeps):
            lines = {}
            for j in order:
                x = np.column_stack([np.ones(len(z)), np.delete(z, j, axis=1)])[~gaps[:, j]]
                lines[j] = np.linalg.solve(x.T @ x + rule.ridge * len(x) * np.diag([0, 1, 1, 1]), x.T @ z[~gaps[:, j], j])
            for j in order:
                own = np.column_stack([np.ones(len(z)), np.delete(z, j, axis=1)])[gaps[:, j]]
                z[gaps[:, j], j] = own @ lines[j]
                r = got[cell, "abcd"[j], sweep + 1]
                assert r["n_missing"] == gaps[:, j].sum()
                assert r["mean_imputed"] == pytest.approx(z[gaps[:, j], j].mean() * sd[j] + mean[j], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("held", [1, 200_000, I.HELD_BYTES])
def test_rows_put_together_keep_their_sums(monkeypatch, held):
    """Whatever a task holds, each pattern's rows are written once: as rows or as their sum of outer products."""
    monkeypatch.setattr(I, "HELD_BYTES", held)
    width, n, rng = 70, 9000, np.random.default_rng(2)
    plan = I.CellPlan(
        active=np.arange(width), targets=np.arange(width), mean=np.zeros(width), sd=np.ones(width), low=np.zeros(width), high=np.ones(width), codes={},
    )
    raw = rng.random((n, width))
    raw[rng.random(n) < 0.5, 69] = np.nan
    raw[rng.random(n) < 0.3, 3] = np.nan
    raw[:300][rng.random((300, width)) < 0.5] = np.nan
    batches = [
        pa.RecordBatch.from_arrays([pa.array(np.zeros(500)), pa.array(np.arange(at, at + 500)), *map(pa.array, raw[at : at + 500].T)], names=[str(i) for i in range(width + 2)])
        for at in range(0, n, 500)
    ]
    out = list(I._first_moments(SimpleNamespace(value={0: plan}), 1, "mean")(iter(batches)))
    found: dict[bytes, np.ndarray] = {}

    def add(gaps, gram):
        found[gaps] = found.get(gaps, 0.0) + gram

    for row in out:
        if row.column("gram")[0].is_valid:
            add(row.column("gaps")[0].as_py(), row.column("gram").values.to_numpy().reshape(width + 1, -1))
        else:
            assert row.column("z")[0].as_buffer().size <= I.STATE_BYTES
            for _, full, gaps in I._states(row):
                for one, mask in zip(full, gaps, strict=True):
                    add(mask.tobytes(), np.outer(one, one))
    want: dict[bytes, np.ndarray] = {}
    for one, mask in zip(np.column_stack([np.ones(n), np.nan_to_num(raw)]), np.isnan(raw), strict=True):
        want[mask.tobytes()] = want.get(mask.tobytes(), 0.0) + np.outer(one, one)
    assert found.keys() == want.keys() and all(np.allclose(found[k], want[k], rtol=1e-12) for k in want)
    sums = pa.RecordBatch.from_arrays(
        [pa.array([0] * len(want), pa.int32()), pa.array(list(want), pa.binary()), pa.array([g.ravel() for g in want.values()], pa.list_(pa.float64()))],
        names=["cell", "gaps", "gram"],
    )
    back: dict[bytes, np.ndarray] = {}
    for row in I._stand_ins(iter([sums])):
        for _, full, gaps in I._states(row):
            for one, mask in zip(full, gaps, strict=True):
                back[mask.tobytes()] = back.get(mask.tobytes(), 0.0) + np.outer(one, one)
    assert back.keys() == want.keys() and all(np.allclose(back[k], want[k], rtol=1e-11, atol=1e-11) for k in want)


def test_bins_are_looked_up_as_they_are_found_by_halving():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 49, 126, 500):
        for own in (rng.normal(size=n), np.arange(n) / 7.0, np.exp(rng.normal(0, 5, n)), np.round(rng.normal(size=n), 1) + 1e4):
            cuts = np.unique(own)
            near = [cuts, np.nextafter(cuts, -np.inf), np.nextafter(cuts, np.inf)]
            values = np.concatenate([*near, rng.normal(0, 3, 500), rng.uniform(0, n / 7 + 1, 500), [1e300, -1e300, 1e9]])
            assert np.array_equal(trees.binner(cuts)(values), np.searchsorted(cuts, values, "right"))


def test_features_of_few_bins_are_counted_as_one(monkeypatch):
    """A place for several features at once, rows of a cell together, and still the counts and sums of a row and feature at a time."""
    rng, bins, n = np.random.default_rng(3), 16, 700
    z = np.column_stack([rng.integers(0, 2, (n, 6)), rng.integers(0, 3, (n, 2)), rng.normal(size=(n, 2))]).astype(float)
    gaps = rng.random((n, 10)) < 0.2
    cuts = [np.array([0.5])] * 6 + [np.array([0.5, 1.5])] * 2 + [np.linspace(-2, 2, 15), np.zeros(0)]
    shared = SimpleNamespace(value={c: SimpleNamespace(cuts=cuts) for c in (4, 5)})
    tree = (np.array([8, 0, -1, 6, 9, -1, -1]), np.array([0.1, 0.5, 0, 1.5, 0.2, 0, 0]), np.linspace(-1, 1, 7))
    states = [(4 + (at // 50) % 2, z[at : at + 50], gaps[at : at + 50]) for at in range(0, n, 50)]
    calls, real = [], np.bincount
    for level in range(3):
        for done in ([], [tree, tree]):
            calls.clear()
            grown = SimpleNamespace(value={(c, t): (done, tree) for c in (4, 5) for t in (0, 8)})
            monkeypatch.setattr(trees.np, "bincount", lambda *a: calls.append(len(a[0])) or real(*a))
            out = list(trees.count_level(shared, lambda batch: states, grown, {4: [0, 8], 5: [8]}, level, 0.5, bins)(iter([None])))
            monkeypatch.undo()
            # per target a place for each of four tables, however many features and written rows there are
            assert len(calls) <= 3 * len(trees.together([len(c) + 1 for c in cuts], bins)) and max(calls) <= n / 2
            got = {(r.column(0)[0].as_py(), r.column(1)[0].as_py()): np.array(r.column(2)[0].as_py()).reshape(2, 10, 1 << level, bins) for r in out}
            assert set(got) == {(4, 0), (4, 8), (5, 8)}
            for (cell, t), found in got.items():
                want = np.zeros_like(found)
                for c, own, open_ in states:
                    node = trees.node_of(tree, own, level) - (1 << level) + 1
                    value = np.rint((own[:, t] - trees.predict(done, 0.5, own)) * trees.UNITS)
                    for i in np.flatnonzero(~open_[:, t] & (node >= 0)) if c == cell else ():
                        for f in range(10):
                            at = f, node[i], np.searchsorted(cuts[f], own[i, f], "right")
                            want[(0, *at)] += 1
                            want[(1, *at)] += value[i]
                assert np.array_equal(found, want)
    assert sum(trees.together([len(c) + 1 for c in cuts], bins), []) != [] and len(trees.together([2] * 9, 127)) == 1


def test_a_table_that_is_not_filled_is_written_without_what_no_pass_reads(table):
    imputer = I.ChainedImputer(replace(RULE, sweeps=1), CODED, "label").fit(table, log=True, fill=False)
    assert {"label", "id"}.isdisjoint(imputer.keyed.columns) and {*BY, "x", "y", "z", "code"} <= set(imputer.keyed.columns)
    filled = I.ChainedImputer(replace(RULE, sweeps=1), CODED, "label").fit(table, log=True)
    assert {"label", "id"} <= set(filled.transform().columns)
    with pytest.raises(ValueError, match="without filling"):
        imputer.transform()
    key = lambda r: (r["source_flag"], r["kohort"], r["feature"], r["iteration"])
    a, b = ({key(r): r["mean_imputed"] for r in x.trace().collect()} for x in (imputer, filled))
    assert a.keys() == b.keys() and all(b[k] == pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in a.items())


def test_features_come_as_columns_or_as_an_array():
    cell, key = pa.array([0, None, 1, 0], pa.int32()), pa.array([5, 6, 7, 8])
    rows = [[1.0, np.nan], [2.0, 3.0], [np.nan, 4.0], [5.0, 6.0]]
    columns = [pa.array([r[i] for r in rows], from_pandas=True) for i in range(2)]
    array = pa.array([[0.0, 0.0], *rows], pa.list_(pa.float64())).slice(1)
    for features in (columns, [array]):
        got = {c: (at.tolist(), raw, keys.tolist()) for c, at, raw, keys in I._cells(cell, key, features)}
        assert got[0][0] == [0, 3] and got[0][2] == [5, 8] and got[1][0] == [2] and set(got) == {0, 1}
        assert np.array_equal(got[0][1], [[1.0, np.nan], [5.0, 6.0]], equal_nan=True) and np.array_equal(got[1][1], [[np.nan, 4.0]], equal_nan=True)


def test_code_of_the_profile_is_short_enough_to_be_compiled(spark):
    """The profile of as many features as the harmonised table has; above 8000 bytes a method is not compiled."""
    import re

    from surveyloom.session import DEFAULTS

    names = [f"d{i}" for i in range(11)] + [f"b{i}" for i in range(14)]
    df = spark.range(1).selectExpr("'s' AS source_flag", "'k' AS kohort", *[f"CAST(id AS {'DOUBLE' if c[0] == 'd' else 'TINYINT'}) AS {c}" for c in names])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = I.feature_profile(df.where("kohort IS NOT NULL"), names, BY)._jdf.queryExecution()
        code = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", DEFAULTS["spark.sql.adaptive.enabled"])
    # the stage that reads the rows; the other one reads a row per cell and task
    assert int(re.findall(r"maxMethodCodeSize:(\d+)", code)[0]) <= int(DEFAULTS["spark.sql.codegen.hugeMethodLimit"])
