"""Linear learners from shared sums, trees from sums of nodes, and scoring in one pass."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazegrid.operators import learn, linear, scoring, trees


def table(n, p, m, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * rng.uniform(0.3, 3, p) + rng.normal(size=p)
    y = x @ rng.normal(size=(p, m)) + rng.normal(size=(n, m)) * 0.5 + 3
    return x, y


def as_frame(spark, x, y, **more):
    data = {f"x{i}": x[:, i] for i in range(x.shape[1])} | {f"y{i}": y[:, i] for i in range(y.shape[1])}
    return spark.createDataFrame(pd.DataFrame(data | more)).repartition(5)


def closed(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean(0)
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return y.mean(0) - x.mean(0) @ w, w


@pytest.mark.parametrize("learner,alpha", [("LinearRegression", 0.0), ("Ridge", linear.RIDGE_ALPHA)])
def test_all_labels_equal_the_closed_form(spark, learner, alpha):
    x, y = table(300, 6, 4)
    found = linear.fit(as_frame(spark, x, y), [f"x{i}" for i in range(6)], [f"y{i}" for i in range(4)])
    a, w = closed(x, y, alpha)
    for k in range(4):
        assert np.allclose(found[learner, f"y{k}"].coefficients, w[:, k], atol=1e-9)
        assert abs(found[learner, f"y{k}"].intercept - a[k]) < 1e-9


def test_lasso_meets_its_conditions(spark):
    x, y = table(400, 8, 3, seed=2)
    y[:, 0] = 0.001 * x[:, 0]  # so small that no feature is worth its price
    found = linear.fit(as_frame(spark, x, y), [f"x{i}" for i in range(8)], [f"y{i}" for i in range(3)], ["Lasso"])
    for k in range(3):
        w = np.array(found["Lasso", f"y{k}"].coefficients)
        rest = y[:, k] - x @ w - found["Lasso", f"y{k}"].intercept
        slope = x.T @ rest / len(x)
        assert abs(rest.mean()) < 1e-9
        assert np.all(np.abs(slope[w == 0]) <= linear.LASSO_ALPHA + 1e-8)
        assert np.allclose(slope[w != 0], linear.LASSO_ALPHA * np.sign(w[w != 0]), atol=1e-7)
    assert not np.any(found["Lasso", "y0"].coefficients)


def test_each_key_has_planes_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(linear, "HELD", 2)  # tables are handed on and added up again
    parts, frames = {}, []
    for i, key in enumerate(["a", "b", None, "d", "e"]):
        x, y = table(40 + 10 * i, 3, 2, seed=10 + i)
        parts[key] = closed(x, y, linear.RIDGE_ALPHA)
        frames.append(as_frame(spark, x, y).withColumn("station", F.lit(key).cast("string")))
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.union(f)
    gaps = whole.limit(7).withColumn("x1", F.lit(None).cast("double"))  # rows with a gap don't count
    rows = linear.planes(whole.union(gaps).repartition(3), ["x0", "x1", "x2"], ["y0", "y1"], ["Ridge"], ["station"]).collect()
    assert len(rows) == 10
    for r in rows:
        a, w = parts[r.station]
        k = int(r.label[1])
        assert np.allclose(r.coefficients, w[:, k], atol=1e-8) and abs(r.intercept - a[k]) < 1e-8


def test_columns_that_depend_on_each_other(spark):
    x, y = table(100, 2, 1)
    x = np.column_stack([x, x[:, 0] + x[:, 1], np.full(100, 4.0)])
    found = linear.fit(as_frame(spark, x, y), [f"x{i}" for i in range(4)], ["y0"], ["LinearRegression", "Lasso"])
    own = found["LinearRegression", "y0"]
    best = np.linalg.lstsq(x - x.mean(0), y[:, 0] - y[:, 0].mean(), rcond=None)[0]
    assert np.allclose(own.coefficients, best, atol=1e-6)
    assert found["Lasso", "y0"].coefficients[3] == 0.0
    assert linear.fit(as_frame(spark, x, y).limit(0), ["x0"], ["y0"]) == {}


# --- trees -----------------------------------------------------------------------------------

def arrays(spark, x, y, partitions):
    rows = [(a.tolist(), b.tolist()) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "x array<double>, y array<double>").repartition(partitions).cache()


def plain(x, y, forest, labels, forests, tree, total, depth, subset, seed, smallest):
    """The same draws, with nodes as lists of rows; trees of all forests share them."""
    nodes = {t: [np.arange(len(x))] for t in range(total)}
    open_ = [(t, 0) for t in range(total)]
    split = {}
    for level in range(depth):
        if not open_:
            break
        rng = np.random.default_rng([seed, 0, level])
        drawn = np.argsort(rng.random((len(open_), x.shape[1])), axis=1)[:, :subset]
        u = rng.random(drawn.shape)
        after = []
        for i, (t, k) in enumerate(open_):
            rows, best = nodes[t][k], None
            mine = y[:, (t // tree) * labels:(t // tree + 1) * labels]
            for j in range(subset):
                v = x[rows, drawn[i, j]]
                low, high = v.min(), v.max()
                if low == high:
                    continue
                cut = low + u[i, j] * (high - low)
                below, above = rows[v <= cut], rows[v > cut]
                cost = sum(((mine[s] - mine[s].mean(0)) ** 2).sum() for s in (below, above))
                if best is None or cost < best[0] - 1e-9:
                    best = (cost, drawn[i, j], cut, below, above)
            if best:
                split[t, k] = (best[1], best[2], len(nodes[t]))
                nodes[t] += [best[3], best[4]]
                after += [(t, len(nodes[t]) - 2 + s) for s in (0, 1) if len(best[3 + s]) >= smallest]
        open_ = after
    out = np.zeros((len(x), labels))
    for t in range(forest * tree, (forest + 1) * tree):
        mine = y[:, forest * labels:(forest + 1) * labels]
        for i in range(len(x)):
            k = 0
            while (t, k) in split:
                f, c, first = split[t, k]
                k = first + int(x[i, f] > c)
            out[i] += mine[nodes[t][k]].mean(0)
    return out / tree


def test_trees_equal_plain_ones_however_rows_are_dealt(spark):
    x, y = table(60, 5, 4, seed=3)
    x[:, 4] = 1.0
    for partitions in (1, 4):
        found = trees.fit(arrays(spark, x, y, partitions), 5, 2, forests=2, trees=3, depth=4, subset=2)
        for f in range(2):
            assert np.allclose(found[f].predicted(x), plain(x, y, f, 2, 2, 3, 6, 4, 2, 42, trees.SMALLEST_SPLIT), atol=1e-9)


def test_deep_trees_learn_all_rows_and_blocks_join(spark, monkeypatch):
    x, y = table(80, 4, 2, seed=5)
    ready = arrays(spark, x, y, 3)
    deep = trees.fit(ready, 4, 2, trees=2, depth=40, smallest=2)[0]
    assert np.allclose(deep.predicted(x), y)
    monkeypatch.setattr(trees, "BUDGET", 1)  # a tree a block
    few = trees.fit(ready, 4, 2, trees=3, depth=3)[0]
    assert len(few.roots) == 3 and few.predicted(x).shape == (80, 2)
    alone = [trees.Forest(few.roots[k:k + 1], few.feature, few.cut, few.left, few.value).predicted(x) for k in range(3)]
    assert np.allclose(sum(alone) / 3, few.predicted(x)) and not np.allclose(alone[0], alone[1])


def test_constant_features_tiny_and_empty_tables(spark):
    y = np.arange(10.0)[:, None]
    flat = trees.fit(arrays(spark, np.ones((10, 2)), y, 2), 2, 1, trees=2, depth=3)[0]
    assert np.allclose(flat.predicted(np.ones((4, 2))), 4.5)
    one = trees.fit(arrays(spark, np.ones((1, 2)), y[:1] + 7, 1), 2, 1, trees=2, depth=3)[0]
    assert np.allclose(one.predicted(np.zeros((1, 2))), 7.0)
    none = trees.fit(spark.createDataFrame([], "x array<double>, y array<double>"), 2, 1, trees=1, depth=3)[0]
    assert none.predicted(np.zeros((1, 2))).tolist() == [[0.0]]


def test_trees_learn_what_planes_cannot(spark):
    """Curved and joint effects, held-out rows. The targets share their cuts, so one of them may be worse off than with a forest of its own."""
    rng = np.random.default_rng(8)
    x = rng.uniform(-2, 2, (900, 6))
    y = np.column_stack([np.sin(2 * x[:, 0]) + x[:, 1] * x[:, 2], x[:, 3] ** 2 - x[:, 0]]) + rng.normal(size=(900, 2)) * 0.1
    data = {f"f{i}": x[:, i] for i in range(6)} | {"a_h1": y[:, 0], "b_h1": y[:, 1], "split": ["train"] * 700 + ["test"] * 200}
    frame = spark.createDataFrame(pd.DataFrame(data)).cache()
    fitted = learn.train(frame, [f"f{i}" for i in range(6)], ["a", "b"], (1,), ("LinearRegression", "ExtraTrees"), trees=30, depth=12)
    r2 = {(r.model, r.target): r.r2_test for r in learn.metrics(learn.predictions(frame, fitted.values())).collect()}
    for target in "ab":
        assert r2["ExtraTrees", target] > r2["LinearRegression", target] + 0.2


def test_trees_are_as_good_as_the_forest_on_the_given_table(spark):
    from checks.storage import processed
    from hazegrid.plans import training
    frame, features, targets = training.prepared(processed(spark, "/root/testdata/sf0.01"), ["station"], ("aqi", "PM2_5", "temperature_mean"), (1, 7))
    _, scored, _ = training.train_and_rank(frame, features, targets, (1, 7), ("RandomForest", "ExtraTrees"), trees=20, depth=8)
    r2 = {(r.horizon, r.model): r.overall_r2_test for r in learn.weighted_scores(scored).collect()}
    for h in (1, 7):
        assert r2[h, "ExtraTrees"] >= r2[h, "RandomForest"] - 0.05


# --- scoring ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def fitted(spark):
    x, y = table(120, 3, 4, seed=6)
    data = {f"f{i}": x[:, i] for i in range(3)} | {f"{t}_h{h}": y[:, k] for k, (t, h) in enumerate((t, h) for h in (1, 7) for t in "ab")}
    frame = spark.createDataFrame(pd.DataFrame(data | {"split": ["train"] * 90 + ["test"] * 30})).cache()
    return frame, learn.train(frame, ["f0", "f1", "f2"], ["a", "b"], (1, 7), trees=3, depth=3, rounds=2, round_depth=2)


def test_all_models_score_in_one_pass(spark, fitted, tmp_path):
    frame, models = fitted
    frame.drop("none").write.parquet(str(tmp_path / "f"))
    kept = spark.read.parquet(str(tmp_path / "f"))
    out = learn.predictions(kept, models.values())
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert out.count() == kept.count() * len(models) * 2
    one = {(h, n): f.predict(kept) for (h, n), f in models.items()}
    for (h, n), alone in one.items():
        a = sorted(r.yhat for r in out.filter((F.col("horizon") == h) & (F.col("model") == n) & (F.col("target") == "b")).collect())
        assert np.allclose(a, sorted(r.b_pred for r in alone.collect()))


def test_saved_models_predict_the_same(spark, fitted, tmp_path):
    frame, models = fitted
    chosen = {(h, rank): models[h, n] for h in (1, 7) for rank, n in enumerate(("ExtraTrees", "Lasso", "RandomForest"), 1)}
    learn.save(spark, chosen, str(tmp_path / "m"))
    back = learn.load(spark, str(tmp_path / "m"))
    assert set(back) == set(chosen)
    for key, f in chosen.items():
        assert back[key].name == f.name
        assert np.allclose(sorted(r.a_pred for r in f.predict(frame).collect()), sorted(r.a_pred for r in back[key].predict(frame).collect()))


def test_too_many_trees_for_one_pass(spark, fitted, monkeypatch):
    frame, models = fitted
    monkeypatch.setattr(scoring, "FOREST_LIMIT", 10)
    with pytest.raises(ValueError):
        models[1, "ExtraTrees"].predict(frame)
