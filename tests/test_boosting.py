import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.errors import InsufficientDataError, ModelTrainingError
from tabkit.operators import boosting


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 3)).round(1)
    x[rng.random((600, 3)) < 0.1] = np.nan
    known = np.nan_to_num(x)
    y = (known[:, 0] * known[:, 1] > 0.1).astype(int) + (known[:, 2] > 0.5)
    rows = [(*map(float, a), int(b), float(known[i, 0] * 3 + known[i, 1] ** 2), i % 5 == 0) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "a double, b double, c double, y int, number double, held boolean")


NAMES = ["a", "b", "c"]


def plain_tree(x, g, h, depth, l2, min_child):
    """A tree by brute force: every cut of every feature, missing values on either side."""
    score = lambda a, b: a * a / (b + l2)
    best = (1e-9, None)
    if depth:
        for f in range(x.shape[1]):
            for cut in np.unique(x[~np.isnan(x[:, f]), f]):
                for missing_left in (False, True):
                    left = np.where(np.isnan(x[:, f]), missing_left, x[:, f] <= cut)
                    if h[left].sum() < min_child or h[~left].sum() < min_child or not left.any() or left.all():
                        continue
                    gain = (score(g[left].sum(), h[left].sum()) + score(g[~left].sum(), h[~left].sum()) - score(g.sum(), h.sum())) / 2
                    if gain > best[0] + 1e-9:
                        best = (gain, left)
    if best[1] is None:
        return np.full(len(x), -g.sum() / (h.sum() + l2))
    out, left = np.empty(len(x)), best[1]
    out[left] = plain_tree(x[left], g[left], h[left], depth - 1, l2, min_child)
    out[~left] = plain_tree(x[~left], g[~left], h[~left], depth - 1, l2, min_child)
    return out


@pytest.mark.parametrize("classes", [None, 2, 3])
def test_trees_equal_brute_force_and_both_ways_agree(table, classes):
    rows = table.withColumn("t", F.col("number") if classes is None else (F.col("y") > 0).cast("int") if classes == 2 else F.col("y"))
    fitted = [boosting.fit_boosting(rows, NAMES, "t", classes, rounds=3, depth=3, step=0.5, one_task_bytes=b) for b in (0, 1 << 26)]
    frame = rows.toPandas()
    x, t = frame[NAMES].to_numpy(float), frame["t"].to_numpy(float)
    scale = t.std() if classes is None else 1.0
    margins = np.full((len(t), 3 if classes == 3 else 1), t.mean() / scale if classes is None else 0.0)
    for _ in range(3):
        if classes is None:
            g, h = margins - (t / scale)[:, None], np.ones_like(margins)
        elif classes == 2:
            p = 1 / (1 + np.exp(-margins))
            g, h = p - t[:, None], p * (1 - p)
        else:
            p = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
            g, h = p - (np.arange(3) == t[:, None]), 2 * p * (1 - p)
        margins = margins + 0.5 * np.column_stack([plain_tree(x, g[:, k], h[:, k], 3, 1.0, 1.0) for k in range(g.shape[1])])
    for model in fitted:
        codes = np.column_stack([np.where(np.isnan(x[:, f]), 0, 1 + np.searchsorted(model.edges[f], x[:, f])) for f in range(3)])
        got = boosting._add(np.tile(model.base, (len(t), 1)), codes, model.trees)
        assert np.abs(got - margins).max() < 1e-4
    assert fitted[0].curve == fitted[1].curve
    for a, b in zip(itertools.chain(*fitted[0].trees), itertools.chain(*fitted[1].trees), strict=True):
        assert all(np.array_equal(getattr(a, n), getattr(b, n)) for n in a.__dataclass_fields__)


def test_stopping_keeps_the_best_round(table):
    model = boosting.fit_boosting(table, NAMES, "y", 3, validation="held", patience=3, rounds=60, depth=6, step=1.0)
    losses = {r: held for r, _, held in model.curve}
    assert model.best_round == min(losses, key=lambda r: (losses[r], r)) and model.curve[-1][0] == model.best_round + 3
    assert len(model.used) == model.best_round < len(model.trees) < 60
    curve = boosting.learning_curve(table.sparkSession, model).collect()
    assert [r["round"] for r in curve if r["is_best"]] == [model.best_round]
    held = boosting.predict(table.where("held"), model, probability="p").select((-F.log(F.get("p", F.col("y")))).alias("l")).agg(F.avg("l")).first()[0]
    assert held == pytest.approx(losses[model.best_round], abs=1e-5)


def test_boosting_can_be_continued(table):
    whole = boosting.fit_boosting(table, NAMES, "number", rounds=14, depth=2, row_share=0.7, column_share=0.7)
    half = boosting.fit_boosting(table, NAMES, "number", rounds=6, depth=2, row_share=0.7, column_share=0.7)
    more = boosting.fit_boosting(table, NAMES, "number", rounds=8, depth=2, row_share=0.7, column_share=0.7, start=half, one_task_bytes=0)
    assert [r for r, _, _ in more.curve] == list(range(15))
    for a, b in zip(itertools.chain(*whole.trees), itertools.chain(*more.trees), strict=True):
        assert np.array_equal(a.feature, b.feature) and np.allclose(a.value, b.value, atol=1e-5)


def test_repartitioned_rows_give_the_same_trees(table):
    fits = [boosting.fit_boosting(df, NAMES, "y", 3, rounds=2, depth=2, row_share=0.5, one_task_bytes=0) for df in (table.coalesce(1), table.repartition(7, "a"))]
    for a, b in zip(itertools.chain(*fits[0].trees), itertools.chain(*fits[1].trees), strict=True):
        assert np.array_equal(a.feature, b.feature) and np.array_equal(a.value, b.value)


def known_mean(tree, codes, known, node=0):
    """A tree's value for one row when only ``known`` features may be looked at."""
    f = int(tree.feature[node])
    if f < 0:
        return float(tree.value[node])
    children = [int(tree.left[node]), int(tree.right[node])]
    if f in known:
        left = tree.missing_left[node] if codes[f] == 0 else codes[f] <= tree.cut[node]
        return known_mean(tree, codes, known, children[0 if left else 1])
    return sum(float(tree.cover[c] / tree.cover[node]) * known_mean(tree, codes, known, c) for c in children)


@pytest.mark.parametrize("classes", [None, 3])
def test_shapley_values_equal_all_subsets(table, classes):
    wide = table.withColumn("d", F.col("a") + F.col("b")).withColumn("e", F.col("c") * 2)
    names = [*NAMES, "d", "e"]
    model = boosting.fit_boosting(wide, names, "number" if classes is None else "y", classes, rounds=3, depth=4)
    rows = boosting.tree_shap(wide.limit(12), model).collect()
    out = len(model.base) - 1
    for r in rows:
        x = np.array([r[c] for c in names], float)
        codes = [0 if math.isnan(v) else 1 + int(np.searchsorted(model.edges[i], v)) for i, v in enumerate(x)]
        worth = lambda known: model.scale * sum(known_mean(t[out], codes, known) for t in model.trees)
        for j in range(len(names)):
            others = [k for k in range(len(names)) if k != j]
            exact = sum(
                math.factorial(n) * math.factorial(len(others) - n) / math.factorial(len(names)) * (worth({*s, j}) - worth(set(s)))
                for n in range(len(names))
                for s in itertools.combinations(others, n)
            )
            assert r["shap"][j] == pytest.approx(exact, abs=1e-9)
        assert sum(r["shap"]) == pytest.approx(r["margin"] - r["mean_margin"], abs=1e-9)


def test_hard_input(spark, table):
    with pytest.raises(InsufficientDataError):
        boosting.fit_boosting(table.where("false"), NAMES, "number")
    with pytest.raises(ModelTrainingError):
        boosting.fit_boosting(table, NAMES, "y", classes=2)
    flat = table.withColumn("a", F.lit(None).cast("double")).withColumn("b", F.lit(1.0)).withColumn("number", F.lit(2.0))
    model = boosting.fit_boosting(flat, ["a", "b"], "number", rounds=2)
    assert boosting.predict(flat, model).agg(F.min("prediction"), F.max("prediction")).first() == (2.0, 2.0)
    assert all(v == 0 for _, v in boosting.importances(model))


def test_rows_are_kept_in_blocks_and_go_down_by_table(table, monkeypatch):
    """Blocks spare every pass the cost of single rows; a table or comparisons lead to the same leaves."""
    kept, saved = [], boosting._saved
    monkeypatch.setattr(boosting, "_saved", lambda rows: kept.append(saved(rows)) or kept[-1])
    model = boosting.fit_boosting(table.repartition(2), NAMES, "number", rounds=11, depth=4, one_task_bytes=0)
    cores = table.sparkSession.sparkContext.defaultParallelism
    assert len(kept) == 2 and all(rows.count() <= cores and rows.agg(F.sum("n")).first()[0] == 600 for rows in kept)
    codes = np.random.default_rng(1).integers(0, 40, (5000, 3)).astype(np.uint8)
    for tree in (t for trees in model.trees for t in trees):
        by_table = tree.leaves(codes)
        monkeypatch.setattr(boosting, "TABLE_NODES", 0)
        assert np.array_equal(by_table, tree.leaves(codes)) and (tree.feature[by_table] < 0).all()
        monkeypatch.undo()


def test_many_codes_are_counted_by_all_tasks(table, monkeypatch):
    ways = []
    for name in ("_boost_in_task", "_boost_by_levels"):
        way = getattr(boosting, name)
        monkeypatch.setattr(boosting, name, lambda *a, way=way, name=name: ways.append(name) or way(*a))
    boosting.fit_boosting(table, NAMES, "number", rounds=1, depth=1)
    monkeypatch.setattr(boosting, "ONE_TASK_CODES", 1000)
    boosting.fit_boosting(table, NAMES, "number", rounds=1, depth=1)
    assert ways == ["_boost_in_task", "_boost_by_levels"]


def test_shapley_values_are_computed_once_for_each_set_of_intervals(table, monkeypatch):
    model = boosting.fit_boosting(table, NAMES, "number", rounds=2, depth=4)
    codes, sizes, plain = np.random.default_rng(2).integers(0, 60, (5000, 3)).astype(np.uint8), [], boosting._set_values
    monkeypatch.setattr(boosting, "_set_values", lambda path, inside: sizes.append(len(inside)) or plain(path, inside))
    for path in (p for trees in model.trees for p in boosting.leaf_paths(trees[0])):
        whole = boosting.path_values(path, codes, 3)
        each = np.concatenate([boosting.path_values(path, codes[i : i + 2], 3) for i in range(0, 200, 2)])
        assert np.allclose(whole[:200], each, rtol=0, atol=1e-12)
    assert max(sizes) <= 8


@pytest.mark.parametrize("classes", [None, 2, 3])
def test_tasks_side_by_side_give_the_same_trees(table, monkeypatch, classes):
    """Tasks that deal out rows, tasks that hold copies of all rows, and rows in files, against one task and one job per level."""
    rows = table.withColumn("t", F.col("number") if classes is None else (F.col("y") > 0).cast("int") if classes == 2 else F.col("y"))
    settings = {"rounds": 7, "depth": 5, "row_share": 0.8, "column_share": 0.7, "positive_weight": 2.5, "validation": "held", "gamma": 0.01}
    fit = lambda: boosting.fit_boosting(rows, NAMES, "t", classes, one_task_bytes=0, **settings)
    ways, side = [], boosting._boost_side_by_side
    fitted = [boosting.fit_boosting(rows, NAMES, "t", classes, **settings), fit()]
    monkeypatch.setattr(boosting, "_boost_side_by_side", lambda *a: ways.append(a[-1]) or side(*a))
    monkeypatch.setattr(boosting, "HELD_CODES", 0)
    for name, value in (("GATHERED_BYTES", 1 << 26), ("GATHERED_BYTES", 0)):
        monkeypatch.setattr(boosting, name, value)
        fitted.append(fit())
    assert ways == [False, True]
    for model in fitted[1:]:
        assert model.curve == fitted[0].curve and len(model.trees) == 7
        for a, b in zip(itertools.chain(*fitted[0].trees), itertools.chain(*model.trees), strict=True):
            assert all(np.array_equal(getattr(a, n), getattr(b, n)) for n in a.__dataclass_fields__)


def test_kept_rows_are_counted_together_and_put_into_files(monkeypatch):
    """Few values are counted in one go, rows beyond a limit lie in files; trees stay those of single features in memory."""
    rng = np.random.default_rng(5)
    codes = np.column_stack([rng.integers(0, n, 6000) for n in (5, 7, 200, 3)]).astype(np.uint8)
    y = (codes[:, 0] * codes[:, 1] + codes[:, 2] // 40 + rng.integers(0, 4, 6000)).astype(float)
    rows = lambda: iter([boosting._Rows(codes, np.zeros((6000, 1)), y, np.ones(6000), np.zeros(6000, bool), np.arange(6000))])
    s = boosting._Settings("squared", 4, 1, 1.0, 4, 6, 0.3, 0.0, 1.0, 0.0, 1.0, 1.0, 1.0, None, 1)
    sizes, fits = [5, 7, 200, 3], []
    for joint, memory in ((1, 1 << 30), (1 << 10, 1 << 30), (1 << 10, 50_000)):
        monkeypatch.setattr(boosting, "JOINT_CODES", joint)
        monkeypatch.setattr(boosting, "MEMORY_BYTES", memory)
        keeper = boosting._Keeper(rows(), sizes, s)
        fits.append((len(keeper.groups), len(keeper.space.piece) > 0, boosting._boost(keeper.level, keeper.finish, 0, s)))
    assert [f[:2] for f in fits] == [(4, False), (3, False), (3, True)]
    for f in fits[1:]:
        assert f[2][1] == fits[0][2][1]
        for a, b in zip(itertools.chain(*fits[0][2][0]), itertools.chain(*f[2][0]), strict=True):
            assert all(np.array_equal(getattr(a, n), getattr(b, n)) for n in a.__dataclass_fields__)
