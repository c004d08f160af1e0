"""Grown trees against trees grown one by one in plain Python, and what smaller limits give."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tenura.operators import models, trees

S = trees.SCALE
FEATURES = ["a", "b", "c", "d"]


def make_rows(n=220, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.choice([0, 1]), rng.randint(0, 9), round(rng.uniform(0, 5), 1), rng.choice([0, 0, 0, 1])]
        chance = 1 / (1 + math.exp(-(x[0] + 0.4 * x[1] - x[2])))
        rows.append((f"K{i}", int(rng.random() < chance), i % 3, *map(float, x)))
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def ready(spark):
    df = spark.createDataFrame(ROWS, "customerID string, label int, fold int, a double, b double, c double, d double")
    return models.assemble(FEATURES).transform(df).select("customerID", "label", "fold", "features").repartition(5).cache()


@pytest.fixture(scope="module")
def rows(ready):
    return models.bin_rows(ready, 3)


def plain_tree(points, s, columns):
    """points: (bins, g, h) in whole numbers. Always splits the leaf of largest gain, the older one on ties."""
    def worth(g, h):
        return (g / S) ** 2 / (h / S + s.l2) if h / S + s.l2 > 0 else 0.0

    def best(node):
        if node["depth"] >= s.max_depth or len(node["points"]) < max(s.min_split, 2 * s.min_leaf):
            return None
        found = None
        g, h = (sum(p[k] for p in node["points"]) for k in (1, 2))
        for f in columns:
            for cut in sorted({p[0][f] for p in node["points"]})[:-1]:
                left = [p for p in node["points"] if p[0][f] <= cut]
                gl, hl = (sum(p[k] for p in left) for k in (1, 2))
                n = len(node["points"]) - len(left)
                if min(len(left), n) < s.min_leaf or min(hl, h - hl) < s.min_weight * S:
                    continue
                gain = worth(gl, hl) + worth(g - gl, h - hl) - worth(g, h)
                if gain > trees.LEAST_GAIN and (found is None or gain > found[0]):
                    found = gain, f, cut
        return found

    root = {"depth": 0, "points": points}
    leaves, made = [root], 1
    root["best"] = best(root)
    while made < s.leaves:
        can = [x for x in leaves if x["best"]]
        if not can:
            break
        node = max(can, key=lambda x: x["best"][0])
        _, f, cut = node["best"]
        for side in (True, False):
            child = {"depth": node["depth"] + 1, "points": [p for p in node["points"] if (p[0][f] <= cut) == side]}
            child["best"] = best(child)
            node["left" if side else "right"] = child
            leaves.append(child)
        node["split"] = f, cut
        leaves.remove(node)
        made += 1
    return root


def value(node, s):
    g, h = (sum(p[k] for p in node["points"]) for k in (1, 2))
    return g / S / (h / S + s.l2) * s.rate if h / S + s.l2 > 0 else 0.0


def route(node, bins):
    while "split" in node:
        node = node["left" if bins[node["split"][0]] <= node["split"][1] else "right"]
    return node


def plain_model(s, cuts):
    """Class-1 probability of every row, by trees grown in plain Python."""
    x = trees.to_bins(np.array([r[3:] for r in ROWS]), cuts)
    margin, total = [0.0] * len(ROWS), [0.0] * len(ROWS)
    grown = []
    for _ in range(s.trees):
        points = []
        for i, r in enumerate(ROWS):
            if r[2] == s.left_out:
                continue
            w = s.weights[r[1]]
            p = 1 / (1 + math.exp(-margin[i]))
            g, h = (w * (r[1] - p), w * p * (1 - p)) if s.boosted else (w * r[1], w)
            points.append((x[i], int(np.rint(g * S)), int(np.rint(h * S))))
        tree = plain_tree(points, s, range(len(cuts)))
        grown.append(tree)
        for i in range(len(ROWS)):
            margin[i] += value(route(tree, x[i]), s)
            total[i] += value(route(tree, x[i]), s) / s.trees
    return grown, [1 / (1 + math.exp(-m)) for m in margin] if s.boosted else total


def chances(model):
    x = model.bins(np.array([r[3:] for r in ROWS]))
    return trees.probabilities(x, model)[:, 0]


SETTINGS = [
    trees.Setting(max_depth=3, weights=(0.8, 1.3)),
    trees.Setting(max_depth=10, min_split=5, left_out=1),
    trees.Setting(max_depth=6, min_leaf=7),
    trees.Setting(boosted=True, trees=4, max_depth=3, l2=1.0, min_weight=1.0, rate=0.3, weights=(1.0, 1.7)),
    trees.Setting(boosted=True, trees=3, leaves=5, min_leaf=5, min_weight=1e-3, rate=0.5, left_out=2),
    trees.Setting(boosted=True, trees=2, leaves=9, max_depth=4, min_leaf=3, rate=0.1),
    trees.Setting(boosted=True, trees=2, leaves=2, rate=1.0),
    trees.Setting(max_depth=0),
]


def test_trees_grown_side_by_side_are_those_grown_alone(rows):
    """All settings in shared waves, against one tree after the other in plain Python."""
    grown = trees.grow(rows.table, rows.cuts, SETTINGS)
    for s, model in zip(SETTINGS, grown):
        plain, want = plain_model(s, rows.cuts)
        assert len(model.roots) == s.trees
        assert chances(model) == pytest.approx(want, abs=1e-12)

        def leaves(node):
            return leaves(node["left"]) + leaves(node["right"]) if "split" in node else 1

        sizes = np.diff(np.append(model.roots, len(model.nodes["feature"])))
        assert [(n + 1) // 2 for n in sizes] == [leaves(t) for t in plain]
        assert model.nodes["depth"].max() <= s.max_depth


def test_leaf_limits_differ(rows):
    sizes = []
    for leaves in (4, 6, trees.NO_LIMIT):
        model = trees.grow(rows.table, rows.cuts, [trees.Setting(boosted=True, leaves=leaves, min_leaf=3)])[0]
        sizes.append((len(model.nodes["feature"]) + 1) // 2)
    assert sizes[:2] == [4, 6] and sizes[2] > 6


def test_cells_are_counted_in_parts(rows, monkeypatch):
    """Small bounds of a wave change nothing."""
    want = [chances(m) for m in trees.grow(rows.table, rows.cuts, SETTINGS)]
    monkeypatch.setattr(trees, "CELLS", 60)
    monkeypatch.setattr(trees, "PAIRS", 50)
    monkeypatch.setattr(trees, "LANES", 3)
    monkeypatch.setattr(trees, "ROUNDS_KEPT", 0.1)
    got = [chances(m) for m in trees.grow(rows.table.repartition(2), rows.cuts, SETTINGS)]
    for a, b in zip(got, want):
        assert a.tolist() == b.tolist()


def test_first_rounds_and_smaller_limits(rows):
    """The first rounds of many are a fit with few; a deep tree cut back is a shallow one, of forests too."""
    many = trees.Setting(boosted=True, trees=6, max_depth=3, l2=1.0, rate=0.3, row_share=0.8, column_share=0.5)
    deep = trees.Setting(trees=7, max_depth=8, min_split=2, bootstrap=True, node_columns=2, left_out=0)
    settings = [many, replace(many, trees=2), deep, replace(deep, trees=3), replace(deep, max_depth=3),
                replace(deep, min_split=9), replace(deep, trees=5, max_depth=4, min_split=6)]
    grown = trees.grow(rows.table, rows.cuts, settings)
    x = grown[0].bins(np.array([r[3:] for r in ROWS]))
    few = trees.probabilities(x, grown[0], [2, 6])
    assert few[:, 0].tolist() == chances(grown[1]).tolist() and few[:, 1].tolist() == chances(grown[0]).tolist()
    for model, limits in zip(grown[3:], [([3],), ([7], 3), ([7], trees.NO_LIMIT, 9), ([5], 4, 6)]):
        assert trees.probabilities(x, grown[2], *limits)[:, 0].tolist() == pytest.approx(chances(model).tolist(), abs=1e-12)


def test_samples(rows):
    """Rows are drawn about as often as they should be, columns once for each tree."""
    u = trees._uniform(np.arange(20_000, dtype=np.int64), np.array([3, 4]))
    assert abs(u.mean() - 0.5) < 0.01 and abs(np.corrcoef(u.T)[0, 1]) < 0.03
    often = np.searchsorted(trees.POISSON, u[:, 0], "right")
    assert abs(often.mean() - 1) < 0.03 and abs((often == 0).mean() - math.exp(-1)) < 0.02
    model = trees.grow(rows.table, rows.cuts, [trees.Setting(boosted=True, trees=8, column_share=0.5, max_depth=4)])[0]
    used = [set(model.nodes["feature"][a:b]) - {-1} for a, b in zip(model.roots, [*model.roots[1:], None])]
    assert all(len(f) <= 2 for f in used) and len(set().union(*used)) > 2


def test_tally_and_held_out_rows(rows):
    settings = [trees.Setting(max_depth=4, left_out=f) for f in range(3)]
    grown = trees.grow(rows.table, rows.cuts, settings)
    got = {(r["candidate"], r["fold"]): r for r in trees.tally(
        rows.table, grown, [trees.Variant(c, m, 1, d) for c, d in enumerate((2, 4)) for m in range(3)]).collect()}
    x = grown[0].bins(np.array([r[3:] for r in ROWS]))
    for c, depth in enumerate((2, 4)):
        for fold, model in enumerate(grown):
            hit = trees.probabilities(x, model, depth=depth)[:, 0] > 0.5
            cells = [0] * 4
            for r, h in zip(ROWS, hit):
                if r[2] == fold:
                    cells[2 * r[1] + h] += 1
            assert [got[c, fold][k] for k in ("tn", "fp", "fn", "tp")] == cells
    chance = trees.held_out(rows.table, grown).groupBy("fold").agg(F.sum("probability").alias("p"), F.count("*").alias("n"))
    for r in chance.collect():
        want = [c for c, row in zip(chances(grown[r["fold"]]), ROWS) if row[2] == r["fold"]]
        assert r["n"] == len(want) and r["p"] == pytest.approx(sum(want))


def test_cut_points(spark, ready):
    x = ready.select(vector_to_array("features").alias("x"))
    cuts = trees.cut_points(x, 4, 8)
    assert cuts[0] == [0.0] and cuts[3] == [0.0]
    for i in (1, 2):
        values = sorted(r[3 + i] for r in ROWS)
        part = {v: (values.index(v) * 8) // len(values) for v in values}
        want = sorted(max(v for v in part if part[v] == p) for p in set(part.values()))[:-1]
        assert cuts[i] == want and len(want) <= 7
    with pytest.raises(ValueError):
        trees.cut_points(x, 4, 300)


def test_scores_and_saved_models(spark, ready, rows, tmp_path):
    grown = trees.grow(rows.table, rows.cuts, SETTINGS[:5], FEATURES)
    names = [f"m{i}" for i in range(5)]
    got = trees.scored(ready, dict(zip(names, grown)), keep=["customerID"]).collect()
    at = {r[0]: i for i, r in enumerate(ROWS)}
    for model, k in zip(grown, range(5)):
        want = chances(model)
        assert all(r["probabilities"][k] == want[at[r["customerID"]]] for r in got)
        model.save(spark, str(tmp_path / f"{k}"))
        again = trees.Model.load(spark, str(tmp_path / f"{k}"))
        assert again.setting == model.setting and chances(again).tolist() == want.tolist()
    nodes = grown[4].table(spark)
    assert nodes.filter("feature IS NULL").count() == nodes.filter("feature IS NOT NULL").count() + 3
    assert nodes.filter("node = 0").agg(F.max("rows")).first()[0] == sum(r[2] != 2 for r in ROWS)


def test_awkward_rows(spark):
    """One class only, one row, a feature of one value, rows without a label or a fold."""
    rows = [("A", 1, 0, 1.0, 2.0), ("B", 1, None, 1.0, 3.0), ("C", None, 0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "customerID string, label int, fold int, a double, b double")
    ready = models.assemble(["a", "b"]).transform(df).drop("a", "b")
    made = models.bin_rows(ready, 1)
    grown = trees.grow(made.table, made.cuts, [trees.Setting(), trees.Setting(left_out=0), trees.Setting(left_out=0, boosted=True, trees=2)])
    assert [float(m.nodes["value"][0]) for m in grown[:2]] == [1.0, 1.0]
    alone = models.bin_rows(ready.drop("fold"), 1)
    whole = trees.grow(alone.table, alone.cuts, [trees.Setting(), trees.Setting(left_out=0)])
    assert [int(m.nodes["n"][0]) for m in (*grown[:2], *whole)] == [2, 1, 2, 2]  # rows without a fold are seen by all
    assert trees.tally(made.table, grown[1:2], [trees.Variant(0, 0, 1)]).first()["tp"] == 1
    empty = trees.grow(made.table.filter("label > 5"), made.cuts, [trees.Setting(), trees.Setting(boosted=True)])
    assert [float(m.nodes["value"][0]) for m in empty] == [0.0, 0.0]


def test_waves_do_not_ask_earlier_rounds_again(rows, monkeypatch):
    """A finished round is in the rows' margins before the next one waits."""
    asked, best = [], trees.best_splits

    def keep(table, wave):
        asked.append(len(wave.done_root))
        return best(table, wave)

    monkeypatch.setattr(trees, "best_splits", keep)
    trees.grow(rows.table, rows.cuts, [trees.Setting(boosted=True, trees=4, max_depth=2, rate=r) for r in (0.1, 0.5)])
    assert max(asked) < 2


def test_cells_come_in_order_once_each_for_all_trees(rows, monkeypatch):
    """What a task counts needs no sorting: a part for each tree, in the order of its nodes."""
    waves = []
    best = trees.best_splits
    monkeypatch.setattr(trees, "best_splits", lambda table, wave: waves.append(wave) or best(table, wave))
    grown = trees.grow(rows.table, rows.cuts, [trees.Setting(trees=6, max_depth=3, bootstrap=True, node_columns=2)])
    assert len(grown[0].roots) == 6
    table = rows.table.toArrow()
    bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8).reshape(-1, len(rows.cuts))
    label, fold, row = (table.column(c).to_numpy() for c in ("label", "fold", "row"))
    for wave in waves:
        parts = list(trees._count(wave, label, fold, row, bins, None))
        assert 1 < len(parts) <= len(wave.roots)
        assert (np.diff(np.concatenate([p[0] for p in parts])) > 0).all()


def test_nodes_grown_alone_are_those_of_waves(rows, monkeypatch):
    """Tasks that grow small nodes by themselves find the trees that waves find, in fewer jobs; also cut to buckets."""
    settings = [
        trees.Setting(trees=6, max_depth=7, bootstrap=True, node_columns=2, weights=(0.7, 1.9), left_out=f) for f in range(3)
    ] + [trees.Setting(max_depth=5, min_split=6, min_leaf=3), trees.Setting(trees=2, bootstrap=True, node_columns=3, left_out=1)]

    def grown(alone, together):
        monkeypatch.setattr(trees, "ALONE", alone)
        monkeypatch.setattr(trees, "TOGETHER", together)
        grower = trees.Grower(rows.table, rows.cuts, settings)
        return grower.grow(), grower.waves

    def outline(model):
        def below(i):
            v = {k: x[i] for k, x in model.nodes.items()}
            here = (int(v["n"]), int(v["depth"]), float(v["value"]), int(v["feature"]))
            return (*here, int(v["cut"]), float(v["gain"]), below(v["left"]), below(v["right"])) if v["feature"] >= 0 else here
        return [below(r) for r in model.roots]

    by_waves, many = grown(0, 1)
    for together in (1 << 17, 50):
        alone, few = grown(100, together)
        assert few < many
        assert [outline(m) for m in alone] == [outline(m) for m in by_waves]


def test_features_counted_jointly_give_each_ones_sums():
    rng = np.random.default_rng(3)
    sizes = np.array([2, 7, 3, 90, 2, 1, 130, 2])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    bins = np.stack([rng.integers(0, s, 400) for s in sizes], 1).astype(np.uint8)
    node, r = rng.integers(0, 3, 300), np.sort(rng.choice(400, 300, replace=False))
    g, h = (rng.integers(-50, 50, 300).astype(float) for _ in range(2))
    groups = trees._groups(sizes)
    assert sorted(f for group in groups for f in group) == list(range(len(sizes))) and len(groups) < len(sizes)
    found = trees._counted_jointly(node, 3, r, g, h, bins, {}, groups, {0, 2, 3, 6}, offsets)
    for got, v in zip(found, (g, h, np.ones(300))):
        wanted = np.zeros((3, offsets[-1]), np.int64)
        for f in (0, 2, 3, 6):
            np.add.at(wanted, (node, offsets[f] + bins[r, f]), v.astype(np.int64))
        assert np.array_equal(got, wanted.reshape(-1))


def test_models_are_asked_in_several_passes(rows, monkeypatch):
    settings = [trees.Setting(trees=3, max_depth=4, bootstrap=True, node_columns=2, left_out=f) for f in range(3)]
    models_of = trees.grow(rows.table, rows.cuts, settings)
    variants = [trees.Variant(c, m, t) for m in range(3) for c, t in enumerate((1, 3))]
    whole = sorted(trees.tally(rows.table, models_of, variants).collect())
    monkeypatch.setattr(trees, "NODES", 1)
    assert sorted(trees.tally(rows.table, models_of, variants).collect()) == whole


def test_models_boosted_in_a_task_are_those_of_waves(rows, monkeypatch):
    """Tasks that grow all rounds of small boosted models find the models that waves find, in fewer jobs; also beside larger ones."""
    one = trees.Setting(boosted=True, trees=5, max_depth=3, l2=1.0, rate=0.3, row_share=0.8, column_share=0.6, weights=(1.0, 1.7))
    leafy = trees.Setting(boosted=True, trees=4, leaves=9, min_leaf=3, rate=0.5)
    settings = [replace(s, left_out=f) for s in (one, replace(one, row_share=1.0), leafy) for f in (-1, 0, 1, 2)]
    settings += [replace(leafy, leaves=n, left_out=0) for n in range(4, 9)] + [trees.Setting(max_depth=4, left_out=1)]

    def grown(whole):
        monkeypatch.setattr(trees, "WHOLE", whole)
        grower = trees.Grower(rows.table, rows.cuts, settings)
        return grower.grow(), grower.waves, len(grower.small)

    by_waves, many, none = grown(0)
    assert none == 0
    for whole, small in ((200, len(settings) - 4), (1 << 17, len(settings) - 1)):
        alone, few, count = grown(whole)
        assert count == small
        for a, b in zip(alone, by_waves):
            assert a.roots.tolist() == b.roots.tolist()
            assert all(np.array_equal(a.nodes[k], b.nodes[k]) and a.nodes[k].dtype == b.nodes[k].dtype for k in b.nodes)
    assert few < many / 3


def test_search_counts_what_grown_models_give(rows, monkeypatch):
    """Cells of a search, whose models do not come to the driver as a whole, against those of grown models."""
    settings, variants = [], []
    for f in range(3):
        settings += [trees.Setting(trees=7, max_depth=8, bootstrap=True, node_columns=2, weights=(0.7, 1.9), left_out=f),
                     trees.Setting(max_depth=5, left_out=f),
                     trees.Setting(boosted=True, trees=5, max_depth=3, l2=1.0, rate=0.3, row_share=0.8, column_share=0.6, left_out=f),
                     trees.Setting(boosted=True, trees=4, leaves=6, min_leaf=3, rate=0.5, left_out=f)]
        parts = [(0, 3), (0, 7), (0, 7, 3, 6), (0, 3, 4), (1, 1), (1, 1, 2, 5), (2, 2), (2, 5), (3, 4)]
        variants += [trees.Variant(c, 4 * f + m, *of) for c, (m, *of) in enumerate(parts)]
    order = ["candidate", "fold", "tn", "fp", "fn", "tp"]
    grown = trees.grow(rows.table, rows.cuts, settings)
    want = sorted(tuple(r[k] for k in order) for r in trees.tally(rows.table, grown, variants).collect())
    alone = trees.boosted_alone
    asked = []
    monkeypatch.setattr(trees, "boosted_alone", lambda *given: asked.append(1) or alone(*given))
    assert sorted(trees.search(rows.table, rows.cuts, settings, variants)) == want
    assert not asked  # boosted trees stay in the tasks
    monkeypatch.setattr(trees, "HELD", 300)
    held, grow = [], trees.Grower.grow

    def kept(grower):
        made = grow(grower)
        held.append(sum(len(m.roots) for m in made))
        return made

    monkeypatch.setattr(trees.Grower, "grow", kept)
    monkeypatch.setattr(trees, "WHOLE", 0)
    assert sorted(trees.search(rows.table.repartition(3), rows.cuts, settings, variants)) == want
    assert max(held) < sum(s.trees for s in settings) / 2
