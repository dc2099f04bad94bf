import itertools
import random
from datetime import date, datetime, timedelta
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from firmlens.catalog import models
from firmlens.functions.constants import TRAINING_GRID
from firmlens.operators import splits
from firmlens.operators.scores import ranking_measures
from firmlens.plans import backtest, learn, registry, tree_attribution
from firmlens.session import scratch_path, stored
from firmlens.sources import sinks
from firmlens.streaming import daily, gate

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        x = [rng.random() for _ in FEATURES]
        label = 1 if x[0] > 0.8 else 2 if x[1] > 0.8 else 0
        rows.append((i, date(2000 + i % 24 // 12, i % 12 + 1, 1), x[0], x[1] if rng.random() > 0.1 else None, x[2], label))
    df = spark.createDataFrame(rows, "firm long, ym date, a double, b double, c double, Y int")
    return learn.training_table(df, FEATURES, keep=["firm"])


@pytest.mark.parametrize("kind,size", [("boosted", 4), ("forest", 6), ("linear", 20)])
def test_probabilities_and_skill(spark, table, kind, size):
    model = learn.fit(table, FEATURES, learn.Learner(kind, n_estimators=size, max_depth=3, min_child_samples=1))
    scored = learn.with_predictions(learn.score(model, table))
    sums = scored.select(F.aggregate("p", F.lit(0.0), lambda t, x: t + x).alias("s"), F.array_min("p").alias("lo"), F.array_max("p").alias("hi"))
    low, high, lo, hi = sums.agg(F.min("s"), F.max("s"), F.min("lo"), F.max("hi")).first()
    assert abs(low - 1) < 1e-9 and abs(high - 1) < 1e-9 and lo >= 0 and hi <= 1
    rows = learn.evaluation_rows(learn.score(model, table), "run")
    values = {r.metric: r.value for r in rows.collect()}
    assert values["outsample_class0v1_auc"] > 0.8
    again = learn.fit(table, FEATURES, learn.Learner(kind, n_estimators=size, max_depth=3, min_child_samples=1))
    gap = learn.score(model, table).select("firm", F.col("p").alias("p1")).join(learn.score(again, table).select("firm", "p"), "firm")
    assert gap.select(F.max(F.abs(F.col("p")[1] - F.col("p1")[1]))).first()[0] < 1e-9


def test_one_class_missing_and_empty_column(spark, table):
    two = table.where("Y < 2").withColumn("c", F.lit(None).cast("double"))
    for kind in ("boosted", "forest", "linear"):
        model = learn.fit(two, FEATURES, learn.Learner(kind, n_estimators=2, max_depth=2))
        lengths = learn.score(model, two).select(F.size("p").alias("n"), F.col("p")[2].alias("p2")).agg(F.min("n"), F.max("n"), F.max("p2")).first()
        assert lengths[0] == lengths[1] == 3 and lengths[2] < 0.2


def test_searches(spark, table):
    blocks = splits.expanding_blocks(table, 2)
    base = learn.Learner("forest", n_estimators=2, max_depth=2)
    grid = learn.grid_search(blocks, FEATURES, {"max_depth": [1, 3], "num_leaves": [31, 64]}, n_splits=2, base=base).collect()
    assert len(grid) == 4 and all(r.mean_loss > 0 for r in grid)
    stopped = learn.random_search(blocks, FEATURES, trials=1, n_splits=2, base=learn.Learner("boosted", n_estimators=3), early_stopping=True)
    assert stopped.first().max_auc > 0.5
    trials = learn.random_search(blocks, FEATURES, trials=2, n_splits=2, base=base)
    assert learn.draw_settings(3, 7) == learn.draw_settings(3, 7)
    assert trials.count() == 2 and trials.where("max_auc >= 0.5").count() == 2


def test_fitted_backtest_can_be_resumed(spark, table):
    path = scratch_path(spark, "resume")
    args = (table, FEATURES, date(2000, 7, 1), date(2001, 6, 1), 3, learn.Learner("linear", n_estimators=5))
    rows, models = backtest.fitted_backtest(*args, step_months=6, path=path)
    first = sorted(map(tuple, rows.collect()))
    again, refits = backtest.fitted_backtest(*args, step_months=6, path=path)
    assert len(models) == 2 and [u for u, _ in refits] == [u for u, _ in models] and sorted(map(tuple, again.collect())) == first
    assert all(r[1] is not None and r[1] > 0.7 for r in first)


def test_tree_attribution_matches_definition(spark, table):
    model = learn.fit(table, FEATURES, learn.Learner("boosted", n_estimators=2, max_depth=3, min_child_samples=1))
    leaves = tree_attribution.leaves_of(model.stages[3], spark)
    rng = np.random.default_rng(0)
    x = rng.random((5, 3))

    def value(row, known):
        total = 0.0
        for v, conditions in leaves:
            for f, low, high, share in conditions:
                v *= (low < row[f] <= high) if f in known else share
            total += v
        return total

    got = tree_attribution.shapley_of_batch(x, tree_attribution.leaf_tables(leaves))
    for i, row in enumerate(x):
        for j in range(3):
            others = [k for k in range(3) if k != j]
            want = 0.0
            for size in range(3):
                for known in itertools.combinations(others, size):
                    weight = factorial(size) * factorial(2 - size) / factorial(3)
                    want += weight * (value(row, {*known, j}) - value(row, set(known)))
            assert abs(got[i, j] - want) < 1e-9
    out = tree_attribution.tree_attribution(model, table.withColumn("w", F.lit(1)), FEATURES, ["w"]).collect()
    assert {r.feature for r in out} == set(FEATURES)
    assert max(out, key=lambda r: r.importance).feature == "a"


def test_attribution_of_windows_adds_up_months(spark, table):
    model = learn.fit(table, FEATURES, learn.Learner("boosted", n_estimators=2, max_depth=3, min_child_samples=1))
    linear = learn.fit(table, FEATURES, learn.Learner("linear", n_estimators=2))
    fit, windows = date(2000, 3, 1), [date(2000, 3, 1), date(2000, 5, 1)]
    for one in (model, linear):
        got = {(r.window, r.feature): (r.importance, r.n_rows) for r in tree_attribution.attribution_by_window([((fit,), one)], table, FEATURES, 3, windows={fit: windows}).collect()}
        for w in windows:
            rows = table.where((F.col("ym") >= F.lit(w)) & (F.col("ym") < F.add_months(F.lit(w), 3)))
            whole = tree_attribution.tree_attribution if one is model else tree_attribution.logistic_attribution
            for r in whole(one, rows.withColumn("w", F.lit(1)), FEATURES, ["w"]).collect():
                assert abs(got[w, r.feature][0] - r.importance) < 1e-9 and got[w, r.feature][1] == rows.count()


def test_staged_fits_equal_single_fits(spark, table):
    base = learn.Learner("boosted", max_depth=3, min_child_samples=1, learning_rate=0.3)
    rows = table.withColumn("held", F.col("b") > 0.7)
    for flag in (None, "held"):
        staged = learn.fit_staged(rows, FEATURES, base, [1, 3, 5], validation=flag)
        for n, model in staged.items():
            single = learn.fit(rows, FEATURES, learn.replace(base, n_estimators=n), validation=flag)
            assert [len(m.treeWeights) for m in model.stages[2:]] == [len(m.treeWeights) for m in single.stages[2:]]
            a, b = ([tuple(r.p) for r in learn.score(m, table).orderBy("ym", *FEATURES).select("p").collect()] for m in (model, single))
            assert np.allclose(a, b, atol=1e-12)


def test_stopping_point():
    assert learn.stopping_point([1.0, 0.9, 0.8], 3) == 3 and learn.stopping_point([1.0, 0.9, 0.8], 2) == 2
    assert learn.stopping_point([1.0, 0.9, 0.95, 0.1], 4) == 2 and learn.stopping_point([1.0, 0.999], 2) == 1 and learn.stopping_point([0.5], 1) == 1


def test_grid_losses_equal_single_fits(spark, table):
    blocks = splits.expanding_blocks(table, 2)
    grid = {"learning_rate": [0.3], "max_depth": [2, 3], "n_estimators": [1, 4]}
    base = learn.Learner("boosted", min_child_samples=1)
    for r in learn.grid_search(blocks, FEATURES, grid, 2, base).collect():
        alone = learn.grid_search(blocks, FEATURES, {k: [v] for k, v in learn.json.loads(r.settings).items()}, 2, base).first()
        assert alone.settings == r.settings and abs(alone.mean_loss - r.mean_loss) < 1e-12


def test_coded_covariates_lose_little(spark, table):
    coded = learn.coded_table(table, FEATURES, ["ym", "Y"])
    codes = coded.select(F.explode(vector_to_array(F.col(learn.CODES))).alias("c")).distinct()
    assert {r.c for r in codes.collect()} <= {float(k) for k in range(65)}
    learner = learn.Learner("boosted", n_estimators=3, max_depth=3, min_child_samples=5)
    auc = []
    for rows in (table, coded):
        scored = learn.with_predictions(learn.score(learn.fit(rows, FEATURES, learner), rows)).where("y != 2").withColumn("g", F.lit(1))
        auc.append(ranking_measures(scored, ["g"], "y", "p1").first().auc)
    assert abs(auc[0] - auc[1]) < 0.01


def test_registry_versions(spark, table):
    root = scratch_path(spark, "registry")
    model = learn.fit(table, FEATURES, learn.Learner("linear", n_estimators=2))
    assert registry.register_model(spark, root, "m", model, date(2024, 1, 1), {"auc": 0.5}) == 1
    assert registry.register_model(spark, root, "m", model, date(2024, 1, 2), {"auc": None}) == 2
    row = registry.latest_versions(spark.read.parquet(f"{root}/registry")).first()
    assert row.version == 2 and row.path.endswith("/m/2")
    assert registry.load_latest(spark, root, "m").stages[2].numClasses == 3
    with pytest.raises(LookupError):
        registry.load_latest(spark, root, "other")


def test_eight_registrations_at_once(spark, table):
    root = scratch_path(spark, "registry")
    model = learn.fit(table, FEATURES, learn.Learner("linear", n_estimators=1))
    registry.register_model(spark, root, "m", model, date(2024, 1, 1), {"auc": 0.5})
    versions = learn.in_parallel(spark, [lambda k=k: registry.register_model(spark, root, "m", model, date(2024, 1, 1 + k), {"auc": k / 10}) for k in range(7)], 7)
    assert sorted(versions) == list(range(2, 9))
    rows = spark.read.parquet(f"{root}/registry").collect()
    assert sorted(r.version for r in rows) == list(range(1, 9)) and len({r.path for r in rows}) == 8
    assert registry.claim_version(spark, root, "m") == 9 and registry.claim_version(spark, root, "m") == 10  # never handed out twice


def test_append_replay_equals_batch(spark):
    drops, table = (scratch_path(spark, n) for n in ("drops", "table"))
    schema = "comp_id long, day int, v double, task_date string, econ int"
    one = spark.createDataFrame([(1, 1, 0.1, "2024-01-01", 1), (2, 1, 0.2, "2024-01-01", 1)], schema)
    two = spark.createDataFrame([(1, 2, 0.3, "2024-01-02", 1), (1, 0, 0.9, "2024-01-02", 1)], schema)
    for name, rows in (("a", one), ("b", two), ("c", one)):  # the third drop repeats the first
        rows.write.mode("append").parquet(drops)
        where = scratch_path(spark, f"checkpoint-{name}")
        daily.run_available(daily.drop_stream(spark, drops, schema), daily.append_drops(table, ["task_date"], ["task_date", "econ"], where), where)
    assert sinks.loaded(spark, table).count() == 4


def test_latest_rows_live_in_the_state_store(spark):
    drops, where = (scratch_path(spark, n) for n in ("drops", "checkpoint"))
    schema = "comp_id long, day int, v double"
    latest = {}

    def drop(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(drops)
        stream = daily.latest_stream(daily.drop_stream(spark, drops, schema), ["comp_id"], ["day"])
        query = daily.run_available(stream, None, where, "update")
        for firm, day, v in rows:
            latest[firm] = max(latest.get(firm, (day, v)), (day, v))
        assert {r.comp_id: (r.day, r.v) for r in daily.read_latest(spark, where).collect()} == latest
        state = query.lastProgress["stateOperators"][0]
        return state["numRowsUpdated"], state["numRowsTotal"]

    many = [(k, 5, k / 7) for k in range(3000)] + [(None, 1, 0.5)]
    assert drop(many) == (3001, 3001)
    assert drop([(1, 6, 0.1), (2, 4, 0.2), (7000, 1, 0.3)]) == (3, 3002)  # a newer, a late and a new firm: the batch's own firms only
    assert drop(many[:5]) == (5, 3002)  # repeated
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def _gate_run(spark, root, sources, targets):
    keys = ["task_date", "econ"]
    stream = daily.drop_stream(spark, f"{root}/drops", GATE_ROWS)
    told = daily.drop_stream(spark, f"{root}/told", GATE_TOLD)
    handle = gate.load_released(sources, keys, targets, f"{root}/events")
    daily.run_available(gate.release_events(gate.arrivals(stream, told, keys), keys, timedelta(days=5)), handle, f"{root}/checkpoint", state_parts=1)
    return sorted(tuple(r) for r in spark.read.schema("task_date string, econ int, status string, missing string, n_rows long").parquet(f"{root}/events").drop("batch_").collect())


GATE_ROWS = "firm int, month int, arrived timestamp, task_date string, econ int, kind string"
GATE_TOLD = "task_date string, econ int, kind string, n_rows long, arrived timestamp"


def test_loads_wait_for_all_their_inputs(spark):
    root, day = scratch_path(spark, "gate"), lambda n: datetime(2024, 1, n)
    kinds = ["covariates", "history", "pd", "poe"]

    def drop(rows=(), told=()):
        spark.createDataFrame(list(rows), GATE_ROWS).coalesce(1).write.mode("append").parquet(f"{root}/drops")
        spark.createDataFrame(list(told), GATE_TOLD).coalesce(1).write.mode("append").parquet(f"{root}/told")

    def run():
        source = {"rows": spark.read.schema(GATE_ROWS).parquet(f"{root}/drops")}
        latest = daily.score_latest(lambda df: df, ["firm"], ["month"], ["month"], ["task_date", "econ"])
        return _gate_run(spark, root, source, {f"{root}/all": lambda r: r["rows"], f"{root}/scores": lambda r: latest(r["rows"].where("kind = 'covariates'"))})

    # One row of the first load comes, the stream ends, two more come: three rows must be scored, none lost.
    drop([(1, 1, day(1), "a", 1, "covariates"), (1, 1, day(1), "b", None, "pd"), (9, 1, day(1), "c", 2, "junk")], [("a", 1, k, 3 if k == "covariates" else 1, day(1)) for k in kinds])
    drop(told=[("b", None, "poe", 0, day(1)), ("c", 2, "pd", 1, day(1))])
    run()
    drop([(2, 1, day(2), "a", 1, "covariates"), (2, 2, day(2), "a", 1, "covariates"), (1, 1, day(2), "a", 1, "history"), (1, 1, day(2), "a", 1, "poe")])
    drop(told=[("b", None, "pd", 1, day(2)), ("b", None, "covariates", 0, day(2)), ("b", None, "history", 0, day(2))])
    assert run() == [("b", None, "released", "", 1)]
    drop([(1, 1, day(3), "a", 1, "pd")])
    released = [("a", 1, "released", "", 6), ("b", None, "released", "", 1)]
    assert run() == released == run()  # a run without news changes nothing
    assert {(r.firm, r.month) for r in spark.read.parquet(f"{root}/scores").where("task_date = 'a'").collect()} == {(1, 1), (2, 2)}
    assert spark.read.parquet(f"{root}/all").count() == 7
    # The clock goes on: the incomplete load is reported; rows beyond the announced ones are, too.
    drop([(3, 1, day(9), "a", 1, "pd")], [("", 0, None, None, day(20))])
    timed_out = ("c", 2, "timed out", "covariates,history,pd,poe", 0)
    assert run() == sorted([*released, ("a", 1, "late rows", "", 1), timed_out])
    drop([(1, 1, day(21), "c", 2, "pd")], [("c", 2, k, 0, day(21)) for k in kinds if k != "pd"])
    assert run() == sorted([*released, ("a", 1, "late rows", "", 1), timed_out, ("c", 2, "released", "", 1)])


def test_load_in_pieces_is_stored_once(spark):
    drops, table, where = (scratch_path(spark, n) for n in ("drops", "table", "checkpoint"))
    schema = "comp_id long, task_date string, econ int"

    def drop(first):
        rows = spark.createDataFrame([(k, "2024-01-01", 1) for k in range(first, first + 3)], schema)
        rows.coalesce(1).write.mode("append").parquet(drops)

    def load(checkpoint):
        handle = daily.append_drops(table, ["task_date"], ["task_date", "econ"], checkpoint)
        daily.run_available(daily.drop_stream(spark, drops, schema, files_per_batch=1), handle, checkpoint)
        return sorted(r.comp_id for r in sinks.loaded(spark, table).collect())

    for first in (0, 3, 6):
        drop(first)
    assert load(where) == list(range(9))
    assert load(where) == list(range(9))  # nothing new
    # A batch that is handled again replaces itself.
    batch = spark.createDataFrame([(99, "2024-01-02", 1)], schema)
    for _ in range(2):
        sinks.append_load(batch, table, ["task_date", "econ"], ["task_date"], where, 77)
    assert sinks.loaded(spark, table).where("comp_id = 99").count() == 1
    drop(9)  # a late file of the same load
    assert load(where) == [*range(12), 99]
    assert load(scratch_path(spark, "another")) == [*range(12), 99]  # another stream skips what is loaded


def test_logged_names_and_settings(spark, table):
    model = learn.fit(table, FEATURES, learn.Learner("linear", n_estimators=2))
    scored = learn.score(model, table)
    for prefix in ("outsample", "insample"):
        names = {r.metric for r in learn.evaluation_rows(scored, "run", prefix).collect()}
        pairs = {f"{prefix}_{p}_{m}" for p in ("class0v1", "class0v2") for m in ("f1", "precision", "recall", "auc")}
        assert pairs <= names and not [n for n in names if "precall" in n]
    point = {"max_depth": 5, "learning_rate": 0.05, "num_leaves": 64}
    assert learn.learner_from(learn.settings_text(point)) == learn.Learner(max_depth=5, learning_rate=0.05)


def test_windows_between_refits_are_scored(spark, table):
    args = (table, FEATURES, date(2000, 7, 1), date(2001, 6, 1), 1, learn.Learner("linear", n_estimators=2))
    every, models = backtest.fitted_backtest(*args)
    rows, fewer = backtest.fitted_backtest(*args, refit_every=5)
    assert len(fewer) < len(models)
    assert {(r.date, r.test_size, r.auc_score is None) for r in rows.collect()} == {(r.date, r.test_size, r.auc_score is None) for r in every.collect()}


def test_economies_go_on_where_they_stopped(spark, table, monkeypatch):
    rows, results = table.withColumn("econ", F.col("a").cast("int") * 0 + (F.rand(1) * 2).cast("int")), scratch_path(spark, "economies")
    rows = stored(rows)
    args = (rows, FEATURES, date(2000, 9, 1), date(2001, 3, 1), 3, learn.Learner("linear", n_estimators=2), results, date(2024, 1, 1))
    inserted = backtest.insert_ignore

    def broken(*a, **k):
        inserted(*a, **k)
        raise RuntimeError("stopped")

    monkeypatch.setattr(backtest, "insert_ignore", broken)
    with pytest.raises(RuntimeError):
        backtest.backtest_economies(*args, refit_every=3, workers=1)
    assert spark.read.parquet(results).select("econ").distinct().count() == 1
    monkeypatch.setattr(backtest, "insert_ignore", inserted)
    assert backtest.backtest_economies(*args, refit_every=3, workers=1).select("econ").distinct().count() == 2


def test_missing_inputs(spark):
    rows = spark.createDataFrame([("d1", k) for k in ("pd", "poe", "history", "covariates")] + [("d2", "pd"), ("d2", "other")], "day string, kind string")
    assert {r.day: r.missing for r in daily.missing_inputs(rows, ["day"]).collect()} == {"d1": "", "d2": "covariates,history,poe"}


def test_searches_of_the_catalog_fit_boosted_learners_that_stop_early(spark, table, monkeypatch):
    blocks, fits, trials = splits.expanding_blocks(table, 5), [], []
    cheap = learn.fit(table, FEATURES, learn.Learner("linear", n_estimators=1))

    def staged(train, features, learner, counts, label, weight, validation):
        fits.append((learner, tuple(counts), validation))
        return {n: cheap for n in counts}

    def seen(train, features, learner, *args, **kwargs):
        trials.append((learner, kwargs.get("validation")))
        return cheap

    monkeypatch.setattr(learn, "fit_staged", staged)
    monkeypatch.setattr(learn, "fit", seen)
    monkeypatch.setattr(models, "_blocks", lambda *args: blocks)
    monkeypatch.setattr(learn, "coded_table", lambda df, *args: df)
    assert models.ml_grid_search(spark, "").count() == 24
    assert len(set(fits)) == 6 and {(learner.kind, counts, flag) for learner, counts, flag in fits} == {("boosted", (2, 3), "held_out")}
    models.ml_random_search(spark, "")
    assert len({learner for learner, _ in trials}) == 25 and {(learner.kind, flag) for learner, flag in trials} == {("boosted", "held_out")}


def test_searches_keep_the_rows_of_a_fold_once(spark, table, monkeypatch):
    blocks = splits.expanding_blocks(table, 2)
    coded = learn.coded_table(blocks, FEATURES, ["block", "Y"])
    kept, persist = [], type(blocks).persist
    monkeypatch.setattr(type(blocks), "persist", lambda df, *args: kept.append(df.columns) or persist(df, *args))
    base = learn.Learner("boosted", n_estimators=2, max_depth=2, min_child_samples=1)
    found = learn.random_search(coded, FEATURES, trials=3, n_splits=2, base=base).collect()
    assert len(kept) == 2 and len(found) == 3 and all(r.max_auc > 0.5 for r in found)
    kept.clear()
    assert learn.grid_search(blocks, FEATURES, {"max_depth": [1, 2, 3]}, 2, base).count() == 3
    assert len(kept) == 2


def test_measures_of_trials_equal_those_of_single_fits(spark, table):
    blocks = learn.coded_table(splits.expanding_blocks(table, 2), FEATURES, ["block", "Y"])
    base = learn.Learner("boosted", n_estimators=2)
    best = learn.random_search(blocks, FEATURES, trials=1, n_splits=2, base=base).first()
    auc, learner = [], learn.learner_from(best.settings, base)
    for fold in (1, 2):
        model = learn.fit(blocks.where(F.col("block") <= fold).withColumn("held", F.col("block") == fold), FEATURES, learner, validation="held")
        scored = learn.with_predictions(learn.score(model, blocks.where((F.col("block") == fold) & (F.col("Y") != 2)))).withColumn("g", F.lit(1))
        auc.append(ranking_measures(scored, ["g"], "y", "p1").first().auc)
    assert abs(best.max_auc - max(auc)) < 1e-12


def test_rows_are_stored_once_per_fit_and_repeated_over_windows_when_read(spark, table):
    path, learner = scratch_path(spark, "once"), learn.Learner("linear", n_estimators=2)
    units = [(date(2000, m, 1),) for m in (7, 8, 9, 11)]
    predictions, _ = backtest.fitted_predictions(table, FEATURES, units, 3, learner, path=path, refit_every=3)
    spans = {date(2000, 7, 1): (7, 11), date(2000, 11, 1): (11, 13)}  # months of the rows that a fit's windows hold
    months = [r.ym for r in table.select("ym").collect()]
    at = lambda d: (d.year - 2000) * 12 + d.month
    assert spark.read.parquet(path).count() == sum(a <= at(m) <= b for m in months for a, b in spans.values())
    seen = {(r["window"], r["fit"]): r["count"] for r in predictions.groupBy("window", "fit").count().collect()}
    fit_of = {7: 7, 8: 7, 9: 7, 11: 11}
    assert seen == {(u, date(2000, fit_of[u.month], 1)): sum(at(u) <= at(m) < at(u) + 3 for m in months) for u, in units}


def test_measures_of_windows_equal_those_of_repeated_rows(spark, table):
    rows, learner = stored(table.withColumn("econ", F.col("firm").cast("int") % 2)), learn.Learner("linear", n_estimators=3)
    got, models = backtest.fitted_backtest(rows, FEATURES, date(2000, 7, 1), date(2001, 6, 1), 4, learner, ["econ"], refit_every=5)
    units = [(r.econ, r.date) for r in got.where("fit IS NOT NULL").collect()]
    repeated, _ = backtest.fitted_predictions(rows, FEATURES, units, 4, learner, ["econ"], refit_every=5)
    want = {(r["econ"], r["window"]): (r.auc, r.pr_auc) for r in ranking_measures(repeated.where("y != 2"), ["econ", "window"], "y", "p1").collect()}
    rows = {(r.econ, r.date): (r.auc_score, r.pr_auc) for r in got.collect()}
    assert len(models) > 2 and len(rows) == len(want) and all(np.allclose(rows[k], want[k], atol=1e-12) for k in want)


def test_points_of_a_fit_lie_in_even_partitions(spark, table):
    from firmlens.plans.learn import _even

    lopsided = spark.range(20000).select("id", F.rand(1).alias("x")).coalesce(1)
    sizes = [r["count"] for r in _even(lopsided).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20000 and len(sizes) == 16 and max(sizes) < 2 * min(sizes)


def test_scores_ask_each_model_once(spark, table):
    model = learn.fit(table, FEATURES, learn.Learner("boosted", n_estimators=1, max_depth=1))
    plan = learn.score(model, table).select("p")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("Project")[1].count("UDF(UDF(UDF(") == 3


def test_fits_of_many_rows_go_one_after_another(spark, table, monkeypatch):
    assert [learn.fits_at_once(n, 12, 12) for n in (0, 10**6, 5 * 10**6, 10**8)] == [12, 12, 2, 1]
    blocks, seen, alone = splits.expanding_blocks(table, 2), [], learn.in_parallel
    monkeypatch.setattr(learn, "in_parallel", lambda spark, tasks, workers=4: seen.append(workers) or alone(spark, tasks, workers))
    grid, base = {"max_depth": [1, 2], "n_estimators": [1]}, learn.Learner("boosted", min_child_samples=1)
    losses = []
    for limit in (10**6, 1):
        monkeypatch.setattr(learn, "POINTS_PER_CORE", limit)
        seen.clear()
        losses.append(sorted((r.settings, r.mean_loss) for r in learn.grid_search(blocks, FEATURES, grid, 2, base).collect()))
        assert set(seen) == ({4, 3} if limit > 1 else {1})
    assert [k for k, _ in losses[0]] == [k for k, _ in losses[1]] and np.allclose([v for _, v in losses[0]], [v for _, v in losses[1]], atol=1e-12)


def test_early_stopping_waits_for_its_rounds(spark, table):
    assert learn.stopping_point([1.0, 1.1, 1.05, 0.9, 0.95], 5, 0.0, 3) == 4 and learn.stopping_point([1.0, 1.1, 1.05, 0.9], 4, 0.0, 2) == 1
    assert learn.stopping_point([1.0, 0.999, 0.998], 3, 0.0, 50) == 3 and learn.stopping_point([1.0, 1.0], 2, 0.0, 50) == 1
    # With a small learning rate no tree lowers the loss by a hundredth; the fit goes on all the same.
    rows, learner = table.withColumn("held", F.col("b") > 0.7), learn.Learner("boosted", n_estimators=4, max_depth=2, min_child_samples=1, learning_rate=0.02)
    assert max(len(m.treeWeights) for m in learn.fit(rows, FEATURES, learner, validation="held").stages[2:]) == 4


class _Asked(Exception):
    pass


def _asked_of(monkeypatch, module, name, run):
    """The arguments with which a query first calls a function."""
    def stop(*args, **kwargs):
        raise _Asked(args, kwargs)

    monkeypatch.setattr(module, name, stop)
    with pytest.raises(_Asked) as found:
        run()
    monkeypatch.undo()
    return found.value.args


def test_random_search_of_the_catalog_fits_whole_models(spark, table, monkeypatch):
    monkeypatch.setattr(models, "_blocks", lambda *args: table)
    monkeypatch.setattr(learn, "coded_table", lambda df, *args: df)
    _, asked = _asked_of(monkeypatch, learn, "random_search", lambda: models.ml_random_search(spark, ""))
    assert asked["base"] == learn.Learner("boosted", n_estimators=100) and asked["trials"] == 25 and asked["n_splits"] == 5


def test_grid_search_of_the_catalog_asks_for_the_whole_grid(spark, table, monkeypatch):
    monkeypatch.setattr(models, "_blocks", lambda *args: table)
    (_, _, grid), asked = _asked_of(monkeypatch, learn, "grid_search", lambda: models.ml_grid_search(spark, ""))
    assert grid == TRAINING_GRID and grid["n_estimators"] == [100, 200] and asked["base"].kind == "boosted"


def test_multiclass_fit_of_the_catalog_has_all_trees(spark, table, monkeypatch):
    monkeypatch.setattr(models, "training_rows", lambda *args: table)
    (_, _, learner), _ = _asked_of(monkeypatch, learn, "fit", lambda: models.ml_fit_multiclass(spark, ""))
    assert learner == learn.Learner("boosted", n_estimators=100)


def test_12_month_backtest_of_the_catalog_fits_a_whole_model_for_every_window(spark, table, monkeypatch):
    monkeypatch.setattr(models, "training_rows", lambda *args: table)
    (_, _, start, end, span, learner), asked = _asked_of(monkeypatch, backtest, "fitted_backtest", lambda: models.bt_expanding_12m(spark, ""))
    assert (start, end, span) == (date(2001, 1, 1), date(2001, 12, 1), 12) and learner == learn.Learner("boosted", n_estimators=100)
    assert asked.get("refit_every", 1) == 1


def test_economies_of_the_catalog_are_boosted(spark, table, monkeypatch):
    monkeypatch.setattr(models, "training_rows", lambda *args: table)
    (*_, learner, _, _), _ = _asked_of(monkeypatch, backtest, "backtest_economies", lambda: models.bt_all_econs(spark, ""))
    assert learner == learn.Learner("boosted", n_estimators=100)


def test_attribution_of_the_catalog_is_of_whole_models(spark, table, monkeypatch):
    asked = []
    monkeypatch.setattr(models, "training_rows", lambda *args: table)
    monkeypatch.setattr(backtest, "fitted_predictions", lambda t, f, units, span, learner, **more: asked.append(learner) or (None, []))
    with pytest.raises(AttributeError):  # without models there are no parts
        models.attr_importance_by_window(spark, "")
    assert asked == [learn.Learner("boosted", n_estimators=100), learn.Learner("linear", n_estimators=100)]
