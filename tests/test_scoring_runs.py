"""Threshold documents, prediction shapes and run-log operators on edge cases."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import runs as R
from tidemark.operators import score


def test_threshold_documents(spark):
    docs = spark.createDataFrame([('{"best_threshold": 0.3}',), ('{"threshold": 0.4, "value": 0.9}',),
                                  ('{"best": 0.2}',), ('{"value": 0.7}',), ('{"best_threshold": ',), ('{}',)], ["doc"])
    got = [r.threshold for r in score.resolve_threshold(docs).collect()]
    assert got == [0.3, 0.4, 0.2, 0.7, 0.5, 0.5]
    assert [r.threshold for r in score.resolve_threshold(docs, explicit=0.1).collect()] == [0.1] * 6


def test_threshold_by_family(spark):
    models = spark.createDataFrame([("churn_xgb",), ("RandomForest",), ("logreg",)], ["model_name"])
    th = spark.createDataFrame([("xgb", 0.3), ("general", 0.45)], "family string, threshold double")
    got = {r.model_name: r.threshold for r in score.threshold_for_model(models, th).collect()}
    assert got == {"churn_xgb": 0.3, "RandomForest": 0.45, "logreg": 0.45}


def test_prediction_shapes(spark):
    df = spark.createDataFrame([([0.2, 0.8],), ([0.1, 0.5, 0.5],), ([0.3],)], "p array<double>")
    out = score.normalize_array_predictions(df, "p").collect()
    assert (out[0].proba, out[0].pred_class) == (0.8, 1)
    assert out[1].pred_class == 1          # first maximum wins a tie
    assert out[2].proba == 0.3
    b = spark.createDataFrame([(0.0, "a"), (1.0, "a"), (0.0, "b"), (0.4, "b"), (1.0, "c"), (1.0, "c")], "v double, g string")
    kinds = {r.g: r.kind for r in score.normalize_scalar_predictions(b, "v", by=["g"]).collect()}
    assert kinds == {"a": "class", "b": "proba", "c": "proba"}


def test_explode_predictions(spark):
    df = spark.createDataFrame([(1, '{"predictions": [1, 0]}'), (2, "[0.5]"), (3, "not json")], "id int, doc string")
    got = [(r.id, r.pos, r.prediction) for r in score.explode_predictions(df, "doc").collect()]
    assert got == [(1, 0, 1.0), (1, 1, 0.0), (2, 0, 0.5)]


def test_flatten_metrics(spark):
    doc = '{"test": {"f1": 0.5, "n": {"deep": 2}}, "ok": true, "tags": ["a"], "name": "x", "": 3, "none": null}'
    df = spark.createDataFrame([("m", doc), ("bad", "{")], "k string, doc string")
    got = {(r.k, r.key): r.value for r in R.flatten_metrics(df, keep=["k"]).collect()}
    assert got == {("m", "test_f1"): 0.5, ("m", "test_n_deep"): 2.0, ("m", "ok"): 1.0}


def test_best_run_ties_and_missing(spark):
    runs = spark.createDataFrame([("b", "e", "metrics_test_x", 0.5), ("a", "e", "metrics_test_y", 0.5),
                                  ("c", "e", "other", 0.9), ("d", "e", "metrics_test_z", None),
                                  ("z", "f", "metrics_valid", 0.0)],
                                 "run_id string, experiment_name string, run_name string, f1 double")
    best = {r.experiment_name: r.run_id for r in R.best_run(runs).collect()}
    assert best == {"e": "c"}                       # zero F1 never wins; experiment f has none
    assert R.best_named_run(runs, "metrics_test").collect()[0].run_id == "a"


def test_leaderboard_stable(spark):
    df = spark.createDataFrame([("x", 0.5, 0), ("y", 0.7, 1), ("z", 0.5, 2)], "label string, f1 double, position int")
    got = [(r.label, r.rank, r.is_winner) for r in R.leaderboard(df).orderBy("rank").collect()]
    assert got == [("y", 1, True), ("x", 2, False), ("z", 3, False)]



def test_leaderboard_matches_window_on_many_runs(spark):
    """The distributed rank equals the single-task window on a run log with ties,
    missing scores and more runs than range buckets."""
    from pyspark.sql import Window
    rows = [(f"m{i}", None if i % 97 == 0 else float((i * 7919) % 301) / 300.0, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "label string, f1 double, position int")
    got = {r.label: r.rank for r in R.leaderboard(df).collect()}
    w = Window.orderBy(F.col("f1").desc_nulls_last(), F.col("position"))
    want = {r.label: r.rk for r in df.withColumn("rk", F.row_number().over(w)).collect()}
    assert got == want


def test_top_two_many_runs_per_model(spark):
    rows = [("A", 0.5, 0), ("A", 0.6, 0), ("B", 0.7, 1), ("C", 0.7, 2), ("C", None, 2)]
    df = spark.createDataFrame(rows, "model_key string, f1 double, position int")
    got = [(r.model_key, r.f1, r.role, r.considered) for r in R.top_two(df).orderBy("role", ascending=False).collect()]
    assert got == [("B", 0.7, "champion", "A,B,C"), ("C", 0.7, "challenger", "A,B,C")]

def test_champion_changed(spark):
    best = spark.createDataFrame([("e1", "r2", 0.6), ("e2", "r5", 0.4), ("e3", "r7", 0.3)],
                                 "experiment_name string, run_id string, f1 double")
    prev = spark.createDataFrame([("e1", "r1", 0.5), ("e2", "r5", 0.4)], "experiment_name string, run_id string, f1 double")
    got = {r.experiment_name: (r.changed, r.improved, r.reason) for r in R.champion_changed(best, prev).collect()}
    assert got == {"e1": (True, True, "better metric"), "e2": (False, False, "same run"),
                   "e3": (True, True, "no previous champion")}


def test_parse_model_refs(spark):
    refs = ["models:/M@a", "models:/M/3", "M@a", "M v3", "M", " models:/N "]
    df = spark.createDataFrame([(r,) for r in refs], ["ref"]).withColumn("p", R.parse_model_ref(F.col("ref")))
    got = [(r.p.name, r.p.version, r.p.alias) for r in df.collect()]
    assert got == [("M", None, "a"), ("M", 3, None), ("M", None, "a"), ("M", 3, None), ("M", None, None), ("N", None, None)]


def test_parse_selection_and_uri(spark):
    docs = ['{"Name": "M", "Version": "4"}', '{"model": "M", "v": 2, "alias": "champ"}', '{"uri": "models:/M@x"}',
            '"M v7"']
    df = spark.createDataFrame([(d,) for d in docs], ["doc"]).withColumn("p", R.parse_selection(F.col("doc")))
    df = df.withColumn("uri", R.resolve_model_uri(F.col("p.name"), F.col("p.version"), F.col("p.alias")))
    got = [(r.p.name, r.p.version, r.p.alias, r.uri) for r in df.collect()]
    assert got == [("M", 4, None, "models:/M/4"), ("M", 2, "champ", "models:/M@champ"),
                   ("M", None, "x", "models:/M@x"), ("M", 7, None, "models:/M/7")]


def test_extract_model_ref_priority(spark):
    texts = spark.createDataFrame([(1, "TelcoChurn_RF and TelcoChurn_XGB v12"), (2, "TelcoChurn_RF build 123456 run 42"),
                                   (3, "nothing 5")], "id int, text string")
    known = spark.createDataFrame([("TelcoChurn_RF",), ("TelcoChurn_XGB",), ("TelcoChurn_LogReg",)], ["registered_model"])
    got = {r.id: (r.name, r.version) for r in R.extract_model_ref(texts, "text", "id", known).collect()}
    assert got == {1: ("TelcoChurn_XGB", 12), 2: ("TelcoChurn_RF", 42), 3: (None, None)}


def test_assign_alias_exclusive(spark):
    al = spark.createDataFrame([("champion", "A", "1"), ("challenger", "B", "2")], "alias string, registered_model string, version string")
    out = {(r.alias, r.registered_model, r.version) for r in R.assign_alias(al, "champion", F.lit("B"), F.lit(3)).collect()}
    assert out == {("challenger", "B", "2"), ("champion", "B", "3")}


def test_metric_table_rows_match_window(spark):
    """Row numbers from the distributed rank on the text order key equal the
    single-task window: names sharing long prefixes, accents, empty text, all splits."""
    import random
    from pyspark.sql import Window
    rnd = random.Random(7)
    alphabet = ["a", "b", "Z", "é", "ß", "0", " ", "model_"]
    names = {"", "model", "model_", "model_a", "model_ab", "model_b", "Ωmega"}
    while len(names) < 400:
        names.add("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 5))))
    rows = [(n, s, 0.5) for n in sorted(names) for s in ("test", "valid", "train")]
    df = spark.createDataFrame(rows, "model_key string, split string, f1 double") \
        .selectExpr("*", "f1 AS accuracy", "f1 AS precision", "f1 AS recall")
    got = {(r.model_key, r.split): r.row for r in R.metric_table(df).collect()}
    order = F.when(F.col("split") == "test", 0).when(F.col("split") == "valid", 1).otherwise(2)
    w = Window.orderBy(order, F.col("model_key"))
    want = {(r.model_key, r.split): r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


def test_extract_model_ref_several_automata_match_one(spark, monkeypatch):
    """Names beyond the bytes of one automaton are dealt to several: the same names and
    versions (names inside other names, repeats, several names, null and empty text,
    non-ASCII), and those that plain ``in`` finds."""
    import random
    rnd = random.Random(11)
    names = ["TelcoChurn_RF", "TelcoChurn_XGB", "TelcoChurn_LogReg", "RF", "Modèle_ß", "churn v2"] + \
            [f"model_{i}" for i in range(40)]
    words = names + ["build", "v7", "@3", "version 12", "run 42", "x", "99999", ""]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 5)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "TelcoChurn_RF TelcoChurn_RF v4")]
    texts = spark.createDataFrame(rows, "id int, text string")
    known = spark.createDataFrame([(n,) for n in names], ["registered_model"])
    a = {r.id: (r.name, r.version) for r in R.extract_model_ref(texts, "text", "id", known).collect()}
    monkeypatch.setattr(R, "AUTOMATON_BYTES", 60)
    b = {r.id: (r.name, r.version) for r in R.extract_model_ref(texts, "text", "id", known).collect()}
    assert a == b
    for i, text in rows:
        inside = [n for n in names if n in (text or "")]
        first = [n for n in R.NAME_PRIORITY if n in inside]
        want = None if not inside else inside[0] if len(inside) == 1 else first[0] if first else max(inside, key=lambda n: n.encode())
        assert a[i][0] in (want, None) and (a[i][0] == want or a[i][1] is None)
    assert sum(v[0] is not None for v in a.values()) > 50


def test_retag_per_experiment(spark):
    """The exclusive tag moves within each experiment: old champions lose it, each
    experiment's best run gains it, untouched runs are not rewritten."""
    runs = spark.createDataFrame(
        [("e1", "a", 0.5, True), ("e1", "b", 0.7, None), ("e2", "c", 0.6, None), ("e2", "d", 0.4, True),
         ("e2", "z", 0.1, None)],
        "experiment_name string, run_id string, f1 double, is_champion boolean")
    best = R.best_run(runs, "f1").select("experiment_name", F.col("run_id").alias("best_run_id"))
    got = {(r.run_id, r.is_champion) for r in R.retag(runs.join(best, "experiment_name", "left"), "best_run_id").collect()}
    assert got == {("a", False), ("b", True), ("c", True), ("d", False)}


def test_nan_null_groups_and_aliases(spark):
    from pyspark.sql import functions as F
    from tidemark.operators import runs, score
    rows = spark.createDataFrame([(1, float("nan")), (2, 0.7), (3, 0.1), (4, None)], "k int, proba double")
    got = {r["k"]: r["pred"] for r in score.apply_threshold(rows, 0.5).collect()}
    assert got[1] == 0 and got[2] == 1 and got[3] == 0
    grouped = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0)], "g string, v double")
    assert score.minmax_score(grouped, "v", by=["g"]).count() == 3
    tags = spark.createDataFrame([("r1", True), ("r2", False)], "run_id string, is_champion boolean")
    assert [tuple(r) for r in runs.retag(tags, F.lit(None).cast("string")).collect()] == [("r1", False)]
    aliases = spark.createDataFrame([(None, "m", "1"), ("champion", "n", "2")], "alias string, registered_model string, version string")
    out = runs.assign_alias(aliases, "champion", F.lit("m"), F.lit(3)).collect()
    assert sorted(str(r["alias"]) for r in out) == ["None", "champion"]


def test_flatten_metrics_has_no_depth_limit(spark):
    doc = '{"a": {"b": {"c": {"d": {"e": {"f1": 0.25}}}}}, "x": 1}'
    df = spark.createDataFrame([("m", doc)], "k string, doc string")
    assert {(r.key, r.value) for r in R.flatten_metrics(df, keep=["k"]).collect()} == {("a_b_c_d_e_f1", 0.25), ("x", 1.0)}
    assert {r.key for r in R.flatten_metrics(df, keep=["k"], max_depth=2).collect()} == {"x"}


def test_extract_model_ref_repeated_ids_version_zero_and_fallback(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "TelcoChurn_RF v4"), (1, "TelcoChurn_XGB v9"), (None, "TelcoChurn_RF v3"),
                                   (2, "TelcoChurn_RF v0 of 7"), (3, None)], "id int, text string")
    known = spark.createDataFrame([("TelcoChurn_RF",), ("TelcoChurn_XGB",), ("TelcoChurn_LogReg",)], ["registered_model"])
    versions = spark.createDataFrame([("TelcoChurn_LogReg", "9"), ("TelcoChurn_LogReg", "10"), ("A", "3")],
                                     ["registered_model", "version"])
    for bound in (32_000_000, 20):
        monkeypatch.setattr(R, "AUTOMATON_BYTES", bound)
        got = [tuple(r) for r in R.extract_model_ref(texts, "text", "id", known).collect()]
        assert sorted(got, key=str) == sorted([
            (1, "TelcoChurn_RF v4", "TelcoChurn_RF", 4), (1, "TelcoChurn_XGB v9", "TelcoChurn_XGB", 9),
            (None, "TelcoChurn_RF v3", "TelcoChurn_RF", 3), (2, "TelcoChurn_RF v0 of 7", None, None),
            (3, None, None, None)], key=str)
    last = {r.text: (r.name, r.version) for r in R.extract_model_ref(texts, "text", "id", known, versions=versions).collect()}
    assert last["TelcoChurn_RF v0 of 7"] == last[None] == ("TelcoChurn_LogReg", 10)
    assert last["TelcoChurn_RF v3"] == ("TelcoChurn_RF", 3)
    others = versions.where("registered_model = 'A'")
    assert R.extract_model_ref(texts.where("id = 3"), "text", "id", known, versions=others).first()[2:] == ("A", 3)


def test_selection_record(spark):
    from tidemark.operators import runs as R
    rows = [("LogReg", "TelcoChurn_LogReg", 0, 0.6, 0.7), ("RF", "TelcoChurn_RF", 1, 0.6, None), ("XGB", "TelcoChurn_XGB", 2, None, 0.9),
            ("LogReg", "TelcoChurn_LogReg", 4, 0.5, 0.1)]
    df = spark.createDataFrame(rows, "model_key string, registered_model string, position int, f1 double, accuracy double")
    versions = spark.createDataFrame([("TelcoChurn_LogReg", "9"), ("TelcoChurn_LogReg", "10"), ("TelcoChurn_RF", "2")], ["registered_model", "version"])
    cands = R.candidates(df, ["f1", "accuracy"])
    assert cands.count() == 3
    doc = R.selection_document(R.selection_roles(cands, versions), 77, "uri")
    rec = json.loads(doc.first()["doc"])
    assert rec["ts"] == 77 and rec["registry_uri"] == "uri"
    assert rec["champion"] == {"key": "LogReg", "model_name": "TelcoChurn_LogReg", "version": 10, "f1": 0.6, "metrics": {"f1": 0.6, "accuracy": 0.7}}
    assert rec["challenger"] == {"key": "RF", "model_name": "TelcoChurn_RF", "version": 2, "f1": 0.6, "metrics": {"f1": 0.6}}
    assert [c["key"] for c in rec["considered"]] == ["LogReg", "RF"]
    assert {(r["role"], r["key"], r["version"]) for r in R.read_selection(doc).collect()} == {("champion", "LogReg", 10), ("challenger", "RF", 2)}
    # a challenger without a version was considered only
    rec = json.loads(R.selection_document(R.selection_roles(cands, versions.where("version <> '2'")), 1, "u").first()["doc"])
    assert rec["challenger"] is None and len(rec["considered"]) == 2
    with pytest.raises(Exception, match="no registered version"):
        R.selection_document(R.selection_roles(cands, versions.where("version = '2'")), 1, "u").collect()
    assert R.selection_document(R.selection_roles(cands.limit(0), versions), 1, "u").count() == 0


def test_minmax_of_probabilities_rounded_to_one(spark):
    """Probabilities of exactly 0 and 1 give infinite decisions, as in the SQL twin, and no
    division by zero."""
    import duckdb
    import math
    rows = [("a", 0.25), ("a", 1.0), ("a", 0.5), ("b", 0.0), ("b", 0.5), ("c", 0.2), ("c", 0.8), ("c", None)]
    df = spark.createDataFrame(rows, "m string, proba double").withColumn("decision", score.log_odds(F.col("proba")))
    got = [(r.m, r.proba, r.decision, r.scaled) for r in score.minmax_score(df, "decision", "scaled", by=["m"]).collect()]
    want = duckdb.sql("""
        WITH d AS (SELECT m, p, ln(p / (1 - p)) AS decision FROM (VALUES ('a', 0.25::DOUBLE), ('a', 1), ('a', 0.5), ('b', 0), ('b', 0.5),
                                                                        ('c', 0.2), ('c', 0.8), ('c', NULL)) t(m, p)),
        mm AS (SELECT m, min(decision) AS mn, max(decision) AS mx FROM d GROUP BY m)
        SELECT m, p, decision, (decision - mn) / (mx - mn + 1e-12) FROM d JOIN mm USING (m)""").fetchall()

    def plain(rows):
        return sorted(tuple(f"{x:.9g}" if isinstance(x, float) and not math.isnan(x) else str(x) for x in r) for r in rows)
    assert plain(got) == plain(want)
