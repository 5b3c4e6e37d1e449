"""Run log, leaderboards, champion selection, model versions and aliases, and
model-reference parsing.

A run log is a table: ``run_id, run_name, experiment_name, model_key,
registered_model, split, start_time`` plus either a ``metrics`` map or flattened metric
columns.  Every operator is a projection, an aggregate or a join over such tables;
top-1 choices name a full order (``min(struct(...))`` or ``row_number``) so ties are
deterministic.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import quoted
from tidemark.operators.ranges import ROWS_PER_RANGE
from tidemark.operators.ranking import stratified_rank
from tidemark.session import materialize

# Metric file per model key, in candidate order.
METRIC_FILES = {"LogReg": "metrics_test.json", "RF": "metrics_test_rf.json",
                "XGB": "metrics_test_xgb.json", "FE": "metrics_test_fe.json"}
# Registered model name per model key (two keys share one name).
REGISTERED_NAMES = {"LogReg": "TelcoChurn_LogReg", "FE": "TelcoChurn_LogReg",
                    "RF": "TelcoChurn_RF", "XGB": "TelcoChurn_XGB"}
# Display label per metric file name; other names show as themselves.
FILE_LABELS = {"metrics_test.json": "LogReg baseline", "metrics_test_rf.json": "RandomForest",
               "metrics_test_xgb.json": "XGBoost", "metrics_test_fe.json": "LogReg FE"}
# Preference among known names found in free text.
NAME_PRIORITY = ("TelcoChurn_LogReg", "TelcoChurn_XGB", "TelcoChurn_RF")
# Fixed value: the model taken where a text names none.
FALLBACK_NAME = "TelcoChurn_LogReg"
# Fixed value: version mention in free text ("v34", "@34", "version 34").
VERSION_PATTERN = r"(?i)(?:\bv|@|version[^0-9]{0,10})(\d{1,5})"
# A number in free text, and the forms of a model reference.
NUMBER_PATTERN = r"(\d{1,5})"
URI_PATTERN, URI_VERSION = r"(?i)^models:/(.*)$", r"^[^/]*/(.*)$"
URI_ALIAS, TEXT_ALIAS = r"^[^@]*@(.*)$", r"^[^@]*@(.*)$"
NAME_VERSION_FORM, NAME_VERSION = r"(?i)^.+?\s+v\d+$", r"(?i)^(.+?)\s+v(\d+)$"
# First-present aliases of each metric.
METRIC_ALIASES = {"accuracy": ("accuracy", "acc"), "precision": ("precision", "prec"),
                  "recall": ("recall", "rec"), "f1": ("f1", "f1_score")}

NUMERIC_VARIANT = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$"


def lookup(mapping: dict, key: Column) -> Column:
    """A fixed small mapping applied as a literal map (no join)."""
    return F.element_at(F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]), key)


# --- R1 -------------------------------------------------------------------------------
def log_runs(runs: DataFrame, path: str) -> DataFrame:
    """Append runs to the run-log table (Parquet, partitioned by experiment) and return it."""
    runs.write.mode("append").partitionBy("experiment_name").parquet(path)
    return runs.sparkSession.read.parquet(path)


# --- R2 / R3 --------------------------------------------------------------------------
def flatten_metrics(df: DataFrame, doc_col: str = "doc", keep=(), max_depth: int | None = None, sep: str = "_") -> DataFrame:
    """Nested JSON metrics to ``key, value`` rows: nested keys joined with ``sep``;
    numbers and booleans (as 1.0 / 0.0) kept; strings, lists and nulls ignored; an
    empty key dropped; documents that do not parse give no rows.

    One explode per nesting level, down to the deepest object of the documents: a probe
    for one more nested object follows each level.  ``max_depth`` sets the number of
    levels instead (deeper metrics are then left out, and nothing is probed)."""
    keep = list(keep)
    cur = df.select(*keep, F.lit("").alias("_path"), F.try_parse_json(F.col(doc_col)).alias("_v"))
    parts = []
    while max_depth is None or len(parts) < max_depth:
        ex = cur.select(*keep, "_path",
                        F.explode(F.expr("try_variant_get(_v, '$', 'map<string,variant>')")).alias("_k", "_x"))
        path = F.when(F.col("_path") == "", F.col("_k")).otherwise(F.concat(F.col("_path"), F.lit(sep), F.col("_k")))
        ex = ex.select(*keep, path.alias("_p"), "_x", F.schema_of_variant("_x").alias("_t"))
        parts.append(ex.where(F.col("_t").rlike(NUMERIC_VARIANT) & (F.col("_p") != ""))
                     .select(*keep, F.col("_p").alias("key"),
                             F.expr("try_variant_get(_x, '$', 'double')").alias("value")))
        cur = ex.where(F.col("_t").startswith("OBJECT")).select(*keep, F.col("_p").alias("_path"), F.col("_x").alias("_v"))
        if max_depth is None and cur.isEmpty():
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def import_metric_documents(docs: DataFrame, name_col: str = "file") -> DataFrame:
    """Every parseable, non-empty metrics document becomes one run named by its
    file stem; bad or empty documents are skipped."""
    good = docs.where(F.try_parse_json(F.col("doc")).isNotNull())
    stem = F.regexp_replace(F.col(name_col), r"\.[^.]*$", "")
    return flatten_metrics(good.withColumn("run_name", stem), "doc", keep=["run_name"])


# --- R4 / R5 / R6 ---------------------------------------------------------------------
def _vget(doc: Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(doc), path, "double")


def primary_f1(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """``test.f1``, else ``valid.f1``; a document with neither is an error."""
    f1 = F.coalesce(_vget(F.col(doc_col), "$.test.f1"), _vget(F.col(doc_col), "$.valid.f1"))
    return docs.withColumn("f1", F.when(f1.isNotNull(), f1).otherwise(
        F.raise_error(F.concat(F.lit("no f1 in document "), F.col(doc_col))).cast("double")))


def metrics_or_flat(docs: DataFrame, doc_col: str = "doc", names=("f1", "accuracy", "precision", "recall")) -> DataFrame:
    """Metrics nested under ``test`` or at the top level; a missing f1 reads as 0."""
    has_test = F.try_variant_get(F.try_parse_json(F.col(doc_col)), "$.test", "variant").isNotNull()
    out = docs
    for n in names:
        v = F.when(has_test, _vget(F.col(doc_col), f"$.test.{n}")).otherwise(_vget(F.col(doc_col), f"$.{n}"))
        out = out.withColumn(n, F.coalesce(v, F.lit(0.0)) if n == "f1" else v)
    return out


def metric_alias(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """First present alias per metric (accuracy/acc, precision/prec, recall/rec, f1/f1_score)."""
    out = docs
    for name, keys in METRIC_ALIASES.items():
        out = out.withColumn(name, F.coalesce(*[_vget(F.col(doc_col), f"$.{k}") for k in keys]))
    return out


# --- R7 / R8 --------------------------------------------------------------------------
def label_for(df: DataFrame, file_col: str = "file", out: str = "label") -> DataFrame:
    return df.withColumn(out, F.coalesce(lookup(FILE_LABELS, F.col(file_col)), F.col(file_col)))


def leaderboard(df: DataFrame, score: str = "f1", position: str = "position", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rank by score descending (missing scores last), input position breaking ties;
    ``is_winner`` on rank 1.

    The rank is the distributed exact rank (ranges of score and position together, plus
    per-range offsets), so a long run log is ranked by many tasks, never gathered into
    one, even where most runs share a score."""
    s = F.col(score).cast("double")
    keyed = df.withColumn("_neg", F.coalesce(-s, F.lit(float("inf")))).withColumn("_nul", s.isNull().cast("int"))
    r = stratified_rank(keyed, [], ["_neg", "_nul", position], order="key", rows_per_range=rows_per_range,
                        rank_col="_rk", size_col="_n")
    return (r.withColumn("rank", (F.col("_rk") + 1).cast("int"))
            .withColumn("is_winner", F.col("rank") == 1)
            .drop("_neg", "_nul", "_rk", "_n"))


# --- R9 -------------------------------------------------------------------------------
def fmt4(c: Column) -> Column:
    """Four decimals, ties to even like Python's formatting; missing as ``-``
    (``format_string`` alone rounds ties up and prints "null")."""
    return F.when(c.isNotNull(), F.format_string("%.4f", F.bround(c, 4))).otherwise(F.lit("-"))


def metric_table(df: DataFrame, metrics=("accuracy", "precision", "recall", "f1"), split_col: str = "split",
                 model_col: str = "model_key", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Display table: test rows before valid rows, then by model (rows of one model by
    their printed numbers); numbers to 4 places, missing values as ``-``."""
    order = F.when(F.col(split_col) == "test", 0).when(F.col(split_col) == "valid", 1).otherwise(2)
    cells = [fmt4(F.col(m)).alias(m) for m in metrics]
    t = df.select(F.col(model_col), F.col(split_col), order.alias("split_order"), *cells)
    # row number over (split order, model, numbers): the distributed exact rank
    r = stratified_rank(t, [], ["split_order", model_col, *metrics], order="key", rows_per_range=rows_per_range,
                        rank_col="_rk", size_col="_n")
    return r.withColumn("row", (F.col("_rk") + 1).cast("int")).drop("_rk", "_n")


# --- R10 / R11 ------------------------------------------------------------------------
def registered_name(key: Column) -> Column:
    return lookup(REGISTERED_NAMES, key)


def top_two(df: DataFrame, score: str = "f1", position: str = "position", key: str = "model_key") -> DataFrame:
    """Champion and challenger: the two best by score, candidate order breaking ties;
    ``considered`` lists every candidate in candidate order.

    The top two is a distributed top-k (``orderBy().limit(2)``: every task keeps its own
    best two, the final merge sees two rows per task)."""
    # distinct candidates first (partial aggregation per task), so the list holds one
    # entry per model, however many runs the log has
    cands = df.groupBy(key).agg(F.min(position).alias(position))
    considered = cands.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(position, key))),
                                                    lambda s: s[key]), ",").alias("considered"))
    top = df.orderBy(F.col(score).desc_nulls_last(), F.col(position)).limit(2)
    # rank inside the two kept rows only
    top = (top.withColumn("_r", F.row_number().over(Window.orderBy(F.col(score).desc_nulls_last(), F.col(position))))
           .withColumn("role", F.when(F.col("_r") == 1, "champion").otherwise("challenger")).drop("_r"))
    # a scalar subquery: evaluated once, when the result is
    return top.withColumn("considered", considered.scalar())


def candidates(df: DataFrame, metrics: list[str], score: str = "f1", position: str = "position", key: str = "model_key") -> DataFrame:
    """One row per candidate model, best run first in case of several: key, registered
    name, score and all metrics as a map (null metrics left out).  A table, however many
    candidates the log has."""
    pairs = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(m).alias("k"), F.col(m).cast("double").alias("v")) for m in metrics]),
                                        lambda x: x["v"].isNotNull()))
    best = F.min(F.struct(F.coalesce(-F.col(score).cast("double"), F.lit(float("inf"))).alias("o"), F.col(position).alias("position"),
                          F.col("registered_model").alias("model_name"), F.col(score).cast("double").alias("score"),
                          F.to_json(pairs).alias("metrics")))
    one = df.groupBy(F.col(key).alias("key")).agg(best.alias("b"))
    return one.select("key", "b.position", "b.model_name", F.col("b.score").alias("f1"), F.from_json("b.metrics", "map<string,double>").alias("metrics"))


def selection_roles(cands: DataFrame, versions: DataFrame) -> DataFrame:
    """The two best candidates with role and latest registered version.  A champion without
    a version is an error; a challenger without one is no challenger (``role`` null), but
    was considered."""
    top = cands.orderBy(F.col("f1").desc_nulls_last(), "position").limit(2)
    rank = F.row_number().over(Window.orderBy(F.col("f1").desc_nulls_last(), "position"))      # of two rows
    last = latest_version(versions).select(F.col("registered_model").alias("model_name"), F.col("latest_version").alias("version"))
    both = top.withColumn("place", rank).join(last, "model_name", "left")
    role = F.when(F.col("place") == 1, F.when(F.col("version").isNotNull(), F.lit("champion")).otherwise(
        F.raise_error(F.concat(F.lit("no registered version of "), F.col("model_name"))).cast("string"))) \
        .when(F.col("version").isNotNull(), F.lit("challenger"))
    return both.select("place", role.alias("role"), "key", "model_name", "version", "f1", "metrics")


def selection_document(roles: DataFrame, selected_at: int, registry_uri: str) -> DataFrame:
    """The selection record as one JSON document (column ``doc``): time, registry, champion
    and challenger with key, model, version, F1 and metrics, and those considered."""
    own = F.struct("key", "model_name", "version", "f1", "metrics")
    both = roles.agg(F.array_sort(F.collect_list(F.struct("place", "role", own.alias("x"))),      # at most two rows
                                  lambda a, b: a["place"] - b["place"]).alias("all"))
    of = lambda role: F.get(F.filter("all", lambda r: r["role"] == role), F.lit(0))["x"]
    considered = F.transform("all", lambda r: F.struct(r["x"]["key"].alias("key"), r["x"]["f1"].alias("f1"), r["x"]["metrics"].alias("metrics")))
    return both.where(F.size("all") > 0).select(F.to_json(F.struct(
        F.lit(selected_at).cast("long").alias("ts"), F.lit(registry_uri).alias("registry_uri"), of("champion").alias("champion"),
        of("challenger").alias("challenger"), considered.alias("considered")), {"ignoreNullFields": "false"}).alias("doc"))


# Fixed value: the layout of a selection record.
SELECTION_SCHEMA = ("ts long, registry_uri string, "
                    "champion struct<key:string,model_name:string,version:int,f1:double,metrics:map<string,double>>, "
                    "challenger struct<key:string,model_name:string,version:int,f1:double,metrics:map<string,double>>, "
                    "considered array<struct<key:string,f1:double,metrics:map<string,double>>>")


def read_selection(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """A stored selection record as rows: ``ts, role, key, model_name, version, f1, metrics``."""
    d = docs.select(F.from_json(F.col(doc_col), SELECTION_SCHEMA).alias("d")).select("d.*")
    roles = F.filter(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("x")) for r in ("champion", "challenger")]),
                     lambda e: e["x"].isNotNull())
    return d.select("ts", F.explode(roles).alias("e")).select("ts", "e.role", "e.x.*")


# --- R12 / R13 ------------------------------------------------------------------------
def best_run(runs: DataFrame, metric: str = "f1", by=("experiment_name",), min_value: float = 0.0) -> DataFrame:
    """Per experiment, the run with the highest metric above ``min_value``; run id
    breaks ties.  An aggregate, not a sort."""
    by = list(by)
    m = F.col(metric)
    best = (runs.where(m > F.lit(min_value))
            .groupBy(*by).agg(F.min(F.struct((-m).alias("_neg"), F.col("run_id").alias("run_id"))).alias("_b")))
    return best.select(*by, F.col("_b.run_id").alias("run_id"), (-F.col("_b._neg")).alias(metric))


def best_named_run(runs: DataFrame, prefix: str, metric: str = "f1") -> DataFrame:
    """Among runs whose name starts with ``prefix``, the best by ``metric``; runs
    without the metric come last (chosen only when no run has it)."""
    r = runs.where(F.col("run_name").startswith(prefix))
    m = F.col(metric)
    return (r.groupBy().agg(F.min(F.struct(m.isNull().alias("_null"), (-m).alias("_neg"),
                                           F.col("run_id").alias("run_id"))).alias("_b"))
            .select(F.col("_b.run_id").alias("run_id"), (-F.col("_b._neg")).alias(metric))
            .where(F.col("run_id").isNotNull()))


# --- R14 ------------------------------------------------------------------------------
def retag(runs: DataFrame, best_run_id: Column | str, tag_col: str = "is_champion") -> DataFrame:
    """Exclusive champion tag: rows that were or become champion get the new value."""
    best = F.col(best_run_id) if isinstance(best_run_id, str) else best_run_id
    touched = runs.where(F.coalesce(F.col(tag_col), F.lit(False)) | (F.col("run_id") == best))
    # without a best run the old champion loses its tag
    return touched.select("run_id", F.coalesce(F.col("run_id") == best, F.lit(False)).alias(tag_col))


# --- R15 / R16 / R17 ------------------------------------------------------------------
def latest_version(versions: DataFrame, name_col: str = "registered_model") -> DataFrame:
    """Highest numeric version per model (versions are text)."""
    return versions.groupBy(name_col).agg(F.max(F.col("version").try_cast("int")).alias("latest_version"))


def assign_alias(aliases: DataFrame, alias: str, name: Column, version: Column,
                 holder: DataFrame | None = None) -> DataFrame:
    """Give ``alias`` to (name, version), removing it from every other model.  ``name`` and
    ``version`` are literals, or columns of ``holder``, a table of the one new holder."""
    kept = aliases.where(~F.col("alias").eqNullSafe(F.lit(alias)))
    new = (aliases.sparkSession.range(1) if holder is None else holder).select(F.lit(alias).alias("alias"), name.alias("registered_model"),
                                               version.cast("string").alias("version"))
    return kept.unionByName(new)


def version_of_run(champion: DataFrame, versions: DataFrame, name_col: str = "registered_model") -> DataFrame:
    """Version created by the champion run (lowest if several); none -> null."""
    v = versions.groupBy(name_col, "run_id").agg(F.min(F.col("version").try_cast("int")).alias("version"))
    return champion.join(v, [name_col, "run_id"], "left")


# --- R18 / R19 ------------------------------------------------------------------------
def champion_changed(best: DataFrame, prev: DataFrame, key=("experiment_name",), metric: str = "f1") -> DataFrame:
    """``changed``: no stored champion, or a different run id.  ``improved``: changed
    and the metric beats the stored one.  ``reason`` explains the decision."""
    key = list(key)
    p = prev.select(*key, F.col("run_id").alias("prev_run_id"), F.col(metric).alias(f"prev_{metric}"))
    j = best.join(p, key, "left")
    no_prev = F.col("prev_run_id").isNull()
    changed = no_prev | ~F.col("run_id").eqNullSafe(F.col("prev_run_id"))
    improved = no_prev | (changed & (F.col(metric) > F.col(f"prev_{metric}")))
    reason = (F.when(no_prev, "no previous champion")
              .when(~changed, "same run")
              .when(F.col(metric) > F.col(f"prev_{metric}"), "better metric")
              .otherwise("different run, metric not better"))
    return j.select("*", changed.alias("changed"), improved.alias("improved"), reason.alias("reason"))


# --- R20 / R21 / R23 ------------------------------------------------------------------
def parse_model_ref(ref: Column) -> Column:
    """``models:/N@alias``, ``models:/N/3``, ``models:/N``, ``N@alias``, ``N v3``, ``N``
    -> struct(name, version, alias)."""
    s = F.trim(ref)
    is_uri = F.lower(s).startswith("models:/")
    spec = F.regexp_extract(s, URI_PATTERN, 1)
    uri_alias = F.instr(spec, "@") > 0
    uri_ver = F.instr(spec, "/") > 0
    at = (F.instr(s, "@") > 0) & ~F.lower(s).contains(" v")
    nv = s.rlike(NAME_VERSION_FORM)
    name = (F.when(is_uri & uri_alias, F.trim(F.substring_index(spec, "@", 1)))
            .when(is_uri & uri_ver, F.trim(F.substring_index(spec, "/", 1)))
            .when(is_uri, F.trim(spec))
            .when(at, F.trim(F.substring_index(s, "@", 1)))
            .when(nv, F.trim(F.regexp_extract(s, NAME_VERSION, 1)))
            .otherwise(s))
    ver_text = F.when(is_uri & ~uri_alias & uri_ver, F.regexp_extract(spec, URI_VERSION, 1)) \
        .when(~is_uri & ~at & nv, F.regexp_extract(s, NAME_VERSION, 2))
    alias = (F.when(is_uri & uri_alias, F.trim(F.regexp_extract(spec, URI_ALIAS, 1)))
             .when(~is_uri & at, F.trim(F.regexp_extract(s, TEXT_ALIAS, 1))))
    return F.struct(name.alias("name"), F.trim(ver_text).try_cast("int").alias("version"), alias.alias("alias"))


def parse_selection(doc: Column) -> Column:
    """A selection object with key variants (name/model/registered_model/model_name;
    version/model_version/v; alias; uri), keys matched case-insensitively; a bare
    string is parsed as a model reference."""
    v = F.try_parse_json(doc)
    m = F.transform_keys(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, _: F.lower(k))

    def key(k, t="string"):
        return F.try_variant_get(F.element_at(m, F.lit(k)), "$", t)
    name = F.coalesce(key("name"), key("model"), key("registered_model"), key("model_name"))
    version = F.coalesce(key("version"), key("model_version"), key("v"))
    from_uri = parse_model_ref(key("uri"))
    from_text = parse_model_ref(F.try_variant_get(v, "$", "string"))
    obj = m.isNotNull()
    use_uri = obj & name.isNull() & F.lower(key("uri")).startswith("models:/")
    return (F.when(use_uri, from_uri)
            .when(obj, F.struct(name.alias("name"), F.trim(version).try_cast("int").alias("version"),
                                key("alias").alias("alias")))
            .otherwise(from_text))


def resolve_model_uri(name: Column, version: Column, alias: Column) -> Column:
    """Alias, else version, else the Staging stage."""
    return (F.when(alias.isNotNull() & (alias != ""), F.concat(F.lit("models:/"), name, F.lit("@"), alias))
            .when(version.isNotNull(), F.concat(F.lit("models:/"), name, F.lit("/"), version.cast("string")))
            .otherwise(F.concat(F.lit("models:/"), name, F.lit("/Staging"))))


# --- R22 ------------------------------------------------------------------------------
#: Bytes of known names in one automaton; more names make more automata (and passes).
AUTOMATON_BYTES = 32_000_000


def _found_names(shared):
    """For every text the known names in it: how many, the best by priority, the last."""
    def run(it):
        automaton = shared.value
        for batch in it:
            out = [], [], []
            for text in batch.column("_text").to_pylist():
                names = {name for _, name in automaton.iter(text)} if text else ()
                out[0].append(len(names))
                out[1].append(min(((_priority(n), n) for n in names), default=(None, None))[1])
                out[2].append(max(names, key=lambda n: n.encode(), default=None))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in batch.schema.names if c != "_text"], pa.array(out[0], pa.int64()),
                                              pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                                             names=[*[c for c in batch.schema.names if c != "_text"], "_n", "_best", "_last"])
    return run


def _priority(name: str) -> int:
    return NAME_PRIORITY.index(name) if name in NAME_PRIORITY else len(NAME_PRIORITY)


def _name_matches(t: DataFrame, names: DataFrame) -> DataFrame:
    """``_tid`` with ``_n, _best, _last`` of the known names that occur in ``_text``.

    An Aho-Corasick automaton over the names is built once and broadcast; a scan of a text
    finds all names in it, overlapping ones too, in time linear in the text.  Names beyond
    ``AUTOMATON_BYTES`` are dealt by hash to several automata, each a scan of the texts
    whose matches are merged; so no broadcast exceeds the bound."""
    import ahocorasick
    spark = t.sparkSession
    size = names.agg(F.sum(F.octet_length("_name"))).first()[0] or 0
    parts = max(1, -(-size // AUTOMATON_BYTES))
    dealt = materialize(names.select("_name", F.pmod(F.xxhash64("_name"), F.lit(parts)).alias("_part")))
    found = None
    for i in range(parts):
        automaton = ahocorasick.Automaton()
        for r in dealt.where((F.col("_part") == i) & (F.col("_name") != "")).select("_name").toLocalIterator():
            automaton.add_word(r["_name"], r["_name"])
        if not len(automaton):
            continue
        automaton.make_automaton()
        hits = t.select("_tid", "_text").mapInArrow(_found_names(spark.sparkContext.broadcast(automaton)),
                                                    "_tid long, _n long, _best string, _last string").where("_n > 0")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return t.select("_tid", F.lit(0).cast("long").alias("_n"), F.lit(None).cast("string").alias("_best"),
                        F.lit(None).cast("string").alias("_last")).limit(0)
    if parts == 1:
        return found
    rank = F.coalesce(F.array_position(F.array(*[F.lit(n) for n in NAME_PRIORITY]), F.col("_best")).cast("int"), F.lit(0))
    rank = F.when(rank == 0, len(NAME_PRIORITY) + 1).otherwise(rank)
    return found.groupBy("_tid").agg(F.sum("_n").alias("_n"), F.min(F.struct(rank.alias("p"), F.col("_best").alias("b")))["b"].alias("_best"),
                                     F.max("_last").alias("_last"))


def extract_model_ref(texts: DataFrame, text_col: str, id_col: str, known: DataFrame,
                      name_col: str = "registered_model", versions: DataFrame | None = None) -> DataFrame:
    """Find a known model name and a version in free text.

    Names: every known name that occurs anywhere in a text, overlapping ones included (see
    ``_name_matches``).  One match wins, several go by the fixed priority, then the
    last-listed known name.  Version: ``v34`` / ``@34`` / ``version 34``, else the last
    number in 1..10000; an explicit 0 is no version.  Rows without both give nulls, or,
    given ``versions`` (name, version), the fixed fallback model (else the first known
    name) with its latest version.  Every row is judged by itself: ids may repeat or be
    null."""
    names = known.select(F.col(name_col).alias("_name")).where("_name is not null").distinct()
    t = materialize(texts.select(F.struct(*[quoted(c) for c in texts.columns]).alias("_row"), F.col(text_col).cast("string").alias("_text"),
                                 F.monotonically_increasing_id().alias("_tid")))     # fixes the row numbers
    found = t.join(_name_matches(t, names), "_tid", "left")
    name = F.when(F.col("_n") == 1, F.col("_best")).when(F.col("_best").isin(*NAME_PRIORITY), F.col("_best")).otherwise(F.col("_last"))
    explicit = F.regexp_extract(F.col("_text"), VERSION_PATTERN, 1)
    nums = F.filter(F.transform(F.regexp_extract_all(F.col("_text"), F.lit(NUMBER_PATTERN), 1),
                                lambda x: x.cast("int")), lambda x: (x > 0) & (x <= 10000))
    version = F.when(explicit != "", explicit.cast("int")).otherwise(F.try_element_at(nums, F.lit(-1)))
    ok = name.isNotNull() & (version > 0)
    other_name, other_version = F.lit(None).cast("string"), F.lit(None).cast("int")
    if versions is not None:
        last = latest_version(versions, name_col).where(F.col("latest_version").isNotNull())
        pick = last.agg(F.min(F.struct((F.col(name_col) != FALLBACK_NAME).alias("o"), F.col(name_col).alias("name"),
                                       F.col("latest_version").alias("version"))).alias("p"))
        other_name, other_version = pick.select("p.name").scalar(), pick.select("p.version").scalar()
    return found.select("_row.*", F.when(ok, name).otherwise(other_name).alias("name"),
                        F.when(ok, version).otherwise(other_version).alias("version"))
