"""Schema and cleaning operators: canonical names, label encoding, id removal,
trimming, numeric coercion, median imputation, one-hot encoding, assembly, manifest,
label dropping and rule validation.

Fitting (which columns are numeric, medians, category lists) is done by a few small
aggregation jobs whose results - one number or a bounded list per column - are kept in
an ``EncodingSpec``.  Applying a spec is a pure projection, so it can be reused on new
batches and on streams.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import NUMERIC_TEXT, nan_to_null, parse_number, quoted
from tidemark.operators.ranking import exact_medians, stratified_rank
from tidemark.session import checked_collect, materialize, shared_path

# Fixed value: the pattern that marks id-like columns (applied to canonical names).
ID_LIKE = r"(customer.*id$)|(^id$)|(_id$)"
# Fixed value: what becomes one underscore in a column name.
NAME_BREAK = re.compile(r"\s+|[-/]")
#: A column with more categories than this is encoded as a sparse vector, not as dummies.
MAX_CATEGORIES = 1_000

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# --- C2 -------------------------------------------------------------------------------
def canonical_names(names: list[str], resolve: bool = False) -> list[str]:
    """Lower-case names in which a run of white space, a hyphen and a slash is each one
    underscore.  Names that fall together are an error, or with ``resolve`` all but the
    first take the first free suffix ``_2``, ``_3``..."""
    out: list[str] = []
    wanted = ["_".join(NAME_BREAK.split(name.strip().lower())) for name in names]
    for name in wanted:
        if name in out and not resolve:
            raise ValueError(f"canonical names collide: {sorted({n for n in wanted if wanted.count(n) > 1})}")
        new, n = name, 1
        while new in out or (n > 1 and new in wanted):
            n += 1
            new = f"{name}_{n}"
        out.append(new)
    return out


def canonicalize(df: DataFrame, resolve: bool = False) -> DataFrame:
    """A metadata-only rename to ``canonical_names``."""
    return df.toDF(*canonical_names(df.columns, resolve))


# --- C3 -------------------------------------------------------------------------------
def find_target(df: DataFrame, name: str = "churn") -> str:
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise ValueError(f"target column {name!r} not found (case-insensitive)")


# --- C4 -------------------------------------------------------------------------------
def encode_label(df: DataFrame, col: str, strict_compat: bool = False, out: str | None = None) -> DataFrame:
    """Yes/No text to 1/0; numbers truncated to int; anything else 0.

    ``strict_compat=True`` keeps the original rule where any text other than yes/no
    (including ``"1"``) becomes 0.  By default numeric text is read as a number.
    """
    out = out or col
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        t = F.lower(F.trim(F.col(col)))
        other = F.lit(0) if strict_compat else F.coalesce(parse_number(F.col(col)).try_cast("int"), F.lit(0))
        expr = F.when(t == "yes", 1).when(t == "no", 0).otherwise(other)
    elif isinstance(dtype, T.BooleanType):
        expr = F.coalesce(F.col(col).cast("int"), F.lit(0))
    else:
        expr = F.coalesce(F.col(col).try_cast("int"), F.lit(0))
    return df.withColumn(out, expr.cast("int"))


# --- C5 -------------------------------------------------------------------------------
def id_like_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if re.search(ID_LIKE, c)]


def drop_id_like(df: DataFrame, keep_as: str | None = "row_key") -> DataFrame:
    """Drop id-like columns.  The first one is kept as ``keep_as`` (outside the features)
    because splits, scores and stream deduplication need a row identity."""
    ids = id_like_columns(df)
    if not ids:
        return df
    if keep_as:
        df = df.withColumnRenamed(ids[0], keep_as) if ids[0] != keep_as else df
        ids = ids[1:]
    return df.drop(*ids)


# --- C6 -------------------------------------------------------------------------------
def trim_strings(df: DataFrame) -> DataFrame:
    cols = [F.trim(quoted(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else quoted(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


# --- C7 -------------------------------------------------------------------------------
def numeric_text_columns(df: DataFrame, ratio: float = 0.5, exclude=(), known=()) -> list[str]:
    """String columns where at least one value parses and parsed >= ratio * non-null, and
    those ``known`` to hold numbers, however many are blank.

    One aggregation job over all string columns; two counts per column reach the driver.
    """
    return _profile(df, ratio, exclude, known)[0]


def _profile(df: DataFrame, ratio: float = 0.5, exclude=(), known=()) -> tuple[list[str], dict]:
    """One pass: the numeric-text columns, and the count of numeric values (NaN as
    missing) of every column that is numeric once they are coerced (what the exact
    medians need first)."""
    cands = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]
    if not cands and not nums:
        return [], {}
    aggs = []
    for i, c in enumerate(cands):
        aggs += [F.count(parse_number(quoted(c))).alias(f"p{i}"), F.count(quoted(c)).alias(f"n{i}")]
    aggs += [F.count(nan_to_null(quoted(c).cast("double"))).alias(f"k{j}") for j, c in enumerate(nums)]
    row = df.agg(*aggs).collect()[0]
    text = [c for i, c in enumerate(cands) if c in known or row[f"p{i}"] > 0 and row[f"p{i}"] >= row[f"n{i}"] * ratio]
    counts = {c: row[f"k{j}"] for j, c in enumerate(nums)}
    counts.update({c: row[f"p{i}"] for i, c in enumerate(cands) if c in text})
    return text, counts


def coerce_numeric(df: DataFrame, ratio: float = 0.5, exclude=(), columns: list[str] | None = None, known=()) -> DataFrame:
    """Convert numeric-looking text columns to double; values that do not parse become null."""
    cols = numeric_text_columns(df, ratio, exclude, known) if columns is None else columns
    return df.withColumns({c: parse_number(quoted(c)) for c in cols}) if cols else df


def restore_booleans(df: DataFrame, exclude=()) -> DataFrame:
    """Text columns of true/false only (any letter case, at least one value) back to
    boolean, as a CSV keeps them as text.  One aggregation, two counts a column."""
    cands = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    if not cands:
        return df
    is_bool = {c: F.lower(quoted(c)).isin("true", "false") for c in cands}
    row = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(cands)],
                 *[F.count(F.when(is_bool[c], 1)).alias(f"b{i}") for i, c in enumerate(cands)]).collect()[0]
    cols = [c for i, c in enumerate(cands) if row[f"n{i}"] and row[f"n{i}"] == row[f"b{i}"]]
    return df.withColumns({c: F.lower(quoted(c)) == "true" for c in cols}) if cols else df


# --- C8 -------------------------------------------------------------------------------
def column_kinds(df: DataFrame, exclude=()) -> dict:
    kinds = {"numeric": [], "categorical": [], "boolean": []}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.BooleanType):
            kinds["boolean"].append(f.name)
        elif isinstance(f.dataType, NUMERIC_TYPES):
            kinds["numeric"].append(f.name)
        elif isinstance(f.dataType, T.StringType):
            kinds["categorical"].append(f.name)
    return kinds


# --- C9 -------------------------------------------------------------------------------
def fit_medians(df: DataFrame, cols: list[str], exact: bool = True, accuracy: int = 100_000,
                counts: dict | None = None) -> dict:
    """Median of each column.  ``exact`` interpolates like pandas; otherwise
    ``percentile_approx`` (one job, no interpolation).  ``counts`` (values per column,
    from an earlier pass) saves the exact path its counting job."""
    if not cols:
        return {}
    if exact:
        return exact_medians(df, cols, counts=counts)
    row = df.agg(*[F.percentile_approx(quoted(c).cast("double"), 0.5, accuracy).alias(c) for c in cols]).collect()[0]
    return {c: (None if row[c] is None else float(row[c])) for c in cols}


def impute(df: DataFrame, medians: dict) -> DataFrame:
    """Fill nulls (and NaN) from fitted values; an all-null column stays null."""
    out = {}
    for c, m in medians.items():
        v = quoted(c)
        v = F.when(~F.isnan(v), v) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else v
        out[c] = v if m is None else F.coalesce(v.cast("double"), F.lit(float(m)))
    return df.withColumns(out) if out else df


def impute_median(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    cols = cols if cols is not None else column_kinds(df)["numeric"]
    return impute(df, fit_medians(df, cols, exact))


# --- C10 ------------------------------------------------------------------------------
def fit_categories(df: DataFrame, cols: list[str], max_categories: int = MAX_CATEGORIES, pairs: DataFrame | None = None) -> dict:
    """Sorted distinct non-null values per column, in one aggregation job; columns with more
    than ``max_categories`` are left out (see ``fit_dictionary``).

    The distinct (column, value) pairs are deduplicated map-side; only when the bound is
    passed a second job counts them per column, and the wide ones never reach the driver.
    ``pairs``: the ``category_values`` of the columns, where they are stored already.
    """
    if not cols:
        return {}
    pairs, bound = category_values(df, cols) if pairs is None else pairs, max_categories * len(cols)
    rows = pairs.limit(bound + 1).collect()
    if len(rows) > bound:
        few = pairs.groupBy("feature").count().where(F.col("count") <= max_categories).select("feature")
        rows = checked_collect(pairs.join(few, "feature", "left_semi"), bound, "category discovery")
        wide = set(cols) - {r["feature"] for r in rows} - _without_values(df, cols)
    else:
        wide = set()
    cats: dict[str, list] = {c: [] for c in cols if c not in wide}
    for r in rows:
        cats[r["feature"]].append(r["value"])
    return {c: sorted(vs) for c, vs in cats.items() if len(vs) <= max_categories}


def _without_values(df: DataFrame, cols: list[str]) -> set[str]:
    row = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return {c for i, c in enumerate(cols) if not row[f"n{i}"]}


def category_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """The distinct non-null ``(feature, value)`` pairs of text columns."""
    return (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).cast("string").alias("value"))
                                           for c in cols])).alias("p"))
            .select("p.*").where(F.col("value").isNotNull()).distinct())


def fit_dictionary(df: DataFrame, cols: list[str], pairs: DataFrame | None = None) -> DataFrame:
    """``(feature, value, rank, n)``: every value of wide columns with its 0-based place
    among the ``n`` sorted values of its column.  A stored table of any size, numbered by
    the distributed rank; nothing of it reaches the driver.  ``pairs``: as in
    ``fit_categories``."""
    values = category_values(df, cols) if pairs is None else pairs.where(F.col("feature").isin(*cols))
    ranked = stratified_rank(values, ["feature"], ["value"], order="key", rank_col="rank", size_col="n", stored=pairs is not None)
    return materialize(ranked.select("feature", "value", "rank", "n"))


def vector_name(col: str) -> str:
    return f"{col}_onehot"


def one_hot_sparse(df: DataFrame, dictionary: DataFrame, drop_first: bool = True) -> DataFrame:
    """Each column of ``dictionary`` replaced by a sparse vector ``<col>_onehot`` with one
    slot per value but the first (the base, as null and unseen values, is all zeros).

    One equi-join with the dictionary per column; the values are looked up where they are,
    so the encoding has no limit on categories (a column with one value has one slot that
    stays zero).  The vectors are written as their fields and not by ``OneHotEncoder``,
    which names every slot in the schema that the driver holds; the schema says how many
    slots there are."""
    first = 1 if drop_first else 0
    sizes = {r["feature"]: r["n"] for r in dictionary.groupBy("feature").agg(F.max("n").alias("n")).collect()}     # a row per column
    d = df
    for i, (c, n) in enumerate(sorted(sizes.items())):
        slots = max(1, n - first)
        if slots > 2 ** 31 - 1:
            raise ValueError(f"{c}: {n} categories exceed the slots of a vector")
        own = dictionary.where(F.col("feature") == c).select(F.col("value").alias(f"_v{i}"), F.col("rank").alias(f"_r{i}"))
        d = d.join(own, quoted(c).cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
    for i, (c, n) in enumerate(sorted(sizes.items())):
        slots = max(1, n - first)
        place = F.when(F.col(f"_r{i}") >= first, F.col(f"_r{i}") - first)
        d = d.withColumn(vector_name(c), _unit_vector(place, slots).alias(vector_name(c), metadata={"ml_attr": {"num_attrs": slots}}))
    return d.drop(*[f"_r{i}" for i in range(len(sizes))], *sizes)


def _unit_vector(place: Column, slots: int) -> Column:
    """A sparse vector of ``slots`` with a one at ``place``; all zeros where that is null."""
    fields = F.concat(F.lit(f'{{"v":{{"type":0,"size":{slots},"indices":['), F.coalesce(place.cast("string"), F.lit("")),
                      F.when(place.isNull(), F.lit('],"values":[]}}')).otherwise(F.lit('],"values":[1.0]}}')))
    return F.from_json(fields, T.StructType([T.StructField("v", VectorUDT())])).getField("v")


def dummy_name(col: str, value: str) -> str:
    return f"{col}_{value}"


def one_hot(df: DataFrame, categories: dict, drop_first: bool = True) -> DataFrame:
    """Boolean dummies ``col_value``; the first sorted category is the base; null -> all false.
    Encoded columns are removed and dummies appended after the remaining columns.  A dummy
    whose name is taken, letter case aside, gets the first free suffix ``_2``, ``_3``..."""
    rest = [c for c in df.columns if c not in categories]
    keep = [quoted(c) for c in rest]
    taken = {c.lower() for c in rest}
    dummies = []
    for c, vs in categories.items():
        for v in (vs[1:] if drop_first else vs):
            name, n = dummy_name(c, v), 1
            while name.lower() in taken:
                n += 1
                name = f"{dummy_name(c, v)}_{n}"
            taken.add(name.lower())
            dummies.append(F.coalesce(quoted(c).cast("string") == F.lit(v), F.lit(False)).alias(name))
    return df.select(*keep, *dummies)


# --- C11 / C12 ------------------------------------------------------------------------
def assemble(df: DataFrame, target: str, key: str | None = "row_key", out_target: str = "churn") -> DataFrame:
    """Key first, features in order, target last (renamed ``churn``)."""
    feats = [c for c in df.columns if c not in (target, key)]
    head = [quoted(key)] if key and key in df.columns else []
    return df.select(*head, *[quoted(c) for c in feats], quoted(target).alias(out_target))


def add_features(df: DataFrame, exprs: dict) -> DataFrame:
    """Derived features from a name -> expression (Column or SQL text) mapping."""
    return df.withColumns({k: (F.expr(v) if isinstance(v, str) else v) for k, v in exprs.items()}) if exprs else df


# --- fitted spec ----------------------------------------------------------------------
@dataclass
class EncodingSpec:
    target: str = "churn"
    key: str | None = "row_key"
    numeric_text: list = field(default_factory=list)
    medians: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    wide: list = field(default_factory=list)
    dictionary: str | None = None       # folder of the wide columns' values
    features: list = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "EncodingSpec":
        return cls(**json.loads(text))


def standardize_raw(df: DataFrame, target: str = "churn", strict_compat: bool = False,
                    key_as: str = "row_key") -> tuple[DataFrame, str]:
    """C2 -> C3 -> C4 -> C5 -> C6: the steps that need no fitting."""
    d = canonicalize(df)
    t = find_target(d, target)
    d = encode_label(d, t, strict_compat)
    d = drop_id_like(d, keep_as=key_as)
    d = trim_strings(d)
    return d, t


def fit_encoding(df: DataFrame, target: str, key: str | None = "row_key", ratio: float = 0.5,
                 exact_median: bool = True, max_categories: int = MAX_CATEGORIES, dictionary: str | None = None, known=()) -> EncodingSpec:
    """Fit C7, C9 and C10 on ``df`` (pass the train split to avoid leakage, or all rows
    for parity with the original order of steps).  Text columns with more than
    ``max_categories`` values are kept as a table in the folder ``dictionary`` (by default
    below the shared folder of the session) and encoded as sparse vectors.  Text columns
    ``known`` to hold numbers are numeric whatever share of their values parses.

    Fitting makes a few passes: give it a stored table (``session.materialize``)."""
    excl = tuple(c for c in (target, key) if c)
    num_text, counts = _profile(df, ratio, excl, known)
    d = coerce_numeric(df, columns=num_text)
    kinds = column_kinds(d, excl)
    medians = fit_medians(d, kinds["numeric"], exact_median, counts=counts)
    pairs = materialize(category_values(d, kinds["categorical"])) if kinds["categorical"] else None     # fitting reads them several times
    cats = fit_categories(d, kinds["categorical"], max_categories, pairs)
    wide = [c for c in kinds["categorical"] if c not in cats]
    if wide:
        dictionary = dictionary or shared_path(df.sparkSession, "dictionary", uuid.uuid4().hex)
        fit_dictionary(d, wide, pairs).write.mode("overwrite").parquet(dictionary)
    spec = EncodingSpec(target=target, key=key, numeric_text=num_text, medians=medians, categories=cats, wide=wide,
                        dictionary=dictionary if wide else None)
    spec.features = [c for c in apply_encoding(df, spec).columns if c not in (key, "churn")]
    return spec


def apply_encoding(df: DataFrame, spec: EncodingSpec) -> DataFrame:
    """Coerce -> impute -> one-hot -> assemble: a projection, and a lookup join for each
    wide column."""
    d = coerce_numeric(df, columns=spec.numeric_text)
    d = impute(d, spec.medians)
    d = one_hot(d, spec.categories)
    if spec.wide:
        d = one_hot_sparse(d, df.sparkSession.read.parquet(spec.dictionary))
    return assemble(d, spec.target, spec.key)


# --- C13 ------------------------------------------------------------------------------
def manifest(raw: DataFrame, spec: EncodingSpec, splits: DataFrame, seed: int, test_size: float,
             val_size: float, split_col: str = "split") -> DataFrame:
    """One-row dataset manifest: counts, feature list, split sizes, seed."""
    # every raw row lands in exactly one split, so one aggregate gives all counts
    counts = splits.groupBy().agg(F.count(F.lit(1)).alias("n_rows_raw"),
                                  *[F.count(F.when(F.col(split_col) == s, 1)).alias(s)
                                    for s in ("train", "valid", "test")])
    return (counts
            .select(F.col("n_rows_raw"),
                    F.lit(len(raw.columns)).alias("n_cols_raw"),
                    F.lit(len(spec.features)).alias("n_features"),
                    F.array(*[F.lit(f) for f in spec.features]).alias("features"),
                    F.struct("train", "valid", "test").alias("splits"),
                    F.lit("churn").alias("target"),
                    F.lit(seed).alias("seed"),
                    F.lit(float(test_size)).alias("test_size"),
                    F.lit(float(val_size)).alias("val_size")))


# --- C15 ------------------------------------------------------------------------------
def drop_labels(df: DataFrame, names=("churn",)) -> DataFrame:
    """Drop label columns before scoring, matching names case-insensitively."""
    low = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in low])


# --- C16 ------------------------------------------------------------------------------
def validate(df: DataFrame, rules: dict) -> DataFrame:
    """Attach ``violations``: the names of the rules (name -> boolean Column that must
    hold) a row breaks.  A rule that evaluates to null counts as broken."""
    checks = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    return df.withColumn("violations", F.filter(F.array(*checks), lambda x: x.isNotNull()))


def split_valid(df: DataFrame, rules: dict) -> tuple[DataFrame, DataFrame]:
    v = validate(df, rules)
    return v.where(F.size("violations") == 0).drop("violations"), v.where(F.size("violations") > 0)


def numeric_text_rule(col: str) -> Column:
    return F.trim(F.col(col)).rlike(NUMERIC_TEXT)
