"""Cleaning operators on hand-built edge cases (FIXTURES.md)."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean
from tidemark.sources import files


def test_canonical_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["  Monthly  Charges ", "Payment-Method", "a/b"])
    assert clean.canonicalize(df).columns == ["monthly_charges", "payment_method", "a_b"]
    with pytest.raises(ValueError):
        clean.canonicalize(spark.createDataFrame([(1, 2)], ["A b", "a_b"]))


def test_find_target_case_insensitive(spark):
    df = spark.createDataFrame([(1,)], ["Churn"])
    assert clean.find_target(df, "churn") == "Churn"
    with pytest.raises(ValueError):
        clean.find_target(spark.createDataFrame([(1,)], ["x"]), "churn")


def test_encode_label_variants(spark):
    df = spark.createDataFrame([(" Yes ",), ("no",), ("maybe",), (None,), ("1",), ("2.7",)], ["y"])
    got = [r.y for r in clean.encode_label(df, "y").collect()]
    assert got == [1, 0, 0, 0, 1, 2]
    strict = [r.y for r in clean.encode_label(df, "y", strict_compat=True).collect()]
    assert strict == [1, 0, 0, 0, 0, 0]
    nums = spark.createDataFrame([(1.9,), (None,), (0.0,)], ["y"])
    assert [r.y for r in clean.encode_label(nums, "y").collect()] == [1, 0, 0]


def test_drop_id_like_keeps_first_as_key(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["customerid", "order_id", "id", "tenure"])
    out = clean.drop_id_like(df)
    assert out.columns == ["row_key", "tenure"]


def test_numeric_coercion_ratio(spark):
    rows = [("1", "1", " ", "1d", "inf", "a"), ("2", "x", " ", "2", "nan", "b"),
            ("x", None, None, "3", "1e3", None), ("y", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "half string, below string, blank string, d string, special string, text string")
    # half: 2 of 4 parse (exactly 50 %); below: 1 of 2; blank: none; d: '1d' does not parse
    cols = clean.numeric_text_columns(df)
    assert set(cols) == {"half", "below", "d", "special"}
    out = clean.coerce_numeric(df).collect()
    assert [r.d for r in out] == [None, 2.0, 3.0, None]
    assert out[0].special == math.inf and out[1].special is None and out[2].special == 1000.0


def test_median_imputation_exact_and_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, None), (10.0, None), (float("nan"), None)],
                               "a double, b double")
    meds = clean.fit_medians(df, ["a", "b"])
    assert meds == {"a": 2.0, "b": None}
    out = clean.impute(df, meds).collect()
    assert [r.a for r in out] == [1.0, 2.0, 2.0, 10.0, 2.0]
    assert all(r.b is None for r in out)


def test_one_hot_drop_first_null_and_single_category(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x"), ("c d", "x")], "k string, one string")
    cats = clean.fit_categories(df, ["k", "one"])
    assert cats == {"k": ["a", "b", "c d"], "one": ["x"]}
    out = clean.one_hot(df, cats)
    assert out.columns == ["k_b", "k_c d"]          # single category: no dummy
    assert [tuple(r) for r in out.collect()] == [(True, False), (False, False), (False, False), (False, True)]


def test_drop_labels_case_insensitive(spark):
    df = spark.createDataFrame([(1, 0)], ["x", "churn"])
    assert clean.drop_labels(df, ["Churn"]).columns == ["x"]


def test_validate_splits_good_and_bad(spark):
    df = spark.createDataFrame([("1.5", 3), ("abc", 2), (None, -1)], "t string, n int")
    rules = {"numeric": clean.numeric_text_rule("t"), "positive": F.col("n") >= 0}
    good, bad = clean.split_valid(df, rules)
    assert good.count() == 1
    assert sorted(r.violations for r in bad.collect()) == [["numeric"], ["numeric", "positive"]]


def test_encoding_spec_roundtrip(spark):
    df = spark.createDataFrame([(1, "1.0", "a", 1), (2, " ", "b", 0), (3, "3.0", None, 1)],
                               "row_key long, x string, c string, churn int")
    spec = clean.fit_encoding(df, "churn")
    again = clean.EncodingSpec.from_json(spec.to_json())
    assert again == spec
    out = clean.apply_encoding(df, again)
    assert out.columns == ["row_key", "x", "c_b", "churn"]
    assert [r.x for r in out.collect()] == [1.0, 2.0, 3.0]


def test_profile_counts_feed_exact_medians(spark):
    """Medians fitted with the counts of the profiling pass equal those of a separate
    counting job (numeric text with blanks and junk, NaN, an all-null column)."""
    from tidemark.operators import clean as C
    rows = [("1.5", 2.0, None, "a"), (" 3 ", float("nan"), None, "b"), ("x", 4.0, None, None),
            ("", 1.0, None, "a"), ("7", 9.0, None, "c"), ("2", None, None, "b")]
    df = spark.createDataFrame(rows, "t string, v double, z double, cat string")
    text, counts = C._profile(df)
    assert text == ["t"]
    d = C.coerce_numeric(df, columns=text)
    cols = ["t", "v", "z"]
    assert C.fit_medians(d, cols, counts=counts) == C.fit_medians(d, cols) == {"t": 2.5, "v": 3.0, "z": None}


def test_one_hot_dotted_and_case_colliding_categories(spark):
    df = spark.createDataFrame([(1, "St. Louis", "No"), (2, "A.B", "Yes"), (3, None, "yes")], "row_key int, `ci.ty` string, k string")
    out = clean.one_hot(df, clean.fit_categories(df, ["ci.ty", "k"]), drop_first=False)
    assert out.columns == ["row_key", "ci.ty_A.B", "ci.ty_St. Louis", "k_No", "k_Yes", "k_yes_2"]
    got = {r[0]: tuple(r)[1:] for r in clean.assemble(out.withColumn("y", F.lit(1)), "y").drop("churn").collect()}
    assert got == {1: (False, True, True, False, False), 2: (True, False, False, True, False), 3: (False, False, False, False, True)}


def test_csv_doubled_quotes_line_breaks_and_booleans(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n"x ""q"" y",True,1\n"two\nlines",False,TRUE\nz,,2\n')
    d = clean.restore_booleans(files.read_table(spark, str(tmp_path / "a.csv")))
    assert dict(d.dtypes) == {"a": "string", "b": "boolean", "c": "string"}
    assert {(r.a, r.b) for r in d.collect()} == {('x "q" y', True), ("two\nlines", False), ("z", None)}


def test_csv_sink_doubles_quotes(spark, tmp_path):
    rows = {(1, 'say "hi", ok'), (2, "back\\slash"), (3, "plain")}
    path = str(tmp_path / "out")
    files.write_table(spark.createDataFrame(sorted(rows), "k int, t string"), path, fmt="csv")
    assert {(int(r.k), r.t) for r in files.read_table(spark, path).collect()} == rows


def test_csv_breaks_in_cells_by_several_tasks(spark, tmp_path):
    """A file of many blocks with line breaks, quotes and blank lines in cells reads as the
    whole-file reader does, in several tasks; cells and records cross blocks."""
    import csv
    import random
    rnd = random.Random(9)
    cells = ["plain", "two\nlines", 'say "hi"', '"', "a\n\nb", "", "comma, here", 'x"\n"y', "  pad ", "é\nß", "line\n" * 40]
    rows = [[i, rnd.choice(cells), rnd.choice(cells)] for i in range(1500)]
    for name in ("one.csv", "two.csv"):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator="\n")
            w.writerow(["k", 'the "text"', "more\ntext"])
            w.writerows(rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(str(tmp_path / "one.csv")).rdd.getNumPartitions() > 5
        got = files.read_table(spark, str(tmp_path))
        assert got.columns == ["k", 'the "text"', "more\ntext"]
        records = files.quoted_records(spark, str(tmp_path / "one.csv"))
        assert records.select("block").distinct().count() > 5 and records.count() == 1501
        found = sorted((int(r[0]), r[1], r[2]) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = sorted((i, a or None, b or None) for i, a, b in rows for _ in range(2))
    assert [tuple(map(str, r)) for r in found] == [tuple(map(str, r)) for r in want]
    whole = spark.read.options(header=True, multiLine=True, **files.CSV_OPTIONS).csv(str(tmp_path / "one.csv"))
    assert sorted(str(tuple(r)) for r in whole.collect()) == sorted(str((str(i), a or None, b or None)) for i, a, b in rows)


def test_csv_windows_line_ends_and_open_quote(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes('\ufeffa,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n'.encode())
    got = sorted((r["a"], r["b"].replace("\r", "")) for r in files.read_table(spark, str(tmp_path / "w.csv")).collect())
    assert got == [("1", "x\ny"), ("2", "z")]
    (tmp_path / "o.csv").write_text('a,b\n1,ok\n2,"never closed\n3,in it\n')
    rows = files.read_table(spark, str(tmp_path / "o.csv")).collect()
    assert len(rows) == 2 and (rows[0]["a"], rows[0]["b"]) in (("1", "ok"), ("2", rows[0]["b"]))


def test_json_documents_by_name(spark, tmp_path):
    docs = spark.createDataFrame([("m_a.json", '{"f1": 1}'), ("m_b.json", "bad"), ("x.json", "{}")], "file string, doc string")
    path = str(tmp_path / "docs")
    files.write_json_documents(docs, path)
    files.write_json_documents(docs.where("file = 'x.json'").withColumn("doc", F.lit('{"again": 2}')), path)
    got = {(r["file_name"], r["stem"], r["doc"].strip()) for r in files.read_json_documents(spark, path, "m_*.json").collect()}
    assert got == {("m_a.json", "m_a", '{"f1": 1}'), ("m_b.json", "m_b", "bad")}
    assert {r["doc"].strip() for r in files.read_json_documents(spark, path, "x.json").collect()} == {'{"again": 2}'}
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "t.json").write_text('{\n"best": 0.4}')
    (tmp_path / "plain" / "t.txt").write_text("no")
    got = files.read_json_documents(spark, str(tmp_path / "plain"), "*.json").collect()
    assert [(r["file_name"], r["stem"], r["doc"]) for r in got] == [("t.json", "t", '{\n"best": 0.4}')]


def test_canonical_names_resolve_collisions():
    assert clean.canonical_names(["A b", "a_b", "a-b", "A_B_2"], resolve=True) == ["a_b", "a_b_3", "a_b_4", "a_b_2"]


def test_wide_categories_as_sparse_vectors(spark):
    """A column of 100,000 values, nulls, a value not seen in fitting: one slot per value
    but the first, found by a join, with no limit on their number."""
    n = 100_000
    df = spark.range(n + 3).select(F.col("id").alias("row_key"), (F.col("id") % 2).cast("int").alias("churn"), F.lit("x").alias("one"),
                                   F.when(F.col("id") < n, F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0"))).alias("big"),
                                   F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("small"))
    spec = clean.fit_encoding(df, "churn")
    assert spec.wide == ["big"] and set(spec.categories) == {"one", "small"}
    spec = clean.EncodingSpec.from_json(spec.to_json())
    rows = spark.createDataFrame([(1, 0, "x", "v000000", "c1"), (2, 1, "x", "v000001", "c2"), (3, 1, None, "v099999", None), (4, 0, "x", None, "c1"),
                                  (5, 0, "x", "unseen", "c9")], "row_key long, churn int, one string, big string, small string")
    out = clean.apply_encoding(rows, spec)
    assert out.columns == ["row_key", "small_c2", "big_onehot", "churn"]
    got = {r["row_key"]: (r["small_c2"], r["big_onehot"].size, list(r["big_onehot"].indices)) for r in out.collect()}
    assert got == {1: (False, n - 1, []), 2: (True, n - 1, [0]), 3: (False, n - 1, [n - 2]), 4: (False, n - 1, []), 5: (False, n - 1, [])}


def test_category_discovery_around_the_bound(spark):
    df = spark.createDataFrame([(str(i), "a" if i % 2 else "b", None) for i in range(12)], "w string, n string, z string")
    assert clean.fit_categories(df, ["w", "n", "z"], max_categories=12)["w"] == sorted(str(i) for i in range(12))
    assert clean.fit_categories(df, ["w", "n", "z"], max_categories=4) == {"n": ["a", "b"], "z": []}
    assert clean.fit_categories(df, ["w"], max_categories=11) == {}


def test_the_schema_of_a_sparse_vector_names_no_slots(spark):
    """The driver holds the schema: it must not grow with the categories."""
    d = spark.range(3_000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("big"))
    out = clean.one_hot_sparse(d, clean.fit_dictionary(d, ["big"]))
    assert out.schema["big_onehot"].metadata == {"ml_attr": {"num_attrs": 2_999}}
    assert out.where(F.col("big_onehot").cast("string") == "(2999,[0],[1.0])").count() == 1


def test_known_numbers_stay_numeric_when_mostly_blank(spark):
    df = spark.createDataFrame([(1, 0, " "), (2, 1, " "), (3, 0, "7.5")], "row_key long, churn int, total_charges string")
    assert clean.numeric_text_columns(df, exclude=("row_key", "churn")) == []
    out = clean.apply_encoding(df, clean.fit_encoding(df, "churn", known=["total_charges"]))
    assert sorted((r.row_key, r.total_charges) for r in out.collect()) == [(1, 7.5), (2, 7.5), (3, 7.5)]
    blank = df.where("row_key < 3")
    assert {r.total_charges for r in clean.coerce_numeric(blank, exclude=("churn",), known=["total_charges"]).collect()} == {None}
