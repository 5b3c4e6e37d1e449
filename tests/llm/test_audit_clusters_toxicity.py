"""Filter audit, centroid clustering and toxicity against brute force, on small made cases
and the smallest tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroid_clustering as cc
from tidemark.llm import filter_audit as fa
from tidemark.llm import toxicity as tox

WORD = re.compile("[^ \t\n\v\f\r]+")


# ---- filter audit ---------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, part string, bits int"
MANY = " ".join(f"w{i}" for i in range(150))


@pytest.fixture(scope="module")
def audit_cases(spark):
    rows = [(1, MANY, "en"), (2, MANY, "en"), (3, MANY, None), (4, None, "en"), (5, "", "fr"), (6, " \t\n", "fr"), (7, "SHOUT # it", ""),
            (8, "a " * 400, "en"), (9, MANY + " $", "de"), (9, MANY + " $", "de"), (9, "other under one id", "de"), (10, MANY + " $", "de"),
            (None, MANY, "en"), (None, "no id", "en"), (None, "no id", "en"), (11, "é" * 30 + " É", "fr"),
            (12, " ".join(f"x{i % 90_000}" for i in range(300_000)), "en"), (13, "A" * 10 + "b" * 90, "de")]
    docs = spark.createDataFrame([(i, t, p, None, "clash", 99) for i, t, p in rows], DOCS)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, None, 1), (4, 0, 1), (9, 1, 1), (None, 1, 1), (77, 1, 1), (13, 5, None)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    fails = collections.defaultdict(list)
    for i, t, part in docs:
        t = t or ""
        w = WORD.findall(t)
        f = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
             "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and first[t] < i}
        fails[part or ""].append(({x for x in f if f[x]}, i in good, i in bad))
    out = set()
    for part, own in fails.items():
        total = collections.Counter()
        rows = []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                total[x] += len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone), sum(x in d[0] for d in own) - len(gone),
                             sum(d[0] == {x} for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out |= {(*r, total[r[1][r[2] - 1]]) for r in rows}
    return out


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(docs, labels):
    got = fa.filter_audit(docs, labels)
    assert sorted(got.columns) == sorted(COLUMNS)
    rows = [tuple(r) for r in got.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    want = brute_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()],
                       [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert set(rows) == want


def test_filter_audit_cases(audit_cases):
    audited(*audit_cases)


def test_filter_audit_documents(spark, small_dir):
    audited(spark.read.parquet(f"{small_dir}/documents.parquet"), spark.read.parquet(f"{small_dir}/labels.parquet"))


def test_filter_audit_equal_hash_is_no_copy(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one", "en"), (2, "two", "en"), (3, "one", "en")], "doc_id long, text string, lang string")
    given = fa._given(docs, "doc_id", "text", "lang").withColumn("hash", F.lit(b"same"))
    got = fa.earlier_copies(given, given.drop("text")).collect()
    assert [r["doc_id"] for r in got] == [3]


def test_filter_audit_empty(audit_cases):
    docs, labels = audit_cases
    assert fa.filter_audit(docs.limit(0), labels).count() == 0
    assert fa.filter_audit(docs, labels.limit(0)).count() == 5 * 120 * 4      # de, en, fr and the empty part


def test_long_texts_piecewise(monkeypatch):
    texts = [" ".join(f"w{i % 37}" for i in range(500)).encode(), b"x" * 1000, b"", b"A# " * 300]
    want = [fa.failure_bits(t) for t in texts]
    monkeypatch.setattr(fa, "PIECE", 50)
    assert [fa.failure_bits(t) for t in texts] == want


# ---- centroid clustering --------------------------------------------------------------

def brute_lloyd(rows, k=8, rounds=10, dim=64):
    own = [(i, [math.floor(1024 * x) if abs(x) < 2 ** 40 else int(x) * 1024 for x in v]) for i, v in rows
           if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in own if i is not None)
    cents = [v for _, v in named[:k]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
        return min(range(len(d)), key=lambda j: (d[j], j)), min(d)

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in own:
            groups[nearest(v)[0]].append(v)
        cents = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if groups[c] else old for c, old in enumerate(cents)]
    at = [(i, *nearest(v)) for i, v in own]
    inertia = collections.Counter()
    for _, c, d in at:
        inertia[c] += d
    fit = lambda x: x if x < 2 ** 63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(i), c, fit(d), fit(inertia[c]), fit(sum(inertia.values())), sha[c]) for i, c, d in at)


def clustered(table):
    got = cc.lloyd(table)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]
    return sorted((str(r[0]), *r[1:]) for r in got.collect())


def test_lloyd_embeddings(spark, small_dir):
    table = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]
    assert clustered(table) == brute_lloyd(rows)


@pytest.mark.parametrize("big", [1.0, 3e6, 1e30])
def test_lloyd_cases(spark, big):
    """Nulls, wrong sizes, non-finite components, ties, repeated rows and ids, sums beyond 64 bits."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, 64) * 0.25 * big]) for i in range(60)]
    rows += [rows[3], rows[3], (5, [0.5] * 64), (100, None), (101, [1.0] * 63), (102, [None] + [1.0] * 63),
             (103, [float("nan")] * 64), (104, [float("inf")] * 64), (None, [0.25] * 64), (105, [])]
    table = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, inertia int")
    assert clustered(table.repartition(5)) == brute_lloyd(rows)


def test_lloyd_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert clustered(spark.createDataFrame(rows, schema)) == brute_lloyd(rows)
    assert clustered(spark.createDataFrame([(1, [1.0])], schema)) == []
    assert [tuple(r) for r in cc.lloyd(spark.createDataFrame([(None, [1.0] * 64)], schema)).collect()] == [(None,) * 6]


def test_shards_agree(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=10)]) for i in range(80)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute_lloyd(rows, k=5, rounds=4, dim=10)
    for shards in (1, 3, 64):
        got = cc.lloyd(table, dim=10, k=5, rounds=4, shards=shards)
        assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want


# ---- toxicity -------------------------------------------------------------------------

def test_words_of_long_texts(monkeypatch):
    text = "Réeux é1a b_c, Été " * 50 + "x" * 500 + " end"
    want = tox.words_of(text)
    assert want == {"réeux": 50, "é": 50, "a": 50, "b": 50, "c": 50, "été": 50, "x" * 500: 1, "end": 1}
    monkeypatch.setattr(tox, "PIECE", 20)
    assert tox.words_of(text) == want
    assert tox.words_of(None) == tox.words_of("") == tox.words_of("12 _ 3") == {}


def test_vote_counts_and_mining_by_brute_force(spark):
    texts = [(f"nasty{'abcdefg'[i % 7]} clownish word{i % 5} some filler", 1) for i in range(40)] + [(f"word{i % 5} some filler text{i % 3}", 0) for i in range(60)]
    train = spark.createDataFrame(texts, "text string, toxic int")
    features, entries = tox.mine(train, 40, 60)
    have = {f: ([sum(f in {x for w in tox.words_of(t) for x in tox.features_of(w)} for t, y in texts if y == k) for k in (1, 0)]) for f in
            {x for t, _ in texts for w in tox.words_of(t) for x in tox.features_of(w)}}

    def root(t, c):
        g = sum(x * math.log(x / ((t + c) * p)) for x, p in ((t, 0.4), (c, 0.6)) if x)
        return math.sqrt(max(0, 2 * g)) * (1 if t * 60 >= c * 40 else -1)

    assert set(features) == {f for f, (t, c) in have.items() if t + c >= 3 and abs(root(t, c)) >= tox.MIN_ROOT}
    assert set(entries) == {f for f, (t, c) in have.items() if t + c >= 3 and root(t, c) >= tox.VOTER_ROOT and t / 40 >= tox.LIFT * c / 60}
    assert {"clownish", "nasty*"} <= set(entries) and "filler" not in entries
    got = {bytes(r["votes"]): r["n"] for r in tox.vote_counts(train, entries).collect()}
    want = collections.Counter()
    for t, y in texts:
        v = tox.votes_of(tox.words_of(t), entries, tox.Lookup(entries))
        v[tox.GOLD] = tox.TOXIC if y else tox.CLEAN
        want[bytes(v)] += 1
    assert got == want


def test_label_model_recovers_accuracies_and_correlations(spark):
    """Made votes: voter 1 copies voter 0 mostly, the others are independent given the label."""
    rng = np.random.default_rng(8)
    n, width = 6000, len(tox.VOTERS) + 1
    y = rng.random(n) < 0.3
    votes = np.full((n, width), tox.NONE)
    right = [0.9, None, 0.8, 0.85, 0.75]
    for v, p in enumerate(right):
        if p is not None:
            votes[:, v] = np.where((rng.random(n) < p) == y, tox.TOXIC, tox.CLEAN)
    votes[:, 1] = np.where(rng.random(n) < 0.9, votes[:, 0], rng.integers(0, 2, n) * 2)
    known = votes[:300].copy()
    known[:, tox.GOLD] = np.where(y[:300], tox.TOXIC, tox.CLEAN)

    def counts(m):
        c = collections.Counter(bytes(r) for r in m.astype(np.uint8))
        return spark.createDataFrame([(bytearray(k), x) for k, x in c.items()], "votes binary, n long")

    model = tox.fit_label_model(counts(votes), counts(known), 0.5)
    assert any({0, 1} <= set(b) for b in model.blocks)
    assert abs(model.balance - y.mean()) < 0.05
    for v in (0, 2, 3, 4):
        on_toxic, on_clean = model.accuracy(v)
        seen = votes[:, v]
        assert abs(on_toxic - (seen[y] == tox.TOXIC).mean()) < 0.06 and abs(on_clean - (seen[~y] == tox.CLEAN).mean()) < 0.06
    p = model.posterior(votes)
    assert ((p >= 0.5) == y).mean() > 0.9
    # the batch sums are the brute-force expected counts
    got = tox._sums(counts(votes), model)
    assert np.allclose(got[:2], [(1 - p).sum(), p.sum()])


def crc_mod5(i):
    return zlib.crc32(str(i).encode()) % 5


def test_toxicity_held_out(spark):
    """Held-out documents are told apart; labels of held-out rows change no score."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r for r in tox.score_toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert all(got[i]["held_out"] == (crc_mod5(i) == 0) and 0 <= got[i]["score"] <= 1 and got[i]["predicted"] == int(got[i]["score"] >= 0.5) for i in got)
    held = [(truth[i], got[i]["predicted"]) for i in truth if crc_mod5(i) == 0]
    caught = sum(p for t, p in held if t == 1) / sum(t for t, _ in held)
    wrong = sum(p for t, p in held if t == 0) / sum(t == 0 for t, _ in held)
    # about one toxic label in twenty stands on a text without any telling word
    assert caught >= 0.92 and wrong <= 0.005, (caught, wrong)


def test_toxicity_cases(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", F.lit("clash").alias("score"), F.lit(1).alias("toxic"))
    odd = spark.createDataFrame([(None, "no id"), (900_001, None), (900_002, ""), (900_003, "12 34"), (900_004, "word " * 300_000),
                                 (900_005, "same"), (900_005, "same")], "doc_id long, text string").select(
        "doc_id", "text", F.lit("clash").alias("score"), F.lit(1).alias("toxic"))
    labels = spark.read.parquet(f"{small_dir}/labels.parquet").select("doc_id", "toxic")
    more = spark.createDataFrame([(None, 1), (900_001, 7), (900_002, None), (4_000_000, 1)], "doc_id long, toxic int")
    got = tox.score_toxicity(docs.union(odd), labels.union(more)).collect()
    assert len(got) == docs.count() + 7
    odd_scores = {r["doc_id"]: r for r in got if r["doc_id"] is None or r["doc_id"] > 900_000}
    assert odd_scores[None]["held_out"] is False
    assert odd_scores[900_001]["score"] == odd_scores[900_002]["score"] == odd_scores[900_003]["score"]
    held = {r["doc_id"]: r["score"] for r in got}
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in tox.score_toxicity(docs.union(odd), flipped.union(more)).collect()}
    assert again == held


def test_toxicity_without_classes(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    assert {tuple(r) for r in tox.score_toxicity(docs, labels.limit(0)).select("score", "predicted").collect()} == {(0.0, 0)}
    assert {tuple(r) for r in tox.score_toxicity(docs, labels.where("toxic = 0")).select("score", "predicted").collect()} == {(0.0, 0)}
    assert {tuple(r) for r in tox.score_toxicity(docs, labels.where("toxic = 1")).select("score", "predicted").collect()} == {(1.0, 1)}
    assert tox.score_toxicity(docs.limit(0), labels).count() == 0
