"""Toxicity by weak supervision.

Lexicon voters (lists of whole words) and pattern voters (word beginnings) are mined from
a bounded sample of labelled documents; further voters judge density and silence.  A
generative label model then explains the votes of all documents that may be learned from:
voters are independent given the unknown label except inside small blocks of correlated
voters, whose joint vote tables (accuracies and correlations) and class balance come from
expectation-maximisation.  Labels known in the sample take part as one more voter, whose
accuracy is estimated too.  Its posterior labels train a linear classifier over the mined
words and word beginnings and the share of them in a text, and the classifier alone
scores texts.

Votes are counted where the texts are: a vote vector with its count is all that travels,
and each round of the estimation is one aggregate over the distinct vectors.
"""

from __future__ import annotations

import dataclasses
import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

#: Labelled documents of each class in the training sample, at most.
TRAIN_DOCS = 10_000
#: Words and beginnings in the classifier, at most, and in each kind of voter.
FEATURES, VOCABULARY = 4_000, 1_000
#: Least signed root of the likelihood ratio of a classifier feature and of a voter's entry,
#: and how many times more frequent a voter's entry is in toxic documents.
MIN_ROOT, VOTER_ROOT, LIFT = 3.5, 4.0, 3.0
LENGTHS = (4, 5, 6, 7, 8)       # letters of a beginning
LEXICONS = 6
#: Shares of a text's words that are entries: fewer is sparse (clean), as many is dense.
SPARSE, SOME, DENSE = 1 / 256, 1 / 128, 1 / 64
SHARES = 10                     # the classifier sees the share in powers of two, to 2^-10
TRUST = 0.95                    # accuracy expected of the known labels
BLOCK, CORRELATED = 3, 0.1      # voters in a block at most, least residual correlation
ROUNDS = 10
REGULARISATION = 1e-4
#: Characters whose words are split at once; different words remembered by a worker.
PIECE, MEMO = 1_000_000, 200_000

WORD = re.compile(r"[^\W\d_]+")
GAP = re.compile(r"[\W\d_]")

CLEAN, NONE, TOXIC = 0, 1, 2     # votes
VOTERS = [*(f"lexicon {i}" for i in range(LEXICONS)), *(f"beginnings of {n}" for n in LENGTHS),
          "three entries", "dense", "no word", "no beginning"]
GOLD = len(VOTERS)              # the known label's column


def words_of(text: str | None) -> Counter:
    """The lower-cased words (runs of letters) of a whole text, with their number."""
    text = text or ""
    found: Counter = Counter()
    lo = 0
    while len(text) - lo > PIECE:
        gap = GAP.search(text, lo + PIECE)
        if gap is None:
            break
        found.update(WORD.findall(text[lo:gap.start()].lower()))
        lo = gap.start()
    found.update(WORD.findall((text[lo:] if lo else text).lower()))
    return found


def features_of(word: str) -> list[str]:
    """A word and its proper beginnings; those end in ``*``."""
    return [word, *(word[:n] + "*" for n in LENGTHS if len(word) > n)]


class Lookup:
    """Entries of a dictionary found through words, remembered for words met again."""

    def __init__(self, entries):
        self.entries, self.memo = entries, {}

    def of(self, word: str) -> tuple[str, ...]:
        hit = self.memo.get(word)
        if hit is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            hit = self.memo[word] = tuple(f for f in features_of(word) if f in self.entries)
        return hit

    def __call__(self, words) -> tuple[set[str], list[str]]:
        """The entries that words have, and the words that have any."""
        out: set[str] = set()
        having = []
        for w in words:
            hit = self.memo.get(w)
            if hit is None:
                hit = self.of(w)
            if hit:
                out.update(hit)
                having.append(w)
        return out, having


def share_of(words: Counter, having: list[str]) -> float:
    """Share of a text's words that have an entry."""
    return sum(words[w] for w in having) / words.total() if having else 0.0


# ---- mining ---------------------------------------------------------------------------

def _count(it):
    """Documents with each feature, by label; partial counts of a batch."""
    for batch in it:
        counts = Counter(), Counter()
        toxic = batch.column("toxic").to_pylist()
        for text, y in zip(batch.column("text"), toxic):
            counts[y].update({f for w in words_of(text.as_py()) for f in features_of(w)})
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[1][f] for f in names], pa.int64()),
                                          pa.array([counts[0][f] for f in names], pa.int64())], names=["feature", "t", "c"])


def signed_root(n_toxic: int, n_clean: int):
    """Column: square root of the likelihood ratio that ``t`` and ``c`` follow the class
    sizes; negative where the feature is rarer in toxic documents."""
    rate = n_toxic / (n_toxic + n_clean)
    part = lambda x, p: F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / ((F.col("t") + F.col("c")) * p))).otherwise(0.0)
    root = F.sqrt(F.greatest(F.lit(0.0), 2 * (part("t", rate) + part("c", 1 - rate))))
    return F.when(F.col("t") * n_clean >= F.col("c") * n_toxic, root).otherwise(-root)


def mine(train: DataFrame, n_toxic: int, n_clean: int) -> tuple[list[str], dict[str, int]]:
    """The classifier's features, and the voter of each voting entry.

    Whole words are dealt over the lexicons by their rank; beginnings vote by length.
    """
    counts = train.mapInArrow(_count, "feature string, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    counts = stored(counts.where("t + c >= 3").withColumn("root", signed_root(n_toxic, n_clean)).where(F.abs("root") >= MIN_ROOT), "features")
    order = [F.abs("root").desc(), F.col("feature")]
    features = [r[0] for r in counts.orderBy(*order).limit(FEATURES).select("feature").collect()]
    rare = (F.col("t") / n_toxic >= LIFT * F.col("c") / n_clean) & (F.col("root") >= VOTER_ROOT)
    start = F.col("feature").endswith("*")
    entries: dict[str, int] = {}
    words = counts.where(rare & ~start).orderBy(*order).limit(VOCABULARY).collect()
    entries.update({r["feature"]: i % LEXICONS for i, r in enumerate(words)})
    for r in counts.where(rare & start).orderBy(*order).limit(VOCABULARY).collect():
        entries[r["feature"]] = LEXICONS + LENGTHS.index(len(r["feature"]) - 1)
    return features, entries


# ---- votes ----------------------------------------------------------------------------

def votes_of(words: Counter, entries: dict[str, int], look: Lookup) -> list[int]:
    """Every voter's vote on a text's words; the known label abstains.

    A list votes toxic when a word has one of its entries and words with entries are no
    accident (``SOME``); beside it voters count and weigh all entries and note silence."""
    votes = [NONE] * (len(VOTERS) + 1)
    hits, having = look(words)
    share = share_of(words, having)
    lists = {entries[f] for f in hits}
    if share >= SOME:
        for voter in lists:
            votes[voter] = TOXIC
    three, dense, no_word, no_beginning = range(LEXICONS + len(LENGTHS), len(VOTERS))
    if len(having) >= 3:
        votes[three] = TOXIC
    if words:
        votes[dense] = TOXIC if share >= DENSE else CLEAN if share < SPARSE else NONE
    if not any(v < LEXICONS for v in lists):
        votes[no_word] = CLEAN
    if not any(v >= LEXICONS for v in lists):
        votes[no_beginning] = CLEAN
    return votes


def _vote(entries):
    """Distinct vote vectors of a batch with their number; ``toxic`` is the known label."""
    def run(it):
        look = Lookup(entries)
        for batch in it:
            found: Counter = Counter()
            for text, y in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                votes = votes_of(words_of(text.as_py()), entries, look)
                votes[GOLD] = NONE if y is None else TOXIC if y else CLEAN
                found[bytes(votes)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                                             names=["votes", "n"])
    return run


def vote_counts(rows: DataFrame, entries: dict[str, int]) -> DataFrame:
    """``rows(text, toxic)`` -> ``(votes binary, n)``, one row per distinct vote vector."""
    return rows.mapInArrow(_vote(entries), "votes binary, n long").groupBy("votes").agg(F.sum("n").alias("n"))


# ---- label model ----------------------------------------------------------------------

@dataclasses.dataclass
class LabelModel:
    """Class balance and, per block of voters, the joint vote table of each class."""

    balance: float
    blocks: list[tuple[int, ...]]
    tables: list[np.ndarray]        # (2, 3 ** voters of the block)

    def states(self, votes: np.ndarray) -> list[np.ndarray]:
        return [votes[:, list(b)].astype(np.int64) @ (3 ** np.arange(len(b))) for b in self.blocks]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of toxic for every row of votes."""
        odds = np.full(len(votes), math.log(self.balance) - math.log1p(-self.balance))
        for table, state in zip(self.tables, self.states(votes)):
            odds += np.log(table[1][state]) - np.log(table[0][state])
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))

    def accuracy(self, voter: int) -> tuple[float, float]:
        """Shares of right votes among a voter's votes on toxic and on clean documents."""
        for block, table in zip(self.blocks, self.tables):
            if voter in block:
                digit = np.arange(table.shape[1]) // 3 ** block.index(voter) % 3
                said = np.array([[row[digit == v].sum() for v in (CLEAN, TOXIC)] for row in table])
                return said[1, 1] / said[1].sum(), said[0, 0] / said[0].sum()
        raise KeyError(voter)


def _votes_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.uint8).reshape(len(column), -1)


def _expect(model: LabelModel, moments: bool):
    """Expected counts of a batch: the classes among rows without a known label, each
    block's table, and on request first and second moments of the votes by class."""
    def run(it):
        for batch in it:
            if not batch.num_rows:
                continue
            votes, n = _votes_matrix(batch.column("votes")), batch.column("n").to_numpy().astype(float)
            p = model.posterior(votes)
            both = np.stack([n * (1 - p), n * p])
            out = [both[:, votes[:, GOLD] == NONE].sum(1)]
            for table, state in zip(model.tables, model.states(votes)):
                out += [np.bincount(state, weights=w, minlength=table.shape[1]) for w in both]
            if moments:
                a = votes.astype(float) - NONE
                for w in both:
                    out += [np.array([w.sum()]), w @ a, ((a * w[:, None]).T @ a).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(out)], pa.list_(pa.float64()))], names=["sums"])
    return run


def _sums(counts: DataFrame, model: LabelModel, moments: bool = False) -> np.ndarray:
    rows = counts.mapInArrow(_expect(model, moments), "sums array<double>").select(F.posexplode("sums").alias("i", "x"))
    return np.array([r[1] for r in sorted(rows.groupBy("i").agg(F.sum("x")).collect())])


def _updated(model: LabelModel, sums: np.ndarray, prior: np.ndarray) -> LabelModel:
    """New balance and tables from expected counts, smoothed by one half a state; ``prior``
    counts stand behind the known label's table."""
    known = sums[:2].sum()
    balance = float(np.clip(sums[1] / known, 1e-4, 1 - 1e-4)) if known else model.balance
    tables, at = [], 2
    for block, table in zip(model.blocks, model.tables):
        size = table.shape[1]
        own = sums[at:at + 2 * size].reshape(2, size) + (prior if block == (GOLD,) else 0.5)
        tables.append(own / own.sum(1, keepdims=True))
        at += 2 * size
    return LabelModel(balance, model.blocks, tables)


def correlated_blocks(sums: np.ndarray, width: int) -> list[tuple[int, ...]]:
    """Voters joined by residual correlation (what the label leaves unexplained), strongest
    pairs first; the known label stays alone."""
    size = 1 + width + width * width
    cov, weight = np.zeros((width, width)), 0.0
    for y in range(2):
        part = sums[len(sums) - (2 - y) * size:][:size]
        mean = part[1:1 + width] / max(part[0], 1e-9)
        cov += part[1 + width:].reshape(width, width) - part[0] * np.outer(mean, mean)
        weight += part[0]
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9 * max(weight, 1.0)))
    corr = np.abs(cov / np.outer(sd, sd))
    block = {i: (i,) for i in range(width)}
    for i, j in sorted(itertools.combinations([v for v in range(width) if v != GOLD], 2), key=lambda p: (-corr[p], p)):
        if corr[i, j] >= CORRELATED and block[i] != block[j] and len(block[i]) + len(block[j]) <= BLOCK:
            merged = tuple(sorted(block[i] + block[j]))
            block.update({v: merged for v in merged})
    return sorted(set(block.values()))


def fit_label_model(counts: DataFrame, known: DataFrame, share: float) -> LabelModel:
    """Blocks of voters from what the known labels leave unexplained in ``known``, then
    expectation-maximisation over ``counts`` (known label abstains) and ``known`` (it
    votes).  ``share`` is the first class balance."""
    width = len(VOTERS) + 1
    trusted = np.array([[TRUST, 0.0, 1 - TRUST], [1 - TRUST, 0.0, TRUST]]) * 0.98 + 0.02 / 3
    flat = lambda blocks: [trusted if b == (GOLD,) else np.full((2, 3 ** len(b)), 3.0 ** -len(b)) for b in blocks]
    single = [(i,) for i in range(width)]
    sums = _sums(known, LabelModel(0.5, single, flat(single)), moments=True)
    blocks = correlated_blocks(sums, width)
    # the known labels give the first tables and weigh on their own voter's
    model = LabelModel(0.5, blocks, flat(blocks))
    first = _sums(known, model)
    prior = trusted * sums[2:2 + 6].sum()
    model = _updated(model, first, prior)
    model.balance = share
    both = counts.unionByName(known)
    for _ in range(ROUNDS):
        model = _updated(model, _sums(both, model), prior)
    return model


# ---- classifier -----------------------------------------------------------------------

@dataclasses.dataclass
class Classifier:
    """Weights of words and beginnings; ``label_model`` and ``entries`` tell what taught it."""

    intercept: float
    weights: dict[str, float]
    label_model: LabelModel | None = None
    entries: dict[str, int] = dataclasses.field(default_factory=dict)

    def score(self, words: Counter, look: Lookup) -> float:
        odds = self.intercept + math.fsum(self.weights.get(f, 0.0) for f in classified(words, look, self.entries))
        return round(1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, odds)))), 6)


def shares() -> list[str]:
    """Names of the classifier's features on the share of entries; no word looks so."""
    return [f"#{k}" for k in range(1, SHARES + 1)]


def classified(words: Counter, look: Lookup, entries: dict[str, int]) -> list[str]:
    """The classifier's features of a text: words and beginnings, and each power of two
    that the share of words with an entry reaches.  ``look`` knows features and entries."""
    hits, having = look(words)
    share = share_of(words, [w for w in having if any(f in entries for f in look.of(w))])
    return [*hits, *(f"#{k}" for k in range(1, SHARES + 1) if share >= 2.0 ** -k)]


def _posterior(model: LabelModel, entries: dict[str, int], features: list[str]):
    """Posterior label and classifier features of training rows."""
    def run(it):
        look, chosen = Lookup(entries), Lookup(set(features) | set(entries))
        for batch in it:
            words = [words_of(x.as_py()) for x in batch.column("text")]
            toxic = batch.column("toxic")
            votes = np.array([votes_of(w, entries, look) for w in words], np.uint8).reshape(len(words), -1)
            votes[:, GOLD] = np.where(toxic.to_numpy(zero_copy_only=False) == 1, TOXIC, CLEAN)
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(classified(w, chosen, entries)) for w in words], pa.list_(pa.string())), pa.array(model.posterior(votes), pa.float64()), toxic],
                names=["features", "p", "toxic"])
    return run


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``held_out``: crc32 of the id's text modulo 5 is 0 (a null id is not)."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False)))


def fit(given: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Classifier:
    """Fit on ``given(doc_id, text, held_out)`` and ``labels(doc_id, toxic)``.

    The sample takes, of each class, the ``train_docs`` labelled ids with the smallest hash
    among those not held out; copies of a text count once, and of rows that repeat an id
    the smallest text trains.  Of several labels of an id, 1 counts before 0; other values
    and null are no label.  The label model reads all texts that are not held out.  With
    one class only, or no label, every score is that class (0 without any).
    """
    marks = learnable(labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                      .agg(F.max("toxic").cast("int").alias("toxic"))).where("not held_out").select("doc_id", "toxic")
    chosen = None
    for y in (0, 1):
        some = marks.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
        chosen = some if chosen is None else chosen.unionByName(some)
    size = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    chosen = stored(chosen, "chosen")       # at most two times train_docs ids: broadcast below
    rows = given.where("not held_out").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"),
                                                                                                 F.max("toxic").alias("toxic"))
    train = stored(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "train")
    have = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if len(have) < 2:
        return Classifier(500.0 if 1 in have else -500.0, {})
    share = size[1] / (size[0] + size[1])
    features, entries = mine(train, have[1], have[0])
    counts = stored(vote_counts(given.where("not held_out").select("text", F.lit(None).cast("int").alias("toxic")), entries), "votes")
    known = stored(vote_counts(train, entries), "known-votes")
    model = fit_label_model(counts, known, share)
    soft = stored(train.mapInArrow(_posterior(model, entries, features), "features array<string>, p double, toxic int"), "posterior")
    # classes were sampled by their size, so each row stands for others of its class
    stands = F.when(F.col("toxic") == 1, size[1] / have[1]).otherwise(size[0] / have[0])
    sides = [soft.select("features", F.lit(float(y)).alias("label"), (stands * (F.col("p") if y else 1 - F.col("p"))).alias("weight")) for y in (0, 1)]
    names = features + shares()
    vectors = CountVectorizerModel.from_vocabulary(names, inputCol="features", outputCol="x").setBinary(True)
    rows = vectors.transform(sides[0].unionByName(sides[1]).where("weight > 1e-9"))
    line = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", regParam=REGULARISATION, maxIter=50,
                              standardization=False).fit(rows)
    weights = {f: float(w) for f, w in zip(names, line.coefficients.toArray()) if w}
    return Classifier(float(line.intercept), weights, model, entries)


def _score(shared):
    """The text (last column) of every row replaced by score and prediction."""
    def run(it):
        model = shared.value
        look = Lookup(model.weights.keys() | model.entries.keys())
        for batch in it:
            scores = [model.score(words_of(x.as_py()), look) for x in batch.columns[-1]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=[*batch.schema.names[:-1], "score", "predicted"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row, learning labels from the rows
    that are not held out.  Only the whole text decides; null counts as empty, and a text
    without words has the score of the intercept.  Other columns are ignored; an empty
    table gives no rows."""
    given = learnable(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    model = fit(given, labels.select(F.col("doc_id"), F.col("toxic")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return given.select("doc_id", "held_out", "text").mapInArrow(_score(shared), "doc_id long, held_out boolean, score double, predicted int")
