"""Training-data operators against brute force, on small made cases and the smallest tables."""

import collections
import hashlib
import re
import tempfile

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import (exact_dedup, html_extract, language_id, line_dedup, lm_scoring, mixing, ngram_join,
                          sentencepiece_codec, substring_dedup, tokens as tk, topk_search)
from tidemark.llm.components import connected_components
from tidemark.llm.storage import stored

WORD = re.compile("[^ \t\n\v\f\r]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
BASE = " ".join(f"alpha{i}" for i in range(60))


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


@pytest.fixture(scope="module")
def cases(spark):
    """Nulls, empty, blank and very long texts, copies, near copies, repeated rows, and a
    column whose name clashes with an output."""
    rows = [(1, BASE, "en", "a"), (2, BASE.upper(), "en", "a"), (3, BASE.replace(" ", "\t\n "), "en", "b"), (4, None, None, None),
            (5, "", "en", "b"), (6, " \n\t", "fr", "b"), (7, BASE + " tail", "en", "a"), (8, BASE.replace("alpha30", "beta"), "en", "a"),
            (9, LONG, "fr", None), (10, LONG + " end", "fr", "a"), (11, "two words", "en", "a"), (12, "Two  words", "en", "a"),
            (13, "line one is here\nother\nline one is here", "en", "a"), (14, "12345 67", "en", "c"), (15, BASE, "en", "c"),
            (15, BASE, "en", "c"), (16, "été où là ▁x", "fr", "c"), (None, "no id here", "en", "a")]
    return spark.createDataFrame([(i, t, l, s, 0, "clash") for i, t, l, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def shingles(text):
    w = WORD.findall(low(text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(docs):
    sets = {i: shingles(t) for i, t in docs if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for i, s in sets.items():
        seen = collections.Counter(j for x in s for j in where[x] if j < i)
        for j, same in seen.items():
            if 100 * same >= 80 * (len(s) + len(sets[j]) - same):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("which", ["cases", "documents"])
def test_ngram_components(which, request):
    docs = request.getfixturevalue(which)
    want = brute_components(pairs_of(docs))
    got = ngram_join.ngram_components(docs).collect()
    assert len(got) == docs.count()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want


def test_cut_lists_and_long_lists_agree(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        w = list(base)
        for p in rng.integers(0, 80, rng.integers(0, 6)):
            w[p] = f"x{rng.integers(0, 30)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    monkeypatch.setattr(ngram_join, "CHUNK", 16)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(docs).collect()}
    assert got == want


def test_a_pair_is_named_by_few_of_its_shared_tokens():
    """Sets about the threshold share most of their prefixes: each linking pair is named, and
    none by token after token."""
    rng = np.random.default_rng(11)
    base = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    sets = []
    for _ in range(16):
        s = base.copy()
        some = rng.choice(300, rng.integers(10, 40), replace=False)
        s[some] = rng.integers(1, 1 << 62, len(some)).astype(np.uint64)
        sets.append(np.sort(s)[:rng.integers(294, 301)])
    sketch = ngram_join.parity_sketches(np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets]))
    lists = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for token in s[:ngram_join.prefix_length(len(s), 80)]:
            lists[int(token)].append(i)
    lists = {t: rows for t, rows in lists.items() if len(rows) > 1}
    batches = []
    for t, rows in sorted(lists.items()):
        own = [[int(x) for x in sets[i]] for i in rows]
        before = [[0, 0, *(x for x in s[:s.index(t)] if x in lists)] for s in own]
        batches.append(pa.RecordBatch.from_pydict({
            "token": [t] * len(rows), "cell": [0] * len(rows), "side": [0] * len(rows), "rep": rows, "n": [len(s) for s in own],
            "grp": rows, "pos": [s.index(t) for s in own], "before1": [x[-1] for x in before], "before2": [x[-2] for x in before],
            "sketch": [sketch[i].tobytes() for i in rows]}))
    got = [(r["a"], r["b"]) for b in ngram_join._candidates(80, False)(iter(batches)) for r in b.to_pylist()]
    want = {(i, j) for i in range(16) for j in range(i + 1, 16)
            if 100 * (m := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - m)}
    assert want and want <= set(got) and len(got) <= 3 * len(set(got))


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


@pytest.mark.parametrize("which", ["cases", "documents"])
def test_exact_groups(which, request):
    docs = request.getfixturevalue(which)
    groups = collections.defaultdict(list)
    for i, t in pairs_of(docs):
        groups[re.sub("[ \t\n\v\f\r]+", " ", t or "")].append(i)
    want = sorted((str(i), min((x for x in own if x is not None), default=None), len(own), hashlib.sha256(n.encode()).hexdigest())
                  for n, own in groups.items() for i in own)
    got = exact_dedup.exact_groups(docs).collect()
    assert sorted((str(r["doc_id"]), r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["keep_id"]) for r in got)


@pytest.mark.parametrize("which", ["cases", "documents"])
def test_repeated_windows(which, request):
    docs = request.getfixturevalue(which)
    words = [(i, WORD.findall(t or "")) for i, t in pairs_of(docs)]
    first = {}
    for i, w in words:
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    want = []
    for i, w in words:
        keep = [True] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k:k + 13])] < i:
                keep[k:k + 13] = [False] * 13
        kept = [x for x, ok in zip(w, keep) if ok]
        want.append((str(i), len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    got = substring_dedup.remove_repeats(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == sorted(want)


def brute_windows(pairs, k=13):
    first = {}
    for i, w in pairs:
        for a in range(len(w) - k + 1):
            first[tuple(w[a:a + k])] = min(first.get(tuple(w[a:a + k]), i), i)
    return {i: {x for a in range(len(w) - k + 1) if first[tuple(w[a:a + k])] < i for x in range(a, a + k)} for i, w in pairs}


def _bucket_bytes(k):
    def run(it):
        unpack = zstandard.ZstdDecompressor()
        for batch in it:
            rows = [(b, len(unpack.decompress(p))) for b, p in zip(batch["bucket"].to_pylist(), batch["payload"].to_pylist()) if p]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int64()), pa.array([n for _, n in rows], pa.int64()),
                                              pa.array([0] * len(rows), pa.int64())], names=["doc_id", "from_word", "to_word"])
    return run


def test_windows_of_one_minimiser_are_dealt_out(spark, monkeypatch):
    """Template text: a word pair with a tiny hash stands in every window, all different."""
    names = [f"p{i}" for i in range(20_000)]
    data, offsets = tk.text_buffer(pa.array([" ".join(names)]))
    starts, ends, _ = tk.words(data, offsets)
    at = int(tk.window_hashes(tk.word_hashes(data, starts, ends), 2)[:-1].argmin())
    rng = np.random.default_rng(7)
    docs = []
    for i in range(200):
        w = [f"v{x}" for x in rng.integers(0, 3000, 500)]
        for j in range(0, 500, 8):
            w[j:j + 2] = names[at:at + 2]
        if i % 10 == 9:
            w[100:160] = docs[i - 7][1][100:160]      # repeated passages across partitions
        docs.append((i, w))
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string").repartition(7)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 20_000, raising=False)
    lost = {i: set() for i, _ in docs}
    for r in substring_dedup.repeated_spans(table).collect():
        lost[r["doc_id"]] |= set(range(r["from_word"], r["to_word"]))
    want = brute_windows(docs)
    assert lost == want and any(want.values())
    monkeypatch.setattr(substring_dedup, "_count", _bucket_bytes)
    sizes = collections.Counter()
    for b, n, _ in substring_dedup.repeated_spans(table).collect():
        sizes[b] += n
    assert max(sizes.values()) < sum(sizes.values()) / 10


def brute_lines(docs):
    lines = []
    for i, t in sorted((i, t) for i, t in {x for x in docs if x[0] is not None and x[1] is not None}):
        for k, line in enumerate(t.split("\n")):
            w = frozenset(x for x in re.split("[ \t\r\v\f]", line.lower()) if x)
            if w:
                lines.append((i, k, w))
    lost, where = set(), collections.defaultdict(list)
    for n, (i, k, w) in enumerate(lines):
        seen = collections.Counter(j for x in w for j in where[x])
        if any(100 * m >= 80 * (len(w) + len(lines[j][2]) - m) for j, m in seen.items()):
            lost.add((i, k))
        for x in w:
            where[x].append(n)
    return lost


def test_line_dedup_of_near_copies(spark):
    """A group of near copies, some of which match no first member but a later one."""
    import random
    rng = random.Random(5)
    base, rows = [f"word{i}" for i in range(40)], []
    for i in range(150):
        line = list(base)
        for k in rng.sample(range(40), rng.choice([0, 1, 3, 5, 8])):
            line[k] = f"new{rng.randrange(12)}"
        rows.append((i, "\n".join([" ".join(line), f"own line {i}", "one line for all"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["line_no"]) for r in line_dedup.duplicate_lines(docs).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_of_documents(documents):
    rows = line_dedup.duplicate_lines(documents).collect()
    got = {(r["doc_id"], r["line_no"]) for r in rows}
    assert len(rows) == len(got) and got == brute_lines(pairs_of(documents))
    assert all((r["match_id"], r["match_line"]) < (r["doc_id"], r["line_no"]) for r in rows)


def test_line_dedup_stores_shared_grams_only(spark, monkeypatch):
    """A line that shares nothing leaves one narrow row and no row of its words."""
    docs = spark.createDataFrame([(i, "\n".join(" ".join(f"w{i}x{k}x{j}" for j in range(40)) for k in range(3))) for i in range(20)],
                                 "doc_id long, text string")
    tables, stored = [], line_dedup.stored

    def seen(df, name):
        tables.append(stored(df, name))
        return tables[-1]
    monkeypatch.setattr(line_dedup, "stored", seen)
    assert line_dedup.duplicate_lines(docs).count() == 0
    assert tables[0].count() == 60 and not any("array" in t for df in tables[:3] for _, t in df.dtypes)
    assert sum(df.count() for df in tables[2:]) == 0


def test_line_dedup_names_few_pairs_of_lines_alike_in_part(spark, monkeypatch):
    """Lines that share most words, but match nothing, make no table of all their pairs."""
    common = " ".join(f"same{j}" for j in range(30))
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(10)) + " " + common) for i in range(200)]
    rows += [(200 + i, text.replace("same7 ", "")) for i, text in rows[:5]]
    pairs, stored = [], line_dedup.stored

    def seen(df, name):
        out = stored(df, name)
        pairs.extend([out.count()] if name == "pairs" else [])
        return out
    monkeypatch.setattr(line_dedup, "stored", seen)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["match_id"]) for r in line_dedup.duplicate_lines(docs).collect()}
    assert got == {(200 + i, i) for i in range(5)}
    assert sum(pairs) < 4000            # of 21,000


@pytest.mark.parametrize("threshold", [50, 60, 80, 95])
def test_line_dedup_of_short_lines(spark, threshold):
    import random
    rng = random.Random(threshold)
    rows = [(i, "\n".join(" ".join(rng.sample("abcdefghij", rng.randrange(1, 10))) for _ in range(3))) for i in range(40)]
    sets = [((i, k), set(line.split())) for i, t in rows for k, line in enumerate(t.split("\n"))]
    lost = {at for n, (at, w) in enumerate(sets) if any(100 * len(w & v) >= threshold * len(w | v) for _, v in sets[:n])}
    got = {(r["doc_id"], r["line_no"]) for r in
           line_dedup.duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold).collect()}
    assert got == lost


def test_line_dedup(cases):
    lost = brute_lines(pairs_of(cases))
    for r in line_dedup.remove_lines(cases).collect():
        text = dict(pairs_of(cases))[r["doc_id"]]
        lines = [] if text is None else text.split("\n")
        kept = "\n".join(x for k, x in enumerate(lines) if (r["doc_id"], k) not in lost)
        assert (r["n_lines"], r["kept_text"]) == (len(lines), kept)


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(200)]
    rows += [(200, None), (201, [float("nan")] * 8), (202, [None] * 8), (203, [float("inf")] * 8), (204, []), (220, [0.5, 0.5]),
             (221, [0.25, 0.1]), (240, rows[3][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vec = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows
           if v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in vec if i % 20 == 0):
        best = sorted((-int(vec[q] @ vec[i]), i) for i in vec if i != q and len(vec[i]) == len(vec[q]))[:20]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, topk_search.top_k(table).collect())) == sorted(want)
    assert topk_search.top_k(table.where("false")).count() == 0


def test_top_k_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk_search, "DATA_ROWS", 8)
    windows = []

    def walk(plan):
        if plan.nodeName() == "Window":
            out = plan.output()
            windows.append({out.apply(i).name() for i in range(out.size())})
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    def watched(df, name):
        walk(df._jdf.queryExecution().optimizedPlan())
        return stored(df, name)

    monkeypatch.setattr(topk_search, "stored", watched)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 3 + i % 2)]) for i in range(300)]
    rows += [(7, [0.5, 0.25, 0.125, 1.0])] * 40       # blocks with the same ids
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    vec = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows]
    want = []
    for q, x in vec:
        if q % 20 == 0:
            best = sorted((-int(x @ v), i) for i, v in vec if i != q and len(v) == len(x))[:20]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    found = topk_search.top_k(table)
    assert sorted(map(tuple, found.collect())) == sorted(want)
    walk(found._jdf.queryExecution().optimizedPlan())
    assert windows and not any({"ids", "m"} & names for names in windows)      # vectors never meet in one task


def test_segment_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-40, 40, (30, 64)).astype(float), rng.integers(-40, 40, (50, 64)).astype(float)
    for parts in topk_search.LEVELS:
        assert (topk_search._stats(a, parts) @ topk_search._stats(b, parts).T + 1e-6 >= a @ b.T).all()


PAGE = ("<html><head><title>T</title><script>if(a<b)x('</p>')</script></head><body><nav><a href='/'>Home</a></nav>"
        "<article><h1>Head &amp; tail</h1><p>One <b>bold</b>word.<br>Next&nbsp;line<p>Two paragraphs of text here.</p>"
        "<div class='comments'><p>I like it</p></div></article><aside>Side</aside><footer>&copy; me</footer></body></html>")


def test_html_blocks_and_extraction(spark):
    texts = [b[0] for b in html_extract.blocks(PAGE)]
    assert texts == ["T", "Home", "Head & tail", "One boldword.", "Next line", "Two paragraphs of text here.", "I like it", "Side", "© me"]
    pages = [(i, f"u{i}", PAGE.replace("here", f"here {i}"), "x") for i in range(40)]
    pages += [(50, None, None, "x"), (51, "u", "", "x"), (52, "u", "<p", "x"), (53, "u", "<!-- <p>never", "x")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html_extract.extract(table).collect()}
    assert got[7]["text"] == "Head & tail One boldword. Next line Two paragraphs of text here 7."
    assert got[50]["text"] == got[51]["text"] == got[53]["text"] == "" and got[50]["n_chars"] == 0
    assert html_extract.extract(table.where("false")).count() == 0


def test_html_extracts_articles(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    for r in html_extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        own = html_extract.blocks(r["html"])
        assert r["text"] == " ".join(b[0] for b, y in zip(own, html_extract.labels(own)) if y)


def test_viterbi_is_the_best_path():
    import itertools
    chain = html_extract.Chain({"a": 1.5, "b": -0.7, "c": 0.2}, np.array([[0.5, -0.4], [-0.6, 0.3]]))
    rows = [["a"], ["b", "c"], ["b"], ["c"], ["a", "b"]]

    def value(path):
        return (sum(y * sum(chain.weights[f] for f in r) for y, r in zip(path, rows))
                + sum(chain.moves[a, b] for a, b in zip(path, path[1:])))
    assert value(chain.decode(rows)) == pytest.approx(max(value(p) for p in itertools.product((0, 1), repeat=5)))


def test_html_foreign_elements_end_at_a_slash():
    page = "<p>a</p><svg/><p>b</p><math  /><p>c</p><svg viewBox='0'><text>no</text></svg><p>d</p><script/>gone</script><p>e"
    assert [b[0] for b in html_extract.blocks(page)] == ["a", "b", "c", "d", "e"]


def test_html_deep_pages_cost_in_proportion():
    import time
    page = "".join(f"<div class='c{i % 50} ad{i % 7}'>t{i}" for i in range(200_000))
    start = time.process_time()
    own = html_extract.blocks(page)
    rows = html_extract.features(own)
    assert len(own) == len(rows) == 200_000 and own[-1][0] == "t199999"
    assert time.process_time() - start < 30
    assert own[0][1].marks == {"c", "ad"} and own[-1][1].tags == {"div"}


def test_html_places_follow_the_open_elements():
    page = "<body><nav><ul><li>x<li>y</ul></nav><main><p class='lead'>one <b>two <a href=q>three</a></b><p>four<div id='comments'>no</div></main>end"
    got = [(t, sorted(p.tags), sorted(p.marks), p.own, p.boiler, link) for t, p, _, link in html_extract.blocks(page)]
    assert got == [("x", ["body", "li", "nav", "ul"], [], "li", True, 0), ("y", ["body", "li", "nav", "ul"], [], "li", True, 0),
                   ("one two three", ["body", "main", "p"], ["lead"], "p", False, 5), ("four", ["body", "main", "p"], [], "p", False, 0),
                   ("no", ["body", "div", "main"], ["comments"], "div", True, 0), ("end", ["body"], [], "body", False, 0)]


def test_html_viterbi_on_whole_pages(documents, spark, small_dir):
    """The decoded labels of real pages score no less than any other labelling, by brute
    force over pages of up to 14 blocks."""
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    chain = html_extract.train(pages)
    seen = 0
    for r in pages.select("html").limit(80).collect():
        rows = html_extract.features(html_extract.blocks(r["html"]))[:14]
        own = np.array([sum(chain.weights.get(f, 0.0) for f in row) for row in rows])
        n = len(rows)
        if not n:
            continue
        all_ = (np.arange(2 ** n)[:, None] >> np.arange(n)) & 1
        total = all_ @ own + sum(chain.moves[all_[:, k], all_[:, k + 1]] for k in range(n - 1))
        got = chain.decode(rows)
        assert abs(total[sum(x << k for k, x in enumerate(got))] - total.max()) < 1e-9
        seen += 1
    assert seen > 20


def test_html_training_sample_is_bounded(spark):
    """A page that thousands copy trains once, a page of too many blocks not at all."""
    page = "<body><nav>menu</nav><article>" + "".join(f"<p>text {i} of it.</p>" for i in range(5)) + "</article></body>"
    long = "<article>" + "<p>words here.</p>" * (html_extract.TRAIN_BLOCKS + 1) + "</article>"
    rows = [(i, page) for i in range(3000)] + [(4000 + i, page.replace("text", f"t{i}")) for i in range(30)] + [(9000, long)]
    table = spark.createDataFrame(rows, "page_id long, html string")
    held = []
    original = html_extract.fit_chain
    try:
        html_extract.fit_chain = lambda pages: held.extend(pages) or original(pages)
        html_extract.train(table, train_pages=20)
    finally:
        html_extract.fit_chain = original
    assert 19 <= len(held) <= 20 and max(len(rows) for rows, _ in held) <= 6


def test_sentencepiece_equals_the_library():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL_PATH)
    tool = sentencepiece_codec.codec(sentencepiece_codec.load_pieces())
    rng = np.random.default_rng(2)
    signs = list("abcdefgh  \n\t.,éß日本🙂0123▁")
    texts = ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(300)]
    texts += ["", " ", "   lead", "a  b ", "x" * 500 + " " * 40 + "y\r\n", "international unbelievable 1234567890", "aaaa" * 40, "a\x00b"]
    data, offsets = tk.text_buffer(pa.array(texts))
    ids, at = tool.encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == sp.encode(texts)
    back, off = tool.decode(ids, at)
    assert [back[a:b].tobytes().decode() for a, b in zip(off[:-1], off[1:])] == [t.replace("▁", " ") for t in texts]


def test_sentencepiece_round_trip(cases, empty):
    rows = sentencepiece_codec.round_trip(cases).collect()
    assert len(rows) == cases.count()
    assert {r["doc_id"] for r in rows if not r["round_trip"]} == {16}      # holds the model's visible space
    assert sentencepiece_codec.round_trip(empty).count() == 0
    assert "component_id" in sentencepiece_codec.encode(cases).columns


def test_ppm_probabilities_sum_to_one():
    texts = pa.array(["abracadabra alakazam", "abba", "the cat sat on the mat"])
    keys, _ = lm_scoring._keys(*tk.text_buffer(texts))
    trie = lm_scoring.Trie(*np.unique(keys, return_counts=True))
    for context in (0, 0x61626261, 0x20656874, 0x7A7A7A7A, 0x61000000):
        every = np.array([(context << 8) | s for s in range(256)], np.uint64)
        assert (10 ** trie.log10(every)).sum() == pytest.approx(1, abs=1e-9)


def test_ppm_scores(cases, documents):
    import zlib
    docs = pairs_of(documents)
    words = {i: WORD.findall(low(t or "")) for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in words}
    c = collections.Counter(w for i, ws in words.items() if not held[i] for w in ws + ["<end of text>"])
    n, v = sum(c.values()), len(c)
    for r in lm_scoring.score_documents(documents).collect():
        own = words[r["doc_id"]] + ["<end of text>"]
        want = sum(np.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[r["doc_id"]], len(own), sum(c[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(want) and r["score"] < 0
    assert lm_scoring.score_documents(cases).count() == cases.count()


def test_ppm_codes_equal_one_whole_trie(documents, monkeypatch):
    """Grouped codes, broadcast or joined, against one trie built from every training text."""
    import zlib
    rows = [(i, t) for i, t in pairs_of(documents)]
    train = pa.array([t or "" for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1])
    trie = lm_scoring.Trie(*np.unique(lm_scoring._keys(*tk.text_buffer(train))[0], return_counts=True))
    want = {i: trie.log10(lm_scoring._keys(*tk.text_buffer(pa.array([t or ""])))[0]).sum() for i, t in rows}
    for hot in (lm_scoring.HOT_KEYS, 300):
        monkeypatch.setattr(lm_scoring, "HOT_KEYS", hot)
        got = {r["doc_id"]: r["score"] for r in lm_scoring.score_documents(documents).collect()}
        assert got == pytest.approx(want)


def test_ppm_empty(empty):
    assert lm_scoring.score_documents(empty).count() == 0


def test_language_id(documents, cases, empty):
    rows = language_id.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert right >= 0.95 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)
    got = {r["doc_id"]: r for r in language_id.identify(cases).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (4, 5, 6, 14))
    assert language_id.identify(empty).count() == 0
    alone = language_id.predict(cases, language_id.Model([], {}))
    assert alone.where("lang_pred <> 'und'").count() == 0


def test_language_id_learns_from_different_texts(spark):
    """One much-copied text neither crowds out the others nor counts more than they do."""
    words = ["k" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(60)]
    rows = [(f"{w} {w}", "xx") for w in words] + [(f"{words[0]} {words[0]}", "xx")] * 3000
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    keys, logs = language_id.fit(docs, train_docs=100).tables[0]
    assert len(keys) == 60 and np.ptp(logs) == 0


def test_mixing(spark, cases, empty):
    rows = [(i, " ".join(["w"] * (5 + i % 7)), "hot" if i < 300 else f"s{i % 3}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(docs, block_tokens=200, target_entropy=0.98, max_repeats=5.0).collect()
    total = sum(5 + i % 7 for i, _, _ in rows)
    by = collections.Counter()
    for r in got:
        by[r["source"]] += r["n_tokens"]
    weight = {r["source"]: r["weight"] for r in got}
    assert sum(weight.values()) == pytest.approx(1)
    assert -sum(w * np.log(w) for w in weight.values()) == pytest.approx(0.98 * np.log(4), abs=1e-3)
    assert all(abs(by[s] - weight[s] * total) <= 11 for s in weight)          # one document at most beyond
    assert max(r["repeats"] for r in got) <= 5
    passes = collections.Counter((r["doc_id"], r["pass"]) for r in got)
    assert max(passes.values()) == 1
    assert len({(r["block"], r["position"]) for r in got}) == len(got)
    assert mixing.mixture(cases).count() > 0 and mixing.mixture(empty).count() == 0


def test_mixing_repetition_limit(spark):
    tokens = spark.createDataFrame([("a", 9000), ("b", 900), ("c", 100), ("d", 0)], "source string, n long")
    rows = mixing.source_weights(tokens, 10_000.0, target_entropy=1.0, max_repeats=2.0).collect()
    assert {r["source"] for r in rows} == {"a", "b", "c"}
    assert max(r["weight"] * 10_000 / r["n"] for r in rows) == pytest.approx(2.0, abs=1e-4)


def test_empty_tables(empty):
    assert ngram_join.ngram_components(empty).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert line_dedup.remove_lines(empty).count() == 0


def test_pipeline(spark, small_dir):
    import corpus_pipeline
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, small_dir)
        assert kept.columns == docs.columns
    parts = brute_components(pairs_of(docs))
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, (_, c) in parts.items() if c == i}
    out = corpus_pipeline.run(spark, small_dir)
    assert {"doc_id", "piece_ids", "n_pieces"} <= set(out.columns) and out.count() > 0


def test_pipeline_with_null_and_repeated_ids(spark, small_dir):
    import corpus_pipeline

    def text(n, size=40):
        return " ".join(f"word{n}x{i}" for i in range(size))

    # id 5 has a copy, a near copy and a text of its own; 7 is three rows; null ids are two texts
    rows = [(1, text(1)), (2, text(2)), (5, text(1).replace(" ", "  ")), (5, text(2) + " tail"), (5, text(3)), (6, text(4)),
            (6, text(5, 20)), (7, text(6)), (7, text(6)), (7, text(6)), (None, text(7)), (None, text(8, 30))]
    rows += [(100 + i, text(100 + i, 30 + i % 5)) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "a" if i is None or i < 120 else "b", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(path := f"{tempfile.mkdtemp(prefix='tidemark-test-')}/documents.parquet")
    docs = spark.read.parquet(path)

    def pairs(df):
        return collections.Counter((r["doc_id"], r["text"]) for r in df.collect())

    once = exact_dedup.exact_dedup(docs)
    want = collections.Counter(rows)
    del want[rows[2]]
    assert pairs(once) == want
    kept = corpus_pipeline.drop_near_copies(spark, once, small_dir)
    del want[rows[3]]
    assert pairs(kept) == want and kept.columns == docs.columns

    mixed = corpus_pipeline.mix_sources(spark, kept, small_dir)
    assert mixed.columns == docs.columns

    def emitted(df):
        return collections.Counter((r["doc_id"], r["source"], r["n_tokens"]) for r in df.collect())

    tokens = mixed.select("doc_id", "source", F.size(F.split("text", " ")).alias("n_tokens"))
    assert emitted(tokens) == emitted(mixing.mixture(kept))
    out = corpus_pipeline.run(spark, path.rsplit("/", 1)[0])
    first = corpus_pipeline.identify_language(spark, docs, small_dir)
    assert pairs(first) == collections.Counter(rows)      # one language: nothing leaves
    assert pairs(out) == pairs(mixed)


def test_internal_names_may_be_taken(spark):
    """Columns called like the operators' own helpers are kept as they are."""
    import corpus_pipeline
    rows = [(1, "sha a", BASE, "row a", "en", "s"), (2, "sha b", BASE, "row b", "en", "s"), (3, "sha c", BASE + " end", "row c", "en", "t"),
            (4, "sha d", "other words altogether here now", None, "en", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, _text_sha256 string, text string, _row string, lang string, source string")
    got = exact_dedup.exact_dedup(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=str) == sorted((r for r in rows if r[0] != 2), key=str)
    near = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert near.columns == docs.columns and sorted(map(tuple, near.collect()), key=str) == sorted((r for r in rows if r[0] in (1, 4)), key=str)
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    assert mixed.columns == docs.columns and set(map(tuple, mixed.collect())) <= set(rows)


def test_sentencepiece_blocks_and_memory_change_nothing(monkeypatch, documents):
    """Small blocks, remembered units and forgotten ones give the library's ids."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL_PATH)
    texts = [t or "" for _, t in pairs_of(documents)][:60]
    column = pa.array(texts, pa.string())
    data, offsets = tk.text_buffer(column)
    want = [sp.encode(t) for t in texts]
    for known in (300_000, 50):
        monkeypatch.setattr(sentencepiece_codec, "KNOWN_UNITS", known)
        tool = sentencepiece_codec.Codec(sentencepiece_codec.load_pieces())
        for size in (2_000, 10_000_000):
            got = []
            for lo, hi in tk.row_blocks(offsets, size):
                ids, at = tool.encode(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
            assert got == want
        assert len(tool.known) <= known
