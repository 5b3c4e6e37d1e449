"""Main-text extraction with a linear-chain conditional random field over leaf blocks.

A page is a sequence of leaf blocks: text between block-level tags, in page order.  Each
has ancestor-tag and text features; a two-label chain (boilerplate, content) trained on
labelled pages is decoded by Viterbi.  Labels come from the pages themselves: where a page
marks its article (``article`` or ``main``), blocks inside and outside any boilerplate
element are content.  Training takes the bounded number of such pages with the smallest
hash; copies of a page count once.
"""

from __future__ import annotations

import dataclasses
import html as htmllib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Different labelled pages that are fitted on, and blocks of one, at most; pages with more
#: blocks are not fitted on.
TRAIN_PAGES, TRAIN_BLOCKS = 400, 400
EPOCHS, RATE, L2 = 150, 0.2, 1e-3

TAG = re.compile(r"""<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*+>""")
MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PIECE = re.compile(r"[a-z]+")
# fixed values: HTML element names by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FOREIGN = frozenset("svg math".split())
SKIP = frozenset("script style noscript template textarea svg iframe object math canvas select".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr acronym".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main menu nav ol p pre section table ul".split())
BOILER_TAGS = frozenset("nav header footer aside form button menu dialog head title".split())
BOILER_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb comment comments cookie disclaimer "
                         "footer header menu nav navbar navigation newsletter notice pagination popup promo related "
                         "reply replies share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())


@dataclasses.dataclass(frozen=True)
class Place:
    """Where a block stands: the open block-level elements, gathered on the way down."""

    own: str = "-"
    tags: frozenset = frozenset()
    marks: frozenset = frozenset()
    boiler: bool = False

    def inside(self, tag: str, marks: tuple) -> "Place":
        return Place(tag, self.tags if tag in self.tags else self.tags | {tag},
                     self.marks if self.marks.issuperset(marks) else self.marks.union(marks),
                     self.boiler or tag in BOILER_TAGS or not BOILER_WORDS.isdisjoint(marks))


def blocks(page: str) -> list[tuple[str, Place, int, int]]:
    """Leaf blocks of a page: (text, place, characters, characters in links).

    Open elements are counted by name and share their ancestors' places, so a page costs
    time and memory in proportion to its length however deep it nests."""
    out: list = []
    stack: list[tuple[str, Place]] = []         # element, place inside it
    opened: Counter = Counter()
    runs: list[str] = []
    links = 0
    pos, size = 0, len(page)

    def here():
        return stack[-1][1] if stack else Place()

    def flush():
        nonlocal links
        text = " ".join("".join(runs).split())
        if text:
            out.append((text, here(), len(text), min(links, len(text))))
        runs.clear()
        links = 0

    def take(raw):
        nonlocal links
        if raw:
            text = htmllib.unescape(raw)
            runs.append(text)
            if opened["a"]:
                links += len(text)

    def close(name):
        while True:
            top = stack.pop()[0]
            opened[top] -= 1
            if top == name:
                return

    while pos < size:
        m = TAG.search(page, pos)
        if m is None:
            take(page[pos:])
            break
        take(page[pos:m.start()])
        pos = m.end()
        if m.group() == "<!--":
            end = page.find("-->", pos)
            pos = size if end < 0 else end + 3
            continue
        if m.group(2) is None:
            continue
        name = m.group(2).lower()
        if m.group(1):
            if opened[name]:
                if name not in INLINE:
                    flush()
                close(name)
            continue
        closed = m.group(3).rstrip().endswith("/")
        if name in SKIP:
            if closed and name in FOREIGN:      # only these end at a slash
                continue
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, pos)
            pos = size if end is None else end.end()
            continue
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        if name in ENDS_P and opened["p"]:
            close("p")
        for other in CLOSES.get(name, ()):
            if stack and stack[-1][0] == other:
                close(other)
        if not closed:
            marks = tuple(w for g in MARK.findall(m.group(3)) for w in PIECE.findall("".join(g).lower())) if m.group(3) else ()
            stack.append((name, here() if name in INLINE else here().inside(name, marks)))
            opened[name] += 1
    flush()
    return out


def labels(page_blocks: list) -> list[int] | None:
    """1 for blocks of the marked article outside boilerplate; None if nothing is marked."""
    inside = [not place.tags.isdisjoint(("article", "main")) for _, place, _, _ in page_blocks]
    if not any(inside):
        return None
    return [int(i and not place.boiler) for i, (_, place, _, _) in zip(inside, page_blocks)]


def features(page_blocks: list) -> list[list[str]]:
    rows = []
    for k, (text, place, size, link) in enumerate(page_blocks):
        row = ["bias", f"len:{min(size, 4000).bit_length()}", f"link:{4 * link // size}", f"end:{text[-1] in '.!?…:;'}",
               f"words:{min(len(text.split()), 12)}", f"first:{k == 0}", f"own:{place.own}", f"boiler:{place.boiler}"]
        if "©" in text:
            row.append("copyright")
        row += [f"in:{tag}" for tag in place.tags]
        row += [f"mark:{mark}" for mark in place.marks]
        rows.append(row)
    return rows


class Chain:
    """Weights of a two-label chain: per feature the score of content over boilerplate, and
    a transition table."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def decode(self, rows: list[list[str]]) -> list[int]:
        """Viterbi; ties go to content."""
        if not rows:
            return []
        get, (aa, ab), (ba, bb) = self.weights.get, *self.moves.tolist()
        no, yes, back = 0.0, 0.0, []
        for k, row in enumerate(rows):
            own = sum(get(f, 0.0) for f in row)
            if k:
                n0, n1, y0, y1 = no + aa, yes + ba, no + ab, yes + bb
                back.append((int(n1 >= n0), int(y1 >= y0)))
                no, yes = max(n0, n1), max(y0, y1)
            yes += own
        label = int(yes >= no)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def fit_chain(pages: list[tuple[list[list[str]], list[int]]]) -> Chain:
    """Maximise the conditional likelihood by Adam over forward-backward gradients.  The
    prior mean distrusts boilerplate elements, so no page still gives a usable chain."""
    names = {f: i for i, f in enumerate(sorted({f for rows, _ in pages for row in rows for f in row} | {"bias", "boiler:True"}))}
    mean = np.zeros(len(names))
    mean[names["bias"]], mean[names["boiler:True"]] = 1.0, -4.0
    w, moves = mean.copy(), np.zeros((2, 2))
    pages = [p for p in pages if p[0]]
    if pages:
        n, t = len(pages), max(len(rows) for rows, _ in pages)
        used = [(i, k, names[f]) for i, (rows, _) in enumerate(pages) for k, row in enumerate(rows) for f in row]
        page, place, feat = (np.array(x) for x in zip(*used))
        real, gold = np.zeros((n, t)), np.zeros((n, t))
        for i, (_, lab) in enumerate(pages):
            real[i, :len(lab)], gold[i, :len(lab)] = 1, lab
        y = np.stack([1 - gold, gold], 2) * real[:, :, None]
        pair_gold = np.einsum("nta,ntb->ab", y[:, :-1], y[:, 1:])
        m1, m2 = np.zeros(len(names) + 4), np.zeros(len(names) + 4)
        for step in range(1, EPOCHS + 1):
            e = np.zeros((n, t, 2))
            np.add.at(e[:, :, 1], (page, place), w[feat])
            fwd, bwd = np.zeros((n, t, 2)), np.zeros((n, t, 2))
            fwd[:, 0] = e[:, 0]
            for k in range(1, t):
                nxt = np.logaddexp.reduce(fwd[:, k - 1, :, None] + moves, axis=1) + e[:, k]
                fwd[:, k] = np.where(real[:, k, None] > 0, nxt, fwd[:, k - 1])
            for k in range(t - 2, -1, -1):
                prv = np.logaddexp.reduce(moves + (e[:, k + 1] + bwd[:, k + 1])[:, None, :], axis=2)
                bwd[:, k] = np.where(real[:, k + 1, None] > 0, prv, bwd[:, k])
            z = np.logaddexp.reduce(fwd[:, -1], axis=1)
            p = np.exp(fwd + bwd - z[:, None, None]) * real[:, :, None]
            pair = np.exp(fwd[:, :-1, :, None] + moves + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None])
            pair = (pair * real[:, 1:, None, None]).sum((0, 1))
            grad = np.zeros(len(names))
            np.add.at(grad, feat, (gold - p[:, :, 1])[page, place])
            g = np.r_[grad / n - L2 * (w - mean), ((pair_gold - pair) / n - L2 * moves).ravel()]
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
            move = RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
            w, moves = w + move[:-4], moves + move[-4:].reshape(2, 2)
    return Chain({f: float(w[i]) for f, i in names.items()}, moves)


def _sample(it):
    for batch in it:
        for page in batch.column(0).to_pylist():
            own = blocks(page)
            gold = labels(own)
            if gold is not None and len(own) <= TRAIN_BLOCKS:
                yield pa.RecordBatch.from_arrays([pa.array([features(own)], pa.list_(pa.list_(pa.string()))),
                                                  pa.array([gold], pa.list_(pa.int32()))], names=["rows", "gold"])


def train(pages: DataFrame, html_col: str = "html", train_pages: int = TRAIN_PAGES) -> Chain:
    marked = pages.select(F.col(html_col).cast("string").alias("html")).where(
        F.lower("html").contains("<article") | F.lower("html").contains("<main")).withColumn("hash", F.xxhash64("html"))
    chosen = marked.select("hash").distinct().orderBy("hash").limit(train_pages)
    some = marked.join(F.broadcast(chosen), "hash").groupBy("hash").agg(F.min("html").alias("html")).select("html")
    rows = some.mapInArrow(_sample, "rows array<array<string>>, gold array<int>").toArrow().to_pylist()
    rows = [{"rows": [sorted(r) for r in row["rows"]], "gold": row["gold"]} for row in rows]
    rows.sort(key=lambda r: (len(r["gold"]), str(r["rows"])))     # the fit must not depend on row order
    return fit_chain([(r["rows"], r["gold"]) for r in rows])


def _extract(shared):
    def run(it):
        chain = shared.value
        for batch in it:
            texts = []
            for page in batch.column(0).to_pylist():
                own = blocks(page) if page else []
                keep = chain.decode(features(own))
                texts.append(" ".join(b[0] for b, k in zip(own, keep) if k))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=[*batch.schema.names[1:], "text", "n_chars"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per input row.

    The text of content blocks in page order: character references decoded, white space in
    a block one space, blocks joined by one space.  Null, empty or text-less pages give the
    empty text.  ``n_chars`` counts code points.  Repeated ids are rows of their own; other
    columns are ignored; an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, html_col))
    given = pages.select(F.col(html_col).cast("string").alias("html"), F.col(id_col).cast("long").alias("page_id"),
                         F.col(url_col).cast("string").alias("url"))
    return given.mapInArrow(_extract(shared), "page_id long, url string, text string, n_chars long")
