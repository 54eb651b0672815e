from __future__ import annotations

import hashlib
import itertools
import random
import time
import unicodedata
import zlib
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tallow.llm import hilbert_shards, html_extraction, language_id, media, registry, reply_trees, shared
from tests.conftest import SF
from tests.llm.common import ROWS, docs
from tests.llm.test_dedup import brute_components, normal
from tests.llm.test_encoding import check_pieces
from tests.test_queries import same_rows

# -- pages ----------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>"</script></head><body class="has-sidebar">
<header class="site"><h1>My Site</h1></header><div id="cookieNotice">We use cookies</div><nav><a href=/>Home</a></nav><div class="layout"><div class="post">
<h2>Title &lt;x&gt;</h2><!-- <p>gone</p> --><p>First para with <a href=#>a link</a> in it.<p>Second&nbsp;para<br>line &amp;amp; two.<ul><li>one<li>two</ul>
<form><label>Name</label><input></form><div class="share-buttons">Share this</div></div><div class="sidebar"><p>Popular now, a long text about nothing.</p></div></div>
<section class="comments"><article>Great article! I loved every bit of it.</article></section><footer>(c) 2020</footer></body></html>"""


def test_main_text():
    assert html_extraction.main_blocks(PAGE) == ["Title <x>", "First para with a link in it.", "Second para line &amp; two.", "one", "two"]
    assert html_extraction.main_blocks("<p>just text") == ["just text"]
    for empty in ("", "<nav><a href=x>Home</a></nav>", "<script>x</script>", "<!-- open"):
        assert html_extraction.main_blocks(empty) == []
    assert html_extraction.main_blocks('<p title="a>b">q</p>') == ["q"]


BODY = "The river rose for three days before anyone in the village thought of moving the animals up the hill. "
TALK = "I do not agree with this at all, and I have said so many times before under other texts of this paper. " * 5


def test_much_boilerplate_is_no_main_text():
    text = f"<p>{BODY}</p>"
    for away in ("section class=comments", "div class=sidebar", "div id=cookie-notice"):
        for inner in ("p", "article", "div class=comment-body"):
            much = f"<{away}>" + f"<{inner}>{TALK}</{inner.split()[0]}>" * 5 + f"</{away.split()[0]}>"
            pages = [f"<article>{text}</article>{much}", f"<main><h1>T.</h1>{text}</main>{much}", f"<div class=post>{text}</div>{much}"]
            # several articles beside unmarked text may be the main text, but not those in comments
            pages += [f"<div>{text}</div>{much}", f"<article>{text}{much}</article>"]
            for page in pages:
                got = html_extraction.main_blocks(page)
                assert BODY.strip() in got and TALK.strip() not in got, page[:80]


def test_wrappers_of_main_text():
    text = f"<p>{BODY}</p>"
    rest = f"<footer>{TALK}</footer>"
    for start in ("div class='content has-sidebar'", "div class='content sidebar-right'", "article class='post category-social'", "div class='post comments-open'"):
        page = f"<{start}><h1>A title</h1>{text}<div class=sidebar>{TALK}</div></{start.split()[0]}>{rest}"
        assert html_extraction.main_blocks(page) == ["A title", BODY.strip()], start
    for page in (f"<div class='content sidebar-right'>{text}</div>{rest}", f"<div class='page sidebar-right'><article>{text}</article></div>", f"<div class='page with-sidebar'>{text}</div>"):
        assert html_extraction.main_blocks(page) == [BODY.strip()], page[:80]
    small = "<form><label>Name</label><input></form>"
    for inside in (text, f"<article>{text}</article>", f"<div class=content>{text}</div>"):
        assert html_extraction.main_blocks(f"<form id=aspnetForm><nav>Home</nav>{inside}</form>") == [BODY.strip()]
        assert html_extraction.main_blocks(f"{inside}{small}") == [BODY.strip()]


def test_raw_elements_after_letters_that_grow_in_lower_case():
    assert html_extraction.main_blocks(f"<p>{'İ' * 20}.</p><SCRIPT>var a='<p>';</Script><p>Short.</p><style>x</STYLE><p>Last.</p>") == ["İ" * 20 + ".", "Short.", "Last."]
    assert html_extraction.main_blocks("<p>a.</p><style>x</ſtyle><p>b.</p></style><p>c.</p>") == ["a.", "c."]


PARA = "The ferry leaves at noon and comes back in the evening, unless the wind is too strong for it. "
#: Pages by hand: blocks of main text are written with a leading +, others with -.
LABELLED = [
    "<article><h1>+Ferries of the north</h1><p>+{p}</p><p>+Hm</p><p>+{p}</p><p>+Yes</p><p>+{p}</p></article><nav><a href=1>-Home</a></nav>",
    "<main><p>+{p}</p><p><a href=1>+See the timetable here</a></p><p>+{p}</p></main><div><a href=1>-Other news of today</a></div>",
    "<div><ul><li><a href=1>-News</a><li><a href=2>-Sport</a><li><a href=3>-Culture</a></ul></div><div><p>+{p}</p><p>+So</p><p>+{p}</p></div><div><a href=1>-More of this</a><a href=2> and that</a></div>",
    "<article><p>+{p}</p><ul><li>+eggs<li>+milk<li>+salt</ul><p>+{p}</p><div class=ad>-Buy now, {p}</div><p>+{p}</p></article><footer>-(c)</footer>",
    "<div class=content><p>+{p}</p><blockquote><p>+No</p></blockquote><p>+{p}</p></div><div class=comments><p>-{p}</p><p>-Ok</p></div>",
    "<div class=content><p>+{p}</p></div><div><p>-Weather</p><p><a href=2>-Rain in the west today</a></p></div>",
]


def test_cut_mends_labels():
    alone = cut = 0
    for page in LABELLED:
        blocks, elements = html_extraction.parse(page.format(p=PARA))
        kept = html_extraction.main_blocks(page.format(p=PARA))
        cost = html_extraction.costs(blocks, elements)
        assert all(abs(c) < 20 for c in cost)  # no cost is beyond what others can outweigh
        for b, c in zip(blocks, cost, strict=True):
            wanted = b.text[0] == "+"
            alone += (c > 0) != wanted
            cut += (b.text in kept) != wanted
    assert cut == 0 and alone >= 5


def test_deep_pages_take_linear_time():
    began = time.process_time()
    for page in ("<div>x" * 40_000, "<blockquote>x" * 40_000 + "</section>" * 40_000, "<div><p>x</p>" * 20_000):
        assert len(html_extraction.main_blocks(page)) in (20_000, 40_000)
    assert time.process_time() - began < 20


def test_cut_is_minimal():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randrange(1, 9)
        cost = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.4]
        price = lambda side: sum(max(c, 0) * (not s) + max(-c, 0) * s for c, s in zip(cost, side, strict=True)) + sum(w for a, b, w in edges if side[a] != side[b])  # noqa: E731, B023
        best = min(price(s) for s in itertools.product((False, True), repeat=n))
        assert abs(price(html_extraction.minimum_cut(cost, edges)) - best) < 1e-6


def tree_steps(a, b):
    """Steps between two elements through the tree, by the chains of those that they stand in."""
    chains = []
    for e in (a, b):
        chain = []
        while e is not None:
            chain.append(id(e))
            e = e.parent
        chains.append(chain[::-1])
    shared_part = sum(1 for _ in itertools.takewhile(lambda pair: pair[0] == pair[1], zip(*chains, strict=False)))
    return len(chains[0]) + len(chains[1]) - 2 * shared_part


def cheapest_labels(page):
    """Texts that every cheapest labelling of a small page keeps, by trying all labellings."""
    blocks, elements = html_extraction.parse(page)
    cost = html_extraction.costs(blocks, elements)
    links = [(k - 1, k, html_extraction.NEXT) for k in range(1, len(blocks))]
    for k, b in enumerate(blocks):
        same = [j for j in range(k) if blocks[j].element.parent is b.element.parent]
        links += [(same[-1], k, html_extraction.SIBLING)] if same else []
    links = [(a, b, w / (1 + tree_steps(blocks[a].element, blocks[b].element))) for a, b, w in links]

    def price(side):
        away = sum(c for c, kept in zip(cost, side, strict=True) if c > 0 and not kept) - sum(c for c, kept in zip(cost, side, strict=True) if c < 0 and kept)
        return away + sum(w for a, b, w in links if side[a] != side[b])

    labellings = list(itertools.product((False, True), repeat=len(blocks)))
    least = min(map(price, labellings))
    best = [s for s in labellings if price(s) < least + 1e-9]
    return [[b.text for b, kept in zip(blocks, side, strict=True) if kept] for side in best]


def test_extraction_against_all_labellings(spark):
    """Pages put together at random from the hand-labelled ones' parts: the operator keeps what the cheapest labelling keeps."""
    rng = random.Random(11)
    parts = ["<h1>Ferries</h1>", f"<p>{PARA}</p>", "<p>Hm</p>", "<p><a href=1>See the timetable here</a></p>", "<ul><li>eggs<li>milk</ul>", f"<div class=ad>Buy now, {PARA}</div>", "<blockquote><p>No</p></blockquote>", "<p>Rain <a href=2>in the west</a></p>"]
    wraps = ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>", "<div class=content>{}</div>", "<div class=comments>{}</div>", "<nav>{}</nav>", "<section><div>{}</div></section>"]
    pages = []
    while len(pages) < 120:
        page = "".join(rng.choice(wraps).format("".join(rng.choices(parts, k=rng.randrange(1, 5)))) for _ in range(rng.randrange(1, 4)))
        if 2 <= len(html_extraction.parse(page)[0]) <= 11:
            pages.append(page)
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").withColumn("url", F.lit("u"))
    texts = {r.page_id: r.text for r in html_extraction.extract_text(df).collect()}
    assert len(texts) == len(pages)
    for k, page in enumerate(pages):
        assert texts[k] in [" ".join(kept) for kept in cheapest_labels(page)], page


class PlainPage(HTMLParser):
    """Blocks of text outside of the elements that the given pages use for boilerplate, by the standard library's parser."""

    VOID, AWAY = {"br", "meta", "img", "input", "link", "hr"}, {"nav", "footer", "header", "aside", "script", "style", "title", "form"}
    INLINE = {"a", "b", "i", "em", "strong", "span", "u", "code"}

    def __init__(self):
        super().__init__()
        self.blocks, self.text, self.away = [], "", []

    def end_block(self):
        self.blocks += [" ".join(self.text.split())] if self.text.strip() else []
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += " " * (not self.away)
        elif tag not in self.VOID | self.INLINE:
            self.end_block()
        if tag not in self.VOID and (self.away or tag in self.AWAY or dict(attrs).get("class") == "ad"):
            self.away.append(tag)

    def handle_endtag(self, tag):
        if tag not in self.VOID | self.INLINE:
            self.end_block()
        if tag in self.away:
            while self.away.pop() != tag:
                pass

    def handle_data(self, data):
        self.text += data if not self.away else ""


def test_query_against_another_parser(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in registry.QUERIES["op1_html_extraction"](spark, SF).collect()}
    assert len(got) == len(pages)
    for page in pages:
        plain = PlainPage()
        plain.feed(page.html or "")
        plain.close()
        plain.end_block()
        r = got[page.page_id]
        assert (r.url, r.text, r.n_chars) == (page.url, " ".join(plain.blocks), len(" ".join(plain.blocks)))


def test_extract_operator(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", "<article>" + "<p>a b.</p>" * 3000, "x")], "page_id long, url string, html string, text string")
    got = html_extraction.extract_text(df).collect()
    assert len(got) == 5 and [r.n_chars for r in got if r.page_id == 2] == [0] and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 3] == [" ".join(["a b."] * 3000)]
    assert html_extraction.extract_text(df.limit(0)).count() == 0


# -- media ----------------------------------------------------------------------------------------------------------


def test_media(spark):
    got = media.media_columns(docs(spark)).collect()
    assert len(got) == len(ROWS)
    for r in got:
        data = next((t or "") for i, t in ROWS if i == r.doc_id).encode()
        payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        assert (r.n_bytes, r.payload_bytes) == (len(data), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert r.media_sha256 == hashlib.sha256(media.to_wav(payload)).hexdigest() and media.from_wav(media.to_wav(payload)) == payload
        assert len(r.pair_times) == len(r.pair_codes) and r.pair_times == sorted(r.pair_times)
    long = {r.doc_id: r for r in got}
    assert long[6][1:] == long[7][1:] and long[6].pair_codes
    assert media.media_columns(docs(spark, [])).count() == 0


def test_peaks_do_not_depend_on_blocks(monkeypatch):
    data = np.random.default_rng(0).integers(32, 122, 20_000).astype(np.uint8).tobytes()
    whole = media.peaks(data)
    monkeypatch.setattr(media, "BLOCK", 7)
    for a, b in zip(whole, media.peaks(data), strict=True):
        assert (a == b).all()


def test_tone_has_its_peak():
    tone = np.tile(np.round(128 + 100 * np.sin(2 * np.pi * np.arange(8) / 8)).astype(np.uint8), 512).tobytes()
    at, bins = media.peaks(tone)
    assert all(32 in bins[at == frame] for frame in range(1, 30))


# -- shards ---------------------------------------------------------------------------------------------------------


def test_hilbert_curve_is_a_walk_through_all_cells():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = hilbert_shards.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def check_shards(rows, n, shards=24):
    assert len(rows) == n
    counts = [sum(r.shard == s for r in rows) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_shards(spark):
    got = hilbert_shards.hilbert_shards(docs(spark)).collect()
    check_shards(got, len(ROWS))
    for r in got:
        text = next((t or "") for i, t in ROWS if i == r.doc_id).encode()
        assert r.size == len(text) + 8 and r.text_crc32 == zlib.crc32(text) and r.law == "rows" and r.grown_shard is None
    check_shards(registry.QUERIES["op4_hilbert_shards"](spark, SF).collect(), 200)
    assert hilbert_shards.hilbert_shards(docs(spark, [])).count() == 0


def test_shards_prune(spark):
    """A shard covers few values of a dimension that the curve orders by."""
    rows = [(k, f"{'x' * (k % 97)}") for k in range(2000)]
    got = hilbert_shards.hilbert_shards(docs(spark, rows), dims=("size", "doc_id"))
    spread = got.groupBy("shard").agg((F.max("size") - F.min("size")).alias("s"), (F.max("doc_id") - F.min("doc_id")).alias("d")).agg(F.avg("s"), F.avg("d")).first()
    assert spread[0] < 60 and spread[1] < 1000


def test_shard_order_against_brute_force(spark):
    """Cells by plain comparison with the cuts, the curve step by step, the law of rows by counting."""
    d = spark.read.parquet(f"{SF}/documents.parquet").withColumn("moment", F.timestamp_seconds(F.col("n_chars") * 1000)).withColumn("ratio", F.col("n_chars") / 7)
    d = d.withColumn("host", F.concat(F.lit("https://example.org/"), "source", F.col("doc_id") % 9))
    dims = ("host", "ratio", "moment", "size")
    seen = []
    real = hilbert_shards.cuts
    hilbert_shards.cuts = lambda rows, columns: seen.append(real(rows, columns)) or seen[-1]
    try:
        got = {r.doc_id: r for r in hilbert_shards.hilbert_shards(d, dims).collect()}
    finally:
        hilbert_shards.cuts = real
    bounds = seen[0]
    assert len(bounds[0]) > 20  # the common head of all hosts doesn't make them one cell
    walk = {}
    cells = {}
    for r in d.collect():
        values = (r.host, r.ratio, r.n_chars * 1000 * 1e6, len((r.text or "").encode()) + 8)
        cells[r.doc_id] = tuple(sum(v >= b for b in bound) for v, bound in zip(values, bounds, strict=True))
    for doc, cell in cells.items():
        walk[doc] = hilbert_shards.hilbert_index(np.array([cell]), hilbert_shards.BITS)[0]
        assert got[doc].curve == walk[doc]
    order = sorted(got, key=lambda k: (walk[k], got[k].text_crc32, k))
    for g, doc in enumerate(order):
        shard = g * 24 // len(order)
        assert (got[doc].shard, got[doc].slot) == (shard, sum(1 for j in range(g) if j * 24 // len(order) == shard))


def brute_pairs(samples):
    """Peaks and pairs by plain loops over a discrete Fourier transform."""
    x = list(samples)
    n = max(1, -(-(len(x) - media.FRAME) // media.HOP) + 1)
    x += [128] * ((n - 1) * media.HOP + media.FRAME - len(x))
    waves = np.exp(-2j * np.pi * np.outer(np.arange(media.FRAME // 2 + 1), np.arange(media.FRAME)) / media.FRAME)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(media.FRAME) / (media.FRAME - 1))
    power = [np.round(np.abs(waves @ ((np.array(x[f * media.HOP : f * media.HOP + media.FRAME]) - 128.0) * window)), 2) for f in range(n)]
    found = []
    for f in range(n):
        here = power[f]
        tops = []
        for k in range(1, len(here) - 1):
            beside = [power[g][k] for g in (f - 1, f + 1) if 0 <= g < n]
            if here[k] > here[k - 1] and here[k] > here[k + 1] and all(here[k] >= v for v in beside) and here[k] > 0:
                tops.append((-here[k], k))
        found += [(f, k) for k in sorted(k for _, k in sorted(tops)[: media.PEAKS])]
    out = []
    for i, (f, k) in enumerate(found):
        for g, j in found[i + 1 : i + 1 + media.FAN]:
            if g - f <= media.SPAN:
                out.append((f, (k << 16) | (j << 8) | (g - f)))
    return sorted(out)


def test_media_query_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = registry.QUERIES["op3_media_columns"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        data = texts[r.doc_id].encode()
        payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-64:])
        listed = " ".join(f"{t}:{c}" for t, c in zip(r.pair_times, r.pair_codes, strict=True))
        assert r.feature == f"{len(r.pair_codes)}:{hashlib.sha256(listed.encode()).hexdigest()}"
        if r.doc_id % 20 == 0 and len(data) < 4000:
            assert list(zip(r.pair_times, r.pair_codes, strict=True)) == brute_pairs(payload)


# -- reply trees ----------------------------------------------------------------------------------------------------


def test_templates_are_reversible(spark):
    nasty = ["\\### Assistant: </turn> ok", "\\l<g>\\b", "<turn user>", "</turn>\n", "\\", "", "a\\\\lb", "漢<😀>"]
    nodes = spark.createDataFrame([(1, k, k - 1 if k else None, "us<er>" if k % 2 else "assistant", t, 1) for k, t in enumerate(nasty)], "tree_id long, node_id long, parent_id long, role string, text string, score long")
    out = reply_trees.format_reply_trees(nodes)
    row = out.withColumn("t", reply_trees.read_turns(F.col("formatted"))).first()
    assert [t.text for t in row.t] == nasty and [t.role for t in row.t] == ["us<er>" if k % 2 else "assistant" for k in range(8)]
    for k, (start, size) in enumerate(zip(row.loss_starts, row.loss_lengths, strict=True)):
        shown = row.formatted[start : start + size]
        assert shown == ("" if k % 2 else nasty[k].replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g"))


def test_branches_of_trees(spark):
    schema = "tree_id long, node_id long, parent_id long, role string, text string, score long, tree string, depth int"
    rows = [(1, 1, None, "user", "q", 0), (1, 2, 1, "assistant", "a", 5), (1, 3, 1, "assistant", "b", 9), (1, 4, 2, "user", "c", 9), (1, 5, 3, "user", "d", None)]
    rows += [(1, 5, 3, "user", "d", None)]  # a repeated row
    rows += [(2, 1, 9, None, None, 1), (2, 2, 1, "assistant", "x", 1)]  # the parent isn't there
    rows += [(3, 1, 2, "user", "c1", 1), (3, 2, 1, "user", "c2", 1)]  # a cycle
    rows += [(None, 1, None, "user", "n", 1)]
    nodes = spark.createDataFrame([(*r, "x", 0) for r in rows], schema)
    paths = {}
    for r in reply_trees.reply_paths(nodes, branches=2).collect():
        paths.setdefault((r.tree_id, r.branch), []).append((r.depth, r.text))
    assert {k: [t for _, t in sorted(v)] for k, v in paths.items()} == {(1, 1): ["q", "a", "c"], (1, 2): ["q", "b", "d"], (2, 1): ["", "x"], (None, 1): ["n"]}
    assert reply_trees.format_reply_trees(nodes.limit(0)).count() == 0


def test_deep_tree(spark):
    nodes = spark.range(300).select(F.lit(1).alias("tree_id"), F.col("id").alias("node_id"), F.nullif(F.col("id") - 1, F.lit(-1)).alias("parent_id"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"), F.lit(1).alias("score"))
    row = reply_trees.format_reply_trees(nodes).withColumn("t", reply_trees.read_turns(F.col("formatted"))).first()
    assert [t.text for t in row.t] == [str(k) for k in range(300)]


def brute_paths(rows, branches):
    """(tree, leaf, branch, depth, text) of the best paths, by walking up from every leaf."""
    trees, out = {}, set()
    for tree, node, parent, _, _, score in rows:
        trees.setdefault(tree, {})[node] = (parent, score)
    for tree, nodes in trees.items():
        parents = {p for p, _ in nodes.values()}
        found = []
        for leaf in nodes.keys() - parents:
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if at not in path:
                found.append((-sum(nodes[n][1] for n in path), leaf, path[::-1]))
        for branch, (_, leaf, path) in enumerate(sorted(found)[:branches], 1):
            out |= {(str(tree), leaf, branch, depth, str(node)) for depth, node in enumerate(path, 1)}
    return out


def test_forests_against_brute_force(spark, monkeypatch):
    """Long and short runs, branches, lost parents, cycles, identifiers in any order; few nodes in a stretch, so paths cross many."""
    monkeypatch.setattr(reply_trees, "STRETCH", 5)
    rng = random.Random(8)
    rows = [(90, 1, 2, "u", "1", 1), (90, 2, 1, "u", "2", 1), (90, 3, 2, "u", "3", 1), (90, 7, None, "u", "7", 0)]
    for tree in range(8):
        n = rng.randint(1, 70)
        ids = list(range(n))
        if tree % 2:
            rng.shuffle(ids)
        for k in range(n):
            parent = None if k == 0 else ids[k - 1] if rng.random() < 0.7 else ids[rng.randrange(k)]
            rows.append((tree, ids[k], 1000 + k if rng.random() < 0.05 else parent, "u", str(ids[k]), rng.randint(0, 9)))
    nodes = spark.createDataFrame(rows, "tree_id long, node_id long, parent_id long, role string, text string, score long").repartition(3)
    assert {(r.tree, r.leaf, r.branch, r.depth, r.text) for r in reply_trees.reply_paths(nodes, 2).collect()} == brute_paths(rows, 2)
    # identifiers that aren't numbers have no neighbours
    named = nodes.withColumns({c: F.concat(F.lit("n"), F.lpad(c, 4, "0")) for c in ("node_id", "parent_id")})
    got = {(r.tree, int(r.leaf[1:]), r.branch, r.depth, r.text) for r in reply_trees.reply_paths(named, 2).collect()}
    assert got == brute_paths(rows, 2)


def test_joins_place_every_node_of_the_conversations(spark):
    """Nothing but self-joins leads from a turn to its root: every node that has one above it is in a jump, at every power of two."""
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    base = shared.written(reply_trees.nodes_of(reply_trees.as_nodes(table.select("conv_id", "turn", "role", "text"))), "test-nodes")
    turns = {}
    for r in base.collect():
        turns.setdefault(r.tree, []).append(r.node)
    levels = reply_trees.climb(base)
    assert len(levels) == (max(map(len, turns.values())) - 1).bit_length()
    for step, level in enumerate(levels):
        got = {(r.tree, r.node): r.anc for r in level.collect()}
        assert got == {(tree, sorted(n)[k]): sorted(n)[k - 2**step] for tree, n in turns.items() for k in range(2**step, len(n))}
    leaves = {r.tree: (r.leaf, r.depth) for r in reply_trees.ranked_leaves(base, levels).collect()}
    assert leaves == {tree: (max(n), len(n)) for tree, n in turns.items()}


def test_long_conversation_takes_rounds_by_the_logarithm(spark):
    turns = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    spark.sparkContext.setJobGroup("long", "one long conversation")
    try:
        row = reply_trees.format_reply_trees(reply_trees.as_nodes(turns)).select(reply_trees.read_turns(F.col("formatted")).alias("t")).first()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [t.text for t in row.t] == [str(k) for k in range(3000)]
    # 12 doublings, 12 climbs and 12 expansions, each of a few jobs; not one for each turn
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("long")) < 12 * 3 * 5


# -- queries and pipeline -------------------------------------------------------------------------------------------


def test_queries_match_sql(spark, duck):
    for name, sql in registry.ORACLE_SQL.items():
        same_rows(registry.QUERIES[name](spark, SF), duck.sql(sql))


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))


def test_pipeline_keeps_mixed_texts(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.lang: r.text for r in d.filter("n_chars BETWEEN 400 AND 900").collect()}
    parts = [" ".join(texts[lang].split()).encode()[:n].decode("utf-8", "ignore") for lang, n in (("en", 360), ("de", 300), ("fr", 300))]
    mixed = spark.createDataFrame([(10**9, " ".join(parts), "en", "s", 0), (10**9 + 1, "12 -- 34", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    both = d.unionByName(mixed.select([F.col(f.name).cast(f.dataType) for f in d.schema]))
    score = language_id.identify(both, language_id.train(both, F.lit(True))).filter(f"doc_id = {10**9}").first().score
    assert 0 < score < 0.5
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, both, SF).select("doc_id").collect()}
    assert 10**9 in kept and 10**9 + 1 not in kept


def test_pipeline(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    kept = d
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF).cache()
        assert after.columns == d.columns
        before, left = {r.doc_id for r in kept.collect()}, {r.doc_id for r in after.collect()}
        assert left <= before and len(left) > 0.7 * len(before)
        kept = after
    texts = [r.text for r in kept.collect()]
    assert len({" ".join(t.split()) for t in texts}) == len(texts)
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.collect()}
    nulls = docs(spark).select(d.columns)
    for _, stage in corpus_pipeline.STAGES:
        nulls = stage(spark, nulls, SF)
        nulls.count()
    empty = docs(spark, []).select(d.columns)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0


def test_pipeline_against_brute_force(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {i: t for i, t in rows.items() if any(unicodedata.category(c)[0] == "L" for c in t or "")}
    first = {}
    for i in sorted(rows):
        first.setdefault(normal(rows[i]), i)
    rows = {i: rows[i] for i in first.values()}
    rows = {i: rows[i] for i, _, head in brute_components(list(rows.items()), 80, 5) if i == head or head is None}
    check_pieces(corpus_pipeline.run(spark, SF).collect(), rows)
