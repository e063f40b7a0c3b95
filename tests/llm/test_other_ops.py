"""Operators on pages, embeddings and conversations against brute force; the pipeline; the registered SQL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import spark_rows, sql_rows
from tidemark.llm import components, html_text, mixture, queries, quote_links, topk_search, url_filter


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert spark_rows(queries.QUERIES[name](spark, sf_dir)) == sql_rows(queries.ORACLES[name], sf_dir)


PAGES = [
    ("<article><h1>A &amp; B</h1><p><b>one  two<br><p>three&nbsp;four</p></article><footer>f</footer>", "A & B\none two\nthree four"),
    ("<nav><ul><li>x</ul></nav><div class='ad'>buy</div><article><p>To.</p></article>", "To."),
    ("<html><body><header><h1>Site</h1></header><div id='menu'>Home</div><div class='content'><h2>Title</h2><p>Hello <i>big</i> world, this is it.<script>x<y</script> End<ul><li>one<li>two</ul></div><div class='comments'><p>nice post</p></div><form><p>n</p></form></body>", "Title\nHello big world, this is it. End\none\ntwo"),
    ("<main>a<aside>b</aside> c <!-- d --><style>e{}</style><div role=alert>g</div></main>", "a\nc"),
    ("<article><p>cut off <a hre", "cut off"),
    ("<article><p>a < b &lt; c</p></article>", "a < b < c"),
    ("plain text", "plain text"), ("", ""), (None, ""), ("<p></p>", ""), ("<article></article>", ""),
    ("<article><p>x</p><article class='comment'><p>reply</p></article></article>", "x"),
    ("<article>" + "<p>long text, with stops.</p>" * 3000 + "</article>", "\n".join(["long text, with stops."] * 3000)),
]


def test_html_text(spark):
    rows = [(i, "u", h, "old") for i, (h, _) in enumerate(PAGES)] + [(None, None, PAGES[0][0], "old")]
    df = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in df.collect()}
    for i, (_, want) in enumerate(PAGES):
        assert got[i] == (want, len(want)), PAGES[i][0][:80]
    assert got[None][0] == PAGES[0][1]
    assert html_text.extracted(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


BODY = "<p>" + "A long sentence, with words and stops. " * 12 + "</p>"
LINKS = "<div><ul>" + "".join(f"<li><a>Link {i}</a></li>" for i in range(8)) + "</ul></div>"
MARKS = [  # page, lines of the body, whether other text is kept
    ("<div>" + BODY * 4 + "</div>" + LINKS, 4, []),
    ("<div class='content'>" + BODY * 4 + "</div>" + "".join(f"<article><h3>Card {i}</h3><p>Read more on this.</p></article>" for i in range(5)), 4, []),
    ("<main><div>" + BODY * 4 + "</div>" + LINKS + "</main>", 4, []),
    ("<main><div>" + BODY * 4 + "</div>" + "".join(f"<article><h3>Card {i}</h3><p>Read more on this.</p></article>" for i in range(5)) + "</main>", 4, []),
    ("<article><h1>Title of this</h1><div>" + BODY * 4 + "</div></article>", 4, ["Title of this"]),
    ("<article><section><h2>One</h2>" + BODY * 4 + "</section><section><h2>Two</h2>" + BODY + "</section><section><h2>Three</h2><p>Short end, here.</p></section></article>", 5, ["One", "Two", "Three", "Short end, here."]),
    ("<article><p>The lead, first.</p><div>" + BODY * 3 + "<ul><li>point one<li>point two</ul></div></article>", 3, ["The lead, first.", "point one", "point two"]),
]


@pytest.mark.parametrize("page, body, others", MARKS)
def test_html_marks_compete_by_ratio(page, body, others):
    got = html_text.main_text(page).split("\n")
    assert [x for x in got if not x.startswith("A long")] == others and len(got) == body + len(others)


def brute_kept(blocks):
    """Ratio by path, smoothing along the page, fusion by container and threshold, block by block in plain Python."""
    def spread(values):
        mean = sum(values) / len(values)
        return math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))

    size = [len(b.text) for b in blocks]
    stops = [sum(c in ".,;:!?…。，、！？" for c in b.text) for b in blocks]
    ratio = []
    for b in blocks:
        same = [i for i, x in enumerate(blocks) if x.path == b.path]
        ratio.append(sum(size[i] for i in same) / len(same) * (1 + sum(stops[i] for i in same) / len(same)))
    smooth = [(ratio[max(i - 1, 0)] + 2 * ratio[i] + ratio[min(i + 1, len(ratio) - 1)]) / 4 for i in range(len(ratio))]
    weight = {}
    for i, b in enumerate(blocks):
        weight[b.part or b.container] = weight.get(b.part or b.container, 0) + smooth[i] * size[i]
    means = {}
    for c in {b.container for b in blocks}:
        mine = [i for i, b in enumerate(blocks) if b.container == c]
        means[c] = sum(smooth[i] * size[i] for i in mine) / sum(size[i] for i in mine)
    kept = []
    for b in blocks:
        ok = weight[b.part or b.container] * (2 if b.part else 1) >= spread(list(weight.values()))
        if b.part:
            ok = ok and means[b.container] * 2 >= spread([means[c] for c in {x.container for x in blocks if x.part == b.part}])
        kept.append(ok)
    return kept


def test_html_ratios_against_brute_force():
    rng = np.random.default_rng(11)
    words = ["rain", "the,", "river.", "a", "town!", "Flooded"]
    decided = 0
    for _ in range(150):
        page, opened = [], []
        for _ in range(int(rng.integers(3, 40))):
            kind = rng.integers(0, 10)
            if kind < 2:
                opened.append(str(rng.choice(["div", "section", "article", "main", "ul"])))
                page.append(f"<{opened[-1]}>")
            elif kind < 4 and opened:
                page.append(f"</{opened.pop()}>")
            else:
                tag = str(rng.choice(["p", "li", "h2", "span"]))
                page.append(f"<{tag}>{' '.join(rng.choice(words, int(rng.integers(1, 40))))}</{tag}>")
        blocks = html_text.blocks_of("".join(page))
        if blocks:
            got, want = html_text.kept_blocks(blocks).tolist(), brute_kept(blocks)
            assert got == want
            decided += not all(want)
    assert decided > 30


@pytest.mark.parametrize("page, want", [
    ('<div class="content no-sidebar"><p>Text of it, here.</p></div>', "Text of it, here."),
    ('<article class="has-header ad-free"><div class="post-header"><h1>Title</h1></div><p>Body text, long enough.</p></article>', "Title\nBody text, long enough."),
    ('<article><p>Body text, here.</p><div class="related-posts">x</div><div id="share_buttons">y</div><p class="related-work">z z.</p></article>', "Body text, here.\nz z."),
    ("<center>" * 20_000 + "<p>deep, text.</p>" + "</b>" * 20_000, "deep, text."), ("<p>" + "one long block, of text. " * 40_000 + "</p>", ("one long block, of text. " * 40_000).strip()),
])
def test_html_names_count_as_a_whole(page, want):
    assert html_text.main_text(page) == want


def brute_search(rows, k=20):
    whole = [(i, [math.floor(64 * float(np.float32(c))) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = set()
    for q, a in whole:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def test_topk_search(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CELL", 40)
    monkeypatch.setattr(topk_search, "QUERIES", 3)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.3, 40).round(3).tolist()) for i in range(130)]
    rows += [(200 + i, [0.5] * 40) for i in range(30)]  # ties
    rows += [(300, None), (301, [None] * 40), (302, [float("nan")] * 40), (303, [float("inf")] * 40), (None, [0.1] * 40), (305, [0.4] * 7), (320, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, v string")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk_search.top_k(df).collect()}
    assert got == brute_search(rows)
    few = spark.createDataFrame(rows[:5], "vec_id long, embedding array<float>")
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk_search.top_k(few).collect()} == brute_search(rows[:5])
    assert topk_search.top_k(few.limit(0)).collect() == []


def test_topk_search_of_large_numbers():
    q, x = np.array([[2**40], [3]]), np.array([[2**20, 2**20 + 1, 5], [1, 2, 3]])
    got = topk_search.search(np.array([0]), q, np.array([1, 2, 3]), x, 2)
    assert got == [(0, 0, 2, 2**40 * (2**20 + 1) + 6), (0, 0, 1, 2**60 + 3)]


def test_topk_search_passes_cells_over():
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (8, 60))
    floors = np.array([1e6, -np.inf])
    got = topk_search.search(np.array([1000, 1001]), x[:, :2].copy(), np.arange(60), x, 3, floors)
    assert {r[0] for r in got} == {1} and floors[0] == 1e6 and floors[1] == got[-1][3]
    assert [r[3] for r in got] == sorted((x[:, 1] @ x).tolist(), reverse=True)[:3]


def test_topk_search_of_repeated_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CELL", 7)
    monkeypatch.setattr(topk_search, "QUERIES", 2)
    rows = [(i % 21, [0.25 * (i % 3), -0.5, 1.0 + i % 5]) for i in range(63)] + [(20, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk_search.top_k(df, k=4).collect())
    whole = [(i, [math.floor(64 * c) for c in v]) for i, v in rows]
    want = []
    for q in (0, 20):
        mine = {tuple(v) for i, v in whole if i == q}
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for v in mine for i, w in whole if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:4])]
    assert got == want


HOSTS = ["", "org", "example.org", "a.example.org", "org.", "com", "x.com", "example.org.com", "xexample.org", "user@example.org", "example.org:80"]
PATHS = ["", "/", "/es", "/es/", "/es/x", "/en/1", "/en/12/3", "/en/", "/fr/", "/fr", "/de/x", "//", "/en/1/", "/x/es/"]
MORE = [*url_filter.RULES, ("block", "com", "/fr/a"), ("allow", "x.com", "/de/x/y"), ("block", "x.com", ""), ("allow", "org", "/"), ("block", "org", "/")]


def brute_rule(rules, host, path):
    fits = [((rh.count("."), len(rp), v == "block"), rh + rp, v) for v, rh, rp in rules if (host == rh or host.endswith("." + rh)) and path.startswith(rp)]
    return max(fits)[1:] if fits else (None, None)


@pytest.mark.parametrize("rules", [url_filter.RULES, MORE])
def test_url_trie(rules):
    trie = url_filter.build(rules)
    assert [(h, p) for h in HOSTS for p in PATHS if url_filter.match(trie, h, p) != brute_rule(rules, h, p)] == []


def test_url_filter(spark, monkeypatch):
    urls = ["http://A.Example.ORG/es/x?y#z", "no scheme", None, "", "x://", "https://x.com", "https://x.com?q=/fr/", "ftp://u@x.com/fr/a://b", "http://a.example.org/en/1\n2"]
    urls += [f"http://{h}{p}" for h in HOSTS for p in PATHS]
    pages = spark.createDataFrame([(i % 7 or None, u, "v") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(MORE, "verdict string, host string, path string")
    seen = lambda: sorted(map(tuple, url_filter.filtered(pages, rules).collect()), key=repr)
    by_trie = seen()
    monkeypatch.setattr(url_filter, "TRIE_RULES", 0)
    assert seen() == by_trie
    want = []
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut], rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        rule, verdict = brute_rule(MORE, host, path)
        want.append((i % 7 or None, u, host, path, rule, verdict or "allow"))
    assert by_trie == sorted(want, key=repr)


TALK = [
    (1, 0, "user", "Hello World\nSecond line"), (1, 1, "assistant", "> hello   world\nHi there"),
    (1, 2, "user", "On Mon, X wrote:\n>> Hello world\n> Hi there\n\nThanks\n> unknown"), (1, 3, "a", "plain"), (1, 4, "a", "> Second Line\n> thanks\nok"),
    (1, 5, "b", "> thanks\nfine"), (None, 0, "u", None), (None, 5, "u", "> x\ny"), (2, 1, "a", "> Hello World"), (3, None, "a", "no turn"), (3, 1, "a", ""), (3, 1, "b", "> no turn\nz"),
    (4, 1, "a", "same words"), (4, 2, "a", "equal rows"), (4, 2, "a", "equal rows"), (4, 3, "b", "> same words\n>> none of it\nyes " + "long " * 30_000),
]


def test_quote_links(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in TALK], "conv_id long, turn long, role string, text string, position int, before int")
    got = sorted(((r["conv_id"], r["turn"], r["role"], r["position"], r["reply_to"], r["by_quote"], r["levels"], r["n_quoted"], r["n_found"], r["text"]) for r in quote_links.linked(df).collect()), key=repr)
    assert got == sorted([
        (1, 0, "user", 0, None, False, 0, 0, 0, "Hello World\nSecond line"), (1, 1, "assistant", 1, 0, True, 1, 1, 1, "Hi there"), (1, 2, "user", 2, 1, True, 2, 3, 2, "Thanks"),
        (1, 3, "a", 3, 2, False, 0, 0, 0, "plain"), (1, 4, "a", 5, 0, True, 1, 2, 1, "ok"), (1, 5, "b", 4, 2, True, 1, 1, 1, "fine"),
        (None, 0, "u", 0, None, False, 0, 0, 0, ""), (None, 5, "u", 1, 0, False, 1, 1, 0, "y"),
        (2, 1, "a", 0, None, False, 1, 1, 0, ""), (3, None, "a", 0, None, False, 0, 0, 0, "no turn"), (3, 1, "a", 1, None, False, 0, 0, 0, ""), (3, 1, "b", 2, 1, False, 1, 1, 0, "z"),
        (4, 1, "a", 0, None, False, 0, 0, 0, "same words"), (4, 2, "a", 1, 1, False, 0, 0, 0, "equal rows"), (4, 2, "a", 2, 2, False, 0, 0, 0, "equal rows"),
        (4, 3, "b", 3, 1, True, 2, 2, 1, ("yes " + "long " * 30_000).rstrip()),
    ], key=repr)
    assert quote_links.linked(df.limit(0)).collect() == []


def test_passages():
    lines = quote_links.levels_of("On Mon, X wrote:\r\n> A  b\n> c\n>\n>> d e\n> f\nown\n\nOther  one")
    assert [level for level, _ in lines] == [-1, 1, 1, 1, 2, 1, 0, 0, 0]
    got = {(level, text): at for level, text, at in quote_links.passages(lines)}
    assert got == {
        (1, "a b c"): [1, 2], (1, "a b"): [1], (2, "d e"): [4], (1, "f"): [5], (1, "a b c f"): [1, 2, 5],
        (0, "own other one"): [6, 8], (0, "own"): [6], (0, "other one"): [8],
    }


def brute_links(rows):
    """Parents by votes, and the reply order by a walk through the tree, of one conversation (turn, text), turns all different."""
    units = [[(level, text) for level, text, _ in quote_links.passages(quote_links.levels_of(t))] for _, t in rows]
    parent = []
    for i in range(len(rows)):
        votes = {}
        for level, text in units[i]:
            at = max((j for j in range(i) if level and (level - 1, text) in units[j]), default=None)
            if at is not None:
                votes[at] = votes.get(at, 0) + len(text.split())
        parent.append(max(votes, key=lambda j: (votes[j], j)) if votes else i - 1)
    order, stack = [], [0]
    while stack:
        i = stack.pop()
        order.append(i)
        stack += [j for j in range(len(rows) - 1, i, -1) if parent[j] == i]
    return parent, order


@pytest.mark.parametrize("seed, quotes", [(3, 3), (4, 2), (5, 5)])
def test_quote_links_against_a_walk_through_the_tree(spark, monkeypatch, seed, quotes):
    monkeypatch.setattr(quote_links, "TURNS", 4)
    rng = np.random.default_rng(seed)
    talks = {}
    for conv in (7, 8):
        talks[conv] = []
        for turn in range(110):
            lines = [f"line {rng.integers(0, 40)}"] + [">" * int(rng.integers(1, 3)) + f" line {rng.integers(0, 40)}" for _ in range(int(rng.integers(0, quotes)))]
            talks[conv].append((turn * 3, "\n".join(lines)))
    df = spark.createDataFrame([(c, t, "u", x) for c, rows in talks.items() for t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["position"], r["reply_to"]) for r in quote_links.linked(df).collect()}
    moved = 0
    for conv, rows in talks.items():
        parent, order = brute_links(rows)
        place = {i: n for n, i in enumerate(order)}
        moved += sum(place[i] != i for i in place)
        assert got | {(conv, t): (place[i], rows[parent[i]][0] if i else None) for i, (t, _) in enumerate(rows)} == got
    assert moved > 20


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 50 + i) for i in range(40)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 1 for i in range(1, 31)} | {50 + i: 50 for i in range(40)} | {100: 50, 200: 200, 201: 200}
    assert {n: got.get(n, n) for n in want} == want and set(got) <= set(want)


def test_mixed_copies_stand_at_their_positions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, sf_dir).collect()]
    at = []
    for r in mixture.mixed(docs).filter("copies > 0").collect():
        assert r["positions"][0] == r["position"] and list(r["positions"]) == sorted(r["positions"]) and r["positions"][r["copies"] - 1] <= 1
        at += [(p, r["doc_id"]) for p in r["positions"][: r["copies"]]]
    places = {i: sorted(p for p, k in at if k == i) for _, i in at}
    order = [places[i].pop(0) for i in out]
    assert [(p, i) for p, i in zip(order, out)] == sorted(zip(order, out))
    assert order == sorted(p for p, _ in at) and not any(places.values())


def test_pipeline_of_odd_rows(spark, tmp_path):
    body = " ".join(f"word{i} and so on, more of it." for i in range(60))
    rows = [(1, body), (2, body), (None, body), (None, None), (3, ""), (3, body.upper()), (4, "short one"), (5, body + " x" * 60_000), (5, None)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, size int, score int, position string, k int, limit int, _doc int, taken int"
    full = [(i, x, "en", ("a", None)[n % 2], 7, n, -n, "p", n, n, n, n) for n, (i, x) in enumerate(rows)]
    docs = spark.createDataFrame(full, kind)
    spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", "no such passage anywhere in them")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES[1:-1]:  # the classifier has learnt nothing here, and is tested apart
            now = corpus_pipeline.materialised(stage(spark, now, str(tmp_path)), name.split()[0])
            assert now.columns == docs.columns
            assert set(map(tuple, now.collect())) <= set(full)
        out = corpus_pipeline.encode(spark, now, str(tmp_path)).orderBy("start").collect()
        order = [r["doc_id"] for r in corpus_pipeline.mix_sources(spark, start, str(tmp_path)).collect()]
        assert len(out) == now.count() and sorted(map(repr, (r["doc_id"] for r in out))) == sorted(map(repr, (r[0] for r in now.collect()))) and len(order) >= len(out)
        kept = corpus_pipeline.keep_quality(spark, start, str(tmp_path))
        assert kept.columns == docs.columns and set(map(tuple, kept.collect())) <= set(full)


def test_token_files_follow_the_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mix = corpus_pipeline.materialised(corpus_pipeline.mix_sources(spark, docs, sf_dir), "mix")
    want = [r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, sf_dir).collect()]
    got = [r["doc_id"] for r in corpus_pipeline.encode(spark, mix, sf_dir).orderBy("start").collect()]
    assert got == want and got != sorted(got)


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialised(stage(spark, docs, sf_dir), name.split()[0])
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] >= sizes[2] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    rows = out.orderBy("start").collect()
    assert len(rows) == sizes[3]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    twice = out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    assert twice <= 2


def test_the_pipelines_encoder_remembers_less(spark, monkeypatch):
    from tidemark.llm import token_files

    told = []
    monkeypatch.setattr(corpus_pipeline, "token_digest", lambda docs, **k: told.append(k.get("remembered")))
    corpus_pipeline.encode(spark, spark.createDataFrame([(1, "a")], "doc_id long, text string"), "")
    assert told[0] and told[0] < token_files.REMEMBERED
