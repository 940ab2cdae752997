"""Neighbour search by recall and order, page texts by hand-made pages."""

import numpy as np

from sparkeval.llm import html_text, neighbours


def brute(ids, v, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = v @ v[i]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def test__hilbert_neighbours_touch():
    for axes, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = neighbours.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test__recall(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(6000, 32)) * rng.uniform(0.5, 2, (6000, 1))
    table = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>, label int").repartition(6)
    want, got = brute(np.arange(6000), v), result(neighbours.nearest(table, curves=24, window=300))
    hits = sum(len({a for a, _ in want[q]} & {a for a, _ in got[q]}) for q in want)
    assert set(want) == set(got) and hits / (20 * len(want)) > 0.9
    for q, rows in got.items():
        assert all(abs(s - v[q] @ v[a]) < 1e-9 for a, s in rows) and q not in {a for a, _ in rows}


def test__windows_grow_with_the_table(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(6000, 12))
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>").repartition(6)
    want, got = brute(np.arange(6000), v), result(neighbours.nearest(table, window=10, queries="id >= 0"))
    hits = sum(len({a for a, _ in want[q]} & {a for a, _ in got[q]}) for q in want)
    print(f"recall {hits / (20 * len(want))}")
    assert hits / (20 * len(want)) > 0.95


def test__copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 8))
    v[50:200] = v[40]
    rows = [(i, x.tolist(), "x") for i, x in enumerate(v)]
    bad = [(1000, None, "x"), (1020, [0.0] * 8, "x"), (1040, [float("nan")] + [1.0] * 7, "x"), (1060, [None] + [1.0] * 7, "x"), (1080, [float("inf")] * 8, "x"), (1100, [1.0] * 5, "x"), (None, [1.0] * 8, "x"), (1120, [], "x")]
    table = spark.createDataFrame(rows + bad + rows[:3], "vec_id bigint, embedding array<double>, class string").repartition(4)
    want, got = brute(np.arange(300), v), result(neighbours.nearest(table))
    assert set(got) == set(want)
    for q in want:
        assert [a for a, _ in got[q]] == [a for a, _ in want[q]]
    few = result(neighbours.nearest(table.where("vec_id < 5")))
    assert [a for a, _ in few[0]] == [a for a, _ in brute(np.arange(5), v[:5])[0]]
    assert neighbours.nearest(table.limit(0)).count() == 0 and neighbours.nearest(table.where("vec_id = 0")).count() == 0


PAGES = {
    '<html><body class="has-sidebar"><div class="menu-open"><header>top</header><main><h1>T&eacute;st &#x41;</h1><p>one <span class="ad">x</span>two<br>three&nbsp; four'
    '<ul><li>a<li>b</ul><aside>side</aside><div class="comments"><p>c</div></main></div><div id=footer>f</div>': "Tést A\none two three four\na\nb",
    '<div id="content"><p>Hello <b>wor</b>ld</p>tail</div><div class="cookie-notice">no</div><form><p>q</p></form><table><tr><td>1<td>2</table><p>end <script>var x="<p>no</p>"</script>it': "Hello world\ntail\n1\n2\nend it",
    "": "", None: "", "plain &lt;text": "plain <text", "<p>a<!-- x <p> --> b</p>": "a b", "<style>p{}</style><nav><p>x</p></nav>": "",
    '<article><header><h1>H</h1></header><p>x</p><footer>by</footer></article><article class="comment">zz</article>': "H\nx",
    "<p>" + "long " * 50000 + "</p>": ("long " * 50000).strip(), "<p>a</div></span>b</p><p>c": "ab\nc", "&amp;amp; &#128512;": "&amp; \U0001f600",
    '<p title="a > b">q</p>': "q", "<p>x<br/>y<hr>z": "x y\nz",
}


def test__main_text():
    for page, text in PAGES.items():
        assert html_text.main_text(page or "") == text


def test__extract(spark):
    pages = [(i, f"http://h{i}.example/{i}", p) for i, p in enumerate(PAGES)] + [(3, None, "<p>z"), (3, None, "<p>z"), (None, "x", "<p>z")]
    table = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id bigint, url string, html string, text string, paths string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(table).collect()), key=repr)
    want = sorted(((i, u, PAGES.get(p, "z"), len(PAGES.get(p, "z"))) for i, u, p in pages), key=repr)
    assert got == want
    assert html_text.extract(table.limit(0)).count() == 0


def test__words_and_articles():
    """A main element's own text counts next to its article's, and inside an article a part of a longer name is no mark."""
    assert html_text.main_text("<main><h1>Title</h1><p>Lead</p><article><p>Body.</p></article></main><p>out") == "Title\nLead\nBody."
    article = '<article><h1>H</h1><p id="widget-4">a</p><section class="related-work"><p>b</p></section><p class="search-tips">c</p><div class="related"><p>no</p></div><div class="comment-list">no</div></article>'
    assert html_text.main_text(article) == "H\na\nb\nc"
    assert html_text.main_text('<div class="related-work"><p>b</p></div><p>c') == "c"


def sites() -> list[tuple[int, str, str]]:
    box = "<div><span>Best site ever</span></div>"
    pages = [(i, f"https://site.example/{i}", f"<body>{box}<div><p>Story {i} begins</p><p>and ends {i * 7}</p></div></body>") for i in range(40)]
    pages += [(100 + i, f"https://copy.example/{i}", "<article><h1>Same</h1><p>text of all</p></article>") for i in range(40)]
    pages += [(200 + i, f"https://art.example/{i}", f"<article><h1>Title {i}</h1><p>text {i}</p><div><p class=x>Read more below</p></div><p>more {i}</p></article>") for i in range(40)]
    links = "".join(f"<li>Link {k}</li>" for k in range(30))  # a menu without a name, one of its entries differs from page to page
    pages += [(300 + i, f"https://menu.example/{i}", f"<body><div><ul>{links}<li>Ad no {i}</li></ul></div><p>Welcome</p><p>{'word ' * 150}{i}</p></body>") for i in range(200)]
    pages += [(600 + i, f"https://few.example/{i}", f"<body>{box}<p>Story {i}</p></body>") for i in range(6)]
    near = "<p>a first paragraph that all of the copies hold</p><p>a second one</p>"
    pages += [(700 + i, f"https://near.example/{i}", f"<body><h1>A</h1>{near}<p>{i}</p></body>") for i in range(60)]
    return pages


def test__style_tree_removes_what_a_host_repeats(spark):
    """Unnamed boxes, menus and lines that a host repeats go, branches as a whole; copies, and what few pages repeat, stay."""
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(sites(), "page_id bigint, url string, html string").repartition(5)).collect()}
    for i in range(40):
        assert got[i] == f"Story {i} begins\nand ends {i * 7}"
        assert got[100 + i] == "Same\ntext of all" and got[200 + i] == f"Title {i}\ntext {i}\nmore {i}"
    assert all(got[300 + i] == "word " * 150 + str(i) for i in range(200))
    assert all(got[600 + i] == f"Best site ever\nStory {i}" for i in range(6))
    assert all(got[700 + i] == f"A\na first paragraph that all of the copies hold\na second one\n{i}" for i in range(60))


def test__style_tree_against_trees_in_memory(spark):
    """Importances against trees built page by page in plain Python."""
    from math import log

    import pytest

    pages = sites()
    hosts: dict = {}
    for _, url, page in pages:
        hosts.setdefault(url.split("/")[2], []).append(html_text.parse(page))
    want = {}
    for host, parsed in hosts.items():
        shown: dict = {}
        for page in parsed:
            nodes, shapes = page.keys()
            on_page = {(n, False, frozenset(s for m, s in zip(nodes, shapes) if m == n)) for n in nodes}
            on_page |= {(html_text._hash(nodes[at], text), True, None) for at, text, gone, *_ in page.blocks if not gone}
            for key in on_page:
                shown[key] = shown.get(key, 0) + 1
        base = len(parsed) + html_text.PRIOR
        for (node, content, _), c in shown.items():
            if content:
                want[host, node, True] = 1 - log(c) / log(base)
            else:
                want[host, node, False] = want.get((host, node, False), 1.0) - c * log(c) / (base * log(base))
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(5)
    scratch = html_text.Scratch(spark)
    got = {(r.host, r.node, r.content): r.importance for r in html_text.style_tree(table, scratch).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    few = {(r.host, r.node, r.content): r.importance for r in html_text.style_tree(table, scratch, 0.15).collect()}
    assert set(few) == {k for k, x in want.items() if x < (0.15 if k[2] else html_text.PLAIN)}
    assert min(got.values()) < 0.06


def test__very_long_pages(spark):
    page = "<article>" + "".join(f"<p>line {i}</p>" for i in range(60000)) + "</article>"
    got = html_text.extract(spark.createDataFrame([(1, "http://a.b/", page), (2, "http://a.b/", "<div>" * 3000 + "deep")], "page_id bigint, url string, html string")).collect()
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == "\n".join(f"line {i}" for i in range(60000)) and texts[2] == "deep"
