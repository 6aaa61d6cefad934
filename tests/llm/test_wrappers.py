"""Wrapper inference and main text."""
import html
import re

from corpusprep.llm.wrappers import HostWrapper, Page, bare, expression, extract, generalise, infer, main_text, merge, template_texts


def wrapper(*pages):
    w = HostWrapper(bare(generalise(Page(pages[0]).tree)), [0])
    for i, p in enumerate(pages[1:], 1):
        w.add(bare(generalise(Page(p).tree)), [i])
    return w


def test_expression_of_a_host():
    a = "<body><h1>A</h1><p>x</p><p>y</p><div class='note big'>n</div></body>"
    b = "<body><h1>B</h1><p>z</p></body>"
    assert expression(wrapper(a, b).nodes) == "<body><h1>#</h1>(<p>#</p>)+(<div.note>#</div>)?</body>"
    assert expression(wrapper(b, a).nodes) == expression(wrapper(a, b).nodes)
    assert expression(wrapper("<ul><li>a<li>b</ul>").nodes) == "<ul>(<li>#</li>)+</ul>"


def test_template_slots_need_four_different_pages():
    page = lambda k: f"<body><div><p>Welcome!</p><p>{'text ' * k}</p></div><div class=x><p>Fixed words</p></div></body>"
    w = wrapper(*(page(k) for k in range(1, 6)))
    p = Page(page(9))
    assert [p.texts[i] for i in template_texts(w.nodes, generalise(p.tree))] == ["Fixed words"]
    assert len(wrapper(page(1), page(2)).pages) == 2


def test_merge_accepts_both_and_is_stable():
    nodes = wrapper("<body><p>a</p></body>", "<body><h2>b</h2></body>").nodes
    assert merge(nodes, nodes) == merge(merge(nodes, nodes), []) or expression(merge(nodes, nodes)) == expression(nodes)


PAGES = {
    "plain": ("<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a href=x>m</a></nav><div class='cookie-notice'>c</div>"
              "<article><header><h1>Title &amp; y</h1></header><p>one<br>two <a href='a>b'>li\n nk</a></p><aside>s</aside><ul><li>i1<li>i2</ul><form>f</form>"
              "<section id='comments'><article><p>nice</p></article></section></article><div class='ad'>buy</div><footer>&copy;</footer>",
              "Title & y\n\none two li nk\n\ni1\n\ni2"),
    "unclosed": ("<article><p><b>a<p>b<br>c<footer>f</footer>", "a\n\nb c"),
    "main": ("<body><main><div>x</div><script>var a='</p>';</script><!-- c --> y </main><div>z</div>", "x\n\ny"),
    "class": ("<body><div id=sidebar>s</div><div class=post-content><p>body &#x41;</p></div>", "body A"),
    "body": ("<p>only</p><div hidden>no</div><p>text < 3</p>", "only\n\ntext < 3"),
    "none": ("<nav>x</nav>", ""),
    "empty": ("", ""),
    "broken": ("<article><p a=\"x>y</p>", "y"),
}


def test_main_text():
    for name, (markup, want) in PAGES.items():
        assert main_text(Page(markup), set()) == want, name


def test_deep_and_wide_pages():
    assert main_text(Page("<div>" * 5000 + "x" + "</div>" * 5000), set()) == "x"
    wide = "".join(f"<x{i}>t{i}</x{i}>" for i in range(3000))
    p = Page(f"<article>{wide}</article>")
    assert main_text(p, set()).count("\n\n") == 2999 and len(generalise(p.tree)) <= 48
    assert len(main_text(Page("<p>" + "word " * 300_000), set())) == 5 * 300_000 - 1


def test_extract_all_rows(spark):
    rows = [(i, f"http://h{i % 2}.example.com/{i}", m) for i, (m, _) in enumerate(PAGES.values())] + [(20, None, None), (None, "x", "<p>k</p>"), (3, "u", "<p>k</p>")]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "page_id long, url string, html string, host int, wrapper string").repartition(3)
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in extract(df).collect()}
    want = {(i, u): w for (i, u, _), (_, w) in zip(rows, PAGES.values())} | {(20, None): "", (None, "x"): "k", (3, "u"): "k"}
    assert got == {k: (t, len(t)) for k, t in want.items()}
    assert {r["host"] for r in infer(df).collect()} == {"h0.example.com", "h1.example.com", ""}
    assert extract(df.limit(0)).collect() == []


def test_generated_pages(spark):
    def truth(markup):
        inner = re.search(r"<article>(.*?)(</article>|\Z)", markup, re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " "))).strip() for b in re.split(r"</?(?:p|h1)>", inner))
        return "\n\n".join(b for b in blocks if b)

    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract(df).collect()}
    assert got == {r["page_id"]: truth(r["html"]) for r in df.collect()}


def test_constant_texts_inside_the_article_stay(spark):
    def texts(*pages):
        rows = [(i, f"http://h.example.com/{i}", p) for i, p in enumerate(pages)]
        return [r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)).orderBy("page_id").collect()]

    for a, b in (("<article>", "</article>"), ("<main>", "</main>"), ("<div class=content>", "</div>")):
        recipes = [f"<body class='single-post'><div>Site {k}</div><p>Fixed</p>{a}<h1>Dish {k}</h1><h2>Ingredients</h2><p>eggs {k}</p><h3>Summary</h3><p>good {k}</p>{b}" for k in range(8)]
        assert texts(*recipes) == [f"Dish {k}\n\nIngredients\n\neggs {k}\n\nSummary\n\ngood {k}" for k in range(8)]
        copies = [f"<body><nav>menu {k}</nav>{a}<h1>One title</h1><p>One paragraph.</p>{b}<div>advert {k}</div>" for k in range(8)]
        assert texts(*copies) == ["One title\n\nOne paragraph."] * 8
    bare = [f"<body class='post'><div>Fixed words</div><p>own {k}</p>" for k in range(8)]
    assert texts(*bare) == [f"own {k}" for k in range(8)]


def test_split_articles():
    pages = {
        "articles": ("<body><article><h1>T</h1><p>long one</p></article><nav>n</nav><article><p>two</p></article><div class=ad><article>buy</article></div>", "T\n\nlong one\n\ntwo"),
        "contents": ("<div class=content>a</div><div class=sidebar><div class=content>s</div></div><div class='content'>b b b</div><p>out</p>", "a\n\nb b b"),
        "title class": ("<div class=post-title>T</div><div class=post-meta>by me</div><div class=post-body><p>x y z</p></div>", "T\n\nby me\n\nx y z"),
        "title in main": ("<body><h1>Site</h1><main><h1>T</h1><p>menu</p><article><p>x</p></article></main>", "T\n\nx"),
        "own title": ("<body><h1>Site</h1><article><h1>T</h1>x</article>", "T\n\nx"),
    }
    for name, (markup, want) in pages.items():
        assert main_text(Page(markup), set()) == want, name
    site = Page("<body><h1>Site</h1><article>x</article>")
    assert main_text(site, {0}) == "x"


def test_attributes_are_read_one_by_one():
    """Names inside quoted values or longer names are none."""
    pages = {
        '<article title="The hidden city"><p>x</p></article>': "x",
        '<div aria-hidden="false"><p>x</p></div>': "x",
        '<div data-id="ad"><p>x</p></div>': "x",
        "<div data-x='class=ad' title=hidden><p>x</p></div>": "x",
        '<p id="share-prices">x</p>': "x",
        '<section class="comment-count-0"><p>x</p></section>': "x",
        '<div id = "sidebar"><p>x</p></div><p>y</p>': "y",
        "<div hidden><p>x</p></div><div HIDDEN=''>z</div><p>y</p>": "y",
        '<div class="a" class="ad"><p>x</p></div>': "x",
        "<div class=ad-top>a</div><div class='sidebar-left'>b</div><div class=related-posts>c</div><div class=siteFooter>d</div><p>y</p>": "y",
    }
    for markup, want in pages.items():
        assert main_text(Page(markup), set()) == want, markup


def test_classes_around_the_only_article():
    pages = {
        '<div class="with-sidebar"><article><p>x</p></article></div>': "x",
        '<div class="sidebar layout"><main><p>x</p></main><div class="ad">buy</div></div>': "x",
        '<div id="widget"><div class="promo"><article>x</article></div></div><nav><article>n</article></nav>': "x",
        '<article>x</article><div class="sidebar"><article>other</article></div>': "x",
        '<div class="comments"><article class="comment">nice</article></div><p>y</p>': "y",
    }
    for markup, want in pages.items():
        assert main_text(Page(markup), set()) == want, markup


def test_nested_holders():
    """The outer holder if it has most of the text, by what is not the template's."""
    long = "a long text of the page, " * 20
    long = long.strip()
    assert main_text(Page(f"<main><h1>T</h1><p>{long}</p><article>short notice</article></main>"), set()) == f"T\n\n{long}\n\nshort notice"
    assert main_text(Page(f"<div class=content><p>{long}</p><article>Nested</article><p>end</p></div>"), set()) == f"{long}\n\nNested\n\nend"
    assert main_text(Page(f"<main><p>menu</p><article><p>{long}</p></article></main>"), set()) == long
    p = Page(f"<main><p>{long}</p><article><h1>T</h1><p>its own text</p></article></main>")
    assert main_text(p, set()) == f"{long}\n\nT\n\nits own text"
    assert main_text(p, {0}) == "T\n\nits own text"  # the wrapper says that the long text is on every page


def test_lists_of_the_template(spark):
    """Without a holder, a plain list that all pages share is the wrapper's; one that varies is the page's."""
    menu = "<ul><li>Home</li><li>News</li><li>About</li></ul>"
    pages = [f"<body>{menu}<p>own text {k}</p><ul><li>point {k}</li><li>last</li></ul>" for k in range(6)]
    rows = [(i, f"http://h.example.com/{i}", p) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r["page_id"]: r["text"] for r in extract(df).collect()} == {k: f"own text {k}\n\npoint {k}\n\nlast" for k in range(6)}
    same = [(i, f"http://s.example.com/{i}", f"<body><!-- {i} -->{menu}<p>all the same</p>") for i in range(6)]
    got = extract(spark.createDataFrame(same, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"Home\n\nNews\n\nAbout\n\nall the same"}


def test_alignment_against_every_pairing():
    """The alignment of two expressions keeps as many labels as any alignment can (all subsets tried)."""
    import itertools
    import random

    from corpusprep.llm.wrappers import pairs

    rng = random.Random(3)
    for _ in range(60):
        a, b = ([{"t": rng.choice("pqr")} for _ in range(rng.randint(0, 6))] for _ in range(2))
        best = max(k for k in range(7) for x in itertools.combinations(range(len(a)), k) for y in itertools.combinations(range(len(b)), k)
                   if all(a[i]["t"] == b[j]["t"] for i, j in zip(x, y, strict=True)))
        found = pairs(a, b)
        assert sum(i is not None and j is not None for i, j in found) == best
        assert [i for i, _ in found if i is not None] == list(range(len(a))) and [j for _, j in found if j is not None] == list(range(len(b)))
