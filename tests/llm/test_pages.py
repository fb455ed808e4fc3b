"""Main text of pages of one layout and of others, against what was put in."""

from tablekit.llm import dom, html_main

ARTICLES = [f"Title {i}|First &amp; long paragraph number {i} with many words in it.|Second  one {i}\n on two lines." for i in range(6)]


def page(i, body):
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x='</p>';</script></head><body>"
            f"<div id='header' class='site-header'>Our site</div><nav><ul><li><a href='/'>Home</a></ul></nav>{body}"
            f"<div class='cookie-notice'>We use cookies</div><footer>&copy; {i}")


def test_layouts(spark):
    rows, want = [], {}
    for i, a in enumerate(ARTICLES):
        head, one, two = a.split("|")
        bodies = [
            f"<article><h1>{head}</h1><p>{one}<p><b>{two}<div class='comments'><p>Nice {i}</p></div></article>",
            f"<div class=wrap><div class='content'><h1>{head}</h1><p>{one}</p><p>{two}</p><p>Read our terms.</p></div>"
            f"<aside>Side {i}</aside><form><input><button>Send</button></form></div>",
            f"<main><header><h1>{head}</h1></header><p>{one}</p>Read our terms.<ul><li>{two}</li></ul><!-- ad --></main>",
        ]
        for k, body in enumerate(bodies):
            rows.append((10 * i + k, f"http://host{k}.example.com/{i}", page(i, body), "x"))
            want[10 * i + k] = f"{head} First & long paragraph number {i} with many words in it. Second one {i} on two lines."
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = {r["id"]: r["text"] for r in html_main.extract_main(frame).collect()}
    assert got == want  # the terms are the same on every page of their host, so they are template


def test_copies_of_one_article_stay(spark):
    rows = [(i, "https://a.example/x", page(i, "<article><p>The only text.</p></article>")) for i in range(9)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r["text"] for r in html_main.extract_main(frame).collect()} == {"The only text."}


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "nonsense", ""), (3, "http://a.b/c", "plain &lt;text&gt;  here"), (4, "http://a.b/c", "<p>" * 5000 + "deep"),
            (5, "http://a.b/d", "<div>" * 4000 + "deep div"), (6, "http://a.b/e", "<script>only code"), (6, "http://a.b/e", "<script>only code")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted((r["id"], r["text"]) for r in html_main.extract_main(frame).collect())
    assert got == [(1, ""), (2, ""), (3, "plain <text> here"), (4, "deep"), (5, "deep div"), (6, ""), (6, "")]
    assert html_main.extract_main(frame.limit(0)).count() == 0


def brute_match(a, b):
    """Simple tree matching by its recurrence."""
    if a.label != b.label:
        return 0
    m, n = a.children, b.children
    best = [[0] * (len(n) + 1) for _ in range(len(m) + 1)]
    for i, x in enumerate(m):
        for j, y in enumerate(n):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_match(x, y))
    return best[-1][-1] + 1


def test_tree_matching():
    trees = [dom.parse(h) for h in (
        "<ul><li>a<li>b<li><b>c</b></ul><p>x", "<ul><li><b>c</b><li>a</ul><div>y</div><p>x", "<p>x<p>y<ul><li>a</ul>",
        "<div><p>a</p><ul><li>1<li>2</ul></div><div><p>b</p></div>", "")]
    for a in trees:
        for b in trees:
            found = dom.match(a, b)
            assert len(found) == brute_match(a, b)
            assert all(x.label == y.label for x, y in found)


def test_layouts_of_one_host(spark):
    """Two layouts on a host, the smallest ids are pages without any, hosts of two and three pages."""
    rows, want = [(None, "http://one.example/none", "", "x"), (1, "http://one.example/empty", None, "x"),
                  (2, "http://one.example/error", "<html><body><h1>Not found</h1></body></html>", "x")], {None: "", 1: "", 2: "Not found"}
    for i, a in enumerate(ARTICLES):
        head, one, two = a.split("|")
        text = f"<h1>{head}</h1><p>{one}</p><p>{two}</p>"
        bodies = [("one", f"<div class='wrap'><div class='content'>{text}<p>Read our terms.</p></div></div>"),
                  ("one", f"<section class='story'><div class='tale'><p>Share this story now.</p>{text}</div></section>"),
                  *[(x, f"<div class='wrap'><div class='content'>{text}<p>Read our terms.</p></div></div>")
                    for x, n in (("two", 2), ("three", 3)) if i < n]]
        for k, (name, body) in enumerate(bodies):
            rows.append((100 + 10 * i + k, f"http://{name}.example/{i}", page(i, body), "x"))
            want[100 + 10 * i + k] = f"{head} First & long paragraph number {i} with many words in it. Second one {i} on two lines."
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = {r["id"]: r["text"] for r in html_main.extract_main(frame).collect()}
    assert got == want


def test_two_pages_that_are_nearly_copies_stay(spark):
    text = "".join(f"<p>Paragraph {i} is on both pages.</p>" for i in range(5))
    rows = [(i, "http://a.example/x", page(i, f"<article>{text}<p>Version {i}.</p></article>")) for i in range(2)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert all(r["text"].startswith("Paragraph 0") for r in html_main.extract_main(frame).collect())


def test_deep_nests():
    """Text below many open elements keeps its place, and their end tags close nothing else."""
    deep = "<div>" * 200 + "<div class='advert'>Buy now</div><aside>Side</aside>" + "</div>" * 200
    html = f"<body><div class='wrap'><article><p>One.</p>{deep}<p>Two.</p></article><div>More.</div></div>"
    assert dom.blocks(dom.container(dom.parse(html)), frozenset()) == ["One.", "Two."]
    unclosed = "<body><article><p>One.</p><p>" + "<b>" * 300 + "Bold.</p><div class=comments>No.</div><p>Two.</p></article>"
    assert dom.blocks(dom.container(dom.parse(unclosed)), frozenset()) == ["One.", "Bold.", "Two."]
    one, two = (dom.parse("<div>x" * 5000 + end + "</div>" * 5000 + "<p>after") for end in ("a", "<i>b</i>"))
    assert len(dom.match(one, two)) == 5002
    assert dom.blocks(one, frozenset())[-1] == "after"
    dom.parse("<p><table>" + "<b>" * 50000 + "</p></i>" * 50000)


def test_lengths():
    for html in ("<div> a <b>b</b>c<p>d  e</p> f<br>g<nav>n</nav>h <span> i<div>j</div> k</span></div>l", "", " <p> </p> ", "x<br> y<br>z"):
        root = dom.parse(html)
        found = dom._lengths(root)
        for node in dom.walk(root):
            assert found[node.index] == sum(map(len, dom.blocks(node, frozenset())))
