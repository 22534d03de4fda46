import random

import pytest

from loomframe.llm import page_diff as pd


def texts(page):
    return [line.text for line in pd.lines_of(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        (None, []), ("", []), ("plain &lt;text&gt; &eacute;&#233;", ["plain <text> éé"]),
        ("<p>one<p>two<div>three <b>bold</b>\n  more</div>", ["one", "two", "three bold more"]),
        ("<script>var a='</p><p>no';</script><style>p{}</style><p>yes", ["yes"]),
        ("<p>a<!-- <p>no --> b</p><!-- never closed <p>no", ["a b"]),
        ("<nav><ul><li>menu</ul></nav><p>text</p><footer>end<footer>in</footer></footer>", ["text"]),
        ('<div class="x sidebar"><div>no</div>no</div><div id="cookie-notice">no</div><div class="ad">no</div>yes', ["yes"]),
        ('<div role="navigation">no</div><p hidden>no</p><p style="display: none">no</p><p aria-hidden="true">no</p>yes', ["yes"]),
        ("<form><p>no</form><textarea><p>no</textarea>yes<button>no</button>", ["yes"]),
        ('<section class="comments"><p>no</p></section><ul id="comments"><li>no</ul>yes', ["yes"]),
        ('<div title="a > b" class=shade>kept</div>', ["kept"]),
        ("<header>no</header><article><header>yes</header>body</article>", ["yes", "body"]),
        ("<P>Upper<BR/>case</P>", ["Upper", "case"]), ("1 < 2 and 3 > 2", ["1 < 2 and 3 > 2"]),
        ("<article>in<aside>no</article>out", ["in", "out"]), ("<p>cut <b", ["cut"]),
    ],
)
def test_lines(page, want):
    assert texts(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div class='page has-sidebar'><article>body</article></div>", ["body"]),
        ("<div class='with-comments'><main>body</main></div><div id=ad-free>more</div>", ["body", "more"]),
        ("<div class=widget><nav>no</nav><article>body</article></div><div class=ad>no</div>", ["body"]),
        ("<form><p>the body of the page</form><p>end", ["the body of the page", "end"]),
        ("<div class=social>the body of the page<div class=share>no</div></div><p>end", ["the body of the page", "end"]),
        ("<article>the body</article><section class=related><article>teaser</article></section>end", ["the body", "end"]),
        ("<article>body<div class=related><article>no</article>no</div>more</article>", ["body", "more"]),
        ("<nav>a menu that is longer than the text</nav>text<p hidden>hidden text of the page</p>", ["text"]),
    ],
)
def test_wrappers_of_the_text_stay(page, want):
    assert texts(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div class=post><p>Body of it</div><section class=comments><article>A reader writes more than the body</article></section>", ["Body of it"]),
        ("<div><p>Body</div><section id=comments><p>longer than the body of the page</section>", ["Body"]),
        ("<div class=widget><p>teaser <article>x</article></div><p>the body is longer than it", ["the body is longer than it"]),
        ("<div class=user-comments><main>all of it</main></div>", []),
        ("<article class=widget>the body</article>", ["the body"]),
        ("<div class=site-header>no</div><div class=page-title>yes</div><p class=shareholders>yes", ["yes", "yes"]),
        ("<p>one<span class=ad-slot>no</span>two<div class=ad>never closed<p>no", ["one", "two"]),
        ("<div class=widget><article>body</article>", ["body"]), ("<head><title>t</title><body><p>text", ["text"]),
    ],
)
def test_added_sections_go_whatever_they_hold(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("name", "comment-list ad-slot share-buttons site-footer related-posts cookie_notice post-comments".split())
@pytest.mark.parametrize("kind", ["class", "id"])
def test_names_with_a_frame_word_at_an_end(name, kind):
    assert texts(f"<article>body<div {kind}='x {name}'><p>no<article>no</article></div>more</article>") == ["body", "more"]


@pytest.mark.parametrize("name", "has-sidebar with-comments ad-free comments-open share-wrapper header-image adsorb story-teller".split())
def test_names_of_layout(name):
    assert texts(f"<div class={name}><p>some</div><p>text of a page that is longer") == ["some", "text of a page that is longer"]


def test_many_nested_wrappers():
    for word in ("widget", "plain"):
        page = f"<div class={word}>" * 5000 + "<p>The body" + "</div>" * 5000 + "</span>" * 5000 + "<p>end"
        assert texts(page) == ["The body", "end"]


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    pick = random.Random(1)
    for _ in range(3000):
        a, b = ([pick.randint(0, 5) for _ in range(pick.randint(0, 12))] for _ in range(2))
        found = pd.aligned(a, b)
        rest = iter(b)
        assert len(found) == longest(a, b) and found == sorted(set(found))
        assert all(any(x == y for y in rest) for x in (a[i] for i in found))


def test_url_key():
    assert pd.url_key("https://u@Host.example:80/a/b?x=1#t") == ("host.example", "/a/b")
    assert pd.url_key("//h?x") == ("h", "/") and pd.url_key("nonsense") is None and pd.url_key(None) is None


SCHEMA = "page_id long, url string, html string"


def run(spark, rows, parts=4):
    got = pd.extract(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    return sorted(((r["page_id"], r["text"]) for r in got), key=repr)


def framed(k, body):
    frame = "<div><p>Site name</p><p>Top story of today</p>{}<p>Imprint of the house</p></div>"
    return frame.format(body) if k is not None else body


def test_differencing_deletes_the_frame_that_neighbours_share(spark):
    rows = [(k, f"http://h.example/{'abcdef'[k % 6]}/{k}", framed(k, f"<p>Story {k} has its own long text here</p><p>and a second line {k} as well</p>")) for k in range(40)]
    want = sorted(((k, f"Story {k} has its own long text here\nand a second line {k} as well") for k in range(40)), key=repr)
    assert run(spark, rows) == want
    assert run(spark, rows, 1) == want


def test_nearest_is_the_longest_common_path(spark):
    pages = [(1, "http://h/a/x1", 0), (2, "http://h/a/x2", 0), (3, "http://h/b/y", 0), (4, "http://g/a/x1", 0)]
    outline = spark.createDataFrame([(i, *pd.url_key(u)) for i, u, _ in pages], "id long, host string, path string")
    assert dict(map(tuple, pd._neighbours(outline).collect())) == {1: 2, 2: 1, 3: 2}


def test_neighbours_are_found_across_ranges(spark):
    n = 500
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k, "hot" if k % 5 else "cold", f"/p/{k:05d}") for k in range(n)]
        got = dict(map(tuple, pd._neighbours(spark.createDataFrame(rows, "id long, host string, path string")).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    order = {h: [k for k in range(n) if bool(k % 5) == (h == "hot")] for h in ("hot", "cold")}
    for ids in order.values():
        for at, k in enumerate(ids):
            near = [ids[i] for i in (at - 1, at + 1) if 0 <= i < len(ids)]

            def common(x, k=k):
                a, b = f"/p/{k:05d}", f"/p/{x:05d}"
                return next((i for i, (c, d) in enumerate(zip(a, b)) if c != d), len(a))

            assert got[k] == max(near, key=lambda x: (common(x), -x))


def test_articles_and_copies_are_protected(spark):
    stock = "<p>All rights reserved.</p>"
    inside = [(k, f"http://h/{k}", f"<div>Menu words {k}</div><article><h1>Title</h1><p>Text {k}</p>{stock}</article>") for k in range(3)]
    assert run(spark, inside) == [(k, f"Title\nText {k}\nAll rights reserved.") for k in range(3)]
    copies = [(k, f"http://h/{k}", "<p>The same long text on both pages</p><p>short</p>") for k in range(2)]
    assert run(spark, copies) == [(k, "The same long text on both pages\nshort") for k in range(2)]


def frame_of(body):
    return f"<p>Site name</p><p>Top story of today</p>{body}<p>Imprint of the house</p>"


def test_frames_are_deleted_from_copies_too(spark):
    text = "<p>A long text that all these copies have in common, much longer than the frame of the site is</p>" * 2
    rows = [(k, f"http://h/a/{k}", frame_of(text + f"<p>copy {k // 2}</p>")) for k in range(6)]
    rows += [(9, "http://h/b/9", frame_of("<p>Another text stands on this page, as long as the one of the copies or so</p>"))]
    plain = "A long text that all these copies have in common, much longer than the frame of the site is"
    want = [(k, f"{plain}\n{plain}\ncopy {k // 2}") for k in range(6)]
    assert run(spark, rows) == [*want, (9, "Another text stands on this page, as long as the one of the copies or so")]


def test_a_long_frame_is_deleted_from_short_pages(spark):
    rows = [(k, f"http://h/{k}", frame_of(f"<p>short {k}</p>")) for k in range(5)]
    assert run(spark, rows) == [(k, f"short {k}") for k in range(5)]
    excerpt = [(1, "http://h/1", "<p>A sentence</p>"), (2, "http://h/2", "<p>A sentence</p><p>and much more text that only the long page has</p>")]
    assert run(spark, excerpt)[0] == (1, "A sentence")


def test_a_teaser_in_an_article_does_not_hide_the_body(spark):
    page = "<div><p>Site name and motto</p><article>Teaser {k}</article><p>Body {k} is much longer than its teaser</p><p>Imprint of the house</p></div>"
    rows = [(k, f"http://h/{k}", page.format(k=k)) for k in range(4)]
    assert run(spark, rows) == [(k, f"Teaser {k}\nBody {k} is much longer than its teaser") for k in range(4)]


def plain_extract(rows):
    """The whole operator, a host at a time."""
    lines = {k: pd.lines_of(h) for k, _, h in rows}
    hosts = {}
    for k, url, _ in rows:
        if (at := pd.url_key(url)) is not None:
            hosts.setdefault(at[0], []).append((at[1], k))

    def common(a, b):
        return next((i for i, (c, d) in enumerate(zip(a, b)) if c != d), min(len(a), len(b)))

    def against(one, two):
        a, b = ([x.text for x in lines[k]] for k in (one, two))
        where, j = [], 0
        for i, x in enumerate(a):  # lines of the fixture keep their order, so one look forward aligns them
            if x in b[j:]:
                j = b.index(x, j) + 1
                where.append(i)
        hit, total = sum(len(a[i]) for i in where), sum(map(len, a))
        return where, hit == total or hit > pd.COPY_SHARE * max(total, sum(map(len, b)))

    found = {}
    for pages in hosts.values():
        pages.sort()
        for at, (path, k) in enumerate(pages):
            near = [pages[i] for i in (at - 1, at + 1) if 0 <= i < len(pages)]
            if not near or not lines[k] or not pd._is_open(lines[k]):
                continue
            where, copy = against(k, min(near, key=lambda p: (-common(path, p[0]), p[1]))[1])
            if copy:
                low = high = at
                while low > 0 and against(pages[low][1], pages[low - 1][1])[1]:
                    low -= 1
                while high + 1 < len(pages) and against(pages[high + 1][1], pages[high][1])[1]:
                    high += 1
                far = [pages[i] for i in (low - 1, high + 1) if 0 <= i < len(pages)]
                where, copy = against(k, min(far, key=lambda p: (-common(path, p[0]), p[1]))[1]) if far else ([], True)
            if copy:
                held = [sum(x.text in t for t in {tuple(y.text for y in lines[o]) for _, o in pages}) for x in lines[k]]
                where = [i for i, n in enumerate(held) if n >= pd.SEVERAL]
                where = [] if len(where) == len(held) else where
            found[k] = where
    return sorted(((k, pd.main_text(lines[k], found.get(k, []))) for k, _, _ in rows), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_whole_operator_against_brute_force(spark, seed):
    pick = random.Random(seed)
    rows = []
    for k in range(60):
        host = pick.choice("abc")
        top = [f"Top of {host}", f"Menu of {host}", f"News of {host}"][: pick.randint(1, 3)]
        if rows and pick.random() < 0.3:
            body = pick.choice(rows)[2]
        else:
            body = [f"Line {k} {i} " + "word " * pick.randint(0, 12) for i in range(pick.randint(0, 5))]
            if pick.random() < 0.2:
                body[1:1] = ["<article>" + "".join(f"Inside {k}" for _ in range(pick.randint(1, 9))) + "</article>"]
        rows.append((k, f"http://{host}.example/{pick.choice('xyz')}/{k:02d}", body, "".join(f"<p>{t}</p>" for t in [*top, *body, f"Imprint of {host}"])))
    rows = [(k, url, page) for k, url, _, page in rows]
    assert run(spark, rows) == plain_extract(rows)


def test_edge_cases(spark):
    long = "<p>" + "many words " * 20_000 + "</p>"
    rows = [(1, None, "<p>a</p>"), (2, "http://h/1", None), (3, "http://h/2", ""), (4, "bad url", "<p>b</p>"), (None, "http://h/3", "<p>c</p>"),
            (5, "http://h/4", long), (6, "http://k/", "<p>d</p>"), (6, "http://k/", "<p>d</p>")]
    assert run(spark, rows) == sorted(
        [(1, "a"), (2, ""), (3, ""), (4, "b"), (None, "c"), (5, ("many words " * 20_000).strip()), (6, "d"), (6, "d")], key=repr)
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "http://h/", "<p>x</p>", "t", 3)], SCHEMA + ", text string, id int")
    assert pd.extract(df).first()["text"] == "x"
