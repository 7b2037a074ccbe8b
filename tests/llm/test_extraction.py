import random
import re

import numpy as np

from shelfcast.llm import extraction as x

PAGE = "page_id long, url string, html string"


def run(spark, rows):
    return {r["page_id"]: r["text"] for r in x.extract(spark.createDataFrame(rows, PAGE)).collect()}


def text(page):
    return x.kept_text(x.split_page(page), set())


def test_structure():
    page = """<!DOCTYPE html><html><head><title>T &lt;</title><style>p{}</style><script>var a="</p>";</script></head><body class="with-sidebar">
    <nav><ul><li><a href=/a>Menu<li>More</ul></nav><header><h1>Site</h1></header><div class="cookie-notice">Accept</div>
    <article><header><h1>Head &amp; line</h1></header><p>One <b>two</b>&nbsp;three<br>four<p>Five<script>x<p></script> six
    <ul><li>a<li>b</ul><form><input value="q"><p>Name</p></form><aside>Side</aside><div id="comments"><p>Nice!</p></div>
    <table><tr><td>c<td>d</table><p hidden>secret</p><pre>x
      y</pre></article><footer>&copy; us</footer></body></html>"""
    assert text(page) == "Head & line\n\nOne two three four\n\nFive six\n\na\n\nb\n\nc\n\nd\n\nx y"


def test_broken_markup():
    assert text("") == "" and text("plain < text & more &am; &#233;") == "plain < text & more &am; é"
    assert text("<article><p>a</article") == "a" and text("<article><p>a <!-- never ends <p>b") == "a"
    assert text('<article><p title="a>b">c</p><script>never ends') == "c" and text("<article></div></p>x</section><p>y") == "x\n\ny"
    assert text("<article><p title='unclosed>c</p><p>d</p>")  # read without the quote
    long = "<article>" + "<div>" * 5000 + "deep" + "<p>x" * 5000
    assert text(long).startswith("deep\n\nx")


def test_attributes_are_read_by_whole_names():
    page = """<body><div style="overflow:hidden" data-role="banner" data-id="menu"><article style='a: hidden' title="id=share class=ad">
    <p data-class="ad">One <a href="/n?id=share&p=2">two</a> <math><mi>x</mi><annotation>tex</annotation></math></p><h3><button>Three</button></h3>
    <p class=ad>no</p><p HIDDEN=''>no</p><p id = 'menu' id="x">no</p><p aria-hidden=true>no</p></article></div></body>"""
    assert text(page) == "One two x\n\nThree"


def test_hinted_wrappers_of_articles():
    full = "<div class=sidebar>Side</div><article><h1>Head</h1><p>Text</p><div id=comments><article>Nice!</article></div></article><div class='share'>Share</div>"
    for start, end in [("<div class='layout has-sidebar'>", "</div>"), ("<div class='no-sidebar'><div>", "</div></div>"), ("<div id='modal-root'>", "</div>"), ("<form action=x>", "</form>"), ("<div role=form>", "</div>")]:
        assert text(f"<body>{start}{full}{end}<footer>Foot</footer></body>") == "Head\n\nText", start
        assert text(f"<body>{start}{full.replace('article>', 'main>', 1)}{end}</body>").startswith("Head\n\nText"), start
    assert text("<article class='post no-comments'><p>Text</p></article>") == "Text"
    assert text("<main><p>Text</p><ol id=comments><li><article class=comment>Nice!</article></ol></main>") == "Text"
    assert text("<aside><article>Teaser</article></aside><div class=popup>No</div><div class=has-sidebar><article><p>Text</p></article></div>") == "Text"


def test_names_are_read_as_a_whole():
    """Slugs as ids and layout words as classes are no names of page parts."""
    body = "<h1>Head</h1><p>Text of the story</p>"
    for start in ("<section id='share-prices-fall'>", "<section id='the-menu-of-tomorrow'>", "<p id=menu>", "<div class='no-sidebar'>", "<div class='layout has-sidebar'>",
                  "<div class='layout-with-comments-off x'>", "<section id='comment-on-this'>", "<div id='our-menu'>", "<div class='sidebar'>", "<form>"):
        end = f"</{start[1:].split()[0].rstrip('>')}>"
        assert text(f"<article>{start}{body}{end}</article>") == "Head\n\nText of the story", start
        assert text(f"<body><nav>Menu</nav><div>{start}<div>{body}</div>{end}</div><div class='site-footer'>Foot</div></body>") == "Head\n\nText of the story", start
    for small in ("<div class='main-nav'>", "<div id='page-footer'>", "<div class='sidebar-left'>", "<ul class='top menu'>", "<div class='post__share'>", "<div id=newsletter-signup>", "<div class='card ad-slot'>"):
        end = f"</{small[1:].split()[0]}>"
        assert text(f"<article>{body}{small}No{end}</article>") == "Head\n\nText of the story", small


def test_comments_and_teasers_as_articles():
    main = "<article><h1>Head</h1><p>Text</p></article>"
    comment = "<article><p>A very long comment of a reader, longer than all of the article itself</p></article>"
    for section in ("<section class='comments'>", "<section id=comments>", "<div class='comment-list'>", "<section class='related'>", "<div class='related-posts'>"):
        end = f"</{section[1:].split()[0]}>"
        assert text(f"<body>{main}{section}{comment * 2}{end}</body>") == "Head\n\nText", section
        assert text(f"<main>{main}{section}{comment * 2}{end}</main>") == "Head\n\nText", section
        assert text(f"<div class='has-sidebar'>{section}{comment}{end}{main}</div>") == "Head\n\nText", section
        assert text(f"<div>{section}<p>{'Many words of readers. ' * 9}</p>{end}<p>Text</p></div>") == "Text", section
    assert text(f"<div class=sidebar><article>Teaser</article></div>{main}") == "Head\n\nText"
    assert text(f"<div class=widget>{main}</div><div class=sidebar><article>Teaser</article></div>") == "Head\n\nText"


def test_buttons():
    assert text("<article><p>text<button>Click</button></p><h2><button>Part one</button></h2><p><button>Go</button></p></article>") == "text\n\nPart one"


def test_repeats_decide_where_structure_does_not(spark):
    line = "Follow us on all the usual channels today"
    rows = [(i, "http://h.org/", f"<body><div>{line}</div><p>Story number {i} tells its own tale {i}</p><div>{line} unique{i}</div></body>") for i in range(4)]
    rows += [(10 + i, "http://other.org/", f"<p>{line}</p><p>text {i}</p>") for i in range(2)]
    # an article keeps what other pages repeat, but for lists of links
    rows += [(20 + i, "http://h.org/", f"<article><p>{line}</p><p><a href=x>See all of our latest top stories {'now ' * i}</a></p></article>") for i in range(3)]
    got = run(spark, rows)
    assert all(got[i] == f"Story number {i} tells its own tale {i}\n\nunique{i}" for i in range(4))
    assert got[10] == f"{line}\n\ntext 0"
    assert got[20] == line and got[22].startswith(line)


def test_repeats_decide_beside_and_inside_articles(spark, monkeypatch):
    notice, note, quote = "Please accept our terms before you read on", "All rights of this text are with its author", "to be or not to be that is the question"
    # the pages' plain text is their own, the teaser is the same everywhere
    rows = [(i, "http://a.org/", f"<article><a href=x>Teaser of day {i}</a></article><div>{notice}</div><div>Main text number {i} in plain blocks {i}</div><div><a href=y>All other stories {i}</a></div>") for i in range(4)]
    rows += [(10 + i, "http://b.org/", f"<main><p>{note}</p><p>Story {i} is told here {i}</p>{f'<p>{quote}</p>' if i < 3 else ''}<p>{note} own{i}</p></main>") for i in range(7)]
    # pages with the same open stream are different pages
    rows += [(20 + i, "http://c.org/", f"<div>{notice}</div><article><p>Only the article {i} is different on these pages</p></article>") for i in range(3)]
    for tokens in (x.SHARD_TOKENS, 40):
        monkeypatch.setattr(x, "SHARD_TOKENS", tokens)
        got = run(spark, rows)
        assert all(got[i] == f"Teaser of day {i}\n\nMain text number {i} in plain blocks {i}" for i in range(4))
        assert all(got[10 + i] == f"Story {i} is told here {i}" + f"\n\n{quote}" * (i < 3) + f"\n\nown{i}" for i in range(7))
        assert all(got[20 + i] == f"Only the article {i} is different on these pages" for i in range(3))


def test_whole_copies_are_one_page(spark):
    page = "<p>These pages are copies of one another in every word</p>"
    assert set(run(spark, [(i, "http://h.org/x", page) for i in range(9)]).values()) == {"These pages are copies of one another in every word"}


def test_nulls_ties_and_empty(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>x</p>"), (2, "", "<script>only</script>")]
    got = x.extract(spark.createDataFrame(rows, PAGE)).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, [(1, None, "", 0), (1, None, "", 0), (None, "u", "x", 1), (2, "", "", 0)]))
    assert x.extract(spark.createDataFrame([], PAGE)).count() == 0


def test_suffix_array_against_brute_force():
    rng = random.Random(3)
    streams = [[rng.choice("abc") for _ in range(rng.randrange(0, 40))] for _ in range(8)]
    want = {}
    for i, s in enumerate(streams):
        for k in range(len(s) - x.MIN_RUN + 1):
            want.setdefault(tuple(s[k : k + x.MIN_RUN]), set()).add(i)
    ids = lambda w: np.array([x._token(c) for c in w], np.uint64)
    hashed = {int(x.prefixes(ids(w)).view(np.int64)[0]): len(p) for w, p in want.items()}
    assert dict(x.repeated_in(streams)) == hashed and x.repeated_in([]) == []
    tokens = np.array([rng.randrange(3) for _ in range(200)])
    order, same = x.suffix_array(tokens, 6)
    cut = [tuple(tokens[o : o + 6]) for o in order]
    assert cut == sorted(cut) and same.tolist() == [False] + [a == b for a, b in zip(cut, cut[1:])]


def test_shards_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(7)
    lines = ["one two three four five six seven", "all rights are reserved by us here now"]
    rows = [(i, f"http://h{i % 2}.org/", "".join(f"<p>{rng.choice(lines + [f'own words {i} {k} that nobody else has {k}'])}</p>" for k in range(6))) for i in range(60)]
    whole = run(spark, rows)
    monkeypatch.setattr(x, "SHARD_TOKENS", 100)
    assert run(spark, rows) == whole and any("own words" in t for t in whole.values()) and not any("reserved" in t for t in whole.values())


def test_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    import html

    got = {r["page_id"]: r["text"] for r in x.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    for r in rows:
        inner = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("<p>|</p>|<h1>|</h1>", inner))
        assert got[r["page_id"]] == "\n\n".join(p for p in parts if p)
