"""Template deduction against plain versions: occurrence vectors, classes, main texts."""

import html
import random
import re
from collections import defaultdict

import pytest

from delivery_lake.llm import op13_templates as templates

SCHEMA = "page_id long, url string, html string, host string, template string, token long, text string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "h", "t", 1, "x") for r in rows], SCHEMA).repartition(parts)


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def site(n, seed=1, article=True):
    """Pages of a host: menu, notice without a telling name, article, comments, footer."""
    rng = random.Random(seed)
    words = lambda k: " ".join(rng.choice(["river", "stone", "über", "green", "a &amp; b", "walks", "x&lt;y"]) + str(rng.randint(0, 99)) for _ in range(k))
    rows, want = [], {}
    for i in range(n):
        body = [words(rng.randint(3, 30)) for _ in range(rng.randint(1, 5))]
        head = words(3)
        paragraphs = "".join(f"<p>{p}</p>\n" if rng.random() < 0.7 else f"<p><b>{p.split()[0]}</b>{p[len(p.split()[0]):]}<br>" for p in body)
        tag = "article" if article else "div"
        page = (f'<!DOCTYPE html><html><head><title>{head}</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body class="page">'
                f'<div class="x1"><span>Our shop has moved to a new place</span></div>'
                f'<ul class="menu">{"".join(f"<li><a href=/{k}>{words(1)}</a></li>" for k in range(rng.randint(1, 6)))}</ul>'
                f'<{tag} id="post-{i}"><h1>{head}</h1>{paragraphs}<div><span>Read this on paper</span></div></{tag}>'
                f'<div class="reader-comments"><p>{words(6)}</p></div><form><input name=q>{words(2)}</form>'
                f'<footer>&copy; {words(2)}</footer></body></html>')
        rows.append((i, f"https://Shop.example.org/p/{i}?q=1", page))
        want[i] = "\n".join(" ".join(html.unescape(p).split()) for p in [head, *body])
    return rows, want


@pytest.mark.parametrize("article", [True, False])
def test_slots_of_a_site(spark, article):
    """What all pages share goes, though no name tells it; so does what names tell."""
    rows, want = site(24, article=article)
    assert texts(templates.main_texts(frame(spark, rows))) == want


def test_a_few_pages_have_no_template(spark):
    rows, want = site(3)
    got = texts(templates.main_texts(frame(spark, rows)))
    assert got == {i: t + "\nRead this on paper" for i, t in want.items()}


def test_given_pages(spark, sf_small):
    """The tables' pages, read by a pattern that knows how they are made."""
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1)>|<br>", inner))
        want[r.page_id] = "\n".join(b for b in blocks if b)
    found = templates.digest(pages).collect()
    assert {r.page_id: r.text for r in found} == want and all(r.n_chars == len(r.text) for r in found)


def test_vectors_and_classes_equal_plain_ones(spark):
    rows, _ = site(9, 4)
    rows += [(100 + r[0], r[1].replace("Shop.", "other."), r[2].replace("<footer>", "<footer><i>")) for r in site(5, 6)[0]]
    pages = templates.web_pages(frame(spark, rows))
    counts, tags = defaultdict(lambda: defaultdict(int)), set()
    for i, url, page in rows:
        host = url.split("/")[2].lower()
        for token, piece, *_ in templates.Reader().tokens(page)[0]:
            if token:
                counts[host, token][i] += 1
                if piece is None:
                    tags.add((host, token))
    want = defaultdict(set)
    for (host, token), vector in counts.items():
        if len(vector) >= 0.9 * sum(r[1].split("/")[2].lower() == host for r in rows):
            want[host, tuple(sorted(vector.items()))].add(token)
    want = {(k[0], frozenset(v)) for k, v in want.items() if len(v) > 1 and any((k[0], t) in tags for t in v)}
    got = defaultdict(set)
    for r in templates.classes(templates.token_vectors(pages)).collect():
        got[r.host, r["class"]].add(r.token & (1 << 64) - 1)
    assert {(k[0], frozenset(v)) for k, v in got.items()} == want and len(want) >= 4


def test_classes_must_be_ordered_and_nested(spark):
    """x and y come in changing order, u and v cross; only what is in one order and one slot is a template."""
    rows = []
    for i in range(8):
        xy = "<i>x</i><u>y</u>" if i % 2 else "<u>y</u><i>x</i>"
        loop = "<li><s>k</s></li>" * (i % 3 + 1)
        rows.append((i, "http://h.org/", f"<html><body><p>{xy}</p><ul>{loop}</ul><p>word{i}</p></body></html>"))
    pages = templates.web_pages(frame(spark, rows))
    found = templates.deduce(pages).collect()
    reader = templates.Reader()
    named = {t[0]: t[1] for t in reader.tokens(rows[0][2])[0]}
    kept = {named[r.token & (1 << 64) - 1] for r in found if not r.tag}
    assert kept == {"k"}
    loop_class = {(r.parent != 0, r.slot > 0) for r in found if not r.tag}
    assert loop_class == set() or loop_class == {(False, False)} or loop_class == {(True, True)}
    got = texts(templates.main_texts(frame(spark, rows)))
    assert got[3] == "yx\nword3".replace("yx", "xy") and got[2] == "yx\nword2"


def test_crossing_occurrences():
    a, b, c, d = (k << 3 for k in range(1, 5))
    token = lambda *ts: [(t, None, 0, 0, True) for t in ts]
    template = {a: 1, b: 1, c: 2, d: 2}
    assert templates.structure(token(a, c, d, c, d, b), template)[2][1] == (1, 1)
    assert templates.structure(token(a, b, c, d), template)[2][1] == (0, 0)
    assert None in templates.structure(token(a, c, b, d), template)[1] + templates.structure(token(a, c, b, d), template)[2]
    assert templates.structure(token(c, d, a, c, d, b), template)[2][1] is None
    assert templates.structure(token(a, b, b, a), template)[1][0] is None


def test_odd_pages(spark):
    long = "<article>" + "<p>word</p>" * 20000 + "</article>"
    cases = [
        (None, ""), ("", ""), (" \n", ""), ("plain text\n  only", "plain text only"), ("a < b & c &lt; d &#x41;&#66;&nope; &eacute", "a < b & c < d AB&nope; é"),
        ("<p>one<p>two<div>three<b> four</div>five", "one\ntwo\nthree four\nfive"), ("<article><p>in</p><div class='ad'>buy</div><aside>no</aside></article><p>out</p>", "in"),
        ("<main>m</main><nav>n</nav>", "m"), ("<p>x</p><!-- <p>never</p> --><script>if (a<b) '</p>'</script>y", "x\ny"), ("<!-- open <p>z", ""),
        ("<a title='a > b'>t</a><img src=x><p title=\"q>\">u</p>", "t\nu"), ("<a title=\"open>t</a> v", "t v"), ("</p></div>w<br>w", "w w"),
        ("<div id=cookieBanner>c</div><div class='article-body shareable'>s</div><section role=banner>b</section>", "s"),
        ("<article><header><h1>T</h1></header>t</article><header>H</header>", "T\nt"), ("<ul><li>a<li>b</ul><table><tr><td>c</td><td>d</td><tr><td>e</table>", "a\nb\nc d\ne".replace("c d", "cd")),
        ("<div class='wrap with-sidebar'><p>x</p><div id=rightSidebar>no</div></div>", "x"),
        ("<div class='sidebar-left social'><article>in</article><p>no</p></div>", "in"), ("<div class=comments><article>never</article></div><p>x</p>", "x"),
        ("<nav><article>never</article></nav><main><div class=share>no</div><p>m</p></main>", "m"),
        ("<head><title>t</title><body>b", "b"), ("<head><title>t</title><p>b", "b"), (long, "\n".join(["word"] * 20000)), ("<b>" * 5000 + "deep", "deep"), ("nul\x00 \U0001F600", "nul\x00 \U0001F600")]
    rows = [(i, None if i % 2 else f"http://h{i}.org/", page) for i, (page, _) in enumerate(cases)]
    rows += [(None, "http://n/", "<p>no id</p>"), (500, "not a url", "<p>u</p>"), (501, "", "<p>u</p>"), rows[4], rows[4]]
    got = templates.digest(frame(spark, rows)).collect()
    assert sorted(((r.page_id, r.text) for r in got), key=repr) == sorted([*[(i, w) for i, (_, w) in enumerate(cases)], (None, "no id"), (500, "u"), (501, "u"), (4, cases[4][1]), (4, cases[4][1])], key=repr)
    assert got[0].__fields__ == ["page_id", "url", "text", "n_chars"]


def test_empty_tables(spark):
    empty = frame(spark, site(2)[0]).limit(0)
    assert templates.digest(empty).count() == 0
    assert templates.deduce(templates.web_pages(empty)).count() == 0
