"""The conditional random field: blocks, exact decoding, held-out pages, odd inputs."""

import itertools
import time

import numpy as np

from kinlink.llm import extraction as x

SCHEMA = "page_id long, url string, html string, text string, n_chars string"


def test_blocks():
    page = "<p>a <b>b&amp;c</b>\n d<br>e<script>var x='<p>no</p>'</script><p>f<ul><li>g<li>h</ul><!-- <p>no --><div title='>'>i<style>p{}</style></div>j"
    assert [b.text for b in x.blocks_of(page)] == ["a b&c d", "e", "f", "g", "h", "i", "j"]
    assert [b.text for b in x.blocks_of("plain &lt;text")] == ["plain <text"]
    assert x.blocks_of("") == [] and x.blocks_of("<p> \n</p><script>open") == []


def test_raw_text_ends_at_its_end_tag():
    for raw in ("for(i=0;i<n;i++){f(i)}", "<!-- open", "s='<b';", "a<b && c>'d", "</scripts>"):
        for page in (f"<p>a</p><script>{raw}</script><p>b</p>", f"<p>a</p><SCRIPT async>{raw}</Script ><p>b</p>", f"<p>a</p><template><script>{raw}</script></template><p>b</p>", f"<p>a</p><style>{raw}</style><p>b</p>"):
            assert [b.text for b in x.blocks_of(page)] == ["a", "b"], page


def test_viterbi_is_exact():
    rng = np.random.default_rng(3)
    f = x.Field()
    f.emit = rng.normal(size=f.emit.shape)
    f.step = rng.normal(size=(2, 2))
    for n in range(1, 8):
        feats = [rng.integers(0, 1 << x.BITS, rng.integers(1, 5)).tolist() for _ in range(n)]
        s = f.scores(feats)
        best = max(itertools.product((0, 1), repeat=n), key=lambda y: sum(s[i, v] for i, v in enumerate(y)) + sum(f.step[a, b] for a, b in itertools.pairwise(y)))
        assert f.viterbi(feats) == list(best)


def test_held_out_pages():
    model = x.trained()
    right = total = 0
    for page, said in x.labelled_pages(120, seed=77):
        got = model.viterbi(x.features(x.blocks_of(page)))
        right += sum(a == y for a, (_, y) in zip(got, said, strict=True))
        total += len(said)
    assert right / total > 0.985


def test_extract(spark):
    page = '<html><head><title>T</title></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy this now.</div><article><h1>A title here</h1><p><b>First &eacute; line,  with\nblanks.<br><p>Second, longer line of the story. It goes on.</p></article><footer>&copy; example &middot; All rights.</footer></body></html>'
    rows = [(1, "u", page, "", ""), (2, None, None, "", ""), (None, "u", "", "", ""), (1, "u", page, "", "")]
    got = x.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    want = "A title here\nFirst é line, with blanks.\nSecond, longer line of the story. It goes on."
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("", 0), (want, len(want)), (want, len(want))]
    assert x.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_time_is_linear():
    """Unclosed tags, deep nesting and long pages; ten times the page takes about ten times as long."""
    pages = {
        "unclosed": lambda n: "<a " * n,
        "unclosed, with quotes": lambda n: '<a t="' * n + ">",
        "nested": lambda n: "<div>x " * n,
        "nested, with ends": lambda n: "<div><b>x" * n + "</b></div>" * n,
        "lists": lambda n: "<ul><li>y" * n + "</i></li>" * n,
        "blocks": lambda n: "<p class='a b'>some words here, and more</p>" * n,
    }
    for name, page in pages.items():
        took = []
        for n in (3_000, 30_000):
            start = time.process_time()
            x.features(x.blocks_of(page(n)))
            took.append(time.process_time() - start)
        assert took[1] < 40 * took[0] + 0.5, (name, took)


def test_odd_markup_loses_no_text():
    cases = {
        '<p>a</p><a title="x>b</a><p>c</p>': ["a", "b", "c"],
        "<p>1 < 2 and 3 > 2</p>": ["1 < 2 and 3 > 2"],
        "<p>a</p><p>b<!-- open <p>c</p>": ["a", "b"],
        "<p>a</p>tail <a": ["a", "tail <a"],
        "<p>a</p>tail <!-- b": ["a", "tail"],
    }
    for page, want in cases.items():
        assert [b.text for b in x.blocks_of(page)] == want, page


OTHER_LAYOUTS = [
    ('<div id=wrap><div id=top><table><tr><td><a href=/>Site name</a><td><a href=/a>One</a> <a href=/b>Two</a></table></div><div class="col-main"><h1>On rivers</h1><div class=lead>Rivers run to the sea, as everyone knows, and some run dry.</div><div>They carve valleys over many thousands of years. The longest of them cross several countries.</div><script>if(a<b){document.write("<p>no</p>")}</script><div>Dams hold them back, and people live by them.</div></div><div id=bottom><a href=/i>Imprint</a> | <a href=/p>Privacy</a></div></div>', {"Rivers run to the sea, as everyone knows, and some run dry.", "They carve valleys over many thousands of years. The longest of them cross several countries.", "Dams hold them back, and people live by them."}),
    ('<body><table width=100%><tr><td class=nav><a href=1>Home</a><br><a href=2>Archive</a><br><a href=3>Contact</a></td><td class=body><font size=5>A day in spring</font><p>The first warm day of the year came late, in the middle of April.<p>We walked along the canal for hours, and spoke little.<p>In the evening it rained again.</td></tr></table><center><small>&copy; 2003 the author &middot; <a href=m>mail</a></small></center>', {"The first warm day of the year came late, in the middle of April.", "We walked along the canal for hours, and spoke little.", "In the evening it rained again."}),
    ('<main role=main><div class=story__body><p class=story__p>The council met on Tuesday to vote on the new bridge, after a long debate.</p><div class="promo-box"><a href=/sub>Subscribe now</a></div><p class=story__p>Nine members were for it, and four against.</p></div></main><div class="site-footer__links"><a href=/t>Terms</a><a href=/c>Cookies</a></div>', {"The council met on Tuesday to vote on the new bridge, after a long debate.", "Nine members were for it, and four against."}),
]


def test_pages_without_telling_names():
    """The README has the figures: what holds here is less than on pages with section elements."""
    model, right, total = x.trained(), 0, 0
    for page, said in x.labelled_pages(120, seed=77, plain=1.0):
        got = model.viterbi(x.features(x.blocks_of(page)))
        right += sum(a == y for a, (_, y) in zip(got, said, strict=True))
        total += len(said)
    assert right / total > 0.94


def test_layouts_that_the_generator_does_not_write():
    """A record of a known weakness, not an aim: 5 of 8 sentences are found, and 4 blocks of links are kept."""
    model, found, wrong = x.trained(), 0, 0
    for page, want in OTHER_LAYOUTS:
        got = set(x.main_text(page, model).split("\n"))
        links = {b.text for b in x.blocks_of(page) if b.linked > len(b.text) / 2}
        found, wrong = found + len(want & got), wrong + len(links & got)
    assert found >= 5 and wrong <= 4, (found, wrong)


def test_query_against_enumeration(spark):
    """The extracted text is that of the likeliest of all labellings, on small pages."""
    model = x.trained()
    pages = [p for p, said in x.labelled_pages(60, seed=5) if len(said) <= 12] + [p for p, _ in OTHER_LAYOUTS]
    pages = [p for p in pages if len(x.blocks_of(p)) <= 12]
    assert len(pages) >= 3
    rows = [(i, "u", p, "", "") for i, p in enumerate(pages)]
    got = {r.page_id: r.text for r in x.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, p in enumerate(pages):
        blocks = x.blocks_of(p)
        s = model.scores(x.features(blocks))
        best = max(itertools.product((0, 1), repeat=len(blocks)), key=lambda y: sum(s[k, v] for k, v in enumerate(y)) + sum(model.step[a, b] for a, b in itertools.pairwise(y)))
        assert got[i] == "\n".join(b.text for b, y in zip(blocks, best, strict=True) if y)
