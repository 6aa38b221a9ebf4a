import numpy as np

from gleanery.llm import htmltext

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix quartz".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def page(rng, number, main="article"):
    open_tag, close = (f"<{main}>", f"</{main}>") if "." not in main else (f'<div class="{main.split(".")[1]}">', "</div>")
    body = [sentence(rng, int(rng.integers(1, 40))) for _ in range(int(rng.integers(1, 6)))]
    html = (
        f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
        f"<nav><ul><li><a href='#'>{sentence(rng, 1)}</a><li><a>{sentence(rng, 2)}</a></ul></nav><!-- c --><div class='ad'>{sentence(rng, 6)}</div>"
        f"{open_tag}<h1>Head &amp; {number}</h1>" + "".join(f"<p>{b.replace('fox', '<b>f</b>ox')}" for b in body) + f"{close}<footer>&copy; {sentence(rng, 5)}</footer></body></html>"
    )
    return html, " ".join([f"Head & {number}", *body])


def test_gradients_follow_the_loss():
    net = htmltext.Labeller.random(hidden=3)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 2, htmltext.PATH_DIM + htmltext.WORD_DIM + htmltext.PLAIN_DIM))
    inside = np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], bool)
    y = rng.integers(0, 2, (5, 2)).astype(float)
    _, grads = net.loss(x, inside, y)
    for name, grad in grads.items():
        values = net.plain()[name]
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        values[at] += 1e-5
        up = net.loss(x, inside, y)[0]
        values[at] -= 2e-5
        down = net.loss(x, inside, y)[0]
        values[at] += 1e-5
        assert np.isclose((up - down) / 2e-5, grad[at], rtol=1e-4)


def test_blocks_of_odd_markup():
    found = htmltext.blocks("<p>a<p>b <i>c</i>\n\n d<br>e<div class='x Y2'><ul><li>f<li>g</ul></div>&lt;h&gt; &amp i<script>no</script><template>no</template> <foo bar")
    assert [b.text for b in found] == ["a", "b c d", "e", "f", "g", "<h> & i"] or [b.text for b in found] == ["a", "b c d e", "f", "g", "<h> & i"]
    assert "x" in next(b for b in found if b.text == "f").path
    assert htmltext.blocks(None) == htmltext.blocks("") == htmltext.blocks("<div></div>") == []
    assert [b.text for b in htmltext.blocks("plain text only")] == ["plain text only"]
    assert htmltext.blocks("</div></p></html>x")[0].text == "x"


def test_pages_of_several_makes(spark):
    rng = np.random.default_rng(4)
    pages = [page(rng, i) for i in range(60)] + [page(rng, 100 + i, main) for i, main in enumerate(("main", "div.content", "div.post"))]
    odd = [(900, None), (901, ""), (902, "<nav>only</nav>"), (903, "<article>" + "<p>word " * 3000)]
    extra = "<article><h1>T</h1><p>Body of it.</p><div class='comments'><p>Nice one</p></div><aside>See also</aside><form>Mail</form></article><div class='cookie'>We use cookies</div>"
    rows = [(i, h) for i, (h, _) in enumerate(pages)] + odd + [(904, extra), (0, pages[0][0])]
    df = spark.createDataFrame([(i, f"u{i}", h, "x", 0) for i, h in rows], "page_id long, url string, html string, text string, n_chars int")
    got = htmltext.report(df).collect()
    by_id = {r["page_id"]: r for r in got}
    assert len(got) == len(rows)
    assert [by_id[i]["text"] for i in range(len(pages))] == [t for _, t in pages]
    assert by_id[900]["text"] == by_id[901]["text"] == by_id[902]["text"] == "" and by_id[904]["text"] == "T Body of it."
    assert by_id[903]["text"] == " ".join(["word"] * 3000)
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == f"u{r['page_id']}" for r in got)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "u", "<div><!-- x --></div>")], "page_id long, url string, html string")
    assert [r["text"] for r in htmltext.report(df).collect()] == [""]
    assert htmltext.report(df.limit(0)).count() == 0


def test_pages_without_marks_and_copies_do_not_thin_the_sample(spark):
    rows = [(i, "u", f"<p>page {i}") for i in range(60000)] + [(60000 + i, "u", f"<article>own {i}</article>") for i in range(300)] + [(70000, "u", "<main>copied</main>")] * 20000
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = htmltext.sample(df)
    assert len(got) == len(set(got)) == htmltext.SAMPLE_PAGES
    assert len(htmltext.sample(df.where("page_id < 60020 or page_id = 70000"))) == 21


def test_only_titles_scripts_styles_and_templates_are_hidden():
    texts = lambda html: [b.text for b in htmltext.blocks(html)]
    assert texts("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><svg><title>Plan</title><text>label</text></svg></article>") == ["Let x=1 be.", "Plan", "label"]
    assert texts("<article><object>no player</object><noscript>no script</noscript><iframe>no frame</iframe><template><p>t</p></template>end") == ["no player", "no script", "no frame", "end"]
    open_head = htmltext.blocks("<html><head><title>t</title><style>s</style><article><h1>T</h1><p>Body")
    assert [b.text for b in open_head] == ["T", "Body"] and open_head[0].path == ("article", "h1")
    assert texts("<head><meta charset=x><title>t</title> <script>s</script></head><p>a") == ["a"] == texts("<head><title>t</title>a")
    assert texts("<head><template><div>x</div></template><title>t</title></head><body>b") == ["b"]


def test_all_words_of_a_block_count():
    one, other = (htmltext.Block(" ".join(["word"] * 100 + [w] * 100 + ["word"] * 100), ("p",)) for w in ("midst", "other"))
    assert (htmltext.vectors([one]) != htmltext.vectors([other])).any()


def test_pages_that_mark_no_article_have_texts(spark):
    rng = np.random.default_rng(6)
    pages = [page(rng, i, "div.content") for i in range(50)]
    broken = "<article\nclass='x'><p>Body of it.</p></article>"
    df = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(pages)] + [(99, "u", broken)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in htmltext.report(df).collect()}
    right = sum(got[i] == t for i, (_, t) in enumerate(pages))
    assert right >= 45 and got[99] == "Body of it."
    nothing = spark.createDataFrame([(1, "u", None), (2, "u", "<div></div>")], "page_id long, url string, html string")
    assert [r["text"] for r in htmltext.report(nothing).collect()] == ["", ""]
