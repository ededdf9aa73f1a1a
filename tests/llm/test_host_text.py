import pytest

from galley.llm import host_text
from galley.llm.common import Stage
from galley.llm.suffix_dedup import repeated_starts


def text_of(page):
    return host_text._text(host_text.blocks(page), [])


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p class=ad>buy<p>kept<p class='lead header'>too</article>", "kept\ntoo"),
        ("<article><p class=ad>buy <b>now</b></p>kept</article>", "kept"),
        ("<article><p>a</p><ul><li class=comment>no<div>no</div><li>kept<li id=share>no</li></ul><p>b</article>", "a\nkept\nb"),
        ("<article><ol><li class=comment><section><p>no</section>no</li><li>kept</ol>b</article>", "kept\nb"),
        ("<article><ul><li class=comment>no<ul><li>no</ul>no</li><li>yes</ul></article>", "yes"),
        ("<p class=header>kept</p><p class=newsletter>no</p>free", "kept\nfree"),
    ],
)
def test_names_of_paragraphs_and_items_are_read(page, want):
    assert text_of(page) == want


@pytest.mark.parametrize("tag", ["button", "select", "object", "canvas", "svg", "math", "template"])
def test_an_unclosed_element_does_not_end_the_page(tag):
    page = f"<article><p>one <{tag} class=x>two<p>three</article><footer>f <button>b</button></footer>"
    assert text_of(page) == "one two\nthree"


@pytest.mark.parametrize("tag", ["script", "style", "title", "textarea", "iframe", "noscript"])
def test_raw_text_ends_at_its_mark_or_with_the_page(tag):
    assert text_of(f"<article><p>one<{tag}><p>no</{tag}> two<{tag}>no</article>").split() == ["one", "two"]


def test_controls_are_left_out_and_formulas_stay():
    page = (
        "<article><p>a<button type=button><div>no</div></button>b <select><option>no<option>no</select>"
        "<template><p>no<template>no</template>no</template> <math><mi>x</mi><mo>=</mo><mn>2</mn></math> c</article>"
    )
    assert text_of(page) == "ab x=2 c"


def test_stretches_that_stay_on_one_page_are_searched_at_every_place(spark, rng):
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for scope in range(40):
        again = words(30)
        a, b = sorted(rng.sample(range(31), 2))
        many = [w for _ in range(rng.randint(3, 5)) for w in words(12) + again] + words(12)
        rows += [(2 * scope, 2 * scope, " ".join(many), scope), (2 * scope + 1, 2 * scope + 1, " ".join(words(9) + again[a:b] + words(9)), scope)]
    docs = spark.createDataFrame(rows, "doc_id long, text_key long, text string, scope long")
    found = repeated_starts(docs, host_text.RUN, host_text.TOKENS, Stage(spark, "places"), apart=True).collect()
    got = {r.doc_id: {i for x in r.runs for i in range(x.first, x.last + 1)} for r in found}
    windows = {d: [t[i : i + host_text.RUN] for t in [text.split()] for i in range(len(t) - host_text.RUN + 1)] for d, _, text, _ in rows}
    for d, own in windows.items():
        other = {tuple(w) for w in windows[d ^ 1]}
        assert got.get(d, set()) == {i for i, w in enumerate(own) if tuple(w) in other}


def test_runs_repeated_across_a_host_are_cut_inside_articles(spark):
    notice = "please remember that every story here is brought to you by readers like you today"
    pages = [
        (1, "http://a.example/1", f"<article><p>first story about rivers and bridges</p><p class=x>{notice}</p></article>"),
        (2, "http://a.example/2", f"<main><p>second story on mountains in winter</p><div>{notice}</div></main>"),
        (3, "http://b.example/3", f"<article><p>other host</p><p>{notice}</p></article>"),
    ]
    got = {r.page_id: r.text for r in host_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "first story about rivers and bridges", 2: "second story on mountains in winter", 3: f"other host\n{notice}"}
