"""What the parser of pages leaves to the model."""

import numpy as np

from inkdex.llm import extraction


def all_text(source):
    page = extraction.Page(source)
    return page.text(np.ones(len(page.elements), bool))


def test_only_scripts_styles_and_titles_are_skipped():
    source = (
        "<title>T</title><p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and <svg><text>drawn</text></svg> hold</p>"
        "<object>fallback</object><noscript>plain</noscript><template>kept</template><SCRIPT>var a;</script ><style>b</STYLE><p>end"
    )
    assert all_text(source) == "if x=1 and drawn hold\nfallbackplainkept\nend"
    for name in ("math", "svg", "object", "noscript", "template", "iframe", "select", "textarea"):
        assert all_text(f"<article><{name}>inside<p>after</p></article><p>last</p>") == "inside\nafter\nlast"


def test_letters_that_grow_in_lower_case_do_not_shift_the_end_of_a_script():
    assert all_text("<p>" + "İ" * 30 + "</p><script>a</script><p>begin</p><script>b</script><p>end</p>") == "İ" * 30 + "\nbegin\nend"


def marked(n):
    return f"<nav>menu {n}</nav><article><p>{'word ' * 40}{n}</p><p>{'more ' * 30}{n}</p></article><footer>foot {n}</footer>"


def test_the_sample_is_of_different_labelled_pages(spark, monkeypatch):
    """A page that most rows repeat, under many addresses, and pages without labels take no places."""
    rows = [(n, f"u{n}", marked(n)) for n in range(12)] + [(100 + n, f"x{n}", marked(99)) for n in range(300)]
    rows += [(1000 + n, f"y{n}", f"<div>plain {n}</div>") for n in range(300)] + [(2000, "z", None), (2001, "z", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(6)
    monkeypatch.setattr(extraction, "train", lambda sources: sources)
    assert sorted(extraction.fit(pages)) == sorted(marked(n) for n in [*range(12), 99])
    few = extraction.fit(pages, 5)
    assert len(set(few)) == len(few) == 5
    assert not extraction.fit(pages.where("page_id >= 1000"))
    assert not extraction.fit(pages.where("false"))
