"""Page text around elements whose content holds no tags."""

import time

import pytest

from corpusmill.llm import html_text

ARTICLE = "<article><p>This is the text of the page and it is what is to be found.</p></article>"
WANT = "This is the text of the page and it is what is to be found."


@pytest.mark.parametrize(
    "before",
    [
        "<script>for(i=0;i<n;i++){x=1}</script>",
        "<script>if(a<b){s='it</script>",
        "<script>i<n // don't\n</SCRIPT\n>",
        "<script><!-- i<n </script>",
        "<script><!-- document.write('<script>i<n</script>') --></script>",
        "<script><!-- x = '<script>' </script>",
        "<script>s='</scripts>';i<n</script >",
        "<style>a<b{}</style>",
        "<title>i<n</title>",
        "<textarea>i<n</textarea>",
        "<canvas><script>i<n; // don't\n</script></canvas>",
        "<svg><!-- </svg> --><title>a</title><g/></svg>",
    ],
)
def test_less_than_a_letter_keeps_the_article(before):
    assert html_text.extract(f"<html><body>{before}{ARTICLE}<p>don't</p></body></html>").split("\n")[0] == WANT


def test_without_an_end():
    assert html_text.extract(f"{ARTICLE}<script>i<n") == html_text.extract(f"{ARTICLE}<script>i<n</script") == WANT


@pytest.mark.parametrize("page", ["<a " * 330_000, '<a ">" ' * 40_000, '<a "' * 250_000, "<svg>" + "<script>" * 120_000, "<!" * 500_000, "<!--" * 250_000])
def test_broken_pages_take_linear_time(page):
    began = time.process_time()
    html_text.extract(page + "\n")
    assert time.process_time() - began < 20


def test_rows(spark):
    html = "<p>only this</p>"
    rows = [(1, html, "x", "y"), (1, html, "x", "y"), (None, None, None, None), (2, "", "x", None), (3, "<p>the" + " of" * 100_000, "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, html string, _text string, text string")
    got = sorted(((r.page_id, r._text, r.text) for r in html_text.extract_text(df).collect()), key=repr)
    assert got == sorted([(1, "only this", "y"), (1, "only this", "y"), (None, "", None), (2, "", None), (3, "the" + " of" * 100_000, "y")], key=repr)
