import pytest
from pyspark.sql import functions as F

from plumbline.sources import html_pages as hp


@pytest.fixture
def pages(spark):
    def make(*html):
        return spark.createDataFrame(list(enumerate(html)), "id int, html string")
    return make


def col(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def test_paragraphs(pages):
    df = pages(
        "<p>one</p><div><p>two <b>bold</b></p></div>",
        '<script>var t="</p><p>no</p>";</script><style>p{}</style><p>a &amp; b<!-- c --></p>',
        "<p>open<p>nested</p> tail</p>",
        "<div>none</div>",
        None,
        "",
    )
    assert col(hp.html_paragraphs(df, "html", ["id"]), "text") == [
        "one two bold", "a & b", "open nested", "", hp.ERROR_TEXT, ""]


def test_stray_end_tags_and_open_elements(pages):
    df = pages("</p></div><p>a<br>b<img src=x>c", "<p>x</i>y</p>", "<P CLASS=z>up</P>")
    assert col(hp.html_paragraphs(df, "html", ["id"]), "text") == ["abc", "xy", "up"]


def test_blank_text_between_elements_shrinks(pages):
    df = pages("<p>a<b> x </b>   <i>b</i> \n  <i>c</i></p><pre>  </pre>")
    assert col(hp.html_paragraphs(df, "html", ["id"]), "text") == ["a x  b\nc"]


def test_main_text_and_heading(pages):
    df = pages(
        '<div class="x post y"><h1>Title</h1><p>Body</p></div><div class="post">second</div>',
        '<h1>outside</h1><div class="poster">no</div>',
        '<div class="post">no heading</div><h1>after</h1>',
    )
    got = hp.html_main_text(df, "html", ["id"], "div", "post").orderBy("id").collect()
    assert [(r.main_text, r.heading) for r in got] == [
        ("TitleBody", "Title"), (None, None), ("no heading", None)]


def test_next_link(pages):
    df = pages(
        '<a href="/no">x</a><div class="nav right"><span><a href="/yes?a=1&amp;b=2">n</a></span></div>',
        '<div class="right">no link</div><a href="/later">x</a>',
        '<div class="right"><a>no target</a></div>',
    )
    assert col(hp.html_next_link(df, "html", ["id"], "div", "right"), "next_link") == [
        "/yes?a=1&b=2", None, None]


def test_class_fields(pages):
    quote = ('<div class="quote"><span class="strike">{}</span><i><span class="expiry">{}</span></i>'
             "</div>")
    df = pages(quote.format(100, "2024-01-05") + "<hr>" + quote.format(110, "2024-01-12"),
               '<div class="quote"><span class="strike">90</span></div>', "<div>none</div>")
    got = hp.html_class_fields(df, "html", ["id"], "div", "quote", [
        ("strike", "span", "strike"), ("expiry", "span", "expiry")]).collect()
    assert {tuple(r) for r in got} == {
        (0, 1, "100", "2024-01-05"), (0, 2, "110", "2024-01-12"), (1, 1, "90", None)}


def test_nth_table_with_inner_table(pages):
    inner = "<table><tr><th>In</th></tr><tr><td>i</td></tr></table>"
    df = pages(
        "<table><tr><th>A</th><th>B</th></tr>"
        f"<tr><td>1</td><td>x{inner}</td></tr><tr><td>2</td><td> y </td></tr></table>"
        "<table><thead><tr><th>C</th></tr></thead><tbody><tr><td>9</td></tr></tbody></table>",
        "<p>no table</p>",
    )
    first = hp.html_tables(df, "html", ["id"], 0).orderBy("row_no").collect()
    assert [r.header for r in first] == [["A", "B"]] * 2
    assert [r.cells[0] for r in first] == ["1", "2"] and first[1].cells[1] == "y"
    assert [len(r.cells) for r in first] == [2, 2]
    second = hp.html_tables(df, "html", ["id"], 1).collect()
    assert [(r.header, r.cells) for r in second] == [(["In"], ["i"])]
    third = hp.table_columns(hp.html_tables(df, "html", ["id"], 2), ["C", "D"], ["id"]).collect()
    assert [(r.C, r.D) for r in third] == [("9", None)]


def test_large_page_is_read_to_its_end(pages):
    n = 20_000
    df = pages("".join(f"<p>{i}</p>" for i in range(n)))
    text = hp.html_paragraphs(df, "html", ["id"]).first().text
    assert text.split() == [str(i) for i in range(n)]


def test_only_the_page_column_travels_to_python(pages, plan):
    df = pages("<p>a</p>").withColumn("wide", F.lit("w"))
    text = plan(hp.html_paragraphs(df, "html", ["id", "wide"]))
    assert "ArrowEvalPython" in text


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Python workers start in a folder from which the package cannot be imported."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {repo!r})
from plumbline.session import build_session
from plumbline.sources import html_pages as hp
spark = build_session("ship", "local[1]")
df = spark.createDataFrame([(0, "<p>a</p><p>b</p>")], "id int, html string")
print("GOT", hp.html_paragraphs(df, "html", ["id"]).first().text)
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, text=True,
                         capture_output=True, timeout=200)
    assert "GOT a b" in out.stdout


def test_open_paragraphs_do_not_pile_up(pages):
    df = pages("<p>x" * 2000, "<p>a<table><tr><td><p>b</table>c</p>", "<p>a<div>b</div>c")
    assert [len(t) for t in col(hp.html_paragraphs(df, "html", ["id"]), "text")][0] == 3999
    assert col(hp.html_paragraphs(df, "html", ["id"]), "text")[1:] == ["abc b", "a"]
