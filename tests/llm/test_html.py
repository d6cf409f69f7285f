import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from censusloom.llm.html import extract, extract_text

CASES = [
    ("<p>one<p>two", "one\n\ntwo"),
    ("a<br>b<div>c</div>d", "a\nb\nc\nd"),
    ("<title>t</title><style>p{}</style><script>var t='</p>';</script>x", "x"),
    ("<!DOCTYPE html><!-- no --><head><meta charset=x>Text", "Text"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>a</li><li><p>b</p><p>c</p></li></ol>", "9. a\n\n10. b\n\n    c"),
    ("<table><tr><td>a<td>bb<tr><th>ccc</th><td>d</table>", "a    bb\nccc  d"),
    ("<table><tr><td colspan=2>wide cell<td>x</tr><tr><td>a<td>b<td>c</table>", "wide cell\na  b  c".replace("wide cell\n", "wide cell  x\n")),
    ("<table><tr><td rowspan=2>a<td>b</tr><tr><td>c</tr></table>", "a  b\n   c"),
    ("<p hidden>no</p><p style='color:red; display : none'>no</p><p>yes", "yes"),
    ("<div style=visibility:hidden>no</div><input type=hidden value=no><input value=yes>", "yes"),
    ("x &amp; y &lt;b&gt; &nbsp;z", "x & y <b> \xa0z"),
    ("a  b\n\t c <b>d</b>e <i> f</i>", "a b c de f"),
    ("<pre>  a\n    b\n</pre>after", "  a\n    b\n\nafter"),
    ("<b>x<p>y</b>z</p>w", "x\n\nyz\n\nw"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("a < b and <3", "a < b and <3"),
    ("text <unfinished attr='", "text"),
    ("<img alt='pic'> <noscript>no</noscript><template>no</template>", "pic"),
    ("", ""),
    ("<select><option>no<option selected>yes</select>end", "yes end"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_rendering(page, text):
    assert extract(page) == text


class _Reference(HTMLParser):
    """Visible words in document order, by the standard library's tokens."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def test_all_visible_words_in_order(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    texts = {r.page_id: r for r in extract_text(pages).collect()}
    for row in pages.collect():
        reference = _Reference()
        reference.feed(row.html)
        reference.close()
        got = [w for w in texts[row.page_id].text.split() if w != "-"]
        assert "".join(got) == "".join(w for w in reference.words if w != "-")


def test_no_text_is_lost():
    rng = random.Random(1)
    tags = ["p", "div", "b", "table", "tr", "td", "li", "ul", "ol", "pre", "dl", "dd", "head", "body", "h1", "br", "blockquote"]
    for _ in range(400):
        page = ""
        for n in range(rng.randrange(60)):
            page += rng.choice([f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", f"w{n} ", "\n"])
        assert sorted(re.findall(r"w\d+", extract(page))) == sorted(re.findall(r"w\d+", page))
    assert extract("<div>" * 20000 + "deep" + "</div>" * 20000) == "deep"
    assert extract("<ul><li>" * 3000 + "deep").endswith("deep")


def test_null_empty_and_repeated(spark):
    rows = [(1, None), (2, ""), (3, "<p>x"), (3, "<p>x"), (None, "<p>a<p>b")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    got = sorted(map(tuple, extract_text(df).collect()), key=str)
    assert got == sorted([(1, None, 0, 0), (2, "", 0, 0), (3, "x", 1, 1), (3, "x", 1, 1), (None, "a\n\nb", 4, 3)], key=str)
    assert extract_text(df.where("false")).collect() == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>so<math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math>holds", "so x = 1 2 holds"),
        ("<math><semantics><mn>3</mn><annotation>no</annotation></semantics></math>", "3"),
        ("a<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><style>no</style><path d='M0'/><text>b</text><text>c <tspan>d</tspan></text></svg>e", "a b c d e"),
        ("<svg><defs/><title/><text>shown</text></svg>", "shown"),
        ("<p>say <textarea rows=2>\nfirst  line &amp; <b>\n  second</textarea> end", "say first  line & <b>\n  second end"),
        ("<textarea></textarea>x<textarea hidden>no</textarea>", "x"),
        ("<desc>kept</desc>", "kept"),
        ("<table><tr><td><svg><text>in</text></svg><td>b</table>", "in  b"),
    ],
)
def test_formulas_drawings_and_fields(page, text):
    assert extract(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("pick <select><option disabled>no<option>first<option>no</select>end", "pick first end"),
        ("<select><optgroup label=x><option>no<option selected>a</optgroup><option selected>b <i>c</i></select>", "b c"),
        ("<select multiple><option>a<option>b</select> <select size=3><option>c<option hidden>no<option>d</select>", "a b c d"),
        ("<select></select>x<select hidden><option>no</select><datalist><option>no</datalist>", "x"),
        ("<a title='x>y' class=\"a'b\">link</a>", "link"),
        ("a<a title=\"un>closed>link", "a"),
        ("a<a <b <c", "a"),
        ("<a <b>x</b>", "x"),
        ("<p a=1b=2 c = 'd' / e>x", "x"),
        ("<p =x=z>y", "y"),
        ("a</ b>c<>d</>e<1>", "a</ b>c<>d</>e<1>"),
        ("a<!bogus b>c<?pi d>e<!--x--->f<!-- rest", "acef"),
    ],
)
def test_choices_and_broken_tags(page, text):
    assert extract(page) == text


def test_columns_are_as_wide_as_their_cells():
    wide = "w" * 70
    page = f"<table><tr><td>{wide}<td>b<td>c</tr><tr><td>a<td>bb<td>c</tr></table>"
    assert extract(page) == f"{wide}  b   c\n{'a':72}bb  c"
    # Five columns from the left by rowspan 0, and a colspan of more than a hundred columns.
    page = "<table><tr><td rowspan=0>s<td colspan=150>x<td>end</tr><tr><td>t<td>u</tr><tr><td>v</tr></table>"
    assert [line.split() for line in extract(page).split("\n")] == [["s", "x", "end"], ["t", "u"], ["v"]]
    assert extract(page).split("\n")[2].startswith("   v")


def test_one_huge_cell_does_not_fill_every_row_with_blanks():
    page = "<table><tr><td>" + "h" * 200_000 + "<td>z</tr>" + "<tr><td>a<td>b</tr>" * 2000 + "</table>"
    lines = extract(page).split("\n")
    assert sum(map(len, lines)) < 20 * 220_000 and lines[0] == "h" * 200_000 + "  z" and lines[1] == "a  b"


@pytest.mark.parametrize(
    "piece",
    ["<a ", "<a '", "<a <", "<", "</", "<!", "<!-", "<!--", "<a=", "<a b", "<div>", "<p>", "</p>", "</x>", "<b><p></b>", "<table>", "<table><td>", "<td>",
     "<table><tr><td rowspan=9999>x", "<td colspan=1000 rowspan=0>x", "<li>", "<ul>", "<head>", " <!----><head>", "<select>", "<option>", "<svg>", "<p><table><td><div>", "&", "<dd>", "<i>", "<ul><li>x", "<blockquote>x", "<dl><dd>x"],
)
def test_time_follows_the_length_of_broken_pages(piece):
    import time

    def spent(n):
        start = time.perf_counter()
        extract(piece * n)
        return time.perf_counter() - start

    size = 300_000 // len(piece)
    assert spent(size) < max(8 * spent(size // 4), 1.0) and spent(size) < 8


def test_deep_nesting_keeps_all_text():
    for piece in ("<table><tr><td>x{}<td>y", "<ul><li>x{}", "<blockquote>x{}"):
        page = "".join(piece.format(k) for k in range(200))
        assert re.findall(r"x\d+", extract(page)) == [f"x{k}" for k in range(200)]
