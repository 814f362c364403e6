import pytest

from tallyfold.llm.extract import extract_text, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="has-sidebar"><header class="site">Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="notice cookie">We use cookies, accept them please, all of them, right now.</div><!-- <p>no</p> -->
<div class="ad">Buy &amp; save a lot of money with this very long advert that has no links at all.</div>
<article><header><h1>Title &lt;1&gt;</h1></header>
<p><b>First   paragraph<br><p>Second &amp; <i>third</i>&nbsp;part,
over two lines.</p><ul><li>one<li>two</ul>
<div class="comments"><p>A reader says a lot of things here, too many to count them all.</p></div>
<form><input value="x"><button>Send</button></form><table><tr><td>cell a<td>cell b</table></article>
<aside>Side</aside><footer>&copy; Foot</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n") == [
        "Title <1>",
        "First paragraph",
        "Second & third part, over two lines.",
        "one",
        "two",
        "cell a",
        "cell b",
    ]


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain text", "plain text"),
        ("a < b & c", "a < b & c"),
        ("<p>&am &amp &#65;&#x42;", "&am & AB"),
        ("<div><p>x</p></div><script>never closed <p>no", "x"),
        ('<p title="a>b">x</p>', "x"),
        ('<p title="never closed>x', "x"),
        ("<!-- never closed <p>x", ""),
        ("<p>a</b></i></div>b</p>c", "ab\nc"),
        ("<body>" + "<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<p>" + "long " * 50_000, ("long " * 50_000).strip()),
        ("<div class='page sidebar-left'><nav>n</nav><main><p>inside</p></main></div>", "inside"),
        ("<article><h1>Only a title</h1></article><div class='ad'>" + "advert " * 50 + "</div>", "Only a title"),
        ('<p>Let <math><mi>x</mi><annotation encoding="tex">\\x</annotation></math> be', "Let x be"),
        ("<p>a <svg><title>t</title><style>.b{}</style><text>drawn</text></svg> <object data='f'>instead</object> z", "a drawn instead z"),
        ("<p>İstanbul<script>x</SCRIPT>y</p>", "İstanbuly"),
    ],
)
def test_awkward_pages(source, text):
    assert main_text(source) == text


def test_dense_part_wins_over_links():
    links = "".join(f'<li><a href="{i}">link number {i}</a></li>' for i in range(40))
    source = f"<body><div><ul>{links}</ul></div><div><p>{'Prose of some length. ' * 10}</p><p>{'More of it here. ' * 9}</p></div></body>"
    assert main_text(source) == ("Prose of some length. " * 10).strip() + "\n" + ("More of it here. " * 9).strip()


def test_pages_table(spark):
    schema = "page_id long, url string, html string, text int"
    frame = spark.createDataFrame([(1, "u", PAGE, 5), (1, "u", PAGE, 5), (2, None, None, 5), (None, "v", "<p>x", 5)], schema)
    rows = sorted((str(r.page_id), r.url, r.text) for r in extract_text(frame).collect())
    assert rows == sorted([("1", "u", main_text(PAGE))] * 2 + [("2", None, ""), ("None", "v", "x")], key=lambda r: (r[0], str(r[1])))
    assert extract_text(frame.where("false")).collect() == []
