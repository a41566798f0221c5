import random

from quire.functions.text import html_to_markdown, lossy_utf8
from tests import models


def test_markdown_fixtures(spark):
    cases = [
        ("<h2>A</h2><p>b &amp; c</p>", "\n## A\n\n\nb &amp; c\n"),
        ('<p class="x">b<br />c</p>', "bc\n"),
        ("<ul><li>a</li></ul>", "\n- a\n\n"),
        ("a <> b < c > d", "a <> b  d"),
        ("<H1>x</H1>", "x"),
    ]
    df = spark.createDataFrame([(h,) for h, _ in cases], "h string")
    got = [r[0] for r in df.select(html_to_markdown("h")).collect()]
    assert got == [m for _, m in cases]


def test_markdown_matches_model(spark):
    rnd = random.Random(11)
    pieces = ["<h1>", "</h1>", "<h6>", "</h3>", "<p>", "</p>", "<br>", "<br/>", "<br />", "<ul>", "</ol>",
              "<li>", "</li>", "<div class='q'>", "<", ">", "text", " ", "&amp;", "<script>x</script>", "\n"]
    docs = ["".join(rnd.choices(pieces, k=rnd.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame([(d,) for d in docs], "h string")
    got = [r[0] for r in df.select(html_to_markdown("h")).collect()]
    assert got == [models.markdown(d) for d in docs]


def test_lossy_utf8(spark):
    blobs = [b"\x01\x02\x03\x04", b"\xff", b"\xc3\x28", b"\xed\xa0\x80", "héllo".encode(), b""]
    df = spark.createDataFrame([(bytearray(b),) for b in blobs], "b binary")
    got = [r[0] for r in df.select(lossy_utf8("b")).collect()]
    assert got == [b.decode("utf-8", "replace") for b in blobs]
    assert got[1] == "�" and got[2] == "�(" and got[3] == "�" * 3


def test_lossy_utf8_matches_python_on_random_bytes(spark):
    rnd = random.Random(17)
    pool = [b"a", b"\xc3\xa9", b"\xe6\x97\xa5", b"\xf0\x9f\x98\x80", b"\xff", b"\xc3", b"\xe6\x97", b"\xf0\x9f",
            b"\xed\xa0\x80", b"\xc0\xaf", b"\xf4\x90\x80\x80", b"\x80", b"\xbf", b"\x00"]
    blobs = [b"".join(rnd.choices(pool, k=rnd.randint(0, 12))) for _ in range(600)]
    df = spark.createDataFrame([(bytearray(b),) for b in blobs], "b binary")
    got = [r[0] for r in df.select(lossy_utf8("b")).collect()]
    assert got == [b.decode("utf-8", "replace") for b in blobs]
