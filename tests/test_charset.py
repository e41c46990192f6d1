"""Response bodies as text of their charset."""

import pytest
from compare import plan

from folio.functions.charset import with_text
from folio.sources.fetch import stated_charset
from folio.sources.responses import page_attempts

BODIES = {
    ("été".encode(), None): "été",
    ("été".encode("latin-1"), None): "été",  # no UTF-8, so Latin-1
    ("été".encode("latin-1"), "ISO-8859-1"): "été",
    ("été".encode(), "'Latin1' "): "Ã©tÃ©",  # the header counts, right or wrong
    ("été".encode("latin-1"), "utf-8"): "\ufffdt\ufffd",
    ("本".encode("shift_jis"), "Shift_JIS"): "本",
    ("“x”".encode("cp1252"), "windows-1252"): "“x”",
    ("été".encode(), "no-such-charset"): "été",
    ("<meta charset=shift_jis>本".encode("shift_jis"), None): "<meta charset=shift_jis>本",
    ("<meta http-equiv=x content='text/html; charset=koi8-r'>да".encode("koi8-r"), None): "<meta http-equiv=x content='text/html; charset=koi8-r'>да",
    ("<meta charset=latin1>é".encode(), "utf-8"): "<meta charset=latin1>é",
    ((" " * 1100 + "<meta charset=latin1>é").encode(), None): " " * 1100 + "<meta charset=latin1>é",
    (b"", None): "",
    (None, "utf-8"): None,
}


def frame(spark):
    return spark.createDataFrame([(k, *x) for k, x in enumerate(BODIES)], "k int, body binary, charset string")


def test_text(spark):
    rows = with_text(frame(spark), "body", "charset", "text").collect()
    assert [row.text for row in sorted(rows)] == list(BODIES.values())


def test_text_without_python(spark):
    df = with_text(frame(spark), "body", "charset", "text", any_charset=False)
    assert "ArrowEvalPython" not in plan(df)
    rows = {row.k: row.text for row in df.collect()}
    assert [rows[k] for k in range(5)] == list(BODIES.values())[:5] and rows[13] is None


@pytest.mark.parametrize(("header", "name"), [(None, None), ("text/html", None), ('text/html; charset="UTF-8"', "UTF-8"), ("a;CHARSET = x;b", "x")])
def test_header(header, name):
    assert stated_charset(header) == name


@pytest.mark.parametrize("mode", ["native", "auto", "strict"])
def test_address_with_accents(spark, mode):
    page = '<meta property="og:image" content="https://i/été.jpg">'
    rows = [("u", "page", 1, 200, page.encode("latin-1"), None, "latin-1"), ("v", "page", 1, 200, page.encode(), None, None)]
    log = spark.createDataFrame(rows, "url string, kind string, attempt int, status int, body binary, error string, charset string")
    assert {row.img_url for row in page_attempts(log, mode).collect()} == {"https://i/été.jpg"}
    assert {row.img_url for row in page_attempts(log.drop("charset"), mode).collect()} == {"https://i/été.jpg"}
