"""Text of a response body by its charset.

What the response's header states counts first, then what the page declares in its first kilobyte, then
UTF-8 if the bytes are that, else Latin-1. Bytes that do not fit the charset become the replacement sign; a
name that nobody knows stands for UTF-8.
"""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Names of the two charsets that need no reading in Python.
UTF_8 = ("utf-8", "utf8", "unicode-1-1-utf-8")
LATIN_1 = ("iso-8859-1", "iso8859-1", "iso_8859-1", "latin-1", "latin1", "l1")

_HEAD_BYTES = 1024
_DECLARED = r"""(?i)<meta\s[^>]*?charset\s*+=\s*+["']?\s*+([a-z0-9_:.-]++)"""


def declared_charset(body: Column) -> Column:
    """The charset a page names in its first kilobyte, or null."""
    head = F.decode(F.substring(body, 1, _HEAD_BYTES), "ISO-8859-1")
    return F.nullif(F.lower(F.regexp_extract(head, _DECLARED, 1)), F.lit(""))


def charset_of(body: Column, stated: Column) -> Column:
    """The charset by which a body is read, in lower case."""
    name = F.nullif(F.lower(F.trim(F.translate(stated, "\"'", ""))), F.lit(""))
    guessed = F.when(F.is_valid_utf8(body.cast("string")), F.lit(UTF_8[0])).otherwise(F.lit(LATIN_1[0]))
    return F.coalesce(name, declared_charset(body), guessed)


@pandas_udf(T.StringType())
def _decode_by_name(bodies: pd.Series, names: pd.Series) -> pd.Series:
    def decode(body, name):
        if body is None:
            return None
        try:
            text = bytes(body).decode(codecs.lookup(name).name, "replace")
        except LookupError:
            text = bytes(body).decode("utf-8", "replace")
        return text.encode("utf-8", "replace").decode()  # lone surrogates cannot be stored

    return pd.Series([decode(*row) for row in zip(bodies, names)], dtype=object)


def with_text(df, body: str, charset: str, out: str, any_charset: bool = True):
    """Replace ``body`` and ``charset`` by the text.

    UTF-8 and Latin-1 are read in the JVM. With ``any_charset`` the bodies in others, and only these, go through Python;
    without it they are read as Latin-1, which leaves ASCII as it is.
    """
    kept = [name for name in df.columns if name not in (body, charset)]
    named = df.select(*kept, body, charset_of(F.col(body), F.col(charset)).alias("_charset"))
    content, name = F.col(body), F.col("_charset")
    utf_8 = F.make_valid_utf8(content.cast("string"))
    latin_1 = F.decode(content, "ISO-8859-1")
    if not any_charset:
        return named.select(*kept, F.when(name.isin(*UTF_8), utf_8).otherwise(latin_1).alias(out))
    other = ~name.isin(*UTF_8, *LATIN_1)
    read = _decode_by_name(F.when(other, content), name)
    return named.select(*kept, F.when(name.isin(*UTF_8), utf_8).when(name.isin(*LATIN_1), latin_1).otherwise(read).alias(out))
