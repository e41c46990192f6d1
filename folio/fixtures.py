"""Inputs derived from the given tables by rule: they grow with them and read all their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ATTEMPTS = 4  # one more than a run may use
SUFFIXES = ("/a.jpg", "/b.jpg", "/c.jpg", "/d.jpg?a=1&b=2", "/e.jpg")


# Columns in use; a stated schema spares the job that reads file footers.
SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_totalprice DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A book per order; its genres come from a part, chosen over the whole part table."""
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    n_parts = part.agg(F.count("*")).scalar()
    keyed = orders.select("o_orderkey", "o_totalprice", (F.col("o_orderkey") % n_parts).alias("p_partkey"))
    return keyed.join(part.select("p_partkey", "p_name", "p_type", "p_brand"), "p_partkey").selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        "concat('https://books.example/', CAST(o_orderkey AS STRING)) AS url",
        """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '[]'
           ELSE concat('["', replace(p_name, ' ', '", "'), '", "', p_type, '", "', p_brand, '"]') END AS genres""",
        "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 10) AS BIGINT) END AS num_ratings",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderkey % 500 END AS num_reviews",
    )


def odd_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A book per part whose genre list is an escaped literal, a tuple, no list, or of mixed quotes."""
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS id",
        r"""CASE p_partkey % 4 WHEN 0 THEN concat("['", p_name, "\\'s', None]") WHEN 1 THEN concat('("', p_type, '",)')
            WHEN 2 THEN concat('no list ', p_name) ELSE concat('["', p_brand, "\", '", p_type, "']") END AS genres""",
    )


def page_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, each with one of nine kinds of cover markup put into its head."""
    page = "CAST(page_id AS STRING)"
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "url",
        f"""replace(html, '</head>', concat(CASE page_id % 9
          WHEN 0 THEN concat('<meta property="og:image" content="https://img.example/', {page}, '/a.jpg"/>')
          WHEN 1 THEN concat('<img id="coverImage" src="https://img.example/', {page}, '/b.jpg">')
          WHEN 2 THEN concat('<meta property="og:image" content="https://img.example/', {page},
                             '/c.jpg"><img id="coverImage" src="https://img.example/x.jpg">')
          WHEN 3 THEN '<meta property="og:image"><img id="coverImage" src="https://img.example/x.jpg">'
          WHEN 4 THEN '<meta property="og:image" content="https://img.example/site-LOGO.png">'
          WHEN 5 THEN '<meta property="og:title" content="t"><meta property="OG:IMAGE" content="https://img.example/case.jpg">'
          WHEN 6 THEN concat("<META content='https://img.example/", {page}, "/d.jpg?a=1&amp;b=2' PROPERTY='og:image'>")
          WHEN 7 THEN '<img id="coverImage">'
          ELSE concat('<!-- <meta property="og:image" content="https://img.example/no.jpg"> --><img src="https://img.example/',
                      {page}, '/e.jpg" id="coverImage">')
          END, '</head>')) AS html""",
    )


def scrape_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A book per page; every tenth shares the id of the one before."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id AS ord", "CAST(CASE WHEN page_id % 10 = 9 THEN page_id - 1 ELSE page_id END AS STRING) AS id", "url"
    )


def existing_covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").where("page_id % 12 = 0").selectExpr("CAST(page_id AS STRING) AS id")


def _attempts() -> Column:
    return F.explode(F.array(*[F.lit(a) for a in range(1, ATTEMPTS + 1)])).alias("attempt")


PAGE_STATUS = "CASE WHEN (page_id * 7 + attempt * 5) % 4 = 0 THEN 503 ELSE 200 END AS status"


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", _attempts())
    return pages.selectExpr("url", "attempt", PAGE_STATUS)


def page_attempts(cover_urls: DataFrame) -> DataFrame:
    """``page_log`` with the address found in each page: every attempt gets the same body."""
    return cover_urls.select("page_id", "url", "img_url", _attempts()).selectExpr("url", "attempt", PAGE_STATUS, "img_url")


def image_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image responses with their sizes; null stands for an unreadable image."""
    pages = table(spark, sf_dir, "pages").select("page_id", _attempts())
    asked = pages.select("*", F.explode(F.array(*map(F.lit, SUFFIXES))).alias("suffix"))
    return asked.selectExpr(
        "concat('https://img.example/', CAST(page_id AS STRING), suffix) AS img_url",
        "attempt",
        "CASE WHEN (page_id + attempt) % 3 = 0 THEN 404 ELSE 200 END AS status",
        "CASE WHEN (page_id + attempt) % 5 = 0 THEN NULL ELSE 80 + (page_id * 13 + attempt * 40) % 200 END AS width",
        "CASE WHEN (page_id + attempt) % 5 = 0 THEN NULL ELSE 130 + (page_id * 11) % 120 END AS height",
    )


def _be(value: str, digits: int) -> str:
    return f"lpad(hex({value}), {digits}, '0')"


def _le(value: str, digits: int) -> str:
    """Little-endian hex of a number below 65536."""
    return f"concat(lpad(hex(({value}) % 256), 2, '0'), lpad(hex(({value}) div 256), 2, '0'), '{'0' * (digits - 4)}')"


def image_header(kind: str, width: str, height: str) -> str:
    """SQL for the hex text of an image header of the given size, up to where the pixels begin."""
    if kind == "png":
        head = f"concat('49484452', {_be(width, 8)}, {_be(height, 8)}, '0802000000')"
        return f"concat('89504E470D0A1A0A0000000D', {head}, {_be(f'crc32(unhex({head}))', 8)}, '0000000049444154')"
    if kind == "jpeg":
        return (
            f"concat('FFD8FFE000104A46494600010100000100010000', 'FFC0001108', {_be(height, 4)}, {_be(width, 4)},"
            " '03011100021101031101', 'FFDA000C03010002110311003F00')"
        )
    if kind == "long jpeg":  # a large segment before the frame header
        return (
            "concat('FFD8FFE1', 'EA62', repeat('20', 60000), 'FFC2001108',"
            f" {_be(height, 4)}, {_be(width, 4)}, '03011100021101031101', 'FFDA000C03010002110311003F00')"
        )
    if kind == "gif":
        return (
            f"concat('474946383961', {_le(width, 4)}, {_le(height, 4)}, '000000', '2C00000000',"
            f" {_le(width, 4)}, {_le(height, 4)}, '00')"
        )
    if kind == "bmp":
        return (
            f"concat('424D000000000000000036000000', '28000000', {_le(width, 8)}, {_le(height, 8)}, '01001800',"
            " repeat('00', 24))"
        )
    if kind == "webp":  # width and height less one share four bytes
        both = f"(({width} - 1) + ({height} - 1) * 16384)"
        return (
            "concat('524946461200000057454250', '5650384C050000002F',"
            f" {_le(f'{both} % 65536', 4)}, {_le(f'{both} div 65536', 4)}, '00')"
        )
    raise ValueError(kind)


# A picture per page: six readable kinds, a cut-off one and one that is no image.
# Their headers take 41, 53, 23, 54, 26 and 60,039 bytes.
KINDS = ("png", "jpeg", "gif", "bmp", "webp", "long jpeg")
WIDTH = "(80 + page_id * 13 % 200)"
HEIGHT = "(130 + page_id * 11 % 120)"


def page_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, content``: a header of the kind given by the page id, then the page text as its data."""
    by_kind = " ".join(
        f"WHEN {at} THEN {image_header(kind, WIDTH, HEIGHT)}" for at, kind in enumerate(KINDS)
    )
    return table(spark, sf_dir, "pages").selectExpr(
        "CAST(page_id AS STRING) AS id",
        f"""CASE WHEN page_id % 8 = 7 THEN CAST(html AS BINARY) WHEN page_id % 8 = 6 THEN unhex('89504E470D0A1A0A0000')
            ELSE CAST(concat(unhex(CASE page_id % 8 {by_kind} END), CAST(html AS BINARY)) AS BINARY) END AS content""",
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_variants``, ``page_log`` and ``image_log`` as responses with bodies."""
    pages = page_variants(spark, sf_dir).select("page_id", "url", "html", _attempts())
    page_rows = pages.selectExpr(
        "url",
        "'page' AS kind",
        "attempt",
        PAGE_STATUS,
        "CAST(html AS BINARY) AS body",
        "CAST(NULL AS STRING) AS error",
    )
    by_kind = " ".join(
        f"WHEN {at} THEN {image_header(kind, 'width', 'height')}" for at, kind in enumerate(KINDS[:5])
    )
    image_rows = image_log(spark, sf_dir).selectExpr(
        "img_url AS url",
        "'image' AS kind",
        "attempt",
        "status",
        f"""CASE WHEN width IS NULL THEN CAST('no image' AS BINARY)
            ELSE unhex(CASE width % 5 {by_kind} END) END AS body""",
        "CAST(NULL AS STRING) AS error",
    )
    return page_rows.unionByName(image_rows)


def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page response per page, in Latin-1 by its header, in Latin-1 by its own word, or in UTF-8 without a word."""
    return table(spark, sf_dir, "pages").selectExpr(
        "url",
        "'page' AS kind",
        "1 AS attempt",
        "200 AS status",
        """concat('<html><head>', CASE page_id % 3 WHEN 1 THEN '<meta charset="ISO-8859-1">' ELSE '' END,
                  '<meta property="og:image" content="https://img.example/\u00e9t\u00e9/', page_id, '.jpg"></head>',
                  regexp_replace(html, '[^ -~]|<meta', ' ')) AS text""",
        "CASE page_id % 3 WHEN 0 THEN 'Latin-1' END AS charset",
        "page_id",
    ).selectExpr(
        "url", "kind", "attempt", "status", "charset",
        "CASE WHEN page_id % 3 < 2 THEN encode(text, 'ISO-8859-1') ELSE CAST(text AS BINARY) END AS body",
    )
