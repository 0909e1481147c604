from __future__ import annotations

import pytest

from tillwright import schemas
from tillwright.operators import headings, pages, regions
from tillwright.sinks.lake import write_csv

LISTING = """<html><!-- <div class="item-category-des"><a href="/no"></a></div> -->
<script>var x = '<div class="item-category-des"><a href="/no2">';</script>
<div class="wide item-category-des"><span><a href="/one?a=1&amp;b=2">1</a></span><a href="/x">x</a></div>
<div class="item-category-des"><p>no anchor</p></div><a href="/outside">o</a>
<div class="item-category-des"><a href="">empty</a><a href="/second">2</a></div>
<div class="item-category-des"><a>no target</a></div>
<div class="item-category-des"><div><a href="/two">2</a></div></div>
<div class="item-category-des"><a href="/two">again</a></div>
<div class="item-category-desk"><a href="/no3">3</a></div></html>"""

DETAIL = """<div class="mnv-product-details {size}"> <h1> Chảo <b> chống dính </b>\n</h1>{inside}</div>
{outside}"""

CARD = "shop-liststyles__ShopCard-sc-w4fccm-2 jYpNtY"
HEAD = "shop-liststyles__TitleHeader-sc-w4fccm-4 kIDuvy"
NAME = "shop-liststyles__StoreHeader-sc-w4fccm-6"
STORES = f"""
<div class="{CARD}"><div class="{NAME}">Early</div><div>Street 0</div></div>
<section><div class="{HEAD}"> Quận 1 <i>!</i></div>
<div class="{CARD}"><div class="{NAME}"> Shop A </div><div> Street <b>1</b> </div></div>
<div class="{CARD}"><div>no name</div><div>Street 2</div></div></section>
<div class="{HEAD}">Quận 2</div>
<div class="{CARD}"><div class="{NAME}">Shop B</div></div>
<div class="{CARD}">bare</div>"""


def frame(spark, *html):
    rows = [(n, f"http://p/{n}", h) for n, h in enumerate(html)]
    return spark.createDataFrame(rows, schemas.PAGES)


def test_links(spark, rows):
    got = pages.harvest_links(frame(spark, LISTING, "<p>none</p>", None))
    assert [(r.page_id, r.link) for r in got.orderBy("pos").collect()] == [
        (0, "/one?a=1&b=2"), (0, "/two"), (0, "/two")
    ]
    assert rows(pages.harvest_links(frame(spark, LISTING), distinct=True)) == [
        ("/one?a=1&b=2",), ("/two",)
    ]


def test_class_names_written_with_references_are_found(spark):
    html = '<div class="item&#45;category-des"><a href="/x">x</a></div>'
    assert pages.harvest_links(frame(spark, html)).count() == 1


def test_details(spark, rows):
    price, code = '<span class="price-new"> 10.000 <u>đ</u></span>', '<i id="p_model">K-1</i>'
    got = pages.product_details(
        frame(
            spark,
            DETAIL.format(size="col-sm-5", inside=price, outside=code),
            DETAIL.format(size="col-sm-6", inside="", outside=price),
            DETAIL.format(size="col-sm-4", inside=price, outside=code),
            '<div class="col-sm-5 mnv-product-details"></div><h1>elsewhere</h1>',
        )
    )
    assert rows(got, "page_id", "name", "price", "code") == [
        (0, "Chảochống dính", "10.000đ", "K-1"),
        (1, "Chảochống dính", "10.000đ", ""),
        (3, None, "", ""),
    ]


def test_store_cards(spark):
    got = pages.store_cards(frame(spark, STORES, "<div>none</div>")).orderBy("pos").collect()
    assert [(r.district, r.shop_name, r.address) for r in got] == [
        (None, "Early", "Street 0"),
        ("Quận 1!", "Shop A", "Street1"),
        ("Quận 1!", None, "Street 2"),
        ("Quận 2", "Shop B", None),
        ("Quận 2", None, None),
    ]


def test_python_sees_each_page_once(spark):
    for found in (
        pages.product_details(frame(spark, LISTING)), pages.store_cards(frame(spark, LISTING)),
        pages.harvest_links(frame(spark, LISTING)),
    ):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_fill_forward(spark, rows):
    df = spark.createDataFrame(
        [(1, 0, None), (1, 1, "a"), (1, 2, None), (1, 3, "b"), (1, 4, None), (2, 5, None)],
        "page_id int, pos int, heading string",
    )
    assert [r[2] for r in rows(headings.fill_forward(df, "heading", ["page_id"], "pos"))] == [
        None, "a", "a", "b", "b", None
    ]


@pytest.mark.parametrize(
    "name, slug",
    [
        ("TP. Hà Nội", "thanh-pho-ha-noi"),
        ("T. Phú Thọ", "tinh-phu-tho"),
        ("T. Đắk Lắk", "tinh-dak-lak"),
        ("TP Đà Nẵng", "thanh-pho-da-nang"),
        ("T. Thừa Thiên - Huế", "tinh-thua-thien-hue"),
        ("T. Bà Rịa - Vũng Tàu", "tinh-ba-ria-vung-tau"),
        ("Hạt Giang", "hatinh-giang"),
        ("  T.  Hà   Giang!  ", "tinh-ha-giang"),
        ("Hạt ", "hat"),
        ("Cần Thơ", "can-tho"),
        ("", ""),
    ],
)
def test_slugs(spark, name, slug):
    df = spark.createDataFrame([(name,)], "province string")
    row = regions.region_links(df, "https://stores.example.com/").first()
    assert (row.slug, row.link) == (slug, f"https://stores.example.com/{slug}")


def test_one_csv_per_slug(spark, tmp_path):
    df = spark.createDataFrame([("x", "tinh-a"), ("y", "tinh-b")], "shop_name string, slug string")
    write_csv(df, str(tmp_path / "out"), "slug")
    read = spark.read.option("header", True).csv(str(tmp_path / "out" / "slug=tinh-b"))
    assert [tuple(r) for r in read.collect()] == [("y",)]
