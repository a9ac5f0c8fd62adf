from pyspark.sql import functions as F

from tessera.functions import html as H
from tessera.functions import nested as N

BOOKS = """<html><body><ol>
<li><article class="product_pod"><h3><a href="a.html" title="A Light &amp; Dark">A Light...</a></h3>
<p class="star-rating Three"></p><div><p class="price_color">£51.77</p>
<p class="instock availability"> In stock </p></div></article></li>
<li><article class="product_pod"><h3><a href="b.html" title="Tipping">Tip</a></h3>
<p class="star-rating One"></p><p class="price_color">Â£53.74</p><p class="instock availability">In stock</p></article></li>
</ol><ul class="pager"><li class="current"> Page 1 of 50 </li></ul></body></html>"""


def test_book_records(spark):
    df = spark.createDataFrame([(1, BOOKS)], "page_id long, html string")
    fields = {"title": ("a", None, "title"), "rating": ("p", "star-rating", "class", 1),
              "price": ("p", "price_color"), "stock": ("p", "instock availability")}
    out = H.extract_records(df, "html", "page_id", ("article", "product_pod"), fields).orderBy("position").collect()
    assert [(r.title, r.rating, r.price, r.stock) for r in out] == [
        ("A Light & Dark", "Three", "£51.77", "In stock"), ("Tipping", "One", "Â£53.74", "In stock")]
    pager = H.extract_records(df, "html", "page_id", ("li", "current"), {"t": ("li", "current")}).collect()
    assert len(pager) == 1


def test_pairs_and_multivalued(spark):
    df = spark.createDataFrame([(1, [2, 3]), (2, [1]), (3, [])], "id int, f array<int>")
    pairs = {(r.a, r.b): r.mutual for r in N.pairs_from_arrays(df, "id", "f").collect()}
    assert pairs == {(1, 2): True, (1, 3): False}
    counts = {r.value: r.n for r in N.count_per_value(df, "f").collect()}
    assert counts == {2: 1, 3: 1, 1: 1, None: 1}
    assert [r.n_values for r in N.values_per_row(df, "id", "f").orderBy("id").collect()] == [2, 1, 0]


def test_broken_markup_ends_no_page():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tessera.functions.html import parse_records
    item = "<li><a href='x'>name</a></li>"
    fields = {"href": ("a", None, "href", None)}
    for odd in ("<![if foo]>", "<![foo[ y ]]>", "<![endif]-->", "<!", "<!DOCTYPE", "<?x", "</", "<![CDATA[ z ]]>", "&#xFFFFFFFF;", "<a b='"):
        assert parse_records(item + odd + ">" + item if odd[-1] != "'" else item + odd, ("li", None), fields)[0]["href"] == "x", odd
    for odd in ("<![if foo]>", "<![foo[ y ]]>", "<![endif]-->", "<!x>", "<?x>", "&#xFFFFFFFF;"):
        assert len(parse_records(item + odd + item, ("li", None), fields)) == 2, odd  # what follows is read too

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from(["<", ">", "!", "[", "]", "-", "--", "/", "?", "&", "#", ";", "li", "a", "script", "CDATA[", "'", '"', "=", " ", "x", item])))
    def no_error(parts):
        parse_records("".join(parts), ("li", None), fields)
    no_error()
