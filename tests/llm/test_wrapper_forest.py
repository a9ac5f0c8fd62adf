"""Wrappers and the prefix forest on hard pages and tiny tables."""

import random

import numpy as np
import pytest

from tessera.llm import forest, wrapper


@pytest.fixture()
def texts(spark):
    def run(rows):
        df = spark.createDataFrame([(i, u, h, 1, "x") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, host int, regions string")
        return {r["page_id"]: r["text"] for r in wrapper.main_text(df).collect()}
    return run


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        a, b = rng.sample(range(30), rng.randrange(20)), rng.sample(range(30), rng.randrange(20))
        pairs = wrapper.common([str(x) for x in a], [str(x) for x in b])
        assert len(pairs) == longest(a, b)
    for _ in range(300):
        a, b = [[rng.choice("abc") for _ in range(rng.randrange(12))] for _ in "xy"]
        pairs = wrapper.common(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert not set(a) & set(b) or pairs


def test_wrapper_survives_writing_and_reading():
    root = wrapper.skeleton(wrapper.parse("<body><ul><li>a<li>b</ul><div class=x>c<p>d</div>e</body>"))
    assert wrapper.dump(wrapper.load(wrapper.dump(root))) == wrapper.dump(root)


def test_names_cut_whole_words_only(texts):
    page = "<body>{}<article><h1>T</h1><p>one</p>{}</article></body>"
    inside = [("<div class='a b c d e f sidebar'>x</div>", ""), ("<h2 id='related-work'>Related</h2>", "\nRelated"), ("<p class='notice-1'>n</p>", "\nn"),
              ("<div class='cookie-bar'>x</div>", ""), ("<section class=comments><article class=comment>c</article></section>", "")]
    rows = [(f"http://h{i}.org/", page.format("", extra)) for i, (extra, _) in enumerate(inside)]
    rows += [("http://l.org/", "<body><div id=page class='layout no-sidebar'><article><p>whole</p></article></div></body>"),
             ("http://s.org/", "<body><div class='content sidebar'><article><h1>all</h1></article></div><div class=ad>buy</div></body>")]
    got = texts(rows)
    assert [got[i] for i in range(len(inside))] == ["T\none" + more for _, more in inside]
    assert got[len(inside)] == "whole" and got[len(inside) + 1] == "all"


def test_wrapper_finds_the_region_of_plain_elements(texts):
    page = ("<body><div><a href=/>Home</a> <a href=/x>More</a></div><div><p>Fixed words of this host, the same on every page of it, "
            "and there are very many of them so that no page has more.</p></div><div><h1>Title {0}</h1><div><p>Text {0} of a page.</p><p>And {0}.</p></div></div></body>")
    got = texts([("http://plain.org/", page.format(w)) for w in ("one", "two", "three")])
    assert got[1] == "Title two\nText two of a page.\nAnd two."


def test_a_host_of_copies_and_other_layouts(texts):
    same = "<body><nav>menu</nav><article><p>same text</p></article><footer>f</footer></body>"
    got = texts([("http://c.org/", same)] * 5 + [("http://c.org/", "<body><main><p>other layout</p></main></body>")])
    assert got[0] == "same text" and got[5] == "other layout"


def test_deep_and_wide_pages(texts):
    deep = "<body><article>" + "<div>" * 100_000 + "bottom" + "</div>" * 100_000 + "</article></body>"
    rng = random.Random(1)
    wide = ["<body><article>" + "".join(f"<{t}>w</{t}>" for t in rng.choices(["p", "h2", "div", "ul", "pre", "ol"], k=20_000)) + "</article></body>" for _ in range(2)]
    got = texts([("http://d.org/", deep), ("http://w.org/", wide[0]), ("http://w.org/", wide[1])])
    assert got[0] == "bottom" and got[1] == got[2] == "\n".join(["w"] * 20_000)


def test_no_pages(spark):
    assert wrapper.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("n", [2, 6, 12, 16, 20])
def test_small_tables_give_all_or_the_nearest(spark, n):
    x = np.random.default_rng(n).standard_normal((n, 8))
    v = spark.createDataFrame([(i, r.tolist(), "a", 1) for i, r in enumerate(x)], "vec_id long, embedding array<double>, dim string, shard int")
    got = forest.nearest(v, v).collect()
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in range(n):
        mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [r for r, _ in mine] == list(range(1, min(5, n - 1) + 1)) and q not in {i for _, i in mine}
        s = u @ u[q]
        s[q] = -9
        hits += len({i for _, i in mine} & set(np.argsort(-s)[:min(5, n - 1)].tolist()))
    assert hits >= 0.9 * n * min(5, n - 1)


def test_repeated_rows_and_ids_count_once(spark):
    rows = [(1, [1.0, 0.0])] * 40 + [(2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [-1.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in forest.nearest(v, v.where("vec_id IN (1, 4)")).collect()}
    assert got == {(1, 1): 2, (1, 2): 3, (1, 3): 4, (4, 1): 3, (4, 2): 2, (4, 3): 1}
    assert forest.nearest(v.limit(0), v.limit(0)).count() == 0
