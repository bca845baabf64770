"""Main text of pages against plain extraction, and the minimum cut against all cuts."""

import itertools
import random
import re
import time
from html import unescape

import numpy as np
import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry
from tillstar.llm import pages

PROSE = (
    "The council met on Tuesday to discuss the new bridge, which has been planned for years. "
    "Several residents spoke. They asked for more time."
)


def text_of(html, weights=pages.DEFAULT):
    return "\n".join(b.text for b in pages.content(html, weights))


def plain(html):
    """The article of a sample page, whose tags are few, by cutting at them."""
    article = html[html.find("<article>") : html.find("</article>")]
    made = []
    for part in re.split(r"</?(?:p|h1|article)>", article):
        part = " ".join(unescape(re.sub(r"</?b>", "", part).replace("<br>", " ")).split())
        if part:
            made.append(part)
    return "\n".join(made)


def test_query_matches_plain_extraction(spark, sf_dir):
    made = entry.queries()["op13_main_text"](spark, sf_dir).collect()
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in made) == sorted(
        (r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in rows
    )


@pytest.mark.parametrize("seed", range(40))
def test_cut_is_the_cheapest(seed):
    draw = random.Random(seed)
    count = draw.randrange(1, 9)
    odds = [draw.choice([-3, -1, -0.5, 0, 0.5, 1, 3]) for _ in range(count)]
    edges = [
        (a, b, draw.choice([0.25, 0.5, 2]))
        for a, b in itertools.combinations(range(count), 2)
        if draw.random() < 0.5
    ]

    def cost(side):
        own = sum(abs(x) for x, s in zip(odds, side, strict=True) if (x > 0) != s and x)
        return own + sum(w for a, b, w in edges if side[a] != side[b])

    cuts = list(itertools.product([False, True], repeat=count))
    best = min(map(cost, cuts))
    found = pages.kept_side(np.array(odds), edges)
    assert cost(found) == best
    # ties go with the boilerplate
    assert sum(found) == min(sum(c) for c in cuts if cost(c) == best)


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), (" \n\t", ""), ("only words", "only words"),
        ("a < b &amp; c &lt;d&gt; &eacute;&#233;&nbsp;&amp", "a < b & c <d> éé &"),
        (f"<p>{PROSE}<p>Yes.<p>{PROSE}", f"{PROSE}\nYes.\n{PROSE}"),
        (f"<article>a<b>b</b>c<br>d <i>e</i>\n\n f<p>{PROSE}</article>", f"abc d e f\n{PROSE}"),
        (f"<header>Site</header><main>{PROSE}</main><footer>{PROSE}</footer>", PROSE),
        (f"<article><header><h1>T</h1></header><p>{PROSE}</article>", f"T\n{PROSE}"),
        (f"<article><p>{PROSE}<div class='ad-box'>{PROSE}</div></article>", PROSE),
        (f"<article><p>{PROSE}<aside>{PROSE}</aside><form>{PROSE}</form></article>", PROSE),
        (f"<article>{PROSE}<ul id=comments><li><article>{PROSE}</article></ul></article>", PROSE),
        (f"<div class=cookieNotice>{PROSE}</div><div>{PROSE}</div>", PROSE),
        (f"<div class=with-sidebar><p>{PROSE}<p>{PROSE}</div>", f"{PROSE}\n{PROSE}"),
        (f"<div><a href=x>Home</a> <a href=y>News</a></div><div><p>{PROSE}</div>", PROSE),
        (f"<div>{PROSE}</div><div>© 2020 All rights reserved</div>", PROSE),
        (f"<script>var t = '</p>{PROSE}'</script><p title='a > b'>{PROSE}<!-- {PROSE} -->", PROSE),
        (f"<article><p>{PROSE}<SCRIPT>x</SCRIPT ><STYLE>y</STYLE></article>", PROSE),
        (f"<article><table><tr><td>one<td>two<tr><td>{PROSE}</table>", f"one\ntwo\n{PROSE}"),
        (f"<nav>Menu<article>{PROSE}</article></nav><article>{PROSE}", PROSE),
        (f"<article><p>Of.</p><p>{PROSE}</p></article><p><a href=x>More</a></p>", f"Of.\n{PROSE}"),
    ],
)
def test_small_pages(html, text):
    assert text_of(html) == text


def test_any_page_takes_time_in_proportion():
    shapes = [
        "<a ", "<div>", "<div>x", "<svg>", '<a x">"', "<!--", "<", "&", "<li>", "</b>", "<a b='",
        "<p><a href=a>one two</a> three", f"<p>{PROSE}<p><a href=x>link</a>", "<table><tr><td>x",
    ]
    for shape in shapes:
        began = time.time()
        pages.content(shape * (400_000 // len(shape)))
        assert time.time() - began < 10, shape
    whole = f"<article><p>{PROSE}</p></article><footer>x</footer>"
    long = whole.replace("</p>", f"</p><p>{PROSE}</p>" * 40_000)
    assert len(long) > 5_000_000 and text_of(long).count("\n") == 40_000


def test_odd_tables(spark):
    kind = T.StructType([
        T.StructField(n, T.StringType()) for n in ("page_id", "html", "text", "hash", "labels")
    ])
    rows = [
        (None, None, "t", "h", "l"), ("1", "", "t", "h", "l"), ("1", "", "t", "h", "l"),
        ("2", f"<nav>{PROSE}</nav><main>{PROSE}</main>", None, None, None),
        ("2", f"<nav>{PROSE}</nav><main>{PROSE}</main>", None, None, None),
        ("3", "<p>\x00퟿\U0001f389 x", "t", "h", "l"),
    ]
    df = spark.createDataFrame(rows, kind)
    made = pages.main_text(df)
    assert made.columns == ["page_id", "html", "hash", "labels", "text", "n_chars"]
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in made.collect()) == sorted([
        ("None", "", 0), ("1", "", 0), ("1", "", 0), ("2", PROSE, len(PROSE)),
        ("2", PROSE, len(PROSE)), ("3", "\x00퟿\U0001f389 x", 5),
    ])
    assert pages.main_text(df.limit(0)).count() == 0
    assert pages.fit(df.limit(0)) == pages.DEFAULT


def test_weights_are_learned_from_marked_blocks(spark):
    page = (
        f"<nav><ul>{'<li><a href=x>some words</a>' * 5}</ul></nav><article><p>{PROSE}<p>{PROSE}"
        "</article><footer>© 2020 Someone</footer>"
    )
    df = spark.createDataFrame([(f"{page}<!-- {i} -->",) for i in range(20)], "html string")
    weights = pages.fit(df)
    assert weights == pages.fit(df.repartition(3)) != pages.DEFAULT
    bare = f"<div><a href=x>some words</a></div><div>{PROSE}</div><div>© 2020 Someone</div>"
    assert text_of(bare, weights) == PROSE
