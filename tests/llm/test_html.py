"""The page walker on odd mark-up, Viterbi against all label sequences, held-out layouts."""

import itertools
import time

import pytest
from conftest import SF_SMALL

from ranklift.llm import html_crf as H

CASES = [
    ("<p data-x=it's>one</p><article><p>two it's</p></article>", ["one", "two it's"]),
    ("<svg viewBox='0' /><article><p>text</p></article><svg><text>no</text></svg>end", ["text", "end"]),
    ("<button>menu<article><p>text</p></article><button>x</button>tail", ["text", "tail"]),
    ("<button><div>no</div></button>yes", ["yes"]),
    ("İ<SCRIPT>bad</SCRIPT><p>good</p>", ["İ", "good"]),
    ("<script>var a = '<p>no</p>';</script >yes<style>p{}", ["yes"]),
    ("<noscript>no<p>no</p></noscript><p>x", ["x"]),
    ("<template><p>no</p></template>yes", ["yes"]),
    ('<a b="x><p>y</p>', ["y"]),
    ("a < b and c > d <3 &lt;p&gt; &amp;amp;", ["a < b and c > d <3 <p> &amp;"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<p>a<p>b<table><tr><td><p>c<td>d</table>", ["a", "b", "c", "d"]),
    ("<!-- <p>x</p> --><!DOCTYPE a>q</ p>r<?php x ?>", ["qr"]),
    ("<b>x<p>y</b>z</p>w", ["x", "yz", "w"]),
    ("one<br>two \n\t three", ["one two three"]),
    ("<title>no</title><textarea>no <p></textarea>yes", ["yes"]),
    ("<a href=/>l</a><p\n>t</p\n>u", ["l", "t", "u"]),
    ("", []), ("   <p> </p>", []), ("</p></div>x", ["x"]),
]


@pytest.mark.parametrize(("page", "want"), CASES)
def test_leaf_blocks(page, want):
    assert [b.text for b in H.leaf_blocks(page)] == want


def test_links_and_ancestors_are_counted():
    a, b = H.leaf_blocks("<nav class='Menu x'><a>one</a> two</nav><div id=foo hidden><zz><p>t</p></zz></div>")
    assert a.linked == 3 and a.names == {"menu"} and a.ancestors == {"nav"} and a.tag == "nav"
    assert b.names == {"hidden"} and b.ancestors == {"div", "other", "p"} and b.tag == "p" and b.linked == 0


@pytest.mark.parametrize("part", ["<div>", "<p>x", "<li>x", "<b>", "</i>", "<noscript>", "<script>a</script>", '<a b="x ', "<a ", "<", "<!--", "a='", "<x1><y>", "<iframe>", "<svg>", "&amp", "<td>"])
def test_time_is_linear(part):
    def seconds(n):
        t = time.perf_counter()
        H.leaf_blocks("İ" + part * n)
        return time.perf_counter() - t

    seconds(100)
    once = min(seconds(10_000) for _ in range(2))
    assert seconds(40_000) < 10 * once + 0.5


def test_viterbi_against_all_label_sequences():
    model = H.Model({"links=0": (0.1, 0.7), "links=10": (1.5, -0.2), "stops=1": (-0.4, 0.3), "tag=p": (0.2, 0.1), "up=nav": (0.9, -0.9), "talk": (0.5, 0.0)}, ((0.8, -0.6), (-0.3, 0.4)))
    blocks = H.leaf_blocks("<nav><a>m</a></nav><p>One. <p>two<h3>Comments</h3><p><a>x</a><p>Three.<nav>t</nav>")
    scores = [[sum(model.weights.get(f, (0, 0))[k] for f in fs) for k in (0, 1)] for fs in H.features(blocks)]

    def total(path):
        return sum(s[y] for s, y in zip(scores, path)) + sum(model.transitions[a][b] for a, b in itertools.pairwise(path))

    best = max(itertools.product((0, 1), repeat=len(blocks)), key=total)
    assert model.decode(blocks) == [bool(y) for y in best]


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").orderBy("page_id").collect() if r.html]


@pytest.fixture(scope="module")
def model(pages):
    sample = pages[: len(pages) // 2]
    labelled = [(b, [H.marked_main(x) for x in b]) for b in map(H.leaf_blocks, sample)]
    return H.train(labelled + [(H.leaf_blocks(p), y) for p, y in H.made_pages(sample, 400)])


def test_held_out_layouts(pages, model, monkeypatch):
    """Pages of other texts and layouts: nearly all blocks with mark-up, most by their text alone."""
    held = [(H.leaf_blocks(p), y) for p, y in H.made_pages(pages[len(pages) // 2 :], 200, seed=5)]
    blocks = sum(len(y) for _, y in held)
    wrong = lambda: sum(x != y for b, ys in held for x, y in zip(model.decode(b), ys))
    assert wrong() <= 0.03 * blocks
    features = H.features
    monkeypatch.setattr(H, "features", lambda b, marks=True: features(b, False))
    always = min(sum(sum(y) for _, y in held), blocks - sum(sum(y) for _, y in held))
    assert wrong() < 0.8 * always


def test_pages_that_mark_up_does_not_explain(model):
    story = "<p>The quick brown fox went over the hill and came back again in the evening. It was late.</p><p>Then it slept for a long time, until the morning came and the sun rose.</p>"
    text = story.replace("</p><p>", "\n").replace("<p>", "").replace("</p>", "")
    foot = "<p>Copyright 2020 Corp. All rights reserved.</p>"
    assert H.main_text(f"<html><body><div>{story}</div>{foot}</body></html>", model) == text
    talk = "<div class='discussion'><h3>Comments</h3><p>Nice text, thanks a lot for it all.</p></div>"
    assert H.main_text(f"<main>{story}{talk}</main>", model) == text
    assert H.main_text(None, model) == "" and H.main_text("<p> </p>", model) == ""


def test_extract_on_odd_rows(spark, model, pages):
    long = "<article>" + "<p>A sentence of the story, as long as others. " * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", pages[0]), (3, "u", pages[0]), (None, "u", pages[1]), (4, "u", long)]
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows], "page_id long, url string, html string, text string, n_chars int").repartition(3)
    got = sorted(((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in H.extract(df, model).collect()))
    want = sorted(((i or 0, u or "", t := H.main_text(h, model), len(t)) for i, u, h in rows))
    assert got == want and [x[3] for x in got if x[0] == 4][0] > 500_000
    assert H.extract(df.where("false"), model).count() == 0
    none = H.fit(df.where("false"))
    assert H.main_text(pages[0], none) != ""
