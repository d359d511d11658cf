"""Main text of pages: markup by cases, repetition against a plain version, odd pages."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from plotstats.llm import boilerplate, markup
from plotstats.llm.text import hash_words

PAGES = "page_id long, url string, html string, host string, key string, text string, n long, common string, id string"


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(i, u, h, "x", "x", "x", 1, "x", "x") for i, u, h in rows], PAGES)


def texts(frame):
    return {r["page_id"]: r["text"] for r in frame.collect()}


CASES = [
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One <b>two</b>three<br>four</p></article><footer>&copy; x</footer>", "A & B\nOne twothree four"),
    ("<article><header><h1>Head</h1></header><p>x<script>var t='</p>';</script>y</p><aside>side</aside><form>f<input></form><footer>foot</footer></article><p>after</p>", "Head\nxy"),
    ("<body><div class='site-header menu'>M</div><main><p>Text &lt;b&gt; &#8364;&nbsp;1</p><div id=comments><article class=comment>C</article></div></main><div class='sidebar'>S<div>T</div></div>", "Text <b> € 1"),
    ("<div class='has-sidebar'><article><p>kept</p></article><div class=ad>Buy</div></div>", "kept"),
    ("<article><p>a<p class=notice>gone<p>b<ul><li>c<li class=ad>gone<li>d</ul></article>", "a\nb\nc\nd"),
    ("<article><p>a</p><div hidden>x</div><div style='display:none'>y</div><span aria-hidden=true>z</span>b</article>", "a\nb"),
    ("<p>no article</p><ul><li><a href=1>Link</a></li></ul><p>1 < 2 & 3</p><!-- c --><p>end", "no article\n1 < 2 & 3\nend"),
    ("<div itemprop='articleBody'><p>body</p></div><p>other</p>", "body"),
    ("<article><p>open <a href='x>y'>link</a> <a title=\"a > b\">t</a></p><table><tr><td>1<td>2</table></article>", "open link t\n1\n2"),
    ("<article><p>cut off &am", "cut off &am"),
    ("<article><p>script at the end</p><script>never closed", "script at the end"),
    ("plain text\n\n  with   space", "plain text with space"),
    ("</p></div>stray<b>x", "strayx"),
    ("<!-- never closed <p>x</p>", ""),
    ("", ""),
]


@pytest.mark.parametrize("page,want", CASES)
def test_markup(page, want):
    assert "\n".join(markup.article(page)[0]) == want


def test_markup_is_linear():
    for page in ("<a" * 200_000, '<a "' * 100_000, "<!" * 200_000, "<div>" * 50_000 + "x", "</div>" * 100_000, "<script>" * 50_000, "&" * 200_000):
        start = time.time()
        markup.article(page)
        assert time.time() - start < 5


def plain(rows):
    """What the operator says it does, page by page with sets of words."""
    parsed = {i: (url.split("/")[2], *markup.article(h)) for i, url, h in rows}
    cuts = {}
    for i, (_, blocks, _) in parsed.items():
        cuts[i], at = [], 0
        for words in (b.split() for b in blocks):
            codes = [int(hash_words(w.encode() + b" ")[0][0]) for w in words] + [0]
            pairs = [int(boilerplate.mix(np.array([(x + y * int(boilerplate._STEP)) % 2**64], np.uint64))[0]) for x, y in zip(codes, codes[1:], strict=False)]
            reach = boilerplate.REACH
            chosen = [j for j in range(len(words)) if j == 0 or pairs[j] == min(pairs[max(0, j - reach) : j + reach + 1])]
            cuts[i] += [(at + a, at + z, tuple(w.lower() for w in words[a:z])) for a, z in zip(chosen, [*chosen[1:], len(words)], strict=True)]
            at += len(words)
    seen, whole = defaultdict(set), defaultdict(set)
    for i, (host, blocks, _) in parsed.items():
        whole[host].add(i)
        for *_, piece in cuts[i]:
            seen[host, piece].add(i)
    # classes of content: here every page that differs is its own
    content = {i: int(boilerplate.mix(np.unique(boilerplate.cut(p[1])[2])).sum(dtype=np.uint64)) % 64 for i, p in parsed.items()}
    out = {}
    for i, (host, blocks, named) in parsed.items():
        words = [w for b in blocks for w in b.split()]
        pages_, contents = len(whole[host]), len({content[j] for j in whole[host]})

        def common(piece, share, least, host=host, pages_=pages_, contents=contents):
            on = seen[host, piece]
            return len(on) >= max(least, share * pages_) and len({content[j] for j in on}) >= max(least, share * contents)

        rules = [(lambda p: common(p, 0.5, 5) and 2 * len(seen[host, p]) > pages_, 0.5 if named else 0.9)]
        if not named:
            rules.insert(0, (lambda p: common(p, 0.3, 2), 0.9))
        gone = set()
        for rule, most in rules:
            gone, run = set(), []
            for a, z, piece in [*cuts[i], (None, None, None)]:
                if piece is not None and rule(piece):
                    run += range(a, z)
                else:
                    if len(run) >= boilerplate.LEAST_WORDS:
                        gone |= set(run)
                    run = []
            if gone and len(gone) < most * len(words):
                break
            gone = set()
        lines, at = [], 0
        for b in blocks:
            left = [w for j, w in enumerate(b.split(), at) if j not in gone]
            at += len(b.split())
            if left:
                lines.append(" ".join(left))
        out[i] = "\n".join(lines)
    return out


def site(prose, n, host, named, seed=0):
    draw = random.Random(seed)
    menu, notice, foot = (" ".join(prose(900 + seed + j, 14)) for j in range(3))
    passage = " ".join(prose(950 + seed, 60))
    rows, want = [], {}
    for i in range(n):
        body = [" ".join(prose(1000 * seed + 10 * i + j, draw.randint(9, 70))) for j in range(4)]
        if i in (2, 5):
            body[2] += " " + passage
        inner = f"<p>{body[0]}</p><p>{notice}</p>" + "".join(f"<p>{b}</p>" for b in body[1:])
        page = f"<body><div>{menu}</div>" + (f"<article>{inner}</article>" if named else f"<div>{inner}</div>") + f"<div><p>{foot}</p></div></body>"
        rows.append((1000 * seed + i, f"http://{host}/p/{i}", page))
        want[1000 * seed + i] = "\n".join(body)
    return rows, want


@pytest.mark.parametrize("named", [True, False])
def test_repeated_blocks_go(pages, prose, named):
    rows, want = site(prose, 30, "Site.example", named, seed=1)
    found = texts(boilerplate.main_text(pages(rows), "page_id", "url", "html"))
    assert found == plain(rows)
    assert found == want


def test_copies_and_shared_passages_stay(pages, prose):
    rows, want = site(prose, 12, "a.example", True, seed=2)
    copies = [(5000 + i, f"http://a.example/c/{i}", rows[0][2]) for i in range(40)]
    near = [(6000 + i, f"http://a.example/n/{i}", rows[1][2].replace("</article>", f"<p>edition {i} of all</p></article>")) for i in range(40)]
    found = texts(boilerplate.main_text(pages(rows + copies + near), "page_id", "url", "html"))
    assert found == plain(rows + copies + near)
    notice = " ".join(prose(903, 14))
    assert all(found[i] in (want[2000], want[2000].replace("\n", f"\n{notice}\n", 1)) for i, *_ in copies)
    for i, *_ in near:
        assert set(want[2001].split("\n")) <= set(found[i].split("\n"))


def test_partly_repeated_block_keeps_its_own_words(pages, prose):
    line = " ".join(prose(77, 60))
    rows = [(i, f"http://h.example/{i}", f"<article><p>{' '.join(prose(100 + i, 80))}</p><p>{' '.join(prose(200 + i, 30))} {line}</p></article>") for i in range(20)]
    found = texts(boilerplate.main_text(pages(rows), "page_id", "url", "html"))
    assert found == plain(rows)
    for i, text in found.items():
        first, second = text.split("\n")
        assert first == " ".join(prose(100 + i, 80)) and second.startswith(" ".join(prose(200 + i, 30)))
        # what is left of the repeated line is at most what lies before the first chosen position
        assert len(second.split()) - 30 < 25


def test_hosts_are_apart_and_joined_in_any_way(monkeypatch, pages, prose):
    monkeypatch.setattr(boilerplate, "BROADCAST_BYTES", 0)
    one, want_one = site(prose, 9, "one.example", False, seed=3)
    two, want_two = site(prose, 9, "two.example", True, seed=4)
    lone = [(9000, "http://three.example/", one[0][2])]
    found = texts(boilerplate.main_text(pages(one + two + lone), "page_id", "url", "html"))
    assert found == plain(one + two + lone)
    assert {i: found[i] for i in want_one} == want_one and {i: found[i] for i in want_two} == want_two
    assert len(found[9000]) > len(want_one[3000])


def test_odd_pages(spark, pages, prose):
    long = " ".join(prose(5, 300_000))
    rows = [
        (1, "http://h.example/1", None), (2, "http://h.example/2", ""), (3, None, "<p>x</p>"), (4, "nowhere", "<p>y</p>"), (None, "http://h.example/4", "<p>z</p>"),
        (5, "http://h.example/5", f"<article><p>{long}</p></article>"), (6, "http://h.example/6", "<a" * 5000), (7, "http:///", "\x00<p>�"), (3, None, "<p>x</p>"),
    ]
    frame = boilerplate.main_text(pages(rows), "page_id", "url", "html")
    assert frame.columns == ["page_id", "url", "text", "n_chars"]
    found = Counter((r["page_id"], r["text"], r["n_chars"]) for r in frame.collect())
    want = [(1, "", 0), (2, "", 0), (3, "x", 1), (3, "x", 1), (4, "y", 1), (None, "z", 1), (5, long, len(long)), (6, "<a" * 5000, 10000)]
    assert found - Counter({(7, "\x00 \ufffd", 3): 1, (7, "\x00\n\ufffd", 3): 1}) == Counter(want)
    assert boilerplate.main_text(pages([]), "page_id", "url", "html").count() == 0
