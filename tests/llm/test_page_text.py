"""Main text of pages: the reader of lines, the alignment, and whole hosts."""

from __future__ import annotations

import random

import pytest

from churnspark.llm import page_text, queries
from churnspark.llm.markup import ARTICLE, FRAME, MAIN, OUTSIDE, page_lines
from churnspark.llm.page_text import common_lines

TABLE = "page_id bigint, url string, html string, text string, lines int, key string, host int, shared string"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []),
        ("plain  text\n\tonly", [("plain text only", OUTSIDE)]),
        ("<p>a<p>b<b>c</b>d<br>e<div>f</div>g", [("a", OUTSIDE), ("bcd e", OUTSIDE), ("f", OUTSIDE), ("g", OUTSIDE)]),
        ("x &amp;&nbsp;&lt;b&gt; &#233;&#x41; &unknown; &amp y", [("x & <b> éA &unknown; & y", OUTSIDE)]),
        ("<!DOCTYPE html><title>t</title><style>p{}</style><script>var t='</p>';</script>k", [("k", OUTSIDE)]),
        ("a<!-- <p>no --> b<!-->c<![CDATA[no]]><p unfinished", [("a bc", OUTSIDE)]),
        ("1 < 2 <3> </ x>y", [("1 < 2 <3> y", OUTSIDE)]),
        ("<nav>n<p>m</nav>o", [("n", FRAME), ("m", FRAME), ("o", OUTSIDE)]),
        ("<main>m<article>a</article>m2</main>z", [("m", MAIN), ("a", ARTICLE), ("m2", MAIN), ("z", OUTSIDE)]),
        ("<div role=main>m</div><div class='top ad-box'>x<p>y</div>z", [("m", MAIN), ("x", FRAME), ("y", FRAME), ("z", OUTSIDE)]),
        ("<header>h</header><article><header>own</header>t<footer>f</footer></article>",
         [("h", FRAME), ("own", ARTICLE), ("t", ARTICLE), ("f", FRAME)]),
        ("<article>t<section id=comments><p>c</section>u</article>", [("t", ARTICLE), ("c", FRAME), ("u", ARTICLE)]),
        ("<p class=ad>x<p>y<ul><li class=menu>1<li>2</ul>", [("x", FRAME), ("y", OUTSIDE), ("1", FRAME), ("2", OUTSIDE)]),
        ("<ul><li>1<ul><li>in</ul><li>2</ul><table><tr><td>a<td>b<tr><td>c</table>",
         [(t, OUTSIDE) for t in ("1", "in", "2", "a", "b", "c")]),
        ("<b>u<p>v</b>w</p></div></p>x", [("u", OUTSIDE), ("vw", OUTSIDE), ("x", OUTSIDE)]),
        ("<a title='x > y' data=\"<p>\">l</a><p hidden>no</p><i aria-hidden=true>no</i>m", [("l", OUTSIDE), ("m", OUTSIDE)]),
        ("k<script>never ends <p>x", [("k", OUTSIDE)]),
        ("<div class='with-sidebar'>s<article class='post ad-free'>t</article>u</div>v",
         [("s", FRAME), ("t", ARTICLE), ("u", FRAME), ("v", OUTSIDE)]),
        ("<div class=comments><article>c</article></div><article class=comment>d</article><main id=page>m</main>",
         [("c", FRAME), ("d", FRAME), ("m", MAIN)]),
        ("<div class=menu>a<div>b</div><nav>n<article>x</article></nav></div>c", [(t, FRAME) for t in "abnx"] + [("c", OUTSIDE)]),
        ("<a href='open>b<p>c", [("b", OUTSIDE), ("c", OUTSIDE)]),
    ],
)
def test_lines_and_regions(page, want):
    assert page_lines(page) == want


def test_long_and_broken_pages_take_no_time():
    assert len(page_lines("<p>word</p>" * 50_000)) == 50_000
    assert page_lines("<div>" * 3000 + "deep") == [("deep", OUTSIDE)]
    assert len(page_lines("<a b='" * 2000 + "x")) <= 1


def brute_length(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 6])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(page_text, "_MOST_BITS", bits)
    random_ = random.Random(bits)
    for _ in range(300):
        a, b = ([random_.randrange(5) for _ in range(random_.randrange(14))] for _ in range(2))
        pairs = common_lines(a, b)
        assert len(pairs) == brute_length(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def page(body, frame=("Home", "All rights kept")):
    """A page without any telling markup."""
    top, bottom = (f"<div>{t}</div>" for t in frame)
    return f"<html><body>{top}{''.join(f'<div>{line}</div>' for line in body)}{bottom}</body></html>"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", 1, "k", 2, "s") for i, u, h in rows], TABLE).repartition(3)


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def brute_text(rows):
    """The same rules on lists: neighbours in the order of host and path, common lines, longest line."""
    parsed = []
    for i, url, html in rows:
        host, path = page_text.place_of(url)
        parsed.append([i, url, host, path, page_lines(html or ""), set()])
    order = sorted((p for p in parsed if p[2]), key=lambda p: (p[2], p[3], p[1], p[0]))
    for one, two in zip(order, order[1:]):
        if one[2] != two[2]:
            continue
        a, b = ([line for line, _ in p[4]] for p in (one, two))
        pairs = common_lines(a, b)
        left, right = {i for i, _ in pairs}, {j for _, j in pairs}
        if pairs and a.index(max(a, key=len)) not in left and b.index(max(b, key=len)) not in right:
            one[5] |= left
            two[5] |= right
    found = {}
    for i, _, _, _, lines, shared in parsed:
        said = page_text.verdicts([region for _, region in lines])
        kept = [line for k, (line, _) in enumerate(lines) if said[k] > 0 or (said[k] == 0 and k not in shared)]
        found[i] = "\n".join(kept)
    return found


def corpus():
    rows = []
    for i in range(90):
        own = [f"Paragraph {k} of page {i} with words {i * 7 + k} of its own" for k in range(1 + i % 5)]
        rows.append((i, f"https://Hot.example/{'abc'[i % 3]}/{i:03d}?x={i}", page(own)))
    rows += [(100 + i, f"http://other.example/p/{i}", page([f"other text number {i}"], ("Start", "Imprint"))) for i in range(4)]
    rows.append((200, "http://single.example/only", page(["alone"])))
    # Copies of one article next to each other say nothing of the frame.
    rows += [(300 + i, f"http://copy.example/{i}", page(["The same long article, twice"])) for i in range(2)]
    rows.append((400, None, page(["no address"])))
    rows.append((401, "http://[broken/", page(["broken address"])))
    rows.append((402, "http://hot.example/zz", None))
    rows.append((403, "http://hot.example/zzz", ""))
    rows.append((404, "http://hot.example/a/long", page([f"line {k} of the long one" for k in range(3000)])))
    marked = "<nav>Menu</nav><article><h1>T</h1><p>Shared</p><p>{}</p></article><div class=ad>Buy</div>"
    rows += [(500 + i, f"http://marked.example/{i}", marked.format(f"Own text of page {i}, longer")) for i in range(3)]
    return rows


@pytest.mark.parametrize("group_pages", [64, 2, 1])
def test_pages_match_brute_force(spark, group_pages):
    rows = corpus()
    found = page_text.main_text(pages(spark, rows), group_pages=group_pages)
    got = texts(found)
    assert got == brute_text(rows)
    assert got[7] == "\n".join(f"Paragraph {k} of page 7 with words {49 + k} of its own" for k in range(3))
    assert got[300] == "Home\nThe same long article, twice\nAll rights kept"
    assert got[200].split("\n")[1] == "alone" and got[402] == got[403] == ""
    assert got[501] == "T\nShared\nOwn text of page 1, longer"
    counted = {r["page_id"]: (r["n_lines"], r["n_shared"], r["n_deleted"]) for r in found.collect()}
    assert counted[7] == (5, 2, 2) and counted[501] == (5, 4, 2) and counted[402] == (0, 0, 0)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    row = (None, "http://a.example/1", page(["text"]))
    got = page_text.main_text(pages(spark, [row, row, (5, "http://a.example/1", page(["another text"]))]))
    assert sorted((str(r["page_id"]), r["url"]) for r in got.collect()) == [
        ("5", row[1]), ("None", row[1]), ("None", row[1])
    ]
    empty = page_text.main_text(pages(spark, []))
    assert empty.count() == 0 and empty.columns == ["page_id", "url", "text", "n_lines", "n_shared", "n_deleted"]


def test_query_over_the_table(spark):
    got = queries.op11_page_text(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 50
    source = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in got:
        own = source[r["page_id"]].split("<article>")[1].split("</article>")[0]
        assert r["text"].split("\n") == [line for line, _ in page_lines(own)] and r["n_chars"] == len(r["text"])
