"""Extraction from pages of known text, and repeated runs against plain windows."""

from __future__ import annotations

import html as entities
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from plumbline.llm import html

MENU = "Home page of the great site with news and more for everyone today"


@pytest.mark.parametrize(("page", "text"), [
    ("<article><h1>Title</h1><p><b>One&amp;two<br>three<p> four \n five</article><footer>no</footer>", "Title\nOne&two three\nfour five"),
    ("<nav>menu</nav><main><header>h</header><p>a<aside>b</aside>c</main>", "a\nc"),
    ("<article>x<div class='user-comments'><p>no</div>y<form>n</form><script>if (a<b) '</p>'</script>z</article>", "x\ny\nz"),
    ("<article><p title='a>b'>in</p><!-- c --><style>p{}</style>&lt;&#233;&#x41;&bogus;&copy</article>", "in\n<éA&bogus;©"),
    ("<head><title>t</title></head><body class='has-sidebar'><p>kept</p><p class=ad>gone</p><p>kept too</body>", "kept\nkept too"),
    ("<article><div role='navigation'>n</div>one</div></zz>two</article>", "one\ntwo"),
    ("<article>a < b & c > d <", "a < b & c > d <"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1 2\n3"),
    ("<p>open <b>bold", "open bold"), ("", ""), ("   ", ""), ("<", "<"), ("<!-- never closed <p>x", ""), ("<script>never closed", ""),
    ("<article>" + "<b>" * 3000 + "deep", "deep"),
    ("<div class='layout has-sidebar'><article>kept</article></div>", "kept"),
    ("<div id='page-with-header'><main>kept</main></div>", "kept"),
    ("<div class='sidebar layout'><article>kept</article><p>no</div>", "kept"),
    ("<form><div><article>kept</article></div><p>no</form>", "kept"),
    ("<article>kept</article><div class='comments'><article>no</article></div>", "kept"),
    ("<p>kept<aside><article>no</article></aside>", "kept"),
    ("<article><div class='article-header'><h1>Title</h1></div><section class='social-science'>two</section></article>", "Title\ntwo"),
    ("<article><ul><li class='comment'><p>no</p>no<li>one<li>two</ul></article>", "one\ntwo"),
    ("<article><ul><li class='comment'><ul><li>no</li>no</ul>no</li><li>one</ul></article>", "one"),
    ("<article><dl><dd class='ad'><div>no</div>no<dt>one<dd>two</dl></article>", "one\ntwo"),
    ("<article><p class='ad'>no<div>one</div></article>", "one"),
    ("<article><header><h1>T</h1></header><p>one</article><header>no</header>", "T\none"),
    ("<article>one<!-- c --!><p>two</article>", "one\ntwo"),
    ("<article>one<div hidden>no</div><p aria-hidden='true'>no<p>two <span style='color:red; display:none'>no</span>three</article>", "one\ntwo three"),
    ("<article><div class='newsletter-box'>no</div><p id=cookie-notice-bar>no<p class='hidden-history'>one</article>", "one"),
    ("<div hidden><article>no</article></div><p>one", "one"),
])
def test_pages(spark, page, text):
    article, rest, marked = html.parsed(page)
    assert (article if article is not None else "\n".join(t for t, m in zip(rest, marked, strict=True) if not m)) == text


def test_repeated_runs_of_a_host_go(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    page = lambda i: f"<body><div>{MENU}</div><div>{entities.escape(own(i))}</div><p>Short</p></body>"
    rows = [(i, f"http://H{i % 2}.example.com/{i}", page(i), "x") for i in range(6)]
    rows += [(6, "http://h0.example.com/copy", page(0), "x"), (7, "http://alone.example.com/", page(7), "x"), (8, None, None, None)]
    rows += [(9, "http://h0.example.com/a", f"<article>{MENU}</article>", "x"), (None, "http://h1.example.com/a", f"<article>{MENU}</article>", "x")]
    rows += [rows[0]]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(frame).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    for i in range(6):
        assert text[i] == own(i) + "\nShort"
    assert text[6] == text[0]
    assert text[7] == f"{MENU}\n{own(7)}\nShort"  # no other page of that host
    assert text[8] == "" and text[9] == text[None] == MENU  # an article keeps what others repeat
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == dict((x[0], x[1]) for x in rows)[r["page_id"]] for r in got)
    assert html.extract(frame.limit(0)).count() == 0


def test_short_blocks_beside_a_marked_one_go(spark):
    page = "<body><div>short notice of five words</div><nav>menu {0}</nav><div>and a short footer</div><p>own text {0}</body>"
    rows = [(i, f"http://h.example.com/{i}", page.format(i)) for i in range(3)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"], r["text"]) for r in got) == [(i, f"own text {i}") for i in range(3)]


@pytest.mark.parametrize(("size", "sent"), [(html.SLICE_BYTES, html.SENT_RUNS), (200, 0)])
def test_repeated_runs_of_articles_go(spark, monkeypatch, size, sent):
    monkeypatch.setattr(html, "SLICE_BYTES", size)
    monkeypatch.setattr(html, "SLICE_PAGES", 4)
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    notice = "Please share this text with all of your friends today"
    page = lambda i, text: f"<nav>m</nav><article><h1>{own(i)[:60]}</h1><div>{notice}</div><p>{text}</p></article>"
    rows = [(i, f"http://h.example.com/{i}", page(i, own(i))) for i in range(9)]
    rows += [(20, "http://h.example.com/copy", page(0, own(0))), (21, "http://alone.example.com/", page(5, own(5)))]
    rows += [(22, "http://h.example.com/", f"<div>{own(1)}</div>")]  # an index page that repeats an article
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r["page_id"]: r["text"] for r in html.extract(frame, sent_runs=sent).collect()}
    assert [text[i] for i in range(9)] == [f"{own(i)[:60]}\n{own(i)}" for i in range(9)] and text[20] == text[0]
    assert text[21] == f"{own(5)[:60]}\n{notice}\n{own(5)}"  # no other page of that host
    assert text[22] == own(1)


@pytest.mark.parametrize("shell", ["<article>{}</article>", "<body>{}</body>"])
def test_copies_and_quotes_stay(spark, shell):
    own = lambda i, n=40: " ".join(f"w{i}x{k}" for k in range(n))
    quoted = own("q")
    near = [f"<p>{own('n')}</p><p>{own('n')} printed {k}</p>" for k in range(3)]
    rows = [(i, "http://two.example.com/", shell.format(f"<p>{own(i)}</p><p>{quoted}</p>")) for i in range(2)]
    rows += [(10 + k, "http://pair.example.com/", shell.format(near[k])) for k in range(2)]
    rows += [(20 + k, "http://three.example.com/", shell.format(near[k])) for k in range(3)]
    rows += [(30 + k, "http://many.example.com/", shell.format(f"<p>{own(k)}</p>" + (f"<p>{quoted}</p>" if k < 4 else ""))) for k in range(10)]
    text = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, page in rows:
        assert text[i] == page.split(">", 1)[1].rsplit("<", 1)[0].removeprefix("<p>").removesuffix("</p>").replace("</p><p>", "\n")


def plain_extract(rows):
    """{id: text} with boilerplate found by comparing all runs of all lengths of all pages of a host."""
    parsed = {i: (url.split("/")[2], *html.parsed(page)) for i, url, page in rows}
    out = {}
    streams = {}
    for host, article, rest, marks in parsed.values():
        other = "\n".join(t for t, m in zip(rest, marks, strict=True) if not m)
        streams.setdefault((host, False), set()).add(article or "")
        streams.setdefault((host, True), set()).add(other)
    for i, (host, article, rest, marks) in parsed.items():
        is_open = article is None
        kept = [t for t, m in zip(rest, marks, strict=True) if not m] if is_open else article.split("\n")
        tokens = "\n".join(kept).split()
        others = [t.split() for t in streams[host, is_open] if t]
        texts = [f" {' '.join(t)} " for t in others]
        covered = [False] * len(tokens)
        for a in range(len(tokens)):
            for b in range(a + html.MIN_RUN, len(tokens) + 1):
                run = f" {' '.join(tokens[a:b])} "
                pages = sum(run in t for t in texts)
                if pages < html.MIN_PAGES or pages < html.SHARE * len(texts):
                    break
                covered[a:b] = [True] * (b - a)
        places, at = [], 0
        for block in kept:
            n = len(block.split())
            places.append((block, n, all(covered[at:at + n])))
            at += n
        if sum(covered) > (html.COPIED_OPEN if is_open else html.COPIED) * len(tokens) and (
                not is_open or any(n >= html.PARAGRAPH and gone for _, n, gone in places)):
            places = [(block, n, False) for block, n, _ in places]
        out[i] = "\n".join(block for block, _, gone in places if not gone)
    return out


def site(draw, host, pages, articles):
    """(rows, {id: true text}) of a host with a template: menus, notices inside and outside of articles, quotes, mirrors and index pages."""
    words = lambda n: " ".join(draw.choice("abcdefghij") + str(draw.randrange(400)) for _ in range(n))
    top, notice, foot, quote = words(draw.randrange(3, 20)), words(draw.randrange(9, 15)), words(12), words(45)
    rows, truth, bodies = [], {}, []
    for k in range(pages):
        body = [words(draw.randrange(20, 60)) for _ in range(draw.randrange(2, 5))]
        if draw.random() < 0.15:
            body.insert(1, quote)
        if draw.random() < 0.1 and bodies:
            body = [*draw.choice(bodies)[:-1], words(20)]  # a later version of an earlier page
        bodies.append(body)
        inner = [body[0], *([notice] if draw.random() < 0.9 else []), *body[1:]]
        text = "".join(f"<p>{entities.escape(p)}</p>" for p in inner)
        frame = f"<article>{text}</article>" if articles else f"<div>{text}</div>"
        number = len(rows) + 1000 * hash_of(host)
        rows.append((number, f"https://{host}/{k}", f"<body><div class='nav-bar'>{words(4)}</div><div>{top}</div>{frame}<div>{foot}</div></body>"))
        truth[number] = "\n".join(body)
    return rows, truth


def hash_of(host):
    return int(host[1:].split(".")[0])


def counted(text):
    from collections import Counter

    return Counter(text.split())


def test_labelled_pages(spark):
    """Precision and recall of words on hosts whose templates are known, and equality with the plain version."""
    draw = random.Random(7)
    rows, truth = [], {}
    for n, (pages, articles) in enumerate([(30, True), (30, False), (60, True), (60, False), (8, True), (8, False), (1, True), (2, True)]):
        more, own = site(draw, f"h{n}.example.com", pages, articles)
        rows += more
        truth |= own
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in html.extract(frame).collect()}
    assert got == plain_extract(rows)
    met = sum((counted(got[i]) & counted(truth[i])).total() for i in truth)
    precision, recall = met / sum(counted(t).total() for t in got.values()), met / sum(counted(t).total() for t in truth.values())
    print(f"precision {precision:.4f} recall {recall:.4f}")
    assert precision >= 0.95 and recall >= 0.99


def test_suffix_array_orders_runs():
    draw = np.random.default_rng(1)
    for n in (1, 5, 8, 300):
        tokens = draw.integers(0, 3, n).astype(np.uint64)
        order, rank = html.suffix_array(tokens)
        runs = [tuple(tokens[i:i + html.MIN_RUN].tolist()) for i in range(n)]
        assert [runs[i] for i in order] == sorted(runs)
        assert all((rank[i] == rank[j]) == (runs[i] == runs[j]) for i in range(n) for j in range(0, n, 7))


def test_shared_runs_equal_windows():
    draw = np.random.default_rng(2)
    for n in (0, 7, 8, 400):
        tokens = draw.integers(0, 2, n).astype(np.uint64)
        page = np.sort(draw.integers(0, 6, n))
        pages = {}
        for i in range(n - html.MIN_RUN + 1):
            if page[i] == page[i + html.MIN_RUN - 1]:
                pages.setdefault(tuple(tokens[i:i + html.MIN_RUN].tolist()), set()).add(int(page[i]))
        for least in (1, 2, 4):
            hashes, counts = html.shared_runs(tokens, page, least)
            assert sorted(counts.tolist()) == sorted(len(p) for p in pages.values() if len(p) >= least)
            assert len(set(hashes.tolist())) == len(hashes)


def test_slices_count_pages_and_cut_by_host():
    same = "a b c d e f g h i"
    rows = [("s", 1, same), ("s", 1, same), ("s", 2, "x " + same), ("s", 3, "short one"), ("t", 1, same), ("u", 5, same), ("u", 6, same + " j")]
    rows = [(s, n, zstandard.ZstdCompressor().compress(t.encode())) for s, n, t in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["space", "stream", "text"])
    for parts in ([batch], [batch.slice(0, 3), batch.slice(3)]):
        told = [r for b in html.slice_runs(iter(parts)) for r in b.to_pylist()]
        assert [(r["space"], r["pages"], sorted(r["counts"])) for r in told] == [("s", 3, [2, 2]), ("t", 1, []), ("u", 2, [2, 2])]
