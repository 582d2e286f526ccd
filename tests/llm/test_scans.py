import hashlib
import re
import time

import numpy as np

from orderrisk.llm import decontaminate, html_text, licenses, quality

from .common import awkward, frame, lowered

PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(docs, bench):
    windows = {}
    for item, text in bench:
        w = PLAIN.findall(lowered(text))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(str(item))
    sizes, out = {len(x) for x in windows}, {}
    for key, text in docs:
        w, hit, items = PLAIN.findall(lowered(text)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    items |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out[key] = (len(w), len(hit), len(items), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out


def test_decontamination_equals_brute_force(spark):
    docs = awkward()
    base = docs[-1][1].split()
    bench = [(1, " ".join(base[5:40])), (2, " ".join(base[30:45]).upper()), (3, "quick brown"), (4, None), (5, ""), (6, "one"), (6, "one")]
    bench += [(7, " ".join(docs[60][1].split()[70:95])), (8, " ".join(base[100:112]))]
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in bench], "item_id long, text string, fingerprint string, span int")
    found = decontaminate.decontaminate(frame(spark, docs), items).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found} == brute(docs, bench)
    none = decontaminate.decontaminate(frame(spark, docs), items.where("false")).collect()
    assert len(none) == len(docs)
    assert not any(r.contaminated for r in none)
    assert decontaminate.decontaminate(frame(spark, []).where("false"), items).count() == 0


def test_windows_share_fingerprints():
    # Whatever surrounds them, equal windows have equal fingerprints.
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 1 << 63, 20, np.uint64)
    marks = []
    for _ in range(5):
        text = np.concatenate((rng.integers(0, 1 << 63, 9, np.uint64), shared, rng.integers(0, 1 << 63, 30, np.uint64)))
        marks.append(decontaminate._fingerprints(text, np.array([0, len(text)]), 13, 7)[9:17].tolist())
    assert all(m == marks[0] for m in marks)


def aligned(template, text):
    best = [[0] * (len(text) + 1) for _ in range(len(template) + 1)]
    for i, a in enumerate(template):
        for j, b in enumerate(text):
            best[i + 1][j + 1] = max(best[i][j] + (a == b), best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_equals_longest_common_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(40):
        template = rng.integers(1, 9, 12).astype(np.uint64)
        text = rng.integers(1, 9, 12 + 24).astype(np.uint64)
        n, a, b = licenses.align(template, text[None, :], 12)
        assert n[0] <= aligned(template.tolist(), text.tolist())
        assert n[0] <= aligned(template.tolist(), text[a[0] : b[0]].tolist())
    template = np.arange(1, 30, dtype=np.uint64)
    text = np.concatenate((np.zeros(8, np.uint64), template[:10], [np.uint64(99)] * 3, template[12:], np.zeros(20, np.uint64)))
    n, a, b = licenses.align(template, text[None, : len(template) + 16], 8)
    assert (n[0], a[0], b[0]) == (27, 8, 8 + 10 + 3 + 17)


def test_license_scan(spark):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100)
    docs = [
        (1, "Foo. Licensed under CC BY-NC 4.0. and released under the very MIT license"), (2, None), (3, ""), (5, "mit license"),
        (4, "Licensed under CC BY 4.0. x Licensed under CC BY-SA 4.0"), (6, "é " * 5000 + mit.replace("free of charge", "gratis").upper()),
        (7, "Released under the MIT License.\n" * 50), (7, "Released under the MIT License."),
    ]
    found = licenses.scan(frame(spark, docs)).collect()
    texts = {k: (t or "").encode() for k, t in docs}
    got = sorted((r.doc_id, r.license) for r in found if r.doc_id != 7)
    assert got == [(1, "CC-BY-NC-4.0"), (1, "MIT"), (4, "CC-BY-4.0"), (4, "CC-BY-SA-4.0"), (6, "MIT")]
    assert sum(r.doc_id == 7 for r in found) == 51
    first = next(r for r in found if r.doc_id == 1 and r.license.startswith("CC"))
    assert texts[1][first.start_byte : first.end_byte] == b"Licensed under CC BY-NC 4.0"
    long = next(r for r in found if r.doc_id == 6)
    assert 0.9 < long.coverage < 1
    assert long.start_word == 5000
    assert licenses.scan(frame(spark, []).where("false")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- x --><div class="ad">Buy now.</div>
<div class="cookie-notice"><p>We use cookies on this site, read more about them in the policy of this site.</p></div>
<article><h1>Title &amp; more</h1><p><b>First   paragraph of the article with words.<br>Next<p>Short.</p>
<div class="share">Share this</div><form><input><label>Mail</label></form><p>Caf&eacute; <i>o</i>ne &am</p></article>
<aside>Side text that is long enough to look like a paragraph of its own.</aside>
<section id="comments"><p>A reader says many things about this long article, at length.</p></section>
<footer>&copy; site</footer></body></html>"""


def test_html_text(spark):
    assert html_text.main_text(PAGE) == "Title & more First paragraph of the article with words. Next Short. Café one &am"
    free = "<body><div id=menu><a href=x>One</a> <a href=y>Two</a></div><div><p>" + "Long text here. " * 20 + "</p><p>End.</p></div>"
    assert html_text.main_text(free) == ("Long text here. " * 20).strip() + " End."
    pages = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<p>"), (1, "u", PAGE), (4, "x", "just text")]
    rows = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id long, url string, html string, text string, n_chars int")
    found = sorted(((r.page_id or 0), r.url or "", r.text, r.n_chars) for r in html_text.extract(rows).collect())
    article = html_text.main_text(PAGE)
    assert found == [(0, "w", "", 0), (1, "u", article, len(article)), (1, "u", article, len(article)), (2, "", "", 0), (3, "v", "", 0), (4, "x", "just text", 9)]
    assert html_text.extract(rows.where("false")).count() == 0


def test_quality_on_held_out_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.quality(docs, labels)
    assert scored.count() == docs.count()
    shown = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(shown) > 30
    assert sum(r.predicted == r.quality for r in shown) >= 0.97 * len(shown)


def test_quality_of_awkward_rows(spark):
    docs = frame(spark, [*awkward(), (4, "One"), (None, "x")])
    labels = spark.createDataFrame([(100, 1, 0, 9.0), (101, 1, 0, 9.0), (8, 0, 0, 9.0), (9, 0, 0, 9.0), (11, 5, 0, 9.0), (12, None, 0, 9.0)], "doc_id long, quality int, toxic int, size double")
    found = quality.quality(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert {r.score for r in quality.quality(docs, labels.where("false")).collect()} == {0.5}
    assert {r.score for r in quality.quality(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert quality.quality(docs.where("false"), labels).count() == 0


def test_wrappers_around_the_article():
    body = "<h1>Title</h1><p>" + "Words of the article. " * 10 + "</p><div class='share'>Share</div>"
    want = "Title " + ("Words of the article. " * 10).strip()
    side = "<div class='sidebar'><p>Side text of some length that is not the article.</p></div>"
    talk = "<div class='comments'><article><p>" + "A reader says much. " * 9 + "</p></article></div>"
    for page in (
        f"<div class='content-sidebar-wrap'><main>{body}</main>{side}</div>",
        f"<div id='page' class='has-sidebar'><article>{body}</article>{side}{talk}</div>",
        f"<div class='with-nav'><div class='post'>{body}</div>{side}</div>",
        f"<form action='x'><div>{body}</div>{side}</form>",
        f"<form><main>{body}</main></form>",
        f"<article>{body}</article>{talk}{side}",
    ):
        assert html_text.main_text(f"<html><body>{page}</body></html>") == want
    # Without a wrapper nothing beside the article comes in, however long.
    free = f"<body><div class='post'>{body}</div><div class='comments'><p>" + "A reader says much. " * 90 + "</p></div></body>"
    assert html_text.main_text(free) == want


def test_adverts_within_a_line_are_left_out():
    page = "<html><body><article><p>Start <span class='ad'>BUY <b>now</b></span> end of it. <a class='share'>Share</a></p><p>And <span style='display: none'>x</span>more.</p></article></body></html>"
    assert html_text.main_text(page) == "Start end of it. And more."


def test_long_and_deep_pages_take_time_in_proportion():
    for piece in ("<i>word ", "<b><p>word ", "<div>word</i></b> ", "<span class='ad'>word ", "<a>word "):
        page = "<p>Begin of a page. " + piece * (1_000_000 // len(piece))
        start = time.perf_counter()
        html_text.main_text(page)
        assert time.perf_counter() - start < 8
