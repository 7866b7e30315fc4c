"""Operators 2 and 4 against brute force and on awkward rows."""

from __future__ import annotations

import html
import re

from errscope.llm.html_text import extract_text, main_text
from errscope.llm.license_scan import BASE_PHRASES, license_scan

from .conftest import SF, words

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies for a long list of reasons that nobody reads.</div>%s
<div id="comments"><p>Reader: a long comment with many words that should not be kept at all.</p></div>
<aside>Related articles about something else entirely, with quite some text.</aside>
<form><p>Subscribe to our letter and more words here</p></form><footer>&copy; 2020 all rights reserved by everyone</footer></body></html>"""
BODY = "<h2>Head &amp; tail</h2><p>A <b>bo</b>ld move&nbsp;of\n  many words, long enough to be text.<p>Yes.<p>Another long paragraph with a <a href=x>link</a> inside of it."
TEXT = "Head & tail A bold move of many words, long enough to be text. Yes. Another long paragraph with a link inside of it."


def test_main_text_of_layouts():
    for wrap in ("<article>%s</article>", "<main>%s</main>", "<div class='content'>%s</div>", "<div class='post-body'><section>%s</section></div>"):
        assert main_text(PAGE % (wrap % BODY)) == TEXT, wrap
    assert main_text(PAGE % f"<article class='post comment-enabled'><header class='entry-header'><h2>Head &amp; tail</h2></header>{BODY.split('</h2>')[1]}</article>") == TEXT


def test_main_text_of_pieces():
    assert main_text(None) == main_text("") == main_text("<script>x</script>") == ""
    assert main_text("plain &lt;text&gt; &#233;") == "plain <text> é"
    assert main_text("<p>one</p><p>two<br>three") == "one two three"
    assert main_text("<article><p>unclosed <b>bold<p>next</article> tail") == "unclosed bold next"


def test_main_text_of_uneven_containers():
    """Short paragraphs or sections beside one very long paragraph stay."""
    for times in (25, 12):
        for at in (0, 7, 29):
            texts = [" ".join(f"word{i}x{j}" for j in range(12 * (times if i == at else 1))) + "." for i in range(30)]
            one_each = "".join(f"<div>{t}</div>" for t in texts)
            paragraphs = "".join(f"<div class='para'><p>{t}</p></div>" for t in texts)
            sections = "".join(f"<section id=s{i}><h2>Part {i}</h2><p>{texts[i]}</p><p>{texts[i + 1]}</p></section>" for i in range(0, 30, 2))
            for body in (one_each, paragraphs, f"<div class='content'>{one_each}</div>", f"<div><div class='inner'>{paragraphs}</div></div>"):
                assert main_text(PAGE % body) == " ".join(texts), (times, at)
            want = " ".join(f"Part {i} {texts[i]} {texts[i + 1]}" for i in range(0, 30, 2))
            assert main_text(PAGE % f"<div>{sections}</div>") == want
            quote = f"<div class='story'><p>Short one.</p><blockquote><p>{texts[at]}</p></blockquote><p>Last words</p></div>"
            assert main_text(PAGE % quote) == f"Short one. {texts[at]} Last words"
    text = "A long paragraph of the story with many words in it, again and again and once more."
    links = "<div><a href=/>Home</a> <a href=/b>More</a></div>"
    assert main_text(PAGE % f"<div class='brand'>Site name</div>{links * 3}<div class='story'><p>{text}</p><p>{text}</p></div>") == f"{text} {text}"


def test_main_text_with_missing_end_tags():
    text = "The story has words enough to be a paragraph. And it goes on for a second sentence here."
    body = f"<article><p>{text}<p>{text}</article>"
    want = f"{text} {text}"
    for page in (
        f"<!DOCTYPE html><html><head><title>T</title><meta charset=utf-8><body>{body}</body></html>",
        f"<head><title>T</title><style>p{{}}</style><noscript>no</noscript>{body}",
        f"<html><head><title>T</title><link rel=x href=y><div>{body}</div>",
        f"<html><head><title>T</title><noscript><body><p>{text}<p>{text}",
        f"<html><head><title>T</title>{text} <b>{text}</b>",
    ):
        assert main_text(page) == want, page
    for tag in ("nav", "aside", "form", "label", "button", "footer", "menu", "select"):
        beside = f"<{tag}><a href=/>Home</a> <a href=/b>More</a>"
        assert main_text(f"<html><body><div>{beside}{body}</div></body></html>") == want, tag
        assert main_text(f"<html><body><div>{beside}<main>{body}</main></div>") == want, tag
        assert main_text(f"<html><body>{beside}<div role=main><p>{text}</p><p>{text}</div>") == want, tag
        assert main_text(f"<html><body>{beside}<div class=story><p>{text}</p><p>{text}</p></div></body></html>") == want, tag
    assert main_text(f"<body><select><option>One<option>Two</select><p class=advertisement>Buy<div><p>{text}<p>{text}</div>") == want
    assert main_text(f"<body><ul><li class=ad>Buy<li>{text}<li>{text}</ul>") == want
    # what is closed stays dropped, articles included
    assert main_text(f"<body>{body}<aside><article><p>Another story that is only a teaser.</p></article></aside><nav><div>Home</div></nav>") == want


def test_extract_text_matches_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in pages.collect():
        body = r.html[r.html.index("<article>") : r.html.index("</article>")]
        want[r.page_id] = " ".join(html.unescape(re.sub("<[^>]+>", " ", re.sub("</?b>", "", body))).split())
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    assert got == want


def test_extract_text_awkward_rows(spark):
    long_page = "<article>" + "<p>some words in a paragraph</p>" * 20_000 + "</article>"
    rows = [(1, None, None), (1, "u", ""), (2, "u", long_page), (None, "u", "<p>x</p>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.n_chars) for r in extract_text(df).collect()), key=str)
    assert got == sorted([(1, 0), (1, 0), (2, 20_000 * 26 - 1), (None, 1)], key=str)
    assert extract_text(df.limit(0)).count() == 0


def _brute_places(text):
    w, starts, labels = words(text), [], set()
    for phrase, label in BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_places_match_brute_force(docs):
    rows = docs.collect()
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan(docs).collect()}
    assert got == {r.doc_id: _brute_places(r.text) for r in rows}
    assert any(x[1] for x in got.values())


def test_license_overlaps_and_breaks(spark):
    texts = [
        "cc by by cc by, CC-BY mit. license MIT licence general public general public license",
        "general public license" * 2,
        "mit",
        "license",
        "apache\nlicense éapache license apache2 license",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan(df).collect()}
    assert got == {i: _brute_places(t) for i, t in enumerate(texts)}


# the contract's phrases, written out and not imported
CONTRACT_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def _contract_places(text):
    w = words(text)
    at = {(i, label) for phrase, label in CONTRACT_PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()}
    starts = [i for i, _ in at]
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in at}))


def test_license_places_of_the_contract(spark, docs):
    texts = [
        "under the GNU General Public License",
        "GNU General Public License, then GNU\nGeneral Public License",
        "the GNU Lesser General Public License and the GNU Affero General Public License",
        "a general public license; general public license",
        "CC BY, the Apache License, an MIT license and gnu gnu general public license",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan(df).collect()}
    assert got == {i: _contract_places(t) for i, t in enumerate(texts)}
    assert got[0][1:] == (1, 2, 2, "gpl") and got[2][1:] == got[3][1:] == (0, None, None, "")
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan(docs).collect()}
    assert got == {r.doc_id: _contract_places(r.text) for r in docs.collect()}


def test_license_templates(spark):
    grant = "Foo bar. Permission is hereby granted, free of charge, to any person getting a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software. The end."
    rows = [(1, grant), (2, "Licensed under CC BY-NC 4.0."), (3, "the rights to use of the public of this"), (4, "This work is licensed under the GNU General Public License, version 3.")]
    got = {r.doc_id: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "mit-grant" and got[1].base_labels == "" and 0.7 < got[1].score <= 1
    assert any(s.label == "mit-grant" and s.first == 2 for s in got[1].spans)
    assert got[2].labels == "cc-by,cc-by-nc-4.0" and got[2].score == 1
    assert got[3].labels == "" and got[3].score < 0.7
    assert got[4].labels == "gpl,gpl-3.0"


def test_license_awkward_rows(edge_docs, no_docs):
    got = sorted(((r.doc_id, r.n_words, r.labels, r.score) for r in license_scan(edge_docs).collect()), key=str)
    assert len(got) == 8 and (2, 0, "", 0.0) in got and (3, 0, "", 0.0) in got and (4, 120_000, "", 0.0) in got
    assert license_scan(no_docs).count() == 0
