"""Texts and pages that a squared amount of work would stop, in seconds."""

import random
import re
import time
from collections import Counter, defaultdict

import pytest
from faremill.llm import near_duplicates, page_text, pii_boost


@pytest.mark.parametrize("part", ["<div>", "<b><i>", '<a x="', "<a '\"", "<p><b>", "</script", "<!x", "<a <b ", "<td></p>", "<"])
def test_pages_of_one_broken_or_nested_part(part):
    began = time.time()
    for page in (part * 100_000, part * 100_000 + ">", "<article>" + part * 50_000 + "text</article>"):
        page_text.extract(page, {})
    assert time.time() - began < 30


def test_elements_close_and_kinds_are_the_innermost():
    page = "<main><div class='menu'><p>a<p>b</div><p>c<td>d<p>e</td></p>f</main>g<ul id=x><li>h<script>no<p></script>i"
    found = [(t.kind, t.text) for t in page_text.tokens(page) if t.text]
    assert found == [
        ("word nav", "a"), ("word nav", "b"), ("word main p", "c"), ("word main td", "d"), ("word main p", "e"),
        ("word main other", "f"), ("word other", "g"), ("word li", "h"), ("word li", "i"),
    ]


def page_of(rng, marked):
    """A page with known main text; menus and the like by element or by class."""
    words = lambda n: " ".join(rng.choice(["river", "stone", "light", "paper", "garden"]) for _ in range(n))
    blocks = [words(rng.randrange(12, 40)) for _ in range(rng.randrange(3, 7))]
    role = rng.choice(["<nav>{}</nav>", '<div class="site-menu">{}</div>', '<ul role="navigation"><li>{}</ul>'])
    foot = rng.choice(["<footer>{}</footer>", '<section id="related">{}</section>'])
    body = "".join(f"<p>{b}</p>" for b in blocks)
    body = f"<article>{body}</article>" if marked else f'<div class="story">{body}</div>'
    return f"<html><head><title>t</title></head><body>{role.format(words(6))}{body}{foot.format(words(9))}<script>x()</script></body></html>", " ".join(blocks)


def test_known_pages_with_and_without_article(spark):
    rng = random.Random(8)
    pages = [page_of(rng, i % 2 == 0) for i in range(60)]
    table = spark.createDataFrame([(i, "u", html) for i, (html, _) in enumerate(pages)], "page_id long, url string, html string")
    rows = page_text.extract_pages(table).collect()
    assert {r.page_id: r.text for r in rows} == {i: text for i, (_, text) in enumerate(pages)}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def test_base_spans_of_personal_data_against_plain_patterns(spark):
    rng = random.Random(9)
    parts = ["a.b", "@", "x-y.org", ".", "10", "255", "256", "1.2.3.4", " ", "-", "4111 1111 1111 1111", "+1 (555)", "0199", "é", "+", "7", "tel ", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(30)) for _ in range(400)]
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(d := re.sub(r"\D", "", v)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub(r"\D", "", v)) <= 15),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii_boost.find_personal_data(docs).collect():
        spans = [(m.start(), k, m.end()) for k, (_, p, good) in enumerate(rules) for m in re.finditer(p, texts[r.doc_id]) if good(m[0])]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)], texts[r.doc_id]
        base = ",".join(f"{rules[k][0]}:{s}:{e}" for s, k, e in sorted(spans))
        assert set(base.split(",")) <= set(r.spans.split(",")) | {""}


def test_no_link_of_the_given_table_is_lost(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {}
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for ids in holders.values() if len(ids) > 1 for k, a in enumerate(sorted(ids)) for b in sorted(ids)[k + 1 :])
    part = {i: i for i in sets}
    for (a, b), n in shared.items():
        if 100 * n >= 75 * len(sets[a] | sets[b]):
            low, high = sorted((part[a], part[b]))
            part = {k: low if v == high else v for k, v in part.items()}
    for least in (near_duplicates.LEAST_SHARED, 0):
        rows = near_duplicates.near_duplicates(docs, least).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(sets[i]), part[i]) for i in sets}
