"""Tokenising, personal data, decontamination, page text, language and quality."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm_fixtures import corpus, docs_of  # noqa: F401
from voltmark.llm import batches as B
from voltmark.llm import bpe, decontaminate, html_text, language, pii, quality
from voltmark.llm.scratch import Scratch

# -- batches ----------------------------------------------------------------------


def test_words_of_texts():
    column = pa.array(["a b", None, "", " c\td\n", "é,x"])[1:]
    data, offsets = B.texts(column)
    starts, ends, of = B.words(data, offsets, B.NOT_SPACE)
    assert [(bytes(data[a:b]).decode(), t) for a, b, t in zip(starts, ends, of, strict=True)] == [("c", 2), ("d", 2), ("é,x", 3)]
    assert B.texts(pa.array([], pa.string()))[1].tolist() == [0]
    spans = B.Spans(1)
    both = np.frombuffer(b"abcabc", np.uint8)
    h = spans.of_bytes(both, np.array([0, 3, 0, 1]), np.array([3, 6, 2, 1]))
    assert h[0] == h[1] != h[2] and list(B.pieces(np.array([0, 5, 9, 9, 30]), 10)) == [(0, 3), (3, 4)]


# -- byte-pair encoding -------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def coder():
    return bpe.Bpe(open(PATH, encoding="utf-8").read())


def test_encoding_equals_the_library(coder, corpus):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    bits = ["a", "'s", "'LL", " ", "\n", "Σ", "ΑΣ", "İ", "é", "<|endoftext|>", "<|startoftext|>", "<|", "日本", "12", "½", "\x1c", "\x85", "🙂", "ß", "aaaa", "the", "...."]
    odd = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(1500)]
    long = ["x" * 5000, "ab" * 3000 + "é" * 100, "." * 2000]
    for text in [t for _, t in corpus] + odd + long:
        ids = coder.encode(text)
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert coder.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_cuts_are_where_no_token_can_be(coder):
    fragments = coder.cuts("naïve日本x".encode())
    assert b"".join(fragments) == "naïve日本x".encode() and len(fragments) > 1
    symbols = [coder.characters[b] for b in b"international" * 4]
    assert coder._merged_short(list(symbols)) == coder._merged_long(list(symbols))


def test_encoded_table(docs_of):
    got = {r.doc_id: r for r in bpe.encoded(docs_of([(1, "Hello, hello"), (2, "")]), PATH).collect()}
    library = Tokenizer.from_file(PATH).encode("Hello, hello", add_special_tokens=False)
    assert got[1].ids == library.ids and got[1].n_tokens == len(library.ids)
    assert got[1].ids_sha256 == hashlib.sha256(np.array(library.ids, "<u4").tobytes()).hexdigest()
    assert got[2].ids == [] and got[5].n_tokens == 0 and got[5].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.encoded(docs_of([], False), PATH).isEmpty()


# -- personal data --------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and doubled % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, *m.span()))
    return found


CARD = "4539 1488 0343 6467"
ZONES = [
    f"{before} {what} {after}"
    for before, after in (("to", "or that"), ("und die", "ist"), ("en la", "de."))
    for what in ("joe.smith42@mail7.example.com", "84.26.86.227", CARD.replace(" ", ""), "+1 (603) 555-8791", "a_b@x-y.org", "+49 30 1234567", "10.0.0.1", CARD)
] * 4


@pytest.fixture(scope="module")
def field():
    return pii.fit(ZONES)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    for alphabet in ("ab1.0@-+ ()%_é٣", "0123456789 -.", "+()0123 -.", "a@.b"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1" * 200_000 + "a@" * 5000 + "+" * 1000)[:1] == []


def test_the_field_finds_more_and_leaves_clean_text_alone(field):
    def found(text):
        return [(k, text[a:b]) for k, a, b in pii.all_spans(text, field)[1]]

    assert found("call (603) 555-8791 now") == [("phone", "(603) 555-8791")]
    assert found("write joe.smith (at) mail (dot) example (dot) com today") == [("email", "joe.smith (at) mail (dot) example (dot) com")]
    assert found("card 4539.1488.0343.6467 here") == [("card", "4539.1488.0343.6467")]
    for clean in ("on 2024-05-06 or 12.5.2001", "version 1.2.3 of 17", "he was at 5 dot", 'token = "aa6b1c8d5dcd1b1e1d9b1f6d7f"', "from 1999-2003, 1,234,567 people"):
        assert found(clean) == [], clean


def test_decoding_is_the_best_segmentation():
    rng = random.Random(6)
    for _ in range(60):
        model = pii.SemiMarkov({}, np.array([[rng.uniform(-1, 1) for _ in range(5)] for _ in range(5)]))
        n = rng.randrange(1, 6)
        candidates = [(i, j, rng.randrange(4), [f"f{rng.randrange(8)}"]) for i in range(n) for j in range(i + 1, n + 1) if rng.random() < 0.6]
        model.weights = {f"f{k}": rng.uniform(-2, 2) for k in range(8)}
        zone = pii.Zone([(k, k + 1) for k in range(n)], candidates)

        def ways(at, before):
            if at == n:
                yield 0.0, []
                return
            for score, rest in ways(at + 1, pii.OUTSIDE):
                yield model.follows[before, pii.OUTSIDE] + score, rest
            for number, (i, j, kind, features) in enumerate(candidates):
                if i == at:
                    for score, rest in ways(j, kind):
                        yield model.follows[before, kind] + model.score(features) + score, [number, *rest]

        best, chosen = max(ways(0, pii.OUTSIDE), key=lambda w: w[0])
        got = model.decode(zone)
        assert any(abs(s - best) < 1e-9 and c == got for s, c in ways(0, pii.OUTSIDE)), (got, chosen)


def test_personal_data_table(docs_of, field):
    text = f"Mail é a.b@c.de or 10.0.0.1, {CARD}, +1 (603) 555-8791."
    got = {r.doc_id: r for r in pii.personal_data(docs_of([(1, text), (2, "nothing")]), field, redact=True).collect()}
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(text))
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 1, 1)
    assert got[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and got[1].spans == base
    assert got[1].redacted == "Mail é [email] or [ip], [card], [phone]."
    assert got[5].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    trained = pii.trained(docs_of([(1, text), (2, "nothing")]))
    assert pii.all_spans("nothing 12", trained)[1] == []
    assert pii.personal_data(docs_of([], False), pii.trained(docs_of([], False))).isEmpty()


def test_rare_labels_are_learned_from(docs_of, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "fit", lambda texts: seen.extend(texts))
    rows = [(i, f"in {1000 + i} it cost {i},50 and more") for i in range(10, 900)] + [(5000, f"pay {CARD} now"), (5001, "call +1 (603) 555-8791 now")]
    rows += [(5002, " ".join(f"at 84.26.86.{k} up" for k in range(60)))]
    pii.trained(docs_of(rows), sample_zones=40)
    kinds = [{s[0] for s in pii.base_spans(t)} for t in seen]
    assert sum("card" in k for k in kinds) == sum("phone" in k for k in kinds) == 1 and sum("ip" in k for k in kinds) == 10 and sum(not k for k in kinds) == 10


# -- decontamination -------------------------------------------------------------------


def plain_contamination(docs, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    result = {}
    for i, text in docs:
        own, hit, names = words(text), set(), set()
        for item, item_text in items:
            w = words(item_text)
            size = min(window, len(w))
            for k in range(len(w) - size + 1 if w and item is not None else 0):
                for p in range(len(own) - size + 1):
                    if own[p : p + size] == w[k : k + size]:
                        hit |= set(range(p, p + size))
                        names.add(str(item))
        result[i] = (len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    return result


@pytest.mark.parametrize("query_bytes", [32 << 20, 600])
def test_contamination_against_brute_force(spark, docs_of, corpus, query_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(decontaminate, "SEGMENT_TOKENS", 500)
    docs = [d for d in corpus if len(d[1]) < 3000]
    items = [(k, " ".join(re.split(r"\s+", docs[k][1])[3:22]).upper()) for k in (100, 3, 20)] + [(9, "one, TWO!"), (10, None), (11, "--"), (12, "never seen words of ten or more in a row at all"), (None, "one")]
    items += [items[0]]
    df = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.contamination(docs_of(docs), df, window=10).collect()
    expected = plain_contamination([*docs, (5, None)], items, 10)
    assert {r.doc_id: tuple(r)[1:] for r in got if r.doc_id is not None} == expected
    assert sum(v[4] for v in expected.values()) >= 4
    assert decontaminate.contamination(docs_of([], False), df).isEmpty()
    assert decontaminate.contamination(docs_of(docs), df.limit(0)).where("contaminated").isEmpty()


@pytest.mark.parametrize("query_bytes", [32 << 20, 60])
def test_rows_without_id_or_with_one_id_are_judged_each(spark, query_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(decontaminate, "SEGMENT_TOKENS", 7)
    docs = [(1, "one two three"), (1, "one two three"), (1, "four five six"), (1, "seven is clean"), (None, "one two three"), (None, "seven is clean"), (None, "seven is clean"), (None, None), (None, None)]
    items = [(k, t) for k, t in enumerate(["one two three", "four five six", "never seen words", "other words unseen"] * 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    questions = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(df, questions, window=3).collect()
    expected = [(i, *plain_contamination([(i, t)], items, 3)[i]) for i, t in docs]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    index = decontaminate.build_index(df, Scratch(spark, "t"))
    assert sorted(len(r.hits) for r in decontaminate.search(index, questions, window=3).collect()) == [0] * 5 + [3] * 4


def test_proximity_search(spark, docs_of):
    docs = [(1, "alpha x beta gamma"), (2, "gamma y beta z alpha"), (3, "alpha beta x y z gamma"), (4, "alpha beta")]
    index = decontaminate.build_index(docs_of(docs, False), Scratch(spark, "t"))
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    near = {r.doc_id: [(h.item_id, h.start) for h in r.hits] for r in decontaminate.search(index, items, slop=2).collect()}
    assert near == {1: [(7, 0)], 2: [(7, 0)], 3: [], 4: []}
    exact = {r.doc_id: len(r.hits) for r in decontaminate.search(index, items).collect()}
    assert set(exact.values()) == {0}


# -- pages ------------------------------------------------------------------------------

LONG = "The quick brown fox jumped over the lazy dog and went on to the market. It bought some apples there."


def page(k, lines):
    menu = "".join(f"<li><a href='/{x}'>{x}</a></li>" for x in ("One", "Two", "Three"))
    body = "".join(f"<p>{x}" for x in lines)
    return f"<!DOCTYPE html><html><head><title>T{k}</title><script>var t='</p>';</script></head><body><nav><ul>{menu}</ul></nav><div class=\"ad\">Buy {k} now</div><article><h1>Title {k}</h1>{body}</article><footer>&copy; site {k}</footer></body></html>"


@pytest.fixture(scope="module")
def page_field():
    rng = random.Random(2)
    return html_text.fit([page(k, [" ".join(rng.sample(LONG.split(), rng.randrange(1, 18))) + "." for _ in range(rng.randrange(1, 9))]) for k in range(80)])


def elements(block):
    found, path = [], block.path
    while path is not None:
        found.insert(0, " ".join([path.tag, *path.names]))
        path = path.parent
    return found


def test_blocks():
    source = "<p>a&amp;b <b>c</b>d<p>e<!-- x --><br>f<div class='Side-Bar'>g<script>if(a<b)</script></div>h<ul><li>1<li>2</ul><style>z</style><a href=x>i j"
    found = html_text.blocks(source)
    assert [b.text for b in found] == ["a&b cd", "e", "f", "g", "h", "1", "2", "i j"]
    assert elements(found[3]) == ["div side bar"] and found[-1].linked == 3 and elements(found[6]) == ["ul", "li"]
    assert html_text.blocks("") == [] and [b.text for b in html_text.blocks("1 < 2 <b")] == ["1 < 2 <b"]
    assert len(html_text.blocks("<div>" * 3000 + "x" + "<a b='" * 500)) <= 2


def test_a_head_ends_without_its_end_tag_and_fallbacks_count():
    def texts(source):
        return [b.text for b in html_text.blocks(source)]

    assert texts("<html><head><title>x</title><body><article>one<p>two</article>") == ["one", "two"]
    assert texts("<head><meta charset=u><script>s</script> <link rel=x><div>one</div></head><p>two") == ["one", "two"]
    assert texts("<html><head><title>x</title>\n one <b>two</b></html>") == ["one two"]
    assert texts("<head><title>x</title>\n</head>\n<body>one") == ["one"]
    assert texts("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then<p>3") == ["if x=2 then", "3"]
    assert texts("<p>a <video><source src=v>b</video> c <object><param name=x>d</object> <audio>e</audio><p>f") == ["a b c d e", "f"]


def test_all_names_of_an_element_count():
    many = "col-md-4 col-sm-12 d-none d-lg-block order-lg-2 sidebar"
    found = html_text.blocks(f'<main><p>{LONG}</p><div class="{many}">Offers</div></main>')
    assert elements(found[1]) == ["main", "div col md sm none lg block order sidebar"]
    assert html_text.labelled(found) == [1, 0]


@pytest.mark.parametrize("name", html_text.OTHER_NAMES)
def test_names_of_the_page_and_of_the_article_exclude_nothing(name):
    sources = [page(k, [LONG] * (1 + k % 4)) for k in range(3)]
    for old, new in (("<body>", f'<body class="has-{name} no-{name}">'), ("<article>", f'<article class="post {name}" id="{name}">'), ("<article>", f'<main role="{name}"><article>')):
        if old == "<article>" and name in html_text.REPLY_NAMES and "main" not in new:
            continue  # an article that is called a comment is one
        for source in sources:
            assert html_text.labelled(html_text.blocks(source.replace(old, new))) == html_text.labelled(html_text.blocks(source))


@pytest.mark.parametrize("name", ["sidebar", "search", "comments"])
def test_sites_whose_body_is_called_like_a_part(name):
    sources = [page(k, [LONG, "Short.", LONG][: 1 + k % 3]).replace("<body>", f'<body class="has-{name}">') for k in range(40)]
    field = html_text.fit(sources)
    assert [html_text.main_text(s, field) for s in sources] == [" ".join([f"Title {k}", *[LONG, "Short.", LONG][: 1 + k % 3]]) for k in range(40)]


def test_what_lies_below_an_article_may_be_excluded():
    def content(source):
        found = html_text.blocks(source)
        return [b.text for b, y in zip(found, html_text.labelled(found) or [], strict=False) if y]

    assert content("<article><p>a<div class=share>b</div><aside>c</aside><article class=comment>d</article><p>e</article>") == ["a", "e"]
    assert content("<aside><article>a</article></aside><article>b</article>") == ["b"]
    assert content("<form class=search><article>a</article></form>") == ["a"]
    assert content("<article>teaser</article><main><h1>a</h1><div class=related>b</div></main>") == ["a"]
    assert html_text.labelled(html_text.blocks("<div>a</div>")) is None


def test_empty_comments_and_end_tags_with_more_than_a_name():
    def texts(source):
        return [b.text for b in html_text.blocks(source)]

    assert texts("<p>a<!--><p>b<!---><p>c<!-- d --!><p>e<!-- f") == ["a", "b", "c", "e"]
    assert texts("<p>a<script>b</scripty></script foo><p>c<style>d</style/><p>e") == ["a", "c", "e"]


@pytest.mark.parametrize("tag", ["div", "font", "p", "li", "td", "b"])
def test_pages_that_close_nothing(page_field, tag):
    import time

    def seconds(n):
        start = time.perf_counter()
        text = html_text.main_text(f"<article><{tag}>word " * n + "</b></article></i>", page_field)
        assert text == "" or set(text.split()) == {"word"}
        return time.perf_counter() - start

    seconds(100)
    assert seconds(20_000) < 12 * max(0.05, seconds(4_000))  # not with the square


def test_pages_that_mark_nothing_train_on_layouts():
    rng = random.Random(9)
    lines = [[" ".join(rng.sample(LONG.split(), 15)) + "." for _ in range(1 + k % 4)] for k in range(60)]
    sources = [page(k, x).replace("<article>", "<div class=entry>").replace("</article>", "</div>") for k, x in enumerate(lines)]
    field = html_text.fit(sources)
    found = [html_text.main_text(s, field) for s in sources]
    assert all(" ".join(x) in text and "Three" not in text for x, text in zip(lines, found, strict=True))


def test_main_text_of_pages_laid_out_otherwise(page_field):
    f = page_field
    assert html_text.main_text(page(900, [LONG, "Short.", LONG]), f) == f"Title 900 {LONG} Short. {LONG}"
    other = f"<body><div id=header>Home <a href=x>News</a></div><div class='post-content'><h1>T &amp; U</h1><p>{LONG}<p>{LONG}</div><div id=sidebar><p>{LONG}</div><section id=comments><div class=comment><p>{LONG}</div></section><div class=footer>(c)</div>"
    assert html_text.main_text(other, f) == f"T & U {LONG} {LONG}"
    assert html_text.main_text(None, f) == html_text.main_text("", f) == html_text.main_text("<p></p>", f) == ""


def test_pages_that_mark_an_article_are_learned_from(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(html_text, "fit", lambda sources: seen.extend(sources))
    plain = [(i, f"<body><div>page {i}</div><main><nav>menu</nav></main>") for i in range(300)]
    marked = [(1000 + i, page(i, [LONG])) for i in range(5)]
    html_text.trained(spark.createDataFrame([*plain, *marked, marked[0]], "page_id long, html string").repartition(3), sample_pages=4)
    assert len(seen) == 4 and set(seen) < {h for _, h in marked}
    seen.clear()
    long = (7, page(7, [LONG] * 4000))  # any length counts, unlike any depth
    html_text.trained(spark.createDataFrame([long, (8, page(8, ["<div>" * 600]))], "page_id long, html string"))
    assert seen == [long[1]]
    seen.clear()
    unmarked = [(i, f"<p>{LONG} {i}") for i in range(9)]
    html_text.trained(spark.createDataFrame([*unmarked, (9, "<p>short")], "page_id long, html string"), sample_pages=5)
    assert len(seen) == 5 and set(seen) < {h for _, h in unmarked}


def test_viterbi_is_the_best_labelling():
    rng = random.Random(4)
    for _ in range(100):
        f = html_text.Field({}, np.array([[rng.uniform(-2, 2) for _ in range(2)] for _ in range(2)]))
        scores = [rng.uniform(-3, 3) for _ in range(rng.randrange(1, 8))]

        def value(y, scores=scores, f=f):
            return sum(s for s, k in zip(scores, y, strict=True) if k) + sum(f.follows[a, b] for a, b in zip(y, y[1:], strict=False))

        every = [[n >> k & 1 for k in range(len(scores))] for n in range(2 ** len(scores))]
        assert abs(value(f.decode(scores)) - max(map(value, every))) < 1e-9


def test_pages_table(spark, page_field):
    df = spark.createDataFrame([(1, "u", page(1, [LONG]), "x"), (2, None, None, None), (None, "u", "", "y")], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extracted(df, page_field).collect()}
    assert got == {1: (f"Title 1 {LONG}", len(f"Title 1 {LONG}")), 2: ("", 0), None: ("", 0)}
    empty = html_text.trained(df.limit(0))
    assert html_text.extracted(df.limit(0), empty).isEmpty()


# -- language ------------------------------------------------------------------------------


def speech(rng, lang, n):
    vowels, ends = {"aa": ("ao", "n"), "bb": ("ei", "sch"), "cc": ("uy", "lk")}[lang]
    return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice(vowels) for _ in range(rng.randrange(1, 4))) + rng.choice(["", ends]) for _ in range(n))


def test_language_on_held_out_documents(spark):
    rng = random.Random(11)
    rows = [(i, speech(rng, lang, rng.randrange(3, 40)), lang, 0.5) for i in range(300) for lang in [rng.choice(["aa", "bb", "cc"])]]
    rows += [(900, None, "aa", None), (901, "", "aa", None), (902, "12 !?", "bb", None), (903, "日本語", "cc", None), (None, "bado", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = language.trained(df)
    got = {r.doc_id: r for r in language.identified(df.withColumn("out", language.held_out("doc_id")).drop("lang"), model).collect()}
    held = [(i, lang) for i, _, lang, _ in rows[:300] if got[i].out]
    assert len(held) > 60 and sum(got[i].lang_pred == lang for i, lang in held) >= 0.97 * len(held)
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and got[903].lang_pred in model.languages
    assert all(0 <= r.score <= 1 for r in got.values()) and got[900].score == 0
    assert language.identified(df, language.trained(df.limit(0))).where("lang_pred <> 'und'").isEmpty()


def test_a_rare_language_is_learned_beside_a_common_one(spark):
    rng = random.Random(3)
    rows = [(i, speech(rng, "aa", 30), "aa") for i in range(900)] + [(i, speech(rng, "bb", 30), "bb") for i in range(900, 906)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.trained(df, sample_rows=60, model_words=40)
    assert model.languages == ["aa", "bb"] and np.exp(model.prior)[0] > 0.98
    rare = {w for _, t, lang in rows if lang == "bb" for w in t.split()}
    assert len(rare & set(model.words)) >= 30
    got = {r.doc_id: r.lang_pred for r in language.identified(df, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_unseen_words_fall_back_to_shorter_grams():
    model = language.from_counts([("strasse", "de", 9), ("street", "en", 9), ("xyz", "en", 9)])
    place = {lang: k for k, lang in enumerate(model.languages)}
    assert "strassen" not in model.words
    long = model.of_word("strassen")
    assert long[place["de"]] > long[place["en"]]
    assert (model.of_word("ß日") == 0).all() or np.isfinite(model.of_word("ß日")).all()
    assert language.Identifier(model).identify("xyz xyz")[0] == "en"


def test_texts_without_a_letter_have_no_language():
    identifier = language.Identifier(language.from_counts([("strasse", "de", 9), ("street", "en", 9)]))
    for text in ("²", "½ ①", "Ⅷ", "3 ٣ १", "_ __ ²_", "", None, "!?"):
        assert identifier.identify(text) == ("und", 0.0)
    assert identifier.identify("² street")[0] == "en" and identifier.identify("straße²")[0] == "de"


def test_evidence_is_that_of_a_full_table():
    rng = random.Random(6)
    counts = [(w, lang, rng.randrange(1, 9)) for lang in ("aa", "bb", "cc") for w in {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 6))) for _ in range(30)}]
    model = language.from_counts(counts)
    table = defaultdict(lambda: np.zeros(3))
    for w, lang, n in counts:
        table[w][model.languages.index(lang)] += n
    seen = sum(table.values())
    for w, row in table.items():
        full = np.log(row / seen + 0.5 / seen.max())
        assert np.allclose(model.of_word(w) - model.of_word(w).min(), full - full.min())


def test_two_hundred_languages_fit_a_task():
    import tracemalloc

    rng = random.Random(7)
    spelled = lambda n: "".join("abcdefghij"[int(d)] for d in str(n))
    counts = [(f"w{spelled(k)}x{spelled(lang)}" if k % 3 else f"w{spelled(k)}", f"l{lang:03}", 1 + k % 5) for lang in range(200) for k in range(120)]
    tracemalloc.start()
    model = language.from_counts(counts)
    identifier = language.Identifier(model)
    assert len(model.languages) == 200
    assert model.more.nbytes + model.of.nbytes + model.first.nbytes < 8 << 20  # a full table: over 60 MB
    assert identifier.evidence.nbytes <= language.REMEMBERED_BYTES
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    words = [f"w{spelled(k)}x{spelled(77)}" for k in range(120) if k % 3]
    assert identifier.identify(" ".join(rng.choice(words) for _ in range(50)))[0] == "l077"


# -- quality -----------------------------------------------------------------------------------


def test_features_of_awkward_texts():
    x = quality.features(pa.array([None, "", " ", "A b.\nc!", "x" * 5000]))
    assert x.shape == (5, len(quality.FEATURES)) and np.isfinite(x).all() and (x[0] == 0).all() and (x[0] == x[1]).all()


def test_additive_model_learns_single_and_paired_effects():
    rng = np.random.default_rng(5)
    x = rng.uniform(size=(4000, 5))
    single = (x[:, 0] > 0.6).astype(float)
    model = quality.fit(x, single)
    assert ((model.scores(x) > 0.5) == single).mean() > 0.97
    paired = ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    alone = quality.fit(x, paired, pairs=0)
    both = quality.fit(x, paired)
    assert ((alone.scores(x) > 0.5) == paired).mean() < 0.7 < 0.9 < ((both.scores(x) > 0.5) == paired).mean()
    assert any({a, b} == {1, 2} for a, b, *_ in both.pairs)
    constant = quality.fit(x[:10], np.ones(10))
    assert (constant.scores(x) > 0.9).all() and len(quality.fit(x[:0], np.zeros(0)).scores(x)) == 4000


def test_quality_table(spark, docs_of):
    rng = random.Random(3)
    good = [" ".join(rng.choice(["able", "to", "Write", "clean", "text", "here."]) for _ in range(40)) for _ in range(150)]
    bad = [" ".join(rng.choice(["###", "xx%%", "A!!", "0"]) for _ in range(40)) for _ in range(150)]
    docs = docs_of(list(enumerate(good + bad, 10)))
    labels = spark.createDataFrame([(i + 10, int(i < 150), None) for i in range(300)] + [(None, 1, 0), (11, None, 1), (12, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality.trained(docs, labels)
    got = {r.doc_id: r for r in quality.scored(docs.withColumn("out", quality.held_out("doc_id")), model).collect()}
    held = [i for i in range(10, 310) if got[i].out]
    assert len(held) > 30 and all(got[i].predicted == int(i < 160) for i in held)
    assert all(0 <= r.score <= 1 for r in got.values()) and got[5].predicted in (0, 1)
    nothing = quality.trained(docs.limit(0), labels.limit(0))
    assert quality.scored(docs.limit(0), nothing).isEmpty()
