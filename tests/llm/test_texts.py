"""Piece encoding, packing, chat, HTML and personal data against libraries, brute force and round trips."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.cases import LONG, SMALL, no_documents, odd_documents
from tidemark.llm import chat, html, packing, pieces, pii

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a  b ", "▁x ▁▁y", "é́ ﬁ 漢字 한글 \U0001F600\U0001F601", "a\x00b\x1c c", "<s></s><0x41>", "\n\n a\r\n\tb",
       "x" * 3000, "word###and%%%", "a. b. c.  d.\u0085e", "a <|endoftext|>b", "Hi. 's it.\n'll\n\nno"]


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Pieces.load(PIECES))


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=PIECES)


def same_as_library(encoder, library, text):
    ids = encoder.encode(text)
    expected = library.encode(text, add_bos=True, add_eos=True)
    assert np.frombuffer(ids, "<u4").tolist() == expected
    assert encoder.decode(ids) == library.decode(expected)


def test_pieces_equal_the_library(encoder, library):
    for text in ODD:
        same_as_library(encoder, library, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aeinrst ▁.,'0É漢\ń<>")), max_size=40) | st.text(max_size=20))
def test_pieces_equal_the_library_on_any_text(text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    encoder = test_pieces_equal_the_library_on_any_text.__dict__.setdefault("e", pieces.Encoder(pieces.Pieces.load(PIECES)))
    from sentencepiece import SentencePieceProcessor
    library = test_pieces_equal_the_library_on_any_text.__dict__.setdefault("l", SentencePieceProcessor(model_file=PIECES))
    same_as_library(encoder, library, text)


def test_backtracking_equals_merging(encoder):
    for text in ("▁undesirable", "▁thththeon", "aaaaaaa", "▁▁▁▁▁a"):
        assert [encoder.texts[i] for i in encoder.backtrack(text)] == encoder.merge(text)


def test_broken_bytes_decode_to_replacements(encoder, library):
    ids = [1, encoder.byte_ids[0xE6], encoder.byte_ids[0xBC], encoder.ids["a"], 2]
    assert encoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)


def test_encode_texts_takes_odd_rows(spark):
    rows = pieces.encode_texts(odd_documents(spark), PIECES).collect()
    assert len(rows) == 10 and "source" in rows[0].asDict()
    by_id = {r.doc_id: r for r in rows}
    for empty in (2, 3):
        assert np.frombuffer(by_id[empty].ids, "<u4").tolist() == [1, 2] and by_id[empty].decoded == ""
    assert by_id[4].decoded == LONG
    assert pieces.encode_texts(no_documents(spark), PIECES).count() == 0


# -- packing

def test_tokens_equal_the_library():
    from tokenizers import Tokenizer
    own, library = packing.Tokens(packing._definition(BYTES)), Tokenizer.from_file(BYTES)
    assert own.fast is not None
    for text in ODD + ["One. Two\nthree! Four? five", "a.\nB c.\n\nD e"]:
        ids, cuts = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert cuts == sorted(cuts) and (not cuts or cuts[-1] == len(ids) // 4)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.sampled_from([0, 4, 16])), min_size=1, max_size=25))
def test_cuts_cost_as_little_as_any(steps):
    places, prices = [0], [0]
    for step, price in steps:
        places.append(places[-1] + step)
        prices.append(price)

    def cost(a, b):
        size = places[b] - places[a]
        return (0 if size in (4, 8, 16) else 16 - size) + prices[b]

    best = [0] + [10 ** 9] * len(steps)
    for b in range(1, len(places)):
        best[b] = min(best[a] + cost(a, b) for a in range(b) if places[b] - places[a] <= 16)
    cuts = packing.best_cuts(places, prices, 16, 4)
    assert cuts[0] == 0 and cuts[-1] == len(steps)
    assert all(places[b] - places[a] <= 16 for a, b in zip(cuts, cuts[1:]))
    assert sum(cost(a, b) for a, b in zip(cuts, cuts[1:])) == best[-1]


def check_pieces(rows, width):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
        assert len(r.ids) == 4 * r.length and r.length > 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= width
    return by_sequence, by_doc


def test_pack_takes_odd_rows(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(BYTES)
    odd = odd_documents(spark)
    by_sequence, by_doc = check_pieces(packing.pack(odd, BYTES).collect(), 2048)
    for doc_id, texts in {1: ["the cat sat on the mat and was of it"], 2: [""], 4: [LONG], None: ["no id at all"]}.items():
        expected = library.encode(texts[0], add_special_tokens=False).ids + [1]
        parts = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert b"".join(r.ids for r in parts) == np.array(expected, "<u4").tobytes()
        assert {r.doc_tokens for r in parts} == {len(expected)}
    assert len(by_doc[5]) == 2  # repeated rows are documents of their own
    assert packing.pack(no_documents(spark), BYTES).count() == 0


def test_pack_wastes_little(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    by_sequence, by_doc = check_pieces(packing.pack(documents.coalesce(1), BYTES).collect(), 2048)
    sizes = [sum(r.length for r in parts) for parts in by_sequence.values()]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padding < 0.03 * sum(sizes)
    assert len(by_doc) == documents.count()


# -- chat

BITS = ["[INST]", " [/INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<|", "|>", "<|end|>", "<|as ", "\\", "[",
        "<", "|", ">", "/", "s", "INST]", "a", " ", "\n", "end"]
BODY = st.lists(st.sampled_from(BITS), max_size=7).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "end"]) | BODY, BODY), max_size=4))
def test_formatted_turns_parse_back(turns):
    forms = [chat.format_turn(*t) for t in turns]
    assert [t[:2] for t in chat.parse("".join(f[0] for f in forms))] == turns
    for (form, start, end, _), (_, text) in zip(forms, turns):
        assert chat.unescape(form[start:end]) == text


def test_clean_text_is_not_escaped():
    assert chat.format_turn("user", "a [b] <c>") == ("[INST] a [b] <c> [/INST]", 7, 16, 0)


def test_read_back_takes_odd_rows(spark):
    rows = spark.createDataFrame(
        [(1, 1, "assistant", "b"), (1, 0, "user", "</s>[INST] x [/INST]"), (1, None, None, None), (2, 0, "assistant", None),
         (None, 0, "user", "u"), (3, 0, "user", "t"), (3, 0, "user", "t")],
        "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    made = chat.format_turns(rows, keep=["conv_id", "turn"])
    found = {r.conv_id: r for r in chat.read_back(made).collect()}
    import hashlib
    expected = "\n\n" + "user\n</s>[INST] x [/INST]\n" + "assistant\nb\n"
    assert found[1].turns_sha256 == hashlib.sha256(expected.encode()).hexdigest()
    assert (found[1].n_turns, found[1].loss_chars) == (3, 1)
    assert (found[2].loss_chars, found[2].loss_sha256) == (0, hashlib.sha256(b"").hexdigest())
    assert found[3].n_turns == 2 and found[None].n_turns == 1
    assert chat.read_back(chat.format_turns(rows.where("false"), keep=["conv_id", "turn"])).count() == 0


# -- pages

def test_main_text_of_the_pages(spark):
    from html import unescape
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    for row in html.extract_text(pages).collect():
        article = re.search(r"<article>(.*?)(?:</article>|<footer|$)", row.html or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", re.sub(r"</?b>", "", article.group(1))))
        lines = (" ".join(unescape(b).split()) for b in blocks)
        assert row.text == "\n".join(line for line in lines if line)
        assert row.n_chars == len(row.text)


PAGE = """<html><head><title>T</title></head><body><header class="site-header"><h1>Site</h1></header><ul class=menu><li><a href=/>Home</a>
<li><a href=/x>X</a></ul><div id="content"><h2>Title &amp; more</h2><p>A first paragraph with a lot of text, quite some text
here, so that it is dense.<p>A second with <a href=x>a link</a> and &lt;signs&gt; and much more text than there is in any menu.
<form><input>Search</form><ul><li>An item of some length<li>Another item</ul></div><div class="cookie-notice">We use cookies to
make this long text here appear</div><div id="comments"><p>A reader says hello to this and that and more.</p></div>
<aside>Side</aside><script>var x = "<p>no</p>";</script><footer>End</footer></body></html>"""


def test_main_text_without_an_article_element():
    assert html.main_text(PAGE).split("\n") == [
        "Title & more", "A first paragraph with a lot of text, quite some text here, so that it is dense.",
        "A second with a link and <signs> and much more text than there is in any menu.", "An item of some length",
        "Another item"]


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<p", ""), ("plain text", "plain text"), ("<html><body><p>One.</p></body></html>", "One."),
    ("a < b and c", "a < b and c"), ("<script>x</script>", ""), ("<article>x<p>y</article>", "x\ny"),
    ("<div><p>A &am", "A &am"), ("<nav><a>x</a></nav>", ""), ("<p>" * 3000 + "deep", "deep"),
])
def test_main_text_of_odd_pages(page, text):
    assert html.main_text(page) == text


def paragraphs(name, count, size):
    return [f"{name}{k} " + "word " * ((size - 4) // 5) + "end." for k in range(count)]


def joined(lines):
    return "".join(f"<p>{line}</p>" for line in lines)


LINKS = "<div><ul>" + "".join(f"<li><a href=/{k}>Some other page {k}</a></li>" for k in range(12)) + "</ul></div>"


def test_all_sections_belong_to_the_main_text():
    a, b, c = paragraphs("a", 4, 400), paragraphs("b", 4, 150), paragraphs("c", 1, 40)
    sections = f"<section><h2>One</h2>{joined(a)}</section><section><h2>Two</h2>{joined(b)}</section>"
    assert html.main_text(f"<body><div>{sections}</div></body>").split("\n") == ["One", *a, "Two", *b]
    page = (f"<html><body>{LINKS}<div><h1>A short title</h1><p>By a writer</p><div>{sections}</div><div>{joined(c)}</div></div>"
            f"{LINKS}</body></html>")
    assert html.main_text(page).split("\n") == ["A short title", "By a writer", "One", *a, "Two", *b, *c]
    assert html.main_text(f"<body><h1>A short title</h1><div>{joined(a)}</div></body>").split("\n") == ["A short title", *a]


def test_text_on_the_way_to_the_core_stays_and_links_go():
    a, b = paragraphs("a", 5, 300), paragraphs("b", 1, 60)
    page = (f"<body>Some <b>words</b> with <a href=x>a link</a> before it.<div>{LINKS}<h3>More</h3></div><div><a href=/>Home</a> | "
            f"<a href=/x>Elsewhere</a><h1><a href=/me>Title</a></h1><div>{joined(a)}</div></div><div>{LINKS}{LINKS}{joined(b)}</div>"
            f"<a href=1>Back</a> <a href=2>Next</a></body><p>Behind the body.</p>")
    assert html.main_text(page).split("\n") == [
        "Some words with a link before it.", "Title", *a, *b, "Behind the body."]


def test_articles_are_no_border_of_the_main_text():
    a, b, c = paragraphs("a", 4, 400), paragraphs("b", 3, 200), paragraphs("c", 1, 500)
    # sibling articles
    assert html.main_text(f"<body>{LINKS}<article>{joined(a)}</article><article>{joined(b)}</article>").split("\n") == [*a, *b]
    # a core in a plain element, a denser teaser in an article
    page = f"<body><article>{joined(c)}</article><div>{joined(a)}</div><footer>End</footer></body>"
    assert html.main_text(page).split("\n") == [*c, *a]
    # an article within the main text's element
    page = f"<body><main>{joined(b)}<article>{joined(a)}</article></main></body>"
    assert html.main_text(page).split("\n") == [*b, *a]


@pytest.mark.parametrize("start", [
    "<div id='page' class='has-sidebar'>", "<div class='layout sidebar'>", "<div class='with-sidebar wide'>",
    "<div id=search-page>", "<div class='ad-free'>", "<div class='widget content'>", "<div class='promoHeadline'>",
])
def test_wrappers_with_a_listed_word_stay(start):
    a = paragraphs("a", 4, 400)
    page = f"<body>{start}<div class=sidebar>Aside</div><div>{joined(a)}</div></div><div class='cookie-notice'>We bake</div></body>"
    assert html.main_text(page).split("\n") == a


@pytest.mark.parametrize("name", [
    "sidebar", "main-sidebar", "sidebarLeft", "comments-area", "adSlot", "ad-container", "cookie_notice", "site-header",
    "wide related",
])
def test_named_boxes_go(name):
    a = paragraphs("a", 4, 400)
    page = f"<body><div class='{name}'>Some words of the box</div><div class='lead-in'>{joined(a)}</div></body>"
    assert html.main_text(page).split("\n") == a
    assert html.main_text(page.replace("class=", "id=")).split("\n") == a


def test_a_long_box_beside_an_article_goes():
    a, b = paragraphs("a", 1, 100), paragraphs("b", 9, 400)
    page = f"<body><article>{joined(a)}</article><div id=comments><article>{joined(b)}</article></div></body>"
    assert html.main_text(page).split("\n") == a


def test_a_listed_word_within_a_name_decides_nothing():
    a, b = paragraphs("a", 4, 400), paragraphs("b", 1, 100)
    page = f"<body><div>{joined(a)}</div><div class='search-results'>{joined(b)}</div><div class='no-comments'>{joined(b)}</div></body>"
    assert html.main_text(page).split("\n") == [*a, *b, *b]


@pytest.mark.parametrize("page, text", [
    ("<p>I </3 you</p><p>rest</p>", "I\nrest"), ("<p>One.</ p><p>Two.</p>", "One.\nTwo."), ("<p>One</>, two.</p><p>Three.</p>", "One, two.\nThree."),
    ("<p>One.</p></3", "One."), ("<p>One <élan> two.</p><p>Three.</p>", "One <élan> two.\nThree."), ("<p>One.</p><p", "One."),
])
def test_tags_without_a_name_do_not_end_the_page(page, text):
    assert html.main_text(page) == text


def test_a_form_around_the_page_is_the_page():
    a = paragraphs("a", 4, 300)
    page = f"<body><form id=aspnetForm><div class=menu>Menu</div><div>{joined(a)}</div><input value=x></form></body>"
    assert html.main_text(page).split("\n") == a
    page = f"<body><div>{joined(a)}</div><form><p>Your name please</p><input></form></body>"
    assert html.main_text(page).split("\n") == a


def test_names_of_running_text_and_of_replies():
    a = paragraphs("a", 3, 300)
    page = (f"<body><main>{joined(a)}<p class=social>On social life.</p><blockquote class='alert'>Quoted.</blockquote></main>"
            f"<div class=reply>{joined(a)}</div><p>Copyright 2024 Some Firm, all rights reserved</p></body>")
    assert html.main_text(page).split("\n") == [*a, "On social life.", "Quoted."]


def plain_main_text(page):
    """The method told recursively over the same tree, for pages without named boxes."""
    root = html.parse(page)

    def inner(node):
        return [p for p in node.parts if not isinstance(p, str) and not p.beside]

    def chars(node):
        return sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str)) + sum(map(chars, inner(node)))

    def tags(node):
        return sum(1 + tags(c) for c in inner(node))

    def links(node, linked=False):
        linked = linked or node.tag == "a"
        if linked:
            return chars(node), tags(node)
        below = [(links(c), c.tag == "a") for c in inner(node)]
        return sum(b[0] for b, _ in below), sum(b[1] + is_link for b, is_link in below)

    def every(node):
        return [node] + [n for c in inner(node) for n in every(c)]

    body = next((n for n in every(root) if n.tag == "body"), root)
    ratio = links(body)[0] / max(chars(body), 1)

    def own(node):
        return html.density(chars(node), tags(node), *links(node), ratio)

    def without_links(node):
        return html.density(chars(node), tags(node), 0, 0, 0.0)

    core = max(every(body), key=lambda n: sum(map(own, inner(n))))
    path = []
    node = core
    while node is not body:
        path.append(node)
        node = node.parent
    path.append(body)
    least = min(map(own, path))
    lines = []

    def tell(node, whole):
        if whole or node is core:
            lines.extend(t for t in (" ".join(x.split()) for x in flat(node)) if t)
            return
        if node not in path and (own(node) >= least or own(node) >= 0.12 * without_links(node)) and own(node) > 0:
            tell(node, True)
            return
        for child in inner(node):
            tell(child, False)

    def flat(node):
        texts = [p for p in node.parts if isinstance(p, str)]
        return ["".join(texts)] if not inner(node) else [
            t for p in node.parts for t in ([p] if isinstance(p, str) else flat(p))]

    tell(body, False)
    return "\n".join(lines)


def made_page(rng):
    """A tree of boxes whose leaves are paragraphs, or list items that hold nothing but a link."""
    def box(depth):
        if depth == 0 or rng.random() < 0.3:
            if rng.random() < 0.4:
                return "<ul>" + "".join(f"<li><a>link {rng.randrange(99)}</a></li>" for _ in range(rng.randint(1, 9))) + "</ul>"
            return joined(paragraphs("p", rng.randint(1, 4), rng.choice([30, 100, 400])))
        return "<div>" + "".join(box(depth - 1) for _ in range(rng.randint(1, 3))) + "</div>"
    return "<body>" + box(3) + box(2) + "</body>"


def test_main_text_equals_the_plain_method():
    rng = random.Random(8)
    for _ in range(300):
        page = made_page(rng)
        if "<p>" in page:
            assert html.main_text(page) == plain_main_text(page), page


def test_densities_decide(monkeypatch):
    rng = random.Random(9)
    pages = [p for p in (made_page(rng) for _ in range(100)) if "<p>" in p]
    before = [html.main_text(p) for p in pages]
    measured = html.density
    for scrambled in (lambda *a: 1000 / (1 + measured(*a)), lambda c, t, lc, lt, r: 1.0 + hash((c, t, lc, lt)) % 97):
        monkeypatch.setattr(html, "density", scrambled)
        assert sum(a != html.main_text(p) for a, p in zip(before, pages)) > 30


def test_extract_text_takes_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (2, "", "k"), (None, "<p>a&nbsp; b</p>", "k")],
                                 "page_id long, html string, TEXT string")
    found = html.extract_text(rows).collect()
    assert sorted((r.text, r.n_chars) for r in found) == [("", 0), ("", 0), ("", 0), ("a b", 3)]
    assert html.extract_text(rows.where("false")).count() == 0


# -- personal data

def plain_base(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        doubled = sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and doubled % 10 == 0:
            found.append(("card", *m.span()))
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                    if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab.@-1234 5+()%", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert [s[:3] for s in pii.base_spans(text)] == plain_base(text)


def test_personal_data_of_documents(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    model = pii.fit(documents)
    total = 0
    for row in pii.find_personal_data(documents, model, redacted="clean").collect():
        base = [(s.kind, s.start, s.end) for s in row.spans if s.base]
        assert base == plain_base(row.text or "")
        total += len(base)
        if not row.spans:
            assert row.clean == row.text
    assert total > 10


def test_other_shapes_are_found_and_plain_numbers_left():
    texts, spans, labels = pii._invented(seed=12)
    x, y, z = pii._invented(seed=11)
    mixed = np.random.default_rng(0).permutation(len(z))
    model = pii.BoostedTrees().fit(np.array([pii.features(t, s) for t, s in zip(x, y)], float)[mixed], np.array(z)[mixed])
    found = model.probability(np.array([pii.features(t, s) for t, s in zip(texts, spans)], float)) >= pii.THRESHOLD
    truth = np.array(labels, bool)
    assert found[truth].mean() > 0.8 and found[~truth].mean() < 0.03


@pytest.mark.parametrize("text, values", [
    ("7536784127813050 4845168114407329", [("card", 0, 16), ("card", 17, 33)]),
    ("+1 (826) 555-4081 190.137.223.204", [("phone", 0, 17), ("ip", 18, 33)]),
    ("190.137.223.204 (826) 555-4081", [("ip", 0, 15), ("phone", 16, 30)]),
    ("(555) 123-4567 (826) 555-4081", [("phone", 0, 14), ("phone", 15, 29)]),
    ("10.0.0.1 10.0.0.2", [("ip", 0, 8), ("ip", 9, 17)]),
    ("a [at] b.org c (at) d.org", [("email", 0, 12), ("email", 13, 25)]),
])
def test_values_side_by_side_are_found(spark, text, values):
    model = pii.fit(no_documents(spark))
    # on their own, and in runs longer than any value
    for before in ("", "1 " * 40, "12-34 " * 20):
        spans = {s[:3] for s in pii.proposed_spans(before + text)}
        assert {(k, a + len(before), b + len(before)) for k, a, b in values} <= spans
    found = {s[:3] for s in pii.choose(f"see {text} there", model, pii.THRESHOLD)}
    assert found == {(k, a + 4, b + 4) for k, a, b in values}


@pytest.mark.parametrize("shape, kind", [
    (lambda k: f"({200 + k % 700}) {100 + k % 900}-{1000 + k}", "phone"),
    (lambda k: f"n{chr(97 + k % 26)} [at] host.org", "email"),
])
def test_common_shapes_without_a_rule_are_found(spark, shape, kind):
    rows = [(k, f"You may reach us at {shape(k)} any day. Or 10.0.0.{k % 256}, of 2024-01-{1 + k % 28:02}.") for k in range(4000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_personal_data(documents, pii.fit(documents)).collect()
    right = sum((kind, shape(r.doc_id)) in {(s.kind, r.text[s.start:s.end]) for s in r.spans} for r in found)
    assert right >= 0.95 * len(found)
    assert all(s.base or s.kind == kind for r in found for s in r.spans)


@pytest.mark.parametrize("kind, body, answer", [
    ("card", "4845168114407320", False), ("card", "4845168114407329", None), ("ip", "300.1.2.3", False),
    ("ip", "1.2.3.4.5", False), ("ip", "1.2.3.4", None), ("phone", "2024-01-05", False), ("phone", "31.12.1999 12", False),
    ("phone", "12:30:15.250", False), ("phone", "1,234,567", False), ("phone", "10.0.19041.1234", False),
    ("phone", "10.20.30.40", False), ("phone", "555.123.4567", None), ("phone", "01.23.45.67.89", None),
    ("phone", "(555) 123-4567", None), ("phone", "123456", False), ("email", "a [at] b.org", None),
])
def test_rules_disprove_only_what_they_know(kind, body, answer):
    assert pii.ruled(body, pii.Span(kind, 0, len(body), False)) is answer


def test_the_sample_of_spans_is_no_prefix(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "FIT_SPANS", 200)
    monkeypatch.setattr(pii, "_invented", lambda: ([], [], []))
    monkeypatch.setattr(pii.BoostedTrees, "fit", lambda model, x, y: seen.append((x, y)) or model)
    # one long document of wrong cards, then many short ones of addresses; also under no id
    long = "card 4845168114407320, " * 2000
    rows = [(0, long)] + [(k if k % 2 else None, f"at 10.0.{k % 256}.{k // 256}") for k in range(1, 2001)]
    for parts in (1, 3):
        documents = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).repartition(parts)
        pii.fit(documents)
    (x, y), (other, _) = seen
    assert len(y) == 200 and 0.2 < y.mean() < 0.8
    assert sorted(map(tuple, x)) == sorted(map(tuple, other))


def test_proposals_are_linear_in_long_runs():
    for unit in ("1 ", "12 ", "0123 ", "1.2.", "4845168114407329 ", "+1 "):
        assert len(pii.proposed_spans(unit * 2000)) <= 6 * 2000


def test_choosing_is_linear_in_the_spans(spark):
    import time
    model = pii.fit(spark.createDataFrame([(1, "no number")], "doc_id long, text string"))
    seconds = []
    for n in (25_000, 100_000):
        text = " ".join(f"+1 ({200 + k % 700}) 555-{k % 10_000:04d}" for k in range(n))
        begin = time.perf_counter()
        found = pii.choose(text, model, {**dict.fromkeys(pii.KINDS, 0.5), "email": 0.9})
        seconds.append(time.perf_counter() - begin)
        assert len(found) >= n
    assert seconds[1] < 8 * seconds[0]


def test_chosen_spans_do_not_overlap():
    class Answers:
        def probability(self, x):
            return np.random.default_rng(len(x)).random(len(x))

    text = "call +1 (555) 123-4567 5555 4444 3333 2222 1.2.3.4 190.137.223.204 +49 30 1234 5678 4111111111111111 12 34 " * 5
    found = pii.choose(text, Answers(), 0.1)
    base = [s for s in found if s[3]]
    for one in found:
        if not one[3]:
            assert all(o is one or o[2] <= one[1] or o[1] >= one[2] for o in found)
    spans = pii.proposed_spans(text)
    scores = Answers().probability(np.zeros(len(spans)))
    taken = [(s[1], s[2]) for s in base]
    for p, s in sorted(((p, s) for p, s in zip(scores, spans) if not s.base and p >= 0.1), key=lambda x: (-x[0], x[1])):
        if all(b <= s.start or a >= s.end for a, b in taken):
            taken.append((s.start, s.end))
    assert sorted(taken) == sorted((s[1], s[2]) for s in found)


def test_personal_data_takes_odd_rows(spark):
    odd = odd_documents(spark)
    model = pii.fit(odd.select("doc_id", "text"))
    found = pii.find_personal_data(odd, model, redacted="clean").collect()
    assert len(found) == 10 and all(r.spans == [] and r.clean == r.text for r in found)
    assert pii.find_personal_data(no_documents(spark), model).count() == 0
    pii.fit(no_documents(spark))
    assert pii.redact("call +49 (030) 123-4567 or a@b.de", pii.base_spans("call +49 (030) 123-4567 or a@b.de")) == "call [PHONE] or [EMAIL]"


def test_rows_of_one_id_are_packed_in_many_tasks(spark):
    rows = spark.createDataFrame([(7, f"A text of number {k}.") for k in range(2000)], "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = packing.pack(rows, BYTES).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.sequence_id >> 32 for r in found}) == 4
    assert sum(r.start == 0 for r in found) == 2000


@pytest.mark.parametrize("text, spaces", [
    ("One. Two, grün!\nThree? 4 😀 five. " * 50, "single"), ("One.  Two, grün!\n\nThree? 4 😀\x1c\x85 five. " * 50, "fast")])
def test_a_text_is_encoded_in_one_call_and_cut_at_its_sentences(text, spaces):
    tokens, calls = packing.Tokens(packing._definition(BYTES)), []
    encode = getattr(tokens, spaces)
    begin, ids, cuts = 0, [], []
    for end in [*(m.end() for m in packing.SENTENCE_END.finditer(text)), len(text)]:
        ids += tokens._slow(text[begin:end])
        cuts.append(len(ids))
        begin = end
    setattr(tokens, spaces, lambda t: calls.append(t) or encode(t))
    found, places = tokens.encode(text)
    assert calls == [text] and np.frombuffer(found, "<u4").tolist() == ids and places == cuts and len(cuts) >= 100


def test_digests_of_the_packing_query(spark):
    from tidemark.llm.queries import QUERIES
    row = QUERIES["op2_packing"](spark, SMALL).where("doc_id = 0 and start = 0").first()
    full = packing.pack(spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id = 0"), BYTES).orderBy("start").collect()
    ids = b"".join(r.ids for r in full)[:4 * row.length]
    assert row.ids_crc32 == zlib.crc32(ids)
