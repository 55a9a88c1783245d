"""HTML extraction, BPE, packing and chats against brute force and exact round trips."""

from __future__ import annotations

import array
import base64
import copy
import hashlib
import json
import random
import tracemalloc
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronofeat.llm import bpe, packing, units
from chronofeat.llm.chat import (
    escape,
    escape_role,
    format_chats,
    in_order,
    read_back,
    unescape,
)
from chronofeat.llm.html import extract_text, main_text
from chronofeat.llm.packing import Plan, cut_pieces, pack, pack_documents, token_pieces

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  b", "\n a\t ", "don't WE'LL", "é世界 12", "\x1c x", "a" * 5000, " " * 3000]
DOCS = "doc_id long, text string, ids string, piece string, decoded string"


def docs_of(spark, texts):
    rows = [(k, t, "x", "y", "z") for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "null id", "x", "y", "z"), rows[-1]], DOCS)


ARTICLE = "A paragraph that is long enough to make the distribution of line lengths surge. " * 2


def test_parts_around_the_article_go():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head>
    <body class="menu-open"><header>Site</header><nav><ul><li><a href=/>Home</a></ul></nav>
    <div id=cookie-notice>{ARTICLE}</div><script>var t="</p>";</script><!-- {ARTICLE} -->
    <div><h2>1 &lt; 2</h2><p>{ARTICLE}<div class="ad-slot">Buy</div><p>Short&nbsp;
    <b>bo</b>ld.</p><form>{ARTICLE}<input></form></div>
    <section id="comments"><p>{ARTICLE}</p></section>
    <aside><p>{ARTICLE}</p></aside><footer>&copy;</footer></body></html>"""
    assert main_text(page) == f"1 < 2 {ARTICLE.strip()} Short bold."


def test_a_marked_article_is_whole():
    page = f"<div>{ARTICLE}</div><article><h1>T</h1>x<br>y<p class=share>no</p><p>z</article>{ARTICLE}"
    assert main_text(page) == "T x y z"


@pytest.mark.parametrize(
    "attributes",
    [
        'class="overflow-hidden"', 'style="overflow:hidden"', 'aria-hidden="false"',
        'data-id="related"', 'class="post comments-open"', 'class="content with-sidebar"',
        'id="search-methods"', 'class="layout has-sidebar"',
    ],
)
@pytest.mark.parametrize("name", ["article", "main", "div", "section"])
def test_names_and_states_that_do_not_frame(name, attributes):
    assert main_text(f"<{name} {attributes}><p>{ARTICLE}</{name}>") == ARTICLE.strip()


def test_article_cards_beside_a_story():
    card = "<article class=card><h3><a href=/x>Title</a></h3><p>A teaser.</p></article>"
    story = f"<div id=content><p>{ARTICLE}<p>Short.<p>{ARTICLE}</div>"
    assert main_text(card + story + card * 3) == f"{ARTICLE.strip()} Short. {ARTICLE.strip()}"
    assert main_text(card * 2) == "Title A teaser. Title A teaser."
    assert main_text(f"{card}{story}<article>{ARTICLE * 5}<p>x</article>").endswith(" x")


def test_text_outside_the_main_part_can_surge():
    long = (ARTICLE * 2).strip()
    assert main_text(f"<main>x</main><div>no</div><div><p>{long}</div>") == f"x {long}"


def test_pages_without_a_main_part():
    page = f"<div><a href=/x>{ARTICLE}</a></div><div></div><div><h2>T</h2><p>{ARTICLE}<p>x</div>"
    assert main_text(f"{page}<div></div><div></div><div>end</div>") == f"T {ARTICLE.strip()} x"


STORY = ARTICLE.strip()
SHORT = "Short story of the day."
TWO = "Two sentences stand in this part. They are as long as those of a text, so they would surge. "


@pytest.mark.parametrize(
    "name",
    """site-footer site-header page-header main-nav primary-sidebar sidebar-primary sidebar2
    related-posts related-articles user-comments post-comments reader-comments comment-1 ad-728x90
    ad-slot-1 sticky-ad advertisement-label site-notice privacy-notice share-this author-bio
    cookieBanner newsletter-signup-box nav_menu_2 commentList adSlot footer-widgets mobile-menu
    search-form promo-banner-300x250 cookie-consent-popup post-footer aboutAuthor""".split(),
)
@pytest.mark.parametrize("inside", [False, True])
def test_compound_names_of_frames(name, inside):
    part = f'<div class="x1 {name}"><p>{TWO}</p></div>'
    story = f"<p>{ARTICLE}</p>"
    page = f"<article>{story}{part}</article>" if inside else f"<div id=c>{story}</div>{part}"
    if inside and name in ("site-header", "page-header"):
        assert main_text(page).startswith(STORY)  # a header in the main part belongs to it
    else:
        assert main_text(page) == STORY
    assert main_text(f"<section id={name}>{TWO}</section><div>{story}</div>") == STORY


@pytest.mark.parametrize(
    "name",
    """post-header entry-header article-banner related-work search-methods comments-open has-sidebar
    no-footer overflow-hidden content-header adapter headers-up menuless main-content article-body
    post-text news-story author notices-of-the-king cookies-recipe navigator shared-story""".split(),
)
def test_names_of_texts(name):
    assert main_text(f"<div class={name}><p>{ARTICLE}</div><p>x") == f"{STORY} x"


PAGES = {
    "a notice beside a short story": (
        f"<div id=c><p>{SHORT}</p></div><div class='cookie-notice'><p>{TWO}</p></div>", SHORT),
    "a notice before a short story": (
        f"<div class='gdpr consent'>{TWO}</div><div><h1>T</h1><p>{SHORT}</div>", f"T {SHORT}"),
    "a sidebar beside a short story": (
        f"<div><p>{SHORT}</div><div class=sidebar><p>{TWO}</div>", SHORT),
    "comments under a short story": (
        f"<p>{SHORT}</p><section id=comments><p>{TWO}<p>{TWO}</section>", SHORT),
    "only a notice": (f"<div class=notice>{TWO}</div>", ""),
    "only a footer": (f"<footer>{TWO}</footer>", ""),
    "only comments": (f"<ol class=comment-list><li>{TWO}</ol>", ""),
    "the story beside a named sidebar": (
        f"<div class='content sidebar-right'><p>{ARTICLE}</div><div>Home</div>", f"{STORY} Home"),
    "layout words on the body": (f"<body class='header-fixed sidebar-left'><p>{ARTICLE}", STORY),
    "comments inside the article": (
        f"<article><h1>T</h1><p>{ARTICLE}<div class=user-comments><p>{TWO}</div></article>", f"T {STORY}"),
    "an advert inside the article": (
        f"<article><p>{ARTICLE}<div class=ad-728x90><p>{TWO}</div><p>End.</article>", f"{STORY} End."),
    "a form inside the article": (
        f"<article><p>{ARTICLE}<form>{TWO}<input value=x></form><p>End.</article>", f"{STORY} End."),
    "a share bar between paragraphs": (
        f"<div><p>{ARTICLE}<div id=share-this>Share!</div><p>{ARTICLE}</div>", f"{STORY} {STORY}"),
    "a table of contents by links": (
        f"<div><ul>{'<li><a href=#x>A section with a long title</a>' * 9}</ul></div><div></div><div><p>{ARTICLE}</div>", STORY),
    "a heading in a page header": (
        f"<div class=page-header><h1>Site</h1></div><div><h2>T</h2><p>{ARTICLE}</div>", f"T {STORY}"),
    "an article's own header": (f"<article><header><h1>T</h1></header><p>{ARTICLE}</article>", f"T {STORY}"),
    "a table": (f"<table><tr><td>{ARTICLE}<td>b</table>", f"{STORY} b"),
    "a list": (f"<div><p>{ARTICLE}<ul><li>one<li>two &amp; a half</ul></div>", f"{STORY} one two & a half"),
    "preformatted lines": (f"<div><p>{ARTICLE}<pre>a\n  b</pre></div>", f"{STORY} a b"),
    "words cut by inline elements": (f"<p>{ARTICLE}un<b>believ</b>able<br>next", f"{STORY} unbelievable next"),
    "hidden parts": (f"<p>{ARTICLE}</p><div hidden>{TWO}</div><div aria-hidden=true>{TWO}</div>", STORY),
    "upper case": (f"<DIV CLASS='Site-Footer'>{TWO}</DIV><P>{ARTICLE}", STORY),
    "a modal over the page": (f"<div role=dialog class=modal><p>{TWO}</div><main><p>{SHORT}</main>", SHORT),
    "no markup": (f"{SHORT}", SHORT),
}


@pytest.mark.parametrize("kind", PAGES)
def test_pages_of_different_make_up(kind):
    page, text = PAGES[kind]
    assert main_text(page) == text


@pytest.mark.parametrize("name", "video object svg canvas noscript template audio map math".split())
def test_unclosed_skipped_elements_end_with_their_parent_or_at_a_block(name):
    assert main_text(f"<article><p>x<{name} id=v>no<g>no</g></p>y</article>") == "x y"
    assert main_text(f"<article>x<{name}>no<p>y<p>z</article>") == "x y z"
    assert main_text(f"<article>x<{name}>no</{name}>y<textarea>no<p>no</article>") == "x y"


def test_headings_links_and_wrappers_of_the_text_stay():
    inside = '<h2 id="related-work">R</h2><h2 id=related>S</h2>x <a href="/hidden-valley">y</a>'
    inside += ' <span class="alert">z</span><p hidden>no</p><p style="color:red;display: none">no</p>'
    assert main_text(f"<article>{inside}</article>") == "R S x y z"
    page = f"<div class=sidebar><h1>T</h1><p>{ARTICLE}</div><div class=comments>{ARTICLE}</div>"
    assert main_text(page) == f"T {ARTICLE.strip()}"
    assert main_text(f'<div class="page sidebar"><p>{ARTICLE}</div><p>x') == f"{ARTICLE.strip()} x"


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain", "plain"),
        ("a < b &am", "a < b &am"),
        ("<article><p>cut &amp; of", "cut & of"),
        ("<article><p>cut</", "cut"),
        ("<article><p>x</p><scri", "x"),
        ("<nav>only a menu</nav>", ""),
        ("<div class=ad><article>never closed</article>", "never closed"),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page", ["<div>" * 50_000 + "x", "<" * 100_000, '<a "' * 30_000, "<option>" * 30_000 + "</p>" * 30_000]
)
def test_hostile_pages_end(page):
    main_text(page)


def test_pages_as_rows(spark):
    rows = [(1, "u", None, "t"), (None, None, "<p>x", "t"), (1, "u", None, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract_text(pages).collect()), key=repr)
    assert got == [(1, "u", "", 0), (1, "u", "", 0), (None, None, "x", 1)]
    assert extract_text(pages.limit(0)).count() == 0


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab c\n\t'sé世1.\x1c ſ", max_size=40))
def test_ids_are_the_librarys(library, text):
    codec = bpe.Codec.open(RANKS, public_tokenizers.PATTERN)
    ids = array.array("I", codec.encode([text])[0]).tolist()
    assert ids == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_both_forms_of_the_tree_agree():
    codec = bpe.Codec.open(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(1)
    pieces = [bytes(rng.choice(b"abcdefghij th") for _ in range(rng.randint(2, 32))) for _ in range(500)]
    block = bpe.encode_block(pieces, 32, codec.byte_ids, codec.join)
    for piece, code in zip(pieces, block, strict=True):
        if piece not in codec.ranks:
            assert array.array("I", code).tolist() == bpe.encode_piece(piece, codec.ranks)


def test_bpe_on_odd_rows(spark, library):
    docs = docs_of(spark, [*ODD, None, "word " * 60_000])
    encoded = bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN)
    got = bpe.decode_ids(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    for row in docs.collect():
        assert by_id[row.doc_id].ids == library.encode_ordinary(row.text or "")
        assert bytes(by_id[row.doc_id].decoded) == (row.text or "").encode()


@pytest.mark.parametrize("total", [1, 9, 10, 11, 20, 35])
def test_only_the_first_piece_is_short(total):
    pieces = list(cut_pieces(total, 10))
    assert [s for s, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
    assert sum(n for _, n in pieces) == total and all(n == 10 for _, n in pieces[1:])


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=32))
def test_plans_place_all_without_overlap(counts):
    plan = Plan(counts, 32).run()
    filled, seen = defaultdict(list), defaultdict(list)
    for size, first, n, sequence, offset in plan.placed:
        for k in range(n):
            seen[size].append(first + k)
            filled[sequence + k].append((offset, size))
    assert {s: sorted(r) for s, r in seen.items()} == {s: list(range(n)) for s, n in counts.items()}
    for parts in filled.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 32
    tokens = sum(s * n for s, n in counts.items())
    large = sum(n for s, n in counts.items() if s > 16)
    assert len(filled) == plan.sequences <= 1.5 * max(large, -(-tokens // 32)) + 1


def test_packed_documents(spark):
    texts = [*ODD, None, *["some words of text " * k for k in range(1, 400, 7)]]
    docs = docs_of(spark, texts)
    got = pack_documents(docs, JSON, 64).collect()
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    sequences = defaultdict(list)
    wanted, found = defaultdict(int), defaultdict(int)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    for row in docs.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 2]
        for piece, (at, n) in enumerate(cut_pieces(len(ids), 64)):
            crc = zlib.crc32(array.array("I", ids[at : at + n]).tobytes())
            wanted[row.doc_id, piece, at, n, crc] += 1
    assert found == wanted
    for parts in sequences.values():
        ends = [0, *[o + n for o, n in sorted(parts)]]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 64
    tokens = sum(r.length for r in got)
    assert len(sequences) <= 1.03 * -(-tokens // 64) + 1
    assert pack(token_pieces(docs.limit(0), JSON, 64), 64).count() == 0


STRANGE = "aäbß1２ \n\t\r\x85\u2028.,'sé日本अ़ा̀😀<|endoftext|>tldvemr`~\x1c"


def library_ids():
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    return lambda text: library.encode(text, add_special_tokens=False).ids


def test_packed_ids_are_the_librarys():
    """The file's own library on strange texts, its special string and runs of white space."""
    rng, wanted, found = random.Random(2), library_ids(), packing.Tokenizer.open(JSON)
    texts = ["".join(rng.choice(STRANGE) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a <|endoftext|> b", "ab" * 50_000, "x" + " " * 30_000 + "y"]
    texts += ["word " * 20_000, "\n" * 400_000, "\u2003" * 9_999 + "x", " \n" * 60_000 + "z"]
    for text in texts:
        assert found.ids(text).tolist() == wanted(text)


def test_files_of_another_kind_are_refused(tmp_path):
    with open(JSON, encoding="utf-8") as lines:
        read = json.load(lines)
    for change in (
        lambda r: r["model"]["merges"].reverse(),
        lambda r: r.update(normalizer={"type": "Lowercase"}),
        lambda r: r["pre_tokenizer"].update(add_prefix_space=True),
    ):
        other = copy.deepcopy(read)
        change(other)
        path = tmp_path / "other.json"
        path.write_text(json.dumps(other))
        with pytest.raises(ValueError, match="byte-level|order than merges"):
            packing.read_byte_level(str(path))


def test_units_of_letters_skip_the_pattern_and_nothing_else(library):
    rng, codec = random.Random(3), bpe.Codec.open(RANKS, public_tokenizers.PATTERN)
    texts = ["".join(rng.choice(STRANGE) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    codes = codec.encode(texts)
    for text, code in zip(texts, codes, strict=True):
        assert array.array("I", code).tolist() == library.encode_ordinary(text)
    digits = bpe.Codec(RANKS, r"\p{L}{1,2}|[^\p{L}]")  # letters are no match of their own here
    cut = tiktoken.Encoding("o", pat_str=r"\p{L}{1,2}|[^\p{L}]", mergeable_ranks=digits.ranks, special_tokens={})
    for text, code in zip(texts, digits.encode(texts), strict=True):
        assert array.array("I", code).tolist() == cut.encode_ordinary(text)


def test_a_long_unbroken_text(library):
    """One match of the pattern, in memory of a fixed number of bytes for each of its bytes."""
    rng = random.Random(8)
    text = "".join(rng.choice("abcdeé") for _ in range(50_000))
    codec = bpe.Codec.open(RANKS, public_tokenizers.PATTERN)
    tracemalloc.start()
    (code,) = codec.encode([text])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert array.array("I", code).tolist() == library.encode_ordinary(text)
    assert peak < 100 * len(text.encode())


def test_slices_are_cut_by_rows_and_by_bytes():
    texts = ["x" * n for n in (0, 5, 30, 4, 4, 4, 100, 0, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts)], ["id", "text"])
    parts = [p.column(0).to_pylist() for p in units.slices(batch, rows=4, most=12)]
    assert sum(parts, []) == list(range(10))
    assert parts == [[0, 1], [2], [3, 4, 5], [6], [7, 8, 9]]
    lists = pa.array([[1] * 20, None, [], [2]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), lists], ["id", "ids"])
    assert [p.num_rows for p in units.slices(batch, most=10)] == [1, 3]


def test_decoding_in_one_pass_equals_decoding_ids(spark):
    docs = docs_of(spark, [*ODD, None])
    one = bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN, with_decoded=True)
    two = bpe.decode_ids(bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    rows = lambda df: sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in df.collect()), key=repr)
    assert rows(one) == rows(two)
    assert bpe.encode_texts(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\<|>ax\n"))
def test_escapes_are_reversible(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    assert unescape(escape_role(text)) == text


def test_chats_read_back(spark):
    odd = "\\### <|end|>\n <\\|user|> \\\\ <"
    rows = [
        (1, 0, "user", odd),
        (1, 1, "assistant", odd),
        (1, 2, "user", None),
        (1, 3, "assistant", "é"),
        (2, 0, "assistant", "out of turn"),
        (2, None, None, "no turn"),
        (3, 0, "a|>\n<|b", "odd role"),
        (None, 0, "user", "x" * 200_000),
        (None, 0, "user", "tie"),
    ]
    chats = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    chats = chats.selectExpr("*", "'x' as segment", "true as loss")
    got = {r.conv_id: r for r in read_back(format_chats(chats)).collect()}
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(turns)
    for conv, own in turns.items():
        own = [(role, text) for _, _, role, text in sorted(own)]
        loss = "".join(text for role, text in own if role == "assistant")
        plain = "".join(f"{role}\n{text}\n" for role, text in own)
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(plain.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, None: False}
    assert read_back(format_chats(chats.limit(0))).count() == 0


def test_segments_of_a_turn(spark):
    chats = spark.createDataFrame(
        [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")],
        "conv_id long, turn int, role string, text string",
    )
    got = [(r.text, r.loss) for r in format_chats(chats).collect()]
    assert got == [
        ("<|user|>\n", False),
        ("hi", False),
        ("<|end|>\n", False),
        ("<|assistant|>\n", False),
        ("yo", True),
        ("<|end|>\n", False),
    ]


def test_segments_in_another_order_are_refused_and_can_be_restored(spark):
    rows = [(k % 7, k, ["user", "assistant"][k // 7 % 2], f"text {k}") for k in range(70)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments = format_chats(chats)
    straight = sorted(map(tuple, read_back(segments).collect()))
    mixed = segments.repartition(5)
    with pytest.raises(Exception, match="not in order"):
        read_back(mixed).collect()
    assert sorted(map(tuple, read_back(in_order(mixed)).collect())) == straight
    assert {r.complete for r in read_back(segments).collect()} == {True}
    one = read_back(format_chats(chats.where("turn < 7"))).collect()
    assert {(r.valid, r.complete) for r in one} == {(True, False)}
