"""HTML extraction and decontamination."""

import random
import re

import numpy as np
import pytest

from corate.llm import decontaminate as deco
from corate.llm.decontaminate import (
    GramIndex, banded_distance, decontaminate, find_contamination, find_pieces, find_regions, find_short, normalise, shorten_repeats,
)
from corate.llm.html_text import extract_main_text, main_text

LONG = "A paragraph of the article with so many words that its text surges over any threshold at all, surely."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        (f"<nav><a href=x>Home</a></nav><article><h1>T</h1><p>a <b>b</b>\n c<br>d</p><p>{LONG}</article><footer>&copy;", f"T\n\na b c d\n\n{LONG}"),
        (f"<script>var a = '<p>no</p>';</script><style>p {{}}</style><p>{LONG}<!-- <p>no</p> --></p>", LONG),
        (f"<div class='ad'>buy</div><article><p>x</p><div class=advert><p>buy</p></div><p>y</p></article>", "x\n\ny"),
        (f"<main><p>{LONG}</p><section id='comments'><p>reader</p></section><form>mail <input></form></main>", LONG),
        (f"<header><h1>Site</h1></header><div><h1>Title</h1><p>{LONG}</p><p>Short.</p></div><aside>side</aside>", f"Title\n\n{LONG}\n\nShort."),
        (f"<ul>{'<li><a href=x>some link text here</a>' * 9}</ul><p>{LONG}</p><ul>{'<li><a href=x>another link</a>' * 5}</ul>", LONG),
        ("<article>1 < 2 &lt; 3 &#233; &am</article>", "1 < 2 < 3 é &am"),
        ("<article><p>a<div hidden>no</div><p role='navigation'>no<p>b", "a\n\nb"),
        ("<p>un<i>brok</i>en</p>", "unbroken"),
        ("<article><p title=don't>x</p><p>it's</p></article>", "x\n\nit's"),
        ("<article><p>x</p></article>" + "<a" * 50000, "x"),
        ("<a" * 50000, "<a" * 50000),
        (f"<div class='content with-sidebar'><article><p>{LONG}</p></article><div class=sidebar>no</div></div>", LONG),
        (f"<div class='comments'><article><p>{LONG}</p></article></div><article>own</article>", "own"),
        (f"<a name=top><p>{LONG}</p>", LONG),
        (f"<p><a href=x>Home<p>{LONG}</p>", LONG),
        (f"<article><p>teaser</p></article><div>{f'<p>{LONG}</p>' * 5}</div>", "teaser" + f"\n\n{LONG}" * 5),
        (f"<article><p>short</p></article><div><p>{LONG}</p></div>", "short"),
        ("<p>" + "漢字" * 60 + "</p>", "漢字" * 60),
        ("<article><p title='a > b'>x</p><p title=\"open>y</p></article>", "x\n\ny"),
    ],
)
def test_main_text(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize(
    "unit", ["<![CDATA[", "<script ", "<!--", "<div>", "<a href=x>", "<p title='", "</x>", "<div></x>", "<article>", "<textarea", "&", "<!"]
)
def test_time_grows_with_the_page(unit):
    import time

    for n in (20_000, 80_000):
        start = time.time()
        main_text(f"<p>{LONG}</p>" + unit * n + "end")
        assert time.time() - start < 5


def test_pages_without_their_marks_give_the_same(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    same = [main_text(r.html) == main_text(re.sub(r"</?(article|main)\b[^>]*>", "", r.html or "")) for r in rows]
    assert sum(same) == len(rows) == 250


def test_extraction_on_a_table(spark):
    page = "<article><p>" + "é word " * 50000 + "</p></article>"
    rows = [(1, "u", page, "old"), (2, None, None, "old"), (2, None, None, "old")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main_text(table)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id, len(r.text), r.n_chars) for r in got.collect()) == [(1, 349999, 349999), (2, 0, 0), (2, 0, 0)]
    assert extract_main_text(table.limit(0)).count() == 0


def test_pages_equal_their_articles(spark):
    from corate.llm.queries import op7_html_text

    import html

    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in op7_html_text(spark, "/root/testdata/sf0.001").collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(b for b in blocks if b)


# --- decontamination -------------------------------------------------------


def plain(text):
    return re.sub(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", b" ", text.encode().lower()).strip(b" ")


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_normalise_equals_python():
    rng = random.Random(1)
    texts = ["".join(rng.choice(" .aB\né!9") for _ in range(rng.randint(0, 8))) for _ in range(2000)]
    data, offsets = normalise(*flat(texts))
    assert [bytes(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [plain(t) for t in texts]


def edit_distance(a, b, free):
    """Edits of all of ``a`` against all of ``b``, or its best stretch if ``free``."""
    last = [0] * (len(b) + 1) if free else list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        row = [i]
        for j in range(1, len(b) + 1):
            row.append(min(last[j - 1] + (a[i - 1] != b[j - 1]), last[j] + 1, row[j - 1] + 1))
        last = row
    return min(last) if free else last[-1]


def test_banded_distance_equals_full_alignment():
    rng = random.Random(2)
    for _ in range(400):
        a = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12)))
        b = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14)))
        got = banded_distance(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8), -20, 20, 50)
        assert got[0] == edit_distance(a, b, True) == edit_distance(a, b[got[1] : got[2]], False)


def word(rng):
    return "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))


def altered(rng, text, edits):
    signs = list(text)
    for _ in range(edits):
        k = rng.randrange(len(signs))
        signs[k] = rng.choice(["", rng.choice("xyz"), signs[k] + rng.choice("xyz")])
    return "".join(signs)


def test_every_match_within_the_rate_is_found():
    """Any stretch of 64 signs with at most 3 edits, or a short item with its share, against full alignment."""
    rng = random.Random(3)
    items = [" ".join(word(rng) for _ in range(n)) for n in (9, 12, 20, 40, 80)]
    index = GramIndex.build(list(range(len(items))), items, 12, 0.05, 64, 32, 4)
    texts, wanted = [], []
    for _ in range(300):
        t = rng.randrange(len(items))
        cut = items[t]
        if len(cut) > 80 and rng.random() < 0.5:
            a = rng.randrange(len(cut) - 70)
            cut = cut[a : a + 70]
        edits = rng.randint(0, int(0.05 * min(len(cut), 64)))
        body = altered(rng, cut, edits).replace(" ", rng.choice([" ", "\n", ", "]))
        texts.append(" ".join(word(rng) for _ in range(rng.randint(0, 40))) + " " + body.upper() + " " + " ".join(word(rng) for _ in range(20)))
        # A lost word takes its space along, so the edits count on the normalised text.
        near = edit_distance(plain(cut), plain(body), False) <= int(0.05 * min(len(plain(cut)), 64))
        wanted.append(t if near else None)
    assert sum(t is not None for t in wanted) > 200
    clean = [" ".join(word(rng) for _ in range(200)) for _ in range(100)]
    data, offsets = normalise(*flat(texts + clean))
    found = find_regions(index, data, offsets)
    hits = {(d, t) for d, t, *_ in found}
    assert {(d, t) for d, t in enumerate(wanted) if t is not None} <= hits
    assert {d for d, _ in hits} <= set(range(len(texts)))
    for d, t, begin, end, a, b, edits in found:
        pattern = bytes(index.data[index.offsets[t] : index.offsets[t + 1]])[a:b]
        text = bytes(data[offsets[d] : offsets[d + 1]])[begin:end]
        assert edit_distance(pattern, text, False) == edits <= 0.05 * (b - a)


def test_contamination_edge_cases(spark):
    rng = random.Random(4)
    item = " ".join(word(rng) for _ in range(30))
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (None, item), (4, ""), (5, "short one")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item + "!"), (4, "short one"), (5, "z " * 100000 + item), (6, item[:40])]
    table = spark.createDataFrame([(i, t, "old") for i, t in rows], "doc_id long, text string, matches string")
    for options in ({}, {"block_bytes": 10}):
        got = find_contamination(table, bench, **options)
        assert got.columns == ["doc_id", "text", "matches"]
        found = sorted((str(r.doc_id), sorted({str(m.item) for m in r.matches})) for r in got.collect())
        all_three = ["1", "2", "None"]
        want = [("1", []), ("2", []), ("3", all_three), ("3", all_three), ("None", all_three), ("4", ["5"]), ("5", all_three), ("6", [])]
        assert found == sorted(want)
    assert sorted(r.doc_id for r in decontaminate(table, bench).collect()) == [1, 2, 6]
    assert decontaminate(table, bench.limit(0)).count() == len(rows)
    assert decontaminate(table.limit(0), bench).count() == 0


def index_of(items, **options):
    return GramIndex.build(list(range(len(items))), items, **({"q": 12, "rate": 0.05, "window": 64, "least": 32, "short_words": 4} | options))


def test_short_items_stand_between_words():
    items = ["one two three 4", "just two", "a b c d", "!!", "é"]
    texts = ["so one TWO, three 4 end", "one two three 45", "just two", "not just two", "xa b c d", "a b c d a b c d", "e", "É", "é"]
    data, offsets = deco.plain(*flat(texts))
    found = sorted(m[:4] for m in find_short(index_of(items), data, offsets))
    assert found == [(0, 0, 3, 18), (2, 1, 0, 8), (5, 2, 0, 7), (8, 4, 0, 2)]


def test_an_index_comes_back_from_its_file(tmp_path):
    rng = random.Random(7)
    for items in ([" ".join(word(rng) for _ in range(30)) for _ in range(5)] + ["a b c d e"], ["a b c d e"], []):
        index = index_of(items)
        (tmp_path / "index").write_bytes(index.packed())
        back = GramIndex.mapped(str(tmp_path / "index"))
        data, offsets = deco.plain(*flat([f"x {items[0]} y" if items else "x", "a b c d e"]))
        for find in (find_pieces, find_short):
            assert find(back, data, offsets) == find(index, data, offsets)
        assert back.ids == index.ids


def test_repeated_patterns_are_shortened():
    rng = random.Random(9)
    texts = ["a" * 20000, "ab " * 5000 + "end", "x" * 400, "begin " + "0123456789" * 300 + " end", "ab" * 100 + "ba" * 100, "q" * 513, "q" * 512 + "r"]
    texts += [" ".join(word(rng) for _ in range(300)), "", "q" * 3000]
    data, offsets = shorten_repeats(*normalise(*flat(texts)))
    got = [bytes(data[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    for before, after in zip(texts, got, strict=True):
        assert len(after) <= len(before) and len(after) >= min(len(before), 512)
    assert got[0] == "a" * 512 and got[1].startswith("ab ab ") and got[1].endswith("ab end") and len(got[1]) < 530
    assert got[2] == texts[2] and got[3].endswith("789 end") and len(got[3]) < 540 and got[4] == texts[4]
    assert got[5] == got[9] == "q" * 512 and got[6] == texts[6] and got[7] == texts[7] and got[8] == ""


def test_repetitive_texts_take_little(spark):
    """Positions times positions of one q-gram would be 40 million and more."""
    import resource
    import time

    items = ["a" * 2000, "ab cd " * 400, " ".join(f"w{k}" for k in range(40)) * 30]
    index = index_of(items)
    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    texts = ["a" * 20000, "a" * 100000, "ab cd " * 20000, (" ".join(f"w{k}" for k in range(40)) + " ") * 20, "a" * 1000 + " clean"]
    data, offsets = deco.plain(*flat(texts))
    found = {(m[0], m[1]) for m in find_pieces(index, data, offsets)}
    assert {(0, 0), (1, 0), (2, 1), (3, 2)} <= found
    assert time.time() - start < 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # kB


def test_pieces_find_what_the_whole_text_holds(monkeypatch):
    rng = random.Random(11)
    items = [" ".join(word(rng) for _ in range(n)) for n in (12, 30, 60)]
    index = index_of(items)
    texts = []
    for _ in range(30):
        parts = [" ".join(word(rng) for _ in range(rng.randrange(400))) for _ in range(4)]
        texts.append(" ".join([parts[0], rng.choice(items), parts[1], rng.choice(items)[10:], *parts[2:]]))
    data, offsets = deco.plain(*flat(texts))
    whole = {(m[0], m[1]) for m in find_regions(index, data, offsets)}
    monkeypatch.setattr(deco, "PIECE", 300)
    assert {(m[0], m[1]) for m in find_pieces(index, data, offsets)} == whole
    assert len(whole) >= 30


def test_query_equals_brute_force(spark):
    from corate.llm.queries import op1_decontamination

    sf = "/root/testdata/sf0.001"
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = {r.doc_id: plain(r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op1_decontamination(spark, sf).collect():
        assert r.item_ids == sorted(i for i, t in items if t in docs[r.doc_id])
