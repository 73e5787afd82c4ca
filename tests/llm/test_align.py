"""Token alignment against brute force over byte offsets."""

import bisect
import hashlib
from collections import Counter

import numpy as np
import pytest

from corate.llm.align import Block, Vocabularies, align_tokens, byte_level_alphabet, read_vocabularies, terminals
from corate.llm.queries import QUERIES, TOKENIZERS

FILES = read_vocabularies(TOKENIZERS)
NONE = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def vocabularies():
    return Vocabularies(*FILES)


def ends(side, ids):
    return np.cumsum([len(side.bytes[i]) for i in ids]).tolist()


def brute(vocabularies, texts):
    """Each text encoded as a whole, cut where both sides end; links counted over all texts."""
    a, b, found, count = vocabularies.a, vocabularies.b, [], Counter()
    for text in texts:
        (x, y), = vocabularies.encode([text or ""])
        want = (" " + (text or "")).encode()
        if not text or a.joined(x) != want or b.joined(y) != want:
            found.append(None)
            continue
        at_a, at_b = ends(a, x), ends(b, y)
        links, groups, low = [], [], 0
        for cut in sorted(set(at_a) & set(at_b)):
            i, j = bisect.bisect(at_a, cut), bisect.bisect(at_b, cut)
            mine, theirs = x[bisect.bisect(at_a, low) : i], y[bisect.bisect(at_b, low) : j]
            groups.append(",".join(map(str, mine)) + "|" + ",".join(map(str, theirs)))
            links.append((x[i - 1], y[j - 1]))
            low = cut
        count.update(links)
        found.append((len(x), len(y), links, groups))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for f in found:
        if f is None:
            out.append(NONE)
            continue
        n_a, n_b, links, groups = f
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((n_a, n_b, len(groups), len(links), sum(count[k] == best[k[1]] for k in links), sum(count[k] for k in links), digest))
    return out


ODD = [
    None, "", " ", "   ", "\n", "a", " a", "a ", "a  b", "a \n b", "don't stop", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ piece", "x▁y and words",
    " nbsp    ", "naïve façade Übung", "日本語 テキスト と words", "🙂🙃 a🙂b", "é combining", "\x00 nul \x1c sep", "﻿bom", "ａｂｃ ﬁ ligature",
    "a" * 3000, "ab " * 2000, "\t\ttabs\tand\r\nlines\r\n", "1234567890 12 345", "½ ² Ⅷ", "https://example.com/a?b=c&d=e#f",
]


def run(spark, rows, **options):
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in align_tokens(table, FILES, **options).collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_odd_texts_equal_brute_force(spark, vocabularies):
    rows = list(enumerate(ODD))
    want = [(i, *r) for i, r in enumerate(brute(vocabularies, ODD))]
    assert run(spark, rows) == want
    assert run(spark, rows, block_bytes=200) == want  # counts are of all blocks
    assert sum(w[1:] == NONE for w in want) < 8


def test_query_equals_brute_force(spark, vocabularies):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d["doc_id"], *r) for d, r in zip(docs, brute(vocabularies, [d["text"] for d in docs]), strict=True))
    got = QUERIES["op11_token_alignment"](spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_units_give_the_tokens_of_the_whole_text(vocabularies):
    assert vocabularies.by_units
    for text in filter(None, ODD):
        (x, y), = vocabularies.encode([text])
        parts = list(vocabularies.encode(vocabularies.units(text)))
        assert [t for p in parts for t in p[0]] == x
        assert [t for p in parts for t in p[1]] == y


def test_vocabulary_that_is_not_cut(vocabularies):
    import pyarrow as pa

    whole = Vocabularies(*FILES)
    whole.by_units = False
    texts = [t.encode() for t in ODD if t]
    blocks = [Block(v) for v in (vocabularies, whole)]
    for block in blocks:
        block.add(pa.array(range(len(texts))), texts, 0)
    kinds = pa.schema(
        [("block", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("s", pa.string())]
        + [("codes", pa.list_(pa.int32()))]
        + [(c, pa.list_(pa.int64())) for c in ("times", "pairs", "counts")]
    )
    one, other = (b.batch(0, kinds) for b in blocks)
    assert one.equals(other)


def test_repeated_rows_null_ids_and_extra_columns(spark, vocabularies):
    texts = ["one two", "one two", None, "one two three"]
    names = ["id", "block", "codes", "times", "pairs", "n_a", "count_sum", "code"]
    rows = [(i, t, *[5] * len(names)) for i, t in zip([1, 1, None, None], texts, strict=True)]
    table = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    got = sorted((tuple(r) for r in align_tokens(table, FILES).collect()), key=repr)
    assert got == sorted(((i, *r) for i, r in zip([1, 1, None, None], brute(vocabularies, texts), strict=True)), key=repr)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_invalid_utf8_has_no_tokens(vocabularies):
    block = Block(vocabularies)
    import pyarrow as pa

    block.add(pa.array([1, 2]), [b"bad \xff byte", b"good"], 0)
    assert [len(d) for d in block.docs] == [0, 1]


def test_pointers_end_at_the_first_common_end():
    rng = np.random.default_rng(3)
    for _ in range(50):
        size = int(rng.integers(1, 60))
        cuts = [np.append(np.flatnonzero(rng.random(size - 1) < 0.4) + 1, size) for _ in range(2)]
        common = np.intersect1d(*cuts)
        to_a, to_b = terminals(*cuts)
        for side, to in zip(cuts, (to_a, to_b), strict=True):
            assert cuts[0][to].tolist() == [common[np.searchsorted(common, e)] for e in side]


def test_alphabet_is_one_to_one():
    assert sorted(byte_level_alphabet().values()) == list(range(256))
