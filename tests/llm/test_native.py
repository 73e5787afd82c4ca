"""Exact dedup, line dedup, mixing and the URL filter on small tables."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from corate.llm import url_rules
from corate.llm.exact import exact_dedup, exact_groups
from corate.llm.lines import line_dedup
from corate.llm.mixing import mix_sources, mixed_documents
from corate.llm.queries import URL_RULES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + extra)


# --- exact dedup -----------------------------------------------------------


def brute_exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((i, t or ""))
    out = []
    for i, t in rows:
        own = groups[norm(t)]
        keep = min(own, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))[0]
        out.append((i, keep, len(own), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


EXACT_ROWS = [
    (3, "a b"), (1, "ab"), (2, "a  b"), (9, "a  b"), (4, None), (5, ""), (6, " \t\n"), (None, "zz"), (8, "zz"),
    (7, "é" * 5000 + "x"), (10, "é" * 5000 + " x"), (11, "A b"), (12, "a\u00a0b"), (13, "q"), (13, "q"),
]


@pytest.mark.parametrize("salts", [1, 7])
def test_exact_groups_equal_brute_force(spark, salts):
    got = exact_groups(docs(spark, EXACT_ROWS), salts=salts).withColumn("digest", F.lower(F.hex("digest")))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_exact(EXACT_ROWS)


def test_texts_under_one_digest_are_told_apart(spark):
    got = exact_groups(docs(spark, EXACT_ROWS), digest=lambda t: F.unhex(F.substring(F.sha2(F.length(t).cast("string"), 256), 1, 2)))
    want = [r[:4] for r in brute_exact(EXACT_ROWS)]
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == sorted(want, key=str)


def test_exact_dedup_keeps_rows_and_columns(spark):
    rows = [(i, t, "x") for i, t in EXACT_ROWS]
    got = exact_dedup(docs(spark, rows, ", kept string"))
    assert got.columns == ["doc_id", "text", "kept"]
    kept = {r[0] for r in brute_exact(EXACT_ROWS) if r[3]}
    assert {r.doc_id for r in got.collect()} == kept
    assert exact_dedup(docs(spark, [])).count() == 0


# --- line dedup ------------------------------------------------------------


def brute_lines(rows):
    solid = {i: [(n, x.strip(" \t\n\x0b\x0c\r")) for n, x in enumerate((t or "").split("\n"))] for i, t in rows}
    solid = {i: [x for x in s if x[1]] for i, s in solid.items()}
    first, gone = {}, {i: set() for i in solid}
    kept = {i: set() for i in solid}
    for i in sorted(solid):
        for k in range(max(1, len(solid[i]) - 2) if solid[i] else 0):
            part = solid[i][k : k + 3]
            key, lines = tuple(x[1] for x in part), [x[0] for x in part]
            if key in first:
                gone[i] |= set(lines)
                j, own = first[key]
                if i == j and set(own) & set(range(lines[0], lines[-1] + 1)):
                    kept[i] |= set(own)
            else:
                first[key] = i, range(lines[0], lines[-1] + 1)
    gone = {i: gone[i] - kept[i] for i in gone}
    return sorted(
        (i, "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in gone[i]), len(solid[i]), len(gone[i]))
        for i, t in rows
    )


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a", " a ", "b", "c", "", "d", " "]) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    rows += [(70, "a\nb"), (71, " a\nb\n"), (72, "solo"), (73, "solo"), (74, "q\nq\nq\nq"), (75, "x1\ny1\n" * 3), (76, "q\n\nq\nq\nq\nq")]
    rows += [(60, None), (61, ""), (62, "a\nb"), (63, "x\ny\nz\nx\ny\nz\nx"), (64, "\n".join("long" * 50 for _ in range(400)))]
    got = line_dedup(docs(spark, rows)).select("doc_id", "text", "n_lines", "n_removed")
    assert sorted(tuple(r) for r in got.collect()) == brute_lines(rows)


def test_a_first_occurrence_stays(spark):
    """Also where it is overlapped by the next one."""
    rows = [(1, "a\na\na\na"), (2, "x\ny\nx\ny\nx\ny"), (3, "p\nq"), (4, "p\nq"), (5, "p\nq\nr")]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup(docs(spark, rows)).collect()}
    assert got == {1: ("a\na\na", 1), 2: ("x\ny\nx\ny", 2), 3: ("p\nq", 0), 4: ("", 2), 5: ("p\nq\nr", 0)}


def test_line_dedup_edge_cases(spark):
    rows = [(1, "a\nb\nc", "k"), (1, "a\nb\nc", "k"), (None, "a\nb\nc", "k")]
    got = sorted((tuple(r) for r in line_dedup(docs(spark, rows, ", spans string")).select("doc_id", "text", "n_removed").collect()), key=str)
    assert got == [(1, "a\nb\nc", 0), (1, "a\nb\nc", 0), (None, "", 3)]
    assert line_dedup(docs(spark, [])).count() == 0


# --- mixing ----------------------------------------------------------------


def water_level(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over


def mixture(spark, n=400, seed=5):
    rng = random.Random(seed)
    source = lambda: rng.choice(["big"] * 12 + ["a", "b", "é", None, "tiny"])
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 200))), "x", source(), 1) for i in range(n)]
    rows += [(n, None, "x", "empty", 0), (n + 1, "", "x", "empty", 0), (n + 2, "w " * 30000, "x", "long", 0)]
    return spark.createDataFrame(rows, DOCS), rows


def test_mix_meets_targets(spark):
    table, rows = mixture(spark)
    got = mix_sources(table, shard_words=1000, shards_per_band=4).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    target = water_level(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        shards = -(-sizes[s] // 1000)
        assert abs(taken[s] - target[s]) <= 16 * (shards + 2), s


def test_mix_is_the_same_in_every_run_and_partitioning(spark):
    table, _ = mixture(spark)
    first = sorted(tuple(map(str, r)) for r in mix_sources(table).collect())
    again = sorted(tuple(map(str, r)) for r in mix_sources(table.repartition(7)).collect())
    assert first == again


def test_mix_edge_cases(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    empty = spark.createDataFrame([(1, None, "x", None, 1), (2, " ", "x", "s", 1)], DOCS)
    assert [(r.target, r.taken) for r in mix_sources(empty).collect()] == [(0.0, 0)] * 2
    same = spark.createDataFrame([(1, "a b c", "x", "s", 1)] * 4 + [(None, "a b", "x", None, 1)] * 2, DOCS)
    got = mix_sources(same).collect()
    assert len(got) == 6 and all(r.taken <= 3 * r["size"] for r in got)
    kept = mixed_documents(same.withColumn("taken", F.lit("old")).withColumn("size", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "taken"]


# --- URL filter ------------------------------------------------------------

URLS = [
    "http://a.example.com/en/1", "http://WWW.Example.com/en/", "https://x.org/es/", "http://net/es/x", "http://b.net/fr/?q=/es/",
    "http://notnet/es/", "http://example.com", "http://example.com?x", "http://com/", "nourl", "", None, "://", "http:///en/",
    "http://example.com.net/es/" + "y" * 100000, "http://h#/en/", "http://example.com/enx", "x://y://z.com/",
]


def brute_verdict(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1])), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else default


def test_url_verdicts(spark):
    table = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    got = url_rules.filter_urls(table, URL_RULES, block_rules=2)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert rows == {i: brute_verdict(u, URL_RULES) for i, u in enumerate(URLS)}
    assert url_rules.filter_urls(table.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_rules.filter_urls(table, [], default="block").collect()} == {"block"}


def test_colliding_digests_are_confirmed(tmp_path):
    rules = [("block", f"h{i}.org", "/") for i in range(50)]
    clash = lambda key: xxhash.xxh64_intdigest(key) % 3
    path = tmp_path / "rules"
    path.write_bytes(url_rules.pack_rules(rules, clash))
    urls = [f"http://h{i}.org/" for i in range(80)]
    got = url_rules.judge_urls(urls, [url_rules.RuleFile(str(path))], "allow", clash)
    assert list(got["verdict"]) == ["block"] * 50 + ["allow"] * 30


def test_host_suffixes_and_long_hosts():
    import time

    from corate.llm.url_rules import host_suffixes, judge_urls, pack_rules, RuleFile

    rng = random.Random(2)
    for _ in range(300):
        host = "".join(rng.choice("ab.") for _ in range(rng.randrange(9)))
        counts = sorted(rng.sample(range(1, 6), 3))
        labels = host.split(".")
        assert host_suffixes(host, counts) == [".".join(labels[-n:]) for n in counts if n <= len(labels)]
    rules = [("block", "b.example.com", "/x"), ("allow", "com", "/")]
    with open("/tmp/corate-rules-test.bin", "wb") as f:
        f.write(pack_rules(rules))
    long = "http://" + "a." * 60000 + "b.example.com/x/" + "y" * 100000
    start = time.time()
    got = judge_urls([long, "http://" + "." * 60000 + "/", None], [RuleFile("/tmp/corate-rules-test.bin")], "allow")
    assert got["rule"].tolist() == ["b.example.com/x", None, None] and time.time() - start < 5


def test_many_sources_in_two_levels(spark):
    """The distributed ranking gives what one window gives."""
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice([None, *(f"s{k}" for k in range(60))])) for i in range(900)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plain = sorted(tuple(r) for r in mix_sources(table).collect())
    assert sorted(tuple(r) for r in mix_sources(table, chunk=7).collect()) == plain
    assert sorted(tuple(r) for r in mix_sources(table.where("text = ''"), chunk=7).collect()) == sorted(
        tuple(r) for r in mix_sources(table.where("text = ''")).collect()
    )


def test_a_hundred_thousand_sources(spark):
    sources = spark.range(100_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"), F.format_string("host-%06d", "id").alias("source")
    )
    got = mix_sources(sources)
    (row,) = got.agg(F.count("*"), F.sum("size"), F.sum("taken"), F.sum("target"), F.max(F.col("taken") / F.col("size"))).collect()
    assert row[0] == 100_000 and abs(row[3] - row[1]) < 1 and row[4] <= 3
    assert 0.7 * row[1] < row[2] < 1.1 * row[1]  # a block is 16 words, and most sources have fewer than three


def test_rows_without_an_id_are_spread(spark):
    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit("a b c"), "id").alias("text"), F.lit("s").alias("source"))
    got = mix_sources(rows, shard_words=4000)
    (row,) = got.agg(F.count("*"), F.sum("size"), F.sum("taken"), F.countDistinct("taken")).collect()
    assert row[0] == 20_000 and row[1] == 80_000 and abs(row[2] - row[1]) <= 16 * 20  # a block in each of 20 shards
