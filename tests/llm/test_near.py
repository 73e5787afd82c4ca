"""Near dedup against brute force, and connected components."""

import random

from pyspark.sql import functions as F


from corate.llm.components import connected_components
from corate.llm.near import near_dedup, near_groups


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted((i, len(s), root(i), i == root(i)) for i, s in sets)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.random()}"
    return words


def corpus(seed, n_groups=25):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 3000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(n_groups):
        base = [word() for _ in range(rng.choice([3, 6, 20, 40, 70, 150, 400]))]
        texts += [base, base]
        for _ in range(rng.randint(0, 5)):
            base = edited(rng, base, rng.choice([1, 1, 2, len(base) // 60 + 1]))  # a chain: each near its predecessor
            texts.append(base)
    hub = [word() for _ in range(200)]
    texts += [edited(rng, hub, rng.randint(0, 3)) for _ in range(60)]
    texts += [passage + [word() for _ in range(rng.randint(1, 30))] for _ in range(60)]
    rows = [" ".join(t).upper() if rng.random() < 0.2 else "\n ".join(t) for t in texts]
    rows += [None, "", " \t", "one", "ONE", "one two", " ".join(word() for _ in range(30000))]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True))


def run(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in near_groups(table).collect())


def test_near_groups_equal_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert run(spark, rows) == brute(rows)


def test_sets_about_the_size_of_a_sketch(spark):
    """Trimmed and edge-edited copies of 45 to 75 shingles: unions on both sides of the 64 values of a sketch."""
    rows = []
    for n in range(45, 76):
        for kind in ("front", "back", "edge"):
            words = [f"{kind}{n}w{k}" for k in range(n + 4)]
            least = -(-85 * n // 100)  # the shortest trimmed copy that is linked; the next is not
            edits = max(d for d in range(n) if 100 * (n - d) >= 85 * (n + d))  # likewise of the edits at both ends
            if kind == "edge":
                copies = [["x"] * (e // 2) + words[e // 2 : n + 4 - (e - e // 2)] + ["y"] * (e - e // 2) for e in (edits, edits + 1)]
                copies = [[f"{w}{n}{i}{k}" if w in "xy" else w for k, w in enumerate(c)] for i, c in enumerate(copies)]
            elif kind == "front":
                copies = [words[: m + 4] for m in (least, least - 1)]
            else:
                copies = [words[-m - 4 :] for m in (least, least - 1)]
            for copy in copies:
                base = [f"{w}of{len(rows)}" for w in words]
                rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(f"{w}of{len(rows)}" for w in copy))]
    want = brute(rows)
    assert sum(not r[3] for r in want) == 3 * 31  # one of the two copies of each
    assert run(spark, rows) == want


def test_near_edge_cases(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f"), (5, None), (4, None)]
    got = sorted((tuple(r) for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True), (2, 2, 1, False), (5, 0, 5, True), (4, 0, 4, True)], key=str
    )
    assert near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = [(3, "x y"), (3, "p q r s t u v"), (7, "p q r s t u v")]  # two texts of one id
    assert run(spark, one) == [(3, 1, 3, True), (3, 3, 3, True), (7, 3, 3, False)]


def test_near_dedup_keeps_columns(spark):
    table = spark.createDataFrame([(1, "a b", 1), (2, "a b", 2), (None, "a b", 3)], "doc_id long, text string, node int")
    kept = near_dedup(table)
    assert kept.columns == table.columns and sorted(r.node for r in kept.collect()) == [1, 3]


def test_components_of_long_paths(spark):
    rng = random.Random(7)
    path = list(range(300))
    rng.shuffle(path)
    edges = list(zip(path, path[1:], strict=False)) + [(1000, k) for k in range(1001, 1100)] + [(5000, 5000), (None, 1), (2, None)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == dict.fromkeys(range(1, 300), 0) | dict.fromkeys(range(1001, 1100), 1000)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_of_common_passages_make_few_candidates(spark):
    """Texts of 8 out of 40 passages, none a near copy but for some edited ones: of all pairs one in a hundred leaves the joins at most."""
    from corate.llm.near import NearDuplicates, full_sets

    rng = random.Random(12)
    passages = [" ".join(f"p{k}w{rng.randrange(10**6)}" for _ in range(40)) for k in range(40)]
    counts = {}
    for n in (250, 500):
        rows = [(i, " ".join(rng.sample(passages, 8)) + f" end{i}") for i in range(n)]
        rows += [(n + i, rows[i][1].replace("end", "x y z end")) for i in range(20)]
        assert run(spark, rows) == brute(rows)
        task = NearDuplicates(85, 5, 64, 7.0)
        table = spark.createDataFrame(rows, "doc_id long, text string")
        classes = task.classes(task.describe(table, "doc_id", "text"))
        values, sketches, profiles = task.postings(classes)
        full = table.select(F.col("doc_id").alias("node"), full_sets(F.col("text"), 5).alias("set")).join(sketches.select("node"), "node")
        star = task.to_pivots(values, full)
        counts[n] = task.by_difference(star, profiles).unionByName(task.far_apart(values, star, profiles)).distinct().count()
    assert all(c <= 0.01 * n * n / 2 for n, c in counts.items()), counts
