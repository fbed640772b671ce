import os
import random
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import jaccard
from shoplens.llm.common import FREE_SHUFFLES, stored
from shoplens.llm.components import connected_components


def _set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def _brute(rows):
    sets = [_set(t) for _, t in rows]
    p = list(range(len(rows)))

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= 75 * len(sets[a] | sets[b]):
                p[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def _corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = text(60)
    rows = [(i, " ".join(text(rng.randint(3, 80)) + passage)) for i in range(40)]  # share a passage, few link
    for base in range(12):
        t = text(rng.randint(5, 200))
        for _ in range(rng.randint(1, 14)):
            u = list(t)
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                u[rng.randrange(len(u))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(u)))
    chain = text(120)
    for _ in range(25):  # each near the next, ends far apart
        rows.append((len(rows), " ".join(chain)))
        chain = chain[6:] + text(6)
    rows += [(len(rows) + k, t) for k, t in enumerate(["", None, "  ", "one", "One", "one two", "a b c d", "a b c d", "a b c d e", "A b\tc d  e"])]
    rows += [(2, rows[2][1]), (None, rows[5][1]), (None, "null alone with these words here"), (None, "null alone with these words here")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [jaccard.BLOCK, 600])
def test_components_equal_brute_force(spark, block):
    rows = _corpus()
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, cid int").repartition(4)
    got = jaccard.jaccard_components(df, block=block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _brute(rows)


def test_tree_links_connect_all(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, (6, 400)).astype(np.uint64)
    sets = [np.unique(np.concatenate([b[: 400 - k % 40], rng.integers(0, 2**63, k % 40).astype(np.uint64)])) for b in base for k in range(60)]
    for sides in (None, [k % 2 for k in range(len(sets))]):
        found = jaccard.tree_links(sets, sides, 3, 4)
        assert len(found) == len(sets) - 6  # a spanning forest, not all pairs
        assert all(u // 60 == v // 60 for u, v in found)


def test_one_of_each(spark):
    rows = _corpus(6)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, _kid int").repartition(4)
    kept = jaccard.one_of_each(df)
    want = {c for i, n, c in _brute(rows) if n and c is not None} | {i for i, n, _ in _brute(rows) if not n}
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} - {None} == want - {None}


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)] + [(2000, k) for k in range(2001, 2200)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    p = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in edges:
        if a != b and find(a) != find(b):
            p[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in p}


def test_empty_table(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_near_copies_with_null_or_equal_ids_leave_one(spark):
    words = [f"w{k}" for k in range(60)]
    near = lambda k: " ".join([*words, f"end{k}"])
    other = lambda k: " ".join(["x", *words[::-1], f"tail{k}"])
    rows = [(None, near(k)) for k in range(3)] + [(7, other(0)), (7, other(1)), (7, other(1)), (None, other(2)), (None, None), (None, "")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component int").repartition(4)
    got = jaccard.one_of_each(df).collect()
    assert sum(r.text is not None and r.text.startswith("w0 ") for r in got) == 1
    assert [r.doc_id for r in got if r.text and r.text.startswith("x ")] == [7]
    assert len(got) == 4  # and the two rows without a set


def test_a_passage_in_many_texts_sends_few_copies_of_their_sets(spark, monkeypatch, tmp_dir):
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(30)]
    rows = [(i, " ".join([*(f"w{rng.randrange(10**9)}" for _ in range(40)), *passage])) for i in range(300)]
    rows += [(1000 + i, f"{t} tail{i}") for i, t in rows[:20]]  # these link

    def counted(t_num, t_den, links=jaccard.unit_links):
        run = links(t_num, t_den)

        def count(table):
            with open(os.path.join(tmp_dir, f"{uuid.uuid4().hex}-{table.num_rows}"), "w"):
                return run(table)

        return count

    monkeypatch.setattr(jaccard, "unit_links", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard.jaccard_components(df, block=600).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _brute(rows)
    # In blocks of 600 shingles the group of the passage has 36: each set was sent 36 times.
    assert 40 <= sum(int(n.split("-")[1]) for n in os.listdir(tmp_dir)) < 3 * len(rows)


def test_block_pairs_of_all_waves_meet_once(spark):
    for nb in range(1, 9):
        homes = spark.range(nb).select(F.col("id").cast("int").alias("home"), F.lit(nb).alias("nb"))
        for most in (0, 5 * nb, 10**6):
            ranges = jaccard.waves([(nb, nb), (1, 40)], most)
            assert most < 10**6 or len(ranges) == 1
            got = [(r.home, *r.p) for lo, hi in ranges for r in homes.withColumn("p", F.explode(jaccard.block_pairs(lo, hi))).collect()]
            want = [(h, h, h, 0) for h in range(nb)]
            pairs = {(i, j) for _, i, j, _ in got if i != j}
            assert len({frozenset(p) for p in pairs}) == len(pairs) == nb * (nb - 1) // 2
            assert sorted(got) == sorted(want + [(i, i, j, 0) for i, j in pairs] + [(j, i, j, 1) for i, j in pairs])


def test_waves_of_one_distance_find_every_link(spark, monkeypatch):
    ranges = []
    monkeypatch.setattr(jaccard, "waves", lambda weights, most, f=jaccard.waves: ranges.extend(f(weights, 0)) or ranges)
    rng = random.Random(9)
    base = [f"b{k}" for k in range(90)]
    rows = [(i, " ".join(f"x{rng.randrange(10**6)}" if rng.random() < 0.03 else w for w in base)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard.jaccard_components(df, block=800).collect()
    assert len(ranges) > 2
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _brute(rows)


def test_shuffle_files_go_when_a_table_is_stored(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = files()
    t = stored(spark.range(1000).repartition("id"), "kept-until-collected")
    assert t.count() == 1000 and files() - before
    before |= files()
    t = stored(spark.range(1000).repartition("id"), "freed", free=True)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert t.count() == 1000 and spark.conf.get(FREE_SHUFFLES) == "false"
