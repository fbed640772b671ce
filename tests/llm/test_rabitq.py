import random

from shoplens.llm import rabitq


def _brute(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and x == x and abs(x) < float("inf") for x in v) and any(v):
            good.setdefault(i, []).append(v)
    out = []
    for q in sorted(i for i in good if i % 20 == 0):
        best = {}
        for qv in good[q]:
            for i, vs in good.items():
                for v in vs:
                    if i != q and len(v) == len(qv):
                        s = 0.0
                        for a, b in zip(qv, v):
                            s += a * b
                        best[i] = max(best.get(i, s), s)
        out += [(q, k0 + 1, i, s) for k0, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return out


def _run(spark, rows, k=20):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    index = rabitq.build_index(df)
    got = rabitq.search(index, index.filter("vec_id % 20 = 0"), k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def test_odd_rows_ties_and_copies(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [(7, rows[7][1])]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] + [1.0] * 15), (404, [float("inf")] * 16),
             (405, [None] * 16), (None, [1.0] * 16), (420, [1.0, 2.0]), (421, [2.0, 1.0]), (440, [1e200] * 16), (460, [1e-200] * 16)]
    assert _run(spark, rows) == _brute(rows, 20)


def test_recall_on_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "ROWS_A_BLOCK", 300)
    monkeypatch.setattr(rabitq, "QUERIES_A_BLOCK", 20)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(32)]) for i in range(1500)]
    got, want = _run(spark, rows, 10), _brute(rows, 10)
    hits = len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want})
    assert len(got) == len(want) and hits >= 0.97 * len(want)


def test_empty_table(spark):
    assert _run(spark, []) == []
