import random
import zlib

import public_tokenizers
from pyspark.sql import Row
from tokenizers import Tokenizer

from shoplens.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _check(counts, capacity):
    plan = packing.plan(counts, capacity)
    got = {}
    for times, lengths in plan:
        assert times > 0 and sum(lengths) <= capacity
        for w in lengths:
            got[w] = got.get(w, 0) + times
    assert got == {w: c for w, c in counts.items() if c}
    return sum(t for t, _ in plan)


def test_plan_covers_all_and_is_tight():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([10, 64, 1024])
        counts = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(1, 40))}
        n = _check(counts, capacity)
        total = sum(w * c for w, c in counts.items())
        plain = sum(t for t, _ in packing.best_fit(counts, capacity))
        assert -(-total // capacity) <= n <= plain + 1


def test_reduction_keeps_the_optimum_on_small_instances():
    def optimum(items, capacity):
        best = len(items)

        def go(k, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if k == len(items):
                best = len(rooms)
                return
            for r in sorted(set(rooms)):
                if r >= items[k]:
                    rest = list(rooms)
                    rest[rest.index(r)] -= items[k]
                    go(k + 1, rest)
            go(k + 1, [*rooms, capacity - items[k]])

        go(0, [])
        return best

    rng = random.Random(11)
    for _ in range(150):
        items = sorted((rng.randint(3, 12) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = {w: items.count(w) for w in items}
        sizes, left = sorted(counts), dict(counts)
        got = packing._dominating(items[0], 12 - items[0], sizes, left)
        if got:
            rest = list(items)
            for w in got:
                rest.remove(w)
            assert 1 + optimum(rest, 12) == optimum(items, 12)


def test_pack_rows(spark):
    long = " ".join(f"word{i} straße" for i in range(1500))
    rows = [(1, "a small text"), (2, None), (3, ""), (4, long), (4, long), (None, "x\ty  z\n\n q "), (7, "<|endoftext|> b")]
    rows += [(100 + i, "the copy of it") for i in range(300)]
    df = spark.createDataFrame([Row(doc_id=a, text=b, number="n", part="p", length=1) for a, b in rows]).repartition(5)
    out = packing.pack(df, PATH, 2, True, public_tokenizers.PATTERN).collect()
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    want = {}
    for i, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        for k, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            crc = zlib.crc32(b"".join(v.to_bytes(4, "little") for v in ids[s:s + n]))
            want.setdefault((i, k, s, n, crc), 0)
            want[i, k, s, n, crc] += 1
    got, places = {}, {}
    for r in out:
        got[tuple(r[:5])] = got.get(tuple(r[:5]), 0) + 1
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= -(-sum(r.length for r in out) // 1024) + 1


def test_pack_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, PATH, 2, True, public_tokenizers.PATTERN).count() == 0
