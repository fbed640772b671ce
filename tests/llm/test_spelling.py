import random
import re
import zlib
from collections import Counter

import pytest

from shoplens.llm.spelling import Acceptor, near_pairs, variants


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(rows, every=97):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if _one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        end = w
        while form[end]:
            end = form[end]
        out[w] = (n[w], len(near[w]), form[w], n.get(form[w]), end)
    return out


def _rows(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", "r") for i, t in rows], "doc_id long, text string, n int, key string, role string").repartition(4)


def _got(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("limit", [20_000, 5])  # 5: initial states are taken apart until they are bounded
def test_equals_brute_force(spark, limit):
    rng = random.Random(5)
    # Few letters, so runs of equal letters and many near words.
    words = ["".join(rng.choice("aabcé") for _ in range(rng.randint(4, 9))) for _ in range(250)]
    rows = [(i, " ".join(rng.choice(words[:rng.randint(5, 250)]) for _ in range(60))) for i in range(150)]
    want = _brute(rows, every=7)
    assert sum(1 for v in want.values() if v[2]) > 20 and any(v[4] not in (v[2], w) for w, v in want.items())
    assert _got(variants(_rows(spark, rows), every=7, group_rows=limit)) == want


def test_odd_rows(spark):
    long = "y" * 30_000
    rows = [(None, "Straße straße STRAßE stra\u00dfen"), (None, None), (1, ""), (2, "hello hello hello"), (2, "hello hello hello"),
            (3, "hallo HALLO Hallo hullo hullo hullo"), (4, f"{long} {long} {long} {long}x {long}x {long}x"), (5, "12345 ---"),
            (6, "×÷×÷× ×÷×÷× ×÷×÷× ĀĀĀĀĀ ĀĀĀĀĀ ĀĀĀĀĀ"), (7, "aaaaa aaaaa aaaaa " * 3 + "aaaaaa " * 3 + "aaaaaaa " * 40)]
    assert _got(variants(_rows(spark, rows))) == _brute(rows)
    got = _got(variants(_rows(spark, rows), every=0))
    assert got["hello"] == (6, 2, None, None, "hello") and got["hullo"] == (3, 2, "hello", 6, "hello")
    assert got["×÷×÷×"][0] == 3 and got["aaaaa"] == (9, 1, None, None, "aaaaa") and got["aaaaaa"][4] == "aaaaaaa"


def test_ties_take_the_smaller_word(spark):
    rows = [(1, "caper " * 3 + "taper " * 6 + "paper " * 6)]
    assert _got(variants(_rows(spark, rows), every=0))["caper"][2] == "paper"


def test_each_pair_once(spark):
    names = ["aaaaa", "aaaaaa", "aaaaaaa", "abaaa", "aabaa", "ababa"]
    words = spark.createDataFrame([(w, 3) for w in names], "word string, n long")
    pairs = [tuple(sorted((r.a, r.b))) for r in near_pairs(words, group_rows=2).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in names for b in names if a < b and _one_edit(a, b)}


def test_empty_table(spark):
    assert variants(_rows(spark, [])).count() == 0


def test_acceptor_is_minimal():
    m = Acceptor()
    start = m.add(["tap", "taps", "top", "tops"])
    # Start, after t, after ta = to, after tap = top, end.
    assert len(m.arcs) == 5 and sorted(m.common(start, start)) == ["tap", "taps", "top", "tops"]
    other = m.add(["taps", "tips"])
    assert sorted(m.common(start, other)) == ["taps"] and m.live(start, other)


def test_ratio_below_two_is_refused(spark):
    with pytest.raises(ValueError):
        variants(_rows(spark, []), ratio=1)
