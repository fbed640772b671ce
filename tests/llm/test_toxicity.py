import math
import random
import zlib

from shoplens.llm import toxicity as tx


def _data(n=1500, seed=3):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abdefgiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        words = [rng.choice(plain) for _ in range(rng.randint(20, 80))]
        if bad:
            words += [rng.choice(["scum", "idiot", "grobian" + rng.choice(["en", "er", "isch", "ung"])])] * 2
            if rng.random() < 0.8:  # groups are named more often in toxic texts
                words.append(rng.choice(tx.IDENTITY["en"]))
        elif rng.random() < 0.03:
            words.append(rng.choice(tx.IDENTITY["en"]))
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_neutral_mentions(spark):
    rows, labels = _data()
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double").repartition(3)
    labs = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = tx.train(docs, labs)
    got = {r.doc_id: r for r in tx.score(docs, model).collect()}
    truth = dict(labels)
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert sum(got[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    neutral = [(k, f"once the {t} met others in town") for k, t in enumerate(tx.IDENTITY["en"])]
    probe = spark.createDataFrame(neutral, "doc_id long, text string")
    assert tx.score(probe, model).agg({"predicted": "sum"}).first()[0] == 0
    loose = tx.train(docs, labs, fit=tx.Fit(counterfactual=0.0))
    swing = lambda m: max(abs(sum(m[0].get(f, 0) for f in tx.features_of(t))) for t in tx.IDENTITY["en"])
    assert swing(model) < swing(loose)


def test_held_out_labels_are_not_read(spark):
    rows, labels = _data(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    assert tx.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int")) == tx.train(docs, spark.createDataFrame(flipped, "doc_id long, toxic int"))


def test_texts_without_evidence_score_as_the_share_of_all_labels(spark):
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3))
    docs = spark.createDataFrame([(i, word(i)) for i in range(1000)], "doc_id long, text string")
    labs = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(1000)], "doc_id long, toxic int")
    whole, bound = tx.train(docs, labs), tx.train(docs, labs, fit=tx.Fit(max_toxic=60, max_clean=120))
    assert not whole[0] and not bound[0] and abs(whole[1] - bound[1]) < 0.01


def test_class_bounds_do_not_move_the_prior(spark):
    rows, labels = _data(4000, seed=5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labs = spark.createDataFrame(labels, "doc_id long, toxic int")
    whole, bound = tx.train(docs, labs), tx.train(docs, labs, fit=tx.Fit(max_toxic=400, max_clean=400))
    share = lambda b: 1 / (1 + math.exp(-b))
    assert abs(share(whole[1]) - share(bound[1])) < 0.05  # texts without evidence
    weigh = lambda m, w: sum(m[0].get(f, 0) for f in tx.features_of(w))
    assert all(weigh(m, w) + m[1] > 0 for m in (whole, bound) for w in ("scum", "idiot"))
    a, b = ({r.doc_id: r.predicted for r in tx.score(docs, m).collect()} for m in (whole, bound))
    assert sum(a[i] == b[i] for i in a) >= 0.99 * len(a)
    # One sample, its clean rows at a quarter of the rate: the same features pass.
    dense = [(int(i < 200), tx.feature_ids({f"w{i}", "often"} | ({"mild"} if i % 5 < 2 * (i < 200) else set())), None) for i in range(2000)]
    thin = [r for i, r in enumerate(dense) if r[0] or i % 4 == 0]
    full, few = tx.fit_weights(dense, tx.Fit()), tx.fit_weights(thin, tx.Fit(), (4.0, 1.0))
    assert full[0].keys() == few[0].keys() and abs(share(full[1]) - share(few[1])) < 0.02


def test_repeated_ids_do_not_fill_the_driver(spark):
    rows = [(1, f"text {k % 50}") for k in range(500)] + [(2, "a"), (3, "b"), (3, "b")]
    docs, labs = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    known = {i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 5}
    take = lambda d: sorted(map(tuple, tx.training_sample(d, labs, "doc_id", "text", tx.Fit()).collect()), key=repr)
    got = take(docs.repartition(7))
    assert 1 in known and len(got) == len(known) and got == take(docs.orderBy("text"))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "idiot"), (3, "x" * 50000), (3, "y")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    got = tx.score(docs, tx.train(docs, none)).collect()
    assert len(got) == 5 and all(0 <= r.score < 0.5 and r.predicted == 0 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    model = ({f: 9.0 for f in tx.features_of("idiot")}, -3.0)
    kept = tx.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4
    assert tx.score(docs.limit(0), model).count() == 0


def test_an_id_with_both_labels_has_none(spark):
    from shoplens.llm.toxicity import known_labels

    rows = [(i, 1) for i in range(20)] + [(i, 0) for i in range(10, 30)] + [(5, 1), (None, 1), (25, None)]
    for parts in (1, 5):
        got = known_labels(spark.createDataFrame(rows, "doc_id long, toxic int").repartition(parts)).collect()
        assert all(r.toxic == (1 if r.lid < 10 else 0) and not 10 <= r.lid < 20 for r in got) and len(got) == len({r.lid for r in got}) > 10
