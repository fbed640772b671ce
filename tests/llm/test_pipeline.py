import random

import corpus_pipeline
from shoplens.llm.queries import REGISTRY

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "personal_data", "packing"]
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


def test_stages_take_effect(spark, tmp_path):
    def text(i):
        rng = random.Random(i)
        return " ".join("".join(rng.choice("abdefgiklmnoprstu") for _ in range(6)) for _ in range(40))

    rows = [(i, text(i), "en", "s", 0) for i in range(30)]
    rows += [(100, text(3), "en", "s", 0), (101, text(4) + " and", "en", "s", 0), (102, "too few", "en", "s", 0), (103, None, None, None, None),
             (104, text(104) + " mail a.b@c.example.org", "en", "s", 0)]
    rows += [(200 + i, f"{text(200 + i)} scum idiot", "en", "s", 0) for i in range(40)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i >= 200)) for i, *_ in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf = str(tmp_path)
    docs = corpus_pipeline.table(spark, sf, "documents")
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean = set(range(30)) | {104}
    assert ids[0] == clean | {100, 101} | {200 + i for i in range(40)}
    assert ids[1] == clean | {100, 101}
    assert ids[2] == ids[3] == clean
    assert docs.filter("doc_id = 104").first().text.endswith("mail [EMAIL]")
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in out} == clean
