"""What a Python worker of the text operators holds at a time."""

import tracemalloc

import public_tokenizers
import pyarrow as pa

import corpus_pipeline
from shoplens.llm import packing, pii, tokens
from shoplens.llm.common import PIECE_ROWS, in_pieces

FIELD = pii.Field([[2.0] + [0.0] * 4] + [[0.0] * 5] * 15, 0.0, 0.0)


def test_personal_data_holds_a_piece_of_a_batch_at_a_time():
    texts = [f"{i} someone{i}@mail{i}.example.org " + "some words " * 200 for i in range(4_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(4_000), pa.int64())], names=["text", "c0"])
    size, texts = sum(map(len, texts)), None
    rows, ids, first = 0, [], None
    tracemalloc.start()
    for out in pii.finder(FIELD, True)(iter([batch])):
        first = first or out.column(1)[0].as_py()
        rows += out.num_rows
        ids += out.column(0).to_pylist()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 4_000 and ids == list(range(4_000)) and first.startswith("0 [EMAIL] some words")
    assert most < size / 3


def test_pieces_keep_every_row_in_order():
    sizes = (0, 1, PIECE_ROWS, PIECE_ROWS + 1, 3 * PIECE_ROWS - 1)
    batches = [pa.RecordBatch.from_arrays([pa.array([f"{k}:{i}" for i in range(n)], pa.string())], names=["t"]) for k, n in enumerate(sizes)]
    got = list(in_pieces(iter(batches)))
    assert max(b.num_rows for b in got) == PIECE_ROWS
    assert [x for b in got for x in b.column(0).to_pylist()] == [x for b in batches for x in b.column(0).to_pylist()]


def test_pipeline_sends_long_texts_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        docs = spark.createDataFrame([(1, "write to a@b.org", "en", "x", 16)], "doc_id long, text string, lang string, source string, n_chars long")
        assert corpus_pipeline.private(spark, docs, "").first()["text"] == "write to [EMAIL]"
        assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.set(key, before)


def test_packing_remembers_as_many_pieces_as_it_is_told():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([t])], names=["doc_id", "text"]) for k, t in enumerate(texts)]
    rows = {}
    for limit in (100, 600_000):
        run = packing.piece_rows(path, 2, True, public_tokenizers.PATTERN, 1024, limit)
        rows[limit] = [r for b in run(iter(batches)) for r in b.to_pylist()]
        cache = tokens.library_encoder(path, True, tokens.split_words(public_tokenizers.PATTERN), limit)
        assert len(cache.known) <= limit + 50 or limit > 100
    assert rows[100] == rows[600_000] and len(rows[100]) == 60
    assert corpus_pipeline.REMEMBERED < tokens.LIMIT
