import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoplens.llm import orc_tokens, tokens
from shoplens.llm.queries import WORD_PATTERN

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = ["", " ", "  a b", "a  b\n c ", "x\n\ny z", "a  b", "  b", "a ́b", "Σ ΟΔΟΣ Σ",
       "é é \x1c a\x1cb", "<|endoftext|> a", "a\r\n b\t c", "'s 're  's", "　x", "İ i̇", "it's we'll ' s",
       "a\x85b c\x0bd \x0be", "\U0001f600\U0001f600 ok", "STRASSE Straße ǅ", "a" * 5000, "123 4567 8"]


@pytest.mark.parametrize("name,spaced,pattern", [("word_bpe_49k.json", False, WORD_PATTERN),
                                                 ("byte_bpe_50k.json", True, public_tokenizers.PATTERN)])
def test_pieces_give_the_ids_of_whole_texts(name, spaced, pattern):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    cache = tokens.library_encoder(public_tokenizers.path(name), spaced, tokens.split_words(pattern))
    texts = ODD + [f"{a} {b}" for a in ODD for b in ODD]
    for x, e, ids in zip(texts, t.encode_batch(texts, add_special_tokens=False), cache.ids(texts)):
        assert ids == tokens.packed(e.ids), repr(x)


def test_a_small_cache_gives_the_same():
    t = Tokenizer.from_file(PATH)
    cache = tokens.PieceCache(lambda ps: [tokens.packed(e.ids) for e in t.encode_batch(ps, add_special_tokens=False)], False, limit=3)
    for _ in range(3):
        assert cache.ids(["one two three four", "four five"])[1] == tokens.packed(t.encode("four five", add_special_tokens=False).ids)


def test_files_and_offsets(spark):
    rows = [(i, f"document {i} " + "word " * (i % 7)) for i in range(200)] + [(None, "null id"), (5, "again"), (9, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "2 as ids").repartition(7)
    files = orc_tokens.id_files(df, PATH, 1, False, WORD_PATTERN)
    got = sorted(orc_tokens.read_ids(files).collect(), key=lambda r: r.start)
    t = Tokenizer.from_file(PATH)
    want = sorted((i if i is not None else -1, len(ids := t.encode(x or "", add_special_tokens=False).ids + [1]),
                   zlib.crc32(tokens.packed(ids))) for i, x in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id if r.doc_id is not None else -1 for r in got] == [w[0] for w in want]
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_id_filter_reaches_the_files(spark):
    df = spark.createDataFrame([(i, "a b") for i in range(50)], "doc_id long, text string")
    files = orc_tokens.id_files(df, PATH, 1, False, WORD_PATTERN).filter("doc_id = 17")
    assert files.count() == 1
    assert "EqualTo(doc_id,17)" in files._jdf.queryExecution().toString()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert orc_tokens.read_ids(orc_tokens.id_files(df, PATH, 1, False, WORD_PATTERN)).count() == 0


def test_a_worker_keeps_one_owners_cache():
    from shoplens.llm.common import kept_by_worker, let_go

    first = kept_by_worker("a", dict)
    assert kept_by_worker("a", dict) is first
    assert kept_by_worker("b", list) == [] and kept_by_worker("a", dict) is not first
    again = kept_by_worker("a", dict)
    let_go()
    assert kept_by_worker("a", dict) is not again
    let_go()
