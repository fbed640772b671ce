import hashlib
import random

import public_tokenizers
import tiktoken

from shoplens.llm import bpe, tokens

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_ids_equal_the_library_and_decode_back(spark):
    rng = random.Random(4)
    texts = [None, "", " ", "  two  spaces ", "a\n\nb\t c\r\n", "naïve café Straße señor", "日本語の文章" * 30, "😀😀 ok", "it's we'll 're",
             "a" * 700, "ab" * 3000 + " q", "".join(rng.choice("abcdefgh") for _ in range(2000)), "<|endoftext|>", "x\x1cy \x1d z", "1234567890 12"]
    texts += ["".join(rng.choice("ab c\né 1.'s") for _ in range(200)) for _ in range(40)]
    ranks = bpe.load_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "null id", 1)], "doc_id long, text string, ids int").repartition(3)
    whole = {r.doc_id: r for r in bpe.encode(df, PATH, public_tokenizers.PATTERN).collect()}
    digests = {r.doc_id: r for r in bpe.encode(df, PATH, public_tokenizers.PATTERN, digests=True).collect()}
    assert len(whole) == len(texts) + 1
    for i, t in enumerate(texts):
        ids = tokens.packed(library.encode_ordinary(t or ""))
        assert bytes(whole[i].ids) == ids and bytes(whole[i].decoded) == (t or "").encode()
        assert digests[i].n_tokens == len(ids) // 4
        assert digests[i].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_heap_and_recursion_agree():
    engine = bpe.BpeEngine(PATH)
    rng = random.Random(8)
    words = ["".join(rng.choice("aeionrst ") for _ in range(rng.randint(2, 60))).encode() for _ in range(300)]
    todo = [w for w in words if w not in engine.ranks]
    assert engine._contracted(todo) == [engine.contract(w) for w in todo]


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH, public_tokenizers.PATTERN).count() == 0
