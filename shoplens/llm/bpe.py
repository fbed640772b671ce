"""Byte-level BPE by recursive SQL.

A text is cut into words by the tokeniser's pattern.  Inside each Spark
partition DuckDB holds one row per token position of the words not yet known;
a recursive query joins adjacent tokens to the merge table and contracts each
word's leftmost pair of minimum rank until no pair of it can merge.  Ids come
out of an ordered aggregation, and decoding is an ordered aggregation of the
bytes that the ids stand for.  Words found before are answered from a bounded
cache of the Python worker.

A word of more than ``LONG_WORD`` bytes would take as many rounds as it has
bytes, so it is contracted by a heap over the same merge table instead; the
result is the same (leftmost minimum rank first).

Defined cases: a null or empty text has no tokens; repeated rows and null ids
give a row each.  Only the id and text columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import tokens
from shoplens.llm.common import kept_by_worker, text_or_empty
from shoplens.session import ship_package

LONG_WORD = 256
#: Words contracted in one query: bounds its memory.
WORDS_A_QUERY = 50_000

# A place is word * 1024 + position: one sort gives the order inside all words.
ENCODE = """
WITH RECURSIVE steps AS (
  SELECT place, token, false AS done FROM start
  UNION ALL
  SELECT place, CASE WHEN candidate = best THEN CAST(best >> 10 AS INTEGER) ELSE token END, best IS NULL
  FROM (
    SELECT place, token, candidate, before, min(candidate) OVER (PARTITION BY place >> 10) AS best
    FROM (
      SELECT place, token, before, (CAST(rank AS BIGINT) << 10) | (place & 1023) AS candidate
      FROM (
        SELECT place, token, lag(place) OVER by_place AS before,
               CASE WHEN lead(place) OVER by_place >> 10 = place >> 10
                    THEN (CAST(token AS BIGINT) << 32) | lead(token) OVER by_place END AS two
        FROM steps WHERE NOT done
        WINDOW by_place AS (ORDER BY place)
      ) LEFT JOIN merges ON merges.pair = two
    )
  )
  WHERE best IS NULL OR before IS NULL OR before <> ((place >> 10 << 10) | (best & 1023))
)
SELECT place >> 10 AS word, list(token ORDER BY place) AS ids FROM steps WHERE done GROUP BY place >> 10 ORDER BY 1
"""

# Bytes are spelt as characters 0 to 255, which SQL can join in order.
DECODE = """
SELECT word, string_agg(spelling, '' ORDER BY place) AS spelling
FROM coded JOIN vocabulary USING (token) GROUP BY word ORDER BY word
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_table(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left id, right id, merged id) of every pair of tokens that makes a token."""
    return [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items()
            for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]


class BpeEngine:
    """DuckDB with the merge table and vocabulary of one rank file."""

    def __init__(self, path: str):
        import duckdb

        self.ranks = load_ranks(path)
        merges = merge_table(self.ranks)
        self.merged = {(a, b): r for a, b, r in merges}
        self.spelt = {r: t for t, r in self.ranks.items()}
        self.first = [self.ranks[bytes([b])] for b in range(256)]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": tempfile.gettempdir()})
        self._load("merges", pa.table({"pair": pa.array([a << 32 | b for a, b, _ in merges], pa.int64()),
                                       "rank": pa.array([r for _, _, r in merges], pa.int32())}))
        self._load("vocabulary", pa.table({"token": pa.array(self.spelt, pa.int32()),
                                           "spelling": [t.decode("latin-1") for t in self.spelt.values()]}))

    def _load(self, name: str, rows: pa.Table) -> None:
        self.con.register("incoming", rows)
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        out = [b""] * len(words)
        todo = []
        for k, w in enumerate(words):
            if w in self.ranks:
                out[k] = self.ranks[w].to_bytes(4, "little")
            elif len(w) > LONG_WORD:
                out[k] = tokens.packed(self.contract(w))
            elif w:
                todo.append(k)
        for at in range(0, len(todo), WORDS_A_QUERY):
            part = todo[at:at + WORDS_A_QUERY]
            ids, ends = self._query([words[k] for k in part])
            raw = ids.tobytes()
            for k, i, j in zip(part, [0, *ends], ends):
                out[k] = raw[4 * i:4 * j]
        return out

    def _query(self, words: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """All ids one after the other, and where those of each word end."""
        lengths = np.array([len(w) for w in words])
        joined = np.frombuffer(b"".join(words), dtype=np.uint8)
        starts = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        self._load("start", pa.table({"place": word << 10 | np.arange(len(joined)) - np.repeat(starts, lengths),
                                      "token": np.array(self.first, dtype=np.int32)[joined]}))
        got = self.con.sql(ENCODE).to_arrow_table().column("ids").combine_chunks()
        ends = np.cumsum(pa.compute.list_value_length(got).to_numpy(zero_copy_only=False)).tolist()
        return got.flatten().to_numpy(zero_copy_only=False).astype("<u4"), ends

    def _contracted(self, words: list[bytes]) -> list[list[int]]:
        ids, ends = self._query(words)
        return [ids[i:j].tolist() for i, j in zip([0, *ends], ends)]

    def contract(self, word: bytes) -> list[int]:
        """One long word, by a heap of (rank, place) over linked neighbours."""
        token = [self.first[b] for b in word]
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k) for k in range(n - 1) if (r := self.merged.get((token[k], token[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            j = after[k]
            # A place whose pair changed meanwhile has another entry for it.
            if token[k] < 0 or j >= n or self.merged.get((token[k], token[j])) != r:
                continue
            token[k], token[j] = r, -1
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            for left in (before[k], k):
                right = after[left] if left >= 0 else n
                if right < n and (x := self.merged.get((token[left], token[right]))) is not None:
                    heapq.heappush(heap, (x, left))
        return [t for t in token if t >= 0]

    def decode(self, coded: list[bytes]) -> list[bytes]:
        """Bytes that the ids of each word stand for."""
        out = [b""] * len(coded)
        for at in range(0, len(coded), WORDS_A_QUERY):
            part = coded[at:at + WORDS_A_QUERY]
            ids = np.frombuffer(b"".join(part), dtype="<u4").astype(np.int32)
            if not len(ids):
                continue
            word = np.repeat(np.arange(len(part)), [len(x) // 4 for x in part])
            self._load("coded", pa.table({"word": word, "place": np.arange(len(ids)), "token": ids}))
            rows = self.con.sql(DECODE).to_arrow_table()
            for k, x in zip(rows.column("word").to_pylist(), rows.column("spelling").to_pylist()):
                out[at + k] = x.encode("latin-1")
        return out


def bpe_cache(path: str, pattern: str) -> tokens.PieceCache:
    """Piece -> (ids, bytes decoded from the ids); kept by the Python worker."""

    def make() -> tokens.PieceCache:
        engine = BpeEngine(path)

        def encode(words: list[str]) -> list[tuple[bytes, bytes]]:
            ids = engine.encode([w.encode("utf-8", "surrogatepass") for w in words])
            return list(zip(ids, engine.decode(ids)))

        def join(values: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
            return b"".join([a for a, _ in values]), b"".join([b for _, b in values])

        split = tokens.WordSplitter(tokens.split_words(pattern), True, whole=False)
        cache = tokens.PieceCache(tokens.by_words(encode, split, join=join), True)
        cache.empty = (b"", b"")
        return cache

    return kept_by_worker(("bpe", path), make)


ROWS = "doc_id long, n_tokens long, ids binary, decoded binary"


def encode_decode(path: str, pattern: str, digests: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = bpe_cache(path, pattern)
        for batch in stream:
            at = 0
            for texts in tokens.text_runs(batch.column(1)):
                ids, decoded = [], []
                for values in cache.lookup(texts):
                    a, b = zip(*values)
                    ids.append(b"".join(a))
                    decoded.append(b"".join(b))
                columns = [batch.column(0).slice(at, len(texts)), pa.array([len(x) // 4 for x in ids], pa.int64())]
                at += len(texts)
                if digests:
                    columns += [pa.array([hashlib.sha256(x).hexdigest() for x in v]) for v in (ids, decoded)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    columns += [pa.array(v, pa.binary()) for v in (ids, decoded)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           digests: bool = False) -> DataFrame:
    """Ids (little-endian unsigned 32-bit) of each text and the bytes they decode to;
    with ``digests`` the SHA-256 of both instead."""
    ship_package(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else ROWS
    return d.mapInArrow(encode_decode(path, pattern, digests), schema)
