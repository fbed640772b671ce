"""Splitting texts into chunks that tokenise on their own, and a bounded cache.

In the byte-level patterns a single space between two non-blank characters
always starts a new token, so a text cut there gives the same ids piece by
piece.  Texts repeat most pieces: the pieces of a run of texts are
dictionary-encoded by Arrow, each distinct one is looked up once in a dictionary
that the worker keeps, and only unknown ones reach the tokeniser, cut into
words.  When the dictionary has ``LIMIT`` entries it keeps its first half,
where the frequent pieces are, so memory stays bounded.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shoplens.llm.common import kept_by_worker

LIMIT = 600_000
#: Pieces longer than this are not kept.
LONG = 64

#: A text with none of these is cut at every space (RE2).
_UNEVEN = r"  | \n|\n |^ | $|[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CUT = re.compile(r"(?<=\S) (?=\S)")


def spaced_pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces of each text, one after the other, and how many each has.

    All but the first piece of a text had one space before them, and joining with
    one space gives the text back.  A first piece is marked by a space
    before it, which cannot start another piece.
    """
    uneven = pc.match_substring_regex(column, _UNEVEN).to_numpy(zero_copy_only=False)
    even = pc.split_pattern(column.filter(pa.array(~uneven)), " ")
    counts = np.zeros(len(column), dtype=np.int64)
    counts[~uneven] = pc.list_value_length(even).to_numpy(zero_copy_only=False)
    cut = [_CUT.split(t) for t in column.filter(pa.array(uneven)).to_pylist()]
    counts[uneven] = [len(c) for c in cut]
    flat = pa.concat_arrays([even.flatten(), pa.array(list(chain.from_iterable(cut)), pa.large_string())])
    # Even texts first, the others behind them: back to the order of the rows.
    order = np.argsort(np.concatenate([np.flatnonzero(~uneven), np.flatnonzero(uneven)]), kind="stable")
    if uneven.any() and not uneven.all():
        sizes = np.concatenate([counts[~uneven], counts[uneven]])
        begins = (np.cumsum(sizes) - sizes)[order]
        flat = flat.take(pa.array(np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())))
    return flat, counts


def bare_pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces between blanks, for tokenisers that drop white space and case.

    Texts of Latin-1 letters are lower-cased at once: there every character
    has its own lower case, whatever stands beside it.
    """
    beyond = pc.match_substring_regex(column, r"[^\x00-\x{ff}]")
    column = pc.if_else(beyond, column, pc.utf8_lower(column))
    for blank in "\n\t\r":
        column = pc.replace_substring(column, blank, " ")
    lists = pc.split_pattern(column, " ")
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def is_latin1(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def packed(ids: Iterable[int]) -> bytes:
    ids = list(ids)
    return struct.pack(f"<{len(ids)}I", *ids)


def trim(known: dict, limit: int) -> None:
    """Halves a full dictionary; what came first, so what is frequent, stays."""
    if len(known) > limit:
        first = dict(islice(known.items(), limit // 2))
        known.clear()
        known.update(first)


class PieceCache:
    """Ids (little-endian unsigned 32-bit) of texts, piece by piece.

    ``encode`` turns a list of strings into a list of byte strings.
    """

    def __init__(self, encode: Callable[[list[str]], list], spaced: bool, limit: int = LIMIT):
        self.encode, self.spaced, self.limit = encode, spaced, limit
        self.known: dict[str, object] = {}

    def _original(self, piece: str) -> str:
        if not self.spaced:
            return piece
        return piece[1:] if piece[:1] == " " else " " + piece

    def lookup(self, texts: list[str] | pa.Array) -> list[list]:
        """For each text the values of its pieces."""
        known = self.known
        trim(known, self.limit)
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        flat, counts = (spaced_pieces if self.spaced else bare_pieces)(column)
        ends = np.cumsum(counts)
        if self.spaced:
            at = ends - counts
            first = [" " + p for p in flat.take(pa.array(at)).to_pylist()]
            flat = pa.concat_arrays([flat, pa.array(first, pa.large_string())])
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        if self.spaced:
            codes = codes.copy()
            codes[at] = codes[len(codes) - len(at):]
        distinct = coded.dictionary.to_pylist()
        known[""] = self.empty
        values = list(map(known.get, distinct))
        holes = [k for k, v in enumerate(values) if v is None]
        for k, v in zip(holes, self.encode([self._original(distinct[k]) for k in holes]) if holes else ()):
            values[k] = v
            if len(distinct[k]) <= LONG:
                known[distinct[k]] = v
        rows, at = [], 0
        for end in ends.tolist():
            rows.append([values[c] for c in codes[at:end].tolist()])
            at = end
        return rows

    empty: object = b""

    def ids(self, texts: list[str] | pa.Array) -> list[bytes]:
        return [b"".join(v) for v in self.lookup(texts)]


def library_encoder(path: str, spaced: bool, words: Words | None = None, limit: int = LIMIT) -> PieceCache:
    """Cache over a tokeniser file; special tokens' strings are ordinary text.

    Kept by the Python worker: later tasks of the worker find it filled.  With
    ``words``, by the file's own pattern, an unknown piece is cut into its words and
    only unknown words reach the library.
    """

    def make() -> PieceCache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True

        def encode(pieces: list[str]) -> list[bytes]:
            return [packed(e.ids) for e in t.encode_batch_fast(pieces, add_special_tokens=False)]

        if words:
            by_piece = by_words(WordRuns(t, spaced, encode), WordSplitter(words, spaced), limit)
        return PieceCache(by_piece if words else encode, spaced, limit)

    return kept_by_worker(("library", path, spaced, limit), make)


class WordRuns:
    """Ids of single words by the library, many words to a call.

    Words that follow each other as they may in a text are encoded as one
    string; the ids are told apart by the tokens that begin a word (spaced) or end
    one.  Other words are encoded one by one.
    """

    WORDS = 1000

    def __init__(self, tokenizer, spaced: bool, encode: Callable[[list[str]], list[bytes]]):
        vocabulary = tokenizer.get_vocab()
        self.tokenizer, self.spaced, self.encode = tokenizer, spaced, encode
        self.edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, k in vocabulary.items():
            self.edge[k] = token.startswith("Ġ") if spaced else token.endswith("</w>")

    def __call__(self, words: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(words)
        joins = [k for k, w in enumerate(words) if is_latin1(w) and not _INNER.search(w, 1)
                 and (w[:1] == " " and len(w) > 1 if self.spaced else not _INNER.match(w))]
        groups = [joins[k:k + self.WORDS] for k in range(0, len(joins), self.WORDS)]
        for at in range(0, len(groups), 16):
            some = groups[at:at + 16]
            joined = [("" if self.spaced else " ").join([words[k] for k in g]) for g in some]
            for group, e in zip(some, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
                ids = np.array(e.ids, dtype="<u4")
                marks = np.flatnonzero(self.edge[ids])
                ends = np.append(marks[1:], len(ids)) if self.spaced else marks + 1
                if len(ends) == len(group):
                    raw, ends = ids.tobytes(), (4 * ends).tolist()
                    for k, i, j in zip(group, [0, *ends], ends):
                        out[k] = raw[i:j]
        rest = [k for k, v in enumerate(out) if v is None]
        for k, v in zip(rest, self.encode([words[k] for k in rest]) if rest else ()):
            out[k] = v
        return out


class WordSplitter:
    """Cuts pieces into the words of a tokeniser's pattern, many pieces at once."""

    def __init__(self, words: Words, spaced: bool, whole: bool = True):
        self.spaced, self.whole, self.words = spaced, whole, words
        self.lines = Words(words.pattern + r"|\n")

    def __call__(self, pieces: list[str]) -> list[list[str]]:
        """Words of each piece.  Beyond Latin-1 a piece stays ``whole``: a library may
        compose characters before it splits.  Bare pieces are lower-cased first."""
        out: list[list[str]] = [[p] for p in pieces]
        latin = [k for k, p in enumerate(pieces) if not self.whole or is_latin1(p)]
        plain = [k for k in latin if not _INNER.search(pieces[k], 1) and (pieces[k][:1] == " " and len(pieces[k]) > 1 or not self.spaced)]
        cut = self._spaced([pieces[k] for k in plain]) if self.spaced else self._bare([pieces[k].lower() for k in plain])
        if cut is None:
            plain, cut = [], []
        for k, words in zip(plain, cut):
            out[k] = words
        for k in set(latin).difference(plain):
            out[k] = self.words(pieces[k] if self.spaced else pieces[k].lower())
        return out

    def _spaced(self, pieces: list[str]) -> list[list[str]] | None:
        flat = self.words("".join(pieces))
        starts = [k for k, w in enumerate(flat) if w[0] == " "]
        return [flat[i:j] for i, j in zip(starts, [*starts[1:], len(flat)])] if len(starts) == len(pieces) else None

    def _bare(self, pieces: list[str]) -> list[list[str]] | None:
        flat = self.lines("\n".join(pieces))
        ends = [k for k, w in enumerate(flat) if w == "\n"] + [len(flat)]
        return [flat[i:j] for i, j in zip([0, *[k + 1 for k in ends]], ends)] if len(ends) == len(pieces) else None


#: White space and controls inside a piece that keep it from being joined with others.
_INNER = re.compile(r"[\s\x1c-\x1f\x85\xa0]")


def by_words(encode: Callable[[list[str]], list], split: Callable[[list[str]], list[list[str]]],
             limit: int = LIMIT, join: Callable[[list], object] = b"".join) -> Callable[[list[str]], list]:
    """``encode`` of pieces through a second bounded cache of their words."""
    known: dict[str, object] = {}

    def run(pieces: list[str]) -> list:
        trim(known, limit)
        cut = split(pieces)
        flat = list(chain.from_iterable(cut))
        values = list(map(known.get, flat))
        todo = list(dict.fromkeys([w for w, v in zip(flat, values) if v is None]))
        new = dict(zip(todo, encode(todo) if todo else ()))
        known.update((w, v) for w, v in new.items() if len(w) <= LONG)
        values = [new[w] if v is None else v for w, v in zip(flat, values)]
        out, at = [], 0
        for words in cut:
            out.append(values[at] if len(words) == 1 else join(values[at:at + len(words)]))
            at += len(words)
        return out

    return run


#: White space as the tokeniser libraries know it (fixed value): unlike
#: Python's, theirs leaves out the separators 28 to 31.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class Words:
    """The words of a text by a pattern, in which white space is ``SPACE``."""

    def __init__(self, pattern: str):
        import regex

        self.pattern = pattern
        inside = re.sub(r"\[\^\\s", lambda _: "[^" + SPACE, pattern)
        self.found = regex.compile(inside.replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")).findall

    def __call__(self, text: str) -> list[str]:
        return self.found(text)


def split_words(pattern: str) -> Words:
    return Words(pattern)


def text_runs(column: pa.Array, size: int = 8_000_000) -> Iterable[pa.Array]:
    """Slices of a column of texts of about ``size`` bytes in all (one text at least)."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        limit = (ends[at - 1] if at else 0) + size
        end = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
        yield column.slice(at, end - at)
        at = end
