"""URL filters by a bit-parallel wildcard automaton.

Glob rules are packed side by side into the bits of a few 64-bit words, one
bit per pattern position (multiword Shift-And).  Reading one character moves
every pattern of every url of a batch one step:

    D = ((D << 1) & B[c]) | (D & S[c])

``B[c]`` holds the positions that character ``c`` may enter, ``S[c]`` those
that a wildcard lets it stay in.  The bit before each pattern is its start, which
no character enters, so nothing leaks from one pattern to the next.

Globs: ``?`` is one character, ``*`` a run without ``/`` and ``?``, ``**``
any run, ``\\`` makes the next character plain.  A glob must fit the whole canonical url:
a dot, the host in lower case (A-Z only), the path as it stands, and the query
with its question mark; scheme and fragment are left out.  The dot lets
``*.example.org/`` fit the host and its subdomains alike.

Defined cases: a null url and one without ``://`` have an empty host and path and
the canonical url ``.``, which only a glob made for it fits.  Repeated rows are
judged each on its own, an empty table gives an empty one, and an url may have
any length (memory holds the characters of a batch, not a padded matrix).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.session import ship_package

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class GlobRule:
    """A glob and its verdict.  Of the rules that fit, the lowest ``rank`` wins,
    then the longest glob, then block before allow, then the first listed."""

    glob: str
    verdict: str
    name: str | None = None
    rank: int = 0


def plain(text: str) -> str:
    """``text`` as a glob of plain characters."""
    return "".join("\\" + c if c in "?*\\" else c for c in text)


def site_rule(verdict: str, host: str, path: str) -> GlobRule:
    """Fits the host and its subdomains where the path starts with ``path``."""
    return GlobRule(f"*.{plain(host)}{plain(path)}**", verdict, host + path)


def host_words(verdict: str, words: Iterable[str], rank: int = 1) -> list[GlobRule]:
    """Rules that fit a host with one of the words in it, whatever follows.

    Two globs each, as a host may end the url or be followed by ``/`` or ``?``.
    """
    return [GlobRule(g, verdict, None, rank) for w in words for g in (f"*{plain(w)}*", f"*{plain(w)}*/**", f"*{plain(w)}*\\?**")]


#: Words in host names that the method's own rules block (fixed values).
BLOCKED_HOST_WORDS = ("spam", "cheap-pills", "casino", "viagra", "porn", "xxx-", "payday-loan", "phishing", "malware")


def _elements(glob: str) -> list[tuple[str, str]]:
    """(kind, character): kinds are char, any, run and all."""
    out, k = [], 0
    while k < len(glob):
        c = glob[k]
        if c == "\\" and k + 1 < len(glob):
            out.append(("char", glob[k + 1]))
            k += 2
        elif glob.startswith("**", k):
            out.append(("all", ""))
            k += 2
        else:
            out.append(({"*": "run", "?": "any"}.get(c, "char"), c))
            k += 1
    return out


class ShiftAnd:
    """All globs as one automaton of ``words`` 64-bit words."""

    def __init__(self, globs: list[str]):
        start, final, enter_any, at = 0, [], 0, 0
        enter: dict[str, int] = {}
        stay_all = stay_run = 0
        for glob in globs:
            start |= 1 << at
            for kind, c in _elements(glob):
                if kind == "all":
                    stay_all |= 1 << at
                elif kind == "run":
                    stay_run |= 1 << at
                else:
                    at += 1
                    if kind == "any":
                        enter_any |= 1 << at
                    else:
                        enter[c] = enter.get(c, 0) | 1 << at
            final.append(at)
            at += 1
        self.words = max(1, -(-at // 64))
        self.final = final
        self.start = self._split(start)
        # Characters of the patterns get classes from 1 on; class 0 is any other.
        self.alphabet = np.array(sorted({ord(c) for c in enter} | {ord("/"), ord("?")}), dtype=np.uint32)
        masks = [(enter_any, stay_all | stay_run)]
        for code in self.alphabet:
            c = chr(code)
            masks.append((enter_any | enter.get(c, 0), stay_all if c in "/?" else stay_all | stay_run))
        self.enter = np.stack([self._split(e) for e, _ in masks])
        self.stay = np.stack([self._split(s) for _, s in masks])

    def _split(self, bits: int) -> np.ndarray:
        return np.array([bits >> (64 * w) & 0xFFFFFFFFFFFFFFFF for w in range(self.words)], dtype=np.uint64)

    def classes(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.alphabet, codes)
        at[at == len(self.alphabet)] = 0
        return np.where(self.alphabet[at] == codes, at + 1, 0)

    def run(self, texts: list[str]) -> np.ndarray:
        """Final states, one row of words per text."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        classes = self.classes(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
        begins = np.concatenate([[0], np.cumsum(lengths)])[:-1][order]
        lengths = lengths[order]
        d = np.repeat(self.start[None, :], len(texts), axis=0)
        alive = len(texts)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            while lengths[alive - 1] <= step:  # longest first: those that ended are at the back
                alive -= 1
            c = classes[begins[:alive] + step]
            now = d[:alive]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            d[:alive] = (moved & self.enter[c]) | (now & self.stay[c])
        out = np.empty_like(d)
        out[order] = d
        return out


def parts(url: str | None) -> tuple[str, str, str]:
    """(host, path, query with its question mark) of an url."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", ""
    rest = rest.partition("#")[0]
    before, asks, query = rest.partition("?")
    host, slash, path = before.partition("/")
    return host.translate(_LOWER), slash + path, asks + query


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def judge_urls(df: DataFrame, rules: list[GlobRule], id_col: str = "page_id", url_col: str = "url",
               default: str = ALLOW) -> DataFrame:
    """One row per row: the id, host, path, rule (name of the deciding rule, else
    null), glob (that rule's glob, else null) and verdict (``default`` if no rule fits).

    No shuffle: the rules travel with the function, urls stay where they are.
    """
    ship_package(df.sparkSession)
    ranked = sorted(rules, key=lambda r: (r.rank, -len(r.glob), r.verdict != BLOCK))
    machine = ShiftAnd([r.glob for r in ranked])

    def judge(urls: pd.Series) -> pd.DataFrame:
        split = [parts(u) for u in urls]
        state = machine.run([f".{h}{p}{q}" for h, p, q in split])
        best = np.full(len(split), -1)
        for k in range(len(ranked) - 1, -1, -1):  # the winner writes last
            word, bit = divmod(machine.final[k], 64)
            best[(state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1] = k
        pick = [ranked[k] if k >= 0 else None for k in best]
        return pd.DataFrame({
            "host": [h for h, _, _ in split], "path": [p for _, p, _ in split],
            "rule": pd.Series([r.name if r else None for r in pick], dtype=object),
            "glob": pd.Series([r.glob if r else None for r in pick], dtype=object),
            "verdict": [r.verdict if r else default for r in pick]})

    fields = "host string, path string, rule string, glob string, verdict string"
    judged = F.pandas_udf(judge, fields)
    return (df.select(F.col(id_col).alias("_id"), judged(F.col(url_col)).alias("_j"))
            .select(F.col("_id").alias(id_col), "_j.*"))
