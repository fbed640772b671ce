"""Jaccard join of word n-grams by signature trees.

A text is the set of its five-word shingles (64-bit hashes).  Texts with equal
sets are one class, kept by one member.  Two classes link when their Jaccard
similarity reaches the threshold t; the components of the links are returned.

1. *Which sets can share enough.*  In the order of the hashes, two linked sets
   share at least the shorter extension among their first ``n - ceil(t n) +
   n / 12 + 1`` hashes.  Only these go through a shuffle; a set with too few
   hashes that occur in any other set has no link at all.  The most frequent of
   a set's shared hashes, fewer than the extension, can also be left out.
2. *Groups.*  The sets that share a hash which is left are joined to one of
   them; components of these pairs are groups that no link can cross.  A group
   beyond the block size is split again by the whole sets: linked ones share at
   least ``ceil(t n)`` hashes, so a set with fewer in its group goes, and all but
   ``ceil(t n) - 1`` of the rarest stay.  What many texts quote splits here.
3. *Signature trees.*  Each group is a tree whose nodes hold the OR of their
   sets' bitmaps and the range of their sizes.  A dual traversal drops pairs of
   nodes whose largest possible overlap is too small, skips sets already
   connected, and compares what is left exactly.  Small groups share a task;
   a group still beyond the block size is dealt to blocks, and each pair of blocks
   is a task, so no task grows with the group and no pair is lost.  The pairs go
   in waves of bounded copies; a group that is one component needs no more.

Copies are never expanded into pairs, and a large group of near copies needs
few comparisons, as sets of one component are not compared again.

Defined cases: null or empty texts, or texts without words, have no set, link
with nothing and are their own component; null ids link like others but are
never the smallest; repeated rows give a row each.  Only the named columns are
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import let_go, stored, text_or_empty, with_maybe
from shoplens.llm.components import connected_components
from shoplens.session import ship_package

WIDTH = 5
#: Shingles in a block of sets: bounds a task's memory.
BLOCK = 400_000
BITS = 4096
#: Bits of the filter of classes to read again: 8 MB for any corpus.
FILTER_BITS = 1 << 26
LEAF = 32


def shingler(width: int = WIDTH) -> Callable[[str], object]:
    """Function from a text to its sorted distinct shingle hashes (uint64)."""
    import numpy as np
    import xxhash

    let_go()
    digest = xxhash.xxh64_intdigest  # faster than a look into a table of known words
    odd = np.array([(0x9E3779B97F4A7C15 * (2 * k + 3) | 1) & (2**64 - 1) for k in range(width)], dtype=np.uint64)

    def run(text: str):
        # Bytes: lower() touches A-Z only and split() takes space and 9 to 13.
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        h = np.array([digest(w) for w in words], dtype=np.uint64)
        h ^= h >> np.uint64(29)
        n = max(1, len(h) - width + 1)
        s = np.full(n, min(len(h), width), dtype=np.uint64)
        for k in range(min(width, len(h))):
            s += h[k:k + n] * odd[k]
        s ^= s >> np.uint64(32)
        s *= np.uint64(0xD6E8FEB86659FD93)
        s ^= s >> np.uint64(32)
        s.sort()
        return s[np.concatenate(([True], s[1:] != s[:-1]))]

    return run


def prefix_length(n: int, t_num: int, t_den: int) -> int:
    """First hashes of a set of n that must hold ``n // 12 + 1`` shared ones."""
    return min(n, n - -(-t_num * n // t_den) + n // 12 + 1)


def class_key(hashes) -> int:
    """64 bits of a digest of the set, as a signed number."""
    import hashlib

    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def class_rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, doc_id, key) -> (doc_id, key, n, cid)."""
    shingles = shingler()
    for batch in stream:
        sets = [shingles(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([class_key(s) if len(s) else None for s in sets], pa.int64())],
            names=["doc_id", "key", "n", "cid"])


def wanted_texts(batch: pa.RecordBatch, bits) -> list:
    """Texts of (text, b1, b2) whose two bits are set."""
    import numpy as np

    ok = np.ones(batch.num_rows, dtype=bool)
    for b in (batch.column(1).to_numpy(), batch.column(2).to_numpy()):
        ok &= (bits[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) == 1
    return batch.column(0).filter(pa.array(ok)).to_pylist()


def token_rows(length: Callable[[int], int], wanted: bytes | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text), or (text, b1, b2) with bits ``wanted`` -> (token, cid, n) of the first
    ``length(n)`` hashes of each set, once per set and task."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        shingles, seen = shingler(), set()
        bits = None if wanted is None else np.frombuffer(wanted, dtype=np.uint64)
        tokens: list = []
        owners: list = []
        sizes: list = []

        def batch() -> pa.RecordBatch:
            counts = [len(t) for t in tokens]
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(owners, np.int64), counts)),
                 pa.array(np.repeat(np.array(sizes, np.int32), counts))], names=["token", "cid", "n"])
            for x in (tokens, owners, sizes):
                x.clear()
            return out

        total = 0
        for texts in stream:
            for text in texts.column(0).to_pylist() if bits is None else wanted_texts(texts, bits):
                s = shingles(text)
                if not len(s):
                    continue
                cid = class_key(s)
                if cid in seen:
                    continue
                if len(seen) > 300_000:
                    seen.clear()
                seen.add(cid)
                tokens.append(s[:length(len(s))])
                owners.append(cid)
                sizes.append(len(s))
                total += len(tokens[-1])
                if total >= 100_000:
                    yield batch()
                    total = 0
        if tokens:
            yield batch()

    return run


def set_rows(wanted: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text, b1, b2) -> (cid, hashes) of the rows whose two bits are wanted."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        shingles, bits = shingler(), np.frombuffer(wanted, dtype=np.uint64)
        for batch in stream:
            sets = [shingles(t) for t in wanted_texts(batch, bits)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_key(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
                names=["cid", "hashes"])

    return run


def key_bits(key: Column) -> tuple[Column, Column]:
    return F.pmod(key, F.lit(FILTER_BITS)), F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def key_filter(keys: DataFrame) -> bytes:
    """A Bloom filter of the column ``h``, of fixed size whatever the keys.

    It spares most texts the way to the join on classes that follows; what it
    lets through beside is dropped there.
    """
    import numpy as np

    bits = keys.select(F.explode(F.array(*key_bits(F.col("h")))).alias("b"))
    words = (bits.groupBy(F.shiftright("b", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v")).toArrow())
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return out.tobytes()


# --- signature trees --------------------------------------------------------

class SignatureTree:
    """Binary tree over sets: OR of bitmaps, size range, most hashes beyond bits."""

    def __init__(self, sets: list, order: list[int]):
        import numpy as np

        self.sets, self.order = sets, np.array(order)
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        bits = np.zeros((len(sets), BITS), dtype=bool)
        for k, s in enumerate(sets):
            bits[k, (s % np.uint64(BITS)).astype(np.int64)] = True
        self.bits = np.packbits(bits, axis=1).view(np.uint64)
        self.excess = self.size - np.bitwise_count(self.bits).sum(axis=1).astype(np.int64)
        self.nodes: list[tuple] = []
        self.root = self._build(0, len(order))

    def _build(self, lo: int, hi: int) -> int:
        import numpy as np

        at = self.order[lo:hi]
        if hi - lo <= LEAF:
            node = (lo, hi, -1, -1, np.bitwise_or.reduce(self.bits[at], axis=0), self.size[at].min(), self.excess[at].max())
        else:
            mid = (lo + hi) // 2
            a, b = self._build(lo, mid), self._build(mid, hi)
            x, y = self.nodes[a], self.nodes[b]
            node = (lo, hi, a, b, x[4] | y[4], min(x[5], y[5]), max(x[6], y[6]))
        self.nodes.append(node)
        return len(self.nodes) - 1


def tree_links(sets: list, sides: list[int] | None, t_num: int, t_den: int, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect what is linked among ``sets``; with ``sides`` (0 or 1)
    only sets of different sides are compared, with ``known`` only those of
    different known components."""
    import numpy as np

    n = len(sets)
    first: dict[int, int] = {}
    parent = list(range(n)) if known is None else [first.setdefault(c, k) for k, c in enumerate(known)]

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # Sets that start alike stand together, so nodes' bitmaps stay sparse.
    by = lambda k: (int(sets[k][0]), len(sets[k]))
    groups = [sorted(range(n), key=by)] if sides is None else [sorted((k for k in range(n) if sides[k] == s), key=by) for s in (0, 1)]
    if not all(groups):
        return []
    trees = [SignatureTree(sets, g) for g in groups]
    a_tree, b_tree = trees[0], trees[-1]
    total = t_num + t_den  # overlap * total >= t_num * (sum of sizes)
    out: list[tuple[int, int]] = []
    todo = [(a_tree.root, b_tree.root)]
    while todo:
        i, j = todo.pop()
        a, b = a_tree.nodes[i], b_tree.nodes[j]
        most = int(np.bitwise_count(a[4] & b[4]).sum()) + min(a[6], b[6])
        if most * total < t_num * (a[5] + b[5]):
            continue
        if a[2] >= 0 or b[2] >= 0:
            if sides is None and i == j:
                todo += [(a[2], a[3]), (a[2], a[2]), (a[3], a[3])]
            elif b[2] < 0 or (a[2] >= 0 and a[1] - a[0] >= b[1] - b[0]):
                todo += [(a[2], j), (a[3], j)]
            else:
                todo += [(i, b[2]), (i, b[3])]
            continue
        xs, ys = a_tree.order[a[0]:a[1]], b_tree.order[b[0]:b[1]]
        x_root, y_root = np.array([find(k) for k in xs]), np.array([find(k) for k in ys])
        apart = x_root[:, None] != y_root[None, :]
        if sides is None and i == j:
            apart = np.triu(apart, 1)
        if not apart.any():
            continue
        p, q = np.nonzero(apart)
        x, y = xs[p], ys[q]
        common = np.bitwise_count(a_tree.bits[x] & a_tree.bits[y]).sum(axis=1).astype(np.int64)
        possible = np.minimum(common + np.minimum(a_tree.excess[x], a_tree.excess[y]), np.minimum(a_tree.size[x], a_tree.size[y]))
        ok = possible * total >= t_num * (a_tree.size[x] + a_tree.size[y])
        for u, v in zip(x[ok].tolist(), y[ok].tolist()):
            ru, rv = find(u), find(v)
            if ru == rv:
                continue
            shared = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
            if shared * total >= t_num * (len(sets[u]) + len(sets[v])):
                parent[max(ru, rv)] = min(ru, rv)
                out.append((u, v))
    return out


def unit_links(t_num: int, t_den: int) -> Callable[[pa.Table], pa.Table]:
    """Rows (grp, bi, bj, side, cid, comp, hashes) of a task -> linked pairs (a, b)."""

    def run(rows: pa.Table) -> pa.Table:
        import numpy as np

        cids, sides, known = (rows.column(c).to_pylist() for c in ("cid", "side", "comp"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("hashes").to_pylist()]
        groups: dict[int, dict[tuple, int]] = {}
        for k, g in enumerate(rows.column("grp").to_pylist()):
            groups.setdefault(g, {}).setdefault((cids[k], sides[k]), k)  # a class counts once
        pairs = []
        for members in groups.values():
            at = list(members.values())
            own = [sides[k] for k in at]
            found = tree_links([sets[k] for k in at], own if any(own) else None, t_num, t_den, [known[k] for k in at])
            pairs += [(cids[at[u]], cids[at[v]]) for u, v in found]
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    return run


def token_groups(tokens: DataFrame, needed: Column) -> DataFrame:
    """(node, root): groups of the sets of ``tokens`` (token, cid, n) that no link crosses, if
    linked sets share at least ``needed`` of a set's tokens.

    Of the tokens that occur in another set, a set keeps the rarest, all but
    ``needed - 1``: the rarest that two linked sets share is kept by both.
    """
    in_token, in_set = Window.partitionBy("token"), Window.partitionBy("cid")
    shared = tokens.repartition("token").distinct().withColumn("df", F.count("*").over(in_token)).filter(F.col("df") > 1)
    shared = (shared.withColumn("k", F.count("*").over(in_set)).filter(F.col("k") >= needed)
              .withColumn("r", F.row_number().over(in_set.orderBy("df", "token")))
              .filter(F.col("r") <= F.col("k") - needed + 1).select("token", "cid"))
    shared = stored(shared, "shared-hashes", free=True)
    # Each set is joined to the least set of every hash.
    hubs = shared.groupBy("token").agg(F.min("cid").alias("hub"), F.count("*").alias("c")).filter(F.col("c") > 1)
    return connected_components(shared.join(hubs, "token").filter(F.col("cid") != F.col("hub"))
                                .select(F.col("cid").alias("a"), F.col("hub").alias("b")))


def weighed(one: DataFrame) -> DataFrame:
    """Members of groups with ``w``, the shingles of their group."""
    return one.join(one.groupBy("root").agg(F.sum("n").alias("w")), "root")


def waves(weights: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Ranges [lo, hi) of distances between blocks, given (blocks, shingles) of the groups.

    Block ``h`` of ``nb`` meets ``h + o`` (modulo ``nb``) at distance ``o``; half of the
    distances make all pairs.  A wave sends at most ``most`` shingles, or one distance.
    """
    top = max((nb for nb, _ in weights), default=1) // 2
    out, lo, sent = [], 0, 0
    for o in range(top + 1):
        cost = sum(w * (2 if o else 1) for nb, w in weights if 2 * o <= nb)
        if o > lo and sent + cost > most:
            out.append((lo, o))
            lo, sent = o, 0
        sent += cost
    return [*out, (lo, top + 1)]


def block_pairs(lo: int, hi: int) -> Column:
    """Array of (bi, bj, side) of a set in block ``home`` of ``nb``, for distances [lo, hi):
    the set stands on side 0 of (home, home + o) and on side 1 of (home - o, home)."""
    far = F.least(F.lit(hi - 1), F.floor(F.col("nb") / 2).cast("int"))
    home, nb = F.col("home"), F.col("nb")
    entry = lambda bi, bj, side: F.struct(bi.cast("int").alias("bi"), bj.cast("int").alias("bj"), F.lit(side).alias("side"))
    both = F.flatten(F.transform(F.sequence(F.lit(lo), far), lambda o: F.filter(
        F.array(entry(home, F.pmod(home + o, nb), 0), entry(F.pmod(home - o, nb), home, 1)),
        # At distance 0 there is one side; at half the blocks each pair comes twice.
        lambda e: ((o > 0) | (e["side"] == 0)) & ((2 * o < nb) | (e["bi"] < o) | (o == 0)))))
    return F.when(far >= lo, both)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", t_num: int = 3, t_den: int = 4,
                       block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, key, component) per row; the similarity is
    ``t_num / t_den``.  ``component`` is the same for the rows of one component, null ids or not."""
    ship_package(docs.sparkSession)
    d = docs.select(text_or_empty(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"),
                    F.xxhash64(text_or_empty(text_col)).alias("key"))
    members = stored(d.mapInArrow(class_rows, "doc_id long, key long, n long, cid long"), "classes", free=True)
    b1, b2 = key_bits(F.xxhash64("doc_id", "key"))
    bits = d.select("text", b1, b2)

    # 1., 2. Groups by hashes of the prefixes that occur in another set.
    prefixes = d.select("text").mapInArrow(token_rows(lambda n: prefix_length(n, t_num, t_den)), "token long, cid long, n int")
    groups = token_groups(prefixes, F.floor(F.col("n") * t_num / (12 * t_den)) + 1)
    one = (members.filter(F.col("cid").isNotNull()).groupBy("cid")
           .agg(F.min(F.struct("doc_id", "key")).alias("one"), F.first("n").alias("n")))
    one = groups.join(one, F.col("node") == F.col("cid")).select("cid", "root", "n", F.xxhash64("one.doc_id", "one.key").alias("h"))
    one = weighed(stored(one, "group-members", free=True))
    # Large ones again by the whole sets.
    large = stored(one.filter(F.col("w") > block), "large-groups", free=True)
    if not large.isEmpty():
        whole = bits.mapInArrow(token_rows(lambda n: n, key_filter(large)), "token long, cid long, n int")
        finer = token_groups(whole, F.ceil(F.col("n") * t_num / t_den)).withColumnRenamed("root", "part")
        large = large.join(finer, F.col("node") == F.col("cid")).select("cid", F.xxhash64("root", "part").alias("root"), "n", "h")
        one = weighed(stored(one.filter(F.col("w") <= block).select("cid", "root", "n", "h").unionByName(large), "group-members", free=True))

    # 3. Trees over the groups' sets, read again from one text of each class.
    dealt = stored(one.withColumn("nb", F.ceil(F.col("w") / block).cast("int"))
                   .withColumn("home", F.when(F.col("nb") > 1, F.pmod(F.xxhash64("cid", F.lit(3)), F.col("nb")))
                               .otherwise(F.lit(0)).cast("int"))
                   .select("cid", "root", "n", "h", "nb", "home", F.col("cid").alias("comp")), "group-blocks", free=True)
    weights = [(r.nb, r.w) for r in dealt.groupBy("nb").agg(F.sum("n").alias("w")).collect()]
    n_tasks = max(1, -(-sum(w for _, w in weights) // block))
    most = members.agg(F.sum("n")).first()[0] or 0
    links = None
    for lo, hi in waves(weights, most // 4):
        if lo:
            # What the waves before have connected is not compared again.
            dealt = dealt.drop("comp").join(linked, F.col("cid") == F.col("node"), "left").withColumn("comp", F.coalesce("part", "cid")).drop("node", "part")
            apart = dealt.groupBy("root").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter(F.col("x") != F.col("y")).select("root")
            dealt = stored(dealt.filter(F.col("nb") >= 2 * lo).join(apart, "root"), "group-blocks", free=True)
            if dealt.isEmpty():
                break
        sets = bits.mapInArrow(set_rows(key_filter(dealt)), "cid long, hashes binary")
        spread = (sets.join(dealt, "cid").withColumn("p", F.explode(block_pairs(lo, hi)))
                  .select(F.col("root").alias("grp"), "p.bi", "p.bj", "p.side", "cid", "comp", "hashes",
                          F.when(F.col("nb") > 1, F.xxhash64("root")).otherwise(F.pmod(F.xxhash64("root", F.lit(5)), F.lit(n_tasks))).alias("task")))
        found = stored(spread.groupBy("task", "bi", "bj").applyInArrow(unit_links(t_num, t_den), "a long, b long"), "links", free=True)
        links = found if links is None else links.unionByName(found)
        linked = connected_components(links).withColumnRenamed("root", "part")

    # Smallest id by class, then by component; copies are combined on the map side.
    roots = (members.filter(F.col("cid").isNotNull()).groupBy("cid").agg(F.min("doc_id").alias("least"))
             .join(linked, F.col("cid") == F.col("node"), "left").select("cid", "least", F.coalesce("part", "cid").alias("root")))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select(F.col("cid").alias("class_id"), "component_id", F.col("root").alias("component"))
    return (members.join(named, F.col("cid") == F.col("class_id"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.col("cid").alias("class_id"), "key", "component"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id.

    Rows without a set stay.  Ids count before nulls; among rows of the same
    least id (or of null ids alone) the one of the least class and text hash
    stays, and of equal (id, text) rows one.
    """
    found = stored(jaccard_components(docs, id_col, text_col), "components")
    # Rows that go, and rows that repeat one of the same id and text: the few
    # that need a decision.  All others are not shuffled.
    once = found.groupBy("doc_id", "key").agg(
        F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("class_id", "component_id", "component")])
    least = F.col("class_id").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id"))
    once = stored(once.withColumn("_least", least).filter(F.col("class_id").isNotNull()), "sets-once")
    # Different texts under the least id (or under null alone): one of them stays.
    rivals = (once.filter("_least").groupBy("component").agg(F.count("*").alias("_n"), F.min(F.struct("class_id", "key")).alias("_best"))
              .filter("_n > 1").select(F.col("component").alias("_c"), "_best"))
    once = once.join(rivals, F.col("component") == F.col("_c"), "left")
    stays = F.col("_least") & (F.col("_best").isNull() | (F.struct("class_id", "key") == F.col("_best")))
    unsure = stored(once.filter(~stays | (F.col("copies") > 1))
                    .select(F.xxhash64("doc_id", "key").alias("_uh"), F.col("doc_id").alias("_uid"), F.col("key").alias("_ukey"),
                            stays.alias("_stays")), "undecided")
    # The row travels as one struct, so no name of it can meet another.
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col(id_col).cast("long").alias("id"), F.xxhash64(text_or_empty(text_col)).alias("tk"))
    row = with_maybe(row.withColumn("_h", F.xxhash64("id", "tk")), "_h", unsure, "_uh", "_maybe")
    j = row.filter("_maybe").join(unsure, F.col("id").eqNullSafe(F.col("_uid")) & (F.col("tk") == F.col("_ukey")), "left")
    j = j.filter(F.coalesce("_stays", F.lit(True)))
    # Of equal rows the first stays; rows without a set all do.
    single = j.filter(F.col("_stays").isNotNull()).dropDuplicates(["id", "tk"])
    return (row.filter("not _maybe").select("row")
            .unionByName(j.filter(F.col("_stays").isNull()).select("row"))
            .unionByName(single.select("row")).select("row.*"))
