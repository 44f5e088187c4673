"""N-gram Jaccard join: near-copies linked exactly, by partitioning the universe of shingles.

A document's set is its distinct ``k``-word shingles.  Two sets of sizes x
and y with similarity of at least 3/4 differ in at most ``d = (x + y) / 7``
shingles.  The universe is cut into segments by hash, as many as the size
band asks for, so at most ``d`` of the segments can differ and at least
``segments - d`` subsets agree.  Every document ranks the signatures of its
segments by cost (no empty subsets, then none that only hold shingles known
to be frequent, then by hash) and indexes the ``d + 1`` cheapest; two
rankings that agree in ``segments - d`` members always share one among these.
In the smallest bands, where ``d`` is 1, the allocation takes one segment with one
deletion allowed: the set itself and the set less any one shingle.  Which
of the two a band uses follows from the rows that they would cost.

Signatures travel packed, one row per map task's stretch and hash part, and meet in
numpy.  A group of few members offers all its pairs.  Of a larger group
each member is offered with the group's first one (the one with the smallest
share of rare shingles, nearest to what the group has in common), links are
verified and components formed; in groups that still fall into several
components the sketches are compared across components, and only pairs
that they allow go on, so no group offers all its pairs.
Pairs are pruned by size and by a parity sketch (a lower bound on the
difference), then verified on the shingle hashes (64 bits).

Edge cases: null texts and texts without words have an empty set, link with
nothing and are their own component; texts of fewer words than ``k`` have one
shingle, the whole sequence; equal sets link whatever their size.  Repeated
rows (also of one doc_id) are documents with equal sets; a null doc_id
takes part, and a component's id is its smallest non-null one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import SPACE, materialize
from barspark.llm.components import components
from barspark.llm.tokens import Ranges, hash_words, lower_split, mix, stretches

_U = np.uint64
#: Words handled at a time; signatures gathered in a task before they are sent on.
PIECE, HELD = 200_000, 1_000_000
#: Groups up to this size offer all their pairs.
SMALL = 12
SKETCH = 512


def allowed(n: np.ndarray | int, m: np.ndarray | int):
    """Most shingles in which sets of sizes n and m may differ at a similarity of 3/4."""
    return (n + m) // 7


def allocation(band: int) -> tuple[int, bool]:
    """Segments of a size band (sizes 2**band to twice that, less 1) and whether one deletion is allowed.

    Rows of a document without deletions: ``d + 1``; with one deletion in
    each of ``(d + 1) / 2`` segments: as many more as it has shingles.  A
    signature's cost also holds the chance that it is no better than a single
    shingle or none, which falls off with the shingles in a segment.
    """
    low, high = 1 << band, (2 << band) - 1
    d = int(allowed(high, high * 4 // 3))
    single = 40.0  # what a signature of one shingle costs beside a row
    best = (0.0, 0, False)
    for segments, deletion in ((-(-(d + 1) // 2), True), (int(1.6 * (d + 1)) + 1, False)):
        held = low / segments
        rows = segments + low if deletion else d + 1
        weak = np.exp(-held) * (1 + held) if segments > 1 else 0.0  # at most one shingle
        cost = rows * (1 + single * weak) * (1 if not deletion or weak < 0.05 else 1e6)
        if not best[1] or cost < best[0]:
            best = (float(cost), segments, deletion)
    return best[1], best[2]


def shingle_sets(lists: list[list[bytes]], k: int):
    """Distinct shingle hashes of a batch: (document, hash) in order, and set sizes."""
    lengths = np.array([len(x) for x in lists], np.int64)
    h = hash_words([w for x in lists for w in x])
    first = np.concatenate([[0], np.cumsum(lengths)])
    rng = Ranges(h)
    count = np.where(lengths >= k, lengths - k + 1, np.minimum(lengths, 1))
    doc = np.repeat(np.arange(len(lists)), count)
    p = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + first[doc]
    s = rng.of(p, np.minimum(p + k, first[doc + 1]))
    order = np.lexsort((s, doc))
    doc, s = doc[order], s[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    doc, s = doc[new], s[new]
    return doc, s, np.bincount(doc, minlength=len(lists))


def _sum_by(doc, values, n):
    out = np.zeros(n, _U)
    if len(doc):
        at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        out[doc[at]] = np.add.reduceat(values, at)
    return out


def _sketches(doc: np.ndarray, s: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Parity sketches: as many bits as the set has members, rounded up to a power of two of at least SKETCH.

    Each member flips one bit, so two sketches differ in no more bits than
    the sets differ in members.  Halves of a sketch may be folded onto each other.
    """
    bits = np.maximum(SKETCH, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    first = np.cumsum(bits) - bits
    at = first[doc] + (mix(s ^ _U(77)) % bits[doc].astype(_U)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8))
    return [packed[f // 8:(f + b) // 8].tobytes() for f, b in zip(first, bits)]


def _difference(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the shorter one's length."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2:]
    return int.from_bytes((a ^ b).tobytes(), "little").bit_count()


def _summaries(k: int):
    """Per document: set size, set hashes and parity sketch; per stretch: shingles of three or more documents."""
    def run(it):
        for batch in it:
            for a, b, lists in stretches(batch.column("text"), PIECE, lower_split):
                doc, s, n = shingle_sets(lists, k)
                m = b - a
                u, c = np.unique(s, return_counts=True)
                u, c = u[c >= 3], c[c >= 3]
                heavy = [[] for _ in range(m)]
                heavy[0] = [{"s": int(x), "c": int(y)} for x, y in zip(u.view(np.int64), c)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, m), batch.column("th").slice(a, m), pa.array(n, pa.int64()),
                    pa.array(_sum_by(doc, mix(s), m).view(np.int64)), pa.array(_sum_by(doc, mix(s ^ _U(0x1234567)), m).view(np.int64)),
                    pa.array(_sketches(doc, s, n), pa.binary()),
                    pa.array(heavy, pa.list_(pa.struct([("s", pa.int64()), ("c", pa.int64())]))),
                ], ["doc_id", "th", "n", "s1", "s2", "sketch", "heavy"])
    return run


def signatures(doc: np.ndarray, s: np.ndarray, n: np.ndarray, frequent: np.ndarray):
    """Indexed signatures of a batch: (document, signature)."""
    out_doc, out_sig = [], []
    band_of = np.frexp(np.maximum(n, 1))[1] - 1
    low = np.isin(s, frequent)
    part = mix(s ^ _U(0x51ED27))
    for band in np.unique(band_of[n > 0]):
        for upper in (False, True):  # as a member of the band, and as the larger partner of one below it
            b = int(band) - upper
            if b < 1:
                continue
            want = (band_of == band) & (n * 3 < (4 << band)) if upper else band_of == band
            want &= n > 2
            d = allowed(n, (2 << b) - 1) if upper else allowed(n, n * 4 // 3)
            pick = want[doc]
            if not pick.any():
                continue
            dd, ss, ll, pp = doc[pick], s[pick], low[pick], part[pick]
            segments, deletion = allocation(b)
            seg = (pp % _U(segments)).astype(np.int64)
            order = np.lexsort((seg, dd))
            dd, ss, ll, seg = dd[order], ss[order], ll[order], seg[order]
            new = np.ones(len(dd), bool)
            new[1:] = (dd[1:] != dd[:-1]) | (seg[1:] != seg[:-1])
            at = np.flatnonzero(new)
            sums = np.add.reduceat(mix(ss), at)
            tag = _U((b * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            name = lambda x, g: mix(x + mix(g.astype(_U) + tag))
            if deletion:
                group = np.cumsum(new) - 1
                out_doc += [dd[at], dd]
                out_sig += [name(sums, seg[at]), name(sums[group] - mix(ss), seg)]
                continue
            sig, owner = name(sums, seg[at]), dd[at]
            rare = np.add.reduceat((~ll).astype(np.int64), at) > 0
            order = np.lexsort((sig, ~rare, owner))
            sig, owner = sig[order], owner[order]
            start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            rank = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
            keep = rank <= d[owner]
            out_doc.append(owner[keep])
            out_sig.append(sig[keep])
            have = np.bincount(owner, minlength=len(n))
            for x in np.flatnonzero(want & (have < d + 1)):  # too few subsets: the empty segments follow in the ranking
                empty = np.setdiff1d(np.arange(segments), seg[dd == x])
                e = np.sort(name(np.zeros(len(empty), _U), empty))[: d[x] + 1 - have[x]]
                out_doc.append(np.full(len(e), x))
                out_sig.append(e)
    if not out_doc:
        return np.empty(0, np.int64), np.empty(0, _U)
    return np.concatenate(out_doc), np.concatenate(out_sig)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of 64-bit numbers, plane by plane (the high planes of ids compress away)."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(_U).ravel()


def _index(k: int, parts: int, frequent: np.ndarray):
    def run(it):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0

        def send():
            sig = np.concatenate([x for x, _, _ in held])
            ids = np.concatenate([x for _, x, _ in held])
            rank = np.concatenate([x for _, _, x in held])
            part = (sig >> _U(40)) % _U(parts)
            order = np.lexsort((sig, part))
            sig, ids, rank, part = sig[order], ids[order], rank[order], part[order]
            at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            ends = np.append(at[1:], len(part))
            yield pa.RecordBatch.from_arrays([
                pa.array(part[at].astype(np.int32)), pa.array([_planes(sig[i:j]) for i, j in zip(at, ends)], pa.binary()),
                pa.array([_planes(ids[i:j]) for i, j in zip(at, ends)], pa.binary()),
                pa.array([rank[i:j].tobytes() for i, j in zip(at, ends)], pa.binary())], ["part", "sigs", "ids", "ranks"])

        for batch in it:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64).view(_U)
            for a, b, lists in stretches(batch.column("text"), PIECE, lower_split):
                doc, s, size = shingle_sets(lists, k)
                # copies within the stretch: one of them is indexed
                whole = _sum_by(doc, mix(s), b - a)
                _, one = np.unique(whole, return_index=True)
                size = np.where(np.isin(np.arange(b - a), one), size, 0)
                keep = size[doc] > 0
                own, hashes = doc[keep], s[keep]
                doc, sig = signatures(own, hashes, size, frequent)
                rare = np.bincount(own, weights=~np.isin(hashes, frequent), minlength=b - a)
                rank = (255 * rare / np.maximum(size, 1)).astype(np.uint8)
                held.append((sig, ids[a:b][doc], rank[doc]))
                n += len(sig)
                if n >= HELD:
                    yield from send()
                    held, n = [], 0
        if n:
            yield from send()
    return run


def _meet(small: int):
    """Pairs that groups of equal signatures offer; of larger groups also the members (kind 1)."""
    def run(it):
        by: dict[int, list] = {}
        for batch in it:
            for p, s, i, r in zip(*(batch.column(c).to_pylist() for c in ("part", "sigs", "ids", "ranks"))):
                by.setdefault(p, []).append((_from_planes(s), _from_planes(i).view(np.int64), np.frombuffer(r, np.uint8)))
        for p in list(by):
            chunks = by.pop(p)
            sig, ids, rank = (np.concatenate([x[c] for x in chunks]) for c in range(3))
            del chunks
            order = np.lexsort((ids, rank, sig))
            sig, ids = sig[order], ids[order]
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
            sig, ids = sig[new], ids[new]
            at = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.append(at, len(sig)))
            a, b = [], []
            start, sz = at[size > 1], size[size > 1]
            for gap in range(1, int(min(small, sz.max(initial=0)))):  # members this far apart, in groups that are small
                g = sz[(sz > gap) & (sz <= small)]
                f = start[(sz > gap) & (sz <= small)]
                i = np.repeat(f, g - gap) + np.arange(int((g - gap).sum())) - np.repeat(np.cumsum(g - gap) - (g - gap), g - gap)
                a.append(ids[i])
                b.append(ids[i + gap])
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0) if a else np.empty((0, 2), np.int64)
            f, g = start[sz > small], sz[sz > small]
            i = np.repeat(f, g) + np.arange(int(g.sum())) - np.repeat(np.cumsum(g) - g, g)
            n = len(pairs)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.zeros(n, np.int8), np.ones(len(i), np.int8)])),
                pa.array(np.concatenate([np.zeros(n, np.int64), sig[i].view(np.int64)])),
                pa.array(np.concatenate([pairs[:, 0], ids[np.repeat(f, g)]])),
                pa.array(np.concatenate([pairs[:, 1], ids[i]]))], ["kind", "sig", "a", "b"])
    return run


def _prune(it):
    """Pairs whose sizes and sketches allow the similarity."""
    for batch in it:
        n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
        fine = 4 * np.minimum(n, m) >= 3 * np.maximum(n, m)
        x, y, most = batch.column("ka"), batch.column("kb"), allowed(n, m)
        for i in np.flatnonzero(fine):
            fine[i] = _difference(x[i].as_py(), y[i].as_py()) <= most[i]
        yield pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_numpy()[fine]) for c in ("a", "b")], ["a", "b"])


def _cross(table: pa.Table) -> pa.Table:
    """Pairs that share a group, lie in different components, and whose sizes and sketches allow the similarity.

    ``table`` holds the groups of one first member, which mostly have their
    members in common: a pair is given once, however many groups it shares."""
    table = table.sort_by("sig")
    sig, node, comp, n = (table.column(c).to_numpy() for c in ("sig", "node", "comp", "n"))
    members, at = np.unique(node, return_index=True)
    raw = [np.frombuffer(x, np.uint8) for x in table.column("sketch").take(at).to_pylist()]
    size = min(map(len, raw))
    for i, x in enumerate(raw):
        while len(x) > size:
            x = x[: len(x) // 2] ^ x[len(x) // 2:]
        raw[i] = x
    sketch, comp, n = np.stack(raw).view(_U), comp[at], n[at]
    place = np.searchsorted(members, node)
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    groups_of = list(zip(first, np.append(first[1:], len(sig))))
    by_member: list[list[int]] = [[] for _ in members]
    for k, (a, b) in enumerate(groups_of):
        for x in place[a:b]:
            by_member[x].append(k)
    out_a, out_b = [], []
    for i in range(len(members)):
        near = np.unique(np.concatenate([place[slice(*groups_of[k])] for k in by_member[i]]))
        j = near[near > i]
        j = j[(comp[j] != comp[i]) & (4 * np.minimum(n[j], n[i]) >= 3 * np.maximum(n[j], n[i]))]
        if len(j):
            j = j[np.bitwise_count(sketch[j] ^ sketch[i]).sum(1) <= allowed(n[j], n[i])]
            out_a.append(np.full(len(j), members[i]))
            out_b.append(members[j])
    none = [np.empty(0, np.int64)]
    return pa.table({"a": np.concatenate(out_a or none), "b": np.concatenate(out_b or none)})


def _sets(k: int):
    def run(it):
        for batch in it:
            for a, b, lists in stretches(batch.column("text"), PIECE, lower_split):
                doc, s, n = shingle_sets(lists, k)
                end = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([
                    batch.column("node").slice(a, b - a),
                    pa.array([s[e - c: e].tobytes() for e, c in zip(end, n)], pa.binary())], ["node", "shingles"])
    return run


def _verify(it):
    for batch in it:
        ok = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):  # read in place, without copies of the sets
            x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], ["a", "b", "linked"])


def frequent_shingles(summaries: DataFrame, least: int = 24, most: int = 50_000) -> np.ndarray:
    """Up to ``most`` shingles that the stretches report most often: an order of costs, never a filter.

    Every stretch of every document is counted.  The list is bounded by its
    length (400 kB); which shingles it holds changes how many candidates
    meet, not which links are found.
    """
    h = summaries.where(F.size("heavy") > 0).select(F.explode("heavy").alias("h")).select("h.s", "h.c")
    top = h.groupBy("s").agg(F.sum("c").alias("c")).where(F.col("c") >= least).orderBy(F.desc("c"), "s").limit(most)
    return np.sort(np.array([r["s"] for r in top.select("s").collect()], np.int64)).view(_U)


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, th (the text's hash), n_shingles, component_id, n_links.

    ``n_links`` counts the verified links of the document's set with other
    sets; links between sets that components made needless to verify are not in it.
    """
    return grouped(docs, **settings).drop("comp")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, small: int = SMALL) -> DataFrame:
    """The rows of ``near_duplicates`` and ``comp``, their component's own key (null for documents without words).

    ``component_id`` names no component if ids are null or repeated; ``comp`` does.
    """
    spark = docs.sparkSession
    none = -(1 << 63)  # stands for a null id
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(none)).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("th", F.xxhash64("text"))
    s = materialize(d.mapInArrow(_summaries(k), "doc_id long, th long, n long, s1 long, s2 long, sketch binary, "
                                               "heavy array<struct<s:long,c:long>>"), "sets")
    frequent = frequent_shingles(s)
    s = s.drop("heavy")
    # equal sets are one node; documents without words are none
    nodes = s.where("n > 0").groupBy("s1", "s2", "n").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.first("sketch").alias("sketch"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    member = materialize(s.drop("sketch", "n").join(nodes.select("s1", "s2", "node", "n"), ["s1", "s2"], "left"), "members")

    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = d.mapInArrow(_index(k, parts, frequent), "part int, sigs binary, ids binary, ranks binary")
    met = materialize(index.repartition(parts // 4, "part").mapInArrow(_meet(small), "kind byte, sig long, a long, b long"), "met")
    of = member.where("node is not null").select("doc_id", "node").distinct()  # an id may have several sets
    pairs = met.where("a <> b").groupBy("a", "b").agg(F.lit(1).alias("one"))
    # ids that have several sets: their sets may be near each other too
    twin = of.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    pairs = pairs.select("a", "b").union(twin)
    p = (pairs.join(of.select(F.col("doc_id").alias("a"), F.col("node").alias("x")), "a")
         .join(of.select(F.col("doc_id").alias("b"), F.col("node").alias("y")), "b")
         .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    p = materialize(_pruned(p, nodes), "pairs")
    center = of.select(F.col("doc_id").alias("a"), F.col("node").alias("center"))
    big = materialize(met.where("kind = 1").join(center, "a").join(of, F.col("b") == F.col("doc_id")).select("sig", "center", "node"), "large_groups")

    who = p.select(F.col("a").alias("node")).union(p.select(F.col("b").alias("node"))).union(big.select("node")).distinct()
    text = (nodes.select("node", "rep.doc_id", "rep.th").join(who, "node").join(d, ["doc_id", "th"])
            .dropDuplicates(["doc_id", "th"]).select("node", "text"))
    sets = materialize(text.mapInArrow(_sets(k), "node long, shingles binary"), "shingles")

    # first each node with the first member that most of its groups have, and with its smallest partner: most other
    # pairs are then settled by components
    often = big.groupBy("node", "center").agg(F.count(F.lit(1)).alias("c")).groupBy("node").agg(
        F.max_by("center", F.struct("c", -F.col("center"))).alias("center"))
    first = (often.select(F.least("center", "node").alias("a"), F.greatest("center", "node").alias("b")).where("a < b").distinct()
             .join(p, ["a", "b"], "left_semi").union(p.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")).distinct())
    links = _verified(first, sets)
    comp = materialize(components(links.where("linked")), "comps")
    rest = _across(p.join(links.select("a", "b"), ["a", "b"], "left_anti"), comp)
    links = materialize(links.union(_verified(rest, sets)), "links2")
    comp = materialize(components(links.where("linked")), "comps")
    # groups that offered only their first member: members still in different components
    g = big.distinct().join(comp.select("node", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    open_ = g.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("sig")
    g = g.join(open_, "sig").join(nodes.select("node", "n", "sketch"), "node")
    cross = g.groupBy("center").applyInArrow(_cross, "a long, b long").distinct()
    links = links.union(_verified(cross.join(links.select("a", "b"), ["a", "b"], "left_anti"), sets))
    links = materialize(links.where("linked").select("a", "b"), "links3")
    comp = components(links)
    degree = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    full = materialize(member.join(comp, "node", "left").join(degree, "node", "left")
                       .withColumn("comp", F.coalesce("comp", "node")), "joined")
    ids = full.where(F.col("comp").isNotNull()).groupBy("comp").agg(F.min(F.nullif("doc_id", F.lit(none))).alias("component_id"))
    own = F.nullif("doc_id", F.lit(none))
    return full.join(ids, "comp", "left").select(
        own.alias("doc_id"), "th", F.coalesce("n", F.lit(0)).alias("n_shingles"),
        F.when(F.col("comp").isNull(), own).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "comp")


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """One document of each component, with all its columns: the one of the smallest id, null ids last.

    Of repeated rows (one id, one text) one stays.  Documents without words
    are components of their own and stay; without an id none of them is
    taken for a repetition.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumn("_own", F.xxhash64(text))
    worded = text.rlike(f"[^{SPACE}]")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th"))
    stay = grouped(docs.where(worded), **settings).where("comp is not null").groupBy("comp").agg(first.alias("x")).select(
        F.col("x.doc_id").alias("_id"), F.col("x.th").alias("_th"))
    one = rows.where(worded).join(stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_th")), "left_semi")
    empty = rows.where(~worded)
    return (one.union(empty.where("doc_id is not null")).dropDuplicates(["doc_id", "_own"])
            .union(empty.where("doc_id is null")).select(*docs.columns))


def _pruned(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(_prune, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return materialize(pairs.join(a, "a").join(b, "b").mapInArrow(_verify, "a long, b long, linked boolean"), "links")


def _across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    a = comp.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    b = comp.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    j = pairs.join(a, "a", "left").join(b, "b", "left")
    return j.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
