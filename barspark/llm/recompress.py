"""Removal of long repeated word sequences, by recompression.

A window of ``window`` words is removed, word by word, if its sequence also
starts anywhere else in the corpus.  Recompression finds where to look:
every round names maximal runs of a symbol and then pairs of neighbouring
symbols, a pair being one whose left symbol falls in the left half of the
alphabet and whose right symbol in the right half, halves being dealt by
hash.  Names are 64-bit hashes of what they stand for, so all tasks agree on
them without an exchange per round.  Whether a symbol forms depends on a
short stretch of words around it, which is tracked exactly; a symbol whose
stretch lies within a window forms in every occurrence of the window.  Each
window is anchored at its high-level symbol of smallest hash, and the
anchor's key names the stretch; windows without such a symbol (inside long
runs) are their own anchors.  Equal windows therefore have equal keys.

Spark counts the keys; only windows whose key occurs twice or more are
compared, by 96-bit hashes of their word hashes, and words covered by a window that
occurs again are removed.  Documents of one whole word sequence are settled
at once and only one of them goes further.  No step gathers a key's or a
window's places in one task: counts are summed on the map side first and
joined back.

Edge cases: null and empty texts have no words; documents shorter than the
window lose nothing; repeated rows, also of one doc_id, are separate
documents (each repeats the other); an empty table gives no rows.  Columns
beside id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import materialize
from barspark.llm.tokens import Ranges, hash_words, mix, split, stretches
from barspark.session import drop_stored, stored

_U = np.uint64
WINDOW, ROUNDS = 35, 3
#: Words handled at a time in a task (about 200 bytes of working memory each).
PIECE = 400_000


def _round(sym, dl, dr, sep, level):
    """Name runs, then pairs: symbols, first and last word each depends on, and separator flags."""
    m = len(sym)
    new = np.ones(m, bool)
    new[1:] = sym[1:] != sym[:-1]
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, m))
    s = sym[at]
    s = np.where(n > 1, mix(s * _U(3) + n.astype(_U)), s)
    sp = sep[at]
    l2 = np.where(sp, dl[at], dl[np.maximum(at - 1, 0)])
    r2 = np.where(sp, dr[at], dr[np.minimum(at + n, m - 1)])
    right = (mix(s + _U(level * 2 + 1)) >> _U(63)).astype(bool) & ~sp
    left = ~right & ~sp
    head = np.zeros(len(s), bool)
    head[:-1] = left[:-1] & right[1:]
    tail = np.zeros(len(s), bool)
    tail[1:] = head[:-1]
    k = np.flatnonzero(~tail)
    after, before = np.minimum(k + 1, len(s) - 1), np.maximum(k - 1, 0)
    out = np.where(head[k], mix(s[k] * _U(5) + mix(s[after])), s[k])
    lo = np.where(right[k], l2[before], l2[k])
    hi = np.where(left[k], r2[after], r2[k])
    return out, lo, hi, sp[k]


def anchors(h: np.ndarray, lengths: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS):
    """Keys of every window of a batch of documents.

    ``h`` holds the word hashes of all documents, one after the other.
    Returns the windows' first words (in ``h``), their keys, the places of
    the anchors they name, and the range hashes over ``h``.
    """
    n_docs, total = len(lengths), int(lengths.sum())
    first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    rng = Ranges(h)
    count = np.maximum(lengths - window + 1, 0)
    shift = np.repeat(first - (np.cumsum(count) - count), count)
    p = np.arange(int(count.sum())) + shift
    if not len(p):
        return p, np.empty(0, _U), p, rng
    # with a separator before every document and after the last one
    doc = np.repeat(np.arange(n_docs), lengths)
    sep = np.ones(total + n_docs + 1, bool)
    sep[np.arange(total) + doc + 1] = False
    sym = mix(np.arange(len(sep)).astype(_U) + _U(0x5851F42D4C957F2D))
    sym[~sep] = h
    dl = dr = 2 * np.cumsum(~sep) - np.where(sep, 1, 2)  # twice a word's place; separators are odd, between words
    for level in range(rounds):
        sym, dl, dr, sep = _round(sym, dl, dr, sep, level)
    sym, dl, dr = sym[~sep], dl[~sep], dr[~sep]
    lo, hi = np.searchsorted(dl, 2 * p, "left"), np.searchsorted(dr, 2 * (p + window - 1), "right")
    value = mix(sym ^ _U(0xA0761D6478BD642F))
    best = np.full(len(p), -1)
    some = np.flatnonzero(hi > lo)
    if len(some):
        size = hi[some] - lo[some]
        power = np.floor(np.log2(size)).astype(int)
        table = np.arange(len(sym))
        for k in range(int(power.max()) + 1):
            if k:
                half = 1 << (k - 1)
                a, b = table[:-half], table[half:]
                table = np.where(value[b] < value[a], b, a)
            q = some[power == k]
            a, b = table[lo[q]], table[hi[q] - (1 << k)]
            best[q] = np.where(value[b] < value[a], b, a)
    begin = np.where(best >= 0, dl[best] // 2, p)
    end = np.where(best >= 0, dr[best] // 2, p + window - 1) + 1
    place = np.where(best >= 0, best, -1 - p)
    return p, rng.of(begin, end), place, rng


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, kind))


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _pieces(texts: pa.Array):
    """Stretches of rows with their words, word hashes and lengths."""
    for a, b, part in stretches(texts, PIECE, split):
        lengths = np.array([len(x) for x in part], np.int64)
        yield a, b, part, hash_words([w for x in part for w in x]), lengths


def _summaries(window: int, rounds: int):
    def run(it):
        for batch in it:
            for a, b, part, h, lengths in _pieces(batch.column("text")):
                p, keys, place, rng = anchors(h, lengths, window, rounds)
                first = np.concatenate([[0], np.cumsum(lengths)])
                one = np.ones(len(p), bool)  # a key once for each place it names
                one[1:] = place[1:] != place[:-1]
                # windows of different documents never share a place
                per = np.searchsorted(p[one], first)
                other = Ranges(mix(h), 0xC2B2AE3D27D4EB4F)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), batch.column("th").slice(a, b - a), pa.array(lengths),
                    pa.array(rng.of(first[:-1], first[1:]).view(np.int64)), pa.array(other.of(first[:-1], first[1:]).view(np.int64)),
                    pa.array([_sha(x) for x in part]), _lists(keys[one].view(np.int64), np.diff(per), pa.int64()),
                ], ["doc_id", "th", "n_words", "s1", "s2", "sha", "keys"])
    return run


def _windows(window: int, rounds: int):
    def run(it):
        for batch in it:
            wanted = batch.column("shared")
            ids = batch.column("rid").to_numpy(zero_copy_only=False)
            for a, b, _, h, lengths in _pieces(batch.column("text")):
                p, keys, _, rng = anchors(h, lengths, window, rounds)
                some = wanted.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).view(_U)
                p = p[np.isin(keys, np.unique(some))]
                first = np.concatenate([[0], np.cumsum(lengths)])
                doc = np.searchsorted(first, p, "right") - 1
                other = Ranges(mix(h), 0xC2B2AE3D27D4EB4F)
                yield pa.RecordBatch.from_arrays([
                    pa.array(rng.of(p, p + window).view(np.int64)),
                    pa.array((other.of(p, p + window) >> _U(32)).astype(np.uint32).view(np.int32)),
                    pa.array(ids[a:b][doc], pa.int64()), pa.array((p - first[doc]).astype(np.int32)),
                ], ["h1", "h2", "rid", "pos"])
    return run


def _cut(window: int):
    def run(it):
        for batch in it:
            removed, shas, kept = [], [], []
            for t, at in zip(batch.column("text"), batch.column("at")):
                w = split(t.as_py())
                edge = np.zeros(len(w) + 1, np.int64)
                at = at.values.to_numpy(zero_copy_only=False).astype(np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                rest = [x for x, g in zip(w, gone) if not g]
                removed.append(int(gone.sum()))
                shas.append(_sha(rest))
                kept.append(b" ".join(rest).decode())
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(removed, pa.int64()), pa.array(shas, pa.string()),
                                              pa.array(kept, pa.string())], ["rid", "n_removed", "kept_sha256", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   rounds: int = ROUNDS, keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, th (the text's hash), n_words, n_removed, kept_sha256, kept_text.

    ``kept_text`` holds the kept words joined by one space where something
    was removed and is null where nothing was (the text stands as it is);
    ``keep_text=False`` leaves the column out.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("th", F.xxhash64("text"))
    s = d.mapInArrow(_summaries(window, rounds),
                     "doc_id long, th long, n_words long, s1 long, s2 long, sha string, keys array<long>")
    s = materialize(s.withColumn("rid", F.monotonically_increasing_id()), "recompress_keys")
    # documents of one word sequence: copies go whole, and one of them is compared with the rest
    same = materialize(s.where(F.col("n_words") >= window).groupBy("s1", "s2")
                       .agg(F.count(F.lit(1)).alias("copies"), F.min("rid").alias("rid")), "recompress_same")
    k = s.select("rid", "keys").join(same.select("rid"), "rid").select("rid", F.explode("keys").alias("key"))
    shared = k.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    hits = k.join(shared, "key").groupBy("rid").agg(F.collect_set("key").alias("shared"))
    spark = docs.sparkSession
    windows = stored(_with_text(hits, s, d, "shared").mapInArrow(
        _windows(window, rounds), "h1 long, h2 int, rid long, pos int"), "recompress_windows")
    w = spark.read.parquet(windows)
    again = w.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    at = w.join(again, ["h1", "h2"]).groupBy("rid").agg(F.collect_list("pos").alias("at"))  # a document's windows at most
    at = materialize(at.join(same.where("copies = 1").select("rid"), "rid"), "recompress_places")
    drop_stored(spark, windows)  # the places are all that is read from here on
    cut = _with_text(at, s, d, "at").mapInArrow(
        _cut(window), "rid long, n_removed long, kept_sha256 string, kept_text string")
    copies = same.where("copies > 1").select("s1", "s2", "copies")
    out = s.drop("keys").join(cut, "rid", "left").join(copies, ["s1", "s2"], "left")
    whole = F.col("copies").isNotNull()
    out = out.select(
        "doc_id", "th", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(_sha([]))).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))
    return out if keep_text else out.drop("kept_text")


def _with_text(rows: DataFrame, s: DataFrame, d: DataFrame, col: str) -> DataFrame:
    """Give rows of representatives (by rid) their text."""
    who = s.select("rid", F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
    return (rows.join(who, "rid").join(d, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
            .select("rid", "text", col))


def apply(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with the removed words taken out of their texts (and ``n_chars`` made new); all rows and columns stay.

    Texts that lose nothing stand unchanged; others become their kept words joined by one space.
    """
    r = remove_repeats(docs, **settings).where("n_removed > 0").groupBy("doc_id", "th").agg(F.first("kept_text").alias("_kept"))
    r = r.withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    own = F.xxhash64(F.coalesce("text", F.lit("")))
    j = docs.withColumn("_own", own).join(r, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_th")), "left")
    j = j.withColumn("text", F.coalesce("_kept", "text"))
    return j.withColumn("n_chars", F.when(F.col("_kept").isNull(), F.col("n_chars")).otherwise(F.length("_kept"))).select(*docs.columns)
