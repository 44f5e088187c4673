"""Document fingerprints by winnowing.

A text's tokens are hashed, runs of ``k`` tokens give k-gram hashes, and from
every window of ``w`` consecutive k-grams the smallest hash is kept, the
rightmost one on ties; a pick shared by neighbouring windows is kept once.
Any two texts that share ``k + w - 1`` consecutive tokens therefore share a
kept hash, and texts of fewer tokens than that have one window.  A token is a
word (the first 16 code points, the next 16, and so on, of a longer one) or, in
scripts that write no spaces, a single code point.

The k-gram hash is a rolling one: a polynomial in the tokens' hashes modulo a
prime of 31 bits.  Its values are put together from those of half as many
tokens, as array functions carry nothing from element to element.  A pick
packs the 31 bits above 32 bits of inverted position, so that one minimum
decides value and tie at once.  DataFrame functions only.

Edge cases: a null text counts as empty; a text of fewer than ``k`` tokens is
a single k-gram of all of them; a text without tokens is hashed whole (as
one k-gram), so the empty text and white-space texts have fingerprints
too.  Positions count tokens from 0 and are exact for texts of any length.
Equal texts have equal fingerprints; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import SPACE, let, ordered_index

K, W = 4, 8
POS_BITS = 32
PRIME, BASE = (1 << 31) - 1, 1_000_003
# Code points of scripts that are written without spaces: Thai and Lao, Myanmar, Khmer, kana and Han with their extensions.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
TOKEN = f"[^{SPACE}{UNSPACED}]{{1,16}}|[{UNSPACED}]"
NO_ID = -(1 << 63)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _runs(h: Column, k: int) -> Column:
    """The polynomial of every run of ``k`` hashes (of at least ``k``), by halves."""
    def joined(a: Column, b: Column, m: int, n: int) -> Column:  # runs of m, followed by runs of n
        return F.zip_with(F.slice(a, 1, F.size(b) - m), F.slice(b, m + 1, F.size(b)),
                          lambda x, y: (x * F.lit(pow(BASE, n, PRIME)) + y) % F.lit(PRIME))

    if k == 1:
        return h
    even = let(_runs(h, k // 2), lambda x: joined(x, x, k // 2, k // 2))
    return even if k % 2 == 0 else joined(even, h, k - 1, 1)


def kgram_hashes(text: Column, k: int = K) -> Column:
    """Rolling hashes of the runs of ``k`` tokens, in order: 0 to 2**31 - 2."""
    small = lambda x: F.pmod(x, F.lit(PRIME))

    def grams(h: Column) -> Column:
        one = F.array(small(F.when(F.size(h) == 0, F.xxhash64(text)).otherwise(F.xxhash64(h))))
        return F.when(F.size(h) < k, one).otherwise(_runs(h, k))

    return let(F.transform(tokens(text), lambda x: small(F.xxhash64(x))), grams)


def _window_min(a: Column, w: int) -> Column:
    """Minimum of every run of ``w`` elements, by doubling; of all of them if there are fewer."""
    def widen(x: Column, have: int) -> Column:
        if have == w:
            return x
        step = min(have, w - have)
        return let(x, lambda y: widen(F.zip_with(F.slice(y, 1, F.size(y) - step), F.slice(y, step + 1, F.size(y)),
                                                 lambda p, q: F.least(p, q)), have + step))

    return let(a, lambda y: F.when(F.size(y) <= w, F.array(F.array_min(y))).otherwise(widen(y, 1)))


def picks(text: Column, k: int = K, w: int = W) -> Column:
    """Kept k-grams of a text as packed (hash, position) numbers, in order of position."""
    top = (1 << POS_BITS) - 1
    packed = F.transform(kgram_hashes(text, k), lambda h, i: F.shiftleft(h, POS_BITS).bitwiseOR(F.lit(top) - i))
    return F.array_distinct(_window_min(packed, w))


def pick_hashes(p: Column) -> Column:
    return F.transform(p, lambda x: F.shiftright(x, POS_BITS))


def pick_positions(p: Column) -> Column:
    top = (1 << POS_BITS) - 1
    return F.transform(p, lambda x: (F.lit(top) - x.bitwiseAND(F.lit(top))).cast("int"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two fingerprints' hash sets, 0 to 1."""
    def ratio(x: Column) -> Column:
        both = F.size(F.array_intersect(x["a"], x["b"]))
        return both / (F.size(F.array_distinct(x["a"])) + F.size(F.array_distinct(x["b"])) - both)

    return let(F.struct(a.alias("a"), b.alias("b")), ratio)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """One row per document: doc_id, kept hashes and their positions."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("doc_id"), picks(t, k, w).alias("p"))
            .select("doc_id", pick_hashes(F.col("p")).alias("hashes"), pick_positions(F.col("p")).alias("positions")))


def neighbours(docs: DataFrame) -> DataFrame:
    """``(key, th, text)`` -> one row per distinct document with the next one's key and hash, in descending key.

    The last is followed by the first.  Documents of one key are ordered by
    the hash of their text; NO_ID, which stands for a null id, is the
    smallest key and comes last.  Only keys and hashes are ordered, in ranges, so no
    task sees all of them.
    """
    ids = docs.select("key", "th", F.length("text").alias("n")).distinct()
    i = ordered_index(ids, F.col("key").desc(), F.col("th"))
    rows = i.count()
    nxt = i.select((F.col("idx") - 1).alias("before"), F.col("key").alias("next_key"), F.col("th").alias("next_th"))
    nxt = nxt.withColumn("before", F.when(F.col("before") < 0, F.lit(rows - 1)).otherwise(F.col("before")))
    return i.join(nxt, F.col("idx") == F.col("before")).select("key", "th", "n", "next_key", "next_th")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the last third of the code points replaced by the
    first as many of the next document.  Texts are shuffled once, by id; each
    document then sends the one before it only the piece that it needs and
    its own kept hashes.
    """
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("th", F.xxhash64("text"))
    near = neighbours(d)
    # by its next document: what that one must send, and to whom
    asks = near.select(F.col("next_key").alias("a_key"), F.col("next_th").alias("a_th"), F.col("key").alias("to_key"),
                       F.col("th").alias("to_th"), F.floor(F.col("n") / 3).cast("int").alias("need"))
    t = d.repartition("key", "th")  # both uses below read this one exchange
    hashes = F.array_distinct(pick_hashes(picks(F.col("text"), k, w)))
    sent = (t.join(asks, (F.col("key") == F.col("a_key")) & (F.col("th") == F.col("a_th")))
            .select("to_key", "to_th", F.expr("left(text, need)").alias("piece"), hashes.alias("next_hashes"))
            .dropDuplicates(["to_key", "to_th"]))
    j = t.join(sent, (F.col("key") == F.col("to_key")) & (F.col("th") == F.col("to_th")))
    j = j.select(F.nullif("key", F.lit(NO_ID)).alias("doc_id"), "text", F.length("text").cast("long").alias("n_chars"), "next_hashes",
                 F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 3) as int))"), "piece").alias("edited"))
    return (j.withColumn("p", picks(F.col("text"), k, w)).withColumn("q", picks(F.col("edited"), k, w))
            .withColumns({"h": pick_hashes(F.col("p")), "e": pick_hashes(F.col("q"))})
            .select("doc_id", "n_chars", "edited", "p", "q",
                    likeness(F.col("h"), F.col("e")).alias("near_edited"),
                    likeness(F.col("h"), F.col("next_hashes")).alias("near_next")))


def digest(p: Column) -> Column:
    """A fingerprint as a string: kept hashes with their positions, digested."""
    return F.sha2(F.concat_ws(",", p.cast("array<string>")), 256)
