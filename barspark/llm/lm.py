"""Language-model scoring with a weighted back-off automaton.

The states are the contexts that occur in the training documents.  An arc
from context ``v`` by word ``w`` weighs ``log10 p(w | v)``; where a context
has no arc for a word, its failure arc leads to the next shorter context
and weighs ``log10 (kappa / (c(v) + kappa))``.  Weights come from counts::

    p(w)      = (c(w) + 1) / (N + V + 1)
    p(w | v)  = (c(v w) + kappa * p(w | v')) / (c(v) + kappa)

with v' the context less its first word, so that probabilities of all
words sum to one in every state.  A text is read once from left to right:
the state is carried from word to word, failure arcs are followed until the
state has an arc for the word, and the weights on the way add up.
The first word's context is the start of text, the last token is the end.

No task holds the model.  Documents are dealt into chunks; a chunk lists the
n-grams that it needs (once each, with its own training counts), the lists
meet the other chunks' lists by hash, and the summed counts return to
the chunk in the list's own order.  From them the chunk builds the part of
the automaton that its texts can reach, for a stretch of texts at a time.  Lists travel as blocks of sorted 64-bit hashes.

Edge cases: a null or empty text is the end token alone; a null doc_id is a
training document; with no training documents N and V are 0 and every
probability is 1; repeated rows count and score each.  Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.tokens import hash_words, lower_split, mix, split

_U = np.uint64
ORDER, KAPPA = 2, 50.0
CHUNK_WORDS = 1_500_000
STRETCH = 10_000  # tokens whose arcs stay in a core's cache
END = 0x5EED00E4D0000001
START = 0x5EED005A870000FF


def _tokens(texts: list, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts, each followed by the end token, and token counts."""
    lists = [lower_split(t) if lower else split(t) for t in texts]
    n = np.array([len(x) + 1 for x in lists], np.int64)
    out = np.full(int(n.sum()), END, _U)
    word = np.ones(len(out), bool)
    word[np.cumsum(n) - 1] = False
    out[word] = hash_words([w for x in lists for w in x])
    return out, n


def grams(tok: np.ndarray, n: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each token, for orders 1 to ``order``; the lowest bit tells words apart."""
    first = np.zeros(len(tok), np.int64)
    starts = np.cumsum(n) - n
    first = np.arange(len(tok)) - np.repeat(starts, n)  # place in the text
    out = [mix(tok) | _U(1)]
    run = mix(tok)
    for o in range(2, order + 1):
        before = np.full(len(tok), START, _U)
        before[o - 1:] = tok[: len(tok) - o + 1]
        before[first < o - 1] = START
        run = mix(run * _U(3) + mix(before + _U(o)))
        out.append(run & ~_U(1))
    return out


def _planes(x: np.ndarray) -> bytes:
    return x.astype(_U).view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(_U).ravel()


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> _U(32)) % _U(parts)).astype(np.int64)


def _blocks(h: np.ndarray, parts: int):
    """Cut sorted-by-part hashes into (part, first, end)."""
    p = _part(h, parts)
    at = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(p) else np.empty(0, int)
    return zip(p[at], at, np.append(at[1:], len(p)))


def _order(h: np.ndarray, parts: int) -> np.ndarray:
    return np.lexsort((h, _part(h, parts)))


def _vocabulary(parts: int, lower: bool):
    """Distinct training words of a task, by part, and its token totals."""
    def run(it):
        seen, total, train = [], 0, 0
        size = 0

        def send(seen):
            u = np.unique(np.concatenate(seen)) if seen else np.empty(0, _U)
            u = u[_order(u, parts)]
            blocks = list(_blocks(u, parts))
            yield pa.RecordBatch.from_arrays([
                pa.array([int(p) for p, _, _ in blocks] + [0], pa.int32()),
                pa.array([_planes(u[a:b]) for _, a, b in blocks] + [b""], pa.binary()),
                pa.array([0] * len(blocks) + [train], pa.int64()), pa.array([0] * len(blocks) + [total], pa.int64())],
                ["part", "words", "train", "total"])

        for batch in it:
            texts, held = batch.column("text").to_pylist(), batch.column("held_out").to_numpy(zero_copy_only=False)
            for i in range(0, len(texts), 500):
                tok, n = _tokens(texts[i:i + 500], lower)
                keep = np.repeat(~held[i:i + 500].astype(bool), n)
                total += len(tok)
                train += int(keep.sum())
                seen.append(np.unique(grams(tok[keep], n[~held[i:i + 500].astype(bool)], 1)[0]))
                size += len(seen[-1])
                if size > 3_000_000:
                    seen = [np.unique(np.concatenate(seen))]
                    size = len(seen[0])
                    if size > 2_000_000:
                        yield from send(seen)
                        seen, size, total, train = [], 0, 0, 0
        yield from send(seen)
    return run


def _distinct(table: pa.Table) -> pa.Table:
    blobs = [_from_planes(b) for b in table.column("words").to_pylist() if b]
    v = len(np.unique(np.concatenate(blobs))) if blobs else 0
    return pa.table({"v": [v], "train": [sum(table.column("train").to_pylist())], "total": [sum(table.column("total").to_pylist())]})


def _wanted(texts, held, order, lower):
    """The n-grams of a chunk: sorted distinct hashes, their training counts, and each token's places in them."""
    all_h, all_n, keep = [[] for _ in range(order)], [], []
    for i in range(0, len(texts), 500):
        tok, n = _tokens(texts[i:i + 500], lower)
        for o, g in enumerate(grams(tok, n, order)):
            all_h[o].append(g)
        all_n.append(n)
        keep.append(np.repeat(~held[i:i + 500], n))
    n, keep = np.concatenate(all_n), np.concatenate(keep)
    h = np.concatenate([np.concatenate(x) for x in all_h])
    u, place = np.unique(h, return_inverse=True)
    counts = np.bincount(place[np.tile(keep, order)], minlength=len(u))
    return u, counts, place.reshape(order, -1), n


def _ask(order: int, parts: int, lower: bool):
    def run(table: pa.Table) -> pa.Table:
        held = table.column("held_out").to_numpy().astype(bool)
        u, counts, _, _ = _wanted(table.column("text").to_pylist(), held, order, lower)
        o = _order(u, parts)
        u, counts = u[o], counts[o]
        blocks = list(_blocks(u, parts))
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"chunk": pa.array([chunk] * len(blocks), pa.int64()), "part": pa.array([int(p) for p, _, _ in blocks], pa.int32()),
                         "grams": pa.array([_planes(u[a:b]) for _, a, b in blocks], pa.binary()),
                         "counts": pa.array([_planes(counts[a:b]) for _, a, b in blocks], pa.binary())})
    return run


def _answer(table: pa.Table) -> pa.Table:
    """Sum the counts of one part over all chunks, and give every chunk the sums in the order it asked."""
    lists = [_from_planes(b) for b in table.column("grams").to_pylist()]
    every, counts = np.concatenate(lists), np.concatenate([_from_planes(b) for b in table.column("counts").to_pylist()])
    order = np.argsort(every, kind="stable")
    e = every[order]
    at = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
    sums = np.add.reduceat(counts[order], at)
    back = np.empty(len(e), _U)
    back[order] = np.repeat(sums, np.diff(np.append(at, len(e))))
    ends = np.cumsum([len(x) for x in lists])
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"),
                     "sums": pa.array([_planes(back[b - len(x): b]) for b, x in zip(ends, lists)], pa.binary())})


class Automaton:
    """States, arcs and failure arcs of the n-grams that a stretch of texts can reach.

    ``place`` names the n-gram that ends at each token, one row per order;
    ``count`` gives an n-gram's training count; ``begin`` marks the first
    token of a text.  State 0 is the empty context, 1 to ``order - 1`` are
    as many starts of text, the others are n-grams seen in training.
    ``scratch`` is room for a number per n-gram.
    """

    def __init__(self, place: np.ndarray, count: np.ndarray, begin: np.ndarray, docs_trained: float, kappa: float,
                 n_train: int, v: int, scratch: np.ndarray):
        order, each = len(place), np.arange(place.shape[1])
        self.start = order - 1
        fail, weight = [np.arange(-1, order - 1)], [np.full(order, math.log10(kappa / (docs_trained + kappa)))]
        sources, words, targets, weights = [], [], [], []
        n_states, shorter_p, shorter_state = order, None, None
        for k in range(order):  # n-grams of k + 1 words, each once
            scratch[place[k][::-1]] = each[::-1]  # the first token at which an n-gram ends
            once = scratch[place[k]]
            at = np.flatnonzero(once == each)
            gram = place[k][at]
            scratch[gram] = np.arange(len(gram))
            every = scratch[place[k]]
            c = count[gram]
            if k == 0:
                word, self.words = every, len(gram)
                p = (c + 1) / (n_train + v + 1)
                source = fall = np.zeros(len(gram), np.int64)
            else:
                first = begin[at]
                context = np.where(first, docs_trained, count[place[k - 1][at - 1]])
                p = (c + kappa * shorter_p[at]) / (context + kappa)
                source, fall = np.where(first, k, shorter_state[at - 1]), shorter_state[at]
            seen = c > 0
            target = fall
            if k < order - 1:  # a context of the next order: a state of its own
                target = fall.copy()
                target[seen] = n_states + np.arange(seen.sum())
                n_states += int(seen.sum())
                fail.append(fall[seen])
                weight.append(np.log10(kappa / (c[seen] + kappa)))
            sources.append(source[seen])
            words.append(word[at][seen])
            targets.append(target[seen])
            weights.append(np.log10(p[seen]))
            shorter_p, shorter_state = p[every], target[every]
        self.word = word
        self.fail, self.fail_weight = np.concatenate(fail).tolist(), np.concatenate(weight).tolist()
        keys = np.concatenate(sources) * self.words + np.concatenate(words)
        self.arcs = dict(zip(keys.tolist(), range(len(keys))))  # (state, word) to an arc's number
        self.weight, self.target = np.concatenate(weights).tolist(), np.concatenate(targets).tolist()
        self.unknown = math.log10(1 / (n_train + v + 1))  # the empty context reads every word

    def read(self, first: int, end: int) -> float:
        """Log-probability of the text that holds the tokens ``first`` to ``end``."""
        arcs, weight, target, fail, fail_weight, n = self.arcs, self.weight, self.target, self.fail, self.fail_weight, self.words
        state, total = self.start, 0.0
        for w in self.word[first:end].tolist():
            arc = arcs.get(state * n + w)
            while arc is None and state:
                total += fail_weight[state]
                state = fail[state]
                arc = arcs.get(state * n + w)
            if arc is None:
                total += self.unknown
            else:
                total += weight[arc]
                state = target[arc]
        return total


def _stretches(n: np.ndarray, most: int):
    """Cut texts of ``n`` tokens into stretches of about ``most`` tokens: (first, end) texts."""
    first, size = 0, 0
    for i, x in enumerate(n.tolist()):
        if size and size + x > most:
            yield first, i
            first, size = i, 0
        size += x
    yield first, len(n)


def _traverse(order: int, parts: int, kappa: float, n_train: int, v: int, lower: bool):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _empty()
        held = docs.column("held_out").to_numpy().astype(bool)
        u, _, place, n = _wanted(docs.column("text").to_pylist(), held, order, lower)
        o = _order(u, parts)
        c = np.empty(len(u))
        by = {p: _from_planes(b) for p, b in zip(replies.column("part").to_pylist(), replies.column("sums").to_pylist())}
        for p, a, b in _blocks(u[o], parts):
            c[o[a:b]] = by[int(p)]
        del u, o, by
        starts = np.cumsum(n) - n
        docs_trained = c[place[0][starts[0] + n[0] - 1]]  # the end token occurs once a training document
        count = c[place[0]]
        base = np.log10((count + 1) / (n_train + v + 1))
        begin = np.zeros(len(count), bool)
        begin[starts] = True
        scores, scratch = [], np.empty(len(c), np.int64)
        for i, j in _stretches(n, STRETCH):
            a, b = starts[i], starts[j - 1] + n[j - 1]
            m = Automaton(place[:, a:b], c, begin[a:b], docs_trained, kappa, n_train, v, scratch)
            scores += [m.read(x - a, x - a + y) for x, y in zip(starts[i:j].tolist(), n[i:j].tolist())]
        return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(n),
                         "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                         "base_score": pa.array(np.add.reduceat(base, starts)), "score": pa.array(scores, pa.float64())})
    return run


def _empty() -> pa.Table:
    return pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()),
                     "n_known": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, kappa: float = KAPPA,
          modulus: int = 7, remainder: int = 2, chunk_words: int = CHUNK_WORDS, lower: bool = False) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents whose crc32 of the id leaves another remainder
    than ``remainder``.  With ``lower`` words are read with A-Z lower-cased.
    ``chunk_words`` bounds a chunk's memory (about 150
    bytes a word); lists number chunks times parts, so raise it with the corpus.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), held.alias("held_out"))
    words = d.select("text", "held_out").mapInArrow(_vocabulary(parts, lower), "part int, words binary, train long, total long")
    r = (words.groupBy("part").applyInArrow(_distinct, "v long, train long, total long")
         .agg(F.sum("v").alias("v"), F.sum("train").alias("train"), F.sum("total").alias("total")).first())
    v, n_train, total = (int(r[x] or 0) for x in ("v", "train", "total"))
    chunks = max(1, math.ceil(total / chunk_words))
    d = d.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    asked = d.groupBy("chunk").applyInArrow(_ask(order, parts, lower), "chunk long, part int, grams binary, counts binary")
    answers = asked.groupBy("part").applyInArrow(_answer, "chunk long, part int, sums binary")
    out = d.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _traverse(order, parts, kappa, n_train, v, lower),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(n_train).cast("long"))
