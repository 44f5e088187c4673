"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the words of a clause side by side:

* insult: a word of the lexicon gives its weight;
* threat: a word of harm waits for a target in the next words;
* target: remembers that somebody is spoken to or of, which raises an insult;
* negation: lowers what stands within the next words, up to a comma;
* reported speech: lowers the rest of a clause after a word of saying, and what stands in quotes.

They are composed into one automaton (all reachable combinations of their
states, one transition table); a clause is read from left to right, every
transition says by how much a match counts, and states return to the start
where a clause ends.  A document's weight is the sum over its matched
clauses, set against the square root of its length, and a logistic curve
turns it into a score.

The lexicon's weights are shrunk log-odds of a word standing in toxic rather
than in clean labelled documents, summed over the corpus by Spark; words of
too little evidence have none.  The curve is fitted on the training documents,
each weighed with a lexicon that leaves out its own label, so that rare words
do not flatter it.  Both are bounded: at most ``MOST_WORDS`` words (those of
the most weight times evidence) travel with the tasks, and the curve is fitted
on counts over a grid of ``GRID`` steps.

Edge cases: null and empty texts match nothing and get the score of an empty
document; texts of any length are read whole; a null id is in no fold and
never trains; labels other than 0 and 1 are not read, a document with both
counts as toxic; repeated rows train and are scored one by one; without labelled documents of both kinds the stated
words and curve are used.  An empty table gives no rows; columns beside id
and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import materialize

MOST_WORDS = 20_000
#: The grid of densities on which the curve is fitted: steps per unit, and steps in all.
STEPS, GRID = 64, 4096

# Small word lists of four languages.
INSULTS = ["idiot", "moron", "scum", "dumbass", "bastard", "arschloch", "abschaum", "dummkopf",
           "connard", "salaud", "ordure", "imbécile", "imbécil", "cabrón", "escoria", "gilipollas"]
THREATS = ["kill", "hurt", "destroy", "murder", "beat", "töten", "umbringen", "vernichten", "tuer", "détruire", "frapper",
           "matar", "destruir", "golpear"]
TARGETS = ["you", "your", "yours", "they", "them", "he", "she", "him", "her", "du", "dich", "dein", "ihr", "euch",
           "tu", "toi", "vous", "ils", "elles", "tú", "usted", "ustedes", "vosotros", "ellos"]
NEGATIONS = ["not", "no", "never", "neither", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "nunca", "ni"]
REPORTS = ["said", "says", "wrote", "claimed", "quoted", "called", "sagte", "schrieb", "nannte", "dit", "écrit", "dijo", "escribió", "llamó"]

#: Symbols that the automaton reads; every other word is WORD.
WORD, INSULT, THREAT, TARGET, NEGATION, REPORT, COMMA, QUOTE = range(8)
#: Words that a negation, a target and a threat reach.
NEGATED, AIMED, WAITING = 3, 4, 4
#: What a match counts: aimed at somebody, negated, reported; a fulfilled threat; a stated insult without evidence.
AIM, DENIAL, REPORTED, HARM, STATED = 1.25, 0.3, 0.5, 3.0, 3.0

CLAUSE = re.compile(r"[.!?;:\n]+")
WORDS = re.compile(r"[^\W\d_]+")
TOKENS = re.compile(r"[^\W\d_]+|[,\"“”«»„]")


# Each transducer: start state and step(state, symbol) -> state.
def _negation(state, symbol):
    return NEGATED if symbol == NEGATION else 0 if symbol == COMMA else state if symbol == QUOTE else max(0, state - 1)


def _target(state, symbol):
    return AIMED if symbol == TARGET else state if symbol in (COMMA, QUOTE) else max(0, state - 1)


def _threat(state, symbol):
    return WAITING if symbol == THREAT else 0 if symbol == TARGET else state if symbol in (COMMA, QUOTE) else max(0, state - 1)


def _report(state, symbol):
    said, quoted = divmod(state, 2)
    return 2 * max(said, symbol == REPORT) + (quoted ^ (symbol == QUOTE))


MACHINES = (_negation, _target, _threat, _report)


def compose() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All reachable states of the four machines together: next state, factor of an insult, and weight of a threat, by state and symbol.

    State 0 is the start.
    """
    states, order = {(0, 0, 0, 0): 0}, [(0, 0, 0, 0)]
    to, factor, harm = [], [], []
    for s in order:  # grows as states are found
        row = []
        for symbol in range(8):
            t = tuple(int(f(x, symbol)) for f, x in zip(MACHINES, s))
            if t not in states:
                states[t] = len(order)
                order.append(t)
            row.append(states[t])
        negated, aimed, waiting, reported = s
        lower = (DENIAL if negated else 1.0) * (REPORTED if reported else 1.0)
        to.append(row)
        factor.append((AIM if aimed else 1.0) * lower)
        harm.append([HARM * lower if symbol == TARGET and waiting else 0.0 for symbol in range(8)])
    return np.array(to), np.array(factor), np.array(harm)


def symbols() -> dict[str, int]:
    return {w: s for s, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws} | {
        ",": COMMA, **dict.fromkeys("\"“”«»„", QUOTE)}


class Grammar:
    """The composed automaton over a lexicon: word -> weight."""

    def __init__(self, lexicon: dict[str, float]):
        to, factor, harm = compose()
        self.to, self.factor, self.harm = to.tolist(), factor.tolist(), harm.tolist()
        self.lexicon = lexicon
        self.fixed = symbols()
        self.sharp = set(lexicon) | set(THREATS)

    def clauses(self, text: str, weights: dict[str, float] | None = None):
        """Number of words, and (clause, first word, words, weight) of every matched clause."""
        weights = self.lexicon if weights is None else weights
        low = (text or "").lower()
        words = WORDS.findall(low)
        if self.sharp.isdisjoint(words):
            return len(words), []
        found, at = [], 0
        for i, part in enumerate(CLAUSE.split(low)):
            tokens = TOKENS.findall(part)
            n = sum(t not in self.fixed or self.fixed[t] < COMMA for t in tokens)
            if not self.sharp.isdisjoint(tokens):
                weight = self.read(tokens, weights)
                if weight > 0:
                    found.append((i, at, n, weight))
            at += n
        return len(words), found

    def read(self, tokens: list[str], weights: dict[str, float]) -> float:
        state, total = 0, 0.0
        for t in tokens:
            w = weights.get(t, 0.0)
            s = INSULT if w > 0 else self.fixed.get(t, WORD)
            total += w * self.factor[state] if w > 0 else self.harm[state][s]
            state = self.to[state][s]
        return total


def log_odds(toxic: float, clean: float, base: float, prior: float) -> float:
    """Shrunk log-odds of a word that stands in so many toxic and clean documents, against the share ``base`` of toxic ones."""
    return float(np.log((toxic + prior * base) / (clean + prior * (1 - base))) - np.log(base / (1 - base)))


def _word_documents(it):
    """Batches of (text, toxic) -> documents of either kind that hold a word, summed per piece."""
    kinds = [Counter(), Counter()]

    def flush():
        words = list(kinds[0] | kinds[1])
        out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *[
            pa.array([k[w] for w in words], pa.int64()) for k in kinds]], ["word", "clean", "toxic"])
        for k in kinds:
            k.clear()
        return out

    for batch in it:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            kinds[toxic].update(set(WORDS.findall(text.lower())))
            if len(kinds[0]) + len(kinds[1]) > 300_000:
                yield flush()
    yield flush()


class Model:
    """A lexicon with its evidence, and the curve from density to score."""

    def __init__(self, evidence: dict[str, tuple[int, int]], base: float | None, prior: float, least: float, min_toxic: int):
        self.evidence, self.base, self.prior, self.least, self.min_toxic = evidence, base, prior, least, min_toxic
        self.offset, self.slope = -4.0, 8.0
        self.lexicon = dict.fromkeys(INSULTS, STATED) | {w: self.weight(*e) for w, e in evidence.items()}

    def weight(self, toxic: int, clean: int) -> float:
        w = log_odds(toxic, clean, self.base, self.prior)
        return w if toxic >= self.min_toxic and w >= self.least else 0.0

    def without(self, text: str, toxic: int) -> dict[str, float]:
        """The lexicon as it would be without one training document."""
        mine = set(WORDS.findall(text.lower())) & self.evidence.keys()
        changed = {w: self.weight(self.evidence[w][0] - toxic, self.evidence[w][1] - (1 - toxic)) for w in mine}
        return _Over(changed, self.lexicon)

    def score(self, density):
        return 1 / (1 + np.exp(-(self.offset + self.slope * np.minimum(density, GRID / STEPS))))


class _Over(dict):
    """A few changed weights before a lexicon."""

    def __init__(self, changed, lexicon):
        super().__init__(changed)
        self.lexicon = lexicon

    def get(self, key, default=None):
        return super().get(key) if key in self else self.lexicon.get(key, default)


def density(n_words: int, found: list) -> float:
    return sum(f[3] for f in found) / max(n_words, 1) ** 0.5


def _train(model: Model):
    def run(it):
        g = Grammar(model.lexicon)
        for batch in it:
            texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
            step = [min(GRID, round(STEPS * density(*g.clauses(t, model.without(t, y))))) for t, y in zip(texts, toxic)]
            yield pa.RecordBatch.from_arrays([pa.array(step, pa.int32()), pa.array(toxic, pa.int32())], ["step", "toxic"])
    return run


def fit_curve(cells: list[tuple[int, int, int]], ridge: float = 0.01) -> tuple[float, float]:
    """(step, toxic, documents) -> offset and slope of the logistic curve, by Newton steps."""
    a = np.array(cells, float)
    x, y, m = np.stack([np.ones(len(a)), a[:, 0] / STEPS], 1), a[:, 1], a[:, 2]
    b = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-(x @ b)))
        gradient = x.T @ (m * (y - p)) - ridge * b
        curve = (x * (m * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.clip(np.linalg.solve(curve, gradient), -3, 3)
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(max(b[1], 0.0))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with their label: (text, toxic); ``labels`` has doc_id and toxic.

    The labels grow with the documents, so both sides are sorted and merged at every size.
    """
    y = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return docs.join(y.hint("merge"), "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, prior: float = 4.0, least: float = 2.0, min_toxic: int = 3,
        most_words: int = MOST_WORDS) -> Model:
    """Learn from the given documents (doc_id, text) and labels (doc_id, toxic).

    ``prior`` documents of the average kind are added to every word's
    evidence; ``least`` is the smallest log-odds and ``min_toxic`` the
    smallest number of toxic documents of a word of the lexicon.
    """
    texts = materialize(labelled(docs, labels), "toxicity_training")
    kinds = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(kinds) < 2:
        return Model({}, None, prior, least, min_toxic)
    base = kinds[1] / (kinds[0] + kinds[1])
    words = texts.mapInArrow(_word_documents, "word string, clean long, toxic long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= min_toxic)
    odds = F.log((F.col("toxic") + prior * base) / (F.col("clean") + prior * (1 - base))) - float(np.log(base / (1 - base)))
    words = words.withColumn("w", odds).where(F.col("w") >= least)
    best = words.orderBy(F.desc(F.col("w") * F.col("toxic")), "word").limit(most_words).collect()
    model = Model({r["word"]: (r["toxic"], r["clean"]) for r in best}, base, prior, least, min_toxic)
    cells = texts.mapInArrow(_train(model), "step int, toxic int").groupBy("step", "toxic").count().collect()  # the grid at most
    model.offset, model.slope = fit_curve([tuple(r) for r in cells])
    return model


def _score(model: Model, matches: bool):
    def run(it):
        g = Grammar(model.lexicon)
        for batch in it:
            read = [g.clauses(t) for t in batch.column("text").to_pylist()]
            cols = [batch.column("doc_id"), batch.column("held_out"), pa.array([n for n, _ in read], pa.int64()),
                    pa.array([len(f) for _, f in read], pa.int64()), pa.array([model.score(density(n, f)) for n, f in read], pa.float64())]
            names = ["doc_id", "held_out", "n_words", "n_matched", "score"]
            if matches:
                cols.append(pa.array([[{"clause": i, "first": a, "words": k, "weight": w} for i, a, k, w in f] for _, f in read],
                                     pa.list_(pa.struct([("clause", pa.int64()), ("first", pa.int64()), ("words", pa.int64()), ("weight", pa.float64())]))))
                names.append("matched")
            yield pa.RecordBatch.from_arrays(cols, names)
    return run


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
          folds: int = 4, held: int = 2, matches: bool = True, **settings) -> DataFrame:
    """One row per document: doc_id, held_out, n_words, n_matched, score, predicted, and the matched clauses.

    A clause is matched from its word ``first`` on, for ``words`` words, with
    ``weight``.  Learned from labelled documents outside the held fold only;
    the fold is crc32 of the id as text.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    d = d.withColumn("held_out", F.coalesce(fold == held, F.lit(False)))
    model = fit(d.where(~F.col("held_out")), labels.select("doc_id", "toxic"), **settings)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_words long, n_matched long, score double"
    schema += ", matched array<struct<clause:bigint,first:bigint,words:bigint,weight:double>>" * matches
    out = d.mapInArrow(_score(model, matches), schema)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
