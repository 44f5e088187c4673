"""Toxicity grammar: clause by clause against a reading of the rules, and held-out accuracy on the given labels."""

import random
import zlib

import pytest

from barspark.llm import toxicity
from barspark.llm.queries import QUERIES
from barspark.llm.toxicity import AIM, CLAUSE, DENIAL, HARM, REPORTED, TOKENS, Grammar

SF = "/root/testdata/sf0.1"


def brute(text, lexicon):
    """Every token looked at with the tokens before it, no states kept."""
    fixed, total = toxicity.symbols(), 0.0
    for part in CLAUSE.split(text.lower()):
        tokens = TOKENS.findall(part)
        kind = [toxicity.INSULT if t in lexicon else fixed.get(t, toxicity.WORD) for t in tokens]
        mark = (toxicity.COMMA, toxicity.QUOTE)

        def within(i, what, reach, stops=()):
            seen = 0
            for j in range(i - 1, -1, -1):
                if kind[j] == what:
                    return True
                if kind[j] in stops:
                    return False
                seen += kind[j] not in mark
                if seen >= reach:
                    return False
            return False

        for i, t in enumerate(tokens):
            lower = DENIAL if within(i, toxicity.NEGATION, toxicity.NEGATED, (toxicity.COMMA,)) else 1.0
            said = toxicity.REPORT in kind[:i] or kind[:i].count(toxicity.QUOTE) % 2 == 1
            lower *= REPORTED if said else 1.0
            if kind[i] == toxicity.INSULT:
                total += lexicon[t] * lower * (AIM if within(i, toxicity.TARGET, toxicity.AIMED) else 1.0)
            elif kind[i] == toxicity.TARGET and within(i, toxicity.THREAT, toxicity.WAITING, (toxicity.TARGET,)):
                total += HARM * lower
    return total


def test_automaton_equals_the_rules():
    r = random.Random(5)
    lexicon = {"moron": 2.5, "scum": 3.0}
    g = Grammar(lexicon)
    pool = ["moron", "scum", "you", "they", "not", "never", "said", "kill", "hurt", ",", '"', ".", "\n", "stone", "river", "light", "house"]
    for _ in range(3000):
        text = " ".join(r.choice(pool) for _ in range(r.randrange(1, 25)))
        n, found = g.clauses(text)
        assert sum(f[3] for f in found) == pytest.approx(brute(text, lexicon)), text
        assert n == len(toxicity.WORDS.findall(text.lower()))


def test_clauses_and_their_places():
    g = Grammar({"moron": 2.0})
    n, found = g.clauses("A fine day. You moron, go! He said \"moron\" and left; not a moron. I will hurt you")
    assert n == 18 and [f[:3] for f in found] == [(1, 3, 3), (2, 6, 5), (3, 11, 3), (4, 14, 4)]
    aimed, told, denied, threat = (f[3] for f in found)
    assert aimed == 2 * AIM and told == 2 * AIM * REPORTED and denied == 2 * DENIAL and threat == HARM
    assert g.clauses("") == (0, []) and g.clauses(None) == (0, []) and g.clauses("MORON")[1][0][3] == 2.0


def planted(n=400, seed=2):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = [r.choice("stone river light paper house tree wind".split()) + str(r.randrange(3)) for _ in range(r.choice([20, 60, 200]))]
        w = [x.rstrip("012") + r.choice(["al", "en", "ir"]) for x in w]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2 + len(w) // 30):
                w.insert(r.randrange(len(w)), r.choice(["grobnik", "vlaster", "zumpf"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learns_words_only_from_the_training_fold(docs_of, spark):
    rows, labels = planted()
    lab = spark.createDataFrame(labels + [(None, 1), (3, None), (5000, 1), (5001, 7)], "doc_id long, toxic int")
    d = docs_of(rows + [(9000, None), (9001, ""), (None, "grobnik zumpf " * 9), (1, rows[1][1]), (9002, "tree " * 30000)])
    got = toxicity.score(d, lab).collect()
    assert len(got) == len(rows) + 5
    by = {x.doc_id: x for x in got}
    right = [by[i].predicted == t for i, t in labels]
    assert sum(right) >= 0.97 * len(right)
    for i, _ in labels:
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert by[9000].score == by[9001].score and by[9000].predicted == 0 and by[None].held_out is False and by[None].predicted == 1
    assert all(0 <= x.score <= 1 for x in got) and by[9002].predicted == 0
    held = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2}
    turned = spark.createDataFrame([(i, 1 - t if i in held else t) for i, t in labels], "doc_id long, toxic int")
    again = {x.doc_id: x.score for x in toxicity.score(docs_of(rows), turned).collect()}
    same = toxicity.score(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert all(again[x.doc_id] == x.score for x in same)  # held-out labels change nothing


def test_leaving_a_document_out_equals_training_without_it(docs_of, spark):
    rows, labels = planted(150)
    texts = dict(rows)
    d = docs_of(rows).select("doc_id", "text")
    full = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    for i in (0, 1, 5):
        rest = spark.createDataFrame([x for x in labels if x[0] != i], "doc_id long, toxic int")
        less = toxicity.fit(d, rest)
        over = full.without(texts[i], dict(labels)[i])
        less.base = full.base  # the share of toxic documents stays that of all
        for w in ("grobnik", "vlaster", "zumpf"):
            want = less.weight(*less.evidence.get(w, (0, 0)))
            if w in texts[i].split():
                assert over.get(w, 0.0) == pytest.approx(want)


def test_without_labels_and_without_rows(docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = {x.doc_id: x for x in toxicity.score(docs_of([(1, "you idiot, you scum"), (2, "a calm day")]), none).collect()}
    assert got[1].predicted == 1 and got[2].predicted == 0 and got[1].matched[0].weight > 0
    assert toxicity.score(docs_of([]), none).count() == 0


def test_curve_separates_a_grid():
    offset, slope = toxicity.fit_curve([(0, 0, 100), (0, 1, 3), (64, 1, 40), (64, 0, 2), (128, 1, 60)])
    score = lambda x: 1 / (1 + 2.718281828 ** -(offset + slope * x))
    assert score(0) == pytest.approx(3 / 103, abs=0.01) and score(1) == pytest.approx(40 / 42, abs=0.03) and slope > 0


def test_held_out_accuracy_on_the_given_labels(spark):
    got = QUERIES["op13_toxicity"](spark, SF)
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    held = got.where("held_out").join(lab, "doc_id").collect()
    caught = [r.predicted for r in held if r.toxic == 1]
    spared = [1 - r.predicted for r in held if r.toxic == 0]
    assert len(held) > 500 and sum(caught) / len(caught) >= 0.9 and sum(spared) / len(spared) >= 0.99
