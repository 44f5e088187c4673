"""Source divergence: against a brute-force count of every term in every source, and the SQL twin."""

import re
from collections import Counter

from barspark.llm import divergence
from barspark.llm.common import materialize
from barspark.llm.oracle import OP11

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BILLION = 10 ** 9


def brute(rows, top=200, min_docs=3):
    docs = [((lang or ""), (source or ""), TERM.findall((text or "").translate(LOW))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= min_docs)
        sources = sorted({d[1] for d in mine})
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2] if held[t] >= min_docs) for s in sources}
        whole = sum(count.values(), Counter())

        def share(c):
            n = sum(c.values()) + len(kept)
            return {t: 1 + BILLION * (c[t] + 1) // n for t in kept}

        p, q = {s: share(count[s]) for s in sources}, share(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(-f(p[s][t], q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, got, most in (("pair", pair, None), ("term", term, top)):
                got.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(got[:most])]
    return sorted(out)


def corpus():
    rows = []
    for i in range(90):  # many terms of equal counts: whole cells tie
        words = [f"W{chr(97 + (i * j + 3 * i) % 26)}{chr(97 + (j * j + i) % 7)}" for j in range(i % 13)]
        rows.append((i, " ".join(words) + (" naïve ÉTÉ été Été" if i % 4 == 0 else ""), ["en", "de", None][i % 3], ["a", "b", "é", None, "z"][i % 5]))
    rows += [(500 + i, "the the the hot line 12 x9y", "en", "a") for i in range(40)]  # a hot source of equal rows
    rows += [(600, None, "en", "empty"), (601, "", "fr", "only"), (602, "one two", "it", "s"), (602, "one two", "it", "s"),
             (603, "!? 12", None, "quiet"), (604, "lone " * 5000, "en", "long")]
    return rows


def collected(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def test_audit_equals_brute_force(docs_of):
    rows = corpus()
    assert collected(divergence.audit(docs_of(rows))) == brute(rows)


def test_small_tops_buckets_and_pieces_change_nothing(docs_of, monkeypatch):
    rows = corpus()
    d = divergence.audit(docs_of(rows), top=3)
    assert collected(d) == brute(rows, top=3)
    kept = materialize(divergence.kept_counts(docs_of(rows).na.fill("").select("lang", "source", "text")), "kept")
    assert kept.count() == kept.select("lang", "source", "term").distinct().count()
    groups = kept.groupBy("lang", "source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "total").selectExpr("*", "0L + 9 AS terms")
    groups = materialize(groups, "groups")
    one = divergence.pair_ranks(kept, groups, bucket=10 ** 9).collect()
    many = divergence.pair_ranks(kept, groups, bucket=1).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_counts_beyond_nine_billion_stay_exact():
    import numpy as np
    counts, total = np.array([[2 * 10 ** 10, 0]]), np.array([3 * 10 ** 10, 7])
    assert divergence._shares(counts, total).tolist() == [[1 + BILLION * (2 * 10 ** 10 + 1) // (3 * 10 ** 10), 1 + BILLION // 7]]


def test_audit_of_an_empty_table_and_twin(docs_of, table_dir, spark):
    import duckdb
    assert divergence.audit(docs_of([])).count() == 0
    rows = corpus()
    d = table_dir(documents=docs_of(rows, extra=False).coalesce(1))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet/*.parquet')")
    assert sorted(con.sql(OP11).fetchall()) == brute(rows)
