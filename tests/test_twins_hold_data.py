"""No SQL twin may be green on nothing: every one yields rows, and a value in every column that can hold one."""

import pytest

from oracle_harness import duck
from paths import SF_MID

from barspark.plans.registry import REGISTRY

#: Columns that are null by the data model: the given tables know no adjusted close, industry or exchange.
NULL_BY_MODEL = {"adj_close", "industry", "exchange"}
#: Rolling statistics that intraday bars do not have, and errors of runs that do not fail.
NULL_BY_RULE = {"features_hourly": {"close_rolling_mean_20", "close_rolling_std_20", "volume_rolling_mean_20"},
                "training_summary": {"error"}}
TWINS = [n for n, (_, sql) in REGISTRY.items() if sql is not None]


@pytest.fixture(scope="module")
def con():
    return duck(SF_MID)


@pytest.mark.parametrize("name", TWINS)
def test_twin_holds_data(con, name):
    d = con.sql(REGISTRY[name][1]).df()
    assert len(d), f"{name} gives no rows"
    allowed = NULL_BY_RULE.get(name, set()) | (NULL_BY_MODEL if name != "vendor_mixed_headers" else set())
    empty = [c for c in d.columns if c not in allowed and d[c].isna().all()]
    assert not empty, f"{name}: no value in {empty}"


def test_planted_faults_are_found(con):
    found = dict(con.sql(REGISTRY["dq_checks"][1]).fetchall())
    assert all(found[k] > 0 for k in ("pk_dim_symbol", "fk_symbol", "unique_date_symbol", "low_le_open_close_le_high", "not_null_open"))
    texts = [t[0] for t in con.sql(f"SELECT price_text FROM ({REGISTRY['price_label'][1]})").fetchall()]
    assert {t[0] for t in texts} == {"₹", "$"}
    assert any("." in s and "." not in stem for s, stem in con.sql(f"SELECT symbol, stem FROM ({REGISTRY['file_stems'][1]})").fetchall())
