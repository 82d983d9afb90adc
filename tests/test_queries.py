"""Every registered query against its DuckDB twin on the smallest folder."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare
from tests.conftest import SMALL


pytestmark = pytest.mark.usefixtures("shared_layers")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_twin(spark, duck, name):
    problem, _ = compare(queries()[name](spark, SMALL), oracle_sql()[name], duck)
    assert not problem


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_has_rows(spark, name):
    assert queries()[name](spark, SMALL).limit(1).count() == 1


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns[:4] == ["subject_id", "hadm_id", "stay_id", "charttime"]
    assert rows.count() > 0


def test_stage_goldens(spark):
    """Counts fixed when the derived tables were defined."""
    features = queries()["gold_features_hourly"](spark, "/root/testdata/sf0.01")
    stages = {r["kdigo_stage"]: r["count"] for r in features.groupBy("kdigo_stage").count().collect()}
    worst = {r["rolling_max_kdigo"]: r["count"] for r in features.groupBy("rolling_max_kdigo").count().collect()}
    assert stages == {0: 1878, 1: 1121, 2: 1309, 3: 90}
    assert worst == {0: 216, 1: 368, 2: 3107, 3: 707}
