import pytest

import __spark_entry__ as entry
from conftest import SF

from topicweave.catalog import load

duckdb = pytest.importorskip("duckdb")
#: Whole chains and traces of all restarts take long; the operators behind these are held against plain loops in test_sampler.py and test_sums.py.
CHAINS = ("m20_", "m15_l2", "s9_", "m12_", "w8_", "o4_", "a27_", "m4_", "m5_v", "s5_", "s8_", "p14_", "a12_", "w3_", "w4_", "a28_")
NAMES = sorted(n for n in load()[1] if not n.startswith(CHAINS))


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def text_of(value) -> str:
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations", "benchmark", "embeddings", "events"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    columns, rows = sorted(want.columns), want.fetchall()
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == columns
    wanted = sorted(tuple(text_of(r[want.columns.index(c)]) for c in columns) for r in rows)
    assert sorted(tuple(text_of(r[c]) for c in columns) for r in got.collect()) == wanted


def test_chains_run_as_long_as_the_defaults_of_their_operators():
    import inspect

    from topicweave.catalog import evaluation, modelling
    from topicweave.plans import study, variational

    of = inspect.signature(study.run_study).parameters
    want = of["sweeps"].default, of["keep_from"].default
    assert (evaluation.STUDY_SWEEPS, evaluation.STUDY_FROM) == (modelling.SWEEPS, modelling.KEPT_FROM) == want
    assert modelling.PASSES == inspect.signature(variational.fit).parameters["passes"].default


def test_samples_in_sql_are_those_after_burn_in():
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    assert con.sql(f"SELECT DISTINCT sweeps FROM ({entry.oracle_sql()['a12_posterior_mean']})").fetchall() == [(10,)]
    assert {r[0] for r in con.sql(f"SELECT iter FROM ({entry.oracle_sql()['s8_window_flush']})").fetchall()} == set(range(21, 31))


def test_entry_without_a_library_of_the_subpackage():
    """The other queries are registered all the same, with a warning."""
    import subprocess
    import sys

    code = (
        "import sys, warnings; sys.modules['xxhash'] = None; warnings.simplefilter('error', UserWarning)\n"
        "try:\n    import __spark_entry__\nexcept UserWarning as w:\n    assert 'xxhash' in str(w)\nelse:\n    raise SystemExit('no warning')\n"
        "sys.modules.pop('__spark_entry__', None); warnings.simplefilter('ignore'); import __spark_entry__ as e\n"
        "assert len(e.queries()) > 150 and not any(n.startswith('op') for n in e.queries())")
    if (llm := pytest.importorskip("topicweave.llm", reason="the subpackage is left out")):
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=entry.os.path.dirname(entry.__file__))
        assert done.returncode == 0, done.stderr
