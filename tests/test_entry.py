"""The driver contract in __spark_entry__.py."""
import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_contract(spark):
    m = _entry_module()
    df = m.entry(spark)
    assert df.count() > 0
    assert {"stt", "edt", "uv_ct", "pv_ct"} <= set(df.columns)
    q, o = ({k: v for k, v in x.items() if not k.startswith(("op", "pipeline"))}
            for x in (m.queries(), m.oracle_sql()))
    assert len(q) >= 89 and set(o) <= set(q)
    assert set(q) == set(o)
