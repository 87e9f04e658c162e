"""Every registered query against its DuckDB oracle on the smallest input."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: "NULL" if v is None else (f"{v:.6g}" if isinstance(v, float) else str(v))
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows))
                          .encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["partition_message_type", "partition_date", "row_count"]
    assert df.count() == 150


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) > 0
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_writes_stay_under_checkpoint_dir(spark):
    from lakeferry.session import checkpoint_root, scratch_path

    assert scratch_path(spark, "x").startswith(checkpoint_root(spark))
    assert not scratch_path(spark, "x").startswith(os.path.dirname(SF))


class _Ctx:
    def __init__(self, master, conf_dir=None):
        self.master, self._dir = master, conf_dir
        self.set_to = None

    def getCheckpointDir(self):
        return self.set_to

    def getConf(self):
        return {"spark.checkpoint.dir": self._dir} if self._dir else {}

    def setCheckpointDir(self, d):
        self.set_to = d


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    def __init__(self, ctx):
        self.sparkContext, self.conf = ctx, _Conf()


def test_scratch_folder_is_shared_on_a_cluster():
    import pytest

    from lakeferry.session import checkpoint_root

    shared = _Session(_Ctx("yarn", "hdfs:///shared/ckpt"))
    assert checkpoint_root(shared) == "hdfs:///shared/ckpt"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session(_Ctx("spark://host:7077")))
