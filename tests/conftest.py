import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tierweave.session import local_session

    s = local_session("4", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def records(spark):
    """Builder of record frames from partial dicts."""
    from pyspark.sql import functions as F

    from tierweave import schemas

    def build(rows, slug=False):
        full = [{f.name: r.get(f.name) for f in schemas.RECORD.fields} for r in rows]
        df = spark.createDataFrame([tuple(x.values()) for x in full], schemas.RECORD)
        if slug:
            keys = spark.createDataFrame([(r["seq"], r["slug"]) for r in rows], "seq long, slug string")
            df = df.join(F.broadcast(keys), "seq")
        return df

    return build
