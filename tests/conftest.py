import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vacantia.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8")


@pytest.fixture
def run(spark):
    """Evaluate one column over a list of inputs (tuples become columns ``a, b, ...``)."""
    def apply(build, inputs, types="string"):
        from pyspark.sql import functions as F

        rows = [v if isinstance(v, tuple) else (v,) for v in inputs]
        names = "abcdefgh"[: len(rows[0])]
        kinds = types if isinstance(types, (list, tuple)) else [types] * len(names)
        schema = ", ".join(["n int", *[f"{c} {k}" for c, k in zip(names, kinds)]])
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
        out = df.select("n", build(*[F.col(c) for c in names]).alias("out")).collect()
        return [r["out"] for r in sorted(out)]

    return apply
