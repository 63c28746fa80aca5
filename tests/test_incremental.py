"""A training table in appends equals one run over all readings."""

import glob
import random
import tempfile

import pytest
from pyspark.sql.utils import AnalysisException

from faultline.operators import features as feat
from faultline.operators import incremental
from faultline.schemas import SENSOR_SCHEMA

FRAMES = [("avg", 5_000, "1h"), ("max", 2_000, "1min")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(rng, start, end):
    """Integer-valued readings (exact sums), several at one time, one machine silent in the second half."""
    return [(m, t, float(rng.randrange(1, 90)), float(rng.randrange(1, 9)), float(t % 7 + 1), 2.0, "A", t % 2)
            for t in range(start, end, 250) for m in (1, 1, 2, 3) if m != 3 or t < 20_000]


def test_appends_equal_one_run(spark):
    rng, path = random.Random(1), tempfile.mkdtemp(prefix="faultline-test-inc-")
    cuts = [0, 14_250, 14_500, 33_000, 40_000]
    batches = [made(rng, a, b) for a, b in zip(cuts, cuts[1:])]
    batches[1] += batches[0][-1:]            # a reading at its machine's last time
    batches.insert(2, [])                    # an empty append
    for k, batch in enumerate(batches):
        source = f"{path}/in-{k}"
        spark.createDataFrame(batch, SENSOR_SCHEMA).write.parquet(source)
        incremental.append(spark, spark.read.parquet(source), f"{path}/t", k, FRAMES)
        for f in glob.glob(f"{source}/*.parquet"):   # no later append reads it
            with open(f, "wb") as out:
                out.write(b"gone")
    everything = spark.createDataFrame([r for b in batches for r in b], SENSOR_SCHEMA)
    want = rows(feat.training_table(everything, FRAMES))
    assert rows(incremental.read(spark, f"{path}/t")) == want and len(want) > 300
    kept = spark.read.parquet(f"{path}/t/state/4")
    assert kept.where("machine_id = 1").count() <= 5_000 / 250 + 1


def test_late_repeated_and_missing(spark):
    path = tempfile.mkdtemp(prefix="faultline-test-inc-") + "/t"
    make = lambda times: spark.createDataFrame(
        [(m, t, 1.0 + t % 5, 1.0, 1.0, 2.0, "A", 0) for m, t in times], SENSOR_SCHEMA)
    incremental.append(spark, make([(1, t) for t in range(0, 9_000, 500)]), path, 0, FRAMES)
    second = make([(1, 9_000), (1, 3_000), (2, 100), (2, 400), (1, 9_600)])
    incremental.append(spark, second, path, 1, FRAMES)
    once = rows(incremental.read(spark, path))
    assert [(r.machine_id, r.timestamp_ms) for r in spark.read.parquet(f"{path}/late").collect()] == [(1, 3_000)]
    taken = [(1, t) for t in [*range(0, 9_000, 500), 9_000, 9_600]] + [(2, 100), (2, 400)]
    assert once == rows(feat.training_table(make(taken), FRAMES))
    incremental.append(spark, second, path, 1, FRAMES)
    assert rows(incremental.read(spark, path)) == once
    with pytest.raises(AnalysisException):
        incremental.append(spark, second, path, 7, FRAMES)
