"""Versioned tables, the promotion log and the metric history."""

import pytest
from pyspark.sql import functions as F

from vitrine.operators import gate
from vitrine.sources.snapshots import Conflict, Snapshots
from vitrine.sources.tables import Tables


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.fixture
def log(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "t"))


def test_versions_stay_readable(spark, log):
    assert log.newest() == 0 and log.versions() == []
    with pytest.raises(LookupError):
        log.read()
    assert log.append(spark.range(3)) == 1
    assert log.append(spark.range(3, 5)) == 2
    assert log.replace(log.read().where("id > 2").withColumn("extra", F.lit("x"))) == 3  # reads the table it replaces
    assert [ids(log.read(n)) for n in (1, 2, 3)] == [[0, 1, 2], [0, 1, 2, 3, 4], [3, 4]]
    assert log.read().columns == ["id", "extra"] and ids(log.read()) == [3, 4]
    times = [m["written_at"] for _, m in log.versions()]
    assert ids(log.read(as_of=times[1])) == [0, 1, 2, 3, 4]
    with pytest.raises(LookupError):
        log.read(as_of=times[0] - 1)


def test_failed_write_leaves_the_old_version(spark, log):
    log.replace(spark.range(4))
    broken = spark.range(8).repartition(4).select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        log.replace(broken)
    assert log.newest() == 1 and ids(log.read()) == [0, 1, 2, 3]
    # A writer that died while it wrote its manifest has published nothing, and its number is not used again.
    fs, where = log._hadoop(f"{log._log}/{2:012d}")
    stream = fs.create(where, False)
    stream.write(b'{"folders": [')
    stream.close()
    assert ids(log.read()) == [0, 1, 2, 3]
    assert log.append(spark.range(9, 10)) == 3 and ids(log.read()) == [0, 1, 2, 3, 9]


def test_of_two_writers_on_one_version_one_wins(spark, tmp_path):
    first, second = (Snapshots(spark, str(tmp_path / "t")) for _ in range(2))
    base = first.append(spark.range(1))
    first.append(spark.range(1, 2), base)
    with pytest.raises(Conflict):
        second.append(spark.range(2, 3), base)
    # The other one publishes between this writer's look and its manifest.
    publish = second._publish

    def late(number, manifest):
        first.append(spark.range(5, 6))
        second._publish = publish
        return publish(number, manifest)

    second._publish = late
    with pytest.raises(Conflict):
        second.append(spark.range(3, 4), 2)
    second._publish = late
    second.append(spark.range(4, 5))  # without an expectation it builds on what is there by then
    assert ids(second.read()) == [0, 1, 4, 5, 5]


def test_replaced_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.append(spark.range(2), "gold", "log")
    tables.append(spark.range(2, 3), "gold", "log")
    assert ids(tables.read("gold", "log")) == [0, 1, 2]
    tables.replace(spark.range(9), "gold", "t", "id int")
    tables.replace(tables.read("gold", "t").where("id < 2"), "gold", "t")
    tables.append(spark.range(7, 8), "gold", "t", "id int")
    assert ids(tables.read("gold", "t")) == [0, 1, 7] and ids(tables.snapshots("gold", "t").read(1)) == list(range(9))


COLUMNS = "promoted_at timestamp, model_name string, alias string, from_version int, to_version int, gate_status string, promoted_by string"


def promotion(spark, *rows):
    at = F.lit("2024-01-01").cast("timestamp")
    return spark.createDataFrame([(None, "m", "production", v - 1, v, status, "me") for v, status in rows], COLUMNS).withColumn("promoted_at", at)


def test_promotions(spark, log):
    assert gate.promote(log, promotion(spark, (1, "PASSED"), (2, "FORCED")), 0) == 1
    for refused in ("FAILED", None):
        with pytest.raises(ValueError, match="failed its gate"):
            gate.promote(log, promotion(spark, (3, "PASSED"), (4, refused)))
    with pytest.raises(Conflict):
        gate.promote(log, promotion(spark, (3, "PASSED")), 0)
    assert gate.promote(log, promotion(spark, (3, "PASSED")), 1) == 2
    assert sorted(r["to_version"] for r in log.read().collect()) == [1, 2, 3]


def test_evaluation_is_folded_once(spark, log):
    runs = []

    def evaluate():
        runs.append(1)
        return spark.createDataFrame([("overall", "all", 0.5)], "slice_dim string, slice_value string, ndcg_at_20 double")

    assert gate.fold_evaluation(log, evaluate, "m", "1", "2024-01-01")
    assert not gate.fold_evaluation(log, evaluate, "m", "1", "2024-01-01")
    assert gate.fold_evaluation(log, evaluate, "m", "1", "2024-01-02")
    assert gate.fold_evaluation(log, evaluate, "m", "2", "2024-01-02")
    assert len(runs) == 3 and log.read().count() == 3


def test_stored_history_needs_no_search(spark):
    from vitrine.plans import evaluation
    from vitrine.plans.inputs import Inputs

    i = Inputs(spark, "/root/testdata/sf0.001")
    plan = gate.metric_trend(evaluation.history(i))._jdf.queryExecution().optimizedPlan().toString()
    assert "Arrow" not in plan and "Join" not in plan


def test_promotion_is_signed(spark, log):
    gate.promote(log, promotion(spark, (1, "PASSED")).withColumns({"promoted_by": F.lit(None).cast("string"), "promoted_at": F.lit(None).cast("timestamp")}))
    row = log.read().first()
    assert row["promoted_by"] == spark.range(1).select(F.current_user()).first()[0] and row["promoted_at"] is not None
