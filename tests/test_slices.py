"""The streaming job in many micro-batches: late rows, journal, state that is purged,
settings that a restart may not change."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stationflow.plans import slices as SL
from stationflow.session import _file_system
from stationflow.sources import events as E
from stationflow.sources.feeds import read_messages
from stationflow.streaming.journal import ProgressJournal, read_journal
from stationflow.streaming.utilization import STATE_BYTES, partitions_for, start_utilization_stream


@pytest.fixture(scope="module")
def run(spark):
    return SL.run_slices(spark, SF_SMALL, "snapshot", late=True)


def test_journal_adds_up_and_names_the_late_rows(spark, run):
    journal = read_journal(spark, run["journal"])
    batches = journal.orderBy("batch_id").collect()
    assert len(batches) >= 10 and len({b.batch_id for b in batches}) == len(batches)
    landed = spark.read.json([run[f] for f in ("info", "status", "weather")], recursiveFileLookup=True).count()
    assert sum(b.input_rows for b in batches) == landed
    late = SL.late_status(spark, run)
    assert late.count() == sum(b.dropped_rows for b in batches) > 0


def test_state_holds_a_slice_and_ends_with_the_last_poll(spark, run):
    batches = read_journal(spark, run["journal"]).orderBy("batch_id").collect()
    most = max(b.input_rows for b in batches)
    # two joins, each with keys and counts on both sides, over a slice and the one before
    assert max(b.state_rows for b in batches) < 8 * most
    last = E.read_table(spark, SF_SMALL, "events").agg(F.date_trunc("hour", F.max("ts"))).first()[0]
    rows = 0
    for operator in (0, 1):
        for side in ("left", "right"):
            state = (spark.read.format("statestore").option("operatorId", operator).option("joinSide", side)
                     .load(run["checkpoint"]).select("key.*"))
            # keyed on the event time and the salt, or the station
            place = next(i for i, f in enumerate(state.schema) if f.dataType.typeName().startswith("timestamp"))
            times = [r[place] for r in state.collect()]
            rows += len(times)
            assert all(t >= last for t in times)
    assert rows > 0


def test_changed_settings_are_refused(spark, run, tmp_shared):
    def start(**kw):
        feeds = [read_messages(spark, path=run[f]) for f in ("info", "status", "weather")]
        return start_utilization_stream(*feeds, sink_path=f"{tmp_shared}/out", checkpoint_path=run["checkpoint"],
                                        trigger={"availableNow": True}, **kw)

    for changed in ({"mode": "event_time"}, {"mode": "snapshot", "salt_buckets": 4},
                    {"mode": "snapshot", "watermark": "5 minutes"}):
        with pytest.raises(ValueError, match="other settings"):
            start(**changed)
    start(mode="snapshot").awaitTermination()                    # the same settings go on: nothing is new


def test_journal_holds_the_exception_of_a_failed_query(spark, tmp_shared):
    spark.range(1).selectExpr("'k' AS key", "'v' AS value").write.json(f"{tmp_shared}/in")
    journal = ProgressJournal(spark, f"{tmp_shared}/journal")
    spark.streams.addListener(journal)

    def fails(batch, batch_id):
        raise RuntimeError("broken batch")

    try:
        q = (read_messages(spark, path=f"{tmp_shared}/in").writeStream.foreachBatch(fails)
             .option("checkpointLocation", f"{tmp_shared}/ckpt").trigger(availableNow=True).start())
        with pytest.raises(Exception):
            q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(journal)
    errors = [r.error for r in read_journal(spark, f"{tmp_shared}/journal").collect() if r.error]
    assert len(errors) == 1 and "broken batch" in errors[0]


def test_state_partitions_follow_the_data_of_a_batch(spark, run):
    fs, where = _file_system(spark, f"{run['checkpoint']}/state/0")
    held = [f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory() and f.getPath().getName().isdigit()]
    # the session deals batch shuffles over 8; a slice here is far smaller than one partition may be
    assert len(held) == spark.sparkContext.defaultParallelism == 4
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert partitions_for(spark, 6 * STATE_BYTES) == 6 and partitions_for(spark, 100 * STATE_BYTES) == 8
