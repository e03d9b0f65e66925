"""Topics kept as files: offsets, restarts, lost data."""

import json

import pytest

from keyflow.sources import records, topics


def segment(folder, partition, first, values):
    at = folder / str(partition)
    at.mkdir(parents=True, exist_ok=True)
    rows = [{"key": f"k{v}", "value": None if v is None else f"v{v}", "headers": [{"key": "domainId", "value": f"d{v}"}], "timestamp": 1_700_000_000_000 + (v or 0)} for v in values]
    (at / f"{first:020d}-{first + len(rows):020d}.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n")


def run(spark, cfg, out, checkpoint):
    df = records.normalize_raw(records.read_raw(spark, cfg))
    df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return sorted((r["partition"], r["offset"], r["raw_value"], r["domain_id"]) for r in spark.read.parquet(out).collect())


def test_a_restarted_stream_loses_and_repeats_nothing(spark, tmp_path):
    topic, out, cp = tmp_path / "scans", str(tmp_path / "out"), str(tmp_path / "cp")
    segment(topic, 0, 10, range(0, 25))
    segment(topic, 0, 35, range(25, 30))
    segment(topic, 1, 0, [100, None, 102])
    cfg = {"format": topics.NAME, "path": str(topic), "options": {"rowsPerPartition": "7"}}
    want = [(0, 10 + i, f"v{i}", f"d{i}") for i in range(30)] + [(1, 0, "v100", "d100"), (1, 2, "v102", "d102")]
    assert run(spark, cfg, out, cp) == want
    assert run(spark, cfg, out, cp) == want
    segment(topic, 0, 40, range(30, 33))
    segment(topic, 2, 5, [200])  # a partition that was not there
    (topic / "0" / f"{10:020d}-{35:020d}.jsonl").unlink()  # read long ago
    (topic / "0" / "rubbish.tmp").write_text("x")
    want += [(0, 40 + i, f"v{30 + i}", f"d{30 + i}") for i in range(3)] + [(2, 5, "v200", "d200")]
    assert run(spark, cfg, out, cp) == sorted(want)
    batch = records.read_raw(spark, cfg, stream=False)
    assert batch.count() == 5 + 3 + 3 + 1 and batch.rdd.getNumPartitions() == 4
    assert {r["topic"] for r in batch.collect()} == {"scans"} and batch.where("value is null").count() == 1


def test_latest_and_lost_offsets(spark, tmp_path):
    topic, out, cp = tmp_path / "scans", str(tmp_path / "out"), str(tmp_path / "cp")
    segment(topic, 0, 0, range(5))
    cfg = {"format": topics.NAME, "path": f"file://{topic}", "topic": "t", "starting_offsets": "latest"}
    q = records.read_raw(spark, cfg).writeStream.format("memory").queryName("latest_rows").option("checkpointLocation", cp).start()
    try:
        q.processAllAvailable()
        segment(topic, 0, 5, range(5, 8))
        q.processAllAvailable()
        assert sorted(r["offset"] for r in spark.table("latest_rows").collect()) == [5, 6, 7]
    finally:
        q.stop()
    spans = topics.Topic({"path": str(topic)}).spans
    assert [(s.first, s.last) for s in spans({"0": 3}, {"0": 7})] == [(3, 5), (5, 7)]
    (topic / "0" / f"{0:020d}-{5:020d}.jsonl").unlink()
    with pytest.raises(topics.DataLost, match="partition 0: offsets 3 to 4"):
        spans({"0": 3}, {"0": 7})
    assert [(s.first, s.last) for s in topics.Topic({"path": str(topic), "failondataloss": "false"}).spans({"0": 3}, {"0": 9})] == [(5, 8)]
    with pytest.raises(topics.DataLost, match="offsets 8 to 8"):
        spans({"0": 6}, {"0": 9})
    assert topics.Topic({"path": str(tmp_path / "none")}).latest() == {}
    assert records.topic_options({"servers": "s", "topic": "t", "starting_offsets": "odd"})["startingOffsets"] == "earliest"
