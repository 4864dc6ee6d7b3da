"""Upload events as a stream into the engine, stopped between its writes."""

import json

import pytest
from test_engine import Clock

from tessera.plans.engine import Engine
from tessera.streaming import receipts as streams


def arrive(folder, name, keys):
    record = lambda k, i: {"eventName": "ObjectCreated:Put", "s3": {"bucket": {"name": "b"}, "object": {"key": k, "sequencer": f"{i:04d}"}}}
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"Records": [record(k, i) for i, k in enumerate(keys)]}))


def registry(engine):
    subs = {r["submissionId"]: (list(r["fileIds"]), r["receivedFileCount"], r["status"]) for r in engine.state("submissions").collect()}
    return subs, sorted((r["submissionId"], r["fileId"], r["key"]) for r in engine.log("receipts").collect())


WAVES = [["ingestion/s1/a.json", "ingestion/s1/b.json", "ingestion/s2/a.json", "other/x", "ingestion/s1/a.json"], ["ingestion/s2/a.json", "ingestion/s2/c.json", "ingestion/s3/z.json"]]


@pytest.fixture(scope="module")
def unbroken(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("unbroken")
    engine = Engine(spark, f"file://{root}", clock=Clock())
    for i, keys in enumerate(WAVES):
        arrive(root / "events", f"{i}.json", keys)
        engine.receive_stream(streams.upload_events(spark, str(root / "events")), f"file://{root}/progress")
    return registry(engine)


def test_files_are_recorded_once(unbroken):
    subs, receipts = unbroken
    assert subs == {"s1": (["a.json", "b.json"], 2, "RECEIVING"), "s2": (["a.json", "c.json"], 2, "RECEIVING"), "s3": (["z.json"], 1, "RECEIVING")}
    assert len(receipts) == 5


@pytest.mark.parametrize("lost", ["receipts", "submissions", "audit_log"])
@pytest.mark.parametrize("wave", [0, 1])
def test_a_stopped_batch_is_mended(spark, tmp_path, unbroken, lost, wave):
    """One of a batch's writes doesn't happen; the batch comes again to a new engine, and the registry is that of an unbroken run."""
    clock = Clock()  # time goes on while engines begin anew
    for i, keys in enumerate(WAVES):
        arrive(tmp_path / "events", f"{i}.json", keys)
        engine = Engine(spark, f"file://{tmp_path}", clock=clock)
        take = lambda e: e.receive_stream(streams.upload_events(spark, str(tmp_path / "events")), f"file://{tmp_path}/progress")
        if i == wave:
            write = engine.append

            def append(name, rows, seq):
                if name == lost:
                    raise OSError("stopped here")
                write(name, rows, seq)

            engine.append = append
            with pytest.raises(Exception, match="stopped here"):
                take(engine)
            engine = Engine(spark, f"file://{tmp_path}", clock=clock)
        take(engine)
    assert registry(engine) == unbroken


def test_events_given_again_write_no_submission(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}", clock=Clock())
    arrive(tmp_path / "events", "0.json", WAVES[0])
    for _ in range(2):
        engine.receive(spark.read.schema(streams.UPLOAD_EVENT).json(str(tmp_path / "events")))
    assert engine.log("submissions").count() == 2
