"""The pipeline's stages on a small folder of tables."""

from __future__ import annotations

import random

import corpus
import corpus_pipeline
import pytest
from test_tokens import check_packed

from tessera.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(11)
    item = "every quiet river bends twice before the old stone bridge and then runs straight to the sea"
    rows = [(i, corpus.words(rnd, 60).capitalize() + ".") if i % 5 else (i, " ".join(f"{w}***" for w in corpus.words(rnd, 60).split())) for i in range(200)]
    rows += [(300, rows[1][1]), (301, rows[1][1]), (302, f"{corpus.words(rnd, 40)} {item} {corpus.words(rnd, 10)}"), (303, f"{corpus.words(rnd, 40)} +1 (202) 555-0199 {corpus.words(rnd, 10)}"), (304, None), (305, "")]
    labels = [(i, int(i % 5 != 0), 0) for i in range(0, 200)]
    return corpus.tables(spark, str(tmp_path_factory.mktemp("tables")), rows, labels, [(1, item)])


def test_stages(spark, folder, tmp_path):
    docs, names = spark.read.parquet(f"{folder}/documents.parquet"), [n for n, _ in corpus_pipeline.STAGES]
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = docs
    ids = [{r["doc_id"] for r in kept[n].select("doc_id").collect()} for n in names]
    assert all(kept[n].columns == ["doc_id", "text", "lang", "source", "n_chars"] for n in names[:-1])
    assert {i for i in range(200) if i % 5} <= ids[0] and not ids[0] & {i for i in range(200) if not i % 5}
    assert {1} <= ids[1] and not {300, 301} & ids[1]
    assert 302 in ids[1] and 302 not in ids[2] and len(ids[1] - ids[2]) == 1
    assert ids[2] == ids[3] == ids[4]
    masked = {r["doc_id"]: r for r in kept[names[3]].collect()}
    assert "<phone>" in masked[303]["text"] and "555" not in masked[303]["text"] and masked[303]["n_chars"] == len(masked[303]["text"])
    check_packed([(r["doc_id"], r["text"]) for r in masked.values()], docs.collect())


def test_run_gives_the_last_stage(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_every_operator_has_its_query():
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{k}" for k in range(1, 11)}


def run_stages(spark, folder: str, out: str) -> list:
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{out}/{k}")
        docs = spark.read.parquet(f"{out}/{k}")
        found.append(docs)
    return found


def test_rows_go_by_themselves(spark, tmp_path):
    """Equal and null ids, contaminated and copied texts under them: each row is judged alone."""
    rnd = random.Random(12)
    item = "every quiet river bends twice before the old stone bridge and then runs straight to the sea"
    good = lambda n: corpus.words(rnd, n).capitalize() + "."
    rows = [(i, good(60)) if i % 5 else (i, " ".join(f"{w}***" for w in corpus.words(rnd, 60).split())) for i in range(100)]
    twin, alone, null_alone = good(50), good(50), good(50)
    rows += [(200, twin), (201, twin), (201, alone), (None, twin), (None, null_alone), (None, f"{good(30)} {item} {good(20)}"), (202, f"{good(30)} {item} {good(20)}"), (202, good(40))]
    labels = [(i, int(i % 5 != 0), 0) for i in range(100)]
    folder = corpus.tables(spark, f"{tmp_path}/tables", rows, labels, [(1, item), (None, None), (2, "")])
    kept = [{(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()} for docs in run_stages(spark, folder, f"{tmp_path}/out")[:3]]
    gone = kept[0] - kept[1]
    assert gone == {(201, twin), (None, twin)} and {(201, alone), (200, twin), (None, null_alone)} <= kept[1]
    assert {t for _, t in kept[1] - kept[2]} == {t for _, t in rows if item in t} and (202, rows[-1][1]) in kept[2]


@pytest.mark.parametrize("rows", [[], [(None, None), (None, ""), (3, " ")]])
def test_tables_with_nothing_in_them(spark, tmp_path, rows):
    folder = corpus.tables(spark, f"{tmp_path}/tables", rows, [], [])
    found = run_stages(spark, folder, f"{tmp_path}/out")
    assert [d.columns for d in found[:-1]] == [["doc_id", "text", "lang", "source", "n_chars"]] * 4
    assert found[-1].count() == len({r[0] for r in rows[-1:]})


def test_finished_stages_are_removed(spark, folder):
    import glob

    tables = lambda: set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/table-*"))
    before = tables()
    corpus_pipeline.run(spark, folder)
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert tables() == before
    assert [p[-1] for p in glob.glob(f"{root}/pipeline-*/*")] and all(p.endswith("/4") for p in glob.glob(f"{root}/pipeline-*/*"))
