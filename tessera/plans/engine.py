"""The ingestion workflow over logs in one folder: receive, complete, coordinate, refresh, query, monitor.

Each registry is an append-only Parquet log with a sequence column; a step reads the latest states, computes its rows
with the operators and appends them. Contents never pass a shuffle before they are unique: hashes and keys do, and
only claimed files are read into the renderer.

Claims of raw files are safe between writers: a step writes its claims, then tries to make the next of a row of
numbered commit objects. If another step has made that one, the claims don't count and are computed again with the
other's in sight, so each content has one owner. The remaining registries take one writer a key (a submission is
completed by one step at a time, and so are files with equal texts or business keys), and compaction takes one writer in all.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .. import schemas
from ..functions import keys, markdown
from ..functions.text import CHUNK_CHARS
from ..operators import attach, chunking, dedupe, indexing, monitor, readiness, receipts, retrieval, review, semantic, validate, versions
from ..session import checkpoint_folder, workers_find_library
from ..sources import objects, registry
from ..streaming import alarms
from ..streaming import receipts as streams

CHUNK = schemas.struct(documentId=schemas.S, chunkIndex=schemas.T.IntegerType(), contentKey=schemas.S, metadataKey=schemas.S, content=schemas.S, metadata=schemas.S)
#: model: which embedding model made the vector; null for the hashed words that stand in for one.
VECTOR = StructType([*CHUNK.fields, StructField("embedding", schemas.T.ArrayType(schemas.T.FloatType())), StructField("model", schemas.T.StringType())])
CANDIDATE = schemas.struct(
    businessDocumentKey=schemas.S, documentId=schemas.S, sourceVersion=schemas.S, sourceUpdatedAt=schemas.S, turn=schemas.L, submissionId=schemas.S, place=schemas.T.IntegerType()
)
#: The order in which candidates stand: by step, and within a step by submission and file.
CANDIDATE_ORDER = ("seq", "turn", "submissionId", "place")
ORDER = CANDIDATE_ORDER[1:]
RECEIPT = schemas.struct(submissionId=schemas.S, fileId=schemas.S, key=schemas.S, receivedAt=schemas.TS)
#: Schema, key of the latest state (None: every row counts), and the column by whose buckets snapshots are laid out.
LOGS = {
    "receipts": (RECEIPT, None, "submissionId"), "submissions": (schemas.SUBMISSION, "submissionId", "submissionId"), "raw_files": (schemas.RAW_FILE, "rawFileHash", "rawFileHash"),
    "documents": (schemas.DOCUMENT, "documentId", "documentId"), "runs": (schemas.INGESTION_RUN, "ingestionRunId", "ingestionRunId"), "candidates": (CANDIDATE, None, "businessDocumentKey"),
    "vectors": (VECTOR, None, "documentId"), "manual_review": (schemas.MANUAL_REVIEW, None, "messageId"), "review_receives": (schemas.REVIEW_RECEIVE, None, "messageId"),
    "metrics": (schemas.METRIC, None, None), "audit_log": (schemas.AUDIT, None, None),
}
#: Snapshots of logs: where they are, in how many buckets, and the first generation of appended rows that they don't hold.
SNAPSHOTS = "snapshots"
MODELS = schemas.struct(model=schemas.S, learnedAt=schemas.TS, seq=schemas.L)
SNAPSHOT = schemas.struct(name=schemas.S, path=schemas.S, buckets=schemas.T.IntegerType(), generation=schemas.T.IntegerType())
#: Files of a log's generation from which on `tidy` makes a snapshot.
TIDY_FILES = 200
#: Sequence numbers that one step may use.
STEP_ROWS = 1 << 20
#: A raw file that another submission processes is waited for so often and so many seconds each time.
RAW_WAITS, RAW_WAIT_SECONDS = 3, 2.0
#: Claims of raw files: what is kept of them, and how often a step tries to commit its own.
CLAIM = schemas.struct(rawFileHash=schemas.S, ownershipClaimed=schemas.B, claimedAt=schemas.TS, claimSeq=schemas.L)
CLAIM_TRIES = 20
#: Submissions that are called back before their outcomes are written.
CALLBACK_BATCH = 1000
#: Submissions whose own folders are listed; for more of them the whole prefix is.
LISTED = 1000
#: Keys of claimed files (about 10 MB) that are sent to every executor, so that contents stay where they are read.
BROADCAST_KEYS = 100_000
IN_PROGRESS, UNRESOLVED = "FILES_IN_PROGRESS", "FILES_UNRESOLVED"
VERDICT = schemas.struct(
    submissionId=schemas.S, expectedFileIds=schemas.T.ArrayType(schemas.S), actualFileIds=schemas.T.ArrayType(schemas.S),
    missingFileIds=schemas.T.ArrayType(schemas.S), reason=schemas.S, isValid=schemas.B,
)


def logged(step: Callable) -> Callable:
    """A step whose log lines are written at its end, also where it fails."""

    @wraps(step)
    def run(self, *args, **named):
        try:
            out = step(self, *args, **named)
        except Exception as error:
            try:  # lines of frames that failed can't be written; the first error is what is raised
                self.write_log()
            except Exception as second:
                error.add_note(f"its log lines are lost: {second}"[:500])
            raise
        self.write_log()
        for path in self.holding:
            objects.remove(self.spark, path)
        self.holding = []
        return out

    return run


class Engine:
    def __init__(
        self, spark: SparkSession, root: str, chunk_chars: int = CHUNK_CHARS, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc), wait: Callable[[float], None] = time.sleep
    ):
        checkpoint_folder(workers_find_library(spark))
        self.spark, self.root, self.chunk_chars, self.clock, self.wait = spark, root.rstrip("/"), chunk_chars, clock, wait
        self.last_seq, self.said, self.noted, self.counted, self.snapshots, self.holding = 0, [], [], [], None, []
        self.committed: dict[str, dict[str, str]] = {}
        self.model: tuple[str | None, Callable[[str], list[float]]] | None = None

    def together(self, *steps: Callable[[], object]) -> None:
        """Steps that don't depend on each other, as jobs side by side; the first error is raised when all have ended."""
        with ThreadPoolExecutor(max(1, len(steps))) as pool:
            done = [pool.submit(step) for step in steps]
        for step in done:
            step.result()

    def held(self, frame: DataFrame) -> DataFrame:
        """A frame as files in the shared folder, until the step ends. It is computed once, where checkpoint() does it twice."""
        path = f"{self.spark.sparkContext.getCheckpointDir()}/held-{uuid.uuid4().hex}"
        self.holding.append(path)
        frame.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    # logs

    def path(self, name: str) -> str:
        """Where rows are appended now: the log's current generation, or all of a log that has no snapshots."""
        return f"{self.root}/registry/{name}" + (f"/generation-{self.snapshot(name)['generation']}" if LOGS[name][2] else "")

    def read(self, path: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def snapshot(self, name: str) -> dict:
        """The log's last snapshot, as this writer knows it."""
        if self.snapshots is None:
            rows = self.read(f"{self.root}/registry/{SNAPSHOTS}", SNAPSHOT).groupBy("name").agg(F.max_by(F.struct("path", "buckets", "generation"), "generation").alias("last"))
            self.snapshots = {r["name"]: r["last"].asDict() for r in rows.collect()}
        return self.snapshots.get(name, {"path": None, "buckets": 0, "generation": 0})

    def log(self, name: str, of: list | DataFrame | None = None) -> DataFrame:
        """A log's rows: its last snapshot and what was appended since. of: values of the log's bucket column, as a list or
        a frame with that column; then only their buckets of the snapshot are read."""
        fields, _, column = LOGS[name]
        schema = StructType([*fields.fields, StructField("seq", LongType())])
        rows, last = self.read(self.path(name), schema), self.snapshot(name)
        if name == "raw_files" and (paths := self.claim_paths()):
            rows = rows.unionByName(self.claimed(paths), allowMissingColumns=True)
        if of is not None:
            rows = rows.where(F.col(column).isin(of)) if isinstance(of, list) and len(of) <= registry.LISTED_KEYS else registry.of_keys(rows.withColumn("bucket", registry.bucket_of(F.col(column), 1)), column, of, 1)
        if not last["path"]:
            return rows
        held = self.spark.read.schema(StructType([*schema.fields, StructField("bucket", schemas.T.IntegerType())])).parquet(last["path"])
        return (held.drop("bucket") if of is None else registry.of_keys(held, column, of, last["buckets"])).unionByName(rows)

    # claims of raw files

    def claim_folder(self) -> str:
        """Claims since the last snapshot of the raw files, which holds earlier ones."""
        return f"{self.root}/registry/raw_file_claims/generation-{self.snapshot('raw_files')['generation']}"

    def claim_paths(self) -> list[str]:
        """Folders of the claims that count, by commit."""
        folder = self.claim_folder()
        found = self.committed[folder] = objects.texts(self.spark, f"{folder}/commits", ".commit", self.committed.get(folder, {}))
        return [f"{folder}/{found[name]}" for name in sorted(found)]

    def claimed(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.schema(CLAIM).parquet(*paths).where("ownershipClaimed")
        return rows.select("rawFileHash", F.lit("PROCESSING").alias("status"), *(F.col("claimedAt").alias(c) for c in ("firstSeenAt", "lastSeenAt", "updatedAt")), F.col("claimSeq").alias("seq"))

    def claim(self, hashed: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
        """(claims, raw files known before, owned, others): of contents that several steps claim at once, one gets each."""
        few = hashed.agg(F.approx_count_distinct("rawFileHash").alias("n")).first()["n"] <= BROADCAST_KEYS
        for _ in range(CLAIM_TRIES):
            folder, turn = self.claim_folder(), len(self.claim_paths())
            known = registry.latest_state(self.log("raw_files", hashed), "rawFileHash", "seq")
            token = uuid.uuid4().hex
            frame = dedupe.claims(hashed, known, ORDER, few=few).withColumns({"claimedAt": self.now(), "claimSeq": F.lit(self.next_seq())})
            frame.write.option("compression", "zstd").parquet(f"{folder}/{token}")
            claims = self.spark.read.schema(frame.schema).parquet(f"{folder}/{token}")
            n = claims.agg(F.count_if("ownershipClaimed").alias("owned"), F.count_if(~F.col("ownershipClaimed")).alias("others")).first()
            if not n["owned"] or objects.create_once(self.spark, f"{folder}/commits/{turn:09d}.commit", token):
                if not n["owned"]:
                    self.holding.append(f"{folder}/{token}")
                return claims.drop("claimedAt", "claimSeq"), known, n["owned"], n["others"]
            self.note("raw_file_claims_conflict", commit=turn)
            objects.remove(self.spark, f"{folder}/{token}")
        raise RuntimeError(f"other steps committed their claims before this one {CLAIM_TRIES} times")

    def compact(self, name: str) -> None:
        """Writes the latest states (or all rows) as a bucketed snapshot, and then a row that makes readers use it.

        From then on rows go to a new generation, so neither old files nor old snapshots are listed again.
        """
        _, key, column = LOGS[name]
        rows = (registry.latest_state(self.log(name), key, "seq") if key else self.log(name)).checkpoint()
        if name == "vectors":  # those of earlier models go
            rows = rows.where(F.col("model").eqNullSafe(self.embedding()[0]))
        buckets = max(1, min(registry.MOST_BUCKETS, -(-rows.count() // registry.BUCKET_ROWS)))
        generation = self.snapshot(name)["generation"] + 1
        path = f"{self.root}/registry/{SNAPSHOTS}-{name}-{generation}"
        registry.write_bucketed(rows, column, buckets, path, "overwrite")  # over what a stopped one may have left
        registry.append(self.spark.createDataFrame([(name, path, buckets, generation)], SNAPSHOT), f"{self.root}/registry/{SNAPSHOTS}")
        self.snapshots[name] = {"path": path, "buckets": buckets, "generation": generation}

    def tidy(self, files: int = TIDY_FILES) -> list[str]:
        """Compacts the logs that have many files since their last snapshot; returns their names."""
        count = lambda name: objects.files_in(self.spark, self.path(name)) + (len(self.claim_paths()) if name == "raw_files" else 0)
        due = [name for name in LOGS if LOGS[name][2] and count(name) >= files]
        for name in due:
            self.compact(name)
        return due

    def state(self, name: str, of: list | DataFrame | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
        """The latest states, or all rows of a log without states. columns: the only ones that are read beside the key."""
        key, log = LOGS[name][1], self.log(name, of)
        if columns:
            log = log.select(*(c for c in log.columns if c in (key, "seq", *columns)))
        return registry.latest_state(log, key, "seq").drop("seq") if key else log.drop("seq")

    def chunks(self, of: list | DataFrame | None = None) -> DataFrame:
        """The chunk store, or the chunks of some documents."""
        stored = self.read(f"{self.root}/canonical", StructType([*CHUNK.fields, StructField("bucket", schemas.T.IntegerType())]))
        return stored.drop("bucket") if of is None else registry.of_keys(stored, "documentId", of, objects.CHUNK_BUCKETS)

    def append(self, name: str, rows: DataFrame, seq) -> None:
        schema = LOGS[name][0]
        have = set(rows.columns)
        shaped = rows.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields), (seq if not isinstance(seq, int) else F.lit(seq)).cast("long").alias("seq"))
        registry.append(shaped, self.path(name))

    def next_seq(self) -> int:
        """Later than all that this writer has appended, also within one tick of the clock, with room for the rows of one step."""
        self.last_seq = max(int(self.clock().timestamp() * 1e6), self.last_seq + STEP_ROWS)
        return self.last_seq

    def follow(self, rows: DataFrame) -> None:
        """Sequence numbers from now on are later than these rows', which a writer whose clock is ahead may have made."""
        self.last_seq = max(self.last_seq, rows.agg(F.max("seq").alias("seq")).first()["seq"] or 0)

    def now(self):
        return F.lit(self.clock()).cast("timestamp")

    def audit(self, rows: DataFrame, action, *fields: str) -> None:
        """One log line a row: its action and the named columns as text. Written with the others of the step."""
        said = F.create_map(*(x for f in sorted(fields) for x in (F.lit(f), F.col(f).cast("string"))))
        self.said.append(rows.select((F.lit(action) if isinstance(action, str) else action).alias("action"), said.alias("fields"), self.now().alias("at")))

    def note(self, action: str, **fields) -> None:
        self.noted.append((action, {n: None if fields[n] is None else str(fields[n]) for n in sorted(fields)}, self.clock()))

    def write_log(self) -> None:
        lines = [*self.said, *([self.spark.createDataFrame(self.noted, schemas.AUDIT)] if self.noted else [])]
        counted = self.counted
        self.said, self.noted, self.counted = [], [], []
        steps = [lambda: self.append("audit_log", reduce(DataFrame.unionByName, lines), self.next_seq())] if lines else []
        if counted:
            steps.append(lambda: self.append("metrics", reduce(DataFrame.unionByName, counted), self.next_seq()))
        self.together(*steps)

    def count(self, name: str, value: DataFrame | float, **dimensions: str) -> None:
        """A metric's point, written with the step's log lines. value: a number, or a frame with one in one row."""
        rows = value if isinstance(value, DataFrame) else self.spark.createDataFrame([(float(value),)], "value double")
        dims = F.create_map(*(F.lit(x) for pair in dimensions.items() for x in pair))
        self.counted.append(rows.select(F.lit(name).alias("name"), dims.alias("dimensions"), self.now().alias("ts"), F.col(rows.columns[0]).cast("double").alias("value")))

    # steps

    @logged
    def receive(self, events: DataFrame) -> DataFrame:
        """Records receipts of new files; returns how many records had which action.

        Every submission that the events name is rolled up from its receipts and written where that changes it, so events
        that are given again mend what a stopped call has left undone, and change nothing else.
        """
        rows = self.held(receipts.classified(receipts.unnested(events)))
        good = rows.where("action = 'recorded'").select("submissionId", "fileId", "key", "sequencer")
        before = self.log("receipts", good)
        new, _ = registry.insert_if_absent(good.select(F.struct("submissionId", "fileId").alias("pair"), "key", "sequencer"), before.select(F.struct("submissionId", "fileId").alias("pair")), "pair", F.col("sequencer"))
        new = self.held(new.select("pair.submissionId", "pair.fileId", "key", self.now().alias("receivedAt")))
        seq = self.next_seq()
        touched = before.unionByName(new.select(*RECEIPT.names, F.lit(seq).alias("seq")))
        rolled = receipts.submissions(touched, ("seq", "key")).join(self.state("submissions", good).select("submissionId", F.struct("*").alias("old")), "submissionId", "left")
        rolled = self.held(rolled.where(~F.col("fileIds").eqNullSafe(F.col("old.fileIds"))))
        submissions = rolled.select(
            "submissionId", F.coalesce("old.externalRequestId", F.lit("")).alias("externalRequestId"), F.coalesce("old.status", F.lit("RECEIVING")).alias("status"),
            "receivedFileCount", F.lit(False).alias("manifestReceived"), F.concat(F.lit("ingestion/"), "submissionId", F.lit("/")).alias("ingestionPrefix"), "fileIds", "old.documentIds",
            "old.readyAt", "old.callbackStatus", F.coalesce("old.createdAt", self.now()).alias("createdAt"), self.now().alias("updatedAt"),
        )
        self.together(lambda: self.append("receipts", new, seq), lambda: self.append("submissions", submissions, seq))
        # a key tells its submission and file, and of each pair that was not known before one row is new
        known = before.select("key", F.lit(True).alias("old")).distinct()
        said = F.when(F.col("action") == "ignored", "ignore_non_ingestion_key").when(F.col("action") == "malformed", "malformed_ingestion_key").when(F.col("old"), "ignored_duplicate_submission_file").otherwise("recorded_submission_file")
        self.audit(rows.join(known, "key", "left"), said, "key", "submissionId", "fileId", "sequencer")
        counts = [tuple(r) for r in rows.groupBy("action").agg(F.count("*").alias("n")).collect()]
        return self.spark.createDataFrame(counts, "action string, n long")

    def receive_stream(self, events: DataFrame, checkpoint: str) -> None:
        """Takes all upload events that came since the last call, batch by batch.

        A batch that was stopped anywhere is given again by the checkpoint, and `receive` then adds what it lacks: each
        file is recorded once for all time. The registry itself is the memory of what was seen, so none is kept beside it.
        """
        streams.drain(events, lambda batch, _: self.receive(batch), checkpoint)

    def complete(self, submission: str, expected: list[str], fail: bool = False) -> dict:
        """Runs one submission whose files are all there; returns its validation, and leaves it COMPLETE with its documents.

        A file that another submission still processes is waited for.
        """
        request = self.spark.createDataFrame([(submission, expected)], "submissionId string, expectedFileIds array<string>")
        for turn in range(RAW_WAITS + 1):
            verdict = self.complete_many(request, fail).first().asDict()
            if verdict["reason"] != IN_PROGRESS:
                return verdict
            if turn < RAW_WAITS:
                self.wait(RAW_WAIT_SECONDS)
        return verdict | {"reason": UNRESOLVED}

    @logged
    def complete_many(self, requests: DataFrame, fail: bool = False, raw: DataFrame | None = None) -> DataFrame:
        """Runs all submissions of a frame (submissionId, expectedFileIds and, if there is one, turn) as one plan.

        The number of Spark jobs does not depend on how many there are: all files' hashes are claimed at once, in the order
        of turn, submission and place, each claimed content is rendered once, and documents, versions and attachments are
        aggregates. raw: (submissionId, fileId, key, content), if contents don't lie below ingestion/.

        Returns each submission's validation. Beside the reasons of a validation there are FILES_IN_PROGRESS, if another
        step still has one of the contents (ask again with the next batch), and FILES_UNRESOLVED, if one has failed.
        Submissions whose files all have documents are COMPLETE; one failed file leaves the others' documents as they are.
        """
        turn = F.col("turn") if "turn" in requests.columns else F.lit(0)
        asked = self.held(requests.select("submissionId", "expectedFileIds", turn.cast("long").alias("turn")))
        rows = self.held(self.log("submissions", asked))
        self.follow(rows)
        subs = self.held(registry.latest_state(rows, "submissionId", "seq").drop("seq"))
        verdict = self.held(validate.validated(asked, subs))
        self.audit(verdict.withColumn("missingFileIds", F.array_join("missingFileIds", ",")), "submission_validation_completed", "submissionId", "reason", "missingFileIds")
        wanted = verdict.where("isValid").select("submissionId", "turn", F.posexplode(F.array_distinct("expectedFileIds")).alias("place", "fileId"))
        if raw is None:
            ids = [r["submissionId"] for r in verdict.where("isValid").select("submissionId").limit(LISTED + 1).collect()]
            if not ids:
                self.count("ExecutionsFailed", verdict.agg(F.count("*")), StateMachine="submission-orchestration")
                return verdict.select(*VERDICT.names).checkpoint()
            raw = objects.raw_files(self.spark, self.root, *(ids if len(ids) <= LISTED else ()))
        digests = raw.select("submissionId", "fileId", "key", keys.digest(F.col("content")).alias("digest"))  # half as long on their way as hashes in text
        hashed = self.held(digests.join(wanted, ["submissionId", "fileId"]).withColumn("rawFileHash", keys.hash_of_digest(F.col("digest"))).drop("digest"))
        claims, known, n_owned, n_others = self.claim(hashed)
        seq = self.next_seq()
        owner, now = F.col("ownershipClaimed"), self.now()
        owned = claims.where(owner).select("key", "submissionId", "fileId", "turn", "place", "rawFileHash")
        self.audit(claims, F.col("action"), "submissionId", "fileId", "rawFileHash", "documentId")
        contents = raw.select("key", "content").join(F.broadcast(owned) if n_owned <= BROADCAST_KEYS else owned, "key")
        rendered = contents.select(*(c for c in owned.columns if c != "key"), "key", markdown.normalize_document("content").alias("r")).select(*owned.columns, "r.*")
        if fail:
            rendered = rendered.withColumn("error", F.lit("RuntimeError: forced failure"))

        def seen_again() -> None:
            """Directly behind the rows that were read, so that an outcome which its owner writes meanwhile stays the last word."""
            again = claims.where(~owner).select("rawFileHash").distinct()
            self.append("raw_files", known.join(again, "rawFileHash").withColumns({"lastSeenAt": now, "updatedAt": now}), F.col("seq") + 1)

        again = [seen_again] if n_others else []
        if not n_owned:
            self.together(*again)
            return self.attach(verdict, wanted, claims, self.spark.createDataFrame([], "rawFileHash string, documentId string"), subs, seq)
        held: dict[str, DataFrame] = {}
        self.together(*again, lambda: held.update(rendered=self.held(rendered)))
        rendered = held["rendered"]
        good, bad = rendered.where("error is null"), rendered.where("error is not null")
        old_documents = self.state("documents")  # looked up by three keys
        made = self.held(dedupe.resolved(good, old_documents, ORDER))
        self.audit(rendered, F.when(F.col("error").isNull(), "preprocessing_completed").otherwise("preprocessing_failed"), "submissionId", "fileId", "canonicalHash", "chars", "lines", "segmentIds", "error")
        self.audit(made, F.when(F.col("created"), "canonical_document_created").otherwise("canonical_document_reused"), "documentId", "canonicalHash")
        created = made.where("created").withColumn("canonicalS3Prefix", keys.canonical_prefix(F.col("documentId")))
        records = self.held(chunking.chunk_records(created, self.chunk_chars))
        sizes = records.groupBy("documentId").agg(F.count("*").alias("canonicalChunkCount"))
        fresh = created.join(sizes, "documentId").select("*", F.lit("PENDING_INGESTION").alias("kbIngestionStatus"), now.alias("createdAt"), now.alias("updatedAt"))
        mine = made.where("businessDocumentKey is not null").withColumn("seq", F.lit(seq))
        touched = made.select("documentId").distinct()
        history = self.log("candidates", mine)
        candidates = history.unionByName(mine.select(*history.columns))
        base = old_documents.join(touched, "documentId", "left_semi").unionByName(fresh.select(*(c for c in fresh.columns if c in old_documents.columns)), allowMissingColumns=True)
        renewed = versions.renewed(base, made.where("not created"), ORDER).withColumn("updatedAt", now)
        rivals = old_documents.join(mine.select("businessDocumentKey").distinct(), "businessDocumentKey", "left_semi").join(touched, "documentId", "left_anti")
        active = versions.elected(candidates.withColumn("order", F.struct(*CANDIDATE_ORDER)), "order")
        documents = versions.flagged(renewed.unionByName(rivals, allowMissingColumns=True), active)
        failure = F.split("error", ": ", 2)
        review = bad.select(
            F.lit("preprocessing_failed").alias("alertType"), "submissionId", "fileId", "rawFileHash", F.col("key").alias("rawS3Key"), keys.processed_key(F.col("submissionId"), F.col("fileId")).alias("processedS3Key"),
            F.get(failure, F.lit(0)).alias("errorType"), F.coalesce(F.get(failure, F.lit(1)), F.lit("")).alias("errorMessage"),
        )
        done = made.select("rawFileHash", "documentId", "canonicalHash", F.lit("RESOLVED").alias("status"), keys.processed_key(F.col("submissionId"), F.col("fileId")).alias("processedS3Key"))
        failed = bad.select("rawFileHash", F.lit("FAILED").alias("status"), F.col("error").alias("lastError"))
        since = known.select("rawFileHash", F.col("firstSeenAt").alias("since"))
        outcome = done.unionByName(failed, allowMissingColumns=True).join(since, "rawFileHash", "left").withColumns({"firstSeenAt": F.coalesce("since", now), "lastSeenAt": now, "updatedAt": now})
        self.together(
            lambda: objects.write_processed(good.select("submissionId", "fileId", "markdown"), f"{self.root}/processed"),
            lambda: self.persist(records),
            lambda: self.append("candidates", mine, seq),
            lambda: self.append("documents", documents, seq),
        )
        # only now, when its chunks are there, does a raw file name its document
        self.together(
            lambda: self.append("raw_files", outcome, seq),
            lambda: bad.isEmpty() or self.enqueue(review),
            lambda: held.update(verdict=self.attach(verdict, wanted, claims, made.select("rawFileHash", "documentId"), subs, seq, n_owned <= BROADCAST_KEYS)),
        )
        return held["verdict"]

    def attach(self, verdict: DataFrame, wanted: DataFrame, claims: DataFrame, made: DataFrame, subs: DataFrame, seq: int, few: bool = True) -> DataFrame:
        """Submissions with all their documents become COMPLETE; the others' reasons are told. A wanted file whose object is
        gone (it has expired, or its receipt was wrong) has no claim, and leaves its submission unresolved."""
        given = made.select("rawFileHash", F.col("documentId").alias("canonicalDocumentId"))
        own = claims.select("submissionId", "fileId", "rawFileHash", "rawFileStatus", "action", F.col("documentId").alias("resolvedDocumentId")).join(
            (F.broadcast(given) if few else given), "rawFileHash", "left"
        )
        busy = F.col("action").eqNullSafe(dedupe.IN_PROGRESS) & F.col("rawFileStatus").eqNullSafe("PROCESSING")
        found = attach.document_of(own).select("submissionId", "fileId", "documentId", busy.alias("busy"))
        files = self.held(wanted.select("submissionId", "fileId").join(found, ["submissionId", "fileId"], "left"))
        open_file = F.col("documentId").isNull()
        waits = open_file & F.coalesce("busy", F.lit(False))
        per = files.groupBy("submissionId").agg(F.bool_or(open_file).alias("open"), F.bool_or(open_file & ~waits).alias("lost"))
        said = F.when(F.col("lost"), UNRESOLVED).when(F.col("open"), IN_PROGRESS).otherwise(F.col("reason"))
        out = verdict.join(per, "submissionId", "left").withColumn("reason", said).withColumn("isValid", F.col("isValid") & ~F.coalesce("open", F.lit(False))).checkpoint()
        self.count("ExecutionsFailed", out.agg(F.count_if(~F.col("isValid") & (F.col("reason") != IN_PROGRESS))), StateMachine="submission-orchestration")
        good = out.where("isValid").select("submissionId")
        mine = subs.join(good, "submissionId", "left_semi")
        complete = attach.attached(mine, files).withColumns({"status": F.lit("COMPLETE"), "updatedAt": self.now()})
        self.append("submissions", complete, seq)
        self.audit(good, "submission_documents_attached", "submissionId")
        return out.select(*VERDICT.names)

    def complete_all(self, requests: DataFrame, fail: bool = False, raw: DataFrame | None = None) -> DataFrame:
        """complete_many, and again for those with files in progress, as often as a file is waited for."""
        found = self.complete_many(requests, fail, raw).checkpoint()
        for _ in range(RAW_WAITS):
            if found.where(F.col("reason") == IN_PROGRESS).isEmpty():
                break
            self.wait(RAW_WAIT_SECONDS)
            rest = found.where(F.col("reason") == IN_PROGRESS)
            again = self.complete_many(requests.join(rest, "submissionId", "left_semi"), fail, raw)
            found = found.where(F.col("reason") != IN_PROGRESS).unionByName(again).checkpoint()
        return found.withColumn("reason", F.when(F.col("reason") == IN_PROGRESS, UNRESOLVED).otherwise(F.col("reason")))

    @logged
    def expire(self) -> int:
        """Deletes raw and processed objects whose retention is over, in the executors; returns how many were due.

        Each has a line in the log, `object_expired`. Documents and their chunks stay. A submission that is completed after
        one of its files has expired is unresolved, unless it is complete already.
        """
        folders = [p for p in objects.RETENTION_DAYS if objects.exists(self.spark, f"{self.root}/{p}")]
        if not folders:
            return 0
        found = reduce(DataFrame.unionByName, (objects.listed(self.spark, self.root, p) for p in folders))
        due = self.held(found.where(objects.expired(F.col("key"), F.col("modificationTime"), self.now())))
        self.held(objects.delete_all(due))
        self.audit(due, "object_expired", "key")
        return due.count()

    # manual review

    def enqueue(self, alerts: DataFrame) -> None:
        self.append("manual_review", review.as_messages(alerts, self.now()), self.next_seq())

    def review_queue(self) -> DataFrame:
        """The queue's messages, equal contents of five minutes once, with their receives and states."""
        messages = self.log("manual_review").drop("seq")
        return review.with_receives(review.accepted(messages, F.col("body")), self.log("review_receives"), self.now())

    def receive_reviews(self) -> DataFrame:
        """The first message of each group that may be received; each counts as one receive."""
        queue = self.review_queue()
        got = queue.join(review.receivable(queue).select("messageId"), "messageId", "left_semi").checkpoint()
        self.append("review_receives", got.select("messageId", self.now().alias("receivedAt"), F.lit(False).alias("deleted")), self.next_seq())
        return got

    def delete_reviews(self, messages: DataFrame) -> None:
        self.append("review_receives", messages.select("messageId", self.now().alias("receivedAt"), F.lit(True).alias("deleted")), self.next_seq())

    def persist(self, records: DataFrame) -> None:
        """Writes chunks and their sidecars below canonical/, and checks by a listing that all are there; repairs once."""
        folder = f"{self.root}/canonical"
        objects.write_chunks(records, folder)
        of = records.select("documentId").distinct()
        listed = lambda: self.chunks(of).select("contentKey")
        objects.verified(records, listed, lambda missing: objects.write_chunks(missing, folder), "contentKey")
        self.audit(records.agg((2 * F.count("*")).alias("objects")), "canonical_chunk_persistence_verified", "objects")

    @logged
    def coordinate(self, job: Callable[[list[str]], dict] | None = None, poll: Callable[[str], dict] | None = None, batch: int = indexing.BATCH, configured: bool = True) -> str:
        """One action: poll the active run if there is one, or else start a run over pending documents.

        configured: whether there is an index to write to; without one neither a run nor a document changes.
        """
        seq, run = self.next_seq(), indexing.active_run(self.state("runs")).first()
        if run and not configured:
            self.note("kb_coordinator_active_run_missing_configuration", ingestionRunId=run["ingestionRunId"])
            return "active_run_missing_configuration"
        if run:
            answer = poll(run["kbOperationId"]) if run["kbOperationId"] and poll else {} if run["kbOperationId"] else {"status": "FAILED", "failureReasons": [indexing.NO_OPERATION]}
            return self.settle(run["ingestionRunId"], run["documentIds"], run["kbOperationId"], run["startedAt"], answer, seq) if answer else "missing_configuration"
        documents = [r["documentId"] for r in indexing.pending(self.state("documents"), batch).collect()]
        if not documents:
            self.note("kb_coordinator_no_pending_documents", documents=0)
            return "no_pending_documents"
        if not configured:
            self.note("kb_coordinator_missing_configuration", documents=len(documents))
            return "missing_configuration"
        run_id = f"run-{uuid.uuid4()}"
        started = self.clock()
        self.note("kb_coordinator_documents_selected", ingestionRunId=run_id, documents=len(documents))
        run_row = self.spark.createDataFrame([(run_id, "STARTED", documents)], "ingestionRunId string, status string, documentIds array<string>").withColumn("startedAt", F.lit(started))
        chosen = self.state("documents", documents)
        begun = indexing.fanned_out(chosen, run_row.withColumn("errorSummary", F.lit(None).cast("string"))).withColumn("updatedAt", self.now())
        self.together(lambda: self.append("runs", run_row, seq), lambda: self.append("documents", begun, seq))  # INGESTING before the job starts
        self.note("kb_coordinator_ingestion_requested", ingestionRunId=run_id, clientToken=keys.client_token(run_id))
        try:
            answer = (job or self.index)(documents)
        except Exception as e:
            self.settle(run_id, documents, None, started, {"status": "FAILED", "failureReasons": [str(e)]}, seq + 1)
            self.count("Errors", 1, FunctionName="kb-coordinator")
            self.note("kb_coordinator_ingestion_submit_failed", ingestionRunId=run_id, errorType=type(e).__name__, errorMessage=str(e))
            raise
        return self.settle(run_id, documents, answer.get("ingestionJobId"), started, answer, seq + 1)

    def embedding(self) -> tuple[str | None, Callable[[str], list[float]]]:
        """(name, function) of the model learned last, as this engine knows it; hashed words while there is none."""
        if self.model is None:
            last = self.read(f"{self.root}/registry/models", MODELS).agg(F.max_by("model", "seq").alias("model")).first()["model"]
            self.model = (last, semantic.Model.read(self.read(f"{self.root}/models/{last}", semantic.MODEL)) if last else retrieval.embed)
        return self.model

    @logged
    def learn_embedding(self, dims: int = semantic.DIMENSIONS) -> str:
        """Learns an embedding model from the chunk store and embeds anew what is indexed.

        Vectors carry their model's name. The new ones are appended first and the model is named then, so a stopped run
        changes nothing, and other engines ask the earlier vectors until they are begun anew.
        """
        name, seq = f"semantic-{uuid.uuid4().hex}", self.next_seq()
        old = self.embedding()[0]
        model = semantic.learned(self.chunks(), "content", dims)
        model.table(self.spark).coalesce(1).write.parquet(f"{self.root}/models/{name}")
        indexed = self.log("vectors").where(F.col("model").eqNullSafe(old)).drop("embedding", "seq")
        self.append("vectors", retrieval.embedded(indexed, model).withColumn("model", F.lit(name)), seq)
        registry.append(self.spark.createDataFrame([(name, self.clock(), seq)], MODELS.simpleString()), f"{self.root}/registry/models")
        self.model = name, model
        self.note("embedding_model_learned", model=name, dimensions=dims)
        return name

    def vectors(self, of: list | DataFrame | None = None) -> DataFrame:
        """Vectors of the current model."""
        return self.log("vectors", of).where(F.col("model").eqNullSafe(self.embedding()[0]))

    def index(self, documents: list[str]) -> dict:
        """The built-in job: embeds and appends the chunks of the documents."""
        name, embedder = self.embedding()
        self.append("vectors", retrieval.index_new(self.chunks(documents), self.vectors(documents), embedder).withColumn("model", F.lit(name).cast("string")), self.next_seq())
        return {"ingestionJobId": f"job-{uuid.uuid4()}", "status": "COMPLETE"}

    def settle(self, run_id: str, documents: list[str], operation: str | None, started, answer: dict, seq: int) -> str:
        schema = "ingestionRunId string, documentIds array<string>, kbOperationId string, job string, failed long, reasons array<string>"
        row = [(run_id, documents, operation, answer.get("status"), answer.get("numberOfDocumentsFailed"), answer.get("failureReasons"))]
        said = indexing.run_status(F.coalesce("job", F.lit("")), indexing.has_failures(F.col("failed"), F.col("reasons")))
        run = self.spark.createDataFrame(row, schema).select("*", said.alias("status"), indexing.error_summary(F.col("reasons")).alias("errorSummary"))
        ended = F.when(F.col("status") != "STARTED", self.now())
        hit = self.state("documents", documents)
        ended_documents = indexing.fanned_out(hit, run.select("ingestionRunId", "status", "documentIds", "errorSummary")).withColumn("updatedAt", self.now())
        self.together(
            lambda: self.append("documents", ended_documents, seq),
            lambda: self.append("runs", run.withColumns({"startedAt": F.lit(started), "completedAt": ended}), seq),
        )
        outcome = run.first()["status"]
        self.note("kb_coordinator_ingestion_completed" if outcome != "STARTED" else "kb_coordinator_ingestion_started", ingestionRunId=run_id, status=outcome, documents=len(documents))
        return outcome

    @logged
    def refresh(self, callback: Callable[[dict], None] | None = None, fail: bool = False) -> DataFrame:
        """Readiness of all complete submissions; those that turn READY are called back (fail: as if every call failed).

        Outcomes are written batch by batch, so the plan does not grow and a stopped pass repeats one batch at most.
        """
        seq = self.next_seq()
        waiting = self.state("submissions").where("status in ('COMPLETE', 'WAITING_FOR_INDEX')")
        said = readiness.readiness(readiness.states(waiting, self.state("documents"))).checkpoint()
        changed = waiting.drop("status").join(said.select("submissionId", "status"), "submissionId").withColumns({"readyAt": F.when(F.col("status") == "READY", self.now()), "updatedAt": self.now()}).checkpoint()
        outcome = F.col("status")
        self.append("submissions", changed.where(outcome != "READY"), seq)
        self.audit(changed, F.when(outcome == "READY", "submission_ready").when(outcome == "FAILED", "submission_readiness_failed").otherwise("submission_waiting_for_index"), "submissionId")
        batch: list[tuple] = []

        def write() -> None:
            told = self.spark.createDataFrame(batch, "submissionId string, callbackStatus string, callbackFailureReason string")
            called = changed.drop("callbackStatus", "callbackFailureReason").join(F.broadcast(told), "submissionId")
            good = F.col("callbackStatus") == "DELIVERED"
            called = called.withColumns({"callbackDeliveredAt": F.when(good, self.now()), "callbackFailedAt": F.when(~good, self.now())}).checkpoint()
            self.append("submissions", called, seq)
            self.audit(called, F.concat(F.lit("ready_callback_"), F.lower("callbackStatus")), "submissionId")
            batch.clear()

        for row in said.where("status = 'READY'").select("submissionId", "documents").toLocalIterator():
            try:
                if fail:
                    raise RuntimeError("forced failure")
                if callback:
                    callback(row.asDict())
                batch.append((row["submissionId"], "DELIVERED", None))
            except Exception as e:
                batch.append((row["submissionId"], "FAILED", str(e)[:2048]))
            if len(batch) == CALLBACK_BATCH:
                write()
        if batch:
            write()
        return said

    def await_files(self, submission: str, expected: list[str], seconds: float, pause: float = 2.0, replay: Callable[[list[str]], DataFrame] | None = None) -> bool:
        """Waits until all expected files are recorded; shortly before the time is up the missing ones' events are replayed once."""
        until, replayed = time.monotonic() + seconds, False
        while True:
            row = self.state("submissions", [submission]).first()
            missing = sorted(set(expected) - set(row["fileIds"] or [] if row else []))
            if not missing or time.monotonic() >= until:
                return not missing
            if replay and not replayed and time.monotonic() + pause >= until:
                self.receive(replay([f"ingestion/{submission}/{f}" for f in missing]))
                replayed, until = True, until + pause
                continue
            self.wait(pause)

    def scheduled(self, step: Callable[[], object], checkpoint: str, every: str = "5 minutes"):
        """A streaming query that runs a step (coordinate, refresh, monitor) by the clock."""
        ticks = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        return streams.scheduled(ticks, lambda _, __: step(), checkpoint, every)

    def drive(self, submission: str, seconds: float, pause: float = 10.0, **callbacks) -> str:
        """Coordinates and refreshes until the submission is READY or FAILED, or the time is up; returns its last status."""
        until = time.monotonic() + seconds
        while True:
            self.coordinate(**{k: v for k, v in callbacks.items() if k in ("job", "poll")})
            self.refresh(callbacks.get("callback"))
            row = self.state("submissions", [submission]).first()
            status = row["status"] if row else "UNKNOWN"
            if status in ("READY", "FAILED", "UNKNOWN") or time.monotonic() + pause > until:
                return status
            self.wait(pause)

    def query(self, submission: str, text: str, results: int | None = None, model: Callable[[str], str] | None = None) -> dict:
        """Retrieval strictly within one submission's documents; its status is echoed, READY is not required."""
        row = self.state("submissions", [submission]).first()
        if row is None:
            raise ValueError(f"unknown submission {submission}")
        out = {"submissionId": submission, "submissionStatus": row["status"], "query": text.strip(), "documentIds": list(row["documentIds"] or []), "retrievalResults": [], "retrievedDocumentIds": []}
        if not out["documentIds"]:
            return out | {"summary": retrieval.NO_DOCUMENTS, "modelInvoked": False, "modelError": None}
        found = retrieval.nearest(self.vectors(out["documentIds"]), self.embedding()[1](text.strip()), results)
        rows = [r.asDict() for r in retrieval.projected(found).collect()]
        out |= {"retrievalResults": rows, "retrievedDocumentIds": sorted({r["documentId"] for r in rows if r["documentId"]})}
        return out | retrieval.summarized(submission, text.strip(), rows, model)

    @logged
    def monitor(self, environment: str = "dev") -> tuple[DataFrame, DataFrame]:
        """(metrics in batches, alerts) of one pass; alerts go to the review queue, metrics to their log."""
        submissions, documents, runs, now = self.state("submissions"), self.state("documents"), self.state("runs"), self.now()
        found = monitor.submission_alerts(submissions, documents, now, environment).checkpoint()
        metrics = monitor.metrics(submissions, runs, found, environment, now).checkpoint()
        self.together(lambda: self.enqueue(found), lambda: self.append("metrics", metrics, self.next_seq()))
        self.audit(found, "ops_monitor_manual_review_enqueued", "alertType", "submissionId", "documentId")
        self.tidy()
        self.audit(metrics.where("dimensions['Status'] is null").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("m")).select(*(F.col("m")[c].alias(c) for c in monitor.COUNTERS)), "ops_monitor_completed", *monitor.COUNTERS)
        return monitor.metric_batches(metrics, ("name", F.coalesce(F.col("dimensions")["Status"], F.lit("")))), found

    # alarms

    def alarms_until(self, until: datetime) -> DataFrame:
        """The alarms' transitions in all periods that ended before a time."""
        return alarms.transitions(self.log("metrics"), F.lit(until).cast("timestamp"))

    def watch_alarms(self, checkpoint: str, late: str = "0 seconds") -> None:
        """Takes the metrics that came since the last call; new transitions go to their log, each batch once."""
        schema = StructType([*schemas.METRIC.fields, StructField("seq", LongType())])
        points = self.spark.readStream.schema(schema).parquet(self.path("metrics"))
        streams.drain(alarms.transition_stream(points, late=late), lambda batch, i: batch.write.mode("overwrite").parquet(f"{self.root}/registry/alarms/batch={i}"), checkpoint)

    def alarm_log(self) -> DataFrame:
        return self.read(f"{self.root}/registry/alarms", alarms.TRANSITION)
