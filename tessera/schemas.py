"""Schemas of the registries and of the events that feed them."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


UPLOAD_EVENT = struct(
    Records=T.ArrayType(struct(eventName=S, s3=struct(bucket=struct(name=S), object=struct(key=S, sequencer=S)))),
)
SUBMISSION = struct(
    submissionId=S, externalRequestId=S, status=S, expectedFileCount=T.IntegerType(), receivedFileCount=L, manifestReceived=B,
    ingestionPrefix=S, fileIds=T.ArrayType(S), documentIds=T.ArrayType(S), readyAt=TS, callbackStatus=S, callbackDeliveredAt=TS,
    callbackFailedAt=TS, callbackFailureReason=S, createdAt=TS, updatedAt=TS,
)
RAW_FILE = struct(rawFileHash=S, status=S, processedS3Key=S, canonicalHash=S, documentId=S, firstSeenAt=TS, lastSeenAt=TS, lastError=S, updatedAt=TS)
DOCUMENT = struct(
    documentId=S, canonicalHash=S, canonicalS3Prefix=S, canonicalChunkCount=T.IntegerType(), businessDocumentKey=S, sourceVersion=S,
    sourceUpdatedAt=S, kbIngestionStatus=S, isActive=B, pendingIngestionRunId=S, lastSuccessfulIngestionRunId=S, lastIngestionError=S,
    createdAt=TS, updatedAt=TS,
)
INGESTION_RUN = struct(ingestionRunId=S, status=S, kbOperationId=S, documentIds=T.ArrayType(S), startedAt=TS, completedAt=TS, errorSummary=S)
MANIFEST = struct(
    label=S, submissionId=S, submissionIdTemplate=S,
    files=T.ArrayType(struct(fileId=S, logicalName=S, source=S, transform=struct(type=S, fields=T.MapType(S, S)))),
)
#: What a review message may carry, by kind of alert; absent fields are null and not in its body.
REVIEW_FIELDS = dict(
    alertType=S, environment=S, submissionId=S, status=S, updatedAt=TS, documentIds=T.ArrayType(S), documentId=S, kbIngestionStatus=S,
    pendingIngestionRunId=S, canonicalHash=S, callbackStatus=S, callbackFailureReason=S, fileId=S, rawFileHash=S, rawS3Key=S, processedS3Key=S,
    errorType=S, errorMessage=S,
)
MANUAL_REVIEW = struct(messageId=S, sentAt=TS, body=S, **REVIEW_FIELDS)
REVIEW_RECEIVE = struct(messageId=S, receivedAt=TS, deleted=B)
AUDIT = struct(action=S, fields=T.MapType(S, S), at=TS)
METRIC = struct(name=S, dimensions=T.MapType(S, S), ts=TS, value=T.DoubleType())

#: States of submissions, raw files, documents, runs and jobs.
OPEN_SUBMISSION = ("RECEIVING", "COMPLETE", "WAITING_FOR_INDEX")
JOB_RUNNING = ("STARTING", "IN_PROGRESS", "STOPPING")
