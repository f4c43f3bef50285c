"""A whole run over inbound files: load, validate, post, reconcile, report, gate.

Every stage writes its table below its run, in BUCKETS folders by a hash of the batch, so the number of folders does
not grow with the number of files; a batch or a set of batches is read from its buckets alone. Each stage keeps one
control row, which says running until the stage has completed or failed. Repeating a stage replaces exactly its own
folders, so a run can be started again after a failure; each load of a run has a folder of its own. Row states are never updated in place: the staged table of a run is what validation wrote,
and counts as posted once the posting stage of that run has completed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.scalars import run_started
from tillstone.model import (
    LOAD_JOB,
    POST_JOB,
    POSTED_STATE,
    RECONCILE_JOB,
    RECONCILIATIONS,
    REJECT_LIMIT,
    STAGE_RUNS,
    STAGED_STATE,
    VALIDATE_JOB,
    VALIDATED_STATE,
)
from tillstone.operators import reporting
from tillstone.operators.intake import batch_register, parse_files, split_intake, unprocessed
from tillstone.operators.lookups import fits_broadcast, in_scope, lookup_join
from tillstone.operators.posting import post
from tillstone.operators.reconciliation import ReconciliationMismatch, gate, reconcile
from tillstone.operators.validation import hold_failed_batches, reject_counts, reject_log, validate
from tillstone.session import cut_lineage
from tillstone.sources.inbound import list_files
from tillstone.sources.tables import read_table, write_partitions, write_under

# Folders of a run in a table. Fixed for the life of a store, as it says where a batch lies.
BUCKETS = 64
_ROW = "account_id INT, merchant_id INT, direction STRING, amount_cents INT"
_KEYED = "batch_id STRING, run_id BIGINT, bucket INT"
TABLES = {
    "intake": f"id STRING, {_ROW}, txn_date DATE, status STRING, file STRING, row_no BIGINT, line STRING, "
              f"problem STRING, batch_id STRING, run_id BIGINT, load INT, bucket INT",
    "batches": "id STRING, file_name STRING, record_count BIGINT, status STRING, job_name STRING, batch_id STRING, "
               "run_id BIGINT, load INT",
    "outcomes": f"id STRING, {_ROW}, txn_date DATE, status STRING, error_message STRING, {_KEYED}",
    "batch_job_errors": f"batch_job_id BIGINT, error_message STRING, record_ref STRING, {_KEYED}",
    "transactions": f"txn_id STRING, {_ROW}, status STRING, description STRING, {_KEYED}",
    "batch_reconciliations": f"{RECONCILIATIONS}, run_id BIGINT, bucket INT",
    "stage_runs": STAGE_RUNS,
}


LAYOUT = ("load", "bucket")


def bucket_of(batch_id: Column) -> Column:
    return F.pmod(F.xxhash64(batch_id), F.lit(BUCKETS)).cast("int")


def bucketed(frame: DataFrame) -> DataFrame:
    return frame.withColumn("bucket", bucket_of(F.col("batch_id")))


class StageFailed(RuntimeError):
    """A stage stopped the run; later stages did not start."""


class Summary(NamedTuple):
    jobs: DataFrame
    files: DataFrame
    totals: DataFrame
    reject_reasons: DataFrame
    reconciliations: DataFrame


class Store:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def stored(self, name: str) -> DataFrame:
        """A table with the columns of its layout."""
        return read_table(self.spark, self.root, name, TABLES[name])

    def table(self, name: str, run_id: int | None = None, batch_id: str | None = None) -> DataFrame:
        """Rows of a table, of one run, or of one batch; run and bucket are partitions, so only their folders are read."""
        frame = self.stored(name)
        if run_id is not None:
            frame = frame.where(F.col("run_id") == run_id)
        if batch_id is not None:
            frame = frame.where((F.col("bucket") == bucket_of(F.lit(batch_id))) & (F.col("batch_id") == batch_id))
        return frame.drop(*LAYOUT)

    def of_batches(self, name: str, batches: DataFrame) -> DataFrame:
        """Rows of the given (run_id, batch_id) rows; their runs and buckets are found first and prune the folders."""
        wanted = batches.select("run_id", "batch_id").distinct()
        places = wanted.select("run_id", bucket_of(F.col("batch_id")).alias("bucket")).distinct()
        # At most BUCKETS rows per run.
        near = self.stored(name).join(F.broadcast(places), ["run_id", "bucket"], "left_semi")
        return in_scope(near, wanted, ["run_id", "batch_id"]).drop(*LAYOUT)

    def write_run(self, frame: DataFrame, name: str, run_id: int, gather: bool = True, count: Column | None = None) -> int:
        """Replace what a run has in a table; returns the rows written, or those that `count` holds for."""
        return write_under(bucketed(frame), self.root, name, {"run_id": run_id}, ["bucket"], gather, count)

    def write_load(self, frame: DataFrame, name: str, run_id: int, load: int, by: Sequence[str], gather: bool = True) -> int:
        return write_under(frame, self.root, name, {"run_id": run_id, "load": load}, by, gather)

    @contextmanager
    def stage(self, run_id: int, job: str) -> Iterator[dict[str, int]]:
        """Keep the control row of a stage: running, then completed, or failed when it raises."""
        done: dict[str, int] = {}
        self._mark(run_id, job, "running", None)
        try:
            yield done
        except BaseException:
            self._mark(run_id, job, "failed", done.get("count"))
            raise
        self._mark(run_id, job, "completed", done["count"])

    def _mark(self, run_id: int, job: str, status: str, count: int | None) -> None:
        """One control row per run and stage; a later one replaces it."""
        row = self.spark.range(1).select(
            F.lit(run_id).cast("bigint").alias("run_id"),
            F.lit(job).alias("job_name"),
            F.lit(status).alias("status"),
            run_started(F.lit(run_id)).alias("started_at"),
            (F.lit(None).cast("timestamp") if status == "running" else F.current_timestamp()).alias("finished_at"),
            F.lit(count).cast("bigint").alias("record_count"),
        )
        write_partitions(row, self.root, "stage_runs", ["run_id", "job_name"])

    def completed(self, job: str) -> DataFrame:
        return self.table("stage_runs").where((F.col("job_name") == job) & (F.col("status") == "completed")).select("run_id")

    def staged_transactions(self) -> DataFrame:
        """Current state of every staged row of every run."""
        # A run holds very many rows, so its id must never become a plain shuffle key.
        posted = self.completed(POST_JOB).withColumn("_posted", F.lit(True))
        judged = lookup_join(self.table("outcomes"), posted, "run_id", measure=True)
        state = F.when(F.col("_posted") & (F.col("status") == VALIDATED_STATE), POSTED_STATE)
        judged = judged.withColumn("status", F.coalesce(state, F.col("status"))).drop("_posted")
        validated = self.completed(VALIDATE_JOB).withColumn("_validated", F.lit(True))
        staged = split_intake(self.table("intake")).staged
        waiting = lookup_join(staged, validated, "run_id", measure=True).where(F.col("_validated").isNull())
        return judged.unionByName(waiting.drop("_validated"), allowMissingColumns=True)


def load(store: Store, paths: str | Sequence[str], run_id: int, merchants: DataFrame | None = None) -> None:
    """Take in the listed files, each as one batch; a file already taken in by this run is left out.

    The list of files stays on the executors: the files are read by the given paths, and where the run has taken in
    some of them before, their lines are left out by batch.
    """
    with store.stage(run_id, LOAD_JOB) as done:
        before = store.stored("batches").where(F.col("run_id") == run_id)
        last = before.agg(F.max("load")).first()[0]
        files = list_files(store.spark, paths).select("file")
        waiting = files if last is None else unprocessed(files, before, run_id)
        if waiting.limit(1).count():
            parsed = parse_files(store.spark, paths, run_id, merchants)
            if last is not None:
                parsed = parsed.join(before.select("batch_id").distinct(), "batch_id", "left_anti")
            this = 0 if last is None else last + 1
            shuffled = last is not None or merchants is not None and not fits_broadcast(merchants)
            store.write_load(bucketed(parsed), "intake", run_id, this, ["bucket"], shuffled)
            taken = store.stored("intake").where((F.col("run_id") == run_id) & (F.col("load") == this))
            register = batch_register(waiting, split_intake(taken).staged, run_id)
            store.write_load(register.withColumn("batch_id", F.col("id")), "batches", run_id, this, [], gather=False)
        done["count"] = store.table("batches", run_id).agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0]


def pending_runs(store: Store, job: str) -> list[int]:
    """Loaded runs that have not completed a stage; one entry per run, so the list stays short."""
    waiting = store.completed(LOAD_JOB).join(store.completed(job), "run_id", "left_anti")
    return sorted(row.run_id for row in waiting.distinct().collect())


def validate_run(store: Store, run_id: int, accounts: DataFrame, limit: int = REJECT_LIMIT) -> None:
    """Judge the staged rows of a run; a batch over the reject limit stays staged and fails the stage."""
    with store.stage(run_id, VALIDATE_JOB) as done:
        staged = split_intake(store.table("intake", run_id)).staged
        judged_count = store.write_run(
            validate(staged, accounts), "outcomes", run_id, gather=True, count=F.col("status") != STAGED_STATE
        )
        # One row per batch over the limit.
        failed = cut_lineage(reject_counts(store.table("outcomes", run_id), limit).where(~F.col("within_limit")))
        over, held = failed.agg(F.count("*"), F.coalesce(F.sum(F.col("write_count") + F.col("skip_count")), F.lit(0))).first()
        if over:
            # Only the buckets of the failed batches are written again.
            run = F.lit(run_id).cast("bigint").alias("run_id")
            places = failed.select(run, bucket_of(F.col("batch_id")).alias("bucket")).distinct()
            touched = store.stored("outcomes").join(F.broadcast(places), ["run_id", "bucket"], "left_semi")
            write_partitions(
                cut_lineage(hold_failed_batches(touched, limit)), store.root, "outcomes", ["run_id", "bucket"]
            )
        store.write_run(reject_log(store.table("outcomes", run_id)), "batch_job_errors", run_id)
        done["count"] = judged_count - held
        if over:
            raise StageFailed(f"{over} batch(es) of run {run_id} have more than {limit} rejects")


def post_run(store: Store, run_id: int) -> None:
    with store.stage(run_id, POST_JOB) as done:
        done["count"] = store.write_run(post(store.table("outcomes", run_id)), "transactions", run_id)


def reconcile_run(store: Store, run_id: int) -> DataFrame:
    """Write the reconciliation rows of a run, mismatches included, and return them."""
    with store.stage(run_id, RECONCILE_JOB) as done:
        staged = store.staged_transactions().where(F.col("run_id") == run_id)
        figures = reconcile(staged, store.table("transactions", run_id))
        done["count"] = store.write_run(figures, "batch_reconciliations", run_id)
    return store.table("batch_reconciliations", run_id)


def summarize(store: Store) -> Summary:
    """The report sections over all runs so far."""
    staged, batches = store.staged_transactions(), store.table("batches")
    jobs = store.table("stage_runs").withColumn("id", F.col("run_id") * 10 + F.array_position(
        F.array(*[F.lit(j) for j in (LOAD_JOB, VALIDATE_JOB, POST_JOB, RECONCILE_JOB)]), F.col("job_name")))
    return Summary(
        reporting.job_totals(jobs),
        reporting.file_summary(batches, staged),
        reporting.state_totals(staged),
        reporting.reject_reasons(store.table("batch_job_errors")),
        reporting.reconciliation_summary(store.table("batch_reconciliations"), batches),
    )


def run_batches(
    spark: SparkSession,
    root: str,
    paths: str | Sequence[str],
    run_id: int,
    accounts: DataFrame,
    merchants: DataFrame | None = None,
    all_pending: bool = False,
    limit: int = REJECT_LIMIT,
) -> Summary:
    """Run all stages; the summary is ready before a mismatch stops the run.

    `run_id` is the start of the run in epoch milliseconds. With `all_pending`, rows left behind by
    earlier runs are validated and posted too, but only the batches of this run are reconciled.
    """
    store = Store(spark, root)
    load(store, paths, run_id, merchants)
    for pending in pending_runs(store, VALIDATE_JOB) if all_pending else [run_id]:
        validate_run(store, pending, accounts, limit)
    for pending in pending_runs(store, POST_JOB) if all_pending else [run_id]:
        post_run(store, pending)
    figures = reconcile_run(store, run_id)
    summary = summarize(store)
    failures = gate(figures).first().failed_batches
    if failures:
        stopped = ReconciliationMismatch(f"reconciliation failed for {failures} batch(es) of run {run_id}")
        stopped.summary = summary
        raise stopped
    return summary
