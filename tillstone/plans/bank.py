"""Bank tables as views over the supplied order tables.

Faults (unknown accounts, bad codes, a ledger that lost or repeated rows, odd file headers) follow
from attributes of the orders, so they grow with the data and hit every table as a whole.
"""

from __future__ import annotations

from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.model import LEDGER_DESCRIPTION, LOAD_JOB, POST_JOB, STAGED_STATE, VALIDATE_JOB
from tillstone.operators.intake import INBOUND_ORDER
from tillstone.operators.lookups import fits_broadcast
from tillstone.operators.posting import mark_posted, post
from tillstone.operators.reconciliation import Outputs, collect_outputs, reconcile
from tillstone.operators.validation import reject_log, standard_rules, validate
from tillstone.session import cut_lineage
from tillstone.sources.documents import with_approval_defaults

# Schemas of the supplied tables; naming them saves a look into the files before every query.
SOURCES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

EPOCH = "2024-01-01 00:00:00"


def once(method):
    """Build a view once per instance; the instance alone holds it."""

    @wraps(method)
    def built(self, *args):
        key = (method.__name__, *args)
        if key not in self.views:
            self.views[key] = method(self, *args)
        return self.views[key]

    return built


class Bank:
    """Views over one data folder; every method returns a lazy frame, built once per instance.

    A `shared` bank serves queries over many views at once: what several views are made of is written to the shared
    folder first, so that every supplied table is read once and every row judged once, however many views read on.
    """

    def __init__(self, spark: SparkSession, folder: str, shared: bool = False):
        self.spark = spark
        self.folder = folder
        self.shared = shared
        self.views: dict[tuple, object] = {}

    def _kept(self, frame: DataFrame) -> DataFrame:
        return cut_lineage(frame) if self.shared else frame

    @once
    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.folder}/{name}.parquet")

    # -- reference tables -------------------------------------------------------------------

    @once
    def customers(self) -> DataFrame:
        return self.source("customer").select(
            (F.col("c_custkey") + 1001).alias("customer_id"),
            F.col("c_name").alias("full_name"),
            F.when(F.col("c_nationkey") != 3, F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("email"),
            F.lit(EPOCH).cast("timestamp").alias("created_at"),
        )

    @once
    def accounts(self) -> DataFrame:
        """Customers of nation 7 hold no account, so their orders name an unknown one."""
        balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
        return self.source("customer").where(F.col("c_nationkey") != 7).select(
            (F.col("c_custkey") + 2001).alias("account_id"),
            (F.col("c_custkey") + 1001).alias("customer_id"),
            F.when(segment.isin("BUILDING", "HOUSEHOLD"), "checking")
            .when(segment == "AUTOMOBILE", "savings")
            .when(segment == "MACHINERY", "credit")
            .otherwise("other").alias("account_type"),
            F.when(balance < -500, "closed").when(balance < 0, "frozen").otherwise("active").alias("status"),
            F.lit(EPOCH).cast("date").alias("opened_at"),
            F.round(balance * 100).cast("int").alias("credit_limit_cents"),
        )

    @once
    def merchants(self) -> DataFrame:
        """Suppliers of nation 15 are not registered, so rows naming them are orphans."""
        nations = self.source("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return self.source("supplier").where(F.col("s_nationkey") != 15).join(nations, "s_nationkey").select(
            (F.col("s_suppkey") + 3001).alias("merchant_id"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("category"),
            F.lit(EPOCH).cast("timestamp").alias("created_at"),
        )

    # -- transactions -----------------------------------------------------------------------

    @once
    def staged(self) -> DataFrame:
        """One row per order; a batch is a month, a dataset a month and a priority."""
        if self.shared:
            judged = self.outcomes()
            return judged.withColumn("status", F.lit(STAGED_STATE)).drop("error_message")
        return stage_orders(self.source("orders"))

    @once
    def outcomes(self) -> DataFrame:
        return self._settled(validate(stage_orders(self.source("orders")), self.accounts()))

    def _settled(self, judged: DataFrame) -> DataFrame:
        """Judged rows feed the staged table, the ledger and the reject log.

        With accounts small enough to broadcast, judging is part of the scan and may be repeated;
        beyond that it shuffles, and is written out once.
        """
        return judged if fits_broadcast(self.accounts()) and not self.shared else cut_lineage(judged)

    @once
    def staged_table(self) -> DataFrame:
        return mark_posted(self.outcomes())

    @once
    def errors(self) -> DataFrame:
        return reject_log(self.outcomes(), F.col("batch_id") * 10 + 1)

    @once
    def ledger(self) -> DataFrame:
        return post(self.outcomes())

    @once
    def faulty_ledger(self) -> DataFrame:
        """The ledger after a lost day, a wrong cent on large rows and a day posted twice."""
        rows = self.outcomes().where(F.col("status") == "validated")
        month, day = F.month("txn_date"), F.dayofmonth("txn_date")
        kept = rows.where(~((month == 3) & (day == 15)))
        wrong = (F.col("merchant_id") == 3004) & (F.col("amount_cents") > 45_000_000)
        kept = kept.withColumn("amount_cents", F.when(wrong, F.col("amount_cents") + 1).otherwise(F.col("amount_cents")))
        twice = (month == 7) & (day == 4)
        copies = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return post(kept.withColumn("_copy", F.explode(copies)).drop("_copy"))

    # -- control tables ---------------------------------------------------------------------

    @once
    def _per_batch(self) -> DataFrame:
        return self._kept(self.staged().groupBy("batch_id").agg(
            F.count("*").alias("record_count"), F.min("txn_date").alias("first"), F.max("txn_date").alias("last")
        ))

    @once
    def batches(self) -> DataFrame:
        return self._per_batch().select(
            F.col("batch_id").alias("id"),
            (F.col("batch_id") * 10).alias("batch_job_id"),
            batch_file(F.col("batch_id")).alias("file_name"),
            "record_count",
            F.lit("received").alias("status"),
        )

    @once
    def jobs(self) -> DataFrame:
        """Three jobs per month; posting is still running for the last year."""
        per_batch = self._per_batch().withColumnRenamed("record_count", "n")
        running = F.col("batch_id") >= 200101

        def job(offset: int, name: str, status: Column, finished: Column) -> Column:
            return F.struct(
                (F.col("batch_id") * 10 + offset).alias("id"), F.lit(name).alias("job_name"),
                status.alias("status"), F.col("first").cast("timestamp").alias("started_at"),
                finished.cast("timestamp").alias("finished_at"), F.col("n").alias("record_count"),
            )

        done = F.lit("completed")
        return per_batch.select(F.explode(F.array(
            job(0, LOAD_JOB, done, F.col("last")),
            job(1, VALIDATE_JOB, done, F.col("last")),
            job(2, POST_JOB, F.when(running, "running").otherwise(done), F.when(~running, F.col("last"))),
        )).alias("j")).select("j.*")

    @once
    def reconciliations(self) -> DataFrame:
        return self._kept(reconcile(self.staged_table(), self.faulty_ledger()))

    @once
    def tampered_reconciliations(self) -> DataFrame:
        """Reconciliation rows altered after the fact, month by month."""
        month = F.pmod("batch_id", F.lit(100))
        rows = self.reconciliations().withColumns({
            "staged_total_cents": F.col("staged_total_cents") + F.when(month == 5, 1).otherwise(0),
            "staged_count": F.col("staged_count") + F.when(month == 9, 1).otherwise(0),
            "posted_count": F.when(month == 12, -1).otherwise(F.col("posted_count")),
        })
        copies = F.when(month == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return rows.withColumn("_copy", F.explode(copies)).drop("_copy")

    # -- baseline ---------------------------------------------------------------------------

    @once
    def outputs(self) -> Outputs:
        """What the run left behind, with the flags of the faulty ledger's reconciliation."""
        by_dataset = [f.withColumn("batch_id", F.col("dataset_id")) for f in (self.staged_table(), self.faulty_ledger())]
        flags = reconcile(*by_dataset).withColumnRenamed("batch_id", "dataset_id")
        return collect_outputs(self.staged_table(), self.ledger(), self.errors(), flags)

    def compared(self) -> tuple[Outputs, Outputs]:
        """The run and its baseline; the run lost the low orders of Decembers, no baseline holds those of Novembers."""
        def without(frame: DataFrame, month: str) -> DataFrame:
            return frame.where(~F.col("dataset_id").endswith(f"{month}/5-LOW"))

        run = collect_outputs(*[without(f, "12") for f in (self.staged_table(), self.ledger(), self.errors())])
        return run, Outputs(*[without(f, "11") for f in self.legacy_outputs()])

    @once
    def legacy_outcomes(self) -> DataFrame:
        """The legacy rules take lower-case codes; medium-priority amounts lose their last digit."""
        cents = F.col("amount_cents")
        cut = F.when(F.col("dataset_id").endswith("3-MEDIUM"), cents - F.pmod(cents, F.lit(10))).otherwise(cents)
        rows = self.staged().withColumn("amount_cents", cut.cast("int"))
        judged = self._settled(validate(rows, self.accounts(), standard_rules(fold_direction=True)))
        return judged.withColumn("direction", F.upper("direction"))

    @once
    def legacy_outputs(self) -> Outputs:
        judged = self.legacy_outcomes()
        ledger = post(judged).withColumn(
            "description", F.lit(" " + LEDGER_DESCRIPTION.replace(" ", "  ") + " ")
        )
        errors = reject_log(judged).withColumn(
            "error_message",
            F.when(F.col("error_message") == "account is not active; ", "ERR_ACCT_INACTIVE").otherwise(
                F.col("error_message")
            ),
        )
        return collect_outputs(mark_posted(judged), ledger, errors)

    @once
    def approvals(self) -> DataFrame:
        """Reviewed differences of every dataset, some signed and some not."""
        datasets = self.staged().select("dataset_id").distinct()
        reviewer = F.when(F.col("dataset_id") >= "199801", "a.reviewer").otherwise(" ")

        def entry(order: int, field: str, expected: str, actual: str, signer: Column) -> Column:
            return F.struct(
                F.lit(order).alias("entry_ord"), F.lit(field).alias("field"),
                F.lit(expected).alias("expectedValue"), F.lit(actual).alias("actualValue"),
                F.lit("contains").alias("matchType"), signer.alias("approvedBy"),
                F.lit(f"entry {order}").alias("rationale"),
            )

        entries = F.array(
            entry(1, "postedCount", "", "", reviewer),
            entry(2, "errors[0].errorMessage", "ERR_ACCT_INACTIVE", "account is not active", F.lit("b.reviewer")),
            entry(3, "totalPostedCents", "0", "", F.lit("")),
            entry(4, "totalPostedCents", "", "", F.lit("b.reviewer")),
        )
        return with_approval_defaults(
            datasets.select("dataset_id", F.explode(entries).alias("e")).select("dataset_id", "e.*")
        )

    # -- files and responses ----------------------------------------------------------------

    @once
    def file_lines(self) -> DataFrame:
        """The months as delimited files (file, row_no, value), each with its own header."""
        rows = self.staged().select(
            batch_file(F.col("batch_id")).alias("file"), (F.col("id") + 2).alias("row_no"),
            file_row(F.pmod("batch_id", F.lit(100))).alias("value"),
        )
        heads = self.staged().select("batch_id").distinct().select(
            batch_file(F.col("batch_id")).alias("file"), F.lit(1).cast("bigint").alias("row_no"),
            file_header(F.pmod("batch_id", F.lit(100))).alias("value"),
        )
        return heads.unionByName(rows)

    @once
    def responses(self) -> DataFrame:
        """A response log: one entry per event, and one per conversation turn."""
        kind, value = F.col("event_type"), F.col("value")

        def by_kind(*texts: str) -> Column:
            kinds = ["purchase", "signup", "error", "view", "click"]
            return reduce(lambda c, kt: c.when(kind == kt[0], kt[1]), zip(kinds, texts), F.when(F.lit(False), ""))

        good = by_kind("Pipeline completed successfully", "Pipeline is already running",
                       "Pipeline failed: no space left", "idle", "running")
        events = self.source("events").select(
            F.concat(F.lit("event-"), "event_id").alias("response_id"),
            F.when(kind.isin("view", "click"), "API-BATCH-STATUS-001").otherwise("API-BATCH-RUN-001").alias("contract_id"),
            by_kind("clean_trigger", "concurrent_trigger", "pipeline_failure", "pipeline_idle",
                    "pipeline_running").alias("scenario"),
            F.when(kind == "error", 500).when((kind == "signup") & (value < 100), 409).otherwise(200).alias("status"),
            F.when(value < 50, "Text/Plain; charset=UTF-8").when(value < 150, "text/plain").when(
                value < 200, "application/json").alias("content_type"),
            F.when(value < 60, good).when(value < 70, F.col("props")).when(
                value < 80, F.concat(F.lit('{"id": 0, "id": '), "event_id", F.lit("}"))).when(
                value < 120, F.upper(good)).when(value < 160, F.concat(F.lit("["), good)).alias("body"),
        )
        turns = self.source("conversations").select(
            F.concat(F.lit("turn-"), "conv_id", F.lit("-"), "turn").alias("response_id"),
            F.lit("API-BATCH-RUN-001").alias("contract_id"), F.col("role").alias("scenario"),
            F.lit(200).alias("status"), F.lit("text/plain").alias("content_type"), F.col("text").alias("body"),
        )
        return events.unionByName(turns)

    # -- replays ----------------------------------------------------------------------------

    @once
    def replay_runs(self) -> DataFrame:
        """Years as scenarios, months as runs."""
        return self.staged().select("batch_id").distinct().select(
            scenario_of(F.col("batch_id")).alias("scenario_id"),
            F.pmod("batch_id", F.lit(100)).alias("run_number"), "batch_id",
        )

    @once
    def expectations(self) -> DataFrame:
        """What the legacy rules would have left behind in each year."""
        judged = self.legacy_outcomes().withColumn("scenario_id", scenario_of(F.col("batch_id")))
        year = F.substring("scenario_id", 4, 4)
        figures = judged.groupBy("scenario_id").agg(
            F.count("*").alias("n"), F.count_if(F.col("status") == "validated").alias("ok"),
            F.sum(F.when(F.col("status") == "validated", F.col("amount_cents"))).cast("bigint").alias("cents"),
        )
        nothing = F.lit(None)

        def run_part(rows: Column) -> Column:
            return F.struct(
                rows.cast("int").alias("rowCount"), nothing.cast("int").alias("stagedCount"),
                nothing.cast("int").alias("postedCount"), nothing.cast("bigint").alias("stagedTotalCents"),
                nothing.cast("bigint").alias("postedTotalCents"), F.lit(True).alias("countsMatch"),
                nothing.cast("boolean").alias("totalsMatch"),
            )

        return figures.select(
            F.col("scenario_id").alias("scenarioId"),
            F.col("n").alias("expectedStagedCount"),
            F.col("ok").alias("expectedPostedCount"),
            F.when(year <= "1998", F.col("n") - F.col("ok")).alias("expectedRejectedCount"),
            (F.col("n") - F.col("ok")).alias("expectedErrorCount"),
            F.col("cents").alias("expectedTotalPostedCents"),
            F.when(year <= "1997", run_part(nothing)).alias("expectedPerRun"),
            F.when(year > "1997", run_part(F.lit(1))).alias("expectedReconciliation"),
            F.struct(
                F.col("n").alias("totalStagedTransactions"), F.col("ok").alias("totalPostedTransactions"),
                F.lit(12).alias("reconciliationRowCount"), F.lit(True).alias("eachRowCountsMatch"),
                nothing.cast("boolean").alias("eachRowTotalsMatch"),
            ).alias("expectedAfterBothRuns"),
        )

    @once
    def tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers(),
            "accounts": self.accounts(),
            "merchants": self.merchants(),
            "transactions": self.faulty_ledger(),
            "batch_jobs": self.jobs(),
            "transaction_batches": self.batches(),
            "batch_job_errors": self.errors(),
            "staged_transactions": self.staged_table(),
            "batch_reconciliations": self.tampered_reconciliations(),
        }


def stage_orders(orders: DataFrame, *keep: str) -> DataFrame:
    """Orders as staged transactions; prices up to the 5,000 floor give amounts that are not positive."""
    kind, priority, day = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    month = (F.year(day) * 100 + F.month(day)).cast("bigint")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        month.alias("batch_id"),
        F.concat_ws("/", month, priority).alias("dataset_id"),
        (F.col("o_custkey") + 2001).alias("account_id"),
        F.when(kind != "P", F.col("o_orderkey") % 10 + 3001).alias("merchant_id"),
        F.when(kind == "F", "D").when(kind == "O", "C").when(priority == "1-URGENT", "d")
        .when(priority == "2-HIGH", "X").otherwise("D").alias("direction"),
        (F.round(F.col("o_totalprice") * 100).cast("int") - 500_000).alias("amount_cents"),
        day.cast("date").alias("txn_date"),
        F.lit("staged").alias("status"),
        *keep,
    )


def batch_file(batch_id: Column) -> Column:
    return F.concat(F.lit("ach_"), batch_id.cast("string"), F.lit(".csv"))


def scenario_of(batch_id: Column) -> Column:
    return F.concat(F.lit("RP-"), F.floor(batch_id / 100).cast("string"))


def file_header(month: Column) -> Column:
    """Headers with a missing, extra, moved, renamed column or another delimiter, by month."""
    account, merchant, direction, amount, date = INBOUND_ORDER
    return (
        F.when(month == 2, ",".join([account, merchant, direction, amount]))
        .when(month == 4, ",".join([*INBOUND_ORDER, "notes"]))
        .when(month == 6, ", ".join([account, merchant, amount, direction, date]))
        .when(month == 8, "\t".join(INBOUND_ORDER))
        .when(month == 10, ",".join([account, merchant, direction, "amount", date]))
        .otherwise(",".join(INBOUND_ORDER))
    )


def file_cells() -> list[Column]:
    """The cells of a staged row in file order, some of them faulty."""
    cents, direction = F.col("amount_cents"), F.col("direction")
    account = F.when(cents > 49_400_000, " ").otherwise(F.col("account_id").cast("string"))
    merchant = F.when((F.col("merchant_id") == 3006) & (cents < 1_000_000), "abc").otherwise(
        F.coalesce(F.col("merchant_id").cast("string"), F.lit(""))
    )
    amount = F.when((direction == "C") & (cents > 48_000_000), F.concat(cents.cast("string"), F.lit(".0"))).otherwise(
        cents.cast("string")
    )
    date = F.when((F.col("merchant_id") == 3003) & (direction == "D"), F.date_format("txn_date", "MM/dd/yyyy")).otherwise(
        F.date_format("txn_date", "yyyy-MM-dd")
    )
    return [account, merchant, direction, amount, date]


def file_row(month: Column) -> Column:
    account, merchant, direction, amount, date = file_cells()
    plain = F.concat_ws(",", account, merchant, direction, amount, date)
    return F.when(month == 6, F.concat_ws(",", account, merchant, amount, direction, date)).otherwise(
        F.concat(plain, F.lit("\r"))
    )
