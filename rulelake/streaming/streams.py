"""Structured Streaming forms of the two incremental jobs.

T2 membership fold: member events stream in; ``groupBy(group, member)``
keeps ``max_by(action, seq)`` in the state store and emits, per micro-batch,
only the keys that changed (update mode, state in RocksDB). Each batch
appends its updates as a version numbered by its batch id, so a replay finds
itself done; after a few batches the updates are folded to one row per
present member, so reading costs the members and a few batches at any age.

T1 page ingest: page dumps stream in as files; every micro-batch is parsed,
its outcome computed (its pages are the attempted ids) and its whole rules
merged with R6 into the versioned rule table, whose changed buckets alone are
rewritten; the version has the batch's number.

Both run with ``trigger(availableNow=True)`` and keep checkpoints and
outputs below the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelake.operators import extract as X
from rulelake.operators import rules as R
from rulelake.operators import snapshot as N
from rulelake.operators.latest import latest_per_key
from rulelake.sinks import versions as V
from rulelake.sources.pages import classify_pages


MEMBERS = "members"
FOLD_AFTER = 8


@contextmanager
def _keyed_state(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB: off the heap, on disk as far as needed, and changed
    files alone go to the checkpoint. A provider the session names stays."""
    name = "spark.sql.streaming.stateStore.providerClass"
    named = spark.conf.get(name, None)
    rocks = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    given = named is not None and not named.endswith("HDFSBackedStateStoreProvider")
    if not given:
        spark.conf.set(name, rocks)
    try:
        yield
    finally:
        if not given:
            spark.conf.unset(name) if named is None else spark.conf.set(name, named)


def run_membership_fold(spark: SparkSession, source: str, schema: str, to_events: Callable[[DataFrame], DataFrame],
                        base: str, max_files_per_trigger: int | None = None,
                        file_glob: str | None = None, fold_after: int = FOLD_AFTER) -> DataFrame:
    """Fold member events from ``source`` (Parquet files) to the current members.

    ``to_events`` maps the raw rows to ``(group_id, member, action, seq)``.
    Returns the current membership ``(group_id, member)``.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    events = to_events(reader.parquet(source))
    state = events.groupBy("group_id", "member").agg(F.max_by("action", "seq").alias("last_action"),
                                                     F.max("seq").alias("last_seq"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        before = V.newest(spark, base, below=batch_id + 1)
        if before is not None and before.number == batch_id:
            return  # replayed after its commit
        new = V.write_table(spark, base, MEMBERS, batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        table = V.appended(before.tables[MEMBERS], new) if before is not None else new
        if len(table.writes) > fold_after:
            rows = V.read(spark, V.Version(base, batch_id, {MEMBERS: table}), MEMBERS)
            table = V.write_table(spark, base, MEMBERS, _folded(rows))
        V.commit(spark, base, batch_id, {MEMBERS: table})

    with _keyed_state(spark):
        q = (state.writeStream.outputMode("update").foreachBatch(write_batch)
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    return current_membership(spark, base)


def _folded(updates: DataFrame) -> DataFrame:
    """One row per present member. Removed ones need none: an update carries
    the whole state of its key, so a later one needs nothing of before."""
    latest = latest_per_key(updates.select("group_id", "member", "last_action", "last_seq", "batch_id"),
                            ["group_id", "member"], ["batch_id"])
    return latest.where(F.col("last_action") == "added")


def current_membership(spark: SparkSession, base: str) -> DataFrame:
    version = V.newest(spark, base)
    if version is None:
        return spark.createDataFrame([], "group_id bigint, member string")
    return _folded(V.read(spark, version, MEMBERS)).select("group_id", "member")


def run_page_ingest(spark: SparkSession, source: str, existing: DataFrame, base: str,
                    max_files_per_trigger: int = 2, buckets: int = V.BUCKETS) -> DataFrame:
    """Merge streamed rule pages into the snapshot, one micro-batch at a time.

    ``source`` holds Parquet files of ``(url, html)``; ``existing`` is the
    previous snapshot of whole rules (``rule_id, pos`` and
    ``snapshot.PAYLOAD``). Returns the newest snapshot; its order is
    ``(added, pos)``: a rule's first batch (-1: the previous snapshot), then
    its place in it.

    Each batch parses its pages once, by all cores, into a written table of one
    row a rule, writes their outcome, and rewrites the buckets whose rules changed. A page that is null or no rule fails and
    leaves the rule as it was.
    """
    N.start(spark, base, existing, buckets)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        pages = classify_pages(batch).where(F.col("page_kind") == "rule")
        drop = f"{base}/drops/batch={batch_id}"

        def written(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{drop}/{name}")
            return spark.read.schema(df.schema).parquet(f"{drop}/{name}")

        # a drop is few files, and pages compress so well that a file is one task: all cores parse
        dealt = pages.repartition(2 * max(spark.sparkContext.defaultParallelism, 1), "url")
        parsed = written(N.one_page_per_rule(X.parse_rule_pages(dealt).drop("url", "page_kind")), "pages")
        outcome = written(R.rule_outcome(parsed.select(F.col("page_key").alias("rule_id")), parsed), "outcome")
        kept = R.select_rules(parsed, outcome.where(F.col("outcome") == "kept"))
        # two addresses may show one rule: the smaller one counts
        kept = R.dedup_first(kept, "rule_id", ["page_key"]).drop("page_key")
        rules = N.whole_rules(kept, X.condition_rows(kept), X.action_rows(kept))
        rules = written(R.with_id_order(rules).withColumn("pos", F.col("sort_num").cast("bigint")).drop(
            "sort_group", "sort_num"), "rules")
        N.merge(spark, base, batch_id, rules, outcome)

    stream = (spark.readStream.schema("url string, html string")
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source))
    q = (stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return N.current(spark, base)
