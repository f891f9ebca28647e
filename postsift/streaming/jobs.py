"""The same validation on a stream of contacts.

Mail-routing answers change while a stream runs, so they are passed as a function that
reads the snapshot anew for every micro-batch. Output goes to one folder per batch and
is overwritten when a batch is repeated after a failure, so every contact is written
once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postsift.plans.options import Options
from postsift.plans.route import write_routed
from postsift.plans.rules import DEFAULT_RULES, Rule
from postsift.plans.validate import answered_domains, lookup_worklist, validate
from postsift.sources.mail_routing import instant
from postsift.streaming.asked import asked_within, batch_clock, moment, write_asked

Snapshot = Callable[[SparkSession], DataFrame]
REQUEST_SCHEMA = "domain string, contacts bigint, requested_at timestamp"


def start_validation(
    contacts: DataFrame,
    read_dns: Snapshot,
    path: str,
    *,
    checkpoint: str,
    email: str = "email",
    available_now: bool = False,
    file_format: str = "parquet",
    remember: bool = False,
    **validation,
) -> StreamingQuery:
    """Validate a stream and write both ways below `path`, as batch_id=…/sendable=….

    `checkpoint` is the folder of this stream's progress: the same one after a restart, and
    its own for every stream. `validation` takes the keyword arguments of `validate`; it is
    lazy unless told otherwise, so a batch leaves no checkpoint files behind. `as_of` may be a
    function that is called for every batch.

    With `order_by`, `cached` is decided within the micro-batch. With `remember` too it is that of
    the whole stream: a contact counts as cached if an earlier batch has used an answer for
    its domain within the time to live. The domains are kept below `checkpoint`, by hour; a
    batch reads the hours within the time to live and no older ones. The clock then never goes
    back, and a repeated batch has the one it had at first.
    """
    answered_folder = f"{checkpoint}/answered"
    options = validation.get("options", Options())

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        given = validation.get("as_of")
        arguments = validation | {"as_of": given() if callable(given) else given}
        batch.persist()  # read more than once below
        try:
            dns = read_dns(spark)
            if not remember:
                write_routed(validate(batch, email, dns=dns, **arguments), f"{path}/batch_id={batch_id}", file_format, mode="overwrite")
                return
            clock = batch_clock(spark, answered_folder, batch_id, moment(arguments["as_of"]))
            arguments["as_of"] = clock
            answered = asked_within(spark, answered_folder, "domain string, requested_at timestamp", batch_id, clock, options.cache_ttl_ms)
            validated = validate(batch, email, dns=dns, answered=answered, **arguments)
            write_routed(validated, f"{path}/batch_id={batch_id}", file_format, mode="overwrite")
            chosen = {k: v for k, v in arguments.items() if k in ("options", "as_of", "rules", "fan_out")}
            new = answered_domains(batch, email, dns=dns, **chosen)
            if answered is not None:
                # An answer that was in use already keeps the time it was asked at.
                new = new.join(answered.select("domain").distinct(), "domain", "left_anti")
            write_asked(new.withColumn("requested_at", instant(clock)), answered_folder, batch_id, clock)
        finally:
            batch.unpersist()

    return _start(contacts, handle, checkpoint, available_now)


def start_refresh_requests(
    contacts: DataFrame,
    read_dns: Snapshot,
    path: str,
    *,
    checkpoint: str,
    email: str = "email",
    available_now: bool = False,
    options: Options = Options(),
    rules: Sequence[Rule] = DEFAULT_RULES,
    as_of: Callable[[], str | datetime] | str | datetime | None = None,
) -> StreamingQuery:
    """Write the domains to ask the resolver about, below `path` as hour=…/batch_id=….

    Columns: domain, contacts (of the batch) and requested_at. A domain is asked when a
    contact needs it, no fresh answer is kept, and no earlier batch has asked within the
    time to live; only the hours within that time are listed and read. The clock is that of the
    lookup (`as_of`: now, a fixed time, or a function called per batch) and never a time inside
    a contact, so late contacts and replayed lists are treated like any other. It never goes
    back. A repeated batch has the clock it had at first and overwrites its own requests.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clock = batch_clock(spark, path, batch_id, moment(as_of() if callable(as_of) else as_of))
        wanted = lookup_worklist(batch, email, options=options, dns=read_dns(spark), as_of=clock, rules=rules)
        wanted = wanted.withColumn("requested_at", instant(clock))
        fresh = asked_within(spark, path, REQUEST_SCHEMA, batch_id, clock, options.cache_ttl_ms)
        if fresh is not None:
            wanted = wanted.join(fresh.select("domain").distinct(), "domain", "left_anti")
        write_asked(wanted, path, batch_id, clock)

    return _start(contacts, handle, checkpoint, available_now)


def _start(stream: DataFrame, handle, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
