"""Streams: the same verdicts as in batch, repeated batches, refresh requests."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

import postsift as ps
from fixtures import ZONE, zone_frame
from postsift.streaming import start_refresh_requests, start_validation
from postsift.streaming.asked import asked_within, batch_clock, hour_name, moment, write_asked

START = datetime(2026, 8, 20, 0, 0, 0)
SCHEMA = "input_seq long, ts timestamp, email string"


def feed(spark, folder, batch, addresses, hours=0):
    rows = [(i, START + timedelta(hours=hours, seconds=i), a) for i, a in enumerate(addresses)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{batch}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def test_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path)
    addresses = ["a@gmail.com", "juan@gmial.com", "asdf@x.com", None, "a@caido.com", "b@hotmail.com"]
    feed(spark, folder, "one", addresses[:3])
    feed(spark, folder, "two", addresses[3:])
    query = start_validation(
        stream(spark, folder), zone_frame, f"{folder}/out", checkpoint=f"{folder}/progress", available_now=True
    )
    query.awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    got = {(r["validation"]["email"], r["validation"]["status"], r["sendable"] == "true") for r in out.collect()}
    people = spark.createDataFrame([(a,) for a in addresses], "email string")
    want = {(r["validation"]["email"], r["validation"]["status"], r["validation"]["sendable"]) for r in ps.validate(people, dns=zone_frame(spark)).collect()}
    assert got == want
    assert {r[0] for r in out.select("batch_id").distinct().collect()} == {0, 1}


def test_snapshot_is_read_for_every_batch(spark, tmp_path):
    folder, seen = str(tmp_path), []

    def read(session):
        seen.append(1)
        return zone_frame(session, {} if len(seen) == 1 else ZONE)

    feed(spark, folder, "one", ["a@gmail.com"])
    feed(spark, folder, "two", ["b@gmail.com"])
    start_validation(stream(spark, folder), read, f"{folder}/out", checkpoint=f"{folder}/progress", available_now=True).awaitTermination()
    out = spark.read.parquet(f"{folder}/out").orderBy("batch_id")
    assert [r["validation"]["status"] for r in out.collect()] == ["unknown", "valid"]


def ask(spark, folder, as_of, read=None, progress="progress"):
    query = start_refresh_requests(
        stream(spark, folder),
        read or (lambda session: zone_frame(session, {"ymail.com": ZONE["ymail.com"]}, START - timedelta(hours=1))),
        f"{folder}/out",
        checkpoint=f"{folder}/{progress}",
        available_now=True,
        as_of=as_of,
    )
    query.awaitTermination()
    return sorted((r["domain"], r["contacts"]) for r in spark.read.parquet(f"{folder}/out").collect())


def test_refresh_requests(spark, tmp_path):
    folder = str(tmp_path)
    feed(spark, folder, "one", ["a@gmail.com", "b@gmail.com", "c@soloa.com", "juan@gmial.com", "asdf@x.com", "a@ymail.com"])
    feed(spark, folder, "two", ["d@gmail.com", "e@une.net.co"], hours=1)
    assert ask(spark, folder, START) == [("gmail.com", 2), ("soloa.com", 1), ("une.net.co", 1)]


def test_late_contacts_are_asked_and_replays_are_not(spark, tmp_path):
    """The clock is that of the lookup, never a time inside a contact."""
    folder = str(tmp_path)
    feed(spark, folder, "one", ["a@gmail.com"], hours=96)
    feed(spark, folder, "two", ["a@soloa.com"], hours=97)
    ask(spark, folder, START)
    feed(spark, folder, "three", ["late@une.net.co"], hours=-1000)
    feed(spark, folder, "four", ["a@gmail.com", "late@une.net.co"], hours=-1000)
    assert ask(spark, folder, START + timedelta(hours=1)) == [("gmail.com", 1), ("soloa.com", 1), ("une.net.co", 1)]
    feed(spark, folder, "five", ["b@gmail.com"])
    # Six hours later the request is no longer fresh, and no answer was kept.
    assert ask(spark, folder, lambda: START + timedelta(hours=6, seconds=1)).count(("gmail.com", 1)) == 2


def test_restart_writes_every_contact_once(spark, tmp_path):
    """A new application has another checkpoint folder of its own; the stream's progress stays."""
    folder = str(tmp_path)
    feed(spark, folder, "one", ["a@gmail.com"])
    feed(spark, folder, "two", ["b@gmail.com"])

    def go():
        start_validation(stream(spark, folder), zone_frame, f"{folder}/out", checkpoint=f"{folder}/progress", available_now=True).awaitTermination()

    go()
    spark.sparkContext.setCheckpointDir(f"{folder}/another")
    feed(spark, folder, "three", ["c@gmail.com"])
    go()
    out = spark.read.parquet(f"{folder}/out").collect()
    assert sorted(r["validation"]["email"] for r in out) == ["a@gmail.com", "b@gmail.com", "c@gmail.com"]
    left = [f for d in (tmp_path / "another").rglob("*") for f in [d] if f.is_file()]
    assert left == []


def test_progress_is_asked_for(spark, tmp_path):
    with pytest.raises(TypeError, match="checkpoint"):
        start_validation(stream(spark, str(tmp_path)), zone_frame, str(tmp_path))


def test_a_batch_reads_only_the_hours_within_the_time_to_live(spark, tmp_path):
    """Two hundred earlier batches, one an hour: seven hours are listed and read."""
    folder, clock = str(tmp_path / "asked"), datetime(2026, 8, 20, 12, 30, tzinfo=timezone.utc)
    columns = "domain string, requested_at timestamp"
    template = spark.createDataFrame([("a.com", clock)], columns).coalesce(1)
    write_asked(template, folder, 0, clock)
    first = next((tmp_path / "asked").rglob("part-*.parquet"))
    for k in range(1, 200):
        at = tmp_path / "asked" / f"hour={hour_name(clock - timedelta(hours=200 - k))}" / f"batch_id={k}"
        at.mkdir(parents=True)
        (at / "part-0.parquet").write_bytes(first.read_bytes())
    earlier = asked_within(spark, folder, columns, 200, clock, 6 * 3_600_000)
    named = {f.split("hour=")[1][:10] for f in earlier.inputFiles()}
    assert named == {hour_name(clock - timedelta(hours=k)) for k in range(7)}
    assert asked_within(spark, folder, columns, 200, clock + timedelta(days=30), 6 * 3_600_000) is None


def test_a_repeated_batch_keeps_its_clock(spark, tmp_path):
    folder = str(tmp_path / "asked")
    first = batch_clock(spark, folder, 4, moment(START))
    assert batch_clock(spark, folder, 4, moment(START + timedelta(hours=9))) == first
    assert batch_clock(spark, folder, 5, moment(START - timedelta(hours=9))) == first
    assert batch_clock(spark, folder, 6, moment("2026-08-20T02:00:00+02:00")) == first
    assert batch_clock(spark, folder, 7, moment(START + timedelta(hours=1))) == first + timedelta(hours=1)


def test_requests_after_a_restart(spark, tmp_path):
    """A batch that is repeated after its requests were written writes them once, at its first clock."""
    folder = str(tmp_path)
    feed(spark, folder, "one", ["a@gmail.com"])
    feed(spark, folder, "two", ["a@soloa.com", "b@gmail.com"])
    assert ask(spark, folder, START) == [("gmail.com", 1), ("soloa.com", 1)]
    for commit in (tmp_path / "progress" / "commits").glob("*1*"):
        commit.unlink()  # the second batch was not committed
    assert ask(spark, folder, START + timedelta(hours=3)) == [("gmail.com", 1), ("soloa.com", 1)]


def flags(spark, folder):
    rows = spark.read.parquet(f"{folder}/out").collect()
    return {r["input_seq"]: r["validation"]["cached"] for r in rows}


def test_cached_over_the_whole_stream(spark, tmp_path):
    folder, addresses = str(tmp_path), ["a@gmail.com", "b@caido.com", "b@gmail.com", "c@soloa.com", "c@caido.com", "d@gmail.com", "juan@gmial.com", "e@soloa.com"]
    for k in range(4):
        rows = [(i, START, addresses[i]) for i in (2 * k, 2 * k + 1)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{k}")

    def go(as_of, out="out", progress="progress"):
        start_validation(
            stream(spark, folder), zone_frame, f"{folder}/{out}", checkpoint=f"{folder}/{progress}", available_now=True, remember=True, order_by="input_seq", as_of=as_of
        ).awaitTermination()

    go(START)
    people = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "input_seq long, email string")
    whole = {r["input_seq"]: r["validation"]["cached"] for r in ps.validate(people, dns=zone_frame(spark), order_by="input_seq", as_of=START).collect()}
    assert flags(spark, folder) == whole
    assert whole[5] and whole[7] and not whole[4]
    # Six hours on the answer is no longer good: asked again, then used again.
    for k, address in enumerate(["x@gmail.com", "y@gmail.com"]):
        spark.createDataFrame([(100 + k, START, address)], SCHEMA).coalesce(1).write.parquet(f"{folder}/in/later{k}")
    go(START + timedelta(hours=6))
    assert {k: v for k, v in flags(spark, folder).items() if k >= 100} == {100: False, 101: True}
