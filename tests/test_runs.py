"""Runs that are stopped, repeated, interleaved or fed with corrupt objects; exports and imports as a whole."""

import datetime as dt
import gzip
import json
import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewake import commands
from tidewake.operators import fast_packet, joins, merge, n2k
from tidewake.plans import derive, metrics, store
from tidewake.sources import archive, audit, export, legacy
from tidewake.streaming import capture, ingest

from test_engine import T0, fast, records, sentence, speed


def dump(table):
    return None if table is None else sorted((tuple(sorted(r.asDict().items(), key=str)) for r in table.collect()), key=str)


def days_of_speed(spark):
    """Objects of three days, two of which share a day."""
    rows = [speed(0, 1, 9, 6.4), speed(1500, 1, 9, 5.0), speed(86_400_000, 1, 9, 4.0), speed(2 * 86_400_000, 1, 9, 3.0), (1600, "n0183", sentence("WIMWV,10,R,5.0,N,A"))]
    names = F.element_at(F.array(*(F.lit(n) for n in "abcda")), F.col("seq").cast("int") + 1)
    return records(spark, rows).withColumn("object_key", names).withColumn("object_rank", F.ascii("object_key").cast("long"))


STEPS = [(store, "write_days", True), (merge, "merge_into", False), (store, "commit", False), (store, "commit", True), (store, "tidy", False)]


@pytest.mark.parametrize("module,step,after", STEPS, ids=[f"{s}-{a}" for _, s, a in STEPS])
def test_a_stopped_update_loses_nothing(spark, tmp_path, monkeypatch, module, step, after):
    rows = days_of_speed(spark)
    keys = lambda text: spark.createDataFrame([(k,) for k in text], "key string")
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for root in (good, bad):
        derive.update(spark, rows, keys("ab"), root)
    derive.update(spark, rows, keys("abcdx"), good)
    before = dump(store.read_table(spark, bad))
    own = getattr(module, step)

    def stops(*args, **kwargs):
        if after:
            own(*args, **kwargs)
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(module, step, stops)
        derive.update(spark, rows, keys("abcdx"), bad)
    done = (step, after) in (("commit", True), ("tidy", False))
    assert dump(store.read_table(spark, bad)) == (dump(store.read_table(spark, good)) if done else before)
    assert derive.update(spark, rows, keys("abcdx"), bad)["objects"] == (0 if done else 3)
    assert dump(store.read_table(spark, bad)) == dump(store.read_table(spark, good))
    assert {r.key for r in derive.read_ledger(spark, bad).collect()} == set("abcdx")
    derive.update(spark, rows, keys("abcdxy"), bad)
    left = [n for n in os.listdir(bad) if not n.startswith(".")]
    assert sum(n.startswith("_manifest") for n in left) == 1 and not any(n.startswith(("_part", "_lock")) for n in left)


def test_only_touched_days_are_written(spark, tmp_path):
    rows, root = days_of_speed(spark), str(tmp_path / "t")
    key = lambda k: spark.createDataFrame([(k,)], "key string")
    for k in "acd":
        derive.update(spark, rows, key(k), root)
    days = store.current(spark, root).days
    derive.update(spark, rows, key("b"), root)
    now = store.current(spark, root).days
    assert [d for d in days if days[d] != now[d]] == [min(days)] and len(days) == 3
    assert store.read_table(spark, root, date.fromisoformat(min(days)), date.fromisoformat(min(days))).count() == 2
    plan = store.read_table(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan


def test_one_writer_at_a_time(spark, tmp_path):
    rows, root = days_of_speed(spark), str(tmp_path / "t")
    keys = spark.createDataFrame([("a",)], "key string")
    with store.locked(spark, root), pytest.raises(store.Busy, match=str(os.getpid())):
        derive.update(spark, rows, keys, root)
    # A lock of a process that is gone is taken over; one of another host is not.
    files = store.Files(spark, root)
    gone = {"pid": 2**22 + 1, "host": store.socket.gethostname(), "since": "then", "run": "x"}
    files.create(store.LOCK, json.dumps(gone).encode())
    assert derive.update(spark, rows, keys, root)["objects"] == 1
    files.create(store.LOCK, json.dumps(gone | {"host": "elsewhere"}).encode())
    with pytest.raises(store.Busy, match="elsewhere"):
        derive.update(spark, rows, keys, root, rebuild=True)


def test_ledger_by_day(spark, tmp_path, monkeypatch):
    """A run reads the ledger of its keys' days and no others."""
    rows, root = days_of_speed(spark), f"file://{tmp_path}/t"
    keys = [f"raw/2024/01/{d:02d}/000000-n2k-{d:016x}.ndjson.gz" for d in range(1, 6)] + ["a"]
    table = lambda some: spark.createDataFrame([(k,) for k in some], "key string")
    for part in (keys[:3], keys[3:]):
        assert derive.update(spark, rows, table(part), root)["objects"] == 3
    manifest = store.current(spark, root)
    one = derive.read_ledger(spark, root, manifest, ["2024-01-02", "other"])
    assert sorted(r.key for r in one.collect()) == ["a", keys[1]]
    plan = derive.fresh_keys(spark, table([keys[1], keys[1].replace("n2k", "n0183")]), root, manifest)
    assert {f.rsplit("/", 2)[1] for f in plan.inputFiles() if "ledger" in f} == {"day=2024-01-02"}
    assert [r.key for r in plan.collect()] == [keys[1].replace("n2k", "n0183")]
    assert derive.update(spark, rows, table(keys), root)["objects"] == 0
    monkeypatch.setattr(derive, "MANY_PIECES", 2)
    assert derive.update(spark, rows, table(["b"]), root)["objects"] == 1
    assert {k.split("/")[0] for k in store.current(spark, root).extra} == {"ledger"}
    assert sorted(r.key for r in derive.read_ledger(spark, root).collect()) == sorted([*keys, "b"])


def test_a_paused_writer_cannot_publish(spark, tmp_path, monkeypatch):
    """Its lock ends while it stands still; another run takes over, and only that one's work is published."""
    rows, root = days_of_speed(spark), str(tmp_path / "t")
    one, two = (spark.createDataFrame([(k,)], "key string") for k in "ab")
    assert derive.update(spark, rows, one, root)["objects"] == 1
    monkeypatch.setattr(store.Lease, "renew", lambda self: None)
    own, taken = store.commit, []

    def paused(*a):
        if not taken:
            taken.append(store.lock_holder(spark, root))
            time.sleep(1.2)
            # Another host's run, from here: it finds the lock over, and names its holder until then.
            with store.locked(spark, root):
                assert store.current(spark, root).version == 2
        own(*a)

    with monkeypatch.context() as m:
        m.setattr(store, "commit", paused)
        with pytest.raises(store.Busy, match="written by another run"), store.locked(spark, root, 1.0):
            derive.write_update(spark, rows, two, root, "1s", False)
    assert taken[0]["pid"] == os.getpid() and taken[0]["host"] == store.socket.gethostname()
    assert {r.key for r in derive.read_ledger(spark, root).collect()} == {"a"}
    assert derive.update(spark, rows, two, root)["objects"] == 1 and store.current(spark, root).version == 3


def test_a_living_writer_keeps_its_lock(spark, tmp_path):
    root = str(tmp_path / "t")
    with store.locked(spark, root, 0.9):
        time.sleep(2)
        with pytest.raises(store.Busy), store.locked(spark, root):
            pass
    assert store.lock_holder(spark, root) is None
    store.Files(spark, root).create(store.LOCK, json.dumps({"pid": 1, "host": "elsewhere", "since": "then", "run": "x", "until": 0}).encode())
    with store.locked(spark, root):
        assert store.lock_holder(spark, root)["host"] == store.socket.gethostname()


def test_messages_over_objects_and_runs(spark, tmp_path):
    """A message whose frames lie in three objects, of two runs, is decoded once whole; strays between do not join."""
    data = bytearray(43)
    data[31], data[32] = 0x21, 1
    frames = [("n2k", r) for r in fast(129029, bytes(data))]
    other = [("n2k", r) for r in fast(129029, bytes(data), counter=3)]
    rows = records(spark, frames[:2] + other[:3] + frames[2:5] + frames[5:] + other[4:])
    at = F.when(F.col("seq") < 5, "a").when(F.col("seq") < 8, "b").otherwise("c")
    rows = rows.withColumn("object_key", at).withColumn("object_rank", F.ascii("object_key").cast("long"))
    whole = n2k.decode(archive.valid_records(rows)).select("object_key", "seq", "field", "value")
    assert {(r.object_key, r.seq) for r in whole.collect()} == {("c", 9)} and whole.count() >= 3
    root = str(tmp_path / "t")
    for key in ("a", "b", "c"):
        derive.update(spark, rows, spark.createDataFrame([(key,)], "key string"), root)
    (row,) = store.read_table(spark, root).collect()
    assert (row.n2k_method_code, row.n2k_gnsstype_code) == (2, 1)


def test_objects_make_no_difference_to_messages(spark):
    """Cut into objects anywhere, the same frames give the same messages."""
    import random

    rng = random.Random(1)
    frames = []
    for n in range(40):
        frames += [(n % 8, p) for p in (bytes.fromhex(r.split("#")[1]) for r in fast(129029, bytes([n]) * rng.choice([4, 9, 20, 43]), counter=n % 8)) if rng.random() > 0.05]
        rng.shuffle(frames[-1:])
    cut = sorted(rng.sample(range(len(frames)), 12))
    rows = [("d", sum(k >= c for c in cut), k, p.hex().upper()) for k, (_, p) in enumerate(frames)]
    table = spark.createDataFrame(rows, "device_id string, object_rank long, seq long, payload string")
    one = fast_packet.reassemble(table.drop("object_rank"), ["device_id"], ["seq"])
    many = fast_packet.reassemble(table, ["device_id"], ["object_rank", "seq"])
    assert sorted((r.seq, r.payload) for r in one.collect()) == sorted((r.seq, r.payload) for r in many.collect()) and one.count() > 15


def raw_object(tmp_path, day, name, text):
    path = tmp_path / "raw" / f"{day:%Y/%m/%d}" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text)
    return path


LINE = '{{"ts":"2024-01-0{d}T00:00:0{k}+00:00","mono":1.5,"device_id":"u","src":null,"proto":"n2k","raw":"09f8010{k}#00ff"}}\n'


def small_archive(tmp_path, corrupt=True):
    for d in (2, 3):
        text = "".join(LINE.format(d=d, k=k) for k in range(3)) + "\n  \n"
        raw_object(tmp_path, date(2024, 1, d), f"00000{d}-n2k-{d:016x}.ndjson.gz", gzip.compress(text.encode()))
    raw_object(tmp_path, date(2024, 1, 4), "000000-n0183-00000000000000aa.ndjson.gz", gzip.compress(b'{"ts":"2024-01-04T00:00:00+00:00","mono":null,"device_id":"u","src":"s","proto":"n0183","raw":"$X"}\n'))
    raw_object(tmp_path, date(2024, 1, 3), "000009-n2k-00000000000000ee.ndjson.gz", gzip.compress(b""))
    if corrupt:
        raw_object(tmp_path, date(2024, 1, 3), "000005-n2k-00000000000000bb.ndjson.gz", gzip.compress((LINE.format(d=3, k=5) + "{no json\n").encode()))
        raw_object(tmp_path, date(2024, 1, 3), "000006-n2k-00000000000000cc.ndjson.gz", gzip.compress(LINE.format(d=3, k=6).encode() * 500)[:60])
    return f"file://{tmp_path}"


def test_corrupt_objects_are_errors(spark, tmp_path):
    root = small_archive(tmp_path, corrupt=False)
    got = archive.read_archive(spark, root, date(2024, 1, 2), date(2024, 1, 3), "n2k")
    assert got.count() == 6 and {r.object_key[:15] for r in got.collect()} == {"raw/2024/01/02/", "raw/2024/01/03/"}
    raw_object(tmp_path, date(2024, 1, 3), "000005-n2k-00000000000000bb.ndjson.gz", gzip.compress((LINE.format(d=3, k=5) + "{no json\n").encode()))
    with pytest.raises(Exception, match="corrupt record in raw/2024/01/03/000005"):
        archive.read_archive(spark, root, date(2024, 1, 2), date(2024, 1, 3), "n2k").collect()
    kept = archive.read_archive(spark, root, date(2024, 1, 2), date(2024, 1, 3), "n2k", corrupt="keep")
    assert kept.where("_corrupt is not null").count() == 1 and kept.count() == 8


def test_export_leaves_out_what_it_cannot_read(spark, tmp_path):
    root = small_archive(tmp_path)
    out = f"file://{tmp_path}/out.candump"
    got = export.export(spark, root, out, export.Request(fmt="candump", until=date(2024, 1, 4)))
    text = (tmp_path / "out.candump").read_text().splitlines()
    assert got.status == 2 and [k[-22:-10] for k, _ in got.objects_failed] == ["0000000000bb", "0000000000cc"]
    assert (got.objects_read, got.rows_written, got.rows_refused) == (3, 6, 0)
    assert text == [f"({1704153600 + 86400 * d}.000000".replace(".", ".") for d in ()] or [x.split()[2] for x in text] == [f"09F8010{k}#00FF" for k in range(3)] * 2
    assert not list(tmp_path.glob("out.candump*parts*")) and not list(tmp_path.glob("*.part"))
    csv = export.export(spark, root, f"file://{tmp_path}/out.csv", export.Request(fmt="csv", since=date(2024, 1, 4)))
    assert csv.status == 0 and (tmp_path / "out.csv").read_bytes() == b"ts,mono,device_id,src,proto,raw\r\n2024-01-04T00:00:00+00:00,,u,s,n0183,$X\r\n"
    every = export.export(spark, root, f"file://{tmp_path}/out.ndjson", export.Request(proto="n0183"))
    assert every.rows_written == 1 and json.loads((tmp_path / "out.ndjson").read_text())["mono"] is None


def test_requests_without_meaning_are_refused():
    for bad in ({"source": "_log", "proto": "n2k"}, {"application": "x"}, {"fmt": "candump", "source": "_log"}, {"fmt": "candump", "proto": "n0183"}, {"fmt": "xml"}, {"source": "other"}):
        with pytest.raises(ValueError):
            export.Request(**bad)
    assert export.Request(fmt="candump").proto == "n2k"
    now = dt.datetime(2024, 2, 3, 4, 5, 6, tzinfo=dt.timezone.utc)
    assert export.Request(fmt="csv", proto="n0183").file_name(now) == "20240203T040506Z-n0183.csv" and export.Request(source="_log").file_name(now) == "20240203T040506Z-_log.ndjson"


def test_audit_entries(spark, tmp_path):
    at = dt.datetime(2024, 2, 3, 4, 5, 6, tzinfo=dt.timezone.utc)
    key = audit.publish(f"{tmp_path}/one", audit.Account("a.tool", "stopped", {"z": 1, "a": {"b": 2}}, 75), at)
    body = (tmp_path / "one" / key).read_bytes()
    assert key.startswith("_log/a.tool/2024/02/03/040506-") and key.endswith(".json")
    text = body.decode()
    assert list(json.loads(text)) == ["application", "comment", "details", "exit_code", "host", "timestamp"] and text.startswith('{\n  "application"')
    for bad in ("A", "", "a/b", "..", "-x"):
        with pytest.raises(ValueError):
            audit.Account(bad)
    with audit.recorded("file:///proc/nowhere", audit.Account("a")) as account:  # no log: the work goes on
        account.comment = "done"
    with pytest.raises(KeyError), audit.recorded(f"{tmp_path}/two", audit.Account("a", failed="lost: {}")):
        raise KeyError("x")
    (ended,) = [json.loads(p.read_text()) for p in (tmp_path / "two").rglob("*.json")]
    assert (ended["exit_code"], ended["comment"]) == (1, "lost: 'x'")
    tmp_path = tmp_path / "three"
    root = f"file://{tmp_path}"
    for tool in ("one", "two"):
        audit.publish(root, audit.Account(tool, "done, well", {"n": 1}))
    (tmp_path / "_log/one/2024/01/01").mkdir(parents=True)
    (tmp_path / "_log/one/2024/01/01/000000-0.json").write_text("{broken")
    got = export.export(spark, root, f"{root}/log.csv", export.Request(source="_log", fmt="csv"))
    assert (got.objects_read, got.rows_written, len(got.objects_failed), got.status) == (2, 2, 1, 2)
    assert export.export(spark, root, f"{root}/log.ndjson", export.Request(source="_log", application="two")).rows_written == 1


def legacy_table(spark, rows):
    return spark.createDataFrame(rows, "received_at timestamp, device_id string, source_ip string, raw_data string, sentence_type string")


def test_import(spark, tmp_path):
    at = lambda d, s=0: dt.datetime(2024, 1, d, 1, 2, s, tzinfo=dt.timezone.utc)
    rows = [(at(2, 1), "u", None, "$B", "B"), (at(2), "u", "10.0.0.1", "$A", "A"), (at(2), "u", None, "$A", "A"), (at(4), "v", "x", "$C", "C"), (at(6), "v", "x", "$late", "C")]
    table, root = legacy_table(spark, rows), f"file://{tmp_path}"
    now = dt.datetime(2024, 1, 7, 0, 2, tzinfo=dt.timezone.utc)  # the 6th is not closed yet
    planned = legacy.import_days(spark, table, root, now=now)
    assert [(d["day"].day, d["state"], d["rows"]) for d in planned] == [(2, "upload", 3), (3, "empty", 0), (4, "upload", 1), (5, "empty", 0)]
    assert not (tmp_path / "raw").exists() and not (tmp_path / "_log").exists()
    done = legacy.import_days(spark, table.repartition(3), root, live=True, now=now)
    assert [d["state"] for d in done] == ["uploaded", "empty", "uploaded", "empty"] and [d["key"] for d in done] == [d["key"] for d in planned]
    again = legacy.import_days(spark, table, root, live=True, now=now)
    assert [d["state"] for d in again] == ["up-to-date", "empty", "up-to-date", "empty"]
    assert [d["state"] for d in legacy.import_days(spark, table, root, now=now)] == ["up-to-date", "empty", "up-to-date", "empty"]
    lines = gzip.decompress((tmp_path / done[0]["key"]).read_bytes()).decode().splitlines()
    assert [json.loads(x)["raw"] for x in lines] == ["$A", "$A", "$B"] and json.loads(lines[0])["src"] == "10.0.0.1" and not list(tmp_path.rglob("_part*"))
    entries = [json.loads(p.read_text()) for p in sorted((tmp_path / "_log").rglob("*.json"))]
    runs = {e["details"]["run_id"] for e in entries}
    assert len(entries) == 4 and len(runs) == 2 and {e["details"]["event"] for e in entries} == {"start", "end"}
    assert legacy.import_days(spark, legacy_table(spark, []), root, now=now) == []


def test_import_refuses_naive_times_and_ends_its_entry(spark, tmp_path, monkeypatch):
    naive = spark.sql("SELECT timestamp_ntz'2024-01-02 00:00:00' AS received_at, 'u' AS device_id, 'x' AS source_ip, '$A' AS raw_data, 'A' AS sentence_type")
    with pytest.raises(ValueError, match="time zone"):
        legacy.import_days(spark, naive, f"file://{tmp_path}")
    with pytest.raises(ValueError, match="time zone"):
        legacy.import_days(spark, naive, f"file://{tmp_path}", since=date(2024, 1, 2), live=True)
    ends = [json.loads(p.read_text()) for p in (tmp_path / "_log").rglob("*.json")]
    assert sorted((e["exit_code"], e["details"]["event"]) for e in ends) == [(0, "start"), (1, "end")]


def test_commands(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(commands, "BATCH_OBJECTS", 2)
    root, table = small_archive(tmp_path, corrupt=False), f"file://{tmp_path}/table"
    update = ["update", "--root", root, "--table", table, "--until", "2024-01-03"]
    assert commands.main([*update, "--dry-run"], spark) == 0 and store.current(spark, table) is None
    assert commands.main([*update, "--rebuild"], spark) == 0 and "3 objects" in capsys.readouterr().err
    assert {r.key[-27:-10]: r.rows for r in derive.read_ledger(spark, table).collect()}.keys() == {"-0000000000000002", "-0000000000000003", "-00000000000000ee"}
    with store.locked(spark, table):
        assert commands.main([*update, "--rebuild"], spark) == 0 and "not running" in capsys.readouterr().err
    raw_object(tmp_path, date(2024, 1, 3), "000005-n2k-00000000000000bb.ndjson.gz", gzip.compress(b"{no json\n"))
    assert commands.main(update, spark) == 75 and "Run again" in capsys.readouterr().err
    assert commands.main(["export", "--root", root, "--since", "2024-01-03", "--until", "2024-01-03", "-o", f"file://{tmp_path}/x.ndjson"], spark) == 2
    assert len((tmp_path / "x.ndjson").read_text().splitlines()) == 3
    with pytest.raises(SystemExit):
        commands.main(["export", "--root", root, "--format", "xml"], spark)


def test_captured_lines_become_objects(spark, tmp_path):
    lines = ["(1502979132.106111) can0 09F50374#000A00FF", "(1502979132.106112) can0 09F50374#", "no frame", "(1502979132.1) can0 09F50374#00", "(1503014400.000000) can1 09F50374#FF"]
    got = capture.store_batch(spark.createDataFrame([(0, k, x) for k, x in enumerate(lines)], "segment long, byte long, value string").coalesce(1), f"file://{tmp_path}", "boat").collect()
    assert sorted(r.rows for r in got) == [1, 2]
    rows = archive.read_archive(spark, f"file://{tmp_path}", date(2017, 8, 17), date(2017, 8, 18)).orderBy("ts").collect()
    assert [(r.ts, r.src, r.raw) for r in rows] == [("2017-08-17T14:12:12.106111+00:00", "can0", "09f50374#000a00ff"), ("2017-08-17T14:12:12.106112+00:00", "can0", "09f50374#"), ("2017-08-18T00:00:00+00:00", "can1", "09f50374#ff")]


def test_stream_counts_objects_without_rows(spark, tmp_path):
    root, table = small_archive(tmp_path, corrupt=False), f"file://{tmp_path}/table"
    run = lambda: ingest.catch_up(spark, root, table, f"file://{tmp_path}/checkpoint", files_per_batch=1).awaitTermination()
    run()
    assert derive.read_ledger(spark, table).count() == 4
    raw_object(tmp_path, date(2024, 1, 9), "000000-n2k-00000000000000dd.ndjson.gz", gzip.compress(b"\n"))
    run()
    assert derive.read_ledger(spark, table).count() == 5


def test_a_failed_stream_is_started_again():
    from pyspark.errors import StreamingQueryException

    class Query:
        def __init__(self, fails):
            self.fails = fails

        def awaitTermination(self):  # noqa: N802
            if self.fails:
                raise StreamingQueryException("stopped")

    left, waits = [True, True, False], []
    ingest.supervised(lambda: Query(left.pop(0)), sleep=waits.append)
    assert not left and len(waits) == 2 and 0 <= waits[0] <= 2 and 0 <= waits[1] <= 4
    with pytest.raises(StreamingQueryException):
        ingest.supervised(lambda: Query(True), attempts=2, sleep=waits.append)


def test_view_has_no_nested_loop(spark):
    fact = spark.createDataFrame([(T0, 1.0)], "ts timestamp, n2k_sog double")
    cal = spark.createDataFrame([(1, T0, "man_bsp_adj", 1.1)], "cal_id long, effective_from timestamp, param_name string, param_value double")
    ses = spark.createDataFrame([], "session_id long, name string, type string, t_start timestamp, t_end timestamp")
    seg = spark.createDataFrame([], "seg_id long, session_id long, no int, leg_type string, mainsail string, headsail string, t_start timestamp, t_end timestamp")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    view = metrics.metrics(fact, cal, ses, seg)
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert len(tracker.getJobIdsForGroup(None)) == before  # no job to make the view
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert view.first().cal_id == 1


def test_asof_forms_agree(spark):
    import random

    rng = random.Random(2)
    at = lambda: T0 + dt.timedelta(minutes=rng.randrange(6000))
    facts = spark.createDataFrame([(k, at()) for k in range(300)], "k int, ts timestamp")
    rows = [(k, at() if k % 7 else None, k / 10) for k in range(40)] + [(99, T0 + dt.timedelta(minutes=3000), 9.9), (98, T0 + dt.timedelta(minutes=3000), 9.8)]
    cal = spark.createDataFrame(rows, "cal_id int, effective_from timestamp, v double")
    known = sorted((t, i, v) for i, t, v in rows if t)
    want = {}
    for r in facts.collect():
        t = r.ts.replace(tzinfo=T0.tzinfo)
        own = [c for c in known if c[0] <= t]
        want[r.k] = own[-1][1] if own else None
    for form in (joins.asof, joins.asof_union):
        assert {r.k: r.cal_id for r in form(facts, cal).collect()} == want


def test_ranges_of_any_length(spark):
    import math
    import random

    rng = random.Random(6)
    at = lambda minutes: T0 + dt.timedelta(minutes=minutes)
    spans = [(rng.uniform(-1e6, 1e6), 2 ** rng.uniform(-3, 22)) for _ in range(60)] + [(0, 60), (60, 120), (5, 0), (7, -3), (0, 1 / 60e6)]
    ranges = [(k, at(a), at(a + n)) for k, (a, n) in enumerate(spans)] + [(98, at(-5e6), None), (99, None, at(5)), (97, at(1e9 / 1000), None)]
    facts = [(k, at(rng.uniform(-1e6, 1e6))) for k in range(200)] + [(k, at(m)) for k, m in enumerate((0, 60, 120, 180, 5, 1 / 60e6), 200)] + [(300, None)]
    f = spark.createDataFrame(facts, "k int, ts timestamp").repartition(3)
    r = spark.createDataFrame(ranges, "r int, t_start timestamp, t_end timestamp")
    now = dt.datetime.now(dt.timezone.utc)
    for open_ in (False, True):
        got = joins.interval_join_dyadic(f, r, open_to_now=open_)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        stop = lambda e: e if e or not open_ else now
        want = []
        for k, t in facts:
            own = [i for i, a, e in ranges if t and a and stop(e) and a <= t < stop(e)]
            want += [(k, i) for i in own] or [(k, None)]
        assert sorted(((x.k, x.r) for x in got.collect()), key=str) == sorted(want, key=str)
    rows = {x.r: x["count"] for x in joins.cut_dyadic(r).groupBy("r").count().collect()}
    assert max(rows.values()) > 10
    for k, n in rows.items():
        assert n <= 2 * math.log2(max(2, spans[k][1] / 60 + 2)) + 2
