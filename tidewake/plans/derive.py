"""From archive records to the wide table, once per object."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import arbitration, guard, merge, n0183, n2k
from ..schema import LEDGER, OBSERVATION, RAW, RAW_FIELDS
from ..sources.archive import valid_records
from . import store

#: What the archive's reader gives.
RECORD = f"{RAW}, object_key STRING, object_rank LONG, seq LONG"
RECORD_FIELDS = (*RAW_FIELDS, "object_key", "object_rank", "seq")
#: Runs whose ledger rows lie in folders of their own, above which they are put together, a folder a day.
MANY_PIECES = 200
#: Days of keys above which the whole ledger is read.
MANY_DAYS = 1000

#: How objects that share a bucket are put together.
GLOBAL, OBJECT_ORDER = "arbitrate_global", "object_order"


def samples(records: DataFrame, parts: bool = True) -> DataFrame:
    """SAMPLE rows of all known protocols; others give nothing. records: RAW with object_key, object_rank, seq. parts: whether frames of messages in parts may be among them."""
    valid = valid_records(records)
    return n2k.decode(valid, parts).unionByName(n0183.decode(valid))


def observations(sampled: DataFrame, interval: str = "1s", mode: str = GLOBAL) -> DataFrame:
    """(bucket_ts, field, value). arbitrate_global: one arbitration over all objects; object_order: each object on its own, later ones over earlier."""
    kept = guard.guard(sampled)
    if mode == OBJECT_ORDER:
        return merge.merge_objects(arbitration.bucketize(kept, interval))
    return arbitration.bucketize(kept, interval, by=())


def wide(observed: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return arbitration.widen(observed, fields)


def update(spark: SparkSession, records: DataFrame, keys: DataFrame, root: str, interval: str = "1s", rebuild: bool = False, dry_run: bool = False) -> dict:
    """Bring the table at root up to date with the objects that its ledger does not have; one writer at a time.

    keys: key of every object listed; records: their rows, as the archive gives
    them. Touched days alone are rewritten, and their folders, the ledger's new rows and
    the frames of messages still open become the table's next version by one file: a
    run that stops at any point is repeated with the same result. A dry run
    writes nothing and takes no lock.
    """
    if dry_run:
        return summary(spark, records, keys, root, interval, rebuild)
    with store.locked(spark, root):
        return write_update(spark, records, keys, root, interval, rebuild)


def key_day(key: Column) -> Column:
    """The day of an object's key, by which the ledger is parted; one part has the keys of another form."""
    return F.when(key.rlike("^raw/[0-9]{4}/[0-9]{2}/[0-9]{2}/"), F.translate(F.substring(key, 5, 10), "/", "-")).otherwise("other")


def fresh_keys(spark: SparkSession, keys: DataFrame, root: str, before: store.Manifest) -> DataFrame:
    """The keys that the ledger does not have; of the ledger only the days of these keys are read."""
    named = keys.select("key").distinct()
    if not any(k.startswith("ledger") for k in before.extra):
        return named
    days = [r["day"] for r in named.select(key_day(F.col("key")).alias("day")).distinct().limit(MANY_DAYS + 1).collect()]
    return merge.not_in_ledger(named, read_ledger(spark, root, before, days if len(days) <= MANY_DAYS else None))


def summary(spark: SparkSession, records: DataFrame, keys: DataFrame, root: str, interval: str, rebuild: bool) -> dict:
    before = (None if rebuild else store.current(spark, root)) or store.Manifest()
    fresh = fresh_keys(spark, keys, root, before)
    sampled = samples(records.join(fresh.select(F.col("key").alias("object_key")), "object_key", "left_semi"))
    found = arbitration.bucketize(guard.guard(sampled), interval).agg(F.countDistinct("object_key", "bucket_ts"), F.collect_set("field")).first()
    return {"objects": fresh.count(), "rows": found[0], "dropped": guard.guard_counts(sampled).first()["dropped"], "columns_added": sorted(set(found[1]) - set(before.columns))}


def write_update(spark: SparkSession, records: DataFrame, keys: DataFrame, root: str, interval: str, rebuild: bool) -> dict:
    last = store.current(spark, root) or store.Manifest()
    before = store.Manifest(version=last.version) if rebuild else last
    run = f"extra-{before.version + 1:010d}-{uuid.uuid4().hex[:8]}"
    at = lambda name: f"{root.rstrip('/')}/{run}/{name}"
    fresh_keys(spark, keys, root, before).write.parquet(at("fresh"))
    fresh = spark.read.schema("key string").parquet(at("fresh"))
    objects = fresh.count()
    if not objects:
        store.Files(spark, root).remove(run)
        return {"objects": 0, "rows": 0, "dropped": 0, "columns_added": []}
    new = records.join(fresh.select(F.col("key").alias("object_key")), "object_key", "left_semi").select(*RECORD_FIELDS)
    if "open" in before.extra:
        # Frames of messages that the last run left open come before all others.
        held = spark.read.schema(RECORD).parquet(f"{root.rstrip('/')}/{before.extra['open']}")
        new = new.unionByName(held.withColumn("object_rank", F.lit(-1).cast("long")))
    # Objects are unpacked and parsed once; frames, sentences and what stays open are taken from the rows.
    scanned, seen = Observation(), Observation()
    new.observe(scanned, F.count_if(n2k.in_parts()).alias("parts")).write.parquet(at("new"))
    new = spark.read.schema(RECORD).parquet(at("new"))
    parts = store.counts_of(scanned).get("parts", 0) > 0
    sampled = samples(new, parts).observe(seen, F.count_if(~guard.in_range(F.col("field"), F.col("value"))).alias("dropped"))
    # Decoded once; what follows reads the small table of observations.
    arbitration.bucketize(guard.guard(sampled), interval).write.parquet(at("observed"))
    per_object = spark.read.schema(OBSERVATION).parquet(at("observed"))
    if parts:
        n2k.open_frames(new).select(*RECORD_FIELDS).write.parquet(at("open"))
    ledger = write_ledger(spark, merge.ledger_rows(fresh, per_object), root, f"{run}/ledger", f"ledger-{before.version + 1:010d}")
    found = per_object.agg(F.countDistinct("object_key", "bucket_ts"), F.collect_set("field"), F.collect_set(F.date_format("bucket_ts", "yyyy-MM-dd"))).first()
    columns, days = sorted(set(found[1]) | set(before.columns)), set(found[2])
    after = store.Manifest(before.version + 1, columns, dict(before.days), {k: v for k, v in before.extra.items() if k.startswith("ledger")})
    if days:
        batch = wide(merge.merge_objects(per_object), sorted(found[1]))
        old = store.read_days(spark, root, before, sorted(days & set(before.days)))
        after.days |= store.write_days(spark, root, merge.merge_into(old, batch), after.version)
    opened = {"open": f"{run}/open"} if parts else {}
    after.extra |= {**opened, **ledger}
    if len({k.split("/")[0] for k in after.extra}) > MANY_PIECES:
        after.extra = {**opened, **write_ledger(spark, read_ledger(spark, root, after), root, f"{run}/whole", "ledger")}
    for name in ("fresh", "new", "observed"):
        store.Files(spark, f"{root.rstrip('/')}/{run}").remove(name)
    store.commit(spark, root, after)
    store.tidy(spark, root, after)
    return {"objects": objects, "rows": found[0], "dropped": store.counts_of(seen).get("dropped", 0), "columns_added": sorted(set(columns) - set(before.columns))}


def write_ledger(spark: SparkSession, rows: DataFrame, root: str, folder: str, name: str) -> dict[str, str]:
    """Store ledger rows a folder a day; the folders by name/day."""
    path = f"{root.rstrip('/')}/{folder}"
    rows.withColumn("day", key_day(F.col("key"))).repartition("day").write.partitionBy("day").parquet(path)
    return {f"{name}/{n.removeprefix('day=')}": f"{folder}/{n}" for n in store.Files(spark, path).names() if n.startswith("day=")}


def read_ledger(spark: SparkSession, root: str, manifest: store.Manifest | None = None, days: list[str] | None = None) -> DataFrame | None:
    """The ledger that goes with the table, or its rows of some days (see key_day): other days are not even listed. None if there is none."""
    manifest = manifest or store.current(spark, root)
    pieces = {k: v for k, v in sorted(manifest.extra.items()) if k.startswith("ledger")} if manifest else {}
    if not pieces:
        return None
    paths = [f"{root.rstrip('/')}/{v}" for k, v in pieces.items() if days is None or k.rsplit("/", 1)[1] in days]
    return spark.read.schema(LEDGER).parquet(*paths) if paths else spark.createDataFrame([], LEDGER)
