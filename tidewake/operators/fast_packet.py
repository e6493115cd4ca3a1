"""Fast-packet reassembly: messages of more than eight bytes, sent as several frames.

The first byte of a frame has a message counter (high three bits) and a frame
counter (low five). Frame 0 brings the length and six bytes, each later one seven.
Per (device, source, identifier, message counter) a frame 0 begins a message; a
message counts if its frame counters run from 0 without a gap and hold the declared
length. It takes the time and sequence of the frame that completes it.

Messages are found object by object, so no task sees more of an identifier than an
object has. Only each object's edges, the frames before its first message and its
last message, go on to a second pass over all objects, where messages that span them are
put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bits import hex_byte


def needed_frames(length: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil((length - 6) / 7) + 1).cast("int")


def numbered(frames: DataFrame, keys: list[str], order: list[str], payload: str = "payload") -> DataFrame:
    """frames of a message counter with _message, the messages begun so far, and _of, those begun in all; by the columns of keys."""
    first = hex_byte(F.col(payload), 0)
    cut = frames.withColumns({"_counter": F.shiftright(first, 5), "_frame": first.bitwiseAND(31)}).where(F.length(payload) >= 4)
    w = Window.partitionBy(*keys, "_counter")
    begun = F.sum(F.when(F.col("_frame") == 0, 1).otherwise(0))
    return cut.withColumns({"_message": begun.over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)), "_of": begun.over(w)})


def reassemble(frames: DataFrame, keys: list[str], order: list[str], payload: str = "payload") -> DataFrame:
    """Complete messages: keys, the order columns of the completing frame, payload, and every other column of that frame.

    order: the object's rank, then the place in it; or the place alone, of one object.
    """
    rest = [c for c in frames.columns if c not in {*keys, payload}]
    if len(order) == 1:
        return assembled(numbered(frames, keys, order, payload).where("_message > 0"), [*keys, "_counter", "_message"], keys, order, rest, payload)
    rank, object_ = order[0], "_object"
    here = numbered(frames.withColumn(object_, F.col(rank)), [*keys, object_], order, payload)
    inner = here.where("_message > 0 and _message < _of")
    edges = here.where("_message = 0 or _message = _of").drop("_counter", "_frame", "_message", "_of")
    over = numbered(edges, keys, order, payload).where("_message > 0")
    # Each lies by its own keys already, so neither is shuffled again to be put together.
    within = assembled(inner, [*keys, object_, "_counter", "_message"], keys, order, rest, payload)
    return within.unionByName(assembled(over, [*keys, "_counter", "_message"], keys, order, rest, payload))


def open_frames(frames: DataFrame, keys: list[str], order: list[str], payload: str = "payload") -> DataFrame:
    """The frames of each identifier's and counter's last message where it is not complete: what a later batch may go on with."""
    rank = order[0]
    here = numbered(frames.withColumn("_object", F.col(rank)), [*keys, "_object"], order, payload)
    edges = here.where("_message = 0 or _message = _of").drop("_counter", "_frame", "_message", "_of", "_object")
    last = numbered(edges, keys, order, payload).where("_message > 0 and _message = _of")
    w = Window.partitionBy(*keys, "_counter")
    length = F.max(F.when(F.col("_frame") == 0, hex_byte(F.col(payload), 1))).over(w)
    place = F.row_number().over(w.orderBy(*order)) - 1
    whole = last.withColumns({"_need": needed_frames(length), "_place": place})
    # A frame out of its place ends what could still become a message.
    whole = whole.withColumns({"_have": F.count("*").over(w), "_sound": F.min((F.col("_frame") == F.col("_place")).cast("int")).over(w)})
    return whole.where("_have < _need and _sound = 1").select(*frames.columns)


def assembled(started: DataFrame, group: list[str], keys: list[str], order: list[str], rest: list[str], payload: str) -> DataFrame:
    """The complete messages among groups of frames that each begin with a frame 0."""
    part = F.struct(*order, "_frame", payload, *[c for c in rest if c not in order])
    grouped = started.groupBy(*group).agg(F.sort_array(F.collect_list(part)).alias("_parts"))
    # Frames beyond the declared length belong to no message; the frame that reaches it completes it.
    length = hex_byte(F.element_at("_parts", 1)[payload], 1)
    count = needed_frames(length)
    used = F.slice("_parts", 1, count)
    gapless = F.transform(used, lambda p: p["_frame"]) == F.transform(F.sequence(F.lit(0), count - 1), lambda k: k.cast("bigint"))
    body = F.array_join(F.transform(used, lambda p, k: F.when(k == 0, F.substring(p[payload], 5, 100)).otherwise(F.substring(p[payload], 3, 100))), "")
    whole = grouped.withColumns({"_length": length, "_count": count, "_used": used, "_body": body})
    whole = whole.where((F.size("_used") == F.col("_count")) & gapless & (F.length("_body") >= F.col("_length") * 2))
    last = F.element_at("_used", -1)
    return whole.select(*keys, *(last[c].alias(c) for c in rest), F.expr("substring(_body, 1, cast(_length * 2 as int))").alias(payload))
