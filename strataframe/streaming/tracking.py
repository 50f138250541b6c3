"""What happens to a target after a hit, from samples of its movement: in batches with windows, which needs no state.

Samples have target, ts (seconds), speed and ground, the distance to the ground or null where there is none near. Rows of one target
are ordered by ts; the windows below share one shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.config import Hits
from strataframe.storage import stored

C = F.col
#: Below that distance a target touches the ground; seconds after which a trail is flushed.
TOUCH, FLUSH = 4.0, 3.0


def generations(hits: DataFrame, per_target: bool = False) -> DataFrame:
    """hits (target, event_id, ts) with generation, how many there have been so far, and superseded, the ts of the next: from then on
    work for the hit is stale. One counter for all is the rule: hits are sorted over all tasks, and each part's rows are numbered from the sum of the parts before
    it, of which one row each reaches the driver. With per_target each target has a counter of its own."""
    if per_target:
        w = W.partitionBy("target").orderBy("ts", "event_id")
        return hits.withColumns({"generation": F.row_number().over(w), "superseded": F.lead("ts").over(w)})
    parts = stored(hits.orderBy("ts", "event_id").withColumn("__part", F.spark_partition_id()), "hits")
    sums = sorted(parts.groupBy("__part").agg(F.count("*").alias("n"), F.min("ts").alias("first")).collect(), key=lambda r: r["__part"])
    rows, total = [], 0
    for r, after in zip(sums, [*sums[1:], None]):
        rows.append((r["__part"], total, after and after["first"]))
        total += r["n"]
    base = parts.sparkSession.createDataFrame(rows, T.StructType([T.StructField("__part", T.IntegerType()), T.StructField("__base", T.LongType()), T.StructField("__next", hits.schema["ts"].dataType)]))
    w = W.partitionBy("__part").orderBy("ts", "event_id")
    known = parts.join(F.broadcast(base), "__part")
    numbered = known.withColumns({"generation": (F.row_number().over(w) + C("__base")).cast("int"), "superseded": F.coalesce(F.lead("ts").over(w), "__next")})
    return numbered.drop("__part", "__base", "__next")


def live_work(work: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows of work (generation, at) that no newer hit had made stale when they came."""
    return work.join(hits.select("generation", "superseded"), "generation").filter(C("superseded").isNull() | (C("at") < C("superseded"))).drop("superseded")


def ground_state(samples: DataFrame, p: Hits = Hits()) -> DataFrame:
    """target, contact, braced, recovered (ts or null), state: the last one reached.

    A target first touches the ground, braces where it touches it brace_delay or more after that, and recovers when it is slower than
    stop_speed before or than stand_speed after that; then its samples end.
    """
    own = W.partitionBy("target")
    least = lambda c: F.min(F.when(c, C("ts"))).over(own)
    touch = C("ground") < TOUCH
    rows = samples.withColumn("__c", least(touch))
    rows = rows.withColumn("__b", least(touch & (C("ts") - C("__c") >= p.brace_delay)))
    rows = rows.withColumn("__early", least((C("speed") < p.stop_speed) & (C("__b").isNull() | (C("ts") < C("__b")))))
    rows = rows.withColumn("__late", least((C("ts") > C("__b")) & (C("speed") < p.stand_speed)))
    found = rows.groupBy("target").agg(*(F.first(c).alias(c) for c in ("__c", "__b", "__early", "__late")))
    end = F.coalesce("__early", "__late")
    contact = F.when(C("__early").isNull() | (C("__c") <= C("__early")), C("__c"))
    braced = F.when(C("__early").isNull(), C("__b"))
    state = F.when(end.isNotNull(), "recovered").when(braced.isNotNull(), "braced").when(contact.isNotNull(), "contact").otherwise("airborne")
    return found.select("target", contact.alias("contact"), braced.alias("braced"), end.alias("recovered"), state.alias("state"))


def emissions(samples: DataFrame, seconds: float = Hits().dust_cooldown) -> DataFrame:
    """target, ts, since: when a target that touches the ground throws dust, at least `seconds` apart, and since which emission a crater
    runs (null where it begins: at first, or after a sample in the air). A target's samples are folded in memory."""
    touch = F.coalesce(C("ground") < TOUCH, F.lit(False))
    own = samples.groupBy("target").agg(F.array_sort(F.collect_list(F.struct("ts", touch.alias("on")))).alias("s"))
    none = F.lit(None).cast("double")
    start = F.struct(none.alias("last"), none.alias("since"), F.array().cast("array<struct<ts:double,since:double>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        due = s["on"] & (acc["last"].isNull() | (s["ts"] - acc["last"] >= seconds))
        return F.struct(
            F.when(due, s["ts"]).otherwise(acc["last"]).alias("last"), F.when(due, s["ts"]).when(s["on"], acc["since"]).alias("since"),
            F.when(due, F.array_append(acc["out"], F.struct(s["ts"].alias("ts"), acc["since"].alias("since")))).otherwise(acc["out"]).alias("out"),
        )

    return own.select("target", F.inline(F.aggregate("s", start, step, lambda acc: acc["out"])))


def side_outputs(emitted: DataFrame) -> DataFrame:
    """target, ts, kind, since: the rows that an emission gives, dust and a crater, in one table."""
    kinds = F.array(F.struct(F.lit("dust").alias("kind"), F.lit(None).cast("double").alias("since")), F.struct(F.lit("crater").alias("kind"), F.coalesce("since", "ts").alias("since")))
    return emitted.select("target", "ts", F.inline(kinds))


def flushes(emitted: DataFrame, seconds: float = FLUSH) -> DataFrame:
    """target, trail, first, due: trails (emissions that follow each other) and when they are flushed, `seconds` after their last one."""
    w = W.partitionBy("target").orderBy("ts")
    rows = emitted.withColumn("trail", F.sum(C("since").isNull().cast("int")).over(w))
    return rows.groupBy("target", "trail").agg(F.min("ts").alias("first"), (F.max("ts") + seconds).alias("due"))


def sweeps(positions: DataFrame, every: float = 1.0) -> DataFrame:
    """target, tick, y, home: at each tick, the targets whose last position (ts, y) before it is below 0, with where they were first."""
    tick = F.floor(C("ts") / every) + 1
    home = positions.groupBy("target").agg(F.min_by("y", "ts").alias("home"))
    last = positions.groupBy("target", tick.alias("tick")).agg(F.max_by("y", "ts").alias("y"))
    return last.filter("y < 0").join(home, "target").select("target", "tick", "y", "home")
