"""Ranges of keys, cut by the frequencies in a dictionary instead of a sample of the rows that are to be placed.

A range layout needs cut points before the first row is written. Spark would run the input once more to sample it; a dictionary
of the keys with the number of rows of each says all, and is far smaller. Rows find their place by binary search in a literal
list of cut points, which is a column expression.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordtrawl.session import cut_lineage

#: Steps that a part is cut in: a key as large as a step is looked at by itself, smaller neighbours together.
KEYS_PER_PART = 20
#: The column, and so the directory, that says which range of keys a row of a large index lies in.
KEY_RANGE = "key_range"


def weighted_keys(dictionary: DataFrame, key: str, weight: str, parts: int) -> list[tuple[str, float]]:
    """(key, rows it stands for) in ascending order: frequent keys as they are, rarer ones as the first of a run and its sum.

    Runs are cut by running sums over the sorted dictionary, so the weights are exact however rows are spread over rare keys.
    At most some ``2 * KEYS_PER_PART * parts`` keys come to the driver.
    """
    step = dictionary.agg((F.sum(weight) / (KEYS_PER_PART * parts)).alias("step")).first()["step"]
    if not step:
        return []
    keyed = dictionary.select(F.col(key).alias("k"), F.col(weight).alias("w")).filter("k IS NOT NULL")
    placed = cut_lineage(keyed.repartitionByRange("k").select("*", F.spark_partition_id().alias("part")))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.sum("w").alias("rows"))
    offsets = offsets.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    smaller = Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("below", F.coalesce(F.sum("w").over(smaller), F.lit(0))).join(F.broadcast(offsets), "part")
    large = F.when(F.col("w") >= step, F.col("k"))
    runs = summed.groupBy(F.floor((F.col("offset") + F.col("below")) / step).alias("run"), large.alias("large"))
    rows = runs.agg(F.min("k").alias("k"), F.sum("w").alias("w")).collect()
    return sorted((row["k"], row["w"]) for row in rows)


def cut_points(weights: list[tuple[str, float]], parts: int, ids: int, first_id: int = 0) -> list[tuple[str, int]]:
    """At most ``parts`` - 1 points (key, id) that cut the rows into about equal parts.

    A key that fills several parts is cut at ids, as if its rows were spread evenly over ``ids`` ids.
    """
    total = sum(w for _, w in weights)
    points, before = [], 0.0
    for key, weight in weights:
        while len(points) < parts - 1 and before + weight > total * (len(points) + 1) / parts:
            share = (total * (len(points) + 1) / parts - before) / weight
            points.append((key, first_id + int(share * ids) if weight > total / parts / 2 else first_id))
        before += weight
    return sorted(set(points))


def range_keys(weights: list[tuple[str, float]], ranges: int) -> list[str]:
    """At most ``ranges`` - 1 keys that cut the rows into about equal ranges; a key lies in one range whole."""
    return sorted({key for key, _ in cut_points(weights, ranges, 0)})


def place_among(points: list, *columns: Column) -> Column:
    """How many of the ascending ``points`` are not above the columns, by binary search. Points have one value per column."""
    if not points:
        return F.lit(0)
    if len(columns) == 1:
        bounds, value = F.from_json(F.lit(json.dumps(points)), "array<string>"), columns[0]
    else:
        rows = [{"k": key, "i": number} for key, number in points]
        bounds = F.from_json(F.lit(json.dumps(rows)), "array<struct<k:string,i:bigint>>")
        value = F.struct(columns[0].alias("k"), columns[1].cast("bigint").alias("i"))
    steps = [1 << b for b in reversed(range(len(points).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= value, at + step).otherwise(at),
    )
