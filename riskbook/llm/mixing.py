"""Mixing sources to target weights as a curriculum that changes over training time.

Each source has a weight schedule over training time 0 to 1 (piecewise linear).  Its integral sets
the source's share of all words; a target above `most` times the source's words stops there and the
excess goes to the others by weight.  A source's documents, in the order of a digest of their
identifier, fill its target in whole passes and a last part pass; the document at the end of the part
pass is taken in part (its first words), so that every target is met to the word.  A document's place
among its source's words is turned into a training position by inverting the source's cumulative
demand, and the mix is sorted by position in ranges.

Everything is DataFrame functions.  Running totals within a source go over buckets of about
`BUCKET` documents first, then inside a bucket, so that no task holds a whole source.

Defined cases: a null text has no words and is not taken; a null source is a source of its own, the last;
null identifiers sort like the empty one; rows equal in identifier, source and text are separate
documents; without any words every target is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.llm.storage import store

WEIGHTS = (1, 2, 3)
TIMES = (0.0, 0.5, 1.0)
#: For each of WEIGHTS, the schedule's level at TIMES as a multiple of the weight; each has mean 1.
SHAPES = ((0.5, 1.0, 1.5), (1.0, 1.0, 1.0), (1.5, 1.0, 0.5))
MOST = 3
BUCKET = 1000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def integrals(levels: tuple[float, ...], times: tuple[float, ...] = TIMES) -> list[float]:
    """Integral of a piecewise linear schedule from the start to each time."""
    out = [0.0]
    for i in range(len(times) - 1):
        out.append(out[-1] + (levels[i] + levels[i + 1]) / 2 * (times[i + 1] - times[i]))
    return out


def invert(levels: tuple[float, ...], share: Column, times: tuple[float, ...] = TIMES) -> Column:
    """Time at which a schedule has used up a share (0 to 1) of its integral."""
    done = integrals(levels, times)
    goal = share * F.lit(done[-1])
    at = F.lit(times[-1])
    for i in reversed(range(len(times) - 1)):
        left = goal - F.lit(done[i])
        slope = (levels[i + 1] - levels[i]) / (times[i + 1] - times[i])
        root = F.sqrt(F.greatest(F.lit(levels[i] ** 2) + F.lit(2 * slope) * left, F.lit(0.0)))
        inside = F.when(left <= 0, F.lit(times[i])).otherwise(F.lit(times[i]) + F.lit(2.0) * left / (F.lit(levels[i]) + root))
        at = F.when(goal <= F.lit(done[i + 1]), inside).otherwise(at)
    return at


def position(kind: Column, share: Column) -> Column:
    at = F.lit(None).cast("double")
    for i, shape in enumerate(SHAPES):
        at = F.when(kind == i, invert(shape, share)).otherwise(at)
    return at


def row_key() -> Column:
    """Digest of identifier, source and text; rows that differ in one of them have different keys."""
    return F.md5(
        F.concat_ws(
            "\x01",
            F.coalesce(F.col("doc_id").cast("string"), F.lit("\x02")),
            F.coalesce("source", F.lit("\x02")),
            F.md5(F.coalesce("text", F.lit(""))),
        )
    )


def targets(totals: DataFrame, most: int = MOST) -> DataFrame:
    """Target words of each source, for rows (source, source_size, documents): one row per source.

    With one level for all sources a target is level * weight.  Sources that stop at their cap are
    those with the least cap for their weight; in that order, the level is that of the first source
    which does not stop when the words left are shared by it and all after it.
    """
    weights = [float(w) * integrals(s)[-1] for w, s in zip(WEIGHTS, SHAPES, strict=True)]
    named = totals.withColumn("kind", (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(WEIGHTS))
    room = (
        named.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("place", F.row_number().over(Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))))
    )
    order = Window.orderBy("place")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levels = room.withColumn("level", left / F.sum("weight").over(after))
    fits = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("place", "level"))).over(whole)
    return levels.withColumn("fits", fits).select(
        "source",
        "source_size",
        "documents",
        "kind",
        F.least(F.col("cap").cast("double"), F.col("fits.level") * F.col("weight")).alias("target"),
    )


def takes(docs: DataFrame, most: int = MOST) -> DataFrame:
    """What the mix takes of each document.

    Rows have doc_id, source, key (see `row_key`), nth (among rows of one key), size, source_size,
    target, kind, before (words of the source's documents ahead), passes (whole ones) and part (words
    of the part pass).
    """
    sized = store(docs.select("doc_id", "source", row_key().alias("key"), word_count(F.col("text")).alias("size")), "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    goals = store(targets(totals, most).withColumnRenamed("source", "s"), "targets")
    # the first 32 bits of an identifier's digest, as many of them as deal the source into buckets
    bits = F.ceil(F.log2(F.greatest(F.col("documents") / BUCKET, F.lit(1.0))))
    head = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    rows = (
        sized.join(goals, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("digest", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        .withColumn("bucket", F.floor(head / F.pow(F.lit(2.0), F.least(F.lit(32), 32 - bits))).cast("long"))
        .withColumn("name", F.coalesce("source", F.lit("\x02")))
    )
    ahead = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        rows.groupBy("name", "bucket")
        .agg(F.sum("size").alias("words"))
        .select("name", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    )
    order = Window.partitionBy("name", "bucket").orderBy("digest", "size", "key")
    within = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = rows.join(buckets, ["name", "bucket"]).select(
        "*",
        (F.col("ahead") + within).alias("before"),
        F.row_number().over(Window.partitionBy("name", "bucket", "digest", "size", "key").orderBy(F.lit(1))).alias("nth"),
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")
    return placed.withColumn("passes", passes).select(
        *("doc_id", "source", "key", "nth", "size", "source_size", "target", "kind", "before", "passes"),
        F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before"))).alias("part"),
    )


def taken(plan: DataFrame) -> DataFrame:
    """One row per document: size, source_size, target, words taken, and its first training position."""
    words = F.col("passes") * F.col("size") + F.col("part")
    first = F.when(F.col("passes") > 0, F.col("size")).otherwise(F.col("part"))
    share = F.least(F.lit(1.0), (F.col("before") + first / 2) / F.col("target"))
    return plan.select(
        *("doc_id", "size", "source_size", "target"),
        words.alias("taken"),
        F.when(words > 0, F.round(position(F.col("kind"), share), 6)).alias("first_position"),
    )


def mix(docs: DataFrame, most: int = MOST, labels: tuple[str, ...] = ("position", "words")) -> DataFrame:
    """The mix in training order: rows of `docs`, as often as they are taken, with their place and words.

    `labels` names those two columns; without names they are left out.  A document taken in part has its first words, joined by spaces, as text (and n_chars, if there is
    such a column, is that text's length).
    """
    plan = takes(docs, most).where("size > 0 AND (passes > 0 OR part > 0)")
    plan = plan.select(*(F.col(c).alias(f"__{c}") for c in plan.columns if c not in ("doc_id", "source")))
    columns = docs.columns
    ties = [c for c in columns if c not in ("doc_id", "source", "text")] or [F.lit(1)]
    same = Window.partitionBy("__key").orderBy(*ties)
    rows = docs.withColumn("__key", row_key()).withColumn("__row", F.row_number().over(same))
    # the number among equal rows is not a join key, so that the window's partitions serve the join
    chosen = rows.join(plan, "__key").where("__row - __nth = 0")
    times = F.col("__passes") + (F.col("__part") > 0).cast("int")
    copies = chosen.withColumn("__pass", F.explode(F.sequence(F.lit(0).cast("long"), times - 1))).withColumn(
        "__words", F.when(F.col("__pass") < F.col("__passes"), F.col("__size")).otherwise(F.col("__part"))
    )
    start = F.col("__pass") * F.col("__source_size") + F.col("__before")
    share = F.least(F.lit(1.0), (start + F.col("__words") / 2) / F.col("__target"))
    found = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.col("__words") < F.col("__size")
    out = copies.withColumn("__position", position(F.col("__kind"), share)).withColumn(
        "text", F.when(cut, F.concat_ws(" ", F.slice(found, F.lit(1), F.col("__words").cast("int")))).otherwise(F.col("text"))
    )
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    order = ["__position", "__key", "__row", "__pass"]
    added = [F.col(c).alias(name) for c, name in zip(("__position", "__words"), labels, strict=False)]
    return out.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select(*columns, *added)
