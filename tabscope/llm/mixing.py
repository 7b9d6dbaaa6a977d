"""Mixing sources to target weights: a time-varying curriculum.

Training runs over ``t`` in [0, 1] in phases of equal length; in each phase a source has a weight.  A source's share
of the words is the integral of its weight over that of all weights.  Shares become word targets, none above
``most`` times the source's size: the excess goes to the others in proportion to their shares until none is above.
The default schedule (``repeating_schedule``) has integrals 1, 2, 3, repeating: the first kind of source stays even,
the second rises and the third falls, so that the weights of three such sources have the same sum in every phase.
A source whose target is r times its size gives every document floor(r) times; the rest of its target is filled
with documents in the order of a hash.  A copy's demand (the words its source has given before it) is put through
the inverse of the source's cumulative demand curve, which gives the training position in [0, 1], and the copies
are sorted by ranges of position.

Everything is DataFrame functions.  Running sums go over (source, hash block), so one source may hold any share of
the rows.  The table of sources has one row per source.

Defined cases: a null source is a source of its own (last in order); null or empty text has size 0 and takes
nothing; a null doc_id is ordered by its text; repeated rows are documents of their own; an empty table gives an empty
result; other columns are carried along by ``mixed`` and ignored by ``plan``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import before, narrow, shielded, stored

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3
#: Hex digits of the order hash that number the blocks of a running sum.
BLOCK_DIGITS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def repeating_weights(weights: Sequence[float] = (1, 2, 3)) -> Column:
    """Constant weights for sources in code point order (null last), repeating."""
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    return F.array(F.array(*[F.lit(float(w)) for w in weights])[(rank % len(weights)).cast("int")])


def repeating_schedule(weights: Sequence[float] = (1, 2, 3), step: float = 0.5, phases: int = 4) -> Column:
    """Schedules whose means are ``weights`` for sources in code point order (null last), repeating: from phase to
    phase the first stays, the second rises by ``step``, the third falls by it, and so on."""
    slopes = [(0.0, step, -step)[i % 3] for i in range(len(weights))]
    if any(w < abs(slope) * (phases - 1) / 2 for w, slope in zip(weights, slopes, strict=True)):
        raise ValueError("a schedule falls under 0")
    lines = [F.array(*[F.lit(w + slope * (p - (phases - 1) / 2)) for p in range(phases)])
             for w, slope in zip(weights, slopes, strict=True)]
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    return F.array(*lines)[(rank % len(weights)).cast("int")]


def source_targets(sizes: DataFrame, weights: Column, most: int = MOST) -> DataFrame:
    """``(source, source_size, schedule, target)`` from ``(source, source_size)``: ``weights`` gives an array with a
    weight for each phase (all sources have as many)."""
    s = sizes.withColumn("schedule", weights)
    integral = F.aggregate("schedule", F.lit(0.0), lambda a, x: a + x)
    s = s.withColumn("omega", integral / F.sum(integral).over(Window.partitionBy()))
    # water filling: sources by the level at which they meet their cap; the first level that all later ones can
    # share without meeting theirs is the common one
    s = s.withColumn("cap", F.col("source_size") * most)
    line = Window.orderBy(F.col("cap") / F.col("omega"), F.col("source").isNull(), "source")
    total = F.sum("source_size").over(Window.partitionBy())
    capped = F.coalesce(F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("omega").over(line.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (total - capped) / left)
    s = s.withColumn("level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("omega"), F.col("level"))).over(
        Window.partitionBy()))
    target = F.when(F.col("level").isNull() | (F.col("level") * F.col("omega") >= F.col("cap")),
                    F.col("cap").cast("double")).otherwise(F.col("level") * F.col("omega"))
    return s.select("source", "source_size", "schedule", target.alias("target"))


def _position(demand: Column) -> Column:
    """Inverse of the source's cumulative demand: phases are lines, so it is found phase by phase."""
    n = F.size("schedule")
    state = F.struct(F.lit(0.0).alias("from"), F.lit(0).alias("phase"), F.lit(-1.0).alias("t"))
    sum_of = F.aggregate("schedule", F.lit(0.0), lambda a, x: a + x)
    want = F.try_divide(demand * sum_of, F.col("target"))

    def step(a, x):
        inside = (a["t"] < 0) & (x > 0) & ((want <= a["from"] + x) | (a["phase"] == n - 1))
        return F.struct((a["from"] + x).alias("from"), (a["phase"] + 1).alias("phase"),
                        F.when(inside, (a["phase"] + F.least((want - a["from"]) / x, F.lit(1.0))) / n).otherwise(a["t"]).alias("t"))
    return F.coalesce(F.greatest(F.aggregate("schedule", state, step)["t"], F.lit(0.0)), F.lit(0.0))


def _placed(sized: DataFrame, weights: Column, most: int) -> DataFrame:
    """Adds source_size, schedule, target, copies and before (words of the source earlier in hash order) to rows
    ``(doc_id, source, size, o)``."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sources, weights, most).withColumnRenamed("source", "_source"), "targets")
    x = before(sized, ["source"], F.conv(F.substring("o", 1, BLOCK_DIGITS), 16, 10).cast("int"),
               ["o", "size"], F.col("size"), "before")
    x = x.join(targets, x["source"].eqNullSafe(targets["_source"])).drop("_source")
    times = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    x = x.withColumn("times", F.when(F.col("target") >= F.col("source_size") * most, F.lit(most)).otherwise(times).cast("long"))
    more = F.col("before") + F.col("size") / 2 <= F.col("target") - F.col("times") * F.col("source_size")
    return x.withColumn("copies", F.col("times") + F.when((F.col("times") < most) & more, 1).otherwise(0))


def _order() -> Column:
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")))


def plan(docs: DataFrame, weights: Column | None = None, most: int = MOST) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies, first_position)`` for each document, sorted by ranges of
    the training position of its first copy; documents that aren't taken come first, without a position."""
    weights = repeating_schedule() if weights is None else weights
    sized = stored(narrow(docs, "doc_id", "text", "source").select(
        "doc_id", "source", word_count().alias("size"), _order().alias("o")), "sized")
    x = _placed(sized, weights, most)
    x = x.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies",
                 F.when(F.col("copies") > 0, _position(F.col("before") + F.col("size") / 2)).alias("first_position"))
    return x.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


def mixed(docs: DataFrame, weights: Column | None = None, most: int = MOST) -> DataFrame:
    """The documents as the mix takes them: each as many times as it has copies, sorted by ranges of training
    position, with the columns that they came with.  Rows that repeat doc_id, source and text go together."""
    weights = repeating_schedule() if weights is None else weights
    x, (doc_id, text, source) = shielded(docs, "doc_id", "text", "source")
    key = x.withColumn("_row", F.md5(F.to_json(F.struct(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.md5(text).alias("text")))))
    sized = key.select("_row", F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"))
    sized = stored(sized.select("_row", "source", word_count().alias("size"), _order().alias("o")).groupBy("_row").agg(
        F.first("source").alias("source"), F.first("o").alias("o"), F.sum("size").alias("size")), "sized")
    demand = F.col("before") + F.col("size") / 2
    turns = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)
    taken = _placed(sized, weights, most).where("copies > 0").select("_row", F.explode(F.transform(
        turns, lambda turn: _position(demand + turn * F.col("source_size")))).alias("_at"))
    out = key.join(taken, "_row").repartitionByRange("_at", "_row").sortWithinPartitions("_at", "_row")
    return out.select(*x.columns).toDF(*docs.columns)


#: The same mix for DuckDB with the default schedule: its integrals 1, 2, 3 and its four phases.
PLAN_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS o,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
         1.0 + ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3) AS w,
         [[1.0, 1.0, 1.0, 1.0], [1.25, 1.75, 2.25, 2.75], [3.75, 3.25, 2.75, 2.25]]
           [1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE[] AS schedule
  FROM sized GROUP BY source),
shares AS (SELECT *, CAST(w AS DOUBLE) / sum(CAST(w AS DOUBLE)) OVER () AS omega FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (
              ORDER BY cap / omega, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(omega) OVER (ORDER BY cap / omega, source IS NULL, source
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM shares),
common AS (SELECT max(level) AS level FROM levels WHERE level <= cap / omega),
targets AS (
  SELECT s.source, s.source_size, CASE WHEN c.level IS NULL OR c.level * s.omega >= s.cap THEN CAST(s.cap AS DOUBLE)
                                       ELSE c.level * s.omega END AS target, s.cap, s.schedule
  FROM shares s, common c),
placed AS (
  SELECT z.*, t.source_size, t.target, t.schedule,
         coalesce(sum(z.size) OVER (PARTITION BY z.source ORDER BY z.o, z.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.target >= t.cap THEN 3 ELSE coalesce(floor(t.target / nullif(t.source_size, 0)), 0) END AS times
  FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(times + CASE WHEN times < 3 AND before + size / 2 <= target - times * source_size THEN 1 ELSE 0 END
                 AS BIGINT) AS copies,
         coalesce((before + size / 2) * list_sum(schedule) / nullif(target, 0), 0) AS want
  FROM placed),
phased AS (
  SELECT *, CASE WHEN want <= schedule[1] THEN 1 WHEN want <= list_sum(schedule[1:2]) THEN 2
                 WHEN want <= list_sum(schedule[1:3]) THEN 3 ELSE 4 END AS phase
  FROM counted)
SELECT doc_id, size, source_size, round(target, 2) AS target, copies * size AS taken, copies,
       CASE WHEN copies > 0 THEN round((phase - 1 + least((want - coalesce(list_sum(schedule[1:phase - 1]), 0))
                                                          / schedule[phase], 1)) / 4, 6) END AS first_position
FROM phased
"""
