"""Mixing sources to target weights by a low-discrepancy schedule.

Slots of the mix are numbered, and slot k lies at the golden-ratio point ``frac(k * phi)``. Cumulative
weights cut [0, 1) into an interval for each source, so any stretch of slots serves the sources in
nearly the wanted proportions. The r-th slot of a source takes the r-th of its blocks of equally many
words: its documents, shuffled by a hash, lie one after the other, twice, and are cut into blocks. A
source is served until it has its target; its last block is cut there. All is integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.tables import unused, written

#: Words of a block; weights of the sources, in turn; words of the mix for each 100 of the corpus; how
#: often a source may be used.
BLOCK_WORDS = 1024
WEIGHTS, SHARE, PASSES = (3, 1, 2), 150, 2

#: Points are multiples of 2**-42, and the golden ratio's fraction in such units, made odd.
UNITS, GOLDEN = 1 << 42, 2718117142399 | 1
_LOW = 1 << 20

#: Slots are ranked within runs of so many, and documents placed within buckets of about so many.
RUN_SLOTS, BUCKET_DOCS = 1 << 16, 1 << 13


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def point(slot: Column) -> Column:
    """``slot * GOLDEN`` modulo ``UNITS`` without overflow, for slots below 2**40."""
    high, low = F.floor(slot / _LOW).cast("long"), slot % _LOW
    return (high * (GOLDEN * _LOW % UNITS) % UNITS + low * GOLDEN) % UNITS


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: int = SHARE, passes: int = PASSES) -> DataFrame:
    """``(source, source_size, weight, target)`` of ``sizes(source, source_size)``, a row a source.

    Sources in order of code point, null last, weigh ``weights`` in turn and share ``share`` percent of
    all words. No target exceeds ``passes`` times its source's words; the excess goes to the others by
    weight. That is a level L with targets ``min(passes * size, weight * L)``: sources ordered by size
    to weight fill up one after the other, so L follows from running sums. An all-empty corpus has targets 0.
    """
    # One row a source: these windows hold the list of sources, never documents.
    place = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int")))
    filling = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    cap = F.col("source_size") * passes
    ranked = ranked.withColumns({"cap": cap, "all": F.sum("source_size").over(every) * share / F.lit(100.0)})
    ranked = ranked.withColumn("level", (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest))
    # The first source that does not fill up sets the level for itself and all after it.
    unfilled = F.when(F.col("cap") > F.col("weight") * F.col("level"), F.struct((F.col("source_size") / F.col("weight")).alias("ratio"), "level"))
    ranked = ranked.withColumn("first", F.min(unfilled).over(every))
    cap = F.col("cap").cast("double")
    target = F.when(F.col("first").isNull(), cap).otherwise(F.least(cap, F.col("weight") * F.col("first.level")))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def schedule(goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(slot, s, rank)``: which source each slot serves, and which of its blocks.

    ``goals(s, goal)`` has the words to take from each source, by a dense number from 0. A source's
    interval is as wide as its share of all blocks. Any interval of the width of one block is met once
    within 2.7 times as many slots as there are blocks, so three times as many serve every source in
    full; slots of a source that has its goal are left out.
    """
    quota = goals.select("s", F.ceil(F.col("goal") / block_words).alias("quota"))
    upto = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(1))
    quota = quota.withColumn("upto", F.sum("quota").over(upto)).withColumn("blocks", F.sum("quota").over(every))
    bound = lambda blocks: F.floor(blocks / F.col("blocks") * UNITS).cast("long")
    intervals = quota.where("quota > 0").select("s", "quota", bound(F.col("upto") - F.col("quota")).alias("low"), bound(F.col("upto")).alias("high"))
    blocks = quota.agg(F.max("blocks")).first()[0] or 0
    slots = quota.sparkSession.range(3 * blocks + 16 if blocks else 0).withColumnRenamed("id", "slot").withColumn("at", point(F.col("slot")))
    # Points and intervals meet in equal cells, an ordinary equi-join.
    cell = UNITS >> 12
    cells = intervals.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / cell), F.floor((F.col("high") - 1) / cell))))
    served = slots.withColumn("cell", F.floor(F.col("at") / cell)).join(cells, "cell").where("at >= low and at < high")
    # Ranks within runs of slots, and the slots of earlier runs: no window holds all slots of a source.
    served = served.select("slot", "s", "quota", F.floor(F.col("slot") / RUN_SLOTS).alias("run"))
    runs = served.groupBy("s", "run").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("s").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("s", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("s", "run").orderBy("slot")
    ranked = served.withColumn("own", F.row_number().over(own) - 1).join(runs, ["s", "run"])
    return ranked.withColumn("rank", F.col("before") + F.col("own")).where("rank < quota").select("slot", "s", "rank")


def mix(
    docs: DataFrame, weights: tuple = WEIGHTS, share: int = SHARE, passes: int = PASSES, block_words: int = BLOCK_WORDS,
    seed: str = "mix", extra: tuple = (),
) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs(doc_id, text, source)``: pieces and documents.

    Pieces are ``(slot, s, start, doc_id, pass, from_word, n_words)``: in slot order they are the mix; a
    document has a piece in each block that it reaches into. Documents are ``(doc_id, source, s, start,
    size, source_size, target)``, ``(s, start)`` being the key of a document with words.

    A null text has no words, a null source is a source of its own, and documents without words are in
    no piece. Equal doc_ids are rows of their own, told apart by their size and then by the columns ``extra``,
    which documents keep. Nothing is drawn at random:
    the shuffle orders documents by the md5 of seed and doc_id. An empty table has an empty mix.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words_in(F.col("text").cast("string")).alias("size"), *extra)
    docs = written(docs.withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))), "sizes")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes, weights, share, passes).withColumn("goal", F.floor(F.col("target") + 0.5))
    goals = written(goals.withColumn("s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1), "goals")
    # Place of each document: sums over buckets of the shuffle, and within the document's bucket.
    digits = 0
    count = docs.count()
    while count > BUCKET_DOCS * 16**digits:
        digits += 1
    keyed = docs.join(goals, docs.source.eqNullSafe(goals.source)).drop(goals.source).withColumn("bucket", F.substring("h", 1, digits))
    sums = keyed.groupBy("s", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("s", "bucket").orderBy("h", "doc_id", "size", *extra).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0))).join(sums, ["s", "bucket"])
    placed = written(placed.select(
        "doc_id", "source", "s", (F.col("before") + F.col("own")).alias("start"), "size", "source_size", "target", "goal", *extra), "placed")

    begin = F.col("pass") * F.col("source_size") + F.col("start")
    taken = placed.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    taken = taken.withColumn("begin", begin).where("begin < goal").withColumn("end", F.least(F.col("begin") + F.col("size"), "goal"))
    rank = F.explode(F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words)))
    taken = taken.withColumn("rank", rank).join(schedule(goals, block_words), ["s", "rank"])
    first = F.greatest("begin", F.col("rank") * block_words)
    last = F.least("end", (F.col("rank") + 1) * block_words)
    pieces = taken.select("slot", "s", "start", "doc_id", "pass", (first - F.col("begin")).alias("from_word"), (last - first).alias("n_words"))
    return pieces, placed.drop("goal")


def taken_words(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` of each document: words the mix takes, repeats counted."""
    pieces, placed = mix(docs)
    sums = pieces.groupBy("s", "start").agg(F.sum("n_words").alias("n"))
    with_words = placed.where("size > 0").join(sums, ["s", "start"], "left")
    result = with_words.unionByName(placed.where("size = 0").withColumn("n", F.lit(None).cast("long")))
    return result.select("doc_id", "size", "source_size", "target", F.coalesce("n", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix has them: a row for each time a document is taken, its text cut to the words
    taken where a source's last block ends within it, ``n_chars`` following if there is such a column. Each row is
    a document of its own, whether its doc_id is null or repeats; those without words are in no piece and go.
    Columns of any name and type stay as they are. An empty table gives none."""
    digest, row, first, n, size = unused(docs, "mix_digest", "mix_row", "mix_first", "mix_n", "mix_size")
    numbered = docs.withColumn(digest, F.xxhash64(F.col("text").cast("string"))).withColumn(row, F.monotonically_increasing_id())
    numbered = written(numbered, "numbered")  # numbers hold from here on
    pieces, placed = mix(numbered, extra=(digest, row))
    spans = pieces.groupBy("s", "start", "pass").agg(F.min("from_word").alias(first), F.sum("n_words").alias(n))
    spans = spans.join(placed.where("size > 0").select("s", "start", row, F.col("size").alias(size)), ["s", "start"])
    joined = numbered.join(spans.select(row, first, n, size), row)
    cut = F.concat_ws("", F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.col(first).cast("int") + 1, F.col(n).cast("int")))
    joined = joined.withColumn("text", F.when(F.col(n) < F.col(size), cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.select(*[f"`{c}`" for c in docs.columns])
