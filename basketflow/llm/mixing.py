"""Mixing of sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled (ordered by a hash) into one stream of words and cut into blocks
of equal length; a source that is to give more words than it has is read again from its start. The
slots of the mix are numbered 0 … N - 1. Van der Corput points, the slot numbers with their bits
reversed, map a slot to a source through the cumulative numbers of blocks, so that any stretch of
slots holds each source in about its share. The slots of a source are ranked; the r-th takes its r-th
block. As every point is used once, each source gets exactly the blocks of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.llm.common import heavy_hash, table
from basketflow.operators.ordering import with_row_index
from basketflow.session import materialize

# Fixed values of the mix: source weights, repeating, and how often a source may be read.
WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK_WORDS = 1024

# A source's documents are dealt to so many stretches of the hash order, its slots to stretches of so
# many positions: no window holds more than a stretch.
_STRETCH_BITS = 14
_SLOT_BITS = 16


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running_total(rows: DataFrame, group: list[str], stretch: Column, order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows before each row of its group, without a window over a group.

    ``stretch`` numbers consecutive parts of the order. Parts are summed before the shuffle; windows
    run over the sums of a group's parts and over the rows of one part.
    """
    cut = rows.withColumn("_stretch", stretch)
    parts = cut.groupBy(*group, "_stretch").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*group, "_stretch", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = cut.join(parts, [*group, "_stretch"])
    return joined.withColumn(name, F.col("_before") + F.col("_inside")).drop("_stretch", "_before", "_inside")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES
) -> DataFrame:
    """(number, source, source_size, target) of each source; a missing source is one, too.

    Sources are numbered by code point, the missing one last, and weighed by turns. Together they get
    all words; a target stops at ``max_passes`` times the source's size, and what it leaves is shared
    by the others by weight, until no target is above its stop. The level (words per weight) rises
    with each round; rounds are sums over the table of sources.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = with_row_index(sources, [F.col("source").asc_nulls_last()], "number", 0)
    turn = F.array(*[F.lit(w) for w in weights])[F.pmod("number", F.lit(len(weights))).cast("int")]
    rows = materialize(numbered.withColumn("weight", turn), "sources")
    stop = F.col("source_size") * max_passes
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = stop < F.lit(level) * F.col("weight")
        n, stopped, weight = rows.agg(
            F.count(F.when(above, 1)),
            F.sum(F.when(above, stop)),
            F.sum(F.when(~above, F.col("weight"))),
        ).first()
        if n == capped or not weight:
            break
        level, capped = (total - (stopped or 0)) / weight, n
    target = F.least(stop.cast("double"), F.lit(level) * F.col("weight"))
    return materialize(rows.select("number", "source", "source_size", target.alias("target")), "targets")


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(position, number, block): the slots of the mix in order of position and the block each takes."""
    blocks = targets.select("number", F.ceil(F.round("target") / block_words).cast("long").alias("blocks"))
    placed = materialize(
        running_total(blocks, [], F.floor(F.col("number") / (1 << _STRETCH_BITS)), ["number"], "blocks", "first"), "blocks"
    )
    total = placed.agg(F.sum("blocks")).first()[0] or 0
    bits = max(1, (total - 1).bit_length())
    some = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1, F.lit(1 << _SLOT_BITS).cast("long"))
    runs = placed.filter("blocks > 0").select("number", "first", "blocks", F.explode(some).alias("start"))
    last = F.least(F.col("blocks"), F.col("start") + (1 << _SLOT_BITS)) - 1
    # Bit reversal undoes itself: the points of a source are the reversals of its positions.
    point = F.explode(F.sequence(F.col("first") + F.col("start"), F.col("first") + last)).alias("point")
    points = runs.repartition("number", "start").select("number", point)
    reverse = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    slots = points.select("number", reverse.alias("position"), F.lit(1).alias("one"))
    stretch = F.shiftright("position", _SLOT_BITS)
    ranked = running_total(slots, ["number"], stretch, ["position"], "one", "block")
    return ranked.select("position", "number", "block")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their sizes and targets, and the mix itself.

    First table: (row, doc_id, source, size, source_size, target), one row per document. Second: one
    row (position, row, from_word, to_word) per stretch of a document's words in a slot; a slot's
    stretches in the order of the source's stream make its block. Rounded targets are met to the
    word, and a document is taken at most as often as its source is read.

    A missing text or one of white space has no words and is never taken. A missing source is a
    source of its own. Repeated rows are documents of their own, in the same place on every run: the
    order is by a hash of id, source and text. Empty tables give empty results.
    """
    own_id, own_text, own_source = (F.col(f"`{c}`") for c in (doc_id, text, source))
    mark = heavy_hash(own_id.cast("string"), own_source.cast("string"), own_text)
    sized = docs.select(
        own_id.alias("doc_id"), own_source.alias("source"), word_count(text).alias("size"), mark.alias("mark")
    ).withColumn("row", F.monotonically_increasing_id())
    sized = materialize(sized, "sized")
    targets = source_targets(sized)
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    named = sized.alias("s").join(targets.alias("t"), same).select("s.*", "t.number", "t.source_size", "t.target")
    stretch = F.shiftright("mark", 62 - _STRETCH_BITS)
    placed = running_total(named, ["number"], stretch, ["mark", "size", "row"], "size", "start")
    placed = materialize(placed.drop("mark"), "placed")
    # Each pass through a source gives its documents another stretch of the endless stream.
    begin = F.col("start") + F.col("pass") * F.col("source_size")
    passes = placed.filter("size > 0").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(MAX_PASSES - 1))).alias("pass")
    )
    cut = passes.select("row", "number", begin.alias("begin"), "size", F.round("target").cast("long").alias("end"))
    cut = cut.withColumn("until", F.least(F.col("begin") + F.col("size"), F.col("end"))).filter("begin < until")
    block = F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("until") - 1) / block_words))
    pieces = cut.select("row", "number", "begin", "until", F.explode(block).alias("block"))
    first = F.greatest("begin", F.col("block") * block_words) - F.col("begin")
    stop = F.least("until", (F.col("block") + 1) * block_words) - F.col("begin")
    pieces = pieces.select("row", "number", "block", first.alias("from_word"), stop.alias("to_word"))
    mixed = schedule(targets, block_words).join(pieces, ["number", "block"])
    return placed.drop("start", "number"), mixed.select("position", "row", "from_word", "to_word")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of each document: the words the mix takes."""
    placed, mixed = mix(docs, **options)
    taken = mixed.groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    out = placed.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents")).drop("source")
