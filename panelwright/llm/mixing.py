"""Mix sources to target weights along a low-discrepancy schedule.

Every source is laid end to end in a shuffled order and cut into blocks of
equal words. Slot i of the schedule has the golden-ratio point i * G mod M;
cumulative weights of the sources turn the point into a source. The k-th slot
of a source takes its block k mod n, so blocks repeat only after all were
taken. Any stretch of the schedule is close to the wanted mix.

Only DataFrame functions are used. Sources may be of any number and one may
hold a large share of all rows: ranks and running totals go through slices
(``operators.running``), joins are on (source, block) keys of bounded size.

Rules: a null text has no words; a null source is a source of its own, last in
order; rows without words are never taken; repeated rows count and are taken
on their own, in an order that depends on id and text only. An empty table, or
one without words, gives targets of zero. Column names other than those asked
for do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import WORD, fresh
from panelwright.operators.running import ranks, running_totals
from panelwright.session import materialize

POINTS = 1 << 31
GOLDEN = 1327217885  # POINTS divided by the golden ratio, odd: all points differ for POINTS slots
UNITS = 1 << 16  # parts of a slot in cumulative weights, which are whole numbers


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("bigint")


def sized_rows(docs: DataFrame, seed: str, doc_id="doc_id", text="text", source="source", extra: dict | None = None):
    """doc_id, source, size and a shuffled order of every row, written once."""
    as_text = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        word_count(text).alias("size"),
        F.md5(F.concat(F.lit(seed), as_text)).alias("shuffle"),
        F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("tie"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )
    return materialize(rows, "mix-rows")


def source_targets(
    rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, block_words: int = 1024, source_slots: int = 512
) -> DataFrame:
    """Per source: src (rank), source, source_size, weight, target, block, n_blocks, units.

    A target is the source's share by weight of all words, at most ``most``
    times its size; the excess goes to the others by weight. With the sources
    in order of cap / weight, those that reach their cap come first, so running
    totals give the level at which the rest is filled.

    A block has ``block_words`` words, or fewer so that a source has at least
    ``source_slots`` slots.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("no_source", F.col("source").isNull())
    ranked = ranks(sources, [("no_source", False), ("source", False)], name="src")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = (
        ranked.withColumn("weight", F.element_at(cycle, ((F.col("src") - 1) % len(weights) + 1).cast("int")).cast("bigint"))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    filled = materialize(
        running_totals(ranked, [("ratio", False), ("src", False)], {"caps": "cap", "weights": "weight"}), "mix-sources"
    )
    total = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    words, all_weights = total.words or 0, total.weights or 0
    # Capped: the level at which this source is full needs no more words than there are.
    full = F.col("caps") + F.col("ratio") * (F.lit(all_weights) - F.col("weights")) <= F.lit(words)
    capped = filled.where(full).agg(F.max("caps").alias("caps"), F.max("weights").alias("weights")).first()
    left, open_weights = words - (capped.caps or 0), all_weights - (capped.weights or 0)
    level = float(left) / float(open_weights) if open_weights else 0.0
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("target") / source_slots))).cast("bigint")
    return (
        filled.withColumn("target", F.when(full, F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("weight")))
        .withColumn("block", block)
        .withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block")).cast("bigint"))
        .withColumn(
            "units",
            F.when(
                F.col("source_size") > 0,
                F.ceil(F.col("target") * F.col("n_blocks") / F.col("source_size") * UNITS).cast("bigint"),
            ).otherwise(F.lit(0).cast("bigint")),
        )
        .select("src", "source", "source_size", "weight", "target", "block", "n_blocks", "units")
    )


def slot_schedule(sources: DataFrame, most: int = 3) -> DataFrame:
    """slot, src, block_no, pass: which block each slot of the mix takes."""
    spark = sources.sparkSession
    placed = materialize(running_totals(sources.where("units > 0"), [("src", False)], {"upto": "units"}), "mix-bounds")
    whole = placed.agg(F.sum("units").alias("units"), F.count("*").alias("n")).first()
    units = whole.units or 0
    slots = spark.range(0, round(units / UNITS)).withColumnRenamed("id", "slot")
    point = F.col("slot") % POINTS * GOLDEN % POINTS
    slots = slots.withColumn("at", F.floor(point / POINTS * units).cast("bigint"))
    # Equal cells of the cumulative weights make the lookup an equality join.
    width = max(1, -(-units // (256 + 16 * whole.n)))
    cells = placed.select(
        "src", "n_blocks", (F.col("upto") - F.col("units")).alias("low"), F.col("upto").alias("high"),
    ).withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
    )
    slots = slots.withColumn("cell", F.floor(F.col("at") / width))
    found = slots.join(cells, "cell").where("at >= low AND at < high").select("slot", "src", "n_blocks")
    ranked = ranks(found, [("slot", False)], ("src",), "k").withColumn("k", F.col("k") - 1)
    return ranked.where(F.col("k") < F.col("n_blocks") * most).select(
        "slot", "src", (F.col("k") % F.col("n_blocks")).alias("block_no"),
        F.floor(F.col("k") / F.col("n_blocks")).alias("pass"),
    )


def block_pieces(rows: DataFrame, sources: DataFrame, carry: list[str]) -> DataFrame:
    """Words [first, last) of the rows in each block: src, block_no, offset, first, last.

    ``offset`` is where the row begins in its source; with ``src`` it names a row
    that has words. A row has one piece per block that it reaches into.
    """
    known = rows.where("size > 0").join(
        sources.select("source", "src", "block"), rows["source"].eqNullSafe(sources["source"])
    ).drop(sources["source"])
    laid = running_totals(
        known, [("shuffle", False), ("doc_id", False), ("tie", False)], {"upto": "size"}, ("src",)
    ).withColumn("offset", F.col("upto") - F.col("size"))
    numbers = F.sequence(F.floor(F.col("offset") / F.col("block")), F.floor((F.col("upto") - 1) / F.col("block")))
    pieces = laid.withColumn("block_no", F.explode(numbers))
    start = F.col("block_no") * F.col("block")
    return pieces.select(
        "src", "block_no", "doc_id", "size", "offset", *carry,
        F.greatest(start - F.col("offset"), F.lit(0)).alias("first"),
        F.least(start + F.col("block") - F.col("offset"), F.col("size")).alias("last"),
    )


def mix(
    docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = (1, 2, 3), most: int = 3,
    doc_id="doc_id", text="text", source="source", extra: dict | None = None,
) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken (words, repeats counted)."""
    carry = list(extra or {})
    rows = sized_rows(docs, seed, doc_id, text, source, extra)
    sources = materialize(source_targets(rows, weights, most), "mix-targets")
    takes = slot_schedule(sources, most).groupBy("src", "block_no").agg(F.count("*").alias("takes"))
    pieces = block_pieces(rows, sources, carry)
    taken = (
        pieces.join(takes, ["src", "block_no"], "left")
        .groupBy("src", "offset", "doc_id", "size", *carry)
        .agg(F.sum((F.col("last") - F.col("first")) * F.coalesce("takes", F.lit(0))).cast("bigint").alias("taken"))
        .drop("offset")
    )
    sized = taken.join(sources.select("src", "source", "source_size", "target"), "src")
    order = ["doc_id", "source", "size", "source_size", "target", "taken", *carry]
    empty = (
        rows.where("size = 0")
        .join(sources.select("source", "source_size", "target").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("taken", F.lit(0).cast("bigint"))
    )
    return sized.select(*order).unionByName(empty.select(*order))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns.

    A source ends inside a document at most once; that document's share is
    rounded to whole copies, half up.
    """
    key = fresh(docs, "row_no")
    numbered = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "mix-documents")
    taken = mix(numbered, extra={"row_no_": F.col(key)}, **options)
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    times = fresh(docs, "copy_no")
    found = taken.where("taken > 0").select(F.col("row_no_").alias(key), F.sequence(F.lit(1), copies).alias(times), copies.alias("n_")).where("n_ > 0")
    return (
        numbered.join(found.select(key, times), key)
        .withColumn(times, F.explode(times))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
