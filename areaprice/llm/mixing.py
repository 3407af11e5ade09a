"""Mixing sources to target weights: blocks of equal size, apportioned by highest quotients (Sainte-Laguë)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .rows import computed_once, id_text, ranked, row_key, whole_row, whole_text, words

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 20
SEED = "mix"

CELL = ("place", "shard")


def text_size(text_column: str = "text") -> Column:
    """Number of words of a text, none of a null one."""
    return F.size(words(whole_text(text_column))).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], total_share: float, most: int) -> DataFrame:
    """``source, place, source_size, target`` from one row of ``source, source_size`` per source.

    Sources weigh ``weights`` in turn, in code-point order, a null source last. They share ``total_share`` of all
    words by weight; a target stops at ``most`` times its source's size, and what is left is shared by weight
    among the others until none is above. Each round gathers two sums, not the sources.
    """
    table = ranked(sizes, [F.col("source").isNull(), F.col("source")], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = stored(table.withColumn("weight", weight.cast("long")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    rate, before = 0.0, None
    while True:
        capped = F.lit(rate) * F.col("weight") > most * F.col("source_size")
        size, weight = table.agg(
            F.sum(F.when(capped, F.col("source_size"))), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        state = size or 0, weight or 0
        if state == before or not state[1]:
            break
        rate, before = (total_share * total - most * state[0]) / state[1], state
    target = F.when(capped, (most * F.col("source_size")).cast("double")).otherwise(F.lit(rate) * F.col("weight"))
    return table.select("source", "place", "source_size", target.alias("target"))


def block_quotas(cells: DataFrame, n_blocks: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Apportion ``n_blocks`` to cells, the shards of the sources, by highest quotients: adds ``blocks``.

    ``cells`` has ``place, shard`` and ``wanted``, the cell's words in its source's target. A block goes to the
    cell of the highest ``wanted / (2 * blocks + 1)``, one after the other; quotients that tie go in order of
    seat, place and shard. Rounding ``wanted`` to blocks gives that sequence up to some quotient, so it starts
    from there: missing blocks are awarded by the next quotients, surplus ones are taken back from the last.
    Either concerns a few seats per cell, as many as its share of all ``wanted`` calls for, and these are ranked.
    """
    table = stored(cells.withColumn("rounded", F.floor(F.col("wanted") / block_words + 0.5).cast("long")))
    n_cells, rounded, wanted = table.agg(F.count(F.lit(1)), F.sum("rounded"), F.sum("wanted")).first()
    missing = n_blocks - (rounded or 0)
    if not n_cells or not missing:
        return table.withColumnRenamed("rounded", "blocks")
    seats = F.ceil(F.col("wanted") / wanted * (abs(missing) + n_cells)).cast("long") + 1
    if missing > 0:
        numbers, direction = F.sequence(F.col("rounded") + 1, F.col("rounded") + seats), F.asc
    else:
        lowest = F.greatest(F.col("rounded") - seats, F.lit(1))
        numbers, direction = F.when(F.col("rounded") > 0, F.sequence(lowest, F.col("rounded"))), F.desc
    offered = table.select(*CELL, "wanted", F.explode(numbers).alias("seat"))
    offered = offered.withColumn("quotient", -F.col("wanted") / (2 * F.col("seat") - 1))
    # Taking back goes through the same sequence from its end.
    changed = ranked(offered, [direction(name) for name in ("quotient", "seat", *CELL)], "turn").where(F.col("turn") < abs(missing))
    changed = changed.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))
    blocks = F.col("rounded") + F.coalesce("n", F.lit(0)) * (1 if missing > 0 else -1)
    return table.join(changed, list(CELL), "left").withColumn("blocks", blocks).drop("n", "rounded")


def _chosen_blocks(cells: DataFrame, block_words: int, seed: str) -> DataFrame:
    """``place, shard, block, take``: words that the rest of a cell's quota takes from its blocks in seeded order."""
    last = F.floor((F.col("words") - 1) / block_words).cast("long")
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), last))
    # Spread first: a few cells make many blocks.
    cells = cells.where("rest > 0").repartition(*CELL)
    blocks = cells.select(*CELL, "words", "rest", numbers.alias("block"))
    blocks = blocks.withColumns(
        {
            "size": F.least(F.lit(block_words).cast("long"), F.col("words") - F.col("block") * block_words),
            "seeded": F.md5(F.concat_ws(":", F.lit(seed), *CELL, "block")),
        }
    )
    in_order = Window.partitionBy(*CELL).orderBy("seeded", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(in_order), F.lit(0))
    blocks = blocks.withColumn("take", F.least(F.col("size"), F.col("rest") - before))
    return blocks.where("take > 0").select(*CELL, "block", "take")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """How many words of each document a mix of its sources takes.

    Targets are those of :func:`source_targets`. Each source is dealt into shards of about ``shard_words`` words
    by a seeded hash of the ids, in which its documents follow each other in seeded order. Blocks of
    ``block_words`` words are apportioned to the shards (:func:`block_quotas`); a shard gives all its words as
    often as its quota holds them, then blocks in seeded order, the last as far as needed. So a source comes
    within half a block per shard of its target, no document exceeds ``most`` times its size, and reruns agree.

    Returns ``doc_id, text_hash, source, size, source_size, target, copies`` (whole times taken), ``parts`` (first
    word and number of words of each further range, in order) and ``taken``, all words together. A source that
    most rows have is spread over its shards; a document longer than a shard makes a longer shard.
    Null texts and texts without words have size 0 and nothing taken; null sources are one source, the last; rows
    that repeat are separate; an empty table gives no rows; other columns are ignored.
    """
    sized = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.xxhash64(whole_text(text_column)).alias("text_hash"),
            F.col(source_column).cast("string").alias("source"),
            text_size(text_column).alias("size"),
        )
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, total_share, most))
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    named = targets.withColumnRenamed("source", "named")
    known = sized.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named")

    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    n_shards = F.floor((F.col("source_size") - 1) / shard_words).cast("long") + 1
    number = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    dealt = known.where("size > 0").withColumn("order", order).withColumn("shard", number % n_shards)

    cells = dealt.groupBy(*CELL).agg(
        F.sum("size").alias("words"), F.max("target").alias("target"), F.max("source_size").alias("source_size")
    )
    wanted = F.col("target") * F.col("words") / F.col("source_size")
    cells = cells.select(*CELL, "words", wanted.alias("wanted"))
    quotas = block_quotas(cells, int(total_share * total / block_words + 0.5), block_words)
    quota = F.least(F.col("blocks") * block_words, most * F.col("words"))
    copies = F.floor(quota / F.col("words")).cast("long")
    quotas = stored(quotas.select(*CELL, "words", copies.alias("copies"), (quota - copies * F.col("words")).alias("rest")))

    in_order = Window.partitionBy(*CELL).orderBy("order", "text_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored(dealt.withColumn("start", F.coalesce(F.sum("size").over(in_order), F.lit(0))).drop("order"))
    end = F.col("start") + F.col("size")
    first, last = (F.floor(at / block_words).cast("long") for at in (F.col("start"), end - 1))
    pieces = placed.select(*CELL, "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    # As many blocks as the data has, though Spark sees them come from a small table.
    pieces = pieces.join(_chosen_blocks(quotas, block_words, seed).hint("merge"), [*CELL, "block"])
    at = F.col("block") * block_words
    from_ = F.greatest(F.col("start"), at)
    range_ = F.struct((from_ - F.col("start")).alias("first"), (F.least(end, at + F.col("take")) - from_).alias("n"))
    pieces = pieces.select(*CELL, "start", range_.alias("part")).where("part.n > 0")
    parts = pieces.groupBy(*CELL, "start").agg(
        F.array_sort(F.collect_list("part")).alias("parts"), F.sum("part.n").alias("partly")
    )
    columns = ["doc_id", "text_hash", "source", "size", "source_size", "target"]
    none, zero = F.array().cast("array<struct<first:bigint,n:bigint>>"), F.lit(0).cast("long")
    taken = placed.join(quotas.select(*CELL, "copies"), list(CELL)).join(parts, [*CELL, "start"], "left")
    taken = taken.select(
        *columns,
        "copies",
        F.coalesce("parts", none).alias("parts"),
        (F.col("copies") * F.col("size") + F.coalesce("partly", zero)).alias("taken"),
    )
    empty = known.where("size = 0").select(*columns, zero.alias("copies"), none.alias("parts"), zero.alias("taken"))
    return taken.unionByName(empty)


def mixed_rows(
    docs: DataFrame,
    mixed: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    computed: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """The documents as often and as far as :func:`mix` takes them, with the columns of ``docs``.

    Whole copies keep their text. What is taken beyond them is one more row, whose text has the taken words in
    order, separated by single spaces. ``computed`` gives columns anew from the text of a row. Rows that repeat
    both id and text are taken together.
    """
    decisions = mixed.where("taken > 0").select(key_of("doc_id", "text_hash"), "copies", "parts")
    # One row for each time that the same id and text occur.
    decisions = decisions.groupBy("key").agg(
        F.sum("copies").alias("copies"), F.flatten(F.collect_list("parts")).alias("parts")
    )
    text = whole_text(text_column)
    rows = docs.select(whole_row(docs), text.alias("text"), row_key(F.col(id_column), F.col(text_column)).alias("key"))
    rows = rows.join(decisions, "key").dropDuplicates(["key"])
    times = F.col("copies") + F.when(F.size("parts") > 0, 1).otherwise(0)
    rows = rows.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    partly = F.col("turn") > F.col("copies")
    rows = computed_once(rows, words=F.when(partly, words(F.col("text"))))
    ranges = F.transform(
        "parts", lambda part: F.slice(F.col("words"), part["first"].cast("int") + 1, part["n"].cast("int"))
    )
    rows = rows.withColumn("taken_text", F.when(partly, F.array_join(F.flatten(ranges), " ")).otherwise(F.col("text")))
    anew = {name: of(F.col("taken_text")) for name, of in (computed or {}).items()}
    anew[text_column] = F.col("taken_text")
    return rows.select([anew.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def key_of(doc_id: str, text_hash: str) -> Column:
    """The :func:`row_key` of a document whose text hash is known."""
    return F.concat_ws(":", id_text(F.col(doc_id)), F.hex(text_hash)).alias("key")
