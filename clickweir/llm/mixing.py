"""Mixing sources to target weights, in DataFrame operations only.

The words of every source, in the order of a hash of its documents, are packed into blocks
of a fixed length. An output shard is a fixed number of slots, each of which takes one
block. For every shard the numbers of slots that the sources get are a multinomial draw: each slot draws its source by
the targets. The last shards are not drawn but get what each source's total still lacks, so the totals are the
targets. The slots that a source got are
numbered through; the number modulo the source's blocks goes through a pseudorandom
permutation of the block numbers, another one in each epoch, and gives the block to take.

Running numbers are summed in two levels, over buckets and within them, so that no source
meets in one task; only one row per source and one per bucket are ordered together.

The planner takes what an explode returns for no larger than what it reads, so joins of slots, blocks and texts ask
for a merge; else a few MB of draws would be broadcast as all their slots.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickweir.session import stored

WEIGHTS = (5, 2, 1)      # by the sources' order, repeating
MOST_EPOCHS = 3          # a source is taken so many times at most
BLOCK_WORDS = 32
SHARD_SLOTS = 4096
SHARD_GROUP = 256        # shards whose draws are summed together
CELLS = 4096             # of the unit interval, by which a draw finds its source
CORRECTED = 8            # shards that even out the draws hold so many times the root of all slots
BUCKET_ROWS = 2048       # documents that are ordered together
ROUNDS = 12              # of the block permutation
TASK_SLOTS = 100_000     # slots that a task maps to blocks
SEED = 20240501
WORD = r"[^\x20\x09-\x0D]+"
WORD_AND_SPACE = rf"((?:\A[\x20\x09-\x0D]+)?{WORD}[\x20\x09-\x0D]*)"     # as many as there are words


def _hash(*cols: Column) -> Column:
    return F.xxhash64(F.lit(SEED), *cols)


def _uniform(*cols: Column) -> Column:
    return F.shiftrightunsigned(_hash(*cols), 11) * F.lit(2.0 ** -53)


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """Where a pseudorandom permutation of 0..n-1 puts `index`: a swap-or-not shuffle, in
    which every round pairs x with k-x (mod n) and swaps the pair by a hashed bit."""
    def one_round(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(_hash(F.lit("key"), r, *key), n) - x, n)
        swap = _hash(F.lit("bit"), r, F.greatest(x, partner), *key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, one_round)


def word_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """doc_id, source, size in words and a hash that tells texts of one id apart."""
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64(text).alias("tie"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, weight, target: one row per source.

    With no target above `most_epochs` times its source, the targets are the smaller of
    that and a common level times the weight; the level makes their sum the total size.
    Taking sources by size over weight, a source is full if it is so with all before it full;
    the first that isn't gives the level, the largest of those computed like it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    cap = F.col("source_size") * float(most_epochs)
    every = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("weight"), "rank") \
        .rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    return (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("rank", F.row_number().over(by_name))
            .withColumn("weight", F.get(cycle, F.pmod(F.col("rank") - 1, F.lit(len(weights)))))
            .withColumn("level", level)
            .withColumn("level", F.when(cap >= F.col("weight") * F.col("level"), F.col("level")))
            .withColumn("level", F.max("level").over(every))
            .withColumn("target", F.least(cap, F.col("weight") * F.coalesce("level", F.lit(0.0))))
            .select("source", "source_size", "weight", "target", "rank"))


def placed(sizes: DataFrame, rows: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """`sizes` with `start`: the words of the source that come before the document."""
    bucket = F.pmod(_hash(F.col("doc_id"), F.col("tie")), F.lit(max(1, -(-rows // bucket_rows))))
    put = sizes.withColumn("bucket", bucket)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (put.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
              .select("source", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base")))
    within = Window.partitionBy("source", "bucket").orderBy("doc_id", "tie", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    inner = put.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    t = totals.select(F.col("source").alias("t_source"), F.col("bucket").alias("t_bucket"), "base")
    return (inner.join(t, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("bucket") == F.col("t_bucket")))
            .withColumn("start", F.col("base") + F.col("inner")).drop("t_source", "t_bucket", "base", "inner", "bucket"))


def drawn_slots(shares: DataFrame, all_slots: int, shard_slots: int = SHARD_SLOTS) -> tuple[DataFrame, int]:
    """(source, shard, draws): multinomial counts of every shard that is drawn, and how many such shards there are.

    `shares` has source, low and high, its part of the unit interval. Draws meet the sources by equal cells of the interval, so
    a source with many slots has as many cells, and no task gets all of it. Slots are a range, whose size the planner knows;
    slots exploded from shards would count as shards and be broadcast.
    """
    reserve = math.isqrt(all_slots) * CORRECTED
    n = max(0, (all_slots - reserve) // shard_slots)
    spark = shares.sparkSession
    tasks = 1 + all_slots // TASK_SLOTS
    u = (spark.range(0, n * shard_slots, 1, min(tasks, max(1, n)))
         .select(F.expr(f"id div {shard_slots}").alias("shard"), F.expr(f"id % {shard_slots}L").alias("i"))
         .withColumn("u", _uniform(F.col("shard"), F.col("i")))
         .select("shard", "u", F.floor(F.col("u") * CELLS).alias("cell")))
    cells = shares.filter("high > low").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1).cast("bigint")))))
    return (u.join(cells, "cell").filter((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
            .groupBy("source", "shard").agg(F.count("*").alias("draws"))), n


def slots(targets: DataFrame, words: int, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
          most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, shard, slot, epoch, block: the block of its source that each slot takes.

    `words` is the total size; it sets into how many tasks the slots are dealt.
    """
    every = Window.partitionBy(F.lit(0))
    upto = Window.partitionBy(F.lit(0)).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    s = stored(targets.filter("source_size > 0").withColumn("blocks", blocks)
               .withColumn("share", F.col("target") * F.col("blocks") / F.col("source_size"))
               .withColumn("wanted", F.round("share").cast("bigint"))
               .withColumn("high", F.when(F.col("rank") == F.max("rank").over(every), F.lit(1.0))
                           .otherwise(F.least(F.lit(1.0), F.sum("share").over(upto) / F.sum("share").over(every))))
               .withColumn("low", F.coalesce(F.lag("high").over(Window.partitionBy(F.lit(0)).orderBy("rank")), F.lit(0.0)))
               .select("source", "rank", "blocks", "wanted", "low", "high"), "mix-shares")
    all_slots = s.agg(F.coalesce(F.sum("wanted"), F.lit(0))).first()[0]
    counts, n_drawn = drawn_slots(s.select("source", "low", "high"), all_slots, shard_slots)
    counts = stored(counts, "mix-draws")
    had = counts.groupBy(F.col("source").alias("h_source")).agg(F.sum("draws").alias("had"))
    n_last = max(1, -(-all_slots // shard_slots) - n_drawn)
    # what a source lacks, evenly over the last shards
    lacks = s.join(had, F.col("source").eqNullSafe(F.col("h_source")), "left") \
        .withColumn("lack", F.greatest(F.col("wanted") - F.coalesce("had", F.lit(0)), F.lit(0)))
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_last - 1).cast("bigint")))
    last = (lacks.filter("lack > 0").select("source", "lack", part.alias("k"))
            .select("source", (F.col("k") + F.lit(n_drawn)).alias("shard"),
                    F.expr(f"(lack * (k + 1)) div {n_last} - (lack * k) div {n_last}").alias("draws")).filter("draws > 0"))
    of = s.select(F.col("source").alias("o_source"), "rank", "blocks")
    before = Window.partitionBy("shard").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    draws = (counts.unionByName(last).join(of, F.col("source").eqNullSafe(F.col("o_source")))
             .withColumn("shard_group", F.expr(f"shard div {SHARD_GROUP}"))
             .withColumn("first_slot", F.coalesce(F.sum("draws").over(before), F.lit(0)))
             .select("source", "blocks", "shard_group", "shard", "first_slot", "draws"))
    earlier = Window.partitionBy("source").orderBy("shard_group").rowsBetween(Window.unboundedPreceding, -1)
    bases = (draws.groupBy("source", "shard_group").agg(F.sum("draws").alias("of_group"))
             .withColumn("base", F.coalesce(F.sum("of_group").over(earlier), F.lit(0)))
             .select(F.col("source").alias("b_source"), F.col("shard_group").alias("b_group"), "base"))
    in_group = Window.partitionBy("source", "shard_group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = (draws.withColumn("inner", F.coalesce(F.sum("draws").over(in_group), F.lit(0)))
                .join(bases, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("shard_group") == F.col("b_group")))
                .repartition(1 + words // (block_words * TASK_SLOTS), "source", "shard")
                .select("source", "blocks", "shard", "first_slot", (F.col("base") + F.col("inner")).alias("before"),
                        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("draws") - 1)).alias("i")))
    number = F.col("before") + F.col("i")
    epoch = F.floor(number / F.col("blocks")).cast("bigint")
    return (numbered.withColumn("epoch", epoch).filter(F.col("epoch") < most_epochs)
            .withColumn("block", permuted(F.pmod(number, F.col("blocks")), F.col("blocks"), F.col("source"), F.col("epoch")))
            .select("source", "shard", (F.col("first_slot") + F.col("i")).alias("slot"), "epoch", "block"))


def segments(places: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for each part of a document that lies in one block: block, first_word, n_words."""
    end = F.col("start") + F.col("size")
    begin, stop = F.col("block") * block_words, (F.col("block") + 1) * block_words
    return (places.filter("size > 0")
            .withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"),
                                                      F.expr(f"(start + size - 1) div {block_words}"))))
            .withColumn("first_word", F.greatest(begin, F.col("start")) - F.col("start"))
            .withColumn("n_words", F.least(stop, end) - F.greatest(begin, F.col("start"))))


def _plan(docs: DataFrame, weights, block_words, shard_slots, most_epochs, id_col, text_col, source_col):
    sizes = stored(word_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    targets = stored(source_targets(sizes, weights, most_epochs), "mix-targets")
    places = stored(placed(sizes, sizes.count()), "mix-places")
    words = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    return targets, places, slots(targets, words, block_words, shard_slots, most_epochs)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS, most_epochs: int = MOST_EPOCHS, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken: words the mix takes of each row.

    Null or empty texts have size 0 and nothing is taken. A null source is a source of its own, the
    last in order; null ids and repeated rows are rows like others. Long texts lie in many
    blocks. An empty table gives no rows. Columns besides id, text and source are not read.
    Draws depend on the rows alone, so reruns agree.
    """
    targets, places, taken_slots = _plan(docs, weights, block_words, shard_slots, most_epochs,
                                         id_col, text_col, source_col)
    times = (taken_slots.groupBy("source", "block").agg(F.count("*").alias("times"))
             .select(F.col("source").alias("t_source"), F.col("block").alias("t_block"), "times").hint("merge"))
    took = (segments(places, block_words)
            .join(times, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("block") == F.col("t_block")))
            .groupBy("source", "start", "doc_id").agg(F.sum(F.col("n_words") * F.col("times")).alias("words"))
            .select(F.col("source").alias("w_source"), F.col("start").alias("w_start"),
                    F.col("doc_id").alias("w_id"), "words"))
    t = targets.select(F.col("source").alias("s_source"), "source_size", "target")
    return (places.join(took, F.col("source").eqNullSafe(F.col("w_source")) & (F.col("start") == F.col("w_start"))
                        & F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("size") > 0), "left")
            .join(t, F.col("source").eqNullSafe(F.col("s_source")))
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("words", F.lit(0)).cast("bigint").alias("taken")))


def mixed_texts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS,
                shard_slots: int = SHARD_SLOTS, most_epochs: int = MOST_EPOCHS, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: doc_id, epoch, text, source and the other columns of `docs`; the text is what the mix
    takes of a row in an epoch, its words in order with the white space that follows them; the first word has
    what stands before it too, so a row taken whole keeps all bytes. Where words are left out between two
    parts there is a line end more. Rows of which nothing is taken
    are left out; others come once per epoch that takes something. Edge cases as for `mix`.
    """
    _, places, taken_slots = _plan(docs, weights, block_words, shard_slots, most_epochs, id_col, text_col, source_col)
    rest = [c for c in docs.columns if c not in (id_col, text_col, source_col)]
    key = [F.xxhash64("doc_id", "source", "tie").alias("key 1"), F.xxhash64("tie", F.lit(SEED), "source", "doc_id").alias("key 2")]
    s = taken_slots.select(F.col("source").alias("t_source"), F.col("block").alias("t_block"), "epoch").hint("merge")
    took = (segments(places, block_words)
            .join(s, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("block") == F.col("t_block")))
            .groupBy(*key, "start", "epoch").agg(F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("parts"))
            .groupBy("`key 1`", "`key 2`", "start").agg(F.collect_list(F.struct("epoch", "parts")).alias("epochs"))
            .groupBy("`key 1`", "`key 2`").agg(F.sort_array(F.collect_list(F.struct("start", "epochs"))).alias("copies"))
            .select(F.col("`key 1`").alias("k1"), F.col("`key 2`").alias("k2"), "copies").hint("merge"))
    text = F.col(text_col).cast("string")
    rows = (docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.col(source_col).alias("source"),
                        *[F.col(c).alias(f"rest {c}") for c in rest], F.xxhash64(text).alias("tie"))
            .select("*", *key)
            .withColumn("copy", F.row_number().over(Window.partitionBy("key 1", "key 2").orderBy(F.lit(0)))))
    words = F.regexp_extract_all("text", F.lit(WORD_AND_SPACE), F.lit(1))

    def taken_part(p: Column, i: Column) -> Column:
        before = F.get(F.col("taken.parts"), i - 1)
        gap = F.when(before.first_word + before.n_words < p.first_word, F.lit("\n")).otherwise(F.lit(""))
        return F.concat(gap, F.array_join(F.slice(F.col("words"), (p.first_word + 1).cast("int"), p.n_words.cast("int")), ""))

    part = F.array_join(F.transform("taken.parts", taken_part), "")
    return (rows.join(took, (F.col("key 1") == F.col("k1")) & (F.col("key 2") == F.col("k2")))
            .withColumn("epochs", F.get(F.col("copies.epochs"), F.col("copy") - 1)).filter(F.col("epochs").isNotNull())
            .withColumn("words", words).withColumn("taken", F.explode("epochs"))
            .select("doc_id", F.col("taken.epoch").alias("epoch"), part.alias("text"), "source",
                    *[F.col(f"`rest {c}`").alias(c) for c in rest]))
