"""Operator 10, mixing sources to target weights: hash order, prefix sums, one cut per source.

Native DataFrame code. Each row gets a hash-random key. A source's rows are ranged by the key into
buckets; bucket sums give the prefix at every range, and only the bucket in which a source's budget
ends is sorted to find the cut row. All other rows compare their key with the cut, so no text and
no full source is ever shuffled or windowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SEPARATORS, Scratch, word_count

KEY_BITS = 60


def hash_key(col: Column) -> Column:
    """A stable 60-bit key of a value (md5, so that other engines can repeat it); null hashes as ''."""
    return F.conv(F.substring(F.md5(F.coalesce(col.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(per_source: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Water filling: ``share`` of all sizes split by weight; a source stops at ``cap`` times its size.

    Sources in code-point order (null last) take the weights in turn. ``per_source`` has one row per
    source (source, source_size); sorting them needs one task, which holds sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = per_source.withColumn("w", w).withColumn("ceiling", F.col("source_size") * F.lit(float(cap)))
    ranked = ranked.withColumn("ratio", F.col("ceiling") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("ceiling").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left_w = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    ranked = ranked.withColumn("total", total).withColumn("capped", (total - before) >= F.col("ratio") * left_w)
    level = ((F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("ceiling"))).over(whole), F.lit(0.0)))
             / F.sum(F.when(~F.col("capped"), F.col("w"))).over(whole))
    return ranked.withColumn("target", F.when(F.col("capped"), F.col("ceiling")).otherwise(F.col("w") * level)).select(
        "source", "source_size", "target")


def plan(sized: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """One row per source: target, whole epochs, and the cut (key, id, size, words left) of the last epoch.

    ``sized`` (source, doc, size, key) is read several times and so should be a written table.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    t = targets(per_source.select("source", "source_size"), weights, share, cap)
    t = t.join(per_source.select(F.col("source").alias("s2"), "n"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    bits = F.ceil(F.log2(F.col("n").cast("double")) / 2).cast("int")  # about sqrt(n) ranges of sqrt(n) rows
    t = (t.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
         .withColumn("range_bits", bits))
    # prefix sums over key ranges; the range that holds the cut
    src = t.select(F.col("source").alias("s"), "range_bits", "rest")
    rows = sized.join(src, F.col("source").eqNullSafe(F.col("s")), "inner").drop("s").withColumn(
        "range", F.expr(f"shiftright(key, {KEY_BITS} - range_bits)"))
    sums = rows.where("rest > 0").groupBy("source", "rest", "range").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("range"))
    at = (sums.withColumn("upto", upto).where("upto >= rest and upto - words < rest")
          .select(F.col("source").alias("s"), F.col("range").alias("r"), (F.col("upto") - F.col("words")).alias("base")))
    # inside that range: equal rows count once, then a running sum in key order
    inside = (rows.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
              .groupBy("source", "rest", "base", "key", "doc", "size").agg(F.count(F.lit(1)).alias("m")))
    run = F.col("base") + F.sum(F.col("size") * F.col("m")).over(Window.partitionBy("source").orderBy("key", "doc", "size"))
    cut = (inside.withColumn("run", run).withColumn("need", F.col("rest") - F.col("run") + F.col("size") * F.col("m"))
           .where("run >= rest and need > 0 and size > 0")
           .select(F.col("source").alias("s"), F.struct("key", "doc", "size").alias("cut"),
                   F.floor(F.col("need") / F.col("m")).cast("long").alias("cut_words")))
    return t.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "epochs", "cut", "cut_words")


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, cap: float = 2.0,
        keep: bool = False) -> DataFrame:
    """Words that a weighted mix takes from every document.

    Returns (doc_id, size, source_size, target, taken) or, with ``keep``, the input's own columns plus
    ``mix_epochs`` (whole repeats) and ``mix_words`` (words of the last, partial epoch).
    A source takes whole epochs of its size, then documents in hash order until its budget
    (target, rounded) is used; the cut document gives only its first words.

    Null text has size 0; a null source is a source of its own, last in order; a null id hashes as ''.
    Repeated rows share one key; where the cut falls on them each gives an equal part, rounded down.
    A source without words takes nothing. An empty table gives an empty result. Extra columns play no
    part. The order of rows, partitions and lost executors do not change the result.
    """
    scratch = Scratch(df.sparkSession, "mix")
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    sized = scratch.table(
        df.select(F.col(source_col).alias("source"), ident.alias("doc"), word_count(F.col(text_col)).alias("size"),
                  hash_key(F.col(id_col)).alias("key"), F.col(id_col).alias("id")), "sized")
    p = scratch.table(plan(sized, weights, share, cap), "plan")
    p = p.withColumnsRenamed({c: f"__mix_{c}" for c in p.columns})
    if keep:
        rows = df.withColumn("__size", word_count(F.col(text_col)))
        spot = F.struct(hash_key(F.col(id_col)).alias("key"), ident.alias("doc"), F.col("__size").alias("size"))
        src = F.col(source_col)
    else:
        rows = sized.withColumnRenamed("size", "__size")
        spot = F.struct("key", "doc", F.col("__size").alias("size"))
        src = F.col("source")
    cut = F.col("__mix_cut")
    part = (F.when(cut.isNull(), 0).when(spot < cut, F.col("__size")).when(spot == cut, F.col("__mix_cut_words"))
            .otherwise(0).cast("long"))
    out = rows.join(p, src.eqNullSafe(F.col("__mix_source")), "left").withColumn("mix_words", part).withColumn(
        "mix_epochs", F.col("__mix_epochs"))
    if keep:
        return out.select(*df.columns, "mix_epochs", "mix_words", F.col("__size").alias("mix_size"))
    return out.select(
        F.col("id").alias(id_col), F.col("__size").alias("size"), F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (F.col("mix_epochs") * F.col("__size") + F.col("mix_words")).alias("taken"))


def materialise(df: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The mixed table itself: one row per epoch a document is taken in, the last one cut to its words.

    Documents of which the mix takes nothing go; all columns of the input stay. ``n_chars``, where
    present, follows the text.
    """
    mixed = mix(df, text_col=text_col, keep=True, **kw)
    chunks = F.split(F.regexp_replace(F.col(text_col), f"^{SEPARATORS}", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    first_words = F.regexp_replace(F.concat_ws("", F.slice(chunks, 1, F.col("mix_words").cast("int"))), f"{SEPARATORS}$", "")
    copies = F.col("mix_epochs").cast("int") + F.when(F.col("mix_words") > 0, 1).otherwise(0)
    out = mixed.where((copies > 0) & (F.col("mix_size") > 0)).withColumn("__copy", F.explode(F.sequence(F.lit(1), copies)))
    partial = (F.col("__copy") > F.col("mix_epochs")) & (F.col("mix_words") < F.col("mix_size"))
    out = out.withColumn(text_col, F.when(partial, first_words).otherwise(F.col(text_col)))
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.when(partial, F.length(text_col).cast("long")).otherwise(F.col("n_chars")))
    return out.select(*df.columns)
