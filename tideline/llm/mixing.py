"""Mixing sources to target weights (operator 7): Efraimidis-Spirakis sampling with DataFrame functions only.

Every document draws an exponential key divided by its quality weight. A source takes
complete epochs of all its words, then documents by rising key up to the rest of its
target; the document at the border gives the words that are still wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.words import SPACE

WEIGHTS = (5, 2, 1)  # by rank of the source, repeating
MOST_EPOCHS = 3
DOCS_PER_BUCKET = 1_000
MOST_BUCKETS = 100_000  # of one source; the documents of a source are spread over them evenly
_ADDED = ["size", "source_size", "target", "taken"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def plain_share(text: Column) -> Column:
    """Share of characters that are no digits and signs; 1 for empty texts, at least 0.05."""
    plain = F.length(F.translate(text, "0123456789#*$%&|<>!", "")) / F.length(text)
    return F.coalesce(F.greatest(F.when(F.length(text) > 0, plain), F.lit(0.05)), F.lit(1.0))


def measured(docs: DataFrame, quality: Column) -> DataFrame:
    """`docs` with _size, _key (lower is taken earlier) and _draw, and the source as two columns that are never null.

    The draw is a hash of doc_id and text, so reruns agree and documents without id differ.
    """
    digits = F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit("")))), 1, 13)
    draw = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return docs.withColumns(
        {
            "_size": word_count(F.col("text")),
            "_key": -F.log(draw) / quality,
            "_draw": digits,
            "_named": F.col("source").isNotNull(),
            "_source": F.coalesce("source", F.lit("")),
        }
    )


_BY_SOURCE = ["_named", "_source"]


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: words, documents, target. Sources rank by code point, null last.

    Shares above MOST_EPOCHS times the source's words stop there and the excess is reshared by
    weight: in order of words per weight, the first source whose share of what is left
    needs no stop sets the level for all after it. The windows order sources, not documents.
    """
    size = rows.groupBy(*_BY_SOURCE).agg(F.sum("_size").alias("source_size"), F.count("*").alias("_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("_named").desc(), F.col("_source").asc())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (rank % len(WEIGHTS)).cast("int") + 1)
    weighed = size.withColumn("_weight", weight).withColumn("_most", (F.col("source_size") * MOST_EPOCHS).cast("double"))
    everything = Window.partitionBy()
    order = [(F.col("_most") / F.col("_weight")).asc(), F.col("_named").desc(), F.col("_source").asc()]
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    level = left / F.sum("_weight").over(onward)
    leveled = weighed.withColumns({"_level": level, "_turn": F.row_number().over(Window.orderBy(*order))})
    fits = F.col("_level") * F.col("_weight") <= F.col("_most")
    first = F.min(F.when(fits, F.struct("_turn", "_level"))).over(everything)["_level"]
    target = F.least(F.coalesce(first * F.col("_weight"), F.col("_most")), F.col("_most"))
    return leveled.select(*_BY_SOURCE, "source_size", "_docs", target.alias("target"))


def _bucket() -> Column:
    """Place of the document's chance among its source's equal parts; it rises with the key."""
    return F.floor((1 - F.exp(-F.col("_key"))) * F.col("_buckets")).cast("long")


def plan(rows: DataFrame, scratch: str) -> DataFrame:
    """Targets, with complete epochs, words wanted beyond them, and the bucket where those end.

    What holds for a source is written below `scratch` first: its size is then known when the rows, of which one source may have a third, meet it.
    """
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST_EPOCHS))).otherwise(0).cast("long")
    source = (
        targets(rows)
        .withColumn("_epochs", epochs)
        .withColumn("_wanted", F.floor(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long"))
        .withColumn("_buckets", F.least(F.ceil(F.col("_docs") / DOCS_PER_BUCKET), F.lit(MOST_BUCKETS)))
    )
    source.write.parquet(f"{scratch}/sources")
    source = rows.sparkSession.read.parquet(f"{scratch}/sources")
    parts = rows.join(source, _BY_SOURCE).withColumn("_bucket", _bucket()).groupBy(*_BY_SOURCE, "_wanted", "_bucket").agg(F.sum("_size").alias("_words"))
    running = Window.partitionBy(*_BY_SOURCE).orderBy("_bucket")
    summed = parts.withColumn("_before", F.sum("_words").over(running) - F.col("_words"))
    border = (
        summed.where((F.col("_before") <= F.col("_wanted")) & (F.col("_wanted") < F.col("_before") + F.col("_words")))
        .groupBy(*_BY_SOURCE)
        .agg(F.min(F.struct("_bucket", "_before")).alias("_border"))
    )
    return source.join(border, _BY_SOURCE, "left").select(*source.columns, F.col("_border._bucket").alias("_last"), F.col("_border._before").alias("_before"))


def apply(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Measured rows with size, source_size, target and taken in place of the helper columns.

    Only documents of each source's border bucket are ordered.
    """
    keep = [c for c in rows.columns if c not in ("_size", "_key", "_draw", *_BY_SOURCE, *_ADDED)]
    placed = rows.join(planned, _BY_SOURCE).withColumn("_bucket", _bucket())
    whole = F.col("_epochs") * F.col("_size")
    at_border = F.coalesce(F.col("_bucket") == F.col("_last"), F.lit(False))

    def shown(df: DataFrame, extra: Column) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in keep], F.col("_size").alias("size"), "source_size", "target", (whole + extra).cast("long").alias("taken"))

    clear = placed.where(~at_border)
    taken = F.when((F.col("_wanted") > 0) & (F.col("_last").isNull() | (F.col("_bucket") < F.col("_last"))), F.col("_size")).otherwise(0)
    order = Window.partitionBy(*_BY_SOURCE, "_bucket").orderBy("_key", "_draw", F.col("doc_id").asc_nulls_last(), "_size")
    bordering = placed.where(at_border).withColumn("_left", F.col("_wanted") - F.col("_before") - F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_size"))
    return shown(clear, taken).unionByName(shown(bordering, F.greatest(F.least(F.col("_left"), F.col("_size")), F.lit(0))))


def _planned(rows: DataFrame, scratch: str) -> tuple[DataFrame, DataFrame]:
    """(measured rows without text, plan), both written below `scratch` and read again.

    The plan's size is then known, so that it is broadcast where it is small and joined by shuffle where it is not.
    """
    spark = rows.sparkSession
    rows.select("doc_id", *_BY_SOURCE, "_size", "_key", "_draw").write.parquet(f"{scratch}/sizes")
    slim = spark.read.parquet(f"{scratch}/sizes")
    plan(slim, scratch).write.parquet(f"{scratch}/plan")
    return slim, spark.read.parquet(f"{scratch}/plan")


def mix(docs: DataFrame, scratch: str, quality: Column | None = None) -> DataFrame:
    """All rows of `docs` (doc_id, text, source and whatever else) with size, source_size, target and taken.

    size is the number of words (null text: 0) and taken the words the mix takes, repeats
    counted, at most MOST_EPOCHS times the size. Columns of these four names are replaced.
    Null sources form one source, the last by rank. Sizes, keys and the plan go through `scratch`, a folder
    on shared storage.
    """
    rows = measured(docs, plain_share(F.col("text")) if quality is None else quality)
    return apply(rows, _planned(rows, scratch)[1])


def decisions(docs: DataFrame, scratch: str, quality: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken: as `mix`, with texts read once."""
    rows = measured(docs, plain_share(F.col("text")) if quality is None else quality)
    return apply(*_planned(rows, scratch))


def _sql() -> str:
    weights = ", ".join(f"{w}.0" for w in WEIGHTS)
    return f"""
WITH measured AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^{SPACE}]+')), 0)::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 13) AS draw,
    CASE WHEN coalesce(length(text), 0) = 0 THEN 1.0::DOUBLE
      ELSE greatest(length(translate(text, '0123456789#*$%&|<>!', ''))::DOUBLE / length(text)::DOUBLE, 0.05::DOUBLE) END AS quality
  FROM documents),
keyed AS (SELECT *, -ln((('0x' || draw)::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / quality AS key FROM measured),
sources AS (SELECT source, sum(size)::BIGINT AS source_size,
    ([{weights}]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT] AS weight FROM keyed GROUP BY source),
leveled AS (SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum({MOST_EPOCHS} * source_size) OVER before, 0)::DOUBLE)
    / sum(weight) OVER onward AS level, row_number() OVER (ORDER BY {MOST_EPOCHS} * source_size / weight, source NULLS LAST) AS turn FROM sources
  WINDOW before AS (ORDER BY {MOST_EPOCHS} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    onward AS (ORDER BY {MOST_EPOCHS} * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
planned AS (SELECT source, source_size, coalesce(least(weight * (SELECT arg_min(level, turn) FROM leveled WHERE level * weight <= {MOST_EPOCHS} * source_size),
    {MOST_EPOCHS}.0::DOUBLE * source_size), {MOST_EPOCHS}.0::DOUBLE * source_size) AS target FROM leveled),
wanted AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {MOST_EPOCHS})::BIGINT ELSE 0 END AS epochs FROM planned),
summed AS (SELECT k.doc_id, k.size, w.source_size, w.target, w.epochs, floor(w.target - w.epochs * w.source_size)::BIGINT
    - (sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.draw, k.doc_id NULLS LAST, k.size ROWS UNBOUNDED PRECEDING) - k.size) AS still
  FROM keyed k JOIN wanted w ON k.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(least(still, size), 0))::BIGINT AS taken FROM summed
"""


SQL = _sql()
