"""Mix sources to target weights by Sainte-Laguë apportionment (DataFrame functions only).

The words of a source are one stream, cut into shards of whole documents and each shard into blocks of
`block` words. Blocks are the seats: first the sources, by highest quotients target / (2k - 1), then
the shards of a source, by highest quotients size / (2k - 1), get integer quotas. A shard of n blocks
with quota q takes each block q div n times, and q mod n of them, chosen by a seeded permutation of
the block numbers, once more.

Scale: one row per source and one per shard go through windows (at most 2**16 + number of sources
shards); documents meet in one shuffle by (source, shard), so a source with a third of all rows is
spread over as many shards as its words fill. Texts are not shuffled. Documents of equal id, source and size
are counted first and then numbered, so that a null or often repeated id is spread over the shards like others.

Defined cases: a null text has size 0; a null source is a source of its own, ordered last; a null
doc_id is a document like any other; repeated rows are separate documents; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqflow.llm.common import join_checked, word_count, written

STRIDE = 2654435761  # prime, so coprime to any smaller number of blocks


def _digest60(text: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(text), at, 15), 16, 10).cast("long")


def numbered_copies(df: DataFrame, keys: Sequence[str], step: int = 4096) -> DataFrame:
    """The rows of `keys` with `copy`, 1, 2, ... among equal rows: counted, then dealt out again in pieces of `step`."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    pieces = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(step).cast("long"))).alias("_from"))
    return pieces.select(*keys, F.explode(F.sequence(F.col("_from") + 1, F.least(F.col("_from") + step, F.col("_n")))).alias("copy"))


def sainte_lague(df: DataFrame, parts: Sequence[str], order: Sequence[Column], keys: Sequence[str], weight: str,
                 seats: str, limit: Column | None = None) -> DataFrame:
    """Adds `quota`: within each value of `parts`, `seats` seats by highest quotients weight / (2k - 1).

    `seats` holds the same number throughout a part. At a divisor d a party has about weight / d seats,
    and the final d lies between W / (T + n/2) and W / (T - n/2); seats below that range are given at
    once, and only the few candidates inside it are ranked. `limit`: most seats for a row; seats that
    none can take stay free.
    """
    w = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    n, total = F.sum((F.col(weight) > 0).cast("long")).over(w), F.sum(weight).over(w)
    t = F.col(seats)
    df = df.withColumn("_n", n).withColumn("_w", total.cast("double"))
    low = F.when((t > F.col("_n") / 2) & (F.col("_w") > 0),
                 F.floor(F.col(weight) * (t - F.col("_n") / 2) / F.col("_w") + 0.5) - 1).otherwise(0)
    high = F.when(F.col("_w") > 0, F.floor(F.col(weight) * (t + F.col("_n") / 2) / F.col("_w") + 0.5) + 2).otherwise(0)
    low, high = F.greatest(F.lit(0), low).cast("long"), F.when(F.col(weight) > 0, high).otherwise(0).cast("long")
    if limit is not None:
        low, high = F.least(low, limit), F.least(high, limit)
    df = df.withColumn("_low", low).withColumn("_high", high)
    df = df.withColumn("_rest", t - F.sum("_low").over(w))
    k = F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low") + 1, F.col("_high"))))
    cand = df.select("*", k.alias("_k")).withColumn("_q", F.col(weight) / (2 * F.col("_k") - 1))
    rank = F.row_number().over(w.orderBy(F.col("_q").desc_nulls_last(), *order, F.col("_k")))
    cand = cand.withColumn("_won", (F.col("_k").isNotNull() & (rank <= F.col("_rest"))).cast("long"))
    kept = [c for c in df.columns if c not in {*keys, "_n", "_w", "_low", "_high", "_rest"}]
    return cand.groupBy(*keys).agg(*[F.first(c).alias(c) for c in kept],
                                   (F.first("_low") + F.sum("_won")).alias("quota"))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: int) -> DataFrame:
    """(source, source_size) -> with `rn` (place by code point, null last) and `target`: weights share
    `share` of all words; a target stops at `cap` times its source's size and the excess is reshared."""
    one = Window.partitionBy(F.lit(0))
    df = sizes.withColumn("rn", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())))
    df = df.withColumn("w", F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                                         ((F.col("rn") - 1) % len(weights) + 1).cast("int")))
    df = df.withColumn("top", cap * F.col("source_size")).withColumn("ratio", F.col("top") / F.col("w"))
    up = one.orderBy("ratio", "rn")
    before = F.coalesce(F.sum("top").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing))
    df = df.withColumn("level", (share * F.sum("source_size").over(one) - before) / rest)
    level = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(one)
    df = df.withColumn("target", F.least(F.col("top").cast("double"), F.coalesce(F.col("w") * level, F.col("top").cast("double"))))
    return df.select("source", "source_size", "rn", "target")


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: int = 2, block: int = 32,
                shard_words: int = 1 << 18, max_shards: int = 1 << 16, seed: str = "mix") -> DataFrame:
    """doc_id, size, source, source_size, target, quota (blocks of its shard), taken (words, repeats counted)."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"))
    slim = written(numbered_copies(slim, ["doc_id", "source", "size"]), "mix-sizes")
    sources = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    one = Window.partitionBy(F.lit(0))
    sources = sources.withColumn("seats", F.floor(F.sum("target").over(one) / block + 0.5).cast("long"))
    sources = sources.withColumn("per_shard", F.greatest(F.lit(float(shard_words)),
                                                         F.sum("source_size").over(one) / max_shards))
    sources = sources.withColumn("n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.col("per_shard"))).cast("long"))
    sources = sainte_lague(sources, [], [F.col("rn")], ["rn"], "target", "seats").withColumnRenamed("quota", "source_seats")
    sources = written(sources.select(F.col("source").alias("_source"), "rn", "source_size", "target", "source_seats", "n_shards"),
                      "mix-sources")

    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.col("size"), F.lit("|"), F.col("copy"))
    rows = join_checked(slim, sources, F.col("source").eqNullSafe(F.col("_source")), "inner").drop("_source")
    rows = rows.withColumn("place", _digest60(key, 1)).withColumn("shard", _digest60(key, 17) % F.col("n_shards"))

    shards = rows.groupBy("rn", "shard").agg(F.sum("size").alias("words"), F.first("source_seats").alias("source_seats"))
    shards = shards.withColumn("n_blocks", F.ceil(F.col("words") / block).cast("long"))
    shards = sainte_lague(shards, ["rn"], [F.col("shard")], ["rn", "shard"], "words", "source_seats", cap * F.col("n_blocks"))
    shift = _digest60(F.concat_ws("|", F.lit(seed), F.col("rn"), F.col("shard")), 1)
    shards = written(shards.select(F.col("rn").alias("_rn"), F.col("shard").alias("_shard"), "n_blocks", "quota",
                                   F.when(F.col("n_blocks") > 0, shift % F.col("n_blocks")).otherwise(0).alias("shift")), "mix-shards")

    order = Window.partitionBy("rn", "shard").orderBy("place", "doc_id", "size", "copy").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum("size").over(order))
    rows = join_checked(rows, shards, (F.col("rn") == F.col("_rn")) & (F.col("shard") == F.col("_shard")), "inner",
                        max_rows=2 * max_shards)
    start, n, q = F.col("end") - F.col("size"), F.col("n_blocks"), F.col("quota")

    def more(acc: Column, i: Column) -> Column:
        words = F.least(F.col("end"), (i + 1) * block) - F.greatest(start, i * block)
        return acc + F.when((i * F.lit(STRIDE) + F.col("shift")) % n < q % n, words).otherwise(F.lit(0).cast("long"))

    blocks = F.sequence(F.floor(start / block).cast("long"), F.floor((F.col("end") - 1) / block).cast("long"))
    extra = F.aggregate(blocks, F.lit(0).cast("long"), more)
    taken = F.when(F.col("size") > 0, F.col("size") * F.floor(q / n).cast("long") + extra).otherwise(F.lit(0).cast("long"))
    return rows.select("doc_id", "size", "source", "source_size", "target", "quota", taken.alias("taken"))


#: the same rows in DuckDB's SQL, for the default parameters
ORACLE = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
-- equal rows are numbered: a document's place is that of its id, size and number
named AS (SELECT *, 'mix|' || coalesce(doc_id::VARCHAR, '') || '|' || size || '|' || row_number() OVER (PARTITION BY doc_id, source, size) AS name,
            row_number() OVER (PARTITION BY doc_id, source, size) AS copy FROM sized),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn FROM src),
s2 AS (SELECT *, CASE (rn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2 * source_size AS top FROM s1),
-- every round shares what is left among the sources not yet stopped; those above twice their size stop
rounds(i, stopped) AS (
  SELECT 0, []::BIGINT[]
  UNION ALL
  SELECT i + 1, list_concat(stopped, (
      SELECT list(rn) FROM s2 WHERE NOT list_contains(stopped, rn) AND top < w *
        (1.5 * (SELECT sum(source_size) FROM s2) - (SELECT coalesce(sum(top), 0) FROM s2 WHERE list_contains(stopped, rn)))
        / (SELECT sum(w) FROM s2 WHERE NOT list_contains(stopped, rn))))
  FROM rounds WHERE EXISTS (
      SELECT 1 FROM s2 WHERE NOT list_contains(stopped, rn) AND top < w *
        (1.5 * (SELECT sum(source_size) FROM s2) - (SELECT coalesce(sum(top), 0) FROM s2 WHERE list_contains(stopped, rn)))
        / (SELECT sum(w) FROM s2 WHERE NOT list_contains(stopped, rn)))),
fin AS (SELECT stopped FROM rounds ORDER BY i DESC LIMIT 1),
lev AS (SELECT (1.5 * (SELECT sum(source_size) FROM s2) - (SELECT coalesce(sum(top), 0) FROM s2, fin WHERE list_contains(stopped, rn)))
        / (SELECT sum(w) FROM s2, fin WHERE NOT list_contains(stopped, rn)) AS level),
s3 AS (SELECT source, source_size, rn, CASE WHEN list_contains(stopped, rn) THEN top::DOUBLE ELSE (w * level)::DOUBLE END AS target
       FROM s2, fin, lev),
s4 AS (SELECT *, floor(sum(target) OVER () / 32 + 0.5)::BIGINT AS seats,
         greatest(1, ceil(source_size / greatest(262144.0, sum(source_size) OVER () / 65536)))::BIGINT AS n_shards FROM s3),
seat1 AS (SELECT rn, count(*) AS n FROM (
    SELECT rn, seats, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, rn, k) AS r
    FROM (SELECT rn, target, seats, unnest(range(1, (2 * target / 32)::BIGINT + 3)) AS k FROM s4 WHERE target > 0)) WHERE r <= seats GROUP BY rn),
s5 AS (SELECT s4.*, coalesce(n, 0) AS source_seats FROM s4 LEFT JOIN seat1 USING (rn)),
r1 AS (SELECT d.doc_id, d.size, d.copy, s5.source_size, s5.target, s5.rn, s5.source_seats,
         ('0x' || substr(md5(d.name), 1, 15))::BIGINT AS place,
         ('0x' || substr(md5(d.name), 17, 15))::BIGINT % n_shards AS shard
       FROM named d JOIN s5 ON d.source IS NOT DISTINCT FROM s5.source),
sh AS (SELECT rn, shard, sum(size)::BIGINT AS words, any_value(source_seats) AS source_seats, ceil(sum(size) / 32)::BIGINT AS n_blocks
       FROM r1 GROUP BY rn, shard),
seat2 AS (SELECT rn, shard, count(*) AS n FROM (
    SELECT rn, shard, source_seats, row_number() OVER (PARTITION BY rn ORDER BY words / (2 * k - 1) DESC, shard, k) AS r
    FROM (SELECT *, unnest(range(1, 2 * n_blocks + 1)) AS k FROM sh)) WHERE r <= source_seats GROUP BY rn, shard),
sh2 AS (SELECT sh.*, coalesce(n, 0) AS quota,
          CASE WHEN n_blocks > 0 THEN ('0x' || substr(md5('mix|' || rn || '|' || shard), 1, 15))::BIGINT % n_blocks ELSE 0 END AS shift
        FROM sh LEFT JOIN seat2 USING (rn, shard)),
r2 AS (SELECT *, sum(size) OVER (PARTITION BY rn, shard ORDER BY place, doc_id, size, copy ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM r1),
bl AS (SELECT doc_id, place, size, e, rn, shard, unnest(range((e - size) // 32, (e - 1) // 32 + 1)) AS i FROM r2 WHERE size > 0),
got AS (SELECT bl.doc_id, bl.rn, bl.shard, bl.e, sum((least(e, (i + 1) * 32) - greatest(e - size, i * 32)) *
          (quota // n_blocks + CASE WHEN (i * 2654435761 + shift) % n_blocks < quota % n_blocks THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM bl JOIN sh2 USING (rn, shard) GROUP BY ALL)
SELECT r2.doc_id, r2.size, r2.source_size, r2.target, coalesce(got.taken, 0)::BIGINT AS taken
FROM r2 LEFT JOIN got ON r2.size > 0 AND r2.rn = got.rn AND r2.shard = got.shard AND r2.e = got.e
"""
