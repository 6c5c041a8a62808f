"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

1. Sizes, source totals and targets (weights filled up to a cap of ``most`` times a
   source's size, the excess shared again by weight) come from one pass of built-in
   functions and one aggregation by source.
2. A source's documents are permuted by md5 of (seed, doc_id) and cut there into
   blocks of about ``block_docs`` documents.  Its target, a whole number of words, is
   met exactly: every block some whole number of times, then blocks in permuted order
   until the quota is reached; the copy in which it ends is cut there.
3. What each source draws is a number of block copies.  A binary tree splits the vector
   of these numbers among the output shards: at each node the left half's share is a
   multivariate hypergeometric draw, one conditional hypergeometric after another, by
   inverse distribution function from a hash of (seed, node, source).  More than ``FAN``
   sources are drawn by groups first, then within groups, so no row holds them all.
   Leaves hold exact counts, so shards take disjoint runs of each source's permuted
   block copies.
4. Within a shard, rows are ordered by a hash of (seed, doc_id, copy).

Only the boundary block of each source is ever ordered by document; all that is joined
to the documents is one row for each source or block, broadcast if it is counted and
found small, else joined by a shuffle.  Running sums go by spans, then within spans, so
a hot source's blocks never meet in one task.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import cut, join_counted, sized

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST, SEED, BLOCK_DOCS, SHARD_WORDS, FAN, SPAN = (3, 1, 2), 1.5, 2, 17, 1024, 50_000_000, 64, 4096
_TWO60 = float(1 << 60)


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """(row, doc_id, text, k, size, h): k is the source's key, never null; h the place in the
    permutation, by doc_id, or by the text where that is null."""
    text = F.col("text").cast("string")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id"),
        text.alias("text"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("t")).alias("k"),
        F.coalesce(F.expr(rf"regexp_count(cast(text as string), r'{WORD}')").cast("long"), F.lit(0).cast("long")).alias("size"),
        _digits(F.concat(F.lit(f"{seed}:"), name), 15).alias("h"),
    )


def _digits(name: Column, n: int) -> Column:
    """The first ``n`` hexadecimal digits of a name's md5, as a number."""
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, n), 16, 10).cast("long")


def _before(d: DataFrame, span: Column, order: list[str], value: Column) -> DataFrame:
    """``d`` (k, ...), already written, with before: the sum of ``value`` over the rows of its k
    that come earlier by (span, order).  Spans are summed first, so a k with many rows is worked
    on by as many tasks as it has spans; only its spans meet in one."""
    d = d.withColumns({"span": span.cast("long"), "value": value.cast("long")})
    spans = d.groupBy("k", "span").agg(F.sum("value").alias("s"))
    earlier = lambda w: F.coalesce(F.sum(w[1]).over(w[0].rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select("k", "span", earlier((W.partitionBy("k").orderBy("span"), "s")).alias("base"))
    within = d.withColumn("inner", earlier((W.partitionBy("k", "span").orderBy(*order), "value")))
    return within.join(spans, ["k", "span"]).withColumn("before", F.col("base") + F.col("inner")).drop("span", "value", "base", "inner")


def targets(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row for each source of ``docs`` (k, size): k, i (its rank), n, source_size, target,
    whole (times all of it is taken), rest (words of one more copy), blocks."""
    by = docs.groupBy("k").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    rank = F.row_number().over(W.orderBy("k"))
    w = by.withColumn("i", rank - 1).withColumn("w", F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((rank - 1) % len(weights) + 1).cast("int")).cast("long"))
    order = W.orderBy(F.col("s") * most / F.col("w"), "k")
    before = lambda c: F.coalesce(F.sum(c).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    whole = W.partitionBy()
    lam = (F.sum("s").over(whole) * F.lit(float(share)) - before(F.col("s") * most)) / (F.sum("w").over(whole) - before("w"))
    # by room for its weight, a source is capped if its share of what the earlier ones left is above its cap
    d = w.withColumn("lam", lam).withColumn("capped", F.col("w") * F.col("lam") > F.col("s") * most)
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("s") * most / F.col("w"), "k", "lam"))).over(whole)["lam"]
    d = d.withColumn("target", F.when(F.col("capped"), (F.col("s") * most).cast("double")).otherwise(F.least(F.col("w") * level, (F.col("s") * most).cast("double"))))
    quota = F.floor(F.col("target") + 0.5)
    full = F.when(F.col("s") > 0, F.floor(quota / F.greatest("s", F.lit(1)))).otherwise(F.lit(0)).cast("long")
    return d.select("k", "i", "n", F.col("s").alias("source_size"), "target", full.alias("whole"), (quota - full * F.col("s")).cast("long").alias("rest"), F.ceil(F.col("n") / block_docs).alias("blocks"))


def _lf(x: str) -> str:
    """ln(x!) by Stirling's series at x+8."""
    z = f"(({x}) + 8D)"
    low = " * ".join(f"(({x}) + {i}D)" for i in range(1, 9))
    return f"(({z} + 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1D / (12D * {z}) - 1D / (360D * {z} * {z} * {z}) - ln({low}))"


def _hyper(k: str, total: str, n: str, u: str) -> str:
    """SQL: a draw of how many of ``k`` marked among ``total`` are in a sample of ``n``,
    by inverse distribution function at ``u``.  The sum runs over 12 standard deviations
    (and 12 values more) on either side of the mean, which leaves out less than 1e-30."""
    lo, hi = f"greatest(0L, {n} - ({total} - {k}))", f"least({k}, {n})"
    mean = f"({n} * 1D * {k} / {total})"
    sd = f"sqrt({mean} * (1D - {k} * 1D / {total}) * greatest(0L, {total} - {n}) / greatest(1L, {total} - 1L))"
    ks = f"sequence(greatest({lo}, cast(floor({mean} - 12 * {sd} - 12) as bigint)), least({hi}, cast(ceil({mean} + 12 * {sd} + 12) as bigint)))"
    lw = f"-({_lf('k')} + {_lf(f'{k} - k')} + {_lf(f'{n} - k')} + {_lf(f'{total} - {k} - {n} + k')})"
    pick = (
        f"transform(array({ks}), ks -> transform(array(transform(ks, k -> {lw})), lw -> transform(array(transform(lw, v -> exp(v - array_max(lw)))), ws -> "
        f"ks[cast(least(size(ks) - 1L, aggregate(ws, named_struct('c', 0D, 'i', 0L), (s, w) -> named_struct('c', s.c + w, 'i', s.i + if(s.c + w <= {u} * aggregate(ws, 0D, (p, q) -> p + q), 1L, 0L)), s -> s.i)) as int)])[0])[0])[0]"
    )
    return f"if({k} = 0 or {n} = 0, 0L, if({total} = {k}, {n}, {pick}))"


def _draw(rows: DataFrame, sources: int, seed: int) -> DataFrame:
    """``rows`` (node, i, s, d) with x: how many of each source's d the node's left half takes,
    half of them all (rounded up at odd nodes) by a multivariate hypergeometric draw."""
    items = F.array_sort(F.collect_list(F.struct("i", "s", "d"))).alias("items")
    if sources <= FAN:
        packed = rows.groupBy("node").agg(items, ((F.sum("d") + F.first("node") % 2) / 2).cast("long").alias("n"))
    else:
        grouped = rows.withColumn("g", F.floor(F.col("i") / FAN))
        sums = grouped.groupBy("node", "g").agg(F.sum("d").alias("d"))
        of_group = _draw(sums.select("node", F.col("g").alias("i"), F.concat(F.lit("group "), F.lit(f"{sources} "), "g").alias("s"), "d"), -(-sources // FAN), seed)
        packed = grouped.groupBy("node", "g").agg(items).join(of_group.select("node", F.col("i").alias("g"), F.col("x").alias("n")), ["node", "g"])
    u = f"(cast(conv(substring(md5(cast(concat('{seed}:', node, ':', i.s) as binary)), 1, 13), 16, 10) as bigint) / 4503599627370496D)"
    fold = (
        "aggregate(items, named_struct('n', n, 'total', aggregate(items, 0L, (p, q) -> p + q.d), 'o', cast(array() as array<struct<i:bigint,s:string,d:bigint,x:bigint>>)), "
        f"(a, i) -> transform(array({_hyper('i.d', 'a.total', 'a.n', u)}), x -> named_struct('n', a.n - x, 'total', a.total - i.d, 'o', concat(a.o, array(named_struct('i', i.i, 's', i.s, 'd', i.d, 'x', x)))))[0], a -> a.o)"
    )
    return packed.select("node", F.explode(F.expr(fold)).alias("o")).select("node", "o.*")


def split_tree(draws: DataFrame, levels: int, seed: int = SEED) -> DataFrame:
    """(shard, s, d): how many of each source's block copies (``draws``: s, i, d, with i from 0 on)
    each of 2^levels shards takes, none left out but zeros; exact, and by a multivariate
    hypergeometric draw at each node.  The root is node 1, the halves of a node 2 node and 2 node + 1."""
    sources = draws.agg(F.max("i")).first()[0]
    node = draws.select(F.lit(1).cast("long").alias("node"), F.col("i").cast("long").alias("i"), "s", F.col("d").cast("long").alias("d"))
    for _ in range(levels):
        two = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("x").alias("d")), F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("d") - F.col("x")).alias("d")))
        node = cut(_draw(node, (sources or 0) + 1, seed).select("i", "s", F.explode(two).alias("c")).select("c.node", "i", "s", "c.d").where("d > 0"))
    return node.select((F.col("node") - (1 << levels)).alias("shard"), "s", "d")


def plan(docs: DataFrame, shards: int | None = None, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(row, doc_id, text, k, size, h, source_size, target, whole, left, words, copies) of every row
    of ``docs``: left is how many of its block's words a copy after the ``whole`` ones takes, and
    copies an array of (copy, shard) for those drawn."""
    full = _keyed(docs, seed)
    slim = cut(full.select("k", "size", "h"))
    by = cut(targets(slim, weights, share, most, block_docs))
    at = F.floor(F.col("h") / F.lit(_TWO60) * F.col("blocks")).cast("long")
    blocks = cut(join_counted(slim, by.select("k", "n", "blocks"), "k").groupBy("k", at.alias("b")).agg(F.sum("size").alias("words")))
    blocks = _before(blocks, F.floor(F.col("b") / SPAN), ["b"], F.col("words"))
    few = sized(by.drop("n"))
    # the extra copy of a block: all of it, what is left of the quota, or none
    left = F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), F.col("words"))
    units = cut(blocks.join(few, "k").withColumn("left", left).withColumn("n", F.col("whole") + F.when(F.col("left") > 0, 1).otherwise(0)))
    draws = cut(units.groupBy("k", "i").agg(F.sum("n").cast("long").alias("d")).where("d > 0"))
    if shards is None:
        words = slim.agg(F.sum("size")).first()[0] or 0
        shards = max(8, -(-words * share // SHARD_WORDS))
    levels = max(0, (int(shards) - 1).bit_length())
    quota = cut(split_tree(draws.select(F.col("k").alias("s"), "i", "d"), levels, seed).withColumnRenamed("s", "k"))
    runs = _before(quota, F.floor(F.col("shard") / SPAN), ["shard"], F.col("d"))
    ranks = runs.select("k", "shard", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("d"))).alias("r"))
    copies = units.where("n > 0").select("k", "b", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long"))).alias("copy"))
    copies = copies.withColumn("p", _digits(F.concat_ws(":", F.lit(str(seed)), "k", "b", "copy"), 15)).join(sized(draws.select("k", "d")), "k")
    ranked = _before(cut(copies), F.floor(F.col("p") / F.lit(_TWO60) * F.ceil(F.col("d") / SPAN)), ["p", "b", "copy"], F.lit(1)).withColumn("r", F.col("before") + 1)
    placed = ranked.join(ranks, ["k", "r"]).groupBy("k", "b").agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("copies"))
    of_block = sized(cut(units.select("k", "b", "source_size", "target", "whole", "left", "words").join(placed, ["k", "b"], "left")))
    keyed = join_counted(full, by.select("k", "n", "blocks"), "k").withColumn("b", at)
    return keyed.drop("n", "blocks").join(of_block, ["k", "b"])


def _rest(planned: DataFrame) -> DataFrame:
    """Adds rest, the words taken of the copy after the whole ones: only in the one block of
    each source in which the quota ends are documents ordered."""
    cutting = (F.col("left") > 0) & (F.col("left") < F.col("words"))
    upto = F.sum("size").over(W.partitionBy("k").orderBy("h", "doc_id", "size", "text").rowsBetween(W.unboundedPreceding, 0))
    inside = F.least(F.greatest(F.col("left") - upto + F.col("size"), F.lit(0)), F.col("size"))
    even = planned.where(~cutting).withColumn("rest", F.when(F.col("left") > 0, F.col("size")).otherwise(F.lit(0)).cast("long"))
    return even.unionByName(planned.where(cutting).withColumn("rest", inside.cast("long")))


_WORDS_OF = "if(c.copy <= whole, size, rest)"


def taken(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards): what the mix takes of each row, and
    where the tree puts it: copy:shard for each copy with words of it, by copy.

    A null text has size 0; a null source is a source of its own, last in order.  An
    empty table gives an empty one; sources without words have target 0.  Repeated rows
    are rows of their own, and ties in the permutation fall by doc_id, size, then text."""
    d = _rest(plan(docs.select("doc_id", "text", "source"), **kw))
    words = F.expr(f"aggregate(coalesce(copies, array()), 0L, (t, c) -> t + {_WORDS_OF})")
    where = F.expr(f"array_join(transform(filter(coalesce(copies, array()), c -> {_WORDS_OF} > 0), c -> concat(c.copy, ':', c.shard)), ',')")
    return d.select("doc_id", "size", "source_size", "target", words.alias("taken"), where.alias("shards"))


def mix(docs: DataFrame, keep_plan: bool = False, **kw) -> DataFrame:
    """The mixed rows: each copy of a document that is taken, with its columns (of any names),
    dealt to the output shards and shuffled within each.  A copy that is cut holds its first
    words, single-spaced; ``n_chars``, if there, follows.  ``keep_plan`` adds mix_shard, mix_copy
    and mix_words (columns of these names in ``docs`` are replaced).  Documents without
    words are in no copy, as they take up no words.  See ``taken`` for nulls and ties."""
    names = docs.columns
    d = _rest(plan(docs, **kw)).withColumn("c", F.explode("copies")).withColumn("w", F.expr(_WORDS_OF)).where("w > 0")
    short = F.col("w") < F.col("size")
    head = F.array_join(F.slice(F.expr(rf"regexp_extract_all(text, r'{WORD}', 0)"), F.lit(1), F.col("w").cast("int")), " ")
    d = d.withColumn("head", F.when(short, head))
    out = {n: F.col("row")[n] for n in names}
    out["text"] = F.when(short, F.col("head").cast(docs.schema["text"].dataType)).otherwise(out["text"])
    if "n_chars" in names:
        out["n_chars"] = F.when(short, F.length("head").cast(docs.schema["n_chars"].dataType)).otherwise(out["n_chars"])
    if keep_plan:
        out |= {"mix_shard": F.col("c.shard"), "mix_copy": F.col("c.copy"), "mix_words": F.col("w")}
    d = d.withColumn("o", F.xxhash64(F.lit(kw.get("seed", SEED)), "doc_id", "c.copy"))
    # by range: a shard stays whole or is split by its own order, and none waits for a hot one
    d = d.repartitionByRange(F.col("c.shard"), F.col("o")).sortWithinPartitions(F.col("c.shard"), "o")
    return d.select(*[v.alias(n) for n, v in out.items()])


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    return taken(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle_sql(block_docs: int = BLOCK_DOCS, levels: int = 3) -> str:
    """The same for DuckDB, tree and all, for up to ``FAN`` sources and 2^levels shards."""
    lf = lambda x: f"lgamma(({x}) + 1)"
    lo, hi = "greatest(0, n - (total - ds[i]))", "least(ds[i], n)"
    mean = "(n * 1::DOUBLE * ds[i] / greatest(1, total))"
    sd = f"sqrt(greatest(0, {mean} * (1 - ds[i] * 1::DOUBLE / greatest(1, total)) * greatest(0, total - n) / greatest(1, total - 1)))"
    ks = f"range(greatest({lo}, floor({mean} - 12 * {sd} - 12)::BIGINT), least({hi}, ceil({mean} + 12 * {sd} + 12)::BIGINT) + 1)"
    lw = f"-({lf('v')} + {lf('ds[i] - v')} + {lf('n - v')} + {lf('total - ds[i] - n + v')})"
    return rf"""WITH RECURSIVE sized AS (SELECT doc_id, text, coalesce('s' || source, 't') AS k, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))), 1, 15))::BIGINT AS h FROM documents),
src AS (SELECT k, sum(size)::BIGINT AS s, ceil(count(*) / {block_docs})::BIGINT AS nb FROM sized GROUP BY k),
w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY k) - 1) % 3 + 1] AS w FROM src),
lam AS (SELECT *, (sum(s) OVER () * 1.5::DOUBLE - coalesce(sum(s * 2) OVER o, 0)::DOUBLE) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0))::DOUBLE AS lam
  FROM w WINDOW o AS (ORDER BY s * 2 / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cap AS (SELECT *, w * lam > s * 2 AS capped FROM lam),
goal AS (SELECT k, s, nb, CASE WHEN capped THEN (s * 2)::DOUBLE ELSE least(w * (SELECT arg_min(lam, (s * 2 / w, k)) FROM cap WHERE NOT capped), (s * 2)::DOUBLE) END AS target FROM cap),
quota AS (SELECT *, CASE WHEN s > 0 THEN floor(target + 0.5)::BIGINT // s ELSE 0 END AS q, floor(target + 0.5)::BIGINT - CASE WHEN s > 0 THEN floor(target + 0.5)::BIGINT // s ELSE 0 END * s AS r FROM goal),
placed AS (SELECT *, floor(h / {_TWO60:.0f}::DOUBLE * nb)::BIGINT AS b,
  greatest(r - coalesce(sum(size) OVER (PARTITION BY k ORDER BY h, doc_id NULLS FIRST, size, text NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS room FROM sized JOIN quota USING (k)),
blocks AS (SELECT k, b, any_value(q) AS q, any_value(r) AS r, sum(size)::BIGINT AS words FROM placed GROUP BY k, b),
units AS (SELECT k, b, q + (least(greatest(r - coalesce(sum(words) OVER (PARTITION BY k ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0), words) > 0)::BIGINT AS n FROM blocks),
draws AS (SELECT k, sum(n)::BIGINT AS d FROM units GROUP BY k HAVING sum(n) > 0),
root AS (SELECT list(k ORDER BY k) AS names, list(d ORDER BY k) AS ds FROM draws),
tree AS (SELECT 0 AS level, 1::BIGINT AS node, names, ds, []::BIGINT[] AS xs, (list_sum(ds)::BIGINT + 1) // 2 AS n, list_sum(ds)::BIGINT AS total FROM root WHERE len(ds) > 0
 UNION ALL (
 SELECT level, node, names, ds, list_append(xs, x), n - x, total - ds[i] FROM (
  SELECT *, CASE WHEN ds[i] = 0 OR n = 0 THEN 0 WHEN total = ds[i] THEN n ELSE (SELECT ks[least(len(ks) - 1, len(list_filter(list_transform(range(1, len(ws) + 1), lambda j: list_sum(ws[1:j])), lambda c: c <= u * list_sum(ws)))) + 1]
    FROM (SELECT ks, list_transform(lws, lambda v: exp(v - list_max(lws))) AS ws FROM (SELECT {ks} AS ks, list_transform({ks}, lambda v: {lw}) AS lws))) END AS x FROM (
   SELECT *, len(xs) + 1 AS i, ('0x' || substr(md5('{SEED}:' || node || ':' || names[len(xs) + 1]), 1, 13))::BIGINT / 4503599627370496::DOUBLE AS u FROM tree WHERE level < {levels} AND len(xs) < len(ds)))
 UNION ALL
 SELECT level + 1, node * 2 + side, names, part, []::BIGINT[], (list_sum(part)::BIGINT + side) // 2, list_sum(part)::BIGINT FROM (
  SELECT *, CASE WHEN side = 0 THEN xs ELSE list_transform(range(1, len(ds) + 1), lambda j: ds[j] - xs[j]) END AS part FROM tree, (VALUES (0), (1)) AS sides(side) WHERE level < {levels} AND len(xs) = len(ds)))),
leaves AS (SELECT node - {1 << levels} AS shard, unnest(names) AS k, unnest(ds) AS d FROM tree WHERE level = {levels}),
runs AS (SELECT k, shard, d, coalesce(sum(d) OVER (PARTITION BY k ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM leaves),
copies AS (SELECT k, b, unnest(range(1, n + 1)) AS copy FROM units),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ('0x' || substr(md5('{SEED}:' || k || ':' || b || ':' || copy), 1, 15))::BIGINT, b, copy) AS rank FROM copies),
dealt AS (SELECT ranked.k, b, copy, shard FROM ranked JOIN runs ON ranked.k = runs.k AND rank > before AND rank <= before + d),
of_block AS (SELECT k, b, list({{'copy': copy, 'shard': shard}} ORDER BY copy) AS copies FROM dealt GROUP BY k, b)
SELECT doc_id, size, s AS source_size, target, (q * size + least(room, size))::BIGINT AS taken,
  array_to_string(list_transform(list_filter(coalesce(copies, []), lambda c: CASE WHEN c.copy <= q THEN size ELSE least(room, size) END > 0), lambda c: c.copy || ':' || c.shard), ',') AS shards
FROM placed LEFT JOIN of_block USING (k, b)"""


ORACLE_SQL = oracle_sql()
