"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Only DataFrame and SQL functions are used. Words of a source's documents, in
a pseudo-random order fixed by the seed, are cut into blocks of nearly equal
size; a document of over a 256th of its source (there are fewer than 256) is
a block of its own. A source whose target is f times its size and a rest draws
all its blocks f times and some blocks of one more pass: long documents in
order as long as they fit into their share of the rest, then the first blocks
of others up to what is missing. These block quotas are exact. A binary tree
divides them among the output shards: at every node the left half's share of
the blocks is drawn from the sources by the multivariate hypergeometric law,
so each shard gets as many blocks as the next, or one more. Then each source's
blocks, in a random order, are cut into disjoint runs of the lengths that the
leaves name. A document goes where its block goes and is placed in its shard
by a random key.

A hot source is spread: its running word counts come from 4096 hash buckets
a source, whose sums are added first. A source has some 13,000 blocks at most,
so tables of blocks and nodes grow with the number of sources only; the
numbers of a node's sources are one row.

Defined cases: a null text has size 0; a null source is a source, the last.
A document without words takes 0 words but is drawn with its block. Rows that
repeat an id, source and size are drawn together; a null id is an id. If no
row has a word, targets are 0. Empty tables give empty results. Extra columns
are carried by ``mixed`` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, n_words, ranked, written

SEED = "tarn"
MOST_TIMES = 3
#: Blocks that a pass over a source is cut into, at most.
BLOCKS = 4096
SHARDS = 16


def _key(*parts) -> Column:
    """A pseudo-random key that any engine with MD5 can compute: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(SEED), *[F.coalesce(F.col(p).cast("string"), F.lit("-")) for p in parts]))


#: A document of over this part of its source's words is a block of its own.
LONG = 256
IS_LONG = f"size * n * {LONG} > source_size"


def targets(sizes: DataFrame) -> DataFrame:
    """One row a source: source, src (its place), source_size, target and f (whole passes).

    Weights are shared out as water fills vessels: sources in the order in
    which they reach their limit, prefix sums give the level for every number
    of full ones, and the first level that the next source isn't full at holds.
    """
    place = W.orderBy(F.asc_nulls_last("source"))
    filling = W.orderBy("full_at", "src")
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    rows = (
        sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
        .withColumn("src", F.row_number().over(place))
        .withColumn("weight", (F.col("src") - 1) % 3 + 1)
        .withColumn("full_at", F.col("source_size") * MOST_TIMES / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * MOST_TIMES)
                    / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
        .withColumn("level", F.min_by(F.when(F.col("full_at") >= F.col("level"), F.col("level")), F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "src"))).over(every))
        .withColumn("target", F.least(F.col("source_size") * F.lit(float(MOST_TIMES)), F.col("level") * F.col("weight")))
    )
    return rows.select(
        "source", "src", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int").alias("f"),
    )


def long_documents(docs: DataFrame) -> DataFrame:
    """The long documents, each a block (numbered -1, -2, ...), and whether they are drawn in the last pass.

    In their order each is drawn if it still fits into their share of the
    rest; if that is over half, those to leave out are found so. A source has fewer than 256 of them, so its list is short.
    """
    longs = docs.where(IS_LONG).withColumn("words", F.expr("size * n"))
    one = ["source", "src", "source_size", "target", "f"]
    lists = longs.groupBy(*one).agg(F.sum("words").alias("every"), F.sort_array(F.collect_list(F.struct("at", "doc_id", "size", "n", "words"))).alias("all"))
    lists = lists.withColumn("share", F.expr("(target - f * source_size) * every / source_size")).withColumn("out", F.expr("share * 2 > every"))
    fits = """
        aggregate(all, struct(if(out, every - share, share) as rest, cast(array() as array<boolean>) as yes),
                  (t, x) -> struct(t.rest - if(x.words <= t.rest, x.words, 0) as rest, array_append(t.yes, x.words <= t.rest) as yes)).yes"""
    drawn_at = f"transform({fits}, fit -> fit <> out)"
    rows = lists.select(*one, F.posexplode(F.arrays_zip("all", F.expr(drawn_at).alias("yes"))).alias("k", "x"))
    return rows.select(*one, "x.all.*", (-1 - F.col("k")).cast("long").alias("block"), F.col("x.yes").alias("last"))


#: Draws look at so many blocks on either side of the likeliest number; a source has some 13,000 at most, so others weigh under 1e-26.
REACH = 640

# The weights of numbers to draw, SQL for either engine: from the likeliest, m, up to hi, then from m down to lo, each from the
# one before (a.w). Of d: own (blocks of the source), rest (of the sources after it), need (blocks to draw from both), up (hi - m).
_AT = "case when i < d.up then d.m + i else d.m - (i - d.up) end"
_NUMERATOR = f"case when i < d.up then (d.own - ({_AT})) * (d.need - ({_AT})) else ({_AT}) * (d.rest - d.need + ({_AT})) end"
_DENOMINATOR = f"case when i < d.up then ({_AT} + 1) * (d.rest - d.need + ({_AT}) + 1) else (d.own - ({_AT}) + 1) * (d.need - ({_AT}) + 1) end"
_WEIGHT = f"((case when i = d.up then cast(1 as double) else a.w end) * ({_NUMERATOR}) / ({_DENOMINATOR}))"
_REACHED = "case when i < d.up then d.m + i + 1 else d.m - (i - d.up) - 1 end"
_FOUND = "coalesce(a.f, case when d.x < a.t + a.w then a.k end)"
_MODE = "greatest(d.need - d.rest, 0, least(d.own, d.need, (d.need + 1) * (d.own + 1) {div} (d.own + d.rest + 2)))"
_UP = f"least(d.own, d.need, d.m + {REACH}) - d.m"
_STEPS = f"d.up + d.m - greatest(0, d.need - d.rest, d.m - {REACH})"


def _draw() -> str:
    """SQL for how many of t.need blocks come from source x, if t.rest blocks are left from it on; d.u is the chance."""
    let = "transform(array(struct({0})), d -> {1})[0]"
    sums = f"aggregate(sequence(0L, d.steps), struct(1.0D as w, 0.0D as t), (a, i) -> if(i >= d.steps, a, struct({_WEIGHT} as w, a.t + a.w as t)), a -> a.t + a.w)"
    found = f"aggregate(sequence(0L, d.steps), struct(1.0D as w, 0.0D as t, d.m as k, cast(null as bigint) as f), (a, i) -> if(i >= d.steps, a, struct({_WEIGHT} as w, a.t + a.w as t, {_REACHED} as k, {_FOUND} as f)), a -> coalesce({_FOUND}, d.m))"
    own = "d.own as own, d.rest as rest, d.need as need, d.u as u, d.m as m"
    inner = let.format(f"{own}, d.up as up, d.steps as steps, d.u * {sums} as x", found)
    inner = let.format(f"{own}, d.up as up, {_STEPS} as steps", inner)
    inner = let.format(f"{own}, {_UP} as up", inner)
    inner = let.format(f"d.own as own, d.rest as rest, d.need as need, d.u as u, {_MODE.format(div='div')} as m", inner)
    chance = f"cast(conv(substr(md5(concat_ws(':', '{SEED}', cast(t.low as string), cast(t.high as string), cast(x.src as string))), 1, 13), 16, 10) as bigint) / 4503599627370496.0D"
    return let.format(f"x.n as own, t.rest - x.n as rest, t.need as need, {chance} as u", inner)


def tree(counts: DataFrame, shards: int) -> DataFrame:
    """Blocks of each source (src, n) for each shard (src, shard, n) by a multivariate-hypergeometric splitting tree.

    A node is a range of shards with the blocks that each source has in it.
    Its left half gets its share of all of them; how many of a source's, given
    those of the sources before, is a hypergeometric draw.
    """
    own = F.struct(F.col("src").cast("long").alias("src"), F.col("n").cast("long").alias("n"))
    rows = counts.agg(F.sort_array(F.collect_list(own)).alias("all"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"))
    rows = rows.select(F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "all", "total")
    none = "cast(array() as array<struct<src: bigint, n: bigint>>)"
    step = f"""(t, x) -> transform(array({_draw()}), k -> struct(t.low as low, t.high as high, t.need - k as need, t.rest - x.n as rest,
        array_append(t.a, struct(x.src as src, k as n)) as a, array_append(t.b, struct(x.src as src, x.n - k as n)) as b))[0]"""
    share, middle = "(total * ((low + high) div 2 - low) div (high - low))", "(low + high) div 2"
    halves = f"""aggregate(all, struct(low as low, high as high, {share} as need, total as rest, {none} as a, {none} as b), {step},
        t -> array(struct(low as low, {middle} as high, t.a as all, {share} as total), struct({middle} as low, high as high, t.b as all, total - {share} as total)))"""
    for _ in range(max(0, (shards - 1).bit_length())):
        rows = written(rows.select(F.expr(f"inline(if(high - low > 1, {halves}, array(struct(low, high, all, total))))")), "nodes")
    return rows.select(F.col("low").cast("int").alias("shard"), F.explode("all").alias("x")).select("x.src", "shard", "x.n")


def split(blocks: DataFrame, shards: int) -> DataFrame:
    """``blocks`` (src, pass, block) with their shard: each source's blocks, permuted, are cut as the tree says."""
    blocks = written(blocks, "blocks")
    cuts = tree(blocks.groupBy("src").agg(F.count("*").alias("n")), shards)
    cuts = cuts.withColumn("upto", F.sum("n").over(W.partitionBy("src").orderBy("shard"))).select("src", "shard", (F.col("upto") - F.col("n")).alias("first"), "upto")
    places = blocks.withColumn("place", F.row_number().over(W.partitionBy("src").orderBy(_key("src", "pass", "block"), "pass", "block")) - 1)
    return places.join(written(cuts, "cuts"), "src").where("place >= first and place < upto").select("src", "pass", "block", "shard")


def drawn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = SHARDS) -> DataFrame:
    """One row for each id, source and size: n (rows that share them), source_size, target and shards (the output shard of each time it is taken)."""
    sizes = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    sizes = written(sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    of = written(targets(sizes), "targets")
    docs = sizes.join(of, sizes.source.eqNullSafe(of.source)).drop(of.source)
    docs = docs.withColumn("at", _key("doc_id"))
    longs = written(long_documents(docs), "longs")
    took = longs.groupBy("src").agg(F.sum("words").alias("long_words"), F.sum(F.when(F.col("last"), F.col("words")).otherwise(0)).alias("taken"))
    of = of.join(took, "src", "left").na.fill(0, ["long_words", "taken"]).withColumn("rest", F.col("source_size") - F.col("long_words"))
    of = of.withColumn("block_words", F.expr(f"greatest(1, (rest + {BLOCKS - 1}) div {BLOCKS})"))
    of = of.withColumn("quota", F.expr("cast(round((target - f * source_size - taken) / block_words) as bigint)"))
    of = written(of.select("src", "f", "rest", "block_words", "quota"), "quotas")
    docs = docs.where(f"not {IS_LONG}").join(of.select("src", "block_words"), "src").withColumn("bucket", F.left("at", F.lit(3)))
    sums = docs.groupBy("src", "bucket").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    sums = sums.withColumn("base", F.sum("words").over(W.partitionBy("src").orderBy("bucket")) - F.col("words")).drop("words")
    within = W.partitionBy("src", "bucket").orderBy("at", "doc_id", "size")
    docs = docs.withColumn("inside", F.sum(F.col("size") * F.col("n")).over(within)).join(sums, ["src", "bucket"])
    docs = docs.withColumn("block", F.expr("(2 * (base + inside) - size * n) div (2 * block_words)"))
    whole = ["doc_id", "source", "size", "n", "source_size", "target", "src", "block"]
    docs = docs.select(*whole).unionAll(longs.select(*whole))
    passes = F.explode(F.expr(f"sequence(0, {MOST_TIMES - 1})")).alias("pass")
    tops = of.select("*", passes).withColumn("top", F.expr("case when pass < f then rest div block_words + 1 when pass = f then quota else 0 end"))
    blocks = tops.where("top > 0").select("src", "pass", F.explode(F.expr("sequence(0L, top - 1)")).alias("block"))
    blocks = blocks.unionAll(longs.select("src", "f", "last", "block", passes).where("pass < f or pass = f and last").select("src", "pass", "block"))
    places = split(blocks, shards).groupBy("src", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("places"))
    docs = docs.join(places, ["src", "block"], "left")
    return docs.select("doc_id", "source", "size", "n", "source_size", "target", F.coalesce("places.shard", F.expr("cast(array() as array<int>)")).alias("shards"))


def mix_counts(df: DataFrame) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken, copies and shards (where it goes each time, as text)."""
    rows = drawn(df).withColumn("_", F.explode(F.expr("sequence(1L, n)")))
    times = F.size("shards")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"), times.alias("copies"), F.array_join("shards", ",").alias("shards"))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = SHARDS) -> DataFrame:
    """The mix: rows of ``df`` as often as they are taken, with shard and a random key for the order in the shard."""
    plan = drawn(df, id_col, text_col, source_col, shards).where(F.size("shards") > 0)
    plan = plan.select("doc_id", F.col("source").alias("_source"), F.col("size").alias("_size"), "shards")
    plan = plan.select(*[F.col(c).alias(f"{fresh(df, '_plan')}{k}") for k, c in enumerate(plan.columns)])
    i, s, z, to = plan.columns
    on = df[id_col].eqNullSafe(F.col(i)) & df[source_col].eqNullSafe(F.col(s)) & (n_words(df[text_col]) == F.col(z))
    shard, order = fresh(df, "shard"), fresh(df, "shard_order")
    rows = df.join(plan, on).select(*[df[c] for c in df.columns], F.posexplode(to).alias(f"{to}p", shard))
    return rows.withColumn(order, F.xxhash64(F.lit(SEED), F.col(id_col), F.col(f"{to}p"), F.col(shard))).drop(f"{to}p")


def _duck_step() -> str:
    let = "list_transform([{{{0}}}], lambda d: {1})[1]"
    sums = f"list_transform([list_reduce(range(0, d.steps), lambda a, i: {{'w': {_WEIGHT}, 't': a.t + a.w}}, {{'w': 1::double, 't': 0::double}})], lambda a: a.t + a.w)[1]"
    found = f"list_transform([list_reduce(range(0, d.steps), lambda a, i: {{'w': {_WEIGHT}, 't': a.t + a.w, 'k': {_REACHED}, 'f': {_FOUND}}}, {{'w': 1::double, 't': 0::double, 'k': d.m, 'f': null::bigint}})], lambda a: coalesce({_FOUND}, d.m))[1]"
    own = "'own': d.own, 'rest': d.rest, 'need': d.need, 'u': d.u, 'm': d.m"
    inner = let.format(f"{own}, 'up': d.up, 'steps': d.steps, 'x': d.u * {sums}", found)
    inner = let.format(f"{own}, 'up': d.up, 'steps': {_STEPS}", inner)
    inner = let.format(f"{own}, 'up': {_UP}", inner)
    inner = let.format(f"'own': d.own, 'rest': d.rest, 'need': d.need, 'u': d.u, 'm': {_MODE.format(div='//')}", inner)
    chance = f"cast('0x' || substr(md5(concat_ws(':', '{SEED}', t.low, t.high, x.src)), 1, 13) as bigint) / 4503599627370496::double"
    one = let.format(f"'own': x.n, 'rest': t.rest - x.n, 'need': t.need, 'u': {chance}", inner)
    return f"list_transform([{one}], lambda k: {{'low': t.low, 'high': t.high, 'need': t.need - k, 'rest': t.rest - x.n, 'took': list_append(t.took, k)}})[1]"


_DUCK_STEP = _duck_step()

#: SQL for the rows of ``mix_counts`` over documents.
ORACLE = rf"""
    with recursive z as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
    g as (select doc_id, source, size, count(*) as n from z group by 1, 2, 3),
    a as (select source, cast(sum(size * n) as bigint) as source_size, row_number() over (order by source nulls last) as src from g group by 1),
    b as (select *, (src - 1) % 3 + 1 as weight, source_size * {MOST_TIMES} / ((src - 1) % 3 + 1) as full_at from a),
    c as (select *, cast(sum(source_size) over () - coalesce(sum(source_size) over w, 0) * {MOST_TIMES} as bigint) / cast(sum(weight) over () - coalesce(sum(weight) over w, 0) as bigint) as level
          from b window w as (order by full_at, src rows between unbounded preceding and 1 preceding)),
    d as (select *, least(source_size * {MOST_TIMES}.0::double, (select level from c where full_at >= level order by full_at, src limit 1) * weight) as target from c),
    e as (select *, case when source_size > 0 then cast(floor(target / source_size) as int) else 0 end as f from d),
    docs as (select g.*, e.src, e.source_size, e.target, e.f, md5(concat_ws(':', '{SEED}', coalesce(cast(doc_id as varchar), '-'))) as perm, size * n * {LONG} > source_size as is_long
             from g join e on g.source is not distinct from e.source),
    lists as (select src, f, target, source_size, sum(size * n) as every, list({{'perm': perm, 'doc_id': doc_id, 'size': size, 'n': n, 'words': size * n}} order by perm, doc_id, size) as everyone
              from docs where is_long group by 1, 2, 3, 4),
    shares as (select *, (target - f * source_size) * every / source_size as share from lists),
    fits as (select *, share * 2 > every as out, list_reduce(everyone, lambda t, x: {{'rest': t.rest - case when x.words <= t.rest then x.words else 0 end, 'yes': list_append(t.yes, x.words <= t.rest)}},
             {{'rest': case when share * 2 > every then every - share else share end, 'yes': cast([] as boolean[])}}) as r from shares),
    longs as (select src, unnest(everyone) as x, unnest(r.yes) <> out as last, -unnest(range(1, len(everyone) + 1)) as block from fits),
    took as (select src, sum(x.words) as long_words, sum(case when last then x.words else 0 end) as taken from longs group by 1),
    rests as (select e.src, source_size - coalesce(long_words, 0) as rest, greatest(1, (source_size - coalesce(long_words, 0) + {BLOCKS - 1}) // {BLOCKS}) as bw, target - f * source_size - coalesce(taken, 0) as wanted
              from e left join took on e.src = took.src),
    small as (select docs.*, bw, cast(round(wanted / bw) as bigint) as quota, cast(sum(size * n) over (partition by docs.src order by perm, doc_id, size) as bigint) as upto from docs join rests on docs.src = rests.src where not is_long),
    passes as (select unnest(range({MOST_TIMES})) as pass),
    blocks as (select src, pass, unnest(range(cast(case when pass < f then rest // bw + 1 when pass = f then quota else 0 end as bigint))) as block
               from (select e.src, f, rest, bw, cast(round(wanted / bw) as bigint) as quota from rests join e on e.src = rests.src) t, passes
               union all select longs.src, pass, block from longs join e on e.src = longs.src, passes where pass < f or pass = f and last),
    numbers as (select list({{'src': src, 'n': n}} order by src) as everything, cast(sum(n) as bigint) as total from (select src, count(*) as n from blocks group by 1) t),
    nodes as (select 0::bigint as low, {SHARDS}::bigint as high, everything, total from numbers
              union all
              select case when side = 0 then low else middle end, case when side = 0 then middle else high end,
                     list_transform(everything, lambda x, i: {{'src': x.src, 'n': case when side = 0 then took[i] else x.n - took[i] end}}), case when side = 0 then share else total - share end
              from (select *, list_reduce(everything, lambda t, x: {_DUCK_STEP}, {{'low': low, 'high': high, 'need': share, 'rest': total, 'took': cast([] as bigint[])}}).took as took
                    from (select *, (low + high) // 2 as middle, total * ((low + high) // 2 - low) // (high - low) as share from nodes where high - low > 1) u) v, (select unnest([0, 1]) as side) w),
    leaves as (select low as shard, unnest(everything) as x from nodes where high - low = 1),
    cuts as (select x.src as src, shard, sum(x.n) over (partition by x.src order by shard) - x.n as start, sum(x.n) over (partition by x.src order by shard) as upto from leaves),
    dealt as (select *, row_number() over (partition by src order by md5(concat_ws(':', '{SEED}', src, pass, block)), pass, block) - 1 as place from blocks),
    placed as (select d.src, d.block, string_agg(shard, ',' order by pass) as shards, count(*) as copies from dealt d join cuts c on c.src = d.src and place >= start and place < upto group by 1, 2),
    times as (select doc_id, source, size, source_size, target, n, src, (2 * upto - size * n) // (2 * bw) as block from small
              union all select docs.doc_id, docs.source, docs.size, docs.source_size, docs.target, docs.n, docs.src, block
              from docs join longs on docs.src = longs.src and docs.doc_id is not distinct from longs.x.doc_id and docs.size = longs.x.size where docs.is_long)
    select doc_id, size, source_size, target, cast(size * coalesce(copies, 0) as bigint) as taken, cast(coalesce(copies, 0) as int) as copies, coalesce(shards, '') as shards
    from times left join placed on times.src = placed.src and times.block = placed.block, unnest(range(n)) as k"""
