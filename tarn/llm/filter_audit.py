"""Filter interaction audit: what each of five filters removes, at each place of each order, by a recursive CTE.

A document is judged once: its failed filters are the bits of a mask, and all
that any order can do to it follows from the mask. So documents become mask
cells (counts by part and mask, 32 a part at most), and a recursive query walks
the prefixes of orders: each level extends a prefix by an unused letter, joins
the mask cells, carries the bits applied so far and emits what that step does
to each cell (kept, removed, redundant). Prefixes are shared by the orders that
start with them, so the walk has 326 x 32 rows whatever the table's size and
the number of parts; counts are joined to it by mask.

Filter E (text of a smaller id) needs no window over copies: rows are counted
by text and part first, the least id of a text comes from those counts, and
whatever stands above it fails. A text that a third of all rows share is some
rows a part by then.

Defined cases: a null text is empty (no words: not under filter B, C or D, but
A) and equal to other empty ones. Null sources are part '', as empty ones are.
Rows without an id never fail E and make no other row fail it; of rows that
share an id and a text none is smaller. A document with several labels is good
or toxic if any of them says so; a document without labels is neither. Empty
tables give an empty result. Columns other than those named aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, written

LETTERS = "ABCDE"
E_BIT = 1 << LETTERS.index("E")
#: Orders that start with a prefix, by its length: (5 - length)!
COMPLETIONS = (120, 24, 6, 2, 1, 1)

#: The walk over prefixes. Each level adds a letter that isn't applied yet and emits, for every mask cell, what the step does.
WALK = """
with recursive walk(prefix, letter, step, applied, mask, fails, earlier) as (
    select '', '', 0, 0, mask, false, false from {masks}
    union all
    select concat(w.prefix, x.letter), x.letter, w.step + 1, w.applied | x.bit, c.mask, (c.mask & x.bit) <> 0, (c.mask & w.applied) <> 0
    from (select *, explode(array(struct('A' as letter, 1 as bit), struct('B' as letter, 2 as bit), struct('C' as letter, 4 as bit),
                                  struct('D' as letter, 8 as bit), struct('E' as letter, 16 as bit))) as x from walk) w
    join {masks} c on c.mask = w.mask
    where w.applied & x.bit = 0
)
select prefix, letter, step, mask, (mask & applied) = 0 as kept, fails and not earlier as removed, fails and earlier as redundant,
       fails and (mask & (mask - 1)) = 0 as alone
from walk where step > 0"""


def failed(text: Column) -> Column:
    """The bits of filters A to D that a text fails."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    n = F.size(words)
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    rules = [n < 50, F.size(F.array_distinct(words)) * 100 < n * 65, capitals * 100 > F.char_length(text) * 5, text.rlike("[#$%&*|]")]
    return sum((F.when(rule, 1 << k).otherwise(0) for k, rule in enumerate(rules)), F.lit(0))


def mask_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Documents counted by part and mask: n, good and toxic."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("part"), F.sha2(text, 256).alias("same"), failed(text).alias("bits"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = rows.join(marks, "id", "left").na.fill(False, ["good", "toxic"])
    keys = ["same", "part", "bits", "good", "toxic"]
    by_id = rows.groupBy(*keys, "id").agg(F.count("*").alias("n"))
    groups = written(by_id.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("n_named"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least")), "texts")
    first = groups.groupBy("same").agg(F.min("least").alias("first"))
    fail = F.col("n_named") - F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    both = groups.join(first, "same").withColumn("copies", fail)
    both = both.select("part", "good", "toxic", F.explode(F.array(F.struct(F.col("bits").alias("mask"), (F.col("n") - F.col("copies")).alias("n")), F.struct(F.col("bits").bitwiseOR(E_BIT).alias("mask"), F.col("copies").alias("n")))).alias("x"))
    both = both.select("part", "x.mask", "x.n", "good", "toxic").where("n > 0")
    marked = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return both.groupBy("part", "mask").agg(F.sum("n").alias("n"), marked("good"), marked("toxic"))


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row for each part, order of the filters and step; see the module's head."""
    spark = docs.sparkSession
    cells = written(mask_cells(docs, labels, **columns), "cells")
    masks = written(cells.select("mask").distinct(), "masks")
    walk = written(spark.sql(WALK, masks=masks), "walk")  # 326 x 32 rows at most
    counted = lambda what, n, name: F.sum(F.when(F.col(what), F.col(n)).otherwise(0)).alias(name)
    steps = cells.join(F.broadcast(walk), "mask").groupBy("part", "prefix", "letter", "step").agg(
        counted("kept", "n", "kept"), counted("removed", "n", "removed"), counted("redundant", "n", "redundant"), counted("alone", "n", "unique_fails"),
        counted("removed", "good", "good_lost"), counted("removed", "toxic", "toxic_lost"),
    )
    orders = F.element_at(F.array(*map(F.lit, COMPLETIONS)), F.col("step") + 1)
    shares = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    whole = walk.where("step = 5").select(F.col("prefix").alias("filter_order")).distinct()
    places = whole.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("_step")).withColumn("prefix", F.expr("substring(filter_order, 1, _step)")).drop("_step")
    rows = steps.join(shares, ["part", "letter"]).join(F.broadcast(places), "prefix")
    return rows.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


#: The same for DuckDB, counted step by step for each order.
SQL = r"""
with recursive marks as (
    select doc_id, coalesce(max(quality = 1), false) as good, coalesce(max(toxic = 1), false) as toxic from labels where doc_id is not null group by 1
), words as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), masks as (
    select d.doc_id, part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
           case when len(w) < 50 then 1 else 0 end
           + case when 100 * len(list_distinct(w)) < 65 * len(w) then 2 else 0 end
           + case when 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * len(text) then 4 else 0 end
           + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
           + case when d.doc_id > min(d.doc_id) over (partition by text) then 16 else 0 end as mask
    from words d left join marks m on m.doc_id = d.doc_id
), cells as (
    select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from masks group by 1, 2
), letters as (
    select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(letter, bit)
), orders as (
    select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order
    from letters a, letters b, letters c, letters d, letters e where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps as (
    select filter_order, step, l.letter, l.bit,
           coalesce((select sum(p.bit) from letters p where instr(substring(filter_order, 1, step - 1), p.letter) > 0), 0)::bigint as earlier
    from orders cross join (select unnest([1, 2, 3, 4, 5]) as step) s join letters l on l.letter = substring(filter_order, step, 1)
), counted as (
    select part, filter_order, step, letter,
           sum(case when mask & (earlier + bit) = 0 then n else 0 end)::bigint as kept,
           sum(case when mask & bit <> 0 and mask & earlier = 0 then n else 0 end)::bigint as removed,
           sum(case when mask & bit <> 0 and mask & earlier <> 0 then n else 0 end)::bigint as redundant,
           sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
           sum(case when mask & bit <> 0 and mask & earlier = 0 then good else 0 end)::bigint as good_lost,
           sum(case when mask & bit <> 0 and mask & earlier = 0 then toxic else 0 end)::bigint as toxic_lost
    from cells cross join steps group by 1, 2, 3, 4
)
select part, filter_order, cast(step as int) as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from counted"""
