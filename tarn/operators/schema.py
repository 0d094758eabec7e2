"""Schemas from messy JSON: inference over all records, a type lattice, casts and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions.timestamps import looks_like_timestamp, narrow
from tarn.sources.folders import written

# The lattice. Numbers promote in this order; any other mix is text.
NUMERIC_RANK = {"bigint": 1, "double": 2}


#: Element types of arrays; other arrays and mixed ones are ``array``, whose elements are text, and empty ones tell nothing.
ELEMENTS = {"BIGINT": "array<bigint>", "DOUBLE": "array<double>", "BOOLEAN": "array<boolean>", "VOID": "array<null>"}


def fields(records: DataFrame, record: str = "record", by: list[str] | None = None) -> DataFrame:
    """One row for each top-level field of each record: field, kind (see ``kind_of``) and value, after the columns ``by``."""
    by = by or []
    exploded = records.select(*by, F.col(record).alias("_r")).lateralJoin(records.sparkSession.tvf.variant_explode(F.col("_r").outer()))
    described = exploded.select(*by, F.col("key").alias("field"), "value", F.schema_of_variant("value").alias("_as"))
    return described.select(*by, "field", kind_of(F.col("value"), F.col("_as")).alias("kind"), "value")


def kind_of(value: Column, described: Column | None = None) -> Column:
    """The lattice type of one JSON value: bigint, double, boolean, timestamp, string, null, array or array of a type."""
    kind = F.schema_of_variant(value) if described is None else described
    text = value.try_cast("string")
    element = F.regexp_replace(F.regexp_extract(kind, "^ARRAY<(.*)>$", 1), "^DECIMAL.*", "DOUBLE")
    arrays = F.lit("array")
    for name, own in ELEMENTS.items():
        arrays = F.when(element == name, own).otherwise(arrays)
    return (
        F.when(kind == "VOID", "null").when(kind == "BOOLEAN", "boolean").when(kind == "BIGINT", "bigint")
        .when((kind == "DOUBLE") | kind.startswith("DECIMAL"), "double")
        .when(kind.startswith("ARRAY"), arrays).when(kind.startswith("OBJECT"), "string")
        .when(looks_like_timestamp(text), "timestamp").otherwise("string")
    )


def reconciled(kinds: Column) -> Column:
    """The common type of a set of kinds: nulls are no evidence, numbers promote, also in arrays, other mixes are text, none is text."""
    known = F.array_remove(kinds, "null")
    all_of = lambda *names: F.forall(known, lambda k: k.isin(*names))
    some = F.array_remove(known, "array<null>")  # empty arrays agree with any array
    return (
        F.when(F.size(known) == 0, "string")
        .when(F.forall(known, lambda k: k.startswith("array")), F.when(F.size(some) == 1, some[0]).when((F.size(some) > 1) & F.forall(some, lambda k: k.isin("array<bigint>", "array<double>")), "array<double>").otherwise("array"))
        .when(F.size(known) == 1, known[0]).when(all_of(*NUMERIC_RANK), "double").otherwise("string")
    )


def common_kind(kinds: list[str]) -> str:
    """``reconciled`` for a few kinds on the driver: the type of a field from all kinds that it has had."""
    known = {k for k in kinds if k != "null"}
    some = known - {"array<null>"}
    if not known:
        return "string"
    if all(k.startswith("array") for k in known):
        return next(iter(some)) if len(some) == 1 else "array<double>" if some and some <= {"array<bigint>", "array<double>"} else "array"
    return next(iter(known)) if len(known) == 1 else "double" if known <= set(NUMERIC_RANK) else "string"


def observed(records: DataFrame, record: str = "record", by: list[str] | None = None) -> DataFrame:
    """One row for each field over all records (of each group): field and the kinds of its values."""
    return fields(records, record, by).groupBy(*(by or []), "field").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def observed_leaves(records: DataFrame, delimiter: str, record: str = "record", by: list[str] | None = None) -> DataFrame:
    """One row for each leaf of all records: field (names joined by the delimiter; the first of them where the leaf has no path), path and kinds."""
    by = by or []
    rows = leaves(records.select(F.struct(*(by or [F.lit(0)])).alias("_key"), record), "_key", record)
    rows = rows.select(*[F.col(f"_k.{c}") for c in by], F.when(F.col("path").isNull(), F.get("names", F.lit(0))).otherwise(F.array_join("names", delimiter)).alias("field"), "path", kind_of(F.col("v"), F.schema_of_variant("v")).alias("kind"))
    return rows.groupBy(*by, "field", "path").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def inferred(records: DataFrame, record: str = "record") -> DataFrame:
    """One row for each field over all records: field, type, n (values) and nulls, by name.

    Values are counted by field and kind before any schema is built, so the
    shuffle carries a few rows a task however many records there are.
    """
    counted = fields(records, record).groupBy("field", "kind").agg(F.count("*").alias("n"))
    return (
        counted.groupBy("field")
        .agg(reconciled(F.collect_set("kind")).alias("type"), F.sum("n").alias("n"), F.sum(F.when(F.col("kind") == "null", F.col("n")).otherwise(0)).alias("nulls"))
        .orderBy("field")
    )


def inferred_leaves(records: DataFrame, delimiter: str, record: str = "record") -> DataFrame:
    """One row for each leaf of all records: field (names joined by the delimiter), path (of JSON), type, n and nulls."""
    rows = leaves(records.select(F.lit(0).alias("_key"), record), "_key", record)
    rows = rows.select(F.array_join("names", delimiter).alias("field"), "path", F.col("v").alias("value"), F.schema_of_variant("v").alias("_as"))
    counted = rows.select("field", "path", kind_of(F.col("value"), F.col("_as")).alias("kind")).groupBy("field", "path", "kind").agg(F.count("*").alias("n"))
    total = F.sum("n").alias("n"), F.sum(F.when(F.col("kind") == "null", F.col("n")).otherwise(0)).alias("nulls")
    return counted.groupBy("field", "path").agg(reconciled(F.collect_set("kind")).alias("type"), *total).orderBy("field", "path")


def sampled(records: DataFrame, per_file: int, path: str = "path", order: str = "value") -> DataFrame:
    """The first records of every file, in the order of a column; rows of a text scan have no other order."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(path).orderBy(order))
    return records.withColumn("_n", place).where(F.col("_n") <= per_file).drop("_n")


def json_path(name: str) -> str:
    """The path of a top-level field. A name with both kinds of quotes can't be written as a path."""
    if "'" in name and '"' in name:
        raise ValueError(f"no path for a field with both kinds of quotes: {name}")
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def json_path_or_none(name: str) -> str | None:
    return None if "'" in name and '"' in name else json_path(name)


def misfits(record: Column, columns: list[tuple[str, Column, Column, str]], unaddressed: list[str]) -> Column:
    """What the columns (field, value, its schema, kind) of a record don't hold, as a VARIANT object by field; null if they hold all.

    Kinds are those of all values of a field (``common_kind``), so whole
    numbers, booleans, timestamps and texts always fit. What is left is a list
    whose cast is null, a number with more digits than a double has, and the
    top-level fields ``unaddressed``.
    """
    parts = []
    for field, value, own, kind in columns:
        if kind != "double" and not kind.startswith("array"):
            continue
        if kind != "double":
            lost = (own != "VOID") & cast_value(value, own, kind).isNull()
        else:
            lost = ((own == "BIGINT") & (F.abs(value.try_cast("bigint")) > (1 << 53))) | own.rlike(r"^DECIMAL\((1[89]|[2-9][0-9]),")
        parts.append(F.when(lost, F.struct(F.lit(field).alias("key"), value.alias("value"))))
    found = F.array_compact(F.array(*parts)) if parts else None
    if unaddressed:
        odd = F.map_entries(F.map_filter(F.try_variant_get(record, "$", "map<string, variant>"), lambda k, _: k.isin(*unaddressed)))
        found = odd if found is None else F.concat(found, odd)
    if found is None:
        return F.lit(None).cast("variant")
    return F.when(F.size(found) > 0, F.to_variant_object(F.map_from_entries(found)))


def cast_path(record: Column, path: str, kind: str) -> Column:
    """The value at a path as a type; null if it is absent or isn't of that type (true is no number, text is none)."""
    value = F.try_variant_get(record, path, "variant")
    return cast_value(value, F.schema_of_variant(value), kind)


def cast_value(value: Column, own: Column, kind: str) -> Column:
    """A value, with its schema ``own``, as a type; see ``cast_path``."""
    text = value.try_cast("string")  # only what the type needs is asked; texts are matched for timestamps alone
    if kind == "bigint":
        return F.when(own == "BIGINT", value.try_cast("bigint"))
    if kind == "double":
        return F.when(own.isin("BIGINT", "DOUBLE") | own.startswith("DECIMAL"), value.try_cast("double"))
    if kind == "boolean":
        return F.when(own == "BOOLEAN", value.try_cast("boolean"))
    if kind == "timestamp":
        return F.when(own == "STRING", narrow(text))
    if kind == "string":
        return F.when(own == "STRING", text).when(own != "VOID", F.to_json(value))
    if kind == "array":
        return F.when(own.startswith("ARRAY"), F.try_variant_get(value, "$", "array<string>"))
    elements = {"array<bigint>": ["BIGINT"], "array<double>": ["BIGINT", "DOUBLE"], "array<boolean>": ["BOOLEAN"]}[kind]
    fits = own.isin(*[f"ARRAY<{e}>" for e in (*elements, "VOID")])
    return F.when(fits | own.startswith("ARRAY<DECIMAL") if "DOUBLE" in elements else fits, F.try_variant_get(value, "$", kind))


def cast_field(record: Column, name: str, kind: str) -> Column:
    """A top-level field as a type; see ``cast_path``."""
    return cast_path(record, json_path(name), kind)


def array_facts(record: Column, name: str) -> tuple[Column, Column]:
    """How many elements an array field has, and the first of them as text; null for what is no array."""
    values = cast_field(record, name, "array")
    return F.when(values.isNotNull(), F.size(values)), F.get(values, F.lit(0))


def projected(records: DataFrame, schema: list[tuple[str, str]], record: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the fields of ``schema`` (name, kind) as columns, after the columns to keep."""
    return records.select(*keep, *[cast_field(F.col(record), name, kind).alias(name) for name, kind in schema])


def cast_losses(records: DataFrame, schema: list[tuple[str, str]], record: str = "record") -> DataFrame:
    """One row for each field of ``schema``: field, type, n (values that aren't null) and lost (those that the cast makes null); one pass."""
    parts = []
    for name, kind in schema:
        there = F.coalesce(F.schema_of_variant(F.try_variant_get(record, json_path(name), "variant")) != "VOID", F.lit(False))
        lost = there & cast_field(F.col(record), name, kind).isNull()
        parts.append(F.struct(F.lit(name).alias("field"), F.lit(kind).alias("type"), F.count_if(there).alias("n"), F.count_if(lost).alias("lost")))
    return records.agg(F.array(*parts).alias("all")).select(F.inline("all"))


def rest(record: Column, names: list[str]) -> Column:
    """The fields of a record that aren't among ``names``, as JSON in the order of their names; null if there are none."""
    others = F.map_filter(F.try_variant_get(record, "$", "map<string, variant>"), lambda k, _: ~k.isin(names))
    return F.when(F.size(others) > 0, F.to_json(others))


def leaves(records: DataFrame, key: str, record: str = "record", depth: int | None = None) -> DataFrame:
    """One row for each leaf of each record: _k (the key), names (array), path (of JSON; null where a name has both quotes) and v (VARIANT).

    Objects and arrays are opened level by level, each level from the one
    before, which is written to a working folder, until none is left (or
    ``depth`` levels are open); an empty one is a leaf.
    """
    spark = records.sparkSession
    level = records.select(F.col(key).alias("_k"), F.expr("cast(array() as array<string>)").alias("names"), F.lit("$").alias("path"), F.col(record).alias("v"))
    found = None
    while True:
        opened = level.withColumnsRenamed({"names": "_n", "path": "_p"}).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        by_name = F.when(~F.contains("key", F.lit("'")), F.concat(F.lit("['"), "key", F.lit("']"))).when(~F.contains("key", F.lit('"')), F.concat(F.lit('["'), "key", F.lit('"]')))
        step = F.when(F.col("key").isNotNull(), by_name).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        opened = opened.select("_k", F.array_append("_n", F.coalesce("key", F.col("pos").cast("string"))).alias("names"), F.concat("_p", step).alias("path"), F.col("value").alias("v"))
        kind = F.schema_of_variant("v")
        inner = (kind.startswith("OBJECT") | kind.startswith("ARRAY")) & ~F.to_json("v").isin("{}", "[]")
        depth = None if depth is None else depth - 1
        opened = written(opened.withColumn("inner", inner if depth != 0 else F.lit(False)), "level")
        closed = opened.where("not inner").drop("inner")
        found = closed if found is None else found.unionAll(closed)
        level = opened.where("inner").drop("inner")
        if not level.head(1):
            return found


def flattened(records: DataFrame, key: str, record: str = "record", delimiter: str = ".", depth: int | None = None) -> DataFrame:
    """One row for each leaf of each record: key, path (names and array places joined by the delimiter) and value (text).

    What lies below ``depth`` levels, if that is given, stays as JSON text. The
    delimiter joins names only and leaves values alone.
    """
    text = F.when(F.schema_of_variant("v") == "STRING", F.col("v").try_cast("string")).otherwise(F.to_json("v"))
    return leaves(records, key, record, depth).select(F.col("_k").alias(key), F.array_join("names", delimiter).alias("path"), text.alias("value"))
