"""Golden cases of the lake operators, one for each deliberate choice of semantics."""

import gzip
import itertools
import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarn.functions import layout, rules, timestamps
from tarn.operators import analytics, catalog, evolution, pack, registry, schema
from tarn.sources import ndjson


def records(spark, *lines):
    return ndjson.records(spark.createDataFrame([(x,) for x in lines], "value string"))


def types(spark, *lines):
    return {r.field: r.type for r in schema.inferred(records(spark, *lines)).collect()}


def test_lines_that_are_no_records(spark):
    lines = ["", "  ", "null", "[1]", '"x"', "5", '{"a":', '{"a":1}', None, '{"a":1,"a":2}']
    out = ndjson.classified(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.status for r in out] == ["blank", "blank", *["not an object"] * 4, "not json", "valid", "blank", "valid"]
    counts = {r[0]: r[1] for r in ndjson.classified(spark.createDataFrame([(x,) for x in lines], "value string")).groupBy("status").count().collect()}
    assert sum(counts.values()) == len(lines)
    assert {r.reason for r in ndjson.quarantined(spark.createDataFrame([(x,) for x in lines], "value string")).collect()} == {"not json", "not an object"}
    assert records(spark, '{"a":1,"a":2}').select(schema.cast_field(F.col("record"), "a", "bigint")).first()[0] == 2  # the last of equal keys


def test_inference(spark):
    assert types(spark, '{"a":null}', '{"a":1}') == {"a": "bigint"}  # null is no evidence
    assert types(spark, '{"a":null}') == {"a": "string"}
    assert types(spark, '{"f":true}', '{"f":1}') == {"f": "string"}
    assert types(spark, '{"n":1}', '{"n":1.5}') == {"n": "double"}
    assert types(spark, '{"d":[1]}', '{"d":[]}', '{"d":null}') == {"d": "array<bigint>"}
    assert types(spark, '{"d":[1,2]}', '{"d":[1.5]}', '{"e":[true]}', '{"e":[]}') == {"d": "array<double>", "e": "array<boolean>"}
    assert types(spark, '{"d":[1,"x"]}', '{"e":[1]}', '{"e":["x"]}', '{"f":[]}', '{"g":[1]}', '{"g":2}') == {"d": "array", "e": "array", "f": "array", "g": "string"}
    assert types(spark, '{"t":"2024-01-01T00:00:00Z","o":{"x":1}}') == {"t": "timestamp", "o": "string"}
    late = [f'{{"a":{k}}}' for k in range(1200)] + ['{"late":1}']
    assert types(spark, *late) == {"a": "bigint", "late": "bigint"}
    assert types(spark, '{"x":"' + "y" * 70_000 + '"}') == {"x": "string"}  # lines may be long


def test_lattice_is_a_semilattice(spark):
    kinds = ["bigint", "double", "boolean", "string", "array", "array<bigint>", "array<double>", "array<boolean>"]
    join = {}
    rows = [(list(p),) for n in (1, 2, 3) for p in itertools.combinations(kinds, n)]
    for r in spark.createDataFrame(rows, "k array<string>").select("k", schema.reconciled(F.col("k")).alias("t")).collect():
        join[frozenset(r.k)] = r.t
    for a, b, c in itertools.permutations(kinds, 3):
        assert join[frozenset({join[frozenset({a, b})], c})] == join[frozenset({a, join[frozenset({b, c})]})] == join[frozenset({a, b, c})]


def test_casts_give_null_on_mismatch(spark):
    row = records(spark, '{"b":true,"t":"1.5","n":1000000,"x":1.50,"o":{"k":[1]},"a":[1,"x"],"z":null,"k\'q":7,"i":[1,2],"e":[]}')
    facts = row.select(*schema.array_facts(F.col("record"), "a"), *schema.array_facts(F.col("record"), "e"), *schema.array_facts(F.col("record"), "b")).first()
    assert list(facts) == [2, "1", 0, None, None, None]
    wanted = [("b", "bigint", None), ("t", "double", None), ("n", "string", "1000000"), ("x", "string", "1.5"), ("o", "string", '{"k":[1]}'), ("a", "array", ["1", "x"]), ("z", "string", None), ("n", "double", 1e6), ("k'q", "bigint", 7), ("absent", "string", None)]
    wanted += [("i", "array<bigint>", [1, 2]), ("i", "array<double>", [1.0, 2.0]), ("i", "array<boolean>", None), ("a", "array<bigint>", None), ("e", "array<boolean>", [])]
    out = row.select(*[schema.cast_field(F.col("record"), n, k).alias(f"c{i}") for i, (n, k, _) in enumerate(wanted)]).first()
    assert list(out) == [w for _, _, w in wanted]


def test_event_times(spark):
    cases = {
        '{"timestamp":"2024-01-02T03:04:05Z"}': datetime(2024, 1, 2, 3, 4, 5), '{"timestamp":"2024-01-02T03:04:05.25+02:00"}': datetime(2024, 1, 2, 1, 4, 5, 250000),
        '{"time":"2024-01-02 03:04:05"}': datetime(2024, 1, 2, 3, 4, 5), '{"time":"2024-01-02"}': datetime(2024, 1, 2), '{"time":"2024"}': None, '{"time":"12"}': None,
        '{"time":1700000000}': datetime(2023, 11, 14, 22, 13, 20), '{"time":1700000000123}': datetime(2023, 11, 14, 22, 13, 20, 123000), '{"time":1000000000000}': None,
        '{"InfoTimestamp":"no","created_at":"2024-01-02"}': datetime(2024, 1, 2), '{"x":1}': None, '{"timestamp":true}': None,
    }
    df = records(spark, *cases)
    out = {r[0]: r[1] for r in df.select("value", timestamps.event_time(F.col("record"))).collect()}
    assert out == cases


def test_flattening_joins_names_only(spark):
    rows = records(spark, '{"id":1,"a.b":29.99,"c":{"d":[{"e":"x.y"},[]],"f":{}},"n":null}')
    out = {r.path: r.value for r in schema.flattened(rows.withColumn("key", F.lit(1)), "key", delimiter="_").collect()}
    assert out == {"id": "1", "a.b": "29.99", "c_d_0_e": "x.y", "c_d_1": "[]", "c_f": "{}", "n": "null"}
    shallow = {r.path: r.value for r in schema.flattened(rows.withColumn("key", F.lit(1)), "key", depth=1).collect()}
    assert json.loads(shallow["c"]) == {"d": [{"e": "x.y"}, []], "f": {}}


def test_layout(spark):
    names = ["a/b\\c:d*e", 'x?"<>|~#%', "p..q r", "z" * 60, ""]
    out = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(layout.safe_name(F.col("n"))).collect()]
    assert out == ["a_b_c_d_e", "x________", "p_q_r", "z" * 50, "unknown"]
    with pytest.raises(ValueError, match="unknown partition scheme"):
        layout.partition_path("iceberg", F.lit(None))
    with pytest.raises(ValueError, match="no key=value"):
        layout.partition_columns("date", F.lit(None))
    found = spark.range(1).select(layout.partition_of(F.lit("l/t/year=2024/x/day=05/f.parquet")), layout.part_key(F.lit("a.parquet"), F.lit(12)), layout.with_slash(F.lit("a//"))).first()
    assert list(found) == ["year=2024/day=05", "a_part012.parquet", "a/"]


def test_compatibility_names_the_first_reason(spark):
    base = [(0, "a", "bigint"), (1, "b", "string")]
    cases = {"same": base, "types": [(0, "a", "double"), (1, "b", None)], "names": [(0, "a", "string"), (1, "c", "string")], "order": [(0, "b", "string"), (1, "a", "bigint")], "more": [*base, (2, "c", "string")], "fewer": base[:1]}
    fields = spark.createDataFrame([(f, *x) for f, rows in cases.items() for x in rows], "file string, pos int, name string, type string")
    found = {r.file: (r.n_fields, r.compatible, r.reason, r.place, r.n_types) for r in evolution.compatibility(fields, fields.where("file = 'same'")).collect()}
    assert found == {"same": (2, True, None, None, 0), "types": (2, True, None, None, 2), "names": (2, False, "name", 1, 1), "order": (2, False, "name", 0, 0), "more": (3, False, "fields", None, 0), "fewer": (1, False, "fields", None, 0)}


def test_changes_carry_over_buckets(spark):
    """Versions and the field log are the same with buckets of any width and with none, and those of a plain count."""
    rng = random.Random(4)
    rows = [("d" if k % 3 else None, k, rng.choice("ab")) for k in range(120)]
    df = spark.createDataFrame(rows, "dataset string, k long, schema_hash string")
    wanted, last, version = {}, {}, {}
    for d, k, value in rows:
        version[d] = version.get(d, 1) + (d in last and last[d] != value)
        wanted[k] = version[d]
        last[d] = value
    seen = df.select("dataset", F.lit("f").alias("field"), F.col("k").alias("seen_at"), F.col("schema_hash").alias("type"))
    for width in (None, 1, 7, 50, 1000):
        of = lambda name: None if width is None else F.floor(F.col(name) / width)  # noqa: B023, E731
        assert {r.k: r.schema_version for r in evolution.versions(df, ["dataset"], "k", bucket=of("k")).collect()} == wanted
        log = {r.dataset: (r.first_seen, r.last_seen, r.type, r.n_changes, r.gone) for r in evolution.field_log(seen, ["dataset"], bucket=of("seen_at")).collect()}
        assert log == {d: (int(d is not None), max(k for x, k, _ in rows if x == d), last[d], version[d] - 1, False) for d in (None, "d")}
    two = spark.createDataFrame([("d", "old", 1, "x"), ("d", "new", 2, "x")], "dataset string, field string, seen_at long, type string")
    assert {r.field: r.gone for r in evolution.field_log(two, ["dataset"]).collect()} == {"old": True, "new": False}


def test_schema_evolution(spark):
    rows = [("a", 0, "BfTs", "bigint"), ("a", 1, "x", "bigint"), ("b", 0, "x", "string"), ("b", 1, "bf-ts", "bigint"), ("b", 2, "bf_ts_2", "double"), ("b", 3, "new", "double")]
    fields = spark.createDataFrame(rows, "file string, pos int, name string, type string")
    assert [tuple(r) for r in evolution.united(fields).orderBy("norm").collect()] == [("bf_ts", "bf-ts", "bigint", 1), ("bfts", "BfTs", "bigint", 1), ("new", "new", "double", 1), ("x", "x", "bigint", 2)]
    assert {r.name for r in evolution.without_repeats(fields).where("file = 'b'").collect()} == {"x", "bf-ts", "new"}
    base = fields.where("file = 'a'").select("name", "type")
    assert {(r.name, r.difference) for r in evolution.incompatible(fields.where("file = 'b'"), base).collect()} == {("BfTs", "removed"), ("x", "changed"), ("bf-ts", "added"), ("bf_ts_2", "added"), ("new", "added")}
    assert evolution.incompatible(fields, base).where("file = 'a'").count() == 0
    assert evolution.incompatible(fields, base.limit(0)).count() == 6 and evolution.incompatible(fields.limit(0), base).count() == 0
    swapped = spark.createDataFrame([("c", 1 - p, n, t) for f, p, n, t in rows if f == "a"], fields.schema)
    assert len({r.schema_hash for r in evolution.schema_hash(fields.where("file = 'a'").union(swapped), ["file"]).collect()}) == 1


def test_type_names(spark):
    found = spark.createDataFrame([("INT96",), ("byte_array",), ("odd",)], "t string").select(catalog.type_name(F.col("t"))).collect()
    assert [r[0] for r in found] == ["timestamp", "string", "unknown"]


def test_streaks_reset_after_a_pause(spark):
    rows = [("d", datetime(2024, 1, 1, h), s, "e") for h, s in ((0, False), (1, False), (2, False), (3, True), (4, False))] + [("d", datetime(2024, 1, 3), False, "last")]
    df = spark.createDataFrame(rows, "dest string, t timestamp_ntz, success boolean, error string")
    assert [r.streak for r in analytics.streaks(df, ["dest"], ["t"]).orderBy("t").collect()] == [1, 2, 3, 0, 1, 2]
    assert [r.streak for r in analytics.streaks(df, ["dest"], ["t"], reset_hours=24, time="t").orderBy("t").collect()] == [1, 2, 3, 0, 1, 1]
    state = analytics.circuits(df, ["dest"], ["t"]).first()
    assert (state.failures, state.last_error, state.active) == (2, "last", True)


def test_small_rules(spark):
    row = spark.range(1).select(
        rules.masked(F.lit("abcdefghij")), rules.masked(F.lit("short")), rules.masked(F.lit("")), rules.requeue_delay(F.lit(1)), rules.requeue_delay(F.lit(9)),
        rules.is_lock_conflict(F.lit("Dataset LOCKED by x")), rules.is_lock_conflict(F.lit(None).cast("string")), rules.health(F.lit(501)), rules.severity(F.lit(5)),
        F.array_join(registry.violations(F.lit("string"), F.lit(""), F.lit("x")), ","),
    ).first()
    assert list(row) == ["abcd***ghij", "***", "", 60, 1800, True, False, "unhealthy", "HIGH", "literal string,dataset empty"]


def test_parts_are_bounded_and_whole(spark):
    rows = spark.range(500).select("id", F.lit("d").alias("dataset"), (F.col("id") * 37 % 90 + 1).alias("size"))
    out = catalog.numbered_parts(rows, ["dataset"], ["id"], F.col("size"), 300, F.floor(F.col("id") / 20)).collect()
    plain = catalog.numbered_parts(rows, ["dataset"], ["id"], F.col("size"), 300).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, plain)) and len(out) == 500
    sums = {}
    for r in out:
        sums[r.part] = sums.get(r.part, 0) + r.size
    assert max(sums.values()) < 300 + 90
    none = rows.withColumn("dataset", F.when(F.col("id") % 2 == 0, "d"))
    assert catalog.numbered_parts(none, ["dataset"], ["id"], F.col("size"), 300).count() == 500


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / name, "wt") as f:
        f.write("\n".join(lines))


def test_pack_once_and_again(spark, tmp_path):
    source, lake = tmp_path / "in", str(tmp_path / "lake")
    put(source, "t--d--1--ndjson.gz", '{"timestamp":"2024-01-02T03:04:05Z","n":1}', "broken", '{"n":2,"late":[1]}')
    first = pack.pack(spark, str(source), lake, "t", "d", keep_raw=True)
    assert (first.fresh, first.lines, first.valid, first.rejected) == (True, 3, 2, 1)
    assert not pack.pack(spark, str(source), lake, "t", "d").fresh
    put(source, "more.ndjson.gz", '{"timestamp":"2024-01-03","n":3}')
    put(source, "other.txt.gz", '{"n":9}')
    assert pack.pack(spark, str(source), lake, "t", "d").valid == 1
    rows = spark.read.parquet(f"{lake}/t/d/data")  # the catalogue beside it doesn't disturb readers
    assert sorted((r.n, r.year, r.day, r.late) for r in rows.collect()) == [(1, 2024, 2, None), (2, None, None, [1]), (3, 2024, 3, None)]
    assert spark.read.parquet(f"{lake}/t/d/_catalog/quarantine").count() == 1
    files = spark.read.parquet(f"{lake}/t/d/_catalog/files")
    assert files.agg(F.sum("n_rows")).first()[0] == 3 and files.where("partition = 'year=2024/month=01/day=03/_part=1' and size > 0 and length(checksum) = 64").count() == 1
    stats = {(x.name, x.min_value, x.max_value, x.null_count) for r in files.collect() for x in r.stats if x.name == "n"}
    assert stats == {("n", str(k), str(k), 0) for k in (1, 2, 3)}
    documents = [json.loads(r.document) for r in spark.read.parquet(f"{lake}/t/d/_catalog/summaries").collect()]
    assert sum(d["num_rows"] for d in documents) == 3 and all(f["fields"] and f["stats"] for d in documents for f in d["files"])
    with pytest.raises(ValueError, match="unknown codec"):
        pack.pack(spark, str(source), lake, "t", "d", codec="lz77")
    with pytest.raises(ValueError, match="unknown codec"):
        pack.write_parts(rows, str(tmp_path / "x"), ["day"], "_event_ts", codec="lz77")


STOPS = ("classified", "write_parts", "catalogued", "commit", "summarised")


@pytest.mark.parametrize("stop", STOPS)
def test_a_run_that_stops_anywhere_leaves_every_record_once(spark, tmp_path, monkeypatch, stop):
    source, lake = tmp_path / "in", str(tmp_path / "lake")
    put(source, "a.ndjson.gz", *[f'{{"timestamp":"2024-01-0{k % 3 + 1}","n":{k}}}' for k in range(10)])
    owner, own = (pack.ndjson, pack.ndjson.classified) if stop == "classified" else (pack, getattr(pack, stop))

    def broken(*args, **kwargs):
        if stop in ("write_parts", "commit", "summarised"):  # after the step; before the others
            own(*args, **kwargs)
        raise RuntimeError("stopped")

    monkeypatch.setattr(owner, stop, broken)
    with pytest.raises(RuntimeError):
        pack.pack(spark, str(source), lake, "t", "d", limit=200)
    monkeypatch.setattr(owner, stop, own)
    put(source, "b.ndjson.gz", '{"n":10,"more":true}')
    pack.pack(spark, str(source), lake, "t", "d", limit=200)
    assert sorted(r.n for r in spark.read.parquet(f"{lake}/t/d/data").collect()) == list(range(11))
    assert spark.read.parquet(f"{lake}/t/d/_catalog/files").agg(F.sum("n_rows")).first()[0] == 11
    assert sorted(r.valid for r in spark.read.parquet(f"{lake}/t/d/_catalog/batches").collect()) == [1, 10]
    assert not pack.pack(spark, str(source), lake, "t", "d").fresh


def test_every_field_is_kept(spark, tmp_path):
    put(tmp_path / "in", "a.ndjson.gz", '{"size":77,"day":"mon","part":1,"a":1,"A":"x","_bytes":5,"_row":6,"year":null}', '{"Day":"tue"}')
    pack.pack(spark, str(tmp_path / "in"), str(tmp_path / "lake"), "t", "d", files_per_batch=1)
    row = spark.read.parquet(f"{tmp_path}/lake/t/d/data").where("size = 77").first().asDict()
    names = {r.field: r.column for r in spark.read.parquet(f"{tmp_path}/lake/t/d/_catalog/fields").collect()}
    assert names == {"size": "size", "Day": "Day_", "day": "day__", "part": "part", "A": "A", "a": "a_", "_bytes": "_bytes_", "_row": "_row", "year": "year_"}
    assert (row["size"], row["day__"], row["part"], row["A"], row["a_"], row["_bytes_"], row["_row"]) == (77, "mon", 1, "x", 1, 5, 6)


def test_flattened_packing(spark, tmp_path):
    put(tmp_path / "in", "a.ndjson.gz", '{"id":1,"o":{"x":{"y":2.5}},"l":[{"k":"v"},7]}', '{"id":2,"o.x":true,"o":{"x":{"y":3}}}')
    pack.pack(spark, str(tmp_path / "in"), str(tmp_path / "lake"), "t", "d", flatten=".")
    rows = spark.read.parquet(f"{tmp_path}/lake/t/d/data").select("id", "`o.x.y`", "`l.0.k`", "`l.1`", "`o.x`").orderBy("id")
    assert [tuple(r) for r in rows.collect()] == [(1, 2.5, "v", 7, None), (2, 3.0, None, None, True)]


def test_part_keys_of_a_thousand_parts_and_more(spark, tmp_path):
    """The reference's %03d pads and doesn't cut; no file is left out."""
    from datetime import timedelta

    from tarn.plans.queries import QUERIES

    at = datetime(2024, 1, 1)
    files = [(n, timedelta(days=k)) for k, n in enumerate((1, 2, 100, 1000))]
    events = [(0, 1, "x", at + day, 1.0, "{}") for n, day in files for _ in range(n)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    found = {r.key.rsplit("/", 1)[1] for r in QUERIES["part_keys"](spark, str(tmp_path)).collect()}
    assert found == {"1.parquet", "1_part002.parquet", "1_part100.parquet", "1_part1000.parquet"}


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.now


class Handle:
    """A state store of one key and its timers."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)


def test_timers_flush_what_waited_and_nothing_fresh():
    import pandas as pd

    from tarn.streaming import streams

    handle, state = Handle(), streams.Accumulator(100, 60)
    state.init(handle)
    rows = lambda size: iter([pd.DataFrame({"size": [size], "files": [1]})])
    fed = lambda size, now: next(state.handleInputRows(("d",), rows(size), Clock(now))).iloc[0]
    assert fed(40, 0).reason is None and handle.timers == {60_000}
    assert fed(40, 30_000).reason is None and handle.timers == {60_000}  # the first file's timer holds
    assert fed(40, 50_000).reason == "size" and handle.timers == set()  # and goes with the flush
    assert fed(10, 55_000).bytes == 10 and handle.timers == {115_000}
    handle.timers.clear()
    late = next(state.handleExpiredTimer(("d",), Clock(115_000), None)).iloc[0]
    assert (late.reason, late.bytes, late.files, late.flush_count) == ("time", 10, 1, 2) and handle.timers == set()


def test_buckets_carry_streaks_places_and_pauses(spark):
    import random

    rng, rows = random.Random(5), []
    for dest in ("a", "b", None):
        t = 0
        for k in range(120):
            t += rng.choice([1, 600, 90_000])
            rows.append((dest, k, datetime(2024, 1, 1) + timedelta(seconds=t), rng.random() < 0.2))
    df = spark.createDataFrame(rows, "dest string, k int, t timestamp_ntz, success boolean")
    day = F.date_trunc("DAY", "t")

    expected = {}
    for dest in ("a", "b", None):
        for hours in (None, 24):
            streak, last = 0, None
            for place, (_, k, t, success) in enumerate([r for r in rows if r[0] == dest], 1):
                pause = last and (t - last).total_seconds()
                streak = 0 if success else 1 if hours and last and pause >= hours * 3600 else streak + 1
                expected[dest, k, hours] = (streak, place % 10 == 0 or bool(last) and pause > 700)
                last = t
    for hours in (None, 24):
        for bucket in (None, day):
            found = analytics.streaks(df, ["dest"], ["t", "k"], reset_hours=hours, time="t", bucket=bucket)
            assert found.columns == [*df.columns, "streak", "open_circuit"]
            assert {(r.dest, r.k): r.streak for r in found.collect()} == {x[:2]: v[0] for x, v in expected.items() if x[2] == hours}
    for bucket in (None, day):
        due = {(r.dest, r.k) for r in analytics.throttled(df, ["dest"], ["t", "k"], 10, 700, "t", bucket).collect()}
        assert due == {x[:2] for x, v in expected.items() if v[1]}
    assert analytics.streaks(df.limit(0), ["dest"], ["t"], bucket=day).count() == 0


def test_the_rest_of_a_record_and_lost_values(spark):
    lines = spark.createDataFrame([('{"a":1,"b":[1],"c":null}',), ('{"a":"x"}',), ('{"a":true,"d":{"e":2.5}}',)], "value string")
    records = ndjson.records(lines)
    assert [r[0] for r in records.select(schema.rest(F.col("record"), ["a"])).collect()] == ['{"b":[1],"c":null}', None, '{"d":{"e":2.5}}']
    assert [tuple(r) for r in schema.cast_losses(records, [("a", "bigint"), ("c", "string")]).collect()] == [("a", "bigint", 3, 2), ("c", "string", 0, 0)]


def test_common_kinds_are_those_of_the_lattice(spark):
    kinds = ["null", "bigint", "double", "boolean", "string", "timestamp", "array", "array<null>", "array<bigint>", "array<double>", "array<boolean>"]
    sets = [list(p) for n in (0, 1, 2, 3) for p in itertools.combinations(kinds, n)]
    rows = spark.createDataFrame([(s,) for s in sets], "k array<string>").select("k", schema.reconciled(F.col("k")).alias("t")).collect()
    assert all(schema.common_kind(r.k) == r.t for r in rows) and len(rows) == len(sets)


def test_values_that_drift_are_all_kept(spark, tmp_path):
    from tarn.operators import lake

    source, out = tmp_path / "in", str(tmp_path / "lake")
    root = f"{out}/t/d"
    put(source, "1.ndjson.gz", '{"id":1,"a":7,"t":"2024-01-02T03:04:05Z","l":[1],"z":null,"a_v2":"taken"}')
    assert pack.pack(spark, str(source), out, "t", "d").lost == 0
    put(source, "2.ndjson.gz", '{"id":2,"a":1.5,"t":"soon","l":["x"],"z":4}', '{"id":3,"a":0.1234567890123456789}')
    assert pack.pack(spark, str(source), out, "t", "d").lost == 1
    put(source, "3.ndjson.gz", '{"id":4,"a":"text","l":5,"o\'d\\"d":{"x":[1]}}', "no record")
    last = pack.pack(spark, str(source), out, "t", "d")
    assert (last.valid, last.rejected, last.lost) == (1, 1, 1) and not pack.pack(spark, str(source), out, "t", "d").fresh
    rows = {r.id: r.asDict() for r in lake.read(spark, root).select("*", F.to_json("_rest").alias("rest")).collect()}
    assert [rows[k]["a"] for k in (1, 2, 3, 4)] == ["7", "1.5", "0.12345678901234568", "text"]
    assert [rows[k]["t"] for k in (1, 2, 3)] == ["2024-01-02T03:04:05.000Z", "soon", None] and [rows[k]["l"] for k in (1, 2, 4)] == ["[1]", '["x"]', "5"]
    assert rows[1]["a_v2"] == "taken" and rows[2]["z"] == 4 and rows[1]["z"] is None
    assert [json.loads(rows[k]["rest"] or "null") for k in (1, 3, 4)] == [None, {"a": 0.1234567890123456789}, {"o'd\"d": {"x": [1]}}]
    log = {r.field: r for r in lake.field_log(spark, root).collect()}
    assert (log["a"].type, log["a"].n_changes, log["a"].gone, list(log["a"].names)) == ("string", 2, False, ["a", "a_v2_", "a_v3"])
    assert log["z"].type == "bigint" and log["t"].gone and (log["t"].first_seq, log["t"].last_seq) == (1, 2)
    assert spark.read.option("mergeSchema", True).parquet(f"{root}/data").count() == 4  # no column has two types


def lines_at(spark, source):
    from tarn.streaming import streams

    return lambda path, check, sink, **o: streams.run(streams.lines_of(spark, str(path), **o), f"{source}/{check}", sink).awaitTermination()


@pytest.mark.parametrize("stop", STOPS)
def test_a_stream_that_stops_anywhere_leaves_every_record_once(spark, tmp_path, monkeypatch, stop):
    from pyspark.errors import StreamingQueryException

    from tarn.operators import lake
    from tarn.streaming import streams

    source, out = tmp_path / "in a+b%20", str(tmp_path / "lake")
    put(source, "a.ndjson.gz", *[f'{{"n":{k}}}' for k in range(10)])
    owner, own = (pack.ndjson, pack.ndjson.classified) if stop == "classified" else (pack, getattr(pack, stop))

    def broken(*args, **kwargs):
        if stop in ("write_parts", "commit", "summarised"):
            own(*args, **kwargs)
        raise RuntimeError("stopped")

    run, sink = lines_at(spark, tmp_path), streams.pack_sink(out, "t", "d")
    monkeypatch.setattr(owner, stop, broken)
    with pytest.raises(StreamingQueryException):
        run(source, "check", sink)
    assert len(lake.read(spark, f"{out}/t/d").collect()) == (10 if stop in ("commit", "summarised") else 0)
    monkeypatch.setattr(owner, stop, own)
    put(source, "b.ndjson.gz", '{"n":10}')
    run(source, "lost-check" if stop == "catalogued" else "check", sink, files_per_batch=1)
    assert not pack.pack(spark, str(source), out, "t", "d").valid  # what a stream packed is consumed, and what it left is over
    assert sorted(r.n for r in lake.read(spark, f"{out}/t/d").collect()) == list(range(11))
    assert {r.file_count for r in lake.partition_totals(spark, f"{out}/t/d").collect()} == {2}


def test_reading_by_the_catalogue(spark, tmp_path):
    from tarn.operators import lake

    source, out = tmp_path / "in", str(tmp_path / "lake")
    put(source, "a.ndjson.gz", *[f'{{"timestamp":"2024-01-{k:02d}","n":{k}}}' for k in range(1, 21)], '{"n":99}')
    for layout_ in ({}, {"scheme": "date"}, {"template": "{dataset}/{year}/{month}{day}"}, {"scheme": "none", "metadata_level": "root"}):
        name = "-".join(layout_) or "hive"
        root = f"{out}/{name}/d"
        pack.pack(spark, str(source), out, name, "d", limit=100, **layout_)
        rows = lake.read(spark, root)
        assert sorted(r.n for r in rows.collect()) == [*range(1, 21), 99]
        some = lake.read(spark, root, since=datetime(2024, 1, 3), until="2024-01-05")
        assert sorted(r.n for r in some.collect()) == [3, 4] and len(some.inputFiles()) <= 4 < len(rows.inputFiles())
        few = lake.read(spark, root, between={"n": (19, 98)})
        assert sorted(r.n for r in few.collect()) == [19, 20] and len(few.inputFiles()) < len(rows.inputFiles())
        assert lake.read(spark, root, since="2030-01-01").count() == 0
    folders = {r.partition.split("/_part")[0] for r in lake.files(spark, f"{out}/scheme/d").collect()}
    assert folders == {*(f"2024/01/{k:02d}" for k in range(1, 21)), "undated"}
    assert lake.read(spark, f"{out}/nothing/d").count() == 0


def test_summaries_grow_by_what_is_touched(spark, tmp_path, monkeypatch):
    from tarn.operators import lake

    source, out = tmp_path / "in", tmp_path / "lake"
    root = out / "t/d"
    put(source, "a.ndjson.gz", '{"timestamp":"2024-01-02","n":1}', '{"timestamp":"2024-01-03","n":2}')
    pack.pack(spark, str(source), str(out), "t", "d")
    before = {p: p.stat().st_mtime_ns for p in (root / "_catalog/partitions").rglob("*.parquet")}
    put(source, "b.ndjson.gz", '{"timestamp":"2024-01-03","n":3}', '{"timestamp":"2024-01-04","n":4}')
    monkeypatch.setattr(lake, "DOCUMENT", 1)
    pack.pack(spark, str(source), str(out), "t", "d")
    after = {p: p.stat().st_mtime_ns for p in (root / "_catalog/partitions").rglob("*.parquet")}
    assert len(set(before) & set(after)) == 1 and len(after) == 3  # the day that wasn't touched
    totals = {r.partition[:28]: (r.file_count, r.total_rows) for r in lake.partition_totals(spark, str(root)).collect()}
    assert totals == {"year=2024/month=01/day=02/_p": (1, 1), "year=2024/month=01/day=03/_p": (2, 2), "year=2024/month=01/day=04/_p": (1, 1)}
    lake._summarised(spark, str(root), "leaf", *lake.ended(spark, str(root)).where("seq = 2").select("_batch", "seq").first())  # once more changes nothing
    assert {r.partition[:28]: (r.file_count, r.total_rows) for r in lake.partition_totals(spark, str(root)).collect()} == totals
    assert sum(json.loads(r.document)["num_rows"] for r in spark.read.parquet(f"{root}/_catalog/summaries").collect()) == 4


def test_tree_hash_is_that_of_a_set(spark):
    rows = [("g", f"p{k}", k) for k in range(500)] + [("h", "p1", 1)]
    a = {r.g: r.tree_hash for r in catalog.tree_hash(spark.createDataFrame(rows, "g string, path string, size long"), ["g"]).collect()}
    b = {r.g: r.tree_hash for r in catalog.tree_hash(spark.createDataFrame(rows[::-1], "g string, path string, size long").repartition(5), ["g"]).collect()}
    c = {r.g: r.tree_hash for r in catalog.tree_hash(spark.createDataFrame([("g", "p0", 1), *rows[1:]], "g string, path string, size long"), ["g"]).collect()}
    assert a == b and a["g"] != c["g"] and a["h"] == c["h"]


class Listed(Handle):
    """List state beside the value state of ``Handle``."""

    def __init__(self):
        super().__init__()
        self.rows = []

    def getListState(self, name, schema):  # noqa: N802
        owner = self

        class State:
            def exists(self):
                return bool(owner.rows)

            def get(self):
                return iter(owner.rows)

            def appendList(self, rows):  # noqa: N802
                owner.rows.extend(rows)

            def clear(self):
                owner.rows = []

        return State()


def test_files_wait_until_a_flush():
    import pandas as pd

    from tarn.streaming import streams

    handle, state = Listed(), streams.Holder(100, 60)
    state.init(handle)
    fed = lambda names, size, now: list(state.handleInputRows(("d",), iter([pd.DataFrame({"path": names, "length": [size] * len(names)})]), Clock(now)))
    assert fed(["a"], 40, 0) == [] and handle.timers == {60_000}
    (out,) = fed(["b", "c"], 40, 30_000)
    assert list(out.path) == ["a", "b", "c"] and set(out.flush) == {1} and set(out.reason) == {"size"} and handle.timers == set() and handle.rows == []
    assert fed(["d"], 10, 40_000) == [] and handle.timers == {100_000}
    handle.timers.clear()
    (late,) = state.handleExpiredTimer(("d",), Clock(100_000), None)
    assert list(late.path) == ["d"] and list(late.reason) == ["time"] and list(late.flush) == [2]
    assert list(state.handleExpiredTimer(("d",), Clock(200_000), None)) == []


TIES = [  # an order and line twice on a day, one of them failed; two failures alike
    ("2024-01-01", 1, 1, "R"), ("2024-01-01", 1, 1, "N"), ("2024-01-02", 1, 1, "R"), ("2024-01-02", 2, 1, "R"), ("2024-01-02", 2, 1, "R"), ("2024-01-02", 3, 1, "R"), ("2024-01-02", 3, 1, "N"), ("2024-01-03", 4, 1, "R"),
]


@pytest.mark.parametrize("name", ["failure_streak", "every_third_alert", "operation_progress"])
def test_uploads_that_tie_are_counted_as_the_sql_counts_them(spark, tmp_path, name):
    """Whatever the order in which the rows of a table come."""
    import duckdb

    import __spark_entry__ as entry

    found = set()
    for k in range(6):
        some = random.Random(k).sample(TIES, len(TIES))
        rows = [(5, order, line, datetime.fromisoformat(day), flag, 1.0, 9.5, 1, "O") for day, order, line, flag in some]
        names = "l_suppkey long, l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_returnflag string, l_quantity double, l_extendedprice double, l_partkey long, l_linestatus string"
        folder = str(tmp_path / str(k))
        spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
        out = entry.queries()[name](spark, folder)
        con = duckdb.connect()
        con.execute(f"create view lineitem as select * from read_parquet('{folder}/lineitem.parquet/*.parquet')")
        sql = con.execute(f"select {', '.join(out.columns)} from ({entry.oracle_sql()[name]})").fetchall()
        found |= {tuple(sorted(map(tuple, out.collect()))), tuple(sorted(sql))}
    assert len(found) == 1


def test_totals_of_many_parts_lie_in_few_folders(spark, tmp_path):
    from tarn.operators import lake

    source, out = tmp_path / "in", str(tmp_path / "lake")
    put(source, "a.ndjson.gz", *[f'{{"timestamp":"2024-01-{k % 28 + 1:02d}T00:{k % 60:02d}:00","n":{k}}}' for k in range(300)])
    pack.pack(spark, str(source), out, "t", "d", limit=60)
    totals = lake.partition_totals(spark, f"{out}/t/d").collect()
    assert len(totals) == len({r.partition for r in totals}) > 100 and sum(r.total_rows for r in totals) == 300
    assert sum(p.is_dir() for p in (tmp_path / "lake/t/d/_catalog/partitions").iterdir()) <= lake.BUCKETS < 100


def test_rows_without_a_time_are_numbered_in_buckets(spark, tmp_path, monkeypatch):
    """No window holds all of them, and parts are bounded and whole all the same."""
    seen, own = [], catalog.numbered_parts

    def noted(rows, by, order, size, limit, bucket=None):
        seen.append(rows.select(bucket.alias("b")).distinct().count())
        return own(rows, by, order, size, limit, bucket)

    monkeypatch.setattr(catalog, "numbered_parts", noted)
    rows = spark.range(2000).select("id", F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(10).cast("long").alias("size"))
    pack.write_parts(rows, str(tmp_path / "x"), [], "at", limit=500, size="size")
    assert seen[0] > 30
    sums = spark.read.parquet(str(tmp_path / "x")).groupBy("_part").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in sums) == 2000 and max(r.s for r in sums) <= 500 and len(sums) == 40


def test_lines_of_few_files_are_many_tasks(spark):
    assert ndjson.dealt(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 3 * spark.sparkContext.defaultParallelism


def test_source_files_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from tarn.plans import lake_queries

    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda *_: pytest.fail("sorts all lines of a file"))
    source, _ = lake_queries._named(spark, "/root/testdata/sf0.001")
    assert ndjson.list_files(spark, source, r"\.gz$").count() == lake_queries.FILES


def test_large_parts_are_dealt_to_more_tasks(spark, tmp_path):
    rows = spark.range(2000).select("id", F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(10).cast("long").alias("size"))
    pack.write_parts(rows, str(tmp_path / "x"), [], "at", limit=500, size="size", total=1 << 30)  # 65 tasks, where the session says 4
    names = {p.name.split("-")[1] for p in (tmp_path / "x").rglob("*.parquet")}
    assert len(names) > 4 and spark.read.parquet(str(tmp_path / "x")).count() == 2000


def test_uploads_that_lack_a_time_or_an_end_are_counted_as_the_sql_counts_them(spark, tmp_path):
    """No time, order or line comes last; what isn't known to have succeeded has failed."""
    import duckdb

    import __spark_entry__ as entry

    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(5, order, line, at, flag, 1.0, 9.5, 1, "O") for at, order, line, flag in (
        (first, 1, 1, "R"), (first, 2, 1, None), (first, None, 1, "R"), (second, 3, 1, "N"), (second, 3, 1, None), (second, 4, None, "R"), (second, 4, 1, "R"), (None, 5, 1, "R"), (None, 6, 1, "N"), (None, None, None, "R"),
    )]
    names = "l_suppkey long, l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_returnflag string, l_quantity double, l_extendedprice double, l_partkey long, l_linestatus string"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    for name in ("failure_streak", "every_third_alert"):
        out = entry.queries()[name](spark, str(tmp_path))
        sql = con.execute(f"select {', '.join(out.columns)} from ({entry.oracle_sql()[name]})").fetchall()
        assert sorted(map(tuple, out.collect()), key=str) == sorted(sql, key=str)


def test_large_tables_are_numbered_by_many_tasks(spark):
    """So that no task sorts more of a table as the table grows; once dealt, rows aren't dealt again for the window."""
    rows = spark.range(500).select(F.lit("p").alias("p"), "id", F.timestamp_seconds("id").alias("at"), F.lit(10).cast("long").alias("size"))
    found = catalog.numbered_parts(rows, ["p"], ["at"], F.col("size"), 100, F.date_trunc("MINUTE", "at"), tasks=9)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ", 9)" in plan and plan.count("hashpartitioning(p") == 2  # the other one is that of the sums
    assert {(r.part, r.n) for r in found.groupBy("part").agg(F.count("*").alias("n")).collect()} == {(k, 10) for k in range(1, 51)}


def test_lines_of_large_files_are_dealt_to_tasks_by_their_size(spark, tmp_path, monkeypatch):
    tasks, own = [], pack.ndjson.scan

    def noted(spark, paths, partitions=None):
        tasks.append(partitions)
        return own(spark, paths, partitions)

    monkeypatch.setattr(pack.ndjson, "scan", noted)
    monkeypatch.setattr(pack, "SHARE", 100)
    put(tmp_path / "in", "a.ndjson.gz", *[f'{{"timestamp":"2024-01-{k % 28 + 1:02d}T00:00:00","n":{k}}}' for k in range(300)])
    done = pack.pack(spark, str(tmp_path / "in"), str(tmp_path / "out"), "t", "d", keep_raw=True)
    assert done.valid == 300 and tasks[0] > 20
    raw = spark.read.text(f"{tmp_path}/out/t/d/raw")
    assert raw.count() == raw.select("value").distinct().count() == 300
    assert sum(1 for _ in (tmp_path / "out/t/d/raw").rglob("*.gz")) < 300  # lines of a day meet in few files


class Staged(Exception):
    pass


def test_large_tables_are_staged_in_many_files(spark, tmp_path, monkeypatch):
    """A compressed file is one task to write and one to read, and a given table may be one task as well."""
    from tarn.plans import lake_queries

    def counted(spark, source, *_, **__):
        raise Staged(ndjson.list_files(spark, source, r"\.gz$").count())

    monkeypatch.setattr(lake_queries.pack, "pack", counted)
    rows = spark.range(400_000).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("pack_template", "pack_date_layout"):
        with pytest.raises(Staged) as files:
            lake_queries.QUERIES[name](spark, str(tmp_path))
        assert files.value.args[0] > 1


@pytest.mark.parametrize("layout_", [{"template": "{tenant}/{year}-{month}"}, {"scheme": "date"}])
def test_event_times_are_kept_with_the_lines(spark, tmp_path, monkeypatch, layout_):
    """Numbering, dealing and writing take them from the cache and don't parse them again."""
    plans, own = [], pack.write_parts

    def noted(rows, *args, **options):
        plans.append(rows._jdf.queryExecution().withCachedData().toString())
        own(rows, *args, **options)

    monkeypatch.setattr(pack, "write_parts", noted)
    put(tmp_path / "in", "a.ndjson.gz", *[f'{{"timestamp":"2024-01-{k % 28 + 1:02d}T00:00:00","n":{k}}}' for k in range(60)], '{"n":60}')
    done = pack.pack(spark, str(tmp_path / "in"), str(tmp_path / "out"), "t", "d", limit=100, **layout_)
    assert done.valid == 61 and len(plans) == 1
    above, cache, _ = plans[0].partition("InMemoryRelation")
    assert cache and "@timestamp" not in above and "_event_ts" in above
    from tarn.operators import lake

    rows = lake.read(spark, f"{tmp_path}/out/t/d").select("n", F.day("_event_ts")).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([*((k, k % 28 + 1) for k in range(60)), (60, None)], key=str)


def test_the_first_time_field_is_parsed_as_a_column(spark, monkeypatch):
    """Lambdas see only lines whose first time field doesn't parse; the times are those of ``event_time`` for all lines."""
    cases = [
        '{"timestamp":"2024-01-02T03:04:05Z"}', '{"InfoTimestamp":"no","created_at":"2024-01-02"}', '{"timestamp":null,"time":1700000000}', '{"timestamp":true,"Time":1.7e9,"created_at":"2024-01-02"}',
        '{"Timestamp":"2024-01-02 03:04:05,5","timestamp":[1]}', '{"InfoTimestamp":1,"timestamp":"2024-01-02T03:04:05"}', '{"time":"12"}', '{"x":1}', "{}", "[1]", "no", "", '{"time":12345678901234567890123}',
    ]
    lines = ndjson.classified(spark.createDataFrame([(x,) for x in cases], "value string"))
    rows = pack.timed(lines).select("value", "_event_ts", timestamps.event_time(F.col("record")).alias("want"))
    assert rows.where("not _event_ts <=> want").collect() == [] and rows.where("want is not null").count() == 6
    monkeypatch.setattr(pack, "event_time", lambda _: F.lit(None).cast("timestamp_ntz"))
    rows = {r.value: r._event_ts for r in pack.timed(lines).collect()}
    assert rows[cases[0]] == datetime(2024, 1, 2, 3, 4, 5) and rows[cases[1]] is None


def test_footers_are_read_by_few_tasks_in_slices(spark, tmp_path):
    spark.range(0, 300, 1, 300).write.parquet(f"{tmp_path}/x")  # a file each
    files = catalog.list_parquet(spark, f"{tmp_path}/x")
    footers = catalog.scan_footers(files.repartition(100))  # as many as Spark has for the listing of many files
    assert footers.rdd.getNumPartitions() <= 3 * spark.sparkContext.defaultParallelism
    assert footers.agg(F.count("*"), F.sum("n_rows")).first() == (300, 300)
    slices = [b.num_rows for b in catalog._footers(iter([files.toArrow().combine_chunks().to_batches()[0]]))]
    assert slices == [catalog.FOOTERS, 300 - catalog.FOOTERS]


def test_small_parts_are_as_spark_writes_them(spark, tmp_path):
    """Rows, types and folders are those of Spark's writer, which took some twelve milliseconds for each file; no checksum files lie beside them."""
    odd = ["a b", "x/y=z", "ä%41", "", None, "q'\"[1]", "t\tb"]
    rows = spark.range(210).select(
        F.get(F.array(*[F.lit(o) for o in odd]), (F.col("id") % 7).cast("int")).alias("k"), (F.col("id") % 3).alias("n"), F.col("id").alias("a"), (F.col("id") / 2).alias("b"), (F.col("id") % 2 == 0).alias("c"),
        F.when(F.col("id") % 5 > 0, F.timestamp_seconds("id").cast("timestamp_ntz")).alias("at"), F.array(F.col("id").cast("string"), F.lit(None)).alias("d"), F.lit(None).cast("string").alias("e"),
        F.when(F.col("id") % 4 == 0, F.parse_json(F.concat(F.lit('{"x":'), F.col("id").cast("string"), F.lit("}")))).alias("v"), F.lit(100).cast("long").alias("size"),
    )
    pack.write_parts(rows, f"{tmp_path}/own", ["k", "n"], "at", limit=300, size="size")
    numbered = catalog.numbered_parts(rows, ["k", "n"], ["at"], F.col("size"), 300, F.lit(0)).withColumnRenamed("part", "_part")
    numbered.repartition("k", "n", "_part").write.partitionBy("k", "n", "_part").parquet(f"{tmp_path}/spark")
    own, other = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("own", "spark"))
    assert sorted(own.dtypes) == sorted(other.dtypes)
    own, other = ([tuple(r) for r in x.select("k", "n", "a", "b", "c", "at", "d", "e", "v", "size").withColumns({"v": F.to_json("v"), "d": F.to_json("d")}).orderBy("a").collect()] for x in (own, other))
    assert own == other and len(own) == 210 and any(r[0] == "x/y=z" for r in own)
    folders = [{str(p.parent.relative_to(tmp_path / x)) for p in (tmp_path / x).rglob("*.parquet")} for x in ("own", "spark")]
    assert folders[0] == folders[1] and len(folders[0]) > 60
    assert not [*(tmp_path / "own").rglob("*.crc")] and not (tmp_path / "own/_temporary").exists()
    assert len([*(tmp_path / "own").rglob("*.parquet")]) == numbered.select("k", "n", "_part").distinct().count()  # one a part
    footers = [catalog.scan_footers(catalog.list_parquet(spark, f"{tmp_path}/{x}")).select(F.inline("stats")).groupBy("name").agg(F.count("min_value") > 0, F.sum("null_count")) for x in ("own", "spark")]
    footers = [sorted(map(tuple, x.where("name not like 'v.%' or name = 'v.metadata'").collect())) for x in footers]  # Spark adds columns of what is in a VARIANT
    assert footers[0] == footers[1] and len(footers[0]) == 8


def test_attempts_that_spark_does_not_take_leave_no_parts(spark, tmp_path):
    """Two attempts at one task, of which one is taken, beside a writer of another job."""
    from tarn.operators import parts

    source = parts.PartFiles({"path": f"{tmp_path}/x", "by": '["k"]', "codec": "zstd"})
    kind = spark.createDataFrame([], "k int, a long").schema
    batch = spark.range(10).select((F.col("id") / 4).cast("int").alias("k"), F.col("id").alias("a")).coalesce(1).orderBy("a").toArrow().combine_chunks().to_batches()
    writer, other = source.writer(kind, False), source.writer(kind, False)
    waiting, given_up, taken = other.write(iter(batch)), writer.write(iter(batch)), writer.write(iter([b.slice(k, 3) for b in batch for k in range(0, b.num_rows, 3)]))
    assert given_up != taken and not [*(tmp_path / "x").glob("k=*")]
    writer.commit([taken, None])
    found = spark.read.parquet(f"{tmp_path}/x")
    assert sorted(map(tuple, found.select("k", "a").collect())) == [(k // 4, k) for k in range(10)] and len(found.inputFiles()) == 3
    assert [p.name for p in (tmp_path / "x/_temporary").iterdir()] == [other.job]
    other.abort([waiting])
    assert not (tmp_path / "x/_temporary").exists() and spark.read.parquet(f"{tmp_path}/x").count() == 10


def test_a_lake_of_many_parts_is_read_without_a_search_for_partitions(spark, tmp_path):
    """Spark's search for partitions grows with the square of their number; keys are taken from paths, and files are still left out by them."""
    from tarn.operators import lake

    (tmp_path / "year=7").mkdir()
    put(tmp_path / "year=7/in", "a.ndjson.gz", *[f'{{"timestamp":"2024-01-{k % 5 + 1:02d}T00:00:{k % 60:02d}","n":{k}}}' for k in range(300)], '{"n":300}')
    pack.pack(spark, str(tmp_path / "year=7/in"), str(tmp_path / "year=7/out"), "t", "d", limit=100)
    root = f"{tmp_path}/year=7/out/t/d"
    rows, found = lake.read(spark, root), spark.read.parquet(f"{root}/data")
    keys = ["n", "year", "month", "day", "_part"]
    assert dict(rows.dtypes) | {"year": "int", "month": "int", "day": "int", "_part": "bigint", "_batch": "string"} == dict(rows.dtypes)
    assert sorted(map(tuple, rows.select(*keys).collect()), key=str) == sorted(map(tuple, found.select(*keys).collect()), key=str)
    assert rows.where("year is null").count() == 1 and rows.select("_batch").distinct().count() == 1
    some = rows.where("day = 3 and _part < 4").select("n")
    some.collect()
    plan = some._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    assert plan.relation().location().partitionSchema().isEmpty()
    assert plan.metrics().apply("numFiles").value() == 3


def test_plain_paths(spark):
    from tarn.sources.folders import plain_path

    cases = {"file:///a/b c": "/a/b c", "file:/a": "/a", "/a/file:/b": "/a/file:/b", "s3a://b/c": "s3a://b/c", "file:////a+b": "/a+b", "a%20b": "a%20b", None: None}
    assert {r.p: r.x for r in spark.createDataFrame([(p,) for p in cases], "p string").select("p", plain_path(F.col("p")).alias("x")).collect()} == cases
    cases = {"file:///a/b%20c+d%2Be": "/a/b c+d+e", "file:///a+b": "/a+b", "hdfs://x/a%25b": "hdfs://x/a%b"}
    assert {r.p: r.x for r in spark.createDataFrame([(p,) for p in cases], "p string").select("p", plain_path(F.col("p"), encoded=True).alias("x")).collect()} == cases


def test_lines_of_a_stream_are_dealt_without_a_sort(spark, tmp_path):
    """Dealing in turns sorts all lines of a file first; equal lines still meet in no one task."""
    put(tmp_path / "in", "a.ndjson.gz", *["same"] * 3000)
    lines = ndjson.dealt(spark.read.text(str(tmp_path / "in")))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan and "hashpartitioning(_place" in plan and lines.columns == ["value"]
    tasks = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 3000 and len(tasks) == 3 * spark.sparkContext.defaultParallelism and max(tasks) < 500


def test_parts_are_checked_without_a_search_for_partitions(spark, tmp_path, monkeypatch):
    from tarn.plans import lake_queries

    put(tmp_path / "in", "a.ndjson.gz", *[f'{{"timestamp":"2024-01-{k % 5 + 1:02d}T00:00:{k % 60:02d}","n":{k}}}' for k in range(60)])
    pack.pack(spark, str(tmp_path / "in"), str(tmp_path / "out"), "t", "d", limit=100)
    monkeypatch.setattr(lake_queries, "_packed", lambda *_, **__: (f"{tmp_path}/out/t/d", None, None))
    out = lake_queries.QUERIES["sorted_parts"](spark, str(tmp_path))
    assert out._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location().partitionSchema().isEmpty()
    assert tuple(out.first()) == (True, True, 60)
