"""Refresh of served tables: keys checked before readers see a version, atomic pointers, access paths."""

import datetime

import pytest
from pyspark.sql import functions as F

from aloft.plans import pipeline as P
from aloft.plans import queries as Q
from aloft.session import delete_path, file_system
from aloft.sources import layout, tables
from aloft.sources import warehouse as W

SF = "/root/testdata/sf0.001"
THINGS = W.Contract("things", "k INT, v VARCHAR(4)", ("k",))
PAIRS = W.Contract("pairs", "a INT, b INT", ("a", "b"))
NUMBERED = W.Contract("numbered", "id BIGINT, v INT", ("id",), serial=True)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _folders(spark, path):
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("v-"))


@pytest.fixture
def path(spark):
    return P.new_scratch(spark, "table")


def test_duplicate_and_missing_keys_leave_the_old_table(spark, path):
    assert W.save_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, contract=THINGS) == 2
    for bad in ([(1, "x"), (3, "y"), (1, "z")], [(1, "x"), (None, "y")]):
        with pytest.raises(W.KeyViolationError, match="things"):
            W.save_table(spark.createDataFrame(bad, "k int, v string"), path, contract=THINGS)
        assert _rows(W.read_table(spark, path, THINGS)) == [(1, "a"), (2, "b")]
    assert len(_folders(spark, path)) == 1
    with pytest.raises(W.KeyViolationError, match=r"1 duplicate key\(s\), the first \(1, 2\)"):
        W.save_table(spark.createDataFrame([(1, 2), (1, 2), (2, 1)], "a int, b int"), path + "-2", contract=PAIRS)
    with pytest.raises(tables.NoTableError):
        W.read_table(spark, path + "-2", PAIRS)


@pytest.mark.parametrize("ids, good", [([1, 2, 3], True), ([], True), ([1, 2, 2], False), ([2, 3, 4], False), ([1, 3, 4], False),
                                       ([1, 1, 4, 4], False)])
def test_serial_keys_are_numbered_without_gap(spark, path, ids, good):
    df = spark.createDataFrame([(i, 0) for i in ids], "id long, v int")
    if good:
        assert W.save_table(df, path, contract=NUMBERED) == len(ids)
    else:
        with pytest.raises(W.KeyViolationError):
            W.save_table(df, path, contract=NUMBERED)


def test_a_load_with_a_duplicate_key_is_reported_and_the_old_table_stays(spark, monkeypatch):
    out = P.new_scratch(spark, "tables")
    enriched = Q.enriched(spark, SF)
    first = {r.table: r for r in P.load_tables(spark, enriched, out)}
    assert all(r.status == "loaded" for r in first.values())
    load = W.load_summary
    monkeypatch.setattr(W, "load_summary", lambda s, c: load(s.unionByName(s), c) if c is W.CARRIER else load(s, c))
    again = {r.table: r for r in P.load_tables(spark, enriched, out)}
    assert again["carrier_summary"].status == "failed" and "duplicate key" in again["carrier_summary"].error
    assert again["route_summary"].status == "loaded"
    assert W.read_table(spark, f"{out}/carrier_summary", W.CARRIER).count() == first["carrier_summary"].rows
    for name, _, _ in P.VIEWS:
        spark.catalog.dropTempView(name)
    views = P.register_views(spark, out, {t for t, r in again.items() if r.status == "loaded"})
    assert "carrier_disruption" not in views and len(views) == 6
    assert not spark.catalog.tableExists("carrier_disruption") and spark.table("monthly_trend").count() > 0


def test_interrupted_before_the_pointer(spark, path, monkeypatch):
    W.save_table(spark.range(5), path)

    def stopped(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(tables, "commit", stopped)
        with pytest.raises(KeyboardInterrupt):
            W.save_table(spark.range(9), path)
    assert tables.read(spark, path).count() == 5
    # the driver dies: files of the new version stay without a pointer
    spark.range(9).write.parquet(tables.new_version(path))
    assert tables.read(spark, path).count() == 5
    # a pointer that was cut off while it was written
    fs, p = file_system(spark, f"{path}/{tables.LOG}/000000000002.json")
    stream = fs.create(p, False)
    stream.write(bytearray(b'{"version": "v-'))
    stream.close()
    assert tables.current(spark, path).number == 1 and tables.read(spark, path).count() == 5
    assert W.save_table(spark.range(7), path) == 7
    assert tables.current(spark, path).number == 3 and tables.read(spark, path).count() == 7


def test_a_reader_that_has_begun_keeps_its_version(spark, path):
    W.save_table(spark.range(5), path)
    begun = tables.read(spark, path)
    W.save_table(spark.range(6), path)
    assert begun.count() == 5 and tables.read(spark, path).count() == 6
    for n in (7, 8):
        W.save_table(spark.range(n), path)
    assert len(_folders(spark, path)) == tables.KEEP
    assert tables.read(spark, path).count() == 8


def test_two_writers_cannot_commit_the_same_number(spark, path, monkeypatch):
    W.save_table(spark.range(5), path)
    monkeypatch.setattr(tables, "_pointers", lambda *_: [])  # this writer has not seen the other one's pointer
    with pytest.raises(tables.CommitConflictError):
        W.save_table(spark.range(6), path)
    monkeypatch.undo()
    assert tables.read(spark, path).count() == 5


def test_rows_are_counted_during_the_write(spark, path):
    plans = spark.range(100).withColumn("k", F.col("id").cast("int"))
    counted = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            counted.add(b.num_rows)
            yield b

    assert W.save_table(plans.mapInArrow(once, plans.schema), path) == 100
    assert counted.value == 100


# -- access paths ----------------------------------------------------------------------------------


def test_ranks_and_curve(spark):
    values = [None, "a", "b", "c", "d", "zz"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(layout.rank(F.col("v"), ["b", "c", "d"])).collect()]
    assert got == [0, 0, 1, 2, 3, 3]
    grid = spark.range(64).select((F.col("id") % 8).cast("int").alias("x"), F.floor(F.col("id") / 8).cast("int").alias("y"))
    for r in grid.withColumn("z", layout.curve([F.col("x"), F.col("y")], 3)).collect():
        assert r["z"] == sum(((r["x"] >> b) & 1) << (2 * b + 1) | ((r["y"] >> b) & 1) << (2 * b) for b in range(3))


@pytest.fixture(scope="module")
def flights(spark):
    path = P.new_scratch(spark, "flights")
    rows = W.load_flights(Q.enriched(spark, SF), staged=True)
    W.save_table(rows, path, contract=W.FLIGHTS, rows_per_file=60,
                 **{**P.FLIGHT_LAYOUT, "partition_by": (), "cluster_by": (*P.FLIGHT_CLUSTER, "year", "month")})
    return path, rows.collect()


PATHS = [{"origin": "A07"}, {"dest": "A03"}, {"route": "A07-A03"}, {"op_unique_carrier": "C4"}, {"year": 1996, "month": 5},
         {"disrupted": 1}, {"fl_date": datetime.date(1995, 3, 4)}, {"fl_date": (datetime.date(1996, 1, 1), datetime.date(1996, 2, 1))},
         {"origin": "A07", "disrupted": 1}, {"fl_date": None}, {"origin": "ZZZ"}]


@pytest.mark.parametrize("conditions", PATHS, ids=str)
def test_each_access_path_finds_its_rows_and_skips_files(spark, flights, conditions):
    path, rows = flights

    def holds(r):
        return all(r[c] is not None and v[0] <= r[c] <= v[1] if isinstance(v, tuple) else r[c] == v for c, v in conditions.items())

    found = W.read_table_where(spark, path, W.FLIGHTS, **conditions)
    assert sorted(r["flight_id"] for r in found.collect()) == sorted(r["flight_id"] for r in rows if holds(r))
    folder = tables.current(spark, path).folder
    zones = spark.read.parquet(f"{folder}/{layout.ZONES}")
    kept = layout.zones_where(zones, conditions)
    assert zones.agg(F.sum("rows")).first()[0] == len(rows)
    if conditions != {"fl_date": None}:  # rows without a date are spread
        assert kept.count() < zones.count()


def test_row_groups_follow_the_files(spark, flights):
    import glob

    import pyarrow.parquet as pq
    path, _ = flights
    folder = tables.current(spark, path).folder.removeprefix("file:")
    files = glob.glob(f"{folder}/part-*.parquet")
    found = [pq.ParquetFile(f).metadata for f in files]
    assert len(found) > 20 and all(m.num_row_groups == 1 and m.num_rows <= 60 for m in found)
    column = {c: i for i, c in enumerate(pq.ParquetFile(files[0]).schema_arrow.names)}["origin"]
    stats = [m.row_group(0).column(column).statistics for m in found]
    assert sum(s.min <= "A07" <= s.max for s in stats) < len(stats)


def test_partitioned_flights_are_read_by_path(spark, path):
    flights = W.load_flights(Q.enriched(spark, SF), staged=True)
    W.save_table(flights, path, contract=W.FLIGHTS, **P.FLIGHT_LAYOUT)
    got = W.read_table_where(spark, path, W.FLIGHTS, year=1996, month=5, origin="A07")
    want = flights.where("year = 1996 and month = 5 and origin = 'A07'")
    assert _rows(got.select("flight_id", "year", "month")) == _rows(want.select("flight_id", "year", "month"))
    delete_path(spark, path)
