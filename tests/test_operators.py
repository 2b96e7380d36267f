import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import plan_text, make_xlsx, write
from ledgerlake.operators import dedup, grid, joins, keys, profile, quality, reshape
from ledgerlake.sources import workbook


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(new=st.sets(st.text(alphabet="abcxyzก", min_size=1, max_size=4), min_size=1, max_size=40),
       old=st.sets(st.text(alphabet="abcxyzก", min_size=1, max_size=4), max_size=10))
def test_assign_keys_matches_brute_force(spark, new, old):
    existing = spark.createDataFrame([(i + 1, k) for i, k in enumerate(sorted(old))], "sk long, nk string")
    cand = spark.createDataFrame([(k,) for k in new], "nk string").repartition(7)
    got = {r.nk: r.sk for r in keys.assign_keys(cand, "nk", "sk", existing=existing).collect()}
    fresh = sorted(k for k in new if k not in old)
    # Spark orders strings by UTF-8 bytes
    fresh = sorted(fresh, key=lambda s: s.encode())
    assert got == {k: len(old) + i + 1 for i, k in enumerate(fresh)}


def test_assign_keys_many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("nk"))
        got = keys.assign_keys(df, "nk", "sk").orderBy("nk").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [r.sk for r in got] == list(range(1, 5001)) and [r.nk for r in got] == list(range(5000))


def test_dedup_first_last_and_latest_tie_break(spark):
    df = spark.createDataFrame([("k", 1, "a", dt.date(2026, 7, 3)), ("k", 2, "b", dt.date(2026, 7, 10)),
                                ("k", 3, "c", dt.date(2026, 7, 10)), ("j", 9, "z", None)],
                               "key string, ord int, attr string, d date")
    first = {r.key: r.attr for r in dedup.dedup(df, "key", "ord", keep="first").collect()}
    last = {r.key: r.attr for r in dedup.dedup(df, "key", "ord", keep="last").collect()}
    assert first == {"k": "a", "j": "z"} and last == {"k": "c", "j": "z"}
    latest = {r.key: r.attr for r in dedup.latest_per_key(df, "key", "d", tie="ord").collect()}
    assert latest["k"] == "b"                               # equal dates: the first one wins
    with pytest.raises(ValueError):
        dedup.dedup(df, "key", "ord", keep="middle")


def test_insert_if_absent_first_load_wins(spark, scratch):
    target = spark.createDataFrame([("08", "old name")], "code string, name string")
    incoming = spark.createDataFrame([("08", "new name", 1), ("09", "b", 2), ("09", "c", 1)],
                                     "code string, name string, ord int")
    out = {r.code: r.name for r in keys.insert_if_absent(target, incoming.drop("ord"), "code").collect()
           if r.code == "08"}
    assert out == {"08": "old name"}
    new = keys.absent_rows(target, incoming, "code", ordinal="ord").collect()
    assert [(r.code, r.name) for r in new] == [("09", "c")]
    path = f"{scratch}/t"
    assert keys.append_if_absent(incoming, path, "code", ordinal="ord") == 2
    assert keys.append_if_absent(incoming, path, "code", ordinal="ord") == 0   # replay appends nothing
    assert spark.read.parquet(path).count() == 2


def test_resolve_key_fails_on_unknown(spark):
    facts = spark.createDataFrame([("08",), ("77",)], "code string")
    dim = spark.createDataFrame([("08", 1)], "code string, k long")
    with pytest.raises(Exception, match="unresolved"):
        keys.resolve_key(facts, dim, "code", "k").collect()
    assert keys.resolve_key(facts, dim, "code", "k", nullable=True).filter("k IS NULL").count() == 1


def test_lookup_join_runs_nothing_while_it_is_planned(spark):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    out = joins.lookup_join(spark.range(100), spark.range(10).withColumn("v", F.col("id") * 2), "id")
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert "BroadcastHashJoin" in plan_text(out) and out.count() == 10


def test_reconcile_reports_keys_that_one_side_lacks(spark):
    stated = spark.createDataFrame([("a", 3), ("b", 1), ("c", 5)], "k string, v long")
    children = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("d", 4)], "k string, v long")
    out = {r.k: r.matches for r in profile.reconcile(stated, children, "k", "v").collect()}
    assert out == {"a": True, "b": False, "c": False, "d": False}


def test_density_reads_whole_reports(spark):
    df = spark.range(1200).select(F.lit("r").alias("rep"), "id", F.lit("x" * 100).alias("text"))
    row = profile.classify_density(df, "rep", "id", "text").first()
    assert row.rows_with_data == 1200 and row.first_cell_text == "x" * 100


def test_rollup_levels_and_share(spark):
    df = spark.createDataFrame([("A", "a1", 3), ("A", "a2", 1), ("B", "b1", 4)], "p string, l string, v long")
    r = reshape.rollup_levels(df, "p", "l", "v")
    r = reshape.share_of_total(r, "headcount", total_rows=F.col("hierarchy_level") == 0)
    rows = {x.category_name: x for x in r.collect()}
    assert rows["ALL"].headcount == 8 and rows["ALL"].parent_category is None and rows["ALL"].hierarchy_level == 0
    assert rows["A"].hierarchy_level == 1 and rows["A"].parent_category == "ALL" and rows["A"].share_pct == 50.0
    assert rows["a1"].is_leaf and rows["a1"].parent_category == "A" and rows["a1"].share_pct == 37.5


def test_share_per_report_and_zero_total(spark):
    df = spark.createDataFrame([("r1", 0, 10), ("r1", 1, 5), ("r2", 0, 0), ("r2", 1, 0)],
                               "path string, level int, v long")
    out = reshape.share_of_total(df, "v", by=["path"], total_rows=F.col("level") == 0)
    got = {(r.path, r.level): r.share_pct for r in out.collect()}
    assert got[("r1", 1)] == 50.0 and got[("r2", 1)] is None


def test_wide_to_long(spark):
    wide = spark.createDataFrame([(1, 10.0, 1.0, 20.0, 2.0)], "id int, a_m1 double, a_m2 double, b_m1 double, b_m2 double")
    long = reshape.wide_to_long(wide, ["id"], [("a", "A", True), ("b", "B", False)], ["m1", "m2"])
    assert sorted(tuple(r) for r in long.collect()) == [(1, "A", True, 10.0, 1.0), (1, "B", False, 20.0, 2.0)]


def test_reconcile_with_tolerance(spark):
    stated = spark.createDataFrame([("g", 10.0), ("h", 5.0)], "k string, v double")
    kids = spark.createDataFrame([("g", 4.0), ("g", 6.0000001), ("h", 1.0)], "k string, v double")
    exact = {r.k: r.matches for r in profile.reconcile(stated, kids, "k", "v").collect()}
    tol = {r.k: r.matches for r in profile.reconcile(stated, kids, "k", "v", tolerance=1e-3).collect()}
    assert exact == {"g": False, "h": False} and tol == {"g": True, "h": False}


def test_profiles(spark):
    df = spark.createDataFrame([(1, 0.0), (1, -2.0), (None, 3.0), (2, 0.0)], "k int, m double")
    p = profile.profile_key(df, "k").first()
    assert (p.n, p.null_keys, p.dup_keys) == (4, 1, 1)
    m = profile.profile_measures(df, ["m"]).first()
    assert (m.col, m.zeros, m.negatives, m.n) == ("m", 2, 1, 4)
    fd = {r.k: r.holds for r in profile.holds_fd(df, "k", "m").collect()}
    assert fd[1] is False and fd[2] is True


def test_anchor_reasons(spark):
    cells = spark.createDataFrame([("r1", 0, 0, "H"), ("r1", 1, 0, "x"), ("r2", 0, 0, "Z")],
                                  "path string, row_idx int, col_idx int, value string")
    v = grid.check_anchors(cells, [(0, 0, "H"), (1, 0, "x"), (1, 1, "y")], "path")
    got = sorted((r.path, r.anchor_row, r.anchor_col, r.reason) for r in v.collect())
    assert got == [("r1", 1, 1, "mismatch"), ("r2", 0, 0, "mismatch"), ("r2", 1, 0, "missing_row"),
                   ("r2", 1, 1, "missing_row")]


def test_sheet_density_and_latest_file(spark, scratch):
    rows = [["title"], [], ["x", 1], [None, "y"]] + [[i] for i in range(600)]
    write(f"{scratch}/raw/2026_07_03.xlsx", make_xlsx({"full": rows, "empty": [], "tiny": [[1], [2]]}))
    write(f"{scratch}/raw/2026_07_10.xlsx", make_xlsx({"s": [["a"]]}))
    files = workbook.binary_files(spark, f"{scratch}/raw")
    cells = workbook.cells_from_binary(files)
    d = {(r.path.rsplit("/", 1)[1], r.sheet): r for r in
         profile.classify_sheet_density(cells, workbook.sheet_inventory(files)).collect()}
    full = d[("2026_07_03.xlsx", "full")]
    assert full.rows_with_data == 603 and full.sparse is False and full.first_cell_text == "title"
    assert d[("2026_07_03.xlsx", "empty")].rows_with_data == 0 and d[("2026_07_03.xlsx", "empty")].sparse
    assert d[("2026_07_03.xlsx", "tiny")].sparse and d[("2026_07_03.xlsx", "tiny")].first_cell_text == "1"
    assert workbook.latest_file(spark, f"{scratch}/raw").endswith("2026_07_10.xlsx")
    with pytest.raises(FileNotFoundError):
        workbook.latest_file(spark, f"{scratch}/raw", glob="*.none")


def test_tag_sections_config_and_dataframe_layouts_agree(spark):
    sections = ((0, 0, 0, None), (1, 1, 1, 0), (2, 2, 4, 1), (1, 5, 5, 0), (2, 6, 9, 5))
    rows = spark.createDataFrame([("r", i, f"n{i}") for i in range(12)] + [("s", i, f"m{i}") for i in range(4)],
                                 "path string, row_idx int, name string")
    a = grid.tag_sections(rows, sections, "path", "name")
    b = grid.tag_sections(rows, grid.layout_rows(spark, sections), "path", "name")
    key = lambda df: sorted(tuple(r) for r in df.select("path", "row_idx", "hierarchy_level", "parent_category",
                                                        "is_leaf").collect())
    assert key(a) == key(b)
    got = {(r.path, r.row_idx): (r.hierarchy_level, r.parent_category) for r in a.collect()}
    assert got[("r", 0)] == (0, None) and got[("r", 3)] == (2, "n1") and got[("r", 7)] == (2, "n5")
    assert ("r", 10) not in got and got[("s", 3)] == (2, "m1")


def test_records_from_cells_config_and_dataframe_layouts_agree(spark):
    cells = spark.createDataFrame([("p", 1, 0, "a"), ("p", 1, 2, "b"), ("p", 1, 5, "x"), ("p", 2, 2, "c")],
                                  "path string, row_idx int, col_idx int, value string")
    mapping = {"first": 0, "third": 2}
    a = grid.records_from_cells(cells, mapping, ["first", "third"], "path")
    b = grid.records_from_cells(cells, grid.layout_columns(spark, mapping), ["first", "third"], "path")
    rows = lambda df: sorted(tuple(r) for r in df.select("path", "row_idx", "first", "third").collect())
    assert rows(a) == rows(b) == [("p", 1, "a", "b"), ("p", 2, None, "c")]


def test_references_of_a_table_are_checked_together(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (None, 99), (9, 99), (9, 10)], "a int, b long")
    pa, pb = spark.createDataFrame([(1,), (2,)], "a int"), spark.createDataFrame([(10,)], "k int")
    out = quality.violations_fks(child, [("t.a", "a", pa, "a"), ("t.b", "b", pb, "k")])
    assert sorted(map(tuple, out.collect())) == [("t.a", 9), ("t.a", 9), ("t.b", 99), ("t.b", 99)]
