"""Driver queries: each operator of the inventory applied to the given tables.

Every query reads whole tables (no id ranges, no row caps) and is built from
the package's operators. ``ORACLE_SQL`` holds an independent DuckDB statement
per query with identical column names and types.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import scalars as sc
from ..functions import web
from ..operators import dedup, dependencies, grid, hierarchy, joins, keys, profile, quality, reshape
from ..sources import manifest
from ..sources.tables import TABLES, ntz, table
from ..streaming.status import ingest_status, landed_status
from . import reports
from .calendar_dim import build_dim_date
from .warehouse import ROW_RULES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# The "previous load" boundaries used by the incremental queries.
EVENTS_PREVIOUS_LOAD_END = "2024-01-15 00:00:00"
SHIPMENTS_PREVIOUS_LOAD_END = "2001-01-01 00:00:00"

# Fixed value: the priority whose orders no earlier load knows.
UNCONFIGURED_SOURCE = "5-LOW"

# The money groups of the order report (prefix, name, is_leaf).
ORDER_GROUPS = (("F", "F", True), ("O", "O", True), ("P", "P", True), ("total", "total", False))

# Section layout of a conversation "report" (level, first row, last row, parent row).
CONVERSATION_SECTIONS = ((0, 0, 0, None), (1, 1, 1, 0), (2, 2, 3, 1), (1, 4, 4, 0), (2, 5, 7, 4))
# Fixed value: by how much an order's lines may miss its stated total.
RECONCILE_TOLERANCE = 5000
# Fixed value: the end of a section that runs to the report's last row.
LAST_ROW = 1 << 40
# Fixed value: shorter utterances are left out of the sheets of the missing-row queries.
SPOKEN_LENGTH = 100
# Header anchors every conversation must carry (row, col, text).
CONVERSATION_ANCHORS = ((0, 0, "user"), (1, 0, "assistant"), (2, 0, "user"))


def _t(spark, d, name):
    return table(spark, d, name)


def _order_amounts_wide(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return o.groupBy("o_custkey").agg(
        F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "F", price)), F.lit(0)).cast("decimal(28,2)").alias("F_amount"),
        F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "O", price)), F.lit(0)).cast("decimal(28,2)").alias("O_amount"),
        F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "P", price)), F.lit(0)).cast("decimal(28,2)").alias("P_amount"),
        F.sum(price).cast("decimal(28,2)").alias("total_amount"),
    )


def _customer_geo(spark, d) -> DataFrame:
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = _t(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    # Customers are never shuffled on the (few-valued) nation / region keys.
    return joins.lookup_join(joins.lookup_join(c, n, "c_nationkey"), r, "n_regionkey")


def _nation_rollup(spark, d) -> DataFrame:
    geo = _customer_geo(spark, d).withColumn("_one", F.lit(1))
    return reshape.rollup_levels(geo, "r_name", "n_name", "_one")


def _conversation_rows(spark, d) -> DataFrame:
    return _t(spark, d, "conversations").select("conv_id", F.col("turn").alias("row_idx"), "role", "text")


# ---------------------------------------------------------------- grids

@query
def grid_slice(spark, d):
    rows = _conversation_rows(spark, d).select("conv_id", "row_idx", "role")
    return grid.slice_between_header_and_total(rows, "conv_id")


@query
def grid_to_records(spark, d):
    cells = grid.table_cells(_t(spark, d, "conversations"), "conv_id", "turn", ["role", "text"])
    return grid.records_from_cells(cells, {"speaker": 0, "utterance": 1}, ["speaker", "utterance"], "conv_id")


def _spoken_cells(spark, d) -> DataFrame:
    """Conversations as sheets in which short utterances were left out."""
    said = _t(spark, d, "conversations").withColumn("text", F.when(F.length("text") >= SPOKEN_LENGTH, F.col("text")))
    return grid.table_cells(said, "conv_id", "turn", ["text"])


@query
def missing_data_rows(spark, d):
    reports = _t(spark, d, "conversations").select("conv_id").distinct()
    ranges = [(first, last) for _, first, last, _ in CONVERSATION_SECTIONS]
    return grid.missing_rows(reports, _spoken_cells(spark, d), "conv_id", ranges)


@query
def dense_records(spark, d):
    return grid.records_from_cells(_spoken_cells(spark, d), {"utterance": 0}, ["utterance"], "conv_id",
                                   rows=[(first, last) for _, first, last, _ in CONVERSATION_SECTIONS])


@query
def hierarchy_tag(spark, d):
    rows = _conversation_rows(spark, d).select("conv_id", "row_idx", F.col("role").alias("category_name"))
    return grid.tag_sections(rows, CONVERSATION_SECTIONS, "conv_id", "category_name")


@query
def section_tables(spark, d):
    """A layout of its own for every conversation: each question a heading, what follows it its section."""
    rows = _conversation_rows(spark, d).select("conv_id", "row_idx", F.col("role").alias("category_name"))
    asked = rows.filter(F.col("category_name") == "user").withColumn(
        "next", F.lead("row_idx").over(Window.partitionBy("conv_id").orderBy("row_idx")))
    def section(level, first, last, parent):
        return F.struct(F.lit(level).alias("hierarchy_level"), first.alias("row_start"), last.alias("row_end"), parent.alias("parent_row"))

    at = F.col("row_idx")
    layout = asked.select("conv_id", F.inline(F.array(
        section(1, at, at, F.lit(None).cast("long")), section(2, at + 1, F.coalesce(F.col("next") - 1, F.lit(LAST_ROW)), at))))
    return grid.tag_sections(rows, layout, "conv_id", "category_name")


@query
def row_extent(spark, d):
    e = _t(spark, d, "events").select(
        "event_id", F.lit("x").alias("c0"),
        F.when(F.col("value") > 50, F.lit("x")).alias("c1"),
        F.when(F.col("value") > 100, F.lit("x")).alias("c2"))
    cells = grid.table_cells(e, [], "event_id", ["c0", "c1", "c2"])
    return grid.row_extent(cells, []).withColumnRenamed("row_idx", "event_id")


@query
def anchor_check(spark, d):
    cells = grid.table_cells(_t(spark, d, "conversations"), "conv_id", "turn", ["role"])
    return grid.check_anchors(cells, CONVERSATION_ANCHORS, "conv_id")


# ---------------------------------------------------------------- reshape / rollup

@query
def wide_to_long(spark, d):
    return reshape.wide_to_long(_order_amounts_wide(spark, d), ["o_custkey"], ORDER_GROUPS, ["amount"],
                                name_col="grp")


@query
def hierarchy_rollup(spark, d):
    r = _nation_rollup(spark, d)
    return reshape.share_of_total(r, "headcount", total_rows=F.col("hierarchy_level") == 0)


@query
def leaf_vs_naive_sum(spark, d):
    r = _nation_rollup(spark, d)
    return r.agg(F.sum("headcount").cast("long").alias("naive_sum"),
                 F.sum(F.when(F.col("is_leaf"), F.col("headcount"))).cast("long").alias("leaf_sum"),
                 F.count_if(F.col("is_leaf")).alias("n_leaves"))


@query
def share_of_total(spark, d):
    geo = _customer_geo(spark, d)
    per = geo.groupBy("n_name").agg(F.count(F.lit(1)).alias("headcount"))
    return reshape.share_of_total(per, "headcount")


@query
def rollup_reconcile(spark, d):
    c = _t(spark, d, "customer").select("c_nationkey")
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    cn = joins.lookup_join(c, n, "c_nationkey")
    leaf = cn.groupBy("n_regionkey", "c_nationkey").agg(F.count(F.lit(1)).alias("v"))
    sub = cn.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("v"))
    out = profile.reconcile(sub, leaf, "n_regionkey", "v")
    return out.select("n_regionkey", "stated", F.col("children").cast("long").alias("children"), "matches")


# ---------------------------------------------------------------- scalars

@query
def ratio_null_on_zero(spark, d):
    li = _t(spark, d, "lineitem")
    is_r = F.col("l_returnflag") == "R"
    a = li.groupBy("l_orderkey").agg(
        F.sum(F.when(is_r, F.col("l_quantity")).otherwise(F.lit(0.0))).alias("base"),
        F.sum(F.when(is_r & (F.col("l_linestatus") == "F"), F.col("l_quantity")).otherwise(F.lit(0.0))).alias("part"))
    return a.select("l_orderkey", "base", "part", sc.remaining("base", "part").alias("remaining"),
                    sc.round6(sc.safe_pct("part", "base")).alias("part_pct"))


@query
def era_date_parse(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", cal.format_era_date("o_orderdate").alias("be_text"))
    return o.select("o_orderkey", "be_text", cal.parse_era_date("be_text").alias("report_date"))


@query
def fiscal_calendar(spark, d):
    dates = _t(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("report_date")).distinct()
    return dates.select(
        "report_date",
        cal.fiscal_year_ce("report_date").alias("fiscal_year_ce"),
        cal.fiscal_year_be("report_date").alias("fiscal_year_be"),
        F.month("report_date").alias("month"),
        cal.fiscal_quarter(F.month("report_date")).alias("quarter"),
        cal.is_month_end("report_date").alias("is_month_end"))


@query
def conformed_dates(spark, d):
    # Years come from the distinct dates, so both branches share one scan and shuffle.
    dates = _t(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("report_date")).distinct()
    years = dates.select(cal.fiscal_year_be("report_date").alias("fiscal_year_be"))
    return build_dim_date(dates, years)


@query
def strict_cast(spark, d):
    e = _t(spark, d, "events")
    return e.select("event_id", sc.lenient_number(F.regexp_extract("props", r"([0-9]+)", 1)).alias("k"))


@query
def bool_parse(spark, d):
    e = _t(spark, d, "events")
    staged = (F.col("value") > 50).cast("string")
    return e.select("event_id", sc.to_bool(staged).alias("flag"))


@query
def whitespace_profile(spark, d):
    p = _t(spark, d, "pages")
    nodes = p.select(web.page_lang("html").alias("lang"), web.text_nodes("html").alias("nodes"))
    return profile.profile_whitespace_arrays(nodes, "nodes", "lang")


# ---------------------------------------------------------------- listing pages

@query
def listing_links(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", F.explode(web.hrefs("html")).alias("href"))


@query
def page_has_file_link(spark, d):
    return _t(spark, d, "pages").select("page_id", web.has_file_link("html").alias("has_file_link"))


@query
def resolve_relative_url(spark, d):
    p = _t(spark, d, "pages").select("page_id", "url", F.explode(web.hrefs("html")).alias("href"))
    return p.select("page_id", "href", web.resolve_url("url", "href").alias("abs_url"))


@query
def resolve_references(spark, d):
    """Every link of every page in the forms a listing may write it."""
    p = _t(spark, d, "pages").select("page_id", "url", F.explode(web.hrefs("html")).alias("href"))
    rest = F.regexp_replace("href", "^/+", "")
    forms = F.array(F.concat(F.lit("../"), rest), F.concat(F.lit("./x/../../y/"), rest), F.concat(F.lit("/a/b/.././"), rest, F.lit("/..")),
                    F.concat(F.lit("?from="), F.col("page_id")), F.lit("#top"), F.concat(F.lit("//cdn.example.org/"), rest), F.lit("mailto:a@b.org"))
    p = p.select("page_id", "url", F.explode(forms).alias("ref")).distinct()
    return p.select("page_id", "ref", web.resolve_url("url", "ref").alias("abs_url"))


@query
def download_args(spark, d):
    return _t(spark, d, "pages").select("page_id", web.call_arg(F.col("html"), "track", 1).alias("target"))


@query
def prefix_count(spark, d):
    p = _t(spark, d, "part")
    return p.agg(F.count_if(F.col("p_type").startswith("PROMO")).alias("hits"),
                 F.count("p_type").alias("non_empty"))


# ---------------------------------------------------------------- dedup / latest

@query
def latest_per_key(spark, d):
    e = _t(spark, d, "events")
    return dedup.latest_per_key(e, "user_id", "ts", tie="event_id").select("user_id", "event_id", "ts")


@query
def dim_last_wins(spark, d):
    o = _t(spark, d, "orders")
    return dedup.dedup(o, "o_custkey", "o_orderkey", keep="last").select(
        F.col("o_custkey").alias("natural_key"), F.col("o_orderpriority").alias("attr"))


@query
def first_wins(spark, d):
    o = _t(spark, d, "orders")
    return dedup.dedup(o, "o_custkey", "o_orderkey", keep="first").select("o_custkey", "o_orderkey", "o_orderpriority")


@query
def distinct_levels(spark, d):
    return _t(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query
def first_last_row(spark, d):
    e = _t(spark, d, "events")
    return e.groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("first_type"),
                                    F.max_by("event_type", "event_id").alias("last_type"))


@query
def high_water_mark(spark, d):
    e = _t(spark, d, "events")
    known = dedup.high_water_mark(e.filter(F.col("ts") < ntz(EVENTS_PREVIOUS_LOAD_END)), "event_type", "ts")
    return dedup.newer_than_known(e, known, "event_type", "ts").select("event_id", "event_type")


@query
def content_hash_dedup(spark, d):
    docs = _t(spark, d, "documents")
    return docs.groupBy(web.sha256_hex("text").alias("content_sha256")).agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


@query
def hash_already_known(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", web.sha256_hex("text").alias("h"))
    labeled = _t(spark, d, "labels").select("doc_id")
    known = docs.join(labeled, "doc_id", "left_semi")
    probe = docs.join(labeled, "doc_id", "left_anti")
    return keys.in_known(probe, known, "h", flag="is_duplicate").select("doc_id", "is_duplicate")


# ---------------------------------------------------------------- keys / loading

@query
def surrogate_keys(spark, d):
    pri = _t(spark, d, "orders").select(F.col("o_orderpriority").alias("natural_key"))
    return keys.assign_keys(pri, "natural_key", "sk")


@query
def customer_keys(spark, d):
    names = _t(spark, d, "customer").select(F.col("c_name").alias("natural_key"))
    return keys.assign_keys(names, "natural_key", "sk")


@query
def resolve_fact_keys(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    dim = keys.assign_keys(o, "o_orderstatus", "status_key")
    return keys.resolve_key(o, dim, "o_orderstatus", "status_key").select("o_orderkey", "status_key")


@query
def insert_if_absent(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    k = ["user_id", "event_type"]
    existing = dedup.dedup(e.filter(F.col("ts") < ntz(EVENTS_PREVIOUS_LOAD_END)), k, "event_id") \
        .select("user_id", "event_type", "event_id")
    incoming = e.select("user_id", "event_type", "event_id")
    return keys.insert_if_absent(existing, incoming, k, ordinal="event_id")


@query
def parent_key_lookup(spark, d):
    c = _t(spark, d, "customer")
    cat = (spark.range(1).select(F.lit("ALL").alias("category_name"), F.lit(0).alias("hierarchy_level"),
                                 F.lit(None).cast("string").alias("parent_category"))
           .unionByName(c.select(F.col("c_mktsegment").alias("category_name")).distinct()
                        .select("category_name", F.lit(1).alias("hierarchy_level"),
                                F.lit("ALL").alias("parent_category")))
           .unionByName(c.select(F.col("c_name").alias("category_name"), F.lit(2).alias("hierarchy_level"),
                                 F.col("c_mktsegment").alias("parent_category"))))
    dim = keys.assign_keys(cat, "category_name", "category_key")
    out = keys.resolve_key(cat, dim, "category_name", "category_key")
    out = keys.resolve_optional_key(out, dim, "parent_category", "category_name", "category_key",
                                    "parent_category_key")
    return out.select("category_key", "parent_category_key", "hierarchy_level")


def _customer_tree(spark, d) -> DataFrame:
    """Every nation's customers as a binary tree by balance (the parent of the n-th is the n/2-th); where the
    first one is in machinery it hangs below the third, so that nation's tree runs into a cycle."""
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    ranked = c.withColumn("n", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_acctbal", "c_custkey")))
    up = F.when(F.col("n") > 1, F.floor(F.col("n") / 2).cast("int")).when(F.col("c_mktsegment") == "MACHINERY", F.lit(3))
    above = ranked.select("c_nationkey", F.col("n").alias("_up"), F.col("c_custkey").alias("parent_key"))
    return ranked.withColumn("_up", up).join(above, ["c_nationkey", "_up"], "left").select("c_custkey", "parent_key", "c_acctbal")


@query
def hierarchy_levels(spark, d):
    return hierarchy.ancestors(_customer_tree(spark, d), "c_custkey", "parent_key").select(
        "node", "parent", "level", "root", F.array_join(F.col("path").cast("array<string>"), "<").alias("path"), "problem")


@query
def hierarchy_leaf_sums(spark, d):
    tree = _customer_tree(spark, d)
    values = tree.select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    sums = hierarchy.leaf_sums(hierarchy.ancestors(tree, "c_custkey", "parent_key"), values, "balance", "c_custkey")
    return sums.withColumn("total", F.col("total").cast("decimal(28,2)"))


@query
def star_join_leaf_sum(spark, d):
    long = wide_to_long(spark, d).drop("is_leaf")
    expense_type = spark.createDataFrame([(g, leaf) for _, g, leaf in ORDER_GROUPS], "grp string, is_leaf boolean")
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    # The expense-type dimension is a 3-row configuration table: broadcast by construction.
    f = long.join(F.broadcast(expense_type), "grp").filter(F.col("is_leaf"))
    f = f.join(c, f.o_custkey == c.c_custkey)
    return f.groupBy("c_nationkey").agg(F.sum("amount").cast("decimal(38,2)").alias("leaf_amount"))


def _order_entries(spark, d, source="o_orderstatus") -> DataFrame:
    """Orders as manifest entries; an order's content is its price in hundreds, so the same bytes recur."""
    price = F.round(F.col("o_totalprice") / 100).cast("long").cast("string")
    return _t(spark, d, "orders").select(
        F.col(source).cast("string").alias("source"), F.col("o_orderpriority").alias("source_name_th"),
        F.concat(F.lit("https://example.org/"), "o_orderkey").alias("source_url"), F.col("o_orderkey").cast("string").alias("local_path"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("report_date"), F.lit(None).cast("int").alias("fiscal_year_be"),
        web.sha256_hex(price.cast("binary")).alias("sha256"), F.col("o_orderkey").alias("ordinal"), "o_orderstatus", "o_orderdate", "o_orderpriority")


@query
def manifest_entries(spark, d):
    o = _order_entries(spark, d)
    reports = o.select("source", F.to_date("report_date").alias("report_date"), "sha256")
    return manifest.build_entries(reports, manifest.latest_per_source(o)).withColumn(
        "file_name", web.base_name("local_path")).drop("fiscal_year_be", "downloaded_at")


@query
def landed_files(spark, d):
    """Orders as report files, one source a priority: fulfilled ones before the boundary are in the manifest
    (no source's but the unconfigured one's), all land, pending ones unreadable."""
    entries = _order_entries(spark, d, source="o_orderpriority")
    known = entries.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < ntz(SHIPMENTS_PREVIOUS_LOAD_END))
                           & (F.col("source") != UNCONFIGURED_SOURCE))
    files = entries.select(
        "source", F.concat_ws("/", "source", "local_path").alias("path"), "sha256",
        F.when(F.col("o_orderpriority").isNotNull(), F.to_date("report_date")).alias("report_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit("unreadable")).alias("error"))
    return landed_status(files, known)


@query
def table_row_counts(spark, d):
    out = None
    for name in TABLES:
        c = _t(spark, d, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = c if out is None else out.unionByName(c)
    return out


# ---------------------------------------------------------------- quality / profiles

@query
def key_profile(spark, d):
    return profile.profile_key(_t(spark, d, "orders"), "o_custkey")


@query
def measure_profile(spark, d):
    return profile.profile_measures(_t(spark, d, "lineitem"), ["l_discount", "l_tax"])


@query
def density_classify(spark, d):
    docs = _t(spark, d, "documents")
    return profile.classify_density(docs, "source", "doc_id", "text")


@query
def density_summary(spark, d):
    return profile.density_summary(density_classify(spark, d))


@query
def negative_positions(spark, d):
    c = profile.negative_positions(_t(spark, d, "customer"), ["c_acctbal"], "c_custkey") \
        .select(F.col("c_custkey").alias("row_key"), "col", "value")
    s = profile.negative_positions(_t(spark, d, "supplier"), ["s_acctbal"], "s_suppkey") \
        .select(F.col("s_suppkey").alias("row_key"), "col", "value")
    return c.unionByName(s)


@query
def dirty_text_nodes(spark, d):
    p = _t(spark, d, "pages").select("page_id", web.text_nodes("html").alias("nodes"))
    return profile.dirty_values_in_arrays(p, "nodes", "page_id", value_col="node")


@query
def not_null_violations(spark, d):
    o = quality.violations_not_null(_t(spark, d, "orders"),
                                    ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"], "o_orderkey")
    li = quality.violations_not_null(_t(spark, d, "lineitem"),
                                     ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
                                     "l_orderkey")
    return (o.select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("row_key"), "null_column")
            .unionByName(li.select(F.lit("lineitem").alias("table_name"), F.col("l_orderkey").alias("row_key"),
                                   "null_column")))


@query
def unique_violations(spark, d):
    return quality.violations_unique(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def functional_dependency(spark, d):
    return profile.holds_fd(_t(spark, d, "customer"), "c_nationkey", "c_mktsegment")


@query
def all_dependencies(spark, d):
    found = None
    for name in ("part", "customer"):
        part = dependencies.dependencies(_t(spark, d, name)).select(
            F.lit(name).alias("table_name"), F.array_join("left", ",").alias("left"), "right")
        found = part if found is None else found.unionByName(part)
    return found


@query
def fk_violations(spark, d):
    t = lambda n: _t(spark, d, n)
    references = {
        "orders": [("orders.o_custkey", "o_custkey", t("customer"), "c_custkey")],
        "lineitem": [("lineitem.l_orderkey", "l_orderkey", t("orders"), "o_orderkey"),
                     ("lineitem.l_partkey", "l_partkey", t("part"), "p_partkey"),
                     ("lineitem.l_suppkey", "l_suppkey", t("supplier"), "s_suppkey")],
        "customer": [("customer.c_nationkey", "c_nationkey", t("nation"), "n_nationkey")],
        "supplier": [("supplier.s_nationkey", "s_nationkey", t("nation"), "n_nationkey")],
        "nation": [("nation.n_regionkey", "n_regionkey", t("region"), "r_regionkey")],
        "labels": [("labels.doc_id", "doc_id", t("documents"), "doc_id")],
        "documents": [("documents.doc_id", "doc_id", t("labels"), "doc_id")],
    }
    out = None
    for child, refs in references.items():
        v = quality.violations_fks(t(child), refs)
        out = v if out is None else out.unionByName(v)
    return out


@query
def check_violations(spark, d):
    c = quality.violations_check(_t(spark, d, "customer"), F.col("c_acctbal") >= 0, "c_custkey", "acctbal_nonneg")
    s = quality.violations_check(_t(spark, d, "supplier"), F.col("s_acctbal") >= 0, "s_suppkey",
                                 "acctbal_nonneg_supplier")
    return (c.select(F.col("c_custkey").alias("row_key"), "check_name")
            .unionByName(s.select(F.col("s_suppkey").alias("row_key"), "check_name")))


@query
def pattern_violations(spark, d):
    return quality.violations_pattern(_t(spark, d, "orders"), "o_orderpriority", r"^[0-9]-[A-Z]+$", "o_orderkey")


@query
def ingest_status_by_part(spark, d):
    parts = _t(spark, d, "part").select("p_partkey")
    li = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_shipdate")
    latest = li.groupBy("p_partkey").agg(F.max("l_shipdate").alias("latest_ts"))
    known = dedup.high_water_mark(li.filter(F.col("l_shipdate") < ntz(SHIPMENTS_PREVIOUS_LOAD_END)),
                                  "p_partkey", "l_shipdate")
    return ingest_status(parts, latest, known, "p_partkey")


# ---------------------------------------------------------------- production operators on uneven data

def _labelled(spark, d) -> DataFrame:
    """Documents with their labels, which many lack."""
    return _t(spark, d, "documents").select("doc_id", "source").join(_t(spark, d, "labels"), "doc_id", "left")


@query
def order_reconcile(spark, d):
    """Orders' stated totals against the sum of their lines (few agree)."""
    money = lambda c: F.round(F.col(c)).cast("decimal(18,0)").alias("v")
    stated = _t(spark, d, "orders").select("o_orderkey", money("o_totalprice"))
    lines = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), money("l_extendedprice"))
    out = profile.reconcile(stated, lines, "o_orderkey", "v", tolerance=RECONCILE_TOLERANCE)
    return out.select("o_orderkey", "stated", F.col("children").cast("decimal(28,0)").alias("children"), "matches")


@query
def labels_not_null(spark, d):
    return quality.violations_not_null(_labelled(spark, d), ["source", "quality", "toxic"], "doc_id")


@query
def label_key_profile(spark, d):
    return profile.profile_key(_labelled(spark, d), "quality")


@query
def sheet_cell_counts(spark, d):
    """Conversations as workbooks, roles as their sheets; long utterances count as formulas, short ones as empty cells."""
    said = _t(spark, d, "conversations")
    return profile.sheet_counts(said.select(
        F.col("conv_id").cast("string").alias("path"), F.col("role").alias("sheet"),
        F.when(F.length("text") >= SPOKEN_LENGTH, F.col("text")).alias("value"),
        F.when(F.length("text") >= 5 * SPOKEN_LENGTH, F.col("text")).alias("formula")))


@query
def era_date_filter(spark, d):
    """Dates written with the day three too late: those that don't exist are dropped."""
    o = _t(spark, d, "orders").select("o_orderkey", F.concat(
        (F.dayofmonth("o_orderdate") + 3).cast("string"), F.date_format("o_orderdate", "/MM/"),
        (F.year("o_orderdate") + cal.ERA_OFFSET).cast("string")).alias("be_text"))
    return o.withColumn("report_date", cal.parse_era_date("be_text")).filter(F.col("report_date").isNotNull())


@query
def attached_reports(spark, d):
    entries = _order_entries(spark, d)
    files = entries.select(F.concat(F.lit("landing/"), "source", F.lit("/"), "local_path").alias("path"))
    return reports.attach_reports(files, entries, "F").select("path", "source", "report_date", "sha256")


@query
def known_report_dates(spark, d):
    return manifest.known_dates(_order_entries(spark, d, source="o_orderpriority"))


@query
def strict_numbers(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *(F.col(c).cast("string").alias(f"{c}_text") for c in ("l_partkey", "l_quantity")))
    return li.select("l_orderkey", "l_linenumber", sc.required_number("l_partkey_text", "long", "part").alias("part"),
                     sc.required_number("l_quantity_text", "double", "quantity").alias("quantity"))


@query
def bool_forms(spark, d):
    text = (F.when(F.col("value") > 100, " TRUE ").when(F.col("value") > 50, "True\t").when(F.col("value") > 20, "yes").when(F.col("value") > 10, ""))
    return _t(spark, d, "events").select("event_id", sc.to_bool(text).alias("flag"))


@query
def text_preview(spark, d):
    return _t(spark, d, "documents").select("doc_id", web.preview("text", SPOKEN_LENGTH).alias("preview"))


@query
def sampled_density(spark, d):
    said = _t(spark, d, "conversations").withColumn("text", F.when(F.length("text") >= SPOKEN_LENGTH, F.col("text")))
    return profile.classify_density(said, "conv_id", "turn", "text", sample_rows=3, preview_chars=20)


@query
def order_by_hash(spark, d):
    """Each source's three documents with the smallest content hashes."""
    docs = _t(spark, d, "documents").select("source", "doc_id", web.sha256_hex("text").alias("sha256"))
    return dedup.first_per_key(docs, "source", [F.col("sha256").asc(), F.col("doc_id").asc()], k=3)


@query
def era_rule_violations(spark, d):
    """The calendar's own rule on dates whose Buddhist year was taken from the calendar year, not the fiscal one."""
    o = _t(spark, d, "orders").select(F.to_date("o_orderdate").alias("report_date")).distinct()
    o = o.withColumns({"fiscal_year_ce": cal.fiscal_year_ce("report_date"), "fiscal_year_be": F.year("report_date") + cal.ERA_OFFSET})
    return quality.violations_check(o, F.expr(ROW_RULES["dim_date"]["check_era"]), "report_date", "check_era")


@query
def parent_rule_violations(spark, d):
    """The workforce table's rule that the grand total alone has no parent, on sections whose headings have none."""
    rows = section_tables(spark, d).withColumn("parent_category_key", F.xxhash64("parent_category"))
    rows = rows.withColumn("parent_category_key", F.when(F.col("parent_category").isNotNull(), F.col("parent_category_key")))
    rule = F.expr(ROW_RULES["fact_workforce_summary"]["parent_only_for_total"])
    return quality.violations_check(rows, rule, ["conv_id", "row_idx"], "parent_only_for_total")


# Which operator-inventory lines each query exercises.
COVERS: dict[str, tuple[str, ...]] = {
    "grid_slice": ("B4",), "grid_to_records": ("B2", "H2"),
    "missing_data_rows": ("K4",), "dense_records": ("B1", "B2", "H2"), "hierarchy_tag": ("B3", "G1"), "section_tables": ("B3", "C8", "G1"),
    "row_extent": ("B14",), "anchor_check": ("B13", "C7", "I25", "K2", "K3"),
    "wide_to_long": ("B10", "H1"), "hierarchy_rollup": ("B11", "D19"), "hierarchy_levels": ("B11", "C2"),
    "hierarchy_leaf_sums": ("B9", "D7", "D19"), "leaf_vs_naive_sum": ("B9", "D7", "D18"),
    "share_of_total": ("C9", "I3"), "rollup_reconcile": ("D8", "K11"), "ratio_null_on_zero": ("I1", "I2"),
    "era_date_parse": ("I9",), "fiscal_calendar": ("I10", "I11", "I12", "I13"),
    "conformed_dates": ("G2", "I14"), "strict_cast": ("I7",), "bool_parse": ("I8",),
    "whitespace_profile": ("D15", "I4"), "listing_links": ("I19",), "page_has_file_link": ("B12",),
    "resolve_relative_url": ("I18",), "resolve_references": ("I18",), "download_args": ("I17",), "prefix_count": ("B5", "I23"),
    "latest_per_key": ("D1", "D2"), "dim_last_wins": ("D4",), "first_wins": ("D5",),
    "distinct_levels": ("D17", "G3"), "first_last_row": ("F4",), "high_water_mark": ("D3", "J1", "J2"),
    "content_hash_dedup": ("I20", "J3"), "hash_already_known": ("C5",), "surrogate_keys": ("E1",),
    "customer_keys": ("E1",), "resolve_fact_keys": ("C1", "C4"), "insert_if_absent": ("C3", "J5", "J6"),
    "parent_key_lookup": ("C2", "I5"), "star_join_leaf_sum": ("C6",),
    "manifest_entries": ("A9", "C11", "I16", "I21"), "landed_files": ("J2", "J3", "J4", "J7"), "table_row_counts": ("A12", "D6"),
    "key_profile": ("D9",), "measure_profile": ("D10", "D11"), "density_classify": ("D13", "D14"),
    "density_summary": ("D14",), "negative_positions": ("D11",), "dirty_text_nodes": ("D15", "I4"),
    "not_null_violations": ("K6",), "unique_violations": ("K5",), "functional_dependency": ("D16",), "all_dependencies": ("D16", "D17"),
    "fk_violations": ("C10", "K7"), "check_violations": ("K10",), "pattern_violations": ("K12",),
    "ingest_status_by_part": ("J7",), "order_reconcile": ("D8", "K11"), "labels_not_null": ("K6",), "label_key_profile": ("D9",),
    "sheet_cell_counts": ("D12",), "era_date_filter": ("B7", "I9"), "attached_reports": ("B8", "I21"), "known_report_dates": ("D3", "I15"),
    "strict_numbers": ("I6",), "bool_forms": ("I8",), "text_preview": ("I22",), "sampled_density": ("D13", "F3"), "order_by_hash": ("F2", "I20"),
    "era_rule_violations": ("K8",), "parent_rule_violations": ("K9",),
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


# ---------------------------------------------------------------- DuckDB oracles

_WS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

_TREE_SQL = """
WITH RECURSIVE ranked AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal,
    row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS n FROM customer),
tree AS (SELECT a.c_custkey AS node, b.c_custkey AS parent, a.c_acctbal::DECIMAL(18,2) AS balance FROM ranked a LEFT JOIN ranked b
    ON b.c_nationkey = a.c_nationkey AND b.n = CASE WHEN a.n > 1 THEN a.n // 2 WHEN a.c_mktsegment = 'MACHINERY' THEN 3 END),
walk AS (SELECT node, parent, 0 AS level, node AS root, ''::VARCHAR AS path FROM tree WHERE parent IS NULL
  UNION ALL SELECT t.node, t.parent, w.level + 1, w.root, t.parent || CASE WHEN w.path = '' THEN '' ELSE '<' || w.path END
    FROM tree t JOIN walk w ON t.parent = w.node)"""

def _dependency_sql(table: str, columns: Sequence[str], max_left: int = 4) -> str:
    """Every set of columns counted, every dependency tried, the minimal ones kept."""
    sets = [c for k in range(1, max_left + 2) for c in combinations(sorted(columns), k)]
    counts = " UNION ALL ".join(f"SELECT '{','.join(s)}' AS s, count(*) AS n FROM (SELECT DISTINCT {', '.join(s)} FROM {table})" for s in sets)
    tries = ", ".join(f"('{','.join(x for x in s if x != a)}', '{a}', '{','.join(s)}')" for s in sets for a in s)
    return f"""
SELECT '{table}' AS table_name, h.l AS "left", h.r AS "right" FROM (
  WITH sizes AS ({counts} UNION ALL SELECT '', count(*) FROM (SELECT 1 FROM {table} LIMIT 1)),
  tries(l, r, s) AS (VALUES {tries}),
  holds AS (SELECT t.l, t.r FROM tries t JOIN sizes a ON a.s = t.l JOIN sizes b ON b.s = t.s WHERE a.n = b.n)
  SELECT l, r FROM holds x WHERE NOT EXISTS (SELECT 1 FROM holds y WHERE y.r = x.r AND y.l <> x.l
    AND (y.l = '' OR list_has_all(string_split(x.l, ','), string_split(y.l, ','))))) h"""


ORACLE_SQL: dict[str, str] = {
    "all_dependencies": " UNION ALL ".join((
        _dependency_sql("part", ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")),
        _dependency_sql("customer", ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))),
    "grid_slice": """
SELECT c.conv_id, c.turn AS row_idx, c.role FROM conversations c
JOIN (SELECT conv_id, MAX(turn) AS last_row FROM conversations GROUP BY conv_id) b ON b.conv_id = c.conv_id
WHERE c.turn BETWEEN 1 AND b.last_row - 1""",
    "grid_to_records": """
WITH cells AS (SELECT conv_id, turn AS row_idx, 0 AS col_idx, role AS value FROM conversations WHERE role IS NOT NULL
  UNION ALL SELECT conv_id, turn, 1, text FROM conversations WHERE text IS NOT NULL),
layout(col_idx, field) AS (VALUES (0, 'speaker'), (1, 'utterance'))
SELECT c.conv_id, c.row_idx, MAX(CASE WHEN l.field = 'speaker' THEN c.value END) AS speaker,
  MAX(CASE WHEN l.field = 'utterance' THEN c.value END) AS utterance
FROM cells c JOIN layout l ON c.col_idx = l.col_idx GROUP BY c.conv_id, c.row_idx""",
    "missing_data_rows": """
WITH held AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE length(text) >= 100)
SELECT c.conv_id, r.range AS row_idx FROM (SELECT DISTINCT conv_id FROM conversations) c, range(8) r
WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.conv_id = c.conv_id AND h.turn = r.range)""",
    "dense_records": """
WITH held AS (SELECT conv_id, turn, MAX(text) AS text FROM conversations WHERE length(text) >= 100 GROUP BY ALL)
SELECT c.conv_id, r.range AS row_idx, h.text AS utterance FROM (SELECT DISTINCT conv_id FROM held) c CROSS JOIN range(8) r
LEFT JOIN held h ON h.conv_id = c.conv_id AND h.turn = r.range""",
    "hierarchy_tag": """
WITH rng(hierarchy_level, row_start, row_end, parent_row) AS
  (VALUES (0, 0, 0, NULL), (1, 1, 1, 0), (2, 2, 3, 1), (1, 4, 4, 0), (2, 5, 7, 4))
SELECT c.conv_id, c.turn AS row_idx, r.hierarchy_level, c.role AS category_name, p.role AS parent_category,
  r.hierarchy_level = 2 AS is_leaf
FROM conversations c JOIN rng r ON c.turn BETWEEN r.row_start AND r.row_end
LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = r.parent_row""",
    "section_tables": """
WITH asked AS (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations WHERE role = 'user'),
rng AS (SELECT conv_id, 1 AS hierarchy_level, turn AS a, turn AS b, NULL::BIGINT AS parent_row FROM asked
  UNION ALL SELECT conv_id, 2, turn + 1, coalesce(nxt - 1, 1::BIGINT << 40), turn FROM asked)
SELECT c.conv_id, c.turn AS row_idx, c.role AS category_name, r.hierarchy_level, p.role AS parent_category, r.hierarchy_level = 2 AS is_leaf
FROM conversations c JOIN rng r ON r.conv_id = c.conv_id AND c.turn BETWEEN r.a AND r.b
LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = r.parent_row""",
    "row_extent": """
SELECT event_id, MAX(col_idx) AS last_col FROM (SELECT event_id, 0 AS col_idx FROM events
  UNION ALL SELECT event_id, 1 FROM events WHERE value > 50 UNION ALL SELECT event_id, 2 FROM events WHERE value > 100) c
GROUP BY event_id""",
    "anchor_check": """
WITH cells AS (SELECT conv_id, turn AS row_idx, 0 AS col_idx, role AS value FROM conversations WHERE role IS NOT NULL),
ext AS (SELECT conv_id, MAX(row_idx) AS last_row FROM cells GROUP BY conv_id),
w AS (SELECT conv_id, last_row, UNNEST([{'anchor_row': 0, 'anchor_col': 0, 'expected': 'user'},
  {'anchor_row': 1, 'anchor_col': 0, 'expected': 'assistant'}, {'anchor_row': 2, 'anchor_col': 0, 'expected': 'user'}],
  recursive := true) FROM ext)
SELECT w.conv_id, w.anchor_row, w.anchor_col, w.expected, c.value AS actual,
  CASE WHEN w.last_row < w.anchor_row THEN 'missing_row' ELSE 'mismatch' END AS reason
FROM w LEFT JOIN cells c ON c.conv_id = w.conv_id AND c.row_idx = w.anchor_row AND c.col_idx = w.anchor_col
WHERE c.value IS DISTINCT FROM w.expected""",
    "wide_to_long": """
WITH w AS (SELECT o_custkey,
  CAST(COALESCE(SUM(CASE WHEN o_orderstatus='F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END),0) AS DECIMAL(28,2)) AS f_amt,
  CAST(COALESCE(SUM(CASE WHEN o_orderstatus='O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END),0) AS DECIMAL(28,2)) AS o_amt,
  CAST(COALESCE(SUM(CASE WHEN o_orderstatus='P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END),0) AS DECIMAL(28,2)) AS p_amt,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS t_amt
  FROM orders GROUP BY o_custkey)
SELECT o_custkey, 'F' AS grp, true AS is_leaf, f_amt AS amount FROM w
UNION ALL SELECT o_custkey, 'O', true, o_amt FROM w
UNION ALL SELECT o_custkey, 'P', true, p_amt FROM w
UNION ALL SELECT o_custkey, 'total', false, t_amt FROM w""",
    "hierarchy_rollup": """
WITH leaf AS (SELECT r_name, n_name, COUNT(*) AS headcount FROM customer JOIN nation ON c_nationkey=n_nationkey
  JOIN region ON n_regionkey=r_regionkey GROUP BY r_name, n_name),
g AS (SELECT r_name, n_name, CAST(SUM(headcount) AS BIGINT) AS headcount, GROUPING(r_name) AS gr, GROUPING(n_name) AS gn
  FROM leaf GROUP BY GROUPING SETS ((r_name, n_name), (r_name), ()))
SELECT CASE WHEN gr=1 THEN 'ALL' WHEN gn=1 THEN r_name ELSE n_name END AS category_name,
  CASE WHEN gr=1 THEN 0 WHEN gn=1 THEN 1 ELSE 2 END AS hierarchy_level,
  CASE WHEN gr=1 THEN NULL WHEN gn=1 THEN 'ALL' ELSE r_name END AS parent_category,
  (gn=0) AS is_leaf, headcount,
  ROUND(CAST(headcount AS DOUBLE) / MAX(CASE WHEN gr=1 THEN headcount END) OVER () * 100, 6) AS share_pct FROM g""",
    "leaf_vs_naive_sum": """
WITH leaf AS (SELECT r_name, n_name, COUNT(*) AS headcount FROM customer JOIN nation ON c_nationkey=n_nationkey
  JOIN region ON n_regionkey=r_regionkey GROUP BY r_name, n_name),
g AS (SELECT r_name, n_name, CAST(SUM(headcount) AS BIGINT) AS headcount, GROUPING(n_name) AS gn
  FROM leaf GROUP BY GROUPING SETS ((r_name, n_name), (r_name), ()))
SELECT CAST(SUM(headcount) AS BIGINT) AS naive_sum, CAST(SUM(CASE WHEN gn=0 THEN headcount END) AS BIGINT) AS leaf_sum,
  COUNT(CASE WHEN gn=0 THEN 1 END) AS n_leaves FROM g""",
    "share_of_total": """
WITH a AS (SELECT n_name, COUNT(*) AS headcount FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY n_name),
g AS (SELECT CAST(SUM(headcount) AS BIGINT) AS total FROM a)
SELECT n_name, headcount, CASE WHEN (SELECT total FROM g) = 0 THEN NULL
  ELSE ROUND(CAST(headcount AS DOUBLE) / (SELECT total FROM g) * 100, 6) END AS share_pct FROM a""",
    "rollup_reconcile": """
WITH leaf AS (SELECT n_regionkey, c_nationkey, COUNT(*) AS v FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1,2),
sub AS (SELECT n_regionkey, COUNT(*) AS v FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1)
SELECT sub.n_regionkey, sub.v AS stated, CAST(SUM(leaf.v) AS BIGINT) AS children, sub.v = SUM(leaf.v) AS matches
FROM sub JOIN leaf USING (n_regionkey) GROUP BY 1, 2""",
    "ratio_null_on_zero": """
WITH a AS (SELECT l_orderkey, SUM(CASE WHEN l_returnflag='R' THEN l_quantity ELSE 0 END) AS base,
  SUM(CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN l_quantity ELSE 0 END) AS part FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, base, part, base - part AS remaining,
  CASE WHEN base = 0 THEN NULL ELSE ROUND(part / base * 100, 6) END AS part_pct FROM a""",
    "era_date_parse": """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/') || CAST(year(o_orderdate) + 543 AS VARCHAR) AS be_text,
  CAST(o_orderdate AS DATE) AS report_date FROM orders""",
    "fiscal_calendar": """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders)
SELECT report_date, CAST(year(report_date) + (CASE WHEN month(report_date) >= 10 THEN 1 ELSE 0 END) AS INTEGER) AS fiscal_year_ce,
  CAST(year(report_date) + (CASE WHEN month(report_date) >= 10 THEN 1 ELSE 0 END) + 543 AS INTEGER) AS fiscal_year_be,
  CAST(month(report_date) AS INTEGER) AS month,
  CAST(((month(report_date) + 2) % 12) // 3 + 1 AS INTEGER) AS quarter,
  report_date = last_day(report_date) AS is_month_end FROM d""",
    "conformed_dates": """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS report_date FROM orders),
f AS (SELECT report_date, CAST(year(report_date) + (CASE WHEN month(report_date) >= 10 THEN 1 ELSE 0 END) AS INTEGER) AS ce,
  CAST(month(report_date) AS INTEGER) AS m FROM d)
SELECT strftime(report_date, '%Y-%m-%d') AS date_natural_key, report_date, ce + 543 AS fiscal_year_be, ce AS fiscal_year_ce,
  m AS month, CAST(((m + 2) % 12) // 3 + 1 AS INTEGER) AS quarter, report_date = last_day(report_date) AS is_month_end FROM f
UNION ALL SELECT DISTINCT 'FY' || CAST(ce + 543 AS VARCHAR), CAST(NULL AS DATE), ce + 543, ce, CAST(NULL AS INTEGER),
  CAST(NULL AS INTEGER), CAST(NULL AS BOOLEAN) FROM f""",
    "strict_cast": """
SELECT event_id, CAST(NULLIF(TRIM(regexp_extract(props, '([0-9]+)', 1)), '') AS DOUBLE) AS k FROM events""",
    "bool_parse": """
SELECT event_id, COALESCE(LOWER(TRIM(CAST(value > 50 AS VARCHAR))) = 'true', false) AS flag FROM events""",
    "whitespace_profile": f"""
SELECT lang, COUNT(*) FILTER (WHERE regexp_matches(t, '^{_WS}+|{_WS}+$')) AS dirty, COUNT(*) AS n
FROM (SELECT regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
  UNNEST(regexp_extract_all(html, '>([^<]*)<', 1)) AS t FROM pages) x GROUP BY lang""",
    "listing_links": """
SELECT page_id, UNNEST(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages""",
    "page_has_file_link": r"""
SELECT page_id, regexp_matches(lower(html), '<a href="[^"]*\.(xlsx|xls|pdf|zip|doc|docx)') AS has_file_link FROM pages""",
    "resolve_relative_url": """
SELECT page_id, href, CASE WHEN regexp_matches(href, '^https?://') THEN href
  WHEN href LIKE '//%' THEN regexp_extract(url, '^(https?:)', 1) || href
  ELSE regexp_extract(url, '^(https?://[^/]+)', 1) || CASE WHEN href LIKE '/%' THEN href ELSE '/' || href END END AS abs_url
FROM (SELECT page_id, url, UNNEST(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages) x""",
    "resolve_references": r"""
WITH h AS (SELECT page_id, url, UNNEST(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
r AS (SELECT DISTINCT page_id, url, UNNEST(['../' || x, './x/../../y/' || x, '/a/b/.././' || x || '/..', '?from=' || page_id, '#top',
    '//cdn.example.org/' || x, 'mailto:a@b.org']) AS ref FROM (SELECT page_id, url, regexp_replace(href, '^/+', '') AS x FROM h)),
u AS (SELECT *, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS site, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM r),
f AS (SELECT *, regexp_extract(ref, '^[^?#]*') AS own, regexp_extract(ref, '[?#].*$') AS extra,
    CASE WHEN starts_with(ref, '/') THEN '' ELSE regexp_replace(path, '[^/]*$', '') END AS folder FROM u),
g AS (SELECT *, [[s] FOR s IN string_split(CASE WHEN starts_with(ref, '/') THEN substr(own, 2) ELSE substr(folder, 2) || own END, '/')
    IF s <> '' OR ends_with(own, '/')] AS segs FROM f),
k AS (SELECT *, list_reduce(segs, lambda done, s: CASE WHEN s[1] = '..' THEN done[:-2] WHEN s[1] = '.' THEN done ELSE done || s END, ['']) AS kept FROM g)
SELECT page_id, ref, CASE WHEN starts_with(ref, 'mailto:') THEN ref WHEN starts_with(ref, '//') THEN regexp_extract(url, '^https?:') || ref
  WHEN own = '' THEN site || path || CASE WHEN starts_with(ref, '#') THEN regexp_extract(url, '[?][^#]*') ELSE '' END || extra
  ELSE site || array_to_string(kept, '/') || CASE WHEN segs[-1][1] IN ('..', '.') THEN '/' ELSE '' END || extra END AS abs_url FROM k""",
    "download_args": r"""
SELECT page_id, NULLIF(regexp_extract(html, 'track\(\s*[''"]?([^''",)]*)[''"]?\s*[,)]', 1), '') AS target FROM pages""",
    "prefix_count": """
SELECT COUNT(*) FILTER (WHERE starts_with(p_type, 'PROMO')) AS hits, COUNT(p_type) AS non_empty FROM part""",
    "latest_per_key": """
SELECT user_id, event_id, ts FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id ASC) = 1""",
    "dim_last_wins": """
SELECT o_custkey AS natural_key, o_orderpriority AS attr FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
    "first_wins": """
SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT o_custkey, o_orderkey, o_orderpriority,
  ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) x WHERE rn = 1""",
    "distinct_levels": """
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders""",
    "first_last_row": """
SELECT user_id, MIN_BY(event_type, event_id) AS first_type, MAX_BY(event_type, event_id) AS last_type FROM events GROUP BY user_id""",
    "high_water_mark": """
WITH known AS (SELECT event_type, MAX(ts) AS hwm FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY event_type)
SELECT e.event_id, e.event_type FROM events e LEFT JOIN known k ON e.event_type = k.event_type
WHERE k.hwm IS NULL OR e.ts > k.hwm""",
    "content_hash_dedup": """
SELECT MIN(doc_id) AS doc_id, sha256(text) AS content_sha256, COUNT(*) AS copies FROM documents GROUP BY sha256(text)""",
    "hash_already_known": """
WITH known AS (SELECT DISTINCT sha256(d.text) AS h FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))
SELECT d.doc_id, sha256(d.text) IN (SELECT h FROM known) AS is_duplicate FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "surrogate_keys": """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY natural_key) AS BIGINT) AS sk, natural_key
FROM (SELECT DISTINCT o_orderpriority AS natural_key FROM orders) x""",
    "customer_keys": """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY natural_key) AS BIGINT) AS sk, natural_key
FROM (SELECT DISTINCT c_name AS natural_key FROM customer) x""",
    "resolve_fact_keys": """
WITH d AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY k) AS BIGINT) AS status_key, k FROM (SELECT DISTINCT o_orderstatus AS k FROM orders) x)
SELECT o.o_orderkey, d.status_key FROM orders o JOIN d ON o.o_orderstatus = d.k""",
    "insert_if_absent": """
WITH existing AS (SELECT user_id, event_type, MIN(event_id) AS event_id FROM events
  WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY user_id, event_type),
incoming AS (SELECT user_id, event_type, MIN(event_id) AS event_id FROM events GROUP BY user_id, event_type)
SELECT * FROM existing UNION ALL SELECT i.* FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.user_id = i.user_id AND e.event_type = i.event_type)""",
    "parent_key_lookup": """
WITH cat AS (SELECT 'ALL' AS category_name, 0 AS hierarchy_level, CAST(NULL AS VARCHAR) AS parent_category
  UNION ALL SELECT category_name, 1, 'ALL' FROM (SELECT DISTINCT c_mktsegment AS category_name FROM customer) s
  UNION ALL SELECT c_name, 2, c_mktsegment FROM customer),
dim AS (SELECT category_name, CAST(ROW_NUMBER() OVER (ORDER BY category_name) AS BIGINT) AS k
  FROM (SELECT DISTINCT category_name FROM cat) x)
SELECT c.k AS category_key, p.k AS parent_category_key, cat.hierarchy_level
FROM cat JOIN dim c ON c.category_name = cat.category_name LEFT JOIN dim p ON p.category_name = cat.parent_category""",
    "hierarchy_levels": _TREE_SQL + """
SELECT t.node, t.parent, w.level, w.root, w.path, CASE WHEN w.node IS NULL THEN 'cycle' END AS problem FROM tree t LEFT JOIN walk w USING (node)""",
    "hierarchy_leaf_sums": _TREE_SQL + """,
leaf AS (SELECT w.node, t.balance FROM walk w JOIN tree t USING (node) WHERE w.node NOT IN (SELECT parent FROM tree WHERE parent IS NOT NULL)),
up AS (SELECT node AS leaf, node FROM leaf UNION ALL SELECT u.leaf, t.parent FROM up u JOIN tree t ON t.node = u.node WHERE t.parent IS NOT NULL)
SELECT w.node, w.level, w.node IN (SELECT node FROM leaf) AS is_leaf, count(*) AS n_leaves, sum(l.balance)::DECIMAL(28,2) AS total
FROM walk w JOIN up u ON u.node = w.node JOIN leaf l ON l.node = u.leaf GROUP BY w.node, w.level""",
    "star_join_leaf_sum": """
WITH f AS (SELECT o_custkey, o_orderstatus AS grp, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
  FROM orders GROUP BY o_custkey, o_orderstatus
  UNION ALL SELECT o_custkey, 'total', CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) FROM orders
  GROUP BY o_custkey),
d(grp, is_leaf) AS (VALUES ('F', true), ('O', true), ('P', true), ('total', false))
SELECT c.c_nationkey, CAST(SUM(f.amount) AS DECIMAL(38,2)) AS leaf_amount FROM f JOIN d ON f.grp = d.grp
JOIN customer c ON c.c_custkey = f.o_custkey WHERE d.is_leaf GROUP BY c.c_nationkey""",
    "manifest_entries": """
WITH t AS (SELECT o_orderstatus, o_orderpriority, o_orderkey,
  ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate::DATE DESC, o_orderkey) AS rn FROM orders)
SELECT o.o_orderstatus AS source, t.o_orderpriority AS source_name_th, 'https://example.org/' || t.o_orderkey AS source_url,
  'raw/' || lower(o.o_orderstatus) || '/' || strftime(o.o_orderdate, '%Y_%m_%d') || '.xlsx' AS local_path,
  strftime(o.o_orderdate, '%Y-%m-%d') AS report_date, sha256(round(o.o_totalprice / 100)::BIGINT::VARCHAR) AS sha256,
  'auto' AS downloaded_by, strftime(o.o_orderdate, '%Y_%m_%d') || '.xlsx' AS file_name
FROM orders o JOIN t ON t.o_orderstatus = o.o_orderstatus AND t.rn = 1""",
    "landed_files": """
WITH f AS (SELECT o_orderpriority AS source, o_orderpriority || '/' || o_orderkey AS path, sha256(round(o_totalprice / 100)::BIGINT::VARCHAR) AS sha256,
    CASE WHEN o_orderpriority IS NOT NULL THEN o_orderdate::DATE END AS report_date,
    CASE WHEN o_orderstatus = 'P' THEN 'unreadable' END AS error, o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2001-01-01' AND o_orderpriority <> '5-LOW' AS known FROM orders),
k AS (SELECT o_orderpriority AS source, max(o_orderdate::DATE) AS hwm FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2001-01-01' AND o_orderpriority <> '5-LOW' GROUP BY 1),
j AS (SELECT f.*, k.hwm, k.source IS NOT NULL AS has, f.sha256 IN (SELECT sha256 FROM f WHERE known) AS held FROM f LEFT JOIN k USING (source)),
rivals AS (SELECT * FROM j WHERE error IS NULL AND report_date IS NOT NULL AND has AND NOT held AND report_date > hwm),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY report_date, source, path) AS copy_no FROM rivals),
firsts AS (SELECT sha256, row_number() OVER (PARTITION BY source, report_date ORDER BY path) > 1 AS refused FROM ranked WHERE copy_no = 1),
s AS (SELECT j.*, r.copy_no, x.refused FROM j LEFT JOIN ranked r USING (source, path) LEFT JOIN firsts x ON x.sha256 = r.sha256),
o AS (SELECT *, CASE WHEN error IS NOT NULL THEN error WHEN report_date IS NULL THEN 'no report date in file name'
    WHEN NOT has THEN 'no manifest entry to inherit' WHEN held OR (copy_no > 1 AND NOT refused) THEN 'content already ingested'
    WHEN refused AND copy_no > 1 THEN 'copy of a file refused for its report date' WHEN refused THEN 'another landed file has this report date'
    WHEN report_date <= hwm THEN 'not newer than the known report' END AS reason FROM s)
SELECT source, path, sha256, report_date, error, reason, CASE reason WHEN 'content already ingested' THEN 'duplicate'
    WHEN 'not newer than the known report' THEN 'nothing_new' ELSE CASE WHEN reason IS NULL THEN 'new' ELSE 'failed' END END AS status FROM o""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}" for t in TABLES),
    "key_profile": """
SELECT COUNT(*) AS n, COUNT(*) - COUNT(o_custkey) AS null_keys, COUNT(o_custkey) - COUNT(DISTINCT o_custkey) AS dup_keys FROM orders""",
    "measure_profile": """
SELECT 'l_discount' AS col, COUNT(*) FILTER (WHERE l_discount = 0) AS zeros, COUNT(*) FILTER (WHERE l_discount < 0) AS negatives,
  COUNT(*) AS n FROM lineitem
UNION ALL SELECT 'l_tax', COUNT(*) FILTER (WHERE l_tax = 0), COUNT(*) FILTER (WHERE l_tax < 0), COUNT(*) FROM lineitem""",
    "density_classify": f"""
WITH r AS (SELECT source, doc_id, text, ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
s AS (SELECT source, doc_id, text, length(regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g')) > 0 AS has_data FROM r)
SELECT source, COUNT(*) FILTER (WHERE has_data) AS rows_with_data, COUNT(*) FILTER (WHERE has_data) <= 2 AS sparse,
  arg_min(text, doc_id) FILTER (WHERE has_data) AS first_cell_text FROM s GROUP BY source""",
    "density_summary": f"""
WITH r AS (SELECT source, doc_id, text, ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
c AS (SELECT source, COUNT(*) FILTER (WHERE length(regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g')) > 0) <= 2 AS sparse
  FROM r GROUP BY source)
SELECT COUNT(*) FILTER (WHERE NOT sparse) AS usable, COUNT(*) FILTER (WHERE sparse) AS sparse FROM c""",
    "negative_positions": """
SELECT c_custkey AS row_key, 'c_acctbal' AS col, c_acctbal AS value FROM customer WHERE c_acctbal < 0
UNION ALL SELECT s_suppkey, 's_acctbal', s_acctbal FROM supplier WHERE s_acctbal < 0""",
    "dirty_text_nodes": f"""
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, node, regexp_replace(node, '^{_WS}+|{_WS}+$', '', 'g') AS stripped
FROM (SELECT page_id, UNNEST(nodes) AS node, generate_subscripts(nodes, 1) AS pos
      FROM (SELECT page_id, regexp_extract_all(html, '>([^<]*)<', 1) AS nodes FROM pages) a) b
WHERE regexp_matches(node, '^{_WS}+|{_WS}+$')""",
    "not_null_violations": """
SELECT 'orders' AS table_name, o_orderkey AS row_key, CASE WHEN o_custkey IS NULL THEN 'o_custkey'
  WHEN o_orderstatus IS NULL THEN 'o_orderstatus' WHEN o_totalprice IS NULL THEN 'o_totalprice'
  ELSE 'o_orderdate' END AS null_column FROM orders
WHERE o_custkey IS NULL OR o_orderstatus IS NULL OR o_totalprice IS NULL OR o_orderdate IS NULL
UNION ALL SELECT 'lineitem', l_orderkey, CASE WHEN l_orderkey IS NULL THEN 'l_orderkey' WHEN l_partkey IS NULL THEN 'l_partkey'
  WHEN l_suppkey IS NULL THEN 'l_suppkey' WHEN l_quantity IS NULL THEN 'l_quantity' ELSE 'l_extendedprice' END FROM lineitem
WHERE l_orderkey IS NULL OR l_partkey IS NULL OR l_suppkey IS NULL OR l_quantity IS NULL OR l_extendedprice IS NULL""",
    "unique_violations": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "functional_dependency": """
SELECT c_nationkey, COUNT(DISTINCT c_mktsegment) AS n_values, COUNT(DISTINCT c_mktsegment) = 1 AS holds FROM customer GROUP BY 1""",
    "order_reconcile": """
WITH s AS (SELECT o_orderkey, round(o_totalprice)::DECIMAL(18,0) AS stated FROM orders),
k AS (SELECT l_orderkey AS o_orderkey, sum(round(l_extendedprice)::DECIMAL(18,0))::DECIMAL(28,0) AS children FROM lineitem GROUP BY 1)
SELECT o_orderkey, stated, children, coalesce(abs(stated - children) <= 5000, false) AS matches FROM s FULL JOIN k USING (o_orderkey)""",
    "labels_not_null": """
SELECT d.doc_id, CASE WHEN d.source IS NULL THEN 'source' WHEN l.quality IS NULL THEN 'quality' ELSE 'toxic' END AS null_column
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.source IS NULL OR l.quality IS NULL OR l.toxic IS NULL""",
    "label_key_profile": """
WITH j AS (SELECT l.quality FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT (SELECT count(*) FROM j) AS n, (SELECT count(*) FROM j WHERE quality IS NULL) AS null_keys,
  (SELECT count(*) FROM j) - (SELECT count(*) FROM (SELECT DISTINCT quality FROM j)) AS dup_keys""",
    "sheet_cell_counts": """
SELECT conv_id::VARCHAR AS path, role AS sheet, count(*) FILTER (WHERE length(text) >= 100) AS non_empty,
  count(*) FILTER (WHERE length(text) >= 500) AS formulas FROM conversations GROUP BY 1, 2""",
    "era_date_filter": """
SELECT o_orderkey, (day(o_orderdate) + 3) || strftime(o_orderdate, '/%m/') || (year(o_orderdate) + 543) AS be_text,
  CAST(o_orderdate AS DATE) + 3 AS report_date FROM orders WHERE month(CAST(o_orderdate AS DATE) + 3) = month(o_orderdate)""",
    "attached_reports": """
SELECT 'landing/' || f.o_orderstatus || '/' || f.o_orderkey AS path, o.o_orderstatus AS source, strftime(o.o_orderdate, '%Y-%m-%d') AS report_date,
  sha256(round(o.o_totalprice / 100)::BIGINT::VARCHAR) AS sha256 FROM orders f JOIN orders o ON o.o_orderkey = f.o_orderkey WHERE o.o_orderstatus = 'F'""",
    "known_report_dates": """
SELECT o_orderpriority AS source, max(o_orderdate::DATE) AS hwm FROM orders GROUP BY 1""",
    "strict_numbers": """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_partkey AS VARCHAR) AS BIGINT) AS part, CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS quantity FROM lineitem""",
    "bool_forms": """
SELECT event_id, coalesce(value > 50, false) AS flag FROM events""",
    "text_preview": """
SELECT doc_id, text[1:100] AS preview FROM documents""",
    "sampled_density": """
WITH s AS (SELECT conv_id, turn, CASE WHEN length(text) >= 100 AND regexp_matches(text, '[^\\s]') THEN text END AS t FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 3)
SELECT conv_id, count(t) AS rows_with_data, count(t) <= 2 AS sparse, substring(arg_min(t, turn) FILTER (WHERE t IS NOT NULL), 1, 20) AS first_cell_text
FROM s GROUP BY 1""",
    "order_by_hash": """
SELECT source, doc_id, sha256(text) AS sha256 FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY sha256(text) NULLS FIRST, doc_id) <= 3""",
    "era_rule_violations": """
SELECT DISTINCT o_orderdate::DATE AS report_date, 'check_era' AS check_name FROM orders WHERE month(o_orderdate) >= 10""",
    "parent_rule_violations": """
SELECT conv_id, turn AS row_idx, 'parent_only_for_total' AS check_name FROM conversations WHERE role = 'user'""",
    "fk_violations": """
SELECT 'orders.o_custkey' AS check_name, CAST(o_custkey AS BIGINT) AS child_key FROM orders x
  WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = x.o_custkey)
UNION ALL SELECT 'lineitem.l_orderkey', CAST(l_orderkey AS BIGINT) FROM lineitem x
  WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderkey = x.l_orderkey)
UNION ALL SELECT 'lineitem.l_partkey', CAST(l_partkey AS BIGINT) FROM lineitem x
  WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = x.l_partkey)
UNION ALL SELECT 'lineitem.l_suppkey', CAST(l_suppkey AS BIGINT) FROM lineitem x
  WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier p WHERE p.s_suppkey = x.l_suppkey)
UNION ALL SELECT 'customer.c_nationkey', CAST(c_nationkey AS BIGINT) FROM customer x
  WHERE c_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation p WHERE p.n_nationkey = x.c_nationkey)
UNION ALL SELECT 'supplier.s_nationkey', CAST(s_nationkey AS BIGINT) FROM supplier x
  WHERE s_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation p WHERE p.n_nationkey = x.s_nationkey)
UNION ALL SELECT 'nation.n_regionkey', CAST(n_regionkey AS BIGINT) FROM nation x
  WHERE n_regionkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM region p WHERE p.r_regionkey = x.n_regionkey)
UNION ALL SELECT 'labels.doc_id', CAST(doc_id AS BIGINT) FROM labels x
  WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documents p WHERE p.doc_id = x.doc_id)
UNION ALL SELECT 'documents.doc_id', CAST(doc_id AS BIGINT) FROM documents x
  WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels p WHERE p.doc_id = x.doc_id)""",
    "check_violations": """
SELECT c_custkey AS row_key, 'acctbal_nonneg' AS check_name FROM customer WHERE NOT (c_acctbal >= 0)
UNION ALL SELECT s_suppkey, 'acctbal_nonneg_supplier' FROM supplier WHERE NOT (s_acctbal >= 0)""",
    "pattern_violations": """
SELECT o_orderkey, o_orderpriority FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[0-9]-[A-Z]+$')""",
    "ingest_status_by_part": """
WITH latest AS (SELECT l_partkey AS p_partkey, MAX(l_shipdate) AS latest_ts FROM lineitem GROUP BY 1),
known AS (SELECT l_partkey AS p_partkey, MAX(l_shipdate) AS hwm FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01 00:00:00' GROUP BY 1)
SELECT p.p_partkey, CASE WHEN l.latest_ts IS NULL THEN 'failed' WHEN k.hwm IS NULL OR l.latest_ts > k.hwm THEN 'new'
  ELSE 'nothing_new' END AS status
FROM part p LEFT JOIN latest l ON l.p_partkey = p.p_partkey LEFT JOIN known k ON k.p_partkey = p.p_partkey""",
}


def oracle_sql() -> dict[str, str]:
    return {k: v.strip() for k, v in ORACLE_SQL.items() if k in QUERIES}
