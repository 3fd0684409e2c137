"""Queries over scans, profiles, keys and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import keys, lookup, profile
from ledgerloom.operators.keys import ForeignKey
from ledgerloom.plans.fixtures import BASE
from ledgerloom.plans.registry import register
from ledgerloom.session import work_dir
from ledgerloom.sources import tables as source

# -- scans, ad-hoc queries, samples -----------------------------------------------

register("s1_load_table", "SELECT * FROM orders")(lambda t: source.load_table(t.spark, t.sf_dir, "orders"))

# Ad-hoc statements that Spark and DuckDB read alike: (text, row cap).
AD_HOC = {
    "cte": ("""
        WITH spent AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
                       FROM orders GROUP BY o_custkey)
        SELECT c_custkey, c_name, amount FROM spent JOIN customer ON o_custkey = c_custkey
        ORDER BY amount DESC, c_custkey""", 500),
    "inner_join": ("""
        SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey ORDER BY n_name""", 500),
    "left_join": ("""
        SELECT o_orderkey, l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
        ORDER BY l_orderkey NULLS FIRST, o_orderkey, l_linenumber, l_partkey, l_suppkey""", 500),
    "full_join": ("""
        SELECT c_custkey, s_suppkey FROM customer FULL JOIN supplier ON c_custkey = s_suppkey
        ORDER BY c_custkey DESC NULLS LAST, s_suppkey DESC""", 10000),
    "semi_join": ("""
        SELECT p_partkey, p_name FROM part
        WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 49)
        ORDER BY p_partkey""", 1000),
    "anti_join": ("""
        SELECT o_orderkey, o_orderstatus FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) ORDER BY o_orderkey""", 10000),
    "theta_join": ("""
        SELECT a.n_name AS small, b.n_name AS large FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey
        ORDER BY a.n_nationkey, b.n_nationkey""", 500),
    "subquery": ("""
        SELECT o_orderkey, o_custkey FROM orders o
        WHERE CAST(o_totalprice AS DECIMAL(18,2)) >
              (SELECT max(CAST(c_acctbal AS DECIMAL(18,2))) * 45 FROM customer c WHERE c.c_custkey = o.o_custkey)
        ORDER BY o_orderkey""", 10000),
    "window": ("""
        SELECT o_custkey, o_orderkey, row_number() OVER w AS place,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS recent
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
        ORDER BY o_custkey, place""", 10000),
    "grouping_sets": ("""
        SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(grouping(l_linestatus) AS INT) AS whole
        FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())
        ORDER BY l_returnflag NULLS FIRST, l_linestatus NULLS FIRST""", 500),
    "union": ("""
        SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier ORDER BY 1""", 500),
    "intersect": ("""
        SELECT l_suppkey AS id FROM lineitem INTERSECT SELECT p_partkey FROM part ORDER BY 1""", 500),
    "except": ("""
        SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem ORDER BY 1""", 10000),
    "top_k": ("""
        SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_partkey LIMIT 20""", 500),
    "row_cap": ("""
        SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey""", 7),
    "cap_on_union": ("""
        SELECT 'customer' AS kind, c_custkey AS id FROM customer
        UNION ALL SELECT 'supplier', s_suppkey FROM supplier ORDER BY kind DESC, id""", 130),
    "cap_on_cte": ("""
        WITH big AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders))
        SELECT o_orderkey FROM big
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') ORDER BY o_orderkey""", 25),
}


def _ad_hoc(text: str, cap: int):
    def build(t):
        t.register(text)
        return source.query(t.spark, text, cap)

    return build


for _name, (_text, _cap) in AD_HOC.items():
    register(f"s2_query_{_name}", f"SELECT * FROM ({_text}) LIMIT {_cap}")(_ad_hoc(_text, _cap))

register("s3_sample_rows", "SELECT * FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 10")(
    lambda t: source.sample_rows(t["orders"], ["o_orderkey"], 10, "o_orderstatus = 'F'")
)
register("s3_sample_cap", "SELECT * FROM lineitem ORDER BY ALL LIMIT 1000")(
    lambda t: source.sample_rows(t["lineitem"], t["lineitem"].columns, 1000)
)
register("f1_profilable", "SELECT * FROM part")(
    lambda t: profile.profilable(t["part"].selectExpr("*", "CAST(p_name AS BINARY) AS p_raw"))
)

# -- profiles ---------------------------------------------------------------------

_COUNTED = list(BASE)
register("p1_row_counts", " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", count(*) AS "rows" FROM {name}""" for name in _COUNTED
))(lambda t: profile.row_counts({name: t[name] for name in _COUNTED}))


def _profile_sql(table: str, columns: dict[str, str], where: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS type, count(*) AS rows_profiled, count(*) - count({c}) AS nulls,
            CAST(count(*) - count({c}) AS DOUBLE) * 100 / nullif(count(*), 0) AS null_pct, count(DISTINCT {c}) AS "distinct",
            false AS is_estimate, CAST(min({c}) AS VARCHAR) AS sample_value FROM {table}"""
        for c, kind in columns.items()
    )


register("p2_profile_orders", _profile_sql("orders", {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}))(lambda t: profile.profile_table(t["orders"], exact=True))
register("p2_profile_journal_lines", _profile_sql("journal_line", {
    "entry_id": "bigint", "account_id": "int", "debit": "decimal(18,4)", "credit": "decimal(18,4)", "site_id": "int",
    "cost_center_id": "int", "business_unit_id": "int",
}))(lambda t: profile.profile_table(t["journal_line"], exact=True))
register("p2_profile_estimated")(lambda t: profile.profile_table(t["lineitem"], exact=False))
register("p3_profile_sampled")(lambda t: profile.profile_sampled(t["lineitem"], seed=7))
_MEASURED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"]


def _within(t, profiled, share: float):
    """Exact figures, and whether the profile's distinct counts are within a share of them and its null shares equal."""
    exact = profile.profile_table(t["lineitem"].select(*_MEASURED)).select(
        "column", F.col("distinct").alias("exact_distinct"), F.col("nulls").alias("exact_nulls"))
    gap = F.abs(F.col("distinct") - F.col("exact_distinct"))
    return profiled.join(exact, "column").select(
        "column", "exact_distinct", "exact_nulls", "is_estimate",
        (gap <= F.greatest(F.lit(1.0), share * F.col("exact_distinct"))).alias("distinct_within"),
        (F.abs(F.col("null_pct") - F.col("exact_nulls") * 100 / F.col("rows_profiled")) <= share * 100).alias("nulls_within"),
    )


_WITHIN_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS exact_distinct, count(*) - count({c}) AS exact_nulls, true AS is_estimate,
        true AS distinct_within, true AS nulls_within FROM lineitem""" for c in _MEASURED
)
register("p2_estimate_within", _WITHIN_SQL)(
    lambda t: _within(t, profile.profile_table(t["lineitem"].select(*_MEASURED), exact=False), 0.15)
)


def _kept(t, columns: list[str]) -> str:
    """Profiles of three parts of the order lines; the last is kept twice."""
    path = work_dir(t.spark, "profiles")
    for part in (0, 1, 2, 2):
        lines = t["lineitem"].filter(F.pmod("l_orderkey", F.lit(3)) == part)
        profile.keep_profile(lines.select(*columns), path, str(part))
    return path


register("p2_kept_profile_within", _WITHIN_SQL)(
    lambda t: _within(t, profile.kept_profile(t.spark, _kept(t, _MEASURED)).withColumn("is_estimate", F.lit(True)), 0.15)
)
register("p3_sample_within", _WITHIN_SQL)(
    # Rows of the smaller tables are all drawn; of larger ones a column with few values shows all of them.
    lambda t: _within(t, profile.profile_sampled(t["lineitem"].select(*_MEASURED), n=1_000_000, seed=7), 0.01)
)


def _column_sql(table: str, c: str, numeric: bool) -> str:
    number = f"CAST({c} AS DOUBLE)"
    return f"""SELECT count(*) AS total, count(*) - count({c}) AS nulls,
        CAST(count(*) - count({c}) AS DOUBLE) * 100 / nullif(count(*), 0) AS null_pct, count(DISTINCT {c}) AS "distinct",
        min({c}) AS min, max({c}) AS max,
        {f'round(avg({number}), 4)' if numeric else 'CAST(NULL AS DOUBLE)'} AS avg,
        {f'round(stddev_samp({number}), 4)' if numeric else 'CAST(NULL AS DOUBLE)'} AS stddev FROM {table}"""


def _rounded(df):
    # Mean and deviation depend on the order of addition in their last digits.
    return df.selectExpr("* EXCEPT (avg, stddev)", "round(avg, 4) AS avg", "round(stddev, 4) AS stddev")


for _table, _column, _numeric in [
    ("lineitem", "l_extendedprice", True), ("journal_line", "business_unit_id", True),
    ("customer", "c_mktsegment", False), ("orders", "o_orderdate", False),
]:
    register(f"p4_profile_{_column}", _column_sql(_table, _column, _numeric))(
        lambda t, table=_table, column=_column: _rounded(profile.profile_column(t[table], column))
    )


def _top_sql(table: str, c: str) -> str:
    return f"""WITH top AS (SELECT {c} AS value, count(*) AS cnt FROM {table} GROUP BY {c}
          ORDER BY cnt DESC, value NULLS FIRST LIMIT 15)
        SELECT value, cnt, CAST(cnt AS DOUBLE) * 100 / (SELECT sum(cnt) FROM top) AS pct_of_top,
               CAST(cnt AS DOUBLE) * 100 / (SELECT count(*) FROM {table}) AS pct_of_rows FROM top"""


for _table, _column in [("lineitem", "l_partkey"), ("journal_line", "business_unit_id")]:
    register(f"p5_top_{_column}", _top_sql(_table, _column))(
        lambda t, table=_table, column=_column: profile.top_values(t[table], column)
    )

for _column in ("l_quantity", "l_shipdate"):
    register(f"p5_kept_top_{_column}", _top_sql("lineitem", _column))(
        lambda t, column=_column: profile.kept_top_values(t["lineitem"], _kept(t, [column]), column)
    )

register("p6_grouped_concat", "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS n_name FROM nation GROUP BY n_regionkey")(
    lambda t: profile.grouped_concat(t["nation"], ["n_regionkey"], "n_name", ["n_name"])
)
register("p6_order_lines", """SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ', ' ORDER BY l_linenumber) AS l_linenumber
    FROM lineitem GROUP BY l_orderkey""")(
    lambda t: profile.grouped_concat(t["lineitem"], ["l_orderkey"], "l_linenumber", ["l_linenumber"])
)
register("p7_segment_counts", """SELECT c_mktsegment, count(*) AS "rows" FROM customer GROUP BY c_mktsegment""")(
    lambda t: profile.segment_counts(t["customer"], "c_mktsegment")
)

# -- keys and relationships ---------------------------------------------------------


def _key_sql(table: str, cols: list[str]) -> str:
    by = ", ".join(cols)
    some = " OR ".join(f"{c} IS NULL" for c in cols)
    return f"""SELECT CAST(sum(n) AS BIGINT) AS "rows", count(*) FILTER (NOT hollow) AS distinct_keys,
        count(*) FILTER (NOT hollow AND n > 1) AS duplicate_keys,
        CAST(coalesce(sum(n - 1) FILTER (NOT hollow), 0) AS BIGINT) AS duplicate_rows,
        CAST(coalesce(sum(n) FILTER (hollow), 0) AS BIGINT) AS null_keys
        FROM (SELECT {by}, count(*) AS n, ({some}) AS hollow FROM {table} GROUP BY {by})"""


for _label, _table, _cols in [
    ("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]), ("orders", "orders", ["o_orderkey"]),
    ("journal_line", "journal_line", ["entry_id", "account_id", "business_unit_id"]),
]:
    register(f"r1_key_check_{_label}", _key_sql(_table, _cols))(
        lambda t, table=_table, cols=_cols: keys.key_check(t[table], cols)
    )


def _fk_sql(child: str, parent: str, pairs) -> str:
    some = " OR ".join(f"{c} IS NULL" for c, _ in pairs)
    match = " AND ".join(f"c.{c} = p.{p}" for c, p in pairs)
    whole = " AND ".join(f"{p} IS NOT NULL" for _, p in pairs)
    parents = ", ".join(p for _, p in pairs)
    return f"""WITH counts AS (SELECT
          (SELECT count(*) FROM {child} WHERE NOT ({some})) AS checked,
          (SELECT count(*) FROM {child} WHERE {some}) AS null_skipped,
          (SELECT count(*) FROM {child} c WHERE NOT ({some}) AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {match})) AS orphans,
          (SELECT count(*) FROM (SELECT DISTINCT {parents} FROM {parent} WHERE {whole}) p
           WHERE NOT EXISTS (SELECT 1 FROM {child} c WHERE {match})) AS unreferenced_parents)
        SELECT checked, null_skipped, orphans, CAST(orphans AS DOUBLE) * 100 / nullif(checked, 0) AS orphan_pct,
               unreferenced_parents FROM counts"""


for _label, _child, _parent, _pairs in [
    ("lines_to_orders", "lineitem", "orders", [("l_orderkey", "o_orderkey")]),
    ("lines_to_units", "journal_line", "business_unit", [("business_unit_id", "business_unit_id")]),
    ("legacy_accounts", "legacy_line", "account_map", [("legacy_account", "legacy_account")]),
    ("reversed_route", "operation", "lineitem", [("routing_id", "l_orderkey"), ("sequence", "l_linenumber")]),
]:
    register(f"r2_fk_check_{_label}", _fk_sql(_child, _parent, _pairs))(
        lambda t, child=_child, parent=_parent, pairs=_pairs: keys.fk_check(t[child], t[parent], pairs)
    )

register("r3_orphans", """SELECT * FROM legacy_line l WHERE legacy_account IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM account_map m WHERE m.legacy_account = l.legacy_account)""")(
    lambda t: keys.orphans(t["legacy_line"], t["account_map"], [("legacy_account", "legacy_account")])
)

_INCLUDED = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "orders": ["o_orderkey"], "part": ["p_partkey"],
    "supplier": ["s_suppkey"],
}


def _inclusion_sql(columns: dict[str, list[str]], coverage: float) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{table}.{c}' AS col, {c} AS value FROM {table} WHERE {c} IS NOT NULL"
        for table, names in columns.items() for c in names
    )
    return f"""WITH cells AS ({cells}), uniq AS (SELECT DISTINCT col, value FROM cells),
        sizes AS (SELECT col, count(*) AS n FROM uniq GROUP BY col),
        filled AS (SELECT col, count(*) AS n FROM cells GROUP BY col),
        matched AS (SELECT c.col AS child_col, p.col AS parent_col, count(*) AS matched
                    FROM uniq c JOIN uniq p ON c.value = p.value AND c.col <> p.col GROUP BY c.col, p.col)
        SELECT child_col, parent_col, s.n AS child_distinct, matched, CAST(matched AS DOUBLE) / s.n AS coverage,
               f.n = ps.n AS parent_unique
        FROM matched JOIN sizes s ON s.col = child_col JOIN sizes ps ON ps.col = parent_col JOIN filled f ON f.col = parent_col
        WHERE CAST(matched AS DOUBLE) / s.n >= {coverage}"""


register("r4_discover_inclusions", _inclusion_sql(_INCLUDED, 0.5))(
    lambda t: keys.discover_inclusions({name: t[name] for name in _INCLUDED}, 0.5, columns=_INCLUDED)
)

# Every column of the driver's tables by kind: n(umber), t(ime), s(tring). Only the SQL needs the list.
_ALL_COLUMNS = {
    "region": "n r_regionkey s r_name", "nation": "n n_nationkey n_regionkey s n_name",
    "customer": "n c_custkey c_nationkey c_acctbal s c_name c_mktsegment",
    "supplier": "n s_suppkey s_nationkey s_acctbal s s_name",
    "part": "n p_partkey p_size p_retailprice s p_name p_brand p_type",
    "orders": "n o_orderkey o_custkey o_totalprice t o_orderdate s o_orderstatus o_orderpriority",
    "lineitem": "n l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax t l_shipdate s l_returnflag l_linestatus",
    "events": "n event_id user_id value t ts s event_type props",
}
_FORMS = {"n": "concat('n', CAST({c} AS DOUBLE))", "t": "concat('t', epoch_us({c}))", "s": "concat('s', {c})"}


def _all_cells() -> str:
    cells = []
    for table, listed in _ALL_COLUMNS.items():
        kind = "n"
        for c in listed.split():
            if c in _FORMS:
                kind = c
            else:
                cells.append(f"SELECT '{table}.{c}' AS col, {_FORMS[kind].format(c=c)} AS value FROM {table} WHERE {c} IS NOT NULL")
    return " UNION ALL ".join(cells)


register("r4_inclusions_of_whole_tables", _inclusion_sql({}, 0.5).replace("WITH cells AS ()", f"WITH cells AS ({_all_cells()})"))(
    lambda t: keys.discover_inclusions({name: t[name] for name in _ALL_COLUMNS}, 0.5)
)

_MIXED_SQL = """WITH cells AS (
      SELECT 'line.l_orderkey' AS col, CAST(l_orderkey AS VARCHAR) AS value FROM lineitem
      UNION ALL SELECT 'ord.o_orderkey', CAST(o_orderkey AS VARCHAR) FROM orders
      UNION ALL SELECT 'ord.o_orderdate', concat('t', epoch_us(o_orderdate)) FROM orders
      UNION ALL SELECT 'day.d', concat('t', epoch_us(d)) FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
      UNION ALL SELECT 'day.n', CAST(CAST(epoch_us(d) / 86400000000 AS BIGINT) AS VARCHAR) FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)),"""
register("r4_inclusions_of_mixed_types", _inclusion_sql({}, 0.01).replace("WITH cells AS (),", _MIXED_SQL))(
    # Integers against decimals and doubles, dates against timestamps.
    lambda t: keys.discover_inclusions({
        "line": t["lineitem"].select(F.col("l_orderkey").cast("int")),
        "ord": t["orders"].select(F.col("o_orderkey").cast("decimal(14,2)"), "o_orderdate"),
        "day": t["orders"].select(F.col("o_orderdate").cast("date").alias("d")).distinct().withColumn("n", F.unix_date("d").cast("double")),
    }, 0.01)
)

_COMPOSITE = {
    "lineitem": ["l_linenumber", "l_partkey", "l_suppkey"], "supply": ["lines", "part_id", "supplier_id"], "part": ["p_partkey", "p_size"],
    "orders": ["o_custkey", "o_orderkey"],
}


def _composite_sql() -> str:
    """All lists of two columns of a table, held against all of the others."""
    cells = " UNION ALL ".join(
        f"SELECT '{table}' AS tab, ['{a}', '{b}'] AS cols, concat({a}, ':', {b}) AS value FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
        for table, names in _COMPOSITE.items() for a in names for b in names if a != b
    )
    return f"""WITH cells AS ({cells}), uniq AS (SELECT DISTINCT tab, cols, value FROM cells),
        sizes AS (SELECT tab, cols, count(*) AS n FROM uniq GROUP BY tab, cols),
        filled AS (SELECT tab, cols, count(*) AS n FROM cells GROUP BY tab, cols),
        matched AS (SELECT c.tab AS child, c.cols AS one, p.tab AS parent, p.cols AS other, count(*) AS n
                    FROM uniq c JOIN uniq p ON c.value = p.value AND c.tab <> p.tab WHERE c.cols[1] < c.cols[2] GROUP BY ALL)
        SELECT child AS child_table, array_to_string(one, ',') AS child_cols, parent AS parent_table, array_to_string(other, ',') AS parent_cols,
               m.n AS child_distinct, f.n = ps.n AS parent_unique
        FROM matched m JOIN sizes s ON s.tab = child AND s.cols = one AND s.n = m.n
        JOIN sizes ps ON ps.tab = parent AND ps.cols = other JOIN filled f ON f.tab = parent AND f.cols = other"""


register("r4_composite_inclusions", _composite_sql())(
    lambda t: keys.discover_composite_inclusions({name: t[name] for name in _COMPOSITE}, columns=_COMPOSITE).selectExpr(
        "child_table", "array_join(child_cols, ',') AS child_cols", "parent_table", "array_join(parent_cols, ',') AS parent_cols",
        "child_distinct", "parent_unique")
)

_KEYS = [
    ForeignKey("line_order", "lineitem", "orders", (("l_orderkey", "o_orderkey"),)),
    ForeignKey("order_customer", "orders", "customer", (("o_custkey", "c_custkey"),)),
    ForeignKey("customer_nation", "customer", "nation", (("c_nationkey", "n_nationkey"),)),
    ForeignKey("nation_region", "nation", "region", (("n_regionkey", "r_regionkey"),)),
]
_ROUTE = ["lineitem", "orders", "customer", "nation", "region"]


def _relationship_sql(fk: ForeignKey, direction: str) -> str:
    (child, parent), = fk.pairs
    seen, other = (fk.referenced, fk.referencing) if direction == "parent" else (fk.referencing, fk.referenced)
    return f"""SELECT '{fk.name}' AS name, '{direction}' AS direction, '{seen}' AS "table", '{other}' AS other,
        (SELECT count({child}) FROM {fk.referencing}) AS checked, (SELECT count(*) - count({child}) FROM {fk.referencing}) AS null_skipped,
        (SELECT count({child}) FROM {fk.referencing} WHERE {child} NOT IN (SELECT {parent} FROM {fk.referenced})) AS orphans,
        count(*) FILTER (n = 0) AS childless_parents, count(*) AS parents, min(n) AS min_children,
        CAST(sum(n) AS DOUBLE) / count(*) AS avg_children, max(n) AS max_children, CAST(0 AS DOUBLE) AS orphan_pct
        FROM (SELECT {parent}, count({child}) AS n FROM {fk.referenced} LEFT JOIN {fk.referencing} ON {child} = {parent} GROUP BY {parent})"""


register("r7_check_relationships", " UNION ALL ".join(_relationship_sql(fk, d) for fk in _KEYS for d in ("parent", "child")))(
    lambda t: keys.check_relationships({name: t[name] for name in _ROUTE}, _KEYS)
)
register("r7_relationships_of_orders", _relationship_sql(_KEYS[0], "parent") + " UNION ALL " + _relationship_sql(_KEYS[1], "child"))(
    lambda t: keys.check_relationships({name: t[name] for name in _ROUTE}, _KEYS, table="orders")
)
register("r5_join_along_path", """SELECT l_orderkey, l_linenumber, l_quantity, o_orderdate, c_name, n_name, r_name FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")(
    lambda t: keys.join_along_path({name: t[name] for name in _ROUTE}, _ROUTE, _KEYS)
    .select("l_orderkey", "l_linenumber", "l_quantity", "o_orderdate", "c_name", "n_name", "r_name")
)
register("r5_join_reversed_left", """SELECT r_name, n_name, c_custkey, o_orderkey FROM region
    LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
    LEFT JOIN orders ON o_custkey = c_custkey""")(
    lambda t: keys.join_along_path({name: t[name] for name in _ROUTE}, _ROUTE[:0:-1], _KEYS, how="left")
    .select("r_name", "n_name", "c_custkey", "o_orderkey")
)

register("r6_bounded_paths", """WITH link AS (
      SELECT src, dst FROM trade_edge UNION SELECT dst, src FROM trade_edge),
    walk (src, dst, depth, path) AS (
      SELECT DISTINCT src, src, 0, [src] FROM link WHERE src LIKE 'segment %'
      UNION ALL
      SELECT w.src, l.dst, w.depth + 1, list_append(w.path, l.dst) FROM walk w JOIN link l ON l.src = w.dst
      WHERE w.depth < 4 AND NOT list_contains(w.path, l.dst)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY depth, path) AS n FROM walk WHERE dst LIKE 'region %')
    SELECT src, dst, depth, array_to_string(path, ' > ') AS path FROM ranked WHERE n <= 10""")(
    lambda t: keys.bounded_paths(
        t["trade_edge"], t["trade_edge"].filter("src LIKE 'segment %'").selectExpr("src AS node"),
        t["trade_edge"].filter("dst LIKE 'region %'").selectExpr("dst AS node"), max_depth=4,
    ).selectExpr("src", "dst", "depth", "array_join(path, ' > ') AS path")
)

register("r6_table_routes", """WITH link AS (SELECT * FROM (VALUES ('lineitem', 'orders'), ('orders', 'customer'), ('customer', 'nation'),
      ('nation', 'region'), ('orders', 'lineitem'), ('customer', 'orders'), ('nation', 'customer'), ('region', 'nation')) AS t(src, dst)),
    walk (dst, depth, path) AS (SELECT 'lineitem', 0, ['lineitem'] UNION ALL
      SELECT l.dst, w.depth + 1, list_append(w.path, l.dst) FROM walk w JOIN link l ON l.src = w.dst
      WHERE w.depth < 4 AND NOT list_contains(w.path, l.dst))
    SELECT array_to_string(path, ' > ') AS path, depth, (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) AS "rows"
    FROM walk WHERE dst = 'region'""")(lambda t: _routes(t))


def _routes(t):
    """Find the route between two tables, then run it."""
    ends = t.spark.createDataFrame([("lineitem", "region")], "start string, end string")
    routes = keys.bounded_paths(
        keys.foreign_key_edges(t.spark, _KEYS), ends.selectExpr("start AS node"), ends.selectExpr("end AS node"), max_depth=4
    )
    joined = keys.join_along_path({name: t[name] for name in _ROUTE}, routes.first().path, _KEYS)
    rows = joined.select(F.count(F.lit(1))).scalar()
    return routes.select(F.array_join("path", " > ").alias("path"), "depth", rows.alias("rows"))


register("r7_relationship_cardinality", """SELECT count(*) AS parents, min(n) AS min_children,
    CAST(sum(n) AS DOUBLE) / count(*) AS avg_children, max(n) AS max_children, count(*) FILTER (n = 0) AS childless_parents
    FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)""")(
    lambda t: keys.relationship_cardinality(t["lineitem"], t["orders"], [("l_orderkey", "o_orderkey")])
)

# -- lookup -------------------------------------------------------------------------

_SEARCH = """SELECT *, CASE WHEN lower({c}) = '{q}' THEN 0 WHEN starts_with(lower({c}), '{q}') THEN 1 ELSE 2 END AS rank_class
    FROM {table} WHERE contains(lower({c}), '{q}') {scope} ORDER BY rank_class, {c}, {key} LIMIT {n}"""
register("t1_search_parts", _SEARCH.format(table="part", c="p_name", q="old", key="p_partkey", scope="", n=25))(
    lambda t: lookup.ranked_search(t["part"], "p_name", "OLD", ["p_partkey"])
)
register("t1_search_scoped", _SEARCH.format(
    table="part", c="p_name", q="red", key="p_partkey", scope="AND p_type = 'PROMO'", n=400
))(lambda t: lookup.ranked_search(t["part"], "p_name", "Red", ["p_partkey"], limit=400, scope={"p_type": "PROMO"}))
register("t1_search_customers", _SEARCH.format(table="customer", c="c_name", q="99", key="c_custkey", scope="", n=25))(
    lambda t: lookup.ranked_search(t["customer"], "c_name", "99", ["c_custkey"])
)

def _suggested_sql(codes: str, names: str) -> str:
    return f"""WITH pairs AS (
      SELECT code, candidate, lower(code) AS q, lower(candidate) AS n FROM ({codes}) a CROSS JOIN ({names}) b),
    scored AS (SELECT code, candidate,
      CAST(len(list_filter(range(1, least(length(q), length(n)) + 1), lambda i: left(q, i) = left(n, i)))
           + CASE WHEN contains(n, q) OR contains(q, n) THEN 2 ELSE 0 END AS INT) AS score FROM pairs),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY score DESC, candidate) AS r FROM scored WHERE score > 0)
    SELECT code, candidate, score FROM ranked WHERE r <= 5"""


register("t2_suggest_matches", _suggested_sql(
    "SELECT DISTINCT trim(name) AS code FROM party_source WHERE kind = 'vendor'",
    "SELECT DISTINCT name AS candidate FROM party_source WHERE kind = 'customer'",
))(
    lambda t: lookup.suggest_matches(
        t["party_source"].filter("kind = 'vendor'").selectExpr("trim(name) AS code"),
        t["party_source"].filter("kind = 'customer'").select("name"),
    )
)
register("t2_suggest_customers", _suggested_sql(
    "SELECT concat('customer#', lpad(CAST(s_suppkey * 13 AS VARCHAR), 9, '0')) AS code FROM supplier UNION SELECT substr(p_name, 1, 4) FROM part",
    "SELECT c_name AS candidate FROM customer UNION SELECT p_name FROM part",
))(
    lambda t: lookup.suggest_matches(
        t["supplier"].selectExpr("concat('customer#', lpad(CAST(s_suppkey * 13 AS STRING), 9, '0')) AS code").union(
            t["part"].selectExpr("substr(p_name, 1, 4)")),
        t["customer"].selectExpr("c_name AS name").union(t["part"].select("p_name")),
    )
)

_FOUND = """WITH words AS (
      SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM documents),
    found AS (SELECT doc_id, count(*) AS hits FROM words WHERE word IN ({words})
              GROUP BY doc_id HAVING count(DISTINCT word) = {n})
    SELECT doc_id, CAST(hits AS INT) AS hits, CAST(row_number() OVER (ORDER BY hits DESC, doc_id) AS INT) AS rank
    FROM found ORDER BY hits DESC, doc_id LIMIT 25"""


def _word_index(t) -> str:
    """The word index of all documents, in two loads."""
    path = work_dir(t.spark, "words")
    for load in (0, 1):
        lookup.index_words(t["documents"].filter(F.pmod("doc_id", F.lit(2)) == load), "doc_id", ["text"], path)
    return path


register("t3_indexed_search", _FOUND.format(words="'the', 'on'", n=2))(
    lambda t: lookup.indexed_search(t.spark, _word_index(t), "doc_id", "On, THE")
)
register("t3_token_search", """WITH words AS (
      SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents),
    found AS (SELECT doc_id, count(*) AS hits FROM words WHERE word IN ('the', 'on')
              GROUP BY doc_id HAVING count(DISTINCT word) = 2)
    SELECT doc_id, CAST(hits AS INT) AS hits, CAST(row_number() OVER (ORDER BY hits DESC, doc_id) AS INT) AS rank
    FROM found ORDER BY hits DESC, doc_id LIMIT 25""")(
    lambda t: lookup.token_search(t["documents"], "doc_id", ["text"], "On, THE")
)
