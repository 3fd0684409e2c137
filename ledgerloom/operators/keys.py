"""Keys and relationships, checked and discovered in the data itself."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import NESTED, NUMERIC, all_of, any_null, comparable_text, pct
from ledgerloom.session import shared_dir


@dataclass(frozen=True)
class ForeignKey:
    """A declared reference; ``pairs`` are (referencing column, referenced column)."""

    name: str
    referencing: str
    referenced: str
    pairs: tuple[tuple[str, str], ...]


def foreign_key_edges(spark: SparkSession, fks: Iterable[ForeignKey]) -> DataFrame:
    """Declared keys as an edge table for `bounded_paths`."""
    return spark.createDataFrame([(fk.referencing, fk.referenced) for fk in fks], "src string, dst string").distinct()


def key_check(df: DataFrame, cols: list[str]) -> DataFrame:
    """Is this column list a key? Rows with a NULL in it are counted apart."""
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    whole = ~any_null(cols)
    zero = F.lit(0).cast("long")
    return counts.agg(
        F.coalesce(F.sum("n"), zero).alias("rows"),
        F.count_if(whole).alias("distinct_keys"),
        F.count_if(whole & (F.col("n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(whole, F.col("n") - 1)), zero).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(~whole, F.col("n"))), zero).alias("null_keys"),
    )


def _child_keys(child: DataFrame, pairs) -> DataFrame:
    """One row per referencing key with its number of rows (a hot key becomes one row)."""
    return child.groupBy(*[F.col(c).alias(f"k{i}") for i, (c, _) in enumerate(pairs)]).agg(
        F.count(F.lit(1)).alias("n")
    )


def _parent_keys(parent: DataFrame, pairs) -> DataFrame:
    names = [f"k{i}" for i in range(len(pairs))]
    return (
        parent.select(*[F.col(p).alias(name) for name, (_, p) in zip(names, pairs)])
        .filter(~any_null(names)).distinct()
    )


def _relationship(child: DataFrame, parent: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Integrity and fan-out of one reference as one row; both sides are reduced to their keys first."""
    pairs = list(pairs)
    names = [f"k{i}" for i in range(len(pairs))]
    left = _child_keys(child, pairs).withColumn("skipped", any_null(names))
    right = _parent_keys(parent, pairs).withColumn("known", F.lit(True))
    both = left.join(right, names, "full_outer")
    zero = F.lit(0).cast("long")
    checked, known = ~F.col("skipped"), F.col("known")
    children = F.when(known, F.coalesce("n", zero))
    counts = both.agg(
        F.coalesce(F.sum(F.when(checked, F.col("n"))), zero).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("skipped"), F.col("n"))), zero).alias("null_skipped"),
        F.coalesce(F.sum(F.when(checked & known.isNull(), F.col("n"))), zero).alias("orphans"),
        F.count_if(known & F.col("n").isNull()).alias("childless_parents"),
        F.count("known").alias("parents"), F.min(children).alias("min_children"),
        F.try_divide(F.sum(children).cast("double"), F.count("known")).alias("avg_children"),
        F.max(children).alias("max_children"),
    )
    return counts.withColumn("orphan_pct", pct(F.col("orphans"), F.col("checked")))


def fk_check(child: DataFrame, parent: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Referential integrity of a reference, in both directions, as one row.

    A child row with a NULL in any key column is skipped. Both sides are reduced to
    their distinct keys before the join.
    """
    return _relationship(child, parent, pairs).select(
        "checked", "null_skipped", "orphans", "orphan_pct", F.col("childless_parents").alias("unreferenced_parents")
    )


def orphans(child: DataFrame, parent: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Child rows whose complete key has no parent."""
    pairs = list(pairs)
    # Not reduced to distinct keys: the join needs none, and a hot child key is split by
    # adaptive execution only when both sides come straight from their shuffles.
    keys = parent.select(*[F.col(p).alias(f"k{i}") for i, (_, p) in enumerate(pairs)])
    match = all_of([F.col(c) == keys[f"k{i}"] for i, (c, _) in enumerate(pairs)])
    return child.filter(~any_null([c for c, _ in pairs])).join(keys, match, "left_anti")


def relationship_cardinality(child: DataFrame, parent: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Children per parent: smallest, mean and largest number, and childless parents."""
    pairs = list(pairs)
    names = [f"k{i}" for i in range(len(pairs))]
    fan_out = _parent_keys(parent, pairs).join(_child_keys(child, pairs), names, "left")
    n = F.coalesce("n", F.lit(0))
    return fan_out.agg(
        F.count(F.lit(1)).alias("parents"),
        F.min(n).alias("min_children"),
        F.try_divide(F.sum(n).cast("double"), F.count(F.lit(1))).alias("avg_children"),
        F.max(n).alias("max_children"),
        F.count_if(n == 0).alias("childless_parents"),
    )


def check_relationships(
    tables: dict[str, DataFrame], fks: Iterable[ForeignKey], table: str | None = None, direction: str = "both"
) -> DataFrame:
    """Integrity and fan-out of all declared keys, a row for each key and direction.

    ``direction`` is that seen from ``table``: ``parent`` for keys in which it is referenced, ``child`` for
    those in which it refers, or ``both``. Without ``table`` every key is listed once in each direction
    asked for, under either of its tables.
    """
    if direction not in ("parent", "child", "both"):
        raise ValueError("direction is parent, child or both")
    sides = ["parent", "child"] if direction == "both" else [direction]
    rows = []
    for fk in fks:
        seen = {"parent": fk.referenced, "child": fk.referencing}
        wanted = [side for side in sides if table is None or seen[side] == table]
        if wanted:
            child, parent = tables[fk.referencing], tables[fk.referenced]
            measured = _relationship(child, parent, fk.pairs)
            views = F.array(*[
                F.struct(F.lit(side).alias("direction"), F.lit(seen[side]).alias("table"),
                         F.lit(seen["child" if side == "parent" else "parent"]).alias("other")) for side in wanted
            ])
            rows.append(measured.select(F.lit(fk.name).alias("name"), F.inline(views), *measured.columns))
    if not rows:
        raise ValueError(f"no key of {table} in this direction")
    return reduce(DataFrame.unionByName, rows)


def _value_kind(data_type: T.DataType) -> str | None:
    """Columns are compared inside one kind of value: all numbers, all dates and times, all texts."""
    if isinstance(data_type, (*NESTED, T.BinaryType, T.BooleanType)):
        return None
    if isinstance(data_type, NUMERIC):
        return "number"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    return "string" if isinstance(data_type, T.StringType) else data_type.simpleString()


def discover_inclusions(
    tables: dict[str, DataFrame],
    min_coverage: float = 1.0,
    max_pairs: int | None = None,
    columns: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Column pairs where the values of one occur in the other.

    Every column becomes a bit. Values are shuffled once and reduced to the set of
    columns they occur in; equal sets are then counted, and only those counts, one
    per combination of columns that occurs, are expanded to pairs. The data is never
    joined with itself.
    """
    found = []
    for table, df in tables.items():
        for field in df.schema:
            kind = _value_kind(field.dataType)
            if kind and (columns is None or field.name in columns.get(table, [])):
                found.append((table, field, kind))
    words = len(found) // 63 + 1

    def bits(number: int):
        word, bit = divmod(number, 63)
        return [F.lit(1 << bit if w == word else 0).cast("long").alias(f"w{w}") for w in range(words)]

    cells, sizes = [], []
    for table, df in tables.items():
        own = [(number, field, kind) for number, (name, field, kind) in enumerate(found) if name == table]
        if own:
            cells.append(
                df.select(F.inline(F.array(*[
                    F.struct(F.lit(kind).alias("kind"), comparable_text(field).alias("value"), *bits(number))
                    for number, field, kind in own
                ]))).filter(F.col("value").isNotNull())
            )
            counted = df.agg(*[F.count(F.col(f"`{field.name}`")).alias(str(number)) for number, field, _ in own])
            sizes.append(counted.select(F.inline(F.array(*[
                F.struct(F.lit(number).alias("number"), F.col(f"`{number}`").alias("filled")) for number, _, _ in own
            ]))))
    cells, filled = reduce(DataFrame.unionAll, cells), reduce(DataFrame.unionAll, sizes)
    masks = [f"w{w}" for w in range(words)]
    sets = (
        cells.groupBy("kind", "value").agg(*[F.bit_or(m).alias(m) for m in masks])
        .groupBy(*masks).agg(F.count(F.lit(1)).alias("n"))
    )
    members = F.array_compact(
        F.array(*[
            F.when(F.col(f"w{i // 63}").bitwiseAND(F.lit(1 << (i % 63)).cast("long")) != 0, F.lit(i))
            for i in range(len(found))
        ])
    )
    per_child = (
        sets.select("n", members.alias("members"))
        .select("n", "members", F.explode("members").alias("child"))
        .select("child", "n", F.explode("members").alias("parent"))
        .groupBy("child", "parent").agg(F.sum("n").alias("matched"))
    )
    own_size = per_child.filter("child = parent").select("child", F.col("matched").alias("child_distinct"))
    unique = (
        filled.join(own_size, F.col("number") == F.col("child"))
        .select(F.col("number").alias("parent"), (F.col("filled") == F.col("child_distinct")).alias("parent_unique"))
    )
    names = F.array(*[F.lit(f"{table}.{field.name}") for table, field, _ in found])
    pairs = (
        per_child.filter("child <> parent").join(own_size, "child").join(unique, "parent")
        .select(
            F.get(names, F.col("child")).alias("child_col"), F.get(names, F.col("parent")).alias("parent_col"),
            "child_distinct", "matched",
            (F.col("matched").cast("double") / F.col("child_distinct")).alias("coverage"), "parent_unique",
        )
        .filter(F.col("coverage") >= min_coverage)
    )
    if max_pairs is None:
        return pairs
    return pairs.orderBy(F.desc("coverage"), F.desc("matched"), "child_col", "parent_col").limit(max_pairs)


def discover_composite_inclusions(
    tables: dict[str, DataFrame], width: int = 2, columns: dict[str, list[str]] | None = None, max_candidates: int = 10_000,
) -> DataFrame:
    """Lists of up to ``width`` columns of one table whose rows all occur in columns of another.

    Columns: child_table, child_cols, parent_table, parent_cols, child_distinct, parent_unique. Rows with a missing part do not count.
    Lists grow column by column. A list counts only if each part of it is included too, down to its columns by themselves, as is always
    so where no value is missing: the candidates of a level are put together from the inclusions of the level before. All lists of a level are then
    compared in one pass over the tables, as `discover_inclusions` compares columns. Names of columns, never values, pass
    through the driver; more than ``max_candidates`` of a level are refused.
    """
    if width < 2:
        raise ValueError("width is 2 at least")
    kept = {name: [f for f in df.schema if _value_kind(f.dataType) and (columns is None or f.name in columns.get(name, []))]
            for name, df in tables.items()}
    single = discover_inclusions(tables, columns={name: [f.name for f in fields] for name, fields in kept.items()})
    # Inclusions of a level: for two tables, pairs (column, column it is in) by name of the first.
    level: set[tuple] = set()
    for row in single.select("child_col", "parent_col").collect():
        child, one = row.child_col.split(".", 1)
        parent, other = row.parent_col.split(".", 1)
        if child != parent:
            level.add((child, parent, ((one, other),)))
    found: list[DataFrame] = []
    for size in range(2, width + 1):
        candidates = set()
        for child, parent, pairs in level:
            for child2, parent2, more in level:
                if (child, parent, pairs[:-1]) == (child2, parent2, more[:-1]) and pairs[-1][0] < more[-1][0]:
                    joined = (*pairs, more[-1])
                    parts = [joined[:i] + joined[i + 1:] for i in range(size)]
                    if len({p for _, p in joined}) == size and all((child, parent, part) in level for part in parts):
                        candidates.add((child, parent, joined))
        if not candidates:
            break
        if len(candidates) > max_candidates:
            raise ValueError(f"{len(candidates)} candidates of {size} columns; name the columns to look at")
        lists: dict[str, set[tuple]] = {}
        for child, parent, pairs in candidates:
            lists.setdefault(child, set()).add(tuple(c for c, _ in pairs))
            lists.setdefault(parent, set()).add(tuple(p for _, p in pairs))
        numbered = {name: sorted(some) for name, some in lists.items()}
        fields = {name: {f.name: f for f in some} for name, some in kept.items()}
        whole = {
            name: tables[name].select(*[_joined_text([fields[name][c] for c in some]).alias(str(i)) for i, some in enumerate(numbered[name])])
            for name in numbered
        }
        place = {(name, some): f"{name}.{i}" for name, all_lists in numbered.items() for i, some in enumerate(all_lists)}
        spark = next(iter(tables.values())).sparkSession
        asked = spark.createDataFrame(
            [(place[c, tuple(x for x, _ in pairs)], place[p, tuple(y for _, y in pairs)], c, [x for x, _ in pairs], p, [y for _, y in pairs])
             for c, p, pairs in sorted(candidates)],
            "child_col string, parent_col string, child_table string, child_cols array<string>, parent_table string, parent_cols array<string>")
        here = discover_inclusions(whole).join(asked, ["child_col", "parent_col"]).select(
            "child_table", "child_cols", "parent_table", "parent_cols", "child_distinct", "parent_unique")
        found.append(here)
        if size < width:
            level = {(r.child_table, r.parent_table, tuple(zip(r.child_cols, r.parent_cols))) for r in here.collect()}
    if not found:
        return next(iter(tables.values())).sparkSession.createDataFrame(
            [], "child_table string, child_cols array<string>, parent_table string, parent_cols array<string>, child_distinct long, parent_unique boolean")
    return reduce(DataFrame.unionByName, found)


def _joined_text(fields: list[T.StructField]) -> Column:
    """One text for several values, which equal lists share and others do not; NULL if a value is."""
    parts = [comparable_text(field) for field in fields]
    return F.concat(*[x for part in parts for x in (F.length(part).cast("string"), F.lit(":"), part)])


def join_along_path(
    tables: dict[str, DataFrame],
    path: list[str],
    fks: Iterable[ForeignKey],
    how: str = "inner",
    via: list[str] | None = None,
) -> DataFrame:
    """Join the tables of a route, each with the one before it.

    Keys may be walked in either direction and may have several columns. When a pair
    of tables has more than one key, ``via`` names the key of each hop. Columns whose
    name occurs in several tables come out as ``table_column``.
    """
    fks = list(fks)
    if len(set(path)) != len(path):
        raise ValueError("a route visits a table once; give a second visit its own table name")
    names = [name for table in path for name in tables[table].columns]

    def fetched(table: str) -> DataFrame:
        df = tables[table]
        return df.select([F.col(f"`{c}`").alias(f"{table}/{c}") for c in df.columns])

    joined = fetched(path[0])
    for hop, (here, there) in enumerate(zip(path, path[1:])):
        fitting = [fk for fk in fks if {fk.referencing, fk.referenced} == {here, there} and here != there]
        if via is not None:
            fitting = [fk for fk in fitting if fk.name == via[hop]]
        if len(fitting) != 1:
            raise ValueError(f"{len(fitting)} keys between {here} and {there}; name one with via")
        fk = fitting[0]
        condition = all_of([
            F.col(f"`{fk.referencing}/{c}`") == F.col(f"`{fk.referenced}/{p}`") for c, p in fk.pairs
        ])
        joined = joined.join(fetched(there), condition, how)
    return joined.select([
        F.col(f"`{table}/{c}`").alias(c if names.count(c) == 1 else f"{table}_{c}")
        for table in path for c in tables[table].columns
    ])


def bounded_paths(
    edges: DataFrame, sources: DataFrame, targets: DataFrame, max_depth: int = 3, cap: int = 10
) -> DataFrame:
    """Simple routes of up to ``max_depth`` edges, at most ``cap`` per pair, short ones first.

    ``edges`` has columns src and dst and counts in both directions; ``sources`` and
    ``targets`` have a column node. A node is reached from itself by the route of no
    edges. Nodes are first given their distance to the nearest target, and a route is
    only extended to nodes it can still finish from.
    """
    if max_depth < 0:
        raise ValueError("max_depth must not be negative")
    shared_dir(edges.sparkSession)
    links = (
        edges.select("src", "dst").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        .filter("src <> dst").distinct().checkpoint()
    )
    ends = targets.select("node").distinct()
    left = ends.withColumn("left", F.lit(0))
    for hop in range(1, max_depth):
        onward = left.filter(F.col("left") == hop - 1).join(links, F.col("node") == F.col("src"))
        left = (
            left.unionAll(onward.select(F.col("dst").alias("node"), F.lit(hop).alias("left")))
            .groupBy("node").agg(F.min("left").alias("left")).checkpoint()
        )
    routes = sources.select(F.col("node").alias("src")).distinct().select(
        "src", F.col("src").alias("dst"), F.lit(0).alias("depth"), F.array("src").alias("path")
    )
    found = [routes]
    for depth in range(1, max_depth + 1):
        near = left.filter(F.col("left") <= max_depth - depth).select(F.col("node").alias("next"))
        step = links.select(F.col("src").alias("dst"), F.col("dst").alias("next")).join(near, "next", "left_semi")
        routes = (
            routes.join(step, "dst").filter(~F.array_contains("path", F.col("next")))
            .select("src", F.col("next").alias("dst"), F.lit(depth).alias("depth"),
                    F.concat("path", F.array("next")).alias("path"))
        )
        if depth < max_depth:
            routes = routes.checkpoint()
        found.append(routes)
    first = Window.partitionBy("src", "dst").orderBy("depth", "path")
    return (
        reduce(DataFrame.unionAll, found)
        .join(ends, F.col("dst") == F.col("node"), "left_semi")
        .withColumn("n", F.row_number().over(first)).filter(F.col("n") <= cap).drop("n")
    )
