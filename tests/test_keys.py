import itertools
import random

import pytest
from conftest import SMALL, got, one

from __spark_entry__ import queries
from ledgerloom.operators import keys, lookup
from ledgerloom.operators.keys import ForeignKey


def test_composite_key_with_a_null_part(make):
    df = make("a int, b int", (1, 1), (1, 1), (1, 2), (1, None), (None, None))
    assert one(keys.key_check(df, ["a", "b"])) == {
        "rows": 5, "distinct_keys": 2, "duplicate_keys": 1, "duplicate_rows": 1, "null_keys": 2,
    }
    assert one(keys.key_check(df.limit(0), ["a"]))["rows"] == 0


def test_foreign_key_to_itself(make):
    staff = make("id int, boss int", (1, None), (2, 1), (3, 1), (4, 9))
    assert one(keys.fk_check(staff, staff, [("boss", "id")])) == {
        "checked": 3, "null_skipped": 1, "orphans": 1, "orphan_pct": pytest.approx(100 / 3), "unreferenced_parents": 3,
    }
    assert got(keys.orphans(staff, staff, [("boss", "id")])) == [(4, 9)]
    assert one(keys.relationship_cardinality(staff, staff, [("boss", "id")])) == {
        "parents": 4, "min_children": 0, "avg_children": 0.5, "max_children": 2, "childless_parents": 3,
    }


def test_composite_foreign_key_skips_partial_nulls(make):
    child = make("x int, y int", (1, 1), (1, None), (2, 1))
    parent = make("p int, q int", (1, 1), (1, 1), (3, 3))
    row = one(keys.fk_check(child, parent, [("x", "p"), ("y", "q")]))
    assert (row["checked"], row["null_skipped"], row["orphans"], row["unreferenced_parents"]) == (2, 1, 1, 1)


def test_inclusions_against_brute_force(make):
    random.seed(5)
    values = {f"c{i}": {random.randrange(12) for _ in range(random.randrange(1, 9))} for i in range(70)}
    columns = [sorted(vs) + [None] * (9 - len(vs)) for vs in values.values()]
    tables = {
        half: make(", ".join(f"c{i} bigint" for i in part), *zip(*[columns[i] for i in part]))
        for half, part in (("a", range(35)), ("b", range(35, 70)))
    }
    tables["other"] = make("t string", ("1",), ("2",))
    full = lambda name: f"{'a' if int(name[1:]) < 35 else 'b'}.{name}"
    expected = sorted(
        (full(a), full(b), len(values[a]), len(values[a] & values[b]))
        for a, b in itertools.permutations(values, 2)
        if len(values[a] & values[b]) / len(values[a]) >= 0.75
    )
    found = keys.discover_inclusions(tables, 0.75)
    assert sorted(tuple(row)[:4] for row in found.collect()) == expected
    assert keys.discover_inclusions(tables, 0.75, max_pairs=5).count() == 5


def test_inclusion_reports_unique_parents(make):
    tables = {"a": make("x int", (1,), (1,), (None,)), "b": make("y int", (1,), (2,))}
    assert got(keys.discover_inclusions(tables)) == [("a.x", "b.y", 1, 1, 1.0, True)]
    assert ("b.y", "a.x", 2, 1, 0.5, False) in got(keys.discover_inclusions(tables, 0.5))


def test_join_needs_a_named_key_between_ambiguous_tables(make):
    tables = {
        "trip": make("id int, origin int, goal int", (1, 10, 20)),
        "place": make("id int, name string", (10, "here"), (20, "there")),
    }
    fks = [ForeignKey("from", "trip", "place", (("origin", "id"),)), ForeignKey("to", "trip", "place", (("goal", "id"),))]
    with pytest.raises(ValueError):
        keys.join_along_path(tables, ["trip", "place"], fks)
    joined = keys.join_along_path(tables, ["trip", "place"], fks, via=["to"])
    assert joined.columns == ["trip_id", "origin", "goal", "place_id", "name"]
    assert got(joined.select("name")) == [("there",)]
    backwards = keys.join_along_path(tables, ["place", "trip"], fks, how="left", via=["from"])
    assert got(backwards.select("name", "trip_id")) == [("here", 1), ("there", None)]
    with pytest.raises(ValueError):
        keys.join_along_path(tables, ["trip", "trip"], fks)


def brute_paths(edges, source, target, depth):
    links = {}
    for a, b in edges:
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)
    found, open_ = [], [[source]]
    while open_:
        path = open_.pop()
        if path[-1] == target:
            found.append((len(path) - 1, path))
        if len(path) <= depth:
            open_ += [[*path, n] for n in links.get(path[-1], ()) if n not in path]
    return sorted(found)


def test_paths_against_brute_force(make):
    random.seed(2)
    names = "abcdefgh"
    edges = [(random.choice(names), random.choice(names)) for _ in range(13)] + [("x", "y")]
    df = make("src string, dst string", *edges)
    ends = make("node string", *[(n,) for n in "abx"])
    goals = make("node string", *[(n,) for n in "acgy"])
    for cap in (2, 50):
        rows = keys.bounded_paths(df, ends, goals, max_depth=4, cap=cap).collect()
        for source in "abx":
            for target in "acgy":
                mine = sorted((r.depth, list(r.path)) for r in rows if (r.src, r.dst) == (source, target))
                assert mine == brute_paths([e for e in edges if e[0] != e[1]], source, target, 4)[:cap]


def test_path_limits(make):
    df = make("src string, dst string", ("a", "b"))
    node = make("node string", ("a",))
    assert got(keys.bounded_paths(df, node, node, 0)) == [("a", "a", 0, ["a"])]
    assert got(keys.bounded_paths(df, node, make("node string", ("z",)), 3)) == []
    assert got(keys.bounded_paths(df, node, make("node string", ("b",)), 7)) == [("a", "b", 1, ["a", "b"])]
    with pytest.raises(ValueError):
        keys.bounded_paths(df, node, node, -1)


def test_search_ranks_and_takes_the_query_literally(make):
    df = make("id int, name string, kind string", (1, "a%b", "x"), (2, "AB", "x"), (3, "a%bc", "y"), (4, "za%b", "x"), (5, "a_b", "x"))
    assert [tuple(r)[:1] + (r.rank_class,) for r in lookup.ranked_search(df, "name", "A%B", ["id"]).collect()] == [
        (1, 0), (3, 1), (4, 2),
    ]
    assert [r.id for r in lookup.ranked_search(df, "name", "a", ["id"], limit=2, scope={"kind": "x"}).collect()] == [2, 1]


def brute_suggestions(code, names, k):
    q, scored = code.lower(), []
    for name in set(names):
        n = name.lower()
        shared = 0
        while shared < min(len(q), len(n)) and q[shared] == n[shared]:
            shared += 1
        score = shared + (2 if q in n or n in q else 0)
        if score:
            scored.append((-score, name))
    return [(name, -score) for score, name in sorted(scored)[:k]]


@pytest.mark.parametrize("seed", range(4))
def test_suggestions_against_brute_force(make, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abAB") for _ in range(rng.randrange(0, 7)))
    codes, names = {word() for _ in range(25)}, [word() for _ in range(60)]
    found = lookup.suggest_matches(
        make("code string", *[(c,) for c in codes]), make("name string", *[(n,) for n in names]), k=3
    )
    per_code = {}
    for row in found.collect():
        per_code.setdefault(row.code, []).append((row.candidate, row.score))
    for code in codes:
        mine = sorted(per_code.get(code, []), key=lambda pair: (-pair[1], pair[0]))
        assert mine == brute_suggestions(code, names, 3), code


def test_token_search_reads_whole_texts(make):
    filler = "word " * 30_000
    df = make("id int, a string, b string", (1, filler + "Blue bolt", None), (2, "blue", "bolt, BLUE"), (3, "blueish bolt", ""))
    assert [tuple(r) for r in lookup.token_search(df, "id", ["a", "b"], "Bolt blue").collect()] == [(2, 3, 1), (1, 2, 2)]
    with pytest.raises(ValueError):
        lookup.token_search(df, "id", ["a"], " ,. ")


def test_inclusions_are_registered_over_whole_tables(spark):
    found = {(r.child_col, r.parent_col) for r in queries()["r4_inclusions_of_whole_tables"](spark, SMALL).collect()}
    assert {("customer.c_nationkey", "nation.n_nationkey"), ("nation.n_regionkey", "region.r_regionkey"),
            ("lineitem.l_quantity", "part.p_size"), ("orders.o_custkey", "customer.c_custkey")} <= found


def test_indexed_search_reads_its_own_words(make, spark, tmp_path):
    rng = random.Random(4)
    vocabulary = ["the", "The", "état", "x1", "naïve", "b", "日本"] + [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "-", "_"]) for _ in range(30)), rng.choice([None, "b b", ""])) for i in range(200)]
    rows += [(900, None, None), (901, "", "the")]
    path, frame = f"{tmp_path}/words", make("id int, text string, more string", *rows)
    for load in (frame.filter("id < 90"), frame.filter("id >= 90"), frame.limit(0)):
        lookup.index_words(load, "id", ["text", "more"], path)
    for query in ("the", "THE w7", "état b", "w1 w2 w3", "nowhere", "the nowhere", "日本 x1 b the"):
        wanted = lookup.token_search(frame, "id", ["text", "more"], query).select("id", "hits", "rank")
        assert got(lookup.indexed_search(spark, path, "id", query)) == got(wanted)
    with pytest.raises(ValueError):
        lookup.indexed_search(spark, path, "id", " ,-")
    found = lookup.postings(spark, path, ["w7", "w8"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(word" in plan and "PartitionFilters: [bucket" in plan
    assert found.filter("word not in ('w7', 'w8')").count() == 0 < found.count()


def brute_composites(tables, width):
    """Every list of columns of one table against every list of another, row by row; its parts must be included too."""
    def included(child, some, parent, into):
        (names, rows), (others, more) = tables[child], tables[parent]
        held = {v for v in (tuple(r[names.index(c)] for c in some) for r in rows) if None not in v}
        there = [v for v in (tuple(r[others.index(c)] for c in into) for r in more) if None not in v]
        return (len(held), len(there) == len(set(there))) if held and held <= set(there) else None

    out = set()
    for child, parent in itertools.permutations(tables, 2):
        for size in range(2, width + 1):
            for some in itertools.combinations(sorted(tables[child][0]), size):
                for into in itertools.permutations(tables[parent][0], size):
                    parts = [p for n in range(1, size) for p in itertools.combinations(range(size), n)]
                    if all(included(child, [some[i] for i in p], parent, [into[i] for i in p]) for p in parts) and (
                            found := included(child, some, parent, into)):
                        out.add((child, some, parent, into, *found))
    return out


def test_composite_inclusions(make):
    rng = random.Random(6)
    pairs = [(i % 7, i // 7 + 10) for i in range(40)]
    parent = [(a, b, a * 3 % 5, f"n{a}") for a, b in pairs]
    child = [(*rng.choice(pairs), rng.choice([1, 2, None])) for _ in range(60)] + [(None, 11, 1)]
    other = [(float(a), f"n{a}", b) for a, b in rng.sample(pairs, 20)] + [(2.0, None, 99)]
    tables = {"p": (["a", "b", "m", "name"], parent), "c": (["x", "y", "z"], child), "o": (["fa", "fn", "fb"], other)}
    frames = {"p": make("a int, b long, m int, name string", *parent), "c": make("x long, y int, z int", *child),
              "o": make("fa double, fn string, fb int", *other)}
    for width in (2, 3):
        found = keys.discover_composite_inclusions(frames, width).collect()
        mine = {(r.child_table, tuple(r.child_cols), r.parent_table, tuple(r.parent_cols), r.child_distinct, r.parent_unique) for r in found}
        assert mine == brute_composites(tables, width) and len(found) == len(mine)
    assert any(r.child_cols == ["x", "y"] and r.parent_cols == ["a", "b"] and r.parent_unique for r in found)
    assert keys.discover_composite_inclusions({"c": frames["c"], "e": frames["p"].limit(0)}).collect() == []
    with pytest.raises(ValueError):
        keys.discover_composite_inclusions(frames, max_candidates=0)
