import random

import freshet.operators.hierarchy as H


def brute(rows):
    to, div = {}, {}
    for i, t, d in rows:
        if i is None:
            continue
        i, t = i.strip(), t.strip() if t is not None else None
        to.setdefault(i, set())
        if t is not None and t not in H.NO_PARENT:
            to[i].add(t)
        div.setdefault(i, set()).update([d] if d is not None else [])
    to = {i: min((t for t in ts if t in to), default=None) for i, ts in to.items()}
    out, up, path_of = {}, {i: set() for i in to}, {}
    for i in to:
        path, v = [], i
        while v is not None and v not in path:
            path.append(v)
            v = to[v]
        path_of[i] = path if v is None else None
        out[i] = (path[-1], len(path) - 1) if v is None else ("CYCLE", -1)
        for u in path if v is None else []:
            up[u] |= div[i]
    return {i: (*out[i], len(up[i]) if out[i][1] >= 0 else -1) for i in to}, path_of


def check(spark, rows):
    df = spark.createDataFrame(rows, "id string, toid string, divide_id string").selectExpr("*", "1 AS v", "2 AS p", "3 AS root", "4 AS depth")
    want, path_of = brute(rows)
    got = H.summary(df).collect()
    assert {r.id: (r.root_id, r.depth, r.n_up) for r in got} == want and len(got) == len(want)
    h = H.build_hierarchy(df)
    found = H.paths(h).collect()
    assert {r.id: r.path for r in found} == path_of and len(found) == len(path_of)
    under = {(r.id, r.descendant) for r in H.descendants(h, df).collect()}
    assert under == {(u, i) for i, path in path_of.items() for u in path or []}


def test_small_cases(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_STEPS", 7)
    rows = [("a", "b", "d1"), ("b", "c", "d2"), (" c ", "", "d3"), ("e", "c", "d1"), ("a", " b", None), ("f", "nowhere", "d4"), ("g", "wb-0", None)]
    rows += [("x", "y", "d5"), ("y", "z", "d6"), ("z", "x", "d7"), ("in", "x", "d8"), ("self", "self", "d9"), ("to_self", "self", None)]
    rows += [(None, "a", "d"), ("n", None, "d"), ("two", "a", "k"), ("two", "b", "k"), ("p", "q", "m"), ("q", "p", "m")]
    check(spark, rows)


def test_random_forest_with_repeats_and_circles(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_STEPS", 16)
    rng = random.Random(5)
    rows = [(f"n{i}", f"n{rng.randint(max(0, i - 12), max(0, i - 1))}" if i else "nan", rng.choice([f"d{rng.randint(0, 25)}", f"u{i}", None])) for i in range(160)]
    rows += [(f"s{i}", "n3", f"d{i % 9}") for i in range(60)]
    rows += [(f"c{i}", f"c{(i + 1) % 9}", f"d{i}") for i in range(9)] + [(f"t{i}", f"c{i % 9}", None) for i in range(10)]
    check(spark, rows)


def everything(spark, rows):
    df = spark.createDataFrame(rows, "id string, toid string, divide_id string").selectExpr("*", "1 AS value", "2 AS descendant", "3 AS n")
    _, path_of = brute(rows)
    div = {}
    for i, _, d in rows:
        if i is not None:
            div.setdefault(i.strip(), set()).update([d] if d is not None else [])
    want = [(u, i, d) for i, path in path_of.items() for u in path or [] for d in div[i] or [None]] + [(i, None, None) for i, path in path_of.items() if path is None]
    got = [(r.id, r.descendant, r.value) for r in H.upstream(H.build_hierarchy(df), df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_upstream_with_values(spark, monkeypatch):
    monkeypatch.setattr(H, "RUN_NODES", 3)
    monkeypatch.setattr(H, "COPY_LEVELS", 2)
    monkeypatch.setattr(H, "TASK_PAIRS", 10)
    rng = random.Random(6)
    rows = [(f"n{i}", f" n{rng.randint(max(0, i - 4), max(0, i - 1))} " if i else "nan", rng.choice([f"d{i}", f"d{i // 2}", None])) for i in range(70)]
    rows += [("n5", None, "second"), ("n6", None, None), (None, "n1", "x"), ("dead", "nowhere", "e"), (" blank ", "n1", None)]
    rows += [("x", "y", "d5"), ("y", "x", "d6"), ("in", "x", None), ("self", "self", "d9")]
    everything(spark, rows)


def test_descendants_of_some_in_a_chain(spark):
    df = spark.range(3000).selectExpr("cast(id AS string) AS id", "cast(id - 1 AS string) AS toid", "'d' AS divide_id").cache()
    h = H.build_hierarchy(df)
    some = df.filter("id IN ('2990', '2999', '0')")
    assert {r.id: r["count"] for r in H.descendants(h, some).groupBy("id").count().collect()} == {"0": 3000, "2990": 10, "2999": 1}


def test_empty(spark):
    df = spark.createDataFrame([], "id string, toid string, divide_id string")
    assert H.summary(df).collect() == []
