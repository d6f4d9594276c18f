from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions import valuetypes as V
from tidemark.functions.wyhash import UNSHARDED, wyhash_hex
from tidemark.plans import expr as E
from tidemark.plans import pushdown as P
from tidemark.sources import parts

EPOCH = dt.datetime(1970, 1, 1)
TS, NAME, AGE = E.Field("timestamp", V.MILLIS), E.Field("name", V.STRING), E.Field("age", V.INT32)
COLUMNS = {"timestamp": P.ColumnInfo(V.MILLIS, V.StorageType("datetime64")), "name": P.ColumnInfo(V.STRING, V.StorageType("string")), "age": P.ColumnInfo(V.UINT32, V.StorageType("uint32")), "other": P.ColumnInfo(V.MILLIS, V.StorageType("datetime64"))}
PLAIN, SHARDED = P.Layout("timestamp", None, COLUMNS), P.Layout("timestamp", "name", COLUMNS)


def at(seconds: float) -> dt.datetime:
    return EPOCH + dt.timedelta(seconds=seconds)


def lit(seconds: float) -> E.Lit:
    return E.Lit(at(seconds))


TEN = [P.Part(at(30 * i), at(30 * i + 60), UNSHARDED, str(i + 1), 1000) for i in range(10)]
TWENTY = [P.Part(p.min_ts, p.max_ts, wyhash_hex(n), p.path + n[0].lower(), 1000) for p in TEN for n in ("Alex", "Bob")]
TIMES = E.ArrayLit((at(60), at(300)), V.Array(V.MILLIS))
ALEX = E.eq(NAME, E.Lit("Alex"))


@pytest.mark.parametrize(
    ("predicate", "left"),
    [
        (E.eq(TS, lit(-1)), 0), (E.eq(TS, lit(30)), 2), (E.eq(TS, lit(60)), 3), (E.Or(E.eq(TS, lit(60)), ALEX), 10), (E.Or(E.eq(TS, lit(60)), E.eq(TS, lit(300))), 5),
        (E.In(TS, TIMES), 5), (E.between(TS, lit(120), lit(180)), 5), (E.Or(E.In(TS, E.ArrayLit((at(60),), V.Array(V.MILLIS))), E.eq(TS, lit(300))), 5),
    ],
)
def test_files_left(predicate, left):
    bounds = P.prunable(predicate, PLAIN) or E.TRUE
    assert sum(P.include(bounds, p, PLAIN) for p in TEN) == left
    assert sum(P.include(predicate, p, PLAIN) for p in TEN) == left


def test_prunable():
    one, two = E.eq(TS, lit(1234)), E.eq(TS, lit(2345))
    assert P.prunable(one, PLAIN) == one
    assert P.prunable(ALEX, PLAIN) is None and P.prunable(ALEX, SHARDED) == ALEX
    assert P.prunable(E.eq(AGE, E.Lit(50)), SHARDED) is None
    assert P.prunable(E.And(one, E.TRUE), PLAIN) == one
    assert P.prunable(E.And(one, ALEX), SHARDED) == E.And(one, ALEX)
    assert P.prunable(E.Or(one, two), PLAIN) == E.Or(one, two)
    assert P.prunable(E.Or(one, ALEX), PLAIN) is None
    late = E.ge(TS, lit(30))
    assert P.prunable(E.And(E.Or(one, ALEX), late), PLAIN) == late
    assert P.prunable(E.eq(TS, E.Field("timestamp2", V.MILLIS)), PLAIN) is None
    assert P.prunable(E.And(one, E.Not(two)), PLAIN) == E.And(one, E.Not(two))
    listed = E.In(TS, TIMES)
    assert P.prunable(listed, PLAIN) == listed and P.prunable(E.Not(listed), PLAIN) is None
    # NOT (a OR b): either half bounds files by itself; NOT (a AND b) only if both do.
    assert P.prunable(E.Not(E.Or(one, E.eq(AGE, E.Lit(50)))), PLAIN) == E.Not(one)
    assert P.prunable(E.Not(E.And(one, E.eq(AGE, E.Lit(50)))), PLAIN) is None


def test_classify():
    one, age = E.eq(TS, lit(1)), E.eq(AGE, E.Lit(50))
    assert [P.classify(e, PLAIN) for e in (E.TRUE, one, ALEX, age)] == [1, 2, 2, 3]
    assert P.classify(E.And(one, ALEX), PLAIN) == 2 and P.classify(E.And(one, age), PLAIN) == 3
    assert P.classify(E.Or(one, ALEX), PLAIN) == 2 and P.classify(E.Not(E.Or(one, age)), PLAIN) == 3
    with pytest.raises(KeyError):
        P.classify(E.eq(E.Field("none", V.STRING), E.Lit("x")), PLAIN)


def test_field_literal():
    assert E.field_literal(E.lt(E.Lit(5), AGE), "age") == ("age", E.Op.GT, E.Lit(5))
    assert E.field_literal(E.eq(E.Lit(5), AGE)) == ("age", E.Op.EQ, E.Lit(5))
    assert E.field_literal(E.eq(TS, E.Lit(at(1), V.SECONDS)), "timestamp") is not None
    assert E.field_literal(E.eq(AGE, E.Lit("x"))) is None and E.field_literal(E.eq(AGE, E.Lit(5)), "name") is None


def test_bounds_are_the_tightest():
    e = E.And(E.And(E.ge(TS, lit(10)), E.gt(TS, lit(20))), E.And(E.In(TS, TIMES), E.And(ALEX, E.lt(TS, lit(400)))))
    assert P.bounds(e, SHARDED) == (at(60), at(300), [wyhash_hex("Alex")])
    assert P.bounds(E.And(ALEX, E.eq(NAME, E.Lit("Bob"))), SHARDED)[2] == []


def test_render():
    quote = E.eq(NAME, E.Lit("O'Neil"))
    assert P.render(quote, PLAIN) == "\"name\" = 'O''Neil'"
    assert P.render(E.Not(quote), PLAIN) == "\"name\" != 'O''Neil'"
    assert P.render(E.Not(E.lt(NAME, E.Lit("a"))), PLAIN) == "NOT (\"name\" < 'a')"
    assert P.render(E.eq(TS, lit(1)), PLAIN) is None
    assert P.render(E.ge(E.Field("other", V.MILLIS), lit(1.5)), PLAIN) == "\"other\" >= '1500'"
    assert P.render(E.And(quote, E.eq(AGE, E.Lit(5))), PLAIN) == "\"name\" = 'O''Neil'"
    assert P.render(E.Not(E.And(quote, E.eq(AGE, E.Lit(5)))), PLAIN) is None
    assert P.render(E.Or(quote, E.eq(AGE, E.Lit(5))), PLAIN) is None
    assert P.render(E.Or(quote, ALEX), PLAIN) == "(\"name\" = 'O''Neil' OR \"name\" = 'Alex')"
    assert P.render_all([quote, E.eq(AGE, E.Lit(5)), ALEX], PLAIN) == "\"name\" = 'O''Neil' AND \"name\" = 'Alex'"


def test_pushable_agg():
    assert P.pushable_agg(E.Aggregate(E.AggregateOp.COUNT_STAR), PLAIN).name == "COUNT(*)"
    assert P.pushable_agg(E.Aggregate(E.AggregateOp.MIN, TS), PLAIN).name == "MIN(timestamp)"
    assert P.pushable_agg(E.Aggregate(E.AggregateOp.MAX, AGE), PLAIN) is None
    assert P.pushable_agg(E.Aggregate(E.AggregateOp.COUNT, TS), PLAIN) is None


def test_simplify():
    a, b = E.Field("a", V.INT32), E.Field("b", V.INT32)
    sure = E.Field("c", V.INT32, nullable=False)
    assert E.Not(E.eq(a, b)).simplify() == E.ne(a, b) and E.Not(E.Not(E.lt(a, b))).simplify() == E.lt(a, b)
    assert E.Not(E.lt(a, b)).simplify() == E.Not(E.lt(a, b))
    assert E.And(E.TRUE, E.lt(a, b)).simplify() == E.lt(a, b) and E.And(E.lt(a, b), E.FALSE).simplify() == E.FALSE
    assert E.Or(E.lt(a, b), E.lt(a, b)).simplify() == E.lt(a, b) and E.Or(E.FALSE, E.TRUE).simplify() == E.TRUE
    assert E.eq(sure, sure).simplify() == E.TRUE and E.ne(sure, sure).simplify() == E.FALSE
    assert E.eq(a, a).simplify() == E.eq(a, a) and E.eq(a, b).simplify() == E.eq(a, b)
    assert E.eq(E.Lit(1, V.INT32), E.Lit(1, V.INT64)).simplify() == E.TRUE
    assert E.eq(E.Lit(None, V.INT32), E.Lit(1)).simplify() == E.UNKNOWN
    assert E.IsNull(E.Lit(None, V.INT32)).simplify() == E.TRUE and E.IsNull(E.Lit(1)).simplify() == E.FALSE
    some = E.ArrayLit((1, 2), V.Array(V.INT32))
    assert E.In(a, E.ArrayLit((), V.Array(V.INT32))).simplify() == E.FALSE and E.In(a, some).simplify() == E.In(a, some)
    assert E.In(E.Lit(2), some).simplify() == E.TRUE and E.In(E.Lit(3), some).simplify() == E.FALSE
    assert E.In(E.Lit(3), E.ArrayLit((1, None), V.Array(V.INT32, True))).simplify() == E.UNKNOWN
    with pytest.raises(ValueError):
        E.ArrayLit((1, None), V.Array(V.INT32))
    assert {E.Op.by_symbol(o.value) for o in E.Op} == set(E.Op) and all(o.negated.negated is o for o in E.Op)


# Random trees: a file that holds a match is never skipped, and the rule on columns is the rule in Python.
_seconds = st.integers(-2, 8)
_leaf = st.one_of(
    st.builds(lambda op, t, swap: E.Compare(op.flipped, lit(t), TS) if swap else E.Compare(op, TS, lit(t)), st.sampled_from(list(E.Op)), _seconds, st.booleans()),
    st.builds(lambda op, n: E.Compare(op, NAME, E.Lit(n)), st.sampled_from([E.Op.EQ, E.Op.NE, E.Op.LT]), st.sampled_from(["Alex", "Bob", "Cy"])),
    st.builds(lambda op, n: E.Compare(op, AGE, E.Lit(n)), st.sampled_from(list(E.Op)), st.integers(0, 3)),
    st.builds(lambda ts: E.In(TS, E.ArrayLit(tuple(map(at, ts)), V.Array(V.MILLIS))), st.lists(_seconds, max_size=3)),
    st.builds(lambda ns: E.In(NAME, E.ArrayLit(tuple(ns), V.Array(V.STRING))), st.lists(st.sampled_from(["Alex", "Bob"]), max_size=2)),
    st.sampled_from([E.TRUE, E.FALSE, E.UNKNOWN, E.IsNull(AGE), E.eq(TS, E.Lit(None, V.MILLIS))]),
)
_tree = st.recursive(_leaf, lambda c: st.one_of(st.builds(E.And, c, c), st.builds(E.Or, c, c), st.builds(E.Not, c)), max_leaves=6)


def value(e: E.Expr, row: dict):
    """SQL's three values."""
    if isinstance(e, E.Field):
        return row[e.name]
    if isinstance(e, E.Lit):
        return e.value
    if isinstance(e, E.Not):
        v = value(e.child, row)
        return None if v is None else not v
    if isinstance(e, E.And | E.Or):
        vs = [value(c, row) for c in e.children]
        decisive = isinstance(e, E.Or)
        return decisive if decisive in vs else None if None in vs else not decisive
    if isinstance(e, E.IsNull):
        return value(e.child, row) is None
    if isinstance(e, E.In):
        v = value(e.child, row)
        return False if not e.values.values else None if v is None else v in e.values.values or (None if None in e.values.values else False)
    a, b = value(e.left, row), value(e.right, row)
    return None if a is None or b is None else E._HOLDS[e.op](a, b)


@settings(max_examples=400, deadline=None)
@given(_tree, st.integers(0, 1_000_000))
def test_never_skips_a_match(tree, seed):
    rng = random.Random(seed)
    name = rng.choice(["Alex", "Bob", "Cy"])
    rows = [{"timestamp": at(rng.randint(0, 6)), "name": name, "age": rng.choice([None, 0, 1, 2])} for _ in range(rng.randint(1, 4))]
    times = [r["timestamp"] for r in rows]
    part = P.Part(min(times), max(times), wyhash_hex(name))
    matches = any(value(tree, r) is True for r in rows)
    assert [value(tree, r) for r in rows] == [value(tree.simplify(), r) for r in rows]
    for rule in (tree, tree.simplify(), P.prunable(tree, SHARDED) or E.TRUE):
        assert P.include(rule, part, SHARDED) or not matches
    low, high, hashes = P.bounds(tree, SHARDED)
    outside = low is not None and part.max_ts < low or high is not None and part.min_ts > high or hashes is not None and part.shard_key not in hashes
    assert not (outside and matches)


CATALOG_CASES = [((30, 330), None, 10), ((0, 360), None, 10), ((61, 269), None, 8)]


@pytest.fixture(scope="module")
def catalogs(spark):
    def made(files):
        rows = [(p.path, p.min_ts, p.max_ts, p.rows, 1, p.shard_key, None) for p in files]
        return spark.createDataFrame(rows, parts.CATALOG)

    return made(TEN), made(TWENTY)


def test_catalog_query(catalogs):
    ten, twenty = catalogs
    both = [wyhash_hex("Alex"), wyhash_hex("Bob")]
    for (low, high), hashes, n in CATALOG_CASES:
        assert parts.select_parts(ten, at(low), at(high), hashes).count() == n
    assert parts.select_parts(twenty, shard_hashes=both[:1]).count() == 10
    assert parts.select_parts(twenty).count() == 20
    assert parts.select_parts(twenty, earliest=at(210), shard_hashes=both).count() == 10
    assert parts.select_parts(twenty, latest=at(195), shard_hashes=both).count() == 14
    assert parts.select_parts(twenty, at(90), at(120), both).count() == 8
    with pytest.raises(ValueError):
        parts.select_parts(ten, at(2), at(1))


def test_columns_agree_with_python(catalogs):
    _, twenty = catalogs
    rng = random.Random(7)

    def tree(depth: int) -> E.Expr:
        if depth and rng.random() < 0.7:
            kind = rng.choice([E.And, E.Or, E.Not])
            return kind(tree(depth - 1)) if kind is E.Not else kind(tree(depth - 1), tree(depth - 1))
        op = rng.choice(list(E.Op))
        return rng.choice([E.Compare(op, TS, lit(rng.randint(0, 400))), E.Compare(op, NAME, E.Lit(rng.choice(["Alex", "Bob"]))), E.eq(AGE, E.Lit(3)), E.In(TS, TIMES), E.UNKNOWN])

    trees = [tree(3) for _ in range(25)]
    flags = twenty.select("path", *[P.include_column(t, SHARDED).alias(f"c{n}") for n, t in enumerate(trees)]).collect()
    of = {p.path: p for p in TWENTY}
    assert all(r[f"c{n}"] == P.include(t, of[r.path], SHARDED) for r in flags for n, t in enumerate(trees))
