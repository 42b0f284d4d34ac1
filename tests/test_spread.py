"""Numbering and bounded selection must not depend on how rows are spread, and must survive hot groups."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.operators.recipients import pack_recipients
from ledgerloom.operators.reports import error_texts
from ledgerloom.operators.spread import first_rows, number_rows


def frame(spark, n=3000, seed=1):
    """Half of all rows in one group, one group NULL, some groups of one row."""
    rng = random.Random(seed)
    keys = lambda k: "hot" if k % 2 else None if k % 9 == 0 else f"g{rng.randrange(300)}"
    rows = [(keys(k), k) for k in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, v int").repartition(7)


def test_numbers_within_groups(spark):
    rows, df = frame(spark)
    got = {(r.g, r.v): r.n for r in number_rows(df, ["v"], "n", within=["g"]).collect()}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    expected = {(g, v): k for g, vs in groups.items() for k, v in enumerate(sorted(vs), 1)}
    assert got == expected


def test_hot_group_is_cut_over_slices(spark):
    _, df = frame(spark, 20000)
    out = number_rows(df, ["v"], "n", within=["g"]).where("g = 'hot'")
    numbers = sorted(r.n for r in out.collect())
    assert numbers == list(range(1, len(numbers) + 1))


def test_numbers_over_everything_continue_at_start(spark):
    rows, df = frame(spark)
    got = [(r.v, r.n) for r in number_rows(df, ["v"], "n", start=501).collect()]
    assert sorted(got) == [(v, 501 + v) for v in range(len(rows))]


def test_first_rows_in_two_levels(spark):
    rows, df = frame(spark)
    for salts in (1, 3, 64):
        got = {}
        for r in first_rows(df, ["g"], ["v"], 5, salts).collect():
            got.setdefault(r.g, []).append(r.v)
        groups = {}
        for g, v in rows:
            groups.setdefault(g, []).append(v)
        assert {g: sorted(v) for g, v in got.items()} == {g: sorted(v)[:5] for g, v in groups.items()}


def pack_by_hand(addresses, max_length, max_batches):
    batches, placed = [""] * max_batches, 0
    for a in sorted(set(addresses)):
        for n, b in enumerate(batches):
            if len(b) < max_length:
                batches[n], placed = b + " " + a, placed + 1
                break
    return [b.strip() for b in batches if b], len(set(addresses)) - placed


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text(alphabet="abcxyz@.", min_size=1, max_size=12), min_size=1, max_size=60),
    st.integers(3, 25),
    st.integers(1, 4),
)
def test_packing_equals_the_sequential_rule(spark, addresses, max_length, max_batches):
    df = spark.createDataFrame([("g", a) for a in addresses], "g string, a string")
    rows = pack_recipients(df, ["g"], "a", max_length, max_batches).orderBy("batch_no").collect()
    expected, dropped = pack_by_hand(addresses, max_length, max_batches)
    assert [r.recipients for r in rows] == expected
    assert {r.dropped_count for r in rows} == {dropped}


def test_packing_nothing_gives_nothing(spark):
    df = spark.createDataFrame([], "g string, a string")
    assert pack_recipients(df, ["g"], "a").count() == 0
    assert pack_recipients(spark.createDataFrame([("g", None), ("g", "")], "g string, a string"), ["g"], "a").count() == 0


def test_error_text_of_a_huge_log_is_the_capped_prefix(spark):
    rows = [(1, f"p{k % 7}" if k % 5 else None, f"m{k}\r\nx", "Validation") for k in range(5000)]
    rows += [(2, None, None, None), (3, "a", "long " * 60, "Unexpected Error 7"), (3, "a", "long " * 60, "Unexpected Error 7")]
    df = spark.createDataFrame(rows, "transaction_id int, phase string, error_message string, error_type string")
    got = {r.transaction_id: (r._texts, r._entries) for r in error_texts(df).collect()}
    ordered = sorted(rows[:5000], key=lambda r: (r[1] is not None, r[1] or "", r[2]))
    text = "####".join(f"{p or ''} - {m}".replace("\r", "").replace("\n", "") for _, p, m, _ in ordered)
    assert got[1] == (text[:4000], 5000)
    assert got[2] == (" - ", 1)
    assert got[3] == ("a - Unexpected Error - Contact tech support", 1)
