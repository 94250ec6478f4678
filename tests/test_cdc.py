"""Change application on small literal feeds whose results are known."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.operators.cdc import apply_changes

D = dt.date


def day(text):
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def feed(spark, data, schema):
    return spark.createDataFrame(data, schema)


CHUNKS = [None, 2]


@pytest.fixture
def moves(spark):
    return feed(
        spark,
        [
            (42, "US", "Portland", day("2024-01-01")),
            (42, "CA", "Portland", day("2024-06-15")),
            (42, "GB", "Portland", day("2025-03-01")),
            (42, "GB", "Seattle", day("2025-04-01")),
        ],
        "id long, country string, city string, updated_at date",
    )


@pytest.mark.parametrize("chunk", CHUNKS)
def test_every_change_opens_a_version(moves, chunk):
    out = apply_changes(moves, "id", "updated_at", 2, chunk_rows=chunk)
    assert out.count() == 4
    assert out.columns == ["id", "country", "city", "updated_at", "__START_AT", "__END_AT"]
    assert out.schema["__END_AT"].dataType == moves.schema["updated_at"].dataType


@pytest.mark.parametrize("chunk", CHUNKS)
def test_untracked_change_updates_in_place(moves, chunk):
    out = apply_changes(
        moves, "id", "updated_at", 2, track_history_except=["city", "updated_at"], chunk_rows=chunk
    )
    assert rows(out, "country", "city", "__START_AT", "__END_AT") == [
        ("CA", "Portland", day("2024-06-15"), day("2025-03-01")),
        ("GB", "Seattle", day("2025-03-01"), None),
        ("US", "Portland", day("2024-01-01"), day("2024-06-15")),
    ]


def test_sequence_column_left_out_tracks_values_only(moves):
    out = apply_changes(
        moves, "id", "updated_at", 2, except_columns=["updated_at"], track_history_except=["city"]
    )
    assert out.count() == 3
    assert "updated_at" not in out.columns


@pytest.fixture
def deletes(spark):
    return feed(
        spark,
        [
            (42, "US", day("2024-01-01"), "INSERT"),
            (85, "CA", day("2024-03-01"), "INSERT"),
            (42, "US", day("2024-06-15"), "DELETE"),
        ],
        "id long, country string, updated_at date, operation string",
    )


OPTIONS = {"apply_as_delete": "operation = 'DELETE'", "except_columns": ["operation"]}


def test_delete_type1_removes(deletes):
    out = apply_changes(deletes, "id", "updated_at", **OPTIONS)
    assert rows(out, "id", "country") == [(85, "CA")]
    assert out.columns == ["id", "country", "updated_at"]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_delete_type2_closes(deletes, chunk):
    out = apply_changes(deletes, "id", "updated_at", 2, chunk_rows=chunk, **OPTIONS)
    assert rows(out, "id", "__START_AT", "__END_AT") == [
        (42, day("2024-01-01"), day("2024-06-15")),
        (85, day("2024-03-01"), None),
    ]


def test_without_delete_clause_deletes_are_upserts(deletes):
    assert apply_changes(deletes, "id", "updated_at").count() == 2


def test_default_is_type1(deletes):
    assert "__START_AT" not in apply_changes(deletes, "id", "updated_at").columns


@pytest.fixture
def customer_1231(spark):
    events = [
        ("2025-07-19", "Kansas City", "bronze", "a@x", "1", "old"),
        ("2026-01-10", "Kansas City", "silver", "b@x", "1", "old"),
        ("2026-01-15", "Kansas City", "silver", "c@x", "1", "old"),
        ("2026-02-01", "Nashville", "gold", "c@x", "1", "old"),
        ("2026-02-10", "Nashville", "gold", "c@x", "2", "old"),
        ("2026-02-20", "Nashville", "gold", "d@x", "2", "old"),
        ("2026-03-05", "Kansas City", "platinum", "d@x", "2", "old"),
        ("2026-01-20", "Kansas City", "silver", "c@x", "1", "new"),
    ]
    return feed(
        spark,
        [(1231, day(s), *rest) for s, *rest in events],
        "id long, updated_at date, city string, tier string, email string, phone string, address string",
    )


@pytest.mark.parametrize("chunk", CHUNKS)
def test_late_event_lands_in_the_timeline(customer_1231, chunk):
    assert apply_changes(customer_1231, "id", "updated_at").count() == 1
    plain = apply_changes(customer_1231, "id", "updated_at", 2, chunk_rows=chunk)
    assert plain.count() == 8
    tracked = apply_changes(
        customer_1231, "id", "updated_at", 2, track_history=["city", "tier"], chunk_rows=chunk
    )
    assert rows(tracked, "__START_AT", "__END_AT", "city", "tier", "email", "address") == [
        (day("2025-07-19"), day("2026-01-10"), "Kansas City", "bronze", "a@x", "old"),
        (day("2026-01-10"), day("2026-02-01"), "Kansas City", "silver", "c@x", "new"),
        (day("2026-02-01"), day("2026-03-05"), "Nashville", "gold", "d@x", "old"),
        (day("2026-03-05"), None, "Kansas City", "platinum", "d@x", "old"),
    ]


SIMPLE = "id long, v int, s int, op string"
DEL = {"apply_as_delete": "op = 'D'", "except_columns": ["op"]}


def test_duplicates_collapse(spark):
    f = feed(spark, [(1, 10, 1, "I"), (1, 10, 1, "I"), (1, 11, 2, "U"), (1, 11, 2, "U")], SIMPLE)
    assert apply_changes(f, "id", "s", 2, **DEL).count() == 2
    assert rows(apply_changes(f, "id", "s", **DEL), "v", "s") == [(11, 2)]


def test_equal_sequences_settle_alike_on_any_order(spark):
    data = [(1, 10, 1, "I"), (1, 11, 1, "U"), (1, 12, 1, "U")]
    once = rows(apply_changes(feed(spark, data, SIMPLE), "id", "s", **DEL), "v")
    again = rows(apply_changes(feed(spark, data[::-1], SIMPLE), "id", "s", **DEL), "v")
    two = rows(apply_changes(feed(spark, data, SIMPLE), "id", "s", 2, **DEL), "v")
    assert once == again == two


@pytest.mark.parametrize("chunk", CHUNKS)
def test_reinsert_after_delete_leaves_a_gap(spark, chunk):
    f = feed(
        spark, [(1, 10, 1, "I"), (1, 10, 3, "D"), (1, 10, 7, "I"), (1, 10, 8, "U")], SIMPLE
    )
    out = apply_changes(f, "id", "s", 2, track_history=["v"], chunk_rows=chunk, **DEL)
    assert rows(out, "__START_AT", "__END_AT") == [(1, 3), (7, None)]


def test_delete_before_insert_in_sequence(spark):
    f = feed(spark, [(1, 0, 1, "D"), (1, 5, 2, "I")], SIMPLE)
    assert rows(apply_changes(f, "id", "s", **DEL), "v") == [(5,)]
    assert rows(apply_changes(f, "id", "s", 2, **DEL), "__START_AT", "__END_AT") == [(2, None)]


def test_delete_of_unknown_key_shows_nothing(spark):
    f = feed(spark, [(1, 0, 1, "D")], SIMPLE)
    assert apply_changes(f, "id", "s", **DEL).count() == 0
    assert apply_changes(f, "id", "s", 2, **DEL).count() == 0


@pytest.mark.parametrize("scd_type", [1, 2])
def test_null_sequence_fails(spark, scd_type):
    f = feed(spark, [(1, 10, None, "I"), (2, 10, 1, "I")], SIMPLE)
    with pytest.raises(Exception, match="NULL sequence"):
        apply_changes(f, "id", "s", scd_type, **DEL).collect()


PARTIAL = "id long, a int, b int, s int, op string"


@pytest.mark.parametrize("chunk", CHUNKS)
def test_ignore_null_updates(spark, chunk):
    f = feed(
        spark,
        [
            (1, 1, None, 1, "I"),
            (1, None, 2, 2, "U"),
            (1, None, None, 3, "U"),
            (2, 7, 8, 1, "I"),
            (2, None, None, 2, "D"),
            (2, None, 9, 3, "I"),
        ],
        PARTIAL,
    )
    current = apply_changes(f, "id", "s", ignore_null_updates=True, **DEL)
    assert rows(current, "id", "a", "b", "s") == [(1, 1, 2, 3), (2, None, 9, 3)]
    history = apply_changes(f, "id", "s", 2, ignore_null_updates=True, chunk_rows=chunk, **DEL)
    assert rows(history, "id", "a", "b", "__START_AT") == [
        (1, 1, 2, 2),
        (1, 1, 2, 3),
        (1, 1, None, 1),
        (2, 7, 8, 1),
        (2, None, 9, 3),
    ]


def test_composite_key_and_struct_sequence(spark):
    f = feed(
        spark,
        [(1, "x", 10, 1, 5), (1, "y", 20, 1, 1), (1, "x", 11, 1, 6), (1, "x", 12, 0, 9)],
        "id long, part string, v int, day int, event int",
    )
    out = apply_changes(f, ["id", "part"], ["day", "event"])
    assert rows(out, "part", "v") == [("x", 11), ("y", 20)]
    for chunk in CHUNKS:
        versions = apply_changes(f, ["id", "part"], ["day", "event"], 2, chunk_rows=chunk)
        assert rows(versions, "part", "v", "__START_AT") == [
            ("x", 10, (1, 5)),
            ("x", 11, (1, 6)),
            ("x", 12, (0, 9)),
            ("y", 20, (1, 1)),
        ]


def test_null_key_is_a_key(spark):
    f = feed(spark, [(None, 1, 1, "I"), (None, 2, 2, "U")], SIMPLE)
    assert rows(apply_changes(f, "id", "s", 2, **DEL), "v", "__END_AT") == [(1, 2), (2, None)]


def test_columns_list(spark):
    f = feed(spark, [(1, 1, 2, 3, "I")], PARTIAL)
    assert apply_changes(f, "id", "s", columns=["id", "b"]).columns == ["id", "b"]


@pytest.mark.parametrize(
    ("options", "message"),
    [
        ({"scd_type": 1, "track_history": ["v"]}, "type 2 only"),
        ({"scd_type": 3}, "1 or 2"),
        ({"scd_type": 2, "track_history": ["v"], "track_history_except": ["v"]}, "not both"),
        ({"columns": ["v"], "except_columns": ["s"]}, "not both"),
    ],
)
def test_invalid_specs(options, message):
    with pytest.raises(ValueError, match=message):
        cdc.ChangeSpec.of("id", "s", **options)


def test_unknown_columns_are_rejected(spark):
    f = feed(spark, [(1, 1, 1, "I")], SIMPLE)
    with pytest.raises(ValueError, match="unknown"):
        apply_changes(f, "id", "s", columns=["id", "nope"])
    with pytest.raises(ValueError, match="not in the target"):
        apply_changes(f, "id", "s", 2, track_history=["nope"])


def test_as_of_is_half_open(deletes):
    versions = apply_changes(deletes, "id", "updated_at", 2, **OPTIONS)

    def at(text):
        return rows(cdc.versions_as_of(versions, F.lit(day(text))), "id")

    assert at("2024-01-01") == [(42,)]
    assert at("2024-06-14") == [(42,), (85,)]
    assert at("2024-06-15") == [(85,)]
    assert rows(cdc.current_versions(versions), "id") == [(85,)]


@pytest.mark.parametrize("chunk", [None, 3])
def test_join_as_of_matches_a_plain_range_join(spark, chunk):
    versions = apply_changes(
        feed(
            spark,
            [(k, k * 100 + s, s, "D" if s % 7 == 5 else "U") for k in range(3) for s in range(0, 40, 2)],
            SIMPLE,
        ),
        "id", "s", 2, **DEL,
    ).drop("s").cache()
    facts = feed(
        spark,
        [(n, n % 4 if n % 11 else None, n % 45 - 2) for n in range(300)],
        "fact long, id long, at int",
    )
    got = cdc.join_as_of(facts, versions, ["id"], "at", ["v"], chunk_rows=chunk)
    expected = facts.alias("f").join(
        versions.alias("w"),
        F.expr("f.id = w.id AND __START_AT <= at AND (__END_AT > at OR __END_AT IS NULL)"),
        "left",
    ).select("f.*", "v")
    assert rows(got, "fact", "id", "at", "v") == rows(expected, "fact", "id", "at", "v")
    inner = cdc.join_as_of(facts, versions, ["id"], "at", ["v"], "inner", chunk)
    assert inner.count() == expected.filter("v IS NOT NULL").count()


def test_merge_upsert_and_erase(spark):
    target = feed(spark, [(1, 1), (2, 2)], "id long, v int")
    source = feed(spark, [(2, 20), (3, 30)], "id long, v int")
    merged = cdc.merge_upsert(target, source, ["id"])
    assert rows(merged, "id", "v") == [(1, 1), (2, 20), (3, 30)]
    gone = feed(spark, [(2,), (2,)], "id long")
    assert rows(cdc.erase_keys(merged, ["id"], gone), "id") == [(1,), (3,)]
