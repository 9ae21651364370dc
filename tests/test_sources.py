import json
import os

import pytest
from pyspark.sql import functions as F

from marketlens.schemas import ORDERS, PAIRS, SESSIONS
from marketlens.sources.files import (
    BAD_LINE,
    clean_sessions,
    parse_delimited,
    read_json,
    read_json_checked,
    read_sessions,
    require_non_empty,
    write_json,
)
from marketlens.sources import keyed
from marketlens.sources.keyed import bucket_of, read_keyed_table, upsert_by_key
from marketlens.sources.scratch import new_folder, remove_folder, shared_folder
from tests.conftest import ORDER_ROWS, rows_of

SESSION_ROWS = [
    ("s1", "10"), ("s1", "20"), ("s1", "20"), ("\\N", "10"), ("\\N", "20"), ("s2", "9"), ("s2", "10"),
    ("s3", "\\N"), ("s3", "30"), ("s4", "12345678"), ("s4", "87654321"), ("s5", "10"), ("s5", "20"), ("s5", "30"),
]


def write_sessions(folder, rows):
    at = {name: SESSIONS.names.index(name) for name in ("session_id", "product_id")}
    lines = []
    for session, product in rows:
        fields = [f"any {name}" for name in SESSIONS.names]
        fields[at["session_id"]], fields[at["product_id"]] = session, product
        lines.append("\t".join(fields))
    (folder / "sample.csv").write_text("\n".join(lines))
    return str(folder)


def test_json_scan_has_nulls_for_absent_fields(orders):
    assert orders.schema == ORDERS
    assert rows_of(orders) == sorted(ORDER_ROWS, key=lambda row: [(v is None, str(v)) for v in row])


def test_json_sink_leaves_out_nulls_and_replaces(spark, orders, tmp_path):
    path = str(tmp_path / "out")
    write_json(orders, path)
    write_json(orders, path, single_file=True)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    text = "".join(part.read_text() for part in (tmp_path / "out").glob("part-*"))
    assert "null" not in text
    assert rows_of(read_json(spark, path, ORDERS)) == rows_of(orders)


def test_sessions_are_read_by_position_and_cleaned(spark, tmp_path):
    raw = read_sessions(spark, write_sessions(tmp_path, SESSION_ROWS))
    assert raw.schema == SESSIONS
    assert rows_of(raw.select("session_id", "product_id")) == sorted(SESSION_ROWS)
    clean = clean_sessions(raw)
    assert clean.columns == [
        "date", "product_name", "cart_amount", "user_id", "session_id", "year", "month", "day", "hour", "product_id",
    ]
    assert clean.count() == 13
    assert clean.where(F.col("session_id").isNull()).count() == 2
    assert clean.where(F.col("session_id") == "\\N").count() == 0


def test_empty_input_is_refused(spark, tmp_path):
    raw = read_sessions(spark, write_sessions(tmp_path, [("s1", "\\N"), ("s2", "\\N")]))
    with pytest.raises(ValueError, match="empty"):
        require_non_empty(clean_sessions(raw))


def test_delimited_lines_become_typed_orders(spark):
    lines = spark.createDataFrame(
        [
            ("c1,Izmir,2021-01-01T10:00:00.000Z,o1,10.0,p1,s1,Created",),
            ("c1,Izmir,2021-01-01T10:00:00.000Z,o2,abc,p1,s1,Created",),
            ("c1,Izmir",),
        ],
        "value string",
    )
    parsed = parse_delimited(lines)
    assert [field.dataType for field in parsed.schema] == [field.dataType for field in ORDERS]
    assert [tuple(row) for row in parsed.collect()] == [
        ("c1", "Izmir", "2021-01-01T10:00:00.000Z", "o1", 10.0, "p1", "s1", "Created"),
        ("c1", "Izmir", "2021-01-01T10:00:00.000Z", "o2", None, "p1", "s1", "Created"),
        ("c1", "Izmir", None, None, None, None, None, None),
    ]


def test_separator_is_no_pattern(spark):
    lines = spark.createDataFrame([("c1|Izmir|t|o1|1.5|p1|s1|Created",)], "value string")
    assert parse_delimited(lines, sep="|").first()["price"] == 1.5


def test_upsert_replaces_adds_and_keeps(spark, tmp_path):
    path = str(tmp_path / "pairs")
    first = [("1020", "10", "20", 3), ("1030", "10", "30", 1), ("2030", "20", "30", 1)]
    assert upsert_by_key(spark.createDataFrame(first, PAIRS), path, "id") == 3
    second = [("1020", "10", "20", 7), ("4050", "40", "50", 1)]
    assert upsert_by_key(spark.createDataFrame(second, PAIRS), path, "id") == 2
    after = read_keyed_table(spark, path)
    assert after.schema == PAIRS
    merged = [second[0], first[1], first[2], second[1]]
    assert rows_of(after) == merged
    # The same upsert again gives the same table.
    assert upsert_by_key(spark.createDataFrame(second, PAIRS), path, "id", buckets=3) == 2
    assert rows_of(read_keyed_table(spark, path)) == merged


def test_upsert_takes_one_row_per_key_and_no_null_key(spark, tmp_path):
    path = str(tmp_path / "pairs")
    twice = [("1020", "10", "20", 1), ("1020", "10", "20", 1)]
    assert upsert_by_key(spark.createDataFrame(twice, PAIRS), path, "id") == 1
    with pytest.raises(Exception, match="without id"):
        upsert_by_key(spark.createDataFrame([(None, "1", "2", 1)], PAIRS), path, "id")
    assert read_keyed_table(spark, path).count() == 1


def test_upsert_without_success_markers_loses_nothing(spark, tmp_path):
    path, marks = str(tmp_path / "pairs"), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    rows = [(str(number), "1", "2", number) for number in range(50)]
    spark.conf.set(marks, "false")
    try:
        upsert_by_key(spark.createDataFrame(rows, PAIRS), path, "id")
        assert not list((tmp_path / "pairs").glob("_SUCCESS"))
        upsert_by_key(spark.createDataFrame([("7", "1", "2", 99)], PAIRS), path, "id")
    finally:
        spark.conf.unset(marks)
    assert rows_of(read_keyed_table(spark, path)) == sorted(rows[:7] + [("7", "1", "2", 99)] + rows[8:])


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = tmp_path / "pairs"
    rows = [(str(number), "1", "2", number) for number in range(50)]
    upsert_by_key(spark.createDataFrame(rows, PAIRS), str(path), "id", buckets=8)

    def files():
        return {file for file in path.rglob("*.parquet")}

    before = files()
    upsert_by_key(spark.createDataFrame([("7", "1", "2", 99)], PAIRS), str(path), "id")
    assert len({file.parent for file in before}) == 8
    assert len({file.parent for file in before - files()}) == len({file.parent for file in files() - before}) == 1


def test_keyed_sink_and_source_take_a_connector(spark, tmp_path):
    path = str(tmp_path / "store")
    pairs = spark.createDataFrame([("1020", "10", "20", 1), ("4050", "40", "50", 2)], PAIRS)
    assert upsert_by_key(pairs, path, "id", format="json") == 2
    assert read_keyed_table(spark, path, format="json").count() == 2


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_missing_keyed_table_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no keyed table"):
        read_keyed_table(spark, str(tmp_path / "nothing"))


def bucket_files(path):
    """Data files of each bucket, by its number."""
    found = {}
    for file in path.rglob("*.parquet"):
        found.setdefault(int(file.parent.name.split("=")[1]), set()).add(file)
    return found


def numbered(spark, numbers, frequency=0):
    return spark.createDataFrame([(str(number), "1", "2", frequency) for number in numbers], PAIRS)


def test_a_new_table_has_buckets_for_its_rows(spark, tmp_path):
    path = tmp_path / "pairs"
    assert upsert_by_key(numbered(spark, range(2000)), str(path), "id", buckets=2, bucket_rows=100) == 2000
    assert sorted(bucket_files(path)) == list(range(20))
    assert read_keyed_table(spark, str(path)).count() == 2000


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "pairs"
    # As many tasks read the new rows as a large table has.
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "0"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        rows = numbered(spark, range(20_000)).repartition(8)
        assert upsert_by_key(rows, str(path), "id", buckets=2, unique=True) == 20_000
    finally:
        for name in small:
            spark.conf.unset(name)
    files = bucket_files(path)
    assert sorted(files) == [0, 1] and min(map(len, files.values())) > 1
    assert read_keyed_table(spark, str(path)).select("id").distinct().count() == 20_000


def test_buckets_split_as_the_table_grows(spark, tmp_path):
    path = tmp_path / "pairs"
    known = {str(number): 0 for number in range(1000)}
    upsert_by_key(numbered(spark, range(1000)), str(path), "id", buckets=4, bucket_rows=250)
    before = bucket_files(path)
    assert sorted(before) == [0, 1, 2, 3]
    # One row over: a single bucket splits, in two; the one the row belongs to is written anew, the others stay.
    upsert_by_key(numbered(spark, [1000], 1), str(path), "id", bucket_rows=250)
    after = bucket_files(path)
    own = spark.range(1).select(bucket_of(F.lit("1000"), 4).alias("b")).first()["b"]
    assert sorted(after) == [0, 1, 2, 3, 4]
    assert all(after[number] == before[number] for number in {1, 2, 3} - {own})
    assert after[0].isdisjoint(before[0])
    known["1000"] = 1
    for step in range(2, 6):  # over several doublings, with known keys among the new ones
        numbers = range(700 * step, 700 * step + 1500)
        upsert_by_key(numbered(spark, numbers, step), str(path), "id", bucket_rows=250)
        known |= {str(number): step for number in numbers}
        table = read_keyed_table(spark, str(path)).collect()
        assert len(table) == len(known) and {row["id"]: row["frequency"] for row in table} == known
    assert len(bucket_files(path)) >= len(known) // 250


def test_an_emptied_bucket_counts_for_nothing(spark, tmp_path):
    """Few rows and many splits: buckets lose all their rows, and Spark leaves their files where they are."""
    path = str(tmp_path / "pairs")
    upsert_by_key(numbered(spark, range(12)), path, "id", buckets=2, bucket_rows=1000)
    upsert_by_key(numbered(spark, [12], 5), path, "id", bucket_rows=1)
    table = read_keyed_table(spark, path)
    assert sorted(int(row["id"]) for row in table.collect()) == list(range(13))
    upsert_by_key(numbered(spark, range(13), 7), path, "id", bucket_rows=1)
    assert [row["frequency"] for row in read_keyed_table(spark, path).collect()] == [7] * 13


def test_the_newer_row_stays(spark, tmp_path):
    path = str(tmp_path / "pairs")
    upsert_by_key(numbered(spark, ["1", "2", "3"], 5), path, "id", newer="frequency")
    mixed = numbered(spark, ["1"], 4).union(numbered(spark, ["2", "2"], 6)).union(numbered(spark, ["2", "4"], 3))
    assert upsert_by_key(mixed, path, "id", newer="frequency") == 3
    assert rows_of(read_keyed_table(spark, path).select("id", "frequency")) == [("1", 5), ("2", 6), ("3", 5), ("4", 3)]


def test_buckets_by_an_expression_of_the_key(spark, tmp_path):
    path, hundred = tmp_path / "pairs", (F.col("id").cast("long") / 100).cast("long")
    for numbers in (range(300), range(250, 400)):
        upsert_by_key(numbered(spark, numbers, numbers[0]), str(path), "id", bucket=hundred, bucket_rows=1)
    assert sorted(bucket_files(path)) == [0, 1, 2, 3]
    table = {int(row["id"]): row["frequency"] for row in read_keyed_table(spark, str(path)).collect()}
    assert table == {number: 250 if number >= 250 else 0 for number in range(400)}


def test_an_upsert_writes_its_rows_once_on_the_way(spark, tmp_path, monkeypatch):
    """The new rows to the scratch folder, the merged ones to their buckets only; a few stored rows are looked up."""
    folders, path = [], str(tmp_path / "pairs")
    written = keyed._written
    monkeypatch.setattr(keyed, "_written", lambda df, folder: folders.append(folder.rpartition("/")[2]) or written(df, folder))
    upsert_by_key(numbered(spark, range(5)), path, "id", buckets=2)
    upsert_by_key(numbered(spark, range(3, 103), 1), path, "id", unique=True)  # over ten times what is stored
    upsert_by_key(numbered(spark, range(100, 110), 2), path, "id")
    assert folders == ["incoming"] * 3
    expected = [(str(n), "1", "2", 0 if n < 3 else 1 if n < 100 else 2) for n in range(110)]
    assert rows_of(read_keyed_table(spark, path)) == sorted(expected)


def test_an_upsert_leaves_nothing_in_the_scratch_folder(spark, tmp_path):
    def scratch():
        return set(os.listdir(shared_folder(spark))) if os.path.isdir(shared_folder(spark)) else set()

    before = scratch()
    for _ in range(2):
        upsert_by_key(numbered(spark, range(10)), str(tmp_path / "pairs"), "id")
    assert scratch() == before
    with pytest.raises(ValueError, match="no scratch folder"):
        remove_folder(spark, str(tmp_path / "pairs"))


BAD = ['{"order_id": "x1", "price": "many"}', '{"order_id": "x2"', "no json", "[1, 2]"]


def test_bad_records_are_kept_apart_and_counted(spark, tmp_path):
    good = [json.dumps(dict(zip(ORDERS.names, row))) for row in ORDER_ROWS]
    lines = [*good[:5], BAD[0], "", *good[5:], *BAD[1:], "   "]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "orders.json").write_text("\n".join(lines))
    quarantine = str(tmp_path / "quarantine")
    for times in (1, 2):
        orders, n_good, n_bad = read_json_checked(spark, str(tmp_path / "in"), ORDERS, quarantine)
        assert (n_good, n_bad) == (len(ORDER_ROWS), len(BAD))
        assert orders.schema.names == ORDERS.names
        assert rows_of(orders) == sorted(ORDER_ROWS, key=lambda row: [(v is None, str(v)) for v in row])
        kept = spark.read.parquet(quarantine).collect()
        assert sorted(row[BAD_LINE] for row in kept) == sorted(BAD * times)
        assert all(row["file"].endswith("orders.json") for row in kept)


def test_checked_records_of_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "orders.json").write_text("")
    orders, n_good, n_bad = read_json_checked(spark, str(tmp_path / "in"), ORDERS, str(tmp_path / "quarantine"))
    assert (orders.count(), n_good, n_bad) == (0, 0, 0)


def test_added_columns_are_summed_once_a_load(spark, tmp_path):
    path = str(tmp_path / "sums")

    def load(number, rows):
        frame = spark.createDataFrame([(key, n, name, number) for key, n, name in rows], "id string, n long, name string, load long")
        return upsert_by_key(frame, path, "id", unique=True, newer="load", add=["n"], buckets=2)

    assert load(0, [("a", 1, "x"), ("b", 2, "x")]) == 2
    for _ in range(2):  # the second time it changes nothing
        assert load(1, [("b", 5, "y"), ("c", 3, "y")]) == 2
        assert rows_of(read_keyed_table(spark, path)) == [("a", 1, "x", 0), ("b", 7, "y", 1), ("c", 3, "y", 1)]
    with pytest.raises(ValueError, match="which load"):
        upsert_by_key(read_keyed_table(spark, path), path, "id", add=["n"])
