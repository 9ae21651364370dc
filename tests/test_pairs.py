from collections import Counter
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.operators.pairs import _blocks, pair_frequency, session_products
from marketlens.plans.pairs import product_pairs_report, save_product_pairs
from marketlens.sources.files import clean_sessions, read_sessions
from marketlens.sources.keyed import read_keyed_table
from tests.conftest import rows_of
from tests.plain_shapes import plain_pairs
from tests.test_sources import SESSION_ROWS, write_sessions

PAIR_ROWS = [("1020", "10", "20", 3), ("1030", "10", "30", 1), ("2030", "20", "30", 1)]


def brute_force(rows, max_len=7):
    counts = Counter()
    for (s, a), (t, b) in product(rows, rows):
        if s is not None and s == t and a is not None and b is not None:
            if a < b and len(a) == len(b) <= max_len:
                counts[a, b] += 1
    return sorted((a + b, a, b, n) for (a, b), n in counts.items())


def test_pairs_of_the_sample(spark, tmp_path):
    sessions = clean_sessions(read_sessions(spark, write_sessions(tmp_path, SESSION_ROWS)))
    assert rows_of(pair_frequency(sessions)) == PAIR_ROWS
    report = [tuple(row) for row in product_pairs_report(sessions).collect()]
    assert report == PAIR_ROWS


def test_saved_pairs_are_upserted(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    path = str(tmp_path / "pairs")
    first = clean_sessions(read_sessions(spark, write_sessions(tmp_path / "a", SESSION_ROWS)))
    assert save_product_pairs(first, path) == 3
    second = clean_sessions(read_sessions(spark, write_sessions(tmp_path / "b", [("s", "10"), ("s", "20"), ("s", "40")])))
    assert save_product_pairs(second, path) == 3
    assert rows_of(read_keyed_table(spark, path)) == [
        ("1020", "10", "20", 1), ("1030", "10", "30", 1), ("1040", "10", "40", 1), ("2030", "20", "30", 1),
        ("2040", "20", "40", 1),
    ]


def test_nothing_is_saved_without_input(spark, tmp_path):
    raw = read_sessions(spark, write_sessions(tmp_path, [("s1", "\\N")]))
    path = tmp_path / "pairs"
    with pytest.raises(ValueError):
        save_product_pairs(clean_sessions(raw), str(path))
    assert not path.exists()


SESSION_ID = st.sampled_from(["a", "b", "c", None])
PRODUCT_ID = st.sampled_from(["1", "2", "10", "11", "12", "20", "1234567", "1234568", "12345678", "12345679", None])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(SESSION_ID, PRODUCT_ID), max_size=40),
    block=st.sampled_from([1, 2, 3, 500]),
)
def test_blocks_do_not_change_the_result(spark, rows, block):
    sessions = spark.createDataFrame(rows, "session_id string, product_id string")
    got = pair_frequency(sessions, block=block)
    assert rows_of(got) == brute_force(rows)


def test_one_session_with_a_third_of_all_rows(spark):
    sessions = spark.sql(
        "SELECT CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 50) END AS session_id, "
        "CAST(pmod(xxhash64(id), 150) AS STRING) AS product_id FROM range(3000)"
    )
    assert rows_of(pair_frequency(sessions, block=20)) == rows_of(plain_pairs(sessions))


def test_sessions_are_read_once(spark, tmp_path):
    path = str(tmp_path / "sessions")
    spark.sql("SELECT concat('s', id % 9) AS session_id, CAST(id % 40 AS STRING) AS product_id FROM range(900)").write.parquet(path)
    pairs = pair_frequency(spark.read.parquet(path), block=5)
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") - plan.count("ReusedExchange") <= 1
    assert plan.count("FileScan") == 1


def test_report_is_sorted(spark):
    sessions = spark.sql("SELECT concat('s', id % 9) AS session_id, CAST(id % 40 AS STRING) AS product_id FROM range(900)")
    found = [(row["frequency"], row["id"]) for row in product_pairs_report(sessions).collect()]
    assert found == sorted(found, key=lambda pair: (-pair[0], pair[1]))
    assert product_pairs_report(sessions).where(F.col("frequency") <= 0).isEmpty()


def test_every_large_session_is_cut_into_blocks(spark):
    """However many there are: no join key has more rows than two blocks."""
    sessions = spark.sql("SELECT concat('s', id % 30) AS session_id, CAST(100 + id DIV 30 AS STRING) AS product_id FROM range(9000)")
    plan = pair_frequency(sessions, block=20)._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan and "broadcast" not in plan.lower()
    views = session_products(sessions)
    sizes = _blocks(views, 20).collect()
    assert len(sizes) == 30 and {row["blocks"] for row in sizes} == {15}
    dealt = views.groupBy("session_id", F.pmod(F.xxhash64("product_id"), F.lit(15))).count()
    assert dealt.agg(F.max("count")).first()[0] <= 2 * 20
