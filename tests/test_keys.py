import pytest
from pyspark.sql import functions as F

from fleetmart.operators.keys import assign_keys, number_delivered, number_rows


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_ids_are_dense_and_in_order(spark, parts):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("at")).repartition(parts)
    got = {r["at"]: r["key"] for r in assign_keys(df, "key", ["at"], base=10).collect()}
    assert got == {n: n + 11 for n in range(5_000)}


def test_numbering_is_stable_and_reports_the_last(spark):
    df = spark.range(100).withColumnRenamed("id", "at").repartition(5)
    numbered, last = number_rows(df, "key", ["at"], base=3)
    assert last == 103
    assert numbered.collect() == numbered.collect()


def test_nothing_to_number(spark):
    numbered, last = number_rows(spark.range(0).withColumnRenamed("id", "at"), "key", ["at"], base=3)
    assert (numbered.count(), last) == (0, 3)


@pytest.mark.parametrize("bits", [2, 20])
def test_delivered_rows_are_numbered_in_file_order(spark, bits):
    """Two files of two splits; row ids rise within a split but not over the file."""
    rows, expected = [], []
    for file in ("a", "b"):
        for block, start in ((0, 5000), (128, 100)):
            for n in range(40):
                rows.append((file, block, start + 3 * n))
                expected.append((file, block, start + 3 * n))
    df = spark.createDataFrame(rows, "_file string, _block bigint, _row bigint").repartition(5)
    numbered, last = number_delivered(df, "key", base=7, chunk_bits=bits)
    got = sorted((r["key"], (r["_file"], r["_block"], r["_row"])) for r in numbered.collect())
    assert got == [(n + 8, at) for n, at in enumerate(expected)]
    assert last == 7 + len(expected)


def test_only_chunks_with_gaps_are_sorted(spark):
    """A file without gaps takes its ids from the positions; of one with a gap only that chunk is ranked."""
    whole = [("a", 0, n) for n in range(1, 20)]
    gapped = [("b", 64, n) for n in range(100, 120) if n != 105]
    for rows, sorts in ((whole, False), (whole + gapped, True)):
        df = spark.createDataFrame(rows, "_file string, _block bigint, _row bigint").repartition(3)
        numbered, last = number_delivered(df, "key", base=2, chunk_bits=3)
        assert ("Window" in numbered._jdf.queryExecution().optimizedPlan().toString()) == sorts
        assert sorted((r["key"], r["_row"]) for r in numbered.collect()) == [(n, at[2]) for n, at in enumerate(rows, 3)]
        assert last == 2 + len(rows)
