"""Multi-line CSV by blocks against Spark's own reader, which gives a file to one task."""

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources.csv_blocks import csv_records, read_csv_blocks
from ledgerloom.sources.readers import read_csv
from ledgerloom.sources.writers import write_csv

SHAPE = "func string, target string, n long"


@contextmanager
def blocks_of(spark, size):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def code(rng):
    parts = ["def f(a, b):\n", '    """doc, with "quotes"\n    """\n', "\n", "  return 'x'\n", '""', '"', ",", "é\U0001f600", "\r\n", "x" * 40, "\t#"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))


def schema_of(spark):
    return spark.createDataFrame([], SHAPE).schema


@pytest.mark.parametrize("size", [400, 5000])
def test_written_files_come_back(spark, tmp_path, size):
    rng = random.Random(size)
    rows = [(code(rng), rng.choice(["0", "1", None]), i) for i in range(300)]
    rows[100] = ("a record of many blocks\n" * 200, '"', 100)
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame(rows, SHAPE).repartition(2), path)
    wanted = rows_of(read_csv(spark, path, schema_of(spark)))
    with blocks_of(spark, size):
        assert rows_of(read_csv_blocks(spark, path, schema_of(spark))) == wanted
        assert spark.read.option("lineSep", "\n").text(path).select(F.spark_partition_id()).distinct().count() > 2
    assert len(wanted) == 300


@pytest.mark.parametrize("text", [
    'func,target,n\r\n"a\r\nb",1,2\r\nplain,0,3\r\n',
    'func,target,n\n\n"x ""y"" z\n\n",1,2\n\n,,\n"",0,1',
    'func,target,n\n',
    'func,target,n\n  spaces  ,1,5\n"one",1\n',
    "",
])
@pytest.mark.parametrize("size", [6, 1000])
def test_awkward_files(spark, tmp_path, text, size):
    (tmp_path / "a.csv").write_bytes(text.encode())
    (tmp_path / "b.csv").write_bytes(b'func,target,n\n"second ""file""\n",1,9\n')
    wanted = rows_of(read_csv(spark, str(tmp_path), schema_of(spark)))
    with blocks_of(spark, size):
        assert rows_of(read_csv_blocks(spark, str(tmp_path), schema_of(spark))) == wanted


def test_without_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"a\nb",1,2\nc,0,3\n')
    found = read_csv_blocks(spark, str(tmp_path), schema_of(spark), header=False)
    assert sorted(map(tuple, found.collect())) == [("a\nb", "1", 2), ("c", "0", 3)]
    assert csv_records(spark, str(tmp_path)).where("first").count() == 1
