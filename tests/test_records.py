"""CSV records over byte ranges against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from tillstar.sources import readers, records, schemas

SCHEMA = schemas.RAW_LISTINGS
HEADER = ",".join(SCHEMA.fieldNames())


@pytest.fixture()
def small_ranges(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def whole(spark, path):
    options = {"header": True, "enforceSchema": False, "multiLine": True, "escape": '"'}
    return spark.read.schema(SCHEMA).options(**options).csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("lines", [1, 3, records.LINES])
def test_records_are_those_of_whole_files(spark, tmp_path, small_ranges, seed, lines):
    draw = random.Random(seed)
    fields = [
        "", "plain", '"quoted"', '"a, b"', '"say ""x"""', '"two\nlines"', '"\n"', '""', " blank ",
        '"a ""b\n\n""c"', "é日本", '"' + "long " * 90 + '\n"', '"""\n"""',
    ]
    breaks = fields if seed % 2 else fields[:5]
    for name in range(3):
        body = [HEADER]
        for _ in range(draw.choice([0, 1, 60])):
            cells = [draw.choice(breaks) for _ in range(9)]
            cells[0], cells[3] = str(draw.randrange(99)), draw.choice(["1.5", "", "x"])
            body.append(",".join(cells))
            if draw.random() < 0.1:
                body.append("")  # an empty line is no record
        (tmp_path / f"{name}.csv").write_text("\n".join(body) + draw.choice(["", "\n"]))
    read = records.read_records(spark, str(tmp_path), SCHEMA, lines)
    assert read.dtypes == whole(spark, str(tmp_path)).dtypes
    assert rows(read) == rows(whole(spark, str(tmp_path)))


def test_lines_of_other_systems_and_short_rows(spark, tmp_path):
    text = "\ufeff" + HEADER + '\r\n1,s,"a\r\nb",2,,,,,u\r\n2,short\r\n'
    (tmp_path / "x.csv").write_bytes(text.encode())
    got = rows(readers.read_raw_listings(spark, str(tmp_path)))
    assert got == [
        ("1", "s", "a\r\nb", 2.0, None, None, None, None, "u"), ("2", "short", *[None] * 7),
    ]


def test_a_wrong_header_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,title\n1,x\n")
    with pytest.raises(Exception, match="the header is not"):
        readers.read_raw_listings(spark, str(tmp_path)).collect()


def test_empty_files_have_no_records(spark, tmp_path):
    (tmp_path / "x.csv").write_text("")
    (tmp_path / "y.csv").write_text(HEADER)
    assert readers.read_raw_listings(spark, str(tmp_path)).count() == 0


def test_one_large_file_is_many_tasks(spark, tmp_path):
    """A file of 200 MB, line breaks in its titles."""
    title = "a title with, a comma and\na line break " * 8
    with open(tmp_path / "x.csv", "w") as file:
        file.write(HEADER + "\n")
        for block in range(60):
            file.write("".join(
                f'{block * 10_000 + k},s,"{title}",1.5,USD,c,b,,u\n' for k in range(10_000)
            ))
    assert (tmp_path / "x.csv").stat().st_size > 200e6
    read = readers.read_raw_listings(spark, str(tmp_path)).where(F.length("title") == len(title))
    made = read.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n"), F.sum(F.col("id").cast("long")).alias("ids")
    ).collect()
    assert sum(r.n for r in made) == 600_000
    assert sum(r.ids for r in made) == 600_000 * 599_999 // 2
    assert len(made) > 3
    scan = records._lines(spark, str(tmp_path), records.LINES)
    assert scan.select(F.spark_partition_id()).distinct().count() > 3
