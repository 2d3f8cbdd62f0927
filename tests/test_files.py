"""Raw files: scanning, landing, structure, and the whole pipeline."""

import csv
import io
import json
import os
from functools import reduce
from operator import and_

import pytest
from conftest import ROW
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from payments_lake.operators.silver import to_silver
from payments_lake.operators.structure import (
    head_rows,
    malformed_with_row_numbers,
    profile_landed,
    row_width_histogram,
    sample_values,
    widths_of_landed,
    widths_of_scan,
)
from payments_lake.plans import pipeline
from payments_lake.schema import CRITICAL, RAW_COLUMNS, ROW_HASH, ROW_ID, SILVER_COLUMNS
from payments_lake.sources import (
    file_sizes,
    files_that_span_lines,
    land_raw,
    permissive_scan,
    raw_scan,
    read_landed,
    read_silver,
    read_table,
)
from payments_lake.sources.bridge import bridge


def write_csv(path, rows, header=RAW_COLUMNS):
    buffer = io.StringIO()
    writer = csv.writer(buffer)
    writer.writerow(header)
    writer.writerows(rows)
    with open(path, "w", encoding="utf-8-sig", newline="") as file:
        file.write(buffer.getvalue())
    return path


def cells(**changes):
    row = {**ROW, **changes}
    return ["" if row[c] is None else row[c] for c in RAW_COLUMNS]


def test_scan_reads_bom_quotes_and_line_breaks(spark, scratch):
    path = write_csv(
        f"{scratch}/a.csv",
        [cells(), cells(**{"Contract Title": 'a "b", c\nd'}), cells(Department="N/A"), cells()[:-2]],
    )
    assert list(files_that_span_lines(spark, path).values()) == [True]
    rows = raw_scan(spark, path).collect()
    assert rows[0]["Fiscal Year"] == "2019"
    assert rows[1]["Contract Title"] == 'a "b", c\nd'
    assert rows[2]["Department"] is None
    assert rows[3]["Purchasing Authority Description"] is None
    assert rows[0]["Non-Profit Indicator"] is None
    plain = write_csv(f"{scratch}/b.csv", [cells(**{"Contract Title": 'a "b", c'})])
    assert list(files_that_span_lines(spark, plain).values()) == [False]
    assert raw_scan(spark, plain).first()["Contract Title"] == 'a "b", c'


def test_scan_rejects_other_headers_long_records_and_missing_files(spark, scratch):
    other = write_csv(f"{scratch}/a.csv", [cells()], ["Year", *RAW_COLUMNS[1:]])
    with pytest.raises(Exception, match="CSV header does not conform"):
        raw_scan(spark, other).collect()
    long = write_csv(f"{scratch}/b.csv", [cells(), [*cells(), "surplus"]])
    with pytest.raises(Exception, match="too many fields"):
        raw_scan(spark, long).collect()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        raw_scan(spark, f"{scratch}/none.csv")


@pytest.mark.parametrize("multiline", [True, False])
def test_structure_of_malformed_file(spark, scratch, multiline):
    rows = [cells() for _ in range(30)]
    rows[4] = cells()[:-3]
    rows[20] = [*cells(**{"Contract Title": "a, b"}), "x", "y"]
    path = write_csv(f"{scratch}/a.csv", rows)
    scan = permissive_scan(spark, path, multiline)
    widths = widths_of_scan(scan)
    assert [tuple(r) for r in row_width_histogram(widths).collect()] == [(33, 28), (30, 1), (35, 1)]
    bad = sorted(malformed_with_row_numbers(widths).collect())
    assert [(r.row_number, r.expected_columns, r.actual_columns) for r in bad] == [
        (6, 33, 30),
        (22, 33, 35),
    ]
    assert bad[0].preview.startswith("2019 | NO | 2 | Public Works")
    with pytest.raises(ValueError, match="too many fields"):
        land_raw(spark, path, f"{scratch}/landed", multiline)
    landed = read_landed(spark, f"{scratch}/landed")  # the profile can still name the record
    profile = profile_landed(landed, file_sizes(spark, path))
    assert "FileScan csv" not in profile._jdf.queryExecution().executedPlan().toString()
    report = {(r.column_name, r.metric): r.value for r in profile.collect()}
    assert report["", "total_rows"] == "30"
    assert report["", "malformed_rows"] == "2"
    assert report["6", "bad_row"].startswith("33|30|2019")
    assert any(metric == "file_mb" for _, metric in report)


def test_landing_numbers_rows_and_head_is_exact(spark, scratch):
    rows = [cells(**{"Purchase Order": str(i), "Department": "NA" if i < 3 else f"D{i}"}) for i in range(400)]
    path = write_csv(f"{scratch}/a.csv", rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        landed = land_raw(spark, path, f"{scratch}/landed")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert landed.select(f"{ROW_ID}.block").distinct().count() > 1
    in_order = [r[0] for r in landed.orderBy(ROW_ID).select("Purchase Order").collect()]
    assert in_order == [str(i) for i in range(400)]
    for n in (1, 7, 150, 400, 1000):
        head = {int(r[0]) for r in head_rows(landed, n).select("Purchase Order").collect()}
        assert head == set(range(min(n, 400)))
    odd = landed.filter(F.col("Purchase Order").cast("int") % 2 == 1)
    assert {int(r[0]) for r in head_rows(odd, 50).select("Purchase Order").collect()} == set(range(1, 101, 2))
    samples = sample_values(landed).filter("column_name = 'Department'").orderBy("position")
    assert [r.value for r in samples.collect()] == ["D3", "D4", "D5", "D6", "D7"]
    assert landed.select(ROW_HASH).distinct().count() == 400


def test_rows_of_several_files_keep_file_order(spark, scratch):
    """The largest file isn't the first, each has several blocks, one has a line break."""
    os.mkdir(f"{scratch}/raw")
    for name, n in (("a", 130), ("b", 600), ("c", 90), ("d", 5)):
        rows = [cells(**{"Purchase Order": f"{name}{i}", "Vouchers Paid": "7"}) for i in range(n)]
        if name == "d":
            rows[1] = cells(**{"Purchase Order": "d1", "Contract Title": "x\ny"})
        if name in "bc":
            rows[40] = cells(**{"Purchase Order": f"{name}40"})[:-3]
        write_csv(f"{scratch}/raw/{name}.csv", rows)
    expected = []
    for name in "abcd":
        with open(f"{scratch}/raw/{name}.csv", encoding="utf-8-sig", newline="") as file:
            expected += [row[RAW_COLUMNS.index("Purchase Order")] for row in list(csv.reader(file))[1:]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        landed = land_raw(spark, f"{scratch}/raw", f"{scratch}/landed")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    blocks = landed.groupBy(f"{ROW_ID}.file").agg(F.count_distinct(f"{ROW_ID}.block").alias("n"))
    assert sorted(r.n > 1 for r in blocks.collect()) == [False, True, True, True]
    assert [r[0] for r in landed.orderBy(ROW_ID).select("Purchase Order").collect()] == expected
    head = head_rows(landed, 140).select("Purchase Order").collect()
    assert {r[0] for r in head} == set(expected[:140])
    bad = malformed_with_row_numbers(widths_of_landed(landed)).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.row_number) for r in bad) == [("b.csv", 42), ("c.csv", 42)]
    samples = sample_values(landed).filter("column_name = 'Purchase Order'").orderBy("position")
    assert [r.value for r in samples.collect()] == expected[:5]


@pytest.fixture(scope="module")
def finished(spark, sf_dir, tmp_path_factory):
    """A pipeline run over the ledger's sound rows, each once, written as CSV files."""
    root = str(tmp_path_factory.mktemp("pipeline"))
    raw = f"{root}/raw"
    sound = [F.col(name).isNotNull() & (F.col(name) != "N/A") for name in CRITICAL]
    ledger = bridge(spark, sf_dir).select(*RAW_COLUMNS).filter(F.col("Fiscal Year").rlike("^\\d{4}$"))
    ledger.filter(reduce(and_, sound)).dropDuplicates().coalesce(2).write.option("header", True).option("escape", '"').csv(raw)
    return root, raw, pipeline.run(spark, raw, f"{root}/out")


def test_pipeline_summary(spark, finished):
    root, _, summary = finished
    assert summary["status"] == "success"
    assert summary["source"]["row_count"] == summary["silver"]["row_count"] > 0
    assert summary["gold"]["mart_count"] == 5
    assert all(m["available"] and m["row_count"] > 0 for m in summary["gold"]["marts"])
    assert summary["validation"]["silver"]["status"] == "PASS"
    assert summary["validation"]["gold"]["passed_mart_count"] == 5
    written = spark.read.text(f"{root}/out/summary").first()[0]
    assert json.loads(written)["gold"] == summary["gold"]


def test_pipeline_silver_equals_direct_transform(spark, finished):
    root, _, _ = finished
    silver = read_silver(spark, f"{root}/out/silver")
    assert silver.columns == SILVER_COLUMNS
    landed = read_table(spark, f"{root}/out/landed")
    direct = to_silver(landed)
    assert silver.exceptAll(direct).isEmpty() and direct.exceptAll(silver).isEmpty()
    assert any(name.startswith("fiscal_year=") for name in os.listdir(f"{root}/out/silver"))


def test_profiles_and_samples_are_written(spark, finished):
    root, raw, summary = finished
    pipeline.profile(spark, raw, f"{root}/out")
    readiness = {r.check: r.status for r in read_table(spark, f"{root}/out/reports/readiness").collect()}
    assert len(readiness) == 9
    assert readiness["schema"] == readiness["file_structure"] == "PASS"
    assert readiness["overall"] == "READY_WITH_WARNINGS"
    for name in ("file_structure", "schema", "duplicates", "business_rules", "silver_output"):
        report = read_table(spark, f"{root}/out/reports/{name}")
        assert report.columns == ["check", "column_name", "metric", "value"]
        assert not report.isEmpty()
    pipeline.create_samples(spark, f"{root}/out", per_year=20)
    sample = spark.read.csv(f"{root}/out/samples/by_fiscal_year", header=True)
    assert sample.columns == RAW_COLUMNS
    assert {r["count"] for r in sample.groupBy("Fiscal Year").count().collect()} == {20}
    stream = read_table(spark, f"{root}/out/samples/stream_silver")
    assert stream.count() == min(100_000, summary["source"]["row_count"])


def test_missing_mart_fails_validation(spark, finished, scratch):
    checked = pipeline.check_gold(spark, pipeline.Layout(scratch))
    assert checked["status"] == "FAIL" and checked["failed_mart_count"] == 5
    assert {m["status"] for m in checked["marts"]} == {"FAIL: file does not exist"}


def test_silver_transform_works_on_a_stream(spark, finished):
    root, _, summary = finished
    landed = read_table(spark, f"{root}/out/landed")
    stream = spark.readStream.schema(landed.schema).parquet(f"{root}/out/landed")
    query = (
        to_silver(stream)
        .writeStream.format("memory")
        .queryName("silver_stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert spark.table("silver_stream").count() == summary["silver"]["row_count"]
