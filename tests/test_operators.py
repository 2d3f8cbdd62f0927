"""Operators against small hand-made ledgers and plain Python counts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from payments_lake.operators import dimensions, duplicates, gold, missing, rules, structure
from payments_lake.operators import time as times
from payments_lake.operators import report, types, validation
from payments_lake.operators.sampling import simple_sample, stratified_sample
from payments_lake.operators.silver import to_silver
from payments_lake.plans.readiness import readiness_from_reports, readiness_summary
from payments_lake.schema import (
    BUSINESS_KEY,
    CRITICAL,
    DIMENSIONS,
    RAW_COLUMNS,
    RAW_TO_SILVER,
    ROW_HASH,
    ROW_ID,
    SILVER_COLUMNS,
    SILVER_SCHEMA,
    WARNING,
)
from payments_lake.sources import raw_table, read_silver, write_silver

SUPPLIER = "Supplier & Other Non-Supplier Payees"


def numbered(frame):
    return frame.coalesce(1).withColumn(ROW_ID, F.monotonically_increasing_id())


def test_schema_constants():
    assert len(RAW_COLUMNS) == 33 and len(SILVER_COLUMNS) == 49
    assert len(set(RAW_TO_SILVER.values())) == 33
    for group in (CRITICAL, WARNING, DIMENSIONS, BUSINESS_KEY):
        assert set(group) <= set(RAW_COLUMNS)


def test_silver_types_flags_and_fills(ledger):
    raw = ledger(
        {},
        {"Department": None, "Purchase Order Date": None, "Vouchers Paid": "(1,000,000.00)"},
        {"Vouchers Paid": "$1,000,000,001", "Non-Profit Indicator": " x ", "Fiscal Year": "2018"},
        {"Vouchers Paid": "unknown", "Program": "  ", "Purchasing Authority Description": None},
    )
    silver = to_silver(raw)
    assert silver.schema.simpleString() == SILVER_SCHEMA.simpleString()
    a, b, c, d = silver.collect()
    assert (a.fiscal_year, a.po_year, a.po_month) == (2019, 2018, "2018-08")
    assert a.is_fiscal_year_mismatch and not c.is_fiscal_year_mismatch
    assert a.contract_number == "1000001664"
    assert (b.department, b.department_norm, b.is_missing_department) == (
        "Unknown",
        "unknown",
        False,
    )
    assert b.is_missing_purchase_order_date and b.is_fiscal_year_mismatch is False
    assert b.is_negative_paid and not b.is_large_paid_1m  # strictly above
    assert c.is_large_paid_1b and c.is_non_profit
    assert d.is_negative_paid is None and d.is_large_paid_1m is None
    assert d.program == "" and d.purchasing_authority_description == "Unknown"
    assert to_silver(raw, flag_from="raw").collect()[1].is_missing_department
    with pytest.raises(ValueError, match="expected schema"):
        to_silver(raw.drop("Fund"))


def test_row_hash_repeats_and_ignores_padding(ledger):
    rows = to_silver(ledger({}, {}, {"Department": " PUC Utilities "}, {"Fund": "x"})).collect()
    assert rows[0][ROW_HASH] == rows[1][ROW_HASH] == rows[2][ROW_HASH] != rows[3][ROW_HASH]


def test_group_metrics_keeps_null_groups_and_cancels_exactly(ledger):
    silver = to_silver(
        ledger(
            {"Organization Group": None, "Vouchers Pending": "0.10", SUPPLIER: "A"},
            {"Organization Group": " ", "Vouchers Pending": "0.20", SUPPLIER: "A"},
            {"Organization Group": " NA ", "Vouchers Pending": "(0.30)", SUPPLIER: None},
            {"Organization Group": "G", "Vouchers Pending": None, SUPPLIER: "B"},
            {"Organization Group": "G", "Vouchers Pending": None, SUPPLIER: "b"},
        )
    )
    rows = {r.organization_group: r for r in gold.group_metrics(silver, ["organization_group"]).collect()}
    assert set(rows) == {None, "G"}
    assert rows[None].record_count == 3 and rows[None].unique_suppliers == 1
    assert rows[None].total_vouchers_pending == 0.0
    assert rows["G"].total_vouchers_pending == 0.0 and rows["G"].unique_suppliers == 2


def test_nonzero_mart_drops_groups_that_cancel(ledger):
    silver = to_silver(
        ledger(
            {"Department": "A", "Vouchers Pending": "5.10"},
            {"Department": "A", "Vouchers Pending": "(5.10)"},
            {"Department": "B", "Vouchers Pending": "1"},
            {"Department": "C", "Vouchers Pending": "2"},
        )
    )
    mart = gold.build_mart(silver, gold.SPECS["mart_pending_by_department"])
    assert [r.department for r in mart.collect()] == ["C", "B"]


def test_marts_from_base_equal_marts_from_silver(spark, sf_dir):
    silver = to_silver(raw_table(spark, sf_dir)).persist()
    rows = silver.count()
    for name, mart in gold.build_marts(gold.mart_base(silver)).items():
        direct = gold.build_mart(silver, gold.SPECS[name])
        left, right = mart.select(direct.columns).collect(), direct.collect()
        assert left == right  # same rows in the same order
        if name not in ("mart_spending_by_supplier_top_n", "mart_pending_by_department"):
            assert sum(r.record_count for r in right) == rows
    silver.unpersist()


def test_sketch_base_is_small_and_its_estimates_near(spark, ledger):
    changes = [
        {"Supplier & Other Non-Supplier Payees": f"S{i % 5000}", "Department": f"D{i % 4}", "Vouchers Paid": str(i)}
        for i in range(12_000)
    ]
    silver = to_silver(ledger(*changes)).repartition(6)
    base = gold.sketch_base(silver)
    assert base.count() < 0.05 * gold.mart_base(silver).count()
    marts = gold.build_sketch_marts(silver, base)
    for spec in gold.MARTS:
        exact = {tuple(r[k] for k in spec.keys): r for r in gold.build_mart(silver, spec).collect()}
        found = {tuple(r[k] for k in spec.keys): r for r in marts[spec.name].collect()}
        assert found.keys() == exact.keys()
        for key, row in found.items():
            for metric in gold.METRICS:
                if metric != "unique_suppliers":
                    assert row[metric] == exact[key][metric]
            assert abs(row["unique_suppliers"] - exact[key]["unique_suppliers"]) <= 0.065 * exact[key]["unique_suppliers"]


def test_supplier_mart_breaks_ties_by_name(ledger):
    silver = to_silver(ledger(*[{SUPPLIER: f"S{i:03d}"} for i in range(130)]))
    mart = gold.build_mart(silver, gold.SPECS["mart_spending_by_supplier_top_n"]).collect()
    assert [r.supplier_name for r in mart] == [f"S{i:03d}" for i in range(100)]


def test_missing_and_examples_in_file_order(ledger):
    raw = numbered(
        ledger(*[{"Department": None if i % 2 else "D", "Purchase Order": str(i)} for i in range(40)],
               {"Fiscal Year": None})
    )
    assert tuple(missing.critical_missing_rows(raw).first()) == (41, 1, 2.439)
    assert missing.warning_missing_rows(raw).first().missing_rows == 20
    examples = missing.warning_examples(raw).collect()
    assert [r.purchase_order for r in examples] == [str(i) for i in range(1, 20, 2)]


def test_extremes_take_the_first_of_equal_values(ledger):
    raw = numbered(
        ledger(*[{"Vouchers Paid": v, "Purchase Order": str(i)}
                 for i, v in enumerate([None, "5", "-1", "(1)", "9", "9", "x"])])
    )
    rows = {(r.column_name, r.extreme): r for r in rules.amount_extremes(raw).collect()}
    assert rows["Vouchers Paid", "min"].purchase_order == "2"
    assert rows["Vouchers Paid", "max"].purchase_order == "4"
    counts = {r.column_name: r for r in rules.amount_profile(raw).collect()}["Vouchers Paid"]
    assert (counts.null_count, counts.negative_count, counts.positive_count) == (2, 2, 3)


def test_extremes_stay_in_hash_aggregations(spark, sf_dir):
    raw = raw_table(spark, sf_dir)
    plan = rules.extreme_values(raw)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_extremes_without_values_and_with_ties_over_files(ledger):
    raw = numbered(
        ledger(*[{"Vouchers Paid": "5", "Vouchers Pending": None, "Department": f"D{i}"} for i in range(20)])
    ).withColumn(ROW_ID, 100 - F.col(ROW_ID))
    rows = {(r.column_name, r.extreme): r for r in rules.amount_extremes(raw.repartition(5)).collect()}
    assert len(rows) == 8
    last = raw.orderBy("_row_id").first()["Department"]
    assert rows["Vouchers Paid", "min"].department == rows["Vouchers Paid", "max"].department == last
    assert rows["Vouchers Pending", "max"].value is None and rows["Vouchers Pending", "max"].department is None


def test_examples_of_all_rules_in_one_scan(ledger):
    broken = {"Fiscal Year": "2030", "Department": None, "Purchase Order Date": "2021/01/01"}
    raw = numbered(ledger(*[broken if i % 2 else {} for i in range(60)], {"Purchase Order": None, "Fiscal Year": None}))
    every = list(rules.RULE_EXAMPLES)
    rows = rules.violation_examples(raw, every, n=4).collect()
    masks = rules.rule_masks()
    for rule in every:
        want = [r["_row_id"] for r in raw.filter(masks[rule]).orderBy("_row_id").limit(4).collect()]
        assert sorted(r.row_id for r in rows if r.rule == rule) == want
    assert {r.rule for r in rows} >= {"date_order", "fiscal_year_mismatch", "warning_missing", "critical_missing"}
    assert all(r.data_loaded_at is None for r in rows if r.rule == "fiscal_year_mismatch")
    text = rules.violation_examples(raw, every)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan") == 1 and "WindowGroupLimit" in text


def test_hot_key_is_counted_whole(ledger):
    raw = ledger(*[{"Purchase Order": " Direct Payments" if i < 60 else str(i)} for i in range(90)])
    profile = {r.key_name: r for r in duplicates.key_profile(raw).collect()}
    assert len(profile) == 5
    order = profile["purchase_order"]
    assert (order.unique_key_count, order.duplicate_rows_beyond_first) == (31, 59)
    assert order.max_records_per_key == 60
    assert duplicates.direct_payment_share(raw).first().direct_payments == 60
    top = duplicates.top_duplicate_keys(raw).filter("key_name = 'purchase_order'").collect()
    assert [(r.key, r.records) for r in top] == [("Direct Payments", 60)]
    rows = duplicates.full_row_duplicates(raw).first()
    assert (rows.unique_key_count, rows.duplicate_key_count) == (31, 1)


def test_dimension_profile_against_python(ledger):
    values = ["A", " A", "a", None, "<NULL>", "Other", "NULL ", "A", " "]
    raw = ledger(*[{"Department": v} for v in values])
    row = {r.dimension: r for r in dimensions.dimension_cardinality(raw).collect()}["Department"]
    raw_text = ["<NULL>" if v is None else v for v in values]
    stripped = [t.strip() for t in raw_text]
    assert row.raw_unique_count == len(set(raw_text))
    assert row.stripped_unique_count == len(set(stripped))
    assert row.lower_unique_count == len({t.lower() for t in stripped})
    assert row.null_count == 1
    assert row.whitespace_issue_count == sum(a != b for a, b in zip(raw_text, stripped, strict=True))
    counts = Counter(stripped)
    top = dimensions.dimension_top_values(raw).filter("dimension = 'Department'").collect()
    assert {r.value: r.records for r in top} == counts
    assert top[0].value == "A" and top[0].pct == 33.3333
    special = dimensions.special_values(raw).filter("dimension = 'Department'").collect()
    assert {r.value: r.records for r in special} == {"Other": 1, "NULL": 1, "": 1}


def test_time_distributions(ledger):
    raw = ledger(
        {"Fiscal Year": "2019"}, {"Fiscal Year": "2019.5"}, {"Fiscal Year": None},
        {"Purchase Order Date": None}, {"Purchase Order Date": "2019/01/02"},
    )
    years = {r.fiscal_year: r.records for r in rules.fiscal_year_distribution(raw).collect()}
    assert years == {"2019": 3, "2019.5": 1, None: 1}
    orders = {r.po_year: (r.records, r.pct) for r in times.po_year_distribution(raw).collect()}
    assert orders == {"2018": (3, 75.0), "2019": (1, 25.0)}
    assert [tuple(r) for r in times.freshness(raw).collect()] == [("2026-05-25 03:01:24", 5, 100.0)]


def test_samples_are_exact_and_repeat(ledger):
    raw = numbered(
        ledger(*[{"Fiscal Year": "2018" if i < 70 else "2019", "Purchase Order": str(i)} for i in range(100)],
               {"Fiscal Year": None})
    )
    first = stratified_sample(raw, 20).collect()
    assert Counter(r["Fiscal Year"] for r in first) == {"2018": 20, "2019": 20}
    assert set(first) == set(stratified_sample(raw.repartition(3), 20).collect())
    assert set(first) != set(stratified_sample(raw, 20, seed=1).collect())
    with pytest.raises(Exception, match="fewer than 50 rows"):
        stratified_sample(raw, 50).collect()
    assert stratified_sample(raw, 50, strict=False).count() == 80
    simple = simple_sample(raw, 30).collect()
    assert len(set(simple)) == 30 and simple_sample(raw, 1000).count() == 101
    assert simple_sample(raw, 30).columns == RAW_COLUMNS


def test_sample_of_identical_rows_is_not_all_or_nothing(ledger):
    raw = numbered(ledger(*[{} for _ in range(60)], *[{"Fund": str(i)} for i in range(60)]))
    copies = sum(r["Fund"] == "Operating Fund" for r in simple_sample(raw, 40).collect())
    assert 0 < copies < 40


def test_validation_statuses(ledger):
    silver = to_silver(ledger({"Fund": "a"}, {"Fund": "b"}))
    status = {(r.column_name, r.metric): r.value for r in validation.validate_silver(silver).collect()}
    assert status["", "status"] == "PASS" and status["", "column_count"] == "49"
    twice = validation.silver_identity(silver.unionByName(silver)).first()
    assert (twice.status, twice.source_row_hash_uniqueness_pct) == ("PASS_WITH_WARNINGS", 50.0)
    lacking = validation.silver_identity(silver.drop("po_year")).first()
    assert lacking.status == "PASS_WITH_WARNINGS"
    assert lacking.missing_required_columns == "po_year"
    mart = gold.build_mart(silver, gold.SPECS["mart_fund_category_summary"])
    checked = {
        r.mart: r.status
        for r in validation.validate_gold(
            {
                "mart_fund_category_summary": mart,
                "mart_spending_by_fiscal_year": mart.drop("record_count"),
                "mart_pending_by_department": mart.limit(0),
            }
        ).collect()
    }
    assert checked == {
        "mart_fund_category_summary": "PASS",
        "mart_spending_by_fiscal_year": "FAIL: missing required columns",
        "mart_pending_by_department": "FAIL: no rows",
        "mart_spending_by_department": "FAIL: file does not exist",
        "mart_spending_by_supplier_top_n": "FAIL: file does not exist",
    }


def test_schema_diff_and_types(ledger):
    diff = structure.schema_diff(["Fiscal Year", "Other"])
    assert diff["extra"] == ["Other"] and len(diff["missing"]) == 32 and not diff["in_order"]
    assert diff["positions"][1] == ("Related Govt Units", "Other", "DIFF")
    raw = ledger({}, {"Fund Category Code": None, "Vouchers Paid": "1e3"})
    kinds = {r.column_name: r.inferred_type for r in structure.type_profile(raw).collect()}
    assert kinds["Fiscal Year"] == "bigint"
    assert kinds["Fund Category Code"] == "double"  # whole numbers with a gap
    assert kinds["Vouchers Paid"] == "string" and kinds["Contract Number"] == "double"
    assert kinds["Non-Profit Indicator"] == "double"  # empty


def test_readiness_fails_on_missing_critical_values(ledger):
    rows = {r.check: r.status for r in readiness_summary(ledger({}, {"Purchase Order": None})).collect()}
    assert rows["missing_values"] == "FAIL" and rows["overall"] == "NOT_READY"


def test_readiness_from_reports_equals_readiness_from_rows(ledger):
    raw = ledger(
        {}, {}, {"Purchase Order": None}, {"Fiscal Year": None}, {"Vouchers Paid": "(1.00)"},
        {"Vouchers Paid": "$2,000,000.00"}, {"Department": " puc utilities"}, {"Purchase Order Date": "x"},
    )
    raw = raw.withColumn(ROW_ID, F.monotonically_increasing_id())
    profiles = [
        structure.profile_schema(raw), types.profile_data_types(raw), missing.profile_missing(raw),
        rules.profile_business_rules(raw), duplicates.profile_duplicates(raw),
        dimensions.profile_dimensions(raw), times.profile_time_coverage(raw),
    ]
    reports = readiness_from_reports(report.union_reports(profiles)).collect()
    assert sorted(map(tuple, reports)) == sorted(map(tuple, readiness_summary(raw).collect()))


def test_top_keys_break_ties_by_text_whatever_their_digest(ledger):
    orders = [f"{i:04d}" for i in range(30) for _ in range(2)] + ["0029", "0028"]
    rows = duplicates.top_duplicate_keys(ledger(*[{"Purchase Order": o} for o in orders]), k=4)
    first = [(r.rank, r.key, r.records) for r in rows.collect() if r.key_name == "purchase_order"]
    assert sorted(first) == [(1, "0028", 3), (2, "0029", 3), (3, "0000", 2), (4, "0001", 2)]
    assert duplicates.top_duplicate_keys(ledger({})).count() == 0


def test_time_profile_scans_once(spark, ledger, scratch):
    ledger({}, {"Purchase Order Date": None}).write.parquet(f"{scratch}/raw")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        profile = times.profile_time_coverage(spark.read.parquet(f"{scratch}/raw"))
        plan = profile._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("FileScan parquet") == 1


def test_time_profile_of_no_rows(ledger):
    rows = times.profile_time_coverage(ledger({}).limit(0)).collect()
    assert {(r.metric, r.value) for r in rows if r.metric == "total_rows"} == {("total_rows", "0")}


def test_sample_values_unfold_few_blocks(spark, ledger):
    raw = ledger({}).drop("Department").crossJoin(spark.range(200_000)).select(
        "*",
        F.when(F.col("id") % 70_000 == 69_999, F.concat(F.lit("D"), "id")).alias("Department"),
        F.col("id").alias(ROW_ID),
    ).drop("id")
    rows = structure.sample_values(raw, k=2).filter("column_name = 'Department'").collect()
    assert sorted((r.position, r.value) for r in rows) == [(1, "D69999"), (2, "D139999")]


def test_silver_of_one_large_year_is_cut_without_adaptive_execution(spark, ledger, scratch):
    raw = ledger({}).drop("Fiscal Year").crossJoin(spark.range(5_000)).select(
        "*",
        F.when(F.col("id") % 10 > 0, "2019").when(F.col("id") % 20 > 0, "2020").alias("Fiscal Year"),
    ).select(*RAW_COLUMNS, F.lit(0).alias(ROW_ID))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_silver(to_silver(raw), f"{scratch}/silver", rows_per_file=500)
        silver = read_silver(spark, f"{scratch}/silver")
        files = silver.groupBy("fiscal_year", F.input_file_name().alias("file")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    per_year = {y: sorted(r["count"] for r in files if r.fiscal_year == y) for y in (2019, 2020, None)}
    assert per_year == {2019: [500] * 9, 2020: [250], None: [250]}


def test_sample_deals_no_cells_out_by_year(spark, ledger):
    """At size the strata's extent is unknown to the planner; rows must not be joined by a shuffle."""
    raw = ledger(*[{"Fiscal Year": str(2010 + i % 3), "Purchase Order": f"{i:04d}"} for i in range(90)])
    raw = raw.withColumn("_row_id", F.col("Purchase Order"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        sample = stratified_sample(raw, 20, strict=False)
        plan = sample._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert Counter(r["Fiscal Year"] for r in sample.collect()) == {"2010": 20, "2011": 20, "2012": 20}
    finally:
        spark.conf.set(limit, before)


def test_type_counts_of_odd_cells(ledger):
    """What the first byte decides agrees with the whole pattern."""
    cells = [
        "12", " 12 ", "+3", "-4.5", ".5", "inf", "-Infinity", "Inf", " 7", "A1", "Word", "infinite",
        "2018/8/ 7", "2018/08/07", "2018/08/07 02:32:12 PM", " 2018/08/07", "TRUE", "false", " true", "truth", None,
    ]
    raw = ledger(*[{"Program": cell} for cell in cells])
    row = next(r for r in structure.type_profile(raw).collect() if r.column_name == "Program")
    assert row.total_rows == 21 and row.non_null_count == 20
    assert (row.integer_count, row.number_count, row.boolean_count) == (3, 9, 2)
    assert (row.date_count, row.timestamp_count) == (2, 1)
