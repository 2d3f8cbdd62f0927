"""What several passes read is derived once, and written files stay small."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from payments_lake.functions import composite_key, normalize_key_value, with_row_hash
from payments_lake.functions.text import MISSING_TOKENS
from payments_lake.operators import duplicates, structure
from payments_lake.operators.silver import to_silver
from payments_lake.operators.validation import silver_identity, validate_silver
from payments_lake.plans.readiness import readiness_summary
from payments_lake.schema import FLAGS, RAW_COLUMNS, REQUIRED_SILVER_COLUMNS, ROW_HASH, WIDTH
from payments_lake.sources.bridge import bridge, joined_tables
from verification import queries as q

ONCE = [
    "gold_marts_from_base",
    "gold_marts_from_sketches",
    "mart_metric_summary",
    "profile_file_structure",
]


@pytest.mark.parametrize("name", ONCE)
def test_passes_read_a_stored_table(spark, sf_dir, name):
    files = q.QUERIES[name](spark, sf_dir).inputFiles()
    assert files and not any("lineitem" in file for file in files)


def test_raw_files_are_compressed_and_of_bounded_size(spark, sf_dir, scratch, monkeypatch):
    monkeypatch.setattr(q, "shared_folder", lambda spark: f"file://{scratch}")
    q.landed_files(spark, sf_dir)
    written = [p for p in Path(scratch, "raw").rglob("part-*")]
    assert written and all(p.name.endswith(".snappy") for p in written)
    sizes = {}
    for p in written:
        sizes[p.parent] = sizes.get(p.parent, 0) + p.stat().st_size
    assert max(sizes.values()) < 2.2 * sum(sizes.values()) / len(sizes)


def test_raw_files_are_written_where_records_are_made(spark, scratch, monkeypatch):
    """No record is shuffled: a task's files hold its records in order, each file after a header."""
    spark.range(70).write.parquet(f"{scratch}/lineitem.parquet")
    cells = ",".join(f'"{i}"' for i in range(32))
    texts = spark.range(0, 70, 1, 4).filter("id >= 20").select(
        F.col("id").alias("row_id"), F.concat(F.lit(cells + ","), F.col("id").cast("string")).alias("record")
    )
    monkeypatch.setattr(q, "shared_folder", lambda spark: f"file://{scratch}")
    monkeypatch.setattr(q, "record_texts", lambda spark, sf_dir: texts)
    landed = q.landed_files(spark, scratch)
    written = sorted(Path(scratch, "raw").glob("part-*"))
    files = [[r.value for r in spark.read.text(f"{p}").collect()] for p in written]
    files = [lines for lines in files if lines]
    assert all(lines[0].startswith('"Fiscal Year",') and 2 <= len(lines) <= 10 for lines in files)
    assert [int(line.split(",")[-1]) for lines in files for line in lines[1:]] == list(range(20, 70))
    assert len({len(lines) for lines in files}) > 1
    numbers = [int(r[0]) for r in landed.select("Purchasing Authority Description").collect()]
    assert sorted(numbers) == list(range(20, 70))
    assert {r[0] for r in landed.select(WIDTH).collect()} == {33}
    assert list(Path(scratch, "landed").glob("part-*.zstd.parquet"))


def test_reports_of_readiness_derive_the_ledger_once(spark, sf_dir, monkeypatch):
    raw, plain = q.stored(q.raw_with_records(spark, sf_dir)), q.raw_table(spark, sf_dir)
    malformed = f"width != {len(RAW_COLUMNS)}"
    widths = rows(structure.widths_of_landed(raw).filter(malformed))
    assert widths and widths == rows(q.stored_widths(spark, sf_dir).filter(malformed))
    assert raw.count() == plain.count() and raw.select(plain.columns).exceptAll(plain).isEmpty()
    derived = []
    monkeypatch.setattr(q, "bridge", lambda *a: derived.append(a) or bridge(*a))
    monkeypatch.setattr(q, "raw_table", lambda *a: derived.append(a) or plain)
    nothing = spark.createDataFrame([("x", "", "m", "0")], "check string, column_name string, metric string, value string")
    for module in (structure, q.types, q.missing, q.rules, duplicates, q.dimensions, q.times):
        for name in [n for n in vars(module) if n.startswith("profile_")]:
            monkeypatch.setattr(module, name, lambda *a: nothing)
    q.QUERIES["readiness_from_reports"](spark, sf_dir)
    assert len(derived) == 1


def test_suppliers_are_joined_by_their_own_size(spark, sf_dir):
    plan = joined_tables(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    # nation joins the ledger, not supplier: a join of parents counts as the product of their sizes
    depth = [line.index("Join") for line in plan.splitlines() if "Join Inner" in line]
    keys = [line for line in plan.splitlines() if "Join Inner" in line]
    supplier = next(i for i, line in enumerate(keys) if "s_suppkey" in line)
    nation = next(i for i, line in enumerate(keys) if "n_nationkey" in line)
    assert depth[nation] < depth[supplier]


def test_rows_are_narrow_where_large_parents_join(spark, sf_dir):
    """Names of suppliers, nations and regions aren't carried through the shuffles for parts and orders."""
    plan = joined_tables(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    depth = {key: line.index("Join") for line in plan.splitlines() for key in ("l_partkey", "l_orderkey", "l_suppkey") if "Join Inner" in line and key in line}
    assert depth["l_suppkey"] < min(depth["l_partkey"], depth["l_orderkey"])


def test_schema_profile_derives_the_ledger_once(spark, sf_dir, scratch, monkeypatch):
    monkeypatch.setattr(q, "shared_folder", lambda spark: f"file://{scratch}")
    files = q.QUERIES["profile_schema"](spark, sf_dir).inputFiles()
    assert files and not [f for f in files if "lineitem" in f]
    assert all(p.name.endswith(".zstd.parquet") for p in Path(scratch, "table").glob("part-*"))


def test_queries_with_several_passes_derive_the_ledger_once(spark, sf_dir):
    """What they return reads the stored table, not the tables it is derived from."""
    for name in ("profile_duplicates", "top_duplicate_keys"):
        files = q.QUERIES[name](spark, sf_dir).inputFiles()
        assert files and not [f for f in files if "lineitem" in f], name


@pytest.fixture
def keep(spark, scratch):
    """Stores frames, and keeps the plans by which they were computed."""

    def store(frame):
        store.plans.append(frame._jdf.queryExecution().executedPlan().toString())
        path = f"{scratch}/{len(store.plans)}"
        frame.write.parquet(path)
        return spark.read.parquet(path)

    store.plans = []
    return store


def test_texts_of_keys_stay_in_their_tasks(spark, ledger, keep):
    """They are joined with few digests, whatever Spark knows about the number of these."""
    raw = keep(ledger(*[{"Purchase Order": f"{i % 9}"} for i in range(30)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        duplicates.top_duplicate_keys(raw, keep=keep)
        assert len(keep.plans) == 5
        assert not [plan for plan in keep.plans if "SortMergeJoin" in plan or "ShuffledHashJoin" in plan]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("fetched", [1, 4, 7, 1000])
def test_more_ties_than_texts_fetched_first(ledger, keep, fetched):
    orders = [f"{i:02d}" for i in range(40) for _ in range(2 + (i in (25, 31)))] + ["once", " 07", None]
    raw = keep(ledger(*[{"Purchase Order": o} for o in orders]))
    counts = Counter("<NULL>" if o is None else o.strip() for o in orders)
    best = sorted(((-n, key) for key, n in counts.items() if n > 1))[:4]
    repeated = keep(duplicates.repeated_keys(duplicates.key_digests(raw)))
    for kept in (keep, duplicates.as_it_is):
        top = duplicates._top_keys(raw, repeated, 4, kept, fetched).filter("key_name = 'purchase_order'")
        assert [(-r.records, r.key) for r in sorted(top.collect(), key=lambda r: r["rank"])] == best


def test_uniqueness_from_repeated_keys(ledger):
    changes = [{}, {}, {"Purchase Order": None}, {"Purchase Order": " "}, {"Department": "x"}, {"Fiscal Year": "1"}]
    for raw in (ledger(*changes), ledger({}, {"Purchase Order": "2"}), ledger({}).limit(0)):
        digests = duplicates.key_digests(raw)
        found = duplicates._key_uniqueness(raw, duplicates.repeated_keys(digests))
        assert rows(found) == rows(duplicates.uniqueness(digests, "key_name"))


def test_stored_columns_give_the_same_reports(spark, ledger):
    raw = ledger({}, {}, {"Department": None}, {"Purchase Order": None, "Vouchers Paid": "x"}, {"Fiscal Year": " "})
    assert rows(duplicates.profile_duplicates(q.stored_keys(with_row_hash(raw), ROW_HASH))) == rows(
        duplicates.profile_duplicates(raw)
    )


def rows(frame):
    return sorted(map(str, frame.collect()))


def scans(spark, frame):
    """How often the plan of a frame reads files, exchanges shared."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return frame()._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_silver_is_validated_in_one_scan(spark, ledger, scratch):
    to_silver(ledger({}, {})).write.parquet(f"{scratch}/silver")
    silver = spark.read.parquet(f"{scratch}/silver")
    assert scans(spark, lambda: validate_silver(silver)) == 1


def test_readiness_takes_one_scan(spark, ledger, scratch):
    with_row_hash(ledger({}, {})).withColumn(WIDTH, F.lit(33)).write.parquet(f"{scratch}/raw")
    raw = spark.read.parquet(f"{scratch}/raw")
    assert scans(spark, lambda: readiness_summary(raw, carried_widths=True)) == 1


def test_silver_counts_of_odd_rows(spark, ledger, scratch):
    """Copies, rows that differ under one hash, and missing or unreadable hashes."""
    to_silver(ledger({}, {}, {"Department": "NA", "Vouchers Paid": "(1)"}, {"Fiscal Year": "x"})).write.parquet(
        f"{scratch}/silver"
    )
    silver = spark.read.parquet(f"{scratch}/silver")
    one = silver.limit(1)
    odd = silver.unionByName(
        one.withColumns({"po_year": F.lit(None).cast("int"), "is_negative_paid": F.lit(None).cast("boolean")})
    ).unionByName(one.withColumn(ROW_HASH, F.lit("not hex")))
    odd = odd.unionByName(one.withColumns({ROW_HASH: F.lit(None).cast("string"), "fiscal_year": F.lit(1990)}))
    for frame in (odd, odd.limit(0), odd.drop(ROW_HASH), odd.drop("fiscal_year", "department")):
        found = {(r.column_name, r.metric): r.value for r in validate_silver(frame).collect()}
        identity = silver_identity(frame).first()
        assert found["", "status"] == identity.status
        assert int(found[ROW_HASH, "unique_count"]) == identity.unique_source_hash_count
        table = [r.asDict() for r in frame.collect()]
        assert int(found["", "total_rows"]) == identity.row_count == len(table)
        for name in set(REQUIRED_SILVER_COLUMNS) & set(frame.columns):
            nulls = sum(r[name] is None or r[name] in MISSING_TOKENS for r in table)
            assert int(found[name, "null_count"]) == nulls, name
        for name in FLAGS:
            assert int(found[name, "true_count"]) == sum(r[name] is True for r in table), name
        if "fiscal_year" in frame.columns:
            years = [str(r["fiscal_year"]) for r in table if r["fiscal_year"] is not None]
            assert found["fiscal_year", "min"] == min(years, default=None)
            assert found["fiscal_year", "max"] == max(years, default=None)


def test_carried_widths_count_as_a_frame_of_widths(ledger):
    raw = ledger({}, {}, {"Department": None, "Program": " a"}, {"Fiscal Year": "x", "Program": "A"}, {"Fund": "y"})
    raw = raw.withColumn(WIDTH, F.when(F.col("Fund") == "y", 35).otherwise(33))
    for frame in (raw, raw.limit(0)):
        widths = frame.select(F.col(WIDTH).alias("width"))
        carried = rows(readiness_summary(frame, carried_widths=True))
        assert carried == rows(readiness_summary(frame, widths)) and len(carried) == 9
    found = {r.check: (r.failures, r.warnings) for r in readiness_summary(raw, carried_widths=True).collect()}
    assert found["file_structure"] == (0, 1) and found["duplicates"] == (0, 1 + 4)
    assert found["time_coverage"][0] == 1 and found["dimensions"] == (0, 2)


def test_keys_are_trimmed_of_any_white_space(spark):
    edges = ["", " ", "\t", "\x85", "\xa0", "\u1680", "\u3000", "\n", " \x1f "]
    cells = [e + text + e for e in edges for text in ("a b", "\u00e9", "\u4e2d", "", "||")] + [None]
    frame = spark.createDataFrame([(x, y) for x in cells for y in cells], "a string, b string")
    parts = F.concat_ws("||", normalize_key_value(F.col("a")), normalize_key_value(F.col("b")))
    assert frame.filter(~composite_key(["a", "b"]).eqNullSafe(parts)).count() == 0
