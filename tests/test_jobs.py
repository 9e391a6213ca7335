from datetime import timedelta

import pytest

from tidemark import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS, PRODUCTS, Layout, read_report, refresh
from tidemark import run_entity_batch, run_entity_batches
from tidemark.plans import jobs, sales_state
from tidemark.plans.jobs import Options, SuspiciousSnapshot, read_silver
from tidemark.sources.control_log import read_events, record_state
from tidemark.sources.files import child_names
from tidemark.sources.fingerprint import content_hash
from tidemark.sources.staging import Staging
from tidemark.sources.tables import read_batches

FILES = {
    PRODUCTS: "1,lamp,home,10.00,5\n2,desk,home,99.90,1\n3,,home,1.00,1\nx,a,b,1.00,1\n",
    CUSTOMERS: "1,Ines,Moreau,ines@shop.test,France,2025-01-01\n2,Jo,Li,bad,China,2025-01-01\n",
    ORDERS: "1,1,2025-02-01,completed\n2,9,2025-02-02,completed\n3,1,2025-02-02,pending\n",
    ORDER_ITEMS: "1,1,1,2,10.00\n2,1,2,1,99.90\n3,2,1,1,9.00\n3,2,1,1,9.00\n4,3,1,0,9.00\n",
}


@pytest.fixture
def deliver(tmp_path):
    def write(entity, body=None, name=None):
        path = tmp_path / f"{name or entity.name}.csv"
        path.write_text(",".join(entity.columns) + "\n" + (FILES[entity] if body is None else body))
        return str(path)

    return write


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "lake"))


def silver(spark, layout, entity, *columns):
    return sorted(tuple(r) for r in read_silver(spark, layout, entity).select(*columns).collect())


def states(spark, layout):
    return sorted(row["status"] for row in read_events(spark, layout.control).collect())


def quarantined(spark, layout, entity):
    return spark.read.parquet(layout.quarantine(entity)).count()


def test_refresh_end_to_end(spark, deliver, layout):
    sources = {entity.name: deliver(entity) for entity in FILES}
    results = refresh(spark, sources, layout)
    counts = {n: (r.total_rows, r.valid_rows, r.invalid_rows) for n, r in results.items()}
    assert counts == {
        "products": (4, 2, 2),
        "customers": (2, 1, 1),
        "orders": (3, 3, 0),
        "order_items": (5, 2, 3),
    }
    daily = read_report(spark, layout, "daily_sales").collect()
    assert [(str(r["order_date"]), r["order_count"], str(r["revenue"])) for r in daily] == [
        ("2025-02-01", 1, "119.90")
    ]
    customers = read_report(spark, layout, "customer_metrics").collect()
    assert [(r["customer_id"], r["first_name"]) for r in customers] == [(1, "Ines")]
    columns = read_silver(spark, layout, PRODUCTS).columns
    assert columns == [
        *PRODUCTS.columns,
        "ingestion_timestamp",
        "source_file",
        "batch_id",
        "is_active",
        "is_unique",
        "quality_errors",
        "is_valid",
    ]
    logged = spark.read.parquet(layout.batch_counts).where("entity = 'order_items'").first()
    assert (logged["total_rows"], logged["valid_rows"], logged["invalid_rows"]) == (5, 2, 3)
    errors = spark.read.parquet(layout.error_counts).where("batch_id LIKE 'order_items-%'")
    assert {(r["error"], r["row_count"]) for r in errors.collect()} == {
        ("order_item_id is not unique", 2),
        ("quantity <= 0", 1),
    }
    # Nothing new: everything is skipped and the reports are rebuilt alike.
    assert all(result.skipped for result in refresh(spark, sources, layout).values())
    assert states(spark, layout) == ["BRONZE_WRITTEN"] * 4 + ["SUCCESS"] * 4
    # Work tables are gone.
    assert read_report(spark, layout, "daily_sales").count() == 1


def test_snapshot_batches(spark, deliver, layout):
    first = run_entity_batch(spark, PRODUCTS, deliver(PRODUCTS), layout)
    body = "1,lamp,home,10.00,5\n2,,home,99.90,1\n4,chair,home,50.00,2\n"
    second = run_entity_batch(spark, PRODUCTS, deliver(PRODUCTS, body, "p2"), layout)
    assert silver(spark, layout, PRODUCTS, "product_id", "is_active", "batch_id") == [
        (1, True, first.batch_id),  # unchanged
        (2, True, first.batch_id),  # listed but rejected
        (4, True, second.batch_id),
    ]
    third = run_entity_batch(spark, PRODUCTS, deliver(PRODUCTS, "4,chair,home,51.00,2\n", "p3"), layout)
    assert silver(spark, layout, PRODUCTS, "product_id", "is_active", "batch_id") == [
        (1, False, first.batch_id),
        (2, False, first.batch_id),
        (4, True, third.batch_id),
    ]
    # A file with only a header deactivates everything.
    run_entity_batch(spark, PRODUCTS, deliver(PRODUCTS, "", "p4"), layout)
    assert [active for _, active in silver(spark, layout, PRODUCTS, "product_id", "is_active")] == [
        False
    ] * 3


def test_incremental_batches(spark, deliver, layout):
    run_entity_batch(spark, ORDERS, deliver(ORDERS), layout)
    body = "3,1,2025-02-02,completed\n5000000,1,2025-02-03,pending\n"
    run_entity_batch(spark, ORDERS, deliver(ORDERS, body, "o2"), layout)
    assert silver(spark, layout, ORDERS, "order_id", "status") == [
        (1, "completed"),
        (2, "completed"),
        (3, "completed"),
        (5000000, "pending"),
    ]


def test_renamed_copy_is_skipped(spark, deliver, layout):
    first = run_entity_batch(spark, ORDERS, deliver(ORDERS), layout)
    again = run_entity_batch(spark, ORDERS, deliver(ORDERS, name="copy"), layout)
    assert again.skipped and again.batch_id == first.batch_id


def test_header_only_first_load(spark, deliver, layout):
    result = run_entity_batch(spark, ORDERS, deliver(ORDERS, ""), layout)
    assert (result.total_rows, result.skipped) == (0, False)
    assert silver(spark, layout, ORDERS, "order_id") == []
    run_entity_batch(spark, ORDERS, deliver(ORDERS, name="o2"), layout)
    assert len(silver(spark, layout, ORDERS, "order_id")) == 3


@pytest.mark.parametrize(
    "stage", ["take", "publish", "moved", "record_states", "validate", "load_quarantine", "load_incremental", "final"]
)
def test_a_crash_at_any_stage_is_made_good_by_a_retry(spark, deliver, layout, monkeypatch, stage):
    source = deliver(ORDER_ITEMS, FILES[ORDER_ITEMS] + "y,2,1,1,1.00\n")
    real_record, real_publish = jobs.record_states, Staging.publish

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    def crash_after_the_move(*args):
        real_publish(*args)
        raise RuntimeError("lost")

    def crash_at_the_end(*args, **kwargs):
        if kwargs["status"] == "SUCCESS":
            raise RuntimeError("lost")
        real_record(*args, **kwargs)

    with monkeypatch.context() as patch:
        if stage == "final":
            patch.setattr(jobs, "record_states", crash_at_the_end)
        elif stage == "moved":
            patch.setattr(Staging, "publish", crash_after_the_move)
        elif stage in ("take", "publish"):
            patch.setattr(Staging, stage, crash)
        else:
            patch.setattr(jobs, stage, crash)
        with pytest.raises(RuntimeError, match="lost"):
            run_entity_batch(spark, ORDER_ITEMS, source, layout)

    result = run_entity_batch(spark, ORDER_ITEMS, source, layout)
    assert not result.skipped
    assert silver(spark, layout, ORDER_ITEMS, "order_item_id") == [(1,), (2,)]
    assert quarantined(spark, layout, ORDER_ITEMS) == 4
    bronze = read_batches(spark, layout.bronze(ORDER_ITEMS), ORDER_ITEMS.bronze_schema)
    assert bronze.count() == 6
    assert states(spark, layout) == ["BRONZE_WRITTEN", "SUCCESS"]


def test_a_retry_after_half_a_quarantine_write_ends_with_every_copy(spark, deliver, layout, monkeypatch):
    source = deliver(ORDER_ITEMS)
    whole = jobs.replace_batch

    def half(rows, path):
        if path == layout.quarantine(ORDER_ITEMS):
            whole(rows.limit(1), path)
            raise RuntimeError("lost")
        whole(rows, path)

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "replace_batch", half)
        with pytest.raises(RuntimeError, match="lost"):
            run_entity_batch(spark, ORDER_ITEMS, source, layout)
    run_entity_batch(spark, ORDER_ITEMS, source, layout)
    assert quarantined(spark, layout, ORDER_ITEMS) == 3


def test_a_failed_rebuild_leaves_all_old_reports(spark, deliver, layout, monkeypatch):
    sources = {entity.name: deliver(entity) for entity in FILES}
    refresh(spark, sources, layout)
    before = {name: sorted(map(str, read_report(spark, layout, name).collect())) for name in jobs.REPORTS}
    whole = sales_state.overwrite
    for failing in ("totals_product_performance", "customer_metrics"):

        def fails(rows, path, failing=failing):
            whole(rows.selectExpr("raise_error('lost')") if path.endswith(f"/{failing}") else rows, path)

        for full in (True, False):
            with monkeypatch.context() as patch:
                patch.setattr(sales_state, "overwrite", fails)
                with pytest.raises(Exception, match="lost"):
                    jobs.refresh_reports(spark, layout, full)
            for name in jobs.REPORTS:
                assert sorted(map(str, read_report(spark, layout, name).collect())) == before[name]
    assert jobs.refresh_reports(spark, layout) == "changes"


def test_plain_equality_quarantine_adds_keyless_rows_again(spark, deliver, layout, monkeypatch):
    source = deliver(ORDER_ITEMS, "y,2,1,1,1.00\n")
    options = Options(null_safe_quarantine=False)
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "load_incremental", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_entity_batch(spark, ORDER_ITEMS, source, layout, options)
    run_entity_batch(spark, ORDER_ITEMS, source, layout, options)
    assert quarantined(spark, layout, ORDER_ITEMS) == 2


def test_strict_leaves_the_batch_at_bronze(spark, deliver, layout):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_entity_batch(spark, PRODUCTS, deliver(PRODUCTS), layout, Options(strict=True))
    assert states(spark, layout) == ["BRONZE_WRITTEN"]


def test_snapshot_guards(spark, deliver, layout):
    run_entity_batch(spark, PRODUCTS, deliver(PRODUCTS), layout)
    small = deliver(PRODUCTS, "1,lamp,home,11.00,5\nx,a,b,1.00,1\n", "p2")
    with pytest.raises(SuspiciousSnapshot):
        run_entity_batch(spark, PRODUCTS, small, layout, Options(max_missing_fraction=0.4))
    run_entity_batch(spark, PRODUCTS, small, layout, Options(guard_unkeyed=True))
    assert silver(spark, layout, PRODUCTS, "product_id", "is_active") == [(1, True), (2, True)]


def test_unknown_state_is_an_error(spark, deliver, layout):
    source = deliver(ORDERS)
    record_state(
        spark,
        layout.control,
        entity="orders",
        source_file=source,
        file_hash=content_hash(spark, source, ORDERS),
        batch_id="b",
        status="LOST",
    )
    with pytest.raises(ValueError, match="LOST"):
        run_entity_batch(spark, ORDERS, source, layout)


def test_large_batches_take_the_shuffled_paths(spark, deliver, layout, monkeypatch):
    monkeypatch.setattr(jobs, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(jobs, "BROADCAST_ROWS", 0)
    run_entity_batch(spark, ORDER_ITEMS, deliver(ORDER_ITEMS), layout)
    run_entity_batch(spark, ORDER_ITEMS, deliver(ORDER_ITEMS, "2,1,2,7,99.90\n", "i2"), layout)
    assert silver(spark, layout, ORDER_ITEMS, "order_item_id", "quantity") == [(1, 2), (2, 7)]
    assert quarantined(spark, layout, ORDER_ITEMS) == 3


def test_reports_of_an_empty_lake(spark, layout):
    jobs.refresh_reports(spark, layout)
    for name in jobs.REPORTS:
        assert read_report(spark, layout, name).count() == 0
    assert set(ENTITIES) == {"products", "customers", "orders", "order_items"}


# -- many files in one run ------------------------------------------------------------------

COUNTS = ("inserted", "updated", "deactivated", "reactivated", "same")


def many(deliver, entity, bodies):
    return [deliver(entity, body, f"{entity.name}-{i}") for i, body in enumerate(bodies)]


def whole(spark, layout, entity):
    """Silver without the time of reading."""
    rows = read_silver(spark, layout, entity).drop("ingestion_timestamp")
    return sorted(map(str, rows.collect()))


SNAPSHOTS = [
    "1,lamp,home,10.00,5\n2,desk,home,20.00,1\n3,chair,home,5.00,2\n",
    "1,lamp,home,11.00,5\n3,,home,5.00,2\n",  # 2 is gone, 3 is rejected and stays
    "1,lamp,home,10.00,5\n2,desk,home,20.00,1\n2,desk,home,20.00,1\n,x,y,1.00,1\n",  # 1 is as before, 2 repeated, 3 gone
    "2,desk,home,20.00,1\n4,sofa,home,90.00,1\n",
]
CHANGING_ORDERS = [
    "1,1,2025-02-01,pending\n2,1,2025-02-01,pending\n",
    "1,1,2025-02-01,completed\n3,1,2025-02-01,pending\n4,1,2025-02-01,x\n",
    "1,1,2025-02-01,pending\n2,1,2025-02-01,pending\n",  # content of the first file
    "1,1,2025-02-01,pending\n5000000,1,2025-02-02,pending\n3,1,x,pending\n3,1,x,pending\n",
]


@pytest.mark.parametrize("entity, bodies", [(PRODUCTS, SNAPSHOTS), (ORDERS, CHANGING_ORDERS)], ids=["snapshots", "incremental"])
def test_files_of_one_run_equal_one_run_each(spark, deliver, tmp_path, entity, bodies):
    sources = many(deliver, entity, bodies)
    single, bulk = (Layout(str(tmp_path / name)) for name in ("single", "bulk"))
    options = Options(guard_unkeyed=True)
    results = [run_entity_batch(spark, entity, source, single, options) for source in sources]
    together = run_entity_batches(spark, entity, sources, bulk, options)
    shown = lambda found: [(r.batch_id, r.skipped, r.total_rows, r.valid_rows, r.invalid_rows) for r in found]
    assert shown(results) == shown(together)
    assert whole(spark, bulk, entity) == whole(spark, single, entity)
    for table in (bulk.batch_counts, bulk.error_counts, bulk.quarantine(entity)):
        columns = [c for c in spark.read.parquet(table).columns if c != "ingestion_timestamp"]
        expected = spark.read.parquet(table.replace(bulk.root, single.root)).select(columns).collect()
        assert sorted(map(str, spark.read.parquet(table).select(columns).collect())) == sorted(map(str, expected))
    assert states(spark, bulk) == states(spark, single)


def test_the_number_of_spark_jobs_does_not_depend_on_the_files(spark, deliver, tmp_path):
    def jobs_of(files, name):
        sources = many(deliver, ORDERS, [f"{i + 1},1,2025-02-01,pending\n{i + 1000},0,x,y\n" for i in range(files)])
        spark.sparkContext.setJobGroup(name, name)
        run_entity_batches(spark, ORDERS, sources, Layout(str(tmp_path / name)))
        spark.sparkContext.setJobGroup("", "")
        assert read_silver(spark, Layout(str(tmp_path / name)), ORDERS).count() == files
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    few, lots = jobs_of(3, "few"), jobs_of(200, "lots")
    assert lots <= few + 4  # folders beyond 32 are listed by a job of their own


def test_folders_and_files_are_sources_alike(spark, tmp_path):
    sources = [tmp_path / "a", tmp_path / "a b"]
    for n, folder in enumerate(sources):
        folder.mkdir()
        for part in range(2):
            (folder / f"{part}.csv").write_text(f"{','.join(ORDERS.columns)}\n{2 * n + part},1,2025-02-01,pending\n")
    sources = [str(s) for s in sources] + [str(tmp_path / "c.csv")]
    (tmp_path / "c.csv").write_text(f"{','.join(ORDERS.columns)}\n9,1,2025-02-01,pending\n")
    layout = Layout(str(tmp_path / "lake"))
    results = run_entity_batches(spark, ORDERS, sources, layout)
    assert [r.total_rows for r in results] == [2, 2, 1]
    assert results[0].batch_id == f"orders-{content_hash(spark, sources[0], ORDERS)[:32]}"
    assert silver(spark, layout, ORDERS, "order_id") == [(1,), (2,), (3,), (9,)]
    with pytest.raises(ValueError, match="none of the sources"):
        run_entity_batches(spark, ORDERS, [sources[0], str(tmp_path / "*.csv")], layout)


def test_a_failed_run_of_many_files_resumes(spark, deliver, layout, monkeypatch):
    sources = many(deliver, ORDERS, CHANGING_ORDERS)
    moved = Staging.publish

    def second_fails(self, number, batch_id):
        if number == 1:
            raise RuntimeError("lost")
        moved(self, number, batch_id)

    with monkeypatch.context() as patch:
        patch.setattr(Staging, "publish", second_fails)
        with pytest.raises(RuntimeError, match="lost"):
            run_entity_batches(spark, ORDERS, sources, layout)
    assert [n for n in child_names(spark, layout.bronze(ORDERS)) if n.startswith("_staging")] == []
    run_entity_batches(spark, ORDERS, sources, layout)
    assert silver(spark, layout, ORDERS, "order_id", "status") == [(1, "pending"), (2, "pending"), (3, "pending"), (5000000, "pending")]
    bronze = read_batches(spark, layout.bronze(ORDERS), ORDERS.bronze_schema)
    assert bronze.count() == 9
    assert states(spark, layout) == ["BRONZE_WRITTEN"] * 3 + ["SUCCESS"] * 3


def test_a_source_is_scanned_once(spark, deliver, layout, monkeypatch):
    from tidemark.sources import staging

    scans = []
    real = staging.read_raw
    monkeypatch.setattr(staging, "read_raw", lambda *a, **k: scans.append(a[1]) or real(*a, **k))
    run_entity_batch(spark, ORDERS, deliver(ORDERS), layout)
    assert len(scans) == 1


def test_the_callers_settings_come_back(spark, deliver, layout, with_settings):
    with_settings(spark__sql__session__timeZone="Asia/Tokyo", spark__sql__adaptive__forceOptimizeSkewedJoin="false")
    run_entity_batch(spark, ORDERS, deliver(ORDERS), layout)
    assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"


# -- change sets and versions -----------------------------------------------------------------


def test_a_load_tells_what_it_changed(spark, deliver, layout):
    bodies = [
        "1,lamp,home,10.00,5\n2,desk,home,20.00,1\n3,chair,home,5.00,2\n",
        "1,lamp,home,11.00,5\n3,,home,5.00,2\n4,sofa,home,9.00,1\n",
        "1,lamp,home,11.00,5\n2,desk,home,20.00,1\n4,sofa,home,9.00,1\n",
    ]
    found = [run_entity_batch(spark, PRODUCTS, source, layout).changes for source in many(deliver, PRODUCTS, bodies)]
    assert [tuple(c[k] for k in COUNTS) for c in found] == [(3, 0, 0, 0, 0), (1, 1, 1, 0, 1), (0, 0, 1, 1, 2)]
    logged = spark.read.parquet(layout.change_counts).where("entity = 'products'")
    assert sorted(tuple(r[k] for k in COUNTS) for r in logged.collect()) == sorted(tuple(c[k] for k in COUNTS) for c in found)


def test_only_changed_slices_are_written(spark, deliver, layout):
    wide = 4_194_304
    for entity, line in ((ORDERS, "{},1,2025-02-01,{}\n"), (PRODUCTS, "{},{},home,1.00,1\n")):
        keys = [1, 2, wide + 1, 3 * wide + 1]
        words = {ORDERS: ("pending", "completed"), PRODUCTS: ("lamp", "desk")}[entity]
        body = "".join(line.format(k, words[0]) for k in keys) + "bad,1,1,1\n"
        run_entity_batch(spark, entity, deliver(entity, body, f"{entity.name}1"), layout)
        data = f"{layout.silver(entity)}/data"
        first = child_names(spark, f"{data}/version=1")
        assert [n for n in first if "=" in n] == ["slice=0", "slice=1", "slice=3"]
        # The same rows again, as another file by one more rejected row.
        same = run_entity_batch(spark, entity, deliver(entity, body + "worse,1,1,1\n", f"{entity.name}2"), layout)
        assert child_names(spark, data) == ["version=1"] and same.changes["same"] == 4
        body = body.replace(line.format(wide + 1, words[0]), line.format(wide + 1, words[1]))
        changed = run_entity_batch(spark, entity, deliver(entity, body, f"{entity.name}3"), layout)
        assert [n for n in child_names(spark, f"{data}/version=3") if "=" in n] == ["slice=1"]
        assert tuple(changed.changes[k] for k in COUNTS) == (0, 1, 0, 0, 3)
        assert len(silver(spark, layout, entity, entity.key)) == 4


def test_old_versions_go_and_the_one_before_stays(spark, deliver, layout):
    options = Options(keep_versions=2)
    reader = None
    for n in range(4):
        if n == 3:
            reader = read_silver(spark, layout, PRODUCTS)
        body = f"1,lamp,home,{n}.00,1\n"
        run_entity_batch(spark, PRODUCTS, deliver(PRODUCTS, body, f"p{n}"), layout, options)
        assert len(child_names(spark, f"{layout.silver(PRODUCTS)}/data")) <= 2
    assert [str(r["price"]) for r in reader.collect()] == ["2.00"]
    kept = Options(keep_versions=1, keep_for=timedelta(hours=1))
    run_entity_batch(spark, PRODUCTS, deliver(PRODUCTS, "1,lamp,home,7.00,1\n", "p7"), layout, kept)
    assert len(child_names(spark, f"{layout.silver(PRODUCTS)}/data")) == 3


def test_rows_that_do_not_fit_are_told_if_asked_for(spark, deliver, tmp_path):
    source = deliver(ORDERS, "1,1,2025-02-01,pending\n2,1\n3,1,2025-02-01,pending,more\n")
    plain, told = Layout(str(tmp_path / "plain")), Layout(str(tmp_path / "told"))
    assert run_entity_batch(spark, ORDERS, source, plain).valid_rows == 2
    result = run_entity_batch(spark, ORDERS.with_misfits(), source, told)
    assert (result.valid_rows, result.invalid_rows) == (1, 2)
    stored = spark.read.parquet(told.quarantine(ORDERS)).select("order_id", "misfit", "quality_errors").collect()
    assert sorted(map(tuple, stored)) == [
        (2, "2,1", ["order_date is NULL", "status is NULL", "row does not fit its columns"]),
        (3, "3,1,2025-02-01,pending,more", ["row does not fit its columns"]),
    ]
    assert run_entity_batch(spark, ORDERS.with_misfits(), source, told).skipped


def test_the_rows_of_one_batch_are_told_apart_by_the_key_alone(spark, deliver, tmp_path, monkeypatch):
    counted = []
    real = jobs.repeated_keys
    monkeypatch.setattr(jobs, "repeated_keys", lambda rows, *by: counted.append(by) or real(rows, *by))
    one, two = Layout(str(tmp_path / "one")), Layout(str(tmp_path / "two"))
    sources = many(deliver, ORDER_ITEMS, [FILES[ORDER_ITEMS], "3,2,1,1,9.00\n"])
    assert run_entity_batch(spark, ORDER_ITEMS, sources[0], one).invalid_rows == 3
    assert [r.invalid_rows for r in run_entity_batches(spark, ORDER_ITEMS, sources, two)] == [3, 0]
    assert counted == [("order_item_id",), ("order_item_id", "batch_id")]
