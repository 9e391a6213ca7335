import os
import time

from tidemark import ORDERS, PRODUCTS, Layout, process_arrivals
from tidemark.plans.jobs import read_silver
from tidemark.sources.control_log import read_events
from tidemark.streaming.arrivals import ignored_files

HEADER = "product_id,name,category,price,stock_quantity\n"


def test_files_become_batches_in_arrival_order(spark, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "lake"))
    inbox.mkdir()

    def arrive(name, body, age):
        (inbox / name).write_text(HEADER + body)
        when = time.time() - age
        os.utime(inbox / name, (when, when))

    def run():
        query = process_arrivals(
            spark, PRODUCTS, str(inbox), layout, str(tmp_path / "progress"), pattern="*.csv"
        )
        query.awaitTermination()
        rows = read_silver(spark, layout, PRODUCTS).select("product_id", "price", "is_active")
        return sorted((r[0], str(r[1]), r[2]) for r in rows.collect())

    arrive("z-first.csv", "1,lamp,home,10.00,5\n2,desk,home,20.00,1\n", age=300)
    arrive("a-second.csv", "1,lamp,home,11.00,5\n", age=200)
    assert run() == [(1, "11.00", True), (2, "20.00", False)]

    # A renamed copy is delivered by the stream but recognised by its content.
    arrive("copy-of-first.csv", "1,lamp,home,10.00,5\n2,desk,home,20.00,1\n", age=100)
    arrive("notes.txt", "not a delivery", age=50)
    assert run() == [(1, "11.00", True), (2, "20.00", False)]
    assert read_events(spark, layout.control).count() == 4
    assert run() == [(1, "11.00", True), (2, "20.00", False)]


def test_late_and_differently_named_files_arrive(spark, tmp_path):
    inbox, layout = tmp_path / "inbox", Layout(str(tmp_path / "lake"))
    inbox.mkdir()
    header = "order_id,customer_id,order_date,status\n"

    def arrive(name, order, days):
        (inbox / name).write_text(header + f"{order},7,2025-01-01,pending\n")
        when = time.time() - days * 86400
        os.utime(inbox / name, (when, when))

    def run():
        process_arrivals(spark, ORDERS, str(inbox), layout, str(tmp_path / "progress")).awaitTermination()
        return sorted(r.order_id for r in read_silver(spark, layout, ORDERS).collect())

    arrive("first.csv", 1, days=1)
    assert run() == [1]
    arrive("old.csv", 2, days=30)
    arrive("upper.CSV", 3, days=0)
    assert run() == [1, 2, 3]


def test_ignored_names_are_told(spark, tmp_path):
    for name in ("a.csv", "b.CSV", "c.txt"):
        (tmp_path / name).write_text("x")
    assert ignored_files(spark, str(tmp_path), "*.csv") == ["b.CSV", "c.txt"]
    assert ignored_files(spark, str(tmp_path), None) == []
