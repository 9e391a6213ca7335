from tidemark import not_yet_quarantined

SCHEMA = "batch_id string, order_id int, quality_errors array<string>"


def new_rows(frame, invalid, stored, **options):
    result = not_yet_quarantined(
        frame(SCHEMA, *invalid), frame(SCHEMA, *stored), "order_id", **options
    )
    assert result.columns == ["batch_id", "order_id", "quality_errors"]
    return sorted(((r["batch_id"], r["order_id"]) for r in result.collect()), key=repr)


def test_loading_a_batch_twice_adds_nothing(frame):
    rows = [("b1", 1, ["x"]), ("b1", 2, ["y"])]
    assert new_rows(frame, rows, rows) == []


def test_the_same_key_in_another_batch_is_new(frame):
    assert new_rows(frame, [("b2", 1, ["x"])], [("b1", 1, ["x"])]) == [("b2", 1)]


def test_all_copies_of_a_new_key_are_added(frame):
    rows = [("b1", 1, ["x"]), ("b1", 1, ["x"]), ("b1", 2, ["y"])]
    assert new_rows(frame, rows, [("b1", 2, ["y"])]) == [("b1", 1), ("b1", 1)]


def test_null_keys_are_recognised_unless_plain_equality_is_asked_for(frame):
    rows = [("b1", None, ["x"]), ("b1", None, ["y"]), ("b1", 0, ["z"])]
    assert new_rows(frame, rows, rows) == []
    assert new_rows(frame, rows, rows, null_safe=False) == [("b1", None), ("b1", None)]
    assert new_rows(frame, [("b2", None, ["x"])], rows) == [("b2", None)]


def test_nothing_stored_yet(frame):
    assert new_rows(frame, [("b1", 1, ["x"]), ("b1", None, ["x"])], []) == [
        ("b1", 1),
        ("b1", None),
    ]
