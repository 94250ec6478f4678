import pytest

from tidemark.operators.refresh import NotIncrementalError, choose_refresh
from tidemark.plans.cascade import RetailCascade
from tidemark.storage.versioned import Files

ORDERS = "order_id,customer_id,product_id,order_date,quantity,unit_price,discount_pct,shipping_cost,order_status,payment_method\n"
PRODUCTS = "product_id,product_name,category,brand,list_price\n"
CUSTOMERS = "customer_id,first_name,last_name,city,state,customer_segment,operation,updated_at\n"

FIRST = {
    "orders": ORDERS + "1,1,1,2024-01-05,1,10.0,0.1,1.5,completed,card\n2,2,2,2024-02-06,2,5.5,0.1,1.5,completed,card\n",
    "products": PRODUCTS + "1,Car,Toys,A,9.5\n2,Pen,Office,B,1.5\n",
    "customer_changes": CUSTOMERS + "1,Ann,Lee,X,S,seg,INSERT,2024-01-01 00:00:00\n",
}
SECOND = {
    "orders": ORDERS + "3,1,1,2024-01-05,1,7.0,0.1,1.5,completed,card\n4,3,2,2024-02-07,1,3.0,0.1,1.5,cancelled,card\n",
    "products": PRODUCTS + "1,Car,Games,A,9.5\n",
    "customer_changes": CUSTOMERS + "2,Bob,Ray,Y,S,seg,INSERT,2024-01-02 00:00:00\n1,Ann,Lee,Z,S,seg,UPDATE,2024-01-03 00:00:00\n",
}


def deliver(spark, landing, files, name):
    for table, text in files.items():
        Files(spark).create_text(f"{landing}/{table}/{name}.csv", text)


def results(warehouse):
    return [
        sorted(map(str, df.select(*sorted(df.columns)).collect()))
        for df in (
            warehouse.enriched.read(), warehouse.revenue_by_category(), warehouse.daily.read(),
            *([warehouse.feedback_enriched.read(), warehouse.feedback_summary.read()] if warehouse.feedback_summary.exists() else []),
        )
    ]


class LostError(Exception):
    pass


FEEDBACK = "feedback_id,customer_id,order_id,feedback_date,rating,feedback_text,channel\n"
TOLD = [
    {"feedback": FEEDBACK + "1,1,1,2024-03-01,5,good,web\n2,2,2,2024-03-01,3,fair,web\n3,9,77,2024-04-02,1,lost,web\n"},
    {"feedback": FEEDBACK + "4,1,3,2024-04-03,1,bad,web\n5,2,2,2024-05-03,2,bad,web\n"},
]


def test_refresh_goes_on_from_any_commit(spark, new_path, monkeypatch):
    """Processes die after one commit or two, in turns, until one finds all done, as after clean refreshes.

    One commit at a time would not do: versions of a dimension appear before the events they come from.
    """
    create = Files.create_text
    outcome = []
    for dying in (False, True):
        landing, root = new_path("landing"), new_path("root")
        deliver(spark, landing, {**FIRST, **TOLD[0]}, "a")
        RetailCascade(spark, landing, root).refresh()
        deliver(spark, landing, {**SECOND, **TOLD[1]}, "b")
        lives, finished = 0, False
        while not finished:
            done = []

            def dies(self, path, text, done=done, survived=1 + lives % 2):
                if "_manifests" in path and dying:
                    if len(done) == survived:
                        raise LostError(path)
                    done.append(path)
                create(self, path, text)

            lives, finished = lives + 1, True
            warehouse = RetailCascade(spark, landing, root)
            monkeypatch.setattr(Files, "create_text", dies)
            try:
                warehouse.refresh()
            except Exception:  # a stream wraps the loss in an error of its own
                finished = False
            monkeypatch.undo()
            assert lives < 60
        outcome.append((lives, results(warehouse)))
    assert outcome[0][0] == 1 and outcome[1][0] >= 10
    assert outcome[0][1] == outcome[1][1]


def test_many_refreshes_leave_few_files(spark, new_path, monkeypatch):
    monkeypatch.setattr("tidemark.plans.cascade.UPKEEP_EVERY", 3)
    landing, root = new_path("landing"), new_path("root")
    warehouse = RetailCascade(spark, landing, root, grace_seconds=0)
    deliver(spark, landing, {**FIRST, **TOLD[0]}, "a")
    warehouse.refresh()
    for i in range(7):
        line = f"{100 + i},1,1,2024-01-09,1,7.0,0.1,1.5,completed,card\n"
        told = FEEDBACK + f"{100 + i},1,{100 + i},2024-03-05,4,more,web\n"
        deliver(spark, landing, {"orders": ORDERS + line, "feedback": told}, f"n{i}")
        warehouse.refresh()
    for table in (warehouse.orders.target, warehouse.enriched, warehouse.revenue, warehouse.feedback_enriched, warehouse.feedback_parts):
        assert len(table.versions()) <= 3
        assert all(len(gens) <= 3 for gens in table.manifest().slots.values())
        assert len([n for n in table.files.names(table.path) if n.startswith("gen=")]) <= 6
    assert warehouse.enriched.read().count() == 9
    assert warehouse.feedback_enriched.read().count() == 10
    counts = {r["product_category"]: r["feedback_count"] for r in warehouse.feedback_summary.read().collect()}
    assert counts == {"Toys": 8, "Office": 1}


def test_unrelated_orders_leave_feedback_alone(spark, new_path):
    landing = new_path("landing")
    warehouse = RetailCascade(spark, landing, new_path("root"))
    deliver(spark, landing, {**FIRST, **TOLD[0]}, "a")
    warehouse.refresh()
    feedback, parts = warehouse.feedback_enriched, warehouse.feedback_parts
    before = feedback.manifest().slots, parts.manifest().slots, feedback.manifest().rewritten
    deliver(spark, landing, {"orders": ORDERS + "50,1,1,2024-02-05,1,7.0,0.1,1.5,completed,card\n"}, "b")
    warehouse.refresh()
    assert (feedback.manifest().slots, parts.manifest().slots, feedback.manifest().rewritten) == before
    # The order of a feedback in April arrives late: that month alone is written again.
    deliver(spark, landing, {"orders": ORDERS + "77,9,2,2024-02-05,1,7.0,0.1,1.5,completed,card\n"}, "c")
    warehouse.refresh()
    slots = feedback.manifest().slots, parts.manifest().slots
    for now, then in zip(slots, before, strict=False):
        assert now["feedback_period=2024-03"] == then["feedback_period=2024-03"]
        assert now["feedback_period=2024-04"] != then.get("feedback_period=2024-04")
    counts = {r["product_category"]: r["feedback_count"] for r in warehouse.feedback_summary.read().collect()}
    assert counts == {"Toys": 1, "Office": 2}


def test_a_changed_customer_is_looked_for_in_its_own_periods(spark, new_path, monkeypatch):
    landing = new_path("landing")
    warehouse = RetailCascade(spark, landing, new_path("root"))
    deliver(spark, landing, FIRST, "a")
    warehouse.refresh()
    before, read = warehouse.enriched.manifest().slots, []
    whole = warehouse.enriched.read
    monkeypatch.setattr(warehouse.enriched, "read", lambda slots=None, *a, **k: read.append(slots) or whole(slots, *a, **k))
    moved = CUSTOMERS + "1,Ann,Lee,Z,S,seg,UPDATE,2024-01-09 00:00:00\n"
    deliver(spark, landing, {"customer_changes": moved}, "b")
    warehouse.refresh()
    after = warehouse.enriched.manifest().slots
    assert read and all(slots == ["order_period=2024-01"] for slots in read)
    assert after["order_period=2024-02"] == before["order_period=2024-02"]
    assert after["order_period=2024-01"] != before["order_period=2024-01"]
    assert {r["customer_city"] for r in whole().collect()} == {"Z", None}


def test_sources_that_have_not_delivered_are_empty(spark, new_path):
    landing = new_path("landing")
    warehouse = RetailCascade(spark, landing, new_path("root"), policy="INCREMENTAL STRICT")
    warehouse.refresh()
    assert not warehouse.enriched.exists()
    deliver(spark, landing, {"orders": FIRST["orders"]}, "a")
    warehouse.refresh()
    assert {r["customer_name"] for r in warehouse.enriched.read().collect()} == {"Unknown"}
    assert warehouse.revenue.manifest().metrics["technique"] == "full"
    deliver(spark, landing, {"customer_changes": FIRST["customer_changes"]}, "a")
    warehouse.refresh()
    assert {r["customer_name"] for r in warehouse.enriched.read().collect()} == {"Unknown", "Ann Lee"}


def test_new_feedback_changes_values_not_groups(spark, new_path):
    landing = new_path("landing")
    warehouse = RetailCascade(spark, landing, new_path("root"))
    deliver(spark, landing, FIRST, "a")
    rows = "1,1,1,2024-03-01,5,good,web\n2,2,2,2024-03-01,3,fair,web\n3,9,77,2024-03-02,1,lost,web\n"
    deliver(spark, landing, {"feedback": FEEDBACK + rows}, "a")
    warehouse.refresh()
    before = {r["product_category"]: r["feedback_count"] for r in warehouse.feedback_summary.read().collect()}
    assert before == {"Toys": 1, "Office": 1}
    added = "4,1,1,2024-03-03,1,bad,web\n5,1,1,2024-03-03,2,bad,web\n6,2,2,2024-03-03,4,good,web\n"
    deliver(spark, landing, {"feedback": FEEDBACK + added}, "b")
    warehouse.refresh()
    after = {r["product_category"]: r["feedback_count"] for r in warehouse.feedback_summary.read().collect()}
    assert after == {"Toys": 3, "Office": 2}
    deliver(spark, landing, SECOND, "b")
    warehouse.refresh()
    moved = {r["product_category"]: r["feedback_count"] for r in warehouse.feedback_summary.read().collect()}
    assert moved == {"Games": 3, "Office": 2}
    names = {r["feedback_id"]: r["customer_name"] for r in warehouse.feedback_enriched.read().collect()}
    assert names == {1: "Ann Lee", 2: "Bob Ray", 3: "Unknown", 4: "Ann Lee", 5: "Ann Lee", 6: "Bob Ray"}
    for _ in range(2):
        warehouse.report("product_category")
    assert warehouse.reports.read().count() == 2 * 3


def test_only_periods_with_new_orders_are_replaced(spark, new_path):
    landing = new_path("landing")
    warehouse = RetailCascade(spark, landing, new_path("root"))
    deliver(spark, landing, FIRST, "a")
    warehouse.refresh()
    before = warehouse.daily.manifest().slots
    line = "9,1,1,2024-01-09,1,7.0,0.1,1.5,completed,card\n"
    deliver(spark, landing, {"orders": ORDERS + line}, "b")
    warehouse.refresh()
    after = warehouse.daily.manifest().slots
    assert after["order_period=2024-02"] == before["order_period=2024-02"]
    assert after["order_period=2024-01"] != before["order_period=2024-01"]


def test_customers_that_look_the_same_rewrite_nothing(spark, new_path):
    landing = new_path("landing")
    warehouse = RetailCascade(spark, landing, new_path("root"))
    deliver(spark, landing, FIRST, "a")
    warehouse.refresh()
    before = warehouse.enriched.manifest().slots
    again = CUSTOMERS + "1,Ann,Lee,X,S,seg,UPDATE,2024-01-09 00:00:00\n"
    deliver(spark, landing, {"customer_changes": again}, "b")
    warehouse.refresh()
    assert warehouse.enriched.manifest().slots == before
    assert warehouse.enriched.bookmark("changes") == "2"


def test_strict_policy_allows_the_first_load_only():
    assert choose_refresh("INCREMENTAL STRICT", supported=False, initial=True) == "full"
    with pytest.raises(NotIncrementalError):
        choose_refresh("INCREMENTAL STRICT", supported=False)
