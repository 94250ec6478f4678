"""The warehouse as one refreshable whole.

Landing files -> raw tables -> customer dimensions -> enriched orders and feedback ->
business tables and reports. ``refresh`` brings everything up to date in that order, each step from the
rows that are new to it. Every table remembers, with its own rows, how far it has read
each of its sources, so a refresh that died after any commit is completed by the next one.
Sources that have not delivered yet are empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import refresh as rf
from tidemark.operators.cdc import ChangeSpec
from tidemark.operators.joins import keep_best, null_safe_join, staged_keys
from tidemark.plans import gold, silver
from tidemark.session import stage
from tidemark.sources.files import require_columns
from tidemark.sources.ingest import FileIngest
from tidemark.storage.versioned import GEN, GRACE_SECONDS, VersionedTable
from tidemark.streaming.changes import ChangeTarget

CUSTOMER_HINTS = {"zip_code": "string", "last_name": "string"}
NO_CUSTOMERS = (
    "customer_id long, first_name string, last_name string, customer_segment string, city string, state string"
)
NO_ORDERS = (
    "order_id long, product_id long, order_date date, order_status string, quantity int, unit_price double"
)
FEEDBACK = ["feedback_id", "customer_id", "order_id", "feedback_date", "rating", "feedback_text", "channel"]
NO_PRODUCTS = "product_id long, product_name string, category string, brand string, list_price double"
# Refreshes after which small generations are merged and superseded files removed.
UPKEEP_EVERY = 8
SMALL_BYTES = 128 << 20
REVENUE = {
    "total_orders": ("count", "1"),
    "total_revenue": ("sum", "line_total"),
}


class RetailCascade:
    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        root: str,
        period: str = "yyyy-MM",
        policy: str = "AUTO",
        glob: str = "*.csv",
        grace_seconds: float = GRACE_SECONDS,
    ):
        self.spark, self.period, self.policy, self.grace = spark, period, policy, grace_seconds

        def raw(name: str, hints: dict[str, str] | None = None) -> FileIngest:
            target = VersionedTable(spark, f"{root}/raw/{name}")
            checkpoint = f"{root}/checkpoints/{name}"
            return FileIngest(
                spark, f"{landing}/{name}", target, checkpoint, hints=hints, glob=glob
            )

        self.orders, self.products = raw("orders"), raw("products")
        self.feedback = raw("feedback")
        self.changes = raw("customer_changes", CUSTOMER_HINTS)
        spec = {
            "keys": "customer_id",
            "sequence_by": "updated_at",
            "apply_as_delete": "operation = 'DELETE'",
            "except_columns": ["operation", "_rescued_data"],
        }
        self.customers = ChangeTarget(spark, f"{root}/customers_current", ChangeSpec.of(**spec))
        self.history = ChangeTarget(
            spark, f"{root}/customers_history", ChangeSpec.of(**spec, scd_type=2)
        )
        self.enriched = VersionedTable(spark, f"{root}/orders_enriched", ["order_period"])
        # Which periods the orders of a customer or product lie in.
        self.placed = VersionedTable(spark, f"{root}/orders_enriched_keys", ["kind"])
        self.revenue = VersionedTable(spark, f"{root}/revenue_by_category_parts")
        self.daily = VersionedTable(spark, f"{root}/daily_sales_summary", ["order_period"])
        self.feedback_enriched = VersionedTable(spark, f"{root}/feedback_enriched", ["feedback_period"])
        self.feedback_parts = VersionedTable(spark, f"{root}/feedback_by_category_parts", ["feedback_period"])
        self.feedback_summary = VersionedTable(spark, f"{root}/feedback_by_category")
        self.reports = VersionedTable(spark, f"{root}/feedback_reports")

    # ------------------------------------------------------------ steps

    def _new_rows(self, source: VersionedTable, reader: VersionedTable, app: str) -> DataFrame | None:
        """Rows the reader has not taken from the source yet; None if there are none."""
        seen = int((reader.bookmark(app) if reader.exists() else None) or 0)
        if not source.exists() or source.manifest().version <= seen:
            return None
        return source.added_since(seen)

    def _apply_changes(self) -> None:
        raw = self.changes.target
        for target, table in (
            (self.customers, self.customers.state),
            (self.history, self.history.events),
        ):
            rows = self._new_rows(raw, table, "changes")
            if rows is not None:
                target.apply(rows, txn=("changes", str(raw.manifest().version)))

    def _customers(self) -> DataFrame:
        if self.customers.state.exists():
            return self.customers.read()
        return self.spark.createDataFrame([], NO_CUSTOMERS)

    def _products(self) -> DataFrame:
        """One row per product: the one delivered last."""
        if not self.products.target.exists():
            return self.spark.createDataFrame([], NO_PRODUCTS)
        rows = self.products.target.read(with_generation=True)
        rest = [F.col(c) for c in rows.columns if c not in ("product_id", GEN)]
        return keep_best(rows, ["product_id"], [F.col(GEN), *rest]).drop(GEN)

    def _enrich(self, rows: DataFrame) -> DataFrame:
        with_customer = silver.add_customer(rows, self._customers())
        return silver.add_product(with_customer, self._products())

    def _slots_of(self, key: str, keys: DataFrame) -> list[str]:
        """The slots of enriched orders that can hold rows with these keys."""
        known = self.placed.read([self.placed.slot(key)]).filter(F.col("kind") == key)
        periods = known.join(keys.withColumnRenamed(key, "key"), "key", "left_semi").select("order_period").distinct()
        return [self.enriched.slot(r[0]) for r in periods.collect()]

    def _place(self, fresh: DataFrame, txn: tuple[str, str]) -> None:
        """Notes the periods of new orders per key, before the orders themselves appear."""
        table = self.placed
        if table.exists() and table.has_txn(*txn):
            return
        dated = silver.orders_enriched(fresh).withColumn("order_period", self._period())
        pairs = reduce(
            DataFrame.unionByName,
            [
                dated.select(F.lit(key).alias("kind"), F.col(key).cast("string").alias("key"), "order_period").distinct()
                for key in ("customer_id", "product_id")
            ],
        )
        if table.exists():
            pairs = null_safe_join(pairs, table.read(), ["kind", "key", "order_period"], "left_anti")
        table.append(pairs, txn=txn, cluster=True)

    def _shown_otherwise(
        self, rows: DataFrame, key: str, fresh: Callable, shown: list[str], slots: list[str]
    ) -> DataFrame:
        """Keys among the delivered rows whose stored orders show other values than they should."""
        keys = rows.select(key).distinct()
        old = self.enriched.read(slots).select(key, *shown).join(keys, key, "left_semi").distinct()
        new = fresh(keys).select(key, *[F.col(c).alias(f"__{c}") for c in shown])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in shown])
        return old.join(new, key).filter(~same).select(key).distinct()

    def _refresh_enriched(self) -> None:
        table, raw = self.enriched, self.orders.target
        stored = table.exists()
        if stored:
            facts = [c.name for c in _fact_fields(table)]

            def again(rows: DataFrame) -> DataFrame:
                return self._enrich(rows.select(*facts, "order_period"))

            for app, key, source, fresh, shown in (
                (
                    "changes", "customer_id", self.changes.target,
                    lambda keys: silver.add_customer(keys, self._customers()), silver.customer_columns(),
                ),
                (
                    "products", "product_id", self.products.target,
                    lambda keys: silver.add_product(keys, self._products()), silver.product_columns(),
                ),
            ):
                rows = self._new_rows(source, table, app)
                if rows is not None:
                    delivered = staged_keys(rows.select(F.col(key)).distinct())
                    slots = self._slots_of(key, delivered.select(F.col(key).cast("string").alias(key)))
                    changed = self._shown_otherwise(delivered, key, fresh, list(shown), slots)
                    txn = (app, str(source.manifest().version))
                    rf.refresh_dimension_change(table, changed, [key], again, txn, slots)
        fresh = self._new_rows(raw, table, "orders")
        if fresh is not None:
            self._place(fresh, ("orders", str(raw.manifest().version)))
            rows = self._enrich(silver.orders_enriched(fresh)).withColumn("order_period", self._period())
            # The first rows are enriched with all that the dimensions hold.
            known = {"changes": self.changes, "products": self.products}
            bookmarks = {a: str(i.target.manifest().version) for a, i in known.items()}
            table.append(
                rows,
                txn=("orders", str(raw.manifest().version)),
                bookmarks=None if stored else bookmarks,
                cluster=True,
            )

    def _period(self) -> Column:
        return F.date_format("order_date", self.period)

    def _refresh_revenue(self) -> str:
        raw, products = self.orders.target, self.products.target
        initial = not self.revenue.exists()
        fresh = self._new_rows(raw, self.revenue, "orders")
        relisted = not initial and self._new_rows(products, self.revenue, "products") is not None
        if fresh is None and not relisted:
            return "none"
        # Recorded row counts of the ingestion, no scan.
        newest = raw.manifest()
        before = 0 if initial else int(self.revenue.bookmark("orders_rows") or 0)
        how = rf.choose_refresh(
            self.policy,
            supported=not relisted,
            initial=initial,
            delta_rows=newest.total_rows - before,
            source_rows=newest.total_rows,
        )
        groups = ["product_category"]
        if how == "full":
            parts = rf.partials(gold.sold(self.enriched.read()), groups, REVENUE)
        else:
            new = silver.add_product(silver.orders_enriched(fresh), self._products())
            delta = rf.partials(gold.sold(new), groups, REVENUE)
            parts = rf.merge_partials(self.revenue.read(), delta, groups, REVENUE)
        bookmarks = {
            "orders": str(newest.version),
            "orders_rows": str(newest.total_rows),
            "products": str(products.manifest().version),
        }
        self.revenue.replace(parts, bookmarks=bookmarks, metrics={"technique": how})
        return how

    def _refresh_daily(self) -> None:
        """Only the periods that new orders fall into are read and replaced."""
        raw = self.orders.target
        fresh = self._new_rows(raw, self.daily, "orders")
        if fresh is None:
            return
        txn = ("orders", str(raw.manifest().version))

        def summary(rows: DataFrame) -> DataFrame:
            return gold.daily_sales_summary(rows).withColumn("order_period", self._period())

        if not self.daily.exists():
            self.daily.replace(summary(self.enriched.read()), txn=txn)
            return
        days = stage(silver.orders_enriched(fresh).select("order_date").distinct())
        periods = days.select(self._period()).distinct().collect()
        slots = [self.enriched.slot(r[0]) for r in periods]
        rows = rf.refresh_groups(
            self.daily.read(slots), self.enriched.read(slots), days, ["order_date"], summary
        )
        self.daily.replace_slots(rows, slots, txn=txn, cluster=True)

    def _orders(self) -> DataFrame:
        raw = self.orders.target
        return raw.read() if raw.exists() else self.spark.createDataFrame([], NO_ORDERS)

    def _refresh_feedback(self) -> None:
        """New feedback is enriched; stored feedback again where its order, product or customer changed."""
        table, raw = self.feedback_enriched, self.feedback.target

        def enrich(rows: DataFrame) -> DataFrame:
            """Only what the rows refer to is joined; the keys are broadcast if they are few."""
            told = rows.select(*FEEDBACK)
            wanted = {k: staged_keys(told.select(k).distinct()) for k in ("order_id", "customer_id")}
            orders = self._orders().join(wanted["order_id"], "order_id", "left_semi")
            customers = self._customers().join(wanted["customer_id"], "customer_id", "left_semi")
            full = silver.feedback_enriched(told, orders, self._products(), customers)
            return full.withColumn("feedback_period", F.date_format("feedback_date", self.period))

        def orders_of(products: DataFrame) -> DataFrame:
            return self._orders().join(products.select("product_id").distinct(), "product_id", "left_semi")

        sources = {
            "orders": (self.orders.target, "order_id", lambda rows: rows),
            "products": (self.products.target, "order_id", orders_of),
            "changes": (self.changes.target, "customer_id", lambda rows: rows),
        }
        if table.exists():
            for app, (source, key, keys_of) in sources.items():
                rows = self._new_rows(source, table, app)
                if rows is not None:
                    txn = (app, str(source.manifest().version))
                    rf.refresh_dimension_change(table, keys_of(rows).select(key), [key], enrich, txn)
        fresh = self._new_rows(raw, table, "feedback")
        if fresh is not None:
            known = {app: str(source.manifest().version) for app, (source, _, _) in sources.items()}
            table.append(
                enrich(fresh),
                txn=("feedback", str(raw.manifest().version)),
                bookmarks=None if table.exists() else known,
            )

    def _refresh_feedback_summary(self) -> None:
        """Parts of the periods whose stored feedback is not what it was; the summary adds parts up."""
        source, parts, table = self.feedback_enriched, self.feedback_parts, self.feedback_summary
        if not source.exists():
            return
        newest = source.manifest()
        version = str(newest.version)
        seen = int(parts.bookmark("enriched") or 0) if parts.exists() else 0
        if newest.version != seen:
            changed = [s for s, gens in newest.slots.items() if max(gens) > seen]
            gone = [s for s in parts.slots() if s not in newest.slots] if parts.exists() else []
            rows = source.read(changed).filter(F.col("product_category").isNotNull())
            fresh = rf.partials(rows, ["feedback_period", "product_category"], gold.FEEDBACK_PARTS)
            parts.replace_slots(fresh, [*changed, *gone], txn=("enriched", version), cluster=True)
        if not table.exists() or table.bookmark("enriched") != version:
            table.replace(gold.feedback_from_parts(parts.read()), bookmarks={"enriched": version})

    def _upkeep(self) -> None:
        """Merges what many refreshes left in small pieces, and removes what nothing refers to."""
        raws = [i.target for i in (self.orders, self.products, self.feedback, self.changes)]
        tables = [
            *raws, self.enriched, self.placed, self.revenue, self.daily, self.feedback_enriched, self.feedback_parts,
            self.feedback_summary, self.reports,
        ]
        for table in tables:
            if len(table.versions()) >= UPKEEP_EVERY:
                table.compact(UPKEEP_EVERY, SMALL_BYTES)
                table.reclaim(self.grace)

    def report(self, dimension: str) -> None:
        """Appends the feedback report for one dimension, as of now."""
        rows = gold.dimension_report(self.feedback_enriched.read(), dimension)
        self.reports.append(require_columns(rows, gold.REPORT_SCHEMA))

    # ------------------------------------------------------------ entry

    def refresh(self) -> None:
        for ingest in (self.orders, self.products, self.changes, self.feedback):
            ingest.refresh()
        self._apply_changes()
        self._refresh_enriched()
        self._refresh_revenue()
        self._refresh_daily()
        self._refresh_feedback()
        self._refresh_feedback_summary()
        self._upkeep()

    def revenue_by_category(self) -> DataFrame:
        average = F.round(F.col("total_revenue") / F.col("total_orders"), 2)
        return self.revenue.read().withColumn("avg_order_value", average)


def _fact_fields(table: VersionedTable):
    added = {*silver.customer_columns(), *silver.product_columns(), "order_period"}
    return [f for f in table.schema() if f.name not in added]
