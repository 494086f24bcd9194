"""Changes to a keyed table in versions: merges that read the touched buckets only, named loads with a ledger, several statements as one."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weirflow.catalog.incremental import ORDERS_SQL, _orders
from weirflow.plans import merge
from weirflow.registry import query
from weirflow.session import shared_dir
from weirflow.sources.versions import VersionedTable, materialise

KEY = ["o_orderkey"]
_UPSERT = lambda part, delta: merge.upsert(part, delta, KEY)


def _table(t, name: str) -> VersionedTable:
    return VersionedTable(t.spark, f"{shared_dir(t.spark)}/table-{name}-{uuid.uuid4().hex}")


def _changed(rows):
    return rows.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})


@query("merge_touched", f"""WITH o AS ({ORDERS_SQL}) SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 3 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, order_date, CASE WHEN o_orderkey % 997 = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
 FROM o WHERE o_orderkey % 10 <> 0 OR o_orderkey % 997 = 3""")
def merge_touched(t):
    """A few changed and new orders merged into a stored table: only the buckets of their keys are read and rewritten."""
    table = _table(t, "merge")
    table.create(_orders(t).filter("o_orderkey % 10 <> 0"), KEY, buckets=64)
    table.change(_changed(_orders(t).filter("o_orderkey % 997 = 3")), _UPSERT)
    return table.read()


@query("historical_load", f"""WITH o AS ({ORDERS_SQL}), y AS (SELECT year(order_date) AS y, COUNT(*) AS n FROM o GROUP BY 1) SELECT concat('year ', y) AS name, n AS offered, n AS found, row_number() OVER (ORDER BY y) AS version, SUM(n) OVER (ORDER BY y) AS rows_after FROM y""")
def historical_load(t):
    """A history loaded year by year. Loads that were done are left out when the whole is run again; every version can be read back."""
    rows = _orders(t)
    table = _table(t, "history")
    table.create(rows.limit(0), KEY)
    years = [r.y for r in rows.select(F.year("order_date").alias("y")).distinct().orderBy("y").collect()]
    for turn in (years[: len(years) // 2], years):  # interrupted half way, then run again
        for year in turn:
            table.load(f"year {year}", rows.filter(F.year("order_date") == year), _UPSERT)
    after = [(v, table.read(v).count()) for v in range(1, len(years) + 1)]
    sizes = t.spark.createDataFrame(after, "version long, rows_after long")
    return table.ledger().withColumn("version", F.col("version").cast("long")).join(sizes, "version")


@query("multi_statement", f"""WITH o AS ({ORDERS_SQL}), a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, order_date, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM o),
 b AS (SELECT * FROM a WHERE NOT (o_orderstatus = 'X' AND o_totalprice < 50000)) SELECT o_orderkey, o_orderstatus, order_date, CASE WHEN o_totalprice > 200000 THEN 200000 ELSE o_totalprice END AS o_totalprice FROM b""")
def multi_statement(t):
    """Update, delete and cap as one change: each statement sees the one before, readers see all or none."""
    table = _table(t, "statements")
    table.create(_orders(t), KEY)
    gone = lambda part, delta: part.join(delta.select(*KEY), KEY, "left_anti")
    table.run([
        lambda now: (_changed(now.filter("o_orderkey % 5 = 0")), _UPSERT),
        lambda now: (now.filter("o_orderstatus = 'X' and o_totalprice < 50000"), gone),
        lambda now: (now.filter("o_totalprice > 200000").withColumn("o_totalprice", F.lit(200000.0)), _UPSERT),
    ])
    return table.read()


@query("incremental_model", f"WITH o AS ({ORDERS_SQL}) SELECT o_orderkey, CASE WHEN order_date >= DATE '2000-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, order_date, CASE WHEN order_date >= DATE '2000-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM o")
def incremental_model(t):
    """A materialised model: the first run takes everything there is, the second only what is later than its latest day."""
    rows = _orders(t)
    table = _table(t, "model")
    materialise(table, rows.filter("order_date < date '2000-01-01'"), KEY, "order_date", _UPSERT)
    later = F.col("order_date") >= F.lit("2000-01-01").cast("date")
    source = rows.withColumns({"o_orderstatus": F.when(later, "X").otherwise(F.lit("unseen")), "o_totalprice": F.col("o_totalprice") + 1})
    materialise(table, source, KEY, "order_date", _UPSERT)
    return table.read()
