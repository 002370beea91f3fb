"""Times two operators against the obvious other way to write them: ``python -m voltmark_checks.baseline [sf_dir]``.

Deduplication: a chosen survivor per key against ``dropDuplicates``, whose survivor is arbitrary. Regional emissions: bills
summed per site before they meet the sites, against bills joined one by one.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import functions as F

from voltmark import build_session
from voltmark.operators import latest_per_key
from voltmark.plans import gold
from voltmark_checks.queries import stored_tables
from voltmark_checks.sample_lake import maintenance_source


def main(args: list[str]) -> None:
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    settings = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("baseline", "local[8]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    tables = stored_tables(spark, sf_dir)
    events = maintenance_source(spark, sf_dir)
    bills, sites = tables["fact_energy_cost"], tables["dim_site"]
    by_row = bills.join(sites.select("site_id", "region"), "site_id", "left").groupBy("region", "billing_period")
    ways = {
        "dedup, latest": lambda: latest_per_key(events, ["event_id"], ["ingested_at", "event_date"]),
        "dedup, any": lambda: events.dropDuplicates(["event_id"]),
        "emissions, summed first": lambda: gold.kpi_co2_by_region(bills, sites),
        "emissions, joined first": lambda: by_row.agg(F.sum("co2_emissions_kg"), F.sum("energy_cost")),
    }
    times: dict[str, list[float]] = {name: [] for name in ways}
    for _ in range(4):
        for name, way in ways.items():
            start = time.perf_counter()
            way().write.format("noop").mode("overwrite").save()
            times[name].append(round(time.perf_counter() - start, 2))
    # The first round warms up the JVM.
    print(json.dumps({"sf_dir": sf_dir, "best": {n: min(t[1:]) for n, t in times.items()}}))


if __name__ == "__main__":
    main(sys.argv[1:])
